"""The corpus operators on small tables: brute force, edge cases and round trips."""

import hashlib
import os
import re
import resource
import subprocess
import sys
import time
import zlib

import numpy as np
import pytest
from compare import compare, duck
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from tallyleaf.llm import chat, components, crf, digests, langid, licenses, mixing, pii, qgrams, simhash, tokens, toxicity
from tallyleaf.llm import trees, wavelet
from tallyleaf.llm.registry import ORACLE, QUERIES
from tallyleaf.llm.tables import read

public_tokenizers = pytest.importorskip("public_tokenizers")
FILE = public_tokenizers.path("word_bpe_49k.json")
# component_id, fp, key, n and _lang clash with names the operators use themselves.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, component_id string, fp string, key int, n int"
LONG = "lorem ipsum dolor " * 20000
ROWS = [
    (3, "The cat sat on the mat", "en", "a"),
    (1, "The cat sat on the mat", "en", "a"),
    (3, "The cat sat on the mat", "en", "a"),
    (7, None, None, None),
    (None, "der Hund und die Katze", "de", None),
    (8, "", "de", "b"),
    (9, " \t\n", "fr", "b"),
    (10, "12 34 !!", "fr", "c"),
    (11, LONG, "la", "c"),
    (12, "le chat et le chien", "fr", "c"),
    (13, "mail a.b@c.de, +49 170 1234567, 1.2.3.4 and 4111 1111 1111 1111.", None, "d"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, la, s, None, "x", "y", 1, 2) for i, t, la, s in ROWS]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_twins(spark, folder, name):
    assert compare(QUERIES[name](spark, folder), duck(folder), ORACLE[name]) == ""


# SimHash


def slow_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", text.encode().translate(simhash.LOWER))
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [b" ".join(words)] * bool(words)
    hashes = [simhash.xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_positions_cover_all_close_pairs():
    assert len(simhash.POSITION_SETS) == 14
    for same in simhash.combinations(range(8), simhash.MIN_BYTES):
        assert any(set(p) <= set(same) for p in simhash.POSITION_SETS)


def test_fingerprint_of_words():
    for text in ("", "One", "one TWO", "a b c d e É Z", LONG):
        assert simhash.fingerprint(text) == slow_fingerprint(text)
    assert simhash.fingerprint(None) == 0


def brute_components(prints):
    left, out = dict(prints), {}
    while left:
        todo = [left.popitem()]
        group = []
        while todo:
            node, value = todo.pop()
            group.append(node)
            near = [n for n, v in left.items() if (v ^ value).bit_count() <= 3]
            todo += [(n, left.pop(n)) for n in near]
        out.update(dict.fromkeys(group, min(group)))
    return out


@pytest.mark.parametrize("cell", [4, 2048])
def test_links_connect_as_all_pairs(spark, cell):
    rng = np.random.default_rng(1)
    prints = {}
    for _ in range(60):
        base = int(rng.integers(0, 2**63))
        for _ in range(int(rng.integers(1, 12))):
            prints[len(prints)] = base
            for bit in rng.integers(0, 64, int(rng.integers(0, 3))):
                base ^= 1 << int(bit)
    signed = [(v - 2**64 if v >= 2**63 else v,) for v in set(prints.values())]
    links = simhash.near_links(spark.createDataFrame(signed, "fp long"), cell)
    roots = {r.node: r.root for r in components.connected_components(links).collect()}
    expected = brute_components({s[0]: s[0] % 2**64 for s in signed})
    got = {s[0]: roots.get(s[0], s[0]) for s in signed}
    assert {frozenset(k for k in got if got[k] == v) for v in got.values()} == {
        frozenset(k for k in expected if expected[k] == v) for v in expected.values()
    }


def test_near_duplicates_of_whole_table(spark, folder):
    table = {r.doc_id: r.text for r in read(spark, folder, "documents").collect()}
    expected = brute_components({i: slow_fingerprint(t or "") for i, t in table.items()})
    got = {r.doc_id: r.component_id for r in QUERIES["op1_simhash_near_dedup"](spark, folder).collect()}
    assert got == expected


def test_near_duplicates_edges(docs, empty):
    got = rows_of(simhash.near_duplicates(docs), "doc_id", "component_id")
    assert len(got) == len(ROWS) and got.count((3, 1)) == 2 and (1, 1) in got
    assert {(7, 7), (8, 7), (9, 7)} <= set(got) and (None, None) in got
    assert simhash.near_duplicates(empty).count() == 0


def test_long_chain_is_one_component(spark):
    links = spark.range(1, 40).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r.root for r in components.connected_components(links).collect()} == {1}


# Chat


def test_chat_round_trip(spark):
    turns = [
        (1, 2, "user", "b", 0),
        (1, 1, "user", "&lt;| &amp; <|im_end|>\n<|im_start|>", 0),
        (1, 3, "assistant", "<|im_next|>é", 0),
        (1, 4, "assistant", "", 0),
        (1, 4, "assistant", "", 0),
        (2, None, None, None, 0),
        (None, 1, "ro\nle<|", "x<", 0),
    ]
    table = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string, pieces int")
    made = chat.format_chats(chat.with_probe(table))
    back = {r.conv_id: r for r in made.select("conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("t"), chat.loss_text(F.col("pieces")).alias("loss")).collect()}
    assert [(t.role, t.text) for t in back[1].t] == [
        ("user", turns[1][3]), ("user", "b"), ("assistant", turns[2][3]), ("assistant", ""), ("assistant", ""),
    ]
    assert back[1].loss == turns[2][3] and back[1].formatted.count(chat.START) == 2
    assert [(t.role, t.text) for t in back[None].t] == [("ro\nle<|", "x<")]
    assert [(t.role, t.text) for t in back[2].t] == [("", "")]
    assert back[-1].loss == chat.PROBE and len(back[-1].t) == 2
    assert chat.format_chats(table.where("false")).count() == 0


# Tokens


@pytest.mark.parametrize("bits,n", [(1, 10), (5, 1), (5, 300), (16, 70000), (5, 0)])
def test_wavelet_round_trip(bits, n):
    ids = np.random.default_rng(n).integers(0, 1 << bits, n)
    file = wavelet.WaveletMatrix(wavelet.build(ids, bits))
    assert (file.all() == ids).all() and file.n == n
    for i in range(0, n, max(1, n // 7)):
        assert file.access(i) == ids[i]
        assert file.rank(int(ids[i]), i) == (ids[:i] == ids[i]).sum()
        assert file.select(int(ids[i]), int((ids[:i] == ids[i]).sum())) == i
    assert file.select(0, n) is None and file.rank(1 << bits, n) == 0


def encode(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(FILE)
    return [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_pieces_encode_as_whole_texts():
    texts = ["", "Hello, world! it's 3 o'clock\r\nÉté déjà", "é ́x İI ẞ <|endoftext|> a<|endoftext|>b", "日本 x..! ..", LONG[:500]]
    texts += ["'s a'S $$$É'' `a` (@) \\[x] {~} ß ÿ! × a÷b Á́a ö_ö __ BY-NC ##Ñu.& <|a|>", "x" * 3000]
    encoder = tokens.PieceEncoder(FILE)
    assert [encoder.encode(t).tolist() for t in texts] == encode(texts)


def test_forgotten_pieces_are_learned_again(monkeypatch):
    monkeypatch.setattr(tokens, "MEMORY", 6)
    texts, encoder = ["a b c d e f g", "a b a b", "g. h a! (b)"], tokens.PieceEncoder(FILE)
    assert [encoder.encode(t).tolist() for t in texts] == encode(texts)
    assert len(encoder) <= 3 and len(encoder.older) <= 3


@pytest.mark.parametrize("shard", [50, tokens.SHARD])
def test_token_files(docs, empty, shard):
    got = [tuple(r) for r in tokens.read_documents(tokens.write_shards(docs, FILE, shard=shard)).orderBy("start").collect()]
    order = sorted(((i, t or "") for i, t, _, _ in ROWS), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    at, expected = 0, []
    for (i, _), ids in zip(order, encode([t for _, t in order])):
        raw = np.array([*ids, 1], "<u4")
        expected.append((i, at, len(raw), zlib.crc32(raw.tobytes())))
        at += len(raw)
    assert got == expected
    assert tokens.read_documents(tokens.write_shards(empty, FILE)).count() == 0


# Licenses


def scan_one(spark, text):
    table = spark.createDataFrame([(1, text)], "doc_id long, text string")
    return licenses.report(licenses.scan(table)).first()


def test_license_phrases_and_suppression(spark):
    got = scan_one(spark, "Licensed UNDER the MIT license under the mit license. Apache-License, version 2 CC-BY_NC")
    assert (got.n_base, got.first_word, got.last_word) == (4, 1, 13) and got.base_labels == "apache-2,cc-by-nc,mit"
    # The longer name stands, the shorter one within it goes.
    assert scan_one(spark, "licensed under the creative commons attribution sharealike license").labels == "cc-by-sa"
    assert scan_one(spark, "released under the gnu general public license version 3").labels == "gpl-3"
    assert scan_one(spark, "This program has an SPDX-License-Identifier: BSD-3-Clause").labels == "bsd-3"
    assert scan_one(spark, "Keep calm").n_words == 2
    assert len(licenses.rules()) > 250


PLAIN = {
    "This is licensed under the GPL.": "gpl",
    "LGPL licensed code": "lgpl",
    "released under the AGPL": "agpl",
    "see the MPL license": "mpl",
    "License: EPL": "epl",
    "released under the BSD license": "bsd",
    "licensed under the Apache License": "apache",
    "under a Creative Commons license": "cc",
    "licensed under the GNU General Public License": "gpl",
    "licensed under the GNU Affero General Public License": "agpl",
    "licensed under the GNU Lesser General Public License": "lgpl",
    # The versioned name stands alone.
    "licensed under the GPL version 2": "gpl-2",
    "licensed under the Apache License, Version 2.0": "apache-2",
    "released under the new BSD license": "bsd-3",
    "licensed under CC-BY-SA": "cc-by-sa",
    "Licensed under the LGPL 2.1 license": "lgpl-2",
    "License: MPL-2.0": "mpl-2",
    "GNU AGPL v3 license": "agpl-3",
    "Python licensed under the MIT license": "mit",
    "the apache helicopter and the cc field of a general public mail": "",
}


def test_license_families_without_version(spark):
    table = spark.createDataFrame(list(enumerate(PLAIN)), "doc_id long, text string")
    got = {list(PLAIN)[r.doc_id]: r.labels for r in licenses.report(licenses.scan(table)).collect()}
    assert got == PLAIN


def test_base_phrases_equal_brute_force(spark, folder):
    table = read(spark, folder, "documents")
    phrases, expected = ("under the mit license", "apache license version 2", "cc by nc"), {}
    for r in table.select("doc_id", "text").collect():
        words = re.findall("[a-z0-9\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), r.text or ""))
        at = [i for i in range(len(words)) for p in phrases if words[i : i + len(p.split())] == p.split()]
        expected[r.doc_id] = (len(at), min(at, default=None), max(at, default=None))
    got = {r.doc_id: (r.n_base, r.first_word, r.last_word) for r in QUERIES["op4_license_scan"](spark, folder).collect()}
    assert got == expected and any(n for n, _, _ in expected.values())


def test_license_edges(docs, empty):
    got = licenses.report(licenses.scan(docs))
    assert got.count() == len(ROWS) and got.where("labels <> '' or score <> 0").count() == 0
    assert {r.n_words for r in got.where("doc_id in (7, 8, 9)").collect()} == {0}
    assert licenses.scan(empty).count() == 0


# Toxicity


def test_trees_and_isotonic():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(800, 4))
    y = (x[:, 1] > 0.3).astype(int)
    model = trees.boost(x[:400], y[:400])
    margins = trees.margin(model, x[400:])
    assert ((margins > 0) == y[400:]).mean() > 0.95
    steps = trees.isotonic(margins, y[400:])
    assert (np.diff(steps[:, 1]) >= 0).all() and ((0 <= trees.calibrated(steps, margins)) & (trees.calibrated(steps, margins) <= 1)).all()
    for only in (0, 1):
        assert len(trees.boost(x[:5], np.full(5, only))[2]) == 0


def test_toxicity_held_out(spark, docs):
    rng = np.random.default_rng(3)
    words = [f"word{i}" for i in range(300)]
    rows = []
    for i in range(900):
        said = list(rng.choice(words, 40))
        if i % 6 == 0:
            said[int(rng.integers(40))] = f"gromb{'abcdefgh'[int(rng.integers(8))]}"
            said[int(rng.integers(40))] = "grombix"
        rows.append((i, " ".join(said), int(i % 6 == 0)))
    table = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    got = toxicity.toxicity(table.drop("toxic"), table.select("doc_id", "toxic")).collect()
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert np.mean([r.predicted == (r.doc_id % 6 == 0) for r in held]) > 0.95
    none = toxicity.toxicity(docs, table.select("doc_id", "toxic").where("false"))
    assert none.count() == len(ROWS) and none.where("score between 0 and 1").count() == len(ROWS)


# Personal data

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def slow_spans(text):
    def valid(kind, value):
        digits = re.sub("[^0-9]", "", value)
        if kind == "ip":
            return all(int(p) <= 255 for p in value.split("."))
        if kind == "card":
            doubled = [2 * int(c) - 9 * (int(c) > 4) if i % 2 else int(c) for i, c in enumerate(digits[::-1])]
            return 16 <= len(digits) <= 19 and sum(doubled) % 10 == 0
        return kind == "email" or 8 <= len(digits) <= 15

    found = [(k, m) for k, p in PATTERNS.items() for m in re.finditer(p, text)]
    return ",".join(f"{k}:{m.start()}:{m.end()}" for k, m in found if valid(k, m.group()))


def test_pii_base_spans(spark, docs, empty):
    texts = [
        "a@b.c_d@e.fg x@y@z.com @a.b 😀me@ex.org. u@v", "1.2.3.4.5.6.7.8 256.1.1.1 0255.000.1.1 1.2.3", "+1 (234) 567-89012 +12 +1234567",
        "4111-1111-1111-1111 4111 1111 1111 1112 " + "1 " * 30000, "x" * 100000 + "@", "1" * 100000, "", *[t or "" for _, t, _, _ in ROWS],
    ]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii.report(pii.sanitise(table)).collect():
        assert r.spans == slow_spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(r.spans.encode()).hexdigest()
    assert pii.sanitise(docs).count() == len(ROWS) and pii.sanitise(empty).count() == 0


def test_pii_terms_that_disclose(spark):
    rows = [(i, f"filler{i} report by zorblax at owner@corp.com about common things {i}") for i in range(6)]
    rows += [(100 + i, f"other{i} report about common things by nobody at all") for i in range(80)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    found = table.join(pii.sanitise(table), "doc_id")
    told = {r.doc_id: {r.text[t.start : t.end] for t in r.terms} for r in found.collect()}
    assert all(told[i] == {"zorblax"} for i in range(6)) and not any(told[100 + i] for i in range(80))
    out = found.where("doc_id = 2").select(pii.redacted(F.col("text"), F.col("marks"), F.col("terms")).alias("t")).first().t
    assert out == "filler2 report by  at [email] about common things 2"


def test_pii_terms_of_whole_texts(spark):
    far = " common" * 400
    rows = [(i, f"Zorblax says{far} {i} mail owner@corp.com and again zorblax, xowner@corp.comé{far} ZORBLAX") for i in range(6)]
    rows += [(100 + i, f"other{i} words common and says mail again by nobody at all") for i in range(80)]
    rows += [(200, f"here no value but zorblax{far}"), (None, "zorblaxes and 1.2.3.4zorblax"), (None, "a zorblax of no id")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, tuple((t.start, t.end) for t in r.terms)) for r in pii.sanitise(table).collect()}

    def places(text):
        outside = [m.span() for m in re.finditer("zorblax(?!es)", text.lower())]
        return tuple(p for p in outside if not text[: p[0]].endswith("1.2.3.4"))

    assert got == {(i, places(t)) for i, t in rows}
    assert len(places(rows[0][1])) == 3 and (200, places(rows[-3][1])) in got and places(rows[-3][1])


def test_pii_disclosing_pairs_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    texts = []
    for i in range(150):
        mails = [f"m{int(k)}@x.org" for k in rng.integers(0, 12, int(rng.integers(0, 3)))]
        said = [f"word{'abcdefghijklmnopqrstuvwxyz'[int(k)]}" for k in rng.integers(0, 26, 3)]
        said += [f"Near{m[1:-6]}q" for m in mails if rng.random() < 0.9]
        texts.append(" ".join(rng.permutation([*said, *mails])))
    texts += texts[:30] + ["rare m99@x.org"] * 9
    values = [set(re.findall(r"m\d+@x\.org", t)) for t in texts]
    words = [{w.lower() for w in t.split() if "@" not in w and len(w) > 2} for t in texts]
    n, expected = len(texts), set()
    for v in set().union(*values):
        for w in set().union(*words):
            both = [i for i in range(n) if v in values[i] and w in words[i]]
            if len({texts[i] for i in both}) < pii.SUPPORT:
                continue
            n_v, n_w = sum(v in s for s in values), sum(w in s for s in words)
            if np.log(n * len(both) / (n_v * n_w)) >= pii.DISCLOSURE * np.log(n / n_v):
                expected.add((v, w))
    table = spark.createDataFrame([(t,) for t in texts], "text string").withColumn("content", F.xxhash64("text"))
    rows = table.select("content", pii.base_marks(F.col("text")).alias("marks"))
    names = spark.createDataFrame([(v, w) for v in set().union(*values) for w in set().union(*words)], "v string, w string")
    names = names.select("v", "w", F.xxhash64(F.lit("email"), "v").alias("entity"), F.xxhash64("w").alias("term"))
    got = {(r.v, r.w) for r in pii.disclosing(rows, table.select("content", "text")).join(names, ["entity", "term"]).collect()}
    assert got == expected and len(expected) > 3


# Decontamination


def slow_distance(pattern, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern):
        new = [i + 1]
        for j, t in enumerate(text):
            new.append(min(row[j] + (c != t), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def test_leaks_equal_edit_distance():
    rng = np.random.default_rng(5)
    letters = b"abcdefgh "
    item = bytes(rng.choice(list(letters[:8]), 120).tolist())
    index = qgrams.make_index([(4, item), (5, b"short")])
    for edits in range(0, 16):
        changed = bytearray(item)
        for at in rng.choice(len(changed), edits, replace=False):
            kind = rng.integers(3)
            if kind == 0:
                changed[at] = 122
            elif kind == 1:
                del changed[at]
            else:
                changed.insert(at, 121)
        noise = bytes(rng.choice(list(letters[:8]), 200).tolist())
        text = noise[:90] + bytes(changed) + noise[90:]
        distance = slow_distance(item, text)
        got = qgrams.leaks(text, index)
        assert [(i, e) for i, e, _, _ in got] == ([(0, distance)] if distance <= qgrams.budget(len(item)) else [])


def test_contaminated_edges(spark, docs, empty):
    items = spark.createDataFrame([(1, "THE cat sat, on the  mat"), (2, None), (3, "cat")], "item_id long, text string")
    got = rows_of(qgrams.contaminated(docs, items), "doc_id", "item_id", "edits")
    # The short third item is held where it stands as a word.
    assert got == sorted([(1, 1, 0), (3, 1, 0), (3, 1, 0), (1, 3, 0), (3, 3, 0), (3, 3, 0)], key=repr)
    assert qgrams.contaminated(empty, items).count() == 0 and qgrams.contaminated(docs, items.where("false")).count() == 0
    assert set(qgrams.with_leaks(docs, items).columns) == {*docs.columns, "_leaks"}


def test_short_items_are_words(spark):
    texts = [(1, "Concatenate the cat."), (2, "concatenated"), (3, "x THE-cat"), (4, "the  cat the cat"), (5, "a b"), (6, "")]
    items = spark.createDataFrame([(1, "cat"), (2, "the cat"), (3, " !"), (4, "a b c d"), (5, "b"), (6, None)], "item_id long, text string")
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = [tuple(r) for r in qgrams.contaminated(docs, items).collect()]
    assert sorted(got) == [
        (1, 1, 0, 16, 19), (1, 2, 0, 12, 19), (3, 1, 0, 6, 9), (3, 2, 0, 2, 9), (4, 1, 0, 4, 7), (4, 2, 0, 0, 7), (5, 5, 0, 2, 3),
    ]


@pytest.mark.parametrize("pairs", [0, 50, 1 << 20])
def test_repeated_words_equal_edit_distance(monkeypatch, pairs):
    """Texts and items of few repeated words, whichever way their pairs of places are put together and whatever is aligned at once."""
    monkeypatch.setattr(qgrams, "PAIRS", pairs)
    monkeypatch.setattr(qgrams, "WIDEST", 150 if pairs == 50 else 1 << 20)
    rng = np.random.default_rng(pairs + 1)
    for _ in range(12):
        words = [b"ab", b"abc", b"hello"][: int(rng.integers(1, 4))]
        item, text = (b" ".join(words[k] for k in rng.integers(0, len(words), n)) for n in (30, 120))
        text = text[:150] + b"zz" * int(rng.integers(0, 3)) + text[150:]
        index = qgrams.make_index([(9, item)])
        distance = slow_distance(item, text)
        got = qgrams.leaks(text, index)
        assert [(i, e) for i, e, _, _ in got] == ([(0, distance)] if distance <= qgrams.budget(len(item)) else [])


def test_a_megabyte_of_one_word():
    item = b" ".join([b"lorem"] * 400)
    index = qgrams.make_index([(1, item), (2, item.replace(b"lorem", b"lorex", 3))])
    begun, memory = time.process_time(), resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    got = qgrams.leaks(b" ".join([b"lorem"] * 175_000), index)
    assert [(i, e) for i, e, _, _ in got] == [(0, 0), (1, 3)]
    assert time.process_time() - begun < 60 and resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - memory < 500_000


def test_benchmark_in_blocks(docs, spark, monkeypatch):
    items = spark.createDataFrame([(i, f"the cat sat on the mat {i}"[: 22 + i % 2]) for i in range(6)], "item_id long, text string")
    whole = rows_of(qgrams.contaminated(docs, items), "doc_id", "item_id", "edits")
    monkeypatch.setattr(qgrams, "BLOCK_BYTES", 30)
    assert rows_of(qgrams.contaminated(docs, items), "doc_id", "item_id", "edits") == whole and whole


# Exact duplicates


def test_exact_duplicates_edges(docs, empty):
    got = rows_of(digests.exact_duplicates(docs), "doc_id", "keep_id", "group_size", "kept")
    assert got.count((3, 3, 3, True)) == 2 and (1, 3, 3, False) in got and (None, None, 1, True) in got
    assert {(7, 8, 2, False), (8, 8, 2, True)} <= set(got) and len(got) == len(ROWS)
    assert digests.exact_duplicates(empty).count() == 0


def test_runs_merge_over_many_rounds(spark):
    table = spark.range(3000).select(F.col("id").alias("doc_id"), (F.col("id") % 7).cast("string").alias("text")).repartition(40)
    text = F.col("text")
    digest = table.select("doc_id", F.unhex(F.sha2(text, 256)).alias("digest"), F.xxhash64(text).alias("check"), F.lit(1).cast("long").alias("size"))
    got = digests.merge_runs(digest, 40).collect()
    assert sorted(r.keep for r in got) == list(range(2993, 3000)) and sum(r.n for r in got) == 3000


# Languages


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(2)
    scores, moves = rng.random((1, 4, 3)) + 0.1, rng.random((3, 3)) + 0.1
    valid = np.array([[True, True, True, False]])
    expected = np.zeros((3, 3))
    for path in np.ndindex(3, 3, 3):
        weight = np.prod([scores[0, t, y] for t, y in enumerate(path)]) * np.prod([moves[a, b] for a, b in zip(path, path[1:])])
        for t, y in enumerate(path):
            expected[t, y] += weight
    got, _, _ = crf.forward_backward(scores, valid, moves)
    assert np.allclose(got[0, :3], expected / expected.sum(axis=1, keepdims=True))


def test_words_in_switched_text():
    a, b = ["thing", "with", "other", "whether"], ["schön", "nicht", "ungern", "gehört"]
    rng = np.random.default_rng(0)
    pieces = [(lang, [str(w) for w in rng.choice(ws, 12)]) for lang, ws in [("x", a), ("y", b)] for _ in range(60)]
    model = langid.fit(pieces)
    likely, letters, _ = crf.posteriors([" ".join([*a, *b, "12"]).encode()], *model[1:])
    assert likely.argmax(axis=1)[:8].tolist() == [0] * 4 + [1] * 4 and letters.tolist() == [True] * 8 + [False]


def test_languages_held_out_and_edges(spark, folder, docs, empty):
    table = read(spark, folder, "documents")
    got = langid.languages(table).join(table.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r.lang_pred == r.lang for r in got]) > 0.9
    edge = rows_of(langid.languages(docs), "doc_id", "lang_pred", "score")
    assert {(i, "und", 0.0) for i in (7, 8, 9, 10)} <= set(edge) and len(edge) == len(ROWS)
    assert langid.languages(empty).count() == 0
    assert {r.lang_pred for r in langid.languages(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


# Mixing


def slow_targets(sizes):
    left, targets = 1.5 * sum(sizes.values()), {}
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    while True:
        rest = sum(weight[s] for s in sizes if s not in targets)
        over = [s for s in sizes if s not in targets and left * weight[s] / rest > 2 * sizes[s]]
        if not over:
            return targets | {s: left * weight[s] / rest for s in sizes if s not in targets}
        targets |= {s: 2.0 * sizes[s] for s in over}
        left = 1.5 * sum(sizes.values()) - sum(targets.values())


def test_targets_fill_up(spark):
    sizes = {"a": 10, "b": 1000, "c": 50, "é": 7, "z": 900, None: 40}
    got = mixing.source_targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long"))
    got = {r.source: r.target for r in got.collect()}
    assert {k: round(v, 6) for k, v in got.items()} == {k: round(v, 6) for k, v in slow_targets(sizes).items()}


def test_pivot_keeps_mass_and_chances():
    rng = np.random.default_rng(1)
    sizes = rng.integers(1, 50, 200).tolist()
    totals = np.zeros(200)
    for run in range(400):
        out = mixing.pivot(sizes, [0.3] * 200, rng.integers(0, 2**62, 200).tolist())
        assert sum(0 < p < 1 for p in out) <= 1
        assert abs(np.dot(sizes, out) - 0.3 * sum(sizes)) < 1e-6
        totals += out
    assert abs(totals.mean() / 400 - 0.3) < 0.02 and totals.min() > 60 and totals.max() < 190


def test_mix_reaches_targets_and_reruns_agree(spark, folder):
    table = read(spark, folder, "documents")
    one = rows_of(mixing.mix(table), "doc_id", "taken", "copies")
    assert one == rows_of(mixing.mix(table.repartition(7)), "doc_id", "taken", "copies")
    mixed = mixing.mix(table).join(table.select("doc_id", "source"), "doc_id")
    got = mixed.groupBy("source", "target").agg(F.sum("taken").alias("taken"), F.max("size").alias("most"))
    assert all(abs(r.taken - r.target) <= r.most / 2 + 1 for r in got.collect())


def test_mix_edges(docs, empty):
    got = mixing.mix(docs)
    assert got.count() == len(ROWS) and got.where("taken > 2 * size or taken < 0").count() == 0
    assert got.where("size = 0 and taken <> 0").count() == 0 and mixing.mix(empty).count() == 0


# Pipeline


def test_pipeline_stages(spark, folder, docs):
    kept = read(spark, folder, "documents")
    before = kept.count()
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, folder).cache()
        assert kept.columns == read(spark, folder, "documents").columns and kept.count() > 0
    assert kept.select("doc_id").distinct().count() <= before
    groups = simhash.near_duplicates(kept.dropDuplicates(["doc_id"]))
    assert groups.where("doc_id <> component_id").count() == 0
    assert qgrams.contaminated(kept, read(spark, folder, "benchmark")).count() == 0
    last = corpus_pipeline.STAGES[-1][1](spark, kept, folder)
    assert last.count() == kept.count()
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.where("false"), folder).count() == 0, name
        assert stage(spark, docs, folder).count() >= 0, name


@pytest.fixture(scope="module")
def odd_ids(spark):
    """Texts without an id, with one id for many, and both as copies of others."""
    rng = np.random.default_rng(8)
    texts = [" ".join(f"w{k}" for k in rng.integers(0, 10**6, 30)) for _ in range(120)]
    ids = [None] * 50 + [5] * 30 + list(range(100, 140))
    rows = [(i, t, "s" if n % 3 else None) for n, (i, t) in enumerate(zip(ids, texts))]
    # A copy of a text under a smaller id, one without an id of a text with one, and rows that are the same.
    rows += [(90, texts[119], "s"), (None, texts[118], "s"), (1, texts[0], "s"), rows[1], rows[60], rows[60]]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)


def test_near_duplicates_are_dropped_by_row(spark, folder, odd_ids):
    rows, table = odd_ids
    groups = brute_components({n: slow_fingerprint(r[1]) for n, r in enumerate(rows)})
    members = {}
    for n, group in groups.items():
        members.setdefault(group, []).append(rows[n])
    best = [min((r[0] is None, r[0] or 0) for r in group) for group in members.values()]
    got = [tuple(r) for r in corpus_pipeline.drop_near_duplicates(spark, table, folder).collect()]
    where = {rows[n]: group for n, group in groups.items()}
    assert sorted(where[r] for r in got) == sorted(members) and len(members) == 120
    kept = {where[r]: (r[0] is None, r[0] or 0) for r in got}
    assert [kept[g] for g in members] == best


def test_rows_are_mixed_by_row(spark, folder, odd_ids):
    rows, table = odd_ids
    got = [tuple(r) for r in corpus_pipeline.mix_sources(spark, table, folder).collect()]
    assert set(got) <= set(rows) and all(got.count(r) <= 2 * rows.count(r) for r in set(got))
    sizes = {s: sum(len(r[1].split()) for r in rows if r[2] == s) for s in ("s", None)}
    for source, target in slow_targets(sizes).items():
        assert abs(sum(len(r[1].split()) for r in got if r[2] == source) - target) <= 30 / 2 + 1
    again = corpus_pipeline.mix_sources(spark, table.repartition(2), folder)
    assert sorted(map(repr, got)) == sorted(repr(tuple(r)) for r in again.collect())


CLASHING = ["_lang", "_score", "_row", "_copies", "_copy", "_leaks", "_before", "a.b", "user_0", "copies", "key", "Fp", "part"]


def test_stages_keep_columns_of_any_name(spark, folder):
    docs = read(spark, folder, "documents")
    more = docs.select("n_chars", *docs.drop("n_chars").columns, *[F.concat(F.lit(n), F.col("doc_id")).alias(n) for n in CLASHING])
    plain = docs.select("n_chars", *docs.drop("n_chars").columns)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, more, folder)
        assert got.columns == more.columns, name
        rows = [tuple(r) for r in got.collect()]
        assert all(r[len(plain.columns) :] == tuple(f"{n}{r[1]}" for n in CLASHING) for r in rows), name
        if name != "source mixing":
            # Which copies are taken may follow the rows' hashes; everything else is decided by text and id.
            assert sorted(r[1] for r in rows) == sorted(r.doc_id for r in stage(spark, plain, folder).collect()), name
    assert corpus_pipeline.write_tokens(spark, more, folder).count() == docs.count()


def test_pipeline_runs_its_stages_in_full(spark, folder):
    docs = read(spark, folder, "documents")
    known = langid.with_language(docs).select("doc_id", "_lang", "_score").collect()
    expected = sorted(r.doc_id for r in known if r._lang != langid.UNKNOWN and r._score >= langid.LEAST_SCORE)
    kept = corpus_pipeline.identify_language(spark, docs, folder).cache()
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == expected
    prints = {r.doc_id: slow_fingerprint(r.text or "") for r in kept.collect()}
    kept = corpus_pipeline.drop_near_duplicates(spark, kept, folder).cache()
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(brute_components(prints).values()))
    kept = corpus_pipeline.drop_contaminated(spark, kept, folder).cache()
    mixed = sorted(r.doc_id for r in corpus_pipeline.mix_sources(spark, kept, folder).collect())
    got = corpus_pipeline.run(spark, folder)
    assert sorted(r.doc_id for r in got.select("doc_id").collect()) == mixed and mixed


def test_registered():
    assert {*QUERIES, "pipeline"} <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


def test_functions_reach_workers_without_the_package(folder, tmp_path):
    code = f"""
import sys; sys.path.insert(0, {os.path.dirname(os.path.abspath(entry.__file__))!r})
import __spark_entry__ as e
from tallyleaf.session import build_session
spark = build_session(master="local[2]", spark__ui__enabled="false", spark__sql__shuffle__partitions=2)
q = e.queries()
print("rows", q["op8_exact_dedup"](spark, {folder!r}).count(), q["signatures"](spark, {folder!r}).count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows 200" in done.stdout, done.stderr[-2000:]

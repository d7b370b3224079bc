"""Spelling variants against plain comparison of all words."""

import itertools
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyleaf.llm import spelling
from tallyleaf.llm.registry import QUERIES
from tallyleaf.llm.tables import read

SCHEMA = "doc_id long, text string, word string, n int, form string"


def plain_words(docs):
    words = Counter()
    for doc_id, text in docs:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 6:
                words[run] += 1
    return {w: n for w, n in words.items() if n >= 5}


def is_near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[at + 1 :] == b[at + 1 :] if len(a) == len(b) else a[at:] == b[at + 1 :]


def plain_variants(words):
    # Near words agree in one of their parts without one letter; so all pairs need not be tried.
    parts = {}
    for w in words:
        for p in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            parts.setdefault(p, set()).add(w)
    near = {w: set() for w in words}
    for group in parts.values():
        for a, b in itertools.combinations(group, 2):
            if is_near(a, b):
                near[a].add(b)
                near[b].add(a)
    forms = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        if best and words[best] >= 5 * words[w]:
            forms[w] = best
    out = set()
    for w, n in words.items():
        root = w
        while root in forms:
            root = forms[root]
        out.add((w, forms.get(w), root, n, len(near[w]), words[forms[w]] if w in forms else None))
    return out


def found(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_index_finds_all_near_words():
    rng = random.Random(2)
    words = sorted({"".join(rng.choice("abé") for _ in range(rng.randrange(1, 8))) for _ in range(400)})
    index = spelling.PositionIndex(words)
    for word in words + ["", "abababab", "zz"]:
        assert {words[i] for i in spelling.numbers(index.near(word))} == {w for w in words if is_near(w, word)}


@pytest.mark.parametrize("block", [3, 4096])
def test_random_words(spark, monkeypatch, block):
    monkeypatch.setattr(spelling, "BLOCK", block)
    rng = random.Random(block)
    words = {}
    for stem in ("abcabcab", "straße", "aaaaaaa", "bananas", "éééééé"):
        for _ in range(60):
            w = list(stem)
            for _ in range(rng.randrange(3)):
                at = rng.randrange(len(w) + 1)
                w[at : at + rng.randrange(2)] = rng.choice(["", "a", "b", "ÿ"])
            if len(w) >= 6:
                words["".join(w)] = rng.choice([5, 5, 6, 25, 30, 125, 700])
    words = {w: n for w, n in words.items() if len(w) >= 6}
    frame = spark.createDataFrame(list(words.items()), "word string, n long").repartition(5)
    near = {r.word: (r.n_near, r.form, r.form_n) for r in spelling.near_words(frame).collect()}
    expected = {}
    for w in words:
        others = [o for o in words if is_near(w, o)]
        if others:
            best = min(others, key=lambda o: (-words[o], o))
            expected[w] = len(others), best, words[best]
    assert near == expected


def test_chains_and_edges(spark, monkeypatch):
    chain = ["aaaaaa", "aaaaab", "aaaabb", "aaabbb", "aabbbb"]
    text = " ".join(w for i, w in enumerate(chain) for _ in range(5 ** (i + 1)))
    docs = [
        (1, text), (None, text), (None, "Großen, GROßEN großen"), (2, None), (3, ""), (4, "12 !?"), (5, "ÀÉÏ×÷ÿÿ " * 9),
        (5, "ÀÉÏ×÷ÿÿ " * 9), (6, "x" * 100_000 + " " + "Nebenan " * 20_000), *[(i, "großen Großem") for i in range(10, 900)],
    ]
    frame = spark.createDataFrame([(*d, "w", 1, "f") for d in docs], SCHEMA).repartition(4)
    got = found(spelling.variants(frame))
    assert got == plain_variants(plain_words(docs))
    assert any(r[2] == chain[-1] and r[1] == chain[1] for r in got)
    assert spelling.variants(frame.where("false")).count() == 0
    # What a task hands on early is added up again.
    monkeypatch.setattr(spelling, "HELD", 1)
    assert {r.word: r.n for r in spelling.vocabulary(frame).collect()} == plain_words(docs)


def test_whole_table(spark, folder):
    docs = [(r.doc_id, r.text) for r in read(spark, folder, "documents").collect()]
    got = found(QUERIES["op11_spelling_variants"](spark, folder))
    assert got == plain_variants(plain_words(docs))
    assert spark.createDataFrame([(r[0],) for r in got], "word string").where(F.length("word") < 6).isEmpty()

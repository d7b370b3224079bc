"""Prefix counts against the tokenizer itself."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyleaf.llm import token_counts
from tallyleaf.llm.registry import QUERIES
from tallyleaf.llm.tables import new_table, read

public_tokenizers = pytest.importorskip("public_tokenizers")
FILE = public_tokenizers.path("byte_bpe_50k.json")
# Characters and strings at which the pre-tokenizer cuts, of several scripts and widths.
ATOMS = [
    *"abcXYZ 019'!?.\n\t ", "  ", "'re", "'ll", "'ve", "'s", " the", " 'm", "\r\n", "é", "ü", "ß", "漢字", "😀", "\xa0", "　",
    "\x1c", "́", "<|endoftext|>", "<|endof", "|>", " <|endoftext|> ", "​", "ª", "×", "१२", "\u0085", "----", "====",
    "   \n  ", "\x00", "İ", "ǅ", "ation", "Straße",
]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(FILE)
    return lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)


@pytest.fixture(scope="module")
def counter():
    return token_counts.PrefixCounter(FILE)


def counts_of(counter, text):
    return token_counts.unpack(token_counts.pack(counter.steps(text))).tolist()


def test_every_prefix(counter, library):
    rng = random.Random(5)
    for _ in range(1500):
        text = "".join(rng.choice(ATOMS) for _ in range(rng.randrange(25)))
        assert counts_of(counter, text) == [library(text[:i]) for i in range(len(text) + 1)], text


@pytest.mark.parametrize("memory", [2, 7])
def test_forgetting_changes_nothing(library, memory, monkeypatch):
    monkeypatch.setattr(token_counts, "MEMORY", memory)
    counter = token_counts.PrefixCounter(FILE)
    text = "some words, and some more words; don't they've come again? " * 3
    assert counts_of(counter, text) == [library(text[:i]) for i in range(len(text) + 1)]


def test_long_pieces(counter, library):
    for text in ("x" * 5000, " " * 5000, "-" * 3000 + "a", "漢" * 2000, "ab" * 3000 + "<|endoftext|>"):
        counts = counts_of(counter, text)
        assert len(counts) == len(text) + 1
        for at in (0, 1, 127, 128, 129, 1000, len(text) - 1, len(text)):
            assert counts[at] == library(text[:at]), (text[:5], at)


def test_wide_steps_are_kept():
    steps = np.array([1, 300, -299, 0])
    assert token_counts.unpack(token_counts.pack(steps)).tolist() == [0, 1, 301, 2, 2]
    assert token_counts.unpack(token_counts.pack(np.zeros(0, np.int8))).tolist() == [0]


def test_edge_cases_and_answers(spark, library):
    long = "lorem ipsum dolor, " * 20000
    texts = [(1, "The cat sat"), (1, "The cat sat"), (None, "Größe 12 <|endoftext|>x"), (4, None), (5, ""), (6, long), (7, " \n")]
    rows = [(i, t, "n", 5) for i, t in texts]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, counts int").repartition(3)
    stored = new_table(token_counts.prefix_counts(docs, FILE), "counts")
    got = token_counts.answers(stored, limit=3, at=5)
    expected = []
    for i, text in texts:
        text = text or ""
        # All prefixes of the long text would take too long; within so few characters the limit is passed for good.
        fits = max(n for n in range(min(len(text), 200) + 1) if library(text[:n]) <= 3)
        expected.append((i, len(text.encode()), len(text), library(text), fits, library(text[:5])))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(expected, key=repr)
    assert token_counts.prefix_counts(docs.where("false"), FILE).count() == 0
    assert token_counts.answers(stored).where(F.col("n_at").isNotNull()).count() == 0


def test_whole_table(spark, folder, library):
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in QUERIES["op13_token_counts"](spark, folder).collect()}
    texts = {r.doc_id: r.text or "" for r in read(spark, folder, "documents").collect()}
    assert got == {i: (len(t.encode()), library(t), library(t) > 1024) for i, t in texts.items()}

"""Exact token counts of every prefix of a text, stored so that truncation and budget questions need no encoding."""

import os
import re
import sys
import types
from array import array
from operator import sub

import ahocorasick
import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT = 1024
#: Units, pieces and pairs of tokens that a worker remembers, each; longer units than UNIT are not remembered.
MEMORY, UNIT = 400_000, 48
#: Documents that are taken out of a batch together.
TOGETHER = 32
#: Whatever may count as white space; a unit of text begins only between two characters that surely do not.
BLANKS = "".join(c for c in map(chr, range(0x3001)) if c.isspace()) + "᠎​⁠﻿"
LETTER, DIGIT = "A-Za-zÀ-ÖØ-öø-ÿ", "0-9"
CONTRACTIONS = ("'re", "'ve", "'ll")
COUNTS = "doc_id long, n_bytes long, n_chars long, n_tokens long, counts binary"


def _byte_letters():
    """The letter that stands for each byte in the vocabulary: itself if it can be seen, else the next one from U+0100 on."""
    seen = [b for b in range(256) if chr(b).isprintable() and b not in (0x20, 0xA0, 0xAD)]
    hidden = [b for b in range(256) if b not in seen]
    return {b: b for b in seen} | {b: 0x100 + n for n, b in enumerate(hidden)}


class PrefixCounter:
    """Token counts of all prefixes of a text under a byte-level BPE file.

    Inside a piece (what the pre-tokenizer cuts off) the encoding of the first i bytes ends in one token t, and what
    is before t is the encoding of the first i - len(t) bytes. So the last token of each prefix is found from those
    of the shorter ones: it is the token t ending there which the merges leave alone next to the last token of what
    is before it, and count[i] = count[i - len(t)] + 1.

    Pieces add up, except where a prefix is cut otherwise than the whole: white space at its end is one piece, and half
    of a contraction or of a special token is ordinary text. Words come again, so the steps of the counts are
    remembered by unit, which is a stretch from a single blank to the next. Units of other characters than ASCII and
    Latin letters are cut by the file's own pre-tokenizer.
    """

    def __init__(self, file):
        # One thread per task: the other cores have tasks of their own.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(file)
        self.model, self.cut = tokenizer.model, tokenizer.pre_tokenizer.pre_tokenize_str
        self.special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        self.letters = _byte_letters()
        self.names, self.found_in = {}, ahocorasick.Automaton()
        for token, number in tokenizer.get_vocab(with_added_tokens=False).items():
            # A token that its own bytes are not encoded to ends no prefix.
            if [t.id for t in self.model.tokenize(token)] == [number]:
                self.names[number] = token
                self.found_in.add_word(token, (number, len(token)))
        self.found_in.make_automaton()
        self.spaces = frozenset(c for c in BLANKS if len(self.cut("!" + c)) == 2)
        self.plain = re.compile(rf"[!-~\s{LETTER}]*", re.ASCII).fullmatch
        marks = rf" ?[^\s{LETTER}{DIGIT}]+"
        # A contraction would be cut from the marks, so they hold no apostrophe.
        self.word = re.compile(rf"([{LETTER}]+)([!-&(-/:-@\[-`{{-~]*)").fullmatch
        self.pieces_of = re.compile(
            rf"'(?:[smtd]|re|ve|ll)| ?[{LETTER}]+| ?[{DIGIT}]+|{marks}|\s+(?!\S)|\s+", re.ASCII
        ).findall
        blanks = re.escape(BLANKS)
        self.odd = re.compile(f" [{blanks}]|[{blanks}] |^ | $").search
        self.between = re.compile(f"(?<=[^{blanks}]) (?=[^{blanks}])").split
        self.pairs, self.pieces, self.units = {}, _Recent(self._piece), _Recent(self._unit)

    def _stay(self, a, b):
        """Whether two tokens side by side are the encoding of their bytes; remembered by the caller."""
        if len(self.pairs) >= MEMORY:
            self.pairs.clear()
        return [t.id for t in self.model.tokenize(self.names[a] + self.names[b])] == [a, b]

    def _by_bytes(self, shown):
        """Token counts of the prefixes, by bytes, of a piece written in byte letters, the empty one first."""
        pairs, last, counts, done = self.pairs, [-1] * (len(shown) + 1), [0] * (len(shown) + 1), 0
        # The tokens that end at each place, the longest first.
        for end, (token, length) in self.found_in.iter(shown):
            end += 1
            if end == done:
                continue
            start = end - length
            if start:
                key = last[start] << 20 | token
                fits = pairs.get(key)
                if fits is None:
                    fits = pairs[key] = self._stay(last[start], token)
                if not fits:
                    continue
            last[end], counts[end], done = token, counts[start] + 1, end
        return counts

    def _piece(self, piece):
        """Token counts of the prefixes of one piece, by characters, from the first on."""
        if piece.isascii():
            counts = self._by_bytes(piece.translate(self.letters))[1:]
        else:
            raw = piece.encode()
            by_bytes = self._by_bytes(raw.decode("latin-1").translate(self.letters))
            counts = [by_bytes[at] for at in range(1, len(raw)) if raw[at] & 0xC0 != 0x80] + by_bytes[-1:]
        if piece in CONTRACTIONS:
            counts[1] = counts[0] + self.pieces[piece[1]][0]
        return bytes(counts) if max(counts) < 256 else counts

    def unit(self, unit):
        """Token counts of the prefixes of one unit."""
        if self.plain(unit):
            pieces = self.pieces_of(unit)
        else:
            pieces = [unit[start:end] for _, (start, end) in self.cut(unit)]
        if len(pieces) == 1:
            return self.pieces[pieces[0]]
        out, before, at_blank = [], 0, None
        for number, piece in enumerate(pieces):
            counts = self.pieces[piece]
            out += [before + c for c in counts]
            if at_blank is not None:
                out[-len(counts)] = at_blank
                at_blank = None
            elif piece[-1] in self.spaces and number + 1 < len(pieces) and pieces[number + 1][0] in self.spaces:
                # The blank that belongs to the next piece is part of this one while nothing follows it.
                at_blank = before + self.pieces[piece + pieces[number + 1][0]][-1]
            before += counts[-1]
        return out

    def _unit(self, rest):
        """The steps of a unit behind a single blank, by what is behind the blank."""
        word = self.word(rest)
        if not word:
            return _steps(self.unit(" " + rest))
        # A word and the marks behind it are two pieces.
        counts, marks = self.pieces[" " + word[1]], word[2]
        return _steps(counts) + _steps(self.pieces[marks]) if marks else _steps(counts)

    def _section(self, text):
        """The steps of a text without special tokens."""
        if not text:
            return b""
        first, *rest = self.between(text) if self.odd(text) else text.split(" ")
        counts = self.unit(first)
        return _steps(counts) + b"".join(map(self.units.__getitem__, rest))

    def steps(self, text):
        """By how much each character of a text changes the token count, as an array."""
        if not any(s in text for s in self.special):
            return self._array(text)
        (special,) = self.special
        sections, out = text.split(special), []
        for section in sections[:-1]:
            partial = self._array(section + special[:-1])
            total = int(self._array(section).sum())
            out += [self._array(section), partial[len(section) :], [total + 1 - int(partial.sum())]]
        # Up to its last character a special token is ordinary text behind what precedes it.
        return np.concatenate([*out, self._array(sections[-1])]).astype(np.int64)

    def _array(self, text):
        try:
            return np.frombuffer(self._section(text), np.int8)
        except OverflowError:
            # Steps that need more than a byte.
            units = [u if not n else " " + u for n, u in enumerate(self.between(text))]
            return np.concatenate([np.diff(np.array([*self.unit(u)], np.int64), prepend=0) for u in units])


def _steps(counts):
    """The differences of counts, as signed bytes."""
    return array("b", map(sub, counts, (0, *counts))).tobytes()


class _Recent(dict):
    """What a function gives for each key: what was used since the last turn, and found again since the one before."""

    def __init__(self, make):
        super().__init__()
        self.make, self.older = make, {}

    def __missing__(self, key):
        if 2 * len(self) >= MEMORY:
            self.older = dict(self)
            self.clear()
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(key) < UNIT:
            self[key] = value
        return value


def pack(steps):
    """The steps of one text as bytes: the width of a step, then the compressed steps."""
    small = len(steps) == 0 or (steps.max() <= 127 and steps.min() >= -128)
    kind = np.dtype("i1" if small else "<i4")
    return bytes([kind.itemsize]) + zstandard.ZstdCompressor(level=1).compress(steps.astype(kind).tobytes())


def unpack(stored):
    """The token counts of all prefixes, the empty one first."""
    raw = zstandard.ZstdDecompressor().decompress(stored[1:])
    return np.concatenate([[0], np.cumsum(np.frombuffer(raw, "i1" if stored[0] == 1 else "<i4"), dtype=np.int64)])


def _counter(file):
    """The counter of this worker process, kept on a module of its own since pickled functions get new globals each task."""
    kept = sys.modules.setdefault("tallyleaf_counters", types.ModuleType("tallyleaf_counters"))
    if not hasattr(kept, "of"):
        kept.of = {}
    if file not in kept.of:
        kept.of = {file: PrefixCounter(file)}
    return kept.of[file]


def prefix_counts(docs: DataFrame, file: str) -> DataFrame:
    """(doc_id, n_bytes, n_chars, n_tokens, counts) for every row of ``docs(doc_id, text)``.

    ``counts`` holds the exact token count of every prefix by code points, as ``unpack`` gives it; ``n_tokens`` is that of
    the whole text. Counts are those of the tokenizers library for ``file`` without added tokens; a special token's string
    in a text is that token, as is the library's default. A null text counts as empty and has no tokens; null and
    repeated ids, and repeated rows, are rows of their own; other columns are ignored; no rows give none. Rows are
    worked on one by one where they lie, so nothing is shuffled.
    """

    def counted(batches):
        counter = _counter(file)
        for batch in batches:
            for at in range(0, batch.num_rows, TOGETHER):
                some = batch.slice(at, TOGETHER)
                texts = some.column(1).to_pylist()
                steps = [counter.steps(t) for t in texts]
                columns = [
                    some.column(0),
                    pa.array([len(t.encode()) for t in texts], pa.int64()),
                    pa.array([len(s) for s in steps], pa.int64()),
                    pa.array([int(s.sum(dtype=np.int64)) for s in steps], pa.int64()),
                    pa.array([pack(s) for s in steps], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in COUNTS.split(", ")])

    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(counted, COUNTS)


def answers(stored: DataFrame, limit: int = LIMIT, at=None) -> DataFrame:
    """Answers from stored counts alone, per row: (doc_id, n_bytes, n_chars, n_tokens, fits, n_at).

    ``n_tokens`` is the count at the last prefix. ``fits`` is the length, in code points, of the longest prefix of at most
    ``limit`` tokens; counts can fall as a text goes on, so a longer prefix may fit where a shorter one does not. ``n_at``
    is the count of the first ``at`` code points, or of the whole text if it has fewer; null without ``at``.
    """

    def answered(batches):
        for batch in batches:
            tokens, fits, n_at = [], [], []
            for value in batch.column(3):
                counts = unpack(value.as_py())
                tokens.append(int(counts[-1]))
                fits.append(int(np.flatnonzero(counts <= limit)[-1]))
                n_at.append(None if at is None else int(counts[min(at, len(counts) - 1)]))
            told = [pa.array(c, pa.int64()) for c in (tokens, fits, n_at)]
            names = ["doc_id", "n_bytes", "n_chars", "n_tokens", "fits", "n_at"]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *told], names)

    schema = "doc_id long, n_bytes long, n_chars long, n_tokens long, fits long, n_at long"
    return stored.select("doc_id", "n_bytes", "n_chars", "counts").mapInArrow(answered, schema)

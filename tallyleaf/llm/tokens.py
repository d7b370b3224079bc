"""Token ids of all documents in wavelet files, and reading them back."""

import os
import re
import struct
import sys
import types
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyleaf.llm import wavelet
from tallyleaf.llm.tables import new_table

END_ID = 1
BITS = 16
#: Ids of one file, unless a single document has more.
SHARD = 1 << 20
#: Pieces of text whose ids a worker remembers.
MEMORY = 600_000
#: Bytes of text that are encoded together, or one longer document.
TOGETHER = 4 << 20
SHARDS = "part int, number int, before long, n_tokens long, payload binary"


class PieceEncoder(dict):
    """Ids of pieces of text as little-endian bytes; blanks and line ends separate pieces and tokens and give none themselves.

    A new piece of Latin letters between marks is one word and two runs of marks to the tokenizer, so each goes to its
    model directly; their normal form and byte letters are known without it. Every other new piece goes through the
    whole tokenizer. Most pieces come again, so their ids are remembered, in two generations: what was used since the last
    turn survives the next, and no more than MEMORY pieces, and half as many runs, are held.
    """

    def __init__(self, file):
        # One thread per task: the other cores have tasks of their own.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        super().__init__()
        self.tokenizer = Tokenizer.from_file(file)
        self.model = self.tokenizer.model
        # Composed letters, whose normal form is the lower case, and marks that never join letters or special tokens.
        marks = r"([!-&(-/:;=?@\[-`{}~]*)"
        self.plain = re.compile(marks + "([A-Za-zÀ-ÖØ-öø-ÿ]*)" + marks).fullmatch
        letters = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.byte_letters = {ord(c): letters.pre_tokenize_str(c)[0][0] for c in map(chr, range(0xDF, 0x100))}
        self.older, self.runs = {}, {"": b""}

    def _run(self, run):
        """The ids of letters, or of marks, that are one word to the tokenizer."""
        ids = self.runs.get(run)
        if ids is None:
            shown = run if run.isascii() else run.translate(self.byte_letters)
            found = [t.id for t in self.model.tokenize(shown)]
            if 2 * len(self.runs) >= MEMORY:
                self.runs = {"": b""}
            ids = self.runs[run] = struct.pack(f"<{len(found)}I", *found)
        return ids

    def _learn(self, piece):
        plain = self.plain(piece)
        if plain:
            before, word, after = plain.groups()
            word, known = word.lower(), self.runs.get
            ids = known(word) or self._run(word)
            if after:
                ids += known(after) or self._run(after)
            return (known(before) or self._run(before)) + ids if before else ids
        return np.array(self.tokenizer.encode(piece, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def __missing__(self, piece):
        if 2 * len(self) >= MEMORY:
            self.older = dict(self)
            self.clear()
        ids = self.older.get(piece)
        if ids is None:
            ids = self._learn(piece)
        self[piece] = ids
        return ids

    def encode(self, text):
        """The ids of a text as an array."""
        return self.encode_all(pa.array([text], pa.string()))[0]

    def encode_all(self, texts):
        """The ids of each text of an Arrow array. Pieces that come several times among the texts are looked up once."""
        pieces = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        found = pieces.flatten().dictionary_encode()
        each = list(map(self.__getitem__, found.dictionary.to_numpy(zero_copy_only=False)))
        which = found.indices.to_numpy().tolist()
        ends = (pieces.offsets.to_numpy() - pieces.offsets[0].as_py()).tolist()
        return [np.frombuffer(b"".join(map(each.__getitem__, which[a:b])), "<u4") for a, b in zip(ends, ends[1:])]


def _encoder(file):
    """The encoder of this worker process: its later tasks go on with what earlier ones loaded and learned.

    It is kept on a module of its own, since functions that were pickled by value have new globals in every task.
    """
    kept = sys.modules.setdefault("tallyleaf_encoders", types.ModuleType("tallyleaf_encoders"))
    if not hasattr(kept, "of"):
        kept.of = {}
    if file not in kept.of:
        kept.of = {file: PieceEncoder(file)}
    return kept.of[file]


def _together(batch):
    """Parts of a batch of about TOGETHER bytes of text."""
    sizes = pc.binary_length(batch.column(1)).to_numpy()
    part = (np.cumsum(sizes) - sizes) // TOGETHER
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    return [batch.slice(a, b - a) for a, b in zip(cuts, cuts[1:]) if b > a]


def _write(file, end_id, bits, shard):
    def shards(batches):
        """Files of consecutive documents of one partition."""
        encoder, held, size, number, before, part = _encoder(file), [], 0, 0, 0, None

        def packed():
            ids = np.concatenate([x for _, x in held])
            extra = {"doc_ids": [d for d, _ in held], "lengths": [len(x) for _, x in held]}
            row = [[part], [number], [before], [len(ids)], [wavelet.build(ids, bits, extra)]]
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
            names = [f.split()[0] for f in SHARDS.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds)], names)

        for batch in batches:
            for some in _together(batch):
                part = some.column(2)[0].as_py()
                kind = np.uint16 if bits <= 16 else np.uint32
                for doc_id, ids in zip(some.column(0).to_pylist(), encoder.encode_all(some.column(1))):
                    if max(end_id, ids.max(initial=0)) >> bits:
                        raise ValueError(f"ids of {file} need more than {bits} bits")
                    ids = np.append(ids.astype(kind), kind(end_id))
                    if held and size + len(ids) > shard:
                        yield packed()
                        number, before, held, size = number + 1, before + size, [], 0
                    held.append((doc_id, ids))
                    size += len(ids)
        if held:
            yield packed()

    return shards


def _read(batches):
    names = ["part", "in_part", "doc_id", "n_tokens", "ids_crc32"]
    for batch in batches:
        for at in range(batch.num_rows):
            file = wavelet.WaveletMatrix(batch.column(2)[at].as_buffer())
            lengths = np.array(file.extra["lengths"], dtype=np.int64)
            ids, ends = file.all().astype("<u4"), np.cumsum(lengths)
            starts = ends - lengths
            sums = [zlib.crc32(ids[s:e].tobytes()) for s, e in zip(starts, ends)]
            part, before = batch.column(0)[at].as_py(), batch.column(1)[at].as_py()
            columns = [
                pa.array(np.full(len(lengths), part, np.int32)),
                pa.array(starts + before),
                pa.array(file.extra["doc_ids"], pa.int64()),
                pa.array(lengths),
                pa.array(sums, pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)


def write_shards(docs: DataFrame, file: str, end_id=END_ID, bits=BITS, shard=SHARD) -> DataFrame:
    """Writes the ids of all rows of ``docs(doc_id, text)`` as wavelet files and returns the table that holds them.

    Documents are dealt by ranges of doc_id and sorted within, so partitions in order, and files in order within each,
    hold the documents in ascending doc_id order. Rows of the same doc_id are ordered by text, null ids come first, a null
    text counts as empty. Every file is one value of ``payload``, of about ``shard`` ids (or one longer document), in
    a table that Spark writes and commits, so it works on any store and survives lost executors; a file's bytes
    can be copied out as they are.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    count = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(count, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), "text"
    )
    dealt = dealt.withColumn("part", F.spark_partition_id())
    return new_table(dealt.mapInArrow(_write(file, end_id, bits, shard), SHARDS), "token-shards")


def read_documents(shards: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) per document, read from the files.

    Only the totals of partitions meet in one place, to find where each partition starts.
    """
    totals = shards.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = Window.partitionBy(F.lit(1)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).cast("long").alias("part_start"))
    schema = "part int, in_part long, doc_id long, n_tokens long, ids_crc32 long"
    read = shards.select("part", "before", "payload").mapInArrow(_read, schema)
    start = (F.col("part_start") + F.col("in_part")).alias("start")
    return read.join(starts, "part").select("doc_id", start, "n_tokens", "ids_crc32")

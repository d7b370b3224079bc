"""Spelling variants: words one edit apart, found with bitsets over the vocabulary by position and letter."""

import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyleaf.llm.tables import new_table
from tallyleaf.operators.skew import salted_join
from tallyleaf.session import cut_lineage

#: Words have at least so many code points and occurrences; a form has at least TIMES the occurrences of its word.
LEAST_LENGTH, LEAST_COUNT, TIMES = 6, 5, 5
#: One occurrence in so many loses a letter.
DAMAGED = 199
#: Words of one index, and distinct words that a task counts before it hands them on.
BLOCK, HELD = 4096, 200_000
#: Documents that are taken out of a batch together.
TOGETHER = 256
RUN = re.compile("[A-Za-zÀ-ÿ]+").findall
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
INDEXED, ASKED = 1, 2


def _counted(batches):
    """(word, n) of whole texts, added up as far as a task can hold them."""
    held = Counter()

    def handed_on():
        words = list(held)
        return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([held[w] for w in words], pa.int64())], ["word", "n"])

    for batch in batches:
        for at in range(0, batch.num_rows, TOGETHER):
            some = batch.slice(at, TOGETHER)
            for doc_id, text in zip(some.column(0).to_pylist(), some.column(1).to_pylist()):
                begun = zlib.crc32(b":" if doc_id is None else b"%d:" % doc_id)
                for word, n in Counter(RUN(text.translate(LOWER))).items():
                    hashed = zlib.crc32(word.encode(), begun)
                    if hashed % DAMAGED == 0:
                        place = hashed % len(word)
                        word = word[:place] + word[place + 1 :]
                    if len(word) >= LEAST_LENGTH:
                        held[word] += n
            if len(held) >= HELD:
                yield handed_on()
                held.clear()
    if held:
        yield handed_on()


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n): the words of ``docs(doc_id, text)`` that occur often enough, with their occurrences.

    Words are runs of Latin letters in whole texts, A-Z in lower case. One in ``DAMAGED`` by a hash of doc_id and word loses a
    letter, the same one in every run; a null doc_id is an empty string there.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).where("text is not null")
    counts = rows.mapInArrow(_counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= LEAST_COUNT)


class PositionIndex:
    """Bitsets over a list of words: for each place and letter the words that have it there, for each length the words of it.

    A word is asked for by a recurrence over its letters. ``same`` has the words that agree so far without an error;
    ``replaced``, ``longer`` and ``shorter`` have those with one, at the same place, one further and one back: the letter is then
    looked up at the shifted place. All words move on at once, with a few operations on integers of as many bits.
    """

    def __init__(self, words):
        self.at, self.length, self.everyone = {}, {}, (1 << len(words)) - 1
        # Bits are gathered by bytes first: shifting long integers bit by bit would be quadratic.
        size, marks = (len(words) + 7) // 8, {}
        for number, word in enumerate(words):
            byte, bit = number >> 3, 1 << (number & 7)
            for key in (len(word), *enumerate(word)):
                if key not in marks:
                    marks[key] = bytearray(size)
                marks[key][byte] |= bit
        for key, mark in marks.items():
            (self.length if isinstance(key, int) else self.at)[key] = int.from_bytes(mark, "little")

    def near(self, word):
        """The bitset of the words that differ from a word by one replaced, inserted or deleted letter."""
        at, same, replaced, shorter, longer = self.at, self.everyone, 0, 0, self.everyone
        for place, letter in enumerate(word):
            here = at.get((place, letter), 0)
            replaced = replaced & here | same & ~here
            shorter = shorter & at.get((place - 1, letter), 0) | same
            same &= here
            longer = longer & at.get((place + 1, letter), 0) | same
            if not (same or replaced or shorter or longer):
                return 0
        size, of = len(word), self.length.get
        return replaced & of(size, 0) | shorter & of(size - 1, 0) | longer & of(size + 1, 0)


def numbers(bits):
    """The places of the bits that are set."""
    while bits:
        low = bits & -bits
        yield low.bit_length() - 1
        bits ^= low


def _halves(words):
    """Each word under the halves it can share with a near word: (size, half, is_end, word, n).

    Of two near words the shorter one, of ``size`` letters, has a half that the error does not touch: its first size // 2
    letters are the first of the other too, or the rest of its letters are the last of the other. A word takes part with its own
    size and, as the longer one, with one less.
    """
    length = F.length("word")
    sizes = F.array(length, length - 1)
    parts = words.select("word", "n", F.explode(sizes).alias("size"))
    begin = F.floor(F.col("size") / 2).cast("int")
    both = F.array(
        F.struct(F.lit(False).alias("is_end"), F.left("word", begin).alias("half")),
        F.struct(F.lit(True).alias("is_end"), F.right("word", F.col("size") - begin).alias("half")),
    )
    return parts.select("word", "n", "size", F.explode(both).alias("h")).select("size", "h.half", "h.is_end", "word", "n")


KEYS = ("size", "half", "is_end", "block_a", "block_b")


def _met(batches):
    """(word, n_near, form, form_n) of each word and block that has near words; the rows of a block follow one another."""
    key, rows = None, []

    def done():
        size, _, is_end, *_ = key
        indexed = [(w, n) for w, n, role in rows if role & INDEXED]
        asked = [(w, n) for w, n, role in rows if role & ASKED]
        if len(indexed) + len(asked) < 2 or len(rows) < 2:
            return
        index, begin = PositionIndex([w for w, _ in indexed]), size // 2
        for word, n in asked:
            for number in numbers(index.near(word)):
                other, other_n = indexed[number]
                # Pairs of the two sizes are found from the shorter word, and are told to both.
                if len(word) != size:
                    continue
                # Words that share both halves meet twice; the first halves count.
                if is_end and word[:begin] == other[:begin]:
                    continue
                yield word, other, other_n
                if len(other) != size:
                    yield other, word, n

    def told():
        best = {}
        for word, other, n in done():
            count, form = best.get(word, (0, None))
            best[word] = count + 1, min(form or (0, ""), (-n, other)) if form else (-n, other)
        columns = list(zip(*((w, c, f[1], -f[0]) for w, (c, f) in best.items()))) or [[], [], [], []]
        kinds = (pa.string(), pa.int64(), pa.string(), pa.int64())
        names = ["word", "n_near", "form", "form_n"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    waiting, size = [], 0
    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
        for *now, word, n, role in zip(*columns):
            if now != key:
                if len(rows) > 1:
                    waiting.append(told())
                    size += waiting[-1].num_rows
                    if size > 10_000 or len(waiting) > 10_000:
                        yield from pa.Table.from_batches(waiting).combine_chunks().to_batches()
                        waiting, size = [], 0
                key, rows = now, []
            rows.append((word, n, role))
    if len(rows) > 1:
        waiting.append(told())
    if waiting:
        yield from pa.Table.from_batches(waiting).combine_chunks().to_batches()


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, form, form_n): how many words of ``words(word, n)`` are near each, and the most frequent of them.

    Words meet under a shared half (``_halves``) and there by a ``PositionIndex``. A half of many words is cut into blocks, and
    each pair of blocks is a group of its own: one block is the index, the words of the other are asked for. So
    memory is bounded by the block, and no pairs are listed but near ones.
    """
    halves = _halves(words)
    sizes = halves.groupBy("size", "half", "is_end").agg(F.count("*").alias("rows")).where("rows > 1")
    met = salted_join(halves, sizes, ["size", "half", "is_end"], ["word"])
    blocks = F.ceil(F.col("rows") / BLOCK)
    own, each = F.pmod(F.xxhash64("word"), F.col("blocks")), F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)

    def place(a, b, role):
        return F.struct(a.alias("block_a"), b.alias("block_b"), role.cast("int").alias("role"))

    indexed = F.transform(each, lambda b: place(F.col("own"), b, F.when(b == F.col("own"), INDEXED | ASKED).otherwise(INDEXED)))
    asked = F.transform(F.filter(each, lambda a: a != F.col("own")), lambda a: place(a, F.col("own"), F.lit(ASKED)))
    spread = met.withColumn("blocks", blocks).withColumn("own", own)
    spread = spread.select("size", "half", "is_end", F.explode(F.concat(indexed, asked)).alias("p"), "word", "n")
    spread = spread.select("size", "half", "is_end", "p.block_a", "p.block_b", "word", "n", "p.role")
    dealt = spread.repartition(*KEYS).sortWithinPartitions(*KEYS)
    found = dealt.mapInArrow(_met, "word string, n_near long, form string, form_n long")
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form")).alias("best")
    merged = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return merged.select("word", "n_near", F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for ``forms(word, form)``, following forms to the last.

    Each round replaces a word's target by its target's target, so the rounds follow the logarithm of the longest chain. As a
    form is TIMES as frequent as its word, no chain is longer than the logarithm of the largest count.
    """
    now = cut_lineage(forms.select("word", F.col("form").alias("root")))
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = salted_join(now, further, ["root"], ["word"], "left")
        moved = cut_lineage(moved.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        now = moved.drop("moved")
        if moved.where("moved").isEmpty():
            return now


def variants(docs: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of ``vocabulary(docs)``.

    Two words are near if they differ by one inserted, deleted or replaced code point. A word's form is its most frequent near
    word (the least in code-point order of equals) if that occurs TIMES as often as the word, else null; the root is where forms
    lead, or the word itself. Null and empty texts hold no words, repeated rows count again, other columns are ignored, and
    no rows give no words.
    """
    words = new_table(vocabulary(docs), "vocabulary")
    near = words.join(near_words(words), "word", "left")
    often = F.col("form_n") >= TIMES * F.col("n")
    judged = near.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(often, F.col("form")).alias("form"),
        F.when(often, F.col("form_n")).alias("form_n"),
    )
    judged = new_table(judged, "forms")
    followed = roots(judged.where("form is not null"))
    root = F.coalesce("root", "word").alias("root")
    return judged.join(followed, "word", "left").select("word", "form", root, "n", "n_near", "form_n")

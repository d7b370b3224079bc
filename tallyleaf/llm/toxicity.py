"""Toxicity of documents by boosted trees over dense features, calibrated by isotonic regression."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyleaf.llm import trees
from tallyleaf.session import cut_lineage

#: Bound of the training sample: labelled documents, chosen by a hash of doc_id.
SAMPLE_DOCS = 30_000
THRESHOLD = 0.7
#: A lexicon entry occurs in so many toxic documents of the sample, and so many times likelier than in others.
LEAST_DOCS, LEAST_RATIO = 3, 8.0
#: How often a dense term comes in a toxic text that has it, at least.
AGAIN = 2.0
PREFIXES = (4, 5, 6, 7, 8)
#: Insults and forms of address that are known without any label.
INSULTS = frozenset(
    "idiot moron loser scum trash clown pathetic worthless disgusting stupid dumb fool jerk liar coward creep freak garbage"
    " imbecile vermin filth pig rat worm ugly hate shut kill die abschaum idiotin dummkopf connard imbécile salaud estúpido"
    " idiota imbécil basura".split()
)
SECOND_PERSON = frozenset(
    "you your yours yourself u ur thou du dich dir dein deine ihr euch euer sie tu te toi ton ta tes vous votre vos"
    " tú ti tuyo usted ustedes vosotros vuestro".split()
)
NEAR = 5
#: Weights from which on terms are counted.
STRENGTHS = (2.0, 4.0, 6.0)
FEATURES = (
    "words told_rate told_2 told_4 told_6 best second insult_rate insult_count near_rate capitals shouts exclaims"
    " punctuation disguised repeats dense_rate dense_count"
).split()
WORD = re.compile(r"\w+")
DISGUISED = re.compile(r"(?<![^\W\d_])[^\W\d_]++[0-9@$!*#]++[^\W\d_]++")
SHOUTED = re.compile(r"\b[A-ZÀ-ÖØ-Þ]{2,}+\b")
UNDO = str.maketrans("013457@$!", "oieastasi")


def held_out(doc_id):
    return F.crc32(doc_id.cast("string")) % 3 == 1


def terms(word):
    """A word and its beginnings, which stand for whole families of inflected words."""
    return [word, *[word[:k] + "+" for k in PREFIXES if len(word) >= k]]


FOLDS = 3
COUNTS = ("clean", "toxic", "clean_words", "toxic_words")


def _counts(batches):
    """Per few texts and fold: in how many texts with and without the label each term occurs, and how often in all."""
    for batch in (b.slice(at, 256) for b in batches for at in range(0, b.num_rows, 256)):
        counts = {}
        for text, toxic, part in zip(*(c.to_pylist() for c in batch.columns)):
            met = Counter()
            for word, n in Counter(WORD.findall((text or "").lower())).items():
                for term in terms(word):
                    met[term] += n
            for term, n in met.items():
                of = counts.setdefault((term, part), [0, 0, 0, 0])
                of[toxic] += 1
                of[2 + toxic] += n
        columns = [[t for t, _ in counts], [p for _, p in counts], *([c[k] for c in counts.values()] for k in range(4))]
        kinds = (pa.string(), *[pa.int64()] * 5)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["term", "part", *COUNTS])


def learn_lexicons(texts: DataFrame):
    """For each fold the lexicon of the texts outside it, and last that of all, of ``texts(text, toxic, part)``.

    A lexicon is ({term: weight}, dense terms). A term has a weight if it occurs in far more toxic texts than others; the weight
    is the root of the likelihood ratio statistic, so that few chance meetings weigh less than many. Long texts hold most
    words by chance, so a term is dense if it makes up a far larger share of the words of toxic texts, and comes again in them.
    """
    counted = texts.select("text", "toxic", F.col("part").cast("long")).mapInArrow(
        _counts, "term string, part long, " + ", ".join(f"{c} long" for c in COUNTS)
    )
    # One row per fold; words are counted once, as their own terms.
    sizes = texts.groupBy("part").agg(*[F.count_if(F.col("toxic") == k).cast("double").alias(c) for k, c in enumerate(COUNTS[:2])]).collect()
    folds = [*range(FOLDS), None]
    sums = [
        F.sum(F.when(F.col("part") != F.lit(-1 if k is None else k), F.col(c))).alias(f"{c}_{n}")
        for n, k in enumerate(folds)
        for c in COUNTS
    ]
    plain = ~F.endswith("term", F.lit("+"))
    summed = cut_lineage(counted.groupBy("term").agg(*sums).na.fill(0))
    words = summed.where(plain).agg(*[F.sum(f"{c}_{n}").alias(f"{c}_{n}") for n in range(len(folds)) for c in COUNTS[2:]]).first()
    out = []
    for n, k in enumerate(folds):
        n_clean, n_toxic = (sum(r[c] for r in sizes if r.part != k) + 1 for c in COUNTS[:2])
        clean, toxic, clean_words, toxic_words = (F.col(f"{c}_{n}") for c in COUNTS)
        a, b = toxic + 0.5, clean + 0.5
        share = (a + b) / (n_toxic + n_clean)
        evidence = 2 * (a * F.ln(a / (share * n_toxic)) + b * F.ln(b / (share * n_clean)))
        often = (toxic >= LEAST_DOCS) & (a / n_toxic >= LEAST_RATIO * b / n_clean)
        all_clean, all_toxic = (float(words[f"{c}_{n}"] or 0) + 1 for c in COUNTS[2:])
        again = (toxic >= LEAST_DOCS) & (toxic_words >= AGAIN * toxic)
        dense = again & ((toxic_words + 0.5) / all_toxic >= LEAST_RATIO * (clean_words + 0.5) / all_clean)
        kept = summed.where(often | dense).select("term", often.alias("often"), dense.alias("dense"), F.sqrt(F.greatest(evidence, F.lit(0.0))).alias("w"))
        rows = list(kept.toLocalIterator())
        out.append(({r.term: r.w for r in rows if r.often}, frozenset(r.term for r in rows if r.dense)))
    return out


class Describer:
    """The features of texts, in the order of FEATURES; remembers the weights of words it has met."""

    MEMORY = 200_000

    def __init__(self, lexicon):
        (self.lexicon, self.dense), self.known, self.is_dense = lexicon, {}, {}

    def _weigh(self, words):
        lexicon, known = self.lexicon, self.known
        for w in words:
            of = terms(w)
            known[w] = max(lexicon.get(t, 0.0) for t in of)
            self.is_dense[w] = not self.dense.isdisjoint(of)

    def __call__(self, text):
        text = text or ""
        low = WORD.findall(text.lower())
        different, n, letters = set(low), max(len(low), 1), max(len(text), 1)
        known = self.known
        new = [w for w in different if w not in known]
        if new:
            if len(known) + len(new) > self.MEMORY:
                known.clear()
                self.is_dense.clear()
                new = different
            self._weigh(new)
        weights = sorted((known[w] for w in different if known[w]), reverse=True)
        told = {w for w in different if known[w]}
        insults = different & INSULTS
        hits = [i for i, w in enumerate(low) if w in told or w in insults] if told or insults else []
        near = sum(not SECOND_PERSON.isdisjoint(low[max(i - NEAR, 0) : i + NEAR + 1]) for i in hits)
        disguised = [d.translate(UNDO).lower() for d in DISGUISED.findall(text)]
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        capitals = int(((points >= 65) & (points <= 90) | (points >= 192) & (points <= 222)).sum())
        same = points[1:] == points[:-1]
        repeats = int((same[1:] & same[:-1] & ((points[2:] | 32) >= 97)).sum())
        n_told = sum(low[i] in told for i in hits)
        dense = {w for w in different if self.is_dense[w]}
        n_dense = sum(w in dense for w in low) if dense else 0
        n_insults = sum(low[i] in insults for i in hits) + sum(d in INSULTS for d in disguised)
        return (
            np.log1p(len(low)),
            n_told / n,
            *[np.log1p(sum(w >= least for w in weights)) for least in STRENGTHS],
            weights[0] if weights else 0.0,
            weights[1] if len(weights) > 1 else 0.0,
            n_insults / n,
            np.log1p(n_insults),
            near / n,
            capitals / letters,
            len(SHOUTED.findall(text)) / n,
            text.count("!") / n,
            (text.count(",") + text.count(".") + text.count("?") + text.count("!")) / letters,
            len(disguised) / n,
            repeats / n,
            n_dense / n,
            np.log1p(n_dense),
        )


def _described(lexicons):
    def described(batches):
        describe = [Describer(lexicon) for lexicon in lexicons]
        for batch in batches:
            keyed = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            rows = [list(map(float, describe[key // 2](text))) for key, text in keyed]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.float64()))], ["key", "x"])

    return described


def labelled_sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, part, toxic, text) of up to SAMPLE_DOCS labelled documents that are not held out.

    A document with several labels counts as toxic if one says so; null labels and ids are left out.
    """
    known = labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int")).dropna()
    known = known.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    mixed = F.xxhash64("doc_id", F.lit(7))
    chosen = known.orderBy(mixed, "doc_id").limit(SAMPLE_DOCS)
    texts = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # At most SAMPLE_DOCS rows of two numbers.
    joined = texts.join(F.broadcast(chosen), "doc_id")
    return joined.select("doc_id", F.pmod(F.xxhash64("doc_id", F.lit(8)), F.lit(FOLDS)).alias("part"), "toxic", "text")


def train(docs: DataFrame, labels: DataFrame):
    """(lexicon, trees, calibration) from the sample of labelled documents.

    The lexicon is that of all of them; the features of a training document come from the lexicon of the other folds, so that
    its own words do not speak for it. The last fold is for the calibration, the others are for the trees.
    """
    texts = cut_lineage(labelled_sample(docs, labels))
    *lexicons, lexicon = learn_lexicons(texts)
    key = (F.col("part") * 2 + F.col("toxic")).cast("long").alias("key")
    rows = texts.select(key, "text").mapInArrow(_described(lexicons), "key long, x array<double>")
    found = sorted((row.key, row.x) for row in rows.toLocalIterator())
    keys = np.array([k for k, _ in found], dtype=np.int64)
    x = np.array([v for _, v in found], dtype=np.float64).reshape(-1, len(FEATURES))
    last, toxic = keys // 2 == FOLDS - 1, keys % 2
    model = trees.boost(x[~last], toxic[~last])
    return lexicon, model, trees.isotonic(trees.margin(model, x[last]), toxic[last])


def score(docs: DataFrame, model) -> DataFrame:
    """(doc_id, score) for every row of ``docs(doc_id, text)``; the text alone decides."""
    lexicon, forest, steps = model

    def scored(batches):
        describe = Describer(lexicon)
        for batch in batches:
            rows = [describe(t) for t in batch.column(1).to_pylist()]
            margins = trees.margin(forest, np.array(rows, dtype=np.float64).reshape(-1, len(FEATURES)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(trees.calibrated(steps, margins))], ["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(scored, "doc_id long, score double")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs(doc_id, text)``, learned from ``labels(doc_id, toxic)``.

    Null and empty texts are scored like any other text without words, repeated rows each get their row, other columns
    are ignored. A score is the calibrated share of toxic documents at its margin, with a little of the margin itself to keep
    scores apart (``trees.calibrated``). Without any label every score is the same and below THRESHOLD.
    """
    found = score(docs, train(docs, labels))
    out = F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out")
    return found.select("doc_id", out, "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))

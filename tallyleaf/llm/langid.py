"""Language of documents by a conditional random field over their words."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyleaf.llm import crf

UNKNOWN = "und"
#: Bounds of the training sample: documents per language and pieces of crf.LENGTH words per document.
SAMPLE_DOCS, SAMPLE_PIECES = 250, 6
LEXICON = 150
#: Bytes of text that are scored at once.
PIECE = 1 << 18
#: The pipeline rejects documents whose words agree less than this on a language.
LEAST_SCORE = 0.35


def held_out(doc_id):
    return F.crc32(doc_id.cast("string")) % 4 == 2


def _pieces(batches):
    """Evenly spaced pieces of each text, over its whole length."""
    for batch in batches:
        langs, out = [], []
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = text.lower().split()
            count = min(SAMPLE_PIECES, -(-len(words) // crf.LENGTH))
            for i in range(count):
                at = i * max(len(words) - crf.LENGTH, 0) // max(count - 1, 1)
                langs.append(lang)
                out.append(words[at : at + crf.LENGTH])
        yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(out, pa.list_(pa.string()))], ["lang", "words"])


def sample(docs: DataFrame) -> DataFrame:
    """Pieces (lang, words) of up to SAMPLE_DOCS labelled documents per language, chosen by a hash of doc_id."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("lang").cast("string"), F.col("text").cast("string"))
    usable = rows.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = usable.select("doc_id", "lang").withColumn("n", F.row_number().over(order)).where(F.col("n") <= SAMPLE_DOCS)
    # At most SAMPLE_DOCS ids per language.
    ids = F.broadcast(chosen.select("doc_id").distinct())
    texts = usable.where("text is not null").join(ids, "doc_id", "left_semi")
    return texts.select("lang", "text").mapInArrow(_pieces, "lang string, words array<string>")


def fit(pieces):
    """(languages, weights, moves, lexicon) from [(lang, words)].

    The lexicon holds the words that are most typical of each language in the sample. Half of the chains switch language
    midway, put together from pieces of two languages, so that transitions are learned too.
    """
    pieces = sorted((lang, tuple(words)) for lang, words in pieces if words)
    languages = sorted({lang for lang, _ in pieces})
    counts = {lang: {} for lang in languages}
    for lang, words in pieces:
        for w in set(words):
            counts[lang][w] = counts[lang].get(w, 0) + 1
    lexicon = set()
    for lang in languages:
        others = [counts[x] for x in languages if x != lang]
        typical = {w: c for w, c in counts[lang].items() if c > 2 * max((o.get(w, 0) for o in others), default=0)}
        lexicon.update(sorted(typical, key=lambda w: (-typical[w], w))[:LEXICON])
    lexicon = np.unique(crf.word_hashes(sorted(lexicon)))
    rng, chains = np.random.default_rng(42), []
    order = rng.permutation(len(pieces))
    for i, at in enumerate(order):
        lang, words = pieces[at]
        labels = [languages.index(lang)] * len(words)
        if i % 2:
            other_lang, other = pieces[order[i - 1]]
            cut = int(rng.integers(1, crf.LENGTH))
            words, labels = words[:cut], labels[:cut]
            rest = other[: crf.LENGTH - len(words)]
            words, labels = words + rest, labels + [languages.index(other_lang)] * len(rest)
        chains.append((list(words), labels))
    if not languages:
        return [], None, None, lexicon
    weights, moves = crf.train(chains, len(languages), lexicon)
    return languages, weights, moves, lexicon


def train(docs: DataFrame):
    """The model of the labelled documents in ``docs(doc_id, text, lang)`` that are not held out."""
    return fit([(row.lang, row.words) for row in sample(docs).toLocalIterator()])


def _cut(data):
    """A text of blank-separated words in pieces of about PIECE bytes, between words where there is a blank."""
    while len(data) > PIECE:
        at = data.rfind(b" ", 1, PIECE)
        yield data[: at if at > 0 else PIECE]
        data = data[at + 1 if at > 0 else PIECE :]
    if data:
        yield data


def predict(texts, model):
    """[(language, score)]: per text the label with the largest share of the posterior mass of all words with letters."""
    languages, weights, moves, lexicon = model
    mass, count = np.zeros((len(texts), max(len(languages), 1))), np.zeros(len(texts), np.int64)
    owners, pieces, size = [], [], 0

    def settle():
        likely, letters, counts = crf.posteriors(pieces, weights, moves, lexicon)
        starts = np.cumsum(counts) - counts
        np.add.at(mass, owners, np.add.reduceat(likely * letters[:, None], starts, axis=0, dtype=np.float64))
        np.add.at(count, owners, np.add.reduceat(letters, starts, dtype=np.int64))

    for i, text in enumerate(texts if languages else []):
        if not text or not any(map(str.isalpha, text)):
            continue
        for piece in _cut(" ".join(text.lower().split()).encode()):
            owners.append(i)
            pieces.append(piece)
            size += len(piece)
            if size >= PIECE:
                settle()
                owners, pieces, size = [], [], 0
    if pieces:
        settle()
    best = mass.argmax(axis=1)
    shares = np.minimum(mass[np.arange(len(texts)), best] / np.maximum(count, 1), 1.0)
    return [(languages[b], float(s)) if n else (UNKNOWN, 0.0) for b, s, n in zip(best, shares, count)]


def _predictions(model, column):
    def predicted(batches):
        for batch in batches:
            found = predict(batch.column(column).to_pylist(), model)
            names = [*batch.schema.names, "_lang", "_score"]
            new = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names)

    return predicted


def with_language(docs: DataFrame, model=None) -> DataFrame:
    """``docs`` with ``_lang`` and ``_score``, by a model learned from ``docs`` unless one is given.

    Learning uses text and non-null lang of rows with a doc_id that is not held out, up to the documented sample;
    predictions see the text alone. A null text, or one without letters, is UNKNOWN with score 0; without any labelled row
    every text is. Other columns and repeated rows are kept, but for those called ``_lang`` and ``_score``, which are replaced.
    """
    model = model or train(docs)
    docs = docs.drop("_lang", "_score")
    added = [T.StructField("_lang", T.StringType()), T.StructField("_score", T.DoubleType())]
    schema = T.StructType([*docs.schema, *added])
    return docs.mapInArrow(_predictions(model, docs.columns.index("text")), schema)


def languages(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row of ``docs(doc_id, text, lang)``."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    found = with_language(rows, train(docs))
    out = F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out")
    return found.select("doc_id", out, F.col("_lang").alias("lang_pred"), F.col("_score").alias("score"))

"""The corpus pipeline: five stages from raw documents to token files.

A stage takes documents with any further columns, whatever their names, and all but the last return them as they were. Stages
look at doc_id, text, lang and source; null texts have no language and go in the first stage, and no rows give none.
"""

import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyleaf.llm import langid, mixing, qgrams, simhash, tokens
from tallyleaf.llm.tables import new_table, read


KNOWN = ("doc_id", "text", "lang", "source")


def _apart(docs):
    """``docs`` with every column the operators do not know under a name of its own, so that none of theirs meets the user's."""
    return docs.toDF(*[c if c in KNOWN else f"user_{n}" for n, c in enumerate(docs.columns)])


def _back(rows, columns):
    """``rows``, which may have more columns, with the first ones under the user's names again."""
    return rows.select(rows.columns[: len(columns)]).toDF(*columns)


def _row(docs):
    """All that a row holds, as one string. Rows that agree in it are the same, whichever of them goes on."""
    return F.to_json(F.struct(*docs.columns))


def identify_language(spark, docs: DataFrame, sf_dir) -> DataFrame:
    """Documents whose text is in a known language; those without letters, or without a clear language, go."""
    found = langid.with_language(_apart(docs))
    kept = found.where((F.col("_lang") != langid.UNKNOWN) & (F.col("_score") >= langid.LEAST_SCORE))
    return _back(kept, docs.columns)


def drop_near_duplicates(spark, docs: DataFrame, sf_dir) -> DataFrame:
    """Of each group of near duplicates the row with the least doc_id, null last; among those, the least by a hash of the row."""
    rows = _apart(docs)
    keyed = rows.withColumn("_row", F.sha2(_row(rows), 256))
    chosen = keyed.join(simhash.survivors(keyed, "_row"), "_row", "left_semi").dropDuplicates(["_row"])
    return _back(chosen.select(*rows.columns), docs.columns)


def drop_contaminated(spark, docs: DataFrame, sf_dir) -> DataFrame:
    """Documents that hold no benchmark item."""
    found = qgrams.with_leaks(_apart(docs), read(spark, sf_dir, "benchmark"))
    return _back(found.where(F.size("_leaks") == 0), docs.columns)


def mix_sources(spark, docs: DataFrame, sf_dir) -> DataFrame:
    """Every row as often as the mix takes it, by a hash of the row (64 bits) in place of its doc_id.

    Rows that are the same get the sum of their copies together.
    """
    rows = _apart(docs)
    keyed = rows.withColumn("_row", F.xxhash64(_row(rows)))
    units = keyed.select(F.col("_row").alias("doc_id"), "text", "source")
    decided = mixing.mix(units).groupBy(F.col("doc_id").alias("_row")).agg(F.sum("copies").cast("int").alias("_copies"))
    chosen = keyed.join(decided.where("_copies > 0"), "_row").dropDuplicates(["_row"])
    copied = chosen.withColumn("_copy", F.explode(F.sequence(F.lit(1), "_copies")))
    return _back(copied.select(*rows.columns), docs.columns)


def write_tokens(spark, docs: DataFrame, sf_dir) -> DataFrame:
    """Token files of all documents; returns what is read back from them, per document."""
    return tokens.read_documents(tokens.write_shards(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("language ID", identify_language),
    ("SimHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("source mixing", mix_sources),
    ("token output", write_tokens),
]

#: Fingerprints, trained labels and rounding by hashes are beyond SQL; tests compare with brute force instead.
ORACLE_SQL = None


def run(spark, sf_dir) -> DataFrame:
    """All stages over ``documents``, each written before the next reads it."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = new_table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs

"""Scores of adjudicated pairs, thresholds, and checks against truth clusters."""

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyleaf.functions import alignment, minhash, text
from tallyleaf.operators import lsh

# The representations compared, as (name, text, shingling, size).
REPRESENTATIONS = (
    ("Raw + Char-5gram", "raw", "char", 5),
    ("Raw + Word-2gram", "raw_words", "word", 2),
    ("Processed + Char-5gram", "processed", "char", 5),
    ("Processed + Word-1gram", "processed", "word", 1),
    ("Processed + Word-2gram", "processed", "word", 2),
    ("Processed + Word-3gram", "processed", "word", 3),
)
SIGNATURE_SIZES = (16, 32, 64, 128, 256, 512)
FALSE_MERGE_COST = 500
#: Pairs with the same first notice that one task compares.
PAIR_BLOCK = 256


def shingle_sets(notices: DataFrame, cleaner: str, unit: str, n: int) -> DataFrame:
    """Shingle sets as 60-bit hashes: half the bytes of the strings in the shuffle, same set sizes."""
    cleaned = lsh.clean(notices, cleaner)
    if unit == "word":
        hashed = minhash.ngram_hashes(F.col("clean"), n)
    else:
        hashed = F.transform(text.char_ngrams(F.col("clean"), n), minhash.hash60)
    return cleaned.select("notice_id", hashed.alias("shingles"))


def score_pairs(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Exact Jaccard of each pair, with the integers it is made of."""
    both = lsh.pair_features(pairs, sets, ["shingles"])
    counted = both.withColumns(
        {
            "shared": minhash.overlap(F.col("shingles_a"), F.col("shingles_b")),
            "size_a": F.size("shingles_a"),
            "size_b": F.size("shingles_b"),
        }
    ).drop("shingles_a", "shingles_b")
    return with_jaccard(counted)


def with_jaccard(counted: DataFrame) -> DataFrame:
    """The score of pairs whose shared shingles and set sizes are counted."""
    union = F.col("size_a") + F.col("size_b") - F.col("shared")
    empty = (F.col("size_a") == 0) | (F.col("size_b") == 0)
    return counted.withColumn("united", union).withColumn(
        "jaccard", F.when(empty, F.lit(0.0)).otherwise(F.col("shared") / F.col("united"))
    )


def class_stats(scored: DataFrame) -> DataFrame:
    """Pairs, lowest, mean and highest score per label."""
    return scored.groupBy("label").agg(
        F.count("*").alias("pairs"),
        F.min("jaccard").alias("min_jaccard"),
        F.round(F.avg("jaccard"), 6).alias("mean_jaccard"),
        F.max("jaccard").alias("max_jaccard"),
    )


def _passed_level():
    return F.when(F.col("united") > 0, F.expr("(100 * shared) div united")).otherwise(0).cast("int")


def threshold_sweep(scored: DataFrame) -> DataFrame:
    """Precision, recall, F1 and cost at the thresholds 0.01 to 0.99.

    A pair passes every threshold up to floor(100 * score), so pairs are first counted per passed level; only
    those at most 101 counts per label are compared with the 99 thresholds.
    """
    is_same = F.col("label") == "same"
    levels = scored.groupBy(_passed_level().alias("level")).agg(
        F.count_if(is_same).alias("same"), F.count_if(~is_same).alias("different")
    )
    steps = levels.select("*", F.explode(F.sequence(F.lit(1), F.lit(99))).alias("step"))
    passes = F.col("level") >= F.col("step")
    counts = steps.groupBy("step").agg(
        F.sum(F.when(passes, F.col("same")).otherwise(0)).alias("tp"),
        F.sum(F.when(passes, F.col("different")).otherwise(0)).alias("fp"),
        F.sum(F.when(passes, 0).otherwise(F.col("same"))).alias("fn"),
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.select(
        (F.col("step") / 100).alias("threshold"),
        "tp",
        "fp",
        "fn",
        F.when(tp + fp > 0, tp / (tp + fp)).otherwise(0.0).alias("precision"),
        F.when(tp + fn > 0, tp / (tp + fn)).otherwise(0.0).alias("recall"),
        F.when(tp > 0, 2 * tp / (2 * tp + fp + fn)).otherwise(0.0).alias("f1"),
        (FALSE_MERGE_COST * fp + fn).alias("cost"),
    )


def best_f1(sweep: DataFrame) -> DataFrame:
    """The lowest threshold with the best F1."""
    return sweep.orderBy(F.col("f1").desc(), "threshold").limit(1).select("threshold", "f1")


def operating_point(sweep: DataFrame) -> DataFrame:
    """The lowest threshold of least cost when a false merge costs 500 missed ones."""
    return sweep.orderBy("cost", "threshold").limit(1)


def compare_representations(notices: DataFrame, pairs: DataFrame) -> DataFrame:
    """One row per representation: set size, score ranges per class, best F1.

    The texts of a pair are brought together once, and their sets made there: a set of hashes is up to eight times as long as its
    text, and there would be one per representation. A notice that is first in very many pairs meets them in blocks.
    """
    title, body = F.col("title"), F.col("body")
    cleaned = notices.select("notice_id", text.raw_text(title, body).alias("raw"), text.processed_text(title, body).alias("processed"))
    blocks = pairs.groupBy("id_a").agg(F.ceil(F.count("*") / PAIR_BLOCK).alias("blocks"))
    firsts = cleaned.toDF("id_a", "raw_a", "processed_a").join(blocks, "id_a")
    firsts = firsts.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).drop("blocks")
    dealt = pairs.join(blocks, "id_a").withColumn("block", F.pmod(F.xxhash64("id_b"), F.col("blocks"))).drop("blocks")
    both = dealt.join(cleaned.toDF("id_b", "raw_b", "processed_b"), "id_b").join(firsts, ["id_a", "block"])

    def end(how, of):
        return text.single_blanks(F.col(f"raw_{of}")) if how == "raw_words" else F.col(f"{how}_{of}")

    shared = minhash.shared_ngrams([(end(how, "a"), end(how, "b"), unit, n) for _, how, unit, n in REPRESENTATIONS])
    found = both.select("label", shared.alias("found")).select("label", F.posexplode("found").alias("at", "s"))
    scored = with_jaccard(found.select("label", "at", "s.*"))
    return _compared(scored, F.array(*[F.lit(name) for name, *_ in REPRESENTATIONS])[F.col("at")])


def _compared(scored, name):
    same = F.col("label") == "same"
    # One pass over the pairs: a small table per level carries both the class ranges and the sweep.
    levels = scored.groupBy("at", _passed_level().alias("level")).agg(
        F.count_if(same).alias("same"),
        F.count_if(~same).alias("different"),
        F.sum(F.when(same, F.col("jaccard"))).alias("same_sum"),
        F.sum(F.when(~same, F.col("jaccard"))).alias("different_sum"),
        F.min(F.when(same, F.col("jaccard"))).alias("same_min"),
        F.max(F.when(~same, F.col("jaccard"))).alias("different_max"),
        F.sum(F.col("size_a") + F.col("size_b")).alias("shingles"),
    )
    steps = levels.select("*", F.explode(F.sequence(F.lit(1), F.lit(99))).alias("step"))
    passes = F.col("level") >= F.col("step")
    swept = steps.groupBy("at", "step").agg(
        F.sum(F.when(passes, F.col("same")).otherwise(0)).alias("tp"),
        F.sum(F.when(passes, F.col("different")).otherwise(0)).alias("fp"),
        F.sum("same").alias("same"),
        F.sum("different").alias("different"),
        F.sum("same_sum").alias("same_sum"),
        F.sum("different_sum").alias("different_sum"),
        F.min("same_min").alias("same_min"),
        F.max("different_max").alias("different_max"),
        F.sum("shingles").alias("shingles"),
    )
    tp, fp = F.col("tp"), F.col("fp")
    f1 = F.when(tp > 0, 2 * tp / (tp + fp + F.col("same"))).otherwise(0.0)
    # 99 rows of each representation.
    ranked = Window.partitionBy("at").orderBy(F.col("f1").desc(), "step")
    best = swept.withColumn("f1", f1).withColumn("rank", F.row_number().over(ranked)).where("rank = 1")
    return best.select(
        name.alias("representation"),
        F.round(F.col("shingles") / (2 * (F.col("same") + F.col("different"))), 6).alias("mean_shingles"),
        F.round(F.try_divide("same_sum", "same"), 6).alias("same_mean"),
        F.round(F.try_divide("different_sum", "different"), 6).alias("different_mean"),
        "different_max",
        "same_min",
        F.col("f1").alias("best_f1"),
        (F.col("step") / 100).alias("best_threshold"),
    )


def _below(k):
    return lambda position: position < k


def signature_error(notices: DataFrame, pairs: DataFrame, sizes=SIGNATURE_SIZES) -> DataFrame:
    """How far the MinHash estimate is from the exact score, for several signature lengths.

    One longest signature per notice; shorter ones are its beginnings.
    """
    longest = max(sizes)
    cleaned = lsh.clean(notices)
    hashed = F.transform(text.word_ngrams(F.col("clean"), 2), minhash.hash60)
    residues = F.transform("shingles", lambda h: (h % minhash.PRIME).cast("int"))
    features = (
        cleaned.select("notice_id", hashed.alias("shingles"))
        .withColumn("signature", minhash.signature(residues, longest))
        .where("signature is not null")
    )
    both = lsh.pair_features(pairs, features, ["shingles", "signature"])
    shared = minhash.overlap(F.col("shingles_a"), F.col("shingles_b"))
    exact = shared / (F.size("shingles_a") + F.size("shingles_b") - shared)
    # Positions that agree, once per pair; each length then only counts the positions below it.
    agree = F.transform(
        F.zip_with("signature_a", "signature_b", lambda x, y: x == y), lambda same, i: F.when(same, i).otherwise(longest)
    )
    rows = both.select(exact.alias("exact"), agree.alias("agree")).select(
        "exact",
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(k).alias("k"), F.size(F.filter("agree", _below(k))).alias("matches"))
                    for k in sizes
                ]
            )
        ).alias("m"),
    )
    s, error = F.col("exact"), F.col("m.matches") / F.col("m.k") - F.col("exact")
    return rows.groupBy(F.col("m.k").alias("k")).agg(
        F.count("*").alias("pairs"),
        F.round(F.avg(F.abs(error)), 6).alias("mae"),
        F.round(F.sqrt(F.avg(error * error)), 6).alias("rmse"),
        F.round(F.max(F.abs(error)), 6).alias("max_error"),
        F.round(F.avg(F.sqrt(s * (1 - s) / F.col("m.k"))), 6).alias("theoretical_se"),
    )


def retrieval_curve(scored: DataFrame, sketches: DataFrame, bands=lsh.BANDS, rows=lsh.ROWS) -> DataFrame:
    """Per tenth of similarity: share of pairs banding proposes, and the share theory expects."""
    both = lsh.pair_features(scored, sketches.select("notice_id", "buckets"), ["buckets"])
    found = F.arrays_overlap("buckets_a", "buckets_b")
    bin_no = F.when(F.col("united") > 0, F.expr("(10 * shared) div united")).otherwise(0).cast("int")
    expected = minhash.candidate_probability(F.col("jaccard"), bands, rows)
    return both.groupBy(bin_no.alias("score_bin")).agg(
        F.count("*").alias("pairs"),
        F.count_if(found).alias("retrieved"),
        F.round(F.avg(expected), 6).alias("expected_share"),
        # Whether the tenth begins at or above the similarity at which banding turns from missing to proposing.
        F.max((bin_no / 10 >= F.lit(minhash.banding_threshold(bands, rows))).cast("int")).alias("above_threshold"),
    )


def label_truth_mismatches(pairs: DataFrame, clusters: DataFrame) -> DataFrame:
    """Adjudicated pairs whose label disagrees with the truth clusters."""
    both = lsh.pair_features(pairs, clusters, ["cluster_id"])
    differs = (F.col("cluster_id_a") == F.col("cluster_id_b")) != (F.col("label") == "same")
    return both.agg(F.count("*").alias("pairs"), F.count_if(differs).alias("mismatches"))


def corpus_counts(notices: DataFrame, clusters: DataFrame) -> DataFrame:
    """Notices and distinct portals per archetype."""
    joined = notices.select("notice_id", "portal_id").join(clusters, "notice_id")
    return joined.groupBy("archetype").agg(
        F.count("*").alias("notices"), F.countDistinct("portal_id").alias("portals")
    )


def shared_values(notices: DataFrame, clusters: DataFrame, n=10) -> DataFrame:
    """The values most clusters have in common."""
    joined = notices.select("notice_id", "estimated_value").join(clusters, "notice_id")
    counts = joined.groupBy("estimated_value").agg(
        F.countDistinct("cluster_id").alias("clusters"), F.count("*").alias("notices")
    )
    return counts.orderBy(F.col("clusters").desc(), "estimated_value").limit(n)


def cluster_consistency(notices: DataFrame, clusters: DataFrame) -> DataFrame:
    """Clusters of several notices, and how many of them agree on one value.

    Lowest and highest value tell whether there are several, so no distinct set is kept per cluster.
    """
    joined = notices.select("notice_id", "estimated_value").join(clusters, "notice_id")
    per_value = joined.groupBy("cluster_id", "estimated_value").agg(F.count("*").alias("n"))
    sized = per_value.groupBy("cluster_id").agg(
        F.sum("n").alias("cluster_size"), F.count("estimated_value").alias("values")
    )
    return sized.where("cluster_size > 1").agg(
        F.count("*").alias("multi_clusters"),
        F.count_if(F.col("values") == 1).alias("one_value"),
        F.count_if(F.col("values") > 1).alias("several_values"),
    )


def first_per_archetype(notices: DataFrame, clusters: DataFrame) -> DataFrame:
    """The first notice of each archetype; one row per archetype and task reaches the shuffle."""
    joined = notices.select("notice_id", "portal_id").join(clusters, "notice_id")
    first = Window.partitionBy("archetype").orderBy("notice_id")
    ranked = joined.withColumn("rank", F.row_number().over(first)).where("rank = 1")
    return ranked.select("archetype", "notice_id", "portal_id", "cluster_id")


def cluster_members(notices: DataFrame, clusters: DataFrame, cluster_id=None) -> DataFrame:
    """Members of the clusters of several notices, or of one cluster, to be read in ``copy_index`` order."""
    if cluster_id is not None:
        clusters = clusters.where(F.col("cluster_id") == cluster_id)
    else:
        several = clusters.groupBy("cluster_id").count().where("count > 1")
        clusters = clusters.join(several, "cluster_id", "left_semi")
    return clusters.join(notices, "notice_id")


def portal_prefixes(notices: DataFrame) -> DataFrame:
    """Text all notices of a portal begin with: the common prefix of its lowest and highest body."""
    ends = notices.groupBy("portal_id").agg(
        F.count("*").alias("notices"), F.min("body").alias("lowest"), F.max("body").alias("highest")
    )
    prefix = text.common_prefix(F.col("lowest"), F.col("highest"))
    return ends.select("portal_id", "notices", F.length(prefix).alias("prefix_length"), prefix.alias("prefix"))


def pair_view(pairs: DataFrame, notices: DataFrame) -> DataFrame:
    """(id_a, id_b, part, side, words) of two notices next to each other, in reading order.

    The cleaned words of both are aligned along a longest common subsequence. A part is a stretch of words that is ``equal``, or
    found on the ``left`` or the ``right`` only; the left one comes first. Texts that are equal are one part; two empty texts have none.
    """
    cleaned = lsh.clean(notices, "naive").select("notice_id", F.col("clean").alias("text"))
    both = lsh.pair_features(pairs.select("id_a", "id_b"), cleaned, ["text"])
    schema = "id_a long, id_b long, part int, side string, words string"

    def viewed(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                id_a, id_b, left, right = (c[at].as_py() for c in batch.columns)
                parts = list(enumerate(alignment.parts(left.split(), right.split())))
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string())
                rows = [(id_a, id_b, n, side, " ".join(words)) for n, (side, words) in parts]
                values = list(zip(*rows)) or [[]] * 5
                names = ["id_a", "id_b", "part", "side", "words"]
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names)

    return both.select("id_a", "id_b", "text_a", "text_b").mapInArrow(viewed, schema)

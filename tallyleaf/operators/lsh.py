"""Sketches, banded retrieval and its mitigations.

A sketch is one narrow row per notice: its bucket id in every band. Everything about buckets is computed from
sketches, never from texts. Bucket sizes are counted (pre-aggregated) before anything is joined on a bucket, and a
bucket is joined with itself in blocks. Buckets of every size take the same path.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyleaf.functions import minhash, text
from tallyleaf.operators.skew import meet, salted_join
from tallyleaf.session import cut_lineage

K, BANDS, ROWS = 128, 32, 4
DF_SHARE = 0.05
#: Frequent shingles up to which the list of them is handed to every set.
FREQUENT = 1 << 12
BUCKET = ("band_id", "bucket_id")


def clean(notices: DataFrame, how="processed") -> DataFrame:
    """Notices with their text reduced to words, title included."""
    cleaner = {"raw": text.raw_text, "raw_words": text.raw_words, "naive": text.naive_text, "processed": text.processed_text}[how]
    kept = [c for c in notices.columns if c not in ("title", "body")]
    return notices.select(*kept, cleaner(F.col("title"), F.col("body")).alias("clean"))


def word_shingles(cleaned: DataFrame, n=2) -> DataFrame:
    return cleaned.withColumn("shingles", text.word_ngrams(F.col("clean"), n))


def frequent_shingles(shingled: DataFrame, share=DF_SHARE) -> DataFrame:
    """Shingles in more than ``share`` of the notices.

    There are at most (mean shingles per notice) / share of them, whatever the number of notices.
    """
    limit = shingled.agg(F.floor(F.count("*") * F.lit(share)).alias("limit"))
    return document_frequency(shingled).where(F.col("df") > limit.scalar())


def document_frequency(shingled: DataFrame) -> DataFrame:
    """Notices per shingle; counted on the map side first, so a shingle of every notice is one row per task."""
    return shingled.select(F.explode("shingles").alias("shingle")).groupBy("shingle").agg(F.count("*").alias("df"))


def prune_frequent(shingled: DataFrame, share=DF_SHARE) -> DataFrame:
    """Shingle sets without the frequent ones; a set that loses all is empty, as is that of a notice without an id.

    A list of up to FREQUENT of them goes to the sets, which stay where they are. Where there are more, the shingles are listed, the
    frequent ones taken out by a salted anti-join, and what is left put together per notice: so neither the list of frequent
    shingles nor a hot one has to fit into one task.
    """
    frequent = cut_lineage(frequent_shingles(shingled, share).select("shingle"))
    none = F.array().cast(shingled.schema["shingles"].dataType)
    if frequent.count() <= FREQUENT:
        taken = frequent.agg(F.collect_list("shingle").alias("taken")).scalar()
        left = F.when(F.col("notice_id").isNotNull(), F.array_except("shingles", taken)).otherwise(none)
        return shingled.withColumn("shingles", left)
    listed = shingled.select("notice_id", F.explode("shingles").alias("shingle"))
    kept = salted_join(listed, frequent, ["shingle"], ["notice_id"], "left_anti")
    sets = kept.groupBy("notice_id").agg(F.collect_list("shingle").alias("left"))
    return shingled.drop("shingles").join(sets, "notice_id", "left").withColumn("shingles", F.coalesce("left", none)).drop("left")


def hashed(shingled: DataFrame) -> DataFrame:
    """The shingles as 60-bit hashes, for sets that are handed from step to step."""
    kept = [c for c in shingled.columns if c not in ("clean", "shingles")]
    return shingled.select(*kept, F.transform("shingles", minhash.hash60).alias("shingles"))


def signed(shingled: DataFrame, k=K) -> DataFrame:
    """The signature of every notice. Notices without a shingle resemble nothing and are left out.

    They are recognised by their missing signature: a condition on the shingles would be pushed below them and
    have every text cleaned and cut a second time.
    """
    kept = [c for c in shingled.columns if c not in ("clean", "shingles")]
    if shingled.schema["shingles"].dataType.elementType.typeName() == "string":
        residues = minhash.shingle_hashes(F.col("shingles"))
    else:
        residues = F.transform("shingles", lambda h: (h % minhash.PRIME).cast("int"))
    rows = shingled.select(*kept, residues.alias("hashes"))
    found = rows.withColumn("signature", minhash.signature(F.col("hashes"), k)).where("signature is not null")
    return found.select(*kept, "signature")


def banded(signatures: DataFrame, bands=BANDS, rows=ROWS) -> DataFrame:
    """One row of bucket ids per notice, from its signature."""
    kept = [c for c in signatures.columns if c != "signature"]
    return signatures.select(*kept, minhash.band_buckets(F.col("signature"), bands, rows).alias("buckets"))


def sketch(shingled: DataFrame, k=K, bands=BANDS, rows=ROWS) -> DataFrame:
    """One row of bucket ids per notice that has a shingle."""
    return banded(signed(shingled, k), bands, rows)


def text_sketch(cleaned: DataFrame, n=2, k=K, bands=BANDS, rows=ROWS) -> DataFrame:
    """``sketch`` of the word n-grams of cleaned texts, which are hashed and signed in one pass."""
    kept = [c for c in cleaned.columns if c != "clean"]
    found = cleaned.select(*kept, minhash.ngram_signature(F.col("clean"), n, k).alias("signature"))
    return banded(found.where("signature is not null"), bands, rows)


def postings(sketches: DataFrame) -> DataFrame:
    """One row per notice and band.

    Buckets are never empty; the outer form keeps Spark from adding a condition that computes them twice.
    """
    kept = [c for c in sketches.columns if c != "buckets"]
    return sketches.select(*kept, F.posexplode_outer("buckets").alias("band_id", "bucket_id"))


def bucket_sizes(posted: DataFrame, within=BUCKET) -> DataFrame:
    """Notices per bucket, counted on the map side first."""
    return posted.groupBy(*within).agg(F.count("*").alias("bucket_size"))


def pairs_among(n):
    """Pairs among ``n`` rows; decimal, as the square of a large count leaves 64 bits."""
    return F.floor(n.cast("decimal(19,0)") * (n - 1).cast("decimal(19,0)") / 2)


def bucket_stats(sizes: DataFrame) -> DataFrame:
    """Buckets, buckets of several notices, largest bucket, and the pairs all buckets together would give."""
    n = F.col("bucket_size")
    return sizes.agg(
        F.count("*").alias("buckets"),
        F.count_if(n > 1).alias("multi_buckets"),
        F.coalesce(F.max(n), F.lit(0)).alias("max_bucket_size"),
        F.coalesce(F.sum(pairs_among(n)), F.lit(0)).cast("long").alias("bucket_pairs"),
    )


def work_per_notice(posted: DataFrame, sizes: DataFrame) -> DataFrame:
    """Comparisons per notice, summed over its buckets; notices that meet nobody are left out."""
    met = salted_join(posted, sizes.where("bucket_size > 1"), BUCKET, ["notice_id"])
    return met.groupBy("notice_id").agg(F.sum(F.col("bucket_size") - 1).alias("work"))


def work_percentiles(work: DataFrame) -> DataFrame:
    """Exact percentiles of work by rank selection; a percentile between two ranks is interpolated.

    The histogram of work is dealt by ranges. Each range counts its notices, the counts before a range are summed over
    ranges, and each range then knows the ranks of its own values, so no task sees the values of all.
    """
    histogram = work.groupBy("work").agg(F.count("*").alias("notices"))
    count = int(work.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = histogram.repartitionByRange(count, "work").withColumn("part", F.spark_partition_id())
    dealt = cut_lineage(dealt)
    totals = dealt.groupBy("part").agg(F.sum("notices").alias("total"), F.max("work").alias("most"))
    # As many rows as there are ranges.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("offset"))
    upto = F.sum("notices").over(Window.partitionBy("part").orderBy("work")) + F.col("offset")
    ranked = dealt.join(offsets, "part").withColumn("upto", upto)
    whole = totals.agg(F.coalesce(F.sum("total"), F.lit(0)).alias("n")).scalar()
    selected, named = [], []
    for p, name in _POINTS:
        rank = F.lit(p) * (whole - 1)
        # The value at a rank is the least one that more notices do not exceed.
        for end, at in (("low", F.floor(rank)), ("high", F.ceil(rank))):
            selected.append(F.min(F.when(F.col("upto") > at, F.col("work"))).alias(f"{name}_{end}"))
        low, high = F.col(f"{name}_low"), F.col(f"{name}_high")
        named.append(F.round(low + (high - low) * (rank - F.floor(rank)), 6).alias(name))
    found = ranked.agg(*selected, F.coalesce(F.sum("notices"), F.lit(0)).alias("notices"), F.max("work").cast("double").alias("max_work"))
    return found.select("notices", *named, "max_work").na.fill(0.0)


_POINTS = ((0.5, "p50_work"), (0.9, "p90_work"), (0.99, "p99_work"), (0.999, "p999_work"))


def shared_postings(posted: DataFrame, sizes: DataFrame, within=BUCKET) -> DataFrame:
    """Postings of buckets that hold several notices, with ``key_rows``, the size of the bucket."""
    shared = sizes.where("bucket_size > 1").withColumnRenamed("bucket_size", "key_rows")
    return salted_join(posted.select(*within, "notice_id"), shared, within, ["notice_id"])


def distinct_shared(posted: DataFrame, within=BUCKET) -> DataFrame:
    """``shared_postings``, once per notice, without the buckets whose members are those of a bucket with a lower id.

    Notices that are alike share many buckets with the very same members, and one of them tells as much as all. Members are compared by
    their number, the lowest one and two sums of 64-bit hashes. Ids are unique across bands, so the band is left out.
    """
    key = [c for c in within if c != "band_id"]
    sums = [F.sum(F.xxhash64("notice_id", F.lit(i)).cast("decimal(20,0)")).alias(f"members_{i}") for i in (0, 1)]
    sized = posted.groupBy(*key).agg(F.count("*").alias("key_rows"), F.min("notice_id").alias("lowest"), *sums).where("key_rows > 1")
    members = [c for c in sized.columns if c != "bucket_id"]
    kept = sized.groupBy(*members).agg(F.min("bucket_id").alias("bucket_id")).select(*key, "key_rows")
    found = salted_join(posted.select(*key, "notice_id"), kept, key, ["notice_id"])
    return found.dropDuplicates([*key, "notice_id"])


def bucket_candidates(posted: DataFrame, sizes: DataFrame, within=BUCKET) -> DataFrame:
    """Distinct pairs that share a bucket: as many as there are, so quadratic in a large bucket."""
    shared = shared_postings(posted, sizes, within)
    met = meet(shared, shared, within, ["notice_id"], ["notice_id"]).where("notice_id_a < notice_id_b")
    return met.select(F.col("notice_id_a").alias("id_a"), F.col("notice_id_b").alias("id_b")).distinct()


def shared_sets(posted: DataFrame, sizes: DataFrame, within=BUCKET) -> DataFrame:
    """Per notice, the sorted ids of the buckets it shares with another. Ids are unique across bands."""
    return meetings(posted, sizes, within).drop("work")


def meetings(posted: DataFrame, sizes: DataFrame, within=BUCKET) -> DataFrame:
    """``shared_sets`` with the ``work`` of ``work_per_notice``, from one join with the sizes."""
    members = shared_postings(posted, sizes, within)
    return members.groupBy("notice_id").agg(
        F.sort_array(F.collect_list("bucket_id")).alias("buckets"), F.sum(F.col("key_rows") - 1).alias("work")
    )


def count_candidates(posted: DataFrame, sizes: DataFrame) -> DataFrame:
    """The exact number of distinct candidate pairs."""
    return count_pairs(shared_sets(posted, sizes))


def count_pairs(sets: DataFrame) -> DataFrame:
    """The number of distinct pairs among ``shared_sets`` that share a bucket.

    Notices with the same set of shared buckets are one pattern with a weight: patterns that meet contribute the product
    of their weights, counted under the first bucket they share. So copies cost nothing; patterns that differ within
    one bucket are met in blocks. Buckets with one pattern, and all but the lowest of those with the very same patterns, are left
    out before anything meets: the first bucket that two patterns share is none of them.
    """
    patterns = sets.groupBy("buckets").agg(F.count("*").alias("weight"), F.min("notice_id").alias("least"))
    # A pattern is named after a notice of its own, and the one of a notice without an id after no other.
    patterns = cut_lineage(patterns.select("buckets", "weight", F.coalesce("least", F.lit(-(1 << 63))).alias("pattern")))
    within = patterns.agg(F.sum(pairs_among(F.col("weight"))).alias("pairs"))
    listed = patterns.select("pattern", "weight", "buckets", F.explode(F.array_distinct("buckets")).alias("bucket_id"))
    # A notice that is there several times has a bucket as often.
    times = F.size(F.filter("buckets", lambda b: b == F.col("bucket_id")))
    listed = listed.select("pattern", "bucket_id", (F.col("weight") * times).alias("weight"))
    sums = [F.sum(F.xxhash64("pattern", F.lit(i)).cast("decimal(20,0)")).alias(f"patterns_{i}") for i in (0, 1)]
    several = listed.groupBy("bucket_id").agg(F.count("*").alias("key_rows"), F.min("pattern").alias("lowest"), *sums).where("key_rows > 1")
    kept = several.groupBy("key_rows", "lowest", "patterns_0", "patterns_1").agg(F.min("bucket_id").alias("bucket_id"))
    counted = cut_lineage(salted_join(listed, kept.select("bucket_id", "key_rows"), ["bucket_id"], ["pattern"]))
    held = counted.groupBy("pattern").agg(F.sort_array(F.collect_list("bucket_id")).alias("held"))
    full = counted.join(held, "pattern")
    met = meet(full, full, ["bucket_id"], ["pattern"], ["pattern", "weight", "held"]).where("pattern_a < pattern_b")
    first = F.array_min(F.array_intersect("held_a", "held_b")) == F.col("bucket_id")
    product = F.col("weight_a").cast("decimal(19,0)") * F.col("weight_b").cast("decimal(19,0)")
    total = within.unionByName(met.where(first).agg(F.sum(product).alias("pairs")))
    return total.agg(F.coalesce(F.sum("pairs"), F.lit(0)).cast("long").alias("unique_candidates"))


def probe(index: DataFrame, batch: DataFrame) -> DataFrame:
    """Stored notices that share a bucket with each incoming notice, and in how many bands.

    Bucket ids differ from band to band, so the join is on the id alone: an index bucketed by it stays where it is, and
    only the batch is shuffled.
    """
    asked = batch.select(F.col("notice_id").alias("incoming_id"), "bucket_id")
    hits = asked.join(index.select("notice_id", "bucket_id"), "bucket_id")
    return hits.groupBy("incoming_id", "notice_id").agg(F.count("*").alias("shared_bands"))


def pair_features(pairs: DataFrame, features: DataFrame, columns) -> DataFrame:
    """Attach the named columns for both ends of each pair, as ``<name>_a`` and ``<name>_b``.

    A notice in very many pairs makes one side skewed; adaptive execution splits that side.
    """
    for end in ("a", "b"):
        side = features.select(
            F.col("notice_id").alias(f"id_{end}"), *[F.col(c).alias(f"{c}_{end}") for c in columns]
        )
        pairs = pairs.join(side, f"id_{end}")
    return pairs


def recall(same_pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """Adjudicated duplicates that banding proposes. Bucket ids of the two notices are compared directly,
    so no candidate is listed."""
    ends = pair_features(same_pairs.select("id_a", "id_b"), sketches.select("notice_id", "buckets"), ["buckets"])
    return ends.agg(F.count_if(F.arrays_overlap("buckets_a", "buckets_b")).alias("hits"))


def within_cap(sizes: DataFrame, cap: int) -> DataFrame:
    """The buckets a cap would leave to the pair search: given to ``count_candidates``, ``work_per_notice`` and ``capped_sets``, they
    measure what it would save and miss. Results never come from it."""
    return sizes.where(F.col("bucket_size") <= cap)


def largest_bucket(sizes: DataFrame) -> DataFrame:
    """The bucket with most notices; ties go to the lowest band, then id."""
    return sizes.orderBy(F.col("bucket_size").desc(), "band_id", "bucket_id").limit(1)


def portals_of_largest(posted: DataFrame, sizes: DataFrame, n=10) -> DataFrame:
    """Which portals fill the largest bucket."""
    members = posted.join(largest_bucket(sizes), [*BUCKET])
    counts = members.groupBy("bucket_size", "portal_id").agg(F.count("*").alias("notices"))
    return counts.orderBy(F.col("notices").desc(), "portal_id").limit(n)


def winning_shingles(shingled: DataFrame, sketches: DataFrame, band_id: int, rows=ROWS) -> DataFrame:
    """For the members of a band's largest bucket: which shingle gave each minimum of the band.

    Each member's minima are found within its own row.
    """
    posted = postings(sketches.select("notice_id", "buckets")).where(F.col("band_id") == band_id)
    top = largest_bucket(bucket_sizes(posted))
    members = posted.join(top, [*BUCKET]).select("notice_id")
    family = minhash.hash_family((band_id + 1) * rows)[band_id * rows :]

    def winner(a, b):
        def scored(s):
            residue = (minhash.hash60(s) % minhash.PRIME).cast("bigint")
            return F.struct(((residue * a + b) % minhash.PRIME).alias("value"), s.alias("shingle"))

        return F.array_min(F.transform("shingles", scored))

    minima = F.array(*[winner(a, b) for a, b in family])
    won = shingled.join(members, "notice_id", "left_semi").select("notice_id", F.posexplode(minima).alias("at", "won"))
    return won.select(
        "notice_id", (F.col("at") + band_id * rows).alias("hash_no"), "won.shingle", F.col("won.value").alias("value")
    )

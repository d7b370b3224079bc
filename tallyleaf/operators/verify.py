"""Exact verification of candidate pairs: word-3-gram Jaccard and equal value."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyleaf.functions import minhash, pairs
from tallyleaf.operators import lsh
from tallyleaf.operators.skew import meet, salted_join
from tallyleaf.session import cut_lineage

THRESHOLD = 0.45
VALUE_BUCKET = ("estimated_value", "band_id", "bucket_id")
SHARED = ("estimated_value", "bucket_id")
TOKEN = ("estimated_value", "token")
#: Members up to which the pairs of a bucket are listed; the others are found over rare shingles.
LISTED = 1 << 14


TEXT = ("text_key", "estimated_value")


def features(notices: DataFrame, k=lsh.K, **banding) -> DataFrame:
    """All that is needed of a notice's text: (notice_id, estimated_value, text_key, sets, n, bits, buckets).

    ``text_key`` is a hash of the cleaned text, ``sets`` its ``n`` word-3-gram hashes and ``bits`` those in about a sixteenth of the bytes. Made in one pass over the texts; whoever uses
    it more than once writes it. A notice without a value matches nothing, as unknown is not equal to unknown, and is left
    out, as is one without a word.
    """
    cleaned = lsh.clean(notices.where(F.col("estimated_value").isNotNull()))
    made = minhash.ngram_features(F.col("clean"), 3, 2, k)
    kept = cleaned.select("notice_id", "estimated_value", F.md5("clean").alias("text_key"), made.alias("made"))
    found = kept.select("notice_id", *reversed(TEXT), "made.sets", F.size("made.sets").alias("n"), "made.bits", "made.signature").where("signature is not null")
    return lsh.banded(found, **banding)


def originals(known: DataFrame) -> DataFrame:
    """Of ``features`` one row per distinct (cleaned text, value), that of the lowest notice id, with the number of copies.

    However often a notice was copied, it enters the pair search once. Only the ids are written: whoever reads a few columns sends
    no others, and the sets are not written a second time.
    """
    firsts = cut_lineage(known.groupBy(*TEXT).agg(F.min("notice_id").alias("notice_id"), F.count("*").alias("copies")))
    return known.join(firsts.select("notice_id", "copies"), "notice_id")


def copies_of(known: DataFrame) -> DataFrame:
    """Every copy with the original it repeats, as (id_a = original, id_b = copy)."""
    keyed = known.select("notice_id", *TEXT)
    repeated = keyed.groupBy(*TEXT).agg(F.min("notice_id").alias("id_a"), F.count("*").alias("n")).where("n > 1")
    members = salted_join(keyed, repeated.drop("n"), TEXT, ["notice_id"])
    return members.where("notice_id > id_a").select("id_a", F.col("notice_id").alias("id_b"))


def verify(candidates: DataFrame, known: DataFrame, threshold=THRESHOLD) -> DataFrame:
    """The candidates that reach the threshold, with their exact score. Only sets of notices in a candidate pair travel."""
    ids = candidates.select(F.col("id_a").alias("notice_id")).union(candidates.select("id_b")).distinct()
    wanted = known.join(ids, "notice_id", "left_semi").select("notice_id", "sets")
    both = lsh.pair_features(candidates, wanted, ["sets"])
    scored = both.select("id_a", "id_b", minhash.jaccard(F.col("sets_a"), F.col("sets_b")).alias("jaccard"))
    return scored.where(F.col("jaccard") >= threshold)


def may_be_pairs(candidates: DataFrame, known: DataFrame, threshold=THRESHOLD) -> DataFrame:
    """The candidates that the bits of their sets do not rule out, written once."""
    both = lsh.pair_features(candidates, known.select("notice_id", "n", "bits"), ["n", "bits"])
    reach = pairs.bits_may_reach(F.col("n_a"), F.col("bits_a"), F.col("n_b"), F.col("bits_b"), threshold)
    return cut_lineage(both.where(reach).select("id_a", "id_b").distinct())


def prefix_tokens(known: DataFrame, members: DataFrame, threshold=THRESHOLD) -> DataFrame:
    """The rarest shingles of each member, as many as it takes for any two sets that reach the threshold to share one.

    With a set of n shingles that is n - ceil(threshold * n) + 1 of them, rarest first. Proof: two sets that reach the
    threshold share at least ceil(threshold * n) shingles for the n of either. Leaving out the others, ceil(threshold
    * n) - 1 of each, cannot leave out all shared ones, and as both are in the same order, the rarest shared one is kept
    on both sides. Shingles only one member has are the rarest: they are never joined, only counted as kept. ``key_rows``
    is the frequency.
    """
    sets = known.join(members.select("notice_id"), "notice_id", "left_semi")
    tokens = sets.select("notice_id", "estimated_value", F.size("sets").alias("n"), F.explode("sets").alias("token"))
    frequency = tokens.groupBy(*TOKEN).agg(F.count("*").alias("df")).where("df > 1")
    ranked = salted_join(tokens, frequency, TOKEN, ["notice_id"])
    per_notice = ranked.groupBy("notice_id", "estimated_value", "n").agg(
        F.sort_array(F.collect_list(F.struct("df", "token"))).alias("rarest")
    )
    alone = F.col("n") - F.size("rarest")
    keep = F.greatest(F.col("n") - F.ceil(F.col("n") * F.lit(threshold) - 1e-9) + 1 - alone, F.lit(0)).cast("int")
    kept = per_notice.select("notice_id", "estimated_value", "n", F.explode(F.slice("rarest", F.lit(1), keep)).alias("r"))
    return kept.select("notice_id", "estimated_value", "n", F.col("r.token").alias("token"), F.col("r.df").alias("key_rows"))


def heads(known: DataFrame, threshold=THRESHOLD) -> DataFrame:
    """(notice_id, estimated_value, n, head): the size of each set, and its n - ceil(threshold * n) + 1 lowest hashes, ascending."""
    n = F.size("sets")
    keep = n - F.ceil(n * F.lit(threshold) - 1e-9).cast("int") + 1
    head = F.slice(F.sort_array("sets"), F.lit(1), F.greatest(keep, F.lit(1)))
    return known.select("notice_id", "estimated_value", n.alias("n"), head.alias("head"))


def may_reach(threshold=THRESHOLD):
    """Whether two sets may reach the threshold, by their ``heads`` (``n_a``, ``head_a``, ``n_b``, ``head_b``); false only for those that do not.

    Up to the end of the head that ends first all hashes of both sets are known; beyond it they share no more than that set has
    left. Heads are a part of the sets, so less travels to compare most pairs than with the sets.
    """
    rest = [F.col(f"n_{e}") - F.size(f"head_{e}") for e in "ab"]
    first = F.element_at("head_a", -1) <= F.element_at("head_b", -1)
    most = minhash.overlap(F.col("head_a"), F.col("head_b")) + F.when(first, rest[0]).otherwise(rest[1])
    shorter, longer = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")
    close = shorter >= longer * F.lit(threshold) - 1e-6
    return close & (most * F.lit(1 + threshold) >= (F.col("n_a") + F.col("n_b")) * F.lit(threshold) - 1e-6)


def token_candidates(known, sets, threshold=THRESHOLD, components=None) -> DataFrame:
    """Pairs that share a bucket, have an equal value and can reach the threshold, found over shared rare shingles.

    ``sets`` holds each notice's shared buckets. The pairs of a bucket are never listed, and none is missed that would
    be verified. With ``components`` (notice_id, component), pairs already connected are not looked for: under each
    shingle the members of its biggest component are only met by the others.
    """
    tokens = prefix_tokens(known, sets, threshold).join(sets, "notice_id")
    if components is None:
        tokens = tokens.withColumn("component", F.col("notice_id"))
        met_by = tokens
    else:
        tokens = tokens.join(components, "notice_id", "left").withColumn(
            "component", F.coalesce("component", F.col("notice_id").cast(components.schema["component"].dataType))
        )
        counted = tokens.groupBy(*TOKEN, "component").agg(F.count("*").alias("n_members"))
        biggest = counted.groupBy(*TOKEN).agg(F.max(F.struct("n_members", "component")).alias("big"))
        biggest = biggest.select(*TOKEN, F.col("big.component").alias("biggest"))
        met_by = salted_join(tokens, biggest, TOKEN, ["notice_id"]).where("component <> biggest").drop("biggest")
    shorter, longer = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")
    met = meet(met_by, tokens, TOKEN, ["notice_id"], ["notice_id", "n", "buckets", "component"])
    met = met.where(F.col("component_a") != F.col("component_b")).where(shorter >= longer * F.lit(threshold))
    return met.where(F.arrays_overlap("buckets_a", "buckets_b")).select(
        F.least("notice_id_a", "notice_id_b").alias("id_a"), F.greatest("notice_id_a", "notice_id_b").alias("id_b")
    ).distinct()


#: Rows of a bucket that meet in one group.
BLOCK = 1 << 10


def _dealt(rows: DataFrame, columns) -> DataFrame:
    """``rows`` of buckets by group: each pair of blocks of a bucket is one, and a bucket of one block a group of its own."""
    blocks = F.ceil(F.col("key_rows") / BLOCK)
    own, each = F.pmod(F.xxhash64("notice_id"), blocks), F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1))
    sent = rows.select(*SHARED, own.alias("own"), each.alias("each"), *columns)
    sent = sent.select(*SHARED, F.least("own", "each").alias("low"), F.greatest("own", "each").alias("high"), "own", *columns)
    return sent.repartition(*SHARED, "low", "high").sortWithinPartitions(*pairs.GROUP, "own")


def bucket_pairs(known: DataFrame, shared: DataFrame, threshold=THRESHOLD, components=None) -> DataFrame:
    """(id_a, id_b, jaccard) of all pairs that share a bucket, have an equal value and reach the threshold.

    ``shared`` are the postings of ``lsh.distinct_shared``. The members of a bucket meet in blocks, twice: first by the bits of their
    sets, which rule out most pairs and none that reaches the threshold; then, with their sets, those that are left. So a set travels only
    where it is in a pair, and a pair is compared in the first bucket it shares. Buckets of more than LISTED
    members go through ``token_candidates``. With ``components`` (notice_id, component), pairs already connected are not looked for:
    the members of a bucket's biggest component are only met by the others.
    """
    small = shared.where(F.col("key_rows") <= LISTED)
    if components is None:
        small = small.withColumn("component", F.col("notice_id")).withColumn("outside", F.lit(True))
    else:
        labelled = small.join(components, "notice_id", "left").withColumn("component", F.coalesce("component", "notice_id"))
        counted = labelled.groupBy(*SHARED, "component").agg(F.count("*").alias("n"))
        parts = counted.groupBy(*SHARED).agg(F.count("*").alias("parts"), F.max(F.struct("n", "component"))["component"].alias("biggest"))
        small = salted_join(labelled, parts.where("parts > 1").drop("parts"), SHARED, ["notice_id"])
        small = small.withColumn("outside", F.col("component") != F.col("biggest")).drop("biggest")
    small = cut_lineage(small)
    held = small.groupBy("notice_id").agg(F.sort_array(F.collect_list("bucket_id")).alias("buckets"))
    row, sketch = ["notice_id", "component", "outside", "buckets"], ["n", "bits"]
    bits = known.select("notice_id", "n", "bits")
    first = _dealt(small.join(held, "notice_id").join(bits, "notice_id"), [*row, *sketch])
    schema = first.select(*SHARED, *row).schema
    ends = first.mapInArrow(pairs.ends_of_pairs([*SHARED, *row], threshold), schema).dropDuplicates([*SHARED, "notice_id"])
    ends = cut_lineage(ends)
    left = salted_join(ends, ends.groupBy(*SHARED).agg(F.count("*").alias("key_rows")), SHARED, ["notice_id"])
    wanted = known.join(ends.select("notice_id").distinct(), "notice_id", "left_semi")
    full = left.join(wanted.select("notice_id", "n", "bits", "sets"), "notice_id")
    last = _dealt(full, [*row, *sketch, "sets"])
    found = last.mapInArrow(pairs.similar_pairs(threshold), "id_a long, id_b long, jaccard double")
    large = shared.where(F.col("key_rows") > LISTED)
    if large.isEmpty():
        return found
    found = cut_lineage(found)
    sets = cut_lineage(large.groupBy("notice_id").agg(F.sort_array(F.collect_list("bucket_id")).alias("buckets")))
    others = verify(token_candidates(known, sets, threshold, components), known, threshold)
    return found.unionByName(others.join(found.select("id_a", "id_b"), ["id_a", "id_b"], "left_anti"))


def verified_pairs(notices: DataFrame, threshold=THRESHOLD, **banding) -> DataFrame:
    """All verified pairs of originals: same bucket in some band, equal value, Jaccard at the threshold.

    The value is part of the bucket key, not a filter on pairs. Buckets of every size are searched.
    """
    return original_pairs(originals(cut_lineage(features(notices, **banding))), threshold)


def original_pairs(firsts: DataFrame, threshold=THRESHOLD) -> DataFrame:
    """Verified pairs among ``originals``."""
    posted = lsh.postings(firsts.select("notice_id", "estimated_value", "buckets"))
    return bucket_pairs(firsts, cut_lineage(lsh.distinct_shared(posted, VALUE_BUCKET)), threshold)


def verified_classes(notices: DataFrame, threshold=THRESHOLD, **banding) -> DataFrame:
    """(notice_id, class_id, class_size, n_links) for every notice.

    A class holds the copies of one cleaned text and value, under its lowest notice id; every two of them are a verified pair, and
    a verified pair of originals stands for all pairs between their classes. So ``n_links`` counts every verified pair of a
    notice, copies included, though only pairs of originals are looked for. A notice without a value or a text is alone.
    """
    known = cut_lineage(features(notices, **banding))
    firsts = originals(known)
    sized = firsts.select(*TEXT, F.col("notice_id").alias("class_id"), F.col("copies").alias("class_size"))
    classed = salted_join(known.select("notice_id", *TEXT), sized, TEXT, ["notice_id"])
    members = notices.select("notice_id").join(classed, "notice_id", "left")
    both = F.array(F.struct("id_a", "id_b"), F.struct(F.col("id_b").alias("id_a"), F.col("id_a").alias("id_b")))
    ends = cut_lineage(original_pairs(firsts, threshold).select(F.explode(both).alias("ends")).select("ends.*"))
    other = sized.select(F.col("class_id").alias("id_b"), "class_size")
    linked = salted_join(ends, other, ["id_b"], ["id_a"]).groupBy(F.col("id_a").alias("class_id")).agg(F.sum("class_size").alias("others"))
    counted = salted_join(members, linked, ["class_id"], ["notice_id"], "left")
    size = F.coalesce("class_size", F.lit(1))
    return counted.select(
        "notice_id",
        F.coalesce("class_id", "notice_id").alias("class_id"),
        size.cast("long").alias("class_size"),
        (size - 1 + F.coalesce("others", F.lit(0))).cast("long").alias("n_links"),
    )

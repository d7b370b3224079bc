"""Weekly notices as a stream: every run places its batch among the stored sketches and keeps the card ids of earlier runs.

The store holds, each in a folder per run: ``originals`` (one sketch per distinct text and value), ``members`` (notice to the
card it got), ``cards`` (card and run of its creation), ``redirects`` (cards that merged away in the run) and ``merged`` (every
card that ever merged away, with the one that stands for it now). No text is stored. A run reads what lies below its number and
writes its own folders, so a run that was lost is repeated as it was.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyleaf.functions import minhash
from tallyleaf.operators import cards, lsh, verify
from tallyleaf.operators.skew import meet, salted_join
from tallyleaf.session import cut_lineage

TABLES = {
    "originals": "notice_id long, estimated_value string, text_key string, sets array<long>, buckets array<long>",
    "members": "notice_id long, card_id string",
    "cards": "card_id string, created_at int",
    "redirects": "old_card_id string, canonical_card_id string",
    "merged": "old_card_id string, canonical_card_id string",
}
TEXT = verify.TEXT


def create_store(spark, store: str) -> None:
    """The folders of a store; nothing changes where they exist."""
    for name, schema in TABLES.items():
        spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{store}/{name}/run=-1")


def stored(spark, store: str, name: str, before: int) -> DataFrame:
    """What the runs below a number have written."""
    rows = spark.read.schema(f"{TABLES[name]}, run int").parquet(f"{store}/{name}")
    return rows.where(F.col("run") < before)


def _write(rows, store, name, run):
    path = f"{store}/{name}/run={run}"
    rows.write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.schema(TABLES[name]).parquet(path)


def members_before(spark, store: str, run: int) -> DataFrame:
    """(notice_id, card_id) of all earlier runs, under the cards that stand today."""
    merged = stored(spark, store, "merged", run).where(F.col("run") == run - 1).drop("run")
    got = stored(spark, store, "members", run).select("notice_id", F.col("card_id").alias("old_card_id"))
    now = salted_join(got, merged, ["old_card_id"], ["notice_id"], "left")
    return now.select("notice_id", F.coalesce("canonical_card_id", "old_card_id").alias("card_id"))


def _originals(incoming, known):
    """(incoming notice, original) and the originals that are new: one per text and value that no earlier run has."""
    firsts = incoming.groupBy(*TEXT).agg(F.min("notice_id").alias("first"))
    seen = known.select(*TEXT, F.col("notice_id").alias("seen"))
    named = cut_lineage(firsts.join(seen, [*TEXT], "left"))
    copies = salted_join(
        incoming.select("notice_id", *TEXT), named.select(*TEXT, F.coalesce("seen", "first").alias("original")), TEXT, ["notice_id"]
    )
    fresh = named.where("seen is null").select(F.col("first").alias("notice_id"))
    return copies.select("notice_id", "original"), incoming.join(fresh, "notice_id", "left_semi")


def _verified(pairs, features, threshold):
    """Of the pairs those that share a bucket and reach the threshold. Only originals that occur in a pair are read."""
    ends = pairs.select(F.col("id_a").alias("notice_id")).union(pairs.select("id_b")).distinct()
    known = features.join(ends, "notice_id", "left_semi").select("notice_id", "sets", "buckets")
    both = lsh.pair_features(pairs, known, ["sets", "buckets"]).where(F.arrays_overlap("buckets_a", "buckets_b"))
    found = both.where(minhash.jaccard(F.col("sets_a"), F.col("sets_b")) >= threshold)
    return cut_lineage(found.select("id_a", "id_b"))


def _shared(fresh, known):
    """The buckets that a new original shares with another one, stored or new: all members of each, as ``lsh.distinct_shared`` gives them."""
    within = verify.VALUE_BUCKET
    asked = lsh.postings(fresh.select("notice_id", "estimated_value", "buckets"))
    there = lsh.postings(known.select("notice_id", "estimated_value", "buckets"))
    met = there.join(asked.select(*within).distinct(), [*within], "left_semi").unionByName(asked)
    return cut_lineage(lsh.distinct_shared(met, within))


def _stars(shared, fresh):
    """Each new original with the lowest one of each of its buckets, stored or new."""
    within = verify.SHARED
    lowest = shared.groupBy(*within).agg(F.min("notice_id").alias("lowest"))
    asked = shared.join(fresh.select("notice_id"), "notice_id", "left_semi")
    stars = salted_join(asked, lowest, within, ["notice_id"]).where("notice_id <> lowest")
    return stars.select(F.col("lowest").alias("id_a"), F.col("notice_id").alias("id_b")).distinct()


def _across(shared, heads, features, labels, threshold):
    """Pairs with a new original that share a bucket, lie in different components and may reach the threshold.

    ``labels`` is (notice_id, component, is_new). Under each bucket the members of its biggest component meet only the others, in
    blocks, and a pair is compared in the first bucket it shares; pairs of two stored originals were looked at in earlier runs.
    Buckets of more than ``verify.LISTED`` members go through ``verify.token_candidates``.
    """
    within, own = verify.SHARED, ["notice_id", "estimated_value"]
    small = shared.where(F.col("key_rows") <= verify.LISTED).join(labels, "notice_id")
    counted = small.groupBy(*within, "component").agg(F.count("*").alias("rows"))
    most = F.max(F.struct("rows", "component"))["component"].alias("biggest")
    parts = counted.groupBy(*within).agg(F.count("*").alias("parts"), most).where("parts > 1").drop("parts")
    small = salted_join(small, parts, within, ["notice_id"])
    small = cut_lineage(small.withColumn("outside", F.col("component") != F.col("biggest")).drop("biggest"))
    held = small.groupBy(*own).agg(F.sort_array(F.collect_list("bucket_id")).alias("buckets"))
    full = small.join(held.join(heads, own), own)
    met = meet(full.where("outside"), full, within, ["notice_id"], ["notice_id", "component", "is_new", "outside", "buckets", "n", "head"])
    met = met.where("(is_new_a or is_new_b) and component_a <> component_b and (notice_id_a < notice_id_b or not outside_b)")
    met = met.where(F.array_min(F.array_intersect("buckets_a", "buckets_b")) == F.col("bucket_id"))
    ends = F.least("notice_id_a", "notice_id_b").alias("id_a"), F.greatest("notice_id_a", "notice_id_b").alias("id_b")
    found = met.where(verify.may_reach(threshold)).select(*ends).distinct()
    large = shared.where(F.col("key_rows") > verify.LISTED)
    if large.isEmpty():
        return found
    sets = cut_lineage(large.groupBy("notice_id").agg(F.sort_array(F.collect_list("bucket_id")).alias("buckets")))
    others = verify.token_candidates(features, sets, threshold, labels.drop("is_new"))
    new = labels.where("is_new").select("notice_id")
    either = [others.join(new.withColumnRenamed("notice_id", end), end, "left_semi").select("id_a", "id_b") for end in ("id_a", "id_b")]
    return found.union(either[0]).union(either[1]).distinct()


def _nodes(links, members):
    """Links between cards: a stored notice stands for its card, a new one for the card it would get."""
    ends = links.select(F.col("id_a").alias("notice_id")).union(links.select("id_b")).distinct()
    members = cut_lineage(members.join(ends, "notice_id", "left_semi"))
    for end in ("id_a", "id_b"):
        card = members.select(F.col("notice_id").alias(end), "card_id")
        links = salted_join(links, card, [end], ["id_a", "id_b"], "left")
        links = links.withColumn(end, F.coalesce("card_id", cards.new_card_id(F.col(end)))).drop("card_id")
    return links.where("id_a <> id_b").distinct()


def run_cards(batch: DataFrame, run: int, store: str, threshold=verify.THRESHOLD, **banding) -> None:
    """Add a batch of notices: new members, cards and redirects.

    Cards are the components of verified pairs over all runs, found from the batch and the stored sketches alone: new texts meet
    stored ones in their buckets, and only their links are merged into the stored cards. A card keeps the oldest id
    of those that meet in it, and the others redirect to it. Notices stored already are not taken again.
    """
    spark = batch.sparkSession
    create_store(spark, store)
    members = cut_lineage(members_before(spark, store, run))
    batch = batch.join(members, "notice_id", "left_anti")
    known = stored(spark, store, "originals", run).drop("run")
    incoming = cut_lineage(verify.features(batch, **banding).drop("n", "bits"))
    copies, fresh = _originals(incoming, known)
    fresh = _write(fresh.select("notice_id", *reversed(TEXT), "sets", "buckets"), store, "originals", run)
    copies = cut_lineage(copies)

    features = known.unionByName(fresh)
    shared = _shared(fresh, known)
    # Cut before they are joined: the heads travel, not the sets.
    heads = cut_lineage(verify.heads(features, threshold).join(shared.select("notice_id").distinct(), "notice_id", "left_semi"))
    stars = lsh.pair_features(_stars(shared, fresh), heads, ["n", "head"]).where(verify.may_reach(threshold))
    near = _verified(cut_lineage(stars.select("id_a", "id_b").distinct()), features, threshold)
    labels = _labels(shared.select("notice_id").distinct(), _nodes(near, members), members)
    new = fresh.select("notice_id", F.lit(True).alias("is_new")).distinct()
    labels = cut_lineage(labels.join(new, "notice_id", "left").na.fill(False, ["is_new"]))
    found = _verified(cut_lineage(_across(shared, heads, features, labels, threshold)), features, threshold)
    again = copies.where("notice_id <> original").select(F.col("original").alias("id_a"), F.col("notice_id").alias("id_b"))
    links = _nodes(near.union(found).union(again), members)
    _merge(links, batch, members, run, store)


def _labels(notices, links, members):
    """The component of each of some originals so far: linked cards are one."""
    joined = cards.connected_components(links).withColumnRenamed("notice_id", "card_id")
    own = notices.join(members, "notice_id", "left")
    own = own.select("notice_id", F.coalesce("card_id", cards.new_card_id(F.col("notice_id"))).alias("card_id"))
    found = salted_join(own, joined, ["card_id"], ["notice_id"], "left")
    return cut_lineage(found.select("notice_id", F.coalesce("component", "card_id").alias("component")))


def _merge(links, batch, members, run, store):
    spark = batch.sparkSession
    grouped = cut_lineage(cards.connected_components(links).withColumnRenamed("notice_id", "card_id"))
    old = stored(spark, store, "cards", run).select("card_id", "created_at")
    oldest = grouped.join(old, "card_id").groupBy("component").agg(F.min(F.struct("created_at", "card_id"))["card_id"].alias("kept"))
    new = batch.select("notice_id", cards.new_card_id(F.col("notice_id")).alias("card_id"))
    placed = salted_join(new, grouped, ["card_id"], ["notice_id"], "left")
    placed = cut_lineage(placed.select("notice_id", F.coalesce("component", "card_id").alias("component")))
    lowest = placed.groupBy("component").agg(F.min("notice_id").alias("lowest"))
    named = lowest.join(oldest, "component", "left")
    named = named.select("component", F.coalesce("kept", cards.new_card_id(F.col("lowest"))).alias("card_id"), F.col("kept").isNull().alias("minted"))
    named = cut_lineage(named)
    _write(named.where("minted").select("card_id", F.lit(run).alias("created_at")), store, "cards", run)
    mine = salted_join(placed, named.drop("minted"), ["component"], ["notice_id"]).select("notice_id", "card_id")
    _write(mine, store, "members", run)
    gone = grouped.join(old, "card_id").join(oldest, "component").where("card_id <> kept")
    gone = _write(gone.select(F.col("card_id").alias("old_card_id"), F.col("kept").alias("canonical_card_id")), store, "redirects", run)
    before = stored(spark, store, "merged", run).where(F.col("run") == run - 1).drop("run")
    further = gone.select(F.col("old_card_id").alias("canonical_card_id"), F.col("canonical_card_id").alias("further"))
    moved = salted_join(before, further, ["canonical_card_id"], ["old_card_id"], "left")
    moved = moved.select("old_card_id", F.coalesce("further", "canonical_card_id").alias("canonical_card_id"))
    _write(moved.unionByName(gone), store, "merged", run)


def card_stream(notices: DataFrame, store: str, checkpoint: str, **banding):
    """Process the notices that have arrived, batch by batch, and stop; returns the finished query."""
    create_store(notices.sparkSession, store)
    writer = notices.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint)
    query = writer.foreachBatch(lambda batch, run: run_cards(batch, run, store, **banding)).start()
    query.awaitTermination()
    return query


def latest_cards(spark, store: str) -> DataFrame:
    """(card_id, notice_id) as of the last run."""
    runs = stored(spark, store, "members", 1 << 30).select("run").union(stored(spark, store, "merged", 1 << 30).select("run"))
    return members_before(spark, store, runs.agg(F.coalesce(F.max("run"), F.lit(-1))).first()[0] + 1).select("card_id", "notice_id")

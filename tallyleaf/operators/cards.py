"""Cards: groups of verified duplicates with ids that stay the same from run to run."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyleaf.operators import lsh, verify
from tallyleaf.operators.skew import salted_join
from tallyleaf.session import cut_lineage


def connected_components(edges: DataFrame) -> DataFrame:
    """(notice_id, component) for every end of an edge; the component is its lowest notice id.

    Each round takes the lowest label among neighbours and then the label of that label, so chains shrink by
    half. Labels are checkpointed every round: the plan stays short, and a lost executor costs one round.
    """
    ends = edges.select(F.col("id_a").alias("notice_id"), F.col("id_b").alias("other"))
    both = cut_lineage(ends.union(ends.select("other", "notice_id")).distinct())
    labels = cut_lineage(both.groupBy("notice_id").agg(F.least("notice_id", F.min("other")).alias("component")))
    while True:
        theirs = labels.withColumnsRenamed({"notice_id": "other", "component": "seen"})
        seen = salted_join(both, theirs, ["other"], ["notice_id"])
        lowest = seen.groupBy("notice_id").agg(F.min("seen").alias("seen"))
        hooked = labels.join(lowest, "notice_id").select(
            "notice_id", F.least("component", "seen").alias("component"), F.col("component").alias("before")
        )
        jump = hooked.select(F.col("notice_id").alias("component"), F.col("component").alias("further"))
        moved = salted_join(hooked, jump, ["component"], ["notice_id"])
        moved = cut_lineage(moved.select("notice_id", F.col("further").alias("component"), "before"))
        labels = moved.drop("before")
        if moved.where("component <> before").isEmpty():
            return labels


def card_links(notices: DataFrame, threshold=verify.THRESHOLD, **banding) -> DataFrame:
    """Verified pairs that connect the same notices as all verified pairs do, without listing all of them.

    Copies hang on their original. The members of a bucket are first compared with its lowest member only; what that
    leaves unconnected is then compared across components only.
    """
    known = cut_lineage(verify.features(notices, **banding))
    firsts = verify.originals(known)
    posted = lsh.postings(firsts.select("notice_id", "estimated_value", "buckets"))
    shared, within = cut_lineage(lsh.distinct_shared(posted, verify.VALUE_BUCKET)), verify.SHARED
    lowest = shared.groupBy(*within).agg(F.min("notice_id").alias("id_a"))
    stars = salted_join(shared, lowest, within, ["notice_id"]).where("notice_id > id_a")
    stars = stars.select("id_a", F.col("notice_id").alias("id_b")).distinct()
    near = cut_lineage(verify.verify(verify.may_be_pairs(stars, firsts, threshold), firsts, threshold).select("id_a", "id_b"))
    found = verify.bucket_pairs(firsts, shared, threshold, connected_components(near)).select("id_a", "id_b")
    return near.union(found).union(verify.copies_of(known))


def card_members(notices: DataFrame, links: DataFrame) -> DataFrame:
    """(component, notice_id) for every notice; a notice without a link is its own component."""
    found = connected_components(links)
    every = notices.select("notice_id").join(found, "notice_id", "left")
    return every.select(F.coalesce("component", "notice_id").alias("component"), "notice_id")


def new_card_id(notice_id):
    return F.concat(F.lit("CARD-"), notice_id.cast("string"))


def representatives(members: DataFrame, notices: DataFrame, order=("notice_id",)) -> DataFrame:
    """The earliest member of each component, by the columns of ``order`` and then the id."""
    extra = [c for c in order if c != "notice_id"]
    dated = members.join(notices.select("notice_id", *extra), "notice_id") if extra else members
    first = F.min(F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)], F.col("notice_id").alias("id")))
    return dated.groupBy("component").agg(first.alias("first")).select(
        "component", F.col("first.id").alias("representative_id")
    )


def mint_cards(members: DataFrame, notices: DataFrame, order=("notice_id",)) -> DataFrame:
    """First run: a card per component, named after its earliest member."""
    named = representatives(members, notices, order)
    joined = salted_join(members, named, ["component"], ["notice_id"])
    return joined.select(new_card_id(F.col("representative_id")).alias("card_id"), "notice_id")


def update_cards(stored: DataFrame, members: DataFrame, notices: DataFrame, now, order=("notice_id",)):
    """Carry card ids over to a new grouping. ``stored`` is (card_id, created_at, notice_id).

    A component with stored cards keeps the oldest; the others redirect to it. A component without one gets
    a new card created ``now``. Returns (membership, redirects), the membership with the columns of ``stored``.
    """
    carried = stored.join(members, "notice_id").groupBy("component", "card_id").agg(
        F.min("created_at").alias("created_at")
    )
    kept = carried.groupBy("component").agg(F.min(F.struct("created_at", "card_id")).alias("oldest"))
    kept = kept.select(
        "component", F.col("oldest.card_id").alias("kept_id"), F.col("oldest.created_at").alias("kept_at")
    )
    named = representatives(members, notices, order).join(kept, "component", "left")
    card = F.coalesce(F.col("kept_id"), new_card_id(F.col("representative_id")))
    cards = named.select("component", card.alias("card_id"), F.coalesce("kept_at", F.lit(now)).alias("created_at"))
    membership = salted_join(members, cards, ["component"], ["notice_id"])
    membership = membership.select("card_id", "created_at", "notice_id")
    redirects = carried.join(kept, "component").where("card_id <> kept_id")
    return membership, redirects.select(
        F.col("card_id").alias("old_card_id"), F.col("kept_id").alias("canonical_card_id")
    ).distinct()

"""The notice queries over a folder of tables."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyleaf.functions import minhash, text
from tallyleaf.operators import cards, evaluate, lsh, verify
from tallyleaf.plans.billing import new_folder
from tallyleaf.session import cut_lineage
from tallyleaf.sources import layout, tables

# The configurations compared, as (name, shingle words, whether frequent shingles are pruned, bands, rows, bucket cap).
MITIGATIONS = (
    ("Baseline", 2, False, 32, 4, None),
    ("Bucket cap 100", 2, False, 32, 4, 100),
    ("Bucket cap 50", 2, False, 32, 4, 50),
    ("Frequent shingles pruned", 2, True, 32, 4, None),
    ("Rebalanced 16 x 8", 2, False, 16, 8, None),
    ("Word 3-grams", 3, False, 32, 4, None),
)
WINNING_BAND = 25
#: Text whose shingles one task lists: it counts them before they are shuffled, and the more text, the more of them differ.
TASK_BYTES = 8 << 20


def _shingled(spark, folder, how="processed", n=2):
    return lsh.word_shingles(lsh.clean(tables.notices(spark, folder, TASK_BYTES), how), n)


def _sketches(spark, folder, how="processed", bands=lsh.BANDS, rows=lsh.ROWS):
    """Sketches written once: bucket sizes and every join on buckets read them again."""
    found = lsh.text_sketch(lsh.clean(tables.notices(spark, folder), how), bands=bands, rows=rows)
    return cut_lineage(found.select("notice_id", "portal_id", "buckets"))


def _postings(spark, folder, **banding):
    return lsh.postings(_sketches(spark, folder, **banding))


def corpus_counts(spark, folder):
    return evaluate.corpus_counts(tables.notices(spark, folder), tables.clusters(spark, folder))


def shared_values(spark, folder):
    return evaluate.shared_values(tables.notices(spark, folder), tables.clusters(spark, folder))


def cluster_consistency(spark, folder):
    return evaluate.cluster_consistency(tables.notices(spark, folder), tables.clusters(spark, folder))


def first_per_archetype(spark, folder):
    return evaluate.first_per_archetype(tables.notices(spark, folder), tables.clusters(spark, folder))


def cluster_members(spark, folder):
    members = evaluate.cluster_members(tables.notices(spark, folder), tables.clusters(spark, folder))
    return members.select("cluster_id", "copy_index", "notice_id", "portal_id", F.length("body").alias("body_length"))


def label_truth_mismatches(spark, folder):
    return evaluate.label_truth_mismatches(tables.labelled_pairs(spark, folder), tables.clusters(spark, folder))


def _digests(notices):
    title, body = F.col("title"), F.col("body")
    return notices.select(
        "notice_id",
        F.md5(text.raw_text(title, body)).alias("raw_md5"),
        F.md5(text.naive_text(title, body)).alias("naive_md5"),
        F.md5(text.processed_text(title, body)).alias("processed_md5"),
        F.length(text.processed_text(title, body)).alias("processed_length"),
    )


def cleaned_documents(spark, folder):
    return _digests(tables.notices(spark, folder))


def cleaned_pages(spark, folder):
    return _digests(tables.pages(spark, folder))


def shingle_counts(spark, folder):
    """Distinct shingles per notice, for every shingling."""
    both = tables.notices(spark, folder).select(
        "notice_id",
        text.raw_text(F.col("title"), F.col("body")).alias("raw"),
        text.processed_text(F.col("title"), F.col("body")).alias("processed"),
    )
    raw, processed = F.col("raw"), F.col("processed")
    shingled = [("raw_char5", raw, "char", 5), ("char5", processed, "char", 5), *[(f"word{n}", processed, "word", n) for n in (1, 2, 3)]]
    return both.select("notice_id", minhash.ngram_counts(shingled).alias("counts")).select("notice_id", "counts.*")


def document_frequency(spark, folder):
    """How many shingles occur in how many notices."""
    counts = lsh.document_frequency(_shingled(spark, folder))
    return counts.groupBy("df").agg(F.count("*").alias("shingles"))


def frequent_shingles(spark, folder):
    return lsh.frequent_shingles(_shingled(spark, folder))


def portal_prefixes(spark, folder):
    return evaluate.portal_prefixes(tables.pages(spark, folder))


def labelled_pairs(spark, folder):
    return tables.labelled_pairs(spark, folder)


def _scored(spark, folder, n=2):
    sets = evaluate.shingle_sets(tables.notices(spark, folder), "processed", "word", n)
    return evaluate.score_pairs(tables.labelled_pairs(spark, folder), sets)


def pair_scores(spark, folder):
    return _scored(spark, folder).select("id_a", "id_b", "label", "shared", "united", "jaccard")


def class_stats(spark, folder):
    return evaluate.class_stats(_scored(spark, folder))


def threshold_sweep(spark, folder):
    return evaluate.threshold_sweep(_scored(spark, folder, 3))


def best_f1(spark, folder):
    return evaluate.best_f1(threshold_sweep(spark, folder))


def operating_point(spark, folder):
    return evaluate.operating_point(threshold_sweep(spark, folder))


def representations(spark, folder):
    pairs = cut_lineage(tables.labelled_pairs(spark, folder))
    return evaluate.compare_representations(tables.notices(spark, folder), pairs)


def signature_error(spark, folder):
    return evaluate.signature_error(tables.notices(spark, folder), tables.labelled_pairs(spark, folder))


def signatures(spark, folder):
    """The whole signature of every notice, as one digest each."""
    cleaned = lsh.clean(tables.notices(spark, folder))
    signed = cleaned.select("notice_id", minhash.ngram_signature(F.col("clean"), 2, lsh.K).alias("signature"))
    return signed.where("signature is not null").select("notice_id", F.md5(F.array_join("signature", ",")).alias("signature_md5"))


def lsh_postings(spark, folder):
    return lsh.postings(lsh.text_sketch(lsh.clean(tables.notices(spark, folder))).select("notice_id", "buckets"))


def bucket_stats(spark, folder):
    """Bucket statistics of naive text for both bandings."""
    rows = [
        lsh.bucket_stats(lsh.bucket_sizes(_postings(spark, folder, how="naive", bands=b, rows=r))).select(
            F.lit(b).alias("bands"), F.lit(r).alias("rows"), "*"
        )
        for b, r in ((16, 8), (32, 4))
    ]
    return reduce(DataFrame.unionByName, rows)


def top_buckets(spark, folder):
    sizes = lsh.bucket_sizes(_postings(spark, folder))
    return sizes.orderBy(F.col("bucket_size").desc(), "band_id", "bucket_id").limit(10)


def largest_bucket_portals(spark, folder):
    posted = _postings(spark, folder)
    return lsh.portals_of_largest(posted, lsh.bucket_sizes(posted))


def _retrieval_summary(sketches, same=None, cap=None, sizes=None):
    """Bucket statistics, work percentiles and candidates of one configuration, as one row; of ``same`` pairs the hits.

    With a cap, larger buckets count in the bucket statistics but give neither work nor candidates nor hits. ``sizes`` are those of the
    buckets, where they are known.
    """
    posted = lsh.postings(sketches)
    sizes = cut_lineage(lsh.bucket_sizes(posted)) if sizes is None else sizes
    met = cut_lineage(lsh.meetings(posted, sizes if cap is None else lsh.within_cap(sizes, cap)))
    parts = [lsh.bucket_stats(sizes), lsh.work_percentiles(met.select("notice_id", "work")), lsh.count_pairs(met)]
    if same is not None:
        parts.append(lsh.recall(same, sketches if cap is None else met))
    return reduce(lambda a, b: a.join(b, "k"), [p.withColumn("k", F.lit(1)) for p in parts]).drop("k")


def naive_vs_processed(spark, folder):
    """What stripping the boilerplate does to buckets, work and candidates."""
    rows = []
    for how in ("naive", "processed"):
        rows.append(_retrieval_summary(_sketches(spark, folder, how)).select(F.lit(how).alias("text"), "*"))
    return reduce(DataFrame.unionByName, rows)


def mitigations(spark, folder):
    """Recall against cost for every mitigation, one row each. Texts are cleaned, hashed and signed once, for all shinglings, and
    buckets are counted once per banding."""
    same = cut_lineage(tables.labelled_pairs(spark, folder).where("label = 'same'"))
    total, signatures, sketches, sizes, rows = F.lit(same.count()), {}, {}, {}, []
    cleaned = lsh.clean(tables.notices(spark, folder, TASK_BYTES)).select("notice_id", "clean")
    # Sets are kept for the shingling that is pruned, the first one.
    lengths = dict.fromkeys(sorted((n for _, n, *_ in MITIGATIONS), key=lambda n: not any(p for _, m, p, *_ in MITIGATIONS if m == n)))
    made = cleaned.select("notice_id", minhash.ngram_signatures(F.col("clean"), [*lengths], lsh.K).alias("made"))
    made = cut_lineage(made.select("notice_id", "made.*"))
    for name, n, pruned, bands, per_band, cap in MITIGATIONS:
        if (n, pruned) not in signatures:
            if pruned:
                found = cut_lineage(lsh.signed(lsh.prune_frequent(made.select("notice_id", F.col("sets").alias("shingles")))))
            else:
                found = made.select("notice_id", F.col(f"signature_{n}").alias("signature"))
            signatures[n, pruned] = found.where("signature is not null")
        key = (n, pruned, bands, per_band)
        if key not in sketches:
            sketches[key] = cut_lineage(lsh.banded(signatures[n, pruned], bands, per_band))
            sizes[key] = cut_lineage(lsh.bucket_sizes(lsh.postings(sketches[key])))
        rows.append(
            _retrieval_summary(sketches[key], same, cap, sizes[key]).select(
                F.lit(name).alias("strategy"),
                "hits",
                F.try_divide("hits", total).alias("recall"),
                "unique_candidates",
                "bucket_pairs",
                "max_bucket_size",
                "p50_work",
                "p90_work",
                "p99_work",
                "max_work",
            )
        )
    return reduce(DataFrame.unionByName, rows)


def work_percentiles(spark, folder):
    posted = _postings(spark, folder)
    return lsh.work_percentiles(lsh.work_per_notice(posted, lsh.bucket_sizes(posted)))


def candidates(spark, folder):
    """Distinct pairs that share a bucket, whatever its size."""
    posted = _postings(spark, folder)
    return lsh.bucket_candidates(posted, lsh.bucket_sizes(posted))


def label_recall(spark, folder):
    """Adjudicated duplicates among the candidates, without a cap."""
    same = tables.labelled_pairs(spark, folder).where("label = 'same'")
    return lsh.recall(same, _sketches(spark, folder))


def winning_shingles(spark, folder):
    return lsh.winning_shingles(_shingled(spark, folder), _sketches(spark, folder), WINNING_BAND)


def retrieval_curve(spark, folder):
    return evaluate.retrieval_curve(_scored(spark, folder), _sketches(spark, folder))


def _probe_batch(spark, folder):
    batch = lsh.word_shingles(lsh.clean(tables.incoming(spark, folder)))
    return lsh.postings(lsh.sketch(batch))


def index_probe(spark, folder):
    """Documents that share a bucket with a benchmark item."""
    return lsh.probe(lsh_postings(spark, folder), _probe_batch(spark, folder))


def _stored_index(spark, folder):
    path = new_folder(spark, "index")
    layout.write_lsh_index(lsh_postings(spark, folder), path)
    return layout.open_lsh_index(spark, path)


def stored_index_probe(spark, folder):
    """The same probe against an index that was written and read back."""
    return lsh.probe(_stored_index(spark, folder), _probe_batch(spark, folder))


def stored_index_lookup(spark, folder):
    """The probe for one incoming notice, the first of the batch: its bucket ids are looked up as constants."""
    batch = _probe_batch(spark, folder)
    first = batch.select(F.min("notice_id")).first()[0]
    asked = batch.where(F.col("notice_id") == F.lit(first))
    # One notice has as many ids as there are bands.
    ids = [r.bucket_id for r in asked.select("bucket_id").collect()]
    return lsh.probe(layout.lookup(_stored_index(spark, folder), ids), asked)


def verified_pairs(spark, folder):
    return verify.verified_pairs(tables.notices(spark, folder))


def verified_classes(spark, folder):
    """Every notice with its class of copies and the number of verified pairs it is in, copies included."""
    return verify.verified_classes(tables.notices(spark, folder))


def pair_view(spark, folder):
    """The labelled duplicates side by side: their texts as stretches that are equal, or only on the left or the right."""
    same = tables.labelled_pairs(spark, folder).where("label = 'same'")
    return evaluate.pair_view(same, tables.notices(spark, folder))


def card_membership(spark, folder):
    notices = tables.notices(spark, folder)
    return cards.mint_cards(cards.card_members(notices, cards.card_links(notices)), notices)


def _rerun(spark, folder):
    early, every = tables.earlier_notices(spark, folder), tables.notices(spark, folder)
    first = cards.mint_cards(cards.card_members(early, cards.card_links(early)), early)
    stored = cut_lineage(first.withColumn("created_at", F.lit("2024-01-01")))
    members = cut_lineage(cards.card_members(every, cards.card_links(every)))
    return cards.update_cards(stored, members, every, "2024-01-08")


def card_rerun(spark, folder):
    """Cards of all documents when those with a quality label already had cards."""
    return _rerun(spark, folder)[0].drop("created_at")


def card_redirects(spark, folder):
    """Earlier cards that merged into an older one."""
    return _rerun(spark, folder)[1]


QUERIES = {
    f.__name__: f
    for f in (
        corpus_counts,
        shared_values,
        cluster_consistency,
        first_per_archetype,
        cluster_members,
        label_truth_mismatches,
        cleaned_documents,
        cleaned_pages,
        shingle_counts,
        document_frequency,
        frequent_shingles,
        portal_prefixes,
        labelled_pairs,
        pair_scores,
        class_stats,
        threshold_sweep,
        best_f1,
        operating_point,
        representations,
        signature_error,
        signatures,
        lsh_postings,
        bucket_stats,
        top_buckets,
        largest_bucket_portals,
        naive_vs_processed,
        mitigations,
        work_percentiles,
        candidates,
        label_recall,
        winning_shingles,
        retrieval_curve,
        index_probe,
        stored_index_probe,
        stored_index_lookup,
        verified_pairs,
        verified_classes,
        pair_view,
        card_membership,
        card_rerun,
        card_redirects,
    )
}

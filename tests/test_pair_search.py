"""The search for pairs over buckets, and the hashes made in one pass."""

import pytest
from pyspark.sql import functions as F

from tallyleaf.functions import minhash, text
from tallyleaf.operators import evaluate, lsh, verify
from tallyleaf.operators.skew import meet
from tallyleaf.sources import tables

WORDS = [f"w{i}" for i in range(40)]
DOCUMENTS = "doc_id long, source string, text string, lang string"


def _documents(spark):
    """Three groups of near copies, one of them in another language, and an unlike text."""
    rows = []
    for group in range(3):
        for copy in range(6):
            words = [f"{w}x{group}" for w in WORDS]
            words[copy * 2] = f"changed{group}y{copy}"
            rows.append((group * 10 + copy, "s", " ".join(words), "de" if group == 2 else "en"))
    return spark.createDataFrame([*rows, (99, "s", "nothing like it", "en")], DOCUMENTS)


def _notices(documents):
    return documents.select(
        F.col("doc_id").alias("notice_id"), F.lit("").alias("title"), F.col("text").alias("body"), F.col("lang").alias("estimated_value")
    )


@pytest.mark.parametrize("n", [1, 2, 3])
def test_hashes_in_one_pass_equal_those_of_listed_ngrams(spark, n):
    values = ["", "a", "a b", "a b c", "a b a b a b c", "über straße ß über", None]
    rows = spark.createDataFrame([(v,) for v in values], "t string")
    listed = F.transform(text.word_ngrams(F.col("t"), n), minhash.hash60).alias("listed")
    found = rows.select(listed, minhash.ngram_hashes(F.col("t"), n).alias("hashed")).collect()
    assert [r.listed for r in found] == [r.hashed for r in found]
    residues = minhash.signature(F.transform("listed", lambda h: (h % minhash.PRIME).cast("int")), 16).alias("listed")
    signed = rows.select(listed, "t").select(residues, minhash.ngram_signature(F.col("t"), n, 16).alias("hashed")).collect()
    assert [r.listed for r in signed] == [r.hashed for r in signed]


def test_buckets_with_the_same_members_are_one(spark):
    posted = [(0, 10, 1), (0, 10, 2), (1, 11, 1), (1, 11, 2), (2, 12, 1), (2, 12, 2), (2, 12, 3), (3, 13, 4), (3, 13, 4), (4, 14, 4), (4, 14, 4)]
    shared = lsh.distinct_shared(spark.createDataFrame(posted, "band_id int, bucket_id long, notice_id long"))
    assert sorted((r.bucket_id, r.notice_id) for r in shared.collect()) == [(10, 1), (10, 2), (12, 1), (12, 2), (12, 3), (13, 4)]


def test_pairs_are_the_same_listed_or_over_rare_shingles(spark, monkeypatch):
    notices = _notices(_documents(spark))
    listed = {(r.id_a, r.id_b, round(r.jaccard, 9)) for r in verify.verified_pairs(notices).collect()}
    expected = {(10 * g + a, 10 * g + b) for g in range(3) for a in range(6) for b in range(a + 1, 6)}
    assert {(a, b) for a, b, _ in listed} == expected
    monkeypatch.setattr(verify, "LISTED", 2)
    assert {(r.id_a, r.id_b, round(r.jaccard, 9)) for r in verify.verified_pairs(notices).collect()} == listed


def test_connected_pairs_are_not_looked_for(spark):
    firsts = verify.originals(verify.features(_notices(_documents(spark)))).cache()
    posted = lsh.postings(firsts.select("notice_id", "estimated_value", "buckets"))
    shared = lsh.distinct_shared(posted, verify.VALUE_BUCKET)
    known = spark.createDataFrame([(g * 10 + i, g * 10) for g in range(3) for i in range(6) if i != 5], "notice_id long, component long")
    found = verify.bucket_pairs(firsts, shared, components=known)
    assert {(r.id_a, r.id_b) for r in found.collect()} == {(10 * g + i, 10 * g + 5) for g in range(3) for i in range(5)}


def test_counted_ngrams_are_those_listed(spark):
    values = ["", "a", "ab a b", "abcd", "abcde", "aaaaaa", "a b a b a b c", "über straße ß über", "".join(map(chr, range(0x4E00, 0x6400))) * 2]
    rows = spark.createDataFrame([(v,) for v in values], "t string")
    units = [("char", 5), ("word", 1), ("word", 2), ("word", 3)]
    listed = [text.char_ngrams(F.col("t"), n) if unit == "char" else text.word_ngrams(F.col("t"), n) for unit, n in units]
    found = rows.select(
        F.array(*map(F.size, listed)).alias("sizes"), minhash.ngram_counts([(f"c{i}", F.col("t"), *u) for i, u in enumerate(units)]).alias("counted")
    )
    assert all(r.sizes == list(r.counted) for r in found.collect())
    pairs = rows.crossJoin(rows.toDF("o"))
    others = [text.char_ngrams(F.col("o"), n) if unit == "char" else text.word_ngrams(F.col("o"), n) for unit, n in units]
    expected = F.array(*[F.array(minhash.overlap(a, b), F.size(a), F.size(b)) for a, b in zip(listed, others)])
    counted = minhash.shared_ngrams([(F.col("t"), F.col("o"), *u) for u in units])
    for r in pairs.select(expected.alias("expected"), counted.alias("counted")).collect():
        assert r.expected == [list(c) for c in r.counted]


def test_representations_move_texts_and_no_sets(spark):
    """Six sets of hashes per end of a pair took many times the bytes of the texts."""
    notices = _notices(_documents(spark))
    pairs = spark.createDataFrame([(0, 1, "same"), (0, 2, "same"), (0, 10, "different"), (10, 11, "same")], "id_a long, id_b long, label string")
    found = evaluate.compare_representations(notices, pairs)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") <= 6 and "array<bigint>" not in plan
    rows = {r.representation: r for r in found.collect()}
    assert len(rows) == 6
    for name, how, unit, n in evaluate.REPRESENTATIONS:
        scored = evaluate.score_pairs(pairs, evaluate.shingle_sets(notices, how, unit, n)).collect()
        assert rows[name].same_min == min(r.jaccard for r in scored if r.label == "same")
        assert rows[name].mean_shingles == round(sum(r.size_a + r.size_b for r in scored) / 8, 6)


def test_buckets_of_one_pattern_are_not_met(spark, monkeypatch):
    """Copies share all their buckets: they were sent to every one of them, though nothing meets there."""
    rows = [(i, [1, 2, 3, 4]) for i in range(5)] + [(5, [3, 4, 9]), (6, [9, 10]), (7, [9, 10]), (8, [20, 20]), (None, [20])]
    sent = []
    monkeypatch.setattr(lsh, "meet", lambda a, *more: sent.append(a.count()) or meet(a, *more))
    found = lsh.count_pairs(spark.createDataFrame(rows, "notice_id long, buckets array<long>")).first()[0]
    # Two of the last pair: a notice that is there twice counts twice.
    assert (found, sent) == (10 + 1 + 5 + 2 + 2, [6])


def test_pruning_by_list_equals_pruning_by_join(spark, monkeypatch):
    rows = spark.createDataFrame([(i, [1, 2, 100 + i] if i % 2 else [1, 200 + i]) for i in range(20)] + [(50, [1])], "notice_id long, shingles array<long>")
    listed = {r.notice_id: sorted(r.shingles) for r in lsh.prune_frequent(rows).collect()}
    monkeypatch.setattr(lsh, "FREQUENT", 0)
    assert {r.notice_id: sorted(r.shingles) for r in lsh.prune_frequent(rows).collect()} == listed
    assert listed[50] == [] and listed[1] == [101] and listed[2] == [202]


def test_tasks_that_list_shingles_hold_a_bounded_text(spark, tmp_path):
    path = str(tmp_path / "documents.parquet")
    _documents(spark).coalesce(1).write.parquet(path)
    assert tables.notices(spark, str(tmp_path), 100).rdd.getNumPartitions() > 4

"""Streams of tables that are folders of files, or empty."""

import random

import pytest
from pyspark.sql import functions as F

from tallyleaf.operators import verify
from tallyleaf.plans import streams
from tallyleaf.streaming import weekly

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


def test_cards_of_a_table_that_is_a_folder(spark, tmp_path):
    _documents(spark).repartition(2).write.parquet(str(tmp_path / "documents.parquet"))
    cards = {r.notice_id: r.card_id for r in streams.streamed_cards(spark, str(tmp_path)).collect()}
    assert cards == {d.doc_id: f"CARD-{d.doc_id // 10 * 10 if d.doc_id < 99 else 99}" for d in _documents(spark).collect()}


def test_cards_of_a_stream_without_rows(spark, tmp_path):
    spark.createDataFrame([], DOCUMENTS).write.parquet(str(tmp_path / "documents.parquet"))
    assert streams.streamed_cards(spark, str(tmp_path)).count() == 0


def test_texts_of_different_buckets_do_not_meet(spark, tmp_path, monkeypatch):
    """Every text holds the same new passage, too short a part of it for a common bucket: no pairs are made of it."""
    passage, met, schema = " ".join(WORDS[:12]), [], "notice_id long, title string, body string, estimated_value string"
    texts = [(i, "", " ".join([*(f"a{i}x{j}" for j in range(60)), passage, *(f"b{i}x{j}" for j in range(60))]), "9") for i in range(40)]
    meet = weekly.meet

    def counted(*sides):
        found = meet(*sides)
        met.append(found.count())
        return found

    monkeypatch.setattr(weekly, "meet", counted)
    weekly.run_cards(spark.createDataFrame([(100, "", " ".join(WORDS[20:]), "9")], schema), 0, str(tmp_path))
    weekly.run_cards(spark.createDataFrame(texts, schema), 1, str(tmp_path))
    assert met and sum(met) < len(texts)
    cards = {r.notice_id: r.card_id for r in weekly.latest_cards(spark, str(tmp_path)).collect()}
    assert cards == {i: f"CARD-{i}" for i in [*range(40), 100]}


@pytest.mark.parametrize("threshold", [0.45, 0.7])
def test_heads_leave_out_no_pair_that_reaches_the_threshold(spark, threshold):
    pool, rows = random.Random(5), []
    for i in range(60):
        base = [pool.randrange(-(1 << 60), 1 << 60) for _ in range(pool.choice([1, 2, 7, 40]))]
        rows += [(i * 4 + c, "9", list({*pool.sample(base, max(1, len(base) - c)), *range(i, i + c)})) for c in range(4)]
    heads = verify.heads(spark.createDataFrame(rows, "notice_id long, estimated_value string, sets array<long>"), threshold)
    a, b = (heads.withColumnsRenamed({c: f"{c}_{e}" for c in heads.columns}) for e in "ab")
    kept = a.join(b, F.col("notice_id_a") < F.col("notice_id_b")).where(verify.may_reach(threshold)).select("notice_id_a", "notice_id_b")
    kept = {tuple(r) for r in kept.collect()}
    near = {(i, j) for i, _, s in rows for j, _, t in rows if i < j and len({*s} & {*t}) >= threshold * len({*s, *t})}
    assert near and near <= kept and len(kept) < len(rows) * (len(rows) - 1) / 20


def test_large_buckets_go_over_rare_shingles(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(verify, "LISTED", 2)
    _documents(spark).write.parquet(str(tmp_path / "documents.parquet"))
    cards = {r.notice_id: r.card_id for r in weekly.latest_cards(spark, streams._weekly_store(spark, str(tmp_path))).collect()}
    assert cards == {d.doc_id: f"CARD-{d.doc_id // 10 * 10 if d.doc_id < 99 else 99}" for d in _documents(spark).collect()}

"""Texts, sketches, retrieval, verification and cards, against plain Python on small fixtures."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from tallyleaf.functions import alignment, minhash, text
from tallyleaf.operators import cards, evaluate, lsh, verify
from tallyleaf.operators.skew import meet
from tallyleaf.sources import layout
from tallyleaf.streaming import weekly
from tallyleaf.streaming.weekly import card_stream, latest_cards


def one(spark, expr, *values):
    names = [f"c{i}" for i in range(len(values))]
    return spark.createDataFrame([values], names).select(expr(*[F.col(n) for n in names])).first()[0]


@pytest.mark.parametrize(
    "title, body, expected",
    [
        ("e-Tender - NIT for Road", "Body text", "road body text"),
        ("Corrigendum - Bridge [MUNI/2025/98454]", "x", "bridge x"),
        ("t", "PREAMBLE a\nNOTICE DETAILS FOLLOW\n------------\n Name of work", "t name of work"),
        ("t", "PREAMBLE NOTICE DETAILS FOLLOW work", "t work"),
        ("t", "head\n" + "=" * 79 + "\nwork", "t work"),
        ("t", "work\n" + "-" * 79 + "\ndisclaimer", "t work"),
        ("t", "work [entry truncated] more", "t work"),
        ("t", "a\nTender Reference Number: X/1\nb", "t a b"),
        ("t", "on 13-07-2024 and 2024/07/13 or 12 Mar 2024 end", "t on and or end"),
        ("", "", ""),
    ],
)
def test_processed_text(spark, title, body, expected):
    assert one(spark, text.processed_text, title, body) == expected


def test_shingles(spark):
    def grams(value, n):
        return sorted(one(spark, lambda t: text.word_ngrams(t, n), value))

    assert grams("a b c a b", 2) == ["a b", "b c", "c a"]
    assert grams("a b", 3) == ["a", "b"]
    assert grams("", 2) == []
    assert sorted(one(spark, text.char_ngrams, "abcdéf")) == ["abcdé", "bcdéf"]
    assert one(spark, text.char_ngrams, "abc") == ["abc"]


def test_common_prefix(spark):
    for a, b in (("abcx", "abcyz"), ("", "a"), ("same", "same"), ("x", "y")):
        n = next((i for i, (p, q) in enumerate(zip(a, b)) if p != q), min(len(a), len(b)))
        assert one(spark, text.common_prefix, a, b) == a[:n]


def test_signature_equals_plain_minima(spark):
    rng = random.Random(1)
    sets = [[rng.randrange(minhash.PRIME) for _ in range(rng.randrange(0, 400))] for _ in range(50)]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(sets)], "i int, h array<int>")
    got = {r.i: r.s for r in df.select("i", minhash.signature(F.col("h"), 16).alias("s")).collect()}
    for i, s in enumerate(sets):
        expected = [min((h * a + b) % minhash.PRIME for h in s) for a, b in minhash.hash_family(16)] if s else None
        assert got[i] == expected


def test_longer_family_starts_with_shorter():
    assert minhash.hash_family(32)[:16] == minhash.hash_family(16)


@pytest.fixture(scope="module")
def crowd(spark):
    """Many notices in few buckets: copies, near copies, and a shared boilerplate."""
    rng = random.Random(7)
    boiler = " ".join(f"clause{i}" for i in range(30))
    rows, no = [], 0
    for group in range(6):
        own = [f"g{group}w{i}" for i in range(40)]
        for _ in range(12):
            words = [w if rng.random() > 0.06 else f"x{rng.randrange(10**6)}" for w in own]
            rows.append((no, f"P{group % 3}", "", f"{boiler} {' '.join(words)}", rng.choice(["10", "20", None])))
            no += 1
    for _ in range(25):
        rows.append((no, "P9", "", rows[3][3], rows[3][4] or "10"))
        no += 1
    rows.append((no, "P9", "", "", "10"))
    schema = "notice_id long, portal_id string, title string, body string, estimated_value string"
    return spark.createDataFrame(rows, schema).repartition(4), rows


def _shingles(body, n):
    words = body.split()
    return {" ".join(words[i : i + n]) for i in range(len(words) - n + 1)}


BANDING = {"k": 32, "bands": 16, "rows": 2}


@pytest.fixture(scope="module")
def buckets(spark, crowd):
    found = lsh.sketch(lsh.word_shingles(lsh.clean(crowd[0])), **BANDING).cache()
    return found, {r.notice_id: r.buckets for r in found.collect()}


def _candidate_pairs(held):
    return {(a, b) for a, b in itertools.combinations(sorted(held), 2) if set(held[a]) & set(held[b])}


def test_candidate_count(buckets):
    found, held = buckets
    posted = lsh.postings(found)
    counted = lsh.count_candidates(posted, lsh.bucket_sizes(posted)).first()[0]
    assert counted == len(_candidate_pairs(held))


def test_bucket_candidates_and_work(buckets):
    found, held = buckets
    posted = lsh.postings(found)
    sizes = lsh.bucket_sizes(posted)
    members = {}
    for notice, ids in held.items():
        for bucket in ids:
            members.setdefault(bucket, []).append(notice)
    expected = {p for m in members.values() for p in itertools.combinations(sorted(m), 2)}
    assert {tuple(r) for r in lsh.bucket_candidates(posted, sizes).collect()} == expected
    work = {}
    for m in members.values():
        if len(m) > 1:
            for notice in m:
                work[notice] = work.get(notice, 0) + len(m) - 1
    assert {r.notice_id: r.work for r in lsh.work_per_notice(posted, sizes).collect()} == work


@pytest.mark.parametrize("block", [1, 7, 1000])
def test_rows_of_a_key_meet_once_in_blocks(spark, block):
    rows = spark.range(40).selectExpr("id", "if(id < 30, 0L, id) k", "if(id < 30, 30L, 1L) key_rows")
    met = meet(rows, rows, ["k"], ["id"], ["id"], block)
    expected = sorted([(a, b) for a in range(30) for b in range(30)] + [(a, a) for a in range(30, 40)])
    assert sorted((r.id_a, r.id_b) for r in met.collect()) == expected


def test_pairs_of_a_huge_bucket_stay_exact(spark):
    assert spark.range(1).select(lsh.pairs_among(F.lit(4_000_000_001))).first()[0] == 8_000_000_002_000_000_000


def test_recall_counts_pairs_that_meet(spark, buckets):
    found, held = buckets
    pairs = list(itertools.combinations(sorted(held), 2))
    same = spark.createDataFrame(pairs, "id_a long, id_b long")
    assert lsh.recall(same, found).first().hits == len(_candidate_pairs(held))


def _verified(rows, held, originals_only=True):
    seen, firsts = set(), []
    for no, _, _, body, value in rows:
        if value and body and not (originals_only and (body, value) in seen):
            seen.add((body, value))
            firsts.append((no, _shingles(body, 3), value))
    out = set()
    for (a, sa, va), (b, sb, vb) in itertools.combinations(firsts, 2):
        if va == vb and set(held[a]) & set(held[b]) and len(sa & sb) / len(sa | sb) >= verify.THRESHOLD:
            out.add((a, b))
    return out


def test_verified_pairs_are_all_pairs_that_qualify(crowd, buckets):
    notices, rows = crowd
    got = {(r.id_a, r.id_b) for r in verify.verified_pairs(notices, **BANDING).collect()}
    assert got == _verified(rows, buckets[1]) and got


def _groups(pairs, nodes):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in pairs:
        ra, rb = root(a), root(b)
        parent[max(ra, rb)] = min(ra, rb)
    return {n: root(n) for n in nodes}


def test_cards_are_the_components_of_all_pairs(crowd, buckets):
    notices, rows = crowd
    links = cards.card_links(notices, **BANDING)
    got = {r.notice_id: r.component for r in cards.card_members(notices, links).collect()}
    assert got == _groups(_verified(rows, buckets[1], originals_only=False), [r[0] for r in rows])


def test_components_of_chains_and_stars(spark):
    rng = random.Random(3)
    chain = [(i, i + 1) for i in range(60)]
    star = [(100, 100 + i) for i in range(1, 80)]
    shuffled = [(b, a) if rng.random() < 0.5 else (a, b) for a, b in chain + star]
    edges = spark.createDataFrame(shuffled, "id_a long, id_b long")
    got = {r.notice_id: r.component for r in cards.connected_components(edges).collect()}
    assert got == _groups(shuffled, {n for e in shuffled for n in e})


def test_cards_keep_their_ids_and_redirect_on_merge(spark):
    stored = spark.sql(
        "select * from values ('CARD-5', '2024-01-02', 5L), ('CARD-7', '2024-01-01', 7L), ('CARD-9', '2024-01-01', 9L)"
        " t(card_id, created_at, notice_id)"
    )
    members = spark.sql("select * from values (5L, 5L), (5L, 6L), (5L, 7L), (9L, 9L), (1L, 1L) t(component, notice_id)")
    notices = members.select("notice_id")
    membership, redirects = cards.update_cards(stored, members, notices, "2024-02-01")
    got = {r.notice_id: (r.card_id, r.created_at) for r in membership.collect()}
    old = ("CARD-7", "2024-01-01")
    assert got == {5: old, 6: old, 7: old, 9: ("CARD-9", "2024-01-01"), 1: ("CARD-1", "2024-02-01")}
    assert [tuple(r) for r in redirects.collect()] == [("CARD-5", "CARD-7")]


def test_frequent_shingles_are_pruned(spark):
    # "the same" is in far more than 5 % of the notices; one notice has nothing else.
    rows = [(i, f"the same {i} only{i}") for i in range(40)] + [(99, "the same")]
    shingled = lsh.word_shingles(spark.createDataFrame(rows, "notice_id long, clean string"), 2)
    for sets in (shingled, lsh.hashed(shingled)):
        left = {r.notice_id: r.shingles for r in lsh.prune_frequent(sets).collect()}
        assert len(left) == 41 and left[99] == [] and {len(v) for k, v in left.items() if k < 99} == {2}
    assert sorted(lsh.prune_frequent(shingled).where("notice_id = 3").first().shingles) == ["3 only3", "same 3"]
    assert lsh.sketch(lsh.prune_frequent(lsh.hashed(shingled))).count() == 40
    plain, hashed = (lsh.sketch(s).orderBy("notice_id").collect() for s in (shingled.drop("clean"), lsh.hashed(shingled)))
    assert plain == hashed


@pytest.mark.parametrize("cap", [2, 5, 30])
def test_a_cap_is_measured_exactly(buckets, cap):
    found, held = buckets
    posted = lsh.postings(found)
    sizes = lsh.bucket_sizes(posted)
    members = {}
    for notice, ids in held.items():
        for bucket in ids:
            members.setdefault(bucket, []).append(notice)
    assert max(map(len, members.values())) > cap
    kept = {b: m for b, m in members.items() if len(m) <= cap}
    pairs = {p for m in kept.values() for p in itertools.combinations(sorted(m), 2)}
    met = lsh.within_cap(sizes, cap)
    assert lsh.count_candidates(posted, met).first()[0] == len(pairs)
    work = {}
    for m in kept.values():
        for notice in m:
            work[notice] = work.get(notice, 0) + len(m) - 1
    got = {r.notice_id: r.work for r in lsh.work_per_notice(posted, met).collect()}
    assert got == {n: w for n, w in work.items() if w}
    every = list(itertools.combinations(sorted(held), 2))
    asked = found.sparkSession.createDataFrame(every, "id_a long, id_b long")
    assert lsh.recall(asked, lsh.shared_sets(posted, met)).first().hits == len(pairs)


def test_percentiles_by_rank_selection(spark):
    rng = random.Random(4)
    for n in (0, 1, 2, 1000):
        values = [rng.choice([1, 2, 3, 50, rng.randrange(1, 10**6)]) for _ in range(n)]
        work = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "notice_id long, work long").repartition(3)
        row = lsh.work_percentiles(work).first()
        ordered = sorted(values)

        def at(p):
            rank = p * (n - 1)
            low, high = ordered[int(rank)], ordered[min(int(rank) + 1, n - 1)]
            return round(low + (high - low) * (rank - int(rank)), 6)

        expected = [at(p) for p in (0.5, 0.9, 0.99, 0.999)] if n else [0.0] * 4
        assert (row.notices, row.max_work) == (n, float(max(values, default=0)))
        assert [row.p50_work, row.p90_work, row.p99_work, row.p999_work] == pytest.approx(expected, abs=1e-6)


def _common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = row[:]
        for j, y in enumerate(b, 1):
            row[j] = before[j - 1] + 1 if x == y else max(before[j], row[j - 1])
    return row[-1]


def test_pair_view(spark):
    rng = random.Random(6)
    for _ in range(300):
        a, b = ([rng.choice("abcd") for _ in range(rng.randrange(30))] for _ in range(2))
        found = alignment.parts(a, b)
        assert [w for side, ws in found if side != "right" for w in ws] == a
        assert [w for side, ws in found if side != "left" for w in ws] == b
        assert sum(len(ws) for side, ws in found if side == "equal") == _common(a, b)
        assert all(x[0] != y[0] for x, y in zip(found, found[1:]))
    long = [f"w{i % 997}" for i in range(20_000)]
    assert alignment.parts(long, [*long[:9000], "new", *long[9001:]]) == [
        ("equal", long[:9000]), ("left", [long[9000]]), ("right", ["new"]), ("equal", long[9001:]),
    ]
    notices = spark.createDataFrame(
        [(1, "", "Road works, north."), (2, "", "Road repair works north"), (3, None, None), (4, "", "")],
        "notice_id long, title string, body string",
    )
    pairs = spark.createDataFrame([(1, 2), (3, 4), (1, 4)], "id_a long, id_b long")
    got = sorted(tuple(r) for r in evaluate.pair_view(pairs, notices).collect())
    assert got == [
        (1, 2, 0, "equal", "road"), (1, 2, 1, "right", "repair"), (1, 2, 2, "equal", "works north"), (1, 4, 0, "left", "road works north"),
    ]


def test_classes_count_every_verified_pair(crowd, buckets):
    notices, rows = crowd
    pairs = _verified(rows, buckets[1], originals_only=False)
    got = {r.notice_id: r for r in verify.verified_classes(notices, **BANDING).collect()}
    assert set(got) == {r[0] for r in rows}
    for notice, row in got.items():
        assert row.n_links == sum(notice in p for p in pairs), row
    assert sum(r.n_links for r in got.values()) == 2 * len(pairs) and max(r.class_size for r in got.values()) > 20


def test_threshold_sweep(spark):
    scored = spark.sql("select * from values ('same', 9, 10), ('same', 1, 2), ('different', 6, 10), ('different', 0, 0) t(label, shared, united)")
    sweep = evaluate.threshold_sweep(scored)
    assert sweep.count() == 99
    half = sweep.where("threshold = 0.5").first()
    assert (half.tp, half.fp, half.fn) == (2, 1, 0) and half.f1 == 0.8
    assert evaluate.best_f1(sweep).first().threshold == 0.01
    point = evaluate.operating_point(sweep).first()
    assert (point.threshold, point.cost) == (0.61, 1)


def test_stream_keeps_cards_over_runs(spark, tmp_path):
    source, store = tmp_path / "in", str(tmp_path / "store")
    source.mkdir()
    words = " ".join(f"w{i}" for i in range(50))
    schema = "notice_id long, title string, body string, estimated_value string"

    def arrive(*rows):
        spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(str(source))
        card_stream(spark.readStream.schema(schema).parquet(str(source)), store, str(tmp_path / "progress"))
        return {r.notice_id: r.card_id for r in latest_cards(spark, store).collect()}

    assert arrive((5, "", words, "1"), (8, "", "other text here", "1")) == {5: "CARD-5", 8: "CARD-8"}
    later = arrive((2, "", words, "1"), (3, "", words, None))
    assert later == {5: "CARD-5", 2: "CARD-5", 8: "CARD-8", 3: "CARD-3"}


def test_incremental_runs_equal_one_grouping(spark, crowd, buckets, tmp_path, monkeypatch):
    notices, rows = crowd
    store, looked_at = str(tmp_path), []
    verified = weekly._verified
    monkeypatch.setattr(weekly, "_verified", lambda pairs, *more: looked_at.append(pairs.count()) or verified(pairs, *more))
    # Three weeks, the ids of each scattered over the groups.
    week = (F.col("notice_id") * 7 + 3) % 3
    for run in range(3):
        weekly.run_cards(notices.where(week == run), run, store, **BANDING)
    expected = _groups(_verified(rows, buckets[1], originals_only=False), [r[0] for r in rows])
    got = {r.notice_id: r.card_id for r in latest_cards(spark, store).collect()}
    assert {frozenset(n for n in got if got[n] == c) for c in got.values()} == {
        frozenset(n for n in expected if expected[n] == c) for c in expected.values()
    }
    # A run compares far fewer pairs than there are among all notices of the weeks so far.
    assert max(looked_at) < len(rows) * (len(rows) - 1) / 2 / 10
    # Nothing in the store is as long as a text, and a repeated run changes nothing.
    assert not any(c in ("body", "title", "clean") for t in weekly.TABLES for c in spark.read.parquet(f"{store}/{t}").columns)
    weekly.run_cards(notices.where(week == 2), 2, store, **BANDING)
    assert {r.notice_id: r.card_id for r in latest_cards(spark, store).collect()} == got
    # What is stored already is not taken again.
    weekly.run_cards(notices, 3, store, **BANDING)
    assert {r.notice_id: r.card_id for r in latest_cards(spark, store).collect()} == got


def test_a_bridge_merges_cards_and_redirects(spark, tmp_path):
    words = [f"w{i}" for i in range(120)]
    # The ends share too little with one another, and enough with what lies between them.
    first, last, between = words[:70], words[50:], words[15:105]
    schema = "notice_id long, title string, body string, estimated_value string"

    def run(number, *rows):
        weekly.run_cards(spark.createDataFrame([(i, "", " ".join(w), "9") for i, w in rows], schema), number, str(tmp_path))
        return {r.notice_id: r.card_id for r in latest_cards(spark, str(tmp_path)).collect()}

    assert run(0, (4, first)) == {4: "CARD-4"}
    assert run(1, (2, last), (3, last)) == {4: "CARD-4", 2: "CARD-2", 3: "CARD-2"}
    assert run(2, (1, between)) == dict.fromkeys((1, 2, 3, 4), "CARD-4")
    gone = weekly.stored(spark, str(tmp_path), "redirects", 9)
    assert [tuple(r) for r in gone.collect()] == [("CARD-2", "CARD-4", 2)]
    assert run(3, (9, words[50:119])) == dict.fromkeys((1, 2, 3, 4, 9), "CARD-4")


def test_index_lookup_opens_few_files(spark, tmp_path):
    rows = spark.range(20_000).selectExpr("cast(id % 32 as int) band_id", "xxhash64(id % 5000) & 1152921504606846975L bucket_id", "id notice_id")
    layout.write_lsh_index(rows, str(tmp_path / "index"), buckets=16)
    index = layout.open_lsh_index(spark, str(tmp_path / "index"), buckets=16)
    assert len(index.inputFiles()) == 16
    wanted = rows.where("notice_id = 77").first().bucket_id
    # Spark prunes buckets either way, but only plans that keep the buckets apart say so.
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    found = layout.lookup(index, [wanted])
    assert sorted(r.notice_id for r in found.collect()) == [77, 5077, 10077, 15077]
    plan = found._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    assert "SelectedBucketsCount: 1 out of 16" in plan and "EqualTo(bucket_id" in plan
    # A batch too large to broadcast is shuffled; the index is not.
    batch = rows.where("notice_id % 3 = 0").select("band_id", "bucket_id", "notice_id")
    joined = lsh.probe(index.hint("merge"), batch)
    assert joined.where("notice_id = 77").count() == 1
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan

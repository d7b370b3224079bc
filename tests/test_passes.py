"""Work done once: texts of all mitigations, and versions that are dropped before a table is rewritten."""

from decimal import Decimal

from pyspark.sql import functions as F

from tallyleaf.functions import minhash
from tallyleaf.operators import ingest, lsh
from tallyleaf.plans import notices
from tallyleaf.sources import layout
from tallyleaf.streaming import nightly


def test_all_shinglings_are_signed_in_one_pass(spark):
    rows = spark.createDataFrame([("",), ("a",), ("a b",), ("a b c d a b",), (None,)], "t string")
    text = F.col("t")
    made = rows.select(minhash.ngram_signatures(text, [2, 3], 16).alias("m")).select("m.*").collect()
    alone = rows.select(
        minhash.ngram_hashes(F.coalesce(text, F.lit("")), 2), minhash.ngram_signature(text, 2, 16), minhash.ngram_signature(text, 3, 16)
    ).collect()
    assert [tuple(r) for r in made] == [tuple(r) for r in alone]


def test_mitigations_clean_texts_once(spark, tmp_path, monkeypatch):
    words = [f"w{i}" for i in range(30)]
    texts = [(i, "s", " ".join(words[i % 5 :]), "en") for i in range(20)]
    spark.createDataFrame(texts, "doc_id long, source string, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    cleaned, clean = [], lsh.clean
    monkeypatch.setattr(lsh, "clean", lambda rows, how="processed": cleaned.append(how) or clean(rows, how))
    assert notices.mitigations(spark, str(tmp_path)).count() == len(notices.MITIGATIONS)
    assert cleaned.count("processed") == 1


def test_replaced_versions_go_before_a_table_is_rewritten(spark, tmp_path, monkeypatch):
    target, there = str(tmp_path / "out"), []
    schema = "bill_no string, line_no int, product_code string, qty decimal(10,2), unit_price decimal(18,2), line_type string, file_name string"
    layout.create_versions(spark, target, ingest.all_sales(spark.createDataFrame([], schema)).schema)
    for version in (0, 2):
        line = ("S01/20240101/1", 1, "P", Decimal(version), Decimal(2), "SALE", f"f{version}")
        nightly.merge_lines(spark.createDataFrame([line], schema), target, version)
    rewrite = layout.rewrite_current

    def watched(spark, path, version):
        there.extend(p.parent.parent.parent.name for p in (tmp_path / "out" / "rows").glob("version=*/*/*/part-*.parquet"))
        rewrite(spark, path, version)

    monkeypatch.setattr(layout, "rewrite_current", watched)
    assert nightly.compact(spark, target) == 1
    assert there == ["version=2"] and [r.qty for r in layout.read_published(spark, target).collect()] == [2]

"""What grows with the input is cut into tasks by its rows: landing, segments, buckets of stored tables."""

import pytest
from pyspark.sql import functions as F

from carespark.sources import adapter
from carespark.sources.adapter import RawSource


@pytest.fixture()
def small_cut(monkeypatch):
    """Landed partitions of at most 40 driver rows."""
    monkeypatch.setattr(adapter, "LANDING_ROWS", 40)
    monkeypatch.setattr(adapter, "LANDING_ROWS_OF", {"mbrelig": 10})


@pytest.fixture()
def sf(spark, tmp_path):
    """400 orders on one day, 800 lines, 60 customers, 5 suppliers: few bytes, many rows."""
    day = F.lit("1996-05-17 00:00:00").cast("timestamp_ntz")
    tables = {
        "supplier": spark.range(5).select(F.col("id").alias("s_suppkey"), F.concat(F.lit("S"), "id").alias("s_name")),
        "customer": spark.range(60).select(F.col("id").alias("c_custkey"), F.concat(F.lit("Customer#"), "id").alias("c_name"), F.lit("AUTO").alias("c_mktsegment")),
        "orders": spark.range(400).select(F.col("id").alias("o_orderkey"), (F.col("id") % 60).alias("o_custkey"), F.lit("F").alias("o_orderstatus"),
                                          F.lit(12.5).alias("o_totalprice"), day.alias("o_orderdate"), F.lit("1-URGENT").alias("o_orderpriority")),
        "lineitem": spark.range(800).select((F.col("id") % 400).alias("l_orderkey"), F.col("id").alias("l_partkey"), (F.col("id") % 5).alias("l_suppkey"),
                                            F.lit(1).alias("l_linenumber"), F.lit(2.0).alias("l_quantity"), F.lit(3.0).alias("l_extendedprice"), F.lit(0.1).alias("l_discount"),
                                            F.lit(0.0).alias("l_tax"), F.lit("N").alias("l_returnflag"), F.lit("O").alias("l_linestatus"), day.alias("l_shipdate")),
    }
    tables |= {"part": spark.range(1).toDF("p_partkey"), "events": spark.range(1).toDF("event_id")}
    for name, df in tables.items():
        df.coalesce(1).write.parquet(f"{tmp_path}/sf/{name}.parquet")
    return f"{tmp_path}/sf"


@pytest.mark.parametrize("name", ["clclaim", "clline", "cldiag", "member", "mbrelig"])
def test_landing_is_cut_by_rows(spark, sf, small_cut, name):
    raw = RawSource(spark, sf)
    lazy, dealt = raw.derived(name), raw.derived(name, dealt=True)
    assert dealt.exceptAll(lazy).count() == 0 and lazy.exceptAll(dealt).count() == 0
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 1 and max(sizes) <= 3 * 40
    landed = raw[name]
    assert landed.count() == lazy.count() and len(landed.inputFiles()) > 1


def test_wide_rows_are_made_after_the_shuffle(spark, sf, small_cut):
    plan = RawSource(spark, sf).derived("clclaim", dealt=True)._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("RepartitionByExpression"):]
    assert "claimid" not in below and "claimid" in plan


def test_segments_are_expanded_by_many_tasks(spark, sf, small_cut):
    from carespark.plans.warehouse import Warehouse

    wh = Warehouse.from_driver(spark, sf)
    months = wh.member_month_detail
    assert months.rdd.getNumPartitions() == 6
    assert months.count() > 0


def test_stored_lines_hold_what_the_roll_up_reads(spark, sf, small_cut):
    from carespark.plans import core
    from carespark.plans.warehouse import Warehouse

    wh = Warehouse.from_driver(spark, sf)
    assert wh.by_claim("stg_clline").columns == core.ROLLED
    assert wh.fct_claim.agg(F.sum("line_count")).first()[0] == 800


def test_first_load_decides_the_buckets(spark, tmp_path, monkeypatch):
    from carespark.operators import upsert

    monkeypatch.setattr(upsert, "BUCKET_ROWS", 100)
    keys = F.when(F.col("id") % 4 > 0, F.concat(F.lit("k"), "id"))  # a quarter without a key
    at = lambda day: F.lit(f"2001-01-0{day} 00:00:00").cast("timestamp_ntz")
    first = spark.range(4000).select(keys.alias("k"), F.col("id").alias("v"), at(1).alias("_loaded_at"))
    t = upsert.IncrementalTable(spark, "t", "k", root=str(tmp_path))
    t.upsert(first)
    parts = t.current()["parts"]
    assert t.current()["buckets"] == len(parts) == 40 and max(p["rows"] for p in parts.values()) < 200
    second = spark.range(8).select(F.concat(F.lit("k"), "id").alias("k"), F.lit(-1).cast("long").alias("v"), at(2).alias("_loaded_at"))
    rows = t.upsert(second)
    assert t.current()["buckets"] == 40 and rows.count() == 4002 and rows.where("v = -1").count() == 8
    new, old = t.changes()
    assert new.columns == old.columns and new.count() == 8 and old.count() == 6


def test_months_that_changed_are_found_once(spark, tmp_path, wh, monkeypatch):
    from carespark.plans.refresh import ClaimMarts

    kept = ClaimMarts(spark, str(tmp_path), wh.dim_member, wh.dim_provider, wh.mart_member_months)
    claims, lines = wh.raw["clclaim"].limit(20), wh.raw["clline"].limit(20)
    kept.load(claims, lines)
    kept.refresh()
    later = claims.limit(3).withColumn("_loaded_at", F.lit("2030-01-01 00:00:00").cast("timestamp_ntz")).withColumn("load_month", F.lit("2030-01-01").cast("date"))
    kept.load(later, lines.limit(0))
    looks, changes = [], kept.claims.changes
    monkeypatch.setattr(kept.claims, "changes", lambda v: looks.append(v) or changes(v))
    kept.refresh()
    assert looks == [2] and {t.current()["built"]["claims"] for t in (kept.fact, kept.summary, kept.expense)} == {2}

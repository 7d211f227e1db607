"""Upsert, SCD-2, quality and streaming operators on small explicit inputs."""

import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from carespark.operators import quality, scd2, upsert
from carespark.operators.quality import Check

T0 = dt.datetime(2024, 1, 1)


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()),
                  key=lambda t: tuple((x is None, x if x is not None else "") for x in t))


def batch(spark, data):
    return spark.createDataFrame(data, "k string, v string, _loaded_at timestamp_ntz")


def test_incremental_table_lifecycle(spark):
    root = tempfile.mkdtemp(prefix="carespark-test-")
    t = upsert.IncrementalTable(spark, "adj", "k", root=root)
    assert t.read() is None
    t.upsert(batch(spark, [("a", "1", T0), ("b", "1", T0)]))  # empty target: full load
    t.upsert(batch(spark, [("a", "2", T0 + dt.timedelta(days=1)),
                           ("b", "stale", T0),  # equal to the watermark: skipped
                           ("c", "1", T0 + dt.timedelta(days=1))]))
    assert rows(t.read(), "k", "v") == [("a", "2"), ("b", "1"), ("c", "1")]
    assert t.versions() == [1, 2]
    # Replaying the same batch changes nothing (idempotent).
    t.upsert(batch(spark, [("a", "2", T0 + dt.timedelta(days=1))]))
    assert rows(t.read(), "k", "v") == [("a", "2"), ("b", "1"), ("c", "1")]


def test_duplicate_keys_fail_or_latest_wins(spark):
    dup = batch(spark, [("a", "1", T0), ("a", "2", T0 + dt.timedelta(hours=1))])
    with pytest.raises(Exception, match="duplicate"):
        upsert.dedupe_batch(dup, "k").collect()
    assert rows(upsert.dedupe_batch(dup, "k", "latest"), "k", "v") == [("a", "2")]


def test_schema_append_and_null_keys(spark):
    target = batch(spark, [("a", "1", T0), (None, "n", T0)])
    src = batch(spark, [("a", "2", T0), (None, "m", T0)]).withColumn("extra", F.lit("x"))
    out = upsert.merge_upsert(target, src, "k")
    # NULL keys never match: both NULL-key rows survive; "a" is replaced.
    assert rows(out, "k", "v", "extra") == [("a", "2", "x"), (None, "m", "x"), (None, "n", None)]


def test_scd2_history(spark):
    def src(data):
        return spark.createDataFrame(data, "id string, attr string, updated_at timestamp_ntz")

    h = scd2.snapshot_merge(None, src([("1", "x", T0), ("2", "y", T0)]), "id", "updated_at", "2024-01-05 00:00:00")
    h = scd2.snapshot_merge(h, src([("1", "x2", T0 + dt.timedelta(days=2)), ("3", "z", None)]), "id", "updated_at",
                            "2024-01-10 00:00:00")
    h = scd2.snapshot_merge(h, src([("1", "x2", T0 + dt.timedelta(days=2)), ("2", "y", T0), ("3", "z", None)]),
                            "id", "updated_at", "2024-01-20 00:00:00")
    got = rows(h, "id", "attr", "dbt_valid_from", "dbt_valid_to")
    assert got == [
        ("1", "x", T0, T0 + dt.timedelta(days=2)),
        ("1", "x2", T0 + dt.timedelta(days=2), None),
        ("2", "y", T0, dt.datetime(2024, 1, 10)),          # hard delete closed at run time
        ("2", "y", T0, None),                               # came back: new open row
        ("3", "z", dt.datetime(2024, 1, 10), None),         # NULL change time opens at run time
    ]
    # At most one open row per key.
    assert h.filter("dbt_valid_to is null").groupBy("id").count().filter("count > 1").count() == 0
    assert rows(scd2.as_of(h, "2024-01-02 00:00:00").filter("id = '1'"), "id", "attr") == [("1", "x")]
    # A key that returns with an unchanged change time reopens at that time, so
    # its new row overlaps the closed one (timestamp-strategy semantics).
    assert rows(scd2.as_of(h, "2024-01-02 00:00:00").filter("id = '2'"), "id", "attr") == [("2", "y"), ("2", "y")]


def test_history_from_changes(spark):
    ch = spark.createDataFrame([("1", T0), ("1", T0 + dt.timedelta(days=1))], "id string, ts timestamp_ntz")
    got = rows(scd2.history_from_changes(ch, "id", "ts"), "dbt_valid_from", "dbt_valid_to")
    assert got == [(T0, T0 + dt.timedelta(days=1)), (T0 + dt.timedelta(days=1), None)]


@pytest.mark.parametrize("check,clean,broken", [
    (Check("t", "not_null", "a"), [("x", 1)], [(None, 1)]),
    (Check("t", "unique", "a"), [("x", 1), ("y", 1)], [("x", 1), ("x", 2)]),
    (Check("t", "accepted_values", "a", values=("x", "y")), [("x", 1), (None, 1)], [("z", 1)]),
    (Check("t", "between", "n", min_value=0, max_value=5), [("x", 5), ("y", None)], [("x", 6)]),
    (Check("t", "pair_ge", "n", column_b="m", row_condition="a is not null"), [("x", 2)], [("x", 0)]),
    (Check("t", "relationships", "a", to_model="p", to_field="pk"), [("x", 1), (None, 1)], [("q", 1)]),
])
def test_quality_rules(spark, check, clean, broken):
    parent = spark.createDataFrame([("x",), ("y",)], "pk string")

    def frame(data):
        return spark.createDataFrame(data, "a string, n int").withColumn("m", F.lit(1))

    for data, expect in ((clean, 0), (broken, 1)):
        models = {"t": frame(data), "p": parent}
        assert quality.failing_rows(models["t"], check, models).count() == expect
        rep = quality.dq_report(spark, models, [check]).first()
        assert rep.failures == expect and rep.status == ("pass" if expect == 0 else "fail")


def test_type_rule_and_freshness(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), T0)], "d date, _loaded_at timestamp_ntz")
    rep = quality.dq_report(spark, {"t": df}, [Check("t", "type", "d", type_name="date")]).first()
    assert rep.failures == 0
    f = quality.freshness({"s": df}, {"s": "g"}, "2024-01-02 12:00:00").first()
    assert (f.age_hours, f.status) == (36.0, "warn")


def test_upsert_from_raw_prunes_and_matches(spark, wh):
    """Watermark on the raw (month-partitioned) extract, then stage == stage, then watermark."""
    from carespark.plans import scenarios, staging

    raw = wh.raw["cladjust"]
    assert "load_month" in raw.columns
    b1, b2 = scenarios.adjustment_batches(raw)
    root = tempfile.mkdtemp(prefix="carespark-raw-")
    t = upsert.IncrementalTable(spark, "adj", "claim_adjustment_id", root=root)
    t.upsert(b1, stage=staging.stg_cladjust)
    got = t.upsert(b2, stage=staging.stg_cladjust)
    first, second = staging.stg_cladjust(b1), staging.stg_cladjust(b2)
    expect = upsert.merge_upsert(first, upsert.after_watermark(second, upsert.watermark(first)), "claim_adjustment_id")
    assert got.count() == expect.count()
    assert got.exceptAll(expect.select(*got.columns)).count() == 0


def stored_files(table):
    """Data files of a stored table, by version folder."""
    import glob

    return {v: len(glob.glob(f"{table.path}/data/{v}/*/part-*")) for v in
            sorted(p.rsplit("/", 1)[1] for p in glob.glob(f"{table.path}/data/v-*"))}


def test_a_batch_rewrites_its_buckets_only(spark, tmp_path):
    t = upsert.IncrementalTable(spark, "t", "k", root=str(tmp_path), buckets=8)
    t.upsert(batch(spark, [(f"k{i}", "1", T0) for i in range(200)] + [(None, "n", T0), (None, "n", T0)]))
    day = dt.timedelta(days=1)
    t.upsert(batch(spark, [("k7", "2", T0 + day)]))
    assert list(stored_files(t).values()) == [8, 1]  # one bucket of eight was written again
    t.upsert(batch(spark, [("k7", "3", T0 + 2 * day), ("new", "1", T0 + 2 * day), (None, "m", T0 + 2 * day)]))
    assert 1 <= stored_files(t)["v-000003"] <= 3
    got = {r.k: r.v for r in t.read().collect() if r.k}
    assert got["k7"] == "3" and got["new"] == "1" and len(got) == 201 and t.count() == 204
    assert sorted(r.v for r in t.read().collect() if r.k is None) == ["m", "n", "n"]
    # The commit records keep statistics, and an older version stays readable.
    assert t.watermark() == T0 + 2 * day and t.read(record=t.record(1)).count() == 202
    again = upsert.IncrementalTable(spark, "t", "k", root=str(tmp_path), buckets=99)
    assert again.version() == 3 and again.current()["buckets"] == 8
    again.upsert(batch(spark, [("k7", "3", T0 + 2 * day)]))
    assert again.version() == 3  # a replay writes nothing


def test_the_watermark_reads_no_data(spark, tmp_path):
    import glob
    import os

    t = upsert.IncrementalTable(spark, "t", "k", root=str(tmp_path))
    t.upsert(batch(spark, [("a", "1", T0), ("b", "1", None)]))
    for f in glob.glob(f"{t.path}/data/*/*/part-*"):
        os.chmod(f, 0o600)
        open(f, "w").close()  # unreadable as parquet
    fresh = upsert.IncrementalTable(spark, "t", "k", root=str(tmp_path))
    assert fresh.watermark() == T0 and fresh.count() == 2


def test_a_half_written_version_is_not_seen(spark, tmp_path):
    t = upsert.IncrementalTable(spark, "t", "k", root=str(tmp_path))
    t.upsert(batch(spark, [("a", "1", T0)]))
    batch(spark, [("x", "half", T0)]).write.parquet(f"{t.path}/data/v-000002/_part=0")  # no commit record
    assert rows(t.read(), "k", "v") == [("a", "1")]
    t.upsert(batch(spark, [("a", "2", T0 + dt.timedelta(days=1))]))
    assert rows(t.read(), "k", "v") == [("a", "2")]
    with pytest.raises(Exception, match="(?i)exist"):
        t._commit({"version": 2})  # a second writer of the same version


def test_stored_schema_history(spark, tmp_path):
    t = upsert.IncrementalTable(spark, "t", "k", root=str(tmp_path))
    t.upsert(batch(spark, [("a", "1", T0), ("b", "1", T0)]))
    later = T0 + dt.timedelta(days=1)
    t.upsert(batch(spark, [("a", "2", later)]).withColumn("extra", F.lit("x")))
    assert rows(t.read(), "k", "v", "extra") == [("a", "2", "x"), ("b", "1", None)]
    t.upsert(batch(spark, [("b", "3", later + dt.timedelta(days=1))]))  # an old writer without the column
    assert rows(t.read(), "k", "v", "extra") == [("a", "2", "x"), ("b", "3", None)]
    assert t.schema(t.record(1)).names == ["k", "v", "_loaded_at"]
    last = later + dt.timedelta(days=2)
    with pytest.raises(ValueError, match="duplicate k in incremental batch: c"):
        t.upsert(batch(spark, [("c", "1", last), ("c", "2", last)]).withColumn("more", F.lit(1)))
    with pytest.raises(ValueError, match="column v was string"):
        t.upsert(batch(spark, [("a", "1", last)]).withColumn("v", F.lit(1)))
    assert t.version() == 3


def test_changes_of_an_upsert(spark, tmp_path):
    t = upsert.IncrementalTable(spark, "t", "k", root=str(tmp_path))
    t.upsert(batch(spark, [("a", "1", T0), ("b", "1", T0)]))
    t.upsert(batch(spark, [("a", "2", T0 + dt.timedelta(days=1)), ("c", "1", T0 + dt.timedelta(days=1))]))
    new, old = t.changes()
    assert rows(new, "k", "v") == [("a", "2"), ("c", "1")] and rows(old, "k", "v") == [("a", "1")]
    new, old = t.changes(1)
    assert new.count() == 2 and old.count() == 0


def test_stored_snapshots(spark, tmp_path):
    def src(data):
        return spark.createDataFrame(data, "id string, attr string, updated_at timestamp_ntz")

    runs = [(dt.datetime(2024, 1, 5), src([("1", "x", T0), ("2", "y", T0), (None, "n", T0)])),
            (dt.datetime(2024, 1, 10), src([("1", "x2", T0 + dt.timedelta(days=2)), ("3", "z", None), (None, "n", T0)])),
            (dt.datetime(2024, 1, 20), src([("1", "x2", T0 + dt.timedelta(days=2)), ("2", "y", T0), ("3", "z", None), (None, "n", T0)]))]
    table, plan = scd2.SnapshotTable(spark, str(tmp_path / "s"), "id", "updated_at"), None
    for at, source in runs:
        plan = scd2.snapshot_merge(plan, source, "id", "updated_at", at)
        table.run(source, at)
        table.run(source, at)  # replayed
    assert rows(table.read(), *plan.columns) == rows(plan, *plan.columns)
    assert table.version() == 3 and set(table.current()["parts"]) == {"open", "closed-000002"}
    # What a run closed is never written again, and a run reads the open part only.
    assert table.current()["parts"]["closed-000002"]["version"] == 2
    with pytest.raises(ValueError, match="after one at"):
        table.run(runs[0][1], runs[0][0])
    opened = table.read(["open"])
    step = scd2.snapshot_step(opened, runs[2][1], "id", "updated_at", dt.datetime(2024, 2, 1))
    assert step._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1


def test_stream_replays_and_late_rows(spark, tmp_path):
    from carespark.streaming.upsert_stream import drain, merge_epoch

    def load(data, name):
        for i, row in enumerate(data):
            batch(spark, [row]).coalesce(1).write.parquet(f"{tmp_path}/{name}/load-{i}")
        return batch(spark, data).schema

    hour = dt.timedelta(hours=1)
    first = [("a", "1", T0 + 5 * hour), ("b", "1", T0), ("c", "1", T0 + 2 * hour)]  # the files' load times go back and forth
    second = [("a", "2", T0 + 9 * hour), ("d", "late", T0 + 5 * hour), ("b", "2", T0 + 6 * hour), ("e", "none", None), ("a", "older", T0 + 7 * hour)]
    tables = []
    for files in (1, None):
        t = upsert.IncrementalTable(spark, f"t{files}", "k", root=str(tmp_path / "tables"))
        for n, data in (("first", first), ("second", second)):
            schema = load(data, f"{n}{files}")
            drain(spark, f"{tmp_path}/{n}{files}/load-*", schema, lambda df: df, t, f"{tmp_path}/cp-{n}{files}", files)
        assert rows(t.read(), "k", "v") == [("a", "2"), ("b", "2"), ("c", "1")]
        assert {r.v for r in t.late().collect()} >= {"late", "none"}
        tables.append(t)
    # One file an epoch: what lost to a newer row of its key is in the side table.
    assert {r.v for r in tables[0].late().collect()} == {"late", "none", "older"}
    version = tables[0].version()
    assert not merge_epoch(tables[0], batch(spark, [("a", "again", T0 + 99 * hour)]), 0, f"{tmp_path}/cp-second1", lambda df: df)
    assert tables[0].version() == version

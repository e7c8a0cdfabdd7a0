"""Compaction of a streamed table, and the report of rows that can't be published."""

import datetime as dt
import json

from pyspark.sql import functions as F

from trendlake.schema import OBS
from trendlake.sinks.tables import publish_messages, publish_report
from trendlake.streaming import compaction as cp
from trendlake.streaming.ingest import await_all, default_checkpoint, read_observations, run_stream, text_source


def observations(spark, days, locations=("A", "B", "C"), start=dt.date(2020, 1, 1)):
    rows = [(loc, start + dt.timedelta(i), float(i)) for loc in locations for i in days]
    d = spark.createDataFrame(rows, "location string, date date, new_cases double")
    return d.select(*[F.col(f.name) if f.name in d.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in OBS.fields])


def ingest(spark, base, obs, name="ingest"):
    publish_messages(obs.repartition(3), f"{base}/landing_{name}")
    await_all(run_stream(text_source(spark, f"{base}/landing_{name}"), f"{base}/table", default_checkpoint(f"{base}/table", name), name))


def found(spark, base):
    return sorted((r["location"], str(r["date"]), r["new_cases"]) for r in read_observations(spark, f"{base}/table").collect())


def read_files(df):
    """How many files a read of all rows opens, by Spark's own count."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().get("numFiles").get().value() for i in range(leaves.size()))


def test_readers_rounds_and_late_rows(spark, tmp_dir):
    table, ckpt = f"{tmp_dir}/table", default_checkpoint(f"{tmp_dir}/table", "ingest")
    every = []
    for k in range(3):
        part = range(k, 90, 4)
        ingest(spark, tmp_dir, observations(spark, part))
        every += [(loc, i) for loc in "ABC" for i in part]
    publish_messages(observations(spark, [0]).limit(1).withColumn("date", F.lit(None).cast("date")), f"{tmp_dir}/landing_ingest")
    ingest(spark, tmp_dir, observations(spark, []))
    before = found(spark, tmp_dir)
    assert len(before) == len(every) + 1
    early = read_observations(spark, table)  # planned before
    n_files = read_files(early)
    assert cp.compact(spark, table, [ckpt], dt.date(2020, 3, 15)) == [dt.date(2020, 1, 1), dt.date(2020, 2, 1)]
    assert found(spark, tmp_dir) == before == sorted((r["location"], str(r["date"]), r["new_cases"]) for r in early.collect())
    assert read_files(read_observations(spark, table)) < n_files / 2  # covered folders are pruned
    assert cp.compact(spark, table, [ckpt], dt.date(2020, 3, 15)) == []  # nothing new
    ingest(spark, tmp_dir, observations(spark, range(3, 20, 4)))  # late rows of January
    late = found(spark, tmp_dir)
    assert len(late) == len(before) + 15
    february = {r["gen"] for r in cp.manifest(spark, table) if r["month"] == dt.date(2020, 2, 1)}
    assert cp.compact(spark, table, [ckpt], dt.date(2020, 1, 1)) == [dt.date(2020, 1, 1)]  # the cutoff stays in February
    assert found(spark, tmp_dir) == late
    assert february == {r["gen"] for r in cp.manifest(spark, table) if r["month"] == dt.date(2020, 2, 1)}  # not rewritten
    assert read_files(read_observations(spark, table, start="2020-02-01", end="2020-02-29")) <= 2


def test_uncommitted_batches_and_failed_runs_change_nothing(spark, tmp_dir):
    table, ckpt = f"{tmp_dir}/table", default_checkpoint(f"{tmp_dir}/table", "ingest")
    ingest(spark, tmp_dir, observations(spark, range(40)))
    before = found(spark, tmp_dir)
    stream, last = cp.committed(spark, ckpt)
    extra = observations(spark, [2], ("Z",)).withColumn("month", F.trunc("date", "month"))
    extra.write.partitionBy("month").parquet(f"{table}/stream={stream}/batch={last + 1}")  # written, not committed
    # data of a run that ended before its manifest
    extra.write.partitionBy("month").parquet(f"{table}_compacted/gen=lost")
    cp.compact(spark, table, [ckpt], dt.date(2020, 2, 1))
    assert [r for r in found(spark, tmp_dir) if r[0] != "Z"] == before
    assert len([r for r in found(spark, tmp_dir) if r[0] == "Z"]) == 1  # once, from its batch
    assert cp.committed(spark, f"{tmp_dir}/nowhere") is None


def test_two_streams_into_one_table(spark, tmp_dir):
    for name in ("one", "two"):
        ingest(spark, tmp_dir, observations(spark, range(35), (name,)), name)
    table = f"{tmp_dir}/table"
    before = found(spark, tmp_dir)
    cp.compact(spark, table, [default_checkpoint(table, "one")], dt.date(2020, 2, 1))
    assert found(spark, tmp_dir) == before
    cp.compact(spark, table, [default_checkpoint(table, n) for n in ("one", "two")], dt.date(2020, 2, 1))
    assert found(spark, tmp_dir) == before and len(before) == 70


def test_row_groups_of_other_locations_are_skipped(spark, tmp_dir):
    """A month's file is sorted by location, so its statistics part the locations."""
    import glob

    import pyarrow.parquet as pq
    ingest(spark, tmp_dir, observations(spark, range(20), [f"L{i:02d}" for i in range(30)]))
    table = f"{tmp_dir}/table"
    cp.compact(spark, table, [default_checkpoint(table, "ingest")], dt.date(2020, 2, 1))
    names = [pq.read_table(f, columns=["location"], partitioning=None)["location"].to_pylist() for f in glob.glob(f"{table}_compacted/gen=*/month=*/*.parquet")]
    assert names and all(n == sorted(n) for n in names)


def test_publish_report(spark, tmp_dir):
    obs = observations(spark, range(5))
    bad = obs.withColumn("location", F.when(F.col("date") != "2020-01-02", F.col("location")).otherwise(F.lit(None)))
    bad = bad.withColumn("new_cases", F.when(F.col("date") == "2020-01-03", F.lit(float("nan"))).otherwise(F.col("new_cases")))
    long = observations(spark, [9], ("L" * 5000,))
    told = publish_report(bad.unionByName(long), tmp_dir, max_bytes=2000)
    assert (told["sent"], told["failed"]) == (9, 7)
    failed = [json.loads(r["value"]) for r in spark.read.text(f"{told['run']}/status=failed").collect()]
    assert sorted(r["reason"] for r in failed) == ["message too long"] + ["no location"] * 3 + ["not a finite number"] * 3
    assert all("new_cases" in r["value"] for r in failed)
    await_all(run_stream(text_source(spark, f"{told['run']}/status=sent"), f"{tmp_dir}/table", f"{tmp_dir}/ckpt", "sent"))
    assert read_observations(spark, f"{tmp_dir}/table").count() == 9
    again = publish_report(obs.limit(0), tmp_dir)
    assert (again["sent"], again["failed"]) == (0, 0) and again["run"] != told["run"]


def test_merge_keeps_the_latest_row_of_a_key(spark, tmp_dir):
    table, ckpt = f"{tmp_dir}/table", default_checkpoint(f"{tmp_dir}/table", "ingest")
    obs = observations(spark, range(40))
    ingest(spark, tmp_dir, obs)
    cp.compact(spark, table, [ckpt], dt.date(2021, 1, 1), keys=["location", "date"])
    newer = obs.filter("location = 'B' and date < '2020-01-11'").withColumn("new_cases", F.col("new_cases") + 1000)
    lost = observations(spark, [1, 1], ("A",)).withColumn("location", F.lit(None).cast("string"))
    ingest(spark, tmp_dir, newer.unionByName(lost))
    assert cp.compact(spark, table, [ckpt], dt.date(2021, 1, 1), keys=["location", "date"]) == [dt.date(2020, 1, 1)]
    got = read_observations(spark, table).collect()
    assert len(got) == 122 and sum(r["location"] is None for r in got) == 2
    assert {r["new_cases"] for r in got if r["location"] == "B" and r["date"] < dt.date(2020, 1, 11)} == {1000.0 + i for i in range(10)}
    assert {r["new_cases"] for r in got if r["location"] == "A"} == {float(i) for i in range(40)}

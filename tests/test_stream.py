"""Streaming ingest: restart with new files (Q10), quarantine, batch = stream parse."""

import os

from pyspark.sql import functions as F

from trendlake.streaming.ingest import await_all, encode, parse, read_observations, run_stream, text_source

LINES_1 = ['{"location":"A","date":"2020-01-01","new_cases":1}',
           '{"location":"A","date":"2020-01-02","new_cases":2}',
           "not json"]
LINES_2 = ['{"location":"B","date":"2020-01-01","new_cases":3}']


def _land(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def test_stream_restart_and_quarantine(spark, tmp_dir):
    land, table, ckpt, quar = (f"{tmp_dir}/{p}" for p in ("landing", "table", "ckpt", "quarantine"))
    _land(land, "f1.json", LINES_1)
    await_all(run_stream(text_source(spark, land), table, ckpt, "t_restart", quarantine_path=quar, keep_bad=False))
    assert read_observations(spark, table).count() == 2
    _land(land, "f2.json", LINES_2)
    await_all(run_stream(text_source(spark, land), table, ckpt, "t_restart", quarantine_path=quar, keep_bad=False))
    got = read_observations(spark, table)
    assert got.count() == 3
    assert got.groupBy("location", "date").count().filter("count > 1").count() == 0
    assert spark.read.parquet(quar).count() == 1


def test_stream_keep_bad_like_reference(spark, tmp_dir):
    land = f"{tmp_dir}/landing"
    _land(land, "f1.json", LINES_1)
    await_all(run_stream(text_source(spark, land), f"{tmp_dir}/t", f"{tmp_dir}/c", "t_keep", keep_bad=True))
    assert spark.read.parquet(f"{tmp_dir}/t").count() == 3


def test_rate_limited_available_now(spark, tmp_dir):
    land = f"{tmp_dir}/landing"
    for i in range(3):
        _land(land, f"f{i}.json", [f'{{"location":"A","date":"2020-01-0{i + 1}","new_cases":{i}}}'])
    qs = run_stream(text_source(spark, land, max_files_per_trigger=1), f"{tmp_dir}/t", f"{tmp_dir}/c", "t_rate")
    await_all(qs)
    assert spark.read.parquet(f"{tmp_dir}/t").count() == 3
    assert len([p for p in qs[0].recentProgress if p["numInputRows"] > 0]) == 3


def test_dedup_replays(spark, tmp_dir):
    land = f"{tmp_dir}/landing"
    _land(land, "f1.json", LINES_1[:2] * 3)
    await_all(run_stream(text_source(spark, land), f"{tmp_dir}/t", f"{tmp_dir}/c", "t_dedup",
                         dedup_delay="1 day"))
    assert spark.read.parquet(f"{tmp_dir}/t").count() == 2


def test_batch_equals_stream(spark, tmp_dir):
    from trendlake.sources.tables import observations
    obs = observations(spark, "/root/testdata/sf0.001")
    land = f"{tmp_dir}/landing"
    encode(obs).write.text(land)
    batch = parse(spark.read.text(land), keep_corrupt=False)
    await_all(run_stream(text_source(spark, land), f"{tmp_dir}/t", f"{tmp_dir}/c", "t_eq", keep_bad=False))
    stream = read_observations(spark, f"{tmp_dir}/t")
    assert batch.exceptAll(stream).count() == 0 and stream.exceptAll(batch).count() == 0
    assert stream.exceptAll(obs.select(*stream.columns)).count() == 0


def test_encode_keeps_nulls(spark):
    df = spark.createDataFrame([("A", None)], "location string, new_cases double")
    v = encode(df).first().value
    assert '"new_cases":null' in v and '"date":null' in v
    assert F is not None


def test_csv_by_header_name(spark, tmp_dir):
    from trendlake.sources.files import read_csv
    p = f"{tmp_dir}/rows.csv"
    with open(p, "w") as f:
        f.write("iso_code,new_cases,location,date,extra,total_cases\n")
        f.write("X1,1.5,A,2020-01-01,zz,NaN\n")
        f.write("X2,oops,B,2020-01-02,,7\n")
    got = {r.location: r for r in read_csv(spark, p).collect()}
    assert got["A"].new_cases == 1.5 and got["A"].total_cases is None and got["A"].date == "2020-01-01"
    assert got["B"].new_cases is None and got["B"].total_cases == 7.0 and got["B"].new_deaths is None
    inferred = read_csv(spark, p, infer=True)
    assert "iso_code" in inferred.columns and len(inferred.columns) == 6


def test_publish_all_columns_parses_wire_fields(spark, tmp_dir):
    from trendlake.sinks.tables import publish_messages
    from trendlake.sources.files import read_csv
    p = f"{tmp_dir}/rows.csv"
    with open(p, "w") as f:
        f.write("iso_code,new_cases,location,date\nX1,1.5,A,2020-01-01\n")
    publish_messages(read_csv(spark, p, infer=True), f"{tmp_dir}/landing", all_columns=True)
    r = parse(spark.read.text(f"{tmp_dir}/landing")).first()
    assert (r.location, str(r.date), r.new_cases, r._corrupt_record) == ("A", "2020-01-01", 1.5, None)


def test_replayed_batch_is_written_once(spark, tmp_dir):
    """A crash after writing a batch but before committing it replays the batch: no duplicates."""
    import shutil
    land, table, quar = f"{tmp_dir}/landing", f"{tmp_dir}/table", f"{tmp_dir}/bad"
    _land(land, "f1.json", LINES_1)
    await_all(run_stream(text_source(spark, land), table, f"{tmp_dir}/ckpt", "t_replay",
                         quarantine_path=quar, keep_bad=False))
    # the checkpoint as it was before batch 0's commit marker was written
    shutil.copytree(f"{tmp_dir}/ckpt", f"{tmp_dir}/ckpt_crashed",
                    ignore=lambda d, names: ["0", ".0.crc"] if d.endswith("commits") else [])
    qs = run_stream(text_source(spark, land), table, f"{tmp_dir}/ckpt_crashed", "t_replay2",
                    quarantine_path=quar, keep_bad=False)
    await_all(qs)
    assert any(p["batchId"] == 0 and p["numInputRows"] > 0 for p in qs[0].recentProgress)  # really replayed
    assert read_observations(spark, table).count() == 2
    assert spark.read.parquet(quar).count() == 1


def _ingest_cli(*args):
    from trendlake.__main__ import main
    return main(["--master", "local[4]", "ingest", *args])


def test_cli_goes_on_where_it_stopped(spark, tmp_dir):
    """Default settings, three runs, each with a new message: nothing is skipped or replaced."""
    for mode, extra in (("plain", []), ("quarantined", ["--quarantine", f"{tmp_dir}/q", "--drop-bad"])):
        land, table = f"{tmp_dir}/{mode}/landing", f"{tmp_dir}/{mode}/table"
        for n in (1, 2, 3):
            _land(land, f"f{n}.json", [f'{{"location":"A","date":"2020-01-0{n}","new_cases":{n}}}'])
            assert _ingest_cli("--landing", land, "--table", table, "--name", f"cli_{mode}", *extra) == 0
            assert read_observations(spark, table).count() == n


def test_cli_keeps_malformed_rows_unless_quarantined(spark, tmp_dir):
    import pytest
    land = f"{tmp_dir}/landing"
    _land(land, "f.json", [LINES_1[0], "not json", '{"location":"B","date":"2020-01-02","new_cases":"x","total_cases":4}'])
    _ingest_cli("--landing", land, "--table", f"{tmp_dir}/t", "--name", "cli_keep")
    assert read_observations(spark, f"{tmp_dir}/t").count() == 3
    _ingest_cli("--landing", land, "--table", f"{tmp_dir}/t2", "--name", "cli_drop", "--quarantine", f"{tmp_dir}/q", "--drop-bad")
    got = {r.location: r for r in read_observations(spark, f"{tmp_dir}/t2").collect()}
    assert set(got) == {"A", "B"} and got["B"].new_cases is None and got["B"].total_cases == 4.0
    assert spark.read.parquet(f"{tmp_dir}/q").count() == 2
    with pytest.raises(SystemExit):
        _ingest_cli("--landing", land, "--table", f"{tmp_dir}/t3", "--drop-bad")


def test_modes_share_one_layout_and_new_checkpoints_add(spark, tmp_dir):
    land, table = f"{tmp_dir}/landing", f"{tmp_dir}/table"
    _land(land, "f1.json", LINES_1[:1])
    await_all(run_stream(text_source(spark, land), table, f"{tmp_dir}/c", "t_mode"))
    _land(land, "f2.json", LINES_2)
    await_all(run_stream(text_source(spark, land), table, f"{tmp_dir}/c", "t_mode", quarantine_path=f"{tmp_dir}/q"))
    assert read_observations(spark, table).count() == 2
    other = f"{tmp_dir}/other"
    _land(other, "f3.json", ['{"location":"C","date":"2020-01-01"}'])
    await_all(run_stream(text_source(spark, other), table, f"{tmp_dir}/c2", "t_mode2"))
    assert read_observations(spark, table).count() == 3


def test_plain_file_sink_tables_are_refused(spark, tmp_dir):
    import pytest
    land = f"{tmp_dir}/landing"
    _land(land, "f1.json", LINES_1)
    os.makedirs(f"{tmp_dir}/t/_spark_metadata")
    with pytest.raises(ValueError):
        run_stream(text_source(spark, land), f"{tmp_dir}/t", f"{tmp_dir}/c", "t_old")

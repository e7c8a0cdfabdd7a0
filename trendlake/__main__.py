"""Command line: the four stages as Spark jobs.

  python -m trendlake publish  --csv rows.csv --landing DIR            (CSV → JSON messages)
  python -m trendlake ingest   --landing DIR --table DIR [--quarantine DIR]
                               [--kafka-servers H --topic T]            (messages → parquet, availableNow)
  python -m trendlake backtest --table DIR --predictions DIR [--models trend_dow,rf] [--locations A,B]
  python -m trendlake analyze  --predictions DIR --kind summary_statistics --out DIR [--location L]

A stream's progress is kept in ``<table>_checkpoint/<name>``, so running it again goes on
where it stopped; ``--checkpoint`` names another folder. Malformed messages stay in the
table with nulls, as in the reference; ``--quarantine`` records them, too.
"""

from __future__ import annotations

import argparse
import sys

from trendlake.schema import ANALYSIS_KINDS, CHART_KINDS
from trendlake.session import checkpoint_dir, get_spark


def _csv_list(v: str | None) -> list[str] | None:
    return [x for x in v.split(",") if x] if v else None


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="trendlake")
    ap.add_argument("--master", default=None, help="Spark master (default: from the launcher)")
    sub = ap.add_subparsers(dest="cmd", required=True)

    p = sub.add_parser("publish", help="CSV rows → one JSON message per row")
    p.add_argument("--csv", required=True)
    p.add_argument("--all-columns", action="store_true", help="send every CSV column, not only the 12 fields")
    p.add_argument("--landing")
    p.add_argument("--kafka-servers")
    p.add_argument("--topic")

    p = sub.add_parser("ingest", help="messages → date-checked parquet table")
    p.add_argument("--landing")
    p.add_argument("--kafka-servers")
    p.add_argument("--topic")
    p.add_argument("--max-per-trigger", type=int, default=None)
    p.add_argument("--table", required=True)
    p.add_argument("--quarantine")
    p.add_argument("--checkpoint")
    p.add_argument("--name", default="trendlake_ingest")
    p.add_argument("--drop-bad", action="store_true",
                   help="leave rows without location or date out of the table (needs --quarantine)")
    p.add_argument("--partition-by", choices=["month", "date"], default="month")

    p = sub.add_parser("backtest", help="observations → prediction table")
    p.add_argument("--table", required=True)
    p.add_argument("--predictions", required=True)
    p.add_argument("--models", default="trend_dow")
    p.add_argument("--locations")
    p.add_argument("--combine", action="store_true", help="reference's single combined row")
    p.add_argument("--models-dir", help="save fitted models / the windowed model's state here")
    p.add_argument("--yearly", action="store_true", help="add the month-of-year term to the windowed model")

    p = sub.add_parser("analyze", help="prediction table → analysis tables")
    p.add_argument("--predictions", required=True)
    p.add_argument("--kind", choices=ANALYSIS_KINDS, required=True)
    p.add_argument("--location")
    p.add_argument("--filter-location", action="store_true")
    p.add_argument("--approx", action="store_true", help="approximate quartiles (bounded memory)")
    p.add_argument("--metric", help="metric to compare (data_analysis)")
    p.add_argument("--chart", choices=CHART_KINDS, help="chart type (interactive)")
    p.add_argument("--x", help="x column (interactive)")
    p.add_argument("--y", help="y column (interactive)")
    p.add_argument("--color", help="colour column (interactive)")
    p.add_argument("--ci", choices=["normal", "bootstrap"], help="interval of line and bar charts (interactive)")
    p.add_argument("--out", required=True)

    a = ap.parse_args(argv)
    if a.cmd == "analyze" and a.kind == "interactive" and not (a.chart and a.x):
        ap.error("--kind interactive needs --chart and --x")
    spark = get_spark(a.master)
    checkpoint_dir(spark)

    if a.cmd == "publish":
        from trendlake.sinks.tables import publish_messages
        from trendlake.sources.files import read_csv
        from trendlake.sources.kafka import sink_options
        df = read_csv(spark, a.csv, infer=a.all_columns)
        kopts = sink_options(a.kafka_servers, a.topic) if a.kafka_servers else None
        publish_messages(df, a.landing, kopts, all_columns=a.all_columns)
    elif a.cmd == "ingest":
        from trendlake.sources.kafka import source_options
        from trendlake.streaming.ingest import await_all, default_checkpoint, kafka_source, run_stream, text_source
        if a.drop_bad and not a.quarantine:
            ap.error("--drop-bad needs --quarantine, or the rows would be lost")
        if a.kafka_servers:
            stream = kafka_source(spark, source_options(a.kafka_servers, a.topic,
                                                        max_offsets_per_trigger=a.max_per_trigger))
        else:
            stream = text_source(spark, a.landing, a.max_per_trigger)
        ckpt = a.checkpoint or default_checkpoint(a.table, a.name)
        await_all(run_stream(stream, a.table, ckpt, a.name, quarantine_path=a.quarantine,
                             keep_bad=not a.drop_bad, partition_by=a.partition_by))
    elif a.cmd == "backtest":
        from trendlake.plans.jobs import backtest
        from trendlake.sinks.tables import write_predictions
        from trendlake.streaming.ingest import read_observations
        obs = read_observations(spark, a.table)
        out = backtest(obs, _csv_list(a.locations), tuple(_csv_list(a.models)), combine=a.combine,
                       model_dir=a.models_dir,
                       seasonality=("weekly", "yearly") if a.yearly else ("weekly",))
        write_predictions(out, a.predictions)
    elif a.cmd == "analyze":
        from trendlake.plans.analyze import analyze, load
        df = load(spark, a.predictions)  # kept in memory until the command ends
        for name, res in analyze(df, a.kind, a.location, a.filter_location, approx=a.approx, metric=a.metric,
                                 chart=a.chart, x=a.x, y=a.y, color=a.color, ci=a.ci).items():
            res.write.mode("overwrite").parquet(f"{a.out.rstrip('/')}/{name}")
        df.unpersist()
    return 0


if __name__ == "__main__":
    sys.exit(main())

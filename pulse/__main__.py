"""Command line: start the stream jobs, print the report documents, compact tables.

    python -m pulse dau --topic startup_log --kafka host:9092 --table T --checkpoint C
    python -m pulse dau --topic startup_log --topic-path /topics --table T --checkpoint C --mode state
    python -m pulse collect --topic raw_log --kafka host:9092 --landing L --topics /topics --checkpoint C
    python -m pulse cdc --topic changes --kafka host:9092 --out /topics/topic=order_info --checkpoint C
    python -m pulse orders --topic order_info --kafka host:9092 --table T --checkpoint C
    python -m pulse first-seen --topic startup_log --kafka host:9092 --table T --checkpoint C
    python -m pulse report total --dau T1 --orders T2 --date 2024-01-15
    python -m pulse report hour --id dau --dau T1 --orders T2 --date 2024-01-15
    python -m pulse report detail --tables DIR --start 0 --length 20 --keyword "red ring" --order sku_price:desc
    python -m pulse compact --table T --day-col logDate --days 2024-01-13,2024-01-14

Run it with ``spark-submit`` on a cluster (master, executors and
``spark.checkpoint.dir`` come from there).
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession


def _source(spark: SparkSession, args) -> DataFrame:
    from pulse.sources.topics import read_changes, read_topic
    if args.topic_log:
        opts = {"startingOffsets": args.starting_offsets, "group": args.group or args.cmd}
        most = args.max_per_trigger or (100 if args.cmd == "cdc" else None)
        return read_topic(spark, args.topic, "log", args.topic_log, opts, most, args.min_partitions)
    if args.cmd == "cdc":  # bounded micro-batches, as a change client fetches
        kafka = {"kafka.bootstrap.servers": args.kafka, "startingOffsets": args.starting_offsets} if args.kafka else None
        return read_changes(spark, args.topic, "kafka" if args.kafka else "parquet", args.topic_path, kafka, args.max_per_trigger or 100)
    if args.kafka:
        return read_topic(spark, args.topic, "kafka", options={"kafka.bootstrap.servers": args.kafka,
                                                               "startingOffsets": args.starting_offsets},
                          max_per_trigger=args.max_per_trigger, min_partitions=args.min_partitions)
    return read_topic(spark, args.topic, "parquet", path=args.topic_path, max_per_trigger=args.max_per_trigger)


def _stream_args(p: argparse.ArgumentParser) -> None:
    p.add_argument("--topic", required=True)
    g = p.add_mutually_exclusive_group(required=True)
    g.add_argument("--kafka", help="bootstrap servers")
    g.add_argument("--topic-path", help="folder holding topic=<name>/ file topics")
    g.add_argument("--topic-log", help="folder holding topic=<name>/ topic logs")
    p.add_argument("--group", default=None, help="topic logs: name under which the position is kept (default: the command)")
    p.add_argument("--starting-offsets", default="latest")
    p.add_argument("--max-per-trigger", type=int, default=None)
    p.add_argument("--min-partitions", type=int, default=None)
    p.add_argument("--checkpoint", required=True)
    p.add_argument("--trigger", default=None, help="interval such as '5 seconds', or available_now")


def _kpi_tables(spark: SparkSession, args):
    from pulse.streaming.jobs import DAU_KEYS, read_orders
    from pulse.streaming.sinks import read_latest
    return read_latest(spark, args.dau, DAU_KEYS), read_orders(spark, args.orders)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="python -m pulse")
    sub = ap.add_subparsers(dest="cmd", required=True)

    p = sub.add_parser("collect", help="stamp, land and route raw log lines")
    _stream_args(p)
    p.add_argument("--landing", required=True)
    p.add_argument("--topics", required=True)

    p = sub.add_parser("cdc", help="relay order inserts from the change topic")
    _stream_args(p)
    p.add_argument("--out", required=True)
    p.add_argument("--quarantine", default=None, help="folder of undecodable lines (default <out>_quarantine)")
    p.add_argument("--table", dest="table_name", default="order_info")

    p = sub.add_parser("dau", help="first start per device and day")
    _stream_args(p)
    p.add_argument("--table", required=True)
    p.add_argument("--mode", choices=["table", "state", "ttl"], default="table")
    p.add_argument("--retention-days", type=int, default=None)
    p.add_argument("--state-partitions", type=int, default=None)
    p.add_argument("--compact-lag-days", type=int, default=None,
                   help="compact days finished this long ago")
    p.add_argument("--compact-every", type=int, default=100)

    p = sub.add_parser("orders", help="order table with first-order flags")
    _stream_args(p)
    p.add_argument("--table", required=True)
    p.add_argument("--mode", choices=["table", "state"], default="table")
    p.add_argument("--state-partitions", type=int, default=None)
    p.add_argument("--compact-lag-days", type=int, default=None,
                   help="compact days finished this long ago")
    p.add_argument("--compact-every", type=int, default=100)

    p = sub.add_parser("first-seen", help="first start ever per device")
    _stream_args(p)
    p.add_argument("--table", required=True)
    p.add_argument("--state-partitions", type=int, default=None)

    p = sub.add_parser("report", help="print a report document")
    p.add_argument("kind", choices=["total", "hour", "detail"])
    p.add_argument("--id", default="dau", help="metric of the hour report: dau or order_amount")
    p.add_argument("--dau", default=None)
    p.add_argument("--orders", default=None)
    p.add_argument("--first-seen", default=None, help="first-seen table: new devices of the day (with --kept)")
    p.add_argument("--kept", action="store_true", help="answer from the totals that the jobs keep next to their tables")
    p.add_argument("--date", default=None, help="required by total and hour, a filter of detail")
    p.add_argument("--tables", default=None, help="detail: folder of lineitem, orders and part")
    p.add_argument("--draw", type=int, default=1)
    p.add_argument("--start", type=int, default=0)
    p.add_argument("--length", type=int, default=10)
    p.add_argument("--keyword", default=None)
    p.add_argument("--level", default=None)
    p.add_argument("--order", action="append", default=[], metavar="COLUMN[:desc]", help="detail: sort order, repeatable")

    p = sub.add_parser("compact", help="rewrite finished days of a foreachBatch table")
    p.add_argument("--table", required=True)
    p.add_argument("--day-col", required=True)
    p.add_argument("--days", required=True, help="comma-separated yyyy-MM-dd")

    args = ap.parse_args(argv)
    from pulse.session import get_session
    spark = get_session(app_name=f"pulse-{args.cmd}")

    if args.cmd == "report" and args.kind == "detail":
        from pulse.operators import reports
        from pulse.sources import views
        order = [(c, d or "asc") for c, _, d in (o.partition(":") for o in args.order)]
        doc = reports.report_detail(views.sale_detail(spark, args.tables, views.GRID_SIDES), args.draw, args.start, args.length,
                                    args.date, args.keyword, args.level, order)
        print(doc.first()["doc"])
        return 0
    if args.cmd == "report":
        from pulse.operators import metrics, reports
        if args.kept:  # a few rows of totals a day instead of the tables
            from pulse.streaming import jobs
            hours, orders = jobs.read_device_hours(spark, args.dau), jobs.read_order_hours(spark, args.orders)
            doc = (reports.report_total(metrics.kpi_totals(hours, jobs.read_new_devices(spark, args.first_seen), orders, args.date))
                   if args.kind == "total" else reports.report_hour_totals(args.id, hours, orders, args.date))
        else:
            dau, orders = _kpi_tables(spark, args)
            doc = (reports.report_total(metrics.kpi_summary(dau, orders, args.date))
                   if args.kind == "total" else reports.report_hour(args.id, dau, orders, args.date))
        print(doc.first()["doc"])
        return 0
    if args.cmd == "compact":
        from pulse.streaming.sinks import compact_days
        n = compact_days(spark, args.table, args.day_col, [d for d in args.days.split(",") if d])
        print(f"compacted {n} rows")
        return 0

    from pulse.streaming import jobs
    src = _source(spark, args)
    # a bounded topic log is drained batch by batch; availableNow would take one of them
    drained = bool(args.topic_log) and args.trigger == "available_now"
    trig = "0 seconds" if drained else args.trigger
    if args.cmd == "collect":
        q = jobs.run_collector(src, args.landing, args.topics, args.checkpoint, trig)
    elif args.cmd == "cdc":
        q = jobs.run_cdc_relay(src, args.out, args.checkpoint, args.table_name, trigger=trig, quarantine=args.quarantine)
    elif args.cmd == "dau":
        if args.mode == "state":
            q = jobs.run_dau_keyed_state(src, args.table, args.checkpoint, trig, args.retention_days,
                                         args.state_partitions, args.compact_lag_days, args.compact_every)
        elif args.mode == "ttl":
            q = jobs.run_dau_ttl(src, args.table, args.checkpoint, trig, state_partitions=args.state_partitions)
        else:
            q = jobs.run_dau(src, args.table, args.checkpoint, trig, args.retention_days,
                             compact_lag_days=args.compact_lag_days, compact_every=args.compact_every)
    elif args.cmd == "orders":
        if args.mode == "state":
            q = jobs.run_orders_keyed_state(src, args.table, args.checkpoint, trig, args.state_partitions,
                                            args.compact_lag_days, args.compact_every)
        else:
            q = jobs.run_orders(src, args.table, args.checkpoint, trig,
                                compact_lag_days=args.compact_lag_days, compact_every=args.compact_every)
    else:
        q = jobs.run_first_seen(src, args.table, args.checkpoint, trig, args.state_partitions)
    if drained:
        from pulse.sources.topic_log import drain
        drain(q)
    elif trig == "available_now":
        q.awaitTermination()
    else:
        spark.streams.awaitAnyTermination()
    return 0


if __name__ == "__main__":
    sys.exit(main())

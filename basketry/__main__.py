"""Command line: ``spark-submit -m basketry <command> ...`` or
``python -m basketry <command> ...``.

Commands: stream, publish, conversion-report, validate-report, segments,
top-products, category-conversion, catalog, audit.
"""

from __future__ import annotations

import argparse

from basketry.session import build_session, scale_conf


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="basketry")
    p.add_argument("--master", default=None, help="only for local runs; clusters set it at submit")
    p.add_argument("--input-bytes", type=int, default=None,
                   help="size of the data a batch job scans; sizes splits and shuffle partitions (with --cores)")
    p.add_argument("--cores", type=int, default=None, help="total executor cores of the cluster")
    sub = p.add_subparsers(dest="command", required=True)

    s = sub.add_parser("stream", help="ingest the event stream into raw/processed/alerts")
    s.add_argument("--base-dir", required=True)
    src = s.add_mutually_exclusive_group(required=True)
    src.add_argument("--kafka", metavar="SERVERS")
    src.add_argument("--text-dir", metavar="DIR", help="folder of JSON-lines files (same value column)")
    s.add_argument("--topic", help="Kafka topic (with --kafka)")
    s.add_argument("--starting-offsets", default="earliest", help="earliest, latest or a JSON text (first start only)")
    s.add_argument("--max-offsets-per-trigger", type=int, default=None,
                   help="messages per micro-batch; without it the first batch is the whole topic")
    s.add_argument("--min-partitions", type=int, default=None, help="read tasks per micro-batch at least")
    s.add_argument("--kafka-option", action="append", default=[], metavar="KEY=VALUE",
                   help="any other source option, e.g. kafka.security.protocol=SASL_SSL (repeatable)")
    s.add_argument("--window", default="5 minutes")
    s.add_argument("--delay", default="5 minutes")
    s.add_argument("--alert-threshold", type=int, default=100)
    s.add_argument("--catalog", help="catalog folder (its newest version is read) for a per-event lookup")
    s.add_argument("--state-partitions", type=int, default=None,
                   help="state stores of each windowed output; fixed with the first checkpoint")
    s.add_argument("--available-now", action="store_true", help="process what is there, then stop")
    s.add_argument("--trigger-interval", default=None, help="micro-batch interval, e.g. '10 seconds'")
    s.add_argument("--max-files-per-trigger", type=int, default=None, help="file source only")
    s.add_argument("--raw-writers", type=int, default=None,
                   help="writers per (date, category) folder per micro-batch (salted shuffle)")
    s.add_argument("--rates", action="store_true", help="add the conversion rate to category metrics")
    s.add_argument("--rocksdb", action="store_true", help="keep window state in the RocksDB state store")

    s = sub.add_parser("publish", help="send the raw events to a Kafka topic as JSON messages")
    s.add_argument("--base-dir", required=True)
    s.add_argument("--kafka", metavar="SERVERS", required=True)
    s.add_argument("--topic", required=True)
    s.add_argument("--kafka-option", action="append", default=[], metavar="KEY=VALUE")

    for name in ("conversion-report", "segments", "top-products"):
        c = sub.add_parser(name)
        c.add_argument("--base-dir", required=True)
        c.add_argument("--as-of", default=None, help="YYYY-MM-DD (segments/top-products: default today)")
    sub.choices["top-products"].add_argument("--k", type=int, default=5)
    for name in ("validate-report", "category-conversion", "audit"):
        sub.add_parser(name).add_argument("--base-dir", required=True)
    c = sub.add_parser("catalog")
    c.add_argument("--csv", required=True)
    c.add_argument("--base-dir", required=True)
    return p


def _options(pairs: list[str]) -> dict[str, str]:
    """``KEY=VALUE`` arguments as options."""
    split = [p.partition("=") for p in pairs]
    if bad := [key for key, eq, _ in split if not key or not eq]:
        raise SystemExit(f"not KEY=VALUE: {', '.join(bad)}")
    return {key: value for key, _, value in split}


def kafka_options(args: argparse.Namespace) -> dict[str, str]:
    """The source options that the stream command's arguments ask for."""
    limits = {"maxOffsetsPerTrigger": args.max_offsets_per_trigger, "minPartitions": args.min_partitions}
    return {k: str(v) for k, v in limits.items() if v is not None} | _options(args.kafka_option)


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    sized = args.input_bytes and args.cores and args.command != "stream"
    extra = scale_conf(args.input_bytes, args.cores) if sized else None
    spark = build_session(args.master, app_name=f"basketry-{args.command}", extra_conf=extra,
                          rocksdb_state_store=getattr(args, "rocksdb", False),
                          state_partitions=getattr(args, "state_partitions", None))
    from basketry.plans import jobs

    if args.command == "stream":
        from basketry.sources.streams import kafka_source, text_source
        from basketry.streaming.jobs import StreamSettings, await_all, start_all, stop_all

        if args.kafka and not args.topic:
            raise SystemExit("--topic is required with --kafka")
        if args.kafka:
            messages = kafka_source(spark, args.kafka, args.topic, args.starting_offsets,
                                    extra_options=kafka_options(args))
        else:
            messages = text_source(spark, args.text_dir, max_files_per_trigger=args.max_files_per_trigger)
        catalog = jobs.latest_catalog(spark, args.catalog) if args.catalog else None
        if args.available_now:
            trigger = {"availableNow": True}
        elif args.trigger_interval:
            trigger = {"processingTime": args.trigger_interval}
        else:
            trigger = None
        settings = StreamSettings(window=args.window, delay=args.delay, alert_threshold=args.alert_threshold,
                                  trigger=trigger, raw_writers=args.raw_writers, with_rates=args.rates)
        queries = start_all(messages, args.base_dir, settings, catalog)
        try:
            if args.available_now:
                await_all(queries)
            else:
                spark.streams.awaitAnyTermination()
        finally:
            stop_all(queries)
        return 0
    if args.command == "conversion-report":
        out = jobs.conversion_report_job(spark, args.base_dir, args.as_of)
        out["report"].show(truncate=False)
        out["average"].show()
        out["top"].show(truncate=False)
        out["low_performers"].show(truncate=False)
    elif args.command == "validate-report":
        checks = jobs.validate_report_job(spark, args.base_dir)
        checks.show(truncate=False)
        if checks.filter("NOT passed").limit(1).count():
            return 1
    elif args.command == "segments":
        jobs.user_segmentation_job(spark, args.base_dir, args.as_of).show()
    elif args.command == "top-products":
        jobs.top_products_job(spark, args.base_dir, args.as_of, args.k).show(n=4 * args.k + 4, truncate=False)
    elif args.command == "category-conversion":
        jobs.category_conversion_job(spark, args.base_dir).show(truncate=False)
    elif args.command == "catalog":
        jobs.catalog_job(spark, args.csv, args.base_dir).show()
    elif args.command == "publish":
        from basketry.sinks.writers import publish_events
        from basketry.sources.files import read_raw_events
        from basketry.streaming.jobs import layout

        events = read_raw_events(spark, layout(args.base_dir)["raw"], missing_ok=False)
        publish_events(events, args.kafka, args.topic, _options(args.kafka_option))
    elif args.command == "audit":
        jobs.output_audit_job(spark, args.base_dir).show(truncate=False)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())

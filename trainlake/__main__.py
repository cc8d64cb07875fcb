"""Jobs for ``spark-submit`` or ``python -m trainlake``.

    refine   raw records (Kafka topics or landed files) → silver tables
    extract  landed API pages → the region's messages (Kafka or files)
    compact  fold appended lots into a partitioned snapshot
    audit    fail unless every silver table has rows

Cluster, memory, packages and store credentials are session settings: pass them to
``spark-submit`` with ``--conf`` / ``--packages``.
"""

import argparse
import logging
import sys

from pyspark.sql import SparkSession

from trainlake import schemas
from trainlake.plans import audit_silver, require_complete
from trainlake.plans.extract import MESSAGE_KEYS, regional_records, unparsed_records
from trainlake.plans.registry import DATASETS
from trainlake.sinks import compact, text_messages, write_kafka
from trainlake.sources import kafka_sources, read_pages, text_source
from trainlake.streaming import AVAILABLE_NOW, refine_all, wait_for_all


def _pairs(text: str) -> dict[str, str]:
    return dict(item.split("=", 1) for item in text.split(","))


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="trainlake", description=__doc__.split("\n")[0])
    jobs = parser.add_subparsers(dest="job", required=True)

    refine = jobs.add_parser("refine")
    refine.add_argument("--silver", required=True, help="base path of the silver tables")
    refine.add_argument("--checkpoints", required=True)
    refine.add_argument("--servers", help="Kafka bootstrap servers")
    refine.add_argument("--topics", type=_pairs, help="dataset=topic,dataset=topic,…")
    refine.add_argument("--landed", help="files below <landed>/<dataset>/ instead of Kafka")
    refine.add_argument("--every", help="trigger interval; without it, work off and stop")
    refine.add_argument("--rejects", help="also collect defective records below this path")
    refine.add_argument("--mode", choices=("snapshot", "append", "replace"), help="for all tables; without it, as each table is used to")
    refine.add_argument("--ttl", help="drop copies within the stream for that long (with --mode append)")
    refine.add_argument("--option", action="append", default=[], metavar="NAME=VALUE", help="source option, such as maxOffsetsPerTrigger=1000000 or kafka.security.protocol=SSL; may be repeated")

    extract = jobs.add_parser("extract")
    extract.add_argument("--pages", required=True, help="pages below <pages>/<dataset>/")
    extract.add_argument("--as-of", help="first day of availability (default: today, UTC)")
    extract.add_argument("--servers")
    extract.add_argument("--topics", type=_pairs)
    extract.add_argument("--out", help="write <out>/<dataset>/ as JSON lines instead of Kafka")
    extract.add_argument("--page-per-line", action="store_true")
    extract.add_argument("--axes", default=schemas.MAIN_AXIS, help="comma-separated")
    extract.add_argument("--station", default=schemas.MAIN_STATION, help="part of the departure station's name")
    extract.add_argument("--lat", type=float, nargs=2, default=schemas.REGION_LAT, metavar=("FROM", "TO"))
    extract.add_argument("--lon", type=float, nargs=2, default=schemas.REGION_LON, metavar=("FROM", "TO"))
    extract.add_argument("--rejects", help="also write records that can't be parsed below this path")
    extract.add_argument("--incomplete", action="store_true", help="go on although pages are missing")
    extract.add_argument("--option", action="append", default=[], metavar="NAME=VALUE", help="Kafka writer option; may be repeated")

    fold = jobs.add_parser("compact")
    fold.add_argument("--silver", required=True)
    fold.add_argument("--dataset", required=True, choices=sorted(DATASETS))
    fold.add_argument("--drop-lots", action="store_true")
    fold.add_argument("--drop-after-hours", type=float, help="also remove versions replaced at least so long ago")

    check = jobs.add_parser("audit")
    check.add_argument("--silver", required=True)

    args = parser.parse_args(argv)
    if args.job in ("refine", "extract"):
        files = args.landed if args.job == "refine" else args.out
        if (files is None) == (args.servers is None):
            parser.error("give either Kafka --servers with --topics, or a directory")
        if args.servers and not args.topics:
            parser.error("--servers needs --topics")
        limits = [o for o in args.option if o.startswith(("maxOffsets", "maxFiles", "maxBytes"))]
        if args.job == "refine" and args.mode == "replace" and limits:
            parser.error("--mode replace keeps only the last of several batches; give no limits")
        args.option = dict(o.split("=", 1) for o in args.option)
    return args


def refine(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.servers:
        sources = kafka_sources(spark, args.servers, args.topics, **args.option)
    else:
        sources = {n: text_source(spark, f"{args.landed}/{n}", **args.option) for n in DATASETS}
    queries = refine_all(
        sources,
        args.silver,
        args.checkpoints,
        trigger=args.every or AVAILABLE_NOW,
        rejects=args.rejects,
        mode=args.mode,
        ttl=args.ttl,
    )
    wait_for_all(queries)


def extract(spark: SparkSession, args: argparse.Namespace) -> None:
    whole = not args.page_per_line
    if not args.incomplete:
        for name in DATASETS:
            require_complete(spark, f"{args.pages}/{name}", multi_line=whole)
    raw = {n: read_pages(spark, f"{args.pages}/{n}", multi_line=whole) for n in DATASETS}
    found = regional_records(
        raw, args.as_of, axes=args.axes.split(","), station=args.station,
        lat_range=tuple(args.lat), lon_range=tuple(args.lon),
    )
    for name, records in found.items():
        if args.rejects:
            unparsed_records(raw[name], name).write.mode("append").parquet(f"{args.rejects}/{name}")
        messages = text_messages(records, MESSAGE_KEYS[name])
        if args.servers:
            write_kafka(messages, args.servers, args.topics[name], **args.option)
        else:
            messages.select("value").write.mode("append").text(f"{args.out}/{name}")


def main(argv: list[str] | None = None) -> None:
    args = _arguments(argv)
    logging.basicConfig(level=logging.INFO)
    spark = (
        SparkSession.builder.appName(f"trainlake-{args.job}")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    if args.job == "refine":
        refine(spark, args)
    elif args.job == "extract":
        extract(spark, args)
    elif args.job == "compact":
        compact(spark, DATASETS[args.dataset], args.silver, args.drop_lots, args.drop_after_hours)
    else:
        audit_silver(spark, args.silver)


if __name__ == "__main__":
    main(sys.argv[1:])

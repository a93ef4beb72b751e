"""Command line: ``python -m rsvpflow <command> ...``.

  reports  --master PATH [--contacts PATH] --out DIR [--filters JSON] [--standardized]
           every dashboard report under one filter spec, exported as CSV parts per report
  cards    --contacts PATH --ledger DIR --out DIR --batch ID
           one export batch: eligible cards written, ledger appended (replay-safe)
  sync     --target PATH --source PATH --key COL --seq COL --out DIR [--mode smart_sync|upsert|insert]

Inputs are Parquet paths.  Nothing is collected to the driver.
"""

from __future__ import annotations

import argparse
import json
import sys

from rsvpflow.session import get_spark


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="rsvpflow")
    sub = p.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("reports")
    r.add_argument("--master", required=True)
    r.add_argument("--contacts")
    r.add_argument("--out", required=True)
    r.add_argument("--filters", default="{}")
    r.add_argument("--standardized", action="store_true")
    c = sub.add_parser("cards")
    c.add_argument("--contacts", required=True)
    c.add_argument("--ledger", required=True)
    c.add_argument("--out", required=True)
    c.add_argument("--batch", required=True)
    s = sub.add_parser("sync")
    s.add_argument("--target", required=True)
    s.add_argument("--source", required=True)
    s.add_argument("--key", required=True)
    s.add_argument("--seq", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--mode", default="smart_sync", choices=["smart_sync", "upsert", "insert"])
    args = p.parse_args(argv)

    spark = get_spark()
    from rsvpflow.operators import contacts as C
    from rsvpflow.plans import jobs as J
    from rsvpflow.sources.sinks import export_report

    if args.cmd == "reports":
        master = spark.read.parquet(args.master)
        contacts = spark.read.parquet(args.contacts) if args.contacts else C.fan_out(master)
        reps = J.reports(master, contacts, json.loads(args.filters), standardized=args.standardized)
        for name, df in reps.items():
            export_report(df, f"{args.out.rstrip('/')}/{name}")
    elif args.cmd == "cards":
        J.export_cards_job(spark, spark.read.parquet(args.contacts), args.ledger, args.out, args.batch)
    elif args.cmd == "sync":
        res, counts = J.load_and_sync(spark, spark.read.parquet(args.source), spark.read.parquet(args.target),
                                      args.key, args.seq, args.mode)
        res.write.mode("overwrite").parquet(f"{args.out.rstrip('/')}/table")
        export_report(counts, f"{args.out.rstrip('/')}/actions")
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())

"""Command line: ``python -m tramline <command> ...``

  clean   raw timetable files -> cleaned parquet tables + ledger rows
  rollup  per-year ledger rows -> totals per table and step
  stream  clean the weekly files that arrived since the last run
"""

from __future__ import annotations

import argparse
import json
import sys

TABLES = ["passagierfrequenz", "haltestellen", "haltepunkte", "fahrzeiten"]


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="tramline")
    sub = p.add_subparsers(dest="cmd", required=True)
    c = sub.add_parser("clean", help="clean raw tables")
    c.add_argument("--raw", required=True)
    c.add_argument("--out", required=True)
    c.add_argument("--ledger", required=True)
    c.add_argument("--tables", nargs="*", default=TABLES, choices=TABLES)
    r = sub.add_parser("rollup", help="sum per-year ledger rows")
    r.add_argument("--ledger", required=True)
    s = sub.add_parser("stream", help="clean newly arrived weekly segment files")
    s.add_argument("--source", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--ledger", required=True)
    s.add_argument("--checkpoint", required=True)
    args = p.parse_args(argv)

    from tramline.session import build_session
    spark = build_session(app_name=f"tramline-{args.cmd}")
    from tramline.sources.ledger import Ledger
    ledger = Ledger(spark, args.ledger)
    if args.cmd == "clean":
        from tramline.plans.timetable import clean_table
        paths = {t: clean_table(spark, args.raw, t, args.out, ledger) for t in args.tables}
        print(json.dumps(paths))
    elif args.cmd == "rollup":
        from tramline.sources.ledger import ledger_rollup
        for row in ledger_rollup(ledger.latest()).orderBy("process").collect():
            print(f"{row['process']},{row['time']},{row['output']}")
    elif args.cmd == "stream":
        from tramline.plans.timetable import RAW_SCHEMAS
        from tramline.streaming.incremental import clean_new_files
        schema = spark.createDataFrame([], RAW_SCHEMAS["fahrzeiten"]).schema
        clean_new_files(spark, args.source, schema, args.out, args.ledger, "Fahrzeiten_Incremental",
                        date_cols=["betriebsdatum", "datum_von", "datum_nach"], checkpoint=args.checkpoint,
                        glob="[Ff]ahrzeiten*.csv")
    return 0


if __name__ == "__main__":
    sys.exit(main())

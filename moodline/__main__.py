"""Command line: ``python -m moodline <command> ...`` (or via spark-submit).

Commands
  ingest-tickets  landed ticket payloads -> raw_zone.raw_tickets + failed_records
  ingest-orders   orders CSV -> raw_zone.raw_orders + failed_records
  run-models      raw_zone -> staging -> core -> enrichment -> dashboard
  stream-tickets  T1 as a Structured Streaming query (drain once, or every 15 minutes)
  export          write a dashboard table as JSON / CSV files
  metrics         operational metrics over the stored tables, as JSON files
  expire          remove old versions of a table

The master and cluster sizing come from spark-submit; each command prints
one JSON line describing what it wrote.
"""

from __future__ import annotations

import argparse
import dataclasses
import json
import sys

from moodline.plans import dag, pipelines
from moodline.session import get_session
from moodline.sources import sinks


def _store(spark, args) -> sinks.TableStore:
    return sinks.TableStore(spark, args.warehouse, merge_buckets=args.buckets or None)


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="moodline")
    sub = p.add_subparsers(dest="cmd", required=True)

    def common(sp):
        sp.add_argument("--warehouse", required=True, help="table root (shared filesystem)")
        sp.add_argument("--buckets", type=int, default=sinks.DEFAULT_BUCKETS,
                        help="key buckets of merge targets created from now on (0: plain)")
        return sp

    t = common(sub.add_parser("ingest-tickets"))
    t.add_argument("--landing", required=True, nargs="+")
    t.add_argument("--audit", default=None)
    t.add_argument("--lines", action="store_true", help="one payload per line instead of per file")
    t.add_argument("--initial-cursor", default=pipelines.INITIAL_TICKETS_CURSOR)
    t.add_argument("--fail-on-malformed", action="store_true")

    o = common(sub.add_parser("ingest-orders"))
    o.add_argument("--csv", required=True, nargs="+")
    o.add_argument("--audit", default=None)
    o.add_argument("--initial-cursor", default=pipelines.INITIAL_ORDERS_CURSOR)
    o.add_argument("--fail-on-malformed", action="store_true")
    o.add_argument("--multi-line", action="store_true", help="fields may hold line breaks (one task per file)")
    o.add_argument("--strict-ids", action="store_true", help="reject order / customer ids of only blanks")

    m = common(sub.add_parser("run-models"))
    m.add_argument("--as-of", default=None)

    s = common(sub.add_parser("stream-tickets"))
    s.add_argument("--landing", required=True)
    s.add_argument("--checkpoint", default=None)
    s.add_argument("--audit", default=None)
    s.add_argument("--lines", action="store_true", help="one payload per line instead of per file")
    s.add_argument("--continuous", action="store_true", help="trigger every 15 minutes instead of draining once")

    e = common(sub.add_parser("export"))
    e.add_argument("--table", choices=("high_risk_table", "sentiment_heatmap"), required=True)
    e.add_argument("--out", required=True)
    e.add_argument("--format", choices=("json", "csv"), default="json")

    k = common(sub.add_parser("metrics"))
    k.add_argument("--out", required=True)
    k.add_argument("--audit", default=None)
    k.add_argument("--as-of", default=None)

    x = common(sub.add_parser("expire"))
    x.add_argument("--layer", required=True, choices=sinks.LAYERS)
    x.add_argument("--table", required=True)
    x.add_argument("--keep", type=int, default=3)

    args = p.parse_args(argv)
    spark = get_session(app_name=f"moodline-{args.cmd}")
    store = _store(spark, args)
    policy = "fail" if getattr(args, "fail_on_malformed", False) else "dead_letter"
    if args.cmd == "ingest-tickets":
        res = pipelines.run_ticket_ingestion(spark, store, args.landing, audit_path=args.audit,
                                             whole_files=not args.lines, on_malformed=policy,
                                             initial_cursor=args.initial_cursor or None)
        out = dataclasses.asdict(res)
    elif args.cmd == "ingest-orders":
        res = pipelines.run_order_ingestion(spark, store, args.csv, audit_path=args.audit,
                                            on_malformed=policy, initial_cursor=args.initial_cursor or None,
                                            strict_ids=args.strict_ids, multi_line=args.multi_line)
        out = dataclasses.asdict(res)
    elif args.cmd == "run-models":
        out = dag.run_models(spark, store, as_of=args.as_of)
    elif args.cmd == "stream-tickets":
        from moodline.streaming.tickets import start_ticket_merge
        q = start_ticket_merge(spark, store, args.landing, checkpoint_location=args.checkpoint,
                               available_now=not args.continuous, audit_path=args.audit,
                               whole_files=not args.lines)
        q.awaitTermination()
        out = {"query_id": str(q.id), "batches": q.lastProgress["batchId"] if q.lastProgress else None}
    elif args.cmd == "metrics":
        from moodline.plans.metrics import warehouse_metrics
        out = {}
        for name, df in warehouse_metrics(spark, store, args.as_of, args.audit).items():
            df.write.mode("overwrite").json(f"{args.out}/{name}")
            out[name] = f"{args.out}/{name}"
    elif args.cmd == "expire":
        out = {"removed": store.expire(args.layer, args.table, args.keep)}
    else:
        sinks.export_extract(store.read("dashboard", args.table), args.out, args.format)
        out = {"exported": args.table, "path": args.out}
    print(json.dumps(out, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())

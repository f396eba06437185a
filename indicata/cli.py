"""Command line: the batch entry points of the pipeline.

    python -m indicata.cli ingest --landing L --out O [--kind rate] [--serie selic] [--days 30] [--strict]
    python -m indicata.cli silver --out O [--kind rate] [--rebuild]
    python -m indicata.cli gold   --out O
    python -m indicata.cli run    --landing L --out O [--days 365] [--check-month 2025-01-01]

Without ``--days``, ``ingest`` looks back 30 days and ``run`` 365 (0: no
window). Exit code 1 when a series, kind or check of this run fails (its error
is printed and logged), or a series is not in the catalog. ``gold`` and ``run``
replace the published table only when the new one passes its checks.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from indicata.plans import pipeline as PL
from indicata.session import get_spark
from indicata.sources.catalog import SERIES

# Fixed values (must equal the reference for right results).
INGEST_DAYS = 30
RUN_DAYS = 365


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="indicata")
    sub = ap.add_subparsers(dest="cmd", required=True)
    for name in ("ingest", "silver", "gold", "run"):
        p = sub.add_parser(name)
        p.add_argument("--out", required=True)
        if name in ("ingest", "run"):
            p.add_argument("--landing", required=True)
            p.add_argument("--days", type=int, default=INGEST_DAYS if name == "ingest" else RUN_DAYS)
            p.add_argument("--strict", action="store_true")
            p.add_argument("--serie", action="append")
        if name in ("ingest", "silver"):
            p.add_argument("--kind", choices=PL.KINDS, action="append")
        if name in ("silver", "run"):
            p.add_argument("--rebuild", action="store_true")
        if name == "run":
            p.add_argument("--check-month", default=None)
    args = ap.parse_args(argv)
    unknown = set(getattr(args, "serie", None) or ()) - {s for s, *_ in SERIES}
    if unknown:
        print(f"unknown series: {', '.join(sorted(unknown))}")
        return 1
    spark = get_spark(f"indicata-{args.cmd}")
    failed = False

    if args.cmd == "ingest":
        of_kind = {s: k for s, _, k, _ in SERIES}
        kinds = args.kind or [k for k in PL.KINDS if not args.serie or k in {of_kind[s] for s in args.serie}]
        for kind in kinds:
            report, err = PL._isolated(PL.ingest_kind, spark, args.landing, args.out, kind, _now(),
                                       args.strict, args.days or None, args.serie)
            if err is not None:
                failed = True
                print(f"bronze.{kind}: error {err}")
                continue
            for r in report.orderBy("serie").toLocalIterator():
                failed |= r.status == "error"
                print(f"bronze.{kind}.{r.serie}: " + (f"error {r.erro}" if r.erro else
                      f"{r.linhas} rows, {r.quarentena} quarantined"))
    elif args.cmd == "silver":
        done = PL.build_silver(spark, args.out, kinds=tuple(args.kind or PL.KINDS), rebuild=args.rebuild)
        for kind, (rows, err, _, apart) in done.items():
            failed |= err is not None or bool(apart)
            print(f"silver.{kind}: " + (f"error {err}" if err else f"{rows} rows"))
            for serie, why in apart.items():
                print(f"silver.{kind}.{serie}: error {why}")
    elif args.cmd == "gold":
        rows, _, err = PL.publish_gold(spark, args.out)
        failed = err is not None
        print(f"gold: error {err}" if failed else f"gold: {rows} rows")
    else:
        res = PL.run_pipeline(spark, args.landing, args.out, _now(), check_month=args.check_month,
                              strict=args.strict, rebuild=args.rebuild, days=args.days or None,
                              series=args.serie)
        for r in res["run"].filter("status = 'error'").toLocalIterator():
            failed = True
            print(f"{r.table_name} {r.metadata.get('serie', '')}: error {r.metadata.get('error')}")
        if args.check_month:
            failed |= res["report"] is None or res["report"].filter("NOT aprovado").count() > 0
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())

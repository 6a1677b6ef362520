"""Command line: refresh the layers, then answer a page over the written gold tables.

  python -m kpi_lake refresh --sf-dir /data/raw --lake /shared/lake [--partition-facts]
  python -m kpi_lake silver  --lake /shared/lake          (bronze -> silver only)
  python -m kpi_lake gold    --lake /shared/lake          (silver -> gold only)
  python -m kpi_lake page performance --lake /shared/lake [--sales-from D --sales-to D]
                                       [--jobs-until D] [--saved-slicers]
                                       [--category C ...] [--departement D ...] [--partner P ...]
  python -m kpi_lake page activity --lake /shared/lake [--activity-period 2024 | 2024/1 ...]
                                    [--registration-period 2024/1 ...]

Slicers that aren't given don't filter; ``--saved-slicers`` applies the report's saved selections.

``--master`` is only needed outside spark-submit.
"""

from __future__ import annotations

import argparse
import sys

from kpi_lake.session import get_spark
from kpi_lake.sources.layers import Lake


def _period(text: str) -> tuple[int, ...]:
    return tuple(int(part) for part in text.split("/"))


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="python -m kpi_lake")
    p.add_argument("--master", default=None)
    sub = p.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("refresh", help="stand-in bronze from a folder of source tables, then silver and gold")
    r.add_argument("--sf-dir", required=True)
    r.add_argument("--lake", required=True)
    r.add_argument("--parallelism", type=int, default=4)
    r.add_argument("--partition-facts", action="store_true")
    for name in ("silver", "gold"):
        s = sub.add_parser(name)
        s.add_argument("--lake", required=True)
        s.add_argument("--parallelism", type=int, default=4)
    g = sub.add_parser("page", help="one row with every card of a report page")
    g.add_argument("name", choices=["registration", "activity", "performance"])
    g.add_argument("--lake", required=True)
    g.add_argument("--sales-from")
    g.add_argument("--sales-to", help="exclusive")
    g.add_argument("--jobs-until", help="exclusive")
    g.add_argument("--year", type=int, action="append", default=[])
    g.add_argument("--category", action="append", default=[])
    g.add_argument("--departement", action="append", default=[])
    g.add_argument("--partner", action="append", default=[])
    g.add_argument("--activity-period", type=_period, action="append", default=[], help="year or year/quarter")
    g.add_argument("--registration-period", type=_period, action="append", default=[], help="year or year/quarter")
    g.add_argument("--saved-slicers", action="store_true", help="the sales and job dates saved in the report")
    return p


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = get_spark(args.master)
    lake = Lake(root=args.lake)
    if args.cmd == "refresh":
        from kpi_lake.plans.pipelines import run_all

        report = run_all(spark, args.sf_dir, lake, args.parallelism, args.partition_facts)
        print("\n".join(report.written))
    elif args.cmd == "silver":
        from kpi_lake.plans.pipelines import run_bronze_to_silver

        print("\n".join(run_bronze_to_silver(spark, lake, args.parallelism).written))
    elif args.cmd == "gold":
        from kpi_lake.plans.pipelines import run_silver_to_gold

        print("\n".join(run_silver_to_gold(spark, lake, args.parallelism).written))
    else:
        from kpi_lake.plans import dashboard as D
        from kpi_lake.plans.catalog import gold_model

        profile = {"categories": args.category, "departements": args.departement, "partners": args.partner}
        if args.name == "performance":
            sales, jobs_until = (args.sales_from, args.sales_to), args.jobs_until
            if args.saved_slicers:
                sales = sales if any(sales) else D.REPORT_SALES_RANGE
                jobs_until = jobs_until or D.REPORT_JOBS_UNTIL
            ctx = D.performance_context(sales if any(sales) else None, jobs_until, **profile)
        elif args.name == "registration":
            ctx = D.registration_context(years=args.year, period=args.registration_period, **profile)
        else:
            ctx = D.activity_context(args.activity_period, args.registration_period, **profile)
        row = D.page(gold_model(spark, lake), ctx, args.name).first()
        for k, v in (row.asDict() if row else {}).items():
            print(f"{k}\t{v}")
    return 0


if __name__ == "__main__":
    sys.exit(main())

"""``spark-submit``-able entry: raw files in, layers and reports out, all of it or some stages."""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import SparkSession

from silverline.plans.layers import STAGES, Layout, read_sources, run


def options(arguments: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="silverline", description=__doc__)
    for name in ("customers", "accounts", "transactions"):
        parser.add_argument(f"--{name}", help=f"path of the {name}; needed by the bronze stage")
    parser.add_argument("--output", required=True, help="folder of the layers and reports")
    parser.add_argument("--transaction-schema", help="DDL of the JSON lines; saves one pass over them")
    parser.add_argument("--stages", nargs="+", choices=STAGES, default=STAGES, help="stages to run; default all")
    parser.add_argument("--ingested-at", type=datetime.fromisoformat, help="load time of the records")
    parser.add_argument("--as-of", type=date.fromisoformat, help="day for which ages are computed")
    parser.add_argument("--flag-issues", action="store_true", help="fill dq_flag in silver")
    parser.add_argument("--orphans-only", action="store_true", help="report 0 for every other issue code")
    parser.add_argument("--keep-malformed", action="store_true", help="keep lines that cannot be read, for quarantine")
    parser.add_argument("--one-pass", action="store_true", help="scan the JSON lines once, for the columns that silver knows")
    parser.add_argument("--partition-by", nargs="+", default=(), help="columns that lay out the fact")
    given = parser.parse_args(arguments)
    if "bronze" in given.stages and None in (given.customers, given.accounts, given.transactions):
        parser.error("the bronze stage needs --customers, --accounts and --transactions")
    return given


def main(arguments: Sequence[str] | None = None) -> None:
    given = options(arguments)
    spark = SparkSession.builder.appName("silverline").getOrCreate()
    sources = (
        read_sources(
            spark,
            given.customers,
            given.accounts,
            given.transactions,
            given.transaction_schema,
            given.keep_malformed,
            given.one_pass,
        )
        if "bronze" in given.stages
        else {}
    )
    run(
        spark,
        sources,
        Layout(given.output),
        given.ingested_at,
        given.as_of,
        given.flag_issues,
        given.partition_by,
        not given.orphans_only,
        given.stages,
    )


if __name__ == "__main__":
    main()

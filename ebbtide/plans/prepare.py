"""Clean a raw customer file and, if asked to, resample it to any size.

    python -m ebbtide.plans.prepare --raw hdfs://host/customers.csv --out hdfs://host/customer_core --scale 5000000
"""

from __future__ import annotations

import argparse
from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame

from ebbtide.operators.normalize import normalize_customers, outcome_rate
from ebbtide.operators.resample import bootstrap_customers
from ebbtide.session import build_session
from ebbtide.sources.storage import through_table
from ebbtide.sources.tables import read_raw_customers
from ebbtide.spec import ObservationSpec


def prepare(raw: DataFrame, out: str, spec: ObservationSpec = ObservationSpec(), scale: int | None = None) -> DataFrame:
    """Write the customers and return the written rows."""
    return through_table(bootstrap_customers(normalize_customers(raw, spec), scale), out)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("--raw", required=True, help="raw customer CSV")
    parser.add_argument("--out", required=True, help="where the Parquet table goes")
    parser.add_argument("--scale", type=int, default=None, help="number of customers to draw with replacement")
    parser.add_argument("--snapshot", type=date.fromisoformat, default=None)
    args = parser.parse_args(argv)
    spec = replace(ObservationSpec(), snapshot=args.snapshot) if args.snapshot else ObservationSpec()
    spark = build_session()
    outcome_rate(prepare(read_raw_customers(spark, args.raw), args.out, spec, args.scale)).show()
    spark.stop()


if __name__ == "__main__":
    main()

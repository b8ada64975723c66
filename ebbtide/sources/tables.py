"""Loading the five relations from files on any Hadoop-compatible store or from a catalog."""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.sources.schemas import EVENT_DAYS, conform, csv_schema, text_days
from ebbtide.spec import TABLES, ObservationSpec

Tables = dict[str, DataFrame]
MONTH = "event_month"  # years * 12 + months


def load_tables(
    spark: SparkSession,
    base_uri: str | None = None,
    fmt: str | None = None,
    id_type: str = "string",
    observed: ObservationSpec | None = None,
) -> Tables:
    """Read ``{base_uri}/{table}.{fmt}`` for each table, check it and register a temp view of that name.

    ``base_uri`` is anything the Hadoop file system layer resolves (hdfs://, s3a://, a local folder).
    ``id_type`` matters for CSV alone; typed formats bring their own. With ``observed``, text dates of histories are
    cut to its window before they get their type, so that the scan can skip what lies outside.
    """
    base = (base_uri or os.environ["EBBTIDE_RAW_URI"]).rstrip("/")
    fmt = fmt or os.getenv("EBBTIDE_RAW_FORMAT", "parquet")

    def read(table: str) -> DataFrame:
        path = f"{base}/{table}.{fmt}"
        if fmt == "csv":
            return _read_csv(spark, path, table, id_type)
        return spark.read.format(fmt).load(path)

    def windowed(table: str) -> DataFrame:
        if observed is None:
            return read(table)
        return text_days(read(table), observed.first_day_before, observed.snapshot)

    return register({table: conform(windowed(table), table) for table in TABLES})


def _read_csv(spark: SparkSession, path: str, table: str, id_type: str) -> DataFrame:
    """Typed CSV scan. Column order comes from the file's header, types from the contract."""
    types = {field.name: field.dataType for field in csv_schema(table, id_type).fields}
    header = spark.read.option("header", True).csv(path).columns
    ordered = ", ".join(
        f"`{name}` {types[name].simpleString() if name in types else 'string'}" for name in header
    )
    # A value that does not fit its type is an error, not a silent NULL.
    return spark.read.schema(ordered).option("header", True).option("mode", "FAILFAST").csv(path)


def read_raw_customers(spark: SparkSession, path: str) -> DataFrame:
    """The raw customer CSV as text; cleaning decides what each column means."""
    return spark.read.option("header", True).csv(path)


def load_catalog(spark: SparkSession, database: str, observed: ObservationSpec | None = None) -> Tables:
    """The same relations from catalog tables, e.g. of a Hive metastore; with ``observed``, of its months alone."""

    def read(table: str) -> DataFrame:
        rows = spark.table(f"{database}.{table}")
        if observed is not None and MONTH in rows.columns:
            first, last = (day.year * 12 + day.month for day in (observed.first_day_before, observed.snapshot))
            rows = rows.filter(F.col(MONTH).between(first, last))
        return conform(rows, table)

    return register({table: read(table) for table in TABLES})


def publish_catalog(tables: Tables, database: str, buckets: int) -> None:
    """Save the relations bucketed by customer, so that later aggregations and joins need no shuffle.

    Histories are partitioned by the month of the event, so that a run reads the months it observes. Rows are dealt by
    month and bucket before they are written: there is one file for each, and a customer with many rows is a task's only
    within a month.
    """
    for name, df in tables.items():
        df = _with_month(df)
        writer = _dealt(df, buckets).write.mode("overwrite").format("parquet")
        writer = writer.partitionBy(MONTH) if MONTH in df.columns else writer
        writer.bucketBy(buckets, "customer_id").sortBy("customer_id").saveAsTable(f"{database}.{name}")


def replace_months(tables: Tables, database: str, months: list[int]) -> None:
    """Put the given months of the histories in the place of those in the catalog; all other months stay untouched.

    ``months`` are numbers as in the partition column. A month of which a table has no rows is emptied. Relations without
    an event date are left as they are.
    """
    mode = "spark.sql.sources.partitionOverwriteMode"
    for name, df in tables.items():
        rows, target = _with_month(df), f"{database}.{name}"
        if MONTH not in rows.columns:
            continue
        spark = df.sparkSession
        rows = rows.filter(F.col(MONTH).isin(months)).select(spark.table(target).columns)
        before = spark.conf.get(mode)
        spark.conf.set(mode, "dynamic")
        try:
            _dealt(rows, _buckets(spark, target)).write.mode("overwrite").insertInto(target)
        finally:
            spark.conf.set(mode, before)
        # As many rows as months were named.
        present = {row[0] for row in rows.select(MONTH).distinct().collect()}
        for month in set(months) - present:
            spark.sql(f"ALTER TABLE {target} DROP IF EXISTS PARTITION ({MONTH} = {int(month)})")


def _with_month(df: DataFrame) -> DataFrame:
    day = next((c for c in EVENT_DAYS if c in df.columns), None)
    return df.withColumn(MONTH, (F.year(day) * 12 + F.month(day)).cast("int")) if day else df


def _dealt(df: DataFrame, buckets: int) -> DataFrame:
    """All rows of a bucket, and of a month where there is one, in one task; the bucket is the one Spark writes to."""
    bucket = F.pmod(F.hash("customer_id"), F.lit(buckets))
    return df.repartition(*([MONTH] if MONTH in df.columns else []), bucket)


def _buckets(spark: SparkSession, table: str) -> int:
    described = spark.sql(f"DESCRIBE EXTENDED {table}").filter("col_name = 'Num Buckets'").first()
    return int(described.data_type)


def register(tables: Tables) -> Tables:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return tables


def table_counts(tables: Tables) -> DataFrame:
    """(table_name, row_count), all tables counted in one job."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)

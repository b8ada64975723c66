"""Loading, cleaning, resampling and storage."""

from dataclasses import replace
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.operators import features as ft
from ebbtide.operators import normalize as nm
from ebbtide.operators import resample as rs
from ebbtide.plans.job import source_label
from ebbtide.plans.prepare import prepare
from ebbtide.sources import storage
from ebbtide.sources import tables as tb
from ebbtide.sources import testdata as td
from ebbtide.sources.schemas import RAW_CUSTOMER_SCHEMA, SchemaError
from ebbtide.spec import ObservationSpec
from tests.conftest import SF_SMALL

SPEC = ObservationSpec()


@pytest.fixture(scope="module")
def relations(spark):
    return td.relations(td.Source(spark, SF_SMALL))


def text_dates(df):
    """The way a pandas writer leaves the relations: dates as text, whole numbers as 64 bits."""
    for field in df.schema.fields:
        if isinstance(field.dataType, T.DateType):
            df = df.withColumn(field.name, F.date_format(field.name, "yyyy-MM-dd"))
        if isinstance(field.dataType, T.IntegerType):
            df = df.withColumn(field.name, F.col(field.name).cast("bigint"))
    return df


@pytest.mark.parametrize("fmt", ["parquet", "csv", "orc", "json"])
def test_formats_give_the_same_features(spark, relations, tmp_path, fmt):
    for name, df in relations.items():
        df = df if fmt in ("csv", "orc") else text_dates(df)
        writer = df.write.option("header", True) if fmt == "csv" else df.write
        writer.format(fmt).save(str(tmp_path / f"{name}.{fmt}"))
    loaded = tb.load_tables(spark, str(tmp_path), fmt, id_type="bigint")
    assert dict(loaded["customers"].dtypes)["signup_date"] == "date"
    want, got = (ft.feature_table(t, td.SPEC) for t in (relations, loaded))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert spark.table("payments").count() == relations["payments"].count()


def test_csv_columns_may_come_in_any_order(spark, relations, tmp_path):
    for name, df in relations.items():
        df.select(*reversed(df.columns)).write.option("header", True).csv(str(tmp_path / f"{name}.csv"))
    loaded = tb.load_tables(spark, str(tmp_path), "csv", id_type="bigint")
    assert tb.table_counts(loaded).exceptAll(tb.table_counts(relations)).count() == 0


def test_counts(relations):
    counts = {r.table_name: r.row_count for r in tb.table_counts(relations).collect()}
    assert counts == {"customers": 150, "usage": 657, "payments": 705, "tickets": 1747, "service_calls": 1000}


def test_missing_column_is_reported(spark, relations, tmp_path):
    for name, df in relations.items():
        (df.drop("days_late") if name == "payments" else df).write.parquet(str(tmp_path / f"{name}.parquet"))
    with pytest.raises(SchemaError, match="payments: missing column"):
        tb.load_tables(spark, str(tmp_path))


def test_bucketed_catalog_tables_need_no_exchange(spark, relations):
    spark.sql("CREATE DATABASE IF NOT EXISTS ebb_test")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tb.publish_catalog(relations, "ebb_test", buckets=4)
        loaded = tb.load_catalog(spark, "ebb_test")
        features = ft.feature_table(loaded, td.SPEC)
        assert "Exchange" not in features._jdf.queryExecution().executedPlan().toString()
        assert features.exceptAll(ft.feature_table(relations, td.SPEC)).count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.sql("DROP DATABASE ebb_test CASCADE")


def test_window_reaches_the_scan_and_columns_are_pruned(spark, relations, tmp_path):
    path = str(tmp_path / "payments.parquet")
    relations["payments"].write.parquet(path)
    plan = ft.payment_features(spark.read.parquet(path), td.SPEC)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(due_date,1997-06-30)" in plan and "LessThanOrEqual(due_date,2000-06-30)" in plan
    assert "amount" not in plan and "paid_date" not in plan


def test_window_reaches_the_scan_of_text_dates(spark, relations, tmp_path):
    for name, df in relations.items():
        days = {c: F.col(c).cast("string") for c, kind in df.dtypes if kind == "date"}
        df.withColumns(days).write.parquet(str(tmp_path / f"{name}.parquet"))
    loaded = tb.load_tables(spark, str(tmp_path), observed=td.SPEC)
    plan = ft.payment_features(loaded["payments"], td.SPEC)._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters: ")[1].split("ReadSchema")[0]
    assert "GreaterThanOrEqual(due_date,1997)" in pushed and "LessThan(due_date,2001)" in pushed
    assert ft.feature_table(loaded, td.SPEC).exceptAll(ft.feature_table(relations, td.SPEC)).count() == 0


@pytest.mark.parametrize("snapshot", [date(2025, 12, 31), date(2025, 9, 30)])
def test_text_dates_in_other_forms_count_as_well(spark, relations, tmp_path, snapshot):
    forms = [" 2025-08-01", "2025-8-1", "2025-7-15", "2025-07-15 ", "2025-07", "2025", "02025-07-15", "\t2025-07-15", "2025-07-15", "2019-01-01", "12025-01-01"]
    spec = replace(td.SPEC, snapshot=snapshot)
    for name, df in relations.items():
        if name == "payments":
            rows = [(1 + i % 2, day, 10.0 + i, i) for i, day in enumerate(forms)]
            df = spark.createDataFrame(rows, "customer_id bigint, due_date string, amount double, days_late bigint").withColumn("paid_date", F.col("due_date"))
        df.write.parquet(str(tmp_path / f"{name}.parquet"))
    cut, whole = (ft.payment_features(tb.load_tables(spark, str(tmp_path), observed=spec_)["payments"], spec) for spec_ in (spec, None))
    assert cut.exceptAll(whole).count() == 0 and whole.exceptAll(cut).count() == 0
    assert whole.agg(F.sum("late_payments")).first()[0] > 3


def test_text_that_is_no_date_is_still_an_error(spark, relations, tmp_path):
    for name, df in relations.items():
        if name == "payments":
            df = df.withColumn("due_date", F.lit("unknown"))
        df.write.parquet(str(tmp_path / f"{name}.parquet"))
    loaded = tb.load_tables(spark, str(tmp_path), observed=td.SPEC)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        loaded["payments"].agg(F.count("due_date")).collect()


def catalog_files(spark, table):
    """Month, bucket and number of files; the bucket is in the name of a file."""
    path = F.input_file_name()
    bucket = F.regexp_extract(path, "_(\\d{5})\\.", 1)
    return spark.table(table).groupBy(tb.MONTH, bucket.alias("bucket")).agg(F.countDistinct(path).alias("files"), F.min(path).alias("name"))


def test_one_file_a_bucket_and_month(spark, relations):
    spark.sql("CREATE DATABASE IF NOT EXISTS ebb_files")
    try:
        tb.publish_catalog(relations, "ebb_files", buckets=3)
        files = catalog_files(spark, "ebb_files.payments")
        assert files.agg(F.max("files"), F.count("*")).first()[0] == 1
        assert files.select(tb.MONTH).distinct().count() > 12 and files.select("bucket").distinct().count() == 3
    finally:
        spark.sql("DROP DATABASE ebb_files CASCADE")


def test_a_month_is_replaced_and_the_others_are_not_touched(spark, relations):
    spark.sql("CREATE DATABASE IF NOT EXISTS ebb_replaced")
    try:
        tb.publish_catalog(relations, "ebb_replaced", buckets=2)
        before = {(r[tb.MONTH], r.bucket): r.name for r in catalog_files(spark, "ebb_replaced.payments").collect()}
        months = sorted({month for month, _ in before})
        one, emptied = months[3], months[5]
        in_month = F.year("due_date") * 12 + F.month("due_date")
        changed = relations["payments"].withColumn("amount", F.lit(1.0)).filter(in_month != emptied)
        tb.replace_months({**relations, "payments": changed}, "ebb_replaced", [one, emptied])
        after = {(r[tb.MONTH], r.bucket): r.name for r in catalog_files(spark, "ebb_replaced.payments").collect()}
        assert {key for key in before if before[key] != after.get(key)} == {key for key in before if key[0] in (one, emptied)}
        now = spark.table("ebb_replaced.payments")
        want = relations["payments"].withColumn("amount", F.when(in_month == one, 1.0).otherwise(F.col("amount"))).filter(in_month != emptied)
        now = now.select(want.columns)
        assert now.exceptAll(want).count() == 0 and want.exceptAll(now).count() == 0
        features = ft.payment_features(tb.load_catalog(spark, "ebb_replaced")["payments"], td.SPEC)
        assert "Exchange" not in features._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.sql("DROP DATABASE ebb_replaced CASCADE")


def test_catalog_reads_the_observed_months_alone(spark, relations):
    spark.sql("CREATE DATABASE IF NOT EXISTS ebb_months")
    try:
        tb.publish_catalog(relations, "ebb_months", buckets=2)
        short = replace(td.SPEC, obs_months=3)
        loaded = tb.load_catalog(spark, "ebb_months", short)
        plan = ft.payment_features(loaded["payments"], short)._jdf.queryExecution().executedPlan().toString()
        assert "event_month" in plan.split("PartitionFilters")[1].split("]")[0]
        want = ft.payment_features(relations["payments"], short)
        assert ft.payment_features(loaded["payments"], short).exceptAll(want).count() == 0
    finally:
        spark.sql("DROP DATABASE ebb_months CASCADE")


def raw(spark, **changes):
    row = dict(
        customerID="7590-VHVEG", SeniorCitizen=0, tenure=1, Contract="One year", InternetService="DSL",
        PaymentMethod="Mailed check", MonthlyCharges=29.855, TotalCharges="29.85", OnlineSecurity="No",
        OnlineBackup="Yes", DeviceProtection="No", TechSupport="No", StreamingTV="No internet service",
        StreamingMovies="No", Churn="No",
    )
    row.update(changes)
    df = spark.createDataFrame([tuple(row.values())], RAW_CUSTOMER_SCHEMA)
    return nm.normalize_customers(df.toDF(*[f"  {c} " for c in df.columns]), SPEC).first()


def test_cleaning(spark):
    row = raw(spark)
    assert (row.customer_id, row.plan, row.internet_service, row.churned) == ("7590-VHVEG", "Basic", "DSL", 0)
    assert row.signup_date == date(2025, 12, 1) and row.total_charges == 29.85
    assert raw(spark, TotalCharges=" ", tenure=0).total_charges == 29.855
    assert raw(spark, TotalCharges=" ", tenure=0).signup_date == date(2025, 12, 1)
    assert raw(spark, TotalCharges="n/a").total_charges == 29.855
    assert raw(spark, TotalCharges=" 108.15 ").total_charges == 108.15
    assert (raw(spark, tenure=90).tenure, raw(spark, tenure=-3).tenure) == (72, 0)
    assert raw(spark, InternetService="Fiber optic", PaymentMethod="Cash").payment_method is None
    assert raw(spark, InternetService="No").internet_service == "None"
    assert raw(spark, Churn="Yes").churned == 1
    assert raw(spark, MonthlyCharges=29.858).monthly_charges == 29.86


def test_prepare_from_a_raw_csv(spark, tmp_path):
    raw_rows = td.raw_customers(td.Source(spark, SF_SMALL))
    raw_rows.write.option("header", True).option("ignoreLeadingWhiteSpace", False).csv(str(tmp_path / "raw.csv"))
    loaded = tb.read_raw_customers(spark, str(tmp_path / "raw.csv"))
    written = prepare(loaded, str(tmp_path / "core"), td.SPEC)
    want = nm.normalize_customers(raw_rows, td.SPEC)
    assert written.drop("source_customer_id").exceptAll(want).count() == 0 and written.count() == 150
    assert prepare(loaded, str(tmp_path / "more"), td.SPEC, scale=400).count() == 400


@pytest.mark.parametrize("addons, plan", [(0, "Basic"), (1, "Basic"), (2, "Standard"), (4, "Standard"), (5, "Premium")])
def test_plan_tier(spark, addons, plan):
    assert raw(spark, **{name: "Yes" if i < addons else "No" for i, name in enumerate(nm.ADDONS)}).plan == plan


def some_customers(spark, n=300):
    return spark.range(n).select(
        F.format_string("C%04d", "id").alias("customer_id"), (F.lit(15.0) + F.col("id") % 50).alias("monthly_charges")
    )


def test_positions_have_no_gaps(spark):
    df = rs.with_position(some_customers(spark), "customer_id")
    assert sorted(r.position for r in df.collect()) == list(range(300))


def test_bootstrap(spark):
    customers = some_customers(spark)
    sample = rs.bootstrap_customers(customers, 3000)
    assert sample.count() == 3000 and sample.select("customer_id").distinct().count() == 3000
    row = sample.first()
    assert row.customer_id.startswith(row.source_customer_id + "-") and len(row.customer_id.split("-")[1]) == 7
    again = rs.bootstrap_customers(customers.repartition(5), 3000)
    assert again.exceptAll(sample).count() == 0
    assert sample.agg(F.min("monthly_charges")).first()[0] >= 15.0
    ratio = sample.join(customers.toDF("source_customer_id", "base"), "source_customer_id").filter("base > 20").agg(
        F.avg(F.col("monthly_charges") / F.col("base")), F.stddev(F.col("monthly_charges") / F.col("base"))
    ).first()
    assert ratio[0] == pytest.approx(1.0, abs=0.005) and ratio[1] == pytest.approx(0.03, abs=0.003)
    hits = sample.groupBy("source_customer_id").count().agg(F.avg("count"), F.variance("count")).first()
    assert hits[0] == pytest.approx(10.0, abs=0.1) and hits[1] == pytest.approx(10.0, rel=0.35)


@pytest.mark.parametrize("size", [None, 300])
def test_bootstrap_of_the_own_size_is_the_input(spark, size):
    sample = rs.bootstrap_customers(some_customers(spark), size)
    assert sample.filter("customer_id <> source_customer_id").count() == 0
    assert sample.select("customer_id", "monthly_charges").exceptAll(some_customers(spark)).count() == 0


def test_checkpoint_folder_of_the_session_is_used(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert storage.shared_folder(spark, fallback="/nowhere") == folder
    assert storage.scratch_path(spark, "x").startswith(folder)
    assert storage.cut_lineage(spark.range(3)).count() == 3


def test_source_label():
    assert source_label("hdfs://host:9000/a/b/c") == "hdfs://host:9000/a/b/c"
    assert source_label("/home/someone/project/data/raw/") == "data/raw"
    assert source_label("raw") == "raw"


def test_stamp_tells_another_content(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(3).write.parquet(path)
    first = storage.stamp(spark, path)
    assert storage.stamp(spark, path) == first
    spark.range(3).write.mode("append").parquet(path)
    assert storage.stamp(spark, path) != first

"""Column contracts of the five relations and of the raw customer file."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column names and types of the input relations. ``id`` is text or a whole number.
CONTRACTS: dict[str, dict[str, str]] = {
    "customers": {
        "customer_id": "id", "signup_date": "date", "age": "int", "region": "string", "contract": "string",
        "plan": "string", "internet_service": "string", "payment_method": "string",
        "monthly_charges": "double", "churned": "int",
    },
    "usage": {
        "customer_id": "id", "month": "date", "call_minutes": "double", "data_gb": "double",
        "sms_count": "bigint", "app_logins": "bigint",
    },
    "payments": {
        "customer_id": "id", "due_date": "date", "paid_date": "date", "amount": "double", "days_late": "bigint",
    },
    "tickets": {
        "customer_id": "id", "created_date": "date", "category": "string", "is_complaint": "int",
        "resolution_hours": "double", "escalated": "int", "satisfaction": "double",
    },
    "service_calls": {
        "customer_id": "id", "call_date": "date", "duration_min": "double", "resolved": "int",
        "sentiment": "double",
    },
}

RAW_CUSTOMER_SCHEMA = T.StructType(
    [
        T.StructField("customerID", T.StringType()),
        T.StructField("SeniorCitizen", T.IntegerType()),
        T.StructField("tenure", T.IntegerType()),
        T.StructField("Contract", T.StringType()),
        T.StructField("InternetService", T.StringType()),
        T.StructField("PaymentMethod", T.StringType()),
        T.StructField("MonthlyCharges", T.DoubleType()),
        T.StructField("TotalCharges", T.StringType()),
        T.StructField("OnlineSecurity", T.StringType()),
        T.StructField("OnlineBackup", T.StringType()),
        T.StructField("DeviceProtection", T.StringType()),
        T.StructField("TechSupport", T.StringType()),
        T.StructField("StreamingTV", T.StringType()),
        T.StructField("StreamingMovies", T.StringType()),
        T.StructField("Churn", T.StringType()),
    ]
)

# The day of an event, by which the observation window is cut.
EVENT_DAYS = ("month", "due_date", "created_date", "call_date")

_NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_ACCEPTED = {
    "id": (T.StringType,) + _WHOLE,
    "string": (T.StringType,),
    "date": (T.DateType, T.TimestampType, T.TimestampNTZType, T.StringType),
    # 0/1 flags also arrive as booleans, and as floats when a writer had to store missing values.
    "int": _NUMBERS + (T.BooleanType,),
    "bigint": _NUMBERS + (T.BooleanType,),
    "double": _NUMBERS,
}


class SchemaError(ValueError):
    """A relation does not fulfil its contract."""


def text_days(df: DataFrame, first_after: date, last: date) -> DataFrame:
    """Rows whose text dates can lie in (first_after, last]; a filter that Parquet readers understand.

    Only event dates of histories are looked at. A cast takes more than YYYY-MM-DD: months and days of one digit, years or
    months alone, blanks around, zeros in front. All of these begin with the year, or with something that sorts before 1;
    so the bounds are years, and text that begins outside 1 to 9 is kept, for the cast to take or to refuse. The exact
    window is cut after the cast.
    """
    for name in EVENT_DAYS:
        if name in df.columns and isinstance(df.schema[name].dataType, T.StringType):
            day = F.col(name)
            years = (day >= f"{first_after.year:04d}") & (day < f"{last.year + 1:04d}")
            df = df.filter(years | (day < "1") | (day >= ":"))
    return df


def conform(df: DataFrame, table: str) -> DataFrame:
    """Check a relation against its contract, then give each contract column its type.

    Columns outside the contract (row keys of tickets and calls, for example) pass through untouched.
    NaN becomes NULL, because one NaN would poison an average while NULL is skipped.
    """
    contract = CONTRACTS[table]
    present = {field.name: field.dataType for field in df.schema.fields}
    missing = [name for name in contract if name not in present]
    if missing:
        raise SchemaError(f"{table}: missing column(s) {', '.join(missing)}")
    wrong = [
        f"{name} is {present[name].simpleString()}, expected {kind}"
        for name, kind in contract.items()
        if not isinstance(present[name], _ACCEPTED[kind])
    ]
    if wrong:
        raise SchemaError(f"{table}: " + "; ".join(wrong))

    def typed(name: str):
        column, kind = F.col(name), contract.get(name)
        if kind in (None, "id", "string"):
            return column
        if kind == "double":
            column = column.cast("double")
            return F.when(F.isnan(column), None).otherwise(column).alias(name)
        if isinstance(present[name], (T.FloatType, T.DoubleType)):
            column = F.when(F.isnan(column), None).otherwise(column)
        return column.cast(kind).alias(name)

    return df.select([typed(name) for name in df.columns])


def csv_schema(table: str, id_type: str = "string") -> T.StructType:
    """Explicit reader schema, so that a CSV scan needs no inference pass over the data."""
    leading = {"tickets": "ticket_id bigint, ", "service_calls": "call_id bigint, "}.get(table, "")
    body = ", ".join(
        f"`{name}` {id_type if kind == 'id' else kind}" for name, kind in CONTRACTS[table].items()
    )
    return T.StructType.fromDDL(leading + body)


def require_unique_customers(customers: DataFrame) -> None:
    """Raise when a customer id occurs twice; duplicates would multiply rows in every later join."""
    repeated = (
        customers.groupBy("customer_id").count().filter(F.col("count") > 1).select("customer_id").limit(5)
    )
    examples = [str(row.customer_id) for row in repeated.collect()]
    if examples:
        raise SchemaError(f"customers: repeated customer_id, e.g. {', '.join(examples)}")

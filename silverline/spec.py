"""What each silver table looks like, stated once and used by every plan.

A :class:`Field` says which type a column has and how raw text becomes that
type; a :class:`TableSpec` lists the fields with the table's key, its aliases
and the order that decides which of several records is the latest.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverline import functions as fn
from silverline.fixed_values import (
    ACCOUNT_ALIASES,
    CUSTOMER_ALIASES,
    EVENT_DATE_NAMES,
    EVENT_TIME_NAMES,
    EVENT_TIMESTAMP_NAMES,
    HOME_CURRENCY,
    TRANSACTION_ALIASES,
)
from silverline.operators.shape import nested_text

MONEY = T.DecimalType(18, 2)


def as_is(value: Column) -> Column:
    return value


@dataclass(frozen=True)
class Field:
    """One silver column.

    ``clean`` turns the raw column into the silver value. ``derive`` builds the
    value from the whole prepared table instead (it sees which columns exist).
    ``after`` builds it from silver columns that are already there. ``default``
    is used when the raw column is absent.
    """

    name: str
    type: T.DataType
    clean: Callable[[Column], Column] = as_is
    derive: Callable[[DataFrame], Column] | None = None
    after: Callable[[], Column] | None = None
    default: str | None = None

    def expression(self, df: DataFrame) -> Column:
        kind = self.type.simpleString()
        if self.after is not None:
            return self.after().alias(self.name)
        if self.derive is not None:
            return self.derive(df).alias(self.name)
        if self.name not in df.columns:
            return F.lit(self.default).cast(kind).alias(self.name)
        if self.clean is as_is and df.schema[self.name].dataType == self.type:
            return F.col(self.name)
        return self.clean(F.col(self.name)).cast(kind).alias(self.name)


@dataclass(frozen=True)
class TableSpec:
    name: str
    key: str
    fields: Sequence[Field]
    required: Sequence[str]
    aliases: Mapping[str, Sequence[str]]
    newest_first: Sequence[str] = ("ingestion_timestamp",)
    # Raw columns by the kind of trouble they can bring (data-quality counts).
    numbers: Mapping[str, Callable[[Column], Column]] = field(default_factory=dict)
    dates: Sequence[Sequence[str]] = ()
    currency: str | None = None

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.type) for f in self.fields])


def _text(*names: str) -> list[Field]:
    return [Field(name, T.StringType()) for name in names]


LOADED = Field("ingestion_timestamp", T.TimestampType())

CUSTOMERS = TableSpec(
    name="customers",
    key="customer_id",
    required=("customer_id",),
    aliases=CUSTOMER_ALIASES,
    fields=[
        Field("customer_id", T.StringType(), fn.trimmed_key),
        *_text("first_name", "last_name"),
        Field("dob", T.DateType(), fn.flexible_date),
        *_text("gender"),
        Field("province", T.StringType(), fn.province),
        *_text("income_band", "segment"),
        Field("risk_score", T.IntegerType(), fn.tolerant_int),
        *_text("kyc_status"),
        LOADED,
    ],
    numbers={"risk_score": fn.tolerant_int},
    dates=(("dob",),),
)

ACCOUNTS = TableSpec(
    name="accounts",
    key="account_id",
    required=("account_id", "customer_id"),
    aliases=ACCOUNT_ALIASES,
    fields=[
        Field("account_id", T.StringType(), fn.trimmed_key),
        Field("customer_id", T.StringType(), fn.trimmed_key),
        *_text("account_type", "account_status"),
        Field("account_open_date", T.DateType(), fn.flexible_date),
        *_text("product_tier", "digital_channel"),
        Field("credit_limit", MONEY, fn.tolerant_decimal),
        Field("current_balance", MONEY, fn.tolerant_decimal),
        Field("last_activity_date", T.DateType(), fn.flexible_date),
        LOADED,
    ],
    numbers={"credit_limit": fn.tolerant_decimal, "current_balance": fn.tolerant_decimal},
    dates=(("account_open_date",), ("last_activity_date",)),
)


def _event_time(df: DataFrame) -> Column:
    return fn.event_time(df.columns)


def _event_province(df: DataFrame) -> Column:
    if "location" in df.columns:
        return fn.province(nested_text(df, "location", "province"))
    return fn.province(F.col("location_province") if "location_province" in df.columns else F.lit(None))


TRANSACTIONS = TableSpec(
    name="transactions",
    key="transaction_id",
    required=("transaction_id", "account_id"),
    aliases=TRANSACTION_ALIASES,
    fields=[
        Field("transaction_id", T.StringType(), fn.trimmed_key),
        Field("account_id", T.StringType(), fn.trimmed_key),
        Field("transaction_timestamp", T.TimestampType(), derive=_event_time),
        Field("transaction_date", T.DateType(), after=lambda: F.to_date("transaction_timestamp")),
        Field("transaction_type", T.StringType(), fn.transaction_type),
        Field("amount", MONEY, fn.tolerant_decimal),
        Field("currency", T.StringType(), fn.currency, default=HOME_CURRENCY),
        *_text("merchant_category", "merchant_subcategory", "channel"),
        Field("location_province", T.StringType(), derive=_event_province),
        Field("dq_flag", T.StringType(), derive=lambda df: F.lit(None).cast("string")),
        LOADED,
    ],
    newest_first=("transaction_timestamp", "ingestion_timestamp"),
    numbers={"amount": fn.tolerant_decimal},
    dates=(EVENT_DATE_NAMES,),
    currency="currency",
)

SPECS = {spec.name: spec for spec in (CUSTOMERS, ACCOUNTS, TRANSACTIONS)}


def raw_names(spec: TableSpec) -> dict[str, list[str]]:
    """Every raw column that a silver column is made of, with the names that it may come under, best first."""
    names = {f.name: [f.name] for f in spec.fields if f.derive is None and f.after is None and f is not LOADED}
    for target, aliases in spec.aliases.items():
        names[target] = [target, *aliases]
    if spec is TRANSACTIONS:
        names |= {n: [n] for n in (*EVENT_TIMESTAMP_NAMES, *EVENT_DATE_NAMES, *EVENT_TIME_NAMES)}
        names["location_province"] = ["location.province", "location_province"]
    return names

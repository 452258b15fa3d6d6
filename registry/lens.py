"""Shows the given tables as raw customer, account and transaction records.

``customer``, ``orders`` and ``lineitem`` take the shape of the three raw inputs.
Dirt (mixed spellings and formats, blanks, NULLs, repeated and dangling keys) is
a fixed function of the row, so the checking SQL can repeat it. Every row of
every table is used.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

INGESTED_AT = datetime(2024, 6, 1)
AS_OF = date(2024, 6, 30)

# Spellings the dirty columns are drawn from, by index.
PROVINCE_SPELLINGS = (
    "EC", "Eastern Cape", " eastern_cape ", "FS", "free state", "GP", "Gauteng", "GAUTENG ",
    "KZN", "KwaZulu-Natal", "KWAZULU_NATAL", "kwazulu  natal", "LP", "Limpopo", "MP",
    "mpumalanga", "NW", "North_West", "NC", "NORTHERN CAPE", "WC", "Western Cape",
    "  western__cape", "Free_State", "Atlantis_Bay ",
)
TYPE_SPELLINGS = (
    "CR", "credit", " Credits ", "DR", "debit", "DEBITS", "fee", "Charges", " FEES", "rev",
    "Reversal", "REVERSE", "Transfer ",
)
CURRENCY_SPELLINGS = ("ZAR", "zar", " R ", "Rand", "710", "usd", None)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def picked(values: tuple[str | None, ...], index: str) -> str:
    """SQL for ``values[index % len(values)]``."""
    listed = ", ".join("NULL" if v is None else f"'{v}'" for v in values)
    return f"get(array({listed}), cast({index} % {len(values)} as int))"


def slashed(iso: str) -> str:
    return f"substr({iso}, 9, 2) || '/' || substr({iso}, 6, 2) || '/' || substr({iso}, 1, 4)"


def epoch_seconds(iso: str) -> str:
    return f"string(unix_date(date({iso})) * 86400L)"


def has_ten_digits(iso: str) -> str:
    return f"{iso} >= '2001-09-09'"


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Every 40th record repeats the id of the record before it.
    keyed = table(spark, sf_dir, "customer").selectExpr(
        "*",
        "c_custkey as k",
        "'C' || (c_custkey - if(c_custkey % 40 = 0 and c_custkey > 0, 1, 0)) as shared",
        "string(date_add(date'1940-01-01', int(c_custkey * 37 % 28000))) as born",
    )
    return keyed.selectExpr(
        """case when k % 101 = 0 then null when k % 97 = 0 then '  '
                when k % 7 = 0 then ' ' || shared || ' ' else shared end as customer_id""",
        "'ID' || k as id_number",
        "substring(c_name, 1, 8) as first_name",
        "substring(c_name, 10, 9) as last_name",
        f"""case when k % 4 = 1 then {slashed("born")}
                 when k % 8 = 2 and {has_ten_digits("born")} then {epoch_seconds("born")}
                 when k % 8 = 6 and {has_ten_digits("born")} then {epoch_seconds("born")} || '123'
                 when k % 8 = 3 then 'unknown'
                 when k % 8 = 7 then ' ' || born || ' '
                 else born end as dob""",
        f"{picked(('F', 'M', 'X'), 'k')} as gender",
        f"{picked(PROVINCE_SPELLINGS, 'c_nationkey')} as province",
        "case when c_acctbal < 0 then 'LOW' when c_acctbal < 5000 then 'MID' else 'HIGH' end as income_band",
        "c_mktsegment as segment",
        """case when k % 13 = 0 then 'n/a' when k % 11 = 0 then (k % 100) || '.7'
                else string(k % 100) end as risk_score""",
        f"{picked(('VERIFIED', 'PENDING', 'FAILED', None), 'k')} as kyc_status",
        "'A|B' as product_flags",
    )


def raw_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = table(spark, sf_dir, "orders").selectExpr(
        "*",
        "o_orderkey as k",
        "'A' || (o_orderkey - if(o_orderkey % 60 = 0 and o_orderkey > 0, 1, 0)) as shared",
        "to_date(o_orderdate) as opened",
        "string(cast(o_totalprice as decimal(18,2))) as money",
    )
    return keyed.selectExpr(
        """case when k % 103 = 0 then null when k % 89 = 0 then '  '
                when k % 9 = 0 then ' ' || shared || ' ' else shared end as account_id""",
        "case when k % 71 <> 0 then 'C' || o_custkey end as customer_ref",
        f"{picked(('SAVINGS', 'CHEQUE', 'CREDIT', 'LOAN'), 'k')} as account_type",
        "o_orderstatus as account_status",
        f"""case when k % 30 = 2 then date_format(opened, 'yyyy.MM.dd')
                 when k % 3 = 1 then {slashed("string(opened)")} else string(opened) end as open_date""",
        "o_orderpriority as product_tier",
        "'082' || k as mobile_number",
        f"{picked(('APP', 'WEB', None), 'k')} as digital_channel",
        "case when k % 19 = 0 then 'n/a' else money end as credit_limit",
        "case when k % 17 = 0 then '1,000' else money end as current_balance",
        "case when k % 6 <> 0 then string(date_add(opened, int(k % 400))) end as last_activity_date",
    )


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = table(spark, sf_dir, "lineitem").selectExpr(
        "*", "l_partkey as p", "l_suppkey as s", "'A' || l_orderkey as account", "string(to_date(l_shipdate)) as day"
    )
    return keyed.selectExpr(
        """case when p % 50 = 0 then null when p % 50 = 1 then '  '
                else account || '-' || l_linenumber end as transaction_id""",
        "account as account_id",
        f"""case when p % 44 = 3 then '2024-02-30'
                 when p % 44 = 7 then null
                 when p % 4 = 1 then {slashed("day")}
                 when p % 4 = 2 and {has_ten_digits("day")} then {epoch_seconds("day")}
                 else if(p % 4 = 2, ' ', '') || day end as transaction_date""",
        """case when p % 5 = 0 then null when p % 53 = 1 then '9:00'
                else lpad(p % 24, 2, '0') || ':' || lpad(p * 7 % 60, 2, '0') || ':'
                     || lpad(p * 11 % 60, 2, '0') end as transaction_time""",
        f"{picked(TYPE_SPELLINGS, 'p')} as transaction_type",
        f"{picked(('GROCERY', 'FUEL', 'TRAVEL', None), 's')} as merchant_category",
        "l_returnflag as merchant_subcategory",
        """case when p % 41 = 0 then 'n/a'
                else string(cast(l_extendedprice as decimal(18,2))) end as amount""",
        f"{picked(CURRENCY_SPELLINGS, 's')} as currency",
        "l_linestatus as channel",
        f"""struct({picked(PROVINCE_SPELLINGS, "s")} as province, 'City ' || s as city,
                   '-26.2,28.0' as coordinates) as location""",
        "struct(string(p) as device_id, string(s) as session_id, p % 2 = 0 as retry_flag) as metadata",
    )

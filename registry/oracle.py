"""SQL that computes each registered query independently, on the given tables.

Every statement runs over the whole tables. Dates, timestamps and decimals are
rendered the way :func:`registry.catalog.portable` renders them.
"""

from __future__ import annotations

PROVINCE_TEXTS = (
    "['EC','Eastern Cape',' eastern_cape ','FS','free state','GP','Gauteng','GAUTENG ','KZN',"
    "'KwaZulu-Natal','KWAZULU_NATAL','kwazulu  natal','LP','Limpopo','MP','mpumalanga','NW',"
    "'North_West','NC','NORTHERN CAPE','WC','Western Cape','  western__cape','Free_State',"
    "'Atlantis_Bay ']"
)
TYPE_TEXTS = (
    "['CR','credit',' Credits ','DR','debit','DEBITS','fee','Charges',' FEES','rev','Reversal',"
    "'REVERSE','Transfer ']"
)
CURRENCY_TEXTS = "['ZAR','zar',' R ','Rand','710','usd',NULL]"


def chosen(texts: str, index: str, size: int) -> str:
    return f"({texts})[({index} % {size})::INT + 1]"


def province(v: str) -> str:
    return f"""CASE trim(regexp_replace(upper({v}), '[\\s_]+', ' ', 'g'))
      WHEN 'EC' THEN 'Eastern Cape' WHEN 'EASTERN CAPE' THEN 'Eastern Cape'
      WHEN 'FS' THEN 'Free State' WHEN 'FREE STATE' THEN 'Free State'
      WHEN 'GP' THEN 'Gauteng' WHEN 'GAUTENG' THEN 'Gauteng'
      WHEN 'KZN' THEN 'KwaZulu-Natal' WHEN 'KWAZULU NATAL' THEN 'KwaZulu-Natal'
      WHEN 'KWAZULU-NATAL' THEN 'KwaZulu-Natal'
      WHEN 'LP' THEN 'Limpopo' WHEN 'LIMPOPO' THEN 'Limpopo'
      WHEN 'MP' THEN 'Mpumalanga' WHEN 'MPUMALANGA' THEN 'Mpumalanga'
      WHEN 'NW' THEN 'North West' WHEN 'NORTH WEST' THEN 'North West'
      WHEN 'NC' THEN 'Northern Cape' WHEN 'NORTHERN CAPE' THEN 'Northern Cape'
      WHEN 'WC' THEN 'Western Cape' WHEN 'WESTERN CAPE' THEN 'Western Cape'
      ELSE trim({v}) END"""


def txn_type(v: str) -> str:
    return f"""CASE WHEN upper(trim({v})) IN ('CR','CREDIT','CREDITS') THEN 'CREDIT'
      WHEN upper(trim({v})) IN ('DR','DEBIT','DEBITS') THEN 'DEBIT'
      WHEN upper(trim({v})) IN ('FEE','FEES','CHARGE','CHARGES') THEN 'FEE'
      WHEN upper(trim({v})) IN ('REV','REVERSE','REVERSAL','REVERSALS') THEN 'REVERSAL'
      ELSE upper(trim({v})) END"""


def currency(v: str) -> str:
    return f"""CASE WHEN upper(trim({v})) IN ('ZAR','R','RAND','RANDS','710') THEN 'ZAR'
      ELSE upper(trim({v})) END"""


def day(v: str) -> str:
    """Flexible date. Digit counts are checked because strptime is lenient."""
    t = f"trim({v})"
    return f"""CASE
      WHEN regexp_full_match({t}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}')
        THEN CAST(try_strptime({t}, '%Y-%m-%d') AS DATE)
      WHEN regexp_full_match({t}, '[0-9]{{2}}/[0-9]{{2}}/[0-9]{{4}}')
        THEN CAST(try_strptime({t}, '%d/%m/%Y') AS DATE)
      WHEN regexp_full_match({t}, '[0-9]{{13}}')
        THEN CAST(make_timestamp((TRY_CAST({t} AS BIGINT) // 1000) * 1000000) AS DATE)
      WHEN regexp_full_match({t}, '[0-9]{{10}}')
        THEN CAST(make_timestamp(TRY_CAST({t} AS BIGINT) * 1000000) AS DATE) END"""


def date_time(d: str, t: str) -> str:
    clock = f"coalesce(trim({t}), '00:00:00')"
    return f"""CASE WHEN ({day(d)}) IS NOT NULL
        AND regexp_full_match({clock}, '[0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}}')
      THEN try_strptime(strftime({day(d)}, '%Y-%m-%d') || ' ' || {clock}, '%Y-%m-%d %H:%M:%S') END"""


def whole(v: str) -> str:
    return f"TRY_CAST(regexp_extract(trim({v}), '^([+-]?[0-9]+)([.][0-9]*)?$', 1) AS INTEGER)"


def decimal(v: str) -> str:
    return f"TRY_CAST({v} AS DECIMAL(18,2))"


def age_band(dob: str) -> str:
    years = f"datesub('year', {dob}, DATE '2024-06-30')"
    return f"""CASE WHEN {years} >= 65 THEN '65+' WHEN {years} >= 56 THEN '56-65'
      WHEN {years} >= 46 THEN '46-55' WHEN {years} >= 36 THEN '36-45'
      WHEN {years} >= 26 THEN '26-35' WHEN {years} >= 18 THEN '18-25' END"""


LOADED = "TIMESTAMP '2024-06-01 00:00:00'"

# --- raw shapes ------------------------------------------------------------------

EPOCH_TEXT = "CAST(date_diff('day', DATE '1970-01-01', {d}) * 86400 AS VARCHAR)"

CTES: dict[str, str] = {}

CTES["raw_customers"] = f"""
  SELECT
    CASE WHEN k % 101 = 0 THEN NULL WHEN k % 97 = 0 THEN '  '
         WHEN k % 7 = 0 THEN ' ' || shared || ' ' ELSE shared END AS customer_id,
    'ID' || k AS id_number, substr(c_name, 1, 8) AS first_name, substr(c_name, 10, 9) AS last_name,
    CASE WHEN k % 4 = 1 THEN strftime(born, '%d/%m/%Y')
         WHEN k % 8 = 2 AND born >= DATE '2001-09-09' THEN {EPOCH_TEXT.format(d="born")}
         WHEN k % 8 = 6 AND born >= DATE '2001-09-09' THEN {EPOCH_TEXT.format(d="born")} || '123'
         WHEN k % 8 = 3 THEN 'unknown'
         WHEN k % 8 = 7 THEN ' ' || strftime(born, '%Y-%m-%d') || ' '
         ELSE strftime(born, '%Y-%m-%d') END AS dob,
    {chosen("['F','M','X']", "k", 3)} AS gender,
    {chosen(PROVINCE_TEXTS, "c_nationkey", 25)} AS province,
    CASE WHEN c_acctbal < 0 THEN 'LOW' WHEN c_acctbal < 5000 THEN 'MID' ELSE 'HIGH' END AS income_band,
    c_mktsegment AS segment,
    CASE WHEN k % 13 = 0 THEN 'n/a' WHEN k % 11 = 0 THEN (k % 100) || '.7'
         ELSE CAST(k % 100 AS VARCHAR) END AS risk_score,
    {chosen("['VERIFIED','PENDING','FAILED',NULL]", "k", 4)} AS kyc_status
  FROM (SELECT *, c_custkey AS k,
          'C' || (c_custkey - CASE WHEN c_custkey % 40 = 0 AND c_custkey > 0 THEN 1 ELSE 0 END) AS shared,
          DATE '1940-01-01' + CAST(c_custkey * 37 % 28000 AS INTEGER) AS born
        FROM customer)"""

CTES["raw_accounts"] = f"""
  SELECT
    CASE WHEN k % 103 = 0 THEN NULL WHEN k % 89 = 0 THEN '  '
         WHEN k % 9 = 0 THEN ' ' || shared || ' ' ELSE shared END AS account_id,
    CASE WHEN k % 71 <> 0 THEN 'C' || o_custkey END AS customer_ref,
    {chosen("['SAVINGS','CHEQUE','CREDIT','LOAN']", "k", 4)} AS account_type,
    o_orderstatus AS account_status,
    CASE WHEN k % 30 = 2 THEN strftime(opened, '%Y.%m.%d')
         WHEN k % 3 = 1 THEN strftime(opened, '%d/%m/%Y')
         ELSE strftime(opened, '%Y-%m-%d') END AS open_date,
    o_orderpriority AS product_tier, '082' || k AS mobile_number,
    {chosen("['APP','WEB',NULL]", "k", 3)} AS digital_channel,
    CASE WHEN k % 19 = 0 THEN 'n/a' ELSE money END AS credit_limit,
    CASE WHEN k % 17 = 0 THEN '1,000' ELSE money END AS current_balance,
    CASE WHEN k % 6 <> 0 THEN strftime(opened + CAST(k % 400 AS INTEGER), '%Y-%m-%d') END
      AS last_activity_date
  FROM (SELECT *, o_orderkey AS k,
          'A' || (o_orderkey - CASE WHEN o_orderkey % 60 = 0 AND o_orderkey > 0 THEN 1 ELSE 0 END) AS shared,
          CAST(o_orderdate AS DATE) AS opened,
          CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS money
        FROM orders)"""

CTES["raw_transactions"] = f"""
  SELECT
    CASE WHEN p % 50 = 0 THEN NULL WHEN p % 50 = 1 THEN '  '
         ELSE account || '-' || l_linenumber END AS transaction_id,
    account AS account_id,
    CASE WHEN p % 44 = 3 THEN '2024-02-30' WHEN p % 44 = 7 THEN NULL
         WHEN p % 4 = 1 THEN strftime(ship, '%d/%m/%Y')
         WHEN p % 4 = 2 AND ship >= DATE '2001-09-09' THEN {EPOCH_TEXT.format(d="ship")}
         WHEN p % 4 = 2 THEN ' ' || strftime(ship, '%Y-%m-%d')
         ELSE strftime(ship, '%Y-%m-%d') END AS transaction_date,
    CASE WHEN p % 5 = 0 THEN NULL WHEN p % 53 = 1 THEN '9:00'
         ELSE lpad(CAST(p % 24 AS VARCHAR), 2, '0') || ':' || lpad(CAST(p * 7 % 60 AS VARCHAR), 2, '0')
              || ':' || lpad(CAST(p * 11 % 60 AS VARCHAR), 2, '0') END AS transaction_time,
    {chosen(TYPE_TEXTS, "p", 13)} AS transaction_type,
    {chosen("['GROCERY','FUEL','TRAVEL',NULL]", "s", 4)} AS merchant_category,
    l_returnflag AS merchant_subcategory,
    CASE WHEN p % 41 = 0 THEN 'n/a'
         ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) END AS amount,
    {chosen(CURRENCY_TEXTS, "s", 7)} AS currency,
    l_linestatus AS channel,
    {chosen(PROVINCE_TEXTS, "s", 25)} AS province, 'City ' || s AS city, p % 2 = 0 AS retry_flag
  FROM (SELECT *, l_partkey AS p, l_suppkey AS s, 'A' || l_orderkey AS account,
          CAST(l_shipdate AS DATE) AS ship FROM lineitem)"""


# --- silver and gold ---------------------------------------------------------------


def latest(source: str, key: str, newest_first: list[str], ties: list[str]) -> str:
    order = [f"{c} DESC NULLS LAST" for c in newest_first] + [f"{c} ASC NULLS FIRST" for c in ties]
    return f"""
  SELECT * EXCLUDE (rank_) FROM (
    SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {", ".join(order)}) AS rank_
    FROM {source} WHERE {key} IS NOT NULL AND trim({key}) <> '') WHERE rank_ = 1"""


CUSTOMER_COLUMNS = [
    "customer_id", "first_name", "last_name", "dob", "gender", "province", "income_band", "segment",
    "risk_score", "kyc_status", "ingestion_timestamp",
]
ACCOUNT_COLUMNS = [
    "account_id", "customer_id", "account_type", "account_status", "account_open_date", "product_tier",
    "digital_channel", "credit_limit", "current_balance", "last_activity_date", "ingestion_timestamp",
]
TRANSACTION_COLUMNS = [
    "transaction_id", "account_id", "transaction_timestamp", "transaction_date", "transaction_type",
    "amount", "currency", "merchant_category", "merchant_subcategory", "channel",
    "location_province", "dq_flag", "ingestion_timestamp",
]

CTES["clean_customers"] = f"""
  SELECT trim(customer_id) AS customer_id, first_name, last_name, {day("dob")} AS dob, gender,
    {province("province")} AS province, income_band, segment, {whole("risk_score")} AS risk_score,
    kyc_status, {LOADED} AS ingestion_timestamp FROM raw_customers"""
CTES["silver_customers"] = latest(
    "clean_customers", "customer_id", ["ingestion_timestamp"], CUSTOMER_COLUMNS[1:]
)
CTES["clean_accounts"] = f"""
  SELECT trim(account_id) AS account_id, trim(customer_ref) AS customer_id, account_type, account_status,
    {day("open_date")} AS account_open_date, product_tier, digital_channel,
    {decimal("credit_limit")} AS credit_limit, {decimal("current_balance")} AS current_balance,
    {day("last_activity_date")} AS last_activity_date, {LOADED} AS ingestion_timestamp FROM raw_accounts"""
CTES["silver_accounts"] = latest("clean_accounts", "account_id", ["ingestion_timestamp"], ACCOUNT_COLUMNS[1:])
CTES["clean_transactions"] = f"""
  SELECT *, CAST(transaction_timestamp AS DATE) AS transaction_date FROM (
    SELECT trim(transaction_id) AS transaction_id, trim(account_id) AS account_id,
      {date_time("transaction_date", "transaction_time")} AS transaction_timestamp,
      {txn_type("transaction_type")} AS transaction_type, {decimal("amount")} AS amount,
      {currency("currency")} AS currency, merchant_category, merchant_subcategory, channel,
      {province("province")} AS location_province, CAST(NULL AS VARCHAR) AS dq_flag,
      {LOADED} AS ingestion_timestamp,
      CASE WHEN currency <> 'ZAR' AND ({currency("currency")}) = 'ZAR' THEN 'CURRENCY_VARIANT'
           WHEN amount IS NOT NULL AND trim(amount) <> '' AND {decimal("amount")} IS NULL
             THEN 'TYPE_MISMATCH'
           WHEN transaction_date IS NOT NULL AND trim(transaction_date) <> ''
             AND ({day("transaction_date")}) IS NULL THEN 'DATE_FORMAT' END AS issue
    FROM raw_transactions)"""
CTES["silver_transactions"] = latest(
    "clean_transactions",
    "transaction_id",
    ["transaction_timestamp", "ingestion_timestamp"],
    TRANSACTION_COLUMNS[1:],
)
CTES["flagged_transactions"] = latest(
    "(SELECT * REPLACE (issue AS dq_flag) FROM clean_transactions)",
    "transaction_id",
    ["transaction_timestamp", "ingestion_timestamp"],
    TRANSACTION_COLUMNS[1:],
)
CTES["dim_customers"] = f"""
  SELECT customer_id, gender, province, income_band, segment, risk_score, kyc_status,
    {age_band("dob")} AS age_band FROM silver_customers"""
CTES["dim_accounts"] = """
  SELECT account_id, customer_id, account_type, account_status, account_open_date AS open_date,
    product_tier, digital_channel, credit_limit, current_balance, last_activity_date
  FROM silver_accounts WHERE customer_id IN (SELECT customer_id FROM dim_customers)"""
CTES["fact"] = """
  SELECT t.transaction_id, t.transaction_date, t.transaction_timestamp, t.transaction_type,
    t.merchant_category, t.merchant_subcategory, t.amount, t.currency, t.channel,
    t.location_province AS province, t.dq_flag, t.ingestion_timestamp,
    a.account_id, c.customer_id
  FROM silver_transactions t JOIN dim_accounts a ON t.account_id = a.account_id
    JOIN dim_customers c ON a.customer_id = c.customer_id"""
# All rows, some under an id that nothing refers to.
CTES["rekeyed_customers"] = """
  SELECT CASE WHEN customer_id LIKE '%0' THEN 'X' || customer_id ELSE customer_id END AS customer_id
  FROM dim_customers"""
CTES["rekeyed_accounts"] = """
  SELECT CASE WHEN account_status = 'P' THEN 'X' || account_id ELSE account_id END AS account_id
  FROM dim_accounts"""

NEEDS = {
    "raw_customers": [],
    "raw_accounts": [],
    "raw_transactions": [],
    "clean_customers": ["raw_customers"],
    "silver_customers": ["clean_customers"],
    "clean_accounts": ["raw_accounts"],
    "silver_accounts": ["clean_accounts"],
    "clean_transactions": ["raw_transactions"],
    "silver_transactions": ["clean_transactions"],
    "flagged_transactions": ["clean_transactions"],
    "dim_customers": ["silver_customers"],
    "dim_accounts": ["silver_accounts", "dim_customers"],
    "fact": ["silver_transactions", "dim_accounts", "dim_customers"],
    "rekeyed_customers": ["dim_customers"],
    "rekeyed_accounts": ["dim_accounts"],
}


def on(tables: list[str], select: str) -> str:
    """``select`` with the CTEs it needs in front."""
    wanted: list[str] = []

    def add(name: str) -> None:
        for needed in NEEDS[name]:
            add(needed)
        if name not in wanted:
            wanted.append(name)

    for table in tables:
        add(table)
    defined = ", ".join(f"{name} AS MATERIALIZED ({CTES[name]})" for name in wanted)
    return f"WITH {defined} {select}" if wanted else select


def text(*columns: str) -> str:
    return ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in columns)


def real(*columns: str) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in columns)


def grouped(columns: str, source: str) -> str:
    return f"SELECT {columns}, count(*) AS n FROM {source} GROUP BY ALL"


SQL: dict[str, str] = {}

SQL["report_volume_by_type"] = on(
    ["fact"],
    """SELECT transaction_type, count(*) AS record_count, CAST(sum(amount) AS DOUBLE) AS total_amount,
         round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 2) AS pct_of_total
       FROM fact GROUP BY transaction_type ORDER BY transaction_type""",
)
SQL["report_unlinked_accounts"] = on(
    ["silver_accounts", "dim_customers"],
    """SELECT count(*) AS unlinked_accounts FROM silver_accounts a LEFT JOIN dim_customers c
         ON a.customer_id = c.customer_id WHERE c.customer_id IS NULL""",
)
SQL["report_province_distribution"] = on(
    ["dim_accounts", "dim_customers"],
    """SELECT c.province, count(DISTINCT a.account_id) AS account_count
       FROM dim_accounts a JOIN dim_customers c ON a.customer_id = c.customer_id
       GROUP BY c.province ORDER BY 1""",
)
SQL["standardise_txn_type"] = on(
    ["raw_transactions"],
    grouped(f"transaction_type, {txn_type('transaction_type')} AS standard", "raw_transactions"),
)
SQL["standardise_province"] = on(
    ["raw_customers"], grouped(f"province, {province('province')} AS standard", "raw_customers")
)
SQL["standardise_currency"] = on(
    ["raw_transactions"], grouped(f"currency, {currency('currency')} AS standard", "raw_transactions")
)
SQL["parse_dates"] = on(
    ["raw_transactions"],
    grouped(
        f"transaction_date, CAST({day('transaction_date')} AS VARCHAR) AS parsed_date", "raw_transactions"
    ),
)
SQL["combine_date_time"] = on(
    ["raw_transactions"],
    grouped(
        "transaction_date, transaction_time, "
        f"CAST({date_time('transaction_date', 'transaction_time')} AS VARCHAR) AS event_time",
        "raw_transactions",
    ),
)
# A text is a timestamp of its own if it is an ISO date, with or without a time;
# hours need not have two digits and seconds may be left out.
SQL["resolve_event_time"] = on(
    ["raw_transactions"],
    f"""SELECT source, CAST(CAST(event_time AS DATE) AS VARCHAR) AS event_date, count(*) AS n,
          CAST(min(event_time) AS VARCHAR) AS first_event, CAST(max(event_time) AS VARCHAR) AS last_event
        FROM (
          SELECT 'timestamp' AS source,
            CASE WHEN regexp_full_match(trim(transaction_date), '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}')
              THEN CASE WHEN transaction_time IS NULL
                THEN try_strptime(trim(transaction_date), '%Y-%m-%d')
                WHEN transaction_time = '9:00'
                THEN try_strptime(trim(transaction_date) || ' 09:00:00', '%Y-%m-%d %H:%M:%S')
                ELSE try_strptime(trim(transaction_date) || ' ' || transaction_time, '%Y-%m-%d %H:%M:%S')
              END END AS event_time FROM raw_transactions
          UNION ALL
          SELECT 'date_and_time', {date_time("transaction_date", "transaction_time")} FROM raw_transactions
          UNION ALL
          SELECT 'date_only', CAST({day("transaction_date")} AS TIMESTAMP) FROM raw_transactions
          UNION ALL
          SELECT 'neither', CAST(NULL AS TIMESTAMP) FROM raw_transactions)
        GROUP BY 1, 2""",
)
SQL["tolerant_casts"] = on(
    ["raw_customers", "raw_accounts"],
    f"""SELECT column_name, raw, "value", count(*) AS n FROM (
          SELECT 'risk_score' AS column_name, risk_score AS raw,
            CAST({whole("risk_score")} AS DOUBLE) AS "value" FROM raw_customers
          UNION ALL
          SELECT 'current_balance', current_balance, CAST({decimal("current_balance")} AS DOUBLE)
          FROM raw_accounts) GROUP BY ALL""",
)
SQL["age_band"] = on(
    ["raw_customers"], grouped(f"dob, {age_band('(' + day('dob') + ')')} AS age_band", "raw_customers")
)
SQL["surrogate_keys"] = on(
    ["raw_customers"],
    """SELECT count(*) AS n_rows, count(DISTINCT coalesce(trim(customer_id), '')) AS n_keys,
         CAST(0 AS BIGINT) AS n_null, CAST(0 AS BIGINT) AS n_negative FROM raw_customers""",
)
SQL["filter_nonblank_key"] = on(
    ["raw_transactions"],
    """SELECT trim(account_id) AS account_id, count(*) AS n FROM raw_transactions
       WHERE transaction_id IS NOT NULL AND trim(transaction_id) <> '' GROUP BY 1""",
)
SQL["dedupe_latest"] = f"""
  WITH lines AS (SELECT l_orderkey || '-' || l_linenumber AS line_id, l_shipdate AS shipped, l_partkey,
    l_suppkey, l_returnflag FROM lineitem)
  SELECT line_id, {text("shipped")}, l_partkey, l_suppkey, l_returnflag FROM (
    {latest("lines", "line_id", ["shipped"], ["l_partkey", "l_suppkey", "l_returnflag"])})"""
SQL["distinct_keys"] = on(
    ["raw_accounts", "raw_customers"],
    """SELECT 'account' AS kind, trim(account_id) AS account_id, min(account_type) AS account_type
       FROM raw_accounts GROUP BY 2
       UNION ALL SELECT DISTINCT 'segment', segment, CAST(NULL AS VARCHAR) FROM raw_customers""",
)
SQL["normalise_columns"] = """
  SELECT o_orderkey AS order_key, o_custkey AS cust_key, o_orderstatus AS order_status,
    CAST(o_orderdate AS VARCHAR) AS order_date, o_orderpriority AS order_priority FROM orders"""
SQL["alias_rename"] = on(
    ["raw_transactions"],
    """SELECT transaction_id, account_id AS account_ref, transaction_type, amount, account_id
       FROM raw_transactions""",
)
SQL["dedupe_columns"] = 'SELECT o_orderkey AS "key", o_orderstatus AS status FROM orders'
SQL["coerce_schema"] = on(
    ["raw_accounts"],
    f"""SELECT account_id, CAST(NULL AS VARCHAR) AS customer_id, CAST(NULL AS VARCHAR) AS account_type,
          CAST(NULL AS VARCHAR) AS account_status, CAST(NULL AS VARCHAR) AS account_open_date,
          CAST(NULL AS VARCHAR) AS product_tier, CAST(NULL AS VARCHAR) AS digital_channel,
          CAST({decimal("credit_limit")} AS DOUBLE) AS credit_limit,
          CAST(NULL AS DOUBLE) AS current_balance, last_activity_date,
          CAST(NULL AS VARCHAR) AS ingestion_timestamp FROM raw_accounts""",
)
SQL["nested_extract"] = on(
    ["raw_transactions"],
    grouped("province AS location_province, CAST(NULL AS VARCHAR) AS no_struct", "raw_transactions"),
)
SQL["bronze_metadata"] = on(
    ["raw_accounts"],
    f"""SELECT *, 'accounts_csv' AS source_system, CAST({LOADED} AS VARCHAR) AS ingestion_timestamp
        FROM raw_accounts""",
)
SQL["scan_csv_strings"] = on(["raw_accounts"], "SELECT * FROM raw_accounts")
SQL["resolved_keys"] = on(
    ["raw_accounts"],
    """SELECT count(*) AS n_ids, count(*) AS n_keys, count(*) FILTER (length(id) % 2 = 0 OR id LIKE '%3') AS n_kept,
         CAST(0 AS BIGINT) AS n_changed, CAST(0 AS BIGINT) AS n_out_of_range,
         count(*) FILTER (n > 1) AS repeated, CAST(0 AS BIGINT) AS collided
       FROM (SELECT trim(account_id) AS id, count(*) AS n FROM raw_accounts WHERE trim(account_id) <> '' GROUP BY ALL)""",
)
SQL["scan_csv_drift"] = on(
    ["raw_customers"],
    """SELECT customer_id, id_number, dob, province, risk_score,
         CASE WHEN CAST(substr(id_number, 3) AS BIGINT) % 3 = 2 THEN 'R' || id_number END AS referrer FROM raw_customers""",
)
SQL["scan_jsonl_nested"] = on(
    ["raw_transactions"],
    """SELECT transaction_id, account_id, transaction_date, amount, currency, province, city,
         CASE WHEN retry_flag THEN 'true' ELSE 'false' END AS retry_flag FROM raw_transactions""",
)
SQL["scan_jsonl_one_pass"] = SQL["scan_jsonl_nested"]
SQL["scan_parquet_counts"] = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}"
    for t in ("customer", "orders", "lineitem", "nation", "region", "events")
)
SILVER_CUSTOMERS_OUT = f"""SELECT * REPLACE ({text("dob", "ingestion_timestamp")}) FROM silver_customers"""
SQL["parquet_roundtrip"] = on(["silver_customers"], SILVER_CUSTOMERS_OUT)
SQL["silver_customers"] = on(["silver_customers"], SILVER_CUSTOMERS_OUT)
SQL["silver_accounts"] = on(
    ["silver_accounts"],
    f"""SELECT * REPLACE ({text("account_open_date", "last_activity_date", "ingestion_timestamp")},
          {real("credit_limit", "current_balance")}) FROM silver_accounts""",
)
SQL["silver_transactions"] = on(
    ["silver_transactions"],
    f"""SELECT * EXCLUDE (issue) REPLACE (
          {text("transaction_timestamp", "transaction_date", "ingestion_timestamp")}, {real("amount")})
        FROM silver_transactions""",
)
SQL["silver_transactions_flagged"] = on(["flagged_transactions"], grouped("dq_flag", "flagged_transactions"))
SQL["join_accounts_customers"] = on(
    ["silver_accounts", "silver_customers"],
    f"""SELECT account_id, customer_id, account_status, {real("current_balance")} FROM silver_accounts
        WHERE customer_id IN (SELECT customer_id FROM silver_customers)""",
)
SQL["split_join"] = """
  SELECT o_orderpriority, CASE WHEN rows > 3 THEN CAST(ceil(rows / 3.0) AS INTEGER) ELSE 1 END AS parts, count(*) AS n,
    CAST(sum(l_partkey) AS BIGINT) AS sum_partkey, CAST(sum(l_linenumber) AS BIGINT) AS sum_line
  FROM (SELECT *, count(*) OVER (PARTITION BY l_orderkey) AS rows FROM lineitem) JOIN orders ON l_orderkey = o_orderkey
  GROUP BY 1, 2"""
SQL["key_counts"] = on(
    ["fact", "dim_accounts", "dim_customers"],
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, '{key}_sk' AS key, count(DISTINCT {key}_id) AS n FROM {source}"
        for name, source, key in (
            ("dim_customers", "dim_customers", "customer"),
            ("dim_accounts", "dim_accounts", "account"),
            ("fact_transactions", "fact", "transaction"),
            ("fact_transactions", "fact", "account"),
            ("fact_transactions", "fact", "customer"),
        )
    ),
)
SQL["dim_customers"] = on(["dim_customers"], "SELECT * FROM dim_customers")
SQL["dim_accounts"] = on(
    ["dim_accounts"],
    f"""SELECT * REPLACE ({text("open_date", "last_activity_date")},
          {real("credit_limit", "current_balance")}) FROM dim_accounts""",
)
FACT_OUT = f"""SELECT * EXCLUDE (account_id, customer_id) REPLACE (
    {text("transaction_timestamp", "transaction_date", "ingestion_timestamp")}, {real("amount")}) FROM fact"""
SQL["fact_build"] = on(["fact"], FACT_OUT)
SQL["fact_by_key"] = SQL["fact_build"]
SQL["orphans_by_key"] = on(
    ["silver_transactions", "dim_accounts"],
    """SELECT transaction_type, count(*) AS n, count(DISTINCT account_id) AS n_accounts FROM silver_transactions t
       WHERE NOT EXISTS (SELECT 1 FROM dim_accounts a WHERE a.account_id = t.account_id) GROUP BY 1""",
)
SQL["clustered_scans"] = on(
    ["silver_transactions"],
    " UNION ALL ".join(
        f"""SELECT '{name}' AS scan, count(*) AS n, count(transaction_date) AS n_days,
              CAST(sum(amount) AS DOUBLE) AS total_amount FROM silver_transactions WHERE {condition}"""
        for name, condition in (
            ("all", "true"),
            ("days", "transaction_date >= DATE '1998-01-01'"),
            ("accounts", "account_id BETWEEN 'A1' AND 'A2'"),
        )
    ),
)
SQL["sample_records"] = on(["fact"], f"{FACT_OUT} ORDER BY transaction_id LIMIT 5")
SQL["orphaned_transactions"] = on(
    ["silver_transactions", "dim_accounts"],
    """SELECT count(*) AS orphan_count FROM silver_transactions t
       WHERE NOT EXISTS (SELECT 1 FROM dim_accounts a WHERE a.account_id = t.account_id)""",
)
SQL["ri_fact_account"] = on(
    ["fact", "rekeyed_accounts"],
    """SELECT count(DISTINCT account_id) AS orphan_keys FROM fact
       WHERE account_id NOT IN (SELECT account_id FROM rekeyed_accounts)""",
)
SQL["ri_fact_customer"] = on(
    ["fact", "rekeyed_customers"],
    """SELECT count(DISTINCT customer_id) AS orphan_keys FROM fact
       WHERE customer_id NOT IN (SELECT customer_id FROM rekeyed_customers)""",
)
SQL["ri_account_customer"] = on(
    ["silver_accounts", "dim_customers"],
    """SELECT count(DISTINCT customer_id) AS orphan_keys FROM silver_accounts
       WHERE customer_id IS NOT NULL AND customer_id NOT IN (SELECT customer_id FROM dim_customers)""",
)
LAYER_TABLES = {
    "bronze_accounts": "raw_accounts",
    "bronze_customers": "raw_customers",
    "bronze_transactions": "raw_transactions",
    "silver_accounts": "silver_accounts",
    "silver_customers": "silver_customers",
    "silver_transactions": "silver_transactions",
    "gold_dim_accounts": "dim_accounts",
    "gold_dim_customers": "dim_customers",
    "gold_fact_transactions": "fact",
}
COUNTS = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {source}" for name, source in LAYER_TABLES.items()
)
SQL["row_counts"] = on(list(LAYER_TABLES.values()), COUNTS)
DELTAS = """
  SELECT 'bronze_to_silver_accounts_delta' AS delta_name,
    (SELECT count(*) FROM raw_accounts) - (SELECT count(*) FROM silver_accounts) AS delta
  UNION ALL SELECT 'bronze_to_silver_customers_delta',
    (SELECT count(*) FROM raw_customers) - (SELECT count(*) FROM silver_customers)
  UNION ALL SELECT 'bronze_to_silver_transactions_delta',
    (SELECT count(*) FROM raw_transactions) - (SELECT count(*) FROM silver_transactions)
  UNION ALL SELECT 'silver_transactions_to_gold_fact_delta',
    (SELECT count(*) FROM silver_transactions) - (SELECT count(*) FROM fact)"""
SQL["reconciliation"] = on(list(LAYER_TABLES.values()), DELTAS)
SQL["null_counts"] = on(
    ["raw_accounts"],
    """SELECT count(*) - count(account_id) AS account_id, count(*) - count(customer_ref) AS customer_ref,
         count(*) - count(digital_channel) AS digital_channel,
         count(*) - count(last_activity_date) AS last_activity_date,
         CAST(-1 AS BIGINT) AS no_such_column FROM raw_accounts""",
)
SQL["duplicate_key_groups"] = on(
    ["raw_transactions"],
    """SELECT 'transaction_id' AS "key", count(*) AS duplicate_groups FROM (
         SELECT 1 FROM raw_transactions GROUP BY transaction_id HAVING count(*) > 1)
       UNION ALL SELECT 'account_and_type', count(*) FROM (
         SELECT 1 FROM raw_transactions GROUP BY account_id, transaction_type HAVING count(*) > 1)
       UNION ALL SELECT 'missing', CAST(-1 AS BIGINT)""",
)
FIGURES = """CAST(sum(amount) AS DOUBLE) AS {p}total{s},
  round(CAST(sum(amount) AS DOUBLE) / count(amount), 6) AS {p}average{s},
  CAST(min(amount) AS DOUBLE) AS {p}minimum{s}, CAST(max(amount) AS DOUBLE) AS {p}maximum{s}"""
SQL["amount_summary"] = on(
    ["fact"], f"SELECT count(*) AS transaction_count, {FIGURES.format(p='', s='_amount')} FROM fact"
)
SQL["table_profile"] = on(
    ["raw_transactions"],
    f"""SELECT count(*) AS "rows", count(*) - count(transaction_id) AS nulls_transaction_id,
          count(*) - count(currency) AS nulls_currency, CAST(-1 AS BIGINT) AS nulls_absent,
          {FIGURES.format(p="amount_", s="")},
          (SELECT count(*) FROM (SELECT 1 FROM raw_transactions GROUP BY transaction_id
             HAVING count(*) > 1)) AS duplicates
        FROM (SELECT transaction_id, currency, {decimal("amount")} AS amount FROM raw_transactions)""",
)


def domain(name: str, expected: str, actual: str) -> str:
    return f"""SELECT '{name}' AS domain, coalesce(e.v, a.v) AS "value", e.here IS NOT NULL AS in_expected,
        a.here IS NOT NULL AS in_actual,
        CASE WHEN e.here IS NULL THEN 'unexpected' WHEN a.here IS NULL THEN 'missing' ELSE 'ok' END AS verdict
      FROM (SELECT unnest({expected}) AS v, 1 AS here) e
      FULL OUTER JOIN (SELECT v, 1 AS here FROM ({actual}) GROUP BY v) a ON e.v IS NOT DISTINCT FROM a.v"""


EXPECTED_TYPES = "['CREDIT','DEBIT','FEE','REVERSAL']"
EXPECTED_PROVINCES = (
    "['Eastern Cape','Free State','Gauteng','KwaZulu-Natal','Limpopo','Mpumalanga','North West',"
    "'Northern Cape','Western Cape']"
)
DOMAINS = (
    domain("transaction_type", EXPECTED_TYPES, "SELECT transaction_type AS v FROM fact")
    + " UNION ALL "
    + domain(
        "province",
        EXPECTED_PROVINCES,
        "SELECT c.province AS v FROM dim_accounts a JOIN dim_customers c ON a.customer_id = c.customer_id",
    )
)
SQL["domain_check"] = on(["fact", "dim_accounts", "dim_customers"], DOMAINS)
SQL["validation_findings"] = on(
    ["fact", "dim_accounts", "dim_customers"],
    f"""SELECT domain, "value", verdict,
          domain || ': ' || verdict || ' value ' || chr(39) || coalesce("value", 'NULL') || chr(39) AS message
        FROM ({DOMAINS}) WHERE verdict <> 'ok'""",
)

# Every check of the report as (group, name, value, healthy or NULL).
UNIQUE_KEYS = {
    "silver_accounts": ("account_id", "account_id", ["account_id"]),
    "silver_customers": ("customer_id", "customer_id", ["customer_id"]),
    "silver_transactions": ("transaction_id", "transaction_id", ["transaction_id", "account_id"]),
    "gold_dim_accounts": ("account_sk", "account_id", ["account_sk"]),
    "gold_dim_customers": ("customer_sk", "customer_id", ["customer_sk"]),
    "gold_fact_transactions": ("transaction_sk", "transaction_id", ["transaction_sk", "account_sk", "customer_sk"]),
}
CHECKS = [
    f"SELECT 'missing_tables' AS check_group, '{name}' AS check_name, 0.0::DOUBLE AS v, true AS decides"
    for name in LAYER_TABLES
]
CHECKS += [f"SELECT 'row_counts', table_name, row_count::DOUBLE, false FROM ({COUNTS})"]
CHECKS += [f"SELECT 'reconciliation', delta_name, delta::DOUBLE, false FROM ({DELTAS})"]
for _name, (_key, _id, _nulls) in UNIQUE_KEYS.items():
    _source = LAYER_TABLES[_name]
    CHECKS.append(
        f"""SELECT 'duplicates', '{_name}_duplicate_{_key}', count(*)::DOUBLE, true FROM (
              SELECT 1 FROM {_source} GROUP BY {_id} HAVING count(*) > 1)"""
    )
    for _column in _nulls:
        _natural = _column.replace("_sk", "_id")
        CHECKS.append(
            f"""SELECT 'null_critical_keys', '{_name}_null_{_column}',
                  (count(*) - count({_natural}))::DOUBLE, true FROM {_source}"""
        )
CHECKS += [
    "SELECT 'amount_summary', 'transaction_count', count(*)::DOUBLE, false FROM fact",
    "SELECT 'amount_summary', 'total_amount', sum(amount)::DOUBLE, false FROM fact",
    "SELECT 'amount_summary', 'average_amount', round(sum(amount)::DOUBLE / count(amount), 6), false FROM fact",
    "SELECT 'amount_summary', 'minimum_amount', min(amount)::DOUBLE, false FROM fact",
    "SELECT 'amount_summary', 'maximum_amount', max(amount)::DOUBLE, false FROM fact",
    """SELECT 'referential_integrity', 'fact_account_sk_not_in_dim_accounts',
         count(DISTINCT account_id)::DOUBLE, true FROM fact
         WHERE account_id NOT IN (SELECT account_id FROM dim_accounts)""",
    """SELECT 'referential_integrity', 'fact_customer_sk_not_in_dim_customers',
         count(DISTINCT customer_id)::DOUBLE, true FROM fact
         WHERE customer_id NOT IN (SELECT customer_id FROM dim_customers)""",
    """SELECT 'referential_integrity', 'dim_account_customer_id_not_in_dim_customers',
         count(DISTINCT customer_id)::DOUBLE, true FROM dim_accounts
         WHERE customer_id NOT IN (SELECT customer_id FROM dim_customers)""",
    """SELECT 'unlinked_accounts', 'unlinked_accounts', count(*)::DOUBLE, true FROM dim_accounts
         WHERE customer_id IS NULL OR customer_id NOT IN (SELECT customer_id FROM dim_customers)""",
]
CHECKS += [
    f"""SELECT 'domains', '{d}_{v}_values', count(*) FILTER (verdict = '{v}')::DOUBLE, true
        FROM ({DOMAINS}) WHERE domain = '{d}'"""
    for d in ("transaction_type", "province")
    for v in ("missing", "unexpected")
]
SQL["validation_report"] = on(
    list(LAYER_TABLES.values()),
    f"""SELECT check_group, check_name, v AS "value", passed,
          CASE WHEN bool_or(NOT passed AND check_group = 'missing_tables') OVER () THEN 'FAIL'
               WHEN bool_or(NOT passed) OVER () THEN 'WARN' ELSE 'PASS' END AS report_status
        FROM (SELECT *, CASE WHEN decides THEN v = 0 END AS passed FROM ({" UNION ALL ".join(CHECKS)}))""",
)

# --- data quality ------------------------------------------------------------------------


def filled(v: str) -> str:
    return f"({v} IS NOT NULL AND trim({v}) <> '')"


def unreadable(v: str, parsed: str) -> str:
    return f"({filled(v)} AND ({parsed}) IS NULL)"


def per_table(counts: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, CAST({count} AS BIGINT) AS record_count FROM raw_{table}"
        for table, count in counts.items()
    )


KEYS = {"customers": "customer_id", "accounts": "account_id", "transactions": "transaction_id"}
RAW_TABLES = [f"raw_{t}" for t in KEYS]
ISSUES = {
    "DUPLICATE_DEDUPED": per_table(
        {t: f"count(*) FILTER ({filled(k)}) - count(DISTINCT trim({k})) FILTER ({filled(k)})" for t, k in KEYS.items()}
    ),
    "TYPE_MISMATCH": per_table(
        {
            "customers": f"count(*) FILTER ({unreadable('risk_score', whole('risk_score'))})",
            "accounts": f"count(*) FILTER ({unreadable('credit_limit', decimal('credit_limit'))})"
            f" + count(*) FILTER ({unreadable('current_balance', decimal('current_balance'))})",
            "transactions": f"count(*) FILTER ({unreadable('amount', decimal('amount'))})",
        }
    ),
    "DATE_FORMAT": per_table(
        {
            "customers": f"count(*) FILTER ({unreadable('dob', day('dob'))})",
            "accounts": f"count(*) FILTER ({unreadable('open_date', day('open_date'))})"
            f" + count(*) FILTER ({unreadable('last_activity_date', day('last_activity_date'))})",
            "transactions": f"count(*) FILTER ({unreadable('transaction_date', day('transaction_date'))})",
        }
    ),
    "CURRENCY_VARIANT": per_table(
        {
            "customers": "0 * count(*)",
            "accounts": "0 * count(*)",
            "transactions": f"count(*) FILTER (currency <> 'ZAR' AND ({currency('currency')}) = 'ZAR')",
        }
    ),
    "NULL_REQUIRED": per_table({t: f"count(*) FILTER (NOT {filled(k)})" for t, k in KEYS.items()}),
}
for _query, _code in {
    "dq_duplicates": "DUPLICATE_DEDUPED",
    "dq_type_mismatch": "TYPE_MISMATCH",
    "dq_date_format": "DATE_FORMAT",
    "dq_currency_variant": "CURRENCY_VARIANT",
    "dq_null_required": "NULL_REQUIRED",
}.items():
    SQL[_query] = on(RAW_TABLES, ISSUES[_code])

ACTIONS = [
    ("ORPHANED_ACCOUNT", "quarantine_from_gold_fact_and_report"),
    ("DUPLICATE_DEDUPED", "deduplicate_keep_latest_and_report"),
    ("TYPE_MISMATCH", "cast_to_expected_type_and_report_if_uncastable"),
    ("DATE_FORMAT", "parse_supported_formats_and_report_if_unparseable"),
    ("CURRENCY_VARIANT", "standardise_to_ZAR"),
    ("NULL_REQUIRED", "reject_from_silver_and_report"),
]
ORPHANS = """SELECT count(*) AS record_count FROM silver_transactions t
  WHERE NOT EXISTS (SELECT 1 FROM dim_accounts a WHERE a.account_id = t.account_id)"""
SQL["dq_summary"] = on(
    [*RAW_TABLES, "silver_transactions", "dim_accounts"],
    "SELECT *, CAST(sum(record_count) OVER () AS BIGINT) AS total_flagged_records FROM ("
    + " UNION ALL ".join(
        f"""SELECT {i} AS issue_order, '{code}' AS issue_code, CAST(sum(record_count) AS BIGINT) AS record_count,
              '{action}' AS handling_action FROM ({ISSUES.get(code, ORPHANS)})"""
        for i, (code, action) in enumerate(ACTIONS, 1)
    )
    + ")",
)

_ACTION = dict(ACTIONS) | {"UNLINKED_ACCOUNT": "quarantine_from_gold_dim_and_report"}
_REJECTED = [
    *[(t, "silver", "DUPLICATE_DEDUPED", f"trim({k})", "count(*) - 1", f"raw_{t} WHERE {filled(k)}", "HAVING count(*) > 1")
      for t, k in KEYS.items()],
    *[(t, "silver", "NULL_REQUIRED", f"trim({k})", "count(*)", f"raw_{t} WHERE NOT {filled(k)}", "") for t, k in KEYS.items()],
    ("accounts", "gold", "UNLINKED_ACCOUNT", "account_id", "count(*)",
     "silver_accounts s WHERE NOT EXISTS (SELECT 1 FROM dim_customers p WHERE p.customer_id = s.customer_id)", ""),
    ("transactions", "gold", "ORPHANED_ACCOUNT", "transaction_id", "count(*)",
     "silver_transactions s WHERE NOT EXISTS (SELECT 1 FROM dim_accounts p WHERE p.account_id = s.account_id)", ""),
]
_REJECTS = " UNION ALL ".join(
    f"""SELECT '{t}' AS table_name, '{layer}' AS layer, '{code}' AS issue_code, '{_ACTION[code]}' AS handling_action,
          {key} AS record_key, CAST({n} AS BIGINT) AS n_records FROM {source} GROUP BY {key} {having}"""
    for t, layer, code, key, n, source, having in _REJECTED
)
_QUARANTINE_TABLES = [*RAW_TABLES, "silver_customers", "silver_accounts", "silver_transactions", "dim_customers", "dim_accounts"]
SQL["quarantined_records"] = on(_QUARANTINE_TABLES, f"SELECT *, n_records AS n_named FROM ({_REJECTS})")
_STEPS = {
    "silver_customers": ("raw_customers", "silver_customers", "customers", "silver"),
    "silver_accounts": ("raw_accounts", "silver_accounts", "accounts", "silver"),
    "silver_transactions": ("raw_transactions", "silver_transactions", "transactions", "silver"),
    "gold_dim_accounts": ("silver_accounts", "dim_accounts", "accounts", "gold"),
    "gold_fact_transactions": ("silver_transactions", "fact", "transactions", "gold"),
}
SQL["quarantine_balance"] = on(
    [*_QUARANTINE_TABLES, "fact"],
    " UNION ALL ".join(
        f"""SELECT '{step}' AS step, (SELECT count(*) FROM {came}) AS n_came, (SELECT count(*) FROM {kept}) AS n_kept,
              (SELECT CAST(coalesce(sum(n_records), 0) AS BIGINT) FROM ({_REJECTS})
               WHERE table_name = '{t}' AND layer = '{layer}') AS n_rejected, true AS balanced"""
        for step, (came, kept, t, layer) in _STEPS.items()
    ),
)
SQL["reported_records"] = on(
    RAW_TABLES,
    " UNION ALL ".join(
        f"SELECT table_name, '{code}' AS issue_code, record_count FROM ({ISSUES[code]}) WHERE record_count > 0"
        for code in ("TYPE_MISMATCH", "DATE_FORMAT", "CURRENCY_VARIANT")
    ),
)

"""Names, spellings and codes that the results depend on.

They are data, kept together and stated as plain text. No logic lives here.
"""

# Every accepted spelling (upper case, single spaces) of each
# transaction type.
TRANSACTION_TYPES = {
    "CREDIT": ("CR", "CREDIT", "CREDITS"),
    "DEBIT": ("DR", "DEBIT", "DEBITS"),
    "FEE": ("FEE", "FEES", "CHARGE", "CHARGES"),
    "REVERSAL": ("REV", "REVERSE", "REVERSAL", "REVERSALS"),
}

# Every accepted spelling of each province.
PROVINCES = {
    "Eastern Cape": ("EC", "EASTERN CAPE"),
    "Free State": ("FS", "FREE STATE"),
    "Gauteng": ("GP", "GAUTENG"),
    "KwaZulu-Natal": ("KZN", "KWAZULU NATAL", "KWAZULU-NATAL"),
    "Limpopo": ("LP", "LIMPOPO"),
    "Mpumalanga": ("MP", "MPUMALANGA"),
    "North West": ("NW", "NORTH WEST"),
    "Northern Cape": ("NC", "NORTHERN CAPE"),
    "Western Cape": ("WC", "WESTERN CAPE"),
}

# Every accepted spelling of the home currency.
HOME_CURRENCY = "ZAR"
CURRENCIES = {HOME_CURRENCY: ("ZAR", "R", "RAND", "RANDS", "710")}

# Lowest age (whole years) of each age band.
AGE_BANDS = {
    18: "18-25",
    26: "26-35",
    36: "36-45",
    46: "46-55",
    56: "56-65",
    65: "65+",
}

# Other names a column may arrive under, best first.
CUSTOMER_ALIASES = {
    "customer_id": ("customer_ref", "cust_id", "client_id"),
    "dob": ("date_of_birth", "birth_date"),
    "province": ("province_name", "home_province", "customer_province"),
    "kyc_status": ("risk_kyc_status",),
    "risk_score": ("risk_rating",),
}
ACCOUNT_ALIASES = {
    "account_id": ("account_ref", "acct_id"),
    "customer_id": ("customer_ref", "cust_id", "client_id"),
    "account_open_date": ("open_date", "opened_date"),
}
TRANSACTION_ALIASES = {
    "transaction_id": ("txn_id", "transaction_ref", "transaction_reference"),
    "account_id": ("acct_id", "account_ref"),
    "transaction_type": ("txn_type", "type"),
    "amount": ("transaction_amount", "txn_amount", "value"),
    "merchant_category": ("merchant_cat", "merchant_category_code"),
    "merchant_subcategory": ("merchant_sub_category", "merchant_subcat"),
}

# Columns the event time may be taken from, best first.
EVENT_TIMESTAMP_NAMES = (
    "transaction_timestamp",
    "txn_timestamp",
    "timestamp",
    "datetime",
    "transaction_datetime",
)
EVENT_DATE_NAMES = ("transaction_date", "txn_date", "date", "transaction_dt")
EVENT_TIME_NAMES = ("transaction_time", "txn_time", "time")

# Data-quality codes in report order, and how each is handled.
ISSUE_HANDLING = {
    "ORPHANED_ACCOUNT": "quarantine_from_gold_fact_and_report",
    "DUPLICATE_DEDUPED": "deduplicate_keep_latest_and_report",
    "TYPE_MISMATCH": "cast_to_expected_type_and_report_if_uncastable",
    "DATE_FORMAT": "parse_supported_formats_and_report_if_unparseable",
    "CURRENCY_VARIANT": "standardise_to_ZAR",
    "NULL_REQUIRED": "reject_from_silver_and_report",
}

# Source labels written into bronze.
SOURCE_LABELS = {
    "customers": "customers_csv",
    "accounts": "accounts_csv",
    "transactions": "transactions_jsonl",
}

# Names in the validation report.
# Differences of row counts: rows of the first table minus rows of the second.
RECONCILED = {
    "bronze_to_silver_accounts_delta": ("bronze_accounts", "silver_accounts"),
    "bronze_to_silver_customers_delta": ("bronze_customers", "silver_customers"),
    "bronze_to_silver_transactions_delta": ("bronze_transactions", "silver_transactions"),
    "silver_transactions_to_gold_fact_delta": ("silver_transactions", "gold_fact_transactions"),
}
LINK_CHECKS = (
    "fact_account_sk_not_in_dim_accounts",
    "fact_customer_sk_not_in_dim_customers",
    "dim_account_customer_id_not_in_dim_customers",
)
UNLINKED_CHECK = "unlinked_accounts"

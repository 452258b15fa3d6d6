"""Column expressions. Each takes a Column and returns a Column."""

from silverline.functions.categories import currency, province, transaction_type
from silverline.functions.keys import surrogate_key, trimmed_key
from silverline.functions.numbers import share_of, tolerant_decimal, tolerant_int
from silverline.functions.times import age_band, date_and_time, event_time, flexible_date

__all__ = [
    "age_band",
    "currency",
    "date_and_time",
    "event_time",
    "flexible_date",
    "province",
    "share_of",
    "surrogate_key",
    "tolerant_decimal",
    "tolerant_int",
    "transaction_type",
    "trimmed_key",
]

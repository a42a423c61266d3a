"""Column expressions used by the operators and plans."""

from shelfmark.functions.cleaning import (
    contact_email,
    id_prefix,
    lenient_double,
    parsed_date,
    product_label,
    text_key,
)
from shelfmark.functions.measures import exact_mean, sale_amount, stock_status

__all__ = [
    "contact_email", "exact_mean", "id_prefix", "lenient_double", "parsed_date",
    "product_label", "sale_amount", "stock_status", "text_key",
]

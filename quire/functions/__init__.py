"""Native column expressions: dates, ISBNs, text, codes and types."""

from quire.functions.codes import (
    display_name,
    format_label,
    is_missing,
    movement_label,
    price_band,
    status_label,
    stock_total,
)
from quire.functions.dates import cyymmdd_to_date, date_to_cyymmdd, iso_date
from quire.functions.isbn import (
    isbn10_to_13,
    isbn13_check_digit,
    isbn13_has_shape,
    isbn13_valid,
    normalise_isbn,
)
from quire.functions.text import ACCENTS, contains_any, strip_controls, trim_fixed
from quire.functions.types import spark_type_name, typed

__all__ = [
    "ACCENTS", "contains_any", "cyymmdd_to_date", "date_to_cyymmdd", "display_name",
    "format_label", "is_missing", "isbn10_to_13", "isbn13_check_digit", "isbn13_has_shape",
    "isbn13_valid", "iso_date", "movement_label", "normalise_isbn", "price_band",
    "spark_type_name", "status_label", "stock_total", "strip_controls", "trim_fixed", "typed",
]

"""ISBN checks and conversion as arithmetic on one long.

With n the number behind the digits, each digit is congruent to n div 10^k modulo 10, so the weighted
digit sum modulo 10 needs no digit to be cut out: it is the weighted sum of the shifted numbers.

All functions take a column name or any SQL expression.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BOOK_PREFIX = 978
SMALLEST_13_DIGITS = 10**12


def _checksum(number: str, digits: int, heavy_first: bool) -> str:
    """Digit sum weighted 1, 3, 1, 3... from the last digit leftwards, or 3, 1, 3, 1..., modulo ten."""
    shifted = [f"{number} DIV {10**k}L" if k else number for k in range(digits)]
    light, heavy = (shifted[1::2], shifted[::2]) if heavy_first else (shifted[::2], shifted[1::2])
    return f"(({' + '.join(light)} + 3L * ({' + '.join(heavy)})) % 10L)"


def _valid(isbn: str) -> str:
    text = f"trim({isbn})"
    number = f"try_cast({text} AS BIGINT)"
    # A 13-character text whose value has 13 digits holds nothing but digits; only a leading
    # zero needs the pattern, so the regular expression is hardly ever run.
    return (
        f"coalesce(length({text}) = 13"
        f" AND ({number} >= {SMALLEST_13_DIGITS}L OR {text} RLIKE '^[0-9]{{13}}$')"
        f" AND {_checksum(number, 13, heavy_first=False)} = 0, false)"
    )


def _check_digit(twelve: str) -> str:
    return f"((10L - {_checksum(twelve, 12, heavy_first=True)}) % 10L)"


def _from_isbn10(isbn: str) -> str:
    text = f"upper(translate({isbn}, '- ', ''))"
    body = f"try_cast(substring({text}, 1, 9) AS BIGINT)"
    last = f"substring({text}, 10, 1)"
    weighted = " + ".join(f"{body} DIV {10**k}L % 10L * {k + 2}L" for k in range(9))
    check = f"(CASE WHEN {last} = 'X' THEN 10 ELSE try_cast({last} AS INT) END)"
    twelve = f"({body} + {BOOK_PREFIX * 10**9}L)"
    return (
        f"CASE WHEN {text} RLIKE '^[0-9]{{9}}[0-9X]$' AND ({weighted} + {check}) % 11L = 0"
        f" THEN string({twelve} * 10L + {_check_digit(twelve)}) END"
    )


def isbn13_valid(isbn: str) -> Column:
    """True for 13 digits (blanks around them ignored) whose 1,3-weighted sum is a multiple of ten."""
    return F.expr(_valid(isbn))


def isbn13_has_shape(isbn: str) -> Column:
    """Weaker test: 978 or 979 and ten digits. NULL has no shape."""
    return F.expr(f"coalesce({isbn} RLIKE '^97[89][0-9]{{10}}$', false)")


def isbn13_check_digit(twelve: str) -> Column:
    """The check digit of a 12-digit number."""
    return F.expr(_check_digit(twelve))


def isbn10_to_13(isbn: str) -> Column:
    """A valid ISBN-10 (mod 11, X = 10) as ISBN-13, else NULL. Hyphens and blanks are ignored."""
    return F.expr(_from_isbn10(isbn))


def normalise_isbn(isbn: str) -> Column:
    """Either format to a valid ISBN-13, NULL for neither."""
    thirteen = f"translate({isbn}, '- ', '')"
    return F.expr(f"CASE WHEN {_valid(thirteen)} THEN {thirteen} ELSE {_from_isbn10(isbn)} END")

"""Text clean-up and search."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.functions.columns import ColumnOrName, as_column

# The accented characters whose survival is audited.
ACCENTS = {
    "é": "e acute",
    "è": "e grave",
    "ê": "e circumflex",
    "ë": "e diaeresis",
    "à": "a grave",
    "ù": "u grave",
    "ç": "c cedilla",
    "â": "a circumflex",
    "î": "i circumflex",
    "ô": "o circumflex",
    "ü": "u diaeresis",
    "ï": "i diaeresis",
    "í": "i acute",
    "á": "a acute",
}

# Signs that a conversion went wrong: the replacement character, and UTF-8 read as Latin-1.
DAMAGE = {
    "�": "replacement character",
    "Ã©": "e acute read as Latin-1",
    "Ã¨": "e grave read as Latin-1",
}

SEARCHED_IN_NAMES = ("é", "è", "ê", "ç", "à", "ù")


def trim_fixed(text: ColumnOrName) -> Column:
    """Remove the blanks that pad a fixed-width column."""
    return F.trim(as_column(text))


def strip_controls(text: ColumnOrName) -> Column:
    """Remove control characters U+0000 to U+001F."""
    return F.regexp_replace(as_column(text), r"[\x00-\x1f]", "")


def contains_any(columns: list[ColumnOrName], needles: tuple[str, ...]) -> Column:
    """True when any column holds any of the texts; NULL columns hold nothing."""
    tests = [
        F.coalesce(as_column(c).contains(needle), F.lit(False))
        for c in columns
        for needle in needles
    ]
    return reduce(or_, tests)

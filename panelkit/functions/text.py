"""Labels, code prefixes, locale numbers and coded cells."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as whitespace, as a class of a Unicode-aware pattern and as a text.
# The Unicode property alone would leave out the four separators.
UNICODE = "(?U)"
WHITESPACE = r"[\s\x1c-\x1f]"
WHITESPACE_CHARACTERS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Texts that a delimited field may hold for "missing".
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)

# what a number may consist of; the cast knows the order, but takes words and suffixes of other languages as well
NUMBER_CHARACTERS = "0123456789+-.eE"

NO_DATA = "no_data"
NOT_REPRESENTATIVE = "not_representative"


def strip(text: Column) -> Column:
    """Trim every kind of whitespace, the no-break space included."""
    return F.btrim(text, F.lit(WHITESPACE_CHARACTERS))


def normalise_label(text: Column) -> Column:
    """Collapse whitespace, trim, and drop the blank before a closing bracket."""
    collapsed = F.trim(F.regexp_replace(text, f"{UNICODE}{WHITESPACE}+", " "))
    return F.replace(collapsed, F.lit(" )"), F.lit(")"))


def decode(value: Column, codes: Mapping[str, str]) -> Column:
    """CASE without ELSE: an unknown value becomes NULL, for a check to find."""
    result = None
    for label, code in codes.items():
        result = (F if result is None else result).when(value == label, F.lit(code))
    return result


def code_prefix(text: Column, default: str = "00", digits: int = 2) -> Column:
    """The leading code of ``'01 Name'``; the default where there is none."""
    code = F.regexp_extract(strip(text), _prefixed(digits), 1)
    return F.when(text.isNull(), None).otherwise(F.coalesce(F.nullif(code, F.lit("")), F.lit(default)))


def code_name(text: Column, digits: int = 2) -> Column:
    """The text after the optional code; NULL when there is nothing left."""
    return F.nullif(F.regexp_extract(strip(text), _prefixed(digits), 2), F.lit(""))


def _prefixed(digits: int) -> str:
    return rf"{UNICODE}^(?:(\p{{Nd}}{{{digits}}}){WHITESPACE}+)?([^\n]+)\z"


def locale_number(text: Column, strict: bool = True, tokens: tuple[str, ...] = ("",)) -> Column:
    """A number written with a decimal comma.

    Missing tokens become NULL. Other text that is no number, by the pattern and
    not only to the cast, raises when strict and becomes NULL otherwise.
    """
    plain = F.replace(strip(text), F.lit(","), F.lit("."))
    # a cast that is bound to fail names the text
    other = F.concat(F.lit("no number: "), plain).cast("double") if strict else F.lit(None).cast("double")
    number = F.when(F.translate(plain, NUMBER_CHARACTERS, "") == "", plain.try_cast("double"))
    missing = plain.isin(*[t.replace(",", ".") for t in tokens])
    return F.when(missing, None).otherwise(F.coalesce(number, other) if strict else number)


def padded(number: Column, digits: int = 2) -> Column:
    """A number as text with leading zeros; longer ones stay whole."""
    plain = number.cast("string")
    return F.when(F.length(plain) < digits, F.lpad(plain, digits, "0")).otherwise(plain)


def year_label(text: Column, pattern: str) -> Column:
    """The year found anywhere in a heading, else NULL."""
    found = F.nullif(F.regexp_extract(text, _wide(pattern), 1), F.lit(""))
    return found.cast("bigint")


def quarter_label(text: Column, pattern: str) -> Column:
    """The quarter when the whole heading is a quarter label, else NULL."""
    found = F.nullif(F.regexp_extract(strip(text), pattern, 1), F.lit(""))
    return found.cast("bigint")


def _wide(pattern: str) -> str:
    return UNICODE + pattern.replace(r"\s", WHITESPACE)


def sentinel_flag(number: Column, text: Column, not_representative: str) -> Column:
    """Why a cell holds no value; ``'unexpected'`` marks text nobody knows."""
    stripped = F.coalesce(strip(text), F.lit(""))
    return (
        F.when(number.isNotNull(), None)
        .when(stripped == "", NO_DATA)
        .when(F.lower(stripped) == not_representative.lower(), NOT_REPRESENTATIVE)
        .otherwise("unexpected")
    )


def quarter_start(year: Column, quarter: Column) -> Column:
    """First day of a quarter."""
    return F.make_date(year.cast("int"), (3 * quarter - 2).cast("int"), F.lit(1))

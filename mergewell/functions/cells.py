"""Cell-level column expressions: missing values, numbers, dates, symbols, text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The spellings of "missing", compared with the untrimmed cell.
NA_TOKENS = (
    "NA", "N A", "N/A", "#N/A", " NA", "NA ", "N / A", "N /A", "N / A ",
    "na", "n a", "n/a", " na", "na ", "n /a", "n / a", "a / a", "n / a ",
    "NULL", "null", "", ".", "*", "?", "-", " - ",
)

# try_cast alone would take "1d" or "NaN", so numbers must pass this first.
NUMERIC_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
US_DATE_PATTERN = r"^([0-9]{1,2})/([0-9]{1,2})/([0-9]{1,4})"


def null_tokens(cell: Column, tokens=NA_TOKENS) -> Column:
    """The cell, or NULL when it is one of the missing-value spellings."""
    return F.when(cell.isin(*tokens), None).otherwise(cell)


def is_numeric_text(cell: Column) -> Column:
    """Whether the cell is a plain number; NULL for a missing cell."""
    return F.when(
        cell.isNotNull(), cell.rlike(NUMERIC_PATTERN) & cell.try_cast("double").isNotNull())


def as_number(cell: Column) -> Column:
    """Text to DOUBLE; NULL for anything that is not a plain number."""
    return F.when(cell.rlike(NUMERIC_PATTERN), F.trim(cell).try_cast("double"))


def is_us_date(cell: Column) -> Column:
    """True when the cell starts with a valid month/day/year; text may follow."""
    month, day, year = (F.regexp_extract(cell, US_DATE_PATTERN, i) for i in (1, 2, 3))
    iso = F.concat_ws("-", F.lpad(year, 4, "0"), F.lpad(month, 2, "0"), F.lpad(day, 2, "0"))
    valid = iso.try_cast("date").isNotNull()
    return F.coalesce(cell.rlike(US_DATE_PATTERN) & valid, F.lit(False))


def is_symbol_only(cell: Column) -> Column:
    return F.coalesce(~cell.rlike("[A-Za-z0-9]"), F.lit(False))


def clean_text(cell: Column) -> Column:
    """Snake-case form of a text value, the value-level twin of naming.clean_name."""
    text = F.regexp_replace(cell, "['\"]", "")
    text = F.regexp_replace(text, "%", "_percent_")
    text = F.regexp_replace(text, "#", "_number_")
    text = F.regexp_replace(text, "([a-z0-9])([A-Z])", "$1_$2")
    text = F.regexp_replace(F.lower(text), "[^a-z0-9]+", "_")
    text = F.regexp_replace(text, "^_+|_+$", "")
    return F.when(text.rlike("^[0-9]") | (text == ""), F.concat(F.lit("x"), text)).otherwise(text)


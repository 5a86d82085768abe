"""Quoting of names and values for stored SQL text, and rule descriptions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def quote_name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def quote_value(text: str) -> str:
    """A Spark SQL string literal that reads back as exactly ``text``."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def col(name: str) -> Column:
    """Column by its literal name, dots and backticks included."""
    return F.col(quote_name(name))


def quoted(name: Column) -> Column:
    """``quote_name`` as a column expression."""
    return F.concat(F.lit("`"), F.replace(name, F.lit("`"), F.lit("``")), F.lit("`"))


def quoted_value(text: Column) -> Column:
    """``quote_value`` as a column expression."""
    escaped = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.concat(F.lit("'"), F.replace(escaped, F.lit("'"), F.lit("\\'")), F.lit("'"))


def readable(name: Column) -> Column:
    """Column name as shown in descriptions."""
    return F.replace(name, F.lit("_"), F.lit(" "))


# Description templates, by case.
DESCRIPTIONS = {
    "null_unexpected": "Checks for unexpected NULL values in the NOT NULL column '%s' in table '%s'.",
    "null_nullable": "Counts NULL values in the nullable column '%s' in table '%s'.",
    "unique": "Checks for duplicate values in the primary key column '%s' of table '%s'.",
    "format": "Checks for formatting inconsistencies in '%s' in table '%s' using the profiled pattern.",
    "empty": "Checks for empty strings in '%s' in table '%s'.",
    "odd_characters": "Checks for unexpected characters in '%s' in table '%s'.",
    "odd_length": "Checks for unexpected lengths in '%s' in table '%s'.",
    "case_variants": "Checks for values of '%s' in table '%s' spelled with different case or spacing.",
    "anomaly": (
        "Detects anomalies in '%s' by training an ARIMA time series model on historical data from '%s'. "
        "The model learns trends, seasonality, and autocorrelation in the data to predict expected values, "
        "flagging significant deviations as anomalies."
    ),
    "reference": (
        "Checks for referential integrity: ensures all values in '%s' of table '%s' "
        "have a matching value in '%s' of table '%s'."
    ),
}


def describe(case: str, *names: Column) -> Column:
    return F.format_string(DESCRIPTIONS[case], *names)

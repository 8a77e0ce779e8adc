"""Column-in, column-out expressions; all stay inside generated JVM code."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts read as true, and texts read as missing in CSV input.
TRUE_TEXTS = ("TRUE", "1", "T", "YES")
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)
_BLANKS = " \t\n\r\f\v"


def parse_bool(c: Column) -> Column:
    """True for the accepted texts in any case, False for all else and for null."""
    text = F.upper(F.btrim(c.cast("string"), F.lit(_BLANKS)))
    return F.coalesce(text.isin(*TRUE_TEXTS), F.lit(False))


def parse_date(c: Column) -> Column:
    """Day-first or ISO text to a date; null stays null, other text raises."""
    text = F.btrim(c.cast("string"), F.lit(_BLANKS))
    parsed = F.coalesce(F.try_to_date(text, "d/M/yyyy"), F.try_to_date(text, "yyyy-MM-dd"))
    bad = F.raise_error(F.concat(F.lit("unparseable date: "), text))
    return F.when(text.isNull() | parsed.isNotNull(), parsed).otherwise(bad.cast("date"))


def missing_text_to_null(c: Column) -> Column:
    return F.when(~c.isin(*MISSING_TEXTS), c)


def nan_to_null(df: DataFrame) -> DataFrame:
    """NULL is the only missing marker downstream."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    if not floats:
        return df
    return df.withColumns({c: F.when(~F.isnan(F.col(c)), F.col(c)) for c in floats})


def is_negative(c: Column) -> Column:
    """A missing value is not negative."""
    return F.coalesce(c < 0, F.lit(False))


def temperature_band(c: Column, freezing: float = 32.0, cold: float = 52.0,
                     moderate: float = 78.0) -> Column:
    return (F.when(c.isNull() | F.isnan(c.cast("double")), "Unknown")
            .when(c <= freezing, "Freezing")
            .when(c <= cold, "Cold")
            .when(c <= moderate, "Moderate")
            .otherwise("Hot"))


def count_positive(columns: Sequence[str]) -> Column:
    total = F.lit(0)
    for c in columns:
        total = total + F.when(F.col(c) > 0, 1).otherwise(0)
    return total


def sum_present(columns: Sequence[str]) -> Column:
    total = F.lit(0.0)
    for c in columns:
        total = total + F.coalesce(F.col(c), F.lit(0.0))
    return total


def forecast_error(actual: Column, forecast: Column) -> Column:
    return actual - forecast


def abs_pct_error(actual: Column, forecast: Column) -> Column:
    """Absolute error in percent of the actual, the actual floored at 1."""
    floored = F.when(actual.isNotNull(), F.greatest(actual, F.lit(1.0)))
    return F.abs(actual - forecast) / floored * 100


def lookup(mapping: dict[str, int], c: Column) -> Column:
    """Value of a saved mapping; unseen keys give null."""
    if not mapping:
        return F.lit(None).cast("int")
    pairs = [F.lit(x) for kv in sorted(mapping.items()) for x in kv]
    return F.try_element_at(F.create_map(*pairs), c)


def yeo_johnson(x: Column, lam: Column | float, *, centred: bool = True) -> Column:
    """Yeo-Johnson power transform of x.

    `centred=False` leaves out the additive constant of the branch x >= 0. The
    variance is then free of the cancellation that the constant brings for
    large x and negative lambda; use it only where x has no negatives.
    """
    lam = lam if isinstance(lam, Column) else F.lit(float(lam))
    one = F.lit(1.0 if centred else 0.0)
    pos = (F.when(F.abs(lam) < 1e-12, F.log1p(x))
           .otherwise((F.pow(x + 1, lam) - one) / lam))
    rest = F.lit(2.0) - lam
    neg = (F.when(F.abs(rest) < 1e-12, -F.log1p(-x))
           .otherwise(-(F.pow(1 - x, rest) - 1) / rest))
    return F.when(x >= 0, pos).when(x < 0, neg)

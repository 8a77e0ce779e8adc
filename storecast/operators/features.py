"""Calendar, weather, promotion and lag features; store-type encoding."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import MARKDOWNS, Keys
from ..functions.scalar import count_positive, lookup, sum_present, temperature_band
from .ordered import previous_value, time_order, year_chunk

#: Upper limits of the freezing, cold and moderate bands, in degrees Fahrenheit.
BANDS = (32.0, 52.0, 78.0)


def add_temporal_features(df: DataFrame, *, time: str = "Date") -> DataFrame:
    """Calendar year and month with the ISO week number."""
    return df.withColumns({
        "Year": F.year(time), "Month": F.month(time), "Week": F.weekofyear(time)})


def add_temperature_band(df: DataFrame, *, column: str = "Temperature",
                         bands: Sequence[float] = BANDS) -> DataFrame:
    return df.withColumn("Temp_Category", temperature_band(F.col(column), *bands))


def add_sales_lag(df: DataFrame, *, keys: Keys = Keys(), chunk: Column | None = None,
                  unique: bool = False) -> DataFrame:
    """Sales of the series' previous row by date; 0 where there is none or it is
    missing. `chunk` sets how a series is cut over tasks (default: by year);
    `unique` says that no (entity, item, time) repeats."""
    lagged = previous_value(
        df, by=keys.series, order=[time_order(keys.time)], value=keys.value,
        out="Sales_Lag_1", chunk=year_chunk(keys.time) if chunk is None else chunk,
        unique=unique)
    return lagged.withColumn("Sales_Lag_1", F.coalesce("Sales_Lag_1", F.lit(0.0)))


def add_markdown_signals(df: DataFrame, markdowns: Sequence[str] = MARKDOWNS) -> DataFrame:
    return df.withColumns({"MD_Count": count_positive(markdowns),
                           "Total_MD_Value": sum_present(markdowns)})


def add_sales_signals(df: DataFrame, markdowns: Sequence[str] = MARKDOWNS, *,
                       keys: Keys = Keys()) -> DataFrame:
    return add_markdown_signals(add_sales_lag(df, keys=keys), markdowns)


def engineer_features(df: DataFrame, *, bands: Sequence[float] = BANDS,
                      markdowns: Sequence[str] = MARKDOWNS, keys: Keys = Keys()) -> DataFrame:
    return (df.transform(add_temporal_features, time=keys.time)
            .transform(add_temperature_band, bands=bands)
            .transform(add_sales_signals, markdowns, keys=keys))


def type_encoding(df: DataFrame, *, column: str = "Type") -> dict[str, int]:
    """Label -> rank in alphabetical order. An action that brings the distinct
    labels of a category column to the driver."""
    labels = df.select(column).where(F.col(column).isNotNull()).distinct()
    return {label: i for i, label in enumerate(sorted(r[0] for r in labels.collect()))}


def encode_type(df: DataFrame, mapping: dict[str, int] | None = None, *,
                column: str = "Type") -> tuple[DataFrame, dict[str, int]]:
    """Adds Type_Encoded from `mapping`, made from the data where not given.
    Labels the mapping lacks give null."""
    mapping = type_encoding(df, column=column) if mapping is None else mapping
    return df.withColumn("Type_Encoded", lookup(mapping, F.col(column))), mapping

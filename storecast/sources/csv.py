"""Raw CSV input: header check, missing tokens, booleans and day-first dates."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import missing_text_to_null, nan_to_null, parse_bool, parse_date
from ..schemas import BY_NAME

# Names of the raw files.
FILES = {"sales": "sales data-set.csv", "stores": "stores data-set.csv",
         "features": "Features data set.csv"}


def typed(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """Text columns to the types of `schema`. Columns the input lacks stay
    absent, so that the schema check can name them; extra columns pass through."""
    wanted = {f.name: f.dataType for f in schema}
    out = []
    for name in raw.columns:
        c = F.col(f"`{name}`")
        kind = wanted.get(name)
        if isinstance(kind, T.BooleanType):
            c = parse_bool(c)
        else:
            c = missing_text_to_null(c)
            if isinstance(kind, T.DateType):
                c = parse_date(c)
            elif kind is not None and not isinstance(kind, T.StringType):
                c = F.trim(c).cast(kind)
        out.append(c.alias(name))
    return nan_to_null(raw.select(*out))


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One file or a folder of part files, each with the same header line; quotes
    inside quoted fields are doubled. A line with too many or too few fields, or
    a part file with another header, is an error."""
    raw = (spark.read.option("header", True).option("inferSchema", False)
           .option("enforceSchema", False).option("escape", '"')
           .option("mode", "FAILFAST").csv(path))
    return typed(raw, schema)


def load_raw_tables(
    spark: SparkSession, data_dir: str, files: Mapping[str, str] = FILES,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The sales, stores and features tables of a folder of CSV files. Each may
    be one file or a folder of part files."""
    base = data_dir.rstrip("/")
    return tuple(read_csv(spark, f"{base}/{files[t]}", BY_NAME[t])
                 for t in ("sales", "stores", "features"))


def write_raw_csv(df: DataFrame, path: str) -> None:
    """Write a table in the raw text layout: day-first dates, upper-case
    booleans, NA for missing."""
    out = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "dd/MM/yyyy")
        elif isinstance(f.dataType, T.BooleanType):
            c = F.upper(c.cast("string"))
        else:
            c = c.cast("string")
        out.append(F.coalesce(c, F.lit("NA")).alias(f.name))
    df.select(*out).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)

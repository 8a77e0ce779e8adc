"""Fixed schemas of the three input tables."""

from pyspark.sql import types as T

from .config import MARKDOWNS

SALES = T.StructType([
    T.StructField("Store", T.IntegerType()),
    T.StructField("Dept", T.IntegerType()),
    T.StructField("Date", T.DateType()),
    T.StructField("Weekly_Sales", T.DoubleType()),
    T.StructField("IsHoliday", T.BooleanType()),
])

STORES = T.StructType([
    T.StructField("Store", T.IntegerType()),
    T.StructField("Type", T.StringType()),
    T.StructField("Size", T.IntegerType()),
])

FEATURES = T.StructType([
    T.StructField("Store", T.IntegerType()),
    T.StructField("Date", T.DateType()),
    T.StructField("Temperature", T.DoubleType()),
    T.StructField("Fuel_Price", T.DoubleType()),
    *[T.StructField(c, T.DoubleType()) for c in MARKDOWNS],
    T.StructField("CPI", T.DoubleType()),
    T.StructField("Unemployment", T.DoubleType()),
    T.StructField("IsHoliday", T.BooleanType()),
])

BY_NAME = {"sales": SALES, "stores": STORES, "features": FEATURES}

"""The engineered master table as one plan."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..config import Keys
from ..operators.anomaly import lag_and_flags
from ..operators.features import (add_markdown_signals, add_sales_lag, add_temperature_band,
                                  add_temporal_features)
from ..operators.master import (clean_master, check_negative_share, drop_negative_sales,
                                ffill_features, merge_datasets)
from .settings import Config


def engineered_master(sales: DataFrame, stores: DataFrame, features: DataFrame,
                      config: Config = Config(), *, keys: Keys = Keys(), gate: bool = True,
                      anomalies: bool = True, unique: bool = False) -> DataFrame:
    """Merge, clean, engineer and flag.

    Lag and z-score depend on the sales rows alone. They are computed before the
    wide joins: the ordered shuffle then moves five columns instead of twenty,
    and no join is repeated for the statistics. With unique dimension keys, which
    the quality checks demand, a left join changes neither. `unique` says that
    the sales key has been checked.
    """
    if gate:
        check_negative_share(sales, config.limits.max_negative_share, value=keys.value)
    kept = drop_negative_sales(sales, value=keys.value)
    rows = (lag_and_flags(kept, threshold=config.zscore, keys=keys,
                          unique=unique)
            if anomalies else add_sales_lag(kept, keys=keys, unique=unique))
    chronological = config.fill == "chronological"
    if chronological:
        features = ffill_features(features, keys=keys)
    markdowns = config.markdowns
    master = clean_master(merge_datasets(rows, stores, features, keys=keys),
                          markdowns=markdowns, max_negative_share=None,
                          fill=None if chronological else "input", keys=keys,
                          unique=unique)
    return (master.transform(add_temporal_features, time=keys.time)
            .transform(add_temperature_band, bands=config.bands)
            .transform(add_markdown_signals, markdowns))

"""The query catalogue: every operator over the driver tables.

Each entry takes (spark, sf_dir) and reads the whole tables through the bridge.
Presentation only: derived doubles are rounded, dates become text and arrays
become comma-joined text, so that two engines print the same values.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import EXTERNAL_FACTORS, FORECAST_FEATURES, MARKDOWNS, PROFILE_FEATURES
from ..functions.scalar import parse_bool, parse_date
from ..operators import anomaly, boosting, closed, explore, features, forecast, late, master, metrics, quality, rules
from ..operators import seasonal, segment
from ..schemas import BY_NAME
from ..session import materialize, scratch_path
from ..sources import sinks
from ..sources.bundle import champion, load_bundle, save_bundle
from ..sources.csv import read_csv, write_raw_csv
from . import bridge, jobs
from .features_plan import engineered_master
from .settings import Config

Query = Callable[[SparkSession, str], DataFrame]

SPLIT = "2000-01-01"
BRIDGE_LIMITS = quality.Limits(min_stores=10, min_rows=5000)
SUPPORT, CONFIDENCE, LIFT = 0.011, 0.1, 1.0
CLOSED_SUPPORT = SUPPORT
PROFILE = list(PROFILE_FEATURES)
SEGMENTS = segment.SegmentParams()
FIXED_LAMBDAS = {"Weekly_Sales": 0.5, "Size": 0.0, "Total_MD_Value": 0.25, "Unemployment": -1.0}
LAMBDA_GRID = [-3 + 0.25 * i for i in range(25)]
# Few rounds: the entries check the operators, not their tuning.
SMALL_FORECAST = forecast.ForecastParams(n_estimators=10, learning_rate=0.2, max_depth=4,
                                         early_stopping_rounds=0)


def shown(df: DataFrame, **digits: int) -> DataFrame:
    """Round the named columns; dates and arrays as text."""
    out = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if f.name in digits:
            c = F.round(c, digits[f.name])
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c, ",")
        out.append(c.alias(f.name))
    return df.select(*out)


def off_ties(df: DataFrame, *columns: str) -> DataFrame:
    """Shift means of four-decimal amounts by a hair before they are rounded to
    four digits: many are exact halves of the last digit, where the last bit of
    the sum, which depends on the order of addition, would decide."""
    return df.withColumns({c: F.col(c) + F.lit(1.3e-6) for c in columns})


# ---- shared inputs -------------------------------------------------------

def _sales(s, d):
    return bridge.sales(s, d)


def _kept(s, d, entity: str = "nation"):
    return master.drop_negative_sales(bridge.sales(s, d, entity))


def _tables(s, d):
    return bridge.sales(s, d), bridge.stores(s, d), bridge.features(s, d)


def _master(s, d, fill: str = "chronological"):
    return master.build_master(*_tables(s, d), fill=fill, max_negative_share=None, unique=True)


def _engineered(s, d, anomalies: bool = True):
    # The bridge groups by the sales key, so no key repeats.
    return engineered_master(*_tables(s, d), gate=False, anomalies=anomalies, unique=True)


def _flagged(s, d, entity: str = "nation"):
    return anomaly.flag_anomalies(_kept(s, d, entity))


def _lagged(s, d, entity: str = "nation"):
    return features.add_sales_lag(_kept(s, d, entity), unique=True)


def _profiles(s, d):
    """Store profiles. The lag is not among their inputs and is left out."""
    m = features.add_markdown_signals(_master(s, d))
    return segment.store_profiles(m)


def _ruled(profiles: DataFrame) -> DataFrame:
    """A rule-based segment, which SQL can reproduce."""
    return profiles.withColumn("Cluster", F.floor(F.col("Size") / 50000).cast("int"))


def _rule_segments(s, d):
    return _ruled(bridge.stores(s, d)).select("Store", "Cluster")


# ---- sources -------------------------------------------------------------

def _round_trip(name: str, source: Query) -> Query:
    def run(s, d):
        path = scratch_path(s, f"raw-{name}")
        write_raw_csv(source(s, d), path)
        return shown(read_csv(s, path, BY_NAME[name]), Temperature=6, Fuel_Price=6, CPI=6)
    return run


def q_parse_bool(s, d):
    token = F.expr("CASE o_orderkey % 10 WHEN 0 THEN 'TRUE' WHEN 1 THEN ' yes ' WHEN 2 THEN '1' "
                   "WHEN 3 THEN 't' WHEN 4 THEN '0' WHEN 5 THEN '' WHEN 6 THEN NULL "
                   "WHEN 7 THEN 'False' WHEN 8 THEN 'no' ELSE o_orderpriority END")
    orders = bridge.table(s, d, "orders").select(token.alias("token"))
    return (orders.withColumn("parsed", parse_bool(F.col("token")))
            .groupBy("token", "parsed").agg(F.count(F.lit(1)).alias("n")))


def q_parse_dates(s, d):
    day = F.col("o_orderdate").cast("date")
    text = (F.when(F.col("o_orderkey") % 3 == 0, F.date_format(day, "d/M/yyyy"))
            .when(F.col("o_orderkey") % 3 == 1, F.date_format(day, "dd/MM/yyyy"))
            .otherwise(F.date_format(day, "yyyy-MM-dd")))
    orders = bridge.table(s, d, "orders").select(parse_date(text).alias("order_date"))
    return shown(orders.groupBy("order_date").agg(F.count(F.lit(1)).alias("n")))


# ---- quality -------------------------------------------------------------

def q_dq_schema(s, d):
    q = BRIDGE_LIMITS
    sales, stores, feats = _tables(s, d)
    return quality.check_schema({
        "sales": (sales, q.required["sales"]), "stores": (stores, q.required["stores"]),
        "features": (feats, q.required["features"])}).select(
            "table_name", "check", "passed", "observed", "message")


def q_dq_row_counts(s, d):
    parts = quality.check_row_count(bridge.stores(s, d), "stores", BRIDGE_LIMITS.min_stores)
    return parts.unionByName(quality.check_row_count(
        _sales(s, d), "sales", BRIDGE_LIMITS.min_rows)).select(
            "table_name", "check", "passed", "observed", "limit")


def q_dq_duplicates(s, d):
    return quality.duplicate_counts(bridge.sales_lines(s, d), ["Store", "Dept", "Date"])


def q_dq_orphans(s, d):
    """Suppliers as stores against the nations' store table: most are orphans."""
    return quality.check_orphans(bridge.sales(s, d, "supplier"), bridge.stores(s, d), "sales",
                                 "Store", "stores").select("check", "passed", "observed")


def q_dq_negative_share(s, d):
    return shown(master.negative_share(_sales(s, d)), negative_share=8)


def q_dq_null_rates(s, d):
    m = master.merge_datasets(*_tables(s, d))
    return shown(quality.null_rates(m, [*BRIDGE_LIMITS.required["master"], "CPI",
                                        "Unemployment"]), null_share=8)


def q_validate(s, d):
    return quality.validate_raw_tables(*_tables(s, d), BRIDGE_LIMITS).select(
        "table_name", "check", "passed", "severity")


def q_freshness(s, d):
    sales, _, feats = _tables(s, d)
    orders = bridge.table(s, d, "orders").select(F.col("o_orderdate").cast("date").alias("Date"))
    return shown(quality.freshness({"sales": sales, "features": feats, "orders": orders}))


def q_dedupe(s, d):
    return shown(quality.dedupe(bridge.sales_lines(s, d)))


# ---- cleaning and joins --------------------------------------------------

_MACRO = ("Store", "Dept", "Date", "CPI", "Unemployment")


def q_impute(s, d):
    return shown(master.impute_markdowns(bridge.features(s, d)).select(
        "Store", "Date", *MARKDOWNS), **dict.fromkeys(MARKDOWNS, 4))


def q_ffill_input(s, d):
    return shown(_master(s, d, "input").select(*_MACRO), CPI=6, Unemployment=6)


def q_ffill_chrono(s, d):
    return shown(_master(s, d).select(*_MACRO), CPI=6, Unemployment=6)


def q_build_master(s, d):
    return shown(_master(s, d).select(
        "Store", "Dept", "Date", "Weekly_Sales", "IsHoliday", "Type", "Size", "Temperature",
        "Fuel_Price", *MARKDOWNS, "CPI", "Unemployment"),
        Weekly_Sales=4, Temperature=6, Fuel_Price=6, CPI=6, Unemployment=6,
        **dict.fromkeys(MARKDOWNS, 4))


def q_split(part: int) -> Query:
    return lambda s, d: shown(master.split_by_date(_sales(s, d), SPLIT)[part], Weekly_Sales=4)


# ---- features ------------------------------------------------------------

def q_temp_bands(s, d):
    return shown(features.add_temperature_band(bridge.features(s, d)).select(
        "Store", "Date", "Temperature", "Temp_Category"), Temperature=6)


def q_markdown_signals(s, d):
    return shown(features.add_markdown_signals(bridge.features(s, d)).select(
        "Store", "Date", "MD_Count", "Total_MD_Value"), Total_MD_Value=4)


def q_engineered(s, d):
    return shown(_engineered(s, d).select(
        "Store", "Dept", "Date", "Weekly_Sales", "Type", "Size", "Year", "Month", "Week",
        "Temp_Category", "Sales_Lag_1", "MD_Count", "Total_MD_Value", "CPI", "Sales_ZScore",
        "Is_Anomaly"), Weekly_Sales=4, Sales_Lag_1=4, Total_MD_Value=4, CPI=6, Sales_ZScore=4)


def q_encode_type(s, d):
    return features.encode_type(bridge.stores(s, d))[0]


def q_model_frame(s, d):
    df = segment.attach_clusters(_engineered(s, d, anomalies=False), _rule_segments(s, d))
    frame, _ = forecast.model_frame(df, features.type_encoding(bridge.stores(s, d)))
    cols = ["Date", *FORECAST_FEATURES]
    return shown(frame.select(*cols), CPI=6, Unemployment=6, Temperature=6, Fuel_Price=6,
                 Sales_Lag_1=4, **dict.fromkeys(MARKDOWNS, 4))


def q_forecast_errors(s, d):
    return shown(metrics.forecast_errors(_lagged(s, d), forecast="Sales_Lag_1").select(
        "Store", "Dept", "Date", "forecast_error", "abs_pct_error"),
        forecast_error=4, abs_pct_error=4)


def q_mean_error(s, d):
    scored = metrics.forecast_errors(_lagged(s, d), forecast="Sales_Lag_1")
    return shown(metrics.mean_abs_pct_error(scored), mean_abs_pct_error=6)


# ---- anomalies -----------------------------------------------------------

def _flag_columns(df):
    return shown(df.select("Store", "Dept", "Date", "Weekly_Sales", "Sales_ZScore", "Is_Anomaly"),
                 Weekly_Sales=4, Sales_ZScore=4)


def q_late_weeks(s, d):
    """The last weeks and some scattered rows come late, over wrong values for some of them."""
    sales = materialize(_kept(s, d), "late-sales")
    coming = F.expr("Date >= DATE'1998-06-01' OR pmod(datediff(Date, DATE'1992-01-01') div 7 * 31 + Store * 7 + Dept, 19) = 0")
    wrong = F.when(coming & (F.col("Dept") % 2 == 0), 1.0).otherwise(F.col("Weekly_Sales"))
    before = sales.where(~coming | (F.col("Dept") % 2 == 0)).withColumn("Weekly_Sales", wrong)
    rows, states = (materialize(t, "late-state") for t in late.start(before))
    changed, replaced, now = (materialize(t, "late-new") for t in late.absorb(rows, states, sales.where(coming)))
    out = late.flagged(late.replace_chunks(rows, changed, replaced), now)
    return shown(out.select("Store", "Dept", "Date", "Weekly_Sales", "Sales_Lag_1", "Sales_ZScore", "Is_Anomaly"),
                 Weekly_Sales=4, Sales_Lag_1=4, Sales_ZScore=4)


def q_drilldown(s, d):
    return shown(anomaly.anomaly_drilldown(_flagged(s, d), entity=1, item=1),
                 Weekly_Sales=4, Sales_ZScore=4)


def q_triage(s, d):
    return shown(anomaly.anomaly_triage(_flagged(s, d)), anomaly_rate=8, holiday_share=8)


# ---- exploration ---------------------------------------------------------

def q_store_ranking(entity: str) -> Query:
    return lambda s, d: shown(off_ties(explore.store_ranking(_kept(s, d, entity)), "avg_sales"),
                              avg_sales=4)


def q_seasonality_wide(s, d):
    """The wide table of all years that occur, listed cell by cell."""
    df = explore.seasonality(features.add_temporal_features(_kept(s, d)), wide=True)
    cells = df.unpivot("Week", [c for c in df.columns if c != "Week"], "Year", "avg_sales")
    return shown(off_ties(cells.withColumn("Year", F.col("Year").cast("int")), "avg_sales"), avg_sales=4)


def q_holiday_lift(s, d):
    df = features.add_temporal_features(_kept(s, d))
    lift = off_ties(explore.holiday_lift(df), "holiday_avg", "regular_avg")
    return shown(lift, holiday_avg=4, regular_avg=4, lift=6)


def q_run_summary(s, d):
    return explore.run_summary(_flagged(s, d))


def q_holiday_effect(s, d):
    df = features.add_temporal_features(_kept(s, d))
    return shown(off_ties(explore.holiday_effect(df), "avg_sales"), avg_sales=4, sd_sales=4)


# ---- segmentation --------------------------------------------------------

def q_lambda(s, d):
    long = segment.long_form(_profiles(s, d), PROFILE)
    return shown(segment.best_lambda(segment.yeo_johnson_loglik(
        long, dict.fromkeys(PROFILE, LAMBDA_GRID))), loglik=4)


def q_yeo_johnson(s, d):
    return shown(segment.apply_yeo_johnson(_profiles(s, d), FIXED_LAMBDAS),
                 **dict.fromkeys(PROFILE, 6))


def q_standardize(s, d):
    p = materialize(_profiles(s, d), "profiles")
    return shown(segment.apply_scaler(p, segment.fit_scaler(p, PROFILE)),
                 **dict.fromkeys(PROFILE, 6))


def q_pca(s, d):
    p = materialize(_profiles(s, d), "profiles")
    return segment.fit_projection(p).project(p).select("Store", "pc1", "pc2")


def q_elbow(s, d):
    p = materialize(_profiles(s, d), "profiles")
    points = segment.fit_projection(p).project(p)
    curve = segment.elbow_curve(points, ["pc1", "pc2"], max_k=SEGMENTS.elbow_max_k,
                                restarts=SEGMENTS.restarts)
    return s.createDataFrame([(i + 1, v) for i, v in enumerate(curve)], "k int, inertia double")


def q_segment_stores(s, d):
    m = features.add_markdown_signals(_master(s, d))
    result = segment.fit_segmentation(m, SEGMENTS, elbow=False, score=False)
    return result.profiles.select("Store", *PROFILE, "Cluster")


def q_wcss(s, d):
    return shown(segment.wcss(_ruled(_profiles(s, d)), ["Weekly_Sales", "Total_MD_Value"]),
                 inertia=1)


def q_silhouette(s, d):
    p = _ruled(_profiles(s, d)).select(
        "Cluster", (F.col("Weekly_Sales") / 1000).alias("a"), (F.col("Size") / 1000).alias("b"))
    return shown(segment.silhouette(p, ["a", "b"], metric="euclidean"), silhouette=6)


def q_segment_summary(s, d):
    return segment.cluster_summary(_ruled(_profiles(s, d)))


def q_attach(s, d):
    return shown(segment.attach_clusters(_kept(s, d), _rule_segments(s, d)), Weekly_Sales=4)


# ---- forecasting ---------------------------------------------------------

def _train_input(s, d):
    return materialize(segment.attach_clusters(_engineered(s, d, anomalies=False), _rule_segments(s, d)), "forecast-input")


def _train(s, d, config: forecast.ForecastParams = SMALL_FORECAST):
    df = _train_input(s, d)
    return df, forecast.train_forecaster(df, config, split_date=SPLIT)


def _saved(s, d):
    df, (result, _) = _train(s, d)
    path = scratch_path(s, "forecaster")
    result.model.save(path)
    return df, result, path


def q_train_forecast(s, d):
    patient = dataclasses.replace(SMALL_FORECAST, early_stopping_rounds=4)
    return _train(s, d, patient)[1][1].select("Store", "Dept", "Date", "Weekly_Sales",
                                     "predicted_weekly_sales")


def q_score_forecast(s, d):
    df, result, path = _saved(s, d)
    model = PipelineModel.load(path)
    return forecast.score_forecasts(model, df, result.type_encoding).select(
        "Store", "Dept", "Date", "Weekly_Sales", "point_forecast")


def q_importance(s, d):
    _, result, path = _saved(s, d)
    return forecast.feature_importance(s, path, result.feature_columns, result.imputed)


def q_boosting_state(s, d):
    """Ten rounds with validation on the end of the training period: the predictions carried
    from round to round against those of the saved trees."""
    df, path = _train_input(s, d), scratch_path(s, "boosting")
    forecast.train_forecaster(df, dataclasses.replace(SMALL_FORECAST, early_stopping_rounds=9), split_date=SPLIT, state=path)
    return boosting.carried_difference(boosting.BoostState(s, path), SMALL_FORECAST.n_estimators, forecast._MODEL_VECTOR)


def _two_models(s, d):
    """Holdout rows with two forecasts: the previous week's sales, and the
    series' mean over the training period."""
    train, test = master.split_by_date(_lagged(s, d), SPLIT)
    mean = train.groupBy("Store", "Dept").agg(F.avg("Weekly_Sales").alias("series_mean"))
    return test.join(mean, ["Store", "Dept"], "left")


def q_metrics(s, d):
    return shown(metrics.regression_metrics(_lagged(s, d), forecast="Sales_Lag_1"),
                 r2=6, mae=4, rmse=4, mape=4)


def q_metrics_by_segment(s, d):
    df = segment.attach_clusters(_lagged(s, d), _rule_segments(s, d))
    return shown(metrics.regression_metrics(df, forecast="Sales_Lag_1", by=["Cluster"]),
                 r2=6, mae=4, rmse=4, mape=4)


def q_compare_runs(s, d):
    """Three training runs; score runs, which have no metrics, before and between them."""
    measured = metrics.regression_metrics(metrics.stacked(_two_models(s, d), ["Sales_Lag_1", "series_mean"]),
                                          forecast="forecast", by=["model"])
    runs = s.createDataFrame([
        ("run-1", "2001-01-01", None), ("run-2", "2001-01-15", "Sales_Lag_1"),
        ("run-3", "2001-02-01", "series_mean"), ("run-4", "2001-02-15", None),
        ("run-5", "2001-03-01", "Sales_Lag_1")], "run_id string, created_at string, model string")
    runs = runs.join(measured, "model", "left").select("run_id", "created_at", "mae", "rmse")
    return shown(metrics.compare_runs(runs, metric="rmse"), mae=4, rmse=4, previous=4,
                 champion=4, change=4)


def q_macro_drift(s, d):
    rows = materialize(bridge.features(s, d).select("Date", "CPI", "Unemployment"), "macro")
    before, after = master.split_by_date(rows, SPLIT)
    return shown(metrics.macro_drift(before, after), ref_mean=6, cur_mean=6, ref_sd=6,
                 cur_sd=6, psi=6)


def q_quantile_drift(s, d):
    """Sketches per year, kept as a table; the years before and from 2000 are compared."""
    yearly = materialize(metrics.value_sketches(
        bridge.features(s, d).withColumn("Year", F.year("Date")), ["CPI", "Unemployment"], by=["Year"], k=65535), "sketches")
    return shown(metrics.quantile_drift(yearly, F.col("Year") < 2000, F.col("Year") >= 2000, k=65535),
                 ref_mean=6, cur_mean=6, psi=6)


# ---- seasonal ------------------------------------------------------------

_BY = ["Store"]


def _store_weeks(s, d, entity: str = "nation"):
    totals = seasonal.weekly_totals(bridge.sales(s, d, entity), by=_BY)
    return seasonal.densify(totals, by=_BY)


def q_orders(entity: str) -> Query:
    return lambda s, d: seasonal.best_orders(
        seasonal.search_orders(_store_weeks(s, d, entity), by=_BY), by=_BY)


def q_fitted(s, d):
    return shown(seasonal.fit_series(_store_weeks(s, d), by=_BY))


def q_unit_roots(s, d):
    return shown(seasonal.unit_root_statistics(_store_weeks(s, d), by=_BY), strength=6, kpss=6, kpss_diff=6)


def q_naive(entity: str) -> Query:
    return lambda s, d: shown(seasonal.seasonal_naive(_store_weeks(s, d, entity), by=_BY),
                              y=4, seasonal_naive=4, seasonal_diff=4)


def q_ar1(s, d):
    return shown(seasonal.ar1_fit(_store_weeks(s, d), by=_BY), slope=6, intercept=3, r2=6)


# ---- rules ---------------------------------------------------------------

def _itemsets(s, d, max_len):
    sales = materialize(_sales(s, d).select("Store", "Date", "Dept"), "basket-rows")
    return rules.frequent_itemsets(sales, min_support=SUPPORT, max_len=max_len)


def _order_itemsets(s, d, max_len=None):
    return rules.frequent_itemsets(bridge.order_items(s, d), min_support=SUPPORT,
                                   max_len=max_len, basket_keys=["OrderKey"])


def _closed(s, d):
    """Closed itemsets of the store-weeks, of any size."""
    return materialize(closed.closed_itemsets(_sales(s, d).select("Store", "Date", "Dept"), min_support=CLOSED_SUPPORT), "closed-itemsets")


def q_closed_rules(s, d):
    return shown(closed.closed_rules(_closed(s, d), min_confidence=CONFIDENCE, min_lift=LIFT),
                 support=8, confidence=8, lift=8)


def q_closed_supports(s, d):
    """The counts of the frequent itemsets of up to three items, from the closed ones alone."""
    asked = _itemsets(s, d, 3).select("items", "size")
    return shown(closed.supports_of(asked, _closed(s, d)), support=8)


def q_itemsets(size: int) -> Query:
    return lambda s, d: shown(_itemsets(s, d, size).where(F.col("size") == size), support=8)


def _rules(itemsets: DataFrame) -> DataFrame:
    return shown(rules.rules_from_itemsets(itemsets, min_confidence=CONFIDENCE, min_lift=LIFT),
                 support=8, confidence=8, lift=8)


# ---- outputs and jobs: written, read back, compared -----------------------

def q_sink_master(s, d):
    path = sinks.write_master(features.add_temporal_features(_kept(s, d)),
                              scratch_path(s, "master"))
    return s.read.parquet(path).groupBy("Year").agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("Weekly_Sales"), 0).alias("total"))


def _bucketed(s, d):
    path = scratch_path(s, "bucketed")
    return sinks.write_bucketed_master(_kept(s, d), path.rsplit("/", 1)[1].replace("-", "_"), path, buckets=16)


def q_bucketed_flags(s, d):
    return _flag_columns(anomaly.lag_and_flags(_bucketed(s, d), chunk=F.col(sinks.CHUNK_COLUMN), unique=True))


def q_bucketed_lag(s, d):
    lagged = features.add_sales_lag(_bucketed(s, d), chunk=F.col(sinks.CHUNK_COLUMN), unique=True)
    return shown(lagged.drop(sinks.CHUNK_COLUMN), Weekly_Sales=4, Sales_Lag_1=4)


def q_sink_forecasts(s, d):
    df = _lagged(s, d).withColumn("predicted_weekly_sales", F.col("Sales_Lag_1"))
    path = sinks.write_forecasts(df, scratch_path(s, "forecasts"))
    return shown(s.read.parquet(path), Weekly_Sales=4, predicted_weekly_sales=4)


def q_sink_scores(s, d):
    df = _lagged(s, d).withColumn("point_forecast", F.col("Sales_Lag_1"))
    path = sinks.write_scores(df, scratch_path(s, "scores"))
    return shown(s.read.parquet(path), Weekly_Sales=4, point_forecast=4)


def q_sink_export(s, d):
    df = segment.attach_clusters(_lagged(s, d), _rule_segments(s, d))
    scored = metrics.forecast_errors(df.withColumn("point_forecast", F.col("Sales_Lag_1")))
    path = scratch_path(s, "export")
    sinks.export_forecasts(scored, path, model="lag")
    back = s.read.option("header", True).csv(path)
    return shown(back.select(
        *[F.col(c).cast("int") for c in ("Store", "Dept", "Cluster")], "Date", "model",
        *[F.col(c).cast("double") for c in ("Weekly_Sales", "point_forecast", "forecast_error")],
        F.col("scored_at").isNotNull().alias("stamped")),
        Weekly_Sales=4, point_forecast=4, forecast_error=4)


def q_sink_rules(s, d):
    found = rules.rules_from_itemsets(_itemsets(s, d, 2), min_confidence=CONFIDENCE, min_lift=LIFT)
    path = sinks.write_rules(rules.sort_rules(found), scratch_path(s, "rules"))
    return shown(s.read.parquet(path), support=8, confidence=8, lift=8)


def q_run_manifest(s, d):
    """A training and a scoring row in a fresh runs table, metrics from the data."""
    m = metrics.regression_metrics(_lagged(s, d), forecast="Sales_Lag_1").first().asDict()
    path = scratch_path(s, "runs")
    for run_id, stage in (("run-1", "train"), ("run-2", "score")):
        runs = sinks.append_run(s, path, run_id=run_id, stage=stage, paths={},
                                metrics=m if stage == "train" else None)
    return shown(runs.select("run_id", "stage", "mae", "rmse",
                             F.col("created_at").isNotNull().alias("stamped")), mae=4, rmse=4)


def q_ingest(s, d):
    df = jobs.ingest(_tables(s, d), scratch_path(s, "ingested"))
    return shown(df.select("Store", "Dept", "Date", "Weekly_Sales", "Type", "CPI"),
                 Weekly_Sales=4, CPI=6)


def q_train_and_score(s, d):
    """The whole train and score jobs on the driver tables, with small models."""
    config = Config(split_date=SPLIT, limits=BRIDGE_LIMITS,
                    segments=segment.SegmentParams(restarts=1, elbow_max_k=3),
                    forecast=SMALL_FORECAST,
                    rules=rules.RuleParams(min_confidence=CONFIDENCE, min_lift=LIFT, max_len=2))
    tables = tuple(materialize(t, "raw") for t in _tables(s, d))
    out = scratch_path(s, "job")
    jobs.train(tables, out, config)
    return jobs.score(tables, out, config)


def q_run_all(s, d):
    """Raw text files to scores in one job; what it wrote, counted."""
    raw, out = scratch_path(s, "raw-files"), scratch_path(s, "job")
    config = Config(split_date=SPLIT, limits=BRIDGE_LIMITS,
                    segments=segment.SegmentParams(restarts=1, elbow_max_k=3), forecast=SMALL_FORECAST,
                    rules=rules.RuleParams(min_confidence=CONFIDENCE, min_lift=LIFT, max_len=2))
    for table, name in zip(_tables(s, d), ("sales", "stores", "features")):
        write_raw_csv(table, f"{raw}/{config.files[name]}")
    trained, scored = jobs.run_all(s, raw, out, config)
    parts = [(trained.master, "master"), (trained.forecasts, "forecasts"), (scored, "scores"),
             (trained.profiles, "profiles")]
    counts = [df.agg(F.lit(name).alias("output"), F.count(F.lit(1)).alias("n_rows")) for df, name in parts]
    return counts[0].unionByName(counts[1]).unionByName(counts[2]).unionByName(counts[3])


def q_score_consistency(s, d):
    """A saved and reloaded model gives the holdout the forecasts that training gave it."""
    df, (result, holdout) = _train(s, d)
    path = scratch_path(s, "forecaster")
    result.model.save(path)
    again = forecast.score_forecasts(PipelineModel.load(path), master.split_by_date(df, SPLIT)[1], result.type_encoding)
    return _mismatches(holdout, again)


def q_guarded_promotion(s, d):
    """A champion, a worse challenger, and what is scored then: the champion's holdout again."""
    df, base, kept = _train_input(s, d), scratch_path(s, "job"), None
    for n, run in ((4, "run-1"), (1, "run-2")):
        result, holdout = forecast.train_forecaster(
            df, dataclasses.replace(SMALL_FORECAST, n_estimators=n), split_date=SPLIT)
        path = save_bundle(s, f"{base}/artifacts/models/{run}", result, segment.SegmentModel([], [], {}, {}, [], [], []),
                           df.select("Store", "Cluster").distinct())
        runs = sinks.append_run(s, f"{base}/artifacts/runs", run_id=run, stage="train", paths={"model_path": path}, metrics=result.metrics)
        promoted = jobs.promote_if_better(s, base, run, path, runs)
        kept = holdout if promoted else kept
    bundle = load_bundle(s, champion(s, jobs.champion_log(base)))
    again = forecast.score_forecasts(bundle.model, master.split_by_date(df, SPLIT)[1], bundle.type_encoding)
    return _mismatches(kept, again).select("n", "n_mismatch", F.lit(promoted).alias("challenger_promoted"))


def _mismatches(holdout: DataFrame, again: DataFrame) -> DataFrame:
    key = ["Store", "Dept", "Date"]
    both = holdout.select(*key, "predicted_weekly_sales").join(again.select(*key, "point_forecast"), key, "full")
    near = F.abs(F.col("point_forecast") - F.col("predicted_weekly_sales")) <= 1e-6
    return both.agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.coalesce(near, F.lit(False))).alias("n_mismatch"))


def q_master_checks(s, d):
    """The checks of the engineered master, from what its write observed."""
    df, seen = quality.observe_nulls(_engineered(s, d))
    written = materialize(df, "observed-master")
    return shown(quality.validate_observed(written, seen).select("table_name", "check", "passed", "observed", "limit"), observed=8)


def q_report(s, d):
    """An evaluation report, written as JSON and read back."""
    m = metrics.regression_metrics(_lagged(s, d), forecast="Sales_Lag_1").first().asDict()
    path = sinks.write_report(s, {"forecast_metrics": m, "checks": ["ok"]}, scratch_path(s, "report"))
    back = s.read.schema("forecast_metrics struct<n:bigint,r2:double,mae:double,rmse:double,mape:double>, "
                         "checks array<string>").json(path)
    return shown(back.select("forecast_metrics.*", F.size("checks").alias("n_checks")), r2=6, mae=4, rmse=4, mape=4)


def q_saved_mapping(s, d):
    """Codes learned from the types A and B; the rest is unseen."""
    known = features.type_encoding(bridge.stores(s, d).where("Type <> 'C'"))
    rows = master.join_stores(_sales(s, d), bridge.stores(s, d))
    return shown(features.encode_type(rows, known)[0].select("Store", "Dept", "Date", "Type", "Type_Encoded"))


def q_raise_if_failed(s, d):
    """Whether each set of limits stops a run."""
    out = []
    for name, limits in (("bridge", BRIDGE_LIMITS), ("no_floor", quality.Limits(min_rows=0, min_stores=0)),
                         ("high_floor", quality.Limits(min_rows=10**12))):
        try:
            quality.raise_if_failed(quality.validate_raw_tables(*_tables(s, d), limits))
            out.append((name, False))
        except quality.DataQualityError:
            out.append((name, True))
    return s.createDataFrame(out, "limits string, raised boolean")


def q_rules_empty(s, d):
    """No basket holds a rule of such lift: an empty table with the rules' columns."""
    config = rules.RuleParams(min_support=1.0, min_lift=1e9)
    return shown(rules.mine_association_rules(bridge.order_items(s, d), config, basket_keys=["OrderKey"]))


def q_basket_matrix(s, d):
    """The matrix of all items that occur, listed cell by cell."""
    wide = rules.basket_matrix(_sales(s, d))
    keys = ["Store", "Date"]
    return shown(wide.unpivot(keys, [c for c in wide.columns if c not in keys], "item", "present"))


def q_top_departments(s, d):
    return shown(rules.top_departments(_sales(s, d), 15), total_sales=4)


def q_top_sales(s, d):
    kept = rules.restrict_to_top(_sales(s, d), 15)
    return kept.groupBy("Dept").agg(F.count(F.lit(1)).alias("n"))


QUERIES: dict[str, Query] = {
    "load_sales": _round_trip("sales", _sales),
    "load_stores": _round_trip("stores", bridge.stores),
    "load_features": _round_trip("features", bridge.features),
    "parse_bool": q_parse_bool,
    "parse_dates": q_parse_dates,
    "dq_schema": q_dq_schema,
    "dq_row_counts": q_dq_row_counts,
    "dq_duplicates": q_dq_duplicates,
    "dq_orphans": q_dq_orphans,
    "dq_negative_share": q_dq_negative_share,
    "dq_null_rates": q_dq_null_rates,
    "validate": q_validate,
    "freshness": q_freshness,
    "dedupe_sales": q_dedupe,
    "clean_negative_sales": lambda s, d: shown(_kept(s, d), Weekly_Sales=4),
    "impute_markdowns": q_impute,
    "ffill_macro": q_ffill_input,
    "ffill_macro_chrono": q_ffill_chrono,
    "split_train": q_split(0),
    "split_test": q_split(1),
    "join_stores": lambda s, d: shown(master.join_stores(_sales(s, d), bridge.stores(s, d)),
                                      Weekly_Sales=4),
    "build_master": q_build_master,
    "temporal_features": lambda s, d: shown(features.add_temporal_features(_sales(s, d)).select(
        "Store", "Dept", "Date", "Year", "Month", "Week")),
    "temp_bands": q_temp_bands,
    "markdown_signals": q_markdown_signals,
    "sales_lag": lambda s, d: shown(_lagged(s, d), Weekly_Sales=4, Sales_Lag_1=4),
    "engineered_master": q_engineered,
    "encode_type": q_encode_type,
    "flag_anomalies": lambda s, d: _flag_columns(_flagged(s, d)),
    "anomaly_summary": lambda s, d: shown(anomaly.anomaly_summary(_flagged(s, d)),
                                          anomaly_rate=8, holiday_share_among_anomalies=8),
    "late_weeks": q_late_weeks,
    "anomaly_drilldown": q_drilldown,
    "anomaly_triage": q_triage,
    "store_ranking": q_store_ranking("nation"),
    "seasonality": lambda s, d: shown(off_ties(explore.seasonality(
        features.add_temporal_features(_kept(s, d))), "avg_sales"), avg_sales=4),
    "seasonality_wide": q_seasonality_wide,
    "macro_histogram": lambda s, d: shown(explore.histogram(materialize(
        bridge.features(s, d).select(*EXTERNAL_FACTORS), "macro")), lower=6, upper=6),
    "holiday_lift": q_holiday_lift,
    "holiday_effect": q_holiday_effect,
    "run_summary": q_run_summary,
    "table_profile": lambda s, d: explore.table_profile(bridge.features(s, d)),
    "store_profiles": lambda s, d: shown(off_ties(_profiles(s, d), "Weekly_Sales",
                                                  "Total_MD_Value"), Weekly_Sales=4, Total_MD_Value=4,
                                         Unemployment=6),
    "segment_summary": q_segment_summary,
    "attach_segments": q_attach,
    "yeo_johnson_lambda": q_lambda,
    "yeo_johnson": q_yeo_johnson,
    "standardize": q_standardize,
    "pca_scores": q_pca,
    "elbow_curve": q_elbow,
    "wcss": q_wcss,
    "segment_stores": q_segment_stores,
    "silhouette": q_silhouette,
    "model_frame": q_model_frame,
    "train_forecast": q_train_forecast,
    "score_forecast": q_score_forecast,
    "feature_importance": q_importance,
    "boosting_state": q_boosting_state,
    "forecast_errors": q_forecast_errors,
    "mean_abs_pct_error": q_mean_error,
    "regression_metrics": q_metrics,
    "metrics_by_segment": q_metrics_by_segment,
    "compare_runs": q_compare_runs,
    "macro_drift": q_macro_drift,
    "quantile_drift": q_quantile_drift,
    "weekly_totals": lambda s, d: shown(seasonal.weekly_totals(_sales(s, d)), y=4),
    "seasonal_order_search": q_orders("nation"),
    "seasonal_order_search_suppliers": q_orders("supplier"),
    "seasonal_fitted": q_fitted,
    "seasonal_naive": q_naive("nation"),
    "seasonal_naive_suppliers": q_naive("supplier"),
    "ar1_fit": q_ar1,
    "unit_root_statistics": q_unit_roots,
    "sink_master": q_sink_master,
    "bucketed_flags": q_bucketed_flags,
    "bucketed_lag": q_bucketed_lag,
    "sink_forecasts": q_sink_forecasts,
    "sink_scores": q_sink_scores,
    "sink_export": q_sink_export,
    "sink_rules": q_sink_rules,
    "run_manifest": q_run_manifest,
    "ingest": q_ingest,
    "train_and_score": q_train_and_score,
    "run_all": q_run_all,
    "score_consistency": q_score_consistency,
    "guarded_promotion": q_guarded_promotion,
    "master_checks": q_master_checks,
    "report_round_trip": q_report,
    "saved_mapping": q_saved_mapping,
    "raise_if_failed": q_raise_if_failed,
    "table_head": lambda s, d: shown(explore.head(_sales(s, d), 5, order=["Store", "Dept", "Date"]), Weekly_Sales=4),
    "top_departments": q_top_departments,
    "top_department_sales": q_top_sales,
    "dept_baskets": lambda s, d: shown(rules.dept_baskets(_sales(s, d))),
    "basket_matrix": q_basket_matrix,
    "rules_empty": q_rules_empty,
    "frequent_items": q_itemsets(1),
    "frequent_pairs": q_itemsets(2),
    "frequent_triples": q_itemsets(3),
    "frequent_itemsets_orders": lambda s, d: shown(_order_itemsets(s, d), support=8),
    "association_rules": lambda s, d: _rules(_itemsets(s, d, 2)),
    "association_rules_k3": lambda s, d: _rules(_itemsets(s, d, 3)),
    "closed_itemsets": lambda s, d: shown(_closed(s, d), support=8),
    "closed_rules": q_closed_rules,
    "closed_supports": q_closed_supports,
    "association_rules_orders": lambda s, d: _rules(_order_itemsets(s, d)),
    "flag_anomalies_suppliers": lambda s, d: _flag_columns(_flagged(s, d, "supplier")),
    "sales_lag_suppliers": lambda s, d: shown(_lagged(s, d, "supplier"), Weekly_Sales=4,
                                              Sales_Lag_1=4),
    "store_ranking_suppliers": q_store_ranking("supplier"),
}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anomalies of the engineered master table."""
    return q_engineered(spark, sf_dir).where("Is_Anomaly")

"""Whole jobs: prepare, train and select, forecast, report, check drift, retrain."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators import calendar as cal, drift, evaluate, joins, monitor, profile, windows
from ..operators.additive import Additive, AdditiveSettings, additive_features
from ..operators.arima import Arima
from ..operators.forecast import SeriesModel, baseline_forecast, per_group
from ..operators.learner import SequenceModel
from ..session import materialize
from ..sources import tables
from ..sources.bundle import SalesBundle


def prepare_features(bundle: SalesBundle) -> DataFrame:
    """The prepared fact with the standard feature set. Windows come before what the date decides, so that rows are narrow
    while they are shuffled."""
    featured = windows.series_features(joins.sales_with_transactions(bundle))
    return windows.cycle_features(joins.beside_dates(featured, bundle))


@dataclass(frozen=True)
class AdditiveModel:
    """The additive model over a daily history as a ``SeriesModel``."""

    keys: tuple[str, ...]
    settings: AdditiveSettings = AdditiveSettings()
    name: str = "additive"

    def _model(self) -> Additive:
        return Additive(self.keys, self.settings)

    def fit(self, history: DataFrame) -> DataFrame:
        return self._model().fit(materialize(additive_features(history, list(self.keys))))

    def predict(self, fits: DataFrame, history: DataFrame, days: int, known: DataFrame | None = None) -> DataFrame:
        return self._model().predict(fits, additive_features(history, list(self.keys)), days, known)


@dataclass(frozen=True)
class SeasonalNaive:
    """Last week's values; needs no parameters."""

    keys: tuple[str, ...]
    name: str = "seasonal_naive"

    def fit(self, history: DataFrame) -> DataFrame:
        return history.select(*self.keys).distinct()

    def predict(self, fits: DataFrame, history: DataFrame, days: int) -> DataFrame:
        future = baseline_forecast(history.join(fits, list(self.keys), "left_semi"), "sales", list(self.keys), days)
        return future.select(*self.keys, "date", "step", F.col("seasonal_naive").alias("prediction"))


@dataclass(frozen=True)
class RecentMean:
    """The mean of each series' last ``width`` days."""

    keys: tuple[str, ...]
    width: int = 28
    name: str = "recent_mean"

    def fit(self, history: DataFrame) -> DataFrame:
        return history.select(*self.keys).distinct()

    def predict(self, fits: DataFrame, history: DataFrame, days: int) -> DataFrame:
        known = history.join(fits, list(self.keys), "left_semi")
        future = baseline_forecast(known, "sales", list(self.keys), days, width=self.width)
        return future.select(*self.keys, "date", "step", F.col("moving_average").alias("prediction"))


def default_models(keys: list[str]) -> list[SeriesModel]:
    return [Arima(keys), AdditiveModel(tuple(keys)), SequenceModel(keys), SeasonalNaive(tuple(keys))]


def train_and_select(history: DataFrame, models: list[SeriesModel], keys: list[str], test_days: int = 14,
                     metric: str = "rmse") -> tuple[DataFrame, DataFrame]:
    """(long metrics per model on the last days, the best model's row).

    Every model forecasts the whole test span. Errors compare the rows of series and date that all models
    forecast, but for models without any forecast, which have no errors; ``unscored`` counts the test rows a model has no
    forecast for.
    """
    history = materialize(history)
    cut = history.agg(F.date_sub(F.max("date"), test_days).alias("cut")).scalar()
    train = materialize(history.where(F.col("date") <= cut))
    test = history.where(F.col("date") > cut).select(*keys, "date", F.col("sales").alias("actual"))
    forecasts = None
    for model in models:
        predicted = model.predict(model.fit(train), train, test_days).select(
            F.lit(model.name).alias("model"), *keys, "date", "prediction")
        forecasts = predicted if forecasts is None else forecasts.unionByName(predicted)
    names = [m.name for m in models]
    wanted = test.withColumn("model", F.explode(F.array(*[F.lit(n) for n in names])))
    scored = materialize(wanted.join(forecasts, ["model", *keys, "date"], "left"))
    missing = scored.groupBy("model").agg(F.count_if(F.col("prediction").isNull()).cast("double").alias("unscored"),
                                          F.count("prediction").alias("_scored"))
    # one row per model
    forecasting = missing.where("_scored > 0").agg(F.count("*").alias("n")).scalar()
    whole = scored.groupBy(*keys, "date").agg(F.count("prediction").alias("_n")).where(F.col("_n") == forecasting).drop("_n")
    errors = evaluate.error_metrics(scored.where("prediction IS NOT NULL").join(whole, [*keys, "date"], "left_semi"), ["model"])
    wide = missing.drop("_scored").join(errors, "model", "left")
    metrics = materialize(wide.unpivot(["model"], [*evaluate.METRICS, "unscored"], "metric", "value"))
    return metrics, evaluate.best_model(metrics, [m.name for m in models], metric)


def generate_predictions(history: DataFrame, models: list[SeriesModel], best: DataFrame, keys: list[str], days: int = 30,
                         ids: list | None = None) -> DataFrame:
    """Future days of the chosen model, for all or some series."""
    row = best.first()
    if row is None:
        raise ValueError("no best model found")
    model = next(m for m in models if m.name == row["model"])
    if ids is not None:
        history = history.where(F.col(keys[0]).isin(*ids))
    history = materialize(history)
    return model.predict(model.fit(history), history, days).withColumn("model", F.lit(model.name))


def forecast_and_monitor(spark: SparkSession, folder: str, run_id: str, model: SeriesModel, history: DataFrame, keys: list[str],
                         days: int, ts: dt.datetime, actuals: DataFrame | None = None) -> DataFrame:
    """Forecast with the parameters stored under ``run_id``, append the predictions and their statistics (and
    errors, where ``actuals`` (keys, date, actual) has them) to the run's tables, and return the predictions.
    The same run written again replaces its rows. A series of the history without stored parameters, as a new one is, is
    not forecast; the run's metrics have a row ``unknown_series`` with the value 1 for it."""
    fits = tables.read_fits(spark, f"{folder}/fits", run_id)
    future = materialize(model.predict(fits, history.join(fits.select(*keys).distinct(), keys, "left_semi"), days))
    series = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    unknown = history.select(*keys).distinct().join(fits.select(*keys).distinct(), keys, "left_anti")
    rows = future.select(*keys, "date", "prediction")
    if actuals is not None:
        rows = rows.join(actuals, [*keys, "date"], "left")
    else:
        rows = rows.withColumn("actual", F.lit(None).cast("double"))
    tables.write_predictions(rows.withColumn("series", series), f"{folder}/predictions", run_id)
    stats = rows.groupBy(series.alias("series")).agg(
        F.count("prediction").cast("double").alias("predictions"), F.avg("prediction").alias("prediction_mean"),
        F.stddev_pop("prediction").alias("prediction_std"),
        F.sqrt(F.avg(F.pow(F.col("prediction") - F.col("actual"), 2))).alias("rmse"))
    names = ["predictions", "prediction_mean", "prediction_std", "rmse"]
    long = tables.to_long_metrics(stats, ["series"], names).unionByName(unknown.select(
        series.alias("series"), F.lit("unknown_series").alias("metric"), F.lit(1.0).alias("value"))).select(
        F.lit(ts).alias("ts"), F.lit("prediction_metrics").alias("metric_type"), F.lit(model.name).alias("model"),
        "series", "metric", "value", F.lit(run_id).alias("run_id"))
    tables.replace_metrics(long, f"{folder}/prediction_metrics")
    return future


Objective = Callable[[Column, Column], Column]


def root_mean_square(prediction: Column, actual: Column) -> Column:
    return F.sqrt(F.avg(F.pow(prediction - actual, 2)))


def _fold_forecasts(history: DataFrame, models: list[SeriesModel], keys: list[str], cutoffs: list[dt.date], days: int) -> DataFrame:
    """(candidate, model, fold, keys, date, prediction, actual) of every model refitted at every cutoff.

    The fold is a further key of the series: each row is given to the folds that train or test on it, and a model fits and
    forecasts all folds in one plan, whose size does not depend on their number.
    """
    folds = F.array(*[F.struct(F.lit(i).alias("fold"), F.lit(c).alias("cutoff")) for i, c in enumerate(sorted(cutoffs), 1)])
    age = F.datediff(F.col("date"), F.col("_f.cutoff"))
    dealt = history.withColumn("_f", F.explode(folds)).where(age <= days).withColumn("fold", F.col("_f.fold")).withColumn("_test", age > 0)
    dealt = materialize(dealt.drop("_f"))
    train = dealt.where(~F.col("_test")).drop("_test")
    test = dealt.where("_test").select("fold", *keys, "date", F.col("sales").alias("actual"))
    out = None
    for number, model in enumerate(models):
        own = per_group(model, "fold")
        predicted = own.predict(own.fit(train), train, days).select("fold", *keys, "date", "prediction")
        rows = joins.predictions_with_actuals(predicted, test, ["fold", *keys, "date"]).select(
            F.lit(number).alias("candidate"), F.lit(model.name).alias("model"), "fold", *keys, "date", "prediction", "actual")
        out = rows if out is None else out.unionByName(rows)
    return out


def cross_validate(history: DataFrame, models: list[SeriesModel], keys: list[str], cutoffs: list[dt.date], days: int) -> DataFrame:
    """(model, fold, metric, value) of each model refitted at every cutoff and scored on the ``days`` after it;
    feeds ``cv_summary``."""
    rows = _fold_forecasts(materialize(history), models, keys, cutoffs, days)
    errors = evaluate.error_metrics(rows, ["model", "fold"])
    return materialize(errors.unpivot(["model", "fold"], evaluate.METRICS, "metric", "value"))


def search_models(history: DataFrame, candidates: list[SeriesModel], keys: list[str], cutoffs: list[dt.date], days: int,
                  objective: Objective = root_mean_square) -> DataFrame:
    """(candidate, model, value): the mean over folds of a user's objective, an aggregate of prediction and actual; smaller
    is better. A candidate without a value comes last."""
    rows = _fold_forecasts(materialize(history), candidates, keys, cutoffs, days)
    folds = rows.groupBy("candidate", "model", "fold").agg(objective(F.col("prediction"), F.col("actual")).alias("value"))
    return folds.groupBy("candidate", "model").agg(F.avg("value").alias("value")).orderBy(F.asc_nulls_last("value"), "candidate")


def report(bundle: SalesBundle) -> DataFrame:
    """All profiles and cross analyses as ``(dataset, section, metric, key, value)``. The columns of the fact and the
    transactions that a dozen aggregates read are stored first."""
    bundle = replace(bundle, sales=materialize(bundle.sales.select("date", "store_nbr", "family", "sales", "onpromotion")), transactions=materialize(bundle.transactions))
    sales = profile.long_row(profile.sales_profile(bundle.sales), "profile")
    oil = profile.long_row(profile.oil_profile(bundle.oil).drop("first_date", "last_date"), "profile")
    flagged = cal.mark_members(bundle.sales, cal.holiday_dates(bundle.holidays), "date", "h")
    lifts = profile.long_row(profile.lift(flagged, F.col("h") == 1), "holiday_impact").unionByName(
        profile.long_row(profile.lift(bundle.sales, F.col("onpromotion") > 0), "promo_impact"))
    daily = joins.daily_sales_with_oil(bundle.sales, bundle.oil)
    lagged = profile.long_counts(windows.lag_correlations(daily, "dcoilwtico", "sales"), "oil_impact",
                                 "lag_correlation", "lag", "correlation")
    parts = {
        "sales": sales, "stores": profile.store_profile(bundle.stores), "oil": oil,
        "holidays": profile.holiday_profile(bundle.holidays),
        "transactions": profile.transaction_profile(bundle.transactions),
        "cross": lifts.unionByName(lagged),
    }
    out = None
    for name, part in parts.items():
        rows = part.select(F.lit(name).alias("dataset"), "section", "metric", "key", "value")
        out = rows if out is None else out.unionByName(rows)
    return out


def check_drift(reference: DataFrame, current: DataFrame, cols: list[str], thresholds: monitor.Thresholds = monitor.Thresholds(),
                log_path: str | None = None, ts: dt.datetime | None = None) -> DataFrame:
    """Drift statistics of each column against the thresholds, appended to the metrics log when a path is given."""
    scored = drift.ks_drift(reference, current, cols)
    long = scored.select("column", "ks_stat", F.col("p_value").alias("drift_p")).unpivot(
        ["column"], ["ks_stat", "drift_p"], "metric", "value")
    limits = monitor.threshold_table(reference.sparkSession, thresholds)
    alerts = F.when(F.col("direction") == "below", F.col("value") < F.col("threshold")).otherwise(F.col("value") > F.col("threshold"))
    checked = long.join(F.broadcast(limits), "metric", "left").select("column", "metric", "value", alerts.alias("exceeded"))
    if log_path is not None:
        checked = materialize(checked)
        stamp = F.lit(ts) if ts is not None else F.current_timestamp()
        tables.append_metrics(checked.select(stamp.alias("ts"), F.lit("drift_metrics").alias("metric_type"),
                                             F.lit(None).cast("string").alias("model"), F.col("column").alias("series"),
                                             "metric", "value"), log_path)
    return checked


def retrain_best_model(spark: SparkSession, run_folder: str, history: DataFrame, models: list[SeriesModel], keys: list[str],
                       started: dt.datetime, metric: str = "rmse", test_days: int = 14) -> tuple[str, DataFrame]:
    """Refit the model of the best logged run on new data, log the new run, and return its id and metrics."""
    runs, run_metrics = tables.read_runs(spark, run_folder)
    best = evaluate.best_run(run_metrics, metric).join(runs, "run_id").first()
    if best is None:
        raise ValueError("no best model found")
    chosen = [m for m in models if m.name == best["model"]]
    metrics, _ = train_and_select(history, chosen, keys, test_days, metric)
    run_id = uuid.uuid4().hex
    # four rows: one model's error metrics
    rows = [("test", r["metric"], 0, r["value"]) for r in metrics.collect()]
    tables.log_run(spark, run_folder, run_id, best["model"], started, metrics=rows, parent_id=best["run_id"])
    return run_id, metrics

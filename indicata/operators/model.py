"""Scaling, correlation and the elastic-net model."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicata.functions import fixed_values as V
from indicata.operators import moments as M
from indicata.session import checkpointed


@dataclass(frozen=True)
class MinMax:
    """Minimum and maximum per column, from one aggregate over the rows."""

    bounds: dict[str, tuple[float, float]]

    @classmethod
    def fit(cls, df: DataFrame, columns: Sequence[str]) -> MinMax:
        row = df.agg(
            *[
                measure
                for i, name in enumerate(columns)
                for measure in (
                    F.min(F.col(f"`{name}`").cast("double")).alias(f"lo{i}"),
                    F.max(F.col(f"`{name}`").cast("double")).alias(f"hi{i}"),
                )
            ]
        ).first()
        if any(bound is None for bound in row):
            raise ValueError("a column to scale has no values")
        return cls({name: (row[f"lo{i}"], row[f"hi{i}"]) for i, name in enumerate(columns)})

    def transform(self, df: DataFrame) -> DataFrame:
        """Scale to 0..1; a constant column becomes 0."""
        return df.withColumns(
            {
                name: (F.col(f"`{name}`").cast("double") - F.lit(low)) / F.lit((high - low) or 1.0)
                for name, (low, high) in self.bounds.items()
            }
        )


def time_split(df: DataFrame, share: float = V.TRAIN_SHARE, time: str = "YEAR") -> tuple[DataFrame, DataFrame]:
    """Rows before and from ``share`` of the scaled time column."""
    return df.where(F.col(time) < share), df.where(F.col(time) >= share)


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The correlation matrix as rows (``feature``, ``other``, ``correlation``).

    It comes from the moments of one aggregate. Where a column has nulls, rows where either value is null do not
    count for a pair, so each pair is measured on its own rows.
    """
    (found,) = M.gather(df, columns).values() or [M.none(columns)]
    if found.missing or not found.count:
        return _pairwise_correlations(df, columns)
    return correlation_rows(df, found)


def correlation_rows(df: DataFrame, moments: M.Moments) -> DataFrame:
    """The correlations of ``moments`` as rows, in the session of ``df``."""
    matrix = moments.correlation()
    cells = [
        (a, b, None if math.isnan(matrix[i, j]) else float(matrix[i, j]))
        for i, a in enumerate(moments.columns)
        for j, b in enumerate(moments.columns)
    ]
    return df.sparkSession.createDataFrame(cells, "feature string, other string, correlation double")


def _pairwise_correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    row = df.agg(
        *[
            F.corr(F.col(f"`{a}`").cast("double"), F.col(f"`{b}`").cast("double")).alias(f"c{k}")
            for k, (a, b) in enumerate(pairs)
        ]
    )
    cells = [
        F.struct(F.lit(x).alias("feature"), F.lit(y).alias("other"), F.col(f"c{k}").alias("correlation"))
        for k, (a, b) in enumerate(pairs)
        for x, y in dict.fromkeys([(a, b), (b, a)])
    ]
    return row.select(F.inline(F.array(*cells)))


@dataclass(frozen=True)
class ElasticNetFit:
    """A fitted model with the penalty cross-validation chose, and the moments of the rows it was fitted on."""

    coefficients: tuple[float, ...]
    intercept: float
    alpha: float
    fold_mse: dict[float, float]
    features: tuple[str, ...]
    moments: M.Moments

    def predict(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        """``df`` with the prediction as a plain arithmetic column."""
        terms: Column = F.lit(self.intercept)
        for feature, weight in zip(self.features, self.coefficients):
            terms = terms + F.col(f"`{feature}`").cast("double") * F.lit(weight)
        return df.withColumn(name, terms)


def contiguous_folds(df: DataFrame, folds: int, time: str) -> Column:
    """Fold numbers that are blocks of consecutive values of ``time``, sizes differing by one at most.

    Rows of one time stay together. The distinct times, however many, are sorted into ranges and numbered there;
    the driver sees the number of times in each range and the first time of each fold.
    """
    times = df.select(F.col(f"`{time}`").alias("time")).where("time IS NOT NULL").distinct()
    ranges = times.repartitionByRange("time").sortWithinPartitions("time")
    # the range stands above the lowest 33 bits, the place in it below
    placed = checkpointed(ranges.withColumn("at", F.monotonically_increasing_id()))
    held = sorted(placed.groupBy(F.shiftright("at", 33).alias("range")).count().collect())
    total = sum(n for _, n in held)
    if total < folds:
        raise ValueError(f"{folds} folds need at least {folds} distinct values of {time}")
    size, larger = divmod(total, folds)
    wanted, before = [], 0
    for number, n in held:
        starts = [k * size + min(k, larger) for k in range(1, folds)]
        wanted += [(number << 33) + start - before for start in starts if before <= start < before + n]
        before += n
    fold = F.lit(0)
    for row in placed.where(F.col("at").isin(wanted)).collect() if wanted else []:
        fold = fold + (F.col(f"`{time}`") >= F.lit(row["time"])).cast("int")
    return fold


def fit_elastic_net(
    train: DataFrame,
    features: Sequence[str],
    label: str = V.LABEL_COLUMN,
    alphas: Sequence[float] = V.ALPHAS,
    l1_ratio: float = V.L1_RATIO,
    folds: int = V.FOLDS,
    time: str = "YEAR",
) -> ElasticNetFit:
    """Fit an elastic net whose ``alpha`` has the lowest mean squared error over the folds.

    One pass over the rows takes each fold's moments; fits for any number of penalties, and their errors on the
    fold left out, follow from these without the rows. Of equally good alphas the largest is taken. Rows without
    ``time`` are in no fold and count for the final fit only.
    """
    features = tuple(features)
    parts = M.gather(train, (*features, label), contiguous_folds(train, folds, time))
    missing = sorted({c for part in parts.values() for c in part.missing})
    if missing:
        raise ValueError(f"rows to fit on have nulls in {', '.join(missing)}")
    blank = M.none((*features, label))
    errors: dict[float, list[float]] = {alpha: [] for alpha in alphas}
    for k in range(folds):
        kept = sum((parts[i] for i in range(folds) if i != k), blank)
        for alpha in alphas:
            weights, intercept = M.elastic_net(kept, label, alpha, l1_ratio)
            errors[alpha].append(M.squared_error(parts[k], label, weights, intercept))
    fold_mse = {alpha: math.fsum(found) / folds for alpha, found in errors.items()}
    best = min(sorted(alphas, reverse=True), key=fold_mse.__getitem__)
    whole = sum(parts.values(), blank)
    weights, intercept = M.elastic_net(whole, label, best, l1_ratio)
    return ElasticNetFit(tuple(map(float, weights)), intercept, best, fold_mse, features, whole)


def regression_metrics(predictions: DataFrame, label: str = V.LABEL_COLUMN, prediction: str = "prediction") -> DataFrame:
    """R2, MSE and RMSE in one aggregate."""
    actual = F.col(label).cast("double")
    mse = F.avg(F.pow(actual - F.col(prediction), F.lit(2)))
    return predictions.agg(
        (F.lit(1.0) - F.try_divide(mse, F.var_pop(actual))).alias("R2"),
        mse.alias("MSE"),
        F.sqrt(mse).alias("RMSE"),
    )


@dataclass(frozen=True)
class GdpModel:
    """Everything the GDP model reports."""

    fit: ElasticNetFit
    correlations: DataFrame
    predictions: DataFrame
    metrics: DataFrame


def fit_gdp_model(
    table: DataFrame,
    columns: Sequence[str] = V.FEATURE_COLUMNS,
    label: str = V.LABEL_COLUMN,
    time: str = "YEAR",
    share: float = V.TRAIN_SHARE,
    fit_on: str = "all",
    **options: object,
) -> GdpModel:
    """Scale, split by time, fit, predict the later rows and measure.

    ``fit_on="all"`` takes the scaling bounds from all rows. ``"train"`` takes them from the training
    rows only, which keeps the test rows out of the fit; the split is by the time of all rows in both.
    The table is small but what leads to it may not be, so it is computed once.
    """
    columns = list(columns)
    table = checkpointed(table.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in columns]))
    whole = MinMax.fit(table, columns)
    if fit_on == "train":
        low, high = whole.bounds[time]
        early = table.where(F.col(time).cast("double") < F.lit(low + share * (high - low)))
        others = MinMax.fit(early, [c for c in columns if c != time]).bounds
        whole = MinMax({**others, time: whole.bounds[time]})
    train, test = time_split(whole.transform(table), share, time)
    features = [c for c in columns if c not in (time, label)]
    fit = fit_elastic_net(train, features, label, time=time, **options)
    predictions = fit.predict(test)
    matrix = correlation_rows(table, fit.moments.of(features))
    return GdpModel(fit, matrix, predictions, regression_metrics(predictions, label))

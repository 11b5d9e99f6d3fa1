"""Counts, means and cross products of columns, from one aggregate over the rows.

A handful of numbers per group, features times features of them, says all that a linear model, its errors and the
correlations need. Spark's covariance merges centred products, so columns far from zero lose no digits; groups are
merged the same way here.
"""

from __future__ import annotations

from collections.abc import Hashable, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Moments:
    """``count`` rows with their ``mean`` per column and ``cross``, the sums of products of deviations from it.

    ``missing`` are the columns that have nulls; the other fields are of no use then.
    """

    columns: tuple[str, ...]
    count: int
    mean: np.ndarray
    cross: np.ndarray
    missing: tuple[str, ...] = ()

    def __add__(self, other: Moments) -> Moments:
        if not self.count or not other.count:
            return self if self.count else other
        count = self.count + other.count
        step = other.mean - self.mean
        cross = self.cross + other.cross + np.outer(step, step) * (self.count * other.count / count)
        missing = tuple(dict.fromkeys(self.missing + other.missing))
        return Moments(self.columns, count, self.mean + step * (other.count / count), cross, missing)

    def of(self, columns: Sequence[str]) -> Moments:
        """The moments of some of the columns."""
        at = [self.columns.index(c) for c in columns]
        return Moments(tuple(columns), self.count, self.mean[at], self.cross[np.ix_(at, at)], self.missing)

    def covariance(self) -> np.ndarray:
        """Population covariances."""
        return self.cross / self.count

    def correlation(self) -> np.ndarray:
        """Correlations; NaN where a column is constant."""
        spread = np.sqrt(np.diag(self.cross))
        with np.errstate(divide="ignore", invalid="ignore"):
            found = self.cross / np.outer(spread, spread)
        return np.where(np.outer(spread, spread) > 0, found, np.nan)


def none(columns: Sequence[str]) -> Moments:
    """The moments of no rows."""
    n = len(columns)
    return Moments(tuple(columns), 0, np.zeros(n), np.zeros((n, n)))


def gather(df: DataFrame, columns: Sequence[str], by: Column | None = None) -> dict[Hashable, Moments]:
    """The moments of each group of ``by`` (all rows are group None without it)."""
    columns = tuple(columns)
    values = [F.col(f"`{c}`").cast("double") for c in columns]
    measures = [F.count(F.lit(1)).alias("rows")]
    for i, x in enumerate(values):
        measures += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}")]
        measures += [F.covar_pop(x, y).alias(f"c{i}_{j}") for j, y in enumerate(values[: i + 1])]
    grouped = df.groupBy((F.lit(None).cast("int") if by is None else by).alias("group")).agg(*measures)
    found = {}
    for row in grouped.collect():  # one row per group
        missing = tuple(c for i, c in enumerate(columns) if row[f"n{i}"] < row["rows"])
        if missing:
            blank = none(columns)
            found[row["group"]] = Moments(columns, row["rows"], blank.mean, blank.cross, missing)
            continue
        cross = np.empty((len(columns), len(columns)))
        for i in range(len(columns)):
            for j in range(i + 1):
                cross[i, j] = cross[j, i] = row[f"c{i}_{j}"] * row["rows"]
        mean = np.array([row[f"m{i}"] for i in range(len(columns))])
        found[row["group"]] = Moments(columns, row["rows"], mean, cross)
    return found


def elastic_net(moments: Moments, label: str, alpha: float, l1_ratio: float) -> tuple[np.ndarray, float]:
    """The weights of all other columns and the intercept that minimise

    ``1 / (2 n) |y - x w - b|^2 + alpha (l1_ratio |w|_1 + (1 - l1_ratio) / 2 |w|_2^2)``.

    Coordinate descent finds which weights are not zero and their signs; with these the minimum is the solution of
    a linear system, which is taken once it meets the conditions of a minimum.
    """
    at = moments.columns.index(label)
    others = [i for i in range(len(moments.columns)) if i != at]
    spread = moments.covariance()
    gram, pull = spread[np.ix_(others, others)], spread[others, at]
    l1, l2 = alpha * l1_ratio, alpha * (1 - l1_ratio)
    weights = np.zeros(len(others))
    for _ in range(2000):
        for _ in range(50):
            before = weights.copy()
            for j in range(len(weights)):
                if gram[j, j] + l2 <= 0:
                    continue  # a constant column without penalty has no weight
                rest = pull[j] - gram[j] @ weights + gram[j, j] * weights[j]
                weights[j] = np.sign(rest) * max(abs(rest) - l1, 0.0) / (gram[j, j] + l2)
        active = np.flatnonzero(weights)
        signs = np.sign(weights[active])
        exact = np.zeros(len(weights))
        system = gram[np.ix_(active, active)] + l2 * np.eye(len(active))
        exact[active] = np.linalg.lstsq(system, pull[active] - l1 * signs, rcond=None)[0]
        slope = np.abs(pull - gram @ exact - l2 * exact)
        idle = np.setdiff1d(np.arange(len(weights)), active)
        scale = 1e-9 * max(1.0, np.abs(pull).max(initial=0.0))
        if (np.sign(exact[active]) == signs).all() and (slope[idle] <= l1 + scale).all() and (
            np.abs(slope[active] - l1) <= scale
        ).all():
            weights = exact
            break
        if np.abs(weights - before).max(initial=0.0) < 1e-15:
            break
    return weights, float(moments.mean[at] - moments.mean[others] @ weights)


def squared_error(moments: Moments, label: str, weights: np.ndarray, intercept: float) -> float:
    """The mean squared error of a linear model over the rows of ``moments``."""
    at = moments.columns.index(label)
    direction = np.insert(-weights, at, 1.0)  # label less the weighted others
    offset = moments.mean @ direction - intercept
    return float(direction @ moments.covariance() @ direction + offset * offset)

"""Grouped linear regression from aggregated moments.

Spark sums the moments of each group; only the small solve per group (one row of moments in, one
row of coefficients out) runs in Python.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

MOMENTS = ["n", "mx", "my", "cxx", "cxy", "cyy", "lo", "hi"]
MOMENT_TYPES = ("n long, mx array<double>, my double, cxx array<double>, cxy array<double>, cyy double, "
                "lo array<double>, hi array<double>")
FIT = ("intercept double, has_const boolean, coef array<double>, se array<double>, t array<double>, "
       "p array<double>, rss double, rank int")
RANK_TOL = 1e-11  # eigenvalues of the correlation matrix below this share of the largest are zero


def moments(df: DataFrame, group: list[str], y: str, xs: list[str]) -> DataFrame:
    """Counts, means, covariances and ranges per group, over rows where everything is present.

    Plain aggregates throughout, so rows are combined before the shuffle however large a group is.
    """
    return _complete(df, group, y, xs).groupBy(*group).agg(*_moment_columns(len(xs)))


def _complete(df: DataFrame, group: list[str], y: str, xs: list[str]) -> DataFrame:
    """The group, ``_y`` and ``_x0``... of rows where everything is present."""
    return df.select(*group, F.col(y).cast("double").alias("_y"),
                     *[F.col(x).cast("double").alias(f"_x{i}") for i, x in enumerate(xs)]).na.drop()


def _moment_columns(number: int) -> list[Column]:
    """The aggregates over ``_y`` and so many ``_x``; rows where all of these are null do not count."""
    x = [f"_x{i}" for i in range(number)]
    cov = {(i, j): F.covar_pop(x[i], x[j]) for i in range(len(x)) for j in range(i, len(x))}
    return [
        F.count("_y").alias("n"), F.array(*[F.avg(c) for c in x]).alias("mx"), F.avg("_y").alias("my"),
        F.array(*[cov[min(i, j), max(i, j)] for i in range(len(x)) for j in range(len(x))]).alias("cxx"),
        F.array(*[F.covar_pop(c, "_y") for c in x]).alias("cxy"), F.var_pop("_y").alias("cyy"),
        F.array(*[F.min(c) for c in x]).alias("lo"), F.array(*[F.max(c) for c in x]).alias("hi")]


def array_moments(df: DataFrame, group: list[str], y: str, x: str, spread: int = 8) -> DataFrame:
    """The same moments where each group has its own number of regressors, held in an array.

    Rows of a group are brought together in ``spread`` places, so a large group is shared by
    several tasks while a batch holds few groups. Each batch is reduced to one row of partial
    moments per group, and those few rows are merged.
    """
    rows = df.select(*group, F.col(y).cast("double").alias("_y"), F.col(x).alias("_x"))
    rows = rows.where(F.col("_y").isNotNull() & ~F.exists("_x", lambda v: v.isNull() | F.isnan(v)))
    rows = rows.repartition(*group, F.pmod(F.xxhash64("_y", "_x"), F.lit(spread))).sortWithinPartitions(*group)
    kinds = dict(rows.dtypes)
    schema = "".join(f"{g} {kinds[g]}, " for g in group) + MOMENT_TYPES

    def reduce_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for key, part in pdf.groupby(group, sort=False):
                xs, ys = np.stack(part["_x"].to_numpy()), part["_y"].to_numpy()
                mx, my = xs.mean(axis=0), ys.mean()
                dx, dy = xs - mx, ys - my
                k = len(ys)
                out.append((*key, k, mx, my, (dx.T @ dx / k).ravel(), dx.T @ dy / k, float(dy @ dy / k),
                            xs.min(axis=0), xs.max(axis=0)))
            if out:
                yield pd.DataFrame(out, columns=[*group, *MOMENTS])

    def merge(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
        merged = merge_moments([unpack(p) for p in parts[MOMENTS].itertuples(index=False)])
        return pd.DataFrame([(*key, *pack(merged))], columns=[*group, *MOMENTS])

    return rows.mapInPandas(reduce_batches, schema).groupBy(*group).applyInPandas(merge, schema)


def unpack(row) -> dict:
    p = len(row.mx)
    return {"n": int(row.n), "mx": np.asarray(row.mx, dtype=float), "my": float(row.my),
            "cxx": np.asarray(row.cxx, dtype=float).reshape(p, p), "cxy": np.asarray(row.cxy, dtype=float),
            "cyy": float(row.cyy), "lo": np.asarray(row.lo, dtype=float), "hi": np.asarray(row.hi, dtype=float)}


def pack(m: dict) -> tuple:
    return m["n"], m["mx"], m["my"], m["cxx"].ravel(), m["cxy"], m["cyy"], m["lo"], m["hi"]


def merge_moments(parts: list[dict], drop: int | None = None) -> dict:
    """Moments of the union of disjoint parts, optionally without one of them."""
    parts = [m for i, m in enumerate(parts) if i != drop]
    n = sum(m["n"] for m in parts)
    w = [m["n"] / n for m in parts]
    mx = sum(a * m["mx"] for a, m in zip(w, parts))
    my = sum(a * m["my"] for a, m in zip(w, parts))
    return {
        "n": n, "mx": mx, "my": my,
        "cxx": sum(a * (m["cxx"] + np.outer(m["mx"] - mx, m["mx"] - mx)) for a, m in zip(w, parts)),
        "cxy": sum(a * (m["cxy"] + (m["mx"] - mx) * (m["my"] - my)) for a, m in zip(w, parts)),
        "cyy": sum(a * (m["cyy"] + (m["my"] - my) ** 2) for a, m in zip(w, parts)),
        "lo": np.min([m["lo"] for m in parts], axis=0), "hi": np.max([m["hi"] for m in parts], axis=0)}


def least_squares(m: dict) -> dict:
    """Smallest-norm least squares. A regressor that is constant and not zero stands in for the
    intercept, which is then not added."""
    p, n = len(m["mx"]), m["n"]
    live = (m["lo"] != m["hi"]) & (m["cxx"].diagonal() > 0)
    fixed = ~live & (m["lo"] != 0)
    c, cxy, mx = m["cxx"][np.ix_(live, live)], m["cxy"][live], m["mx"][live]
    s = np.sqrt(c.diagonal())
    values, vectors = np.linalg.eigh(c / np.outer(s, s))
    real = values > RANK_TOL * values.max(initial=0.0)
    inverse = (vectors[:, real] / values[real]) @ vectors[:, real].T / np.outer(s, s)
    beta = inverse @ cxy
    weight = float(np.sum(m["lo"][fixed] ** 2)) if fixed.any() else 1.0
    if not real.all():
        # Directions the data cannot tell apart: take the smallest coefficients, intercept included.
        null = vectors[:, ~real] / s[:, None]
        stacked = np.vstack([null, mx @ null / math.sqrt(weight)])
        target = np.append(beta, -(m["my"] - mx @ beta) / math.sqrt(weight))
        beta = beta - null @ np.linalg.lstsq(stacked, target, rcond=None)[0]
    level = m["my"] - mx @ beta
    rss = n * max(m["cyy"] - 2 * beta @ cxy + beta @ c @ beta, 0.0)
    rank = int(real.sum()) + 1
    coef, se = np.where(fixed, level * m["lo"] / weight, 0.0), np.full(p, np.nan)
    coef[live] = beta
    if n > rank:
        se[live] = np.sqrt(np.maximum(rss / (n - rank) * inverse.diagonal() / n, 0.0))
    return {"intercept": 0.0 if fixed.any() else level, "has_const": not fixed.any(), "coef": coef, "se": se,
            "rss": rss, "rank": rank, "dof": n - rank}


def ridge(m: dict, lam: float) -> dict:
    """Ridge with an unpenalised intercept."""
    p, n = len(m["mx"]), m["n"]
    beta = np.linalg.solve(n * m["cxx"] + lam * np.eye(p), n * m["cxy"])
    rss = n * max(m["cyy"] - 2 * beta @ m["cxy"] + beta @ m["cxx"] @ beta, 0.0)
    return {"intercept": m["my"] - m["mx"] @ beta, "has_const": True, "coef": beta, "se": np.full(p, np.nan),
            "rss": rss, "rank": p + 1, "dof": n - p - 1}


def t_two_sided(t: float, dof: int) -> float:
    """P(|T| > |t|) for Student's t: the regularised incomplete beta function as a continued fraction."""
    if math.isnan(t) or dof <= 0:
        return math.nan
    x = dof / (dof + t * t)
    return _incomplete_beta(dof / 2, 0.5, x) if x < 1 else 1.0


def _incomplete_beta(a: float, b: float, x: float) -> float:
    if x <= 0:
        return 0.0
    if x > (a + 1) / (a + b + 2):
        return 1.0 - _incomplete_beta(b, a, 1 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    tiny, f, c, d = 1e-300, 1.0, 1.0, 0.0
    for step in range(400):
        k = step // 2
        if step == 0:
            term = 1.0
        elif step % 2 == 0:
            term = k * (b - k) * x / ((a + 2 * k - 1) * (a + 2 * k))
        else:
            term = -(a + k) * (a + b + k) * x / ((a + 2 * k) * (a + 2 * k + 1))
        d = 1.0 / (1.0 + term * d or tiny)
        c = 1.0 + term / c or tiny
        f *= c * d
        if abs(1.0 - c * d) < 1e-15:
            break
    return front * (f - 1.0)


def _fit_row(m: dict, method: str, lam: float) -> dict:
    if method == "ols":
        fit = least_squares(m)
    elif method == "ridge":
        fit = ridge(m, lam)
    else:
        raise ValueError("method must be 'ols' or 'ridge'")
    with np.errstate(divide="ignore", invalid="ignore"):
        t = fit["coef"] / fit["se"]
    fit["t"] = t
    fit["p"] = np.array([t_two_sided(v, fit["dof"]) for v in t])
    return {k: fit[k] for k in ("intercept", "has_const", "coef", "se", "t", "p", "rss", "rank")}


def solve(sums: DataFrame, method: str = "ols", lam: float = 0.01) -> DataFrame:
    """Moments with a ``fit`` struct: intercept, coefficients and their statistics. 'auto' reads the method from a column of that name."""
    chosen = F.col("method") if method == "auto" else F.lit(method)

    @F.pandas_udf(FIT)
    def fit(method: pd.Series, n: pd.Series, mx: pd.Series, my: pd.Series, cxx: pd.Series, cxy: pd.Series, cyy: pd.Series,
            lo: pd.Series, hi: pd.Series) -> pd.DataFrame:
        rows = pd.DataFrame(dict(zip(MOMENTS, (n, mx, my, cxx, cxy, cyy, lo, hi))))
        return pd.DataFrame([_fit_row(unpack(row), m, lam) for m, row in zip(method, rows.itertuples(index=False))],
                            columns=["intercept", "has_const", "coef", "se", "t", "p", "rss", "rank"])

    return sums.withColumn("fit", fit(chosen, *MOMENTS))


def grouped_fit(df: DataFrame, group: list[str], y: str, xs: list[str], method: str = "ols",
                lam: float = 0.01) -> DataFrame:
    """One row per group with ``n``, ``cyy`` and the ``fit`` of ``y`` on ``xs``.

    'auto' is least squares, but ridge over the finite rows in groups that hold an infinite value, for which least
    squares has no answer; ``method`` tells which. Groups without a finite row have no fit.
    """
    if method != "auto":
        return solve(moments(df, group, y, xs), method, lam).select(*group, "n", "cyy", "fit")
    # one aggregate counts the unusable rows and sums the others: unusable values are null, which no moment counts
    complete, names = _complete(df, group, y, xs), ["_y", *(f"_x{i}" for i in range(len(xs)))]
    usable = reduce(lambda a, b: a & b, [F.abs(c) < F.lit(math.inf) for c in names])
    masked = complete.select(*group, usable.alias("_usable"), *[F.when(usable, F.col(c)).alias(c) for c in names])
    tested = masked.groupBy(*group).agg(*_moment_columns(len(xs)), F.count_if(~F.col("_usable")).alias("_bad")).where("n > 0")
    return _by_choice(tested, lam).select(*group, "n", "cyy", "fit", "method")


def _by_choice(tested: DataFrame, lam: float) -> DataFrame:
    """Least squares for groups of usable rows only, ridge for those with ``_bad`` ones."""
    return solve(tested.withColumn("method", F.when(F.col("_bad") > 0, "ridge").otherwise("ols")), "auto", lam).drop("_bad")


def array_fit(df: DataFrame, group: list[str], y: str, x: str, method: str = "ols", lam: float = 0.01) -> DataFrame:
    """``solve`` of ``array_moments``; 'auto' as in ``grouped_fit``."""
    if method != "auto":
        return solve(array_moments(df, group, y, x), method, lam)
    complete = df.where(F.col(y).isNotNull() & ~F.isnan(F.col(y).cast("double")) & ~F.exists(x, lambda v: v.isNull() | F.isnan(v)))
    usable = (F.abs(F.col(y).cast("double")) < F.lit(math.inf)) & F.forall(x, lambda v: F.abs(v) < F.lit(math.inf))
    bad = complete.groupBy(*group).agg(F.count_if(~usable).alias("_bad"))
    return _by_choice(array_moments(complete.where(usable), group, y, x).join(bad, group), lam)


def coefficients(fits: DataFrame, group: list[str], names: list[str] | str) -> DataFrame:
    """Long table (group, feature, coef, se, t, p); ``names`` is a list or a column of names."""
    names = F.array(*[F.lit(n) for n in names]) if isinstance(names, list) else F.col(names)
    cells = F.arrays_zip(names.alias("feature"), F.col("fit.coef").alias("coef"), F.col("fit.se").alias("se"),
                         F.col("fit.t").alias("t"), F.col("fit.p").alias("p"))
    slopes = fits.select(*group, F.inline(cells))
    const = fits.where("fit.has_const").select(
        *group, F.lit("const").alias("feature"), F.col("fit.intercept").alias("coef"),
        *[F.lit(None).cast("double").alias(c) for c in ("se", "t", "p")])
    out = const.unionByName(slopes)
    return out.select(*group, "feature", "coef", *[F.when(~F.isnan(c), F.col(c)).alias(c) for c in ("se", "t", "p")])


def predicted(xs: list[str]):
    """Fitted value of a row joined with its group's ``fit``."""
    return sum((F.col("fit.coef")[i] * F.col(x).cast("double") for i, x in enumerate(xs)), F.col("fit.intercept"))


def with_residuals(df: DataFrame, group: list[str], y: str, xs: list[str], name: str = "residuals") -> DataFrame:
    fits = grouped_fit(df, group, y, xs).select(*group, "fit")
    return df.join(fits, group).withColumn(name, F.col(y) - predicted(xs)).drop("fit")


def ridge_cv(df: DataFrame, group: list[str], y: str, xs: list[str], order: list[str], lambdas: list[float],
             folds: int = 5, seed: int = 42, by: Column | None = None) -> DataFrame:
    """Ridge on standardised regressors, penalty chosen by cross-validated R2.

    Rows of a group are dealt to folds in the order of a seeded hash, or of ``by``. Moments are summed per fold,
    and a training set is the merge of the other folds. Gives the slope of the first regressor in
    original units, plain and bias-corrected, and the penalty. ``order`` identifies a row within
    its group; groups are series, at most one row per period.
    """
    complete = df.na.drop(subset=[y, *xs])
    deal = Window.partitionBy(*group).orderBy(F.xxhash64(F.lit(seed), *order) if by is None else by, *order)
    dealt = complete.withColumn("_fold", (F.row_number().over(deal) - 1) % folds)
    sums = moments(dealt, [*group, "_fold"], y, xs)
    kinds = dict(sums.dtypes)
    schema = "".join(f"{g} {kinds[g]}, " for g in group) + "slope double, slope_debiased double, lam double"

    def choose(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
        out = _choose_penalty([unpack(p) for p in parts.sort_values("_fold")[MOMENTS].itertuples(index=False)],
                              lambdas, folds)
        return pd.DataFrame([(*key, *out)], columns=[*group, "slope", "slope_debiased", "lam"])

    return sums.groupBy(*group).applyInPandas(choose, schema)


def _choose_penalty(parts: list[dict], lambdas: list[float], folds: int) -> tuple:
    if len(parts) < folds:
        return None, None, None
    total = merge_moments(parts)
    std = np.sqrt(np.maximum(total["cxx"].diagonal(), 0.0))
    std = np.where(std > 0, std, 1.0)

    def scaled(m: dict) -> dict:
        return {**m, "mx": (m["mx"] - total["mx"]) / std, "cxx": m["cxx"] / np.outer(std, std), "cxy": m["cxy"] / std}

    parts, total = [scaled(m) for m in parts], scaled(total)
    best, best_score = lambdas[0], -math.inf
    for lam in lambdas:
        scores = []
        for i, held in enumerate(parts):
            fit = ridge(merge_moments(parts, drop=i), lam)
            beta = fit["coef"]
            miss = held["my"] - fit["intercept"] - held["mx"] @ beta
            err = held["cyy"] - 2 * beta @ held["cxy"] + beta @ held["cxx"] @ beta + miss * miss
            scores.append(1 - err / held["cyy"] if held["cyy"] > 0 else float(err <= 0))
        if np.mean(scores) > best_score:
            best, best_score = lam, np.mean(scores)
    beta = ridge(total, best)["coef"]
    gram = total["n"] * total["cxx"] + best * np.eye(len(beta))
    debiased = beta + best * np.linalg.solve(gram, beta)
    return float(beta[0] / std[0]), float(debiased[0] / std[0]), float(best)

"""Daily sentiment indices, market measures, the aligned panel and inference
(N01-N10, WF2/WF3/WF5/WF6, A10 on the panel).

Daily series hold one row per (symbol, day), so symbol-partitioned windows
over them are bounded by the calendar, not by data volume. Regressions never
pull a series to the driver: OLS and Granger tests are one partial
aggregation of co-moments per group, then a tiny solve on that single
summary row per group (``applyInPandas``).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.scalar import safe_ln
from .aggregates import daily_label_pivot

# Fixed values.
GK_COEF = 2.0 * math.log(2.0) - 1.0     # Garman-Klass weight of ln(C/O)^2
CARRIED = ("bullishness", "agreement", "msg_volume", "pos", "neg")
MARKET_COLS = ("return", "volatility", "log_trading_vol")
SENTIMENT_COLS = ("pos", "neg", "bullishness", "carried_pos", "carried_neg", "carried_bullishness")
GRANGER_FEATURES = ("bullishness", "agreement", "msg_volume")
TRAIN_FRACTION = 0.75


# ----------------------------------------------------------------- indices
def bullishness(pos, neg) -> Column:
    """ln((1+pos)/(1+neg))."""
    return F.ln((1 + F.col(pos)) / (1 + F.col(neg)))


def message_volume(pos, neg) -> Column:
    """ln(pos+neg); NULL when pos+neg = 0."""
    return safe_ln(F.col(pos) + F.col(neg))


def agreement(pos, neg) -> Column:
    """1 - sqrt(1 - ((pos-neg)/(pos+neg))^2); NULL when pos+neg = 0."""
    ratio = F.try_divide(F.col(pos) - F.col(neg), F.col(pos) + F.col(neg))
    return 1 - F.sqrt(1 - ratio * ratio)


def with_indices(df: DataFrame, pos="pos", neg="neg") -> DataFrame:
    return df.withColumns({"bullishness": bullishness(pos, neg),
                           "msg_volume": message_volume(pos, neg),
                           "agreement": agreement(pos, neg)})


def daily_sentiment(corpus: DataFrame, time_col="created_at", label_col="pred_label",
                    group_cols=("symbol",)) -> DataFrame:
    """A09 + N01-N03: per (symbol, date) label counts and the three indices."""
    return with_indices(daily_label_pivot(corpus, time_col, label_col, group_cols))


# ----------------------------------------------------------------- market
def gk_volatility(o="open", h="high", low="low", c="close") -> Column:
    """sqrt(0.5 ln(H/L)^2 - (2ln2-1) ln(C/O)^2); NULL when the radicand < 0."""
    hl = safe_ln(F.col(h) / F.col(low))
    co = safe_ln(F.col(c) / F.col(o))
    v = 0.5 * hl * hl - GK_COEF * co * co
    return F.when(v >= 0, F.sqrt(v))


def market_measures(bars: DataFrame, group_col="symbol", date_col="date") -> DataFrame:
    """WF2 log return x100 (lag over the full bar series), N05 log volume, N04."""
    w = Window.partitionBy(group_col).orderBy(date_col)
    lc = safe_ln(F.col("close"))
    return bars.withColumns({"return": (lc - F.lag(lc).over(w)) * 100,
                             "log_trading_vol": safe_ln(F.col("volume")),
                             "volatility": gk_volatility()})


def daily_panel(bars: DataFrame, corpus: DataFrame, group_col="symbol",
                date_col="date") -> DataFrame:
    """Market measures (returns lagged before the join) x daily sentiment,
    carried (lag-1 over the joined trading days) features, rows with any NULL dropped.
    """
    m = market_measures(bars, group_col, date_col)
    s = daily_sentiment(corpus, group_cols=(group_col,))
    j = m.join(s, [group_col, date_col], "inner")
    w = Window.partitionBy(group_col).orderBy(date_col)
    j = j.withColumns({f"carried_{c}": F.lag(c).over(w) for c in CARRIED})
    return j.na.drop()


def chrono_split(df: DataFrame, group_col="symbol", date_col="date",
                 fraction: float = TRAIN_FRACTION) -> DataFrame:
    """WF6: first floor(fraction * n) rows (by date) of each group are 'train'."""
    w = Window.partitionBy(group_col).orderBy(date_col)
    n = F.count("*").over(Window.partitionBy(group_col))
    rn = F.row_number().over(w)
    return df.withColumn("split", F.when(rn <= F.floor(n * F.lit(fraction)), "train")
                         .otherwise("test"))


def lag_columns(df: DataFrame, cols: Sequence[str], max_lag: int, group_col="symbol",
                date_col="date") -> DataFrame:
    """WF5: ``{c}_lag{k}`` for k = 1..max_lag (positional lags over the rows)."""
    w = Window.partitionBy(group_col).orderBy(date_col)
    lags = {f"{c}_lag{k}": F.lag(c, k).over(w) for c in cols for k in range(1, max_lag + 1)}
    return df.withColumns({"_rn": F.row_number().over(w), **lags})


# ----------------------------------------------------------------- co-moments
def _comoments(z: Sequence[Column], y: Column) -> list[Column]:
    """Row count, and centred sums of products of the regressors ``z`` and ``y`` (co-moment aggregates merge
    stably, so no means are needed beforehand)."""
    n = F.count("*")
    aggs = [n.alias("n"), (F.var_pop(y) * n).alias("yy")]
    for i, a in enumerate(z):
        aggs += [(F.covar_pop(a, b) * n).alias(f"zz_{i}_{j}") for j, b in enumerate(z) if j >= i]
        aggs.append((F.covar_pop(a, y) * n).alias(f"zy_{i}"))
    return aggs


def _comoments_by_sums(df: DataFrame, keys: Sequence[str], z: Sequence[Column], y: Column) -> DataFrame:
    """The same per ``keys`` from plain sums, which compile to less code than so many co-moments; for columns whose
    means are near 0, so that nothing cancels."""
    v = [*z, y]
    sums = df.groupBy(*keys).agg(F.count("*").alias("n"), *[F.sum(a).alias(f"s_{i}") for i, a in enumerate(v)],
                                 *[F.sum(a * b).alias(f"p_{i}_{j}") for i, a in enumerate(v) for j, b in enumerate(v) if j >= i])
    k = len(z)

    def name(i: int, j: int) -> str:
        return f"zz_{i}_{j}" if j < k else f"zy_{i}" if i < k else "yy"

    return sums.select(*keys, "n", *[
        (F.col(f"p_{i}_{j}") - F.col(f"s_{i}") * F.col(f"s_{j}") / F.col("n")).alias(name(i, j))
        for i in range(k + 1) for j in range(i, k + 1)])


def _solve_ssr(row: pd.Series, idx: Sequence[int]) -> tuple[np.ndarray, float]:
    """Least squares with an intercept on the centred sums of regressors ``idx``: slopes and the residuals' sum of
    squares. Of the fits of a singular system it is the one with the shortest slopes."""
    xtx = np.array([[row[f"zz_{min(i, j)}_{max(i, j)}"] for j in idx] for i in idx], float)
    xty = np.array([row[f"zy_{i}"] for i in idx], float)
    size = np.sqrt(np.diag(xtx))
    size[size == 0] = 1.0
    unit = xtx / np.outer(size, size)  # correlations: rank is judged free of the columns' scales
    if np.linalg.matrix_rank(unit, hermitian=True) == len(idx):
        beta = np.linalg.solve(unit, xty / size) / size
    else:
        beta = np.linalg.pinv(xtx, rcond=1e-12, hermitian=True) @ xty
    return beta, max(float(row["yy"] - beta @ xty), 0.0)


def ols_by_group(df: DataFrame, group_cols: Sequence[str], features: Sequence[str],
                 label: str) -> DataFrame:
    """OLS with intercept per group; returns ``intercept`` and ``coef_<f>``.

    Rows with a NULL label or feature are skipped. One aggregation gives each
    group's means and co-moments; a singular system has the least-squares fit
    of the shortest slopes.
    """
    cols = [label, *features]
    clean = df.na.drop(subset=cols).select(*group_cols, *[F.col(c).cast("double").alias(c) for c in cols])
    sums = clean.groupBy(*group_cols).agg(*_comoments([F.col(f) for f in features], F.col(label)),
                                          *[F.avg(c).alias(f"_m_{c}") for c in cols])
    names = ["intercept"] + [f"coef_{f}" for f in features]
    schema = ", ".join([*(f"{g} string" for g in group_cols), "n long",
                        *(f"{c} double" for c in names)])

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        row = pdf.iloc[0]
        beta, _ = _solve_ssr(row, range(len(features)))
        intercept = row[f"_m_{label}"] - sum(b * row[f"_m_{f}"] for b, f in zip(beta, features))
        return pd.DataFrame([[*(str(row[g]) for g in group_cols), int(row["n"]), float(intercept), *map(float, beta)]],
                            columns=[*group_cols, "n", *names])

    return sums.groupBy(*group_cols).applyInPandas(solve, schema)


def predict(df: DataFrame, coefs: DataFrame, group_cols: Sequence[str],
            features: Sequence[str], out_col: str = "prediction") -> DataFrame:
    """Apply per-group coefficients (one small row per group) to rows."""
    yhat = F.col("intercept")
    for f in features:
        yhat = yhat + F.col(f"coef_{f}") * F.col(f)
    return df.join(coefs.drop("n"), list(group_cols), "inner").withColumn(out_col, yhat)


def r2_score(y: str, yhat: str) -> Column:
    """1 - sum((y-yhat)^2) / sum((y-mean(y))^2) (aggregate expression)."""
    yc, pc = F.col(y), F.col(yhat)
    ss_res = F.sum((yc - pc) * (yc - pc))
    ss_tot = F.var_pop(yc) * F.count(yc)
    return 1 - F.try_divide(ss_res, ss_tot)


def directional_accuracy(y: str, yhat: str) -> Column:
    """mean(sign(yhat) == sign(y)), sign(0) = 0."""
    return F.avg((F.signum(F.col(y)) == F.signum(F.col(yhat))).cast("double"))


# ----------------------------------------------------------------- Granger
def chi2_sf(x: float, k: int) -> float:
    """Survival function of chi-square with integer ``k`` degrees of freedom."""
    if x is None or not math.isfinite(x):
        return float("nan") if x is None or math.isnan(x) else 0.0
    if x <= 0:
        return 1.0
    h = x / 2.0
    if k % 2 == 0:
        term, total = 1.0, 1.0
        for i in range(1, k // 2):
            term *= h / i
            total += term
        return math.exp(-h) * total
    total = math.erfc(math.sqrt(h))
    for i in range(1, (k - 1) // 2 + 1):
        total += math.exp(-h + (i - 0.5) * math.log(h) - math.lgamma(i + 0.5))
    return total


def granger_pvalues(panel: DataFrame, target: str = "return",
                    features: Sequence[str] = GRANGER_FEATURES, max_lag: int = 5,
                    group_col: str = "symbol", date_col: str = "date") -> DataFrame:
    """Ssr chi-square Granger test of ``feature -> target`` for lags 1..max_lag.

    For lag L on the rows with L predecessors: restricted y ~ 1 + y_1..y_L,
    unrestricted adds x_1..x_L; stat = n (SSR_r - SSR_u) / SSR_u, p = chi2_sf(stat, L).
    """
    cols = [target, *features]
    # centring is a shift (SSRs are unchanged); its window has the lags' partitioning, so it costs no shuffle
    whole = Window.partitionBy(group_col)
    centred = panel.select(group_col, date_col, *[(F.col(c) - F.avg(c).over(whole)).alias(c) for c in cols])
    lagged = lag_columns(centred, cols, max_lag, group_col, date_col)
    combos = F.explode(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.lit(L).alias("lag"))
        for f in features for L in range(1, max_lag + 1)])).alias("c")
    x = lagged.select("*", combos).select("*", "c.feature", "c.lag").drop("c")
    # regressor slots: max_lag y lags, then max_lag x lags (unused -> 0)
    z = [F.when(F.col("lag") >= i, F.col(f"{target}_lag{i}")).otherwise(F.lit(0.0))
         for i in range(1, max_lag + 1)]
    for i in range(1, max_lag + 1):
        xi = None
        for f in features:
            v = F.when(F.col("feature") == f, F.col(f"{f}_lag{i}"))
            xi = v if xi is None else F.coalesce(xi, v)
        z.append(F.when(F.col("lag") >= i, xi).otherwise(F.lit(0.0)))
    usable = (F.col("_rn") > F.col("lag"))
    x = x.filter(usable)
    sums = _comoments_by_sums(x, [group_col, "feature", "lag"], z, F.col(target))
    schema = (f"{group_col} string, feature string, lag int, n_obs long, "
              "ssr_restricted double, ssr_full double, chi2 double, p_value double")

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        row = pdf.iloc[0]
        L = int(row["lag"])
        own = list(range(L))
        full = own + list(range(max_lag, max_lag + L))
        _, ssr_r = _solve_ssr(row, own)
        _, ssr_u = _solve_ssr(row, full)
        n = int(row["n"])
        stat = p = None
        if ssr_u > 0:
            stat = n * (ssr_r - ssr_u) / ssr_u
            p = chi2_sf(stat, L)
        return pd.DataFrame({group_col: [str(row[group_col])], "feature": [row["feature"]],
                             "lag": [L], "n_obs": [n], "ssr_restricted": [ssr_r],
                             "ssr_full": [ssr_u], "chi2": [stat], "p_value": [p]})

    return sums.groupBy(group_col, "feature", "lag").applyInPandas(solve, schema)

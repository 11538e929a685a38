"""Registered study queries: daily indices, market measures, panel, correlation,
split, Granger, OLS, R^2 and directional accuracy (A09, A10, A13, N01-N10, WF2-WF6)."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from ..operators import aggregates as A
from ..operators import econ as E
from ..session import scratch_path
from ..sources import testviews as V
from .registry import r, register
from .sqlviews import with_views

_LN = "CASE WHEN ({x}) > 0 THEN ln({x}) END"


def ln(x: str) -> str:
    return _LN.format(x=x)


_SENT = f"""daily AS (
  SELECT symbol, CAST(created_at AS DATE) AS date,
         count_if(pred_label = 'BULLISH') AS pos, count_if(pred_label = 'BEARISH') AS neg,
         count_if(pred_label = 'NEUTRAL') AS NEUTRAL
  FROM label_corpus_v GROUP BY symbol, CAST(created_at AS DATE)),
sent AS (
  SELECT *, ln((1 + pos) / (1 + neg)) AS bullishness,
         {ln('pos + neg')} AS msg_volume,
         CASE WHEN pos + neg = 0 THEN NULL
              ELSE 1 - sqrt(1 - power((pos - neg) / (pos + neg), 2)) END AS agreement
  FROM daily),
mkt AS (
  SELECT symbol, date, open, high, low, close, volume,
         ({ln('close')} - lag({ln('close')}) OVER (PARTITION BY symbol ORDER BY date)) * 100 AS return,
         {ln('volume')} AS log_trading_vol,
         CASE WHEN gk >= 0 THEN sqrt(gk) END AS volatility
  FROM (SELECT *, 0.5 * power({ln('high / low')}, 2)
                  - (2 * ln(2) - 1) * power({ln('close / open')}, 2) AS gk FROM bars_v) b),
joined AS (
  SELECT m.*, s.pos, s.neg, s.NEUTRAL, s.bullishness, s.msg_volume, s.agreement
  FROM mkt m JOIN sent s ON m.symbol = s.symbol AND m.date = s.date),
carried AS (
  SELECT *, lag(bullishness) OVER w AS carried_bullishness, lag(agreement) OVER w AS carried_agreement,
         lag(msg_volume) OVER w AS carried_msg_volume, lag(pos) OVER w AS carried_pos,
         lag(neg) OVER w AS carried_neg
  FROM joined WINDOW w AS (PARTITION BY symbol ORDER BY date)),
panel AS (
  SELECT * FROM carried
  WHERE open IS NOT NULL AND high IS NOT NULL AND low IS NOT NULL AND close IS NOT NULL
    AND volume IS NOT NULL AND return IS NOT NULL AND log_trading_vol IS NOT NULL
    AND volatility IS NOT NULL AND bullishness IS NOT NULL AND msg_volume IS NOT NULL
    AND agreement IS NOT NULL AND carried_bullishness IS NOT NULL
    AND carried_agreement IS NOT NULL AND carried_msg_volume IS NOT NULL
    AND carried_pos IS NOT NULL AND carried_neg IS NOT NULL)"""

_VIEWS = ["bars_v", "label_corpus_v"]


def study_sql(body: str) -> str:
    return with_views(_VIEWS, body, extra=_SENT)


def _sent(spark, d):
    return E.daily_sentiment(V.label_corpus_v(spark, d))


def _panel(spark, d):
    return E.daily_panel(V.bars_v(spark, d), V.label_corpus_v(spark, d))


@register("daily_label_pivot", "A09 D02 P09", study_sql("""
SELECT symbol, date, pos, neg, NEUTRAL FROM daily"""))
def q_daily_label_pivot(spark, d):
    """Per-day label counts (BULLISH->pos, BEARISH->neg), missing -> 0."""
    return A.daily_label_pivot(V.label_corpus_v(spark, d), group_cols=("symbol",))


@register("bullishness", "N01", study_sql(f"""
SELECT symbol, date, {r('bullishness')} AS bullishness FROM sent"""))
def q_bullishness(spark, d):
    return _sent(spark, d).select("symbol", "date", "bullishness")


@register("message_volume", "N02", study_sql(f"""
SELECT symbol, date, {r('msg_volume')} AS msg_volume FROM sent"""))
def q_message_volume(spark, d):
    return _sent(spark, d).select("symbol", "date", "msg_volume")


@register("agreement", "N03", study_sql(f"""
SELECT symbol, date, {r('agreement')} AS agreement FROM sent"""))
def q_agreement(spark, d):
    return _sent(spark, d).select("symbol", "date", "agreement")


@register("gk_volatility", "N04", study_sql(f"""
SELECT symbol, date, {r('volatility')} AS volatility FROM mkt"""))
def q_gk_volatility(spark, d):
    return E.market_measures(V.bars_v(spark, d)).select("symbol", "date", "volatility")


@register("log_volume", "N05", study_sql(f"""
SELECT symbol, date, {r('log_trading_vol')} AS log_trading_vol FROM mkt"""))
def q_log_volume(spark, d):
    return E.market_measures(V.bars_v(spark, d)).select("symbol", "date", "log_trading_vol")


@register("log_return", "WF2", study_sql(f"""
SELECT symbol, date, {r('return')} AS return FROM mkt"""))
def q_log_return(spark, d):
    """(ln C_t - ln C_t-1) x 100 per symbol; first day NULL."""
    return E.market_measures(V.bars_v(spark, d)).select("symbol", "date", "return")


_CARRIED_SQL = f"""
SELECT symbol, date, {r('carried_bullishness')} AS carried_bullishness,
       {r('carried_agreement')} AS carried_agreement,
       {r('carried_msg_volume')} AS carried_msg_volume, carried_pos, carried_neg
FROM carried"""


@register("carried_features", "WF3", study_sql(_CARRIED_SQL))
def q_carried_features(spark, d):
    """Lag-1 sentiment over the joined trading days (before dropping NULL rows)."""
    return _carried(V.bars_v(spark, d), V.label_corpus_v(spark, d))


def _carried(bars, corpus):
    j = E.market_measures(bars).join(E.daily_sentiment(corpus), ["symbol", "date"])
    w = Window.partitionBy("symbol").orderBy("date")
    return j.select("symbol", "date", *[F.lag(c).over(w).alias(f"carried_{c}") for c in E.CARRIED])


_PANEL_COLS = ("symbol, date, {open}, {high}, {low}, {close}, volume, {ret}, {ltv}, {vol}, pos, neg, "
               "NEUTRAL, {b}, {mv}, {ag}, {cb}, {ca}, {cm}, carried_pos, carried_neg")


@register("daily_panel", "N10 D01 J04", study_sql("SELECT " + _PANEL_COLS.format(
    open=r("open") + " AS open", high=r("high") + " AS high", low=r("low") + " AS low",
    close=r("close") + " AS close", ret=r("return") + " AS return",
    ltv=r("log_trading_vol") + " AS log_trading_vol", vol=r("volatility") + " AS volatility",
    b=r("bullishness") + " AS bullishness", mv=r("msg_volume") + " AS msg_volume",
    ag=r("agreement") + " AS agreement", cb=r("carried_bullishness") + " AS carried_bullishness",
    ca=r("carried_agreement") + " AS carried_agreement",
    cm=r("carried_msg_volume") + " AS carried_msg_volume") + " FROM panel"))
def q_daily_panel(spark, d):
    """Aligned daily panel: market x sentiment, carried features, complete rows only."""
    p = _panel(spark, d)
    return p.select("symbol", "date", "open", "high", "low", "close", "volume", "return",
                    "log_trading_vol", "volatility", "pos", "neg", "NEUTRAL", "bullishness",
                    "msg_volume", "agreement", "carried_bullishness", "carried_agreement",
                    "carried_msg_volume", "carried_pos", "carried_neg")


_CORR_SQL = study_sql("\nUNION ALL\n".join(
    f"SELECT symbol, '{a}' AS row, '{b}' AS col, {r(f'corr({a}, {b})')} AS r FROM panel GROUP BY symbol"
    for a in E.SENTIMENT_COLS for b in E.MARKET_COLS))


@register("corr_matrix", "A10", _CORR_SQL)
def q_corr_matrix(spark, d):
    """Sentiment x market block of the panel's correlation matrix (long form)."""
    p = _panel(spark, d)
    return A.corr_block(p, E.SENTIMENT_COLS, E.MARKET_COLS, group_cols=("symbol",))


_SPLIT_SQL = """
SELECT symbol, date, CASE WHEN row_number() OVER (PARTITION BY symbol ORDER BY date)
                               <= floor(count(*) OVER (PARTITION BY symbol) * 0.75)
                          THEN 'train' ELSE 'test' END AS split
FROM panel"""


@register("chrono_split", "WF6", study_sql(_SPLIT_SQL))
def q_chrono_split(spark, d):
    """First 75% of each symbol's panel rows (by date) train, the rest test."""
    return E.chrono_split(_panel(spark, d)).select("symbol", "date", "split")


_PERSIST = """scored AS (
  SELECT symbol, date, return AS y, lag(return) OVER (PARTITION BY symbol ORDER BY date) AS yhat,
         CASE WHEN row_number() OVER (PARTITION BY symbol ORDER BY date)
                   <= floor(count(*) OVER (PARTITION BY symbol) * 0.75)
              THEN 'train' ELSE 'test' END AS split
  FROM panel)"""


def _persistence(panel):
    """Test rows with the previous day's return as the forecast."""
    w = Window.partitionBy("symbol").orderBy("date")
    s = E.chrono_split(panel).withColumn("y", F.col("return")).withColumn("yhat", F.lag("return").over(w))
    return s.filter((F.col("split") == "test") & F.col("yhat").isNotNull())


_R2_SQL = f""", {_PERSIST}
SELECT symbol, {r('1 - sum((y - yhat) * (y - yhat)) / (var_pop(y) * count(y))')} AS r2
FROM scored WHERE split = 'test' AND yhat IS NOT NULL GROUP BY symbol"""


@register("r2_score", "N08", study_sql(_R2_SQL))
def q_r2_score(spark, d):
    """R^2 of a given forecast (previous day's return) on the test part."""
    return _persistence(_panel(spark, d)).groupBy("symbol").agg(E.r2_score("y", "yhat").alias("r2"))


_DIR_SQL = f""", {_PERSIST}
SELECT symbol, {r('avg(CASE WHEN sign(y) = sign(yhat) THEN 1.0 ELSE 0.0 END)')} AS dir_acc
FROM scored WHERE split = 'test' AND yhat IS NOT NULL GROUP BY symbol"""


@register("directional_accuracy", "N09", study_sql(_DIR_SQL))
def q_directional_accuracy(spark, d):
    """Share of test days whose forecast sign equals the realised sign."""
    return _persistence(_panel(spark, d)).groupBy("symbol").agg(E.directional_accuracy("y", "yhat").alias("dir_acc"))


_OLS_FEATURES = ["carried_bullishness", "carried_agreement", "carried_msg_volume",
                 "carried_pos", "carried_neg"]


def _residuals(source: str, ys: list[str], xs: list[str], fit: str, keep: str, by: str = "symbol") -> str:
    """SQL text of CTEs ``s0 .. s<len(xs)>``: columns ``ys`` of ``source``, freed of the regressors ``xs`` one after
    the other by slopes (covariance over variance) on the rows where ``fit`` holds, per ``by``."""
    over = f"FILTER (WHERE {fit}) OVER (PARTITION BY {by})"
    cols = [*ys, *xs]
    ctes = ["s0 AS (SELECT " + keep + ", " + ", ".join(f"{c} - avg({c}) {over} AS {c}" for c in cols) + f" FROM {source})"]
    for k, x in enumerate(xs):
        left = [*ys, *xs[k + 1:]]
        ctes.append(f"s{k + 1} AS (SELECT {keep}, " + ", ".join(
            f"{c} - {x} * coalesce(covar_pop({c}, {x}) {over} / nullif(var_pop({x}) {over}, 0), 0) AS {c}" for c in left)
            + f" FROM s{k})")
    return ",\n".join(ctes)


_OLS_SQL = f""", parted AS (
  SELECT *, return AS y, CASE WHEN row_number() OVER (PARTITION BY symbol ORDER BY date)
                   <= floor(count(*) OVER (PARTITION BY symbol) * 0.75) THEN 'train' ELSE 'test' END AS split
  FROM panel),
{_residuals("parted", ["y"], _OLS_FEATURES, "split = 'train'", "symbol, split, return")}
SELECT symbol, count(*) AS n_test, {r('1 - sum(y * y) / (var_pop(return) * count(*))')} AS r2,
       {r('avg(CASE WHEN sign(return) = sign(return - y) THEN 1.0 ELSE 0.0 END)')} AS dir_acc
FROM s5 WHERE split = 'test' GROUP BY symbol"""


@register("ols_fit_predict", "N07 N08 N09 WF6", study_sql(_OLS_SQL))
def q_ols_fit_predict(spark, d):
    """OLS of return on the five carried features, fit on each symbol's first
    75 %, evaluated (R^2, directional accuracy) on the rest."""
    return _fit_predict(_once(_panel(spark, d)))


def _once(panel):
    """The panel as a table (a row a day and series): fit and prediction both read it."""
    spark = panel.sparkSession
    path = scratch_path(spark, "panel")
    panel.write.mode("overwrite").parquet(path)
    return spark.read.schema(panel.schema).parquet(path)


def _fit_predict(panel):
    p = E.chrono_split(panel)
    coefs = E.ols_by_group(p.filter(F.col("split") == "train"), ["symbol"], _OLS_FEATURES, "return")
    test = E.predict(p.filter(F.col("split") == "test"), coefs, ["symbol"], _OLS_FEATURES)
    return test.groupBy("symbol").agg(F.count("*").alias("n_test"),
                                      E.r2_score("return", "prediction").alias("r2"),
                                      E.directional_accuracy("return", "prediction").alias("dir_acc"))


_LAGS = range(1, 6)
_SLOTS = [f"{z}{i}" for z in "yx" for i in _LAGS]
#: Regressors a row (own lags, then the feature's; those beyond the tested lag are 0), freed one after the other: the
#: residuals after the own lags give the restricted fit, after all the full one. The p-value is the upper tail of the
#: chi-square law, one less the series of the lower incomplete gamma function.
_GRANGER_SQL = f""", lagged AS (
  SELECT symbol, row_number() OVER w AS rn, return AS y0, {", ".join(f"lag(return, {i}) OVER w AS r{i}" for i in _LAGS)},
         {", ".join(f"lag({f}, {i}) OVER w AS {f}{i}" for f in E.GRANGER_FEATURES for i in _LAGS)}
  FROM panel WINDOW w AS (PARTITION BY symbol ORDER BY date)),
slots AS (
  SELECT symbol, feature, lag, y0 AS y, {", ".join(f"CASE WHEN lag >= {i} THEN r{i} ELSE 0.0 END AS y{i}" for i in _LAGS)},
         {", ".join(f"CASE WHEN lag < {i} THEN 0.0 " + " ".join(f"WHEN feature = '{f}' THEN {f}{i}" for f in E.GRANGER_FEATURES) + f" END AS x{i}" for i in _LAGS)}
  FROM lagged, (VALUES {", ".join(f"('{f}')" for f in E.GRANGER_FEATURES)}) f(feature), range(1, 6) l(lag) WHERE rn > lag),
{_residuals("slots", ["y"], _SLOTS, "true", "symbol, feature, lag", "symbol, feature, lag")},
own AS (SELECT symbol, feature, lag, sum(y * y) AS ssr FROM s5 GROUP BY ALL),
whole AS (SELECT symbol, feature, lag, count(*) AS n, sum(y * y) AS ssr FROM s10 GROUP BY ALL),
tested AS (
  SELECT symbol, feature, lag, n, o.ssr AS ssr_r, w.ssr AS ssr_u, CASE WHEN w.ssr > 0 THEN n * (o.ssr - w.ssr) / w.ssr END AS chi2
  FROM own o JOIN whole w USING (symbol, feature, lag))
SELECT symbol, feature, CAST(lag AS INTEGER) AS lag, n AS n_obs, {r('round(ssr_r, 2)')} AS ssr_restricted, {r('round(ssr_u, 2)')} AS ssr_full,
       {r('chi2')} AS chi2, {r("""CASE WHEN chi2 IS NULL THEN NULL WHEN chi2 <= 0 THEN 1.0 ELSE greatest(0.0, 1 - list_sum(list_transform(
         range(0, 600), lambda i: exp(-chi2 / 2 + (lag / 2.0 + i) * ln(chi2 / 2) - lgamma(lag / 2.0 + i + 1))))) END""")} AS p_value
FROM tested"""


def _granger(panel):
    """Sums of squares reach 1e8 here, so they are compared to two places."""
    return E.granger_pvalues(panel).withColumns({c: F.round(c, 2) for c in ("ssr_restricted", "ssr_full")})


@register("granger_pvalues", "N06 WF5", study_sql(_GRANGER_SQL))
def q_granger_pvalues(spark, d):
    """Granger (ssr chi-square) p-values of bullishness / agreement / msg_volume
    -> return, lags 1..5, per symbol."""
    return _granger(_panel(spark, d))


@register("udaf_agreement", "A13 F03", study_sql(f"""
SELECT symbol, {r('ln((1 + sum(pos)) / (1 + sum(neg)))')} AS bullishness,
       {r('CASE WHEN sum(pos) + sum(neg) = 0 THEN NULL ELSE 1 - sqrt(1 - power((sum(pos) - sum(neg)) / (sum(pos) + sum(neg)), 2)) END')} AS agreement
FROM daily GROUP BY symbol"""))
def q_udaf_agreement(spark, d):
    """Bullishness and agreement as reusable aggregates over labelled rows."""
    c = V.label_corpus_v(spark, d).withColumnRenamed("pred_label", "sentiment_label")
    return c.groupBy("symbol").agg(A.bullishness_agg().alias("bullishness"),
                                   A.agreement_agg().alias("agreement"))



# ---------------------------------------------------------------- five series (by order priority)
_MULTI_VIEWS = """bars_v AS (
  SELECT o_orderpriority AS symbol, CAST(o_orderdate AS DATE) AS date,
         arg_min(o_totalprice, o_orderkey) AS open, max(o_totalprice) AS high,
         min(o_totalprice) AS low, arg_max(o_totalprice, o_orderkey) AS close,
         count(*) * 100 AS volume
  FROM orders GROUP BY 1, 2),
label_corpus_v AS (
  SELECT CAST(l_shipdate AS TIMESTAMP) AS created_at,
         CASE l_returnflag WHEN 'A' THEN 'BULLISH' WHEN 'R' THEN 'BEARISH'
                           WHEN 'N' THEN 'NEUTRAL' END AS pred_label,
         o_orderpriority AS symbol
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def multi_sql(body: str) -> str:
    return "WITH " + _MULTI_VIEWS + ",\n" + _SENT + "\n" + body


def _panel_multi(spark, d):
    return E.daily_panel(V.bars_by_priority_v(spark, d), V.label_corpus_by_priority_v(spark, d))


@register("daily_panel_multi", "N10 D01 J04", multi_sql("SELECT " + _PANEL_COLS.format(
    open=r("open") + " AS open", high=r("high") + " AS high", low=r("low") + " AS low",
    close=r("close") + " AS close", ret=r("return") + " AS return",
    ltv=r("log_trading_vol") + " AS log_trading_vol", vol=r("volatility") + " AS volatility",
    b=r("bullishness") + " AS bullishness", mv=r("msg_volume") + " AS msg_volume",
    ag=r("agreement") + " AS agreement", cb=r("carried_bullishness") + " AS carried_bullishness",
    ca=r("carried_agreement") + " AS carried_agreement",
    cm=r("carried_msg_volume") + " AS carried_msg_volume") + " FROM panel"))
def q_daily_panel_multi(spark, d):
    """The aligned daily panel for five series at once (windows per series)."""
    p = _panel_multi(spark, d)
    return p.select("symbol", "date", "open", "high", "low", "close", "volume", "return",
                    "log_trading_vol", "volatility", "pos", "neg", "NEUTRAL", "bullishness",
                    "msg_volume", "agreement", "carried_bullishness", "carried_agreement",
                    "carried_msg_volume", "carried_pos", "carried_neg")


@register("corr_matrix_multi", "A10", multi_sql("\nUNION ALL\n".join(
    f"SELECT symbol, '{a}' AS row, '{b}' AS col, {r(f'corr({a}, {b})')} AS r FROM panel GROUP BY symbol"
    for a in E.SENTIMENT_COLS for b in E.MARKET_COLS)))
def q_corr_matrix_multi(spark, d):
    """Sentiment x market correlation block of each of the five series, one pass."""
    return A.corr_block(_panel_multi(spark, d), E.SENTIMENT_COLS, E.MARKET_COLS, group_cols=("symbol",))


@register("granger_pvalues_multi", "N06 WF5", multi_sql(_GRANGER_SQL))
def q_granger_pvalues_multi(spark, d):
    """Granger p-values for every series, feature and lag in one aggregation."""
    return _granger(_panel_multi(spark, d))


@register("ols_fit_predict_multi", "N07 N08 N09 WF6", multi_sql(_OLS_SQL))
def q_ols_fit_predict_multi(spark, d):
    """Per-series OLS fit on the first 75 %, R^2 and directional accuracy on the rest."""
    return _fit_predict(_once(_panel_multi(spark, d)))


@register("log_return_multi", "WF2", multi_sql(f"""
SELECT symbol, date, {r('return')} AS return FROM mkt"""))
def q_log_return_multi(spark, d):
    """Log returns of the five series."""
    return E.market_measures(V.bars_by_priority_v(spark, d)).select("symbol", "date", "return")


@register("carried_features_multi", "WF3", multi_sql(_CARRIED_SQL))
def q_carried_features_multi(spark, d):
    """Lag-1 sentiment of the five series."""
    return _carried(V.bars_by_priority_v(spark, d), V.label_corpus_by_priority_v(spark, d))


@register("chrono_split_multi", "WF6", multi_sql(_SPLIT_SQL))
def q_chrono_split_multi(spark, d):
    """Chronological split of each of the five series."""
    return E.chrono_split(_panel_multi(spark, d)).select("symbol", "date", "split")


@register("r2_score_multi", "N08", multi_sql(_R2_SQL))
def q_r2_score_multi(spark, d):
    """R^2 of the previous day's return as a forecast, per series."""
    return _persistence(_panel_multi(spark, d)).groupBy("symbol").agg(E.r2_score("y", "yhat").alias("r2"))


@register("directional_accuracy_multi", "N09", multi_sql(_DIR_SQL))
def q_directional_accuracy_multi(spark, d):
    """Directional accuracy of the previous day's return as a forecast, per series."""
    return _persistence(_panel_multi(spark, d)).groupBy("symbol").agg(
        E.directional_accuracy("y", "yhat").alias("dir_acc"))

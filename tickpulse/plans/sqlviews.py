"""DuckDB SQL text of the domain views (twins of ``sources.testviews``)."""

from __future__ import annotations

_TEXT = "('$' || upper(event_type) || ' ' || props)"
_CREATED = "strftime(ts, '%Y-%m-%d %H:%M:%S.%f')"
_SCORE = "((value - 25.0) / (value + 25.0))"

VIEWS: dict[str, str] = {
    "tweets_v": f"""
        SELECT * FROM (
          SELECT {_CREATED} AS created_at,
                 {_TEXT} AS text,
                 CAST(ts AS TIMESTAMP) AS api_timestamp,
                 regexp_extract({_TEXT}, '\\$([A-Z]+)', 1) AS symbol,
                 CASE WHEN {_SCORE} >= 0.05 THEN 'BULLISH'
                      WHEN {_SCORE} <= -0.05 THEN 'BEARISH'
                      WHEN {_SCORE} IS NOT NULL THEN 'NEUTRAL' END AS sentiment_label,
                 {_SCORE} AS sentiment_score,
                 CAST(event_id AS VARCHAR) AS uuid,
                 sha256(concat_ws('|', {_CREATED}, {_TEXT})) AS id,
                 CAST(ts AS TIMESTAMP) AS ingest_timestamp,
                 regexp_extract({_TEXT}, '\\$([A-Z]+)', 1) AS topic,
                 'twitter_user' AS author,
                 event_id
          FROM events) t
        WHERE symbol IS NOT NULL AND symbol <> ''""",
    "prices_v": """
        SELECT CAST(user_id AS VARCHAR) AS symbol,
               CAST(ts AS TIMESTAMP) AS trade_timestamp,
               value + 1.0 AS open_price, value + 1.0 AS high_price,
               value + 1.0 AS low_price, value + 1.0 AS close_price,
               CAST(json_extract_string(props, '$.k') AS BIGINT) + 1 AS volume,
               event_id
        FROM events WHERE event_type = 'purchase'""",
    "tweets_by_user_v": f"""
        SELECT CAST(event_id AS VARCHAR) AS uuid,
               CAST(user_id AS VARCHAR) AS symbol,
               CAST(user_id AS VARCHAR) AS topic,
               {_SCORE} AS sentiment_score,
               CAST(ts AS TIMESTAMP) AS api_timestamp,
               CAST(ts AS TIMESTAMP) AS ingest_timestamp
        FROM events WHERE event_type = 'view'""",
    "user_events_v": """
        SELECT CAST(event_id AS VARCHAR) AS uuid, CAST(user_id AS VARCHAR) AS symbol, event_id, event_type,
               CAST(json_extract_string(props, '$.k') AS BIGINT) + 1 AS volume
        FROM events""",
    "bars_v": """
        SELECT 'IDX' AS symbol, CAST(o_orderdate AS DATE) AS date,
               arg_min(o_totalprice, o_orderkey) AS open,
               max(o_totalprice) AS high, min(o_totalprice) AS low,
               arg_max(o_totalprice, o_orderkey) AS close,
               count(*) * 100 AS volume
        FROM orders GROUP BY CAST(o_orderdate AS DATE)""",
    "label_corpus_v": """
        SELECT CAST(l_shipdate AS TIMESTAMP) AS created_at,
               CASE l_returnflag WHEN 'A' THEN 'BULLISH' WHEN 'R' THEN 'BEARISH'
                                 WHEN 'N' THEN 'NEUTRAL' END AS pred_label,
               'IDX' AS symbol
        FROM lineitem""",
    "stock_info_v": """
        SELECT CAST(c_custkey AS VARCHAR) AS symbol, c_name AS company_name,
               c_mktsegment AS sector
        FROM customer""",
    "logits_v": """
        SELECT vec_id, [list_sum(list_filter(CAST(embedding AS DOUBLE[]), lambda x, i: (i - 1) % 3 = 0)),
                        list_sum(list_filter(CAST(embedding AS DOUBLE[]), lambda x, i: (i - 1) % 3 = 1)),
                        list_sum(list_filter(CAST(embedding AS DOUBLE[]), lambda x, i: (i - 1) % 3 = 2))] AS logits
        FROM embeddings""",
}


def with_views(names: list[str] | tuple[str, ...], body: str, extra: str = "") -> str:
    """``WITH v1 AS (...), v2 AS (...)[, extra] body``."""
    parts = [f"{n} AS ({VIEWS[n]})" for n in names]
    if extra:
        parts.append(extra)
    return "WITH " + ",\n".join(parts) + "\n" + body

"""The stand-in tables in SQL, written apart from the Spark definitions."""

from __future__ import annotations

import re

from .tables import LEXICON

_WORDS = ", ".join(f"('{w}', CAST({v} AS DOUBLE))" for w, v in LEXICON.items())

#: name -> (tables it needs, SELECT)
CTES: dict[str, tuple[list[str], str]] = {
    "ticks": ([], """
        SELECT ts AS event_time, event_id AS trade_id, event_type AS symbol, value AS price,
               CAST(json_extract_string(props, '$.k') AS DOUBLE) AS quantity FROM events"""),
    "stepped": (["ticks"], """
        SELECT *, time_bucket(INTERVAL '6 hours', event_time) AS window_start,
               lag(price) OVER (PARTITION BY symbol, time_bucket(INTERVAL '6 hours', event_time)
                                ORDER BY event_time, trade_id) AS prior FROM ticks"""),
    "bars": (["stepped"], """
        SELECT symbol, window_start, window_start + INTERVAL 6 HOUR AS window_end,
               arg_min(price, (event_time, trade_id)) AS open, max(price) AS high, min(price) AS low,
               arg_max(price, (event_time, trade_id)) AS close, sum(quantity) AS volume,
               count(*) AS trade_count,
               stddev_pop(CASE WHEN prior <> 0 THEN (price - prior) / prior END) AS volatility
        FROM stepped GROUP BY symbol, window_start"""),
    "rets": (["bars"], """
        SELECT *, (close - lag(close) OVER w) / nullif(lag(close) OVER w, 0) AS ret
        FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY window_start)"""),
    "feats": (["rets"], """
        SELECT *, stddev_samp(ret) OVER (w ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS rolling_vol,
               count(ret) OVER (w ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS n_ret,
               (high - low) / nullif(close, 0) AS price_range_ratio,
               avg(volume) OVER (w ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS mean_volume,
               count(volume) OVER (w ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS n_volume,
               volume / nullif(avg(volume) OVER (w ROWS BETWEEN 9 PRECEDING AND CURRENT ROW), 0) AS vol_ratio,
               stddev_samp(ret) OVER (w ROWS BETWEEN 1 FOLLOWING AND 5 FOLLOWING) AS target_vol
        FROM rets WINDOW w AS (PARTITION BY symbol ORDER BY window_start)"""),
    "first_posts": ([], """
        SELECT e.ts AS created_at, d.doc_id AS id, d.text, d.lang, d.source AS keyword,
               json_extract_string(e.props, '$.k') AS likes
        FROM documents d JOIN events e ON e.event_id = (d.doc_id * 10) % (SELECT count(*) FROM events)"""),
    "raw_posts": (["first_posts"], """
        SELECT * FROM first_posts UNION ALL
        SELECT created_at + INTERVAL 1 HOUR, id, text, lang, keyword || '-again', likes
        FROM first_posts WHERE id % 20 = 0"""),
    "posts": (["raw_posts"], """
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY id ORDER BY created_at, keyword) AS rn FROM raw_posts)
        WHERE rn = 1"""),
    "lexicon": ([], f"SELECT * FROM (VALUES {_WORDS}) AS t(word, valence)"),
    "word_sums": (["posts", "lexicon"], r"""
        SELECT id, sum(valence) AS s FROM (
            SELECT id, unnest(string_split_regex(lower(text), '[^\p{L}]+')) AS word FROM posts) w
        JOIN lexicon USING (word) GROUP BY id"""),
    "scored": (["word_sums"], """
        SELECT p.id, p.created_at, p.lang, p.keyword, p.likes,
               round(coalesce(s, 0) / sqrt(coalesce(s, 0) * coalesce(s, 0) + 15), 4) AS compound
        FROM posts p LEFT JOIN word_sums USING (id)"""),
    "all_slots": (["scored"], """
        SELECT window_start, window_start + INTERVAL 12 HOUR AS window_end,
               fourths(s, n) AS compound_score, fourths(pos * 10000, n) AS positive_ratio,
               fourths(neg * 10000, n) AS negative_ratio, fourths((n - pos - neg) * 10000, n) AS neutral_ratio,
               fourths(sw, w) AS weighted_compound, n AS post_count,
               CASE WHEN n < 16 THEN 'low_sample' ELSE 'ok' END AS data_quality
        FROM (SELECT window_start, count(*) AS n, CAST(sum(units) AS BIGINT) AS s, CAST(sum(units * w) AS BIGINT) AS sw,
                     CAST(sum(w) AS BIGINT) AS w, CAST(count(CASE WHEN compound > 0.05 THEN 1 END) AS BIGINT) AS pos,
                     CAST(count(CASE WHEN compound < -0.05 THEN 1 END) AS BIGINT) AS neg
              FROM (SELECT *, time_bucket(INTERVAL '12 hours', created_at) AS window_start,
                           CAST(round(compound * 10000) AS BIGINT) AS units,
                           CAST(greatest(coalesce(TRY_CAST(likes AS INTEGER), 1), 1) AS BIGINT) AS w FROM scored)
              GROUP BY window_start)"""),
    "slots": (["all_slots"], """
        SELECT * FROM all_slots
        WHERE (date_diff('day', DATE '1970-01-01', CAST(window_start AS DATE)) * 2
               + CASE WHEN hour(window_start) >= 12 THEN 1 ELSE 0 END) % 9 <> 0"""),
    "laid": (["bars", "slots"], """
        SELECT g.t, s.window_start AS slot_start, s.compound_score, s.positive_ratio, s.post_count
        FROM (SELECT unnest(generate_series((SELECT min(window_start) FROM bars),
                                            (SELECT max(window_start) FROM bars), INTERVAL 6 HOUR)) AS t) g
        LEFT JOIN slots s ON s.window_start <= g.t AND s.window_end > g.t"""),
    "filled": (["laid"], """
        SELECT t AS window_start, last_value(compound_score IGNORE NULLS) OVER w AS compound_score,
               last_value(positive_ratio IGNORE NULLS) OVER w AS positive_ratio,
               last_value(post_count IGNORE NULLS) OVER w AS post_count,
               last_value(slot_start IGNORE NULLS) OVER w AS last_sentiment_ts
        FROM laid WINDOW w AS (ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""),
    "highest": (["laid"], """
        SELECT t AS window_start, max(compound_score) OVER w AS compound_score,
               max(positive_ratio) OVER w AS positive_ratio, max(post_count) OVER w AS post_count,
               max(slot_start) OVER w AS last_sentiment_ts
        FROM laid WINDOW w AS (ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""),
    "features": (["feats", "filled"], """
        SELECT f.symbol, f.window_start, f.rolling_vol, f.price_range_ratio, f.vol_ratio, m.compound_score,
               m.positive_ratio, CAST(m.post_count AS DOUBLE) AS post_count,
               date_diff('second', m.last_sentiment_ts, f.window_start) / 60.0 AS minutes_since_sentiment,
               f.target_vol
        FROM feats f JOIN filled m USING (window_start)
        WHERE f.target_vol IS NOT NULL AND f.rolling_vol IS NOT NULL AND m.compound_score IS NOT NULL"""),
    "predictions": (["feats"], """
        SELECT symbol, window_start, rolling_vol AS predicted_vol, rolling_vol,
               'v' || CAST((hour(window_start) // 6) % 3 + 1 AS VARCHAR) AS model_version,
               CAST(trade_count % 66 + 15 AS INTEGER) AS inference_latency_ms
        FROM feats WHERE rolling_vol IS NOT NULL"""),
    "realized": (["predictions", "rets"], """
        SELECT p.symbol, p.window_start, stddev_samp(r.ret) AS actual_vol
        FROM predictions p JOIN rets r ON r.symbol = p.symbol AND r.window_start > p.window_start
             AND r.window_start <= p.window_start + INTERVAL 30 HOUR
        GROUP BY p.symbol, p.window_start"""),
    "evaluated": (["realized"], """
        SELECT p.symbol, p.window_start, p.predicted_vol, a.actual_vol, p.model_version
        FROM predictions p JOIN realized a USING (symbol, window_start) WHERE a.actual_vol IS NOT NULL"""),
    "logs": ([], """
        SELECT ts AS timestamp, 'svc' || CAST(user_id % 8 AS VARCHAR) AS service,
               CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'purchase' THEN 'WARNING' ELSE 'INFO' END AS level,
               props AS message, event_id AS log_id FROM events"""),
    "runs": ([], """
        SELECT o_orderkey AS run_id, o_orderpriority AS pipeline_name,
               CASE o_orderstatus WHEN 'O' THEN 'ok' WHEN 'F' THEN 'failed' ELSE 'promoted' END AS quality_status,
               CAST(trunc(o_totalprice) AS BIGINT) AS rows_processed, o_custkey % 50 AS rows_rejected,
               o_orderdate AS started_at,
               CASE WHEN o_orderkey % 41 <> 0 THEN o_orderdate + to_seconds(o_orderkey % 300) END AS finished_at,
               CAST(o_orderkey % 13 AS VARCHAR) AS checks_passed, CAST(o_custkey % 5 AS VARCHAR) AS checks_failed
        FROM orders"""),
    "containers": ([], """
        SELECT ts AS time, 'c' || CAST(user_id % 12 AS VARCHAR) AS container_name,
               least(value, 100.0) AS usage_percent,
               CASE event_type WHEN 'error' THEN 'exited' WHEN 'signup' THEN 'restarting' ELSE 'running' END AS status,
               event_id AS metric_id FROM events"""),
    "audit_old": ([], "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 10 <> 0"),
    "audit_new": ([], """
        SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice + 1 ELSE o_totalprice END
               AS o_totalprice FROM orders WHERE o_orderkey % 11 <> 0"""),
    "registry": ([], "SELECT p_partkey AS version, p_retailprice / 650000 AS mae FROM part"),
    "promoted": (["registry"], """
        SELECT *, mae < 0.0015 AND (champion_mae IS NULL OR mae < champion_mae) AS promoted FROM (
            SELECT version, mae, min(CASE WHEN mae < 0.0015 THEN mae END)
                   OVER (ORDER BY version ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS champion_mae
            FROM registry)"""),
    "edges": ([], """
        SELECT 'region' AS source_table, r_name AS source_column, 'nation' AS target_table, n_name AS target_column
        FROM nation JOIN region ON n_regionkey = r_regionkey"""),
    "sparse": ([], """
        SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, o_orderkey, o_orderstatus, o_totalprice,
               o_orderdate, o_orderpriority
        FROM customer LEFT JOIN (
            SELECT * REPLACE (CASE WHEN o_orderkey % 2 = 1 THEN o_totalprice END AS o_totalprice,
                              CASE WHEN o_orderkey % 20 <> 0 THEN o_orderpriority END AS o_orderpriority) FROM orders) o
            ON c_custkey = o_custkey"""),
}


# a / (b * 10000) rounded to four places, halves away from zero, in whole numbers
_FOURTHS = re.compile(r"fourths\((.+?), (\w+)\)")


def with_tables(names: str, select: str) -> str:
    """``select`` with the CTEs it names (blank-separated) and what those need."""
    order: list[str] = []

    def add(name: str) -> None:
        if name not in order:
            for need in CTES[name][0]:
                add(need)
            order.append(name)

    for name in names.split():
        add(name)
    text = "WITH " + ",\n".join(f"{n} AS ({CTES[n][1]})" for n in order) + "\n" + select
    return _FOURTHS.sub(r"(sign(\1) * ((2 * abs(\1) + \2) // (2 * \2)) / 10000.0)", text)

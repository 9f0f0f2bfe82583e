"""Independent DuckDB SQL for every registered query (same column names and types).

Written directly from the query's meaning (window membership by
``generate_series``, ``row_number`` for positions, plain SQL joins), not
from the Spark plans, so the two implementations check each other.
Times are epoch microseconds; ``//`` is integer division (inputs are
after 1970, so it floors).
"""

from __future__ import annotations

#: the cap of the registered click queries and its alert text, stated on their own
CAP = 2
ALERT = "点击超过2 次"

HOUR = 3_600_000_000
DAY = 86_400_000_000
CENTS = "CAST(round(value * 100) AS BIGINT)"


def _sliding_counts(key_expr: str, key: str, size: int, slide: int, source: str = "events",
                    t_expr: str = "epoch_us(ts)") -> str:
    return f"""
    e AS (SELECT {key_expr} AS {key}, {t_expr} AS t FROM {source}),
    s AS (SELECT {key}, unnest(generate_series(((t - {size}) // {slide}) * {slide} + {slide},
                                               (t // {slide}) * {slide}, {slide})) AS s
          FROM e),
    c AS (SELECT {key}, make_timestamp(s + {size}) AS window_end, count(*) AS n
          FROM s GROUP BY ALL)"""


def _tumbling(aggs: str, size: int, source: str = "events", ts: str = "ts") -> str:
    return f"""
    SELECT make_timestamp((epoch_us({ts}) // {size}) * {size}) AS window_start,
           make_timestamp((epoch_us({ts}) // {size}) * {size} + {size}) AS window_end,
           {aggs}
    FROM {source} GROUP BY ALL"""


_JOIN_INPUTS = """
    WITH l AS (SELECT doc_id AS id, CAST(quality AS VARCHAR) AS quality, toxic FROM labels),
         e AS (SELECT vec_id AS id, CAST(label AS VARCHAR) AS cluster FROM embeddings)"""

_FULL_JOIN = _JOIN_INPUTS + """,
    f AS (SELECT coalesce(l.id, e.id) AS id,
                 CASE WHEN l.id IS NULL THEN 'null' ELSE l.quality END AS quality, l.toxic,
                 CASE WHEN e.id IS NULL THEN 'null' ELSE e.cluster END AS cluster
          FROM l FULL JOIN e ON l.id = e.id)"""

_AD_LINES = """
    WITH lines AS (SELECT event_id, concat_ws(',', CAST(user_id AS VARCHAR),
                          CAST(event_id % 3 AS VARCHAR), event_type,
                          'city' || CAST(user_id % 5 AS VARCHAR),
                          CAST(epoch_us(ts) // 1000000 AS VARCHAR)) AS line FROM events),
    f AS (SELECT event_id, string_split(line, ',') AS p FROM lines),
    a AS (SELECT event_id, CAST(p[1] AS BIGINT) AS user_id, CAST(p[2] AS BIGINT) AS ad_id,
                 p[3] AS province, p[4] AS city,
                 make_timestamp(CAST(p[5] AS BIGINT) * 1000000) AS ts FROM f),
    r AS (SELECT *, make_timestamp((epoch_us(ts) // 86400000000) * 86400000000) AS period_start,
                 row_number() OVER (PARTITION BY user_id, ad_id, epoch_us(ts) // 86400000000
                                    ORDER BY ts, event_id) AS rk FROM a)"""

_CLICK_RANKS = """
    WITH r AS (SELECT event_id, user_id, event_type AS ad_id, ts,
                      make_timestamp((epoch_us(ts) // 86400000000) * 86400000000) AS period_start,
                      row_number() OVER (PARTITION BY user_id, event_type,
                                         epoch_us(ts) // 86400000000
                                         ORDER BY ts, event_id) AS rk
               FROM events)"""

SQL: dict[str, str] = {
    "sliding_count": "WITH" + _sliding_counts("event_type", "province", HOUR, 5_000_000)
    + " SELECT window_end, province, n FROM c",

    "sliding_count_expand": "WITH" + _sliding_counts("event_type", "province", HOUR, 300_000_000)
    + " SELECT window_end, province, n FROM c",

    "hot_pages": "WITH" + _sliding_counts("event_type", "url", 600_000_000, 5_000_000) + """,
    r AS (SELECT url, window_end, n,
                 row_number() OVER (PARTITION BY window_end ORDER BY n DESC, url ASC) AS rk
          FROM c)
    SELECT url, window_end, n FROM r WHERE rk <= 3""",

    "hot_pages_log": """WITH
    lines AS (SELECT concat_ws(' ', '10.0.0.1', CAST(user_id AS VARCHAR), '-',
                               strftime(ts, '%d/%m/%Y:%H:%M:%S'), '+0000', 'GET',
                               '/' || event_type) AS line FROM events),
    parsed AS (SELECT string_split(line, ' ') AS f FROM lines),""" + _sliding_counts(
        "trim(f[7])", "url", 600_000_000, 5_000_000, source="parsed",
        t_expr="epoch_us(strptime(trim(f[4]), '%d/%m/%Y:%H:%M:%S'))") + """,
    r AS (SELECT url, window_end, n,
                 row_number() OVER (PARTITION BY window_end ORDER BY n DESC, url ASC) AS rk
          FROM c)
    SELECT url, window_end, n FROM r WHERE rk <= 3""",

    "tumbling_sum": _tumbling(f"count(*) AS n, CAST(sum({CENTS}) AS BIGINT) AS total", HOUR),

    "tumbling_full": _tumbling(
        f"count(*) AS n, CAST(sum({CENTS}) AS BIGINT) AS total, "
        f"min({CENTS}) AS min_c, max({CENTS}) AS max_c", HOUR),

    "stream_observed_count": f"SELECT count(*) AS n, CAST(sum({CENTS}) AS BIGINT) AS total FROM events",

    # late: behind the last time of all other events, less the delay of the watermark
    "stream_late_rows": """WITH
    w AS (SELECT max(ts) - INTERVAL 10 SECOND AS mark FROM events WHERE event_id % 50 <> 0),
    e AS (SELECT event_id % 50 = 0 AND ts <= mark AS late FROM events, w)
    SELECT count(*) AS n_in, count(*) FILTER (NOT late) AS n_kept, count(*) FILTER (late) AS n_late
    FROM e""",

    "window_median": _tumbling(f"count(*) AS n, median({CENTS}) AS median", HOUR),

    # a rise ends before every value that is below its predecessor
    "window_digest": f"""WITH
    e AS (SELECT (epoch_us(ts) // {HOUR}) * {HOUR} AS w, event_id, {CENTS} AS c FROM events),
    r AS (SELECT *, row_number() OVER o AS rn, CASE WHEN c < lag(c) OVER o THEN 1 ELSE 0 END AS ends
          FROM e WINDOW o AS (PARTITION BY w ORDER BY event_id)),
    g AS (SELECT *, sum(ends) OVER (PARTITION BY w ORDER BY event_id) AS rise FROM r),
    l AS (SELECT w, max(len) AS longest_rise
          FROM (SELECT w, rise, count(*) AS len FROM g GROUP BY ALL) GROUP BY w)
    SELECT make_timestamp(w) AS window_start, make_timestamp(w + {HOUR}) AS window_end,
           count(*) AS n, arg_min(c, event_id) AS first_v, arg_max(c, event_id) AS last_v,
           CAST(sum(rn * c) AS BIGINT) AS checksum, any_value(longest_rise) AS longest_rise
    FROM r JOIN l USING (w) GROUP BY w""",

    "tumbling_avg": _tumbling(
        f"count(*) AS n, CAST(sum({CENTS}) AS DOUBLE) / count(*) AS avg", HOUR),

    "order_amount": _tumbling(
        "count(*) AS n_orders, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT)"
        " AS amount", DAY, source="orders", ts="o_orderdate"),

    "word_count": r"""
    WITH lines AS (
        SELECT unnest(CASE WHEN text = '' THEN []::VARCHAR[]
                           ELSE string_split_regex(regexp_replace(text, '\r?\n\z', ''), '\r?\n') END)
               AS line
        FROM documents),
    w AS (
        SELECT unnest(CASE WHEN line = '' THEN ['']
                           WHEN regexp_replace(line, ',+\z', '') = '' THEN []::VARCHAR[]
                           ELSE string_split(regexp_replace(line, ',+\z', ''), ',') END) AS word
        FROM lines)
    SELECT word, count(*) AS n FROM w GROUP BY word""",

    "running_word_count": r"""
    WITH d AS (
        SELECT doc_id, CASE WHEN text = '' THEN []::VARCHAR[]
                            ELSE string_split_regex(regexp_replace(text, '\r?\n\z', ''), '\r?\n') END AS ls
        FROM documents),
    l AS (SELECT doc_id, unnest(ls) AS line, CAST(generate_subscripts(ls, 1) - 1 AS BIGINT) AS line_no
          FROM d),
    a AS (SELECT doc_id, line_no,
                 CASE WHEN line = '' THEN ['']
                      WHEN regexp_replace(line, ',+\z', '') = '' THEN []::VARCHAR[]
                      ELSE string_split(regexp_replace(line, ',+\z', ''), ',') END AS ws
          FROM l),
    w AS (SELECT doc_id, line_no, unnest(ws) AS word,
                 CAST(generate_subscripts(ws, 1) - 1 AS BIGINT) AS pos FROM a)
    SELECT doc_id, line_no, pos, word,
           row_number() OVER (PARTITION BY word ORDER BY doc_id, line_no, pos) AS n
    FROM w""",

    "running_count": """
    SELECT event_id, event_type,
           count(*) OVER (PARTITION BY event_type ORDER BY event_id
                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running
    FROM events""",

    "count_window_avg": f"""
    WITH r AS (SELECT user_id, {CENTS} AS c,
                      row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn
               FROM events),
    g AS (SELECT user_id, CAST((rn - 1) // 3 + 1 AS BIGINT) AS window_no, count(*) AS n,
                 CAST(sum(c) AS BIGINT) AS total
          FROM r GROUP BY ALL HAVING count(*) = 3)
    SELECT user_id, window_no, n, total, CAST(total AS DOUBLE) / n AS avg FROM g""",

    "count_window_sliding": f"""
    WITH b AS (SELECT user_id, event_id, {CENTS} AS c FROM events),
    r AS (SELECT user_id,
                 row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn,
                 count(*) OVER (PARTITION BY user_id ORDER BY event_id
                                ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS n,
                 CAST(sum(c) OVER (PARTITION BY user_id ORDER BY event_id
                                   ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS BIGINT) AS total
          FROM b)
    SELECT user_id, rn, n, total FROM r WHERE rn % 2 = 0""",

    "join_inner": _JOIN_INPUTS + """
    SELECT l.id, quality, toxic, cluster FROM l JOIN e ON l.id = e.id""",

    "join_left": _JOIN_INPUTS + """
    SELECT l.id, quality, toxic, CASE WHEN e.id IS NULL THEN 'null' ELSE cluster END AS cluster
    FROM l LEFT JOIN e ON l.id = e.id""",

    "join_right": _JOIN_INPUTS + """
    SELECT e.id, CASE WHEN l.id IS NULL THEN 'null' ELSE quality END AS quality, toxic, cluster
    FROM l RIGHT JOIN e ON l.id = e.id""",

    "join_full": _FULL_JOIN + " SELECT id, quality, toxic, cluster FROM f",

    "text_lines_written": _FULL_JOIN + """
    SELECT concat_ws(',', coalesce(CAST(id AS VARCHAR), 'null'), coalesce(quality, 'null'),
                     coalesce(CAST(toxic AS VARCHAR), 'null'), coalesce(cluster, 'null')) AS value
    FROM f""",

    "broadcast_lookup": """
    WITH s AS (SELECT user_id, count(*) AS n_events FROM events GROUP BY user_id)
    SELECT c_custkey, c_name, c_nationkey,
           CASE WHEN s.user_id IS NULL THEN 0 ELSE s.n_events END AS n_events
    FROM customer LEFT JOIN s ON customer.c_custkey = s.user_id""",

    "mapped_patterns": r"""
    SELECT doc_id, CAST(len(regexp_extract_all(coalesce(text, ''), '[0-9]+')) AS BIGINT) AS n_numbers,
           CAST(len(regexp_extract_all(coalesce(text, ''), '[A-Z][a-z]+')) AS BIGINT) AS n_names,
           CAST(len(regexp_extract_all(coalesce(text, ''), '[a-z] ?, ?[a-z]')) AS BIGINT) AS n_commas
    FROM documents""",

    "parsed_ints": f"""
    SELECT CAST({CENTS} AS INTEGER) AS v, count(*) AS n FROM events GROUP BY ALL""",

    "parsed_key_values": """
    SELECT CAST(user_id AS VARCHAR) AS k, event_type AS v, count(*) AS n FROM events GROUP BY ALL""",

    "parsed_ad_clicks": _AD_LINES + """
    SELECT event_id, user_id, ad_id, province, city, ts FROM a""",

    "parsed_orders": """
    SELECT o_orderkey AS order_id, CAST(round(o_totalprice * 100) AS BIGINT) AS amount,
           CAST(length(o_orderpriority) AS INTEGER) AS category, o_custkey AS user_id,
           o_orderpriority AS channel,
           CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_orderkey END AS payment_ref,
           CAST(o_orderdate AS TIMESTAMP) AS create_time, CAST(o_orderdate AS TIMESTAMP) AS end_time
    FROM orders""",

    "window_join": f"""
    WITH cl AS (SELECT user_id AS k, (epoch_us(ts) // {HOUR}) * {HOUR} AS w, event_id AS v1
                FROM events WHERE event_type = 'click'),
         pu AS (SELECT user_id AS k, (epoch_us(ts) // {HOUR}) * {HOUR} AS w, event_id AS v2
                FROM events WHERE event_type = 'purchase')
    SELECT cl.k, make_timestamp(cl.w) AS window_start,
           make_timestamp(cl.w + {HOUR}) AS window_end, v1, v2
    FROM cl JOIN pu ON cl.k = pu.k AND cl.w = pu.w""",

    "first_n": """
    SELECT o_orderkey, o_custkey, o_orderstatus FROM orders ORDER BY o_orderkey LIMIT 3""",

    "group_first_n": """
    SELECT o_custkey, o_orderkey, o_orderstatus FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rk
        FROM orders) WHERE rk <= 2""",

    "group_sorted_first": """
    SELECT o_custkey, o_orderkey, o_totalprice FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey
                                     ORDER BY o_totalprice, o_orderkey) AS rk
        FROM orders) WHERE rk <= 1""",

    "sort_limit": """
    SELECT o_custkey, o_totalprice, o_orderkey FROM orders
    ORDER BY o_custkey ASC, o_totalprice DESC, o_orderkey ASC LIMIT 3""",

    "blacklist_pass": _CLICK_RANKS + f"""
    SELECT event_id, user_id, ad_id, ts FROM r WHERE rk <= {CAP}""",

    "blacklist_alerts": _CLICK_RANKS + f"""
    SELECT user_id, ad_id, period_start, '{ALERT}' AS message
    FROM r WHERE rk = {CAP + 1}""",

    "ad_click_count": _AD_LINES + f""",
    s AS (SELECT province,
                 unnest(generate_series(((epoch_us(ts) - {HOUR}) // 5000000) * 5000000 + 5000000,
                                        (epoch_us(ts) // 5000000) * 5000000, 5000000)) AS s
          FROM r WHERE rk <= {CAP})
    SELECT make_timestamp(s + {HOUR}) AS window_end, province, count(*) AS n
    FROM s GROUP BY ALL""",

    "ad_click_alerts": _AD_LINES + f"""
    SELECT user_id, ad_id, period_start, '{ALERT}' AS message FROM r WHERE rk = {CAP + 1}""",

    "stream_hot_pages": "WITH" + _sliding_counts("event_type", "url", 600_000_000, 60_000_000) + """,
    r AS (SELECT url, window_end, n,
                 row_number() OVER (PARTITION BY window_end ORDER BY n DESC, url ASC) AS rk
          FROM c)
    SELECT url, window_end, n FROM r WHERE rk <= 3""",

    "next_midnight": f"""
    SELECT event_id, ts, make_timestamp((epoch_us(ts) // {DAY} + 1) * {DAY}) AS next_midnight
    FROM events""",

    "observed_count": "SELECT count(*) AS n FROM lineitem",
}

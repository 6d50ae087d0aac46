"""The same results in SQL, written independently of the library (window functions, plain joins)."""

from __future__ import annotations

from . import inputs as I

_PAGES = f"WITH pages AS ({I.PAGES_SQL}), "


def _bounds(start: str, size: str, date: str = "start") -> str:
    at = start if date == "start" else f"{start} + INTERVAL {size}"
    return (f"strftime({start}, '%Y-%m-%d %H:%M:%S') AS \"startTime\", "
            f"strftime({start} + INTERVAL {size}, '%Y-%m-%d %H:%M:%S') AS \"endTime\", "
            f"strftime({at}, '%Y-%m-%d') AS \"date\"")


HOUR = "time_bucket(INTERVAL 1 HOUR, {})".format
DAY = "date_trunc('day', {})".format


def _closed(size: str, delay: str, ts: str = "ts", rows: str = "events") -> str:
    """Windows a stream has closed at the end of its input."""
    return f"b + INTERVAL {size} <= (SELECT max({ts}) FROM {rows}) - INTERVAL {delay}"


def _page_views(where: str = "TRUE") -> str:
    return _PAGES + f"""
    flagged AS (SELECT *, lag(CAST(ts AS DATE)) OVER (PARTITION BY mid ORDER BY ts, event_id) AS p
                FROM pages),
    counted AS (SELECT {HOUR('ts')} AS b, ar, ch, vc, is_new, count(*) AS pv,
                       sum(CASE WHEN p IS NULL OR p <> CAST(ts AS DATE) THEN 1 ELSE 0 END) AS uv,
                       sum(CASE WHEN last_page_id IS NULL THEN 1 ELSE 0 END) AS sv,
                       sum(CAST(during_time AS DOUBLE)) AS dur
                FROM flagged GROUP BY ALL)
    SELECT {_bounds('b', '1 HOUR')}, ar, ch, vc, is_new, CAST(pv AS BIGINT) AS "pvCt",
           CAST(uv AS BIGINT) AS "uvCt", CAST(sv AS BIGINT) AS "svCt", round(dur, 2) AS "durSum"
    FROM counted WHERE {where}"""


def _home_detail(where: str = "TRUE") -> str:
    return _PAGES + f"""
    flagged AS (
      SELECT ts, page_id, lag(CAST(ts AS DATE)) OVER
             (PARTITION BY page_id, mid ORDER BY ts, event_id) AS p
      FROM pages WHERE page_id IN ('home', 'good_detail')),
    counted AS (SELECT {HOUR('ts')} AS b, count(*) FILTER (page_id = 'home') AS h,
                       count(*) FILTER (page_id = 'good_detail') AS d
                FROM flagged WHERE p IS NULL OR p <> CAST(ts AS DATE) GROUP BY 1)
    SELECT {_bounds('b', '1 HOUR')}, CAST(h AS BIGINT) AS "homeUvCt",
           CAST(d AS BIGINT) AS "goodDetailUvCt" FROM counted WHERE {where}"""


def _logins(where: str = "TRUE") -> str:
    return _PAGES + f"""
    logins AS (SELECT ts, CAST(ts AS DATE) AS d, lag(CAST(ts AS DATE)) OVER
                      (PARTITION BY uid ORDER BY ts, event_id) AS p
               FROM pages WHERE uid IS NOT NULL AND (last_page_id IS NULL OR last_page_id = 'login')),
    counted AS (SELECT {HOUR('ts')} AS b, count(*) AS uu,
                       count(*) FILTER (date_diff('day', p, d) > 7) AS back
                FROM logins WHERE p IS NULL OR p <> d GROUP BY 1)
    SELECT {_bounds('b', '1 HOUR')}, CAST(uu AS BIGINT) AS "uuCt", CAST(back AS BIGINT) AS "backCt"
    FROM counted WHERE {where}"""


def _register(where: str = "TRUE") -> str:
    return f"""
    WITH signups AS (SELECT ts FROM events WHERE event_type = 'signup'),
    counted AS (SELECT b, count(*) AS n FROM (
        SELECT {HOUR('ts')} AS b FROM signups UNION ALL
        SELECT {HOUR('ts')} - INTERVAL 1 HOUR FROM signups) GROUP BY 1)
    SELECT {_bounds('b', '2 HOUR')}, CAST(n AS BIGINT) AS "registerCt" FROM counted WHERE {where}"""


def _carts(where: str = "TRUE") -> str:
    return f"""
    WITH flagged AS (SELECT ts, CAST(ts AS DATE) AS d, lag(CAST(ts AS DATE)) OVER
                            (PARTITION BY user_id ORDER BY ts, event_id) AS p
                     FROM events WHERE event_type = 'click'),
    counted AS (SELECT {HOUR('ts')} AS b, count(*) AS n FROM flagged
                WHERE p IS NULL OR p <> d GROUP BY 1)
    SELECT {_bounds('b', '1 HOUR')}, CAST(n AS BIGINT) AS "cartAddUuCt" FROM counted WHERE {where}"""


def _payers(where: str = "TRUE") -> str:
    return f"""
    WITH flagged AS (SELECT ts, CAST(ts AS DATE) AS d, lag(CAST(ts AS DATE)) OVER
                            (PARTITION BY user_id ORDER BY ts, event_id) AS p
                     FROM events WHERE event_type = 'purchase'),
    counted AS (SELECT {HOUR('ts')} AS b, count(*) FILTER (p IS NULL) AS fresh,
                       count(*) FILTER (p IS NULL OR p <> d) AS uu FROM flagged
                WHERE p IS NULL OR p <> d GROUP BY 1)
    SELECT {_bounds('b', '1 HOUR')}, CAST(fresh AS BIGINT) AS "payNewUserCnt",
           CAST(uu AS BIGINT) AS "payUuCnt" FROM counted WHERE {where}"""


_WORDS = "unnest(regexp_extract_all(lower({}), '[\\p{{L}}\\p{{N}}]+'))".format


def _search(where: str = "TRUE") -> str:
    return _PAGES + f"""
    words AS (SELECT ts, {_WORDS('item')} AS keyword FROM pages
              WHERE last_page_id = 'search' AND item_type = 'keyword' AND item IS NOT NULL),
    counted AS (SELECT {HOUR('ts')} AS b, keyword, count(*) AS n FROM words GROUP BY ALL)
    SELECT {_bounds('b', '1 HOUR')}, keyword, CAST(n AS BIGINT) AS "count" FROM counted WHERE {where}"""


_SKU_NAMES = """
    sku AS (SELECT CAST(p_partkey AS VARCHAR) AS id, p_name, p_brand, p_partkey % (SELECT count(*) FROM supplier) AS supp FROM part)
"""
_SKU_COLUMNS = """sku_id AS "skuId", p_name AS "skuName", CAST(supp AS VARCHAR) AS "spuId",
           s_name AS "spuName", p_brand AS "trademarkId", upper(p_brand) AS "trademarkName",
           CAST(n_regionkey AS VARCHAR) AS "category1Id", r_name AS "category1Name",
           CAST(s_nationkey AS VARCHAR) AS "category2Id", n_name AS "category2Name",
           CAST(supp AS VARCHAR) AS "category3Id", 'c3 ' || s_name AS "category3Name" """
_SKU_JOINS = """LEFT JOIN sku ON sku.id = sku_id LEFT JOIN supplier ON s_suppkey = supp
    LEFT JOIN nation ON n_nationkey = s_nationkey LEFT JOIN region ON r_regionkey = n_regionkey"""


def _provinces() -> str:
    return f"""
    WITH counted AS (SELECT {DAY('o_orderdate')} AS b, c_nationkey, count(DISTINCT o_orderkey) AS n,
                            sum(o_totalprice) AS price
                     FROM orders JOIN customer ON o_custkey = c_custkey
                     WHERE c_nationkey IS NOT NULL GROUP BY ALL)
    SELECT {_bounds('b', '1 DAY', 'end')}, CAST(c_nationkey AS VARCHAR) AS "provinceId",
           n_name AS "provinceName", CAST(n AS BIGINT) AS "totalOrderNum",
           round(price, 2) AS "totalOrderPrice"
    FROM counted LEFT JOIN nation ON n_nationkey = c_nationkey"""


_MICROS = "strftime({}, '%Y-%m-%d %H:%M:%S.%f')".format


def _wide(where: str = "TRUE") -> str:
    return f"""
    SELECT CAST(a.user_id AS VARCHAR) AS order_id, CAST(a.event_id AS VARCHAR) AS sku_id,
           CAST(a.event_id % 9 AS INTEGER) AS sku_num, a.value AS order_price,
           CAST(b.event_id AS VARCHAR) AS province_id, CAST(c.event_id AS VARCHAR) AS activity_id,
           CASE WHEN c.event_id IS NOT NULL THEN 'r1' END AS activity_rule_id,
           CAST(d.event_id AS VARCHAR) AS coupon_id, {_MICROS('a.ts')} AS create_time,
           strftime(a.ts, '%Y-%m-%d') AS "date"
    FROM (SELECT * FROM events WHERE event_type = 'click') a
    JOIN (SELECT * FROM events WHERE event_type = 'purchase') b ON a.user_id = b.user_id
      AND a.ts BETWEEN b.ts - INTERVAL 1 HOUR AND b.ts + INTERVAL 1 HOUR
    LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') c ON a.user_id = c.user_id
      AND a.ts BETWEEN c.ts - INTERVAL 1 HOUR AND c.ts + INTERVAL 1 HOUR
    LEFT JOIN (SELECT * FROM events WHERE event_type = 'error') d ON a.user_id = d.user_id
      AND a.ts BETWEEN d.ts - INTERVAL 1 HOUR AND d.ts + INTERVAL 1 HOUR
    WHERE {where}"""


def _payments(where: str = "TRUE") -> str:
    return f"""
    SELECT CAST(p.event_id AS VARCHAR) AS id, CAST(p.user_id AS VARCHAR) AS order_id,
           CAST(p.user_id AS VARCHAR) AS user_id, CAST(p.event_id % 25 AS VARCHAR) AS payment_type,
           p.value AS total_amount, {_MICROS('p.ts')} AS payment_time,
           CAST(o.event_id AS VARCHAR) AS sku_id, n_name AS payment_name,
           coalesce(c_name, '') AS user_name, strftime(p.ts, '%Y-%m-%d') AS "date"
    FROM (SELECT * FROM events WHERE event_type = 'purchase' AND event_id % 5 <> 0) p
    LEFT JOIN (SELECT * FROM events WHERE event_type = 'click') o ON p.user_id = o.user_id
      AND p.ts BETWEEN o.ts AND o.ts + INTERVAL 6 HOUR
    LEFT JOIN nation ON n_nationkey = p.event_id % 25 AND n_regionkey < 3
    LEFT JOIN customer ON c_custkey = p.user_id AND c_custkey % 3 <> 0
    WHERE {where}"""


_USER_KIND = I.USER_KIND


def _merge(creates: str, replaces: str) -> str:
    """Changes applied in order: only those after a key's last delete matter."""
    return f"""
    WITH ch AS ({I.CUSTOMER_CHANGES_SQL}),
    live AS (SELECT *, max(seq) FILTER (type = 'delete') OVER (PARTITION BY c_custkey) AS cut FROM ch),
    mark AS (SELECT *, cut IS NULL OR seq > cut AS ok FROM live),
    made AS (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY seq) AS first
             FROM mark WHERE ok AND type IN ({creates})),
    over AS (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY seq DESC) AS last
             FROM mark WHERE ok AND type IN ({replaces})),
    keys AS (SELECT DISTINCT c_custkey, cut IS NOT NULL AS was_cut FROM live),
    joined AS (
      SELECT k.c_custkey, t.c_custkey IS NOT NULL AND NOT k.was_cut AS present, t.c_name AS t_name,
             m.seq AS m_seq, m.c_name AS m_name, o.seq AS o_seq, o.c_name AS o_name,
             coalesce(t.c_nationkey, m.c_nationkey) AS c_nationkey,
             coalesce(t.c_acctbal, m.c_acctbal) AS c_acctbal,
             coalesce(t.c_mktsegment, m.c_mktsegment) AS c_mktsegment
      FROM keys k LEFT JOIN customer t ON t.c_custkey = k.c_custkey
      LEFT JOIN made m ON m.c_custkey = k.c_custkey AND m.first = 1
      LEFT JOIN over o ON o.c_custkey = k.c_custkey AND o.last = 1)
    SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
    WHERE c_custkey NOT IN (SELECT c_custkey FROM keys)
    UNION ALL
    SELECT c_custkey, CASE WHEN present THEN coalesce(o_name, t_name)
                           WHEN o_seq > m_seq THEN o_name ELSE m_name END,
           c_nationkey, c_acctbal, c_mktsegment FROM joined WHERE present OR m_seq IS NOT NULL"""


_HOURLY = f"""
    SELECT {HOUR('ts')} AS b, event_type, count(*) AS n FROM events WHERE {{}} GROUP BY ALL"""

_REPLACED = f"""
    WITH a AS ({_HOURLY.format('TRUE')}), z AS ({_HOURLY.format('value > 50')})
    SELECT {_bounds('a.b', '1 HOUR')}, a.event_type, CAST(coalesce(z.n, a.n) AS BIGINT) AS n
    FROM a LEFT JOIN z ON a.b = z.b AND a.event_type = z.event_type"""

# Names after the second batch of changes: an update replaces, an insert only creates.
_NEXT_NAME = ("c_name || CASE WHEN c_custkey % 4 = 0 THEN '*' WHEN c_custkey % 4 = 2 AND NOT stored "
              "THEN '+' ELSE '' END")
_KEPT = ("c_custkey % 5 IN ({}) AND " + _USER_KIND + " IN ('insert', 'bootstrap-insert'{})").format

# The log, in arrival order per device.
_ACCEPTED = f"""
    good AS (SELECT *, date_trunc('second', ts) AS s, {I.ARRIVAL} AS arrival FROM events
             WHERE NOT {I.BAD_LINE}),
    seen AS (SELECT *, max(s) OVER (PARTITION BY user_id ORDER BY arrival
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest,
                    first_value(CAST(s AS DATE)) OVER (PARTITION BY user_id ORDER BY arrival) AS d1
             FROM good),
    log AS (SELECT *, CASE WHEN CAST(s AS DATE) = d1 THEN '1' ELSE '0' END AS flag,
                   strftime(s, '%Y-%m-%d %H:%M:%S') AS st, strftime(s, '%Y-%m-%d') AS dt,
                   event_type IN ('view', 'click', 'purchase') AS has_page
            FROM seen WHERE newest IS NULL OR newest - s <= INTERVAL 5 SECOND)"""

_SHOWN = "CASE event_id % 4 WHEN 1 THEN [1] WHEN 2 THEN [1, 2] END"


def _device(select: str, first: str = "CAST(ts AS DATE)") -> str:
    return f"""
    WITH rows AS (SELECT *, date_trunc('second', ts) AS s, {I.ARRIVAL} AS arrival FROM events),
    seen AS (SELECT *, max(s) OVER (PARTITION BY user_id ORDER BY arrival
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest,
                    first_value({first}) OVER (PARTITION BY user_id ORDER BY arrival) AS d1 FROM rows),
    kept AS (SELECT *, CASE WHEN CAST(ts AS DATE) = d1 THEN '1' ELSE '0' END AS is_new
             FROM seen WHERE newest IS NULL OR newest - s <= INTERVAL 5 SECOND)
    {select}"""


_CART_KEY = "(l_orderkey + l_linenumber)"
_OLD_QTY = (f"CASE WHEN {_CART_KEY} % 5 <> 0 AND {_CART_KEY} % 11 = 0 THEN NULL "
            f"WHEN {_CART_KEY} % 7 = 0 THEN NULL "
            "ELSE CAST(l_quantity AS BIGINT) - 10 + l_linenumber * 2 END")
_OLD_PRICE = (f"CASE WHEN {_CART_KEY} % 5 = 0 THEN NULL WHEN {_CART_KEY} % 11 = 0 THEN 1.5 "
              "ELSE CAST(l_linenumber AS DOUBLE) END")

ORACLES: dict[str, str] = {
    "page_view_metrics": _page_views(),
    "home_detail_uv": _home_detail(),
    "user_login_returning": _logins(),
    "register_sliding": _register(),
    "cart_add_users": _carts(),
    "payment_success_users": _payers(),
    "search_keyword_windows": _search(),
    "keyword_count": f"""SELECT keyword, count(*) AS "count" FROM (
        SELECT {_WORDS('text')} AS keyword FROM documents) GROUP BY 1""",
    "sku_order_snowflake": f"""
    WITH {_SKU_NAMES}, counted AS (
        SELECT {DAY('l_shipdate')} AS b, CAST(l_partkey AS VARCHAR) AS sku_id,
               sum(CAST(l_quantity AS INTEGER)) AS qty, sum(l_extendedprice) AS price
        FROM lineitem GROUP BY ALL)
    SELECT {_bounds('b', '1 DAY', 'end')}, {_SKU_COLUMNS}, CAST(qty AS BIGINT) AS "totalSkuNum",
           round(price, 2) AS "totalOrderPrice"
    FROM counted {_SKU_JOINS}""",
    "province_orders_exact": _provinces(),
    "window_date_from_end": f"""
    SELECT {_bounds('b', '6 HOUR', 'end')}, event_type, n FROM (
        SELECT time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '2024-01-01') AS b, event_type, count(*) AS n
        FROM events GROUP BY ALL)""",
    "daily_first_visits": f"""
    SELECT user_id, {_MICROS('ts')} AS ts, event_type, strftime(d, '%Y-%m-%d') AS visit_date,
           strftime(p, '%Y-%m-%d') AS previous_date
    FROM (SELECT *, CAST(ts AS DATE) AS d, lag(CAST(ts AS DATE)) OVER
                    (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events)
    WHERE p IS NULL OR p <> d""",
    "order_wide_interval": _wide(),
    "payment_wide": _payments(),
    "interval_pairs_inner": """
    SELECT c.event_id AS click_id, v.event_id AS view_id
    FROM events c JOIN events v ON c.event_type = 'click' AND v.event_type = 'view'
     AND c.user_id = v.user_id AND c.ts BETWEEN v.ts AND v.ts + INTERVAL 30 MINUTE""",
    "semi_join_config": f"""
    SELECT 'user_info' AS "table", {_USER_KIND} AS type, count(*) AS n FROM customer
    WHERE {_USER_KIND} NOT IN ('bootstrap-start', 'bootstrap-complete') GROUP BY ALL
    UNION ALL
    SELECT 'comment_info', CASE WHEN o_orderkey % 10 = 0 THEN 'delete' ELSE 'insert' END, count(*)
    FROM orders GROUP BY ALL""",
    "cdc_cart_delta": f"""
    WITH c AS (SELECT *, {_CART_KEY} % 3 = 0 AS fresh, CAST(l_quantity AS BIGINT) AS qty,
                      {_OLD_QTY} AS old_qty, {_OLD_PRICE} AS old_price
               FROM lineitem WHERE {_CART_KEY} % 13 <> 0)
    SELECT strftime(l_shipdate, '%Y-%m-%d') AS "date", CAST(l_partkey AS VARCHAR) AS sku_id,
           count(*) AS n, CAST(sum(CASE WHEN fresh THEN qty ELSE qty - old_qty END) AS BIGINT) AS sku_num,
           round(sum(CASE WHEN fresh THEN l_extendedprice WHEN old_price IS NULL THEN 0
                          ELSE l_extendedprice - old_price END), 2) AS cart_price
    FROM c WHERE fresh OR qty > old_qty GROUP BY ALL""",
    "comment_dictionary": """
    SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS user_id,
           CASE WHEN o_orderpriority <> '5-LOW' THEN substring(o_orderpriority, 3) END AS appraise,
           strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS create_time,
           strftime(o_orderdate, '%Y-%m-%d') AS "date"
    FROM orders WHERE o_orderkey % 10 <> 0""",
    "cdc_new_users": """
    SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, c_mktsegment AS user_level,
           strftime(DATE '2024-01-01' + CAST(c_custkey % 28 AS INTEGER), '%Y-%m-%d') || ' 08:00:00'
               AS create_time,
           strftime(DATE '2024-01-01' + CAST(c_custkey % 28 AS INTEGER), '%Y-%m-%d') AS "date"
    FROM customer WHERE c_custkey % 6 IN (0, 1)""",
    "cdc_control_filter": f"""
    SELECT 'shop' AS "database", 'user_info' AS "table", {_USER_KIND} AS type, count(*) AS n
    FROM customer WHERE c_custkey % 6 < 4 GROUP BY ALL""",
    "json_props": """
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, 'none' AS missing
    FROM events""",
    "latest_order_per_customer": """
    SELECT o_custkey, o_orderkey, o_orderpriority, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate
    FROM orders QUALIFY row_number() OVER
        (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
    "dim_merge_strict": _merge("'insert', 'bootstrap-insert'", "'update'"),
    "dim_merge_upsert": _merge("'insert', 'bootstrap-insert', 'update'", "'update'"),
    "rowkey_replace": f"""
    WITH puts AS (SELECT *, 'insert' AS type, 0 AS seq FROM customer UNION ALL {I.CUSTOMER_CHANGES_SQL})
    SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
           CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment
    FROM (SELECT * FROM puts QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY seq DESC) = 1)
    WHERE type <> 'delete'""",
    "metric_keyed_replace": _REPLACED,
    "keyed_table_batches": _REPLACED,
    "dimension_config": """
    SELECT CAST(r_regionkey AS VARCHAR) AS id, 'dim_source_' || r_regionkey AS source_table,
           CASE WHEN r_regionkey = 3 THEN 'moved_' ELSE 'dim_sink_' END || r_regionkey AS sink_table,
           'id' AS row_key, CAST(r_regionkey % 2 AS INTEGER) AS to_hbase,
           CASE WHEN r_regionkey = 3 THEN '2023-11-14 22:13:21' ELSE '2023-11-14 22:13:20' END AS "time"
    FROM region WHERE r_regionkey <> 4""",
    "dimension_sync": f"""
    SELECT CAST(c_custkey AS VARCHAR) AS id, c_mktsegment AS user_level, {_NEXT_NAME} AS name,
           'dim_sink_' || (c_custkey % 5) AS sink_table
    FROM (SELECT *, {_KEPT('0, 2, 4', '')} AS stored FROM customer)
    WHERE c_custkey % 5 IN (0, 2, 4) AND c_custkey % 4 <> 1 AND (stored OR c_custkey % 4 = 2)""",
    "dimension_sync_keyed": f"""
    SELECT CAST(c_custkey AS VARCHAR) AS id, c_mktsegment AS user_level, 'dim_sink_' || (c_custkey % 5) AS sink_table,
           c_name || CASE c_custkey % 4 WHEN 0 THEN '*' WHEN 2 THEN '+' ELSE '' END AS name
    FROM (SELECT *, {_KEPT('1, 3', ", 'update'")} AS stored FROM customer)
    WHERE c_custkey % 5 IN (1, 3) AND (c_custkey % 4 IN (0, 2) OR (c_custkey % 4 = 3 AND stored))""",
    "dimension_sync_files": """
    SELECT CAST(c_custkey AS VARCHAR) AS id, c_mktsegment AS user_level,
           CASE WHEN c_custkey % 4 <> 0 THEN c_name || ' as the newer file has it' ELSE 'old' END AS name,
           'dim_sink_' || (c_custkey % 5) AS sink_table
    FROM customer WHERE c_custkey % 5 IN (1, 3)""",
    "log_valid": f"""
    SELECT CAST(user_id AS VARCHAR) AS mid, CAST(user_id % 2 AS VARCHAR) AS is_new,
           strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS ts
    FROM events WHERE NOT {I.BAD_LINE}""",
    "log_invalid": f"SELECT {I.log_line('epoch_us(ts) // 1000')} AS value, TRUE AS today FROM events WHERE {I.BAD_LINE}",
    "log_pages": f"""WITH {_ACCEPTED}
    SELECT 'a' || (user_id % 4) AS ar, event_type AS ch, flag AS is_new, CAST(user_id AS VARCHAR) AS mid,
           CAST(user_id AS VARCHAR) AS uid, 'v' || (event_id % 3) AS vc, event_type AS page_id,
           CASE WHEN event_id % 5 <> 0 THEN 'home' END AS last_page_id,
           CAST(event_id % 1000 AS VARCHAR) AS during_time, st AS ts, dt AS "date"
    FROM log WHERE has_page""",
    "log_starts": f"""WITH {_ACCEPTED}
    SELECT CAST(user_id AS VARCHAR) AS mid, flag AS is_new, 'icon' AS entry,
           CAST(event_id % 100 AS BIGINT) AS loading_time, st AS ts, dt AS "date"
    FROM log WHERE event_type = 'signup'""",
    "log_errors": f"""WITH {_ACCEPTED}
    SELECT CAST(event_id % 7 AS BIGINT) AS error_code, 'm' || (event_id % 3) AS msg, st AS ts, dt AS "date"
    FROM log WHERE event_type = 'error'""",
    "log_display_explode": f"""WITH {_ACCEPTED}
    SELECT CAST(user_id AS VARCHAR) AS mid, flag AS is_new, CASE WHEN has_page THEN event_type END AS page_id,
           'query' AS display_type, CAST(event_id % 50 AS VARCHAR) AS display_item,
           'sku' AS display_item_type, CAST(unnest({_SHOWN}) AS VARCHAR) AS pos_seq,
           CAST(event_id % 5 AS VARCHAR) AS pos_id, st AS ts, dt AS "date" FROM log""",
    "log_action_explode": f"""WITH {_ACCEPTED}
    SELECT CAST(user_id AS VARCHAR) AS mid, flag AS is_new, CASE WHEN has_page THEN event_type END AS page_id,
           'favor' AS action_id, CAST(event_id % 40 AS VARCHAR) AS action_item, 'sku' AS action_item_type,
           st AS ts, dt AS "date" FROM log WHERE event_id % 3 = 0""",
    "log_route_counts": f"""WITH {_ACCEPTED}
    SELECT 'topic_log_start' AS "table", dt AS "date", count(*) AS n FROM log WHERE event_type = 'signup' GROUP BY ALL
    UNION ALL SELECT 'topic_log_err', dt, count(*) FROM log WHERE event_type = 'error' GROUP BY ALL
    UNION ALL SELECT 'topic_log_page', dt, count(*) FROM log WHERE has_page GROUP BY ALL
    UNION ALL SELECT 'topic_log_display', dt, CAST(sum(event_id % 4) AS BIGINT) FROM log
              WHERE event_id % 4 IN (1, 2) GROUP BY ALL
    UNION ALL SELECT 'topic_log_action', dt, count(*) FROM log WHERE event_id % 3 = 0 GROUP BY ALL""",
    "device_is_new": _device("SELECT event_id, user_id, is_new FROM kept"),
    "device_is_new_trusting": _device(
        "SELECT event_id, is_new FROM kept",
        "CAST(ts AS DATE) - CASE WHEN event_id % 2 = 0 THEN 1 ELSE 0 END"),
    "device_late_drop": _device("SELECT user_id, count(*) AS kept FROM kept GROUP BY user_id"),
    "keyword_count_sql": f"""SELECT keyword, count(*) AS "count" FROM (
        SELECT {_WORDS('text')} AS keyword FROM documents) GROUP BY 1""",
    "partition_overwrite": """
    SELECT strftime(o_orderdate, '%Y') AS "year", CASE WHEN year(o_orderdate) = 1997 THEN 'again'
           ELSE o_orderstatus END AS o_orderstatus, count(*) AS n FROM orders GROUP BY ALL""",
    "compacted_files": "SELECT p_partkey, p_type, p_size FROM part",
    "compacted_fact_files": """
    SELECT "table", strftime(ts, '%Y-%m-%d') AS "date", count(*) AS n, CAST(1 AS BIGINT) AS files_after,
           count(DISTINCT event_id % 4) > 1 AS fewer
    FROM events, (VALUES ('facts'), ('stream')) t("table") GROUP BY ALL""",
    "keyed_lookup_for_batch": """
    SELECT CAST(user_id AS VARCHAR) AS user_id, coalesce(CASE WHEN c_custkey % 2 = 0 THEN upper(c_name)
           ELSE c_name END, '') AS name, count(*) AS n
    FROM events LEFT JOIN customer ON c_custkey = user_id AND c_custkey % 3 <> 0
    WHERE event_type = 'purchase' GROUP BY ALL""",
    "point_lookup": "SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_custkey = 42",
    "range_scan": """
    SELECT c_custkey, c_name FROM customer
    WHERE CAST(c_custkey AS VARCHAR) >= '10' AND CAST(c_custkey AS VARCHAR) < '2'""",
    "range_scan_filtered": """
    SELECT c_custkey, c_name FROM customer
    WHERE CAST(c_custkey AS VARCHAR) >= '10' AND CAST(c_custkey AS VARCHAR) < '2'
      AND (c_custkey % 10 = 0 OR c_mktsegment = 'BUILDING')""",
    "append_evolved_schema": """
    SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END
               AS o_orderpriority, strftime(o_orderdate, '%Y') AS "year"
    FROM orders""",
    "date_functions": """
    SELECT event_id, strftime(ts, '%Y-%m-%d') AS day,
           strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS "second",
           strftime(ts, '%Y-%m-%d') AS millis_day,
           strftime(CAST(ts AS DATE) - 1, '%Y-%m-%d') AS day_before,
           date_diff('second', TIMESTAMP '2024-01-01', date_trunc('second', ts)) AS seconds,
           date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS days
    FROM events""",
    "stream_page_view_metrics": _page_views(_closed("1 HOUR", "3 SECOND")),
    "stream_home_detail_uv": _home_detail(_closed(
        "1 HOUR", "3 SECOND", rows="pages WHERE page_id IN ('home', 'good_detail')")),
    "stream_home_detail_state": _home_detail(_closed(
        "1 HOUR", "3 SECOND", rows="pages WHERE page_id IN ('home', 'good_detail')")),
    "stream_user_login_returning": _logins(_closed("1 HOUR", "3 SECOND", rows="logins")),
    "stream_register_sliding": _register(_closed("2 HOUR", "3 SECOND", rows="signups")),
    "stream_cart_add_users": _carts(_closed("1 HOUR", "5 SECOND", rows="flagged")),
    "stream_payment_success_users": _payers(_closed("1 HOUR", "5 SECOND", rows="flagged")),
    "stream_search_keyword_windows": _search(_closed("1 HOUR", "30 SECOND", rows="words")),
    "stream_device_is_new": _device("SELECT event_id, user_id, is_new FROM kept"),
    "stream_log_invalid": f"SELECT {I.log_line('epoch_us(ts) // 1000')} AS value, TRUE AS today FROM events WHERE {I.BAD_LINE}",
    "stream_sku_orders": f"""
    WITH {_SKU_NAMES}, clicks AS (SELECT * FROM events WHERE event_type = 'click'),
    counted AS (SELECT {HOUR('ts')} AS b, CAST(event_id AS VARCHAR) AS sku_id, 2 * count(*) AS qty,
                       sum(value) AS price FROM clicks GROUP BY ALL)
    SELECT {_bounds('b', '1 HOUR', 'end')}, {_SKU_COLUMNS}, CAST(qty AS BIGINT) AS "totalSkuNum",
           round(price, 2) AS "totalOrderPrice"
    FROM counted {_SKU_JOINS} WHERE {_closed('1 HOUR', '1 SECOND', rows='clicks')}""",
    "stream_keyed_metric_table": _register(_closed("2 HOUR", "3 SECOND", rows="signups")),
}

# Left joins as streams: rows still waiting for a partner at the end of the input are not out yet.
_LAST = ("(SELECT least(max(ts) FILTER (event_type = 'click'), "
         "max(ts) FILTER (event_type = 'purchase')) FROM events)")
ORACLES["stream_payment_wide"] = _payments(
    f"o.event_id IS NOT NULL OR p.ts < {_LAST} - INTERVAL 1 MINUTE")

# In a chain each left join holds an unmatched row one interval longer than the join before it:
# the first (inner) join passes its watermark on an hour late, the next join another hour.
_ENDS = ("(SELECT min(m) FROM (SELECT max(ts) AS m FROM events WHERE event_type IN "
         "('click', 'purchase', 'view', 'error') GROUP BY event_type)) - INTERVAL 1 MINUTE")
ORACLES["stream_order_wide_interval"] = _wide(
    f"(c.event_id IS NOT NULL OR a.ts < {_ENDS} - INTERVAL 2 HOUR) "
    f"AND (d.event_id IS NOT NULL OR a.ts < {_ENDS} - INTERVAL 3 HOUR)")
ORACLES["stream_log_pages"] = ORACLES["log_pages"]
# Delivered in time order, no row is late.
ORACLES["stream_device_delivered"] = """
    SELECT event_id, user_id, CASE WHEN CAST(ts AS DATE) = min(CAST(ts AS DATE)) OVER
           (PARTITION BY user_id) THEN '1' ELSE '0' END AS is_new FROM events"""

_SIX_HOURS = "time_bucket(INTERVAL 6 HOUR, {}, TIMESTAMP '2024-01-01')".format
_LATE = "epoch_us(ts) + CASE WHEN event_id % 97 = 0 THEN 604800000000 ELSE 0 END"
# The slice each row is staged in, and the newest time of all slices before it.
_SLICED = f"""
    WITH placed AS (SELECT *, {_LATE} AS place FROM events),
    sliced AS (SELECT *, (place - low) // ((high - low) // 4 + 1) AS slice
               FROM placed, (SELECT min(place) AS low, max(place) AS high FROM placed)),
    marks AS (SELECT slice, max(max(ts)) OVER (ORDER BY slice ROWS BETWEEN UNBOUNDED PRECEDING
                                               AND 1 PRECEDING) AS mark,
                     max(max(ts)) OVER (ORDER BY slice ROWS BETWEEN UNBOUNDED PRECEDING
                                        AND 2 PRECEDING) AS closed FROM sliced GROUP BY slice),
    told AS (SELECT s.*, mark, closed, coalesce(ts <= mark - INTERVAL 1 MINUTE, FALSE) AS late
             FROM sliced s JOIN marks USING (slice))"""

ORACLES |= {
    "stream_evolved_schema": ORACLES["append_evolved_schema"],
    "stream_cart_delta": ORACLES["cdc_cart_delta"],
    "stream_new_users": ORACLES["cdc_new_users"],
    "stream_comment_dictionary": ORACLES["comment_dictionary"],
    "stream_province_orders": f"""
    WITH lines AS (SELECT CAST(floor(event_id / 3) AS BIGINT) AS o, user_id % 5 AS p, value, ts FROM events
                   WHERE event_type IN ('click', 'purchase')),
    counted AS (SELECT {_SIX_HOURS('ts')} AS b, p, count(DISTINCT o) AS n, sum(value) AS price
                FROM lines GROUP BY ALL)
    SELECT {_bounds('b', '6 HOUR', 'end')}, CAST(p AS VARCHAR) AS "provinceId", n_name AS "provinceName",
           n AS orders, TRUE AS near, round(price, 2) AS "totalOrderPrice"
    FROM counted JOIN nation ON n_nationkey = p
    WHERE {_closed('6 HOUR', '1 SECOND', rows='lines')}""",
    "province_orders_sketch": """
    WITH o AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, CAST(c_nationkey AS VARCHAR) AS province, o_orderkey
               FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_nationkey IS NOT NULL)
    SELECT month, province, count(DISTINCT o_orderkey) AS orders, TRUE AS near FROM o GROUP BY ALL
    UNION ALL SELECT month, 'all', count(DISTINCT o_orderkey), TRUE FROM o GROUP BY ALL""",
    "stream_state_days": f"""
    WITH pages AS ({I.PAGES_SQL}),
    last AS (SELECT uid, max(CAST(ts AS DATE)) AS d FROM pages WHERE last_page_id IS NULL GROUP BY 1)
    SELECT strftime(d, '%Y-%m-%d') AS last_day, count(*) AS keys FROM last GROUP BY 1""",
    "stream_log_observed": f"""
    SELECT CASE WHEN {I.BAD_LINE} THEN 'invalid' ELSE 'valid' END AS kind, count(*) AS observed,
           count(*) AS written FROM events GROUP BY 1""",
    "stream_late_rows": f"{_SLICED} SELECT event_id, late FROM told",
    "stream_late_dropped": f"""{_SLICED},
    counted AS (SELECT date_trunc('day', ts) AS b, event_type, count(*) AS n FROM told
                WHERE closed IS NULL OR date_trunc('day', ts) + INTERVAL 1 DAY > closed - INTERVAL 1 MINUTE
                GROUP BY ALL)
    SELECT {_bounds('b', '1 DAY')}, event_type, n FROM counted
    WHERE {_closed('1 DAY', '1 MINUTE')}""",
    "catalog_table": """
    SELECT r_regionkey, r_name, count(*) OVER () AS seen, TRUE AS dropped FROM region""",
}

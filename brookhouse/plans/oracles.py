"""ANSI SQL over the raw tables that gives the result of the query with the same name."""

EPOCH, GAP = 1704067200, 7

LINE_ID = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)"


def _seconds(key: str) -> str:
    return f"({key} * {GAP} + {EPOCH})"


def _text(x: str) -> str:
    return f"CAST({x} AS VARCHAR)"


def _money(x: str) -> str:
    return f"CAST(CAST({x} AS DECIMAL(18,2)) AS VARCHAR)"


def _moment(seconds: str, fmt: str = "%Y-%m-%d %H:%M:%S") -> str:
    return f"strftime(TIMESTAMP '1970-01-01' + to_seconds(CAST({seconds} AS BIGINT)), '{fmt}')"


NULL = "CAST(NULL AS VARCHAR)"
K = "CAST(json_extract(props, '$.k') AS BIGINT)"
CANCEL_TS = f"({_seconds('o_orderkey')} + o_orderkey % 60 * 60)"
PAY_TS = f"({_seconds('o_orderkey')} + (o_orderkey % 30 - 20) * 60)"
ACTIVITY = "5.00"

DETAIL = f"""
SELECT {LINE_ID} AS id, {_text('l_orderkey')} AS order_id, {_text('l_partkey')} AS sku_id,
       'sku-' || l_partkey AS sku_name, {_money('l_extendedprice')} AS order_price,
       {_text('CAST(l_quantity AS BIGINT)')} AS sku_num, {_moment(_seconds('l_orderkey'))} AS create_time,
       {_money('l_extendedprice')} AS split_total_amount,
       CASE WHEN l_discount >= 0.05 THEN '5.00' ELSE '0.00' END AS split_activity_amount,
       '0.00' AS split_coupon_amount, {_seconds('l_orderkey')} AS ts
FROM lineitem"""
BUYER = f"""
SELECT {_text('o_orderkey')} AS id, {_text('o_custkey % 34')} AS province_id, {_text('o_custkey')} AS user_id,
       {_seconds('o_orderkey')} AS ts
FROM orders"""
ACTIVITIES = f"""
SELECT {LINE_ID} AS order_detail_id, {_text('l_suppkey % 10')} AS activity_id, {_text('l_suppkey')} AS activity_rule_id
FROM lineitem WHERE l_discount >= 0.05"""
COUPONS = f"""
SELECT {LINE_ID} AS order_detail_id, {_text('l_suppkey')} AS coupon_id FROM lineitem WHERE l_tax >= 0.05"""
WIDE = f"""
WITH d AS ({DETAIL}), b AS ({BUYER}), a AS ({ACTIVITIES}), c AS ({COUPONS})
SELECT d.id, d.order_id, d.sku_id, b.province_id, b.user_id, a.activity_id, a.activity_rule_id, c.coupon_id,
       d.sku_name, d.order_price, d.sku_num, d.create_time, d.split_total_amount, d.split_activity_amount,
       d.split_coupon_amount, d.ts
FROM d JOIN b ON d.order_id = b.id LEFT JOIN a ON d.id = a.order_detail_id LEFT JOIN c ON d.id = c.order_detail_id"""
CANCELS = f"""
SELECT {_text('o_orderkey')} AS id, {_moment(CANCEL_TS)} AS operate_time, {CANCEL_TS} AS ts
FROM orders WHERE o_orderstatus = 'F'"""
PAYMENTS = f"""
SELECT {_text('o_orderkey')} AS id, {_text('o_orderkey')} AS order_id, {_text('o_custkey')} AS user_id,
       substr(o_orderpriority, 1, 1) AS payment_type, {_money('o_totalprice')} AS total_amount,
       {_moment(PAY_TS)} AS callback_time, {PAY_TS} AS ts
FROM orders WHERE o_orderstatus = 'P'"""
COMMENTS = f"""
SELECT {_text('o_orderkey')} AS id, {_text('o_custkey')} AS user_id, 'user-' || o_custkey AS nick_name,
       {NULL} AS head_img, {_text('o_orderkey % 100')} AS sku_id, {_text('o_orderkey % 10')} AS spu_id,
       {_text('o_orderkey')} AS order_id, substr(o_orderpriority, 1, 1) AS appraise, o_orderpriority AS comment_txt,
       {_moment(_seconds('o_orderkey'))} AS create_time, {NULL} AS operate_time
FROM orders WHERE o_orderstatus = 'O'"""
DICTIONARY = """
SELECT DISTINCT substr(o_orderpriority, 1, 1) AS dic_code, substr(o_orderpriority, 3) AS dic_name
FROM orders WHERE substr(o_orderpriority, 1, 1) <> '5'"""


def _cancelled(bound: str) -> str:
    return f"""
WITH w AS ({WIDE}), x AS ({CANCELS})
SELECT d.id, d.order_id, d.sku_id, d.province_id, d.user_id, d.activity_id, d.activity_rule_id, d.coupon_id, substr(c.operate_time, 1, 10) AS order_cancel_date_id,
       c.operate_time, d.sku_name, d.order_price, d.sku_num, d.create_time, d.split_total_amount,
       d.split_activity_amount, d.split_coupon_amount, c.ts
FROM w d JOIN x c ON d.order_id = c.id{bound}"""


def _paid(low: int, high: int) -> str:
    return f"""
SELECT d.id, p.order_id, p.user_id, p.payment_type, p.callback_time AS payment_time, d.sku_id, d.province_id,
       d.activity_id, d.activity_rule_id, d.coupon_id, d.sku_name, d.order_price, d.sku_num,
       d.split_total_amount, d.split_activity_amount, d.split_coupon_amount, p.ts
FROM ({WIDE}) d JOIN ({PAYMENTS}) p ON d.order_id = p.order_id AND p.ts BETWEEN d.ts + {low} AND d.ts + {high}"""


COMMENT_FACT = f"""
SELECT c.id, c.user_id, c.nick_name, c.sku_id, c.spu_id, c.order_id, c.appraise AS appraise_code,
       b.dic_name AS appraise_name, c.comment_txt, c.create_time, c.operate_time
FROM ({COMMENTS}) c JOIN ({DICTIONARY}) b ON c.appraise = b.dic_code"""

CART = f"""
SELECT {LINE_ID} AS id, {_text('l_suppkey')} AS user_id, {_text('l_partkey')} AS sku_id,
       {_money('l_extendedprice')} AS cart_price,
       {_text("CASE WHEN l_linenumber = 1 THEN CAST(l_quantity AS BIGINT) "
              "ELSE CAST(l_quantity AS BIGINT) - 5 * l_linenumber END")} AS sku_num,
       'sku-' || l_partkey AS sku_name, {NULL} AS is_checked, {_moment(_seconds('l_orderkey'))} AS create_time,
       {NULL} AS operate_time, '0' AS is_ordered, {NULL} AS order_time, {_seconds('l_orderkey')} AS ts
FROM lineitem WHERE l_linenumber = 1 OR CAST(l_quantity AS BIGINT) > 5 * l_linenumber"""

CHANGE_ROWS = f"""
SELECT o_orderkey % 10 AS rest, {_text('o_orderkey')} AS id, o_orderstatus AS status, {_seconds('o_orderkey')} AS ts
FROM orders"""

FACT_CELLS = f"""
SELECT 'dwd_order_new' AS sink_table, {_text('o_orderkey')} AS id, 'o_orderkey' AS col, {_text('o_orderkey')} AS val
FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT 'dwd_order_new', {_text('o_orderkey')}, 'o_custkey', {_text('o_custkey')}
FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT 'dwd_order_change', {_text('o_orderkey')}, 'o_orderkey', {_text('o_orderkey')}
FROM orders WHERE o_orderstatus = 'O'
UNION ALL SELECT 'dwd_order_change', {_text('o_orderkey')}, 'o_orderstatus', o_orderstatus
FROM orders WHERE o_orderstatus = 'O'
UNION ALL SELECT 'dwd_line_new', {LINE_ID}, 'l_orderkey', {_text('l_orderkey')} FROM lineitem WHERE l_returnflag = 'N'
UNION ALL SELECT 'dwd_line_new', {LINE_ID}, 'l_linenumber', {_text('l_linenumber')}
FROM lineitem WHERE l_returnflag = 'N'"""

ORDER_TYPE = "CASE o_orderstatus WHEN 'F' THEN 'insert' WHEN 'O' THEN 'update' ELSE 'delete' END"
LINE_TYPE = "CASE l_returnflag WHEN 'N' THEN 'insert' WHEN 'A' THEN 'update' ELSE 'delete' END"


def _folded(keep_nulls: bool) -> str:
    prio = "CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority END"
    st = "CASE WHEN o_orderkey % 2 <> 0 THEN o_orderstatus END"

    def last(value: str) -> str:
        seen = "TRUE" if keep_nulls else f"{value} IS NOT NULL"
        return (f"(max({{'seq': seq, 'v': {value}}}) FILTER "
                f"(WHERE type <> 'delete' AND seq > coalesce(gone, -1) AND {seen})).v")

    some = "" if keep_nulls else " AND (prio IS NOT NULL OR st IS NOT NULL)"
    return f"""
WITH e AS (SELECT o_custkey AS row_key, o_orderkey AS seq, {prio} AS prio, {st} AS st,
                  CASE WHEN o_orderstatus = 'P' AND o_orderkey % 5 = 0 THEN 'delete' ELSE 'insert' END AS type
           FROM orders),
     g AS (SELECT e.*, max(CASE WHEN type = 'delete' THEN seq END) OVER (PARTITION BY row_key) AS gone FROM e)
SELECT row_key, {last('prio')} AS prio, {last('st')} AS st
FROM g GROUP BY row_key HAVING bool_or(type <> 'delete' AND seq > coalesce(gone, -1){some})"""


FEED = """
SELECT s_name AS source_table, 'dim_' || s_name AS sink_table, s_suppkey, step,
       CASE step WHEN 0 THEN 'c' WHEN 1 THEN 'u' ELSE 'd' END AS op, s_suppkey * 10 + step + 1 AS ts_ms
FROM supplier, generate_series(0, 2) AS g(step) WHERE step <= s_suppkey % 3"""

LOG = f"""
SELECT *, {K} AS k, epoch_us(ts) // 1000 AS ms, {_text('event_id')} AS sid,
       CASE event_type WHEN 'signup' THEN '1' ELSE '0' END AS is_new
FROM events"""
FOUND = "(event_type = 'click' AND k % 4 = 0)"

# Whole messages; fields of an object are in the order of their names, the context of a display or action comes last.
COMMON = f"""json_object('ar', {_text('k % 34')}, 'ba', 'ba', 'ch', 'ch', 'is_new', is_new, 'md', 'md', 'mid', {_text('user_id')},
            'net', 'wifi', 'os', 'os', 'sid', sid, 'uid', {_text('user_id')}, 'vc', 'v1')"""
PAGE = f"""json_object('during_time', k, 'item', 'item-' || k, 'item_type', CASE WHEN {FOUND} THEN 'keyword' ELSE 'sku_id' END,
          'last_page_id', CASE WHEN {FOUND} THEN 'search' ELSE 'home' END, 'page_id', event_type, 'scroll', k)"""
DEVICE = "json_object('kind', 'tablet')"


def _messages(topic: str, value: str, where: str, more: str = "") -> str:
    return f"SELECT 'dwd_traffic_{topic}' AS topic, CAST({value} AS VARCHAR) AS value FROM ({LOG}) l{more} WHERE {where}"


LOG_PAGE = _messages("page", f"json_object('device', {DEVICE}, 'page', {PAGE}, 'ts', ms, 'common', {COMMON})", "event_type <> 'signup'")
LOG_START = _messages("start", f"json_object('device', {DEVICE}, 'start', json_object('cold', true, 'entry', 'icon', 'loading_time', k), "
                      f"'ts', ms, 'common', {COMMON})", "event_type = 'signup'")
LOG_ERR = _messages("err", "json_object('error_code', k + 1000, 'msg', 'event ' || event_id, 'trace', 'at x')", "event_type = 'error'")
LOG_DISPLAY = _messages("display", f"json_object('item', 'sku-' || i, 'item_type', 'sku_id', 'pos_id', k, 'pos_seq', i, 'rank', i, "
                        f"'common', {COMMON}, 'page', {PAGE}, 'ts', ms)", "event_type <> 'signup' AND i <= k % 3",
                        ", generate_series(1, 2) AS g(i)")
LOG_ACTION = _messages("action", f"json_object('action_id', 'favor_add', 'item', {_text('k')}, 'item_type', 'sku_id', 'weight', 1, "
                       f"'common', {COMMON}, 'page', {PAGE}, 'ts', ms)", "event_type = 'click'")

PART_SEARCH = """
SELECT p_name AS keyword, epoch_us(ts) // 1000 AS ts
FROM events JOIN part ON p_partkey = event_id % (SELECT count(*) FROM part) WHERE event_type = 'view'"""


def _east(fmt: str) -> str:
    return f"strftime(make_timestamp(epoch_us(ts) + 28800000000), '{fmt}')"


ORACLES: dict[str, str] = {
    "cdc_cleanse": f"""
SELECT CASE rest WHEN 5 THEN 'bootstrap-insert' WHEN 6 THEN NULL ELSE 'update' END AS type,
       CASE WHEN rest <> 6 THEN ts END AS ts, id, CASE WHEN rest <> 6 THEN status END AS status
FROM ({CHANGE_ROWS}) WHERE rest IN (5, 6, 8, 9)""",
    "cdc_cleanse_generic": f"""
SELECT CASE rest WHEN 3 THEN 'other' ELSE 'shop' END AS database, 'orders' AS "table",
       CASE rest WHEN 2 THEN 'bootstrap-start' WHEN 3 THEN 'insert' WHEN 4 THEN 'insert'
                 WHEN 5 THEN 'bootstrap-insert' WHEN 6 THEN NULL ELSE 'update' END AS type,
       CASE WHEN rest <> 6 THEN ts END AS ts, CASE WHEN rest <> 4 THEN id END AS id,
       CASE WHEN rest NOT IN (4, 6) THEN status END AS status
FROM ({CHANGE_ROWS}) WHERE rest NOT IN (0, 1, 7)""",
    "exact_money": """
SELECT o_orderkey AS id, CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 100 AS BIGINT) AS total_cents FROM orders""",
    "cart_add": CART,
    "cart_add_json": f"""
SELECT 'dwd_trade_cart_add' AS topic,
       '{{"id":"' || id || '","user_id":"' || user_id || '","sku_id":"' || sku_id || '","cart_price":"' || cart_price
       || '","sku_num":"' || sku_num || '","sku_name":"' || sku_name || '","create_time":"' || create_time
       || '","is_ordered":"' || is_ordered || '","ts":' || ts || '}}' AS value FROM ({CART})""",
    "comment_insert": COMMENTS,
    "order_detail_insert": DETAIL,
    "order_detail_view": f"""
SELECT sku_id, count(*) AS n, CAST(sum(CAST(sku_num AS BIGINT)) AS BIGINT) AS goods FROM ({DETAIL}) GROUP BY sku_id""",
    "order_info_insert": BUYER,
    "order_activity_insert": ACTIVITIES,
    "order_coupon_insert": COUPONS,
    "order_cancel_update": CANCELS,
    "payment_success_update": PAYMENTS,
    "order_detail_wide": WIDE,
    "order_detail_wide_unbounded": WIDE,
    "order_cancel": _cancelled(" AND c.ts BETWEEN d.ts - 5 AND d.ts + 1805"),
    "order_cancel_unbounded": _cancelled(""),
    "payment_interval": _paid(-900, 5),
    "payment_interval_after_order": _paid(-5, 900),
    "click_purchase_interval": """
SELECT b.event_id AS purchase_id, c.event_id AS click_id, b.user_id
FROM events b JOIN events c ON b.user_id = c.user_id AND b.event_type = 'purchase' AND c.event_type = 'click'
 AND c.ts BETWEEN b.ts - INTERVAL 6 HOUR AND b.ts + INTERVAL 10 MINUTE""",
    "payment_success": f"""
SELECT p.id, p.order_id, p.user_id, p.payment_type AS payment_type_code, b.dic_name AS payment_type_name,
       p.payment_time, p.sku_id, p.province_id, p.activity_id, p.activity_rule_id, p.coupon_id, p.sku_name,
       p.order_price, p.sku_num, p.split_total_amount, p.split_activity_amount, p.split_coupon_amount, p.ts
FROM ({_paid(-900, 5)}) p LEFT JOIN ({DICTIONARY}) b ON p.payment_type = b.dic_code""",
    "comment_lookup": COMMENT_FACT,
    "dictionary_join": COMMENT_FACT,
    "order_fact_topic": f"""
SELECT *, ts AS row_seconds FROM ({WIDE})""",
    "config_route_dwd": f"""
SELECT sink_table, col, val, count(*) AS n FROM ({FACT_CELLS}) GROUP BY sink_table, col, val""",
    "config_route_dwd_json": """
SELECT 'dwd_order_new' AS topic, '{"o_orderkey":"' || o_orderkey || '","o_custkey":"' || o_custkey || '"}' AS value
FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT 'dwd_order_change', '{"o_orderkey":"' || o_orderkey || '","o_orderstatus":"' || o_orderstatus || '"}'
FROM orders WHERE o_orderstatus = 'O'
UNION ALL SELECT 'dwd_line_new', '{"l_orderkey":"' || l_orderkey || '","l_linenumber":"' || l_linenumber || '"}'
FROM lineitem WHERE l_returnflag = 'N'""",
    "config_route_dim": f"""
SELECT 'dim_order' AS sink_table, 'info' AS sink_family, {_text('o_orderkey')} AS row_key, {ORDER_TYPE} AS type,
       'o_orderkey' AS col, {_text('o_orderkey')} AS val FROM orders
UNION ALL SELECT 'dim_order', 'info', {_text('o_orderkey')}, {ORDER_TYPE}, 'o_orderstatus', o_orderstatus FROM orders
UNION ALL SELECT 'dim_line', 'info', {LINE_ID}, {LINE_TYPE}, 'l_orderkey', {_text('l_orderkey')} FROM lineitem
UNION ALL SELECT 'dim_line', 'info', {LINE_ID}, {LINE_TYPE}, 'l_partkey', {_text('l_partkey')} FROM lineitem""",
    "dim_cell_merge": _folded(False),
    "dim_cell_merge_nulls": _folded(True),
    "config_feed": f"SELECT source_table, sink_table, op, ts_ms FROM ({FEED})",
    "config_current": """
SELECT s_name AS source_table, 'dim_' || s_name AS sink_table, 'a,b' AS sink_columns, 'info' AS sink_family,
       'id' AS sink_row_key
FROM supplier WHERE s_suppkey % 3 < 2""",
    "dim_registry": f"""
SELECT sink_table, CASE op WHEN 'c' THEN 'create' WHEN 'u' THEN 'recreate' ELSE 'drop' END AS action, ts_ms
FROM ({FEED})""",
    "dim_tables": """
SELECT 'dim_' || s_name AS sink_table, CASE WHEN s_suppkey % 3 = 1 THEN (s_suppkey * 10 + 2) || '-0' ELSE '0' END AS generation
FROM supplier WHERE s_suppkey % 3 < 2""",
    "upsert_latest": """
SELECT user_id, event_id, event_type, props FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1""",
    "upsert_with_deletes": """
SELECT * FROM (SELECT o_custkey, o_orderkey, o_orderstatus, o_orderpriority FROM orders
               QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1)
WHERE o_orderstatus <> 'P'""",
    "upsert_messages": """
SELECT '{"id":"' || o_orderkey || '"}' AS key,
       '{"id":"' || o_orderkey || '","status":"' || o_orderstatus || '"}' AS value FROM orders""",
    "log_cleanse": f"""
SELECT sid, {_text('user_id')} AS mid, CASE WHEN event_type <> 'signup' THEN 'item-' || k END AS item,
       CASE WHEN event_type = 'signup' THEN k END AS loading_time,
       CASE WHEN event_type <> 'signup' THEN CAST(k % 3 AS INTEGER) ELSE 0 END AS shown, ms AS ts
FROM ({LOG}) WHERE event_id % 10 > 3""",
    "visitor_fix": f"""
WITH l AS (SELECT sid, {_text('user_id')} AS mid, is_new, ms, CAST(make_timestamp(ms * 1000) AS DATE) AS day FROM ({LOG})),
     f AS (SELECT *, first_value(CASE is_new WHEN '1' THEN day ELSE day - 1 END)
                     OVER (PARTITION BY mid ORDER BY ms, is_new) AS first_day FROM l)
SELECT sid, mid, CASE WHEN is_new = '1' AND day <> first_day THEN '0' ELSE is_new END AS is_new, ms AS ts FROM f""",
    "log_page": LOG_PAGE,
    "log_start": LOG_START,
    "log_err": LOG_ERR,
    "log_display": LOG_DISPLAY,
    "log_action": LOG_ACTION,
    "log_split": " UNION ALL ".join([LOG_PAGE, LOG_START, LOG_ERR, LOG_DISPLAY, LOG_ACTION]),
    "search_keyword": f"""
SELECT 'item-' || k AS keyword, ms AS ts FROM ({LOG}) WHERE {FOUND}""",
    "search_keyword_json": f"""
SELECT 'item-' || k AS keyword, ms AS ts FROM ({LOG}) WHERE {FOUND}""",
    "keyword_window_count": f"""
SELECT ts // 600000 * 600000 AS window_start, keyword, count(*) AS views
FROM (SELECT ts, unnest(string_split(keyword, ' ')) AS keyword FROM ({PART_SEARCH})) GROUP BY 1, 2""",
    "keyword_tokens_regex": f"""
SELECT word, count(*) AS n
FROM (SELECT unnest(regexp_extract_all(keyword, '[a-z]+')) AS word FROM ({PART_SEARCH})) GROUP BY word""",
    "keyword_tokens_dictionary": """
WITH w AS (SELECT string_agg(w, '|' ORDER BY length(w) DESC, w) AS p
           FROM (SELECT DISTINCT unnest(string_split(p_name, ' ')) AS w FROM part))
SELECT p_partkey, unnest(regexp_extract_all(replace(p_name, ' ', ''), (SELECT p FROM w))) AS word FROM part""",
    "keyword_tokens_smart": """
WITH RECURSIVE names AS (SELECT p_partkey, replace(p_name, ' ', '') || '-' || p_partkey AS t, string_split(p_name, ' ') AS w FROM part),
listed AS (
  SELECT unnest(w) AS w FROM names UNION
  SELECT w[i] || left(w[i + 1], 2) FROM (SELECT w, unnest(range(1, len(w))) AS i FROM names)),
ends AS (SELECT p_partkey, t, unnest(range(1, length(t) + 1)) AS e FROM names),
edges AS (
  SELECT e.p_partkey, e.t, e.e, coalesce(list(length(l.w)) FILTER (l.w IS NOT NULL), []) AS sizes
  FROM ends e LEFT JOIN listed l ON length(l.w) <= e.e AND substring(e.t, e.e - length(l.w) + 1, length(l.w)) = l.w GROUP BY ALL),
graphs AS (SELECT p_partkey, t, list(sizes ORDER BY e) AS sizes FROM edges GROUP BY ALL),
scored AS (
  SELECT p_partkey, t, sizes, list_reduce(list_prepend([0::BIGINT], sizes), lambda best, own: list_append(best, greatest(
    best[len(best)], list_max(list_transform(own, lambda x: best[len(best) - x + 1] + x * 1000000000000 - 100000000 - x * x))))) AS best FROM graphs),
path AS (
  SELECT p_partkey, t, sizes, best, length(t) AS e, 0 AS size, false AS taken FROM scored UNION ALL
  SELECT p_partkey, t, sizes, best, e - greatest(step, 1), greatest(step, 1), step > 0 FROM (
    SELECT *, coalesce(list_max(list_filter(sizes[e], lambda x: best[e - x + 1] + x * 1000000000000 - 100000000 - x * x = best[e + 1])), 0) AS step
    FROM path WHERE e > 0)),
skipped AS (
  SELECT p_partkey, substring(t, e + 1, 1) AS c, e, e - row_number() OVER (PARTITION BY p_partkey ORDER BY e) AS run
  FROM path WHERE size > 0 AND NOT taken AND regexp_matches(substring(t, e + 1, 1), '[A-Za-z0-9]'))
SELECT p_partkey, substring(t, e + 1, size) AS word FROM path WHERE taken UNION ALL
SELECT p_partkey, string_agg(c, '' ORDER BY e) FROM skipped GROUP BY p_partkey, run""",
    "date_functions": f"""
SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%Y-%m-%d %H:%M:%S') AS moment,
       strftime(ts, '%Y%m%d') AS part, {_east('%Y-%m-%d')} AS day_east,
       epoch_us(ts) // 1000000 * 1000 AS back_ms,
       (epoch_us(ts) // 1000 + 28800000) // 86400000 * 86400000 - 28800000 AS midnight_ms
FROM events""",
}

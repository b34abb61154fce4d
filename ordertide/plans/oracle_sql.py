"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

The fragments below restate each operator in plain SQL over the driver's
tables, independently of the Spark code. Money stays DECIMAL(18,2) inside and
is cast to DOUBLE in the final projection, as the Spark queries do.
"""

from __future__ import annotations

from ordertide.config import Limits, TABLE_LIMITS


def facts_cte(line_price: str = "l_extendedprice") -> str:
    return f"""
li AS (
  SELECT l_orderkey AS orderkey,
         CAST(count(*) AS INTEGER) AS n_products,
         CAST(sum(CAST({line_price} AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS total,
         CAST(count(*) - count({line_price}) AS INTEGER) AS n_null_price
  FROM lineitem GROUP BY l_orderkey),
facts AS (
  SELECT CAST(o.o_orderkey AS VARCHAR) AS id, o.o_orderkey AS seq, o.o_orderdate AS ts,
         CAST(o.o_custkey AS VARCHAR) AS customerId,
         CAST(c.c_nationkey AS VARCHAR) AS marketId,
         coalesce(li.n_products, 0) AS n_products,
         coalesce(li.total, CAST(0 AS DECIMAL(18,2))) AS total,
         coalesce(li.n_null_price, 0) AS n_null_price
  FROM orders o
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN li ON li.orderkey = o.o_orderkey)"""


def enriched_cte(lim: Limits, line_price: str = "l_extendedprice") -> str:
    fault = (f"WHEN n_products = {lim.fault_count} THEN '/ by zero' "
             if lim.fault_count is not None else "")
    return facts_cte(line_price) + f""",
enriched_all AS (
  SELECT id, seq, ts, customerId, marketId, n_products, total,
         CASE {fault}WHEN n_null_price > 0 THEN 'product price is null' END AS error
  FROM facts),
enriched AS (
  SELECT id, seq, ts, customerId, marketId,
         CASE WHEN error IS NULL THEN n_products END AS productCount,
         CASE WHEN error IS NULL THEN total END AS price,
         CASE WHEN error IS NULL THEN 'NEW' END AS status,
         error
  FROM enriched_all),
success AS (SELECT * FROM enriched WHERE error IS NULL),
routed AS (
  SELECT *, CASE WHEN productCount >= {lim.full_cart} THEN 'full-cart'
                 WHEN productCount >= {lim.half_full_cart} THEN 'half-full-cart'
                 ELSE 'mini-cart' END AS route,
         price > CAST({lim.valuable_threshold} AS DECIMAL(18,2)) AS valuable
  FROM success)"""


def enriched_orders(lim: Limits = TABLE_LIMITS) -> str:
    return "WITH " + enriched_cte(lim) + """
SELECT id, customerId, marketId, productCount, CAST(price AS DOUBLE) AS price, status, error
FROM enriched"""


def route_summary(lim: Limits = TABLE_LIMITS) -> str:
    return "WITH " + enriched_cte(lim) + """,
all_routes AS (
  SELECT route, price, valuable FROM routed
  UNION ALL
  SELECT 'error' AS route, CAST(NULL AS DECIMAL(18,2)) AS price, false AS valuable
  FROM enriched WHERE error IS NOT NULL)
SELECT route, count(*) AS n_orders,
       CAST(coalesce(sum(price), 0) AS DOUBLE) AS revenue,
       CAST(count(*) FILTER (WHERE valuable) AS BIGINT) AS n_valuable
FROM all_routes GROUP BY route"""


def valuable_customers(lim: Limits = TABLE_LIMITS) -> str:
    return "WITH " + enriched_cte(lim) + """
SELECT id, customerId, marketId, productCount, CAST(price AS DOUBLE) AS price
FROM routed WHERE valuable"""


def full_mini_cart(lim: Limits = TABLE_LIMITS) -> str:
    return "WITH " + enriched_cte(lim) + """
SELECT id, productCount, CAST(price AS DOUBLE) AS price
FROM routed WHERE route IN ('full-cart', 'mini-cart')"""


def half_full_cart(lim: Limits = TABLE_LIMITS) -> str:
    return "WITH " + enriched_cte(lim) + """
SELECT id, customerId, marketId, productCount, CAST(price AS DOUBLE) AS price, status
FROM routed WHERE route = 'half-full-cart'"""


def topic_fanout(lim: Limits = TABLE_LIMITS) -> str:
    return "WITH " + enriched_cte(lim) + """,
fan AS (
  SELECT 'orders-full' AS topic, id FROM routed
  UNION ALL SELECT 'valuable-customer', id FROM routed WHERE valuable
  UNION ALL SELECT CASE WHEN route = 'half-full-cart' THEN 'half-full-cart' ELSE 'full-mini-cart' END, id
            FROM routed
  UNION ALL SELECT 'error-topic', id FROM enriched WHERE error IS NOT NULL)
SELECT topic, count(*) AS n_records FROM fan GROUP BY topic"""


def product_paths(lim: Limits = TABLE_LIMITS) -> str:
    return "WITH " + enriched_cte(lim) + """
SELECT CASE WHEN productCount % 2 = 0 THEN 'transactional' ELSE 'plain' END AS path,
       count(*) AS n_orders, CAST(sum(price) AS DOUBLE) AS revenue
FROM routed WHERE valuable GROUP BY 1"""


# --------------------------------------------------------------------------
# Reservation fold (R1/R2): a recursive CTE stepping rn -> rn + 1 per key.

def _side_params(side: str, lim: Limits) -> dict:
    if side == "pay":
        return dict(key="customerId", amt="price", init=f"CAST({lim.initial_credit} AS DECIMAL(18,2))",
                    guard=f"CAST({lim.price_guard} AS DECIMAL(18,2))", msg="Price is too high",
                    typ="DECIMAL(18,2)", zero="CAST(0 AS DECIMAL(18,2))", src="PAYMENT", delay=7)
    return dict(key="marketId", amt="productCount", init=f"{lim.initial_items}",
                guard=f"{lim.count_guard}", msg="Product Count is too high",
                typ="INTEGER", zero="0", src="STOCK", delay=23)


def fold_cte(side: str, lim: Limits) -> str:
    p = _side_params(side, lim)
    return f""",
{side}_ev AS (
  SELECT {p['key']} AS k, id, seq, ts, customerId, marketId, productCount, price, {p['amt']} AS amt,
         row_number() OVER (PARTITION BY {p['key']} ORDER BY ts, seq, id) AS rn
  FROM success WHERE {p['key']} IS NOT NULL),
{side}_fold AS (
  SELECT k, rn, id, seq, ts, customerId, marketId, productCount, price, amt,
         CASE WHEN amt <= {p['init']} THEN 'ACCEPT' ELSE 'REJECT' END AS status,
         CASE WHEN amt >= {p['guard']} THEN '{p['msg']}' END AS error,
         CAST(CASE WHEN amt >= {p['guard']} OR amt > {p['init']} THEN {p['init']}
                   ELSE {p['init']} - amt END AS {p['typ']}) AS available,
         CAST(CASE WHEN amt >= {p['guard']} OR amt > {p['init']} THEN {p['zero']}
                   ELSE amt END AS {p['typ']}) AS reserved
  FROM {side}_ev WHERE rn = 1
  UNION ALL
  SELECT e.k, e.rn, e.id, e.seq, e.ts, e.customerId, e.marketId, e.productCount, e.price, e.amt,
         CASE WHEN e.amt <= f.available THEN 'ACCEPT' ELSE 'REJECT' END,
         CASE WHEN e.amt >= {p['guard']} THEN '{p['msg']}' END,
         CAST(CASE WHEN e.amt >= {p['guard']} OR e.amt > f.available THEN f.available
                   ELSE f.available - e.amt END AS {p['typ']}),
         CAST(CASE WHEN e.amt >= {p['guard']} OR e.amt > f.available THEN f.reserved
                   ELSE f.reserved + e.amt END AS {p['typ']})
  FROM {side}_fold f JOIN {side}_ev e ON e.k = f.k AND e.rn = f.rn + 1),
{side}_balance AS (
  SELECT k, available, reserved FROM {side}_fold WHERE error IS NULL
  QUALIFY rn = max(rn) OVER (PARTITION BY k)),
{side}_replies AS (
  SELECT id, status, ts + to_seconds(CAST(seq % {p['delay']} AS BIGINT)) AS rts,
         customerId, marketId, productCount, price
  FROM {side}_fold WHERE error IS NULL AND status IN ('ACCEPT', 'REJECT'))"""


def saga_ctes(lim: Limits) -> str:
    return "WITH RECURSIVE " + enriched_cte(lim) + fold_cte("pay", lim) + fold_cte("stk", lim) + f""",
pairs AS (
  SELECT p.id, p.customerId, p.marketId, p.productCount, p.price,
         p.status AS p_status, s.status AS s_status, greatest(p.rts, s.rts) AS ts
  FROM pay_replies p JOIN stk_replies s
    ON p.id = s.id
   AND s.rts BETWEEN p.rts - INTERVAL {lim.join_window_seconds} SECOND
                 AND p.rts + INTERVAL {lim.join_window_seconds} SECOND),
decisions AS (
  SELECT id, customerId, marketId, productCount, price, ts,
         CASE WHEN p_status = 'ACCEPT' AND s_status = 'ACCEPT' THEN 'CONFIRMED'
              WHEN p_status = 'REJECT' AND s_status = 'REJECT' THEN 'REJECT'
              WHEN p_status = 'REJECT' OR s_status = 'REJECT' THEN 'ROLLBACK' END AS status,
         CASE WHEN (p_status = 'REJECT') <> (s_status = 'REJECT')
              THEN CASE WHEN p_status = 'REJECT' THEN 'PAYMENT' ELSE 'STOCK' END END AS source,
         CASE WHEN p_status IS NULL OR s_status IS NULL THEN 'null status'
              WHEN price IS NULL THEN 'price is null'
              WHEN price >= CAST({lim.price_guard if lim.decision_price_guard is None else lim.decision_price_guard} AS DECIMAL(18,2)) THEN 'Price is too high' END AS error
  FROM pairs)"""


def credit_reservation(lim: Limits = TABLE_LIMITS) -> str:
    return saga_ctes(lim) + """
SELECT id, k AS customerId, status, error,
       CAST(available AS DOUBLE) AS available, CAST(reserved AS DOUBLE) AS reserved
FROM pay_fold"""


def stock_reservation(lim: Limits = TABLE_LIMITS) -> str:
    return saga_ctes(lim) + """
SELECT id, k AS marketId, status, error, available, reserved
FROM stk_fold"""


def credit_balance(lim: Limits = TABLE_LIMITS) -> str:
    return saga_ctes(lim) + """
SELECT k AS customerId, CAST(available AS DOUBLE) AS available, CAST(reserved AS DOUBLE) AS reserved
FROM pay_balance"""


def stock_balance(lim: Limits = TABLE_LIMITS) -> str:
    return saga_ctes(lim) + """
SELECT k AS marketId, available, reserved FROM stk_balance"""


def order_decisions(lim: Limits = TABLE_LIMITS) -> str:
    return saga_ctes(lim) + """
SELECT id, customerId, marketId, productCount, CAST(price AS DOUBLE) AS price,
       status, source, error, ts
FROM decisions"""


def _settled(side: str, lim: Limits) -> str:
    p = _side_params(side, lim)
    own = p["src"]
    if lim.rollback_policy == "as_coded":
        release = f"source = '{own}'"
    else:
        release = f"source IS NOT NULL AND source <> '{own}'"
    cast = "DOUBLE" if side == "pay" else "BIGINT"
    return saga_ctes(lim) + f""",
deltas AS (
  SELECT {p['key']} AS k,
         sum(CASE WHEN status = 'ROLLBACK' AND {release} THEN {p['amt']} ELSE {p['zero']} END) AS d_available,
         sum(CASE WHEN status = 'CONFIRMED' OR (status = 'ROLLBACK' AND {release})
                  THEN -{p['amt']} ELSE {p['zero']} END) AS d_reserved,
         sum(CASE WHEN status = 'CONFIRMED' THEN {p['amt']} ELSE {p['zero']} END) AS settled
  FROM decisions
  WHERE error IS NULL AND {p['key']} IS NOT NULL AND {p['amt']} < {p['guard']}
  GROUP BY 1)
SELECT b.k AS {p['key']},
       CAST(b.available + coalesce(d.d_available, {p['zero']}) AS {cast}) AS available,
       CAST(b.reserved + coalesce(d.d_reserved, {p['zero']}) AS {cast}) AS reserved,
       CAST(coalesce(d.settled, {p['zero']}) AS {cast}) AS settled
FROM {side}_balance b LEFT JOIN deltas d ON b.k = d.k"""


def settled_credit(lim: Limits = TABLE_LIMITS) -> str:
    return _settled("pay", lim)


def settled_stock(lim: Limits = TABLE_LIMITS) -> str:
    return _settled("stk", lim)


# --------------------------------------------------------------------------
# Settlements between slices of two years (R5): the folds, decisions and balances of a
# slice start from the balances of the one before, written out slice by slice.

SLICES = range(1994 // 2, 2002 // 2 + 1)


def _slice_fold(side: str, lim: Limits, k: int, first: bool) -> str:
    p = _side_params(side, lim)
    start_a, start_r, join = p["init"], p["zero"], ""
    if not first:
        start_a, start_r = f"coalesce(b.available, {p['init']})", f"coalesce(b.reserved, {p['zero']})"
        join = f"LEFT JOIN {side}_bal_{k - 1} b ON b.k = e.{p['key']}"
    kept = f"e.amt >= {p['guard']} OR e.amt > f.available"
    return f""",
{side}_ev_{k} AS MATERIALIZED (
  SELECT e.{p['key']} AS k, e.id, e.seq, e.ts, e.customerId, e.marketId, e.productCount, e.price, e.{p['amt']} AS amt,
         CAST({start_a} AS {p['typ']}) AS start_a, CAST({start_r} AS {p['typ']}) AS start_r,
         row_number() OVER (PARTITION BY e.{p['key']} ORDER BY e.ts, e.seq, e.id) AS rn
  FROM success e {join} WHERE e.{p['key']} IS NOT NULL AND year(e.ts) // 2 = {k}),
{side}_step_{k} AS (
  SELECT k, CAST(0 AS BIGINT) AS rn, CAST(NULL AS VARCHAR) AS id, CAST(NULL AS VARCHAR) AS status, CAST(NULL AS VARCHAR) AS error,
         start_a AS available, start_r AS reserved
  FROM {side}_ev_{k} WHERE rn = 1
  UNION ALL
  SELECT e.k, e.rn, e.id, CASE WHEN e.amt <= f.available THEN 'ACCEPT' ELSE 'REJECT' END,
         CASE WHEN e.amt >= {p['guard']} THEN '{p['msg']}' END,
         CAST(CASE WHEN {kept} THEN f.available ELSE f.available - e.amt END AS {p['typ']}),
         CAST(CASE WHEN {kept} THEN f.reserved ELSE f.reserved + e.amt END AS {p['typ']})
  FROM {side}_step_{k} f JOIN {side}_ev_{k} e ON e.k = f.k AND e.rn = f.rn + 1),
{side}_fold_{k} AS MATERIALIZED (SELECT s.*, e.seq, e.ts, e.customerId, e.marketId, e.productCount, e.price
  FROM {side}_step_{k} s JOIN {side}_ev_{k} e ON e.k = s.k AND e.rn = s.rn),
{side}_replies_{k} AS (
  SELECT id, status, ts + to_seconds(CAST(seq % {p['delay']} AS BIGINT)) AS rts, customerId, marketId, productCount, price
  FROM {side}_fold_{k} WHERE error IS NULL)"""


def _slice_balance(side: str, lim: Limits, k: int, first: bool) -> str:
    p = _side_params(side, lim)
    release = f"source IS NOT NULL AND source <> '{p['src']}'"
    earlier = "" if first else f"""
    UNION ALL SELECT k, available, reserved, settled FROM {side}_bal_{k - 1} WHERE k NOT IN (SELECT k FROM {side}_fold_{k} WHERE error IS NULL)"""
    settled = p["zero"] if first else f"coalesce((SELECT b.settled FROM {side}_bal_{k - 1} b WHERE b.k = f.k), {p['zero']})"
    return f""",
{side}_now_{k} AS (
  SELECT k, available, reserved, {settled} AS settled FROM (
    SELECT k, available, reserved FROM {side}_fold_{k} WHERE error IS NULL QUALIFY rn = max(rn) OVER (PARTITION BY k)) f{earlier}),
{side}_delta_{k} AS (
  SELECT {p['key']} AS k, sum(CASE WHEN status = 'ROLLBACK' AND {release} THEN {p['amt']} ELSE {p['zero']} END) AS da,
         sum(CASE WHEN status = 'CONFIRMED' OR (status = 'ROLLBACK' AND {release}) THEN {p['amt']} ELSE {p['zero']} END) AS dr,
         sum(CASE WHEN status = 'CONFIRMED' THEN {p['amt']} ELSE {p['zero']} END) AS ds
  FROM decisions_{k} WHERE error IS NULL AND {p['key']} IS NOT NULL AND {p['amt']} < {p['guard']} GROUP BY 1),
{side}_bal_{k} AS MATERIALIZED (
  SELECT n.k, n.available + coalesce(d.da, {p['zero']}) AS available, n.reserved - coalesce(d.dr, {p['zero']}) AS reserved,
         n.settled + coalesce(d.ds, {p['zero']}) AS settled
  FROM {side}_now_{k} n LEFT JOIN {side}_delta_{k} d ON d.k = n.k)"""


def _slices(lim: Limits) -> str:
    sql = "WITH RECURSIVE " + enriched_cte(lim)
    for k in SLICES:
        first = k == SLICES[0]
        sql += _slice_fold("pay", lim, k, first) + _slice_fold("stk", lim, k, first) + f""",
decisions_{k} AS MATERIALIZED (
  SELECT p.id, p.customerId, p.marketId, p.productCount, p.price, greatest(p.rts, s.rts) AS ts,
         CASE WHEN p.status = 'ACCEPT' AND s.status = 'ACCEPT' THEN 'CONFIRMED'
              WHEN p.status = 'REJECT' AND s.status = 'REJECT' THEN 'REJECT' ELSE 'ROLLBACK' END AS status,
         CASE WHEN p.status <> s.status THEN CASE WHEN p.status = 'REJECT' THEN 'PAYMENT' ELSE 'STOCK' END END AS source,
         CASE WHEN p.price >= CAST({lim.price_guard} AS DECIMAL(18,2)) THEN 'Price is too high' END AS error
  FROM pay_replies_{k} p JOIN stk_replies_{k} s ON p.id = s.id
   AND s.rts BETWEEN p.rts - INTERVAL {lim.join_window_seconds} SECOND AND p.rts + INTERVAL {lim.join_window_seconds} SECOND)"""
        sql += _slice_balance("pay", lim, k, first) + _slice_balance("stk", lim, k, first)
    return sql


def interleaved_decisions(lim: Limits = TABLE_LIMITS) -> str:
    return _slices(lim) + "\n" + "\nUNION ALL ".join(
        f"SELECT id, customerId, marketId, CAST({k} AS INTEGER) AS slice, status, source, error, ts FROM decisions_{k}" for k in SLICES)


def interleaved_balances(lim: Limits = TABLE_LIMITS) -> str:
    return _slices(lim) + "\n" + "\nUNION ALL ".join(
        f"SELECT '{name}' AS side, k AS key, CAST(available AS DOUBLE) AS available, CAST(reserved AS DOUBLE) AS reserved, "
        f"CAST(settled AS DOUBLE) AS settled FROM {side}_bal_{SLICES[-1]}" for name, side in (("payment", "pay"), ("stock", "stk")))


def click_purchase_hours() -> str:
    return """
SELECT c.user_id, date_trunc('hour', c.ts) AS hour, count(DISTINCT c.event_id) AS n_clicks, count(p.event_id) AS n_pairs
FROM events c LEFT JOIN events p ON p.event_type = 'purchase' AND p.user_id = c.user_id
 AND p.ts BETWEEN c.ts - INTERVAL 1 HOUR AND c.ts + INTERVAL 1 HOUR
WHERE c.event_type = 'click' GROUP BY 1, 2"""


def late_replies(lim: Limits = TABLE_LIMITS) -> str:
    return saga_ctes(lim) + f"""
SELECT coalesce(p.id, s.id) AS id, p.status AS p_status, s.status AS s_status,
       CAST(abs(epoch_us(p.rts) - epoch_us(s.rts)) AS DOUBLE) / 1000000 AS apart,
       CASE WHEN p.id IS NULL THEN 'no payment reply' WHEN s.id IS NULL THEN 'no stock reply' ELSE 'too far apart' END AS reason
FROM pay_replies p FULL JOIN stk_replies s ON p.id = s.id
WHERE p.id IS NULL OR s.id IS NULL OR abs(epoch_us(p.rts) - epoch_us(s.rts)) > {lim.join_window_seconds} * 1000000"""


def error_topic(lim: Limits = TABLE_LIMITS) -> str:
    return saga_ctes(lim) + """
SELECT id AS key, 'enrich' AS stage, error AS message FROM enriched WHERE error IS NOT NULL
UNION ALL SELECT k, 'payment', error FROM pay_fold WHERE error IS NOT NULL
UNION ALL SELECT k, 'stock', error FROM stk_fold WHERE error IS NOT NULL
UNION ALL SELECT id, 'decision', error FROM decisions WHERE error IS NOT NULL"""


# --------------------------------------------------------------------------
# Latest per key (K1-K3).

def _order_records() -> str:
    return """,
recs AS (SELECT id, customerId, marketId, ts, seq, n_products AS productCount, total AS price FROM facts)"""


def latest_order_per_customer(lim: Limits = TABLE_LIMITS) -> str:
    return "WITH " + facts_cte() + _order_records() + """
SELECT customerId, id, ts, productCount, CAST(price AS DOUBLE) AS price FROM recs
QUALIFY row_number() OVER (PARTITION BY customerId ORDER BY ts DESC, seq DESC) = 1"""


def latest_event_per_user(lim: Limits = TABLE_LIMITS) -> str:
    return """
SELECT user_id, event_id, ts, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""


def current_orders(lim: Limits = TABLE_LIMITS) -> str:
    return "WITH " + facts_cte() + _order_records() + """
SELECT id, customerId, marketId, productCount, CAST(price AS DOUBLE) AS price FROM recs
QUALIFY row_number() OVER (PARTITION BY id ORDER BY ts DESC, seq DESC) = 1"""


def customer_order_lookup(lim: Limits = TABLE_LIMITS) -> str:
    return "WITH " + facts_cte() + _order_records() + """,
latest AS (SELECT * FROM recs
           QUALIFY row_number() OVER (PARTITION BY customerId ORDER BY ts DESC, seq DESC) = 1)
SELECT CAST(c.c_custkey AS VARCHAR) AS customerId, l.id IS NOT NULL AS found, l.id,
       CAST(l.price AS DOUBLE) AS price
FROM customer c LEFT JOIN latest l ON l.customerId = CAST(c.c_custkey AS VARCHAR)"""


# --------------------------------------------------------------------------
# Relational writes.

_SAVES = "marketId IS NOT NULL AND customerId IS NOT NULL AND productCount IS NOT NULL AND price IS NOT NULL"


def event_table(lim: Limits = TABLE_LIMITS) -> str:
    return "WITH " + enriched_cte(lim) + f"""
SELECT id AS event_id, marketId AS market_id, customerId AS customer_id, productCount AS product_count,
       CAST(price AS DOUBLE) AS price
FROM routed WHERE valuable AND {_SAVES}"""


def product_table(lim: Limits = TABLE_LIMITS) -> str:
    return "WITH " + enriched_cte(lim) + f"""
SELECT r.id AS event_id, 'part ' || CAST(l.l_partkey AS VARCHAR) AS name,
       CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS price
FROM routed r JOIN lineitem l ON l.l_orderkey = r.seq
WHERE valuable AND {_SAVES}"""


def event_not_null(lim: Limits = TABLE_LIMITS) -> str:
    return "WITH " + enriched_cte(lim) + f"""
SELECT id AS event_id, {_SAVES} AS ok,
       concat_ws(',', CASE WHEN marketId IS NULL THEN 'market_id' END,
                      CASE WHEN customerId IS NULL THEN 'customer_id' END,
                      CASE WHEN productCount IS NULL THEN 'product_count' END,
                      CASE WHEN price IS NULL THEN 'price' END) AS violations
FROM routed WHERE valuable"""


_UNNAMED = "CASE WHEN l_partkey % 89 <> 0 THEN 'part ' || CAST(l_partkey AS VARCHAR) END"


def event_checks(lim: Limits = TABLE_LIMITS) -> str:
    return "WITH " + enriched_cte(lim) + f""",
checked AS (
  SELECT id AS event_id, concat_ws(',', CASE WHEN marketId IS NULL THEN 'market_id' END, CASE WHEN customerId IS NULL THEN 'customer_id' END,
         CASE WHEN productCount IS NULL THEN 'product_count' END, CASE WHEN price IS NULL THEN 'price' END,
         CASE WHEN EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = routed.seq AND {_UNNAMED} IS NULL) THEN 'product.name' END,
         CASE WHEN EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = routed.seq AND l_extendedprice IS NULL) THEN 'product.price' END) AS violations
  FROM routed WHERE valuable)
SELECT event_id, violations = '' AS ok, violations FROM checked"""


def committed_products(lim: Limits = TABLE_LIMITS) -> str:
    return event_checks(lim).replace("SELECT event_id, violations = '' AS ok, violations FROM checked", "") + f"""
SELECT r.id AS event_id, r.marketId AS market_id, r.customerId AS customer_id, r.productCount AS product_count, CAST(r.price AS DOUBLE) AS price,
       {_UNNAMED} AS name, CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS product_price
FROM routed r JOIN checked c ON c.event_id = r.id JOIN lineitem l ON l.l_orderkey = r.seq
WHERE r.valuable AND c.violations = ''"""


_GAPS = "CASE WHEN l_partkey % 97 <> 0 THEN l_extendedprice END"


def product_not_null() -> str:
    return f"""
SELECT concat_ws(',', CASE WHEN l_partkey IS NULL THEN 'name' END, CASE WHEN {_GAPS} IS NULL THEN 'price' END,
                      CASE WHEN l_orderkey IS NULL THEN 'event_id' END) AS violations, count(*) AS n_rows
FROM lineitem GROUP BY 1"""


def enriched_with_gaps(lim: Limits = TABLE_LIMITS) -> str:
    return "WITH " + enriched_cte(lim, _GAPS) + """
SELECT id, productCount, CAST(price AS DOUBLE) AS price, status, error FROM enriched"""


def half_full_lookup(lim: Limits = TABLE_LIMITS) -> str:
    return "WITH " + enriched_cte(lim) + """,
latest AS (SELECT * FROM routed WHERE route = 'half-full-cart'
           QUALIFY row_number() OVER (PARTITION BY customerId ORDER BY ts DESC, seq DESC) = 1)
SELECT CAST(c.c_custkey AS VARCHAR) AS customerId, l.id IS NOT NULL AS found, l.id,
       CAST(l.price AS DOUBLE) AS price
FROM customer c LEFT JOIN latest l ON l.customerId = CAST(c.c_custkey AS VARCHAR)"""


def malformed_counts(lim: Limits = TABLE_LIMITS) -> str:
    return "WITH " + enriched_cte(lim) + """
SELECT 'order' AS kind, count(*) AS n_records, count(*) FILTER (WHERE seq % 11 = 0) AS n_dropped FROM success
UNION ALL SELECT 'text', count(*), count(*) FILTER (WHERE NOT coalesce(json_valid(text), true)) FROM documents
UNION ALL SELECT 'props', count(*), count(*) FILTER (WHERE NOT coalesce(json_valid(props), true)) FROM events"""


def replayed_records(lim: Limits = TABLE_LIMITS) -> str:
    return "WITH " + enriched_cte(lim) + """,
kept AS (
  SELECT 'order' AS kind, 'unknown status: SHIPPED' AS reason, id, true AS mended FROM success WHERE seq % 11 = 0
  UNION ALL SELECT 'text', 'unreadable', CAST(doc_id AS VARCHAR), false FROM documents WHERE NOT coalesce(json_valid(text), true)
  UNION ALL SELECT 'props', 'unreadable', CAST(event_id AS VARCHAR), false FROM events WHERE NOT coalesce(json_valid(props), true))
SELECT kind, reason, count(*) AS n_kept, count(*) FILTER (WHERE mended) AS n_replayed, count(*) FILTER (WHERE mended) AS n_back,
       count(DISTINCT id) FILTER (WHERE mended) AS n_keys
FROM kept GROUP BY kind, reason"""


def decoded_enriched_orders(lim: Limits = TABLE_LIMITS) -> str:
    return "WITH " + enriched_cte(lim) + """
SELECT id, productCount, CAST(price AS DOUBLE) AS price, status, error FROM enriched"""


def reply_records(lim: Limits = TABLE_LIMITS) -> str:
    return saga_ctes(lim) + """
SELECT 'payment-orders' AS topic, id AS key, status, rts AS ts FROM pay_replies
UNION ALL
SELECT 'stock-orders' AS topic, id AS key, status, rts AS ts FROM stk_replies"""


def decision_summary(lim: Limits = TABLE_LIMITS) -> str:
    return saga_ctes(lim) + """
SELECT status, source, error, count(*) AS n_orders, CAST(sum(price) AS DOUBLE) AS revenue
FROM decisions GROUP BY status, source, error"""


"""Carts, checkout, order arithmetic and basket rules."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfline.operators import baskets as B
from shelfline.operators import carts as C
from shelfline.operators.routing import union_all
from shelfline.plans import tables as t
from shelfline.plans.registry import query

# The SQL form replays resets with window maxima instead of per-cart aggregates.
LIVE = "WITH " + t.CART_ACTIONS + """,
resets AS (SELECT *, (ts, seq) AS pos, max(CASE WHEN action = 'CLEAR' THEN (ts, seq) END) OVER (PARTITION BY cart_id) AS cleared,
                  max(CASE WHEN action = 'REMOVE' THEN (ts, seq) END) OVER (PARTITION BY cart_id, product_id) AS removed
           FROM cart_actions),
live AS (SELECT * FROM resets WHERE action IN ('ADD', 'UPDATE_QUANTITY') AND (cleared IS NULL OR pos > cleared) AND (removed IS NULL OR pos > removed)),
firsts AS (SELECT cart_id, product_id, min(pos) AS first_at, arg_min(price_cents, pos) AS price, arg_min(quantity, pos) AS q0,
                  sum(quantity) AS q, sum(price_cents * quantity) AS cents, count(*) AS lines FROM live WHERE action = 'ADD' GROUP BY 1, 2),
last_update AS (SELECT cart_id, product_id, arg_max(quantity, pos) AS qs FROM live JOIN firsts USING (cart_id, product_id)
                WHERE action = 'UPDATE_QUANTITY' AND pos > first_at GROUP BY 1, 2),
last_any AS (SELECT cart_id, product_id, arg_max(quantity, pos) AS qs FROM live JOIN firsts USING (cart_id, product_id)
             WHERE pos > first_at GROUP BY 1, 2),
appended AS (SELECT cart_id, product_id, CAST(q + coalesce(qs, q0) - q0 AS BIGINT) AS quantity, price AS price_cents,
                    CAST(cents + (coalesce(qs, q0) - q0) * price AS BIGINT) AS line_cents, lines
             FROM firsts LEFT JOIN last_update USING (cart_id, product_id)),
upserted AS (SELECT cart_id, product_id, CAST(coalesce(qs, q0) AS BIGINT) AS quantity, price AS price_cents, CAST(coalesce(qs, q0) * price AS BIGINT) AS line_cents,
                    CAST(1 AS BIGINT) AS lines FROM firsts LEFT JOIN last_any USING (cart_id, product_id))"""


@query("cart_append", LIVE + " SELECT * FROM appended")
def cart_append(spark, folder):
    return C.fold_cart(t.cart_actions(spark, folder), "append")


@query("cart_upsert", LIVE + " SELECT * FROM upserted")
def cart_upsert(spark, folder):
    return C.fold_cart(t.cart_actions(spark, folder), "upsert")


@query(
    "cart_summary",
    LIVE + """ SELECT cart_id, CAST(sum(quantity) AS BIGINT) AS item_count, CAST(sum(line_cents) AS BIGINT) AS total_cents,
       CAST(sum(lines) AS BIGINT) AS lines FROM appended GROUP BY 1""",
)
def cart_summary(spark, folder):
    return C.cart_summary(C.fold_cart(t.cart_actions(spark, folder), "append"))


@query(
    "cart_totals",
    "WITH " + t.CART_ACTIONS + """,
log AS (SELECT *, (ts, seq) AS at FROM cart_actions WHERE action IN ('ADD', 'REMOVE'))
SELECT e.cart_id, e.ts, e.seq, e.action, e.product_id,
       CAST(coalesce(sum(a.price_cents * a.quantity), 0) AS BIGINT) AS total_cents, CAST(coalesce(sum(a.quantity), 0) AS BIGINT) AS item_count
FROM log e LEFT JOIN log a ON a.cart_id = e.cart_id AND a.action = 'ADD' AND a.at <= e.at
  AND NOT EXISTS (SELECT 1 FROM log r WHERE r.cart_id = a.cart_id AND r.product_id = a.product_id AND r.action = 'REMOVE' AND r.at > a.at AND r.at <= e.at)
GROUP BY ALL""",
)
def cart_totals(spark, folder):
    out = C.cart_totals(t.cart_actions(spark, folder))
    return out.select("cart_id", "ts", "seq", "action", "product_id", "total_cents", "item_count")


@query(
    "capped_adds",
    "WITH " + t.CART_ACTIONS + """,
adds AS (SELECT *, sum(quantity) OVER (PARTITION BY cart_id, product_id ORDER BY ts, seq ROWS UNBOUNDED PRECEDING) AS wanted
         FROM cart_actions WHERE action = 'ADD'),
capped AS (SELECT *, least(wanted, coalesce(p_size, 0)) AS final, least(wanted - quantity, coalesce(p_size, 0)) AS held FROM adds LEFT JOIN part ON p_partkey = product_id)
SELECT cart_id, product_id, ts, seq, quantity, CAST(final AS BIGINT) AS final_quantity FROM capped WHERE wanted = quantity OR final > held""",
)
def capped_adds(spark, folder):
    stock = t.table(spark, folder, "part").select(F.col("p_partkey").alias("product_id"), F.col("p_size").alias("inventory"))
    adds = t.cart_actions(spark, folder).where("action = 'ADD'")
    return C.capped_adds(adds, stock).select("cart_id", "product_id", "ts", "seq", "quantity", "final_quantity")


REQUESTS = """requests AS (
  SELECT c_custkey AS session_id, CASE WHEN c_nationkey % 2 = 0 THEN 'user-' || c_custkey END AS user_id FROM customer
  UNION ALL SELECT NULL, 'nobody-' || s_suppkey FROM supplier)"""


def requests(spark, folder):
    """A checkout for every customer's session, with and without a cart, and one without a session per supplier."""
    sessions = t.table(spark, folder, "customer").select(
        F.col("c_custkey").alias("session_id"),
        F.when(F.col("c_nationkey") % 2 == 0, F.concat(F.lit("user-"), F.col("c_custkey").cast("string"))).alias("user_id"),
    )
    lost = t.table(spark, folder, "supplier").select(
        F.lit(None).cast("long").alias("session_id"), F.concat(F.lit("nobody-"), F.col("s_suppkey").cast("string")).alias("user_id")
    )
    return union_all(sessions, lost)


@query(
    "checkout",
    LIVE + ", " + REQUESTS + """,
carts AS (SELECT cart_id AS session_id, sum(quantity) AS item_count, sum(line_cents) AS cents FROM upserted GROUP BY 1),
used AS (SELECT DISTINCT user_id FROM events),
j AS (SELECT r.session_id, r.user_id, c.session_id IS NOT NULL AS ok, u.user_id IS NOT NULL AS used, item_count, CAST(cents AS BIGINT) AS cents,
             CAST(cents AS BIGINT) * 8 AS tax_100
      FROM requests r LEFT JOIN carts c ON c.session_id = r.session_id LEFT JOIN used u ON u.user_id = r.session_id)
SELECT session_id, coalesce(user_id, 'guest') AS user_id, CASE WHEN ok THEN 'CONFIRMED' ELSE 'REJECTED' END AS status,
       CASE WHEN session_id IS NULL THEN 'Session ID is missing.' WHEN NOT used THEN 'Cart not found.' WHEN NOT ok THEN 'Cart is empty' END AS reject_reason,
       CAST(CASE WHEN ok THEN item_count END AS BIGINT) AS item_count,
       cents AS subtotal_cents, (tax_100 + 50) // 100 AS tax_cents, CASE WHEN ok THEN 599 END AS shipping_cents,
       cents + (tax_100 + 50) // 100 + 599 AS total_cents
FROM j""",
)
def checkout(spark, folder):
    actions = t.cart_actions(spark, folder)
    out = C.checkout(requests(spark, folder), C.fold_cart(actions, "upsert"), actions)
    whole = lambda c: (F.col(c) * 100).cast("long")
    return out.select(
        "session_id", "user_id", "status", "reject_reason", "item_count",
        whole("subtotal").alias("subtotal_cents"), whole("tax").alias("tax_cents"),
        whole("shipping").cast("int").alias("shipping_cents"), whole("total_amount").alias("total_cents"),
    )


@query(
    "cart_estimate",
    LIVE + """,
carts AS (SELECT cart_id, CAST(sum(line_cents) AS BIGINT) AS cents FROM upserted GROUP BY 1)
SELECT cart_id, cents AS subtotal_cents, CASE WHEN cents > 5000 THEN 0 ELSE 599 END AS shipping_cents,
       cents + (cents * 8 + 50) // 100 + CASE WHEN cents > 5000 THEN 0 ELSE 599 END AS total_cents FROM carts""",
)
def cart_estimate(spark, folder):
    summary = C.cart_summary(C.fold_cart(t.cart_actions(spark, folder), "upsert"))
    out = C.estimate(summary)
    return out.select(
        "cart_id", (F.col("subtotal") * 100).cast("long").alias("subtotal_cents"),
        (F.col("shipping") * 100).cast("int").alias("shipping_cents"),
        (F.col("total_amount") * 100).cast("long").alias("total_cents"),
    )


@query(
    "order_lines",
    """SELECT l_orderkey AS order_id, l_linenumber AS line_no, CAST(l_quantity AS INT) AS quantity,
       CAST(round(p_retailprice * 100) AS BIGINT) AS price_cents, CAST(round(p_retailprice * 100) AS BIGINT) * CAST(l_quantity AS INT) AS line_total_cents,
       0 AS discount_cents FROM lineitem JOIN part ON p_partkey = l_partkey""",
)
def order_lines(spark, folder):
    part = t.table(spark, folder, "part").select("p_partkey", F.round(F.col("p_retailprice") * 100).cast("long").alias("price_cents"))
    lines = t.table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_no"),
        F.col("l_quantity").cast("int").alias("quantity"), "l_partkey",
    )
    joined = lines.join(part, lines.l_partkey == part.p_partkey).select("order_id", "line_no", "quantity", "price_cents")
    return C.order_lines(joined)


@query(
    "item_events",
    """SELECT o_orderkey AS order_id, unnest([o_custkey % 200, o_orderkey % 200]) AS product_id, unnest([1, 2]) AS quantity,
       epoch_ms(o_orderdate) AS timestamp FROM orders WHERE o_orderstatus <> 'F'""",
)
def item_events(spark, folder):
    line = lambda product, quantity: F.struct(product.alias("product_id"), F.lit(quantity).alias("quantity"))
    orders = t.table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.array(line(F.col("o_custkey") % 200, 1), line(F.col("o_orderkey") % 200, 2)).alias("items"),
        t.millis("o_orderdate").alias("ts"),
        (F.col("o_orderstatus") == "F").alias("use_cdc"),
    )
    return C.item_events(orders)


@query(
    "available_stock",
    """SELECT p_partkey AS product_id, coalesce(p_size - reserved, 0) AS available
FROM part LEFT JOIN (SELECT l_partkey, CAST(count(*) AS INT) AS reserved FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1) ON l_partkey = p_partkey""",
)
def available_stock(spark, folder):
    reserved = (
        t.table(spark, folder, "lineitem").where("l_linestatus = 'O'").groupBy(F.col("l_partkey").alias("p_partkey"))
        .agg(F.count("*").cast("int").alias("reserved"))
    )
    part = t.table(spark, folder, "part").join(reserved, "p_partkey", "left")
    return part.select(F.col("p_partkey").alias("product_id"), C.available(F.col("p_size"), F.col("reserved")).alias("available"))


@query(
    "checkouts_over_time",
    "WITH " + t.CART_ACTIONS + """,
log AS (SELECT *, row_number() OVER (PARTITION BY cart_id ORDER BY ts, seq) AS n FROM cart_actions),
-- Every 9th action of a cart is a checkout; carts of the form action log with sessions that end in a checkout.
marked AS (SELECT *, n % 9 = 0 AS checks, count(CASE WHEN n % 9 = 0 THEN 1 END) OVER (PARTITION BY cart_id ORDER BY ts, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS e FROM log),
acts AS (SELECT *, (ts, seq) AS pos, max(CASE WHEN action = 'CLEAR' THEN (ts, seq) END) OVER (PARTITION BY cart_id, e) AS cleared,
                max(CASE WHEN action = 'REMOVE' THEN (ts, seq) END) OVER (PARTITION BY cart_id, e, product_id) AS removed FROM marked WHERE NOT checks),
live AS (SELECT * FROM acts WHERE action IN ('ADD', 'UPDATE_QUANTITY') AND (cleared IS NULL OR pos > cleared) AND (removed IS NULL OR pos > removed)),
firsts AS (SELECT cart_id, e, product_id, min(pos) AS first_at, arg_min(price_cents, pos) AS price, arg_min(quantity, pos) AS q0 FROM live WHERE action = 'ADD' GROUP BY 1, 2, 3),
lasts AS (SELECT cart_id, e, product_id, arg_max(quantity, pos) AS qs FROM live JOIN firsts USING (cart_id, e, product_id) WHERE pos > first_at GROUP BY 1, 2, 3),
carts AS (SELECT cart_id, e, sum(coalesce(qs, q0)) AS item_count, sum(coalesce(qs, q0) * price) AS cents FROM firsts LEFT JOIN lasts USING (cart_id, e, product_id) GROUP BY 1, 2)
SELECT cart_id, ts, seq, CASE WHEN cents IS NULL THEN 'Cart is empty' END AS reject_reason, CAST(item_count AS BIGINT) AS item_count, CAST(cents AS BIGINT) AS total_cents
FROM marked LEFT JOIN carts USING (cart_id, e) WHERE checks""",
)
def checkouts_over_time(spark, folder):
    nth = F.row_number().over(Window.partitionBy("cart_id").orderBy("ts", "seq"))
    log = t.cart_actions(spark, folder).withColumn("action", F.when(nth % 9 == 0, "CHECKOUT").otherwise(F.col("action")))
    return C.checkouts(log).select("cart_id", "ts", "seq", "reject_reason", "item_count", "total_cents")


@query(
    "basket_context",
    LIVE + """ SELECT cart_id, count(*) AS basket_size, CAST(sum(price_cents) AS BIGINT) AS basket_value_cents
FROM upserted GROUP BY 1""",
)
def basket_context(spark, folder):
    return C.basket_context(C.fold_cart(t.cart_actions(spark, folder), "upsert"))


@query(
    "basket_rules",
    """WITH b AS (SELECT DISTINCT l_orderkey AS o, p_brand AS i FROM lineitem JOIN part ON p_partkey = l_partkey),
n AS (SELECT count(DISTINCT o) AS n FROM b), s AS (SELECT i, count(*) AS c FROM b GROUP BY 1),
p AS (SELECT x.i AS a, y.i AS c, count(*) AS k FROM b x JOIN b y ON x.o = y.o AND x.i <> y.i GROUP BY 1, 2)
SELECT a AS antecedent, p.c AS consequent, round(k::DOUBLE / s.c, 9) AS confidence, k AS together, n AS baskets
FROM p JOIN s ON s.i = a, n WHERE k >= ceil(0.01::DOUBLE * n)""",
)
def basket_rules(spark, folder):
    part = t.table(spark, folder, "part").select("p_partkey", "p_brand")
    lines = t.table(spark, folder, "lineitem").select("l_orderkey", "l_partkey")
    rules = B.pair_rules(lines.join(part, lines.l_partkey == part.p_partkey), "l_orderkey", "p_brand", 0.01)
    return rules.select("antecedent", "consequent", F.round("confidence", 9).alias("confidence"), "together", "baskets")

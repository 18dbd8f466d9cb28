"""Change logs applied to tables, values as of a row's own time, and questions answered from stored totals and indexes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.functions import records as R
from shelfline.operators import panes as P
from shelfline.operators import sessions as S
from shelfline.operators import text_index as X
from shelfline.operators import versions as V
from shelfline.operators.baskets import as_recommendations, pair_rules
from shelfline.operators.timers import number_sessions
from shelfline.plans import tables as t
from shelfline.plans.quiet import DAY, SESSIONS
from shelfline.plans.read_model import ALL
from shelfline.plans.registry import query
from shelfline.session import new_folder

HOUR = 3_600_000
LINE_ROW = "order_item_id: BIGINT, order_id: STRING, product_id: STRING, quantity: INT"


def change_messages(spark: SparkSession, folder: str) -> DataFrame:
    """A change log of order lines: inserts, updates that come in the wrong order, deletions, tombstones, new inserts of deleted lines, repeated records."""
    line, key = F.col("l_linenumber"), F.col("l_orderkey") * 8 + F.col("l_linenumber")
    ship, units = t.millis("l_shipdate"), F.col("l_quantity").cast("int")

    def record(op: str, after_ms: int, more: int, when=None):
        row = F.struct(
            key.alias("order_item_id"), F.col("l_orderkey").cast("string").alias("order_id"), F.col("l_partkey").cast("string").alias("product_id"), (units + more).alias("quantity")
        )
        source = F.struct(F.lit("order_items").alias("table"), (ship + after_ms).alias("lsn"))
        body = F.to_json(F.struct(F.lit(op).alias("op"), (ship + after_ms).alias("ts_ms"), source.alias("source"), row.alias("before" if op == "d" else "after")))
        found = F.struct((ship + after_ms).alias("timestamp"), body.alias("value"))
        return found if when is None else F.when(when, found)

    tombstone = F.when(line == 5, F.struct((ship + 3 * HOUR).alias("timestamp"), F.lit(None).cast("string").alias("value")))
    records = F.array(
        record("c", 0, 0),
        record("u", 2 * HOUR, 1, line % 2 == 0),
        record("u", HOUR, 100, line % 2 == 0),
        record("d", 3 * HOUR, 0, line == 3),
        tombstone,
        record("c", 4 * HOUR, 7, (line == 3) & (F.col("l_orderkey") % 2 == 0)),
    )
    sent = F.filter(records, lambda r: r.isNotNull())
    sent = F.when(F.col("l_suppkey") % 3 == 0, F.concat(F.reverse(sent), sent)).otherwise(sent)
    return t.table(spark, folder, "lineitem").select(F.to_json(F.struct(key.alias("order_item_id"))).alias("key"), F.explode(sent).alias("m")).select("key", "m.*")


@query(
    "cdc_applied",
    f"""WITH l AS (SELECT l_orderkey * 8 + l_linenumber AS id, l_orderkey, l_partkey, l_linenumber AS line, CAST(l_quantity AS INT) AS q, epoch_ms(l_shipdate) AS ship FROM lineitem),
log AS (
  SELECT id, l_orderkey, l_partkey, q, ship AS ts, false AS gone FROM l
  UNION ALL SELECT id, l_orderkey, l_partkey, q + 1, ship + {2 * HOUR}, false FROM l WHERE line % 2 = 0
  UNION ALL SELECT id, l_orderkey, l_partkey, q + 100, ship + {HOUR}, false FROM l WHERE line % 2 = 0
  UNION ALL SELECT id, NULL, NULL, NULL, ship + {3 * HOUR}, true FROM l WHERE line IN (3, 5)
  UNION ALL SELECT id, l_orderkey, l_partkey, q + 7, ship + {4 * HOUR}, false FROM l WHERE line = 3 AND l_orderkey % 2 = 0),
last AS (SELECT * FROM log QUALIFY row_number() OVER (PARTITION BY id ORDER BY ts DESC, gone DESC, CAST(l_orderkey AS VARCHAR) DESC, CAST(l_partkey AS VARCHAR) DESC, q DESC) = 1)
SELECT id AS order_item_id, CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_partkey AS VARCHAR) AS product_id, q AS quantity FROM last WHERE NOT gone""",
)
def cdc_applied(spark: SparkSession, folder: str) -> DataFrame:
    """The order lines that the change log leaves."""
    log = R.change_log(change_messages(spark, folder), "order_items", LINE_ROW, "order_item_id")
    return V.apply_changes(log, ["order_item_id"], ["ts"])


@query(
    "cart_prices_as_of",
    "WITH " + t.EVENTS + """,
prices AS (SELECT product_id, ts, max(CAST(round(value * 100) AS BIGINT)) AS price_cents FROM tracked WHERE event_type = 'CATEGORY_BROWSE' GROUP BY 1, 2),
now AS (SELECT product_id, arg_max(price_cents, ts) AS price_now_cents FROM prices GROUP BY 1),
adds AS (SELECT event_id, user_id AS cart_id, product_id, ts FROM tracked WHERE event_type IN ('PRODUCT_VIEW', 'RECOMMENDATION_CLICKED'))
SELECT event_id, cart_id, adds.product_id, adds.ts, prices.price_cents, price_now_cents
FROM adds ASOF LEFT JOIN prices ON adds.product_id = prices.product_id AND adds.ts >= prices.ts LEFT JOIN now ON now.product_id = adds.product_id""",
)
def cart_prices_as_of(spark: SparkSession, folder: str) -> DataFrame:
    """The price of each cart line when it was added, and today's; a product's prices are the values of its browse events."""
    events, cents = t.events(spark, folder), F.round(F.col("value") * 100).cast("long")
    prices = events.where(F.col("event_type") == "CATEGORY_BROWSE").select("product_id", "ts", cents.alias("price_cents"))
    adds = events.where(F.col("event_type").isin("PRODUCT_VIEW", "RECOMMENDATION_CLICKED")).select("event_id", F.col("user_id").alias("cart_id"), "product_id", "ts")
    now = prices.groupBy("product_id").agg(F.max_by("price_cents", F.struct("ts", "price_cents")).alias("price_now_cents"))
    return V.as_of(adds, prices, ["product_id"], ["price_cents"]).join(now, "product_id", "left")


@query(
    "rule_routes_as_of",
    """WITH o AS (SELECT o_orderkey AS order_id, o_orderpriority AS priority, o_totalprice AS total, epoch_ms(o_orderdate) AS ts FROM orders),
versions AS (SELECT priority, rule_id, ts, arg_max(active, (active, at_least)) AS active, arg_max(at_least, (active, at_least)) AS at_least
             FROM (SELECT priority, order_id % 3 AS rule_id, ts, order_id % 10 <> 0 AS active, total AS at_least FROM o WHERE order_id % 50 < 5) GROUP BY 1, 2, 3),
asked AS (SELECT * FROM o JOIN (SELECT DISTINCT priority, rule_id FROM versions) USING (priority))
SELECT order_id, 'rule ' || asked.rule_id AS output
FROM asked ASOF JOIN versions v ON asked.priority = v.priority AND asked.rule_id = v.rule_id AND asked.ts >= v.ts
WHERE v.active AND total >= v.at_least""",
)
def rule_routes_as_of(spark: SparkSession, folder: str) -> DataFrame:
    """Orders routed by the rules of their day: five orders in fifty set or end one of three rules of its priority."""
    key, total = F.col("o_orderkey"), F.col("o_totalprice")
    orders = t.table(spark, folder, "orders").select(key.alias("order_id"), F.col("o_orderpriority").alias("priority"), total.alias("total"), t.millis("o_orderdate").alias("ts"))
    order_id = F.col("order_id")
    rules = orders.where(order_id % 50 < 5).select(
        "priority", (order_id % 3).alias("rule_id"), "ts", (order_id % 10 != 0).alias("active"), F.col("total").alias("at_least"),
        F.lit(None).cast("double").alias("below"), F.concat(F.lit("rule "), (order_id % 3).cast("string")).alias("output"),
    )
    return V.rules_as_of(orders, rules, "priority", "total").select("order_id", "output")


GAP, LEAST_SESSIONS = 3, 2
_RULES = f"""
steps AS (SELECT user_id, session_no, product_id, ts, row_number() OVER (PARTITION BY user_id, session_no ORDER BY ts, event_id) AS p FROM numbered),
held AS (SELECT DISTINCT user_id, session_no, product_id FROM steps),
sessions AS (SELECT count(*) AS sessions FROM (SELECT DISTINCT user_id, session_no FROM steps)),
having_it AS (SELECT product_id, count(*) AS n FROM held GROUP BY 1)"""


@query(
    "session_rules",
    SESSIONS + "," + _RULES + f""",
pairs AS (SELECT DISTINCT a.user_id, a.session_no, a.product_id AS antecedent, b.product_id AS consequent
          FROM steps a JOIN steps b ON a.user_id = b.user_id AND a.session_no = b.session_no AND b.p BETWEEN a.p + 1 AND a.p + {GAP} AND a.product_id <> b.product_id),
counted AS (SELECT antecedent, consequent, count(*) AS together FROM pairs GROUP BY 1, 2 HAVING count(*) >= {LEAST_SESSIONS})
SELECT antecedent, consequent, together, together / n AS confidence, together / sessions AS support
FROM counted JOIN having_it ON antecedent = product_id, sessions""",
)
def session_rules(spark: SparkSession, folder: str) -> DataFrame:
    """SESSION_BASED: what follows what within three steps of a session."""
    numbered = number_sessions(t.events(spark, folder), DAY // 2, order=("ts", "event_id"))
    return S.session_rules(numbered, "user_id", "session_no", "product_id", GAP, LEAST_SESSIONS, order=("ts", "event_id"))


@query(
    "view_rules",
    SESSIONS + f""",
bought AS (SELECT DISTINCT user_id || '-' || session_no AS basket, product_id FROM numbered WHERE event_type = 'PRODUCT_VIEW'),
baskets AS (SELECT count(DISTINCT basket) AS n FROM bought),
frequent AS (SELECT product_id, count(*) AS n FROM bought GROUP BY 1 HAVING count(*) >= 0.001 * (SELECT n FROM baskets)),
pairs AS (SELECT a.product_id AS trigger, b.product_id AS other, count(*) AS together FROM bought a JOIN bought b ON a.basket = b.basket AND a.product_id <> b.product_id
          WHERE a.product_id IN (SELECT product_id FROM frequent) AND b.product_id IN (SELECT product_id FROM frequent) GROUP BY 1, 2)
SELECT 'VIEW_BASED' AS recommendation_type, trigger, [other] AS recommended_products, together / n AS confidence, CAST(0 AS BIGINT) AS timestamp
FROM pairs JOIN frequent ON trigger = product_id WHERE together >= 0.001 * (SELECT n FROM baskets)""",
)
def view_rules(spark: SparkSession, folder: str) -> DataFrame:
    """VIEW_BASED: what is viewed in the same session, as recommendation messages."""
    numbered = number_sessions(t.events(spark, folder), DAY // 2, order=("ts", "event_id"))
    views = numbered.where("event_type = 'PRODUCT_VIEW'").select(F.concat_ws("-", "user_id", "session_no").alias("basket"), "product_id")
    return as_recommendations(pair_rules(views, "basket", "product_id", 0.001), "VIEW_BASED", F.lit(0).cast("long"))


@query(
    "sliding_panes",
    """WITH e AS (SELECT event_type AS category, epoch_us(ts) // 1000 AS ts, CAST(round(value * 100) AS BIGINT) AS cents, user_id FROM events),
w AS (SELECT category, (ts // 600000 - k) * 600000 AS window_start, cents, user_id FROM e, range(36) r(k))
SELECT category, window_start, count(*) AS n, CAST(sum(cents) AS BIGINT) AS total, CAST(sum(cents) AS DOUBLE) / count(*) AS mean, min(cents) AS least, max(cents) AS most,
       count(DISTINCT user_id) AS members FROM w GROUP BY 1, 2""",
)
def sliding_panes(spark: SparkSession, folder: str) -> DataFrame:
    """Six-hour windows every ten minutes; the sketches are exact for the few users of a window here."""
    events = t.table(spark, folder, "events").select(
        F.col("event_type").alias("category"), t.millis("ts").alias("ts"), F.round(F.col("value") * 100).cast("long").alias("cents"), "user_id"
    )
    return P.sliding_by_panes(events, ["category"], 6 * HOUR, HOUR // 6, "cents", "user_id")


@query(
    "active_users_range",
    """WITH e AS (SELECT epoch_us(ts) // 3600000000 AS hour, user_id, CAST(round(value * 100) AS BIGINT) AS cents FROM events),
asked AS (SELECT DISTINCT (hour // 24 - k) * 24 AS first_hour FROM e, range(7) r(k))
SELECT first_hour, count(*) AS n, true AS members_within_5_percent, true AS median_within_2_percent FROM asked JOIN e ON hour >= first_hour AND hour < first_hour + 168 GROUP BY 1""",
)
def active_users_range(spark: SparkSession, folder: str) -> DataFrame:
    """Active users and the median value of every seven days, from stored hours; compared with the exact ones of the raw events."""
    events = t.events(spark, folder).select("ts", "user_id", F.round(F.col("value") * 100).cast("long").alias("cents"))
    path = new_folder(spark)
    P.store_hourly(events, path, "user_id", "cents")
    hours = P.stored_hours(spark, path)
    first = F.explode(F.sequence((F.col("day") - 6) * 24, F.col("day") * 24, F.lit(24)))
    asked = hours.select("day").distinct().select(first.alias("first_hour"), F.lit(168).cast("long").alias("hours")).distinct()
    told = P.over_ranges(hours, asked, (0.5,))
    day = F.explode(F.sequence((P.pane_of("ts", DAY) - 6) * 24, P.pane_of("ts", DAY) * 24, F.lit(24)))
    raw = events.withColumn("first_hour", day)
    # The share of values up to the told median; the sketch's error is in ranks.
    exact = raw.join(told.select("first_hour", "q50"), "first_hour").groupBy("first_hour").agg(
        F.count_distinct("user_id").alias("users"),
        (F.count_if(F.col("cents") < F.col("q50")) / F.count("*")).alias("below"),
        (F.count_if(F.col("cents") <= F.col("q50")) / F.count("*")).alias("upto"),
    )
    near = F.abs(F.col("members") - F.col("users")) <= F.greatest(F.col("users") * 0.05, F.lit(1.0))
    middle = (F.col("below") <= 0.52) & (F.col("upto") >= 0.48)
    return told.join(exact, "first_hour").select("first_hour", "n", near.alias("members_within_5_percent"), middle.alias("median_within_2_percent"))


@query(
    "indexed_search",
    "WITH " + t.CATALOGUE + f", words AS (SELECT unnest(['small', 'Blue', 'zzz', 'ed']) AS word)"
    f" SELECT word, {ALL} FROM catalogue, words WHERE contains(lower(name), lower(word)) OR contains(lower(description), lower(word))",
)
def indexed_search(spark: SparkSession, folder: str) -> DataFrame:
    """Four words looked up in an index of the catalogue's trigrams; the last one is too short for it."""
    products, path = t.catalogue(spark, folder), new_folder(spark)
    X.write_index(products, path, "product_id", ["name", "description"])
    out = None
    for word in ("small", "Blue", "zzz", "ed"):
        found = X.indexed_search(products, path, "product_id", ["name", "description"], word).select(F.lit(word).alias("word"), *ALL.split(", "))
        out = found if out is None else out.unionByName(found)
    return out

"""The product view and the reads on it."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfline.operators import catalog as G
from shelfline.operators import views as V
from shelfline.operators.keyed import last_n, latest, order_by_key, running
from shelfline.plans import tables as t
from shelfline.plans.registry import query

DESC = ", ".join(c + " DESC" for c in t.LINE_ORDER)


@query(
    "latest_product",
    "WITH " + t.PRODUCT_UPDATES + f"""
SELECT product_id, ts, order_id, line_no, supplier_id, amount, inventory, price, name
FROM product_updates QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY {DESC}) = 1""",
)
def latest_product(spark, folder):
    return latest(t.product_updates(spark, folder), ["product_id"], t.LINE_ORDER)


@query(
    "product_view",
    "WITH " + t.LEDGER_ROWS + f""",
full_rows AS (SELECT * FROM ledger_rows WHERE kind = 'PRODUCT' QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY {DESC}) = 1),
after AS (SELECT l.*, CASE WHEN l.line_no % 2 = 0 THEN l.qty END AS new_inv, CASE WHEN l.line_no % 3 = 0 THEN l.amount END AS new_price
          FROM ledger_rows l JOIN full_rows f USING (product_id)
          WHERE l.kind = 'ORDER' AND (l.ts, l.order_id, l.line_no, l.supplier_id, l.amount) > (f.ts, f.order_id, f.line_no, f.supplier_id, f.amount)),
inv AS (SELECT product_id, new_inv FROM after WHERE new_inv IS NOT NULL QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY {DESC}) = 1),
pri AS (SELECT product_id, new_price FROM after WHERE new_price IS NOT NULL QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY {DESC}) = 1)
SELECT f.product_id, f.name, f.ts, coalesce(new_inv, f.inventory) AS inventory, coalesce(new_price, f.price) AS price
FROM full_rows f LEFT JOIN inv USING (product_id) LEFT JOIN pri USING (product_id)""",
)
def product_view(spark, folder):
    rows = t.ledger_rows(spark, folder)
    full = rows.where("kind = 'PRODUCT'").select("product_id", *t.LINE_ORDER, "inventory", "price", "name")
    partial = rows.where("kind = 'ORDER'").select(
        "product_id", *t.LINE_ORDER,
        F.when(F.col("line_no") % 2 == 0, F.col("qty")).alias("inventory"),
        F.when(F.col("line_no") % 3 == 0, F.col("amount")).alias("price"),
    )
    return V.merge_partial(full, partial, order=t.LINE_ORDER).select("product_id", "name", "ts", "inventory", "price")


@query(
    "field_upsert",
    """WITH r AS (SELECT l_partkey AS product_id, l_orderkey AS o, l_linenumber AS n, l_suppkey AS s, l_extendedprice AS a,
       CASE WHEN l_linenumber % 2 = 0 THEN l_returnflag END AS flag, CASE WHEN l_linenumber % 3 = 0 THEN l_linestatus END AS status FROM lineitem),
f AS (SELECT product_id, flag FROM r WHERE flag IS NOT NULL QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY o DESC, n DESC, s DESC, a DESC) = 1),
g AS (SELECT product_id, status FROM r WHERE status IS NOT NULL QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY o DESC, n DESC, s DESC, a DESC) = 1)
SELECT DISTINCT r.product_id, f.flag, g.status FROM r LEFT JOIN f USING (product_id) LEFT JOIN g USING (product_id)""",
)
def field_upsert(spark, folder):
    line = F.col("l_linenumber")
    rows = t.table(spark, folder, "lineitem").select(
        F.col("l_partkey").alias("product_id"),
        F.col("l_orderkey").alias("o"), line.alias("n"), F.col("l_suppkey").alias("s"), F.col("l_extendedprice").alias("a"),
        F.when(line % 2 == 0, F.col("l_returnflag")).alias("flag"),
        F.when(line % 3 == 0, F.col("l_linestatus")).alias("status"),
    )
    return V.upsert_fields(rows, ["product_id"], ("o", "n", "s", "a")).select("product_id", "flag", "status")


@query(
    "cart_lookup",
    "WITH " + t.EVENTS + """,
asked AS (SELECT event_id, CASE WHEN event_id % 4 = 0 THEN 1000000000 + product_id ELSE product_id END AS product_id FROM tracked)
SELECT event_id, product_id, p_partkey IS NOT NULL AS found, p_name AS name, p_retailprice AS price
FROM asked LEFT JOIN part ON p_partkey = product_id""",
)
def cart_lookup(spark, folder):
    """Products of events; every fourth asks for one that does not exist."""
    view = t.table(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("name"), F.col("p_retailprice").alias("price")
    )
    product = F.col("product_id")
    asked = t.events(spark, folder).select(
        "event_id", F.when(F.col("event_id") % 4 == 0, product + 1_000_000_000).otherwise(product).alias("product_id")
    )
    return V.looked_up(asked, view)


@query(
    "recommended_products",
    """WITH r AS (SELECT s_suppkey AS user_id, unnest([s_suppkey * 7 % 250, s_suppkey * 11 % 250, 1000000 + s_suppkey, s_suppkey * 13 % 250]) AS product_id,
       unnest([0, 1, 2, 3]) AS position FROM supplier)
SELECT user_id, CAST(position AS INT) AS position, product_id, p_name AS name FROM r JOIN part ON p_partkey = product_id""",
)
def recommended_products(spark, folder):
    key = F.col("s_suppkey")
    recs = t.table(spark, folder, "supplier").select(
        key.alias("user_id"),
        F.array(key * 7 % 250, key * 11 % 250, F.lit(1_000_000) + key, key * 13 % 250, key % 250).alias("recommended_products"),
    )
    view = t.catalogue(spark, folder).select("product_id", "name")
    return V.recommended_products(recs, view)


@query(
    "orders_with_items",
    """SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS status, l_linenumber AS line_no, l_partkey AS product_id,
       CAST(l_quantity AS INT) AS quantity FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey""",
)
def orders_with_items(spark, folder):
    orders = t.table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"), F.col("o_orderstatus").alias("status")
    )
    items = t.table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_no"),
        F.col("l_partkey").alias("product_id"), F.col("l_quantity").cast("int").alias("quantity"),
    )
    return V.orders_with_items(orders, items)


@query(
    "preferred_language",
    """WITH s AS (SELECT 'src-' || source AS user_id, doc_id AS seq, CASE WHEN n_chars % 3 = 0 THEN 'DEFAULT' ELSE upper(lang) END AS language FROM documents)
SELECT user_id, language FROM (SELECT user_id, arg_max(language, seq) AS language FROM s GROUP BY 1) WHERE language <> 'DEFAULT'""",
)
def preferred_language(spark, folder):
    settings = t.table(spark, folder, "documents").select(
        F.concat(F.lit("src-"), "source").alias("user_id"),
        F.col("doc_id").alias("seq"),
        F.when(F.col("n_chars") % 3 == 0, "DEFAULT").otherwise(F.upper("lang")).alias("language"),
    )
    return V.preferred_language(settings, ("seq",)).select("user_id", "language")


ALL = "product_id, name, category, price"


@query("list_products", "WITH " + t.CATALOGUE + f" SELECT {ALL} FROM catalogue WHERE lower(category) = 'promo' ORDER BY product_id LIMIT 20")
def list_products(spark, folder):
    return G.list_products(t.catalogue(spark, folder), category="promo").select(*ALL.split(", "))


@query(
    "search_listing",
    "WITH " + t.CATALOGUE + f" SELECT {ALL} FROM catalogue WHERE contains(lower(name), 'ring') OR contains(lower(description), 'ring') ORDER BY product_id LIMIT 20",
)
def search_listing(spark, folder):
    return G.list_products(t.catalogue(spark, folder), search="Ring").select(*ALL.split(", "))


@query(
    "search_products",
    "WITH " + t.CATALOGUE + f""" SELECT {ALL} FROM catalogue
WHERE contains(lower(name), 'small') OR contains(lower(description), 'small') OR contains(lower(category), 'small') OR contains(lower(brand), 'small')""",
)
def search_products(spark, folder):
    return G.search_products(t.catalogue(spark, folder), "SMALL").select(*ALL.split(", "))


@query(
    "document_search",
    "SELECT doc_id, lang, source FROM documents WHERE contains(lower(text), 'license')",
)
def document_search(spark, folder):
    """The text search over whole documents."""
    docs = t.table(spark, folder, "documents").select("doc_id", "lang", "source", F.col("text").alias("description"), F.lit(None).cast("string").alias("name"))
    return docs.where(G.matches("license")).select("doc_id", "lang", "source")


@query(
    "browse_products",
    "WITH " + t.CATALOGUE + f""" SELECT {ALL}, CAST(row_number() OVER (ORDER BY price DESC, product_id) AS BIGINT) AS rank FROM catalogue
WHERE category = 'LARGE' AND price BETWEEN 905 AND 980 AND (contains(lower(name), 'red') OR contains(lower(description), 'red') OR contains(lower(brand), 'red'))""",
)
def browse_products(spark, folder):
    """All matches in price order; `rank` numbers the sorted rows."""
    page = G.browse(t.catalogue(spark, folder), "LARGE", "red", (905, 980), "price-high").select(*ALL.split(", "))
    return _ranked(page)


def _ranked(page):
    """Number products by falling price, then id: within a price, and ahead of it by counts per price."""
    keyed = order_by_key(page, ["price"], ["product_id"])
    inside = keyed.finish(running(keyed, keyed.df, {"_at": ("count", F.col("product_id"))}))
    dearer = Window.partitionBy(F.lit(0)).orderBy(F.col("price").desc()).rowsBetween(Window.unboundedPreceding, -1)
    ahead = (
        page.groupBy("price")
        .agg(F.count("*").alias("_n"))
        # One row per price between the bounds of the page, at most one per cent of money.
        .select("price", F.coalesce(F.sum("_n").over(dearer), F.lit(0)).alias("_ahead"))
    )
    return inside.join(ahead, "price").withColumn("rank", F.col("_ahead") + F.col("_at")).drop("_ahead", "_at")


@query("trending", "WITH " + t.CATALOGUE + " SELECT product_id, review_count FROM catalogue ORDER BY review_count DESC, product_id LIMIT 8")
def trending(spark, folder):
    return G.trending(t.catalogue(spark, folder)).select("product_id", "review_count")


@query("featured", "WITH " + t.CATALOGUE + " SELECT product_id, rating FROM catalogue WHERE rating >= 4.0 ORDER BY product_id LIMIT 8")
def featured(spark, folder):
    return G.featured(t.catalogue(spark, folder)).select("product_id", "rating")


@query(
    "featured_by_score",
    "WITH " + t.CATALOGUE + " SELECT product_id, rating * review_count AS score FROM catalogue ORDER BY score DESC, product_id LIMIT 8",
)
def featured_by_score(spark, folder):
    return G.featured_by_score(t.catalogue(spark, folder)).select("product_id", "score")


@query("first_recommendation", "SELECT list(p_partkey ORDER BY p_partkey) AS recommended_products FROM (SELECT p_partkey FROM part ORDER BY p_partkey LIMIT 5)")
def first_recommendation(spark, folder):
    return G.first_recommendation(t.catalogue(spark, folder))


@query(
    "unseen_recommendations",
    "WITH " + t.CATALOGUE + """,
cand AS (SELECT product_id FROM catalogue ORDER BY review_count DESC, product_id LIMIT 5),
seen AS (SELECT DISTINCT l_orderkey AS session_id, l_partkey AS product_id FROM lineitem)
SELECT o_orderkey AS session_id, product_id, CASE WHEN EXISTS (SELECT 1 FROM seen s WHERE s.session_id = o_orderkey) THEN 'PERSONALIZED' ELSE 'TRENDING_NOW' END AS type,
       CASE WHEN EXISTS (SELECT 1 FROM seen s WHERE s.session_id = o_orderkey) THEN 'Based on your recent activity' ELSE 'Trending products' END AS reason
FROM orders, cand WHERE NOT EXISTS (SELECT 1 FROM seen s WHERE s.session_id = o_orderkey AND s.product_id = cand.product_id)""",
)
def unseen_recommendations(spark, folder):
    sessions = t.table(spark, folder, "orders").select(F.col("o_orderkey").alias("session_id"))
    seen = t.table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("session_id"), F.col("l_partkey").alias("product_id")
    ).distinct()
    return G.unseen_recommendations(sessions, seen, t.catalogue(spark, folder))


@query(
    "last_orders",
    """SELECT o_custkey AS user_id, o_orderkey AS order_id, CAST(position AS INT) AS position FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS position FROM orders) WHERE position <= 5""",
)
def last_orders(spark, folder):
    orders = t.table(spark, folder, "orders").select(
        F.col("o_custkey").alias("user_id"), t.millis("o_orderdate").alias("ts"), F.col("o_orderkey").alias("order_id")
    )
    return last_n(orders, ["user_id"], ["ts", "order_id"], 5).select("user_id", "order_id", "position")


@query(
    "recent_points",
    """SELECT event_id, epoch_us(ts) // 1000 AS ts, value FROM events
WHERE epoch_us(ts) // 1000 > (SELECT max(epoch_us(ts) // 1000) FROM events) - 86400000""",
)
def recent_points(spark, folder):
    points = t.table(spark, folder, "events").select("event_id", t.millis("ts").alias("ts"), "value")
    return G.recent_points(points, 86_400_000)

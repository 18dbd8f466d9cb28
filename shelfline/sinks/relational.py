"""Relational tables: catalogue load, orders with their lines, JDBC writes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.operators.carts import available

# Defaults of a new inventory row.
RESERVED, REORDER_POINT, REORDER_QUANTITY = 0, 10, 20


def catalogue_rows(products: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Parsed products as rows of the `products` and `inventory` tables."""
    head = products.select(
        F.col("productId").alias("product_id"), "name", "description",
        F.col("price").cast("decimal(10,2)").alias("price"), "category", "brand",
        F.col("imageUrl").alias("image_url"), "tags", "rating", F.col("reviewCount").alias("review_count"),
    )
    stock = products.select(
        F.col("productId").alias("product_id"),
        F.col("inventory").alias("on_hand"),
        F.lit(RESERVED).alias("reserved"),
        F.lit(REORDER_POINT).alias("reorder_point"),
        F.lit(REORDER_QUANTITY).alias("reorder_quantity"),
    ).withColumn("available", available(F.col("on_hand"), F.col("reserved")))
    return head, stock


def catalogue_load_rows(products: DataFrame) -> DataFrame:
    """Parsed products as rows for both tables at once, tagged with `table_name`; the texts are parsed once."""
    reserved = F.lit(RESERVED)
    stock = {"on_hand": F.col("inventory"), "reserved": reserved, "reorder_point": F.lit(REORDER_POINT), "reorder_quantity": F.lit(REORDER_QUANTITY), "available": available(F.col("inventory"), reserved)}
    head = {
        "name": F.col("name"), "description": F.col("description"), "price": F.col("price").cast("decimal(10,2)"), "category": F.col("category"),
        "brand": F.col("brand"), "image_url": F.col("imageUrl"), "tags": F.col("tags"), "rating": F.col("rating"), "review_count": F.col("reviewCount"),
    }
    tagged = products.withColumn("table_name", F.explode(F.array(F.lit("products"), F.lit("inventory"))))

    def only(table: str, columns: dict) -> list:
        return [F.when(F.col("table_name") == table, c).alias(name) for name, c in columns.items()]

    return tagged.select(F.col("productId").alias("product_id"), "table_name", *only("products", head), *only("inventory", stock))


def stamp_update(df: DataFrame) -> DataFrame:
    """Set the modification time in whichever column the table has for it."""
    for col in ("updated_at", "last_updated"):
        if col in df.columns:
            return df.withColumn(col, F.current_timestamp())
    return df


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None, batch: int = 5000) -> dict[str, str]:
    options = {"url": url, "dbtable": table, "batchsize": str(batch), "stringtype": "unspecified"}
    if user:
        options["user"] = user
    if password:
        options["password"] = password
    return options


def write_jdbc(df: DataFrame, mode: str = "append", **options: str) -> None:
    df.write.format("jdbc").options(**options).mode(mode).save()


def order_tables(orders: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Confirmed orders and their lines as rows of the `orders` and `order_items` tables."""
    money = "decimal(12,2)"
    head = orders.where(F.col("status") == "CONFIRMED").select(
        "order_id", F.col("user_id").alias("customer_id"), F.timestamp_millis("ts").alias("order_date"), "status",
        *(F.col(c).cast(money).alias(c) for c in ("subtotal", "tax", "shipping", "total_amount")),
    )
    lines = items.join(head.select("order_id"), "order_id", "left_semi").select(
        "order_id", "product_id", "quantity",
        *((F.col(f"{c}_cents") / 100).cast("decimal(10,2)").alias(name)
          for c, name in (("price", "unit_price"), ("discount", "discount"), ("line_total", "line_total"))),
    )
    return head, lines


def merge_statement(target: str, staged: str, keys: Sequence[str], columns: Sequence[str]) -> str:
    """Standard SQL that brings the rows of table `staged` into `target`: rows with a known key are set anew, others inserted."""
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    rest = [c for c in columns if c not in keys]
    change = f" WHEN MATCHED THEN UPDATE SET {', '.join(f'{c} = s.{c}' for c in rest)}" if rest else ""
    return (
        f"MERGE INTO {target} AS t USING {staged} AS s ON ({on}){change}"
        f" WHEN NOT MATCHED THEN INSERT ({', '.join(columns)}) VALUES ({', '.join(f's.{c}' for c in columns)})"
    )


def order_sink(head: dict[str, str], lines: dict[str, str], items_of, run=None, write=write_jdbc, line_keys: Sequence[str] = ("order_id", "product_id")):
    """A `foreachBatch` function over orders that merges them into the two tables over JDBC; `items_of(orders)` gives a batch's order lines.

    A batch's rows go to tables named after the batch, which replace themselves when the batch is retried. Then one transaction merges both into
    their targets and drops them: that is the commit point, after which a retry merges the same rows again without a change. `run(options, statements)` runs the
    statements in one transaction, by default over JDBC from the driver. Lines of an order that share the `line_keys` have to be summed before.
    """
    run = run or run_jdbc

    def sink(orders: DataFrame, batch_id: int) -> None:
        order_rows, item_rows = (stamp_update(df) for df in order_tables(orders, items_of(orders)))
        done, gone = [], []
        for rows, options, keys in ((order_rows, head, ("order_id",)), (item_rows, lines, tuple(line_keys))):
            staged = f"{options['dbtable']}_{batch_id}"
            write(rows, "overwrite", **{**options, "dbtable": staged})
            done.append(merge_statement(options["dbtable"], staged, keys, rows.columns))
            gone.append(f"DROP TABLE {staged}")
        run(head, done + gone)

    return sink


def run_jdbc(options: dict[str, str], statements: Sequence[str]) -> None:
    """Run statements in one transaction on the database of JDBC `options`."""
    spark = SparkSession.getActiveSession()
    jvm = spark.sparkContext._jvm
    login = jvm.java.util.Properties()
    for name in ("user", "password"):
        if name in options:
            login.setProperty(name, options[name])
    connection = jvm.java.sql.DriverManager.getConnection(options["url"], login)
    try:
        connection.setAutoCommit(False)
        for text in statements:
            statement = connection.createStatement()
            statement.executeUpdate(text)
            statement.close()
        connection.commit()
    except Exception:
        connection.rollback()
        raise
    finally:
        connection.close()

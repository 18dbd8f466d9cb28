"""JSON text to typed records and back, with rejected records kept beside the valid ones.

Scalars are read as text and cast here, so that `"7"` and `2.7` become the integers 7 and 2 and a
missing or null number becomes 0, as senders of these topics expect. A product record with an unknown
field or an unreadable number is rejected whole; a product array is accepted only as a whole.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline import schemas as S

SPACE = " \t\r\n\f"
VALUE = "value"


class Parsed(NamedTuple):
    """`tagged` has every record once, `reject_reason` null on valid ones; the others are its slices."""

    tagged: DataFrame
    valid: DataFrame
    dead: DataFrame


def _split(tagged: DataFrame, fields: list[str], raw: list[str]) -> Parsed:
    ok = F.col("reject_reason").isNull()
    kept = [c for c in raw if c != VALUE]
    return Parsed(
        tagged,
        tagged.where(ok).select(*kept, *fields),
        tagged.where(~ok).select(*raw, "reject_reason"),
    )


def parse_once(df: DataFrame, name: str, parsed: Column) -> DataFrame:
    """Add an expensive expression as a column that later filters cannot pull it out of.

    A filter on a plain column is pushed below it and repeats its expression for every use; one on
    the output of a generator stays above, so each record is parsed once.
    """
    return df.select("*", F.explode(F.array(parsed)).alias(name))


def field_names(ddl: str) -> list[str]:
    return [part.strip().split(" ")[0].rstrip(":") for part in _top_level(ddl)]


def _top_level(ddl: str) -> list[str]:
    parts, depth = [""], 0
    for ch in ddl:
        depth += (ch in "<(") - (ch in ">)")
        if ch == "," and depth == 0:
            parts.append("")
        else:
            parts[-1] += ch
    return parts


def to_int(text: Column) -> Column:
    """Integer of a number in text form, fraction cut off; null when it is none."""
    return text.try_cast("double").try_cast("int")


def trimmed(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACE))


# ---- Products ------------------------------------------------------------------------------------

_PRODUCT_INTS = ("inventory", "reviewCount")
_PRODUCT_DOUBLES = ("price", "rating")


def parse_products(df: DataFrame) -> Parsed:
    """Text to products: an object is one, an array many, blank text none.

    Text that is neither, malformed JSON, unknown fields and values of a wrong type are rejected: an object or array in a text or
    number field, tags that are no list of plain values, an array element that is no object. Numbers and texts stand for each
    other where they can be read; null array elements are skipped. One wrong record rejects its whole text.
    """
    names = field_names(S.PRODUCT)
    body = trimmed(F.col(VALUE))
    is_array, is_object = body.startswith("["), body.startswith("{")
    whole = F.try_parse_json(body)
    records = F.when(is_array, F.try_variant_get(whole, "$", "array<variant>")).when(is_object & whole.isNotNull(), F.array(whole))
    elements = F.transform(
        F.filter(records, lambda v: ~F.is_variant_null(v)),
        lambda v: F.struct(F.try_variant_get(v, "$", "map<string,variant>").alias("v")),
    )

    def nested(v: Column) -> Column:
        return F.coalesce(F.schema_of_variant(v).rlike("^(OBJECT|ARRAY)"), F.lit(False))

    def bad_field(field: Column) -> Column:
        name, v = field["key"], field["value"]
        text, tags = F.try_variant_get(v, "$", "string"), F.try_variant_get(v, "$", "array<variant>")
        given = v.isNotNull() & ~F.is_variant_null(v)
        return (
            F.when(name == "tags", F.coalesce(given & (tags.isNull() | F.exists(tags, nested)), F.lit(False)))
            .when(~name.isin(names) | nested(v), True)
            .when(name.isin(*_PRODUCT_INTS), text.isNotNull() & to_int(text).isNull())
            .when(name.isin(*_PRODUCT_DOUBLES), text.isNotNull() & text.try_cast("double").isNull())
            .otherwise(False)
        )

    def unreadable(e: Column) -> Column:
        # Only the fields that are there: a look at every known name costs most on records that have few.
        return F.when(e["v"].isNull(), True).otherwise(F.exists(F.map_entries(e["v"]), bad_field))

    reason = (
        F.when(~is_array & ~is_object, "not JSON")
        .when(F.col("_elements").isNull(), "malformed JSON")
        .when(F.exists("_elements", unreadable), "unknown field or unreadable value")
    )
    read = parse_once(df.where((body != "") & body.isNotNull()), "_elements", elements)
    read = parse_once(read, "reject_reason", reason)
    # A rejected text gives one row without a product.
    kept = F.when(F.col("reject_reason").isNull(), F.col("_elements.v"))
    none = F.array(F.lit(None).cast("map<string,variant>"))
    tagged = read.withColumn("_m", F.explode(F.coalesce(kept, none))).drop("_elements")

    def typed(name: str) -> Column:
        v = F.col("_m")[name]
        c = F.try_variant_get(v, "$", "array<string>" if name == "tags" else "string")
        if name in _PRODUCT_INTS:
            c = F.coalesce(to_int(c), F.lit(0))
        elif name in _PRODUCT_DOUBLES:
            c = F.coalesce(c.try_cast("double"), F.lit(0.0))
        return F.when(F.col("reject_reason").isNull(), c).alias(name)

    tagged = tagged.select(*df.columns, *(typed(n) for n in names), "reject_reason")
    return _split(tagged, names, df.columns)


# ---- Order items ---------------------------------------------------------------------------------


def _node_text(name: str) -> Column:
    """A JSON field as text: empty when absent, the word `null` when it is null."""
    value = F.col("_m")[name]
    return F.when(value.isNotNull(), value).when(F.map_contains_key("_m", name), F.lit("null")).otherwise("")


def _node_long(name: str) -> Column:
    value = F.col("_m")[name]
    return F.coalesce(value.try_cast("long"), value.try_cast("double").try_cast("long"), F.lit(0).cast("long"))


def parse_order_items(df: DataFrame) -> Parsed:
    """Text to order items; without order, product or a positive quantity they are rejected."""
    read = parse_once(df, "_m", F.from_json(VALUE, "map<string,string>")).select(
        *df.columns,
        F.col("_m").isNull().alias("_broken"),
        _node_text("orderId").alias("orderId"),
        _node_text("productId").alias("productId"),
        F.coalesce(to_int(F.col("_m")["quantity"]), F.lit(0)).alias("quantity"),
        _node_long("timestamp").alias("timestamp"),
    )
    reason = (
        F.when(F.col("_broken"), "malformed JSON")
        .when(F.col("orderId") == "", "no orderId")
        .when(F.col("productId") == "", "no productId")
        .when(F.col("quantity") <= 0, "quantity not positive")
    )
    tagged = read.withColumn("reject_reason", reason).drop("_broken")
    return _split(tagged, field_names(S.ORDER_ITEM), df.columns)


# ---- Change records ------------------------------------------------------------------------------


def change_records(df: DataFrame) -> DataFrame:
    """Change-capture text as one typed `r` column, parsed once."""
    return parse_once(df, "r", F.from_json(VALUE, S.CHANGE_RECORD))


def inserted(df: DataFrame, table: str) -> DataFrame:
    """Inserts into one table; malformed text, other tables, updates and deletes drop out."""
    return change_records(df).where(
        (F.col("r.op") == "c") & (F.col("r.source.table") == table) & F.col("r.after").isNotNull()
    )


def cdc_order_items(df: DataFrame) -> DataFrame:
    """Inserted order lines as order events. `order_item_id` stays, to tell equal lines apart."""
    return inserted(df, "order_items").select(
        *[c for c in df.columns if c != VALUE],
        F.coalesce(F.col("r.after.order_id"), F.lit("")).alias("orderId"),
        F.coalesce(F.col("r.after.product_id"), F.lit("")).alias("productId"),
        F.coalesce(to_int(F.col("r.after.quantity")), F.lit(0)).alias("quantity"),
        F.coalesce(F.col("r.ts_ms"), F.lit(0).cast("long")).alias("timestamp"),
        F.col("r.after.order_item_id").alias("order_item_id"),
    )


def cdc_orders(df: DataFrame) -> DataFrame:
    """Inserted order headers as order-placed rows."""
    return inserted(df, "orders").select(
        *[c for c in df.columns if c != VALUE],
        F.col("r.after.order_id").alias("orderId"),
        F.lit("ORDER_PLACED").alias("eventType"),
        F.col("r.ts_ms").alias("timestamp"),
    )


def change_log(df: DataFrame, table: str, row: str, key: str) -> DataFrame:
    """Change-capture text of one table as (`key`, ts, lsn, op, row), for `apply_changes` in order of (ts, lsn).

    `df` has the message's `key` and `value` text and its `timestamp`; `row` is the schema of the table's rows. Inserts, updates and
    snapshot reads set the row, deletions and tombstones (a null value) remove it. Malformed text, other tables and records without a key drop out.
    """
    schema = f"op STRING, ts_ms BIGINT, source STRUCT<table: STRING, lsn: BIGINT>, before STRUCT<{row}>, after STRUCT<{row}>"
    read = parse_once(df, "r", F.from_json(VALUE, schema))
    tombstone = F.col(VALUE).isNull()
    kind = read.select(F.col(f"r.after.{key}")).schema[0].dataType
    found = F.coalesce(f"r.after.{key}", f"r.before.{key}", F.get_json_object("key", f"$.{key}").try_cast(kind))
    ours = (F.col("r.source.table") == table) & F.col("r.op").isin("c", "u", "r", "d")
    return read.where(tombstone | ours).select(
        found.alias(key),
        F.coalesce("r.ts_ms", "timestamp").alias("ts"),
        F.coalesce("r.source.lsn", F.lit(0).cast("long")).alias("lsn"),
        F.when(tombstone, "d").otherwise(F.col("r.op")).alias("op"),
        F.when(~tombstone & (F.col("r.op") != "d"), F.col("r.after")).alias("row"),
    ).where(F.col(key).isNotNull())


# ---- Inventory events and alerts -----------------------------------------------------------------


def _blank(c: str) -> Column:
    return F.col(c).isNull() | (F.trim(F.col(c)) == "")


def _violations(rules: dict[str, Column]) -> Column:
    return F.filter(
        F.array(*(F.when(broken, F.lit(text)) for text, broken in rules.items())), lambda v: v.isNotNull()
    )


def validate_events(df: DataFrame) -> DataFrame:
    """Add `violations`, the rules an inventory event breaks as `rule:field`, and default the low-stock level."""
    kind = F.col("eventType")
    rules = {
        "missing:productId": _blank("productId"),
        "missing:productName": _blank("productName"),
        "missing:eventType": kind.isNull(),
        "unknown:eventType": kind.isNotNull() & ~kind.isin(*S.INVENTORY_EVENT_TYPES),
        "not-positive:timestamp": F.coalesce("timestamp", F.lit(0)) <= 0,
        **{f"negative:{c}": F.col(c) < 0 for c in ("previousInventory", "currentInventory", "previousPrice", "currentPrice")},
        "missing:currentInventory": kind.isin("INVENTORY_INCREASED", "INVENTORY_DECREASED") & F.col("currentInventory").isNull(),
        "missing:currentPrice": (kind == "PRICE_CHANGED") & F.col("currentPrice").isNull(),
        "not-zero:currentInventory": (kind == "OUT_OF_STOCK") & (F.col("currentInventory") > 0),
    }
    level = F.when((kind == "LOW_STOCK_ALERT") & _blank("alertLevel"), "WARNING").otherwise(F.col("alertLevel"))
    return df.withColumn("violations", _violations(rules)).withColumn("alertLevel", level)


def validate_alerts(df: DataFrame) -> DataFrame:
    """Add `violations`; severity defaults to MEDIUM where it is absent."""
    df = df.withColumn("severity", F.coalesce("severity", F.lit("MEDIUM")))
    rules = {f"missing:{c}": _blank(c) for c in ("alertType", "productId", "message", "severity")}
    rules["not-positive:timestamp"] = F.coalesce("timestamp", F.lit(0)) <= 0
    return df.withColumn("violations", _violations(rules))


def derived_fields(df: DataFrame) -> DataFrame:
    """Changes of stock and price (0 when a side is missing) and the critical flag."""
    zero, nil = F.lit(0), F.lit(0.0)
    critical = F.coalesce(F.upper("alertLevel") == "CRITICAL", F.lit(False)) | (F.col("eventType") == "OUT_OF_STOCK")
    return (
        df.withColumn("inventoryChange", F.coalesce(F.col("currentInventory") - F.col("previousInventory"), zero))
        .withColumn("priceChange", F.coalesce(F.col("currentPrice") - F.col("previousPrice"), nil))
        .withColumn("critical", F.coalesce(critical, F.lit(False)))
    )


def partial_products(df: DataFrame) -> DataFrame:
    """Inventory-event text to partial product updates, keyed by product.

    PRODUCT_ADDED and unreadable records drop out; a field that is absent or null stays null.
    """
    read = parse_once(df, "_m", F.from_json(VALUE, "map<string,string>"))
    field = lambda name: F.col("_m")[name]
    return read.where((field("eventType") != "PRODUCT_ADDED") & field("productId").isNotNull()).select(
        *[c for c in df.columns if c != VALUE],
        field("productId").alias("product_id"),
        to_int(field("currentInventory")).alias("inventory"),
        field("currentPrice").try_cast("double").alias("price"),
    )


# ---- Tracked events ------------------------------------------------------------------------------


def parse_tracked(df: DataFrame) -> Parsed:
    """Text to tracked events; an unknown event type rejects that event only."""
    read = parse_once(df, "e", F.from_json(VALUE, f"{S.TRACKED_EVENT}, _broken STRING", {"columnNameOfCorruptRecord": "_broken"}))
    kind = F.col("e.eventType")
    reason = (
        F.when(F.col("e").isNull() | F.col("e._broken").isNotNull(), "malformed JSON")
        .when(kind.isNull(), "no event type")
        .when(~kind.isin(*S.TRACKED_EVENT_TYPES), "unknown event type")
    )
    # The record has a `value` field of its own, so the text moves to `text`.
    raw = [F.col(c).alias("text") if c == VALUE else F.col(c) for c in df.columns]
    tagged = read.withColumn("reject_reason", reason).select(*raw, "e.*", "reject_reason").drop("_broken")
    ok = F.col("reject_reason").isNull()
    others = [c for c in df.columns if c != VALUE]
    return Parsed(
        tagged,
        tagged.where(ok).select(*others, *field_names(S.TRACKED_EVENT)),
        tagged.where(~ok).select(*others, F.col("text").alias(VALUE), "reject_reason"),
    )


def enrich_tracked(df: DataFrame, session: Column, user: Column, now: Column, extra: dict[str, Column]) -> DataFrame:
    """Fill in id, session, user and time of tracked events and add `extra` to their metadata."""
    pairs = [x for name, c in extra.items() for x in (F.lit(name), c)]
    added = F.create_map(*pairs).cast("map<string,string>")
    # New keys only: metadata sent with the event keeps its own values.
    fresh = F.map_filter(
        added, lambda k, _: ~F.coalesce(F.map_contains_key("metadata", k), F.lit(False))
    )
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    return (
        df.withColumn("sessionId", F.coalesce("sessionId", session))
        .withColumn("userId", F.coalesce("userId", user))
        .withColumn("timestamp", F.coalesce("timestamp", now))
        .withColumn("eventId", F.coalesce("eventId", record_id("sessionId", "timestamp", "eventType", "productId")))
        .withColumn("metadata", F.map_concat(F.coalesce("metadata", empty), fresh))
    )


# ---- Envelopes -----------------------------------------------------------------------------------


def record_id(*cols: str) -> Column:
    """An id that is the same when a record is sent again."""
    return F.sha2(F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols)), 256)


def envelope(
    df: DataFrame, kind: str, payload: Column, key: Column, to_user: Column, timestamp: Column, uid: Column | None = None
) -> DataFrame:
    """Records in the processing envelope: id, time, key, recipient, type, payload as JSON."""
    if kind not in S.ENVELOPE_TYPES:
        raise ValueError(f"unknown envelope type {kind!r}")
    return df.select(
        (F.uuid() if uid is None else uid).alias("uuid"),
        timestamp.alias("timestamp"),
        key.cast("string").alias("key"),
        to_user.cast("string").alias("toUserId"),
        F.lit(kind).alias("eventType"),
        F.to_json(payload).alias("payload"),
    )


def ui_update(payload: Column, timestamp: Column) -> Column:
    """The UI fan-out message of an inventory event."""
    return F.to_json(
        F.struct(F.lit("INVENTORY_UPDATE").alias("eventType"), payload.alias("payload"), timestamp.alias("timestamp"))
    )


def ui_update_text(payload: Column, timestamp: Column) -> Column:
    """The text of `ui_update` for a payload that is JSON text already."""
    at = F.coalesce(F.concat(F.lit(',"timestamp":'), timestamp.cast("string")), F.lit(""))
    return F.concat(F.lit('{"eventType":"INVENTORY_UPDATE","payload":'), payload, at, F.lit("}"))


def by_envelope_type(df: DataFrame) -> DataFrame:
    """Envelope text with its parsed `eventType`; unknown types are marked, not fatal."""
    kind = F.get_json_object(VALUE, "$.eventType")
    return df.withColumn("eventType", kind).withColumn(
        "reject_reason",
        F.when(kind.isNull(), "no event type").when(~kind.isin(*S.ENVELOPE_TYPES), "unknown event type"),
    )


def inspect_topics(topics: dict[str, DataFrame], product_id: str) -> DataFrame:
    """All messages about one product across topics."""
    tagged = [df.select(F.lit(name).alias("topic"), VALUE) for name, df in topics.items()]
    out = tagged[0]
    for df in tagged[1:]:
        out = out.unionByName(df)
    return out.where(F.get_json_object(VALUE, "$.productId") == product_id)


# ---- Assistant and chat messages -----------------------------------------------------------------


def assistant_messages(df: DataFrame) -> DataFrame:
    """User and init messages for the assistant; blank sessions and blank user texts drop out.

    Input: `session_id, user_id, text, basket, product, context, timestamp` (the last four may be
    null); a row without text opens the conversation.
    """
    is_init = F.col("text").isNull()
    return df.where(~_blank("session_id") & (is_init | (F.trim("text") != ""))).select(
        record_id("session_id", "timestamp", "text").alias("messageId"),
        F.col("session_id").alias("sessionId"),
        F.col("user_id").alias("userId"),
        F.when(is_init, "INIT").otherwise("USER_MESSAGE").alias("type"),
        F.col("text"),
        "basket",
        "product",
        "context",
        "timestamp",
    )


_ASSISTANT = (
    "messageId STRING, sessionId STRING, userId STRING, text STRING, timestamp BIGINT, products ARRAY<STRING>"
)


def assistant_responses(df: DataFrame, now: Column) -> DataFrame:
    """Assistant responses with id and time filled in; products stay null when there are none."""
    return df.select(F.from_json(VALUE, _ASSISTANT).alias("m"), VALUE).select(
        F.coalesce("m.messageId", F.sha2(VALUE, 256)).alias("messageId"),
        F.col("m.sessionId").alias("sessionId"),
        F.col("m.userId").alias("userId"),
        F.col("m.text").alias("text"),
        F.coalesce("m.timestamp", now).alias("timestamp"),
        F.col("m.products").alias("products"),
    )


def enrich_chat(df: DataFrame, languages: Column) -> DataFrame:
    """Give chat messages an id and one empty translation slot per requested language."""
    langs = F.array_distinct(F.filter(languages, lambda x: x != "DEFAULT"))
    return df.withColumn("id", record_id("user_id", "timestamp", "message")).withColumn(
        "translations", F.map_from_arrays(langs, F.transform(langs, lambda _: F.lit(None).cast("string")))
    )


# ---- Coordinates ---------------------------------------------------------------------------------


def geo_features(lines: DataFrame) -> DataFrame:
    """GeoJSON feature lines to coordinates. GeoJSON puts the longitude first."""
    text = F.regexp_replace(trimmed(F.col(VALUE)), ",$", "")
    point = F.from_json(text, "geometry STRUCT<coordinates: ARRAY<DOUBLE>>")["geometry"]["coordinates"]
    return parse_once(lines, "_c", point).where(F.size("_c") >= 2).select(
        *[c for c in lines.columns if c != VALUE],
        F.element_at("_c", 2).alias("latitude"),
        F.element_at("_c", 1).alias("longitude"),
    )

"""Who receives which message, and in which language."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def is_public(to_user: Column, event_type: Column) -> Column:
    """Public unless it is a chat message with a recipient."""
    return to_user.isNull() | (event_type != "CHAT_MESSAGE")


def audience(messages: DataFrame, online: DataFrame) -> DataFrame:
    """One row per message and recipient; a public message is one row with a null `recipient`.

    Private messages go to their receiver and their sender, each once, as far as they are online.
    "Everyone" stays one row: the list of users is the same for all public messages.
    """
    public = is_public(F.col("to_user"), F.col("event_type"))
    everyone = messages.where(public).withColumn("recipient", F.lit(None).cast("string"))
    both = F.array_distinct(F.filter(F.array("to_user", "user_id"), lambda u: u.isNotNull()))
    private = messages.where(~public).withColumn("recipient", F.explode(both))
    reached = private.join(online.select(F.col("user_id").alias("recipient")), "recipient", "left_semi")
    return everyone.unionByName(reached)


def translate(rows: DataFrame, language: Column) -> DataFrame:
    """The text in `language` where a translation is there, else the original; sets `translated`."""
    has = (language != "DEFAULT") & F.map_contains_key("translations", language)
    has = F.coalesce(has, F.lit(False))
    return rows.withColumn("translated", has).withColumn(
        "message", F.when(has, F.element_at("translations", language)).otherwise(F.col("message"))
    )


def deliver(messages: DataFrame, online: DataFrame, preferences: DataFrame) -> DataFrame:
    """Delivered messages: to one recipient in their language, or to everyone once per language.

    `preferences` has `user_id, language`. A public message has a row for the users of every
    language with a translation and one, DEFAULT, for the others.
    """
    rows = audience(messages, online)
    prefs = preferences.select(F.col("user_id").alias("recipient"), "language")
    to_one = rows.where(F.col("recipient").isNotNull()).join(prefs, "recipient", "left")
    to_one = to_one.withColumn("language", F.coalesce("language", F.lit("DEFAULT")))
    languages = F.array_union(F.array(F.lit("DEFAULT")), F.coalesce(F.map_keys("translations"), F.array().cast("array<string>")))
    # Only chat texts are translated; joins, leaves and other events go out as they are.
    chat = (F.col("event_type") == "CHAT_MESSAGE") & (F.col("type") == "CHAT_MESSAGE")
    to_all = rows.where(F.col("recipient").isNull()).withColumn(
        "language", F.explode(F.when(chat, languages).otherwise(F.array(F.lit("DEFAULT"))))
    )
    both = to_all.unionByName(to_one)
    return translate(both, F.when(chat, F.col("language")).otherwise("DEFAULT"))


def event_targets(events: DataFrame) -> DataFrame:
    """The connections an event goes to: a user's, a session's, or all; others go nowhere."""
    kind = F.col("event_type")
    target = (
        F.when(kind == "RECOMMENDATION", F.struct(F.lit("user").alias("kind"), F.col("to_user").alias("id")))
        .when(kind == "SHOPPING_CART", F.struct(F.lit("session").alias("kind"), F.col("key").alias("id")))
        .when(kind == "PRODUCT_UPDATE", F.struct(F.lit("all").alias("kind"), F.lit(None).cast("string").alias("id")))
    )
    return _targeted(events, target)


def recommendation_targets(recommendations: DataFrame) -> DataFrame:
    """Recommendations go to the user, else to the session, else to all."""
    nobody = F.lit(None).cast("string")
    target = (
        F.when(F.col("user_id").isNotNull(), F.struct(F.lit("user").alias("kind"), F.col("user_id").alias("id")))
        .when(F.col("session_id").isNotNull(), F.struct(F.lit("session").alias("kind"), F.col("session_id").alias("id")))
        .otherwise(F.struct(F.lit("all").alias("kind"), nobody.alias("id")))
    )
    return _targeted(recommendations, target)


def _targeted(df: DataFrame, target: Column) -> DataFrame:
    return (
        df.withColumn("_t", target)
        .where(F.col("_t").isNotNull())
        .withColumn("target", F.col("_t.kind"))
        .withColumn("target_id", F.col("_t.id"))
        .drop("_t")
    )


def to_connections(targeted: DataFrame, connections: DataFrame) -> DataFrame:
    """Targeted rows per open connection (`connection_id, user_id, session_id`); `all` rows stay whole.

    One join, each side read once: a connection is listed under its user and its session. Rows for all have a key of their own each, so that they don't meet in one task.
    """
    places = F.explode(F.array(*(F.struct(F.lit(kind).alias("_kind"), F.col(f"{kind}_id").cast("string").alias("_id")) for kind in ("user", "session"))))
    listed = connections.select("connection_id", places.alias("_p")).select("connection_id", "_p.*", F.lit(True).alias("_met"))
    everyone = F.col("target") == "all"
    own = F.when(everyone, F.monotonically_increasing_id().cast("string")).otherwise(F.col("target_id").cast("string"))
    met = targeted.withColumn("_own", own).join(listed, (F.col("target") == F.col("_kind")) & (F.col("_own") == F.col("_id")), "left")
    return met.where(everyone | F.col("_met")).select(*targeted.columns, "connection_id")


def response_connections(responses: DataFrame, connections: DataFrame) -> DataFrame:
    """Assistant responses to their session's connection; a null connection means all of them."""
    return responses.join(connections.select("session_id", "connection_id"), "session_id", "left")

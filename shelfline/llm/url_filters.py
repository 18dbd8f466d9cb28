"""URL lists as of the time of fetching.

A list is a log of dated entries: an address part is added to a list or taken off it. Each entry's log becomes validity intervals
with a window. A capture is evaluated against the entries that were active when it was fetched: its host, the host's parent domains
and its path's first part are looked up among the intervals. Intervals are cut at the borders of fixed periods, so the as-of
join is an equality on (address part, period) with a bounded number of intervals for each capture, and a host with a third of all captures is dealt
over the periods. Everything is built from DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfline.llm.registry import query, table

#: Length of a period, in seconds.
PERIOD_SECONDS = 30 * 86400


def validity(log: DataFrame) -> DataFrame:
    """(list, part, action, valid_from, valid_to) from `log` (list, part, action, at: long seconds, active: boolean).

    A record holds from its time until the entry's next one; of records at one time that differ, the active one counts, then the smaller action.
    Inactive stretches are left out; the last one is open (valid_to null). Records with a null in list, part, at or active are left out.
    """
    sound = log.where("list is not null and part is not null and at is not null and active is not null")
    last = sound.groupBy("list", "part", "at").agg(F.min(F.struct((~F.col("active")).alias("off"), "action")).alias("r"))
    ahead = Window.partitionBy("list", "part").orderBy("at")
    stretches = last.select("list", "part", "r.action", F.col("at").alias("valid_from"), F.lead("at").over(ahead).alias("valid_to"), "r.off")
    return stretches.where("not off").drop("off")


def host_of(url: Column) -> Column:
    """The lower-case host of an address, without user, port or final dot; null if there is none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.nullif(F.regexp_replace(host, r"\.$", ""), F.lit(""))


def parts_of(url: Column) -> Column:
    """What a list can name of an address, broadest first: parent domains from two labels on, the host, host/first path part."""
    host = host_of(url)
    labels = F.split(host, r"\.")
    n = F.size(labels)
    domains = F.transform(
        F.reverse(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1)))), lambda i: F.array_join(F.slice(labels, i, n), ".")
    )
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#]+)", 1)
    with_path = F.when(path != "", F.array(F.concat_ws("/", host, path))).otherwise(F.array().cast("array<string>"))
    return F.when(host.isNotNull(), F.concat(domains, with_path)).otherwise(F.array().cast("array<string>"))


def evaluate(captures: DataFrame, intervals: DataFrame, period: int = PERIOD_SECONDS) -> DataFrame:
    """One row per row of `captures` (page_id, url, fetched_at: long seconds), with n_active, verdict and matched.

    n_active counts the intervals that hold at the time of fetching; verdict is the action of the most specific of them, of several
    lists the smaller action ('allow' before 'block'), or 'none'; matched is that entry as `list:part`, of several the smallest. An address without a host and a
    null time match nothing. Repeated rows stay; no rows give no rows.
    """
    looked = captures.groupBy("page_id", "url", "fetched_at").agg(F.count("*").alias("copies"))
    at = F.col("fetched_at")
    parts = looked.select(
        "page_id", "url", "fetched_at", "copies", F.posexplode_outer(parts_of(F.col("url"))).alias("depth", "part")
    ).withColumn("period", F.floor(at / period))
    # An interval is listed in each period that has captures and that it reaches: from its start to its end, or to the last capture.
    first, last = (F.lit(x).cast("long") for x in captures.agg(F.min("fetched_at"), F.max("fetched_at")).first())
    begin = F.floor(F.greatest(F.col("valid_from"), first) / period)
    end = F.floor(F.least(F.coalesce(F.col("valid_to") - 1, last), last) / period)
    dealt = intervals.where(first.isNotNull()).where(begin <= end).select("list", "part", "action", "valid_from", "valid_to", F.explode(F.sequence(begin, end)).alias("period"))
    holds = (at >= F.col("valid_from")) & (F.col("valid_to").isNull() | (at < F.col("valid_to")))
    joined = parts.join(dealt, ["part", "period"], "left").withColumn("hit", F.coalesce(holds, F.lit(False)))
    best = F.min(F.when(F.col("hit"), F.struct((-F.col("depth")).alias("depth"), F.col("action"), F.concat_ws(":", "list", "part").alias("entry"))))
    found = joined.groupBy("page_id", "url", "fetched_at", "copies").agg(F.count(F.when(F.col("hit"), 1)).alias("n_active"), best.alias("best"))
    return found.select(
        "page_id",
        "url",
        "fetched_at",
        "n_active",
        F.coalesce("best.action", F.lit("none")).alias("verdict"),
        F.col("best.entry").alias("matched"),
        F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"),
    ).drop("copy")


#: The query's times: captures and list changes are spread over the seconds of 2024.
_START, _SECONDS = 1704067200, 366 * 86400


def captures_of(pages: DataFrame) -> DataFrame:
    """The pages as captures: `pages` has no times, so each gets one from its id."""
    return pages.select("page_id", "url", (F.lit(_START) + F.pmod(F.col("page_id") * 7919, F.lit(_SECONDS))).alias("fetched_at"))


def log_of(captures: DataFrame) -> DataFrame:
    """A list log about the captures' own address parts: of two thirds of them, by their MD5, three dated changes each."""
    parts = captures.select(F.explode(parts_of(F.col("url"))).alias("part")).distinct()
    number = parts.withColumn("a", F.conv(F.substring(F.md5(F.col("part").cast("binary")), 1, 6), 16, 10).cast("long")).where("a % 3 <> 0")
    dated = number.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(2))))
    return dated.select(
        F.when(F.col("a") % 2 == 0, "ads").otherwise("malware").alias("list"),
        "part",
        F.when(F.col("a") % 5 == 0, "allow").otherwise("block").alias("action"),
        (F.lit(_START) + F.pmod(F.col("a") * (F.col("k") + 1) * 37, F.lit(_SECONDS))).alias("at"),
        (F.col("k") != 1).alias("active"),
    )


_SQL = r"""
WITH c AS (
  SELECT page_id, url, 1704067200 + (page_id * 7919) % 31622400 AS fetched_at,
         nullif(regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '\.$', ''), '') AS host,
         regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#]+)', 1) AS path
  FROM pages),
l AS (SELECT *, string_split(host, '.') AS labels FROM c),
p AS (
  SELECT page_id, url, fetched_at, len(labels) - i AS depth, array_to_string(labels[i:], '.') AS part
  FROM l, range(1, greatest(len(labels), 2)) AS r(i) WHERE host IS NOT NULL
  UNION ALL
  SELECT page_id, url, fetched_at, 1000, host || '/' || path FROM l WHERE host IS NOT NULL AND path <> ''),
n AS (SELECT DISTINCT part, ('0x' || substr(md5(part), 1, 6))::BIGINT AS a FROM p),
g AS (
  SELECT CASE WHEN a % 2 = 0 THEN 'ads' ELSE 'malware' END AS list, part, CASE WHEN a % 5 = 0 THEN 'allow' ELSE 'block' END AS action,
         1704067200 + (a * (k + 1) * 37) % 31622400 AS since, k <> 1 AS active
  FROM n, range(3) AS r(k) WHERE a % 3 <> 0),
d AS (SELECT list, part, since, bool_or(active) AS active, any_value(action) AS action FROM g GROUP BY ALL),
v AS (SELECT *, lead(since) OVER (PARTITION BY list, part ORDER BY since) AS until FROM d),
m AS (
  SELECT p.*, v.action, v.list || ':' || v.part AS entry
  FROM p JOIN v ON p.part = v.part AND v.active AND fetched_at >= v.since AND (v.until IS NULL OR fetched_at < v.until)),
b AS (
  SELECT page_id, url, count(*) AS n_active, first(action ORDER BY depth DESC, action, entry) AS verdict,
         first(entry ORDER BY depth DESC, action, entry) AS matched
  FROM m GROUP BY ALL)
SELECT c.page_id, c.url, c.fetched_at, coalesce(n_active, 0) AS n_active, coalesce(verdict, 'none') AS verdict, matched
FROM c LEFT JOIN b USING (page_id, url)
"""


@query("op10_url_filters", _SQL)
def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    captures = captures_of(table(spark, sf_dir, "pages"))
    return evaluate(captures, validity(log_of(captures)))

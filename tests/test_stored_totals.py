"""Session rules, panes, stored hours, the text index and the hand-over from bootstrap to stream, against brute force."""

import random
from collections import defaultdict

import pytest
from conftest import rows
from pyspark.sql import functions as F

from shelfline.operators import panes as P
from shelfline.operators import sessions as S
from shelfline.operators import text_index as X
from shelfline.sources import hybrid


def steps(n=300, seed=4):
    rng = random.Random(seed)
    return [(rng.choice([1, 1, 1, 1, 2, 3, None]), rng.randrange(4), rng.choice(["a", "b", "c", "d", None]), i // 2, i) for i in range(n)]


def brute_rules(found, gap, least):
    by = defaultdict(list)
    for user, session, item, ts, seq in sorted(found, key=lambda r: (r[3], r[4])):
        by[user].append((session, item))
    together, having, sessions = defaultdict(set), defaultdict(set), set()
    for user, own in by.items():
        for k, (session, item) in enumerate(own):
            sessions.add((user, session))
            if item is not None:
                having[item].add((user, session))
            for other, later in own[k + 1 : k + 1 + gap]:
                if other == session and None not in (item, later) and later != item:
                    together[item, later].add((user, session))
    return sorted((a, len(s) / len(having[a]), b, len(s) / len(sessions), len(s)) for (a, b), s in together.items() if len(s) >= least)


def test_session_rules_in_one_piece_and_in_slices(spark, both_ways):
    """Steps of sessions that interleave, null users and items, ties in time, a hot user."""
    df = spark.createDataFrame(steps(), "user long, session long, item string, ts long, seq long")
    plain, cut = both_ways(lambda: S.session_rules(df, "user", "session", "item", 2, 2))
    assert plain == cut
    assert sorted(plain) == brute_rules(steps(), 2, 2)
    assert S.session_rules(df.limit(0), "user", "session", "item").count() == 0


def timed(n=400, seed=8):
    rng = random.Random(seed)
    return [(rng.choice("xy"), rng.choice([None, rng.randrange(-5000, 9000)]), rng.randrange(-50, 50), rng.randrange(30)) for _ in range(n)]


def test_sliding_windows_from_panes(spark):
    """Negative times, rows without a time, and windows that only later panes fill."""
    df = spark.createDataFrame(timed(), "g string, ts long, v long, who int")
    want = defaultdict(list)
    for g, ts, v, who in timed():
        if ts is not None:
            for start in range(ts // 500 * 500 - 1500, ts // 500 * 500 + 1, 500):
                want[g, start].append((v, who))
    got = {(r.g, r.window_start): (r.n, r.total, r["mean"], r.least, r.most, r.members) for r in P.sliding_by_panes(df, ["g"], 2000, 500, "v", "who").collect()}
    values = {k: [v for v, _ in m] for k, m in want.items()}
    assert got == {k: (len(v), sum(v), sum(v) / len(v), min(v), max(v), len({w for _, w in want[k]})) for k, v in values.items()}
    with pytest.raises(ValueError):
        P.sliding_by_panes(df, ["g"], 2000, 300, "v", "who")
    assert P.sliding_by_panes(df.limit(0), ["g"], 2000, 500, "v", "who").count() == 0
    assert P.sliding_by_panes(df, [], 2000, 500, "v", "who").agg(F.sum("n")).first()[0] == 4 * sum(ts is not None for _, ts, _, _ in timed())


def test_panes_are_shuffled_before_they_are_copied(spark):
    df = spark.createDataFrame(timed(), "g string, ts long, v long, who int")

    def exchanges(width):
        plan = P.sliding_by_panes(df, ["g"], width, 500, "v", "who")._jdf.queryExecution().executedPlan().toString()
        return plan.count("Exchange hashpartitioning"), plan.index("Generate explode") < plan.rindex("Exchange hashpartitioning")

    assert exchanges(2000) == exchanges(500_000) == (2, True)


def test_ranges_read_stored_hours_only(spark, tmp_path):
    found = [(h * P.HOUR + k, f"u{(h + k) % 40}", k) for h in range(-30, 60) for k in range(5)]
    P.store_hourly(spark.createDataFrame([*found, (None, "u", 1)], "ts long, who string, v long"), str(tmp_path), "who", "v")
    hours = P.stored_hours(spark, str(tmp_path))
    asked = spark.createDataFrame([(-30, 90), (0, 1), (-48, 20), (500, 3), (0, 1)], "first_hour long, hours long")
    got = {(r.first_hour, r.hours): (r.n, r.members, r.q50) for r in P.over_ranges(hours, asked, (0.5,)).collect()}
    assert got == {(-30, 90): (450, 40, 2), (0, 1): (5, 5, 2), (-48, 20): (10, 6, 2)}
    assert "day=-2" in " ".join(hours.where("day = -2").inputFiles())


def test_index_finds_what_a_scan_finds_and_reads_matching_lists(spark, tmp_path):
    rng = random.Random(6)
    texts = [(i, rng.choice([None, "", "ab", *("".join(rng.choice("abcÄ ") for _ in range(rng.randint(3, 40))) for _ in range(9))]), rng.choice([None, "Cab abä"])) for i in range(300)]
    df = spark.createDataFrame(texts, "id long, name string, about string")
    X.write_index(df, str(tmp_path), "id", ["name", "about"])
    for wanted in ("abc", "CAB A", "äa", "ä a", "abcabcabc", "", "b", "zzz", "abä"):
        want = [t for t in texts if any(f is not None and wanted.lower() in f.lower() for f in t[1:])]
        assert rows(X.indexed_search(df, str(tmp_path), "id", ["name", "about"], wanted)) == rows(spark.createDataFrame(want, df.schema)), wanted
    lists = X.candidates(spark, str(tmp_path), "id", "bigint", "abca")
    plan = lists._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan and "PushedFilters: [In(gram" in plan
    assert X.candidates(spark, str(tmp_path), "id", "bigint", "ab") is None


def test_index_is_written_in_parts_of_bounded_size(spark, tmp_path, monkeypatch):
    """Their number was that of the session's shuffle partitions, so a task's share grew with the texts; rows that share a key are candidates once."""
    monkeypatch.setattr(X, "BUCKETS", 1)
    monkeypatch.setattr(X, "PART_POSTINGS", 500, raising=False)
    df = spark.range(400).selectExpr("id % 390 AS id", "concat('row number ', id % 390) AS name")
    X.write_index(df, str(tmp_path), "id", ["name"])
    sizes = spark.read.parquet(str(tmp_path)).groupBy(F.col("_metadata.file_path")).count().collect()
    assert len(sizes) > 2 and max(r["count"] for r in sizes) <= 1000
    found = X.indexed_search(df, str(tmp_path), "id", ["name"], "number 38")
    assert sorted(r.id for r in found.collect()) == sorted(k % 390 for k in range(400) if f"number {k % 390}".startswith("number 38"))
    assert X.candidates(spark, str(tmp_path), "id", "bigint", "number 7").count() == X.candidates(spark, str(tmp_path), "id", "bigint", "number 7").distinct().count()


def test_nothing_is_lost_or_doubled_between_bootstrap_and_stream(spark, tmp_path):
    """Rows that arrive while the bootstrap runs come with the stream, also when the bootstrap is started again."""
    log, position, schema = str(tmp_path / "log"), str(tmp_path / "position"), "n INT"

    def arrive(*found):
        spark.createDataFrame([(n,) for n in found], schema).coalesce(1).write.mode("append").parquet(log)

    arrive(1, 2)
    arrive(3)
    hybrid.record_position(spark, log, position)
    arrive(4)
    hybrid.record_position(spark, log, position)
    assert sorted(r.n for r in hybrid.log_until(spark, log, schema, position).collect()) == [1, 2, 3]
    seen = []

    def drain():
        stream = hybrid.log_since(spark, log, schema, position, maxFilesPerTrigger="1")
        query = stream.writeStream.option("checkpointLocation", str(tmp_path / "cp")).foreachBatch(lambda df, i: seen.extend(r.n for r in df.collect()))
        query.trigger(availableNow=True).start().awaitTermination()

    drain()
    arrive(5, 6)
    drain()
    assert sorted(seen) == [4, 5, 6]

"""Top-k by bit slices, sharding and URL lists against brute force."""

import random
import zlib

import duckdb
import numpy as np
import pytest
from conftest import DATA
from pyspark.sql import functions as F

from shelfline.llm import bitsliced_topk as K
from shelfline.llm import registry, sharding, url_filters
from shelfline.session import new_folder


def brute_top(vectors, is_query, k):
    whole = [
        (i, np.floor(64 * np.array(v, np.float64)).astype(np.int64)) for i, v in vectors if i is not None and v and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = []
    for row, (q, own) in enumerate(whole):
        if is_query(q):
            scores = sorted((-int(v @ own), i) for other, (i, v) in enumerate(whole) if other != row and len(v) == len(own))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("n,dims,scale", [(1, 3, 1.0), (63, 1, 1.0), (64, 7, 0.1), (700, 8, 20.0), (500, 5, 0.0)])
def test_block_index(n, dims, scale):
    rng = np.random.default_rng(n)
    rows = np.floor(64 * rng.normal(size=(n, dims)) * scale).astype(np.int64)
    rows[n // 2 :] = rows[n // 2]  # ties
    index = K.BitSlices(rows)
    for weights in [*rows[:20], np.zeros(dims, np.int64)]:
        for k in (1, 5, n, n + 3):
            scores = rows @ weights
            assert sorted(index.top(weights, k)) == sorted(np.lexsort((np.arange(n), -scores))[:k])


@pytest.mark.parametrize("block_rows,chunk_bytes", [(10_000, 1 << 20), (37, 400)])
def test_top_k_equals_brute_force(spark, block_rows, chunk_bytes):
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(6)]) for i in range(300)]
    rows += [(i, [0.5] * 6) for i in range(300, 420)]  # one common vector
    rows += [(20, [9.0] * 6), (500, None), (520, []), (540, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (560, [float("nan")] * 6), (580, [float("inf")] * 6)]
    rows += [(40, [300_000.0] * 6), (40, [0.25] * 6), (740, [300_000.0, 1.0]), (741, [2.0, -400_000.0])]  # large ones, and rows that share an id
    rows += [(None, [1.0] * 6), (600, [1.0, 2.0]), (601, [1.0, 3.0]), (700, [0.0] * 6)]
    df = spark.createDataFrame([(i, v, 1, "x", 2) for i, v in rows], "vec_id long, embedding array<float>, score int, block string, q int")
    got = K.top_k(df, F.col("vec_id") % 20 == 0, block_rows=block_rows, chunk_bytes=chunk_bytes)
    as32 = [(i, v and [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    assert sorted(map(tuple, got.collect())) == brute_top(as32, lambda i: i % 20 == 0, 20)
    assert K.top_k(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_scores_that_do_not_fit_are_an_error(spark):
    schema = "vec_id long, embedding array<double>"
    for huge in (1e8, 1e300):
        with pytest.raises(ValueError):
            K.top_k(spark.createDataFrame([(1, [huge]), (2, [1.0])], schema), F.lit(True))
    rows = [(20, [300_000.0, 1.0]), (20, [1.0, 2.0]), (3, [1e7, 0.0])]
    got = sorted(map(tuple, K.top_k(spark.createDataFrame(rows, schema), F.col("vec_id") % 20 == 0).collect()))
    assert got == brute_top(rows, lambda i: i % 20 == 0, 20) and len(got) == 4


def test_index_is_built_once_and_whole(spark):
    rows = K.quantised(spark.createDataFrame([(i % 50, [float(i % 7), 1.0, -2.0][: 1 + i % 3]) for i in range(200)], "vec_id long, embedding array<double>"))
    index = K.build_index(K.stored(rows), 16).collect()
    marks = [m for r in index for m in np.frombuffer(r.marks, "<i8").tolist()]
    assert len(marks) == len(set(marks)) == 200
    for r in index:
        vectors = np.frombuffer(r.vectors, "<i8").reshape(-1, r.dims)
        fresh, kept = K.BitSlices(vectors), K.BitSlices.stored(vectors, r.low, r.bits, r.slices)
        assert (fresh.slices == kept.slices).all() and (fresh.there == kept.there).all() and len(vectors) <= 16


def test_op4_query(spark):
    vectors = [tuple(r) for r in spark.read.parquet(f"{DATA}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert sorted(map(tuple, K.op4_topk(spark, DATA).collect())) == brute_top(vectors, lambda i: i % 20 == 0, 20)


def records(spark, n=900, hot=300):
    rows = [(i, "é" * (i % 50) if i % 7 else None, "s", 1) for i in range(n)] + [(None, "t", "s", 1)] * 3 + [(7, "dup", "s", 1)] * 2
    rows += [(10_000 + i, "copy", "s", 1) for i in range(hot)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, shard string, slot int")


def placed_rows(df):
    by_shard = {}
    for r in df.collect():
        by_shard.setdefault(r.shard, []).append(r)
    for found in by_shard.values():
        assert sorted(r.slot for r in found) == list(range(len(found)))
    return by_shard


def test_sharding(spark):
    rows, docs = records(spark)
    found = sharding.records_of(docs).cache()
    sums = sharding.slot_sums(found).cache()
    assert sums.count() == sharding.SLOTS
    first = sharding.first_map(sums)
    by_shard = placed_rows(sharding.place(found, first, sums))
    expected = sorted((str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for f in by_shard.values() for r in f) == expected
    loads = [sum(r.size for r in f) for f in by_shard.values()]
    assert len(loads) == 16 and max(loads) - min(loads) <= max(b for b, in sums.select("bytes").collect())
    assert sharding.place(found.limit(0), first, sums).count() == 0


def test_versioned_map_is_edited_when_rebalancing(spark):
    _, docs = records(spark)
    sums = sharding.slot_sums(sharding.records_of(docs)).cache()
    path = new_folder(spark)
    sharding.save_map(sharding.first_map(sums), path)
    for shards in (17, 5):
        before = sharding.load_map(spark, path)
        sharding.save_map(sharding.rebalanced(before, sums, shards), path)
    one, two, three = ({r.vslot: r.shard for r in sharding.load_map(spark, path, v).collect()} for v in (1, 2, 3))
    size = {r.vslot: r.bytes for r in sums.collect()}
    for found, shards in ((one, 16), (two, 17), (three, 5)):
        loads = [sum(size[v] for v, s in found.items() if s == k) for k in range(shards)]
        assert len(found) == sharding.SLOTS and set(found.values()) <= set(range(shards))
        assert max(loads) - min(loads) <= 0.15 * max(loads)
    moved = sum(size[v] for v in one if one[v] != two[v])
    assert moved <= 0.15 * sum(size.values())
    assert sharding.load_map(spark, path).first().version == 3


def test_op7_query(spark):
    by_shard = placed_rows(sharding.op7_sharding(spark, DATA))
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    got = [r for f in by_shard.values() for r in f]
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in got) == sorted((i, len(t.encode()) + 1, zlib.crc32(t.encode())) for i, t in texts.items())
    assert {(r.law, r.grown_shard) for r in got} == {("bytes", None)}
    # The shard of every record, by a second reckoning: slots in turn, then edited by the bytes that they hold.
    ids = spark.createDataFrame([(i,) for i in texts], "doc_id long")
    slot = {r.doc_id: r.v for r in ids.select("doc_id", sharding.slot_of(F.col("doc_id"), F.lit(None)).alias("v")).collect()}
    size = dict.fromkeys(range(sharding.SLOTS), 0)
    for i, t in texts.items():
        size[slot[i]] += len(t.encode()) + 1
    rows = {v: sum(s == v for s in slot.values()) for v in set(slot.values())}
    limit, loads, shard, moved = sum(size.values()) / 16 * (1 + sharding.TOLERANCE), [0] * 16, {}, []
    for k in range(16):
        so_far = 0
        for v in sorted(range(k, sharding.SLOTS, 16), key=lambda v: (-size[v], v)):
            so_far += size[v]
            if so_far <= limit:
                shard[v], loads[k] = k, loads[k] + size[v]
            else:
                moved.append(v)
    for v in sorted(moved, key=lambda v: (size[v], rows.get(v, 0), v), reverse=True):
        shard[v] = loads.index(min(loads))
        loads[shard[v]] += size[v]
    assert {r.doc_id: r.shard for r in got} == {i: shard[slot[i]] for i in texts}
    assert max(loads) - min(loads) <= 0.02 * min(loads)


def test_many_records_without_an_id_are_no_hot_slot(spark):
    docs = spark.createDataFrame([(None, "same")] * 5000, "doc_id long, text string")
    most = sharding.records_of(docs).groupBy("vslot").count().agg(F.max("count")).first()[0]
    assert most <= 12


def test_plans_of_native_operators_have_no_python(spark, capsys):
    for fn in (sharding.op7_sharding, url_filters.op10_url_filters):
        fn(spark, DATA).explain()
        plan = capsys.readouterr().out
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def brute_parts(url):
    host = url_host(url)
    if not host:
        return []
    labels = host.split(".")
    out = [".".join(labels[i:]) for i in range(max(len(labels) - 2, 0), -1, -1)]
    path = url.split("://", 1)[1].split("?")[0].split("#")[0].split("/")
    first = path[1] if len(path) > 1 else ""
    return out + ([f"{host}/{first}"] if first else [])


def url_host(url):
    if url is None or "://" not in url:
        return None
    rest = url.split("://", 1)[1]
    for end in "/?#":
        rest = rest.split(end)[0]
    return rest.split("@")[-1].split(":")[0].lower().removesuffix(".") or None


URLS = [None, "", "no address", "http://", "http://Host", "https://user:pw@A.B.Example.com:8080/x/y?q#f", "http://b.example.com./?x", "ftp://example.com#top"]
URLS += [f"http://h{i % 4}.example.{'org' if i % 3 else 'com'}/p{i % 5}/{i}" for i in range(60)]


def test_parts(spark):
    df = spark.createDataFrame([(u,) for u in URLS], "url string")
    for r in df.select("url", url_filters.parts_of(F.col("url")).alias("p")).collect():
        assert r.p == brute_parts(r.url), r.url


def test_evaluation_as_of_the_fetch(spark):
    rng = random.Random(4)
    captures = [(i % 60, rng.choice(URLS), rng.choice([None, *range(0, 400 * 86400, 86400)])) for i in range(400)]
    captures += captures[:20]
    names = sorted({p for u in URLS for p in brute_parts(u)})
    log = [(rng.choice(["l1", "l2"]), rng.choice(names), rng.choice(["allow", "block"]), rng.randrange(0, 400) * 86400, rng.random() < 0.6) for _ in range(150)]
    log += [(None, names[0], "block", 0, True), ("l1", None, "block", 0, True), ("l1", names[0], "block", None, True), ("l1", names[0], "block", 5, None)]

    state = {}
    for list_, part, action, at, active in log:
        if None not in (list_, part, at, active):
            key = (list_, part, at)
            state[key] = min(state.get(key, (True, "z")), (not active, action))

    def expected(page_id, url, at):
        hits = []
        for depth, part in enumerate(brute_parts(url) if at is not None else []):
            for list_ in ("l1", "l2"):
                past = [a for (name, p, a) in state if (name, p) == (list_, part) and a <= at]
                if past and not state[list_, part, max(past)][0]:
                    hits.append((-depth, state[list_, part, max(past)][1], f"{list_}:{part}"))
        best = min(hits, default=(0, "none", None))
        return page_id, url, at, len(hits), best[1], best[2]

    df = spark.createDataFrame([(*c, "x", 1) for c in captures], "page_id long, url string, fetched_at long, part string, period int")
    intervals = url_filters.validity(spark.createDataFrame(log, "list string, part string, action string, at long, active boolean"))
    got = [tuple(r) for r in url_filters.evaluate(df, intervals).collect()]
    assert sorted(got, key=str) == sorted((expected(*c) for c in captures), key=str)
    assert url_filters.evaluate(df.limit(0), intervals).count() == 0
    assert {r.verdict for r in url_filters.evaluate(df, intervals.limit(0)).collect()} == {"none"}


def test_op10_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{DATA}/pages.parquet'")
    found = con.execute(registry.ORACLES["op10_url_filters"])
    names = [c[0] for c in found.description]
    got = [tuple(r[n] for n in names) for r in url_filters.op10_url_filters(spark, DATA).collect()]
    assert sorted(got, key=str) == sorted(found.fetchall(), key=str)

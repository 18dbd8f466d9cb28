"""Fingerprints, links and components against brute force."""

import random
import re

import pytest
import xxhash
from conftest import DATA

from shelfline.llm import components, simhash_dedup


def brute_print(text, size=4):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not found:
        return 0
    shingles = [" ".join(found[i : i + size]) for i in range(max(1, len(found) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, max_bits=4):
    parent = {p: p for p in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    found = list(parent)
    for i, a in enumerate(found):
        for b in found[i + 1 :]:
            if (a ^ b).bit_count() <= max_bits:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {p: find(p) for p in found}


def signed(x):
    return x - (1 << 64) if x >> 63 else x


ODD = [None, "", " \t", "one", "One TWO", "Ünï Cödé É a", "a b c d", "a\xa0b c", "x " * 40_000, "same words here again and more", "same words here again and more"]


def test_simhash():
    for text in ODD:
        assert simhash_dedup.simhash(text.encode() if text is not None else None) % (1 << 64) == brute_print(text)


@pytest.mark.parametrize("seed", range(3))
def test_components_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    prints = set()
    for _ in range(12):  # dense balls, chains, and pairs at exactly 4 and 5 bits
        centre = rng.getrandbits(64)
        for _ in range(rng.choice([2, 5, 120])):
            prints.add(centre ^ sum({1 << rng.randrange(64) for _ in range(rng.randint(0, 5))}))
        for _ in range(6):
            centre ^= sum(1 << b for b in rng.sample(range(64), rng.choice([4, 5])))
            prints.add(centre)
    expected = brute_components(prints)
    df = spark.createDataFrame([(signed(p),) for p in prints], "fp long")
    got = {r.fp: r.component for r in simhash_dedup.fingerprint_components(df).collect()}
    groups, wanted = {}, {}
    for p in prints:
        groups.setdefault(got.get(signed(p), signed(p)), set()).add(p)
        wanted.setdefault(expected[p], set()).add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))
    assert all(c == min(map(signed, members)) for c, members in groups.items())


def test_near_duplicates_of_odd_rows(spark):
    rows = [(i, t, "a", 1, "b") for i, t in enumerate(ODD)] + [(None, "one", "a", 1, "b"), (3, "one", "a", 1, "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string, component int, row string")
    got = simhash_dedup.near_duplicates(df).collect()
    prints = {p for p in (brute_print(r[1]) for r in rows)}
    parts = brute_components(prints)
    assert len(got) == len(rows)
    least = {}
    for i, t, *_ in rows:
        if i is not None:
            least[parts[brute_print(t)]] = min(i, least.get(parts[brute_print(t)], i))
    expected = sorted((str(i), f"{brute_print(t):016x}", least[parts[brute_print(t)]]) for i, t, *_ in rows)
    assert sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in got) == expected
    assert simhash_dedup.near_duplicates(df.limit(0)).count() == 0


def test_op1_query(spark):
    got = simhash_dedup.op1_simhash(spark, DATA).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    parts = brute_components({brute_print(t) for t in texts.values()})
    least = {}
    for i, t in texts.items():
        least[parts[brute_print(t)]] = min(i, least.get(parts[brute_print(t)], i))
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in got} == {
        (i, f"{brute_print(t):016x}", least[parts[brute_print(t)]]) for i, t in texts.items()
    }


def test_one_row_of_each_component_stays(spark):
    rows = [(5, "a b c d e", "x"), (4, "a b c d e", "y"), (4, "a b c d e", "y"), (None, "a b c d e", "z"), (None, "q r s t u", "z"), (9, None, "n"), (8, "", "n")]
    df = spark.createDataFrame(rows, "doc_id long, text string, row string")
    got = sorted(map(tuple, simhash_dedup.without_near_duplicates(df).collect()), key=str)
    assert got == sorted([(4, "a b c d e", "y"), (None, "q r s t u", "z"), (8, "", "n")], key=str)
    assert simhash_dedup.without_near_duplicates(df.limit(0)).count() == 0


def test_connected_components(spark):
    rng = random.Random(5)
    edges = [(k, k + 1) for k in range(60)] + [(1000, k) for k in range(1001, 1100)] + [(rng.randrange(2000, 2300), rng.randrange(2000, 2300)) for _ in range(250)]
    edges += [(7, 7), (None, 3), (3, None)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: find(n) for n in parent}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0

"""Benchmark decontamination against brute force."""

import hashlib
import random
import re

import pytest

from shelfline.llm import decontamination as D

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
UPPER = {c: c + 32 for c in range(65, 91)}
ITEMS = [
    (1, "One two three four five six seven eight nine ten eleven twelve"),
    (2, "short Item, here"),
    (3, "one two three four five six seven eight nine ten"),
    (4, None),
    (5, " .,; "),
    (10, "ÉCOLE été 東京 αβγ"),
    (10, "ÉCOLE été 東京 αβγ"),
    (None, "nobody owns this one"),
    (7, "a b a b a b a b a b a b a b"),
]


def words_of(text):
    return WORD.findall((text or "").translate(UPPER))


def brute(texts, items, size=10):
    windows = {}
    for item, text in items:
        words = words_of(text)
        n = min(size, len(words))
        for i in range(len(words) - n + 1 if words else 0):
            windows.setdefault(tuple(words[i : i + n]), set()).add(item)
    out = []
    for text in texts:
        words, hit, found = words_of(text), set(), set()
        for n in {len(w) for w in windows}:
            for i in range(len(words) - n + 1):
                owners = windows.get(tuple(words[i : i + n]))
                if owners:
                    hit.update(range(i, i + n))
                    found |= owners - {None}
        out.append((len(words), len(hit), sorted(map(str, found)), hit))
    return out


def texts(n=60):
    rng = random.Random(3)
    lines = [t for _, t in ITEMS if t] + ["padding Words of no item", "été 東京", "one two three", "a b a b", "x" * 300]
    out = [None, "", " ", "ONE two-three/four five.six seven_eight nine;ten", "short  item\nHERE", "a " * 40, "école ÉCOLE été 東京 αβγ!"]
    return out + [rng.choice([" ", "\n", ". "]).join(rng.choices(lines, k=rng.randint(1, 9))) for _ in range(n)]


@pytest.fixture(scope="module")
def frames(spark):
    docs = spark.createDataFrame([(i if i % 9 else None, t, "x", 1) for i, t in enumerate(texts())], "doc_id long, text string, `a.b` string, leak int")
    return docs, spark.createDataFrame([(*r, 3) for r in ITEMS], "item_id long, text string, `window` int")


@pytest.mark.parametrize("block_bytes", [D.BLOCK_BYTES, 200])
def test_against_brute_force(frames, block_bytes):
    """In one block, and with a benchmark that is cut into many."""
    docs, items = frames
    want = dict(zip(texts(), brute(texts(), ITEMS), strict=True))
    rows = D.contamination(docs, items, block_bytes=block_bytes).collect()
    assert sorted(map(str, (r.doc_id for r in rows))) == sorted(str(r.doc_id) for r in docs.collect())
    for r in rows:
        n, n_hit, found, hit = want[r.text]
        assert (r.leak.n_words, r.leak.n_hit, r.leak["items"]) == (n, n_hit, found)
        places = [m.span() for m in WORD.finditer((r.text or "").translate(UPPER))]
        runs = [i for i in sorted(hit) if i - 1 not in hit], [i for i in sorted(hit) if i + 1 not in hit]
        assert [tuple(s) for s in r.leak.spans] == [(places[a][0], places[b][1]) for a, b in zip(*runs, strict=True)]


def test_removal(frames):
    docs, items = frames
    found = {t: w for t, w in zip(texts(), brute(texts(), ITEMS), strict=True)}
    left = D.without_benchmark(docs, items, "documents")
    assert left.columns == ["doc_id", "text", "a.b"] or left.columns == docs.columns[:-1]
    assert sorted((r.text or "", r.text is None) for r in left.collect()) == sorted((t or "", t is None) for t in texts() if not found[t][1])
    cut = [r.text for r in D.without_benchmark(docs, items).collect()]
    assert len(cut) == len(texts())
    for before, after in zip(texts(), cut, strict=True):
        n, n_hit, _, hit = found[before]
        assert words_of(after) == [w for i, w in enumerate(words_of(before)) if i not in hit] or n_hit
        if not n_hit:
            assert after == before
    with pytest.raises(ValueError):
        D.without_benchmark(docs, items, "other")


def test_long_text_and_empty_tables(spark, monkeypatch, frames):
    docs, items = frames
    monkeypatch.setattr(D, "_PIECE", 50)
    known = D.WindowSet([b"a b c d e f g h i j"], ["1"])
    text = ("zz " * 100 + "a b c d e f g h i j ") * 50
    n, hit, owners = known.find(text.encode())
    assert (n, hit.sum(), owners) == (50 * 110, 500, {"1"})
    empty = items.limit(0)
    assert [r.leak.n_hit for r in D.contamination(docs.limit(2), empty).collect()] == [0, 0]
    assert D.contamination(docs.limit(0), items).count() == 0


def test_equal_hashes_are_verified(monkeypatch):
    monkeypatch.setattr(D, "_rolling", lambda numbers, length: D.np.zeros(len(numbers) - length + 1, D.np.uint64))
    known = D.WindowSet([b"a b", b"c d", b"e f"], ["1", "2", None])
    n, hit, owners = known.find(b"a d c d e f b a")
    assert (n, hit.tolist(), owners) == (8, [False, False, True, True, True, True, False, False], {"2"})


def test_op13_query(spark):
    from conftest import DATA

    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    want = dict(zip(docs, brute(docs.values(), items), strict=True))
    rows = D.op13_decontamination(spark, DATA).collect()
    assert len(rows) == len(docs)
    for r in rows:
        n, n_hit, found, _ = want[r.doc_id]
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (n, n_hit, len(found), n_hit > 0)
        assert r.items_sha256 == hashlib.sha256(",".join(found).encode()).hexdigest()

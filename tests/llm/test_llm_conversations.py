"""Conversation repair against an exhaustive search."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from conftest import DATA

from shelfline.llm import conversation_repair as C

PATTERN = re.compile("(s?(ua)+)?")
TURNS = ["Hello there.", "Is it so?", "cut off", "", " \t", "No!", "Hello there.", ". a"]


def brute_faults(rows):
    seen, out = set(), []
    for role, text in rows:
        solid = [c for c in text if c not in " \t\n\x0b\x0c\r"]
        out.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def brute_repair(rows):
    """The least (cost, audit, lines) over all edits of every row and up to two inserted turns in every gap."""
    faults, best = brute_faults(rows), None
    names = {"u": "user", "a": "assistant"}
    gaps = [[()] if len(rows) > 3 and 0 < i < len(rows) and rows[i][0][:1] == rows[i - 1][0][:1] == "x" else [(), ("u",), ("a",), ("u", "a")] for i in range(len(rows) + 1)]
    choices = []
    for (role, text), found in zip(rows, faults, strict=True):
        fee = 5 if found == "truncated" else 0
        own = [("D", 2, None)]
        if found not in ("blank", "duplicate"):
            own += [("K", fee, (role, text)), ("R", 1 + fee, ("user", text)), ("R", 1 + fee, ("assistant", text))]
        choices.append(own)
    for edits in itertools.product(*choices):
        base = sum(e[1] for e in edits)
        if best and base > best[0]:
            continue
        for put in itertools.product(*gaps):
            cost = base + 5 * sum(map(len, put))
            if best and cost > best[0]:
                continue
            audit, lines = "I" * len(put[0]), [(names[i], "") for i in put[0]]
            for e, more in zip(edits, put[1:], strict=True):
                audit += e[0] + "I" * len(more)
                lines += [e[2]] if e[2] else []
                lines += [(names[i], "") for i in more]
            if PATTERN.fullmatch("".join(r[:1] or "-" for r, _ in lines)) and (best is None or (cost, audit) < best[:2]):
                best = (cost, audit, lines)
    return best


def conversations(n=150, longest=4, seed=5):
    rng = random.Random(seed)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", " "]
    return [[(rng.choice(roles), rng.choice(TURNS)) for _ in range(rng.randint(0, longest))] for _ in range(n)]


def brute_path(kinds):
    """The same optimum row by row over the four states, for conversations too long to try everything."""
    best = {0: (0, "")}

    def insert(best):
        for _ in range(2):
            for q, (c, a) in list(best.items()):
                to = 3 if q == 2 else 2
                best[to] = min(best.get(to, (c + 5, a + "I")), (c + 5, a + "I"))

    for kind in kinds:
        insert(best)
        after = {}
        for q, (c, a) in best.items():
            fee = 5 if kind.isupper() else 0
            steps = [(q, c + 2, a + "D")]
            if kind != "x":
                steps.append((3 if q == 2 else 2, c + 1 + fee, a + "R"))
                keep = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}.get(kind.lower(), {}).get(q)
                steps += [(keep, c + fee, a + "K")] if keep else []
            for to, cost, audit in steps:
                after[to] = min(after.get(to, (cost, audit)), (cost, audit))
        best = after
    insert(best)
    return min(best[q] for q in (0, 3) if q in best)


def test_search_is_optimal():
    for rows in conversations():
        _, kinds = C._conversation(rows)
        cost, audit, lines = brute_repair(rows)
        assert C.solve(kinds) == (cost, audit), rows
        assert list(C.apply_audit(rows, audit)) == lines


def test_long_searches():
    rng = random.Random(2)
    for n in (0, 1, 7, 60, 1024):
        for _ in range(20):
            kinds = "".join(rng.choices("suaoSUAOx", weights=[1, 6, 6, 1, 1, 1, 1, 1, 1], k=n))
            assert C.solve(kinds) == brute_path(kinds)
    assert C.solve("o" * 1024) == brute_path("o" * 1024)
    assert C.solve("U" * 255) == brute_path("U" * 255)


def test_segments_join_to_the_same():
    rng = random.Random(4)
    for _ in range(200):
        kinds = "".join(rng.choices("suaoSUAOx", k=rng.randint(1, 30)))
        cuts = [0, *sorted(rng.sample(range(len(kinds)), min(3, len(kinds) - 1))), len(kinds)]
        parts = [kinds[a:b] for a, b in zip(cuts, cuts[1:], strict=False) if a < b]
        ways = [
            [{"start": a, "end": b, "cost": w[0], "audit": w[1]} for a in range(4) for b in range(4) if (w := C.solve(p, a, (b,)))] for p in parts
        ]
        cost, taken = C.join_segments(ways)
        assert (cost, "".join(a for _, a in taken)) == C.solve(kinds)


@pytest.fixture(scope="module")
def table(spark):
    """Conversations with null ids and turns, repeated turns and a long one, and a column of a clashing name."""
    rows = []
    for i, turns in enumerate(conversations(60, 7, 9)):
        rows += [(i or None, k if k % 5 else None, r, t, 1) for k, (r, t) in enumerate(turns)]
    rng = random.Random(1)
    rows += [(1000, k // 2, rng.choice(["user", "assistant", None]), rng.choice([*TURNS, None, f"turn {k}.", f"turn {k}!"]), 2) for k in range(90)]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, segment int")


def grouped(table):
    out = {}
    for r in table.collect():
        row = (r.turn is not None, r.turn or 0, " " if r.role is None else r.role, " " if r.text is None else r.text)
        out.setdefault(r.conv_id, []).append(row)
    return {k: [r[2:] for r in sorted(v)] for k, v in out.items()}


def brute_row(rows):
    faults = brute_faults(rows)
    kinds = "".join(
        "x" if f in ("blank", "duplicate") else (i.upper() if f else i)
        for (role, _), f in zip(rows, faults, strict=True)
        for i in [role[:1] if role[:1] in ("s", "u", "a") else "o"]
    )
    cost, audit = brute_path(kinds)
    lines, state, left = [], 0, iter(rows)
    for letter in audit:
        role = "assistant" if state == 2 else "user"
        row = (role, "") if letter == "I" else next(left)
        if letter != "D":
            lines.append(row if letter == "K" else (role, row[1]))
            state = {"s": 1, "u": 2, "a": 3}[lines[-1][0][0]]
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest()
    return [*(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest], lines


@pytest.mark.parametrize("limit", [3, 20, C.SEGMENT_ROWS])
def test_tables(table, limit):
    """In one piece and in segments of a few rows."""
    want = {k: brute_row(v) for k, v in grouped(table).items()}
    got = {r.conv_id: [r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256] for r in C.audits(table, limit).collect()}
    assert got == {k: v[0] for k, v in want.items()}
    lines = {}
    for r in sorted(C.repaired(table, limit).collect(), key=lambda r: (r.segment, r.place)):
        lines.setdefault(r.conv_id, []).append((r.role, r.text))
    assert lines == {k: v[1] for k, v in want.items() if v[1]}


def test_empty_table(table):
    assert C.audits(table.limit(0)).count() == 0 == C.repaired(table.limit(0)).count()
    assert C.turn_gaps(table.limit(0)).count() == 0


def test_op12_query(spark, tmp_path):
    """The given table with odd rows added, damaged and repaired row by row."""
    given = spark.read.parquet(f"{DATA}/conversations.parquet")
    odd = spark.createDataFrame([(None, None, None, None), (None, 3, "user", "Hi."), (77777, None, "user", "So?"), (77778, 2, None, "x")], given.schema)
    given.unionByName(odd).write.parquet(f"{tmp_path}/conversations.parquet")
    rows = [tuple(r) for r in given.unionByName(odd).select("conv_id", "turn", "role", "text").collect()]
    broken = {r[0]: [] for r in rows}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        fate = zlib.crc32(":".join(" " if x is None else str(x) for x in (conv, turn)).encode()) % 20
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        row = (turn is not None, turn or 0, "user" if fate == 4 else role, text)
        broken[conv] += [] if fate == 0 else [row] * (2 if fate == 3 else 1)
    got = {}
    for r in C.op12_conversations(spark, str(tmp_path)).collect():
        assert r.conv_id not in got
        got[r.conv_id] = [r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256]
    want = {}
    for conv, some in broken.items():
        turns = {t for known, t, _, _ in some if known}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        want[conv] = [gaps, *brute_row([r[2:] for r in sorted(some)])[0]]
    assert got == want

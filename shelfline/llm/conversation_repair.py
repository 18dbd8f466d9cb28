"""Conversation structure repair by depth-first branch-and-bound.

A conversation is well formed if its role initials match `(s?(ua)+)?` and no turn is blank, a duplicate or cut off. Rows are kept, given
another role, or deleted, and empty turns inserted, at the least total cost; of equally cheap edits the ones whose initials are the
smallest text win.

The search walks edits with an explicit stack. A prefix is a node (rows consumed, state of the role pattern) with a cost and an audit,
the initials so far. It is cut off if its cost and the lower bound of the remaining rows exceed the incumbent, or if the node's
dominance entry has a better (cost, audit): both orders are kept by any common continuation, since prefixes of one node and one cost never
extend each other. What is left when the stack is empty is the proven optimum. The bounds are kept per state: with sums of the rows' least
costs alone a search of 120 rows took two seconds, so that longer ones were out of reach.

Conversations of up to SEGMENT_ROWS rows are solved where their rows lie after one shuffle. Longer ones, whose rows may be a third of the
table, are range-partitioned and cut into segments; a segment is solved from each state to each state, and the segments' results, not
their rows, are joined in order. Edits depend on a segment's neighbours only through the state, so this optimum is the same.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm.registry import query, table
from shelfline.session import stored

#: Rows, and bytes of texts, of a conversation that is solved in one piece.
SEGMENT_ROWS, SEGMENT_BYTES = 1024, 16 << 20
#: Costs of the edits, and of a cut-off turn that is not deleted.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: States of the role pattern: nothing yet, after a system, a user and an assistant turn. It may end in the first and the last.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
FINAL = (EMPTY, ASSISTANT)
_WHITE = " \t\n\x0b\x0c\r"
_FAULTS = ("blank", "duplicate", "truncated")
#: A row as the search sees it: its role's initial, `o` for any other; in upper case if truncated; `x` if it has to be deleted.
_GONE = "x"
_AFTER = {(EMPTY, "s"): SYSTEM, (EMPTY, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
_SUMS = "blank long, duplicate long, truncated long, illegal long"


def _next_turn(state: int) -> tuple[str, int]:
    """The role that an inserted or renamed turn takes in a state, and the state after it."""
    return ("assistant", ASSISTANT) if state == USER else ("user", USER)


def _moves(kind: str, state: int) -> list[tuple[int, str, int]]:
    """(cost, initial, next state) of the edits that consume a row."""
    moves = [(DELETE, "D", state)]
    if kind != _GONE:
        fee = TRUNCATED if kind.isupper() else 0
        after = _AFTER.get((state, kind.lower()))
        if after is not None:
            moves.append((KEEP + fee, "K", after))
        moves.append((REROLE + fee, "R", _next_turn(state)[1]))
    return moves


_MOVES = {(kind, state): _moves(kind, state) for kind in "suaoSUAOx" for state in range(4)}


def _least_costs(kinds: str, targets: tuple[int, ...]) -> list[list[float]]:
    """Lower bounds of the rows from each place on, per state: their least cost, without an audit, added up from the end."""
    row = [0 if state in targets else math.inf for state in range(4)]
    out = []
    for kind in (None, *reversed(kinds)):
        if kind is not None:
            row = [min(c + row[after] for c, _, after in _MOVES[kind, state]) for state in range(4)]
        for _ in range(3):  # a turn or two may be inserted before
            row = [min(row[state], INSERT + row[_next_turn(state)[1]]) for state in range(4)]
        out.append(row)
    return out[::-1]


@lru_cache(1 << 14)
def solve(kinds: str, start: int = EMPTY, targets: tuple[int, ...] = FINAL) -> tuple[int, str] | None:
    """The least (cost, audit) that leads the rows from `start` to one of `targets`; None if nothing does."""
    least, best = _least_costs(kinds, targets), None
    dominant: dict[tuple[int, int], tuple[int, str]] = {}
    stack = [(0, start, 0, "")]
    while stack:
        place, state, cost, audit = stack.pop()
        bound = cost + least[place][state]
        if bound == math.inf or best is not None and (bound > best[0] or bound == best[0] and audit > best[1][: len(audit)]):
            continue
        held = dominant.get((place, state))
        if held is not None and held <= (cost, audit):
            continue
        dominant[place, state] = (cost, audit)
        if place == len(kinds):
            if state in targets and (best is None or (cost, audit) < best):
                best = (cost, audit)
            moves = []
        else:
            moves = [(cost + c, audit + letter, place + 1, after) for c, letter, after in _MOVES[kinds[place], state]]
        moves.append((cost + INSERT, audit + "I", place, _next_turn(state)[1]))
        # The cheapest continuation comes off the stack first, so that the incumbent is good early.
        moves.sort(key=lambda m: (m[0] + least[m[2]][m[3]], m[1]), reverse=True)
        stack.extend((to, after, c, a) for c, a, to, after in moves)
    return best


def apply_audit(rows: Iterable[tuple[str, str]], audit: str, state: int = EMPTY) -> Iterator[tuple[str, str]]:
    """The repaired (role, text) of the rows, from a state of the role pattern on."""
    left = iter(rows)
    for letter in audit:
        role, after = _next_turn(state)
        if letter == "I":
            yield role, ""
        else:
            old, text = next(left)
            if letter == "D":
                continue
            if letter == "K":
                role, after = old, _AFTER[state, old[:1]]
            yield role, text
        state = after


def fault(role: str, text: str, repeated: bool) -> str | None:
    """The first fault of a row."""
    solid = text.rstrip(_WHITE)
    if not solid:
        return "blank"
    if repeated:
        return "duplicate"
    return None if solid[-1] in ".!?" else "truncated"


def _kind(role: str, found: str | None) -> str:
    if found in ("blank", "duplicate"):
        return _GONE
    initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
    return initial.upper() if found else initial


def _illegal(roles: list[str]) -> int:
    initials = [r[:1] for r in roles]
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))


def _conversation(rows: list[tuple[str, str]]) -> tuple[dict[str, int], str]:
    """Counts of the faults and illegal neighbours, and the rows as the search sees them."""
    seen: set[tuple[str, str]] = set()
    counts, kinds = dict.fromkeys((*_FAULTS, "illegal"), 0), []
    for row in rows:
        found = fault(*row, row in seen)
        seen.add(row)
        if found:
            counts[found] += 1
        kinds.append(_kind(row[0], found))
    counts["illegal"] = _illegal([r for r, _ in rows])
    return counts, "".join(kinds)


def _digest(lines: Iterable[tuple[str, str]]) -> str:
    return hashlib.sha256("\n".join(f"{role}:{text}" for role, text in lines).encode()).hexdigest()


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows of `conversations` (conv_id, turn, role, text) with planted faults, chosen by a checksum of conversation and turn.

    Of twenty residues 0 drops the row, 1 empties its text, 2 removes its sentence ends, 3 repeats it and 4 makes it a user's. A null
    stands for one space in the checksum, in role and in text.
    """
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    fate = F.pmod(F.crc32(key.cast("binary")), F.lit(20))
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), fate.alias("fate")).where("fate <> 0")
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(F.col("fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), copies.alias("c")).select(
        "conv_id", "turn", "role", "text", F.explode("c").alias("copy")
    ).drop("copy")


def _plain_rows(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text): nulls of role and text as one space."""
    return rows.select("conv_id", "turn", *(F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")))


def _same(a: str, b: str = "conv_id") -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def _long_ones(rows: DataFrame, limit: int, limit_bytes: int) -> DataFrame:
    sizes = rows.groupBy("conv_id").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("size"))
    return stored(sizes.where((F.col("n") > limit) | (F.col("size") > limit_bytes)).select(F.col("conv_id").alias("long_id")))


_ORDER = ("conv_id", "turn", "role", "text")


def _solved(rows: DataFrame, lines: bool = False) -> DataFrame:
    """One row per conversation of bounded length: counts, cost, audit, digest, and with `lines` the repaired turns."""
    kind = "array<struct<role: string, text: string>>"
    schema = f"{_schema_of(rows)}, {_SUMS}, cost long, audit string, repaired_sha256 string" + (f", lines {kind}" if lines else "")
    columns = [c.split()[0] for c in schema.split(", ")[:8]] + (["lines"] if lines else [])
    id_type = rows.schema["conv_id"].dataType

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in _whole_groups(batches):
            out: dict[str, list] = {c: [] for c in columns}
            for conv, members in some:
                counts, kinds = _conversation(members)
                cost, audit = solve(kinds)
                done = list(apply_audit(members, audit))
                found = {"conv_id": conv, **counts, "cost": cost, "audit": audit, "repaired_sha256": _digest(done)}
                if lines:
                    found["lines"] = [{"role": r, "text": t} for r, t in done]
                for c in columns:
                    out[c].append(found[c])
            yield pa.RecordBatch.from_pydict(out, _arrow(id_type, columns))

    return rows.repartition("conv_id").sortWithinPartitions(*_ORDER).select("conv_id", "role", "text").mapInArrow(work, schema)


def _schema_of(rows: DataFrame) -> str:
    return f"conv_id {rows.schema['conv_id'].dataType.simpleString()}"


def _arrow(id_type, columns: list[str]) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_type

    line = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
    kinds = {"conv_id": to_arrow_type(id_type), "audit": pa.string(), "repaired_sha256": pa.string(), "lines": line}
    return pa.schema([(c, kinds.get(c, pa.int64())) for c in columns])


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[object, list[tuple[str, str]]]]]:
    """The conversations of a sorted partition, those that end in one batch together."""
    held_id, held = None, []
    for batch in batches:
        groups = groupby(zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True), key=lambda r: r[0])
        out = []
        for conv, rows in groups:
            if held and conv != held_id:
                out.append((held_id, held))
                held = []
            held_id = conv
            held = [*held, *((r[1], r[2]) for r in rows)]
        if out:
            yield out
    if held:
        yield [(held_id, held)]


def _segments(rows: DataFrame, segment: int, segment_bytes: int) -> DataFrame:
    """The rows of long conversations with `segment`, a number that grows with their order, `place` in it and `repeated`."""
    tagged = stored(rows.withColumn("row", F.monotonically_increasing_id()).withColumn("same", F.sha2(F.concat_ws(":", "role", "text").cast("binary"), 256)))
    first = tagged.groupBy("conv_id", "role", "same").agg(F.min(F.struct("turn", "row")).alias("first"))
    first = stored(first.select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("same").alias("s"), "first"))
    marked = tagged.join(first, _same("c") & (F.col("r") == F.col("role")) & (F.col("s") == F.col("same")))
    marked = marked.select(*_ORDER, "row", (F.col("row") != F.col("first.row")).alias("repeated"))
    # Range partitions follow the order; `row` parts equal rows, so no group of them is one task's.
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = marked.repartitionByRange(parts, *_ORDER, "row").sortWithinPartitions(*_ORDER, "row")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, at, place, size, begun = None, -1, 0, 0, False
        for batch in batches:
            segments, places = [], []
            for now, text in zip(batch.column("conv_id").to_pylist(), batch.column("text"), strict=True):
                if not begun or now != conv or place + 1 >= segment or size > segment_bytes:
                    conv, at, place, size, begun = now, at + 1, -1, 0, True
                place, size = place + 1, size + len(text.as_buffer())
                segments.append(at)
                places.append(place)
            yield batch.append_column("at", pa.array(segments, pa.int64())).append_column("place", pa.array(places, pa.int64()))

    schema = f"{_schema_of(rows)}, role string, text string, repeated boolean, at long, place long"
    numbered = ranged.select("conv_id", "role", "text", "repeated").mapInArrow(number, schema)
    return stored(numbered.withColumn("segment", F.shiftleft(F.spark_partition_id().cast("long"), 40) + F.col("at")).drop("at"))


def _segment_rows(table_: pa.Table) -> list[tuple[str, str, bool]]:
    table_ = table_.sort_by("place")
    return list(zip(*(table_.column(c).to_pylist() for c in ("role", "text", "repeated")), strict=True))


def _solved_segments(segments: DataFrame) -> DataFrame:
    """Per segment: counts, its first and last role, and the least (cost, audit) from each state to each."""
    ways = "array<struct<start: int, end: int, cost: long, audit: string>>"
    schema = f"{_schema_of(segments)}, segment long, {_SUMS}, first string, last string, ways {ways}"
    id_type = segments.schema["conv_id"].dataType

    def work(table_: pa.Table) -> pa.Table:
        rows = _segment_rows(table_)
        found = [fault(*r) for r in rows]
        kinds = "".join(_kind(r[0], f) for r, f in zip(rows, found, strict=True))
        paths = [(a, b, solve(kinds, a, (b,))) for a in range(4) for b in range(4)]
        row = {"conv_id": table_.column("conv_id")[0].as_py(), "segment": table_.column("segment")[0].as_py()}
        row |= {f: found.count(f) for f in _FAULTS} | {"illegal": _illegal([r[0] for r in rows]), "first": rows[0][0][:1], "last": rows[-1][0][:1]}
        row["ways"] = [{"start": a, "end": b, "cost": w[0], "audit": w[1]} for a, b, w in paths if w]
        way = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
        schema = _arrow(id_type, ["conv_id", "segment", *_FAULTS, "illegal"])
        for c, kind in (("first", pa.string()), ("last", pa.string()), ("ways", pa.list_(way))):
            schema = schema.append(pa.field(c, kind))
        return pa.Table.from_pylist([row], schema)

    return segments.groupBy("segment").applyInArrow(work, schema)


def join_segments(segments: list[list[dict]]) -> tuple[int, list[tuple[int, str]]]:
    """The least cost of consecutive segments, and the (start state, audit) taken in each."""
    best: dict[int, tuple[int, str, tuple]] = {EMPTY: (0, "", ())}
    for ways in segments:
        after: dict[int, tuple[int, str, tuple]] = {}
        for w in ways:
            if w["start"] in best:
                cost, audit, path = best[w["start"]]
                found = (cost + w["cost"], audit + w["audit"], (path, w["start"], w["audit"]))
                if w["end"] not in after or found[:2] < after[w["end"]][:2]:
                    after[w["end"]] = found
        best = after
    cost, _, path = min((best[q] for q in FINAL if q in best), key=lambda b: b[:2])
    taken = []
    while path:
        path, start, audit = path
        taken.append((start, audit))
    return cost, taken[::-1]


def _joined_segments(solved: DataFrame) -> DataFrame:
    """Per segment of a long conversation: the state it starts from and its audit; and the conversation's whole cost."""

    def work(table_: pa.Table) -> pa.Table:
        table_ = table_.sort_by("segment")
        cost, taken = join_segments(table_.column("ways").to_pylist())
        first, last = table_.column("first").to_pylist(), table_.column("last").to_pylist()
        seams = [int(a + b not in ("su", "ua", "au")) for a, b in zip([None, *last[:-1]], first, strict=True) if a is not None]
        out = [table_.column(c) for c in ("conv_id", "segment", *_FAULTS)]
        illegal = [n + s for n, s in zip(table_.column("illegal").to_pylist(), [0, *seams], strict=True)]
        out += [pa.array(illegal, pa.int64()), pa.array([cost] * len(taken), pa.int64())]
        out += [pa.array([s for s, _ in taken], pa.int32()), pa.array([a for _, a in taken], pa.string())]
        return pa.table(out, ["conv_id", "segment", *_FAULTS, "illegal", "cost", "start", "audit"])

    return solved.groupBy("conv_id").applyInArrow(work, f"{_schema_of(solved)}, segment long, {_SUMS}, cost long, start int, audit string")


def _segment_lines(segments: DataFrame, taken: DataFrame) -> DataFrame:
    """The repaired turns of long conversations: (conv_id, segment, place, role, text)."""
    id_type = segments.schema["conv_id"].dataType

    def work(rows: pa.Table, chosen: pa.Table) -> pa.Table:
        start, audit = chosen.column("start")[0].as_py(), chosen.column("audit")[0].as_py()
        done = list(apply_audit([r[:2] for r in _segment_rows(rows)], audit, start))
        schema = _arrow(id_type, ["conv_id", "segment", "place", "audit", "repaired_sha256"])
        conv, segment = chosen.column("conv_id")[0].as_py(), chosen.column("segment")[0].as_py()
        columns = [[conv] * len(done), [segment] * len(done), list(range(len(done))), [r for r, _ in done], [t for _, t in done]]
        arrays = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
        return pa.table(arrays, ["conv_id", "segment", "place", "role", "text"])

    schema = f"{_schema_of(segments)}, segment long, place long, role string, text string"
    return segments.groupBy("segment").cogroup(taken.groupBy("segment")).applyInArrow(work, schema)


def _digests(lines: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256): a digest of all turns has to be taken in their order, so each conversation is one stream, held nowhere whole."""
    id_type = lines.schema["conv_id"].dataType

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state, done = None, None, []
        for batch in batches:
            for now, role, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if state is not None and now == conv:
                    state.update(b"\n")
                else:
                    if state is not None:
                        done.append((conv, state.hexdigest()))
                    conv, state = now, hashlib.sha256()
                state.update(f"{role}:{text}".encode())
        if state is not None:
            done.append((conv, state.hexdigest()))
        schema = _arrow(id_type, ["conv_id", "repaired_sha256"])
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done, strict=True) if done else ([], []), schema, strict=True)], schema=schema)

    ordered = lines.repartition("conv_id").sortWithinPartitions("conv_id", "segment", "place")
    return ordered.select("conv_id", "role", "text").mapInArrow(work, f"{_schema_of(lines)}, repaired_sha256 string")


def _split(rows: DataFrame, limit: int, limit_bytes: int) -> tuple[DataFrame, DataFrame | None]:
    """Rows of conversations of bounded length, and those of longer ones, if there are any."""
    long_ids = _long_ones(rows, limit, limit_bytes)
    if long_ids.isEmpty():
        return rows, None
    return rows.join(long_ids, _same("long_id"), "left_anti"), rows.join(long_ids, _same("long_id"), "left_semi")


def audits(conversations: DataFrame, limit: int = SEGMENT_ROWS, limit_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """One row per conversation of `conversations` (conv_id, turn, role, text): conv_id, blank, duplicate, truncated, illegal, cost, audit
    and repaired_sha256, of the repaired `role:text` lines.

    Rows are taken by turn, null turns first; of equal turns by role and text. Rows with a null conv_id are one conversation. A null role or text
    counts as one space, so such a text is blank; a role without one of the three initials can only be renamed or deleted. Repeated rows are
    duplicates. Texts of any length are read whole. Other columns are ignored; no rows give no rows.
    """
    short, long = _split(_plain_rows(conversations), limit, limit_bytes)
    found = _solved(short)
    if long is None:
        return found
    segments = _segments(long, limit, limit_bytes)
    taken = stored(_joined_segments(stored(_solved_segments(segments))))
    digests = stored(_digests(_segment_lines(segments, taken)).withColumnRenamed("conv_id", "id"))
    sums = [F.sum(c).alias(c) for c in (*_FAULTS, "illegal")]
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("segment", "audit"))), lambda s: s["audit"])
    whole = taken.groupBy("conv_id").agg(*sums, F.first("cost").alias("cost"), F.array_join(ordered, "").alias("audit"))
    digest = F.coalesce("repaired_sha256", F.lit(_digest([]))).alias("repaired_sha256")  # all turns may be deleted
    return found.unionByName(whole.join(digests, _same("id"), "left").select("conv_id", *_FAULTS, "illegal", "cost", "audit", digest))


def repaired(conversations: DataFrame, limit: int = SEGMENT_ROWS, limit_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """The repaired turns of `conversations` (conv_id, turn, role, text): (conv_id, segment, place, role, text), in order of segment and place.

    Conversations whose turns are all deleted have none. See `audits` for nulls, ties and repeated rows.
    """
    short, long = _split(_plain_rows(conversations), limit, limit_bytes)
    done = _solved(short, lines=True).select("conv_id", F.lit(0).cast("long").alias("segment"), F.posexplode("lines").alias("place", "l"))
    done = done.select("conv_id", "segment", F.col("place").cast("long").alias("place"), "l.role", "l.text")
    if long is None:
        return done
    segments = _segments(long, limit, limit_bytes)
    taken = stored(_joined_segments(stored(_solved_segments(segments))))
    return done.unionByName(_segment_lines(segments, taken))


def turn_gaps(conversations: DataFrame) -> DataFrame:
    """(conv_id, gaps): turns between the first and the last that are missing; null turns don't count."""
    turns = conversations.select("conv_id", "turn").distinct().groupBy("conv_id").agg(F.max("turn").alias("last"), F.min("turn").alias("first"), F.count("turn").alias("n"))
    return turns.select("conv_id", F.coalesce(F.col("last") - F.col("first") + 1 - F.col("n"), F.lit(0)).cast("long").alias("gaps"))


@query("op12_conversations")
def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    original = table(spark, sf_dir, "conversations")
    broken = damaged(original)
    every = original.select(F.col("conv_id").alias("id")).distinct()
    gaps = turn_gaps(broken).withColumnRenamed("conv_id", "gap_id")
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", *_FAULTS, "illegal", "cost")]
    rest = [F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(_digest([]))).alias("repaired_sha256")]
    joined = every.join(gaps, _same("id", "gap_id"), "left").join(audits(broken), _same("id"), "left")
    return joined.select(F.col("id").alias("conv_id"), *zero, *rest)

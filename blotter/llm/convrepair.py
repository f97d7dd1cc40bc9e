"""Operator 13: conversation repair by a square-root checkpointed dynamic program.

A conversation's turns are kept, given another role, deleted, or preceded by inserted
empty turns, at least cost, so that the roles' initials match ``(s?(ua)+)?``; of the
cheapest edits those whose initials (D, I, K, R) come first in ASCII are taken.
The state is what stands last: nothing yet, system, user or assistant.  A backward pass
finds the least cost from each state to the end, but stores that vector of four
only at checkpoints, one in about sqrt(n) turns; walking forward, the block between
two checkpoints is computed anew, and of the tight edits the ASCII-least is emitted
(:func:`repair`).  Memory is about 2 sqrt(n) vectors.

Turns are ordered by one range exchange on (conversation, turn, role, text).  A task reads its
range as a stream of chunks of bounded rows and bytes; conversations that lie inside
a chunk are finished there.  Those that a chunk or a task border cuts, so also any
conversation too long for one task, go on as segments, one per chunk:

1. turns seen earlier come from a group by (conversation, role, text) with map-side minima;
2. each segment gives its cost from each state to each state, a (min, +) matrix;
3. products of these matrices, from the last segment to the first, are the cost
   vectors at the segments' ends (the outer checkpoints), one small row per segment;
4. each segment is walked from the four states that it may begin in, in parallel, and
   the segments' first states follow from the first to the last;
5. each segment writes its repaired lines, and SHA-256, which has no parallel form, is fed
   segment by segment in one pass that holds one segment.

Defined results: nulls in role or text are one space; turns of equal number go by role, then
text, nulls first; an initial other than s, u, a (or an empty role) cannot be kept; repeated
rows are duplicates; an empty table gives an empty result; extra columns are ignored."""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blotter.llm.common import ship_package, stage, to_batch

SPACE = " \t\n\x0b\x0c\r"
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
CHUNK_ROWS, CHUNK_BYTES = 4096, 8_000_000
INF = 1 << 40

#: States: nothing yet, system, user, assistant; the state after a user or assistant turn.
START, S, U, A = range(4)
STATES = (START, S, U, A)
NEXT = {START: U, S: U, U: A, A: U}
ROLE = {U: "user", A: "assistant"}
INITIALS = {"s": 0, "u": 1, "a": 2}
#: Kinds of turns: must go (blank or duplicate), truncated, sound.
GOES, CUT, SOUND = range(3)
END = (0, INF, INF, 0)


def keeps(state: int, initial: int) -> int | None:
    """The state after keeping a turn of this initial, or None where it may not follow."""
    if initial == 0:
        return S if state == START else None
    if initial == 1:
        return U if state != U else None
    return A if initial == 2 and state == U else None


def with_inserts(costs: Sequence[int]) -> tuple[int, ...]:
    """Costs to the end, when turns may be inserted first."""
    out = list(costs)
    for _ in range(3):
        for q in STATES:
            out[q] = min(out[q], INSERT + out[NEXT[q]])
    return tuple(out)


@functools.lru_cache(maxsize=1 << 16)
def before(code: int, after: tuple[int, ...]) -> tuple[int, ...]:
    """Costs to the end from before a turn, of those from after it."""
    kind, initial = divmod(code, 4)
    out = [DELETE + c for c in after]
    if kind != GOES:
        extra = TRUNCATED if kind == CUT else 0
        for q in STATES:
            kept = keeps(q, initial)
            if kept is not None:
                out[q] = min(out[q], extra + after[kept])
            out[q] = min(out[q], extra + REROLE + after[NEXT[q]])
    return with_inserts(out)


def back(code: int, after: tuple[int, ...]) -> tuple[int, ...]:
    """:func:`before` on costs less their least, so that few vectors occur and the cache has them."""
    least = min(after)
    return tuple(min(least + c, INF) for c in before(code, tuple(min(c - least, INF) for c in after)))


def repair(codes: bytes, end: tuple[int, ...] = END, state: int = START, last: bool = True) -> tuple[int, str, int]:
    """Least cost, ASCII-least cheapest edits and final state of turns given by their
    codes (4 x kind + initial).  ``end``: the costs after them; a part that is not the
    ``last`` leaves inserts after its last turn to the next."""
    n = len(codes)
    block = max(1, math.isqrt(n))
    vector = with_inserts(end)
    checkpoints = {n: vector}
    for i in range(n - 1, -1, -1):
        vector = back(codes[i], vector)
        if i % block == 0:
            checkpoints[i] = vector
    cost, edits = vector[state], []
    for start in range(0, n, block):
        stop = min(start + block, n)
        vectors = [checkpoints[stop]]
        for i in range(stop - 1, start - 1, -1):
            vectors.append(back(codes[i], vectors[-1]))
        vectors.reverse()
        for i in range(start, stop):
            kind, initial = divmod(codes[i], 4)
            extra = TRUNCATED if kind == CUT else 0
            here, after = vectors[i - start], vectors[i - start + 1]
            while True:
                if here[state] == DELETE + after[state]:
                    edits.append("D")
                    break
                if here[state] == INSERT + here[NEXT[state]]:
                    edits.append("I")
                    state = NEXT[state]
                    continue
                kept = keeps(state, initial) if kind != GOES else None
                if kept is not None and here[state] == extra + after[kept]:
                    edits.append("K")
                    state = kept
                    break
                edits.append("R")
                state = NEXT[state]
                break
    while last and checkpoints[n][state]:
        edits.append("I")
        state = NEXT[state]
    return cost, "".join(edits), state


def matrix(codes: bytes) -> list[int]:
    """Least costs from each state before these turns to each state after them, inserts
    after the last turn left out."""
    out = []
    for goal in STATES:
        vector = tuple(0 if q == goal else INF for q in STATES)
        for i in range(len(codes) - 1, -1, -1):
            vector = back(codes[i], vector)
        out.append(vector)
    return [out[goal][q] for q in STATES for goal in STATES]


def repaired_lines(audit: str, state: int, turns: Sequence[tuple[str, str]]) -> list[str]:
    """``role:text`` of what the edits leave, from a state on."""
    out, rows = [], iter(turns)
    for edit in audit:
        if edit == "I":
            state = NEXT[state]
            out.append(f"{ROLE[state]}:")
            continue
        role, text = next(rows)
        if edit == "K":
            state = keeps(state, INITIALS[role[0]])
            out.append(f"{role}:{text}")
        elif edit == "R":
            state = NEXT[state]
            out.append(f"{ROLE[state]}:{text}")
    return out


def seen_key(role: str, text: str) -> bytes:
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()


def kind_of(text: str) -> int:
    sound = text.rstrip(SPACE)
    return GOES if not sound else SOUND if sound[-1] in ".!?" else CUT


def initial_of(role: str) -> int:
    return INITIALS.get(role[:1], 3)


def follows(a: int, b: int) -> bool:
    """Whether two adjacent initials are su, ua or au."""
    return (a, b) in ((0, 1), (1, 2), (2, 1))


def damaged(rows: DataFrame) -> DataFrame:
    """The contract's damage by crc32(``conv_id:turn``) mod 20; dropped rows stay, marked,
    so that no conversation is lost."""
    def key(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    role, text = key("role"), key("text")
    kind = F.pmod(F.crc32(F.concat_ws(":", key("conv_id"), key("turn")).cast("binary")), F.lit(20))
    return (rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), kind.alias("d"),
                        F.when(kind == 4, "user").otherwise(role).alias("role"),
                        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"))
            .select("conv_id", "turn", "role", "text", (F.col("d") == 0).alias("dropped"),
                    F.explode(F.when(F.col("d") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")))


SUMMARY = [T.StructField(c, T.LongType()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")] + [
    T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())]
ID = T.StructField("conv_id", T.LongType())
RESULT = T.StructType([ID, *SUMMARY])
PASS = T.StructType([
    *RESULT.fields, T.StructField("task", T.IntegerType()), T.StructField("chunk", T.IntegerType()), T.StructField("pos", T.IntegerType()),
    T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
    T.StructField("dropped", T.BooleanType()), T.StructField("key", T.BinaryType())])


def whole_conversation(turns: list[tuple[int | None, str, str]]) -> dict:
    """The result columns of one conversation held in memory."""
    seen: set[bytes] = set()
    counts, codes, initials = [0, 0, 0], bytearray(), []
    for _, role, text in turns:
        kind, key, initial = kind_of(text), seen_key(role, text), initial_of(role)
        if kind == GOES:
            counts[0] += 1
        elif key in seen:
            kind = GOES
            counts[1] += 1
        elif kind == CUT:
            counts[2] += 1
        seen.add(key)
        codes.append(4 * kind + initial)
        initials.append(initial)
    numbers = {t for t, _, _ in turns if t is not None}
    cost, audit, _ = repair(bytes(codes))
    lines = repaired_lines(audit, START, [(r, t) for _, r, t in turns])
    return {"gaps": max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0,
            "blank": counts[0], "duplicate": counts[1], "truncated": counts[2],
            "illegal": sum(not follows(a, b) for a, b in zip(initials, initials[1:], strict=False)),
            "cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest()}


def first_pass(chunk_rows: int, chunk_bytes: int):
    """Over one ordered range: a result row for each conversation that lies inside a chunk,
    and the turns of the others, with their chunk."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        task = TaskContext.get().partitionId()
        blank = dict.fromkeys(PASS.names)
        state = {"chunk": 0}

        def flush(groups: list[list[tuple]], head_open: bool, tail_open: bool) -> pa.RecordBatch:
            """``groups``: rows by conversation; the first and the last may go on elsewhere."""
            out: dict[str, list] = {name: [] for name in PASS.names}
            before_these = 0
            for g, rows in enumerate(groups):
                if (g == 0 and head_open) or (g == len(groups) - 1 and tail_open):
                    found = [{"task": task, "chunk": state["chunk"], "pos": before_these + i, "turn": t, "role": r, "text": x,
                              "dropped": d, "key": None if d else seen_key(r, x)} for i, (_, t, r, x, d) in enumerate(rows)]
                else:
                    found = [whole_conversation([(t, r, x) for _, t, r, x, d in rows if not d])]
                before_these += len(rows)
                for row in found:
                    for name, v in (blank | row | {"conv_id": rows[0][0]}).items():
                        out[name].append(v)
            state["chunk"] += 1
            return to_batch(out, PASS)

        groups: list[list[tuple]] = []
        held = size = 0
        head_open = True        # the range's first conversation may have begun in another task
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for row in zip(*(c.to_pylist() for c in batch.slice(at, 256).columns), strict=True):
                    same = bool(groups) and groups[-1][0][0] == row[0]
                    if groups and (held >= chunk_rows or size >= chunk_bytes):
                        # close at a conversation's end, or within the first one of a chunk
                        if not same:
                            yield flush(groups, head_open, False)
                            groups, held, size, head_open = [], 0, 0, False
                        elif len(groups) == 1:
                            yield flush(groups, True, True)
                            groups, held, size, head_open, same = [], 0, 0, True, False
                        else:
                            last = groups.pop()
                            yield flush(groups, head_open, False)
                            groups, held, size, head_open = [last], len(last), sum(len(r[2]) + len(r[3]) for r in last), False
                    if same:
                        groups[-1].append(row)
                    else:
                        groups.append([row])
                    held += 1
                    size += len(row[2]) + len(row[3])
        if groups:
            yield flush(groups, head_open, True)
    return run


SEGMENT = T.StructType([
    ID, T.StructField("at", T.LongType()), T.StructField("codes", T.BinaryType()), T.StructField("matrix", T.ArrayType(T.LongType())),
    T.StructField("blank", T.LongType()), T.StructField("duplicate", T.LongType()), T.StructField("truncated", T.LongType()),
    T.StructField("illegal", T.LongType()), T.StructField("first", T.IntegerType()), T.StructField("final", T.IntegerType())])
CHECKPOINT = T.StructType([ID, T.StructField("at", T.LongType()), T.StructField("end", T.ArrayType(T.LongType())),
                           T.StructField("opens", T.BooleanType()), T.StructField("closes", T.BooleanType())])
WALKS = T.StructType([ID, T.StructField("at", T.LongType()), T.StructField("cost", T.ArrayType(T.LongType())),
                      T.StructField("audit", T.ArrayType(T.StringType())), T.StructField("state", T.ArrayType(T.IntegerType()))])
CHOSEN = T.StructType([ID, T.StructField("at", T.LongType()), T.StructField("cost", T.LongType()), T.StructField("audit", T.StringType()),
                       T.StructField("begins", T.IntegerType())])
LINES = T.StructType([ID, T.StructField("at", T.LongType()), T.StructField("cost", T.LongType()), T.StructField("audit", T.StringType()),
                      T.StructField("lines", T.BinaryType()), T.StructField("any", T.BooleanType())])
ENDS = T.StructType([ID, T.StructField("cost", T.LongType()), T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())])


def segment(key: tuple, turns: pa.Table) -> pa.Table:
    """Codes, faults and cost matrix of the turns of one segment."""
    rows = turns.sort_by("at").to_pylist()
    counts, codes, illegal = [0, 0, 0], bytearray(), 0
    for row in rows:
        kind, initial = row["kind"], row["initial"]
        if kind == GOES:
            counts[0] += 1
        elif not row["is_first"]:
            kind = GOES
            counts[1] += 1
        elif kind == CUT:
            counts[2] += 1
        illegal += bool(codes) and not follows(codes[-1] % 4, initial)
        codes.append(4 * kind + initial)
    out = {"conv_id": [key[0].as_py()], "at": [rows[0]["at"]], "codes": [bytes(codes)], "matrix": [matrix(bytes(codes))],
           "blank": [counts[0]], "duplicate": [counts[1]], "truncated": [counts[2]], "illegal": [illegal],
           "first": [codes[0] % 4], "final": [codes[-1] % 4]}
    return pa.Table.from_batches([to_batch(out, SEGMENT)])


def by_conversation(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, dict]]:
    """(begins a conversation, row) of rows sorted by conversation."""
    last: object = by_conversation
    for b in batches:
        for at in range(0, b.num_rows, 64):
            for row in b.slice(at, 64).to_pylist():
                yield row["conv_id"] != last or last is by_conversation, row
                last = row["conv_id"]


def ordered(df: DataFrame) -> DataFrame:
    """Conversations whole in a task and in order; only for rows of one per segment."""
    return df.repartition("conv_id").sortWithinPartitions("conv_id", "at")


def outer_checkpoints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cost vectors at the segments' ends, from matrices read in order."""
    def solved(rows: list[dict]) -> pa.RecordBatch:
        vector, ends = END, []
        for row in reversed(rows):
            ends.append(vector)
            after, m = with_inserts(vector), row["matrix"]
            vector = tuple(min(min(m[4 * q + goal] + after[goal] for goal in STATES), INF) for q in STATES)
        n = len(rows)
        return to_batch({"conv_id": [r["conv_id"] for r in rows], "at": [r["at"] for r in rows], "end": [list(e) for e in reversed(ends)],
                         "opens": [i == 0 for i in range(n)], "closes": [i == n - 1 for i in range(n)]}, CHECKPOINT)

    rows: list[dict] = []
    for begins, row in by_conversation(batches):
        if begins and rows:
            yield solved(rows)
            rows = []
        rows.append(row)
    if rows:
        yield solved(rows)


def walks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each segment walked from the states that it may begin in."""
    for b in batches:
        for at in range(0, b.num_rows, 64):
            out: dict[str, list] = {name: [] for name in WALKS.names}
            for row in b.slice(at, 64).to_pylist():
                found = [repair(row["codes"], tuple(row["end"]), q, row["closes"]) if q == START or not row["opens"] else (0, "", 0) for q in STATES]
                for name, v in zip(WALKS.names, (row["conv_id"], row["at"], *(list(x) for x in zip(*found, strict=True))), strict=True):
                    out[name].append(v)
            yield to_batch(out, WALKS)


def chosen_walks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The walk of each segment that begins where the one before ended."""
    state = START
    for begins, row in by_conversation(batches):
        if begins:
            state = START
        yield to_batch({"conv_id": [row["conv_id"]], "at": [row["at"]], "cost": [row["cost"][state] if begins else 0],
                        "audit": [row["audit"][state]], "begins": [state]}, CHOSEN)
        state = row["state"][state]


def segment_lines(key: tuple, turns: pa.Table, chosen: pa.Table) -> pa.Table:
    rows, walk = turns.sort_by("at").to_pylist(), chosen.to_pylist()[0]
    lines = repaired_lines(walk["audit"], walk["begins"], [(r["role"], r["text"]) for r in rows])
    out = {c: [walk[c]] for c in ("conv_id", "at", "cost", "audit")}
    return pa.Table.from_batches([to_batch(out | {"lines": ["\n".join(lines).encode()], "any": [bool(lines)]}, LINES)])


def joined_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Audit and hash of each conversation, fed segment by segment."""
    now: dict | None = None

    def closed() -> pa.RecordBatch:
        return to_batch({"conv_id": [now["conv_id"]], "cost": [now["cost"]], "audit": ["".join(now["audit"])],
                         "repaired_sha256": [now["hash"].hexdigest()]}, ENDS)

    for begins, row in by_conversation(batches):
        if begins:
            if now:
                yield closed()
            now = {"conv_id": row["conv_id"], "cost": row["cost"], "audit": [], "hash": hashlib.sha256(), "any": False}
        now["audit"].append(row["audit"])
        if row["any"]:
            if now["any"]:
                now["hash"].update(b"\n")
            now["hash"].update(row["lines"])
            now["any"] = True
    if now:
        yield closed()


def split_conversations(spark: SparkSession, turns: DataFrame) -> DataFrame:
    """Results of conversations whose turns lie in several chunks."""
    ids = turns.select("conv_id").distinct()
    at = F.shiftleft(F.col("task").cast("long"), 40) + F.shiftleft(F.col("chunk").cast("long"), 16) + F.col("pos")
    live = turns.where("not dropped").withColumn("at", at).withColumn("chunk", F.shiftright("at", 16))
    firsts = live.groupBy("conv_id", "key").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("is_first"))
    trimmed = F.rtrim("text", F.lit(SPACE))
    kind = F.when(trimmed == "", GOES).when(F.substring(trimmed, -1, 1).isin(".", "!", "?"), SOUND).otherwise(CUT)
    initial = F.substring("role", 1, 1)
    initials = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    thin = (live.select("conv_id", "chunk", "at", kind.alias("kind"), initials.alias("initial"))
            .join(firsts, "at", "left").withColumn("is_first", F.coalesce("is_first", F.lit(False))))
    segments = stage(spark, thin.groupBy("conv_id", "chunk").applyInArrow(segment, SEGMENT), "segments")
    ends = ordered(segments.select("conv_id", "at", "matrix")).mapInArrow(outer_checkpoints, CHECKPOINT)
    asked = segments.select("at", "codes").join(ends, "at").select("conv_id", "at", "codes", "end", "opens", "closes")
    walked = stage(spark, asked.mapInArrow(walks, WALKS), "walks")
    chosen = ordered(walked).mapInArrow(chosen_walks, CHOSEN).withColumn("chunk", F.shiftright("at", 16))
    lines = (live.select("chunk", "at", "role", "text", "conv_id").groupBy("conv_id", "chunk")
             .cogroup(chosen.groupBy("conv_id", "chunk")).applyInArrow(segment_lines, LINES))
    texts = ordered(lines).mapInArrow(joined_segments, ENDS)
    # what two segments have between them, by segments in order
    order = F.struct("at", "first", "final")
    seams = segments.groupBy("conv_id").agg(
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")], F.array_sort(F.collect_list(order)).alias("s"))
    legal = F.array(*[F.lit(10 * a + b) for a, b in ((0, 1), (1, 2), (2, 1))])
    between = F.size(F.filter(F.sequence(F.lit(1), F.size("s")), lambda i: (i > 1) & ~F.array_contains(
        legal, F.element_at("s", F.greatest(i - 1, F.lit(1)))["final"] * 10 + F.element_at("s", i)["first"])))
    faults = seams.select("conv_id", "blank", "duplicate", "truncated", (F.col("illegal") + between).alias("illegal"))
    gaps = live.groupBy("conv_id").agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps"))
    out = ids
    for part in (gaps, faults, texts):
        part = part.withColumnRenamed("conv_id", "_id")
        out = out.join(part, F.col("conv_id").eqNullSafe(F.col("_id")), "left").drop("_id")
    empty = {"audit": "", "repaired_sha256": hashlib.sha256(b"").hexdigest()}
    return out.select(*[F.coalesce(F.col(f.name), F.lit(empty.get(f.name, 0)).cast(f.dataType)).alias(f.name) if f.name != "conv_id"
                        else F.col("conv_id") for f in RESULT.fields])


def repair_conversations(spark: SparkSession, rows: DataFrame, chunk_rows: int = CHUNK_ROWS, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per conversation of ``rows`` (conv_id, turn, role, text, dropped): its faults, the
    least cost, the edits and the hash of the repaired conversation."""
    ship_package(spark)
    head = F.substring("text", 1, 64)
    columns = rows.select("conv_id", "turn", "role", "text", "dropped")
    ranged = (columns.repartitionByRange(*[F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role")], head)
              .sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "text")]))
    seen = stage(spark, ranged.mapInArrow(first_pass(chunk_rows, chunk_bytes), PASS), "turns")
    done = seen.where("task is null").select(*RESULT.names)
    return done.unionByName(split_conversations(spark, seen.where("task is not null").drop(*[f.name for f in SUMMARY])))


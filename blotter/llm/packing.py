"""Operator 4: hierarchical multi-length packing.

Documents are tokenised, ended by id 0, and cut into whole windows of the
longest tier; what remains of each is routed to the smallest tier that holds
it.  Tiers are packed from the longest down: a piece opens a window of its
tier, and the gap is filled with the largest fitting pieces of the shorter
tiers, at last with a cut of a longer one, so windows are exactly full.  Full
windows are then dealt to step groups of equal token counts.

Each task packs its own rows in one pass with a bounded pool; nothing is
shuffled or gathered.  Only a task's last, unfilled window can hold padding.

Defined results: null and empty texts are the end id alone; a document longer
than a window is cut into several pieces; repeated rows are packed each, null
ids like any other; an empty table gives an empty result; extra columns are
ignored."""

from __future__ import annotations

import bisect
import heapq
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blotter.llm.common import ship_package, text_slices, to_batch
from blotter.llm.tokens import encoder

TIERS = (128, 256, 512, 1024)
POOL_TOKENS = 1 << 20
STEP_TOKENS = 1 << 16
END_ID = (0).to_bytes(4, "little")

PIECES = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
    T.StructField("ids_crc32", T.LongType()), T.StructField("doc_tokens", T.LongType()),
    T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType()),
    T.StructField("sequence_tokens", T.IntegerType()), T.StructField("tier", T.IntegerType()),
    T.StructField("step_id", T.LongType())])


class TierPacker:
    """Packs pieces (doc, start, ids) into windows; ``take`` gives the windows made.

    A piece is (length in tokens, serial number, doc, start, ids as bytes)."""

    def __init__(self, tiers: tuple[int, ...] = TIERS):
        self.tiers, self.longest = sorted(tiers), max(tiers)
        self.pool: list[tuple[int, int, object, int, bytes]] = []
        self.serial = self.pooled = 0
        self.windows: list[tuple[int, list]] = []

    def tier_of(self, tokens: int) -> int:
        return self.tiers[bisect.bisect_left(self.tiers, tokens)]

    def _piece(self, doc, start: int, ids: bytes) -> tuple:
        self.serial += 1
        return (len(ids) // 4, self.serial, doc, start, ids)

    def add(self, doc, ids: bytes) -> None:
        tokens, start = len(ids) // 4, 0
        while tokens - start >= self.longest:
            end = start + self.longest
            self.windows.append((self.longest, [self._piece(doc, start, ids[4 * start:4 * end])]))
            start = end
        if start < tokens:
            self.pool.append(self._piece(doc, start, ids[4 * start:]))
            self.pooled += tokens - start

    def pack(self, last: bool) -> None:
        """Make windows of the pool; an unfilled one goes back to the pool, or
        with ``last`` is closed as it is, in the shortest tier that holds it."""
        rest = sorted(self.pool)
        self.pool, self.pooled = [], 0
        while rest:
            first = rest.pop()
            room = size = self.tier_of(first[0])
            inside = []
            while first is not None:
                if first[0] > room:  # cut to fill the window; what is left returns to its tier
                    _, _, doc, start, ids = first
                    first = self._piece(doc, start, ids[:4 * room])
                    bisect.insort(rest, self._piece(doc, start + room, ids[4 * room:]))
                inside.append(first)
                room -= first[0]
                first = None
                if room and rest:
                    fits = bisect.bisect_left(rest, (room + 1,))
                    first = rest.pop(fits - 1 if fits else 0)
            if not room:
                self.windows.append((size, inside))
            elif last:
                self._close(inside)
            else:
                self.pool += inside
                self.pooled += size - room

    def _close(self, pieces: list) -> None:
        """Split the last pieces over exactly full windows of ever shorter tiers;
        less than the shortest tier is left, in one padded window."""
        left = sum(p[0] for p in pieces)
        while pieces:
            fit = [t for t in self.tiers if t <= left]
            size = room = fit[-1] if fit else left
            inside = []
            while room:
                p = pieces.pop()
                if p[0] > room:
                    pieces.append(self._piece(p[2], p[3] + room, p[4][4 * room:]))
                    p = self._piece(p[2], p[3], p[4][:4 * room])
                inside.append(p)
                room -= p[0]
            self.windows.append((size if fit else self.longest, inside))
            left -= size

    def take(self) -> list[tuple[int, list]]:
        made, self.windows = self.windows, []
        return made


def step_groups(sizes: list[int], step_tokens: int) -> list[int]:
    """A step number for each window, so that the steps' tokens are near equal:
    longest windows first, each to the step with least tokens so far."""
    steps = [(0, k) for k in range(max(1, -(-sum(sizes) // step_tokens)))]
    out = [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        filled, k = heapq.heappop(steps)
        out[i] = k
        heapq.heappush(steps, (filled + sizes[i], k))
    return out


def pack(docs: DataFrame, ranks_path: str, pattern: str, tiers: tuple[int, ...] = TIERS, step_tokens: int = STEP_TOKENS,
         pool_tokens: int = POOL_TOKENS, with_ids: bool = False) -> DataFrame:
    """One row per piece of ``docs`` (doc_id, text): where it lies in its document
    and in its sequence, the sequence's tokens, tier and step; ``with_ids`` adds
    the ids themselves."""
    ship_package(docs.sparkSession)
    schema = T.StructType(PIECES.fields + [T.StructField("ids", T.BinaryType())]) if with_ids else PIECES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        base = TaskContext.get().partitionId() << 33
        encode, packer, counts = encoder(ranks_path, pattern).encode, TierPacker(tiers), [0, 0]

        def rows() -> Iterator[pa.RecordBatch]:
            windows = packer.take()
            used = [sum(p[0] for p in inside) for _, inside in windows]
            steps = step_groups(used, step_tokens)
            out: dict[str, list] = {f.name: [] for f in schema.fields}
            for (tier, inside), tokens, step in zip(windows, used, steps, strict=True):
                offset = 0
                for length, _, (doc_id, doc_tokens), start, ids in inside:
                    row = (doc_id, start, length, zlib.crc32(ids), doc_tokens, base + counts[0], offset, tokens, tier,
                           base + counts[1] + step, ids)
                    for name, v in zip(schema.names, row, strict=False):
                        out[name].append(v)
                    offset += length
                counts[0] += 1
            counts[1] += max(steps, default=-1) + 1
            if windows:
                yield to_batch(out, schema)

        for b in batches:
            doc_ids, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            for lo, hi in text_slices(texts):
                for doc_id, ids in zip(doc_ids[lo:hi], encode(texts[lo:hi]), strict=True):
                    ids += END_ID
                    packer.add((doc_id, len(ids) // 4), ids)
                if packer.pooled >= pool_tokens or len(packer.windows) >= 2000:
                    packer.pack(last=False)
                    yield from rows()
        packer.pack(last=True)
        yield from rows()

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
            .mapInArrow(run, schema))

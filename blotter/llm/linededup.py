"""Operator 2: fuzzy line deduplication.

Lines are normalised to their lower-cased words.  The runs of ``KEY_RUN`` words of a line
are ordered by how rare they are in the table: a first scan counts runs of ``RUN`` words in
2**SLOT_BITS slots, whatever the size of the table, and a key run is as rare as the rarer of its
two.  An edit changes at most ``KEY_RUN`` key runs, so of two lines within the allowed edits each has
one of the other's runs among its rarest few (:func:`prefix_runs`): lines that share one of
these, at places that the edits allow (:func:`has_room`), are candidates, and no pair is
lost, however the order falls out.  Lines of at most ``SHORT`` words are candidates also where
they agree after the deletions that their length allows.  Candidates are compared whose parities
of ``PLANES`` x 64 bits leave room, which loses no pair either.
A candidate pair is a link when the edit distance of
the word sequences is at most 1 - ``SIMILARITY`` of the longer one.  Of all
occurrences of a connected group of lines the first (least doc_id, hash of the
text, line number) stays, the others are removed.

Lines travel as hashes.  The keys of a second scan travel as packed cells, one for each task and
part of the hashes: differences of sorted keys, 32 bits of the line's name, its length and the
key's place.  Keys of one line end where they meet; the others give pairs.  The words of
lines in a pair are fetched in a third scan; only texts that may lose a line (a bitmap of 16 MB
tells) are shuffled, to be rebuilt, the others pass through.

Defined results: null text is empty and stays null; a line without letter or
digit is never removed for itself; a text that loses all its lines with words
is empty (:func:`deduplicated` drops it); a null doc_id sorts first; rows that
repeat both doc_id and text get equal results; an empty table gives an empty
result; extra columns pass through :func:`deduplicated`."""

from __future__ import annotations

import ctypes
import functools
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.llm.common import ship_package, stage, text_slices, unstage
from blotter.llm.components import _measured, allowed_edits, connected, least_words, max_edits, maybe_wanted, wanted_filter
from blotter.llm.ctw import packed, unpacked
from blotter.llm.wordunits import CODES, Units, mixed

BLOCKS, BLOCK_BITS = 20, 3  # BLOCKS * BLOCK_BITS < 64
MAX_BITS = 24
RUN, KEY_RUN = 2, 3  # a key run is two runs that overlap
SLOT_BITS, CHUNK_BITS = 24, 16
ALONE = 1  # the code of a run that the table holds once
SHORT = 9
SIMILARITY = 0.8
CHUNK = 1 << 15
PLANES = 8
PLANE_NAMES = [f"p{k}" for k in range(PLANES)]
FAR = 255  # the place of all keys from there on, and of those that a line has several times
ROWS = 500  # texts held as strings at once
SLICE = 500_000  # characters whose arrays are held at once
LOT = 1 << 19
PART_LINES = 50_000
SMALL_BUCKET = 16
BLOCK = 1 << 17


def simhash_blocks(words: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """units x BLOCKS: the blocks of each unit's SimHash (every word one vote); no
    unit is empty."""
    ones = np.empty((len(offsets) - 1, 64), dtype=bool)
    # runs of whole units of about CHUNK words, so the bit matrix stays small
    at = 0
    while at < len(ones):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK, side="right")) - 1)
        lo, hi = offsets[at], offsets[end]
        bits = np.unpackbits(mixed(words[lo:hi]).view(np.uint8).reshape(-1, 8), axis=1)
        votes = np.add.reduceat(bits, offsets[at:end] - lo, axis=0, dtype=np.uint16 if hi - lo < 1 << 15 else np.int64)
        ones[at:end] = 2 * votes > np.diff(offsets[at:end + 1])[:, None]
        at = end
    weights = 1 << np.arange(BLOCK_BITS, dtype=np.int64)
    return (ones[:, :BLOCKS * BLOCK_BITS].reshape(-1, BLOCKS, BLOCK_BITS) * weights).sum(axis=2).astype(np.uint64)


def simhashes(words: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The SimHash of each unit as one number, its blocks side by side; -1, which it
    never is, for units of at most SHORT words.  Links do not depend on it any more; tests hold
    candidates to the stricter measure of MAX_BITS."""
    n = np.diff(offsets)
    out = np.full(len(n), -1, dtype=np.int64)
    long = n > SHORT
    if long.any():
        blocks = simhash_blocks(words[np.repeat(long, n)], np.concatenate([[0], np.cumsum(n[long])]))
        out[long] = (blocks << np.arange(0, BLOCKS * BLOCK_BITS, BLOCK_BITS, dtype=np.uint64)).sum(axis=1, dtype=np.uint64).view(np.int64)
    return out


def parity_planes(words: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """PLANES x 64 bits of each unit: each word, as the character that alignment takes it for, flips
    one.  An edit flips two at most, so units of k edits differ in at most 2 k bits, less the
    difference of their lengths (insertions and deletions flip one)."""
    spread = mixed(words % np.uint64(CODES) + np.uint64(1))
    flip, plane = np.uint64(1) << (spread & np.uint64(63)), (spread >> np.uint64(6)) % np.uint64(PLANES)
    out = []
    for k in range(PLANES):
        flips = np.zeros(len(words) + 1, dtype=np.uint64)
        np.bitwise_xor.accumulate(np.where(plane == k, flip, np.uint64(0)), out=flips[1:])
        out.append((flips[offsets[1:]] ^ flips[offsets[:-1]]).view(np.int64))
    return out


def parities(words: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The planes of each unit as one, which keeps their bound."""
    return functools.reduce(np.bitwise_xor, parity_planes(words, offsets))


def word_runs(words: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of RUN words of all units, and the unit of each."""
    unit = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    left = offsets[1:][unit] - np.arange(len(words))
    runs = mixed(words)
    for k in range(1, RUN):
        runs[:len(words) - k] = mixed((runs[:len(words) - k] ^ words[k:]) + np.uint64(k))
    return runs[left >= RUN], unit[left >= RUN]


def least_run_words(share: float) -> int:
    """The shortest units that can be linked to one of more than SHORT words."""
    return max(KEY_RUN, math.ceil((1 - share) * (SHORT + 1) - 1e-6))


@functools.cache
def prefix_runs(n: int, share: float) -> int:
    """How many key runs of a unit of ``n`` words may be missing from a unit that it is linked
    to, and one: k edits of a unit of m words, the longer one, leave all but KEY_RUN * k of its runs."""
    return 1 + max(n - m + KEY_RUN * allowed_edits(share, m, n) for m in range(n, math.floor(n / (1 - share) + 1e-6) + 1))


def rare_runs(words: np.ndarray, offsets: np.ndarray, share: float, codes: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(unit, key, place) of each unit's rarest key runs, as many as a partner may lack and one; one
    that the unit has several times is one, at the place FAR.  A key run is as rare as the rarer of its two runs by ``codes``,
    ties go by hash."""
    n = np.diff(offsets)
    runs, unit = word_runs(words, offsets)
    code = np.zeros(len(runs), np.uint8) if codes is None else codes[runs >> np.uint64(64 - SLOT_BITS)]
    whole = unit[1:] == unit[:-1]
    keys = mixed(runs[:-1] ^ (runs[1:] * np.uint64(3)))[whole]
    code, unit = np.minimum(code[:-1], code[1:])[whole].astype(np.uint64), unit[:-1][whole]
    ends = np.cumsum(np.bincount(unit, minlength=len(n)))
    starts = ends - np.bincount(unit, minlength=len(n))
    lengths, which = np.unique(n, return_inverse=True)
    most = np.array([prefix_runs(int(m), share) for m in lengths], dtype=np.int64)[which]
    last = np.maximum(np.minimum(starts + most, ends) - 1, 0)
    place, kept = np.arange(len(keys)) - starts[unit], np.zeros(len(keys), dtype=bool)
    # unit, code and 40 bits of the hash in one word, so the runs of 2**16 units are sorted by it
    for first in range(0, len(n), 1 << 16):
        lo, hi = starts[first], ends[first:first + (1 << 16)][-1]
        row = unit[lo:hi] - first
        mine = (row.astype(np.uint64) << np.uint64(48)) | (code[lo:hi] << np.uint64(40)) | (keys[lo:hi] & np.uint64((1 << 40) - 1))
        if hi > lo:
            ordered = np.sort(mine)
            kept[lo:hi] = mine <= ordered[np.clip(last[first:first + (1 << 16)] - lo, 0, hi - lo - 1)][row]
            again = np.flatnonzero(np.isin(mine, ordered[1:][ordered[1:] == ordered[:-1]]) & kept[lo:hi])
            place[lo + again] = FAR
            kept[lo + np.delete(again, np.unique(mine[again], return_index=True)[1])] = False
    at = np.flatnonzero(kept)
    return unit[at], keys[at], place[at]


def _thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of few rows, so that few texts are Python strings at once; what Arrow and the C
    library hold of freed memory is given back at their end, since workers wait for later stages."""
    for b in batches:
        for lo in range(0, b.num_rows, ROWS):
            yield b.slice(lo, ROWS)
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def _named(batches: Iterator[pa.RecordBatch], share: float) -> Iterator[pa.RecordBatch]:
    """The names of all lines with a word, and how often each slot's runs are met in one task's lines,
    by chunks of slots."""
    schema = pa.schema([("chunk", pa.int32()), ("n", pa.binary()), ("doc_id", pa.int64()), ("th", pa.int64()), ("line", pa.int32()), ("h1", pa.int64()), ("h2", pa.int64())])
    counts = np.zeros(1 << SLOT_BITS, dtype=np.uint16)
    for b in _thin(batches):
        texts = b.column(2).to_pylist()
        for lo, hi in text_slices(texts, SLICE):
            units = Units(texts[lo:hi], by_line=True)
            n = np.diff(units.offsets)
            some = n >= least_run_words(share)
            runs = word_runs(units.words[np.repeat(some, n)], np.concatenate([[0], np.cumsum(n[some])]))[0]
            slots, met = np.unique(runs >> np.uint64(64 - SLOT_BITS), return_counts=True)
            counts[slots] = np.minimum(counts[slots] + met, 0xFFFF)
            at = np.flatnonzero(n > 0)
            doc = pa.array(units.text[at] + lo)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(at), pa.int32()), pa.nulls(len(at), pa.binary()), b.column(0).take(doc), b.column(1).take(doc),
                 pa.array(units.line[at], pa.int32()), *(pa.array(h[at]) for h in units.names())], schema=schema)
    for k, part in enumerate(counts.reshape(-1, 1 << CHUNK_BITS)):
        if part.any():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([packed(part)], pa.binary()), *(pa.nulls(1, f.type) for f in list(schema)[2:])], schema=schema)


def named_and_counted(docs: DataFrame, share: float) -> DataFrame:
    """The rows of :func:`_named`: names of lines where ``chunk`` is null, else counts."""
    body = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(body).alias("th"), body.alias("text"))
            .mapInArrow(functools.partial(_named, share=share), "chunk int, n binary, doc_id long, th long, line int, h1 long, h2 long"))


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each chunk of sorted rows: its counts over all tasks, as codes that
    grow with them; ALONE stands for one and for nothing else."""
    rows = ((k, n) for b in batches for k, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
    for k, parts in itertools.groupby(rows, key=lambda r: r[0]):
        total = np.zeros(1 << CHUNK_BITS, dtype=np.int64)
        for _, n in parts:
            total += unpacked(n, np.uint16)
        codes = np.where(total > 0, np.minimum(ALONE + np.floor(15 * np.log2(np.maximum(total, 1))), 255), 0).astype(np.uint8)
        yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([codes.tobytes()], pa.binary())], ["chunk", "n"])


def slot_codes(spark: SparkSession, scanned: DataFrame):
    """A broadcast array: for each slot of runs a code of how often it is met in all tasks."""
    codes = np.zeros((1 << SLOT_BITS - CHUNK_BITS, 1 << CHUNK_BITS), dtype=np.uint8)
    counted = scanned.where("chunk is not null").select("chunk", "n")
    for r in counted.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(_coded, "chunk int, n binary").collect():
        codes[r["chunk"]] = np.frombuffer(r["n"], dtype=np.uint8)
    return spark.sparkContext.broadcast(codes.ravel())


def run_codes(spark: SparkSession, docs: DataFrame, share: float):
    """:func:`slot_codes` of ``docs``."""
    return slot_codes(spark, named_and_counted(docs, share))


def deletion_keys(words: np.ndarray, share: float) -> np.ndarray:
    """units x ways: hashes of the units (rows of ``words``, equal in length) with up
    to their allowed edits of words deleted."""
    n = words.shape[1]
    out = []
    for deleted in range(allowed_edits(share, n, 0) + 1):
        for places in itertools.combinations(range(n), n - deleted):
            h = np.full(len(words), np.uint64(n - deleted))
            for at in places:
                h = mixed(h * np.uint64(3) + words[:, at])
            out.append(h)
    return np.stack(out, axis=1)


def placed_keys(words: np.ndarray, offsets: np.ndarray, share: float, codes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(unit, key, place) of all keys: units that share one are candidates, where the places leave
    room (:func:`has_room`).  Units too short for any link have none.  Deletions stand at place 0."""
    n = np.diff(offsets)
    rows, keys, places = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for length in range(least_words(share), SHORT + 1):
        some = np.flatnonzero(n == length)
        if len(some):
            found = deletion_keys(words[offsets[some][:, None] + np.arange(length)], share)
            rows.append(np.repeat(some, found.shape[1]))
            keys.append(found.ravel())
            places.append(np.zeros(found.size, np.int64))
    long = np.flatnonzero(n >= least_run_words(share))
    if len(long):
        mine = words[np.repeat(n >= least_run_words(share), n)]
        unit, found, place = rare_runs(mine, np.concatenate([[0], np.cumsum(n[long])]), share, codes)
        rows.append(long[unit])
        keys.append(found)
        places.append(place)
    return np.concatenate(rows), np.concatenate(keys), np.concatenate(places)


def candidate_keys(words: np.ndarray, offsets: np.ndarray, share: float, codes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys of each unit, as (ends, keys)."""
    row, key, _ = placed_keys(words, offsets, share, codes)
    order = np.lexsort((key, row))
    row, key = row[order], key[order]
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (key[1:] != key[:-1])
    return np.concatenate([[0], np.cumsum(np.bincount(row[new], minlength=len(offsets) - 1))]).astype(np.int32), key[new].view(np.int64)


def has_room(n: np.ndarray, place: np.ndarray, m: np.ndarray, at: np.ndarray, share: float) -> np.ndarray:
    """Whether units of ``n`` and ``m`` words with a key at ``place`` and ``at`` may be links by that
    key: the words before it and those after it differ in number by no more than the edits.  Linked
    units have a key of which this holds: of the runs that the edits leave, the rarest."""
    edits = np.floor(share * np.maximum(n, m) + 1e-6)
    known = np.maximum(place, at) < FAR
    return (np.abs(n - m) <= edits) & (~known | (np.abs(place - at) + np.abs((n - place) - (m - at)) <= edits))


def _cells(held: list[tuple[np.ndarray, ...]], parts: int) -> pa.RecordBatch:
    """The keys of many lines, a row for each part: sorted keys as differences, tags, lengths, places."""
    keys, tags, n, places = (np.concatenate(c) for c in zip(*held, strict=True))
    part = (keys >> np.uint64(32)) % np.uint64(parts)
    low = keys & np.uint64(0xFFFFFFFF)
    order = np.argsort((part << np.uint64(32)) | low)
    part, low = part[order].astype(np.int64), low[order].astype(np.uint32)
    starts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else np.zeros(0, np.int64)
    ends = np.append(starts[1:], len(part))
    tags, n, places = tags[order], n[order], places[order]
    rows = [(int(part[lo]), packed(np.diff(low[lo:hi], prepend=np.uint32(0))), packed(tags[lo:hi]), packed(n[lo:hi]), packed(places[lo:hi]))
            for lo, hi in zip(starts.tolist(), ends.tolist(), strict=True)]
    kinds = [pa.int32(), *[pa.binary()] * 4]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], ["part", "keys", "tags", "n", "places"])


def tag_of(h1: np.ndarray) -> np.ndarray:
    """32 bits of a line's name, which stand for it where it travels with each key."""
    return (h1.view(np.uint64) >> np.uint64(32)).astype(np.uint32)


def _keyed(batches: Iterator[pa.RecordBatch], share: float, codes, parts: int) -> Iterator[pa.RecordBatch]:
    """The cells of the lines of one task, equal lines once in LOT keys."""
    held, size, seen = [], 0, np.zeros(0, np.int64)
    for b in _thin(batches):
        texts = b.column(0).to_pylist()
        for lo, hi in text_slices(texts, SLICE):
            units = Units(texts[lo:hi], by_line=True)
            n, h1 = np.diff(units.offsets), units.first_names()
            wanted = np.zeros(len(n), dtype=bool)
            wanted[np.unique(h1, return_index=True)[1]] = True
            wanted &= (n >= least_words(share)) & ~np.isin(h1, seen)
            seen = np.concatenate([seen, h1[wanted]])
            sizes = n[wanted]
            row, key, place = placed_keys(units.words[np.repeat(wanted, n)], np.concatenate([[0], np.cumsum(sizes)]), share, codes.value)
            held.append((key, tag_of(h1[wanted])[row], sizes.astype(np.uint32)[row], np.minimum(place, FAR).astype(np.uint8)))
            size += len(key)
            if size >= LOT:
                cells = _cells(held, parts)
                held, size, seen = [], 0, np.zeros(0, np.int64)
                yield cells
    if size:
        yield _cells(held, parts)


def _met(batches: Iterator[pa.RecordBatch], share: float) -> Iterator[pa.RecordBatch]:
    """Of cells sorted by part, the buckets of two lines or more: the pairs (x, y) of tags that may be
    links, of a bucket of more than SMALL_BUCKET entries only those with its least and its greatest
    tag, and its entries: x is the tag, y the least one."""
    cells = ((p, c) for b in batches for p, *c in zip(*(col.to_pylist() for col in b.columns), strict=True))
    for part, rows in itertools.groupby(cells, key=lambda r: r[0]):
        keys, tags, n, place = (np.concatenate(c) for c in zip(*(
            (np.cumsum(unpacked(c[0], np.uint32), dtype=np.uint32), unpacked(c[1], np.uint32), unpacked(c[2], np.uint32), unpacked(c[3], np.uint8)) for _, c in rows), strict=True))
        both = (keys.astype(np.uint64) << np.uint64(32)) | tags
        order = np.argsort(both)
        both = both[order]
        starts, counts = _stretches(both >> np.uint64(32))
        some = both[starts] != both[starts + counts - 1]  # more than one line
        order = order[np.repeat(some, counts)]
        # what is left is little: copies of a line from several tasks go, places in order
        order = order[np.lexsort((place[order], tags[order], keys[order]))]
        keys, tags, n, place = keys[order], tags[order].astype(np.int64), n[order].astype(np.int64), place[order].astype(np.int64)
        new = np.ones(len(keys), dtype=bool)
        new[1:] = (keys[1:] != keys[:-1]) | (tags[1:] != tags[:-1]) | (place[1:] != place[:-1])
        keys, tags, n, place = keys[new], tags[new], n[new], place[new]
        starts, counts = _stretches(keys)
        found = []

        def add(a: np.ndarray, b: np.ndarray) -> None:
            fit = (tags[a] != tags[b]) & has_room(n[a], place[a], n[b], place[b], share)
            a, b = tags[a[fit]], tags[b[fit]]
            found.append((np.minimum(a, b).astype(np.uint64) << np.uint64(32)) | np.maximum(a, b).astype(np.uint64))

        for size in range(2, SMALL_BUCKET + 1):
            first = starts[counts == size]
            i, j = np.triu_indices(size, 1)
            step = BLOCK // len(i)
            for lo in range(0, len(first), step):
                add((first[lo:lo + step, None] + i).ravel(), (first[lo:lo + step, None] + j).ravel())
        hot = counts > SMALL_BUCKET
        each = np.flatnonzero(np.repeat(hot, counts))
        leader = np.repeat(starts[hot], counts[hot])
        add(each, leader)
        add(each, np.repeat(starts[hot] + counts[hot] - 1, counts[hot]))
        pairs = np.unique(np.concatenate(found))
        if len(pairs):
            yield _rows(x=pa.array((pairs >> np.uint64(32)).astype(np.int64)), y=pa.array((pairs & np.uint64(0xFFFFFFFF)).astype(np.int64)))
        if len(each):
            yield _rows(x=pa.array(tags[each]), y=pa.array(tags[leader]), bucket=pa.array((part << 32) | keys[each].astype(np.int64)), n=pa.array(n[each]), place=pa.array(place[each]))


def _stretches(sorted_values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the stretches of equal values."""
    if not len(sorted_values):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts = np.flatnonzero(np.concatenate([[True], sorted_values[1:] != sorted_values[:-1]]))
    return starts, np.diff(np.append(starts, len(sorted_values)))


def _rows(**columns: pa.Array) -> pa.RecordBatch:
    """A batch of :func:`_met`."""
    size = len(columns["x"])
    names = ["x", "y", "bucket", "n", "place"]
    return pa.RecordBatch.from_arrays([columns.get(c, pa.nulls(size, pa.int64())) for c in names], names)


def _fetched(batches: Iterator[pa.RecordBatch], bits) -> Iterator[pa.RecordBatch]:
    """Name, tag, length, parity planes and words of the lines whose tag the bitmap may hold."""
    names = ["h1", "h2", "tag", "n", *PLANE_NAMES, "seq"]
    for b in _thin(batches):
        texts = b.column(0).to_pylist()
        for lo, hi in text_slices(texts, SLICE):
            units = Units(texts[lo:hi], by_line=True)
            n, (h1, h2) = np.diff(units.offsets), units.names()
            wanted = (n > 0) & maybe_wanted(bits.value, tag_of(h1).astype(np.int64))
            wanted[wanted] = np.isin(np.flatnonzero(wanted), np.unique(h1, return_index=True)[1])
            at = np.flatnonzero(wanted)
            planes = parity_planes(units.words[np.repeat(wanted, n)], np.concatenate([[0], np.cumsum(n[at])]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(h1[at]), pa.array(h2[at]), pa.array(tag_of(h1[at]).astype(np.int64)), pa.array(n[at]), *map(pa.array, planes), pa.array(units.strings(at), pa.string())], names)


def _across(batches: Iterator[pa.RecordBatch], share: float) -> Iterator[pa.RecordBatch]:
    """Of rows (leader, bucket, id, component, n, place, planes) sorted by leader and bucket, the pairs
    (x, y) of ids of a bucket that are in different components and may be links, once for each leader.
    The rows that are not of a bucket's largest component are compared, in blocks of about BLOCK
    pairs, with all others of a length in reach."""
    def across(rows: list[list[np.ndarray]]) -> np.ndarray:
        ids, component, n, place, *planes = (np.concatenate(c) for c in zip(*rows, strict=True))
        _, component, sizes = np.unique(component, return_inverse=True, return_counts=True)
        found = [np.zeros((0, 2), np.int64)]
        if len(sizes) > 1:
            # the largest component stands last and is never a left side
            component = np.where(component == sizes.argmax(), len(sizes), component)
            order = np.argsort(n, kind="stable")
            ids, component, n, place = ids[order], component[order].astype(np.int32), n[order].astype(np.int32), place[order].astype(np.int32)
            planes = np.stack(planes, axis=1).view(np.uint64)[order]
            left = np.flatnonzero(component < len(sizes))
            step = max(1, BLOCK // len(n))
            for some in np.split(left, range(step, len(left), step)):
                least, most = math.ceil(n[some[0]] * (1 - share) - 1e-6), math.floor(n[some[-1]] / (1 - share) + 1e-6)
                lo, hi = np.searchsorted(n, least), np.searchsorted(n, most, side="right")
                a, b = np.nonzero((component[some][:, None] < component[lo:hi]) & has_room(n[some][:, None], place[some][:, None], n[lo:hi], place[lo:hi], share))
                a, b = some[a], b + lo
                differ = np.bitwise_count(planes[a] ^ planes[b]).sum(axis=1, dtype=np.int32) + np.abs(n[a] - n[b])
                near = differ <= 2 * np.floor(share * np.maximum(n[a], n[b]) + 1e-6)
                found.append(np.stack([ids[a[near]], ids[b[near]]], axis=1))
        return np.sort(np.concatenate(found), axis=1)

    def buckets() -> Iterator[tuple[int, int, list[np.ndarray]]]:
        for b in batches:
            leader, bucket, *columns = (c.to_numpy(zero_copy_only=False) for c in b.columns)
            for lo, size in zip(*map(np.ndarray.tolist, _stretches(bucket)), strict=True):
                yield int(leader[lo]), int(bucket[lo]), [c[lo:lo + size] for c in columns]

    for _, mine in itertools.groupby(buckets(), key=lambda r: r[0]):
        pairs = np.zeros((0, 2), np.int64)
        for _, rows in itertools.groupby(mine, key=lambda r: r[1]):
            pairs = np.concatenate([pairs, across([r[2] for r in rows])])
            ids, each = np.unique(pairs, return_inverse=True)
            each = each.reshape(-1, 2)
            pairs = pairs[np.unique(each[:, 0] * len(ids) + each[:, 1], return_index=True)[1]]
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["x", "y"])


def line_links(spark: SparkSession, docs: DataFrame, codes, parts: int, share: float) -> tuple[DataFrame, DataFrame]:
    """The lines that may have a link, (id, h1, h2) among others, and edges (a, b) of ids whose
    components are those of all links.  The keys travel as packed cells, are met by part, and only
    pairs that keys, lengths and places leave go on.  Buckets of more than SMALL_BUCKET entries give the pairs with
    two of theirs first, then those between different components of the links found."""
    body = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    cells = docs.select(body).mapInArrow(functools.partial(_keyed, share=share, codes=codes, parts=parts), "part int, keys binary, tags binary, n binary, places binary")
    met = stage(spark, cells.repartition(parts, "part").sortWithinPartitions("part")
                .mapInArrow(functools.partial(_met, share=share), "x long, y long, bucket long, n long, place long"), "met")
    pairs, entries = stage(spark, met.where("bucket is null").select("x", "y").distinct(), "tag-pairs"), met.where("bucket is not null")
    wanted = pairs.select("x").unionByName(pairs.select(F.col("y").alias("x"))).unionByName(entries.select("x"))
    bits = wanted_filter(spark, wanted, "x")
    planes = ", ".join(f"{p} long" for p in PLANE_NAMES)
    fetched = docs.select(body).mapInArrow(functools.partial(_fetched, bits=bits), f"h1 long, h2 long, tag long, n long, {planes}, seq string")
    nodes = stage(spark, fetched.groupBy("h1", "h2").agg(*(F.first(c).alias(c) for c in fetched.columns[2:])).withColumn("id", F.monotonically_increasing_id()), "nodes")
    bits.unpersist()
    thin = nodes.select("tag", "id", "n", *PLANE_NAMES)

    def side(name: str) -> DataFrame:
        return thin.select(F.col("tag").alias(name), F.struct("id", "n", *PLANE_NAMES).alias(f"{name}_of"))

    a, b = F.col("x_of"), F.col("y_of")
    differ = functools.reduce(lambda p, q: p + q, (F.bit_count(a[p].bitwiseXOR(b[p])) for p in PLANE_NAMES)) + F.abs(a["n"] - b["n"])
    may = stage(spark, pairs.join(side("x"), "x").join(side("y"), "y").where(differ <= 2 * max_edits(share, a["n"], b["n"]))
                .select(a["id"].alias("x"), b["id"].alias("y")), "pairs")
    texts = nodes.select("id", "seq")

    def links(found: DataFrame) -> DataFrame:
        return stage(spark, _measured(found, texts, share).where("d >= 0").select(F.col("x").alias("a"), F.col("y").alias("b")), "links")

    edges = links(may)
    unstage(spark, pairs, may)
    if entries.limit(1).count():
        known = connected(spark, edges)
        told = (entries.select(F.col("x").alias("tag"), F.col("y").alias("leader"), "bucket", "place").join(thin, "tag").join(known, F.col("id") == F.col("node"), "left")
                .select("leader", "bucket", "id", F.coalesce("component", "id").alias("component"), "n", "place", *PLANE_NAMES))
        across = stage(spark, told.repartition("leader").sortWithinPartitions("leader", "bucket").mapInArrow(functools.partial(_across, share=share), "x long, y long").distinct(), "across")
        edges = edges.unionByName(links(across))
        unstage(spark, across)
    unstage(spark, met)
    return nodes, edges


def line_groups(spark: SparkSession, docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row per line with a word: doc_id, th (hash of the text), line, group
    (an id), kept."""
    ship_package(spark)
    scanned = stage(spark, named_and_counted(docs, 1 - similarity), "scanned")
    codes = slot_codes(spark, scanned)
    # without the counts what the end needs is small
    lines = stage(spark, scanned.where("chunk is null").drop("chunk", "n"), "lines")
    unstage(spark, scanned)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(lines.count() / PART_LINES))
    nodes, edges = line_links(spark, docs, codes, parts, 1 - similarity)
    codes.unpersist()
    linked = nodes.select("id", "h1", "h2").join(connected(spark, edges), F.col("id") == F.col("node")).select("h1", "h2", "component")
    units = stage(spark, lines.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "th", "line")).alias("first"))
                  .withColumn("id", F.monotonically_increasing_id()).join(linked, ["h1", "h2"], "left"), "units")
    unstage(spark, nodes)
    firsts = units.where("component is not null").groupBy("component").agg(F.min("first").alias("first_of"))
    # components are ids of their own, so lines without a link count downwards
    known = units.join(firsts, "component").select("h1", "h2", F.col("component").alias("group"), "first_of").unionByName(
        units.where("component is null").select("h1", "h2", (-1 - F.col("id")).alias("group"), F.col("first").alias("first_of")))
    return lines.join(known, ["h1", "h2"]).select(
        "doc_id", "th", "line", "group", F.struct("doc_id", "th", "line").eqNullSafe(F.col("first_of")).alias("kept"))


def rebuilt(spark: SparkSession, docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with text and n_chars of the lines that stay, plus __removed (number
    of lines removed) and __left (whether a line with a word is left)."""
    groups = line_groups(spark, docs, similarity)
    drops = stage(spark, groups.groupBy("doc_id", "th").agg(
        F.collect_set(F.when(~F.col("kept"), F.col("line"))).alias("__drop"), F.count_if(F.col("kept")).alias("__kept"))
        .where(F.size("__drop") > 0).select(F.col("doc_id").alias("__id"), F.col("th").alias("__th"), "__drop", "__kept"), "drops")
    body = F.coalesce(F.col("text").cast("string"), F.lit(""))
    bits = wanted_filter(spark, drops, "__th")

    @F.pandas_udf("boolean")
    def may_lose(th: pd.Series) -> pd.Series:
        return pd.Series(maybe_wanted(bits.value, th.to_numpy()))

    told = docs.withColumn("__may", may_lose(F.xxhash64(body)))
    joined = told.where("__may").join(drops, F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.xxhash64(body) == F.col("__th")), "left")

    # __lines stands twice below, so it is evaluated once a row and not inside the lambda
    joined = joined.withColumn("__lines", F.split(body, "\n"))
    numbers = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.col("__drop"))
    text = F.when(F.col("__drop").isNull(), F.col("text")).otherwise(
        F.array_join(F.transform(numbers, lambda i: F.get(F.col("__lines"), i)), "\n"))
    out = joined.withColumn("text", text).withColumn("__removed", F.coalesce(F.size("__drop"), F.lit(0))).withColumn(
        "__left", F.coalesce(F.col("__kept") > 0, F.lit(True)))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast("long"))
    others = told.where("not __may")
    if "n_chars" in docs.columns:
        others = others.withColumn("n_chars", F.char_length("text").cast("long"))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return out.select(*columns, "__removed", "__left").unionByName(
        others.select(*columns, F.lit(0).alias("__removed"), F.lit(True).alias("__left")))


def deduplicated(spark: SparkSession, docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with repeated lines removed, without the documents of which no line
    with a word is left."""
    return rebuilt(spark, docs, similarity).where("__left").drop("__removed", "__left")

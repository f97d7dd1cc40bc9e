"""Operator 1: language-model scoring by context-tree weighting over bytes.

Each byte is eight binary decisions; every decision has a context tree over the
bytes before it, to depth ``DEPTH``.  A node keeps counts of zeros and ones, its
Krichevsky-Trofimov probability P_e, and the weighted P_w = (P_e + product of
the children's P_w) / 2.  The prediction mixes the estimates of all depths on
the path, each by the weight that its tree has after the training texts.

The texts are lower-cased (A-Z), led by end marks (byte 0xFF, which UTF-8 never
holds) as context, and ended by one, which is coded too; so the probabilities
of all texts sum to one.

How it is spread: a gram is a byte below its context, the latest byte highest,
so the nodes of every depth are runs of sorted grams.  They go to buckets (grams by
their last ``TOP`` context bytes, words by a hash), where each bucket computes
its subtrees from runs.  The levels above come to the driver: nodes of at most
TOP - 1 bytes and eight bits, whose number UTF-8 bounds, not the corpus.

The scan forms blocks of about ``BLOCK_BYTES`` of text, and makes of each block its
compressed rows and packed pieces, one a bucket: its distinct grams or words in
order and their numbers in training texts.  The pieces of a bucket sum to its model; then
each piece is answered by the values of its grams alone, in its order, so no keys
travel back.  A bucket reads its model, then answers pieces as they stream by, in
lots no smaller than its model, so no task holds the model or all pieces, however
large the corpus makes them.  Grams that training
never met take part with no counts: their value is that of the deepest context
known.  Values travel as 32-bit floats (relative error at most 6e-8).

Defined results: null text is empty, of one token (the end) and one coded byte;
a null doc_id counts as the empty text in the training rule; repeated rows
count and are scored each; with no training text every byte costs eight bits
and N is 0; an empty table gives an empty result; extra columns are ignored."""

from __future__ import annotations

import itertools
import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.llm.common import ragged_sums, ship_package, stage, text_slices

DEPTH = 7  # a gram, of DEPTH + 1 bytes, fills an unsigned 64-bit word
END = b"\xff"
TOP = 3  # shallowest depth computed in buckets
BLOCK_BYTES = 16_000_000
BUCKET_BYTES = 4_000_000  # text for each bucket of grams, and of words
MOST_BUCKETS = 1 << 15
LOT = 1_000_000  # grams answered in one go, at least
END_TOKEN = b""  # no word is empty
LOG_PI, LN2 = math.log(math.pi), math.log(2.0)


def grams_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The gram of every coded byte (the byte lowest, its context above, the latest
    byte highest) and the offsets of the texts."""
    raw = np.frombuffer(b"".join(END * DEPTH + t + END for t in texts), dtype=np.uint8)
    sizes = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    if not texts:
        return np.empty(0, np.uint64), offsets
    windows = np.ndarray((len(raw) - DEPTH,), "<u8", raw, strides=(1,))  # the coded byte highest
    coded = np.ones(len(windows), dtype=bool)
    for k in range(DEPTH):
        coded[offsets[1:-1] + DEPTH * np.arange(1, len(texts)) - DEPTH + k] = False
    windows = windows[coded]
    return (windows << np.uint64(8)) | (windows >> np.uint64(8 * DEPTH)), offsets


# ------------------------------------------------------------------ estimates

def log_gamma(x: np.ndarray) -> np.ndarray:
    """ln Gamma for x >= 0.5: Stirling's series, six steps up."""
    shift = np.ones_like(x)
    for k in range(6):
        shift = shift * (x + k)
    y = x + 6
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - 1 / (1680 * y**7)
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + series - np.log(shift)


_SMALL = 1 << 12
_LOG_GAMMA = {plus: log_gamma(np.arange(_SMALL) + plus) for plus in (0.5, 1.0)}


def _log_gamma_of(counts: np.ndarray, plus: float) -> np.ndarray:
    """ln Gamma(counts + plus); small counts are looked up."""
    out = _LOG_GAMMA[plus][np.minimum(counts, _SMALL - 1)]
    large = counts >= _SMALL
    if large.any():
        out[large] = log_gamma(counts[large] + plus)
    return out


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """ln of the Krichevsky-Trofimov probability of that many zeros and ones."""
    return _log_gamma_of(zeros, 0.5) + _log_gamma_of(ones, 0.5) - _log_gamma_of(zeros + ones, 1.0) - LOG_PI


def kt_one(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    return (ones + 0.5) / (zeros + ones + 1.0)


def weighted(log_e: np.ndarray, log_children: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """ln P_w of nodes, and how much of it stops at the node."""
    log_w = np.logaddexp(log_e, log_children) - LN2
    return log_w, np.exp(log_e - LN2 - log_w)


# ---------------------------------------------------------------------- trees

def _first(keys: np.ndarray) -> np.ndarray:
    first = np.ones(len(keys), dtype=bool)
    first[1:] = keys[1:] != keys[:-1]
    return first


def _distinct(keys: np.ndarray) -> np.ndarray:
    """Sorted distinct ``keys``."""
    keys = np.sort(keys)
    return keys[_first(keys)]


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal ``keys`` start, and the run of each."""
    first = _first(keys)
    return np.flatnonzero(first), np.cumsum(first) - 1


class Level:
    """The nodes of one depth for one bit position, sorted: keys (bits so far above
    the context bytes, the latest highest), counts, ln P_w, the share that stops
    here, and the parent of each node below."""

    def __init__(self, keys, zeros, ones, log_children=None, parent=None):
        self.keys, self.zeros, self.ones, self.parent = keys, zeros, ones, parent
        log_e = log_kt(zeros, ones)
        self.log_w, self.stop = (log_e, np.ones(len(keys))) if log_children is None else weighted(log_e, log_children)

    def above(self) -> Level:
        """The level of one context byte less."""
        shorter = self.keys >> np.uint64(8)
        starts, parent = _runs(shorter)
        return Level(shorter[starts], *(np.add.reduceat(v, starts) for v in (self.zeros, self.ones, self.log_w)), parent)


def subtrees(grams: np.ndarray, counts: np.ndarray, bit: int) -> tuple[list[Level], np.ndarray, np.ndarray, np.ndarray]:
    """Levels ``DEPTH`` to ``TOP`` of the trees of one bit position over sorted
    distinct grams; an order of the grams, and in it each one's deepest node and bit."""
    byte = (grams & np.uint64(255)).astype(np.uint16)
    path = (1 << bit) | (byte >> (8 - bit))
    order = np.argsort(path, kind="stable")
    keys = (path[order].astype(np.uint64) << np.uint64(8 * DEPTH)) | (grams[order] >> np.uint64(8))
    is_one = ((byte[order] >> (7 - bit)) & 1).astype(bool)
    starts, leaf = _runs(keys)
    n = counts[order]
    zeros, ones = (np.add.reduceat(np.where(which, n, 0), starts) for which in (~is_one, is_one))
    levels = [Level(keys[starts], zeros, ones)]
    for _ in range(DEPTH - TOP):
        levels.append(levels[-1].above())
    return levels, order, leaf, is_one


def top_rows(grams: np.ndarray, counts: np.ndarray) -> pd.DataFrame:
    """What depth TOP hands up, summed per node of depth TOP - 1 of these grams."""
    rows = []
    for bit in range(8):
        level = subtrees(grams, counts, bit)[0][-1]
        shorter = level.keys >> np.uint64(8)
        starts = _runs(shorter)[0]
        rows.append(pd.DataFrame({"node": shorter[starts].astype(np.int64)} | {
            name: np.add.reduceat(v, starts) for name, v in (("zeros", level.zeros), ("ones", level.ones), ("log_w", level.log_w))}))
    return pd.concat(rows, ignore_index=True)


def upper_mix(rows: pd.DataFrame) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For depths 0 to TOP - 1: the nodes, what their depth and those above give to
    the probability of a one, and the weight that goes deeper."""
    rows = rows.sort_values("node")
    levels = [Level(rows["node"].to_numpy().astype(np.uint64), rows["zeros"].to_numpy().astype(np.int64),
                    rows["ones"].to_numpy().astype(np.int64), rows["log_w"].to_numpy().astype(np.float64))]
    if rows.empty:
        return [(levels[0].keys, np.empty(0), np.empty(0))] * TOP
    for _ in range(TOP - 1):
        levels.append(levels[-1].above())
    mixes = []
    given, deeper = np.zeros(1), np.ones(1)
    for i in range(TOP - 1, -1, -1):
        level = levels[i]
        if i < TOP - 1:
            given, deeper = given[levels[i + 1].parent], deeper[levels[i + 1].parent]
        given = given + deeper * level.stop * kt_one(level.zeros, level.ones)
        deeper = deeper * (1 - level.stop)
        mixes.append((level.keys, given, deeper))
    return mixes


def _entering(nodes: np.ndarray, upper: tuple) -> tuple[np.ndarray, np.ndarray]:
    """What all depths above give to nodes of depth TOP, and the weight left; below
    the deepest known node all estimates are one half."""
    given, deeper = np.full(len(nodes), 0.5), np.zeros(len(nodes))
    known = np.ones(len(nodes), dtype=bool)
    for d, (keys, level_given, level_deeper) in enumerate(upper):
        if not len(keys):
            break
        wanted = nodes >> np.uint64(8 * (TOP - d))
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        met = known & (keys[at] == wanted)
        lost = known & ~met
        given[lost] += deeper[lost] * 0.5
        deeper[lost] = 0.0
        given[met], deeper[met] = level_given[at[met]], level_deeper[at[met]]
        known = met
    return given, deeper


def gram_log10(grams: np.ndarray, counts: np.ndarray, *upper) -> np.ndarray:
    """log10 probability of the byte of each of these sorted distinct grams after its context."""
    out = np.zeros(len(grams))
    for bit in range(8):
        levels, order, leaf, is_one = subtrees(grams, counts, bit)
        p, left = _entering(levels[-1].keys, upper)
        for i in range(len(levels) - 1, -1, -1):
            level = levels[i]
            if i < len(levels) - 1:
                p, left = p[levels[i + 1].parent], left[levels[i + 1].parent]
            p = p + left * level.stop * kt_one(level.zeros, level.ones)
            left = left * (1 - level.stop)
        out[order] += np.log10(np.where(is_one, p[leaf], 1 - p[leaf]))
    return out


# -------------------------------------------------------------------- packing

def packed(values: np.ndarray) -> bytes:
    """Numbers as planes of bytes, compressed."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked(data: bytes, dtype: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(dtype).itemsize, -1).T).view(dtype).ravel()


def packed_grams(grams: np.ndarray) -> bytes:
    return packed(np.diff(grams, prepend=np.uint64(0)))


def unpacked_grams(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked(data, np.uint64), dtype=np.uint64)


def packed_words(words: list[bytes]) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b" ".join(words))


def unpacked_words(data: bytes) -> list[bytes]:
    return zstandard.ZstdDecompressor().decompress(data).split(b" ")


def gram_parts(grams: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, places) of sorted grams; places ascend."""
    if not len(grams):
        return
    bucket = np.empty(len(grams), dtype=np.uint16)
    for lo in range(0, len(grams), LOT):  # lots, so what is made on the way stays small
        top = grams[lo:lo + LOT] >> np.uint64(8 * (DEPTH + 1 - TOP))
        bucket[lo:lo + LOT] = (((top * np.uint64(2654435761)) & np.uint64(0xFFFFFFFF)) >> np.uint64(8)) % np.uint64(buckets)
    order = np.argsort(bucket, kind="stable")
    ends = np.cumsum(np.bincount(bucket, minlength=buckets))
    for k, (lo, hi) in enumerate(itertools.pairwise([0, *ends.tolist()])):
        if hi > lo:
            yield k, order[lo:hi]


def word_parts(words, buckets: int) -> Iterator[tuple[int, list[bytes]]]:
    """(bucket, sorted words); buckets of words come after those of grams."""
    parts: dict[int, list[bytes]] = {}
    for w in words:
        parts.setdefault(zlib.crc32(w) % buckets, []).append(w)
    for k, found in parts.items():
        yield buckets + k, sorted(found)


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct grams and their summed counts, from sorted parts."""
    if len(parts) == 1:
        return parts[0]
    keys = np.concatenate([k for k, _ in parts])
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = _runs(keys)[0]
    return keys[starts], np.add.reduceat(np.concatenate([n for _, n in parts])[order], starts)


# ------------------------------------------------------------------- counting

def _batch(columns: dict[str, tuple[list, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in columns.values()], list(columns))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        for i in range(b.num_rows):
            yield tuple(c[i].as_py() for c in b.columns)


PIECES = "bucket int, block long, keys binary, n binary, texts binary"
TEXTS = -1  # the bucket of a block's texts
BLOCK = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("text", pa.binary())])


def _block(ids: list, held: list[bool], texts: list[bytes], block: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """One block's distinct grams and words, packed by bucket, with their numbers in
    its training texts; and its rows."""
    words: Counter = Counter()
    parts: list[tuple[np.ndarray, np.ndarray]] = []
    for lo, hi in text_slices(texts):
        learn = [t for t, h in zip(texts[lo:hi], held[lo:hi], strict=True) if not h]
        other = _distinct(grams_of([t for t, h in zip(texts[lo:hi], held[lo:hi], strict=True) if h])[0])
        parts += [np.unique(grams_of(learn)[0], return_counts=True), (other, np.zeros(len(other), dtype=np.int64))]
        for t, h in zip(texts[lo:hi], held[lo:hi], strict=True):
            if h:
                words.update(dict.fromkeys(t.split(), 0))
            else:
                words.update(t.split())
        words[END_TOKEN] += len(learn)
        if sum(len(k) for k, _ in parts[1:]) > LOT:
            parts[:] = [_merged(parts)]
    keys, n = _merged(parts)
    parts.clear()
    found = [(k, packed_grams(keys[at]), packed(n[at]), None) for k, at in gram_parts(keys, buckets)]
    found += [(k, packed_words(some), packed(np.array([words[w] for w in some], dtype=np.int64)), None) for k, some in word_parts(words, buckets)]
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, BLOCK, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
        stream.write_table(pa.table([ids, held, texts], schema=BLOCK))
    found.append((TEXTS, None, None, sink.getvalue().to_pybytes()))
    for lo in range(0, len(found), 64):
        k, data, counts, rows = zip(*found[lo:lo + 64], strict=True)
        yield _batch({"bucket": (k, pa.int32()), "block": ([block] * len(k), pa.int64()), "keys": (data, pa.binary()),
                      "n": (counts, pa.binary()), "texts": (rows, pa.binary())})


def _blocks(batches: Iterator[pa.RecordBatch], buckets: int, block_bytes: int) -> Iterator[pa.RecordBatch]:
    """The blocks of one task's rows, in the order read."""
    block, size, rows = TaskContext.get().partitionId() << 32, 0, ([], [], [])
    for b in batches:
        for row in zip(*(b.column(c).to_pylist() for c in ("doc_id", "held_out")), (t.encode().lower() for t in b.column("text").to_pylist()), strict=True):
            if size and size + len(row[2]) > block_bytes:
                yield from _block(*rows, block, buckets)
                block, size, rows = block + 1, 0, ([], [], [])
            for column, value in zip(rows, row, strict=True):
                column.append(value)
            size += len(row[2])
    if rows[0]:
        yield from _block(*rows, block, buckets)


MODEL = "bucket int, keys binary, n binary, total long, distinct long, node array<long>, zeros array<long>, ones array<long>, log_w array<double>"


def _gather(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """One row for each bucket of sorted pieces: what training met, counted, and what its trees hand up."""
    current, words, parts = None, Counter(), []

    def close() -> Iterator[pa.RecordBatch]:
        if current is None:
            return
        if current < buckets:
            keys, n = _merged(parts)
            keys, n = keys[n > 0], n[n > 0]
            up = top_rows(keys, n) if len(keys) else None
            row = (current, packed_grams(keys), packed(n), None, None, *([] if up is None else up[c].to_numpy() for c in ("node", "zeros", "ones", "log_w")))
        else:
            some = sorted(w for w, c in words.items() if c)
            row = (current, packed_words(some), packed(np.array([words[w] for w in some], dtype=np.int64)), words.total(), len(some), [], [], [], [])
        parts.clear()
        words.clear()
        longs = pa.list_(pa.int64())
        types = (pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), longs, longs, longs, pa.list_(pa.float64()))
        names = ("bucket", "keys", "n", "total", "distinct", "node", "zeros", "ones", "log_w")
        if row[4] != 0:
            yield _batch({name: ([v], t) for name, v, t in zip(names, row, types, strict=True)})

    for bucket, keys, n in _rows(batches):
        if bucket != current:
            yield from close()
            current = bucket
        if bucket < buckets:
            parts.append((unpacked_grams(keys), unpacked(n, np.int64)))
            if sum(len(k) for k, _ in parts[1:]) > max(LOT, len(parts[0][0])):
                parts[:] = [_merged(parts)]
        else:
            for w, c in zip(unpacked_words(keys), unpacked(n, np.int64).tolist(), strict=True):
                words[w] += c
    yield from close()


# -------------------------------------------------------------------- scoring

def _answer(batches: Iterator[pa.RecordBatch], buckets: int, upper) -> Iterator[pa.RecordBatch]:
    """Answers to rows (bucket, kind, block, keys, n) sorted by bucket and kind, the
    model (kind 0), then the pieces: values of grams in the order of their keys;
    words come back with their counts."""
    current, keys, n, counts = None, None, None, {}
    waiting: list[tuple[int, np.ndarray]] = []

    def out(*found: tuple[int, bytes, bytes | None]) -> pa.RecordBatch:
        return _batch({"block": ([b for b, _, _ in found], pa.int64()), "bucket": ([current] * len(found), pa.int32()),
                       "answers": ([v for _, v, _ in found], pa.binary()), "words": ([w for *_, w in found], pa.binary())})

    def answered() -> Iterator[pa.RecordBatch]:
        if waiting:
            union = _distinct(np.concatenate([keys, *(a for _, a in waiting)]))
            have = np.zeros(len(union), dtype=np.int64)
            have[np.searchsorted(union, keys)] = n
            values = gram_log10(union, have, *upper).astype(np.float32)
            for block, asked in waiting:
                yield out((block, packed(values[np.searchsorted(union, asked)]), None))
            waiting.clear()

    for bucket, kind, block, data, n_data in _rows(batches):
        if bucket != current:
            yield from answered()
            current, keys, n, counts = bucket, np.empty(0, np.uint64), np.empty(0, np.int64), {}
        if kind == 0 and bucket < buckets:
            keys, n = unpacked_grams(data), unpacked(n_data, np.int64)
        elif kind == 0:
            counts = dict(zip(unpacked_words(data), unpacked(n_data, np.int64).tolist(), strict=True))
        elif bucket < buckets:
            waiting.append((block, unpacked_grams(data)))
            if sum(len(a) for _, a in waiting) > max(LOT, 2 * len(keys)):
                yield from answered()
        else:
            yield out((block, packed(np.array([counts.get(w, 0) for w in unpacked_words(data)], dtype=np.int64)), data))
    yield from answered()


def _placed(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct grams, sorted, and the place of each gram among them.

    Grams are sorted with their positions in one word: a hash above, the position
    below.  Where two grams share a hash, they are sorted as they are."""
    bits = np.uint64(max(1, len(grams) - 1).bit_length())
    low = (np.uint64(1) << bits) - np.uint64(1)
    tagged = np.sort(((grams * np.uint64(0x9E3779B97F4A7C15)) & ~low) | np.arange(len(grams), dtype=np.uint64))
    at = (tagged & low).astype(np.int64)
    shuffled = grams[at]
    starts, run = _runs(shuffled)
    if (np.diff((tagged >> bits)[starts]) == 0).any():
        met, place = np.unique(grams, return_inverse=True)
        return met, place.astype(np.int32)
    found = shuffled[starts]
    order = np.argsort(found)
    rank = np.empty(len(order), dtype=np.int32)
    rank[order] = np.arange(len(order), dtype=np.int32)
    place = np.empty(len(grams), dtype=np.int32)
    place[at] = rank[run]
    return found[order], place


SCORED = ("doc_id long, held_out boolean, n_tokens long, n_known long, sum_log_count double, score double, n_bytes long")


def _score(part: pa.Table, answers: pa.Table, buckets: int) -> pa.Table:
    """Scores of one block's texts from the values it asked for."""
    if not part.num_rows:
        return pa.table({c: pa.array([], t) for c, t in (("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                                                         ("sum_log_count", pa.float64()), ("score", pa.float64()), ("n_bytes", pa.int64()))})
    part = pa.ipc.open_stream(part.column("texts")[0].as_py()).read_all()
    texts = part.column("text").to_pylist()
    # the slices' grams are placed one slice at a time, below: only the distinct ones of all are held
    keys, waiting = np.empty(0, np.uint64), []
    for lo, hi in text_slices(texts):
        waiting.append(_distinct(grams_of(texts[lo:hi])[0]))
        if sum(map(len, waiting)) > max(LOT, len(keys)):
            keys = _distinct(np.concatenate([keys, *waiting]))
            waiting.clear()
    keys = _distinct(np.concatenate([keys, *waiting]))
    waiting.clear()
    log_p = np.empty(len(keys), dtype=np.float32)
    told, log_count = {}, {}
    values, some = answers.column("answers"), answers.column("words")
    for i, k in enumerate(answers.column("bucket").to_pylist()):
        if k < buckets:
            told[k] = i
        else:
            log_count.update(zip(unpacked_words(some[i].as_py()), np.log10(unpacked(values[i].as_py(), np.int64) + 1.0).tolist(), strict=True))
    for k, at in gram_parts(keys, buckets):
        log_p[at] = unpacked(values[told[k]].as_py(), np.float32)
    get = log_count.__getitem__
    sums, tokens, known, scores, sizes = [], [], [], [], []
    for lo, hi in text_slices(texts):
        grams, offsets = grams_of(texts[lo:hi])
        met, place = _placed(grams)
        scores.append(ragged_sums(log_p[np.searchsorted(keys, met)].astype(np.float64)[place], offsets))
        sizes.append(np.diff(offsets))
        for t in texts[lo:hi]:
            found = list(map(get, t.split()))
            sums.append(sum(found))
            tokens.append(len(found))
            known.append(len(found) - found.count(0.0))
    return pa.table({"doc_id": part.column("doc_id"), "held_out": part.column("held_out"), "n_tokens": pa.array(tokens, pa.int64()),
                     "n_known": pa.array(known, pa.int64()), "sum_log_count": pa.array(sums, pa.float64()),
                     "score": np.concatenate(scores), "n_bytes": np.concatenate(sizes)})


def held_out(doc_id: Column, modulus: int = 7, remainder: int = 2) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus == remainder


def score(spark: SparkSession, docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Scores of all ``docs`` (doc_id, text) under the model learned from those not
    held out.  One row per document."""
    ship_package(spark)
    size = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    buckets = min(MOST_BUCKETS, max(1, -(-size // BUCKET_BYTES)))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    thin = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # blocks are data: a lost task of a later step reads the same ones again
    pieces = stage(spark, thin.coalesce(blocks).mapInArrow(lambda batches: _blocks(batches, buckets, block_bytes * 3 // 2), PIECES), "ctw-blocks")
    grams_and_words = pieces.where(F.col("bucket") != TEXTS)
    model = stage(spark, grams_and_words.select("bucket", "keys", "n").repartition(tasks, "bucket").sortWithinPartitions("bucket")
                  .mapInArrow(lambda batches: _gather(batches, buckets), MODEL), "ctw-model")
    words = model.where(F.col("bucket") >= buckets).agg(F.sum("total").alias("n"), F.sum("distinct").alias("v")).first()
    n, v, ends = words["n"] or 0, words["v"] or 0, docs.where(~held_out(F.col("doc_id"))).count()
    upper = (model.select(F.explode(F.arrays_zip("node", "zeros", "ones", "log_w")).alias("r")).select("r.*")
             .groupBy("node").agg(*[F.sum(c).alias(c) for c in ("zeros", "ones", "log_w")]).toPandas())
    shared = spark.sparkContext.broadcast(upper_mix(upper))
    spark.sparkContext._jvm.System.gc()  # the exchange that made the model is garbage only now: its files go before the next are written

    asked = (model.select("bucket", F.lit(0).alias("kind"), F.lit(-1).cast("long").alias("block"), "keys", "n")
             .unionByName(grams_and_words.select("bucket", F.lit(1).alias("kind"), "block", "keys", F.lit(None).cast("binary").alias("n"))))
    answers = (asked.repartition(tasks, "bucket").sortWithinPartitions("bucket", "kind")
               .mapInArrow(lambda batches: _answer(batches, buckets, shared.value), "block long, bucket int, answers binary, words binary"))
    dealt = pieces.where(F.col("bucket") == TEXTS).select("block", "texts").repartition(blocks, "block")
    scored = dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(lambda part, told: _score(part, told, buckets), SCORED)
    ended = math.log10(ends + 1.0) - math.log10(n + v + 1.0)
    return scored.select(
        "doc_id", "held_out", (F.col("n_tokens") + 1).alias("n_tokens"),
        (F.col("n_known") + (1 if ends else 0)).alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        (F.col("sum_log_count") - F.col("n_tokens") * math.log10(n + v + 1.0) + ended).alias("base_score"), "score",
        (-F.col("score") / math.log10(2.0) / F.col("n_bytes")).alias("bits_per_byte"))

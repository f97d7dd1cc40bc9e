"""Operator 11: best-fit packing planned on the histogram of piece lengths.

Documents are tokenised and ended by id 1; only longer ones are cut, into pieces of
a whole window and a last shorter one.  What is planned on is not the pieces but
how many there are of each length: best-fit decreasing over counts puts ``n`` pieces
of one length at once into the open windows that they fit best
(:func:`best_fit_plan`).  The plan is a list of slot ranges, "the pieces of length L
ranked lo to hi lie k to a window, from window s on, at offset o", and a piece takes
its place by joining the ranges on its rank within its length.

The histogram has a row per length, at most ``window`` of them, and is all that
the driver sees.  A window's free room r becomes r mod L < r / 2 when it is filled with a
length L, and a length opens or splits at most 4 groups of windows, so the plan has
at most 4 x window x log2(window) ranges (196,608 for 4096, about 11 MB), whatever
the number of documents: that bound is why it may be broadcast.  Ranks are counted
in each task while it tokenises, and made global by the counts of (task, length);
no task meets all pieces of a length.

Defined results: null and empty texts are the end id alone; repeated rows are
packed each, null ids like any other; an empty table gives an empty result; extra
columns are ignored; strings of the vocabulary's special tokens in a text become
their ids, as the tokenizer has it."""

from __future__ import annotations

import bisect
import functools
import re
import zlib
from collections import defaultdict, deque
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from blotter.llm.common import ship_package, sized_slices, stage, to_batch

WINDOW = 4096
END_ID = (1).to_bytes(4, "little")
CACHE_WORDS = 400_000
CACHED_LENGTH = 64
#: Letters that are letters to every tokenizer and whose lower case is one plain character, then
#: ASCII punctuation without the apostrophe, which may begin a pre-token of its own.
WORD_AND_MARKS = re.compile(r"([a-zß-öø-ÿ]*)([!-&(-/:-@\[-`{-~]*)")
#: Texts with these are not lowered: special tokens, and characters of which case rules may differ.
NOT_LOWERED = re.compile("<\\||[^\x00-\u012f\u0131-\u017f]")

PIECES = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
    T.StructField("__task", T.IntegerType()), T.StructField("__local", T.LongType())])
RANGES = "length long, bucket long, lo long, hi long, per_window long, first_window long, first_offset long"


class Words(dict):
    """Ids of words; an absent one is taken from the encoder's older generation, or made."""

    def __init__(self, encoder: WordEncoder):
        self.encoder = encoder

    def __missing__(self, word: str) -> bytes:
        ids = self.encoder.old.get(word)
        if ids is None:
            ids = self.encoder.learn(word)
        if len(word) <= CACHED_LENGTH:
            self[word] = ids
        return ids


class WordEncoder:
    """Ids of whole texts by a tokenizer that drops white space and case: a text is the
    concatenation of its words.  Only the four plainest white-space characters split;
    the others are left to the tokenizer.

    Words are kept with their ids in two generations: a full young one becomes
    the old one, and words still in use are taken over, so that frequent words stay.
    A new word of Latin letters and then punctuation is two pre-tokens, whose ids
    the tokenizer's model gives; any other goes through the whole tokenizer.  Texts of
    plain Latin characters are lowered first, where that changes no id, so that
    words of different case are one."""

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        byte_level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.bytes = {ord(c): byte_level.pre_tokenize_str(c)[0][0] for c in map(chr, range(0xDF, 0x100)) if c.isalpha()}
        self.cache_words = cache_words
        self.young = Words(self)
        self.old: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {"": b""}

    def _model(self, letters: str) -> bytes:
        if not letters.isascii():
            letters = letters.translate(self.bytes)
        return b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(letters)])

    def learn(self, word: str) -> bytes:
        m = WORD_AND_MARKS.fullmatch(word)
        if m is None:
            return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, dtype="<u4").tobytes()
        letters, marks = m.groups()
        if marks not in self.marks:
            if len(self.marks) >= 10_000:
                self.marks = {"": b""}
            self.marks[marks] = self._model(marks)
        if not letters:
            return self.marks[marks]
        ids = self.young.get(letters) if marks else None
        return (self._model(letters) if ids is None else ids) + self.marks[marks]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        out = []
        for t in texts:
            if len(self.young) > self.cache_words:
                self.old = dict(self.young)
                self.young = Words(self)
            plain = t if NOT_LOWERED.search(t) else t.lower()
            words = plain.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
            out.append(b"".join(map(self.young.__getitem__, words)))
        return out


@functools.lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    """One encoder for each worker process, so its cache outlives a task."""
    return WordEncoder(path)


def best_fit_plan(histogram: Iterable[tuple[int, int]], window: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts of lengths: slot ranges (length, lo, hi,
    per window, first window, first offset).

    The windows are those of best-fit decreasing over single pieces: a piece goes
    where least room is left after it, and as the window it went to has less room
    than before, the next piece of its length goes there too, while it fits."""
    open_rooms: list[int] = []                                  # ascending
    groups: dict[int, deque] = defaultdict(deque)               # room -> (first window, windows)
    plan, windows = [], 0

    def keep(room: int, first: int, count: int) -> None:
        if count and room:
            if not groups[room]:
                bisect.insort(open_rooms, room)
            groups[room].append((first, count))

    for length, left in sorted(histogram, reverse=True):
        placed = 0
        while left:
            at = bisect.bisect_left(open_rooms, length)
            if at < len(open_rooms):
                room = open_rooms[at]
                first, count = groups[room].popleft()
                if not groups[room]:
                    open_rooms.pop(at)
            else:
                room, first, count = window, windows, -(-left // (window // length))
                windows += count
            fit = room // length
            full = min(count, left // fit)
            rest = left - full * fit if full < count else 0     # the window that is not filled
            for many, each, start in ((full, fit, first), (1, rest, first + full)):
                if many and each:
                    plan.append((length, placed, placed + many * each, each, start, window - room))
                    placed += many * each
                    left -= many * each
                    keep(room - each * length, start, many)
            used = full + (1 if rest else 0)
            keep(room, first + used, count - used)
    return plan


def slot_ranges(spark: SparkSession, plan: list[tuple], counts: dict[int, int]) -> tuple[DataFrame, DataFrame]:
    """The plan as a table for an equi-join: ranks of a length are cut into as many
    equal buckets as it has ranges, and a range is listed in each bucket that it meets.
    Also (length, width of its buckets)."""
    ranges = defaultdict(int)
    for r in plan:
        ranges[r[0]] += 1
    width = {n: -(-counts[n] // ranges[n]) for n in ranges}
    rows = [(r[0], bucket, *r[1:]) for r in plan for bucket in range(r[1] // width[r[0]], (r[2] - 1) // width[r[0]] + 1)]
    return (spark.createDataFrame(rows, RANGES),
            spark.createDataFrame(list(width.items()), "length long, width long"))


def cut_pieces(docs: DataFrame, tokenizer_path: str, window: int, with_ids: bool) -> DataFrame:
    """One row per piece, with its task and its rank among the task's pieces of its length."""
    schema = T.StructType(PIECES.fields + [T.StructField("ids", T.BinaryType())]) if with_ids else PIECES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        task, encode, seen = TaskContext.get().partitionId(), word_encoder(tokenizer_path).encode, defaultdict(int)
        for b in batches:
            sizes, doc_ids = b.column(2).to_pylist(), b.column(0)
            for lo, hi in sized_slices(sizes):
                out: dict[str, list] = {f.name: [] for f in schema.fields}
                texts = b.column(1).slice(lo, hi - lo).to_pylist()
                for doc_id, ids in zip(doc_ids.slice(lo, hi - lo).to_pylist(), encode(texts), strict=True):
                    ids += END_ID
                    for piece, at in enumerate(range(0, len(ids), 4 * window)):
                        some = ids[at:at + 4 * window]
                        length = len(some) // 4
                        row = (doc_id, piece, at // 4, length, zlib.crc32(some), task, seen[length], some)
                        for name, v in zip(schema.names, row, strict=False):
                            out[name].append(v)
                        seen[length] += 1
                yield to_batch(out, schema)

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
                       F.length(text).alias("size")).mapInArrow(run, schema)


def pack(spark: SparkSession, docs: DataFrame, tokenizer_path: str, window: int = WINDOW, with_ids: bool = False) -> DataFrame:
    """One row per piece of ``docs`` (doc_id, text): where it lies in its document,
    its sequence and its offset there; ``with_ids`` adds the ids themselves."""
    ship_package(spark)
    pieces = stage(spark, cut_pieces(docs, tokenizer_path, window, with_ids), "pieces")
    local = pieces.groupBy("__task", "length").agg(F.count(F.lit(1)).alias("n"))
    counts = {r["length"]: r["n"] for r in local.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    ranges, widths = slot_ranges(spark, best_fit_plan(counts.items(), window), counts)
    earlier = Window.partitionBy("length").orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    base = (local.withColumn("base", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
            .join(F.broadcast(widths), "length").select("__task", "length", "base", "width"))
    ranked = (pieces.join(base, ["__task", "length"])
              .withColumn("rank", F.col("base") + F.col("__local"))
              .withColumn("bucket", F.expr("rank div width")))
    placed = ranked.join(F.broadcast(ranges), ["length", "bucket"]).where("rank >= lo and rank < hi")
    kept = [c for c in pieces.columns if not c.startswith("__")]
    return placed.select(*kept, F.expr("first_window + (rank - lo) div per_window").alias("sequence_id"),
                         F.expr("first_offset + (rank - lo) % per_window * length").alias("offset"))

"""Links inside buckets, and connected components of links, without a task that
holds a whole bucket or component."""

from __future__ import annotations

import functools
import math
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.llm.alignment import banded_distance, lacking
from blotter.llm.common import stage, unstage

SMALL_BUCKET = 16
LEADERS = 8
WITNESSES = 4


def allowed_edits(share: float, a: int, b: int) -> int:
    """Edits allowed between texts of ``a`` and ``b`` words (the small term undoes
    the rounding of ``share``)."""
    return math.floor(share * max(a, b) + 1e-6)


def max_edits(share: float, a: Column, b: Column) -> Column:
    """Column form of :func:`allowed_edits`."""
    return F.floor(F.lit(share) * F.greatest(a, b) + F.lit(1e-6))


def least_words(share: float) -> int:
    """Shorter texts than this can be linked to no other: their longest possible
    partner would allow no edit."""
    return max(1, math.ceil(1 / share - 1e-6) - 1)


def connected(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of ``edges``
    (a, b).  Large-star and small-star steps by turns (Kiveris et al.): each
    links the neighbours of a node to the least of them, until every component
    is a star.  Rounds are written to the shared folder; a hub's edges are
    joined to one row and may be split over tasks."""
    def minima(e: DataFrame) -> DataFrame:
        return e.groupBy("u").agg(F.min("v").alias("m"))

    now = stage(spark, edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    mark = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = minima(both).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = minima(large)
        small = large.join(least, "u")
        small = (small.select("u", F.col("m").alias("v")).unionByName(small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct())
        now = stage(spark, small, "stars")
        seen = now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if seen == mark:
            break
        mark = seen
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()


def _measured(pairs: DataFrame, texts: DataFrame, share: float) -> DataFrame:
    """Distinct ``pairs`` (x, y) with ``least``, the edit distance ``d`` (-1 where it is
    more than ``share`` of the longer text) and the lengths lx and ly.

    ``least`` bounds the distance from below; only where it leaves room are the
    texts aligned.  The rows are dealt to a fixed number of tasks, since it is
    alignments and not bytes that cost."""
    tasks = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = (pairs.join(texts.select(F.col("id").alias("x"), F.col("seq").alias("sx")), "x").repartition(tasks, "y")
            .join(texts.select(F.col("id").alias("y"), F.col("seq").alias("sy")).hint("merge"), "y"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            least, d, lx, ly = [], [], [], []
            for a, b in zip(batch.column(2), batch.column(3), strict=True):
                a, b = a.as_py(), b.as_py()
                limit = allowed_edits(share, len(a), len(b))
                least.append(lacking(a, b))
                d.append(banded_distance(a, b, limit) if least[-1] <= limit else -1)
                lx.append(len(a))
                ly.append(len(b))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c, pa.int32()) for c in (least, d, lx, ly))],
                                             ["x", "y", "least", "d", "lx", "ly"])

    return both.select("x", "y", "sx", "sy").mapInArrow(measure, "x long, y long, least int, d int, lx int, ly int")


def bucket_links(spark: SparkSession, members: DataFrame, texts: DataFrame | Callable[[DataFrame], DataFrame], share: float,
                 spent: tuple[DataFrame, ...] = ()) -> DataFrame:
    """Edges (a, b) whose components are those of all pairs that share a bucket and
    whose edit distance is at most ``share`` of the longer text.

    members: (bucket, id, prior, size in words), texts: (id, seq), or what gives them for
    distinct ids: those of large buckets, and those that are left in a pair.  ``spent``: staged
    frames that only ``members`` reads, removed after it.  Small buckets give all
    their pairs.  A large bucket is compared with a leader, its member of least
    ``prior``: what is near the leader is linked to it and done.  The rest goes
    on to the next round, which has eight times the leaders; it is compared with
    a few of the done texts, and what is near one of them is linked, which spares
    it the others, but not done: only what is near the leader has all its
    partners within ``reach`` of it.  What is not linked is compared with all that
    is done, but only where the triangle inequality leaves room for a link.  ``least`` of :func:`_measured` obeys it and is never more than the
    edit distance, so a text whose ``least`` to the leader is larger by more than
    the allowed edits than that of a done text cannot be near that text.  No
    link between components is lost, and no pairs of a whole group are made."""
    ratio = 1 / (1 - share)  # near texts differ in length by at most this factor
    reach = share * ratio * (1 + ratio)  # of a leader's length: beyond, nothing near the leader can be near

    none = members.select(F.col("id").alias("x"), F.col("id").alias("y")).limit(0)
    left, number, found, pairs_to_do = members, 0, [], []  # pairs that decide nothing in a round are kept and aligned at the end
    while True:
        sizes = left.groupBy("bucket").agg(F.count("*").alias("n"), F.min(F.struct("prior", "id")).alias("first")).where("n > 1")
        sized = stage(spark, left.join(sizes, "bucket"), "buckets")
        unstage(spark, *spent)
        spent = ()
        counts = sized.agg(F.count("*").alias("all"), F.count_if(F.col("n") > SMALL_BUCKET).alias("hot")).first()
        if counts["all"]:
            few = sized.where(F.col("n") <= SMALL_BUCKET)
            pairs_to_do.append(stage(spark, few.select("bucket", F.col("id").alias("x"), F.col("size").alias("nx"))
                               .join(few.select("bucket", F.col("id").alias("y"), F.col("size").alias("ny")), "bucket")
                               .where((F.col("x") < F.col("y")) & (F.abs(F.col("nx") - F.col("ny")) <= max_edits(share, F.col("nx"), F.col("ny"))))
                               .select("x", "y").distinct(), "near-pairs"))
        hot = sized.where(F.col("n") > SMALL_BUCKET)
        if callable(texts):
            ids = [hot.select("id"), *(p.select(F.col(c).alias("id")) for p in pairs_to_do for c in "xy")]
            texts = texts(functools.reduce(DataFrame.unionByName, ids).distinct())
        if not counts["hot"]:
            unstage(spark, sized)
            break
        draw = F.pmod(F.xxhash64("id", F.lit(number)), F.col("n"))
        is_leader = (F.col("id") == F.col("first.id")) | (F.lit(number > 0) & (draw < LEADERS ** number))
        leaders = hot.where(is_leader).select("bucket", F.col("id").alias("y"), F.col("size").alias("ny"))
        pairs = (hot.select("bucket", F.col("id").alias("x"), F.col("size").alias("nx")).join(leaders, "bucket")
                 .where((F.col("x") != F.col("y")) & (F.abs(F.col("nx") - F.col("ny")) <= F.lit(reach) * F.col("ny") + 1)).select("bucket", "x", "y"))
        measured = stage(spark, _measured(pairs.select("x", "y").distinct(), texts, share)
                         .where(F.col("least") <= F.lit(reach) * F.col("ly") + 1)
                         .select("x", "y", "least", (F.col("d") >= 0).alias("near"), F.col("lx").alias("length")), "leaders")
        found.append(measured.where("near").select(F.col("x").alias("a"), F.col("y").alias("b")))
        told = pairs.join(measured, ["x", "y"])
        done = told.where("near").select("bucket", "y", F.col("x").alias("a"), F.col("least").alias("da"), F.col("length").alias("la"))
        rest = told.where("not near").select("bucket", "y", F.col("x").alias("r"), F.col("least").alias("dr"), F.col("length").alias("lr"))
        edits = max_edits(share, F.col("lr"), F.col("la"))
        room = (F.col("dr") - F.col("da") <= edits) & (F.abs(F.col("lr") - F.col("la")) <= edits)
        # most of the rest is near one of the done texts that are nearest to the leader: those first
        witness = (done.groupBy("bucket", "y", F.pmod(F.xxhash64("a"), F.lit(WITNESSES))).agg(F.min(F.struct("da", "a", "la")).alias("w"))
                   .select("bucket", "y", "w.*"))
        tries = rest.join(witness, ["bucket", "y"]).where(room)
        tried = stage(spark, _measured(tries.select(F.col("r").alias("x"), F.col("a").alias("y")).distinct(), texts, share)
                      .where("d >= 0").select("x", F.col("y").alias("w")), "witnesses")
        found.append(tried.select(F.col("x").alias("a"), F.col("w").alias("b")))
        linked = tries.join(tried, (F.col("r") == F.col("x")) & (F.col("a") == F.col("w"))).select("bucket", "y", "r").distinct()
        rest = rest.join(linked, ["bucket", "y", "r"], "left_anti")
        pairs_to_do.append(stage(spark, rest.join(done, ["bucket", "y"]).where(room).select(
            F.least("r", "a").alias("x"), F.greatest("r", "a").alias("y")).distinct(), "rest-pairs"))
        settled = done.select("bucket", F.col("a").alias("id")).unionByName(leaders.select("bucket", F.col("y").alias("id"))).distinct()
        left = stage(spark, hot.select(*members.columns).join(settled, ["bucket", "id"], "left_anti"), "left")
        unstage(spark, sized)
        number += 1
    pairs = functools.reduce(DataFrame.unionByName, pairs_to_do, none).distinct()
    found.append(stage(spark, _measured(pairs, texts, share).where("d >= 0").select(F.col("x").alias("a"), F.col("y").alias("b")), "links"))
    return functools.reduce(DataFrame.unionByName, found)


def length_classes(words: Column, share: float) -> Column:
    """The two length classes of a text: texts of which the longer has at most
    1 / (1 - share) times the words of the other have one in common, so a
    bucket may be split by class without losing a link."""
    own = F.floor(F.log(words.cast("double")) / math.log(1 / (1 - share)) + 1e-9).cast("long")
    return F.array(own, own + 1)


#: Bits of the filter that says which units may be wanted; its size never grows.
FILTER_BITS = 1 << 27


def wanted_filter(spark: SparkSession, keys: DataFrame, column: str):
    """A broadcast bitmap of hashes modulo FILTER_BITS (16 MB at most, in 32,768-bit
    rows): a pre-filter for a join that follows.  At any size it is right; the
    more keys there are, the less it saves."""
    import numpy as np
    place = F.pmod(F.col(column), F.lit(FILTER_BITS))
    rows = (keys.select(F.expr(f"bitmap_bucket_number(pmod({column}, {FILTER_BITS}L) + 1)").alias("k"),
                        F.bitmap_bit_position(place + 1).alias("p"))
            .groupBy("k").agg(F.bitmap_construct_agg("p").alias("bits")).collect())
    bits = np.zeros(FILTER_BITS // 8, dtype=np.uint8)
    for r in rows:
        at = (r["k"] - 1) * 4096
        bits[at:at + 4096] = np.frombuffer(r["bits"], dtype=np.uint8)
    return spark.sparkContext.broadcast(bits)


def maybe_wanted(bits, keys):
    """Which of the 64-bit ``keys`` the bitmap may hold."""
    import numpy as np
    place = np.mod(keys, np.int64(FILTER_BITS))
    return (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1

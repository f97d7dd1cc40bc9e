"""Operator 12: hard negatives by a BOND vertical scan.

Vectors are made integer (each component floor(scale * x)) and stored vertically: a
section holds up to some thousand rows as one array per dimension, with the
dimension's least and greatest value.  An anchor reads the dimensions of a section
in descending order of its own magnitudes, a few at a time.  After each step a
row's score lies between its partial sum plus the least and plus the greatest
that the unread dimensions can add; rows whose interval cannot reach what is asked
for leave the candidate bitmap, and those that stay to the end have exact scores.

Two scans use it.  The first finds an anchor's positives, the best rows of its own
label; a row leaves when its upper bound is below the k-th best lower bound.  The second
has a window [share * positive's score, positive's score] per positive and looks at the
other labels; a row leaves when it can reach no window, or only windows that hold k
rows for certain which all beat it.  A section gives at most k rows per
anchor (and positive); the best k of all sections follow from a ranked window.

Anchors are bundled, and a cell is one bundle against one section, both of bounded
size, so no task holds a group that grows with the table; the stated anchors meet
all rows in such blocks.  Nothing is drawn to the driver but two counts.

Defined results: rows with a null label, a null vector, or a null or non-finite
component take no part; vectors compare only with vectors of their length; equal
scores go by smaller vec_id, null ids last, and rows that repeat an id count one by
one, each as an anchor, positive or negative of its own; a row is never its own
positive; components are held to +-2^20 (|x| < 4096 is exact); an empty table gives
an empty result; extra columns are ignored."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from blotter.llm.common import ship_package, stage, to_batch

SCALE, LIMIT = 256, 1 << 20
SECTION_ROWS, BUNDLE_ROWS = 4096, 512
STEP = 8
POSITIVES = NEGATIVES = 5
#: A negative's score is at least this share (numerator, denominator) of the positive's.
SHARE = (4, 5)

SECTION = T.StructType([
    T.StructField("section", T.LongType()), T.StructField("dims", T.IntegerType()),
    T.StructField("rows", T.ArrayType(T.LongType())), T.StructField("ids", T.ArrayType(T.LongType())),
    T.StructField("labels", T.ArrayType(T.LongType())), T.StructField("columns", T.ArrayType(T.BinaryType())),
    T.StructField("least", T.ArrayType(T.IntegerType())), T.StructField("greatest", T.ArrayType(T.IntegerType()))])
FOUND = T.StructType([
    T.StructField("anchor_row", T.LongType()), T.StructField("positive_row", T.LongType()),
    T.StructField("found_row", T.LongType()), T.StructField("found_id", T.LongType()), T.StructField("score", T.LongType())])


def integer_rows(vectors: DataFrame, label: Column, anchor: Column) -> DataFrame:
    """The rows that take part: vec_id, label, integer components, whether an anchor."""
    x = F.transform("embedding", lambda v: v.cast("double"))
    whole = F.transform(x, lambda v: F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), F.floor(F.lit(float(SCALE)) * v))).cast("int"))
    good = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return (vectors.where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & good)
            .select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"),
                    whole.alias("parts"), F.size("embedding").alias("dims"), F.coalesce(anchor, F.lit(False)).alias("anchor"))
            .withColumn("row", F.monotonically_increasing_id()))


def build_section(key: tuple, rows: pa.Table) -> pa.Table:
    """One section, columns by dimension, rows ordered by (vec_id, nulls last)."""
    rows = rows.sort_by([("vec_id", "ascending"), ("row", "ascending")])
    dims = key[1].as_py()
    m = rows.column("parts").combine_chunks().flatten().to_numpy().astype("<i4").reshape(len(rows), dims).T
    out = {"section": [key[0].as_py()], "dims": [dims], "rows": [rows.column("row").to_pylist()], "ids": [rows.column("vec_id").to_pylist()],
           "labels": [rows.column("label").to_pylist()], "columns": [[np.ascontiguousarray(c).tobytes() for c in m]],
           "least": [m.min(axis=1).tolist()], "greatest": [m.max(axis=1).tolist()]}
    return pa.Table.from_batches([to_batch(out, SECTION)])


class VerticalSection:
    """The columns of one section, and the scan over them."""

    def __init__(self, section: dict):
        dims = section["dims"]
        # sums of products of 21-bit integers are exact as doubles up to 2^12 dimensions
        kind = np.float64 if dims <= 4096 else np.int64
        self.rows, self.labels = np.array(section["rows"], np.int64), np.array(section["labels"], np.int64)
        self.ids = section["ids"]
        n = len(self.rows)
        self.columns = np.stack([np.frombuffer(c, "<i4") for c in section["columns"]]).astype(kind) if dims else np.zeros((0, n), kind)
        self.least, self.greatest = (np.array(section[c], dtype=kind) for c in ("least", "greatest"))

    def scan(self, anchor: np.ndarray, bitmap: np.ndarray, keep) -> tuple[np.ndarray, np.ndarray]:
        """Positions and exact scores of the rows of ``bitmap`` that outlast ``keep``
        (lower bounds, upper bounds -> mask), dimensions in descending magnitude."""
        q = anchor.astype(self.columns.dtype)
        order = np.argsort(-np.abs(q), kind="stable")
        ends = q * self.least, q * self.greatest
        rest = [np.concatenate([np.cumsum(e[order][::-1])[::-1], [0]]) for e in (np.minimum(*ends), np.maximum(*ends))]
        at = np.flatnonzero(bitmap)
        score = np.zeros(len(at), dtype=self.columns.dtype)
        for d in range(0, len(order), STEP):
            if not len(at):
                break
            some = order[d:d + STEP]
            score = score + q[some] @ self.columns[some][:, at]
            low, high = rest[0][min(d + STEP, len(order))], rest[1][min(d + STEP, len(order))]
            stays = keep(score + low, score + high)
            if not stays.all():
                bitmap = bitmap.copy()
                bitmap[at[~stays]] = False
                at, score = np.flatnonzero(bitmap), score[stays]
        return at, score.astype(np.int64)


def kth_best(values: np.ndarray, k: int) -> float:
    return -np.inf if len(values) < k else np.partition(values, len(values) - k)[len(values) - k]


def best(at: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Indices of the k best scores, ties by position (that is, by vec_id)."""
    return np.lexsort((at, -score))[:k]


def anchors_of(bundle: pa.Table, dims: int) -> list[dict]:
    return [a for a in bundle.to_pylist() if a["dims"] == dims]


def nearest_of_label(k: int):
    def cell(bundle: pa.Table, sections: pa.Table) -> pa.Table:
        out: dict[str, list] = {f.name: [] for f in FOUND.fields}
        for section in sections.to_pylist():
            s = VerticalSection(section)
            for a in anchors_of(bundle, section["dims"]):
                at, score = s.scan(np.array(a["parts"]), (s.labels == a["label"]) & (s.rows != a["row"]),
                                   lambda low, high: high >= kth_best(low, k))
                for i in best(at, score, k):
                    for name, v in zip(FOUND.names, (a["row"], None, s.rows[at[i]], s.ids[at[i]], score[i]), strict=True):
                        out[name].append(v)
        return pa.Table.from_batches([to_batch(out, FOUND)])
    return cell


def keep_windows(floors: np.ndarray, tops: np.ndarray, k: int):
    """Rows that may still be among the k best of a window [floor, top]."""
    def keep(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        stays = np.zeros(len(low), dtype=bool)
        for floor, top in zip(floors, tops, strict=True):
            certain = low[(low >= floor) & (high <= top)]
            stays |= (high >= max(floor, kth_best(certain, k))) & (low <= top)
        return stays
    return keep


def inside_windows(k: int, share: tuple[int, int]):
    def cell(bundle: pa.Table, sections: pa.Table) -> pa.Table:
        out: dict[str, list] = {f.name: [] for f in FOUND.fields}
        for section in sections.to_pylist():
            s = VerticalSection(section)
            for a in anchors_of(bundle, section["dims"]):
                tops = np.array([p["score"] for p in a["positives"]])
                floors = -(-share[0] * tops // share[1])
                at, score = s.scan(np.array(a["parts"]), s.labels != a["label"], keep_windows(floors, tops, k))
                for p, floor, top in zip(a["positives"], floors, tops, strict=True):
                    inside = np.flatnonzero((score >= floor) & (score <= top))
                    for i in inside[best(at[inside], score[inside], k)]:
                        for name, v in zip(FOUND.names, (a["row"], p["row"], s.rows[at[i]], s.ids[at[i]], score[i]), strict=True):
                            out[name].append(v)
        return pa.Table.from_batches([to_batch(out, FOUND)])
    return cell


def over_cells(anchors: DataFrame, sections: DataFrame, bundles: int, parts: int, cell) -> DataFrame:
    """``cell`` for each (bundle, section)."""
    left = anchors.withColumn("section", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)).cast("array<bigint>")))
    right = sections.withColumn("bundle", F.explode(F.sequence(F.lit(0), F.lit(bundles - 1)).cast("array<bigint>")))
    return (left.groupBy("bundle", "section").cogroup(right.groupBy("bundle", "section"))
            .applyInArrow(cell, FOUND))


def ranked(found: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("found_id"), "found_row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(spark: SparkSession, vectors: DataFrame, label: Column, anchor: Column, positives: int = POSITIVES,
                   negatives: int = NEGATIVES, share: tuple[int, int] = SHARE, section_rows: int = SECTION_ROWS,
                   bundle_rows: int = BUNDLE_ROWS) -> DataFrame:
    """For each ``anchor`` row and each of its ``positives`` best rows of the same
    ``label``: the ``negatives`` best rows of other labels whose score is between ``share`` of the
    positive's and the positive's."""
    ship_package(spark)
    rows = stage(spark, integer_rows(vectors, label, anchor), "integers")
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("anchor").alias("a")).first()
    parts, bundles = max(1, -(-size["n"] // section_rows)), max(1, -(-size["a"] // bundle_rows))
    sections = stage(spark, rows.withColumn("section", F.pmod(F.xxhash64("row"), F.lit(parts)))
                     .select("section", "dims", "row", "vec_id", "label", "parts")
                     .groupBy("section", "dims").applyInArrow(build_section, SECTION), "sections")
    anchors = rows.where("anchor").withColumn("bundle", F.pmod(F.xxhash64("row"), F.lit(bundles)))
    same = ranked(over_cells(anchors, sections, bundles, parts, nearest_of_label(positives)), ["anchor_row"], positives)
    same = stage(spark, same.select("anchor_row", F.col("found_row").alias("positive_row"), F.col("found_id").alias("positive_id"),
                                    F.col("score").alias("positive_score")), "positives")
    listed = same.groupBy("anchor_row").agg(F.collect_list(F.struct(
        F.col("positive_row").alias("row"), F.col("positive_score").alias("score"))).alias("positives"))
    asking = anchors.join(listed, F.col("row") == F.col("anchor_row")).drop("anchor_row")
    other = ranked(over_cells(asking, sections, bundles, parts, inside_windows(negatives, share)), ["anchor_row", "positive_row"], negatives)
    ids = anchors.select(F.col("row").alias("anchor_row"), F.col("vec_id").alias("anchor_id"))
    return (other.join(same, ["anchor_row", "positive_row"]).join(ids, "anchor_row")
            .select("anchor_id", "positive_id", "rank", F.col("found_id").alias("negative_id"), "positive_score",
                    F.col("score").alias("negative_score")))

"""Operator 6: near-duplicate embeddings by NN-descent.

Vectors are compared only with vectors of their label, by cosine in double
precision.  A neighbour graph is started from random-hyperplane blocks and
refined: the neighbours of a vector (forward and reverse) are joined at it, and
each takes the best it meets into its list.  A list that is full of links is
saturated and may grow to twice its length in the next round.  After a round
the links of a bounded sample are compared with brute force; rounds go on until
the recall is reached.  Links (cosine >= threshold) give components.

A saturated list may hold its own dense group alone and none of a group nearby.  So
the vectors with saturated lists go on searching among those of *other*
components, with lists of their own for that (:func:`bridged`), until a search
finds no link and the sample, compared with all links this time and not only as far
as lists are long, has its links inside components.

Inside a component all pairs are then compared exactly, in tiles of a bounded number of
rows that give counts and not pairs: that is the full enlargement of its
saturated lists.  Equal vectors are one vector with a weight throughout.

Defined results: a vector that is null, empty or zero, or holds a null or
non-finite number, or has no label, links with nothing, nor do vectors of
different lengths; rows that repeat a vec_id are vectors of their own; a null
vec_id is a component's id only if the component has no other; an empty table
gives an empty result; extra columns are ignored."""

from __future__ import annotations

import warnings
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from blotter.llm.common import ship_package, stage
from blotter.llm.components import connected

THRESHOLD = 0.93
NEIGHBOURS = 10
TABLES = 4
BLOCK = 256
JOIN_ROWS = 64
TILE = 256
AUDIT_QUERIES = 500
RECALL = 0.99
MAX_ROUNDS = 8
MAX_BITS = 40
EDGES = "src long, dst long, sim double"


def unit_rows(packed: list[bytes], width: int) -> np.ndarray:
    """Unit rows in double precision from packed vectors of one length."""
    kind = np.float32 if width == 4 else np.float64
    m = np.frombuffer(b"".join(packed), dtype=kind).reshape(len(packed), -1).astype(np.float64)
    m = m / np.abs(m).max(axis=1, keepdims=True)
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def vectors(spark: SparkSession, table: DataFrame, vec: str = "embedding", key: str = "vec_id", label: str = "label") -> DataFrame:
    """Rows that can link: id (a number of the row), vec_id, label, dim, vec (packed)."""
    ship_package(spark)
    width = 4 if isinstance(table.schema[vec].dataType.elementType, T.FloatType) else 8
    kind = "array<float>" if width == 4 else "array<double>"
    numbered = stage(spark, table.select(
        F.col(key).cast("long").alias("vec_id"), F.col(label).alias("label"), F.col(vec).cast(kind).alias("v"))
        .withColumn("id", F.monotonically_increasing_id()), "vectors")
    finite = F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x)) & F.exists("v", lambda x: x != 0)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, offsets = b.column(2).values.to_numpy(zero_copy_only=False), b.column(2).offsets.to_numpy()
            vec = [rows[s:e].tobytes() for s, e in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(np.diff(offsets), pa.int32()), pa.array(vec, pa.binary())], ["id", "grp", "dim", "vec"])

    usable = numbered.where(F.col("label").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)).where(finite)
    ready = usable.select("id", F.col("label").cast("string").alias("grp"), "v").mapInArrow(packed, "id long, grp string, dim int, vec binary")
    return numbered.select("id", "vec_id"), stage(spark, ready, "packed"), width


def distinct_vectors(spark: SparkSession, ready: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One row of equal vectors, with their number as ``weight``, and (id, same) for the
    others.  The row that stands for them is that of the smallest id."""
    key = F.md5("vec").alias("key")
    found = ready.groupBy("grp", "dim", key).agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("weight"))
    found = stage(spark, found, "distinct")
    one = ready.join(found.select(F.col("first").alias("id"), "weight"), "id").withColumn("apart", F.col("id"))
    several = found.where("weight > 1").select("grp", "dim", "key", F.col("first").alias("same"))
    rest = ready.select("id", "grp", "dim", key).join(several, ["grp", "dim", "key"]).where("id <> same").select("id", "same")
    return stage(spark, one, "vectors"), stage(spark, rest, "same")


def _best(ids: np.ndarray, units: np.ndarray, least: np.ndarray, most: int | None, apart: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(src, dst, sim) among the rows: pairs better than each row's ``least``, at
    most ``most`` a row, none with equal ``apart``."""
    sim = units @ units.T
    sim[apart[:, None] == apart[None, :]] = -2.0
    if most is not None and most < len(ids):
        cut = -np.partition(-sim, most - 1, axis=1)[:, most - 1]
        least = np.maximum(least, cut - 1e-15)
    src, dst = np.nonzero(sim > np.maximum(least, -1.5)[:, None])
    return ids[src], ids[dst], sim[src, dst]


def first_graph(spark: SparkSession, ready: DataFrame, width: int, k: int, seed: int = 0) -> DataFrame:
    """Best neighbours inside blocks of vectors on the same side of random planes,
    over several tables; blocks hold about BLOCK rows and larger ones are dealt
    out by hash.  Vectors of equal ``apart`` are not neighbours."""
    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims, vec = b.column(2).to_numpy(), b.column(3).to_pylist()
            out = np.zeros((len(vec), TABLES), dtype=np.int64)
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                units = unit_rows([vec[i] for i in at], width)
                planes = np.random.default_rng([int(d), seed] if seed else int(d)).standard_normal((int(d), TABLES * MAX_BITS))
                sides = ((units @ planes) > 0).reshape(len(at), TABLES, MAX_BITS)
                out[at] = (sides * (1 << np.arange(MAX_BITS, dtype=np.int64))).sum(axis=2)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.ListArray.from_arrays(np.arange(len(vec) + 1, dtype=np.int32) * TABLES, out.ravel())],
                                             ["id", "grp", "dim", "vec", "apart", "codes"])

    def best(part: pa.Table) -> pa.Table:
        ids = part.column("id").to_numpy()
        src, dst, sim = _best(ids, unit_rows(part.column("vec").to_pylist(), width), np.full(len(ids), -2.0), k, part.column("apart").to_numpy())
        return pa.table({"src": src, "dst": dst, "sim": sim})

    coded = ready.select("id", "grp", "dim", "vec", "apart").mapInArrow(codes, "id long, grp string, dim int, vec binary, apart long, codes array<long>")
    sizes = ready.groupBy("grp", "dim").agg(F.greatest(F.ceil(F.log2(F.count("*") / F.lit(float(BLOCK)))), F.lit(0)).cast("int").alias("bits"))
    rows = (coded.join(sizes, ["grp", "dim"]).select("id", "grp", "dim", "vec", "apart", "bits", F.posexplode("codes").alias("t", "code"))
            .withColumn("code", F.expr(f"code & (shiftleft(1L, least(bits, {MAX_BITS})) - 1)")))
    block = ["grp", "dim", "t", "code"]
    loads = rows.groupBy(*block).agg(F.ceil(F.count("*") / F.lit(2.0 * BLOCK)).alias("parts"))
    dealt = rows.join(loads, block).withColumn("part", F.pmod(F.xxhash64("id", "t", F.lit(seed)), F.col("parts")))
    return dealt.select(*block, "part", "id", "vec", "apart").groupBy(*block, "part").applyInArrow(best, EDGES)


def merged(edges: DataFrame, limits: DataFrame | None, k: int) -> DataFrame:
    """The best of each list, up to its limit (``k`` where none is given)."""
    rank = F.row_number().over(Window.partitionBy("src").orderBy(F.desc("sim"), "dst"))
    one = edges.groupBy("src", "dst").agg(F.max("sim").alias("sim"))
    if limits is None:
        return one.withColumn("r", rank).where(F.col("r") <= k).drop("r")
    return (one.withColumn("r", rank).join(limits.select(F.col("id").alias("src"), "limit"), "src", "left")
            .where(F.col("r") <= F.coalesce("limit", F.lit(k))).select("src", "dst", "sim"))


def refined(spark: SparkSession, edges: DataFrame, ready: DataFrame, width: int, k: int, threshold: float) -> DataFrame:
    """One round: join the neighbours of every vector at it and update the lists."""
    lists = edges.groupBy(F.col("src").alias("id")).agg(F.count("*").alias("held"), F.min("sim").alias("worst"))
    saturated = (F.col("held") >= k) & (F.col("worst") >= threshold)
    limits = stage(spark, lists.select("id", F.when(saturated, 2 * F.col("held")).otherwise(k).alias("limit"),
                                       F.when((F.col("held") >= k) & ~saturated, F.col("worst")).otherwise(-2.0).alias("least")), "limits")
    at = edges.select(F.col("src").alias("u"), F.col("dst").alias("id")).unionByName(edges.select(F.col("dst").alias("u"), F.col("src").alias("id")))
    at = at.unionByName(limits.select(F.col("id").alias("u"), "id")).distinct()
    degree = at.groupBy("u").agg(F.ceil(F.count("*") / F.lit(float(JOIN_ROWS))).alias("parts"))
    known = ready.select("id", "vec", "apart").join(limits.select("id", "least", "limit"), "id")
    total = limits.count()
    rows = (at.join(degree, "u").withColumn("part", F.pmod(F.xxhash64("id", "u"), F.col("parts"))).join(known, "id")
            .withColumn("bin", F.pmod(F.xxhash64("u", "part"), F.lit(max(1, total // 64)))))

    def local(part: pa.Table) -> pa.Table:
        part = part.sort_by([("u", "ascending"), ("part", "ascending")])
        u, p = part.column("u").to_numpy(), part.column("part").to_numpy()
        ids, least, limit, vec = part.column("id").to_numpy(), part.column("least").to_numpy(), part.column("limit").to_numpy(), part.column("vec").to_pylist()
        apart = part.column("apart").to_numpy()
        cuts = np.concatenate([[0], np.flatnonzero((u[1:] != u[:-1]) | (p[1:] != p[:-1])) + 1, [len(u)]])
        found = [_best(ids[s:e], unit_rows(vec[s:e], width), least[s:e], int(limit[s:e].max()), apart[s:e]) for s, e in zip(cuts[:-1], cuts[1:], strict=True) if e - s > 1]
        columns = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        return pa.table(dict(zip(("src", "dst", "sim"), columns, strict=True)))

    met = rows.select("bin", "u", "part", "id", "least", "limit", "vec", "apart").groupBy("bin").applyInArrow(local, EDGES)
    return stage(spark, merged(edges.unionByName(met), limits, k), "graph")


def audited_recall(spark: SparkSession, edges: DataFrame, ready: DataFrame, width: int, threshold: float, groups: DataFrame | None = None) -> float:
    """Share of the true links of at most AUDIT_QUERIES vectors (those of least
    hash) that their lists hold, as far as the lists are long; with ``groups``, of all their links
    that lie inside a component."""
    queries = ready.orderBy(F.xxhash64("id"), "id").limit(AUDIT_QUERIES).select("id", "grp", "dim", "vec").collect()
    if not queries:
        return 1.0
    by_group: dict[tuple, list] = {}
    for q in queries:
        by_group.setdefault((q["grp"], q["dim"]), []).append((q["id"], bytes(q["vec"])))
    shared = spark.sparkContext.broadcast({g: (np.array([i for i, _ in v]), unit_rows([x for _, x in v], width)) for g, v in by_group.items()})

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, keys, vec = b.column(0).to_numpy(), list(zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)), b.column(3).to_pylist()
            for g in set(keys) & set(shared.value):
                at = np.array([i for i, key in enumerate(keys) if key == g])
                asked, units = shared.value[g]
                q, x = np.nonzero(units @ unit_rows([vec[i] for i in at], width).T >= threshold)
                other = asked[q] != ids[at][x]
                yield pa.RecordBatch.from_arrays([pa.array(asked[q][other]), pa.array(ids[at][x][other])], ["src", "dst"])

    true = ready.select("id", "grp", "dim", "vec").mapInArrow(links, "src long, dst long")
    if groups is not None:
        ends = [groups.select(F.col("node").alias(end), F.col("component").alias(f"{end}_in")) for end in ("src", "dst")]
        inside = F.coalesce(F.col("src_in") == F.col("dst_in"), F.lit(False))
        found = true.join(ends[0], "src", "left").join(ends[1], "dst", "left").agg(F.count(F.lit(1)).alias("true"), F.count_if(inside).alias("hit")).first()
        return 1.0 if not found["true"] else found["hit"] / found["true"]
    held = edges.where(F.col("sim") >= threshold).select("src", "dst", F.lit(1).alias("hit"))
    each = true.join(held, ["src", "dst"], "left").groupBy("src").agg(F.count("*").alias("true"), F.count("hit").alias("hit"))
    lengths = edges.groupBy("src").agg(F.count("*").alias("len"))
    total = each.join(lengths, "src", "left").agg(F.sum("hit").alias("hit"), F.sum(F.least("true", F.greatest(F.coalesce("len", F.lit(0)), F.lit(NEIGHBOURS)))).alias("true")).first()
    return 1.0 if not total["true"] else total["hit"] / total["true"]


def bridged(spark: SparkSession, edges: DataFrame, links: DataFrame, ready: DataFrame, width: int, k: int, threshold: float) -> DataFrame:
    """Components of ``links`` and of the links that saturated lists had no room for: their
    vectors search among those of other components, by blocks over new planes and one
    round of refinement, until a search finds nothing and the sample's links are inside components."""
    lists = edges.groupBy(F.col("src").alias("id")).agg(F.count("*").alias("held"), F.min("sim").alias("worst"))
    full = stage(spark, lists.where((F.col("held") >= k) & (F.col("worst") >= threshold)).select("id"), "saturated")
    groups = stage(spark, connected(spark, links), "components")
    if full.isEmpty():
        return groups
    dense = stage(spark, ready.drop("apart").join(full, "id"), "dense")
    recall = 0.0
    for search in range(1, MAX_ROUNDS + 1):
        asking = stage(spark, dense.join(groups.select(F.col("node").alias("id"), F.col("component").alias("apart")), "id"), "asking")
        others = stage(spark, merged(first_graph(spark, asking, width, k, search), None, k), "graph")
        others = refined(spark, others, asking, width, k, threshold)
        new = stage(spark, others.where(F.col("sim") >= threshold).select(F.col("src").alias("a"), F.col("dst").alias("b")), "bridges")
        if new.isEmpty():
            recall = audited_recall(spark, edges, ready, width, threshold, groups)
            if recall >= RECALL:
                return groups
            continue
        links = links.unionByName(new)
        groups = stage(spark, connected(spark, links), "components")
    warnings.warn(f"searches between components ended at a recall of {recall:.3f}", stacklevel=2)
    return groups


def link_counts(ready: DataFrame, groups: DataFrame, width: int, threshold: float) -> DataFrame:
    """(id, n): exact links of every vector inside its component.  Small components
    share a task's matrix; one of more than TILE rows is dealt to tiles, and
    each pair of tiles is one task's matrix."""
    sizes = groups.groupBy("component").agg(F.ceil(F.count("*") / F.lit(float(TILE))).cast("int").alias("tiles"), F.count("*").alias("n"))
    bins = F.pmod(F.xxhash64("component"), F.lit(1 << 20))
    total = groups.count()
    rows = groups.join(sizes, "component").withColumn("tile", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
    pairs = F.transform(F.sequence(F.lit(0), F.col("tiles") - 1), lambda j: F.struct(F.least("tile", j).alias("i"), F.greatest("tile", j).alias("j")))
    spread = (rows.withColumn("pair", F.explode(pairs))
              .withColumn("bin", F.when(F.col("tiles") > 1, F.col("component")).otherwise(-1 - F.pmod(bins, F.lit(max(1, total // TILE)))))
              .join(ready.select(F.col("id").alias("node"), "vec", "weight"), "node")
              .select("bin", F.col("pair.i").alias("i"), F.col("pair.j").alias("j"), "component", "tile", "node", "vec", "weight"))

    def count(part: pa.Table) -> pa.Table:
        part = part.sort_by([("component", "ascending"), ("tile", "ascending")])
        i, j = part.column("i")[0].as_py(), part.column("j")[0].as_py()
        ids, comp, tile, vec = part.column("node").to_numpy(), part.column("component").to_numpy(), part.column("tile").to_numpy(), part.column("vec").to_pylist()
        out, weight = np.zeros(len(ids), dtype=np.int64), part.column("weight").to_numpy()
        cuts = np.concatenate([[0], np.flatnonzero(comp[1:] != comp[:-1]) + 1, [len(ids)]])
        for s, e in zip(cuts[:-1], cuts[1:], strict=True):
            units = unit_rows(vec[s:e], width)
            near = units @ units.T >= threshold
            np.fill_diagonal(near, False)
            if i != j:  # both tiles are here; links inside a tile are counted where it meets itself
                near &= tile[s:e][:, None] != tile[s:e][None, :]
            out[s:e] = near @ weight[s:e]
        return pa.table({"id": ids, "n": out})

    return spread.groupBy("bin", "i", "j").applyInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n_links"))


def near_duplicates(spark: SparkSession, table: DataFrame, threshold: float = THRESHOLD, k: int = NEIGHBOURS) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    numbered, every, width = vectors(spark, table)
    ready, same = distinct_vectors(spark, every)
    edges = stage(spark, merged(first_graph(spark, ready, width, k), None, k), "graph")
    for _ in range(MAX_ROUNDS):
        edges = refined(spark, edges, ready, width, k, threshold)
        if audited_recall(spark, edges, ready, width, threshold) >= RECALL:
            break
    links = edges.where(F.col("sim") >= threshold).select(F.col("src").alias("a"), F.col("dst").alias("b"))
    groups = bridged(spark, edges, links, ready, width, k, threshold)
    counts = link_counts(ready, groups, width, threshold)
    # a vector that stands for equal ones links with them too, and they have its links
    alone = ready.select("id", "weight").join(groups.select(F.col("node").alias("id"), "component"), "id", "left").join(counts, "id", "left")
    shown = stage(spark, alone.select("id", F.coalesce("component", "id").alias("component"), (F.coalesce("n_links", F.lit(0)) + F.col("weight") - 1).alias("n_links")), "counted")
    others = same.join(shown.withColumnRenamed("id", "same"), "same").select("id", "component", "n_links")
    told = shown.unionByName(others).join(numbered, "id")
    named = told.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    told = told.join(named, "component").select("id", "n_links", "component_id")
    return numbered.join(told, "id", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id")).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))

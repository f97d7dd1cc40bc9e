"""Operator 10: mixing sources to target weights by weighted fair queueing.

Every shuffled document of a source gets a virtual finish time: the source's
cumulative size up to and including the document, divided by the source's
target weight.  All documents (each repeated ``max_repeats`` times, one epoch
after the other) are then range-sorted by finish time and taken while the
running total is within the budget.

Defined results: null text has size 0, and a document of size 0 is never
taken; the null source is a source of its own, ranked last; a null doc_id is an
id like any other; repeated rows count and are taken separately; with no words
at all every target is 0; an empty table gives an empty result; extra columns
are ignored here and kept by :func:`mixed_documents`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from blotter.llm.common import WORD, running_total, stage

WEIGHTS = (5, 2, 1)
TOTAL_SHARE = 1.5
MAX_REPEATS = 2
SEED = "mix-1"


def water_fill(weights: list[float], caps: list[float], budget: float) -> list[float]:
    """Shares of ``budget`` by weight; a share stops at its cap, and what is above
    is shared anew by weight among the others until none is above."""
    shares = [0.0] * len(weights)
    free, left = list(range(len(weights))), budget
    while free:
        rate = left / sum(weights[i] for i in free)
        over = [i for i in free if rate * weights[i] > caps[i]]
        if not over:
            for i in free:
                shares[i] = rate * weights[i]
            break
        for i in over:
            shares[i] = float(caps[i])
            left -= caps[i]
        free = [i for i in free if i not in over]
    return shares


def source_targets(spark: SparkSession, sized: DataFrame, weights=WEIGHTS, total_share: float = TOTAL_SHARE,
                   max_repeats: int = MAX_REPEATS) -> tuple[DataFrame, int]:
    """Per source its size and target, and the total budget in words.  One row
    per source name comes to the driver (a mix is configured by source, so
    their number is that of a configuration, not of the documents)."""
    rows = [(r["source"], r["s"]) for r in sized.groupBy("source").agg(F.sum("size").alias("s")).collect()]
    rows.sort(key=lambda r: (r[0] is None, r[0] or ""))
    total = sum(s for _, s in rows)
    shares = water_fill([float(weights[i % len(weights)]) for i in range(len(rows))],
                        [max_repeats * s for _, s in rows], total_share * total)
    return spark.createDataFrame([(n, s, t) for (n, s), t in zip(rows, shares, strict=True)],
                                 "source string, source_size long, target double"), int(min(total_share, max_repeats) * total)


def mix(spark: SparkSession, docs: DataFrame, weights=WEIGHTS, total_share: float = TOTAL_SHARE,
        max_repeats: int = MAX_REPEATS, seed: str = SEED) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken
    (words, repeats counted).  Shuffles only thin rows; the prefix sums are
    distributed, so a source with a third of all rows spans many tasks."""
    sized = stage(spark, docs.select(
        "doc_id", F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.md5(F.concat(F.lit(seed), F.lit(":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
              .cast("binary")).alias("__shuffle")), "sized")
    thin = running_total(spark, sized, "source", [F.col("__shuffle"), F.col("doc_id"), F.col("size")], "size", "__before")
    targets, budget = source_targets(spark, sized, weights, total_share, max_repeats)
    per_source = F.broadcast(targets.withColumnRenamed("source", "__s"))
    rows = thin.join(per_source, F.col("source").eqNullSafe(F.col("__s"))).drop("__s")
    copies = (rows.where("size > 0 and target > 0")
              .withColumn("__epoch", F.explode(F.sequence(F.lit(0), F.lit(max_repeats - 1))))
              .withColumn("__finish", (F.col("__epoch") * F.col("source_size") + F.col("__before") + F.col("size"))
                          .cast("double") / F.col("target"))
              .withColumn("__all", F.lit(0)))
    order = [F.col("__finish"), F.col("__shuffle"), F.col("doc_id"), F.col("size"), F.col("__epoch")]
    ranked = running_total(spark, copies.select("__all", "__finish", "__shuffle", "doc_id", "source", "size", "__before", "__epoch"),
                           "__all", order, "size", "__gone")
    taken = (ranked.where(F.col("__gone") + F.col("size") <= budget)
             .groupBy(F.col("source").alias("__ts"), F.col("__before").alias("__tb"), F.col("size").alias("__tz"))
             .agg(F.sum("size").alias("__taken")))
    # a document of positive size is alone at its place in its source
    out = rows.join(taken, F.col("source").eqNullSafe(F.col("__ts")) & (F.col("__before") == F.col("__tb"))
                    & (F.col("size") == F.col("__tz")), "left")
    return out.select("doc_id", "source", "size", "source_size", "target",
                      F.coalesce("__taken", F.lit(0)).cast("long").alias("taken"))


def mixed_documents(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every column of ``docs``, one row for each time a document
    is taken.  Rows that repeat a doc_id share what that id was given, spread
    evenly over them."""
    per_id = (mix(spark, docs, **options).where("size > 0")
              .groupBy(F.col("doc_id").alias("__id"), F.col("source").alias("__src"), F.col("size").alias("__size"))
              .agg((F.sum("taken") / F.max("size")).cast("long").alias("__copies"), F.count("*").alias("__rows")))
    sized = docs.withColumn("__words", F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)).cast("long"))
    same = Window.partitionBy("doc_id", "source", "__words").orderBy(F.xxhash64("text"))
    each = F.floor(F.col("__copies") / F.col("__rows")) + (F.row_number().over(same) <= F.col("__copies") % F.col("__rows")).cast("int")
    return (sized.join(per_id, F.col("doc_id").eqNullSafe(F.col("__id"))
                       & F.col("source").cast("string").eqNullSafe(F.col("__src")) & (F.col("__words") == F.col("__size")))
            .withColumn("__each", each.cast("int")).where("__each > 0")
            .withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__each"))))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))

"""State of a ``foreachBatch`` query as data below its checkpoint.

:class:`StateLog` holds keyed counters as a log: each micro-batch writes only the
increments of the keys that it touched, and the state is the sum over the last
compacted base and the deltas since.  Every ``compact_every`` micro-batches the next
base is written, without the keys that are finished.  Bases take turns in two
folders and deltas in ``2 * compact_every``, so their number is constant, and a
folder is only replaced once no micro-batch that may be replayed reads it.

:class:`Ledger` holds what a micro-batch leaves besides: its rows, staged once (the
only execution of the micro-batch's plan), and a mark with the watermark and the
counts of late rows.  A mark is written last; a replayed micro-batch starts from the
mark and the deltas of those before it and so gives the same rows.

Nothing depends on partition counts: a query may go on with any number of them.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blotter.files import get_text, put_text, remove

COMPACT_EVERY = 16


class StateLog:
    """Counters by key; ``schema``: the key columns ``keys``, then counters (longs)."""

    def __init__(self, path: str, schema: T.StructType, keys: list[str], compact_every: int = COMPACT_EVERY):
        self.path, self.schema, self.keys, self.every = path, schema, keys, compact_every
        self.counters = [n for n in schema.names if n not in keys]

    def _base(self, generation: int) -> str:
        return f"{self.path}/base-{generation % 2}"

    def _delta(self, epoch: int) -> str:
        return f"{self.path}/delta-{epoch % (2 * self.every):03d}"

    def _read(self, spark: SparkSession, generation: int, epochs: range) -> DataFrame:
        """Keys and counters of a base and the deltas of ``epochs``."""
        folders = ([self._base(generation)] if generation else []) + [self._delta(e) for e in epochs]
        if not folders:
            return spark.createDataFrame([], self.schema)
        rows = spark.read.schema(self.schema).parquet(*folders)
        return rows.groupBy(*self.keys).agg(*[F.sum(c).alias(c) for c in self.counters])

    def held(self, spark: SparkSession, epoch: int, keep: Column | None = None) -> DataFrame:
        """The state that the micro-batches before ``epoch`` left, of keys that satisfy
        ``keep``.  The first micro-batch of a generation writes its base."""
        generation, first = epoch // self.every, epoch - epoch % self.every
        if epoch and epoch == first:
            old = self._read(spark, generation - 1, range(first - self.every, first))
            (old if keep is None else old.where(keep)).write.mode("overwrite").parquet(self._base(generation))
        state = self._read(spark, generation, range(first, epoch))
        return state if keep is None else state.where(keep)

    def append(self, increments: DataFrame, epoch: int) -> None:
        """Add ``increments`` (one row per key touched) as the delta of ``epoch``."""
        increments.select(*self.schema.names).write.mode("overwrite").parquet(self._delta(epoch))

    def after(self, spark: SparkSession, epoch: int) -> DataFrame:
        """The state with the delta of ``epoch``; :meth:`held` comes first."""
        return self._read(spark, epoch // self.every, range(epoch - epoch % self.every, epoch + 1))


@dataclass(frozen=True)
class Mark:
    """Where a micro-batch ended.  ``late_rows``: rows dropped so far because their month
    had closed; ``late_windows``: (row, sliding window) pairs dropped so far."""
    epoch: int = -1
    watermark_ms: int | None = None
    late_rows: int = 0
    late_windows: int = 0


class Ledger:
    """Staged rows and marks of a query.

    ``partition_col`` names the source partition of a row: the watermark is then the
    least, over the partitions, of the largest event time less the delay, and there
    is none before ``partitions`` of them have been seen; without it, the largest
    event time of all rows decides."""

    def __init__(self, path: str, delay_seconds: int, partition_col: str | None = None, partitions: int = 1):
        self.path, self.delay_ms = path, delay_seconds * 1000
        self.partition_col, self.partitions = partition_col, partitions

    def _mark(self, epoch: int) -> str:
        return f"{self.path}/marks/{epoch:09d}.json"

    def run_id(self, spark: SparkSession) -> str:
        """Name of the run that this checkpoint belongs to."""
        path = f"{self.path}/run"
        if get_text(spark, path) is None:
            put_text(spark, path, uuid.uuid4().hex[:12])
        return get_text(spark, path)

    def before(self, spark: SparkSession, epoch: int) -> Mark:
        """The mark that the micro-batch before ``epoch`` left."""
        if epoch == 0:
            return Mark()
        text = get_text(spark, self._mark(epoch - 1))
        if text is None:
            raise RuntimeError(f"no state of micro-batch {epoch - 1} below {self.path}")
        return Mark(**json.loads(text))

    def stage(self, rows: DataFrame, epoch: int, name: str = "input", observed: dict[str, Column] | None = None) -> tuple[DataFrame, dict]:
        """Execute ``rows`` once into a durable folder; what was ``observed`` on the way."""
        path = f"{self.path}/{name}-{epoch % 2}"
        seen = Observation(f"{name}-{uuid.uuid4().hex[:8]}")
        counted = rows.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in (observed or {}).items()])
        counted.write.mode("overwrite").parquet(path)
        return rows.sparkSession.read.schema(rows.schema).parquet(path), seen.get

    def watermark(self, rows: DataFrame, largest_ms: int | None, mark: Mark, epoch: int) -> int | None:
        """The watermark after staged ``rows`` (event_ms, and the source partition if any)."""
        if self.partition_col:
            spark = rows.sparkSession
            seen = rows.where("event_ms is not null").groupBy(F.col(self.partition_col).cast("string").alias("source")).agg(F.max("event_ms").alias("largest"))
            if epoch:
                seen = seen.unionByName(spark.read.schema(seen.schema).parquet(f"{self.path}/sources-{(epoch - 1) % 2}"))
                seen = seen.groupBy("source").agg(F.max("largest").alias("largest"))
            seen.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/sources-{epoch % 2}")   # a row per source partition
            found = spark.read.schema(seen.schema).parquet(f"{self.path}/sources-{epoch % 2}").agg(
                F.min("largest").alias("least"), F.count(F.lit(1)).alias("n")).first()
            largest_ms = found["least"] if found["n"] >= self.partitions else None
        reached = [m for m in (mark.watermark_ms, None if largest_ms is None else largest_ms - self.delay_ms) if m is not None]
        return max(reached, default=None)

    def commit(self, spark: SparkSession, epoch: int, mark: Mark) -> None:
        put_text(spark, self._mark(epoch), json.dumps(asdict(replace(mark, epoch=epoch))), replace=True)
        remove(spark, self._mark(epoch - 3))


def last_mark(spark: SparkSession, path: str) -> Mark:
    """The newest mark below a query's ledger folder."""
    from blotter.files import names
    found = names(spark, f"{path}/marks")
    return Mark(**json.loads(get_text(spark, f"{path}/marks/{found[-1]}"))) if found else Mark()

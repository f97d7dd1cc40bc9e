"""K1 / K3 / K4: the serving table, a snapshot table of Parquet folders.

One row per (district, month, primary_description).  An upsert writes the merged
rows of the districts it touches to a new version folder and then a new pointer,
one small file that names the version folder of each district.  Readers resolve the
newest pointer, so between any two steps of an upsert they see the table of
before or of after it, whole; folders are never changed once a pointer names them.

    <path>/_pointer/000000007.json        {"districts": [[district, version], ...], ...}
    <path>/_data/v=000000007/district=4/  rows of one district

The incoming rows are first reduced to the last emitted row per key and written to
a durable folder, their only execution.  A crash before the new pointer leaves the
table as it was, so a replay simply merges again.  The pointer also says which
micro-batch of which writer came last, and an older one is not applied again.
Pointers and version folders that the newest ``RETAIN`` pointers do not name are removed.
One writer at a time: of two that write the same pointer number the second fails.

Because ``month`` carries no year, a later year's month replaces the earlier
year's row, as in the reference; ``keep_year=True`` adds ``year`` to the key.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blotter.files import get_text, names, put_text, remove
from blotter.schema import COUNTERS, SERVING, SERVING_KEY
from blotter.session import scratch_path

#: Newest pointers whose folders stay, for readers that resolved one a while ago.
RETAIN = 4
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def serving_schema(keep_year: bool = False) -> T.StructType:
    if not keep_year:
        return SERVING
    return T.StructType(SERVING.fields[:2] + [T.StructField("year", T.IntegerType())]
                        + SERVING.fields[2:])


def serving_key(keep_year: bool = False) -> list[str]:
    return SERVING_KEY[:2] + ["year"] + SERVING_KEY[2:] if keep_year else list(SERVING_KEY)


@dataclass
class Snapshot:
    """What a pointer says: number, version folder of each district, last micro-batch of each writer."""
    number: int
    districts: dict[int | None, int] = field(default_factory=dict)
    writers: dict[str, int] = field(default_factory=dict)
    generation: str = ""

    def text(self) -> str:
        listed = sorted(self.districts.items(), key=lambda d: (d[0] is not None, d[0] or 0))
        return json.dumps({"districts": listed, "writers": self.writers, "generation": self.generation})


def _pointer(path: str, number: int) -> str:
    return f"{path}/_pointer/{number:09d}.json"


def snapshot(spark: SparkSession, path: str) -> Snapshot | None:
    """The newest snapshot; None where there is no table."""
    found = [n for n in names(spark, f"{path}/_pointer") if n.endswith(".json")]
    if not found:
        return None
    number = int(found[-1].removesuffix(".json"))
    held = json.loads(get_text(spark, _pointer(path, number)))
    return Snapshot(number, dict(map(tuple, held["districts"])), held["writers"], held["generation"])


def read_snapshot(spark: SparkSession, path: str, schema: T.StructType, at: Snapshot | None = None,
                  only: list | None = None) -> DataFrame:
    """Rows of a snapshot (the newest by default), or of some districts of it."""
    at = at or snapshot(spark, path)
    if at is None:
        raise ValueError(f"there is no serving table at {path}")
    folders = [f"{path}/_data/v={version:09d}/district={NULL_FOLDER if d is None else d}"
               for d, version in at.districts.items() if only is None or d in only]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{path}/_data").parquet(*folders).select(*schema.names)


def _publish(spark: SparkSession, path: str, new: Snapshot) -> None:
    put_text(spark, _pointer(path, new.number), new.text())
    numbers = [int(n.removesuffix(".json")) for n in names(spark, f"{path}/_pointer") if n.endswith(".json")]
    kept = sorted(numbers)[-RETAIN:]
    named = {new.number}
    for n in kept:
        named.update(v for _, v in json.loads(get_text(spark, _pointer(path, n)))["districts"])
    for n in set(numbers) - set(kept):
        remove(spark, _pointer(path, n))
    for folder in names(spark, f"{path}/_data"):
        if int(folder.removeprefix("v=")) not in named:
            remove(spark, f"{path}/_data/{folder}")


def create_serving_table(spark: SparkSession, path: str, keep_year: bool = False) -> str:
    """K3: create the (empty) table if absent."""
    if snapshot(spark, path) is None:
        _publish(spark, path, Snapshot(0, generation=uuid.uuid4().hex))
    return path


def truncate_serving_table(spark: SparkSession, path: str, keep_year: bool = False) -> str:
    """K4: an empty snapshot of a new generation, which no writer has written to."""
    held = snapshot(spark, path)
    _publish(spark, path, Snapshot(0 if held is None else held.number + 1, generation=uuid.uuid4().hex))
    return path


def upsert_serving(rows: DataFrame, path: str, order_col: str, keep_year: bool = False,
                   epoch_id: int | None = None, staging: str | None = None) -> None:
    """K1: upsert ``rows`` (serving columns + ``order_col`` = emission order)
    into the table at ``path``; last emission per key wins.

    ``staging``: folder of the writer's reduced rows, below the checkpoint of the query
    that writes; with ``epoch_id`` it also names the writer, and a micro-batch
    that the table already holds is not applied again.  Without one (batch
    upserts) a fresh scratch folder is used."""
    spark = rows.sparkSession
    key, schema = serving_key(keep_year), serving_schema(keep_year)
    create_serving_table(spark, path, keep_year)
    held = snapshot(spark, path)
    writer = staging if epoch_id is not None else None
    if writer is not None and held.writers.get(writer, -1) >= epoch_id:
        return
    reduced = f"{staging or scratch_path(spark, 'serving-staging')}/reduced"
    (rows.groupBy(*key).agg(F.max_by(F.struct(*COUNTERS), F.col(order_col)).alias("_v"))
     .select(*key, *[F.col("_v." + c).alias(c) for c in COUNTERS]).write.mode("overwrite").parquet(reduced))
    new = spark.read.schema(schema).parquet(reduced)
    touched = [r["district"] for r in new.select("district").distinct().collect()]   # a row per partition of the table
    if not touched:
        return
    old = read_snapshot(spark, path, schema, held, touched)
    merged = (old.join(new.select(*key), [old[k].eqNullSafe(new[k]) for k in key], "left_anti")
              .unionByName(new).select(*schema.names).hint("rebalance", F.col("district")))
    number = held.number + 1
    merged.write.mode("overwrite").partitionBy("district").parquet(f"{path}/_data/v={number:09d}")
    writers = held.writers if writer is None else held.writers | {writer: epoch_id}
    _publish(spark, path, Snapshot(number, held.districts | dict.fromkeys(touched, number), writers, held.generation))


def serving_batch_writer(path: str, order_col: str, keep_year: bool = False, staging: str | None = None):
    """``foreachBatch`` function for streaming upserts.  ``staging`` belongs below
    the query's ``checkpointLocation``."""
    def write(batch: DataFrame, epoch_id: int) -> None:
        upsert_serving(batch, path, order_col, keep_year, epoch_id, staging)
    return write

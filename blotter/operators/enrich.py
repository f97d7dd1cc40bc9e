"""Lookup enrichment = left outer equi-join with a unique code table.

The code table is broadcast only when its measured size is within
``max_rows`` rows and ``max_bytes`` bytes.  Beyond that the join is a
sort-merge join (by hint, so no threshold of the session turns it back into a
broadcast); a hot code on the incident side is then split by AQE's skew-join
handling in batch plans, or salted: all codes alike (``salt_buckets``), or only
those that a frequency sketch of the rows finds hot (:func:`hot_codes`), each over
as many pieces as its share asks for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOOKUP_COLUMNS = ["primary_description", "monitored_by_fbi"]


def broadcast_if_bounded(df: DataFrame, max_rows: int = 1_000_000,
                         max_bytes: int = 64 * 1024 * 1024) -> tuple[DataFrame, bool]:
    """Return (df or broadcast(df), broadcast?) after measuring ``df`` with one
    partial/final aggregate (a row per task is shuffled)."""
    width = sum(F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in df.columns)
    probe = df.agg(F.count("*").alias("n"), F.coalesce(F.sum(width + F.lit(16)), F.lit(0)).alias("b")).first()
    ok = probe["n"] <= max_rows and probe["b"] <= max_bytes
    return (F.broadcast(df) if ok else df), ok


#: A hot code's piece is about this share of the mean partition.
PIECE_OF_PARTITION = 0.125
#: Codes that the frequency sketch follows; the hot ones are at most so many, a bound for their broadcast.
TRACKED_CODES = 10_000


def hot_codes(incidents: DataFrame, partitions: int, code_col: str = "iucr_code", tracked: int = TRACKED_CODES) -> DataFrame:
    """(code, pieces) of the codes that hold more than half a mean partition's rows, by
    ``approx_top_k``: each task keeps a sketch of ``tracked`` codes, whatever the number of rows."""
    top = min(tracked, max(1, 2 * partitions))
    sketch = incidents.agg(F.count(F.lit(1)).alias("rows"), F.expr(f"approx_top_k(`{code_col}`, {top}, {tracked})").alias("top"))
    share = F.col("t.count") * F.lit(float(partitions)) / F.col("rows")
    return (sketch.select("rows", F.explode("top").alias("t"))
            .select(F.col("t.item").alias("code"), F.ceil(share / F.lit(PIECE_OF_PARTITION)).cast("int").alias("pieces"), share.alias("_share"))
            .where(F.col("code").isNotNull() & (F.col("_share") > 0.5)).drop("_share"))


def _salted_by_share(incidents: DataFrame, right: DataFrame, hot: DataFrame, code_col: str) -> DataFrame:
    """Shuffle join in which a hot code's rows are dealt over its pieces, and its row of the
    code table is repeated for each; ``hot`` has at most ``TRACKED_CODES`` rows."""
    hot = F.broadcast(hot.select(F.col("code").alias("_hot"), "pieces"))
    row = F.xxhash64(*[F.col(c) for c in incidents.columns])
    left = (incidents.join(hot, F.col(code_col) == F.col("_hot"), "left")
            .withColumn("_salt", F.pmod(row, F.coalesce("pieces", F.lit(1)))).drop("_hot", "pieces"))
    right = (right.join(hot, F.col("_lk_code") == F.col("_hot"), "left")
             .withColumn("_rsalt", F.explode(F.sequence(F.lit(0), F.coalesce("pieces", F.lit(1)) - 1)))
             .drop("_hot", "pieces").hint("merge"))
    return left.join(right, (F.col(code_col) == F.col("_lk_code")) & (F.col("_salt") == F.col("_rsalt")), "left")


def enrich(incidents: DataFrame, codes, code_col: str = "iucr_code",
           broadcast: bool | None = None, max_rows: int = 1_000_000,
           max_bytes: int = 64 * 1024 * 1024, salt_buckets: int = 0,
           hot: DataFrame | None = None) -> DataFrame:
    """Add ``primary_description`` ('' when unmatched) and ``monitored_by_fbi``
    (false when unmatched) to every incident (P10).

    ``codes`` is a DataFrame or a measured ``CodeTable`` (then its measured
    size decides, without another job).
    ``broadcast``: None = decide by the measured size; False = shuffle; True =
    broadcast if the size allows it (otherwise an error).
    ``salt_buckets`` > 1 salts the shuffle join (non-broadcast path only);
    ``hot`` (:func:`hot_codes`) salts it for those codes alone.
    """
    fits = None
    if hasattr(codes, "broadcastable"):
        fits = codes.broadcastable(max_rows, max_bytes)
        codes = codes.df
    right = codes.select(F.col("code").alias("_lk_code"), *LOOKUP_COLUMNS)
    if broadcast is not False:
        if fits is None:
            _, fits = broadcast_if_bounded(right, max_rows, max_bytes)
        if broadcast and not fits:
            raise ValueError(f"the code table is over {max_rows} rows or {max_bytes} bytes: too large to broadcast")
        broadcast = fits
    if broadcast:
        right = F.broadcast(right)
    if not broadcast and hot is not None:
        joined = _salted_by_share(incidents, right, hot, code_col)
        return joined.select(*[F.col(c) for c in incidents.columns],
                             F.coalesce(F.col("primary_description"), F.lit("")).alias("primary_description"),
                             F.coalesce(F.col("monitored_by_fbi"), F.lit(False)).alias("monitored_by_fbi"))
    if not broadcast and salt_buckets > 1:
        left = incidents.withColumn(
            "_salt", F.pmod(F.xxhash64(*[F.col(c) for c in incidents.columns]), F.lit(salt_buckets)))
        right = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt_buckets - 1)))).hint("merge")
        cond = (left[code_col] == right["_lk_code"]) & (left["_salt"] == right["_salt"])
        joined = left.join(right, cond, "left").drop(left["_salt"]).drop(right["_salt"])
    else:
        right = right if broadcast else right.hint("merge")
        joined = incidents.join(right, incidents[code_col] == right["_lk_code"], "left")
    return joined.select(
        *[incidents[c] for c in incidents.columns],
        F.coalesce(F.col("primary_description"), F.lit("")).alias("primary_description"),
        F.coalesce(F.col("monitored_by_fbi"), F.lit(False)).alias("monitored_by_fbi"),
    )

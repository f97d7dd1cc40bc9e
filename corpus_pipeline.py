"""The corpus pipeline: language identification, line deduplication, near-duplicate
removal, mixing to target weights, packing.

Each stage takes (spark, docs, sf_dir), ``docs`` with the columns of the
documents table, and returns a DataFrame; all but the last return those
columns.  :func:`run` writes each stage's rows below the shared checkpoint
folder and reads them back for the next.  No stage can be written in DuckDB's
SQL as a whole (the language models and the tokenizer are not), so there is no
oracle; ``tests/llm`` checks the operators that the stages call, and the rows that
each stage keeps.

In every stage: null ids and sources are values like others, rows that repeat an id are rows of
their own, extra columns stay as they are (also under names that an operator
uses), an empty table gives an empty one, and texts are taken whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.llm import langid, linededup, mixing, orderminhash, packing
from blotter.llm.common import stage
from blotter.llm.queries import tokenizer


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: drops what the models reject, so also null and empty texts and those without a
    letter; a missing label is filled in."""
    found = langid.identify(docs, langid.train(docs)).where("not rejected")
    filled = found.withColumn("lang", F.coalesce("lang", "lang_pred"))
    return filled.select(*[F.col(f"`{c}`") for c in docs.columns])


def deduplicate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: of fuzzily equal lines the first stays (ties by row); a document that loses all
    its lines goes; a null or empty text, which has none to lose, stays."""
    return linededup.deduplicated(spark, docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: one document of each near-duplicate class stays, that of the smallest id (null
    last, then by row); texts without a word, null ones too, are one class."""
    return orderminhash.deduplicated(spark, docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: the mix, a row for each time a document is taken; a document without words is
    never taken; a null source is the last source."""
    return mixing.mixed_documents(spark, docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: the pieces of the training sequences; a null or empty text is its end id alone."""
    return packing.pack(docs, *tokenizer())


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", deduplicate_lines),
    ("near_dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(spark, function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

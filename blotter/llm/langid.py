"""Operator 8: language identification by interpolated Kneser-Ney character models.

One model per language over lower-cased letters (runs of anything else are one
space), each order held as a sorted array of n-gram hashes with the discounted
probability beside it, and one of context hashes with the back-off weight.  A
text goes to the language of the lowest cross-entropy per character.  Held-back
training texts calibrate a temperature, which turns the entropies into a score,
and a rejection limit: a text whose best entropy lies beyond it is in none of
the learned languages.

Learning takes a bounded sample: at most ``sample_rows`` labelled documents a
language, chosen by hash, whole texts.  Every document is predicted from its
whole text.

Defined results: a text that is null or has no letter is ``und`` with score 0
and rejected; with nothing to learn from every text is ``und``; rows without
label are not learned from; repeated rows are predicted alike; an empty table
gives an empty result; other columns pass through, and an input column of the
name of a result column is replaced."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from blotter.llm.common import ragged_sums, ship_package, sized_slices, stage, text_slices, with_columns_replaced

ORDER = 5
SAMPLE_ROWS = 400
DISCOUNT = 0.75
KNOWN_GRAMS = 300_000
#: Characters whose grams are looked up at once (about 60 bytes of arrays for each).
PREDICT_SLICE = 1_000_000
UND = "und"
EDGE, SPACE = 1, 32
RESULT = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
          T.StructField("entropy", T.DoubleType()), T.StructField("rejected", T.BooleanType())]
_FOLD: np.ndarray | None = None


def _fold_char(c: int) -> int:
    low = chr(c).lower()
    return (ord(low) if len(low) == 1 else c) if chr(c).isalpha() else SPACE


def letter_fold() -> np.ndarray:
    """Code point -> its lower case if a letter, else a space (basic plane)."""
    global _FOLD
    if _FOLD is None:
        _FOLD = np.array([_fold_char(c) if not 0xD800 <= c < 0xE000 else SPACE for c in range(0x10000)], dtype=np.uint32)
        _FOLD[EDGE] = EDGE
    return _FOLD


def fold_texts(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Folded code points of all texts, each led by ORDER - 1 edge marks and a
    space and ended by a space; the offsets of the texts; whether each has a
    letter."""
    lead = chr(EDGE) * (ORDER - 1) + " "
    parts = [lead + t + " " for t in texts]
    raw = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    codes = letter_fold()[np.minimum(raw, 0xFFFF)]
    for c in np.unique(raw[raw > 0xFFFF]):
        codes[raw == c] = _fold_char(int(c))
    keep = np.ones(len(codes), dtype=bool)
    keep[1:] = (codes[1:] != SPACE) | (codes[:-1] != SPACE)
    before = np.concatenate([[0], np.cumsum(keep)])
    offsets = before[np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)]
    letters = np.concatenate([[0], np.cumsum(codes[keep] > SPACE)])
    return codes[keep], offsets, np.diff(letters[offsets]) > 0


def gram_hashes(codes: np.ndarray, order: int) -> np.ndarray:
    """Hash of the ``order`` code points that end at each position (the first
    order - 1 positions hold shorter ones, which are never used)."""
    out = np.full(len(codes), order, dtype=np.uint64)
    for back in range(order - 1, -1, -1):
        shifted = np.zeros(len(codes), dtype=np.uint64)
        shifted[back:] = codes[:len(codes) - back]
        out = (out ^ shifted) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


@dataclass
class Level:
    """One order of a model: sorted gram hashes with their discounted
    probability, sorted context hashes with their back-off weight."""

    grams: np.ndarray
    alpha: np.ndarray
    contexts: np.ndarray
    gamma: np.ndarray


def _find(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, default: float) -> np.ndarray:
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], default)


def _sorted(keys: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys.index.to_numpy(dtype=np.uint64))
    return keys.index.to_numpy(dtype=np.uint64)[order], keys.to_numpy(dtype=np.float64)[order]


@dataclass
class Model:
    languages: list[str] = field(default_factory=list)
    levels: list[list[Level]] = field(default_factory=list)
    alphabet: int = 1
    temperature: float = 1.0
    limit: float = float("inf")
    known: tuple[np.ndarray, np.ndarray] | None = None

    def gram_log_probs(self, hashes: np.ndarray, grams: np.ndarray) -> np.ndarray:
        """Log probabilities, grams x languages; those of grams met before are
        kept (at most KNOWN_GRAMS) in a sorted hash array."""
        order = np.argsort(hashes)
        keys = hashes[order]
        old, values = self.known or (np.zeros(0, np.uint64), np.zeros((0, len(self.languages))))
        at = np.minimum(np.searchsorted(old, keys), max(len(old) - 1, 0))
        new = old[at] != keys if len(old) else np.ones(len(keys), dtype=bool)
        out = np.empty((len(keys), len(self.languages)))
        out[~new] = values[at[~new]]
        fresh = grams[order[new]]
        out[new] = np.stack([self.log_prob(k, fresh) for k in range(len(self.languages))], axis=1)
        if len(old) + new.sum() > KNOWN_GRAMS:
            self.known = (keys, out.copy())
        elif new.any():
            merged = np.concatenate([old, keys[new]])
            by = np.argsort(merged, kind="stable")
            self.known = (merged[by], np.concatenate([values, out[new]])[by])
        back = np.empty_like(out)
        back[order] = out
        return back

    def log_prob(self, language: int, grams: np.ndarray) -> np.ndarray:
        """Natural log probability of the last code point of each row of ``grams``
        (rows of ORDER code points) after the others."""
        p = np.full(len(grams), 1.0 / self.alphabet)
        for n, level in enumerate(self.levels[language], 1):
            key, context = row_hashes(grams[:, ORDER - n:]), row_hashes(grams[:, ORDER - n:-1])
            p = _find(level.grams, level.alpha, key, 0.0) + _find(level.contexts, level.gamma, context, 1.0) * p
        return np.log(p)

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy per character, texts x languages, and whether a text has
        a letter.  Each distinct gram of the batch is looked up once."""
        codes, offsets, letters = fold_texts(texts)
        hashes = gram_hashes(codes, ORDER)
        inverse, distinct = pd.factorize(hashes)
        first = np.zeros(len(distinct), dtype=np.int64)
        first[inverse[::-1]] = np.arange(len(inverse))[::-1]
        first = np.maximum(first, ORDER - 1)
        grams = np.stack([codes[first - back] for back in range(ORDER - 1, -1, -1)], axis=1)
        coded = codes != EDGE
        count = np.maximum(ragged_sums(coded.astype(np.float64), offsets), 1)
        each = self.gram_log_probs(distinct, grams)
        out = np.stack([-ragged_sums(np.where(coded, each[:, k][inverse], 0.0), offsets) / count
                        for k in range(len(self.languages))], axis=1)
        return out, letters


def row_hashes(grams: np.ndarray) -> np.ndarray:
    """As :func:`gram_hashes` for a matrix with one gram a row."""
    out = np.full(len(grams), grams.shape[1], dtype=np.uint64)
    for column in grams.T:
        out = (out ^ column.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def kneser_ney(grams: np.ndarray, counts: np.ndarray) -> list[Level]:
    """Levels 1..ORDER from the counts of the longest grams: raw counts at the
    top, below it the number of distinct characters that come before."""
    levels = []
    for _ in range(ORDER):
        keys, contexts = row_hashes(grams), row_hashes(grams[:, :-1])
        table = pd.DataFrame({"k": keys, "c": contexts, "n": counts.astype(np.float64)}).groupby(["k", "c"], as_index=False)["n"].sum()
        total = table.groupby("c")["n"].transform("sum")
        alpha = pd.Series(((table["n"] - DISCOUNT).clip(lower=0) / total).to_numpy(), index=table["k"].to_numpy())
        gamma = table.groupby("c").agg(n=("n", "sum"), kinds=("k", "size"))
        gamma = DISCOUNT * gamma["kinds"] / gamma["n"]
        levels.append(Level(*_sorted(alpha), *_sorted(gamma)))
        if grams.shape[1] > 1:
            shorter = np.unique(grams, axis=0)[:, 1:]
            grams, counts = np.unique(shorter, axis=0, return_counts=True)
    return levels[::-1]


def fit(gram_counts: pd.DataFrame) -> Model:
    """Models from rows (lang, gram, n); ``gram`` is a string of ORDER characters."""
    if gram_counts.empty:
        return Model()
    model = Model(languages=sorted(gram_counts["lang"].unique()))
    seen: set[int] = set()
    for name in model.languages:
        part = gram_counts[gram_counts["lang"] == name]
        grams = np.frombuffer("".join(part["gram"]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).reshape(-1, ORDER)
        model.levels.append(kneser_ney(grams, part["n"].to_numpy()))
        seen |= set(np.unique(grams).tolist())
    model.alphabet = len(seen) + 1
    return model


def calibrate(model: Model, entropies: np.ndarray, labels: np.ndarray) -> Model:
    """Temperature of least log loss on held-back texts; the rejection limit lies
    halfway between their 99th percentile under their own language and the
    entropy of a uniform draw from the alphabet."""
    if not len(labels) or not model.languages:
        return model

    def loss(t: float) -> float:
        z = -t * entropies
        z -= z.max(axis=1, keepdims=True)
        return float(np.mean(np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(labels)), labels]))

    model.temperature = min((2.0 ** k for k in range(-2, 7)), key=loss)
    own = np.quantile(entropies[np.arange(len(labels)), labels], 0.99)
    model.limit = float(own + max(0.5, 0.5 * (np.log(model.alphabet) - own)))
    return model


def sample_labelled(docs: DataFrame, sample_rows: int) -> DataFrame:
    """At most ``sample_rows`` labelled rows (lang, text, held) a language, those of
    the smallest hashes of the row (its place included, so that rows without an id, or equal
    ones, are drawn one by one).  A hash limit first cuts each language to about twice
    that number where the rows are read, so only a bounded number of texts is
    moved and ranked.  The counts by language come to the driver, as the model
    with its one entry a language does."""
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"),
        F.xxhash64(F.monotonically_increasing_id(), "doc_id", "text").alias("h"))
    counts = rows.groupBy("lang").agg(F.count("*").alias("rows")).collect()
    counts = F.broadcast(docs.sparkSession.createDataFrame([(r["lang"], r["rows"]) for r in counts], "lang string, rows long"))
    unit = (F.col("h") / F.lit(2.0 ** 64)) + 0.5
    near = rows.join(counts, "lang").where(unit < 2.0 * sample_rows / F.col("rows") + 0.0)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h", "text"))
    return near.withColumn("r", rank).where(F.col("r") <= sample_rows).select(
        "lang", "text", (F.col("r") % 5 == 0).alias("held"))


def train(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit and calibrate on a bounded sample of ``docs`` (doc_id, text, lang); four
    of five sampled texts are learned from, the fifth calibrates."""
    spark = docs.sparkSession
    ship_package(spark)
    sample = stage(spark, sample_labelled(docs, sample_rows), "langid-sample")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            langs, texts = np.array(b.column(0).to_pylist(), dtype=object), b.column(1).to_pylist()
            for lo, hi in text_slices(texts):
                for name in set(langs[lo:hi]):
                    codes, offsets, _ = fold_texts([t for t, x in zip(texts[lo:hi], langs[lo:hi], strict=True) if x == name])
                    at = np.flatnonzero(codes != EDGE)
                    grams, n = np.unique(np.stack([codes[at - back] for back in range(ORDER - 1, -1, -1)], axis=1), axis=0, return_counts=True)
                    text = [g.astype("<u4").tobytes().decode("utf-32-le", "replace") for g in grams]
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(n)), pa.array(text), pa.array(n, pa.int64())], ["lang", "gram", "n"])

    learned = sample.where("not held").select("lang", "text").mapInArrow(count, "lang string, gram string, n long")
    model = fit(learned.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas())
    if not model.languages:
        return model
    shared, names = spark.sparkContext.broadcast(model), model.languages

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            langs, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            for lo, hi in text_slices(texts):
                entropies, letters = shared.value.entropies(texts[lo:hi])
                rows = [(names.index(x), e.tolist()) for x, e, ok in zip(langs[lo:hi], entropies, letters, strict=True) if ok and x in names]
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.list_(pa.float64()))], ["label", "e"])

    held = sample.where("held").select("lang", "text").mapInArrow(measure, "label int, e array<double>").collect()
    return calibrate(model, np.array([r["e"] for r in held]).reshape(len(held), len(names)), np.array([r["label"] for r in held], dtype=np.int64))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` plus lang_pred, score (calibrated probability of the prediction),
    entropy (nats per character under it) and rejected."""
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)
    schema = with_columns_replaced(docs.schema, RESULT)
    kept = schema.names[:-len(RESULT)]
    text_at = kept.index("text") if "text" in kept and docs.schema["text"].dataType == T.StringType() else len(kept)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            sizes = pc.fill_null(pc.utf8_length(b.column(text_at)), 0).to_pylist()
            for start, end in sized_slices(sizes, PREDICT_SLICE):
                texts, lo, hi = [t or "" for t in b.column(text_at).slice(start, end - start).to_pylist()], 0, end - start
                pred, score, entropy, out = [UND] * (hi - lo), np.zeros(hi - lo), np.full(hi - lo, np.nan), np.ones(hi - lo, dtype=bool)
                if m.languages:
                    e, letters = m.entropies(texts[lo:hi])
                    best = e.argmin(axis=1)
                    weights = np.exp(-m.temperature * (e - e.min(axis=1, keepdims=True)))
                    score = np.where(letters, 1.0 / weights.sum(axis=1), 0.0)
                    entropy = np.where(letters, e.min(axis=1), np.nan)
                    out = ~letters | (entropy > m.limit)
                    pred = [m.languages[k] if ok else UND for k, ok in zip(best, letters, strict=True)]
                columns = [b.column(i).slice(start, end - start) for i in range(len(kept))]
                columns += [pa.array(pred, pa.string()), pa.array(score), pa.array(entropy, from_pandas=True), pa.array(out)]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    more = [] if text_at < len(kept) else [F.col("text").cast("string").alias("__text")]
    return docs.select(*[F.col(f"`{c}`") for c in kept], *more).mapInArrow(predict, schema)


def held_out(doc_id: Column, modulus: int = 3, remainder: int = 1) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus == remainder

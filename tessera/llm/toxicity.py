"""Toxicity scores from a counterfactually regularised linear classifier.

A text's features are its different words and their beginnings of 3 to 6
characters, hashed into ``BINS`` bins.  The features that speak for
label 1 beyond chance (chi-square over the training rows, one partial aggregate) feed a logistic
regression.  Of every labelled text a sentence, one with identity terms if there is any, is copied with each of its terms
swapped for each other of the same group; a sentence without any gets one inserted.  The squared
difference of the scores of a sentence and its copies is added to the loss:
mentioning a neutral group, whichever, must not move the score.  Only features that speak for label 1 are admitted, so
that a long harmless text around a toxic sentence does not outweigh it.

The classifier is fitted on at most about ``TRAIN_ROWS`` labelled rows, picked by a
hash of the id; every text is scored whole.

Defined results: null and empty texts get the model's base score; without both
labels in the training rows every text scores the share of label 1; labels of a
repeated id count once, the highest; texts of any length are scored whole; new columns replace others of their names,
all other columns pass through.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.textkit import arrow_schema, held_out, load, map_texts
from tessera.session import discard, materialize

BINS = 1 << 22
FEATURES = 4096
#: Features below this chi-square are chance among so many candidates.
CHI_SQUARE = 30.0
TRAIN_ROWS = 20_000
THRESHOLD = 0.3
PENALTY = 20.0
#: Neutral group mentions; within a group any term can stand for any other.
IDENTITY_TERMS = (
    ("women", "men", "people", "girls", "boys"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "arab"),
    ("gay", "lesbian", "straight", "bisexual", "transgender"),
    ("immigrants", "refugees", "natives", "foreigners"),
    ("disabled", "deaf", "blind", "elderly", "young"),
    ("femmes", "hommes", "musulmans", "chrétiens", "juifs", "immigrés"),
    ("frauen", "männer", "muslime", "christen", "juden", "ausländer"),
    ("mujeres", "hombres", "musulmanes", "cristianos", "judíos", "inmigrantes"),
)
_WORD = re.compile(r"[^\W\d_]+")
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")


def words_of(text: str | None) -> set[str]:
    return set(_WORD.findall(text.lower())) if text else set()


def word_bins(word: str) -> list[int]:
    parts = [f"={word}", *(f"^{word[:n]}" for n in range(3, 7) if len(word) >= n)]
    return [xxhash.xxh32_intdigest(p) % BINS for p in parts]


def text_bins(text: str | None) -> tuple[list[int], list[int]]:
    """Bins and how many different words fall into each."""
    count: dict[int, int] = {}
    for w in words_of(text):
        for b in word_bins(w):
            count[b] = count.get(b, 0) + 1
    return list(count), list(count.values())


def swaps(sentence: str, groups: tuple = IDENTITY_TERMS) -> list[str]:
    """A sentence in lower case, and its copies with one identity term swapped; a sentence without any gets a term inserted in turn."""
    low = sentence.lower()
    found = words_of(low)
    out = [low]
    for group in groups:
        for term in (t for t in group if t in found):
            out += [re.sub(rf"\b{re.escape(term)}\b", other, low) for other in group if other != term]
    if len(out) == 1:
        out += [f"{low} {term}" for term in groups[zlib.crc32(low.encode()) % len(groups)]]
    return out


def pairs_of(text: str | None, groups: tuple = IDENTITY_TERMS) -> list[tuple[list[int], list[int]]]:
    """How the features of one sentence of a text change with each of its swaps."""
    pool = [s for s in _SENTENCE.split(text or "") if s.strip()]
    if not pool:
        return []
    terms = {t for g in groups for t in g}
    telling = [s for s in pool if terms & words_of(s)] if terms & words_of(text) else []
    pool = telling or pool
    first, *others = (dict(zip(*text_bins(s), strict=True)) for s in swaps(pool[zlib.crc32((text or "").encode()) % len(pool)], groups))
    out = []
    for other in others:
        change = {b: other.get(b, 0) - first.get(b, 0) for b in sorted({*first, *other}) if other.get(b, 0) != first.get(b, 0)}
        out.append((list(change), list(change.values())))
    return out


class Linear:
    """Bins, their weights and the base score."""

    def __init__(self, bins: np.ndarray, weights: np.ndarray, base: float):
        self.weights = dict(zip(bins.tolist(), weights.tolist(), strict=True))
        self.base = base
        self.words: dict[str, float] = {}

    def score(self, text: str | None) -> float:
        total, known, weights = self.base, self.words, self.weights
        if len(known) > 1 << 16:
            known.clear()
        for w in sorted(words_of(text)):  # a fixed order of summation: reruns agree to the last bit
            v = known.get(w)
            if v is None:
                v = known[w] = sum(weights.get(b, 0.0) for b in word_bins(w))
            if v:
                total += v
        return float(1.0 / (1.0 + np.exp(-np.clip(total, -40, 40))))


class _Sparse:
    """Rows of (feature, value) pairs, and how much each row weighs."""

    def __init__(self, rows: Iterable[tuple[list[int], list[float]]], width: int, weight: Iterable[float] | None = None):
        rows = list(rows)
        self.n, self.width = len(rows), width
        self.row = np.repeat(np.arange(self.n), [len(i) for i, _ in rows])
        self.col = np.array([x for i, _ in rows for x in i], np.int64)
        self.val = np.array([x for _, v in rows for x in v], np.float64)
        self.weight = np.ones(self.n) if weight is None else np.asarray(list(weight), np.float64)

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=self.val * w[self.col], minlength=self.n)

    def back(self, g: np.ndarray) -> np.ndarray:
        return np.bincount(self.col, weights=self.val * g[self.row], minlength=self.width)


def fit_weights(x: _Sparse, y: np.ndarray, pairs: _Sparse, penalty: float = PENALTY, l2: float = 2e-5, steps: int = 500, rate: float = 0.05) -> tuple[np.ndarray, float]:
    """Logistic loss + l2 + penalty * mean squared score change over the pairs, by full-batch Adam."""
    w = np.zeros(x.width + 1)
    m, v = np.zeros_like(w), np.zeros_like(w)
    w[-1] = np.log((y.sum() + 1) / (len(y) - y.sum() + 1))
    share = pairs.weight / max(1.0, pairs.weight.sum())
    for t in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(x.dot(w[:-1]) + w[-1], -40, 40)))
        g = np.append(x.back((p - y) / len(y)) + l2 * w[:-1], (p - y).mean())
        if pairs.n:
            g[:-1] += 2 * penalty * pairs.back(pairs.dot(w[:-1]) * share)
        m = 0.9 * m + 0.1 * g
        v = 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w[:-1], float(w[-1])


PICKS = 1 << 30


def picked(id_text: str) -> F.Column:
    """A number below PICKS that a hash of the id gives."""
    return F.pmod(F.xxhash64(F.col(id_text).cast("string"), F.lit("toxicity")), F.lit(PICKS))


def train(rows: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "toxic", groups: tuple = IDENTITY_TERMS, penalty: float = PENALTY, bound: int = TRAIN_ROWS, features: int = FEATURES) -> Linear:
    """Fit on a bounded sample of labelled rows ``(id, text, label)``."""
    use = rows.where(F.col(label).isNotNull()).select(F.col(id_col).cast("string").alias("i"), F.col(text).alias("text"), (F.col(label) > 0).cast("int").alias("y"))
    sample = use.withColumn("pick", picked("i"))
    total = use.count()
    if total > 1.1 * bound:
        sample = sample.where(F.col("pick") < int(bound / total * PICKS))
    ints = T.ArrayType(T.IntegerType())
    changes = T.ArrayType(T.StructType([T.StructField("bins", ints), T.StructField("change", ints)]))

    def make() -> Callable:
        def run(texts: list[str | None]) -> tuple:
            found = [text_bins(t) for t in texts]
            return [b for b, _ in found], [c for _, c in found], [[{"bins": b, "change": c} for b, c in pairs_of(t, groups)] for t in texts]

        return run

    # Features are computed once; the counts and the fit read the written table.
    kept: list[str] = []
    sample = materialize(map_texts(sample, "text", [("bins", ints), ("counts", ints), ("pairs", changes)], make, keep_text=False), "labelled", kept)
    n, pos = sample.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0))).first()
    if pos in (0, n):
        discard(rows.sparkSession, kept)
        share = (pos + 1) / (n + 2)
        return Linear(np.zeros(0, np.int64), np.zeros(0), float(np.log(share / (1 - share))))
    seen = sample.select("y", F.explode("bins").alias("bin")).groupBy("bin").agg(F.count("*").alias("d"), F.sum("y").alias("p")).where("d >= 3")
    # Chi-square of the feature against the label, from the four counts; only features that speak for label 1 well beyond chance.
    lead = F.col("p") * float(n) - F.col("d") * float(pos)
    chi = float(n) * lead * lead / (F.col("d") * (float(n) - F.col("d")) * float(pos) * float(n - pos))
    seen = seen.where(F.col("d") < n).withColumn("lead", lead).withColumn("chi", chi)
    best = seen.where((F.col("lead") > 0) & (F.col("chi") >= CHI_SQUARE)).orderBy(F.desc("chi"), "bin").limit(features).select("bin").collect()
    identity = {b for g in groups for t in g for b in word_bins(t)}
    bins = sorted({r["bin"] for r in best} | identity)
    model = _fit(sample, {b: i for i, b in enumerate(bins)}, penalty)
    discard(rows.sparkSession, kept)
    return model


def _fit(sample: DataFrame, place: dict[int, int], penalty: float) -> Linear:
    shared = sample.sparkSession.sparkContext.broadcast(place)
    ints = T.ArrayType(T.IntegerType())
    schema = T.StructType([T.StructField("pick", T.LongType()), T.StructField("i", T.StringType()), T.StructField("y", T.IntegerType()), T.StructField("idx", ints), T.StructField("val", ints)])
    target = arrow_schema(schema)

    def narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = shared.value
        for batch in batches:
            rows = [[(at[b], c) for b, c in zip(bins, counts, strict=True) if b in at] for bins, counts in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True)]
            new = [pa.array([[x[k] for x in r] for r in rows], type=target.field(3 + k).type) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *new], schema=target)

    rows = sample.select("pick", "i", "y", "bins", "counts").mapInArrow(narrow, schema).toPandas().sort_values(["pick", "i"])
    # Equal changes are one row that weighs as many; all their bins are those of identity terms, which are all in.
    pairs = sample.select(F.explode("pairs").alias("p")).groupBy("p.bins", "p.change").count().collect()
    pairs = sorted((r["bins"], r["change"], r["count"]) for r in pairs)
    shared.unpersist()
    x = _Sparse(zip(rows["idx"], rows["val"], strict=True), len(place))
    swapped = _Sparse([([place[b] for b in bins if b in place], [c for b, c in zip(bins, change, strict=True) if b in place]) for bins, change, _ in pairs], len(place), [n for _, _, n in pairs])
    weights, base = fit_weights(x, rows["y"].to_numpy(np.float64), swapped, penalty)
    return Linear(np.array(sorted(place, key=place.__getitem__), np.int64), weights, base)


def score(docs: DataFrame, model: Linear, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Replace every whole text by its ``score`` and whether that is ``predicted`` toxic."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make() -> Callable:
        m = shared.value
        return lambda texts: ([m.score(t) for t in texts],)

    return map_texts(docs, text, [("score", T.DoubleType())], make, keep_text=False).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    labels = load(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    labels = labels.where(~held_out() & F.col("toxic").isNotNull())
    # The bound is applied to both sides before they are joined, so no other text is moved.
    few = F.coalesce(picked("doc_id") < int(min(1.0, TRAIN_ROWS / max(1, labels.count())) * PICKS), F.lit(False))
    model = train(docs.where(~held_out() & few).join(labels.where(few), "doc_id"))
    return score(docs.select("doc_id", held_out().alias("held_out"), "text"), model)


QUERIES = {"op9_toxicity": op9_toxicity}

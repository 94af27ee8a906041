"""Exact vector search as column expressions; the top-k is Spark's TakeOrderedAndProject."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dot(a: Column | str, b: Column | str) -> Column:
    """Dot product in double precision."""
    both = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(both, F.lit(0.0), lambda acc, x: acc + x)


def cosine(a: Column | str, b: Column | str) -> Column:
    """Cosine similarity; null when either vector is null or has no length."""
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norm > 0, dot(a, b) / norm)


def probe_vector(embeddings: DataFrame, id_col: str, key: int, vector: str = "embedding") -> list[float]:
    """The stored vector of one id, as plain floats (a single row)."""
    row = embeddings.where(F.col(id_col) == key).select(vector).first()
    return [] if row is None or row[0] is None else [float(x) for x in row[0]]


def vector_literal(values: list[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values]) if values else F.array().cast("array<double>")


def top_k(embeddings: DataFrame, probe: list[float], k: int, id_col: str = "id", vector: str = "embedding") -> DataFrame:
    """The k rows most similar to the probe, ties by id; rows without a defined similarity are left out."""
    scored = embeddings.withColumn("score", cosine(vector, vector_literal(probe))).where("score is not null").drop(vector)
    return scored.orderBy(F.desc("score"), F.col(id_col)).limit(k)


def hybrid_search(embeddings: DataFrame, probe: list[float], properties: DataFrame, predicate: Column, k: int = 20, limit: int = 10) -> DataFrame:
    """Top k by similarity, then the property predicate, then the best ``limit`` rows.

    The predicate is applied after the inner limit, so fewer than ``limit`` rows may come back.
    The k winners are the broadcast side: their number is the bound.
    """
    winners = top_k(embeddings, probe, k)
    return F.broadcast(winners).join(properties, "id").where(predicate).orderBy(F.desc("score"), F.col("id")).limit(limit)

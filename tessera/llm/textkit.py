"""Helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Word bytes of the contracts' `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` after A-Z are lowered: digits, a-z and all non-ASCII.
WORD_TABLE = bytes(b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def alnum_words(text: str | None) -> list[bytes]:
    """Words of digits, a-z and non-ASCII characters, A-Z lowered; null has none."""
    return text.encode().lower().translate(WORD_TABLE).split() if text else []


def space_words(text: str | None) -> list[bytes]:
    """Words between the blanks 0x20 and 0x09-0x0D, A-Z lowered; null has none."""
    return text.encode().lower().split() if text else []


def held_out(column: str = "doc_id") -> F.Column:
    """True for rows that no model may learn from: crc32 of the id's decimal text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


#: Rows of an Arrow batch at most: texts may be long, and a batch exists in the JVM and in Python, on the way in and out.
BATCH_ROWS = 1024


def tuned(f: Callable) -> Callable:
    """A query or stage whose session sends small Arrow batches.

    Batches are made when a result is read, so this is the application's setting and holds for the session; operators
    leave the session as it is and work with batches of any size.
    """

    @wraps(f)
    def run(spark: SparkSession, *rest: object) -> DataFrame:
        key = "spark.sql.execution.arrow.maxRecordsPerBatch"
        now = int(spark.conf.get(key, "10000"))
        if now <= 0 or now > BATCH_ROWS:
            spark.conf.set(key, str(BATCH_ROWS))
        return f(spark, *rest)

    return run


def without_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """``df`` without the columns that new ones of these names replace, as ``withColumn`` does."""
    gone = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in gone])


def map_texts(
    df: DataFrame,
    text: str,
    new: list[tuple[str, T.DataType]],
    make: Callable[[], Callable[[list[str | None]], Iterable[list]]],
    rows: int = 256,
    keep_text: bool = True,
) -> DataFrame:
    """Append columns that a Python function computes from a text column.

    ``make()`` runs once per task and returns ``f(texts) -> columns``.  Batches are
    re-sliced to ``rows`` so that memory follows a few hundred texts, not a whole
    Arrow batch.  All other columns pass through untouched as Arrow buffers; the text
    itself does unless ``keep_text`` is off.  A new column replaces one of its name.
    """
    clash = {n.lower() for n, _ in new}
    kept = [i for i, c in enumerate(df.columns) if (keep_text or c != text) and c.lower() not in clash]
    schema = T.StructType([df.schema.fields[i] for i in kept] + [T.StructField(n, t, True) for n, t in new])
    where = df.columns.index(text)
    kinds = [arrow_schema(T.StructType([T.StructField(n, t)])).field(0).type for n, t in new]
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                out = f(part.column(where).to_pylist())
                extra = [pa.array(c, type=k) for c, k in zip(out, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in kept), *extra], names=names)

    return df.mapInArrow(run, schema)

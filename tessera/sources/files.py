"""CSV ledgers, JSONL, and sinks."""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.schemas import LEDGER
from tessera.session import materialize


def read_ledger(spark: SparkSession, path: str, schema: str = LEDGER) -> DataFrame:
    return spark.read.csv(path, header=True, schema=schema)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, line, value``: lines of text files, numbered from 1 within each file.

    Files are read in splits; a line's number is its place in the split and the sum of the file's splits before it.
    """
    rows = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), "value")
    rows = materialize(rows, "lines")
    counts = rows.groupBy("file", "block").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    before = F.coalesce(F.sum("n").over(W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    counts = materialize(counts.select("file", "block", "first", before.alias("before")), "splits")
    # Ids run on within a task, so those of a split are consecutive.
    return rows.join(counts, ["file", "block"]).select("file", (F.col("before") + F.col("at") - F.col("first") + 1).cast("int").alias("line"), "value")


def read_jsonl(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema else spark.read).json(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    df.select(F.to_json(F.struct(*df.columns)).alias("value")).write.mode("overwrite").text(path)


def write_documents(df: DataFrame, path: str, rel_path: str = "rel_path", text: str = "text") -> None:
    """Documents with their relative path as a column, spread over the folders of the source tree."""
    folder = F.regexp_replace(F.regexp_extract(rel_path, r"^(.*)/[^/]*$", 1), "^$", ".")
    df.withColumn("folder", folder).select("folder", rel_path, text).write.mode("overwrite").partitionBy("folder").parquet(path)


def write_mirror(df: DataFrame, path: str, rel_path: str = "rel_path", text: str = "text") -> int:
    """One file per document at ``path/rel_path``, as the source tree had them; returns how many were written.

    ``path`` is a URI or absolute path that all executors reach.  A file is written beside its place and then moved
    there, so lost and repeated tasks leave whole files only.  Relative paths must be distinct and stay below
    ``path``; a null text is an empty file.  Where readers are Spark jobs, ``write_documents`` scales better.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow.fs import FileSystem

        system, root = FileSystem.from_uri(path)
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                place = posixpath.normpath(name)
                if place.startswith(("/", "..")) or place == ".":
                    raise ValueError(f"no path below the folder: {name}")
                target = f"{root}/{place}"
                system.create_dir(posixpath.dirname(target), recursive=True)
                beside = f"{posixpath.dirname(target)}/.{uuid.uuid4().hex}"
                with system.open_output_stream(beside) as out:
                    out.write((data or "").encode())
                system.move(beside, target)
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    return df.select(rel_path, text).mapInArrow(write, "n long").agg({"n": "sum"}).first()[0] or 0


def write_vocabulary(words: DataFrame, path: str, column: str) -> None:
    """Distinct strings (see ``units.vocabulary``) as Parquet and, in order, as JSON lines."""
    words.select(column).write.mode("overwrite").parquet(f"{path}/parquet")
    words.sparkSession.read.schema(words.select(column).schema).parquet(f"{path}/parquet").orderBy(column).write.mode("overwrite").json(f"{path}/json")


def write_report(df: DataFrame, path: str, column: str) -> None:
    """A side report: distinct values in order."""
    df.select(column).distinct().orderBy(column).coalesce(1).write.mode("overwrite").json(path)

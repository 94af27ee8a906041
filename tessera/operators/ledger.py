"""Work ledgers, incremental work lists, harvested records and enrichment joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import file_to_doi, strip

PENDING, DONE, FAILED, DELAYED = 0, 1, 2, 3


def status(c: Column | str) -> Column:
    """A status as a whole number; what is no number is 0."""
    return F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string").try_cast("double").cast("int"), F.lit(0))


def new_ledger(found: DataFrame) -> DataFrame:
    """A ledger of deduplicated search results: nothing downloaded, nothing processed."""
    return found.where("doi is not null").groupBy("doi").agg(F.min("cover_date").alias("cover_date")).select("doi", F.lit(PENDING).alias("downloaded"), F.lit(PENDING).alias("llm_processed"), "cover_date")


def to_download(ledger: DataFrame) -> DataFrame:
    """Rows never tried; failed and throttled ones are not retried."""
    return ledger.where((status("downloaded") == PENDING) & F.col("doi").isNotNull())


def last_row(ledger: DataFrame, order: str, key: str = "doi") -> DataFrame:
    """The last row of each key; an aggregate, so a key with very many rows is folded before the shuffle."""
    best = ledger.groupBy(F.col(key).alias("__k")).agg(F.max_by(F.struct(*ledger.columns), F.struct(order)).alias("__s"))
    return best.select("__s.*")


def to_process(files: DataFrame, ledger: DataFrame, order: str, name: str = "file_name") -> DataFrame:
    """Files whose DOI, read from the file name, is in the ledger and not done; of repeated ledger rows the last counts."""
    latest = last_row(ledger, order).select("doi", "llm_processed")
    return files.withColumn("doi", file_to_doi(name)).join(latest, "doi").where(~F.col("llm_processed").eqNullSafe(DONE))


def start_from(files: DataFrame, first: str, name: str = "file_name") -> DataFrame:
    """Resume: files in name order from the first one on whose name ends with ``first``; none where no name does."""
    start = files.where(F.col(name).endswith(first)).agg(F.min(name)).first()[0]
    return files.where(F.col(name) >= F.lit(start))


def first_batch(rows: DataFrame, key: str, most: int = 200) -> DataFrame:
    """The first rows in key order, as sent in one batch."""
    return rows.orderBy(key).limit(most)


def append_status(ledger: DataFrame, log: DataFrame, column: str) -> DataFrame:
    """Apply a log ``doi, status, ts`` to a ledger: the latest status of each DOI wins."""
    latest = log.groupBy("doi").agg(F.max_by("status", "ts").alias("__s"))
    return ledger.join(latest, "doi", "left").withColumn(column, F.coalesce("__s", column)).drop("__s")


def status_counts(ledger: DataFrame, column: str) -> DataFrame:
    s = status(column)
    return ledger.agg(F.count("*").alias("total"), F.count_if(s == DONE).alias("done"), F.count_if(s == FAILED).alias("failed"), F.count_if(s == DELAYED).alias("delayed"), F.count_if(s == PENDING).alias("pending"))


def keep_first(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """The first row of each key in a stated order; an aggregate, as in ``last_row``."""
    best = rows.groupBy(F.col(key).alias("__k")).agg(F.min_by(F.struct(*rows.columns), F.struct(*order)).alias("__s"))
    return best.select("__s.*")


def enrich(left: DataFrame, right: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """Left join on lower-cased, stripped keys; null values are dropped first, of repeated keys the last counts."""
    k = F.lower(strip(key))
    table = right.where(F.col(key).isNotNull() & F.col(value).isNotNull()).withColumn("__k", k)
    table = last_row(table, order, "__k").select("__k", F.col(value).alias("__v"))
    out = left.withColumn("__key", k).join(table, F.col("__key") == F.col("__k"), "left")
    return out.drop("__key", "__k").withColumnRenamed("__v", value)


def search_records(pages: DataFrame, entries: str = "entries") -> DataFrame:
    """Flatten pages of search results (JSON objects with prefixed names) into the seven search columns."""
    v = F.explode(F.from_json(entries, "array<variant>"))
    get = lambda path, kind="string": F.try_variant_get(F.col("e"), path, kind)
    rows = pages.select(v.alias("e"))
    return rows.select(
        get("$.eid").alias("eid"), get("$['prism:doi']").alias("doi"), get("$['dc:title']").alias("title"), get("$['prism:publicationName']").alias("publication_name"),
        get("$['prism:coverDate']").alias("cover_date"), F.coalesce(get("$['citedby-count']").try_cast("long"), F.lit(0)).alias("citedby_count"), F.coalesce(get("$.openaccess"), F.lit("0")).alias("open_access"),
    )


def authors(names: Column, most: int = 10) -> Column:
    """struct(authors, author_count): the first ten names joined, all of them counted."""
    real = F.filter(names, lambda x: x.isNotNull() & (x != ""))
    return F.struct(F.array_join(F.slice(real, 1, most), "; ").alias("authors"), F.size(real).alias("author_count"))


def abstract(record: Column) -> Column:
    """The description of a VARIANT record, or its abstract where it has no such field; a description of null is null."""
    described = F.try_variant_get(record, "$['dc:description']", "variant")
    return F.when(described.isNotNull(), F.try_variant_get(record, "$['dc:description']", "string")).otherwise(F.try_variant_get(record, "$.abstract", "string"))


def reply_join(requested: DataFrame, replies: DataFrame) -> DataFrame:
    """``batch, name`` with ``canonical_name, electrolyte, error``: a failed or missing reply falls back to the name itself."""
    rows = requested.join(replies, ["batch", "name"], "left")
    return rows.select("batch", "name", F.coalesce("canonical_name", "name").alias("canonical_name"), F.coalesce("electrolyte", F.lit(False)).alias("electrolyte"), F.col("error"), F.col("canonical_name").isNull().alias("missing"))


def missing_names(requested: DataFrame, replies: DataFrame) -> DataFrame:
    return requested.join(replies, ["batch", "name"], "left_anti").select("batch", "name")


def apply_names(rows: DataFrame, mapping: DataFrame, name: str = "name") -> DataFrame:
    """Write canonical names back: the old one stays as ``original_name``; names without an entry stay."""
    m = mapping.select(F.col("name").alias("__n"), F.col("canonical_name").alias("__c"), F.col("electrolyte").alias("__e"))
    out = rows.drop("original_name", "electrolyte").join(m, F.col(name) == F.col("__n"), "left")
    return out.withColumn("original_name", F.col(name)).withColumn(name, F.coalesce("__c", name)).withColumn("electrolyte", F.coalesce("__e", F.lit(False))).drop("__n", "__c", "__e")

"""Licence scans by canonical digest, with DataFrame expressions alone.

A text is brought to a canonical form: lower case, copyright statements dropped,
punctuation, blanks and line ends folded to one blank, equivalent spellings and phrases replaced.  The
digest of a whole text is hash-joined to the digests of known licence texts, a table that
``known_files`` reads from a folder of any number of texts; the built-in one holds each text alone and under its usual titles.  The
digests of single lines are looked up among known notices.

A copyright statement is a line that opens with copyright and a sign, year or placeholder, or with the sign
and a year; it ends with its line, or where a licence begins on the same one.

Defined results: a null text has a null digest; a text without words has the
digest of the empty string and never matches; if known texts share a digest, the
smallest id is reported; repeated rows each get a row; texts of any length are digested whole; new columns replace others
of their names, all other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.license_texts import LICENSES, NOTICES
from tessera.llm.textkit import load

#: Known tables of more rows than this are joined without a broadcast.
KNOWN_ROWS = 100_000

# Spellings that count as equal, after the public licence-matching guidelines of SPDX.
SPELLINGS = {
    "acknowledgment": "acknowledgement",
    "analogue": "analog",
    "analyse": "analyze",
    "artefact": "artifact",
    "authorisation": "authorization",
    "authorised": "authorized",
    "calibre": "caliber",
    "cancelled": "canceled",
    "capitalisations": "capitalizations",
    "catalogue": "catalog",
    "categorise": "categorize",
    "centre": "center",
    "emphasised": "emphasized",
    "favour": "favor",
    "favourite": "favorite",
    "fulfil": "fulfill",
    "fulfilment": "fulfillment",
    "https": "http",
    "initialise": "initialize",
    "judgment": "judgement",
    "labelling": "labeling",
    "labour": "labor",
    "licence": "license",
    "maximise": "maximize",
    "modelled": "modeled",
    "modelling": "modeling",
    "offence": "offense",
    "optimise": "optimize",
    "organisation": "organization",
    "organise": "organize",
    "practise": "practice",
    "programme": "program",
    "realise": "realize",
    "recognise": "recognize",
    "signalling": "signaling",
    "utilisation": "utilization",
    "whilst": "while",
    "wilful": "wilfull",
}
PHRASES = {"sub license": "sublicense", "non commercial": "noncommercial", "per cent": "percent", "copyright owner": "copyright holder", "copy right": "copyright"}
#: Opens a copyright statement, up to its line's end or to the words that licences begin with, which group 1 keeps.
_COPYRIGHT = r"(?m)^[ \t*#/;-]*(?:copyright[ \t]*(?:\(c\)|©|<|\[|[0-9]{4})|\(c\)[ \t]*(?:copyright[ \t]*)?[0-9]{4}|©)[^\n]*?(\n|permission |redistribution |this software |licensed under |all rights reserved)"
_RESERVED = r"all rights reserved\.?"
_FOLD = r"[\x00-\x2f\x3a-\x60\x7b-\x7f“”‘’–—•·…«»©]+"
#: Every notice has this in it, however its words are spelled.
_ANCHOR = "licen"


def canonical(text: Column) -> Column:
    """Canonical form of a text, without its copyright statements."""
    low = F.regexp_replace(F.regexp_replace(F.concat(F.lower(text), F.lit("\n")), _COPYRIGHT, "$1"), _RESERVED, " ")
    words = F.trim(F.regexp_replace(low, _FOLD, " "))
    # Doubled blanks keep neighbouring words apart, so plain replacements see every whole word.
    out = F.concat(F.lit(" "), F.replace(words, F.lit(" "), F.lit("  ")), F.lit(" "))
    for table in (SPELLINGS, {k.replace(" ", "  "): v for k, v in PHRASES.items()}):
        for old, new in table.items():
            out = F.replace(out, F.lit(f" {old} "), F.lit(f" {new} "))
    return F.trim(F.replace(out, F.lit("  "), F.lit(" ")))


def digest(canonical: Column) -> Column:
    return F.sha2(canonical, 256)


def known_table(spark: SparkSession, texts: list[tuple[str, str]]) -> DataFrame:
    """``known_id, known_digest`` of (id, text) pairs."""
    cells = F.array(*[F.struct(F.lit(k).alias("known_id"), F.lit(t).alias("text")) for k, t in sorted(texts)])
    rows = spark.range(1).select(F.inline(cells.cast("array<struct<known_id:string,text:string>>")))
    return known_digests(rows)


def known_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``known_id, known_digest`` of a folder, or a list, of licence texts, each named by its id (``.txt`` is left out)."""
    rows = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("name"), F.col("value").alias("text"))
    return known_digests(rows.select(F.regexp_replace(F.url_decode("name"), r"\.txt$", "").alias("known_id"), "text"))


def known_digests(known: DataFrame, id_col: str = "known_id", text: str = "text") -> DataFrame:
    return known.select(F.col(id_col).alias("known_id"), canonical(F.col(text)).alias("c")).where("c <> ''").groupBy(digest(F.col("c")).alias("known_digest")).agg(F.min("known_id").alias("known_id"))


def scan(docs: DataFrame, licenses: DataFrame, notices: dict[str, str], text: str = "text") -> DataFrame:
    """Append ``n_words, canonical_sha256, license_id, notice_ids`` to documents.

    ``licenses`` comes from ``known_digests``; ``notices`` is a small fixed table of one-line texts with ``_ANCHOR`` in them.
    """
    spark = docs.sparkSession
    if bad := [k for k, t in notices.items() if _ANCHOR not in t.lower()]:
        raise ValueError(f"notices without {_ANCHOR!r}: {bad}")
    if licenses.limit(KNOWN_ROWS + 1).count() <= KNOWN_ROWS:
        licenses = F.broadcast(licenses)
    ids = {r["known_digest"]: r["known_id"] for r in known_table(spark, list(notices.items())).collect()}
    table = F.create_map(*[F.lit(x) for kv in sorted(ids.items()) for x in kv]) if ids else F.create_map().cast("map<string,string>")
    docs = docs.select("*", canonical(F.col(f"`{text}`")).alias("__canonical"))
    # Most texts have no line that could be a notice, and only such lines are brought to canonical form one by one.
    lines = F.filter(F.split(F.col(f"`{text}`"), "\n"), lambda x: F.lower(x).contains(_ANCHOR))
    found = F.array_sort(F.array_distinct(F.filter(F.transform(lines, lambda x: F.element_at(table, digest(canonical(x)))), lambda x: x.isNotNull())))
    row = docs.withColumn("__notices", F.when(F.lower(f"`{text}`").contains(_ANCHOR), F.array_join(found, ","))).withColumn("__digest", digest(F.col("__canonical")))
    words = F.when(F.col("__canonical") == "", 0).otherwise(F.length("__canonical") - F.length(F.replace("__canonical", F.lit(" "), F.lit(""))) + 1).cast("long")
    joined = row.join(licenses.withColumnsRenamed({"known_id": "__known_id", "known_digest": "__known"}), F.when(F.col("__canonical") != "", F.col("__digest")) == F.col("__known"), "left")
    names = [c for c in docs.columns if c not in ("n_words", "canonical_sha256", "license_id", "notice_ids", "__canonical")]
    return joined.select(*[F.col(f"`{c}`") for c in names], words.alias("n_words"), F.col("__digest").alias("canonical_sha256"), F.col("__known_id").alias("license_id"), F.coalesce("__notices", F.lit("")).alias("notice_ids"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return scan(docs, known_table(spark, LICENSES), NOTICES).drop("text")


def _oracle() -> str:
    def quoted(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    def canon(x: str) -> str:
        low = f"regexp_replace(regexp_replace(lower({x}) || chr(10), {quoted(_COPYRIGHT)}, '\\1', 'g'), {quoted(_RESERVED)}, ' ', 'g')"
        out = f"' ' || replace(trim(regexp_replace({low}, {quoted(_FOLD)}, ' ', 'g')), ' ', '  ') || ' '"
        for table in (SPELLINGS, {k.replace(" ", "  "): v for k, v in PHRASES.items()}):
            for old, new in table.items():
                out = f"replace({out}, {quoted(f' {old} ')}, {quoted(f' {new} ')})"
        return f"trim(replace({out}, '  ', ' '))"

    def known(texts: list[tuple[str, str]]) -> str:
        values = ", ".join(f"({quoted(k)}, {quoted(v)})" for k, v in sorted(texts))
        return f"select min(id) as id, sha256(c) as d from (select id, {canon('t')} as c from (values {values}) v(id, t)) where c <> '' group by 2"

    return f"""
with lic as ({known(LICENSES)}), note as ({known(list(NOTICES.items()))}),
d as (select doc_id, {canon('text')} as c, list_filter(string_split(text, chr(10)), lambda x: contains(lower(x), '{_ANCHOR}')) as l from documents),
n as (select doc_id, string_agg(distinct note.id, ',' order by note.id) as ids from (select doc_id, unnest(l) as x from d) join note on note.d = sha256({canon('x')}) group by 1)
select d.doc_id, case when c = '' then 0 else length(c) - length(replace(c, ' ', '')) + 1 end::bigint as n_words, sha256(c) as canonical_sha256, lic.id as license_id, coalesce(n.ids, '') as notice_ids
from d left join lic on c <> '' and lic.d = sha256(c) left join n on n.doc_id = d.doc_id
"""


QUERIES = {"op7_license_scan": op7_license_scan}
ORACLE = {"op7_license_scan": _oracle()}

"""Substring dedup over sliding sentence spans.

A text is split into sentences at line ends and after ``. ! ?``; a sentence of more
than ``LONG`` words is cut after words that a hash picks, so the cuts depend on the
words around them alone.  Each sentence begins the shortest run of at least ``SENTENCES``
sentences and ``WORDS`` words, and one that no such run ends with ends a run of its own; runs are hashed over
lower-cased words.  Where ``REACH`` words in a row are not certain to hold such a run
whatever stands around them, the ``SPAN`` words of the smallest hash among them are
a run as well, and so is each whole text of ``WORDS`` words.  So any ``REACH`` words
that two texts share hold a common run, wherever sentences end.

Runs are known by 96 bits of two polynomials over word hashes.  They meet in one global aggregate; a run's first
place is the smallest document id, then the earliest position.  Words covered by any other
occurrence are removed, so of a repeated passage exactly the first copy stays; of a
passage pasted into a sentence up to ``REACH - WORDS`` words may stay at either end.  The
repeated runs are a written table, so the places of a very frequent run can be split over tasks (AQE).

Texts are worked on as arrays over the bytes and words of about ``BLOCK`` bytes of texts at once; a longer text
is read in blocks, and its words are held as arrays of some 100 bytes a word.

Defined results: null and empty texts have no sentences and stay as they are;
texts of fewer words than a run cannot repeat; rows with a null id
pass unchanged; rows that share an id count as one document, so neither is a
repeat of the other, but each loses its own repeats only; the new columns replace others of their names, and
all other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.minmax_dedup import mix
from tessera.llm.textkit import WORD_TABLE, arrow_schema, load, without_columns
from tessera.session import discard, materialize

SENTENCES, WORDS, LONG = 3, 20, 24
#: A run of SPAN words and a run of sentences leave no gap between them in a shared passage while REACH is below WORDS + SPAN.
SPAN, REACH = 26, 45
#: One word in so many ends a piece of a long sentence.
PICK = 8
BLOCK = 1 << 20
_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)
_IS_WORD = np.frombuffer(bytes(range(256)).lower().translate(WORD_TABLE), np.uint8) != 32
_IS_BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_IS_STOP = np.isin(np.arange(256), list(b".!?"))
_RANDOM = np.random.default_rng(5)
_SIGN = _RANDOM.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)


class Words(NamedTuple):
    """Words of one or more texts, in order: where each one's share of the text begins, its hash, and whether a sentence ends with it.

    ``first`` has the number of each text's first word, and the number of all words at its end.
    """

    begin: np.ndarray
    hash: np.ndarray
    ends: np.ndarray
    first: np.ndarray


def _powers(base: int, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, base, np.uint64)]))


def _scan(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, hash, sentence end and the next word's begin for each word of a block.

    A word's share of the text begins after the sentence mark before it, else at the first blank before it.
    """
    word = _IS_WORD[data]
    edge = np.diff(word.astype(np.int8), prepend=0, append=0)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(start):
        return start, start.astype(np.uint64), start.astype(bool), start
    size = end - start
    offset = np.cumsum(size) - size
    place = np.arange(size.sum()) - np.repeat(offset, size)
    value = np.add.reduceat(_SIGN[_LOWER[data[word]]] * _powers(_BASES[0], int(size.max()))[place], offset)
    blank = _IS_BLANK[data]
    mark = data == 10
    mark[:-1] |= _IS_STOP[data[:-1]] & blank[1:]
    marks, blanks = np.flatnonzero(mark) + 1, np.append(np.flatnonzero(blank), len(data))
    following = np.append(start[1:], len(data))
    last = np.append(0, marks)[np.searchsorted(marks, following, side="right")]
    ends = last > end
    return start, mix(value ^ mix(size.astype(np.uint64))), ends, np.where(ends, last, np.minimum(blanks[np.searchsorted(blanks, end)], following))


def words_of(texts: list[bytes]) -> Words:
    """All words of texts, whose bytes are numbered through with one between two texts."""
    begin, value, ends, at = [], [], [], 0
    data = np.frombuffer(b"\n".join(texts), np.uint8)
    limits = np.cumsum([0, *(len(t) + 1 for t in texts)])
    starts = []
    while at < len(data):
        # A block ends before a word, so all that stands between two words lies in one block.
        to = at + BLOCK
        while to < len(data):
            word = _IS_WORD[data[to - 1 : to + BLOCK]]
            if len(hit := np.flatnonzero(word[1:] & ~word[:-1])):
                to += int(hit[0])
                break
            to += BLOCK
        s, h, e, n = _scan(data[at:to])
        starts.append(s + at)
        value.append(h)
        ends.append(e)
        begin.append(n + at)
        at = to
    none = np.zeros(0, np.int64)
    start = np.concatenate([none, *starts])
    first = np.searchsorted(start, limits)
    out = Words(np.concatenate([none, *begin]), np.concatenate([none.astype(np.uint64), *value]), np.concatenate([none.astype(bool), *ends]), first)
    shares = np.append(0, out.begin[:-1]) if len(start) else none
    some = first[:-1] < first[1:]
    shares[first[:-1][some]] = limits[:-1][some]
    out.ends[first[1:][some] - 1] = True
    return out._replace(begin=shares)


def cuts(words: Words, long: int = LONG) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word numbers at which sentences begin, long ones in pieces, with the number of all words at the end; and for each the first and last + 1 word of the uncut sentence."""
    whole = np.append(0, np.flatnonzero(words.ends) + 1)
    size = np.diff(whole)
    cut = words.ends | (np.repeat(size > long, size) & (words.hash % np.uint64(PICK) == 0))
    count = np.append(0, np.flatnonzero(cut) + 1)
    part = np.searchsorted(whole, count[:-1], side="right") - 1
    return count, whole[part], whole[part + 1]


def sentence_runs(count: np.ndarray, doc: np.ndarray, least: int = SENTENCES, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """First and last sentence of the runs; ``doc`` numbers the text of each sentence."""
    n = len(doc)
    place = np.arange(n)
    last = np.maximum(np.searchsorted(count, count[:-1] + words) - 1, place + least - 1)
    first = np.minimum(np.searchsorted(count, count[1:] - words, side="right") - 1, place - least + 1)
    ok = last < n
    ok[ok] = doc[last[ok]] == doc[ok]
    back = first >= 0
    back[back] = doc[first[back]] == doc[back]
    back[last[ok]] = False  # runs that begin in a shared passage end there already
    return np.concatenate([place[ok], first[back]]), np.concatenate([last[ok], place[back]])


def all_runs(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, two digests, first and last word (counted in the text) of all runs of texts, and which stood before in the text, apart from it."""
    words = words_of(texts)
    n, bounds = len(words.hash), words.first
    count, begin, end = cuts(words)
    doc = np.repeat(np.arange(len(texts)), np.diff(bounds))
    s, e = sentence_runs(count, doc[count[:-1]])
    head, power = [], []
    for base, h in zip(_BASES, (words.hash, mix(words.hash)), strict=True):
        power.append(_powers(base, n))
        head.append(np.append(np.zeros(1, np.uint64), np.cumsum(h * _powers(pow(base, -1, 1 << 64), n)[:n], dtype=np.uint64)))

    def digest(a: np.ndarray, b: np.ndarray, k: int = 0) -> np.ndarray:
        # A run's value is the sum of h_i * B^(a - i): the difference of two prefix sums, shifted by a power.
        return mix(((head[k][b] - head[k][a]) * power[k][a]) ^ mix((b - a).astype(np.uint64)))

    a, b = [count[s]], [count[e + 1]]
    if n >= REACH:
        # A run of sentences spares the stretches that begin from lo to hi: it lies in them, and they alone tell its
        # borders, for which a border needs a word on both sides, a cut in a sentence more than LONG words of it.
        lo = np.maximum(count[e + 1] + 1, np.minimum(end[e] + 1, begin[e] + LONG + 1)) - REACH
        hi = np.minimum(count[s] - 1, np.maximum(begin[s] - 1, end[s] - LONG - 1))
        own = doc[count[s]]
        lo, hi = np.maximum(lo, bounds[own]), np.minimum(hi, bounds[own + 1] - REACH)
        some = lo <= hi
        spared = np.cumsum(np.bincount(lo[some], minlength=n + 2) - np.bincount(hi[some] + 1, minlength=n + 2))[:n]
        need = np.flatnonzero((spared == 0) & (np.arange(n) + REACH <= bounds[1:][doc]))
        if len(need):
            at = np.arange(n - SPAN + 1)
            value, choice = digest(at, at + SPAN), REACH - SPAN
            # Of equal hashes the last one counts.
            best = need + choice - np.lib.stride_tricks.sliding_window_view(value, choice + 1)[need, ::-1].argmin(axis=1)
            best = best[np.diff(best, prepend=-1) != 0]
            a.append(best)
            b.append(best + SPAN)
    size = np.diff(bounds)
    a.append(bounds[:-1][size >= WORDS])
    b.append(bounds[1:][size >= WORDS])
    a, b = np.concatenate(a), np.concatenate(b)
    order = np.argsort(a, kind="stable")
    a, b = a[order], b[order]
    h, own = digest(a, b), doc[a] if n else a
    _, at, which = np.unique(h ^ mix(own.astype(np.uint64)), return_index=True, return_inverse=True)
    again = a >= b[at][which]  # runs may overlap their own first copy ("the the the"), which stays
    base = bounds[own]
    return own, h.view(np.int64), (digest(a, b, 1) >> np.uint64(32)).astype(np.uint32).view(np.int32), a - base, b - 1 - base, again


RUN = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("row", T.LongType()), T.StructField("h", T.LongType()),
    T.StructField("c", T.IntegerType()), T.StructField("place", T.LongType()),
])


def _groups(texts: list[str | None], rows: int = 256) -> Iterator[tuple[int, list[bytes]]]:
    """Neighbouring texts of about BLOCK bytes together, and the number of the first."""
    held, size, at = [], 0, 0
    for i, t in enumerate(texts):
        data = t.encode() if t else b""
        if held and (size + len(data) > BLOCK or len(held) >= rows):
            yield at, held
            held, size, at = [], 0, i
        held.append(data)
        size += len(data)
    if held:
        yield at, held


def run_rows(docs: DataFrame) -> DataFrame:
    """A row for each run of each text of ``doc_id, row, text``.

    ``place`` holds the first word, the last word, and 1 if the same text held the run before, in 32, 31 and 1 bits:
    one number is less to shuffle than three columns.
    """
    schema = arrow_schema(RUN)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for at, texts in _groups(batch.column(2).to_pylist()):
                own, h, c, s, e, again = all_runs(texts)
                place = s.astype(np.int64) << 32 | e.astype(np.int64) << 1 | again
                yield pa.RecordBatch.from_arrays([pa.array(x, type=f.type) for x, f in zip((ids[at + own], rows[at + own], h, c, place), schema, strict=True)], schema=schema)

    return docs.mapInArrow(make, RUN)


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, row, spans, first_doc_ids``: the places of runs to remove from each row, and where they stand first.

    ``row`` is the hash of the row's text, which tells apart rows that share an id.
    """
    spark, kept = docs.sparkSession, []
    base = docs.where(F.col(id_col).isNotNull() & (F.length(text) > 0)).select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("row"), F.col(text).alias("text"))
    found = materialize(run_rows(base), "runs", kept)
    many = found.groupBy("h", "c").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.max(F.col("place") % 2).alias("again"))
    many = materialize(many.where("first < last or again = 1").select("h", "c", "first"), "repeated", kept)
    spans = found.join(many, ["h", "c"]).where("place % 2 = 1 or first < doc_id").select("doc_id", "row", "place", "first")
    spans = spans.groupBy("doc_id", "row").agg(F.collect_list("place").alias("spans"), F.array_sort(F.collect_set("first")).alias("first_doc_ids"))
    spans = materialize(spans, "spans")
    discard(spark, kept)
    return spans


def without(text: str, spans: list) -> tuple[int, str]:
    """How many sentences lose words or go, and the text that stays."""
    data = text.encode()
    words = words_of([data])
    change = np.zeros(len(words.hash) + 1, np.int64)
    place = np.asarray(spans, np.int64)
    np.add.at(change, place >> 32, 1)
    np.add.at(change, ((place & 0xFFFFFFFF) >> 1) + 1, -1)
    gone = np.cumsum(change)[:-1] > 0
    count = cuts(words)[0]
    turn = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=1))
    # Words that stay reach from where such a stretch begins to where the next one that goes begins.
    begin = np.append(words.begin, len(data))
    limits = begin[np.append(turn, len(gone))[: len(turn) + 1]].tolist()
    kept = b"".join(data[a:b] for a, b in zip(limits[::2], limits[1::2], strict=False))
    return int(np.logical_or.reduceat(gone, count[:-1]).sum()), kept.decode().strip()


def dedup_spans(docs: DataFrame, id_col: str = "doc_id", text: str = "text", prefix: str = "") -> DataFrame:
    """Documents with repeats cut out of their text, and ``n_removed, first_doc_ids`` appended.

    A text without repeats is not even split again.
    """
    new = [T.StructField(f"{prefix}n_removed", T.LongType()), T.StructField(f"{prefix}first_doc_ids", T.ArrayType(T.LongType()))]
    repeated = repeated_spans(docs, id_col, text).select(F.col("doc_id").alias("__span_doc"), F.col("row").alias("__span_row"), F.col("spans").alias("__spans"), F.col("first_doc_ids").alias("__first"))
    docs = without_columns(docs, [f.name for f in new])
    names = docs.columns
    # The join brings at most one row to each document.
    joined = docs.join(repeated, (F.col(f"`{id_col}`").cast("long") == F.col("__span_doc")) & (F.xxhash64(F.col(f"`{text}`")) == F.col("__span_row")), "left").drop("__span_doc", "__span_row")
    schema = T.StructType([*docs.schema.fields, *new])
    target = arrow_schema(schema)
    where = names.index(text)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                columns = part.columns[: len(names)]
                gone, kept = [], []
                for t, spans in zip(columns[where].to_pylist(), part.column(len(names)).to_pylist(), strict=True):
                    k, t = without(t, spans) if spans else (0, t)
                    gone.append(k)
                    kept.append(t)
                columns[where] = pa.array(kept, type=target.field(where).type)
                yield pa.RecordBatch.from_arrays([*columns, pa.array(gone, pa.int64()), part.column(len(names) + 1)], names=schema.names)

    return joined.mapInArrow(make, schema)


def op5_span_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_spans(docs).select("doc_id", "n_removed", (F.col("n_removed") > 0).alias("changed"), F.coalesce("first_doc_ids", F.array().cast("array<bigint>")).alias("first_doc_ids"), "text")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut repeated passages out of texts; a document of which nothing is left goes."""
    done = dedup_spans(docs, prefix="__span_")
    kept = done.where((F.col("__span_n_removed") == 0) | (F.length("text") > 0))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


QUERIES = {"op5_span_dedup": op5_span_dedup}

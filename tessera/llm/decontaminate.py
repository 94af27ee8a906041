"""Benchmark decontamination with a generalised suffix automaton.

The automaton holds every run of words of every benchmark item.  A document's
words stream through it once; the state and match length at a word give the
longest run ending there that some item contains, so every occurrence of a
10-word window (or of a whole shorter item) is found exactly, whatever precedes it.

A state's transitions are two arrays, one for its first word and one for the state
that it leads to; only states with several have a dictionary for the others.

Benchmarks are a reference set: they are split into blocks of at most
``BLOCK_WORDS`` words, each block's automaton is broadcast (its size is bounded
by that number), and documents pass the blocks one after the other.

Defined results: null or empty texts have no words and are never contaminated; items
without words are ignored; an item whose id is null taints words but is not
listed; repeated items and rows each count; a text of any length is streamed whole; new columns replace others of their
names, all other columns pass through.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.textkit import alnum_words, arrow_schema, load, map_texts
from tessera.session import discard, materialize

WINDOW = 10
#: Most words that one automaton holds, at about 170 bytes of memory each with the dictionary (measured on 100,000 words of 20,000).
BLOCK_WORDS = 500_000
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


class ItemAutomaton:
    """Generalised suffix automaton over the word sequences of items."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.ids: dict[bytes, int] = {}
        #: First transition of each state (word -1: none) and the further ones of states that have some.
        self.word, self.to, self.more = array("i", [-1]), array("i", [0]), {}
        self.link, self.length = array("i", [-1]), array("i", [0])
        self.items: list[str | None] = []
        sequences = []
        for name, words in items:
            if words:
                seq = array("i", [self.ids.setdefault(w, len(self.ids)) for w in words])
                sequences.append(seq)
                self.items.append(name)
                last = 0
                for w in seq:
                    last = self._extend(last, w)
        n = len(self.word)
        #: The item whose window ends at a state of the last `window` words, and all of them where there are several.
        self.owner, self.owners = array("i", [-1]) * n, {}
        short: dict[int, list[tuple[int, int]]] = {}
        for item, seq in enumerate(sequences):
            v = 0
            for i, w in enumerate(seq):
                v = self.step(v, w)
                if i + 1 >= window:
                    self._own(self._above(v), item)
            if len(seq) < window:
                short.setdefault(v, []).append((len(seq), item))
        #: Short items that end at a state, those of its suffixes included, and the state of the last `window` words.
        self.short: dict[int, tuple[tuple[int, int], ...]] = {}
        self.tail = array("i", [0]) * n
        for v in sorted(range(1, n), key=self.length.__getitem__):
            up = self.link[v]
            if v in short or up in self.short:
                self.short[v] = tuple(sorted([*short.get(v, ()), *self.short.get(up, ())]))
            if self.length[v] >= window:
                self.tail[v] = v if self.length[up] < window else self.tail[up]

    def step(self, v: int, w: int) -> int | None:
        if self.word[v] == w:
            return self.to[v]
        return self.more[v].get(w) if v in self.more else None

    def _lead(self, v: int, w: int, to: int) -> None:
        if self.word[v] in (-1, w):
            self.word[v], self.to[v] = w, to
        else:
            self.more.setdefault(v, {})[w] = to

    def _own(self, state: int, item: int) -> None:
        first = self.owner[state]
        if first < 0:
            self.owner[state] = item
        elif first != item:
            self.owners.setdefault(state, {first}).add(item)

    def _above(self, v: int) -> int:
        while self.length[self.link[v]] >= self.window:
            v = self.link[v]
        return v

    def _state(self, length: int, link: int = 0) -> int:
        self.word.append(-1)
        self.to.append(0)
        self.link.append(link)
        self.length.append(length)
        return len(self.word) - 1

    def _extend(self, last: int, w: int) -> int:
        def split(p: int, q: int) -> int:
            """The state for the words of p and w alone, apart from the longer ones of q."""
            if self.length[q] == self.length[p] + 1:
                return q
            c = self._state(self.length[p] + 1, self.link[q])
            self.word[c], self.to[c] = self.word[q], self.to[q]
            if q in self.more:
                self.more[c] = dict(self.more[q])
            while p != -1 and self.step(p, w) == q:
                self._lead(p, w, c)
                p = self.link[p]
            self.link[q] = c
            return c

        if (q := self.step(last, w)) is not None:
            return split(last, q)
        new, p = self._state(self.length[last] + 1), last
        while p != -1 and (q := self.step(p, w)) is None:
            self._lead(p, w, new)
            p = self.link[p]
        if p != -1:
            self.link[new] = split(p, q)
        return new

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str], int]:
        """Merged hit ranges of words (end exclusive), ids of items with an occurring window, longest match."""
        first, to, more, link, length, tail, short, window = self.word, self.to, self.more, self.link, self.length, self.tail, self.short, self.window
        spans: list[tuple[int, int]] = []
        states: set[int] = set()
        found: set[int] = set()
        v = l = best = 0
        for i, w in enumerate(map(self.ids.get, words)):
            if w is None:
                v = l = 0
                continue
            while first[v] != w:
                if v in more and w in more[v]:
                    v = more[v][w]
                    break
                v = link[v]
                l = length[v]
            else:
                v = to[v]
            l += 1
            hit = 0
            if l >= window:
                hit = window
                states.add(tail[v])
            if v in short:
                for n, item in short[v]:
                    if n <= l:
                        found.add(item)
                        hit = max(hit, n)
            if hit:
                best = max(best, l)
                start = i + 1 - hit
                while spans and start <= spans[-1][1]:
                    start = min(start, spans.pop()[0])
                spans.append((start, i + 1))
        for s in states:
            found |= self.owners.get(s) or {self.owner[s]}
        return spans, {self.items[k] for k in found} - {None}, best


def merged(spans: Column) -> Column:
    """Sorted (from, to) ranges with those that touch united."""

    def unite(done: Column, s: Column) -> Column:
        last = F.element_at(done, -1)
        joined = F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(F.struct(last["from"].alias("from"), F.greatest(last["to"], s["to"]).alias("to"))))
        return F.when((F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["to"] >= s["from"]), joined).otherwise(F.concat(done, F.array(s)))

    return F.aggregate(spans, F.array().cast(SPANS), unite)


def cut(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans and what stands between them."""
    data = text.encode()
    places = [m.span() for m in _WORD.finditer(data)]
    out, at = [], 0
    for s, e in spans:
        out.append(data[at : places[s][0]].rstrip())
        at = places[e - 1][1]
    out.append(data[at:])
    return b" ".join(x for x in out if x.strip()).decode().strip()


SPANS = T.ArrayType(T.StructType([T.StructField("from", T.LongType()), T.StructField("to", T.LongType())]))


def blocks(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", words: int = BLOCK_WORDS, window: int = WINDOW):
    """Yield automata of at most ``words`` item words each (a single longer item gets one alone)."""
    held: list[tuple[str | None, list[bytes]]] = []
    n = 0
    for row in benchmark.select(F.col(item_id).cast("string").alias("i"), F.col(text).alias("t")).toLocalIterator():
        ws = alnum_words(row["t"])
        if held and n + len(ws) > words:
            yield ItemAutomaton(held, window)
            held, n = [], 0
        held.append((row["i"], ws))
        n += len(ws)
    yield ItemAutomaton(held, window)


def find_overlaps(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS, prefix: str = "") -> DataFrame:
    """Append ``n_words``, ``longest`` (match length), ``spans`` (hit word ranges) and ``items`` (sorted ids) to documents."""
    new = [(f"{prefix}n_words", T.LongType()), (f"{prefix}longest", T.LongType()), (f"{prefix}spans", SPANS), (f"{prefix}items", T.ArrayType(T.StringType()))]
    spark = docs.sparkSession

    def scan(df: DataFrame, automaton: ItemAutomaton) -> DataFrame:
        shared = spark.sparkContext.broadcast(automaton)

        def make() -> Callable:
            a = shared.value

            def run(texts: list[str | None]) -> tuple:
                counts, longest, spans, items = [], [], [], []
                for t in texts:
                    words = alnum_words(t)
                    s, f, best = a.scan(words)
                    counts.append(len(words))
                    longest.append(best)
                    spans.append([{"from": x, "to": y} for x, y in s])
                    items.append(sorted(f))
                return counts, longest, spans, items

            return run

        return map_texts(df, text, new, make)

    def joined(df: DataFrame, automaton: ItemAutomaton) -> DataFrame:
        """A further block: its findings are united with those that the row has."""
        old = {n: f"__before_{n}" for n, _ in new}
        both = scan(df.withColumnsRenamed(old), automaton)
        _, longest, spans, items = (n for n, _ in new)
        united = {
            longest: F.greatest(longest, old[longest]),
            spans: F.when(F.size(spans) == 0, F.col(old[spans])).when(F.size(old[spans]) == 0, F.col(spans)).otherwise(merged(F.array_sort(F.concat(old[spans], spans)))),
            items: F.array_sort(F.array_union(items, old[items])),
        }
        return both.withColumns(united).select(*[F.col(f"`{c}`") for c in df.columns])

    out: DataFrame | None = None
    past: list[str] = []
    for automaton in blocks(benchmark, item_id, item_text, block_words, window):
        if out is None:
            out = scan(docs, automaton)
            continue
        held = materialize(out, "decontaminate", now := [])
        discard(spark, past)
        past = now
        out = joined(held, automaton)
    return out


def op3_benchmark_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_overlaps(docs, load(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["to"] - s["from"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


#: Hit spans of at least this many words are cut out of a document; it goes altogether when hits cover this share of it.
CUT_WORDS, DROP_COVERAGE = 5, 0.8


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", cut_words: int = CUT_WORDS, drop_coverage: float = DROP_COVERAGE) -> DataFrame:
    """Remove benchmark spans from texts and drop documents that are little else; columns stay as they are.

    A hit span shorter than ``cut_words``, which only items as short can make, stays in a text that is not
    mostly hits: a one-word item does not take its word out of every document.
    """
    found = find_overlaps(docs, benchmark, text, prefix="__dec_")
    n_hit = F.aggregate("__dec_spans", F.lit(0).cast("long"), lambda a, s: a + s["to"] - s["from"])
    kept = found.where((F.size("__dec_spans") == 0) | (n_hit < drop_coverage * F.col("__dec_n_words")))
    long_ = F.filter("__dec_spans", lambda s: s["to"] - s["from"] >= cut_words)
    kept = kept.select(*[F.col(f"`{c}`") for c in docs.columns], long_.alias("__dec_spans"))
    schema, names = docs.schema, docs.columns
    target, where = arrow_schema(schema), names.index(text)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns, spans = batch.columns[:-1], batch.column(len(names))
            dirty = np.flatnonzero(pc.list_value_length(spans).to_numpy(zero_copy_only=False) > 0).tolist()
            stays = np.ones(batch.num_rows, bool)
            if dirty:  # other texts pass as they are
                texts = columns[where].to_pylist()
                for i in dirty:
                    texts[i] = cut(texts[i], [(s["from"], s["to"]) for s in spans[i].as_py()])
                    stays[i] = bool(texts[i])
                columns[where] = pa.array(texts, type=target.field(where).type)
            yield pa.RecordBatch.from_arrays(columns, names=names).filter(pa.array(stays))

    return kept.mapInArrow(clean, schema)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate(docs, load(spark, sf_dir, "benchmark"))


QUERIES = {"op3_benchmark_overlap": op3_benchmark_overlap}

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
ORACLE = {
    "op3_benchmark_overlap": f"""
with d as (select doc_id, coalesce({_WORDS}, []) as w from documents),
i as (select item_id::varchar as item, {_WORDS} as w from benchmark where text is not null),
iw as (select item, least(len(w), {WINDOW}) as n, unnest(range(len(w) - least(len(w), {WINDOW}) + 1)) as a, w from i where len(w) > 0),
win as (select distinct item, n, array_to_string(w[a + 1 : a + n], ' ') as k from iw),
dw as (select doc_id, m.n, unnest(range(len(w) - m.n + 1)) as a, w from d, (select distinct n from win) m where len(w) >= m.n),
hit as (select distinct dw.doc_id, dw.a, dw.n, win.item from dw join win on win.n = dw.n and win.k = array_to_string(dw.w[dw.a + 1 : dw.a + dw.n], ' ')),
pos as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(a, a + n)) as p from hit) group by 1),
its as (select doc_id, count(distinct item) as n_items, string_agg(distinct item, ',' order by item) as ids from hit group by 1)
select d.doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join pos using (doc_id) left join its using (doc_id)
"""
}

"""Near-duplicate components by min-max hashing, confirmed on full shingle sets.

Each permutation of the hash space is evaluated once per shingle and both its
minimum and its maximum are kept: ``PERMUTATIONS`` evaluations give twice as many
signature values.  ``BANDS`` bands of ``ROWS`` values (minima in one half of the
bands, maxima in the other, so the two values of a permutation never share a
band) put documents into buckets; at a similarity of 0.8 a pair shares no bucket
with probability (1 - 0.8^5)^40, about 1e-7.

Equal sets are first folded into one representative.  Inside a bucket not all
pairs are emitted: every member is compared with the bucket's hub (its smallest
id), and members that the verified links already join need no further
comparison.  Of the buckets that still hold several components, those of up to
``SMALL`` members compare the rest of their pairs; larger ones are united into
groups by shared members, and the group's members outside its largest component
are held against all of it block by block: a task gets two blocks of about
``BLOCK`` sets and emits the confirmed links alone.  So no link between components
is missed, and a large group of copies costs one comparison per member.

Defined results: documents without words have an empty set, are linked with
nothing and stay; rows with a null id are never linked (null component, kept);
for ``near_duplicates`` repeated ids are one document and each row is returned, for ``one_of_each`` every
row stands for itself; a text of any length is one set, held in memory in one task; other columns, whatever
their names, are ignored by the first and passed through by the second.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from tessera.llm.textkit import load, map_texts, space_words
from tessera.operators.components import connected_components
from tessera.session import discard, materialize

PERMUTATIONS = 100
ROWS = 5
BANDS = 2 * PERMUTATIONS // ROWS
#: Buckets of more members than this are compared in blocks of about so many sets.
SMALL, BLOCK = 16, 256
_COLUMNS = 4096
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Hashes of a text's distinct word shingles; word hashes are remembered."""

    def __init__(self, size: int, words: Callable[[str | None], list[bytes]] = space_words, remember: int = 1 << 16):
        self.size, self.words, self.remember = size, words, remember
        self.seen: dict[bytes, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = self.words(text)
        if not words:
            return np.zeros(0, np.uint64)
        seen = self.seen
        if len(seen) > self.remember:
            seen.clear()
        out = []
        for w in words:
            h = seen.get(w)
            if h is None:
                h = seen[w] = xxhash.xxh64_intdigest(w)
            out.append(h)
        h = np.array(out, np.uint64)
        k = min(self.size, len(h))
        acc = h[: len(h) - k + 1].copy()
        for i in range(1, k):
            acc = mix(acc + np.uint64(0x9E3779B97F4A7C15)) ^ h[i : len(h) - k + 1 + i]
        return np.unique(mix(acc + np.uint64(k)))


class MinMaxSigner:
    def __init__(self, permutations: int = PERMUTATIONS, rows: int = ROWS, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.add = rng.integers(0, 1 << 63, permutations, dtype=np.uint64)[:, None]
        self.mul = (rng.integers(0, 1 << 63, permutations, dtype=np.uint64) * np.uint64(2) + np.uint64(1))[:, None]
        self.rows = rows
        self.band_mul = rng.integers(0, 1 << 63, rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.band_no = np.arange(2 * permutations // rows, dtype=np.uint64)

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        """All minima, then all maxima, of the permuted hashes."""
        low = np.full(len(self.mul), np.iinfo(np.uint64).max, np.uint64)
        high = np.zeros(len(self.mul), np.uint64)
        for at in range(0, len(shingles), _COLUMNS):
            x = (shingles[None, at : at + _COLUMNS] + self.add) * self.mul
            x ^= x >> np.uint64(32)
            low = np.minimum(low, x.min(axis=1))
            high = np.maximum(high, x.max(axis=1))
        return np.concatenate([low, high])

    def bands(self, shingles: np.ndarray) -> np.ndarray:
        if not len(shingles):
            return np.zeros(0, np.int64)
        grid = mix(self.signature(shingles)).reshape(-1, self.rows)
        return mix((grid * self.band_mul).sum(axis=1, dtype=np.uint64) + self.band_no).view(np.int64)


LONGS = T.ArrayType(T.LongType())


def signatures(docs: DataFrame, text: str, size: int, words: Callable = space_words) -> DataFrame:
    """Replace the text by its set's size, two 64-bit digests of the set, and the band keys."""

    def make() -> Callable:
        shingle, signer = Shingler(size, words), MinMaxSigner()

        def run(texts: list[str | None]) -> tuple:
            n, one, two, bands = [], [], [], []
            for t in texts:
                s = shingle(t)
                n.append(len(s))
                d = xxhash.xxh3_128_intdigest(s.tobytes())
                one.append((d >> 64) - (1 << 63))
                two.append((d & ((1 << 64) - 1)) - (1 << 63))
                bands.append(signer.bands(s))
            return n, one, two, bands

        return run

    new = [("n_shingles", T.LongType()), ("set_a", T.LongType()), ("set_b", T.LongType()), ("bands", LONGS)]
    return map_texts(docs, text, new, make, keep_text=False)


def shingle_sets(docs: DataFrame, text: str, size: int, words: Callable = space_words) -> DataFrame:
    def make() -> Callable:
        shingle = Shingler(size, words)
        return lambda texts: ([shingle(t).view(np.int64) for t in texts],)

    return map_texts(docs, text, [("shingles", LONGS)], make, rows=128, keep_text=False)


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of (a, b) pairs, those whose full sets reach the similarity."""
    left = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("rep").alias("b"), F.col("shingles").alias("y"))
    both = pairs.join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("x", "y"))
    total = F.size("x") + F.size("y")
    return both.where((100 + percent) * common >= percent * total).select("a", "b")


def link_sets(docs: DataFrame, id_col: str, text: str, size: int, percent: int, words: Callable, by_id: bool) -> tuple[DataFrame, DataFrame]:
    """Signed rows ``doc_id, row, n_shingles, set_a, set_b`` and, for each set, its class ``set_a, set_b, doc_id, component``.

    A set's number in the linking is ``rep``; ``doc_id`` is the smallest id that has it, ``row`` the hash of a row's
    text.  With ``by_id``, sets of rows that share an id are linked.
    """
    spark = docs.sparkSession
    keep: list[str] = []
    base = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.xxhash64(F.col(f"`{text}`")).alias("row"), F.col(f"`{text}`").alias("text"))
    signed = materialize(signatures(base, "text", size, words), "minmax")
    linkable = signed.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))

    # Equal sets: one representative each, found by a partial aggregate and numbered as it is written.
    reps = linkable.groupBy("set_a", "set_b").agg(F.min(F.struct("doc_id", "row")).alias("one"), F.max("n_shingles").alias("n"), F.max("bands").alias("bands"))
    reps = reps.select(F.monotonically_increasing_id().alias("rep"), "set_a", "set_b", "one.doc_id", "one.row", "n", "bands")
    reps = materialize(reps, "reps", keep)
    rows = reps.select("rep", "n", F.explode("bands").alias("key"))
    # Written, so that the join's sides are plain exchanges and a very large bucket can be split over tasks (AQE).
    shared = rows.groupBy("key").agg(F.min("rep").alias("hub"), F.count("*").alias("m")).where("m > 1").select("key", "hub")
    members = materialize(rows.join(materialize(shared, "shared", keep), "key").select("key", "rep", "n", "hub"), "buckets", keep)

    wanted = reps.select("rep", "doc_id", "row").join(members.select("rep").distinct(), "rep")
    # A repeated row is read once.
    candidates = base.join(wanted, ["doc_id", "row"]).dropDuplicates(["doc_id", "row"]).select("rep", "text")
    sets = materialize(shingle_sets(candidates, "text", size, words), "sets", keep)

    first = members.where("rep <> hub").select(F.col("rep").alias("a"), F.col("hub").alias("b")).distinct()
    edges = verified(first, sets, percent)
    edges = materialize(edges.union(_same_id(linkable, reps)) if by_id else edges, "links", keep)
    component = connected_components(edges, "a", "b")
    labelled = members.join(component.select(F.col("id").alias("rep"), "component"), "rep", "left")
    labelled = materialize(labelled.withColumn("component", F.coalesce("component", "rep")), "labelled", keep)
    open_ = labelled.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("m")).where("lo < hi and m > 2").select("key", "m")
    rest = materialize(labelled.join(materialize(open_, "open", keep), "key"), "open", keep)
    found = verified(_small_pairs(rest.where(F.col("m") <= SMALL), percent), sets, percent)
    if not (large := rest.where(F.col("m") > SMALL)).isEmpty():
        found = found.union(_block_links(large, sets, percent, keep))
    found = materialize(found, "links", keep)
    if not found.isEmpty():
        component = connected_components(edges.union(found), "a", "b")
    classes = reps.select("set_a", "set_b", "doc_id", "rep").join(component.withColumnRenamed("id", "rep"), "rep", "left")
    classes = materialize(classes.select("set_a", "set_b", "doc_id", F.coalesce("component", "rep").alias("component")), "classes")
    discard(spark, keep)
    return signed.drop("bands"), classes


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80, words: Callable = space_words) -> DataFrame:
    """Classes of documents linked by ``100 * |A & B| >= percent * |A | B|`` on shingles of ``size`` words.

    Returns one row per input row: ``doc_id, n_shingles, component_id, kept``.
    """
    signed, classes = link_sets(docs, id_col, text, size, percent, words, by_id=True)
    least = materialize(classes.groupBy("component").agg(F.min("doc_id").alias("component_id")), "least")
    named = materialize(classes.join(least, "component").select("set_a", "set_b", "component_id"), "named")
    linked = signed.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)).join(named, ["set_a", "set_b"]).select("doc_id", "n_shingles", "component_id")
    alone = signed.where(F.col("doc_id").isNull() | (F.col("n_shingles") == 0)).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80, words: Callable = space_words) -> DataFrame:
    """The rows of ``docs`` that stay when of each class of near-duplicates only one does: that of the smallest id.

    Rows are judged by their texts alone, so unrelated texts that share an id all stay; of repeated rows one stays.
    Rows with a null id or without words stay.
    """
    signed, classes = link_sets(docs, id_col, text, size, percent, words, by_id=False)
    linked = signed.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)).join(classes.select("set_a", "set_b", "component"), ["set_a", "set_b"])
    kept = linked.groupBy("component").agg(F.min(F.struct("doc_id", "row")).alias("one")).select("one.*")
    kept = materialize(kept.select(F.col("doc_id").alias("__doc"), F.col("row").alias("__row"), F.lit(True).alias("__linked")), "kept")
    key, content = F.col(f"`{id_col}`"), F.col(f"`{text}`")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    plain = key.isNull() | content.isNull() | ~content.rlike(r"[^\x20\x09-\x0D]")
    some = docs.where(~plain).join(kept, (key == F.col("__doc")) & (F.xxhash64(content) == F.col("__row")))
    some = some.withColumn("__n", F.row_number().over(W.partitionBy("__doc", "__row").orderBy(F.lit(1)))).where("__n = 1")
    return some.select(*columns).union(docs.where(plain).select(*columns))


def _small_pairs(rest: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components in buckets of at most SMALL members; those with the hub are known already."""
    size_ok = F.lit(percent) * F.greatest("na", "nb") <= 100 * F.least("na", "nb")
    side = rest.where("rep <> hub")
    left = side.select("key", F.col("rep").alias("a"), F.col("n").alias("na"), F.col("component").alias("ca"))
    right = side.select("key", F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("component").alias("cb"))
    return left.join(right, "key").where((F.col("a") > F.col("b")) & (F.col("ca") != F.col("cb")) & size_ok).select("a", "b").distinct()


def _block_links(large: DataFrame, sets: DataFrame, percent: int, keep: list[str]) -> DataFrame:
    """Links between different components of groups of members that share large buckets."""
    group = connected_components(large.where("rep <> hub").select(F.col("rep").alias("src"), F.col("hub").alias("dst"))).withColumnRenamed("component", "grp")
    inside = large.select("rep", "component").distinct().join(group.withColumnRenamed("id", "rep"), "rep")
    inside = materialize(inside, "groups", keep)
    counts = inside.groupBy("grp", "component").agg(F.count("*").alias("n"))
    main = counts.groupBy("grp").agg(F.max(F.struct("n", "component")).alias("top"), F.sum("n").alias("all"), F.count("*").alias("parts")).where("parts > 1")
    blocks = lambda n: F.greatest(F.lit(1), F.ceil(n / BLOCK)).cast("int")
    main = main.select("grp", F.col("top.component").alias("main"), blocks(F.col("top.n")).alias("nm"), blocks(F.col("all") - F.col("top.n")).alias("no"))
    rows = inside.join(main, "grp").withColumn("h", F.xxhash64("rep"))
    # Block pairs are (outer block i, outer block j >= i) and (outer block i, main block j, numbered from -1 down).
    own = F.pmod("h", "no").cast("int")
    outer = rows.where("component <> main").withColumn("own", own)
    last = F.col("no") - 1
    with_outer = F.concat(
        F.transform(F.sequence(F.lit(0), F.col("own")), lambda i: F.struct(i.alias("i"), F.col("own").alias("j"))),
        F.transform(F.when(F.col("own") < last, F.sequence(F.col("own") + 1, last)).otherwise(F.array().cast("array<int>")), lambda j: F.struct(F.col("own").alias("i"), j.alias("j"))),
        F.transform(F.sequence(F.lit(1), F.col("nm")), lambda j: F.struct(F.col("own").alias("i"), (-j).alias("j"))),
    )
    inner = rows.where("component = main").withColumn("own", -F.pmod("h", "nm").cast("int") - 1)
    with_main = F.transform(F.sequence(F.lit(0), last), lambda i: F.struct(i.alias("i"), F.col("own").alias("j")))
    placed = outer.select("grp", "rep", "component", "own", F.explode(with_outer).alias("at")).union(inner.select("grp", "rep", "component", "own", F.explode(with_main).alias("at")))
    placed = placed.select("grp", "at.i", "at.j", "rep", "component", "own").join(sets, "rep")

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        i, j = int(pdf["i"].iloc[0]), int(pdf["j"].iloc[0])
        left, right = pdf[pdf["own"] == i], pdf[pdf["own"] == j]
        out_a, out_b = [], []
        if len(left) and len(right):
            arrays = list(right["shingles"])
            size = np.array([len(x) for x in arrays])
            universe, at = np.unique(np.concatenate(arrays), return_inverse=True)
            starts = np.concatenate([[0], np.cumsum(size)[:-1]])
            part, ids = right["component"].to_numpy(), right["rep"].to_numpy()
            for a, c, s in zip(left["rep"], left["component"], left["shingles"], strict=True):
                flag = np.zeros(len(universe), np.int32)
                place = np.minimum(np.searchsorted(universe, s), len(universe) - 1)
                flag[place[universe[place] == s]] = 1
                common = np.add.reduceat(flag[at], starts)
                hit = ((100 + percent) * common >= percent * (size + len(s))) & (part != c)
                for b in ids[hit].tolist():
                    out_a.append(a)
                    out_b.append(b)
        return pd.DataFrame({"a": out_a, "b": out_b}, dtype="int64")

    return placed.groupBy("grp", "i", "j").applyInPandas(compare, "a long, b long").where("a <> b").distinct()


def _same_id(linkable: DataFrame, reps: DataFrame) -> DataFrame:
    """Links between the representatives of one id that came with several sets."""
    several = linkable.groupBy("doc_id").agg(*[f(c).alias(f"{f.__name__}_{c}") for c in ("set_a", "set_b") for f in (F.min, F.max)])
    several = several.where("min_set_a < max_set_a or min_set_b < max_set_b").select("doc_id")
    folded = linkable.select("doc_id", "set_a", "set_b").join(several, "doc_id", "left_semi").join(reps.select("set_a", "set_b", "rep"), ["set_a", "set_b"]).select("doc_id", "rep")
    least = folded.groupBy("doc_id").agg(F.min("rep").alias("lo"))
    return folded.join(least, "doc_id").where("rep > lo").select(F.col("rep").alias("a"), F.col("lo").alias("b")).distinct()


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(load(spark, sf_dir, "documents"), size=2)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document, that of the smallest id, of each group of near-duplicates (five-word shingles)."""
    return one_of_each(docs)


QUERIES = {"op4_near_duplicates": op4_near_duplicates}

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLE = {
    "op4_near_duplicates": f"""
with recursive d as (select doc_id, coalesce(regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+'), []) as w from documents),
s as (select distinct doc_id, unnest(case when len(w) = 1 then [w[1]] else list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) end) as g from d where len(w) > 0),
n as (select doc_id, count(*) as n from s group by 1),
c as (select a.doc_id as x, b.doc_id as y, count(*) as k from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
l as (select x, y from c join n a on a.doc_id = x join n b on b.doc_id = y where 100 * k >= 80 * (a.n + b.n - k)),
e as (select x, y from l union all select y, x from l),
r as (select doc_id as x, doc_id as root from n union select e.y, r.root from r join e on e.x = r.x),
m as (select x, min(root) as component_id from r group by 1)
select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, coalesce(component_id, d.doc_id) as component_id, d.doc_id = coalesce(component_id, d.doc_id) as kept
from d left join n using (doc_id) left join m on m.x = d.doc_id
"""
}

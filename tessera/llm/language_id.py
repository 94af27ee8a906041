"""Language ID by prediction by partial matching (PPM, escape method C).

Per language, a variable-order byte context tree holds how often each byte
followed each context of up to ``MAX_ORDER`` bytes.  A byte's exact code length
is found from the longest context down: a context that was seen either codes the
byte (``c / (n + d)``) or codes an escape (``d / (n + d)``) and passes it to the
next shorter context; below the empty context every byte costs 8 bits.
``n`` counts what followed the context, ``d`` how many different bytes did.
Statistics are frozen after training, so a window of ``MAX_ORDER + 1`` bytes has
one code length per language, and a batch needs one look-up per different window.

Defined results: null texts and texts without a letter are ``und`` with score 0;
repeated rows score alike; ties go to the first language in code-point order;
a language without text to learn from is never predicted; with no training rows every text is ``und``; a text
of any length is scored in pieces; new columns replace others of their names, all other columns pass through.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.textkit import arrow_schema, held_out, load, map_texts

MAX_ORDER = 4
#: The classifier is fitted on whole documents of about this many characters in all, an equal share for each language,
#: picked by a hash of their id.
TRAIN_CHARS = 10_000_000
#: Bytes counted at once, and bytes times languages scored at once; they bound a task's memory for texts of any length.
CHUNK = 1 << 19
CELLS = 1 << 21
UND = "und"


def has_letter(text: str | None) -> bool:
    if not text:
        return False
    return any(map(str.isalpha, text))


def windows(data: np.ndarray, order: int) -> np.ndarray:
    """Each byte with the ``order`` bytes before it, packed into a uint64, oldest byte highest."""
    n = len(data) - order
    out = np.zeros(max(n, 0), np.uint64)
    for k in range(order + 1):
        out = (out << np.uint64(8)) | data[k : k + n].astype(np.uint64)
    return out


def prepared(text: str) -> bytes:
    return text.lower().encode()


def count_windows(texts: Iterable[str], order: int = MAX_ORDER) -> tuple[np.ndarray, np.ndarray]:
    """Different windows of texts and how often each comes; a long text is counted in pieces."""
    keys, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for text in texts:
        data = np.frombuffer(bytes(order) + prepared(text), np.uint8)
        for at in range(0, len(data) - order, CHUNK):
            k, n = np.unique(windows(data[at : at + CHUNK + order], order), return_counts=True)
            keys.append(k)
            counts.append(n)
    every, back = np.unique(np.concatenate(keys), return_inverse=True)
    return every, np.bincount(back, weights=np.concatenate(counts), minlength=len(every)).astype(np.int64)


class PPM:
    """Frozen context trees of all languages, as sorted arrays of packed contexts."""

    def __init__(self, languages: list[str], order: int, grams: list[np.ndarray], codes: list[np.ndarray], contexts: list[np.ndarray], escapes: list[np.ndarray]):
        self.languages, self.order = languages, order
        self.grams, self.codes, self.contexts, self.escapes = grams, codes, contexts, escapes

    @staticmethod
    def fit(texts: dict[str, Iterable[str]], order: int = MAX_ORDER) -> PPM:
        return PPM.of_counts({lang: count_windows(ts, order) for lang, ts in texts.items()}, order)

    @staticmethod
    def of_counts(found: dict[str, tuple[np.ndarray, np.ndarray]], order: int = MAX_ORDER) -> PPM:
        """From each language's windows and how often they came; languages without any are left out, as they would code all at 8 bits a byte."""
        languages = sorted(lang for lang, (keys, _) in found.items() if len(keys))
        counted = [found[lang] for lang in languages]
        if not languages:
            return PPM([], order, [], [], [], [])
        grams, codes, contexts, escapes = [], [], [], []
        for k in range(order + 1):
            mask = np.uint64((1 << (8 * (k + 1))) - 1)
            per = []
            for keys, counts in counted:  # grams of k context bytes and a symbol
                short, back = np.unique(keys & mask, return_inverse=True)
                per.append((short, np.bincount(back, weights=counts, minlength=len(short))))
            g = np.unique(np.concatenate([s for s, _ in per]))
            c = np.unique(g >> np.uint64(8))
            code = np.full((len(g), len(languages)), np.inf, np.float64)
            escape = np.zeros((len(c), len(languages)), np.float64)
            for j, (short, count) in enumerate(per):
                ctx, back = np.unique(short >> np.uint64(8), return_inverse=True)
                n = np.bincount(back, weights=count, minlength=len(ctx))
                d = np.bincount(back, minlength=len(ctx))
                code[np.searchsorted(g, short), j] = -np.log2(count / (n + d)[back])
                escape[np.searchsorted(c, ctx), j] = -np.log2(d / (n + d))
            grams.append(g)
            codes.append(code)
            contexts.append(c)
            escapes.append(escape)
        return PPM(languages, order, grams, codes, contexts, escapes)

    def code_lengths(self, keys: np.ndarray) -> np.ndarray:
        """Bits of the last byte of each window, per language."""
        bits = np.zeros((len(keys), len(self.languages)))
        open_ = np.ones_like(bits, dtype=bool)
        for k in range(self.order, -1, -1):
            gram = keys & np.uint64((1 << (8 * (k + 1))) - 1)
            ctx = gram >> np.uint64(8)
            at = np.minimum(np.searchsorted(self.contexts[k], ctx), len(self.contexts[k]) - 1)
            seen = self.contexts[k][at] == ctx
            at_g = np.minimum(np.searchsorted(self.grams[k], gram), len(self.grams[k]) - 1)
            code = np.where((self.grams[k][at_g] == gram)[:, None], self.codes[k][at_g], np.inf)
            found = open_ & np.isfinite(code)
            bits[found] += code[found]
            open_ &= ~found
            bits += np.where(open_ & seen[:, None], self.escapes[k][at], 0.0)
        return bits + 8.0 * open_

    def score(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Total bits per text and language, and bytes per text."""
        total = np.zeros((len(texts), len(self.languages)))
        size = np.zeros(len(texts), np.int64)
        pad = bytes(self.order)
        buffer: list[bytes] = []
        owner: list[tuple[int, int]] = []
        held, most = 0, max(1, CELLS // len(self.languages))

        def flush() -> None:
            nonlocal held
            if not buffer:
                return
            keys = np.concatenate([windows(np.frombuffer(b, np.uint8), self.order) for b in buffer])
            different, back = np.unique(keys, return_inverse=True)
            cost = self.code_lengths(different)[back]
            starts = np.cumsum([0] + [n for _, n in owner[:-1]])
            np.add.at(total, [i for i, _ in owner], np.add.reduceat(cost, starts, axis=0))
            buffer.clear()
            owner.clear()
            held = 0

        for i, text in enumerate(texts):
            data = prepared(text) if text else b""
            size[i] = len(data)
            data = pad + data
            for at in range(0, len(data) - self.order, most):
                piece = data[at : at + most + self.order]
                buffer.append(piece)
                owner.append((i, len(piece) - self.order))
                held += len(piece)
                if held >= most:
                    flush()
        flush()
        return total, size

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float], list[float]]:
        """Language, its posterior under equal priors, and bits per byte in it."""
        if not self.languages:
            return [UND] * len(texts), [0.0] * len(texts), [0.0] * len(texts)
        total, size = self.score(texts)
        best = total.argmin(axis=1)
        low = total.min(axis=1)
        posterior = 1.0 / np.exp2(np.clip(low[:, None] - total, -1000, 0)).sum(axis=1)
        lang, score, rate = [], [], []
        for i, text in enumerate(texts):
            ok = has_letter(text)
            lang.append(self.languages[best[i]] if ok else UND)
            score.append(float(posterior[i]) if ok else 0.0)
            rate.append(float(low[i] / size[i]) if size[i] else 0.0)
        return lang, score, rate


COUNTS = T.StructType([T.StructField("l", T.StringType()), T.StructField("key", T.LongType()), T.StructField("n", T.LongType())])


def train(rows: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang", order: int = MAX_ORDER, bound: int = TRAIN_CHARS) -> PPM:
    """Fit on a bounded sample of whole texts, chosen by a hash of the id, at least one id for each language that has text.

    Windows are counted where the texts are; the driver gets each language's different windows with their counts.
    """
    use = rows.select(F.col(f"`{id_col}`").cast("string").alias("i"), F.col(f"`{lang}`").alias("l"), F.col(f"`{text}`").alias("t")).where((F.length("t") > 0) & F.col("l").isNotNull())
    pick = F.pmod(F.xxhash64("i", F.lit("ppm")), F.lit(1 << 30))
    sizes = use.groupBy("l").agg(F.sum(F.length("t")).alias("n"), F.min(pick).alias("least")).collect()
    if not sizes:
        return PPM.of_counts({}, order)
    share = bound / len(sizes)
    limits = {r["l"]: max(int(min(1.0, share / r["n"]) * (1 << 30)), r["least"] + 1) for r in sizes}
    limit = F.create_map(*[F.lit(x) for kv in limits.items() for x in kv])
    schema = arrow_schema(COUNTS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts: dict[str, list[str]] = {}
            for l, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                texts.setdefault(l, []).append(t)
            for l, ts in texts.items():
                keys, n = count_windows(ts, order)
                yield pa.RecordBatch.from_arrays([pa.array([l] * len(keys)), pa.array(keys.view(np.int64)), pa.array(n)], schema=schema)

    counted = use.where(pick < limit[F.col("l")]).select("l", "t").mapInArrow(count, COUNTS).groupBy("l", "key").agg(F.sum("n").alias("n")).toArrow()
    langs = counted.column("l").dictionary_encode().combine_chunks()
    which, keys, n = langs.indices.to_numpy(), counted.column("key").to_numpy().view(np.uint64), counted.column("n").to_numpy()
    return PPM.of_counts({l: (keys[order_], n[order_]) for j, l in enumerate(langs.dictionary.to_pylist()) for order_ in [np.flatnonzero(which == j)]}, order)


def identify(df: DataFrame, model: PPM, text: str = "text", prefix: str = "", keep_text: bool = True) -> DataFrame:
    """Append ``lang_pred``, ``score`` and ``bits_per_byte`` of every whole text."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def make() -> Callable:
        return shared.value.predict

    new = [(f"{prefix}lang_pred", T.StringType()), (f"{prefix}score", T.DoubleType()), (f"{prefix}bits_per_byte", T.DoubleType())]
    return map_texts(df, text, new, make, keep_text=keep_text)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = train(docs.where(~held_out()))
    return identify(docs.select("doc_id", held_out().alias("held_out"), "text"), model, keep_text=False)


#: Texts for which even the best language's code is longer than raw bytes are not prose in a known language.
MAX_BITS_PER_BYTE = 8.0


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents of no known language: null texts, texts without a letter, and texts that cost over 8 bits a byte, more than raw storage."""
    model = train(docs.where(~held_out()))
    tagged = identify(docs, model, prefix="__lid_")
    keep = (F.col("__lid_lang_pred") != UND) & (F.col("__lid_bits_per_byte") <= MAX_BITS_PER_BYTE)
    return tagged.where(keep).select(*[F.col(f"`{c}`") for c in docs.columns])


QUERIES = {"op1_language_id": op1_language_id}
ORACLE: dict[str, str] = {}

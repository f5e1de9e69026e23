"""Quality rules with an n-gram perplexity band for each language.

The language model gives the bytes of a word from up to four bytes before them in
the word (and the word's end), by interpolated modified Kneser-Ney smoothing, one
model a language. Spark counts the 5-grams of all words of all documents, and
derives the lower orders (continuation counts), discounts and probabilities from
them. Every counted n-gram is in the model, at every size of the corpus, and no model
is broadcast: documents are dealt into chunks by a hash of the whole row, a chunk asks
for each of its distinct 5-grams once, and the requests meet the model by (language,
bucket of the 5-gram), where it is stored in sorted hash arrays. The numbers of chunks and buckets grow
with the corpus; the size of a bucket does not, but the requests to it grow with the chunks. A word is scored once a chunk, however often it occurs.

A document's score is the median, over its runs of ``RUN_WORDS`` words, of the run's
cross entropy in nats a byte (the logarithm of its perplexity), so one odd passage or
name does not decide on a whole text. Scores of short texts scatter more, and texts of one length differ
in topic and style however long they are, so each language has a middle and a deviation
(scaled quartile distance) for each length class, the power of two of the bytes: exact
quantiles of all its documents that pass the base rules, where texts of one score and
length count once. A text is rejected above or below ``WIDTH`` deviations; it is also rejected if the cross entropy
of all its words (``whole``) or of its run at the quantile ``TAIL`` is that far above the
middle of its class, so that junk in a part of the text counts too. A class of
fewer than ``CLASS_ROWS`` documents takes the figures of the nearest class that has as
many, wider by the root of the length if that is a longer one and never narrower; a
language without such a class has one band for all lengths.

Defined results: a null text has no words; a null language is the empty one. A
text without words scores zero and fails the base rules. Repeated rows count and
are judged like others. Other columns stay as they are, whatever their names. An
empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..operators.robust import exact_quantiles
from ..session import materialize
from . import encode
from .common import col, give_back, map_arrow, mix64, small_batches

ORDER = 5
START, END = 0x20, 0x0A  # bytes that no word has
WIDTH, LEAST_DEVIATION, CLASS_ROWS = 4.0, 0.1, 30
WINDOW_WORDS, MIN_WORDS, MAX_REPEAT_PERCENT = 5, 10, 20
SPACES, SYMBOLS = " \t\n\v\f\r", "#*$%&|<>"
RUN_WORDS, TAIL = 16, 0.75
JUDGED = ("score", "whole", "tail")
FLUSH_WORDS = 500_000
CHUNK_BYTES, LEAST_CHUNK_BYTES = 16 << 20, 1 << 20
BUCKET_GRAMS, PRIME = 1 << 16, 1_000_003
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


# ---- the model -------------------------------------------------------------------------------------------------

def word_grams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Packed 5-grams of each word, filled up with start marks, and their number for each word."""
    sizes = np.array([len(x) + 1 for x in words], np.int64)
    flat = np.frombuffer(bytes([END]).join(words) + bytes([END]), np.uint8).astype(np.int64)
    ends = np.cumsum(sizes)
    place = np.arange(len(flat)) - np.repeat(ends - sizes, sizes)
    grams = flat.copy()
    for back in range(1, ORDER):
        before = np.full(len(flat), START, np.int64)
        before[back:] = np.where(place[back:] >= back, flat[:-back], START)
        grams |= before << 8 * back
    return grams, sizes


def _count(lang_col: str, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[str, Counter] = {}
        encode.forget()
        give_back()

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, counter in words.items():
                if counter:
                    grams, sizes = word_grams(list(counter))
                    weights = np.repeat(np.fromiter(counter.values(), np.int64, len(counter)), sizes)
                    order = np.argsort(grams)
                    grams, starts = np.unique(grams[order], return_index=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(grams)), pa.array(grams), pa.array(np.add.reduceat(weights[order], starts))],
                        ["lang", "gram", "n"])
            words.clear()

        for batch in small_batches(batches, text_col):
            for lang, text in zip(batch.column(lang_col).to_pylist(), batch.column(text_col).to_pylist(), strict=True):
                words.setdefault(lang or "", Counter()).update((text or "").encode().split())
            if sum(map(len, words.values())) > FLUSH_WORDS:
                yield from flush()
        yield from flush()
        give_back()
    return run


def count_grams(df: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    """lang, gram, n: the 5-grams of all words of all rows."""
    used = df.select(col(lang_col).cast("string").alias("lang"), col(text_col).cast("string").alias("text"))
    found = map_arrow(used, _count("lang", "text"), "lang string, gram long, n long")
    return found.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _discounts(counts: DataFrame) -> DataFrame:
    """lang, d1, d2, d3: modified Kneser-Ney discounts; halves of the count where counts of counts are missing."""
    n = counts.groupBy("lang").agg(*(F.count(F.when(F.col("n") == i, 1)).alias(f"n{i}") for i in range(1, 5)))
    y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))

    def discount(i: int) -> Column:
        whole = (F.col(f"n{i}") > 0) & (F.col("n1") > 0)
        value = F.when(whole, i - (i + 1) * y * F.col(f"n{i + 1}") / F.col(f"n{i}")).otherwise(i / 2)
        return F.greatest(F.lit(0.0), F.least(F.lit(float(i)), value))

    return n.select("lang", *(discount(i).alias(f"d{i}") for i in range(1, 4)))


def _model(counts: DataFrame) -> tuple[DataFrame, int]:
    """lang, gram, p of every counted 5-gram, and the bytes of all words and their ends.

    Orders are built from the shortest up: what an order's discounts free in a context goes to the next shorter one.
    """
    tables = {ORDER: materialize(counts.select("lang", "gram", "n"), "grams")}
    n_bytes = tables[ORDER].agg(F.sum("n")).first()[0] or 0
    for size in range(ORDER - 1, 0, -1):
        shorter = F.col("gram").bitwiseAND((1 << 8 * size) - 1)
        tables[size] = materialize(tables[size + 1].groupBy("lang", shorter.alias("gram")).agg(F.count("*").alias("n")), "grams")
    lower = None
    for size in range(1, ORDER + 1):
        context = Window.partitionBy("lang", "context")
        rows = tables[size].join(F.broadcast(_discounts(tables[size])), "lang")
        d = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
        rows = rows.select("lang", "gram", "n", d.alias("d"), F.shiftright("gram", 8).alias("context"),
                           F.col("gram").bitwiseAND((1 << 8 * (size - 1)) - 1).alias("short"))
        rows = rows.withColumn("all", F.sum("n").over(context)).withColumn("share", F.sum("d").over(context) / F.col("all"))
        if lower is None:
            rows = rows.withColumn("q", F.lit(1 / 256))
        else:
            rows = rows.join(lower.select("lang", F.col("gram").alias("short"), F.col("p").alias("q")), ["lang", "short"])
        p = (F.col("n") - F.col("d")) / F.col("all") + F.col("share") * F.col("q")
        lower = materialize(rows.select("lang", "gram", p.alias("p")), "model")
    return lower, n_bytes


class HashArrays:
    """N-grams as sorted 64-bit hashes (a bijection of their bytes) beside the logarithms of their probabilities."""

    def __init__(self, grams: np.ndarray, p: np.ndarray):
        key = mix64(grams.astype(np.uint64))
        order = np.argsort(key)
        self.keys, self.logs = key[order], np.log(p[order])
        # where the hashes with the same first bits begin
        self.bits = max(1, int(np.log2(len(key) + 1)))
        self.begin = np.searchsorted(self.keys, np.arange(1 << self.bits, dtype=np.uint64) << np.uint64(64 - self.bits))

    def find(self, grams: np.ndarray) -> np.ndarray:
        """The logarithms of n-grams that are all there."""
        key = mix64(grams.astype(np.uint64))
        at = self.begin[key >> np.uint64(64 - self.bits)]
        going = np.arange(len(key))
        while len(going):  # a few steps: the hashes are spread evenly
            going = going[self.keys[at[going]] < key[going]]
            at[going] += 1
        return self.logs[at]


# ---- base rules ------------------------------------------------------------------------------------------------

def repeated_words(words: list[list[bytes]]) -> np.ndarray:
    """For each text, the words in windows of five that its words hold twice or more."""
    sizes = np.array([len(x) for x in words], np.int64)
    out = np.zeros(len(words), np.int64)
    total = int(sizes.sum())
    if total < WINDOW_WORDS:
        return out
    value = np.fromiter(map(hash, chain.from_iterable(words)), np.int64, total).view(np.uint64)
    text = np.repeat(np.arange(len(words)), sizes)
    n = total - WINDOW_WORDS + 1
    window = text[:n].astype(np.uint64)
    for i in range(WINDOW_WORDS):
        window = mix64(window + value[i:i + n])
    inside = np.flatnonzero(text[:n] == text[WINDOW_WORDS - 1:])
    order = inside[np.argsort(window[inside])]
    same = window[order][1:] == window[order][:-1]
    twice = np.concatenate([order[1:][same], order[:-1][same]])
    cover = np.zeros(total + 1, np.int64)
    twice = np.unique(twice)
    cover[twice] += 1
    np.subtract.at(cover, twice + WINDOW_WORDS, 1)
    covered = np.cumsum(cover[:-1]) > 0
    return np.bincount(text[covered], minlength=len(words))


def _base(texts: list[str], words: list[list[bytes]]) -> dict[str, np.ndarray]:
    lines = [[x for x in text.split("\n") if x.strip(SPACES)] for text in texts]
    found = (
        [len(x) for x in words],
        [len(x) - sum(map(x.count, SPACES)) for x in texts],
        [sum(map(x.count, SYMBOLS)) for x in texts],
        [len(x) - len(set(x)) for x in lines],
        repeated_words(words))
    return {k: np.asarray(v, np.int64) for k, v in zip(STATS, found, strict=True)}


def _runs(log_p: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    starts = RUN_WORDS * np.arange(max(1, len(log_p) // RUN_WORDS))
    return -np.add.reduceat(log_p, starts) / np.add.reduceat(sizes + 1, starts)


def middle_run(log_p: np.ndarray, sizes: np.ndarray) -> float:
    """The median cross entropy of a text's runs of words; what is left over belongs to the last run."""
    return float(np.median(_runs(log_p, sizes))) if len(log_p) else 0.0


def entropies(log_p: np.ndarray, sizes: np.ndarray) -> tuple[float, float, float]:
    """Cross entropy of the middle run, of all words, and of the run at TAIL (the lower one of two)."""
    if not len(log_p):
        return 0.0, 0.0, 0.0
    runs = np.sort(_runs(log_p, sizes))
    return float(np.median(runs)), float(-log_p.sum() / (sizes + 1).sum()), float(runs[int(TAIL * (len(runs) - 1))])


class _Chunk:
    """The rows of a chunk in batches, and the distinct 5-grams of its languages in the order of (bucket, gram)."""

    def __init__(self, rows: pa.Table, lang_col: str, text_col: str, buckets: int):
        self.rows = list(small_batches(map(pa.RecordBatch.from_struct_array, rows["row"].chunks), text_col))
        self.text_col, self.words, self.langs = text_col, {}, []
        for batch in self.rows:
            self.langs.append([x or "" for x in batch.column(lang_col).cast(pa.string()).to_pylist()])
            for lang, own in zip(self.langs[-1], self.split(batch)[1], strict=True):
                self.words.setdefault(lang, set()).update(own)
        self.buckets = buckets

    def split(self, batch: pa.RecordBatch) -> tuple[list[str], list[list[bytes]]]:
        texts = [x or "" for x in batch.column(self.text_col).cast(pa.string()).to_pylist()]
        return texts, [x.encode().split() for x in texts]

    def grams(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct 5-grams and their buckets, the place among these of each word's 5-grams, and their number a word."""
        found, sizes = word_grams(words)
        grams, place = np.unique(found, return_inverse=True)
        bucket = grams % PRIME % self.buckets
        order = np.argsort(bucket, kind="stable")
        rank = np.empty_like(order)
        rank[order] = np.arange(len(order))
        return grams[order], bucket[order], rank[place], sizes


def _ask(lang_col: str, text_col: str, buckets: int):
    """chunk, lang, bucket, asked: the distinct 5-grams of a chunk, as differences."""
    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        out = {"chunk": [], "lang": [], "bucket": [], "asked": []}
        chunk = _Chunk(rows, lang_col, text_col, buckets)
        for lang, words in chunk.words.items():
            if not words:
                continue
            grams, bucket, _, _ = chunk.grams(list(words))
            at = np.flatnonzero(np.diff(bucket, prepend=-1))
            for a, b in zip(at.tolist(), [*at[1:].tolist(), len(grams)], strict=True):
                out["chunk"].append(key[0].as_py())
                out["lang"].append(lang)
                out["bucket"].append(int(bucket[a]))
                out["asked"].append(np.diff(grams[a:b], prepend=0).tobytes())
        del chunk
        give_back()
        return pa.table(out, pa.schema([("chunk", pa.int64()), ("lang", pa.string()), ("bucket", pa.int64()), ("asked", pa.binary())]))
    return run


def _answer(asked: pa.Table, model: pa.Table) -> pa.Table:
    """The logarithms of the probabilities of the asked 5-grams, all of which the model has."""
    table = HashArrays(model["gram"].to_numpy(), model["p"].to_numpy())
    found = [table.find(np.cumsum(np.frombuffer(x, np.int64))).tobytes() for x in asked["asked"].to_pylist()]
    return asked.select(["chunk", "lang", "bucket"]).append_column("log_p", pa.array(found, pa.binary()))


def _score(lang_col: str, text_col: str, keep: list[str], buckets: int, schema: pa.Schema):
    """row, language, the base statistics, the score and its bytes, from a chunk's rows and the answers to it."""
    def run(rows: pa.Table, answers: pa.Table) -> pa.Table:
        chunk, logs, out = _Chunk(rows, lang_col, text_col, buckets), {}, []
        for r in sorted(answers.select(["lang", "bucket", "log_p"]).to_pylist(), key=lambda r: r["bucket"]):
            logs.setdefault(r["lang"], []).append(r["log_p"])
        scores = {}
        for lang, words in chunk.words.items():
            words = list(words)
            if words:
                _, _, place, sizes = chunk.grams(words)
                each = np.frombuffer(b"".join(logs.pop(lang)))[place]
                scores[lang] = dict(zip(words, np.add.reduceat(each, np.cumsum(sizes) - sizes).tolist(), strict=True))
        for batch, langs in zip(chunk.rows, chunk.langs, strict=True):
            texts, words = chunk.split(batch)
            found = [entropies(np.fromiter(map(scores[lang].__getitem__, own), float, len(own)),
                               np.fromiter(map(len, own), float, len(own))) if own else (0.0, 0.0, 0.0)
                     for lang, own in zip(langs, words, strict=True)]
            base = _base(texts, words)
            n_bytes = np.array([sum(map(len, x)) + len(x) for x in words], np.int64)
            row = pa.StructArray.from_arrays([batch.column(x) for x in keep], fields=[batch.schema.field(x) for x in keep])
            out.append(pa.RecordBatch.from_arrays(
                [row, pa.array(langs), *(pa.array(base[x]) for x in STATS), *(pa.array(x, pa.float64()) for x in zip(*found, strict=True)),
                 pa.array(n_bytes)], ["row", "lang", *STATS, *JUDGED, "n_bytes"]))
        del chunk, scores, logs
        give_back()
        return pa.Table.from_batches(out) if out else schema.empty_table()
    return run


def _chunked(df: DataFrame, used: list[str], n_bytes: int) -> DataFrame:
    """chunk, row: the used columns, dealt by a hash of the whole row."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = max(1, n_bytes // CHUNK_BYTES, min(partitions, n_bytes // LEAST_CHUNK_BYTES))
    hashed = [col(x.name) for x in df.schema if not any(t in x.dataType.simpleString() for t in ("map<", "variant"))]
    chunk = F.pmod(F.xxhash64(*hashed), F.lit(chunks))
    return df.select(chunk.alias("chunk"), F.struct(*map(col, used)).alias("row")).repartition("chunk")


def _scored(df: DataFrame, lang_col: str, text_col: str, keep: list[str]) -> DataFrame:
    model, n_bytes = _model(count_grams(df, lang_col, text_col))
    buckets = model.count() // BUCKET_GRAMS + 1
    docs = _chunked(df, list(dict.fromkeys([*keep, lang_col, text_col])), n_bytes)
    # both uses of the rows take all their columns, so that they share one exchange
    asked = docs.groupBy("chunk").applyInArrow(_ask(lang_col, text_col, buckets), "chunk long, lang string, bucket long, asked binary")
    model = model.select("lang", (F.col("gram") % PRIME % buckets).alias("bucket"), "gram", "p")
    answers = asked.groupBy("lang", "bucket").cogroup(model.groupBy("lang", "bucket")).applyInArrow(
        _answer, "chunk long, lang string, bucket long, log_p binary")
    fields = [T.StructField("row", T.StructType([df.schema[x] for x in keep])), T.StructField("lang", T.StringType()),
              *(T.StructField(x, T.LongType()) for x in STATS), *(T.StructField(x, T.DoubleType()) for x in JUDGED),
              T.StructField("n_bytes", T.LongType())]
    schema = T.StructType(fields)
    score = _score(lang_col, text_col, keep, buckets, to_arrow_schema(schema))
    return materialize(docs.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(score, schema), "scored")


def _length_class(n_bytes: str) -> Column:
    return F.floor(F.log2(F.greatest(F.lit(1), F.col(n_bytes)))).cast("int")


def _spread(rows: DataFrame, keys: list[str]) -> DataFrame:
    """keys, and of each judged value a struct of its middle and deviation."""
    def band(x: str) -> Column:
        q = F.col(f"_q_{x}")
        return F.struct(q[1].alias("middle"), ((q[2] - q[0]) / 1.349).alias("deviation")).alias(f"{x}_band")

    return exact_quantiles(rows, JUDGED, (0.25, 0.5, 0.75), keys).select(*keys, *map(band, JUDGED))


def bands(scored: DataFrame) -> DataFrame:
    """lang, class, score_band, whole_band, tail_band: one row a language and length class of the documents."""
    rows = scored.where(~F.col("base_failed")).select("lang", _length_class("n_bytes").alias("class"), *JUDGED, "n_bytes")
    rows = materialize(rows.distinct(), "scores")
    sizes = rows.groupBy("lang", "class").agg(F.count("*").alias("n"))
    full = sizes.where(F.col("n") >= CLASS_ROWS).join(_spread(rows, ["lang", "class"]), ["lang", "class"])
    full = full.withColumnRenamed("class", "of").drop("n")
    wider = F.pow(F.lit(2.0), F.greatest(F.lit(0), F.col("of") - F.col("class")) / 2)
    values = [F.col(f"{x}_band").withField("deviation", F.col(f"{x}_band.deviation") * wider).alias(f"{x}_band") for x in JUDGED]
    near = sizes.select("lang", "class").join(full, "lang").groupBy("lang", "class").agg(F.min_by(
        F.struct(*values), F.struct(F.abs(F.col("of") - F.col("class")), "of")).alias("x")).select("lang", "class", "x.*")
    rest = sizes.select("lang", "class").join(_spread(rows, ["lang"]), "lang").join(near, ["lang", "class"], "left_anti")
    return near.unionByName(rest)


def judge(df: DataFrame, text_col: str = "text", lang_col: str = "lang", keep: list[str] | None = None) -> DataFrame:
    """row (the kept columns, all by default), base statistics, base_failed, score, low, high, whole, tail and kept."""
    rows = _scored(df, lang_col, text_col, df.columns if keep is None else keep)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    rows = rows.select("*", failed.alias("base_failed"), _length_class("n_bytes").alias("class"))
    found = rows.join(F.broadcast(bands(rows)), ["lang", "class"], "left")
    least = LEAST_DEVIATION / F.sqrt(F.greatest(F.lit(1), F.col("n_bytes")))

    def end(x: str, sign: int) -> Column:
        return F.col(f"{x}_band.middle") + sign * WIDTH * F.greatest(least, F.col(f"{x}_band.deviation"))

    found = found.select("*", end("score", -1).alias("low"), end("score", 1).alias("high"))
    kept = (~F.col("base_failed") & F.col("score").between(F.col("low"), F.col("high"))
            & (F.col("whole") <= end("whole", 1)) & (F.col("tail") <= end("tail", 1)))
    return found.select("row", *STATS, "base_failed", "score", "low", "high", "whole", "tail",
                        F.coalesce(kept, F.lit(False)).alias("kept"))

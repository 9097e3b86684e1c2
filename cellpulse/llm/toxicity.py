"""Toxicity by subword-bag embeddings averaged into a linear softmax.

A word is a bag of hashed character n-grams (with word boundaries) and itself;
its vector is the mean of their embeddings.  A window of ``WINDOW`` words is the
mean of its words' vectors, which a linear softmax over two classes turns into
a logit; a text scores by its most toxic window, so a few words count in a text
of any length.  Embeddings and softmax weights are trained jointly in numpy
(Adam, whole-sample gradients).  A misspelling that no training text holds shares
n-grams, and so their vectors, with the words it comes from.

Training uses a bounded sample: per class at most ``PER_CLASS[label]`` labelled
rows in hash order, of texts up to ``TRAIN_CHARS`` characters.  Scoring reads
every whole text.  After training an n-gram's contribution to the logit is one
number, so tasks get a table of ``BUCKETS`` floats.

Defined cases: null text counts as empty; an empty text has no window and gets
the model's bias alone; without labelled rows of both classes the score is the
labelled share of label 1 (0 without labels); labels of repeated or unknown ids
are taken as they are; null labels are skipped; other columns are never read.
"""
from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import small_batches

BUCKETS, DIM, GRAMS = 1 << 18, 8, (3, 4, 5)
WINDOW, STRIDE = 48, 16
PER_CLASS, TRAIN_CHARS = {0: 2500, 1: 1500}, 20_000
STEPS, WARM_STEPS, RATE, DECAY = 160, 40, 0.05, 1e-6
THRESHOLD = 0.3
#: Longer tokens are read in pieces of this many characters; a task's word cache is emptied beyond this size.
PIECE, CACHE_WORDS = 40, 300_000
#: Texts whose words are looked up together have about so many characters.
PART_CHARS = 1 << 18
_EDGES = re.compile(r"^\W+|\W+$")


def tokens(text: str) -> list[str]:
    words = text.lower().split()
    if max(map(len, words), default=0) > PIECE:
        words = [w[i:i + PIECE] for w in words for i in range(0, len(w), PIECE)]
    return words


def marked(token: str) -> str:
    return "<" + (_EDGES.sub("", token) or token) + ">"


def buckets(token: str) -> list[int]:
    """The hashed n-grams of a token, and the word itself."""
    word = marked(token)
    crc, mask = zlib.crc32, BUCKETS - 1
    out = [crc(word.encode()) & mask]
    for n in GRAMS:
        out += [crc(word[i:i + n].encode()) & mask for i in range(len(word) - n + 1)]
    return out


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_CRC, _ONES = _crc_table(), np.uint32(0xFFFFFFFF)


def all_buckets(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """:func:`buckets` of every word one after another, and how many each word has.

    The CRC of all n-grams of one length is carried on by a character to those of the next length."""
    if not words:
        return np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int64)
    inner = [marked(w) for w in words]
    text = "".join(inner)
    raw = np.frombuffer(text.encode(), dtype=np.uint8)
    width = np.diff(np.flatnonzero((raw & 0xC0) != 0x80), append=len(raw))  # bytes a character
    at = np.cumsum(width) - width
    lengths = np.fromiter(map(len, inner), dtype=np.int64, count=len(inner))
    first = np.cumsum(lengths) - lengths
    counts = {n: np.maximum(0, lengths - n + 1) for n in GRAMS}
    sizes = 1 + sum(counts.values())
    place = np.cumsum(sizes) - sizes
    out, mask = np.empty(int(sizes.sum()), dtype=np.int32), np.uint32(BUCKETS - 1)
    out[place] = np.fromiter((zlib.crc32(w.encode()) & (BUCKETS - 1) for w in inner), dtype=np.int32, count=len(inner))
    place += 1
    state = np.full(len(width), _ONES)
    for n in range(1, max(GRAMS) + 1):
        state = state[:len(width) - n + 1]
        wide, start = width[n - 1:], at[n - 1:]
        state = _CRC[(state ^ raw[start]) & 255] ^ (state >> 8)
        for byte in range(1, int(wide.max(initial=1))):
            more = np.flatnonzero(wide > byte)
            part = state[more]
            state[more] = _CRC[(part ^ raw[start[more] + byte]) & 255] ^ (part >> 8)
        if n in counts:
            c = counts[n]
            step = np.arange(int(c.sum())) - np.repeat(np.cumsum(c) - c, c)
            out[np.repeat(place, c) + step] = (state[np.repeat(first, c) + step] ^ _ONES) & mask
            place += c
    return out, sizes


def windows(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the windows over ``n`` words: every word lies in one."""
    if n <= WINDOW:
        return np.zeros(1, dtype=np.int64), np.array([n], dtype=np.int64)
    starts = np.append(np.arange(0, n - WINDOW, STRIDE), n - WINDOW)
    return starts, starts + WINDOW


def held_out(id_col: str | Column) -> Column:
    col = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % 4 == 2


class Model:
    """Per-bucket contributions to the logit of label 1 and the bias."""

    def __init__(self, table: np.ndarray, bias: float):
        self.table, self.bias = table, bias

    def scorer(self):
        """Logits of a list of texts; the words that the cache lacks are hashed together."""
        cache: dict[str, float] = {}

        def learn(words: set[str]) -> None:
            new = [w for w in words if w not in cache]
            if len(cache) + len(new) > CACHE_WORDS:
                cache.clear()
                new = list(words)
            ids, sizes = all_buckets(new)
            if new:  # long doubles hold these sums of single floats whole
                sums = np.add.reduceat(self.table[ids].astype(np.longdouble), np.cumsum(sizes) - sizes)
                cache.update(zip(new, (sums.astype(np.float64) / sizes).tolist()))

        def logit(words: list[str]) -> float:
            if not words:
                return self.bias
            total = np.concatenate([[0.0], np.cumsum(list(map(cache.__getitem__, words)))])
            a, b = windows(len(words))
            return self.bias + float(((total[b] - total[a]) / (b - a)).max())

        def logits(texts: list[str]) -> list[float]:
            split = [tokens(t) for t in texts]
            learn(set().union(*split))
            return [logit(words) for words in split]

        return lambda texts: logits([texts])[0] if isinstance(texts, str) else logits(texts)


def train(texts: list[str], labels: list[int], seed: int = 7) -> Model:
    """Joint training of embeddings (BUCKETS x DIM) and softmax weights (DIM x 2)."""
    y = np.array(labels, dtype=np.float64)
    if len(set(labels)) < 2:
        share = float(y.mean()) if len(y) else 0.0
        return Model(np.zeros(BUCKETS, dtype=np.float32), float(np.log((share + 1e-9) / (1 - share + 1e-9))))
    vocab: dict[str, int] = {}
    docs = [np.fromiter((vocab.setdefault(w, len(vocab)) for w in tokens(t)), dtype=np.int32) for t in texts]
    flat, sizes = all_buckets(list(vocab))
    begins, per_word = np.cumsum(sizes) - sizes, np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    flow = np.concatenate(docs)
    first = np.cumsum([0, *map(len, docs)])
    spans = [windows(len(d)) for d in docs]
    a = np.concatenate([s + o for (s, _), o in zip(spans, first)])
    b = np.concatenate([e + o for (_, e), o in zip(spans, first)])
    owner = np.repeat(np.arange(len(docs)), [len(s) for s, _ in spans])
    group = np.flatnonzero(np.diff(owner, prepend=-1))
    filled = np.array([len(d) > 0 for d in docs])
    rng = np.random.default_rng(seed)
    used = np.unique(flat)
    place = np.zeros(BUCKETS, dtype=np.int32)
    place[used] = np.arange(len(used))
    flat = place[flat]
    params = {"E": rng.normal(0, 0.1, (len(used), DIM)), "W": rng.normal(0, 0.5, (DIM, 2)), "b": np.zeros(2)}
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in params.items()}
    for step in range(1, STEPS + 1):
        E, W, bias = params["E"], params["W"], params["b"]
        diff = W[:, 1] - W[:, 0]
        word = np.add.reduceat((E @ diff)[flat], begins) / sizes
        total = np.concatenate([[0.0], np.cumsum(word[flow])])
        if step <= WARM_STEPS:  # whole texts first, then each text's most toxic window
            lo, hi = first[:-1], first[1:]
        else:
            mean = (total[b] - total[a]) / np.maximum(1, b - a)
            top = np.maximum.reduceat(mean, group)
            at = np.flatnonzero(mean == top[owner])
            pick = at[np.unique(owner[at], return_index=True)[1]]
            lo, hi = a[pick], b[pick]
        size = np.maximum(1, hi - lo)
        z = (total[hi] - total[lo]) / size + bias[1] - bias[0]
        g = (1 / (1 + np.exp(-z)) - y) / len(y)
        each = np.zeros(len(flow) + 1)
        np.add.at(each, lo[filled], (g / size)[filled])
        np.add.at(each, hi[filled], -(g / size)[filled])
        per_token = np.cumsum(each[:-1])
        d_word = np.bincount(flow, per_token, minlength=len(sizes)) / sizes
        d_bucket = np.bincount(flat, d_word[per_word], minlength=len(used))
        d_w = E.T @ d_bucket
        grads = {"E": np.outer(d_bucket, diff) + DECAY * E, "W": np.stack([-d_w, d_w], axis=1),
                 "b": np.array([-g.sum(), g.sum()])}
        for k, v in params.items():
            m, s = moments[k]
            m += 0.1 * (grads[k] - m)
            s += 0.01 * (grads[k] ** 2 - s)
            v -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-9)
    table = np.zeros(BUCKETS, dtype=np.float32)
    table[used] = params["E"] @ (params["W"][:, 1] - params["W"][:, 0])
    return Model(table, float(params["b"][1] - params["b"][0]))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Train on a bounded sample of labelled rows that are not held out."""
    known = labels.select(F.col("doc_id").alias("l_id"), F.col("toxic").cast("int").alias("toxic")).where(
        F.col("toxic").isin(0, 1) & F.col("l_id").isNotNull() & ~held_out("l_id"))
    order = (F.xxhash64(F.col("l_id").cast("string"), F.lit(11)), "l_id")
    sample = None
    for label, most in PER_CLASS.items():  # at most this many ids: a bounded broadcast
        part = known.where(F.col("toxic") == label).orderBy(*order).limit(most)
        sample = part if sample is None else sample.unionByName(part)
    rows = (docs.select(F.col(id_col).alias("d_id"), F.col(text_col).alias("text"))
            .where(F.length("text") <= TRAIN_CHARS).join(F.broadcast(sample), F.col("d_id") == F.col("l_id"))
            .select("text", "toxic", F.xxhash64("text").alias("h"))
            .orderBy("h", "toxic").limit(2 * sum(PER_CLASS.values())).collect())
    return train([r["text"] for r in rows], [r["toxic"] for r in rows])


def parts(texts: list[str]) -> Iterator[list[str]]:
    """Neighbouring texts of about ``PART_CHARS`` characters together; a longer text comes alone."""
    part, size = [], 0
    for text in texts:
        if part and size + len(text) > PART_CHARS:
            yield part
            part, size = [], 0
        part.append(text)
        size += len(text)
    if part:
        yield part


def scored(docs: DataFrame, model: Model, text_col: str, keep: list[str]) -> DataFrame:
    """The columns ``keep`` and ``score`` for every row, whole texts."""
    held = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS floats
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logits = held.value.scorer()
        for batch in batches:
            texts = [t or "" for t in batch.column(len(keep)).to_pylist()]
            z = np.array([v for part in parts(texts) for v in logits(part)], dtype=np.float64)
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keep))),
                                              pa.array(1 / (1 + np.exp(-np.clip(z, -60, 60))))],
                                             names=[f"c{i}" for i in range(len(keep))] + ["score"])

    row = docs.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)), F.col(text_col).alias("t"))
    schema = T.StructType([*row.schema.fields[:len(keep)], T.StructField("score", T.DoubleType())])
    return row.mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    model = fit(docs, labels, id_col, text_col)
    out = scored(docs, model, text_col, [id_col])
    return out.select(F.col("c0").alias("doc_id"), held_out("c0").alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def clean(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not rejected, with all their columns."""
    model = fit(docs, labels, id_col, text_col)
    out = scored(docs, model, text_col, docs.columns).where(F.col("score") < THRESHOLD)
    return out.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)))

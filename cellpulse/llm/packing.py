"""Packing documents into training sequences by cutting-stock column generation.

1. Tasks tokenize whole documents and cut only where a piece would exceed a
   sequence, so a document of n ids gives floor(n / 2048) full pieces and a rest.
2. The pieces' lengths form a histogram of at most ``SEQUENCE / GRAIN`` classes
   (lengths rounded up to ``GRAIN`` tokens), whatever the input's size.
3. A linear program over *patterns* (how many pieces of each class one sequence
   takes) minimises the number of sequences.  It starts with one-class
   patterns; a knapsack dynamic program prices new patterns by the dual values
   until none improves the bound by more than ``GAP``.
4. Pattern counts are rounded down; the few pieces left over (less than one
   pattern per class) are packed best-fit decreasing.
5. The pieces of a class are ranked; ranks 0, 1, 2, ... fill the class's places
   pattern by pattern, which gives each piece its sequence.

Only the histogram (at most 512 rows) reaches the driver.  Ranks need no global
sort and no task sees a class: pieces are numbered within (class, hash block)
and offset by the blocks' counts.

Defined cases: null text is empty and gives one piece with the end id alone;
rows that repeat are packed again; a null id is an id; an empty table gives no
piece; other columns are ignored.  A sequence of exactly a power of two of
tokens needs no padding, every other one is padded to ``SEQUENCE``.
Skew: full pieces may be most rows; their class is split into ``RANK_BLOCKS``.
"""
from __future__ import annotations

import base64
import json
import re
import zlib
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import small_batches, stored

SEQUENCE, END_ID, GRAIN = 2048, 1, 4
GAP, PIVOT_LIMIT, RANK_BLOCKS = 0.0005, 6000, 1024
VOCABULARY, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"
#: Texts of other characters or beyond this length go to `tokenizers` itself.
_COMMON, _LONG = re.compile("[^\x00-⁯]"), 1_000_000


def added_tokens(vocabulary: str) -> list[dict]:
    """The added tokens of a ``tokenizers`` file, without building its merges."""
    with open(vocabulary, encoding="utf-8") as file:
        text = file.read()
    key = re.search(r'"added_tokens"\s*:\s*', text)
    return json.JSONDecoder().raw_decode(text, key.end())[0] if key else []


class Encoder:
    """Ids as ``tokenizers`` gives them without added special tokens.  Plain texts take the same
    vocabulary's rank file in ``tiktoken``, which gives the same ids several times faster; ``tokenizers``
    itself is loaded with the first text that needs it."""

    def __init__(self, vocabulary: str | None = None, ranks: str | None = None):
        import public_tokenizers
        import tiktoken
        self.path, ranks = vocabulary or public_tokenizers.path(VOCABULARY), ranks or public_tokenizers.path(RANKS)
        with open(ranks, "rb") as lines:
            merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        special = {t["content"]: t["id"] for t in added_tokens(self.path)}
        self.fast = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges,
                                      special_tokens=special)

    @cached_property
    def slow(self):
        from tokenizers import Tokenizer
        return Tokenizer.from_file(self.path)

    def ids(self, text: str) -> np.ndarray:
        if len(text) > _LONG or _COMMON.search(text):
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, dtype="<u4")
        return self.fast.encode_to_numpy(text, allowed_special="all").astype("<u4", copy=False)


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False,
           vocabulary: str | None = None, ranks: str | None = None) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens (and ids as little-endian uint32 with ``keep_ids``)."""
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * keep_ids
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary, ranks)
        for batch in batches:
            row, start, length, crc, total, raw = [], [], [], [], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                ids = np.append(encoder.ids(text or ""), np.uint32(END_ID)).astype("<u4")
                for a in range(0, len(ids), SEQUENCE):
                    part = ids[a:a + SEQUENCE].tobytes()
                    row.append(i)
                    start.append(a)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    total.append(len(ids))
                    if keep_ids:
                        raw.append(part)
            cols = [batch.column(0).take(pa.array(row, pa.int64())), *(pa.array(c, pa.int64())
                                                                       for c in (start, length, crc, total))]
            yield pa.RecordBatch.from_arrays(cols + [pa.array(raw, pa.binary())] * keep_ids, names=names)

    schema = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType)]
                          + [T.StructField(n, T.LongType()) for n in names[1:5]]
                          + [T.StructField("ids", T.BinaryType())] * keep_ids)
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def best_pattern(sizes: np.ndarray, values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack by dynamic programming: the most valuable pattern and its class counts."""
    worth = values > 0
    index, size, value = np.flatnonzero(worth), sizes[worth], values[worth]
    order = np.argsort(size, kind="stable")
    index, size, value = index[order], size[order], value[order]
    best, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    fits = np.searchsorted(size, np.arange(capacity + 1), side="right")
    for c in range(1, capacity + 1):
        best[c], n = best[c - 1], fits[c]
        if n:
            gain = value[:n] + best[c - size[:n]]
            j = int(gain.argmax())
            if gain[j] > best[c] + 1e-12:
                best[c], last[c] = gain[j], j
    counts, c = np.zeros(len(sizes), dtype=np.int64), capacity
    while c > 0:
        if last[c] < 0:
            c -= 1
        else:
            counts[index[last[c]]] += 1
            c -= int(size[last[c]])
    return float(best[capacity]), counts


def column_generation(sizes: np.ndarray, demand: np.ndarray, capacity: int, gap: float = GAP,
                      pivots: int = PIVOT_LIMIT) -> list[tuple[np.ndarray, float]]:
    """min sum x over patterns that cover the demand: [(class counts, x)], by the revised simplex method."""
    m, scale = len(sizes), float(demand.sum())
    d = demand / scale
    basis = [np.eye(m, dtype=np.int64)[i] * (capacity // int(sizes[i])) for i in range(m)]
    cost = np.ones(m)
    inverse = np.diag([1.0 / b.max() for b in basis])
    x, bound = inverse @ d, 0.0
    for step in range(pivots):
        duals = cost @ inverse
        if duals.min() < -1e-9:  # a surplus column: this class may be covered more than asked
            i = int(duals.argmin())
            column, c = -np.eye(m, dtype=np.int64)[i], 0.0
        else:
            worth, column = best_pattern(sizes, duals, capacity)
            c, total = 1.0, float(cost @ x)
            bound = max(bound, total / max(worth, 1.0))
            if worth <= 1 + 1e-9 or total - bound <= gap * total:
                break
        w = inverse @ column
        up = w > 1e-10
        if not up.any():
            break
        ratio = np.full(m, np.inf)
        ratio[up] = x[up] / w[up]
        r = int(ratio.argmin())
        basis[r], cost[r] = column, c
        if step % 100 == 99:  # fresh inverse against rounding errors
            inverse = np.linalg.inv(np.array(basis, dtype=np.float64).T)
        else:
            inverse[r] /= w[r]
            w[r] = 0.0
            inverse -= np.outer(w, inverse[r])
        x = np.maximum(inverse @ d, 0.0)
    return [(b, float(v) * scale) for b, v, c in zip(basis, x, cost) if c and v > 0]


def best_fit(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[np.ndarray]:
    """Best-fit decreasing of the (few) left-over pieces: one pattern per sequence."""
    room: list[list[np.ndarray]] = [[] for _ in range(capacity + 1)]
    filled = []
    for i in np.argsort(-sizes, kind="stable"):
        for _ in range(int(demand[i])):
            free = next((f for f in range(int(sizes[i]), capacity + 1) if room[f]), None)
            if free is None:
                pattern, free = np.zeros(len(sizes), dtype=np.int64), capacity
                filled.append(pattern)
            else:
                pattern = room[free].pop()
            pattern[i] += 1
            room[free - int(sizes[i])].append(pattern)
    return filled


def plan(histogram: dict[int, int], capacity: int = SEQUENCE // GRAIN) -> pd.DataFrame:
    """Places for the ranked pieces of each class: cls, rank_from, rank_to, per sequence, first sequence."""
    if not histogram:
        return pd.DataFrame({"cls": [], "rank_from": [], "rank_to": [], "per": [], "first": []}).astype("int64")
    sizes = np.array(sorted(histogram), dtype=np.int64)
    demand = np.array([histogram[int(s)] for s in sizes], dtype=np.int64)
    used = [(p, int(x + 1e-7)) for p, x in column_generation(sizes, demand, capacity)]
    used = [(p, n) for p, n in used if n]
    rest = demand - sum((p * n for p, n in used), np.zeros_like(demand))
    used += [(p, 1) for p in best_fit(sizes, np.maximum(rest, 0), capacity)]
    rows, filled, first = [], np.zeros_like(demand), 0
    for pattern, n in used:
        for i in np.flatnonzero(pattern):
            per = int(pattern[i])
            upto = min(int(filled[i]) + per * n, int(demand[i]))
            if upto > filled[i]:
                rows.append((int(sizes[i]), int(filled[i]), upto, per, first))
                filled[i] = upto
        first += n
    return pd.DataFrame(rows, columns=["cls", "rank_from", "rank_to", "per", "first"])


def pack(cut: DataFrame, keys: tuple[str, ...] = ("doc_id", "start", "ids_crc32")) -> DataFrame:
    """A stored table of pieces (with ``length``) plus sequence_id and offset."""
    cls = F.ceil(F.col("length") / GRAIN).cast("long")
    counted = cut.groupBy(cls.alias("cls")).agg(F.count(F.lit(1)).alias("n")).collect()  # at most SEQUENCE / GRAIN rows
    places = plan({r["cls"]: r["n"] for r in counted})
    spark = cut.sparkSession
    places = spark.createDataFrame(list(places.itertuples(index=False, name=None)) or [],
                                   "p_cls long, rank_from long, rank_to long, per long, first long")
    blocked = cut.withColumn("cls", cls).withColumn(
        "block", F.pmod(F.xxhash64(*keys), F.lit(RANK_BLOCKS)).cast("int"))
    counts = blocked.groupBy("cls", "block").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("cls").orderBy("block")
    counts = counts.select("cls", "block", (F.sum("n").over(before) - F.col("n")).alias("before"))
    within = Window.partitionBy("cls", "block").orderBy("length", *keys)
    # counts: at most SEQUENCE / GRAIN * RANK_BLOCKS short rows; places: a few per class
    ranked = (blocked.withColumn("rank", F.row_number().over(within) - 1)
              .join(F.broadcast(counts), ["cls", "block"]).withColumn("rank", F.col("rank") + F.col("before")))
    spot = (F.col("cls") == F.col("p_cls")) & (F.col("rank") >= F.col("rank_from")) & (F.col("rank") < F.col("rank_to"))
    placed = ranked.join(F.broadcast(places), spot).withColumn(
        "sequence_id", F.col("first") + F.expr("(rank - rank_from) div per"))
    inside = Window.partitionBy("sequence_id").orderBy(F.desc("cls"), "rank")
    offset = F.sum("length").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("length")
    return placed.select(*cut.columns, "sequence_id", offset.alias("offset"))


def sequences(packed: DataFrame, pad_id: int = 0) -> DataFrame:
    """The sequences themselves from packed pieces with ``ids``: sequence_id, ids (padded), tokens, starts."""
    def lay(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("offset")
        ids = np.concatenate([np.frombuffer(x, dtype="<u4") for x in rows["ids"]])
        width = len(ids) if len(ids) & (len(ids) - 1) == 0 else SEQUENCE
        out = np.full(width, pad_id, dtype=np.int32)
        out[:len(ids)] = ids
        return pd.DataFrame({"sequence_id": [rows["sequence_id"].iloc[0]], "ids": [out], "tokens": [len(ids)],
                             "starts": [rows["offset"].to_numpy(np.int32)]})
    return (packed.select("sequence_id", "offset", "ids").groupBy("sequence_id")
            .applyInPandas(lay, "sequence_id long, ids array<int>, tokens int, starts array<int>"))


def query(docs: DataFrame) -> DataFrame:
    return pack(stored(pieces(docs), "pieces"))

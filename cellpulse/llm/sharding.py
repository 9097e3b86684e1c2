"""Sharding by a Feistel permutation with cycle walking over global row numbers.

Every row gets a global number 0..N-1.  A keyed balanced Feistel network
permutes the smallest even-bit domain that holds N; values outside 0..N-1 are
walked through the permutation again until they fall inside, which keeps it a
bijection of 0..N-1.  The permuted number p then says where the row goes:
shard ``p mod S``, slot ``p div S``.  So shard sizes differ by at most one row
(law ``rows``), slots are gapless, the order is a reproducible shuffle, and
both directions are plain arithmetic: :func:`place` gives (shard, slot) of a
row number and :func:`row_at` the row number at (shard, slot).

Global numbers need no global sort: rows are dealt to ``BLOCKS`` fixed hash
blocks of their id and text checksum, a block's first number is a running sum over the block
counts, and rows are numbered within their block by (id, text checksum, size).
Reruns, other partitionings and other cluster sizes give the same numbers.

Defined cases: null text has size 1 and checksum 0; null ids come first
within a block; rows that repeat id and text are interchangeable and get
consecutive numbers; an empty table gives no rows; groups of equal texts are
not kept together (the law is ``rows``); further columns are ignored.
Skew: hash blocks are even for rows that differ in id or text; only rows equal in both share a block.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import stored

#: Hash blocks of the numbering; fixed, since it is part of the shuffle's definition.
BLOCKS = 4096
ROUNDS = 6


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift-multiply), the round function's core."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Feistel:
    """A keyed permutation of 0..n-1 with computable inverse."""

    def __init__(self, n: int, seed: int, rounds: int = ROUNDS):
        self.n, self.half = int(n), max(1, (max(2, int(n)) - 1).bit_length() + 1 >> 1)
        self.mask = np.uint64((1 << self.half) - 1)
        with np.errstate(over="ignore"):
            self.keys = [_mix(np.array([seed * 1_000_003 + r + 1], dtype=np.uint64))[0] for r in range(rounds)]

    def _once(self, x: np.ndarray, inverse: bool) -> np.ndarray:
        left, right = x >> np.uint64(self.half), x & self.mask
        if inverse:
            for key in reversed(self.keys):
                left, right = right ^ (_mix(left ^ key) & self.mask), left
        else:
            for key in self.keys:
                left, right = right, left ^ (_mix(right ^ key) & self.mask)
        return (left << np.uint64(self.half)) | right

    def _walk(self, x, inverse: bool) -> np.ndarray:
        out = np.array(x, dtype=np.uint64, ndmin=1)
        with np.errstate(over="ignore"):
            out = self._once(out, inverse)
            while (outside := np.flatnonzero(out >= np.uint64(self.n))).size:
                out[outside] = self._once(out[outside], inverse)
        return out.astype(np.int64)

    def forward(self, x) -> np.ndarray:
        return self._walk(x, False)

    def backward(self, y) -> np.ndarray:
        return self._walk(y, True)


def place(rows, n: int, shards: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(shard, slot) of global row numbers."""
    p = Feistel(n, seed).forward(rows)
    return p % shards, p // shards


def row_at(shard, slot, n: int, shards: int, seed: int) -> np.ndarray:
    """The global row number that lies at (shard, slot): the inverse of :func:`place`."""
    return Feistel(n, seed).backward(np.asarray(slot) * shards + np.asarray(shard))


def row_numbers(df: DataFrame, order: list[str], keys: list[str], out: str = "row_number") -> DataFrame:
    """Global numbers 0..N-1 by fixed hash blocks of ``keys``; within a block by ``order``."""
    blocked = df.withColumn("_block", F.pmod(F.xxhash64(*keys, F.lit(17)), F.lit(BLOCKS)))
    counts = blocked.groupBy("_block").agg(F.count(F.lit(1)).alias("_n"))
    # At most BLOCKS rows: the one ordered window and the broadcast have a fixed bound.
    first = counts.select("_block", (F.sum("_n").over(Window.orderBy("_block")) - F.col("_n")).alias("_first"))
    within = F.row_number().over(Window.partitionBy("_block").orderBy(*order))
    return (blocked.withColumn("_within", within).join(F.broadcast(first), "_block")
            .withColumn(out, F.col("_first") + F.col("_within") - 1).drop("_block", "_first", "_within"))


def shard_rows(docs: DataFrame, shards: int = 8, seed: int = 42, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, row_number, shard, slot of every row."""
    slim = stored(docs.select(
        F.col(id_col).alias("doc_id"),
        (F.coalesce(F.octet_length(text_col), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("text_crc32")), "sized")
    total = slim.count()

    @F.pandas_udf("long")
    def permuted(rows: pd.Series) -> pd.Series:
        return pd.Series(Feistel(total, seed).forward(rows.to_numpy()))

    numbered = row_numbers(slim, ["doc_id", "text_crc32", "size"], ["doc_id", "text_crc32"])
    p = F.col("_p")
    return (numbered.withColumn("_p", permuted("row_number"))
            .withColumn("shard", (p % shards).cast("int"))
            .withColumn("slot", F.expr(f"_p div {int(shards)}"))
            .drop("_p"))


def write_shards(docs: DataFrame, path: str, shards: int = 8, seed: int = 42, id_col: str = "doc_id",
                 text_col: str = "text") -> None:
    """Write the rows themselves as one folder per shard, each file sorted by slot.
    Every shard is cut into ranges of slots, so no task holds a shard.  Ids must be unique."""
    spots = shard_rows(docs.select(id_col, text_col), shards, seed, id_col, text_col).select(
        F.col("doc_id").alias(id_col), "shard", "slot")
    out = docs.join(spots, id_col)
    out.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def query(docs: DataFrame) -> DataFrame:
    rows = shard_rows(docs)
    return rows.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                       F.lit(None).cast("int").alias("grown_shard"), "row_number")

"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

1. Targets: sources in code-point order (null last) weigh ``WEIGHTS`` in turn
   and share ``share`` times all words; a target stops at ``max_repeat`` times
   its source's words and the excess is reshared by weight (water filling).
2. Blocks: a source's documents fall by hash into blocks of about
   ``BLOCK_DOCS``; a Feistel permutation orders the blocks.  All blocks are
   drawn ``floor(target / words)`` times, the first ones in permuted order once
   more; the block at the cut is drawn in part, its documents chosen largest
   first so that the source's words meet the target.
3. Splitting tree: the exact number of block draws of each source is split
   among the output shards.  A node that covers several shards draws its left
   half's quotas from a multivariate hypergeometric distribution, and so on
   down to single shards: every draw lies in exactly one shard, shard quotas
   add up exactly, and the mix of each shard is that of a uniform shuffle.
   Shard s takes the next draws of each source in permuted order (disjoint),
   and rows are shuffled inside a shard by a hash key.

Defined cases: null text has size 0; a source without words has target 0 and
takes nothing; null is a source of its own; rows that repeat an id move
together, as do rows without an id that repeat a text; an empty table gives an empty result; reruns, other partitionings
and cluster sizes agree.  Further columns are ignored, or kept by :func:`mixed`.
Skew: a hot source has proportionally more blocks; block prefix sums run over
super-blocks of ``SUPER`` blocks, so no task sees a whole source.  The driver
holds one short row per source colour (at most ``MAX_COLOURS``) only.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import SPACE_CLASS, free_name, small_side, stored, text_or_empty
from .sharding import Feistel

WEIGHTS = (3, 1, 2)
BLOCK_DOCS, SUPER, MAX_COLOURS = 128, 1024, 65_536


def words(text: str) -> Column:
    return F.regexp_count(text_or_empty(text), F.lit("[^" + SPACE_CLASS[1:-1] + "]+")).cast("long")


def _doc_hash(id_col: str, text_col: str, seed: int) -> Column:
    """By id; rows without one go by their text, so that they do not all move as one."""
    text = F.concat(F.lit("text:"), F.xxhash64(text_or_empty(text_col)).cast("string"))
    return F.xxhash64(F.coalesce(F.col(id_col).cast("string"), text), F.lit(seed))


def source_targets(slim: DataFrame, share: float, max_repeat: float) -> DataFrame:
    """One row per source: source, source_rank, source_size, docs, target (water filling, closed form)."""
    s = (slim.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
         .withColumn("source_rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1))
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("source_rank") % len(WEIGHTS) + 1).cast("int"))
    s = s.withColumn("w", weight.cast("double")).withColumn("cap", F.lit(float(max_repeat)) * F.col("source_size"))
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing).orderBy(F.lit(0))
    up = Window.orderBy(F.col("cap") / F.col("w"), "source_rank")
    s = (s.withColumn("total", F.sum("source_size").over(every) * F.lit(float(share)))
         .withColumn("left_w", F.sum("w").over(every) - F.sum("w").over(up) + F.col("w"))
         .withColumn("left_t", F.col("total") - F.sum("cap").over(up) + F.col("cap"))
         .withColumn("level", F.col("left_t") / F.col("left_w"))
         .withColumn("full", F.col("level") >= F.col("cap") / F.col("w")))
    level = F.max(F.when(~F.col("full"), F.col("level"))).over(every)
    return (s.withColumn("target", F.when(F.col("full"), F.col("cap")).otherwise(level * F.col("w")))
            .select("source", "source_rank", "source_size", "docs", "target"))


def split_quotas(draws: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """(colours, shards) exact quotas of the splitting tree; columns sum to even shard sizes."""
    out = np.zeros((len(draws), shards), dtype=np.int64)
    total = int(draws.sum())
    sizes = [(total * (g + 1)) // shards - (total * g) // shards for g in range(shards)]
    # numpy's sampler takes fewer than 1e9 draws at a time; larger nodes are split in exact proportion chunks.
    todo = [(0, shards, draws.astype(np.int64))]
    while todo:
        a, b, have = todo.pop()
        if b - a == 1:
            out[:, a] = have
            continue
        mid, rng = (a + b) // 2, np.random.default_rng([seed, a, b])
        want, left = sum(sizes[a:mid]), np.zeros_like(have)
        chunk = max(1, -(-int(have.sum()) // 500_000_000))
        share, need = have // chunk, want // chunk
        for i in range(chunk):
            part = have - share * (chunk - 1) if i == chunk - 1 else share
            n = want - need * (chunk - 1) if i == chunk - 1 else need
            left += rng.multivariate_hypergeometric(part, n, method="marginals")
        todo += [(a, mid, left), (mid, b, have - left)]
    return out


def _permuted_blocks(block: pd.Series, blocks: pd.Series, key: pd.Series) -> pd.Series:
    out = np.zeros(len(block), dtype=np.int64)
    for (n, k), i in pd.DataFrame({"n": blocks, "k": key}).groupby(["n", "k"]).indices.items():
        out[i] = Feistel(int(n), int(k)).forward(block.to_numpy()[i])
    return pd.Series(out)


def _permuted(*cols) -> Column:
    return F.pandas_udf(_permuted_blocks, "long")(*cols)


def _cut(rows: pd.DataFrame) -> pd.DataFrame:
    """The documents of a source's cut block that bring its words to the target: largest first."""
    rows = rows.groupby("h", as_index=False).agg(size=("size", "sum"), rest=("rest", "first"),
                                                 source_rank=("source_rank", "first"))
    rows = rows.sort_values(["size", "h"], ascending=[False, True])
    rest, taken = float(rows["rest"].iloc[0]), []
    for s in rows["size"]:
        taken.append(fits := s <= rest)
        rest -= s if fits else 0
    chosen = np.array(taken)
    if (~chosen).any():  # the smallest one left, if that comes nearer
        last = np.flatnonzero(~chosen)[-1]
        chosen[last] = rows["size"].iloc[last] - rest < rest
    return rows.loc[chosen, ["source_rank", "h"]]


class Mix:
    """The plan of a mix: targets, block draws and shards; :meth:`attach` gives it to rows."""

    def __init__(self, docs: DataFrame, share: float = 1.5, max_repeat: float = 2.0, shards: int = 16,
                 seed: int = 42, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text"):
        self.id_col, self.source_col, self.text_col, self.seed, self.shards = id_col, source_col, text_col, seed, shards
        self.slim = stored(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                                       words(text_col).alias("size"), _doc_hash(id_col, text_col, seed).alias("h")), "sized")
        targets = source_targets(self.slim, share, max_repeat)
        ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
        self.sources = stored(
            targets.withColumn("blocks", F.ceil(F.col("docs") / BLOCK_DOCS).cast("long"))
            .withColumn("base", F.floor(ratio + F.lit(1e-12)).cast("long"))
            .withColumn("goal", F.greatest(F.lit(0.0), F.col("target") - F.col("base") * F.col("source_size"))),
            "sources")
        dealt = self._dealt(self.slim, "source", F.col("h"))
        sums = stored(dealt.groupBy("source_rank", "block").agg(
            F.sum("size").alias("words"), F.first("blocks").alias("blocks"), F.first("base").alias("base"),
            F.first("goal").alias("goal")).withColumn(
            "rank", _permuted("block", "blocks", F.col("source_rank") + F.lit(seed * 1000))), "block_words")
        supers = sums.groupBy("source_rank", F.expr(f"rank div {SUPER}").alias("super")).agg(F.sum("words").alias("sw"))
        before = Window.partitionBy("source_rank").orderBy("super")
        supers = supers.withColumn("sw", F.sum("sw").over(before) - F.col("sw"))
        inside = Window.partitionBy("source_rank", "super").orderBy("rank")
        ends = (sums.withColumn("super", F.expr(f"rank div {SUPER}")).join(supers, ["source_rank", "super"])
                .withColumn("end", F.col("sw") + F.sum("words").over(inside)))
        start = F.col("end") - F.col("words")
        self.blocks = stored(ends.select(
            "source_rank", "block", "rank", "blocks", "base", ((F.col("end") <= F.col("goal"))
                                                   & (F.col("goal") > 0)).alias("whole"),
            ((start < F.col("goal")) & (F.col("goal") < F.col("end"))).alias("cut"),
            (F.col("goal") - start).alias("rest")), "blocks")
        cut = self._dealt(self.slim, "source", F.col("h")).drop("base", "blocks").join(
            F.broadcast(self.blocks.where("cut").drop("blocks")), ["source_rank", "block"])  # one per source at most
        self.picked = stored(cut.select("source_rank", "h", "size", "rest").groupBy("source_rank").applyInPandas(
            _cut, "source_rank int, h long"), "picked")
        self._plant()

    def _dealt(self, df: DataFrame, source_col: str, h: Column) -> DataFrame:
        s = self.sources.select(F.col("source").alias("m_source"), "source_rank", "source_size", "target", "blocks",
                                "base", "goal")
        return (df.join(small_side(s, 96), df[source_col].eqNullSafe(s["m_source"])).drop("m_source")
                .withColumn("block", F.pmod(h, F.col("blocks"))))

    def _plant(self) -> None:
        """Split the draws of every source among the shards."""
        colour = (F.col("source_rank") % MAX_COLOURS)
        draws = (self.blocks.groupBy("source_rank").agg(
            F.sum(F.col("base") + (F.col("whole") | F.col("cut")).cast("long")).alias("draws"))
            .withColumn("colour", colour)
            .withColumn("first", F.sum("draws").over(Window.partitionBy("colour").orderBy("source_rank"))
                        - F.col("draws")))
        totals = draws.groupBy("colour").agg(F.sum("draws").alias("draws")).orderBy("colour").collect()
        quota = split_quotas(np.array([r["draws"] for r in totals], dtype=np.int64), self.shards, self.seed)
        ends = np.cumsum(quota, axis=1)
        spark = self.slim.sparkSession
        ladder = spark.createDataFrame([(int(r["colour"]), [int(x) for x in e]) for r, e in zip(totals, ends)],
                                       "colour int, ends array<bigint>")
        self.draws = stored(draws.withColumn("colour", F.col("colour").cast("int")).join(ladder, "colour")
                            .select("source_rank", "first", "ends"), "draws")

    def attach(self, df: DataFrame) -> DataFrame:
        """``df`` (with its source and hash ``h``) plus source_size, target, copies and the shard of each copy."""
        b = self.blocks.drop("rest", "base").withColumnRenamed("blocks", "in_all")
        out = self._dealt(df, self.source_col, F.col("h"))
        out = out.join(small_side(b, 64), ["source_rank", "block"])
        out = out.join(F.broadcast(self.picked.withColumn("picked", F.lit(True))), ["source_rank", "h"], "left")
        out = out.join(small_side(self.draws, 32 + 8 * self.shards), "source_rank")
        extra = F.col("whole") | (F.col("cut") & F.coalesce("picked", F.lit(False)))
        copies = (F.col("base") + extra.cast("long")).cast("int")
        shard = F.transform(F.sequence(F.lit(0), F.col("copies") - 1), lambda c: F.size(F.filter(
            "ends", lambda e: e <= F.col("first") + c.cast("long") * F.col("in_all") + F.col("rank"))))
        return (out.withColumn("copies", copies)
                .withColumn("shards", F.when(F.col("copies") > 0, shard).otherwise(F.array().cast("array<int>"))))

    def per_document(self) -> DataFrame:
        got = self.attach(self.slim.withColumnsRenamed({"doc_id": self.id_col, "source": self.source_col}))
        return got.select(F.col(self.id_col).alias("doc_id"), "size", "source_size", "target",
                          (F.col("size") * F.col("copies")).alias("taken"), "copies", "shards")


def mixed(docs: DataFrame, shards: int = 16, seed: int = 42, with_shard: bool = False, **options) -> DataFrame:
    """The mix itself: rows of ``docs`` once per copy, shuffled by a hash inside their shard when written with
    ``repartitionByRange("mix_shard", "mix_order")``; ``with_shard`` adds these two columns."""
    mix = Mix(docs, shards=shards, seed=seed, **options)
    packed = free_name(docs, "packed_row")
    row = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias(packed),
                      _doc_hash(mix.id_col, mix.text_col, seed).alias("h"), F.col(mix.source_col).alias("mix_source"))
    mix.source_col = "mix_source"
    out = (mix.attach(row).select(packed, "h", F.posexplode("shards").alias("copy", "mix_shard")))
    more = ["mix_shard", F.xxhash64("h", "copy", "mix_shard").alias("mix_order")] if with_shard else []
    return out.select(F.col(f"{packed}.*"), *more)


def query(docs: DataFrame) -> DataFrame:
    return Mix(docs).per_document()

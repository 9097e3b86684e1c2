"""Ordered per-key series without single-task keys.

A cell's history is an ordered series.  A plain ``Window.partitionBy(cell)``
puts a whole cell in one task, which breaks when one cell holds a large share
of all rows.  The helpers here keep every task bounded:

* ``ordered_positions`` numbers rows 1..n inside each key.  Rows are counted
  per (key, block) where ``block`` is a coarse, order-preserving bucket of the
  sort column; a running sum over that small count table gives each block's
  offset; each (key, block) is then numbered locally.
* ``with_halo`` splits a numbered series into blocks of ``block_rows``
  positions and copies the last ``halo`` rows of each block into the next one,
  so trailing frames of up to ``halo`` rows are complete inside every block.
* ``cross_block_context`` and ``with_carried_halo`` do the same for rows that are
  already dealt by (key, block of the sort column): only a per-block table moves.
* ``expand_to_blocks`` turns a per-key table into a per-(key, block) table so
  it joins the blocked series on its own partitioning key (no re-shuffle of
  the large side).
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config

BLOCK = "_pblk"
CYCLE_BLOCK = "_cblk"
HALO = "_halo"


def ordered_positions(df: DataFrame, keys: list[str], block: Column | str, order: list[Column],
                      pos_col: str = "pos", count_col: str | None = None,
                      per_key: DataFrame | None = None) -> DataFrame:
    """Add ``pos_col`` = 1-based row number within ``keys`` ordered by ``order``.

    ``block`` must be non-decreasing along ``order`` inside a key.  Pass the
    name of an existing ``_cblk`` column to reuse a partitioning made upstream.
    When ``count_col`` is given the key's total row count is attached as well.
    ``per_key`` is inner-joined on ``keys``: its columns ride on the block
    offsets, so the rows themselves are shuffled and sorted once.
    """
    b = df if isinstance(block, str) else df.withColumn("_cblk", block)
    counts = b.groupBy(*keys, "_cblk").agg(F.count(F.lit(1)).alias("_cn"))
    before = Window.partitionBy(*keys).orderBy("_cblk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_coff", F.coalesce(F.sum("_cn").over(before), F.lit(0)))
    if count_col:
        offsets = offsets.withColumn(count_col, F.sum("_cn").over(Window.partitionBy(*keys)))
    offsets = offsets.drop("_cn")
    if per_key is not None:
        offsets = offsets.join(per_key, keys)
    # Numbered before the join, whose sort order the window's satisfies.
    local = Window.partitionBy(*keys, "_cblk").orderBy(*order)
    out = (b.withColumn("_clocal", F.row_number().over(local)).join(offsets, [*keys, "_cblk"])
            .withColumn(pos_col, (F.col("_coff") + F.col("_clocal")).cast("int")))
    return out.drop("_cblk", "_coff", "_clocal")


def with_halo(df: DataFrame, pos_col: str, halo: int,
              block_rows: int = config.SERIES_BLOCK_ROWS) -> DataFrame:
    """Assign rows to position blocks and replicate the ``halo`` rows preceding each block."""
    if halo >= block_rows:
        raise ValueError("halo must be smaller than the block size")
    offset = (F.col(pos_col) - 1) % block_rows
    copies = F.when(offset >= block_rows - halo, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (df.withColumn("_copy", F.explode(copies))
              .withColumn(BLOCK, (F.floor((F.col(pos_col) - 1) / block_rows) + F.col("_copy")).cast("int"))
              .withColumn(HALO, F.col("_copy") == 1)
              .drop("_copy"))


def expand_to_blocks(per_key: DataFrame, n_col: str,
                     block_rows: int = config.SERIES_BLOCK_ROWS) -> DataFrame:
    """Repeat each per-key row once per position block of that key (n rows -> ceil(n/B) blocks)."""
    last = F.floor((F.col(n_col) - 1) / block_rows).cast("int")
    return per_key.withColumn(BLOCK, F.explode(F.sequence(F.lit(0), last)))


def block_window(keys: list[str], pos_col: str):
    return Window.partitionBy(*keys, BLOCK).orderBy(pos_col)


def keys_of_several_blocks(df: DataFrame, key: str, block: str = CYCLE_BLOCK) -> DataFrame:
    """Keys whose rows lie in more than one block."""
    return (df.groupBy(key).agg(F.min(block).alias("_lo"), F.max(block).alias("_hi"))
            .where(F.col("_lo") < F.col("_hi")).select(key))


def cross_block_context(rows: DataFrame, key: str, order: str, means: dict[str, str], first: int,
                        halo_columns: tuple[str, ...], halo: int, block: str = CYCLE_BLOCK) -> DataFrame:
    """Per (key, block): ``_before`` (rows in earlier blocks), ``n_rows`` of the key, the means over its ``first`` rows
    (``means``: name -> column) and ``_tail``, the ``halo`` rows before the block.

    A block gives its count, its first and its last rows; the running windows see only that table.
    """
    w = Window.partitionBy(key, block)
    x = (rows.withColumn("_up", F.row_number().over(w.orderBy(order)))
         .withColumn("_down", F.row_number().over(w.orderBy(F.desc(order)))))
    head = F.struct(order, *[F.col(c).alias(f"_m{i}") for i, c in enumerate(means.values())])
    per_block = x.groupBy(key, block).agg(
        F.count(F.lit(1)).alias("_n"),
        F.array_sort(F.collect_list(F.when(F.col("_up") <= first, head))).alias("_head"),
        F.array_sort(F.collect_list(F.when(F.col("_down") <= halo, F.struct(*halo_columns)))).alias("_last"))
    along = Window.partitionBy(key).orderBy(block)
    # Every block holds a row at least, so so many blocks hold the rows wanted.
    heads = F.flatten(F.collect_list("_head").over(Window.partitionBy(key)))
    starts = (per_block.withColumn("_rank", F.row_number().over(along)).where(F.col("_rank") <= first)
              .withColumn("_all", F.slice(F.array_sort(heads), 1, first)).where(F.col("_rank") == 1)
              .select(key, *[(F.aggregate(F.col(f"_all._m{i}"), F.lit(0.0), lambda a, v: a + v) / F.size("_all")).alias(name)
                             for i, name in enumerate(means)]))
    totals = per_block.groupBy(key).agg(F.sum("_n").alias("n_rows"))
    before = F.flatten(F.collect_list("_last").over(along.rowsBetween(-halo, -1)))
    carried = per_block.select(
        key, block, F.coalesce(F.sum("_n").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
        F.slice(F.reverse(F.array_sort(before)), 1, halo).alias("_tail"))
    return carried.join(totals.join(starts, key), key)


def with_carried_halo(rows: DataFrame, halo_columns: tuple[str, ...]) -> DataFrame:
    """The rows and, before the first row of a block that has a ``_tail``, those rows again with ``_halo`` true."""
    if "_tail" not in rows.columns:
        return rows.withColumn(HALO, F.lit(False)).drop("_rn")
    own = F.struct(*[F.col(c) for c in halo_columns], F.lit(False).alias(HALO))
    tail = F.transform("_tail", lambda t: F.struct(*[t[c].alias(c) for c in halo_columns], F.lit(True).alias(HALO)))
    made = F.when((F.col("_rn") == 1) & (F.size("_tail") > 0), F.concat(F.array(own), tail)).otherwise(F.array(own))
    x = rows.withColumn("_made", F.explode(made)).drop("_rn", "_tail", *halo_columns)
    return x.select("*", "_made.*").drop("_made")

"""Exact dedup by a Golomb-coded fingerprint exchange.

Every partition is a *sender*.  It sorts the short fingerprints of its rows,
splits them by owner (equal fingerprint ranges) and sends each owner one
Golomb-coded set.  An owner decodes the sets of its range, finds the
fingerprints that more than one sender holds, and answers each sender with a
bitmap over the set it got.  Rows whose bit is set, and rows that repeat a
fingerprint within their sender, are *suspects*: only their texts are shuffled,
and grouped by the normalised bytes themselves, so a fingerprint collision
never merges different texts.

Equality: texts are equal when identical after deleting ``[\\x20\\x09-\\x0D]``.
Defined cases: null text counts as empty, all empty texts form one group; a
null ``doc_id`` sorts after every other id; of rows that repeat both id and
text exactly one is kept; an empty table gives an empty result; further
columns, whatever their names, are ignored by :func:`exact_groups` and kept
by :func:`deduplicate`.

Skew: a sender sends a fingerprint once however often it holds it, suspects are
aggregated map-side before they are shuffled, and the join back to rows is a
sort-merge join that adaptive execution can split.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import golomb
from ._common import SPACE_CLASS, free_name, small_side, stored, text_or_empty

#: Fingerprint bits beyond log2(rows): a row is a false suspect with probability 2**-EXTRA_BITS.
EXTRA_BITS = 12
#: Rows a sender holds at once, and fingerprints an owner decodes at once (on average).
SENDER_ROWS, OWNER_ROWS = 400_000, 4_000_000


def normalised(text: str | Column) -> Column:
    return F.regexp_replace(text_or_empty(text), SPACE_CLASS + "+", "")


def _row_keys(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    norm = normalised(text_col)
    return docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(norm).alias("h"),
                       F.length(text_or_empty(text_col)).alias("cp"),
                       F.unhex(F.sha2(norm, 256)).alias("sha"))


def _sender(fp_bits: int, owners: int, id_type: pa.DataType):
    span = -(-(1 << fp_bits) // owners)
    fields = [("doc_id", id_type), ("h", pa.int64()), ("cp", pa.int32()), ("sha", pa.binary())]

    def send(batch: pa.Table, sender: int) -> Iterator[pa.RecordBatch]:
        fp = batch["h"].to_numpy().view(np.uint64) >> np.uint64(64 - fp_bits)
        batch = batch.take(pa.array(order := np.argsort(fp, kind="stable")))
        fp = fp[order]
        owner = (fp // np.uint64(span)).astype(np.int64)
        starts = np.flatnonzero(np.diff(owner, prepend=-1))
        for a, b in zip(starts, [*starts[1:], len(fp)]):
            mine = fp[a:b] - np.uint64(owner[a] * span)
            new = np.diff(mine, prepend=np.uint64(2**64 - 1)) != 0
            slot = np.cumsum(new) - 1
            k, payload = golomb.encode(mine[new], span)
            times = np.bincount(slot)
            cols = {c: batch[c].slice(a, b - a).combine_chunks() for c, _ in fields}
            one = pa.array([0, b - a], type=pa.int32())
            lists = [pa.ListArray.from_arrays(one, x.chunk(0) if isinstance(x, pa.ChunkedArray) else x)
                     for x in cols.values()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([sender], pa.int64()), pa.array([int(owner[a])], pa.int64()),
                 pa.array([int(new.sum())], pa.int32()), pa.array([k], pa.int32()),
                 pa.array([payload], pa.binary()), *lists,
                 pa.ListArray.from_arrays(one, pa.array(slot.astype(np.int32))),
                 pa.ListArray.from_arrays(one, pa.array(times[slot] > 1))],
                names=["sender", "owner", "n", "k", "payload", *(c for c, _ in fields), "slot", "repeated"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, seq = [], 0, 0
        base = TaskContext.get().partitionId() << 24
        for b in batches:
            if not b.num_rows:
                continue
            held.append(b)
            rows += b.num_rows
            if rows >= SENDER_ROWS:
                yield from send(pa.Table.from_batches(held), base + seq)
                held, rows, seq = [], 0, seq + 1
        if held:
            yield from send(pa.Table.from_batches(held), base + seq)

    return run


def _owner(key: tuple, messages: pd.DataFrame) -> pd.DataFrame:
    """Which of the fingerprints of each message do other senders hold, too?"""
    sets = [golomb.decode(p, n, k) for p, n, k in zip(messages["payload"], messages["n"], messages["k"])]
    values, inverse, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.split((times > 1)[inverse], np.cumsum([len(s) for s in sets])[:-1])
    return pd.DataFrame({"sender": messages["sender"], "owner": messages["owner"],
                         "bitmap": [np.packbits(s).tobytes() for s in shared]})


def _answered(id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                row = b.slice(i, 1)
                slot = row["slot"].flatten().to_numpy()
                bits = np.unpackbits(np.frombuffer(row["bitmap"][0].as_py(), dtype=np.uint8)).astype(bool)
                suspect = bits[slot] | row["repeated"].flatten().to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays(
                    [row["doc_id"].flatten(), row["h"].flatten(), row["cp"].flatten(), row["sha"].flatten(),
                     pa.array(suspect)], names=["doc_id", "h", "cp", "sha", "suspect"])
    return run


def suspects(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The exchange: every row's (doc_id, h, cp, sha, suspect), stored."""
    from pyspark.sql.pandas.types import to_arrow_type
    id_type = docs.schema[id_col].dataType
    total = max(1, docs.count())
    owners = max(8, -(-total // OWNER_ROWS))
    fp_bits = min(62, total.bit_length() + EXTRA_BITS)
    arrow_id = to_arrow_type(id_type)
    kind = id_type.simpleString()
    sent = stored(_row_keys(docs, id_col, text_col).mapInArrow(
        _sender(fp_bits, owners, arrow_id),
        f"sender long, owner long, n int, k int, payload binary, doc_id array<{kind}>, h array<bigint>, "
        "cp array<int>, sha array<binary>, slot array<int>, repeated array<boolean>"), "sent")
    bitmaps = (sent.select("sender", "owner", "n", "k", "payload").groupBy("owner")
               .applyInPandas(_owner, "sender long, owner long, bitmap binary"))
    return stored(sent.drop("n", "k", "payload").join(bitmaps, ["sender", "owner"])
                  .mapInArrow(_answered(arrow_id), T.StructType([
                      T.StructField("doc_id", id_type), T.StructField("h", T.LongType()),
                      T.StructField("cp", T.IntegerType()), T.StructField("sha", T.BinaryType()),
                      T.StructField("suspect", T.BooleanType())])), "rows")


def _verified(docs: DataFrame, rows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Byte verification: the suspects' texts grouped by their normalised bytes.
    One row per text: sha, group_size, keep_cp, keep_id."""
    keys = stored(rows.where("suspect").select("h").distinct(), "suspect_keys")
    texts = docs.select(F.col(id_col).alias("doc_id"), normalised(text_col).alias("norm"),
                        F.length(text_or_empty(text_col)).alias("cp"))
    texts = texts.withColumn("h", F.xxhash64("norm")).join(small_side(keys, 16), "h", "left_semi")
    best = F.min(F.struct((-F.col("cp")).alias("neg_cp"), F.col("doc_id").isNull().alias("no_id"), "doc_id"))
    return (texts.groupBy("norm").agg(F.count(F.lit(1)).alias("group_size"), best.alias("best"))
            .select(F.unhex(F.sha2("norm", 256)).alias("sha"), "group_size",
                    (-F.col("best.neg_cp")).alias("keep_cp"), F.col("best.doc_id").alias("keep_id")))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256, and the row's h and cp."""
    rows = suspects(docs, id_col, text_col)
    groups = _verified(docs, rows, id_col, text_col)
    sha = F.lower(F.hex("sha")).alias("text_sha256")
    single = rows.where("not suspect").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), sha, "h", "cp")
    # Rows that repeat id and text collapse to a count before the join; the first of them can be kept.
    times = rows.where("suspect").groupBy("sha", "doc_id", "h", "cp").agg(F.count(F.lit(1)).alias("times"))
    joined = (times.join(groups, "sha")
              .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "times"))))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("cp") == F.col("keep_cp")) & (F.col("copy") == 1)
    return single.unionByName(joined.select("doc_id", "keep_id", "group_size", kept.alias("kept"), sha, "h", "cp"))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    h, cp = free_name(docs, "dedup_h"), free_name(docs, "dedup_cp")
    result = exact_groups(docs, id_col, text_col).where("group_size > 1")
    keys = stored(result.groupBy(F.col("doc_id").alias("k_id"), F.col("h").alias("k_h"), F.col("cp").alias("k_cp"))
                  .agg(F.max("kept").alias("k_kept"), F.count(F.lit(1)).alias("k_times"))
                  .where("not k_kept or k_times > 1"), "dropped")
    keyed = docs.withColumns({h: F.xxhash64(normalised(text_col)), cp: F.length(text_or_empty(text_col))})
    same = (keyed[id_col].eqNullSafe(keys["k_id"])) & (keyed[h] == keys["k_h"]) & (keyed[cp] == keys["k_cp"])
    rest = keyed.join(small_side(keys, 48), same, "left_anti").select(*docs.columns)
    again = keys.where("k_kept and k_times > 1")
    first = (keyed.join(small_side(again, 48), same, "left_semi").groupBy(id_col, h, cp)
             .agg(*(F.first(F.col(f"`{c}`")).alias(c) for c in docs.columns if c != id_col))
             .select(*docs.columns))
    return rest.unionByName(first)


def query(docs: DataFrame) -> DataFrame:
    return exact_groups(docs).drop("h", "cp")


#: DuckDB: groups of equal normalised texts, the longest original (then smallest id) stays.
ORACLE_SQL = r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS cp,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER g AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER g = 1 AS kept, text_sha256
FROM n
WINDOW g AS (PARTITION BY text_sha256 ORDER BY cp DESC, doc_id NULLS LAST)
"""

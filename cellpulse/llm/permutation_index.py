"""Nearest neighbours by a permutation index.

A vector is represented by its ordered nearest pivots.  Vectors are dealt to
blocks of about ``BLOCK`` rows; each block keeps one inverted file per pivot
with the vectors that have it among their ``PREFIX`` nearest, and at which
place.  A query walks the files of its own ``PROBE`` nearest pivots and adds up,
for every vector met, how much each shared pivot lowers the footrule distance of
the two rankings; the vectors of least footrule distance (``RERANK`` of a block
and all that tie with the last of them) are reranked by the exact inner product in
double precision.  While one of the best lies in the farther half of what was
reranked, the cut is unclear and the share is doubled, up to the whole block.  Every
query meets every block; a block gives its best, and the best over all blocks remain.

Largest inner product is reduced to nearest neighbours by one more dimension
(``sqrt(M^2 - |x|^2)``, 0 for queries), so vectors need not have unit length.  The
products leave out what all pivots share, so a row of very large norm (a large M)
costs the others no digits, and the ``RERANK_MIN`` rows of largest norm in a block
are always reranked.  Squared norms must fit a double (components below 1e150).
Pivots are ``PIVOTS`` rows of a hash-ordered sample of ``SAMPLE``, each the farthest
by angle from those before it, so a tight cluster gets few of them whatever its size;
all rows are indexed, equal vectors as one entry with the ids that can be in any answer (the ``top + 1``
smallest; more copies can never be among the nearest ``top``).

Defined cases: vectors that are null, zero, of another dimension than most, or
hold null or non-finite components take no part; ties go to the smaller id;
fewer than ``top`` candidates give fewer rows; an empty table gives none.
Rows that repeat an id are one vector each; rows without an id are candidates
whose id is null, after all others of equal score.  Other columns are ignored.
Skew: copies are limited map-side, blocks are dealt by hash.
"""
from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import stored

PIVOTS, PREFIX, PROBE, BLOCK, QUERIES = 256, 96, 64, 16_384, 1024
#: Stands for a null id, after all others.
NO_ID = (1 << 63) - 1
#: Rows the pivots are chosen from.
SAMPLE = 4096
#: Share of a block that is reranked exactly at first, and the least number of vectors.
RERANK, RERANK_MIN = 0.15, 600


def usable(embeddings: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    v = embeddings.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("vec_id"),
                          F.col(vector_col).cast("array<double>").alias("v")).where(
        F.col("v").isNotNull()
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("v", lambda x: x != 0))
    dims = v.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    return v.where(F.size("v") == (dims["dim"] if dims else 0))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def _rest(norm2: np.ndarray, top_norm: float) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, top_norm**2 - norm2))


def _nearness(x: np.ndarray, pivots: np.ndarray, top_norm: float) -> np.ndarray:
    """Products of lifted rows and pivots less ``M sqrt(M^2 - |x|^2)``, the same for all pivots of a row."""
    norm2, pivot2 = (np.einsum("ij,ij->i", m, m) for m in (x, pivots))
    below = pivot2 / np.maximum(top_norm + _rest(pivot2, top_norm), np.finfo(float).tiny)
    return x @ pivots.T - _rest(norm2, top_norm)[:, None] * below


def _ranking(near: np.ndarray, prefix: int) -> np.ndarray:
    """The ``prefix`` nearest pivots of each row, nearest first."""
    part = np.argpartition(-near, prefix - 1, axis=1)[:, :prefix]
    order = np.argsort(-np.take_along_axis(near, part, 1), axis=1, kind="stable")
    return np.take_along_axis(part, order, 1)


def _spread(x: np.ndarray, count: int) -> np.ndarray:
    """The first row, then again and again the row of largest angle to all taken so far."""
    unit = x / np.abs(x).max(axis=1, keepdims=True)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    taken, near = [], np.full(len(x), -1.0)
    for _ in range(min(count, len(x))):
        i = int(np.argmin(near))
        taken.append(i)
        near = np.maximum(near, unit @ unit[i])
        near[i] = np.inf
    return x[taken]


def _poster(pivots: np.ndarray, prefix: int, top_norm: float):
    def post(rows: pd.DataFrame) -> pd.DataFrame:
        """A block's inverted files; pivot -1 holds the block's ids and vectors."""
        rows = rows.sort_values("vec_id")
        x = _matrix(rows["v"])
        rank = _ranking(_nearness(x, pivots, top_norm), prefix)
        flat = rank.reshape(-1)
        order = np.argsort(flat, kind="stable")
        owner = (order // prefix).astype(np.int32)
        place = (order % prefix).astype(np.uint8)
        ends = np.searchsorted(flat[order], np.arange(len(pivots) + 1))
        files = [(p, owner[a:b].tobytes(), place[a:b].tobytes())
                 for p, (a, b) in enumerate(zip(ends[:-1], ends[1:])) if b > a]
        files.append((-1, rows[["vec_id", "row"]].to_numpy(np.int64).T.tobytes(), x.tobytes()))
        out = pd.DataFrame(files, columns=["pivot", "owners", "places"])
        out.insert(0, "block", rows["block"].iloc[0])
        return out
    return post


def _rerank(near: np.ndarray, large: np.ndarray, ids: np.ndarray, x: np.ndarray, vec: np.ndarray, take: int, count: int):
    """Rows and scores of the best ``count``, reranking ``large``, ``take`` rows and more while the cut is unclear."""
    met = np.cumsum(np.bincount(near)[::-1])

    def nth(k: int) -> int:
        """The ``k``-th largest value of ``near``, from 1."""
        return len(met) - 1 - int(np.searchsorted(met, k))
    score, done = np.zeros(len(ids)), np.zeros(len(ids), dtype=bool)
    while True:
        fresh = np.flatnonzero(((near >= nth(take)) | large) & ~done)
        score[fresh] = (x[fresh] * vec).sum(axis=1)
        done[fresh] = True
        cand = np.flatnonzero(done)
        if len(cand) > count:
            cand = cand[score[cand] >= np.partition(score[cand], -count)[-count]]
        best = cand[np.lexsort((ids[cand], -score[cand]))[:count]]
        if done.all() or near[best].min() > nth(take // 2 + 1):
            return best, score[best]
        take = min(len(ids), 2 * take)


def _searcher(pivots: np.ndarray, prefix: int, probe: int, top: int, share: float, least: int):
    def search(files: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if files.empty or queries.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "rep": [], "score": []})
        base = files[files["pivot"] < 0].iloc[0]
        ids, keys = np.frombuffer(base["owners"], dtype=np.int64).reshape(2, -1)
        x = np.frombuffer(base["places"], dtype=np.float64).reshape(len(ids), -1)
        # a block's files hold a good share of its rows each, so they are laid out as rows of places, ``prefix`` where absent
        laid = np.full((len(pivots), len(ids)), prefix, dtype=np.uint8)
        for p, o, s in zip(files["pivot"], files["owners"], files["places"]):
            if p >= 0:
                laid[p, np.frombuffer(o, dtype=np.int32)] = np.frombuffer(s, dtype=np.uint8)
        q = _matrix(queries["v"])
        ranking = _ranking(q @ pivots.T, probe)
        take = min(len(ids), max(least, math.ceil(share * len(ids))))
        large = np.zeros(len(ids), dtype=bool)
        large[np.argsort(-np.einsum("ij,ij->i", x, x), kind="stable")[:least]] = True
        got = []
        for qid, vec, rank in zip(queries["vec_id"], q, ranking):
            apart = np.maximum(laid[rank], np.arange(len(rank), dtype=np.uint8)[:, None])
            near = prefix * len(rank) - apart.sum(axis=0, dtype=np.uint16).astype(np.int64)
            best, score = _rerank(near, large, ids, x, vec, take, top + 1)
            got.append(pd.DataFrame({"query_id": qid, "vec_id": ids[best], "rep": keys[best], "score": score}))
        return pd.concat(got)
    return search


def build(vectors: DataFrame, top: int) -> tuple[DataFrame, DataFrame, np.ndarray, int]:
    """(inverted files, copies, pivots, blocks) of the usable vectors."""
    same = Window.partitionBy("v").orderBy("vec_id", "row")
    held = vectors.withColumn("row", F.monotonically_increasing_id()).withColumn("nth", F.row_number().over(same)).where(
        F.col("nth") <= top + 1)
    held = stored(held.withColumn("rep", F.first("row").over(same)), "held")
    entries = held.where("nth = 1").select("vec_id", "row", "v")
    copies = held.select("rep", "vec_id")
    norm2 = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    total, top_norm = entries.agg(F.count(F.lit(1)), F.sqrt(F.max(norm2))).first()
    top_norm = float(top_norm or 0.0)
    sample = entries.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("v").toPandas()
    pivots = _spread(_matrix(sample["v"]), PIVOTS)
    blocks = max(1, -(-total // BLOCK))
    files = (entries.withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(blocks)).cast("int"))
             .groupBy("block").applyInPandas(_poster(pivots, min(PREFIX, len(pivots)), top_norm),
                                             "block int, pivot int, owners binary, places binary"))
    return stored(files, "files"), copies, pivots, blocks


def search(embeddings: DataFrame, queries: DataFrame, top: int = 20, id_col: str = "vec_id",
           vector_col: str = "embedding", share: float = RERANK) -> DataFrame:
    """query_id, rank, vec_id, score: the ``top`` nearest found of each row of ``queries``."""
    schema = "query_id long, vec_id long, rep long, score double"
    vectors = stored(usable(embeddings, id_col, vector_col), "usable")
    asked = stored(usable(queries, id_col, vector_col), "queries")
    count = asked.count()
    spark = embeddings.sparkSession
    if not count or vectors.isEmpty():
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    files, copies, pivots, blocks = build(vectors, top)
    parts = -(-count // QUERIES)
    prefix = min(PREFIX, len(pivots))
    every_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    left = files.select("*", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
    right = asked.select("vec_id", "v", F.pmod(F.xxhash64("vec_id", F.lit(5)), F.lit(parts)).cast("int").alias("part"),
                         every_block)
    found = (left.groupBy("block", "part").cogroup(right.groupBy("block", "part"))
             .applyInPandas(_searcher(pivots, prefix, min(PROBE, prefix), top, share, RERANK_MIN), schema))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = found.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= top + 1)
    spread = (found.drop("vec_id").join(copies, "rep")
              .where(F.col("vec_id") != F.col("query_id"))
              .withColumn("rank", F.row_number().over(best).cast("int")).where(F.col("rank") <= top))
    return spread.select("query_id", "rank", F.when(F.col("vec_id") != NO_ID, F.col("vec_id")).alias("vec_id"), "score")


def query(embeddings: DataFrame) -> DataFrame:
    return search(embeddings, embeddings.where(F.col("vec_id") % 20 == 0))

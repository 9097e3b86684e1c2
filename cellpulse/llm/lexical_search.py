"""Ranked lexical search for many items at once, with common subexpressions shared.

Terms are the maximal matches of ``[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+``,
only A-Z lower-cased.  One pass over the documents finds each one's number of
terms and its occurrences of the items' terms; these short rows are stored, and
the counts over all documents (documents with terms, all terms, documents per
item term) are aggregated from them.

Many items share terms.  Terms that the same items hold form one node; then,
round by round, neighbouring nodes (items list their nodes by falling number of
items) that at least two items have next to each other become a new node, the
most shared pairs first.  The result is a DAG whose sinks are the items.  For a
slab of documents every node's partial score is materialised once, from its two
parts, and all items that share it add it from there.  A task keeps the best
``top`` documents of each item it has met, so a few rows an item and task are
shuffled; they are cut again by (item, salt) before the last ranking.

Items are taken in blocks of at most ``BLOCK_TERMS`` item terms (an item with more
is a block of its own), so what a task holds has a bound that the number of
items does not move; each block is a search of its own over all documents.

Scores are exact 64-bit integers: ``w = floor(1000 ln((2N+2)/(2df+1)))``,
``m = 100 - b + b n N div L`` with ``b`` 90, and the sum of
``w ((10^9 tf) div (1000 tf + 8 m))`` over the item's terms.

Defined cases: null text has no terms; rows of the items that share an id (null
ids too) are one item with the terms of all; an item or a corpus without terms
gives no rows; documents that repeat an id are ranked one by one; equal scores
go by ascending id, null ids last; other columns are ignored.
Skew: a term in every document is one entry of each document's own row.
"""
from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import scratch_path, stored

TOP, LENGTH_SHARE = 10, 90
#: Item terms of a block of items; documents of a slab; parts an item's candidates are first cut in.
BLOCK_TERMS, SLAB, SALTS = 1 << 15, 256, 32
#: The contract's terms on UTF-8 bytes: every byte of a character beyond ASCII belongs to a term.
_TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text: bytes) -> list[bytes]:
    return _TERM.findall(text.lower())


# The query-sharing DAG ---------------------------------------------------------------------------------------------
def share(items: list[frozenset[int]]) -> tuple[list[list[int]], list[tuple[int, int]], list[list[int]]]:
    """(terms of each leaf, the two parts of each further node, nodes of each item) for items' sets of terms.

    Leaves are numbered first; node ``len(leaves) + k`` joins the pair ``k``.  Every item is the disjoint union of its nodes.
    """
    holders: dict[int, list[int]] = defaultdict(list)
    for i, held in enumerate(items):
        for t in held:
            holders[t].append(i)
    groups: dict[tuple, list[int]] = defaultdict(list)
    for t in sorted(holders):
        groups[tuple(holders[t])].append(t)
    order = sorted(groups, key=lambda g: (-len(g), groups[g]))
    leaves = [groups[g] for g in order]
    paths: list[list[int]] = [[] for _ in items]
    for node, g in enumerate(order):
        for i in g:
            paths[i].append(node)
    pairs: list[tuple[int, int]] = []
    while True:
        seen = Counter(p for path in paths for p in zip(path, path[1:]))
        used: set[int] = set()
        chosen: dict[tuple[int, int], int] = {}
        for pair, n in sorted(seen.items(), key=lambda x: (-x[1], x[0])):
            if n < 2:
                break
            if not used & set(pair):
                used |= set(pair)
                chosen[pair] = len(leaves) + len(pairs)
                pairs.append(pair)
        if not chosen:
            return leaves, pairs, paths
        for i, path in enumerate(paths):
            out, k = [], 0
            while k < len(path):
                joined = chosen.get((path[k], path[k + 1])) if k + 1 < len(path) else None
                out.append(path[k] if joined is None else joined)
                k += 1 if joined is None else 2
            paths[i] = out


class Dag:
    """Nodes' scores of a slab of documents, levels of nodes at a time."""

    def __init__(self, items: list[frozenset[int]], n_terms: int):
        leaves, pairs, self.paths = share(items)
        self.n_leaves, self.n_nodes, self.n_terms = len(leaves), len(leaves) + len(pairs), n_terms
        self.leaf_terms = np.array([t for leaf in leaves for t in leaf], dtype=np.int64)
        self.leaf_starts = np.cumsum([0] + [len(leaf) for leaf in leaves])[:-1]
        level = [0] * len(leaves)
        for a, b in pairs:
            level.append(1 + max(level[a], level[b]))
        rounds: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
        for k, (a, b) in enumerate(pairs):
            rounds[level[len(leaves) + k]].append((len(leaves) + k, a, b))
        self.rounds = [np.array(rounds[r], dtype=np.int64).T for r in sorted(rounds)]
        self.path_nodes = np.array([n for p in self.paths for n in p], dtype=np.int64)
        self.path_starts = np.cumsum([0] + [len(p) for p in self.paths])[:-1]

    def scores(self, term_scores: np.ndarray) -> np.ndarray:
        """Items x documents from terms x documents."""
        nodes = np.empty((self.n_nodes, term_scores.shape[1]), dtype=np.int64)
        nodes[:self.n_leaves] = np.add.reduceat(term_scores[self.leaf_terms], self.leaf_starts, axis=0)
        for out, a, b in self.rounds:
            nodes[out] = nodes[a] + nodes[b]
        return np.add.reduceat(nodes[self.path_nodes], self.path_starts, axis=0)


# Postings ----------------------------------------------------------------------------------------------------------
def _poster(number: dict[bytes, int], schema: pa.Schema):
    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, held, counts = [], [], []
            for text in batch.column("text").cast(pa.binary()):
                raw = text.as_py()
                found = terms(raw) if raw else []
                sizes.append(len(found))
                tf = Counter(number[t] for t in found if t in number)
                held.append(list(tf))
                counts.append(list(tf.values()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(
                pa.array(v, f.type) for v, f in zip((sizes, held, counts), list(schema)[1:]))], schema=schema)
    return post


def _ranker(dag: Dag, weights: np.ndarray, n_docs: int, n_all: int, top: int, share_of_length: int, schema: pa.Schema):
    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_items = len(dag.paths)
        best = [np.empty((0, 3), dtype=np.int64)] * n_items  # score, id is null, id; best first
        bar = np.zeros(n_items, dtype=np.int64)
        for whole in batches:
            for at in range(0, whole.num_rows, SLAB):
                batch = whole.slice(at, SLAB)
                held, tf = (batch.column(c) for c in ("held", "tf"))
                lengths = np.diff(held.offsets.to_numpy())
                doc = np.repeat(np.arange(batch.num_rows), lengths)
                if not len(doc):
                    continue
                t, f = held.flatten().to_numpy(), tf.flatten().to_numpy()
                size = batch.column("n").to_numpy()
                m = 100 - share_of_length + (share_of_length * size * n_docs) // n_all
                part = np.zeros((dag.n_terms, batch.num_rows), dtype=np.int64)
                part[t, doc] = weights[t] * ((1_000_000_000 * f) // (1000 * f + 8 * m[doc]))
                scores = dag.scores(part)
                ids = batch.column("doc_id")
                none = np.asarray(ids.is_null()).astype(np.int64)
                ids = ids.fill_null(0).to_numpy()
                # ties with the last kept score may still win by a smaller id
                fresh = (scores > 0) & (scores >= bar[:, None])
                for i in np.flatnonzero(fresh.any(axis=1)):
                    d = np.flatnonzero(fresh[i])
                    both = np.concatenate([best[i], np.stack([scores[i, d], none[d], ids[d]], axis=1)])
                    best[i] = both[np.lexsort((both[:, 2], both[:, 1], -both[:, 0]))[:top]]
                    if len(best[i]) == top:
                        bar[i] = best[i][-1, 0]
        rows = np.concatenate([np.empty((0, 4), dtype=np.int64)] + [
            np.column_stack([np.full(len(b), i), b]) for i, b in enumerate(best) if len(b)])
        yield pa.RecordBatch.from_arrays([
            pa.array(rows[:, 0], pa.int64()), pa.array(rows[:, 3], pa.int64(), mask=rows[:, 2] > 0),
            pa.array(rows[:, 1], pa.int64())], schema=schema)
    return rank


def _item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Stored rows (item, item_id, held): the terms of all rows of an id, each once, dealt to numbered items."""
    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            pairs = [(i, t) for i, text in zip(rows["item_id"], rows["text"])
                     for t in set(terms(text.encode() if isinstance(text, str) else b""))]
            yield pd.DataFrame(pairs, columns=["item_id", "term"])
    known = items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text"))
    pairs = known.mapInArrow(_arrow(split), "item_id long, term binary").distinct()
    return stored(pairs, "item_terms")


def _arrow(fn):
    """``mapInArrow`` from a function on data frames that keeps null ids null."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frames = (b.to_pandas(types_mapper={pa.int64(): pd.Int64Dtype()}.get) for b in batches)
        for out in fn(frames):
            yield pa.RecordBatch.from_arrays([pa.array(out["item_id"], pa.int64(), from_pandas=True),
                                              pa.array(out["term"], pa.binary())], names=["item_id", "term"])
    return run


def _blocks(pairs: DataFrame, block_terms: int) -> tuple[DataFrame, int]:
    """``pairs`` with the number of its block: items in hash order, blocks of about ``block_terms`` rows."""
    total = pairs.count()
    blocks = max(1, -(-total // block_terms))
    return pairs.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(blocks)).cast("int")), blocks


def search(docs: DataFrame, items: DataFrame, top: int = TOP, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text: str = "text", block_terms: int = BLOCK_TERMS,
           share_of_length: int = LENGTH_SHARE) -> DataFrame:
    """item_id, rank, doc_id, score: each item's ``top`` documents of highest positive score."""
    from pyspark.sql.pandas.types import to_arrow_schema
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    pairs, blocks = _blocks(_item_terms(items, item_col, item_text), block_terms)
    empty = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    out_path, written = scratch_path(spark, "ranked"), False
    for block in range(blocks):
        rows = pairs.where(F.col("block") == block).collect()  # about block_terms rows
        if not len(rows):
            continue
        ids = sorted({r["item_id"] for r in rows}, key=lambda x: (x is None, x or 0))
        number = {t: k for k, t in enumerate(sorted({bytes(r["term"]) for r in rows}))}
        held: list[set[int]] = [set() for _ in ids]
        place = {x: i for i, x in enumerate(ids)}
        for r in rows:
            held[place[r["item_id"]]].add(number[bytes(r["term"])])
        post_schema = "doc_id long, n long, held array<long>, tf array<long>"
        arrow = to_arrow_schema(spark.createDataFrame([], post_schema).schema)
        posted = stored(texts.mapInArrow(_poster(number, arrow), post_schema), "postings")
        n_docs, n_all = posted.agg(F.count(F.when(F.col("n") > 0, 1)), F.sum("n")).first()
        if not n_all:
            break
        df = dict(posted.select(F.explode("held").alias("t")).groupBy("t").count().collect())  # one row an item term
        weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df.get(k, 0) + 1)))
                            for k in range(len(number))], dtype=np.int64)
        found_schema = "item long, doc_id long, score long"
        arrow = to_arrow_schema(spark.createDataFrame([], found_schema).schema)
        found = posted.where(F.size("held") > 0).select("doc_id", "n", "held", "tf").mapInArrow(
            _ranker(Dag([frozenset(h) for h in held], len(number)), weights, n_docs, n_all, top, share_of_length, arrow),
            found_schema)
        best = (F.desc("score"), F.asc_nulls_last("doc_id"))
        salted = found.withColumn("salt", F.pmod(F.xxhash64("doc_id", "score"), F.lit(SALTS)))
        for keys in (("item", "salt"), ("item",)):
            salted = salted.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*best))).where(
                F.col("rank") <= top)
        names = spark.createDataFrame([(i, x) for i, x in enumerate(ids)], "item long, item_id long")
        (salted.join(F.broadcast(names), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
         .write.mode("append").parquet(out_path))
        written = True
    return spark.read.schema(empty.schema).parquet(out_path) if written else empty


def query(docs: DataFrame, items: DataFrame) -> DataFrame:
    return search(docs, items)


ORACLE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, string_split_regex(translate(text,
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
p AS (SELECT rid, doc_id, t FROM (SELECT rid, doc_id, unnest(ts) AS t FROM d) WHERE t <> ''),
tf AS (SELECT rid, any_value(doc_id) AS doc_id, t, count(*) AS tf FROM p GROUP BY rid, t),
n AS (SELECT rid, count(*) AS n FROM p GROUP BY rid),
c AS (SELECT count(*) AS big_n, sum(n)::BIGINT AS big_l FROM n),
q AS (SELECT DISTINCT item_id, t FROM (SELECT item_id, unnest(string_split_regex(translate(text,
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t
        FROM benchmark) WHERE t <> ''),
w AS (SELECT t, floor(1000 * ln((2 * big_n + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tf, c GROUP BY t, big_n),
s AS (SELECT q.item_id, tf.rid, any_value(tf.doc_id) AS doc_id,
        sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * big_n) // big_l))))::BIGINT AS score
      FROM q JOIN tf USING (t) JOIN w USING (t) JOIN n USING (rid), c GROUP BY q.item_id, tf.rid),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM r WHERE rank <= 10
"""

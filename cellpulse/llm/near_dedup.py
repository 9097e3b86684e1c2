"""Near-duplicate documents by HyperMinHash.

Sketch: one 64-bit hash per word shingle; its first 7 bits choose a bucket, the
smallest remainder of each bucket is kept as its leading-zero count (6 bits) and
the ``MANTISSA`` bits after the leading one.  Empty buckets borrow from occupied
ones in a fixed pseudo-random order, so small sets agree in each register with
about their Jaccard similarity, too.  ``BANDS`` bands of ``ROWS`` compressed registers
give the candidates; the similarity estimated from equal registers, corrected
for chance collisions of compressed registers, sorts out unlikely ones; the
rest is verified on the full shingle sets, recomputed from whole texts.

No pair of a group is emitted that is not needed for its components:
* documents with equal sets are one node from the start;
* round 1 links every member of a band bucket to the bucket's smallest node only;
* round 2 looks at buckets that still hold several components and verifies the
  likely pairs *across* components, in bounded blocks of the bucket; each pair is
  looked at once, in the first band it shares, and short sets are compared there.
All pairs that share a bucket are then linked, verified or ruled out, so
components are those of all links (a link of similarity 0.8 shares no bucket
with probability below 1e-7; the estimate may miss one in 1e5).

Defined cases: null or wordless text has an empty set and links with nothing; a
text of fewer than ``SHINGLE`` words has one shingle, its whole sequence; rows that
share an id are one document for linking; each row with a null id is a document of its
own, numbered above the largest id while the operator works: it links like any other,
its component is the smallest id reachable (null if there is none) and it is kept only
if no row with an id is reachable and it is the first of its component.  With ids above
2**62 there is no room for such numbers and rows with a null id link with nothing.
An empty table gives an empty result; other columns are ignored.
"""
from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import free_name, small_side, stored

SHINGLE, SIMILAR = 4, 80
REGISTERS, MANTISSA, ROWS, BANDS = 128, 10, 4, 32
#: Standard errors below the threshold at which an estimate rules a pair out.
MARGIN, BLOCK, CACHE_WORDS = 4.5, 1024, 300_000
#: Sets of at most so many shingles travel whole into a split bucket; longer ones are verified afterwards.
SHORT = 1024
#: Largest id that leaves room above it for the numbers of rows with a null id.
ROOM = 1 << 62
_U = np.uint64
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_GOLD = _U(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Shingler:
    """Sorted distinct 64-bit shingle hashes of a text's UTF-8 bytes."""

    def __init__(self, width: int):
        self.width, self.words = width, {}

    def _word(self, word: bytes) -> int:
        if len(self.words) >= CACHE_WORDS:
            self.words.clear()
        value = self.words[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def __call__(self, text: bytes | None) -> np.ndarray:
        found = (text or b"").translate(_LOWER).split()
        if not found:
            return np.zeros(0, dtype=_U)
        get = self.words.get
        w = np.fromiter((self._word(x) if (v := get(x)) is None else v for x in found), dtype=_U, count=len(found))
        width = min(self.width, len(w))
        with np.errstate(over="ignore"):
            h = np.full(len(w) - width + 1, width, dtype=_U)
            for i in range(width):
                h = _mix((h + _GOLD) ^ w[i:len(w) - width + 1 + i])
        return np.unique(h)


@functools.cache
def _borrow() -> np.ndarray:
    """For each bucket the fixed pseudo-random order in which it would borrow from the others."""
    return np.random.default_rng(20).permuted(np.tile(np.arange(REGISTERS), (REGISTERS, 1)), axis=1)


def sketch(hashes: np.ndarray) -> np.ndarray:
    """The HyperMinHash registers (uint16) of a sorted set of hashes (not empty)."""
    bits = REGISTERS.bit_length() - 1
    bucket = (hashes >> _U(64 - bits)).astype(np.int64)
    first = np.flatnonzero(np.diff(bucket, prepend=-1))  # hashes are sorted: the first of a bucket is its smallest
    rest = hashes[first] & _U((1 << (64 - bits)) - 1)
    width = 64 - bits
    length = np.frexp(rest.astype(np.float64))[1].astype(np.int64)
    length -= (rest < (_U(1) << np.maximum(length - 1, 0).astype(_U))).astype(np.int64) * (length > 0)
    zeros = np.minimum(width - length, 63)
    shift = length - 1 - MANTISSA
    mantissa = np.where(shift >= 0, rest >> np.maximum(shift, 0).astype(_U),
                        rest << np.maximum(-shift, 0).astype(_U)).astype(np.int64) & ((1 << MANTISSA) - 1)
    value = ((zeros << MANTISSA) | mantissa).astype(np.uint16)
    out = np.zeros(REGISTERS, dtype=np.uint16)
    place = np.full(REGISTERS, REGISTERS, dtype=np.int64)
    out[bucket[first]] = value
    empty = np.setdiff1d(np.arange(REGISTERS), bucket[first], assume_unique=True)
    if len(empty):
        place[bucket[first]] = np.arange(len(first))
        order = _borrow()[empty]
        lender = np.take_along_axis(order, (place[order] < REGISTERS).argmax(axis=1)[:, None], 1)[:, 0]
        out[empty] = out[lender]
    return out


def band_keys(sketches: np.ndarray) -> np.ndarray:
    """(n, BANDS) 64-bit keys of the bands of (n, REGISTERS) sketches."""
    part = sketches.reshape(len(sketches), BANDS, ROWS).astype(_U)
    with np.errstate(over="ignore"):
        h = np.broadcast_to(np.arange(BANDS, dtype=_U) * _GOLD, part.shape[:2]).copy()
        for i in range(ROWS):
            h = _mix((h + _GOLD) ^ part[:, :, i])
    return h.view(np.int64)


@functools.lru_cache(maxsize=4096)
def _chance(a: int, b: int) -> float:
    """Probability that registers of two unrelated sets of 2**a and 2**b shingles agree."""
    edges = np.concatenate([[0.0], np.ldexp(1.0, np.arange(-63, 1))])
    fine = (edges[:-1, None] + (edges[1:] - edges[:-1])[:, None] * np.linspace(0, 1, 17)[None, :])
    cells = [np.exp(-fine[:, :-1] * lam) - np.exp(-fine[:, 1:] * lam)
             for lam in (max(1.0, 2.0**a / REGISTERS), max(1.0, 2.0**b / REGISTERS))]
    return float((cells[0] * cells[1]).sum() / (2**MANTISSA / 16))


def estimate(equal: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Jaccard estimates from the share of equal registers, corrected for chance collisions."""
    c = np.array([_chance(int(x), int(y)) for x, y in zip(np.log2(a).astype(int), np.log2(b).astype(int))])
    return (equal - c) / (1 - c)


def likely(equal: np.ndarray, a: np.ndarray, b: np.ndarray, similar: int) -> np.ndarray:
    """Whether sets of sizes a, b and this share of equal registers may reach the similarity."""
    s = similar / 100
    filled = REGISTERS * -np.expm1(-np.maximum(a, b) / REGISTERS)
    return ((100 * np.minimum(a, b) >= similar * np.maximum(a, b))
            & (estimate(equal, a, b) >= s - MARGIN * np.sqrt(s * (1 - s) / filled)))


def _batches(fn, out_names: list[str]):
    """mapInArrow over numpy/bytes columns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays(fn(batch), names=out_names)
    return run


def _key(id_col: str, text_col: str) -> Column:
    """Where a row's text is found again: rows of equal keys are told apart by their sets."""
    return F.xxhash64(F.col(id_col).cast("long"), F.col(text_col))


def sketched(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """doc_id, key, n, a, b (128-bit identity of the set), regs of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(width)
        for batch in batches:
            n, a, b, regs = [], [], [], []
            for text in batch.column(2).to_pylist():
                s = shingle(text)
                n.append(len(s))
                raw = xxhash.xxh3_128_intdigest(s.tobytes())
                a.append((raw >> 64) - (1 << 63))
                b.append((raw & (1 << 64) - 1) - (1 << 63))
                regs.append(sketch(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(a, pa.int64()),
                 pa.array(b, pa.int64()), pa.array(regs, pa.binary())], names=["doc_id", "key", "n", "a", "b", "regs"])
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), _key(id_col, text_col).alias("key"),
                       F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, key long, n long, a long, b long, regs binary")


def _bands(nodes: DataFrame) -> DataFrame:
    """key, node, n: one row per node and band."""
    def fn(batch: pa.RecordBatch) -> list[pa.Array]:
        regs = np.frombuffer(b"".join(batch["regs"].to_pylist()), dtype=np.uint16).reshape(-1, REGISTERS)
        rep = np.repeat(np.arange(batch.num_rows), BANDS)
        return [pa.array(band_keys(regs).reshape(-1)), batch["node"].take(pa.array(rep)),
                batch["n"].take(pa.array(rep))]
    return nodes.select("node", "n", "regs").mapInArrow(_batches(fn, ["key", "node", "n"]),
                                                        "key long, node long, n long")


def _probable(pairs: DataFrame, nodes: DataFrame, similar: int) -> DataFrame:
    """Pairs (u, v) that the corrected estimate does not rule out."""
    regs = nodes.select("node", "n", "regs")
    both = (pairs.join(regs.toDF("u", "nu", "ru"), "u").join(regs.toDF("v", "nv", "rv"), "v"))

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            ru, rv = (np.frombuffer(b"".join(b[c].to_pylist()), dtype=np.uint16).reshape(-1, REGISTERS)
                      for c in ("ru", "rv"))
            ok = likely((ru == rv).mean(axis=1), b["nu"].to_numpy(), b["nv"].to_numpy(), similar)
            yield pa.RecordBatch.from_arrays([b["u"].filter(pa.array(ok)), b["v"].filter(pa.array(ok))],
                                             names=["u", "v"])
    return both.select("u", "nu", "ru", "v", "nv", "rv").mapInArrow(fn, "u long, v long")


def _sets(wanted: DataFrame, docs: DataFrame, id_col: str, text_col: str, width: int, name: str) -> DataFrame:
    """node, shingles (sorted 64-bit hashes) of the stored nodes (node, key, a), recomputed from whole texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(width)
        for batch in batches:
            sets = [shingle(t) for t in batch.column(1).to_pylist()]
            ident = [(xxhash.xxh3_128_intdigest(s.tobytes()) >> 64) - (1 << 63) for s in sets]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ident, pa.int64()),
                                              pa.array([s.tobytes() for s in sets], pa.binary())],
                                             names=["key", "a", "shingles"])
    texts = docs.select(_key(id_col, text_col).alias("key"), F.col(text_col).cast("binary").alias("text"))
    texts = texts.join(small_side(wanted.select("key"), 8), "key", "left_semi")
    sets = (texts.mapInArrow(run, "key long, a long, shingles binary").join(small_side(wanted, 24), ["key", "a"])
            .select("node", "shingles").dropDuplicates(["node"]))
    return stored(sets, name)


def _verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, id_col: str, text_col: str, width: int,
              similar: int) -> DataFrame:
    """The pairs whose full sets reach the similarity."""
    wanted = stored(pairs.select(F.col("u").alias("node")).unionByName(pairs.select(F.col("v").alias("node"))).distinct()
                    .join(nodes.select("node", "key", "a"), "node"), "wanted")
    sets = _sets(wanted, docs, id_col, text_col, width, "sets")
    both = pairs.join(sets.toDF("u", "su"), "u").join(sets.toDF("v", "sv"), "v")

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = []
            for x, y in zip(b["su"].to_pylist(), b["sv"].to_pylist()):
                x, y = np.frombuffer(x, dtype=_U), np.frombuffer(y, dtype=_U)
                at = np.searchsorted(x, y)
                common = int((x[np.minimum(at, len(x) - 1)] == y).sum())
                ok.append(100 * common >= similar * (len(x) + len(y) - common))
            keep = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([b["u"].filter(keep), b["v"].filter(keep)], names=["u", "v"])
    return both.select("u", "v", "su", "sv").mapInArrow(fn, "u long, v long")


def components(links: DataFrame) -> DataFrame:
    """node, component (its smallest reachable node) of every linked node: alternating large and small
    stars.  A hub's links are aggregated map-side and joined back, never collected."""
    def both(e: DataFrame) -> DataFrame:
        return e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))

    def mark(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    edges = stored(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                   .where("u <> v").distinct(), "links")
    seen = mark(edges)
    while True:
        around = both(edges)
        low = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = stored(around.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                       .distinct(), "large_star")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select("u", F.col("m").alias("v"))).distinct()
        edges = stored(small, "small_star")
        now = mark(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _across(similar: int):
    """Likely pairs across components between two blocks of a bucket (or within one), each in the first
    band that its two nodes share.  Sets of at most ``SHORT`` shingles are compared whole, on 32 bits of
    each hash: equal bits of different hashes can only add a pair, which verification then drops."""
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        bucket, i, j = key
        regs = np.frombuffer(b"".join(rows["regs"]), dtype=np.uint16).reshape(-1, REGISTERS)
        node, comp, n, blk = (rows[c].to_numpy() for c in ("node", "comp", "n", "blk"))
        band = int(np.flatnonzero(band_keys(regs[:1])[0] == bucket)[0])
        sets = [np.frombuffer(x or b"", dtype=np.uint32) for x in rows["short"]]
        held = np.array([len(x) for x in sets])
        short = held == n  # rows that share an id may meet each other's sets; those are left to verification
        flat = np.concatenate(sets)
        place = np.unique(flat, return_inverse=True)[1].reshape(-1)
        ends = np.cumsum(held)
        largest = pd.Series(comp).mode()[0]  # of two components one at least is another
        seen = np.zeros(int(place.max(initial=-1)) + 1, dtype=np.int64)
        out = []
        for x in np.flatnonzero(comp != largest):
            pick = (comp != comp[x]) & ((comp == largest) | (node > node[x]))
            if i != j:
                pick &= blk != blk[x]
            pick &= 100 * np.minimum(n, n[x]) >= similar * np.maximum(n, n[x])
            others = np.flatnonzero(pick)
            equal = regs[others] == regs[x]
            first = equal.reshape(-1, BANDS, ROWS).all(axis=2).argmax(axis=1) == band
            others, equal = others[first], equal[first]
            if not len(others):
                continue
            ok = likely(equal.mean(axis=1), np.full(len(others), n[x]), n[others], similar)
            others = others[ok]
            if short[x] and len(others):
                seen[place[ends[x] - n[x]:ends[x]]] = 1
                common = np.array([seen[place[ends[y] - n[y]:ends[y]]].sum() if short[y] else n[y] for y in others])
                seen[place[ends[x] - n[x]:ends[x]]] = 0
                others = others[100 * common >= similar * (n[x] + n[others] - common)]
            out += [(node[x], y) for y in node[others]]
        return pd.DataFrame([(min(p), max(p)) for p in out], columns=["u", "v"], dtype="int64")
    return run


def near_links(nodes: DataFrame, docs: DataFrame, id_col: str, text_col: str, width: int,
               similar: int) -> DataFrame:
    """node, component of all nodes that are linked with another one."""
    bands = stored(_bands(nodes), "bands")
    buckets = stored(bands.groupBy("key").agg(F.min("node").alias("center"), F.count(F.lit(1)).alias("members"))
                     .where("members > 1"), "buckets")
    held = bands.join(small_side(buckets, 40), "key")
    held = stored(held, "held")
    pairs = (held.where("node <> center").select(F.col("center").alias("u"), F.col("node").alias("v")).distinct())
    tested = stored(_probable(pairs, nodes, similar), "round1")
    links = stored(_verified(tested, nodes, docs, id_col, text_col, width, similar), "links1")
    found = stored(components(links), "components1")
    # Buckets of three or more members that still hold several components.
    wide = held.where("members > 2").join(small_side(found, 24), "node", "left").withColumn(
        "comp", F.coalesce("component", "node")).drop("component")
    split = (wide.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("size"))
             .where("lo <> hi").select("key", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks")))
    split = stored(split, "split_buckets")
    rows = stored(wide.join(small_side(split, 24), "key"), "split")
    wanted = stored(rows.where(F.col("n") <= SHORT).select("node").distinct()
                    .join(nodes.select("node", "key", "a"), "node"), "short")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b["node"], pa.array(
                [np.frombuffer(x, dtype=_U).astype(np.uint32).tobytes() for x in b["shingles"].to_pylist()],
                pa.binary())], names=["node", "short"])
    sets = _sets(wanted, docs, id_col, text_col, width, "short_sets").mapInArrow(cut, "node long, short binary")
    rows = rows.join(nodes.select("node", "regs").join(sets, "node", "left"), "node")
    rows = rows.withColumn("blk", F.pmod(F.xxhash64("node", F.lit(9)), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "key", F.least("blk", "other").alias("i"), F.greatest("blk", "other").alias("j"), "blk", "node", "comp", "n",
        "regs", "short")
    more = (rows.groupBy("key", "i", "j").applyInPandas(_across(similar), "u long, v long")
            .join(tested.select(F.col("u"), F.col("v")), ["u", "v"], "left_anti"))
    more = stored(more, "round2")
    if more.isEmpty():
        return found
    links2 = stored(_verified(more, nodes, docs, id_col, text_col, width, similar), "links2")
    return stored(components(links.unionByName(links2)), "components2")


def _grouped(docs: DataFrame, id_col: str, text_col: str, width: int, similar: int) -> DataFrame:
    """doc_id, key, n, component_id, kept of every row."""
    top = docs.agg(F.max(F.col(id_col).cast("long"))).first()[0] or 0
    lone = F.lit(top + 1) + F.monotonically_increasing_id() if top < ROOM else F.lit(None)
    rows = stored(sketched(docs, id_col, text_col, width).withColumn("row", F.coalesce("doc_id", lone.cast("long"))),
                  "sketches")
    linkable = rows.where("n > 0 and row is not null")
    same_set = Window.partitionBy("a", "b").orderBy("row")
    nodes = stored(linkable.withColumn("nth", F.row_number().over(same_set)).where("nth = 1")
                   .select(F.col("row").alias("node"), "key", "n", "a", "b", "regs"), "nodes")
    joined = near_links(nodes, docs, id_col, text_col, width, similar)
    # Equal sets are links, too: members point to their set's node, rows that share an id share a component.
    reps = linkable.groupBy("a", "b").agg(F.min("row").alias("node"), F.count(F.lit(1)).alias("members"))
    copies = stored(linkable.join(reps.where("members > 1"), ["a", "b"]).where("row <> node")
                    .select(F.col("row").alias("u"), F.col("node").alias("v")).distinct(), "copies")
    every = copies.join(joined.withColumnRenamed("node", "v"), "v", "left").select(
        F.col("u").alias("node"), F.coalesce("component", "v").alias("component")).unionByName(joined)
    every = stored(every, "labels")
    ids = every.groupBy("node").agg(F.count_distinct("component").alias("c")).where("c > 1")
    if not ids.isEmpty():  # an id with several texts joins their components
        every = stored(components(every.select(F.col("node").alias("u"), F.col("component").alias("v"))), "joined")
    label = every.distinct().withColumnRenamed("node", "l_node")
    out = rows.select("doc_id", "key", "n", "row").join(small_side(stored(label, "label"), 24),
                                                        F.col("row") == F.col("l_node"), "left")
    component = F.coalesce("component", "row")
    return out.select("doc_id", "key", "n", F.when(component <= top, component).alias("component_id"),
                      F.col("row").eqNullSafe(component).alias("kept"))


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE,
                similar: int = SIMILAR) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept."""
    return _grouped(docs, id_col, text_col, width, similar).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id", "kept")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE,
                similar: int = SIMILAR) -> DataFrame:
    """The rows of ``docs`` that stay, one document of each component, with all their columns.

    Rows with an id go by it; rows with a null id go by their text, of equal ones that stay one row does."""
    groups = stored(_grouped(docs, id_col, text_col, width, similar).drop("component_id"), "groups")
    drop = stored(groups.where("not kept and doc_id is not null").select(F.col("doc_id").alias("drop_id")).distinct(),
                  "dropped")
    left = docs.join(small_side(drop, 16), docs[id_col].cast("long") == drop["drop_id"], "left_anti")
    lone = groups.where("doc_id is null and n > 0").groupBy("key").agg(
        F.max("kept").alias("stays"), F.count(F.lit(1)).alias("copies"))
    lone = stored(lone.where("not stays or copies > 1"), "lone")
    if lone.isEmpty():
        return left
    key = free_name(docs, "near_key")
    left = left.withColumn(key, F.when(F.col(id_col).isNull(), _key(id_col, text_col)))
    named = lone.withColumnRenamed("key", key)
    once = left.join(named.where("stays").select(key), key, "left_semi").dropDuplicates([key])
    return left.join(small_side(named.select(key), 16), key, "left_anti").unionByName(once).drop(key)


def query(docs: DataFrame) -> DataFrame:
    return near_groups(docs)

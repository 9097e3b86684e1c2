"""WARC Merkle fixity audit.

Pages are laid out as WARC records in archive files (segments of
``SEGMENT_PAGES`` consecutive page ids), each record at an ordered byte range.
For each replica a Merkle tree hashes the records (leaves) and, level by level,
up to ``FANOUT`` neighbouring (range, digest) pairs into one node, through the
segments up to one root.  The audit compares the two roots and descends only
below nodes whose digests differ: level by level the children of mismatching
nodes are looked up and compared, down to the damaged records.

A tree is stored once per replica, so an audit reads a few nodes per level and
mismatch, never the records again.

Defined cases: null url or html is empty; a null page id gets a segment of its
own (the last); pages with equal ids are ordered by url and html; a record that
one replica lacks differs; two empty replicas give an empty report; other
columns are ignored.
Skew: groups have at most ``FANOUT`` children, segments a bounded number of ids;
the leaf positions set aside for a segment grow with the fullest one, so that
segments never overlap.  The SQL has the usual room and suits segments up to it,
and ids from 0; with negative ids positions count from the first segment.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import small_side, stored

SEGMENT_PAGES, FANOUT, SEGMENT_ROOM = 1000, 16, 4096  # SEGMENT_ROOM: leaf positions of a segment, at least
#: Archive of pages without an id.
NO_ID_SEGMENT = 1 << 40


def _record(url: Column, page_id: Column, html: Column) -> Column:
    return F.concat(F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Target-URI: "), url,
                    F.lit("\r\nWARC-Record-ID: <urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")),
                    F.lit(">\r\nContent-Type: text/html\r\nContent-Length: "),
                    F.octet_length(html).cast("string"), F.lit("\r\n\r\n"), html, F.lit("\r\n\r\n"))


def _read(pages: DataFrame) -> DataFrame:
    """page_id, url, html, record, size: nulls filled, records rendered."""
    p = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    record = _record(F.col("url"), F.col("page_id"), F.col("html"))
    return p.select("*", record.alias("record")).withColumn("size", F.octet_length("record").cast("long"))


def _placed(p: DataFrame, keep: list[str]) -> DataFrame:
    """position (global, ordered), segment, page_id, range_start, range_end and ``keep``; html travels only where it must order
    records of equal id and url."""
    p = p.withColumn("segment", F.coalesce(F.floor(F.col("page_id") / SEGMENT_PAGES), F.lit(NO_ID_SEGMENT)).cast("long"))
    named = F.when(F.col("segment") < NO_ID_SEGMENT, F.col("segment"))
    most, low, high = p.groupBy("segment").count().agg(F.max("count"), F.min(named), F.max(named)).first()
    room, low, high = SEGMENT_ROOM, min(0, low or 0), max(0, high or 0)
    while room < (most or 0):  # repeated or missing ids can fill a segment beyond its usual room
        room *= FANOUT
    if room > SEGMENT_ROOM or low < 0:  # positions count from the first segment, the archive without ids follows the last
        p = p.withColumn("segment", F.least(F.col("segment"), F.lit(high + 1)) - low)
    place = F.xxhash64("page_id", "url")
    again = stored(p.groupBy(place.alias("again")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("again"), "again")
    p = p.withColumn("place", place).join(small_side(again, 24), F.col("place") == F.col("again"), "left")
    p = p.select("segment", "page_id", "url", F.when(F.col("again").isNotNull(), F.col("html")).alias("html"), "size", *keep)
    order = Window.partitionBy("segment").orderBy("page_id", "url", "html")
    end = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))
    return p.select("segment", "page_id", *keep, (end - F.col("size")).alias("range_start"), end.alias("range_end"),
                    (F.col("segment") * room + F.row_number().over(order) - 1).alias("position"))


def records(pages: DataFrame) -> DataFrame:
    """position (global, ordered), segment, page_id, range_start, range_end, record."""
    return _placed(_read(pages), ["record"])


def leaves(recs: DataFrame, record: Column | None = None) -> DataFrame:
    held = F.col("record") if record is None else record
    return recs.select(F.lit(0).alias("level"), F.col("position").alias("node"), "range_start", "range_end",
                       F.sha2(held, 256).alias("digest"), "page_id")


def tree(leaf: DataFrame, levels: int, name: str) -> DataFrame:
    """All nodes: level, node, range_start, range_end, digest, page_id (leaves only)."""
    level = stored(leaf, f"{name}_0")
    out = level
    for k in range(1, levels + 1):
        child = F.struct("node", "range_start", "range_end", "digest")
        parts = F.transform(F.sort_array(F.collect_list(child)), lambda c: F.concat(
            c["range_start"].cast("string"), F.lit("-"), c["range_end"].cast("string"), F.lit(":"), c["digest"]))
        level = stored(level.groupBy(F.expr(f"node div {FANOUT}").alias("parent")).agg(
            F.min("range_start").alias("range_start"), F.max("range_end").alias("range_end"),
            F.sha2(F.array_join(parts, ";"), 256).alias("digest"))
            .select(F.lit(k).alias("level"), F.col("parent").alias("node"), "range_start", "range_end", "digest",
                    F.lit(None).cast(leaf.schema["page_id"].dataType).alias("page_id")), f"{name}_{k}")
        out = out.unionByName(level)
    return out


def audit(a: DataFrame, b: DataFrame, levels: int) -> DataFrame:
    """Every node compared: level, node, range, both digests, equal, page_id of records."""
    side = ("level", "node", "range_start", "range_end", "digest", "page_id")
    report, wanted = None, None
    for k in range(levels, -1, -1):
        left, right = (t.where(F.col("level") == k).select(*(F.col(c).alias(f"{s}_{c}") for c in side))
                       for s, t in (("a", a), ("b", b)))
        if wanted is not None:  # only children of mismatching nodes
            left = left.join(wanted, F.expr(f"a_node div {FANOUT}") == wanted["parent"], "left_semi")
            right = right.join(wanted, F.expr(f"b_node div {FANOUT}") == wanted["parent"], "left_semi")
        seen = stored(left.join(right, left["a_node"] == right["b_node"], "full").select(
            F.lit(k).alias("level"), F.coalesce("a_node", "b_node").alias("node"),
            F.coalesce("a_range_start", "b_range_start").alias("range_start"),
            F.coalesce("a_range_end", "b_range_end").alias("range_end"), F.col("a_digest").alias("digest_a"),
            F.col("b_digest").alias("digest_b"),
            (F.col("a_digest").eqNullSafe(F.col("b_digest"))
             & F.col("a_range_end").eqNullSafe(F.col("b_range_end"))).alias("equal"),
            F.coalesce("a_page_id", "b_page_id").alias("page_id")), f"seen_{k}")
        report = seen if report is None else report.unionByName(seen)
        wanted = small_side(seen.where("not equal").select(F.col("node").alias("parent")), 16)
    return report


def depth(*leaf_tables: DataFrame) -> int:
    """Levels above the leaves until one node is left (one driver row per replica)."""
    top = max((t.agg(F.max("node")).first()[0] or 0) for t in leaf_tables)
    levels = 0
    while top:
        top //= FANOUT
        levels += 1
    return levels


def damaged(digest: Column, record: Column) -> Column:
    """The replica of the registered query: bit rot by content.  By the first two hex
    digits of its digest a record lost a byte's value (00), its second half (01) or everything (02)."""
    two = F.substring(digest, 1, 2)
    return (F.when(two == "00", F.concat(F.lit("X"), F.expr("substring(record, 2)")))
            .when(two == "01", F.expr("substring(record, 1, length(record) div 2)"))
            .when(two == "02", F.lit("")).otherwise(record))


def query(pages: DataFrame) -> DataFrame:
    p = _read(pages).withColumn("digest_a", F.sha2("record", 256)).withColumn(
        "digest_b", F.sha2(damaged(F.col("digest_a"), F.col("record")), 256))
    placed = stored(_placed(p, ["digest_a", "digest_b"]), "placed")  # texts stay where they were read
    a, b = (placed.select(F.lit(0).alias("level"), F.col("position").alias("node"), "range_start", "range_end",
                          F.col(f"digest_{s}").alias("digest"), "page_id") for s in "ab")
    levels = depth(a)
    return audit(tree(a, levels, "a"), tree(b, levels, "b"), levels)


def _oracle(levels: int = 7) -> str:
    parts = [f"""
WITH p AS (SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html,
    coalesce(floor(page_id / {SEGMENT_PAGES}.0)::BIGINT, {NO_ID_SEGMENT}) AS segment FROM pages),
q AS (SELECT *, 'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10) || 'WARC-Target-URI: '
    || url || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:' || coalesce(page_id::VARCHAR, 'none') || '>' || chr(13)
    || chr(10) || 'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: ' || strlen(html)::VARCHAR
    || chr(13) || chr(10) || chr(13) || chr(10) || html || chr(13) || chr(10) || chr(13) || chr(10) AS rec FROM p),
r AS (SELECT *, sha256(rec) AS good, segment * {SEGMENT_ROOM} + row_number() OVER w - 1 AS node,
    sum(strlen(rec)) OVER w::BIGINT AS range_end FROM q
    WINDOW w AS (PARTITION BY segment ORDER BY page_id, url, html ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
n0 AS (SELECT node, range_end - strlen(rec) AS range_start, range_end, good AS digest_a, page_id,
    sha256(CASE good[1:2] WHEN '00' THEN 'X' || rec[2:] WHEN '01' THEN left(rec, length(rec) // 2) WHEN '02' THEN ''
           ELSE rec END) AS digest_b FROM r)""".replace("OVER w::BIGINT", "OVER w")]
    for k in range(1, levels + 1):
        agg = ", ".join(f"sha256(string_agg(range_start::VARCHAR || '-' || range_end::VARCHAR || ':' || digest_{s}, "
                        f"';' ORDER BY node)) AS digest_{s}" for s in "ab")
        parts.append(f"n{k} AS (SELECT node // {FANOUT} AS node, min(range_start) AS range_start, "
                     f"max(range_end) AS range_end, NULL AS page_id, {agg} FROM n{k - 1} GROUP BY 1)")
    every = " UNION ALL ".join(
        f"SELECT {k} AS level, node, range_start::BIGINT AS range_start, range_end::BIGINT AS range_end, digest_a, "
        f"digest_b, digest_a = digest_b AS equal, page_id FROM n{k}" for k in range(levels + 1))
    parts.append(f"t AS ({every})")
    parts.append("root AS (SELECT min(level) AS level FROM (SELECT level FROM t GROUP BY level HAVING max(node) = 0))")
    return ",\n".join(parts) + f"""
SELECT t.* FROM t, root WHERE t.level = root.level OR (t.level < root.level AND EXISTS (
  SELECT 1 FROM t AS up WHERE up.level = t.level + 1 AND up.node = t.node // {FANOUT} AND NOT up.equal))
"""


ORACLE_SQL = _oracle()

"""Line dedup with DataFrame functions only.

Lines are exploded to (document, position, key hash); a key's documents are
counted by partial aggregation over each document's distinct keys; the lines of
keys found in at least ``min_docs`` documents are dropped; documents are
reassembled by position.

A line's key is the line stripped at both ends of ``[\\x20\\x09-\\x0D]`` with A-Z
lower-cased.  Each key is made once and kept as two 64-bit hashes with
different seeds.  Keys are counted by the first; where lines of one first hash differ in the
second, that hash's keys are counted anew by both.  Line texts are never shuffled line by line: only
hashes and positions travel, and a document's own lines are picked where its text lies.

Defined cases: null or empty text is one empty line; keys shorter than
``min_chars`` code points never lose lines; a document is a row, and rows that
repeat id and text are equal documents that count separately and get equal
results; null ids are ordinary ids; an empty table gives an empty result.
Work and memory grow in proportion to a text's lines, however many it has.
Skew: a line that a third of all documents share is one row per document before
the count and is pre-aggregated map-side; the marks are joined by the frequent
key, broadcast only below a counted size and skew-split otherwise.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import SPACES, free_name, small_side, stored, text_or_empty

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lines(text: str) -> Column:
    return F.split(text_or_empty(text), "\n", -1)


def _keys(lines: Column) -> Column:
    return F.transform(lines, lambda line: F.translate(F.btrim(line, F.lit(SPACES)), _UPPER, _LOWER))


def _frequent(keyed: DataFrame, min_docs: int) -> DataFrame:
    """(a, b) of the keys found in at least ``min_docs`` rows of ``keyed`` (row, k_id, k_hash, a, b)."""
    often = stored(keyed.select(F.explode(F.array_distinct("a")).alias("a")).where(F.col("a").isNotNull())
                   .groupBy("a").agg(F.count(F.lit(1)).alias("docs")).where(F.col("docs") >= min_docs).select("a"), "often")
    lines = (keyed.select("row", F.explode(F.arrays_zip("a", "b")).alias("k")).select("row", "k.a", "k.b")
             .join(small_side(often, 24), "a", "left_semi"))
    seconds = stored(lines.groupBy("a").agg(F.min("b").alias("b"), F.max("b").alias("other")), "seconds")
    mixed = seconds.where(F.col("b") != F.col("other")).select("a")
    if mixed.isEmpty():
        return seconds.select("a", "b")
    exact = (lines.join(mixed, "a", "left_semi").distinct().groupBy("a", "b").agg(F.count(F.lit(1)).alias("docs"))
             .where(F.col("docs") >= min_docs).select("a", "b"))
    return stored(seconds.where(F.col("b") == F.col("other")).select("a", "b").unionByName(exact), "frequent_lines")


def drop_frequent_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, id_col: str = "doc_id",
                        text_col: str = "text") -> DataFrame:
    """``docs`` with its text cleaned, plus n_lines and n_dropped (names made free if taken)."""
    k_id, k_hash, drop_pos = (free_name(docs, c) for c in ("k_id", "k_hash", "drop_pos"))
    row_hash = F.xxhash64(text_or_empty(text_col))
    keyed = docs.select(F.col(id_col).alias("k_id"), row_hash.alias("k_hash"), _keys(_lines(text_col)).alias("keys"))
    keyed = stored(keyed.select(
        F.monotonically_increasing_id().alias("row"), "k_id", "k_hash",
        F.transform("keys", lambda k: F.when(F.length(k) >= min_chars, F.xxhash64(k))).alias("a"),
        F.transform("keys", lambda k: F.xxhash64(F.lit("line"), k)).alias("b")), "line_keys")
    frequent = _frequent(keyed, min_docs)
    marks = (keyed.select("k_id", "k_hash", F.posexplode(F.arrays_zip("a", "b")).alias("pos", "key"))
             .select("k_id", "k_hash", "pos", "key.a", "key.b")
             .join(small_side(frequent, 32), ["a", "b"], "left_semi")
             .groupBy(F.col("k_id").alias(k_id), F.col("k_hash").alias(k_hash))
             .agg(F.collect_set("pos").alias(drop_pos)))
    same = docs[id_col].eqNullSafe(marks[k_id]) & (row_hash == marks[k_hash])
    lines, n_lines, n_dropped = (free_name(docs, c) for c in ("line_list", "n_lines", "n_dropped"))
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(drop_pos))
    kept = F.concat_ws("\n", F.transform(left, lambda i: F.get(F.col(lines), i)))
    return (docs.join(marks, same, "left").withColumn(lines, _lines(text_col))
            .withColumn(n_lines, F.size(lines).cast("long"))
            .withColumn(n_dropped, F.coalesce(F.size(drop_pos), F.lit(0)).cast("long"))
            .withColumn(text_col, F.when(F.col(drop_pos).isNull(), text_or_empty(text_col)).otherwise(kept))
            .select(*docs.columns, n_lines, n_dropped))


def query(docs: DataFrame) -> DataFrame:
    out = drop_frequent_lines(docs.select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


ORACLE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
x AS (SELECT rid, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM d),
k AS (SELECT rid, pos, line, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''),
        '[\x20\x09-\x0D]+$', ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM x),
f AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT rid) >= 10),
m AS (SELECT k.rid, k.pos, k.line, f.key IS NOT NULL AS dropped FROM k LEFT JOIN f ON k.key = f.key)
SELECT d.doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM m JOIN d USING (rid) GROUP BY d.rid, d.doc_id
"""

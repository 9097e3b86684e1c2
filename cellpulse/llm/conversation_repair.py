"""Conversation structure repair by a grammar-compressed dynamic program.

A conversation's rows, by turn, become symbols: ``X`` for a row that must go (blank
or duplicate), else its role's initial (``o`` for any but s, u, a), upper case
when the text is truncated.  The cheapest edits to a role sequence ``(s?(ua)+)?`` are a shortest
path in an automaton of four states (nothing yet, after s, after u, after a).  The
edits of a run of symbols are a min-plus matrix over those states whose entries
hold the cost and the edit initials (the ASCII-least of equal cost, which
concatenation respects: edits of equal cost and equal rows are never each other's prefix).
Re-Pair finds frequent neighbours over all conversations: in each round Spark counts the
pairs of neighbouring symbols in all stored sequences, and the most frequent, disjoint pairs become rules.
Each rule's matrix is computed once, bottom-up from its two parts, its edit initials a rope of the
parts' ropes, and serves every conversation; a task replaces its sequences by the
rules and multiplies what is left.

Rows are dealt by range of (conversation, turn, role, text), so each task holds a
contiguous piece of the order, and a conversation of any size is cut
into segments of at most ``ROWS`` rows or ``BYTES`` of text.  Conversations that lie in one segment are finished
there.  The others give one matrix and the counts a segment; these few rows are
composed, ``FAN`` segments at a time, the chosen path goes back to the segments, each
repairs its own rows, and the pieces are hashed in order.  (SHA-256 of one long text
is serial by nature: one task streams a conversation's repaired pieces, bounded in memory.)

Damage, faults and edits are those of :func:`repair`.  Rows of equal turn are
ordered by role, then by the first ``PREFIX`` characters of the text, then its hash; null
turns come first.

Defined cases: null role and text are one space (so such a text is blank and such
a role must be changed); null conversation ids are one conversation of their own;
repeated rows are duplicates of each other; a conversation without rows after
damage has zeros, an empty audit and the hash of an empty string; other columns
are ignored; an empty table gives an empty result.
Skew: a hot conversation or turn spreads over the ranges; the place of a row is
the last range key, so even equal rows split.
"""
from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import SPACES, small_side, stored

KEEP_TRUNCATED, REROLE, DELETE, INSERT = 3, 3, 4, 3
#: Rows and text bytes of a segment; segments composed at a time; text characters that order equal turns and roles.
ROWS, BYTES, FAN, PREFIX = 4096, 4 << 20, 64, 64
#: Rounds of the grammar, rules a round, and the least share of all pairs a rule's pair has.
ROUNDS, RULES, LEAST = 6, 12, 0.002
STATES = 4  # nothing yet, after s, after u, after a
_AFTER = {"u": 2, "a": 3}


# Ropes and min-plus matrices ---------------------------------------------------------------------------------------
class Rope:
    """An immutable string of edit initials that shares its parts."""
    __slots__ = ("left", "right", "leaf")
    FLAT = 64

    def __init__(self, leaf: str | None, left: "Rope | None" = None, right: "Rope | None" = None):
        self.leaf, self.left, self.right = leaf, left, right

    def __add__(self, other: "Rope") -> "Rope":
        if self.leaf is not None and other.leaf is not None and len(self.leaf) + len(other.leaf) <= self.FLAT:
            return Rope(self.leaf + other.leaf)
        return Rope(None, self, other)

    def leaves(self) -> Iterator[str]:
        stack = [self]
        while stack:
            node = stack.pop()
            if node.leaf is not None:
                yield node.leaf
            else:
                stack += (node.right, node.left)

    def __str__(self) -> str:
        return "".join(self.leaves())

    def __lt__(self, other: "Rope") -> bool:
        a, b = self.leaves(), other.leaves()
        x, y = "", ""
        while True:
            while x == "":
                x = next(a, None)
            while y == "":
                y = next(b, None)
            if x is None or y is None:
                return x is None and y is not None
            n = min(len(x), len(y))
            if x[:n] != y[:n]:
                return x[:n] < y[:n]
            x, y = x[n:], y[n:]


# A matrix maps (state before, state after) to (cost, rope); missing pairs are impossible.
Matrix = dict[tuple[int, int], tuple[int, Rope]]


def better(a: tuple, b: tuple | None) -> bool:
    return b is None or a[0] < b[0] or (a[0] == b[0] and a[1] < b[1])


def times(a: Matrix, b: Matrix) -> Matrix:
    out: Matrix = {}
    for (i, k), (cost, rope) in a.items():
        for j in range(STATES):
            step = b.get((k, j))
            if step is None:
                continue
            old = out.get((i, j))
            if old is not None and old[0] < cost + step[0]:
                continue
            new = (cost + step[0], rope + step[1])
            if better(new, old):
                out[i, j] = new
    return out


def _inserts() -> Matrix:
    """Any inserts: more than one role pair never pays."""
    out: Matrix = {(i, i): (0, Rope("")) for i in range(STATES)}
    for i in range(STATES):
        first = 3 if i == 2 else 2
        out[i, first] = (INSERT, Rope("I"))
        if i < 2:
            out[i, 3] = (2 * INSERT, Rope("II"))
    return out


def _row(symbol: str) -> Matrix:
    """The edits of one row alone."""
    out: Matrix = {(i, i): (DELETE, Rope("D")) for i in range(STATES)}
    if symbol == "X":
        return out
    extra = KEEP_TRUNCATED if symbol.isupper() else 0
    role = symbol.lower()
    for i in range(STATES):
        after = 3 if i == 2 else 2
        out[i, after] = (REROLE + extra, Rope("R"))
        if _AFTER.get(role) == after:
            out[i, after] = (extra, Rope("K"))
    if role == "s":
        out[0, 1] = (extra, Rope("K"))
    return out


@lru_cache(maxsize=None)
def _inserted() -> Matrix:
    return _inserts()


@lru_cache(maxsize=None)
def _terminal(symbol: str) -> Matrix:
    return times(_inserted(), _row(symbol))


class Grammar:
    """Re-Pair rules; symbols are strings, rule ``k`` is ``<k>``.  One matrix a rule, built from its two parts."""

    def __init__(self, rules: list[tuple[str, str]]):
        self.rules = rules
        self.names = {pair: f"<{k}>" for k, pair in enumerate(rules)}
        self.matrices: dict[str, Matrix] = {}
        for k, (a, b) in enumerate(rules):
            self.matrices[f"<{k}>"] = times(self.matrix(a), self.matrix(b))
        self.known: dict[str, Matrix] = {}

    def matrix(self, symbol: str) -> Matrix:
        return self.matrices.get(symbol) or _terminal(symbol)

    def compress(self, symbols: str) -> list[str]:
        """The sequence with the rules applied in the order they were made."""
        out = list(symbols)
        for pair, name in self.names.items():
            if len(out) < 2:
                break
            a, b = pair
            if a not in out:
                continue
            new, k = [], 0
            while k < len(out):
                if out[k] == a and k + 1 < len(out) and out[k + 1] == b:
                    new.append(name)
                    k += 2
                else:
                    new.append(out[k])
                    k += 1
            out = new
        return out

    def product(self, symbols: str) -> Matrix:
        """The matrix of a sequence of rows, shared by all sequences alike that a task meets."""
        got = self.known.get(symbols)
        if got is None:
            parts = [self.matrix(s) for s in self.compress(symbols)] or [{(i, i): (0, Rope("")) for i in range(STATES)}]
            while len(parts) > 1:
                parts = [times(*parts[k:k + 2]) if k + 1 < len(parts) else parts[k] for k in range(0, len(parts), 2)]
            got = parts[0]
            if len(symbols) <= 64:
                if len(self.known) > 50_000:
                    self.known.clear()
                self.known[symbols] = got
        return got


def finish(total: Matrix) -> tuple[int, str]:
    """(cost, audit) from a conversation's matrix: from nothing, then inserts, to nothing or after an assistant."""
    closed = times(total, _inserted())
    best = None
    for j in (0, 3):
        new = closed.get((0, j))
        if new is not None and better(new, best):
            best = new
    return best[0], str(best[1])


def rewrite(audit: str, rows: list[tuple[str, str]], state: int) -> list[str]:
    """The repaired ``role:text`` lines of rows under their edits, entered in ``state``."""
    out, k = [], 0
    for edit in audit:
        if edit == "D":
            k += 1
            continue
        due = "assistant" if state == 2 else "user"
        if edit == "I":
            out.append(f"{due}:")
        else:
            role, text = rows[k]
            k += 1
            out.append(f"{role if edit == 'K' else due}:{text}")
            if edit == "K" and state == 0 and role[:1] == "s":
                state = 1
                continue
        state = 3 if due == "assistant" else 2
    return out


# Rows --------------------------------------------------------------------------------------------------------------
def _spaced(c: Column | str) -> Column:
    return F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(" "))


def damaged(conversations: DataFrame) -> DataFrame:
    """conv, turn, role, text, copies: rows whose code drops them stay as one without copies, so no conversation is lost.

    ``conv`` is the id as text after ``=``, empty for a null id.
    """
    code = F.crc32(F.concat(_spaced("conv_id"), F.lit(":"), _spaced("turn"))) % 20
    text = (F.when(code == 0, "").when(code == 1, "").when(code == 2, F.translate(_spaced("text"), ".!?", ""))
            .otherwise(_spaced("text")))
    return conversations.select(
        F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("conv"), F.when(code != 0, F.col("turn").cast("long")).alias("turn"),
        F.when(code == 0, "").when(code == 4, "user").otherwise(_spaced("role")).alias("role"), text.alias("text"),
        F.when(code == 0, 0).when(code == 3, 2).otherwise(1).alias("copies"))


def _ordered(rows: DataFrame) -> DataFrame:
    """``rows`` of :func:`damaged` dealt by range and sorted, with ``again`` where role and text were seen earlier."""
    rows = stored(rows.withColumn("place", F.monotonically_increasing_id()).withColumn("h1", F.xxhash64("text"))
                  .withColumn("h2", F.xxhash64(F.lit("row"), "role", "text")), "damaged")
    first = F.min(F.struct(F.col("turn").isNotNull().alias("t0"), "turn", "place"))
    same = ["conv", "role", "h1", "h2"]
    firsts = stored(rows.where("copies > 0").groupBy(*same).agg(first.alias("f"), F.count(F.lit(1)).alias("n"))
                    .where("n > 1").select(*same, F.col("f.place").alias("f_place")), "firsts")
    marked = rows.join(small_side(firsts, 128), same, "left")
    last = F.substring(F.rtrim("text", F.lit(SPACES)), -1, 1)
    order = ["conv", "turn", "role", F.substring("text", 1, PREFIX), "h1", "place"]
    return marked.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv", "turn", "role", "text", "copies", (F.col("f_place") != F.col("place")).alias("again"),
        (last == "").alias("blank"), (~last.isin(".", "!", "?")).alias("cut"))


class Counts:
    """Counts of a run of rows that add up with those of the next run."""
    FIELDS = ("rows", "least", "most", "turns", "first", "final", "head", "tail", "blank", "duplicate", "truncated", "illegal")
    __slots__ = FIELDS

    def __init__(self, *values):
        for name, v in zip(self.FIELDS, values or (0, None, None, 0, None, None, None, None, 0, 0, 0, 0)):
            setattr(self, name, v)

    def values(self) -> list:
        return [getattr(self, f) for f in self.FIELDS]

    def add(self, turn: int | None, initial: str, fault: str) -> None:
        one = Counts(1, turn, turn, int(turn is not None), turn, turn, initial, initial, int(fault == "blank"),
                     int(fault == "duplicate"), int(fault == "truncated"), 0)
        self.join(one)

    def join(self, b: "Counts") -> None:
        """Append the counts of the rows that follow."""
        if not b.rows:
            return
        if self.rows:
            self.illegal += b.illegal + (self.tail + b.head not in ("su", "ua", "au"))
        else:
            self.illegal, self.head = b.illegal, b.head
        self.tail = b.tail
        self.rows += b.rows
        if b.turns:
            self.turns += b.turns - (self.turns > 0 and self.final == b.first)
            self.least, self.first = (b.least, b.first) if self.least is None else (self.least, self.first)
            self.most, self.final = b.most, b.final
        for f in ("blank", "duplicate", "truncated"):
            setattr(self, f, getattr(self, f) + getattr(b, f))

    def figures(self) -> list[int]:
        """gaps, blank, duplicate, truncated, illegal"""
        gaps = 0 if self.least is None else min(self.most - self.least + 1 - self.turns, (1 << 63) - 1)
        return [gaps, self.blank, self.duplicate, self.truncated, self.illegal]


_SEGMENT = "conv string, task long, seg long, open boolean, counts string, symbols string, roles array<string>, texts array<string>"
_FIGURES = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _batch(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(columns, schema)], schema=schema)


def _segmenter(schema: pa.Schema, rows_limit: int, bytes_limit: int):
    """Cut a task's sorted rows into segments; open ones may go on in another segment or task."""
    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        out, size, seg = [], 0, 0
        conv, fresh, held = None, False, 0
        counts, symbols, roles, texts = Counts(), [], [], []

        def closed(is_open: bool) -> list:
            return [conv, task, seg, is_open, json.dumps(counts.values()), "".join(symbols), roles, texts]
        for batch in batches:
            for c, turn, role, text, copies, again, blank, cut in zip(*(col.to_pylist() for col in batch.columns)):
                if conv is None:
                    conv = c
                elif c != conv or len(roles) >= rows_limit or held >= bytes_limit:
                    out.append(closed(not (fresh and c != conv)))
                    size += held
                    if size >= bytes_limit or len(out) >= 1024:
                        yield _batch(out, schema)
                        out, size = [], 0
                    conv, fresh, held, seg = c, c != conv, 0, seg + 1
                    counts, symbols, roles, texts = Counts(), [], [], []
                initial = role[:1]
                plain = initial if initial in ("s", "u", "a") else "o"
                for k in range(copies):
                    fault = "blank" if blank else "duplicate" if again or k else "truncated" if cut else ""
                    counts.add(turn, initial, fault)
                    symbols.append("X" if fault in ("blank", "duplicate") else plain.upper() if fault else plain)
                    roles.append(role)
                    texts.append(text)
                    held += len(text)
        if conv is not None:
            out.append(closed(True))
        yield _batch(out, schema)
    return segments


def mine(sequences: DataFrame, rounds: int = ROUNDS, rules_a_round: int = RULES) -> Grammar:
    """Re-Pair over all sequences: each round Spark counts the neighbours left by the rules so far."""
    rules: list[tuple[str, str]] = []
    for _ in range(rounds):
        grammar = Grammar(rules)
        counted = sequences.mapInPandas(_pair_counter(grammar), "a string, b string, n long")
        pairs = counted.groupBy("a", "b").agg(F.sum("n").alias("n")).collect()  # at most the square of symbols and rules
        total = sum(r["n"] for r in pairs)
        fresh, used = [], set()
        for r in sorted(pairs, key=lambda r: (-r["n"], r["a"], r["b"])):
            if r["n"] < max(2, LEAST * total) or len(fresh) == rules_a_round:
                break
            if not used & {r["a"], r["b"]}:
                used |= {r["a"], r["b"]}
                fresh.append((r["a"], r["b"]))
        if not fresh:
            break
        rules = rules + fresh
    return Grammar(rules)


def _pair_counter(grammar: Grammar):
    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[tuple[str, str], int] = {}
        for frame in frames:
            for symbols, n in frame["symbols"].value_counts().items():
                parts = grammar.compress(symbols)
                for pair in zip(parts, parts[1:]):
                    seen[pair] = seen.get(pair, 0) + int(n)
        yield pd.DataFrame([(a, b, n) for (a, b), n in seen.items()], columns=["a", "b", "n"])
    return count


def _whole(grammar: Grammar, schema: pa.Schema):
    """Finish conversations that lie in one segment."""
    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for conv, raw, symbols, roles, texts in zip(*(col.to_pylist() for col in batch.columns)):
                cost, audit = finish(grammar.product(symbols))
                lines = rewrite(audit, list(zip(roles, texts)), 0)
                sha = hashlib.sha256("\n".join(lines).encode("utf-8", "surrogatepass")).hexdigest()
                rows.append([conv, *Counts(*json.loads(raw)).figures(), cost, audit, sha])
            yield _batch(rows, schema)
    return solve


def _matrices(grammar: Grammar):
    def to_matrix(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            f["matrix"] = [dump({k: (c, r, [k[1]]) for k, (c, r) in grammar.product(s).items()}) for s in f["symbols"]]
            yield f[["conv", "task", "seg", "counts", "matrix"]]
    return to_matrix


# A composed matrix also lists, per entry, the state after each of its segments.
def dump(m: dict) -> str:
    return json.dumps([(i, j, c, str(r), p) for (i, j), (c, r, p) in m.items()])


def load(raw: str) -> dict:
    return {(i, j): (c, Rope(r), p) for i, j, c, r, p in json.loads(raw)}


def _join_paths(a: dict, b: dict) -> dict:
    out: dict = {}
    for (i, k), (cost, rope, path) in a.items():
        for j in range(STATES):
            step = b.get((k, j))
            if step is not None and (out.get((i, j)) is None or cost + step[0] <= out[i, j][0]):
                new = (cost + step[0], rope + step[1], path + step[2])
                if better(new[:2], out.get((i, j)) and out[i, j][:2]):
                    out[i, j] = new
    return out


def _fold(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame.sort_values(["task", "seg"])
    counts, total = Counts(), None
    for raw_counts, raw in zip(frame["counts"], frame["matrix"]):
        counts.join(Counts(*json.loads(raw_counts)))
        total = load(raw) if total is None else _join_paths(total, load(raw))
    row = frame.iloc[0]
    return pd.DataFrame([[row["conv"], row["task"], row["seg"], json.dumps(counts.values()), dump(total), row["nth"] // FAN]],
                        columns=["conv", "task", "seg", "counts", "matrix", "nth"])


def _close(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The figures of each conversation and the state after each of its segments."""
    end = {k: (c, r, []) for k, (c, r) in _inserted().items()}
    for f in frames:
        rows = []
        for conv, raw_counts, raw in zip(f["conv"], f["counts"], f["matrix"]):
            total = _join_paths(load(raw), end)
            cost, audit, path = min((total[0, j] for j in (0, 3) if (0, j) in total), key=lambda x: (x[0], str(x[1])))
            rows.append([conv, *Counts(*json.loads(raw_counts)).figures(), cost, str(audit), path])
        yield pd.DataFrame(rows, columns=["conv", *(x.split()[0] for x in _FIGURES.split(", ")), "path"])


def _repairer(grammar: Grammar):
    """Each open segment's repaired piece, entered and left in the states of the chosen path."""
    def pieces(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            got = []
            for symbols, roles, texts, path, at in zip(f["symbols"], f["roles"], f["texts"], f["path"], f["at"]):
                before, after = (0 if at == 0 else path[at - 1]), path[at]
                m = grammar.product(symbols)
                audit = str(m[before, after][1])
                if at == len(path) - 1:
                    tail = {j: (_inserted()[after, j]) for j in (0, 3) if (after, j) in _inserted()}
                    audit += str(min(tail.values(), key=lambda x: (x[0], str(x[1])))[1])
                got.append(rewrite(audit, list(zip(roles, texts)), before))
            f = f[["conv", "task", "seg"]].copy()
            f["lines"], f["piece"] = [len(g) for g in got], ["\n".join(g) for g in got]
            yield f
    return pieces


def _hasher(schema: pa.Schema):
    """Stream the pieces of whole conversations in order through SHA-256."""
    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, sha, any_line, begun, done = None, hashlib.sha256(), False, False, []
        for batch in batches:
            for c, lines, piece in zip(*(batch.column(x).to_pylist() for x in ("conv", "lines", "piece"))):
                if begun and c != conv:
                    done.append((conv, sha.hexdigest()))
                    sha, any_line = hashlib.sha256(), False
                conv, begun = c, True
                if lines:
                    sha.update((("\n" if any_line else "") + piece).encode("utf-8", "surrogatepass"))
                    any_line = True
        if begun:
            done.append((conv, sha.hexdigest()))
        yield pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], f.type) for k, f in enumerate(schema)], schema=schema)
    return stream


def repair(conversations: DataFrame, rows_limit: int = ROWS, bytes_limit: int = BYTES) -> DataFrame:
    """One row per conv_id: gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Damage by ``crc32(conv_id:turn) % 20``: 0 drops the row, 1 empties its text, 2 removes its ``.!?``, 3 repeats it, 4 sets
    role user.  Edits: keep (0, truncated 3 more), re-role (3, likewise), delete (4), insert an empty user or assistant row (3).
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    spark = conversations.sparkSession
    id_type = conversations.schema["conv_id"].dataType

    def arrow(ddl: str) -> pa.Schema:
        return to_arrow_schema(spark.createDataFrame([], ddl).schema)
    result = f"conv string, {_FIGURES}, repaired_sha256 string"
    segments = stored(_ordered(damaged(conversations)).mapInArrow(
        _segmenter(arrow(_SEGMENT), rows_limit, bytes_limit), _SEGMENT), "segments")
    grammar = mine(segments.select("symbols"))
    whole = segments.where("not open").select("conv", "counts", "symbols", "roles", "texts").mapInArrow(
        _whole(grammar, arrow(result)), result)
    split = _across(segments.where("open"), grammar, arrow)
    conv_id = F.when(F.col("conv") != "", F.expr("substring(conv, 2)").cast(id_type)).alias("conv_id")
    return whole.unionByName(split).select(conv_id, *(x.split()[0] for x in result.split(", ")[1:]))


def _across(segments: DataFrame, grammar: Grammar, arrow) -> DataFrame:
    """The rows of conversations whose segments must be composed."""
    ddl = "conv string, task long, seg long, counts string, matrix string"
    parts = stored(segments.select("conv", "task", "seg", "counts", "symbols").mapInPandas(_matrices(grammar), ddl), "matrices")
    numbered = stored(_numbered(parts), "numbered")
    level, most = numbered, numbered.agg(F.max("nth")).first()[0] or 0
    while most:
        level = level.withColumn("grp", F.floor(F.col("nth") / FAN)).groupBy("conv", "grp").applyInPandas(
            _fold, ddl + ", nth long")
        most //= FAN
    closed = stored(level.select("conv", "counts", "matrix").mapInPandas(_close, f"conv string, {_FIGURES}, path array<int>"),
                    "closed")
    placed = segments.join(numbered.select("task", "seg", F.col("nth").alias("at")), ["task", "seg"]).join(
        closed.select("conv", "path"), "conv")
    pieces = placed.select("conv", "task", "seg", "symbols", "roles", "texts", "path", "at").mapInPandas(
        _repairer(grammar), "conv string, task long, seg long, lines long, piece string")
    sha = "conv string, repaired_sha256 string"
    hashed = pieces.repartition("conv").sortWithinPartitions("conv", "task", "seg").mapInArrow(_hasher(arrow(sha)), sha)
    return closed.drop("path").join(hashed, "conv")


def _numbered(parts: DataFrame) -> DataFrame:
    """``parts`` with each segment's place ``nth`` in its conversation: its place in its task after those of earlier tasks."""
    per_task = parts.groupBy("conv", "task").agg(F.count(F.lit(1)).alias("n"), F.min("seg").alias("low"))
    before = F.sum("n").over(Window.partitionBy("conv").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    starts = per_task.select("conv", "task", "low", F.coalesce(before, F.lit(0)).alias("before"))
    return parts.join(starts, ["conv", "task"]).select(*parts.columns, (F.col("before") + F.col("seg") - F.col("low")).alias("nth"))


def query(conversations: DataFrame) -> DataFrame:
    return repair(conversations.select("conv_id", "turn", "role", "text"))

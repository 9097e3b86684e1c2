"""Token counts by a compiled finite-state tokenizer.

A byte-pair vocabulary (any two neighbours whose join is a piece may merge, best
score first, then leftmost) is compiled to a deterministic transducer over
characters whose transitions carry the number of tokens they emit.  It rests on
one property: a sequence of pieces is the tokenizer's result exactly if the
tokenizer splits the join of every two neighbours back into those two.  So each
prefix of a text has one last piece, found from the last pieces of the prefixes
where a piece could start.  A state holds those places only: for every
piece that is still open its characters so far, the piece before it, and the
tokens up to there, counted from the least of them.  A transition emits what that
least count grows by; the state holds the rest.  States and transitions are
compiled when first met and thrown away together beyond ``STATES``.

Where two characters are neighbours in no piece, no token spans them, and the state
after the second one depends on it alone (a reset).  Texts of more than ``CHUNK``
characters are cut into chunks that Spark deals out.  A chunk gives a state map: its
characters up to its first reset (the only part that depends on the state before
it), the tokens emitted after, and its last state.  A chunk without a reset
holds, beside its characters, a table of the states that its ``LEAD`` preceding
characters can lead to.  Maps compose associatively; ``FAN`` neighbours at a time are composed
in parallel until one map per text is left (a prefix scan of which only the last value is kept).

Supported are SentencePiece models with byte fallback, a dummy prefix and no
normalisation; others raise ``ValueError``.  Unknown characters cost one token a UTF-8 byte.

Defined cases: null or empty text has 0 bytes and 0 tokens; rows that repeat an id
are counted one by one; null ids are ordinary ids; other columns are ignored; an
empty table gives an empty result.
Skew: a very long text is many chunks; no step groups by a column of the table.
"""
from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import stored, text_or_empty

MODEL = "piece_bpe_32k.model"
#: Tokens beyond which the query marks a document.
LIMIT = 4096
#: Characters of a chunk, characters before it that are looked at, maps composed at a time.
CHUNK, LEAD, FAN = 1 << 16, 48, 64
#: Compiled states beyond which the transducer starts anew.
STATES = 300_000
SPACE = "▁"
_WORD = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


class State(dict):
    """Transitions character -> (state, emitted tokens); ``spots``: (open characters, piece before, tokens) a place."""
    __slots__ = ("spots", "owner")

    def __init__(self, spots: tuple, owner: "Transducer"):
        self.spots, self.owner = spots, owner

    def __missing__(self, c: str):
        step = self[c] = self.owner.compile(self.spots, c)
        return step

    @property
    def held(self) -> int:
        """Tokens not yet emitted."""
        return self.spots[-1][2]


class Transducer:
    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        self.begun = {p[:i] for p in scores for i in range(1, len(p))}
        self.neighbours = {p[i:i + 2] for p in scores for i in range(len(p) - 1)}
        self.states: dict[tuple, State] = {}
        self.splits: dict[str, tuple] = {}
        #: Whether every space after another character resets, so that words can be counted on their own.
        self.by_word = not any(n[1] == SPACE != n[0] for n in self.neighbours)
        self.words: dict[str, int] = {}

    def split(self, text: str) -> tuple:
        """The tokenizer's own merging, for the join of two pieces."""
        got = self.splits.get(text)
        if got is None:
            parts = list(text)
            while len(parts) > 1:
                joins = [self.scores.get(a + b) for a, b in zip(parts, parts[1:])]
                ranked = [(-s, i) for i, s in enumerate(joins) if s is not None]
                if not ranked:
                    break
                i = min(ranked)[1]
                parts[i:i + 2] = [parts[i] + parts[i + 1]]
            if len(self.splits) > 2 * STATES:
                self.splits.clear()
            got = self.splits[text] = tuple(parts)
        return got

    def follows(self, before: str, piece: str) -> bool:
        if not before or before[-1] + piece[0] not in self.neighbours:
            return self.split(piece) == (piece,)
        return self.split(before + piece) == (before, piece)

    def cost(self, c: str) -> int:
        return 1 if c in self.scores else len(c.encode("utf-8", "surrogatepass"))

    def state(self, spots: tuple) -> State:
        got = self.states.get(spots)
        if got is None:
            if len(self.states) >= STATES:
                for old in self.states.values():
                    old.clear()
                self.states.clear()
            got = self.states[spots] = State(spots, self)
        return got

    @property
    def start(self) -> State:
        return self.state((("", "", 0),))

    def resets(self, before: str, c: str) -> bool:
        return before + c not in self.neighbours

    def compile(self, spots: tuple, c: str) -> tuple[State, int]:
        for begun, before, tokens in spots:
            piece = begun + c
            if (not begun or piece in self.scores) and self.follows(before, piece):
                break
        now = tokens + (1 if begun else self.cost(c))
        last = spots[-1][1]
        if last and self.resets(last[-1], c):
            spots = (("", "", spots[-1][2]),)
        kept = [(b + c, p, t) for b, p, t in spots if b + c in self.begun] + [("", piece, now)]
        least = min(t for _, _, t in kept)
        return self.state(tuple((b, p, t - least) for b, p, t in kept)), least

    def run(self, state: State, text: str) -> tuple[State, int]:
        emitted = 0
        for c in text:
            state, n = state[c]
            emitted += n
        return state, emitted

    def count(self, text: str) -> int:
        if not text:
            return 0
        return self.settled(SPACE + text.replace(" ", SPACE))

    def settled(self, text: str) -> int:
        """Tokens of a text with marked spaces; the maps of whole words are transitions of their own, kept when met."""
        if not self.by_word:
            state, emitted = self.run(self.start, text)
            return emitted + state.held
        known, total = self.words, 0
        for word in _WORD.findall(text):
            n = known.get(word)
            if n is None:
                state, emitted = self.run(self.start, word)
                n = emitted + state.held
                if len(word) <= 24:
                    if len(known) >= STATES:
                        known.clear()
                    known[word] = n
            total += n
        return total


@lru_cache(maxsize=2)
def transducer(model: str = MODEL) -> Transducer:
    """The transducer of a vocabulary file (a name in the tokenizer folder, or a path), once per Python worker."""
    import os

    import public_tokenizers
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=model if os.path.isabs(model) else public_tokenizers.path(model))
    probe = "ﬁ  A\té\n 　x "
    if sp.normalize(probe) != SPACE + probe.replace(" ", SPACE) or not any(sp.is_byte(i) for i in range(sp.vocab_size())):
        raise ValueError("only models with byte fallback, a dummy prefix and no normalisation are supported")
    return Transducer({sp.id_to_piece(i): sp.get_score(i) for i in range(sp.vocab_size())
                       if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))})


# Chunk maps: (head, table, emitted, last); table null: what follows ``head`` emits ``emitted`` and ends in ``last``;
# else the whole chunk is ``head`` and ``table`` lists known (state before, state after, emitted).
def chunk_map(t: Transducer, lead: str, text: str) -> tuple[str, str | None, int, str]:
    known = (lead[-1:] + text) if lead else text
    first = next((i for i in range(1, len(known)) if t.resets(known[i - 1], known[i])), None)
    if first is not None:
        first -= bool(lead)
        state, emitted = t.run(t.state((("", "", 0),)), text[first:])
        return text[:first], None, emitted, json.dumps(state.spots)
    table = {}
    for i in range(max(1, len(lead))):
        state = t.run(t.start, lead[i:])[0]
        if state.spots not in table:
            end, emitted = t.run(state, text)
            table[state.spots] = (end.spots, emitted)
    return text, json.dumps([(a, b, n) for a, (b, n) in table.items()]), 0, ""


def _spots(raw) -> tuple:
    return tuple(tuple(s) for s in raw)


def apply_map(t: Transducer, spots: tuple, part: tuple) -> tuple[tuple, int]:
    """(state after, emitted) of one map from the state ``spots``."""
    head, table, emitted, last = part
    if table is not None:
        for a, b, n in json.loads(table):
            if _spots(a) == spots:
                return _spots(b), n
    state, n = t.run(t.state(spots), head)
    if table is not None:
        return state.spots, n
    # a reset: what the state still holds is settled, the rest starts afresh
    return _spots(json.loads(last)), n + state.held + emitted


def compose(t: Transducer, a: tuple, b: tuple) -> tuple[str, str | None, int, str]:
    """The map of ``a`` followed by ``b``."""
    if a[1] is None:
        last, n = apply_map(t, _spots(json.loads(a[3])), b)
        return a[0], None, a[2] + n, json.dumps(last)
    if b[1] is None:
        return a[0] + b[0], None, b[2], b[3]
    rows = []
    for before, mid, n in json.loads(a[1]):
        after, more = apply_map(t, _spots(mid), b)
        rows.append((before, after, n + more))
    return a[0] + b[0], json.dumps(rows), 0, ""


_MAP = "doc_id {id}, n_bytes long, row long, part long, head string, tab string, emitted long, last string"


def _counter(model: str, schema: pa.Schema):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = transducer(model)
        for batch in batches:
            tokens = [t.count(v.as_py()) for v in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"),
                                              pa.array(tokens, pa.int64())], schema=schema)
    return count


def _cutter(schema: pa.Schema, chunk: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                text = SPACE + one.column("text")[0].as_py().replace(" ", SPACE)
                for part, at in enumerate(range(0, len(text), chunk)):
                    values = [[one.column("doc_id")[0].as_py()], [one.column("n_bytes")[0].as_py()],
                              [one.column("row")[0].as_py()], [part], [text[max(0, at - LEAD):at]], [text[at:at + chunk]]]
                    yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, schema)], schema=schema)
    return cut


def _mapper(model: str, schema: pa.Schema):
    def to_maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = transducer(model)
        for batch in batches:
            maps = [chunk_map(t, a.as_py(), b.as_py()) for a, b in zip(batch.column("lead"), batch.column("piece"))]
            kept = [batch.column(c) for c in ("doc_id", "n_bytes", "row", "part")]
            yield pa.RecordBatch.from_arrays(kept + [pa.array(v, f.type) for v, f in zip(zip(*maps), list(schema)[4:])],
                                             schema=schema)
    return to_maps


def _composer(model: str):
    def fold(rows):
        t = transducer(model)
        rows = rows.sort_values("part")
        maps = [(h, x if isinstance(x, str) else None, int(n), s)
                for h, x, n, s in zip(rows["head"], rows["tab"], rows["emitted"], rows["last"])]
        out = maps[0]
        for nxt in maps[1:]:
            out = compose(t, out, nxt)
        got = rows.iloc[:1].copy()
        got["part"] //= FAN
        got["head"], got["tab"], got["emitted"], got["last"] = out
        return got
    return fold


def _finisher(model: str, schema: pa.Schema):
    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = transducer(model)
        for batch in batches:
            tokens = []
            for part in zip(*(batch.column(c).to_pylist() for c in ("head", "tab", "emitted", "last"))):
                spots, n = apply_map(t, t.start.spots, part)
                tokens.append(n + spots[-1][2])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"),
                                              pa.array(tokens, pa.int64())], schema=schema)
    return finish


def count_tokens(docs: DataFrame, model: str = MODEL, id_col: str = "doc_id", text_col: str = "text",
                 chunk: int = CHUNK) -> DataFrame:
    """doc_id, n_bytes, n_tokens: one row per row of ``docs``."""
    from pyspark.sql.pandas.types import to_arrow_schema
    texts = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text")).withColumn(
        "n_bytes", F.octet_length("text").cast("long"))
    id_type = texts.schema["doc_id"].dataType.simpleString()
    result = f"doc_id {id_type}, n_bytes long, n_tokens long"
    cut_schema = f"doc_id {id_type}, n_bytes long, row long, part long, lead string, piece string"
    map_schema = _MAP.format(id=id_type)
    empty = docs.sparkSession.createDataFrame
    arrow = {s: to_arrow_schema(empty([], s).schema) for s in (result, cut_schema, map_schema)}
    short = texts.where(F.length("text") < chunk).mapInArrow(_counter(model, arrow[result]), result)
    far = texts.where(F.length("text") >= chunk).withColumn("row", F.monotonically_increasing_id())
    pieces = stored(far.select("doc_id", "n_bytes", "row", "text").mapInArrow(_cutter(arrow[cut_schema], chunk), cut_schema),
                    "chunks")
    most, count = pieces.agg(F.max("part"), F.count(F.lit(1))).first()
    if most is None:
        return short
    # a fixed number: by bytes alone adaptive execution would put all of a small table's chunks into one task
    tasks = min(count, max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-count // 512)))
    maps = pieces.repartition(tasks, F.xxhash64("row", "part")).mapInArrow(_mapper(model, arrow[map_schema]), map_schema)
    while most:
        maps = (maps.withColumn("grp", F.floor(F.col("part") / FAN)).groupBy("row", "grp")
                .applyInPandas(_dropping_group(_composer(model)), map_schema))
        most //= FAN
    return short.unionByName(maps.mapInArrow(_finisher(model, arrow[result]), result))


def _dropping_group(fold):
    def run(rows):
        return fold(rows.drop(columns="grp"))
    return run


def query(docs: DataFrame) -> DataFrame:
    out = count_tokens(docs)
    return out.withColumn("over_limit", F.col("n_tokens") > LIMIT)

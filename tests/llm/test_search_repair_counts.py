"""Conversation repair, lexical search and token counts against brute force, DuckDB and the tokenizer's own library."""
from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from cellpulse.llm import catalog, conversation_repair as repair, lexical_search as search, token_counts as counts
from cellpulse.llm._common import ship, table

from .test_operators import EDGES, LONG, SF, make, same_as_sql


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


# 11 conversation repair --------------------------------------------------------------------------------------------
STRIP = " \t\n\x0b\x0c\r"
TURNS = "conv_id long, turn long, role string, text string, place long, h1 string, conv string, again int"


def brute_edits(symbols):
    """Cheapest (cost, audit) by trying every edit of every row, with up to two inserts anywhere."""
    best = {"": (0, "")}  # output initials so far, cut down to what the grammar needs

    def legal(out):
        return re.fullmatch(r"s?(ua)*u?", out) is not None

    for sym in [*symbols, None]:
        grown = {}
        for out, (cost, audit) in best.items():
            for n in range(3):
                for ins in itertools.product("ua", repeat=n):
                    base, c, a = out + "".join(ins), cost + 3 * n, audit + "I" * n
                    steps = [("", 0, "")] if sym is None else [("", 4, "D")]
                    if sym not in (None, "X"):
                        extra = 3 if sym.isupper() else 0
                        steps += [(r, 3 + extra, "R") for r in "ua"] + [(sym.lower(), extra, "K")]
                    for add, more, mark in steps:
                        if legal(base + add):
                            key = _short(base + add)
                            new = (c + more, a + mark)
                            if key not in grown or new < grown[key]:
                                grown[key] = new
        best = grown
    return min(v for k, v in best.items() if k == "" or k.endswith("a"))


def _short(out):
    return out if len(out) < 2 else "u" if out.endswith("u") else "ua"


def brute_repair(rows):
    """{conv_id: figures} of (conv_id, turn, role, text) rows."""
    kept = {r[0]: [] for r in rows}
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        code = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if code == 0:
            continue
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        kept[conv] += [(turn, "user" if code == 4 else role, text)] * (2 if code == 3 else 1)
    out = {}
    for conv, mine in kept.items():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, symbols, faults = set(), [], []
        for _, role, text in mine:
            bare = text.strip(STRIP)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated"
            seen.add((role, text))
            faults.append(fault)
            initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
            symbols.append("X" if fault in ("blank", "duplicate") else initial.upper() if fault else initial)
        cost, audit = brute_edits(symbols)
        state, lines, k = "", [], 0
        for edit in audit:
            due = "assistant" if state == "u" else "user"
            if edit == "I":
                lines.append(due + ":")
                state = due[0]
            else:
                role, text = mine[k][1:]
                k += 1
                if edit != "D":
                    role = role if edit == "K" else due
                    lines.append(role + ":" + text)
                    state = role[0]
        turns = [t for t, _, _ in mine if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        out[conv] = (gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def check_repair(spark, rows, **limits):
    df = spark.createDataFrame([(*r, 1, "h", "c", 2) for r in rows], TURNS)
    got = repair.repair(df, **limits).collect()
    assert {r["conv_id"]: tuple(r)[1:] for r in got} == brute_repair(rows)
    assert len(got) == len({r[0] for r in rows})


def some_rows(seed, convs, most):
    r = random.Random(seed)
    texts = ["Yes.", "no", "Well?", "", " \n", "same text.", "more of it", "end!  "]
    return [(c, r.choice([t, t, t, t + 1, None]) if r.random() < 0.2 else t,
             r.choice(["user", "assistant", "system", "tool", "user", "assistant", None]),
             r.choice([None, *texts]) if r.random() < 0.4 else f"text {c} {t}" + r.choice([".", ""]))
            for c in range(convs) for t in range(r.randrange(most))]


def test_repair_whole_table(spark):
    rows = [tuple(r) for r in table(spark, SF, "conversations").select("conv_id", "turn", "role", "text").collect()]
    check_repair(spark, rows)
    got = catalog.QUERIES["op11_conversation_repair"](spark, SF)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def test_repair_edges_and_segments(spark):
    rows = some_rows(5, 120, 12)
    rows += [(None, t, "user", "null id.") for t in range(9)] + [(-7, t, None, None) for t in range(6)]
    rows += [(500, None, "user", f"{i} no turn") for i in range(7)] + [(501, 3, "user", "same.")] * 30
    rows += [(502, 2**40 + t, "assistant" if t % 2 else "user", LONG[:2000 + t] + ".") for t in range(0, 40, 2)]
    check_repair(spark, rows)
    check_repair(spark, rows, rows_limit=3)
    check_repair(spark, rows, bytes_limit=20)


def test_repair_hot_conversation_and_empty(spark):
    r = random.Random(2)
    hot = [(1, t, r.choice(["user", "assistant", "system"]), r.choice(["a.", "b", f"x{t}."])) for t in range(1500)]
    check_repair(spark, hot + some_rows(3, 20, 6), rows_limit=16)
    dropped = next(t for t in range(1000) if zlib.crc32(f"9:{t}".encode()) % 20 == 0)
    check_repair(spark, [(9, dropped, "user", "gone")])
    assert repair.repair(spark.createDataFrame([], TURNS)).count() == 0


def test_repair_matrices_against_all_edits():
    r = random.Random(1)
    grammar = repair.Grammar([("u", "a"), ("<0>", "<0>"), ("X", "u"), ("U", "a")])
    for _ in range(400):
        symbols = "".join(r.choice("suaoSUAOX") for _ in range(r.randrange(9)))
        assert repair.finish(grammar.product(symbols)) == brute_edits(symbols), symbols


# 12 lexical search -------------------------------------------------------------------------------------------------
def test_search_equals_sql(spark):
    docs, items = (table(spark, SF, n) for n in ("documents", "benchmark"))
    got = catalog.QUERIES["op12_lexical_search"](spark, SF)
    assert same_as_sql(got, search.ORACLE_SQL, documents=docs, benchmark=items) > 100


def test_search_edges_ties_and_blocks(spark):
    docs = make(spark, EDGES + [(20, "One, two. THREE É", "a"), (21, "é É\x00two", None), (30, None, None)]
                + [(40 + i, "one two", "t") for i in range(14)])
    items = spark.createDataFrame([(1, "ONE two!", 5), (2, "", 5), (None, "É é three", 5), (3, None, 5), (4, "one,two", 5),
                                   (4, "three", 5), (5, "nowhere", 5), (6, "w3x0 tail w4x0", 5)], "item_id long, text string, rank int")
    sql = search.ORACLE_SQL
    for size in (search.BLOCK_TERMS, 2):
        assert same_as_sql(search.search(docs, items, block_terms=size), sql, documents=docs, benchmark=items) > 20
    assert search.search(docs.limit(0), items).count() == 0
    assert search.search(docs, items.limit(0)).count() == 0
    assert search.search(make(spark, [(1, None, "a"), (2, " .", "a")]), items).count() == 0


def test_shared_nodes_cover_every_item_once():
    r = random.Random(4)
    for n in (1, 5, 40):
        items = [frozenset(r.sample(range(60), r.randrange(1, 30))) for _ in range(n)] + [frozenset(range(10))] * 2
        leaves, pairs, paths = search.share(items)
        held = [list(x) for x in leaves]
        for a, b in pairs:
            held.append(held[a] + held[b])
        assert [sorted(t for node in p for t in held[node]) for p in paths] == [sorted(i) for i in items]
        assert not pairs or sum(map(len, paths)) < sum(map(len, items))


# 13 token counts ---------------------------------------------------------------------------------------------------
@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(counts.MODEL))


def check_counts(spark, docs, library, **kw):
    want = sorted((-1 if r[0] is None else r[0], len((r[1] or "").encode()), len(library.encode(r[1] or "")))
                  for r in docs.select("doc_id", "text").collect())
    got = counts.count_tokens(docs, **kw).collect()
    assert sorted((-1 if r[0] is None else r[0], r[1], r[2]) for r in got) == want


ODD = [(50, "<s> </s> <0x0A> <unk> ▁▁ ", "a"), (51, "aaaa" * 300, "a"), (52, "  " * 200 + "x", "a"), (53, "漢字🎉\x01é" * 40, "a"),
       (54, "=" * 999, "a"), (55, "\n\t\r", "a"), (56, "ab" * 700 + " " + "-" * 300, "b"), (None, "ththe" * 400, "b")]


def test_counts_equal_the_library(spark, library):
    check_counts(spark, table(spark, SF, "documents"), library)
    got = catalog.QUERIES["op13_token_counts"](spark, SF)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert all(r["over_limit"] == (r["n_tokens"] > 4096) for r in got.collect())


def test_counts_edges_and_chunks(spark, library):
    docs = make(spark, EDGES + ODD)
    check_counts(spark, docs, library)
    short = make(spark, [(i, t and t[:3000], s) for i, t, s in EDGES] + ODD)
    check_counts(spark, short, library, chunk=7)
    check_counts(spark, short, library, chunk=100)
    assert counts.count_tokens(docs.limit(0)).count() == 0


def test_transducer_random_texts(library):
    t, r = counts.transducer(), random.Random(3)
    pieces = list(t.scores)
    for _ in range(3000):
        text = "".join(r.choice([r.choice(pieces).replace("▁", " "), r.choice("ab \n1é漢=."), r.choice(["the", "ing", " a"])])
                       for _ in range(r.randrange(12)))
        assert t.count(text) == len(library.encode(text)), repr(text)


def test_transducer_starts_anew_when_full(monkeypatch, library):
    monkeypatch.setattr(counts, "STATES", 50)
    t = counts.Transducer(counts.transducer().scores)
    text = LONG[:6000]
    assert t.count(text) == len(library.encode(text)) and len(t.states) <= 50


# 3 rows without an id are candidates -------------------------------------------------------------------------------
def test_index_keeps_rows_without_an_id(spark):
    from cellpulse.llm import permutation_index
    r = random.Random(9)
    rows = [(i if i % 3 else None, [r.gauss(0, 1) for _ in range(8)]) for i in range(1, 90)] + [(20, [1.0] * 8), (None, [1.0] * 8), (7, [2.0] + [1.0] * 7)]
    got = permutation_index.query(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    for q in {x["query_id"] for x in got} - {20}:
        own = next(v for i, v in rows if i == q)
        want = sorted((-sum(a * b for a, b in zip(own, v)), i is None, i or 0) for i, v in rows if i != q)[:20]
        assert [(x["vec_id"] is None, x["vec_id"] or 0) for x in sorted((x for x in got if x["query_id"] == q), key=lambda x: x["rank"])] == [
            (n, i) for _, n, i in want]


# 10 rows without an id reach the targets ---------------------------------------------------------------------------
def test_mix_targets_are_met_with_rows_without_an_id(spark):
    from cellpulse.llm import mixing
    rows = [(None if i % 2 else i, " ".join(f"w{i}x{k}" for k in range(5 + i % 40)), "abc"[i % 3]) for i in range(4500)]
    docs = make(spark, rows)
    got = mixing.query(docs).groupBy("target").sum("taken").collect()
    assert len(got) >= 2 and all(abs(r[1] - r[0]) <= 0.02 * r[0] for r in got), got
    assert mixing.mixed(docs).count() == sum(r["copies"] for r in mixing.Mix(docs).per_document().collect())


# 2 rows without an id spread over the blocks -----------------------------------------------------------------------
def test_rows_without_an_id_fill_no_single_block(spark):
    from cellpulse.llm import sharding
    docs = make(spark, [(None, f"text {i}", "a") for i in range(2000)] + [(i, "same", "b") for i in range(100)])
    got = sharding.query(docs).collect()
    sizes = [sum(r["shard"] == s for r in got) for s in range(8)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sizes[s])) for s in range(8))
    blocks = docs.selectExpr("doc_id", "crc32(cast(text as binary)) as c").selectExpr("pmod(xxhash64(doc_id, c, 17), 4096) as b")
    assert blocks.groupBy("b").count().agg(F.max("count")).first()[0] < 20


def test_chat_rotation_starts_over_many_runs_of_chunks(spark, monkeypatch):
    from cellpulse.llm import chat_rotation as rotation
    monkeypatch.setattr(rotation, "RUN", 2)
    rows = [(c, t, ["a", "b", "system", None][(t * 7) % 4], "x" * (t % 11)) for c in ("hot", None) for t in range(-40, 600)]
    got = rotation.rotate(spark.createDataFrame(rows, "conv_id string, turn long, role string, text string"), turns=16)
    whole = {}
    for r in got.orderBy("conv_id", "perspective", "chunk").collect():
        key = (r["conv_id"], r["perspective"])
        assert r["chunk_start"] == whole.get(key, 0)
        whole[key] = r["chunk_start"] + len(r["rendered"])
    assert len(whole) == 6 and got.count() == 6 * 41  # chunks -3 to 37

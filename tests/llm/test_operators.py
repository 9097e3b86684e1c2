"""The ten operators against brute force, DuckDB or exact round trips, on small tables and defined edge cases."""
from __future__ import annotations

import itertools
import re
import zlib

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cellpulse.llm import (chat_rotation, exact_dedup, golomb, line_dedup, mixing, near_dedup, packing,
                           permutation_index, sharding, toxicity, warc_fixity)
from cellpulse.llm._common import ship, table

SF = "/root/testdata/sf0.001"
#: Extra columns whose names clash with the operators' own.
DOCS = ("doc_id long, text string, lang string, source string, n_chars long, h long, node long, size long, rank int, "
        "block int, key string, sha string, K_ID long, shards int, drop_id long")
EXTRA = (1, 2, 3, 4, 5, "k", "s", 6, 7, 8)
WORDS = "one two three four five six seven eight nine ten eleven twelve".split()


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


def make(spark, rows):
    """Documents from (doc_id, text, source)."""
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), *EXTRA) for i, t, s in rows], DOCS)


LONG = " ".join(f"w{i % 977}x{i // 7}" for i in range(60_000))
EDGES = [(1, None, "a"), (2, "", None), (3, " \t\n", "a"), (4, "one two three", "b"), (5, "One  TWO three", "b"),
         (6, LONG, "b"), (7, LONG + " tail", "c"), (8, " ".join(WORDS), "c"), (8, " ".join(WORDS), "c"),
         (9, "same line\n" * 3 + "own é line", None), (None, "no id at all here", None), (10, "ONE two three", "b"),
         (11, "x" * 50_000, "a"), (None, None, None)]


def plain(rows) -> list[tuple]:
    out = [tuple(None if isinstance(v, float) and np.isnan(v) else v for v in r) for r in rows]
    return sorted(out, key=lambda r: tuple((v is not None, str(v)) for v in r))


def same_as_sql(got, sql: str, **tables) -> int:
    con = duckdb.connect()
    for name, df in tables.items():
        con.register(name, df.toArrow())
    cur = con.execute(sql)
    cols = [c[0] for c in cur.description]
    rows = [tuple(r) for r in got.select(*cols).collect()]
    assert sorted(cols) == sorted(got.columns)
    assert plain(rows) == plain(cur.fetchall())
    return len(rows)


# 1 packing ---------------------------------------------------------------------------------------------------------
def check_packed(docs, packed):
    encoder, want = packing.Encoder(), []
    for r in docs.select("doc_id", "text").collect():
        ids = encoder.slow.encode(r["text"] or "", add_special_tokens=False).ids + [packing.END_ID]
        want.append((r["doc_id"], len(ids), np.array(ids, dtype="<u4")))
    got = packed.toPandas()
    assert got.groupby("sequence_id")["length"].sum().max() <= packing.SEQUENCE
    for _, g in got.sort_values("offset").groupby("sequence_id"):
        assert list(g["offset"]) == [0, *g["length"].cumsum()[:-1]]
    crcs = sorted(zip(got["doc_id"].fillna(-1), got["start"], got["length"], got["ids_crc32"], got["doc_tokens"]))
    pieces = []
    for doc_id, n, ids in want:
        mine = {s: length for d, s, length, _, t in crcs if d == (-1 if doc_id is None else doc_id) and t == n}
        assert sum(mine.values()) == n or len(mine) > 0
        pieces += [(-1 if doc_id is None else doc_id, s, length, zlib.crc32(ids[s:s + length].tobytes()), n)
                   for s, length in mine.items()]
    assert sorted(pieces) == crcs
    return got


def test_packing_round_trip_and_padding(spark):
    docs = table(spark, SF, "documents")
    got = check_packed(docs, packing.query(docs))
    used, sequences = got["length"].sum(), got["sequence_id"].nunique()
    assert sequences <= -(-used // packing.SEQUENCE) * 1.05 + 2


def test_packing_edges(spark):
    docs = make(spark, EDGES).where("doc_id is not null")
    check_packed(docs.union(docs.where("doc_id < 0")), packing.query(docs))
    assert packing.query(docs.limit(0)).count() == 0
    assert packing.query(make(spark, [(None, None, None)])).collect()[0]["length"] == 1


def test_sequences_hold_the_ids(spark):
    docs = table(spark, SF, "documents").limit(40)
    from cellpulse.llm._common import stored
    packed = stored(packing.pack(stored(packing.pieces(docs, keep_ids=True), "p")), "k")
    laid = {r["sequence_id"]: r for r in packing.sequences(packed).collect()}
    for r in packed.collect():
        ids = np.array(laid[r["sequence_id"]]["ids"][r["offset"]:r["offset"] + r["length"]], dtype="<u4")
        assert zlib.crc32(ids.tobytes()) == r["ids_crc32"]


def test_knapsack_prices_the_best_pattern():
    sizes, values = np.array([3, 5, 7]), np.array([0.3, 0.55, 0.8])
    best = max(a * .3 + b * .55 + c * .8 for a, b, c in itertools.product(range(6), repeat=3) if 3 * a + 5 * b + 7 * c <= 17)
    worth, counts = packing.best_pattern(sizes, values, 17)
    assert worth == pytest.approx(best) and counts @ sizes <= 17


# 2 sharding --------------------------------------------------------------------------------------------------------
@pytest.mark.parametrize("n", [1, 2, 3, 5, 100, 1025])
def test_feistel_is_a_bijection_with_an_inverse(n):
    f = sharding.Feistel(n, 42)
    y = f.forward(np.arange(n))
    assert sorted(y) == list(range(n)) and list(f.backward(y)) == list(range(n))


@pytest.mark.parametrize("edges", [False, True])
def test_sharding(spark, edges):
    docs = make(spark, EDGES) if edges else table(spark, SF, "documents")
    got = sharding.query(docs).toPandas()
    counts = got.groupby("shard")["slot"].agg(["count", "max", "nunique"])
    assert counts["count"].max() - counts["count"].min() <= 1
    assert (counts["count"] == counts["max"] + 1).all() and (counts["count"] == counts["nunique"]).all()
    want = [(r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in docs.select("doc_id", "text").collect()]
    assert plain(got[["doc_id", "size", "text_crc32"]].itertuples(index=False)) == plain(want)
    again = sharding.query(docs.repartition(5)).toPandas()
    cols = ["size", "text_crc32", "shard", "slot"]
    assert plain(got[cols].itertuples(index=False)) == plain(again[cols].itertuples(index=False))
    rows = sharding.row_at(got["shard"], got["slot"], len(got), 8, 42)
    assert (rows == got["row_number"].to_numpy()).all()
    assert sharding.query(docs.limit(0)).count() == 0


# 3 permutation index -----------------------------------------------------------------------------------------------
def brute_nearest(rows, top=20, every=20):
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], dtype=np.float64)
    out = {}
    for i, v in zip(ids, x):
        if i % every == 0:
            score = (x * v).sum(axis=1)
            order = [j for j in np.lexsort((ids, -score)) if ids[j] != i][:top]
            out[int(i)] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def test_permutation_index_recall(spark):
    emb = table(spark, "/root/testdata/sf0.01", "embeddings")
    vector = next(f.name for f in emb.schema.fields if f.dataType.typeName() == "array")
    want = brute_nearest(emb.select("vec_id", vector).collect())
    got = permutation_index.query(emb).toPandas().sort_values(["query_id", "rank"])
    hits = sum(len({v for v, _ in want[q]} & set(g["vec_id"])) for q, g in got.groupby("query_id"))
    assert hits >= 0.9 * sum(map(len, want.values()))
    assert set(got["query_id"]) == set(want)
    best = {(q, v): s for q, w in want.items() for v, s in w}
    assert all(best.get((r.query_id, r.vec_id), r.score) == pytest.approx(r.score, rel=1e-12) for r in got.itertuples())


def test_permutation_index_edges(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [float("nan"), 1.0]), (5, [None, 1.0]),
            (6, [2.0, 0.0]), (20, [0.0, 1.0]), (21, [1.0, 0.0]), (22, [1.0])]
    emb = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rep", F.lit(1))
    got = [tuple(r) for r in permutation_index.query(emb).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 6, 2.0), (0, 2, 1, 1.0), (0, 3, 21, 1.0), (0, 4, 20, 0.0),
                   (20, 1, 0, 0.0), (20, 2, 1, 0.0), (20, 3, 6, 0.0), (20, 4, 21, 0.0)]
    assert permutation_index.query(emb.limit(0)).count() == 0


def block_recall(spark, x, asked):
    emb = spark.createDataFrame(pd.DataFrame({"vec_id": range(len(x)), "embedding": list(x)}))
    got = permutation_index.search(emb, emb.where(F.col("vec_id").isin(asked))).toPandas()
    found = got.groupby("query_id")["vec_id"].agg(set)
    hits = 0
    for i in asked:
        score = (x * x[i]).sum(axis=1)
        order = [int(j) for j in np.lexsort((np.arange(len(x)), -score)) if j != i][:20]
        hits += len(found[i] & set(order))
    return hits / (20 * len(asked))


def unit_vectors(n, hot=0, noise=0.02, seed=1):
    """``n`` vectors of length one, the first ``hot`` close to one point."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 64))
    x[:hot] = x[n - 1] / np.linalg.norm(x[n - 1]) + noise * x[:hot] / 8
    return x / np.linalg.norm(x, axis=1, keepdims=True)


@pytest.mark.parametrize("noise", [0.02, 0.2])
def test_permutation_index_recall_beside_and_in_a_hot_cluster(spark, noise):
    n = 2 * permutation_index.BLOCK
    x = unit_vectors(n, n // 3, noise)
    outside, inside = (block_recall(spark, x, list(range(a, a + 40))) for a in (n // 2, 0))
    print("recall", noise, outside, inside)
    assert outside >= 0.95 and inside >= 0.95


@pytest.mark.parametrize("outliers", [1, 40])
def test_permutation_index_recall_beside_very_large_norms(spark, outliers):
    x = unit_vectors(permutation_index.BLOCK)
    x[-outliers:] *= 1e10
    recall = block_recall(spark, x, list(range(40)))
    print("recall of", outliers, recall)
    assert recall >= 0.95


# 4 exact dedup -----------------------------------------------------------------------------------------------------
@pytest.mark.parametrize("edges", [False, True])
def test_exact_dedup(spark, edges):
    docs = make(spark, EDGES) if edges else table(spark, SF, "documents")
    assert same_as_sql(exact_dedup.query(docs), exact_dedup.ORACLE_SQL, documents=docs) == docs.count()
    left = exact_dedup.deduplicate(docs)
    assert left.columns == docs.columns
    texts = [re.sub(r"[\x20\x09-\x0D]", "", r["text"] or "") for r in left.collect()]
    every = {re.sub(r"[\x20\x09-\x0D]", "", r["text"] or "") for r in docs.collect()}
    assert len(texts) == len(every) and set(texts) == every
    assert exact_dedup.query(docs.limit(0)).count() == exact_dedup.deduplicate(docs.limit(0)).count() == 0


def test_golomb_round_trip():
    values = np.unique(np.random.default_rng(1).integers(0, 1 << 20, 5000)).astype(np.uint64)
    k, payload = golomb.encode(values, 1 << 20)
    assert (golomb.decode(payload, len(values), k) == values).all()


# 5 toxicity --------------------------------------------------------------------------------------------------------
def test_toxicity_held_out(spark):
    docs, labels = (table(spark, "/root/testdata/sf0.1", t) for t in ("documents", "labels"))
    got = toxicity.classify(docs, labels).toPandas().merge(labels.select("doc_id", "toxic").toPandas(), on="doc_id")
    out = got[got["held_out"] & got["toxic"].notna()]
    assert all(zlib.crc32(str(i).encode()) % 4 == 2 for i in out["doc_id"])
    pos, neg = out[out["toxic"] == 1]["score"], out[out["toxic"] == 0]["score"]
    assert (pos.to_numpy()[:, None] > neg.to_numpy()[None, :]).mean() > 0.9


def test_toxicity_shares_subwords_with_misspellings():
    bad, good = ["you are a horrid idiot"] * 8, ["a calm walk in the park"] * 8
    logit = toxicity.train(bad + good, [1] * 8 + [0] * 8).scorer()
    assert logit("horrrid idiott") > logit("calmm parkk")


def test_toxicity_hashes_words_together():
    words = ["", "a", "ab", "--x--", "misspeling", "été", "日本語テキスト", "a😀b", "x" * 40] + [f"w{i}é" for i in range(50)]
    ids, sizes = toxicity.all_buckets(words)
    assert [i for w in words for i in toxicity.buckets(w)] == ids.tolist()
    assert [len(toxicity.buckets(w)) for w in words] == sizes.tolist()
    rng = np.random.default_rng(1)
    model = toxicity.Model(rng.normal(size=toxicity.BUCKETS).astype(np.float32), -0.5)
    texts = ["", " ".join(words), "one two " * 40, LONG[:20_000]]
    values = [[model.table[toxicity.buckets(w)].astype(float).mean() for w in toxicity.tokens(t)] for t in texts]
    want = [-0.5 + max((np.mean(v[a:b]) for a, b in zip(*toxicity.windows(len(v)))), default=0) if v else -0.5 for v in values]
    logits = model.scorer()
    assert np.allclose([x for part in toxicity.parts(texts) for x in logits(part)], want, atol=1e-9)
    assert [t for part in toxicity.parts(texts * 30) for t in part] == texts * 30


def test_toxicity_edges(spark):
    docs = make(spark, EDGES)
    labels = spark.createDataFrame([(i, i % 2) for i in range(12)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    got = toxicity.classify(docs, labels).collect()
    assert len(got) == len(EDGES) and all(0 <= r["score"] <= 1 and r["held_out"] is not None for r in got)
    assert all(r["score"] == 0 or r["predicted"] in (0, 1) for r in toxicity.classify(docs, labels.limit(0)).collect())
    assert toxicity.classify(docs.limit(0), labels).count() == 0
    assert toxicity.clean(docs, labels.limit(0)).columns == docs.columns


# 6 WARC fixity, 7 chat rotation, 9 line dedup ----------------------------------------------------------------------
def test_warc_fixity(spark):
    pages = table(spark, "/root/testdata/sf0.01", "pages")
    assert same_as_sql(warc_fixity.query(pages), warc_fixity.ORACLE_SQL, pages=pages)


def test_warc_fixity_negative_and_missing_ids(spark, monkeypatch):
    ddl = "page_id long, url string, html string"
    rows = [(i, f"u{i}", "h" * 500 + str(i)) for i in (-5000, -5, -4, -1, 0, 7)] + [(None, f"n{i}", f"x{i}") for i in range(40)]
    for room in (4096, 16):
        monkeypatch.setattr(warc_fixity, "SEGMENT_ROOM", room)
        recs = warc_fixity.records(spark.createDataFrame(rows, ddl))
        assert sorted(r["position"] for r in recs.collect())[0] >= 0
        a = stored_leaves = warc_fixity.leaves(recs)
        b = warc_fixity.leaves(recs, F.when(F.col("page_id") == -4, F.lit("?")).otherwise(F.col("record")))
        n = warc_fixity.depth(a, b)
        report = warc_fixity.audit(warc_fixity.tree(stored_leaves, n, "a"), warc_fixity.tree(b, n, "b"), n)
        assert [r["page_id"] for r in report.where("level = 0 and not equal").collect()] == [-4]


def test_warc_fixity_finds_the_damaged_record(spark):
    rows = [(i, f"u{i}", f"<p>{i}</p>" if i % 7 else None, 1) for i in range(300)] + [(None, None, None, 1)] + [(5, "u5", "<p>5</p>", 1)]
    recs = warc_fixity.records(spark.createDataFrame(rows, "page_id long, url string, html string, node int"))
    from cellpulse.llm._common import stored
    a = stored(warc_fixity.leaves(recs), "a")
    b = stored(warc_fixity.leaves(recs, F.when(F.col("page_id") == 123, F.lit("?")).otherwise(F.col("record"))), "b")
    n = warc_fixity.depth(a, b)
    report = warc_fixity.audit(warc_fixity.tree(a, n, "a"), warc_fixity.tree(b, n, "b"), n)
    assert [r["page_id"] for r in report.where("level = 0 and not equal").collect()] == [123]
    assert report.count() <= (n + 1) * warc_fixity.FANOUT
    assert warc_fixity.query(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


@pytest.mark.parametrize("edges", [False, True])
def test_chat_rotation(spark, edges):
    if edges:
        rows = ([(1, t, f"r{t % 3}", f"t<|{t}", "x") for t in range(200)] + [(1, 3, "r0", "t<|3", "x")]
                + [(2, None, None, None, "x"), (3, 0, "system", "s", "x"), (None, 1, "user", "", "x"), (None, 1, "user", None, "x")])
        talk = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, perspective string")
    else:
        talk = table(spark, SF, "conversations")
    assert same_as_sql(chat_rotation.query(talk), chat_rotation.ORACLE_SQL, conversations=talk)
    assert chat_rotation.query(talk.limit(0)).count() == 0


def test_chat_rotation_masks_the_assistant(spark):
    talk = spark.createDataFrame([(1, 0, "ann", "hi"), (1, 1, "bob", "yo")], "conv_id long, turn int, role string, text string")
    got = {r["perspective"]: r for r in chat_rotation.query(talk).collect()}
    for who, said in (("ann", "hi"), ("bob", "yo")):
        a, b = map(int, got[who]["loss_spans"].split(":"))
        assert got[who]["rendered"][a:b] == said + chat_rotation.CLOSE


@pytest.mark.parametrize("edges", [False, True])
def test_line_dedup(spark, edges):
    rows = EDGES + [(100 + i, f"  Shared LINE\t\nown {i}\n\nshared line", "a") for i in range(12)]
    docs = make(spark, rows) if edges else table(spark, SF, "documents")
    assert same_as_sql(line_dedup.query(docs), line_dedup.ORACLE_SQL, documents=docs) == docs.count()
    assert line_dedup.query(docs.limit(0)).count() == 0


def test_fixity_segments_with_repeated_ids_do_not_overlap(spark, monkeypatch):
    monkeypatch.setattr(warc_fixity, "SEGMENT_ROOM", 4)
    rows = [(k % 2 * 1000, f"u{k}", "h") for k in range(80)]
    recs = warc_fixity.records(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len({r["position"] for r in recs}) == 80
    assert {r["segment"]: r["position"] // 64 for r in recs} == {0: 0, 1: 1}


# 8 near dedup ------------------------------------------------------------------------------------------------------
def brute_components(rows, width=4, similar=80):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        sets[i] = {tuple(w[k:k + width]) for k in range(max(1, len(w) - width + 1))} if w else set()
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holders: dict = {}
    for i, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(i)
    linked = {p for own in holders.values() for p in itertools.combinations(sorted(own), 2)}
    for a, b in linked:
        if 100 * len(sets[a] & sets[b]) >= similar * len(sets[a] | sets[b]):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return sorted((i, len(s), root(i), root(i) == i) for i, s in sets.items())


@pytest.mark.parametrize("edges", [False, True])
def test_near_dedup_against_brute_force(spark, edges):
    if edges:
        base = [f"v{i}" for i in range(120)]
        near = [(50 + k, " ".join(base[:119 - k] + [f"z{k}"] + base[120 - k:]), "a") for k in range(20)]
        docs = make(spark, [r for r in EDGES if r[0] is not None] + near)
        rows = list({r[0]: (r[0], r[1]) for r in docs.select("doc_id", "text").collect()}.values())
    else:
        docs = table(spark, SF, "documents")
        rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = sorted({tuple(r) for r in near_dedup.query(docs).collect()})
    assert got == brute_components(rows)


@pytest.mark.parametrize("short", [0, near_dedup.SHORT])
def test_near_dedup_of_a_group_with_stragglers(spark, short, monkeypatch):
    """Many copies around the threshold, in several blocks a bucket; an id with two texts among them."""
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    monkeypatch.setattr(near_dedup, "SHORT", short)
    rng, base = np.random.default_rng(8), [f"v{i}" for i in range(150)]
    rows = []
    for k in range(120):
        words = list(base)
        for at in rng.choice(150, size=int(rng.integers(0, 12)), replace=False):
            words[at] = f"z{k}x{at}"
        rows.append((k, " ".join(words), "a"))
    got = sorted(plain_row[:4] for plain_row in map(tuple, near_dedup.query(make(spark, rows)).collect()))
    assert got == brute_components([r[:2] for r in rows])
    twice = make(spark, rows + [(119, "another text of the same id", "a")])
    kept = {r["doc_id"]: r["component_id"] for r in near_dedup.query(twice).collect()}
    assert kept == {r[0]: r[2] for r in got}


def test_near_dedup_defined_cases(spark):
    docs = make(spark, [(1, "a b c d e f", "x"), (2, "A B  c d e f", "x"), (None, "a b c d e f", "x"), (3, None, "x"), (4, "", "x")])
    got = {r["doc_id"]: r for r in near_dedup.query(docs).collect()}
    assert got[2]["component_id"] == 1 and not got[2]["kept"] and got[3]["kept"] and got[4]["n_shingles"] == 0
    assert got[None]["component_id"] == 1 and not got[None]["kept"]
    left = near_dedup.deduplicate(docs)
    assert left.columns == docs.columns and {r["doc_id"] for r in left.collect()} == {1, 3, 4}
    assert near_dedup.query(docs.limit(0)).count() == 0


def test_near_dedup_links_rows_without_an_id(spark):
    """A link that runs only through a row without an id, groups of such rows alone, repeated ones, ids too large for numbers above."""
    base, other = [f"v{i}" for i in range(100)], [f"o{i}" for i in range(60)]
    def text(words, changed):
        return " ".join(f"z{i}" if i in changed else w for i, w in enumerate(words))
    rows = [(70, text(base, {20})), (None, text(base, {20, 50})), (40, text(base, {50, 80})), (None, text(base, {20, 50})),
            (None, text(other, {5})), (None, text(other, {})), (None, text(other, {})), (None, text(other, {})),
            (3, "alone in its group"), (None, "alone without id"), (None, "alone without id"), (None, ""), (None, None), (None, " ")]
    docs = make(spark, [(i, t, "a") for i, t in rows])
    named = [(1000 + k if i is None else i, t) for k, (i, t) in enumerate(rows)]
    want = [(None if i >= 1000 else i, n, None if c >= 1000 else c, k) for i, n, c, k in brute_components(named)]
    assert plain(near_dedup.query(docs).collect()) == plain(want)
    assert {c[2] for c in want if c[0] == 70} == {40}
    kept = near_dedup.deduplicate(docs)
    texts = sorted((r["doc_id"] or 0, r["text"] or "") for r in kept.collect())
    assert kept.columns == docs.columns
    assert [t for t in texts if t[1].strip() and t[1][0] != "o"] == [(0, "alone without id"), (3, "alone in its group"), (40, rows[2][1])]
    assert len([t for t in texts if not t[1].strip()]) == 3 and len([t for t in texts if t[1][:1] == "o"]) == 1
    large = make(spark, [(2**62 + 1, rows[0][1], "a"), (None, rows[0][1], "a")])
    assert plain(near_dedup.query(large).collect()) == plain([(2**62 + 1, 97, 2**62 + 1, True), (None, 97, None, True)])


# 10 mixing ---------------------------------------------------------------------------------------------------------
def brute_targets(sizes: dict) -> dict:
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode("utf-32-be")) + [None] * (None in sizes)
    w = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    left, out, free = 1.5 * sum(sizes.values()), {}, set(names)
    while free:
        total = sum(w[s] for s in free)
        full = {s for s in free if left * w[s] / total >= 2 * sizes[s]}
        if not full:
            return out | {s: left * w[s] / total for s in free}
        out |= {s: 2.0 * sizes[s] for s in full}
        left -= sum(2.0 * sizes[s] for s in full)
        free -= full
    return out


@pytest.mark.parametrize("edges", [False, True])
def test_mixing(spark, edges):
    docs = make(spark, [r for r in EDGES if r[0] not in (6, 7, None)]) if edges else table(spark, "/root/testdata/sf0.01", "documents")
    source = docs.select("doc_id", "source").toPandas().drop_duplicates("doc_id")
    got = mixing.query(docs).toPandas()
    assert len(got) == docs.count()
    assert (got["taken"] <= 2 * got["size"]).all() and (got["taken"] == got["size"] * got["copies"]).all()
    assert (got["shards"].map(len) == got["copies"]).all()
    m = got.merge(source, on="doc_id")
    m["source"] = m["source"].map(lambda s: s if isinstance(s, str) else None)
    sizes = {k if isinstance(k, str) else None: int(g["size"].sum()) for k, g in m.groupby("source", dropna=False)}
    for key, g in m.groupby("source", dropna=False):
        target = brute_targets(sizes)[key if isinstance(key, str) else None]
        assert g["target"].iloc[0] == pytest.approx(target)
        assert abs(g["taken"].sum() - target) <= max(0.02 * target, g["size"].max())
    cols = ["doc_id", "size", "taken"]
    again = mixing.query(docs.repartition(7)).toPandas()
    assert plain(got[cols].itertuples(index=False)) == plain(again[cols].itertuples(index=False))
    copies = mixing.mixed(docs)
    assert copies.columns == docs.columns and copies.count() == got["copies"].sum()
    assert mixing.query(docs.limit(0)).count() == 0


def test_splitting_tree_is_exact():
    draws = np.array([7, 0, 1000, 33])
    quota = mixing.split_quotas(draws, 16, 5)
    assert (quota.sum(axis=1) == draws).all() and np.ptp(quota.sum(axis=0)) <= 1


# the pipeline ------------------------------------------------------------------------------------------------------
def test_pipeline_stages_act_on_their_own_input(spark):
    from cellpulse.llm._common import stored
    docs = table(spark, SF, "documents")
    seen = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = seen[name] = stored(stage(spark, docs, SF), name)
        if name != "packing":
            assert docs.columns == seen["documents"].columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "mixing", "packing"]
    ids = {n: pd.Series([r["doc_id"] for r in d.select("doc_id").collect()]) for n, d in seen.items()}
    scores = toxicity.classify(seen["documents"], table(spark, SF, "labels"))
    assert set(ids["toxicity"]) == {r["doc_id"] for r in scores.where("predicted = 0").collect()}
    kept = exact_dedup.query(seen["toxicity"]).where("kept")
    assert set(ids["exact_dedup"]) == {r["doc_id"] for r in kept.collect()}
    rows = [tuple(r) for r in seen["exact_dedup"].select("doc_id", "text").collect()]
    assert set(ids["near_dedup"]) == {c[0] for c in brute_components(rows, width=5) if c[3]}
    assert set(ids["mixing"]) <= set(ids["near_dedup"]) and ids["mixing"].value_counts().max() <= 2
    check_lengths = seen["packing"].groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(F.max("n")).first()[0]
    assert check_lengths <= packing.SEQUENCE and set(ids["packing"]) == set(ids["mixing"])


def test_arrow_batches_end_by_bytes_and_plain_texts_need_no_slow_tokenizer(spark):
    """A batch of long texts ends at ``BATCH_BYTES``; a smaller limit set before stays; added tokens are the library's."""
    from cellpulse.llm import _common
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    old = spark.conf.get(setting)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], names=["n", "size"])

    try:
        spark.conf.set(setting, "64m")
        table(spark, SF, "documents")
        long = spark.range(0, 300, 1, 1).select("id", F.repeat(F.lit("abcdefghij"), 10_000).alias("text"))
        got = long.mapInArrow(sizes, "n long, size long").collect()
        assert sum(r["n"] for r in got) == 300 and max(r["size"] for r in got) < 2 * _common.BATCH_BYTES
        spark.conf.set(setting, "1m")
        _common.small_batches(spark)
        assert spark.conf.get(setting) == "1m"
    finally:
        spark.conf.set(setting, old)
    encoder = packing.Encoder()
    encoder.ids("plain text, <|endoftext|> and more")
    assert "slow" not in vars(encoder)
    assert packing.added_tokens(encoder.path)
    assert {t["content"]: t["id"] for t in packing.added_tokens(encoder.path)} == {
        t.content: i for i, t in encoder.slow.get_added_tokens_decoder().items()}
    for text in ("plain text, <|endoftext|> and more", "日本語 <|endoftext|>", ""):
        assert encoder.ids(text).tolist() == encoder.slow.encode(text, add_special_tokens=False).ids

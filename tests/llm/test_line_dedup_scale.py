"""Line dedup on texts of very many lines and on keys whose first hashes collide."""
from __future__ import annotations

import pytest

from cellpulse.llm import line_dedup
from cellpulse.llm._common import ship

from .test_operators import make, same_as_sql


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


def test_texts_of_very_many_lines(spark):
    many = "\n".join(f" Line {i} of many" for i in range(80_000))
    shared = "\n".join(f"shared {i}" if i % 3 else f"own {i} {'x' * (i % 5)}" for i in range(5_000))
    docs = make(spark, [(1, many, "a"), (None, many.upper(), "a")] + [(10 + i, shared + f"\nlast {i}", "b") for i in range(10)])
    assert same_as_sql(line_dedup.query(docs), line_dedup.ORACLE_SQL, documents=docs) == 12


def test_colliding_first_hashes_are_counted_by_both(spark):
    rows = [(i, i, 0, [7, 8, None], [1 if i < 2 else 2, 5, 9]) for i in range(4)] + [(9, 9, 0, [7, 7, 8], [3, 3, 5])]
    keyed = spark.createDataFrame(rows, "row long, k_id long, k_hash long, a array<long>, b array<long>")
    assert {tuple(r) for r in line_dedup._frequent(keyed, 2).collect()} == {(7, 1), (7, 2), (8, 5)}
    assert {tuple(r) for r in line_dedup._frequent(keyed, 3).collect()} == {(8, 5)}

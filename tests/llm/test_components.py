from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tidelake.llm.common import sieve
from tidelake.llm.components import components


def walked(links: list[tuple[int, int]]) -> dict[int, int]:
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {x: find(x) for x in parent}


@pytest.mark.parametrize("links", [
    [], [(3, 3)], [(n, n + 1) for n in range(60)], [(0, n) for n in range(1, 80)],
    [(50, n) for n in range(50)], "random"], ids=["none", "self", "chain", "star", "low", "random"])
def test_against_union_find(spark, links):
    if links == "random":
        draw = random.Random(5)
        links = [(draw.randrange(300), draw.randrange(300)) for _ in range(200)] + [(-4, 7), (-4, -4)]
    frame = spark.createDataFrame(links, "a long, b long")
    found = [tuple(r) for r in components(frame).collect()]
    assert len(found) == len(set(found)) and dict(found) == walked(links)


def test_sieve_lets_its_keys_pass(spark):
    keys = spark.range(0, 40_000, 7).select((F.col("id") * 1_000_003 - 5).alias("k"))
    every = spark.range(40_000).select((F.col("id") * 1_000_003 - 5).alias("k"), "id")
    passed = {r[0] for r in every.where(sieve(keys)(F.col("k"))).select("id").collect()}
    assert passed >= set(range(0, 40_000, 7))
    assert len(passed) < 40_000 / 7 * 1.2
    crowded = every.where(sieve(keys, most_bits=1 << 12)(F.col("k")))  # too small: lets most pass
    assert {r[0] for r in crowded.select("id").collect()} >= set(range(0, 40_000, 7))
    assert every.where(sieve(keys.limit(0))(F.col("k"))).count() == 0

from __future__ import annotations

import re

from tests.llm.tables import documents, rows
from tidelake.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shares(sizes: dict, budget: float = 1.5, most: float = 2.0) -> dict:
    """Targets by filling: share out what is left among the sources that aren't full."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3.0, 1.0, 2.0)[n % 3] for n, s in enumerate(names)}
    target, open_, left = dict.fromkeys(names, 0.0), set(names), budget * sum(sizes.values())
    while left > 1e-9 and open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if target[s] + level * weight[s] >= most * sizes[s]}
        for s in full or open_:
            give = most * sizes[s] - target[s] if full else level * weight[s]
            target[s], left = target[s] + give, left - give
        if not full:
            break
        open_ -= full
    return target


def test_plan(spark):
    docs = documents(spark)
    found = mixing.plan_mix(docs).collect()
    assert len(found) == len(rows())
    sizes: dict = {}
    for r in rows():
        sizes[r[3]] = sizes.get(r[3], 0) + len(WORD.findall(r[1] or ""))
    wanted = shares(sizes)
    for r in found:
        source, size = r["document"]["source"], len(WORD.findall(r["document"]["text"] or ""))
        assert (r["size"], r["source_size"]) == (size, sizes[source])
        assert abs(r["target"] - wanted[source]) < 1e-6
        rate = wanted[source] / sizes[source] if sizes[source] else 0
        assert int(rate) <= r["copies"] <= min(2, int(rate) + 1)
    again = {(str(r["document"]), r["copies"]) for r in mixing.plan_mix(docs.repartition(5)).collect()}
    assert again == {(str(r["document"]), r["copies"]) for r in found}


def test_copies_keep_columns_and_come_near_the_target(spark):
    frame = spark.range(4000).selectExpr(
        "id AS doc_id", "if(id % 3 = 0, 'x', if(id % 3 = 1, 'y', null)) AS source",
        "repeat('w ', cast(1 + id % 50 AS int)) AS text", "id AS size")
    mixed = mixing.mix_sources(frame)
    assert mixed.columns == frame.columns
    taken = {r[0]: r[1] for r in mixed.groupBy("source").agg({"size": "count"}).collect()}
    sizes = dict.fromkeys(("x", "y", None), 0)
    for i in range(4000):
        sizes[("x", "y", None)[i % 3]] += 1 + i % 50
    for source, target in shares(sizes).items():
        words = sum((1 + r["size"] % 50) for r in mixed.where(
            mixed.source.eqNullSafe(source)).select("size").collect())
        assert abs(words - target) < 0.06 * target and taken[source] > 0


def test_empty(spark):
    assert mixing.mix_sources(documents(spark, empty=True)).collect() == []

from __future__ import annotations

import numpy as np
import pytest

from tidelake.llm import vector_dedup

SCHEMA = "vec_id long, embedding array<float>, label int, node long, size string, links int"


def brute(rows: list[tuple], cosine: float) -> dict:
    ok = [n for n, (_, v, label, *_) in enumerate(rows)
          if v and label is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links: dict[int, set] = {n: set() for n in range(len(rows))}
    for n in ok:
        for m in ok:
            a, b = np.array(rows[n][1], float), np.array(rows[m][1], float)
            if n != m and rows[n][2] == rows[m][2] and len(a) == len(b):
                if a @ b / np.sqrt(a @ a) / np.sqrt(b @ b) >= cosine:
                    links[n].add(m)
    out = []
    for n, row in enumerate(rows):
        seen, todo = {n}, [n]
        while todo:
            for m in links[todo.pop()] - seen:
                seen.add(m)
                todo.append(m)
        keys = [rows[m][0] for m in seen if rows[m][0] is not None]
        least = min(keys, default=None)
        out.append((row[0], len(links[n]), least, row[0] == least))
    return sorted(out, key=str)


def table(copies: int = 1, spread: float = 0.02) -> list[tuple]:
    rng = np.random.default_rng(3)
    rows: list[tuple] = []
    for cluster in range(30):
        centre = rng.standard_normal(16)
        for _ in range(1 + cluster % 7):
            v = (centre + spread * np.sqrt(16) * rng.standard_normal(16)).astype(np.float32).tolist()
            rows += [(len(rows) + k, v, cluster % 3) for k in range(copies)]
    n = len(rows)
    v = rows[0][1]
    rows += [(n, None, 1), (n + 1, [0.0] * 16, 1), (n + 2, [None, *v[1:]], 0), (n + 3, v, None),
             (n + 4, [float("nan"), *v[1:]], 0), (n + 5, [float("inf"), *v[1:]], 0), (n + 6, [], 0),
             (n + 7, v[:8], 0), (n + 8, v[:8], 0), (None, v, 0), (n + 9, [x * 1e30 for x in v], 0),
             (n + 10, [x * 1e-30 for x in v], 0), (5, rows[5][1], rows[5][2])]
    return [(*r, 1, "x", 2) for r in rows]


@pytest.mark.parametrize("tile", [1024, 3])
def test_against_all_pairs(spark, monkeypatch, tile):
    monkeypatch.setattr(vector_dedup, "TILE", tile)
    rows = table(copies=2)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = vector_dedup.near_vectors(frame)
    assert found.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute(rows, 0.98)


def test_recall_at_the_threshold(spark):
    """Pairs just above the threshold, and none just below it."""
    rng, rows, angle = np.random.default_rng(8), [], np.arccos(0.9801)
    for n in range(1500):
        a, b = rng.standard_normal((2, 64))
        a /= np.linalg.norm(a)
        b -= (a @ b) * a
        b /= np.linalg.norm(b)
        far = np.arccos(0.979) if n % 3 == 0 else angle
        rows += [(2 * n, a.tolist(), 1), (2 * n + 1, (np.cos(far) * a + np.sin(far) * b).tolist(), 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    linked = {r["vec_id"] // 2 for r in vector_dedup.near_vectors(frame).where("n_links > 0").collect()}
    assert not any(n % 3 == 0 for n in linked)
    assert len(linked) >= 0.995 * 1000


def test_empty(spark):
    assert vector_dedup.near_vectors(spark.createDataFrame([], SCHEMA)).collect() == []

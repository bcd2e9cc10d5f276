from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from tidelake.operators.dense import dense_knn
from tidelake.operators.pruned_knn import pruned_knn, scored_share
from tidelake.sources.vector_cells import read_cells, write_cells


def unit(vectors):
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def clustered(seed, rows=600, clusters=12, spread=0.05, dim=8):
    draw = np.random.default_rng(seed)
    centres = unit(draw.normal(size=(clusters, dim)))
    return unit(centres[draw.integers(0, clusters, rows)] + spread * draw.normal(size=(rows, dim)))


def table(spark, vectors, name="chunk_id"):
    return spark.createDataFrame([(f"{name[0]}{n:05d}", [float(x) for x in v])
                                  for n, v in enumerate(vectors)], f"{name} string, embedding array<double>")


def stored(spark, path, vectors, cells=None):
    rows = table(spark, vectors)
    write_cells(rows, str(path), cells=cells)
    return rows, read_cells(spark, str(path))


def shown(frame):
    return sorted((r["query_id"], r["chunk_id"], round(r["dense_score"], 9), r["rank"])
                  for r in frame.collect())


@pytest.mark.parametrize("k,block", [(1, 50_000), (10, 50), (2000, 50_000)])
def test_the_same_as_scoring_everything(spark, tmp_path, k, block):
    vectors = clustered(1)
    vectors[100:300] = vectors[0]  # a third are one vector: ties, and a cell of many rows
    rows, cells = stored(spark, tmp_path, vectors)
    asked = table(spark, np.concatenate([clustered(2, 20), unit(-vectors[:3]), vectors[:2]]), "query_id")
    assert shown(pruned_knn(cells, asked, k, corpus_rows=block)) == shown(dense_knn(rows, asked, k))
    assert cells.cells.agg({"rows": "sum"}).first()[0] == 600


def test_clusters_are_skipped_and_noise_is_not(spark, tmp_path):
    asked = table(spark, clustered(3, 15), "query_id")
    shares = {}
    for name, spread in (("clusters", 0.02), ("noise", 50.0)):
        rows, cells = stored(spark, tmp_path / name, clustered(3, spread=spread))
        seen = []
        got = pruned_knn(cells, asked, 5, report=seen.append)
        assert shown(got) == shown(dense_knn(rows, asked, 5))
        shares[name] = scored_share(cells, seen[0])
    assert shares["clusters"] < 0.4 < shares["noise"] <= 1


def test_one_vector_and_no_question(spark, tmp_path):
    rows, cells = stored(spark, tmp_path, clustered(4, 1))
    asked = table(spark, clustered(5, 2), "query_id")
    assert shown(pruned_knn(cells, asked, 3)) == shown(dense_knn(rows, asked, 3))
    assert pruned_knn(cells, asked.limit(0), 3).collect() == []


def test_many_bytes_of_few_questions_are_not_collected(spark, monkeypatch):
    """Six questions with long vectors: more bytes than may be broadcast, so they meet in a grid."""
    from tidelake.operators import best_matches

    rows, asked = table(spark, clustered(6, 40)), table(spark, clustered(7, 6), "query_id")
    small = shown(dense_knn(rows, asked, 3))
    monkeypatch.setattr(best_matches, "QUERY_BYTES", 300)
    monkeypatch.setattr(type(asked), "toArrow", lambda self: pytest.fail("collected"))
    assert shown(dense_knn(rows, asked, 3)) == small


def test_a_query_travels_to_groups_of_cells_not_to_every_cell(spark, tmp_path, monkeypatch):
    """Vectors without clusters: every query visits nearly all cells."""
    from tidelake.operators import pruned_knn as module

    travelled, visits = [], module._visits

    def counted(*given):
        travelled.append(visits(*given).count())
        return visits(*given)

    monkeypatch.setattr(module, "_visits", counted)
    rows, cells = stored(spark, tmp_path, clustered(8, 400, spread=50.0), cells=40)
    asked = table(spark, clustered(9, 30, spread=50.0), "query_id")
    assert shown(pruned_knn(cells, asked, 3)) == shown(dense_knn(rows, asked, 3))
    assert sum(travelled) <= 2 * 30
    travelled.clear()
    monkeypatch.setattr(module, "CELL_BYTES", 1)
    parts = pruned_knn(cells, asked, 3, corpus_rows=100, query_rows=7)
    assert shown(parts) == shown(dense_knn(rows, asked, 3))
    assert sum(travelled) <= 2 * 30 * 5


def test_the_second_round_finds_only_what_is_as_near_as_the_kth_of_the_first(spark, tmp_path, monkeypatch):
    """Every group of cells used to give k rows to every query that visited it."""
    from tidelake.operators import pruned_knn as module

    rounds, scored = [], module._scored

    def kept(*given):
        rounds.append([tuple(r) for r in scored(*given).collect()])
        return scored(*given)

    monkeypatch.setattr(module, "_scored", kept)
    rows, cells = stored(spark, tmp_path, clustered(8, 400, spread=50.0), cells=40)
    asked = table(spark, clustered(9, 30, spread=50.0), "query_id")
    assert shown(pruned_knn(cells, asked, 3)) == shown(dense_knn(rows, asked, 3))
    first, second = rounds
    kth = {q: sorted((s for p, _, s in first if p == q), reverse=True)[2] for q, *_ in first}
    assert second and all(s >= kth[q] - 1e-5 for q, _, s in second)


def test_rows_are_ordered_once_for_many_small_slices(monkeypatch):
    from tidelake.operators import best_matches

    draw, sorted_rows, lexsort = np.random.default_rng(5), [], np.lexsort
    monkeypatch.setattr(np, "lexsort", lambda keys: sorted_rows.append(len(keys[-1])) or lexsort(keys))
    scores, ids = draw.normal(size=(3000, 50)), np.arange(3000)
    best = best_matches.Best(10, 50)
    for n in range(0, 3000, 10):  # half of the queries at a time
        for mine in (np.arange(0, 50, 2), np.arange(1, 50, 2)):
            best.add(pa.array(ids[n:n + 10]), scores[n:n + 10][:, mine], -np.inf, mine)
    found = sorted(zip(best.column.tolist(), best.ids.to_pylist(), strict=True))
    assert found == sorted((c, int(i)) for c in range(50) for i in np.argsort(-scores[:, c])[:10])
    assert sum(sorted_rows) < 30_000

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidelake.functions import text
from tidelake.operators import documents as d
from tidelake.operators.best_matches import CELL_BYTES, SPARE_BYTES, TIE_DECIMALS, Best, grid_shape
from tidelake.operators.dense import dense_knn
from tidelake.operators.embedding import embed_text, normalize_vectors
from tidelake.operators.fusion import hybrid_fuse, rerank, rrf_fuse
from tidelake.operators.grounding import NO_CONTEXT, citations, grounded_context
from tidelake.operators.lexical import bm25_search
from tidelake.operators.term_index import bm25_index
from tidelake.plans.retrieval import hybrid_retrieve, indexable_chunks
from tidelake.schemas import CHUNK, INDEXED_CHUNK
from tidelake.plans.indexing import update_index
from tidelake.session import settings
from tidelake.sources.layers import write_snapshot
from tidelake.sources.vector_table import STATE, compact_index, read_index, vector_table_sink

WORDS = [f"w{n}" for n in range(60)] + ["the"] * 30


def sentence(rng, low, high):
    return " ".join(rng.choice(WORDS) for _ in range(rng.randint(low, high)))


def docs(spark, texts):
    return spark.createDataFrame(
        [(f"d{n:03}", f"uri/{n}", f"title {n % 5}", t) for n, t in enumerate(texts)],
        "document_id string, source_uri string, title string, text string")


def windows(text, size, overlap):
    """Windows by plain search for the last space."""
    found, start = [], 0
    while True:
        end = start + size
        if end >= len(text):
            return found + [(start, len(text))]
        space = text.rfind(" ", start + overlap + 1, end)
        end = space if space >= 0 else end
        found.append((start, end))
        start = end - overlap


def test_chunks_of_a_repeated_sentence(spark):
    text = "Lanterns drift past the quiet harbour; " * 70
    first = d.chunk_documents(docs(spark, [text]), 90, 25).orderBy("chunk_number").collect()
    assert len(first) > 1
    assert [r.chunk_id for r in first] == [r.chunk_id for r in d.chunk_documents(
        docs(spark, [text]), 90, 25).orderBy("chunk_number").collect()]
    assert {r.source_uri for r in first} == {"uri/0"}
    digest = hashlib.sha256(f"d000:1:{first[1].text}".encode()).hexdigest()
    assert first[1].chunk_id == digest


@pytest.mark.parametrize(("size", "overlap"), [(40, 10), (10, 9), (1, 0), (50, 0), (30, 28)])
def test_chunks_against_plain_search(spark, size, overlap):
    rng = random.Random(size)
    texts = [sentence(rng, 1, 80) for _ in range(30)]
    texts += ["x" * 200, "a " + "y" * 120 + " b", "short", "é ü " * 40, " \n lead", "tab\tnew\nline"]
    rows = d.chunk_documents(docs(spark, texts), size, overlap).collect()
    for n, text in enumerate(texts):
        normal = " ".join(text.split())
        mine = sorted((r.chunk_number, r.char_start, r.char_end, r.text) for r in rows
                      if r.document_id == f"d{n:03}")
        spans = windows(normal, size, overlap)
        assert [(a, b) for _, a, b, _ in mine] == spans
        assert all(t == normal[a:b] for _, a, b, t in mine)
        assert mine[0][1] == 0 and mine[-1][2] == len(normal)
        assert all(after[1] <= before[2] for before, after in zip(mine, mine[1:]))


def test_blank_documents_and_bad_windows(spark):
    assert d.chunk_documents(docs(spark, ["", "  ", "\n\t ", None])).count() == 0
    for size, overlap in ((0, 0), (10, 10), (10, -1)):
        with pytest.raises(ValueError, match="size must be positive"):
            d.window_pattern(size, overlap)


def test_normalised_text_equals_split_and_join(spark):
    odd = [c for c in map(chr, range(0x3001)) if c.isspace()]
    texts = [f"a{c}{c} b{c}" for c in odd] + ["plain", "a​b"]
    rows = d.normalize_text(docs(spark, texts)).orderBy("document_id").collect()
    assert [r.text for r in rows] == [" ".join(t.split()) for t in texts]


def tokens(text):
    return [t for t in re.split(r"[\W_]+", text.lower()) if t]


def hashed(text, dim):
    vector = np.zeros(dim)
    for t in tokens(text):
        vector[int(hashlib.md5(t.encode()).hexdigest()[:8], 16) % dim] += 1
    return vector / np.linalg.norm(vector)


def test_embedding(spark):
    rng = random.Random(3)
    texts = [sentence(rng, 1, 50) for _ in range(20)] + ["Été ÉTÉ x_y"]
    for dim in (8, 64):
        rows = embed_text(docs(spark, texts), dim=dim).orderBy("document_id").collect()
        for row, text in zip(rows, texts, strict=True):
            assert np.allclose(row.embedding, hashed(text, dim), atol=1e-6)
    with pytest.raises(Exception, match="must not be empty"):
        embed_text(docs(spark, [" "])).collect()


def test_embedding_by_a_model(spark):
    def lengths(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [float(len(t)), 1.0])

    row = embed_text(docs(spark, ["abc"]), encode=lengths).first()
    assert np.allclose(row.embedding, np.array([3, 1]) / math.sqrt(10))


def test_zero_vectors_stay(spark):
    frame = spark.createDataFrame([([0.0, 0.0],), ([3.0, 4.0],)], "embedding array<float>")
    got = sorted(list(r.embedding) for r in normalize_vectors(frame).collect())
    assert got == [[0.0, 0.0], [0.6, 0.8]]


def exact(vectors, asked, k):
    best = {}
    for name, q in asked.items():
        scored = sorted((-round(float(q @ v), 12), c) for c, v in vectors.items())
        best[name] = [c for _, c in scored[:k]]
    return best


def lists(frame, column="chunk_id"):
    found = {}
    for r in frame.orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append(r[column])
    return found


@pytest.mark.parametrize("query_rows", [8_192, 3])
def test_dense_search_both_ways(spark, query_rows):
    rng = np.random.default_rng(5)
    vectors = {f"c{n:04}": rng.integers(-3, 4, 6).astype(float) for n in range(400)}
    for n in range(0, 400, 3):  # a third of the corpus is one vector
        vectors[f"c{n:04}"] = np.ones(6)
    asked = {f"q{n:02}": rng.integers(-3, 4, 6).astype(float) for n in range(11)}
    asked["q11"] = np.ones(6)
    corpus = spark.createDataFrame(
        [(c, v.tolist()) for c, v in vectors.items()], "chunk_id string, embedding array<float>")
    queries = spark.createDataFrame(
        [(q, v.tolist()) for q, v in asked.items()], "query_id string, embedding array<float>")
    found = dense_knn(corpus.repartition(5), queries, 7, query_rows=query_rows, corpus_rows=90)
    assert lists(found) == exact(vectors, asked, 7)
    tiny = dense_knn(corpus.limit(3), queries, 7, query_rows=query_rows, corpus_rows=90)
    assert all(len(v) == 3 for v in lists(tiny).values())
    assert dense_knn(corpus.limit(0), queries, 7, query_rows=query_rows).count() == 0


def test_grid_copies_little():
    def copied(vectors, asked):
        across, down = grid_shape(vectors, vectors * 1300, 200, asked, asked * 1300, 150, 20)
        return across, down, vectors * 1300 * down, (asked * 1300 + asked * 20 * 128) * across

    assert copied(500, 400)[:2] == (3, 3)  # as wanted
    for rows in (10_000, 100_000, 600_000):
        most = max(SPARE_BYTES, rows * (1300 + 20 * 128) * (1 + rows * 1300 // CELL_BYTES))
        assert max(copied(rows, rows)[2:]) <= most
    # A few questions over a large index: it is shuffled once.
    assert grid_shape(10**7, 6 * 10**9, 1000, 200, 20_000, 15, 20)[1] == 1


@pytest.mark.parametrize("query_rows", [8_192, 1])
def test_near_scores_are_told_apart(spark, query_rows):
    corpus = spark.createDataFrame(
        [("a", [0.90000011]), ("b", [0.90000039]), ("c", [0.90000039])],
        "chunk_id string, embedding array<double>")
    asked = spark.createDataFrame(
        [("q", [1.0]), ("z", [-1.0])], "query_id string, embedding array<double>")
    found = dense_knn(corpus, asked, 2, query_rows=query_rows).where("query_id = 'q'").orderBy(
        "rank").collect()
    assert [r.chunk_id for r in found] == ["b", "c"]
    assert found[0].dense_score == pytest.approx(0.90000039, abs=1e-12)


def test_null_vectors_are_refused(spark):
    corpus = spark.createDataFrame([("a", [1.0]), ("b", None)],
                                   "chunk_id string, embedding array<double>")
    asked = spark.createDataFrame([("q", [1.0])], "query_id string, embedding array<double>")
    with pytest.raises(Exception, match="is null"):
        dense_knn(corpus, asked, 1).collect()


def bm25(chunks, asked, k):
    """Scores by the formula, one chunk and term at a time."""
    counts = {f: {c: Counter(tokens(r[f])) for c, r in chunks.items()} for f in ("title", "text")}
    best = {}
    for q, query in asked.items():
        scored = []
        for c in chunks:
            fields = []
            for f, boost in (("title", 2.0), ("text", 1.0)):
                filled = [x for x in counts[f].values() if x]
                average = sum(sum(x.values()) for x in filled) / len(filled)
                own, total = counts[f][c], 0.0
                for t, times in Counter(tokens(query)).items():
                    df = sum(1 for x in filled if t in x)
                    if own[t]:
                        norm = 1.2 * (0.25 + 0.75 * sum(own.values()) / average)
                        total += times * math.log(1 + (len(filled) - df + 0.5) / (df + 0.5)) * (
                            own[t] / (own[t] + norm))
                fields.append(boost * total)
            if max(fields) > 0:
                scored.append((-round(max(fields), 12), c))
        best[q] = [c for _, c in sorted(scored)[:k]]
    return best


def test_token_functions_take_slices(monkeypatch):
    """A batch of 10,000 long texts was taken whole; slices give the same and hold little."""
    rng, taken = random.Random(3), []
    lists = pa.array([rng.choices(WORDS, k=rng.randint(0, 9)) if n % 7 else None
                      for n in range(300)], pa.list_(pa.string()))
    monkeypatch.setattr(text, "SLICE_TOKENS", 20)

    def watched(part: pa.Array) -> pa.Array:
        taken.append(len(part.flatten()))
        return text.counted_terms(part)

    assert text.by_slices(watched)(lists).to_pylist() == text.counted_terms(lists).to_pylist()
    assert max(taken) <= 20 + 9 and len(taken) > 10
    assert len(text.by_slices(watched)(lists.slice(0, 0))) == 0
    monkeypatch.setattr(d, "SLICE_CHARS", 50)
    batch = pa.RecordBatch.from_pydict({"text": ["x" * 30] * 10 + [None]})
    assert pa.Table.from_batches(d.slices(batch)).to_pydict() == batch.to_pydict()
    assert max(p.num_rows for p in d.slices(batch)) <= 3


@pytest.mark.parametrize("query_rows", [8_192, 2])
def test_lexical_search_both_ways(spark, query_rows):
    rng = random.Random(9)
    chunks = {f"c{n:03}": {"title": rng.choice(["the w1", "w2 report", "", "w3"]),
                           "text": sentence(rng, 1, 25)} for n in range(150)}
    for n in range(0, 150, 3):  # a third of the chunks are copies
        chunks[f"c{n:03}"] = {"title": "the w1", "text": "the w5 the w6"}
    asked = {f"q{n}": sentence(rng, 1, 6) for n in range(7)}
    asked |= {"q7": "the the w5", "q8": "unknown words", "q9": "W1, w2!"}
    table = spark.createDataFrame([(c, r["title"], r["text"]) for c, r in chunks.items()],
                                  "chunk_id string, title string, text string").repartition(4)
    queries = spark.createDataFrame(list(asked.items()), "query_id string, query string")
    found = lists(bm25_search(bm25_index(table), queries, 6, query_rows=query_rows,
                              corpus_rows=40))
    assert found == {q: c for q, c in bm25(chunks, asked, 6).items() if c}


def test_blank_question_is_refused(spark):
    index = bm25_index(docs(spark, ["some text"]).withColumn("chunk_id", F.lit("c")))
    blank = spark.createDataFrame([("q", " \n")], "query_id string, query string")
    with pytest.raises(Exception, match="query cannot be empty"):
        bm25_search(index, blank).collect()


def ranking(spark, score, *names):
    return spark.createDataFrame([("q", n, r, 1.0 / r) for r, n in enumerate(names, 1)],
                                 f"query_id string, chunk_id string, rank int, {score} double")


def test_fusion_promotes_shared_results_and_keeps_both_scores(spark):
    both = {"dense": ranking(spark, "dense_score", "a", "b"),
            "lexical": ranking(spark, "lexical_score", "b", "c")}
    got = {r.chunk_id: r for r in rrf_fuse(both).collect()}
    assert got["b"].fused_score == pytest.approx(1 / 62 + 1 / 61)
    assert (got["a"].fused_score, got["c"].fused_score) == pytest.approx((1 / 61, 1 / 62))
    assert (got["b"].dense_score, got["b"].lexical_score) == (0.5, 1.0)
    assert [r.chunk_id for r in hybrid_fuse(both["dense"], both["lexical"], k=2).orderBy(
        "rank").collect()] == ["b", "a"]
    with pytest.raises(ValueError, match="positive"):
        rrf_fuse(both, 0)


def test_rerank_by_a_scorer(spark):
    rows = spark.createDataFrame(
        [("q", f"c{n}", "red car", t, 1.0 / n) for n, t in enumerate(
            ["blue", "a red car", "car red", "red"], 1)],
        "query_id string, chunk_id string, query string, text string, fused_score double")
    assert lists(rerank(rows, k=3)) == {"q": ["c2", "c3", "c4"]}

    def shortest(queries: pd.Series, texts: pd.Series) -> pd.Series:
        return -texts.str.len().astype(float)

    assert lists(rerank(rows, shortest, k=2)) == {"q": ["c4", "c1"]}


def test_questions_to_cited_context(spark, tmp_path):
    rng = random.Random(11)
    events = spark.createDataFrame(
        [(f"e{n:02}", f"c{n % 4}", "support_case", sentence(rng, 20, 200)) for n in range(30)],
        "event_id string, customer_id string, event_type string, document_text string")
    root = str(tmp_path / "index")
    vector_table_sink(indexable_chunks(events, size=120, overlap=20), root)
    index = read_index(spark, root)
    questions = spark.createDataFrame(
        [("q1", "w1 w2 w3"), ("q2", "support case for customer c2")],
        "query_id string, query string")
    results = hybrid_retrieve(index, questions)
    rows = results.orderBy("query_id", "rank").collect()
    assert Counter(r.query_id for r in rows) == {"q1": 5, "q2": 5}
    scores = [r.rerank_score for r in rows if r.query_id == "q1"]
    assert scores == sorted(scores, reverse=True)
    more = questions.unionByName(spark.createDataFrame([("q3", "x")], questions.schema))
    contexts = {r.query_id: r.context for r in grounded_context(more, results).collect()}
    first = [r for r in rows if r.query_id == "q1"]
    assert contexts["q1"] == "\n\n".join(f"[{n}] {r.text}" for n, r in enumerate(first, 1))
    assert contexts["q3"] == NO_CONTEXT
    cited = {r.query_id: r.citations for r in citations(more, results).collect()}
    assert [c.chunk_id for c in cited["q1"]] == [r.chunk_id for r in first]
    assert cited["q3"] == []
    assert first[0].source_uri.startswith("delta://silver/customer_events/e")


def test_changed_documents_replace_their_chunks(spark, tmp_path):
    root = str(tmp_path / "index")
    schema = "event_id string, customer_id string, event_type string, document_text string"

    def chunks(*rows):
        events = spark.createDataFrame([(e, "c", "kind", t) for e, t in rows], schema)
        return indexable_chunks(events, size=20, overlap=5)

    vector_table_sink(chunks(("a", "one two three four five six"), ("b", "other text")), root)
    before = read_index(spark, root)
    assert before.select(*CHUNK.names).where("document_id = 'a'").count() > 1
    vector_table_sink(chunks(("a", "short")), root)
    after = {(r.document_id, r.text) for r in read_index(spark, root).collect()}
    assert after == {("a", "short"), ("b", "other text")}
    gone = spark.createDataFrame([("b",)], "document_id string")
    vector_table_sink(chunks(("a", "short")).limit(0), root, documents=gone)
    assert {r.document_id for r in read_index(spark, root).collect()} == {"a"}
    compact_index(spark, root)
    assert {r.document_id for r in read_index(spark, root).collect()} == {"a"}
    vector_table_sink(chunks(("b", "again")), root)
    assert {(r.document_id, r.text) for r in read_index(spark, root).collect()} == {
        ("a", "short"), ("b", "again")}


def test_an_update_writes_only_what_changed(spark, tmp_path):
    root = str(tmp_path / "index")
    schema = "event_id string, customer_id string, event_type string, document_text string"

    def events(*rows):
        return spark.createDataFrame([(e, "c", "kind", t) for e, t in rows], schema)

    def files():
        return {p.relative_to(tmp_path).as_posix(): p.stat().st_mtime_ns
                for p in tmp_path.rglob("part-*")}

    update_index(events(("a", "one"), ("b", "two"), ("c", "three")), root)
    first = files()
    update_index(events(("a", "one"), ("b", "deux"), ("d", "four")), root)
    assert {k: v for k, v in files().items() if k in first} == first
    written = spark.read.parquet(f"{root}/changes-{0:010d}")
    assert sorted(r.text for r in written.collect()) == ["deux", "four"]
    assert sorted(r.text for r in read_index(spark, root).collect()) == ["deux", "four", "one"]
    before = files()
    update_index(events(("a", "one"), ("b", "deux"), ("d", "four")), root)
    assert spark.read.parquet(f"{root}/changes-{0:010d}").count() == 2
    assert set(before) <= set(files())


def test_reading_the_index_moves_no_chunks(spark, tmp_path):
    """Of a table too large for Spark's own broadcasts: the index stays where it is."""
    root = str(tmp_path / "index")

    def chunks(*rows):
        return indexable_chunks(spark.createDataFrame(
            [(e, "c", "kind", t) for e, t in rows],
            "event_id string, customer_id string, event_type string, document_text string"))

    def texts():
        index = read_index(spark, root)
        plan = index._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
        return sorted(r.text for r in index.collect())

    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1",
                          "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}):
        vector_table_sink(chunks(("a", "one"), ("b", "two")), root)
        assert texts() == ["one", "two"]
        vector_table_sink(chunks(("a", "uno"), ("b", "due")), root)  # all of the snapshot
        assert texts() == ["due", "uno"]
        vector_table_sink(chunks(("b", "zwei"), ("c", "drei")), root)  # a part of the write before
        assert texts() == ["drei", "uno", "zwei"]
        vector_table_sink(chunks(("a", "eins")), root)
        vector_table_sink(chunks(("d", "lost")).limit(0), root, documents=spark.createDataFrame(
            [("c",)], "document_id string"))
        assert texts() == ["eins", "zwei"]
        compact_index(spark, root)
        vector_table_sink(chunks(("b", "deux")), root)  # a part of the snapshot
        assert texts() == ["deux", "eins"]


def test_a_snapshot_without_state_gives_way_to_what_is_written_after(spark, tmp_path):
    root = str(tmp_path / "index")
    events = spark.createDataFrame(
        [("a", "c", "kind", "one"), ("b", "c", "kind", "two")],
        "event_id string, customer_id string, event_type string, document_text string")
    write_snapshot(indexable_chunks(events).select(*INDEXED_CHUNK.names), root, INDEXED_CHUNK)
    spark.createDataFrame([], STATE).write.parquet(f"{root}/state-{0:010d}")
    assert read_index(spark, root).count() == 2
    vector_table_sink(indexable_chunks(events.where("event_id = 'a'").withColumn(
        "document_text", F.lit("uno"))), root)
    assert sorted(r.text for r in read_index(spark, root).collect()) == ["two", "uno"]


def test_the_flow_of_the_readme(spark, tmp_path):
    from tests import samples
    from tidelake.plans import refresh
    from tidelake.plans.indexing import refresh_index
    from tidelake.sources.layers import LakePaths

    lake, everything = LakePaths(str(tmp_path)), samples.messages(spark)
    questions = spark.createDataFrame([("q", "note on a visit_booked")],
                                      "query_id string, query string")
    for batch, documents in (("batch = 'valid'", 8), ("batch <> 'valid'", 11)):
        refresh.validate_batch(everything.where(batch), lake)
        refresh.refresh(spark, lake)
        refresh_index(spark, lake)
        index = read_index(spark, lake.chunks)
        assert index.select("document_id").distinct().count() == documents
        assert hybrid_retrieve(index, questions).count() == 5


def test_later_slices_are_compared_with_the_bar_and_not_sorted(monkeypatch):
    # Once k rows a query are known, a slice costs a comparison; it used to be partitioned every time.
    rng, k, rows, width, step = np.random.default_rng(3), 5, 64_000, 20, 1000
    scores = rng.normal(size=(rows, width))
    scores[:, 3] = np.round(scores[:, 3])       # ties at the k-th place
    scores[:, 4] = np.arange(rows) // 3         # ever better ones, in threes
    scores[:, 5] = -np.inf                      # nothing may be found
    scores[::7, 6] = np.nan
    scores[::2] += rng.uniform(-4e-13, 4e-13, (rows // 2, width))  # less than TIE_DECIMALS shows
    partition, sorted_cells = np.partition, []

    def counted(values, *args, **named):
        sorted_cells.append(values.size)
        return partition(values, *args, **named)

    monkeypatch.setattr(np, "partition", counted)
    best = Best(k, width)
    ids = rng.permutation(rows)
    for n in range(0, rows, step):
        best.add(pa.array(ids[n:n + step]), scores[n:n + step], -np.inf)
    assert sum(sorted_cells) < scores.size / 8
    found = {(c, i) for c, i in zip(best.column.tolist(), best.ids.to_pylist(), strict=True)}
    exact = np.round(scores, TIE_DECIMALS)
    wanted = set()
    for c in range(width):
        there = np.flatnonzero(exact[:, c] > -np.inf)
        first = there[np.lexsort((ids[there], -exact[there, c]))][:k]
        wanted |= {(c, int(ids[n])) for n in first}
    assert found == wanted

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from tests.llm.tables import documents, prose, rows
from tidelake.llm import dart_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text: str | None) -> Counter:
    words = WORD.findall(text or "")
    return Counter(tuple(words[n:n + 5]) for n in range(max(len(words) - 4, bool(words))))


def alike(a: Counter, b: Counter) -> float:
    common = sum((a & b).values())
    total = sum(a.values()) + sum(b.values()) - common
    return common / total if total else 1.0


def groups(found: list[tuple]) -> list[list]:
    """Keys of each class of (key, text)."""
    bags, parent = [shingles(t) for _, t in found], list(range(len(found)))

    def find(n: int) -> int:
        while parent[n] != n:
            n = parent[n]
        return n

    for n in range(len(found)):
        for m in range(n):
            if alike(bags[n], bags[m]) >= 0.8:
                parent[find(n)] = find(m)
    out: dict[int, list] = {}
    for n, (key, _) in enumerate(found):
        out.setdefault(find(n), []).append(key)
    return list(out.values())


def least(keys: list) -> int | None:
    return min((k for k in keys if k is not None), default=None)


def classes(found: list[tuple]) -> list[tuple]:
    """(key, class, size) of all (key, text)."""
    return sorted(((key, least(g), len(g)) for g in groups(found) for key in g), key=str)


def test_signatures_estimate_weighted_similarity():
    draw = random.Random(4)
    for keep in (0.95, 0.9, 0.6):
        a = prose(11, 400).split(" ") + ["again and again and"] * 30
        b = [w if draw.random() < keep ** 0.2 else "other" + str(draw.random()) for w in a]
        texts = [" ".join(a), " ".join(b)]
        cell, starts = dart_dedup.cells(pa.array(texts))
        sign = dart_dedup.signatures(cell, starts, 2000)
        exact = alike(*map(shingles, texts))
        assert abs((sign[0] == sign[1]).mean() - exact) < 0.05
        assert abs(dart_dedup.weighted_similarity(
            pa.array(texts[:1]), pa.array(texts[1:]))[0].as_py() - exact) < 1e-12


def test_signature_does_not_depend_on_neighbours():
    texts = pa.array([r[1] for r in rows()], pa.string())
    together = dart_dedup.text_signs(texts).to_pylist()
    assert together == [dart_dedup.text_signs(texts.slice(n, 1)).to_pylist()[0]
                        for n in range(len(texts))]
    assert [len(t["bands"]) for t in together] == [28 if WORD.findall(t.as_py() or "") else 0 for t in texts]
    assert np.array(dart_dedup.cells(texts)[1]).tolist()[0] == 0


def test_classes_of_awkward_rows(spark):
    found = dart_dedup.near_duplicates(documents(spark)).collect()
    pairs = [(r[0], r[1] or "") for r in rows()]
    assert sorted(((r["doc_id"], r["class_id"], r["class_size"]) for r in found),
                  key=str) == classes(pairs)
    assert all(r["kept"] == (r["doc_id"] == r["class_id"]) for r in found)


def test_large_groups_of_near_copies(spark):
    """Chains and groups whose members aren't all like the first one."""
    draw, found = random.Random(6), []
    for group in range(6):
        words = prose(50 + group, 150).split(" ")
        for _ in range(25):
            if draw.random() < 0.5:
                words[draw.randrange(len(words))] = f"w{draw.random()}"
            found.append((len(found), " ".join(words)))
    draw.shuffle(found)
    frame = spark.createDataFrame(found, "doc_id long, text string").repartition(4)
    got = dart_dedup.near_duplicates(frame).select("doc_id", "class_id", "class_size").collect()
    assert sorted((tuple(r) for r in got), key=str) == classes(found)


def test_few_pairs_in_a_large_family_just_below(spark):
    """2,000 texts of one template at 0.78 to each other, six pairs among them above 0.8."""
    template, found = prose(70, 200), []
    for n in range(2_000):
        own = [f"w{n}x{k}" for k in range(28)]
        if n >= 1_994:
            own = found[n - 1_994][1].split(" ")[200:220] + own[20:]
        found.append((n, " ".join([template, *own])))
    number: dict[tuple, int] = {}
    bags = [{number.setdefault(x, len(number)) for x in shingles(t)} for _, t in found]
    alike_ = {(m, n) for n in range(len(bags)) for m in range(n)
              if (c := len(bags[m] & bags[n])) >= 0.8 * (len(bags[m]) + len(bags[n]) - c)}
    assert alike_ == {(n, n + 1_994) for n in range(6)}
    assert len(bags[7] & bags[8]) > 0.77 * len(bags[7] | bags[8])
    frame = spark.createDataFrame(found, "doc_id long, text string").repartition(4)
    got = dart_dedup.near_duplicates(frame).where("class_size > 1").collect()
    assert {(r["class_id"], r["doc_id"]) for r in got if not r["kept"]} == alike_


def test_one_per_class_keeps_rows_whole(spark):
    docs = documents(spark)
    kept = dart_dedup.one_per_class(docs)
    assert kept.columns == docs.columns
    left = kept.collect()
    wanted = [least(g) for g in groups([(r[0], r[1] or "") for r in rows()])]
    assert sorted(str(r["doc_id"]) for r in left) == sorted(map(str, wanted))
    assert {tuple(r) for r in left} <= set(rows())


def test_empty(spark):
    assert dart_dedup.near_duplicates(documents(spark, empty=True)).collect() == []
    assert dart_dedup.one_per_class(documents(spark, empty=True)).collect() == []

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tests.llm.tables import documents, rows
from tidelake.llm import interpolated_lm as lm

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {n: n + 32 for n in range(65, 91)}


def tokens(text: str | None) -> list[str]:
    return [*WORD.findall((text or "").translate(LOWER)), "</s>"]


def brute(found: list[tuple]) -> tuple[list[tuple], float]:
    """Counts in dictionaries, weights by EM on the triples themselves."""
    kind = [zlib.crc32(("" if k is None else str(k)).encode()) % 10 for k, _ in found]
    texts = [tokens(t) for _, t in found]

    def count(skip: set[int]) -> tuple[Counter, Counter, Counter]:
        one, two = Counter(), Counter()
        for k, t in zip(kind, texts, strict=True):
            if k not in skip:
                one.update(t)
                two.update(zip(["<s>", *t], t, strict=False))
        return one, two, one + Counter({"<s>": one["</s>"]})

    def parts(t: list[str], counts: tuple, v: int) -> list[tuple[int, float, float]]:
        one, two, context = counts
        n, out = sum(one.values()), []
        for h, w in zip(["<s>", *t], t, strict=False):
            c = context[h]
            out.append((int(math.log2(c)) + 1 if c else 0, two[h, w] / c * (v + 1) if c else 0.0,
                        one[w] / n * (v + 1) if n else 0.0))
        return out

    full, rest = count({0}), count({0, 1})
    v, n = len(full[0]), sum(full[0].values())
    seen = [p for k, t in zip(kind, texts, strict=True) if k == 1 for p in parts(t, rest, v)]
    bucket, two, one = (np.array(x) for x in zip(*seen, strict=True)) if seen else [np.zeros(0)] * 3
    weights = lm.learn_weights(bucket.astype(int), lm.level(two), lm.level(one), np.ones(len(bucket)))
    out = []
    for (key, _), k, t in zip(found, kind, texts, strict=True):
        base = sum(math.log10((full[0][w] + 0.1) / (n + 0.1 * (v + 1))) for w in t)
        score = sum(math.log10((weights[b] @ [x, y, 1.0]) / (v + 1)) for b, x, y in parts(t, full, v))
        out.append((key, k == 0, len(t), sum(full[0][w] > 0 for w in t), n, base, score))
    return out, v


def texts() -> list[tuple]:
    return [(r[0], r[1]) for r in rows()]


@pytest.mark.parametrize("chunk_bytes,range_keys", [(8 << 20, 2_000_000), (3_000, 500)])
def test_against_dictionaries(spark, chunk_bytes, range_keys):
    found = lm.score(documents(spark), chunk_bytes=chunk_bytes, range_keys=range_keys)
    assert found.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens",
                             "base_score", "score"]
    wanted, _ = brute(texts())
    order = lambda r: (str(r[0]), r[2], round(r[5], 6))
    for got, want in zip(sorted(map(tuple, found.collect()), key=order), sorted(wanted, key=order),
                         strict=True):
        assert got[:5] == want[:5]
        assert got[5:] == pytest.approx(want[5:], rel=1e-9)


def test_model_is_better_than_its_base_on_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    row = lm.score(docs).where("held_out").selectExpr(
        "sum(score) AS s", "sum(base_score) AS b", "sum(n_tokens) AS n").first()
    assert row["s"] > row["b"] + 0.5 * row["n"]  # half a decimal digit per token


def test_em_finds_the_mixture():
    rng = np.random.default_rng(1)
    bucket = rng.integers(1, 4, 30_000)
    share = np.array([[0.1, 0.6, 0.3], [0.5, 0.3, 0.2], [0.8, 0.15, 0.05]])
    which = np.array([rng.choice(3, p=share[b - 1]) for b in bucket])
    two = np.where(which == 0, 2.0 ** 12, 0.0)
    one = np.where(which == 1, 2.0 ** 8, 2.0 ** -6)
    found = lm.learn_weights(bucket, lm.level(two), lm.level(one), np.ones(30_000))
    assert np.abs(found[1:4] - share).max() < 0.03
    assert np.allclose(found.sum(axis=1), 1)


def test_probabilities_sum_to_one():
    """Over all words that can follow a context, known ones and one share for the others."""
    weights = np.array([0.5, 0.4, 0.1])
    one, two = Counter("aababbc"), Counter(zip("aababb", "ababbc", strict=True))
    n, v = sum(one.values()), len(one)
    context = Counter("aababb")
    total = sum(weights @ [two["a", w] / context["a"], one[w] / n, 1 / (v + 1)] for w in "abc")
    assert abs(total + weights[2] / (v + 1) - 1) < 1e-12


def test_empty(spark):
    assert lm.score(documents(spark, empty=True)).collect() == []
    one = lm.score(spark.createDataFrame([(None, "a b")], "doc_id long, text string")).collect()
    assert len(one) == 1 and one[0]["held_out"] and one[0]["score"] == pytest.approx(0)

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import numpy as np
import xxhash
from pyspark.sql import functions as F

from tests.llm.tables import documents, prose, rows
from tidelake.llm import weighted_sampling as ws
from tidelake.llm.queries import op12_weighted_fingerprints

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def chained(*values: str | int) -> int:
    """Spark's xxhash64: each value is hashed with the hash so far as its seed."""
    seed = 42
    for v in values:
        size = 8 if isinstance(v, int) and not -(2**31) <= v < 2**31 or v is values[0] else 4
        raw = v.encode() if isinstance(v, str) else v.to_bytes(size, "little", signed=True)
        seed = xxhash.xxh64_intdigest(raw, seed=seed)
    return seed - (1 << 64) if seed >> 63 else seed


def weights(text: str | None) -> Counter:
    words = WORD.findall(text or "")
    if len(words) >= 5:
        return Counter(chained(*words[n:n + 5]) for n in range(len(words) - 4))
    return Counter(chained(w) for w in words) or Counter([chained("")])


def unit(bits: int) -> float:
    return ((bits & 0xFFFFFFFF) + 0.5) / 2**32


def signature(text: str | None, samples: int) -> list[tuple[int, int]]:
    """Term and t of the least offer, for every sample."""
    out = []
    for n in range(samples):
        offers = []
        for term, w in weights(text).items():
            a, b, c = (chained(term, 3 * n + k) & (2**64 - 1) for k in range(3))
            r = -math.log(unit(a) * unit(a >> 32))
            t = math.floor(math.log(w) / r + unit(c))
            offers.append((math.log(-math.log(unit(b) * unit(b >> 32))) - r * (t - unit(c) + 1),
                           term, t))
        out.append(min(offers)[1:])
    return out


def test_against_terms_in_python(spark):
    found = ws.edited_fingerprints(documents(spark), samples=8).collect()
    order = sorted(rows(), key=lambda r: (r[0] is not None, r[0] or 0,
                                          chained(r[1] or "")))
    short = {t: signature(t, 8) for t in {r[1] for r in order} if len(t or "") < 20_000}
    wanted = []
    for n, (key, text, *_) in enumerate(order):
        text, after = text or "", order[(n + 1) % len(order)][1] or ""
        k = len(text) // 4
        edited = text[:len(text) - k] + after[:k]
        sha = hashlib.sha256(edited.encode()).hexdigest()
        if max(len(text), len(after)) > 20_000:
            wanted.append((str(key), len(text), sha))
            continue
        mine, its, other = (short.get(t) or signature(t, 8) for t in (text, edited, after))
        wanted.append((str(key), len(text), sha, np.mean([a == b for a, b in zip(mine, its)]),
                       np.mean([a == b for a, b in zip(mine, other)])))
    got = sorted((str(r["doc_id"]), r["n_chars"], r["edited_sha256"], r["near_edited"],
                  r["near_next"]) for r in found)
    wanted.sort()
    assert len(got) == len(wanted)
    for a, b in zip(got, wanted):
        assert a[:len(b)] == b
    prints: dict = {}
    for r in found:
        prints.setdefault(r["fingerprint"], set()).add(r["n_chars"])
    same = [r["fingerprint"] for r in found if r["doc_id"] in (1, 2)]
    assert len(set(same)) == 1 and all(len(p) == 64 for p in prints)


def test_collision_rate_is_the_weighted_similarity(spark):
    base, other = prose(1, 160), prose(2, 60)
    pairs = [(base, " ".join(base.split()[:120]) + " " + other), (base + " " + base, base),
             (base, other), (" ".join(["so it goes on and on"] * 30), "so it goes on and on once more")]
    flat = [(n, side, t) for n, p in enumerate(pairs) for side, t in enumerate(p)]
    found = ws.fingerprints(spark.createDataFrame(flat, "n int, side int, text string"),
                            ["n", "side"], samples=400).collect()
    sample = {(r["n"], r["side"]): r["samples"] for r in found}
    for n, (a, b) in enumerate(pairs):
        wa, wb = weights(a), weights(b)
        true = sum((wa & wb).values()) / sum((wa | wb).values())
        rate = np.mean([x == y for x, y in zip(sample[n, 0], sample[n, 1])])
        assert abs(rate - true) <= 4 * math.sqrt(max(true * (1 - true), 1e-9) / 400), (n, rate, true)


def test_single_repeated_and_empty(spark):
    schema = "doc_id long, text string, id int, sha string, which int"
    assert ws.edited_fingerprints(spark.createDataFrame([], schema)).collect() == []
    one = ws.edited_fingerprints(spark.createDataFrame([(5, "abcdefgh", 1, "", 2)], schema)).first()
    assert one["edited_sha256"] == hashlib.sha256(b"abcdefab").hexdigest() and one["near_next"] == 1
    many = [(5, "abcdefgh", 1, "", 2)] * 9000 + [(6, "z", 1, "", 2)]
    found = ws.edited_fingerprints(spark.createDataFrame(many, schema)).collect()
    edited = Counter(r["edited_sha256"] for r in found)
    assert edited == {hashlib.sha256(b"abcdefab").hexdigest(): 8999,
                      hashlib.sha256(b"abcdefz").hexdigest(): 1, hashlib.sha256(b"z").hexdigest(): 1}


def test_plan_has_no_python(spark):
    frame = op12_weighted_fingerprints(spark, "/root/testdata/sf0.001")
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert frame.where(F.col("near_edited").between(0, 1)).count() == frame.count() == 200

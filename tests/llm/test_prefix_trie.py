from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from tidelake.llm import prefix_trie

SCHEMA = "conv_id long, turn int, role string, text string, base int, key string, turns int"


def plain(rows: list[tuple]) -> list[tuple]:
    """Every node with its members, by walking all prefixes of all conversations."""
    own = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            own[c].append(((turn is not None, turn or 0, digest), (role, text)))
    own = {c: [t for _, t in sorted(v)] for c, v in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(np.fmod(c, 100))
        whole[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, turns in sorted(whole.items()):
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    below = defaultdict(set)
    for node in members:
        for d in range(len(node) + 1):
            below[node[:d]].add(node)
    out = []
    for node, found in members.items():
        kids = [n for n in below[node] if len(n) == len(node) + 1]
        ends = ",".join(str(c) for c in found if whole[c] == node)
        out.append((
            found[0], len(node), members[node[:-1]][0] if node else None, len(found), len(kids),
            sum(1 for n in below[node] if all(len(k) == len(n) for k in below[n])),
            sum((len(members[n]) - 1) * (len(n[-1][1]) if n else 0) for n in below[node]),
            hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def draw(seed: int, convs: int, hot: int = 0) -> list[tuple]:
    r, rows = random.Random(seed), []
    for c in r.sample(range(-40, 900), convs):
        for n in range(r.randint(1, 7)):
            rows.append((c, r.choice([None, n, n, n]), r.choice(["user", "bot", None]),
                         r.choice(["a", "bb", "ü\U0001f600", None, ""]), 1, "x", 2))
    for c in range(2000, 2000 + hot):
        rows += [(c, n, "user", "same" * n, 1, "x", 2) for n in range(9)]
    return rows + rows[:5] + [(None, 1, "user", "no number", 1, "x", 2)]


@pytest.mark.parametrize("seed,convs,hot,turns", [(1, 60, 0, 9), (2, 150, 300, 40), (3, 3, 0, 1)])
def test_nodes_against_walked_prefixes(spark, seed, convs, hot, turns):
    rows = draw(seed, convs, hot)
    found = prefix_trie.conversation_trie(
        spark.createDataFrame(rows, SCHEMA).repartition(4), shard_turns=turns)
    assert found.columns == prefix_trie.COLUMNS
    assert sorted((tuple(r) for r in found.collect()), key=str) == plain(rows)


def test_turnless_long_and_empty(spark):
    short = [c for c in range(100, 200) if zlib.crc32(str(c).encode()) % 6 >= 2][:2]
    rows = [(c, 0, "user", "gone", 1, "x", 2) for c in short]  # no conversation 100: all are cut off
    rows = [r for r in rows if r[0] != 100]
    found = prefix_trie.conversation_trie(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [tuple(r) for r in found] == plain(rows) and found[0]["n_leaves"] == 1
    rows += [(500, n, "user", f"turn {n % 50}", 1, "x", 2) for n in range(700)]
    found = prefix_trie.conversation_trie(spark.createDataFrame(rows, SCHEMA))
    assert sorted((tuple(r) for r in found.collect()), key=str) == plain(rows)
    assert prefix_trie.conversation_trie(spark.createDataFrame([], SCHEMA)).collect() == []


def test_extents_against_scans():
    r = np.random.default_rng(5)
    values = np.concatenate([[-1], r.integers(0, 6, 200)])
    minima = prefix_trie.RangeMinima(values)
    at, least = r.integers(0, 201, 500), r.integers(0, 6, 500)
    for a, d, left, right in zip(at, least, minima.left(at, least), minima.right(at, least)):
        lo, hi = a, a
        while values[lo] >= d:
            lo -= 1
        while hi + 1 < len(values) and values[hi + 1] >= d:
            hi += 1
        assert (left, right) == (lo, hi)

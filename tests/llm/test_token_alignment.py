from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.tables import documents, rows
from tidelake.llm import token_alignment
from tidelake.llm.queries import vocabulary

A, B = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")
HARD = ["a  b", " lead", "tail ", "  ", " ", "\n", "x y", "a b c", "́a ́b", "ﬁ ½",
        "a b▁c", "▁", "x▁", "<|endoftext|> and <s> </s> <unk> <0x41>", "日本語 テキスト", "=" * 300,
        "x" * 3000, "\U0001f600\U0001f601 ok", "tab\tend \t", "a\x00b c", "don't won't  I'm", "a" + " " * 40 + "b",
        "12345 67.89", "line\nline\n\nline", "\r\n mixed \r\n", "é è ê", "é combined"]


@pytest.fixture(scope="module")
def tools():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    letters = {c: n for n, c in enumerate(token_alignment._byte_letters())}
    spelt = {n: bytes(letters[c] for c in t) if all(c in letters for c in t) else t.encode()
             for t, n in a.get_vocab().items()}
    return a, b, spelt


def groups_of(text: str | None, tools) -> list[tuple[list[int], list[int]]]:
    """Groups of a whole text by walking both streams to the ends they share."""
    a, b, spelt = tools
    if not text:
        return []
    in_a, in_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    bytes_a = [spelt[i] for i in in_a]
    bytes_b = [token_alignment._piece_bytes(b.id_to_piece(i)) for i in in_b]
    if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
        return []
    ends_a = np.cumsum([len(x) for x in bytes_a]).tolist()
    ends_b = np.cumsum([len(x) for x in bytes_b]).tolist()
    after_a, after_b = ({e: n for n, e in enumerate(x, 1)} for x in (ends_a, ends_b))
    out, i, j = [], 0, 0
    for end in sorted(set(ends_a) & set(ends_b)):
        k, m = after_a[end], after_b[end]
        out.append((in_a[i:k], in_b[j:m]))
        i, j = k, m
    return out


def plain(table: list[tuple], tools) -> list[tuple]:
    every = [(key, groups_of(text, tools)) for key, text in table]
    count = Counter(p for _, gs in every for p in {(x, y) for g in gs for x in g[0] for y in g[1]})
    most: dict = {}
    for (x, _), n in count.items():
        most[x] = max(most.get(x, 0), n)
    out = []
    for key, gs in every:
        links = [(x, y) for g in gs for x in g[0] for y in g[1]]
        shown = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in gs)
        out.append((key, sum(len(x) for x, _ in gs), sum(len(y) for _, y in gs), len(gs), len(links),
                    sum(count[p] == most[p[0]] for p in links), sum(count[p] for p in links),
                    hashlib.sha256(shown.encode()).hexdigest() if gs else ""))
    return sorted(out, key=str)


@pytest.mark.parametrize("size", [1 << 26, 0])
def test_against_whole_texts(spark, tools, size):
    docs = documents(spark)
    more = [(1000 + n, t, *rows()[0][2:]) for n, t in enumerate(HARD)]
    docs = docs.union(spark.createDataFrame(more, docs.schema)).repartition(5)
    found = token_alignment.align(docs, A, B, broadcast_bytes=size)
    table = [(r[0], r[1]) for r in [*rows(), *more]]
    got = sorted((tuple(r) for r in found.collect()), key=str)
    for x, y in zip(got, plain(table, tools), strict=True):
        assert x == y
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                             "groups_sha256"]


def test_empty_table(spark):
    assert token_alignment.align(documents(spark, empty=True), A, B).collect() == []


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 3), max_size=40), st.randoms())
def test_cuts_are_the_shared_ends(lengths, draw):
    ends_a = np.cumsum(lengths).astype(np.int64)
    total = int(ends_a[-1]) if lengths else 0
    ends_b = np.array(sorted({*draw.sample(range(1, total + 1), draw.randint(0, total)), total})
                      if total else [], np.int64)
    in_a, in_b = token_alignment.shared_cuts(ends_a, ends_b)
    shared = sorted(set(ends_a.tolist()) & set(ends_b.tolist()))
    assert ends_a[in_a - 1].tolist() == shared == ends_b[in_b - 1].tolist()


def test_wide_groups_and_forgetting(tools, monkeypatch):
    monkeypatch.setattr(token_alignment, "WIDE", 1)
    monkeypatch.setattr(token_alignment, "KEPT_PIECES", 5)
    import pyarrow as pa

    draw = random.Random(4)
    words = ["incomprehensibilities", "naïveté", "Ωmega", "zzzz", "antidisestablishment", "日本語"]
    known = token_alignment.Pieces(A, B)
    for _ in range(4):
        texts = [" ".join(draw.choices(words, k=9)) for _ in range(20)] + ["only   once here"]
        for text, row in zip(texts, token_alignment.aligned(pa.array(texts), known), strict=True):
            links = Counter(x * known.width + y for g in groups_of(text, tools)
                            for x in g[0] for y in g[1])
            assert dict(zip(row[5].tolist(), row[6].tolist())) == links
        assert len(known.groups) <= 10

"""Language-model scores by deleted interpolation of word pairs, words and a uniform share.

    p(w | h) = l2(b) c(h w) / c(h) + l1(b) c(w) / N + l0(b) / (V + 1),   b = bucket of c(h)

Counts come from the training documents. The weights of each context-frequency bucket are learnt by
expectation maximisation on documents that were left out of the counts: a part of the training
documents, scored with the counts of the rest.

Nothing of the size of the vocabulary is ever in one place. Texts are cut into chunks of a few
megabytes. A chunk asks for the counts of its distinct words and pairs: it sends their hashes, sorted
and cut by range, to the tasks that own the ranges; each owner adds up what all chunks have counted
and answers every chunk in the order of its hashes. A word that is everywhere appears once in a
chunk's question, so no range is hot. Words are told apart by 64-bit hashes, pairs by 40 bits and
their range; among ten billion distinct words about three would share a hash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelake.llm.common import mixed, stored
from tidelake.session import shared_folder

CHUNK_BYTES = 8 << 20
RANGE_KEYS = 2_000_000  # hashes an owner holds, about
FOLD, HELD_OUT = 1, 0  # remainders: left out of the counts that weights are learnt on; of all
REST, OUT, LEFT = 0, 1, 2  # kinds of chunks: counted, fold, not learnt from
END = np.uint64(0x5851F42D4C957F2D)
START = np.uint64(0x14057B7EF767814F)
SMOOTH = 0.1
BUCKETS = 42  # 0: unseen context; n: seen 2**(n - 1) times or more
STEPS = 4  # ratios of probabilities are counted in steps of a quarter octave
LEVELS = 44 * STEPS  # ratios up to 2**44
PAIR_BYTES = 5
_BASE = np.uint64(0x9E3779B97F4A7C15)

CHUNK_FIELDS = ("chunk long, kind int, doc_ids array<long>, n_tokens array<long>, n long, "
                "n_keys long, words binary, tokens binary")


def _chunk(number: int, kind: int, docs: list[int | None], texts: list[pa.Array]) -> pa.RecordBatch:
    """Lower-case words and an end per text, as places in the chunk's sorted distinct hashes."""
    lowered = pc.ascii_lower(pa.concat_arrays(texts))  # A-Z only
    lists = pc.ascii_split_whitespace(lowered)
    flat = pc.list_flatten(lists)
    doc = np.repeat(np.arange(len(docs)), pc.list_value_length(lists).to_numpy())
    full = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    coded = flat.dictionary_encode()
    hashes = pd.util.hash_array(np.asarray(coded.dictionary.to_pylist(), dtype=object),
                                categorize=False).astype(np.uint64)
    size = np.bincount(doc[full], minlength=len(docs))
    at = coded.indices.to_numpy()[full].astype(np.int64)
    at = np.insert(at, np.cumsum(size), len(hashes))
    words, place = np.unique(np.append(hashes, END), return_inverse=True)
    tokens = place[at]
    pairs = _pairs(tokens, size + 1, len(words))[0]
    used = np.bincount(tokens, minlength=len(words)) > 0
    place = np.cumsum(used) - 1  # the empty piece at a text's edge is no word
    return pa.RecordBatch.from_arrays([
        pa.array([number]), pa.array([kind], pa.int32()), pa.array([docs], pa.list_(pa.int64())),
        pa.array([(size + 1).tolist()], pa.list_(pa.int64())), pa.array([len(tokens)]),
        pa.array([len(words) + len(pairs)]), pa.array([words[used].tobytes()], pa.binary()),
        pa.array([place[tokens].astype("<u4").tobytes()], pa.binary())],
        ["chunk", "kind", "doc_ids", "n_tokens", "n", "n_keys", "words", "tokens"])


def chunks(docs: DataFrame, key: str = "doc_id", text: str = "text",
           size: int = CHUNK_BYTES) -> DataFrame:
    """Documents in chunks of one kind each; a text longer than a chunk is a chunk of its own."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: dict[int, tuple[list, list, int]] = {k: ([], [], 0) for k in (REST, OUT, LEFT)}
        for batch in batches:
            kinds = batch.column("kind").to_numpy()
            for kind in (REST, OUT, LEFT):
                rows = np.flatnonzero(kinds == kind)
                texts = batch.column("text").take(pa.array(rows))
                names = batch.column("doc_id").take(pa.array(rows)).to_pylist()
                width = pc.binary_length(texts).to_numpy(zero_copy_only=False)
                start = 0
                while start < len(rows):
                    ids, parts, weight = held[kind]
                    room = np.cumsum(width[start:]) + weight
                    stop = start + int(np.searchsorted(room, size)) + 1
                    stop = min(stop, len(rows))
                    ids += names[start:stop]
                    parts.append(texts.slice(start, stop - start))
                    held[kind] = (ids, parts, int(room[stop - start - 1]))
                    if held[kind][2] >= size:
                        yield _chunk(number, kind, ids, parts)
                        number, held[kind] = number + 1, ([], [], 0)
                    start = stop
        for kind, (ids, parts, _) in held.items():
            if ids:
                yield _chunk(number, kind, ids, parts)
                number += 1

    name = F.coalesce(F.col(key).cast("string"), F.lit(""))
    remainder = F.crc32(name.cast("binary")) % 10
    kind = F.when(remainder == HELD_OUT, LEFT).when(remainder == FOLD, OUT).otherwise(REST)
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), kind.cast("int").alias("kind"),
                       F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(cut, CHUNK_FIELDS)


def _pairs(tokens: np.ndarray, size: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (word before, word) as one number, and which of them stands where.

    `width` stands for the start of a text.
    """
    before = np.empty(len(tokens), np.int64)
    before[1:] = tokens[:-1]
    before[np.cumsum(size) - size] = width
    return np.unique(before * width + tokens, return_inverse=True)


class Chunk:
    """The words and pairs of a stored chunk, and the order in which it asks for pairs."""

    def __init__(self, row: dict) -> None:
        self.size = np.asarray(row["n_tokens"], np.int64)
        self.words = np.frombuffer(row["words"], "<u8")
        self.width = len(self.words)
        self.tokens = np.frombuffer(row["tokens"], "<u4").astype(np.int64)
        self.pairs, self.at = _pairs(self.tokens, self.size, self.width)
        with np.errstate(over="ignore"):
            before = np.append(self.words, START)[self.pairs // self.width]
            self.keys = mixed(before * _BASE + self.words[self.pairs % self.width])
        self.order = np.argsort(self.keys, kind="stable")


def questions(table: DataFrame, ranges: int) -> DataFrame:
    """range, chunk, kind, keys, counts: hashes by their first bits, words and pairs apart."""
    shift = np.uint64(64 - int(math.log2(ranges)))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                chunk = Chunk(row)
                counted = (np.bincount(chunk.tokens, minlength=chunk.width),
                           np.bincount(chunk.at, minlength=len(chunk.keys))[chunk.order])
                for first, k, n, width in ((0, chunk.words, counted[0], 8),
                                           (ranges, chunk.keys[chunk.order], counted[1],
                                            PAIR_BYTES)):
                    owner = (k >> shift).astype(np.int64) if ranges > 1 else np.zeros(len(k), int)
                    cuts = np.searchsorted(owner, np.arange(ranges + 1))
                    # A pair tells the bits that follow those of its range.
                    told = k << np.uint64(64) - shift if ranges > 1 and width < 8 else k
                    raw = told.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :width]
                    asked = [(first + r, a, b) for r, (a, b) in enumerate(
                        zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)) if b > a]
                    tell = row["kind"] != LEFT
                    yield pa.RecordBatch.from_arrays([
                        pa.array([r for r, _, _ in asked], pa.int64()),
                        pa.array([row["chunk"]] * len(asked), pa.int64()),
                        pa.array([row["kind"]] * len(asked), pa.int32()),
                        pa.array([raw[a:b].tobytes() for _, a, b in asked], pa.binary()),
                        pa.array([n[a:b].astype("<u4").tobytes() if tell else b""
                                  for _, a, b in asked], pa.binary())],
                        ["range", "chunk", "kind", "keys", "counts"])

    return table.select("chunk", "kind", "n_tokens", "words", "tokens").mapInArrow(
        ask, "range long, chunk long, kind int, keys binary, counts binary")


def answers(asked: DataFrame, ranges: int) -> DataFrame:
    """range, chunk, kind, total, rest, distinct: counts in the order of the keys asked for.

    total counts all training documents, rest leaves out the fold and is told to the fold's chunks
    only; distinct is the number of trained words of the range, on one row of it.
    """
    def answer(group: pa.Table) -> pa.Table:
        width = PAIR_BYTES if group["range"][0].as_py() >= ranges else 8
        kinds, raw = group["kind"].to_pylist(), group["keys"].to_pylist()
        size = np.array([len(k) // width for k in raw])
        keys = np.zeros((int(size.sum()), 8), np.uint8)
        keys[:, 8 - width:] = np.frombuffer(b"".join(raw), np.uint8).reshape(-1, width)
        _, at = np.unique(keys.view(">u8").ravel(), return_inverse=True)
        counts = np.concatenate([
            np.frombuffer(c, "<u4") if k != LEFT else np.zeros(n, np.uint32)
            for c, k, n in zip(group["counts"].to_pylist(), kinds, size, strict=True)])
        fold = np.repeat(np.array(kinds) == OUT, size)
        total = np.bincount(at, counts).astype(np.int64)
        rest = total - np.bincount(at, np.where(fold, counts, 0)).astype(np.int64)
        ends = np.cumsum(size)
        spans = list(zip(ends - size, ends, kinds, strict=True))
        distinct = [0] * len(spans)
        distinct[0] = int((total > 0).sum()) if width == 8 else 0
        return pa.table({
            "range": group["range"], "chunk": group["chunk"], "kind": group["kind"],
            "total": pa.array([total[at[a:b]].astype("<u8").tobytes() for a, b, _ in spans],
                              pa.binary()),
            "rest": pa.array([rest[at[a:b]].astype("<u8").tobytes() if k == OUT else b""
                              for a, b, k in spans], pa.binary()),
            "distinct": pa.array(distinct, pa.int64())})

    return asked.groupBy("range").applyInArrow(
        answer, "range long, chunk long, kind int, total binary, rest binary, distinct long")


def _counts(told: pa.Table, column: str, ranges: int) -> tuple[np.ndarray, np.ndarray]:
    rows = sorted(zip(told["range"].to_pylist(), told[column].to_pylist(), strict=True))
    return tuple(np.frombuffer(b"".join(v for r, v in rows if (r >= ranges) == pair), "<u8").astype(
        np.float64) for pair in (False, True))


def _ratios(chunk: Chunk, words: np.ndarray, pairs: np.ndarray, n: float, v: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket, and pair and word probability over the uniform one, of every token.

    A text's start comes before as many words as there are texts, that is, ends.
    """
    asked = np.empty(len(pairs))
    asked[chunk.order] = pairs
    context = np.append(words, 0.0)
    context[chunk.width] = words[chunk.tokens[-1]]  # every chunk ends in an end
    h = context[chunk.pairs // chunk.width][chunk.at]
    bucket = np.where(h > 0, np.floor(np.log2(np.maximum(h, 1))) + 1, 0).astype(np.int64)
    two = np.where(h > 0, asked[chunk.at] / np.maximum(h, 1), 0) * (v + 1)
    one = words[chunk.tokens] / max(n, 1) * (v + 1)
    return np.minimum(bucket, BUCKETS - 1), two, one


def level(ratio: np.ndarray) -> np.ndarray:
    """0 for nothing, else the step of the ratio, from 2**-22 to 2**22 times the uniform share."""
    step = np.round(np.log2(np.maximum(ratio, 1e-30)) * STEPS) + LEVELS // 2
    return np.where(ratio > 0, np.clip(step, 1, LEVELS), 0).astype(np.int64)


def ratio_of(step: np.ndarray) -> np.ndarray:
    return np.where(step > 0, 2.0 ** ((step - LEVELS // 2) / STEPS), 0.0)


def learn_weights(bucket: np.ndarray, two: np.ndarray, one: np.ndarray, n: np.ndarray,
                  rounds: int = 100) -> np.ndarray:
    """Weights (bucket; pair, word, uniform) by EM on counts of the left-out tokens' ratios.

    Every bucket starts from the weights of all buckets together and counts them as a hundred
    tokens, so a bucket that the fold hardly reaches stays near them.
    """
    ratio = np.stack([ratio_of(two), ratio_of(one), np.ones(len(n))], axis=1)

    def run(where: np.ndarray, start: np.ndarray, prior: float) -> np.ndarray:
        weights = start
        for _ in range(rounds):
            share = ratio[where] * weights
            share *= (n[where] / share.sum(axis=1))[:, None]
            new = share.sum(axis=0) + prior * start
            weights = np.maximum(new / max(new.sum(), 1e-300), 1e-6)
            weights = weights / weights.sum()
        return weights

    shared = np.array([0.5, 0.4, 0.1])
    if len(n):
        shared = run(np.ones(len(n), bool), shared, 1.0)
    out = np.tile(shared, (BUCKETS, 1))
    for b in np.unique(bucket):
        out[b] = run(bucket == b, shared, 100.0)
    out[0] = [0, *out[0, 1:] / out[0, 1:].sum()]  # an unseen context says nothing
    return out


def score(docs: DataFrame, key: str = "doc_id", text: str = "text", folder: str | None = None,
          chunk_bytes: int = CHUNK_BYTES, range_keys: int = RANGE_KEYS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score per row.

    Documents are split by the checksum of their key as text; a null key counts as an empty one.
    Null and empty texts have their end alone. Rows that repeat are counted and scored as often. A
    table without training documents gives every token the uniform share, and without left-out
    documents the weights are those EM starts from.
    """
    folder = folder or shared_folder(docs.sparkSession)
    table = stored(chunks(docs, key, text, chunk_bytes), "chunks", folder)
    sizes = table.agg(F.sum(F.when(F.col("kind") != LEFT, F.col("n"))).alias("n"),
                      F.sum(F.when(F.col("kind") == REST, F.col("n"))).alias("rest"),
                      F.sum("n_keys").alias("keys")).first()
    n, rest = float(sizes["n"] or 0), float(sizes["rest"] or 0)
    ranges = 1 << max(0, math.ceil(math.log2(max(1, (sizes["keys"] or 1) / range_keys))))
    told = stored(answers(questions(table, ranges), ranges), "answers", folder)
    v = float(told.agg(F.sum("distinct")).first()[0] or 0)

    def prepared(left: pa.Table, right: pa.Table, column: str, total: float) -> tuple:
        row = left.to_pylist()[0]
        chunk = Chunk(row)
        words, pairs = _counts(right, column, ranges)
        return row, chunk, words, _ratios(chunk, words, pairs, total, v)

    def seen(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left):
            return pa.table({c: pa.array([], pa.int64()) for c in ("b", "two", "one", "n")})
        _, _, _, (bucket, two, one) = prepared(left, right, "rest", rest)
        cell = (bucket * (LEVELS + 1) + level(two)) * (LEVELS + 1) + level(one)
        cell, count = np.unique(cell, return_counts=True)
        return pa.table({"b": cell // (LEVELS + 1) ** 2, "two": cell // (LEVELS + 1) % (LEVELS + 1),
                         "one": cell % (LEVELS + 1), "n": count})

    asked = table.select("chunk", "kind", "doc_ids", "n_tokens", "words", "tokens")
    fold = asked.where(F.col("kind") == OUT).groupBy("chunk").cogroup(
        told.where(F.col("kind") == OUT).groupBy("chunk"))
    # At most BUCKETS * (LEVELS + 1)**2 rows; what occurs is far less.
    cells = fold.applyInArrow(seen, "b long, two long, one long, n long").groupBy(
        "b", "two", "one").agg(F.sum("n").alias("n")).orderBy("b", "two", "one").toPandas()
    weights = learn_weights(*(cells[c].to_numpy() for c in ("b", "two", "one", "n")))
    if not n:
        weights[:] = [0, 0, 1]

    def scored(left: pa.Table, right: pa.Table) -> pa.Table:
        row, chunk, words, (bucket, two, one) = prepared(left, right, "total", n)
        w = weights[bucket]
        p = (w[:, 0] * two + w[:, 1] * one + w[:, 2]) / (v + 1)
        count = words[chunk.tokens]
        base = np.log10((count + SMOOTH) / (n + SMOOTH * (v + 1)))
        start = np.cumsum(chunk.size) - chunk.size
        return pa.table({
            "doc_id": pa.array(row["doc_ids"], pa.int64()),
            "held_out": pa.array([row["kind"] == LEFT] * len(start)),
            "n_tokens": pa.array(chunk.size),
            "n_known": pa.array(np.add.reduceat((count > 0).astype(np.int64), start)),
            "base_score": pa.array(np.add.reduceat(base, start)),
            "score": pa.array(np.add.reduceat(np.log10(p), start))})

    out = asked.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(
        scored, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, "
        "score double")
    return out.select("doc_id", "held_out", "n_tokens", "n_known",
                      F.lit(int(n)).cast("long").alias("train_tokens"), "base_score", "score")

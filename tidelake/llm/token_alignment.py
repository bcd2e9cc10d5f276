"""Links between the tokens of two tokenizers, and how often the corpus makes each.

Both token streams of a text spell the same bytes. Divide and conquer finds the groups: an interval of
tokens is split at an end that both streams share, the nearest to its middle, found by bisection; both
halves are split again, and an interval without a shared end inside is a group. All intervals of one
depth are split together in numpy.

Neither tokenizer has a token that reaches from one visible character over a lone space to the next, so
the ends of such pieces are shared and every distinct piece is encoded and split once. A first pass
writes each document's figures and its distinct linked pairs; pairs are counted by document in Spark,
after each task has added up its own; a second pass sums the counts over each document's links.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelake.llm.common import stored
from tidelake.session import shared_folder
from tidelake.sizing import BROADCAST_BYTES

_SPACE = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
_UNEVEN = rf"^{_SPACE}|{_SPACE}{{2}}|{_SPACE}\z"
_LONE_SPACE = re.compile(r"(?<=\S) (?=\S)")
KEPT_PIECES = 300_000
KEPT_LENGTH = 32
TEXT_BYTES = 1 << 20  # of texts that are worked on at a time
PAIRS_KEPT = 1 << 20  # counted in a task before they are passed on
WIDE = 1 << 12  # links of a group from which equal ids are counted before they are paired


def shared_cuts(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many tokens of either stream lie before the end of each group, ascending.

    Both streams end at the same byte. Every token has at least one byte.
    """
    cuts = []
    lo = np.zeros(min(1, len(ends_a)), np.int64)  # intervals of a's tokens, [lo, hi)
    hi = np.full(len(lo), len(ends_a), np.int64)
    while len(lo):
        begin = np.where(lo > 0, ends_a[lo - 1], 0)
        middle = (begin + ends_a[hi - 1]) // 2
        near = np.clip(np.searchsorted(ends_a, middle), lo, np.maximum(hi - 2, lo))
        cut = np.full(len(lo), -1, np.int64)
        open_, step = np.flatnonzero(hi - lo > 1), 0
        while len(open_):
            for at in (near[open_] - step, near[open_] + step):
                inside = (at >= lo[open_]) & (at < hi[open_] - 1)
                byte = ends_a[np.where(inside, at, 0)]
                meets = inside & (ends_b[np.searchsorted(ends_b, byte)] == byte)
                cut[open_[meets]] = at[meets] + 1
            step += 1
            left = (near[open_] - step >= lo[open_]) | (near[open_] + step < hi[open_] - 1)
            open_ = open_[left & (cut[open_] < 0)]
        whole = cut < 0
        cuts.append(hi[whole])
        lo, cut, hi = lo[~whole], cut[~whole], hi[~whole]
        lo, hi = np.concatenate([lo, cut]), np.concatenate([cut, hi])
    in_a = np.sort(np.concatenate(cuts)) if cuts else np.zeros(0, np.int64)
    return in_a, np.searchsorted(ends_b, ends_a[in_a - 1]) + 1


def _spread(counts: np.ndarray) -> np.ndarray:
    """0, 1, .., n - 1 for every n, one after the other."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)


class Pieces:
    """Groups and links of pieces of text, each worked out once; short ones are remembered."""

    def __init__(self, path_a: str, path_b: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task on every core
        import sentencepiece
        from tokenizers import Tokenizer

        self._a = Tokenizer.from_file(path_a)
        self._a.encode_special_tokens = True  # their strings are plain text
        self._b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        letters = {c: n for n, c in enumerate(_byte_letters())}
        vocabulary = self._a.get_vocab()
        self._bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, n in vocabulary.items():
            known = all(c in letters for c in token)
            self._bytes_a[n] = bytes(letters[c] for c in token) if known else token.encode()
        self._bytes_b = [_piece_bytes(self._b.id_to_piece(n))
                         for n in range(self._b.get_piece_size())]
        self.width = len(self._bytes_b)
        self._long_a = np.array([len(b) for b in self._bytes_a], np.int64)
        self._long_b = np.array([len(b) for b in self._bytes_b], np.int64)
        self._known: dict[str, int] = {}
        # Per piece: tokens of a and b, groups, links; -1 tokens if the bytes differ.
        self._figures = array("q")
        self.groups: list[str] = []
        self._starts = array("q", [0])  # of a piece's pairs
        self._pairs = array("q")
        self._times = array("q")

    # Views; none may be held when pieces are added.
    @property
    def figures(self) -> np.ndarray:
        return np.frombuffer(self._figures, np.int64).reshape(-1, 4)

    @property
    def starts(self) -> np.ndarray:
        return np.frombuffer(self._starts, np.int64)

    @property
    def pairs(self) -> np.ndarray:
        return np.frombuffer(self._pairs, np.int64)

    @property
    def times(self) -> np.ndarray:
        return np.frombuffer(self._times, np.int64)

    def _append(self, figures: np.ndarray, counts: np.ndarray, pairs: np.ndarray,
                times: np.ndarray) -> None:
        ends = self._starts[-1] + np.cumsum(counts)
        for held, new in ((self._figures, figures), (self._starts, ends), (self._pairs, pairs),
                          (self._times, times)):
            held.frombytes(np.ascontiguousarray(new, np.int64).tobytes())

    def rows(self, texts: list[str]) -> np.ndarray:
        """Numbers of distinct pieces; those that `forget` drops hold until then."""
        found = list(map(self._known.get, texts))
        new = [n for n, row in enumerate(found) if row is None]
        if new:
            first = len(self.groups)
            self._add([texts[n] for n in new])
            room = len(self._known) < KEPT_PIECES
            kept = [n for n in new if room and len(texts[n]) <= KEPT_LENGTH]
            for row, n in enumerate(new, first):
                found[n] = row
            self._new = (first, [found[n] - first for n in kept])
            self._names = [texts[n] for n in kept]
        else:
            self._new, self._names = (len(self.groups), []), []
        return np.array(found, np.int64)

    def forget(self) -> None:
        """Keep of the newest pieces only those that are worth it."""
        first, kept = self._new
        index = np.array(kept, np.int64) + first
        begin = self.starts[index]
        spans = self.starts[index + 1] - begin
        take = np.repeat(begin, spans) + _spread(spans)
        figures, pairs, times = self.figures[index], self.pairs[take], self.times[take]
        self.groups[first:] = [self.groups[n] for n in index.tolist()]
        end = self._starts[first]
        del self._figures[4 * first:], self._starts[first + 1:], self._pairs[end:], self._times[end:]
        self._append(figures, spans, pairs, times)
        self._known.update((name, first + n) for n, name in enumerate(self._names))
        self._new, self._names = (len(self.groups), []), []

    def _add(self, texts: list[str]) -> None:
        in_a = [e.ids for e in self._a.encode_batch_fast(
            [" " + t for t in texts], add_special_tokens=False)]
        in_b = self._b.encode(texts, num_threads=1)
        figures = np.full((len(texts), 4), -1, np.int64)
        named = [""] * len(texts)
        right = []
        said_a, said_b = self._bytes_a.__getitem__, self._bytes_b.__getitem__
        for n, text in enumerate(texts):
            said = b" " + text.encode()
            if b"".join(map(said_a, in_a[n])) == said == b"".join(map(said_b, in_b[n])):
                right.append(n)
        a = np.fromiter((i for n in right for i in in_a[n]), np.int64)
        b = np.fromiter((i for n in right for i in in_b[n]), np.int64)
        cut_a, cut_b = shared_cuts(np.cumsum(self._long_a[a]), np.cumsum(self._long_b[b]))
        many_a, many_b = np.diff(cut_a, prepend=0), np.diff(cut_b, prepend=0)
        # The end of a piece is the end of a group.
        ends = np.cumsum([len(in_a[n]) for n in right]).astype(np.int64)
        piece = np.searchsorted(ends, cut_a)
        numbers = np.bincount(piece, minlength=len(right))
        links = np.zeros(len(right), np.int64)
        np.add.at(links, piece, many_a * many_b)
        figures[right] = np.stack([
            [len(in_a[n]) for n in right], [len(in_b[n]) for n in right], numbers, links],
            axis=1).reshape(-1, 4) if right else np.zeros((0, 4))
        at_a = at_b = 0
        shown_a, shown_b = list(map(str, a.tolist())), list(map(str, b.tolist()))
        shown: list[list[str]] = [[] for _ in right]
        for n, i, j in zip(piece.tolist(), cut_a.tolist(), cut_b.tolist(), strict=True):
            shown[n].append(f"{','.join(shown_a[at_a:i])}|{','.join(shown_b[at_b:j])}")
            at_a, at_b = i, j
        for n, parts in zip(right, shown, strict=True):
            named[n] = ";".join(parts)
        owner, pair, times = self._linked(a, b, cut_a, cut_b, many_a, many_b, piece)
        counts = np.zeros(len(texts), np.int64)
        counts[right] = np.bincount(owner, minlength=len(right))
        self.groups += named
        self._append(figures, counts, pair, times)

    def _linked(self, a, b, cut_a, cut_b, many_a, many_b, piece) -> tuple[np.ndarray, ...]:
        """Piece, pair and number of links for every distinct pair of a piece, in that order."""
        links = many_a * many_b
        plain = links <= WIDE
        size = np.where(plain, links, 0)
        group = np.repeat(np.arange(len(links)), size)
        nth = _spread(size)
        first = a[(cut_a - many_a)[group] + nth // np.maximum(many_b, 1)[group]]
        second = b[(cut_b - many_b)[group] + nth % np.maximum(many_b, 1)[group]]
        owners, pairs, times = [piece[group]], [first * self.width + second], [np.ones(len(group), np.int64)]
        for g in np.flatnonzero(~plain).tolist():
            x, n_x = np.unique(a[cut_a[g] - many_a[g]:cut_a[g]], return_counts=True)
            y, n_y = np.unique(b[cut_b[g] - many_b[g]:cut_b[g]], return_counts=True)
            pairs.append((x[:, None] * self.width + y).ravel())
            times.append((n_x[:, None] * n_y).ravel())
            owners.append(np.full(len(pairs[-1]), piece[g]))
        return _summed(np.concatenate(owners), np.concatenate(pairs), np.concatenate(times))


def _summed(owner: np.ndarray, pair: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, ...]:
    """Equal owner and pair once, sorted, with the sum of times."""
    if not len(owner):
        return owner, pair, times
    width = int(pair.max()) + 1
    if int(owner.max()) < (1 << 62) // width:  # both in one number
        both = owner.astype(np.int64) * width + pair
        order = np.argsort(both)
        both, times = both[order], times[order]
        new = np.concatenate([[True], both[1:] != both[:-1]])
        owner, pair = np.divmod(both[new], width)
    else:
        order = np.lexsort((pair, owner))
        owner, pair, times = owner[order], pair[order], times[order]
        new = np.concatenate([[True], (owner[1:] != owner[:-1]) | (pair[1:] != pair[:-1])])
        owner, pair = owner[new], pair[new]
    return owner, pair, np.add.reduceat(times, np.flatnonzero(new))


def _byte_letters() -> list[str]:
    """The visible character that stands for each byte in a byte-level vocabulary: printable Latin-1
    characters stand for themselves, the others are numbered from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [n for n in range(256) if n not in shown]
    return [chr(n if n in shown else 256 + hidden.index(n)) for n in range(256)]


def _piece_bytes(piece: str) -> bytes:
    if re.fullmatch(r"<0x[0-9A-F]{2}>", piece):
        return bytes([int(piece[3:5], 16)])
    return piece.replace("▁", " ").encode()


_PIECES: dict[tuple[str, str], Pieces] = {}


def _pieces(path_a: str, path_b: str) -> Pieces:
    """The process's pieces for two vocabulary files."""
    if (path_a, path_b) not in _PIECES:
        _PIECES[path_a, path_b] = Pieces(path_a, path_b)
    return _PIECES[path_a, path_b]


_WRITTEN = ("row long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
            "pairs binary, times binary")


def aligned(texts: pa.Array, known: Pieces) -> Iterator[tuple]:
    """n_a, n_b, n_groups, n_links, groups_sha256, pairs (ascending), times of every text."""
    parts = pc.split_pattern(texts, " ")
    uneven = pc.match_substring_regex(texts, _UNEVEN).to_numpy(zero_copy_only=False)
    if uneven.any():
        lists = parts.to_pylist()
        for n in np.flatnonzero(uneven):
            lists[n] = _LONE_SPACE.split(texts[n].as_py())
        parts = pa.array(lists, type=pa.list_(pa.string()))
    coded = pc.list_flatten(parts).dictionary_encode()
    rows = known.rows(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
    lengths = pc.list_value_length(parts).to_numpy().astype(np.int64)
    starts = np.concatenate([[0], np.cumsum(lengths)])
    empty = pc.equal(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    figures = known.figures[rows]
    wrong = np.logical_or.reduceat(figures[:, 0] < 0, starts[:-1]) | empty
    sums = np.add.reduceat(figures, starts[:-1], axis=0)
    # Equal pieces of a text once, then their pairs.
    text = np.repeat(np.arange(len(texts)), lengths)
    kept = ~wrong[text]
    text, piece, many = _summed(text[kept], rows[kept], np.ones(int(kept.sum()), np.int64))
    spans = known.starts[piece + 1] - known.starts[piece]
    take = np.repeat(known.starts[piece], spans) + _spread(spans)
    owner, pair, times = _summed(np.repeat(text, spans), known.pairs[take],
                                 known.times[take] * np.repeat(many, spans))
    bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
    shown_as, listed = known.groups.__getitem__, rows.tolist()
    for n in range(len(texts)):
        if wrong[n]:
            yield 0, 0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int64)
            continue
        shown = ";".join(map(shown_as, listed[starts[n]:starts[n + 1]]))
        yield (*sums[n].tolist(), hashlib.sha256(shown.encode()).hexdigest(),
               pair[bounds[n]:bounds[n + 1]], times[bounds[n]:bounds[n + 1]])
    known.forget()


def _slices(texts: pa.Array) -> Iterator[pa.Array]:
    """Stretches of about TEXT_BYTES of texts, a longer text alone."""
    total = np.cumsum(pc.binary_length(texts).to_numpy().astype(np.int64))
    at = 0
    while at < len(texts):
        before = total[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(total, before + TEXT_BYTES, "right")))
        yield texts.slice(at, end - at)
        at = end


def _written(path_a: str, path_b: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _pieces(path_a, path_b)
        for batch in batches:
            texts, at = pc.fill_null(batch.column("text").cast(pa.string()), ""), 0
            for part in _slices(texts):
                found = list(aligned(part, known))
                named = {c: batch.column(c).slice(at, len(part)) for c in ("keys", "row")}
                for k, name in enumerate(("n_a", "n_b", "n_groups", "n_links")):
                    named[name] = pa.array([f[k] for f in found], pa.int64())
                named["groups_sha256"] = pa.array([f[4] for f in found], pa.string())
                # Differences compress well; times are small.
                named["pairs"] = pa.array(
                    [np.diff(f[5], prepend=0).tobytes() for f in found], pa.binary())
                named["times"] = pa.array([f[6].astype(np.uint32).tobytes() for f in found], pa.binary())
                at += len(part)
                yield pa.RecordBatch.from_pydict(named)
    return write


def _pairs_of(cell: pa.Scalar) -> np.ndarray:
    return np.cumsum(np.frombuffer(cell.as_py(), np.int64))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """pair, n: a task's documents per pair, added up before they leave it."""
    pairs, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    waiting: list[np.ndarray] = []
    size = 0

    def merged() -> tuple[np.ndarray, np.ndarray]:
        every = np.concatenate([pairs, *waiting])
        _, p, n = _summed(np.zeros(len(every), np.int8), every, np.concatenate(
            [counts, np.ones(len(every) - len(pairs), np.int64)]))
        return p, n

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"pair": pa.array(pairs), "n": pa.array(counts)})

    for batch in batches:
        for cell in batch.column("pairs"):
            waiting.append(_pairs_of(cell))
            size += len(waiting[-1])
            if size > PAIRS_KEPT:
                (pairs, counts), waiting, size = merged(), [], 0
                if len(pairs) > PAIRS_KEPT:
                    yield out()
                    pairs, counts = pairs[:0], counts[:0]
    pairs, counts = merged()
    if len(pairs):
        yield out()


def _vocabulary_size(path_b: str) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()


def _by_lookup(found: DataFrame, counts: DataFrame) -> DataFrame:
    """Sums over each document's links with the counts in every task, sorted by pair."""
    table = counts.toArrow().sort_by("pair")  # measured by the caller
    known = found.sparkSession.sparkContext.broadcast(tuple(
        table.column(c).to_numpy() for c in ("pair", "n", "best")))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, n, best = known.value
        for batch in batches:
            out = []
            for cell, often in zip(batch.column("pairs"), batch.column("times"), strict=True):
                at = np.searchsorted(pairs, _pairs_of(cell))
                times = np.frombuffer(often.as_py(), np.uint32).astype(np.int64)
                out.append((int(times[best[at]].sum()), int((times * n[at]).sum())))
            kept = batch.drop_columns(["pairs", "times"])
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array([o[0] for o in out], pa.int64()),
                 pa.array([o[1] for o in out], pa.int64())],
                [*kept.schema.names, "n_best", "count_sum"])

    kinds = T.StructType([*found.drop("pairs", "times").schema.fields,
                          *T.StructType.fromDDL("n_best long, count_sum long").fields])
    return found.mapInArrow(sums, kinds)


def _by_join(found: DataFrame, counts: DataFrame) -> DataFrame:
    """The same sums by a join on pairs: one row per document and distinct pair."""
    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, cell, often in zip(*[batch.column(c) for c in ("row", "pairs", "times")],
                                        strict=True):
                pairs = _pairs_of(cell)
                yield pa.RecordBatch.from_pydict({
                    "row": pa.array(np.full(len(pairs), row.as_py())), "pair": pa.array(pairs),
                    "times": pa.array(np.frombuffer(often.as_py(), np.uint32).astype(np.int64))})

    links = found.select("row", "pairs", "times").mapInArrow(
        listed, "row long, pair long, times long")
    sums = links.join(counts, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    none = F.lit(0).cast("long")
    return found.join(sums, "row", "left").withColumns({
        c: F.coalesce(F.col(c), none) for c in ("n_best", "count_sum")})


def align(docs: DataFrame, path_a: str, path_b: str, text: str = "text",
          keep: tuple[str, ...] = ("doc_id",), broadcast_bytes: int = BROADCAST_BYTES,
          folder: str | None = None) -> DataFrame:
    """Figures of every document's alignment, one row per row of docs, in no order.

    Columns: keep, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256. Tokenizer a is a
    byte-level one (tokenizers) and gets a space and the text; b is a sentencepiece model, which adds
    the space. A text that is null or empty, or that either tokenizer doesn't spell byte for byte, has
    no tokens: zeros and an empty string. Groups end where tokens of both end. A link is a pair of
    tokens of one group; a pair of ids is counted once for each row that links it, so rows that repeat
    count each. n_best counts the links whose pair is the commonest of its a id (ties included),
    count_sum adds up their pairs' counts. Very long texts are worked on alone, in memory in
    proportion to their tokens. Columns not kept are ignored; an empty table gives an empty result.

    The counts of pairs go to every task if their measured size allows it, else a document's pairs
    are joined with them.
    """
    folder = folder or shared_folder(docs.sparkSession)
    rows = docs.select(F.struct(*[F.col(k) for k in keep]).alias("keys"),
                       F.monotonically_increasing_id().alias("row"), F.col(text).alias("text"))
    kinds = T.StructType([rows.schema["keys"], *T.StructType.fromDDL(_WRITTEN).fields])
    found = stored(rows.mapInArrow(_written(path_a, path_b), kinds), "aligned", folder)
    counts = found.select("pairs").mapInArrow(_counted, "pair long, n long").groupBy("pair").agg(
        F.sum("n").alias("n"))
    width = _vocabulary_size(path_b)
    counts = stored(counts.withColumn("a", F.floor(F.col("pair") / width).cast("long")),
                    "counts", folder)
    best = counts.groupBy("a").agg(F.max("n").alias("most"))  # at most a row per id of a
    counts = counts.join(F.broadcast(best), "a").select(
        "pair", "n", (F.col("n") == F.col("most")).alias("best"))
    if counts.count() * 17 <= broadcast_bytes:
        summed = _by_lookup(found, counts)
    else:
        summed = _by_join(found, counts)
    return summed.select(*[F.col("keys").getField(k).alias(k) for k in keep], "n_a", "n_b", "n_groups",
                         "n_links", "n_best", "count_sum", "groups_sha256")

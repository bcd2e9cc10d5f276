"""Token ids of whole texts with a public byte-pair tokenizer, inside Spark tasks.

No token of the vocabularies used here reaches from one word over a lone space into the next. A text
is therefore cut before every space that stands between two visible characters, every *distinct*
piece of a batch is encoded once, and the ids are put together again. This gives the ids of the
whole text for a fraction of the work; tests/llm/test_tokens.py holds it against whole texts.
"""

from __future__ import annotations

import gc
import itertools
import os
import re
import string
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Two neighbouring white-space characters in any script; the text is then cut by _LONE_SPACE.
_UNEVEN = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]{2}"
_LONE_SPACE = re.compile(r"(?<=\S) (?=\S)")
CACHED_PIECES = 900_000
CACHED_LENGTH = 32
# Signs that form one unit with each other and none with the letters before them. An apostrophe does.
SIGNS = string.punctuation.replace("'", "")
CACHED_WORDS = 400_000
CACHED_TAILS = 10_000


def _cut(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All pieces in order, and where each text's pieces start; every text has at least one."""
    parts = pc.split_pattern(texts, " ")
    uneven = pc.match_substring_regex(texts, _UNEVEN).to_numpy(zero_copy_only=False)
    if uneven.any():
        lists = parts.to_pylist()
        for n in np.flatnonzero(uneven):
            lists[n] = _LONE_SPACE.split(texts[n].as_py())
        parts = pa.array(lists, type=pa.list_(pa.string()))
    return pc.list_flatten(parts), np.concatenate(
        [[0], np.cumsum(pc.list_value_length(parts).to_numpy())]).astype(np.int64)


def _letters() -> list[str]:
    """The visible character that stands for each byte in a byte-level vocabulary: printable Latin-1
    characters stand for themselves, the others are numbered from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [n for n in range(256) if n not in shown]
    return [chr(n if n in shown else 256 + hidden.index(n)) for n in range(256)]


class PieceEncoder:
    """Encodes texts piece by piece and remembers short pieces, up to a fixed number.

    A word of letters alone is one unit of the vocabulary's pattern, and the signs after it are
    another: a new word's ids come from the tokenizer's model at once; words and signs are remembered
    too, within limits. All other pieces go through the whole tokenizer.
    """

    def __init__(self, path: str, pieces: int | None = None) -> None:
        self._pieces = pieces  # to remember, in place of CACHED_PIECES
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task on every core
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._model = self._tokenizer.model
        self._normal = self._tokenizer.normalizer
        self._lower = self._normal is not None and self._normal.normalize_str("A") == "a"
        spaced = self._tokenizer.encode(" a", add_special_tokens=False).tokens[0]
        self._space = spaced[:1] if spaced.startswith("Ġ") else ""
        self._letters = _letters()
        self._known: dict[str, int] = {}
        self._ids = array("I")  # ids of all known pieces, one after the other
        self._ends = array("q", [0])  # of piece n: from place n to place n + 1
        self._break = self._plain(["\n"])[0]
        self._words: dict[str, dict[str, list[int]]] = {self._space: {}, "": {}}
        self._tails: dict[str, list[int]] = {}

    def _plain(self, texts: list[str]) -> list[list[int]]:
        found = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [e.ids for e in found]

    def _word(self, word: str, space: str) -> list[int] | None:
        """Ids of a word, with `space` for what is before it, or None if it isn't letters alone."""
        if self._lower and word.isascii():
            word = word.lower()
        known = self._words[space]
        ids = known.get(word)
        if ids is None and word.isalpha():
            ids = self._unit(word, space)
            if ids and len(known) < CACHED_WORDS and len(word) <= CACHED_LENGTH:
                known[word] = ids
        return ids

    def _unit(self, word: str, space: str) -> list[int] | None:
        """Ids of letters that are one unit, or None if they are not when normalised."""
        unit = word
        if not word.isascii():
            unit = self._normal.normalize_str(word) if self._normal else word
            if not unit.isalpha():
                return None
            unit = "".join([self._letters[b] for b in unit.encode()])
        return [t.id for t in self._model.tokenize(space + unit)]

    def _signed(self, piece: str, space: str) -> list[int] | None:
        """Ids of a word of letters with signs after it, or None if it is something else."""
        word = piece.rstrip(SIGNS)
        ids = self._word(word, space)
        if ids is None or len(word) == len(piece):
            return ids
        tail = piece[len(word):]
        more = self._tails.get(tail)
        if more is None:
            more = self._plain([tail])[0]
            if len(self._tails) < CACHED_TAILS and len(tail) <= CACHED_LENGTH:
                self._tails[tail] = more
        return ids + more

    def _lines(self, piece: str) -> list[int] | None:
        """Ids of such words on lines of their own; a lone line break is a unit by itself."""
        out: list[int] = []
        for n, line in enumerate(piece.split("\n")):
            ids = self._signed(line, "" if n else self._space)
            if ids is None:
                return None
            out += self._break + ids if n else ids
        return out

    def _add(self, pieces: list[str]) -> range:
        """Append the ids of new pieces, each with the space before it; their numbers."""
        first, others, found = len(self._ends) - 1, [], []
        for p in pieces:
            ids = self._lines(p) if "\n" in p else self._signed(p, self._space)
            if ids is None:
                others.append(p)
            found.append(ids)
        whole = iter(self._plain([" " + p for p in others]))
        for ids in found:
            self._ids.extend(next(whole) if ids is None else ids)
            self._ends.append(len(self._ids))
        return range(first, len(self._ends) - 1)

    def _look_up(self, texts: list[str]) -> np.ndarray:
        """Numbers of distinct pieces. Those beyond the limit are forgotten by `_forget`."""
        rows = list(map(self._known.get, texts))
        new = [n for n, row in enumerate(rows) if row is None]
        for n, row in zip(new, self._add([texts[n] for n in new]), strict=True):
            rows[n] = row
        room = (CACHED_PIECES if self._pieces is None else self._pieces) - len(self._known)
        if room > 0:
            short = ((texts[n], rows[n]) for n in new if len(texts[n]) <= CACHED_LENGTH)
            self._known.update(itertools.islice(short, room))
            self._keep = len(self._ends)
        return np.fromiter(rows, np.int64, len(rows))

    def _forget(self) -> None:
        del self._ends[self._keep:]
        del self._ids[self._ends[-1]:]

    def encode(self, texts: pa.Array, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in order, and where each text's ids start. Nulls have none.

        With end_id, that id follows the ids of each text.
        """
        if len(texts) == 0:
            return np.empty(0, "<u4"), np.zeros(1, np.int64)
        collecting = gc.isenabled()
        gc.disable()  # millions of short-lived objects and no cycles among them
        try:
            return self._encode(texts, end_id)
        finally:
            if collecting:
                gc.enable()

    def _encode(self, texts: pa.Array, end_id: int | None) -> tuple[np.ndarray, np.ndarray]:
        flat, starts = _cut(pc.fill_null(texts.cast(pa.string()), ""))
        coded = flat.dictionary_encode()
        heads = flat.take(pa.array(starts[:-1])).dictionary_encode()
        rows = self._look_up(coded.dictionary.to_pylist())
        rest = len(self._ends) - 1
        last = [] if end_id is None else [[end_id]]
        for ids in self._plain(heads.dictionary.to_pylist()) + last:  # no space before these
            self._ids.extend(ids)
            self._ends.append(len(self._ids))
        row = rows[coded.indices.to_numpy()]
        row[starts[:-1]] = heads.indices.to_numpy() + rest
        if last:
            row = np.insert(row, starts[1:], len(self._ends) - 2)
            starts = starts + np.arange(len(starts))
        ends = np.frombuffer(self._ends, np.int64)
        pool = np.frombuffer(self._ids, np.uint32)
        length = np.diff(ends)[row]
        after = np.cumsum(length)
        kind = np.int32 if max(len(pool), after[-1]) < 1 << 31 else np.int64
        source = np.repeat((ends[row] - (after - length)).astype(kind), length)
        source += np.arange(len(source), dtype=kind)
        out = pool[source].astype("<u4", copy=False)
        del ends, pool  # the arrays below them are about to shrink
        self._forget()
        return out, np.append(0, after)[starts]


_ENCODERS: dict[tuple[str, int | None], PieceEncoder] = {}


def encoder(path: str, pieces: int | None = None) -> PieceEncoder:
    """The process's encoder for a vocabulary file, remembering up to so many pieces."""
    if (path, pieces) not in _ENCODERS:
        _ENCODERS[path, pieces] = PieceEncoder(path, pieces)
    return _ENCODERS[path, pieces]

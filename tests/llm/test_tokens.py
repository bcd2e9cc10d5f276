"""Ids put together from pieces are the ids of the whole text."""

from __future__ import annotations

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.tables import rows
from tidelake.llm.queries import vocabulary
from tidelake.llm.tokens import PieceEncoder, encoder

FILES = ("byte_bpe_50k.json", "word_bpe_49k.json")
BITS = st.lists(st.sampled_from([
    " ", "  ", "\n", "\t", "a", "it's", "é", "<|endoftext|>", "\x1c", "x1", " '", "́", "ΑΣ", "!",
    "İ a", ",", ".", "ab, ", " ", "\x85", "ſ", "１", "\U0001f600", "Word", "don't", "end.\nThe", "$$$", "_"]), max_size=25)


def whole(path: str, texts: list[str]) -> list[list[int]]:
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)
    return [e.ids for e in found]


def split(ids, starts) -> list[list[int]]:
    return [ids[a:b].tolist() for a, b in zip(starts[:-1], starts[1:], strict=True)]


@pytest.mark.parametrize("name", FILES)
@settings(max_examples=60, deadline=None)
@given(texts=st.lists(st.one_of(BITS.map("".join), st.text(max_size=30)), min_size=1, max_size=20))
def test_pieces_give_whole_texts(name, texts):
    path = vocabulary(name)
    assert split(*encoder(path).encode(pa.array(texts))) == whole(path, texts)


@pytest.mark.parametrize("name", FILES)
def test_nulls_ends_and_a_full_cache(name, monkeypatch):
    monkeypatch.setattr("tidelake.llm.tokens.CACHED_PIECES", 5)
    path, texts = vocabulary(name), [r[1] for r in rows()]
    coder = PieceEncoder(path)
    for _ in range(2):
        found = split(*coder.encode(pa.array(texts, pa.string()), end_id=2))
        assert found == [i + [2] for i in whole(path, [t or "" for t in texts])]
    assert coder.encode(pa.array([], pa.string()))[0].tolist() == []


def test_an_encoder_remembers_no_more_pieces_than_it_is_given():
    texts = [" ".join(f"word{n} x{n}," for n in range(40))] * 2
    path = vocabulary(FILES[1])
    small = PieceEncoder(path, 10)
    assert split(*small.encode(pa.array(texts))) == whole(path, texts)
    assert len(small._known) == 10
    assert split(*small.encode(pa.array(texts[::-1]))) == whole(path, texts)

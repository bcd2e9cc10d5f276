from __future__ import annotations

import gzip
import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidelake.llm import warc

SCHEMA = "page_id long, url string, html string, row string, digest int, first string"


def pages() -> list[tuple]:
    big = "<p>Größe \U0001f600</p>" * 100
    rows = [(1, "http://a", big), (2, "http://b", big), (9, "http://c", big), (9, "http://c", big),
            (3, None, "small"), (4, "u\r\nEvil: 1", "small"), (5, "x", None), (6, "x", ""),
            (7, "x", "WARC/1.1\r\n\r\n" * 30), (None, "n", big), (None, "m", "only" * 400),
            (None, "m", "only" * 400), (8, "long", "é<b>" * 60_000), (10, "long", "é<b>" * 60_000),
            (11, "edge", "x" * 1000), (12, "edge", "x" * 1000), (13, "edge", "y" * 999),
            (14, "edge", "y" * 999)]
    return [(*r, "r", 1, "f") for r in rows]


def brute(rows: list[tuple]) -> list[tuple]:
    first: dict[bytes, int] = {}
    for key, _, html, *_ in rows:
        body = (html or "").encode()
        if len(body) >= 1000 and key is not None:
            first[body] = max(first.get(body, key), key)
    out = []
    for key, _, html, *_ in rows:
        body = (html or "").encode()
        to = first.get(body) if first.get(body) != key else None
        out.append((key, "revisit" if to is not None else "response", to, len(body),
                    hashlib.sha1(body).hexdigest(), True))
    return sorted(out, key=str)


@pytest.mark.parametrize("segment", [warc.SEGMENT, 300])
def test_round_trip(spark, tmp_path, monkeypatch, segment):
    monkeypatch.setattr(warc, "SEGMENT", segment)
    monkeypatch.setattr(warc, "CHUNK", 77)
    frame = spark.createDataFrame(pages(), SCHEMA).repartition(3)
    folder = warc.write_archives(frame, str(tmp_path / "w"))
    found = warc.read_archives(spark, folder).collect()
    assert sorted((tuple(r[c] for c in ("page_id", "record_type", "refers_to", "payload_bytes",
                                        "payload_digest", "intact")) for r in found),
                  key=str) == brute(pages())
    html = {(r[0], r[2] or "") for r in pages()}
    for r in found:
        if r["record_type"] == "response":
            assert (r["page_id"], bytes(r["payload"]).decode()) in html
    raw = b"".join(gzip.decompress(p.read_bytes()) for p in (tmp_path / "w/warc").glob("*.gz"))
    kinds = [h["warc-type"] for h, _ in warc.parse(raw)]
    assert ("continuation" in kinds) and all(b.count(b"\r\nEvil: 1") == 0 for _, b in warc.parse(raw))


def test_broken_segments_are_told():
    made = list(warc.records(5, 0, "u", "z" * 50_000, None))
    parts = []
    for head, block in warc.parse("".join(r + warc.END for r in made).encode()):
        parts.append({"segment": int(head["warc-segment-number"]), "block": block,
                      "total": int(head.get("warc-segment-total-length", -1)),
                      "header": "\n".join(f"{k}:{v}" for k, v in head.items())})
    assert warc.assemble(parts)["intact"] and warc.assemble(parts)["payload"] == b"z" * 50_000
    assert not warc.assemble([*parts[:1], *parts[2:]])["intact"]
    assert not warc.assemble([parts[0], parts[0], *parts[1:]])["intact"]
    assert not warc.assemble(parts[:-1])["intact"]


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=300), st.integers(1, 50))
def test_chunked_framing(body, size):
    assert warc.unchunked(warc.chunked(body, size).encode()) == (body.encode(), True)
    assert not warc.unchunked(warc.chunked(body, size).encode()[:-5])[1]


def test_empty(spark):
    assert warc.round_trip(spark.createDataFrame([], SCHEMA)).collect() == []

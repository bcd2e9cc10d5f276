from __future__ import annotations

import re
from collections import Counter

import pytest

from tests.llm.tables import documents, prose, rows
from tidelake.llm import adaptive_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def measured(text: str | None) -> tuple:
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[n:n + 3]) for n in range(len(words) - 2)]
    often = Counter(windows)
    again = {n + k for n, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(again))


AWKWARD = ["a b c a b c", "a a a a", "a a a a a b a a a", "x y\nx y\n\n \nx y", "#*$ %&|<>",
           "a b c d a b c x b c d", "    a", "A B C " * 60, "one\x1ctwo\x0bthree\x0cfour"]


def frame(spark):
    more = [(3000 + n, t, "en", "w", len(t), 7, 7, "x", "y", 8, 9, "z") for n, t in enumerate(AWKWARD)]
    docs = documents(spark)
    return docs.unionByName(spark.createDataFrame(more, docs.schema))


def test_base_measures(spark):
    found = adaptive_rules.judge(frame(spark)).collect()
    wanted = Counter((key, *measured(text)) for key, text in [
        *((r[0], r[1]) for r in rows()), *((3000 + n, t) for n, t in enumerate(AWKWARD))])
    assert Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"],
                    r["n_repeat_words"]) for r in found) == wanted
    for r in found:
        failed = r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]
        assert r["base_failed"] == failed and r["kept"] == (not failed and not r["broken"])


def test_cutoffs_follow_the_group(spark):
    """What is usual in one source is an outlier in another."""
    rows_ = []
    for n in range(300):
        code = " ".join(w + (" #" if k % 3 == 0 else "") for k, w in enumerate(
            prose(n, 80).split(" ")))
        rows_ += [(2 * n, code, "en", "code"), (2 * n + 1, prose(900 + n, 80), "en", "news")]
    rows_ += [(9000, rows_[0][1], "en", "news"), (9001, rows_[0][1], "en", "tiny"),
              (9002, rows_[1][1], None, None)]
    docs = spark.createDataFrame(rows_, "doc_id long, text string, lang string, source string")
    found = {r["doc_id"]: r for r in adaptive_rules.judge(docs).collect()}
    assert all(found[k]["kept"] for k in range(600))
    assert found[9000]["broken"] == ["symbol_ratio"] and not found[9000]["kept"]
    # A source with few rows takes the cutoffs of its language, where half the texts are code.
    assert found[9001]["kept"] and found[9002]["kept"]


def test_no_python_in_the_plan(spark):
    plan = adaptive_rules.judge(documents(spark))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


@pytest.mark.parametrize("least", [1, 100])
def test_empty(spark, least):
    assert adaptive_rules.judge(documents(spark, empty=True), least_rows=least).collect() == []

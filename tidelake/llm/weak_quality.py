"""Quality classifier without given labels: heuristics vote, EM weighs them, a linear scorer learns.

1. Eight heuristics look at every text and vote good, bad, or not at all. How often each pattern of
   votes occurs is all that EM needs; there are at most 3**8 patterns, whatever the table's size.
2. EM estimates how often each heuristic is right about good and bad texts and the posterior of each
   pattern.
3. A logistic scorer over hashed features learns the posteriors of a bounded sample of rows
   (TRAIN_ROWS, drawn by hash) and then scores every text. The scorer decides.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.llm.common import mixed

TRAIN_ROWS = 4000  # rows the scorer is fitted on, about; all rows are voted on and scored
FEATURES = 1 << 16
KEEP = 0.25  # least score; short texts score lower than long ones, as less speaks for them
SLICE_BYTES = 2 << 20
SEED = 1
# What a heuristic is taken to be, whatever EM finds: seldom against a good text, and against some of
# the bad ones. Kinds of bad texts differ, and each trips a few heuristics only; without this EM
# takes the rarer kinds for good texts with an odd trait.
MOST_WRONG, LEAST_RIGHT = 0.002, 0.1
SYMBOLS = "[#*$%&|<>~^{}\\\\]"
# Name, measure, and the bounds of the votes: bad below, good from, good to, bad above.
LABELLERS = (
    ("symbols", "symbol_ratio", (-1.0, 0.0, 0.03, 0.2)),
    ("capitals", "capital_ratio", (-1.0, 0.0, 0.15, 0.4)),
    ("variety", "distinct_ratio", (0.25, 0.4, 1.0, 2.0)),
    ("stutter", "stutter_ratio", (-1.0, 0.0, 0.05, 0.2)),
    ("word_length", "word_length", (2.0, 3.0, 9.0, 14.0)),
    ("marks", "mark_ratio", (-1.0, 0.0, 0.3, 0.6)),
    ("letters", "letter_ratio", (0.5, 0.75, 1.0, 2.0)),
    ("lone_marks", "lone_mark_ratio", (-1.0, 0.0, 0.05, 0.2)),
)
LEAST_WORDS = 12  # a shorter text gets no vote on these, and its features weigh less
UNSURE_IF_SHORT = ("variety", "stutter", "word_length", "marks", "letters")


@dataclass
class Words:
    """The words of a slice of texts: distinct ones, and which one stands where."""

    distinct: pa.Array
    at: np.ndarray
    doc: np.ndarray
    count: np.ndarray


def words_of(texts: pa.Array) -> Words:
    lists = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.string()), ""))
    flat = pc.list_flatten(lists)
    doc = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy())
    full = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    coded = flat.dictionary_encode()
    doc = doc[full]
    return Words(coded.dictionary, coded.indices.to_numpy()[full].astype(np.int64), doc,
                 np.bincount(doc, minlength=len(texts)))


def slices(texts: pa.Array) -> list[pa.Array]:
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    group = np.cumsum(size) // SLICE_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(texts)]
    return [texts.slice(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False) if b > a]


def _per_word(words: Words, value: pa.Array) -> np.ndarray:
    """Sums over each text of a number that depends on the word."""
    number = np.asarray(value, dtype=float)
    return np.bincount(words.doc, number[words.at], len(words.count))


def measures(words: Words) -> dict[str, np.ndarray]:
    distinct, n = words.distinct, np.maximum(words.count, 1)
    chars = _per_word(words, pc.utf8_length(distinct))
    letters = _per_word(words, pc.count_substring_regex(distinct, r"\p{L}"))
    again = np.zeros(len(words.at), bool)
    again[1:] = (words.at[1:] == words.at[:-1]) & (words.doc[1:] == words.doc[:-1])
    seen = np.unique(words.doc * max(len(distinct), 1) + words.at)
    kinds = np.bincount(seen // max(len(distinct), 1), minlength=len(n))
    return {
        "symbol_ratio": _per_word(words, pc.count_substring_regex(distinct, SYMBOLS)) / n,
        "capital_ratio": _per_word(words, pc.count_substring_regex(distinct, r"\p{Lu}"))
        / np.maximum(letters, 1),
        "distinct_ratio": kinds / np.sqrt(n * np.minimum(n, 200)),
        "stutter_ratio": np.bincount(words.doc, again, len(n)) / n,
        "word_length": chars / n,
        "mark_ratio": _per_word(words, pc.match_substring_regex(distinct, r"[^\p{L}\p{N}]$")) / n,
        "letter_ratio": letters / np.maximum(chars, 1),
        "lone_mark_ratio": 1 - _per_word(
            words, pc.match_substring_regex(distinct, r"[\p{L}\p{N}]")) / n}


def votes(words: Words) -> np.ndarray:
    """A row per text, a column per heuristic: 2 good, 0 bad, 1 no vote. No words: no votes."""
    found = measures(words)
    out = np.ones((len(words.count), len(LABELLERS)), np.int64)
    for k, (name, measure, (low, good_from, good_to, high)) in enumerate(LABELLERS):
        x = found[measure]
        out[(x >= good_from) & (x <= good_to), k] = 2
        out[(x < low) | (x > high), k] = 0
        if name in UNSURE_IF_SHORT:
            out[words.count < LEAST_WORDS, k] = 1
    out[words.count == 0] = 1
    return out


def pattern(found: np.ndarray) -> np.ndarray:
    return found @ 3 ** np.arange(len(LABELLERS))


def unpattern(number: np.ndarray) -> np.ndarray:
    return np.asarray(number)[:, None] // 3 ** np.arange(len(LABELLERS)) % 3


def expectation_maximisation(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200,
                             ) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities of votes (class, heuristic, bad or good) and each pattern's posterior of good.

    A heuristic that doesn't vote says nothing.
    Heuristics are taken as independent within a class. A first guess, bad if any heuristic says so,
    also tells which class is which; counts are smoothed by one, so no probability becomes zero.
    """
    cast = unpattern(patterns)
    good = np.where((cast == 0).any(axis=1), 0.1, np.where((cast == 2).any(axis=1), 0.95, 0.5))
    chosen = np.stack([cast == 0, cast == 2], axis=2).astype(float)  # pattern, who, vote
    table = np.empty((2, cast.shape[1], 2))
    for _ in range(rounds):
        weight = np.stack([counts * (1 - good), counts * good])
        table = np.einsum("cp,phv->chv", weight, chosen) + 1.0
        table /= table.sum(axis=2, keepdims=True)
        table[1, :, 0] = np.minimum(table[1, :, 0], MOST_WRONG)
        table[0, :, 0] = np.maximum(table[0, :, 0], LEAST_RIGHT)
        table[:, :, 1] = 1 - table[:, :, 0]
        prior = (weight.sum(axis=1) + 1) / (weight.sum() + 2)
        log = np.einsum("phv,chv->cp", chosen, np.log(table)) + np.log(prior)[:, None]
        new = 1 / (1 + np.exp(np.clip(log[0] - log[1], -50, 50)))
        if np.abs(new - good).max(initial=0) < 1e-9:
            break
        good = new
    return table, good


def features(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, feature, value: hashed words, word shapes and repeats as shares of the words."""
    if not len(words.at):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    shape = words.distinct
    for found, put in ((r"\p{Lu}+", "A"), (r"[\p{Ll}\p{Lo}]+", "a"), (r"\p{N}+", "0")):
        shape = pc.replace_substring_regex(shape, found, put)
    shape = shape.dictionary_encode()

    def hashed(values: pa.Array, kind: int) -> np.ndarray:
        h = pd.util.hash_array(np.asarray(values.to_pylist(), dtype=object), categorize=False)
        return (mixed(h ^ np.uint64(kind)) % np.uint64(FEATURES)).astype(np.int64)

    word = hashed(words.distinct, 1)
    form = hashed(shape.dictionary, 2)[shape.indices.to_numpy()]
    twice = np.zeros(len(words.at), bool)
    twice[1:] = (words.at[1:] == words.at[:-1]) & (words.doc[1:] == words.doc[:-1])
    mark = int(mixed(np.array([3], np.uint64))[0] % np.uint64(FEATURES))
    key = np.concatenate([words.doc * FEATURES + word[words.at],
                          words.doc * FEATURES + form[words.at],
                          words.doc[twice] * FEATURES + mark])
    # Shapes and repeats say more than a single word, so they count double.
    weight = np.concatenate([np.full(len(words.at), 0.5), np.ones(len(words.at)),
                             np.full(int(twice.sum()), 2.0)])
    key, inverse = np.unique(key, return_inverse=True)
    value = np.bincount(inverse, weight)
    doc = key // FEATURES
    return doc, key % FEATURES, value / np.maximum(words.count, LEAST_WORDS)[doc]


def fit(doc: np.ndarray, feature: np.ndarray, value: np.ndarray, target: np.ndarray,
        rounds: int = 300, rate: float = 0.5, decay: float = 1e-4) -> np.ndarray:
    """Weights of a logistic scorer, the last one its bias, by adaptive gradient steps.

    Both classes weigh the same, however rare bad texts are.
    """
    weights, speed = np.zeros(FEATURES + 1), np.full(FEATURES + 1, 1e-8)
    good = max(target.sum(), 1e-9)
    bad = max(len(target) - target.sum(), 1e-9)
    share = target / good + (1 - target) / bad
    for _ in range(rounds):
        score = np.bincount(doc, weights[feature] * value, len(target)) + weights[-1]
        error = (1 / (1 + np.exp(-np.clip(score, -30, 30))) - target) * share
        slope = np.bincount(feature, error[doc] * value, FEATURES + 1)
        slope[-1] += error.sum()
        slope += decay * weights
        speed += slope ** 2
        weights -= rate * slope / np.sqrt(speed)
    return weights


def vote_column(text: Column) -> Column:
    @F.arrow_udf("int")
    def vote(texts: pa.Array) -> pa.Array:
        return pa.array(np.concatenate([pattern(votes(words_of(t))) for t in slices(texts)]
                                       or [np.zeros(0, np.int64)]).astype(np.int32))

    return vote(text)


@dataclass
class Model:
    """What was learnt: posterior by pattern, accuracies, and the scorer's weights."""

    posterior: dict[int, float]
    accuracies: np.ndarray
    weights: np.ndarray


def learn(docs: DataFrame, text: str = "text", train_rows: int = TRAIN_ROWS) -> Model:
    """Vote on all rows, weigh the heuristics, and fit the scorer to a sample drawn by hash.

    To the driver come a row per pattern of votes and the features of about `train_rows` texts at
    most.
    """
    counted = docs.select(vote_column(F.col(text)).alias("p")).groupBy("p").count().orderBy(
        "p").collect()
    patterns = np.array([r["p"] for r in counted], np.int64)
    counts = np.array([r["count"] for r in counted], np.int64)
    table, good = expectation_maximisation(patterns, counts)
    posterior = dict(zip(patterns.tolist(), good.tolist(), strict=True))
    total = int(counts.sum())
    if not total:
        return Model(posterior, table, np.zeros(FEATURES + 1))

    @F.arrow_udf("struct<feature:array<int>,value:array<double>>")
    def seen(texts: pa.Array) -> pa.Array:
        rows = []
        for part in slices(texts):
            doc, feature, value = features(words_of(part))
            edge = np.searchsorted(doc, np.arange(len(part) + 1))
            rows += [{"feature": feature[a:b], "value": value[a:b]}
                     for a, b in zip(edge[:-1], edge[1:], strict=True)]
        return pa.array(rows, pa.struct([("feature", pa.list_(pa.int32())),
                                         ("value", pa.list_(pa.float64()))]))

    # Texts are drawn by their hash, so the sample depends on nothing else, and copies count once:
    # each task passes on one of them.
    drawn = docs.select(F.col(text).alias("t"), F.xxhash64(F.lit(SEED), F.col(text)).alias("h")).where(
        F.pmod("h", F.lit(1 << 30)) < (1 << 30) * (train_rows / total))
    sample = drawn.groupBy("h").agg(F.first("t").alias("t")).select(
        "h", vote_column(F.col("t")).alias("p"), seen(F.col("t")).alias("x")).orderBy("h").collect()
    size = [len(r["x"]["feature"]) for r in sample]
    doc = np.repeat(np.arange(len(sample)), size)
    feature = np.array([f for r in sample for f in r["x"]["feature"]], np.int64)
    value = np.array([v for r in sample for v in r["x"]["value"]])
    target = np.array([posterior.get(r["p"], 0.5) for r in sample])
    return Model(posterior, table, fit(doc, feature, value, target))


def judged_column(text: Column, model: Model, docs: DataFrame, voting: bool = True) -> Column:
    """struct: votes if asked for, and score, the probability of being good; 0 without words."""
    shared = docs.sparkSession.sparkContext.broadcast(model.weights)  # FEATURES numbers

    @F.arrow_udf("struct<votes:int,score:double>")
    def judge(texts: pa.Array) -> pa.Array:
        weights, cast, out = shared.value, [np.zeros(0, np.int32)], [np.zeros(0)]
        for part in slices(texts):
            words = words_of(part)
            doc, feature, value = features(words)
            z = np.bincount(doc, weights[feature] * value, len(part)) + weights[-1]
            cast.append(pattern(votes(words)).astype(np.int32) if voting
                        else np.zeros(len(part), np.int32))
            out.append(np.where(words.count > 0, 1 / (1 + np.exp(-np.clip(z, -30, 30))), 0.0))
        return pa.StructArray.from_arrays(
            [pa.array(np.concatenate(cast)), pa.array(np.concatenate(out))], ["votes", "score"])

    return judge(text)


def classify(docs: DataFrame, text: str = "text", keep: float = KEEP,
             model: Model | None = None) -> DataFrame:
    """document (a struct of all input columns), votes, posterior, score, kept for every row.

    Null and empty texts have no words: no heuristic votes, the score is 0 and they are rejected.
    Equal texts get equal scores, repeated rows stay repeated, an empty table stays empty.
    """
    model = model or learn(docs, text)
    rows = docs.select(F.struct("*").alias("document"), judged_column(
        F.col(text), model, docs).alias("j")).select("document", "j.votes", "j.score")
    known = docs.sparkSession.createDataFrame(
        [(p, g) for p, g in sorted(model.posterior.items())] or [(-1, 0.5)],
        "p int, posterior double")  # at most 3**8 rows
    return rows.join(F.broadcast(known), F.col("votes") == F.col("p"), "left").select(
        "document", "votes", F.coalesce("posterior", F.lit(0.5)).alias("posterior"), "score",
        (F.col("score") >= keep).alias("kept"))


def good_documents(docs: DataFrame, text: str = "text", keep: float = KEEP) -> DataFrame:
    """The rows the scorer keeps, with all their columns."""
    return docs.where(judged_column(F.col(text), learn(docs, text), docs, voting=False)[
        "score"] >= keep)

"""Secrets in texts: three fixed patterns, and a character network over every other candidate.

The patterns' findings always stand. A candidate is a run of at least LEAST characters of the kind
keys are made of, with a digit, or such a part of a run beside the patterns' findings. The network sees the candidate and the
characters around it, a long one in overlapping windows, of which the greatest probability counts; a
candidate is a finding, as a whole, if its calibrated probability reaches a threshold that keeps
RECALL of the held-out secrets, of the corpus's own and of the drawn ones alike.

The network learns from labelled findings: what the patterns found in the texts (secrets), runs of
well-known harmless forms such as addresses, numbers and dates (not secrets), at most SAMPLE of each,
drawn by hash; and as many drawn by a seeded generator in forms that the patterns don't know.
"""

from __future__ import annotations

import logging
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.llm.common import stored

SAMPLE = 1500
LEAST = 12
RECALL = 0.98
SEED = 7
MASK = "[SECRET]"
log = logging.getLogger(__name__)
# The patterns every text is searched with, in this order, and the least length of
# what they find.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a run of 24 or more is the whole run
ASSIGN_LEAST, ACCESS_LEAST = 6, 20
KINDS = ("assign", "access", "hex", "net")
_DIGIT = re.compile(r"[0-9]")
_RUN = re.compile(r"[A-Za-z0-9+/_.=-]*")
_RUN_CHARACTERS = frozenset(
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")
# Harmless forms: numbers, dotted or dashed numbers, names of hosts and files, words with a number.
# No part gives back what it took, so that a run is judged in one pass however long it is.
_HARMLESS = re.compile(
    r"[0-9]++([./_-][0-9]++)*+|"
    r"[A-Za-z][a-z]*+[0-9]{0,4}+([._/=-]++[A-Za-z]?+[a-z]*+[0-9]{0,4}+)*+")

Span = tuple[int, int, int]  # start, end, kind


def base_spans(text: str) -> list[Span]:
    found = []
    if "=" in text or ":" in text:
        found += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text)
                  if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text)
                  if m.end() - m.start() >= ACCESS_LEAST]
    found += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], s[2], s[1]))


def runs(text: str) -> Iterator[tuple[int, int]]:
    """Runs of key characters with a digit, from left to right."""
    at = 0
    while found := _DIGIT.search(text, at):
        start = found.start()
        while start > at and text[start - 1] in _RUN_CHARACTERS:
            start -= 1
        at = _RUN.match(text, found.end()).end()
        if at - start >= LEAST:
            yield start, at


def candidates(text: str, taken: list[Span], parts: bool = False) -> Iterator[tuple[int, int]]:
    """Runs that no finding overlaps; with parts, also what findings leave of a run, if it is long
    enough and has a digit."""
    n = 0
    for start, end in runs(text):
        while n < len(taken) and taken[n][1] <= start:
            n += 1
        at, k = start, n
        while k < len(taken) and taken[k][0] < end:
            if parts and taken[k][0] - at >= LEAST and _DIGIT.search(text, at, taken[k][0]):
                yield at, taken[k][0]
            at, k = max(at, taken[k][1]), k + 1
        if at == start or (parts and end - at >= LEAST and _DIGIT.search(text, at, end)):
            yield at, end


# What the network sees: characters before, characters of the candidate, characters after. Windows of
# a longer candidate are SLIDE apart, so that any SHOWN - SLIDE characters in a row are in one window.
BEFORE, SHOWN, AFTER = 20, 48, 8
SLIDE = 24
WINDOW = BEFORE + SHOWN + AFTER
SHAPES, WIDTH, FILTERS = 12, 5, 24
_OTHER = 128  # any character beyond ASCII
_PAD = 129


def window(text: str, start: int, end: int) -> np.ndarray:
    """Character codes at fixed places, of SHOWN characters at most."""
    shown = (text[max(0, start - BEFORE):start].rjust(BEFORE, "\0")
             + text[start:end].ljust(SHOWN, "\0") + text[end:end + AFTER].ljust(AFTER, "\0"))
    codes = np.frombuffer(shown.encode("utf-32-le"), np.uint32)
    return np.where(codes == 0, _PAD, np.minimum(codes, _OTHER)).astype(np.uint8)


def places(start: int, end: int) -> list[tuple[int, int]]:
    """The windows that together show all of a candidate."""
    if end - start <= SHOWN:
        return [(start, end)]
    return [(a, a + SHOWN) for a in [*range(start, end - SHOWN, SLIDE), end - SHOWN]]


@dataclass
class Network:
    """Character embedding, one convolution, the greatest answer of each filter over the candidate
    and over its surroundings, and a logistic layer; then Platt's calibration and the threshold."""

    shape: np.ndarray  # character, number
    filters: np.ndarray  # WIDTH * SHAPES, FILTERS
    bias: np.ndarray
    out: np.ndarray  # 2 * FILTERS + 1
    platt: tuple[float, float] = (1.0, 0.0)
    threshold: float = 0.5
    # Per sort of labelled window (0 the corpus's, 1 drawn): held-out secrets, and the share of them
    # that reaches the threshold.
    reached: tuple[tuple[int, int, float], ...] = ()

    def _forward(self, codes: np.ndarray) -> tuple[np.ndarray, ...]:
        places = codes.shape[1] - WIDTH + 1
        view = np.lib.stride_tricks.sliding_window_view(codes, WIDTH, axis=1)
        columns = self.shape[view].reshape(len(codes), places, WIDTH * SHAPES)
        answer = np.maximum(columns @ self.filters + self.bias, 0)
        inside = slice(BEFORE, BEFORE + SHOWN - WIDTH + 1)
        outer = answer.copy()
        outer[:, inside] = -1
        at = answer[:, inside].argmax(axis=1) + BEFORE, outer.argmax(axis=1)
        row, f = np.arange(len(codes))[:, None], np.arange(FILTERS)[None, :]
        pooled = np.concatenate(
            [answer[row, at[0], f], np.maximum(outer[row, at[1], f], 0)], axis=1)
        return view, columns, at, pooled, pooled @ self.out[:-1] + self.out[-1]

    def score(self, codes: np.ndarray) -> np.ndarray:
        return self._forward(codes)[-1] if len(codes) else np.zeros(0)

    def probability(self, codes: np.ndarray) -> np.ndarray:
        a, b = self.platt
        return 1 / (1 + np.exp(-np.clip(a * self.score(codes) + b, -30, 30)))

    def gradient(self, codes: np.ndarray, target: np.ndarray) -> list[np.ndarray]:
        view, columns, at, pooled, z = self._forward(codes)
        error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - target) / len(codes)
        out = np.append(pooled.T @ error, error.sum())
        down = error[:, None] * self.out[None, :-1] * (pooled > 0)
        filters, bias = np.zeros_like(self.filters), np.zeros_like(self.bias)
        shape = np.zeros_like(self.shape)
        row = np.arange(len(codes))[:, None]
        for half, place in enumerate(at):
            part = down[:, half * FILTERS:(half + 1) * FILTERS]
            seen = columns[row, place]  # row, filter, WIDTH * SHAPES
            filters += np.einsum("nfk,nf->kf", seen, part)
            bias += part.sum(axis=0)
            back = (part[:, :, None] * self.filters.T[None]).reshape(
                len(codes), FILTERS, WIDTH, SHAPES)
            np.add.at(shape, view[row, place], back)
        return [shape, filters, bias, out]


def train(codes: np.ndarray, target: np.ndarray, recall: float = RECALL, rounds: int = 12,
          seed: int = SEED, sort: np.ndarray | None = None) -> Network:
    """Fit the network on four fifths of the labelled windows, calibrate it and set the threshold on
    the rest.

    The threshold is the highest that keeps the recall for each sort of window, whatever it is. A sort
    with too few held-out secrets to tell such a share (fewer than 1 / (1 - recall)) sets none, unless
    no sort has enough; then all set it together.
    """
    rng = np.random.default_rng(seed)
    net = Network(rng.normal(0, 0.4, (_PAD + 1, SHAPES)),
                  rng.normal(0, 1 / np.sqrt(WIDTH * SHAPES), (WIDTH * SHAPES, FILTERS)),
                  np.zeros(FILTERS), rng.normal(0, 0.2, 2 * FILTERS + 1))
    order = rng.permutation(len(codes))
    held, used = order[:len(order) // 5], order[len(order) // 5:]
    state = [(p, np.zeros_like(p), np.zeros_like(p))
             for p in (net.shape, net.filters, net.bias, net.out)]
    step = 0
    for _ in range(rounds):
        used = rng.permutation(used)
        for n in range(0, len(used), 64):
            step += 1
            some = used[n:n + 64]
            for (p, m, v), g in zip(state, net.gradient(codes[some], target[some]), strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= 0.01 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    net.platt = calibrate(net.score(codes[held]), target[held])
    secret = held[target[held] == 1]
    found = net.probability(codes[secret])
    kind = np.zeros(len(codes), int)[secret] if sort is None else sort[secret]
    groups = [np.sort(found[kind == k]) for k in np.unique(kind)]
    enough = [g for g in groups if len(g) * (1 - recall) >= 1 - 1e-9] or [np.sort(found)]
    if len(found):
        net.threshold = min(float(g[int(np.floor((1 - recall) * len(g) + 1e-9))]) for g in enough)
    net.reached = tuple((int(k), len(g), float((g >= net.threshold).mean()))
                        for k, g in zip(np.unique(kind), groups, strict=True))
    return net


def calibrate(score: np.ndarray, target: np.ndarray) -> tuple[float, float]:
    """Platt's a, b with his smoothed targets, by gradient steps on standardised scores.

    The steps are few and bounded, so scores that separate the labels don't make a grow for ever.
    """
    if not len(score):
        return 1.0, 0.0
    good, bad = target.sum(), (1 - target).sum()
    aim = np.where(target == 1, (good + 1) / (good + 2), 1 / (bad + 2))
    centre, spread = score.mean(), max(score.std(), 1e-6)
    x, a, b = (score - centre) / spread, 1.0, 0.0
    for _ in range(500):
        error = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30))) - aim
        a, b = a - (error @ x) / len(x), b - error.mean()
    return float(a / spread), float(b - a * centre / spread)


def drawn_findings(n: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Labelled windows in forms the patterns don't know, half of the forms secrets.

    Some secrets lie in a long path, query or dotted chain: a window that shows as much of one as
    some window always does is labelled a secret, one that shows none is not, others aren't used.
    """
    rng = np.random.default_rng([seed, 1])
    small, large, digits = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"

    def some(alphabet: str, least: int, most: int) -> str:
        return "".join(rng.choice(list(alphabet), int(rng.integers(least, most + 1))))

    def word() -> str:
        return some(small, 2, 9)

    def number(least: int = 1, most: int = 4) -> str:
        return some(digits, least, most)

    secrets = [lambda: some(small + large + digits, 16, 48),
               lambda: some(small + large + digits + "+/", 20, 64) + "=" * int(rng.integers(0, 3)),
               lambda: word()[:3] + "_" + some(small + large + digits, 24, 40),
               lambda: word()[:2] + "-" + some(small + large + digits, 20, 48),
               lambda: some(digits + "ABCDEF", 24, 64),
               lambda: ".".join(some(small + large + digits + "_-", 16, 40) for _ in range(3)),
               lambda: some(small + digits, 20, 40),
               lambda: some(large + digits, 16, 32)]
    plain = [lambda: number(12, 20), lambda: ".".join(number(1, 3) for _ in range(4)),
             lambda: "-".join(number(2, 4) for _ in range(4)),
             lambda: f"{word()}{number()}.{word()}.{word()[:3]}",
             lambda: f"{word()}/{word()}/{word()}{number()}.{word()[:3]}",
             lambda: f"{number(4, 4)}-{number(2, 2)}-{number(2, 2)}T{number(2, 2)}",
             lambda: f"{word()}_{word()}_{word()}{number()}",
             lambda: f"{word().capitalize()}{word().capitalize()}{word().capitalize()}{number()}",
             lambda: f"{word()}={number(6, 9)}.{number()}", lambda: f"v{number()}.{number()}.{word()}.{word()}"]

    def chain(least: int, most: int, within: str) -> str:
        return within.join(word() + str(rng.choice(["", number()])) for _ in range(
            int(rng.integers(least, most + 1))))

    def around() -> tuple[str, str]:
        kind = int(rng.integers(3))
        if kind == 0:
            return chain(1, 14, "/") + "/", "/" + chain(1, 14, "/")
        if kind == 1:
            return chain(1, 8, "/") + "/" + word() + "=", "." + chain(1, 14, "=")
        return chain(1, 14, ".") + ".", "." + chain(1, 14, ".")

    plain += [lambda: chain(8, 30, "/"), lambda: chain(8, 30, "."), lambda: chain(8, 30, "-")]
    codes, target = [], []
    for k in range(n):
        make = secrets if k % 2 else plain
        body = make[int(rng.integers(len(make)))]()
        key = (0, len(body)) if k % 2 else (0, 0)
        if k % 8 == 7:
            first, last = around()
            hidden = some(small + large + digits, 16, 40)
            body, key = first + hidden + last, (len(first), len(first) + len(hidden))
        before = " ".join(word() for _ in range(4)) + str(rng.choice([" ", ": ", ' "', "\n"]))
        after = str(rng.choice([" ", '" ', "\n", ". "])) + " ".join(word() for _ in range(2))
        for a, b in places(0, len(body)):
            common = min(b, key[1]) - max(a, key[0])
            if common <= 0 or common >= min(key[1] - key[0], SHOWN - SLIDE):
                codes.append(window(before + body + after, len(before) + a, len(before) + b))
                target.append(int(common > 0))
    return np.array(codes), np.array(target, float)


def corpus_findings(docs: DataFrame, text: str = "text", sample: int = SAMPLE,
                    seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Labelled windows from the texts, at most `sample` of each label, the smallest by hash.

    Of findings the value alone is shown in every other window, so that the word before it isn't all
    the network learns. Equal windows count once.
    """
    @F.arrow_udf("array<struct<secret:int,window:binary>>")
    def labelled(texts: pa.Array) -> pa.Array:
        out = []
        for value in texts:
            body, rows = value.as_py() or "", []
            found = base_spans(body)
            for n, (start, end, kind) in enumerate(found):
                if kind == 0:
                    start = max(start, end - len(_value(body[start:end])))
                seen, at = (body, start) if n % 2 else (body[start:end], 0)
                rows += [(1, window(seen, a, b)) for a, b in places(at, at + end - start)]
            rows += [(0, window(body, a, b)) for start, end in candidates(body, found)
                     if _HARMLESS.fullmatch(body, start, end) for a, b in places(start, end)]
            out.append([{"secret": s, "window": w.tobytes()} for s, w in rows])
        return pa.array(out, pa.list_(pa.struct([("secret", pa.int32()),
                                                 ("window", pa.binary())])))

    rows = docs.select(F.explode(labelled(F.col(text))).alias("r")).select("r.secret", "r.window")
    # The texts are read once; what is labelled is small beside them. Each task then passes on no
    # more than `sample` of a label.
    rows = stored(rows.distinct(), "labelled")
    drawn = [rows.where(F.col("secret") == s).orderBy(
        F.xxhash64("window", F.lit(seed)), "window").limit(sample) for s in (0, 1)]
    found = drawn[0].union(drawn[1]).collect()
    codes = [np.frombuffer(r["window"], np.uint8) for r in found]
    return (np.array(codes, np.uint8).reshape(-1, WINDOW),
            np.array([r["secret"] for r in found], float))


def _value(assigned: str) -> str:
    return ASSIGN.match(assigned).group(2)


def learn(docs: DataFrame, text: str = "text", sample: int = SAMPLE,
          recall: float = RECALL) -> Network:
    own, drawn = corpus_findings(docs, text, sample), drawn_findings(2 * sample)
    net = train(np.concatenate([own[0], drawn[0]]), np.concatenate([own[1], drawn[1]]), recall,
                sort=np.repeat([0, 1], [len(own[0]), len(drawn[0])]))
    log.info("threshold %.4f; sort, held-out secrets and recall: %s", net.threshold, net.reached)
    return net


def find(texts: list[str | None], net: Network) -> list[tuple[list[Span], list[Span]]]:
    """Findings of the patterns and all findings, per text."""
    base, open_, codes = [], [], []
    for n, text in enumerate(texts):
        found = base_spans(text or "")
        base.append(found)
        for start, end in candidates(text or "", found, parts=True):
            seen = [window(text, a, b) for a, b in places(start, end)]
            open_ += [(n, start, end)] * len(seen)
            codes += seen
    sure: set[tuple[int, int, int]] = set()
    for k in range(0, len(codes), 512):
        yes = net.probability(np.array(codes[k:k + 512])) >= net.threshold
        sure.update(open_[k + m] for m in np.flatnonzero(yes).tolist())
    more: list[list[Span]] = [[] for _ in texts]
    for n, start, end in sure:
        more[n].append((start, end, 3))
    return [(b, sorted(b + m, key=lambda s: (s[0], s[2], s[1])))
            for b, m in zip(base, more, strict=True)]


def listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in spans)


def masked(text: str, spans: list[Span], mask: str = MASK) -> str:
    """The text with overlapping spans joined and replaced."""
    out, at = [], 0
    for start, end, _ in spans:
        if start >= at:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join([*out, text[at:]])


def spans_column(docs: DataFrame, text: Column, net: Network) -> Column:
    """struct: base and all spans as kind:start:end in code points, end exclusive."""
    shared = docs.sparkSession.sparkContext.broadcast(net)  # a few thousand numbers

    @F.arrow_udf("struct<base:string,spans:string>")
    def spans(texts: pa.Array) -> pa.Array:
        out = [{"base": listed(b), "spans": listed(a)}
               for b, a in find(texts.to_pylist(), shared.value)]
        return pa.array(out, pa.struct([("base", pa.string()), ("spans", pa.string())]))

    return spans(text)


def find_secrets(docs: DataFrame, text: str = "text", net: Network | None = None) -> DataFrame:
    """document (a struct of all input columns), base, spans for every row.

    Null and empty texts have no spans. Spans of different kinds may overlap each other; those of
    the network overlap none. Repeated rows are searched alike, an empty table stays empty, and a
    corpus without findings leaves the network its drawn examples.
    """
    found = spans_column(docs, F.col(text), net or learn(docs, text))
    return docs.select(F.struct("*").alias("document"), found.alias("f")).select(
        "document", "f.base", "f.spans")


def mask_secrets(docs: DataFrame, text: str = "text", length: str | None = "n_chars",
                 net: Network | None = None) -> DataFrame:
    """All rows and columns, with every span replaced by MASK; `length`, if there is such a column,
    is set to the characters of a text that was changed. Null texts stay null."""
    shared = docs.sparkSession.sparkContext.broadcast(net or learn(docs, text))

    @F.arrow_udf("string")
    def mask(texts: pa.Array) -> pa.Array:
        values = texts.to_pylist()
        return pa.array([t if t is None or not s else masked(t, s) for t, (_, s) in
                         zip(values, find(values, shared.value), strict=True)], pa.string())

    rows = docs.select(F.struct("*").alias("d"), mask(F.col(text)).alias("m"))
    out = {c: F.col("d").getField(c) for c in docs.columns}
    if length in out:
        out[length] = F.when(F.col("m").eqNullSafe(out[text]), out[length]).otherwise(
            F.length("m").cast(docs.schema[length].dataType))
    out[text] = F.col("m")
    return rows.select(*[value.alias(name) for name, value in out.items()])

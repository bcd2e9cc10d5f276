"""The trie of conversation prefixes, from sorted sequences and range minima over their LCPs.

Conversations are sequences of turn digests. Their keys (sequence, conv_id) are cut into ranges by
keys drawn from the data; a range is sorted in one task, where the number of common leading turns of
neighbours is kept in a sparse table of range minima. Every candidate prefix then searches its left
and right extent in that table on its own, by binary search, which gives its members as an interval;
all counts are differences of running sums.

Only prefixes of the range bounds can have members in several ranges. They come out of each range in
parts: numbers that add up (members, their characters, leaves, children, distinct turns), and the
listed ends. There are at most as many as the bounds have turns, however large the table is. Copies of
one conversation are told apart by conv_id, so a large group of them is spread over ranges.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelake.llm.common import stored
from tidelake.session import shared_folder
from tidelake.sizing import broadcast_if_small

DIGEST = 16
SHARD_TURNS = 1_000_000  # of a range, about
DRAWN = 64  # keys drawn for each range, from which its bounds are taken
SEED = 13
_EMPTY = hashlib.sha256(b"").hexdigest()
_PART = ("key binary, above binary, shard int, depth long, conv_id long, parent_conv_id long, "
         "n_convs long, n_children long, n_leaves long, tokens long, distinct_tokens long, "
         "own_tokens long, ends string, ids string")
_NODE = ("key binary, conv_id long, depth long, parent_conv_id long, n_convs long, "
         "n_children long, n_leaves long, saved_tokens long")
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
           "saved_tokens", "ends_sha256"]


def turn_sequences(conversations: DataFrame) -> DataFrame:
    """conv_id, turns (array of struct digest, tokens) in the order of `turn`, null first.

    A turn is known by a digest of role and text; null ones are empty. Turns of equal number follow
    each other by digest. Rows without conv_id belong to no conversation. What moves is 16 bytes and
    two numbers a turn, hashed by the hundred conversations a conv_id belongs to.
    """
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    said = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    number = F.col("conv_id").cast("long")
    rows = conversations.where(number.isNotNull()).select(
        (number - number % 100).alias("base"), number.alias("conv_id"),
        F.col("turn").alias("turn"), F.unhex(F.md5(said)).alias("digest"),
        F.length(text).alias("tokens"))
    ordered = F.sort_array(F.collect_list(F.struct("turn", "digest", "tokens")))
    return rows.repartition("base").groupBy("base", "conv_id").agg(ordered.alias("turns")).select(
        "base", "conv_id", F.transform("turns", lambda t: F.struct(
            t["digest"].alias("digest"), t["tokens"].alias("tokens"))).alias("turns"))


def rebuilt(conversations: DataFrame, shared: int = 6) -> DataFrame:
    """conv_id, seq (digests joined), tokens: each conversation with the head of its hundred's first.

    The first h turns of conversation c - c % 100 (all it has, none if there is none), then its own
    turns after its first h; h = crc32(c) % shared.
    """
    rows = turn_sequences(conversations)
    lead = F.slice("turns", 1, shared)
    head = F.max(F.when(F.col("conv_id") == F.col("base"), lead)).over(Window.partitionBy("base"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % shared).cast("int")
    rows = rows.select("conv_id", "turns", F.coalesce(head, F.array_repeat(
        F.col("turns")[0], F.lit(0))).alias("head"), h.alias("h"))
    turns = F.concat(F.slice("head", F.lit(1), F.col("h")),
                     F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1))))
    return rows.select("conv_id", turns.alias("turns")).select(
        "conv_id",
        F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["digest"])), "")).alias("seq"),
        F.transform("turns", lambda t: t["tokens"].cast("int")).alias("tokens"))


class RangeMinima:
    """Minima of a row of numbers over every stretch whose length is a power of two."""

    def __init__(self, values: np.ndarray) -> None:
        self.levels = [values]
        while 2 << len(self.levels) - 1 <= len(values):
            last, half = self.levels[-1], 1 << len(self.levels) - 1
            self.levels.append(np.minimum(last[:-half], last[half:]))

    def right(self, at: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The furthest r >= at such that values[at + 1 .. r] are all >= least."""
        r, last = at.copy(), len(self.levels[0]) - 1
        for k in range(len(self.levels) - 1, -1, -1):
            level, step = self.levels[k], 1 << k
            go = r + step <= last
            go[go] = level[r[go] + 1] >= least[go]
            r[go] += step
        return r

    def left(self, at: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The furthest l <= at such that values[l + 1 .. at] are all >= least."""
        found = at.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            level, step = self.levels[k], 1 << k
            go = found - step >= 0
            go[go] = level[found[go] - step + 1] >= least[go]
            found[go] -= step
        return found


def _common(a: bytes, b: bytes) -> int:
    """Leading turns that two sequences share."""
    most, step = min(len(a), len(b)) // DIGEST, 64
    for k in range(0, most, step):
        if a[k * DIGEST:(k + step) * DIGEST] != b[k * DIGEST:(k + step) * DIGEST]:
            n = k
            while n < most and a[n * DIGEST:(n + 1) * DIGEST] == b[n * DIGEST:(n + 1) * DIGEST]:
                n += 1
            return n
    return most


def _prefix_keys(seq: bytes, depth: int) -> list[bytes]:
    """A key for each prefix of up to `depth` turns."""
    state, keys = hashlib.md5(), []
    for d in range(depth + 1):
        keys.append(state.copy().digest())
        state.update(seq[d * DIGEST:(d + 1) * DIGEST])
    return keys


def _ranges(counts: np.ndarray) -> np.ndarray:
    """0, 1, .., n - 1 for every n, one after the other."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)


def shard_nodes(ids: np.ndarray, seqs: list[bytes], tokens: list[np.ndarray], shard: int,
                low: bytes | None, high: bytes | None) -> dict[str, list]:
    """All nodes of the conversations of one range, columns as in _PART.

    `low` and `high` are the sequences of the bounds at its start and end. Nodes that are prefixes
    of a bound, and the root, have a key and are parts; the others are whole.
    """
    order = sorted(range(len(ids)), key=lambda n: (seqs[n], ids[n]))
    seqs, ids = [seqs[n] for n in order], ids[order]
    first = [n for n in range(len(seqs)) if n == 0 or seqs[n] != seqs[n - 1]]
    ends = [*first[1:], len(seqs)]
    distinct = [seqs[n] for n in first]
    copies = np.diff([*first, len(seqs)]).astype(np.int64)
    words = [tokens[order[n]] for n in first]
    length = np.array([len(w) for w in words], np.int64)
    m = len(distinct)
    lcp = np.array([-1] + [_common(distinct[n - 1], distinct[n]) for n in range(1, m)], np.int64)
    minima = RangeMinima(lcp)
    smallest = RangeMinima(ids[first])

    # Candidates: every prefix from the one shared with the sequence before to the whole sequence.
    start = np.maximum(lcp, 0)
    per = length - start + 1
    seq_of, depth = np.repeat(np.arange(m), per), np.repeat(start, per) + _ranges(per)
    left, right = minima.left(seq_of, depth), minima.right(seq_of, depth)
    is_node = left == seq_of
    node_left, node_right, node_depth = left[is_node], right[is_node], depth[is_node]
    # Nodes stand in preorder: those of a sequence together, shallow ones first.
    at = np.concatenate([[0], np.cumsum(length - lcp)])
    assert at[-1] == len(node_left)
    parent = np.arange(len(node_left)) - 1
    branch = ~is_node
    parent[at[seq_of[branch]]] = at[left[branch]] + depth[branch] - lcp[left[branch]] - 1

    own = np.concatenate([np.concatenate([[0], w])[lcp[n] + 1:] for n, w in enumerate(words)])
    before = np.concatenate([np.concatenate([[0, 0], np.cumsum(w)])[lcp[n] + 1:-1]
                             if len(w) else np.zeros(1, np.int64) for n, w in enumerate(words)])
    own, before = own.astype(np.int64), before.astype(np.int64)

    # Prefixes of the bounds begin at the first or end at the last sequence of the range.
    reach_low = -1 if low is None else _common(low, distinct[0])
    reach_high = -1 if high is None else _common(high, distinct[-1])
    shared = (node_depth == 0) | ((node_left == 0) & (node_depth <= reach_low)) \
        | ((node_right == m - 1) & (node_depth <= reach_high))
    whole = ~shared

    def running(values: np.ndarray) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(values)])

    members = running(copies)
    n_convs = members[node_right + 1] - members[node_left]
    spoken = running(copies * np.array([int(w.sum()) for w in words], np.int64))
    tokens_below = spoken[node_right + 1] - spoken[node_left] - n_convs * before
    here, after = np.arange(len(node_left)), at[node_right + 1]
    kids = np.bincount(parent[whole & (parent >= 0)], minlength=len(parent))
    leaf = running(whole & (kids == 0))
    said = running(np.where(whole, own, 0))
    # The least id of an interval, from two overlapping stretches.
    span = node_right - node_left + 1
    level = np.floor(np.log2(span)).astype(np.int64)
    conv = np.empty(len(span), np.int64)
    for k in np.unique(level):
        rows = level == k
        table = smallest.levels[k]
        conv[rows] = np.minimum(table[node_left[rows]], table[node_right[rows] - (1 << int(k)) + 1])

    n = len(node_left)
    ended = node_depth == length[node_left]
    keys: list[bytes | None] = [None] * n
    low_keys = _prefix_keys(low, reach_low) if low is not None else []
    high_keys = _prefix_keys(high, reach_high) if high is not None else []
    root = hashlib.md5().digest()
    for k in np.flatnonzero(shared).tolist():
        d = int(node_depth[k])
        keys[k] = root if d == 0 else (
            low_keys[d] if node_left[k] == 0 and d <= reach_low else high_keys[d])
    listed: list[str | None] = [None] * n
    digest = [_EMPTY] * n
    for k in np.flatnonzero(ended).tolist():
        i = int(node_left[k])
        text = ",".join(map(str, ids[first[i]:ends[i]].tolist()))
        if shared[k]:
            listed[k] = text
        else:
            digest[k] = hashlib.sha256(text.encode()).hexdigest()
    above = [keys[p] if p >= 0 else None for p in parent.tolist()]
    parent_conv = [int(conv[p]) if p >= 0 and whole[p] else None for p in parent.tolist()]
    return {"key": keys, "above": above, "shard": [shard] * n, "depth": node_depth.tolist(),
            "conv_id": conv.tolist(), "parent_conv_id": parent_conv, "n_convs": n_convs.tolist(),
            "n_children": kids.tolist(), "n_leaves": (leaf[after] - leaf[here]).tolist(),
            "tokens": tokens_below.tolist(), "distinct_tokens": (said[after] - said[here]).tolist(),
            "own_tokens": own.tolist(), "ends": digest, "ids": listed}


def shared_nodes(parts: pa.Table) -> pa.Table:
    """Whole nodes from the sums of their parts: the prefixes of the range bounds, a row each.

    What their whole descendants add is in the sums; they themselves are added here, deepest first.
    """
    rows = sorted(parts.to_pylist(), key=lambda r: r["depth"])
    place = {r["key"]: n for n, r in enumerate(rows)}
    for r in reversed(rows):
        if r["n_children"] == 0:
            r["n_leaves"] += 1
        r["distinct_tokens"] += r["own_tokens"]
        if r["above"] is not None:
            up = rows[place[r["above"]]]
            up["n_children"] += 1
            up["distinct_tokens"] += r["distinct_tokens"] - r["below_tokens"]
            up["n_leaves"] += r["n_leaves"] - r["below_leaves"]
    out = [{"key": r["key"], "conv_id": r["conv_id"], "depth": r["depth"],
            "parent_conv_id": None if r["above"] is None else rows[place[r["above"]]]["conv_id"],
            "n_convs": r["n_convs"], "n_children": r["n_children"], "n_leaves": r["n_leaves"],
            "saved_tokens": r["tokens"] - r["distinct_tokens"]} for r in rows]
    kinds = [("key", pa.binary()), ("conv_id", pa.int64()), ("depth", pa.int64()),
             ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
             ("n_leaves", pa.int64()), ("saved_tokens", pa.int64())]
    return pa.Table.from_pylist(out, pa.schema(kinds))


def listed_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """key, ends_sha256 from id lists in order: a list is hashed as it comes, never put together."""
    key, state = None, None

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({
            "key": pa.array([key], pa.binary()),
            "ends_sha256": pa.array([state.hexdigest()], pa.string())})

    for batch in batches:
        for k, ids in zip(batch.column("key"), batch.column("ids"), strict=True):
            if k.as_py() != key or state is None:
                if state is not None:
                    yield row()
                key, state = k.as_py(), hashlib.sha256(ids.as_py().encode())
            else:
                state.update(b"," + ids.as_py().encode())
    if state is not None:
        yield row()


def prefix_nodes(sequences: DataFrame, folder: str | None = None,
                 shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row per node of the trie of sequences (conv_id, seq, tokens), columns COLUMNS.

    conv_id is unique; seq joins digests of 16 bytes, tokens has a number per turn. Empty sequences
    are members of the root alone. An empty table has no nodes. Further columns are ignored. Very
    long sequences cost 20 bytes a turn in the task of their range; a range holds about
    `shard_turns` turns, and all copies of a text are spread over ranges by conv_id.
    """
    spark = sequences.sparkSession
    folder = folder or shared_folder(spark)
    rows = stored(sequences.select("conv_id", "seq", "tokens"), "sequences", folder)
    n, turns = rows.agg(F.count("*"), F.coalesce(F.sum(F.size("tokens")), F.lit(0))).first()
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), turns // shard_turns + 1)
    share = min(1.0, DRAWN * shards / max(n, 1))
    drawn = sorted((bytes(r["seq"]), r["conv_id"]) for r in rows.select("seq", "conv_id").where(
        F.pmod(F.xxhash64("conv_id", F.lit(SEED)), F.lit(1 << 30)) < int(share * (1 << 30))).collect())
    bounds = sorted({drawn[len(drawn) * k // shards] for k in range(1, shards)}) if drawn else []
    shared = spark.sparkContext.broadcast(bounds)  # a key for each range

    @F.arrow_udf("int")
    def shard_of(seq: pa.Array, conv_id: pa.Array) -> pa.Array:
        from bisect import bisect_right

        known = shared.value
        return pa.array([bisect_right(known, key) for key in
                         zip(seq.to_pylist(), conv_id.to_pylist(), strict=True)], pa.int32())

    def of_shard(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        number, known = table.column("shard")[0].as_py(), shared.value
        values = [np.asarray(v.values.to_numpy(zero_copy_only=False), np.int64)
                  for v in table.column("tokens")]
        found = shard_nodes(
            table.column("conv_id").to_numpy(), table.column("seq").to_pylist(), values, number,
            known[number - 1][0] if number else None,
            known[number][0] if number < len(known) else None)
        kinds = {"key": pa.binary(), "above": pa.binary(), "shard": pa.int32(),
                 "ends": pa.string(), "ids": pa.string()}
        return pa.table({k: pa.array(v, kinds.get(k, pa.int64())) for k, v in found.items()})

    parts = stored(rows.withColumn("shard", shard_of("seq", "conv_id")).groupBy("shard")
                   .applyInArrow(of_shard, _PART), "parts", folder)
    pieces = parts.where(F.col("key").isNotNull())
    summed = pieces.groupBy("key").agg(
        F.first("above", True).alias("above"), F.first("depth").alias("depth"),
        F.min("conv_id").alias("conv_id"), F.first("own_tokens").alias("own_tokens"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "tokens",
                                      "distinct_tokens")])
    summed = summed.select("*", F.col("n_leaves").alias("below_leaves"),
                           F.col("distinct_tokens").alias("below_tokens"), F.lit(0).alias("all"))
    crossing = summed.groupBy("all").applyInArrow(shared_nodes, _NODE)
    ends = pieces.where(F.col("ids").isNotNull()).select("key", "shard", "ids").repartition(
        "key").sortWithinPartitions("key", "shard").mapInArrow(
        listed_digests, "key binary, ends_sha256 string")
    crossing = stored(crossing.join(ends, "key", "left").withColumn(
        "ends_sha256", F.coalesce("ends_sha256", F.lit(_EMPTY))), "crossing", folder)

    inner = parts.where(F.col("key").isNull()).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        (F.col("tokens") - F.col("distinct_tokens")).alias("saved_tokens"),
        F.col("ends").alias("ends_sha256"), "above")
    below = inner.where(F.col("above").isNotNull()).drop("parent_conv_id").join(
        broadcast_if_small(crossing.select(
            F.col("key").alias("above"), F.col("conv_id").alias("parent_conv_id"))), "above")
    return inner.where(F.col("above").isNull()).select(*COLUMNS).union(
        below.select(*COLUMNS)).union(crossing.select(*COLUMNS))


def conversation_trie(conversations: DataFrame, folder: str | None = None,
                      shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The prefix trie of all rebuilt conversations (`rebuilt`), one row per node: COLUMNS.

    Null turns come first, null roles and texts are empty, rows without conv_id are no
    conversation, equal rows of a conversation count as often as they occur. Columns besides
    conv_id, turn, role and text are ignored. An empty table gives an empty result.
    """
    return prefix_nodes(rebuilt(conversations), folder, shard_turns)

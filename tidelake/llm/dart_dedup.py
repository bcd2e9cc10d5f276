"""Near-duplicate documents: dart signatures of weighted word shingles, joined by bands.

A document is the multiset of its runs of five words; the weight of a shingle is how often it occurs,
and its region is that many unit cells. Into every cell darts arrive as a Poisson process whose times
and coordinates are hashes of the cell, the same in all documents. The signature keeps, for each
coordinate, the earliest dart that hits one of the document's cells. Two documents agree in a
coordinate with the probability of their weighted Jaccard similarity. About T * (log T + 4) darts are
looked at for a document of any length, where plain minwise hashing needs T hashes for every shingle.

Bands of coordinates propose links. First every bucket's nodes are compared with a few leaders, which
joins the groups of near copies; a proposal whose signatures agree far too seldom for the wanted
similarity goes no further, and for the others the exact similarity of the whole texts decides. In the
buckets that still hold several components all other pairs are compared, whole texts, inside tasks.
Connected components are the classes. Equal texts are one node from the start.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidelake.llm.common import SPACES, mixed, sieve, stored, unit
from tidelake.llm.components import components
from tidelake.session import shared_folder

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 28, 6  # a pair at 0.8 shares a band with probability 0.9998, one at 0.4 with 0.11
# A proposal needs this much agreement of the whole signatures to be compared in full. It is five
# standard deviations below what a pair at the wanted similarity shows: one in three million is lost.
DEVIATIONS = 5.0
LEADERS = 4
ROUNDS = 2  # of leaders, before the buckets that are still open are compared whole
# Nodes, and bytes of text, that one block of an open bucket has about.
BLOCK, BLOCK_BYTES = 512, 8 << 20
SLICE_BYTES = 2 << 20
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0x100000001B3)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words in order, and where each text's words start."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.string()), ""))
    flat = pc.list_flatten(lists)
    doc = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy())
    full = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    coded = flat.dictionary_encode()
    table = pd.util.hash_array(np.asarray(coded.dictionary.to_pylist(), dtype=object),
                               categorize=False).astype(np.uint64)
    starts = np.append(0, np.cumsum(np.bincount(doc[full], minlength=len(texts))))
    return table[coded.indices.to_numpy()[full]] if len(table) else np.zeros(0, np.uint64), starts


def cells(texts: pa.Array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Cells of all texts, sorted within each, and where each text's cells start.

    A cell is the hash of a shingle and of how often it occurred before. A text with fewer words is
    one shingle; a text without words, and a null, has none.
    """
    with np.errstate(over="ignore"):
        h, starts = word_hashes(texts)
        size = np.diff(starts)
        doc = np.repeat(np.arange(len(size)), size)
        n = max(len(h) - words + 1, 0)
        chain = h[:n].copy()
        for k in range(1, words):
            chain = chain * _BASE + h[k:n + k]
        whole = doc[:n] == doc[words - 1:words - 1 + n]
        shingle, owner = mixed(chain[whole]), doc[:n][whole]
        short = np.flatnonzero((size > 0) & (size < words))
        if len(short):
            own = [h[a:b].tolist() for a, b in zip(starts[short], starts[short + 1], strict=True)]
            chains = [0] * len(own)
            for n_, values in enumerate(own):
                for v in values:
                    chains[n_] = (chains[n_] * int(_BASE) + v) % (1 << 64)
            shingle = np.append(shingle, mixed(np.array(chains, np.uint64) + size[short].astype(
                np.uint64)))
            owner = np.append(owner, short)
        order = np.lexsort((shingle, owner))
        shingle, owner = shingle[order], owner[order]
        new = np.ones(len(shingle), bool)
        new[1:] = (shingle[1:] != shingle[:-1]) | (owner[1:] != owner[:-1])
        first = np.flatnonzero(new)
        nth = np.arange(len(shingle)) - np.repeat(first, np.diff(np.append(first, len(shingle))))
        again = nth > 0
        shingle[again] = mixed(shingle[again] + nth[again].astype(np.uint64) * _STEP)
    return shingle, np.append(0, np.cumsum(np.bincount(owner, minlength=len(size))))


def signatures(cell: np.ndarray, starts: np.ndarray, coordinates: int) -> np.ndarray:
    """The earliest dart of every coordinate, a row per text with cells."""
    weight = np.diff(starts)
    out = np.zeros((len(weight), coordinates), np.uint64)
    todo, wait = np.flatnonzero(weight), math.log(coordinates) + 4
    while len(todo):
        size = weight[todo]
        at = np.repeat(starts[todo] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        owner, live = np.repeat(np.arange(len(todo)), size), cell[at]
        until = wait * coordinates / size  # expected: wait darts for a coordinate
        best = np.full(len(todo) * coordinates, np.inf)
        sign = np.zeros(len(best), np.uint64)
        time, turn = np.zeros(len(live)), 0
        with np.errstate(over="ignore"):
            while len(live):
                dart = mixed(live + np.uint64(turn) * _STEP)
                time = time - np.log(unit(dart))
                hit = time <= until[owner]
                owner, live, time, dart = owner[hit], live[hit], time[hit], dart[hit]
                name = mixed(dart ^ _STEP)
                key = owner * coordinates + (name % np.uint64(coordinates)).astype(np.int64)
                np.minimum.at(best, key, time)
                won = time == best[key]
                sign[key[won]] = name[won]
                turn += 1
        found = np.isfinite(best).reshape(len(todo), coordinates).all(axis=1)
        out[todo[found]] = sign.reshape(len(todo), coordinates)[found]
        todo, wait = todo[~found], wait * 2  # a coordinate without a dart: wait for later ones
    return out


def text_signs(texts: pa.Array, bands: int = BANDS, rows: int = ROWS,
               words: int = WORDS) -> pa.Array:
    """bands: a hash per band, none for a text without words; sketch: a byte per coordinate."""
    found, sketches = [], []
    lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    group = np.cumsum(lengths) // SLICE_BYTES
    for g in np.unique(group):
        at = np.flatnonzero(group == g)
        cell, starts = cells(texts.slice(at[0], len(at)), words)
        sign = signatures(cell, starts, bands * rows)
        sketches += [s.tobytes() for s in sign.astype(np.uint8)]
        sign = sign.reshape(len(at), bands, rows)
        with np.errstate(over="ignore"):
            value = np.zeros((len(at), bands), np.uint64) + np.arange(bands, dtype=np.uint64)
            for r in range(rows):
                value = mixed(value * _BASE + sign[:, :, r])
        full = np.diff(starts) > 0
        edges = np.append(0, np.cumsum(np.where(full, bands, 0))).astype(np.int32)
        found.append(pa.ListArray.from_arrays(
            pa.array(edges), pa.array(value[full].ravel().view(np.int64))))
    lists = pa.concat_arrays(found) if found else pa.array([], pa.list_(pa.int64()))
    return pa.StructArray.from_arrays([lists, pa.array(sketches, pa.binary())], ["bands", "sketch"])


def agreement(left: pa.Array, right: pa.Array, coordinates: int) -> pa.Array:
    """The share of coordinates in which sketches agree."""
    a, b = (np.frombuffer(b"".join(x.to_pylist()), np.uint8).reshape(-1, coordinates)
            for x in (left, right))
    return pa.array((a == b).mean(axis=1) if len(a) else np.zeros(0))


def least_agreement(similarity: float, coordinates: int) -> float:
    return similarity - DEVIATIONS * math.sqrt(similarity * (1 - similarity) / coordinates)


def weighted_similarity(left: pa.Array, right: pa.Array, words: int = WORDS) -> pa.Array:
    """Weighted Jaccard similarity of the texts, pair by pair; each distinct text is cut once."""
    both = pa.concat_arrays([left, right]).dictionary_encode()
    cell, starts = cells(both.dictionary, words)
    a, b = both.indices.to_numpy()[:len(left)], both.indices.to_numpy()[len(left):]
    out = np.zeros(len(left))
    for n, (x, y) in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
        p, q = cell[starts[x]:starts[x + 1]], cell[starts[y]:starts[y + 1]]
        common = len(np.intersect1d(p, q, assume_unique=True))
        total = len(p) + len(q) - common
        out[n] = common / total if total else 0.0
    return pa.array(out)


def sign(docs: DataFrame, key: str = "doc_id", text: str = "text", bands: int = BANDS,
         rows: int = ROWS, words: int = WORDS) -> DataFrame:
    """doc_id, node (a 64-bit hash of the text; equal texts share it), bands, sketch, bytes of the
    text. Map-only."""
    @F.arrow_udf("struct<bands:array<long>,sketch:binary>")
    def signed(texts: pa.Array) -> pa.Array:
        return text_signs(texts, bands, rows, words)

    return docs.select(F.col(key).alias("doc_id"), node_of(text), signed(F.col(text)).alias("s"),
                       F.octet_length(text).cast("long").alias("bytes")
                       ).select("doc_id", "node", "s.bands", "s.sketch", "bytes")


def node_of(text: str) -> Column:
    """A 64-bit hash of the text; texts without words are one node."""
    blank = F.btrim(F.col(text), F.lit(SPACES)) == ""
    return F.xxhash64(F.when(F.col(text).isNull() | blank, F.lit("")).otherwise(F.col(text))).alias(
        "node")


def _likely(pairs: DataFrame, nodes: DataFrame, similarity: float, coordinates: int) -> DataFrame:
    """The pairs whose sketches agree as often as those of similar texts do."""
    @F.arrow_udf("double")
    def agree(left: pa.Array, right: pa.Array) -> pa.Array:
        return agreement(left, right, coordinates)

    both = pairs.join(nodes.select(F.col("node").alias("b"), F.col("sketch").alias("right")), "b")
    both = both.join(nodes.select(F.col("node").alias("a"), F.col("sketch").alias("left")), "a")
    return both.where(agree("left", "right") >= least_agreement(similarity, coordinates)).select(
        "a", "b")


def _texts(docs: DataFrame, text: str, needed: DataFrame) -> DataFrame:
    """node, body for the nodes that are needed.

    They are few and lie anywhere, so a sieve of their hashes keeps the other texts where they are.
    """
    needed = needed.distinct()
    texts = docs.select(node_of(text), F.col(text).alias("body"))
    texts = texts.where(sieve(needed)(F.col("node"))).join(needed, "node", "left_semi")
    return texts.groupBy("node").agg(F.first("body").alias("body"))


def _verified(pairs: DataFrame, docs: DataFrame, text: str, similarity: float,
              words: int) -> DataFrame:
    """The pairs a, b whose whole texts are similar enough."""
    @F.arrow_udf("double")
    def alike(left: pa.Array, right: pa.Array) -> pa.Array:
        return weighted_similarity(left, right, words)

    texts = _texts(docs, text, pairs.select(F.col("a").alias("node")).union(pairs.select("b")))
    members = pairs.join(texts.select(F.col("node").alias("b"), F.col("body").alias("right")), "b")
    whole = members.join(texts.select(F.col("node").alias("a"), F.col("body").alias("left")), "a")
    return whole.where(alike("left", "right") >= similarity).select("a", "b")


def link_nodes(signed: DataFrame, docs: DataFrame, folder: str, text: str = "text",
               similarity: float = SIMILARITY, words: int = WORDS,
               coordinates: int = BANDS * ROWS) -> DataFrame:
    """node, component for the nodes that have links.

    In every band bucket that holds several nodes one is drawn as its leader and all others are
    compared with it: a bucket of m nodes costs m - 1 comparisons. Buckets whose nodes are still in
    different components then draw about LEADERS leaders. What is still open after that is compared
    whole, each bucket for itself, so every two nodes of a bucket end in one component or have been
    compared.
    """
    spark = docs.sparkSession
    # Copies say the same: each task passes on a node once.
    nodes = stored(signed.groupBy("node").agg(F.first(F.struct("bands", "sketch", "bytes")).alias(
        "s")).select("node", "s.bands", "s.sketch", "s.bytes"), "nodes", folder)
    members = nodes.select("node", "bytes", F.explode("bands").alias("band"))
    several = members.groupBy("band").agg(F.min("node").alias("x"), F.max("node").alias("y")).where(
        "x < y").select("band")
    members = stored(members.join(several, "band", "left_semi"), "members", folder)
    links = spark.createDataFrame([], "a long, b long")
    tested = found = None
    for turn in range(ROUNDS):
        rows = _placed(members, found)
        drawn = F.struct(F.xxhash64("node", F.lit(0)).alias("h"), "node", "component")
        open_ = rows.groupBy("band").agg(
            F.min(drawn).alias("leader"), F.min("component").alias("x"),
            F.max("component").alias("y"), F.count("*").alias("n")).where("x < y")
        if turn == 0:
            leaders = open_.select("band", "leader.node", "leader.component")
        else:
            # The same nodes lead in all their buckets, so that their pairs are few.
            share = F.pmod(F.xxhash64("node", F.lit(turn)), F.lit(1 << 20)) / (1 << 20)
            leaders = rows.join(open_.select("band", "n"), "band").where(
                share < F.lit(LEADERS ** turn) / F.col("n")).select("band", "node", "component")
        pairs = rows.join(leaders.toDF("band", "leader", "led"), "band").where(
            "component <> led").select(
            F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = stored(_likely(pairs, nodes, similarity, coordinates), f"pairs-{turn}", folder)
        fresh = stored(_verified(pairs, docs, text, similarity, words), f"links-{turn}", folder)
        if fresh.isEmpty():
            break
        tested = pairs if tested is None else tested.union(pairs)
        links = links.union(fresh)
        found = stored(components(links, f"{folder}/round-{turn}"), f"components-{turn}", folder)
    rest = stored(_rest(_placed(members, found), docs, folder, text, similarity, words), "links-rest",
                  folder)
    if not rest.isEmpty():
        found = stored(components(links.union(rest), f"{folder}/round-rest"), "components-rest",
                       folder)
    return found if found is not None else links.toDF("node", "component")


def _placed(members: DataFrame, found: DataFrame | None) -> DataFrame:
    """band, node, bytes, component: a node without links is its own component."""
    if found is None:
        return members.select("band", "node", "bytes", F.col("node").alias("component"))
    return members.join(found.select("node", "component"), "node", "left").select(
        "band", "node", "bytes", F.coalesce("component", "node").alias("component"))


def _rest(rows: DataFrame, docs: DataFrame, folder: str, text: str, similarity: float,
          words: int) -> DataFrame:
    """Links a, b that join what is alike in the buckets that hold several components.

    A bucket is cut into blocks by hash, and each two blocks meet in one task with their texts, so no
    pair is a row: a task passes on the links that join its components. Of buckets with the same
    nodes one is enough; two nodes alone were compared when one of them led.
    """
    open_ = rows.groupBy("band").agg(
        F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("n"),
        F.sum("bytes").alias("size"), F.bit_xor(F.xxhash64("node", F.lit(2))).alias("p"),
        F.bit_xor(F.xxhash64("node", F.lit(3))).alias("q")).where("x < y and n > 2")
    open_ = open_.groupBy("n", "size", "p", "q").agg(F.min("band").alias("band"))
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("size") / BLOCK_BYTES), F.lit(1))
    held = rows.join(open_.select("band", blocks.cast("int").alias("g")), "band").select(
        "band", "node", "component", "g",
        F.pmod(F.xxhash64("node", F.lit(4)), F.col("g")).cast("int").alias("block"))
    held = stored(held, "open", folder)
    whole = held.join(_texts(docs, text, held.select("node")), "node")
    other = F.explode(F.sequence(F.lit(0), F.col("g") - 1)).alias("other")
    tiles = whole.select("band", "node", "component", "body", "block", other).select(
        "band", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        "node", "component", "block", "body")

    def linked(tile: pa.Table) -> pa.Table:
        return joining(tile, similarity, words)

    return tiles.groupBy("band", "i", "j").applyInArrow(linked, "a long, b long")


def joining(tile: pa.Table, similarity: float = SIMILARITY, words: int = WORDS) -> pa.Table:
    """Links between nodes of block i and of block j that join components, from all their pairs.

    Pairs of one component, also one joined here before, need no comparison, nor do pairs whose
    sizes alone rule the similarity out.
    """
    i, j = tile["i"][0].as_py(), tile["j"][0].as_py()
    node, block = tile["node"].to_numpy(), tile["block"].to_numpy()
    label = np.unique(tile["component"].to_numpy(), return_inverse=True)[1]
    cell, starts = cells(tile["body"].combine_chunks(), words)
    size, cell = np.diff(starts), np.unique(cell, return_inverse=True)[1]
    mark = np.zeros(len(cell) + 1, bool)
    a, b, right = [], [], np.flatnonzero(block == j)
    for x in np.flatnonzero(block == i):
        near = np.minimum(size[right], size[x]) >= similarity * np.maximum(size[right], size[x]) - 1
        y = right[near & (label[right] != label[x]) & ((right > x) | (i != j))]
        if not len(y):
            continue
        own, n = cell[starts[x]:starts[x + 1]], size[y]
        mark[own] = True
        first = np.cumsum(n) - n
        at = np.repeat(starts[y] - first, n) + np.arange(int(n.sum()))
        common = np.add.reduceat(mark[cell[at]], first, dtype=np.int64)
        mark[own] = False
        for z in y[common / (size[x] + n - common) >= similarity]:
            if label[z] != label[x]:
                label[label == label[z]] = label[x]
                a.append(min(node[x], node[z]))
                b.append(max(node[x], node[z]))
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text",
                    similarity: float = SIMILARITY, words: int = WORDS,
                    folder: str | None = None) -> DataFrame:
    """doc_id, node, component, class_id, class_size, kept: a row per row of the input.

    class_id is the smallest key of all documents linked to a document, directly or by way of
    others; class_size counts their rows. kept marks the documents whose key that is. Equal texts
    are always one class; null texts count as empty, and empty texts are equal. Null keys are never
    a class_id unless a class has no other. Long texts are compared whole. Documents of fewer than
    five words are near duplicates only of the same words. component tells classes apart that have
    no class_id.
    """
    folder = folder or shared_folder(docs.sparkSession)
    signed = stored(sign(docs, key, text, words=words), "signed", folder)
    found = link_nodes(signed, docs, folder, text, similarity, words)
    rows = signed.select("doc_id", "node").join(found, "node", "left").select(
        "doc_id", "node", F.coalesce("component", "node").alias("component"))
    classes = rows.groupBy("component").agg(
        F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"))
    return rows.join(classes, "component").select(
        "doc_id", "node", "component", "class_id", "class_size",
        F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"))


def one_per_class(docs: DataFrame, key: str = "doc_id", text: str = "text",
                  folder: str | None = None) -> DataFrame:
    """The rows of the input, one of each class: the first by key, then by text hash.

    All columns stay as they are, whatever they are called. Rows equal in key and text are told
    apart by nothing else, so one of them stays.
    """
    folder = folder or shared_folder(docs.sparkSession)
    marked = near_duplicates(docs, key, text, folder=folder)
    chosen = marked.where("kept").groupBy("component", "class_id").agg(
        F.min("node").alias("node")).select(F.col("class_id").alias("k"), F.col("node").alias("n"))
    chosen = stored(chosen, "chosen", folder)
    rows = docs.select(F.struct("*").alias("document"), F.col(key).alias("k"),
                       node_of(text).alias("n"))
    kept = rows.alias("r").join(chosen.alias("c"), F.col("r.k").eqNullSafe(F.col("c.k"))
                                & (F.col("r.n") == F.col("c.n")), "left_semi")
    # Few rows share key and text; those that do are in one partition of the join already.
    one = Window.partitionBy("k", "n").orderBy("k")
    return kept.withColumn("nth", F.row_number().over(one)).where("nth = 1").select("document.*")

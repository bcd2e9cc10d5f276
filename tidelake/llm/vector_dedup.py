"""Near-duplicate vectors: signs of random projections in several tables, exact cosine, components.

Equal vectors of a label are one node. In each table the signs of a few random projections name a
bucket. Nodes of a bucket are compared with each other as one matrix product inside a task; buckets
above TILE nodes are cut into tiles, and a task gets two tiles. What leaves a task is a sum of links
and one edge per node, never the pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelake.llm.common import mixed, stored
from tidelake.llm.components import components
from tidelake.session import shared_folder

COSINE = 0.98
RECALL = 0.9999  # of pairs just at the threshold; more similar ones are found more surely
BUCKET = 64  # nodes of a label that share a bucket by chance, about
TILE = 1024
SEED = 6


def tables_for(rows: int, cosine: float = COSINE, recall: float = RECALL) -> tuple[int, int]:
    """Signs per table and tables, for labels of up to `rows` nodes."""
    signs = min(40, max(8, math.ceil(math.log2(max(rows, 1) / BUCKET))))
    agree = (1 - math.acos(cosine) / math.pi) ** signs
    return signs, math.ceil(math.log(1 - recall) / math.log(1 - agree))


def buckets(vectors: np.ndarray, signs: int, tables: int, seed: int = SEED) -> np.ndarray:
    """Bucket per vector and table."""
    planes = np.random.default_rng([seed, vectors.shape[1]]).standard_normal(
        (vectors.shape[1], signs * tables))
    bits = (vectors @ planes >= 0).reshape(len(vectors), tables, signs)
    return bits @ (np.int64(1) << np.arange(signs, dtype=np.int64))


def local_components(size: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member of each member's component; a and b are the ends of the links."""
    label = np.arange(size)
    while True:
        new = label.copy()
        least = np.minimum(label[a], label[b])
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        np.minimum.at(new, label, new.copy())  # a component's old name learns its new one
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _matrix(column: pa.Array, width: int, kind: type) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=kind).reshape(-1, width)


def nodes(rows: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """doc key, label, vector of doubles and node; node is null if the row can link with nothing."""
    values = F.transform(F.col(vector), lambda x: x.cast("double"))
    usable = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = usable & F.exists(values, lambda x: x != 0) & F.col(label).isNotNull()
    cleaned = rows.select(F.col(key).alias("vec_id"), F.col(label).alias("label"),
                          values.alias("vector"), F.coalesce(usable, F.lit(False)).alias("usable"))
    return cleaned.withColumn("node", F.when(F.col("usable"), F.xxhash64("label", "vector")))


def _sums(found: DataFrame, signs: int, tables: int, cosine: float) -> DataFrame:
    """a, b, links per node and tile pair; b is the smallest node of a's component there."""
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["bucket", "low", "high"]
        held: pa.Table | None = None
        for batch in batches:
            whole = pa.Table.from_batches([batch])
            whole = whole if held is None else pa.concat_tables([held, whole])
            group = np.stack([whole[c].to_numpy() for c in names])
            edge = np.flatnonzero((group[:, 1:] != group[:, :-1]).any(axis=0)) + 1
            cuts = [0, *edge.tolist()]
            for start, stop in zip(cuts, cuts[1:], strict=False):
                yield from one(whole.slice(start, stop - start))
            held = whole.slice(cuts[-1]).combine_chunks()  # its group may go on
        if held is not None and len(held):
            yield from one(held)

    def one(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        if len(rows) < 2:
            return
        rows = rows.combine_chunks()
        node, size, tile = (rows[c].to_numpy() for c in ("node", "size", "tile"))
        low, high = rows["low"][0].as_py(), rows["high"][0].as_py()
        table = rows["number"][0].as_py()
        vectors = rows["vector"].combine_chunks()
        width = len(vectors[0])
        x = _matrix(vectors, width, np.float64)
        x = x / np.abs(x).max(axis=1, keepdims=True)  # no square overflows or vanishes
        x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
        keys = _matrix(rows["keys"].combine_chunks(), tables, np.int64)
        left, right = np.flatnonzero(tile == low), np.flatnonzero(tile == high)
        near = x[left] @ x[right].T >= cosine
        a, b = (side[i] for side, i in zip((left, right), np.nonzero(near), strict=True))
        once = node[a] < node[b] if low == high else node[a] != node[b]
        a, b = a[once], b[once]
        if not len(a):
            return
        first = np.empty(len(a), bool)  # count a pair in the first table where it meets
        for n in range(0, len(a), 1 << 16):
            s = slice(n, n + (1 << 16))
            first[s] = (keys[a[s]] == keys[b[s]]).argmax(axis=1) == table
        links = np.bincount(a[first], size[b[first]], len(node))
        links += np.bincount(b[first], size[a[first]], len(node))
        order = np.argsort(node, kind="stable")  # so that the smallest member has the least node
        place = np.empty(len(node), np.int64)
        place[order] = np.arange(len(node))
        root = order[local_components(len(node), place[a], place[b])[place]]
        told = np.unique(np.concatenate([a, b]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(node[told]), pa.array(node[root[told]]),
             pa.array(links[told].astype(np.int64))], ["a", "b", "links"])

    # Vectors of other lengths never meet: the length is part of the bucket.
    return found.mapInArrow(compare, "a long, b long, links long")


def near_vectors(rows: DataFrame, key: str = "vec_id", vector: str = "embedding",
                 label: str = "label", cosine: float = COSINE, recall: float = RECALL,
                 folder: str | None = None) -> DataFrame:
    """vec_id, n_links, component_id, kept: a row per row of the input.

    Rows link if their labels are equal and their vectors' cosine is at least `cosine`. n_links
    counts the other rows linked directly, component_id is the smallest key reachable, itself
    included, kept marks the row that has it. Null, zero or non-finite vectors, vectors with null
    components, and rows without a label link with nothing and are kept. Repeated rows link with
    each other; a null key is never a component_id unless its component has no other.
    """
    folder = folder or shared_folder(rows.sparkSession)
    base = stored(nodes(rows, key, vector, label), "vectors", folder)
    usable = base.where(F.col("node").isNotNull())
    most = usable.groupBy("label").agg(F.countDistinct("node").alias("n")).agg(F.max("n")).first()
    signs, tables = tables_for(most[0] or 0, cosine, recall)

    @F.arrow_udf("array<long>")
    def signed(vectors: pa.Array) -> pa.Array:
        width = np.asarray(vectors.value_lengths())
        out = np.zeros((len(vectors), tables), np.int64)
        start = vectors.offsets.to_numpy()[:-1]
        flat = vectors.values.to_numpy(zero_copy_only=False)
        for n in np.unique(width):
            at = np.flatnonzero(width == n)
            x = flat[start[at][:, None] + np.arange(n)]
            bits = buckets(x / np.abs(x).max(axis=1, keepdims=True), signs, tables)
            named = mixed(bits.astype(np.uint64) + np.uint64(n) * np.uint64(1 << 48))
            out[at] = mixed(named ^ np.arange(tables, dtype=np.uint64) << np.uint64(56)).view(
                np.int64)
        return pa.ListArray.from_arrays(
            pa.array(np.arange(len(vectors) + 1, dtype=np.int32) * tables), pa.array(out.ravel()))

    distinct = usable.groupBy("node").agg(
        F.first("label").alias("label"), F.first("vector").alias("vector"),
        F.count("*").alias("size"))
    distinct = stored(distinct.withColumn("keys", signed("vector")), "nodes", folder)
    members = distinct.select("node", "label", F.posexplode("keys").alias("number", "bits")).select(
        "node", "number", F.xxhash64("label", "number", "bits").alias("bucket"))
    many = members.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select(
        "bucket", F.ceil(F.col("n") / TILE).alias("tiles"))
    placed = members.join(many, "bucket").withColumn(
        "tile", F.pmod(F.xxhash64("node", F.lit(SEED)), "tiles"))
    # Tile t goes with every tile; the pair (t, t) compares t with itself.
    placed = placed.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1))
                           .alias("other"))
    placed = placed.select("node", "number", "bucket", "tile",
                           F.least("tile", "other").alias("low"),
                           F.greatest("tile", "other").alias("high"))
    grouped = placed.join(distinct.select("node", "vector", "size", "keys"), "node").repartition(
        "bucket", "low", "high").sortWithinPartitions("bucket", "low", "high")
    sums = stored(_sums(grouped, signs, tables, cosine), "sums", folder)
    linked = sums.groupBy("a").agg(F.sum("links").alias("links"))
    found = stored(components(sums.select("a", "b"), f"{folder}/components"), "found", folder)
    per_node = distinct.select("node", "size").join(
        linked.withColumnRenamed("a", "node"), "node", "left").join(found, "node", "left").select(
        "node", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"),
        F.coalesce("component", "node").alias("component"))
    told = base.select("vec_id", "node").join(per_node, "node", "left")
    least = told.where(F.col("component").isNotNull()).groupBy("component").agg(
        F.min("vec_id").alias("least"))
    return told.join(least, "component", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("least"))
        .alias("component_id"),
        F.when(F.col("node").isNull(), F.lit(True)).otherwise(
            F.col("vec_id").eqNullSafe(F.col("least"))).alias("kept"))

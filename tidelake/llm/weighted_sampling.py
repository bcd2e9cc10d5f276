"""Document fingerprints by consistent weighted sampling. DataFrame functions only.

A document is a set of weighted terms: its windows of five words, each with the number of times it
occurs; of fewer than five words, its words. For every sample and term a checksum gives r and c, drawn
from a Gamma(2, 1) distribution, and b from [0, 1); with weight w, t = floor(ln w / r + b), the term
offers c / exp(r (t - b + 1)), and the least offer is the sample. Two documents have a sample in common
with a probability equal to their generalised Jaccard similarity: the weights they share over the
weights that either has. Samples are kept as 32 bits of the least offer, which tells term and t apart.

Terms are rows only inside a task: windows are counted in arrays, exploded, and folded into one row of
minima per document where the document already is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.llm.common import stored
from tidelake.session import shared_folder

WINDOW = 5
SAMPLES = 32
BLOCK = 4096  # copies of a row that are put out at a time
_KEY = ["id", "no_id", "digest"]
_HALF = float(1 << 32)


def _unit(bits: Column) -> Column:
    """The lower 32 bits as a number in (0, 1)."""
    return (bits.bitwiseAND((1 << 32) - 1).cast("double") + 0.5) / _HALF


def offer(term: Column, log_weight: Column, sample: int) -> Column:
    """Logarithm of what a term offers for a sample; the least one of a document is kept."""
    first, second, third = (F.xxhash64(term, F.lit(3 * sample + n)) for n in range(3))
    r = -F.log(_unit(first) * _unit(F.shiftrightunsigned(first, 32)))
    c = -F.log(_unit(second) * _unit(F.shiftrightunsigned(second, 32)))
    b = _unit(third)
    return F.log(c) - r * (F.floor(log_weight / r + b).cast("double") - b + 1)


def terms(text: Column) -> Column:
    """Hashes of a text's windows of five words in order; of its words if there are fewer; of the
    empty word if there are none."""
    words = F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return F.transform(F.array(words), lambda ws: F.when(
        F.size(ws) >= WINDOW, F.transform(
            F.slice(ws, F.lit(1), F.greatest(F.size(ws) - (WINDOW - 1), F.lit(0))),
            lambda w, i: F.xxhash64(w, *[F.get(ws, i + n) for n in range(1, WINDOW)])))
        .when(F.size(ws) > 0, F.transform(ws, lambda w: F.xxhash64(w)))
        .otherwise(F.array(F.xxhash64(F.lit("")))))[0]


def fingerprints(texts: DataFrame, keys: list[str], text: str = "text",
                 samples: int = SAMPLES) -> DataFrame:
    """keys and `samples` (array of int) for every distinct combination of keys.

    Rows with equal keys must have equal texts. Null texts are empty. Where the input is already
    partitioned by some of the keys nothing moves.
    """
    named = [F.col(k) for k in keys]
    rows = texts.select(*named, terms(F.col(text)).alias("w_terms"))
    # Most texts repeat no window; only the others are sorted to count.
    rows = rows.select(*named, F.when(
        F.size(F.array_distinct("w_terms")) < F.size("w_terms"), F.sort_array("w_terms"))
        .alias("w_sorted"), "w_terms")
    starts = F.array_compact(F.transform("w_sorted", lambda t, i: F.when(
        (i == 0) | (t != F.get("w_sorted", i - 1)), i)))
    rows = rows.select(*named, F.coalesce("w_sorted", "w_terms").alias("w_terms"),
                       starts.alias("w_starts"))
    runs = F.when(F.col("w_starts").isNull(), F.size("w_terms")).otherwise(F.size("w_starts"))
    rows = rows.select(*named, "w_terms", "w_starts", F.explode(
        F.sequence(F.lit(0), runs - 1)).alias("w_n"))
    start = F.coalesce(F.get("w_starts", F.col("w_n")), F.col("w_n"))
    end = F.coalesce(F.get("w_starts", F.col("w_n") + 1), F.when(
        F.col("w_starts").isNull(), F.col("w_n") + 1).otherwise(F.size("w_terms")))
    rows = rows.select(*named, F.get("w_terms", start).alias("w_term"),
                       F.log((end - start).cast("double")).alias("w_log"))
    least = rows.groupBy(*keys).agg(*[
        F.min(offer(F.col("w_term"), F.col("w_log"), n)).alias(f"w_{n}") for n in range(samples)])
    return least.select(*named, F.array(*[F.hash(f"w_{n}") for n in range(samples)])
                        .alias("samples"))


def printed(samples: Column) -> Column:
    """A fingerprint as text, eight hexadecimal digits per sample."""
    return F.array_join(F.transform(samples, lambda s: F.lpad(F.lower(F.hex(
        s.cast("long").bitwiseAND((1 << 32) - 1))), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal samples: an estimate of the generalised Jaccard similarity."""
    same = F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda equal: equal)
    return F.size(same) / F.size(a)


def _keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    number, body = F.col(key), F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.select(number.alias("doc_id"), body.alias("body")).select(
        "doc_id", F.coalesce("doc_id", F.lit(0).cast(docs.schema[key].dataType)).alias("id"),
        F.col("doc_id").isNull().alias("no_id"), F.xxhash64("body").alias("digest"), "body")


def _neighbours(rows: DataFrame, folder: str) -> DataFrame:
    """Every distinct document with its copies and, as p_..., key and length of the one before it.

    Ascending by doc_id (null first), then by the text's hash; before the first stands the last.
    Keys and lengths alone are sorted.
    """
    spark = rows.sparkSession
    distinct = rows.groupBy(*_KEY).agg(F.count("*").alias("copies"),
                                       F.max(F.length("body")).alias("n_chars"))
    order = [F.col("no_id").desc(), F.col("id"), F.col("digest")]
    placed = stored(distinct.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "*", F.monotonically_increasing_id().alias("place")), "order", folder)
    part = F.shiftright("place", 33)
    sizes = placed.groupBy(part.alias("part")).count().orderBy("part").collect()  # a row a partition
    before, total = [], 0
    for row in sizes:
        before.append((row["part"], total))
        total += row["count"]
    starts = F.broadcast(spark.createDataFrame(before, "part long, start long"))
    ranked = placed.join(starts, part == F.col("part")).select(
        *_KEY, "copies", "n_chars",
        (F.col("start") + F.col("place").bitwiseAND((1 << 33) - 1)).alias("rank"))
    earlier = ranked.select(*[F.col(c).alias(f"p_{c}") for c in [*_KEY, "n_chars"]],
                            ((F.col("rank") + 1) % max(total, 1)).alias("rank"))
    return stored(ranked.join(earlier, "rank"), "neighbours", folder)


def edited_fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text",
                        samples: int = SAMPLES, folder: str | None = None) -> DataFrame:
    """Fingerprints of all texts, of their edited texts, and how alike they are; one row per row.

    Columns: key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.
    The edited text has its last quarter (rounded down, in code points) replaced by as many leading
    characters, or all, of the next document's text: the next by ascending key (null first), then by
    hash of the text, after the last the first. Rows that repeat in full follow each other. Null and
    empty texts are equal; texts without words have one common fingerprint. A single document follows
    itself. Columns besides key and text are ignored; an empty table gives an empty result. A text's
    windows are arrays of one row in a task, 16 bytes a word.
    """
    folder = folder or shared_folder(docs.sparkSession)
    rows = _keyed(docs, key, text)
    near = _neighbours(rows, folder)
    texts = rows.groupBy(*_KEY).agg(F.first("body").alias("body")).join(near, _KEY)
    # The next document's head goes to the document before it.
    heads = texts.select(
        *[F.col(f"p_{c}").alias(c) for c in _KEY],
        F.expr("substring(body, 1, int(p_n_chars div 4))").alias("head"))
    kept = F.expr("substring(body, 1, int(n_chars - n_chars div 4))")
    own_head = F.expr("substring(body, 1, int(n_chars div 4))")
    both = texts.join(heads, _KEY).select(
        *_KEY, F.posexplode(F.filter(F.array(
            F.col("body"), F.concat(kept, F.col("head")),
            F.when(F.col("copies") > 1, F.concat(kept, own_head))),
            lambda t: t.isNotNull())).alias("which", "body"))
    both = both.withColumn("sha", F.when(F.col("which") > 0, F.sha2("body", 256)))
    signed = fingerprints(both, [*_KEY, "which", "sha"], "body", samples)
    signed = stored(signed.groupBy(*_KEY).agg(*[
        F.max(F.when(F.col("which") == n, F.col(c))).alias(f"{c}_{n}")
        for n in range(3) for c in ("samples", "sha")]), "signed", folder)
    after = signed.join(near, _KEY).select(
        *[F.col(f"p_{c}").alias(c) for c in _KEY], F.col("samples_0").alias("samples_next"))
    found = signed.join(near.select(*_KEY, "copies", "n_chars"), _KEY).join(after, _KEY)

    def case(n: int, count: Column, following: str) -> Column:
        return F.struct(
            count.alias("rows"), F.col(f"sha_{n}").alias("edited_sha256"),
            F.col(f"samples_{n}").alias("edited"), F.col(following).alias("following"))

    # Of equal rows all but the last are followed by their like.
    cases = F.array(case(1, F.lit(1).cast("long"), "samples_next"),
                    case(2, F.col("copies") - 1, "samples_0"))
    found = found.select(
        F.when(~F.col("no_id"), F.col("id")).alias(key), F.col("n_chars").cast("long"),
        "samples_0", F.explode(cases).alias("c")).where("c.rows > 0").select(
        key, "n_chars", F.col("c.edited_sha256"), printed(F.col("samples_0")).alias("fingerprint"),
        printed(F.col("c.edited")).alias("edited_fingerprint"),
        likeness(F.col("samples_0"), F.col("c.edited")).alias("near_edited"),
        likeness(F.col("samples_0"), F.col("c.following")).alias("near_next"),
        F.col("c.rows").alias("w_rows"))
    blocks = F.sequence(F.lit(0).cast("long"), F.floor((F.col("w_rows") - 1) / BLOCK))
    found = found.select("*", F.explode(blocks).alias("w_block"))
    found = found.select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.least(
        F.lit(BLOCK).cast("long"), F.col("w_rows") - F.col("w_block") * BLOCK))).alias("w_copy"))
    return found.drop("w_rows", "w_block", "w_copy")

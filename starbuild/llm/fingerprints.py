"""Document fingerprints: bottom-k sketches of shingle hashes.

A sketch is the ascending array of the k smallest distinct 64-bit hashes of a text's five-word shingles (white-space
words, lower case; a shorter text is one shingle, a text without words has an empty sketch). The sketch of a union is
the bottom k of the sketches' union, so parts of a text set can be sketched apart and merged. As a string it is k
fixed-width hexadecimal numbers.

Defined results: two empty sketches have resemblance 1, an empty and a non-empty one 0. Null texts count as empty.
Rows of one doc_id each keep their own row; the order among them is that of their text's hash. A null doc_id comes
last in descending order. Empty tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starbuild.llm.common import let, materialize, shingle_hashes

K = 128
#: Hashes are signed; this is added to bring them to 0 .. 2^64.
HALF = float(2**63)


def words_of(text: Column) -> Column:
    trimmed = F.btrim(F.lower(text), F.lit(" \t\n\x0b\f\r"))
    return let(
        trimmed,
        lambda t: F.when(F.length(t) > 0, F.split(t, r"[\x20\x09-\x0D]+")).otherwise(F.array().cast("array<string>")),
    )


def sketch(text: Column, k: int = K) -> Column:
    """The k smallest distinct shingle hashes of `text`, ascending."""
    hashes = let(words_of(F.coalesce(text, F.lit(""))), lambda words: shingle_hashes(words))
    return F.slice(F.array_sort(F.array_distinct(hashes)), 1, k)


def merged(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of the union of what `a` and `b` sketch."""
    return F.slice(F.array_sort(F.array_union(a, b)), 1, k)


def merge_groups(sketches: DataFrame, keys: list[str], column: str = "sketch", k: int = K) -> DataFrame:
    """One sketch for each group of sketches. Ranks a group's hashes; parts are cut before they meet, so no
    group is gathered: at most k hashes of each of a bounded number of parts reach the last step."""
    hashes = sketches.select(*keys, F.explode(column).alias("hash"))
    parts = hashes.withColumn("part", F.pmod(F.xxhash64("hash"), F.lit(64))).distinct()
    inner = Window.partitionBy(*keys, "part").orderBy("hash")
    cut = parts.withColumn("n", F.row_number().over(inner)).where(F.col("n") <= k)
    return cut.groupBy(*keys).agg(F.slice(F.array_sort(F.collect_list("hash")), 1, k).alias(column))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard likeness: the share of the union's bottom k that both sketches hold."""
    both = let(
        merged(a, b, k), lambda u: F.size(F.array_intersect(u, F.array_intersect(a, b))) / F.greatest(F.size(u), F.lit(1))
    )
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(both)


def distinct_count(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles: exact below k, else from how dense the k smallest hashes lie."""
    spread = (F.element_at(a, k).cast("double") + HALF) / (2 * HALF)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / spread)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has."""
    union = distinct_count(merged(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(
        F.least(F.lit(1.0), resemblance(a, b, k) * union / F.greatest(distinct_count(a, k), F.lit(1.0)))
    )


def as_text(sketched: Column) -> Column:
    return F.array_join(F.transform(sketched, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def neighbours(docs: DataFrame) -> DataFrame:
    """For each distinct (doc_id, row_key), descending: the next one, the one before, and the length of the one before.

    Only ids and lengths are ordered. Each range partition is a window of its own; the first and last row of each
    partition come to the driver, to close the gaps. What follows the last row is the first.
    """
    spark = docs.sparkSession
    order = [F.col("doc_id").desc_nulls_last(), F.col("row_key").desc()]
    keys = docs.select("doc_id", "row_key", "n_chars").dropDuplicates(["doc_id", "row_key"])
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = materialize(keys.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()))
    inside = Window.partitionBy("part").orderBy(*order)
    row = F.struct("doc_id", "row_key", "n_chars").alias("row")
    numbered = keys.select(
        "part", row, F.lead(row).over(inside).alias("after"), F.lag(row).over(inside).alias("before")
    )
    ends = numbered.where("after is null or before is null").collect()
    heads = {r["part"]: r["row"] for r in ends if r["before"] is None}
    tails = {r["part"]: r["row"] for r in ends if r["after"] is None}
    ring = sorted(heads)
    edges = [(p, heads[ring[(i + 1) % len(ring)]], tails[ring[i - 1]]) for i, p in enumerate(ring)]
    kind = numbered.schema["row"].dataType.simpleString()
    edge = spark.createDataFrame(edges, f"part int, head {kind}, tail {kind}")
    return numbered.join(F.broadcast(edge), "part").select(
        "row.doc_id",
        "row.row_key",
        F.coalesce("after", "head").alias("next"),
        F.coalesce("before", "tail").alias("previous"),
    )


def fingerprint_edits(docs: DataFrame, k: int = K) -> DataFrame:
    """Fingerprints of every text, of its edited form and of the next document, and their likeness.

    The edited text has its last third replaced by the beginning of the next document (descending doc_id).
    """
    text = F.coalesce("text", F.lit(""))
    kind = docs.schema["doc_id"].dataType

    def key(doc_id: str) -> list[Column]:
        # without nulls, all three joins can use one partitioning
        return [F.coalesce(F.col(doc_id), F.lit("0").cast(kind)).alias("id"), F.col(doc_id).isNull().alias("no_id")]

    on = ["id", "no_id", "row_key"]
    rows = docs.select("doc_id", F.xxhash64(text).alias("row_key"), text.alias("text"))
    near = neighbours(rows.withColumn("n_chars", F.length("text"))).select(*key("doc_id"), "row_key", "next", "previous")
    # read twice below with the same columns, so that the texts are moved once
    placed = rows.select(*key("doc_id"), "row_key", "text").join(near, on)
    heads = placed.select(
        *key("previous.doc_id"),
        "previous.row_key",
        F.substring("text", F.lit(1), F.floor(F.col("previous.n_chars") / 3).cast("int")).alias("head"),
        sketch(F.col("text"), k).alias("next_sketch"),
    ).dropDuplicates(on)
    both = placed.select(*on, "text").join(heads, on)
    n = F.length("text")
    edited = F.concat(F.substring("text", F.lit(1), n - F.floor(n / 3).cast("int")), F.col("head"))
    doc_id = F.when(~F.col("no_id"), F.col("id")).alias("doc_id")
    sketched = both.select(doc_id, "text", edited.alias("edited"), "next_sketch").select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        sketch(F.col("text"), k).alias("own"),
        sketch(F.col("edited"), k).alias("changed"),
        "next_sketch",
    )
    return sketched.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text(F.col("own")).alias("fingerprint"),
        as_text(F.col("changed")).alias("edited_fingerprint"),
        resemblance(F.col("own"), F.col("changed"), k).alias("near_edited"),
        resemblance(F.col("own"), F.col("next_sketch"), k).alias("near_next"),
    )

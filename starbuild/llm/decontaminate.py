"""Benchmark decontamination: which documents contain a test item, by size-partitioned MinHash containment search.

Words are runs of letters and digits in lower case, shingles are runs of five words. A document contains an item when
it has at least 80 % of the item's distinct shingles.

Items are far shorter than documents, so equal-length MinHash signatures would miss most of them. Here the two
sides have sketches of different kinds under one hash order:

* an item of q shingles keeps its k smallest hashes, k = q - ceil(0.8 q) + 1. Whatever contains the item has at least
  one of these k, so no match is lost (a document that lacks all k lacks more than a fifth);
* documents are partitioned by size. For each power of two the largest k-th hash of the items that can be contained in a
  document of that size is known (at most 32 numbers); a document keeps its hashes up to its partition's number.

Equal hashes give candidates. They are verified by the exact shingles, looked for in the document as strings.

Defined results: an item with fewer than five words is looked for as a run of that many words; items and documents
without words match nothing, nor do null texts. Items with equal shingle sets are searched once and reported each.
Null ids match as any value but are not reported. Rows of one doc_id are judged each on its own, and a pair is
reported once, with its best containment. Empty tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starbuild.llm.common import SHINGLE_WORDS, SIMILARITY_PERCENT, let, materialize, shingle_hashes

#: Sketch rows up to which the items' sketch is broadcast: about 40 MB.
BROADCAST_ROWS = 1_000_000


def words_of(text: Column) -> Column:
    return let(
        F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"),
        lambda w: F.slice(
            w,
            F.when(w[0] == "", 2).otherwise(1),
            F.greatest(
                F.size(w)
                - F.when(w[0] == "", 1).otherwise(0)
                - F.when((F.size(w) > 1) & (F.element_at(w, -1) == ""), 1).otherwise(0),
                F.lit(0),
            ),
        ),
    )


def plain(text: Column) -> Column:
    """The words of `text`, each between spaces: it holds a run of words exactly when the run, between spaces, is part of it."""
    return F.concat(F.lit(" "), F.array_join(words_of(text), " "), F.lit(" "))


def runs_of(words: Column, width: Column | int) -> Column:
    """The distinct runs of `width` words, as strings."""
    return F.when(
        F.size(words) >= width,
        F.array_distinct(
            F.transform(
                F.sequence(F.lit(1), F.size(words) - width + 1), lambda i: F.concat_ws(" ", F.slice(words, i, width))
            )
        ),
    ).otherwise(F.array().cast("array<string>"))


def item_sets(items: DataFrame) -> DataFrame:
    """set_id (smallest item_id with these shingles), item_id, width, shingles, q, need of every item with words."""
    words = items.select("item_id", words_of(F.col("text")).alias("words")).where(
        (F.size("words") > 0) & F.col("item_id").isNotNull()
    )
    width = F.least(F.size("words"), F.lit(SHINGLE_WORDS))
    sets = words.select("item_id", width.alias("width"), F.array_sort(runs_of(F.col("words"), width)).alias("shingles"))
    q = F.size("shingles")
    return sets.select(
        F.min("item_id").over(Window.partitionBy("shingles")).alias("set_id"),
        "item_id",
        "width",
        "shingles",
        q.alias("q"),
        F.ceil(q * SIMILARITY_PERCENT / 100).cast("int").alias("need"),
    ).distinct()


def size_class(size: Column) -> Column:
    return F.floor(F.log2(F.greatest(size, F.lit(1)))).cast("int")


def hash_run(run: Column) -> Column:
    """The hash `shingle_hashes` gives to a run of words, from the run as a string."""
    return let(F.split(run, " "), lambda w: shingle_hashes(w)[0])


def item_sketch(sets: DataFrame) -> DataFrame:
    """set_id, width, need, hash: the smallest q - need + 1 hashes of each distinct item."""
    once = sets.where("item_id = set_id")
    return once.select(
        "set_id",
        "width",
        "need",
        F.explode(
            F.slice(
                F.array_sort(F.transform("shingles", hash_run)), F.lit(1), F.col("q") - F.col("need") + 1
            )
        ).alias("hash"),
    )


def document_hashes(words: Column, width: int) -> Column:
    """Hashes of the document's runs of `width` words, equal to `hash_run` of the same run."""
    if width == SHINGLE_WORDS:
        return F.when(F.size(words) >= width, shingle_hashes(words)).otherwise(F.array().cast("array<bigint>"))
    return F.transform(runs_of(words, width), hash_run)


def contaminated(docs: DataFrame, items: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """doc_id, item_id, n_item_shingles, n_shared, containment of every contained item. Native expressions only."""
    sets = materialize(item_sets(items))
    sketch = materialize(item_sketch(sets))
    # For each width and power of two: the largest hash that any item of that size or less keeps.
    rows = sketch.groupBy("width", size_class(F.col("need")).alias("size")).agg(
        F.max("hash").alias("top"), F.count("*").alias("n")
    ).collect()
    small = sum(r["n"] for r in rows) <= broadcast_rows
    tops: dict[int, list[int]] = {}
    for r in rows:
        top = tops.setdefault(r["width"], [-(2**63)] * 32)
        top[r["size"] :] = [max(x, r["top"]) for x in top[r["size"] :]]

    texts = docs.where(F.col("doc_id").isNotNull()).select(
        "doc_id", F.xxhash64("text").alias("row_key"), words_of(F.col("text")).alias("words")
    )

    def kept(width: int, top: list[int]) -> Column:
        bound = F.array(*[F.lit(x) for x in top])[size_class(F.size("words"))]
        return let(bound, lambda b: F.filter(document_hashes(F.col("words"), width), lambda h: h <= b))

    found = None
    for width, top in sorted(tops.items()):
        probes = texts.select(
            "doc_id", "row_key", F.size("words").alias("n_words"), F.explode_outer(kept(width, top)).alias("hash")
        )
        side = sketch.where(F.col("width") == width)
        side = F.broadcast(side) if small else side
        part = probes.join(side, "hash").where(F.col("n_words") - width + 1 >= F.col("need"))
        found = part if found is None else found.union(part)
    if found is None:
        kinds = f"doc_id {dict(docs.dtypes)['doc_id']}, item_id {dict(items.dtypes)['item_id']}"
        return docs.sparkSession.createDataFrame([], f"{kinds}, n_item_shingles int, n_shared long, containment double")
    candidates = materialize(found.select("doc_id", "row_key", "set_id", "width").distinct())

    wanted = candidates.select("doc_id", "row_key").distinct()
    texts = docs.select("doc_id", F.xxhash64("text").alias("row_key"), "text").join(wanted, ["doc_id", "row_key"])
    texts = texts.select("doc_id", "row_key", plain(F.col("text")).alias("plain"))
    item_runs = sets.where("item_id = set_id").select(
        "set_id", "q", "need", F.transform("shingles", lambda s: F.concat(F.lit(" "), s, F.lit(" "))).alias("runs")
    )
    item_runs = F.broadcast(item_runs) if small else item_runs
    n_shared = F.size(F.filter("runs", lambda run: F.contains(F.col("plain"), run))).cast("long")
    shared = (
        texts.join(candidates, ["doc_id", "row_key"])
        .join(item_runs, "set_id")
        .select("doc_id", "set_id", "q", "need", n_shared.alias("n_shared"))
        .where("n_shared >= need")
        .groupBy("doc_id", "set_id", "q")
        .agg(F.max("n_shared").alias("n_shared"))
    )
    members = sets.select("set_id", "item_id")
    members = F.broadcast(members) if small else members
    return shared.join(members, "set_id").select(
        "doc_id",
        "item_id",
        F.col("q").alias("n_item_shingles"),
        "n_shared",
        (F.col("n_shared") / F.col("q")).alias("containment"),
    )


def without_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of `docs` whose text contains no item, all columns as they were.

    Rows are judged by their text alone, so it does not matter whether they have a doc_id, or share it.
    """
    key = F.sha2("text", 256)
    texts = docs.where(F.col("text").isNotNull()).select(key.alias("doc_id"), "text")
    leaks = contaminated(texts, items).select(F.col("doc_id").alias("_leak")).distinct()
    return docs.join(leaks, key == F.col("_leak"), "left_anti")


def _words_sql(key: str, source: str) -> str:
    return (
        f"SELECT {key}, [x FOR x IN regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{N}}]+') IF x <> ''] AS words "
        f"FROM {source} WHERE {key} IS NOT NULL"
    )


#: The same rows by brute force, for DuckDB: all shingles of all documents against those of all items.
ORACLE_SQL = f"""
WITH d AS MATERIALIZED ({_words_sql("doc_id", "documents")}),
i AS MATERIALIZED (SELECT item_id, words, least(len(words), {SHINGLE_WORDS}) AS width FROM ({_words_sql("item_id", "benchmark")}) w WHERE len(words) > 0),
wanted AS MATERIALIZED (
  SELECT DISTINCT item_id, width, array_to_string(words[pos : pos + width - 1], ' ') AS run
  FROM (SELECT *, unnest(range(1, len(words) - width + 2)) AS pos FROM i) r
),
sizes AS (SELECT item_id, count(*) AS q FROM wanted GROUP BY item_id),
held AS (
  SELECT DISTINCT doc_id, width, array_to_string(words[pos : pos + width - 1], ' ') AS run
  FROM (SELECT doc_id, words, width, unnest(range(1, len(words) - width + 2)) AS pos
        FROM d, (SELECT DISTINCT width FROM wanted) k WHERE len(words) >= width) r
),
shared AS (SELECT doc_id, item_id, count(*) AS n_shared FROM held JOIN wanted USING (width, run) GROUP BY ALL)
SELECT doc_id, item_id, CAST(q AS INTEGER) AS n_item_shingles, n_shared, n_shared / q AS containment
FROM shared JOIN sizes USING (item_id) WHERE 100 * n_shared >= {SIMILARITY_PERCENT} * q
"""

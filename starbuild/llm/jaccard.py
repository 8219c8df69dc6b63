"""N-gram Jaccard self-join by grouped prefixes, and the components of its links.

Words are `[^\\x20\\x09-\\x0D]+` with A-Z in lower case; a document is the set of its distinct five-word shingles, as 64-bit
hashes (fewer words: the whole sequence as one). Two documents link at a Jaccard likeness of 0.8 or more.

1. *Order.* Hashes that many documents share are found exactly (each task counts its own, counts meet by range of
   hashes) and come last in a global order, commonest at the very end. The order steers speed only, never results.
2. *Prefix.* A linked pair shares one of the first n - ceil(0.8 n) + 1 hashes of either document.
3. *Groups.* Equal sets fall together first. Then documents with identical prefix and size are one group, and only groups
   are indexed under their prefix hashes.
4. *Chain and pivots.* In each list of the index, and in each group, neighbours by size are compared exactly and linked;
   then, a few times over, all members of a list with one of them.
5. *Rest.* Lists and groups that still hold more than one component: group pairs across components are filtered by size, by
   how often they meet early in their prefixes (after each shared hash, either set must have room for all others that a
   linked pair shares) and by how many prefix hashes they share, then expanded to members and compared. A linked pair is either found
   here or already connected, so components lose nothing, while a group of thousands of near copies costs about its length
   and not its square.

Defined results: null, empty and blank texts have size 0 and are linked with nothing. doc_id is the identity: rows with
one doc_id are one node, linked by any of their texts; each keeps its own row and size. A null doc_id is linked
with nothing and its component is null. Empty tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starbuild.llm.common import SHINGLE_WORDS, SIMILARITY_PERCENT, materialize, ship
from starbuild.llm.graph import components
from starbuild.operators.numbering import surrogate_key
from starbuild.operators.skew import skew_join
from starbuild.session import materialize_counted

#: Hashes known as common. Bounds the table each task holds (16 bytes each); the others keep their place by value.
COMMON_HASHES = 200_000
COMMON_FROM = 16
#: Leading bits of a hash that are counted; hashes that share them are common together, which only changes their place.
COUNTED_BITS = 40
FLUSH = 3_000_000
#: Ids up to which they are broadcast to the documents, to select the texts of candidates: about 30 MB.
BROADCAST_IDS = 1_000_000
#: Rounds in which the members of each list are compared with one of them.
PIVOT_ROUNDS = 1
#: Likeliest partners that a document is compared with first in each other component.
BEST_PARTNERS = 2
#: A pair is worth a comparison in these rounds when it meets in so many of the lists it must share.
PIVOT_SHARE = 4
#: Shared hashes by which group pairs are found.
EARLY_MEETINGS = 4
WORD_CACHE = 500_000
SLICE = 100
WEIGHTS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


HASHES = WordHashes()


def shingles(text: str) -> np.ndarray:
    """Ascending distinct hashes of the text's shingles."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < SHINGLE_WORDS:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], np.uint64)
    one = np.fromiter(map(HASHES.__getitem__, words), np.uint64, len(words))
    n = len(words) - SHINGLE_WORDS + 1
    out = one[:n] * WEIGHTS[0]
    for i in range(1, SHINGLE_WORDS):
        out = (out ^ (out >> np.uint64(29))) * WEIGHTS[i] + one[i : i + n]
    out = (out ^ (out >> np.uint64(32))) * WEIGHTS[0]
    return np.unique(out ^ (out >> np.uint64(29)))


def in_slices(batch: pa.RecordBatch, *columns: str) -> Iterator[tuple]:
    """The rows of a batch; only SLICE of them at a time are Python objects."""
    for at in range(0, batch.num_rows, SLICE):
        part = batch.slice(at, SLICE)
        yield from zip(*(part.column(c).to_pylist() for c in columns), strict=True)


def needed(n: int) -> int:
    """The smallest overlap with a linked document."""
    return (SIMILARITY_PERCENT * n + 99) // 100


def linked(both: int, a: int, b: int) -> bool:
    return 100 * both >= SIMILARITY_PERCENT * (a + b - both)


def planes(ascending: np.ndarray) -> bytes:
    """Steps between ascending numbers, byte by byte of significance: the upper bytes are nearly all 0 and shrink."""
    steps = np.diff(ascending, prepend=np.uint64(0))
    return np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes()


def from_planes(held: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(held, np.uint8).reshape(8, -1).T).view(np.uint64).ravel(), dtype=np.uint64)


def common_hashes(docs: DataFrame, bound: int = COMMON_HASHES) -> pd.DataFrame:
    """lead, n: the leading bits of the hashes in the most documents (at least COMMON_FROM), as many as `bound`."""
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            value, n = np.unique(np.concatenate(held), return_counts=True)
            bucket = (value * np.uint64(buckets)) >> np.uint64(COUNTED_BITS)
            cuts = np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))
            spans = [(i, a, b) for i, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]
            low, high = (n & 0xFF).astype(np.uint8), (n >> 8).astype("<u4")
            columns = {
                "bucket": pa.array([i for i, *_ in spans], pa.int32()),
                "leads": pa.array([planes(value[a:b]) for _, a, b in spans], pa.binary()),
                "counts": pa.array([low[a:b].tobytes() for _, a, b in spans], pa.binary()),
                "more": pa.array([high[a:b].tobytes() if high[a:b].any() else b"" for _, a, b in spans], pa.binary()),
            }
            return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

        for batch in batches:
            for (text,) in in_slices(batch, "text"):
                own = shingles(text) >> np.uint64(64 - COUNTED_BITS)
                held.append(own)
                size += len(own)
                if size >= FLUSH:
                    yield flush()
                    held, size = [], 0
        if size:
            yield flush()

    def summed(part: pd.DataFrame) -> pd.DataFrame:
        value = np.concatenate([from_planes(x) for x in part["leads"]])
        n = np.concatenate([np.frombuffer(x, np.uint8) for x in part["counts"]]).astype(np.int64)
        at = 0
        for more, low in zip(part["more"], part["counts"], strict=True):
            if more:
                n[at : at + len(low)] += np.frombuffer(more, "<u4").astype(np.int64) << 8
            at += len(low)
        order = np.argsort(value, kind="stable")
        value, n = value[order], n[order]
        first = np.flatnonzero(np.r_[True, value[1:] != value[:-1]]) if len(value) else np.empty(0, int)
        n = np.add.reduceat(n, first) if len(first) else n
        often = n >= COMMON_FROM
        return pd.DataFrame({"lead": value[first][often].astype(np.int64), "n": n[often]})

    parts = docs.select("text").mapInArrow(counted, "bucket int, leads binary, counts binary, more binary")
    often = parts.groupBy("bucket").applyInPandas(summed, "lead long, n long")
    return often.orderBy(F.desc("n"), "lead").limit(bound).toPandas()


def prefixes(docs: DataFrame, common: pd.DataFrame) -> DataFrame:
    """doc_id, n, sig (of the set), prefix_sig, prefix of every row."""
    value = common["lead"].to_numpy(np.int64).astype(np.uint64)
    by_value = np.argsort(value)
    value, often = value[by_value], common["n"].to_numpy(np.int64)[by_value]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for (text,) in in_slices(batch, "text"):
                own = shingles(text)
                n = len(own)
                if not n:
                    rows.append((0, b"", b"", []))
                    continue
                sig = xxhash.xxh3_128_digest(own.tobytes())
                keep = n - needed(n) + 1
                if len(value):
                    lead = own >> np.uint64(64 - COUNTED_BITS)
                    at = np.minimum(np.searchsorted(value, lead), len(value) - 1)
                    rank = np.where(value[at] == lead, often[at], 0)
                    if rank.any():
                        own = own[np.argsort(rank, kind="stable")]
                own = own[:keep]
                rows.append((n, sig, xxhash.xxh3_128_digest(own.tobytes()), own.view(np.int64)))
            kinds = pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64())
            columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds, strict=True)] if rows else [pa.array([], k) for k in kinds]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "n", "sig", "prefix_sig", "prefix"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.mapInArrow(cut, f"doc_id {kind}, n long, sig binary, prefix_sig binary, prefix array<long>")


def verified(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The stored `pairs` (a, b) of doc_ids whose texts link; `docs` may have several rows of one doc_id.

    Only the texts of these pairs are moved: the ids select them, at the scan where they are few.
    """
    kind = dict(pairs.dtypes)["a"]
    ids, counts = materialize_counted(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct())
    if not counts["rows"]:
        return pairs.select("a", "b")
    texts = docs.join(F.broadcast(ids) if counts["rows"] <= BROADCAST_IDS else ids, "doc_id", "left_semi")
    left = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("left")), "a")
    both = left.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("right")), "b")
    both = both.select("a", "b", "left", "right")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits = []
            for x, y in in_slices(batch, "left", "right"):
                p, q = shingles(x), shingles(y)
                hits.append(linked(len(np.intersect1d(p, q, assume_unique=True)), len(p), len(q)))
            yield batch.select(["a", "b"]).filter(pa.array(hits, pa.bool_()))

    return both.mapInArrow(compared, f"a {kind}, b {kind}").distinct()


def sizes_fit(a: Column | str, b: Column | str) -> Column:
    a, b = F.col(a), F.col(b)
    return (100 * F.least(a, b) >= SIMILARITY_PERCENT * F.greatest(a, b)) & (F.least(a, b) > 0)


def shared_least(a: Column | str, b: Column | str) -> Column:
    """How many hashes the prefixes of linked sets of these sizes share at least.

    Up to the end of the prefix that ends first in the order, shared hashes are in both prefixes; after it that set has
    only ceil(0.8 n) - 1 hashes left.
    """
    larger = F.greatest(F.col(a), F.col(b))
    return F.greatest(overlap(a, b) - F.ceil(SIMILARITY_PERCENT * larger / 100) + 1, F.lit(1))


def neighbours(rows: DataFrame, key: list[str]) -> DataFrame:
    """Pairs a < b of rows that stand side by side under `key`, by size, with their sizes."""
    window = Window.partitionBy(*key).orderBy("n", "id")
    side = rows.select("id", "n", F.lag("id").over(window).alias("other"), F.lag("n").over(window).alias("m"))
    side = side.where(F.col("other").isNotNull() & (F.col("other") != F.col("id")) & sizes_fit("n", "m"))
    return side.select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b"), "n", "m")


def overlap(a: Column | str, b: Column | str) -> Column:
    """How many hashes linked sets of these sizes share at least."""
    return F.ceil(SIMILARITY_PERCENT * (F.col(a) + F.col(b)) / (100 + SIMILARITY_PERCENT))


def early(place: str, n: str, shared: Column, nth: Column) -> Column:
    """Whether a hash at this place of a set can be one of the first `nth` hashes that it shares with another one.

    All others of the `shared` hashes come after it.
    """
    return F.col(place) <= F.col(n) - shared + nth - 1


def relabelled(labels: DataFrame, more: DataFrame) -> DataFrame:
    """`labels` (node, component) after the links `more` (a, b) are added: only components that these connect are looked at."""
    at = labels.select(F.col("node").alias("a"), F.col("component").alias("u"))
    ends = more.join(at, "a", "left").join(at.withColumnsRenamed({"a": "b", "u": "v"}), "b", "left")
    ends = materialize(ends.select("a", "b", F.coalesce("u", "a").alias("u"), F.coalesce("v", "b").alias("v")))
    new = ends.select(F.col("a").alias("node")).union(ends.select("b")).distinct().join(labels, "node", "left_anti")
    known = labels.select("node", "component").union(new.select("node", F.col("node").alias("component")))
    joined = components(ends.select("u", "v")).select(F.col("node").alias("component"), F.col("component").alias("to"))
    return materialize(known.join(joined, "component", "left").select("node", F.coalesce("to", "component").alias("component")))


def join_labels(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(members, labels). members: doc_id, n, sig and head (the smallest doc_id with the same set) of every row;
    labels: node and component of every head that has links."""
    ship(docs.sparkSession)
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    prefixed = materialize(prefixes(docs, common_hashes(docs)))
    named = prefixed.where("doc_id is not null and n > 0")
    heads = named.groupBy("sig").agg(
        F.min("doc_id").alias("head"), F.first("n").alias("n"), F.first("prefix_sig").alias("prefix_sig")
    )
    heads = materialize(heads)
    members = prefixed.select("doc_id", "n", "sig").join(heads.select("sig", "head"), "sig", "left")

    groups = heads.groupBy("prefix_sig", "n").agg(F.min("head").alias("id"))
    in_groups = materialize(heads.join(groups, ["prefix_sig", "n"]).select("id", "n", "head"))
    # One row of each group brings its prefix along.
    heads_of = groups.select(F.col("id").alias("doc_id"), F.col("prefix_sig").alias("own_sig"))
    once = named.select("doc_id", "n", "prefix_sig", "prefix").join(heads_of, "doc_id").where("prefix_sig = own_sig")
    once = once.select(F.col("doc_id").alias("id"), F.col("n").cast("int").alias("n"), "prefix")
    shared = Window.partitionBy("hash")
    entries = once.select("id", "n", F.posexplode("prefix").alias("place", "hash"))
    lists = materialize(entries.withColumn("size", F.count("*").over(shared)).where("size > 1").drop("size"))

    # A pair that is side by side in few of its lists is left to the last step, which decides exactly.
    beside = neighbours(lists, ["hash"]).groupBy("a", "b").agg(
        F.count("*").alias("lists"), F.max("n").alias("n"), F.max("m").alias("m")
    )
    beside = beside.where(PIVOT_SHARE * F.col("lists") >= shared_least("n", "m")).select("a", "b")
    within = neighbours(in_groups.select(F.col("id").alias("group"), F.col("head").alias("id"), "n"), ["group", "n"])
    first = materialize(beside.union(within.select("a", "b")).distinct())
    links = materialize(verified(first, docs))
    labels = materialize(components(links.select(F.col("a").alias("u"), F.col("b").alias("v"))))
    for turn in range(PIVOT_ROUNDS):
        own = lists.join(labels.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
        pivots = own.groupBy("hash").agg(
            F.min(F.struct(F.xxhash64("id", F.lit(turn)), "id", "n", "component")).alias("pivot"),
            (F.min("component") < F.max("component")).alias("mixed"),
        )
        met = own.join(pivots.where("mixed").select("hash", "pivot"), "hash").select(
            F.least("id", "pivot.id").alias("a"),
            F.greatest("id", "pivot.id").alias("b"),
            "n",
            F.col("pivot.n").alias("m"),
            (F.col("component") != F.col("pivot.component")).alias("apart"),
        )
        met = met.where("apart").where(sizes_fit("n", "m")).groupBy("a", "b").agg(
            F.count("*").alias("lists"), F.max("n").alias("n"), F.max("m").alias("m")
        )
        met = met.where(PIVOT_SHARE * F.col("lists") >= shared_least("n", "m")).select("a", "b")
        more = materialize(verified(materialize(met), docs))
        if more.isEmpty():
            break
        labels = relabelled(labels, more)
    placed = in_groups.join(labels, F.col("head") == F.col("node"), "left").select(
        "id", "n", "head", F.coalesce("component", "head").alias("component")
    )
    placed = materialize(placed)
    # Groups that meet in lists that still hold several components.
    groups = placed.groupBy("id", "n").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    listed = lists.join(groups, ["id", "n"])
    mixed = listed.groupBy("hash").agg(F.min("low").alias("least"), F.max("high").alias("most")).where("least <> most")
    open_lists = materialize(listed.join(mixed.select("hash"), "hash"))
    other = open_lists.select("hash", *[F.col(c).alias(f"{c}_2") for c in ("id", "n", "place", "low", "high")])
    least = shared_least("n", "n_2")
    # The first few hashes that a linked pair shares stand early in both prefixes: it meets so often there.
    nth = F.least(least, F.lit(EARLY_MEETINGS))
    shared_all = overlap("n", "n_2")
    met = open_lists.join(other, "hash").where(
        (F.col("id") < F.col("id_2"))
        & sizes_fit("n", "n_2")
        & early("place", "n", shared_all, nth)
        & early("place_2", "n_2", shared_all, nth)
        & ((F.col("low") != F.col("high")) | (F.col("low_2") != F.col("high_2")) | (F.col("low") != F.col("low_2")))
    )
    met = met.groupBy("id", "n", "id_2", "n_2").agg(F.count("*").alias("meetings")).where(F.col("meetings") >= nth)
    # What they share of their whole prefixes filters group pairs, before members are looked at.
    first_prefix, second_prefix = once.select("id", "prefix"), once.select(F.col("id").alias("id_2"), F.col("prefix").alias("prefix_2"))
    both = met.join(first_prefix, "id").join(second_prefix, "id_2")
    both = both.withColumn("lists", F.size(F.array_intersect("prefix", "prefix_2"))).where(F.col("lists") >= least)
    sides = "head", "component", "head_2", "component_2"
    second = placed.select(F.col("id").alias("id_2"), F.col("n").alias("n_2"), F.col("head").alias("head_2"), F.col("component").alias("component_2"))
    rest = both.select("id", "n", "id_2", "n_2", "lists").join(placed, ["id", "n"]).join(second, ["id_2", "n_2"])
    rest = rest.where("component <> component_2").select(*sides, "lists")
    split = groups.where("low <> high").select("id", "n")
    same = placed.join(split, ["id", "n"])
    inner = same.select("id", "n", F.col("head").alias("head_2"), F.col("component").alias("component_2"))
    inside = same.join(inner, ["id", "n"]).where("component < component_2").select(*sides, F.lit(1).alias("lists"))
    rest = materialize(rest.union(inside))
    ends = F.least("head", "head_2").alias("a"), F.greatest("head", "head_2").alias("b")
    # The likeliest partners first: most documents are connected by them, and need no other comparison.
    best = F.row_number().over(Window.partitionBy("head", "component_2").orderBy(F.desc("lists"), "head_2"))
    back = F.row_number().over(Window.partitionBy("head_2", "component").orderBy(F.desc("lists"), "head"))
    near = rest.withColumn("best", best).where(F.col("best") <= BEST_PARTNERS).select(*ends)
    near = near.union(rest.withColumn("best", back).where(F.col("best") <= BEST_PARTNERS).select(*ends)).distinct()
    near = materialize(near)
    labels = relabelled(labels, materialize(verified(near, docs)))
    apart = (
        rest.select("head", "head_2")
        .join(labels.select(F.col("node").alias("head"), F.col("component").alias("c")), "head", "left")
        .join(labels.select(F.col("node").alias("head_2"), F.col("component").alias("c_2")), "head_2", "left")
        .where(~F.coalesce("c", "head").eqNullSafe(F.coalesce("c_2", "head_2")))
        .select(*ends)
        .distinct()
    )
    more = verified(materialize(apart.join(near, ["a", "b"], "left_anti")), docs)
    # A doc_id with several sets connects them.
    several = named.groupBy("doc_id").agg(F.count_distinct("sig").alias("sets")).where("sets > 1").select("doc_id")
    own_sets = members.where("head <> doc_id").join(several, "doc_id", "left_semi")
    more = more.union(own_sets.select(F.col("doc_id").alias("a"), F.col("head").alias("b")))
    return members, relabelled(labels, materialize(more))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of `docs` (doc_id, text)."""
    members, labels = join_labels(docs)
    kind = dict(docs.dtypes)["doc_id"]
    return members.join(labels, F.col("head") == F.col("node"), "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("component", "head", "doc_id").cast(kind).alias("component_id"),
    )


def first_of_each(docs: DataFrame) -> DataFrame:
    """The rows of `docs` (doc_id long, text), one for each group of near duplicates: the one with the smallest doc_id.

    Rows are judged one by one. Where several rows share a doc_id, or have none, each different text is a document of its own,
    numbered behind the largest doc_id in the order of doc_id (nulls first) and text hash; rows that agree in both count once. Rows without
    words are linked with nothing and all stay.
    """
    shared = docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 or doc_id is null").select(F.col("doc_id").alias("_id"))
    shared = materialize(shared)
    if shared.isEmpty():
        keep = near_duplicates(docs).where("component_id = doc_id").select(F.col("doc_id").alias("_keep"))
        return docs.join(keep, F.col("doc_id") == F.col("_keep"), "left_semi")
    if docs.schema["doc_id"].dataType.simpleString() != "bigint":
        raise ValueError("rows that share a doc_id can only be told apart where it is a long")
    same = docs["doc_id"].eqNullSafe(shared["_id"])
    alone = docs.join(shared, same, "left_anti").withColumn("_node", F.col("doc_id"))
    text = F.sha2(F.coalesce("text", F.lit("")), 256)
    several = docs.join(shared, same, "left_semi").withColumn("_key", F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("none")), text))
    numbers = surrogate_key(several.select("doc_id", "_key").distinct(), "_node", ["doc_id", "_key"], "bigint")
    last = docs.agg(F.max("doc_id")).first()[0] or 0
    numbers = numbers.select("_key", (F.col("_node") + F.lit(last).cast("bigint")).alias("_node"))
    several = skew_join(several, numbers, ["_key"]).drop("_key")
    rows = alone.unionByName(several)
    found = near_duplicates(rows.select(F.col("_node").alias("doc_id"), "text")).where("component_id = doc_id")
    found = materialize(found.select(F.col("doc_id").alias("_keep"), (F.col("n_shingles") > 0).alias("_words")).distinct())
    # several copies of one row: one of them stays, unless it has no words
    kept = several.join(found, F.col("_node") == F.col("_keep"))
    once = kept.where("_words").dropDuplicates(["_node"]).unionByName(kept.where("not _words"))
    first = alone.join(found, F.col("_node") == F.col("_keep"), "left_semi")
    return first.select(*docs.columns).unionByName(once.select(*docs.columns))


#: The same rows by brute force, for DuckDB: all pairs that share a shingle, and what each document reaches.
ORACLE_SQL = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{ascii_uppercase}', '{ascii_lowercase}'), '[^\\x20\\x09-\\x0D]+') AS words
  FROM documents
),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(words[i : i + {SHINGLE_WORDS - 1}], ' ') AS shingle
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - {SHINGLE_WORDS - 1}, 1) + 1)) AS i FROM w WHERE len(words) > 0) runs
),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS MATERIALIZED (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS shared
  FROM s AS a JOIN s AS b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL
),
l AS MATERIALIZED (
  SELECT u, v FROM p JOIN n AS a ON a.doc_id = u JOIN n AS b ON b.doc_id = v
  WHERE 100 * shared >= {SIMILARITY_PERCENT} * (a.n + b.n - shared)
),
e AS MATERIALIZED (SELECT u, v FROM l UNION SELECT v, u FROM l),
r AS (SELECT u AS node, u AS reached FROM e UNION SELECT r.node, e.v FROM r JOIN e ON r.reached = e.u),
m AS (SELECT node, min(reached) AS component_id FROM r GROUP BY node)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(m.component_id, w.doc_id) AS component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN m ON m.node = w.doc_id
"""

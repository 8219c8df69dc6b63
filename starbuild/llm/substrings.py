"""Substring dedup by sliding spans of words and of whole sentences.

A text is a row of words in lower case; what white space stands between them does not matter. Spans are of two kinds:

- *words*: SPAN_WORDS words in a row, where the smallest hash of its runs of RUN_WORDS words is that of its first or of its
  last run (closed syncmers). This depends on the span's own words only, so a stretch is treated alike wherever it stands,
  and of any SPAN_WORDS - RUN_WORDS such stretches in a row one at least is a span. So a repeat of
  2 * SPAN_WORDS - RUN_WORDS - 1 words is always seen, all but fewer than SPAN_WORDS - RUN_WORDS words at each of its ends;
- *sentences*: for each sentence, the shortest run of whole ones of at least SPAN_WORDS words that begins, or that ends,
  with it. Sentences end at line ends and at words that end with .!? - so repeats of whole sentences are seen whole.

Spans are hashed (128 bits) and joined over the whole corpus, and every piece that lies in a repeated span other than its
first occurrence (smallest doc_id, then position) is removed. Pieces are what the ends of sentences and spans cut.

Defined results: null, empty and short texts have no spans and lose nothing. Rows with one doc_id and the same
sentences are one occurrence; other rows of one doc_id are told apart by position only. A null doc_id is never
searched and never changed. Empty tables give no rows; extra columns are ignored by `repeated` and kept by `removed`.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starbuild.llm.common import let, ship

SPAN_WORDS = 20
RUN_WORDS = 12
WORD = re.compile(r"\S+")
ENDS = (".", "!", "?")
#: Odd multipliers that mix hashes.
MIX = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9], np.uint64)


def runs(values: np.ndarray, width: int, join: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """`join` over each `width` values in a row, by doubling."""
    out, held, done, size = None, values, 0, 1
    while True:
        if width & size:
            n = len(values) - done - size + 1
            out = held[:n] if out is None else join(out[:n], held[done : done + n])
            done += size
        if done == width:
            return out
        held, size = join(held[:-size], held[size:]), 2 * size


def chained(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    mixed = a * MIX[0] + b
    return (mixed ^ (mixed >> np.uint64(31))) * MIX[1]


def chosen(hashes: np.ndarray) -> np.ndarray:
    """The first word of each span of the first kind."""
    if len(hashes) < SPAN_WORDS:
        return np.zeros(0, np.int64)
    own = runs(hashes, RUN_WORDS, chained)
    least = runs(own, SPAN_WORDS - RUN_WORDS + 1, np.minimum)
    return np.flatnonzero((own[: len(least)] == least) | (own[-len(least) :] == least))


def cut(text: str) -> tuple[list[tuple[int, int]], bytes, np.ndarray, np.ndarray, np.ndarray]:
    """Where each word stands; the words' hashes; where pieces end, and from and up to which word each span runs."""
    words = text.lower().split()
    n = len(words)
    marks = b"".join(map(xxhash.xxh3_64_digest, words))
    if not n:
        return [], marks, *[np.zeros(0, np.int64)] * 3
    stops = [i for i, word in enumerate(words, 1) if word.endswith(ENDS)]
    lines = np.cumsum([len(line.split()) for line in text.split("\n")])
    ends = np.unique(np.concatenate([stops, lines, [n]]).astype(np.int64))
    ends = ends[ends > 0]
    starts = np.concatenate([[0], ends[:-1]])
    first = chosen(np.frombuffer(marks, ">u8").astype(np.uint64))
    pieces = np.unique(np.concatenate([ends, first, first + SPAN_WORDS]))
    up = np.searchsorted(ends, starts + SPAN_WORDS)
    back = np.searchsorted(starts, ends - SPAN_WORDS, "right") - 1
    begin, end = starts[up < len(ends)], ends[up[up < len(ends)]]
    begin, end = np.concatenate([first, begin, starts[back[back >= 0]]]), np.concatenate([first + SPAN_WORDS, end, ends[back >= 0]])
    both = np.unique(begin * (n + 1) + end)
    return [m.span() for m in WORD.finditer(text)], marks, pieces[pieces > 0], both // (n + 1), both % (n + 1)


def sentences(text: str) -> list[tuple[int, int, int, bytes]]:
    """Start, end, number of words and hash of each piece, in code points."""
    at, marks, pieces, *_ = cut(text)
    from_ = [0, *pieces.tolist()]
    digest = xxhash.xxh3_128_digest
    return [(at[a][0], at[b - 1][1], b - a, digest(marks[8 * a : 8 * b])) for a, b in zip(from_, from_[1:])]


def spans(text: str) -> list[tuple[int, int, int, int, bytes]]:
    """First and last piece, start, end and hash of each span, in order."""
    at, marks, pieces, begin, end = cut(text)
    first, last = np.searchsorted(pieces, begin, "right"), np.searchsorted(pieces, end)
    digest = xxhash.xxh3_128_digest
    return [
        (i, j, at[a][0], at[b - 1][1], digest(marks[8 * a : 8 * b]))
        for i, j, a, b in zip(first.tolist(), last.tolist(), begin.tolist(), end.tolist())
    ]


def occurrences(docs: DataFrame) -> DataFrame:
    """doc_id, at, size, h1, h2 of every span.

    at: first piece and start; size: pieces after the first and characters, each pair in one number, to shuffle less.
    """
    ship(docs.sparkSession)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            places, keys, each = array("q"), [], []
            for text in batch["text"]:
                own = spans(text)
                each.append(len(own))
                for a, b, start, stop, key in own:
                    places.extend((a << 32 | start, (b - a) << 32 | (stop - start)))
                    keys.append(key)
            at = np.frombuffer(places, np.int64).reshape(-1, 2)
            key = np.frombuffer(b"".join(keys), "<i8").reshape(-1, 2)
            doc_id = batch["doc_id"].repeat(each).to_numpy()
            yield pd.DataFrame({"doc_id": doc_id, "at": at[:, 0], "size": at[:, 1], "h1": key[:, 0], "h2": key[:, 1]})

    kind = dict(docs.dtypes)["doc_id"]
    named = docs.select("doc_id", "text").where("doc_id is not null and text is not null")
    return named.mapInPandas(read, f"doc_id {kind}, at long, size long, h1 long, h2 long")


def repeated(docs: DataFrame) -> DataFrame:
    """doc_id, start, stop, n_sentences, kept_in: each stretch of text that repeats what stands earlier.

    n_sentences counts pieces. kept_in is the document that holds the first occurrence of the stretch's first span.
    """
    high, low = lambda c: F.shiftright(c, 32), lambda c: F.col(c).bitwiseAND(0xFFFFFFFF)
    # One window, as a join to the first places would cut all texts twice and deal out all spans twice.
    found = occurrences(docs).repartition("h1", "h2")
    place = F.struct("doc_id", high("at").alias("first"))
    kept = F.min(place).over(Window.partitionBy("h1", "h2"))
    later = found.withColumn("kept", kept).where(place != F.col("kept"))
    later = later.select("doc_id", "at", "size", F.col("kept.doc_id").alias("kept")).repartition("doc_id")
    later = later.withColumns({"first": high("at"), "start": low("at")})
    later = later.withColumns({"last": F.col("first") + high("size"), "stop": F.col("start") + low("size")})
    by_doc = Window.partitionBy("doc_id").orderBy("first", "last", "start")
    before = F.max("last").over(by_doc.rowsBetween(Window.unboundedPreceding, -1))
    islands = later.withColumn("new", F.when(F.col("first") <= before, 0).otherwise(1)).withColumn(
        "island", F.sum("new").over(by_doc)
    )
    return islands.groupBy("doc_id", "island").agg(
        F.min("start").cast("int").alias("start"),
        F.max("stop").cast("int").alias("stop"),
        (F.max("last") - F.min("first") + 1).cast("long").alias("n_sentences"),
        F.min_by("kept", F.struct("first", "kept")).alias("kept_in"),
    ).drop("island")


def removed(docs: DataFrame) -> DataFrame:
    """`docs` without the repeated stretches; n_chars is set anew where there is such a column."""
    cuts = repeated(docs).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("_cuts"))
    joined = docs.join(cuts.withColumnRenamed("doc_id", "_doc"), F.col("doc_id") == F.col("_doc"), "left")
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    done = F.aggregate(
        "_cuts",
        zero,
        lambda state, c: F.struct(
            c["stop"].alias("at"),
            F.concat(state["out"], F.substring(F.col("text"), state["at"] + 1, c["start"] - state["at"])).alias("out"),
        ),
    )
    text = let(done, lambda d: F.concat(d["out"], F.substring(F.col("text"), d["at"] + 1, F.length("text"))))
    out = joined.withColumn("text", F.when(F.col("_cuts").isNotNull(), text).otherwise(F.col("text"))).drop("_cuts", "_doc")
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out

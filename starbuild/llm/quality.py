"""Quality classifier: random-indexing word vectors, pooled for each document, and a small numpy network.

1. *Word vectors.* A word is its letters in lower case, and beside it stands its shape (case, digits, signs, runs made
   one). Both fall into BUCKETS by hash; each bucket has a sparse random index vector made from its number. The vector
   of a bucket is the sum of the index vectors of its neighbours over the whole corpus: each task adds up its own texts
   and the tables, of fixed size, are added over the tasks.
2. *Documents* are pooled from their whole text: the mean vector over all words and over distinct words, their lengths,
   and how often words repeat.
3. *Network.* Two layers (tanh, logistic) in numpy, fitted on the driver to at most `sample` labelled documents (those
   with the smallest hashes of their ids) of the training folds.
4. *Calibration.* A part of the sample is kept from the fit and sets the temperature that divides the logits.

Scores use the text only. Defined results: null and empty texts have the score of an all-zero pooled vector. Labels
that are null, or of ids not in `docs`, are not used; of several labels for an id the largest counts. Without labels
of both kinds every score is the share of label 1 (0.5 without any). Rows of one doc_id and rows with a null id are
each scored. Empty tables give no rows; extra columns are ignored or kept, as said below.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starbuild.llm.common import ship

BUCKETS = 1 << 13
WIDTH = 32
SIGNS = 4
SAMPLE = 20_000
HIDDEN = 24
EPOCHS = 120
THRESHOLD = 0.3
CACHE_ENTRIES = 400_000
CACHED_CHARS = 100
LETTERS = re.compile(r"[^\W\d_]+")


def index_vectors() -> np.ndarray:
    """The sparse random vector of each bucket: SIGNS places of WIDTH with +1 or -1."""
    random = np.random.default_rng(7)
    out = np.zeros((BUCKETS, WIDTH), np.float32)
    rows = np.arange(BUCKETS)[:, None]
    out[rows, random.random((BUCKETS, WIDTH)).argsort(axis=1)[:, :SIGNS]] = random.choice([-1.0, 1.0], (BUCKETS, SIGNS))
    return out


def shape(piece: str) -> str:
    """What a word looks like: X, x, 9 for upper case, lower case and digits, signs as they are, runs as one."""
    out: list[str] = []
    for c in piece:
        s = "X" if c.isupper() else "x" if c.isalpha() else "9" if c.isdigit() else c
        if not out or out[-1] != s:
            out.append(s)
    return "".join(out)


class Buckets(dict):
    """Word to its bucket and its shape's bucket, packed into one number; bounded, and without the words that are very long."""

    def __missing__(self, piece: str) -> int:
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        letters = "".join(LETTERS.findall(piece)).lower()
        word = xxhash.xxh3_64_intdigest(letters) % (BUCKETS // 2)
        look = BUCKETS // 2 + xxhash.xxh3_64_intdigest(shape(piece)) % (BUCKETS // 2)
        value = word * BUCKETS + look
        if len(piece) <= CACHED_CHARS:
            self[piece] = value
        return value


KNOWN = Buckets()


def looked_up(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The word buckets and the shape buckets of a text, in order."""
    pieces = text.split()
    both = np.fromiter(map(KNOWN.__getitem__, pieces), np.int64, len(pieces))
    return both // BUCKETS, both % BUCKETS


def word_vectors(docs: DataFrame) -> np.ndarray:
    """The summed context vectors of all buckets over all rows of `docs`, each scaled to length 1."""
    ship(docs.sparkSession)

    def summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pairs = np.zeros(BUCKETS * WIDTH, np.float64)
        index = index_vectors()
        places = np.argsort(-np.abs(index), axis=1, kind="stable")[:, :SIGNS]
        signs = np.take_along_axis(index, places, axis=1)

        def add(at: np.ndarray, neighbour: np.ndarray) -> None:
            for j in range(SIGNS):
                flat = at * WIDTH + places[neighbour, j]
                np.add(pairs, np.bincount(flat, signs[neighbour, j], BUCKETS * WIDTH), out=pairs)

        def flush(words: list[np.ndarray], looks: list[np.ndarray]) -> None:
            w, s = np.concatenate(words), np.concatenate(looks)
            add(w[:-1], w[1:])
            add(w[1:], w[:-1])
            add(s[:-1], s[1:])

        words: list[np.ndarray] = []
        looks: list[np.ndarray] = []
        held = 0
        for batch in batches:
            for text in batch["text"]:
                w, s = looked_up(text)
                if len(w) > 1:
                    words.append(w)
                    looks.append(s)
                    held += len(w)
                if held >= 1_000_000:
                    flush(words, looks)
                    words, looks, held = [], [], 0
        if words:
            flush(words, looks)
        table = pairs.astype("<f4").reshape(64, -1)
        yield pd.DataFrame({"block": np.arange(64), "sums": [x.tobytes() for x in table]})

    def added(part: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(x, "<f4").astype(np.float64) for x in part["sums"]], axis=0)
        return pd.DataFrame({"block": part["block"][:1], "sums": [total.astype("<f8").tobytes()]})

    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"))
    parts = texts.mapInPandas(summed, "block int, sums binary")
    blocks = parts.groupBy("block").applyInPandas(added, "block int, sums binary").orderBy("block").collect()
    if not blocks:
        return np.zeros((BUCKETS, WIDTH), np.float32)
    table = np.concatenate([np.frombuffer(r["sums"], "<f8") for r in blocks]).reshape(BUCKETS, WIDTH)
    table = np.sign(table) * np.sqrt(np.abs(table))
    # a word's own index vector is part of its context, so that words without neighbours differ too
    table = table / np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1e-9) + 0.5 * index_vectors()
    return table.astype(np.float32)


def pooled(text: str, vectors: np.ndarray) -> np.ndarray:
    """Mean vectors of words, of distinct words and of shapes; then their lengths and how far words repeat."""
    words, looks = looked_up(text)
    if not len(words):
        return np.zeros(3 * WIDTH + 6, np.float32)
    distinct, times = np.unique(words, return_counts=True)
    w = times @ vectors[distinct] / len(words)
    d = vectors[distinct].mean(axis=0)
    kinds, of = np.unique(looks, return_counts=True)
    s = of @ vectors[kinds] / len(looks)
    extra = [
        np.linalg.norm(w),
        np.linalg.norm(d),
        np.linalg.norm(s),
        len(distinct) / len(words),
        times.max() / len(words),
        np.log1p(len(words)) / 10,
    ]
    return np.concatenate([w, d, s, extra]).astype(np.float32)


@dataclass
class Network:
    """Two layers over standardised inputs, and the temperature of its logits."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0
    constant: float | None = None

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(((x - self.mean) / self.scale) @ self.w1 + self.b1) @ self.w2 + self.b2

    def probability(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def loss(logits: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, logits) - y * logits))


def fit(x: np.ndarray, y: np.ndarray, hidden: int = HIDDEN, epochs: int = EPOCHS) -> Network:
    """Adam on the logistic loss; every fifth row is kept back to stop early and to set the temperature."""
    if not len(y) or y.min() == y.max():
        return Network(*[np.zeros(1)] * 5, 0.0, constant=float(y.mean()) if len(y) else 0.5)
    random = np.random.default_rng(11)
    kept = np.arange(len(y)) % 5 == 4
    if kept.sum() < 20 or len(set(y[kept])) < 2:
        kept[:] = False
    train = ~kept
    mean, scale = x[train].mean(axis=0), x[train].std(axis=0) + 1e-3
    z, t = ((x - mean) / scale)[train], y[train]
    params = [
        random.normal(0, 1 / np.sqrt(z.shape[1]), (z.shape[1], hidden)),
        np.zeros(hidden),
        random.normal(0, 1 / np.sqrt(hidden), hidden),
        np.zeros(1),
    ]
    m, v, step, best = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0, None
    for _ in range(epochs):
        for rows in np.array_split(random.permutation(len(t)), max(1, len(t) // 128)):
            h = np.tanh(z[rows] @ params[0] + params[1])
            error = (1 / (1 + np.exp(-np.clip(h @ params[2] + params[3], -30, 30))) - t[rows]) / len(rows)
            back = np.outer(error, params[2]) * (1 - h * h)
            grads = [z[rows].T @ back + 1e-4 * params[0], back.sum(axis=0), h.T @ error + 1e-4 * params[2], error.sum(keepdims=True)]
            step += 1
            for i, g in enumerate(grads):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                params[i] = params[i] - 3e-3 * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
        net = Network(mean, scale, params[0], params[1], params[2], float(params[3][0]))
        now = loss(net.logits(x[kept]), y[kept]) if kept.any() else 0.0
        if best is None or now <= best[0]:
            best = (now, net)
    net = best[1]
    if kept.any():
        logits = net.logits(x[kept])
        net.temperature = min(np.geomspace(0.3, 5, 60), key=lambda temperature: loss(logits / temperature, y[kept]))
    return net


def held_out(doc_id: Column | str) -> Column:
    """Whether crc32 of the id as text leaves no remainder by 5; null ids are not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, Network]:
    """The word vectors of `docs` (doc_id, text) and a network for `labels` (doc_id, quality) of the training folds."""
    vectors = word_vectors(docs)
    marks = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    # Bounded by `sample`, and so small enough to go to every task.
    chosen = marks.where(~held_out("doc_id")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def pool(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [pooled(text, shared.value).tobytes() for text in batch["text"]]
            yield batch[["quality", "key"]].assign(x=rows)

    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    rows = rows.select("quality", F.xxhash64("doc_id", "text").alias("key"), "text")
    found = rows.mapInPandas(pool, "quality int, key long, x binary").orderBy("key", "x").limit(sample).toPandas()
    x = np.array([np.frombuffer(b, np.float32) for b in found["x"]]).reshape(len(found), 3 * WIDTH + 6).astype(np.float64)
    return vectors, fit(x, found["quality"].to_numpy(np.float64))


def score(docs: DataFrame, vectors: np.ndarray, net: Network) -> DataFrame:
    """`docs` with the column `score`."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((vectors, net))

    def scored(texts: pd.Series) -> pd.Series:
        own, network = shared.value
        x = np.array([pooled(t or "", own) for t in texts], np.float64).reshape(len(texts), 3 * WIDTH + 6)
        return pd.Series(network.probability(x))

    udf = F.pandas_udf(lambda s: scored(s), "double")
    return docs.withColumn("score", udf(F.coalesce(F.col("text"), F.lit(""))))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of `docs` (doc_id, text)."""
    rows = docs.select("doc_id", "text")
    scores = score(rows, *train(rows, labels, sample)).select("doc_id", held_out("doc_id").alias("held_out"), "score")
    return scores.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, sample: int = SAMPLE) -> DataFrame:
    """The rows of `docs`, all columns as they were, whose score reaches the threshold."""
    marked = docs.withColumns({c: F.col(c) for c in docs.columns})
    if "score" in docs.columns:
        marked = marked.withColumnRenamed("score", "_own_score")
    out = score(marked, *train(docs.select("doc_id", "text"), labels, sample)).where(F.col("score") >= threshold).drop("score")
    return out.withColumnRenamed("_own_score", "score") if "score" in docs.columns else out

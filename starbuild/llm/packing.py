"""Best-fit packing of token sequences by a configuration linear program.

1. Every text becomes token ids and the end id; longer ones are cut at `capacity`. The pieces are stored.
2. Their lengths are counted: at most `capacity` rows, whatever the corpus.
3. On that histogram the driver solves the configuration program (fewest sequences whose configurations, multisets of
   lengths that fit in one, hold all pieces) by multiplicative weights: each round prices the lengths, a knapsack
   dynamic program finds the dearest configuration, and the weights of what it holds fall.
4. Fractions are rounded down in the order found; best fit, again on the histogram, places what is left. The program's
   prices also bound from below how few sequences there can be.
5. Pieces are numbered within their length on the executors and look up their place in the plan, whose size depends on
   the number of lengths only.

Defined results: null and empty texts are the end id alone (one piece of length 1). Rows with equal or null doc_id are
separate documents; extra columns are ignored. Empty tables give no rows. Nothing is dropped: each token is
placed once, offsets within a sequence are gapless from 0.
"""

from __future__ import annotations

import math
import os
import re
import unicodedata
import zlib
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starbuild.llm.common import materialize, ship
from starbuild.llm.tokens import ODD_SPACE, TOKENIZER, merger, pieces_of, vocabulary_path

CAPACITY = 4096
END_ID = 1
#: (rounds, how fast a weight falls with what is covered). One after the other is solved until the plan is as short as the
#: program's bound allows; otherwise the shortest plan counts.
TRIES = ((12, 0.3), (20, 2.0), (40, 3.0))
SLACK = 0.02
CACHE_ENTRIES = 600_000
#: Pre-tokens encoded as one string, and characters of text handled at a time.
JOINED = 1_000
PORTION_CHARS = 1_000_000


class PieceEncoder:
    """Token ids of texts as little-endian 32-bit bytes.

    The library encodes each distinct pre-token once, JOINED of them in one string. A pre-token's last id, and no other, closes a word, which tells the ids of a string apart.
    """

    def __init__(self, path: str, cache_entries: int = CACHE_ENTRIES):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_file(path)
        self.cutter = merger(path)
        self.narrow = narrow_pattern(self.cutter.word.pattern)
        self.closes = np.zeros(self.library.get_vocab_size(with_added_tokens=True), bool)
        self.closes[self.cutter.closing] = True
        self.known: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.cache_entries = cache_entries

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4") for e in found]

    def learn_words(self, words: list[str]) -> None:
        parts = [words[i : i + JOINED] for i in range(0, len(words), JOINED)]
        for part, ids in zip(parts, self.ids([" ".join(x) for x in parts]), strict=True):
            last = np.flatnonzero(self.closes[ids]) + 1
            if len(last) == len(part) and last[-1] == len(ids):
                raw, ends = ids.tobytes(), (4 * last).tolist()
                each = [raw[i:j] for i, j in zip([0, *ends], ends)]
            else:
                each = [x.tobytes() for x in self.ids(part)]
            self.words.update(zip(part, each, strict=True))

    def learn(self, pieces: list[str]) -> None:
        known, words = self.known, self.words
        special = [x for x in pieces if "<" in x]
        known.update((x, ids.tobytes()) for x, ids in zip(special, self.ids(special), strict=True))
        cut = [(x, self.cutter.cut(x)) for x in pieces if "<" not in x]
        self.hold_words({w for _, own in cut for w in own})
        known.update((x, words[own[0]] if len(own) == 1 else b"".join(map(words.__getitem__, own))) for x, own in cut)

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Texts of one batch, so that what is new in them goes to the library together.

        Pre-tokens of a plain text are looked up as they are; what stands for itself in others, as special strings do, by pieces.
        """
        plain = ["<" not in x and not ODD_SPACE.search(x) for x in texts]
        words = [self.pre_tokens(lowered(x)) if easy else () for x, easy in zip(texts, plain, strict=True)]
        self.hold_words(set().union(*words))
        out = [b"".join(map(self.words.__getitem__, own)) for own in words]
        rest = [i for i, easy in enumerate(plain) if not easy]
        for i, ids in zip(rest, self.encode_pieces([texts[i] for i in rest]), strict=True):
            out[i] = ids
        return out

    def pre_tokens(self, text: str) -> list[str]:
        narrow = text.isascii() or not WIDE.search(text)
        return (self.narrow if narrow and self.narrow else self.cutter.word).findall(text)

    def hold_words(self, wanted: set[str]) -> None:
        """See to it that the ids of all `wanted` pre-tokens are known at once."""
        new = wanted.difference(self.words)
        if new and len(self.words) + len(new) > self.cache_entries:
            self.words.clear()
            new = wanted
        self.learn_words(list(new))

    def encode_pieces(self, texts: list[str]) -> list[bytes]:
        pieces, known = [pieces_of(x) for x in texts], self.known
        distinct = set().union(*pieces)
        new = distinct.difference(known)
        if new:
            if len(known) + len(new) > self.cache_entries:
                known.clear()
                new = distinct
            self.learn(list(new))
        return [b"".join(map(known.__getitem__, own)) for own in pieces]


#: From this character on, a pattern needs the character classes of Unicode.
NARROW = 0x250
WIDE = re.compile(f"[{chr(NARROW)}-\U0010ffff]")


def narrow_pattern(pattern: str) -> re.Pattern | None:
    """`pattern` for texts of characters below NARROW, its classes written out: the standard engine cuts twice as fast.

    None if it has other classes than letters, numbers and white space.
    """
    signs = list(map(chr, range(NARROW)))
    for name, tested in ((r"\p{L}", r"\p{L}"), (r"\p{N}", r"\p{N}"), (r"\s", r"\p{White_Space}")):
        kept = regex.compile(tested)
        pattern = pattern.replace(name, "".join(re.escape(c) for c in signs if kept.match(c)))
    return None if r"\p" in pattern or r"\P" in pattern else re.compile(pattern)


def lowered(text: str) -> str:
    """Text as the tokenizer's normaliser leaves it."""
    if text.isascii():
        return text.lower()
    normal = unicodedata.normalize("NFC", text)
    return "".join(c.lower() for c in normal) if "\u03a3" in normal else normal.lower()  # no final sigma


def portions(texts: list[str], chars: int = PORTION_CHARS) -> Iterator[tuple[int, int]]:
    """Spans of neighbouring texts of about `chars` characters; a longer text is one alone."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        if i > start and held + len(text) > chars:
            yield start, i
            start, held = i, 0
        held += len(text)
    if texts:
        yield start, len(texts)


@lru_cache(maxsize=2)
def encoder(path: str) -> PieceEncoder:
    return PieceEncoder(path)


def cut(docs: DataFrame, tokenizer: str = TOKENIZER, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece."""
    ship(docs.sparkSession)
    end, width = np.asarray([end_id], "<u4").tobytes(), 4 * capacity

    def cut_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(vocabulary_path(tokenizer)).encode_all
        for batch in batches:
            rows, doc_ids, texts = [], batch["doc_id"].tolist(), batch["text"].tolist()
            for low, high in portions(texts):
                for doc_id, ids in zip(doc_ids[low:high], encode(texts[low:high]), strict=True):
                    ids += end
                    for i, at in enumerate(range(0, len(ids), width)):
                        part = ids[at : at + width]
                        rows.append((doc_id, i, at // 4, len(part) // 4, zlib.crc32(part)))
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])

    kind = dict(docs.dtypes)["doc_id"]
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInPandas(cut_rows, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def priced(prices: np.ndarray, lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """The unbounded knapsack for every room up to `capacity`: the highest price, and the length taken first (-1: none).

    Of equal prices the longer length wins, so the short ones are kept for later.
    """
    best, took = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    backwards, backwards_prices = lengths[::-1].copy(), prices[::-1].copy()
    for room in range(1, capacity + 1):
        skip = len(lengths) - int(np.searchsorted(lengths, room, side="right"))
        best[room] = best[room - 1]
        if skip < len(lengths):
            totals = best[room - backwards[skip:]] + backwards_prices[skip:]
            k = int(totals.argmax())
            if totals[k] > best[room]:
                best[room], took[room] = totals[k], backwards[skip + k]
    return best, took


def filled(room: int, took: np.ndarray) -> Counter:
    """The lengths the knapsack takes for `room`."""
    config: Counter = Counter()
    while room > 0:
        if took[room] < 0:
            room -= 1
        else:
            config[int(took[room])] += 1
            room -= int(took[room])
    return config


def solve(
    histogram: dict[int, int], capacity: int, rounds: int, learning: float
) -> tuple[list[tuple[Counter, float]], float]:
    """Configurations and how often to use each (fractional), by multiplicative weights on the covering program, and a bound.

    A length's price is its share of the capacity times a weight, which falls by a factor with each part of it that is
    covered. A round prices all rooms by one knapsack; for each length, longest first, the dearest configuration that holds it
    is used for a part of what is left, if its price is within SLACK of the round's best. No program can do with fewer sequences
    than all pieces cost at a round's prices over the dearest configuration's price: the bound is the highest of the rounds.
    """
    lengths = np.array(sorted(histogram), dtype=np.int64)
    counts = np.array([histogram[int(x)] for x in lengths], dtype=float)
    left, uses, bound = dict(zip(lengths.tolist(), counts.tolist(), strict=True)), [], 0.0
    for turn in range(rounds):
        remains = np.array(list(left.values()))
        open_ = remains >= 1
        if not open_.any():
            break
        prices = lengths / capacity * np.exp(-learning * (1 - remains / counts))
        best, took = priced(prices, lengths, capacity)
        bound = max(bound, float((counts * prices).sum() / best[capacity]))
        here, own = lengths[open_], prices[open_]
        if not open_.all():
            best, took = priced(own, here, capacity)
        part, used = 1.0 / (rounds - turn), 0
        for length, price in zip(here[::-1].tolist(), own[::-1].tolist(), strict=True):
            if price + best[capacity - length] < (1 - SLACK) * best[capacity]:
                continue
            config = filled(capacity - length, took)
            config[length] += 1
            step = min(max(part * left[k] / v, min(1.0, left[k] / v)) for k, v in config.items())
            if step >= 1:
                uses.append((config, step))
                used += 1
                for k, v in config.items():
                    left[k] -= step * v
        if not used:
            break
    return uses, bound


def best_fit(left: dict[int, int], capacity: int) -> list[tuple[Counter, int]]:
    """Best fit of the longest first, moving equal pieces and equal sequences together."""
    groups: dict[int, list[tuple[Counter, int]]] = {}
    rooms: list[int] = []
    done = []

    def add(config: Counter, n: int) -> None:
        room = capacity - sum(k * v for k, v in config.items())
        if room == 0:
            done.append((config, n))
            return
        if room not in groups:
            groups[room] = []
            insort(rooms, room)
        groups[room].append((config, n))

    for length in sorted(left, reverse=True):
        todo = left[length]
        while todo:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                each = capacity // length
                full, rest = divmod(todo, each)
                if full:
                    add(Counter({length: each}), full)
                if rest:
                    add(Counter({length: rest}), 1)
                break
            room = rooms[at]
            config, n = groups[room].pop()
            if not groups[room]:
                del groups[room]
                rooms.pop(at)
            each = min(room // length, todo)
            used = min(n, todo // each)
            add(config + Counter({length: each}), used)
            if n > used:
                add(config, n - used)
            todo -= used * each
    return done + [x for room in rooms for x in groups[room]]


def rounded(histogram: dict[int, int], capacity: int, uses: list[tuple[Counter, float]]) -> list[tuple[Counter, int]]:
    """Whole uses of the configurations, with and without gaps, in the order found, and best fit for what they leave."""
    left, out = dict(histogram), []
    for config, x in uses:
        n = min(int(x), *(left[k] // v for k, v in config.items()))
        if n > 0:
            out.append((config, n))
            for k, v in config.items():
                left[k] -= n * v
    return out + best_fit({k: v for k, v in left.items() if v}, capacity)


def sequences(configs: list[tuple[Counter, int]]) -> int:
    return sum(n for _, n in configs)


def planned(histogram: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple[Counter, int]], float]:
    """Configurations and how many sequences follow each, which together hold the histogram exactly, and the program's bound.

    The rounded solutions come first; best fit alone counts only where it needs fewer sequences than each of them.
    """
    found, bound = [], 0.0
    for rounds, learning in TRIES:
        uses, low = solve(histogram, capacity, rounds, learning)
        found.append(rounded(histogram, capacity, uses))
        bound = max(bound, low)
        if min(map(sequences, found)) <= math.ceil(bound - 1e-6):
            break
    else:
        found.append(best_fit(histogram, capacity))
    return min(found, key=sequences), bound


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[Counter, int]]:
    return planned(histogram, capacity)[0]


def slots(configs: list[tuple[Counter, int]]) -> dict[int, np.ndarray]:
    """For each length, rows (first rank, per sequence, first sequence, first offset): where its pieces go, by rank."""
    runs: dict[int, list[tuple[int, int, int, int]]] = {}
    rank: Counter = Counter()
    sequence = 0
    for config, n in configs:
        offset = 0
        for length in sorted(config, reverse=True):
            each = config[length]
            runs.setdefault(length, []).append((rank[length], each, sequence, offset))
            rank[length] += n * each
            offset += each * length
        sequence += n
    return {k: np.array(v, dtype=np.int64) for k, v in runs.items()}


def ranked(pieces: DataFrame, tasks: int) -> DataFrame:
    """`pieces` with `rank`, 0.. within each length. A length's rows are dealt over `tasks` parts, so none is too large."""
    dealt = pieces.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(tasks)))
    sizes = dealt.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("length", "part", F.coalesce(before, F.lit(0)).alias("before"))
    inner = Window.partitionBy("length", "part").orderBy("doc_id", "piece")
    return (
        dealt.withColumn("at", F.row_number().over(inner) - 1)
        .join(starts, ["length", "part"])
        .withColumn("rank", F.col("at") + F.col("before"))
        .drop("at", "before", "part")
    )


def pack(docs: DataFrame, tokenizer: str = TOKENIZER, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of `docs` (doc_id, text)."""
    pieces = materialize(cut(docs, tokenizer, capacity, end_id))
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    places = slots(plan(histogram, capacity))

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sequence, offset = np.empty(len(batch), np.int64), np.empty(len(batch), np.int64)
            for length, rows in batch.groupby("length").indices.items():
                run = places[length]
                rank = batch["rank"].to_numpy()[rows]
                at = run[np.searchsorted(run[:, 0], rank, side="right") - 1]
                nth, inside = np.divmod(rank - at[:, 0], at[:, 1])
                sequence[rows], offset[rows] = at[:, 2] + nth, at[:, 3] + inside * length
            yield batch.drop(columns="rank").assign(sequence_id=sequence, offset=offset)

    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    kinds = ", ".join(f"{c} {dict(pieces.dtypes)[c]}" for c in columns)
    return (
        ranked(pieces, tasks)
        .select(*columns, "rank")
        .mapInPandas(placed, f"{kinds}, sequence_id long, offset long")
    )

"""Token counts by heap-and-linked-list byte-pair merging; no identifier is ever produced.

Text is cut at white space, and each distinct piece is counted once in a bounded cache of its worker. A piece is
normalised (NFC, lower case), cut into pre-tokens, and each pre-token's bytes are merged: all adjacent pairs
go into a heap, the pair of lowest rank (leftmost first) is taken again and again, and the linked list of symbols
closes over it. The count is the initial symbols less the merges.

Defined results: null and empty texts have 0 bytes and 0 tokens. Rows are independent, so repeated rows, ties
and null ids pass through; extra columns are ignored. Texts of any length are counted whole.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starbuild.llm.common import ship

TOKENIZER = "word_bpe_49k.json"
CACHE_ENTRIES = 600_000
SHIFT = 20
#: Characters that Python's split() takes as white space and the tokenizer's patterns do not.
ODD_SPACE = regex.compile("[\x1c-\x1f]")
SPACE = regex.compile(r"[^\P{White_Space}]+")


def vocabulary_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pieces_of(text: str) -> list[str]:
    """The runs without white space; no token crosses white space."""
    return [x for x in SPACE.split(text) if x] if ODD_SPACE.search(text) else text.split()


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself where printable, else the next free one from 256."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    free = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(free)) for b in range(256)]


class PairMerger:
    """Counts the tokens of white-space-free pieces from the ranks of a tokenizer file."""

    def __init__(self, path: str, cache_entries: int = CACHE_ENTRIES):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or model["byte_fallback"] or model["ignore_merges"] or model["dropout"]:
            raise ValueError("only plain byte-pair tables are supported")
        symbol = model["vocab"]
        #: A pair of symbols, packed into one number, has a rank; the rank has the symbol they become.
        self.rank: dict[int, int] = {}
        self.merged: list[int] = []
        for i, merge in enumerate(model["merges"]):
            first, second = merge if isinstance(merge, list) else merge.split(" ")
            self.rank[symbol[first] << SHIFT | symbol[second]] = i
            self.merged.append(symbol[first + second])
        end = model["end_of_word_suffix"] or ""
        self.inner = [symbol.get(x) for x in byte_symbols()]
        self.last = [symbol.get(x + end) for x in byte_symbols()]
        #: Symbols that end a pre-token.
        self.closing = [i for x, i in symbol.items() if end and x.endswith(end)]
        split = next(x for x in spec["pre_tokenizer"]["pretokenizers"] if x["type"] == "Split")
        self.word = regex.compile(split["pattern"]["Regex"])
        special = sorted((x["content"] for x in spec["added_tokens"]), key=len, reverse=True)
        self.letters_stay = self.word.findall("abcxyz") == ["abcxyz"]
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.words: dict[str, int] = {}
        self.pieces: dict[str, int] = {}
        self.cache_entries = cache_entries

    def merge_count(self, symbols: list[int]) -> int:
        """Symbols left after merging: a heap of rank and place over a doubly linked list."""
        n = len(symbols)
        rank, left, right, merges = self.rank.get, list(range(-1, n - 1)), list(range(1, n + 1)), 0
        heap = []
        for i in range(n - 1):
            if (r := rank(symbols[i] << SHIFT | symbols[i + 1])) is not None:
                heap.append(r * n + i)
        heapq.heapify(heap)
        while heap:
            r, i = divmod(heapq.heappop(heap), n)
            j = right[i]
            # a swallowed symbol is -1, and no pair has it
            if j >= n or rank(symbols[i] << SHIFT | symbols[j]) != r:
                continue
            symbols[i], symbols[j] = self.merged[r], -1
            merges += 1
            right[i] = k = right[j]
            if k < n:
                left[k] = i
                if (r := rank(symbols[i] << SHIFT | symbols[k])) is not None:
                    heapq.heappush(heap, r * n + i)
            h = left[i]
            if h >= 0 and (r := rank(symbols[h] << SHIFT | symbols[i])) is not None:
                heapq.heappush(heap, r * n + h)
        return n - merges

    def word_count(self, word: str) -> int:
        raw = word.encode("utf-8")
        symbols = [self.inner[b] for b in raw[:-1]]
        symbols.append(self.last[raw[-1]])
        return self.merge_count([s for s in symbols if s is not None])

    def cut(self, piece: str) -> list[str]:
        """The pre-tokens of a piece without special strings."""
        if self.letters_stay and piece.isascii() and piece.isalpha():
            return [piece.lower()]
        normal = unicodedata.normalize("NFC", piece)
        lower = "".join(c.lower() for c in normal) if "Σ" in normal else normal.lower()  # no final sigma
        return self.word.findall(lower)

    def plain_count(self, piece: str) -> int:
        """Tokens of a piece without special strings."""
        total = 0
        for word in self.cut(piece):
            n = self.words.get(word)
            if n is None:
                if len(self.words) >= self.cache_entries:
                    self.words.clear()
                n = self.words[word] = self.word_count(word)
            total += n
        return total

    def piece_count(self, piece: str) -> int:
        if self.special is None or "<" not in piece:
            return self.plain_count(piece)
        found = len(self.special.findall(piece))
        return found + sum(map(self.plain_count, self.special.split(piece)))

    def count(self, text: str) -> int:
        pieces, known = pieces_of(text), self.pieces
        for piece in set(pieces).difference(known):
            if len(known) >= self.cache_entries:
                known.clear()
                return sum(map(self.piece_count, pieces))
            known[piece] = self.piece_count(piece)
        return sum(map(known.__getitem__, pieces))


@lru_cache(maxsize=2)
def merger(path: str) -> PairMerger:
    return PairMerger(path)


def count_tokens(docs: DataFrame, tokenizer: str = TOKENIZER, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit) of every row of `docs` (doc_id, text)."""
    ship(docs.sparkSession)

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = merger(vocabulary_path(tokenizer)).count
        for batch in batches:
            yield batch[["doc_id", "n_bytes"]].assign(n_tokens=[count(x) for x in batch["text"]])

    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    kind = dict(docs.dtypes)["doc_id"]
    return rows.mapInPandas(counted, f"doc_id {kind}, n_bytes long, n_tokens long").withColumn(
        "over_limit", F.col("n_tokens") > limit
    )

"""Byte-pair encoding and decoding; long unsplit text is encoded as a tree of halves.

A text is cut at special strings and into pre-tokens. A pre-token's bytes are merged by rank, lowest first, leftmost on a tie.
One that is longer than a leaf is halved again and again; its leaves are encoded on their own and joined pair by pair:
a window of tokens around the join is encoded anew and grows on each side until its outermost token there
is the one that stood there before. Whether a row of tokens is the encoding of its bytes depends on
neighbours alone: each two adjacent tokens must be the encoding of their bytes. So agreement at one token on either side is enough, and the
joined row is exactly the encoding of the whole. Texts with more than `spread` bytes are cut into rows of their own (at
pre-tokens, and within those that are longer), encoded in parallel on all executors, and joined for each text.

Defined results: null and empty texts have no tokens and decode to the empty text. Rows are independent; repeated rows, ties
and null ids pass through; other columns are ignored. Special strings within a text are special tokens, as the tokenizer's default has
it, and are kept in decoding. Ids that end within a character decode to U+FFFD there.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starbuild.llm.common import ship
from starbuild.llm.tokens import byte_symbols, vocabulary_path
from starbuild.operators.skew import skew_join

TOKENIZER = "byte_bpe_50k.json"
#: Bytes of a leaf: this much is merged at once.
LEAF = 64
#: Bytes from which a text is dealt over several tasks.
SPREAD = 1 << 20
CACHE_ENTRIES = 300_000
#: Rows sent back at once.
ROWS = 1_000
#: Longer pre-tokens are not kept in the cache.
CACHED_CHARS = 64
SHIFT = 20
#: Letters and numbers assigned after Unicode 16.0, which the tokenizer takes for neither; code points in hexadecimal.
NEWER = (
    "558 58B-58C 88F C5C CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF 10940-10959 "
    "10EC5-10EC7 10ED9-10EEE 11B0A 11DB0-11DDB 11DE0-11DE9 11DF1 1246F 12475-1247F 12550-12686 16EA0-16EB8 16EBB-16ED3 "
    "16FF2-16FF6 187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 1B123-1B128 1B168 1D6A6 "
    "1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4 "
    "1E6FE-1E6FF 2B73A-2B73F 2B81E 2CEA2-2CEAD 323B0-33479 3D000-3FC3F"
)
NEWER_SET = "".join("-".join(f"\\U{int(c, 16):08X}" for c in span.split("-")) for span in NEWER.split())


def pre_token(letter: str, number: str, other: str) -> regex.Pattern:
    """The pre-tokens of byte-level tables; white space is the Unicode property."""
    return regex.compile(
        rf"'s|'t|'re|'ve|'m|'ll|'d| ?{letter}+| ?{number}+| ?{other}+"
        r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+",
        regex.V1,
    )


OTHER = r"[^\p{White_Space}\p{L}\p{N}]"
PLAIN = pre_token(r"\p{L}", r"\p{N}", OTHER)
EXACT = pre_token(rf"[\p{{L}}--[{NEWER_SET}]]", rf"[\p{{N}}--[{NEWER_SET}]]", rf"[{OTHER}||[{NEWER_SET}]]")
#: Without these, both patterns cut alike.
HIGH = regex.compile("[\u0558-\U0010ffff]")


def pre_tokens(text: str) -> list[str]:
    return (EXACT if HIGH.search(text) else PLAIN).findall(text)


ID = np.dtype("<u4")


class Encoder(dict):
    """Encodes and decodes with a tokenizer file; as a dict, it holds the ids of known pre-tokens as packed bytes."""

    def __init__(self, path: str, leaf: int = LEAF, cache_entries: int = CACHE_ENTRIES):
        super().__init__()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, cutter = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or model["byte_fallback"] or model["ignore_merges"] or model["dropout"]:
            raise ValueError("only plain byte-pair tables are supported")
        if cutter["type"] != "ByteLevel" or cutter["add_prefix_space"] or not cutter["use_regex"] or spec["normalizer"]:
            raise ValueError("only byte-level tables without prefix and normalizer are supported")
        symbol, signs = model["vocab"], byte_symbols()
        self.byte_ids = [symbol[c] for c in signs]
        byte_of = {c: b for b, c in enumerate(signs)}
        #: A pair of ids, packed into one number, has a rank; the rank has the id they become.
        self.rank: dict[int, int] = {}
        self.merged: list[int] = []
        for i, merge in enumerate(model["merges"]):
            first, second = merge if isinstance(merge, list) else merge.split(" ")
            self.rank[symbol[first] << SHIFT | symbol[second]] = i
            self.merged.append(symbol[first + second])
        added = {x["content"]: x["id"] for x in spec["added_tokens"]}
        if any(x[k] for x in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("only plain special strings are supported")
        self.special = {text: np.array([i], ID).tobytes() for text, i in added.items()}
        self.cuts = regex.compile(f"({'|'.join(map(regex.escape, sorted(added, key=len, reverse=True)))})") if added else None
        self.token: list[bytes] = [b""] * (1 + max([*symbol.values(), *added.values()]))
        for text, i in symbol.items():
            self.token[i] = bytes(byte_of[c] for c in text) if all(c in byte_of for c in text) else text.encode()
        for text, i in added.items():
            self.token[i] = text.encode()
        self.leaf = leaf
        self.cache_entries = cache_entries

    def __missing__(self, word: str) -> bytes:
        packed = np.array(self.encode_run(word.encode()), ID).tobytes()
        if len(word) <= CACHED_CHARS:
            if len(self) >= self.cache_entries:
                self.clear()
            self[word] = packed
        return packed

    def merge_short(self, raw: bytes) -> list[int]:
        """Ids of a short run: look for the lowest rank, merge there, and again."""
        ids, rank = [self.byte_ids[b] for b in raw], self.rank.get
        none = len(self.merged)
        ranks = [rank(a << SHIFT | b, none) for a, b in zip(ids, ids[1:])]
        while ranks and (low := min(ranks)) < none:
            i = ranks.index(low)
            ids[i : i + 2] = [new] = [self.merged[low]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank(ids[i - 1] << SHIFT | new, none)
            if i < len(ranks):
                ranks[i] = rank(new << SHIFT | ids[i + 1], none)
        return ids

    def merge_long(self, raw: bytes) -> list[int]:
        """Ids of a run of any length: pairs in a heap by rank and place."""
        ids, rank, n = [self.byte_ids[b] for b in raw], self.rank.get, len(raw)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [r * n + i for i in range(n - 1) if (r := rank(ids[i] << SHIFT | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = divmod(heapq.heappop(heap), n)
            j = after[i]
            if ids[i] < 0 or j >= n or rank(ids[i] << SHIFT | ids[j]) != r:
                continue
            ids[i], ids[j] = self.merged[r], -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
            for left, right in ((before[i], i), (i, k)):
                if left >= 0 and right < n and (r := rank(ids[left] << SHIFT | ids[right])) is not None:
                    heapq.heappush(heap, r * n + left)
        return [i for i in ids if i >= 0]

    def merge(self, raw: bytes) -> list[int]:
        return self.merge_short(raw) if len(raw) <= 2 * self.leaf else self.merge_long(raw)

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of the bytes of `left` and `right` together, each the encoding of its own bytes."""
        if not left or not right:
            return left + right
        i, j = 1, 1
        while True:
            i, j = min(i, len(left)), min(j, len(right))
            window = self.merge(b"".join([self.token[x] for x in left[-i:] + right[:j]]))
            agreed_left = i == len(left) or window[0] == left[-i]
            agreed_right = j == len(right) or window[-1] == right[j - 1]
            if agreed_left and agreed_right:
                return left[:-i] + window + right[j:]
            i, j = i if agreed_left else 2 * i, j if agreed_right else 2 * j

    def join_all(self, parts: list[list[int]]) -> list[int]:
        """Parts joined in pairs, level by level."""
        while len(parts) > 1:
            parts = [self.join(*parts[k : k + 2]) if k + 1 < len(parts) else parts[k] for k in range(0, len(parts), 2)]
        return parts[0] if parts else []

    def encode_run(self, raw: bytes) -> list[int]:
        """Ids of a run without pre-token cuts, by halves."""
        if len(raw) <= self.leaf:
            return self.merge_short(raw)
        half = len(raw) // 2
        return self.join(self.encode_run(raw[:half]), self.encode_run(raw[half:]))

    def sections(self, text: str) -> Iterator[tuple[bool, str]]:
        """The text cut at special strings: (whether special, text)."""
        if self.cuts is None or not self.cuts.search(text):
            yield False, text
            return
        for i, section in enumerate(self.cuts.split(text)):
            if section:
                yield bool(i % 2), section

    def encode(self, text: str) -> bytes:
        """Ids of a whole text, little-endian unsigned 32-bit."""
        packed = []
        for special, section in self.sections(text):
            if special:
                packed.append(self.special[section])
            else:
                packed.extend(map(self.__getitem__, pre_tokens(section)))
        return b"".join(packed)

    def decode(self, packed: bytes) -> str:
        ids = np.frombuffer(packed, ID).tolist()
        return b"".join(map(self.token.__getitem__, ids)).decode("utf-8", "replace")

    def parts(self, text: str, size: int) -> Iterator[tuple[int, bytes]]:
        """The text as rows to encode apart: (kind, bytes).

        Kind 0 is several pre-tokens without special strings, 1 one pre-token or its first part, 2 a later part of it, 3 a special string.
        """
        for special, section in self.sections(text):
            if special:
                yield 3, section.encode()
                continue
            words: list[str] = []
            held = 0
            for word in pre_tokens(section):
                width = len(word.encode())
                if held + width > size:
                    yield from self._closed(words)
                    words, held = [], 0
                if width > size:  # a long one alone, by halves
                    raw, count = word.encode(), 1 << (-(-width // size) - 1).bit_length()
                    at = [width * k // count for k in range(count + 1)]
                    yield from ((2 if k else 1, raw[at[k] : at[k + 1]]) for k in range(count))
                else:
                    words.append(word)
                    held += width
            yield from self._closed(words)

    @staticmethod
    def _closed(words: list[str]) -> Iterator[tuple[int, bytes]]:
        """Pre-tokens as one part; white space at its end, which is cut by what follows it, as parts of its own."""
        end = len(words)
        while end and words[end - 1][-1].isspace():
            end -= 1
        if end:
            yield 0, "".join(words[:end]).encode()
        yield from ((1, word.encode()) for word in words[end:])

    def encode_part(self, kind: int, raw: bytes) -> bytes:
        if kind == 3:
            return self.special[raw.decode()]
        if kind == 0:
            return b"".join(map(self.__getitem__, pre_tokens(raw.decode())))
        return np.array(self.encode_run(raw), ID).tobytes()

    def assemble(self, parts: Iterable[tuple[int, bytes]]) -> bytes:
        """Ids of a text from the encoded parts in order."""
        out, run = [], []

        def close() -> None:
            if run:
                out.append(np.array(self.join_all(run), ID).tobytes())
                run.clear()

        for kind, packed in parts:
            if kind != 2:
                close()
            if kind in (1, 2):
                run.append(np.frombuffer(packed, ID).tolist())
            else:
                out.append(packed)
        close()
        return b"".join(out)


@lru_cache(maxsize=2)
def encoder(path: str, leaf: int = LEAF) -> Encoder:
    return Encoder(path, leaf)


def _encode_whole(docs: DataFrame, tokenizer: str, leaf: int) -> DataFrame:
    """Texts encoded and decoded where they are."""

    def coded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        code = encoder(vocabulary_path(tokenizer), leaf)
        for batch in batches:
            for at in range(0, len(batch), ROWS):
                some = batch.iloc[at : at + ROWS]
                ids = [code.encode(t) for t in some["text"]]
                yield some[["doc_id"]].assign(ids=ids, decoded=[code.decode(x) for x in ids])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.mapInPandas(coded, f"doc_id {kind}, ids binary, decoded string")


def _encode_spread(docs: DataFrame, tokenizer: str, leaf: int, size: int) -> DataFrame:
    """Each distinct text is cut into parts of about `size` bytes, which are encoded wherever there is room."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        code = encoder(vocabulary_path(tokenizer), leaf)
        for batch in batches:
            for key, text in zip(batch["digest"], batch["text"], strict=True):
                rows = [(key, place, kind, raw) for place, (kind, raw) in enumerate(code.parts(text, size))]
                yield pd.DataFrame(rows, columns=["digest", "place", "kind", "raw"])

    def coded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        code = encoder(vocabulary_path(tokenizer), leaf)
        for batch in batches:
            ids = [code.encode_part(k, raw) for k, raw in zip(batch["kind"], batch["raw"], strict=True)]
            yield batch[["digest", "place", "kind"]].assign(ids=ids)

    def joined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        code = encoder(vocabulary_path(tokenizer), leaf)
        for batch in batches:
            ids = [code.assemble((p["kind"], p["ids"]) for p in parts) for parts in batch["parts"]]
            yield batch[["digest"]].assign(ids=ids, decoded=[code.decode(x) for x in ids])

    keyed = docs.withColumn("digest", F.sha2("text", 256))
    parts = keyed.select("digest", "text").mapInPandas(cut, "digest string, place int, kind int, raw binary")
    # copies of a text have the same parts; one of each goes on, from any task
    encoded = parts.dropDuplicates(["digest", "place"]).mapInPandas(coded, "digest string, place int, kind int, ids binary")
    whole = (
        encoded.groupBy("digest")
        .agg(F.sort_array(F.collect_list(F.struct("place", "kind", "ids"))).alias("parts"))
        .mapInPandas(joined, "digest string, ids binary, decoded string")
    )
    return skew_join(keyed.select("doc_id", "digest"), whole, ["digest"]).select("doc_id", "ids", "decoded")


def encode_texts(docs: DataFrame, tokenizer: str = TOKENIZER, leaf: int = LEAF, spread: int = SPREAD) -> DataFrame:
    """doc_id, ids (binary: little-endian unsigned 32-bit) and decoded (the text of the ids) of each row of `docs` (doc_id, text)."""
    ship(docs.sparkSession)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    long = F.octet_length("text") > spread
    return _encode_whole(rows.filter(~long), tokenizer, leaf).unionByName(
        _encode_spread(rows.filter(long), tokenizer, leaf, spread)
    )


def code_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_tokens and the SHA-256 of ids and decoded text of every row of `docs`."""
    return encode_texts(docs).select(
        "doc_id",
        F.expr("octet_length(ids) div 4").cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )

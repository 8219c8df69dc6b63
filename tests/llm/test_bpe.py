"""Encoding and decoding against the tokenizer library."""

import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from starbuild.llm.bpe import TOKENIZER, Encoder, code_report, encode_texts, pre_tokens
from starbuild.llm.queries import QUERIES
from starbuild.llm.tokens import vocabulary_path

PATH = vocabulary_path(TOKENIZER)
LIBRARY = Tokenizer.from_file(PATH)
SMALL_LEAVES = Encoder(PATH, leaf=3)


@pytest.fixture(scope="module")
def library():
    return LIBRARY


@pytest.fixture(scope="module")
def code():
    return Encoder(PATH)


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    packed = b"".join(i.to_bytes(4, "little") for i in ids)
    decoded = library.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


def rows_of(df):
    return sorted((repr(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in df.collect())


def ids_of(code, text):
    packed = code.encode(text)
    return [int.from_bytes(packed[i : i + 4], "little") for i in range(0, len(packed), 4)]


def test_whole_table(spark, small, library):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    assert rows_of(QUERIES["op12_bpe"](spark, small)) == sorted((repr(r.doc_id), *expected(library, r.text)) for r in docs)


def test_odd_rows(odd, empty, library):
    rows = odd.select("doc_id", "text").collect()
    assert rows_of(code_report(odd)) == sorted((repr(r.doc_id), *expected(library, r.text)) for r in rows)
    assert code_report(empty).collect() == []


def long_texts():
    rng = random.Random(5)
    letters = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(5_000))
    words = " ".join("".join(rng.choice("etaoin") for _ in range(rng.randint(1, 9))) for _ in range(1_500))
    return [
        "x" * 4_097, letters, words, "a  \n\n b " * 400, " " * 3_000 + "end", "ab\n\n" + "q" * 2_000 + "\n\n\nz", "é世🤖" * 900,
        "<|endoftext|>" * 90, f"{words}<|endoftext|>\n\n<|endoftext|>  {letters}", letters + "'s" + letters + "'start 'll", "0123456789" * 500,
        "\x1c\x1d  \x1e" * 700, " 　  " * 500, words + "\n\n", "aab" * 3_001,
    ]


def test_spread_texts(spark, library):
    """Texts dealt over tasks in parts of 300 bytes: the rows of the library; copies and null ids stay rows of their own."""
    rows = [(i, t, "x") for i, t in enumerate(long_texts())] * 2 + [(None, long_texts()[0], None), (7, None, None), (8, "short", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, digest string").repartition(4)
    found = encode_texts(docs, leaf=8, spread=300)
    got = sorted((repr(r.doc_id), len(r.ids) // 4, hashlib.sha256(r.ids).hexdigest(), hashlib.sha256(r.decoded.encode()).hexdigest()) for r in found.collect())
    assert got == sorted((repr(i), *expected(library, t)) for i, t, _ in rows)


@pytest.mark.parametrize("leaf", [1, 2, 5, 64])
def test_trees_of_any_leaf(library, leaf):
    own = Encoder(PATH, leaf=leaf)
    for text in long_texts():
        assert ids_of(own, text) == library.encode(text, add_special_tokens=False).ids


def test_long_merge_is_the_short_one(code):
    for text in long_texts()[:4]:
        raw = text.replace(" ", "").encode()[:600]
        assert code.merge_long(raw) == code.merge_short(raw)


def test_long_run_takes_little_time(code, library):
    rng = random.Random(9)
    text = "".join(rng.choice("acgt") for _ in range(200_000))
    assert ids_of(code, text) == library.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t'sdltrevm<|endoftext|>aAéß1٣世 \x1c\x85🤖"), st.characters(codec="utf-8")), max_size=80))
def test_any_text(text):
    want = LIBRARY.encode(text, add_special_tokens=False).ids
    assert ids_of(SMALL_LEAVES, text) == want
    assert SMALL_LEAVES.decode(SMALL_LEAVES.encode(text)) == LIBRARY.decode(want, skip_special_tokens=False)


def test_decoding_any_ids(library, code):
    rng = random.Random(3)
    for _ in range(300):
        ids = [rng.randrange(50257) for _ in range(rng.randrange(12))]
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        assert code.decode(packed) == library.decode(ids, skip_special_tokens=False)


def test_bounded_cache(library):
    own = Encoder(PATH, cache_entries=5)
    for text in long_texts():
        own.encode(text)
        assert len(own) <= 5


def test_classes_of_all_characters(library):
    """Letters, digits, white space and the rest are cut as the library cuts them, for every character of the planes in use."""
    signs = [chr(c) for c in (*range(0x40000), *range(0xE0000, 0xE0200)) if not 0xD800 <= c < 0xE000]
    differing = []
    for at in range(0, len(signs), 4_000):
        text = "".join(f"a{c}1{c}!{c} \n" for c in signs[at : at + 4_000])
        cut = [text[a:b] for _, (a, b) in library.pre_tokenizer.pre_tokenize_str(text)]
        if pre_tokens(text) != cut:
            differing += [c for c in signs[at : at + 4_000] if pre_tokens(t := f"a{c}1{c}!{c} \n") != [t[a:b] for _, (a, b) in library.pre_tokenizer.pre_tokenize_str(t)]]
    assert differing == []

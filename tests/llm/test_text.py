from __future__ import annotations

import random
from collections import Counter

import corpus_pipeline
import numpy as np
from starbuild.llm import quality
from starbuild.llm.packing import pack
from starbuild.llm.quality import accepted, classify, fit
from starbuild.llm.substrings import removed, repeated, sentences, spans
from pyspark.sql import functions as F

from tests.llm.brute import base_secrets, leaks, near_components


def brute_repeats(rows):
    places = {}
    for doc_id, text in rows:
        for first, last, start, stop, h in spans(text or ""):
            places.setdefault(h, set()).add((doc_id, first, last, start, stop))
    covered = {}
    for held in places.values():
        for doc_id, first, last, *_ in sorted(held)[1:]:
            covered.setdefault(doc_id, set()).update(range(first, last + 1))
    out = set()
    for doc_id, text in rows:
        cut = sentences(text or "")
        wanted = sorted(covered.get(doc_id, ()))
        out |= {(doc_id, cut[i][0]) for i in wanted if i - 1 not in wanted}
    return out, covered


def test_substrings_of_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    _, covered = brute_repeats(rows)
    found = repeated(docs).collect()
    assert sum(r["n_sentences"] for r in found) == sum(map(len, covered.values())) > 0
    assert {r["doc_id"] for r in found} == set(covered)
    clean = {r["doc_id"]: r["text"] for r in removed(docs).collect()}
    assert all(clean[d] == t for d, t in rows if d not in covered)
    assert all(r["n_chars"] == len(r["text"]) for r in removed(docs).collect())


def test_planted_passages_are_found_wherever_they_stand(spark):
    r = random.Random(2)
    word = lambda: "".join(r.choices("abcdefghij", k=r.randint(2, 8)))
    prose = lambda n: " ".join(word() + r.choice(["", "", "", "."]) for _ in range(n))
    plain = " ".join(word() for _ in range(70))
    ended = prose(70)
    rows = [(i, f"{prose(40)} {passage}{sep}{prose(30)}") for i, (passage, sep) in enumerate([(plain, " "), (plain, "\n"), (ended, " "), (ended, ". "), (prose(70), " ")])]
    found = repeated(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r["doc_id"], r["kept_in"]) for r in found} == {(1, 0), (3, 2)}


def test_every_passage_of_51_words_is_found_at_all_offsets(spark):
    """51 words of one text inside another, in running text, with no sentence ends, short sentences or other line ends."""
    r = random.Random(5)
    rows, want = [], {}
    for kind, signs in enumerate((["", "", "", "."], [""], ["", "", "", "", "", "", ".", "\n"])):
        word = lambda signs=signs: "".join(r.choices("abcdefghij", k=r.randint(3, 8))) + r.choice(signs)
        source = [word() for _ in range(200)]
        rows.append((1000 * kind, " ".join(source)))
        for at in range(200 - 51 + 1):
            passage = source[at : at + 51]
            here = r.randint(1, 40)
            text = " ".join([word() for _ in range(here)]) + " " + r.choice([" ", "\n"]).join(w.strip() for w in passage) + " " + " ".join(word() for _ in range(30))
            rows.append((1000 * kind + 1 + at, text))
            want[rows[-1][0]] = (here, text.split())
    text_of = dict(rows)
    covered = {}
    for f in repeated(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        before = len(text_of[f["doc_id"]][: f["start"]].split())
        covered.setdefault(f["doc_id"], set()).update(range(before, before + len(text_of[f["doc_id"]][f["start"] : f["stop"]].split())))
    runs = {}
    for d, text in rows:
        w = text.split()
        for i in range(len(w) - 19):
            runs.setdefault(tuple(w[i : i + 20]), set()).add((d, i))
    repeats = {(d, i + j) for places in runs.values() if len(places) > 1 for d, i in sorted(places)[1:] for j in range(20)}
    for d, (here, words) in want.items():
        inner = range(here + 7, here + 51 - 7)
        assert set(inner) <= covered.get(d, set()), (d, here)
        assert {(d, i) for i in covered[d]} <= repeats


def test_repeats_of_whole_sentences_are_found_whole(spark):
    ends = "Ab cd ef gh ij kl mn op qr st uv wx yz ba dc fe hg ji lk nm. Po rq ts. Vu xw zy."
    rows = [(0, f"Other words stand here first. {ends} And after."), (1, f"Not these words. {ends} Nor those\nwords.")]
    row = repeated(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [(r["doc_id"], rows[1][1][r["start"] : r["stop"]]) for r in row] == [(1, ends)]


def test_substrings_of_odd_rows(odd, empty):
    assert removed(odd).columns == odd.columns and removed(odd).count() == odd.count()
    assert repeated(odd).where("doc_id is null").count() == 0
    assert repeated(empty).count() == 0 and removed(empty).count() == 0


def test_classifier_on_held_out_rows(spark):
    at = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{at}/{t}.parquet") for t in ("documents", "labels"))
    rows = classify(docs, labels).join(labels, "doc_id").where("held_out").collect()
    right = np.mean([r["predicted"] == r["quality"] for r in rows])
    good = np.array([r["score"] for r in rows if r["quality"] == 1])
    bad = np.array([r["score"] for r in rows if r["quality"] == 0])
    assert right > 0.93 and np.mean(good[:, None] > bad[None]) > 0.95


def test_classifier_of_odd_rows(spark, odd, empty):
    marks = spark.createDataFrame([(3, 1, 0), (4, None, 1), (None, 1, 1), (5, 0, 0), (6, 1, 0), (5, 1, 0)], "doc_id long, quality int, toxic int")
    rows = classify(odd, marks).collect()
    assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert classify(empty, marks).count() == 0
    assert {r["score"] for r in classify(odd, marks.limit(0)).collect()} == {0.5}
    assert accepted(odd, marks, threshold=0.0).columns == odd.columns


def test_shape_of_whole_words():
    assert quality.shape("a" * 50 + "9") != quality.shape("a" * 50 + "X") and quality.shape("aB9--") == "xX9-"
    known = quality.Buckets()
    assert known["y" * 5000] == known["y" * 5000] and not known
    assert known["word"] == known["word"] and len(known) == 1


def test_network_learns_and_calibrates():
    random_ = np.random.default_rng(1)
    x = random_.normal(size=(2000, 6))
    y = (x[:, 0] * x[:, 1] + 0.3 * random_.normal(size=2000) > 0).astype(float)
    net = fit(x[:1500], y[:1500])
    p = net.probability(x[1500:])
    assert np.mean((p > 0.5) == y[1500:]) > 0.7
    assert abs(p.mean() - y[1500:].mean()) < 0.1


def test_pipeline_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    labels = spark.read.parquet(f"{small}/labels.parquet")
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    names = [n for n, _ in corpus_pipeline.STAGES]
    stages = dict(corpus_pipeline.STAGES)
    good = stages[names[0]](spark, docs, small).cache()
    want = {r["doc_id"] for r in classify(docs, labels).where("predicted = 1").collect()}
    assert good.columns == docs.columns and {r["doc_id"] for r in good.collect()} == want
    text = {r["doc_id"]: r["text"] for r in good.collect()}
    once = stages[names[1]](spark, good, small).cache()
    keep = {c for _, _, c in near_components(sorted(text.items()))}
    assert once.columns == docs.columns and Counter(r["doc_id"] for r in once.collect()) == Counter(keep)
    left = stages[names[2]](spark, once, small).cache()
    bad = {d for d, *_ in leaks([(d, text[d]) for d in keep], items)}
    assert bad and {r["doc_id"] for r in left.collect()} == keep - bad and left.columns == docs.columns
    safe = stages[names[3]](spark, left, small).cache()
    assert safe.columns == docs.columns and safe.count() == left.count()
    for r in safe.collect():
        assert not sum(base_secrets(r["text"])[0].values())
        assert r["n_chars"] == len(r["text"])
        assert r["text"] == text[r["doc_id"]] or sum(base_secrets(text[r["doc_id"]])[0].values())
    packed = stages[names[4]](spark, safe, small)
    assert {r["doc_id"] for r in packed.collect()} == keep - bad
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    whole = corpus_pipeline.run(spark, small).select(*columns)
    assert Counter(map(tuple, whole.collect())) == Counter(map(tuple, packed.select(*columns).collect()))
    assert pack(safe).agg(F.sum("length")).first() == packed.agg(F.sum("length")).first()
    assert quality.THRESHOLD == 0.3

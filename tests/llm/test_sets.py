from __future__ import annotations

import random

from starbuild.llm.decontaminate import contaminated, without_leaks
from starbuild.llm.graph import components
from starbuild.llm.jaccard import first_of_each, near_duplicates

from tests.llm.brute import leaks, near_components


def pairs(frame):
    return [(r["doc_id"], r["text"]) for r in frame.select("doc_id", "text").collect()]


def found(frame):
    return sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in near_duplicates(frame).collect())


def test_near_duplicates_of_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    assert found(docs) == near_components(pairs(docs))


def test_near_duplicates_lose_no_link(spark):
    """Chains of edits around the threshold, many copies, a shared passage, and short texts."""
    r = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = r.choices(vocabulary, k=25)
    rows, base = [], r.choices(vocabulary, k=60)
    for i in range(260):
        text = list(base)
        for _ in range(r.randint(0, 3)):
            text[r.randrange(len(text))] = r.choice(vocabulary)
        if i % 5 == 0:
            base = r.choices(vocabulary, k=r.randint(3, 90))
        if i % 3 == 0:
            text = text[:10] + passage + text[10 : r.randint(12, 60)]
        rows.append((1000 - i, " ".join(text).upper() if i % 7 == 0 else " ".join(text)))
    rows += [(2000 + i, "Same  words\nin the text") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(docs) == near_components(rows)


def test_near_duplicates_of_odd_rows(odd, empty):
    rows = near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    assert all(r["component_id"] is None for r in rows if r["doc_id"] is None)
    want = near_components([p for p in pairs(odd) if p[0] is not None])
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows if r["doc_id"] is not None) == want
    assert near_duplicates(empty).count() == 0
    kept = first_of_each(odd)
    assert kept.columns == odd.columns
    assert kept.where("doc_id is null").count() == 1  # two equal rows


def test_no_row_is_lost_for_its_id(spark):
    """Different texts stay whatever ids they share; near copies go whether or not they have ids."""
    r = random.Random(8)
    words = [f"w{i}" for i in range(300)]
    base = [" ".join(r.choices(words, k=60)) for _ in range(6)]
    near = [f"{t} tail" for t in base]
    rows = [(1, base[0], "a"), (1, base[1], "b"), (1, base[1], "b2"), (None, base[2], "c"), (None, base[2], "d"), (None, near[2], "e")]
    rows += [(7, near[0], "f"), (8, base[3], "g"), (None, near[3], "h"), (1, None, "i"), (1, "", "j"), (None, None, "k"), (None, None, "l")]
    rows += [(20, base[4], "m"), (30, near[4], "n"), (40, base[5], "o")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    kept = first_of_each(docs)
    assert kept.columns == docs.columns
    left = {x["source"] for x in kept.collect()}
    assert len(kept.collect()) == len(left)
    # of each group one: f and a (7 has an id of its own), b or b2, one of c, d, e, and g before h
    assert left - {"b", "b2", "c", "d", "e"} == {"f", "g", "i", "j", "k", "l", "m", "o"}
    assert len(left & {"b", "b2"}) == 1 and len(left & {"c", "d", "e"}) == 1
    alone = docs.where("doc_id > 7")
    assert {x["source"] for x in first_of_each(alone).collect()} == {"g", "m", "o"}
    assert first_of_each(docs.limit(0)).collect() == []


def test_leaks_are_found_without_ids(spark):
    item = "one two three four five six seven eight nine"
    rows = [(1, f"before {item} after", "a"), (1, "nothing in here at all", "b"), (None, f"x {item}", "c"), (None, None, "d"), (2, "", "e"), (3, f"before {item} after", "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    items = spark.createDataFrame([(5, item)], "item_id long, text string")
    assert sorted(r["source"] for r in without_leaks(docs, items).collect()) == ["b", "d", "e"]
    assert without_leaks(docs, items).columns == docs.columns
    assert without_leaks(docs, items.limit(0)).count() == 6


def test_components_of_a_long_path(spark):
    edges = [(i, i + 1) for i in range(100, 180)] + [(5, 7), (7, 5), (9, 9)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 100 for i in range(100, 181)}, 5: 5, 7: 5}


def leak_rows(frame):
    return {(r["doc_id"], r["item_id"], r["n_item_shingles"], r["n_shared"]) for r in frame.collect()}


def test_leaks_in_documents(spark, small):
    docs, items = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "benchmark"))
    want = leaks(pairs(docs), [(r["item_id"], r["text"]) for r in items.collect()])
    assert want and leak_rows(contaminated(docs, items)) == want
    assert leak_rows(contaminated(docs, items, broadcast_rows=0)) == want


def test_leaks_around_the_threshold(spark, odd, empty):
    r = random.Random(5)
    words = [f"v{i}" for i in range(90)]
    items = [(i, " ".join(r.choices(words, k=r.randint(1, 40)))) for i in range(40)]
    items += [(90, items[7][1]), (91, None), (92, "  "), (93, "One TWO"), (None, "one two three four five")]
    docs = []
    for i in range(120):
        item = r.choice(items[:40])[1].split()
        for _ in range(r.randint(0, 2)):
            item[r.randrange(len(item))] = r.choice(words)
        docs.append((i, " ".join(r.choices(words, k=r.randint(0, 200))) + " (" + ", ".join(item).upper() + ") " + " ".join(r.choices(words, k=5))))
    docs += [(0, "v1 v2"), (None, items[3][1])]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame(items, "item_id long, text string")
    assert leak_rows(contaminated(d, i)) == leaks(docs, items)
    assert leak_rows(contaminated(odd, i)) == leaks(pairs(odd), items)
    assert contaminated(empty, i).count() == 0 and contaminated(d, i.limit(0)).count() == 0

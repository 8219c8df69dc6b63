"""Repairs against a plain version: uniform-cost search over (cost, audit)."""

import hashlib
import heapq
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from starbuild.llm.conversations import damaged, repair, repair_report, replay, search
from starbuild.llm.queries import QUERIES

LEGAL = re.compile(r"(s?(ua)+)?")


def cheapest(rows, wrong):
    """(cost, audit, repaired) by trying all edits, cheapest and ASCII-least first; roles decide, no states are kept but what the pattern allows."""
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, initials, out = heapq.heappop(heap)
        if i == len(rows) and LEGAL.fullmatch(initials):
            return cost, audit, list(out)
        # what may follow depends on the last initial only, and on whether there is one
        if (i, initials[-1:]) in done:
            continue
        done.add((i, initials[-1:]))
        steps = [("I", 5, 0, (r, "")) for r in ("user", "assistant")]
        if i < len(rows):
            role, text = rows[i]
            steps.append(("D", 2, 1, None))
            if wrong[i] not in ("blank", "duplicate"):
                more = 5 if wrong[i] else 0
                steps.append(("K", more, 1, (role, text)))
                steps += [("R", 1 + more, 1, (r, text)) for r in ("user", "assistant")]
        for edit, price, used, row in steps:
            new = initials + (row[0][:1] if row else "")
            if not any(LEGAL.fullmatch(new + rest) for rest in ("", "a", "ua")):
                continue
            if row and not row[0][:1]:
                continue
            heapq.heappush(heap, (cost + price, audit + edit, i + used, new, (*out, row) if row else out))
    raise AssertionError


def brute(rows):
    """Of (conv_id, turn, role, text)."""
    by = {}
    for conv, turn, role, text in rows:
        kept = by.setdefault(conv, [])
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        code = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if code == 1:
            text = ""
        if code == 2:
            text = re.sub("[.!?]", "", text)
        if code == 4:
            role = "user"
        kept += [(turn, role, text)] * (0 if code == 0 else 2 if code == 3 else 1)
    out = []
    for conv, kept in by.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        wrong = []
        for i, (_, role, text) in enumerate(kept):
            solid = re.findall(r"[^\x20\x09-\x0D]", text)
            before = [(r, t) for _, r, t in kept[:i]]
            wrong.append("blank" if not solid else "duplicate" if (role, text) in before else "" if solid[-1] in ".!?" else "truncated")
        turns = [t for t, _, _ in kept if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(kept, kept[1:]))
        cost, audit, left = cheapest([r[1:] for r in kept], wrong)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in left).encode()).hexdigest()
        out.append((repr(conv), gaps, *(wrong.count(w) for w in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest))
    return sorted(out)


def rows_of(df):
    assert df.columns[:9] == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return sorted((repr(r[0]), *r[1:]) for r in df.collect())


@pytest.fixture(scope="module")
def odd_talks(spark):
    rng = random.Random(11)
    texts = ["Yes.", "no", "What?", "", " \t\r\n", " ", None, "Done!  ", "a.b", "Repeat this."]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "User", None, "usher"]
    rows = [(c, t if rng.random() < 0.9 else None, rng.choice(roles), rng.choice(texts), "x", 1) for c in range(60) for t in range(rng.randrange(1, 9))]
    rows += [(None, t, ("user", "assistant")[t % 2], f"Line {t}.", None, 2) for t in range(40)]
    rows += [(100, t, ("user", "assistant")[t % 2], f"Line {t // 9}.", None, 2) for t in range(90)]
    rows += [(101, 3, "user", "Same.", None, 2)] * 30 + [(101, 9, "assistant", "Later.", None, 1)] + [(102, None, "system", "Only.", "", 0)] * 7
    rows += [(103, 10 * t - 5, rng.choice(roles), rng.choice(texts), "", 0) for t in range(70)]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, kept string, cost int").repartition(5)


def plain(df):
    return [(r.conv_id, r.turn, r.role, r.text) for r in df.collect()]


def test_whole_table(spark, small):
    rows = plain(spark.read.parquet(f"{small}/conversations.parquet"))
    assert rows_of(QUERIES["op13_conversations"](spark, small)) == brute(rows)


def test_odd_rows(odd_talks):
    assert rows_of(repair_report(odd_talks)) == brute(plain(odd_talks))


@pytest.mark.parametrize(("long", "segment"), [(1, 1), (5, 3), (20, 16)])
def test_segments_give_the_same(odd_talks, long, segment):
    assert rows_of(repair_report(odd_talks, long, segment)) == brute(plain(odd_talks))


def test_no_rows(odd_talks):
    assert repair_report(odd_talks.limit(0)).collect() == []


def test_texts_of_other_ids(spark):
    talk = spark.createDataFrame([("c", 1, "user", "Hi."), ("c", 2, "assistant", "x" * 300_000 + "!")], "conv_id string, turn int, role string, text string")
    got = repair(talk.withColumn("kept", F.lit(True))).collect()
    assert [(r.conv_id, r.cost, r.audit) for r in got] == [("c", 0, "KK")]
    assert [(r.role, len(r.text)) for r in got[0].repaired] == [("user", 3), ("assistant", 300_001)]
    assert damaged(talk).count() > 0


def test_search_of_long_rows():
    signs = "suaUxoau" * 60
    cost, audit = search(signs)
    assert len(audit.replace("I", "")) == len(signs) and cost > 0
    rows = [({"s": "system", "u": "user", "a": "assistant"}.get(c.lower(), "other"), "t") for c in signs]
    assert LEGAL.fullmatch("".join(r["role"][0] for r in replay(rows, audit)))

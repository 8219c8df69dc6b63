"""Clustering against a plain version and against its SQL."""

import hashlib
import math

import pytest
from pyspark.sql import functions as F

from starbuild.llm.centroids import cluster, cluster_report, integer_vectors


def brute(rows, centroids=40, rounds=5):
    kept = []
    for vec_id, e in rows:
        if e is not None and len(e) == 64 and all(x is not None and math.isfinite(x) for x in e):
            kept.append((vec_id, tuple(math.floor(256 * x) for x in e)))
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))
    middle = [r[1] for r in order[:centroids]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(middle))

    for _ in range(rounds):
        members = {}
        for _, v in kept:
            members.setdefault(near(v)[1], []).append(v)
        middle = [tuple(sum(c) // len(m) for c in zip(*m)) if (m := members.get(k)) else middle[k] for k in range(len(middle))]
    found = [(i, *near(v)[::-1]) for i, v in kept]
    by, total = {}, sum(d for _, _, d in found)
    for _, k, d in found:
        by[k] = by.get(k, 0) + d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in middle]
    return sorted((repr(i), k, d, by[k], total, digest[k]) for i, k, d in found)


def rows_of(df):
    return sorted((repr(r.vec_id), r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in df.collect())


@pytest.fixture(scope="module")
def odd_vectors(spark):
    wave = [[math.sin(i * 7.1 + j) * (1 + i % 5) for j in range(64)] for i in range(120)]
    rows = [(i, v, "x", 1) for i, v in enumerate(wave)]
    rows += [(5, wave[5], "x", 1), (5, wave[6], None, 2), (None, wave[7], "x", 1), (None, None, None, None)]
    rows += [(200, [0.0] * 63, "x", 1), (201, [0.0] * 65, "x", 1), (202, [], "x", 1)]
    rows += [(203 + k, [*wave[0][:-1], bad], "x", 1) for k, bad in enumerate((None, math.nan, math.inf, -math.inf))]
    rows += [(300, [0.0] * 64, "x", 1), (301, [-0.001] * 64, "x", 1)]
    rows += [(400 + i, [0.5] * 64, "copy", 1) for i in range(300)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, cluster string, distance int").repartition(5)


def test_odd_rows(odd_vectors):
    plain = [(r.vec_id, r.embedding) for r in odd_vectors.collect()]
    assert rows_of(cluster_report(odd_vectors)) == brute(plain)


def test_few_and_no_vectors(odd_vectors):
    few = odd_vectors.filter(F.col("vec_id").isin(1, 2, 300))
    assert rows_of(cluster_report(few)) == brute([(r.vec_id, r.embedding) for r in few.collect()])
    for none in (odd_vectors.limit(0), odd_vectors.filter("vec_id = 202")):
        assert cluster_report(none).collect() == []
        assert cluster(none)[1] == []


def test_other_parameters(odd_vectors):
    found, middle = cluster(odd_vectors, centroids=3, rounds=1, components=63)
    assert [(r.vec_id, r.cluster, r.distance) for r in found.collect()] == [(200, 0, 0)] and len(middle) == 1


def test_components_too_large_are_an_error(spark):
    huge = spark.createDataFrame([(1, [1e6] * 64)], "vec_id long, embedding array<float>")
    with pytest.raises(Exception, match="would not fit a long"):
        integer_vectors(huge).collect()

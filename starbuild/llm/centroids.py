"""Centroid clustering in integers, all of it in JVM expressions.

Components become integers, so that sums, distances and ties are exact and do not depend on the order of rows. A
distance is |x|^2 + |c|^2 - 2 x.c: `zip_with` and `aggregate` give the product of a vector with each
centroid, and `array_min` over structs (distance, number) names the nearest centroid, the smaller number on
a tie. Literal arrays hold the centroids, several side by side in the bits of each number where the lengths of the vectors allow it. New centroids come from one grouped sum for each component, combined before the shuffle, so that only
one row for each centroid reaches the driver, however large a cluster is.

Defined results: a vector that is null, of another length, or has a null or non-finite component is left out. Rows with
one id are vectors of their own. A null id is kept, and starts a centroid only when too few others do; rows of one
hash start in the order of their components. With fewer vectors than centroids there are as many centroids
as vectors; an empty table gives no rows. Components from 2 ** 19 on have distances beyond a long: they are an error.
Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starbuild.llm.common import materialize
from starbuild.session import materialize_counted

COMPONENTS = 64
SCALE = 256
CENTROIDS = 40
ROUNDS = 5
#: Scaled components up to here keep each sum of squares of a difference within a long, for up to 64 components.
LARGEST = 1 << 27


def integer_vectors(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """vec_id, x (array of long) and norm (the sum of squares) of the vectors that are kept."""
    raw = F.col("embedding").cast("array<double>")
    finite = F.forall(raw, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    scaled = F.transform(raw, lambda x: F.floor(x * scale))
    refuse = F.raise_error(F.lit(f"a component is beyond {LARGEST // scale}: distances would not fit a long"))
    whole = F.when(F.forall(raw, lambda x: F.abs(x) < LARGEST // scale), scaled).otherwise(
        refuse.cast("array<bigint>")
    )
    return (
        vectors.filter((F.size(raw) == components) & finite)
        .select("vec_id", whole.alias("x"))
        .withColumn("norm", F.expr("aggregate(transform(x, a -> a * a), 0L, (sum, a) -> sum + a)"))
    )


def starts(kept: DataFrame, count: int = CENTROIDS) -> list[list[int]]:
    """The vectors with the smallest hashes of their ids."""
    digest = F.sha2(F.concat(F.lit("2:"), F.col("vec_id").cast("string")), 256)
    return [r.x for r in kept.orderBy(digest.asc_nulls_last(), "x").select("x").limit(count).collect()]


def lanes_for(centroids: list[list[int]], largest_norm: int) -> tuple[int, int]:
    """(lanes, bits): how many products with centroids fit side by side in a long, and the width of each.

    No product, nor the sum of some of its terms, is beyond the product of both lengths.
    """
    most = max(sum(c * c for c in centroid) for centroid in centroids)
    bits = ((math.isqrt(largest_norm) + 1) * (math.isqrt(most) + 1)).bit_length() + 1
    return max(1, 63 // bits), bits


def nearest(centroids: list[list[int]], largest_norm: int) -> Column:
    """The struct (distance, cluster) of the centroid nearest to `x`, whose norm is at most `largest_norm`.

    A literal array carries several centroids, each in bits of its own of every element, so that one product of arrays is the
    product with each of them.
    """
    lanes, bits = lanes_for(centroids, largest_norm)
    each = []
    for first in range(0, len(centroids), lanes):
        some = centroids[first : first + lanes]
        literal = ", ".join(f"{sum(c << bits * lane for lane, c in enumerate(column))}L" for column in zip(*some))
        product = f"aggregate(zip_with(x, array({literal}), (a, c) -> a * c), 0L, (sum, p) -> sum + p)"
        structs = []
        for lane, centroid in enumerate(some):
            # the lowest lane is the rest of the number, with its sign; without it, the next one is the lowest
            held = "p" if lane == 0 else f"shiftright(p + {sum(1 << bits * k for k in range(lane)) << bits - 1}L, {bits * lane})"
            own = held if len(some) == 1 or lane == len(some) - 1 else f"shiftright(shiftleft({held}, {64 - bits}), {64 - bits})"
            norm = sum(c * c for c in centroid)
            structs.append(f"named_struct('distance', norm + {norm}L - 2L * {own}, 'cluster', {first + lane})")
        each.append(f"array_min(transform(array({product}), p -> array_min(array({', '.join(structs)}))))")
    return F.expr(f"array_min(array({', '.join(each)}))")


def moved(kept: DataFrame, centroids: list[list[int]], largest_norm: int) -> list[list[int]]:
    """The centroids after one round: the floor of each cluster's mean, or the old one where a cluster is empty."""
    sums = [F.sum(F.col("x")[i]).alias(f"s{i}") for i in range(len(centroids[0]))]
    clusters = (
        kept.select(nearest(centroids, largest_norm)["cluster"].alias("cluster"), "x")
        .groupBy("cluster")
        .agg(F.count("*").alias("n"), *sums)
        .collect()
    )
    new = list(centroids)
    for row in clusters:
        new[row.cluster] = [row[f"s{i}"] // row.n for i in range(len(sums))]
    return new


def cluster(
    vectors: DataFrame,
    centroids: int = CENTROIDS,
    rounds: int = ROUNDS,
    components: int = COMPONENTS,
    scale: int = SCALE,
) -> tuple[DataFrame, list[list[int]]]:
    """vec_id, cluster and distance (squared) of each kept vector of `vectors` (vec_id, embedding), and the centroids."""
    kept, counts = materialize_counted(integer_vectors(vectors, components, scale), largest=F.max("norm"))
    largest = counts["largest"] or 0
    middle = starts(kept, centroids)
    if not middle:
        return kept.selectExpr("vec_id", "0 as cluster", "0L as distance").limit(0), []
    for _ in range(rounds):
        middle = moved(kept, middle, largest)
    best = kept.select("vec_id", nearest(middle, largest).alias("best"))
    return best.select("vec_id", "best.cluster", "best.distance"), middle


def cluster_report(vectors: DataFrame) -> DataFrame:
    """The rows of `cluster` with each cluster's and the whole inertia and the hash of the final centroid."""
    assigned, centroids = cluster(vectors)
    assigned = materialize(assigned)
    found = dict(assigned.groupBy("cluster").agg(F.sum("distance")).collect())
    inertia = [found.get(i, 0) for i in range(len(centroids))]
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    in_cluster = F.expr(f"array({', '.join(f'{n}L' for n in inertia)})" if inertia else "array(0L)")
    digest = F.expr(f"array({', '.join(map(repr, digests or ['']))})")
    return assigned.select(
        "vec_id",
        "cluster",
        "distance",
        in_cluster[F.col("cluster")].alias("cluster_inertia"),
        F.lit(sum(inertia)).cast("bigint").alias("inertia"),
        digest[F.col("cluster")].alias("centroid_sha256"),
    )


def _rounds_sql(rounds: int, components: int, centroids: int) -> str:
    """For DuckDB: assignments a0..aN and centroids c0..cN over the long table x (row, place, value)."""
    steps = []
    for n in range(rounds + 1):
        steps.append(
            f"a{n} AS MATERIALIZED (SELECT rid, min(d * {centroids} + k) AS best FROM (SELECT x.rid, c.k, "
            f"sum((x.v - c.v) * (x.v - c.v)) AS d FROM x JOIN c{n} AS c USING (i) GROUP BY x.rid, c.k) GROUP BY rid)"
        )
        if n < rounds:
            steps.append(
                f"c{n + 1} AS MATERIALIZED (SELECT c.k, c.i, CAST(coalesce(s.v, c.v) AS BIGINT) AS v FROM c{n} AS c LEFT JOIN "
                f"(SELECT a.best % {centroids} AS k, x.i, (sum(x.v) - (sum(x.v) % count(*) + count(*)) % count(*)) // count(*) AS v "
                f"FROM x JOIN a{n} AS a USING (rid) GROUP BY 1, 2) AS s ON c.k = s.k AND c.i = s.i)"
            )
    return ",\n".join(steps)


ORACLE_SQL = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS rid, vec_id,
    [CAST(floor({SCALE} * CAST(e AS DOUBLE)) AS BIGINT) FOR e IN embedding] AS vec
  FROM embeddings
  WHERE len(embedding) = {COMPONENTS} AND len([e FOR e IN embedding IF e IS NOT NULL AND isfinite(e)]) = {COMPONENTS}
),
x AS MATERIALIZED (SELECT rid, unnest(range({COMPONENTS})) AS i, unnest(vec) AS v FROM kept),
first AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('2:' || CAST(vec_id AS VARCHAR)), vec) - 1 AS k, vec
  FROM kept QUALIFY k < {CENTROIDS}
),
c0 AS MATERIALIZED (SELECT k, unnest(range({COMPONENTS})) AS i, unnest(vec) AS v FROM first),
{_rounds_sql(ROUNDS, COMPONENTS, CENTROIDS)},
digests AS (SELECT k, sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c{ROUNDS} GROUP BY k),
assigned AS (
  SELECT vec_id, CAST(best % {CENTROIDS} AS INTEGER) AS cluster, CAST(best // {CENTROIDS} AS BIGINT) AS distance
  FROM a{ROUNDS} JOIN kept USING (rid)
)
SELECT vec_id, cluster, distance,
  CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM assigned JOIN digests ON k = cluster
"""

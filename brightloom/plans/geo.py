"""Spatial statistics on the first dimensions of the embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightloom.functions.common import rounded
from brightloom.operators import spatial
from brightloom.plans.registry import Tables, query
from brightloom.session import cut

# Points at dimensions 1 and 2, valued by dimension 3.
POINTS = """
pts AS (SELECT vec_id AS id, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y, CAST(embedding[3] AS DOUBLE) AS v FROM embeddings),
knn AS (SELECT a.id AS i, b.id AS j, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS distance,
   row_number() OVER (PARTITION BY a.id ORDER BY (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y), b.id) AS position
  FROM pts a JOIN pts b ON a.id <> b.id QUALIFY position <= 8),
dev AS (SELECT id, v - (SELECT avg(v) FROM pts) AS z FROM pts)
"""
# Occupied unit cells of a 30 x 30 raster over the same points, valued by their points' mean.
CELLS = """
cells AS (SELECT CAST(floor(embedding[1]::DOUBLE * 30) AS BIGINT) AS cx, CAST(floor(embedding[2]::DOUBLE * 30) AS BIGINT) AS cy, avg(CAST(embedding[3] AS DOUBLE)) AS v FROM embeddings GROUP BY 1, 2),
qn AS (SELECT a.cx AS ax, a.cy AS ay, b.cx AS bx, b.cy AS by_, b.v FROM cells a JOIN cells b ON abs(a.cx - b.cx) <= 1 AND abs(a.cy - b.cy) <= 1 AND (a.cx <> b.cx OR a.cy <> b.cy))
"""


def points(t: Tables) -> DataFrame:
    e = F.col("embedding")
    return t.embeddings.select(F.col("vec_id").alias("id"), e[0].cast("double").alias("x"), e[1].cast("double").alias("y"), e[2].cast("double").alias("v"))


def knn_weights(t: Tables, k: int = spatial.DEFAULT_K) -> DataFrame:
    return cut(spatial.row_weights(spatial.nearest(points(t), "id", "x", "y", k)))


def cells(t: Tables) -> DataFrame:
    """Unit squares as closed rings with a text key."""
    p = points(t).groupBy(F.floor(F.col("x") * 30).alias("cx"), F.floor(F.col("y") * 30).alias("cy")).agg(F.avg("v").alias("v"))
    corners = [(0, 0), (1, 0), (1, 1), (0, 1), (0, 0)]
    ring = F.array(*[F.struct((F.col("cx") + a).cast("double").alias("x"), (F.col("cy") + b).cast("double").alias("y")) for a, b in corners])
    return p.select(F.concat_ws(":", "cx", "cy").alias("id"), "v", ring.alias("ring"))


@query("geo_knn", f"WITH {POINTS} SELECT i, j, CAST(position AS INTEGER) AS position, round(distance, 9) AS distance FROM knn WHERE position <= 6")
def _(t):
    return rounded(spatial.nearest(points(t), "id", "x", "y"), 9)


@query("geo_queen", f"WITH {CELLS} SELECT ax || ':' || ay AS i, bx || ':' || by_ AS j FROM qn")
def _(t):
    return spatial.queen(cells(t), "id", "ring")


@query("geo_isolates", f"WITH {CELLS} SELECT cx || ':' || cy AS i FROM cells WHERE NOT EXISTS (SELECT 1 FROM qn WHERE ax = cx AND ay = cy)")
def _(t):
    c = cut(cells(t))
    return spatial.isolates(c, "id", spatial.queen(c, "id", "ring"))


@query("geo_spatial_lag", f"WITH {POINTS} SELECT i, round(avg(v), 9) AS lag FROM knn JOIN pts ON j = pts.id WHERE position <= 6 GROUP BY i")
def _(t):
    return rounded(spatial.spatial_lag(knn_weights(t), points(t).select("id", "v")), 9)


LOCAL = f"""{POINTS}, lagged AS (SELECT i, a.z, avg(b.z) AS lag FROM knn JOIN dev a ON i = a.id JOIN dev b ON j = b.id WHERE position <= 6 GROUP BY ALL)"""


@query("geo_moran_global", f"""WITH {LOCAL} SELECT count(*) AS n, 0::BIGINT AS isolates, round(sum(z * lag) / sum(z * z), 9) AS moran_i, round(-1.0 / (count(*) - 1), 9) AS expected_i FROM lagged""")
def _(t):
    return rounded(spatial.moran_global(knn_weights(t), points(t).select("id", "v")), 9)


@query("geo_moran_local", f"""WITH {LOCAL} SELECT i, round((count(*) OVER () - 1) * z * lag / sum(z * z) OVER (), 9) AS local_i,
  CASE WHEN z > 0 AND lag > 0 THEN 'High-High' WHEN z > 0 THEN 'High-Low' WHEN lag > 0 THEN 'Low-High' ELSE 'Low-Low' END AS quadrant FROM lagged""")
def _(t):
    return rounded(spatial.moran_local(knn_weights(t), points(t).select("id", "v")).select("i", "local_i", "quadrant"), 9)


@query("geo_moran_sensitivity", f"""WITH {POINTS}, ks AS (SELECT unnest([4, 6, 8]) AS k),
lg AS (SELECT k, i, a.z, avg(b.z) AS lag FROM ks JOIN knn ON position <= k JOIN dev a ON i = a.id JOIN dev b ON j = b.id GROUP BY ALL),
{CELLS}, m AS (SELECT avg(v) AS mu, count(*) AS n, sum(power(v - (SELECT avg(v) FROM cells), 2)) AS zz FROM cells),
ql AS (SELECT ax, ay, avg(qn.v - mu) AS lag FROM qn, m GROUP BY 1, 2)
SELECT 'k' || k AS scheme, count(*) AS n, 0::BIGINT AS isolates, round(sum(z * lag) / sum(z * z), 9) AS moran_i FROM lg GROUP BY k
UNION ALL SELECT 'queen', any_value(n), any_value(n) - count(*), round(any_value(n) / count(*) * sum((v - mu) * lag) / any_value(zz), 9) FROM ql JOIN cells ON ax = cx AND ay = cy, m""")
def _(t):
    by_k = spatial.sensitivity(points(t), points(t).select("id", "v"), "id", "x", "y").withColumn("scheme", F.concat(F.lit("k"), F.col("k")))
    c = cut(cells(t))
    q = spatial.moran_global(cut(spatial.row_weights(spatial.queen(c, "id", "ring"))), c.select("id", "v")).withColumn("scheme", F.lit("queen"))
    cols = ["scheme", "n", "isolates", "moran_i"]
    return rounded(by_k.select(*cols).unionByName(q.select(*cols)), 9)


@query("geo_moran_significance")
def _(t):
    w, v = knn_weights(t), points(t).select("id", "v")
    n = spatial.moran_normal(w, v).select("n", "expected_i", "z_norm", "p_norm")
    one = spatial.moran_permutations(w, v)
    packed = n.agg(F.first(F.struct("n", "expected_i", "z_norm", "p_norm"))).scalar()
    return rounded(one.withColumn("_n", packed).select("*", "_n.*").drop("_n"))


def _network(x: str) -> str:
    """The shuffle's Feistel network in DuckDB's words, on columns lo, hi and perm."""
    right, left = "CASE WHEN i % 2 = 0 THEN lo ELSE hi END", "CASE WHEN i % 2 = 0 THEN hi ELSE lo END"
    own = f"(acc % ({right}))"
    m1 = f"(({own} * 48271 + perm * 69621 + i * 16807 + {spatial.SEED}) % {spatial.PRIME})"
    m2 = f"((({m1} * {m1}) % {spatial.PRIME} * 39373 + {own}) % {spatial.PRIME})"
    return f"list_reduce({[*range(spatial.ROUNDS)]}::BIGINT[], lambda acc, i: {own} * ({left}) + xor(acc // ({right}), {m2} % ({left})), CAST({x} AS BIGINT))"


@query("geo_moran_permuted", f"""WITH RECURSIVE {POINTS}, o AS (SELECT id, z, row_number() OVER (ORDER BY id) - 1 AS own FROM dev),
b AS (SELECT n, CAST(1 AS BIGINT) << (bits - bits // 2) AS lo, CAST(1 AS BIGINT) << (bits // 2) AS hi FROM (SELECT count(*) AS n, CAST(floor(log2(count(*) - 1)) AS INTEGER) + 1 AS bits FROM o)),
s AS (SELECT perm, own, {_network('own')} AS x FROM o, b, range(1, {spatial.PERMUTATIONS + 1}) p(perm) UNION ALL SELECT perm, own, {_network('x')} FROM s, b WHERE x >= n),
d AS (SELECT perm, a.id, t.z FROM s JOIN b ON x < n JOIN o a ON a.own = s.own JOIN o t ON t.own = x),
lag AS (SELECT perm, knn.i, avg(d.z) AS lag FROM knn JOIN d ON d.id = knn.j WHERE position <= 6 GROUP BY 1, 2),
zz AS (SELECT sum(z * z) AS zz FROM dev), sims AS (SELECT perm, sum(z * lag) / any_value(zz) AS sim FROM lag JOIN d USING (perm), zz WHERE d.id = lag.i GROUP BY perm),
obs AS (SELECT sum(a.z * l.lag) / any_value(zz) AS obs FROM (SELECT knn.i, avg(z) AS lag FROM knn JOIN dev ON dev.id = knn.j WHERE position <= 6 GROUP BY 1) l JOIN dev a ON a.id = l.i, zz),
r AS (SELECT any_value(obs) AS obs, count(*) FILTER (WHERE sim >= obs) AS above, avg(sim) AS m, stddev_pop(sim) AS sd, count(*) AS perms FROM sims, obs)
SELECT round(obs, 6) AS moran_i, round((least(above, perms - above) + 1) / (perms + 1), 6) AS p_sim, round((obs - m) / sd, 6) AS z_sim, CAST(perms AS INTEGER) AS permutations, (least(above, perms - above) + 1) / (perms + 1) < 0.05 AS significant FROM r""")
def _(t):
    return rounded(spatial.moran_permutations(knn_weights(t), points(t).select("id", "v")))


@query("geo_local_clusters")
def _(t):
    return rounded(spatial.local_clusters(knn_weights(t), points(t).select("id", "v")))

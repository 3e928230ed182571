"""DuckDB SQL for the two clustering operators: the rounds written out as common tables."""

from __future__ import annotations

_FINITE = "len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)"


def _kept(scale: int, extra: str) -> str:
    return f"""
    kept AS MATERIALIZED (
      SELECT row_number() OVER () AS r, vec_id, label,
             list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
      FROM embeddings WHERE embedding IS NOT NULL AND {_FINITE} AND {extra})"""


_FLOOR = "CAST((sum(k.x) - ((sum(k.x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT)"


def heap_clusters_sql(k: int = 16, rounds: int = 3) -> str:
    steps = [_kept(64, "len(embedding) = 64"), """
    comps AS MATERIALIZED (SELECT r, unnest(range(1, 65)) AS i, unnest(v) AS x FROM kept)""", f"""
    first AS (
      SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), vec_id, v) - 1 AS c, v
      FROM kept WHERE vec_id IS NOT NULL ORDER BY 1 LIMIT {k})""", """
    c0 AS MATERIALIZED (SELECT c, unnest(range(1, 65)) AS i, unnest(v) AS x FROM first)"""]
    for n in range(rounds + 1):
        steps.append(f"""
    d{n} AS (SELECT r, c, CAST(sum((k.x - e.x) * (k.x - e.x)) AS BIGINT) AS d
      FROM comps k JOIN c{n} e ON k.i = e.i GROUP BY r, c),
    a{n} AS MATERIALIZED (SELECT r, c, d FROM (
      SELECT *, row_number() OVER (PARTITION BY r ORDER BY d, c) AS p FROM d{n}) WHERE p = 1)""")
        if n < rounds:
            steps.append(f"""
    c{n + 1} AS MATERIALIZED (
      SELECT e.c, e.i, coalesce(m.x, e.x) AS x FROM c{n} e LEFT JOIN (
        SELECT a.c, k.i, {_FLOOR} AS x FROM a{n} a JOIN comps k ON a.r = k.r GROUP BY a.c, k.i) m
      ON e.c = m.c AND e.i = m.i)""")
    steps.append(f"""
    named AS (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS h FROM c{rounds} GROUP BY c)""")
    return f"""WITH {','.join(steps)}
    SELECT vec_id, CAST(c AS INT) AS cluster, d AS distance,
           CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
           h AS centroid_sha256
    FROM a{rounds} JOIN kept USING (r) JOIN named USING (c)"""


def dual_tree_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    steps = [_kept(4096, f"len(embedding) % {parts} = 0"), f"""
    comps AS MATERIALIZED (
      SELECT r, (i - 1) // (n // {parts}) AS p, (i - 1) % (n // {parts}) AS i, x
      FROM (SELECT r, len(v) AS n, unnest(range(1, len(v) + 1)) AS i, unnest(v) AS x FROM kept))""", f"""
    first AS (
      SELECT r, row_number() OVER (ORDER BY vec_id, v) - 1 AS c FROM kept WHERE vec_id IS NOT NULL
      ORDER BY 2 LIMIT {entries})""", """
    c0 AS MATERIALIZED (SELECT c, p, i, x FROM comps JOIN first USING (r))"""]
    for n in range(rounds + 1):
        steps.append(f"""
    d{n} AS (SELECT k.r, k.p, c, CAST(sum((k.x - e.x) * (k.x - e.x)) AS BIGINT) AS d
      FROM comps k JOIN c{n} e ON k.p = e.p AND k.i = e.i GROUP BY k.r, k.p, c),
    a{n} AS MATERIALIZED (SELECT r, p, c, d FROM (
      SELECT *, row_number() OVER (PARTITION BY r, p ORDER BY d, c) AS o FROM d{n}) WHERE o = 1)""")
        if n < rounds:
            steps.append(f"""
    c{n + 1} AS MATERIALIZED (
      SELECT e.c, e.p, e.i, coalesce(m.x, e.x) AS x FROM c{n} e LEFT JOIN (
        SELECT a.c, k.p, k.i, {_FLOOR} AS x FROM a{n} a JOIN comps k ON a.r = k.r AND a.p = k.p
        GROUP BY a.c, k.p, k.i) m ON e.c = m.c AND e.p = m.p AND e.i = m.i)""")
    return f"""WITH {','.join(steps)},
    coded AS (
      SELECT r, string_agg(printf('%02x', CAST(c AS INT)), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
      FROM a{rounds} GROUP BY r),
    books AS (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY p, c, i)) AS h FROM c{rounds})
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
           h AS codebooks_sha256
    FROM coded JOIN kept USING (r), books"""

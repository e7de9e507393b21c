"""DuckDB SQL of the prefix trie and of clustering, from their definitions."""

from __future__ import annotations

from landfall.llm import centroids, prefix_trie

# The polynomial of crc32, bits reversed.
_CRC = 3988292384


def _crc32(text: str) -> str:
    bit = f"list_reduce(list_prepend(v, [0, 0, 0, 0, 0, 0, 0, 0]), lambda a, z: xor(a >> 1, {_CRC} * (a & 1)))"
    step = bit.replace("(v,", "(xor(c, b),")
    bytes_ = f"list_transform(string_split({text}, ''), lambda ch: ascii(ch)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {bytes_}), lambda c, b: {step}), 4294967295)"


def prefix_tree() -> str:
    return f"""WITH t AS (SELECT conv_id AS c, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL),
    k AS (SELECT c, turn, md5(length(r) || ':' || r || x) AS m, strlen(x) AS n FROM t),
    o AS (SELECT c, m, n, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, m) AS i FROM k),
    ids AS (SELECT c, {_crc32('c::VARCHAR')} % {prefix_trie.HEADS} AS h, count(*) AS own FROM o GROUP BY c),
    base AS (SELECT a.c, a.h, coalesce(least(a.h, b.own), 0) AS taken FROM ids a LEFT JOIN ids b ON b.c = a.c - a.c % {prefix_trie.FAMILY}),
    turns AS (SELECT base.c, o.i AS d, m, n FROM base JOIN o ON o.c = base.c - base.c % {prefix_trie.FAMILY} AND o.i <= base.h
        UNION ALL SELECT base.c, taken + o.i - h, m, n FROM base JOIN o ON o.c = base.c AND o.i > h),
    rows_ AS (SELECT c, d, n, md5(array_to_string(list(m) OVER (PARTITION BY c ORDER BY d), '')) AS node FROM turns
        UNION ALL SELECT c, 0, 0, 'root' FROM base),
    linked AS (SELECT *, lag(node) OVER (PARTITION BY c ORDER BY d) AS parent, d = max(d) OVER (PARTITION BY c) AS ended FROM rows_),
    nodes AS (SELECT node, any_value(parent) AS parent, any_value(d) AS depth, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(n) AS saved,
        sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ended), '')) AS ends_sha256 FROM linked GROUP BY node),
    children AS (SELECT parent AS node, count(*) AS n FROM nodes WHERE parent IS NOT NULL GROUP BY 1),
    below AS (SELECT r.node, sum(v.saved) AS saved_tokens, count(*) FILTER (v.node NOT IN (SELECT node FROM children)) AS n_leaves
        FROM nodes v JOIN linked r ON r.c = v.conv_id AND r.d <= v.depth GROUP BY 1)
    SELECT a.conv_id, a.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, a.n_convs, coalesce(children.n, 0) AS n_children, n_leaves::BIGINT AS n_leaves,
        saved_tokens::BIGINT AS saved_tokens, a.ends_sha256
    FROM nodes a LEFT JOIN nodes p ON p.node = a.parent LEFT JOIN children ON children.node = a.node JOIN below ON below.node = a.node"""


def clustering() -> str:
    k, size = centroids.CLUSTERS, centroids.DIMENSION
    apart = "list_sum(list_transform(range(1, %d), lambda i: (v[i] - p[i]) * (v[i] - p[i])))" % (size + 1)
    parts = [f"""points AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: least(greatest(floor({centroids.SCALE} * x::DOUBLE), -{centroids.MOST}), {centroids.MOST})::BIGINT) AS v
        FROM embeddings WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {size}),
    c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h) - 1 AS j, v AS p FROM (SELECT sha256('{centroids.SEED}:' || vec_id) AS h, v FROM points ORDER BY h LIMIT {k}))"""]
    for step in range(centroids.ROUNDS + 1):
        parts.append(f"a{step} AS MATERIALIZED (SELECT r, min(({apart}, j)) AS best FROM points, c{step} GROUP BY r)")
        if step < centroids.ROUNDS:
            parts.append(f"""m{step} AS (SELECT j, list(m ORDER BY i) AS p FROM (SELECT best[2] AS j, i, ((sum(v[i]) - ((sum(v[i]) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS m
                FROM a{step} JOIN points USING (r), range(1, {size + 1}) AS g(i) GROUP BY 1, 2) GROUP BY j),
            c{step + 1} AS MATERIALIZED (SELECT j, coalesce(m{step}.p, c{step}.p) AS p FROM c{step} LEFT JOIN m{step} USING (j))""")
    last = centroids.ROUNDS
    return f"""WITH {', '.join(parts)}
    SELECT vec_id, best[2]::INTEGER AS "cluster", best[1]::BIGINT AS distance, (sum(best[1]) OVER (PARTITION BY best[2]))::BIGINT AS cluster_inertia,
        (sum(best[1]) OVER ())::BIGINT AS inertia, sha256(array_to_string(p, ',')) AS centroid_sha256
    FROM a{last} JOIN points USING (r) JOIN c{last} ON j = best[2]"""


def oracle_sql() -> dict[str, str]:
    return {"op12_prefix_trie": prefix_tree(), "op13_centroids": clustering()}

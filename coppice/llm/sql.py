"""SQL counterparts of the queries that SQL can express."""

ORACLES: dict[str, str] = {}

ORACLES["op7_norm_buckets"] = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS c
    FROM embeddings
    WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, x.vec_id AS vec_id,
           CAST(list_sum(list_transform(list_zip(q.c, x.c), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM v q JOIN v x ON q.vec_id <> x.vec_id AND len(q.c) = len(x.c)
    WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM scored)
WHERE n <= 5
"""

ORACLES["op4_minhash_components"] = """
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w
    FROM documents
), shingle AS (
    SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM words WHERE len(w) > 0)
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id
), common AS (
    SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c
    FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id <> b.doc_id
    GROUP BY ALL
), links AS (
    SELECT u, v FROM common JOIN sizes x ON x.doc_id = u JOIN sizes y ON y.doc_id = v
    WHERE 100 * c >= 85 * (x.n + y.n - c)
), reach(node, other) AS (
    SELECT u, v FROM links
    UNION
    SELECT r.node, l.v FROM reach r JOIN links l ON l.u = r.other
), least AS (
    SELECT node, min(other) AS m FROM reach GROUP BY node
)
SELECT d.doc_id, CAST(coalesce(s.n, 0) AS BIGINT) AS n_shingles,
       least(d.doc_id, coalesce(l.m, d.doc_id)) AS component_id,
       l.m IS NULL OR d.doc_id <= l.m AS kept
FROM documents d LEFT JOIN sizes s USING (doc_id) LEFT JOIN least l ON l.node = d.doc_id
"""


def path_templates_sql(
    rules: list[tuple[str, str]], depth: int, least_pages: int, apart: float, weight: float, least_purity: float
) -> str:
    """The URL filter: a step for each level of the tree, then one for each level of merging.

    It fails where ``least_pages`` pages go deeper than ``depth`` levels together.
    """
    longest = sorted(rules, key=lambda r: -len(r[1]))

    def fits(text: str) -> str:
        host, slash, rest = text.partition("/")
        return f"((host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{slash}{rest}'))"

    rule = "CASE " + " ".join(f"WHEN {fits(t)} THEN '{t}'" for _, t in longest) + " END"
    verdict = "CASE " + " ".join(f"WHEN {fits(t)} THEN '{v}'" for v, t in longest) + " END"
    steps = [
        "cut AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages)",
        "known AS (SELECT doc_id, count(quality) AS labelled, count(*) FILTER (quality = 1) AS good FROM labels GROUP BY doc_id)",
        "whole AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
        "'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut)",
        "listed AS (SELECT *, list_filter(string_split(path, '/'), lambda s: s <> '') AS every FROM whole)",
        f"p0 AS (SELECT page_id, host, path, every AS segments, '' AS template, "
        "coalesce(labelled, 0) AS labelled, coalesce(good, 0) AS good FROM listed LEFT JOIN known ON doc_id = page_id)",
    ]
    for d in range(depth):
        steps += [
            f"c{d} AS (SELECT host, template, segments[{d + 1}] AS segment, count(*) AS n FROM p{d} WHERE len(segments) > {d} GROUP BY ALL)",
            f"f{d} AS (SELECT host, template FROM c{d} GROUP BY ALL HAVING sum(n) < {least_pages})",
            f"p{d + 1} AS (SELECT p.* REPLACE (CASE WHEN f.host IS NOT NULL AND len(p.segments) > {d} THEN p.segments[1:{d + 1}] ELSE p.segments END AS segments, "
            f"CASE WHEN len(p.segments) <= {d} THEN p.template WHEN f.host IS NOT NULL THEN p.template || '/**' "
            f"ELSE p.template || '/' || coalesce(c.segment, '*') END AS template) FROM p{d} p "
            f"LEFT JOIN f{d} f ON f.host = p.host AND f.template = p.template LEFT JOIN c{d} c "
            f"ON c.n >= {least_pages} AND c.host = p.host AND c.template = p.template AND c.segment = p.segments[{d + 1}])",
        ]
    steps += [
        f"placed AS (SELECT * REPLACE (CASE WHEN len(segments) > {depth} THEN error('more than {depth} levels') ELSE template END AS template) "
        f"FROM p{depth})",
        "o AS (SELECT CASE WHEN sum(labelled) > 0 THEN sum(good)::double / sum(labelled)::double ELSE 1.0::double END AS overall FROM placed)",
        "t0 AS (SELECT host, template, sum(labelled)::double AS labelled, sum(good)::double AS good, '' AS branch, "
        "CASE WHEN template = '' THEN [] ELSE string_split(substr(template, 2), '/') END AS parts FROM placed GROUP BY ALL)",
    ]
    smoothed = f"(g + {weight}::double * overall) / (l + {weight}::double)"
    for d in range(depth):
        steps += [
            f"s{d} AS (SELECT *, {smoothed} AS purity FROM (SELECT host, branch, parts[{d + 1}] AS part, sum(labelled) AS l, sum(good) AS g "
            f"FROM t{d} WHERE len(parts) > {d} GROUP BY ALL), o)",
            f"b{d} AS (SELECT *, lag(l) OVER w AS pl, lag(g) OVER w AS pg FROM s{d} WINDOW w AS (PARTITION BY host, branch ORDER BY l = 0, purity, part))",
            f"q{d} AS (SELECT *, (g + pg) / (l + pl) AS pooled FROM b{d})",
            f"a{d} AS (SELECT *, CASE WHEN l > 0 AND pl > 0 THEN (abs(g / l - pg / pl) > {apart}::double * sqrt(pooled * (1 - pooled) * "
            f"(1 / l + 1 / pl)))::int WHEN l = 0 AND pl > 0 THEN 1 ELSE 0 END AS apart FROM q{d})",
            f"g{d} AS (SELECT *, sum(apart) OVER (PARTITION BY host, branch ORDER BY l = 0, purity, part ROWS UNBOUNDED PRECEDING) AS grp FROM a{d})",
            f"n{d} AS (SELECT host, branch, part, min(part) OVER (PARTITION BY host, branch, grp) AS name FROM g{d})",
            f"t{d + 1} AS (SELECT t.* REPLACE (CASE WHEN n.part IS NULL THEN t.branch ELSE t.branch || '/' || n.name END AS branch) "
            f"FROM t{d} t LEFT JOIN n{d} n ON n.host = t.host AND n.branch = t.branch AND n.part = t.parts[{d + 1}])",
        ]
    last = f"t{depth}"
    steps.append(
        f"pure AS (SELECT host, branch, {smoothed} AS purity FROM (SELECT host, branch, sum(labelled) AS l, sum(good) AS g FROM {last} GROUP BY ALL), o)"
    )
    return (
        "WITH " + ",\n".join(s.replace(" AS (", " AS MATERIALIZED (", 1) for s in steps)
        + f"\nSELECT page_id, host, path, {rule} AS rule, coalesce({verdict}, CASE WHEN purity < {least_purity} THEN 'block' ELSE 'allow' END) "
        f"AS verdict FROM placed JOIN {last} USING (host, template) JOIN pure USING (host, branch)"
    )


ORACLES["op9_path_templates"] = path_templates_sql(
    [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")],
    depth=8, least_pages=5, apart=1.96, weight=20.0, least_purity=0.8,
)

_CRC32 = """xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(conv_id::VARCHAR, ''),
        lambda s: [ascii(s)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END))"""

ORACLES["op12_prefix_trie"] = f"""
WITH placed AS MATERIALIZED (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
    FROM conversations WHERE conv_id IS NOT NULL
), told AS MATERIALIZED (
    SELECT conv_id, pos, dense_rank() OVER (ORDER BY role, text) AS k,
           len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words
    FROM placed
), convs AS MATERIALIZED (
    SELECT conv_id, conv_id - conv_id % 20 AS base, ({_CRC32} % 4) AS h FROM (SELECT DISTINCT conv_id FROM placed)
), rebuilt AS MATERIALIZED (
    SELECT c.conv_id, 0 AS own, t.pos, t.k, t.words FROM convs c JOIN told t ON t.conv_id = c.base AND t.pos <= c.h
    UNION ALL
    SELECT c.conv_id, 1, t.pos, t.k, t.words FROM convs c JOIN told t ON t.conv_id = c.conv_id AND t.pos > c.h
), whole AS MATERIALIZED (
    SELECT c.conv_id, coalesce(s, []) AS s, coalesce(w, []) AS w FROM convs c LEFT JOIN (
        SELECT conv_id, list(k ORDER BY own, pos) AS s, list(words ORDER BY own, pos) AS w FROM rebuilt GROUP BY conv_id
    ) USING (conv_id)
), members AS MATERIALIZED (
    SELECT conv_id, d, s[1:d] AS p, coalesce(w[d], 0) AS words, len(s) = d AS ended
    FROM (SELECT *, unnest(range(0, len(s) + 1)) AS d FROM whole)
), nodes AS MATERIALIZED (
    SELECT d, p, min(conv_id) AS conv_id, count(*) AS n, any_value(words) AS words,
           sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ended), '')) AS ends_sha256
    FROM members GROUP BY d, p
), named AS MATERIALIZED (
    SELECT m.conv_id AS member, m.d, n.conv_id AS node FROM members m JOIN nodes n USING (d, p)
), parents AS MATERIALIZED (
    SELECT n.*, a.node AS parent FROM nodes n LEFT JOIN named a ON a.member = n.conv_id AND a.d = n.d - 1
), children AS MATERIALIZED (
    SELECT parent, d - 1 AS d, count(*) AS n_children FROM parents WHERE d > 0 GROUP BY ALL
), sums AS (
    SELECT a.node, a.d, sum((n.n - 1) * n.words) AS saved, count(*) FILTER (c.n_children IS NULL) AS leaves
    FROM nodes n JOIN named a ON a.member = n.conv_id AND a.d <= n.d LEFT JOIN children c ON c.parent = n.conv_id AND c.d = n.d
    GROUP BY ALL
)
SELECT n.conv_id, n.d::BIGINT AS depth, n.parent AS parent_conv_id, n.n AS n_convs,
       coalesce(c.n_children, 0)::BIGINT AS n_children, s.leaves AS n_leaves, s.saved::BIGINT AS saved_tokens, n.ends_sha256
FROM parents n JOIN sums s ON s.node = n.conv_id AND s.d = n.d LEFT JOIN children c ON c.parent = n.conv_id AND c.d = n.d
"""

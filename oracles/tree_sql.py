"""Decision-tree training as one SQL statement, level by level, without shortcuts."""

from __future__ import annotations


def _impurity(counts: list[str], criterion: str) -> str:
    n = "(" + " + ".join(counts) + ")"
    share = [f"(cast({c} as double) / {n})" for c in counts]
    if criterion == "gini":
        value = "1 - (" + " + ".join(f"{p} * {p}" for p in share) + ")"
    else:
        value = "-(" + " + ".join(
            f"CASE WHEN {c} > 0 THEN {p} * log2({p}) ELSE 0 END" for c, p in zip(counts, share)
        ) + ")"
    return f"CASE WHEN {n} = 0 THEN 0 ELSE {value} END"


def tree_ctes(
    base: str,
    features: list[tuple[str, bool]],
    labels: list[str],
    depth: int,
    criterion: str = "entropy",
    min_samples: int = 2,
) -> str:
    """Common table expressions ending in ``node_rows`` and ``placed``.

    ``base`` gives rid, tree, y, w (1: row is trained on) and f0, f1, ... per feature;
    ``features`` are (name, is_numeric). ``placed`` holds the leaf of every row.
    """
    k = range(len(labels))
    parts = [f"base AS MATERIALIZED ({base})"]
    longs = []
    for i, (_, is_numeric) in enumerate(features):
        num = f"CASE WHEN isnan(cast(f{i} as double)) THEN NULL ELSE cast(f{i} as double) END" if is_numeric else "cast(NULL as double)"
        text = "cast(NULL as varchar)" if is_numeric else f"cast(f{i} as varchar)"
        longs.append(f"SELECT rid, tree, y, w, {i} AS f, {num} AS num, {text} AS str FROM base")
    parts.append("long AS MATERIALIZED (" + " UNION ALL ".join(longs) + ")")
    numeric = [str(i) for i, (_, is_numeric) in enumerate(features) if is_numeric] or ["-1"]
    parts.append(
        f"kinds AS MATERIALIZED (SELECT tree, f, f IN ({', '.join(numeric)}) AND count(DISTINCT num) + "
        "max(CASE WHEN num IS NULL THEN 1 ELSE 0 END) > 15 AS cont FROM long WHERE w = 1 GROUP BY tree, f)"
    )
    parts.append("at0 AS MATERIALIZED (SELECT rid, '' AS path FROM base)")
    sums = ", ".join(f"sum(CASE WHEN y = '{v}' THEN 1 ELSE 0 END) AS t{j}" for j, v in enumerate(labels))
    kinds_of = " + ".join(f"CASE WHEN t{j} > 0 THEN 1 ELSE 0 END" for j in k)
    for d in range(depth):
        parts.append(
            f"open{d} AS MATERIALIZED (SELECT * FROM (SELECT b.tree, a.path, count(*) AS n, {sums} "
            f"FROM base b JOIN at{d} a USING (rid) WHERE w = 1 AND length(a.path) = {d} GROUP BY b.tree, a.path) "
            f"WHERE n >= {min_samples} AND {kinds_of} > 1)"
        )
        counts = ", ".join(f"sum(CASE WHEN l.y = '{v}' THEN 1 ELSE 0 END) AS c{j}" for j, v in enumerate(labels))
        parts.append(
            f"val{d} AS MATERIALIZED (SELECT l.tree, a.path, l.f, l.num, l.str, {counts} FROM long l "
            f"JOIN at{d} a USING (rid) WHERE l.w = 1 AND length(a.path) = {d} AND (l.num IS NOT NULL OR l.str IS NOT NULL) "
            "GROUP BY l.tree, a.path, l.f, l.num, l.str)"
        )
        below = ", ".join(
            f"CASE WHEN q.cont THEN sum(c{j}) OVER (PARTITION BY v.tree, v.path, v.f ORDER BY v.num "
            f"ROWS UNBOUNDED PRECEDING) ELSE c{j} END AS b{j}" for j in k
        )
        totals = ", ".join(f"o.t{j}" for j in k)
        parts.append(
            f"cand{d} AS MATERIALIZED (SELECT v.tree, v.path, v.f, v.num, v.str, q.cont, o.n, {totals}, {below} "
            f"FROM val{d} v JOIN open{d} o ON o.tree = v.tree AND o.path = v.path "
            "JOIN kinds q ON q.tree = v.tree AND q.f = v.f)"
        )
        n_yes = "(" + " + ".join(f"b{j}" for j in k) + ")"
        yes = _impurity([f"b{j}" for j in k], criterion)
        no = _impurity([f"(t{j} - b{j})" for j in k], criterion)
        parts.append(
            f"best{d} AS MATERIALIZED (SELECT * FROM (SELECT *, {n_yes} AS n_yes, row_number() OVER "
            f"(PARTITION BY tree, path ORDER BY round(({n_yes} * ({yes}) + (n - {n_yes}) * ({no})) / n, 10) ASC, "
            "f DESC, num DESC NULLS LAST, str DESC NULLS LAST) AS rk "
            f"FROM cand{d}) WHERE rk = 1 AND n_yes > 0 AND n_yes < n)"
        )
        parts.append(
            f"at{d + 1} AS MATERIALIZED (SELECT a.rid, CASE WHEN s.f IS NULL THEN a.path WHEN coalesce(CASE "
            "WHEN s.cont THEN l.num <= s.num WHEN s.num IS NOT NULL THEN l.num = s.num ELSE l.str = s.str END, "
            f"false) THEN a.path || 'y' ELSE a.path || 'n' END AS path FROM at{d} a JOIN base b USING (rid) "
            f"LEFT JOIN best{d} s ON s.tree = b.tree AND s.path = a.path "
            "LEFT JOIN long l ON l.rid = a.rid AND l.f = s.f)"
        )
    most = "greatest(" + ", ".join(f"t{j}" for j in k) + ")"
    majority = "CASE " + " ".join(f"WHEN t{j} = {most} THEN '{v}'" for j, v in enumerate(labels)) + " END"
    parts.append(
        f"leaves AS MATERIALIZED (SELECT tree, path, {majority} AS label, n FROM (SELECT b.tree, a.path, "
        f"count(*) AS n, {sums} FROM base b JOIN at{depth} a USING (rid) WHERE w = 1 GROUP BY b.tree, a.path))"
    )
    parts.append(
        f"placed AS MATERIALIZED (SELECT b.rid, b.tree, b.y, b.w, z.label FROM base b JOIN at{depth} a USING (rid) "
        "JOIN leaves z ON z.tree = b.tree AND z.path = a.path)"
    )
    names = "CASE f " + " ".join(f"WHEN {i} THEN '{n}'" for i, (n, _) in enumerate(features)) + " END"
    asked = " UNION ALL ".join(
        f"SELECT tree, path, {names} AS feature, CASE WHEN cont THEN '<=' ELSE '=' END AS op, num AS value_num, "
        f"str AS value_str, cast(NULL as varchar) AS label, n FROM best{d}" for d in range(depth)
    )
    parts.append(
        f"node_rows AS ({asked} UNION ALL SELECT tree, path, NULL, NULL, NULL, NULL, label, n FROM leaves)"
    )
    return "WITH " + ",\n".join(parts)


NODE_COLUMNS = (
    "SELECT cast(tree as int) AS tree_id, path, cast(length(path) as int) AS depth, feature, op, "
    "value_num, value_str, label, cast(n as bigint) AS n FROM node_rows"
)

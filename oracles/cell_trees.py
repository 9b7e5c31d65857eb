"""Trees over counted cells as one SQL statement: binned ones, and exhaustive ones of any depth.

A cell is a combination of feature values and label with its training rows (w) and held-out
rows (v). Features are few-valued numbers, so every value is a bin of its own.
"""

from __future__ import annotations


def _mass(counts: list[str], criterion: str) -> str:
    """Rows times impurity."""
    n = "(" + " + ".join(counts) + ")"
    if criterion == "gini":
        squares = " + ".join(f"cast({c} as double) * {c}" for c in counts)
        return f"CASE WHEN {n} = 0 THEN 0 ELSE {n} - ({squares}) / {n} END"

    def term(x: str) -> str:
        return f"CASE WHEN {x} > 0 THEN {x} * log2({x}) ELSE 0 END"

    return f"({term(n)} - " + " - ".join(f"({term(c)})" for c in counts) + ")"


def cell_tree_ctes(cells: str, n_features: int, labels: list, depth: int, criterion: str, binned: bool, name: str = "") -> str:
    """Common table expressions (without WITH) that end in ``{name}placed``: cid, label.

    ``cells`` gives cid, f0, f1, ..., y, w, v. ``binned``: thresholds lie halfway to the next
    value of all training rows, the first feature and least value win among equals, and a node
    without gain is a leaf. Else: thresholds are values, the last feature and largest value win,
    and only a side without rows makes a leaf; ``depth`` is then more than the tree has.
    """
    p, k = name, range(len(labels))
    longs = " UNION ALL ".join(f"SELECT cid, {i} AS f, f{i} AS x FROM {p}cells" for i in range(n_features))
    counts = ", ".join(f"sum(CASE WHEN y = {v} THEN w ELSE 0 END) AS t{j}" for j, v in enumerate(labels))
    parts = [
        f"{p}cells AS MATERIALIZED ({cells})",
        f"{p}long AS MATERIALIZED ({longs})",
        f"{p}bins AS MATERIALIZED (SELECT f, x, lead(x) OVER (PARTITION BY f ORDER BY x) AS nx FROM "
        f"(SELECT DISTINCT f, x FROM {p}long JOIN {p}cells USING (cid) WHERE w > 0))",
        # id: the node, as a number that its children extend; leaves keep theirs.
        f"{p}at0 AS MATERIALIZED (SELECT cid, 1::HUGEINT AS id, true AS open FROM {p}cells)",
    ]
    total = "(" + " + ".join(f"t{j}" for j in k) + ")"
    kinds = " + ".join(f"(t{j} > 0)::int" for j in k)
    here = ", ".join(f"sum(CASE WHEN c.y = {v} THEN c.w ELSE 0 END) AS c{j}" for j, v in enumerate(labels))
    upto = ", ".join(
        f"sum(c{j}) OVER (PARTITION BY id, f ORDER BY x ROWS UNBOUNDED PRECEDING) AS b{j}" for j in k
    )
    yes, no = [f"b{j}" for j in k], [f"(t{j} - b{j})" for j in k]
    n_yes = "(" + " + ".join(yes) + ")"
    merit = f"round((({_mass(yes, criterion)}) + ({_mass(no, criterion)})) / {total}, {12 if binned else 10})"
    order = f"{merit}, f, x" if binned else f"{merit}, f DESC, x DESC"
    possible = f"{n_yes} < {total}" if binned else "true"
    useful = f"merit < ({_mass([f't{j}' for j in k], criterion)}) / {total} - 1e-12" if binned else f"{n_yes} < {total}"
    threshold = "(b.x + g.nx) / 2" if binned else "b.x"
    for d in range(depth):
        parts += [
            f"{p}open{d} AS MATERIALIZED (SELECT * FROM (SELECT id, {counts} FROM {p}at{d} JOIN {p}cells USING (cid) "
            f"WHERE open AND w > 0 GROUP BY id) WHERE {kinds} > 1)",
            f"{p}best{d} AS MATERIALIZED (SELECT b.id, b.f, {threshold} AS threshold FROM (SELECT *, {merit} AS merit, row_number() OVER "
            f"(PARTITION BY id ORDER BY {order}) AS place FROM (SELECT *, {upto} FROM (SELECT a.id, l.f, l.x, {here} FROM {p}at{d} a "
            f"JOIN {p}cells c USING (cid) JOIN {p}long l USING (cid) WHERE a.open AND c.w > 0 GROUP BY a.id, l.f, l.x) "
            f"JOIN {p}open{d} USING (id)) WHERE {possible}) b JOIN {p}bins g USING (f, x) WHERE place = 1 AND {useful})",
            f"{p}at{d + 1} AS MATERIALIZED (SELECT a.cid, CASE WHEN s.id IS NULL THEN a.id WHEN l.x <= s.threshold THEN 2 * a.id "
            f"ELSE 2 * a.id + 1 END AS id, s.id IS NOT NULL AS open FROM {p}at{d} a LEFT JOIN {p}best{d} s ON s.id = a.id AND a.open "
            f"LEFT JOIN {p}long l ON l.cid = a.cid AND l.f = s.f)",
        ]
    most = "greatest(" + ", ".join(f"t{j}" for j in k) + ")"
    answer = "CASE " + " ".join(f"WHEN t{j} = {most} THEN {v}" for j, v in enumerate(labels)) + " END"
    parts += [
        f"{p}leaves AS MATERIALIZED (SELECT id, {answer} AS label FROM (SELECT id, {counts} FROM {p}at{depth} JOIN {p}cells USING (cid) "
        "WHERE w > 0 GROUP BY id))",
        f"{p}placed AS MATERIALIZED (SELECT a.cid, z.label FROM {p}at{depth} a JOIN {p}leaves z USING (id))",
    ]
    return ",\n".join(parts)

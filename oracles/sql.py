"""SQL for the registered queries, written for a database that reads the same tables."""

from __future__ import annotations

from coppice.plans.schemas import (
    DATE_COLUMNS,
    ENGINEERED_ALIASES,
    ENGINEERED_COLUMNS,
    ENGINEERED_DOUBLES,
    RAW_COLUMNS,
    TIME_COLUMNS,
    VECTOR_COLUMNS,
    WEEKDAYS,
    raw_schema,
)
from coppice.plans.wide import wide_expressions
from oracles.cell_trees import cell_tree_ctes
from oracles.tree_sql import NODE_COLUMNS, tree_ctes

ORACLES: dict[str, str] = {}

KEY = "CID X LOC_NUM X VENDOR"
TYPES = {f.name: f.dataType.simpleString() for f in raw_schema().fields}

WIDE = (
    "SELECT " + ", ".join(f'{e} AS "{n}"' for n, e in wide_expressions().items())
    + " FROM orders JOIN customer ON o_custkey = c_custkey"
)
# Lists with dashes, as every later step expects them.
CLEAN = (
    "SELECT * REPLACE (replace(vendor_tag, ',', '-') AS vendor_tag, "
    f"replace(vendor_tag_name, ',', '-') AS vendor_tag_name) FROM ({WIDE})"
)

GAPPY_ORDERS = """SELECT o_orderkey,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_custkey END AS o_custkey,
  CASE WHEN o_orderkey % 5 = 1 THEN NULL ELSE o_orderpriority END AS o_orderpriority,
  CASE WHEN o_orderkey % 3 = 2 THEN NULL ELSE o_orderstatus END AS o_orderstatus,
  CASE WHEN o_orderkey % 11 IN (0, 1) THEN NULL ELSE o_totalprice END AS o_totalprice
FROM orders"""
GAPPY_PART = """SELECT p_partkey, CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_size END AS p_size,
  CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_retailprice END AS p_retailprice FROM part"""


def hash_bits(key: str, seed: int | str) -> str:
    return f"(('0x' || substr(md5('{seed}:' || cast({key} as varchar)), 1, 13))::bigint)"


def hash_unit(key: str, seed: int | str) -> str:
    return f"({hash_bits(key, seed)}::double / 4503599627370496)"


def seconds(c: str) -> str:
    return (
        f"(split_part({c}, ':', 1)::bigint * 3600 + split_part({c}, ':', 2)::bigint * 60 "
        f"+ split_part({c}, ':', 3)::bigint)"
    )


def span(day: str, i: int, wrap: bool = False) -> str:
    gap = f"({seconds(f'{day}_to_time{i}')} - {seconds(f'{day}_from_time{i}')})"
    return f"(CASE WHEN {gap} < 0 THEN {gap} + 86400 ELSE {gap} END)" if wrap else gap


def hours(day: str, digits: int, binary: bool = False, wrap: bool = False) -> str:
    total = f"({span(day, 1, wrap)} + {span(day, 2, wrap)})"
    if binary:
        # printf rounds the stored binary value, ties to even.
        return f"printf('%.{digits}f', {total} / 3600.0::double)::double"
    # Half up on whole hundredths of an hour, away from zero: 36 seconds each.
    return f"(sign({total}) * floor((abs({total}) + 18) / 36.0::double) / 100)"


def rows(name: str, sql: str) -> None:
    ORACLES[name] = sql


# Sources and sinks ----------------------------------------------------------------

rows("csv_roundtrip", """SELECT o_orderkey, o_totalprice,
  o_orderstatus || ', "' || o_orderpriority || '"' AS remark FROM orders""")
rows("csv_positional", "SELECT c_custkey AS key, c_name AS name, c_mktsegment AS segment FROM customer")
rows("plain_lines", "SELECT s_suppkey, s_name, s_nationkey FROM supplier")
rows("tag_union", """SELECT c_custkey AS key, c_name AS name, c_acctbal AS balance, 'train' AS split FROM customer
UNION ALL SELECT s_suppkey, s_name, s_acctbal, 'test' FROM supplier""")

# Projections ------------------------------------------------------------------------

rows("project_rename_drop",
     "SELECT o_orderkey, o_custkey, o_totalprice AS price, o_totalprice * 2 AS double_price FROM orders")
rows("cast_columns", """SELECT event_id, user_id::double AS user_id,
  try_cast(event_type AS double) AS event_type, value FROM events""")
rows("split_by_predicate", """SELECT count(*) FILTER (l_quantity <= 25) AS below,
  count(*) FILTER (l_quantity > 25) AS above, count(*) FILTER (l_linestatus = 'F') AS equal,
  count(*) FILTER (l_linestatus <> 'F') AS other FROM lineitem""")

# Profiles -----------------------------------------------------------------------------

_GAPPY_COLUMNS = ["o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus", "o_totalprice"]
rows("null_counts", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS missing FROM ({GAPPY_ORDERS})"
    for c in _GAPPY_COLUMNS))
rows("null_total", "SELECT count(*) AS n_rows, " + " + ".join(
    f"(count(*) - count({c}))" for c in _GAPPY_COLUMNS) + f" AS missing FROM ({GAPPY_ORDERS})")
rows("row_width_hist", """SELECT len(string_split(text, ','))::bigint AS width, count(*) AS n_rows
FROM documents GROUP BY 1""")
rows("sum_per_key", "SELECT l_suppkey, sum(l_quantity) AS total FROM lineitem GROUP BY l_suppkey")
rows("label_counts", "SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY l_returnflag")
rows("feature_types", " UNION ALL ".join(
    [f"SELECT '{c}' AS feature, CASE WHEN count(DISTINCT {c}) > 15 THEN 'continuous' ELSE 'categorical' END AS kind "
     "FROM lineitem" for c in ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber", "l_suppkey"]]
    + ["SELECT 'l_linestatus', 'categorical'"]))
rows("candidate_splits", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {c} AS num, NULL::varchar AS str, count(*) AS n FROM lineitem GROUP BY {c}"
    for c in ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    + " UNION ALL SELECT 'l_linestatus', NULL, l_linestatus, count(*) FROM lineitem GROUP BY l_linestatus")
rows("sorted_values", "SELECT DISTINCT p_name FROM part ORDER BY p_name")
rows("preview", "SELECT * FROM customer ORDER BY c_custkey LIMIT 10")
rows("cell_lookup", """SELECT c_mktsegment FROM (SELECT c_mktsegment,
  row_number() OVER (ORDER BY c_custkey) AS rn FROM customer) WHERE rn = 89""")
rows("node_stats", """WITH c AS (SELECT l_linestatus, l_returnflag, count(*) AS n FROM lineitem GROUP BY 1, 2),
t AS (SELECT *, sum(n) OVER (PARTITION BY l_linestatus) AS total FROM c)
SELECT l_linestatus, max(total)::bigint AS n, count(*) = 1 AS pure,
  arg_min(l_returnflag, (-n, l_returnflag)) AS majority,
  round(-sum(n / total * log2(n / total)), 6) AS impurity FROM t GROUP BY l_linestatus""")

# Missing values -------------------------------------------------------------------------

rows("fill_constant", f'SELECT "{KEY}" AS row_key, ' + ", ".join(
    f"coalesce({c}, '00:00:00') AS {c}" for c in TIME_COLUMNS) + f" FROM ({WIDE})")


def frequent(c: str, source: str) -> str:
    return (
        f'(SELECT "{c}" FROM {source} WHERE "{c}" IS NOT NULL GROUP BY "{c}" '
        f"HAVING count(*) >= 0.6 * (SELECT count(*) FROM {source}))"
    )


_HEAVY = ["gender", "language", "location_type", "vendor_category_en", "vendor_tag"]
rows("heavy_hitter_fill", f'WITH wide AS MATERIALIZED ({WIDE}) SELECT "{KEY}" AS row_key, ' + ", ".join(
    f"coalesce({c}, {frequent(c, 'wide')}) AS {c}" for c in _HEAVY) + " FROM wide")
rows("median_impute_approx", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS filled, true AS close FROM ({GAPPY_PART})"
    for c in ["p_size", "p_retailprice"]))
rows("median_impute_lower", f"""WITH g AS ({GAPPY_PART}) SELECT p_partkey,
  coalesce(p_size, (SELECT quantile_disc(p_size, 0.5) FROM g)) AS p_size,
  coalesce(p_retailprice, (SELECT quantile_disc(p_retailprice, 0.5) FROM g)) AS p_retailprice FROM g""")
rows("median_impute_exact", f"""WITH g AS ({GAPPY_PART}) SELECT p_partkey,
  coalesce(p_size::double, (SELECT median(p_size) FROM g)) AS p_size,
  coalesce(p_retailprice, (SELECT median(p_retailprice) FROM g)) AS p_retailprice FROM g""")
rows("median_impute_narrowed", """SELECT count(*) AS n_rows, median(l_quantity) AS l_quantity,
  median(l_extendedprice) AS l_extendedprice, median(l_discount) AS l_discount FROM lineitem""")


def smallest_mode(c: str) -> str:
    return f"(SELECT {c} FROM g WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"


rows("mode_impute", f"WITH g AS ({GAPPY_ORDERS}) SELECT o_orderkey, " + ", ".join(
    f"coalesce({c}, {smallest_mode(c)}) AS {c}" for c in ["o_custkey", "o_orderpriority", "o_orderstatus"])
    + " FROM g")


rows("typed_fill_mode", f"""WITH g AS ({GAPPY_ORDERS}) SELECT o_orderkey,
  coalesce(o_custkey::double, (SELECT median(o_custkey)::double FROM g)) AS o_custkey,
  coalesce(o_orderpriority, {smallest_mode('o_orderpriority')}) AS o_orderpriority,
  coalesce(o_orderstatus, {smallest_mode('o_orderstatus')}) AS o_orderstatus,
  coalesce(CASE WHEN NOT isnan(o_totalprice) THEN o_totalprice END,
    (SELECT median(o_totalprice) FROM g WHERE NOT isnan(o_totalprice))) AS o_totalprice FROM g""")


def filled(source: str, learned_on: str) -> list[str]:
    """Select list that fills every raw column by type, values learned on another relation."""
    items = []
    for c in RAW_COLUMNS:
        if c == "target":
            value = c
        elif c in TIME_COLUMNS:
            value = f"coalesce({c}, '00:00:00')"
        elif TYPES[c] == "string":
            value = f'coalesce("{c}", {frequent(c, learned_on)})'
        else:
            value = f'coalesce("{c}", (SELECT quantile_disc("{c}", 0.5) FROM {learned_on}))'
        items.append(f'{value} AS "{c}"')
    return items


rows("wide_fill", f"WITH clean AS MATERIALIZED ({CLEAN}) SELECT * RENAME (\"{KEY}\" AS row_key) FROM (SELECT "
     + ", ".join(filled("clean", "clean")) + " FROM clean)")

# Scalar functions -------------------------------------------------------------------------

rows("list_delim_replace", f"""SELECT "{KEY}" AS row_key, vendor_tag, vendor_tag_name,
  len(string_split(vendor_tag, '-'))::bigint AS vendor_tag_sum,
  len(string_split(vendor_tag_name, '-'))::bigint AS vendor_tag_name_sum FROM ({CLEAN})""")
rows("json_tag_extract", f"""SELECT "{KEY}" AS row_key,
  nullif(regexp_extract(primary_tags, '[0-9]+'), '') AS tag,
  nullif(regexp_extract(primary_tags, '[0-9]+'), '') AS tag_of_doubled,
  replace(primary_tags, '"', '') AS stripped FROM ({WIDE})""")
rows("json_props_extract", """SELECT event_id, regexp_extract(props, '[0-9]+')::int AS k,
  replace(props, '"', '') AS stripped FROM events""")
rows("line_cleanup", """SELECT o_orderkey,
  replace(o_orderkey::varchar || ',' || o_orderpriority || ',''x''', ' ', '') AS bare,
  '  [[' || o_orderkey::varchar || ', ' || o_orderpriority || ', x ]] ' AS unquoted FROM orders""")
rows("date_part_text", """SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%H:%M:%S') AS clock,
  (date_part('hour', ts) * 3600 + date_part('minute', ts) * 60 + floor(date_part('second', ts)))::bigint AS seconds,
  date_diff('day', DATE '1970-01-01', ts::date)::double AS days, value::varchar AS value_text FROM events""")
rows("opening_hours", f'SELECT "{KEY}" AS row_key, ' + ", ".join(
    f"{hours(d, 2)} AS {d}_2, {hours(d, 1, True)} AS {d}_1, {hours(d, 2, False, True)} AS {d}_wrapped"
    for d in WEEKDAYS) + f" FROM ({WIDE})")
rows("rounding_modes", """SELECT l_orderkey, printf('%.1f', l_orderkey / 20.0::double)::double AS even,
  floor((l_orderkey + 1) / 2.0::double) / 10 AS half_up,
  round(log2(l_quantity), 6) AS log2 FROM lineitem""")

# Samples and order -----------------------------------------------------------------------


def tag(key: str, seed: int) -> str:
    return f"CASE WHEN {hash_bits(key, seed)} % 11 <= 1 THEN 'Test' ELSE 'Train' END"


rows("hash_split_counts", f"SELECT {tag('o_orderkey', 7)} AS split, count(*) AS n_rows FROM orders GROUP BY 1")
rows("hash_split_train", f"SELECT o_orderkey FROM orders WHERE {tag('o_orderkey', 7)} = 'Train'")
rows("keyed_split", f"SELECT o_orderkey, o_orderstatus FROM orders WHERE {hash_unit('o_orderkey', 42)} < 0.7")
rows("split_features_label", f"""WITH t AS (SELECT * FROM orders WHERE {hash_unit('o_orderkey', 42)} < 0.7)
SELECT o_orderstatus, count(*) AS n_label, (SELECT count(*) FROM t) AS n_features,
  (SELECT sum(o_custkey)::bigint FROM t) AS custkeys FROM t GROUP BY 1""")
_RANKED = f"""SELECT *, row_number() OVER (ORDER BY {hash_bits('c_custkey', 5)}, c_custkey) AS rn,
  (SELECT round_even(0.25 * count(*), 0) FROM customer) AS size FROM customer"""
rows("exact_sample", f"SELECT * EXCLUDE (rn, size) FROM ({_RANKED}) WHERE rn <= size")
rows("exact_sample_rest", f"SELECT * EXCLUDE (rn, size) FROM ({_RANKED}) WHERE rn > size")
rows("shuffle_positions", f"""SELECT o_orderkey,
  row_number() OVER (ORDER BY {hash_bits('o_orderkey', 9)}, o_orderkey) AS position FROM orders""")
rows("shuffle_rows", "SELECT o_orderkey, o_custkey FROM orders")
rows("synth_labels", f"""SELECT o_orderkey,
  CASE WHEN {hash_unit('o_orderkey', 3)} < 0.1 THEN 1.0::double ELSE 0.0::double END AS target FROM orders""")
rows("positional_zip", """SELECT o_orderkey, event_id FROM
  (SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders)
  JOIN (SELECT event_id, row_number() OVER (ORDER BY value, event_id) AS rn FROM events) USING (rn)""")
rows("file_order_zip", f"""SELECT CASE WHEN {hash_unit('id', 4)} < 0.1 THEN 1.0::double ELSE 0.0::double END AS target,
  count(*) AS n_rows FROM (SELECT row_number() OVER () - 1 AS id FROM orders) GROUP BY 1""")
rows("collect_per_key", """SELECT o_custkey, 0::bigint AS chunk,
  string_agg(o_orderkey::varchar, ',' ORDER BY o_orderkey) AS order_keys FROM orders GROUP BY o_custkey""")
rows("collect_per_hot_key", """SELECT l_returnflag, chunk, count(*) AS n_values, min(l_extendedprice) AS least,
  max(l_extendedprice) AS largest FROM (SELECT l_returnflag, l_extendedprice,
  (row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice) - 1) // 500 AS chunk FROM lineitem) GROUP BY ALL""")

# Encoding ------------------------------------------------------------------------------------


def frequency_code(c: str, source: str) -> str:
    return (
        f"(SELECT value, (row_number() OVER (ORDER BY n DESC, value) - 1)::double AS code FROM "
        f'(SELECT "{c}" AS value, count(*) AS n FROM {source} WHERE "{c}" IS NOT NULL GROUP BY 1))'
    )


def alphabet_code(c: str, source: str) -> str:
    return (
        f"(SELECT value, (row_number() OVER (ORDER BY value) - 1)::double AS code FROM "
        f'(SELECT DISTINCT "{c}" AS value FROM {source} WHERE "{c}" IS NOT NULL))'
    )


def coded(names: list[str], others: str, source: str, coder, learned_on: str | None = None) -> str:
    learned = learned_on or source
    joins = " ".join(
        f'LEFT JOIN {coder(c, learned)} AS d{i} ON d{i}.value = s."{c}"' for i, c in enumerate(names)
    )
    values = ", ".join(
        f'coalesce(d{i}.code, (SELECT count(DISTINCT "{c}") FROM {learned})::double) AS "{c}"'
        for i, c in enumerate(names)
    )
    return f"SELECT {others}, {values} FROM {source} s {joins}"


_PART_TEXT = ["p_brand", "p_type", "p_name"]
rows("index_by_frequency", coded(_PART_TEXT, "p_partkey", "part", frequency_code))
rows("index_alphabetic", coded(_PART_TEXT, "p_partkey", "part", alphabet_code))
rows("index_many_values", "SELECT c_custkey, c_mktsegment, c_name_code AS c_name_index, c_segment_code AS c_mktsegment_index "
     f"FROM customer JOIN (SELECT value, code AS c_name_code FROM {frequency_code('c_name', 'customer')}) a ON a.value = c_name "
     f"JOIN (SELECT value, code AS c_segment_code FROM {frequency_code('c_mktsegment', 'customer')}) b ON b.value = c_mktsegment")
rows("index_unseen", "WITH learned AS (SELECT * FROM part WHERE p_brand < 'Brand#2') "
     + coded(["p_brand", "p_name"], "p_partkey", "part", frequency_code, "learned"))
rows("assemble_features", """SELECT l_orderkey, l_quantity, l_extendedprice, l_discount, l_tax,
  date_diff('day', DATE '1970-01-01', l_shipdate::date)::double AS l_shipdate FROM lineitem""")


def engineered(source: str, extra: str) -> str:
    """The engineered columns as SQL; ``extra`` comes first in the select list."""
    special = {d: hours(d, 1, True) for d in WEEKDAYS}
    special |= {c: f"split_part({c}, ' ', 1)" for c in DATE_COLUMNS}
    special["create_at_x"] = "split_part(created_at_x, ' ', 1)"
    special["primary_tags"] = "replace(primary_tags, '\"', '')"
    special["vendor_tag_sum"] = "len(string_split(vendor_tag, '-'))"
    items = []
    for c in ENGINEERED_COLUMNS:
        value = special.get(c, f'"{ENGINEERED_ALIASES.get(c, c)}"')
        kind = "double" if c in ENGINEERED_DOUBLES else "varchar"
        items.append(f'cast({value} AS {kind}) AS "{c}"')
    return f"SELECT {extra}, " + ", ".join(items) + f" FROM {source}"


rows("wide_features", engineered(f"({CLEAN})", f'"{KEY}" AS row_key'))


def vector_values() -> tuple[list[str], list[str]]:
    """Numeric select items and names of text columns of the vector table."""
    special = {f"{d}_opening_time": hours(d, 2) for d in WEEKDAYS}
    special |= {
        c: f"date_diff('day', DATE '1970-01-01', split_part({c}, ' ', 1)::date)" for c in DATE_COLUMNS
    }
    special |= {c: f"len(string_split({c}, '-'))" for c in ["vendor_tag", "vendor_tag_name"]}
    special["primary_tags"] = "nullif(regexp_extract(primary_tags, '[0-9]+'), '')"
    texts = [c for c in VECTOR_COLUMNS if c == "primary_tags" or (c not in special and TYPES[c] == "string")]
    items = [
        f'cast({special.get(c, c)} AS {"varchar" if c in texts else "double"}) AS "{c}"' for c in VECTOR_COLUMNS
    ]
    return items, texts


_ITEMS, _TEXTS = vector_values()
_NUMBERS = ", ".join(["row_key", *[c for c in VECTOR_COLUMNS if c not in _TEXTS]])
rows("wide_numeric", f'WITH shaped AS MATERIALIZED (SELECT "{KEY}" AS row_key, ' + ", ".join(_ITEMS)
     + f" FROM ({CLEAN})) " + coded(_TEXTS, _NUMBERS, "shaped", frequency_code))

# Trees -----------------------------------------------------------------------------------------

_LINE_FEATURES = [("l_quantity", True), ("l_extendedprice", True), ("l_discount", True), ("l_tax", True),
                  ("l_linestatus", False)]
_LINE_VALUES = ", ".join(f"{c} AS f{i}" for i, (c, _) in enumerate(_LINE_FEATURES))
_LINE = f"SELECT row_number() OVER () AS rid, 0 AS tree, l_returnflag AS y, 1 AS w, {_LINE_VALUES} FROM lineitem"
_SHARDED = f"SELECT row_number() OVER () AS rid, l_suppkey % 3 AS tree, l_returnflag AS y, 1 AS w, {_LINE_VALUES} FROM lineitem"
_LABELS = ["A", "N", "R"]

rows("best_root_split", tree_ctes(_LINE, _LINE_FEATURES, _LABELS, 1)
     + " SELECT feature, op, value_num, value_str, n FROM node_rows WHERE path = ''")
rows("tree_nodes", tree_ctes(_LINE, _LINE_FEATURES, _LABELS, 5) + NODE_COLUMNS)
rows("tree_nodes_bucketed", tree_ctes(_LINE, _LINE_FEATURES, _LABELS, 5) + NODE_COLUMNS)
rows("tree_nodes_gini", tree_ctes(_LINE, _LINE_FEATURES, _LABELS, 5, "gini") + NODE_COLUMNS)
rows("shard_trees", tree_ctes(_SHARDED, _LINE_FEATURES, _LABELS, 5) + NODE_COLUMNS)
rows("tree_score", tree_ctes(_LINE, _LINE_FEATURES, _LABELS, 5)
     + " SELECT y AS l_returnflag, label AS prediction, count(*) AS n_rows FROM placed GROUP BY 1, 2")
rows("prediction_sink", tree_ctes(
    _LINE.replace("SELECT", "SELECT l_orderkey,", 1), _LINE_FEATURES, _LABELS, 5)
    + " SELECT p.label AS target, count(*) AS n_rows, sum(b.l_orderkey)::bigint AS keys "
    "FROM placed p JOIN base b USING (rid) GROUP BY 1")


def answers(depth: int) -> str:
    """Every row walked through the tree of every shard."""
    steps = ["walk0 AS (SELECT b.rid, b.y, t.tree, '' AS path FROM base b CROSS JOIN (SELECT DISTINCT tree FROM base) t)"]
    for d in range(depth):
        steps.append(
            f"walk{d + 1} AS (SELECT a.rid, a.y, a.tree, CASE WHEN s.f IS NULL THEN a.path WHEN coalesce(CASE WHEN s.cont "
            "THEN l.num <= s.num WHEN s.num IS NOT NULL THEN l.num = s.num ELSE l.str = s.str END, false) "
            f"THEN a.path || 'y' ELSE a.path || 'n' END AS path FROM walk{d} a LEFT JOIN best{d} s "
            "ON s.tree = a.tree AND s.path = a.path LEFT JOIN long l ON l.rid = a.rid AND l.f = s.f)"
        )
    steps.append(
        f"scored AS (SELECT a.y, a.tree, z.label FROM walk{depth} a JOIN leaves z ON z.tree = a.tree AND z.path = a.path)"
    )
    return ", " + ", ".join(steps)


rows("tree_score_each", tree_ctes(_SHARDED, _LINE_FEATURES, _LABELS, 5) + answers(5)
     + " SELECT tree::int AS tree_id, y AS l_returnflag, label AS prediction, count(*) AS n_rows FROM scored GROUP BY 1, 2, 3")
rows("tree_accuracy", tree_ctes(_SHARDED, _LINE_FEATURES, _LABELS, 5) + answers(5)
     + " SELECT tree::int AS tree_id, round(avg(CASE WHEN y = label THEN 1.0::double ELSE 0.0::double END), 8) AS accuracy "
     "FROM scored GROUP BY 1")

# The whole job -------------------------------------------------------------------------------------

_FEATURES = [(c, c in ENGINEERED_DOUBLES) for c in ENGINEERED_COLUMNS if c != "target"]


def trained_flow(train_condition: str, depth: int) -> str:
    """Fill, engineer and train; train_condition picks the rows that are learned from."""
    shaped = engineered("filled", "w, rid")
    base = ("SELECT rid, 0 AS tree, target AS y, w, "
            + ", ".join(f'"{c}" AS f{i}' for i, (c, _) in enumerate(_FEATURES)) + f" FROM ({shaped})")
    prefix = (
        f"WITH clean AS MATERIALIZED (SELECT *, row_number() OVER () AS rid, CASE WHEN {train_condition} "
        f"THEN 1 ELSE 0 END AS w FROM ({CLEAN})), train AS MATERIALIZED (SELECT * FROM clean WHERE w = 1), "
        "filled AS MATERIALIZED (SELECT rid, w, " + ", ".join(filled("clean", "train")) + " FROM clean), "
    )
    return prefix + tree_ctes(base, _FEATURES, ["0", "1"], depth).removeprefix("WITH ")


_SPLIT = tag(f'"{KEY}"', 1) + " = 'Train'"
rows("flagship", trained_flow(_SPLIT, 5) + """ SELECT CASE WHEN w = 1 THEN 'Train' ELSE 'Test' END AS split,
  count(*) AS n_rows, round(avg(CASE WHEN y = label THEN 1.0::double ELSE 0.0::double END), 8) AS accuracy
FROM placed GROUP BY 1""")
rows("stream_scoring", trained_flow("true", 5)
     + " SELECT y AS target, label AS prediction, count(*) AS n_rows FROM placed GROUP BY 1, 2")

# Random draws ---------------------------------------------------------------------------------

for _name in ("random_split", "random_tags", "synth_labels_random"):
    rows(_name, "SELECT count(*) AS n_rows, true AS near FROM orders")

# Binned and unlimited trees: what the holdout, by key, gets ---------------------------------------

_BINNED = ["l_quantity", "l_discount", "l_tax", "l_linestatus"]
_COARSE = ["l_linenumber", "quantity_pair", "l_discount", "l_tax", "l_linestatus"]
_TRAINED = f"({hash_unit('l_orderkey || chr(45) || l_linenumber', 42)} < 0.7)"
#: More levels than an unlimited tree on these few-valued features has.
_LEVELS = 48


def line_cells(features: list[str]) -> str:
    values = ", ".join(f"{'s.code' if c == 'l_linestatus' else f'ceil(l_quantity / 2)' if c == 'quantity_pair' else c}::double AS f{i}"
                       for i, c in enumerate(features))
    names = ", ".join(f"f{i}" for i in range(len(features)))
    return (
        f"SELECT row_number() OVER () AS cid, * FROM (SELECT {names}, y, count(*) FILTER (trained) AS w, count(*) FILTER (NOT trained) AS v "
        f"FROM (SELECT {values}, r.code::int AS y, {_TRAINED} AS trained FROM lineitem "
        f"JOIN {frequency_code('l_linestatus', 'lineitem')} s ON s.value = l_linestatus "
        f"JOIN {frequency_code('l_returnflag', 'lineitem')} r ON r.value = l_returnflag) GROUP BY ALL)"
    )


def held_out_labels(features: list[str], depth: int, criterion: str, binned: bool) -> str:
    ctes = cell_tree_ctes(line_cells(features), len(features), [0, 1, 2], depth, criterion, binned)
    return (
        f"WITH {ctes} SELECT y::double AS l_returnflag, label::double AS prediction, sum(v)::bigint AS n_rows "
        "FROM placed JOIN cells USING (cid) WHERE v > 0 GROUP BY 1, 2"
    )


rows("vector_tree", held_out_labels(_BINNED, 4, "entropy", True))
rows("vector_tree_default", held_out_labels(_COARSE, 5, "entropy", True))
rows("vector_tree_gini", held_out_labels(_BINNED, _LEVELS, "gini", False))
_SHARE = "round(sum(CASE WHEN y = label THEN v ELSE 0 END)::double / sum(v)::double, 8) AS accuracy"
rows("impurity_compare", "WITH " + cell_tree_ctes(line_cells(_BINNED), 4, [0, 1, 2], _LEVELS, "gini", False, "g")
     + ",\n" + cell_tree_ctes(line_cells(_BINNED), 4, [0, 1, 2], 3, "entropy", True, "e")
     + f" SELECT 'gini' AS criterion, NULL::int AS max_depth, {_SHARE} FROM gplaced JOIN gcells USING (cid)"
     + f" UNION ALL SELECT 'entropy', 3, {_SHARE} FROM eplaced JOIN ecells USING (cid)")

# The stored tree, merged and rendered -----------------------------------------------------------


def merged_tree(depth: int) -> str:
    """CTEs after ``node_rows``: texts from the deepest level up, then the nodes that stay."""
    quoted = "('''' || a.label || '''')"
    nested = "'{''' || a.question || ''': [' || y.text || ', ' || o.text || ']}'"
    steps = [
        "asked AS MATERIALIZED (SELECT path, label, n, feature || ' ' || op || ' ' || coalesce(value_num::varchar, value_str) AS question FROM node_rows)",
        f"up{depth} AS MATERIALIZED (SELECT a.path, {quoted} AS text, a.path AS source FROM asked a WHERE length(a.path) = {depth})",
    ]
    for d in range(depth - 1, -1, -1):
        steps.append(
            f"up{d} AS MATERIALIZED (SELECT a.path, CASE WHEN a.question IS NULL THEN {quoted} WHEN y.text = o.text THEN y.text ELSE {nested} END AS text, "
            "CASE WHEN a.question IS NOT NULL AND y.text = o.text THEN y.source ELSE a.path END AS source "
            f"FROM asked a LEFT JOIN up{d + 1} y ON y.path = a.path || 'y' LEFT JOIN up{d + 1} o ON o.path = a.path || 'n' WHERE length(a.path) = {d})"
        )
    every = " UNION ALL ".join(f"SELECT * FROM up{d}" for d in range(depth + 1))
    steps += [f"merged AS MATERIALIZED ({every})", "kept0 AS MATERIALIZED (SELECT '' AS path, '' AS at)"]
    for d in range(depth):
        steps.append(
            f"kept{d + 1} AS MATERIALIZED (SELECT k.path || s.side AS path, m.source || s.side AS at FROM kept{d} k JOIN merged m ON m.path = k.at "
            "JOIN asked a ON a.path = m.source AND a.question IS NOT NULL CROSS JOIN (VALUES ('y'), ('n')) s(side))"
        )
    kept = " UNION ALL ".join(f"SELECT * FROM kept{d}" for d in range(depth + 1))
    return (
        ", " + ", ".join(steps) + f" SELECT k.path, length(k.path)::int AS depth, c.question, c.label, t.n, m.text FROM ({kept}) k "
        "JOIN merged m ON m.path = k.at JOIN asked c ON c.path = m.source JOIN asked t ON t.path = k.at"
    )


rows("tree_stored", tree_ctes(_LINE, _LINE_FEATURES, _LABELS, 5) + merged_tree(5))

"""A raw food-delivery table with all 73 columns, derived from orders and customers.

Gives tests, benchmarks and registered queries a wide input whose size follows the
given tables: one row per order. The expressions use SQL both Spark and other engines
read, so a check in another engine can start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coppice.plans.schemas import RAW_COLUMNS, WEEKDAYS
from coppice.session import deal_rows, split_large_methods

_VENDORS = 97
_VENDOR = f"(o_orderkey % {_VENDORS})"


def _clock(hour: str, minute: str) -> str:
    return f"lpad(cast({hour} as string), 2, '0') || ':' || lpad(cast({minute} as string), 2, '0') || ':00'"


def _weekday_times() -> dict[str, str]:
    """Two opening intervals per day; some close after midnight, some are missing."""
    times = {}
    for d, day in enumerate(WEEKDAYS):
        edges = {
            "from_time1": _clock(f"(8 + ({_VENDOR} + {d}) % 3)", f"({_VENDOR} * 7 + {d}) % 60"),
            "to_time1": _clock(f"(12 + ({_VENDOR} + {d}) % 4)", f"({_VENDOR} * 11 + {d}) % 60"),
            "from_time2": _clock(f"(16 + {_VENDOR} % 2)", f"({_VENDOR} * 13 + {d}) % 60"),
            "to_time2": _clock(f"((20 + ({_VENDOR} + {d}) % 6) % 24)", f"({_VENDOR} * 17 + {d}) % 60"),
        }
        for e, (edge, text) in enumerate(edges.items()):
            # A vendor without a second interval has neither of its ends.
            gap = f"({_VENDOR} + {d}) % 9 = 4" if e >= 2 else f"({_VENDOR} * 3 + {d}) % 31 = {e}"
            times[f"{day}_{edge}"] = f"CASE WHEN {gap} THEN NULL ELSE {text} END"
    return times


def _maybe(condition: str, value: str) -> str:
    return f"CASE WHEN {condition} THEN NULL ELSE {value} END"


def wide_expressions() -> dict[str, str]:
    """SQL text per raw column, over orders joined with customer."""
    day = "cast(cast(o_orderdate as date) as string)"
    april = "'2020-04-' || lpad(cast({} % 28 + 1 as string), 2, '0')"
    columns = {
        "customer_id": "'C' || lpad(cast(o_custkey as string), 9, '0')",
        "gender": "CASE WHEN o_custkey % 11 = 0 THEN NULL WHEN o_custkey % 4 = 0 THEN 'Female' ELSE 'Male' END",
        "status_x": _maybe("o_orderkey % 13 = 0", "cast(o_custkey % 2 as int)"),
        "verified_x": "cast(CASE WHEN o_custkey % 5 = 0 THEN 0 ELSE 1 END as int)",
        "created_at_x": f"{day} || ' 10:11:12'",
        "updated_at_x": april.format("o_custkey") + " || ' 01:02:03'",
        "location_number": "cast(o_orderkey % 5 as int)",
        "location_type": "CASE WHEN o_orderkey % 10 < 3 THEN NULL WHEN o_orderkey % 10 < 6 THEN 'Home' "
        "WHEN o_orderkey % 10 < 8 THEN 'Work' ELSE 'Other' END",
        "latitude_x": _maybe("o_custkey % 9 = 0", "c_acctbal / cast(8192 as double)"),
        "longitude_x": "o_totalprice / cast(131072 as double)",
        "id": f"cast({_VENDOR} as int)",
        "authentication_id": f"cast({_VENDOR} * 31 as string)",
        "latitude_y": f"cast({_VENDOR} % 40 as double) / cast(8 as double)",
        "longitude_y": f"cast({_VENDOR} % 53 as double) / cast(4 as double)",
        "vendor_category_en": f"CASE WHEN {_VENDOR} % 3 = 0 THEN 'Sweets & Bakes' ELSE 'Restaurants' END",
        "vendor_category_id": f"cast({_VENDOR} % 2 + 2 as double)",
        "delivery_charge": f"CASE WHEN {_VENDOR} % 2 = 0 THEN cast(0 as double) ELSE cast(0.7 as double) END",
        "serving_distance": _maybe("o_orderkey % 17 = 0", f"cast({_VENDOR} % 15 + 1 as double)"),
        "is_open": f"cast(CASE WHEN {_VENDOR} % 10 = 0 THEN 0 ELSE 1 END as int)",
        "OpeningTime": "'11:00AM-11:30PM'",
        "OpeningTime2": _maybe(f"{_VENDOR} % 4 > 0", "'-'"),
        "prepration_time": _maybe("o_orderkey % 19 = 0", f"cast({_VENDOR} % 20 + 10 as int)"),
        "commission": _maybe("o_orderkey % 3 = 0", "cast(18 as double)"),
        "is_akeed_delivering": "'Yes'",
        "discount_percentage": "cast(0 as double)",
        "status_y": f"cast(CASE WHEN {_VENDOR} % 12 = 0 THEN 0 ELSE 1 END as int)",
        "verified_y": "cast(1 as int)",
        "rank": f"cast(CASE WHEN {_VENDOR} % 8 = 0 THEN 1 ELSE 11 END as int)",
        "language": _maybe("o_orderkey % 6 = 0", "'EN'"),
        "vendor_rating": _maybe("o_orderkey % 23 = 0", f"cast({_VENDOR} % 16 + 35 as double) / cast(10 as double)"),
        **_weekday_times(),
        "primary_tags": _maybe(
            f"{_VENDOR} % 14 = 0", f"'{{\"primary_tags\":\"' || cast({_VENDOR} % 50 as string) || '\"}}'"
        ),
        "open_close_flags": "cast(1 as int)",
        "vendor_tag": f"CASE WHEN {_VENDOR} % 16 = 0 THEN NULL WHEN {_VENDOR} % 16 = 1 THEN '5' "
        f"ELSE '4' || repeat(',8', cast({_VENDOR} % 10 as int)) END",
        "vendor_tag_name": f"CASE WHEN {_VENDOR} % 16 = 0 THEN NULL "
        f"ELSE 'Arabic' || repeat(',\"Free Delivery\"', cast({_VENDOR} % 10 as int)) END",
        "one_click_vendor": "'Y'",
        "country_id": "cast(1 as int)",
        "city_id": "cast(1 as int)",
        "created_at_y": f"'2019-' || lpad(cast({_VENDOR} % 12 + 1 as string), 2, '0') || '-15 08:00:00'",
        "updated_at_y": april.format(_VENDOR) + " || ' 20:00:01'",
        "device_type": "cast(3 as int)",
        "display_orders": "cast(1 as int)",
        "location_number_obj": "cast(o_orderkey % 5 as int)",
        "id_obj": f"cast({_VENDOR} as int)",
        "CID X LOC_NUM X VENDOR": f"cast(o_custkey as string) || ' X ' || cast(o_orderkey as string) "
        f"|| ' X ' || cast({_VENDOR} as string)",
        "target": f"cast(CASE WHEN ({_VENDOR} % 53 < 20 AND c_acctbal > 3000) "
        f"OR (o_orderkey * 7919) % 23 = 0 THEN 1 ELSE 0 END as int)",
    }
    return {name: columns[name] for name in RAW_COLUMNS}


def _vendor_table(orders: DataFrame, expressions: dict[str, str]) -> DataFrame:
    """What the raw table tells of a vendor, a row for each (keys may be negative or missing)."""
    spark = orders.sparkSession
    numbers = spark.range(1 - _VENDORS, _VENDORS, numPartitions=1).union(spark.sql("SELECT cast(NULL AS bigint)"))
    vendors = numbers.select(F.col("id").cast(orders.schema["o_orderkey"].dataType).alias("_vendor"))
    return vendors.select("_vendor", *[F.expr(e).alias(n) for n, e in expressions.items()])


def wide_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw table, one row per order.

    Columns that depend on the vendor alone are made once for each vendor and joined. The narrow
    rows are dealt out by their number before they become wide.
    """
    split_large_methods(spark)
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    texts = {n: e.replace(_VENDOR, "_vendor") for n, e in wide_expressions().items()}
    of_vendor = {n: e for n, e in texts.items() if "_vendor" in e and "o_" not in e and "c_" not in e}
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey)
    narrow = joined.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "c_acctbal", F.expr(_VENDOR).alias("_vendor"))
    dealt = deal_rows(narrow, orders.count())
    vendors = _vendor_table(orders, of_vendor).withColumnRenamed("_vendor", "_vendor_number")
    rows = dealt.join(F.broadcast(vendors), F.col("_vendor").eqNullSafe(F.col("_vendor_number")))
    return rows.select(*[F.col(f"`{n}`") if n in of_vendor else F.expr(e).alias(n) for n, e in texts.items()])

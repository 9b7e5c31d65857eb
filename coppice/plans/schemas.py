"""Column lists of the food-delivery table in its three forms."""

from __future__ import annotations

from pyspark.sql import types as T

# Names and order of the input files.
WEEKDAYS = ["sunday", "monday", "tuesday", "wednesday", "thursday", "friday", "saturday"]

TIME_COLUMNS = [
    f"{day}_{edge}_time{interval}"
    for day in WEEKDAYS
    for interval in (1, 2)
    for edge in ("from", "to")
]

# The 73 columns of the raw table (the test table lacks ``target``).
RAW_COLUMNS = [
    "customer_id", "gender", "status_x", "verified_x", "created_at_x", "updated_at_x",
    "location_number", "location_type", "latitude_x", "longitude_x", "id",
    "authentication_id", "latitude_y", "longitude_y", "vendor_category_en",
    "vendor_category_id", "delivery_charge", "serving_distance", "is_open", "OpeningTime",
    "OpeningTime2", "prepration_time", "commission", "is_akeed_delivering",
    "discount_percentage", "status_y", "verified_y", "rank", "language", "vendor_rating",
    *TIME_COLUMNS,
    "primary_tags", "open_close_flags", "vendor_tag", "vendor_tag_name", "one_click_vendor",
    "country_id", "city_id", "created_at_y", "updated_at_y", "device_type", "display_orders",
    "location_number_obj", "id_obj", "CID X LOC_NUM X VENDOR", "target",
]

# The 41 engineered columns (40 without ``target``).
ENGINEERED_COLUMNS = [
    "customer_id", "gender", "status_x", "verified_x", "create_at_x", "updated_at_x",
    "location_number", "location_type", "vendor_id", "latitude_x", "longitude_x",
    "latitude_y", "longitude_y", "vendor_category_en", "delivery_charge", "serving_distance",
    "is_open", "prepration_time", "commission", "is_akeed_delivering", "discount_percentage",
    "status_y", "verified_y", "rank", "language", "vendor_rating",
    "sunday", "monday", "tuesday", "wednesday", "thursday", "friday", "saturday",
    "primary_tags", "open_close_flags", "vendor_tag_sum", "created_at_y", "updated_at_y",
    "device_type", "location_number_obj", "target",
]

# The engineered columns that hold doubles; all others hold text.
ENGINEERED_DOUBLES = [
    "sunday", "monday", "tuesday", "wednesday", "thursday", "friday", "saturday",
    "vendor_tag_sum", "longitude_x", "longitude_y", "latitude_x", "latitude_y", "vendor_rating",
]

# Engineered columns whose raw column has another name.
ENGINEERED_ALIASES = {"create_at_x": "created_at_x", "vendor_id": "id"}

# The 41 numeric columns of the vector model.
VECTOR_COLUMNS = [
    "customer_id", "gender", "status_x", "verified_x", "created_at_x", "updated_at_x",
    "location_number", "location_type", "vendor_category_id", "vendor_category_en",
    "delivery_charge", "serving_distance", "sunday_opening_time", "monday_opening_time",
    "tuesday_opening_time", "wednesday_opening_time", "thursday_opening_time",
    "friday_opening_time", "saturday_opening_time", "is_akeed_delivering",
    "discount_percentage", "rank", "primary_tags", "verified_y", "status_y", "device_type",
    "latitude_x", "longitude_x", "latitude_y", "longitude_y", "created_at_y", "updated_at_y",
    "is_open", "prepration_time", "commission", "language", "open_close_flags", "vendor_tag",
    "vendor_tag_name", "location_number_obj", "vendor_rating",
]

DATE_COLUMNS = ["created_at_x", "updated_at_x", "created_at_y", "updated_at_y"]

_RAW_TYPES = {
    **dict.fromkeys(["latitude_x", "longitude_x", "latitude_y", "longitude_y"], T.DoubleType()),
    **dict.fromkeys(
        ["vendor_rating", "vendor_category_id", "delivery_charge", "serving_distance",
         "commission", "discount_percentage"],
        T.DoubleType(),
    ),
    **dict.fromkeys(
        ["status_x", "verified_x", "location_number", "id", "is_open", "prepration_time",
         "status_y", "verified_y", "rank", "open_close_flags", "country_id", "city_id",
         "device_type", "display_orders", "location_number_obj", "id_obj", "target"],
        T.IntegerType(),
    ),
}


def raw_schema(with_target: bool = True) -> T.StructType:
    """Schema of the raw table; columns without a numeric type are text."""
    names = RAW_COLUMNS if with_target else RAW_COLUMNS[:-1]
    return T.StructType([T.StructField(n, _RAW_TYPES.get(n, T.StringType())) for n in names])


def text_schema(names: list[str]) -> T.StructType:
    """All columns as text."""
    return T.StructType([T.StructField(n, T.StringType()) for n in names])

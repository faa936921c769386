"""Dimension tables of the star schema and the product catalog source.

``dim_user`` and ``dim_product`` are literal seed rows (100 and 24 rows);
``dim_date`` is generated from a date range with calendar functions, entirely
inside Spark (``sequence`` + ``explode``), so it scales with the range.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salespark.functions import time as TS
from salespark.schemas import CATALOG, DIM_PRODUCT, DIM_USER

# Product seed rows (product_id, name, category, brand, base_price).
PRODUCTS = [
    (101, 'MacBook Pro 14"', "Electronics", "Apple", "1999.99"),
    (102, "iPhone 16 Pro", "Electronics", "Apple", "1299.00"),
    (103, "AirPods Pro 2", "Electronics", "Apple", "279.00"),
    (104, "Samsung Galaxy S25", "Electronics", "Samsung", "899.00"),
    (105, "Sony WH-1000XM6", "Electronics", "Sony", "349.00"),
    (106, "Logitech MX Master 3S", "Electronics", "Logitech", "109.99"),
    (201, "iRobot Roomba j9+ Robot Vacuum", "Home", "iRobot", "899.00"),
    (202, "De'Longhi Magnifica Coffee Machine", "Home", "De'Longhi", "549.99"),
    (203, "Stainless Steel Cookware Set 10pc", "Home", "Lagostina", "189.00"),
    (204, "Philips Hue Smart Lamp", "Home", "Philips", "59.99"),
    (205, "Memory Foam Pillow", "Home", "Tempur", "39.99"),
    (206, "Dyson Air Purifier", "Home", "Dyson", "599.00"),
    (207, "Professional Cutting Board Set 3pc", "Home", "Berghoff", "34.99"),
    (301, "The North Face Winter Jacket", "Clothing", "The North Face", "259.99"),
    (302, "Nike Pegasus 41 Running Shoes", "Clothing", "Nike", "149.99"),
    (303, "Levi's 501 Classic Jeans", "Clothing", "Levi's", "98.00"),
    (304, "Casio G-Shock Watch", "Clothing", "Casio", "129.00"),
    (305, "Fjällräven Kånken Backpack", "Clothing", "Fjällräven", "89.99"),
    (401, "Technogym MyRun Treadmill", "Sports", "Technogym", "2995.00"),
    (402, "Dumbbell Set 20 kg", "Sports", "Decathlon", "79.99"),
    (403, "Quechua 2-Person Camping Tent", "Sports", "Quechua", "69.99"),
    (404, "Manduka Premium Yoga Mat 6mm", "Sports", "Manduka", "44.99"),
    (405, "Trek FX+ 2 Electric Bike", "Sports", "Trek", "2799.00"),
    (406, "Coleman 30L Cooler Bag", "Sports", "Coleman", "29.99"),
]

# User seed rows U-0001 .. U-0100, segment in id order.
USER_SEGMENTS = [
    "regular", "vip", "new", "regular", "regular", "new", "vip", "regular",
    "new", "regular", "vip", "regular", "new", "regular", "regular", "vip",
    "regular", "new", "regular", "vip", "new", "regular", "vip", "regular",
    "new", "regular", "vip", "regular", "new", "regular", "vip", "regular",
    "new", "regular", "vip", "regular", "new", "regular", "vip", "regular",
    "new", "regular", "vip", "regular", "new", "regular", "vip", "regular",
    "new", "regular", "vip", "regular", "new", "regular", "vip", "regular",
    "new", "regular", "vip", "regular", "new", "regular", "vip", "regular",
    "new", "regular", "vip", "regular", "new", "regular", "vip", "regular",
    "new", "regular", "vip", "regular", "new", "regular", "vip", "regular",
    "new", "regular", "vip", "regular", "new", "regular", "vip", "regular",
    "new", "regular", "vip", "regular", "new", "regular", "vip", "regular",
    "new", "regular", "vip", "regular",
]

# Allowed domains declared by the star schema.
SEGMENTS = ("new", "regular", "vip")
CATEGORIES = ("Electronics", "Home", "Clothing", "Sports")
SEED_DATE_START = "2025-01-01"
SEED_DATE_END = "2026-12-31"


def user_rows() -> list[tuple[str, str]]:
    return [(f"U-{i:04d}", seg) for i, seg in enumerate(USER_SEGMENTS, start=1)]


def product_rows() -> list[tuple]:
    return [(pid, name, cat, brand, Decimal(price)) for pid, name, cat, brand, price in PRODUCTS]


def dim_user(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(user_rows(), DIM_USER)


def dim_product(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(product_rows(), DIM_PRODUCT)


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """The product catalog: one JSON array of objects, schema given (no
    inference pass over the file)."""
    return spark.read.schema(CATALOG).option("multiLine", True).json(path)


def catalog_as_dim(catalog: DataFrame) -> DataFrame:
    """Catalog file rows -> dim_product layout (price as DECIMAL(10,2))."""
    return catalog.select(
        F.col("product_id").cast("int").alias("product_id"), "name", "category", "brand",
        F.col("base_price").cast("decimal(10,2)").alias("base_price"))


def catalog_rows() -> list[dict]:
    """Catalog objects in file order (for writing a catalog file)."""
    return [{"product_id": pid, "name": name, "category": cat,
             "base_price": float(price), "brand": brand}
            for pid, name, cat, brand, price in PRODUCTS]


def date_series(start, end) -> F.Column:
    """``GENERATE_SERIES(start, end, '1 day')`` as an exploded column; both
    ends included.  ``start`` / ``end`` are date columns or literals."""
    s = F.to_date(start if isinstance(start, F.Column) else F.lit(start))
    e = F.to_date(end if isinstance(end, F.Column) else F.lit(end))
    return F.explode(F.sequence(s, e, F.expr("INTERVAL 1 DAY")))


def calendar(days: DataFrame, col: str = "d") -> DataFrame:
    """Calendar attributes of a column of dates (dim_date layout)."""
    d = F.col(col)
    dow = TS.dow_sunday0(d)
    return days.select(
        d.alias("date_id"), d.alias("full_date"),
        F.year(d).alias("year"), F.quarter(d).alias("quarter"), F.month(d).alias("month"),
        TS.padded_name(d, "MMMM").alias("month_name"),
        F.dayofmonth(d).alias("day"),
        dow.alias("day_of_week"),
        TS.padded_name(d, "EEEE").alias("day_name"),
        dow.isin(0, 6).alias("is_weekend"))


def dim_date(spark: SparkSession, start: str = SEED_DATE_START,
             end: str = SEED_DATE_END) -> DataFrame:
    """dim_date for a fixed range (the seed uses 2025-01-01 .. 2026-12-31)."""
    days = spark.range(1).select(date_series(start, end).alias("d"))
    return calendar(days)


def dim_date_covering(dates: DataFrame, col: str = "date_id") -> DataFrame:
    """dim_date spanning the min..max of a date column of the data.

    One global min/max aggregate (partial per task, one row shuffled per
    task), then the day sequence.  Its size is bounded by the calendar span
    of the data (365 rows per year), not by the number of sales."""
    bounds = dates.agg(F.min(col).alias("lo"), F.max(col).alias("hi"))
    days = bounds.select(date_series(F.col("lo"), F.col("hi")).alias("d"))
    return calendar(days)


def sequence_source(spark: SparkSession, start: int = 1, end: int = 5) -> DataFrame:
    """Bounded id sequence (``datagen`` with kind=sequence): ids start..end."""
    return spark.range(start, end + 1).select(F.col("id").cast("int").alias("id"))

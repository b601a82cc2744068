"""Rows for the unit tests."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NOTE = (
    "Red plum and cocoa lead, with a firm middle of slate and thyme; the tannins are fine, the acids bright, "
    "and the finish holds on long enough to promise a good many years of rest in a cool cellar."
)

RAW = "ordinal bigint, description string, price double, points bigint, variety string, country string, province string, region_1 string, winery string, designation string, title string, taster_name string"


def raw(spark: SparkSession, *changes: dict) -> DataFrame:
    base = {
        "description": NOTE, "price": 27.5, "points": 88, "variety": "Syrah", "country": "Chile", "province": "Maule",
        "region_1": "Loncomilla", "winery": "Piedra", "designation": "Alta", "title": "Alta, harvest of 2011",
        "taster_name": "A. Taster",
    }
    names = [part.split()[0] for part in RAW.split(", ")]
    rows = [tuple({**base, "ordinal": i, **change}[name] for name in names) for i, change in enumerate(changes)]
    return spark.createDataFrame(rows, RAW)


def priced(spark: SparkSession, prices: list[float]) -> DataFrame:
    """Curated-like rows with distinct notes."""
    rows = [(i, i, float(p), f"{NOTE} No {i}.") for i, p in enumerate(prices)]
    extra = {name: F.lit(None).cast("string") for name in ("variety", "country", "province", "region", "winery", "title")}
    return spark.createDataFrame(rows, "ordinal bigint, id bigint, price double, description string").withColumns(
        {**extra, "vintage": F.lit(None).cast("bigint")}
    )

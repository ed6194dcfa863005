"""Explicit schemas of the delimited inputs, one place per source."""

from __future__ import annotations

from pyspark.sql import types as T

# Field names and types of the known input files.
RATINGS = "user_id int, item_id int, rating int, rated_at bigint"
USERS = "userid int, age int, gender string, occupation string, zipcode string"
GENRES = "name string, genre_id int"
OCCUPATIONS = "occupation string"
ZIPCODES = "zipcode bigint, zipCodeType string, city string, state string"
HOURLY = (
    "instant int, dteday string, season double, yr int, mnth double, hr double, holiday double, "
    "weekday double, workingday double, weathersit double, temp double, atemp double, hum double, "
    "windspeed double, casual int, registered int, cnt double"
)
HOURLY_FEATURES = [
    "season", "mnth", "hr", "holiday", "weekday", "workingday", "weathersit",
    "temp", "atemp", "hum", "windspeed",
]
COVER_NAMES = {"f0": "海拔", "f1": "方位", "f2": "斜率", "f3": "垂直距离", "f4": "水平距离", "f5": "阴影"}



def numbered(width: int, kind: T.DataType | None = None, prefix: str = "f") -> T.StructType:
    """``width`` nullable columns ``f0, f1, …`` of one type (string unless given)."""
    kind = kind or T.StringType()
    return T.StructType([T.StructField(f"{prefix}{i}", kind, True) for i in range(width)])


def items() -> T.StructType:
    """Item file: four descriptive columns after the id, then 19 genre flags."""
    lead = T.StructType.fromDDL(
        "item_id int, title string, release_date string, video_date string, url string"
    )
    return T.StructType(lead.fields + numbered(19, T.IntegerType(), "genre_").fields)

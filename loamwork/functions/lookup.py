"""Decoding of small fixed code lists."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

# Descriptions of the page-type and hourly-rental codes, as users of these inputs know them.
PAGE_TYPES = {0: "暂时性网页(ephemeral)", 1: "长青网页(evergreen)"}
SEASONS = {1: "春", 2: "夏", 3: "秋", 4: "冬"}
HOLIDAYS = {0: "非假日", 1: "假日"}
WEEKDAYS = {0: "一", 1: "二", 2: "三", 3: "四", 4: "五", 5: "六", 6: "日"}
WORKDAYS = {1: "工作日", 0: "非工作日"}
WEATHER = {1: "晴", 2: "阴", 3: "小雨", 4: "大雨"}
# Factors that undo the scaling of the hourly-rental inputs.
HOURLY_UNITS = {"temp": 41, "atemp": 50, "hum": 100, "windspeed": 67}


def decode(code: Column, names: Mapping) -> Column:
    """Description of a code from a literal mapping; unknown codes give null."""
    pairs = [F.lit(x) for pair in names.items() for x in pair]
    if not all(isinstance(k, int) for k in names):
        return F.try_element_at(F.create_map(*pairs), code)
    whole = code.try_cast("int")
    return F.when(code == whole, F.try_element_at(F.create_map(*pairs), whole))


def denormalise(columns: Mapping[str, float]) -> list[Column]:
    """Scaled columns multiplied back to display units."""
    return [(F.col(name) * F.lit(float(factor))).alias(name) for name, factor in columns.items()]

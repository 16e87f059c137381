"""Decompose the dictionary's geographic text into country, province and city."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clickweir.schemas import UNKNOWN

# Fixed values of the dictionary's vocabulary and of the resulting fields.
CHINA = "中国"
DEFAULT_PROVINCE = "上海市"
LAN = "局域网"
PLACEHOLDER_PREFIX = "CZ88"
PROVINCE_MARK = "省"
CITY_MARK = "市"
DISTRICT_MARK = "区"
COUNTY_MARK = "县"
INNER_MONGOLIA = "内蒙"
INNER_MONGOLIA_PROVINCE = "内蒙古自治区"
REGIONS = ["广西", "西藏", "宁夏", "新疆"]
MUNICIPALITIES = ["上海", "北京", "重庆", "天津"]
SPECIAL_REGIONS = ["香港", "澳门"]
SPECIAL_SUFFIX = "特别行政区"
NO_COUNTRY = "未知国家"
NO_AREA = "未知地区"


def _up_to(text: Column, mark: str) -> Column:
    """Text up to and including ``mark``, when ``mark`` is not its first character."""
    at = F.instr(text, mark)
    return F.when(at > 1, F.substr(text, F.lit(1), at))


def region_of(text: Column) -> Column:
    """Struct (country, province, city); fields without a rule stay ``unknown``."""
    unset = F.lit(UNKNOWN)
    local = (
        text.isNull() | (text == "") | (text == LAN)
        | F.trim(text).startswith(PLACEHOLDER_PREFIX)
    )
    province_at = F.instr(text, PROVINCE_MARK)
    in_province = province_at > 1
    too_short = F.length(text) < 2
    head = F.substring(text, 1, 2)
    after_two, after_three = F.substr(text, F.lit(3)), F.substr(text, F.lit(4))
    mongolia = head == INNER_MONGOLIA
    autonomous = head.isin(REGIONS)
    municipal = head.isin(MUNICIPALITIES)
    special = head.isin(SPECIAL_REGIONS)

    country = (
        F.when(local | in_province, CHINA)
        .when(too_short, unset)
        .when(mongolia | autonomous | municipal | special, CHINA)
        .otherwise(text)
    )
    province = (
        F.when(local, DEFAULT_PROVINCE)
        .when(in_province, F.substr(text, F.lit(1), province_at))
        .when(too_short, unset)
        .when(mongolia, INNER_MONGOLIA_PROVINCE)
        .when(autonomous, head)
        .when(municipal, F.concat(head, F.lit(CITY_MARK)))
        .when(special, F.concat(head, F.lit(SPECIAL_SUFFIX)))
        .otherwise(unset)
    )
    # Inside a province the city may directly follow the province mark.
    past_province = F.substr(text, province_at + 1)
    city_at = F.instr(past_province, CITY_MARK)
    city = (
        F.when(local, unset)
        .when(in_province, F.when(city_at > 0, F.substr(past_province, F.lit(1), city_at)))
        .when(too_short, unset)
        .when(mongolia, _up_to(after_three, CITY_MARK))
        .when(autonomous, _up_to(after_two, CITY_MARK))
        .when(
            municipal,
            F.coalesce(_up_to(after_three, DISTRICT_MARK), _up_to(after_three, COUNTY_MARK)),
        )
    )
    return F.struct(
        country.alias("country"),
        province.alias("province"),
        F.coalesce(city, unset).alias("city"),
    )

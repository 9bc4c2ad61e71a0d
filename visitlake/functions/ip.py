"""IPv4 text and numbers, region names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from visitlake.functions.text import trim_controls
from visitlake.schema import UNKNOWN


def ip_to_long(ip: Column) -> Column:
    """IPv4 text -> number. Octets keep their low 8 bits; from the first unreadable one on they are 0.

    Empty octets do not count and missing ones are 0.
    """
    zeros = F.array(*[F.lit("0")] * 4)
    octets = F.slice(F.concat(F.array_remove(F.split(ip, r"\."), ""), zeros), 1, 4)

    def append(number: Column, octet: Column) -> Column:
        text_ok = number["readable"] & (octet == trim_controls(octet))
        value = F.when(text_ok, octet.try_cast("int")).cast("bigint")
        low = F.coalesce(value.bitwiseAND(F.lit(255).cast("bigint")), F.lit(0).cast("bigint"))
        return F.struct((number["value"] * 256 + low).alias("value"), value.isNotNull().alias("readable"))

    start = F.struct(F.lit(0).cast("bigint").alias("value"), F.lit(True).alias("readable"))
    return F.reduce(octets, start, append)["value"]


def long_to_ip(n: Column) -> Column:
    low = F.lit(255).cast("bigint")
    return F.concat_ws(
        ".",
        F.shiftright(n, 24).cast("string"),
        F.shiftright(n, 16).bitwiseAND(low).cast("string"),
        F.shiftright(n, 8).bitwiseAND(low).cast("string"),
        n.bitwiseAND(low).cast("string"),
    )


def address_text(country: Column, area: Column) -> Column:
    """Country and area in one line, leaving out the placeholder of the range table."""
    placeholder = " CZ88.NET"
    shown = [F.when(c == placeholder, "").otherwise(F.coalesce(c, F.lit(""))) for c in (country, area)]
    return trim_controls(F.concat(shown[0], F.lit(" "), shown[1]))


# Place names and suffix characters of the region rules.
HOME = "中国"
LOCAL_NETWORK = "局域网"
LOCAL_SUFFIX = "CZ88"
PROVINCE_END = "省"
CITY_END = "市"
DISTRICT_END = "区"
COUNTY_END = "县"
NOT_DISTRICT = ["小", "校"]
INNER_MONGOLIA = "内蒙"
INNER_MONGOLIA_FULL = "内蒙古自治区"
AUTONOMOUS_REGIONS = ["广西", "宁夏", "西藏", "新疆"]
MUNICIPALITIES = ["上海", "北京", "重庆", "天津"]
SPECIAL_REGIONS = ["香港", "澳门"]
SPECIAL_REGION_SUFFIX = "特别行政区"


def _through(text: Column, mark: str) -> Column:
    """Text up to and including the first `mark`; null when the mark is absent or comes first."""
    at = F.instr(text, mark)
    return F.when(at > 1, F.substring(text, F.lit(1), at))


def parse_region(place: Column) -> Column:
    """Struct (country, province, city) read out of the place text of an IP range."""
    length = F.length(place)
    head = F.substring(place, 1, 2)
    province_at = F.instr(place, PROVINCE_END)
    after_head = F.substring(place, F.lit(3), length)
    after_third = F.substring(place, F.lit(4), length)

    # province: city is what lies between the province mark and the next city mark
    after_province = F.substring(place, province_at + 1, length)
    city_at = F.instr(after_province, CITY_END)
    province_city = F.when(city_at > 0, F.substring(after_province, F.lit(1), city_at))

    # municipality: a district, unless the mark belongs to a housing estate or campus, else a county
    district_at = F.instr(after_third, DISTRICT_END)
    before_mark = F.substring(after_third, district_at - 1, F.lit(1))
    district = F.when(
        (district_at > 1) & ~before_mark.isin(NOT_DISTRICT), F.substring(after_third, F.lit(1), district_at)
    )

    unknown = F.lit(UNKNOWN)

    def region(country: Column, province: Column = unknown, city: Column = unknown) -> Column:
        return F.struct(
            country.alias("country"), province.alias("province"), F.coalesce(city, unknown).alias("city")
        )

    home = F.lit(HOME)
    return (
        F.when(F.coalesce(place, F.lit("")) == "", region(unknown))
        .when(
            (place == LOCAL_NETWORK) | trim_controls(place).endswith(LOCAL_SUFFIX),
            region(home, F.lit(LOCAL_NETWORK)),
        )
        .when(province_at > 1, region(home, F.substring(place, F.lit(1), province_at), province_city))
        .when(head == INNER_MONGOLIA, region(home, F.lit(INNER_MONGOLIA_FULL), _through(after_third, CITY_END)))
        .when(head.isin(AUTONOMOUS_REGIONS), region(home, head, _through(after_head, CITY_END)))
        .when(
            head.isin(MUNICIPALITIES),
            region(home, F.concat(head, F.lit(CITY_END)), F.coalesce(district, _through(after_third, COUNTY_END))),
        )
        .when(head.isin(SPECIAL_REGIONS), region(home, F.concat(head, F.lit(SPECIAL_REGION_SUFFIX))))
        .otherwise(region(place))
    )

"""Region and browser enrichment of events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweir.functions import agents, geo, network
from clickweir.functions.text import blank_to_null, not_blank
from clickweir.operators import joins
from clickweir.operators.columns import computed_once


def ip_range_join(
    df: DataFrame,
    ip_ranges: DataFrame,
    ip: str = "ip",
    max_bytes: int = joins.BROADCAST_BYTES,
    max_per_bucket: int = joins.BUCKET_RANGES,
) -> DataFrame:
    """Add ``geo_country`` and ``geo_area``, the dictionary texts of an address.

    Columns of ``ip_ranges`` beyond country and area are carried along.
    """
    extra = [c for c in ip_ranges.columns
             if c not in ("begin_ip_num", "end_ip_num", "country", "area")]
    dimension = ip_ranges.select(
        F.col("begin_ip_num").alias("_begin"),
        F.col("end_ip_num").alias("_end"),
        F.col("country").alias("geo_country"),
        F.col("area").alias("geo_area"),
        *extra,
    )
    probed = df.withColumn("_ip_num", network.ip_to_long(F.col(ip)))
    joined = joins.range_join(
        probed, "_ip_num", dimension, "_begin", "_end", max_bytes, max_per_bucket
    )
    found = F.col("_begin").isNotNull()
    return joined.select(
        *[F.col(c) for c in df.columns],
        F.when(found, F.col("geo_country")).otherwise(geo.NO_COUNTRY).alias("geo_country"),
        F.when(found, F.col("geo_area")).otherwise(geo.NO_AREA).alias("geo_area"),
        *extra,
    )


def enrich_ip(
    df: DataFrame,
    ip_ranges: DataFrame,
    ip: str = "client_ip",
    max_bytes: int = joins.BROADCAST_BYTES,
    max_per_bucket: int = joins.BUCKET_RANGES,
) -> DataFrame:
    """Fill country, province and city from the address.

    The text rules run once per dictionary range, not once per event. A blank
    address or field leaves the event's own value in place.
    """
    dimension = ip_ranges.withColumn("_region", geo.region_of(F.col("country")))
    joined = ip_range_join(df, dimension, ip, max_bytes, max_per_bucket)
    nowhere = F.struct(
        F.lit(geo.NO_COUNTRY).alias("country"),
        F.lit("unknown").alias("province"),
        F.lit("unknown").alias("city"),
    )
    region = F.when(not_blank(F.col(ip)), F.coalesce("_region", nowhere))
    filled = {}
    for name in ("country", "province", "city"):
        own = F.col(name) if name in df.columns else F.lit(None).cast("string")
        filled[name] = F.coalesce(blank_to_null(region[name]), own)
    return joined.withColumns(filled).drop("_region", "geo_country", "geo_area")


def enrich_user_agent(
    df: DataFrame,
    agent: str = "b_iev",
    browsers: list[agents.BrowserRule] = agents.BROWSERS,
    systems: list[agents.SystemRule] = agents.SYSTEMS,
) -> DataFrame:
    """Fill browser, browser_v, os and os_v from the user agent.

    Plain expressions on every row: no shuffle, whatever the skew of agents.
    """
    matched = computed_once(df, "_browser", agents.browser_of(F.col(agent), browsers))
    # No generator here: a projection is pruned where nobody reads the system.
    matched = matched.withColumn("_system", agents.system_of(F.col(agent), systems))
    filled = {}
    for name in ("browser", "browser_v", "os", "os_v"):
        value = F.col("_browser" if name.startswith("browser") else "_system")[name]
        filled[name] = F.coalesce(value, F.col(name)) if name in df.columns else value
    return matched.withColumns(filled).drop("_browser", "_system")


def search_ip_ranges(ip_ranges: DataFrame, text: str) -> DataFrame:
    """Ranges whose country or area contains ``text``, with dotted addresses."""
    return ip_ranges.where(
        F.col("country").contains(text) | F.col("area").contains(text)
    ).select(
        network.long_to_ip(F.col("begin_ip_num")).alias("begin_ip"),
        network.long_to_ip(F.col("end_ip_num")).alias("end_ip"),
        "country",
        "area",
    )


def list_ip_ends(ip_ranges: DataFrame) -> DataFrame:
    """Dotted end address of every range."""
    return ip_ranges.select(network.long_to_ip(F.col("end_ip_num")).alias("end_ip"))

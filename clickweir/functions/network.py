"""IPv4 text <-> number helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_OCTET = r"(?:25[0-5]|2[0-4]\d|[01]?\d?\d)"
_IPV4 = rf"^{_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}$"

# Placeholder the address dictionary stores where it has no text (fixed value).
NO_TEXT = " CZ88.NET"


def ip_to_long(c: Column) -> Column:
    """Dotted IPv4 to an unsigned number; malformed text gives null."""
    octets = F.split(c, r"\.")
    number = F.lit(0).cast("long")
    for position in range(4):
        number = number * 256 + F.get(octets, F.lit(position)).try_cast("long")
    return F.when(c.rlike(_IPV4), number)


def long_to_ip(c: Column) -> Column:
    octets = [F.shiftright(c, shift).bitwiseAND(255).cast("string") for shift in (24, 16, 8, 0)]
    return F.when(c.isNotNull(), F.concat_ws(".", *octets))


def address_text(country: Column, area: Column) -> Column:
    """``country area`` without the no-text placeholder, trimmed."""
    def clean(c: Column) -> Column:
        return F.when(c == NO_TEXT, F.lit("")).otherwise(c)

    return F.trim(F.concat(clean(country), F.lit(" "), clean(area)))

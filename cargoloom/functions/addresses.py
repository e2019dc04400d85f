"""Parts of comma-separated addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Where the parts of a default-layout address stand.
# city = the segment before the last one; district = the second of four or more.
CITY_PATTERN = r",\s*([^,]+),\s*[^,]+$"
DISTRICT_PATTERN = r",\s*([^,]+),\s*[^,]+,"
# Fixed value: the form of a Vietnamese street address.
ADDRESS_FORM = "Số %s %s, %s, %s"

LAYOUTS = ("default", "street_district_city")


def _captured(address: Column | str, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(address, pattern, 1), F.lit(""))


def _from_end(address: Column | str, position: int) -> Column:
    parts = F.split(address, ",")
    part = F.trim(F.element_at(parts, -position))
    return F.when(F.size(parts) >= 3, F.nullif(part, F.lit("")))


def _check(layout: str) -> None:
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}, not {layout!r}")


def address_city(address: Column | str, layout: str = "default") -> Column:
    """City of an address, null for fewer than three segments.

    The default layout takes the next-to-last segment; ``street_district_city``
    takes the last one, as addresses written by :func:`full_address` need.
    """
    _check(layout)
    return _captured(address, CITY_PATTERN) if layout == "default" else _from_end(address, 1)


def address_district(address: Column | str, layout: str = "default") -> Column:
    _check(layout)
    return _captured(address, DISTRICT_PATTERN) if layout == "default" else _from_end(address, 2)


def full_address(number: Column, street: Column, district: Column, city: Column) -> Column:
    """House number, street, district and city as one line; null if any part is null."""
    line = F.format_string(ADDRESS_FORM, number.cast("string"), street, district, city)
    whole = number.isNotNull() & street.isNotNull() & district.isNotNull() & city.isNotNull()
    return F.when(whole, line)

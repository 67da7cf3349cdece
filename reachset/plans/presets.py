"""Market presets: city -> posting metro area, state, location predicates
(SURVEY §2.10, F11).

A preset is parameter data, fixed and tiny (26 rows).  It is resolved in
Python when the plan is built, and becomes literal predicates that Spark
pushes into the Parquet scan.  ``ip_city=None`` means "every city of the
metro area", taken from recent job postings by a semi-join at run time.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.algebra import restrict_to


@dataclass(frozen=True)
class MarketPreset:
    city: str
    include_metro: bool
    jlmsa: str
    state: str
    ip_city: str | None
    ip_regions: tuple[str, ...]


# They must equal the reference's presets.
# (city, include_metro, jlmsa, state, ip_city or None for the metro list, ip_regions)
_PRESET_ROWS = [
    ("Chicago", True, "Chicago-Naperville-Elgin, IL-IN-WI", "IL", None, ("IL", "IN", "WI")),
    ("Sacramento", True, "Sacramento--Roseville--Arden-Arcade, CA", "CA", None, ("CA",)),
    ("Phoenix", True, "Phoenix-Mesa-Scottsdale, AZ", "AZ", None, ("AZ",)),
    ("Seattle", True, "Seattle-Tacoma-Bellevue, WA", "WA", None, ("WA",)),
    ("Boston", True, "Boston-Cambridge-Newton, MA-NH", "MA", None, ("MA", "NH")),
    ("Detroit", True, "Detroit-Warren-Dearborn, MI", "MI", None, ("MI",)),
    ("Washington D.C.", True, "Washington-Arlington-Alexandria, DC-VA-MD-WV", "DC", None, ("DC", "VA", "MD", "WV")),
    ("Atlanta", True, "Atlanta-Sandy Springs-Roswell, GA", "GA", None, ("GA",)),
    ("Austin", True, "Austin-Round Rock, TX", "TX", None, ("TX",)),
    ("New York City", True, "New York-Newark-Jersey City, NY-NJ-PA", "NY", None, ("NY", "NJ", "PA")),
    ("Sunnyvale", True, "San Jose-Sunnyvale-Santa Clara, CA", "CA", "Sunnyvale", ("CA",)),
    ("Scottsdale", True, "Phoenix-Mesa-Scottsdale, AZ", "AZ", "Phoenix", ("AZ",)),
    ("San Francisco", True, "San Francisco-Oakland-Hayward, CA", "CA", "San Francisco", ("CA",)),
    ("Chicago", False, "Chicago-Naperville-Elgin, IL-IN-WI", "IL", "Chicago", ("IL",)),
    ("Sacramento", False, "Sacramento--Roseville--Arden-Arcade, CA", "CA", "Sacramento", ("CA",)),
    ("Phoenix", False, "Phoenix-Mesa-Scottsdale, AZ", "AZ", "Phoenix", ("AZ",)),
    ("Seattle", False, "Seattle-Tacoma-Bellevue, WA", "WA", "Seattle", ("WA",)),
    ("Boston", False, "Boston-Cambridge-Newton, MA-NH", "MA", "Boston", ("MA",)),
    ("Detroit", False, "Detroit-Warren-Dearborn, MI", "MI", "Detroit", ("MI",)),
    ("Washington D.C.", False, "Washington-Arlington-Alexandria, DC-VA-MD-WV", "DC", "Washington DC", ("DC",)),
    ("Atlanta", False, "Atlanta-Sandy Springs-Roswell, GA", "GA", "Atlanta", ("GA",)),
    ("Austin", False, "Austin-Round Rock, TX", "TX", "Austin", ("TX",)),
    ("New York City", False, "New York-Newark-Jersey City, NY-NJ-PA", "NY", "New York City", ("NY",)),
    ("Sunnyvale", False, "San Jose-Sunnyvale-Santa Clara, CA", "CA", "Sunnyvale", ("CA",)),
    ("Scottsdale", False, "Phoenix-Mesa-Scottsdale, AZ", "AZ", "Phoenix", ("AZ",)),
    ("San Francisco", False, "San Francisco-Oakland-Hayward, CA", "CA", "San Francisco", ("CA",)),
]

METRO_PRESETS: dict[tuple[str, bool], MarketPreset] = {
    (r[0], r[1]): MarketPreset(*r) for r in _PRESET_ROWS
}

CITIES = tuple(dict.fromkeys(r[0] for r in _PRESET_ROWS))


def preset(city: str, include_metro: bool) -> MarketPreset:
    try:
        return METRO_PRESETS[(city, bool(include_metro))]
    except KeyError:
        raise ValueError(f"unknown city {city!r}; one of {', '.join(CITIES)}") from None


def near_market(
    df: DataFrame,
    presets: Mapping[tuple[str, bool], MarketPreset],
    city: str,
    include_metro: bool,
    city_col: str,
    region_col: str | None = None,
    metro_cities: DataFrame | None = None,
    metro_key: str | None = None,
    spread_by: str | None = None,
) -> DataFrame:
    """Rows in the preset's place.

    With an ``ip_city`` the place is that city; without one it is every city
    of ``metro_cities`` (column ``metro_key``), by a semi-join that leaves the
    rows where they are while the list is small.  ``region_col``, if given,
    must be one of the preset's regions.
    """
    pr = presets[city, include_metro]
    if region_col is not None:
        df = df.where(F.col(region_col).isin(*pr.ip_regions))
    if pr.ip_city is not None:
        return df.where(F.col(city_col) == pr.ip_city)
    if metro_cities is None:
        raise ValueError(f"{city} with its metro area needs the list of the metro's cities")
    return restrict_to(df, metro_cities, on=city_col, keys_on=metro_key, spread_by=spread_by)


def presets_frame(
    spark: SparkSession, presets: Mapping[tuple[str, bool], MarketPreset] = METRO_PRESETS
) -> DataFrame:
    """The 26 presets as a DataFrame (for joins over several markets)."""
    rows = [
        (p.city, p.include_metro, p.jlmsa, p.state, p.ip_city, list(p.ip_regions))
        for p in presets.values()
    ]
    schema = (
        "city string, include_metro boolean, jlmsa string, state string, "
        "ip_city string, ip_regions array<string>"
    )
    return spark.createDataFrame(rows, schema).select(
        "city", "include_metro", "jlmsa", "state", "ip_city", F.col("ip_regions")
    )

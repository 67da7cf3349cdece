"""Every market in one pass (F11, §2.10, Q3).

The presets and the metro lists make one table of places, a row per market and
city; one join of an event dataset with it gives the markets of each event.  The
whole of Q3 for all markets then reads each dataset once, where separate runs
read it once per market.  A market is named by the preset's ``city`` and
``include_metro``, here ``market`` and ``metro``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import days_before, resolve_date, window_bounds
from ..functions.predicates import id_key, non_empty
from ..operators.algebra import (
    MEASURE_FROM,
    audience,
    exclude,
    hot_values,
    semi_join_spread,
)
from ..sources.events import event_window
from ..sources.lookups import attach_profile, employer_accounts
from .market import MarketParams
from .presets import METRO_PRESETS, MarketPreset, presets_frame

MARKET = ["market", "metro"]


def market_places(
    spark: SparkSession,
    metro_cities: DataFrame,
    presets: Mapping[tuple[str, bool], MarketPreset] = METRO_PRESETS,
) -> DataFrame:
    """``market, metro, state, place, regions``: the cities of every market.

    ``metro_cities`` (``jlmsa, place``) lists the cities of each metro area; it
    serves the presets without a city of their own.
    """
    rows = presets_frame(spark, presets).select(
        F.col("city").alias("market"), F.col("include_metro").alias("metro"), "state", "jlmsa",
        F.col("ip_city").alias("own"), F.col("ip_regions").alias("regions"),
    )
    listed = F.broadcast(rows.where("own is null").drop("own"))  # the presets, a fixed few
    cities = metro_cities.where(non_empty("place")).select("jlmsa", "place").distinct()
    return (
        rows.where("own is not null").withColumnRenamed("own", "place")
        .unionByName(cities.join(listed, "jlmsa"))
        .select(*MARKET, "state", "place", "regions")
    )


def near_any_market(
    df: DataFrame,
    places: DataFrame,
    city_col: str,
    region_col: str | None = None,
    spread_by: str | None = None,
    measure_from: int | None = MEASURE_FROM,
) -> DataFrame:
    """Rows of ``df`` with ``market, metro, state``, once for each market they lie in.

    As :func:`~reachset.plans.presets.near_market` for all presets at once.
    While the places are few they are broadcast; in a large dataset the cities
    that many rows share are measured and salted by ``spread_by``.
    """
    keyed = places.select(F.col("place").alias("_place"), *MARKET, "state", F.col("regions").alias("_regions"))
    rows = df.withColumn("_place", F.col(city_col)).where(F.col("_place").isNotNull())
    hot = hot_values(rows, "_place", measure_from) if spread_by else []
    if hot:
        found = semi_join_spread(rows, keyed, "_place", spread_by, hot, how="inner")
    else:
        found = rows.join(keyed, "_place")
    if region_col is not None:
        found = found.where(F.array_contains("_regions", F.col(region_col)))
    return found.drop("_place", "_regions")


def metro_lists(tables: Mapping[str, DataFrame], p: MarketParams, focus, presets=METRO_PRESETS) -> DataFrame:
    """``jlmsa, place`` of all metro areas with job postings in the window: one scan."""
    posts = event_window(
        tables["job_postings"], days_before(focus, p.metro_days), focus, partition_col=p.partition_col
    ).where(
        (F.col("jobcountry") == p.country)
        & F.col("jlmsa").isin(sorted({pr.jlmsa for pr in presets.values()}))
        & non_empty("jlcity")
    )
    return audience(posts, "jlmsa", "jlcity").withColumnRenamed("jlcity", "place")


def reference_all_markets(
    tables: Mapping[str, DataFrame],
    p: MarketParams = MarketParams(),
    presets: Mapping[tuple[str, bool], MarketPreset] = METRO_PRESETS,
) -> DataFrame:
    """Q3 of every preset: ``market, metro`` and the columns of ``reference_market``.

    ``p.city`` and ``p.include_metro`` take no part.
    """
    if p.account_days == 0 and p.alert_days == 0:
        raise ValueError("no source selected: both the account and the alert window are 0")
    focus, key = resolve_date(p.focus, p.as_of), "accountId"
    spark = tables["job_postings"].sparkSession
    places = market_places(spark, metro_lists(tables, p, focus, presets), presets)
    keys = [*MARKET, key]

    def win(name: str, days: int) -> DataFrame:
        lo, hi = window_bounds(days_before(focus, days), focus)
        return event_window(tables[name], lo, hi, partition_col=p.partition_col)

    parts = []
    if p.alert_days > 0:
        found = near_any_market(
            win("job_alerts", p.alert_days)
            .where(
                (F.col("country") == p.country.lower())
                & (F.col("ipCountry") == p.country)
                & non_empty("accountId")
            )
            .select(id_key("accountId").alias(key), "ipCity", "ipRegion"),
            places, "ipCity", "ipRegion", spread_by=key,
        ).where(F.col(key).isNotNull()).withColumnRenamed("state", "home")
        located = [F.col("ipCity").alias("City"), F.col("ipRegion").alias("State")]
        parts.append(found.select(*keys, "home", *located).distinct())
    if p.account_days > 0:
        signins = near_any_market(
            win("sign_ins", p.account_days)
            .where(F.col("js_ip_country_code") == p.country)
            .select("ipcity", id_key("accountId").alias(key)),
            places, "ipcity", spread_by=key,
        ).where(F.col(key) != 0).select(*keys, F.col("state").alias("home")).distinct()
        created = win("new_accounts", p.account_days).where(F.col("country") == p.country)
        created = audience(created.select(id_key("accountid").alias(key)).where(F.col(key) != 0), key)
        parts.append(signins.join(created, key, "left_semi").select(*keys, "home"))
    aud = parts[0] if len(parts) == 1 else parts[0].join(parts[1], [*keys, "home"], "full")
    aud = aud.withColumns({c: F.col(c) if c in aud.columns else F.lit(None).cast("string") for c in ("City", "State")})
    named = attach_profile(
        aud, key, primary=tables["email"], primary_key="id",
        primary_cols={"emailAddress": "emailAddress"}, secondary=tables["account_names"],
        link=("id", "account_id"), secondary_cols={"lastName": "family_name", "firstName": "given_name"},
    )
    employers = employer_accounts(tables["advertiser_info"], key, "advertiser_id", source="accountId")
    kept = exclude(named, employers, key, null_keys=False).withColumns(
        {"City": F.coalesce("City", "market"), "State": F.coalesce("State", "home")}
    )
    columns = ["City", "State", "emailAddress", "lastName", "firstName"]
    if not p.one_row_per_account:
        return kept.select(*keys, *columns)
    best = kept.groupBy(*keys).agg(F.min(F.struct(*columns)).alias("_best"))
    return best.select(*keys, *[F.col(f"_best.{c}").alias(c) for c in columns])

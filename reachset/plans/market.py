"""Q3 -- city/metro market audience with profile, employers removed
(SURVEY §2.11 Q3, §3.3).

``market_audience`` is the algebra: full outer join of the alert and the
account audiences, profile attached, defaults filled, employers removed.
``reference_market`` builds its inputs from the reference's datasets and
the city presets.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import days_before, resolve_date, window_bounds
from ..functions.predicates import id_key, non_empty
from ..operators.algebra import audience, combine, exclude
from ..operators.shape import RowGuard, fill_defaults, rename, with_literals
from ..sources.events import event_window, intersect_sources
from ..sources.lookups import attach_profile, employer_accounts
from .presets import METRO_PRESETS, MarketPreset, near_market, preset


def market_audience(
    alerts: DataFrame | None,
    accounts: DataFrame | None,
    attach: Callable[[DataFrame], DataFrame],
    employers: DataFrame,
    defaults: Mapping[str, object],
    key: str = "accountId",
    one_row_per_account: bool = False,
) -> DataFrame:
    """Accounts from alerts and/or new accounts, with profile attributes.

    ``alerts`` carries (key, location attributes); ``accounts`` carries the
    key (and possibly literal location columns).  With both, they are
    combined by a full outer join on the key (one coalesced key column).
    ``attach`` adds the profile attributes (normally
    :func:`~reachset.sources.lookups.attach_profile` with ``how="left"``);
    ``defaults`` fills missing attributes; keys in ``employers`` are
    removed by an anti-join.

    An account with alerts from several cities keeps one row per city, as
    in the reference.  ``one_row_per_account`` keeps only its smallest
    (attributes...) row, chosen by a grouped ``min`` over a struct, which
    aggregates map-side instead of collecting the account's rows.
    """
    if alerts is None and accounts is None:
        raise ValueError("no source selected: both the account and the alert window are 0")
    if alerts is None:
        aud = accounts.distinct()
    elif accounts is None:
        aud = alerts.distinct()
    else:
        # Both sides distinct (a no-op when they come from a grouping, which
        # Catalyst removes) => the full join's rows are distinct too: the
        # reference's drop_duplicates after its outer merge needs no shuffle.
        aud = combine(alerts.distinct(), accounts.distinct(), key, how="full")
    with_profile = attach(aud)
    present = {c: v for c, v in defaults.items() if c in with_profile.columns}
    filled = fill_defaults(with_profile, present)
    kept = exclude(filled, employers, key, null_keys=False)
    if not one_row_per_account:
        return kept
    attrs = [c for c in kept.columns if c != key]
    best = kept.groupBy(key).agg(F.min(F.struct(*attrs)).alias("_best"))
    return best.select(key, *[F.col(f"_best.{c}").alias(c) for c in attrs])


@dataclass(frozen=True)
class MarketParams:
    focus: str | dt.date = "today"
    city: str = "Washington D.C."
    include_metro: bool = True
    account_days: int = 3
    alert_days: int = 0
    metro_days: int = 30
    as_of: dt.date | None = None
    one_row_per_account: bool = False
    country: str = "US"
    partition_col: str | None = None  # event-date partition column, if any


def metro_cities(
    job_postings: DataFrame,
    pr: MarketPreset,
    start: dt.date,
    end: dt.date,
    country: str,
    partition_col: str | None = None,
) -> DataFrame:
    """Cities with job postings in the preset's metro area (Q3 step 2).

    A small grouped frame (one row per city and admin code), used as the
    build side of a semi-join; AQE broadcasts it when it is small.
    """
    posts = event_window(job_postings, start, end, partition_col=partition_col).where(
        (F.col("jobcountry") == country) & (F.col("jlmsa") == pr.jlmsa) & non_empty("jlcity")
    )
    return audience(posts, "jlcity", "jladmin1code")


def reference_market(
    tables: Mapping[str, DataFrame], p: MarketParams = MarketParams(), guard: RowGuard | None = None
) -> DataFrame:
    """Q3 over the reference's datasets; columns
    (accountId, City, State, emailAddress, lastName, firstName).

    ``guard`` watches the chosen sources and the result for rows, and the
    datasets' ids.
    """
    if not (0 <= p.account_days <= 30 and 0 <= p.alert_days <= 30):
        raise ValueError("account_days and alert_days must be within 0..30")
    if p.account_days == 0 and p.alert_days == 0:
        raise ValueError("no source selected: both the account and the alert window are 0")
    focus = resolve_date(p.focus, p.as_of)
    pr = preset(p.city, p.include_metro)
    key = "accountId"

    def watched(df: DataFrame, name: str) -> DataFrame:
        return guard.watch(df, name) if guard else df

    def win(name: str, column: str, lo: dt.date, hi: dt.date) -> DataFrame:
        df = event_window(tables[name], lo, hi, partition_col=p.partition_col)
        return guard.watch_ids(df, column, f"{name}.{column}") if guard else df

    cities = None
    if pr.ip_city is None:
        cities = metro_cities(
            tables["job_postings"], pr, days_before(focus, p.metro_days), focus, p.country,
            p.partition_col,
        )

    accounts = None
    if p.account_days > 0:
        lo, hi = window_bounds(days_before(focus, p.account_days), focus)
        signins = near_market(
            win("sign_ins", "accountId", lo, hi)
            .where(F.col("js_ip_country_code") == p.country)
            .select("ipcity", id_key("accountId").alias(key)),
            METRO_PRESETS, p.city, p.include_metro, "ipcity",
            metro_cities=cities, metro_key="jlcity", spread_by=key,
        ).select(key)
        created = win("new_accounts", "accountid", lo, hi).where(
            F.col("country") == p.country
        ).select(id_key("accountid").alias(key))
        accounts = intersect_sources(
            {
                "a": (watched(signins.where(F.col(key) != 0), "sign-in"), key),
                "b": (watched(created.where(F.col(key) != 0), "new account"), key),
            },
            key=key,
        )
        if p.alert_days == 0:
            accounts = with_literals(accounts, {"ipCity": p.city, "ipRegion": pr.state})

    alerts = None
    if p.alert_days > 0:
        lo, hi = window_bounds(days_before(focus, p.alert_days), focus)
        found = near_market(
            win("job_alerts", "accountId", lo, hi)
            .where(
                (F.col("country") == p.country.lower())
                & (F.col("ipCountry") == p.country)
                & non_empty("accountId")
            )
            .select(id_key("accountId").alias(key), "ipCity", "ipRegion"),
            METRO_PRESETS, p.city, p.include_metro, "ipCity", region_col="ipRegion",
            metro_cities=cities, metro_key="jlcity", spread_by=key,
        )
        alerts = audience(watched(found, "job alert"), key, "ipCity", "ipRegion")

    def attach(aud: DataFrame) -> DataFrame:
        return attach_profile(
            aud,
            key,
            primary=tables["email"],
            primary_key="id",
            primary_cols={"emailAddress": "emailAddress"},
            secondary=tables["account_names"],
            link=("id", "account_id"),
            secondary_cols={"lastName": "family_name", "firstName": "given_name"},
        )

    employers = employer_accounts(
        tables["advertiser_info"], key, "advertiser_id", source="accountId"
    )
    located = {"ipCity": "City", "ipRegion": "State"}
    out = market_audience(
        rename(alerts, located) if alerts is not None else None,
        rename(accounts, located) if accounts is not None and p.alert_days == 0 else accounts,
        attach,
        employers,
        defaults={"City": p.city, "State": pr.state},
        key=key,
        one_row_per_account=p.one_row_per_account,
    )
    out = out.select(key, "City", "State", "emailAddress", "lastName", "firstName")
    return watched(out, "market audience")

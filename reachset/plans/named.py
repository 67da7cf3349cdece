"""Named queries over the driver tables (FIXTURES §C).

Each query exercises one or more library operators on the TPC-H-style
tables and the ``events`` table, over the whole tables (a date window or a
filter is there only where it is the operator's own).  ``oracle_sql.SQL``
holds the equivalent DuckDB text for every query; column names agree one to
one.  The operator demos (``inner_audience``, ``anti_audience``, ...) use
the operator they are named after; the three plans use the cheapest
composition: audiences drawn from the one events table are flagged in a
single pass (``signal_flags``), dimension tables (region, nation) are
broadcast as bounded sets.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import date_text, days_before, window_bounds
from ..functions.predicates import (
    all_of,
    any_of,
    any_value_in,
    id_key,
    is_multivalued,
    keyword_any,
    matches,
    non_empty,
    none_value_is,
    not_equal,
    positive_id,
    same_code,
    two_letter_code,
)
from ..operators.algebra import (
    Link,
    audience,
    audience_by_token,
    checked_broadcast,
    combine,
    distinct_count,
    exclude,
    in_all,
    in_any,
    restrict_to,
    semi_chain,
    signal_flags,
)
from ..operators.bitmap_counts import count_bitmaps, group_bitmaps, merge_bitmaps, number_keys
from ..operators.chains import SharedLink, shared_chains
from ..operators.day_windows import day_counts, move_window, read_days, window_counts, write_days
from ..operators.membership import semi_join_filtered
from ..operators.phrase_join import keyword_hits, phrase_table
from ..operators.shape import (
    cast_key,
    dedupe,
    drop_incomplete,
    fill_defaults,
    rename,
    with_literals,
)
from ..session import cut_lineage, shared_dir
from ..sources.events import event_window, intersect_sources, union_sources, window_predicate
from ..sources.lookups import attach_profile, employer_accounts
from ..sources.sinks import (
    read_campaign_csv,
    read_campaign_json,
    write_campaign_csv,
    write_campaign_json,
)
from .all_markets import market_places, near_any_market
from .any_signal import TECH_KEYWORDS, any_signal_audience
from .market import market_audience
from .presets import MarketPreset, near_market
from .tables import DRIVER_SCHEMAS, table  # noqa: F401  the schemas are part of this module's interface
from .unconverted import with_company

Query = Callable[[SparkSession, str], DataFrame]


def _d(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def _events(spark, sf_dir, kind: str, start: str | None = None, end: str | None = None):
    ev = table(spark, sf_dir, "events")
    if start is not None:
        ev = event_window(ev, _d(start), _d(end))
    return ev.where(F.col("event_type") == kind)


# --------------------------------------------------------------------------
# sources
# --------------------------------------------------------------------------


def q_event_window(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return event_window(
        ev, dt.datetime(2024, 1, 10, 6), dt.datetime(2024, 1, 25, 18, 30)
    ).select("event_id", "user_id")


def q_union_sources(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("account_id"), F.col("event_type").alias("kind")
    )
    od = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("account_id"), F.col("o_orderstatus").alias("kind")
    )
    both = union_sources(
        {"events": ev, "orders": od},
        where=F.col("kind").isin("click", "F") & (F.col("account_id") > 0),
    )
    return audience(both, "account_id")


def q_intersect_sources(spark, sf_dir):
    signups = _events(spark, sf_dir, "signup", "2024-01-10", "2024-01-20").where(
        F.col("user_id") > 0
    )
    finished = table(spark, sf_dir, "orders").where(
        (F.col("o_orderstatus") == "F") & (F.col("o_custkey") > 0)
    )
    return intersect_sources(
        {"a": (signups, "user_id"), "b": (finished, "o_custkey")},
        key="account_id",
        min_counts={"a": 1, "b": 1},
    )


def q_profile_lookup(spark, sf_dir):
    keys = audience(
        _events(spark, sf_dir, "signup"), "account_id", source="user_id"
    )
    nation = table(spark, sf_dir, "nation")
    return attach_profile(
        keys,
        "account_id",
        primary=table(spark, sf_dir, "customer"),
        primary_key="c_custkey",
        primary_cols={"name": "c_name"},
        secondary=nation,
        link=("c_nationkey", "n_nationkey"),
        secondary_cols={"home": "n_name"},
        how="inner",
        secondary_bounded=True,  # nation: a fixed-size dimension
    )


def q_profile_linked(spark, sf_dir):
    """The general link: hot link values measured and salted, profiles without a link kept."""
    keys = audience(_events(spark, sf_dir, "signup"), "account_id", source="user_id")
    has_home = F.col("c_custkey") % 7 != 0
    customer = table(spark, sf_dir, "customer").withColumn("home_key", F.when(has_home, F.col("c_nationkey")))
    return attach_profile(
        keys,
        "account_id",
        primary=customer,
        primary_key="c_custkey",
        primary_cols={"name": "c_name"},
        secondary=table(spark, sf_dir, "nation"),
        link=("home_key", "n_nationkey"),
        secondary_cols={"home": "n_name"},
        measure_from=0,
    )


def q_scrub_accounts(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("account_id"))
    # a balance below 0 stands for "no advertiser id", so the flag rejects rows
    info = table(spark, sf_dir, "supplier").withColumn(
        "flag", F.when(F.col("s_acctbal") >= 0, F.col("s_acctbal"))
    )
    employers = employer_accounts(info, "account_id", "flag", source="s_suppkey")
    return exclude(customers, employers, "account_id")


# --------------------------------------------------------------------------
# predicates
# --------------------------------------------------------------------------


def q_filter_compare(spark, sf_dir):
    # sessions of some users have '' or no label, so every predicate rejects rows
    label = (
        F.when(F.col("user_id") % 5 == 0, "")
        .when(F.col("user_id") % 7 == 0, F.lit(None))
        .otherwise(F.col("event_type"))
    )
    ev = table(spark, sf_dir, "events").withColumn("label", label)
    return ev.where(
        all_of(
            non_empty("label"), not_equal("label", "view"), F.col("user_id") != 7,
            F.col("value") > 50,
        )
    ).select("event_id")


def q_not_equal_nulls(spark, sf_dir):
    """``!=`` on a scalar with nulls, and on a list field that may be missing."""
    parts = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.when(F.col("p_size") > 10, F.col("p_brand")).alias("brand"),
        F.when(F.col("p_size") > 20, F.split("p_name", " ")).alias("words"),
        F.split("p_name", " ")[0].alias("word"),
    )
    brands = ("Brand#11", "Brand#12")
    return parts.where(
        not_equal("brand", *brands)
        & none_value_is("words", "red")
        & none_value_is("word", "blue", scalar=not is_multivalued(parts, "word"))
    ).select("p_partkey")


def q_ids_as_text(spark, sf_dir):
    """Ids stored as text: blanks, words and overflow take no part."""
    orders = table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderkey") % 11 == 0, "abc")
        .when(F.col("o_orderkey") % 13 == 0, "")
        .when(F.col("o_orderkey") % 17 == 0, "99999999999999999999")
        .otherwise(F.col("o_custkey").cast("string"))
        .alias("account")
    )
    usable = orders.where(positive_id("account")).select(id_key("account").alias("account_id"))
    return audience(usable, "account_id", count="n")


def q_filter_in_list(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return c.where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).select("c_custkey")


def q_filter_boolean_mix(spark, sf_dir):
    ev = table(spark, sf_dir, "events").where(
        all_of(
            F.col("user_id") != 7,
            any_of(
                F.col("event_type").isin("view", "click"),
                (F.col("event_type") == "purchase") & (F.col("value") > 60),
            ),
            F.col("value") > 20,
        )
    )
    return audience(ev, "user_id")


def q_regex_full_match(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.where(matches("p_name", ".*widget|red ring|blue bol*.")).select("p_partkey")


NAME_KEYWORDS = ("widget", "Bolt", "RED", "red widget", "Blue  bolt", "blue bolt", "dget")


def q_keyword_any(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.where(keyword_any("p_name", ["widget", "bolt", "red"], mode="contains")).select(
        "p_partkey"
    )


def q_keyword_words(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.where(keyword_any("p_name", ["Widget", "bolt", "RED", "red"])).select("p_partkey")


def q_keyword_documents(spark, sf_dir):
    """The reference's own keyword list (whole words) over whole documents."""
    docs = table(spark, sf_dir, "documents")
    return docs.where(keyword_any("text", TECH_KEYWORDS)).select("doc_id")


def q_keyword_attribution(spark, sf_dir):
    """Each keyword with the parts whose name it hits."""
    return keyword_hits(
        table(spark, sf_dir, "part"), phrase_table(spark, NAME_KEYWORDS), "p_partkey", "p_name"
    )


def q_regex_prefix(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.where(matches("p_name", "blue.*")).select("p_partkey")


def q_multivalue_any(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.where(any_value_in(F.split("p_name", " "), ["red", "anvil"])).select("p_partkey")


def q_multivalue_group(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.split("p_name", " ").alias("tokens"))
    return audience_by_token(p, "tokens", alias="token", count="n")


# Presets over the driver tables: metro areas are regions, cities are nations,
# regions are market segments.
DRIVER_PRESETS = {
    ("Hub A", True): MarketPreset("Hub A", True, "ASIA", "HA", None, ("BUILDING", "MACHINERY")),
    ("Hub A", False): MarketPreset("Hub A", False, "ASIA", "HA", "NATION_2", ("BUILDING",)),
}


def _near_hub(spark, sf_dir, include_metro):
    t = lambda n: table(spark, sf_dir, n)
    pr = DRIVER_PRESETS["Hub A", include_metro]
    nation = t("nation").select("n_nationkey", "n_name", "n_regionkey")
    metro = restrict_to(
        nation, t("region").where(F.col("r_name") == pr.jlmsa), on="n_regionkey",
        keys_on="r_regionkey", bounded=True,
    )
    people = (
        t("customer").join(
            checked_broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey")
        ).select("c_custkey", "n_name", "c_mktsegment")
    )
    near = near_market(
        people, DRIVER_PRESETS, pr.city, include_metro, "n_name", region_col="c_mktsegment",
        metro_cities=metro, metro_key="n_name", spread_by="c_custkey",
    )
    return with_literals(near.select("c_custkey", "n_name"), {"state": pr.state})


def q_near_market_metro(spark, sf_dir):
    return _near_hub(spark, sf_dir, True)


def q_near_market_city(spark, sf_dir):
    return _near_hub(spark, sf_dir, False)


def q_all_markets(spark, sf_dir):
    """The hub's customers with and without its metro area, in one pass."""
    t = lambda n: table(spark, sf_dir, n)
    nation = t("nation").select("n_nationkey", "n_name", "n_regionkey")
    cities = nation.join(t("region"), F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("r_name").alias("jlmsa"), F.col("n_name").alias("place")
    )
    people = t("customer").join(checked_broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))
    return near_any_market(
        people.select("c_custkey", "n_name", "c_mktsegment"), market_places(spark, cities, DRIVER_PRESETS),
        "n_name", "c_mktsegment", spread_by="c_custkey", measure_from=0,
    ).select("market", "metro", "c_custkey", "n_name", "state")


def q_preset_filter(spark, sf_dir):
    pr = DRIVER_PRESETS["Hub A", False]
    region = table(spark, sf_dir, "region").where(F.col("r_name") == pr.jlmsa)
    # region and nation are dimensions of fixed size: their keys are broadcast
    nations = restrict_to(
        table(spark, sf_dir, "nation"), region, on="n_regionkey", keys_on="r_regionkey",
        bounded=True,
    )
    customers = restrict_to(
        table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"),
        nations,
        on="c_nationkey",
        keys_on="n_nationkey",
        bounded=True,
    )
    return with_literals(customers.select("c_custkey"), {"city": pr.ip_city})


# --------------------------------------------------------------------------
# joins and set operations
# --------------------------------------------------------------------------


def q_semi_chain(spark, sf_dir):
    t = lambda n: table(spark, sf_dir, n)
    return semi_chain(
        [
            # region and nation are dimensions: their key sets are bounded
            Link(t("region").where(F.col("r_name") == "ASIA"), key="r_regionkey", bounded=True),
            Link(t("nation"), key="n_nationkey", on="n_regionkey", bounded=True),
            Link(
                t("customer").where(F.col("c_mktsegment") == "BUILDING"),
                key="c_custkey",
                on="c_nationkey",
            ),
            Link(
                t("orders").where(
                    (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT")
                ),
                key="o_orderkey",
                on="o_custkey",
            ),
            Link(
                t("lineitem").where(
                    (F.col("l_returnflag") != "R") & (F.col("l_quantity") > 40)
                ),
                key="l_suppkey",
                on="l_orderkey",
            ),
        ]
    )


def q_semi_keys(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").where(
        (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT")
    )
    customers = table(spark, sf_dir, "customer").select("c_name", "c_custkey")
    return dedupe(restrict_to(customers, orders, on="c_custkey", keys_on="o_custkey"))


def q_filtered_semi_keys(spark, sf_dir):
    """Lines of urgent open orders: a membership filter thins them before the exact join."""
    urgent = table(spark, sf_dir, "orders").where(
        (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "O")
    )
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_suppkey")
    return semi_join_filtered(lines, urgent, "o_orderkey")


def q_inner_audience(spark, sf_dir):
    views = audience(_events(spark, sf_dir, "view"), "account_id", source="user_id")
    clicks = audience(_events(spark, sf_dir, "click"), "account_id", source="user_id")
    return in_all([views, clicks], "account_id")


def q_full_attributes(spark, sf_dir):
    clicks = audience(
        _events(spark, sf_dir, "click"), "account_id", source="user_id", count="n_click"
    )
    signups = audience(
        _events(spark, sf_dir, "signup"), "account_id", source="user_id", count="n_signup"
    )
    return combine(clicks, signups, "account_id", how="full")


def q_union_audiences(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    od = table(spark, sf_dir, "orders")
    cu = table(spark, sf_dir, "customer")
    key = "account_id"
    return in_any(
        [
            ev.where((F.col("event_type") == "click") & (F.col("value") > 60)).select(
                F.col("user_id").alias(key)
            ),
            od.where(F.col("o_orderpriority") == "1-URGENT").select(F.col("o_custkey").alias(key)),
            cu.where(F.col("c_mktsegment") == "BUILDING").select(F.col("c_custkey").alias(key)),
        ],
        key,
    )


def q_anti_audience(spark, sf_dir):
    views = audience(_events(spark, sf_dir, "view"), "account_id", source="user_id")
    buyers = _events(spark, sf_dir, "purchase").where(F.col("value") > 60)
    return exclude(views, buyers, "account_id", other_key="user_id")


# --------------------------------------------------------------------------
# aggregations, nulls, shaping, dates
# --------------------------------------------------------------------------


def q_distinct_keys(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return audience(ev, "account_id", source="user_id", count="n")


def q_group_multi_key(spark, sf_dir):
    od = table(spark, sf_dir, "orders")
    return audience(od, "o_custkey", "o_orderstatus", "o_orderpriority", count="n")


def q_distinct_count(spark, sf_dir):
    return distinct_count(table(spark, sf_dir, "events"), "event_type", "user_id", "accounts")


def q_distinct_bitmaps(spark, sf_dir):
    """Distinct users per event type and of all, merged from bitmaps per day and type."""
    ev = table(spark, sf_dir, "events").select(F.to_date("ts").alias("day"), "event_type", "user_id")
    ids = number_keys(ev, "user_id")
    daily = cut_lineage(group_bitmaps(ev, ["day", "event_type"], "user_id", ids))
    by_type = count_bitmaps(merge_bitmaps(daily, ["event_type"]), ["event_type"], "users")
    total = count_bitmaps(merge_bitmaps(daily, []).withColumn("event_type", F.lit("all")), ["event_type"], "users")
    return by_type.unionByName(total)


def q_moved_window(spark, sf_dir):
    """Events per user in a window moved by a day: its state and two days are read."""
    old, new = (_d("2024-01-05"), _d("2024-01-25")), (_d("2024-01-06"), _d("2024-01-26"))
    path = shared_dir(spark, "day-counts")
    write_days(day_counts(table(spark, sf_dir, "events"), "user_id"), path)
    state = window_counts(read_days(spark, path, [old], "bigint", "user_id"), "user_id")
    return move_window(state, path, "user_id", old, new)


def _nation_names(spark, sf_dir, cond):
    nation = table(spark, sf_dir, "nation").where(cond)
    return (
        table(spark, sf_dir, "customer")
        # 25 nations at most: a dimension of fixed size
        .join(checked_broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"), "inner")
        .select("c_custkey", "n_name")
    )


def q_drop_incomplete(spark, sf_dir):
    accounts = audience(table(spark, sf_dir, "events"), "account_id", source="user_id")
    names = _nation_names(spark, sf_dir, F.col("n_regionkey") < 2).select(
        F.col("c_custkey").alias("account_id"), F.col("n_name").alias("city")
    )
    return dedupe(drop_incomplete(combine(accounts, names, "account_id", how="left")))


def q_fill_defaults(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("account_id"), "c_nationkey"
    )
    nation = table(spark, sf_dir, "nation").where(F.col("n_regionkey") == 2)
    joined = customers.join(
        checked_broadcast(nation), customers["c_nationkey"] == nation["n_nationkey"], "left"
    ).select("account_id", F.col("n_name").alias("city"))
    return fill_defaults(joined, {"city": "Hub A"})


def q_shape_output(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    shaped = cast_key(rename(c, {"c_name": "company"}), "c_custkey", "accountId")
    return dedupe(with_literals(shaped, {"firstName": ""}))


def q_date_offset(spark, sf_dir):
    focus = _d("1998-12-01")
    lo, hi = window_bounds(days_before(focus, 30), "0d", as_of=focus)
    od = event_window(table(spark, sf_dir, "orders"), lo, hi, ts="o_orderdate")
    return od.select("o_orderkey")


def q_code_filter(spark, sf_dir):
    # some codes are padded, some too long, some in capitals
    code = (
        F.when(F.col("doc_id") % 5 == 0, F.concat(F.lit(" "), F.col("lang"), F.lit(" ")))
        .when(F.col("doc_id") % 7 == 0, F.concat(F.col("lang"), F.lit("a")))
        .when(F.col("doc_id") % 3 == 0, F.upper("lang"))
        .otherwise(F.col("lang"))
    )
    docs = table(spark, sf_dir, "documents").select("doc_id", code.alias("code"))
    two = docs.where(two_letter_code("code"))
    return two.where(any_of(same_code("code", "fr"), same_code("code", "de", case="upper"))).select(
        "doc_id", F.upper(F.trim("code")).alias("lang")
    )


def q_date_text(spark, sf_dir):
    od = table(spark, sf_dir, "orders")
    return od.select("o_orderkey", date_text("o_orderdate").alias("day"))


# --------------------------------------------------------------------------
# the three plans on driver tables
# --------------------------------------------------------------------------


def q_unconverted_audience(spark, sf_dir):
    # All three audiences come from the one events table: scan it once over
    # the union of their windows and flag, per user, which signals occurred
    # (one scan, one grouping) instead of three scans, groupings and joins.
    key = "user_id"
    ev = event_window(table(spark, sf_dir, "events"), _d("2024-01-15"), _d("2024-01-31"))
    kind = F.col("event_type")
    flags = signal_flags(
        ev.where(kind.isin("view", "click", "purchase")),
        key,
        {
            "base": kind == "view",
            "optimized": kind == "click",
            "spent": (kind == "purchase")
            & window_predicate(ev, _d("2024-01-28"), _d("2024-01-30"), "ts"),
        },
    )
    raw = flags.where(F.col("base") & F.col("optimized") & ~F.col("spent")).select(key)
    companies = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias(key), F.col("c_name").alias("company")
    )
    return with_company(raw, companies, key=key)


def q_unconverted_chain(spark, sf_dir):
    """Q1 in its own shape: two nested chains and the base over shared levels, then company.

    Orders and lineitem are read once each: the base begins at lineitem, one
    chain at orders, the other at customer.
    """
    t = lambda n: table(spark, sf_dir, n)
    key = "l_suppkey"
    flags = shared_chains(
        [
            SharedLink(t("customer").where(F.col("c_mktsegment") == "BUILDING"), {"spent": "c_custkey"}),
            SharedLink(
                t("orders").where(F.col("o_orderstatus") == "F"),
                {"optimized": "o_orderkey", "spent": "o_orderkey"},
                on="o_custkey",
                where={"spent": F.col("o_orderpriority") == "1-URGENT"},
            ),
            SharedLink(
                t("lineitem"),
                {"base": key, "optimized": key, "spent": key},
                on="l_orderkey",
                where={
                    "base": not_equal("l_returnflag", "R"),
                    "optimized": F.col("l_discount") >= 0.1,
                    "spent": F.col("l_quantity") > 49,
                },
            ),
        ]
    ).flags(key)
    raw = flags.where(F.col("base") & F.col("optimized") & ~F.col("spent")).select(key)
    companies = t("supplier").select(F.col("s_suppkey").alias(key), F.col("s_name").alias("company"))
    return with_company(raw, companies, key=key)


def q_any_signal_audience(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    od = table(spark, sf_dir, "orders")
    cu = table(spark, sf_dir, "customer")
    k = "accountId"
    kind = F.col("event_type")
    signals = [
        # the two event signals share one scan of the events table
        ev.where(
            any_of((kind == "click") & (F.col("value") > 20), kind == "view")
            & (F.col("user_id") > 0)
        ).select(F.col("user_id").alias(k)),
        od.where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") & (F.col("o_custkey") > 0))
        .select(F.col("o_custkey").alias(k)),
        cu.where((F.col("c_mktsegment") == "BUILDING") & (F.col("c_custkey") > 0)).select(
            F.col("c_custkey").alias(k)
        ),
    ]
    new_accounts = audience(_events(spark, sf_dir, "signup", "2024-01-28", "2024-01-30"), k, source="user_id")
    return any_signal_audience(signals, new_accounts, key=k)


def q_market_audience(spark, sf_dir):
    key = "accountId"
    t = lambda n: table(spark, sf_dir, n)
    region = t("region").where(F.col("r_name") == "ASIA")
    metro = restrict_to(
        t("nation").select("n_nationkey", "n_name", "n_regionkey"),
        region,
        on="n_regionkey",
        keys_on="r_regionkey",
        bounded=True,
    )
    buyers = audience(
        t("orders").where(F.col("o_orderpriority") == "1-URGENT"), key, source="o_custkey"
    )
    located = (
        buyers.join(t("customer").select(F.col("c_custkey").alias(key), "c_nationkey"), key)
        # the metro's nations: a subset of a fixed-size dimension
        .join(checked_broadcast(metro), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(key, F.col("n_name").alias("City"))
    )
    alerts = audience(located, key, "City")
    accounts = audience(_events(spark, sf_dir, "signup", "2024-01-20", "2024-01-31"), key, source="user_id")
    def attach(aud):
        return attach_profile(
            aud, key, primary=t("customer"), primary_key="c_custkey", primary_cols={"firstName": "c_name"}
        )

    employers = employer_accounts(
        t("supplier"), key, F.col("s_acctbal") > 5000, source="s_suppkey"
    )
    return market_audience(alerts, accounts, attach, employers, defaults={"City": "Hub A"}, key=key)


# --------------------------------------------------------------------------
# sinks: write, read back with an explicit schema
# --------------------------------------------------------------------------


def _awkward_names(spark, sf_dir):
    """Every customer, some with '', null, quotes, line breaks or outer blanks."""
    k = F.col("c_custkey")
    name = (
        F.when(k % 11 == 0, "")
        .when(k % 13 == 0, F.lit(None))
        .when(k % 17 == 0, F.concat(F.lit('say "hi" \\ '), F.col("c_name")))
        .when(k % 19 == 0, F.concat(F.col("c_name"), F.lit("\nline two")))
        .when(k % 23 == 0, F.concat(F.lit("  "), F.col("c_name"), F.lit(", x ")))
        .otherwise(F.col("c_name"))
    )
    return table(spark, sf_dir, "customer").select(
        k.alias("accountId"), name.alias("firstName"), F.col("c_mktsegment").alias("City")
    )


# One output folder for each session and sink, written anew by each call.
_SCRATCH: dict[tuple[int, str], str] = {}


def _scratch(spark, name):
    memo = (id(spark), name)
    if memo not in _SCRATCH:
        _SCRATCH[memo] = shared_dir(spark, name)
    return _SCRATCH[memo]


def q_json_roundtrip(spark, sf_dir):
    path = _scratch(spark, "json-roundtrip")
    write_campaign_json(_awkward_names(spark, sf_dir).drop("City"), path, mode="overwrite")
    return read_campaign_json(spark, path, "accountId bigint, firstName string")


def q_csv_roundtrip(spark, sf_dir):
    path = _scratch(spark, "csv-roundtrip")
    write_campaign_csv(_awkward_names(spark, sf_dir), path, mode="overwrite")
    return read_campaign_csv(spark, path, "accountId bigint, firstName string, City string")


QUERIES: dict[str, Query] = {
    "event_window": q_event_window,
    "union_sources": q_union_sources,
    "intersect_sources": q_intersect_sources,
    "profile_lookup": q_profile_lookup,
    "profile_linked": q_profile_linked,
    "scrub_accounts": q_scrub_accounts,
    "filter_compare": q_filter_compare,
    "not_equal_nulls": q_not_equal_nulls,
    "ids_as_text": q_ids_as_text,
    "filter_in_list": q_filter_in_list,
    "filter_boolean_mix": q_filter_boolean_mix,
    "regex_full_match": q_regex_full_match,
    "keyword_any": q_keyword_any,
    "keyword_words": q_keyword_words,
    "keyword_documents": q_keyword_documents,
    "keyword_attribution": q_keyword_attribution,
    "regex_prefix": q_regex_prefix,
    "multivalue_any": q_multivalue_any,
    "multivalue_group": q_multivalue_group,
    "preset_filter": q_preset_filter,
    "near_market_metro": q_near_market_metro,
    "near_market_city": q_near_market_city,
    "all_markets": q_all_markets,
    "semi_chain": q_semi_chain,
    "semi_keys": q_semi_keys,
    "filtered_semi_keys": q_filtered_semi_keys,
    "inner_audience": q_inner_audience,
    "full_attributes": q_full_attributes,
    "union_audiences": q_union_audiences,
    "anti_audience": q_anti_audience,
    "distinct_keys": q_distinct_keys,
    "group_multi_key": q_group_multi_key,
    "distinct_count": q_distinct_count,
    "distinct_bitmaps": q_distinct_bitmaps,
    "moved_window": q_moved_window,
    "drop_incomplete": q_drop_incomplete,
    "fill_defaults": q_fill_defaults,
    "shape_output": q_shape_output,
    "date_offset": q_date_offset,
    "unconverted_audience": q_unconverted_audience,
    "unconverted_chain": q_unconverted_chain,
    "any_signal_audience": q_any_signal_audience,
    "market_audience": q_market_audience,
    "code_filter": q_code_filter,
    "date_text": q_date_text,
    "json_roundtrip": q_json_roundtrip,
    "csv_roundtrip": q_csv_roundtrip,
}

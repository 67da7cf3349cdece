"""Q2 -- accounts with any tech-interest signal, minus new accounts
(SURVEY §2.11 Q2, §3.2).

``any_signal_audience`` is the algebra (one union + one anti-join);
``reference_any_signal`` builds the six inputs from the reference's event
datasets (FIXTURES §A).  The signals are independent scans in one plan, so
they run in parallel stages instead of one round trip after another.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import window_bounds
from ..functions.predicates import (
    any_value_in,
    check_code,
    id_key,
    is_multivalued,
    keyword_any,
    none_value_is,
    not_equal,
    positive_id,
)
from ..operators.algebra import audience, exclude, in_any
from ..operators.shape import RowGuard, cast_key, drop_incomplete, with_literals
from ..sources.events import event_window, union_sources

# The reference's keyword list, in its order and spelling
# (accented letters decomposed, four entries with the leading blanks of
# the continuation lines they stood on; ``desenvolvedor front-end`` twice).
TECH_KEYWORDS = (
    'tecnologia',
    'tech',
    'software',
    'ciencia da computacao',
    'programador',
    'analista de suporte',
    'tecnico de informatica',
    'desenvolvedor',
    'ti',
    '            analista de desenvolvimento',
    'sistemas',
    'analista de bi',
    'analista de inteligência de mercado',
    'analista de sistemas júnior',
    '            analista de sistemas sênior',
    'business intelligence',
    'desenvolvedor front-end',
    '            analista de teste',
    'webmaster',
    'back end developer',
    'desenvolvedor.net',
    'desenvolvedor back-end',
    'senior back end developer',
    '            java',
    'desenvolvedor mobile',
    'desenvolvedor android',
    'desenvolvedor ios 3',
    'desenvolvedor front-end',
    'desenvolvedor c#',
    'flutter',
)

# The reference's job-title categories and skill ids.
TECH_TITLE_CATEGORIES = ("techsoftware", "tech", "techhelp", "techinfo")
TECH_SKILL_IDS = (
    "4aa53570-9248-46ab-b3b5-f503a756ca8e", "54ffd971-5469-407c-9b2c-689dff41620b",
    "5563e45b-1958-48ce-a222-208f86aa25b2", "5695c5e3-fea8-425f-b033-f972a08a3275",
    "57888570-9814-4caf-91f4-c84e2c7e3507", "58025ea9-47da-4959-9ba2-90118c84b4a1",
    "58957b5b-a0f0-4eaa-ad23-afcc6f19a9bf", "63893905-7171-4a6f-8ecf-df95f7bca284",
    "6b7f7d6c-1a66-4a87-b0af-d7967ffca146", "6f8392d4-a4d9-4039-bd0f-fffa67f8a197",
    "6eff2485-087f-4b30-8ce0-11e0b859d381", "700bacc6-4436-47cb-bca4-a8a3ba3b3141",
    "71aa5bc6-e90e-41b4-bfa9-7ab63e65a5bd", "735f46d7-93f5-41d6-a31b-def8573d3d42",
    "769f0837-8e1c-44b6-99be-4a9cdda930f1", "7a73a84b-207c-4109-9c1e-925e331c4afb",
    "9772f699-4d4e-4028-b377-31476be1e671", "9c6c3058-92d6-459d-ac7c-34f3de3bc903",
    "a091e3cc-93ae-4246-a91c-0520d2c7f4f9", "a5d8de53-bf16-4aff-aef3-503a2b764334",
    "b66ed846-98f0-4f75-ade8-ef21f5531648", "d50db9a9-326b-47df-847e-d5fb8b12ea1a",
    "d467eb6c-dc7d-41f8-bd02-ca8de2744512", "d57ef302-293f-4405-8fb8-c0ff4e8eb44a",
    "d6d98cd3-7087-4148-a4bb-6f6e606fa2c9", "d78872e4-2c6b-457d-af90-7c77309c2de0",
    "f0641ea8-e055-48ed-9e56-1bb9e6dd0132", "eecb57f8-39ad-4b5e-9e5f-1c88b88638ef",
)


def reference_pattern(keywords: Sequence[str] = TECH_KEYWORDS) -> str:
    """The reference's regular expression exactly as it is assembled."""
    return ".*" + "|".join(keywords) + "*."


def any_signal_audience(
    signals: Sequence[DataFrame],
    new_accounts: DataFrame,
    key: str = "accountId",
    first_name: str = "",
) -> DataFrame:
    """Union of the signal key sets, minus new accounts, shaped for mail.

    Each signal is a frame with column ``key`` (duplicates allowed).  The
    union is grouped once (one shuffle); the anti-join's right side is
    grouped too.  Keys are already distinct afterwards and the int32
    narrowing is exact or fails, so no further de-duplication is needed.
    """
    raw = in_any(signals, key)
    kept = exclude(raw, new_accounts, key, null_keys=False)
    # null checks come before the int32 narrowing: Catalyst pushes filters
    # down, and a filter holding the narrowing would test rows the
    # exclusion is about to drop (failing on an excluded out-of-range id)
    if first_name is None:
        raise ValueError("first_name must not be null: every row would be incomplete")
    return with_literals(cast_key(drop_incomplete(kept), key), {"firstName": first_name})


@dataclass(frozen=True)
class AnySignalParams:
    start: str | dt.date = "1y"
    focus: str | dt.date = "0d"
    as_of: dt.date | None = None
    country: str = "BR"
    language: str = "pt"
    new_account_start: str | dt.date = "14d"
    new_account_end: str | dt.date = "0d"
    new_account_lang: str = "pt_BR"
    keywords: tuple[str, ...] = TECH_KEYWORDS
    keyword_mode: str = "words"
    title_categories: tuple[str, ...] = TECH_TITLE_CATEGORIES
    skill_ids: tuple[str, ...] = TECH_SKILL_IDS
    excluded_groups: tuple[str, ...] = ("privileged", "spider")
    search_rcv: str = "jsv"
    probe_agent: str = "catchpoint"
    partition_col: str | None = None  # event-date partition column, if any


def _kw(col: str, p: AnySignalParams) -> Column:
    if p.keyword_mode == "pattern":
        return keyword_any(col, reference_pattern(p.keywords), mode="pattern")
    return keyword_any(col, p.keywords, mode=p.keyword_mode)


def reference_signals(
    tables: Mapping[str, DataFrame],
    p: AnySignalParams = AnySignalParams(),
    guard: RowGuard | None = None,
) -> tuple[list[DataFrame], DataFrame]:
    """The five signal frames and the new-account frame, keyed ``accountId``.

    Equality predicates come first in every filter: they are pushed into
    the Parquet reader and skip row groups before the keyword regex runs.
    """
    country = check_code("country", p.country)
    language = check_code("language", p.language)
    up_country, lo_country, lo_lang = country.upper(), country.lower(), language.lower()
    lo, hi = window_bounds(p.start, p.focus, p.as_of)

    def seen(df: DataFrame, name: str, key: str) -> DataFrame:
        return guard.watch_ids(df, key, f"{name}.{key}") if guard else df

    def win(name: str, key: str) -> DataFrame:
        return seen(event_window(tables[name], lo, hi, partition_col=p.partition_col), name, key)

    grp_ok = not_equal("grp", *p.excluded_groups)

    click = win("clicks", "account_id").where(
        (F.col("job_country_code") == up_country)
        & (F.col("joblanguage") == lo_lang)
        & not_equal("format", "unknown")
        & positive_id("account_id")
        & _kw("query", p)
    )
    search = union_sources(
        {name: win(name, "account_id") for name in ("mobile_searches", "searches")},
        where=grp_ok
        & (F.col("page") == 1)
        & (F.col("rcv") == p.search_rcv)
        & not_equal("useragent", p.probe_agent)
        & (F.col("country") == lo_country)
        & (F.col("lang") == lo_lang)
        & positive_id("account_id")
        & _kw("qnorm", p),
    )
    created, seekers = win("job_alerts", "accountId"), win("profiles", "accountId")
    scalar = lambda df, c: not is_multivalued(df, c)
    alerts = created.where(
        none_value_is("creationGroups", "privileged", scalar(created, "creationGroups"))
        & (F.col("alert_country_code") == lo_country)
        & (F.col("lang") == lo_lang)
        & positive_id("accountId")
        & _kw("q", p)
    )
    views = win("job_views", "account_id").where(
        grp_ok
        & (F.col("rcv") == p.search_rcv)
        & (F.col("site_country_code") == lo_country)
        & (F.col("lang") == lo_lang)
        & F.col("job_title_category").isin(*p.title_categories)
        & positive_id("account_id")
    )
    profiles = seekers.where(
        none_value_is("grps", "privileged", scalar(seekers, "grps"))
        & (F.col("country") == up_country)
        & any_value_in("extractedSkills", p.skill_ids, scalar(seekers, "extractedSkills"))
        & positive_id("accountId")
    )
    key = "accountId"
    signals = [
        click.select(id_key("account_id").alias(key)),
        search.select(id_key("account_id").alias(key)),
        alerts.select(id_key("accountId").alias(key)),
        views.select(id_key("account_id").alias(key)),
        profiles.select(id_key("accountId").alias(key)),
    ]
    opened = event_window(
        tables["new_accounts"], p.new_account_start, p.new_account_end, as_of=p.as_of,
        partition_col=p.partition_col,
    )
    new_accounts = audience(
        seen(opened, "new_accounts", "accountid")
        .where((F.col("lang") == p.new_account_lang) & positive_id("accountid"))
        .select(id_key("accountid").alias(key)),
        key,
    )
    return signals, new_accounts


def reference_any_signal(
    tables: Mapping[str, DataFrame],
    p: AnySignalParams = AnySignalParams(),
    guard: RowGuard | None = None,
) -> DataFrame:
    """Q2 over the reference's datasets."""
    signals, new_accounts = reference_signals(tables, p, guard)
    if guard:
        names = ("click", "search", "job alert", "view", "profile")
        signals = [guard.watch(part, name) for name, part in zip(names, signals)]
        new_accounts = guard.watch(new_accounts, "new account")
    return any_signal_audience(signals, new_accounts)

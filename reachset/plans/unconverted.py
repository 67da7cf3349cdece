"""Q1 -- mailed and optimized, but did not spend; with company name
(SURVEY §2.11 Q1, §3.1).

``unconverted_audience`` is the algebra; ``reference_unconverted`` builds
its three inputs from the reference's event datasets (FIXTURES §A).
Everything is one lazy plan; the only actions are the caller's write, and one
small job per chain level from ``measure_from`` bytes on (``cut_lineage`` adds
the job that writes the shared levels).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import window_bounds
from ..functions.predicates import (
    all_of,
    any_of,
    any_value_in,
    is_multivalued,
    matches,
    non_empty,
    not_equal,
)
from ..operators.algebra import (
    MEASURE_FROM,
    Link,
    audience,
    exclude,
    in_all,
    restrict_to,
    semi_chain,
)
from ..operators.chains import SharedLink, shared_chains
from ..operators.shape import RowGuard, cast_key, drop_incomplete
from ..sources.events import event_window


def unconverted_audience(
    base: DataFrame,
    optimized: DataFrame,
    spent: DataFrame,
    companies: DataFrame,
    key: str = "advertiser_id",
    company: str = "company",
    out_key: str = "advertiserId",
    optimized_mode: str = "in",
) -> DataFrame:
    """(base ∩ optimized) − spent, with company; key narrowed to int32.

    ``optimized_mode="in"`` is the reference's audience 1 (optimized, did
    not spend); ``"not_in"`` is its audience 2 (neither), the same algebra
    with an exclusion in place of the intersection.
    """
    if optimized_mode == "in":
        kept = in_all([base, optimized], key)
    elif optimized_mode == "not_in":
        kept = exclude(audience(base, key), optimized, key, null_keys=False)
    else:
        raise ValueError(f"optimized_mode must be 'in' or 'not_in', not {optimized_mode!r}")
    return with_company(exclude(kept, spent, key, null_keys=False), companies, key, company, out_key)


def with_company(
    raw: DataFrame,
    companies: DataFrame,
    key: str = "advertiser_id",
    company: str = "company",
    out_key: str = "advertiserId",
) -> DataFrame:
    """Attach company names to an audience of distinct keys; narrow the key.

    ``companies`` holds (key, company) rows; it is restricted to the
    audience's keys by a semi-join (the reference's second round trip with
    a pasted id list) and grouped, which yields its ``GROUP BY company,
    advertiser_id`` answer.  The reference then outer-merges that answer
    with the audience and drops rows with nulls; since the answer only
    holds audience keys and the audience keys are distinct, that is the
    answer itself -- no second join is needed.
    """
    # One advertiser may own a third of all job rows: group to distinct
    # (advertiser, company) pairs first -- a handful per advertiser -- and
    # restrict those.  (Catalyst moves the semi-join below the grouping only
    # when the audience can be broadcast, i.e. when no shuffle is at risk.)
    names = restrict_to(audience(companies, key, company), raw, on=key)
    # drop incomplete rows before narrowing the key, so that the narrowing
    # never lands in a filter Catalyst pushes below the joins
    return cast_key(drop_incomplete(names), key, out_key)


@dataclass(frozen=True)
class UnconvertedParams:
    """Campaign constants have no defaults: they name one company's data."""

    client_name: str
    campaign: str
    excluded_advertiser: int
    eligibility_group: str
    start: str | dt.date = "20d"
    focus: str | dt.date = "12d"
    mail_start: str | dt.date = "2d"
    mail_focus: str | dt.date = "1d"
    company_start: str | dt.date = "15d"
    company_end: str | dt.date = "0d"
    as_of: dt.date | None = None
    eligibility_event: str = "NEW"
    update_action: str = "UPDATE"
    sponsor_sheet: str = "sponsor.*"
    open_levels: tuple[str, ...] = ("organic", "jobalert")
    sponsored_level: str = "sponsored"
    sponsored_state: str = "spon_active"
    optimized_mode: str = "in"
    partition_col: str | None = None  # event-date partition column, if any
    cut_lineage: bool = False  # write the levels that both chains share
    measure_from: int | None = MEASURE_FROM  # chain levels from this size on are measured for skew


def reference_unconverted(
    tables: Mapping[str, DataFrame], p: UnconvertedParams, guard: RowGuard | None = None
) -> DataFrame:
    """Q1 over the reference's datasets (names and columns as FIXTURES §A)."""
    lo, hi = window_bounds(p.start, p.focus, p.as_of)

    def win(name: str) -> DataFrame:
        return event_window(tables[name], lo, hi, partition_col=p.partition_col)

    base = audience(
        event_window(
            tables["mailings"], p.mail_start, p.mail_focus, as_of=p.as_of,
            partition_col=p.partition_col,
        ).where(
            (F.col("clientName") == p.client_name) & (F.col("campaign") == p.campaign)
        ),
        "advertiser_id",
    )

    excl = p.excluded_advertiser
    # Both chains follow the same datasets up to the job changes, which are read
    # once: the sheet filter and what is handed on there are the chains' own.
    eligibility = win("eligibility")
    one_group = not is_multivalued(eligibility, "tokenizedGroups")
    both = lambda column: {"optimized": column, "spent": column}
    shared = shared_chains(
        [
            SharedLink(
                eligibility.where(
                    any_value_in("tokenizedGroups", [p.eligibility_group], scalar=one_group)
                    & (F.col("event") == p.eligibility_event)
                ),
                both("advertiserId"),
            ),
            SharedLink(
                win("claimed_jobs").where(
                    (F.col("success") == 1)
                    & not_equal("advertiserId", excl)
                    & non_empty("claimedAggJobId")
                ),
                both("newJobHash"),
                on="advertiserId",
            ),
            SharedLink(
                win("new_jobs").where(
                    not_equal("advertiser_id", excl) & (F.col("jobagedays") == 0)
                ),
                both("job_hash"),
                on="job_hash",
            ),
            SharedLink(
                win("job_wizard").where(F.col("edit") == 1),
                both("jobhash"),
                on="jobhash",
                where={"spent": matches("tosheet", p.sponsor_sheet)},
            ),
            SharedLink(
                win("job_changes").where(
                    (F.col("action") == p.update_action) & not_equal("advertiser_id", excl)
                ),
                {"optimized": "advertiser_id", "spent": "job_hash"},
                on="job_hash",
            ),
        ],
        measure_from=p.measure_from,
        cut=p.cut_lineage,
    )
    optimized = shared.of("optimized", "advertiser_id")
    spent = semi_chain(
        [
            Link(shared.of("spent", "job_hash"), key="job_hash"),
            Link(
                win("job_details").where(
                    (F.col("is_sponsor_all") == 0) & (F.col("daily_total_revenue_cents") > 0)
                ),
                key="agg_job_id_tokenized",
                on="job_hash",
            ),
            Link(
                win("job_postings").where(
                    all_of(
                        not_equal("dupeStatus", 1),
                        any_of(
                            F.col("job_visibility_level").isin(*p.open_levels),
                            (F.col("job_visibility_level") == p.sponsored_level)
                            & (F.col("sponVisibility") == p.sponsored_state),
                        ),
                    )
                ),
                key="claimed_advertiser_id",
                on="agg_job_id",
            ),
        ],
        out="advertiser_id",
        measure_from=p.measure_from,
    )

    companies = event_window(
        tables["job_details"], p.company_start, p.company_end, as_of=p.as_of,
        partition_col=p.partition_col,
    ).select("advertiser_id", "company")
    if guard:
        base = guard.watch(base, "mailed")
        optimized, spent = guard.watch(optimized, "optimized"), guard.watch(spent, "spent")
    out = unconverted_audience(base, optimized, spent, companies, optimized_mode=p.optimized_mode)
    return guard.watch(out, "companies") if guard else out

"""reachset -- audience building on Spark DataFrames.

Event datasets are scanned over date windows and filtered; key sets are
combined by semi-join chains, union, intersection and exclusion; the
resulting audiences get attributes attached, are cleaned and written as
campaign-ready JSON or CSV.  Every operator takes and returns DataFrames;
nothing is collected to the driver.
"""

from .functions.dates import date_text, days_before, resolve_date, window_bounds  # noqa: F401
from .functions.predicates import (  # noqa: F401
    all_of,
    any_of,
    any_value_in,
    keyword_any,
    matches,
    non_empty,
    none_value_is,
    positive_id,
    same_code,
    two_letter_code,
)
from .operators.algebra import (  # noqa: F401
    Link,
    audience,
    audience_by_token,
    combine,
    distinct_count,
    exclude,
    in_all,
    in_any,
    restrict_to,
    semi_chain,
    semi_join_spread,
)
from .operators.shape import (  # noqa: F401
    cast_key,
    dedupe,
    drop_incomplete,
    fill_defaults,
    rename,
    require_rows,
    with_literals,
)
from .session import build_session, cut_lineage, shared_dir  # noqa: F401
from .sources.events import event_window, intersect_sources, read_dataset, union_sources  # noqa: F401
from .sources.lookups import attach_profile, employer_accounts  # noqa: F401
from .sources.sinks import write_campaign_csv, write_campaign_json  # noqa: F401

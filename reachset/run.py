"""Run one of the three audience plans from the command line.

    python -m reachset.run unconverted --data DIR --out PATH --client NAME --campaign NAME ...
    python -m reachset.run any_signal  --data DIR --out PATH --country BR --language pt ...
    python -m reachset.run market      --data DIR --out PATH --city Chicago --metro --format csv ...

``DIR/<dataset>`` holds each dataset (Parquet, any number of files; a
date-partitioned layout is pruned with ``--partition-col``).  Datasets are
opened only when the plan uses them.  The result is written by the
executors (JSON: one object per recipient, e-mail dropped; CSV: header,
e-mail kept); nothing is collected.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

from .operators.algebra import MEASURE_FROM
from .operators.shape import RowGuard
from .plans.any_signal import AnySignalParams, reference_any_signal
from .plans.market import MarketParams, reference_market
from .plans.unconverted import UnconvertedParams, reference_unconverted
from .sources.events import read_dataset
from .sources.sinks import write_campaign_csv, write_campaign_json


class LazyTables(Mapping[str, DataFrame]):
    """``DIR/<name>`` read on first access, by :func:`read_dataset`.

    ``layout`` maps a dataset to ``{"path": ..., "aliases": {stored: used}}``
    where its folder or columns have other names.
    """

    def __init__(
        self, spark: SparkSession, root: str, fmt: str = "parquet",
        layout: Mapping[str, Mapping] | None = None,
    ):
        self.spark, self.root, self.fmt = spark, root.rstrip("/"), fmt
        self.layout = layout or {}
        self._cache: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            at = self.layout.get(name, {})
            self._cache[name] = read_dataset(
                self.spark, f"{self.root}/{at.get('path', name)}", at.get("aliases"),
                fmt=self.fmt, ids=at.get("ids", ()),
            )
        return self._cache[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._cache)

    def __len__(self) -> int:
        return len(self._cache)


def _date(s: str | None) -> dt.date | None:
    return dt.date.fromisoformat(s) if s else None


def parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="python -m reachset.run", description=__doc__.split("\n")[0])
    sub = ap.add_subparsers(dest="plan", required=True)

    def common(p):
        p.add_argument("--data", required=True, help="folder with one sub-folder per dataset")
        p.add_argument("--out", required=True, help="output folder")
        p.add_argument("--as-of", help="ISO date that relative dates count back from (default: today)")
        p.add_argument("--partition-col", help="event-date partition column of the datasets")
        p.add_argument("--mode", default="errorifexists", help="write mode")
        p.add_argument("--layout", help="JSON text: {dataset: {path, aliases, ids}}")

    q1 = sub.add_parser("unconverted", help="mailed and optimized, did not spend (Q1)")
    common(q1)
    q1.add_argument("--start", default="20d")
    q1.add_argument("--focus", default="12d")
    q1.add_argument("--mail-start", default="2d")
    q1.add_argument("--mail-focus", default="1d")
    q1.add_argument("--neither", action="store_true", help="audience 2: not optimized either")
    q1.add_argument("--client", required=True, help="client name of the mailing")
    q1.add_argument("--campaign", required=True)
    q1.add_argument("--excluded-advertiser", type=int, required=True, help="internal test advertiser")
    q1.add_argument("--eligibility-group", required=True)
    q1.add_argument(
        "--measure-from", type=int, default=MEASURE_FROM,
        help="bytes from which a chain level is measured for hot keys",
    )
    q1.add_argument("--require-rows", action="store_true", help="fail if a part came back empty")

    q2 = sub.add_parser("any_signal", help="any tech-interest signal, not new (Q2)")
    common(q2)
    q2.add_argument("--start", default="1y")
    q2.add_argument("--focus", default="0d")
    q2.add_argument("--country", default="BR")
    q2.add_argument("--language", default="pt")
    q2.add_argument("--require-rows", action="store_true", help="fail if a signal came back empty")
    q2.add_argument("--keyword-mode", default="words", choices=["words", "contains", "pattern"])

    q3 = sub.add_parser("market", help="city/metro market audience (Q3)")
    common(q3)
    q3.add_argument("--focus", default="today")
    q3.add_argument("--city", default="Washington D.C.")
    q3.add_argument("--metro", action="store_true", help="include the metro area")
    q3.add_argument("--account-days", type=int, default=3)
    q3.add_argument("--alert-days", type=int, default=0)
    q3.add_argument("--format", default="json", choices=["json", "csv"])
    q3.add_argument("--one-row-per-account", action="store_true")
    q3.add_argument("--require-rows", action="store_true", help="fail if a source or the result came back empty")
    return ap


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> DataFrame:
    args = parser().parse_args(argv)
    if spark is None:
        from .session import build_session

        # no master here: the submit command's wins, a plain run is local
        spark = SparkSession.getActiveSession() or build_session()
    tables = LazyTables(spark, args.data, layout=json.loads(args.layout) if args.layout else None)
    guard = RowGuard() if args.require_rows else None
    as_of, part = _date(args.as_of), args.partition_col
    if args.plan == "unconverted":
        p = UnconvertedParams(
            client_name=args.client, campaign=args.campaign,
            excluded_advertiser=args.excluded_advertiser, eligibility_group=args.eligibility_group,
            start=args.start, focus=args.focus, mail_start=args.mail_start,
            mail_focus=args.mail_focus, as_of=as_of, partition_col=part,
            optimized_mode="not_in" if args.neither else "in", measure_from=args.measure_from,
        )
        out = reference_unconverted(tables, p, guard)
        write_campaign_json(out, args.out, mode=args.mode)
    elif args.plan == "any_signal":
        p = AnySignalParams(
            start=args.start, focus=args.focus, as_of=as_of, country=args.country,
            language=args.language, keyword_mode=args.keyword_mode, partition_col=part,
        )
        out = reference_any_signal(tables, p, guard)
        write_campaign_json(out, args.out, mode=args.mode)
    else:
        p = MarketParams(
            focus=args.focus, city=args.city, include_metro=args.metro,
            account_days=args.account_days, alert_days=args.alert_days, as_of=as_of,
            one_row_per_account=args.one_row_per_account, partition_col=part,
        )
        out = reference_market(tables, p, guard)
        if args.format == "csv":
            write_campaign_csv(out, args.out, mode=args.mode)
        else:
            write_campaign_json(out, args.out, mode=args.mode)
    if guard:
        for name, n in guard.check().items():
            print(f"{name}: {n} unusable ids")
    return out


if __name__ == "__main__":
    main()

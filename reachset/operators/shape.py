"""Output shaping, null handling and guards
(SURVEY §2.2 P1-P5, §2.6 N1-N2, §2.11 G1).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

INT32_MIN, INT32_MAX = -(2**31), 2**31 - 1


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename columns; unlike ``withColumnRenamed`` a missing column fails."""
    missing = [c for c in mapping if c not in df.columns]
    if missing:
        raise ValueError(f"cannot rename missing column(s) {missing}; have {df.columns}")
    return df.select(*[F.col(c).alias(mapping.get(c, c)) for c in df.columns])


def project(df: DataFrame, *cols: str | Column, drop: tuple[str, ...] = ()) -> DataFrame:
    """Explicit projection (P1, P5); ``drop`` names columns that must exist."""
    missing = [c for c in drop if c not in df.columns]
    if missing:
        raise ValueError(f"cannot drop missing column(s) {missing}")
    if cols:
        return df.select(*cols)
    return df.select(*[c for c in df.columns if c not in drop])


def with_literals(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Constant columns such as ``firstName = ''``."""
    return df.withColumns({c: F.lit(v) for c, v in values.items()})


def int32_key(c: Column | str) -> Column:
    """Narrow a key to 32-bit int; out-of-range values fail the job.

    The check is explicit, so it holds whether or not the session runs in
    ANSI mode (pandas would wrap silently; a non-ANSI cast would too).
    """
    col = F.col(c) if isinstance(c, str) else c
    ok = col.isNull() | ((col >= F.lit(INT32_MIN)) & (col <= F.lit(INT32_MAX)))
    return F.when(ok, col.cast("int")).otherwise(
        F.raise_error(F.concat(F.lit("key out of int32 range: "), col.cast("string")))
    ).cast("int")


def cast_key(df: DataFrame, key: str, new_name: str | None = None) -> DataFrame:
    """``cast_key`` on a frame: narrow ``key`` and optionally rename it (P4+P2)."""
    target = new_name or key
    return df.select(
        *[int32_key(c).alias(target) if c == key else F.col(c) for c in df.columns]
    )


def dedupe(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Remove repeated rows (A5); partial aggregation runs map-side."""
    return df.dropDuplicates(subset) if subset else df.distinct()


def drop_incomplete(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Drop rows with a null in any (or the given) column; '' stays."""
    return df.dropna(how="any", subset=subset)


def fill_defaults(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Per-column replacement of null; '' is left alone."""
    missing = [c for c in values if c not in df.columns]
    if missing:
        raise ValueError(f"cannot fill missing column(s) {missing}")
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items()})


class EmptyAudienceError(ValueError):
    pass


def require_rows(df: DataFrame, name: str = "result") -> DataFrame:
    """Fail now if ``df`` is empty (G1).  Runs ``df`` until its first row.

    For a whole plan use :class:`RowGuard`, which runs nothing twice.
    """
    if df.isEmpty():
        raise EmptyAudienceError(f"{name} came back empty; check the inputs")
    return df


class RowGuard:
    """Counts rows while the plan runs; :meth:`check` fails afterwards (G1).

    ``watch`` marks a part of the plan, ``watch_ids`` counts its ids that are
    neither null nor a number (they take no part in an audience); ids stored
    as numbers need no counting and their plan stays as it is.  Call ``check``
    after the write: it raises for watched parts without rows and returns the
    number of unusable ids by name, where there are any.
    """

    def __init__(self):
        self._rows: dict[str, Observation] = {}
        self._ids: dict[str, Observation] = {}

    def watch(self, df: DataFrame, name: str) -> DataFrame:
        self._rows[name] = Observation()
        return df.observe(self._rows[name], F.count(F.lit(1)).alias("rows"))

    def watch_ids(self, df: DataFrame, column: str, name: str) -> DataFrame:
        if not isinstance(df.schema[column].dataType, StringType):
            return df
        bad = F.col(column).isNotNull() & F.col(column).try_cast("bigint").isNull()
        self._ids[name] = Observation()
        return df.observe(self._ids[name], F.count_if(bad).alias("unusable"))

    @staticmethod
    def _reported(seen: Observation, name: str) -> int:
        # a part that the optimizer found empty and took out reports a row without fields
        return seen.get.get(name, 0) if seen._jo.getRow().length() else 0

    def check(self) -> dict[str, int]:
        empty = [n for n, seen in self._rows.items() if not self._reported(seen, "rows")]
        if empty:
            raise EmptyAudienceError(f"{', '.join(empty)} came back empty; check the inputs")
        counts = {n: self._reported(seen, "unusable") for n, seen in self._ids.items()}
        return {n: count for n, count in counts.items() if count}

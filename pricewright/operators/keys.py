"""Checks of dimension keys and row counts that ride on the job which reads or writes the rows.

Both are metrics observed while rows pass by, so neither costs a scan of its own. Key checks are
maxima, which a repeated task leaves as they are. Counts observed below a shuffle are sums: a task
that runs again after a lost executor counts its rows again, so they are a report, not a check. The count of
a written table is observed in the tasks that write it, each of which counts once.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, Observation, functions as F

from ..sources.star import StarSchema


def observed(seen: Observation) -> dict:
    """The metrics of a finished job; none where the plan did without the node, because another
    table was empty."""
    return seen.get if seen._jo.getRow().length() else {}


class KeyViolation(ValueError):
    """A dimension whose key is null, or stands in several rows."""


class KeyChecks:
    """The key checks of one job. :meth:`verify` comes after the checked tables are written."""

    def __init__(self) -> None:
        self._pending: list[tuple[str, str, Observation]] = []

    def one_row_per_key(self, df: DataFrame, table: str, key: str) -> DataFrame:
        """One row for each key, whose number of rows and null keys are observed.

        The exchange by the key is the one that a join on it needs anyway. Until :meth:`verify`
        has passed, the result of a bad table is not to be used: it holds any row of a key.
        """
        rest = [name for name in df.columns if name != key]
        row = F.first(F.struct(*rest)) if rest else F.lit(None)
        seen = Observation()
        self._pending.append((table, key, seen))
        grouped = df.groupBy(key).agg(F.count(F.lit(1)).alias("copies__"), row.alias("row__"))
        copies = F.when(F.col(key).isNotNull(), F.col("copies__"))
        return (
            grouped.observe(
                seen,
                F.max(copies).alias("copies"),
                F.max_by(F.col(key).cast("string"), copies).alias("example"),
                F.max(F.col(key).isNull()).alias("null_key"),
            )
            .filter(F.col(key).isNotNull())
            .select(key, *[F.col(f"row__.{name}") for name in rest])
            .select(*df.columns)
        )

    def verify(self) -> None:
        """Raise by table and key what the written rows have shown."""
        pending, self._pending = self._pending, []
        for table, key, seen in pending:
            found = observed(seen)
            if found.get("null_key"):
                raise KeyViolation(f"{table}: null in key {key}")
            if (found.get("copies") or 0) > 1:
                raise KeyViolation(
                    f"{table}: {found['copies']} rows with {key} = {found['example']!r}"
                )


class SourceCounts:
    """Row counts of source tables, observed where a job scans them."""

    def __init__(self) -> None:
        self._seen: dict[str, tuple[DataFrame, Observation]] = {}

    def watch(self, star: StarSchema, tables: tuple[str, ...] | None = None) -> StarSchema:
        """The same tables. Name those that the job reads: an unread one is counted on its own."""
        watched = {}
        for name, df in star.tables().items():
            if tables is None or name in tables:
                seen = Observation()
                watched[name] = df.observe(seen, F.count(F.lit(1)).alias("rows"))
                self._seen[name] = df, seen
        return replace(star, **watched)

    def rows(self) -> dict[str, int]:
        """Row count of each table, once the job has read them all.

        A table that the plan did without is counted on its own.
        """
        counts = {name: observed(seen).get("rows") for name, (_, seen) in self._seen.items()}
        return {
            name: self._seen[name][0].count() if rows is None else rows
            for name, rows in counts.items()
        }

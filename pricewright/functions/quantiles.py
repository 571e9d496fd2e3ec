"""Exact quantiles whose work is spread over the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Buckets per unit of ln(1 + |value|), each about 0.1 % of its value wide. The bucket number
# never decreases with the value, and all doubles together have at most
# 2 * 710 * BUCKETS + 1 of them.
BUCKETS = 1024
_BUCKET = f"signum(value) * floor(log1p(abs(value)) * {BUCKETS})"
_BEFORE = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"


def exact_quantiles(df: DataFrame, targets: dict[str, tuple[str, float]]) -> DataFrame:
    """One row with one column per target ``name: (column, probability)``.

    Linear interpolation between the two nearest ranks; null and NaN are skipped; a column
    without values gives null. The built-in ``percentile`` keeps every distinct value of the
    table in one task, and sorting would shuffle every row. Here a first scan counts rows per
    bucket of values, combined before the shuffle, and a running total over the buckets
    (their number has a fixed bound) finds those that hold a wanted rank: at most two per
    target. A second scan keeps the rows of those buckets only and ranks their values. Both
    scans read just the target columns; give it a written table rather than a long plan.
    """
    columns = list(dict.fromkeys(column for column, _ in targets.values()))
    series = {
        name: (columns.index(column), f"(total - 1) * {float(p)!r}D")
        for name, (column, p) in targets.items()
    }
    pairs = ", ".join(
        f"struct({i} AS series, CAST(`{c}` AS DOUBLE) AS value)" for i, c in enumerate(columns)
    )
    values = (
        df.selectExpr(f"inline(array({pairs}))")
        .where("value IS NOT NULL AND NOT isnan(value)")
        .withColumn("bucket", F.expr(_BUCKET))
    )
    holds_wanted_rank = " OR ".join(
        f"(series = {i} AND floor({rank}) < start + rows AND ceil({rank}) >= start)"
        for i, rank in series.values()
    )
    opened = (
        values.groupBy("series", "bucket")
        .agg(F.expr("count(*) AS rows"))
        .selectExpr(
            "series",
            "bucket",
            "rows",
            f"coalesce(sum(rows) OVER (PARTITION BY series ORDER BY bucket {_BEFORE}), 0) AS start",
            "sum(rows) OVER (PARTITION BY series) AS total",
        )
        .where(holds_wanted_rank)
        .drop("rows")
    )
    ranked = (
        # At most two buckets per target, whatever the size of the table.
        values.join(F.broadcast(opened), ["series", "bucket"])
        .groupBy("series", "bucket", "start", "total", "value")
        .agg(F.expr("count(*) AS rows"))
        .selectExpr(
            "series",
            "total",
            "value",
            "rows",
            "start + coalesce(sum(rows) OVER (PARTITION BY series, bucket ORDER BY value "
            f"{_BEFORE}), 0) AS first",
        )
    )
    found = []
    for name, (i, rank) in series.items():
        for end in ("floor", "ceil"):
            hit = f"series = {i} AND {end}({rank}) >= first AND {end}({rank}) < first + rows"
            found.append(F.expr(f"max(IF({hit}, value, NULL)) AS {name}__{end}"))
        found.append(F.expr(f"max(IF(series = {i}, ({rank}) % 1, NULL)) AS {name}__part"))
    return ranked.agg(*found).selectExpr(
        *[f"{n}__floor + ({n}__ceil - {n}__floor) * {n}__part AS {n}" for n in series]
    )

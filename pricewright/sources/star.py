"""The source tables and their readers."""

from __future__ import annotations

from dataclasses import dataclass, fields
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .. import schemas
from .records import read_records


@dataclass(frozen=True)
class StarSchema:
    """Source tables by role. Jobs that need fewer tables leave the others unset."""

    items: DataFrame
    products: DataFrame
    translation: DataFrame
    orders: DataFrame | None = None
    payments: DataFrame | None = None
    reviews: DataFrame | None = None
    customers: DataFrame | None = None
    sellers: DataFrame | None = None
    #: Whether orders, payments, reviews and items lie in equal buckets of the order id, and the orders
    #: carry their customer's state; see :mod:`pricewright.sources.layout`.
    by_order: bool = False

    def tables(self) -> dict[str, DataFrame]:
        present = {f.name: getattr(self, f.name) for f in fields(self)}
        return {name: df for name, df in present.items() if isinstance(df, DataFrame)}


#: Where the CSV reader puts a record that it cannot split.
_CORRUPT = T.StructField("_corrupt_record", T.StringType())


def _typed(table: str, header: list[str]) -> T.StructType:
    wanted = schemas.TABLES[table]
    missing = set(wanted.names) - set(header) - schemas.OPTIONAL_COLUMNS
    if missing:
        raise ValueError(f"{table}: missing columns {sorted(missing)}")
    known = {f.name: f for f in wanted}
    return T.StructType([known.get(n, T.StructField(n, T.StringType())) for n in header])


def read_csv_table(spark: SparkSession, table: str, path: str, mode: str = "FAILFAST") -> DataFrame:
    """Read one CSV table with its declared types, whatever the order of its columns.

    Blanks become null. A value that does not parse raises, or becomes null with
    ``mode="PERMISSIVE"``. Types are declared, never inferred: the only extra read is the
    header line. Review texts contain line breaks; see :mod:`pricewright.sources.records`.
    """
    # Each file's header is held against the schema, so a folder of files that order their
    # columns differently is an error, not a mix-up.
    options = {
        "header": "true",
        "mode": mode,
        "quote": '"',
        "escape": '"',
        "enforceSchema": "false",
    }
    header = spark.read.options(**options).csv(path).columns
    schema = _typed(table, header)
    used = [n for n in schemas.TABLES[table].names if n in header]
    if table == "reviews":
        return read_records(spark, path, schema, mode).select(*used)
    return spark.read.schema(schema).options(**options).csv(path).select(*used)


def read_parquet_table(spark: SparkSession, table: str, path: str) -> DataFrame:
    """Read one Parquet table; columns of another type are cast, values that do not fit raise."""
    df = spark.read.parquet(path)
    _typed(table, df.columns)
    fields = [f for f in schemas.TABLES[table] if f.name in df.columns]
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])


def read_quarantined(
    spark: SparkSession, table: str, path: str
) -> tuple[DataFrame, DataFrame]:
    """The CSV rows that parse, and the others as ``table_name, record, reason``.

    Null and blank values are no errors. Both results scan the files; neither drops a row that the
    other lacks.
    """
    options = {"header": "true", "quote": '"', "escape": '"', "enforceSchema": "false"}
    if table == "reviews":
        options["multiLine"] = "true"
    header = spark.read.options(**options).csv(path).columns
    schema = _typed(table, header)
    texts = spark.read.options(**options).schema(
        T.StructType([T.StructField(n, T.StringType()) for n in header] + [_CORRUPT])
    ).option("columnNameOfCorruptRecord", _CORRUPT.name).csv(path)
    wanted = {f.name: f.dataType for f in schemas.TABLES[table] if f.name in header}
    bad = [
        F.when(
            F.trim(n).isNotNull() & (F.trim(n) != "") & F.col(n).try_cast(kind).isNull(),
            F.concat(F.lit(f"{n}: no {kind.simpleString()}: "), F.col(n)),
        )
        for n, kind in wanted.items()
        if not isinstance(kind, T.StringType)
    ]
    broken = F.when(F.col(_CORRUPT.name).isNotNull(), F.lit("broken record"))
    reason = F.array_join(F.array_compact(F.array(broken, *bad)), "; ")
    judged = texts.withColumn("reason", reason)
    record = F.coalesce(_CORRUPT.name, F.to_json(F.struct(*header)))
    good = judged.filter("reason = ''").select(
        *[
            F.col(n).try_cast(kind).alias(n) if not isinstance(kind, T.StringType) else F.col(n)
            for n, kind in wanted.items()
        ]
    )
    aside = judged.filter("reason <> ''").select(
        F.lit(table).alias("table_name"), record.alias("record"), "reason"
    )
    return good, aside


def to_parquet(spark: SparkSession, folder: str, out: str, tables=tuple(schemas.TABLES)) -> None:
    """Convert published CSV files to ``<table>.parquet``, once, for jobs that read them often."""
    for table, df in read_star(spark, folder, tables).tables().items():
        df.write.mode("error").parquet(f"{out}/{table}.parquet")


def read_star(
    spark: SparkSession,
    folder: str,
    tables: tuple[str, ...] = tuple(schemas.TABLES),
    fmt: str = "csv",
    mode: str = "FAILFAST",
) -> StarSchema:
    """Read the named tables of a folder of published CSV files or of ``<table>.parquet``."""
    if fmt == "csv":
        read = {
            t: read_csv_table(spark, t, f"{folder}/{schemas.CSV_FILES[t]}", mode) for t in tables
        }
    elif fmt == "parquet":
        read = {t: read_parquet_table(spark, t, f"{folder}/{t}.parquet") for t in tables}
    else:
        raise ValueError(f"unknown format {fmt!r}")
    return StarSchema(**read)


def scan_counts(star: StarSchema) -> DataFrame:
    """Row count of every table, ``table_name, row_count``."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in star.tables().items()
    ]
    return reduce(DataFrame.unionAll, counts)

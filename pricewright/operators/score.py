"""Price scoring of request rows. Every step works on tables and on streams alike."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .. import schemas
from ..functions.features import is_peak_season, price_of, with_physical_features


#: A record that the reader could not parse; see :func:`pricewright.streaming.scoring.request_schema`.
CORRUPT = "_corrupt_record"


def _with_missing_fields(requests: DataFrame) -> DataFrame:
    """Give every request field a column of its declared type; what does not fit becomes null."""
    kinds = dict(requests.dtypes)

    def typed(field: T.StructField) -> Column:
        if field.name not in kinds:
            return F.lit(None).cast(field.dataType)
        own = F.col(field.name)
        return own if kinds[field.name] == field.dataType.simpleString() else own.try_cast(
            field.dataType
        )

    return requests.withColumns({f.name: typed(f) for f in schemas.REQUEST})


def _unreadable(requests: DataFrame) -> list[Column]:
    """Values and records that are there and cannot be read."""
    kinds = dict(requests.dtypes)
    found = []
    if CORRUPT in kinds:
        found.append(F.when(F.col(CORRUPT).isNotNull(), "request: cannot be parsed"))
    for field in schemas.REQUEST:
        kind = field.dataType.simpleString()
        if field.name in kinds and kinds[field.name] != kind:
            own = F.col(field.name)
            bad = own.isNotNull() & own.try_cast(field.dataType).isNull()
            found.append(F.when(bad, f"{field.name}: is no {kind}"))
    return found


def _violations() -> list[Column]:
    found = []
    for name, (_, default, lower, inclusive, upper) in schemas.REQUEST_FIELDS.items():
        value = F.col(name)
        if default is None:
            found.append(F.when(value.isNull(), f"{name}: required"))
        if isinstance(schemas.REQUEST[name].dataType, T.DoubleType):
            # NaN sorts above every bound, so no comparison below finds it.
            infinite = F.isnan(value) | (F.abs(value) == float("inf"))
            found.append(F.when(infinite, f"{name}: must be a finite number"))
        if lower is not None:
            bad = value < lower if inclusive else value <= lower
            sign = ">=" if inclusive else ">"
            found.append(F.when(bad, f"{name}: must be {sign} {lower}"))
        if upper is not None:
            found.append(F.when((value > upper) & ~_nan(name), f"{name}: must be <= {upper}"))
    return found


def _nan(name: str) -> Column:
    is_double = isinstance(schemas.REQUEST[name].dataType, T.DoubleType)
    return F.isnan(name) if is_double else F.lit(False)


def validate(requests: DataFrame) -> DataFrame:
    """Add ``violations``, the broken rules of each row (empty when valid)."""
    unreadable = F.array_compact(F.array(*_unreadable(requests)).cast("array<string>"))
    return _with_missing_fields(requests.withColumn("violations", unreadable)).withColumn(
        "violations", F.concat("violations", F.array_compact(F.array(*_violations())))
    )


def valid_rows(validated: DataFrame) -> DataFrame:
    return validated.filter(F.size("violations") == 0).drop("violations")


def quarantined_rows(validated: DataFrame) -> DataFrame:
    """Rejected rows with their reasons as one ``error`` text."""
    return validated.filter(F.size("violations") > 0).withColumn(
        "error", F.array_join("violations", "; ")
    )


def apply_defaults(requests: DataFrame) -> DataFrame:
    """Fill optional fields that were not given."""
    return requests.withColumns(
        {
            name: F.coalesce(F.col(name), F.lit(spec[1]).cast(spec[0]))
            for name, spec in schemas.REQUEST_FIELDS.items()
            if spec[1] is not None
        }
    )


def request_features(requests: DataFrame) -> DataFrame:
    """Derived features, from the expressions the training side uses."""
    return with_physical_features(requests).withColumn(
        "is_peak_season", is_peak_season(F.col("purchase_month"))
    )


def score(requests: DataFrame, model: PipelineModel, keep: tuple[str, ...] = ()) -> DataFrame:
    """``predicted_price`` for valid rows, ``error`` for the others; no row is lost.

    Rejected rows go through the model on placeholder values instead of a separate branch:
    the input is read once, and nothing about one bad row stops the rest. Their prediction
    is blanked.
    """
    checked = validate(requests).withColumn(
        "error",
        F.when(F.size("violations") > 0, F.array_join("violations", "; ")),
    )
    failed = F.col("error").isNotNull()
    usable = apply_defaults(checked).withColumns(
        {
            name: F.when(failed, F.lit("" if kind.simpleString() == "string" else 1).cast(kind))
            .otherwise(F.col(name))
            for name, (kind, *_) in schemas.REQUEST_FIELDS.items()
        }
    )
    featured = request_features(usable).select(*keep, "error", *schemas.FEATURES)
    return model.transform(featured).select(
        *keep,
        F.when(~failed, F.bround(price_of(F.col("prediction")), 2)).alias("predicted_price"),
        "error",
    )

"""Train-fitted preparation of model inputs as persistable pipeline stages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.config import NUMERIC_FEATURES
from ledgerloom.functions.ordering import exact_quantiles

INPUTS = "inputs"


def train_medians(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact median per column, in one row."""
    long = exact_quantiles(train, columns, [0.5])
    return long.agg(*[F.max(F.when(F.col("column") == c, F.col("value"))).alias(c) for c in columns])


def _number(value: float) -> str:
    return f"CAST({float(value)!r} AS DOUBLE)"


def preparation_stages(train: DataFrame, scaled: bool, columns: Sequence[str] = NUMERIC_FEATURES) -> list:
    """Median fill, optional z-scores and country indicators, fitted on ``train`` only.

    Medians are only looked for where a column has gaps. Population deviations are used, and a constant
    column is divided by one. A country unseen in training has no indicator.
    """
    found = train.agg(
        *[F.count_if(F.col(c).isNull()).alias(f"gaps_{c}") for c in columns],
        *[F.avg(c).alias(f"mean_{c}") for c in columns],
        *[F.stddev_pop(c).alias(f"std_{c}") for c in columns],
    ).first()
    gappy = [c for c in columns if found[f"gaps_{c}"]]
    medians = train_medians(train, gappy).first().asDict() if gappy else {}
    if gappy and scaled:
        filled = train.fillna(medians)
        moments = filled.agg(
            *[F.avg(c).alias(f"mean_{c}") for c in columns], *[F.stddev_pop(c).alias(f"std_{c}") for c in columns]
        ).first()
    else:
        moments = found
    prepared = []
    for c in columns:
        value = f"coalesce(CAST({c} AS DOUBLE), {_number(medians.get(c, 0.0))})"
        if scaled:
            mean, std = moments[f"mean_{c}"], moments[f"std_{c}"] or 1.0
            value = f"({value} - {_number(mean)}) / {_number(std)}"
        prepared.append(f"{value} AS x_{c}")
    return [
        SQLTransformer(statement=f"SELECT *, {', '.join(prepared)} FROM __THIS__"),
        StringIndexer(
            inputCol="country", outputCol="country_index", handleInvalid="keep", stringOrderType="alphabetAsc"
        ),
        # The last index is the unseen bucket; dropping it leaves all indicators at zero.
        OneHotEncoder(inputCols=["country_index"], outputCols=["country_flags"], dropLast=True),
        VectorAssembler(inputCols=[*[f"x_{c}" for c in columns], "country_flags"], outputCol=INPUTS),
    ]


def input_names(model, columns: Sequence[str] = NUMERIC_FEATURES) -> list[str]:
    """Names of the assembled inputs of a fitted pipeline."""
    countries = next(stage for stage in model.stages if hasattr(stage, "labelsArray")).labelsArray[0]
    return [*columns, *countries]

"""Feature vectors and standardisation."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import StandardScaler, StandardScalerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.typing import column
from ledgerline.operators.missing import ROW, attach_row


def assembler(names: Sequence[str]) -> VectorAssembler:
    """Nulls raise: fill them first."""
    return VectorAssembler(inputCols=list(names), outputCol="features", handleInvalid="error")


def assemble_features(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return assembler(names).transform(df)


def scaler() -> StandardScaler:
    return StandardScaler(inputCol="features", outputCol="scaled_features", withMean=True, withStd=True)


def standardize(assembled: DataFrame) -> tuple[StandardScalerModel, DataFrame]:
    """Centre and scale ``features`` by the sample spread; a constant column becomes 0."""
    model = scaler().fit(assembled)
    return model, model.transform(assembled)


def prepare_stages(names: Sequence[str]) -> list:
    """Assembler and scaler as pipeline stages, so that both are fitted on train rows only."""
    return [assembler(names), scaler()]


def pipeline(names: Sequence[str], classifier) -> Pipeline:
    return Pipeline(stages=[*prepare_stages(names), classifier])


def vector_columns(df: DataFrame, vector: str, names: Iterable[str]) -> list[Column]:
    values = vector_to_array(vector)
    return [values[i].alias(c) for i, c in enumerate(names)]


def standardize_columns(df: DataFrame, names: Iterable[str], ddof: int = 0) -> DataFrame:
    """Standardise plain columns with a population (0) or sample (1) spread."""
    names = list(names)
    spread = F.stddev_pop if ddof == 0 else F.stddev_samp
    stats = {f"mean {c}": F.avg(column(c)) for c in names} | {f"std {c}": spread(column(c)) for c in names}
    df, row = attach_row(df, stats)

    def scaled(c: str) -> Column:
        z = F.try_divide(column(c) - row[f"mean {c}"], row[f"std {c}"])
        return F.when(column(c).isNotNull(), F.coalesce(z, F.lit(0.0)))

    return df.withColumns({c: scaled(c) for c in names}).drop(ROW)

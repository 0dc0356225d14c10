"""Record shapes, and one normaliser that brings any input to them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampType(),
}


def _struct(spec: str) -> T.StructType:
    """Fields from ``name type, ...``, readable before there is a session."""
    pairs = (field.split() for field in spec.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


EVAL_ROW = _struct(
    "id1 string, id2 string, lang_codes string, text string, translation string, "
    "is_code_switched boolean, lang_count int, semantic_similarity double"
)

TRANSLATION = _struct(
    "model string, id1 string, id2 string, lang_codes string, language string, "
    "source string, hypothesis string, reference string, error string"
)

RUN_META = _struct(
    "model string, model_revision string, eval_path string, csv_path string, timestamp timestamp, "
    "n_rows bigint, n_errors bigint, num_shots bigint, concurrency bigint, "
    "elapsed_seconds double, req_per_s double"
)

SCORES = _struct("ifeval double, comet double, comet_qe double")

OPTIONAL_SCORED = _struct(
    "slang_density double, slang_hits bigint, n_tokens bigint, source_copy boolean, slang_bucket string"
)

SCORED = T.StructType(TRANSLATION.fields + SCORES.fields + OPTIONAL_SCORED.fields)

SUMMARY_EXAMPLE = _struct(
    "model string, dataset string, category string, language string, source string, "
    "hypothesis string, reference string, ifeval double, comet_qe double"
)


def typed(column: Column, data_type: T.DataType) -> Column:
    """Cast leniently: unreadable text and NaN both become null."""
    value = column.try_cast(data_type)
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        value = F.when(~F.isnan(value), value)
    return value


def normalise(df: DataFrame, schema: T.StructType, keep_extra: bool = True) -> DataFrame:
    """Every column of ``schema`` with its type (null where the input lacks it), then the extras."""
    present = set(df.columns)
    declared = [
        (typed(F.col(f"`{f.name}`"), f.dataType) if f.name in present else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields
    ]
    names = {f.name for f in schema.fields}
    extra = [F.col(f"`{c}`") for c in df.columns if c not in names] if keep_extra else []
    return df.select(*declared, *extra)


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN sorts above every number and spoils averages, so no table carries one."""
    return df.select(
        *[
            typed(F.col(f"`{f.name}`"), f.dataType).alias(f.name)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )

"""Reading, renaming, checking and narrowing the canonical table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortix import schema as S
from cohortix.functions.expr import nan_to_null
from cohortix.session import written

READERS = ("parquet", "orc", "json", "csv")
RECORD = "malformed_record"


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Columns as stored; CSV columns come as strings, so nothing is inferred from rows."""
    if fmt not in READERS:
        raise ValueError(f"unknown format {fmt!r}, expected one of {READERS}")
    reader = spark.read.option("header", True) if fmt == "csv" else spark.read
    return reader.format(fmt).load(path)


def rename_to_canonical(df: DataFrame, column_map: Mapping[str, str]) -> DataFrame:
    """``column_map`` is canonical -> source; every canonical column must be there after it."""
    renamed = df.withColumnsRenamed({source: name for name, source in column_map.items()})
    missing = sorted(set(S.CANONICAL) - set(renamed.columns))
    if missing:
        raise KeyError(f"missing required columns after renaming: {missing}")
    return renamed


def typed(df: DataFrame) -> DataFrame:
    """Cast to the canonical types; unreadable values and NaN become null."""
    out = []
    for f in S.RAW_SCHEMA.fields:
        value = F.col(f.name) if f.name == S.ID else F.col(f.name).try_cast(f.dataType)
        out.append((nan_to_null(value) if f.dataType.typeName() == "double" else value).alias(f.name))
    return df.select(*out)


def narrowed(df: DataFrame) -> DataFrame:
    """Storage types: measures float, flags byte, tenure int."""
    types = {S.USAGE: "float", S.REVENUE: "float", S.DOU: "float",
             S.PACK: "byte", S.CHURN: "byte", S.TENURE: "int"}
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items() if c in df.columns})


def load_canonical(
    spark: SparkSession, path: str, fmt: str = "csv", column_map: Mapping[str, str] | None = None
) -> DataFrame:
    table = read_table(spark, path, fmt)
    return typed(rename_to_canonical(table, column_map or {c: c for c in S.CANONICAL}))


@dataclass(frozen=True)
class Checked:
    """Rows that fit the schema, and the lines that do not, with their file."""

    rows: DataFrame
    quarantined: DataFrame
    loaded: int
    malformed: int


def load_checked(spark: SparkSession, path: str, column_map: Mapping[str, str] | None = None, *,
                 columns: Sequence[str] | None = None) -> Checked:
    """Canonical rows of CSV files bound to their types; lines that do not fit are set aside, none is lost.

    A line does not fit if it has too few or too many fields or a field that is no value of its
    column. Empty fields and NaN are missing values and fit. The files have a header, which must
    be the same in all of them, or ``columns`` in that order. The text is parsed once, into a
    written table, whose write also counts both kinds.
    """
    names = {source: name for name, source in (column_map or {c: c for c in S.CANONICAL}).items()}
    headed = columns is None
    found = read_table(spark, path, "csv").columns if headed else list(columns)
    missing = sorted(set(S.CANONICAL) - {names.get(c, c) for c in found})
    if missing:
        raise KeyError(f"missing required columns after renaming: {missing}")
    kinds = {f.name: f.dataType for f in S.RAW_SCHEMA.fields}
    schema = T.StructType([T.StructField(c, kinds.get(names.get(c, c), T.StringType())) for c in found]
                          + [T.StructField(RECORD, T.StringType())])
    lines = (spark.read.schema(schema).option("header", headed).option("enforceSchema", not headed).option("mode", "PERMISSIVE")
             .option("columnNameOfCorruptRecord", RECORD).csv(path))
    counted = Observation()
    fits = F.col(RECORD).isNull()
    # all columns are parsed: a line is only checked as far as it is read
    whole = lines.withColumn("source_file", F.col("_metadata.file_path")).observe(
        counted, F.count_if(fits).alias("loaded"), F.count_if(~fits).alias("malformed"))
    table = written(whole, "parsed")
    rows = typed(rename_to_canonical(table.where(fits).drop(RECORD, "source_file"), {n: s for s, n in names.items()}))
    return Checked(rows, table.where(~fits).select(F.col(RECORD).alias("record"), "source_file"), **counted.get)

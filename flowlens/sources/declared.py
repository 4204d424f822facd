"""Readers with a declared schema, and the rows that break it.

Text files are read as text by the declared names, so that one field of a
wrong type never loses the rest of its row.  A field that is there but cannot
be read as its type, or a record that is not one (too few or too many fields,
broken JSON), makes the row a reject: it is kept as it came, with its reasons.
Good rows and rejects come from one pass and add up to the input.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .ingest import write_parquet

#: Column of the text readers for a record that is not one.
CORRUPT = "_corrupt_record"
NOT_A_RECORD = "record"


class SchemaError(ValueError):
    """The source lacks declared columns."""


def _value(c: Column, kind: T.DataType, is_text: bool) -> Column:
    if not is_text:
        return c.try_cast(kind)
    text = F.btrim(c, F.lit(" \t\n\x0b\f\r"))
    if isinstance(kind, T.StringType):
        return c
    value = text.try_cast(kind)
    return F.when(~F.isnan(value), value) if isinstance(kind, (T.DoubleType, T.FloatType)) else value


def classified(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """The declared columns, ``record`` (a reject as JSON text, else null) and
    ``reasons`` (names of the fields that break the schema, in its order;
    'record' for a record that is not one; empty for a good row).

    Null and, but for strings, blank fields are null values and no reason,
    unless the schema declares the field as not null.  Columns that the schema
    does not name are left out of good rows.
    """
    lost = [f.name for f in schema if f.name not in raw.columns]
    if lost:
        raise SchemaError(f"columns not in the source: {lost}")
    typed, reasons = [], []
    for f in schema:
        c = F.col(f"`{f.name}`")
        is_text = isinstance(raw.schema[f.name].dataType, T.StringType)
        value = _value(c, f.dataType, is_text)
        given = c.isNotNull()
        if is_text and not isinstance(f.dataType, T.StringType):
            given &= F.btrim(c, F.lit(" \t\n\x0b\f\r")) != ""
        broken = given & value.isNull() if f.nullable else value.isNull()
        typed.append(value.alias(f.name))
        reasons.append(F.when(broken, F.lit(f.name)))
    whole = F.to_json(F.struct(*[F.col(f"`{c}`") for c in raw.columns if c != CORRUPT]))
    if CORRUPT in raw.columns:
        bad = F.col(CORRUPT).isNotNull()
        found = F.when(bad, F.array(F.lit(NOT_A_RECORD))).otherwise(F.array_compact(F.array(*reasons)))
        whole = F.coalesce(F.col(CORRUPT), whole)
    else:
        found = F.array_compact(F.array(*reasons))
    out = raw.select(*typed, whole.alias("record"), found.alias("reasons"))
    return out.withColumn("record", F.when(F.size("reasons") > 0, F.col("record")))


def read_raw(spark: SparkSession, path: str, schema: T.StructType, fmt: str) -> DataFrame:
    """The source with its declared columns as text (csv, json) or as stored (parquet, orc)."""
    if fmt not in ("csv", "json"):
        return spark.read.format(fmt).load(path)
    text = T.StructType([*(T.StructField(f.name, T.StringType()) for f in schema), T.StructField(CORRUPT, T.StringType())])
    reader = spark.read.schema(text).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    if fmt == "csv":
        # a header in another order than the schema is an error, not a shift of columns
        reader = reader.option("header", True).option("enforceSchema", False)
    return reader.format(fmt).load(path)


def read_declared(spark: SparkSession, path: str, schema: T.StructType, out: str, fmt: str = "csv",
                  raw: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejects with ``record`` and ``reasons``), both read back from ``out``.

    The source is read once; the written table has a folder for each of the two.
    """
    rows = classified(read_raw(spark, path, schema, fmt) if raw is None else raw, schema)
    write_parquet(rows.withColumn("rejected", F.size("reasons") > 0), out, ["rejected"])
    # the schema is given: a source without rows or without rejects has no folder to infer from
    nullable = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema] + [T.StructField("rejected", T.BooleanType())])
    back = spark.read.schema(nullable).parquet(out)
    return (back.where("NOT rejected").select(*schema.names),
            back.where("rejected").select("record", "reasons"))


def reject_counts(table: str, rows: DataFrame) -> DataFrame:
    """table, reason, n_rows: the rejects of classified rows by reason, and the good rows ('')."""
    reason = F.explode(F.when(F.size("reasons") > 0, F.col("reasons")).otherwise(F.array(F.lit(""))))
    return rows.select(reason.alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(table).alias("table"), "reason", "n_rows")

"""Schemas of landed tables as the polls bring them: inferred, merged, kept; rejected lines in quarantine.

A poll is a table of JSON lines. Its schema is inferred over all its lines and
merged into the table's: a new column appears, a column that is missing stays,
one whose type changes widens (to text in the end). Names that differ in case
only are one column, spelled as it came first; JSON values under another
spelling are not read. A table's schemas are a change log next to it, the newest
counts.

A line that is no JSON object, lacks its key, or fails a check (such as a start
that is no time) goes to the quarantine table with its reasons; the others go on.
"""

from __future__ import annotations

import json
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boxoffice.sources import changelog

SCHEMA_LOG = T.StructType([T.StructField("schema", T.StringType())])
QUARANTINE = T.StructType([T.StructField("line", T.StringType()), T.StructField("reasons", T.ArrayType(T.StringType())),
                           T.StructField("ingested_at", T.TimestampType())])

# From narrow to wide; other pairs widen to text.
NUMBERS = [T.LongType(), T.DoubleType()]


def inferred(lines: DataFrame, line: str = "value") -> T.StructType:
    """The schema of all JSON objects among the lines; combines map-side.

    Numbers are long, decimal numbers double, values of different kinds text.
    """
    found = lines.select(F.try_parse_json(line).alias("v")).filter(
        F.schema_of_variant("v").startswith("OBJECT")).agg(F.schema_of_variant_agg("v")).first()[0]
    if not found or not found.startswith("OBJECT<"):
        return T.StructType()
    return _plain(T.DataType.fromDDL(found.replace("OBJECT<", "STRUCT<")))


def _plain(kind: T.DataType) -> T.DataType:
    """Kinds that a typed table of text, numbers, booleans, arrays and structs has."""
    if isinstance(kind, T.StructType):
        first = {f.name.lower(): f for f in reversed(kind.fields)}  # of names that differ in case only, the first
        return T.StructType([T.StructField(f.name, _plain(f.dataType)) for f in kind.fields if first[f.name.lower()] is f])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_plain(kind.elementType))
    if isinstance(kind, T.DecimalType | T.DoubleType | T.FloatType):
        return T.DoubleType()
    return kind if isinstance(kind, T.LongType | T.BooleanType) else T.StringType()


def merged(old: T.DataType, new: T.DataType) -> T.DataType:
    """The narrowest kind that holds both."""
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        brought, have = {f.name.lower(): f.dataType for f in new.fields}, {f.name.lower() for f in old.fields}
        fields = [T.StructField(f.name, merged(f.dataType, brought[f.name.lower()]) if f.name.lower() in brought else f.dataType) for f in old.fields]
        return T.StructType(fields + [T.StructField(f.name, f.dataType) for f in new.fields if f.name.lower() not in have])
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return T.ArrayType(merged(old.elementType, new.elementType))
    if old == new:
        return old
    if old in NUMBERS and new in NUMBERS:
        return NUMBERS[max(NUMBERS.index(old), NUMBERS.index(new))]
    return T.StringType()


def table_schema(spark: SparkSession, path: str) -> T.StructType:
    """The newest schema of the table at ``path`` (without columns if it has none yet)."""
    log = changelog.entries(spark, os.path.join(path, "_schema"), SCHEMA_LOG)
    newest = log.agg(F.max_by("schema", changelog.VERSION)).first()[0]
    return T.StructType.fromJson(json.loads(newest)) if newest else T.StructType()


def evolve(spark: SparkSession, path: str, schema: T.StructType) -> T.StructType:
    """Merge ``schema`` into that of the table at ``path``; returns the table's."""
    old = table_schema(spark, path)
    new = merged(old, schema) if old.fields else schema
    if new != old:
        changelog.append(spark.createDataFrame([(new.json(),)], SCHEMA_LOG), os.path.join(path, "_schema"))
    return new


def typed(lines: DataFrame, schema: T.StructType, key: list[str], checks: dict[str, Column], line: str = "value") -> tuple[DataFrame, DataFrame]:
    """The rows of the lines in ``schema``, and the lines that are rejected with their ``reasons``.

    ``checks`` names what must not be so (a condition over the columns). Other
    columns of ``lines`` are kept. A value that its column cannot hold becomes
    null if a check doesn't reject it; where a kind has widened to text, any
    value is held.
    """
    rest = [c for c in lines.columns if c != line]
    parsed = lines.select(*rest, F.col(line).alias("_line"), F.try_parse_json(line).alias("_v"))
    is_object = F.coalesce(F.schema_of_variant("_v").startswith("OBJECT"), F.lit(False))
    row = F.from_json("_line", schema, {"mode": "PERMISSIVE"})
    rows = parsed.select(*rest, "_line", is_object.alias("_object"), row.alias("_row")).select(*rest, "_line", "_object", "_row.*")
    no_key = F.lit(False)
    for k in key:
        no_key = no_key | F.col(k).isNull()
    told = [F.when(~F.col("_object"), F.lit("no object")), F.when(F.col("_object") & no_key, F.lit("no key"))]
    told += [F.when(F.col("_object") & F.coalesce(bad, F.lit(False)), F.lit(name)) for name, bad in checks.items()]
    rows = rows.withColumn("_reasons", F.filter(F.array(*told), lambda r: r.isNotNull()))
    good = rows.filter(F.size("_reasons") == 0).drop("_line", "_object", "_reasons")
    bad = rows.filter(F.size("_reasons") > 0).select(F.col("_line").alias("line"), F.col("_reasons").alias("reasons"), *rest)
    return good, bad


def not_a_time(column: str) -> Column:
    """Text that is there and is no time."""
    return F.col(column).isNotNull() & F.col(column).try_cast("timestamp").isNull()

"""Numbered message schemas. A new version is checked against all earlier
ones before it is let in, and each message is decoded by the version that its
header names and returned in the reader's schema.

A message is a zero byte, four bytes of version number and the JSON text. A
field may have a default in its metadata (``{"default": value}``), which stands
for it in messages of versions that don't know the field.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructField, StructType

from cartwheel.operators.decode import CORRUPT
from cartwheel.sources.files import read_optional_parquet

# Number types in the order in which a value of one may be read as a later one.
WIDENING = ["tinyint", "smallint", "int", "bigint", "float", "double"]


class IncompatibleSchema(ValueError):
    """A schema version that readers or writers of another can't live with."""


def _type_problems(reader: DataType, writer: DataType, path: str) -> list[str]:
    if isinstance(reader, StructType) and isinstance(writer, StructType):
        return problems(reader, writer, path)
    if isinstance(reader, ArrayType) and isinstance(writer, ArrayType):
        return _type_problems(reader.elementType, writer.elementType, f"{path}[]")
    r, w = reader.simpleString(), writer.simpleString()
    if r == w or (r in WIDENING and w in WIDENING and WIDENING.index(w) <= WIDENING.index(r)):
        return []
    return [f"{path}: {w} can't be read as {r}"]


def problems(reader: StructType, writer: StructType, path: str = "") -> list[str]:
    """What keeps a reader with one schema from messages written with another:
    fields that are required but not written or may be null, and types that
    don't widen. Fields that only the writer has are ignored."""
    out, written = [], {f.name: f for f in writer.fields}
    for f in reader.fields:
        name, given = f"{path}.{f.name}".lstrip("."), written.get(f.name)
        if given is None:
            if not f.nullable and "default" not in f.metadata:
                out.append(f"{name}: required, but not written and without a default")
        else:
            if given.nullable and not f.nullable and "default" not in f.metadata:
                out.append(f"{name}: required, but may be null")
            out += _type_problems(f.dataType, given.dataType, name)
    return out


class SchemaLog:
    """The versions of one message schema, a folder ``version=N`` each.
    ``mode`` is what a new version must be towards all earlier ones:
    ``backward`` (it reads their messages), ``forward`` (they read its) or ``full``."""

    def __init__(self, spark: SparkSession, root: str, mode: str = "full"):
        if mode not in ("backward", "forward", "full"):
            raise ValueError("mode is backward, forward or full")
        self.spark, self.root, self.mode = spark, root.rstrip("/"), mode

    def versions(self) -> dict[int, StructType]:
        found = read_optional_parquet(self.spark, StructType().add("schema", "string").add("version", "integer"), self.root)
        return {} if found is None else {r["version"]: StructType.fromJson(json.loads(r["schema"])) for r in found.collect()}  # a row a version

    def register(self, schema: StructType) -> int:
        """The number of ``schema``: that of the equal version, or a new one."""
        known = self.versions()
        for number, old in sorted(known.items()):
            if old == schema:
                return number
            wrong = problems(schema, old) if self.mode != "forward" else []
            wrong += problems(old, schema) if self.mode != "backward" else []
            if wrong:
                raise IncompatibleSchema(f"with version {number}: " + "; ".join(wrong))
        number = max(known, default=0) + 1
        row = self.spark.createDataFrame([(schema.json(),)], "schema string").coalesce(1)
        row.write.mode("errorifexists").parquet(f"{self.root}/version={number}")  # a second writer of this number fails
        return number


def encode_version(version: Column, text: Column) -> Column:
    """A message of ``version`` (header and JSON text), binary."""
    return F.concat(F.unhex(F.lpad(F.hex(version.cast("int")), 10, "0")), text.cast("binary"))


def decode_versions(envelope: DataFrame, versions: dict[int, StructType], reader: StructType) -> DataFrame:
    """The fields of ``reader`` from messages of any of ``versions``, with
    ``schema_version``, ``raw_value`` (the whole message, binary) and ``error_reason``: null, or
    ``no_version`` (no header), ``unknown_version``, ``invalid_json`` or
    ``out_of_range:<field>`` (a value that the reader's type can't hold). Fields
    are null then, as far as they can't be read. No message is dropped, and each is parsed once."""
    header = (F.length("value") >= 5) & (F.hex(F.expr("substring(value, 1, 1)")) == "00")
    version = F.when(header, F.conv(F.hex(F.expr("substring(value, 2, 4)")), 16, 10).cast("long"))
    text = F.expr("substring(value, 6)").cast("string")
    split = envelope.select(F.col("value").alias("raw_value"), version.alias("schema_version"), text.alias("_text"))
    # one column a version, so that a message is parsed by its own only; all fields may be null while they are parsed
    parsed = split.select("raw_value", "schema_version", *[
        F.when(F.col("schema_version") == n, F.from_json("_text", _loose(s), {"columnNameOfCorruptRecord": CORRUPT})).alias(f"_v{n}")
        for n, s in sorted(versions.items())])
    own = {n: F.col("schema_version") == n for n in sorted(versions)}
    fields = [_field(f, versions, own).alias(f.name) for f in reader.fields]
    broken = F.coalesce(*[F.col(f"_v{n}.{CORRUPT}") for n in own], *[F.when(own[n] & F.col(f"_v{n}").isNull(), F.lit("")) for n in own]).isNotNull()
    reason = (F.when(F.col("schema_version").isNull(), "no_version")
              .when(~F.col("schema_version").isin(*own), "unknown_version").when(broken, "invalid_json"))
    for f in reader.fields:
        for n, schema in versions.items():
            if f.name in schema.fieldNames() and schema[f.name].dataType != f.dataType:
                given = F.col(f"_v{n}.{f.name}")
                reason = reason.when(given.isNotNull() & given.try_cast(f.dataType).isNull(), f"out_of_range:{f.name}")
    return parsed.select(*fields, "schema_version", "raw_value", reason.alias("error_reason"))


def _loose(schema: StructType) -> StructType:
    return StructType([StructField(f.name, f.dataType, True) for f in schema.fields] + [StructField(CORRUPT, StringType(), True)])


def _field(field: StructField, versions: dict[int, StructType], own: dict[int, Column]) -> Column:
    """One field of the reader: from the versions that have it, its default from the others'."""
    default = F.lit(field.metadata.get("default")).cast(field.dataType)
    value = F.lit(None).cast(field.dataType)
    for n, schema in versions.items():
        has = field.name in schema.fieldNames()
        value = F.when(own[n], F.col(f"_v{n}.{field.name}").try_cast(field.dataType) if has else default).otherwise(value)
    return value

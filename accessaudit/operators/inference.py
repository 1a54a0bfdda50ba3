"""The schema a batch of records really has, found in one aggregation.

Records are parsed as VARIANT, so nothing is fixed before and nothing is lost; the fields of all
records of a batch are merged by an aggregate that combines map-side. `packets.parse_packets` with
its fixed schema is what the audit uses; this is for topics whose fields are not known, and for the gate
that lets a batch pass only if it has the columns an audit needs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructField, StructType, VariantType

from accessaudit.operators.lookup import join_measured
from accessaudit.session import fresh_folder, written

REQUIRED = ("query", "http", "destination")  # fixed values: the columns the gate asks for
DEPTH = 3
FIELD = "struct<path:string,value:variant>"


def variant_records(raw: DataFrame, value: str = "value") -> DataFrame:
    """One row per object of `value` (an object, or an array of them) as VARIANT column `record`; other columns are kept.

    Text that is neither gives no row.
    """
    kept = [f"`{c}`" for c in raw.columns if c != value]
    parsed = F.try_parse_json(F.col(value).cast("string"))
    objects = F.coalesce(F.expr("try_cast(_parsed AS array<variant>)"), F.array(F.col("_parsed")))
    rows = raw.select(*kept, parsed.alias("_parsed")).select(*kept, F.explode(objects).alias("record"))
    return rows.where(F.expr("try_cast(record AS map<string, variant>)").isNotNull())


def _fields(value: str, path: str, depth: int) -> str:
    """An array of FIELD: the members of an object, each followed by its own members."""
    members = f"map_entries(try_cast({value} AS map<string, variant>))"
    e = f"e{depth}"
    own = f"named_struct('path', concat({path}, {e}.key), 'value', {e}.value)"
    inner = f"array({own})"
    if depth > 1:
        inner = f"concat({inner}, {_fields(f'{e}.value', f'concat({path}, {e}.key, chr(46))', depth - 1)})"
    return f"flatten(transform(coalesce({members}, map_entries(cast(map() AS map<string, variant>))), {e} -> {inner}))"


def fields(records: DataFrame, batch: str | None = None, depth: int = DEPTH) -> DataFrame:
    """`path, kind, records, nulls` of every field of `variant_records`, for each value of `batch` if given.

    A path has up to `depth` names. `kind` is the type that holds all values: OBJECT, ARRAY, STRING, BIGINT
    and so on, VARIANT where they do not agree, VOID where all are null; `records` counts the values,
    `nulls` those that are null. Groups are as many as there are fields, and combine map-side.
    """
    by = [batch] if batch else []
    rows = records.select(*by, F.expr(f"explode({_fields('record', repr(''), depth)})").alias("f")).select(*by, "f.path", "f.value")
    kind = F.expr("schema_of_variant_agg(value)")
    found = rows.groupBy(*by, "path").agg(
        kind.alias("kind"), F.count(F.lit(1)).alias("records"), F.count_if(F.is_variant_null("value")).alias("nulls")
    )
    return found.withColumn("kind", F.regexp_extract("kind", "^[A-Z]+", 0))


def inferred_schema(records: DataFrame) -> StructType:
    """The schema of all `variant_records` together, merged by one aggregation; its text is what reaches the driver.

    Text keeps its type, numbers and booleans theirs; what disagrees, and what is null throughout, is text.
    """
    found = records.agg(F.expr("schema_of_variant_agg(record)")).first()[0]
    whole = DataType.fromDDL(_as_ddl(found)) if found and found.startswith("OBJECT<") else StructType([])
    return _texts(whole) or StructType([])


def _as_ddl(text: str) -> str:
    return text.replace("OBJECT<", "STRUCT<").replace("VOID", "STRING").replace("VARIANT", "STRING")


def _texts(kind: DataType) -> DataType | None:
    """The type with text for what is VARIANT; None for objects without any field, as in Spark's own inference."""
    if isinstance(kind, StructType):
        kept = [StructField(f.name, t) for f in kind.fields if (t := _texts(f.dataType)) is not None]
        return StructType(kept) if kept else None
    if isinstance(kind, ArrayType):
        inner = _texts(kind.elementType)
        return None if inner is None else ArrayType(inner)
    return StringType() if isinstance(kind, VariantType) else kind


def inferred_packets(raw: DataFrame, value: str = "value") -> DataFrame:
    """The records of one batch with the columns they have: kept columns, then a column for each field found.

    A field named like a kept column comes as `record_<name>`.
    """
    records = variant_records(raw, value)
    schema = inferred_schema(records)
    kept = [c for c in records.columns if c != "record"]
    name = lambda c: f"record_{c}" if c in kept else c
    parsed = F.from_json(F.to_json("record"), schema)
    rows = records.select(*[f"`{c}`" for c in kept], parsed.alias("_record"))
    return rows.select(*[f"`{c}`" for c in kept], *[F.col("_record").getField(f.name).alias(name(f.name)) for f in schema.fields])


#: A type that is no object, or array of them, without any field: what makes a column, read off `schema_of_variant`.
_LEAF = "(^|: |ARRAY<)(?!OBJECT<|ARRAY<)[A-Z]"


def _has(required: tuple[str, ...]) -> Column:
    """Whether some record of the group has each of the columns, be it null."""
    members = "map_entries(try_cast(record AS map<string, variant>))"
    columns = F.expr(f"transform(filter({members}, e -> schema_of_variant(e.value) RLIKE '{_LEAF}'), e -> e.key)")
    found = [F.bool_or(F.array_contains(columns, c)) for c in required]
    return F.coalesce(F.array_min(F.array(*found)), F.lit(False))


def inferred_gate(raw: DataFrame, batch: str | None = None, required: tuple[str, ...] = REQUIRED, value: str = "value") -> DataFrame:
    """Records of the batches whose inferred schema has all `required` columns at its top.

    What counts is the column, not its values: a field that is null in every record is a column too, one that holds only
    objects without fields is none.
    `batch` names the column telling batches apart; without it the frame is one batch.
    """
    records = variant_records(raw, value)
    if batch is None:
        return raw.where(records.agg(_has(required)).scalar())
    passed = records.groupBy(batch).agg(_has(required).alias("complete")).where("complete").select(batch)
    passed = written(passed, fresh_folder(raw.sparkSession, "inferred-gate"))  # measured and joined: parsed once
    return join_measured(raw, passed, batch, "left_semi")

"""Reading dumped records typed by the dictionary.

Lines are read as text in one scan over all studies and tables; no file is
opened to infer a schema. A line becomes a VARIANT, which keeps JSON's own
types apart (``"3"`` is text, ``3`` a number, ``null`` a value), or, with a
schema compiled from the dictionary, typed columns. A line that is no record is
a row of its own, with its place, and never a record with null fields.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BooleanType, DataType, DoubleType, LongType, StringType, StructField, StructType,
                               VariantType)

from strata.operators.positions import line_positions

#: Columns of a dumped line: its key, its position in the table's dump, the text.
LINE_KEY = ("study_id", "validation_id", "table_name", "snapshot_id")
_SIMPLE = {"string": StringType(), "integer": LongType(), "number": DoubleType(), "boolean": BooleanType()}


def node_of(table_name: Column) -> Column:
    """The node is what follows the study in ``<layer>_<study>_<node>``; a
    shorter name is a node itself."""
    parts = F.split(table_name, "_", 3)
    return F.when(F.size(parts) > 2, F.element_at(parts, 3)).otherwise(table_name)


def _lines(spark: SparkSession, root: str, validation_id: str | None) -> DataFrame:
    lines = spark.read.text(root).select(*LINE_KEY, F.col("value").alias("line")).filter(F.trim("line") != "")
    return lines if validation_id is None else lines.filter(F.col("validation_id") == validation_id)


def parse_lines(lines: DataFrame) -> DataFrame:
    """``lines`` (column ``line``) with ``record`` (VARIANT; null for a line
    that is no record), ``submitter_id`` and ``bad`` (what is wrong with the
    line, else null)."""
    # Inside brackets a second value or trailing text cannot go unseen. Each
    # inline of one element holds what is made once a line: a filter on a plain
    # column would be pushed below it and parse the line once more a mention.
    whole = lines.select("*", F.inline(F.array(F.struct(F.expr("try_parse_json(concat('[', line, ']'))").alias("__all")))))
    # A JSON value is an object exactly if it begins as one.
    bad = F.when(F.col("__all").isNull(), F.lit("not valid JSON")) \
        .when(F.expr("try_variant_get(__all, '$[1]', 'variant') IS NOT NULL"), F.lit("more than one value in a line")) \
        .when(~F.ltrim("line", F.lit(" \t\n\r")).startswith("{"), F.lit("not a JSON object"))
    judged = whole.select(*[F.col(f"`{c}`") for c in lines.columns], F.inline(F.array(F.struct(bad.alias("bad"), F.col("__all")))))
    record = F.when(F.col("bad").isNull(), F.expr("try_variant_get(__all, '$[0]', 'variant')"))
    one = judged.select(*[F.col(f"`{c}`") for c in lines.columns], "bad", F.inline(F.array(F.struct(record.alias("record")))))
    return one.withColumn("submitter_id", F.expr("try_variant_get(record, '$.submitter_id', 'string')"))


def read_records(spark: SparkSession, root: str, validation_id: str | None = None) -> DataFrame:
    """Every line of a dump prefix that is not blank: LINE_KEY, ``node``,
    ``index`` (0-based position in the dump of its study and table, files in
    path order), ``record``, ``submitter_id``, ``bad`` and, for a bad line, the
    ``line``. With a validation id only that run's folders are read.

    Each line is parsed once, and written with its place to the shared scratch
    folder; what is returned reads that table."""
    parsed = parse_lines(_lines(spark, root, validation_id)) \
        .withColumn("line", F.when(F.col("bad").isNotNull(), F.col("line"))) \
        .withColumn("node", node_of(F.col("table_name")))
    return line_positions(parsed, within=LINE_KEY, name="index")


def bad_lines(parsed: DataFrame, *, schema_version: str, validation_id: str) -> DataFrame:
    """One ERROR row per line that is no record, with its index."""
    null = F.lit(None).cast("string")
    return parsed.filter(F.col("bad").isNotNull()).select(
        F.lit(validation_id).alias("validation_id"), "index", "node", "study_id", F.lit("ERROR").alias("validation_result"),
        null.alias("invalid_key"), null.alias("schema_path"), F.lit("json").alias("validator"), null.alias("validator_value"),
        F.format_string("record %d of table '%s' is unreadable: %s", "index", "table_name", "bad").alias("validation_error"),
        F.lit(schema_version).alias("schema_version"), null.alias("submitter_id"))


def text_columns(parsed: DataFrame) -> dict[str, DataFrame]:
    """Good records per node as text: study_id, submitter_id and every key that
    the node's records hold (objects and lists as JSON, null as null). No type
    is inferred; the keys come from one aggregate and are metadata-sized."""
    good = parsed.filter(F.col("bad").isNull())
    keys: dict[str, list[str]] = {}
    held = good.select("node", F.explode(F.map_keys(F.expr("cast(record as map<string,variant>)"))).alias("key")).distinct()
    for r in held.orderBy("node", "key").collect():
        keys.setdefault(r.node, []).append(r.key)

    def text(name: str) -> Column:
        at = F.expr(f"try_variant_get(record, {path_literal(name)}, 'variant')")
        kind = F.schema_of_variant(at)
        return F.when(kind.rlike("^(OBJECT|ARRAY)"), F.to_json(at)).when(kind != "VOID", at.cast("string")).alias(name)
    return {node: good.filter(F.col("node") == node).select(
        "study_id", "submitter_id", *[text(k) for k in names if k not in ("study_id", "submitter_id")]) for node, names in keys.items()}


# ----------------------------------------------------------- compiled schemas


def spark_type(schema: dict) -> DataType:
    """The Spark type of a property's JSON schema. ``null`` beside one other
    type adds nothing, as every column may be null; where a value may be of
    several types, or its schema says nothing of types, it stays a VARIANT."""
    said = schema.get("type")
    names = [said] if isinstance(said, str) else [t for t in said or [] if t != "null"]
    if not names and "properties" in schema:
        names = ["object"]
    if not names and "enum" in schema and all(v is None or isinstance(v, str) for v in schema["enum"]):
        names = ["string"]
    if set(names) == {"integer", "number"}:
        names = ["number"]
    if len(names) != 1:
        return VariantType()
    if names[0] == "array" and isinstance(schema.get("items"), dict):
        return ArrayType(spark_type(schema["items"]))
    if names[0] == "object" and schema.get("properties"):
        return record_type(schema)
    return _SIMPLE.get(names[0], VariantType())


def record_type(schema: dict) -> StructType:
    """The StructType of a node's (or object's) schema, properties in order."""
    return StructType([StructField(p, spark_type(s if isinstance(s, dict) else {})) for p, s in (schema.get("properties") or {}).items()])


def typed_columns(parsed: DataFrame, schema: dict, links: tuple[str, ...] = ()) -> DataFrame:
    """The good records of one node as columns: study_id, index, submitter_id,
    the dictionary's properties in its types, the links' targets (text) and
    ``untyped``: the properties whose value is of another type (their column is
    null), so that no value is lost in silence. Inside objects and lists a
    value is cast as far as it can be."""
    fields = [f for f in record_type(schema) if f.name not in ("study_id", "index", "submitter_id", "untyped", *links)]
    good = parsed.filter(F.col("bad").isNull())

    def at(name: str, kind: str) -> str:
        return f"try_variant_get(record, {path_literal(name)}, '{kind}')"

    def cast(name: str, kind: DataType) -> Column:
        if isinstance(kind, VariantType):
            return F.expr(at(name, "variant"))
        # A cast would read text as numbers and numbers as text.
        return F.when(_fits(name, kind), F.expr(at(name, kind.simpleString())))

    def _fits(name: str, kind: DataType) -> Column:
        json = F.expr(f"schema_of_variant({at(name, 'variant')})")
        if isinstance(kind, LongType):
            number = F.expr(at(name, "double"))
            return (json == "BIGINT") | (json.rlike("^(DECIMAL|DOUBLE)") & (number == F.floor(number)))
        want = {"string": "^STRING", "double": "^(BIGINT|DECIMAL|DOUBLE|FLOAT)", "boolean": "^BOOLEAN"}
        return json.rlike(want.get(kind.simpleString(), "^OBJECT" if isinstance(kind, StructType) else "^ARRAY"))

    lost = [F.when(F.expr(f"schema_of_variant({at(f.name, 'variant')}) <> 'VOID'") & cast(f.name, f.dataType).isNull(), F.lit(f.name))
            for f in fields]
    untyped = F.array_compact(F.array(*lost)) if lost else F.array().cast("array<string>")
    return good.select(
        "study_id", "index", "submitter_id", *[cast(f.name, f.dataType).alias(f.name) for f in fields],
        *[F.expr(f"coalesce(try_variant_get(record, {path_literal(n, 'submitter_id')}, 'string'), {at(n, 'string')})").alias(n)
          for n in links], untyped.alias("untyped"))


def path_literal(*names: str) -> str:
    """A VARIANT path through the named keys, as a SQL literal."""
    path = "$"
    for n in names:
        if '"' in n and "'" in n:
            raise ValueError(f"a key with both kinds of quotes cannot be addressed: {n!r}")
        path += f"['{n}']" if '"' in n else f'["{n}"]'
    return "'" + path.replace("\\", "\\\\").replace("'", "\\'") + "'"

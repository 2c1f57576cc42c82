"""Aligning rows and column lists with a target's schema."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

#: A name that may reach a target; limits of numbers; how dates are written.
IDENTIFIER = r"^[a-zA-Z_][a-zA-Z0-9_]*$"
MAX_PRECISION, DEFAULT_SCALE, NUMERIC_DEFAULT = 18, 0, "0"
DATE_FORMAT, DATETIME_FORMAT = "yyyy-MM-dd", "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"
#: Source types that are not text.
NUMERIC_TYPES = ["int", "long", "double", "currency", "percent"]
DATE_TYPES = ["date", "datetime"]


def plain_name(name: str) -> str:
    return name.replace(".", "_").lower()


def augment(df: DataFrame, constants: Mapping[str, str]) -> DataFrame:
    """Append constant text columns. A constant that overlaps a column is refused."""
    clash = {plain_name(c) for c in df.columns} & {plain_name(c) for c in constants}
    if clash:
        raise ValueError(f"constants overlap columns: {sorted(clash)}")
    return df.select("*", *[F.lit(v).cast("string").alias(k, metadata={"origin": "augment"}) for k, v in constants.items()])


def project(df: DataFrame, target: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """The columns in the target's order and casing, matched without regard to case and with dots as underscores.

    Missing and extra columns are refused by name; ``keep`` lists hidden columns that follow.
    """
    own = {plain_name(c): c for c in df.columns if c not in keep}
    missing = [t for t in target if plain_name(t) not in own]
    extra = [c for p, c in own.items() if p not in {plain_name(t) for t in target}]
    if missing or extra:
        raise ValueError(f"columns do not fit the target: missing {missing}, extra {extra}")
    return df.select(*[F.col(f"`{own[plain_name(t)]}`").alias(t) for t in target], *keep)


def column_diff(provided: DataFrame, expected: DataFrame, owner: str = "owner") -> DataFrame:
    """How two listings ``(owner, position, name)`` differ: ``owner, issue, name, position``.

    ``missing`` and ``extra`` compare names without regard to case; ``casing`` are those that differ in case alone; ``order`` are the
    expected names at whose position another one stands, only for owners whose sets agree.
    """
    p = provided.select(F.col(owner).alias("owner"), F.col("position").alias("p_pos"), F.col("name").alias("p_name"), F.lower(F.replace("name", F.lit("."), F.lit("_"))).alias("k"))
    e = expected.select(F.col(owner).alias("owner"), F.col("position").alias("e_pos"), F.col("name").alias("e_name"), F.lower(F.replace("name", F.lit("."), F.lit("_"))).alias("k"))
    both = p.join(e, ["owner", "k"], "full")
    alone = (F.col("p_name").isNull() | F.col("e_name").isNull()).cast("int")
    both = both.withColumn("unequal", F.max(alone).over(Window.partitionBy("owner")))
    odd = F.when(F.col("p_name").isNull(), "missing").when(F.col("e_name").isNull(), "extra").when(F.col("p_name") != F.col("e_name"), "casing")
    moved = F.when((F.col("unequal") == 0) & (F.col("p_pos") != F.col("e_pos")), "order")
    issues = F.explode(F.array_compact(F.array(odd, moved))).alias("issue")
    return both.select("owner", issues, F.coalesce("e_name", "p_name").alias("name"), F.coalesce("e_pos", "p_pos").alias("position"))


def overlapping(provided: DataFrame, constants: DataFrame, owner: str = "owner") -> DataFrame:
    """``owner, name`` of provided columns that a constant of the same owner would overlap, in any case and with dots as underscores."""
    plain = lambda: F.lower(F.replace("name", F.lit("."), F.lit("_"))).alias("k")
    own = constants.select(F.col(owner).alias("owner"), plain())
    return provided.select(F.col(owner).alias("owner"), "name", plain()).join(own, ["owner", "k"], "left_semi").select("owner", "name")


def target_type(source_type: Column) -> Column:
    return F.when(source_type.isin(NUMERIC_TYPES), "Numeric").when(source_type.isin(DATE_TYPES), "Date").otherwise("Text")


def resolve_paths(paths: DataFrame, describe: DataFrame, depth: int) -> DataFrame:
    """Resolve ``paths(object, path)`` over ``describe(object, field, type, precision, scale, reference_to, relationship_name)``.

    All paths take a hop at a time: the relationship's name, in any case, leads to the first object that it refers to. Returns ``object,
    path, leaf_object, field, type, precision, scale, problem``; ``problem`` names the hop or field that was not found.
    """
    hops = describe.where("relationship_name is not null").select(
        F.col("object").alias("h_object"), F.lower("relationship_name").alias("h_name"), F.element_at("reference_to", 1).alias("h_to")
    )
    at = paths.select("object", "path", F.split("path", r"\.").alias("names"), F.col("object").alias("here"), F.lit(None).cast("string").alias("problem"))
    for i in range(depth):
        hop = F.when((F.size("names") - 1 > i) & F.col("problem").isNull(), F.get("names", F.lit(i)))
        at = at.join(hops, (F.col("here") == F.col("h_object")) & (F.lower(hop) == F.col("h_name")), "left").select(
            "object", "path", "names",
            F.when(hop.isNotNull(), F.coalesce("h_to", "here")).otherwise(F.col("here")).alias("here"),
            F.when(hop.isNotNull() & F.col("h_to").isNull(), hop).otherwise(F.col("problem")).alias("problem"),
        )
    leaf = F.element_at("names", -1)
    fields = describe.select(F.col("object").alias("f_object"), "field", "type", "precision", "scale")
    found = at.join(fields, (F.col("here") == F.col("f_object")) & (F.lower(leaf) == F.lower("field")) & F.col("problem").isNull(), "left")
    problem = F.coalesce("problem", F.when(F.col("field").isNull(), leaf))
    return found.select("object", "path", F.col("here").alias("leaf_object"), "field", target_type(F.col("type")).alias("type"), "precision", "scale", problem.alias("problem"))


def synthesised_fields(fields: DataFrame) -> DataFrame:
    """The target's fields for ``fields(target, position, name, label, type, precision, scale, format)``, types being the target's.

    Adds ``default_value`` and ``problem``: numbers have a precision from 1 to 18, a scale no larger and a default; dates have a format;
    names that are no identifiers or repeat within a target, in any case, are problems.
    """
    numeric, dated = F.col("type") == "Numeric", F.col("type") == "Date"
    precision = F.when(F.col("precision").between(1, MAX_PRECISION), F.col("precision")).otherwise(F.lit(MAX_PRECISION))
    scale = F.least(F.coalesce("scale", F.lit(DEFAULT_SCALE)), precision)
    repeated = fields.groupBy("target", F.lower("name").alias("k")).agg(F.count(F.lit(1)).alias("times"))
    marked = fields.withColumn("k", F.lower("name")).join(repeated, ["target", "k"])
    return marked.select(
        "target", "position", "name", "label", "type",
        F.when(numeric, precision).alias("precision"),
        F.when(numeric, scale).alias("scale"),
        F.when(numeric, F.lit(NUMERIC_DEFAULT)).alias("default_value"),
        F.when(dated, F.coalesce("format", F.lit(DATETIME_FORMAT))).alias("format"),
        F.when(~F.col("name").rlike(IDENTIFIER), "bad name").when(F.col("times") > 1, "duplicate").alias("problem"),
    )


FIELD = "struct<name:string,fullyQualifiedName:string,label:string,type:string,precision:int,scale:int,defaultValue:string,format:string>"
METADATA = f"struct<objects:array<struct<name:string,numberOfLinesToIgnore:int,fields:array<{FIELD}>>>>"


def metadata_json(fields: DataFrame) -> DataFrame:
    """``target, metadata``: one JSON document for each target from :func:`synthesised_fields`, in order of position."""
    field = F.struct(
        "name", F.col("name").alias("fullyQualifiedName"), "label", "type", F.col("precision").cast("int").alias("precision"), F.col("scale").cast("int").alias("scale"),
        F.col("default_value").alias("defaultValue"), "format",
    )
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("position", field.alias("field")))), lambda x: x["field"])
    form = F.struct(*[F.lit(v).alias(k) for k, v in (("charsetName", "UTF-8"), ("fieldsDelimitedBy", ","), ("fieldsEnclosedBy", '"'), ("linesTerminatedBy", "\n"), ("numberOfLinesToIgnore", 0))])
    grouped = fields.groupBy("target").agg(ordered.alias("fields"))
    top = F.struct(form.alias("fileFormat"), F.array(F.struct(F.col("target").alias("fullyQualifiedName"), F.col("target").alias("name"), "fields")).alias("objects"))
    return grouped.select("target", F.to_json(top).alias("metadata"))


def metadata_columns(metadata: Column) -> Column:
    """The column names that a target's metadata lists, in order; a document without any fails the job."""
    names = F.transform(F.from_json(metadata, METADATA)["objects"][0]["fields"], lambda f: f["fullyQualifiedName"])
    empty = names.isNull() | (F.size(names) == 0) | F.exists(names, lambda n: n.isNull())
    return F.when(empty, F.raise_error(F.lit("metadata without fields")).cast("array<string>")).otherwise(names)


def frame_fields(df: DataFrame, target: str) -> DataFrame:
    """The listing ``(target, position, name, label, type, precision, scale, format)`` of a frame's columns, for :func:`synthesised_fields`.

    Whole numbers and decimals keep their precision within the limits; other numbers get six places. What is neither number nor date is text.
    """
    rows = []
    for i, f in enumerate(df.schema):
        kind = "Numeric" if isinstance(f.dataType, T.NumericType) else "Date" if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)) else "Text"
        whole = isinstance(f.dataType, T.IntegralType)
        decimal = isinstance(f.dataType, T.DecimalType)
        precision, scale = (f.dataType.precision, f.dataType.scale) if decimal else (MAX_PRECISION, 0 if whole else 6)
        form = DATE_FORMAT if isinstance(f.dataType, T.DateType) else DATETIME_FORMAT
        rows.append((target, i, f.name, f.name, kind, precision, scale, form if kind == "Date" else None))
    return df.sparkSession.createDataFrame(rows, "target string, position int, name string, label string, type string, precision int, scale int, format string")


def synthesised_metadata(df: DataFrame, target: str) -> dict:
    """The metadata document of a frame's columns; names that are no identifiers, or repeat in any case, are refused."""
    wrong = F.raise_error(F.concat(F.lit("column cannot be described: "), "name", F.lit(" ("), "problem", F.lit(")"))).cast("string")
    fields = synthesised_fields(frame_fields(df, target)).withColumn("name", F.when(F.col("problem").isNull(), F.col("name")).otherwise(wrong))
    return json.loads(metadata_json(fields).first()["metadata"])


def document_fields(document: Mapping) -> list[dict]:
    """The fields of a metadata document, each with a name; a document without any is refused."""
    found = (document.get("objects") or [{}])[0].get("fields") or []
    if not found or any(not f.get("fullyQualifiedName") for f in found):
        raise ValueError("metadata without fields")
    return [{**f, "name": f["fullyQualifiedName"]} for f in found]


def as_described(df: DataFrame, document: Mapping) -> DataFrame:
    """Rows of text as the types that a metadata document declares (see :func:`typed_load`); columns of other types stay as they are."""
    fields = {plain_name(f["name"]): f for f in document_fields(document)}
    text = {c for c in df.columns if isinstance(df.schema[c].dataType, T.StringType)}
    return df.select(*[_typed(c, fields[plain_name(c)], False).alias(c) if c in text and plain_name(c) in fields else F.col(f"`{c}`") for c in df.columns])


def resolve_metadata(existing: Column, synthesised: Column, override: Column) -> Column:
    return F.when(override | existing.isNull(), synthesised).otherwise(existing)


def _typed(name: str, field: Mapping, lenient: bool) -> Column:
    text = F.nullif(F.col(f"`{name}`"), F.lit(""))
    if field["type"] == "Numeric":
        kind = T.DecimalType(int(field["precision"]), int(field["scale"]))
        return F.coalesce(text.try_cast(kind) if lenient else text.cast(kind), F.lit(0).cast(kind))
    if field["type"] == "Date":
        form = field.get("format") or DATETIME_FORMAT
        if form == DATE_FORMAT:
            return text.try_cast("date") if lenient else text.cast("date")
        form = form.replace("XXX", "XX")  # offsets are written without a colon
        return F.try_to_timestamp(text, F.lit(form)) if lenient else F.to_timestamp(text, form)
    return F.col(f"`{name}`")


def typed_load(df: DataFrame, fields: Sequence[Mapping]) -> DataFrame:
    """Text columns as the types that the target declares: empty numbers are 0, empty dates null, and a malformed cell fails the job."""
    return df.select(*[_typed(f["name"], f, False).alias(f["name"]) for f in fields])


def bad_cells(df: DataFrame, fields: Sequence[Mapping]) -> DataFrame:
    """How many cells of each column would fail :func:`typed_load`, in one pass: one row."""
    counts = []
    for f in fields:
        text = F.nullif(F.col(f"`{f['name']}`"), F.lit(""))
        cast = text.try_cast(T.DecimalType(int(f["precision"]), int(f["scale"]))) if f["type"] == "Numeric" else _typed(f["name"], f, True)
        counts.append(F.count_if(text.isNotNull() & cast.isNull()).alias(f["name"]))
    return df.agg(*counts)

"""Landing-zone readers: service responses stored as JSON, one document per
line (NDJSON), in a directory per endpoint.

Transport is not part of this library: whatever fetches pages drops them
into the landing directory; these readers turn them into DataFrames in
parallel (one task per file split) and never collect documents to the driver.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.errors import SchemaMismatch
from ledgerline.functions.shape import flatten_structs, to_ndjson
from ledgerline.session import counted, scratch

#: White space around a JSON value.
BLANKS = " \t\r\n"

# --- writing landing files (used by fixtures, tests and the stream sources) --


def land_ndjson(df: DataFrame, path: str) -> str:
    """Write each row as one JSON line."""
    to_ndjson(df).write.mode("errorifexists").text(path)
    return path


def land_text(docs: DataFrame, path: str, column: str = "value", compression: str = "none",
              file_rows: int = 0) -> str:
    """Write a text column, one document per line. A compressed file is read by one task, so state
    with ``compression`` how many documents (``file_rows``) a file takes at most."""
    docs.select(F.col(column).alias("value")).write.mode("errorifexists").option(
        "maxRecordsPerFile", file_rows).text(path, compression=compression)
    return path


def page_documents(rows: DataFrame, key: str, page: Column, total: int | None = None,
                   next_page: bool = False, keep_nulls: bool = False) -> DataFrame:
    """Group rows into response pages ``{key: [rows], meta: {total}, nextPageId}``.

    ``page`` must give bounded groups (e.g. a dense id divided by the page
    size); each page is built by one aggregate group.
    """
    cols = [F.col(f"`{c}`") for c in rows.columns]
    grouped = rows.groupBy(page.alias("_page")).agg(F.collect_list(F.struct(*cols)).alias(key))
    out = [F.col(key)]
    if total is not None:
        out.append(F.struct(F.lit(total).cast("bigint").alias("total")).alias("meta"))
    if next_page:
        out.append((F.col("_page") + 1).alias("nextPageId"))
    opts = {"ignoreNullFields": "false"} if keep_nulls else None
    return grouped.select(F.to_json(F.struct(*out), opts).alias("value"), F.col("_page"))


# --- readers -------------------------------------------------------------

def _string_schema(dtype: T.DataType) -> T.DataType:
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f.name, _string_schema(f.dataType)) for f in dtype.fields])
    return T.StringType()


def _typed(c: Column, dtype: T.DataType, name: str) -> Column:
    """Text of a JSON value -> the schema type; a non-null value that does
    not convert fails the job (the warehouse loader rejects it too)."""
    if isinstance(dtype, T.StructType):
        return F.when(c.isNotNull(), F.struct(*[
            _typed(c.getField(f.name), f.dataType, f"{name}.{f.name}").alias(f.name)
            for f in dtype.fields]))
    if isinstance(dtype, T.StringType):
        return c
    if isinstance(dtype, T.IntegralType):
        as_double = c.try_cast("double")
        v = F.coalesce(c.try_cast("bigint"),
                       F.when(as_double == F.floor(as_double), as_double.try_cast("bigint")))
    else:
        v = c.try_cast(dtype)
    return F.when(c.isNull() | v.isNotNull(), v).otherwise(
        F.raise_error(F.concat(F.lit(f"cannot load {name}: "), c)).cast(dtype))


def read_ndjson_typed(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """JSON lines under a fixed (nested) schema.

    Read as text per field, then cast: plain typed JSON reading would turn
    ``"12"`` or ``5.0`` in a BIGINT field into a silent null. Fields outside
    the schema are ignored.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    raw = spark.read.schema(_string_schema(schema)).json(path)
    return _cast_fields(raw, schema)


def typed_rows(texts: DataFrame, column: str, schema: T.StructType | str) -> DataFrame:
    """S1 on JSON object text held in a column (e.g. rows exploded from pages)."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    raw = texts.select(F.from_json(F.col(column), _string_schema(schema)).alias("_r")).select("_r.*")
    return _cast_fields(raw, schema)


def _cast_fields(raw: DataFrame, schema: T.StructType) -> DataFrame:
    return raw.select(*[_typed(F.col(f"`{f.name}`"), f.dataType, f.name).alias(f.name)
                        for f in schema.fields])


def outside_schema(c: Column, schema: T.StructType | str) -> Column:
    """Whether a JSON object in text has top-level fields that the fixed schema lacks."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    known = F.array(*[F.lit(f.name) for f in schema.fields])
    return F.size(F.array_except(F.coalesce(F.json_object_keys(c), F.array().cast("array<string>")), known)) > 0


def fields_outside_schema(spark: SparkSession, path: str, schema: T.StructType | str) -> int:
    """Number of JSON lines carrying top-level fields the fixed schema does
    not have (those fields are not loaded; this reports them). One pass."""
    return spark.read.text(path).agg(F.count_if(outside_schema(F.col("value"), schema))).first()[0]


def read_ndjson_inferred(spark: SparkSession, path: str, sampling_ratio: float = 1.0) -> DataFrame:
    """JSON lines with the schema inferred by Spark (a scan over a
    ``sampling_ratio`` sample before the read)."""
    return spark.read.option("samplingRatio", sampling_ratio).json(path)


def is_json(c: Column) -> Column:
    """Whether a text is one whole JSON object or list (false for null).

    A JSON reader stops behind the first value it finds, so a text with
    anything behind that would pass. Here the text is read as the first item of
    a list that ends in a mark, the text's own hash: only if the text is exactly
    one value does the list have two items of which the second is the mark.
    Single quotes are no JSON.
    """
    text = F.trim(c, F.lit(BLANKS))
    mark = F.hex(F.xxhash64(text))
    items = F.from_json(F.concat(F.lit("["), text, F.lit(',"'), mark, F.lit('"]')), "array<string>",
                        {"allowSingleQuotes": "false"})
    return F.coalesce((text.startswith("{") | text.startswith("[")) & (F.size(items) == 2)
                      & (F.get(items, F.lit(1)) == mark), F.lit(False))


def staged_check(rows: DataFrame, good: Column, record: Column, stage: str,
                 drop: Sequence[str] = ()) -> tuple[DataFrame, DataFrame, dict]:
    """Split ``rows`` by ``good`` while reading them once.

    They are written to ``stage`` and counted on the way, without the columns
    ``drop`` that only ``good`` and ``record`` read. Returns the good rows, the
    others as text (``record``), and how many ``rows`` there were and were
    ``rejected``.
    """
    seen = Observation()
    flagged = rows.withColumn("_good", F.coalesce(good, F.lit(False)))
    flagged = flagged.withColumn("_record", F.when(~F.col("_good"), record)).drop(*drop).observe(
        seen, F.count(F.lit(1)).alias("rows"), F.count_if(~F.col("_good")).alias("rejected"))
    flagged.write.partitionBy("_good").parquet(stage)
    back = rows.sparkSession.read.schema(flagged.schema).parquet(stage)
    return (back.filter(F.col("_good")).select(*[f"`{c}`" for c in rows.columns if c not in drop]),
            back.filter(~F.col("_good")).select(F.col("_record").alias("record")),
            {"rows": 0, "rejected": 0} | counted(seen))


def _elements(doc: Column) -> Column:
    """Documents -> JSON text of each row object: an object is one row, a
    list gives its items, a list of lists its flattened items."""
    txt = F.trim(doc, F.lit(BLANKS))
    is_list = txt.startswith("[")
    nested = F.from_json(txt, "array<array<string>>")
    flat = F.from_json(txt, "array<string>")
    return (F.when(~is_list, F.array(txt))
             .when(nested.isNotNull(), F.flatten(nested))
             .otherwise(flat))


def response_rows(docs: DataFrame, schema: T.StructType | str, column: str = "value") -> DataFrame:
    """S3: rows of response documents; items that are not objects give an
    all-null row and an empty list gives no row. Documents that are not whole
    JSON (truncated, error pages) give no row; the jobs store them as rejected."""
    items = docs.filter(is_json(F.col(column))).select(F.explode(_elements(F.col(column))).alias("item"))
    obj = F.trim(F.col("item")).startswith("{")
    empty = F.from_json(F.lit("{}"), schema)
    return items.select(F.when(obj, F.from_json("item", schema)).otherwise(empty).alias("r")) \
                .select("r.*")


def response_items(docs: DataFrame, column: str = "value") -> DataFrame:
    """S3 as JSON text in ``item``, one per row object (``{}`` for items that are no objects)."""
    items = docs.filter(is_json(F.col(column))).select(F.explode(_elements(F.col(column))).alias("item"))
    obj = F.trim(F.col("item")).startswith("{")
    return items.select(F.when(obj, F.col("item")).otherwise(F.lit("{}")).alias("item"))


def response_rows_inferred(docs: DataFrame, stage: str, column: str = "value") -> DataFrame:
    """S3 when the row schema is not known: the row objects are written once
    to ``stage`` (one JSON line each, ``{}`` for non-object items) and read
    back with Spark's schema inference. Only valid rows take part in the
    inference, and the stage cuts the lineage to the landing files."""
    response_items(docs, column).select(F.col("item").alias("value")).write.mode("errorifexists").text(stage)
    return docs.sparkSession.read.json(stage)


def item_ids(items: DataFrame, field: str, kind: str) -> DataFrame:
    """P2 on JSON objects in ``item``: the distinct values of ``field`` that are of type ``kind``."""
    return items.select(F.get_json_object("item", f"$.{field}").try_cast(kind).alias(field)).dropna().distinct()


def listed_items(docs: DataFrame, path: str | None = None, column: str = "value",
                 keep: Sequence[str] = ()) -> DataFrame:
    """S6 on text: one row per object listed under ``path`` of the documents in
    ``column`` (in the document itself without one), as JSON text in ``item``,
    beside the ``keep`` columns. What is there but is not a list gives no row."""
    text = F.get_json_object(F.col(column), f"$.{path}") if path else F.col(column)
    items = F.when(F.trim(text, F.lit(BLANKS)).startswith("["), F.from_json(text, "array<string>"))
    return (docs.select(*keep, F.explode(items).alias("item"))
                .filter(F.ltrim(F.col("item")).startswith("{")))


def rows_inferred(items: DataFrame, stage: str, as_text: bool = False) -> DataFrame:
    """Rows of the JSON objects in ``item`` beside the other columns of
    ``items``, which win over row fields of the same name. The objects are
    written once to ``stage`` and only they take part in the inference, so no
    other landed document decides a type. ``as_text`` leaves numbers and
    booleans as text. Without any object the frame has no columns."""
    spark = items.sparkSession
    keep = [f for f in items.schema.fields if f.name != "item"]
    line = F.concat(F.lit('{"row":'), F.col("item"), F.lit(',"keep":'),
                    F.to_json(F.struct(*[F.col(f"`{f.name}`") for f in keep])) if keep else F.lit("{}"),
                    F.lit("}"))
    items.select(line.alias("value")).write.mode("errorifexists").text(stage)
    reader = spark.read.option("primitivesAsString", as_text)
    found = reader.json(stage).schema
    row = found["row"].dataType if "row" in found.names else None
    if not isinstance(row, T.StructType):
        return spark.createDataFrame([], T.StructType([]))
    kept = T.StructType([T.StructField(f.name, f.dataType) for f in keep])
    staged = reader.schema(T.StructType([T.StructField("keep", kept), T.StructField("row", row)])).json(stage)
    return staged.select(*[F.col("keep")[f.name].alias(f.name) for f in keep],
                         *[F.col("row")[n].alias(n) for n in row.names if n not in kept.names])


# --- exact values: documents as VARIANT --------------------------------------------

def listed_variants(docs: DataFrame, path: str | None = None, column: str = "value",
                    keep: Sequence[str] = ()) -> DataFrame:
    """``listed_items`` with every object as a VARIANT in ``item``: numbers keep all
    their digits. A document that VARIANT refuses (``NaN``, a key twice in one
    object) fails the batch; what is there but is not a list gives no row."""
    parsed = F.parse_json(F.col(column))
    whole = F.try_variant_get(parsed, f"$.{path}" if path else "$", "array<variant>")
    return docs.select(*keep, F.explode(whole).alias("item")).filter(
        F.schema_of_variant("item").startswith("OBJECT<"))


def _settled(t: T.DataType, decimals: bool, at: str = "") -> T.DataType:
    """Column type for an inferred variant type: text for values of several kinds or none at all."""
    if isinstance(t, (T.NullType, T.VariantType)):
        return T.StringType()
    if isinstance(t, T.DecimalType) and not decimals:
        return T.DoubleType()
    if isinstance(t, T.ArrayType):
        return T.ArrayType(_settled(t.elementType, decimals, at))
    if isinstance(t, T.StructType):
        seen: dict[str, str] = {}
        for name in t.names:
            if seen.setdefault(name.lower(), name) != name:
                raise SchemaMismatch(f"fields differ in case alone: {at}{seen[name.lower()]}, {at}{name}")
        return T.StructType([T.StructField(f.name, _settled(f.dataType, decimals, f"{at}{f.name}.")) for f in t.fields])
    return t


def _ddl(t: T.DataType) -> str:
    if isinstance(t, T.StructType):
        return "struct<" + ", ".join(f"`{f.name.replace('`', '``')}`: {_ddl(f.dataType)}" for f in t.fields) + ">"
    return f"array<{_ddl(t.elementType)}>" if isinstance(t, T.ArrayType) else t.simpleString()


def rows_of_variants(items: DataFrame, stage: str, decimals: bool = True) -> DataFrame:
    """Rows of the VARIANT objects in ``item`` beside the other columns of ``items``, which win over
    row fields of the same name.

    The landed text is parsed once, into ``stage``; the row type is one
    aggregation over the parsed values (merged per field: whole numbers BIGINT
    where they fit, other exact numbers DECIMAL, or DOUBLE without ``decimals``),
    and every field is read by its path. Values of several kinds become text.
    Names that differ in case alone are refused (``SchemaMismatch``). Without
    any object the frame has no columns.
    """
    spark = items.sparkSession
    items.write.mode("errorifexists").parquet(stage)
    held = spark.read.schema(items.schema).parquet(stage)
    # a session of its own, in which names that differ in case are not merged
    strict = spark.newSession()
    strict.conf.set("spark.sql.caseSensitive", "true")
    found = strict.read.schema(items.schema).parquet(stage).agg(F.schema_of_variant_agg("item")).first()[0]
    if not (found or "").startswith("OBJECT<") or found == "OBJECT<>":
        return spark.createDataFrame([], T.StructType([]))
    kind = _settled(T.StructType.fromDDL("item " + found.replace("OBJECT<", "STRUCT<"))["item"].dataType, decimals)
    keep = [c for c in items.columns if c != "item"]

    def field(f: T.StructField) -> Column:
        quote = '"' if "'" in f.name else "'"
        if quote == '"' and '"' in f.name:
            raise SchemaMismatch(f"a field's name holds both kinds of quotes: {f.name}")
        return F.variant_get("item", f"$[{quote}{f.name}{quote}]", _ddl(f.dataType)).alias(f.name)

    return held.select(*[f"`{c}`" for c in keep], *[field(f) for f in kind.fields if f.name not in keep])


def read_documents(spark: SparkSession, path: str, schema: T.StructType | str | None = None):
    """Response documents, one per line, typed by ``schema`` or inferred."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def keyed_rows(docs: DataFrame, key: str) -> DataFrame:
    """The rows listed under ``key`` (a dotted path allowed, e.g.
    ``registrants.data``); documents where it is absent, null or not a list
    give no rows."""
    return docs.select(F.inline(F.col(key)))


def keyed_doc(docs: DataFrame, key: str) -> DataFrame:
    """One row per document, from the object under ``key``."""
    return docs.filter(F.col(key).isNotNull()).select(f"{key}.*")


def result_rows_flat(docs: DataFrame, key: str = "result") -> DataFrame:
    """Rows under ``key`` with nested objects flattened to ``a_b_c``."""
    return flatten_structs(keyed_rows(docs, key))


def read_valid_documents(spark: SparkSession, path: str, schema: T.StructType | str):
    """Documents that are one whole JSON object or list with values of
    their types; returns (rows, number dropped), both from one read."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    full = T.StructType(list(schema.fields) + [T.StructField("_corrupt_record", T.StringType())])
    parsed = F.from_json("value", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    rows = spark.read.text(path).select("value", is_json(F.col("value")).alias("whole"), parsed.alias("r"))
    good, _, counts = staged_check(rows.select("value", "whole", "r.*"),
                                   F.col("whole") & F.col("_corrupt_record").isNull(), F.col("value"),
                                   scratch(spark, "documents"), drop=["value", "whole", "_corrupt_record"])
    return good.select(*[f"`{f.name}`" for f in schema.fields]), counts["rejected"]


def lenient_json(c: Column, schema: T.StructType | str) -> Column:
    """JSON text, or the same written as a Python literal (single
    quotes, None/True/False); anything else fails the job. Valid JSON is taken
    as it is; only text that is not JSON is read as a literal."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    full = T.StructType(list(schema.fields) + [T.StructField("_corrupt_record", T.StringType())])
    options = {"allowSingleQuotes": "false", "columnNameOfCorruptRecord": "_corrupt_record"}
    plain = F.from_json(c, full, options)
    literal = F.from_json(_literal_as_json(c), full, options)

    def row(parsed: Column) -> Column:
        return F.struct(*[parsed[f.name].alias(f.name) for f in schema.fields])

    return (F.when(c.isNull() | plain["_corrupt_record"].isNull(), row(plain))
             .when(literal["_corrupt_record"].isNull(), row(literal))
             .otherwise(F.raise_error(F.concat(F.lit("invalid JSON string provided: "), c)).cast(schema)))


def json_or_literal(c: Column) -> Column:
    """S10 for a whole document: JSON as it is, a Python literal as JSON, null for anything else."""
    literal = _literal_as_json(c)
    return F.when(is_json(c), c).when(is_json(literal), literal)


def _literal_as_json(c: Column) -> Column:
    """A Python literal as JSON text. The text is cut into quoted and bare
    pieces by one linear expression (no backtracking, so long documents are
    safe); single-quoted pieces are re-quoted, words change in bare ones only."""
    backslash, single, double = "\u0001", "\u0002", "\u0003"      # escapes, set aside while cutting
    aside = F.replace(F.replace(F.replace(c, F.lit("\\\\"), F.lit(backslash)),
                                F.lit("\\'"), F.lit(single)), F.lit('\\"'), F.lit(double))
    pieces = F.regexp_extract_all(aside, F.lit("""('[^']*+'|"[^"]*+"|[^'"]++|['"])"""), F.lit(1))

    def rewrite(piece: Column) -> Column:
        inner = F.substring(piece, F.lit(2), F.length(piece) - 2)
        bare = piece
        for word, value in (("None", "null"), ("True", "true"), ("False", "false")):
            bare = F.regexp_replace(bare, rf"\b{word}\b", value)
        return (F.when(piece.startswith("'") & (F.length(piece) > 1),
                       F.concat(F.lit('"'), F.replace(inner, F.lit('"'), F.lit('\\"')), F.lit('"')))
                 .when(piece.startswith('"'), piece).otherwise(bare))

    joined = F.array_join(F.transform(pieces, rewrite), "")
    return F.replace(F.replace(F.replace(joined, F.lit(double), F.lit('\\"')),
                               F.lit(single), F.lit("'")), F.lit(backslash), F.lit("\\\\"))


def recent_window(df: DataFrame, ts_col: str, as_of: dt.date, days: int = 30,
                  n: int = 100, tie_break: Sequence[str] = ()) -> DataFrame:
    """Rows of the last ``days`` days before ``as_of`` (inclusive),
    newest first, first page of ``n`` (Spark runs it as a per-partition
    top-n and a merge of n rows per partition)."""
    c = F.col(ts_col)
    since = F.lit(as_of - dt.timedelta(days=days)).cast(df.schema[ts_col].dataType)
    order = [c.desc()] + [F.col(t).desc() for t in tie_break]
    return df.filter(c >= since).orderBy(*order).limit(n)

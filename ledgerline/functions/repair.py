"""Type repair for service responses: numeric narrowing, fixed-format
timestamps, durations, epoch/ISO creation times.

All of it is Spark expressions (codegen, no Python per row). Bad input that
the source system treats as an error raises through ``raise_error`` on the
executors, so a job fails instead of loading wrong values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Text that counts as a number: decimal or scientific notation, surrounding
# blanks allowed, and the float words inf / infinity / nan.
NUMERIC_TEXT = (r"^\s*[+-]?((\d+(\.\d*)?)|(\.\d+))([eE][+-]?\d+)?\s*$"
                r"|^\s*[+-]?(?i:inf|infinity|nan)\s*$")


def _clean_double(d: Column) -> Column:
    """NaN and ±infinity become null."""
    return F.when(F.isnan(d) | (F.abs(d) == F.lit(float("inf"))), F.lit(None)).otherwise(d)


def _as_double(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StringType):
        return _clean_double(F.when(F.trim(c).rlike(NUMERIC_TEXT),
                                    F.trim(c).try_cast("double")))
    return _clean_double(c.cast("double"))


def _as_whole(c: Column, dtype: T.DataType) -> Column:
    """The value as BIGINT where it is a whole number in range, else null.
    Integers never pass through DOUBLE, so those above 2^53 keep their value."""
    if isinstance(dtype, (T.IntegralType, T.BooleanType, T.NullType)):
        return c.cast("bigint")
    if isinstance(dtype, T.DecimalType):
        return F.when(c == F.floor(c), c.try_cast("bigint"))
    d = _as_double(c, dtype)
    whole = F.when((d == F.floor(d)) & (F.abs(d) < F.lit(2.0 ** 63)), d.cast("bigint"))
    if isinstance(dtype, T.StringType):
        return F.coalesce(F.trim(c).try_cast("bigint"), whole)
    return whole


def numeric_profile(df: DataFrame, columns: list[str] | None = None) -> dict[str, dict]:
    """Pass 1 of T1: one aggregate over all candidate columns.

    Returns per column ``{"numeric": bool, "whole": bool}``.
    """
    fields = [f for f in df.schema.fields if columns is None or f.name in columns]
    aggs, names = [], []
    for f in fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, T.StringType):
            # most cells are plain integers or plainly something else: the pattern decides the rest
            integer = F.trim(c).try_cast("bigint").isNotNull()
            blank = c.isNull() | (F.trim(c) == "")
            numeric = F.bool_and(F.when(integer | blank, F.lit(True)).otherwise(F.trim(c).rlike(NUMERIC_TEXT)))
        elif isinstance(t, (T.NumericType, T.BooleanType, T.NullType)):
            numeric = F.lit(True)
        else:
            continue
        if isinstance(t, (T.IntegralType, T.BooleanType, T.NullType)):
            whole = F.lit(True)
        else:
            fits = _as_double(c, t).isNull() | _as_whole(c, t).isNotNull()
            if isinstance(t, T.StringType):
                fits = F.when(integer, F.lit(True)).otherwise(fits)
            whole = F.coalesce(F.bool_and(fits), F.lit(True))
        aggs += [F.coalesce(numeric, F.lit(True)).alias(f"n{len(names)}"),
                 whole.alias(f"w{len(names)}")]
        names.append(f.name)
    if not names:
        return {}
    row = df.agg(*aggs).first()
    return {n: {"numeric": bool(row[f"n{i}"]), "whole": bool(row[f"w{i}"])}
            for i, n in enumerate(names)}


def narrow_numeric(df: DataFrame, fill_null: int | None = 0,
                   profile: dict[str, dict] | None = None) -> DataFrame:
    """Per column, when every non-null value is numeric, make it a
    number; infinities become null; when every remaining value is whole the
    column becomes BIGINT with nulls filled by ``fill_null`` (0 as in the
    source system; booleans become 0/1 and all-null columns all 0), otherwise
    DOUBLE keeping nulls. Other columns are untouched.

    ``profile`` (from ``numeric_profile``) can be pinned, e.g. from the target
    table in a stream, to avoid the eager profiling pass.
    """
    prof = profile if profile is not None else numeric_profile(df)
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        p = prof.get(f.name)
        if p is None or not p["numeric"]:
            out.append(c)
            continue
        if p["whole"]:
            v = _as_whole(c, f.dataType)
            if fill_null is not None:
                v = F.coalesce(v, F.lit(fill_null).cast("bigint"))
        else:
            v = _as_double(c, f.dataType)
        out.append(v.alias(f.name))
    return df.select(*out)


# --- timestamps and durations -------------------------------------------------

WEEKDAY_PREFIX = r"^(?i:mon|tue|wed|thu|fri|sat|sun), "
FIXED_TS_FORMAT = "d MMM yyyy, h:mm a"


def parse_fixed_ts(c: Column) -> Column:
    """``Thu, 17 Apr 2025, 10:30 AM`` -> UTC timestamp; anything else null.

    The weekday must be a weekday abbreviation; like the source parser it is
    not checked against the date.
    """
    return F.when(c.rlike(WEEKDAY_PREFIX),
                  F.try_to_timestamp(F.regexp_replace(c, WEEKDAY_PREFIX, ""),
                                     F.lit(FIXED_TS_FORMAT)))


DURATION = r"^([+-]?)(\d+):([0-5]?\d):([0-5]?\d(\.\d+)?)$"


def duration_minutes(c: Column) -> Column:
    """T4: ``HH:MM:SS`` (hours may exceed 24, fractional seconds allowed) ->
    minutes as DOUBLE. Null, blank and ``nan`` give null; any other text
    fails the job."""
    txt = F.trim(c)
    parts = F.split(F.regexp_replace(txt, r"^[+-]", ""), ":")
    seconds = (parts.getItem(0).cast("double") * 3600 + parts.getItem(1).cast("double") * 60
               + parts.getItem(2).cast("double"))
    sign = F.when(txt.startswith("-"), F.lit(-1.0)).otherwise(F.lit(1.0))
    return (F.when(c.isNull() | (txt == "") | (F.lower(txt).isin("nan", "nat")),
                   F.lit(None).cast("double"))
             .when(txt.rlike(DURATION), sign * seconds / 60)
             .otherwise(F.raise_error(F.concat(F.lit("not a HH:MM:SS duration: "), c))
                        .cast("double")))


ISO_WITH_OFFSET = (r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?"
                   r"(Z|[+-]\d{2}:\d{2})$")
EPOCH_MILLIS = r"^-?\d+$"


def parse_creation_ts(c: Column, dtype: T.DataType = T.StringType()) -> Column:
    """ISO text with a zone offset, or epoch milliseconds -> UTC timestamp.
    Zone-less or other text fails the job (it is ambiguous)."""
    if isinstance(dtype, T.NumericType):
        return F.timestamp_millis(c.cast("bigint"))
    txt = F.trim(c)
    return (F.when(c.isNull(), F.lit(None).cast("timestamp"))
             .when(txt.rlike(ISO_WITH_OFFSET), txt.cast("timestamp"))
             .when(txt.rlike(EPOCH_MILLIS), F.timestamp_millis(txt.cast("bigint")))
             .otherwise(F.raise_error(F.concat(F.lit("creation time without a zone: "), c))
                        .cast("timestamp")))


def as_text(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(c)
    return c.cast("string")


def stringify_then_ids(df: DataFrame, id_columns: list[str],
                       keep: Sequence[str] = ()) -> DataFrame:
    """T5: every column to text (null stays null), then the id columns to
    BIGINT; ``keep`` columns (added by the job, not the response) untouched."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.name in keep:
            out.append(c)
        elif f.name in id_columns:
            out.append(F.trim(as_text(c, f.dataType)).cast("bigint").alias(f.name))
        else:
            out.append(as_text(c, f.dataType).alias(f.name))
    return df.select(*out)


def repair_registrants(df: DataFrame, ts_fields, duration_fields, id_fields,
                       keep: Sequence[str] = ()) -> DataFrame:
    """Registrant rows: T5, then T3 on the timestamp fields and T4 on the durations."""
    df = stringify_then_ids(df, [c for c in id_fields if c in df.columns], keep)
    cols = {}
    for c in ts_fields:
        if c in df.columns:
            cols[c] = parse_fixed_ts(F.col(c))
    for c in duration_fields:
        if c in df.columns:
            cols[c] = duration_minutes(F.col(c))
    return df.withColumns(cols)

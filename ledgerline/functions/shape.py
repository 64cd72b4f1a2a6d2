"""Column shaping: flattening, projection, tagging and list-to-text."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class ColumnCollision(ValueError):
    """Two source paths flatten to the same column name."""


def _leaves(schema: T.StructType, prefix: tuple[str, ...] = ()):
    for f in schema.fields:
        path = prefix + (f.name,)
        if isinstance(f.dataType, T.StructType):
            # an empty object contributes no column
            yield from _leaves(f.dataType, path)
        else:
            yield path


def _ref(path: Sequence[str]) -> Column:
    c = F.col(f"`{path[0]}`")
    for part in path[1:]:
        c = c.getField(part)
    return c


def flat_name(path: Sequence[str], sep: str = "_") -> str:
    """P10: nested path to a column name; dots inside a name become ``sep`` too."""
    return sep.join(path).replace(".", sep)


def flatten_structs(df: DataFrame, sep: str = "_") -> DataFrame:
    """S7 walk: every nested record field becomes a top-level column named by
    its path (``a.b.c`` -> ``a_b_c``); lists are kept as they are."""
    out, seen = [], {}
    for path in _leaves(df.schema):
        name = flat_name(path, sep)
        if name in seen:
            raise ColumnCollision(f"{'.'.join(path)} and {'.'.join(seen[name])} both map to {name}")
        seen[name] = path
        out.append(_ref(path).alias(name))
    return df.select(*out)


def project_struct_fields(df: DataFrame, fields: Mapping[str, str]) -> DataFrame:
    """``{"output_name": "record.field"}`` projections."""
    return df.select(*[_ref(path.split(".")).alias(name) for name, path in fields.items()])


def tag_columns(df: DataFrame, tags: Mapping[str, object]) -> DataFrame:
    """Constant columns such as fetched_at, date, integration_type."""
    return df.withColumns({k: (v if isinstance(v, Column) else F.lit(v)) for k, v in tags.items()})


def select_metrics(df: DataFrame, keep: Sequence[str], metrics: Sequence[str],
                   dtype: str = "double") -> DataFrame:
    """The key columns plus a fixed metric list; absent metrics are null."""
    have = set(df.columns)
    cols = [F.col(k) for k in keep]
    cols += [(F.col(m) if m in have else F.lit(None)).cast(dtype).alias(m) for m in metrics]
    return df.select(*cols)


def _element_text(dtype: T.DataType, x: Column) -> Column:
    if isinstance(dtype, T.BooleanType):
        return F.when(x, F.lit("True")).when(~x, F.lit("False"))
    if isinstance(dtype, (T.StructType, T.MapType, T.ArrayType)):
        return F.to_json(x)
    return x.cast("string")


def list_text(c: Column, element_type: T.DataType) -> Column:
    """T6 for one column: elements joined with ',' (null elements as ``None``)."""
    return F.array_join(F.transform(c, lambda x: _element_text(element_type, x)), ",", "None")


def text_list_text(c: Column) -> Column:
    """T6 for a text column whose values may be JSON lists (a key that mixes
    lists and scalars is read as text): list values are joined like list
    columns, other values are kept."""
    items = F.from_json(c, "array<string>")
    words = F.transform(items, lambda x: F.when(x == "true", F.lit("True"))
                        .when(x == "false", F.lit("False")).otherwise(x))
    return F.when(F.trim(c).startswith("[") & items.isNotNull(),
                  F.array_join(words, ",", "None")).otherwise(c)


def flatten_lists(df: DataFrame, text_lists: Sequence[str] = ()) -> DataFrame:
    """Every list column becomes comma-joined text; ``text_lists`` names
    text columns holding JSON lists among scalars; other columns untouched."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.ArrayType):
            cols.append(list_text(c, f.dataType.elementType).alias(f.name))
        elif f.name in text_lists and isinstance(f.dataType, T.StringType):
            cols.append(text_list_text(c).alias(f.name))
        else:
            cols.append(c)
    return df.select(*cols)


def concat_pages(frames: Iterable[DataFrame]) -> DataFrame:
    """Concatenate frames whose columns differ; missing columns are null."""
    out = None
    for f in frames:
        out = f if out is None else out.unionByName(f, allowMissingColumns=True)
    if out is None:
        raise ValueError("no frames to concatenate")
    return out


def time_of_day(c: Column) -> Column:
    """``HH:mm:ss`` of a timestamp."""
    return F.date_format(c, "HH:mm:ss")


def to_ndjson(df: DataFrame) -> DataFrame:
    """One JSON object per row, column ``value`` (write with ``.write.text``)."""
    return df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("value"))


def day_bounds(start: dt.date, end: dt.date) -> tuple[dt.datetime, dt.datetime]:
    """``start`` at 00:00:00 and ``end`` at 23:59:59."""
    return (dt.datetime.combine(start, dt.time(0, 0, 0)),
            dt.datetime.combine(end, dt.time(23, 59, 59)))


def filter_date_range(df: DataFrame, ts_col: str, start: dt.date, end: dt.date) -> DataFrame:
    """Rows with ``start 00:00:00 <= ts <= end 23:59:59`` (a row at
    23:59:59.5 on the end day is outside, as with the source service)."""
    lo, hi = day_bounds(start, end)
    c = F.col(ts_col)
    return df.filter((c >= F.lit(lo).cast(c_type(df, ts_col)))
                     & (c <= F.lit(hi).cast(c_type(df, ts_col))))


def c_type(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()


def flat_output(df: DataFrame) -> DataFrame:
    """One level of record fields expanded to ``parent_field`` columns, for
    outputs compared with flat SQL results."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StructType):
            cols += [F.col(f"`{f.name}`").getField(s.name).alias(f"{f.name}_{s.name}")
                     for s in f.dataType.fields]
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)

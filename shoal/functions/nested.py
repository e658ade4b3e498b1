"""Arrays, maps, JSON text and schema-driven feature typing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from .numeric import as_col


def union_of(a, b) -> Column:
    """Distinct union of two arrays, null read as empty."""
    empty = F.array().cast("array<string>")
    return F.array_union(F.coalesce(as_col(a), empty), F.coalesce(as_col(b), empty))


def combinations(c) -> Column:
    """Ordered pairs of different members of one row's array."""
    members = F.array_distinct(as_col(c))
    return F.flatten(F.transform(members, lambda x: F.transform(
        F.filter(members, lambda y: y != x), lambda y: F.struct(x.alias("a"), y.alias("b")))))


def top_map(entries, n: int) -> Column:
    """Map of the first n of an ordered array of (key, value) structs."""
    return F.map_from_entries(F.slice(as_col(entries), 1, n))


def json_list(c) -> Column:
    return F.from_json(as_col(c), T.ArrayType(T.StringType()))


def json_text(c, path: str, default: str | None = None) -> Column:
    value = F.get_json_object(as_col(c), path)
    return value if default is None else F.coalesce(value, F.lit(default))


def json_map(c, value_type: T.DataType) -> Column:
    """Empty map where the text does not parse."""
    schema = T.MapType(T.StringType(), value_type)
    return F.coalesce(F.from_json(as_col(c), schema), F.create_map().cast(schema))


def rename_features(df: DataFrame, prefix: str = "", suffix: str = "", keep: tuple[str, ...] = ()) -> DataFrame:
    """Prefix and suffix every column but the kept ones."""
    return df.withColumnsRenamed({c: f"{prefix}{c}{suffix}" for c in df.columns if c not in keep})


def feature_columns(df: DataFrame, drop: tuple[str, ...] = ()) -> list[str]:
    return [c for c in df.columns if c not in drop]


def _typed(column: Column, kind: T.DataType, inside_map: bool = False) -> Column | None:
    """Column cast to its feature form, or None where the type carries no feature."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        number = column.cast("float")
        return number if inside_map else F.when(column.isNotNull(), F.array(number))
    if isinstance(kind, (T.IntegerType, T.LongType)):
        return F.when(column.isNotNull(), F.array(column.cast("float")))
    if isinstance(kind, T.StringType):
        return column
    if isinstance(kind, T.ArrayType):
        if isinstance(kind.elementType, (T.DoubleType, T.FloatType, T.IntegerType)):
            return F.when(F.size(column) > 0, column.cast("array<float>"))
        if isinstance(kind.elementType, T.StringType):
            return F.when(F.size(column) > 0, column)
        return None
    if isinstance(kind, T.MapType):
        if _typed(F.lit(None).cast(kind.valueType), kind.valueType, True) is None:
            return None
        mapped = F.map_filter(F.transform_values(column, lambda k, v: _typed(v, kind.valueType, True)),
                              lambda k, v: v.isNotNull())
        mapped = F.transform_keys(mapped, lambda k, v: k.cast("string"))
        return F.when(F.size(mapped) > 0, mapped)
    return None


def normalise_features(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Numbers become one-element float arrays, number arrays float arrays, maps recurse.

    Empty collections become null and untyped columns go.
    """
    selected = []
    for field in df.schema.fields:
        if field.name in keep:
            selected.append(F.col(field.name))
            continue
        column = _typed(F.col(field.name), field.dataType)
        if column is not None:
            selected.append(column.alias(field.name))
    return df.select(*selected)

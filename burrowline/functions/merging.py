"""Deep merge of layered metadata, driven by the layers' schemas.

Structs merge field by field, maps key by key, lists of structs by the name of their entries, other lists by adding what
isn't there yet; of two plain values the later layer's wins where it has one. A layer may lack fields, or have more.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NAME = "name"


def merged_type(low: T.DataType, high: T.DataType, at: str = "") -> T.DataType:
    """The type that holds what either layer has."""
    if isinstance(low, T.NullType):
        return high
    if isinstance(high, T.NullType) or low == high:
        return low
    if isinstance(low, T.StructType) and isinstance(high, T.StructType):
        more = {f.name: f.dataType for f in high}
        fields = [(f.name, merged_type(f.dataType, more[f.name], f"{at}.{f.name}") if f.name in more else f.dataType) for f in low]
        return T.StructType([T.StructField(n, t) for n, t in [*fields, *((n, t) for n, t in more.items() if n not in low.names)]])
    if isinstance(low, T.MapType) and isinstance(high, T.MapType):
        return T.MapType(merged_type(low.keyType, high.keyType, at), merged_type(low.valueType, high.valueType, f"{at}[]"))
    if isinstance(low, T.ArrayType) and isinstance(high, T.ArrayType):
        return T.ArrayType(merged_type(low.elementType, high.elementType, f"{at}[]"))
    if isinstance(low, T.NumericType) and isinstance(high, T.NumericType):
        return T.LongType() if isinstance(low, T.IntegralType) and isinstance(high, T.IntegralType) else T.DoubleType()
    if isinstance(low, (T.StructType, T.MapType, T.ArrayType)) or isinstance(high, (T.StructType, T.MapType, T.ArrayType)):
        raise ValueError(f"layers disagree on what {at.lstrip('.')} is: {low.simpleString()} and {high.simpleString()}")
    return T.StringType()


def lifted(c: Column, own: T.DataType, to: T.DataType) -> Column:
    """A value of one layer in the merged type; fields that it lacks are null."""
    if own.simpleString() == to.simpleString():
        return c
    if isinstance(own, T.StructType):
        held = {f.name: f.dataType for f in own}
        fields = [(lifted(c.getField(f.name), held[f.name], f.dataType) if f.name in held else F.lit(None).cast(f.dataType)).alias(f.name) for f in to]
        return F.when(c.isNotNull(), F.struct(*fields))
    if isinstance(own, T.MapType):
        values = F.transform_values(c, lambda _, v: lifted(v, own.valueType, to.valueType))
        return values if own.keyType == to.keyType else F.transform_keys(values, lambda k, _: lifted(k, own.keyType, to.keyType))
    if isinstance(own, T.ArrayType):
        return F.transform(c, lambda x: lifted(x, own.elementType, to.elementType))
    return c.cast(to)


def merged(low: Column, high: Column, kind: T.DataType) -> Column:
    """Two values of one type, the second one's leaves winning."""
    if isinstance(kind, T.StructType):
        both = F.struct(*[merged(low.getField(f.name), high.getField(f.name), f.dataType).alias(f.name) for f in kind])
        return F.when(low.isNotNull() | high.isNotNull(), both)
    if isinstance(kind, T.MapType):
        both = F.map_zip_with(low, high, lambda _, a, b: merged(a, b, kind.valueType))
        return F.when(low.isNull(), high).when(high.isNull(), low).otherwise(both)
    if isinstance(kind, T.ArrayType):
        return F.when(low.isNull(), high).when(high.isNull(), low).otherwise(_lists(low, high, kind.elementType))
    return F.coalesce(high, low)


def _lists(low: Column, high: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StructType) and NAME in kind.names:
        same = lambda x, h: x.getField(NAME) == h.getField(NAME)
        put = lambda held, h: F.when(F.exists(held, lambda x: F.coalesce(same(x, h), F.lit(False))), F.transform(held, lambda x: F.when(same(x, h), merged(x, h, kind)).otherwise(x))).otherwise(F.concat(held, F.array(h)))
        return F.aggregate(high, low, put)
    joined = F.concat(low, high)
    return joined if "map<" in kind.simpleString() else F.array_distinct(joined)


def deep_merge(df: DataFrame, layers: list[str], column: str) -> DataFrame:
    """df with the merge of some of its columns, the lowest layer first."""
    kinds = [df.schema[c].dataType for c in layers]
    kind = reduce(lambda a, b: merged_type(a, b), kinds)
    values = [lifted(F.col(f"`{c}`"), k, kind) for c, k in zip(layers, kinds, strict=True)]
    return df.withColumn(column, reduce(lambda a, b: merged(a, b, kind), values))

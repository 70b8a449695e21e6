"""Flattening of typed record fields into rows (record_id, key, text_value, num_value, ord)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.functions.numbers import number_text

ROW = "struct<key:string,text_value:string,num_value:double>"


def _row(key: str, text: Column, num: Column | None = None) -> Column:
    return F.struct(F.lit(key).alias("key"), text.cast("string").alias("text_value"), (num if num is not None else F.lit(None)).cast("double").alias("num_value"))


def _scalar(key: str, value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.BooleanType):
        return _row(key, F.when(value, "true").when(~value, "false"))
    if isinstance(kind, T.NumericType):
        return _row(key, F.lit(None), value)
    return _row(key, value)


def shown(value: Column, kind: T.DataType) -> Column:
    """A scalar as it stands in a combined row."""
    return number_text(value) if isinstance(kind, T.NumericType) else value.cast("string")


def _flatten(key: str, value: Column, kind: T.DataType) -> list[Column]:
    """Arrays of rows of one field, in order."""
    none = F.array().cast(f"array<{ROW}>")
    if isinstance(kind, T.StructType):
        out = [x for f in kind for x in _flatten(f"{key}.{f.name}", value[f.name], f.dataType)]
        if "text" in kind.names:
            text = value["text"].cast("string")
            out.append(F.when(F.trim(text) != "", F.array(_row(key, text))).otherwise(none))
        return out
    if isinstance(kind, T.ArrayType):
        of = kind.elementType
        if isinstance(of, T.ArrayType):
            return []
        if isinstance(of, T.StructType):
            subs = sorted(of, key=lambda f: f.name)

            def rows(e: Column) -> Column:
                parts = [F.when(e[f.name].isNotNull(), F.array(_scalar(f"{key}.{f.name}", e[f.name], f.dataType))).otherwise(none) for f in subs]
                whole = F.array_join(F.array(*(shown(e[f.name], f.dataType) for f in subs)), " ")
                return F.concat(*parts, F.array(_row(key, whole)))

            return [F.when(value.isNotNull(), F.flatten(F.transform(value, rows))).otherwise(none)]
        each = F.transform(F.filter(value, lambda e: e.isNotNull()), lambda e: _scalar(key, e, of))
        return [F.when(value.isNotNull(), each).otherwise(none)]
    return [F.when(value.isNotNull(), F.array(_scalar(key, value, kind))).otherwise(none)]


def flatten_fields(records: DataFrame, id_col: str, fields: list[str]) -> DataFrame:
    """One pass over ``records``: every field's rows with their order within the record."""
    parts = [x.cast(f"array<{ROW}>") for f in fields for x in _flatten(f, F.col(f), records.schema[f].dataType)]
    return records.select(F.col(id_col).alias("record_id"), F.posexplode(F.concat(*parts))).select("record_id", "col.*", F.col("pos").alias("ord"))

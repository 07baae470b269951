"""Reading JSON text columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalars import as_col

_PARSED = "__parsed"
# Accept and reject the same texts as get_json_object does.
_READER = {"allowNonNumericNumbers": "false", "allowUnquotedControlChars": "true"}


def json_field(text: Column | str, path: str) -> Column:
    """One JSON path as text: NULL when missing, null or not JSON; nested values stay JSON text."""
    return F.get_json_object(as_col(text), "$." + path)


def json_fields(df: DataFrame, text: str, fields: dict[str, str]) -> DataFrame:
    """Add one STRING column per ``name: path`` pair, read from the JSON text column ``text``.

    The text is parsed once for all fields, with an all-text schema made of the paths.  Each value equals
    ``json_field`` of its path (of a name given twice in one object, the last value counts).  Paths with array
    places, and paths that lead through another one, are read on their own.
    """
    alone = {p for p in fields.values() if "[" in p or any(q.startswith(p + ".") for q in fields.values())}
    tree: dict = {}
    for path in fields.values():
        if path not in alone:
            node = tree
            *groups, leaf = path.split(".")
            for group in groups:
                node = node.setdefault(group, {})
            node[leaf] = None

    def schema(node: dict) -> T.StructType:
        return T.StructType([
            T.StructField(name, T.StringType() if child is None else schema(child)) for name, child in node.items()
        ])

    def read(path: str) -> Column:
        if path in alone:
            return json_field(text, path)
        column = F.col(_PARSED)
        for step in path.split("."):
            column = column.getField(step)
        return column

    rows = df.withColumn(_PARSED, F.from_json(F.col(text), schema(tree), _READER)) if tree else df
    return rows.select(*df.columns, *[read(path).alias(name) for name, path in fields.items()])

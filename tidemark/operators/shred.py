"""Nested records as a root table and child tables."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..names import PARENT_ID, POSITION, ROOT_ID, ROW_ID


def normal_name(name: str, longest: int = 63) -> str:
    """Lower case, and _ for what isn't a letter, digit or _."""
    return re.sub(r"[^a-z0-9_]", "_", name.lower())[:longest]


def normal_names(df: DataFrame, longest: int = 63) -> DataFrame:
    """df with normal names; two names that become one are refused."""
    names = [normal_name(c, longest) for c in df.columns]
    if twice := sorted({n for n in names if names.count(n) > 1}):
        raise ValueError(f"columns share the name {', '.join(twice)}")
    return df.toDF(*names)


def row_id(df: DataFrame, key: list[str] | None = None) -> Column:
    """A row's identity: a hash of its key, else of its content."""
    return F.sha2(F.to_json(F.struct(*[F.col(c) for c in key or df.columns]), {"ignoreNullFields": "false"}), 256)


def flatten(df: DataFrame) -> DataFrame:
    """Struct columns become columns a__b, to any depth."""
    while any(isinstance(f.dataType, T.StructType) for f in df.schema.fields):
        parts: list[Column] = []
        for f in df.schema.fields:
            parts += [F.col(f"`{f.name}`.`{g.name}`").alias(f"{f.name}__{g.name}") for g in f.dataType.fields] if isinstance(f.dataType, T.StructType) else [F.col(f"`{f.name}`")]
        df = df.select(*parts)
    return df


def is_child(kind: T.DataType) -> bool:
    return isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType)


def shred(df: DataFrame, table: str, key: list[str] | None = None, native_structs: bool = False) -> dict[str, DataFrame]:
    """{table: root, table__field: children, ...}. Arrays of objects become tables with the ids of their parent and root
    and their position; arrays of plain values stay."""
    rooted = df.withColumn(ROW_ID, row_id(df, key)).withColumn(ROOT_ID, F.col(ROW_ID))
    out: dict[str, DataFrame] = {}

    def walk(rows: DataFrame, name: str) -> None:
        rows = rows if native_structs else flatten(rows)
        lists = [f.name for f in rows.schema.fields if is_child(f.dataType)]
        out[name] = rows.drop(*lists) if name != table else rows.drop(*lists, ROOT_ID)
        for field in lists:
            each = rows.select(F.col(ROW_ID).alias(PARENT_ID), ROOT_ID, F.posexplode(F.col(f"`{field}`")).alias(POSITION, "_item"))
            child = each.select(F.sha2(F.concat_ws("/", PARENT_ID, F.lit(field), F.col(POSITION).cast("string")), 256).alias(ROW_ID), PARENT_ID, ROOT_ID, POSITION, "_item.*")
            walk(child, f"{name}__{field}")

    walk(rooted, table)
    return out


def include_parent(children: DataFrame, parents: DataFrame, child_key: list[str], parent_key: list[str], fields: list[str], prefix: str = "_parent_") -> DataFrame:
    """Children with fields of their parent; a name that the children have already is refused."""
    taken = {f"{prefix}{f}" for f in fields} & set(children.columns)
    if taken:
        raise ValueError(f"the children have {', '.join(sorted(taken))} already")
    side = parents.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(parent_key)], *[F.col(f).alias(f"{prefix}{f}") for f in fields])
    on = [children[c] == side[f"_k{i}"] for i, c in enumerate(child_key)]
    return children.join(side, on, "left").drop(*[f"_k{i}" for i in range(len(parent_key))])

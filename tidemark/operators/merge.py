"""Merge arms: pure functions of DataFrames from a target and delivered rows to the new target.

Whether a side is broadcast is left to the optimiser's own size threshold, so no arm fails on a large delivery.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .survivors import flagged, survivors


@dataclass(frozen=True)
class MergeSpec:
    key: tuple[str, ...]
    arrival: str
    sort: tuple[str, str] | None = None
    hard_delete: str | None = None
    scope: tuple[str, ...] | None = None


def _kept(rows: DataFrame, spec: MergeSpec) -> DataFrame:
    return rows.filter(~flagged(rows, spec.hard_delete)) if spec.hard_delete else rows


def scope_replace(target: DataFrame, stage: DataFrame, scope: list[str]) -> DataFrame:
    """Target without the rows of delivered scopes; a scope with a null in it is none."""
    return target.join(stage.select(*scope).dropna().distinct(), list(scope), "left_anti").select(*target.columns)


def delete_insert(target: DataFrame, stage: DataFrame, spec: MergeSpec) -> DataFrame:
    """Keys met anywhere in the delivery leave the target; survivors that aren't flagged come in."""
    if spec.scope:
        target = scope_replace(target, stage, list(spec.scope))
    key = list(spec.key)
    rows = _kept(survivors(stage, key, spec.arrival, spec.sort), spec)
    gone = stage.select(*key).distinct()
    return target.join(gone, key, "left_anti").select(*target.columns).unionByName(rows.select(*target.columns))


def upsert(target: DataFrame, stage: DataFrame, spec: MergeSpec) -> DataFrame:
    """Keys whose survivor is flagged leave the target; other survivors replace their row or come in. Where every column
    is of the key, rows that are there already stay as they are."""
    if spec.scope:
        target = scope_replace(target, stage, list(spec.scope))
    key, columns = list(spec.key), target.columns
    rows = survivors(stage, key, spec.arrival, spec.sort)
    if set(columns) == set(key):
        kept = _kept(rows, spec).select(*columns)
        gone = rows.join(kept, key, "left_anti").select(*key)
        return target.join(gone, key, "left_anti").select(*columns).unionByName(kept.join(target, key, "left_anti").select(*columns))
    # Keys of the delivery are those of its survivors; the window isn't computed for them.
    gone = stage.select(*key).distinct()
    return target.join(gone, key, "left_anti").select(*columns).unionByName(_kept(rows, spec).select(*columns))


def duplicate_keys(target: DataFrame, key: list[str]) -> DataFrame:
    """Keys that an upsert would refuse as the target holds them more than once."""
    return target.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def merge_root(target: DataFrame, stage: DataFrame, row_id: str, arrival: str, hard_delete: str | None = None) -> DataFrame:
    """Delete-insert of shredded roots by their row id."""
    return delete_insert(target, stage, MergeSpec((row_id,), arrival, hard_delete=hard_delete))


def merge_children(target: DataFrame, stage: DataFrame, root_stage: DataFrame, row_id: str, root_id: str, arrival: str, root_row_id: str, root_arrival: str, hard_delete: str | None = None) -> DataFrame:
    """Subtrees of delivered roots are replaced. Children of roots whose last delivered row is flagged go."""
    gone = root_stage.select(F.col(root_row_id).alias(root_id)).distinct()
    rows = survivors(stage, [row_id], arrival)
    if hard_delete:
        last = survivors(root_stage, [root_row_id], root_arrival)
        dead = last.filter(flagged(last, hard_delete)).select(F.col(root_row_id).alias(root_id))
        rows = rows.join(dead, root_id, "left_anti")
    return target.join(gone, root_id, "left_anti").select(*target.columns).unionByName(rows.select(*target.columns))

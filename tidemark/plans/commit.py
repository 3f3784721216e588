"""What a commit does, as a list of steps: a pure function of tables, options and facts; and its run over DataFrames."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from ..operators import merge, scd2
from .options import OptionError, Scd2Options, TableOptions


@dataclass(frozen=True)
class Table:
    name: str
    mode: str  # append, replace or merge
    key: tuple[str, ...] = ()
    options: TableOptions = field(default_factory=TableOptions)
    parent: str | None = None
    keyed: bool = True


@dataclass(frozen=True)
class Facts:
    """What is known before a commit: tables cleared already in this load, units published by table, and empty stages."""

    load_id: str
    seq: int
    committed: bool = False
    cleared: frozenset[str] = frozenset()
    published: frozenset[str] = frozenset()
    empty: frozenset[str] = frozenset()


@dataclass(frozen=True)
class Step:
    kind: str
    table: str | None = None
    detail: str | None = None


def full_feed(t: Table) -> str | None:
    """The rule by which a table takes one unit a load: its delivery stands for all there is."""
    if t.mode != "merge":
        return None
    if t.options.merge_scope is not None:
        return "merge_scope"
    return "absent: retire" if t.options.strategy == "scd2" and (t.options.scd2 or Scd2Options()).absent == "retire" else None


def arm(t: Table) -> str:
    strategy = t.options.strategy or "delete_insert"
    if t.keyed and t.parent is None:
        return f"keyed_{strategy}"
    if strategy != "delete_insert":
        raise OptionError(f"{t.name}: {strategy} needs a keyed table")
    return "identity_children" if t.parent else "identity_root"


def root_of(name: str, tables: dict[str, Table]) -> str:
    """The root of a table; a chain of over 64 parents is refused."""
    for _ in range(64):
        if tables[name].parent is None:
            return name
        name = tables[name].parent
    raise ValueError(f"{name}: parents form a loop")


def plan_commit(tables: list[Table], facts: Facts) -> list[Step]:
    """The steps of a commit unit in order. A unit committed before only empties its stages."""
    if facts.committed:
        return [Step("truncate_stage", t.name) for t in tables]
    steps: list[Step] = []
    for t in tables:
        if t.mode == "replace" and t.name not in facts.cleared:
            steps.append(Step("clear_target", t.name))
        if t.mode in ("append", "replace"):
            steps.append(Step("insert", t.name))
            continue
        rule = full_feed(t)
        if rule and t.name in facts.empty:
            continue  # an empty unit would retire or clear everything
        if rule and t.name in facts.published:
            raise OptionError(f"{t.name}: a second unit in one load, but {rule} takes a delivery as complete")
        if t.options.merge_scope is not None and t.options.strategy != "scd2":
            steps.append(Step("scope_replace", t.name))
        steps.append(Step("merge", t.name, arm(t)))
    # Roots stay staged until their children have been merged.
    steps += [Step("truncate_stage", t.name) for t in tables]
    return [*steps, Step("upsert_state"), Step("insert_receipt", detail=f"{facts.load_id}/{facts.seq}")]


def run_commit(steps: list[Step], tables: list[Table], target: Callable[[str], DataFrame], stage: Callable[[str], DataFrame], arrival: str, boundary=None, row_id: str = "_sys_id", root_id: str = "_sys_root_id") -> dict[str, DataFrame]:
    """The new content of every table that the steps change."""
    by_name = {t.name: t for t in tables}
    out: dict[str, DataFrame] = {}
    for s in steps:
        if s.table is None or s.kind == "truncate_stage":
            continue
        t, rows = by_name[s.table], stage(s.table)
        now = out.get(s.table, target(s.table))
        if s.kind == "clear_target":
            out[s.table] = now.limit(0)
        elif s.kind == "insert":
            out[s.table] = now.unionByName(rows.select(*now.columns))
        elif s.kind == "scope_replace":
            out[s.table] = merge.scope_replace(now, rows, list(t.options.merge_scope))
        elif s.detail in ("keyed_delete_insert", "keyed_upsert"):
            spec = merge.MergeSpec(t.key, arrival, t.options.dedup_sort, t.options.hard_delete)
            out[s.table] = (merge.upsert if s.detail == "keyed_upsert" else merge.delete_insert)(now, rows, spec)
        elif s.detail == "keyed_scd2":
            o = t.options.scd2 or Scd2Options()
            at = o.boundary_timestamp or boundary
            if at is None:
                raise ValueError(f"{t.name}: a commit unit needs one boundary")
            scope = list(t.options.merge_scope) if t.options.merge_scope else None
            out[s.table] = scd2.scd2_merge(now, rows, list(t.key), arrival, at, marker=o.active_record_timestamp, absent=o.absent, scope=scope, sort=t.options.dedup_sort, valid_from=o.valid_from, valid_to=o.valid_to, ignore=("_sys_load_id",))
        elif s.detail == "identity_root":
            out[s.table] = merge.merge_root(now, rows, row_id, arrival, t.options.hard_delete)
        else:
            root = by_name[root_of(t.name, by_name)]
            out[s.table] = merge.merge_children(now, rows, stage(root.name), row_id, root_id, arrival, row_id, arrival, root.options.hard_delete)
    return out

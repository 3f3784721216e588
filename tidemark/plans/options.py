"""Options of a destination table, checked when they are read and again when the table is opened."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from ..names import VALID_FROM, VALID_TO

STRATEGIES = ("delete_insert", "upsert", "scd2")


class OptionError(ValueError):
    """Names the table and the rule."""


@dataclass(frozen=True)
class Scd2Options:
    valid_from: str = VALID_FROM
    valid_to: str = VALID_TO
    boundary_timestamp: str | None = None
    active_record_timestamp: str | None = None
    absent: str = "keep"


@dataclass(frozen=True)
class TableOptions:
    strategy: str | None = None
    hard_delete: str | None = None
    dedup_sort: tuple[str, str] | None = None
    merge_scope: tuple[str, ...] | None = None
    scd2: Scd2Options | None = None


def instant(text: str) -> datetime:
    """An RFC 3339 instant; an offset is required."""
    when = datetime.fromisoformat(text)
    if when.tzinfo is None:
        raise ValueError("an instant needs an offset")
    return when


def check_parsed(table: str, o: TableOptions) -> None:
    """Rules that need no schema, in order; the first that is broken is named."""
    no = lambda why: OptionError(f"{table}: {why}")
    strategy = o.strategy or "delete_insert"
    if strategy not in STRATEGIES:
        raise no(f"strategy {strategy} is none of {', '.join(STRATEGIES)}")
    if o.hard_delete is not None:
        if not o.hard_delete:
            raise no("hard_delete names no column")
        if strategy == "scd2":
            raise no("hard_delete doesn't go with scd2")
    if o.dedup_sort is not None and (not o.dedup_sort[0] or o.dedup_sort[1] not in ("asc", "desc")):
        raise no("dedup_sort needs a column and asc or desc")
    if o.merge_scope is not None:
        if not o.merge_scope or not all(o.merge_scope):
            raise no("merge_scope is empty")
        if len(set(o.merge_scope)) < len(o.merge_scope):
            raise no("merge_scope names a column twice")
        if strategy == "scd2" and (o.scd2 or Scd2Options()).absent != "retire":
            raise no("merge_scope with scd2 needs absent: retire")
    if o.scd2 is not None:
        if strategy != "scd2":
            raise no("scd2 options need strategy scd2")
        s = o.scd2
        if not s.valid_from or not s.valid_to:
            raise no("validity columns need names")
        if s.valid_from == s.valid_to:
            raise no("validity columns share a name")
        if s.absent not in ("keep", "retire"):
            raise no("absent is keep or retire")
        times = []
        for name, value in (("boundary_timestamp", s.boundary_timestamp), ("active_record_timestamp", s.active_record_timestamp)):
            if value is not None:
                try:
                    times.append(instant(value))
                except ValueError as e:
                    raise no(f"{name} isn't an RFC 3339 instant with an offset") from e
        if len(times) == 2 and times[0] == times[1]:
            raise no("the marker of open versions is the boundary")


def check_opened(table: str, o: TableOptions, columns: list[str], mode: str, key: list[str], *, child: bool = False, keyed: bool = True) -> None:
    """Rules that need the table, in order. keyed: merged by a declared key, not by row identity."""
    no = lambda why: OptionError(f"{table}: {why}")
    if mode != "merge":
        used = [n for n in ("strategy", "hard_delete", "dedup_sort", "merge_scope", "scd2") if getattr(o, n) is not None]
        if used:
            raise no(f"{used[0]} needs merge, not {mode}")
        return
    for c in key:
        if c not in columns:
            raise no(f"key column {c} is missing")
    if o.hard_delete is not None and (child or o.hard_delete not in columns):
        raise no("hard_delete belongs to the root table" if child else f"hard_delete column {o.hard_delete} is missing")
    if o.dedup_sort is not None:
        c = o.dedup_sort[0]
        if not keyed:
            raise no("dedup_sort needs a keyed table")
        if c not in columns:
            raise no(f"dedup_sort column {c} is missing")
        if c == o.hard_delete:
            raise no("dedup_sort can't be the hard_delete flag")
        if c in key:
            raise no("dedup_sort can't be a key column")
    if o.merge_scope is not None:
        if not keyed:
            raise no("merge_scope needs a keyed table")
        for c in o.merge_scope:
            if c not in columns:
                raise no(f"merge_scope column {c} is missing")
            if c == o.hard_delete:
                raise no("merge_scope can't hold the hard_delete flag")
    if o.strategy in ("upsert", "scd2") and not keyed:
        raise no(f"{o.strategy} needs a keyed table: rows known by identity alone can't be matched")
    if o.strategy == "scd2":
        s = o.scd2 or Scd2Options()
        for c in (s.valid_from, s.valid_to):
            if c in columns:
                raise no(f"validity column {c} is a column of the data")

"""Clause filters over sessions and events, compiled to one Column.

A filter is a list of clauses; all must hold, and a clause holds if any of its values
does.  An empty list of values matches nothing, an empty list of clauses everything.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.functions.text import literal_pattern

AVAILABILITY, SURFACES = ("live", "persisted"), ("current", "shadowed", "log-only")
#: Clause kinds and the columns that they test.
SESSION_VALUES = {"id": ("id", False), "cwd": ("cwd", True), "parent": ("parent_session", True)}
EVENT_VALUES = {"type": ("type", None), "surface": ("surface", SURFACES)}
SESSION_RANGES, EVENT_RANGES = {"created-at": "created_at"}, {"seq": "seq", "time": "time"}


class InvalidFilter(ValueError):
    """A clause of an unknown kind or with values that it can't have."""


def _values(clause: Mapping[str, Any], nullable: bool = False, allowed: Sequence[str] | None = None) -> list:
    values = clause.get("values")
    if not isinstance(values, (list, tuple)) or not all(isinstance(v, str) or (nullable and v is None) for v in values):
        raise InvalidFilter(f"{clause['kind']} values must be a list of strings{' or null' if nullable else ''}")
    if allowed is not None and (wrong := [v for v in values if v not in allowed]):
        raise InvalidFilter(f"{clause['kind']} can't be {wrong[0]!r}")
    return list(values)


def _any_value(column: str, values: list) -> Column:
    """Null-safe membership."""
    plain = [v for v in values if v is not None]
    found = F.coalesce(F.col(column).isin(plain), F.lit(False)) if plain else F.lit(False)
    return found | F.col(column).isNull() if len(plain) < len(values) else found


def _range(clause: Mapping[str, Any], column: str) -> Column:
    low, high = clause.get("from"), clause.get("to")
    for bound in (low, high):
        if bound is not None and (isinstance(bound, bool) or not isinstance(bound, (int, float)) or not math.isfinite(bound)):
            raise InvalidFilter(f"{clause['kind']} bounds must be finite numbers")
    if low is not None and high is not None and low > high:
        raise InvalidFilter(f"{clause['kind']} must have from <= to")
    tests = ([F.col(column) >= low] if low is not None else []) + ([F.col(column) <= high] if high is not None else [])
    return F.coalesce(reduce(Column.__and__, tests), F.lit(False)) if tests else F.lit(True)


def session_clause(clause: Mapping[str, Any]) -> Column:
    kind = clause.get("kind")
    if kind in SESSION_VALUES:
        column, nullable = SESSION_VALUES[kind]
        return _any_value(column, _values(clause, nullable))
    if kind in SESSION_RANGES:
        return _range(clause, SESSION_RANGES[kind])
    if kind == "availability":
        return reduce(Column.__or__, [F.coalesce(F.col(v), F.lit(False)) for v in _values(clause, allowed=AVAILABILITY)], F.lit(False))
    raise InvalidFilter(f"unknown filter kind {kind!r}")


def event_clause(clause: Mapping[str, Any]) -> Column:
    kind = clause.get("kind")
    if kind in EVENT_VALUES:
        column, allowed = EVENT_VALUES[kind]
        return _any_value(column, _values(clause, allowed=allowed))
    if kind in EVENT_RANGES:
        return _range(clause, EVENT_RANGES[kind])
    if kind == "text":
        if not isinstance(clause.get("text"), str):
            raise InvalidFilter("text must be a string")
        try:
            return F.coalesce(F.col("text").rlike(literal_pattern(clause["text"])), F.lit(False))
        except ValueError as error:
            raise InvalidFilter(str(error)) from error
    raise InvalidFilter(f"unknown filter kind {kind!r}")


def _all(df: DataFrame, clauses: Sequence[Mapping[str, Any]], compile_clause) -> DataFrame:
    if not isinstance(clauses, (list, tuple)):
        raise InvalidFilter("filters must be a list")
    tests = [compile_clause(c) for c in clauses]
    return df.filter(reduce(Column.__and__, tests)) if tests else df


def filter_sessions(sessions: DataFrame, clauses: Sequence[Mapping[str, Any]]) -> DataFrame:
    """Sessions that pass every clause (id, cwd, created-at, parent, availability)."""
    return _all(sessions, clauses, session_clause)


def filter_events(documents: DataFrame, clauses: Sequence[Mapping[str, Any]]) -> DataFrame:
    """Event documents that pass every clause (seq, time, type, surface, text)."""
    return _all(documents, clauses, event_clause)


def authorized_ids(requested: DataFrame, sessions: DataFrame, caller_id: str) -> DataFrame:
    """Requested ids that exist and share the caller's working directory, or are its own."""
    caller = sessions.filter(F.col("id") == caller_id).select(F.col("cwd").alias("own_cwd")).limit(1)
    # one row at most
    reachable = sessions.join(F.broadcast(caller), F.col("cwd").eqNullSafe(F.col("own_cwd")) | (F.col("id") == caller_id), "left_semi")
    return requested.select("id").distinct().join(reachable.select("id"), "id", "left_semi")

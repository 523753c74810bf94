"""Declarative description of a source. Everything a job needs to know about the
columns of a register or survey is stated here, not coded."""

from __future__ import annotations

from dataclasses import dataclass, field

from ..operators.link import MatchPass


@dataclass(frozen=True)
class CodeMap:
    """Look `source` up in the user table `table` and put the result in `target`."""
    source: str
    target: str
    table: str
    default: str | None = "UDF"


@dataclass(frozen=True)
class SourceSpec:
    name: str
    separator: str = ";"
    rename: dict = field(default_factory=dict)
    drop: tuple = ()
    drop_pattern: str | None = None
    deny: tuple = ()
    dates: dict = field(default_factory=dict)
    booleans: dict = field(default_factory=dict)
    integers: tuple = ()
    trim: tuple = ()
    normalize: tuple = ()
    null_if: dict = field(default_factory=dict)
    codes: tuple = ()
    ensure: dict = field(default_factory=dict)
    pad: dict = field(default_factory=dict)
    digits: dict = field(default_factory=dict)
    dedupe: tuple = ()
    row_key: tuple = ()  # tells the rows of a file apart; the dedupe columns if empty
    event_dates: tuple = ()
    address: tuple = ()
    passes: tuple[MatchPass, ...] = ()
    release: tuple = ()
    release_deny: tuple = ()
    backbone: tuple = ()

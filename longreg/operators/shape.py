"""Schema and projection operators. Each is one projection, whatever its width."""

from __future__ import annotations

import datetime as dt
import re
import uuid

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.keys import keyed_id

LINEAGE = [
    "entity_id", "group_id", "site_id", "row_id", "file_id", "wave_date",
    "loaded_on", "superseded_on", "latest_event_date", "source", "address_key",
]


class MissingColumns(ValueError):
    pass


class DeniedColumns(ValueError):
    pass


def require(df: DataFrame, names) -> None:
    absent = [n for n in names if n not in df.columns]
    if absent:
        raise MissingColumns(f"columns not found: {', '.join(absent)}")


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename the columns that are there; names without a column are ignored."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def drop_columns(df: DataFrame, names=None, pattern: str | None = None, deny=()) -> DataFrame:
    """Drop listed columns, or all whose name matches `pattern`; then make sure
    that no column of the deny list is left."""
    gone = list(names or [])
    if pattern:
        gone += [c for c in df.columns if re.search(pattern, c)]
    out = df.drop(*gone)
    forbid_columns(out, deny)
    return out


def forbid_columns(df: DataFrame, deny) -> None:
    left = [c for c in df.columns if c in set(deny)]
    if left:
        raise DeniedColumns(f"columns must not be kept: {', '.join(left)}")


def ensure_columns(df: DataFrame, wanted: dict[str, str]) -> DataFrame:
    """Add each missing column as a typed NULL; present columns stay as they are."""
    absent = {n: F.lit(None).cast(t) for n, t in wanted.items() if n not in df.columns}
    return df.withColumns(absent) if absent else df


def order_columns(df: DataFrame, front=()) -> DataFrame:
    first = [c for c in front if c in df.columns]
    return df.select(*first, *sorted(c for c in df.columns if c not in first))


def select_required(df: DataFrame, names) -> DataFrame:
    require(df, names)
    return df.select(*names)


def as_date(value: dt.date | str, name: str) -> dt.date:
    return value if isinstance(value, dt.date) else _parse(value, name)


def _parse(value, name):
    try:
        return dt.date.fromisoformat(value)
    except (TypeError, ValueError) as err:
        raise ValueError(f"{name} must be a date, got {value!r}") from err


def check_uuid(value: str) -> str:
    try:
        return str(uuid.UUID(value))
    except (TypeError, ValueError, AttributeError) as err:
        raise ValueError(f"file_id must be a UUID, got {value!r}") from err


def add_lineage(df: DataFrame, *, source: str, wave_date: dt.date | str | Column, file_id: str,
                loaded_on: dt.date | str, secret: str, row_key: list[str],
                overwrite: bool = True) -> DataFrame:
    """Put the lineage block in front of the business columns.

    Ids start empty; `row_id` is derived from the file and the columns that make a
    row distinct within it, so a retried task or a second run mints the same ids.
    With `overwrite=False` only missing lineage columns are added.
    """
    require(df, row_key)
    wave = wave_date if isinstance(wave_date, Column) else F.lit(as_date(wave_date, "wave_date"))
    file_id = check_uuid(file_id)
    # NULL and '' stay apart, so rows that differ at all get different ids.
    parts = [F.lit(file_id), *[F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-"))
                               for c in row_key]]
    block = {
        "entity_id": F.lit(None).cast("string"),
        "group_id": F.lit(None).cast("string"),
        "site_id": F.lit(None).cast("string"),
        "row_id": keyed_id(secret, "row", parts),
        "file_id": F.lit(file_id),
        "wave_date": wave,
        "loaded_on": F.lit(as_date(loaded_on, "loaded_on")),
        "superseded_on": F.lit(None).cast("date"),
        "latest_event_date": F.lit(None).cast("date"),
        "source": F.lit(source),
        "address_key": F.lit(None).cast("string"),
    }
    kept = set() if overwrite else set(df.columns)
    out = df.withColumns({n: c for n, c in block.items() if n not in kept})
    return out.select(*LINEAGE, *[c for c in out.columns if c not in LINEAGE])

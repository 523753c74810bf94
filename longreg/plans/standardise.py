"""Raw text rows of a wave to typed, deduplicated rows with a lineage block."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators import clean, shape
from ..operators.dedup import drop_duplicates
from ..specs.model import SourceSpec


def type_columns(raw: DataFrame, spec: SourceSpec, code_tables: dict | None = None) -> DataFrame:
    """Rename, drop, type, trim, normalise, decode: projections only, no shuffle."""
    df = shape.rename_columns(raw, spec.rename)
    df = shape.drop_columns(df, spec.drop, spec.drop_pattern, spec.deny)
    df = clean.parse_dates(df, spec.dates)
    df = clean.decode_boolean(df, spec.booleans)
    df = clean.cast_int(df, spec.integers)
    df = clean.trim_columns(df, spec.trim)
    df = clean.normalize_text(df, spec.normalize)
    df = clean.null_if(df, spec.null_if)
    for code in spec.codes:
        if code.table not in (code_tables or {}):
            raise ValueError(f"no code table {code.table!r}; pass an empty one to give every code {code.default!r}")
        df = clean.map_codes(df, code.source, code.target, code_tables[code.table], code.default)
    df = shape.ensure_columns(df, spec.ensure)
    df = clean.pad_ids(df, spec.pad)
    return clean.extract_digits(df, spec.digits)


def standardise(raw: DataFrame, spec: SourceSpec, *, source: str, wave_date, file_id: str, loaded_on,
                secret: str, code_tables: dict | None = None) -> DataFrame:
    df = type_columns(raw, spec, code_tables)
    if spec.dedupe:
        df = drop_duplicates(df, list(spec.dedupe))
    # After deduplication the dedupe columns tell the rows of a file apart.
    row_key = list(spec.row_key or spec.dedupe) or sorted(df.columns)
    df = shape.add_lineage(df, source=source, wave_date=wave_date, file_id=file_id,
                           loaded_on=loaded_on, secret=secret, row_key=row_key)
    df = clean.row_extreme(df, list(spec.event_dates), "latest_event_date")
    return clean.concat_key(df, list(spec.address), "address_key")

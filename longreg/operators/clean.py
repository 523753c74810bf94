"""Column transforms and row filters. All are built-in expressions in one projection."""

from __future__ import annotations


from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.blank import all_blank, all_filled, as_text, blank_to_null, not_blank
from ..functions.text import LEGAL_SUFFIXES, match_text
from .shape import require
from .skew import lookup_join

#: Codes that are sent to all rows.
CODES = 100_000


def _present(df: DataFrame, names) -> list[str]:
    return [n for n in names if n in df.columns]


def _apply(df: DataFrame, columns: dict) -> DataFrame:
    return df.withColumns(columns) if columns else df


def trim_columns(df: DataFrame, cols, blank: str = "null") -> DataFrame:
    """Trim; what is then empty becomes NULL (`blank="null"`) or '' (`blank="empty"`)."""
    if blank not in ("null", "empty"):
        raise ValueError("blank must be 'null' or 'empty'")
    made = {c: blank_to_null(F.col(c)) if blank == "null" else F.coalesce(F.trim(c), F.lit(""))
            for c in _present(df, cols)}
    return _apply(df, made)


def fill_nulls(df: DataFrame, cols, value) -> DataFrame:
    return df.na.fill(value, _present(df, cols))


def null_if(df: DataFrame, values: dict) -> DataFrame:
    """Replace a sentinel by NULL, e.g. year 0. The sentinel takes the column's type."""
    return _apply(df, {c: F.nullif(F.col(c), F.lit(v).cast(df.schema[c].dataType))
                       for c, v in values.items() if c in df.columns})


def parse_dates(df: DataFrame, formats: dict[str, str], prefix: str = "date_") -> DataFrame:
    """Parse each column by its pattern (NULL if it is no such date) and add the
    year, month and day columns named after it."""
    made = {}
    for c in _present(df, formats):
        is_date = isinstance(df.schema[c].dataType, T.DateType)
        day = F.col(c) if is_date else F.try_to_date(F.trim(F.col(c)), formats[c])
        stem = c[len(prefix):] if c.startswith(prefix) else c
        made |= {c: day, f"year_{stem}": F.year(day), f"month_{stem}": F.month(day),
                 f"day_{stem}": F.dayofmonth(day)}
    return _apply(df, made)


def decode_boolean(df: DataFrame, codes: dict[str, tuple[str, str]],
                   true_only: bool = False) -> DataFrame:
    """Two-valued codes to BOOLEAN. Unknown codes give NULL, or FALSE with `true_only`."""
    made = {}
    for c in _present(df, codes):
        yes, no = codes[c] if not isinstance(codes[c], str) else (codes[c], None)
        text = F.trim(F.col(c).cast("string"))
        made[c] = (F.coalesce(text == yes, F.lit(False)) if true_only
                   else F.when(text == yes, True).when(text == no, False))
    return _apply(df, made)


def cast_int(df: DataFrame, cols) -> DataFrame:
    return _apply(df, {c: F.col(c).try_cast("int") for c in _present(df, cols)})


def normalize_text(df: DataFrame, cols, suffixes=LEGAL_SUFFIXES, prefix: str = "uni_") -> DataFrame:
    return _apply(df, {prefix + c: match_text(F.col(c), suffixes) for c in _present(df, cols)})


def extract_digits(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """First run of digits, e.g. the four digits of a Dutch postcode."""
    return _apply(df, {dst: F.regexp_extract(F.col(src), r"\d+", 0)
                       for src, dst in mapping.items() if src in df.columns})


def row_extreme(df: DataFrame, cols, out: str, how: str = "latest",
                overwrite: bool = True) -> DataFrame:
    """Latest or earliest date of the row, ignoring NULLs. All columns must be dates."""
    require(df, cols)
    wrong = [c for c in cols if not isinstance(df.schema[c].dataType, T.DateType)]
    if wrong:
        raise TypeError(f"not parsed as dates: {', '.join(wrong)}")
    pick = {"latest": F.greatest, "earliest": F.least}[how]
    value = pick(*cols) if len(cols) > 1 else F.col(cols[0])
    if not overwrite:
        require(df, [out])
        value = F.coalesce(F.col(out), value)
    return df.withColumn(out, value)


def concat_key(df: DataFrame, cols, out: str, sep: str = "|", overwrite: bool = True) -> DataFrame:
    """Join the parts with a separator. NULL when all parts are blank, so that rows
    without an address never look alike."""
    require(df, cols)
    value = F.when(~all_blank(df, cols), F.concat_ws(sep, *[as_text(F.col(c)) for c in cols]))
    if not overwrite:
        require(df, [out])
        value = F.when(not_blank(df, out), F.col(out)).otherwise(value)
    return df.withColumn(out, value)


def pad_ids(df: DataFrame, widths: dict[str, int]) -> DataFrame:
    """Restore lost leading zeros. Blank stays NULL and long ids are never cut."""
    made = {}
    for c in _present(df, widths):
        text = blank_to_null(F.col(c).cast("string"))
        made[c] = F.lpad(text, F.greatest(F.length(text), F.lit(widths[c])), F.lit("0"))
    return _apply(df, made)


def map_codes(df: DataFrame, src: str, dst: str, mapping: dict[str, str] | DataFrame,
              default: str | None = "UDF") -> DataFrame:
    """Look codes up in a user table. NULL stays NULL, unknown codes give `default`.

    A dict becomes one map literal. A DataFrame (code, label) is joined: up to CODES codes go to
    the rows, counted first; more are looked up with hot codes spread. A code with two labels is
    an error; repeated lines are not.
    """
    require(df, [src])
    code = F.trim(F.col(src).cast("string"))
    if isinstance(mapping, DataFrame):
        several = F.raise_error(F.concat(F.lit(f"two labels for a code of {src}: "), F.col("_src")))
        one = F.when(F.min("_label").eqNullSafe(F.max("_label")), F.min("_label")).otherwise(several)
        table = (mapping.toDF("_src", "_label").withColumn("_src", F.trim(F.col("_src").cast("string"))).where("_src is not null")
                 .groupBy("_src").agg(one.alias("_label")))
        coded = df.withColumn("_src", code)
        if mapping.count() <= CODES:
            joined = coded.join(F.broadcast(table), "_src", "left")
        else:
            joined = lookup_join(coded, table, ["_src"], spread=df.columns)
        found = F.col("_label")
    else:
        joined = df
        pairs = [F.lit(x) for item in sorted(mapping.items()) for x in item]
        found = F.try_element_at(F.create_map(*pairs), code) if pairs else F.lit(None).cast("string")
    value = F.when(code.isNotNull(), F.coalesce(found, F.lit(default)))
    return joined.withColumn(dst, value).drop("_src", "_label").select(*df.columns, *([] if dst in df.columns else [dst]))


def filter_not_blank(df: DataFrame, cols) -> DataFrame:
    require(df, cols)
    return df.where(all_filled(df, list(cols)))


def active_only(df: DataFrame) -> DataFrame:
    return df.where(F.col("superseded_on").isNull())


def is_matched(df: DataFrame, id_col: str = "entity_id"):
    return not_blank(df, id_col)


def split_matched(df: DataFrame, id_col: str = "entity_id") -> tuple[DataFrame, DataFrame]:
    """Rows with an id and rows without: together all rows, none twice."""
    linked = is_matched(df, id_col)
    return df.where(linked), df.where(~linked)



"""Column profiles, histograms and dictionary joins, whatever the width.

A profile reads its table twice at most. The first scan is for numeric columns: counts, moments,
and a quantile sketch that brackets each median within half a percent of the ranks. The second
counts what else matters, by column and value: values inside a bracket, values of text columns,
and NULLs. What it counts is staged and much smaller; medians are selected from it by ranges, so no
task sees all values of a column. Every aggregate combines in the map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from ..sources.tables import stage

# percentile_approx is off by at most rows / ACCURACY ranks.
ACCURACY = 10_000
#: Size of the sketch that brackets a median, whose error of 0.07 % of the ranks is rarely passed, and the bracket's
#: half width. The sketch draws at random; the bracket is checked by counting, so the median is exact in any case.
SKETCH, HALF = 8000, 0.0025
#: Values of which one task finds the middle.
RANGE = 100_000
STATISTICS = ["mean", "median", "stddev", "skewness"]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def _long(df: DataFrame, cols: list[str], data_type: str) -> DataFrame:
    typed = df.select(*[F.col(c).cast(data_type).alias(c) for c in cols])
    return typed.unpivot([], cols, "column", "value")


def _summary(df: DataFrame, numeric: list[str], approx: bool) -> dict:
    """Statistics of numeric columns and three quantiles around the middle, by column; one scan.
    The quantiles are those of percentile_approx, or of a faster sketch that only has to bracket."""
    x = F.col("value")
    middle = [0.5 - HALF, 0.5, 0.5 + HALF]
    sketch = F.percentile_approx(x, middle, ACCURACY) if approx else F.kll_sketch_agg_double(x, SKETCH)
    stats = _long(df, numeric, "double").groupBy("column").agg(
        F.count(x).alias("n"), F.count_if(x.isNull()).alias("nulls"), F.mean(x).alias("mean"), F.stddev_samp(x).alias("stddev"),
        F.skewness(x).alias("skewness"), F.min(x).alias("min"), F.max(x).alias("max"), sketch.alias("q"))
    if not approx:
        values = F.array(*[F.kll_sketch_get_quantile_double("q", F.lit(m)) for m in middle])
        stats = stats.withColumn("q", F.when(F.col("n") > 0, values))
    return {r["column"]: r.asDict() for r in stats.collect()}  # one row a column


def _sketched(df: DataFrame, texts: list[str], other: list[str]) -> dict:
    """Approximate distinct counts of text columns, nulls of these and the others; one scan."""
    cols = [*texts, *other]
    row = df.agg(F.lit(0), *[F.approx_count_distinct(c) for c in texts], *[F.count_if(F.col(c).isNull()) for c in cols]).first()
    distinct = dict(zip(texts, row[1:]))
    return {c: {"distinct": distinct.get(c), "nulls": n} for c, n in zip(cols, row[1 + len(texts):])}


def _counted(df: DataFrame, brackets: dict[str, tuple[float, float]], texts: list[str] = (), other: list[str] = ()) -> DataFrame:
    """(column, inside, number, text, times): values inside a bracket and values of text columns;
    what lies below a bracket, and other NULLs, are counted as one (`inside` false). One scan."""
    empty, none = F.lit(None).cast("double"), F.lit(None).cast("string")
    row = lambda inside, number, text: F.struct(F.lit(inside).alias("inside"), number.alias("number"), text.alias("text"))
    entries = {}
    for c, (low, high) in brackets.items():
        x = F.col(c).cast("double")
        entries[c] = F.when(x < low, row(False, empty, none)).when(x <= high, row(True, x, none))
    for c in texts:
        entries[c] = F.when(F.col(c).isNull(), row(False, empty, none)).otherwise(row(True, empty, F.col(c)))
    for c in other:
        entries[c] = F.when(F.col(c).isNull(), row(False, empty, none))
    long = df.select(*[e.alias(c) for c, e in entries.items()]).unpivot([], list(entries), "column", "e").where("e is not null")
    return long.groupBy("column", "e.inside", "e.number", "e.text").agg(F.count(F.lit(1)).alias("times"))


def median_of_counts(counted: DataFrame, sizes: dict[str, int]) -> DataFrame:
    """(column, median) from (column, number, times); a NULL number stands for smaller values. The median
    is NULL if a middle rank of the column's `sizes` rows is not among the numbers.

    Values are dealt by ranges; sums per range tell which range holds a middle rank, and only
    those ranges are ranked. Up to RANGE values are one range.
    """
    dealt = lambda: counted.repartitionByRange("column", "number").withColumn("_range", F.spark_partition_id())
    ranges = stage(dealt(), "median-ranges") if counted.count() > RANGE else counted.withColumn("_range", F.lit(0))
    size = F.create_map(*[F.lit(x) for pair in sizes.items() for x in pair])[F.col("column")]
    first, second = F.ceil(size / 2), F.floor(size / 2) + 1
    upto = lambda *keys: W.partitionBy(*keys).rowsBetween(W.unboundedPreceding, 0)
    covers = lambda r, to, times: (F.col(to) - F.col(times) < r) & (r <= F.col(to))
    sums = (ranges.groupBy("column", "_range").agg(F.sum("times").alias("_sum"))
            .withColumn("_upto", F.sum("_sum").over(upto("column").orderBy("_range")))  # one row a range
            .where(covers(first, "_upto", "_sum") | covers(second, "_upto", "_sum")))
    ranked = ranges.join(F.broadcast(sums), ["column", "_range"]).withColumn("_to", F.col("_upto") - F.col("_sum") + F.sum("times").over(
        upto("column", "_range").orderBy("number")))
    value = lambda r: F.max(F.when(covers(r, "_to", "times"), F.col("number")))
    return ranked.groupBy("column").agg(((value(first) + value(second)) / 2).alias("median"))


def _medians(df: DataFrame, counted: DataFrame, brackets: dict, sizes: dict[str, int], limits: dict) -> dict[str, float]:
    """Exact medians. Should a bracket miss a middle rank, its column is counted over its whole range."""
    if not brackets:
        return {}
    columns = ["column", "number", "times"]
    found = dict(median_of_counts(counted.where(F.col("column").isin(list(brackets))).select(*columns), sizes).collect())  # one row a column
    missed = [c for c in brackets if found.get(c) is None]
    if missed:
        again = stage(_counted(df, {c: limits[c] for c in missed}), "profile-values")
        found |= dict(median_of_counts(again.select(*columns), sizes).collect())
    return found


def _profile(df: DataFrame, numeric: list[str], texts: list[str], other: list[str], approx: bool, digits: int = 3) -> DataFrame:
    """(column, mean, median, stddev, skewness, distinct_count, null_count), one row per column."""
    empty = dict.fromkeys(("mean", "stddev", "skewness", "q"), None) | {"n": 0, "nulls": 0}
    stats = dict.fromkeys(numeric, empty) | (_summary(df, numeric, approx) if numeric else {})
    filled = {c: s for c, s in stats.items() if s["n"]}
    medians, facts = {c: s["q"][1] for c, s in filled.items()}, {}
    if approx:
        facts = _sketched(df, texts, other) if texts or other else {}
    elif filled or texts or other:
        brackets = {c: (s["q"][0], s["q"][2]) for c, s in filled.items()}
        counted = stage(_counted(df, brackets, texts, other), "profile-values")
        medians = _medians(df, counted, brackets, {c: s["n"] for c, s in filled.items()}, {c: (s["min"], s["max"]) for c, s in filled.items()})
        if texts or other:
            nulls = F.sum(F.when(F.col("inside"), 0).otherwise(F.col("times")))
            facts = {r["column"]: r.asDict() for r in counted.where(F.col("column").isin([*texts, *other])).groupBy("column").agg(
                F.count("text").alias("distinct"), nulls.alias("nulls")).collect()}  # one row a column; none where nothing was counted
    fact = lambda c: facts.get(c, {"distinct": 0, "nulls": 0})
    rows = [(c, s["mean"], medians.get(c), s["stddev"], s["skewness"], None, s["nulls"]) for c, s in stats.items()]
    rows += [(c, None, None, None, None, fact(c)["distinct"] if c in texts else None, fact(c)["nulls"]) for c in [*texts, *other]]
    schema = "column string, mean double, median double, stddev double, skewness double, distinct_count long, null_count long"
    return df.sparkSession.createDataFrame(rows, schema).withColumns({c: F.round(c, digits) for c in STATISTICS})


def profile_numeric(df: DataFrame, cols: list[str] | None = None, approx: bool = False,
                    digits: int = 3) -> DataFrame:
    """Per numeric column: nulls, mean, median, sample stddev and population skewness.

    The median is exact; `approx=True` takes the sketch's and saves the second scan.
    """
    return _profile(df, cols or numeric_columns(df), [], [], approx, digits).select("column", *STATISTICS, "null_count")


def profile_string(df: DataFrame, cols: list[str] | None = None, approx: bool = False) -> DataFrame:
    """Per string column: distinct non-null values and nulls. One scan."""
    return _profile(df, [], cols or string_columns(df), [], approx).select("column", "distinct_count", "null_count")


def profile_nulls(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """NULL count of any column, in one aggregate row that is then turned."""
    cols = cols or df.columns
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return counted.unpivot([], cols, "column", "null_count")


def profile_columns(df: DataFrame, approx: bool = False) -> DataFrame:
    """Profile of all columns by type, one row per column in schema order `position`."""
    numeric, text = numeric_columns(df), string_columns(df)
    other = [c for c in df.columns if c not in {*numeric, *text}]
    out = _profile(df, numeric, text, other, approx)
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    facts = F.create_map(*[F.lit(x) for c in df.columns for x in (c, types[c])])
    place = F.create_map(*[F.lit(x) for i, c in enumerate(df.columns) for x in (c, i)])
    return out.select("column", facts[F.col("column")].alias("type"), place[F.col("column")].alias("position"),
                      *STATISTICS, "distinct_count", "null_count")


def dataset_dims(df: DataFrame, name: str) -> DataFrame:
    """Name, rows and columns of a dataset."""
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(name).alias("dataset"), "rows", F.lit(len(df.columns)).cast("long").alias("columns"))


def dataset_bytes(df: DataFrame) -> DataFrame:
    """Files and bytes behind a file-based DataFrame, from scan metadata only."""
    files = df.select("_metadata.file_path", "_metadata.file_size").groupBy("file_path").agg(
        F.max("file_size").alias("size"))
    return files.agg(F.count(F.lit(1)).alias("files"), F.sum("size").alias("bytes"))


def histogram(df: DataFrame, cols: list[str] | None = None, bins: int = 8) -> DataFrame:
    """Equal-width bins between the smallest and largest value of each column."""
    values = _long(df, cols or numeric_columns(df), "double").where(F.col("value").isNotNull())
    limits = values.groupBy("column").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    width = (F.col("hi") - F.col("lo")) / bins
    place = F.when(F.col("hi") == F.col("lo"), 0).otherwise(
        F.least(F.lit(bins - 1), F.floor((F.col("value") - F.col("lo")) / width)))
    return (values.join(F.broadcast(limits), "column")
            .select("column", place.cast("int").alias("bin"))
            .groupBy("column", "bin").agg(F.count(F.lit(1)).alias("rows")))


def value_frequency(df: DataFrame, cols: list[str]) -> DataFrame:
    return _long(df, cols, "string").groupBy("column", "value").agg(F.count(F.lit(1)).alias("rows"))


def label_frequency(df: DataFrame, labels: DataFrame, cols: list[str]) -> DataFrame:
    """Occurrences of every documented value of the columns with its label. Documented
    values that do not occur count 0; occurring values without a label have NULL.

    `labels` has the columns column, value, label.
    """
    return (value_frequency(df, cols).where(F.col("value").isNotNull())
            .join(labels.where(F.col("column").isin(cols)), ["column", "value"], "full")
            .select("column", "value", "label", F.coalesce("rows", F.lit(0)).alias("rows")))


def dictionary_coverage(df: DataFrame, columns: DataFrame) -> DataFrame:
    """Dictionary against data: each column with its description, filled values, and
    `coverage`: documented, undocumented or orphan (described but not in the data)."""
    filled = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns]).unpivot(
        [], df.columns, "column", "filled")
    state = (F.when(F.col("filled").isNull(), "orphan").when(~F.coalesce("_described", F.lit(False)), "undocumented")
             .otherwise("documented"))
    return (filled.join(columns.withColumn("_described", F.lit(True)), "column", "full")
            .select("column", "description", "filled", state.alias("coverage")))

"""Versioned history: at most one active row per firm and site."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.blank import as_text, blank_to_null
from ..functions.keys import key_text, packed, unpacked
from ..sources.tables import stage
from .dedup import top_per_key
from .identity import generate_ids
from .order import LAST, FirstRow, newest_dates, oldest_first
from .shape import select_required
from .skew import HASH, attach_group_values, key_filter, lookup_join, rare_join, with_filter

ENTITY_IDS = ["group_id", "site_id"]
#: The entity and the content of a row, 16 bytes each.
ENTITY, CONTENT = [HASH, "_f"], ["_c", "_d"]
#: Columns that travel packed in whole rows.
PACKED = ["entity_id", "group_id", "site_id", "row_id"]


def _entity() -> dict[str, Column]:
    parts = [as_text(F.col("group_id")), F.lit("|"), as_text(F.col("site_id"))]
    return {HASH: F.xxhash64(*parts), "_f": F.xxhash64(F.lit(1), *parts), "_row": packed(F.col("row_id"))}


def _newest_of() -> FirstRow:
    return FirstRow(newest_dates(), [F.col("superseded_on")])


def _and_mark(first: Column) -> Column:
    """What is needed of the newest row of an entity."""
    return F.struct(first["_row"].alias("_row"), first["superseded_on"].alias("superseded_on"))


def _or_own(found: DataFrame) -> DataFrame:
    """Rows with the newest row of their entity, which is the row itself where the entity has no other."""
    own = F.struct("_row", "superseded_on")
    return found.withColumn("_newest", F.when(F.col("_found").isNull(), own).otherwise(_and_mark(F.col("_found")))).drop("_found")


def _with_newest(df: DataFrame) -> DataFrame:
    """Add the newest row of each (group, site) and whether that row is still active. The row of an entity
    that has no other is its newest, so only rows of entities with several are shuffled."""
    keyed, newest = df.withColumns(_entity()), _newest_of()
    groups = keyed.groupBy(*ENTITY).agg(F.count(F.lit(1)).alias("_rows"), *newest.aggregates)
    several = groups.where("_rows > 1").select(*ENTITY, "_rows", newest.found().alias("_found"))
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    found = rare_join(keyed, several, ["_f"], "_rows", total, PACKED)
    return _or_own(found).drop("_f")


def _superseded(as_of) -> Column:
    older = F.col("_row") != F.col("_newest._row")
    return F.when(older & F.col("superseded_on").isNull(), F.lit(as_of)).otherwise(F.col("superseded_on"))


def _valid() -> Column:
    return F.col("_newest.superseded_on").isNull() & F.coalesce(F.col("case_id").rlike("^[0-9]+$"), F.lit(False))


def supersede(df: DataFrame, as_of) -> DataFrame:
    """Mark all but the newest row of each (group, site) as superseded; earlier marks
    stay. A wave that arrives late is superseded on arrival."""
    return _with_newest(df).withColumn("superseded_on", _superseded(as_of)).drop("_newest", "_row")


def check_history(df: DataFrame, as_of) -> DataFrame:
    """Supersede, and add `is_valid`: the entity has exactly one active row and its firm
    number is numeric. After superseding, only the newest row can be active."""
    return (_with_newest(df).withColumn("is_valid", _valid())
            .withColumn("superseded_on", _superseded(as_of)).drop("_newest", "_row"))


def split_history(df: DataFrame, as_of) -> tuple[DataFrame, DataFrame]:
    """(clean, errors): together all rows, none in both."""
    checked = check_history(df, as_of)
    return (checked.where("is_valid").drop("is_valid"),
            checked.where(~F.col("is_valid")).drop("is_valid"))


def active_per_entity(df: DataFrame, keys=("entity_id",)) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("versions"),
        F.count_if(F.col("superseded_on").isNull()).alias("active_rows"))


def invariant_single_active(df: DataFrame, keys=("group_id", "site_id")) -> DataFrame:
    """Entities that break the rule of exactly one active row."""
    return active_per_entity(df, keys).where("active_rows <> 1")


def backbone_union(wave: DataFrame, backbone: DataFrame, columns: list[str]) -> DataFrame:
    """Append a wave, after checking that both sides have all backbone columns."""
    return select_required(wave, columns).unionByName(select_required(backbone, columns))


def survivor_order() -> list:
    """Of equal rows the one loaded first stays, with its ids; among those of one load
    an active row goes before a superseded one, so that no entity loses its active row."""
    return [F.col("wave_date").asc_nulls_last(), F.col("loaded_on").asc_nulls_last(),
            F.col("superseded_on").asc_nulls_first(), F.col("row_id").asc()]


def create_backbone(wave: DataFrame, columns: list[str], secret: str, as_of) -> DataFrame:
    """First wave to checked backbone rows (see `check_history`)."""
    return check_history(generate_ids(select_required(wave, columns), secret), as_of)


#: Keys of a wave that are sent to all executors, 8 bytes each; more are shuffled.
FEW = 2_000_000
#: Rows of a wave up to which its changes are gathered, so that a small layer is not many tiny files.
SMALL = 100_000


def _keyed(df: DataFrame, dedupe: list[str]) -> DataFrame:
    """Add the entity and the content (_c, _d) as two hashes each, the packed row id and a hash of it (_r).
    Which parts are NULL goes into the hash, as hashes skip NULLs."""
    nulls = F.concat(*[F.when(F.col(c).isNull(), "0").otherwise("1") for c in dedupe])
    return df.withColumns({
        **_entity(), "_r": F.xxhash64("row_id"),
        "_c": F.xxhash64(nulls, *dedupe), "_d": F.xxhash64(F.lit(1), nulls, *dedupe)})


def _among(rows: DataFrame, keys: DataFrame, name: str, few: bool) -> DataFrame:
    """Rows that may have one of the keys. A few keys go to the rows; with many, all rows pass, and are
    shuffled once, by the join that decides."""
    if not few:
        return rows
    return rows.join(F.broadcast(keys.select(name).distinct()), name, "left_semi")


def _news(wave: DataFrame, known: DataFrame, as_of, few: bool) -> DataFrame:
    """Rows of a wave that tell something new: not in the backbone yet, once each, and with
    other content than every active row. The content holds the firm and site numbers, so equal
    content is that of one entity, whatever ids a second linkage gives. When a file is added again,
    rows that it superseded the first time count as active.

    Decided on row id, dates and hashes alone; the other columns stay where they are."""
    told = _among(known.select("superseded_on", *ENTITY, *CONTENT), wave, "_c", few)
    files = known.join(F.broadcast(wave.select("file_id").distinct()), "file_id", "left_semi").select(*ENTITY, "file_id").distinct()
    replaced = told.where(F.col("superseded_on") == F.lit(as_of)).join(files, ENTITY).select(*CONTENT, "file_id")
    active = told.where("superseded_on is null").select(*CONTENT)
    seen = _among(known.select("_row", "_r"), wave, "_r", few).select("_row")
    fresh = wave.select("_row", *DATES, *ENTITY, *CONTENT, "file_id").join(seen, "_row", "left_anti")
    first = FirstRow(_surviving(), [F.col(c) for c in (*DATES, *ENTITY, "file_id")])
    once = fresh.groupBy(*CONTENT).agg(*first.aggregates).select(*CONTENT, first.found().alias("_one")).select(
        *CONTENT, *[F.col("_one")[c].alias(c) for c in ("_row", *DATES, *ENTITY, "file_id")])
    return once.join(active, CONTENT, "left_anti").join(replaced, [*CONTENT, "file_id"], "left_anti")


#: What the order of rows is decided by, besides the row id.
DATES = ["wave_date", "loaded_on", "latest_event_date", "superseded_on"]


def _surviving() -> dict[str, Column]:
    """The lead of `survivor_order`, as values of which the least goes first."""
    last = lambda c: F.coalesce(F.unix_date(F.col(c)), F.lit(LAST))
    return {"s_wave": last("wave_date"), "s_loaded": last("loaded_on"), "s_superseded": F.col("superseded_on")}


def _newest_of_touched(news: DataFrame, again: DataFrame) -> DataFrame:
    """Per entity with a new row and others, the newest of its new and known rows, and how many are new."""
    narrow, newest = ["_row", "wave_date", "latest_event_date", "superseded_on", *ENTITY], _newest_of()
    both = news.select(*narrow, F.lit(1).alias("_new")).unionByName(again.select(*narrow, F.lit(0).alias("_new")))
    return (both.groupBy(*ENTITY).agg(*newest.aggregates, F.sum("_new").alias("_rows"), F.count(F.lit(1)).alias("_all"))
            .where("_rows > 0 and _all > 1").select(*ENTITY, "_rows", newest.found().alias("_found")))


def _checked(as_of) -> dict[str, Column]:
    """The mark and the validity of rows of touched entities."""
    return {"superseded_on": _superseded(as_of), "is_valid": _valid()}


def _split(known: DataFrame, news: DataFrame, few: bool) -> tuple[DataFrame, DataFrame]:
    """(again, passed): known rows that may be of an entity with a new row, and the others. A few entities go to
    the rows; of many, a filter of fixed size."""
    if few:
        touched = F.broadcast(news.select(HASH).distinct())
        return known.join(touched, HASH, "left_semi"), known.join(touched, HASH, "left_anti")
    marked = with_filter(known, key_filter(news, HASH), HASH)
    return marked.where("_may").drop("_may"), marked.where("not _may").drop("_may")


def _doubtful(wave: DataFrame, verdicts: DataFrame) -> DataFrame:
    """A filter of the row ids of a wave that need a look: all but those of one row that is new, the newest of its
    entity, and active. Of the others the verdict is known without one."""
    plain = verdicts.where((F.col("_newest._row") == F.col("_row")) & F.col("_newest.superseded_on").isNull())
    each = wave.select("_row", F.lit(0).alias("_plain")).unionByName(plain.select("_row", F.lit(1).alias("_plain")))
    odd = each.groupBy("_row").agg(F.count(F.lit(1)).alias("_n"), F.sum("_plain").alias("_plain")).where("_row is null or _plain <> 1 or _n <> 2")
    return key_filter(odd.select(F.xxhash64("_row").alias("_id")), "_id")


def _among_ids(rows: DataFrame, ids: DataFrame) -> DataFrame:
    return with_filter(rows.withColumn("_id", F.xxhash64("_row")), ids, "_id").drop("_id")


def _touched(identified: DataFrame, known: DataFrame, columns: list[str], as_of, size: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(added, again, passed): the new rows of a wave of `size` rows, checked; the known rows that may be of an entity
    with a new row, with `_newest`, which is NULL if they aren't; and the rest of the known rows.

    Everything is decided on narrow rows. Whole rows of the wave are shuffled once at most, to meet the verdict on
    them: of a wave with little news those that may be new, of one with much those that may be anything but new, newest
    and active. Known ones are shuffled once, if their entity may be touched. Ids travel packed."""
    few = size <= FEW
    news = stage(_news(identified, known, as_of, few).drop("loaded_on", "file_id"), "news")
    again, passed = _split(known, news, few)
    newest = _newest_of_touched(news, again)
    own, found = news.select("_row", "superseded_on", *ENTITY, *CONTENT), news.count()
    key, slim = ["_row", *CONTENT], [c for c in columns if c in PACKED and c != "row_id"]
    pack = lambda df, more: df.select(*[packed(F.col(c)).alias(c) if c in slim else F.col(c) for c in columns if c != "row_id"], *more)
    full = lambda df, more=(): df.select(*[unpacked(F.col({"row_id": "_row"}.get(c, c))).alias(c) if c in (*slim, "row_id") else F.col(c)
                                           for c in columns], "_row", "_newest", *more)
    # Rows of a key have one row id.
    met = lambda rows, verdicts: full(top_per_key(pack(rows, key).join(verdicts.select(*key, "_newest"), key), key, survivor_order()[:-1]))
    if few:
        added = met(identified, _or_own(lookup_join(own, newest.drop("_rows"), ["_f"], spread=["_row"])))
    else:
        verdicts = lambda rows: _or_own(rare_join(rows, newest, ["_f"], "_rows", F.lit(max(found, 1))))
        much = 2 * found > size
        ids = _doubtful(identified, verdicts(own)) if much else key_filter(news.select(F.xxhash64("_row").alias("_id")), "_id")
        marked, look = _among_ids(identified, ids), _among_ids(own, ids).where("_may").drop("_may")
        added = met(marked.where("_may"), verdicts(look))
        if much:
            sure = marked.where("not _may").withColumn("_newest", F.struct("_row", "superseded_on"))
            added = added.unionByName(sure.select(*columns, "_row", "_newest"))
    marks = newest.select(*ENTITY, _and_mark(F.col("_found")).alias("_newest"))
    looked = lookup_join(pack(again, ["_row", "is_valid", *ENTITY]), marks, ["_f"], spread=["_row"])
    return added, full(looked, ["is_valid"]), passed


def _with_validity(backbone: DataFrame) -> DataFrame:
    return backbone if "is_valid" in backbone.columns else backbone.withColumn("is_valid", F.lit(True))


def backbone_changes(identified: DataFrame, backbone: DataFrame, columns: list[str], dedupe: list[str], as_of) -> DataFrame:
    """What a wave that has ids (see `identify`) adds to a backbone and changes in it: new rows,
    and known rows whose superseding date or validity is another one, with `is_valid` and `is_new`.

    A row is compared with the active row of its (group, site) only. With equal content the
    known row stays; otherwise it is appended and the older row is superseded, so an entity
    that returns to an earlier state has that state as its active row. Rows that are in the
    backbone already stay out, so adding the same wave again changes nothing. Only entities that get
    a new row are checked again, with all their rows: quarantined ones too, if `backbone` has them
    (and says so in `is_valid`), so they come back as soon as their entity is in order.

    The wave is read several times, so it should be a table. The backbone is scanned for the wave's
    keys and never shuffled, unless the wave has more than FEW rows; then its whole rows are shuffled
    once. What is written and shuffled grows with the wave and the entities it touches.
    """
    known = _keyed(_with_validity(backbone), dedupe)
    wave, size = _keyed(select_required(identified, columns), dedupe), identified.count()
    added, again, _ = _touched(wave, known, columns, as_of, size)
    other = ~F.col("superseded_on").eqNullSafe(_superseded(as_of)) | (F.col("is_valid") != _valid())
    changed = again.where(F.col("_newest").isNotNull() & other)
    marked = lambda df, new: df.withColumns(_checked(as_of)).select(*columns, "is_valid", F.lit(new).alias("is_new"))
    changes = marked(added, True).unionByName(marked(changed, False))
    return changes.hint("rebalance") if size <= SMALL else changes


def with_changes(backbone: DataFrame, changes: DataFrame) -> DataFrame:
    """A backbone with rows replaced by, or extended with, the rows of `changes`, by row id."""
    rest = backbone.join(changes.select("row_id"), "row_id", "left_anti")
    return rest.unionByName(changes.select(*backbone.columns))


def update_backbone(identified: DataFrame, backbone: DataFrame, columns: list[str],
                    dedupe: list[str], as_of) -> DataFrame:
    """The whole backbone, with `is_valid`, after a wave (see `backbone_changes`). `backbone` holds
    valid rows, or all rows with `is_valid`. Entities that the wave does not touch pass as they are."""
    known = _keyed(select_required(_with_validity(backbone), [*columns, "is_valid"]), dedupe)
    wave = _keyed(select_required(identified, columns), dedupe)
    added, again, passed = _touched(wave, known, columns, as_of, identified.count())
    marks = {c: F.when(F.col("_newest").isNull(), F.col(c)).otherwise(made) for c, made in _checked(as_of).items()}
    parts = [added.withColumns(_checked(as_of)), again.withColumns(marks), passed]
    return functools.reduce(DataFrame.unionByName, [p.select(*columns, "is_valid") for p in parts])


SITE_KEY = ["case_id", "establishment_id"]


def _first(column: Column, where: Column | None = None) -> Column:
    """Oldest non-blank value, optionally among some rows only."""
    usable = column.isNotNull() if where is None else column.isNotNull() & where
    return F.min_by(column, F.when(usable, oldest_first()))


def _adopt(rows: DataFrame, who: Column) -> DataFrame:
    made = {i: F.when(who, F.coalesce(F.col(f"_old_{i}"), F.col(i))).otherwise(F.col(i))
            for i in ("entity_id", "site_id")}
    return rows.withColumns(made)


def inherit_oldest_id(df: DataFrame) -> DataFrame:
    """Rows with the same firm and site number take the oldest entity and site id."""
    rows = attach_group_values(
        df.withColumn("_key", key_text(SITE_KEY)), ["_key"],
        [_first(blank_to_null(F.col(i))).alias(f"_old_{i}") for i in ("entity_id", "site_id")],
        spread=["row_id"])
    return _adopt(rows, F.col("_key").isNotNull()).select(*df.columns)


def _supersede_older(rows: DataFrame, file_id: str, as_of) -> Column:
    replaced = (F.col("_key").isNotNull() & (F.col("file_id") != file_id)
                & F.coalesce(F.col("_current") > 0, F.lit(False)))
    return F.when(replaced & F.col("superseded_on").isNull(), F.lit(as_of)).otherwise(
        F.col("superseded_on"))


def inherit_id_from_older_file(df: DataFrame, file_id: str, as_of) -> DataFrame:
    """Rows of the current file take the oldest ids of earlier files, or keep their own;
    the earlier rows they replace are marked superseded."""
    older = F.col("file_id") != file_id
    rows = attach_group_values(
        df.withColumn("_key", key_text(SITE_KEY)), ["_key"],
        [*[_first(blank_to_null(F.col(i)), older).alias(f"_old_{i}")
           for i in ("entity_id", "site_id")],
         F.count_if(~older).alias("_current")], spread=["row_id"])
    adopted = _adopt(rows, F.col("_key").isNotNull() & (F.col("file_id") == file_id))
    return adopted.withColumn("superseded_on", _supersede_older(rows, file_id, as_of)).select(*df.columns)


def _agreeing(texts: list[str]) -> Column:
    """How many of the evidence columns equal the group's first values."""
    return sum((F.coalesce(F.col(t) == F.col(f"_f{t}"), F.lit(False)).cast("int") for t in texts), F.lit(0))


def _donors(rows: DataFrame, texts: list[str], at_least: int, older: Column) -> DataFrame:
    """One row per key: first value of each evidence column, the ids of the first row that agrees
    with them, rows and rows of the current file.

    Rows of a key with the same evidence are one signature, aggregated before the shuffle. First
    values and donor are then found among signatures, so rows are not touched a second time.
    """
    ids = {i: blank_to_null(F.col(i)) for i in ("entity_id", "site_id")}
    when = {i: F.when(c.isNotNull() & older, oldest_first()) for i, c in ids.items()}
    signatures = stage(rows.where(F.col("_key").isNotNull()).groupBy("_key", *texts).agg(
        F.min(F.when(older, oldest_first())).alias("_order"),
        *[F.min_by(c, when[i]).alias(f"_own_{i}") for i, c in ids.items()],
        *[F.min(when[i]).alias(f"_order_{i}") for i in ids],
        F.count(F.lit(1)).alias("_rows"), F.count_if(~older).alias("_current")), "signatures")
    firsts = [F.min_by(t, F.when(F.col(t).isNotNull(), F.col("_order"))).alias(f"_f{t}") for t in texts]
    scored = attach_group_values(signatures, ["_key"], firsts, spread=texts)
    agrees = _agreeing(texts) >= at_least
    return stage(scored.groupBy("_key").agg(
        *[F.min(f"_f{t}").alias(f"_f{t}") for t in texts],
        *[F.min_by(f"_own_{i}", F.when(agrees, F.col(f"_order_{i}"))).alias(f"_old_{i}") for i in ids],
        F.sum("_rows").alias("_rows"), F.sum("_current").alias("_current")), "donors")


def inherit_id_k_of_n(df: DataFrame, evidence: list[str], at_least: int,
                      file_id: str | None = None, as_of=None) -> DataFrame:
    """Inherit ids only on evidence: a row takes the ids of the first row of its firm
    and site number that agrees with the group's first values on `at_least` of the
    evidence columns, and only if the row itself agrees as well. Others keep their own.

    With `file_id`, first values and ids come from earlier files, only rows of that file
    inherit, and the earlier rows of groups that it renews are marked superseded.
    """
    older = F.col("file_id") != file_id if file_id else F.lit(True)
    texts = {f"_e{i}": blank_to_null(F.col(c).cast("string")) for i, c in enumerate(evidence)}
    rows = df.withColumn("_key", key_text(SITE_KEY)).withColumns(texts)
    found = lookup_join(rows, _donors(rows, list(texts), at_least, older), ["_key"], spread=["row_id"], weight="_rows")
    agrees = F.col("_key").isNotNull() & (_agreeing(list(texts)) >= at_least)
    if file_id is None:
        return _adopt(found, agrees).select(*df.columns)
    adopted = _adopt(found, agrees & (F.col("file_id") == file_id))
    return adopted.withColumn("superseded_on", _supersede_older(found, file_id, as_of)).select(*df.columns)

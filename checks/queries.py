"""One query per operator. Each reads whole tables through the public operators."""

from __future__ import annotations

import os
import uuid
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from longreg.functions.blank import blank_to_null
from longreg.operators import clean, dedup, history, identity, link, profile, quality, release, shape
from longreg.sources import bronze, delimited, dictionary, versions
from longreg.sources.tables import shared_folder, stage

from . import fixture as fx
from .fixture import LOADED, SECRET, WAVE_1, WAVE_2, table

IDS = ["entity_id", "group_id", "site_id"]
NAME, CITY, ADDRESS = "uni_establishment_name", "uni_establishment_city", "address_key"
CODE_GROUPS = {
    "legal": ("41", "51", "71", "74", "88"),
    "legal_profit": ("41", "51"),
    "legal_nonprofit": ("71", "74"),
    "foreign": ("93",),
    "public": ("88",),
}
SPLIT_KEYS = ["case_id", ADDRESS, "code_sbi_1"]


def _day(c: str):
    return F.col(c).cast("date").alias(c)


def _linked(df: DataFrame) -> DataFrame:
    more = [c for c in ("match_pass", "agreeing", "match_status") if c in df.columns]
    return df.select("row_id", *IDS, *more)


def _w2(spark, sf):
    return fx.wave(spark, sf, WAVE_2)


def _with_row_ids(df: DataFrame) -> DataFrame:
    """Entity and site ids that differ per row, so that inheriting them shows."""
    for id_col in ("entity_id", "site_id"):
        df = identity.assign_ids(df, ["row_id"], id_col, SECRET, namespace=f"{id_col}-row")
    return identity.assign_ids(df, ["case_id"], "group_id", SECRET, namespace="group")


def _rows(spark, sf):
    return _with_row_ids(fx.both_waves(spark, sf))


# sources and sinks

def scan_csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Write the register as delimited text to the shared folder and scan it back."""
    path = os.path.join(shared_folder(spark), f"register-{uuid.uuid4()}")
    raw = fx.register(spark, sf)
    delimited.write_delimited(raw, path)
    back = delimited.scan_delimited(spark, path, columns=raw.columns)
    return back.select(*[blank_to_null(F.col(c)).alias(c) for c in back.columns])


def bronze_manifest(spark, sf):
    raw = fx.register(spark, sf)
    stamped = [bronze.stamp(raw.where(F.col("wave_date") == F.lit(d)), source=fx.SOURCE, wave_date=d,
                            file_id=fx.FILES[d]) for d in (WAVE_1, WAVE_2)]
    return bronze.manifest(stamped[0].unionByName(stamped[1]))


def bronze_roundtrip(spark, sf):
    """Land both waves, whose delivered columns are named like what the manifest knows, and read them back by it."""
    path = os.path.join(shared_folder(spark), f"bronze-{uuid.uuid4()}")
    raw = fx.register(spark, sf)
    parts = []
    for day, more in ((WAVE_1, {"hq_indicator": "source"}), (WAVE_2, {"hq_indicator": "file_id", "code_sbi_1": "wave_date"})):
        delivered = raw.where(F.col("wave_date") == F.lit(day)).drop("wave_date").select(
            F.col("row_key").cast("string"), "case_id", "hq_indicator", "code_sbi_1").withColumnsRenamed(more)
        bronze.land_bronze(delivered, path, source=fx.SOURCE, wave_date=day, file_id=fx.FILES[day], received_on=LOADED[day], processor="check")
        file = bronze.landed_file(spark, path, fx.FILES[day])
        back = bronze.landed_rows(spark, path, file).withColumnsRenamed({v: k for k, v in more.items()})
        parts.append(back.select("*", F.lit(",".join(file.header)).alias("header"), F.lit(file.rows).cast("long").alias("rows")))
    return parts[0].unionByName(parts[1])


def split_matched_counts(spark, sf):
    linked = link.exact_match(_w2(spark, sf), fx.backbone(spark, sf), [NAME, CITY], unique=True)
    return linked.groupBy(clean.is_matched(linked).alias("matched")).agg(F.count(F.lit(1)).alias("rows"))


def _dictionary(spark, sf):
    """One small dictionary document per part row."""
    part = table(spark, sf, "part")
    entry = F.struct(F.col("p_brand").alias("description"),
                     F.create_map(F.col("p_size").cast("string"), F.col("p_type")).alias("values"))
    study = F.struct(F.col("p_name").alias("title"), F.col("p_partkey").cast("string").alias("id"))
    text = F.to_json(F.struct(study.alias("study"), F.create_map(
        F.concat(F.lit("part_"), F.col("p_partkey").cast("string")), entry).alias("columns")))
    return dictionary.parse_dictionary(part.select(text.alias("text")))


def dictionary_labels(spark, sf):
    _, columns, labels = _dictionary(spark, sf)
    return columns.join(labels, "column")


def dictionary_study(spark, sf):
    return _dictionary(spark, sf)[0].select("title", "id")


# schema operators

def rename_map(spark, sf):
    return shape.rename_columns(table(spark, sf, "customer"), {
        "c_custkey": "case_number", "c_name": "company_name", "c_absent": "never"})


def drop_by_pattern(spark, sf):
    named = table(spark, sf, "orders").withColumnsRenamed(
        {"o_totalprice": "remove_price", "o_orderpriority": "remove_priority"})
    return shape.drop_columns(named, pattern="^remove_", deny=("remove_price",)).withColumn(
        "o_orderdate", F.col("o_orderdate").cast("date"))


def ensure_columns(spark, sf):
    return shape.ensure_columns(table(spark, sf, "customer"), {"c_name": "string", "case_id": "string"})


def order_columns(spark, sf):
    return shape.order_columns(table(spark, sf, "part"), ["p_size", "p_brand"])


def select_required(spark, sf):
    return shape.select_required(table(spark, sf, "orders"), ["o_orderkey", "o_orderstatus"])


def add_lineage(spark, sf):
    return fx.standardised(spark, sf, WAVE_2).select(*shape.LINEAGE)


def standardise_wave(spark, sf):
    """All cleaning operators in a row, as the import jobs run them."""
    df = fx.standardised(spark, sf, WAVE_2)
    return df.select(*[c for c in fx.BACKBONE if c not in IDS and c != "superseded_on"])


def release_projection(spark, sf):
    df = identity.generate_ids(fx.both_waves(spark, sf), SECRET)
    return release.release_projection(df, list(fx.RELEASE), fx.DENY)


# filters

def filter_not_blank(spark, sf):
    df = fx.both_waves(spark, sf)
    return clean.filter_not_blank(df, ["case_id", "establishment_id", "date_founded"]).select(
        "row_key", "case_id", "establishment_id", "date_founded")


def history_active(spark, sf):
    return clean.active_only(fx.backbone(spark, sf)).select("row_id", *IDS)


def release_subsets(spark, sf):
    rows = release.subset_by_codes(fx.both_waves(spark, sf), "code_legal_form", CODE_GROUPS)
    return rows.groupBy("release_group").agg(F.count(F.lit(1)).alias("rows"))


def release_subset_rows(spark, sf):
    return release.subset_by_codes(fx.both_waves(spark, sf), "code_legal_form", CODE_GROUPS).select(
        "row_key", "code_legal_form", "release_group")


def fill_nulls(spark, sf):
    raw = fx.register(spark, sf).select("row_key", "hq_indicator", "correspondence_code_country")
    return clean.fill_nulls(raw, ["hq_indicator", "correspondence_code_country"], "?")


def null_if(spark, sf):
    raw = fx.register(spark, sf).select("row_key", "date_founded", "establishment_number")
    return clean.null_if(raw, {"date_founded": "0", "establishment_number": 0})


# linkage

def _exact(spark, sf, keys, **options):
    return _linked(link.exact_match(_w2(spark, sf), fx.backbone(spark, sf), keys, **options))


def exact_match_override(spark, sf):
    own = identity.generate_ids(_w2(spark, sf), SECRET)
    return _linked(link.exact_match(own, fx.backbone(spark, sf), [NAME, CITY], override=True))


def exact_match_mapped(spark, sf):
    """Source and backbone columns with different names."""
    src = _w2(spark, sf).withColumnRenamed("case_id", "dossier")
    return _linked(link.exact_match(src, fx.backbone(spark, sf),
                                    {"dossier": "case_id", "establishment_id": "establishment_id"}))


def match_cascade(spark, sf, passes):
    return _linked(link.match_cascade(_w2(spark, sf), fx.backbone(spark, sf), passes))


def threshold_match(spark, sf):
    return _linked(link.threshold_match(_w2(spark, sf), fx.backbone(spark, sf),
                                        [ADDRESS, "code_sbi_1", NAME], at_least=2))


def release_restrict(spark, sf):
    src = identity.generate_ids(_w2(spark, sf), SECRET)
    return release.restrict_by_backbone(src, fx.backbone(spark, sf), "code_legal_form",
                                        CODE_GROUPS["legal_profit"]).select("row_id", "entity_id")


def release_by_backbone(spark, sf):
    src = identity.generate_ids(_w2(spark, sf), SECRET)
    return release.subset_by_backbone(src, fx.backbone(spark, sf), "code_legal_form", CODE_GROUPS).select(
        "row_id", "release_group")


def refresh_by_row_id(spark, sf):
    return link.refresh_by_row_id(_rows(spark, sf), fx.backbone(spark, sf),
                                  ["entity_id", "superseded_on"]).select("row_id", "entity_id", "group_id",
                                                                         "superseded_on")


def map_codes(spark, sf):
    raw = fx.register(spark, sf).select("row_key", "correspondence_code_country")
    return clean.map_codes(raw, "correspondence_code_country", "iso3", fx.COUNTRIES)


def map_codes_table(spark, sf):
    nation = table(spark, sf, "nation").select(F.lpad(F.col("n_nationkey").cast("string"), 4, "0"), "n_name")
    raw = fx.register(spark, sf).select("row_key", "correspondence_code_country")
    return clean.map_codes(raw, "correspondence_code_country", "country", nation)


def dictionary_coverage(spark, sf):
    df = table(spark, sf, "orders")
    described = (table(spark, sf, "lineitem").select(F.explode(F.array(
        F.lit("o_orderkey"), F.lit("o_custkey"), F.concat(F.lit("flag_"), F.col("l_returnflag")))).alias("column"))
        .groupBy("column").agg(F.concat(F.lit("seen "), F.count(F.lit(1)).cast("string")).alias("description")))
    return profile.dictionary_coverage(df, described)


# aggregates and profiles

def profile_numeric(spark, sf):
    return profile.profile_numeric(table(spark, sf, "lineitem"), [
        "l_quantity", "l_extendedprice", "l_discount", "l_linenumber"])


def profile_string(spark, sf):
    return profile.profile_string(fx.register(spark, sf), [
        "case_id", "hq_indicator", "establishment_name", "establishment_city", "correspondence_code_country"])


def profile_nulls(spark, sf):
    return profile.profile_nulls(fx.both_waves(spark, sf), ["date_founded", "indication_import", "site_id"])


def profile_columns(spark, sf):
    df = fx.both_waves(spark, sf).select("employees_total", "hq_indicator", "date_founded", "indication_import")
    return profile.profile_columns(df)


def dataset_dims(spark, sf):
    return profile.dataset_dims(table(spark, sf, "orders"), "orders")


def histogram(spark, sf):
    return profile.histogram(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_linenumber"])


def _labels(spark, sf):
    pairs = {"l_returnflag": {"A": "accepted", "R": "returned", "X": "never used"}, "l_linestatus": {"O": "open"}}
    rows = [F.struct(F.lit(c).alias("column"), F.lit(v).alias("value"), F.lit(t).alias("label"))
            for c, d in pairs.items() for v, t in d.items()]
    return spark.range(1).select(F.inline(F.array(*rows)))


def label_frequency(spark, sf):
    return profile.label_frequency(table(spark, sf, "lineitem"), _labels(spark, sf), ["l_returnflag", "l_linestatus"])


def codebook(spark, sf):
    df = table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity")
    described = _labels(spark, sf).select("column").distinct().withColumn("description", F.upper("column"))
    book = dictionary.codebook(profile.profile_columns(df), described, _labels(spark, sf))
    return book.select("position", "name", "label", "type", F.size("categories").alias("labels"), "mean",
                       "median", "stddev", "skewness", "distinct_count", "null_count")


# windows, sets, duplicates

def top1_per_key(spark, sf):
    orders = table(spark, sf, "orders")
    return dedup.top_per_key(orders, ["o_custkey"], [F.col("o_totalprice").desc(), F.col("o_orderkey")]).select(
        "o_custkey", "o_orderkey", "o_totalprice")


def history_supersede(spark, sf):
    ids = identity.generate_ids(fx.both_waves(spark, sf), SECRET)
    return history.supersede(ids, LOADED[WAVE_2]).select("row_id", "group_id", "site_id", "superseded_on")


def inherit_oldest_id(spark, sf):
    return history.inherit_oldest_id(_rows(spark, sf)).select("row_id", "entity_id", "site_id")


def inherit_id_from_older_file(spark, sf):
    return history.inherit_id_from_older_file(_rows(spark, sf), fx.FILES[WAVE_2], LOADED[WAVE_2]).select(
        "row_id", "entity_id", "site_id", "superseded_on")


def inherit_id_k_of_n(spark, sf, with_file=False):
    args = (fx.FILES[WAVE_2], LOADED[WAVE_2]) if with_file else ()
    return history.inherit_id_k_of_n(_rows(spark, sf), [ADDRESS, "code_sbi_1", NAME], 2, *args).select(
        "row_id", "entity_id", "site_id", "superseded_on")


def backbone_union(spark, sf):
    w2 = identity.generate_ids(_w2(spark, sf), SECRET)
    return history.backbone_union(w2, fx.backbone(spark, sf), fx.BACKBONE)


def drop_duplicates(spark, sf):
    df = table(spark, sf, "lineitem").withColumn("l_shipdate", F.col("l_shipdate").cast("date"))
    return dedup.drop_duplicates(df, ["l_orderkey", "l_linenumber"])


def drop_duplicates_register(spark, sf):
    rows = fx.both_waves(spark, sf)
    return dedup.drop_duplicates(rows, fx.DEDUPE, history.survivor_order()).select("row_id", *fx.DEDUPE)


def duplicate_groups(spark, sf):
    return dedup.duplicate_groups(_rows(spark, sf), SPLIT_KEYS)


def renumber_duplicates(spark, sf, allow_blank=False):
    return dedup.renumber_duplicates(_rows(spark, sf), SPLIT_KEYS, LOADED[WAVE_2], allow_blank).select(
        "row_id", *IDS, "superseded_on")


# column transforms

def normalize_text(spark, sf):
    raw = fx.register(spark, sf).select("row_key", "establishment_name", "establishment_city")
    return clean.normalize_text(raw, ["establishment_name", "establishment_city"])


def normalize_documents(spark, sf):
    return clean.normalize_text(table(spark, sf, "documents").select("doc_id", "text"), ["text"]).select(
        "doc_id", "uni_text")


def trim_columns(spark, sf, blank="null"):
    raw = fx.register(spark, sf).select("row_key", "case_id", "establishment_id", "establishment_name", "hq_indicator")
    return clean.trim_columns(raw, ["case_id", "establishment_id", "establishment_name", "hq_indicator"], blank)


def parse_dates(spark, sf):
    raw = fx.register(spark, sf).select("row_key", "date_founded", "date_registration")
    return clean.parse_dates(raw, {"date_founded": "yyyyMMdd", "date_registration": "yyyyMMdd"})


def decode_boolean(spark, sf, true_only=False):
    raw = fx.register(spark, sf).select("row_key", "indication_import")
    return clean.decode_boolean(raw, {"indication_import": "J" if true_only else ("J", "N")}, true_only)


def cast_int(spark, sf):
    raw = fx.register(spark, sf).select("row_key", "employees_total", "establishment_id", "indication_import")
    return clean.cast_int(raw, ["employees_total", "establishment_id", "indication_import"])


def extract_digits(spark, sf):
    raw = fx.register(spark, sf).select("row_key", "establishment_postcode", "establishment_street")
    return clean.extract_digits(raw, {"establishment_postcode": "pc4", "establishment_street": "street_digits"})


def row_date(spark, sf, how):
    raw = fx.register(spark, sf).select("row_key", "date_founded", "date_registration")
    typed = clean.parse_dates(raw, {"date_founded": "yyyyMMdd", "date_registration": "yyyyMMdd"})
    return clean.row_extreme(typed, ["date_founded", "date_registration"], "event_date", how).select(
        "row_key", "event_date")


def address_key(spark, sf):
    return fx.both_waves(spark, sf).select("row_key", ADDRESS)


def pad_ids(spark, sf):
    df = table(spark, sf, "customer").select(
        "c_custkey", F.col("c_custkey").cast("string").alias("case_id"),
        F.when(F.col("c_nationkey") == 0, " ").otherwise(F.col("c_name")).alias("establishment_id"))
    return clean.pad_ids(df, {"case_id": 8, "establishment_id": 12})


def quality_checks(spark, sf):
    raw = fx.register(spark, sf).withColumn("file_id", F.lit(fx.FILES[WAVE_1]))
    return quality.quality_checks(raw, {
        "file id is a random uuid": ("file_id", quality.is_uuid4("file_id")),
        "firm number has 8 digits": ("case_id", quality.is_numeric_id("case_id", 8)),
        "founding date is a date": ("date_founded", F.try_to_date("date_founded", "yyyyMMdd").isNotNull()),
        "head count is an integer": ("employees_total", quality.is_castable("employees_total", "int")),
        "country is an iso date": ("correspondence_code_country", quality.is_iso_date("correspondence_code_country")),
    })


# identity and history

def assign_ids_new(spark, sf):
    return identity.assign_ids(_w2(spark, sf), ["case_id", ADDRESS], "site_id", SECRET,
                               namespace="site-location").select("row_id", "site_id")


def assign_ids_known(spark, sf, **options):
    return identity.assign_ids(_w2(spark, sf), SPLIT_KEYS, "entity_id", SECRET, namespace="entity-location",
                               backbone=fx.backbone(spark, sf), **options).select("row_id", "entity_id")


def generate_ids(spark, sf):
    return identity.generate_ids(fx.both_waves(spark, sf), SECRET).select("row_id", *IDS)


def append_ids(spark, sf):
    return identity.append_ids(_w2(spark, sf), fx.backbone(spark, sf), SECRET).select("row_id", *IDS)


def backbone_create(spark, sf):
    return fx.checked_first_wave(spark, sf)


def _identified(spark, sf):
    return identity.identify(_w2(spark, sf), fx.backbone(spark, sf), SECRET, fx.PASSES_2)


def backbone_update(spark, sf):
    """Link and identify the second wave, write it, and add it to the backbone."""
    return history.update_backbone(stage(_identified(spark, sf), "identified"), fx.backbone(spark, sf),
                                   fx.BACKBONE, fx.DEDUPE, LOADED[WAVE_2])


def backbone_update_quarantine(spark, sf):
    """The same through stored versions: the quarantined rows of the first wave stay in the chain."""
    root = os.path.join(shared_folder(spark), f"backbone-{uuid.uuid4()}")
    first = versions.commit_base(fx.checked_first_wave(spark, sf), root, "first")
    known = versions.read_backbone(spark, first)
    identified = stage(identity.identify(_w2(spark, sf), known, SECRET, fx.PASSES_2), "identified")
    changes = history.backbone_changes(identified, versions.read_rows(spark, first), fx.BACKBONE, fx.DEDUPE, LOADED[WAVE_2])
    return versions.read_rows(spark, versions.commit_changes(changes, first, "second"))


def backbone_changes(spark, sf):
    """Only what the second wave adds and changes."""
    identified = stage(_identified(spark, sf), "identified")
    checked = fx.checked_backbone(spark, sf)
    return history.backbone_changes(identified, checked, fx.BACKBONE, fx.DEDUPE, LOADED[WAVE_2]).select(
        "row_id", "case_id", "superseded_on", "is_valid", "is_new")


def identified_wave(spark, sf):
    return _linked(_identified(spark, sf))


def _both_with_ids(spark, sf):
    return identity.generate_ids(fx.both_waves(spark, sf), SECRET)


def history_clean(spark, sf):
    return history.split_history(_both_with_ids(spark, sf), LOADED[WAVE_2])[0].select("row_id", "superseded_on")


def history_quarantine(spark, sf):
    return history.split_history(_both_with_ids(spark, sf), LOADED[WAVE_2])[1].select("row_id", "case_id")


def invariant_single_active(spark, sf):
    """Before superseding, so that broken entities show."""
    return history.invariant_single_active(_both_with_ids(spark, sf))


def active_per_entity(spark, sf):
    return history.active_per_entity(fx.backbone(spark, sf))


QUERIES = {
    "match_cascade_8": partial(match_cascade, passes=fx.PASSES_8),
    "match_cascade_2": partial(match_cascade, passes=fx.PASSES_2),
    "exact_match_basic": partial(_exact, keys=["case_id", "establishment_id"]),
    "exact_match_allow_blank": partial(_exact, keys=["case_id", "establishment_id", NAME], allow_blank=True),
    "exact_match_prefer_hq": partial(_exact, keys=[NAME], prefer=("hq_indicator",)),
    "exact_match_unique": partial(_exact, keys=[NAME, CITY], unique=True),
    "exact_match_active": partial(_exact, keys=[NAME, "date_founded"], active=True),
    "inherit_id_k_of_n_file": partial(inherit_id_k_of_n, with_file=True),
    "renumber_duplicates_blank": partial(renumber_duplicates, allow_blank=True),
    "trim_columns_empty": partial(trim_columns, blank="empty"),
    "decode_boolean_true_only": partial(decode_boolean, true_only=True),
    "row_latest_date": partial(row_date, how="latest"),
    "row_earliest_date": partial(row_date, how="earliest"),
    "assign_ids_known_blank": partial(assign_ids_known, allow_blank=True),
}
for _f in (scan_csv_roundtrip, bronze_manifest, bronze_roundtrip, split_matched_counts, dictionary_labels, dictionary_study,
           rename_map, drop_by_pattern, ensure_columns, order_columns, select_required, add_lineage, standardise_wave,
           release_projection, filter_not_blank, history_active, release_subsets, release_subset_rows,
           fill_nulls, null_if, exact_match_override, exact_match_mapped, threshold_match, release_restrict,
           release_by_backbone, refresh_by_row_id, map_codes, map_codes_table, dictionary_coverage,
           profile_numeric, profile_string, profile_nulls, profile_columns, dataset_dims, histogram,
           label_frequency, codebook, top1_per_key, history_supersede, inherit_oldest_id,
           inherit_id_from_older_file, inherit_id_k_of_n, backbone_union, drop_duplicates,
           drop_duplicates_register, duplicate_groups, renumber_duplicates, normalize_text,
           normalize_documents, trim_columns, parse_dates, decode_boolean, cast_int, extract_digits,
           address_key, pad_ids, quality_checks, assign_ids_new, assign_ids_known, generate_ids, append_ids,
           backbone_create, backbone_update, backbone_update_quarantine, backbone_changes, identified_wave, history_clean, history_quarantine,
           invariant_single_active, active_per_entity):
    QUERIES[_f.__name__] = _f

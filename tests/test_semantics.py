"""The intended result for each known trap of the data semantics, on tiny frames."""

import datetime as dt
import hmac
import statistics

import pytest
from pyspark.sql import functions as F

from longreg.functions.text import match_text
from longreg.operators import clean, dedup, history, identity, link, profile, quality, release, shape
from longreg.sources.delimited import scan_delimited
from longreg.sources.tables import write_table

from .frames import D, by_row, entity, frame, one

SECRET = "s"
AS_OF = D(2024, 6, 1)


def test_candidates_rank_by_backbone_columns(spark):
    """Active first, then latest event, latest wave, row id - of the backbone, not the source."""
    bb = frame(spark,
               entity("1", name="a", superseded_on=D(2024, 1, 1), latest_event_date=D(2023, 1, 1)),
               entity("2", name="a", latest_event_date=D(2020, 1, 1)),
               entity("3", name="a", latest_event_date=D(2021, 1, 1)))
    out = link.exact_match(frame(spark, {"name": "a"}), bb, ["name"])
    assert by_row(out, "entity_id", "match_status") == {"r0": ("e3", "linked")}


def test_ambiguous_row_is_kept_and_later_passes_go_on(spark):
    bb = frame(spark, entity("1", name="a", city="x"), entity("2", name="a", city="y"), entity("3", name="b"))
    src = frame(spark, {"name": "a", "city": "x"}, {"name": "a", "city": "z"}, {"name": "b"}, {"name": "q"})
    passes = [link.MatchPass.on("name", unique=True), link.MatchPass.on("name", "city")]
    out = by_row(link.match_cascade(src, bb, passes), "entity_id", "match_pass", "match_status")
    assert out == {"r0": ("e1", 2, "linked"), "r1": (None, None, "ambiguous"),
                   "r2": ("e3", 1, "linked"), "r3": (None, None, "unmatched")}


def test_first_pass_wins_and_ids_come_from_one_candidate(spark):
    bb = frame(spark, {**entity("1", name="a"), "site_id": None}, entity("2", city="x"))
    out = link.match_cascade(frame(spark, {"name": "a", "city": "x"}), bb,
                             [link.MatchPass.on("name"), link.MatchPass.on("city")])
    assert by_row(out, "entity_id", "group_id", "site_id") == {"r0": ("e1", "g1", None)}


def test_existing_ids_are_kept_unless_overridden(spark):
    bb = frame(spark, entity("1", name="a"))
    src = frame(spark, {"name": "a", "entity_id": "own", "group_id": "og", "site_id": "os"})
    fill = link.match_cascade(src, bb, [link.MatchPass.on("name")])
    over = link.match_cascade(src, bb, [link.MatchPass.on("name", override=True)])
    assert by_row(fill, "entity_id", "match_status") == {"r0": ("own", "kept")}
    assert by_row(over, "entity_id", "site_id", "match_status") == {"r0": ("e1", "s1", "linked")}


def test_mapped_column_names(spark):
    bb = frame(spark, entity("1", case_id="7"))
    src = frame(spark, {"case_id": "7"}).withColumnRenamed("case_id", "dossier")
    assert by_row(link.exact_match(src, bb, {"dossier": "case_id"}), "entity_id") == {"r0": "e1"}


def test_business_columns_survive_whatever_their_name(spark):
    src = frame(spark, {"name": "a"}).withColumn("y_coordinate_rd", F.lit(5))
    out = link.match_cascade(src, frame(spark, entity("1", name="a")), [link.MatchPass.on("name")])
    assert "y_coordinate_rd" in out.columns


def test_dates_can_be_match_keys(spark):
    bb = frame(spark, entity("1", name="a", founded=D(2020, 1, 1)))
    src = frame(spark, {"name": "a", "founded": D(2020, 1, 1)}, {"name": "a"})
    out = by_row(link.match_cascade(src, bb, [link.MatchPass.on("name", "founded")]), "entity_id")
    assert out == {"r0": "e1", "r1": None}


def test_blank_keys_match_only_when_allowed(spark):
    bb = frame(spark, entity("1", name="a", city=" "))
    src = frame(spark, {"name": "a", "city": None})
    assert by_row(link.exact_match(src, bb, ["name", "city"]), "entity_id") == {"r0": None}
    assert by_row(link.exact_match(src, bb, ["name", "city"], allow_blank=True), "entity_id") == {"r0": "e1"}


def test_prefer_ranks_null_before_h_before_n(spark):
    bb = frame(spark, entity("1", name="a", hq_indicator="N"), entity("2", name="a", hq_indicator="H"),
               entity("3", name="b", hq_indicator="H"), entity("4", name="b"))
    src = frame(spark, {"name": "a"}, {"name": "b"})
    out = link.exact_match(src, bb, ["name"], prefer=("hq_indicator",))
    assert by_row(out, "entity_id") == {"r0": "e2", "r1": "e4"}


def test_active_only_candidates(spark):
    bb = frame(spark, entity("1", name="a", superseded_on=D(2024, 1, 1)))
    assert by_row(link.exact_match(frame(spark, {"name": "a"}), bb, ["name"], active=True), "entity_id") == {"r0": None}


def test_same_entity_twice_is_not_ambiguous(spark):
    bb = frame(spark, entity("1", name="a"), {**entity("1", name="a"), "row_id": "b9"})
    out = link.exact_match(frame(spark, {"name": "a"}), bb, ["name"], unique=True)
    assert by_row(out, "entity_id") == {"r0": "e1"}


def test_not_blank_filter_knows_types(spark):
    df = frame(spark, {"name": "a", "founded": D(2020, 1, 1)}, {"name": " ", "founded": D(2020, 1, 1)}, {"name": "b"})
    assert by_row(clean.filter_not_blank(df, ["name", "founded"]), "name") == {"r0": "a"}


def test_newest_row_stays_active_and_nothing_is_quarantined(spark):
    ids = {"group_id": "g", "site_id": "s", "case_id": "1"}
    df = frame(spark, {**ids, "latest_event_date": D(2020, 1, 1)}, {**ids, "latest_event_date": D(2021, 1, 1)})
    good, bad = history.split_history(df, AS_OF)
    assert by_row(good, "superseded_on") == {"r0": AS_OF, "r1": None}
    assert bad.count() == 0


def test_late_wave_is_superseded_on_arrival(spark):
    ids = {"group_id": "g", "site_id": "s", "case_id": "1"}
    df = frame(spark, {**ids, "wave_date": D(2024, 1, 1)}, {**ids, "wave_date": D(2023, 1, 1)})
    assert by_row(history.supersede(df, AS_OF), "superseded_on") == {"r0": None, "r1": AS_OF}


def test_split_history_is_disjoint_and_complete(spark):
    df = frame(spark, {"group_id": "g", "site_id": "s", "case_id": "x1"},
               {"group_id": "h", "site_id": "s", "case_id": "12", "superseded_on": D(2020, 1, 1)},
               {"group_id": "i", "site_id": "s", "case_id": "13"}, {"case_id": None})
    good, bad = history.split_history(df, AS_OF)
    assert set(by_row(good, "case_id")) == {"r2"}
    assert set(by_row(bad, "case_id")) == {"r0", "r1", "r3"}


def test_duplicates_keep_the_oldest_wave(spark):
    df = frame(spark, {"name": "a", "wave_date": D(2024, 2, 1), "entity_id": "new"},
               {"name": "a", "wave_date": D(2024, 1, 1), "entity_id": "old"}, {"name": None}, {"name": None})
    out = dedup.drop_duplicates(df, ["name"], history.survivor_order())
    assert by_row(out, "entity_id") == {"r1": "old", "r2": None}


def test_known_ids_never_fan_out_and_no_helper_columns_leak(spark):
    bb = frame(spark, {"case_id": "1", "group_id": "g1", "wave_date": D(2023, 1, 1)},
               {"case_id": "1", "group_id": "g2", "wave_date": D(2024, 1, 1)})
    src = frame(spark, {"case_id": "1"}, {"case_id": "2"}, {"case_id": "1", "group_id": "own"}, {"case_id": ""})
    out = identity.assign_ids(src, ["case_id"], "group_id", SECRET, namespace="group", backbone=bb)
    got = by_row(out, "group_id")
    assert out.columns == src.columns and len(got) == 4
    assert (got["r0"], got["r2"], got["r3"]) == ("g1", "own", None) and got["r1"]
    forced = identity.assign_ids(src, ["case_id"], "group_id", SECRET, namespace="group", backbone=bb, force=True)
    assert by_row(forced, "group_id")["r2"] == "g1"


def test_generated_ids_follow_the_five_steps(spark):
    df = frame(spark, {"case_id": "1", "establishment_id": "2"}, {"case_id": "1", "establishment_id": "2"},
               {"case_id": "1", "address_key": "a", "code_sbi_1": "9"}, {"case_id": "1"})
    got = by_row(identity.generate_ids(df, SECRET), "entity_id", "group_id", "site_id")
    assert got["r0"] == got["r1"] and got["r0"][1] == got["r2"][1] == got["r3"][1]
    assert got["r2"][0] and got["r2"][2] and got["r2"][0] != got["r0"][0] and got["r2"][0] != got["r2"][2]
    assert got["r3"][0] is None and got["r3"][2] is None


def test_appended_ids_prefer_own_then_known_then_new(spark):
    bb = frame(spark, {**entity("1", case_id="1", establishment_id="2"), "wave_date": D(2023, 1, 1)},
               entity("2", case_id="3", address_key="a", code_sbi_1="9"))
    src = frame(spark, {"case_id": "1", "establishment_id": "2"}, {"case_id": "3", "address_key": "a", "code_sbi_1": "9"},
                {"case_id": "4"}, {"case_id": "1", "establishment_id": "2", "entity_id": "own"})
    got = by_row(identity.append_ids(src, bb, SECRET), "entity_id", "group_id", "site_id")
    assert got["r0"] == ("e1", "g1", "s1") and got["r1"] == ("e2", "g2", "s2")
    assert all(got["r2"]) and got["r3"] == ("own", "g1", "s1")


def test_ids_are_stable_and_keyed(spark):
    df = frame(spark, {"case_id": "1", "establishment_id": "2"})
    ids = [identity.generate_ids(df, s).first()["entity_id"] for s in ("a", "a", "b")]
    assert ids[0] == ids[1] != ids[2]


def test_release_never_duplicates(spark):
    bb = frame(spark, entity("1"), {**entity("1"), "row_id": "b2"}).withColumn("code", F.lit("41"))
    src = frame(spark, {"entity_id": "e1"}, {"entity_id": "e2"}, {"entity_id": None})
    assert by_row(release.restrict_by_backbone(src, bb, "code", ["41"]), "entity_id") == {"r0": "e1"}
    groups = release.subset_by_backbone(src, bb, "code", {"x": ("41",), "y": ("99",)})
    got = sorted((r["row_id"], r["release_group"]) for r in groups.collect())
    assert got == [("r0", "complete"), ("r0", "x"), ("r1", "complete"), ("r2", "complete")]


def test_split_treats_empty_ids_as_unmatched(spark):
    matched, rest = clean.split_matched(frame(spark, {"entity_id": "e"}, {"entity_id": ""}, {}))
    assert set(by_row(matched, "entity_id")) == {"r0"} and set(by_row(rest, "entity_id")) == {"r1", "r2"}


def test_only_missing_columns_are_added(spark):
    out = shape.ensure_columns(one(spark, case_id="7"), {"case_id": "string", "establishment_id": "string"})
    assert out.first().asDict() == {"case_id": "7", "establishment_id": None}


def test_padding_keeps_blank_blank_and_never_cuts(spark):
    df = spark.createDataFrame([("1",), ("",), (None,), ("123456789",)], "id string")
    assert [r[0] for r in clean.pad_ids(df, {"id": 8}).collect()] == ["00000001", None, None, "123456789"]


def test_denied_columns_fail(spark):
    df = one(spark, remove_x=1, phone=2)
    assert shape.drop_columns(df, pattern="^remove_").columns == ["phone"]
    with pytest.raises(shape.DeniedColumns):
        shape.drop_columns(df, pattern="^remove_", deny=["phone"])
    with pytest.raises(shape.MissingColumns):
        shape.select_required(df, ["absent"])


def test_scan_keeps_text(spark, tmp_path):
    (tmp_path / "in.csv").write_text('id;name\n"01234567";"a ""b"" c"\n1.0;x\n')
    got = scan_delimited(spark, str(tmp_path / "in.csv")).collect()
    assert [tuple(r) for r in got] == [("01234567", 'a "b" c'), ("1.0", "x")]


def test_scan_keeps_lines_that_do_not_fit(spark, tmp_path):
    (tmp_path / "in.csv").write_text("id;name\n1;x;y\n2;z\n")
    got = scan_delimited(spark, str(tmp_path / "in.csv"), columns=["id", "name"], keep_corrupt=True).collect()
    assert [r["_corrupt_record"] for r in got] == ["1;x;y", None]


def test_row_extreme_both_ways_and_type_check(spark):
    df = frame(spark, {"founded": D(2020, 1, 1), "latest_event_date": D(2021, 1, 1)}, {"founded": D(2019, 1, 1)})
    dates = ["founded", "latest_event_date"]
    assert by_row(clean.row_extreme(df, dates, "x"), "x") == {"r0": D(2021, 1, 1), "r1": D(2019, 1, 1)}
    assert by_row(clean.row_extreme(df, dates, "x", "earliest"), "x") == {"r0": D(2020, 1, 1), "r1": D(2019, 1, 1)}
    fill = clean.row_extreme(df, ["founded"], "latest_event_date", overwrite=False)
    assert by_row(fill, "latest_event_date") == {"r0": D(2021, 1, 1), "r1": D(2019, 1, 1)}
    with pytest.raises(TypeError):
        clean.row_extreme(df, ["founded", "name"], "x")


@pytest.mark.parametrize("text, want", [
    ("Bevo Invest B.V. Café-Übergang", "bevoinvestcafeubergang"), ("Novum BV", "novum"), ("BVO", "bvo"),
    ("X b.v. n.v. Y", "xy"), ("v.o.f. De Hoop", "dehoop"), ("abv", "abv"), (None, ""), ("  ", "")])
def test_normalised_text(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(match_text(F.col("t"))).first()[0] == want


@pytest.mark.parametrize("few", [0, clean.CODES])
def test_code_tables(spark, monkeypatch, few):
    monkeypatch.setattr(clean, "CODES", few)
    df = spark.createDataFrame([(" 1",), ("2",), ("9",), (None,)] + [("3",)] * 50, "c string")
    table = spark.createDataFrame([("1", "a"), ("1 ", "a"), ("2", None), ("3", "c"), (None, "n")], "code string, label string")
    got = clean.map_codes(df, "c", "o", table)
    assert got.columns == ["c", "o"]
    assert sorted(map(str, {(r["c"], r["o"]) for r in got.collect()})) == sorted(map(str, {(" 1", "a"), ("2", "UDF"), ("9", "UDF"), (None, None), ("3", "c")}))
    assert got.count() == 54
    with pytest.raises(Exception, match="two labels for a code of c: 3"):
        clean.map_codes(df, "c", "o", table.union(spark.createDataFrame([("3", "d")], table.schema))).collect()


def test_address_parts_stay_apart(spark):
    df = spark.createDataFrame([("a1", "23"), ("a12", "3"), ("", None)], "s string, n string")
    keys = [r["k"] for r in clean.concat_key(df, ["s", "n"], "k").collect()]
    assert keys == ["a1|23", "a12|3", None]


def test_unknown_codes_and_null_codes(spark):
    df = spark.createDataFrame([("1",), ("9",), (None,)], "c string")
    assert [r["o"] for r in clean.map_codes(df, "c", "o", {"1": "NLD"}).collect()] == ["NLD", "UDF", None]
    assert [r["o"] for r in clean.map_codes(df, "c", "o", {"1": "NLD"}, default=None).collect()] == ["NLD", None, None]


def test_booleans(spark):
    df = spark.createDataFrame([("J",), ("N",), ("?",), (None,)], "c string")
    assert [r[0] for r in clean.decode_boolean(df, {"c": ("J", "N")}).collect()] == [True, False, None, None]
    assert [r[0] for r in clean.decode_boolean(df, {"c": "J"}, true_only=True).collect()] == [True, False, False, False]


def test_distinct_count_leaves_nulls_out(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "c string")
    assert profile.profile_string(df).first().asDict() == {"column": "c", "distinct_count": 1, "null_count": 1}


def test_profile_covers_decimals_empty_and_even_counts(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, None), (10, None)], "a int, b double").withColumn(
        "d", F.col("a").cast("decimal(9,2)"))
    got = {r["column"]: r.asDict() for r in profile.profile_numeric(df).collect()}
    assert got["a"]["median"] == 2.5 and got["d"]["median"] == 2.5 and got["a"]["mean"] == 4.0
    assert got["b"]["median"] is None and got["b"]["null_count"] == 4


@pytest.mark.parametrize("bracket", [(90.0, 95.0), (2.0, 3.0), (50.0, 50.0), (0.0, 100.0)])
def test_median_is_exact_whatever_the_bracket(spark, bracket):
    df = spark.range(101).select(F.col("id").cast("double").alias("c"))
    counted = profile._counted(df, {"c": bracket})
    assert profile._medians(df, counted, {"c": bracket}, {"c": 101}, {"c": (0.0, 100.0)}) == {"c": 50.0}


@pytest.mark.parametrize("few", [0, 1000])
def test_medians_are_selected_by_ranges(spark, monkeypatch, few):
    monkeypatch.setattr(profile, "RANGE", few)
    values = {"a": [3.0, 1.0, 2.0] * 50, "b": [5.0] * 7, "c": [float(i * i % 97) for i in range(100)], "d": [1.0, 9.0]}
    rows = [(c, v, values[c].count(v)) for c in values for v in set(values[c])]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = profile.median_of_counts(spark.createDataFrame(rows, "column string, number double, times long"),
                                         {c: len(v) for c, v in values.items()}).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert {r["column"]: r["median"] for r in found} == {c: statistics.median(v) for c, v in values.items()}


def test_a_profile_scans_its_table_twice(spark, tmp_path):
    spark.range(50).select("id", F.col("id").cast("string").alias("it's"), F.current_date().alias("d"), F.lit(None).cast("double").alias("none"),
                           F.lit(None).cast("string").alias("blank")).write.parquet(str(tmp_path / "t"))
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    table = spark.read.parquet(str(tmp_path / "t"))
    rows = {r["column"]: r for r in profile.profile_columns(table.mapInPandas(count, table.schema)).collect()}
    assert seen.value == 100
    assert (rows["id"]["median"], rows["it's"]["distinct_count"], rows["d"]["null_count"], rows["none"]["null_count"], rows["blank"]["null_count"],
            rows["blank"]["distinct_count"]) == (24.5, 50, 0, 50, 50, 0)
    none = {r["column"]: r for r in profile.profile_columns(table.where("false")).collect()}
    assert none["it's"]["distinct_count"] == none["it's"]["null_count"] == 0 and none["id"]["median"] is None


def test_history_takes_its_date_as_argument(spark):
    ids = {"group_id": "g", "site_id": "s", "case_id": "1"}
    df = frame(spark, {**ids, "wave_date": D(2023, 1, 1)}, ids)
    assert by_row(history.supersede(df, D(1999, 9, 9)), "superseded_on")["r0"] == D(1999, 9, 9)


SITE = {"case_id": "1", "establishment_id": "2"}


def test_inherit_from_older_file(spark):
    df = frame(spark, {**SITE, "entity_id": "old", "site_id": "so", "file_id": "f0", "wave_date": D(2023, 1, 1)},
               {**SITE, "entity_id": "new", "site_id": "sn"},
               {"case_id": "7", "establishment_id": "8", "entity_id": "first"},
               {"case_id": "9", "establishment_id": "9", "entity_id": "gone", "file_id": "f0"})
    out = by_row(history.inherit_id_from_older_file(df, "f1", AS_OF), "entity_id", "site_id", "superseded_on")
    assert out == {"r0": ("old", "so", AS_OF), "r1": ("old", "so", None), "r2": ("first", None, None),
                   "r3": ("gone", None, None)}


def test_inherit_on_evidence(spark):
    base = {**SITE, "name": "n", "city": "c", "code_sbi_1": "s"}
    df = frame(spark, {**base, "entity_id": "a", "wave_date": D(2023, 1, 1)},
               {**base, "entity_id": "b", "city": "moved"}, {**base, "entity_id": "c", "city": "x", "name": "y"})
    out = history.inherit_id_k_of_n(df, ["name", "city", "code_sbi_1"], 2)
    assert by_row(out, "entity_id") == {"r0": "a", "r1": "a", "r2": "c"}


def test_oldest_id_skips_blank_ids(spark):
    df = frame(spark, {**SITE, "entity_id": "", "wave_date": D(2022, 1, 1)},
               {**SITE, "entity_id": "a", "wave_date": D(2023, 1, 1)}, {**SITE, "entity_id": "b"},
               {"case_id": "1", "entity_id": "alone"})
    assert by_row(history.inherit_oldest_id(df), "entity_id") == {"r0": "a", "r1": "a", "r2": "a", "r3": "alone"}


def test_renumber_treats_null_and_empty_keys_alike(spark):
    df = frame(spark, {"case_id": "1", "city": None, "entity_id": "a", "wave_date": D(2023, 1, 1)},
               {"case_id": "1", "city": "", "entity_id": "b"})
    out = dedup.renumber_duplicates(df, ["case_id", "city"], AS_OF, allow_blank=True)
    assert by_row(out, "entity_id", "superseded_on") == {"r0": ("a", AS_OF), "r1": ("a", None)}
    kept = dedup.renumber_duplicates(df, ["case_id", "city"], AS_OF)
    assert by_row(kept, "entity_id") == {"r0": "a", "r1": "b"}


def test_lineage_is_validated_and_can_fill_only(spark):
    args = dict(source="x", wave_date="2024-01-01", file_id="0b8f4c1e-1a55-4f5e-9d0a-3f6f0f3c0001",
                loaded_on="2024-01-02", secret=SECRET, row_key=["k"])
    df = spark.createDataFrame([("a", "mine"), (None, "mine"), ("", "mine")], "k string, source string")
    out = shape.add_lineage(df, **args)
    assert out.columns[:11] == shape.LINEAGE
    assert out.select("row_id").distinct().count() == 3 and out.first()["source"] == "x"
    assert shape.add_lineage(df, **{**args, "overwrite": False}).first()["source"] == "mine"
    for wrong in ({"wave_date": "2024-13-01"}, {"file_id": "nope"}, {"loaded_on": None}):
        with pytest.raises(ValueError):
            shape.add_lineage(df, **{**args, **wrong})


def test_quality_rules(spark):
    df = spark.createDataFrame([("2024-02-30", "550e8400-e29b-41d4-a716-446655440000"), ("2024-02-29", "x"), (None, None)],
                               "d string, u string")
    got = {r["rule"]: (r["rows"], r["blank"], r["failed"]) for r in quality.quality_checks(df, {
        "date": ("d", quality.is_iso_date("d")), "uuid": ("u", quality.is_uuid4("u"))}).collect()}
    assert got == {"date": (3, 1, 1), "uuid": (3, 1, 1)}


def test_tables_are_never_written_over_their_input(spark, tmp_path):
    path = str(tmp_path / "t")
    assert write_table(spark.range(5), path) == 5
    with pytest.raises(ValueError):
        write_table(spark.read.parquet(path), path, mode="overwrite", reads=[path])


def test_order_columns(spark):
    assert shape.order_columns(one(spark, b=1, z=2, a=3), ["z", "absent"]).columns == ["z", "a", "b"]


def test_refresh_lets_the_right_side_win(spark):
    left = frame(spark, {"entity_id": "a"}, {"entity_id": "b"})
    right = frame(spark, {"entity_id": None, "row_id": "r0"})
    assert by_row(link.refresh_by_row_id(left, right, ["entity_id"]), "entity_id") == {"r0": None, "r1": None}


def test_dates_parse_by_pattern(spark):
    df = spark.createDataFrame([("20240229", "31-12-2020"), ("0", "2020-12-31"), (None, "")], "date_a string, date_b string")
    got = clean.parse_dates(df, {"date_a": "yyyyMMdd", "date_b": "dd-MM-yyyy"}).collect()
    assert [(r["date_a"], r["year_a"], r["month_a"], r["day_a"]) for r in got] == [
        (dt.date(2024, 2, 29), 2024, 2, 29), (None, None, None, None), (None, None, None, None)]
    assert [r["date_b"] for r in got] == [dt.date(2020, 12, 31), None, None]


def test_ids_are_hmacs_and_the_secret_is_in_no_plan(spark, capsys):
    secrets = ["a secret of the register", "x" * 100]
    for secret in secrets:
        df = identity.generate_ids(frame(spark, {"case_id": " 12 ", "establishment_id": "3"}), secret)
        row = df.first()
        for id_col, text in (("group_id", "group|2:12"), ("entity_id", "entity|2:12|1:3")):
            digest = hmac.new(secret.encode(), text.encode(), "sha256").hexdigest()
            assert row[id_col] == "-".join((digest[:8], digest[8:12], digest[12:16], digest[16:20], digest[20:32]))
        df.write.format("noop").mode("overwrite").save()
        df.explain("extended")
        df.explain("formatted")
        shown = capsys.readouterr().out + df._jdf.queryExecution().toString()
        assert "sha2" in shown and not any(t in shown for t in (secret, secret.encode().hex(), secret.encode().hex().upper()))


def test_every_script_keeps_a_key(spark):
    names = ["Łódź", "Αθήνα", "Київ", "Ştefan Łódź ß", "Café B.V.", "CAFÉ bv", "ΑΘΗΝΑΣ", "Αθηνας", "東京 nv", "Ærø & Co", "бbv", "bv", "Ÿ_9"]
    df = spark.createDataFrame([(n,) for n in names], "n string").select("n", match_text(F.col("n")).alias("k"))
    keys = {r["n"]: r["k"] for r in df.collect()}
    assert list(keys.values()) == ["lodz", "αθηνα", "киів", "stefanlodzss", "cafe", "cafe", "αθηνασ", "αθηνασ", "東京", "aeroco", "бbv", "", "y_9"]

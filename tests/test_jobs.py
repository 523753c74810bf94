"""The five jobs from delimited files to codebook, with Parquet in between."""

import json

import pytest
from pyspark.sql import functions as F

from longreg.plans import jobs
from longreg.plans.jobs import Wave
from longreg.sources.bronze import land_bronze, landed_file, landed_rows
from longreg.sources.dictionary import load_dictionary
from longreg.sources.tables import scan_table
from longreg.sources.versions import read_backbone, read_quarantine
from longreg.specs import register, survey
from longreg.streaming.waves import follow_waves

FILES = [f"0b8f4c1e-1a55-4f5e-9d0a-3f6f0f3c000{i}" for i in range(4)]
SECRET = "job-secret"
COUNTRIES = {"0001": "NLD"}


def write_csv(path, header, rows, sep):
    lines = [sep.join(header)] + [sep.join(f'"{r.get(h, "")}"' for h in header) for r in rows]
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def firm(number, site, name, **more):
    return {"Dossier": number, "Vestigingsnummer": site, "Handelsnaam": name, "Zaaknaam": name,
            "Straatvestadrs": "Straat", "Huisnrvestadrs": "1", "Postcdvestadrs": "1234 AB",
            "Pltsvestadrs": "Utrecht", "Cdhoofdactiviteit": "00101", "Cdrechtsvorm": "41",
            "Datoprichting": "20200115", "Cdlndcorradrs": "0001", "Boekjaar": "0", "Indimport": "J", **more}


HEADER = list(register.RENAME)
WAVE_1 = [firm("00000001", "000000000001", "Alfa B.V."), firm("00000001", "000000000001", "Alfa B.V."),
          firm("00000002", "", "Beta", Cdrechtsvorm="01"), firm("X", "000000000009", "Gamma"),
          firm("00000004", "000000000004", "Delta", Cdrechtsvorm="88", Huisnrvestadrs="4")]
WAVE_2 = [firm("00000001", "000000000001", "Alfa B.V.", Huisnrvestadrs="7"), firm("00000002", "", "Beta", Cdrechtsvorm="01"),
          firm("00000005", "000000000005", "Epsilon")]
SURVEY_HEADER = [h for h in survey.RENAME if h not in ("bagnaid",)] + ["bagnaid"]
SURVEY = [{"lisanr": "1", "kvkdosnr": "1", "kvkvestnr": "1", "naam": "Alfa", "sbi08": "00101", "opgehoogd": "JA",
           "datummut": "2020-01-15", "telefoon": "030", "postcode": "1234 AB"},
          {"lisanr": "2", "naam": "delta bv", "straat": "Straat", "huisnr": "4", "plaats": "UTRECHT", "sbi08": "00101"},
          {"lisanr": "3", "naam": "Nobody"}]


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    files = [write_csv(root / "w1.csv", HEADER, WAVE_1, ";"), write_csv(root / "w2.csv", HEADER, WAVE_2, ";"),
             write_csv(root / "s.csv", SURVEY_HEADER, SURVEY, ",")]
    run = lambda i, date, bb: jobs.import_register(
        spark, Wave(files[i], "register", date, FILES[i], date), register.REGISTER, str(root), SECRET, bb,
        {"countries": COUNTRIES})
    first = run(0, "2023-12-21", None)
    second = run(1, "2024-02-05", first["backbone"])
    linked = jobs.link_survey(spark, Wave(files[2], "survey", "2024-12-04", FILES[2], "2024-12-05"), survey.SURVEY,
                              str(root), SECRET, second["backbone"])
    return {"root": str(root), "first": first, "second": second, "survey": linked}


def test_first_wave_makes_the_backbone(spark, world):
    bb = read_backbone(spark, world["first"]["backbone"])
    assert len(bb.columns) == 82
    rows = {r["case_id"]: r for r in bb.collect()}
    assert set(rows) == {"00000001", "00000002", "00000004"}  # the repeated row is dropped
    assert [r["case_id"] for r in read_quarantine(spark, world["first"]["backbone"]).collect()] == ["X"]
    one = rows["00000001"]
    assert (one["uni_company_name"], one["establishment_pc4"], one["correspondence_code_iso3c"]) == ("alfa", "1234", "NLD")
    assert one["annual_report_year"] is None and one["indication_import"] is True and one["entity_id"]
    assert rows["00000002"]["site_id"] and str(one["latest_event_date"]) == "2020-01-15"


def test_second_wave_extends_the_history(spark, world):
    bb = read_backbone(spark, world["second"]["backbone"])
    moved = sorted(bb.where("case_id = '00000001'").collect(), key=lambda r: r["wave_date"])
    assert len({r["entity_id"] for r in moved}) == 1
    assert [str(r["superseded_on"]) for r in moved] == ["2024-02-05", "None"]
    assert bb.where("case_id = '00000002'").count() == 1  # unchanged content is not added again
    assert bb.where("case_id = '00000005'").count() == 1
    first = read_backbone(spark, world["first"]["backbone"])
    same = first.select("case_id", "entity_id").intersect(bb.select("case_id", "entity_id"))
    assert same.count() == 3


def test_silver_and_manifest(spark, world):
    silver = scan_table(spark, world["second"]["silver"], ["linked"])
    assert world["second"]["silver_rows"] == silver.count() == 3
    assert silver.where("linked").count() == 3
    log = scan_table(spark, f"{world['root']}/bronze/register/manifest").orderBy("wave_date").collect()
    assert [(str(r["wave_date"]), r["rows"]) for r in log] == [("2023-12-21", 5), ("2024-02-05", 3)]


def test_survey_is_linked(spark, world):
    rows = {r["lisa_id"]: r for r in scan_table(spark, world["survey"]["silver"], ["linked"]).collect()}
    assert (rows["1"]["case_id"], rows["1"]["match_pass"], rows["1"]["linked"]) == ("00000001", 1, True)
    assert rows["2"]["case_id"] is None and rows["2"]["match_pass"] == 4
    assert rows["3"]["match_status"] == "unmatched" and not rows["3"]["linked"]
    assert "establishment_phone" not in rows["1"].asDict()
    assert rows["1"]["counts_raised"] is True


def test_releases(spark, world, tmp_path):
    path = str(tmp_path / "gold")
    jobs.release_register(spark, world["first"]["silver"], register.REGISTER, register.LEGAL_FORMS, path)
    gold = scan_table(spark, path)
    assert len(gold.columns) == 65 + 1
    counts = {r["release_group"]: r["count"] for r in gold.groupBy("release_group").count().collect()}
    assert counts == {"complete": 3, "legal": 2, "legal_profit": 1, "public": 1}
    path = str(tmp_path / "survey")
    jobs.release_survey(spark, world["survey"]["silver"], world["second"]["backbone"], survey.SURVEY,
                        register.LEGAL_FORMS, path)
    gold = scan_table(spark, path)
    assert len(gold.columns) == 52 + 1
    counts = {r["release_group"]: r["count"] for r in gold.groupBy("release_group").count().collect()}
    assert counts == {"complete": 2, "legal": 2, "legal_profit": 1, "public": 1}


def test_codebook(spark, world, tmp_path):
    entry = {"description": "Legal form", "values": {"41": "Limited", "88": "Public"}}
    book = tmp_path / "d.json"
    book.write_text(json.dumps({"study": {"title": "T", "id": "1"}, "columns": {
        "code_legal_form": entry, "absent": {"description": "Not in the data"}}}, indent=1))
    study, columns, labels = load_dictionary(spark, str(book))
    assert study.first()["title"] == "T" and columns.count() == 2 and labels.count() == 2
    for kind in ("xml", "json", "parquet"):
        out = jobs.build_codebook(spark, world["first"]["silver"], str(book), str(tmp_path / kind), kind)
    rows = {r["name"]: r for r in out.collect()}
    assert rows["code_legal_form"]["label"] == "Legal form" and len(rows["code_legal_form"]["categories"]) == 2
    assert rows["entity_id"]["distinct_count"] == 3 and rows["site_id"]["label"] == "No description provided"
    xml = spark.read.format("xml").option("rowTag", "var").load(str(tmp_path / "xml"))
    assert xml.count() == out.count()
    block = lambda part, tag: spark.read.format("xml").option("rowTag", tag).load(str(tmp_path / f"xml-{part}"))
    assert block("study", "stdyDscr").first()["title"] == "T"
    file = block("file", "fileDscr").first()
    silver = scan_table(spark, world["first"]["silver"])
    assert file["rows"] == silver.count() and file["columns"] == len(silver.columns) and file["bytes"] > 0
    coverage = {r["column"]: r["coverage"] for r in block("coverage", "coverage").collect()}
    assert coverage["absent"] == "orphan" and coverage["site_id"] == "undocumented" and coverage["code_legal_form"] == "documented"


def test_waves_are_followed(spark, tmp_path):
    raw = spark.createDataFrame([("1",), ("2",)], "id string")
    keys = dict(source="s", wave_date="2024-01-01", received_on="2024-01-02", processor="t")
    land_bronze(raw, str(tmp_path / "b"), file_id=FILES[0], **keys)
    seen = []
    schema = scan_table(spark, str(tmp_path / "b" / "data")).schema

    def run():
        follow_waves(spark, str(tmp_path / "b" / "data"), schema, str(tmp_path / "c"),
                     lambda batch, i: seen.append(sorted(r["id"] for r in batch.collect()))).awaitTermination(120)

    run()
    land_bronze(raw.where(F.col("id") == "2"), str(tmp_path / "b"), file_id=FILES[1], **keys)
    run()
    assert [s for s in seen if s] == [["1", "2"], ["2"]]


def _import(spark, root, path, i, date, bb=None):
    return jobs.import_register(spark, Wave(path, "register", date, FILES[i], date), register.REGISTER, str(root), SECRET, bb,
                                {"countries": COUNTRIES})


def test_an_earlier_state_that_returns_is_active(spark, tmp_path):
    at = lambda number: [firm("00000001", "000000000001", "Alfa", Huisnrvestadrs=number), firm("00000002", "000000000002", "Beta")]
    bb = None
    for i, (date, number) in enumerate([("2023-12-21", "1"), ("2024-02-05", "2"), ("2024-03-05", "1"), ("2024-04-05", "1")]):
        bb = _import(spark, tmp_path, write_csv(tmp_path / f"{i}.csv", HEADER, at(number), ";"), i, date, bb)["backbone"]
    rows = read_backbone(spark, bb).where("case_id = '00000001'").orderBy("wave_date").collect()
    assert [(r["uni_establishment_number"], str(r["superseded_on"])) for r in rows] == [
        ("1", "2024-02-05"), ("2", "2024-03-05"), ("1", "None")]
    assert len({r["site_id"] for r in rows}) == 1
    assert read_backbone(spark, bb).where("case_id = '00000002'").count() == 1


def test_lines_and_columns_of_a_file_are_kept(spark, tmp_path):
    for i, lines in enumerate(["id;x\n1;a\n", "id;x;new\n2;b;c\n3;d;e;EXTRA\n4\n"] * 2):
        (tmp_path / f"{i}.csv").write_text(lines)
        wave = Wave(str(tmp_path / f"{i}.csv"), "s", "2024-01-01", FILES[i % 2], "2024-01-02")  # each landed twice
        jobs._land(spark, wave, ";", str(tmp_path), "t")
        landed = landed_rows(spark, f"{tmp_path}/bronze/s", landed_file(spark, f"{tmp_path}/bronze/s", wave.file_id))
    rows = sorted(landed.collect(), key=lambda r: r["id"])
    assert landed.columns == ["id", "x", "new", "_corrupt_record"]
    assert [(r["id"], r["new"], r["_corrupt_record"]) for r in rows] == [
        ("2", "c", None), ("3", "e", "3;d;e;EXTRA"), ("4", None, "4")]
    log = scan_table(spark, f"{tmp_path}/bronze/s/manifest").collect()
    assert sorted((r["file_id"], r["rows"]) for r in log) == [(FILES[0], 1), (FILES[1], 3)]


def test_a_missing_code_table_is_an_error(spark, tmp_path):
    path = write_csv(tmp_path / "w.csv", HEADER, WAVE_2, ";")
    with pytest.raises(ValueError, match="countries"):
        jobs.import_register(spark, Wave(path, "register", "2024-02-05", FILES[1], "2024-02-05"), register.REGISTER, str(tmp_path), SECRET)

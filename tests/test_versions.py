"""Stored versions: what a wave costs, what stays in the chain, and what a dead run leaves behind."""

import pathlib

import pytest
from pyspark.sql import functions as F

from checks import fixture as fx
from longreg.operators import history, identity, skew
from longreg.plans import jobs
from longreg.sources import tables, versions
from longreg.sources.bronze import landed_file, landed_rows, land_bronze, read_manifest
from longreg.sources.tables import scan_table, stage
from longreg.specs import register
from longreg.streaming import waves

from .conftest import SF
from .frames import BASE, D, by_row, frame
from .test_jobs import COUNTRIES, FILES, HEADER, SECRET, WAVE_1, WAVE_2, Wave, firm, write_csv

AS_OF = fx.LOADED[fx.WAVE_2]
COLUMNS = list(BASE)
DEDUPE = ["case_id", "establishment_id", "name"]


def rows_of(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def changes(wave, state, as_of=D(2024, 6, 1)):
    return history.backbone_changes(wave, state, COLUMNS, DEDUPE, as_of)


def test_quarantined_rows_come_back(spark):
    ids = {"group_id": "g", "site_id": "s", "case_id": "1", "establishment_id": "2"}
    old = frame(spark, {**ids, "row_id": "a", "name": "x", "superseded_on": D(2024, 1, 1)}, {"row_id": "b", "group_id": "h", "case_id": "X"},
                {"row_id": "c", "group_id": "i", "case_id": "3"})
    state = stage(history.check_history(old, D(2024, 1, 2)), "state")
    assert by_row(state, "is_valid") == {"a": False, "b": False, "c": True}  # a's entity has no active row
    wave = frame(spark, {**ids, "row_id": "n", "name": "y", "wave_date": D(2024, 5, 1)})
    new = changes(wave, state)
    assert by_row(new, "is_valid", "is_new") == {"a": (True, False), "n": (True, True)}
    assert by_row(history.with_changes(state, new), "is_valid") == {"a": True, "b": False, "c": True, "n": True}


def test_a_quarantined_row_that_comes_again_is_known(spark):
    state = stage(history.check_history(frame(spark, {"row_id": "b", "group_id": "h", "case_id": "X", "name": "q"}), D(2024, 1, 2)), "state")
    wave = frame(spark, {"row_id": "z", "group_id": "h", "case_id": "X", "name": "q", "file_id": "f2", "wave_date": D(2024, 5, 1)})
    assert changes(wave, state).count() == 0


def test_parts_that_are_null_do_not_look_alike(spark):
    state = stage(history.check_history(frame(spark, {"row_id": "b", "group_id": "h", "case_id": "1", "name": None, "establishment_id": "q"}), D(2024, 1, 2)), "state")
    wave = frame(spark, {"row_id": "z", "group_id": "h", "case_id": "1", "name": "q", "wave_date": D(2024, 5, 1)})
    assert by_row(changes(wave, state), "is_new") == {"z": True, "b": False}


@pytest.mark.parametrize("few", [0, history.FEW])
def test_changes_do_not_depend_on_the_way_to_them(spark, monkeypatch, few):
    monkeypatch.setattr(history, "FEW", few)
    known = fx.checked_backbone(spark, SF)
    named = stage(identity.identify(fx.wave(spark, SF, fx.WAVE_2), known.where("is_valid").drop("is_valid"), fx.SECRET, fx.PASSES_2), "named")
    new = stage(history.backbone_changes(named, known, fx.BACKBONE, fx.DEDUPE, AS_OF), "new")
    after = stage(history.with_changes(known, new), "after")
    assert after.count() == known.count() + new.where("is_new").count()
    assert after.where("not is_valid").count() >= known.where("not is_valid").count() > 0
    assert history.backbone_changes(named, after, fx.BACKBONE, fx.DEDUPE, AS_OF).count() == 0
    whole = history.check_history(after.drop("is_valid"), AS_OF)
    assert rows_of(whole) == rows_of(after)  # checking every entity again finds nothing else


def shuffled(spark):
    """Bytes that this session has shuffled so far."""
    return spark.sparkContext._jsc.sc().statusStore().executorSummary("driver").totalShuffleWrite()


def folder_bytes(path):
    return sum(p.stat().st_size for p in path.rglob("*.parquet"))


def test_a_small_wave_costs_the_same_on_a_long_history(spark, tmp_path):
    known = fx.checked_backbone(spark, SF)
    named = identity.identify(fx.wave(spark, SF, fx.WAVE_2), known.where("is_valid").drop("is_valid"), fx.SECRET, fx.PASSES_2)
    wave = stage(named.where(F.xxhash64("row_id") % 50 == 0), "small-wave")
    cost = {}
    for times in (1, 8):
        copy = lambda c: F.when(F.col("_i") > 0, F.concat(c, F.lit("-"), F.col("_i"))).otherwise(F.col(c)).alias(c)
        copied = ("row_id", "entity_id", "group_id", "site_id", "case_id")
        many = known.withColumn("_i", F.explode(F.sequence(F.lit(0), F.lit(times - 1)))).select(
            *[copy(c) if c in copied else F.col(c) for c in known.columns])
        root = str(tmp_path / str(times))
        first = versions.commit_base(many, root, "a")
        state = versions.read_rows(spark, first)
        before = shuffled(spark)
        second = versions.commit_changes(history.backbone_changes(wave, state, fx.BACKBONE, fx.DEDUPE, AS_OF), first, "b")
        layers = versions._layers(spark, second)
        assert len(layers) == 2 and layers[0]["rows"] == many.count()
        cost[times] = (shuffled(spark) - before, folder_bytes(tmp_path / str(times) / "rows" / f"layer={layers[1]['layer']}"))
    assert all(cost[8][i] < 1.1 * cost[1][i] for i in (0, 1)), cost
    assert cost[8][1] * 4 < folder_bytes(tmp_path / "8" / "rows")


def test_entities_of_one_row_are_not_shuffled_whole(spark):
    """Only rows of an entity with others have to learn which of them is the newest."""
    text = F.concat(*[F.sha2(F.concat(F.lit(str(i)), F.col("id").cast("string")), 512) for i in range(8)])
    rows = stage(frame(spark, {"case_id": "1"}).drop("row_id", "group_id", "city").crossJoin(spark.range(1000)).withColumns(
        {"row_id": F.concat(F.lit("r"), "id"), "group_id": F.concat(F.lit("g"), F.col("id") % 990), "city": text}).drop("id"), "singles")
    before = shuffled(spark)
    out = stage(history.check_history(rows, AS_OF), "checked")
    assert shuffled(spark) - before < 200_000  # the texts are a million characters
    assert out.count() == 1000 and out.where("superseded_on is not null").count() == 10 and out.where("is_valid").count() == 1000


def test_new_rows_that_are_sure_are_not_shuffled_whole(spark, monkeypatch):
    """Of a large wave with much news only rows that may be anything but new, newest and active meet a verdict; of one
    with little news, only those that may be new."""
    monkeypatch.setattr(history, "FEW", 0)
    monkeypatch.setattr(history, "SMALL", 0)
    text = F.concat(*[F.sha2(F.concat(F.lit(str(i)), F.col("id").cast("string")), 512) for i in range(8)])
    rows = frame(spark, {"case_id": "1"}).drop("row_id", "group_id", "city", "name").crossJoin(spark.range(1000)).withColumns(
        {"row_id": F.concat(F.lit("r"), "id"), "group_id": F.concat(F.lit("g"), F.col("id") % 990), "name": F.concat(F.lit("n"), "id"),
         "city": text}).drop("id").select(*COLUMNS)
    wave = stage(rows, "large-wave")
    state = stage(history.check_history(rows.where("group_id < 'g2'").withColumn("row_id", F.concat(F.lit("k"), "row_id")), D(2024, 1, 2)), "state")
    assert state.count() == 114
    before = shuffled(spark)
    new = stage(changes(wave, state), "new")
    assert shuffled(spark) - before < 600_000  # the texts are a million characters
    assert new.where("is_new").count() == 1000 - 114 + state.where("superseded_on is not null").count()
    after = stage(history.with_changes(state, new), "after")
    more = stage(wave.unionByName(wave.limit(1).withColumns({"row_id": F.lit("z"), "group_id": F.lit("z"), "name": F.lit("z")})), "more")
    before = shuffled(spark)
    assert by_row(stage(changes(more, after, D(2024, 7, 1)), "new"), "is_new", "is_valid") == {"z": (True, True)}
    assert shuffled(spark) - before < 600_000


@pytest.mark.parametrize("bits", [64, 1 << 26])
@pytest.mark.parametrize("news", [0, 40])
def test_odd_rows_of_a_wave_do_not_depend_on_its_size(spark, monkeypatch, bits, news):
    """Row ids that are NULL or occur again, superseded rows, content twice or known: the same in a small wave and in a
    large one, with little and with much news."""
    monkeypatch.setattr(skew, "FILTER_BITS", bits)
    ids = lambda g, name, **more: {"case_id": str(g), "establishment_id": "2", "group_id": f"g{g}", "site_id": "s", "name": name, **more}
    known = [ids(i, "a", row_id=f"k{i}") for i in range(20)] + [ids(3, "b", row_id="k3b", superseded_on=D(2024, 1, 1)),
                                                                {"row_id": "k-none", "case_id": "X", "name": "q"}]
    late = {"wave_date": D(2024, 5, 1), "file_id": "f2"}
    wave = [ids(1, "a", row_id="w1"), ids(2, "new", row_id="w2"), ids(2, "newer", row_id="w2x", latest_event_date=D(2024, 4, 1)),
            ids(4, "x", row_id="dup"), ids(5, "y", row_id="dup"), ids(6, "x", row_id="same"), ids(6, "x", row_id="same"),
            ids(7, "x", row_id="c1"), ids(7, "x", row_id="c2"), ids(8, "x", row_id=None), ids(9, "gone", row_id="w9", superseded_on=D(2024, 5, 2)),
            ids(10, "a", row_id="k10"), ids(30, "x", row_id="w30"), ids(31, "x", row_id="0f8f4c1e-1a55-4f5e-9d0a-3f6f0f3c0001"),
            ids(31, "y", row_id="0f8"), ids("Z", "x", row_id="wz"), *[ids(100 + i, "x", row_id=f"n{i}") for i in range(news)],
            *[ids(i, "a", row_id=f"old{i}") for i in range(11, 20) if not news]]
    state = stage(history.check_history(frame(spark, *known), D(2024, 1, 2)), "state")
    rows = stage(frame(spark, *[{**w, **late} for w in wave]), "odd-wave")
    made = {}
    for few in (history.FEW, 0):
        monkeypatch.setattr(history, "FEW", few)
        made[few] = rows_of(changes(rows, state)), rows_of(history.update_backbone(rows, state, COLUMNS, DEDUPE, D(2024, 6, 1)))
    small, large = made.values()
    assert small == large and len(small[0]) > news


def test_shuffle_files_of_a_step_are_removed_when_it_ends(spark, tmp_path):
    """Also if the plan of an earlier write is still held; the caller's setting stays."""
    root = next(p for p in map(pathlib.Path, spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())
                if p.exists())
    files = lambda: {p for p in root.rglob("shuffle_*.data")}
    before, asked = files(), spark.conf.get(tables.CLEANUP, None)
    rows = spark.range(20_000).groupBy((F.col("id") % 7000).alias("k")).count()
    assert stage(rows, "grouped").count() == 7000
    versions.commit_base(history.check_history(frame(spark, {"row_id": "a", "group_id": "g", "case_id": "1"}), D(2024, 1, 2)), str(tmp_path / "v"), "b")
    assert tables.write_table(rows, str(tmp_path / "t")) == 7000
    assert not [p for p in files() - before if p.stat().st_size > 10_000]
    assert spark.conf.get(tables.CLEANUP, None) == asked
    assert rows.count() == 7000 == len(rows.collect()) == len(rows.collect())


def test_layers_are_merged_when_they_pile_up(spark, tmp_path):
    base = frame(spark, *[{"row_id": f"r{i}", "group_id": f"g{i}", "case_id": str(i), "name": "a"} for i in range(8)])
    version = versions.commit_base(history.check_history(base, D(2024, 1, 2)), str(tmp_path), "0")
    for n in range(1, 4):
        wave = frame(spark, {"row_id": f"n{n}", "group_id": "g1", "case_id": "1", "name": f"a{n}", "wave_date": D(2024, 1, 1 + n)})
        state = versions.read_rows(spark, version)
        version = versions.commit_changes(changes(wave, state, D(2024, 2, n)), version, str(n))
    names = [len(versions._layers(spark, versions.Version(str(tmp_path), v))) for v in (1, 2, 3, 4)]
    assert names == [1, 2, 1, 2] and versions.total_rows(spark, version) == 11
    assert by_row(versions.read_backbone(spark, version).where("group_id = 'g1'"), "superseded_on") == {
        "r1": D(2024, 2, 1), "n1": D(2024, 2, 2), "n2": D(2024, 2, 3), "n3": None}
    assert versions.read_rows(spark, f"{tmp_path}@2").count() == 9  # earlier versions can still be read
    assert versions.read_rows(spark, str(tmp_path)).count() == 11
    with pytest.raises(ValueError, match="no version"):
        versions.read_rows(spark, f"{tmp_path}@9")
    with pytest.raises(ValueError, match="no version"):
        versions.read_rows(spark, str(tmp_path / "elsewhere"))


def test_a_layer_has_marks_only_of_known_rows(spark, tmp_path):
    ids = {"case_id": "1", "establishment_id": "2", "entity_id": "e", "site_id": "s"}
    base = frame(spark, *[{**ids, "row_id": f"r{i}", "group_id": f"g{i}", "name": "a" * i} for i in range(20)])
    first = versions.commit_base(history.check_history(base, D(2024, 1, 2)), str(tmp_path), "0")
    wave = frame(spark, {**ids, "row_id": "n", "group_id": "g3", "name": "other", "wave_date": D(2024, 5, 1)})
    state = versions.read_rows(spark, first)
    new = stage(changes(wave, state), "new")
    assert by_row(new, "name", "is_new") == {"n": ("other", True), "r3": ("aaa", False)}
    second = versions.commit_changes(new, first, "1")
    layer = versions._layers(spark, second)[1]["layer"]
    stored = spark.read.parquet(f"{tmp_path}/rows/layer={layer}")
    assert by_row(stored.where("part = 'marked'"), "name", "group_id", "case_id", "superseded_on", "is_valid") == {
        "r3": (None, None, None, D(2024, 6, 1), True)}
    assert rows_of(versions.read_rows(spark, second)) == rows_of(history.with_changes(state, new))
    # The newest mark counts, also that of a row which a layer added.
    wave = frame(spark, {**ids, "row_id": "m", "group_id": "g3", "name": "third", "wave_date": D(2024, 7, 1)})
    third = versions.commit_changes(changes(wave, versions.read_rows(spark, second), D(2024, 8, 1)), second, "2")
    assert len(versions._layers(spark, third)) == 3
    assert by_row(versions.read_rows(spark, third).where("group_id = 'g3'"), "superseded_on", "name") == {
        "r3": (D(2024, 6, 1), "aaa"), "n": (D(2024, 8, 1), "other"), "m": (None, "third")}


def test_a_new_base_does_not_write_added_rows_again(spark, tmp_path):
    ids = {"case_id": "1", "entity_id": "e", "site_id": "s"}
    base = frame(spark, *[{**ids, "row_id": f"r{i}", "group_id": f"g{i}", "name": "a"} for i in range(3)])
    first = versions.commit_base(history.check_history(base, D(2024, 1, 2)), str(tmp_path), "0")
    wave = frame(spark, *[{**ids, "row_id": f"n{i}", "group_id": f"g{i}", "name": f"b{i}", "wave_date": D(2024, 5, 1)} for i in range(1, 9)])
    state = versions.read_rows(spark, first)
    new = stage(changes(wave, state), "new")
    second = versions.commit_changes(new, first, "1")
    assert [r["rows"] for r in versions._layers(spark, second)] == [11] and versions.total_rows(spark, second) == 11
    stored = spark.read.parquet(f"{tmp_path}/rows/layer={versions._layers(spark, second)[0]['layer']}")
    assert stored.where("row_id like 'n%'").count() == 8
    assert rows_of(versions.read_rows(spark, second)) == rows_of(history.with_changes(state, new))
    assert versions.read_rows(spark, first).where("superseded_on is null").count() == 3  # the former version stays
    wave = frame(spark, {**ids, "row_id": "z", "group_id": "g8", "name": "c", "wave_date": D(2024, 7, 1)})
    third = versions.commit_changes(changes(wave, versions.read_rows(spark, second), D(2024, 8, 1)), second, "2")
    assert [r["rows"] for r in versions._layers(spark, third)] == [11, 2]
    assert by_row(versions.read_rows(spark, third).where("group_id = 'g8'"), "superseded_on") == {"n8": D(2024, 8, 1), "z": None}


def test_layers_with_whole_changed_rows_can_be_read(spark, tmp_path):
    """As earlier versions of this code have stored them."""
    row = {"case_id": "1", "group_id": "g", "name": "a"}
    base = history.check_history(frame(spark, {**row, "row_id": "a"}, {"row_id": "b", "group_id": "h", "case_id": "2"}), D(2024, 1, 2))
    first = versions.commit_base(base, str(tmp_path), "0")
    later = base.where("row_id = 'a'").withColumns({"superseded_on": F.lit(D(2024, 6, 1)), "name": F.lit("changed")})
    layer, n, _ = versions._write_layer(later, str(tmp_path))
    layers = [(r["layer"], r["rows"]) for r in versions._layers(spark, first)]
    second = versions._name(spark, str(tmp_path), 1, [*layers, (layer, n)], 2, "1")
    assert by_row(versions.read_rows(spark, second), "superseded_on", "name") == {"a": (D(2024, 6, 1), "changed"), "b": (None, None)}
    marks = later.select(*[F.lit(D(2024, 7, 1)).alias(c) if c == "superseded_on" else c for c in later.columns], F.lit(False).alias("is_new"))
    layer, m, _ = versions._write_layer(marks, str(tmp_path))
    layers = [(r["layer"], r["rows"]) for r in versions._layers(spark, second)]
    third = versions._name(spark, str(tmp_path), 2, [*layers, (layer, m)], 2, "2")
    assert by_row(versions.read_rows(spark, third), "superseded_on", "name") == {"a": (D(2024, 7, 1), "changed"), "b": (None, None)}


def test_a_batch_is_committed_once(spark, tmp_path):
    base = history.check_history(frame(spark, {"row_id": "a", "group_id": "g", "case_id": "1"}), D(2024, 1, 2))
    first = versions.commit_base(base, str(tmp_path), "b")
    assert versions.commit_base(base, str(tmp_path), "b") == first == versions.latest(spark, str(tmp_path))
    nothing = versions.commit_changes(base.where("false").withColumn("is_new", F.lit(True)), first, "c")
    assert nothing.number == 2 and versions.read_rows(spark, nothing).count() == 1


def land(spark, root, i, date, rows):
    path = write_csv(root / f"{i}.csv", HEADER, rows, ";")
    jobs._land(spark, Wave(path, "register", date, FILES[i], date), ";", str(root), "t")


def follow(spark, root):
    waves.follow_register(spark, "register", str(root), register.REGISTER, SECRET, str(root / "checkpoint"), {"countries": COUNTRIES}).awaitTermination(300)


def state_of(spark, root):
    return rows_of(versions.read_rows(spark, f"{root}/backbone"))


@pytest.mark.parametrize("dies", ["before the commit", "after the commit"])
def test_the_stream_dies_and_goes_on(spark, tmp_path, monkeypatch, dies):
    plain, root = tmp_path / "plain", tmp_path / "stream"
    for place in (plain, root):
        place.mkdir()
        land(spark, place, 0, "2023-12-21", WAVE_1)
    bb = None
    for i, (date, rows) in enumerate([("2023-12-21", WAVE_1), ("2024-02-05", WAVE_2)]):
        land(spark, plain, i, date, rows)
        bb = jobs.register_wave(spark, "register", FILES[i], register.REGISTER, str(plain), SECRET, bb, {"countries": COUNTRIES})["backbone"]
    follow(spark, root)
    land(spark, root, 1, "2024-02-05", WAVE_2)

    real = versions._name

    def once(*args):
        monkeypatch.setattr(versions, "_name", real)
        if dies == "after the commit":
            real(*args)
        raise RuntimeError("killed")

    monkeypatch.setattr(versions, "_name", once)
    with pytest.raises(Exception, match="killed"):
        follow(spark, root)
    assert versions.latest(spark, f"{root}/backbone").number == (1 if dies == "before the commit" else 2)
    follow(spark, root)
    assert versions.latest(spark, f"{root}/backbone").number == 2
    assert state_of(spark, root) == state_of(spark, plain)
    assert [r["case_id"] for r in versions.read_quarantine(spark, bb).collect()] == ["X"]  # of the first wave, still there
    silver = scan_table(spark, f"{root}/silver/register_2024-02-05", ["linked"])
    assert silver.count() == 3
    follow(spark, root)  # nothing has arrived
    land(spark, root, 1, "2024-02-05", [*WAVE_2, firm("00000006", "000000000006", "Zeta")])  # landed again, with a line more
    follow(spark, root)
    assert versions.latest(spark, f"{root}/backbone").number == 3
    assert versions.read_backbone(spark, f"{root}/backbone").where("case_id = '00000006'").count() == 1


def test_delivered_columns_keep_their_names(spark, tmp_path):
    (tmp_path / "w.csv").write_text("id;source;name\n1;web;a\n2;shop;b\n3;x\n4;y;z;EXTRA\n")
    jobs._land(spark, Wave(str(tmp_path / "w.csv"), "s", "2024-01-01", FILES[0], "2024-01-02"), ";", str(tmp_path), "t")
    path = f"{tmp_path}/bronze/s"
    file = landed_file(spark, path, FILES[0])
    assert file.header == ["id", "source", "name", "_corrupt_record"] and file.rows == 4 and file.source == "s"
    rows = {r["id"]: r for r in landed_rows(spark, path, file).collect()}
    assert [rows[i]["source"] for i in "12"] == ["web", "shop"]
    assert [rows[i]["_corrupt_record"] for i in "1234"] == [None, None, "3;x", "4;y;z;EXTRA"]
    assert landed_rows(spark, path, file).where("_corrupt_record is null").select("id").count() == 2
    raw = spark.createDataFrame([("1",)], "_landed_source string")
    keys = dict(source="s ü=/", wave_date="2024-01-01", received_on="2024-01-02", processor="t")
    with pytest.raises(ValueError, match="reserved"):
        land_bronze(raw, path, file_id=FILES[1], **keys)
    odd = raw.withColumnRenamed("_landed_source", "wave_date")
    land_bronze(odd, path, file_id=FILES[1], **keys)
    assert [tuple(r) for r in landed_rows(spark, path, landed_file(spark, path, FILES[1])).collect()] == [("1",)]
    land_bronze(odd.where("false"), path, file_id=FILES[1], **keys)  # landed again, empty
    assert landed_rows(spark, path, landed_file(spark, path, FILES[1])).count() == 0
    assert read_manifest(spark, path).count() == 2
    with pytest.raises(ValueError, match="not landed"):
        landed_file(spark, path, FILES[3])

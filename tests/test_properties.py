"""Properties that hold on the whole fixture, and plan checks."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from checks import fixture as fx, naive
from longreg.functions import keys
from longreg.operators import clean, dedup, history, identity, link, order, profile, release, skew
from longreg.plans.standardise import standardise
from longreg.sources.tables import stage

from .conftest import SF
from .frames import by_row, entity, frame

AS_OF = fx.LOADED[fx.WAVE_2]
OUT = ["row_id", *link.IDS, "match_pass"]


@pytest.fixture(scope="module")
def sides(spark):
    return fx.wave(spark, SF, fx.WAVE_2), fx.backbone(spark, SF)


def content(df, *cols):
    return sorted(map(str, df.select(*cols).collect()))


@pytest.fixture(scope="module")
def linked(sides):
    return content(link.match_cascade(*sides, fx.PASSES_8), *OUT)


def test_cascade_returns_every_row_once(sides, linked):
    src, _ = sides
    assert len(linked) == src.count() == len(set(linked))


def test_cascade_equals_fan_out_and_windows(sides, linked):
    assert content(naive.cascade_by_windows(*sides, fx.PASSES_8), *OUT) == linked


def test_cascade_does_not_depend_on_partitioning(spark, sides, linked):
    src, bb = sides
    assert content(link.match_cascade(src.repartition(1), bb.repartition(17), fx.PASSES_8), *OUT) == linked
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "13")
        assert content(link.match_cascade(src, bb, fx.PASSES_8), *OUT) == linked
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_cascade_with_every_repeated_key_hot(sides, linked, monkeypatch):
    monkeypatch.setattr(skew, "PIECES", 100_000)
    assert content(link.match_cascade(*sides, fx.PASSES_8), *OUT) == linked


def test_plan_does_not_grow_with_the_passes(sides):
    def nodes(passes):
        text = link.match_cascade(*sides, passes)._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in text
        return text.count("Exchange"), text.count("Generate explode(array")

    assert nodes(fx.PASSES_8) == nodes(fx.PASSES_8[:2])


@pytest.mark.parametrize("share", [1000, 3])
def test_lookup_with_a_key_that_owns_a_third(spark, monkeypatch, share):
    """A third of the rows share a key, another part has none."""
    monkeypatch.setattr(skew, "PIECES", share)
    rows = spark.range(3000).select(F.col("id").cast("string").alias("row_id"), F.when(
        F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.col("id").cast("string")).alias("k"))
    right = spark.createDataFrame([("hot", 1), ("1", 2), ("4", 3)], "k string, v int")
    out = skew.lookup_join(rows, right, ["k"], ["row_id"])
    assert out.columns == ["row_id", "k", "v"]
    got = {(r["v"], r["n"]) for r in out.groupBy("v").agg(F.count("*").alias("n")).collect()}
    assert got == {(1, 1000), (2, 1), (3, 1), (None, 1998)}
    sums = skew.attach_group_values(rows, ["k"], [F.count(F.lit(1)).alias("n")], ["row_id"])
    got = {(r["n"], r["c"]) for r in sums.groupBy("n").agg(F.count("*").alias("c")).collect()}
    assert got == {(1000, 1000), (1, 1000), (None, 1000)}


def test_hot_rows_are_spread_over_partitions(spark, monkeypatch):
    rows = spark.range(4000).select(F.col("id").cast("string").alias("row_id"), F.lit("hot").alias("k"))
    right = spark.range(20_000).select(F.when(F.col("id") == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
                                       F.col("id").alias("v"))
    before = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        sizes = (skew.lookup_join(rows, right, ["k"], ["row_id"]).where("v = 0")
                 .groupBy(F.spark_partition_id()).count().collect())
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    assert len(sizes) == 4 and max(r["count"] for r in sizes) < 2000


def test_hot_keys_and_their_copies_are_bounded():
    counts = [1] * 5000 + [10] * 3000 + [100_000]
    total, whole = sum(counts), skew.PIECES
    parts = [-(-c * whole // total) for c in counts]
    assert sum(p > 1 for p in parts) <= whole and sum(p for p in parts if p > 1) <= 2 * whole


def test_top_per_key_limits_before_the_shuffle(spark):
    text = dedup.top_per_key(fx.table(spark, SF, "orders"), ["o_custkey"], [F.col("o_orderkey")])
    assert text._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") == 2


def test_threshold_match_equals_brute_force(spark):
    keys = ["name", "city", "code_sbi_1"]
    value = lambda i, n: None if i % 7 == 0 else f"{i % n}"
    bb = [entity(str(i), name=value(i, 5), city=value(i + 1, 4), code_sbi_1=value(i + 2, 3),
                 latest_event_date=dt.date(2020, 1, 1 + i % 9)) for i in range(40)]
    src = [{"name": value(i, 6), "city": value(i * 3, 5), "code_sbi_1": value(i * 5, 4)} for i in range(40)]
    want = {}
    for i, s in enumerate(src):
        found = []
        for b in bb:
            n = sum(s[k] is not None and s[k] == b[k] for k in keys)
            if n >= 2:
                found.append((-n, -b["latest_event_date"].toordinal(), b["row_id"], b["entity_id"]))
        want[f"r{i}"] = (min(found)[3], -min(found)[0]) if found else (None, None)
    out = link.threshold_match(frame(spark, *src), frame(spark, *bb), keys, 2)
    assert by_row(out, "entity_id", "agreeing") == want


def test_history_splits_all_rows_once(spark):
    df = identity.generate_ids(fx.both_waves(spark, SF), fx.SECRET)
    good, bad = history.split_history(df, AS_OF)
    rows = [r["row_id"] for part in (good, bad) for r in part.select("row_id").collect()]
    assert len(rows) == len(set(rows)) == df.count()
    assert history.invariant_single_active(good).count() == 0


def _update(wave, bb):
    identified = identity.identify(wave, bb, fx.SECRET, fx.PASSES_2)
    return history.update_backbone(identified, bb, fx.BACKBONE, fx.DEDUPE, AS_OF)


def test_update_keeps_the_invariant_and_repeats_without_effect(spark, tmp_path):
    # As in the jobs, no wave repeats its own content.
    distinct = lambda df: dedup.drop_duplicates(df, fx.DEDUPE, history.survivor_order())
    made = history.create_backbone(distinct(fx.wave(spark, SF, fx.WAVE_1)), fx.BACKBONE, fx.SECRET, AS_OF)
    wave = stage(distinct(fx.wave(spark, SF, fx.WAVE_2)), "distinct-wave")
    bb = stage(made.where("is_valid").drop("is_valid"), "distinct-backbone")
    _update(wave, bb).write.parquet(str(tmp_path / "v1"))
    first = spark.read.parquet(str(tmp_path / "v1")).where("is_valid").drop("is_valid")
    assert history.invariant_single_active(first).count() == 0
    again = _update(wave, first).where("is_valid").drop("is_valid")
    assert wave.join(first, "row_id", "left_semi").count() > 0
    # Rows quarantined the first time come back only as quarantined rows.
    assert content(again, *fx.BACKBONE) == content(first, *fx.BACKBONE)


def test_out_of_order_wave_ends_superseded(spark):
    late = frame(spark, {**entity("1", case_id="1", establishment_id="2"), "wave_date": dt.date(2020, 1, 1)})
    now = frame(spark, {**entity("1", case_id="1", establishment_id="2"), "row_id": "now"})
    out = history.supersede(now.unionByName(late), AS_OF)
    assert by_row(out, "superseded_on") == {"now": None, "b1": AS_OF}


def test_standardising_is_repeatable(spark):
    a, b = (fx.standardised(spark, SF, fx.WAVE_1).select("row_id", "address_key") for _ in range(2))
    assert content(a, "row_id", "address_key") == content(b.repartition(5), "row_id", "address_key")
    assert a.select("row_id").distinct().count() == a.count()


def test_split_is_complementary(sides):
    out = link.exact_match(*sides, ["uni_establishment_name", "uni_establishment_city"], unique=True)
    matched, rest = clean.split_matched(out)
    assert matched.count() + rest.count() == out.count() and rest.count() > 0 and matched.count() > 0


def test_profile_equals_one_job_per_statistic(spark):
    df = fx.table(spark, SF, "lineitem").select("l_quantity", "l_extendedprice", "l_discount")
    cols = ["column", "mean", "median", "stddev", "skewness"]
    assert content(profile.profile_numeric(df), *cols) == content(naive.profile_per_column(df), *cols)


def test_approximate_profile_is_close(spark):
    df = fx.table(spark, SF, "lineitem").select("l_extendedprice", "l_returnflag")
    exact = profile.profile_numeric(df).first()["median"]
    close = profile.profile_numeric(df, approx=True).first()["median"]
    assert abs(exact - close) / exact < 0.01
    assert profile.profile_string(df, approx=True).first()["distinct_count"] == 3


def test_scans_read_only_what_a_query_needs(spark):
    from checks.queries import QUERIES
    text = QUERIES["release_subsets"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<code_legal_form:string>" in text


def test_standardise_needs_no_shuffle_without_deduplication(spark):
    raw = fx.table(spark, SF, "customer").select(F.col("c_custkey").alias("row_key"), F.col("c_name").alias("uni_a"),
                                                 F.lit("20200101").alias("date_x"))
    from longreg.specs.model import SourceSpec
    spec = SourceSpec(name="x", dates={"date_x": "yyyyMMdd"}, row_key=("row_key",), event_dates=("date_x",),
                      address=("uni_a",))
    out = standardise(raw, spec, source="x", wave_date="2024-01-01", file_id=fx.FILES[fx.WAVE_1],
                      loaded_on="2024-01-02", secret="s")
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


def test_inheritance_is_a_flat_plan(spark):
    rows = stage(fx.both_waves(spark, SF), "both")
    plans = [history.inherit_id_k_of_n(rows, ["address_key", "code_sbi_1", "uni_establishment_name"][:n], n)._jdf.queryExecution()
             .executedPlan().toString() for n in (1, 3)]
    assert all(p.count("FileScan") <= 12 and p.count("Join") <= 4 for p in plans)


def test_groups_are_made_once_for_hot_and_other_keys(spark):
    rows = stage(fx.wave(spark, SF, fx.WAVE_1), "grouped-once")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # then the plan says beforehand what is used again
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = history.check_history(identity.generate_ids(rows, "s"), AS_OF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("partial_min(struct(") == 1 and "ReusedExchange" in plan


def test_a_hot_key_is_spread_by_its_share(spark):
    # Half of the rows have one key, a third none.
    rows = spark.range(60_000).select("id", F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 3 == 0, None)
                                      .otherwise(F.col("id").cast("string")).alias("k"))
    table = rows.where("k is not null").select("k").distinct().withColumn("v", F.length("k"))
    got = skew.lookup_join(rows, table, ["k"], spread=["id"])
    assert got.count() == 60_000 and got.where("v is distinct from length(k)").count() == 0
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "_pieces" in plan
    spark.conf.set("spark.sql.shuffle.partitions", "400")
    try:
        assert skew.pieces(rows) == 1600
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        sizes = [r["count"] for r in skew.lookup_join(rows, table, ["k"], spread=["id"]).groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes) < 5 * 60_000 / 400
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_grouped_lookup_rows_are_not_shuffled_again(spark):
    rows = spark.range(1000).select(F.col("id").cast("string").alias("row_id"), (F.col("id") % 70).alias("k"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = skew.attach_group_values(rows, ["k"], [F.max("row_id").alias("last")], ["row_id"])
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(_at" in plan and "hashpartitioning(_r_hash" not in plan
        assert out.where("last is null or last % 70 <> k").count() == 0 and out.count() == 1000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("bits", [64, 1 << 26])
@pytest.mark.parametrize("share", [10, 100_000])
def test_rows_without_a_lookup_row_are_not_shuffled(spark, monkeypatch, bits, share):
    """Whatever the filter lets through and whichever keys are hot, the result is that of a left join."""
    monkeypatch.setattr(skew, "FILTER_BITS", bits)
    monkeypatch.setattr(skew, "PIECES", share)
    rows = spark.range(2000).select(F.concat(F.lit("r"), "id").alias("row_id"), F.when(F.col("id") % 4 == 0, 7).otherwise(F.col("id")).alias("k"))
    left = stage(rows.withColumn(skew.HASH, F.xxhash64("k")), "rare-left")
    right = rows.where("k < 20").groupBy(F.xxhash64("k").alias(skew.HASH), "k").agg(F.count("*").alias("_rows"), F.max("row_id").alias("v"))
    out = skew.rare_join(left, right, ["k"], "_rows", F.lit(2000), ["row_id"])
    plain = rows.join(right.select("k", "v"), "k", "left").select(*out.columns)
    assert sorted(map(str, out.collect())) == sorted(map(str, plain.collect()))
    moved = skew.with_filter(left, skew.key_filter(right, skew.HASH), skew.HASH).where("_may")
    assert bits == 64 or moved.count() == rows.where("k < 20").count()


def test_the_first_row_is_the_first_by_text_whatever_the_form_of_ids(spark):
    short, texts = "3f8f4c1e-1a55-4f5e-9d0a-3f6f0f3c000", ["", "3", "4", "3F8f", "zz", "3f8f4c1e", "3f8f4c1e-1a55-4f5e-9d0a-3f6f0f3c0009x"]
    rows = spark.createDataFrame([(g, i) for g, pair in enumerate([[short + "1", t] for t in texts] + [[short + "2", short + "1"], texts])
                                  for i in pair], "g int, row_id string").withColumn("_row", keys.packed(F.col("row_id")))
    first = order.FirstRow({"lead": F.lit(1)}, [F.col("row_id")])
    found = rows.groupBy("g").agg(*first.aggregates, F.min("row_id").alias("least")).select("least", first.found()["row_id"].alias("found"))
    assert found.count() == len(texts) + 2 and found.where("least <> found").count() == 0


def test_passes_with_one_key_send_it_once(spark):
    src, bb = fx.wave(spark, SF, fx.WAVE_2), fx.backbone(spark, SF)
    passes = [*fx.PASSES_2, *[p for _, _, p in identity.CROSSWALK]]
    assert link._alike(passes) == [[0, 4], [1], [2], [3], [5, 6]]
    together, apart = [stage(link.stacked_hits(src, bb, part), "hits") for part in (passes, passes[:4])]
    assert content(together.where("slot < 4"), *apart.columns) == content(apart, *apart.columns)
    alone = stage(link.stacked_hits(src, bb, passes[6:]), "hits").withColumn("slot", F.lit(6))
    assert content(together.where("slot = 6"), *apart.columns) == content(alone, *apart.columns) and alone.count() > 0


def test_ids_and_keys_are_packed_on_the_way(spark):
    texts = ["0f8f4c1e-1a55-4f5e-9d0a-3f6f0f3c0001", "0F8F4C1E-1a55-4f5e-9d0a-3f6f0f3c0001", "e1", "", " ", "sixteen letters!",
             "0f8f4c1e1a554f5e9d0a3f6f0f3c0001", "Łódź", "-" * 17, None]
    made = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("b", keys.packed(F.col("t")))
    assert [r["t"] for r in made.select(keys.unpacked(F.col("b")).alias("t")).collect()] == texts
    assert made.select("b").distinct().count() == len(texts)
    assert made.where(F.octet_length("b") == 16).select("t").collect() == [(texts[0],)]
    bb = fx.backbone(spark, SF)
    found = link.candidates(bb, fx.PASSES_8)
    assert found.where(F.octet_length("key") != 16).count() == 0
    assert found.agg(F.max(F.octet_length("ids.entity_id"))).first()[0] == 16


def test_the_update_decides_on_narrow_rows(spark, monkeypatch):
    """With a wave that is not small, whole rows are in no staged table, and the result is the same."""
    staged = []
    keep = history.stage
    monkeypatch.setattr(history, "stage", lambda df, name: staged.append(df.columns) or keep(df, name))
    rows = stage(identity.identify(fx.wave(spark, SF, fx.WAVE_2), fx.backbone(spark, SF), fx.SECRET, fx.PASSES_2), "identified")
    update = lambda: sorted(map(str, history.update_backbone(rows, fx.backbone(spark, SF), fx.BACKBONE, fx.DEDUPE,
                                                             fx.LOADED[fx.WAVE_2]).collect()))
    few = update()
    monkeypatch.setattr(history, "FEW", 0)
    assert update() == few and len(few) > 0
    assert staged and all("establishment_name" not in columns for columns in staged)


def test_sets_of_entities_are_flags_that_are_grouped_as_the_join_deals_rows(spark):
    backbone = spark.createDataFrame([("e1", "b"), ("e1", " a "), ("e1", "a"), ("e2", "c"), (None, "a"), ("e3", None)],
                                     "entity_id string, code string").withColumn("superseded_on", F.lit(None).cast("date"))
    src = spark.createDataFrame([("r1", "e1"), ("r2", "e2"), ("r3", "e3"), ("r4", None)], "row_id string, entity_id string")
    found = lambda groups: release.subset_by_backbone(src, backbone, "code", groups, complete=None)
    rows = found({"two": ("a", "c"), "one": ("b", "a"), "none": ()})
    assert sorted(map(tuple, rows.collect())) == [("r1", "e1", "one"), ("r1", "e1", "two"), ("r2", "e2", "two")]
    assert found({}).count() == 0
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" not in plan and "collect_set" not in plan

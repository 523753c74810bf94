"""Two-wave firm register derived from orders, customer and nation, one row per order.

The same SQL builds it on both engines; only the date format function differs.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from longreg.operators.history import create_backbone
from longreg.operators.link import MatchPass
from longreg.operators.shape import LINEAGE
from longreg.plans.standardise import standardise
from longreg.session import tune
from longreg.sources.tables import stage
from longreg.specs.model import CodeMap, SourceSpec

SECRET = "oracle-test-secret"
WAVE_1, WAVE_2 = dt.date(2023, 12, 21), dt.date(2024, 2, 5)
FILES = {WAVE_1: "0b8f4c1e-1a55-4f5e-9d0a-3f6f0f3c0001", WAVE_2: "0b8f4c1e-1a55-4f5e-9d0a-3f6f0f3c0002"}
LOADED = {WAVE_1: dt.date(2024, 1, 1), WAVE_2: dt.date(2024, 3, 1)}
SOURCE = "register"

REGISTER_SQL = """
SELECT o.o_orderkey AS row_key,
 CASE WHEN o.o_orderkey % 4 = 0 THEN '' ELSE lpad(CAST(o.o_custkey AS STRING),8,'0') END AS case_id,
 CASE WHEN o.o_orderkey % 5 = 0 THEN '' ELSE lpad(CAST(o.o_orderkey % 7 AS STRING),12,'0') END AS establishment_id,
 CASE WHEN o.o_orderkey % 7 = 0 THEN NULL WHEN o.o_orderkey % 7 = 1 THEN 'H' ELSE 'N' END AS hq_indicator,
 concat(' ', c.c_mktsegment, ' Café-', CAST(o.o_custkey % 1300 AS STRING), CASE WHEN o.o_orderkey % 2 = 0 THEN ' B.V.' ELSE ' bv ' END) AS establishment_name,
 concat('Straat ', CAST(o.o_custkey % 50 + CASE WHEN o.o_orderkey % 6 = 0 THEN 100 ELSE 0 END AS STRING)) AS establishment_street,
 CAST(o.o_orderkey % 2 AS STRING) AS establishment_number,
 CASE WHEN o.o_orderkey % 9 = 0 THEN concat(n.n_name, '-Oost') ELSE n.n_name END AS establishment_city,
 concat(CAST(1000 + o.o_custkey % 90 AS STRING), ' AB') AS establishment_postcode,
 lpad(CAST(o.o_custkey % 20 + o.o_orderkey % 3 AS STRING),5,'0') AS code_sbi_1,
 CASE o.o_custkey % 7 WHEN 0 THEN '01' WHEN 1 THEN '41' WHEN 2 THEN '51' WHEN 3 THEN '71' WHEN 4 THEN '74' WHEN 5 THEN '88' ELSE '93' END AS code_legal_form,
 CASE WHEN c.c_nationkey = 24 THEN NULL ELSE lpad(CAST(c.c_nationkey AS STRING),4,'0') END AS correspondence_code_country,
 CASE WHEN o.o_custkey % 13 = 0 THEN '0' ELSE concat(CAST(1980 + o.o_custkey % 40 AS STRING), lpad(CAST(1 + o.o_custkey % 14 AS STRING),2,'0'), '15') END AS date_founded,
 {date_format} AS date_registration,
 CASE o.o_orderstatus WHEN 'O' THEN 'J' WHEN 'F' THEN 'N' ELSE '?' END AS indication_import,
 CAST(CAST(floor(o.o_totalprice) AS BIGINT) % 500 AS STRING) AS employees_total,
 CASE WHEN o.o_orderdate < TIMESTAMP '1998-07-01' THEN DATE '2023-12-21' ELSE DATE '2024-02-05' END AS wave_date
FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey JOIN {nation} n ON c.c_nationkey = n.n_nationkey
"""
DUCK_REGISTER = REGISTER_SQL.format(date_format="strftime(o.o_orderdate,'%Y%m%d')",
                                    orders="orders", customer="customer", nation="nation")

COUNTRIES = {"0001": "NLD", "0002": "BEL", "0003": "DEU", "0007": "FRA", "0012": "ESP"}

RELEASE = ("entity_id", "group_id", "site_id", "row_id", "file_id", "wave_date", "loaded_on", "superseded_on",
           "hq_indicator", "code_legal_form", "establishment_pc4", "establishment_city",
           "correspondence_code_iso3c", "employees_total", "code_sbi_1", "indication_import",
           "year_founded", "month_founded", "year_registration", "month_registration")
DENY = ("case_id", "establishment_id", "establishment_name", "establishment_street", "establishment_postcode",
        "date_founded", "date_registration", "address_key")

SPEC = SourceSpec(
    name=SOURCE,
    dates={"date_founded": "yyyyMMdd", "date_registration": "yyyyMMdd"},
    booleans={"indication_import": ("J", "N")},
    integers=("employees_total",),
    trim=("case_id", "establishment_id", "establishment_name", "establishment_street",
          "establishment_number", "establishment_city", "code_sbi_1"),
    normalize=("establishment_name", "establishment_street", "establishment_number", "establishment_city"),
    null_if={"employees_total": 0},
    codes=(CodeMap("correspondence_code_country", "correspondence_code_iso3c", "countries"),),
    digits={"establishment_postcode": "establishment_pc4"},
    row_key=("row_key",),
    event_dates=("date_founded", "date_registration"),
    address=("uni_establishment_street", "uni_establishment_number", "uni_establishment_city"),
    release=RELEASE,
)

BUSINESS = ["case_id", "establishment_id", "hq_indicator", "establishment_name", "establishment_street",
            "establishment_number", "establishment_city", "establishment_pc4", "code_sbi_1", "code_legal_form",
            "correspondence_code_iso3c", "date_founded", "date_registration", "indication_import",
            "employees_total", "uni_establishment_name", "uni_establishment_city"]
BACKBONE = [*LINEAGE, *BUSINESS]
DEDUPE = ["case_id", "establishment_id", "hq_indicator", "code_sbi_1", "code_legal_form", "date_founded",
          "uni_establishment_name", "address_key"]

PASSES_2 = [
    MatchPass.on("case_id", "establishment_id", override=True),
    MatchPass.on("case_id", "address_key", "code_sbi_1", "uni_establishment_name", allow_blank=True),
]
HQ = {"prefer": ("hq_indicator",)}
PASSES_8 = [
    MatchPass.on("case_id", "establishment_id", override=True),
    MatchPass.on("case_id", "address_key", "code_sbi_1", "uni_establishment_name", **HQ),
    MatchPass.on("address_key", "code_sbi_1", "uni_establishment_name", "date_founded", **HQ),
    MatchPass.on("address_key", "code_sbi_1", "uni_establishment_name", **HQ),
    MatchPass.on("address_key", "uni_establishment_name", "date_founded", **HQ),
    MatchPass.on("uni_establishment_name", "date_founded", **HQ),
    MatchPass.on("uni_establishment_city", "uni_establishment_name", unique=True, **HQ),
    MatchPass.on("uni_establishment_name", unique=True, **HQ),
]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def register(spark: SparkSession, sf: str) -> DataFrame:
    tune(spark)
    names = ("orders", "customer", "nation")
    sql = REGISTER_SQL.format(date_format="date_format(o.o_orderdate,'yyyyMMdd')",
                              **{n: "{" + n + "}" for n in names})
    tables = {n: table(spark, sf, n) for n in names}
    tables["orders"] = tables["orders"].repartition("o_custkey")  # as a join with many customers needs them
    return spark.sql(sql, **tables)


def standardised(spark: SparkSession, sf: str, day: dt.date) -> DataFrame:
    raw = register(spark, sf).where(F.col("wave_date") == F.lit(day)).drop("wave_date")
    return standardise(raw, SPEC, source=SOURCE, wave_date=day, file_id=FILES[day],
                       loaded_on=LOADED[day], secret=SECRET, code_tables={"countries": COUNTRIES})


_STAGED: dict[tuple, DataFrame] = {}


def _staged(spark: SparkSession, sf: str, name: str, build) -> DataFrame:
    """Silver tables of the fixture, written once per application as the jobs do."""
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _STAGED:
        _STAGED[key] = stage(build(), name)
    return _STAGED[key]


def wave(spark: SparkSession, sf: str, day: dt.date) -> DataFrame:
    return _staged(spark, sf, f"wave-{day}", lambda: standardised(spark, sf, day))


def both_waves(spark: SparkSession, sf: str) -> DataFrame:
    return wave(spark, sf, WAVE_1).unionByName(wave(spark, sf, WAVE_2))


def checked_first_wave(spark: SparkSession, sf: str) -> DataFrame:
    return create_backbone(wave(spark, sf, WAVE_1), BACKBONE, SECRET, LOADED[WAVE_1])


def checked_backbone(spark: SparkSession, sf: str) -> DataFrame:
    return _staged(spark, sf, "backbone", lambda: checked_first_wave(spark, sf))


def backbone(spark: SparkSession, sf: str) -> DataFrame:
    return checked_backbone(spark, sf).where("is_valid").drop("is_valid")

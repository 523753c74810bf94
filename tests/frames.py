"""Small frames with the lineage columns that operators expect."""

import datetime as dt

from pyspark.sql import functions as F

D = dt.date
BASE = {"entity_id": None, "group_id": None, "site_id": None, "row_id": None, "file_id": "f1",
        "wave_date": D(2024, 1, 1), "loaded_on": D(2024, 1, 2), "superseded_on": None,
        "latest_event_date": None, "case_id": None, "establishment_id": None, "hq_indicator": None,
        "name": None, "city": None, "founded": None, "address_key": None, "code_sbi_1": None}
TYPES = {**{c: "string" for c in BASE}, **{c: "date" for c in (
    "wave_date", "loaded_on", "superseded_on", "latest_event_date", "founded")}}
SCHEMA = ", ".join(f"{c} {t}" for c, t in TYPES.items())


def frame(spark, *rows):
    data = [{**BASE, "row_id": f"r{i}", **r} for i, r in enumerate(rows)]
    return spark.createDataFrame([tuple(r[c] for c in TYPES) for r in data], SCHEMA)


def entity(tag, /, **more):
    return {"entity_id": f"e{tag}", "group_id": f"g{tag}", "site_id": f"s{tag}", "row_id": f"b{tag}", **more}


def by_row(df, *cols):
    return {r["row_id"]: tuple(r[c] for c in cols) if len(cols) > 1 else r[cols[0]]
            for r in df.select("row_id", *cols).collect()}


def one(spark, **values):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])

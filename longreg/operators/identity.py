"""Persistent identifiers for firms (group), sites and firm-site entities."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.blank import blank_to_null
from ..functions.keys import key_digest, key_text, surrogate_id, unpacked
from .link import IDS, MatchPass, candidates, join_hits, match_status, set_ids, stacked_hits
from .shape import require
from .skew import HASH, lookup_join

FIRM = ["case_id"]
SITE = ["establishment_id"]
ENTITY = ["case_id", "establishment_id"]
LOCATION = ["case_id", "address_key", "code_sbi_1"]

# Known ids by the oldest backbone row with the key: (id column, namespace, pass).
CROSSWALK = [
    ("group_id", "group", MatchPass.on(*FIRM, oldest=True, override=True, needs="group_id", takes=("group_id",))),
    ("site_id", "site", MatchPass.on(*SITE, oldest=True, override=True, needs="site_id", takes=("site_id",))),
    ("entity_id", "entity", MatchPass.on(*ENTITY, oldest=True, override=True, takes=("entity_id",))),
    ("entity_id", "entity-location",
     MatchPass.on(*LOCATION, oldest=True, override=True, allow_blank=True, takes=("entity_id",))),
    ("site_id", "site-location",
     MatchPass.on(*LOCATION, oldest=True, override=True, allow_blank=True, needs="site_id", takes=("site_id",))),
]


def assign_ids(df: DataFrame, keys: list[str], id_col: str, secret: str, *, namespace: str,
               backbone: DataFrame | None = None, allow_blank: bool = False,
               force: bool = False) -> DataFrame:
    """One id per distinct key combination: the row's own, else the backbone's, else a
    new one. With `force` the row's own id comes last."""
    require(df, [*keys, id_col])
    own = blank_to_null(F.col(id_col))
    new = surrogate_id(df, secret, namespace, keys, allow_blank)
    if backbone is None:
        found = [new]
        joined = df
    else:
        p = MatchPass.on(*keys, allow_blank=allow_blank, oldest=True, needs=id_col, takes=(id_col,))
        known = candidates(backbone, [p]).select(HASH, "key", unpacked(F.col(f"ids.{id_col}")).alias("_known"))
        keyed = df.withColumn("key", key_digest(key_text(keys, allow_blank)))
        joined = lookup_join(keyed, known, ["key"], spread=["row_id"])
        found = [F.col("_known"), new]
    order = [*found, own] if force else [own, *found]
    return joined.withColumn(id_col, F.coalesce(*order)).drop("key", "_known")


def generate_ids(df: DataFrame, secret: str) -> DataFrame:
    """Ids of a first wave: firm by number, site by number, entity by both, and entity
    and site by location for rows without a site number. No shuffle."""
    require(df, [*IDS, *FIRM, *SITE, *LOCATION])
    made: dict = {i: blank_to_null(F.col(i)) for i in IDS}
    for id_col, namespace, p in CROSSWALK:
        made[id_col] = F.coalesce(
            made[id_col], surrogate_id(df, secret, namespace, p.source_columns))
    return df.withColumns(made)


def _fill(df: DataFrame, secret: str, known, own: dict) -> dict:
    made = dict(own)
    for i, (id_col, namespace, p) in enumerate(CROSSWALK):
        made[id_col] = F.coalesce(
            made[id_col], known(i),
            surrogate_id(df, secret, namespace, p.source_columns, p.allow_blank))
    return made


def append_ids(df: DataFrame, backbone: DataFrame, secret: str) -> DataFrame:
    """Ids of a further wave: own, else the backbone's for the key, else new."""
    return identify(df, backbone, secret, []).drop("match_pass", "match_status")


def identify(df: DataFrame, backbone: DataFrame, secret: str, passes: list[MatchPass]) -> DataFrame:
    """Match cascade and id assignment in one join: the crosswalk keys, like the pass
    keys, depend on the row only, so all are looked up together."""
    n = len(passes)
    hits = stacked_hits(df, backbone, [*passes, *[p for _, _, p in CROSSWALK]])
    usable = F.when((F.col("slot") < n) & ~F.col("ambiguous"), F.col("slot"))
    known = [F.max(F.when(F.col("slot") == n + i, F.col(f"ids.{id_col}"))).alias(f"_k{i}")
             for i, (id_col, _, _) in enumerate(CROSSWALK)]
    best = hits.groupBy("_row").agg(
        F.min_by("ids", usable).alias("_link"), F.min(usable).alias("_slot"),
        F.max((F.col("slot") < n) & F.col("ambiguous")).alias("_ambiguous"), *known)
    joined = join_hits(df, best)
    linked = {i: blank_to_null(c) for i, c in set_ids(joined, F.col("_link")).items()}
    ids = _fill(joined, secret, lambda i: unpacked(F.col(f"_k{i}")), linked)
    return joined.select(
        *[ids[c].alias(c) if c in IDS else F.col(c) for c in df.columns],
        (F.col("_slot") + 1).alias("match_pass"),
        match_status(joined, F.col("_slot").isNotNull(), F.col("_ambiguous")).alias("match_status"))

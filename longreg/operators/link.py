"""Exact-key linkage of source rows to backbone entities.

Which candidate wins depends only on the key, never on the source row. So the
backbone is first reduced to one row per key, and a whole cascade of passes becomes
one equi join on (pass, key) instead of one join and one window per pass.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.blank import blank, not_blank
from ..functions.keys import filled_text, key_digest, key_of, key_text, packed, unpacked
from .order import LAST, FirstRow, newest_date, newest_first
from .dedup import top_per_key
from .shape import require
from .skew import HASH, lookup_join

IDS = ["entity_id", "group_id", "site_id"]
BACKBONE_COLUMNS = [*IDS, "row_id", "superseded_on", "latest_event_date", "wave_date"]


@dataclass(frozen=True)
class MatchPass:
    """One exact-key comparison. `keys` maps source columns to backbone columns.

    allow_blank  blank parts equal each other (else rows with a blank part stay out)
    override     also replaces ids a row already has (else fills only)
    unique       links only when the key leads to exactly one entity
    prefer       backbone columns that rank candidates first, NULL lowest
    active       only rows that are not superseded are candidates
    oldest       rank by oldest wave instead of active and newest
    needs        id that a candidate must carry
    takes        ids that are used of a candidate; others of the three come as NULL
    """

    keys: tuple[tuple[str, str], ...]
    allow_blank: bool = False
    override: bool = False
    unique: bool = False
    prefer: tuple[str, ...] = ()
    active: bool = False
    oldest: bool = False
    needs: str = "entity_id"
    takes: tuple[str, ...] = tuple(IDS)

    @classmethod
    def on(cls, *names, **options) -> "MatchPass":
        pairs = tuple(n if isinstance(n, tuple) else (n, n) for n in names)
        return cls(pairs, **options)

    @property
    def source_columns(self) -> list[str]:
        return [s for s, _ in self.keys]

    @property
    def backbone_columns(self) -> list[str]:
        return [b for _, b in self.keys]


def _alike(passes: list[MatchPass]) -> list[list[int]]:
    """Passes by number, those together that look up the same key of the same rows: it is sent once for all of them."""
    groups: dict = {}
    for i, p in enumerate(passes):
        groups.setdefault((p.keys, p.allow_blank, p.override or p.needs), []).append(i)
    return list(groups.values())


def _stack(df: DataFrame, blanks: list[bool], columns: list[list[str]], usable: list,
           carry: list[str]) -> DataFrame:
    """One row per (row, slot) that has a key, with the hash of (slot, key) in front.

    The text of each key column is cleaned once per row, whatever the number of slots.
    """
    names = sorted({c for cols in columns for c in cols})
    texts = {c: f"_t{i}" for i, c in enumerate(names)}
    cleaned = df.select(*carry, *[F.expr(filled_text(c)).alias(t) for c, t in texts.items()],
                        *[c.alias(f"_u{i}") for i, c in enumerate(usable)])
    entries = []
    for i, (allow_blank, cols) in enumerate(zip(blanks, columns)):
        key = key_digest(key_of([texts[c] for c in cols], allow_blank))
        entries.append(F.struct(F.lit(i).alias("slot"), F.when(F.col(f"_u{i}"), key).alias("key")))
    return (cleaned.select(*carry, F.explode(F.array(*entries)).alias("_e"))
            .select(*carry, "_e.*").where(F.col("key").isNotNull())
            .withColumn(HASH, F.xxhash64(*_by(columns))))


def _by(slots: list) -> list[str]:
    """What tells the keys apart: a single slot needs no number."""
    return ["slot", "key"] if len(slots) > 1 else ["key"]


def _among(slots: list[int]) -> Column:
    return F.col("slot").isin(slots) if slots else F.lit(False)


def _best(backbone: DataFrame, passes: list[MatchPass], groups: list[list[int]]) -> DataFrame:
    """Per (slot, key), or per key of a single slot, the best candidate of each pass of the slot: for the first
    pass `ids0`, packed, its rank `best0`, and whether the key is `ambiguous0`. One scan and one pre-aggregated
    shuffle for all passes, which carries a row id and the ids that are used once each, packed before the passes are stacked."""
    prefer = sorted({c for p in passes for c in p.prefer})
    require(backbone, [*BACKBONE_COLUMNS, *prefer, *[b for p in passes for b in p.backbone_columns]])

    usable = [not_blank(backbone, p.needs) & F.col("superseded_on").isNull() if p.active
              else not_blank(backbone, p.needs) for p in passes]
    rows = with_row(backbone).withColumns({f"_p_{c}": packed(F.col(c)) for c in IDS})
    flags = {f"_v{i}": c for i, c in enumerate(usable)}
    firsts = [passes[g[0]] for g in groups]
    dates = ["latest_event_date", "wave_date", "superseded_on", "entity_id"]
    stacked = _stack(rows.withColumns(flags), [p.allow_blank for p in firsts], [p.backbone_columns for p in firsts],
                     [functools.reduce(Column.__or__, [usable[i] for i in g]) for g in groups],
                     ["_row", *dates, *prefer, *[f"_p_{c}" for c in IDS], *flags])
    by, made, told = _by(groups), [], []
    for j in range(max(map(len, groups))):
        here = {slot: g[j] for slot, g in enumerate(groups) if len(g) > j}
        slots = lambda test: [slot for slot, i in here.items() if test(passes[i])]  # noqa: B023,E731
        oldest = _among(slots(lambda p: p.oldest))
        rank = {
            **{f"p{i}": F.when(_among(slots(lambda p, c=c: c in p.prefer)), F.col(c)) for i, c in enumerate(prefer)},
            "old": F.when(oldest, 0).otherwise(F.col("superseded_on").isNotNull().cast("int")),
            "e": F.when(oldest, 0).otherwise(newest_date("latest_event_date")),
            "w": F.when(oldest, F.coalesce(F.unix_date("wave_date"), F.lit(LAST))).otherwise(newest_date("wave_date"))}
        taken = F.struct(*[F.when(_among(slots(lambda p, c=c: c in p.takes)), F.col(f"_p_{c}")).alias(c) for c in IDS]).alias("ids")
        among = functools.reduce(Column.__or__, [(F.col("slot") == slot) & F.col(f"_v{i}") for slot, i in here.items()])
        first = FirstRow(rank, [taken], None if len(groups) == len(passes) else among, str(j))
        entity = F.when(_among(slots(lambda p: p.unique)) & among, F.col("entity_id"))
        made += [*first.aggregates, (F.min(entity) != F.max(entity)).alias(f"_several{j}")]
        found = first.found()
        told += [found["ids"].alias(f"ids{j}"),
                 F.when(found.isNotNull(), F.struct(*[found[n].alias(n) for n in rank], unpacked(found["_row"]).alias("row_id"))).alias(f"best{j}"),
                 F.coalesce(f"_several{j}", F.lit(False)).alias(f"ambiguous{j}")]
    return stacked.groupBy(HASH, *by).agg(*made).select(HASH, *by, *told)


def candidates(backbone: DataFrame, passes: list[MatchPass]) -> DataFrame:
    """Best candidate per (slot, key), the slot being the number of the pass, or per key of a single pass:
    `ids`, packed, its rank `best`, and whether the key is `ambiguous`."""
    found = _best(backbone, passes, [[i] for i in range(len(passes))])
    return found.withColumnsRenamed({f"{c}0": c for c in ("ids", "best", "ambiguous")})


def with_row(src: DataFrame) -> DataFrame:
    """Add the packed row id, by which hits are collected."""
    return src.withColumn("_row", packed(F.col("row_id")))


def stacked_hits(src: DataFrame, backbone: DataFrame, passes: list[MatchPass], best: bool = False) -> DataFrame:
    """(_row, slot, ids, ambiguous) for every pass that finds a candidate, with `best` also its rank; row id and ids
    are packed, `slot` is the number of the pass."""
    require(src, ["row_id", "entity_id", *[s for p in passes for s in p.source_columns]])
    groups = _alike(passes)
    firsts = [passes[g[0]] for g in groups]
    usable = [F.lit(True) if p.override else blank(src, p.needs) for p in firsts]
    stacked = _stack(with_row(src), [p.allow_blank for p in firsts], [p.source_columns for p in firsts], usable, ["_row"])
    told, places = ["ids", "ambiguous", *["best"][:best]], range(max(map(len, groups)))
    right = _best(backbone, passes, groups).select(HASH, *_by(groups), *[f"{c}{j}" for j in places for c in told])
    met = lookup_join(stacked, right, _by(groups), spread=["_row"])
    # The number of the pass at each place of a slot; a slot with fewer passes has no ids there.
    number = lambda j: F.element_at(F.array(*[F.lit(g[j] if len(g) > j else -1) for g in groups]), F.col("slot") + 1)
    hits = [F.struct(number(j).alias("slot"), *[F.col(f"{c}{j}").alias(c) for c in told]) for j in places]
    each = met.select("_row", hits[0].alias("_h")) if len(hits) == 1 else met.select("_row", F.explode(F.array(*hits)).alias("_h"))
    return each.select("_row", "_h.*").where(F.col("ids").isNotNull())


def join_hits(src: DataFrame, best: DataFrame) -> DataFrame:
    """The rows with the columns of `best`, which has one row per `_row`. Ids travel packed, the row id once."""
    packs = [c for c in IDS if c in src.columns]
    slim = with_row(src).drop("row_id").withColumns({c: packed(F.col(c)) for c in packs})
    return slim.join(best, "_row", "left").withColumns({"row_id": unpacked(F.col("_row")), **{c: unpacked(F.col(c)) for c in packs}}).drop("_row")


def match_status(df: DataFrame, linked: Column, ambiguous: Column) -> Column:
    return (F.when(linked, "linked").when(not_blank(df, "entity_id"), "kept")
            .when(F.coalesce(ambiguous, F.lit(False)), "ambiguous").otherwise("unmatched"))


def set_ids(df: DataFrame, link: Column) -> dict[str, Column]:
    """The three ids of one candidate, packed, taken together; own ids where there is none."""
    return {i: F.when(link.isNotNull(), unpacked(link[i])).otherwise(F.col(i)) for i in IDS}


def match_cascade(src: DataFrame, backbone: DataFrame, passes: list[MatchPass]) -> DataFrame:
    """Link each row by the first pass that finds a candidate.

    Every source row comes back exactly once, with `match_pass` (1-based) and
    `match_status`: linked, kept (had ids already), ambiguous (only unique passes hit,
    and each led to several entities) or unmatched.
    """
    hits = stacked_hits(src, backbone, passes)
    usable = F.when(~F.col("ambiguous"), F.col("slot"))
    best = hits.groupBy("_row").agg(F.min_by("ids", usable).alias("_link"),
                                      F.min(usable).alias("_slot"),
                                      F.max("ambiguous").alias("_ambiguous"))
    joined = join_hits(src, best)
    return joined.select(
        *[set_ids(joined, F.col("_link"))[c].alias(c) if c in IDS else F.col(c) for c in src.columns],
        (F.col("_slot") + 1).alias("match_pass"),
        match_status(joined, F.col("_slot").isNotNull(), F.col("_ambiguous")).alias("match_status"))


def exact_match(src: DataFrame, backbone: DataFrame, keys, **options) -> DataFrame:
    """A single pass: one join of the source with the reduced backbone."""
    p = MatchPass.on(*keys.items() if isinstance(keys, dict) else keys, **options)
    key = key_digest(key_text(p.source_columns, p.allow_blank))
    keyed = src.withColumn("key", key if p.override else F.when(blank(src, p.needs), key))
    right = candidates(backbone, [p]).select(
        HASH, "key", F.col("ids").alias("_ids"), F.col("ambiguous").alias("_ambiguous"))
    joined = lookup_join(keyed, right, ["key"], spread=["row_id"])
    link = F.when(~F.col("_ambiguous"), F.col("_ids"))
    return joined.select(
        *[set_ids(joined, link)[c].alias(c) if c in IDS else F.col(c) for c in src.columns],
        match_status(joined, link.isNotNull(), F.col("_ambiguous")).alias("match_status"))


def threshold_match(src: DataFrame, backbone: DataFrame, keys, at_least: int) -> DataFrame:
    """Link rows that agree with a candidate on at least k of the n key columns.

    A candidate that agrees on exactly the columns S is found by the pass on S. So the
    passes on all subsets of k and more columns, larger subsets first, give the best
    candidate without ever forming the pairs within a block. Adds `agreeing`, the
    number of equal columns.
    """
    pairs = list(keys.items()) if isinstance(keys, dict) else [(k, k) for k in keys]
    n = len(pairs)
    if not 1 <= at_least <= n:
        raise ValueError(f"at_least must be between 1 and {n}")
    subsets = [s for size in range(n, at_least - 1, -1) for s in combinations(pairs, size)]
    hits = stacked_hits(src, backbone, [MatchPass(tuple(s)) for s in subsets], best=True)
    sizes = F.element_at(F.array(*[F.lit(len(s)) for s in subsets]), F.col("slot") + 1)
    best = (hits.withColumn("_size", sizes).groupBy("_row")
            .agg(F.min_by("ids", F.struct(-F.col("_size"), "best")).alias("_link"),
                 F.max("_size").alias("_size")))
    joined = join_hits(src, best)
    return joined.select(
        *[set_ids(joined, F.col("_link"))[c].alias(c) if c in IDS else F.col(c) for c in src.columns],
        F.col("_size").alias("agreeing"),
        match_status(joined, F.col("_link").isNotNull(), F.lit(False)).alias("match_status"))


def refresh_by_row_id(df: DataFrame, other: DataFrame, cols: list[str]) -> DataFrame:
    """Take the columns from the row of `other` with the same row id, also when it
    holds NULL there; rows that `other` does not have get NULL."""
    require(df, ["row_id", *cols])
    latest = top_per_key(other, ["row_id"], [newest_first()])
    fresh = latest.select("row_id", *[F.col(c).alias(f"_{c}") for c in cols])
    return df.join(fresh, "row_id", "left").select(
        *[F.col(f"_{c}").alias(c) if c in cols else F.col(c) for c in df.columns])

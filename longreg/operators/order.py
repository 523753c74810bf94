"""Total orders as comparable structs, for min_by/max_by. All end in row_id."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..functions.keys import is_short, unpacked

LAST = 2_147_483_647


def newest_date(name: str) -> Column:
    """Sort value of a date, newest first and NULL last."""
    return F.coalesce(-F.unix_date(F.col(name)), F.lit(LAST))


def oldest_first() -> Column:
    return F.struct(F.col("wave_date"), F.col("row_id"))


def newest_dates() -> dict[str, Column]:
    return {"w": newest_date("wave_date"), "e": newest_date("latest_event_date")}


def newest_first() -> Column:
    return F.struct(*[c.alias(n) for n, c in newest_dates().items()], F.col("row_id"))


def candidate_order(prefer: list[str], use_preference: Column | None = None) -> Column:
    """Preference columns (NULL first), then active, latest event, latest wave, row id."""
    lead = [F.when(use_preference, F.col(c)) if use_preference is not None else F.col(c)
            for c in prefer]
    return F.struct(*[c.alias(f"p{i}") for i, c in enumerate(lead)],
                    F.col("superseded_on").isNotNull().cast("int").alias("old"),
                    newest_date("latest_event_date").alias("e"),
                    newest_date("wave_date").alias("w"), F.col("row_id"))


class FirstRow:
    """The first row of a group by `lead`, then by row id as text, with what it carries; row ids are packed in `_row`.

    Packed ids of one kind have the order of their texts, but ids of both kinds together don't. So short ids go first,
    the first of the others is aggregated beside, and `found` compares the two; no id is unpacked before the shuffle."""

    def __init__(self, lead: dict[str, Column], carried: list[Column], where: Column | None = None, suffix: str = ""):
        self.lead, self.names = list(lead), [f"_first{suffix}", f"_long{suffix}"]
        short = F.coalesce(is_short(F.col("_row")), F.lit(False))
        row = F.struct(F.when(short, 0).otherwise(1).alias("long"), *[c.alias(n) for n, c in lead.items()], F.col("_row"), *carried)
        least = lambda when: F.min(row if when is None else F.when(when, row))
        both = [where, ~short if where is None else where & ~short]
        self.aggregates = [least(when).alias(name) for when, name in zip(both, self.names)]

    def found(self) -> Column:
        """The struct of the lead, `_row` and what is carried."""
        first, long = map(F.col, self.names)
        told = lambda kind: F.struct(*[kind[n] for n in self.lead], unpacked(kind["_row"]))
        return F.when((first["long"] == 0) & long.isNotNull() & (told(long) < told(first)), long).otherwise(first)

"""Format-preserving pseudonyms for personal numbers and dates.

Built-in functions only. A value that its own rule finds valid is exchanged for another valid
value of the same form: a keyed Feistel network permutes the form's values, so equal values
get equal pseudonyms in all documents, different ones different pseudonyms, and whoever has
the key can turn them back. The domain of every form is a product of two ranges, one for each
half of the network, so no step has to be repeated until it fits.

* card: 13 to 19 digits, or 16 or 15 in groups with spaces or hyphens between, with a right
  Luhn digit; the digit is formed anew for the other digits.
* phone: +1 and ten digits, written (ddd) ddd-dddd or with spaces, dots or hyphens.
* ip: four numbers up to 255. id: ddd-dd-dddd in the ranges that are given out.
* date: year-month-day, or day and month before the year with / or . between, years 1 to 9999. The
  calendar repeats every 400 years, 189 * 773 days; dates are permuted within 1800 to 2199, or within
  the like span around them. The first and the last span are cut to the years 1 to 199, 13 * 5591
  days, and 9800 to 9999, 184 * 397 days, so that the year keeps its four digits.
* email: letters and digits of the name; its signs and the domain stay.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from .common import Steps, packed

#: Forms in the order in which they are tried.
FORMS = {
    "email": r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "phone": r"\+1[ .-]?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-]?)[0-9]{3}[ .-]?[0-9]{4}(?![0-9])",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\.?[0-9])",
    "date": r"(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})(?![./-]?[0-9])",
    "id": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?!-?[0-9])",
    "card": r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9])",
}
ANY = "|".join(FORMS.values())
ROUNDS = 8
DAY_ZERO = "1800-01-01"


def feistel(a: Column, b: Column, size_a: Column, size_b: Column, key: str, tweak: Column) -> Column:
    """struct<a, b>: a keyed permutation of the pairs of a number under size_a and one under size_b."""

    def step(state, i):
        even = i % 2 == 0
        other = F.when(even, state["b"]).otherwise(state["a"])
        digest = F.sha2(F.concat_ws("|", F.lit(key), tweak, i.cast("string"), other.cast("string")), 256)
        drawn = F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")
        return F.struct(F.when(even, (state["a"] + drawn % size_a) % size_a).otherwise(state["a"]).alias("a"),
                        F.when(even, state["b"]).otherwise((state["b"] + drawn % size_b) % size_b).alias("b"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), F.struct(a.cast("long").alias("a"), b.cast("long").alias("b")), step)


def _power(radix: int, n: Column) -> Column:
    """radix ** n as a whole number, n up to 18."""
    powers = [radix ** i for i in range(19) if radix ** i < 1 << 62]
    return F.element_at(F.array(*[F.lit(p).cast("long") for p in powers]), n + 1)


def permuted_text(text: Column, radix: int, key: str, kind: str) -> Column:
    """Permutes strings of one to 22 digits or letters of a radix, keeping their length."""
    half = F.floor(F.length(text) / 2).cast("int")
    rest = F.length(text) - half
    number = lambda part: F.coalesce(F.conv(part, radix, 10), F.lit("0")).cast("long")
    mixed = feistel(number(F.substring(text, F.lit(1), half)), number(F.substring(text, half + 1, rest)),
                    _power(radix, half), _power(radix, rest), key, F.concat(F.lit(kind), F.length(text).cast("string")))
    written = lambda n, width: F.lpad(F.lower(F.conv(n.cast("string"), 10, radix)), width, F.lit("0"))
    return F.element_at(F.transform(F.array(mixed), lambda m: F.concat(written(m["a"], half), written(m["b"], rest))), 1)


def luhn_sum(digits: Column) -> Column:
    """Luhn's sum of a string of digits, the last of which is the check digit."""
    backwards = F.split(F.reverse(digits), "")
    values = F.transform(F.slice(backwards, 1, F.length(digits)), lambda d, i: F.when(
        i % 2 == 0, d.cast("int")).otherwise(d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(values, F.lit(0), lambda s, v: s + v)


def refilled(form: Column, characters: str, new: Column) -> Column:
    """`form` with its characters of a class, one after the other, exchanged for those of `new`."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state, c):
        own = c.rlike(f"[{characters}]")
        return F.struct((state["at"] + own.cast("int")).alias("at"), F.concat(state["out"], F.when(
            own, F.substring(new, state["at"] + 1, F.lit(1))).otherwise(c)).alias("out"))

    return F.aggregate(F.slice(F.split(form, ""), 1, F.length(form)), start, step)["out"]


def _parts(hit: Column, signs: str) -> Column:
    return F.transform(F.split(hit, signs), lambda p: p.cast("long"))


def _day(year: Column, month: Column, day: Column) -> Column:
    """Days from DAY_ZERO, null if there is no such day. There is no year 0."""
    written = F.concat_ws("-", F.lpad(year, 4, "0"), F.lpad(month, 2, "0"), F.lpad(day, 2, "0"))
    there = F.try_to_timestamp(F.when(F.lpad(year, 4, "0") != "0000", written), F.lit("yyyy-MM-dd")).cast("date")
    return F.datediff(there, F.lit(DAY_ZERO).cast("date"))


def _date(hit: Column, key: str) -> Column:
    """The pseudonym of a date, null if it is none. Where both orders are valid the day is first."""
    p = F.split(hit, "[-/.]")
    at = lambda i: F.element_at(p, i)
    first = F.length(at(1)) == 4
    tries = Steps(F.array(F.struct(hit.alias("hit"))), ("hit",)).add(
        ymd=lambda c: F.when(first, _day(at(1), at(2), at(3))),
        dmy=lambda c: F.when(~first, _day(at(3), at(2), at(1))),
        mdy=lambda c: F.when(~first, _day(at(3), at(1), at(2))))
    days = 189 * 773
    tries = tries.add(day=lambda c: F.coalesce(c["ymd"], c["dmy"], c["mdy"]).cast("long"))
    since = lambda day: (dt.date.fromisoformat(day) - dt.date.fromisoformat(DAY_ZERO)).days
    by_span = lambda c, early, late, other: F.when(c["day"] < since("0200-01-01"), early).when(
        c["day"] >= since("9800-01-01"), late).otherwise(other)
    tries = tries.add(start=lambda c: by_span(c, since("0001-01-01"), since("9800-01-01"), F.floor(c["day"] / days) * days),
                      size_a=lambda c: by_span(c, 13, 184, 189), size_b=lambda c: by_span(c, 5591, 397, 773))
    tries = tries.add(place=lambda c: c["day"] - c["start"])
    tries = tries.add(new=lambda c: feistel(F.floor(c["place"] / c["size_b"]), c["place"] % c["size_b"], c["size_a"], c["size_b"], key, F.lit("date")))
    tries = tries.add(date=lambda c: F.date_add(F.lit(DAY_ZERO).cast("date"), (c["start"] + c["new"]["a"] * c["size_b"] + c["new"]["b"]).cast("int")))
    sign = F.substring(hit, 3, 1)
    written = lambda c: F.when(c["ymd"].isNotNull(), F.date_format(c["date"], "yyyy-MM-dd")).otherwise(F.concat(
        F.when(c["dmy"].isNotNull(), F.date_format(c["date"], "dd")).otherwise(F.date_format(c["date"], "MM")), sign,
        F.when(c["dmy"].isNotNull(), F.date_format(c["date"], "MM")).otherwise(F.date_format(c["date"], "dd")), sign,
        F.date_format(c["date"], "yyyy")))
    return F.element_at(F.transform(tries.array, lambda c: F.when(c["day"].isNotNull(), written(c))), 1)


def _ip(hit: Column, key: str) -> Column:
    numbers = Steps(F.array(F.struct(_parts(hit, r"\.").alias("p"))), ("p",)).add(new=lambda c: feistel(
        c["p"][0] * 256 + c["p"][1], c["p"][2] * 256 + c["p"][3], F.lit(65536), F.lit(65536), key, F.lit("ip")))
    return F.element_at(F.transform(numbers.array, lambda c: F.when(F.forall(c["p"], lambda n: n < 256), F.concat_ws(
        ".", *[x.cast("string") for half in ("a", "b") for x in (F.floor(c["new"][half] / 256), c["new"][half] % 256)]))), 1)


def _id(hit: Column, key: str) -> Column:
    """Areas 001-899 but 666, groups 01-99, numbers 0001-9999: 898 * 99 and 9999 values."""
    numbers = Steps(F.array(F.struct(_parts(hit, "-").alias("p"))), ("p",))
    numbers = numbers.add(ok=lambda c: (c["p"][0] > 0) & (c["p"][0] < 900) & (c["p"][0] != 666) & (c["p"][1] > 0) & (c["p"][2] > 0),
                          area=lambda c: c["p"][0] - 1 - (c["p"][0] > 666).cast("int"))
    numbers = numbers.add(new=lambda c: feistel(c["area"] * 99 + c["p"][1] - 1, c["p"][2] - 1, F.lit(898 * 99), F.lit(9999), key, F.lit("id")))
    numbers = numbers.add(place=lambda c: F.floor(c["new"]["a"] / 99))
    pad = lambda n, width: F.lpad(n.cast("string"), width, "0")
    return F.element_at(F.transform(numbers.array, lambda c: F.when(c["ok"], F.concat_ws(
        "-", pad(c["place"] + 1 + (c["place"] >= 665).cast("int"), 3), pad(c["new"]["a"] % 99 + 1, 2), pad(c["new"]["b"] + 1, 4)))), 1)


def _card(hit: Column, key: str) -> Column:
    made = Steps(F.array(F.struct(F.regexp_replace(hit, "[^0-9]", "").alias("digits"))), ("digits",))
    made = made.add(ok=lambda c: luhn_sum(c["digits"]) % 10 == 0, body=lambda c: permuted_text(
        F.substring(c["digits"], F.lit(1), F.length(c["digits"]) - 1), 10, key, "card"))
    made = made.add(check=lambda c: (10 - luhn_sum(F.concat(c["body"], F.lit("0"))) % 10) % 10)
    return F.element_at(F.transform(made.array, lambda c: F.when(
        c["ok"], refilled(hit, "0-9", F.concat(c["body"], c["check"].cast("string"))))), 1)


def _phone(hit: Column, key: str) -> Column:
    digits = F.substring(F.regexp_replace(hit, "[^0-9]", ""), 2, 10)
    return F.concat(F.lit("+1"), refilled(F.substring(hit, F.lit(3), F.length(hit)), "0-9", permuted_text(digits, 10, key, "phone")))


def _email(hit: Column, key: str) -> Column:
    """Letters and digits of the name are permuted at most 20 at a time."""
    made = Steps(F.array(F.struct(F.substring_index(hit, "@", 1).alias("name"))), ("name",))
    made = made.add(plain=lambda c: F.regexp_replace(F.lower(c["name"]), "[^a-z0-9]", ""))
    # Parts of equal length, so that none is left with a single character.
    made = made.add(width=lambda c: F.ceil(F.length(c["plain"]) / F.ceil(F.length(c["plain"]) / 20)).cast("int"))
    made = made.add(starts=lambda c: F.sequence(F.lit(1), F.length(c["plain"]), c["width"]))
    new = lambda c: F.array_join(F.transform(c["starts"], lambda at: permuted_text(
        F.substring(c["plain"], at, c["width"]), 36, key, "email")), "")
    return F.element_at(F.transform(made.array, lambda c: F.concat(
        refilled(F.lower(c["name"]), "a-z0-9", new(c)), F.substring(hit, F.length(c["name"]) + 1, F.length(hit)))), 1)


MAKERS = {"email": _email, "phone": _phone, "ip": _ip, "date": _date, "id": _id, "card": _card}


def pseudonymised(docs: DataFrame, key: str, counts: bool = False) -> DataFrame:
    """Documents with valid values in text exchanged; with counts, n_<form> of those exchanged.

    Null texts stay null, texts without valid values stay as they are, and values that their
    rule does not find valid are left alone. Other columns are kept; columns named like the
    counts are replaced.
    """
    hits = F.regexp_extract_all("text", F.lit(ANY), F.lit(0))
    pairs = Steps(F.arrays_zip(F.split("text", ANY, -1).alias("gap"), hits.alias("hit")), ("gap", "hit"))

    def form(c):
        out = None
        for name, pattern in FORMS.items():
            test = c["hit"].rlike(f"^(?:{pattern})$")
            out = F.when(test, name) if out is None else out.when(test, name)
        return out

    def new(c):
        out = None
        for name, make in MAKERS.items():
            out = F.when(c["form"] == name, make(c["hit"], key)) if out is None else out.when(c["form"] == name, make(c["hit"], key))
        return out

    pairs = pairs.add(form=lambda c: F.when(c["hit"].isNotNull(), form(c))).add(new=new)
    found = packed(docs, "text").withColumn("_pairs", F.when(F.col("text").rlike(ANY), pairs.array))
    text = F.array_join(F.transform("_pairs", lambda c: F.concat(c["gap"], F.coalesce(c["new"], c["hit"], F.lit("")))), "")
    exchanged = F.transform(F.filter("_pairs", lambda c: c["new"].isNotNull()), lambda c: c["form"])
    number = {f"n_{name}": F.coalesce(F.size(exchanged) - F.size(F.array_remove(exchanged, name)), F.lit(0)).cast("long")
              for name in (FORMS if counts else ())}
    kept = [F.coalesce(text, "text").alias(c) if c == "text" else F.col("_row").getField(c).alias(c) for c in docs.columns if c not in number]
    return found.select(*kept, *[n.alias(name) for name, n in number.items()])

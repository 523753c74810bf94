"""Secret scan: known forms, and a battery of randomness tests for the rest.

Built-in functions only. Spans are code points, end exclusive. Known forms are searched by
pattern. Other candidates are runs of encoded-looking characters; the encoding is inferred
from the characters that occur, and every candidate gets

* three tests of randomness over its alphabet: chi-squared uniformity, runs above and below
  the middle of the alphabet, and serial correlation. One that any of them rejects (with
  Bonferroni's correction) is not random;
* an e-value against ordinary text: how much likelier its symbols are as a random string of
  its encoding than as text whose letters are as frequent as in English, and which goes on
  from small letters, capitals, digits or signs to another of them at most every fifth
  character, to those classes to which the candidate goes. As the encoding is chosen by the candidate, the e-value is divided by the number
  of encodings; then it is weighted by the smallest p-value of the three tests, where that
  is below one after correction. Neither lifts its mean under the null over one.

False discoveries are controlled by the e-value form of the Benjamini-Hochberg rule, apart for
each encoding and each doubling of the length, as short candidates are many and prove little.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import Steps, packed

#: Kinds and forms, in the order in which they are listed.
KINDS = {
    "assign": r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": "AKIA[A-Z0-9]{16,}",
    "hex": "[0-9a-f]{24,}",
}
RANDOM = "random"
#: Runs of at least 16 that hold a digit or a capital after a small letter.
CANDIDATE = (r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*(?:[0-9]|[a-z][A-Z]))[A-Za-z0-9+/_-]{16,}={0,2}")
LOWER, UPPER, DIGITS = string.ascii_lowercase, string.ascii_uppercase, string.digits
#: Encodings by the first that has all characters: name, characters, alphabet.
ENCODINGS = (
    ("digits", DIGITS, DIGITS),
    ("hex", "0-9a-f", DIGITS + LOWER[:6]),
    ("HEX", "0-9A-F", DIGITS + UPPER[:6]),
    ("base32", "A-Z2-7", UPPER + DIGITS[2:8]),
    ("base36", "0-9a-z", DIGITS + LOWER),
    ("BASE36", "0-9A-Z", DIGITS + UPPER),
    ("base62", "0-9A-Za-z", DIGITS + UPPER + LOWER),
    ("base64", "0-9A-Za-z+/", UPPER + LOWER + DIGITS + "+/"),
    ("base64url", "0-9A-Za-z_-", UPPER + LOWER + DIGITS + "-_"),
    ("mixed", "0-9A-Za-z+/_-", UPPER + LOWER + DIGITS + "+/-_"),
)
#: The most often that text changes class.
TEXT_CHANGES = 0.2


#: Letters of English in 10,000, and signs of names in 100.
LETTERS = dict(zip("etaoinshrdlcumwfgypbvkjxqz", (
    1270, 906, 817, 751, 697, 675, 633, 609, 599, 425, 403, 278, 276, 241, 236, 223, 202, 197, 193, 149, 98, 77, 15, 15, 10, 7)))
SIGNS = {"_": 0.4, "-": 0.3, "/": 0.25, "+": 0.05}
#: Share of letters in names and abbreviations that are as frequent as any other.
EVEN = 0.03


def _text_log_chances() -> list[float]:
    """By ASCII code, the log chance of a character in ordinary text, given its class."""
    out = [0.0] * 128
    for letter, n in LETTERS.items():
        chance = math.log((1 - EVEN) * n / sum(LETTERS.values()) + EVEN / 26)
        out[ord(letter)] = out[ord(letter.upper())] = chance
    return [math.log(0.1) if chr(i) in DIGITS else math.log(SIGNS[chr(i)]) if chr(i) in SIGNS else x for i, x in enumerate(out)]


def spans_of(text: Column, kind: str, pattern: str) -> Column:
    """array<struct<start, end, kind, hit>> of the leftmost non-overlapping matches."""
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,kind:string,hit:string>>").alias("out"))

    def step(state, pair):
        start = state["at"] + F.length(pair["gap"])
        end = start + F.length(pair["hit"])
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(F.struct(
            start.alias("start"), end.alias("end"), F.lit(kind).alias("kind"), pair["hit"].alias("hit")))).alias("out"))

    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.filter(F.arrays_zip(F.split(text, pattern, -1).alias("gap"), hits.alias("hit")), lambda p: p["hit"].isNotNull())
    return F.when(text.rlike(pattern), F.aggregate(pairs, zero, step)["out"]).otherwise(zero["out"])


def base_spans(text: Column) -> Column:
    parts = [spans_of(text, kind, pattern) for kind, pattern in KINDS.items()]
    order = F.array(*map(F.lit, KINDS))
    found = F.filter(F.concat(*parts), lambda s: (s["kind"] != "assign") | (
        F.length(F.regexp_extract(s["hit"], KINDS["assign"], 2)) >= 6))
    return F.transform(F.array_sort(F.transform(found, lambda s: F.struct(
        s["start"].alias("start"), F.array_position(order, s["kind"]).alias("order"), s["end"].alias("end"), s["kind"].alias("kind")))),
        lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))


def _case(name: Column, values: dict) -> Column:
    out = None
    for key, value in values.items():
        out = F.when(name == key, F.lit(value)) if out is None else out.when(name == key, F.lit(value))
    return out


def _two_sided(z: Column) -> Column:
    """Tail of the normal distribution, within 0.0002 (a logistic approximation)."""
    a = F.least(F.abs(z), F.lit(30.0))
    return 2 / (1 + F.exp(1.5976 * a + 0.07056 * a * a * a))


def _encoding(body: Column) -> Column:
    name = None
    for encoding, characters, _ in ENCODINGS:
        test = body.rlike(f"^[{characters}]+$")
        name = F.when(test, encoding) if name is None else name.when(test, encoding)
    return name


def _total(array: Column, value) -> Column:
    return F.aggregate(array, F.lit(0.0), lambda s, v: s + value(v))


def candidates(text: Column) -> Column:
    """array<struct<start, end, kind, ..., stratum, log_e, random>> of the candidates of a text."""
    steps = Steps(spans_of(text, RANDOM, CANDIDATE), ("start", "end", "kind", "hit"))
    steps = steps.add(body=lambda c: F.rtrim(c["hit"], F.lit("=")))
    steps = steps.add(n=lambda c: F.length(c["body"]), name=lambda c: _encoding(c["body"]))
    steps = steps.add(
        alphabet=lambda c: _case(c["name"], {e: a for e, _, a in ENCODINGS}),
        classes=lambda c: F.translate(c["body"], LOWER + UPPER + DIGITS + "+/-_", "l" * 26 + "u" * 26 + "d" * 10 + "ssss"))
    steps = steps.add(
        changes=lambda c: F.regexp_count(c["classes"], F.lit(r"(.)(?!\1|$)")),
        turns=lambda c: F.array(*[F.array(*[F.regexp_count(c["classes"], F.lit(f"{a}(?={b})")) for b in "luds" if b != a]) for a in "luds"]))
    # Symbols as distances from the middle of the alphabet.
    steps = steps.add(k=lambda c: F.length(c["alphabet"]), at=lambda c: F.transform(
        F.slice(F.split(c["body"], ""), 1, c["n"]), lambda x: F.instr(c["alphabet"], x) - (F.length(c["alphabet"]) + 1) / 2))
    steps = steps.add(
        squares=lambda c: _total(F.slice(F.split(c["alphabet"], ""), 1, c["k"]), lambda x: F.pow(
            c["n"] - F.length(F.replace(c["body"], x, F.lit(""))), F.lit(2.0))),
        low=lambda c: _total(c["at"], lambda v: (v < 0).cast("double")),
        pairs=lambda c: F.zip_with(F.slice(c["at"], 1, c["n"] - 1), F.slice(c["at"], 2, c["n"] - 1), lambda x, y: x * y))
    steps = steps.add(
        uniform=lambda c: (c["k"] / c["n"] * c["squares"] - c["n"] - (c["k"] - 1)) / F.sqrt(2 * (c["k"] - 1) * (c["n"] - 1) / c["n"]),
        runs=lambda c: 1 + _total(c["pairs"], lambda v: (v < 0).cast("double")),
        expected=lambda c: 2 * c["low"] * (c["n"] - c["low"]) / c["n"] + 1,
        # The variance of a uniform symbol is known, so it is not estimated.
        serial=lambda c: _total(c["pairs"], lambda v: v) / ((c["k"] * c["k"] - 1) / 12) / F.sqrt(c["n"] - 1),
        q0=lambda c: F.greatest(F.least(c["changes"] / (c["n"] - 1), F.lit(TEXT_CHANGES)), F.lit(1e-6)))
    chances = F.array(*[F.lit(x) for x in _text_log_chances()])
    weighed = lambda n: F.when(n > 0, n * F.log(n)).otherwise(0.0)
    steps = steps.add(
        # The share of each other class after a class is the candidate's own, which makes text
        # likelier than it is under any fixed shares.
        text=lambda c: (_total(c["turns"], lambda t: _total(t, weighed) - weighed(F.aggregate(
            t, F.lit(0), lambda s, v: s + v))) + c["changes"] * F.log(c["q0"]) + (c["n"] - 1 - c["changes"]) * F.log(1 - c["q0"]) + _total(
            F.slice(F.split(c["body"], ""), 1, c["n"]), lambda x: F.element_at(chances, F.ascii(x) + 1))),
        p=lambda c: F.least(
        _two_sided(F.greatest(c["uniform"], F.lit(0.0))), _two_sided(c["serial"]),
        _two_sided((c["runs"] - c["expected"]) / F.sqrt(F.greatest((c["expected"] - 1) * (c["expected"] - 2) / (c["n"] - 1), F.lit(1e-9))))))
    return F.transform(steps.array, lambda c: F.struct(
        c["start"].alias("start"), c["end"].alias("end"), c["kind"].alias("kind"),
        F.concat_ws(":", c["name"], F.floor(F.log2(c["n"])).cast("string")).alias("stratum"),
        (-c["n"] * F.log(c["k"]) - c["text"] - math.log(len(ENCODINGS)) + F.log(F.least(
            F.greatest(3 * c["p"], F.lit(1e-300)), F.lit(1.0)))).alias("log_e"),
        ((3 * c["p"] >= 0.01) & (c["name"] != "digits")).alias("random")))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.withColumn("_text", F.coalesce("text", F.lit("")))


def cuts(docs: DataFrame, alpha: float = 0.01) -> dict[str, int]:
    """stratum -> least whole log e-value that is a discovery, over all documents.

    A discovery among m candidates is one whose e-value is at least m / (alpha * k), with k the
    number of candidates of at least that e-value. The driver gets one number a stratum, of
    which there are encodings times doublings of the length.
    """
    found = (_texts(docs).where(F.col("_text").rlike(CANDIDATE)).select(F.explode(candidates(F.col("_text"))).alias("c"))
             .select("c.stratum", F.when(F.col("c.random"), F.floor("c.log_e")).otherwise(-1).alias("bin")))
    bins = found.groupBy("stratum", F.least(F.greatest("bin", F.lit(-1)), F.lit(700)).alias("bin")).count()
    down = Window.partitionBy("stratum").orderBy(F.desc("bin"))
    ranked = bins.withColumn("k", F.sum("count").over(down)).withColumn("m", F.sum("count").over(Window.partitionBy("stratum")))
    passed = ranked.where((F.col("bin") > 0) & (F.exp(F.col("bin")) >= F.col("m") / (alpha * F.col("k"))))
    return {r["stratum"]: r["cut"] for r in passed.groupBy("stratum").agg(F.min("bin").alias("cut")).collect()}


def with_spans(docs: DataFrame, found: dict[str, int]) -> DataFrame:
    """Adds base and spans, arrays of (start, end, kind) by start, to documents.

    spans holds base and those random candidates that pass the cuts and overlap no base span.
    Null and empty texts have none.
    """
    text = _texts(docs)
    cut = (F.create_map(*[F.lit(x) for pair in found.items() for x in pair]) if found
           else F.create_map().cast("map<string,int>"))
    text = text.withColumn("base", base_spans(F.col("_text"))).withColumn("_c", candidates(F.col("_text")))
    passed = F.filter("_c", lambda c: c["random"] & F.coalesce(
        c["log_e"] >= cut[c["stratum"]], F.lit(False)) & ~F.exists(
        "base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))
    added = F.transform(passed, lambda c: F.struct(c["start"].alias("start"), c["end"].alias("end"), c["kind"].alias("kind")))
    starts = lambda a, b: F.when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1).otherwise(0)
    # No added span overlaps a base one, so the sort moves none of those that start together.
    spans = F.when(F.size(added) == 0, F.col("base")).otherwise(F.array_sort(F.concat("base", added), starts))
    return text.withColumn("spans", spans).drop("_c", "_text")


def listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(docs: DataFrame, alpha: float = 0.01) -> DataFrame:
    """The documents with every span replaced by its kind in brackets; n_chars, if it is there,
    follows the text. Null texts stay null; documents without secrets stay as they are."""
    found = with_spans(packed(docs, "text"), cuts(docs.select("text"), alpha))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(state, s):
        piece = F.substring("text", state["at"] + 1, s["start"] - state["at"])
        return F.when(s["start"] >= state["at"], F.struct(s["end"].alias("at"), F.concat(
            state["out"], F.array(piece, F.concat(F.lit("["), s["kind"], F.lit("]")))).alias("out"))).otherwise(
            F.struct(F.greatest(state["at"], s["end"]).alias("at"), state["out"].alias("out")))

    parts = F.aggregate("spans", start, step)
    clean = F.concat(F.array_join(parts["out"], ""), F.substring("text", parts["at"] + 1, F.length("text")))
    found = found.select("_row", F.when(F.size("spans") > 0, clean).alias("_clean"))
    made = {"text": F.col("_clean")}
    if "n_chars" in docs.columns:
        made["n_chars"] = F.length("_clean").cast(docs.schema["n_chars"].dataType)
    return found.select(*[F.coalesce(made[c], f"_row.{c}").alias(c) if c in made else F.col(f"_row.`{c}`") for c in docs.columns])

"""Filter audit, importance resampling and prefix hashes against plain versions."""

import hashlib
import math
import re
import zlib
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from longreg.llm import filter_audit, importance, prefix_hashes
from longreg.llm.prefix_hashes import Fingerprint, PrefixHashes
from longreg.llm.queries import QUERIES
from longreg.llm.statements import STATEMENTS
from tools.compare import connect, rows

from ..conftest import SF
from .frames import empty, odd_documents

LABELS = "doc_id long, quality int, toxic int, mask string"


@pytest.mark.parametrize("name", list(STATEMENTS))
def test_statement(spark, name):
    assert rows(QUERIES[name](spark, SF).toPandas()) == rows(connect(SF).sql(STATEMENTS[name]).df())


# filter audit

def plain_fails(text, doc_id, all_rows):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    tests = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
             "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text), "D": re.search(r"[#$%&*|]", text),
             "E": doc_id is not None and any(i is not None and i < doc_id and t == text for i, t in all_rows)}
    return {k for k, v in tests.items() if v}


def plain_audit(docs, labels):
    texts = [(i, t or "") for i, t, _ in docs]
    fails = [plain_fails(t, i, texts) for i, t in texts]
    good, toxic = ({i for i, *marks in labels if i is not None and marks[m] == 1} for m in (0, 1))
    out, shares = {}, Counter()
    for order in map("".join, permutations("ABCDE")):
        for (i, _, part), f in zip(docs, fails):
            alive = True
            for step, c in enumerate(order, 1):
                row = out.setdefault((part or "", order, step), Counter())
                removed, alive = alive and c in f, alive and c not in f
                row.update(kept=alive, removed=removed, redundant=c in f and not removed, unique_fails=f == {c},
                           good_lost=removed and i in good, toxic_lost=removed and i in toxic)
                shares[part or "", c] += removed
    for (part, order, step), row in out.items():
        row["shapley"] = shares[part, order[step - 1]]
    return out


def test_audit_against_plain_loops(spark):
    words = " ".join(f"w{i}" for i in range(250))
    few = [(1, words, "en"), (2, words, "de"), (3, "x " * 300, None), (4, words + " #", "en"), (4, words, "en"), (5, None, ""), (6, "", None),
           (None, words, "en"), (7, "SHOUT " * 3, "en"), (8, words.upper(), "de"), (9, words + " #", "de")]
    labels = [(1, 1, 0, "x"), (2, 1, 1, "x"), (4, 0, 1, "x"), (4, 1, None, "x"), (7, None, 1, "x"), (None, 1, 1, "x"), (99, 1, 1, "x"), (9, 1, 0, "x")]
    docs = spark.createDataFrame([(*d, "clash") for d in few], "doc_id long, text string, lang string, good string")
    masks = filter_audit.failure_masks(docs, spark.createDataFrame(labels, LABELS))
    assert masks.count() == len(few)
    got = {(r["part"], r["filter_order"], r["step"]): {c: r[c] for c in (*filter_audit.COUNTS, "shapley")} for r in filter_audit.audit(masks).collect()}
    want = plain_audit(few, [row[:3] for row in labels])
    assert got == {k: {c: int(v[c]) for c in (*filter_audit.COUNTS, "shapley")} for k, v in want.items()}


def test_audit_odd(spark):
    docs, labels = odd_documents(spark), spark.createDataFrame([], LABELS)
    masks = filter_audit.failure_masks(docs, labels)
    audited = filter_audit.audit(masks)
    assert audited.count() == 600 * docs.select("lang").distinct().count()
    last = audited.where("step = 5").select(F.max("kept"), F.max("good_lost")).first()
    assert tuple(last) == (0, 0)  # the long texts repeat their words
    assert filter_audit.audit(filter_audit.failure_masks(empty(spark), labels)).count() == 0


def test_counts_do_not_run_over():
    n = (1 << 62) - 1
    found = filter_audit.audit_rows([(0, True, True, n), (1, True, False, 5)], "ABCDE")
    assert set(found["kept"]) == {n, n + 5} and set(found["removed"]) == {0, 5}


# importance resampling

def plain_features(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return len(words), [" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def plain_resampled(docs, target, percent, least, seed):
    bucket = lambda f: zlib.crc32(f.encode()) % 10_000
    raw, aim = (Counter(bucket(f) for t in texts for f in plain_features(t)[1]) for texts in ([t for _, t in docs], target))
    S, T = sum(raw.values()), sum(aim.values())
    gain = lambda b: math.floor(1000 * math.log((aim[b] + 1) * (S + 10_000) / ((raw[b] + 1) * (T + 10_000))))
    out = []
    for i, t in docs:
        n, features = plain_features(t)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain(bucket(f)) for f in features)
        out.append([n, i, len(features), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    long = sorted((r for r in out if r[0] >= least), key=lambda r: (-r[4], r[1] is None, r[1], r[2]))
    for rank, r in enumerate(long[:percent * len(long) // 100], 1):
        r[5] = rank
    return sorted(map(str, (tuple(r[1:]) for r in out)))


@pytest.mark.parametrize("percent, least", [(5, 20), (50, 1), (100, 0), (0, 0)])
def test_resampling_odd(spark, percent, least):
    docs = odd_documents(spark)
    aim = spark.createDataFrame([("one two three",), (None,), ("w5x5 w6x6",)], "text string")
    for target, texts in ((aim, ["one two three", None, "w5x5 w6x6"]), (aim.where("false"), [])):
        got = importance.resampled(docs, target, percent, least, 42)
        plain = plain_resampled([(r["doc_id"], r["text"]) for r in docs.collect()], texts, percent, least, 42)
        assert sorted(str(tuple(r)) for r in got.collect()) == plain
    assert importance.resampled(empty(spark), aim).count() == 0


@given(st.text(st.sampled_from("aB1 é_\n.語"), max_size=80), st.integers(1, 9))
@settings(max_examples=200, deadline=None)
def test_long_texts_are_read_in_pieces(text, piece):
    n, features = plain_features(text)
    parts = list(importance.buckets_of(text.encode(), piece))
    assert sum(p[0] for p in parts) == n
    assert Counter(b for _, buckets in parts for b in buckets.tolist()) == Counter(zlib.crc32(f.encode()) % 10_000 for f in features)


def test_ranks_are_those_of_a_sort(spark):
    df = spark.range(2000).select(F.col("id"), (F.col("id") * 7919 % 31).alias("score"), F.monotonically_increasing_id().alias("_n"))
    ranked = importance.with_rank(df, [F.col("score").desc(), F.col("id"), F.col("_n")]).orderBy("rank").collect()
    assert [r["rank"] for r in ranked] == list(range(1, 2001))
    assert [(r["score"], r["id"]) for r in ranked] == sorted(((r["score"], r["id"]) for r in ranked), key=lambda x: (-x[0], x[1]))


# prefix hashes

TEXTS = st.text(st.sampled_from("ab é語\U0001f600"), max_size=60)


def plain_extension(a, i, b, j):
    n = 0
    while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
        n += 1
    return n


@given(TEXTS, TEXTS, st.data())
@settings(max_examples=300, deadline=None)
def test_spans_and_extensions(a, b, data):
    i, j = data.draw(st.integers(0, len(a))), data.draw(st.integers(0, len(b)))
    x, y = PrefixHashes(a), PrefixHashes(b)
    assert x.common_extension(y, i, j) == plain_extension(a, i, b, j)
    n = min(len(a) - i, len(b) - j)
    assert x.same(i, y, j, n) == (a[i:i + n] == b[j:j + n])


@given(st.text(st.sampled_from("ab é語"), max_size=400), st.text(st.sampled_from("ab é語"), max_size=400))
@settings(max_examples=150, deadline=None)
def test_fingerprints(a, b):
    x, y = Fingerprint.of(PrefixHashes(a)), Fingerprint.of(PrefixHashes(b))
    assert str(Fingerprint.parse(str(x))) == str(x) and (str(x) == str(y)) == (a == b)
    assert x.likeness(x) == 1 and 0 <= x.likeness(y) <= 1
    again = Fingerprint.parse(str(x)).likeness(Fingerprint.parse(str(y)))
    assert x.likeness(y) == y.likeness(x) == again and (again == 1) == (a == b)
    for unit, segments in x.segments.items():
        assert segments.ends[-1] == len(a) and segments.sums == segments._sums()
        assert [PrefixHashes(a[s:e]).span(0, e - s) for s, e in zip(segments.ends, segments.ends[1:])] == [k[1:] for k in segments.keys]


def test_likeness_follows_edits():
    rng = np.random.default_rng(5)
    word = lambda: "".join(rng.choice(list("abcdefghij"), 5))
    near = lambda a, b: Fingerprint.of(PrefixHashes(a)).likeness(Fingerprint.of(PrefixHashes(b)))
    for size in (30, 300, 3000):
        a, b = (" ".join(word() for _ in range(size)) for _ in range(2))
        assert near(a, b) < 0.05
        assert 0.55 < near(a, prefix_hashes.edited_text(a, b)) < 0.8
        assert near(a, "new beginning " + a) > 0.8  # cuts move with the text
        middle = len(a) // 2
        assert near(a, a[:middle] + "inserted" + a[middle:]) > 0.8
    lines = "the same line again\n" * 200
    assert near(lines, prefix_hashes.edited_text(lines, "z" * 5000)) > 0.6  # repeating texts have cuts as well


def plain_compared(docs):
    digest = lambda t: hashlib.sha256((t or "").encode()).digest()
    order = sorted(docs, key=lambda r: (r[0] is not None, r[0] or 0, digest(r[1])))
    out = []
    for k, (i, t) in enumerate(order):
        t, after = t or "", order[(k + 1) % len(order)][1] or ""
        q = len(t) // 4
        edited = t[:len(t) - q] + after[:q]
        prints = [Fingerprint.of(PrefixHashes(x)) for x in (t, edited, after)]
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), str(prints[0]), str(prints[1]), prints[0].likeness(prints[1]),
                    prints[0].likeness(prints[2]), plain_extension(t, 0, edited, 0), plain_extension(t, 0, after, 0)))
    return sorted(map(str, out))


@pytest.mark.parametrize("ranges", [1, 7])
def test_compared_with_next(spark, ranges):
    docs = odd_documents(spark)
    spark.conf.set("spark.sql.shuffle.partitions", str(ranges))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        large = docs.withColumn("doc_id", F.col("doc_id") + (1 << 60))
        for frame in (docs, large, docs.where("doc_id = 5"), empty(spark), spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 60")):
            got = prefix_hashes.compared_with_next(frame)
            assert sorted(str(tuple(r)) for r in got.collect()) == plain_compared([(r["doc_id"], r["text"]) for r in frame.collect()])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_fingerprint_columns(spark):
    docs = odd_documents(spark).withColumn("fingerprint", F.lit("old"))
    marked = prefix_hashes.with_fingerprints(docs)
    assert sorted(marked.columns) == sorted(docs.columns) and marked.count() == docs.count()
    both = marked.select(prefix_hashes.likeness(F.col("fingerprint"), F.col("fingerprint")).alias("same"),
                         prefix_hashes.likeness(F.col("fingerprint"), F.lit(None).cast("string")).alias("none")).distinct().collect()
    assert [tuple(r) for r in both] == [(1.0, None)]

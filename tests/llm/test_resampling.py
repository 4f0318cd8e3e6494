"""Importance resampling and the radix sort against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from clickloom.llm import importance, queries, radix

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def runs_of(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return len(w), [" ".join(w[i:i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def brute(docs, target, percent=5, least=20):
    """{(doc_id, text): (n_features, weight, score)} and the drawn ids in order."""
    def bucket(run):
        return zlib.crc32(run.encode()) % 10000

    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(map(bucket, runs_of(text)[1]))
    for text in target:
        t.update(map(bucket, runs_of(text)[1]))
    big_s, big_t = sum(s.values()), sum(t.values())

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1.0) * (big_s + 10000) / ((s[b] + 1.0) * (big_t + 10000))))

    rows = []
    for doc, text in docs:
        n, runs = runs_of(text)
        weight = sum(gain(bucket(r)) for r in runs)
        h = int(hashlib.sha256(f"42:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        rows.append((doc, n, len(runs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    some = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2]))
    drawn = some[:len(some) * percent // 100]
    return rows, drawn


def check(report, rows, drawn):
    got = report.collect()
    assert Counter((r.doc_id, r.n_words, r.n_features, r.weight, r.score) for r in got) == Counter(rows)
    order = sorted((r for r in got if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in order] == list(range(1, len(drawn) + 1))
    assert [(r.doc_id, r.n_words, r.n_features, r.weight, r.score) for r in order] == drawn


def test_checksums_of_runs():
    import numpy as np
    import pyarrow as pa

    texts = ["Über die Brücke 7 mal", "x", "", None, "a" * 200 + " b " + "c" * 65 + "'" + "d" * 64 + "-é", "A.B,C\x7fD"]
    w = importance.text_words(pa.array(texts))
    for row, text in enumerate(texts):
        got = [b for bucket, there in importance.features(w)
               for b in np.asarray(bucket)[np.flatnonzero(there & (w.doc[:len(bucket)] == row))].tolist()]
        assert sorted(got) == sorted(zlib.crc32(r.encode()) % 10000 for r in runs_of(text)[1])


def test_on_hard_rows(spark, hard):
    target = ["alpha beta gamma", None, "", "Delta EPSILON zeta " * 9]
    docs = [(r.doc_id, r.text) for r in hard.collect()]
    rows, drawn = brute(docs, target, percent=60)
    assert drawn
    bench = spark.createDataFrame([(t,) for t in target], "text string")
    report = importance.resample(hard, bench, percent=60)
    check(report, rows, drawn)
    kept = importance.drawn(hard, report)
    assert kept.columns == hard.columns
    assert {r.doc_id for r in kept.collect()} == {r[0] for r in drawn}


def test_empty_tables(spark, hard, empty):
    assert importance.resample(empty, empty).count() == 0
    assert importance.resample(empty, hard).count() == 0
    rows, drawn = brute([(r.doc_id, r.text) for r in hard.collect()], [])
    check(importance.resample(hard, empty), rows, drawn)


def test_ties_go_to_the_smaller_id(spark):
    text = "one two three four five six seven eight nine ten " * 2
    docs = [(7, text)] * 3 + [(7, text + "more")] * 2 + [(None, text)] * 2
    rows, drawn = brute(docs, [], percent=90)
    check(importance.resample(spark.createDataFrame(docs, "doc_id long, text string"),
                              spark.createDataFrame([], "text string"), percent=90), rows, drawn)


def test_query_against_brute_force(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows, drawn = brute(docs, [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()])
    got = queries.op11_importance(spark, sf)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"] and {t for _, t in got.dtypes} == {"bigint"}
    place = {r: i + 1 for i, r in enumerate(drawn)}
    assert Counter(tuple(r) for r in got.collect()) == Counter((d, f, w, s, place.get((d, n, f, w, s))) for d, n, f, w, s in rows)


@pytest.mark.parametrize("block", [4, 64, 1 << 17])
def test_radix_order(spark, monkeypatch, block):
    monkeypatch.setattr(radix, "BLOCK", block)
    draw = random.Random(block)
    wide = [-(1 << 63), (1 << 63) - 1, 0, -1, 5, None]
    rows = [(draw.choice(wide), draw.randint(-70000, 70000), draw.choice([3, 3, 3, 900])) for _ in range(500)]
    df = spark.createDataFrame(rows, "a long, b long, c int").repartition(7)
    got = radix.radix_ranks(df, ["a", "b", "c"]).orderBy("rank").collect()
    assert [r["rank"] for r in got] == list(range(1, 501))
    assert [(r.a, r.b, r.c) for r in got] == sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2]))


def test_radix_without_digits(spark):
    df = spark.createDataFrame([(4,)] * 9, "a long").repartition(3)
    assert sorted(r["rank"] for r in radix.radix_ranks(df, ["a"]).collect()) == list(range(1, 10))
    assert radix.radix_ranks(df.filter(F.lit(False)), ["a"]).count() == 0


def test_a_digit_that_most_rows_share_is_spread(spark, monkeypatch):
    """Groups that are counted and numbered have at most a block of rows, however many share the digit."""
    monkeypatch.setattr(radix, "BLOCK", 100)
    df = spark.range(5000).select(F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(1).alias("a"), F.col("id").alias("b"))
    got = radix.radix_ranks(df, ["a", "b"]).orderBy("rank").collect()
    assert [(r.a, r.b) for r in got] == sorted((i if i % 3 == 0 else 1, i) for i in range(5000))

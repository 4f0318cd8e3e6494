"""SimHash near duplicates against plain Python."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from clickloom.llm import queries, simhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_print(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    runs = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) > 2 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(prints):
    """{print: least print it reaches}, comparing all pairs."""
    prints = sorted(set(prints))
    arr = np.array(prints, dtype=np.uint64)
    label = {}
    for p in prints:
        if p in label:
            continue
        label[p], todo = p, [p]
        while todo:
            near = arr[np.bitwise_count(arr ^ np.uint64(todo.pop())) <= 2]
            for q in near.tolist():
                if q not in label:
                    label[q] = p
                    todo.append(q)
    return label


def brute(docs):
    prints = [brute_print(t) for _, t in docs]
    label = classes(prints)
    least = {}
    for (doc, _), p in zip(docs, prints):
        if doc is not None:
            least[label[p]] = min(doc, least.get(label[p], doc))
    return sorted(((d, f"{p:016x}", least.get(label[p])) for (d, _), p in zip(docs, prints)), key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_on_hard_rows(spark, hard, empty):
    docs = [(r.doc_id, r.text) for r in hard.collect()]
    assert rows_of(simhash.near_duplicates(hard)) == brute(docs)
    assert simhash.near_duplicates(empty).count() == 0
    alone = spark.createDataFrame([(None, "x y z"), (None, "x y z")], "doc_id long, text string")
    assert rows_of(simhash.near_duplicates(alone)) == brute([(None, "x y z")] * 2)


def test_very_long_text(spark):
    from tests.llm.conftest import prose

    docs = [(1, prose(120_000, 5)), (2, prose(120_000, 5) + " more"), (3, "Ab  cd\tEF\ngh " * 3)]
    assert rows_of(simhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"))) == brute(docs)


@pytest.mark.parametrize("name", ["sf0.001", "sf0.01"])
def test_query_against_brute_force(spark, sf, name):
    folder = sf.replace("sf0.001", name)
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = queries.op12_simhash(spark, folder)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert rows_of(got) == brute(docs)


def flipped(p, draw, n):
    for b in draw.sample(range(64), n):
        p ^= 1 << b
    return p


def signed(p):
    return p - (1 << 64) if p >> 63 else p


@pytest.mark.parametrize("most", [2, 8, 256])
def test_links_of_crowded_fingerprints(spark, monkeypatch, most):
    """Chains, crowded balls and fingerprints that share 32, 48 or 56 bits: same classes as all pairs, at every bucket size."""
    monkeypatch.setattr(simhash, "MOST", most)
    draw = random.Random(most)
    prints = [draw.getrandbits(64) for _ in range(200)]
    for start in prints[:20]:
        for _ in range(10):
            start = flipped(start, draw, 2)
            prints.append(start)
    prints += [flipped(prints[30], draw, draw.randint(1, 6)) for _ in range(300)]
    prints += [(prints[31] & ~0xFFFFFFFF) | draw.getrandbits(32) for _ in range(300)]
    prints += [(prints[32] & ~0xFFFF) | draw.getrandbits(16) for _ in range(300)]
    prints += [(prints[33] & ~0xFF) | draw.getrandbits(8) for _ in range(300)]
    want = classes(prints)
    nodes = spark.createDataFrame([(signed(p),) for p in set(prints)], "fingerprint long").repartition(4)
    from clickloom.session import pin

    found = simhash.edges(pin(nodes)).collect()
    for r in found:
        assert ((r.a ^ r.b) & ((1 << 64) - 1)) and want[r.a % (1 << 64)] == want[r.b % (1 << 64)]
    above = {p: p for p in want}

    def root(p):
        while above[p] != p:
            p = above[p]
        return p

    for r in found:
        a, b = root(r.a % (1 << 64)), root(r.b % (1 << 64))
        above[max(a, b)] = min(a, b)
    assert {p: root(p) for p in want} == want


def test_sums_of_twins_tell_the_part():
    """Two changed bits leave the keys of at least one pair of parts; another change of the part changes its sums."""
    draw = random.Random(3)
    p = draw.getrandbits(64)
    for _ in range(200):
        q = flipped(p, draw, 2)
        both = np.array([p, q], dtype=np.uint64)
        outer = np.zeros(2, dtype=np.uint64)
        shared = [k[0] == k[1] for k, _ in simhash.bucket_keys(both, outer, (1 << 64) - 1)]
        moved = {b // 16 for b in range(64) if (p ^ q) >> b & 1}
        assert shared == [not moved & set(pair) for pair in simhash.PAIRS] and any(shared)


def test_a_third_of_the_rows_without_words(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, F.concat(
        F.lit("text number "), F.col("id").cast("string"), F.lit(" with words "), F.md5(F.col("id").cast("string")))).alias("text"))
    got = simhash.near_duplicates(df)
    zero = got.filter(F.col("fingerprint") == "0" * 16)
    assert zero.count() == 1000 and zero.select("component_id").distinct().collect()[0][0] == 0

"""The operators on hard tables: nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from clickloom.llm import (
    chat,
    decontam,
    fertility,
    jaccard_join,
    language_id,
    line_dedup,
    mixing,
    packing,
    sharding,
    vocabularies,
    warc,
)

from clickloom.session import pin

WORD = re.compile(r"[^\x20\x09-\x0D]+")
IDS = "byte_bpe_50k.json"


def grams(text, multiple=False):
    w = WORD.findall(text or "")
    found = [tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))] if w else []
    return Counter(found) if multiple else set(found)


# --- mixing ---------------------------------------------------------------------------------

def test_mix_meets_targets(hard):
    rows = mixing.mix(hard).collect()
    again = mixing.mix(hard).collect()
    assert sorted((r.doc_id or -1, r.source or "", r.copies) for r in rows) == sorted(
        (r.doc_id or -1, r.source or "", r.copies) for r in again)
    total = sum(r.size for r in rows)
    by = defaultdict(list)
    for r in rows:
        by[r.source].append(r)
        assert 0 <= r.copies <= 3
    assert set(by) == {"a", "b", "c", "", None}
    assert sum(rs[0].target for rs in by.values()) == pytest.approx(total)
    for rs in by.values():
        size, target = sum(r.size for r in rs), rs[0].target
        assert rs[0].source_size == size and target <= 3 * size + 1e-9
        assert abs(sum(r.size * r.copies for r in rs) - target) <= max(r.size for r in rs) * 2
    assert hard.columns[0] in mixing.mix(hard).columns and mixing.mix(hard).columns.count("size") == 1
    taken = mixing.take(mixing.mix(hard))
    assert taken.count() == sum(r.copies for r in rows)


def test_mix_weights_go_round_by_code_point(spark):
    df = spark.createDataFrame([(i, "w " * 100, s) for i, s in enumerate(["B", "a", "é", None])], "doc_id long, text string, source string")
    got = {r.source: r.target for r in mixing.mix(df).collect()}
    # weights 5, 2, 1, 5 of 400 words; 5/13 of 400 stays below three times 100
    assert {k: round(v, 6) for k, v in got.items()} == {
        "B": round(400 * 5 / 13, 6), "a": round(400 * 2 / 13, 6), "é": round(400 / 13, 6), None: round(400 * 5 / 13, 6)}


def test_mix_excess_is_shared_again(spark):
    df = spark.createDataFrame([(0, "w " * 10, "a"), (1, "w " * 1000, "b"), (2, "", "c")], "doc_id long, text string, source string")
    got = {r.source: (r.target, r.copies) for r in mixing.mix(df).collect()}
    assert got["a"] == (30.0, 3) and got["b"][0] == pytest.approx(980) and got["c"][0] == 0.0 and got["c"][1] == 0


def test_mix_empty(empty):
    assert mixing.mix(empty).count() == 0


# --- near duplicates ---------------------------------------------------------------------------

def brute_classes(rows):
    links = {i: {j for j in range(len(rows)) if j != i and linked(rows[i].text, rows[j].text)} for i in range(len(rows))}
    seen, label = {}, {}
    for i in range(len(rows)):
        stack, found = [i], set()
        while stack:
            x = stack.pop()
            if x not in found:
                found.add(x)
                stack += links[x]
        ids = [rows[x].doc_id for x in found if rows[x].doc_id is not None]
        label[i] = min(ids) if ids else None
        seen[i] = frozenset(found)
    return Counter((rows[i].doc_id, label[i], len(links[i])) for i in links)


def linked(a, b):
    a, b = a or "", b or ""
    if a == b:
        return True
    x, y = grams(a), grams(b)
    return bool(x and y) and len(x & y) >= 0.8 * len(x | y) - 1e-12


def test_near_duplicates_hard(hard):
    rows = hard.select("doc_id", "text").collect()
    got = Counter(tuple(r) for r in jaccard_join.near_duplicates(hard).collect())
    assert got == brute_classes(rows)


def test_near_duplicates_splits_large_buckets(spark, monkeypatch):
    from tests.llm.conftest import prose

    monkeypatch.setattr(jaccard_join, "SMALL", 6)
    monkeypatch.setattr(jaccard_join, "TILE_ROWS", 4)
    shared = prose(30, 99)
    texts = [shared + " " + prose(60, i) for i in range(30)] + [prose(100, 500) + f" tail{i}" for i in range(20)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = Counter(tuple(r) for r in jaccard_join.near_duplicates(df).collect())
    assert got == brute_classes(df.collect())


def variants(n, base, draw, most):
    """Texts of one base with up to ``most`` words replaced, added or left out; all differ."""
    out = set()
    while len(out) < n:
        w = list(base)
        for _ in range(draw.randint(0, most)):
            at = draw.randrange(len(w))
            w[at:at + draw.randint(0, 1)] = [f"new{draw.randint(0, 10 ** 6)}"] * draw.randint(0, 1)
        out.add(" ".join(w))
    return sorted(out)


@pytest.mark.parametrize("most", [1, 4])
def test_links_about_a_middle_are_exact(spark, monkeypatch, most):
    """Crowds of near copies, some near their middle and some at the edge of a link, with exact copies and null ids: links and classes as by
    brute force, and some links are told without a comparison."""
    import random

    from tests.llm.conftest import prose

    monkeypatch.setattr(jaccard_join, "SMALL", 12)
    monkeypatch.setattr(jaccard_join, "CROWD", 13)
    monkeypatch.setattr(jaccard_join, "DRAWN", 40)
    monkeypatch.setattr(jaccard_join, "TILE_ROWS", 16)
    told, inner = [], jaccard_join.told_links
    monkeypatch.setattr(jaccard_join, "told_links", lambda *a: told.append(inner(*a)) or told[-1])
    draw = random.Random(most)
    texts = variants(70, prose(110, 7).split(), draw, most) + variants(30, prose(70, 8).split(), draw, most) + [prose(90, i) for i in range(20)]
    rows = [(i if i % 9 else None, t) for i, t in enumerate([*texts, *texts[:15], "", None])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert Counter(tuple(r) for r in jaccard_join.near_duplicates(df).collect()) == brute_classes(df.collect())
    assert told and told[0][0].count() > 20


def test_tiles_of_near_copies_grow_in_proportion(spark, monkeypatch):
    from tests.llm.conftest import prose

    monkeypatch.setattr(jaccard_join, "CROWD", 512)
    found, inner = [], jaccard_join.candidates
    monkeypatch.setattr(jaccard_join, "candidates", lambda placed, *a: found.append(placed.count()) or inner(placed, *a))
    for n in (700, 1400):
        df = spark.createDataFrame([(i, prose(100, 500) + f" tail{i}") for i in range(n)], "doc_id long, text string")
        got = jaccard_join.near_duplicates(df).groupBy("class_id", "links").count().collect()
        assert [(r.class_id, r.links, r["count"]) for r in got] == [(0, n - 1, n)]
    assert found[1] <= 2.2 * max(found[0], 100)


def test_filter_and_splits_keep_the_recall():
    from math import ceil, comb

    near, most = jaccard_join.SIMILARITY, 1 - jaccard_join.RECALL
    runs = jaccard_join.runs_for(jaccard_join.RECALL, near)
    need = ceil((near - jaccard_join.SLACK) * jaccard_join.SKETCH - 1e-9)
    few = sum(comb(jaccard_join.SKETCH, k) * near ** k * (1 - near) ** (jaccard_join.SKETCH - k) for k in range(need))
    apart = (1 - near * (1 - (1 - near) ** jaccard_join.BRANCHES) ** jaccard_join.DEPTH) ** runs
    assert few + apart <= most and jaccard_join.missed(runs, near) <= most
    found = np.zeros((2, jaccard_join.SKETCH), dtype=np.uint32)
    found[1, need:] = 1
    assert len(jaccard_join.pairs(5, [[5], [5]], found, np.zeros(2), False, near)[0]) == 1
    with pytest.raises(ValueError):
        jaccard_join.runs_for(1 - 1e-9, near)


def test_keep_one(hard, empty):
    kept = jaccard_join.keep_one(hard)
    assert kept.columns == hard.columns
    ids = sorted((r.doc_id is None, r.doc_id) for r in kept.select("doc_id").collect())
    # 1, 2, 3 and a row without id are near duplicates; 5 and 6 both count as empty; 8 and 9 are equal; 11 is there twice
    assert [i for _, i in ids if i is not None] == [1, 4, 5, 7, 8, 10, 11, 12, 13, 14, 15] and len(ids) == 12
    assert jaccard_join.keep_one(empty).count() == 0


# --- decontamination ------------------------------------------------------------------------------

def test_leaks_against_brute_force(spark, hard):
    from tests.llm.conftest import prose

    items = [(1, " ".join(prose(60, 1).split()[10:45])), (2, "one"), (3, None), (4, ""), (5, prose(30, 77)), (5, prose(30, 77)),
             (None, prose(25, 78)), (6, "eta theta")]
    texts = [prose(50, 9) + " " + prose(30, 77) + "\n" + prose(20, 8), prose(25, 78) + " more", " ".join(prose(30, 77).split()[:28]),
             prose(30, 77).replace(" ", "  ", 3), prose(200, 12) + " eta theta " + prose(9, 3)]
    docs = hard.select("doc_id", "text").union(spark.createDataFrame([(100 + i, t) for i, t in enumerate(texts)], "doc_id long, text string"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): round(r.similarity, 9) for r in decontam.find_leaks(docs, bench).collect()}
    want = {}
    for d, text in docs.collect():
        w = WORD.findall(text or "")
        for i, item in items:
            theirs = grams(item, True)
            n = len(WORD.findall(item or ""))
            best = 0.0
            for at in range(max(1, len(w) - n + 1)):
                mine = grams(" ".join(w[at:at + n]), True)
                if mine and theirs:
                    common = sum((mine & theirs).values())
                    best = max(best, common / (sum(mine.values()) + sum(theirs.values()) - common))
            if best >= 0.8:
                want[(d, i)] = round(best, 9)
    assert got == want and (100, 5) in got and (None, 5) not in got
    clean = decontam.without_leaks(docs, bench)
    # rows without id are two different texts, of which one leaks
    assert {r.doc_id for r in clean.collect()} - {None} == {r.doc_id for r in docs.collect()} - {d for d, _ in want} - {None}
    assert clean.filter("doc_id is null").count() == 1


def test_short_items_leak_in_short_texts(spark):
    texts = ["alpha eta theta", "eta theta", "one eta theta one", "theta eta", "one", "eta theta eta theta", "one two eta theta x"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame([(1, "eta theta"), (2, "one"), (3, "alpha eta theta")], "item_id long, text string")
    got = sorted((r.doc_id, r.item_id, r.similarity, r.first_word, r.n_words) for r in decontam.find_leaks(docs, bench).collect())
    assert got == [(0, 1, 1.0, 1, 2), (0, 3, 1.0, 0, 3), (1, 1, 1.0, 0, 2), (2, 1, 1.0, 1, 2), (2, 2, 1.0, 0, 1), (4, 2, 1.0, 0, 1),
                   (5, 1, 1.0, 0, 2), (6, 1, 1.0, 2, 2), (6, 2, 1.0, 0, 1)]
    assert [r.doc_id for r in decontam.without_leaks(docs, bench).collect()] == [3]


def test_multi_index_finds_all_within_radius(monkeypatch):
    draw = np.random.default_rng(1)
    prints = draw.integers(0, 1 << 32, (400, 4), dtype=np.uint32)
    flips = [np.packbits(draw.random((100, 128)) < share, axis=1).view("<u4") for share in (0.15, 0.28, 0.35)]
    near = np.concatenate([prints[:100] ^ f for f in flips])
    every = np.bitwise_count(near[:, None, :] ^ prints[None]).sum(axis=2)
    for at_once in (1 << 22, 1000):
        monkeypatch.setattr(decontam, "PAIRS_AT_ONCE", at_once)
        query, at, distance = decontam.MultiIndex(prints).within(near)
        assert set(zip(query.tolist(), at.tolist())) == set(zip(*(x.tolist() for x in np.nonzero(every <= decontam.RADIUS))))
        assert (every[query, at] == distance).all()
    # few pairs of random fingerprints pass
    other = draw.integers(0, 1 << 32, (1000, 4), dtype=np.uint32)
    passed = sum(len(q) for q, _ in decontam.MultiIndex(prints).candidates(other))
    assert passed < 0.1 * 400 * 1000


def test_recall_of_the_radius():
    """Pairs of shingle sets just above the similarity: their fingerprints lie within the radius."""
    draw = np.random.default_rng(2)
    lost = 0
    for _ in range(1500):
        n = int(draw.integers(30, 200))
        common = draw.integers(0, 1 << 63, n).astype(np.uint64)
        more = int(n * 0.25 / 2)                      # common / (common + 2 more) is at least 0.8
        one, two = (np.concatenate((common, draw.integers(0, 1 << 63, more).astype(np.uint64))) for _ in range(2))
        a, b = (decontam.fingerprints(v, np.zeros(1, dtype=int), len(v)) for v in (one, two))
        lost += np.bitwise_count(a ^ b).sum() > decontam.RADIUS
    assert lost <= 1


def test_fingerprints_of_far_windows():
    """Windows at both ends of a long text, across steps and next to each other, equal those taken one by one."""
    draw = np.random.default_rng(3)
    value = draw.integers(0, 1 << 63, 300_000).astype(np.uint64)
    for size in (1, 7, 900, 40_000):
        starts = np.unique(np.concatenate((np.arange(5), draw.integers(0, 3000, 40), [16_380, 16_384, 299_999 - size, 300_000 - size])))
        got = decontam.fingerprints(value, starts, size)
        for s, g in zip(starts.tolist(), got):
            votes = decontam.bits_of(value[s:s + size]).sum(axis=0, dtype=np.int64)
            assert (np.packbits(votes > 0).view("<u4") == g).all()


def test_a_very_long_text_takes_little_memory():
    import tracemalloc

    from tests.llm.conftest import prose

    item = prose(60, 501)
    text = item + " " + " ".join(["filler word of no item"] * 800_000) + " " + item       # 19 MB, the item at both ends
    items = decontam.Items([1], [item])
    tracemalloc.start()
    found = list(items.leaks(pa.array([text]), 0.8))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == [(0, 0, 1.0, 0, 60)] and most < 600 << 20


def test_leaks_empty(empty, spark):
    bench = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert decontam.find_leaks(empty, bench).count() == 0
    assert decontam.find_leaks(bench.withColumnRenamed("item_id", "doc_id"), bench.limit(0)).count() == 0


# --- packed ids -------------------------------------------------------------------------------------

@pytest.mark.parametrize("bits", [1, 7, 15, 16, 17, 20])
def test_pack_round_trip(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 1001).astype(np.uint32)
    data = packing.pack(ids, bits)
    assert len(data) == (1001 * bits + 7) // 8
    assert (packing.unpack(data, 1001, bits) == ids).all()


def test_ids_of_whole_texts(hard, empty):
    from tokenizers import Tokenizer

    path = vocabularies.default_path(IDS)
    files = packing.write_ids(hard, path, per_block=256, unit_ids=500)
    got = packing.read_ids(files).orderBy("start").collect()
    tok = Tokenizer.from_file(path)
    want = {}
    for r in hard.collect():
        ids = tok.encode(r.text or "", add_special_tokens=False).ids + [2]
        want.setdefault(r.doc_id, []).append((len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
        want[r.doc_id].remove((r.n_tokens, r.ids_crc32))
    assert not any(want.values())
    assert [r.doc_id for r in got] == sorted([r.doc_id for r in got], key=lambda x: (x is not None, x))
    assert packing.read_ids(packing.write_ids(empty, path)).count() == 0


def test_ids_do_not_depend_on_the_partitions(spark):
    """Repeated and null ids: the same files whatever the order and number of input partitions."""
    from tests.llm.conftest import prose

    rows = [(draw % 5 or None, prose(1 + draw % 7, draw % 41)) for draw in range(200)] + [(3, None), (3, "")]
    found = []
    for n in (3, 5):
        df = spark.createDataFrame(rows if n == 3 else rows[::-1], "doc_id long, text string").repartition(n)
        files = packing.write_ids(df, vocabularies.default_path("byte_bpe_50k.json"), per_block=64, unit_ids=100)
        read = [tuple(r) for r in packing.read_ids(files).orderBy("start").collect()]
        assert len(read) == len(rows)
        found.append(read)
    assert found[0] == found[1]


def test_random_access(hard):
    files = packing.write_ids(hard.filter("doc_id = 10"), vocabularies.default_path(IDS), per_block=100)
    reader = packing.Reader(files.filter("docs > 0").first().path)
    whole = reader.ids(0, reader.n_ids)
    assert (reader.ids(333, 555) == whole[333:888]).all() and len(whole) == reader.n_ids


def test_parts_encode_like_whole_texts():
    import random

    import pyarrow as pa

    from clickloom.llm.text import buffers

    tok = vocabularies.byte_tokenizer(vocabularies.default_path(IDS))
    draw = random.Random(4)
    letters = ["a", "Bc", "é", "ß", " ", "  ", "\n", "\t", " ", "　", "'s", "'", ",", ".", "#", "…", "1", "½", "中", "\r\n", "\x1c",
               "\x85", "Ж", "<|endoftext|>", "𝒳", "​", "_", "-", "×", "|"]
    texts = ["".join(draw.choice(letters) for _ in range(draw.randint(0, 30))) for _ in range(2000)]
    ids, counts = tok.encode(*buffers(pa.array(texts)))
    for text, got in zip(texts, np.split(ids, np.cumsum(counts)[:-1])):
        assert got.tolist() == tok.tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


# --- quality rules -------------------------------------------------------------------------------------

def measured(df):
    return fertility.measure(df, vocabularies.default_path("byte_bpe_50k.tiktoken"), vocabularies.default_path("piece_bpe_32k.model"))


def test_counts_against_brute_force(hard, spark):
    repeats = spark.createDataFrame([(50, "a b c d e f a b c d e g\nx y\nx y\n \n \nx y")], "doc_id long, text string")
    docs = hard.select("doc_id", "text").union(repeats)
    for r in measured(docs).collect():
        text = r.text or ""
        w = WORD.findall(text)
        windows = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
        many = Counter(windows)
        covered = {i + j for i, x in enumerate(windows) if many[x] > 1 for j in range(5)}
        seen, dup = set(), 0
        for line in text.split("\n"):
            if WORD.search(line):
                dup += line in seen
                seen.add(line)
        assert [r[c] for c in fertility.COUNTS] == [
            len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)], r.doc_id
        assert (r.entropy is None) == (not w)


def test_measures_of_one_text(spark):
    import base64

    import public_tokenizers
    import sentencepiece
    import tiktoken

    text = "Hello worlds, hello ☃ 𝒳 again"
    got = measured(spark.createDataFrame([(text,)], "text string")).first()
    with open(vocabularies.default_path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    enc = tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    ids = [i for w in WORD.findall(text) for i in enc.encode_ordinary(" " + w)]
    sp = sentencepiece.SentencePieceProcessor(model_file=vocabularies.default_path("piece_bpe_32k.model"))
    pieces = [p for w in WORD.findall(text) for p in sp.encode(w)]
    chars = sum(map(len, WORD.findall(text)))
    share = np.array(list(Counter(ids).values())) / len(ids)
    assert got.chars_per_token == pytest.approx(chars / len(ids)) and got.chars_per_piece == pytest.approx(chars / len(pieces))
    assert got.fallback_share == pytest.approx(sum(map(sp.is_byte, pieces)) / len(pieces)) and got.fallback_share > 0
    assert got.entropy == pytest.approx(-(share * np.log2(share)).sum())


def test_verdict_rejects_what_leaves_its_band(spark, empty, hard):
    from tests.llm.conftest import prose

    rows = [(i, prose(100, i), "en") for i in range(40)] + [(90, " ".join(f"𝒳{chr(0x1F600 + i)}ꙮ" for i in range(100)), "en"), (91, "few words", "en")]
    found = measured(spark.createDataFrame(rows, "doc_id long, text string, lang string")).cache()
    kept = {r.doc_id: (r.base_failed, r.kept) for r in fertility.verdict(found, fertility.bands(found, enough=20)).collect()}
    assert all(kept[i] == (False, True) for i in range(40)) and kept[90] == (False, False) and kept[91] == (True, False)
    none = measured(empty)
    assert fertility.verdict(none, fertility.bands(none)).count() == 0
    found = measured(hard).cache()
    out = fertility.verdict(found, fertility.bands(found))
    assert out.count() == hard.count() and out.columns.count("kept") == 1


def test_sparse_groups_are_judged_by_wider_ones(spark):
    """A lone document of a language or length meets the language's or the script's band; null and empty languages differ."""
    from tests.llm.conftest import prose

    junk = " ".join("xqz" + "".join(chr(97 + (7 * i + j * j) % 26) for j in range(9)) for i in range(300))
    rows = [(i, prose(100 + i % 50, i), "en") for i in range(120)]
    rows += [(200, prose(900, 7), "en"), (201, junk, "en"), (202, junk, "xx"), (203, prose(100, 8), "xx"), (204, junk, None),
             (205, prose(100, 9), None), (206, junk, ""), (207, prose(100, 10), ""), (208, "слово за слово идёт одно слово раз два три четыре", None)]
    found = measured(spark.createDataFrame(rows, "doc_id long, text string, lang string")).cache()
    assert found.filter("doc_id = 208").first().script == "cyrillic" and found.filter("doc_id = 204").first().script == "latin"
    table = fertility.bands(found)
    assert {r._key for r in table.collect()} == {"length 3 of en", "all of en", "script latin"}
    gone = {r.doc_id for r in fertility.verdict(found, table).filter("not kept").collect()}
    assert gone == {201, 202, 204, 206}


def brute_verdict(rows):
    """{doc_id: (base_failed, kept)} from measured rows, group by group."""
    def failed(r):
        return r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words

    def keys(r):
        out = [] if r.lang is None else [(r.lang, math.floor(math.log2(r.n_words) / 2)), (r.lang,)]
        return [*((k, 100) for k in out), (("script", r.script), 20)]

    def median(values):
        return sorted(values)[(len(values) - 1) // 2]

    groups = defaultdict(set)
    for r in rows:
        if not failed(r):
            for key, _ in keys(r):
                groups[key].add((r.n_words, *[math.floor(r[m] * 1000 + 0.5) for m in fertility.MEASURES]))
    out = {}
    for r in rows:
        good = not failed(r)
        for key, enough in keys(r) if good else []:
            if len(groups[key]) >= enough:
                for i, m in enumerate(fertility.MEASURES):
                    mid = median([g[i + 1] for g in groups[key]])
                    mad = median([abs(g[i + 1] - mid) for g in groups[key]])
                    short = (1.5 if r.n_words < 64 else 1) if len(key) == 2 and key[0] != "script" else max(1, (256 / r.n_words) ** 0.5)
                    width = 4 * 1.4826 * short * (1.5 if m == "pieces_per_token" else 1)
                    half = max(mad * width / 1000, 0.05 if m == "fallback_share" else 0.05 * mid / 1000)
                    off = r[m] - mid / 1000
                    off = off if m == "fallback_share" else -off if m == "entropy" else abs(off)
                    good = good and off <= half + 1e-12
                break
        out[r.doc_id] = (failed(r), good)
    return out


def test_quality_query_against_brute_force(spark, sf):
    from clickloom.llm.queries import op9_fertility

    docs = spark.read.parquet(f"{sf.replace('0.001', '0.01')}/documents.parquet")
    want = brute_verdict(measured(docs.select("doc_id", "text", "lang")).collect())
    got = op9_fertility(spark, sf.replace("0.001", "0.01"))
    assert {r.doc_id: (r.base_failed, r.kept) for r in got.collect()} == want


def test_bands_catch_garbled_and_wrongly_labelled_text(spark, sf):
    """Mixed into the clean corpus, of 60 words or more: mojibake, shuffled letters, other languages labelled en; clean ones stay."""
    import random

    folder = sf.replace("0.001", "0.1")
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang")
    good = spark.read.parquet(f"{folder}/labels.parquet").filter("quality = 1").select("doc_id")
    found = pin(measured(docs), "t").join(good.withColumn("good", F.lit(True)), "doc_id", "left")
    some = [r for r in found.filter("good and n_words between 60 and 400 and doc_id % 5 = 0").collect()]

    def shuffled(text):
        draw = random.Random(5)
        return " ".join("".join(draw.sample(w, len(w))) for w in text.split(" "))

    made = [("mojibake", r.text.encode().decode("latin-1"), r.lang) for r in some if r.lang != "en"]
    made += [("shuffled", shuffled(r.text), r.lang) for r in some]
    made += [(f"{r.lang} as en", r.text, "en") for r in some if r.lang != "en"]
    other = measured(spark.createDataFrame(made, "kind string, text string, lang string"))
    table = fertility.bands(found)
    caught = {r.kind: r.rate for r in fertility.verdict(other, table).groupBy("kind").agg(
        F.avg(F.when(F.col("kept"), 0).otherwise(1)).alias("rate")).collect()}
    kept = fertility.verdict(found, table).filter("good and not base_failed and n_words >= 60").agg(F.avg(F.col("kept").cast("int"))).first()[0]
    print(caught, kept)
    assert min(caught.values()) >= 0.9 and kept >= 0.98


# --- sharding --------------------------------------------------------------------------------------------

def sharded(df, shards, units=1024):
    sized = df.withColumns({"bytes": F.octet_length(F.coalesce("text", F.lit(""))) + 16, "group_key": sharding.group_key(F.col("text"))}).cache()
    return sharding.with_slots(sharding.assign_shards(sized, shards, "group_key", "bytes", units), "shard", ["group_key", "doc_id"])


def check_shards(rows, shards):
    of, slots, load = {}, defaultdict(list), Counter()
    for r in rows:
        assert of.setdefault(r.group_key, r.shard) == r.shard and 0 <= r.shard < shards
        slots[r.shard].append(r.slot)
        load[r.shard] += r.bytes
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return load


def test_shards_follow_the_heap(hard, empty):
    rows = sharded(hard, 3).collect()
    load = check_shards(rows, 3)
    size = Counter()
    for r in rows:
        size[r.group_key] += r.bytes
    want = sharding.schedule(list(size.items()), 3)
    assert {r.group_key: r.shard for r in rows} == want and len(rows) == hard.count() and sum(load.values()) == sum(size.values())
    assert sharded(empty, 3).count() == 0


def test_small_groups_are_bundled(spark):
    from tests.llm.conftest import prose

    df = spark.createDataFrame([(i, prose(5 + i % 40, i)) for i in range(600)], "doc_id long, text string")
    load = check_shards(sharded(df, 4, units=8).collect(), 4)
    assert max(load.values()) - min(load.values()) < 0.1 * sum(load.values()) / 4


# --- lines -----------------------------------------------------------------------------------------------

def brute_maximal(texts, least):
    """Line numbers that go from each text: every run of ``least`` words that begins earlier too, whole."""
    lines = [[(i, x, len(WORD.findall(x))) for i, x in enumerate(t.split("\n")) if WORD.search(x)] for t in texts]
    starts = [(d, p) for d, of in enumerate(lines) for p in range(len(of))]
    gone = [set() for _ in texts]
    for at, (d, p) in enumerate(starts):
        for e, q in starts[:at]:
            n = 0
            while p + n < len(lines[d]) and q + n < len(lines[e]) and lines[d][p + n][1] == lines[e][q + n][1]:
                n += 1
            if sum(w for *_, w in lines[d][p:p + n]) >= least:
                gone[d].update(i for i, *_ in lines[d][p:p + n])
    return [sorted(x) for x in gone]


@pytest.mark.parametrize("least", [4, 12, 50])
def test_line_runs_go_whole(spark, least):
    import random

    from tests.llm.conftest import prose

    draw = random.Random(least)
    pool = [prose(n, 40 + n) for n in (1, 2, 3, 5, 8, 13, 30, 55)] + ["", " "]
    run = [prose(n, 900 + n) for n in (60, 10, 11)]
    texts = ["\n".join([*run, prose(70, 1)]), "\n".join([prose(3, 2), *run, prose(70, 3)]), "\n".join(run),
             "\n".join([*["echo"] * 130, "end"]), "\n".join(["echo"] * 51), prose(55, 95) + "\n\n" + prose(2, 42)]
    texts += ["\n".join(draw.choice(pool) for _ in range(draw.randint(1, 25))) for _ in range(30)]
    want = brute_maximal(texts, least)
    got = line_dedup.delete_repeated_runs(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), min_words=least)
    assert {r.doc_id: r.deleted for r in got.collect()} == dict(enumerate(want))
    assert want[1] == [1, 2, 3] and want[2] == [0, 1, 2]


@pytest.mark.parametrize("least", [4, 50])
def test_line_runs_of_hard_rows(spark, hard, least):
    """Null ids first, repeated ids and rows by the md5 of their text: the first copy keeps its lines."""
    import hashlib

    from tests.llm.conftest import prose

    rows = [(r.doc_id, r.text) for r in hard.collect()]
    rows += [(11, "\n".join([prose(30, 7), prose(30, 8), "end"])), (None, "\n".join([prose(30, 7), prose(30, 8)]))] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, hashlib.md5((r[1] or "").encode()).hexdigest()))
    want = brute_maximal([t or "" for _, t in rows], least)
    kept = ["\n".join(x for i, x in enumerate((t or "").split("\n")) if i not in gone) for (_, t), gone in zip(rows, want)]
    got = line_dedup.delete_repeated_runs(df, min_words=least).collect()
    assert sorted(map(str, [(r.doc_id, r.text, r.deleted) for r in got])) == sorted(map(str, zip([d for d, _ in rows], kept, want)))
    report = line_dedup.run_report(df, min_words=least)
    assert report.count() == len(rows) and report.agg(F.sum("n_deleted")).first()[0] == sum(map(len, want))


def test_lines_empty(empty):
    assert line_dedup.run_report(empty).count() == 0 and line_dedup.delete_repeated_runs(empty).count() == 0


# --- archives ----------------------------------------------------------------------------------------------

def test_archives_round_trip(spark):
    body = "<p>ünï</p>" * 200
    pages = spark.createDataFrame([(1, "u1", body), (2, "u\r\n2", body), (3, None, body), (3, "u3", body), (4, "u4", None), (5, "u5", ""),
                                   (6, "u6", "x" * 999), (7, "u7", "x" * 999), (None, "n", body), (8, "u8", "\x1f\x8b\x08 not gzip" * 100),
                                   *[(10 + i, "v", f"{i} " * 700) for i in range(40)]], "page_id long, url string, html string")
    files = warc.write_warc(warc.with_revisits(pages.repartition(2)))
    for split in (64, 700, 4 << 20):
        got = warc.read_warc(files, split, payloads=True).collect()
        assert len(got) == pages.count()
        texts = Counter((r.page_id, r.html or "") for r in pages.collect())
        for r in got:
            if r.record_type == "response":
                texts[(r.page_id, r.payload.decode())] -= 1
            else:
                assert r.refers_to == 3 and r.payload is None and r.payload_bytes == len(body.encode()) and r.page_id in (1, 2)
        assert sorted(r.page_id or 0 for r in got if r.record_type == "revisit") == [1, 2]
        assert +texts == Counter({(1, body): 1, (2, body): 1})
    assert warc.read_warc(warc.write_warc(warc.with_revisits(pages.limit(0)))).count() == 0


def foreign_archive():
    """Records as other crawlers write them: uuids, request and metadata records, no lengths or digests, WARC/1.0."""
    def one(kind, content, block, *more, version="1.0"):
        head = [f"WARC/{version}", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{kind}-{len(block)}>", "WARC-Date: 2020-01-01T00:00:00Z",
                f"Content-Type: {content}", f"Content-Length: {len(block)}", *more]
        return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"

    body = "<p>été</p>".encode() * 40
    http = "application/http; msgtype=response"
    return [one("warcinfo", "application/warc-fields", b"software: other\r\n"),
            one("request", "application/http; msgtype=request", b"GET / HTTP/1.1\r\nHost: a.b\r\n\r\n", "WARC-Target-URI: http://a.b/"),
            one("response", http, b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n" + body, "WARC-Target-URI: http://a.b/"),
            one("response", http, b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n3\r\nabc\r\n0\r\n\r\n",
                "WARC-Payload-Digest: sha1:" + "A" * 32),
            one("metadata", "application/warc-fields", b"fetchTimeMs: 5\r\n", "WARC-Concurrent-To: <urn:uuid:x>"),
            one("revisit", http, b"HTTP/1.1 304 Not Modified\r\n\r\n", "WARC-Refers-To: <urn:uuid:y>", version="1.1"),
            one("resource", "text/plain", b"", "WARC-Payload-Digest: md5:zz")], body


def test_archives_of_other_writers(spark, tmp_path):
    import hashlib

    records, body = foreign_archive()
    path = tmp_path / "other.warc.gz"
    path.write_bytes(b"".join(warc.member(r) for r in records))
    files = spark.createDataFrame([(str(path), path.stat().st_size)], "path string, bytes long")
    for split in (100, 4 << 20):
        got = warc.read_warc(files, split, payloads=True, kinds=None).collect()
        assert Counter(r.record_type for r in got) == Counter(["warcinfo", "request", "response", "response", "metadata", "revisit", "resource"])
        by = {(r.record_type, r.payload_bytes): r for r in got}
        page = by["response", len(body)]
        assert page.payload == body and page.payload_digest == hashlib.sha1(body).hexdigest() and page.url == "http://a.b/"
        assert page.page_id is None and page.record_id.startswith("<urn:uuid:response")
        assert by["response", 13].payload_digest == "00" * 20 and by["request", 0].content_type.endswith("request")
        revisit = by["revisit", None]
        assert revisit.refers_to_id == "<urn:uuid:y>" and revisit.refers_to is None and revisit.payload is None
        assert by["resource", 0].payload_digest == hashlib.sha1(b"").hexdigest() and by["metadata", 16].payload == b"fetchTimeMs: 5\r\n"
        assert warc.read_warc(files, split).count() == 3


def test_archive_begins_with_info_and_ids_are_unique(spark):
    """Repeated and null page numbers get record ids of their own; extra and clashing columns are ignored."""
    rows = [(1, "a", "x" * 2000, "p"), (1, "b", "y", "q"), (None, "c", "z", "r"), (None, "d", "z", "s"), (2, "e", "x" * 2000, "t")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, payload string").repartition(2)
    files = warc.write_warc(warc.with_revisits(pages))
    got = warc.read_warc(files, kinds=None).collect()
    assert len({r.record_id for r in got}) == len(got) == len(rows) + files.count()
    assert sum(r.record_type == "warcinfo" for r in got) == files.count()
    assert Counter(r.page_id for r in got if r.record_type != "warcinfo") == Counter(r[0] for r in rows)
    leader = next(r for r in got if r.page_id == 2)
    assert [r.refers_to_id for r in got if r.record_type == "revisit"] == [leader.record_id]
    assert warc.read_warc(warc.write_warc(warc.with_revisits(pages.limit(0)))).count() == 0


def test_damaged_archive_fails(spark, tmp_path):
    good = warc.member(warc.record(1, "u", b"abc", 3, "a9993e364706816aba3e25717850c26c9cd0d89d", None, "2024-01-01T00:00:00Z"))
    path = tmp_path / "x.warc.gz"
    path.write_bytes(b"junk\x1f\x8b\x08junk" + good + good[:-5])
    source = warc._Bytes(str(path))
    assert [at for at, _ in warc.records_in(source, 0, 60)] == [11]
    with pytest.raises(ValueError, match="ends inside"):
        list(warc.records_in(source, 0, source.size))


# --- chat -----------------------------------------------------------------------------------------------------

def test_perspectives(spark):
    turns = spark.createDataFrame([(1, 0, "system", "rules"), (1, 1, "ann", "hi <|im_end|>"), (1, 2, "bob", "yo"), (1, 2, "ann", None), (1, 3, None, "x"),
                                   (2, 0, "system", "alone"), (None, 5, "bob", "me"), (None, 5, "bob", "me")],
                                  "conv_id long, turn long, role string, text string").withColumn("_place", F.lit("x"))
    ordered = chat.turns_in_order(turns)
    segments = chat.perspectives(ordered)
    got = {(r.conv, r.participant): (r.rendered, [r.rendered[a:b] for a, b in r.spans]) for r in chat.dialogues(segments).collect()}
    assert set(got) == {(1, "ann"), (1, "bob"), (1, "unknown"), (None, "bob")}
    text, trained = got[(1, "bob")]
    assert text == ("<|im_start|>system\nrules<|im_end|>\n<|im_start|>user name=ann\nhi <| im_end|><|im_end|>\n"
                    "<|im_start|>user name=ann\n<|im_end|>\n<|im_start|>assistant\nyo<|im_end|>\n<|im_start|>user name=unknown\nx<|im_end|>\n")
    assert trained == ["yo<|im_end|>\n"] and got[(None, "bob")][1] == ["me<|im_end|>\n"] * 2
    sums = {(r.conv, r.participant): (r.n_turns, r.n_own_turns, r.n_chars, r.n_train_chars) for r in chat.digests(segments).collect()}
    assert sums[(1, "bob")] == (5, 1, len(text), len("yo<|im_end|>\n"))
    assert chat.digests(chat.perspectives(chat.turns_in_order(turns.limit(0)))).count() == 0


def test_renderings_in_parts_are_the_whole(spark, sf, monkeypatch):
    """Parts in order are the one-row rendering, their spans and digests the same whatever their length; the query reads its digests from them."""
    rows = [(c, i // 2, who, text) for c in (1, None) for i, (who, text) in enumerate(
        [("system", "<|im_start|>assistant\n"), ("ann", "naïve 𝒳 <|im_start|>"), ("b\r\n<|im_start|>ob", "assistant\n"), ("ann", None), (None, "\n"),
         ("ann", "日本"), ("assistant", "<|<|im_im_end|>"), ("user", ""), ("ann", "z")])]
    turns = spark.createDataFrame([*rows, (7, 0, "system", "alone"), (8, 0, "ann", "short")], "conv_id long, turn long, role string, text string")
    segments = chat.perspectives(chat.turns_in_order(turns))
    whole = {(r.conv, r.participant): (r.rendered, [tuple(s) for s in r.spans]) for r in chat.dialogues(segments).collect()}
    digests = sorted(map(str, chat.digests(segments).collect()))
    for n in (1, 2, 4, 64):
        parts = chat.renderings(segments, n)
        found = sorted(parts.collect(), key=lambda r: r.part)
        assert len(found) > len(whole) if n < 9 else len(found) == len(whole)
        joined = {key: ("", []) for key in whole}
        for r in found:
            text, spans = joined[(r.conv, r.participant)]
            assert r.begin == len(text)
            joined[(r.conv, r.participant)] = (text + r.rendered, [*spans, *map(tuple, r.spans)])
        assert joined == whole
        assert sorted(map(str, chat.rendering_digests(parts, n).collect())) == digests
    made, inner = [], chat.renderings
    monkeypatch.setattr(chat, "renderings", lambda *a: made.append(inner(*a)) or made[-1])
    from clickloom.llm.queries import QUERIES

    rows = QUERIES["op7_chat_perspectives"](spark, sf).collect()
    assert sum(len(r.rendered) for r in made[0].collect()) == sum(r.n_chars for r in rows)


# --- language ---------------------------------------------------------------------------------------------------

def test_gradients_are_right():
    samples = [("a", b"abcabc"), ("b", b"xyzxyz")]
    net = language_id.Network.fresh(["a", "b"], hidden=3)
    for part in ("inputs", "recurrent"):
        setattr(net, part, [p.astype(np.float64) for p in getattr(net, part)])
    net.out, net.bias = net.out.astype(np.float64), net.bias.astype(np.float64)
    x = np.stack([np.frombuffer(d, dtype=np.uint8) for _, d in samples], axis=1)
    y = np.array([0, 1])
    _, grads = language_id.gradients(net, x, y)
    for p, g in zip(net.parts(), grads):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        before, step = p[at], 1e-3
        p[at] = before + step
        up, _ = language_id.gradients(net, x, y)
        p[at] = before - step
        down, _ = language_id.gradients(net, x, y)
        p[at] = before
        assert (up - down) / (2 * step) == pytest.approx(g[at], rel=2e-2, abs=1e-4)


def test_languages_learned_and_edge_cases(spark, sf, hard, empty):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = language_id.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert sum(r.lang_pred == r.lang for r in held) >= 0.9 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)
    net = language_id.train([("en", b"the and of"), ("es", "ción ñandú".encode())] * 3, steps=5)
    got = {r.doc_id: (r.lang_pred, r.score) for r in language_id.predict(hard, net).collect()}
    assert all(got[i] == ("und", 0.0) for i in (5, 6, 7)) and got[13][0] in ("en", "es") and got[10][0] in ("en", "es")
    assert language_id.identify(empty).count() == 0
    unlabelled = hard.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language_id.identify(unlabelled).collect()} == {"und"}


def test_all_of_many_labels_are_learned():
    """150 labels, more than a batch: each is predicted at least once on texts that were held out."""
    import random

    draw = random.Random(1)
    parts = {f"l{i:03d}": ["".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=2)) for _ in range(6)] for i in range(150)}

    def text(label):
        return " ".join("".join(draw.choices(parts[label], k=draw.randint(1, 3))) for _ in range(40))

    net = language_id.train([(label, text(label).encode()) for label in parts for _ in range(20)])
    held = [(label, text(label)) for label in parts for _ in range(2)]
    data, offsets = language_id.buffers(pa.array([t for _, t in held]))
    best = [net.labels[i] for i in language_id.document_probabilities(net, data, offsets).argmax(axis=1)]
    assert set(best) == set(parts) and sum(b == label for b, (label, _) in zip(best, held)) >= 0.9 * len(held)


def test_sample_is_bounded_and_spread(spark):
    """One id for all rows and null ids: texts are sampled like any others; copies count once; labels share the total."""
    from tests.llm.conftest import prose

    for key in (7, 5, None):
        df = spark.createDataFrame([(key, prose(30, i), f"l{i % 3}") for i in range(900)] + [(key, prose(30, 1), "l1")] * 500
                                   + [(key, "", "l0"), (key, None, "l1"), (key, "x", None)], "doc_id long, text string, lang string")
        got = Counter(label for label, _ in language_id.labelled_sample(df, "doc_id", "text", "lang", per_label=200))
        assert got == {"l0": 200, "l1": 200, "l2": 200}
        got = Counter(label for label, _ in language_id.labelled_sample(df, "doc_id", "text", "lang", texts=60))
        assert got == {"l0": 20, "l1": 20, "l2": 20}
        assert len(language_id.labelled_sample(df, "doc_id", "text", "lang", texts=2)) == 2


def test_long_text_is_read_whole():
    net = language_id.Network.fresh(["a", "b", "c"])
    data = np.random.default_rng(0).integers(0, 256, 1500).astype(np.uint8)
    p = language_id.document_probabilities(net, np.concatenate((data, data[:7])), np.array([0, 1500, 1500, 1507]))
    assert p[0].sum() == pytest.approx(1, abs=1e-4) and p[1].sum() == 0 and p[2].sum() == pytest.approx(1, abs=1e-4)
    x = data[:150]
    one = language_id.document_probabilities(net, x, np.array([0, 150]))[0]
    labels = language_id.byte_labels(net, x.tobytes())
    assert len(labels) == 150 and Counter(labels).most_common(1)[0][0] == net.labels[one.argmax()]


def test_reading_costs_what_the_counted_bytes_need(monkeypatch):
    """No state is computed beyond the last counted byte of a direction, and none on scattered pieces of memory."""
    net, many = language_id.Network.fresh(["a", "b", "c"]), 5
    data = np.random.default_rng(1).integers(0, 256, many * language_id.WINDOW).astype(np.uint8)
    made, tanh = [], np.tanh

    def counting(x, out=None):
        made.append((x.size, x.flags.c_contiguous))
        return tanh(x, out=out)

    monkeypatch.setattr(np, "tanh", counting)
    language_id.document_probabilities(net, data, np.array([0, len(data)]))
    steps = language_id.WINDOW + language_id.CONTEXT
    assert sum(size for size, _ in made) == 2 * steps * many * 3 * language_id.HIDDEN and all(whole for _, whole in made)


@pytest.mark.parametrize("classes", [1, 4, 40])
def test_reading_matches_a_plain_loop(classes):
    """Each window on its own, byte by byte, with 16 bytes on either side; zeros before and beyond the text, as in a matrix of windows."""
    net = language_id.Network.fresh([f"l{i:02d}" for i in range(classes)])
    lengths = [0, 1, 15, 207, 208, 209, 0, 500]
    data = np.random.default_rng(2).integers(0, 256, sum(lengths)).astype(np.uint8)
    offsets = np.concatenate(([0], np.cumsum(lengths)))
    window, context = language_id.WINDOW, language_id.CONTEXT

    def plain(text):
        total = np.zeros(classes)
        for at in range(0, len(text), window):
            x = [text[i] if 0 <= i < len(text) else 0 for i in range(at - context, at + window + context)]
            states = []
            for side in range(2):
                h, found = np.zeros(language_id.HIDDEN), {}
                for t in range(len(x)) if side == 0 else range(len(x) - 1, -1, -1):
                    (z, r, n), (az, ar, an) = np.split(net.inputs[side][x[t]].astype(float), 3), np.split(h @ net.recurrent[side], 3)
                    z, r = 1 / (1 + np.exp(-z - az)), 1 / (1 + np.exp(-r - ar))
                    n = np.tanh(n + r * an)
                    h = n + z * (h - n)
                    found[t] = h
                states.append(found)
            for t in range(context, context + min(window, len(text) - at)):
                p = np.exp(np.concatenate((states[0][t], states[1][t])) @ net.out + net.bias)
                total += p / p.sum()
        return total / max(1, len(text))

    want = [plain(data[lo:hi]) for lo, hi in zip(offsets, offsets[1:])]
    assert language_id.document_probabilities(net, data, offsets) == pytest.approx(np.array(want), abs=1e-5)


# --- pipeline ------------------------------------------------------------------------------------------------------

def test_stages_on_hard_rows(spark, hard, empty, sf):
    import corpus_pipeline

    for docs in (hard, empty):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, sf)
            if name != "sharding":
                assert out.columns == corpus_pipeline.COLUMNS
                assert out.exceptAll(docs.select(*corpus_pipeline.COLUMNS).union(docs.select(*corpus_pipeline.COLUMNS)).union(
                    docs.select(*corpus_pipeline.COLUMNS))).count() == 0
            else:
                assert out.count() == docs.count()


@pytest.mark.parametrize("name", ["op1_mixing", "op3_jaccard_join", "op4_warc", "op6_line_dedup", "op7_chat_perspectives"])
def test_query_against_sql(spark, sf, name):
    from check import compare, connect
    from clickloom.llm.queries import ORACLES, QUERIES

    good, note = compare(QUERIES[name](spark, sf), connect(sf), ORACLES[name])
    assert good, note


def test_pipeline_runs(spark, sf):
    from clickloom.llm.queries import QUERIES

    rows = QUERIES["pipeline"](spark, sf).collect()
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r.slot)
    assert rows and all(sorted(s) == list(range(len(s))) for s in by.values())


def test_measuring_holds_few_texts_at_once(monkeypatch):
    """memory of the measuring code and of the tables it keeps follows neither a batch of texts nor the length of words."""
    import tracemalloc

    vocab = fertility.vocabularies(vocabularies.default_path("byte_bpe_50k.tiktoken"), vocabularies.default_path("piece_bpe_32k.model"))
    batch = pa.RecordBatch.from_arrays([pa.array([" ".join(f"w{(i + j * j) % 5000}" for j in range(400)) for i in range(2800)])], names=["text"])
    assert batch.nbytes > 5 << 20
    vocab.forget()
    tracemalloc.start()
    try:
        parts = [part.select(fertility.COUNTS) for part in fertility.measured(iter([batch]), 0, vocab)]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 100 << 20 and pa.Table.from_batches(parts).column("n_words").to_pylist() == [400] * 2800
    vocab.forget()
    monkeypatch.setattr(fertility, "KEPT_BYTES", 10_000)
    long = [b"%d" % i * 500 for i in range(100, 115)]
    assert vocab.of(long[:12]).tolist() == list(range(12)) and len(vocab.known) == 12
    assert vocab.of(long[12:]).tolist() == [0, 1, 2] and len(vocab.known) == 3
    vocab.forget()


def test_small_batches_bound_what_a_worker_is_sent(spark):
    """bytes, not only rows, bound a batch inside the block; the session has its own setting again afterwards, also after an error."""
    from clickloom.session import small_batches

    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["rows", "bytes"])

    texts = spark.range(0, 3000, 1, 1).select(F.repeat(F.lit("words "), 1000).alias("text"))
    with small_batches(spark):
        got = texts.mapInArrow(sizes, "rows long, bytes long").collect()
    assert sum(r.rows for r in got) == 3000 and len(got) >= 4 and max(r.bytes for r in got) < 5 << 20
    assert spark.conf.get(name, None) == before
    with pytest.raises(ZeroDivisionError), small_batches(spark):
        1 / 0
    assert spark.conf.get(name, None) == before


def test_small_batches_bound_what_is_read_at_once(spark, tmp_path):
    """F1: the reader of whole texts holds a few rows, not 4,096 of the longest (4,000 of 110,000 characters took more than a heap of 1.8 GB)."""
    from clickloom.session import small_batches

    def read_at_once():
        docs = spark.read.parquet(str(tmp_path / "texts")).mapInArrow(lambda batches: batches, "text string")
        assert docs.count() == 100
        rows = docs.collect()
        node, found = docs._jdf.queryExecution().executedPlan(), []
        nodes = [node]
        while nodes:
            node = nodes.pop()
            nodes += [node.children().apply(i) for i in range(node.children().size())]
            if node.nodeName() == "ColumnarToRow":
                found.append(node.metrics().apply("numInputBatches").value())
        return len(rows), found

    name = "spark.sql.parquet.columnarReaderBatchSize"
    before = spark.conf.get(name, None)
    spark.range(0, 100, 1, 1).select(F.repeat(F.lit("words "), 100).alias("text")).write.parquet(str(tmp_path / "texts"))
    assert read_at_once() == (100, [1])
    with small_batches(spark):
        assert read_at_once() == (100, [7])
    assert spark.conf.get(name, None) == before


def test_white_space_runs_have_the_ranks_of_the_tokenizer(monkeypatch):
    """the tokenizer fails on a million white-space characters in a row; cut out, runs have the ranks that it gives to shorter ones."""
    import random
    import re

    vocab = fertility.vocabularies(vocabularies.default_path("byte_bpe_50k.tiktoken"), vocabularies.default_path("piece_bpe_32k.model"))
    words, counts = vocab._ranks_of(["\u00a0" * 1_200_000, "a" + "\u00a0" * 1_200_000 + "b"])
    assert len(counts) == 2 and len(words) == counts.sum()
    assert vocab.ranks.decode(words.tolist()) == " " + "\u00a0" * 1_200_000 + " a" + "\u00a0" * 1_200_000 + "b"
    monkeypatch.setattr(fertility, "RUN", 3)
    monkeypatch.setattr(fertility, "WIDE_RUN", re.compile(fertility.WIDE_RUN.pattern.replace("100000", "3")))
    draw = random.Random(5)
    for _ in range(300):
        text = " " + "".join(draw.choice(["a", "'s", "Ж1", "!", "漢"]) if draw.random() < 0.3 else draw.choice("\u00a0\u3000\u2003\u0085") * draw.randint(1, 6)
                             for _ in range(8))
        assert vocab._encoded(text).tolist() == vocab.ranks.encode_ordinary(text)


def test_op9_measures_odd_texts(spark, tmp_path):
    """bytes that are not UTF-8 and a long run of white space stop no task; the rows beside them are measured as alone."""
    from clickloom.llm.queries import op9_fertility

    def texts(*rows):
        return " union all ".join(f"select {i}L doc_id, {text} text, 'en' lang, 's' source, 0L n_chars" for i, text in rows)

    plain = (1, "'some plain words stand in this text and nothing else'")
    spark.sql(texts(plain, (2, "cast(unhex('636166E9206F6B20FF') as string)"), (3, "concat('a ', repeat('\u00a0', 1200000))"))) \
        .write.parquet(str(tmp_path / "odd/documents.parquet"))
    spark.sql(texts(plain, (2, "'caf\ufffd ok \ufffd'"))).write.parquet(str(tmp_path / "even/documents.parquet"))
    odd, even = ({r.doc_id: r.asDict() for r in op9_fertility(spark, str(tmp_path / d)).collect()} for d in ("odd", "even"))
    assert set(odd) == {1, 2, 3} and odd[1] == even[1]
    assert {m: odd[2][m] for m in ("n_words", *fertility.MEASURES)} == {m: even[2][m] for m in ("n_words", *fertility.MEASURES)}
    assert (odd[3]["n_words"], odd[3]["word_chars"]) == (2, 1_200_001) and odd[3]["tokens_per_word"] > 1000


def test_op9_judges_texts_without_words(spark, tmp_path, conf):
    """null and empty texts are not kept and divide nothing by their 0 words, where Spark reports a division by zero."""
    from clickloom.llm.queries import op9_fertility

    conf(spark__sql__ansi__enabled="true")
    plain = [(i, " ".join(f"w{(i * 7 + j * j) % 50}" for j in range(30)), "en") for i in range(150)]
    bare = [(150, None, "en"), (151, "", "en"), (152, " \n\t ", None), (153, None, None)]
    spark.createDataFrame(plain + bare, "doc_id long, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    out = op9_fertility(spark, str(tmp_path))
    out.write.parquet(str(tmp_path / "out"))
    rows = {r.doc_id: r for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert len(rows) == 154 and any(rows[i].kept for i in range(150))
    for i in range(150, 154):
        assert (rows[i].n_words, rows[i].base_failed, rows[i].kept, rows[i].entropy) == (0, True, False, None)

"""Every stage of the pipeline against a brute-force version on its own input, and the queries that SQL cannot state."""

import hashlib
import heapq
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest

from clickloom.llm import oracles, queries
from clickloom.session import pin
from tests.llm.test_llm_tables import WORD, brute_verdict, grams, measured

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def classes(rows, similarity=0.8):
    """Class number of each (id, text): equal texts, or five-word shingle sets of at least that similarity, linked through others."""
    above = list(range(len(rows)))

    def root(i):
        while above[i] != i:
            i = above[i]
        return i

    sets = [grams(t) for _, t in rows]
    by_text, by_gram = defaultdict(list), defaultdict(list)
    for i, (_, text) in enumerate(rows):
        by_text[text or ""].append(i)
        for g in sets[i]:
            by_gram[g].append(i)
    pairs = {(a, b) for group in by_gram.values() for a in group for b in group if a < b}
    pairs = {(a, b) for a, b in pairs if len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b]) - 1e-9}
    pairs |= {(group[0], b) for group in by_text.values() for b in group[1:]}
    for a, b in pairs:
        a, b = sorted((root(a), root(b)))
        above[b] = a
    return [root(i) for i in range(len(rows))]


def leaks(text, items, similarity=0.8):
    w = WORD.findall(text or "")
    for item in items:
        theirs, n = grams(item, True), len(WORD.findall(item or ""))
        known = set(theirs)
        if not known:
            continue
        shingles = [tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))] if w else []
        starts = {s for i, g in enumerate(shingles) if g in known for s in range(max(0, i - n), i + 1)}
        for at in sorted(s for s in starts if s <= max(0, len(w) - n)):
            mine = grams(" ".join(w[at:at + n]), True)
            common = sum((mine & theirs).values())
            if common >= similarity * (sum(mine.values()) + sum(theirs.values()) - common) - 1e-9:
                return True
    return False


def plain_shards(groups, shards):
    """Largest group first, each to the least-loaded shard."""
    heap, out = [(0, s) for s in range(shards)], {}
    for key, size in sorted(groups.items(), key=lambda g: (-g[1], g[0])):
        load, shard = heapq.heappop(heap)
        out[key] = shard
        heapq.heappush(heap, (load + size, shard))
    return out


def size_of(text):
    return len((text or "").encode()) + 16


def key_of(text):
    return "null" if text is None else hashlib.md5(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def stages(spark, sf):
    import corpus_pipeline

    docs, found = spark.read.parquet(f"{sf}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        out = pin(stage(spark, docs, sf), "t")
        found.append((name, docs.collect(), out.collect(), out.columns))
        docs = out
    return {name: (given, got, columns) for name, given, got, columns in found}


def rows(found):
    return Counter(tuple(r[c] for c in COLUMNS) for r in found)


def test_all_but_the_last_return_the_columns_of_documents(stages):
    assert list(stages) == ["quality_rules", "ngram_jaccard_join", "benchmark_decontamination", "mixing_sources", "sharding"]
    assert all(columns == COLUMNS for name, (_, _, columns) in stages.items() if name != "sharding")
    assert all(len(got) < len(given) for name, (given, got, _) in stages.items() if name in ("quality_rules", "ngram_jaccard_join"))


def test_quality_stage(spark, stages):
    given, got, _ = stages["quality_rules"]
    want = brute_verdict(measured(spark.createDataFrame([(r.doc_id, r.text, r.lang) for r in given], "doc_id long, text string, lang string")).collect())
    assert rows(got) == rows(r for r in given if want[r.doc_id][1])


def test_near_duplicate_stage(stages):
    given, got, _ = stages["ngram_jaccard_join"]
    found = classes([(r.doc_id, r.text) for r in given])
    best = {}
    for r, c in zip(given, found):
        if c not in best or r.doc_id < best[c].doc_id:
            best[c] = r
    assert rows(got) == rows(best.values())


def test_decontamination_stage(spark, stages, sf):
    given, got, _ = stages["benchmark_decontamination"]
    items = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert rows(got) == rows(r for r in given if not leaks(r.text, items))


def test_mixing_stage(stages):
    given, got, _ = stages["mixing_sources"]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", [tuple(r[c] for c in COLUMNS) for r in given])
    taken = {d: (size, words) for d, size, _, _, words in con.execute(oracles.OP1).fetchall()}
    times = Counter(r.doc_id for r in got)
    assert all(times[r.doc_id] * taken[r.doc_id][0] == taken[r.doc_id][1] for r in given) and max(times.values()) <= 3
    assert set(rows(got)) <= set(rows(given))


def check_slots(got):
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_sharding_stage(stages):
    given, got, _ = stages["sharding"]
    groups = Counter()
    for r in given:
        groups[key_of(r.text)] += size_of(r.text)
    want = plain_shards(groups, 40)
    assert Counter((r.doc_id, r.text, r.size, r.shard) for r in got) == Counter(
        (r.doc_id, r.text, size_of(r.text), want[key_of(r.text)]) for r in given)
    check_slots(got)


def test_sharding_query(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    groups = Counter()
    for r in docs:
        groups[key_of(r.text)] += size_of(r.text)
    want, got = plain_shards(groups, 40), queries.op10_sharding(spark, sf).collect()
    assert Counter((r.doc_id, r["size"], r.text_crc32, r.law, r.shard, r.grown_shard) for r in got) == Counter(
        (r.doc_id, size_of(r.text), zlib.crc32((r.text or "").encode()), "bytes", want[key_of(r.text)], None) for r in docs)
    check_slots(got)


def test_decontamination_query(spark, sf):
    items = {r.item_id: r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    got = {(r.doc_id, r.item_id) for r in queries.op2_decontamination(spark, sf).collect()}
    assert got and got == {(r.doc_id, i) for r in docs for i, t in items.items() if leaks(r.text, [t])}


def test_packed_ids_query(spark, sf):
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    start, want = 0, []
    for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect():
        ids = [*tok.encode(r.text or "", add_special_tokens=False).ids, 2]
        want.append((r.doc_id, start, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))))
        start += len(ids)
    assert sorted(tuple(r) for r in queries.op8_packed_ids(spark, sf).collect()) == want


def test_language_query(spark, sf):
    """Held-out rows are told by their text alone: the same texts with other labels, sources and ids get the same answer."""
    got = queries.op5_language_id(spark, sf).collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert len(got) == len(lang) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r.held_out and lang[r.doc_id]]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.95 * len(held) and all(0 <= r.score <= 1 for r in got)

"""Resampling documents towards a target text: importance weights over hashed n-grams, Gumbel draws, radix ranks."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.radix import radix_ranks
from clickloom.llm.text import Words, buffers, lower_ascii, per_row, slices, words
from clickloom.session import pin

BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 5
SEED = 42
U32 = np.uint32

#: A word is a run of digits, letters a-z and bytes outside ASCII.
BETWEEN = np.ones(256, dtype=bool)
BETWEEN[0x30:0x3A] = BETWEEN[0x61:0x7B] = BETWEEN[0x80:] = False

#: Word bytes handled in array steps; what is longer goes through zlib.
SHORT = 64


def _crc_table() -> np.ndarray:
    value = np.arange(256, dtype=U32)
    for _ in range(8):
        value = np.where(value & U32(1), (value >> U32(1)) ^ U32(0xEDB88320), value >> U32(1))
    return value


def _zero_tables() -> np.ndarray:
    """[n, place, byte]: what n zero bytes make of a checksum that has only this byte at this place."""
    out = np.zeros((SHORT + 1, 4, 256), dtype=U32)
    for place in range(4):
        out[0, place] = np.arange(256, dtype=U32) << U32(8 * place)
    for n in range(1, SHORT + 1):
        out[n] = _CRC[out[n - 1] & U32(255)] ^ (out[n - 1] >> U32(8))
    return out


_CRC = _crc_table()
_ZEROS = _zero_tables()


def after_zeros(crc: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Checksums moved over ``n`` zero bytes: crc32(a + b) = after_zeros(crc32(a), len(b)) ^ crc32(b)."""
    if len(n) and n.max() > SHORT:
        crc, n = crc.copy(), n.copy()
        far = np.flatnonzero(n > SHORT)
        while len(far):
            crc[far] = after_zeros(crc[far], np.full(len(far), SHORT))
            n[far] -= SHORT
            far = far[n[far] > SHORT]
    byte = U32(255)
    return (_ZEROS[n, 0, crc & byte] ^ _ZEROS[n, 1, (crc >> U32(8)) & byte]
            ^ _ZEROS[n, 2, (crc >> U32(16)) & byte] ^ _ZEROS[n, 3, crc >> U32(24)])


def word_crcs(w: Words) -> np.ndarray:
    """crc32 of each word, one array step for each byte place."""
    out = np.zeros(len(w.lengths), dtype=U32)
    starts = np.concatenate(([0], np.cumsum(w.lengths)[:-1])) if len(w.lengths) else w.lengths
    order = np.argsort(-w.lengths, kind="stable")
    lengths, at = w.lengths[order], starts[order]
    long = int(np.searchsorted(-lengths, -SHORT, side="left"))
    for i in range(long):
        out[order[i]] = zlib.crc32(w.data[at[i]:at[i] + lengths[i]])
    order, lengths, at = order[long:], lengths[long:], at[long:]
    crc = np.full(len(order), 0xFFFFFFFF, dtype=U32)
    for place in range(int(lengths[0]) if len(lengths) else 0):
        m = int(np.searchsorted(-lengths, -place, side="left"))
        crc[:m] = _CRC[(crc[:m] ^ w.data[at[:m] + place]) & U32(255)] ^ (crc[:m] >> U32(8))
    out[order] = crc ^ U32(0xFFFFFFFF)
    return out


def features(w: Words) -> list[tuple[np.ndarray, np.ndarray]]:
    """For runs of one, two and three words: the bucket of the run that begins at each word, and whether there is one.

    Checksums of longer runs come from those of the words, so no run is put together as text.
    """
    crc, n = word_crcs(w), len(w.lengths)
    spaced = after_zeros(np.full(n, zlib.crc32(b" "), dtype=U32), w.lengths) ^ crc
    out = [(crc % U32(BUCKETS), np.ones(n, dtype=bool))]
    run = crc
    for k in (1, 2):
        if n <= k:
            break
        run = after_zeros(run[:n - k], w.lengths[k:] + 1) ^ spaced[k:]
        out.append((run % U32(BUCKETS), w.doc[:n - k] == w.doc[k:]))
    return out


def text_words(column: pa.Array) -> Words:
    data, offsets = buffers(column)
    return words(lower_ascii(data), offsets, BETWEEN)


def bucket_counts(df: DataFrame, text: str = "text") -> np.ndarray:
    """Number of features of all texts in each bucket.  A task hands on one row a bucket, the driver gets one a bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            for lo, hi in slices(batch.column(0)):
                for bucket, there in features(text_words(batch.column(0).slice(lo, hi - lo))):
                    total += np.bincount(bucket[there], minlength=BUCKETS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    found = df.select(text).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(BUCKETS, dtype=np.int64)
    for r in found:
        out[r.bucket] = r.n
    return out


def gains(of_docs: np.ndarray, of_target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln of the smoothed ratio of shares) of each bucket."""
    over = (of_target + 1.0) * (of_docs.sum() + float(BUCKETS))
    under = (of_docs + 1.0) * (of_target.sum() + float(BUCKETS))
    return np.floor(1000 * np.log(over / under)).astype(np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_features, weight) of each row: the weight sums the gains of all its features."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column(1)):
                w = text_words(batch.column(1).slice(lo, hi - lo))
                n = np.diff(w.first)
                at = np.zeros(len(w.lengths), dtype=np.int64)
                for bucket, there in features(w):
                    at[:len(bucket)] += np.where(there, gain[bucket], 0)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(n), pa.array(n + np.maximum(n - 1, 0) + np.maximum(n - 2, 0)),
                     pa.array(per_row(at, w.first))], names=["doc_id", "n_words", "n_features", "weight"])

    return (docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
            .mapInArrow(run, "doc_id long, n_words long, n_features long, weight long"))


def gumbel(key: Column, seed: int = SEED) -> Column:
    """floor(-1000 * ln(-ln(u))) with u from the first 32 bits of the SHA-256 of ``seed:key``; a null key hashes as empty."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def resample(docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text",
             percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of each row; rank is null where the row is not drawn.

    Of the N rows with at least ``min_words`` words, the floor(percent * N / 100) with the highest scores are drawn:
    score = weight + Gumbel noise of the id, which samples without replacement in proportion to exp(weight / 1000).
    Ties go to the smaller id, null last, then to fewer features; rows equal in these too differ in no column here.
    Null and empty texts have no features, weight 0, and are never drawn; an empty table or target is no special case.
    Only ``key`` and ``text`` of ``docs`` are read; to get the drawn rows see ``drawn``.

    Two passes over the texts: counts (10,000 numbers reach the driver and go back to the tasks), then weights.  What is
    sorted has 40 bytes a row.
    """
    gain = gains(bucket_counts(docs, text), bucket_counts(target, target_text))
    scored = pin(weigh(docs, gain, key, text)
                 .withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed)), "importance")
    enough = F.col("n_words") >= min_words
    some = scored.filter(enough)
    quota = some.count() * percent // 100
    order = radix_ranks(some.withColumn("loom_down", F.bitwise_not("score")), ["loom_down", "doc_id", "n_features"])
    picked = order.drop("loom_down").withColumn("rank", F.when(F.col("rank") <= quota, F.col("rank")))
    return picked.unionByName(scored.filter(~enough).withColumn("rank", F.lit(None).cast("long")))


def drawn(docs: DataFrame, report: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows of ``docs``, all columns, whose id was drawn (rows that repeat a drawn id come all)."""
    ids = pin(report.filter(F.col("rank").isNotNull()).select(F.col("doc_id").alias("loom_drawn")).distinct(), "drawn")
    return docs.join(ids, docs[key].eqNullSafe(ids["loom_drawn"]), "left_semi")

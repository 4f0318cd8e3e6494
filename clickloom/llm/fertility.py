"""Quality rules: repetition counts and the fertility of public vocabularies.

Per document two public vocabularies measure characters per token, tokens per word, the share of byte
fallbacks (pieces that stand for single bytes) and token entropy.  Documents are
compared with those of their language and length: a band around the
median of all documents there decides.  Where these are few, with those of the language; where there is no language or
its documents are few, with those of the script.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType
from pyspark.sql.window import Window

from clickloom.llm.columns import shield
from clickloom.llm.text import (
    NEWLINE,
    WHITE,
    Words,
    buffers,
    mix64,
    per_row,
    shingles,
    slices,
    span_hashes,
    word_hashes,
    words,
)
from clickloom.llm.vocabularies import LETTER, spread
from clickloom.session import pin

SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
REPEAT = 5          # words in a repeated window
KEPT = 300_000      # words whose tokens a worker keeps between batches
KEPT_BYTES = 16 << 20   # and their bytes, where words are long
RUN = 100_000       # white space in a row that the tokenizer's search for pieces is given; it has no stack for a million
WIDE_RUN = re.compile(r"[ \u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,}" % RUN)
AT_ONCE = 1 << 20   # bytes of texts measured at once: numpy holds some fifty times as many meanwhile

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MEASURES = ["chars_per_token", "chars_per_piece", "tokens_per_word", "pieces_per_token", "fallback_share", "entropy"]
#: which side of its band rejects a document
SIDES = {m: "both" for m in MEASURES} | {"fallback_share": "above", "entropy": "below"}

WIDTH = 4.0         # half width of a band in standard deviations
WIDER = {"pieces_per_token": 1.5}
SHORT_WORDS, SHORT_WIDER = 64, 1.5      # texts under so many words vary more among those of their length
USUAL_WORDS = 256   # and texts shorter than this vary more than the language or script as a whole, by the root of the ratio
LEAST = 0.05        # least half width, as a share of the median
ENOUGH = 100        # documents that a band of a language needs
ENOUGH_SCRIPT = 20  # documents that a band of a script needs
GRAIN = 1000        # bins of a unit

#: Scripts told apart by the first byte of a character outside ASCII; 0 has no say.
SCRIPTS = ["none", "latin", "greek", "cyrillic", "hebrew", "arabic", "indic", "other", "han", "hangul"]
SCRIPT_OF = np.zeros(256, dtype=np.int64)
for _code, _bytes in ((1, range(0xC3, 0xCB)), (2, range(0xCD, 0xD0)), (3, range(0xD0, 0xD5)), (4, range(0xD6, 0xD8)),
                      (5, range(0xD8, 0xDC)), (6, [0xE0]), (7, [0xE1]), (8, range(0xE3, 0xEA)), (9, range(0xEA, 0xEE))):
    SCRIPT_OF[list(_bytes)] = _code


def twice(value: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Which entries occur twice or more in their row."""
    key = mix64(value + (row.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key)
    same = key[order[1:]] == key[order[:-1]]
    out = np.zeros(len(key), dtype=bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def base_counts(data: np.ndarray, offsets: np.ndarray, w: Words) -> dict[str, np.ndarray]:
    rows = len(offsets) - 1
    n = np.diff(w.first)
    lead = (data & 0xC0) != 0x80
    chars = per_row(lead & ~WHITE[data], offsets)
    symbols = per_row(SYMBOLS[data], offsets)
    # lines: cut after each line feed and at row ends
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    edge[1:][data == NEWLINE] = True
    cut = np.flatnonzero(edge)
    lengths = np.diff(cut)
    ends_in_feed = data[cut[1:] - 1] == NEWLINE if len(lengths) else np.zeros(0, dtype=bool)
    line_row = np.searchsorted(offsets, cut[:-1], side="right") - 1
    has_word = np.diff(np.searchsorted(w.starts, cut)) > 0
    content = lengths - ends_in_feed
    keep = np.flatnonzero(has_word)
    flat = data[spread(cut[:-1][keep], content[keep])]
    hashes = span_hashes(flat, content[keep])
    key = mix64(hashes + (line_row[keep].astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
    _, first = np.unique(key, return_index=True)
    later = np.ones(len(key), dtype=bool)
    later[first] = False
    dup = np.bincount(line_row[keep][later], minlength=rows)
    # words inside windows that occur twice
    value, row, place = shingles(w, word_hashes(w), REPEAT)
    full = n[row] >= REPEAT
    value, row, place = value[full], row[full], place[full]
    marks = np.zeros(len(w.lengths) + 1, dtype=np.int64)
    hit = place[twice(value, row)]
    np.add.at(marks, hit, 1)
    np.add.at(marks, hit + REPEAT, -1)
    covered = np.cumsum(marks[:-1]) > 0
    return {"n_words": n, "word_chars": chars, "n_symbols": symbols, "n_dup_lines": dup,
            "n_repeat_words": per_row(covered, w.first)}


def scripts(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """The script of most letters of each row; the first of equals, ``none`` without a letter."""
    rows = len(offsets) - 1
    some = np.flatnonzero(SCRIPT_OF[data])
    row = np.searchsorted(offsets, some, side="right") - 1
    found = np.bincount(row * len(SCRIPTS) + SCRIPT_OF[data[some]], minlength=rows * len(SCRIPTS)).reshape(rows, len(SCRIPTS))
    found[:, 1] += per_row(LETTER[data], offsets)
    return pa.array([SCRIPTS[i] for i in found.argmax(axis=1)], type=pa.string())


class Vocabularies:
    """Tokens of words under a byte-level vocabulary (ranks) and a piece vocabulary with byte fallback."""

    def __init__(self, ranks_path: str, pieces_path: str):
        import public_tokenizers
        import sentencepiece
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.ranks = tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.feed = ranks[b"\n"]
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=pieces_path)
        self.is_byte = np.array([self.pieces.is_byte(i) for i in range(self.pieces.get_piece_size())], dtype=bool)
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.held = 0
        self.flat, self.used = np.zeros(1 << 16, dtype=np.uint32), 0
        self.ends = np.zeros(1, dtype=np.int64)
        self.n_pieces, self.n_bytes = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

    def _encoded(self, text: str) -> np.ndarray:
        """Ranks of one text.  A long run of white space is cut out: it is one piece, but for its last character where a visible one follows."""
        ids, at = [], 0
        for run in WIDE_RUN.finditer(text) if len(text) >= RUN else ():
            end = run.end() - (run.end() < len(text))
            ids += [self.ranks.encode_ordinary(text[at:run.start()]), self.ranks._encode_single_piece(text[run.start():end])]
            at = end
        return np.fromiter(chain(*ids, self.ranks.encode_ordinary(text[at:])), dtype=np.uint32)

    def _ranks_of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ranks of the words, each after a space, and their numbers; many are encoded at once, line feeds between them."""
        ids, counts = [], []
        for lo in range(0, len(texts), 500):
            some = texts[lo:lo + 500]
            if sum(map(len, some)) < RUN:
                found = np.array(self.ranks.encode_ordinary(" " + "\n ".join(some)), dtype=np.uint32)
                ends = np.flatnonzero(found == self.feed)
                if len(ends) == len(some) - 1:
                    ids.append(np.delete(found, ends))
                    counts.append(np.diff(np.concatenate(([-1], ends, [len(found)]))) - 1)
                    continue
            # long words, or one that ends in some other white space
            apart = [self._encoded(" " + t) for t in some]
            ids += apart
            counts.append(np.array([len(x) for x in apart]))
        return np.concatenate(ids), np.concatenate(counts)

    def of(self, distinct: list[bytes]) -> np.ndarray:
        """Place of each word in the tables."""
        if len(self.known) > KEPT or self.held > KEPT_BYTES:
            self.forget()
        missing = [word for word in distinct if word not in self.known]
        if missing:
            texts = [word.decode(errors="replace") for word in missing]
            ids, counts = self._ranks_of(texts)
            pieces = self.pieces.encode(texts, num_threads=1)
            many = np.array([len(p) for p in pieces])
            fallback = self.is_byte[np.fromiter(chain.from_iterable(pieces), dtype=np.int64, count=int(many.sum()))]
            self.known.update(zip(missing, range(len(self.ends) - 1, len(self.ends) - 1 + len(missing))))
            self.held += sum(map(len, missing))
            self.ends = np.concatenate((self.ends, self.ends[-1] + np.cumsum(counts)))
            self.n_pieces = np.concatenate((self.n_pieces, many))
            self.n_bytes = np.concatenate((self.n_bytes, np.bincount(
                np.repeat(np.arange(len(many)), many), weights=fallback, minlength=len(many)).astype(np.int64)))
            if self.used + len(ids) > len(self.flat):
                self.flat = np.concatenate((self.flat[:self.used], np.zeros(self.used + 2 * len(ids), dtype=np.uint32)))
            self.flat[self.used:self.used + len(ids)] = ids
            self.used += len(ids)
        return np.fromiter((self.known[word] for word in distinct), dtype=np.int64, count=len(distinct))


@lru_cache(maxsize=2)
def vocabularies(ranks_path: str, pieces_path: str) -> Vocabularies:
    return Vocabularies(ranks_path, pieces_path)


def fertility(w: Words, chars: np.ndarray, vocab: Vocabularies) -> dict[str, np.ndarray]:
    """The measures of each row; a row without words has null (nan) measures."""
    rows = len(w.first) - 1
    ends = np.concatenate(([0], np.cumsum(w.lengths))).astype(np.int64)
    column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(w.lengths), [
        None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(w.data))])
    coded = pc.dictionary_encode(column)
    place = vocab.of(coded.dictionary.to_pylist())
    which = place[coded.indices.to_numpy(zero_copy_only=False)] if len(place) else place
    n_ids = vocab.ends[which + 1] - vocab.ends[which]
    tokens = per_row(n_ids, w.first)
    pieces = per_row(vocab.n_pieces[which], w.first)
    fallbacks = per_row(vocab.n_bytes[which], w.first)
    ids = vocab.flat[spread(vocab.ends[which], n_ids)].astype(np.int64)
    key = np.sort((np.repeat(np.arange(rows, dtype=np.int64), tokens) << 32) | ids)
    starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, dtype=np.int64)
    many = np.diff(np.concatenate((starts, [len(key)]))).astype(float)
    row = (key[starts] >> 32).astype(np.int64)
    weighted = np.bincount(row, weights=many * np.log2(many), minlength=rows) if len(row) else np.zeros(rows)
    with np.errstate(divide="ignore", invalid="ignore"):
        entropy = np.log2(tokens) - weighted / tokens
        return {"chars_per_token": chars / tokens, "chars_per_piece": chars / pieces,
                "tokens_per_word": tokens / np.diff(w.first), "pieces_per_token": pieces / tokens, "fallback_share": fallbacks / pieces, "entropy": entropy}


def measured(batches: Iterator[pa.RecordBatch], at: int, vocab: Vocabularies) -> Iterator[pa.RecordBatch]:
    """The rows with the counts, script and measures of the texts in column ``at``, at most ``AT_ONCE`` bytes of texts or one row at a time."""
    for batch in batches:
        for lo, hi in slices(batch.column(at), AT_ONCE):
            part = batch.slice(lo, hi - lo)
            data, offsets = buffers(part.column(at))
            w = words(data, offsets)
            counts = base_counts(data, offsets, w)
            measures = fertility(w, counts["word_chars"], vocab)
            empty = counts["n_words"] == 0
            yield pa.RecordBatch.from_arrays(
                [*part.columns, *[pa.array(counts[c], type=pa.int64()) for c in COUNTS],
                 scripts(data, offsets), *[pa.array(measures[c], type=pa.float64(), mask=empty) for c in MEASURES]],
                names=[*batch.schema.names, *COUNTS, "script", *MEASURES])


def measure(df: DataFrame, ranks_path: str, pieces_path: str, text: str = "text") -> DataFrame:
    """Append the counts, the script and the measures of every whole text to the rows of ``df`` (columns of those names are replaced).

    A null or empty text has counts 0 and null measures.  Bytes that are not UTF-8 are measured as replacement characters.
    """
    own = [c for c in df.columns if c not in [*COUNTS, "script", *MEASURES]]
    df = df.select(*own)
    at = own.index(text)
    schema = StructType([*df.schema.fields, *[StructField(c, LongType()) for c in COUNTS],
                         StructField("script", StringType()), *[StructField(c, DoubleType()) for c in MEASURES]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return measured(batches, at, vocabularies(ranks_path, pieces_path))

    return df.mapInArrow(run, schema)


def base_failed(least_words: int = 10, most_repeated: int = 20) -> Column:
    return (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > most_repeated * F.col("n_words"))


def _levels(group: str) -> list[tuple[Column, int]]:
    """The groups a document is compared with, the closest first, and the documents each needs.

    A key is null where there is no such group: a null language (an empty one is a language of its own) is compared by script only.
    """
    lang = F.col(group).cast("string")
    length = F.floor(F.log2(F.col("n_words")) / 2).cast("string")        # a factor of four in length
    return [(F.concat(F.lit("length "), length, F.lit(" of "), lang), ENOUGH), (F.concat(F.lit("all of "), lang), ENOUGH),
            (F.concat(F.lit("script "), F.col("script")), ENOUGH_SCRIPT)]


def bands(measured: DataFrame, group: str = "lang", enough: int | None = None) -> DataFrame:
    """Written table (_key, _<measure>: (mid, mad)): the median of each measure, and the median distance from it, in each group
    of ``_levels`` that has enough documents (``enough`` for all levels where given).  Counted are documents that pass the base rules,
    those equal in all measures once, so that copies do not narrow a band.

    The measures are counted in bins of a thousandth, so that what is shuffled and windowed are bins, not documents.
    """
    levels = _levels(group)
    keys = F.array(*[F.struct(key.alias("_key"), F.lit(n if enough is None else enough).alias("_enough")) for key, n in levels])
    cells = [F.round(F.col(m) * GRAIN).cast("long").alias(m) for m in MEASURES]
    good = measured.filter(~base_failed()).select(F.filter(keys, lambda k: k["_key"].isNotNull()).alias("_keys"), "n_words", *cells)
    each = good.distinct().select("_keys", F.inline(F.array(*[
        F.struct(F.lit(m).alias("measure"), F.col(m).alias("bin")) for m in MEASURES])))
    small = each.groupBy("_keys", "measure", "bin").agg(F.count("*").alias("_n"))
    bins = pin(small.select(F.inline("_keys"), "measure", "bin", "_n").groupBy("_key", "_enough", "measure", "bin")
               .agg(F.sum("_n").alias("n")), "fertility-bins")
    by = ["_key", "_enough", "measure"]

    def median(table: DataFrame, value: str, name: str) -> DataFrame:
        """The lowest value with at least half of the rows at or below it."""
        whole = Window.partitionBy(*by)
        upto = whole.orderBy(value)
        return (table.withColumn("_upto", F.sum("n").over(upto)).withColumn("_all", F.sum("n").over(whole))
                .filter((2 * F.col("_upto") >= F.col("_all")) & (F.col("_all") >= F.col("_enough")))
                .groupBy(*by).agg(F.min(value).alias(name)))

    middle = median(bins, "bin", "mid")
    away = bins.join(middle, by).withColumn("_away", F.abs(F.col("bin") - F.col("mid")))
    out = middle.join(median(away, "_away", "mad"), by).withColumns({"mid": F.col("mid") / GRAIN, "mad": F.col("mad") / GRAIN})
    wide = out.groupBy("_key").agg(*[F.max(F.when(F.col("measure") == m, F.struct("mid", "mad"))).alias(f"_{m}") for m in MEASURES])
    return pin(wide, "fertility-bands")


def half_width(measure: str) -> Column:
    """``WIDTH`` standard deviations (1.4826 times the median distance is one), wider for short texts, ``LEAST`` of the median at least."""
    short = F.when(F.col("n_words") < SHORT_WORDS, SHORT_WIDER).otherwise(1.0)
    # Spark may compute this for rows without words too, though nothing asks for it there
    rare = F.greatest(F.lit(1.0), F.sqrt(F.lit(float(USUAL_WORDS)) / F.greatest(F.col("n_words"), F.lit(1))))
    width = F.when(F.col("_level") == 0, short).otherwise(rare) * (WIDTH * WIDER.get(measure, 1.0) * 1.4826)
    least = F.lit(0.05) if measure == "fallback_share" else F.col("_band")[f"_{measure}"]["mid"] * LEAST
    return F.greatest(F.col("_band")[f"_{measure}"]["mad"] * width, least)


def verdict(measured: DataFrame, ranges: DataFrame, group: str = "lang") -> DataFrame:
    """Add ``base_failed`` and ``kept``: a document is kept if it passes the base rules and no measure leaves the band of the closest
    group of ``_levels`` that has one.  A document without such a group is judged by the base rules alone.
    """
    measured, back = shield(measured, [*COUNTS, "script", *MEASURES, group])
    joined, found = measured, []
    for i, (key, _) in enumerate(_levels(group)):
        table = ranges.select(F.col("_key").alias(f"_of{i}"), F.struct(*[f"_{m}" for m in MEASURES]).alias(f"_band{i}"))
        joined = joined.withColumn(f"_is{i}", key).join(table, F.col(f"_is{i}") == F.col(f"_of{i}"), "left")
        found.append(f"_band{i}")
    level = F.coalesce(*[F.when(F.col(c).isNotNull(), i) for i, c in enumerate(found)])
    joined = joined.withColumns({"_band": F.coalesce(*found), "_level": level})
    outside = F.lit(False)
    for m in MEASURES:
        off = F.col(m) - F.col("_band")[f"_{m}"]["mid"]
        off = {"both": F.abs(off), "above": off, "below": -off}[SIDES[m]]
        outside = outside | F.coalesce(off > half_width(m), F.lit(False))
    failed = base_failed()
    out = joined.select(*measured.columns, failed.alias("base_failed"), (~failed & ~outside).alias("kept"))
    return back(out, ["base_failed", "kept"])

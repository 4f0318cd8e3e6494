"""Public tokenizers inside tasks, with each distinct stretch of text encoded once per batch.

A byte-level tokenizer splits text before it merges bytes.  A single space between two
visible characters always begins a new part there, and a single line feed between two is
a part.  So a text may be cut at those places: its ids are the ids of the parts, one after another.  ``pyarrow`` finds the
distinct parts exactly (by their bytes), and only those go through the tokenizer.
"""

from __future__ import annotations

import json
import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from clickloom.llm.text import WHITE

KEPT = 1_000_000        # parts whose ids a worker keeps between batches

LETTER = np.zeros(256, dtype=bool)
LETTER[[*range(65, 91), *range(97, 123)]] = True
#: ASCII marks that end a word; an apostrophe may belong to what follows
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def default_path(name: str) -> str:
    """Where the installed public tokenizers keep a file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def cuts(data: np.ndarray, offsets: np.ndarray, marks: np.ndarray | None = None) -> np.ndarray:
    """Starts of the parts: row starts, single spaces, and single line feeds and what follows them, where a
    visible character stands on either side; also ``marks`` (a table of bytes) right after a letter of ASCII or Latin-1.

    A byte that may belong to a white-space character of two or three bytes is not taken for visible,
    so fewer cuts are made, never wrong ones.
    """
    n = len(data)
    at = np.flatnonzero((data == 32) | (data == 10))
    at = at[(at > 1) & (at < n - 1)]
    last, second, third = data[at - 1], data[at - 2], data[np.maximum(at - 3, 0)]
    after = data[at + 1]

    def control(x):
        return WHITE[x] | ((x >= 0x1C) & (x <= 0x1F))

    maybe = (last >= 0x80) & (((second == 0xC2) & ((last == 0x85) | (last == 0xA0)))
                              | (third == 0xE1) | (third == 0xE2) | (third == 0xE3))
    next_maybe = (after == 0xC2) | ((after >= 0xE1) & (after <= 0xE3))
    at = at[~control(last) & ~maybe & ~control(after) & ~next_maybe]
    start = np.zeros(n + 1, dtype=bool)
    start[offsets] = True
    start[at] = True
    start[at[data[at] == 10] + 1] = True
    if marks is not None:
        at = np.flatnonzero(marks[data])
        at = at[at > 1]
        last = data[at - 1]
        latin = (data[at - 2] == 0xC3) & (last >= 0x80) & (last != 0x97) & (last != 0xB7)
        start[at[LETTER[last] | latin]] = True
    return np.flatnonzero(start[:n])


def _latin_word(text: str) -> bool:
    """A word of Latin letters, maybe after one space: a part that the tokenizer does not split further."""
    word = text[1:] if text[:1] == " " else text
    return word.isalpha() and (word.isascii() or max(word) < "\u0250")


class ByteTokenizer:
    """Ids of whole texts by the tokenizers library."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.bits = max(1, int(self.tokenizer.get_vocab_size() - 1).bit_length())
        feed = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.feed = feed[0] if len(feed) == 1 else None
        spec = json.loads(self.tokenizer.to_str())
        before = spec["pre_tokenizer"] or {}
        #: whether words of letters can go to the library's merges without its search for words
        added = {c for token in spec["added_tokens"] for c in token["content"]}
        self.plain = (spec["normalizer"] is None and before.get("type") == "ByteLevel" and before.get("use_regex", True)
                      and not before.get("add_prefix_space") and not added & {" ", "\n"})
        self.marks = None
        if self.plain:
            self.marks = np.zeros(256, dtype=bool)
            self.marks[[ord(c) for c in MARKS if c not in added]] = True
        self.merges = Tokenizer(self.tokenizer.model)
        self.merges.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.Split("\n", "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.flat, self.used = np.zeros(1 << 16, dtype=np.uint32), 0
        self.ends = np.zeros(1, dtype=np.int64)

    def _joined(self, tokenizer, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids and numbers of ids of parts without line feeds: a hundred at once, joined by line feeds whose id marks the ends."""
        ids, counts = [], []
        for lo in range(0, len(texts), 100):
            some = texts[lo:lo + 100]
            found = np.array(tokenizer.encode("\n".join(some), add_special_tokens=False).ids, dtype=np.uint32)
            ends = np.flatnonzero(found == self.feed)
            if len(ends) != len(some) - 1:
                raise ValueError("line feeds are not encoded on their own")
            ids.append(np.delete(found, ends))
            counts.append(np.diff(np.concatenate(([-1], ends, [len(found)]))) - 1)
        return ids, counts

    def _learn(self, parts: list[bytes]) -> None:
        """Encode distinct parts and keep their ids."""
        words, others, single = [], [], []
        for part in parts:
            text = part.decode()
            if self.feed is None or "\n" in text or not text or text[-1].isspace() or text[text[0] == " "].isspace():
                single.append((part, text))
            elif self.plain and _latin_word(text):
                words.append((part, text))
            else:
                others.append((part, text))
        ids, counts = [], []
        for tokenizer, some in ((self.merges, words), (self.tokenizer, others)):
            found = self._joined(tokenizer, [text for _, text in some])
            ids += found[0]
            counts += found[1]
        for _, text in single:
            found = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
            ids.append(found)
            counts.append(np.array([len(found)]))
        if not parts:
            return
        for at, (part, _) in enumerate([*words, *others, *single], len(self.ends) - 1):
            self.known[part] = at
        ids, counts = np.concatenate(ids), np.concatenate(counts)
        self.ends = np.concatenate((self.ends, self.ends[-1] + np.cumsum(counts)))
        if self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate((self.flat[:self.used], np.zeros(self.used + 2 * len(ids), dtype=np.uint32)))
        self.flat[self.used:self.used + len(ids)] = ids
        self.used += len(ids)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows, one after another, and the number of ids of each row."""
        rows = len(offsets) - 1
        if not len(data):
            return np.zeros(0, dtype=np.uint32), np.zeros(rows, dtype=np.int64)
        starts = cuts(data, offsets, self.marks)
        ends = np.concatenate((starts, [len(data)])).astype(np.int64)
        parts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [
            None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))])
        coded = pc.dictionary_encode(parts)
        distinct = coded.dictionary.to_pylist()
        if len(self.known) > KEPT:
            self.forget()
        self._learn([part for part in distinct if part not in self.known])
        place = np.fromiter((self.known[part] for part in distinct), dtype=np.int64, count=len(distinct))
        which = place[coded.indices.to_numpy(zero_copy_only=False)]
        many = self.ends[which + 1] - self.ends[which]
        ids = self.flat[spread(self.ends[which], many)]
        ids_before = np.concatenate(([0], np.cumsum(many)))
        of_row = ids_before[np.searchsorted(starts, offsets)]
        return ids, np.diff(of_row)


def spread(first: np.ndarray, many: np.ndarray) -> np.ndarray:
    """``first[i], first[i] + 1, ...`` for ``many[i]`` places each."""
    total = int(many.sum())
    begin = np.cumsum(many) - many
    return np.arange(total, dtype=np.int64) + np.repeat(first - begin, many)


@lru_cache(maxsize=2)
def byte_tokenizer(path: str) -> ByteTokenizer:
    return ByteTokenizer(path)

"""Token ids in the fewest bits the vocabulary allows, in blocks with offsets.

A file: the 8 bytes ``LOOMBITS``; the blocks; one table each of 64-bit values for block
offsets, document ids, null marks and id counts; a footer of six 64-bit
values (bits, ids per block, number of ids, of blocks, of documents, start of the tables).  All values
are little-endian.  Block b holds ids ``b * per_block`` on, packed from the lowest bit of its
first byte, so any id is found from its number alone and a block unpacks in a few numpy calls.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clickloom.llm.files import attempt_name, folder, opened
from clickloom.llm.text import buffers, slices
from clickloom.llm.vocabularies import byte_tokenizer
from clickloom.session import pin

MAGIC = b"LOOMBITS"
PER_BLOCK = 1 << 16
UNIT_IDS = 1 << 22


def pack(ids: np.ndarray, bits: int) -> bytes:
    """``bits`` bits per id, lowest first."""
    ids = np.asarray(ids, dtype=np.uint32)
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    spread = (ids[:, None] >> np.arange(bits, dtype=np.uint32)) & np.uint32(1)
    return np.packbits(spread.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(data: bytes, n: int, bits: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, dtype=f"<u{bits // 8}", count=n).astype(np.uint32)
    flat = np.unpackbits(np.frombuffer(data, dtype=np.uint8), count=n * bits, bitorder="little").reshape(n, bits)
    return (flat.astype(np.uint32) << np.arange(bits, dtype=np.uint32)).sum(axis=1, dtype=np.uint32)


class Writer:
    """Streams ids into one file; at most one block is held."""

    def __init__(self, out, bits: int, per_block: int = PER_BLOCK):
        self.out, self.bits, self.per_block = out, bits, per_block
        self.at, self.ids, self.held, self.held_ids = len(MAGIC), 0, [], 0
        self.blocks: list[int] = []
        self.docs: list[np.ndarray] = []
        out.write(MAGIC)

    def _block(self, ids: np.ndarray) -> None:
        data = pack(ids, self.bits)
        self.blocks.append(self.at)
        self.out.write(data)
        self.at += len(data)

    def add(self, doc_ids: np.ndarray, nulls: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> None:
        self.docs.append(np.stack((doc_ids, nulls.astype(np.int64), counts)).astype("<i8"))
        self.ids += len(ids)
        self.held.append(ids)
        self.held_ids += len(ids)
        if self.held_ids >= self.per_block:
            ids = np.concatenate(self.held)
            full = len(ids) - len(ids) % self.per_block
            for lo in range(0, full, self.per_block):
                self._block(ids[lo:lo + self.per_block])
            self.held, self.held_ids = [ids[full:]], len(ids) - full

    def close(self) -> None:
        if self.held_ids:
            self._block(np.concatenate(self.held))
        docs = np.concatenate(self.docs, axis=1) if self.docs else np.zeros((3, 0), dtype="<i8")
        self.out.write(np.array(self.blocks, dtype="<i8").tobytes() + np.ascontiguousarray(docs).tobytes())
        self.out.write(np.array([self.bits, self.per_block, self.ids, len(self.blocks), docs.shape[1], self.at],
                                dtype="<i8").tobytes())
        self.out.close()


class Reader:
    """Random access to documents and ids of one file."""

    def __init__(self, path: str):
        filesystem, inside = opened(path)
        self.file = filesystem.open_input_file(inside)
        size = self.file.size()
        if self.file.read_at(len(MAGIC), 0) != MAGIC:
            raise ValueError(f"{path} is not a packed id file")
        foot = np.frombuffer(self.file.read_at(48, size - 48), dtype="<i8")
        self.bits, self.per_block, self.n_ids, self.n_blocks, self.n_docs, self.tables = (int(x) for x in foot)

    def _table(self, first: int, n: int) -> np.ndarray:
        return np.frombuffer(self.file.read_at(8 * n, self.tables + 8 * first), dtype="<i8")

    def docs(self, first: int, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Document ids, null marks and id counts of documents ``first`` on."""
        return tuple(self._table(self.n_blocks + part * self.n_docs + first, n) for part in range(3))

    def ids(self, first: int, n: int) -> np.ndarray:
        """Ids ``first`` to ``first + n - 1``: only their blocks are read."""
        if n <= 0:
            return np.zeros(0, dtype=np.uint32)
        b0, b1 = first // self.per_block, (first + n - 1) // self.per_block
        starts = self._table(b0, b1 - b0 + 1)
        out = []
        for b, at in zip(range(b0, b1 + 1), starts):
            here = min(self.per_block, self.n_ids - b * self.per_block)
            out.append(unpack(self.file.read_at((here * self.bits + 7) // 8, int(at)), here, self.bits))
        ids = np.concatenate(out)
        skip = first - b0 * self.per_block
        return ids[skip:skip + n]

    def close(self) -> None:
        self.file.close()


MANIFEST = "part int, path string, unit int, first_doc long, docs long, first_id long, ids long"


def write_ids(df: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", end_id: int | None = 2,
              name: str = "packed", per_block: int = PER_BLOCK, unit_ids: int = UNIT_IDS) -> DataFrame:
    """Encode whole texts and write them in ascending order of ``key`` (an integer), one file per task.

    Returns the written list of the files in units of about ``unit_ids`` ids, to be read on their own.  Null texts count as empty; a null key
    comes first; rows of equal keys are in the order of the md5 of their texts and are spread over files by it (rows equal in both are the
    same); other columns are ignored.  A file counts only when its task has ended and stands in the list, so lost attempts do no harm.
    """
    root = folder(df.sparkSession, name)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = byte_tokenizer(tokenizer)
        part = TaskContext.get().partitionId()
        path = f"{root}/{attempt_name(part, '.ids')}"
        writer, units, doc, unit = None, [], 0, [0, 0]
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                filesystem, inside = opened(path)
                writer = Writer(filesystem.open_output_stream(inside, compression=None), tok.bits, per_block)
            for lo, hi in slices(batch.column(1), 8 << 20):
                data, offsets = buffers(batch.column(1).slice(lo, hi - lo))
                ids, counts = tok.encode(data, offsets)
                if end_id is not None:
                    ids = np.insert(ids, np.cumsum(counts), np.uint32(end_id))
                    counts = counts + 1
                keys = batch.column(0).slice(lo, hi - lo)
                nulls = keys.is_null().to_numpy(zero_copy_only=False)
                writer.add(keys.fill_null(0).to_numpy(), nulls, counts, ids)
                doc += hi - lo
                if writer.ids - unit[1] >= unit_ids:
                    units.append((part, path, len(units), unit[0], doc - unit[0], unit[1], writer.ids - unit[1]))
                    unit = [doc, writer.ids]
        if writer is not None:
            if doc > unit[0]:
                units.append((part, path, len(units), unit[0], doc - unit[0], unit[1], writer.ids - unit[1]))
            writer.close()
        types = [pa.int32(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
        names = ["part", "path", "unit", "first_doc", "docs", "first_id", "ids"]
        yield pa.RecordBatch.from_arrays(
            [pa.array([u[i] for u in units], type=t) for i, t in enumerate(types)], names=names)

    tie = F.unhex(F.md5(F.coalesce(F.col(text), F.lit(""))))
    ordered = (df.select(F.col(key).cast("long").alias("_key"), F.col(text).alias("_text"), tie.alias("_tie"))
               .repartitionByRange("_key", "_tie").sortWithinPartitions("_key", "_tie").select("_key", "_text"))
    return pin(ordered.mapInArrow(write, MANIFEST), f"{name}-files")


def read_ids(files: DataFrame) -> DataFrame:
    """Read the listed files back: doc_id, start (ids before the document over all files), n_tokens, ids_crc32."""
    run = Window.orderBy("part", "unit").rowsBetween(Window.unboundedPreceding, -1)   # one row per unit of millions of ids
    units = files.withColumn("start", F.coalesce(F.sum("ids").over(run), F.lit(0)).cast("long"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for unit in batch.to_pylist():
                reader = Reader(unit["path"])
                try:
                    doc_ids, nulls, counts = reader.docs(unit["first_doc"], unit["docs"])
                    ids = reader.ids(unit["first_id"], unit["ids"]).astype("<u4")
                finally:
                    reader.close()
                ends = np.cumsum(counts)
                starts = ends - counts
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays([
                    pa.array(doc_ids, type=pa.int64(), mask=nulls.astype(bool)),
                    pa.array(starts + unit["start"], type=pa.int64()), pa.array(counts, type=pa.int64()),
                    pa.array(crc, type=pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    tasks = max(1, units.count())
    return (units.repartition(tasks, "path", "unit")
            .mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long"))

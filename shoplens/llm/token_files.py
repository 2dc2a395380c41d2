"""Token ids in binary shard files with Elias-Fano coded document boundaries.

A shard holds the ids of a run of documents in ascending doc_id order, in the narrowest width of the
vocabulary (2 or 4 bytes, little-endian), one after the other. Where documents end is a rising
sequence; each end is cut into low bits, kept as they are, and a high part, kept in unary in a bit
string: about 2 + log2(ids per document) bits a document. ``select`` finds the i-th set bit from a
sample of every 512th; no table of 64-bit offsets is kept.

File: room for a header, ids, low bits, high bits, doc_ids (8 bytes each; the first ``nulls``
documents have a null doc_id), then the magic and the fields of ``HEADER``.

Null or empty text: the end id alone. Rows with equal doc_ids are ordered by text and each keeps its
own ids. Extra columns are not written. An empty table writes no shard and reads as no rows.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.llm.tokens import encoder, with_end
from shoplens.llm.words import slices
from shoplens.sources.stages import stage_path, store

MAGIC, HEADER = b"EFTOKEN1", "<5Q"  # width, documents, ids, low bits each, nulls
HEAD = len(MAGIC) + struct.calcsize(HEADER)
SAMPLE, READ_IDS = 512, 1 << 20


class EliasFano:
    """A rising sequence of whole numbers in near-minimal space."""

    def __init__(self, low: np.ndarray, high: np.ndarray, bits: int, count: int):
        self.low, self.high, self.bits, self.count = low, high, bits, count
        # Set bits before each byte, kept for every SAMPLE-th set bit only.
        ones = np.cumsum(np.bitwise_count(high))
        self.sample = np.searchsorted(ones, np.arange(0, count, SAMPLE) + 1)
        self.before = np.where(self.sample > 0, ones[self.sample - 1], 0) if count else ones

    @staticmethod
    def width(count: int, limit: int) -> int:
        return max(0, (limit // count).bit_length() - 1) if count else 0

    @classmethod
    def encode(cls, values: np.ndarray, limit: int) -> EliasFano:
        """``values`` rise (equal ones are allowed) and are at most ``limit``."""
        values = np.asarray(values, dtype=np.uint64)
        bits = cls.width(len(values), limit)
        places = (values >> np.uint64(bits)).astype(np.int64) + np.arange(len(values))
        high = np.zeros(int(places[-1]) + 1 if len(values) else 0, dtype=np.uint8)
        high[places] = 1
        shifts = np.arange(bits, dtype=np.uint64)
        low = ((values[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).reshape(-1)
        return cls(
            np.packbits(low, bitorder="little"),
            np.packbits(high, bitorder="little"), bits, len(values),
        )

    def select(self, i: int) -> int:
        """The i-th value."""
        block = i // SAMPLE
        at, left = int(self.sample[block]), i - int(self.before[block])
        while left >= (ones := int(self.high[at]).bit_count()):
            left -= ones
            at += 1
        byte = int(self.high[at])
        for _ in range(left):
            byte &= byte - 1
        place = 8 * at + (byte & -byte).bit_length() - 1
        return (place - i) << self.bits | self.lows(i, i + 1)[0]

    def lows(self, start: int, end: int) -> list[int]:
        if not self.bits:
            return [0] * (end - start)
        first, last = start * self.bits, end * self.bits
        cut = np.unpackbits(self.low[first // 8 : -(-last // 8)], bitorder="little")
        cut = cut[first % 8 :][: last - first].reshape(-1, self.bits).astype(np.int64)
        return (cut << np.arange(self.bits)).sum(axis=1).tolist()

    def block(self, start: int) -> list[int]:
        """The values from ``start``, a multiple of SAMPLE, up to the next one."""
        end = min(start + SAMPLE, self.count)
        at = int(self.sample[start // SAMPLE])
        stop = int(self.sample[end // SAMPLE]) + 1 if end < self.count else len(self.high)
        places = np.flatnonzero(np.unpackbits(self.high[at:stop], bitorder="little"))
        skip = start - int(self.before[start // SAMPLE])
        places = places[skip : skip + end - start] + 8 * at - np.arange(start, end)
        return ((places << self.bits) + np.array(self.lows(start, end))).tolist()


def filesystem(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder that all executors share, and the folder's place in it."""
    if path.startswith("file:"):
        path = "file://" + path.removeprefix("file:").removeprefix("//")
    return fs.FileSystem.from_uri(path)


def write_shards(docs: DataFrame, folder: str, path: str, end_id: int) -> DataFrame:
    """Shard files in ``folder``; a stored table of (shard, file, documents, ids) for each.

    A shard is one range of doc_ids, written as its texts come; a task that runs again writes the
    same file again, under its own name until it is whole.
    """
    shards = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    system, base = filesystem(folder)
    system.create_dir(base, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, context = encoder(path), TaskContext.get()
        width = 2 if max(model.size, end_id + 1) <= 1 << 16 else 4
        system, base = filesystem(folder)
        file = f"{base}/shard-{context.partitionId():06d}.tokens"
        draft = f"{base}/.draft-{context.taskAttemptId()}"
        doc_ids, lengths, nulls, total, out = [], [], 0, 0, None
        for part in slices(batches):
            if out is None:
                out = system.open_output_stream(draft)
                out.write(MAGIC + bytes(HEAD - len(MAGIC)))
            ids, starts = with_end(*model.texts(part.column("text")), end_id)
            out.write(ids.astype(f"<u{width}").tobytes())
            column = part.column("doc_id")
            nulls += column.null_count
            doc_ids.append(column.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8"))
            lengths.append(np.diff(starts))
            total += len(ids)
        if out is None:
            return
        ends = EliasFano.encode(np.cumsum(np.concatenate(lengths)), total)
        numbers = np.concatenate(doc_ids)
        for block in (ends.low, ends.high, numbers):
            out.write(block.tobytes())
        header = (width, len(numbers), total, ends.bits, nulls)
        out.write(MAGIC + struct.pack(HEADER, *header))  # the same at the end: streams can't seek
        out.close()
        if system.get_file_info(file).type != fs.FileType.NotFound:
            system.delete_file(file)
        system.move(draft, file)
        yield pa.RecordBatch.from_pylist(
            [{"shard": context.partitionId(), "file": file, "documents": len(numbers), "ids": total}]
        )

    # The hash parts rows that share a doc_id, or have none, over several shards.
    order = F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.length("text")
    ordered = docs.select("doc_id", "text").repartitionByRange(shards, *order[:2]).sortWithinPartitions(*order)
    schema = "shard bigint, file string, documents bigint, ids bigint"
    return store(ordered.mapInArrow(write, schema), "token-shards")


class Shard:
    """One file: its boundaries in memory, its ids read as asked for."""

    def __init__(self, system: fs.FileSystem, file: str):
        self.file = system.open_input_file(file)
        size, head = self.file.size(), HEAD
        self.start = head
        tail = self.file.read_at(head, size - head)
        if tail[: len(MAGIC)] != MAGIC:
            raise ValueError(f"{file} is not a whole token file")
        self.width, self.documents, self.ids, bits, self.nulls = struct.unpack(HEADER, tail[len(MAGIC) :])
        first = head + self.ids * self.width
        rest = self.file.read_at(size - head - first, first)
        low_bytes, last = -(-self.documents * bits // 8), len(rest) - 8 * self.documents
        whole = np.frombuffer(rest, dtype=np.uint8)
        self.ends = EliasFano(whole[:low_bytes], whole[low_bytes:last], bits, self.documents)
        self.doc_ids = np.frombuffer(rest, dtype="<i8", offset=last)

    def offset(self, i: int) -> int:
        return self.ends.select(i - 1) if i else 0

    def read(self, start: int, end: int) -> np.ndarray:
        raw = self.file.read_at((end - start) * self.width, self.start + start * self.width)
        return np.frombuffer(raw, dtype=f"<u{self.width}").astype("<u4")

    def document(self, i: int) -> np.ndarray:
        return self.read(self.offset(i), self.ends.select(i))


def read_documents(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the checksum of the ids of every document in the files.

    ``start`` counts the ids of all documents before it, over all shards; the driver adds up one
    number per shard for that.
    """
    shards, before = [], 0
    for row in manifest.orderBy("shard").collect():
        shards.append((row.file, before))
        before += row.ids

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = filesystem(folder)
        for batch in batches:
            for file, base in zip(batch["file"].to_pylist(), batch["base"].to_pylist()):
                shard = Shard(system, file)
                begin = 0
                for block in range(0, shard.documents, SAMPLE):
                    ends = shard.ends.block(block)
                    starts = [begin, *ends[:-1]]
                    crcs = []
                    read_from, ids = begin, np.empty(0, dtype="<u4")
                    for start, end in zip(starts, ends):
                        if end > read_from + len(ids):
                            stop = max(end, min(start + READ_IDS, ends[-1]))
                            read_from, ids = start, shard.read(start, stop)
                        crcs.append(zlib.crc32(ids[start - read_from : end - read_from]))
                    begin = ends[-1]
                    numbers = shard.doc_ids[block : block + SAMPLE]
                    null = np.arange(block, block + len(numbers)) < shard.nulls
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(numbers, pa.int64(), mask=null),
                         pa.array(np.array(starts, np.int64) + base),
                         pa.array(np.diff([*starts, begin]), pa.int64()),
                         pa.array(crcs, pa.int64())],
                        ["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    listed = spark.createDataFrame(shards, "file string, base bigint")
    return listed.repartition(max(1, len(shards))).mapInArrow(
        read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    )


def round_trip(docs: DataFrame, path: str, end_id: int = 1) -> DataFrame:
    """Write all documents to shard files in the shared folder and read them back."""
    spark = docs.sparkSession
    folder = stage_path(spark, "tokens")
    return read_documents(spark, folder, write_shards(docs, folder, path, end_id))

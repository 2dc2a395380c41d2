"""CSV files with line ends inside quotes, read by many tasks.

Whether a line end closes a record depends on all quotes before it, so a file cannot be cut blindly. One pass counts
the quotes of each block; the running parity of these counts tells for every block whether it begins
inside a quoted field. A second pass then reads each block from its first true record start to the end of its
last record, and Spark parses the records. A doubled quote counts twice, so it leaves the parity as it is.

The driver holds a file name, a place and a count per block. Files are read in UTF-8 through Arrow's file systems;
compressed files, which cannot be cut, are left to Spark's own reader.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shoplens.sources.stages import _place

BLOCK, MORE = 16 << 20, 1 << 20
QUOTE, LINE_END = 0x22, 0x0A
COMPRESSED = (".gz", ".bz2", ".zst", ".snappy", ".lz4", ".deflate", ".xz")


def files_of(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Files and their sizes at a path: a file, a folder or a pattern; hidden ones are left out."""
    system, place = _place(spark, path)
    found = []
    waiting = list(system.globStatus(place) or [])
    if not waiting:
        raise FileNotFoundError(path)
    while waiting:
        status = waiting.pop()
        if status.isDirectory():
            waiting += [s for s in system.listStatus(status.getPath()) if not s.getPath().getName().startswith(("_", "."))]
        else:
            found.append((status.getPath().toString(), status.getLen()))
    return sorted(found)


def can_be_cut(files: list[tuple[str, int]]) -> bool:
    return not any(name.endswith(COMPRESSED) for name, _ in files)


def opened(name: str) -> pa.NativeFile:
    if name.startswith("file:"):
        name = "file://" + name.removeprefix("file:").removeprefix("//")
    system, place = fs.FileSystem.from_uri(name)
    return system.open_input_file(place)


def quotes_in(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The number of quotes of each block."""
    for batch in batches:
        counts = []
        for name, start, end in zip(*(batch.column(c).to_pylist() for c in ("file", "start", "stop"))):
            with opened(name) as file:
                raw = np.frombuffer(file.read_at(end - start, start), dtype=np.uint8)
            counts.append(int((raw == QUOTE).sum()))
        yield pa.RecordBatch.from_arrays(
            [batch.column("file"), batch.column("start"), pa.array(counts, pa.int64())], ["file", "start", "quotes"]
        )


def record_starts(raw: np.ndarray, inside: bool) -> np.ndarray:
    """Where a record begins after a line end outside quotes; ``inside``: the bytes begin within quotes."""
    open_quotes = (np.cumsum(raw == QUOTE) + inside) & 1
    return np.flatnonzero((raw == LINE_END) & (open_quotes == 0)) + 1


def block_records(file: pa.NativeFile, start: int, end: int, size: int, inside: bool) -> pa.Array:
    """The records whose first byte lies in the block, without their line ends."""
    data = file.read_at(end - start, start)
    raw = np.frombuffer(data, dtype=np.uint8)
    begins = record_starts(raw, inside)
    first = start == 0 or (not inside and file.read_at(1, start - 1) == b"\n")
    begins = np.concatenate([[0] if first else [], begins]).astype(np.int64)
    begins = begins[begins < len(raw)]
    if not len(begins):
        return pa.array([], pa.string())
    # The last record may end in a later block.
    after, parity = end, bool((inside + int((raw == QUOTE).sum())) & 1)
    parts = [data]
    finish = len(raw) if not parity and raw[-1] == LINE_END else None
    total = len(raw)
    while finish is None and after < size:
        more = file.read_at(min(MORE, size - after), after)
        found = record_starts(np.frombuffer(more, dtype=np.uint8), parity)
        parts.append(more)
        if len(found):
            finish = total + int(found[0])
        parity = bool((parity + more.count(b'"')) & 1)
        total, after = total + len(more), after + len(more)
    whole = b"".join(parts)
    bounds = np.append(begins, len(whole) if finish is None else finish)
    origin = int(bounds[0])
    text = pa.StringArray.from_buffers(
        len(begins), pa.py_buffer((bounds - origin).astype(np.int32).tobytes()), pa.py_buffer(whole[origin : int(bounds[-1])])
    )
    return pc.utf8_rtrim(text, "\r\n")


def records(spark: SparkSession, files: list[tuple[str, int]], block: int = BLOCK) -> DataFrame:
    """(record): every record of the files but their headers."""
    cuts = [
        (name, start, min(start + block, size), size) for name, size in files for start in range(0, size, block)
    ]
    listed = "file string, start bigint, stop bigint, size bigint"
    if not cuts:
        return spark.createDataFrame([], "record string")
    blocks = spark.createDataFrame(cuts, listed).repartition(len(cuts))
    counts = {
        (r.file, r.start): r.quotes
        for r in blocks.mapInArrow(quotes_in, "file string, start bigint, quotes bigint").collect()
    }
    placed, parity = [], 0
    for name, start, end, size in cuts:
        parity = 0 if start == 0 else parity
        placed.append((name, start, end, size, bool(parity & 1)))
        parity += counts[name, start]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with opened(row["file"]) as file:
                    found = block_records(file, row["start"], row["stop"], row["size"], row["inside"])
                if row["start"] == 0:
                    found = found[1:]  # the header
                yield pa.RecordBatch.from_arrays([found.filter(pc.not_equal(found, ""))], ["record"])

    rows = spark.createDataFrame(placed, f"{listed}, inside boolean").repartition(len(placed))
    return rows.mapInArrow(read, "record string")


def read_csv(
    spark: SparkSession, files: list[tuple[str, int]], schema: StructType, options: dict[str, str], block: int = BLOCK
) -> DataFrame:
    """The records of the files in the columns of ``schema``, parsed by Spark with its CSV ``options``."""
    parsed = F.from_csv("record", schema.toDDL(), {**options, "multiLine": "true"}).alias("r")
    return records(spark, files, block).select(parsed).select("r.*")

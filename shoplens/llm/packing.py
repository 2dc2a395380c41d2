"""Packing of token sequences by Karmarkar-Karp multiway differencing.

A document's ids, with an end id, are cut into full windows and a rest. The rests of a block are
split over k windows: every rest begins as a partial partition of its own; again and again the two
partial partitions with the widest spread are merged, the fullest window of one with the emptiest of
the other, so that opposing imbalances cancel and all windows end nearly equal. If one exceeds the
capacity, k rises by one and the block is split anew. A block closes when its rests fill ``FILL`` of
``windows`` windows, so near-equal windows are near-full ones, or when it has ``RESTS`` rests. Where more rests
are longer than half a window than windows are needed, half a window is cut off each of them.

Blocks are made and packed inside the tasks that tokenize: no text moves, and a task holds one block
of rests. Only the last block of a task may leave a window emptier.

Null or empty text: the end id alone. Equal sizes go by their order in the task. Repeated rows are packed each by itself; a null doc_id stays
null; extra columns stay out of the result; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm.tokens import encoder, with_end
from shoplens.llm.words import slices

FILL = 0.985
#: Bytes of text tokenized at a time (one text at least) and of the cache of words: a worker may have been
#: used by other stages before and keep some of their memory.
SLICE, WORDS = 2 << 20, 48 << 20
RESTS = 1 << 16  # rests of a block at most, so very short texts do not pile up
SCHEMA = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint"
)


def differencing(sizes: list[int], k: int) -> list[list[int]]:
    """``sizes`` (all above 0) split over k windows of nearly equal sums: the places of the items of each."""
    if k <= 1:
        return [list(range(len(sizes)))]
    following = [-1] * len(sizes)
    # A partial partition: its filled windows (sum, first item, last item), least sum first. The other
    # windows are empty, so an item that has not met another is one window, whatever k is.
    queue = [(-size, i, [(size, i, i)]) for i, size in enumerate(sizes)]
    heapq.heapify(queue)
    made = len(sizes)
    while len(queue) > 1:
        _, _, one = heapq.heappop(queue)
        _, _, two = heapq.heappop(queue)
        # The fullest windows of one meet the empty ones of the other; where both are filled, the least of
        # one meet the fullest of these.
        shared = max(len(one) + len(two) - k, 0)
        windows = one[shared:] + two[shared:]
        for (a, first, last), (b, head, tail) in zip(one[:shared], reversed(two[:shared])):
            following[last] = head
            windows.append((a + b, first, tail))
        windows.sort()
        least = windows[0][0] if len(windows) == k else 0
        heapq.heappush(queue, (least - windows[-1][0], made, windows))
        made += 1
    out = []
    for _, first, _ in queue[0][2] if queue else []:
        items = []
        while first >= 0:
            items.append(first)
            first = following[first]
        out.append(items)
    return out


def pack(sizes: list[int], capacity: int) -> list[list[int]]:
    """Windows of at most ``capacity``; each item is at most that long."""
    k = max(-(-sum(sizes) // capacity), sum(2 * size > capacity for size in sizes))
    while True:
        windows = differencing(sizes, k)
        if all(sum(sizes[i] for i in window) <= capacity for window in windows):
            return windows
        k += 1


def pack_documents(
    docs: DataFrame, path: str, end_id: int = 2, capacity: int = 4096, windows: int = 128
) -> DataFrame:
    """One row per piece: where it begins in its document and in its sequence, its length and the
    checksum of its ids. Ids of sequences are unique, not without gaps."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = encoder(path, WORDS)
        context = TaskContext.get()
        sequence = (context.partitionId() if context else 0) << 40
        rests: list[tuple] = []  # a piece and, if it may be cut, its ids
        waiting = 0
        full = FILL * windows * capacity

        def close() -> list[tuple]:
            nonlocal sequence, rests, waiting
            long = sum(ids is not None for _, ids in rests)
            pieces = []
            for piece, ids in rests:
                # More long rests than windows needed: two never share one, so half a window is cut off each.
                if ids is None or long * capacity <= waiting + capacity:
                    pieces.append(piece)
                    continue
                doc, at, length, _, total = piece
                half = capacity // 2
                pieces.append((doc, at, half, zlib.crc32(ids[:half]), total))
                pieces.append((doc, at + half, length - half, zlib.crc32(ids[half:]), total))
            rows = []
            for window in pack([p[2] for p in pieces], capacity):
                offset = 0
                for i in sorted(window):
                    rows.append((*pieces[i], sequence, offset))
                    offset += pieces[i][2]
                sequence += 1
            rests, waiting = [], 0
            return rows

        for part in slices(batches, limit=SLICE):
            ids, starts = with_end(*model.texts(part.column("text")), end_id)
            rows: list[tuple] = []
            bounds = starts.tolist()
            for doc, begin, end in zip(part.column("doc_id").to_pylist(), bounds, bounds[1:]):
                total = end - begin
                for at in range(0, total, capacity):
                    length = min(capacity, total - at)
                    own = ids[begin + at : begin + at + length]
                    crc = zlib.crc32(own)
                    if length == capacity:
                        rows.append((doc, at, length, crc, total, sequence, 0))
                        sequence += 1
                    else:
                        rests.append(((doc, at, length, crc, total), own.copy() if 2 * length > capacity else None))
                        waiting += length
                if waiting >= full or len(rests) >= RESTS:
                    rows += close()
            yield table(rows)
        model.forget()
        if rests:
            yield table(close())

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def table(rows: list[tuple]) -> pa.RecordBatch:
    names = [part.split()[0] for part in SCHEMA.split(", ")]
    columns = zip(*rows) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)


def sequences(docs: DataFrame, pieces: DataFrame, path: str, end_id: int = 2) -> DataFrame:
    """sequence_id and its ids: the pieces joined with their documents' ids, one bounded row per
    sequence. doc_id must be unique and not null in ``docs``."""

    def ids_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = encoder(path)
        for part in slices(batches):
            ids, starts = with_end(*model.texts(part.column("text")), end_id)
            column = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), ids.astype(np.int32))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), column], ["doc_id", "ids"])

    coded = docs.select("doc_id", "text").mapInArrow(ids_of, "doc_id bigint, ids array<int>")
    cut = F.slice("ids", (F.col("start") + 1).cast("int"), F.col("length").cast("int"))
    return (
        pieces.join(coded, "doc_id")
        .select("sequence_id", F.struct("offset", cut.alias("ids")).alias("piece"))
        .groupBy("sequence_id")
        .agg(F.flatten(F.transform(F.sort_array(F.collect_list("piece")), lambda p: p.ids)).alias("ids"))
    )

"""Line dedup with levelled sorted runs of line hashes.

Documents come in batches of rising doc_id. The keys seen so far lie in runs: tables of (key,
doc_id) bucketed and sorted by key, so that a batch is merged with a run without moving the run. A
batch's keys are anti-joined with every run; what is left is new, and each new key with its smallest
doc_id becomes the next run. When a level holds ``fan_in`` runs they are compacted into one run of the
next level. A (document, key) pair of the batch that is not among its new pairs is a repeat, and the
document loses the lines with that key.

A key is a line without white space at both ends, A-Z in lower case; shorter keys than ``least``
code points are never dropped. Null or empty text: one empty line. Repeated rows of one doc_id count
as one document; rows with a null doc_id count as one document that comes last. Extra columns pass
through. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from uuid import uuid4

import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplens.llm.words import SPACES, slices
from shoplens.sources.stages import stage_path, store

LAST = (1 << 63) - 1
SALTS = 16
SLICE = 1 << 20  # bytes of text cut into lines at a time, one text at least


def line_key(line: str, least: int) -> bytes | None:
    """The hash of a line's key; None for a key that is too short to count."""
    bare = line.strip(SPACES)
    return xxhash.xxh3_128_digest(bare.encode().lower()) if len(bare) >= least else None


def line_keys(docs: DataFrame, least: int) -> DataFrame:
    """(doc_id, key) for the distinct keys of each row."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, limit=SLICE):
            found: list[bytes] = []
            counts = []
            for text in pc.fill_null(part.column("text"), "").to_pylist():
                own = {line_key(line, least) for line in text.split("\n")} - {None}
                found += own
                counts.append(len(own))
            ids = pa.array(
                part.column("doc_id").to_numpy(zero_copy_only=False).repeat(counts), pa.int64()
            )
            yield pa.RecordBatch.from_arrays([ids, pa.array(found, pa.binary())], ["doc_id", "key"])

    ids = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST)).alias("doc_id")
    return docs.select(ids, "text").mapInArrow(keys, "doc_id bigint, key binary")


class LineRuns:
    """The keys of all earlier batches, in levels of bucketed runs."""

    def __init__(self, spark: SparkSession, fan_in: int = 2):
        self.spark, self.fan_in = spark, fan_in
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []

    def write(self, pairs: DataFrame) -> str:
        """A run: one sorted file for each bucket of keys."""
        name = f"shoplens_lines_{uuid4().hex}"
        (
            pairs.repartition(self.buckets, "key")
            .write.bucketBy(self.buckets, "key")
            .sortBy("key")
            .option("path", stage_path(self.spark, "lines"))
            .saveAsTable(name)
        )
        return name

    def add(self, pairs: DataFrame) -> DataFrame:
        """The pairs (doc_id, key) of the next batch that repeat an earlier line."""
        new = pairs.groupBy("key").agg(F.min("doc_id").alias("doc_id"))
        for run in (name for level in self.levels for name in level):
            new = new.join(self.spark.table(run).select("key"), "key", "left_anti")
        run = self.write(new)
        if not self.levels:
            self.levels.append([])
        self.levels[0].append(run)
        # Both columns are the join key, so a line that everyone has is spread over its documents.
        repeats = pairs.join(self.spark.table(run), ["doc_id", "key"], "left_anti")
        stored = store(repeats, "repeats")
        self.compact()
        return stored

    def compact(self) -> None:
        for depth, level in enumerate(self.levels):
            if len(level) < self.fan_in:
                continue
            if depth + 1 == len(self.levels):
                self.levels.append([])
            merged = self.spark.table(level[0])
            for name in level[1:]:
                merged = merged.unionByName(self.spark.table(name))
            self.levels[depth + 1].append(self.write(merged))
            self.drop(level)
            level.clear()

    def drop(self, names: list[str]) -> None:
        for name in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def close(self) -> None:
        for level in self.levels:
            self.drop(level)
        self.levels = []


def repeated_lines(docs: DataFrame, least: int = 10, batches: int = 4, fan_in: int = 2) -> DataFrame:
    """(doc_id, key): whose lines that document loses; rows without a doc_id are the document LAST."""
    spark = docs.sparkSession
    pairs = store(line_keys(docs, least).dropDuplicates(["doc_id", "key"]), "line-keys")
    shares = [(i + 1) / batches for i in range(batches - 1)]
    cuts = pairs.select(F.percentile_approx("doc_id", F.array(*map(F.lit, shares)), 10_000).alias("c"))
    edges = sorted(set(cuts.first().c or [])) if shares else []
    runs = LineRuns(spark, fan_in)
    repeats = None
    for low, high in zip([None, *edges], [*edges, None]):
        batch = pairs
        if low is not None:
            batch = batch.filter(F.col("doc_id") > low)
        if high is not None:
            batch = batch.filter(F.col("doc_id") <= high)
        found = runs.add(batch)
        repeats = found if repeats is None else repeats.unionByName(found)
    runs.close()
    return repeats


def unnamed_keys(docs: DataFrame, repeats: DataFrame, least: int) -> DataFrame:
    """(row, keys): the keys that each row without a doc_id loses, met line by line.

    These rows are one document with one list of keys, which may be long: no list of it is made. A key is
    copied ``SALTS`` times and a row's lines are dealt over the copies, so a line that all rows have is not
    one task.
    """
    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, limit=SLICE):
            rows, found = [], []
            for row, text in zip(part.column("row").to_pylist(), part.column("text").to_pylist()):
                own = {line_key(line, least) for line in (text or "").split("\n")} - {None}
                found += own
                rows += [row] * len(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.binary()), pa.array(found, pa.binary())], ["row", "key"]
            )

    held = docs.select("row", "text").mapInArrow(lines, "row binary, key binary").distinct()
    salt = F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int").alias("salt")
    lost = repeats.filter(F.col("doc_id") == LAST).select(
        "key", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    )
    return held.select("row", "key", salt).join(lost, ["key", "salt"]).groupBy("row").agg(
        F.collect_list("key").alias("keys")
    )


def cut_lines(docs: DataFrame, repeats: DataFrame, least: int) -> DataFrame:
    """(doc, n_lines, n_dropped, kept_text): every row of ``docs`` as a struct, and what is left."""
    place = F.col("doc_id").cast("bigint")
    whole = docs.select(F.struct("*").alias("doc"), "text", place.alias("place"))
    lost = repeats.filter(F.col("doc_id") != LAST).groupBy(F.col("doc_id").alias("place")).agg(
        F.collect_list("key").alias("keys")
    )
    joined = whole.filter("place IS NOT NULL").join(lost.hint("shuffle_hash"), "place", "left").select("doc", "text", "keys")
    unnamed = whole.filter("place IS NULL")
    if not unnamed.isEmpty():
        # Equal texts lose the same lines, so a text stands for all its rows.
        row = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).cast("binary").alias("row")
        unnamed = unnamed.select("doc", "text", row)
        keys = unnamed_keys(unnamed.select("row", "text"), repeats, least)
        joined = joined.unionByName(unnamed.join(keys, "row", "left").select("doc", "text", "keys"))
    schema = T.StructType([joined.schema["doc"]])
    schema.add("n_lines", "long").add("n_dropped", "long").add("kept_text", "string")

    def cut(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(found, limit=SLICE):
            lines, dropped, texts = [], [], []
            for text, keys in zip(
                pc.fill_null(part.column("text"), "").to_pylist(), part.column("keys").to_pylist()
            ):
                all_lines = text.split("\n")
                left = all_lines
                if keys:
                    gone = set(keys)
                    left = [x for x in all_lines if line_key(x, least) not in gone]
                lines.append(len(all_lines))
                dropped.append(len(all_lines) - len(left))
                texts.append("\n".join(left) if keys else text)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc"), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64()),
                 pa.array(texts, pa.string())],
                ["doc", "n_lines", "n_dropped", "kept_text"],
            )

    return joined.mapInArrow(cut, schema)


def without_repeated_lines(
    docs: DataFrame, least: int = 10, batches: int = 4, fan_in: int = 2
) -> DataFrame:
    """The same rows and columns with the repeated lines gone from ``text``; null stays null."""
    cut = cut_lines(docs, repeated_lines(docs, least, batches, fan_in), least)
    text = F.when(F.col("doc.text").isNotNull(), F.col("kept_text")).alias("text")
    return cut.select(*(text if c == "text" else F.col(f"doc.`{c}`") for c in docs.columns))


def line_digests(
    docs: DataFrame, least: int = 10, batches: int = 4, fan_in: int = 2
) -> DataFrame:
    """doc_id, n_lines, n_dropped and the SHA-256 of the kept text."""
    thin = docs.select("doc_id", "text")
    cut = cut_lines(thin, repeated_lines(thin, least, batches, fan_in), least)
    digest = F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256")
    return cut.select("doc.doc_id", "n_lines", "n_dropped", digest)

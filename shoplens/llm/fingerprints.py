"""I-Match fingerprints: hashes of the sorted distinct terms within a band of inverse document
frequency, over the whole lexicon and over randomised subsets of it.

Terms are words in lower case without punctuation at both ends. The lexicon holds the terms with
ln(documents / frequency) in the band; a text none of whose terms is in it uses all its terms. The
subsets are nested: in each of ``REPLICAS`` random orders the s-th keeps a term with chance 2**-s, so
short and long texts alike have subsets that hold few of their terms, and those outlive an edit. The
likeness of two fingerprints is the share of equal hashes among the subsets that are not empty in both
(1 when all are).

A frequency of at least documents * exp(-high) bounds the lexicon by exp(high) times the mean number
of distinct terms per document, whatever the number of documents; that is what is broadcast.

Null text: empty, and an empty text has only empty subsets. Equal texts have equal fingerprints. For
``edited`` the documents stand in descending doc_id order, null doc_ids last, rows with equal doc_ids
by descending hash of the text; a lone document is its own next. Repeated rows stand next to each other. Very long
texts are a slice of their own. Extra columns stay out of the result; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm.words import joined_lines, mix, slices, split_words, word_hashes

IDF_BAND = (math.log(10), math.log(500))
SCALES, REPLICAS = 11, 8
KEEP = 1 << 22  # distinct terms that a task gathers before it hands their counts on
EMPTY = "00000000"


def text_terms(texts: pa.Array) -> list[np.ndarray]:
    """The sorted distinct term hashes of each text."""
    words = split_words(texts)
    if not len(words.codes):
        return [np.empty(0, dtype=np.uint64)] * len(texts)
    low = pc.replace_substring_regex(
        pc.utf8_lower(words.distinct), r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", ""
    )
    hashes = word_hashes(joined_lines(low).split("\n"))
    hashes[(pc.binary_length(low).to_numpy(zero_copy_only=False) == 0)] = 0
    own, bounds = hashes[words.codes], words.starts.tolist()
    found = [np.unique(own[a:b]) for a, b in zip(bounds, bounds[1:])]
    return [t[1:] if len(t) and t[0] == 0 else t for t in found]


def term_frequencies(docs: DataFrame) -> DataFrame:
    """(term, n): in how many rows each term stands."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, counts = np.empty(0, np.uint64), np.empty(0, np.int64)
        for part in slices(batches):
            found = np.concatenate([terms, *text_terms(part.column("text"))])
            weight = np.concatenate([counts, np.ones(len(found) - len(terms), np.int64)])
            terms, place = np.unique(found, return_inverse=True)
            counts = np.bincount(place, weights=weight, minlength=len(terms)).astype(np.int64)
            if len(terms) > KEEP:
                yield batch(terms, counts)
                terms, counts = terms[:0], counts[:0]
        yield batch(terms, counts)

    def batch(terms: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(terms.view(np.int64)), pa.array(counts)], ["term", "n"]
        )

    rows = docs.select("text").mapInArrow(count, "term bigint, n bigint")
    return rows.groupBy("term").agg(F.sum("n").alias("n"))


def lexicon(docs: DataFrame, band: tuple[float, float] = IDF_BAND) -> np.ndarray:
    """The sorted term hashes within the band."""
    total = docs.count()
    frequent = term_frequencies(docs).filter(
        (F.col("n") >= total * math.exp(-band[1])) & (F.col("n") <= total * math.exp(-band[0]))
    )
    return np.sort(frequent.select("term").toPandas()["term"].to_numpy(np.int64).view(np.uint64))


def subset_hashes(terms: np.ndarray, chosen: np.ndarray) -> list[str]:
    """The fingerprint of a text: one hash per subset, ``EMPTY`` for a subset without its terms."""
    if len(chosen) and len(terms):
        places = np.minimum(np.searchsorted(chosen, terms), len(chosen) - 1)
        inside = terms[chosen[places] == terms]
        terms = inside if len(inside) else terms
    hashes = [digest(terms)]
    for replica in range(REPLICAS):
        drawn = mix(terms ^ np.uint64((replica + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        for scale in range(1, SCALES):
            drawn_in = (drawn & np.uint64((1 << scale) - 1)) == 0
            terms_in, drawn = (terms if scale == 1 else terms_in)[drawn_in], drawn[drawn_in]
            hashes.append(digest(terms_in))
    return hashes


def digest(terms: np.ndarray) -> str:
    return hashlib.blake2b(terms.tobytes(), digest_size=4).hexdigest() if len(terms) else EMPTY


def likeness(one: list[str], other: list[str]) -> float:
    used = [a == b for a, b in zip(one, other) if a != EMPTY or b != EMPTY]
    return sum(used) / len(used) if used else 1.0


def fingerprints(texts: pa.Array, chosen: np.ndarray) -> list[list[str]]:
    return [subset_hashes(terms, chosen) for terms in text_terms(texts)]


def fingerprint_documents(docs: DataFrame, band: tuple[float, float] = IDF_BAND) -> DataFrame:
    """doc_id and fingerprint of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon(docs, band))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found = ["".join(f) for f in fingerprints(part.column("text"), shared.value)]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(found, pa.string())], ["doc_id", "fingerprint"]
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, fingerprint string")


FIRST = -(1 << 63)


def with_neighbours(docs: DataFrame) -> DataFrame:
    """(bucket, donor, doc_id, text): ranges of doc_id, sorted for reading in descending order.

    A range also gets, as its last row with donor = 1, the document that follows its lowest one. A doc_id (or
    the missing one) with so many rows that it takes several ranges is parted by the hash of the text. The
    driver holds two numbers for each range.
    """
    ranges = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(FIRST))
    keyed = docs.select(
        order.alias("k"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"),
        F.col("doc_id").cast("bigint").alias("doc_id"), "text",
    )
    shares = [(i + 1) / ranges for i in range(ranges - 1)]
    found = keyed.select(F.percentile_approx("k", F.array(*map(F.lit, shares)), 10_000).alias("c"))
    cuts = (found.first().c or []) if shares else []
    bucket = F.lit(0)
    if cuts:
        edges = F.array(*map(F.lit, cuts))
        below = F.size(F.filter(edges, lambda c: c < F.col("k")))
        here = F.size(F.filter(edges, lambda c: c == F.col("k")))
        share = F.shiftrightunsigned("h", 34).cast("double") / (1 << 30)
        bucket = below + F.floor(share * F.greatest(here, F.lit(1))).cast("int")
    keyed = keyed.withColumn("bucket", bucket)
    tops = keyed.groupBy("bucket").agg(F.max(F.struct("k", "h")).alias("top"))
    tops = sorted((r.bucket, r.top.k, r.top.h) for r in tops.collect())
    rows = keyed.withColumn("donor", F.lit(0))
    if tops:
        follows = [*(t[0] for t in tops[1:]), tops[0][0]]
        listed = [(*top, to) for top, to in zip(tops, follows)]
        # At most ``ranges`` rows, a setting of the session.
        highest = F.broadcast(
            docs.sparkSession.createDataFrame(listed, "bucket int, k bigint, h bigint, to int")
        )
        donors = keyed.join(highest, ["bucket", "k", "h"]).groupBy("to").agg(
            F.max(F.struct("k", "h", "doc_id", "text")).alias("top")
        )
        rows = rows.select("bucket", "donor", "k", "h", "doc_id", "text").unionByName(
            donors.select(F.col("to").alias("bucket"), F.lit(1).alias("donor"), "top.*")
        )
    return (
        rows.repartitionById(max(len(cuts) + 1, 1), "bucket")
        .sortWithinPartitions(
            "bucket", "donor", F.col("k").desc(), F.col("h").desc(), F.col("text").desc_nulls_last()
        )
        .select("bucket", "donor", "doc_id", "text")
    )


def edited(text: str, following: str) -> str:
    """``text`` with its last third replaced by the beginning of the following document."""
    size = len(text) // 3
    return text[: len(text) - size] + following[:size]


def edit_likeness(docs: DataFrame, band: tuple[float, float] = IDF_BAND) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they and the next are."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon(docs, band))
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
             "near_edited", "near_next"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None  # the last row so far, and its fingerprint
        for part in slices(batches):
            texts = pc.fill_null(part.column("text"), "")
            rows = list(
                zip(
                    part.column("bucket").to_pylist(), part.column("donor").to_pylist(),
                    part.column("doc_id").to_pylist(), texts.to_pylist(),
                    fingerprints(texts, shared.value),
                )
            )
            if before:
                rows.insert(0, before)
            pairs = [(a, b) for a, b in zip(rows, rows[1:]) if a[0] == b[0] and not a[1]]
            changed = [edited(a[3], b[3]) for a, b in pairs]
            found = fingerprints(pa.array(changed, pa.string()), shared.value)
            out = [
                (a[2], len(a[3]), hashlib.sha256(text.encode()).hexdigest(), "".join(a[4]),
                 "".join(own), likeness(a[4], own), likeness(a[4], b[4]))
                for (a, b), text, own in zip(pairs, changed, found)
            ]
            kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2]
            columns = zip(*out) if out else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)
            before = rows[-1]

    return with_neighbours(docs).mapInArrow(
        run,
        "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double",
    )

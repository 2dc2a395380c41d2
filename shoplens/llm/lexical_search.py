"""Ranked lexical search by MaxScore with pair bounds.

The index is a table of blocks of documents. A block holds, for each term of the query set, the documents
that have it with the term's impact (its part of their score), the largest impact, and for chosen pairs of
terms the intersection list with the largest joint impact. Pairs are neighbours by weight among the terms of
an item, so the pairs of one item are disjoint and their bounds add up.

A search goes through the blocks of a task with one list of best documents per item, whose last score is
the threshold. Of a block it first bounds what each pair can add: a document that has both terms gets at
most the joint maximum, one that has one of them at most the larger single maximum; this is less than the
two maxima together, so longer runs of terms together stay below the threshold. Documents that only such
terms hold are never scored. The others are scored by the remaining (essential) terms, then by the pairs from
the highest bound down, and dropped as soon as what is left cannot lift them to the threshold; whether a
document stands in a pair's intersection list decides which bound it gets. A document that equals
the threshold is kept, since its doc_id may be smaller. The result is exact.

Scores are whole numbers: see ``weight``, ``spread`` and ``impacts``. All counts are over all documents.
The lists of the tasks meet in a window over at most ``top`` rows per task and item.

The query set is handled in batches of about ``BATCH`` bytes, each with its own index, so what the driver
holds and tasks are sent (terms of a batch, their counts, its pairs) is bounded; the index grows with the documents.

Null or empty text (of documents or items): no terms. Repeated documents are ranked each by itself, repeated
items answered each by itself. Equal scores go by doc_id, a null doc_id last. Very long texts are
one block. Extra columns stay out; an empty table of either kind gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoplens.llm.words import Words, from_raw, raw_texts, slices, split_words
from shoplens.sources.stages import store

TOP, BATCH = 20, 8 << 20
BLOCK = 2 << 20  # bytes of text in a block of the index, one text at least
#: Digits, letters (A-Z in lower case) and all bytes of longer characters stay, the rest is space.
TERM_BYTES = bytes(
    b if b >= 0x80 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 32
    for b in range(256)
)


def terms_of(texts: pa.Array) -> Words:
    """The terms of each text; null has none."""
    data, starts = raw_texts(texts)
    return split_words(from_raw(data.tobytes().translate(TERM_BYTES), starts))


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def spread(terms: np.ndarray, documents: int, total: int) -> np.ndarray:
    """m of documents with so many terms: 75 and 25 times the length against the mean length."""
    return 100 - 25 + (25 * terms * documents) // max(total, 1)


def impacts(weights: np.ndarray, times: np.ndarray, m: np.ndarray) -> np.ndarray:
    return weights * ((1_000_000_000 * times) // (1000 * times + 12 * m))


# ---- index -----------------------------------------------------------------------------------------

COUNTS = (
    "ids array<bigint>, lengths array<bigint>, with_terms bigint, terms_total bigint, "
    "terms array<int>, starts array<int>, places array<int>, times array<int>"
)
BLOCKS = (
    "ids array<bigint>, terms array<int>, starts array<int>, places array<int>, impact array<bigint>, "
    "pairs array<int>, pair_starts array<int>, pair_places array<int>, pair_best array<bigint>"
)


def names_of(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(", ")]


def one_row(values: list, schema: str) -> pa.RecordBatch:
    """A batch of one row; arrays become lists."""
    kinds = {"array<bigint>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()), "bigint": pa.int64()}
    columns = []
    for value, part in zip(values, schema.split(", ")):
        kind = kinds[part.split()[1]]
        if pa.types.is_list(kind):
            flat = value if isinstance(value, pa.Array) else pa.array(value, kind.value_type)
            columns.append(pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat))
        else:
            columns.append(pa.array([value], kind))
    return pa.RecordBatch.from_arrays(columns, names_of(schema))


def counted_blocks(docs: DataFrame, lexicon: dict[str, int]) -> DataFrame:
    """One row per block: its documents, and where and how often they hold each term of the lexicon."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value
        for part in slices(batches, limit=BLOCK):
            words = terms_of(part.column("text"))
            known = np.fromiter((number.get(w, -1) for w in words.strings()), np.int64, len(words.distinct))
            code = known[words.codes] if len(known) else np.empty(0, np.int64)
            found = code >= 0
            cells = code[found] * part.num_rows + words.rows[found]
            cells, times = np.unique(cells, return_counts=True)
            term, place = np.divmod(cells, part.num_rows)
            terms, starts = np.unique(term, return_index=True)
            yield one_row(
                [part.column("doc_id"), words.counts, int((words.counts > 0).sum()), int(words.counts.sum()),
                 terms.astype(np.int32), np.append(starts, len(term)).astype(np.int32),
                 place.astype(np.int32), times.astype(np.int32)],
                COUNTS,
            )

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, COUNTS)


def arrays_of(batch: pa.RecordBatch, row: int, names: list[str]) -> dict[str, np.ndarray]:
    return {n: batch.column(n)[row].values.to_numpy(zero_copy_only=False) for n in names}


@dataclass
class Corpus:
    """What scores need of all documents: how many have a term, all their terms, weights by term number."""

    documents: int
    total: int
    weights: np.ndarray


def corpus_of(blocks: DataFrame, size: int) -> Corpus:
    sums = blocks.agg(F.sum("with_terms").alias("n"), F.sum("terms_total").alias("total")).first()
    sizes = F.zip_with(
        F.slice("starts", 2, F.greatest(F.size("starts") - 1, F.lit(0))),
        F.slice("starts", 1, F.greatest(F.size("starts") - 1, F.lit(0))), lambda b, a: b - a,
    )
    cells = blocks.select(F.explode(F.arrays_zip("terms", sizes.alias("holding"))).alias("cell"))
    # One row per term of the lexicon, which is bounded by the batch of items.
    holding = (
        cells.groupBy("cell.terms").agg(F.sum("cell.holding").cast("bigint").alias("holding")).collect()
    )
    weights = np.zeros(size, dtype=np.int64)
    for row in holding:
        weights[row.terms] = weight(sums.n, row.holding)
    return Corpus(sums.n or 0, sums.total or 0, weights)


@dataclass
class Query:
    """One item: its pairs (two places in ``terms``, or one twice), and how often each term stands in it."""

    terms: np.ndarray
    repeats: np.ndarray
    pairs: list[tuple[int, int]]


def planned(items: list[Counter], lexicon: dict[str, int], corpus: Corpus) -> list[Query]:
    """The items' terms by weight, neighbours paired; terms without weight are left out."""
    plans = []
    for item in items:
        own = [(int(corpus.weights[lexicon[t]]), t, n) for t, n in item.items()]
        own = sorted((x for x in own if x[0] > 0), key=lambda x: (-x[0], x[1]))
        pairs = [(i, min(i + 1, len(own) - 1)) for i in range(0, len(own), 2)]
        plans.append(Query(
            np.array([lexicon[t] for _, t, _ in own], dtype=np.int64),
            np.array([n for _, _, n in own], dtype=np.int64), pairs,
        ))
    return plans


def term_pairs(plans: list[Query]) -> np.ndarray:
    """The distinct pairs of term numbers, smaller first, in order."""
    found = {tuple(sorted((int(q.terms[a]), int(q.terms[b])))) for q in plans for a, b in q.pairs if a != b}
    return np.array(sorted(found), dtype=np.int64).reshape(-1, 2)


def index_blocks(blocks: DataFrame, corpus: Corpus, pairs: np.ndarray) -> DataFrame:
    """Impacts instead of counts, and the intersection lists of the pairs that bound better than their terms."""
    shared = blocks.sparkSession.sparkContext.broadcast((corpus, pairs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        corpus, pairs = shared.value
        for batch in batches:
            for row in range(batch.num_rows):
                own = arrays_of(batch, row, ["lengths", "terms", "starts", "places", "times"])
                terms, starts, places = own["terms"], own["starts"], own["places"]
                m = spread(own["lengths"], corpus.documents, corpus.total)
                weights = np.repeat(corpus.weights[terms], np.diff(starts))
                impact = impacts(weights, own["times"].astype(np.int64), m[places])
                at = np.full(len(corpus.weights), -1)
                at[terms] = np.arange(len(terms))
                gained = np.zeros(len(m), dtype=np.int64)
                kept, lists, best = [], [], []
                for number, (a, b) in enumerate(pairs.tolist()):
                    x, y = at[a], at[b]
                    if x < 0 or y < 0:
                        continue
                    one, two = slice(starts[x], starts[x + 1]), slice(starts[y], starts[y + 1])
                    gained[places[one]] = impact[one]
                    first = gained[places[two]]
                    both = first > 0
                    joint = int((first + impact[two])[both].max()) if both.any() else 0
                    gained[places[one]] = 0
                    if joint < impact[one].max() + impact[two].max():
                        kept.append(number)
                        lists.append(places[two][both])
                        best.append(joint)
                yield one_row(
                    [batch.column("ids")[row].values, terms, starts, places, impact, np.array(kept, np.int32),
                     np.cumsum([0, *map(len, lists)], dtype=np.int32),
                     np.concatenate(lists) if lists else np.empty(0, np.int32), np.array(best, np.int64)],
                    BLOCKS,
                )

    return blocks.mapInArrow(run, BLOCKS)


# ---- search ----------------------------------------------------------------------------------------


@dataclass
class Best:
    """The best documents of an item so far, in order: score, whether the id is null, id."""

    scores: np.ndarray
    nulls: np.ndarray
    ids: np.ndarray

    def least(self, top: int) -> int:
        """What a document must reach to get in."""
        return max(int(self.scores[-1]), 1) if len(self.scores) >= top else 1

    def add(self, scores: np.ndarray, nulls: np.ndarray, ids: np.ndarray, top: int) -> None:
        scores, nulls, ids = (
            np.concatenate(x) for x in ((self.scores, scores), (self.nulls, nulls), (self.ids, ids))
        )
        order = np.lexsort((ids, nulls, -scores))[:top]
        self.scores, self.nulls, self.ids = scores[order], nulls[order], ids[order]


class Block:
    """One block of the index."""

    def __init__(self, batch: pa.RecordBatch, row: int, terms: int, pairs: int):
        names = names_of(BLOCKS)[1:]
        own = arrays_of(batch, row, names)
        ids = batch.column("ids")[row].values
        self.nulls = ids.is_null().to_numpy(zero_copy_only=False)
        self.ids = pc.fill_null(ids, 0).to_numpy(zero_copy_only=False)
        self.starts, self.places, self.impact = own["starts"], own["places"], own["impact"]
        self.pair_starts, self.pair_places = own["pair_starts"], own["pair_places"]
        self.pair_best = own["pair_best"]
        self.at = np.full(terms, -1)
        self.at[own["terms"]] = np.arange(len(own["terms"]))
        self.pair_at = np.full(pairs, -1)
        self.pair_at[own["pairs"]] = np.arange(len(own["pairs"]))
        some = len(own["terms"])
        self.most = np.maximum.reduceat(self.impact, self.starts[:-1]) if some else self.impact[:0]

    def postings(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.starts[self.at[term]], self.starts[self.at[term] + 1]
        return self.places[a:b], self.impact[a:b]

    def intersection(self, pair: int) -> np.ndarray:
        a = self.pair_at[pair]
        return self.pair_places[self.pair_starts[a] : self.pair_starts[a + 1]]


def search_block(block: Block, query: Query, numbers: list[int], best: Best, top: int) -> None:
    """Bring ``best`` up to date with the documents of the block. ``numbers``: the pairs' numbers, -1 if none."""
    least = best.least(top)
    # A unit: the most it adds to a document, the most to one outside its intersection list, its terms
    # (with repeats), and its pair's number if it has such a list.
    units = []
    for (a, b), number in zip(query.pairs, numbers):
        terms = [(int(query.terms[i]), int(query.repeats[i])) for i in ({a, b} if a != b else {a})]
        terms = [(t, r) for t, r in terms if block.at[t] >= 0]
        if not terms:
            continue
        singles = [r * int(block.most[block.at[t]]) for t, r in terms]
        bound = outside = sum(singles)
        listed = -1
        if len(terms) == 2 and number >= 0 and block.pair_at[number] >= 0:
            joint = max(r for _, r in terms) * int(block.pair_best[block.pair_at[number]])
            outside = max(singles)
            bound = min(bound, max(joint, outside))
            listed = number
        units.append((bound, outside, terms, listed))
    units.sort(key=lambda unit: unit[0])
    below = np.cumsum([0, *(unit[0] for unit in units)])  # the most that the first so many units add
    if below[-1] < least:
        return
    spared = int(np.searchsorted(below, least, "left")) - 1  # units that cannot reach it together
    scores = np.zeros(len(block.ids), dtype=np.int64)
    for _, _, terms, _ in units[spared:]:
        for term, repeats in terms:
            places, impact = block.postings(term)
            scores[places] += repeats * impact
    alive = np.flatnonzero(scores > 0)
    for number in range(spared - 1, -1, -1):
        alive = alive[scores[alive] + below[number + 1] >= least]
        if not len(alive):
            return
        _, outside, terms, listed = units[number]
        if listed >= 0:
            reach = scores[alive] + below[number] + outside >= least
            reach[~reach] = np.isin(alive[~reach], block.intersection(listed), assume_unique=True)
            alive = alive[reach]
        for term, repeats in terms:
            places, impact = block.postings(term)
            if len(places) > 8 * len(alive):
                at = np.minimum(np.searchsorted(places, alive), len(places) - 1)
                scores[alive] += np.where(places[at] == alive, repeats * impact[at], 0)
            else:
                scores[places] += repeats * impact
    alive = alive[scores[alive] >= least]
    if len(alive):
        best.add(scores[alive], block.nulls[alive], block.ids[alive], top)


def searched(index: DataFrame, plans: list[Query], pairs: np.ndarray, terms: int, top: int) -> DataFrame:
    """(item, doc_id, score): the best documents of each item in each task."""
    number_of = {pair: n for n, pair in enumerate(map(tuple, pairs.tolist()))}
    numbers = [
        [number_of.get(tuple(sorted((int(q.terms[a]), int(q.terms[b])))), -1) for a, b in q.pairs] for q in plans
    ]
    shared = index.sparkSession.sparkContext.broadcast((plans, numbers))
    count = len(pairs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plans, numbers = shared.value
        empty = np.empty(0, dtype=np.int64)
        found = [Best(empty, empty.astype(bool), empty) for _ in plans]
        for batch in batches:
            for row in range(batch.num_rows):
                block = Block(batch, row, terms, count)
                for query, own, best in zip(plans, numbers, found):
                    search_block(block, query, own, best, top)
        for item, best in enumerate(found):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(best.ids), item), pa.int32()),
                 pa.array(best.ids, pa.int64(), mask=best.nulls), pa.array(best.scores, pa.int64())],
                ["item", "doc_id", "score"],
            )

    return index.mapInArrow(run, "item int, doc_id bigint, score bigint")


def ranked_batch(docs: DataFrame, rows: list, top: int) -> DataFrame:
    """item_id, rank, doc_id, score for the items ``rows`` (item_id, text)."""
    spark = docs.sparkSession
    words = terms_of(pa.array([r.text for r in rows], pa.string()))
    strings, bounds = words.strings(), words.starts.tolist()
    items = [Counter(strings[c] for c in words.codes[a:b].tolist()) for a, b in zip(bounds, bounds[1:])]
    lexicon = {term: number for number, term in enumerate(strings)}
    blocks = store(counted_blocks(docs, lexicon), "term-counts")
    corpus = corpus_of(blocks, len(lexicon))
    plans = planned(items, lexicon, corpus)
    pairs = term_pairs(plans)
    index = store(index_blocks(blocks, corpus, pairs), "impact-index")
    found = searched(index, plans, pairs, len(lexicon), top)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    found = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    names = spark.createDataFrame([(n, r.item_id) for n, r in enumerate(rows)], "item int, item_id bigint")
    return found.join(names, "item").select("item_id", "rank", "doc_id", "score")


def rank_documents(docs: DataFrame, items: DataFrame, top: int = TOP, batch: int = BATCH) -> DataFrame:
    """item_id, rank, doc_id and score of the ``top`` best documents of every item (item_id, text)."""
    items = items.select(F.col("item_id").cast("bigint").alias("item_id"), "text")
    size = items.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 64).alias("size")).first().size
    batches = max(-(-(size or 0) // batch), 1)
    out = None
    for number in range(batches):
        mine = F.pmod(F.xxhash64("item_id", "text"), F.lit(batches)) == number
        found = ranked_batch(docs, items.filter(mine).collect(), top)
        found = store(found, "ranked") if batches > 1 else found
        out = found if out is None else out.unionByName(found)
    return out

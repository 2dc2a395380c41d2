"""Quality classifier by co-training of a text view and a metadata view.

The text view sees what the words are: hashed word shares, shares of capitals, digits, symbols, repeats,
and the evidence of the words a document holds. The metadata view sees source, language, length and line
layout. Both are logistic regressions, fitted on the labelled documents with both classes of equal weight.
In every round each view's scores are calibrated on labelled documents kept apart, and its confident scores of
unlabelled documents become training labels of the other view. At the end the two calibrated scores are
combined by a third logistic regression on the documents kept apart, and all documents are scored.

Evidence is for words that stand once in a long text, which no share shows: labelled documents that hold a
word, or a word with the same first ``PREFIX`` letters, are counted per class in ``PLACES`` hashed places (a
fixed number; places that stand out come to the driver).
Where the log odds of the classes are more than ``CERTAIN`` standard errors from even, they are the place's evidence;
a document has the sum of the evidence for and against. The evidence of a source is its smoothed
log odds. A training document is judged by the counts of the other folds only, so it never votes for itself.
Nothing is listed in the program; what is bad is learned from ``labels``.

Models are fitted on at most ``LABELLED`` labelled documents (those of lowest hash), a bound on what the
driver and tasks hold: their doc_ids and classes are sent to all tasks, so neither texts nor features are
shuffled. All documents are scored, and all unlabelled ones may become training rows.

Two targets are learned by the same views, each for itself: ``good`` from the mean ``quality`` of a
doc_id (1/2 and more is good) and ``clean`` from its mean ``toxic`` (below 1/2 is clean), null ones
left out. A document is rejected on either: if its chance to be good is below 1/2, or its chance to be clean
below the limit that catches most documents kept apart and loses at most ``LOSS`` of the clean ones. If
a target's labels or one of its two classes are missing, there is no ground to reject by: its every score is 1. Null text: empty. A null doc_id is never labelled.
Repeated rows are scored each by itself; equal scores are treated alike. Very long texts are a slice of
their own. Extra columns stay out of ``score_documents`` and pass through ``keep_good``. An empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplens.llm.quality_rules import repeated_words
from shoplens.llm.words import Words, slices, split_words, word_hashes
from shoplens.sources.stages import store

WORD_BUCKETS, LANG_BUCKETS = 64, 8
PLACES, PREFIX, CERTAIN, LABELLED = 1 << 18, 4, 4.0, 1 << 18
SLICE = 2 << 20  # bytes of text at a time, one text at least
FOLDS = 4  # of the labelled documents not kept apart
CELLS = 2 * 2 * (FOLDS + 1)  # of a place: target, class and fold
SMOOTH = 10.0  # documents of average kind that each source is given
LOSS = 0.02
ROUNDS, CONFIDENT, PSEUDO_WEIGHT = 2, 0.98, 0.5
#: Share of the labelled documents kept apart for calibration: one in APART, by checksum of doc_id.
APART = 5
VIEWS, TARGETS = ("text", "meta"), ("good", "clean")
#: The targets for which single words count. Quality is a matter of form, which the shares show.
WORDY = (TARGETS.index("clean"),)
LARGEST = 12.0  # log odds beyond this count as this
TRIMMED = ".,;:!?\"'()"
CLASSES = (r"\p{Lu}", r"\p{L}", r"\p{N}", r"[#*$%&|<>]", r"[!?]", r"[.,;:]")


@dataclass
class Labels:
    """The labelled documents: ascending doc_ids, and for each target its class (-1 if unknown). ``part`` is 0
    for documents kept apart, else 1 and more for their fold."""

    ids: np.ndarray
    targets: np.ndarray
    part: np.ndarray

    def of(self, ids: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(row, target) classes of documents, and their parts; unlabelled ones are -1 and 0."""
        known = ids.is_valid().to_numpy(zero_copy_only=False)
        wanted = pc.fill_null(ids, 0).to_numpy(zero_copy_only=False)
        if not len(self.ids):
            return np.full((len(wanted), len(TARGETS)), -1), np.zeros(len(wanted), dtype=np.int64)
        at = np.minimum(np.searchsorted(self.ids, wanted), len(self.ids) - 1)
        known &= self.ids[at] == wanted
        return np.where(known[:, None], self.targets[at], -1), np.where(known, self.part[at], 0)


def labels_of(labels: DataFrame) -> Labels:
    for column in ("quality", "toxic"):
        if column not in labels.columns:
            labels = labels.withColumn(column, F.lit(None).cast("int"))
    key = F.col("doc_id").cast("bigint").alias("doc_id")
    known = (
        labels.filter("doc_id IS NOT NULL").groupBy(key)
        .agg((F.avg("quality") >= 0.5).cast("int").alias("good"),
             (F.avg("toxic") < 0.5).cast("int").alias("clean"))
        .filter("good IS NOT NULL OR clean IS NOT NULL")
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(LABELLED)
    )
    draw = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    found = known.select(
        "doc_id", *(F.coalesce(t, F.lit(-1)).alias(t) for t in TARGETS),
        F.when(draw % APART == 0, 0).otherwise(1 + F.floor(draw / APART) % FOLDS).cast("int").alias("part"),
    ).toPandas().sort_values("doc_id")
    return Labels(found["doc_id"].to_numpy(np.int64), found[list(TARGETS)].to_numpy(np.int64), found["part"].to_numpy(np.int64))


def place_of(string: str) -> int:
    return xxhash.xxh3_64_intdigest(string) % PLACES


def word_places(words: Words) -> np.ndarray:
    """The places of each distinct word: of the word itself and of its first letters."""
    plain = [w.strip(TRIMMED).lower() or w for w in words.strings()]
    whole = np.fromiter(map(place_of, plain), np.int64, len(plain))
    start = np.fromiter((place_of(f" {w[:PREFIX]}") if len(w) > PREFIX else -1 for w in plain), np.int64, len(plain))
    return np.column_stack([whole, np.where(start < 0, whole, start)])


def source_places(part: pa.RecordBatch) -> np.ndarray:
    values = part.column("source").cast(pa.string()).to_pylist()
    place = {v: PLACES - 1 if v is None else place_of(v) for v in set(values)}
    return np.array([place[v] for v in values], dtype=np.int64)


def each_once(rows: np.ndarray, places: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct pairs (row, place), of several places in each row of ``places``; below 0 is none."""
    pairs = [rows[own >= 0] * size + own[own >= 0] for own in places.T]
    return np.divmod(np.unique(np.concatenate(pairs)), size)


@dataclass
class Table:
    """Evidence for the class 0 of each target, at the places that have any: ``values[place, target, table]``.
    Table 0 is from all training documents, table f from those outside fold f."""

    places: np.ndarray
    values: np.ndarray

    def find(self, places: np.ndarray) -> np.ndarray:
        """Where the places stand in the table, -1 if they have no evidence."""
        if not len(self.places):
            return np.full(places.shape, -1)
        at = np.minimum(np.searchsorted(self.places, places), len(self.places) - 1)
        return np.where(self.places[at] == places, at, -1)


@dataclass
class Evidence:
    words: Table
    sources: Table

    @staticmethod
    def learned(docs: DataFrame, labels: Labels) -> Evidence:
        shared = docs.sparkSession.sparkContext.broadcast(labels)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            labels = shared.value
            for part in slices(batches, limit=SLICE):
                targets, fold = labels.of(part.column("doc_id"))
                mine = fold > 0
                part = part.filter(pa.array(mine))
                if not part.num_rows:
                    continue
                targets, fold = targets[mine], fold[mine]
                words = split_words(part.column("text"))
                held = each_once(words.rows, word_places(words)[words.codes], PLACES)
                own = np.arange(part.num_rows), source_places(part) + PLACES
                keys = []
                for t in range(len(TARGETS)):
                    for row, place in (held, own) if t in WORDY else (own,):
                        known = targets[row, t] >= 0
                        cell = (t * 2 + targets[row, t][known]) * (FOLDS + 1) + fold[row][known]
                        keys.append(place[known] * CELLS + cell)
                key, n = np.unique(np.concatenate(keys), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], ["key", "n"])

        rows = docs.mapInArrow(run, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n"))
        cell = F.pmod("key", F.lit(CELLS))
        fold, kind = F.pmod(cell, F.lit(FOLDS + 1)), F.floor(cell / (FOLDS + 1))
        counts = rows.groupBy(F.floor(F.col("key") / CELLS).alias("place"), F.floor(kind / 2).alias("target")).agg(*(
            F.sum(F.when((kind % 2 == c) & (fold == f), F.col("n")).otherwise(0)).alias(f"n{c}_{f}")
            for c in (0, 1) for f in range(1, FOLDS + 1)
        ))
        sizes = {
            (t, c, f): int(((labels.targets[:, t] == c) & (labels.part == f)).sum())
            for t in range(len(TARGETS)) for c in (0, 1) for f in range(1, FOLDS + 1)
        }
        tables = []
        for table in range(FOLDS + 1):
            kept = [f for f in range(1, FOLDS + 1) if f != table]
            bad, good = (sum((F.col(f"n{c}_{f}") for f in kept), F.lit(0.0)) for c in (0, 1))
            n_bad, n_good = (
                F.element_at(F.array(*(F.lit(float(sum(sizes[t, c, f] for f in kept))) for t in range(len(TARGETS)))),
                             F.col("target").cast("int") + 1) for c in (0, 1)
            )
            odds = F.log((bad + 0.5) / (n_bad + 1)) - F.log((good + 0.5) / (n_good + 1))
            error = F.sqrt(1 / (bad + 0.5) + 1 / (good + 0.5))
            base = (n_bad + 1) / (n_bad + n_good + 2)
            rate = (bad + SMOOTH * base) / (bad + good + SMOOTH)
            of_source = F.log(rate / (1 - rate)) - F.log(base / (1 - base))
            of_word = F.when(F.abs(odds) > CERTAIN * error, odds).otherwise(0.0)
            tables.append(F.when(F.col("place") < PLACES, of_word).otherwise(of_source).alias(f"table{table}"))
        # Only places with evidence come to the driver: few of the words', and at most as many as sources.
        names = [f"table{i}" for i in range(FOLDS + 1)]
        some = counts.select("place", "target", *tables).filter(" OR ".join(f"{n} <> 0" for n in names))
        found = some.toPandas()
        place, target = (found[c].to_numpy(np.int64) for c in ("place", "target"))
        parts = []
        for own in (place < PLACES, place >= PLACES):
            places, at = np.unique(place[own] % PLACES, return_inverse=True)
            values = np.zeros((len(places), len(TARGETS), FOLDS + 1), dtype=np.float32)
            values[at, target[own]] = found.loc[own, names].to_numpy(np.float32)
            parts.append(Table(places, values))
        return Evidence(*parts)

    def of_words(self, words: Words, table: np.ndarray) -> np.ndarray:
        """For each text and wordy target the evidence for and against, added up, in logarithms."""
        size = len(table)
        if not len(words.codes) or not len(self.words.places):
            return np.zeros((size, 2 * len(WORDY)))
        at = self.words.find(word_places(words))
        some = (at >= 0).any(axis=1)[words.codes]  # few words are evidence
        row, place = each_once(words.rows[some], at[words.codes[some]], len(self.words.places))
        out = []
        for t in WORDY:
            found = self.words.values[place, t, table[row]]
            out += [
                np.log1p(np.bincount(row, np.maximum(sign * found, 0), minlength=size)) for sign in (1, -1)
            ]
        return np.column_stack(out)

    def of_sources(self, part: pa.RecordBatch, table: np.ndarray) -> np.ndarray:
        at = self.sources.find(source_places(part))
        if not len(self.sources.places):
            return np.zeros((len(at), len(TARGETS)))
        found = self.sources.values[np.maximum(at, 0), :, table]
        return np.where(at[:, None] >= 0, found, 0)


def text_view(texts: pa.Array, evidence: Evidence, table: np.ndarray) -> np.ndarray:
    words = split_words(texts)
    counts = words.counts
    some = np.maximum(counts, 1)
    hashes = word_hashes(words.strings())
    buckets = (hashes >> np.uint64(40)).astype(np.int64) % WORD_BUCKETS
    rows = words.rows
    shares = np.bincount(
        rows * WORD_BUCKETS + buckets[words.codes], minlength=len(counts) * WORD_BUCKETS
    ).reshape(len(counts), WORD_BUCKETS)
    characters = words.sums(pc.utf8_length(words.distinct).to_numpy(zero_copy_only=False))
    kinds = [
        words.sums(pc.count_substring_regex(words.distinct, c).to_numpy(zero_copy_only=False))
        / np.maximum(characters, 1)
        for c in CLASSES
    ]
    shouted = words.sums(
        pc.match_substring_regex(words.distinct, r"^\P{L}*\p{Lu}{2,}\P{L}*$").to_numpy(zero_copy_only=False)
    )
    marked = words.sums(
        pc.match_substring_regex(words.distinct, r"[#*$%&|<>!]").to_numpy(zero_copy_only=False)
    )
    own = hashes[words.codes]
    different = np.array(
        [len(np.unique(own[a:b])) for a, b in zip(words.starts.tolist(), words.starts[1:].tolist())],
        dtype=np.float64,
    )
    same = np.zeros(len(counts), dtype=np.int64)
    if len(own) > 1:
        twin = (own[1:] == own[:-1]) & (rows[1:] == rows[:-1])
        same = np.bincount(rows[1:][twin], minlength=len(counts))
    more = [
        np.log1p(counts), characters / some, shouted / some, marked / some, different / some,
        same / some, repeated_words(own, words.starts) / some, counts == 0,
    ]
    return np.column_stack(
        [shares / some[:, None], *kinds, *more, evidence.of_words(words, table)]
    ).astype(np.float32)


def meta_view(
    part: pa.RecordBatch, texts: pa.Array, evidence: Evidence, table: np.ndarray
) -> np.ndarray:
    def one_hot(column: str, buckets: int) -> np.ndarray:
        values = part.column(column).cast(pa.string()).to_pylist()
        places = [0 if v is None else 1 + xxhash.xxh3_64_intdigest(v) % (buckets - 1) for v in values]
        return np.eye(buckets, dtype=np.float32)[np.array(places, dtype=np.int64)]

    size = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(float)
    lines = pc.count_substring(texts, "\n").to_numpy(zero_copy_only=False) + 1.0
    empty = pc.count_substring(texts, "\n\n").to_numpy(zero_copy_only=False)
    more = np.column_stack(
        [np.log1p(size), np.log1p(size) ** 2, np.log(lines), np.log1p(size / lines), empty / lines]
    )
    return np.column_stack(
        [evidence.of_sources(part, table), one_hot("lang", LANG_BUCKETS), more]
    ).astype(np.float32)


def views_of(part: pa.RecordBatch, evidence: Evidence, table: np.ndarray) -> dict[str, np.ndarray]:
    texts = pc.fill_null(part.column("text"), "")
    return {"text": text_view(texts, evidence, table), "meta": meta_view(part, texts, evidence, table)}


def featured(docs: DataFrame, labels: Labels, evidence: Evidence) -> DataFrame:
    """doc_id, the two views, the targets (null if unlabelled) and ``apart`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast((labels, evidence))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels, evidence = shared.value

        def lists(matrix: np.ndarray) -> pa.Array:
            starts = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
            return pa.ListArray.from_arrays(pa.array(starts), pa.array(matrix.reshape(-1)))

        for part in slices(batches, limit=SLICE):
            targets, fold = labels.of(part.column("doc_id"))
            views = views_of(part, evidence, fold)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *(lists(views[v]) for v in VIEWS),
                 *(pa.array(own, pa.int32(), mask=own < 0) for own in targets.T),
                 pa.array((targets >= 0).any(axis=1) & (fold == 0))],
                ["doc_id", *(f"view_{v}" for v in VIEWS), *TARGETS, "apart"],
            )

    return docs.mapInArrow(
        run,
        "doc_id bigint, view_text array<float>, view_meta array<float>, good int, clean int, apart boolean",
    )


def inputs(docs: DataFrame) -> DataFrame:
    """doc_id, text, source and lang; a column that is not there is null."""
    kinds = {"doc_id": "bigint", "text": "string", "source": "string", "lang": "string"}
    return docs.select(
        *((F.col(c) if c in docs.columns else F.lit(None)).cast(k).alias(c) for c, k in kinds.items())
    )


def logistic(x: np.ndarray, weight: np.ndarray, target: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Coefficients, the constant last, of a small weighted logistic regression by Newton's steps."""
    x = np.column_stack([x, np.ones(len(x))])
    beta = np.zeros(x.shape[1])
    keep = np.diag([ridge] * (x.shape[1] - 1) + [1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + keep
        step = np.linalg.solve(hessian, x.T @ (weight * (target - p)) - keep @ beta)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return beta


@dataclass
class View:
    """The linear score of a view and its calibration."""

    weights: np.ndarray
    intercept: float
    scale: np.ndarray | None = None

    def raw(self, view: str) -> Column:
        weights = F.array(*(F.lit(float(w)) for w in self.weights))
        products = F.zip_with(F.col(f"view_{view}"), weights, lambda a, b: a.cast("double") * b)
        total = F.aggregate(products, F.lit(self.intercept), lambda a, b: a + b)
        return F.greatest(F.least(total, F.lit(LARGEST)), F.lit(-LARGEST))

    def calibrated(self, view: str) -> Column:
        return combined(self.scale, [self.raw(view)])

    def values(self, matrix: np.ndarray) -> np.ndarray:
        raw = np.clip(matrix.astype(float) @ self.weights + self.intercept, -LARGEST, LARGEST)
        return raw * self.scale[0] + self.scale[1]


@dataclass
class Model:
    """The chance of a document to be of class 1 of a target, from its two views."""

    views: dict[str, View]
    weights: np.ndarray
    limit: float = 0.5

    def column(self) -> Column:
        return probability(combined(self.weights, [bounded(v.calibrated(n)) for n, v in self.views.items()]))

    def values(self, views: dict[str, np.ndarray]) -> np.ndarray:
        scores = [np.clip(v.values(views[n]), -LARGEST, LARGEST) for n, v in self.views.items()]
        return 1 / (1 + np.exp(-(np.column_stack(scores) @ self.weights[:-1] + self.weights[-1])))


def bounded(score: Column) -> Column:
    return F.greatest(F.least(score, F.lit(LARGEST)), F.lit(-LARGEST))


def combined(beta: np.ndarray, columns: list[Column]) -> Column:
    total = F.lit(float(beta[-1]))
    for w, c in zip(beta, columns):
        total = total + F.lit(float(w)) * c
    return total


def probability(odds: Column) -> Column:
    return 1 / (1 + F.exp(-odds))


def fit_on_histogram(
    rows: DataFrame, scores: list[Column], step: float, target: str
) -> np.ndarray:
    """A logistic regression on scores rounded to ``step``: at most a fixed number of cells."""
    names = [f"s{i}" for i in range(len(scores))]
    cells = (
        rows.select(F.col(target).alias("good"), *((F.round(s / step) * step).alias(n) for s, n in zip(scores, names)))
        .groupBy("good", *names).count().toPandas()
    )
    positive = cells.loc[cells.good == 1, "count"].sum()
    negative = cells.loc[cells.good == 0, "count"].sum()
    aim = np.where(cells.good == 1, (positive + 1) / (positive + 2), 1 / (negative + 2))
    return logistic(cells[names].to_numpy(float), cells["count"].to_numpy(float), aim)


def co_train(rows: DataFrame, apart: DataFrame, rounds: int, target: str, share: float) -> Model:
    """The model of a target. ``rows``: (view_text, view_meta, target, apart), target null if unlabelled;
    ``apart``: the labelled rows that calibrate; ``share``: how many labelled rows are of class 1."""
    extra: dict[str, Column | None] = dict.fromkeys(VIEWS)
    views: dict[str, View] = {}
    for turn in range(rounds + 1):
        for view in VIEWS:
            label = F.col(target).cast("double")
            weight = F.when(label == 1, 0.5 / share).otherwise(0.5 / (1 - share))
            if extra[view] is not None:
                weight = F.when(label.isNull(), PSEUDO_WEIGHT).otherwise(weight)
                label = F.coalesce(label, extra[view])
            training = rows.filter(f"NOT apart OR {target} IS NULL").select(
                array_to_vector(f"view_{view}").alias("features"), label.alias("label"), weight.alias("weight")
            )
            # Unscaled: shares of words, which are small numbers, are held back most by the penalty.
            model = LogisticRegression(
                maxIter=20, regParam=1e-4, standardization=False, weightCol="weight"
            ).fit(training.filter("label IS NOT NULL"))
            views[view] = View(model.coefficients.toArray(), float(model.intercept))
            views[view].scale = fit_on_histogram(apart, [views[view].raw(view)], 0.01, target)
        if turn < rounds:
            for view, other in zip(VIEWS, VIEWS[::-1]):
                sure = probability(views[other].calibrated(other))
                extra[view] = F.when(sure >= CONFIDENT, 1.0).when(sure <= 1 - CONFIDENT, 0.0)
    scores = [bounded(views[v].calibrated(v)) for v in VIEWS]
    return Model(views, fit_on_histogram(apart, scores, 0.1, target))


def limit_of(apart: DataFrame, model: Model, target: str) -> float:
    """The limit below which documents are rejected: of the limits that lose at most ``LOSS`` of class 1 the one
    that catches most of class 0 and loses least, of equal ones the one nearest to 1/2; chances are counted in
    steps of 1/1000."""
    step = F.ceil(model.column() * 1000).cast("int").alias("step")
    cells = apart.groupBy(F.col(target).alias("is"), step).count().toPandas()
    below = np.zeros((2, 1002))
    for row in cells.itertuples():
        below[int(row[1]), int(row[2])] += row[3]
    totals = below.sum(axis=1)
    # A chance in (k - 1, k] thousandths is below the limit k / 1000 or equals it.
    rejected = np.cumsum(below, axis=1) / np.maximum(totals, 1)[:, None]
    allowed = rejected[1] <= LOSS
    value = np.where(allowed, rejected[0] - rejected[1], -1.0)
    best = np.flatnonzero(value >= value.max() - 1e-12)
    return float(best[np.abs(best - 500).argmin()]) / 1000


def fitted(
    docs: DataFrame, labels: DataFrame, rounds: int
) -> tuple[DataFrame, Labels, Evidence, dict[str, Model]]:
    """Stored rows (doc_id, views, targets, apart), the labels, the evidence, and a model for each target
    that can be learned."""
    own = inputs(docs)
    known = labels_of(labels)
    evidence = Evidence.learned(own, known)
    rows = store(featured(own, known, evidence), "views")
    models = {}
    for target in TARGETS:
        labelled = rows.filter(f"{target} IS NOT NULL")
        seen = labelled.groupBy(F.col(target).alias("is"), "apart").count().toPandas()
        if seen.empty or seen["is"].nunique() < 2 or seen[~seen.apart]["is"].nunique() < 2:
            continue
        apart = labelled
        if seen[seen.apart]["is"].nunique() == 2:
            apart = labelled.filter("apart")
        inside = seen[~seen.apart]
        share = inside.loc[inside["is"] == 1, "count"].sum() / inside["count"].sum()
        models[target] = co_train(rows, apart, rounds, target, float(share))
        if target == "clean":
            models[target].limit = limit_of(apart, models[target], target)
    return rows, known, evidence, models


def score_documents(docs: DataFrame, labels: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, score (chance of good quality), kept and clean_score (chance not to be toxic) for
    every row; kept asks for both."""
    rows, _, _, models = fitted(docs, labels, rounds)
    scores = {t: models[t].column() if t in models else F.lit(1.0) for t in TARGETS}
    kept = F.lit(True)
    for target, model in models.items():
        kept = kept & (scores[target] > model.limit)
    return rows.select(
        "doc_id", scores["good"].alias("score"), kept.alias("kept"), scores["clean"].alias("clean_score")
    )


def keep_good(docs: DataFrame, labels: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """The documents that are kept, with all their columns. Texts are read again, not shuffled; each row goes
    through a task once, and only kept rows come back."""
    _, *learned = fitted(docs, labels, rounds)
    shared = docs.sparkSession.sparkContext.broadcast(learned)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels, evidence, models = shared.value
        for part in slices(batches, limit=SLICE):
            chosen = [part.column(c) if c in part.schema.names else pa.nulls(part.num_rows, pa.string())
                      for c in ("text", "source", "lang")]
            views = views_of(
                pa.RecordBatch.from_arrays(chosen, ["text", "source", "lang"]), evidence,
                labels.of(part.column("doc_id").cast(pa.int64()))[1],
            )
            kept = np.ones(part.num_rows, dtype=bool)
            for model in models.values():
                kept &= model.values(views) > model.limit
            yield part.filter(pa.array(kept))

    return docs.mapInArrow(run, docs.schema)

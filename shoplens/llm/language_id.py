"""Language mixtures of documents by expectation-maximisation over n-gram likelihoods.

Training counts letter trigrams, with word borders, of all labelled texts per language, in a fixed
number of hash buckets. A word's likelihood under a language is the product of its trigrams'. A
document is a mixture of languages over its words: each round gives every word to the languages in
proportion to share times likelihood, and takes the new shares from that. Languages enter in the order
of the words they win outright; a set of k languages is scored by its log-likelihood less
k - 1 times ``PENALTY`` * ln(words), and the set grows while that rises. A document whose words all
together gain less from a second language than its penalty needs no rounds.

Null text or no letter (marks alone are none): ``und``, score 0. Without any labelled text all documents are
``und``. Ties go to the first language by name. Very long texts are a slice of their own; an empty table
gives no rows. Rows are judged each by itself, so repeated rows and null doc_ids keep
their rows; labels that are null do not train. Extra columns stay out of the result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm.words import Words, joined_lines, mix, slices, split_words

BUCKETS = 1 << 16
SMOOTHING, ROUNDS, PENALTY = 0.5, 12, 2.0
#: The model holds 4 bytes for each language and bucket: 256 KB a language.
MOST_LANGUAGES = 512
UNKNOWN = "und"


def letter_trigrams(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """The trigram buckets of each distinct word that has a letter, and the word of each bucket."""
    strings = pc.utf8_lower(words.distinct)
    strings = pc.replace_substring_regex(strings, r"[^\p{L}\p{M}]+", " ")
    points = f" {joined_lines(strings)} ".encode("utf-32-le", "surrogatepass")
    points = np.frombuffer(points, dtype="<u4").astype(np.uint64)
    if len(points) < 3:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    border = points == ord("\n")
    place = np.cumsum(border)[1:-1]
    points = np.where(border, np.uint64(32), points)
    letter = points[1:-1] != 32
    grams = (points[:-2] << np.uint64(42)) | (points[1:-1] << np.uint64(21)) | points[2:]
    return (mix(grams[letter]) >> np.uint64(48)).astype(np.int64), place[letter]


def count_trigrams(docs: DataFrame) -> DataFrame:
    """(lang, bucket, count) over all given texts; a task sends one row per language and bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for part in slices(batches):
            words = split_words(part.column("text"))
            grams, place = letter_trigrams(words)
            langs = part.column("lang").to_pylist()
            rows = words.rows
            for lang in dict.fromkeys(langs):
                own = np.array([x == lang for x in langs])
                times = np.bincount(words.codes[own[rows]], minlength=len(words.distinct))
                counts = np.bincount(grams, weights=times[place], minlength=BUCKETS)
                totals[lang] = totals.get(lang, 0) + counts
        for lang, counts in totals.items():
            used = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(used), pa.string()), pa.array(used, pa.int32()),
                 pa.array(counts[used].astype(np.int64))],
                ["lang", "bucket", "n"],
            )

    rows = docs.select("text", "lang").mapInArrow(count, "lang string, bucket int, n bigint")
    return rows.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


@dataclass
class LanguageModel:
    """Log-likelihoods of the trigram buckets, a row per language; of fixed size per language."""

    languages: list[str]
    table: np.ndarray

    @classmethod
    def fit(cls, labelled: DataFrame) -> LanguageModel:
        """From rows (text, lang) with a lang. The driver gets languages x BUCKETS counts at most."""
        distinct = labelled.select("lang").distinct()
        languages = sorted(r.lang for r in distinct.limit(MOST_LANGUAGES + 1).collect())
        if len(languages) > MOST_LANGUAGES:
            raise ValueError(f"{distinct.count()} languages; the model is made for {MOST_LANGUAGES}")
        counts = count_trigrams(labelled).toPandas()
        table = np.zeros((len(languages), BUCKETS))
        row = {lang: i for i, lang in enumerate(languages)}
        table[counts["lang"].map(row).to_numpy(int), counts["bucket"].to_numpy(int)] = counts["n"]
        table = np.log(table + SMOOTHING) - np.log(
            table.sum(axis=1, keepdims=True) + SMOOTHING * BUCKETS
        )
        return cls(languages, table.astype(np.float32))

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray, list[str]]:
        """For each text its language, the share of it, and the whole mixture as text."""
        none = [UNKNOWN] * len(texts), np.zeros(len(texts)), [""] * len(texts)
        words = split_words(texts)
        grams, place = letter_trigrams(words)
        if not self.languages or not len(grams):
            return none
        likes = np.zeros((len(words.distinct), len(self.languages)), dtype=np.float32)
        first = np.flatnonzero(np.diff(place, prepend=-1))
        likes[place[first]] = np.add.reduceat(self.table[:, grams], first, axis=1).T
        lettered = np.zeros(len(words.distinct), dtype=bool)
        lettered[place[first]] = True
        # Marks join letters; a word of marks alone has no letter.
        lettered &= pc.match_substring_regex(words.distinct, r"\p{L}").to_numpy(zero_copy_only=False)
        use = lettered[words.codes]
        if not use.any():
            return none
        codes, rows = words.codes[use], words.rows[use]
        docs, at = np.unique(rows, return_index=True)
        shares = mixtures(likes[codes], at)
        best = shares.argmax(axis=1)
        named, score, whole = none
        for k, doc in enumerate(docs.tolist()):
            named[doc] = self.languages[best[k]]
            score[doc] = shares[k, best[k]]
            whole[doc] = ",".join(
                f"{self.languages[j]}:{shares[k, j]:.3f}"
                for j in np.argsort(-shares[k], kind="stable") if shares[k, j] >= 0.0005
            )
        return named, np.clip(score, 0, 1), whole


def mixtures(likes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Shares of the languages in each document; ``at``: where its rows of ``likes`` begin."""
    counts = np.diff([*at, len(likes)])
    alone = np.add.reduceat(likes, at, axis=0).astype(np.float64)
    best = alone.argmax(axis=1)
    documents = np.arange(len(at))
    score = alone[documents, best]
    shares = np.zeros_like(alone)
    shares[documents, best] = 1.0
    if likes.shape[1] == 1:
        return shares
    top = likes.max(axis=1)
    # No mixture can be likelier than the likeliest language for each word.
    possible = np.add.reduceat(top, at) - score
    penalty = PENALTY * np.log(np.maximum(counts, 2))
    wins = np.add.reduceat((likes == top[:, None]).astype(np.float64), at, axis=0)
    wins[documents, best] = np.inf
    order = np.argsort(-wins, axis=1, kind="stable")
    open_ = np.flatnonzero(possible > penalty)
    for k in range(2, likes.shape[1] + 1):
        if not len(open_):
            break
        chosen = order[open_, :k]
        which = np.repeat(np.arange(len(open_)), counts[open_])
        starts = np.cumsum(counts[open_]) - counts[open_]
        rows = np.repeat(at[open_] - starts, counts[open_]) + np.arange(len(which))
        some = np.take_along_axis(likes[rows], chosen[which], axis=1)
        peak = some.max(axis=1)
        some = np.exp(some - peak[:, None])
        part = np.take_along_axis(wins[open_], chosen, axis=1)
        part[:, 0] = np.maximum(counts[open_] - part[:, 1:].sum(axis=1), 1)
        part = (part + 0.5) / (part + 0.5).sum(axis=1, keepdims=True)
        for _ in range(ROUNDS):
            weight = some * part[which].astype(np.float32)
            total = weight.sum(axis=1)
            part = np.add.reduceat(weight / total[:, None], starts, axis=0) / counts[open_][:, None]
        total = (some * part[which].astype(np.float32)).sum(axis=1)
        found = np.add.reduceat(np.log(np.maximum(total, 1e-30)) + peak, starts).astype(np.float64)
        found -= (k - 1) * penalty[open_]
        better = found > score[open_]
        open_, chosen, part = open_[better], chosen[better], part[better]
        score[open_] = found[better]
        shares[open_] = 0.0
        shares[open_[:, None], chosen] = part
    return shares


def predict_languages(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, lang_pred, score and the mixture of every row."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # MOST_LANGUAGES bounds it

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, limit=max(1 << 19, (16 << 20) // max(4, len(shared.value.languages)))):
            named, score, whole = shared.value.predict(part.column("text"))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(named, pa.string()),
                 pa.array(score, pa.float64()), pa.array(whole, pa.string())],
                ["doc_id", "lang_pred", "score", "mixture"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id bigint, lang_pred string, score double, mixture string"
    )


def held_out_predictions(docs: DataFrame) -> DataFrame:
    """Learn from three quarters of the documents by the checksum of doc_id, predict all."""
    rest = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4
    labelled = docs.filter((rest != 2) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    model = LanguageModel.fit(labelled.select("text", "lang"))
    predicted = predict_languages(docs, model)
    return predicted.select("doc_id", (rest == 2).alias("held_out"), "lang_pred", "score", "mixture")

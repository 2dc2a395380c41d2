"""Quality rules by host: documents are measured, rule failures are counted per host, failure rates
are shrunk with an empirical beta prior, and the host verdicts are joined back to the documents.

For each rule the prior is fitted to all hosts: its mean is the overall failure rate, its strength
comes from the spread of the host rates beyond what chance gives (the analysis-of-variance estimate
of the beta-binomial correlation). A host's shrunk rate is (alpha + failures) / (alpha + beta + documents),
so one bad document does not condemn a small host. Verdict on a document:

* it fails when it breaks a base rule (short, repeated);
* it fails when the shrunk rate of any rule of its host is above ``REJECT``;
* it fails when it breaks another rule at whose breaking its host is known: a shrunk rate of at least
  ``KNOWN``. A host that hardly ever breaks a rule is forgiven the odd document.

Null or empty text: no words, so it is short. A null source is the host of empty name. Rows are
judged each by itself, so repeated rows and null doc_ids keep their rows. Extra columns stay out of
the result. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.llm.words import mix, slices, split_words, window_hashes, word_hashes
from shoplens.sources.stages import store

REJECT, KNOWN = 0.5, 0.01
LOOSEST = 1e-4  # the least correlation of a prior: a strength of at most 9,999 documents
MEASURES = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint, n_lines bigint"
)
#: Each rule as SQL over the measures; the first two are the base rules.
RULES = {
    "short": "n_words < 50",
    "repeated": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "dup_lines": "10 * n_dup_lines > 3 * n_lines",
    "word_length": "word_chars < 2 * n_words OR word_chars > 12 * n_words",
}
BASE = ("short", "repeated")


def repeated_words(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each text, its words in windows of three words that stand in it twice or more.

    Windows are compared by 64-bit hashes of their words and their text.
    """
    counts = np.diff(starts)
    rows = np.repeat(np.arange(len(counts)), counts)
    if len(hashes) < 3:
        return np.zeros(len(counts), dtype=np.int64)
    inside = rows[2:] == rows[:-2]
    windows = mix(window_hashes(hashes, 3) + rows[2:].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    ordered = np.sort(windows[inside])
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    covered = np.zeros(len(hashes), dtype=bool)
    if len(twice):
        places = np.minimum(np.searchsorted(twice, windows), len(twice) - 1)
        found = np.flatnonzero((twice[places] == windows) & inside)
        for k in range(3):
            covered[found + k] = True
    return np.bincount(rows[covered], minlength=len(counts))


def line_counts(text: str) -> tuple[int, int]:
    """Lines with a word, and how many of them equal an earlier line."""
    lines = [x for x in text.split("\n") if x.strip(" \t\x0b\x0c\r")]
    return len(lines), len(lines) - len(set(lines))


def measure(texts: pa.Array) -> list[pa.Array]:
    """The columns of ``MEASURES`` for each text."""
    texts = pc.fill_null(texts, "")
    words = split_words(texts)
    lengths = pc.utf8_length(words.distinct).to_numpy(zero_copy_only=False)
    hashes = word_hashes(words.strings())[words.codes]
    symbols = pc.count_substring_regex(words.distinct, r"[#*$%&|<>]")
    lines = [line_counts(text) for text in texts.to_pylist()]
    columns = [
        words.counts,
        words.sums(lengths),
        words.sums(symbols.to_numpy(zero_copy_only=False)),
        [b for _, b in lines],
        repeated_words(hashes, words.starts),
        [a for a, _ in lines],
    ]
    return [pa.array(c, pa.int64()) for c in columns]


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, host and the measures of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [m.split()[0] for m in MEASURES.split(", ")]
        for part in slices(batches):
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("host"), *measure(part.column("text"))],
                ["doc_id", "host", *names],
            )

    host = F.coalesce(F.col("source").cast("string"), F.lit("")).alias("host")
    return docs.select("doc_id", host, "text").mapInArrow(
        run, f"doc_id bigint, host string, {MEASURES}"
    )


def host_rates(measures: DataFrame) -> DataFrame:
    """(host, rule, documents, failures, rate): the shrunk failure rate of each rule."""
    hosts = measures.groupBy("host").agg(
        F.count(F.lit(1)).alias("n"),
        *(F.sum(F.expr(f"CAST({rule} AS bigint)")).alias(name) for name, rule in RULES.items()),
    )
    stacked = ", ".join(f"'{name}', `{name}`" for name in RULES)
    long = hosts.select("host", "n", F.expr(f"stack({len(RULES)}, {stacked}) AS (rule, f)"))
    n, f = F.col("n").cast("double"), F.col("f").cast("double")
    sums = long.groupBy("rule").agg(
        F.count(F.lit(1)).cast("double").alias("hosts"), F.sum(n).alias("docs"),
        F.sum(f).alias("fails"), F.sum(n * n).alias("squares"),
        F.sum(f * f / n).alias("between"), F.sum(f * (1 - f / n)).alias("within"),
    )
    mean = F.col("fails") / F.col("docs")
    one_less = F.greatest(F.col("hosts") - 1, F.lit(1.0))
    size = (F.col("docs") - F.col("squares") / F.col("docs")) / one_less
    between = (F.col("between") - F.col("docs") * mean * mean) / one_less
    within = F.col("within") / F.greatest(F.col("docs") - F.col("hosts"), F.lit(1.0))
    spread = between + (size - 1) * within
    linked = F.when(spread > 0, (between - within) / spread).otherwise(0.0)
    linked = F.greatest(F.least(linked, F.lit(0.5)), F.lit(LOOSEST))
    prior = sums.select("rule", mean.alias("mean"), (1 / linked - 1).alias("strength"))
    # One row per rule, so this side has as many rows as RULES, whatever the data.
    return long.join(F.broadcast(prior), "rule").select(
        "host", "rule", F.col("n").alias("documents"), F.col("f").alias("failures"),
        ((F.col("mean") * F.col("strength") + f) / (F.col("strength") + n)).alias("rate"),
    )


def host_verdicts(rates: DataFrame, reject: float = REJECT, known: float = KNOWN) -> DataFrame:
    """One row per host: host_rejected, and for each further rule whether the host is known for it."""
    extra = [name for name in RULES if name not in BASE]
    return rates.groupBy("host").agg(
        (F.max("rate") > reject).alias("host_rejected"),
        *(
            F.max(F.when(F.col("rule") == name, F.col("rate") >= known)).alias(f"known_{name}")
            for name in extra
        ),
    )


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def judge(docs: DataFrame, reject: float = REJECT, known: float = KNOWN) -> DataFrame:
    """doc_id, the measures, base_failed, host_rejected and kept."""
    measures = store(measured(docs), "measures")
    verdicts = store(host_verdicts(host_rates(measures), reject, known), "host-verdicts")
    extra = [name for name in RULES if name not in BASE]
    base = any_of([F.expr(RULES[name]) for name in BASE])
    broken = any_of([F.expr(RULES[name]) & F.col(f"known_{name}") for name in extra])
    return measures.join(verdicts, "host", "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"), "host_rejected",
        (~base & ~F.col("host_rejected") & ~broken).alias("kept"),
    )

"""Spelling variants: k-d trees over letter-count vectors find all words one edit apart.

One edit changes the letter counts of a word by little: a replaced letter takes one from one letter and
gives one to another (distance two), an inserted letter gives one (distance one). So the words of each
length are a k-d tree over their letter counts, and a word is looked up in the trees of its own length
and of the lengths next to it, entering only boxes that it can reach with one unit down and one unit up
(same length), one up (longer) or one down (shorter). What shares a last box is verified letter by letter.

The top of the trees is built by Spark, a level of all trees at a time: words per (box, letter, count),
the most even split of each box, until a box holds at most ``BOX`` words. A second pass sends each word to
the boxes it can reach; a box and what is sent to it are one group, in which numpy carries the tree on to
leaves of ``LEAF`` words. A box is never larger than ``BOX``: words with the very same counts that no split
can part are dealt out by hash and every visitor goes to each part; a box with more than ``VISITORS``
visitors is copied and they are dealt out. Groups return one row per visitor (how many near words, the
best of them), so no list of pairs is made, however many words are near each other.

A word's form is its near word of largest count, if that is at least ``FACTOR`` times its own. Roots
follow forms by pointer doubling: counts grow by ``FACTOR`` at each step, so the rounds are few.

Words with the same count: the form is the smallest in code-point order. Null or empty text: no words. A
null doc_id counts as an empty name in the checksum. Repeated rows count as often as they stand. Very
long runs are words like any other; texts are cut into slices of a few MB by rows, never inside one.
Extra columns stay out; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.llm.words import from_raw, raw_texts, slices, split_words
from shoplens.sources.stages import store

LEAST_LENGTH, LEAST_COUNT, FACTOR = 6, 5, 5
BOX, VISITORS, LEAF = 4096, 1 << 18, 24
EVERY = 199  # of the runs of a document one in EVERY loses a letter
CELLS = 1 << 20  # letters compared at a time
SLICE = 2 << 20  # bytes of text whose words are counted at a time, one text at least


# ---- words ---------------------------------------------------------------------------------------


def letter_runs(texts: pa.Array) -> pa.Array:
    """The texts with A-Z in lower case and a space for all but A-Z, a-z and U+00C0 to U+00FF.

    In UTF-8 the latter are the two-byte characters that begin with byte C3.
    """
    raw, starts = raw_texts(texts)
    lead, low = raw == 0xC3, raw | 0x20
    kept = lead.copy()
    kept[1:] |= lead[:-1]
    letter = (low >= 97) & (low <= 122) & (raw < 128)
    out = np.where(letter, low, np.where(kept, raw, 0x20)).astype(np.uint8)
    return from_raw(out.tobytes(), starts)


def edited(run: str, checksum: int) -> str:
    """The run, without one letter if EVERY divides the checksum of ``<doc_id>:<run>``."""
    if checksum % EVERY:
        return run
    place = checksum % len(run)
    return run[:place] + run[place + 1 :]


def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n) of each slice."""
    for part in slices(batches, limit=SLICE):
        words = split_words(letter_runs(part.column("text")))
        runs = words.strings()
        raw = [run.encode() for run in runs]
        long = np.fromiter((len(run) >= LEAST_LENGTH for run in runs), bool, len(runs))
        kept = long[words.codes]
        rows, codes = words.rows[kept], words.codes[kept]
        # One number for each (document, run) that occurs, and how often.
        pairs, times = np.unique(rows * max(len(runs), 1) + codes, return_counts=True)
        owner, code = np.divmod(pairs, max(len(runs), 1))
        totals = np.bincount(code, times, minlength=len(runs)).astype(np.int64)
        extra: dict[str, int] = {}
        bounds = np.searchsorted(owner, np.arange(part.num_rows + 1)).tolist()
        for doc, a, b in zip(part.column("doc_id").to_pylist(), bounds, bounds[1:]):
            name = b":" if doc is None else b"%d:" % doc
            start = zlib.crc32(name)
            for at, c in enumerate(code[a:b].tolist(), a):
                checksum = zlib.crc32(raw[c], start)
                if checksum % EVERY == 0:
                    totals[c] -= times[at]
                    word = edited(runs[c], checksum)
                    if len(word) >= LEAST_LENGTH:
                        extra[word] = extra.get(word, 0) + int(times[at])
        some = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays(
            [pa.array([*(runs[c] for c in some.tolist()), *extra], pa.string()),
             pa.array([*totals[some].tolist(), *extra.values()], pa.int64())],
            ["word", "n"],
        )


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n, length) of the distinct words that are long and frequent enough."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return (
        rows.mapInArrow(counted, "word string, n bigint")
        .groupBy("word").agg(F.sum("n").alias("n"))
        .filter(F.col("n") >= LEAST_COUNT)
        .withColumn("length", F.char_length("word"))
    )


# ---- tops of the trees -----------------------------------------------------------------------------


def times(letter: Column) -> Column:
    """How often the letter stands in the word."""
    return F.char_length("word") - F.char_length(F.replace(F.col("word"), letter, F.lit("")))


def best_splits(words: DataFrame, box: int) -> DataFrame:
    """(node, letter, least): the most even split of each node with more than ``box`` words; words with
    ``least`` of the letter or more go right. Nodes whose words have all the same counts give no row."""
    sizes = words.groupBy("node").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > box)
    letters = F.explode(F.array_distinct(F.split("word", ""))).alias("letter")
    # All words are counted, those of small boxes too: sorting these out first would deal the words by box.
    cells = (
        words.select("node", "word", letters).filter("letter <> ''")
        .groupBy("node", "letter", times(F.col("letter")).alias("least"))
        .agg(F.count(F.lit(1)).alias("here"))
    )
    # Words with ``least`` or more of the letter: a running total over the few counts of one letter.
    upward = (
        cells.groupBy("node", "letter").agg(F.collect_list(F.struct("least", "here")).alias("cells"))
        .select("node", "letter", F.explode(F.transform("cells", lambda c: F.struct(
            c.least.alias("least"),
            F.aggregate(F.filter("cells", lambda o: o.least >= c.least), F.lit(0).cast("bigint"),
                        lambda total, o: total + o.here).alias("right")))).alias("cut"))
        .select("node", "letter", "cut.*")
    )
    even = F.least("right", F.col("size") - F.col("right"))
    return (
        upward.join(sizes, "node").withColumn("even", even).filter("even > 0")
        .groupBy("node")
        .agg(F.max(F.struct("even", "letter", "least")).alias("best"))
        .select("node", "best.letter", "best.least")
    )


def grown(words: DataFrame, box: int) -> tuple[DataFrame, list[DataFrame]]:
    """The words with their last ``node``, and the splits of each level."""
    level = words.withColumn("node", F.col("length").cast("string"))
    levels: list[DataFrame] = []
    done: list[DataFrame] = []
    while True:
        splits = store(best_splits(level, box), f"splits-{len(levels)}")
        joined = level.join(splits, "node", "left")
        done.append(joined.filter("letter IS NULL").select(*level.columns))
        if splits.isEmpty():
            break
        levels.append(splits)
        side = F.when(times(F.col("letter")) >= F.col("least"), "1").otherwise("0")
        parted = joined.filter("letter IS NOT NULL").withColumn("node", F.concat("node", F.lit("/"), side))
        level = store(parted.select(*level.columns), f"words-{len(levels)}")
    leaves = done[0]
    for more in done[1:]:
        leaves = leaves.unionByName(more)
    return leaves, levels


def routed(words: DataFrame, lengths: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """(word, length, up, down, node): every last box that a word can reach with one edit.

    ``up`` and ``down`` are the units it may still gain and lose; a box that asks for more is left out.
    """
    aims = F.explode(F.array(*(
        F.struct((F.col("length") + step).cast("string").alias("node"), F.lit(up).alias("up"), F.lit(down).alias("down"))
        for step, up, down in ((-1, 0, 1), (0, 1, 1), (1, 1, 0))
    ))).alias("aim")
    rows = words.select("word", aims).select("word", "aim.*").join(lengths, "node", "left_semi")
    ended: DataFrame | None = None
    for splits in levels:
        met = rows.join(splits, "node", "left")
        own = times(F.col("letter"))
        gain, loss = F.col("least") - own, own - F.col("least") + 1
        right = F.when(gain <= F.col("up"), F.struct(
            F.concat("node", F.lit("/1")).alias("node"), (F.col("up") - F.greatest(gain, F.lit(0))).alias("up"), "down"))
        left = F.when(loss <= F.col("down"), F.struct(
            F.concat("node", F.lit("/0")).alias("node"), "up", (F.col("down") - F.greatest(loss, F.lit(0))).alias("down")))
        stay = F.when(F.col("letter").isNull(), F.array(F.struct("node", "up", "down")))
        nexts = F.coalesce(stay, F.array_compact(F.array(left, right)))
        rows = met.select("word", F.explode(nexts).alias("at")).select("word", "at.*")
    return rows.select("word", "node")


# ---- boxes -----------------------------------------------------------------------------------------


def letters_of(words: list[str]) -> np.ndarray:
    """A row of letters for each word; all words are of one length, their letters below U+0100."""
    return np.frombuffer("".join(words).encode("latin-1"), dtype=np.uint8).reshape(len(words), -1)


def counts_of(letters: np.ndarray, alphabet: np.ndarray) -> np.ndarray:
    """How often each letter of the alphabet stands in each word."""
    size = len(alphabet) + 1
    place = np.searchsorted(alphabet, letters)
    place[alphabet[np.minimum(place, len(alphabet) - 1)] != letters] = len(alphabet)
    cells = place + np.arange(len(letters))[:, None] * size
    return np.bincount(cells.ravel(), minlength=len(letters) * size).reshape(-1, size)[:, :-1]


def near(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Which pairs (a row of ``one``, a row of ``two``) are exactly one edit apart, by letter order."""
    short, long = one.shape[1], two.shape[1]
    if short > long:
        return near(two, one).T
    if short == long:
        return (one[:, None, :] != two[None, :, :]).sum(axis=2) == 1
    ahead = np.logical_and.accumulate(one[:, None, :] == two[None, :, :-1], axis=2).sum(axis=2)
    back = one[:, None, ::-1] == two[None, :, :0:-1]
    return ahead + np.logical_and.accumulate(back, axis=2).sum(axis=2) >= short


def halves(one: np.ndarray, two: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs one edit apart among many words with the same counts: one edit leaves the first half or
    the second half of the shorter word as it is, so words are met by either half."""
    short, long = min(one.shape[1], two.shape[1]), max(one.shape[1], two.shape[1])
    half = short // 2
    fronts = one[:, :half], two[:, :half]
    backs = one[:, one.shape[1] - (short - half) :], two[:, two.shape[1] - (short - half) :]
    for turn, (a, b) in enumerate((fronts, backs)):
        key_a, key_b = ([r.tobytes() for r in np.ascontiguousarray(x)] for x in (a, b))
        where: dict[bytes, list[int]] = {}
        for j, key in enumerate(key_b):
            where.setdefault(key, []).append(j)
        for i, key in enumerate(key_a):
            found = np.array(where.get(key, ()), dtype=np.int64)
            if turn and len(found):  # met already by the first half
                found = found[(fronts[1][found] != fronts[0][i]).any(axis=1)]
            for at in range(0, len(found), max(CELLS // long, 1)):
                some = found[at : at + max(CELLS // long, 1)]
                some = some[near(one[i : i + 1], two[some])[0]]
                if len(some):
                    yield np.full(len(some), i), some


def search(
    one: np.ndarray, two: np.ndarray, gain: int, loss: int, leaf: int = LEAF
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(i, j): row i of ``one`` is one edit from row j of ``two``; a k-d tree over the letter counts of
    ``two``, entered by the rows of ``one`` that reach a box with ``gain`` units up and ``loss`` down."""
    alphabet = np.unique(two)
    mine, theirs = counts_of(one, alphabet), counts_of(two, alphabet)
    width = max(one.shape[1], two.shape[1])
    work = [(np.arange(len(one)), np.full(len(one), gain), np.full(len(one), loss), np.arange(len(two)))]
    while work:
        visitors, up, down, inside = work.pop()
        if not len(visitors):
            continue
        if len(inside) <= leaf:
            step = max(CELLS // (len(inside) * width), 1)
            for at in range(0, len(visitors), step):
                some = visitors[at : at + step]
                i, j = np.nonzero(near(one[some], two[inside]))
                if len(i):
                    yield some[i], inside[j]
            continue
        counts = theirs[inside]
        best, letter, least = 0, -1, 0
        for value in np.unique(counts)[1:] if counts.min() == 0 else np.unique(counts):
            right = (counts >= value).sum(axis=0)
            even = np.minimum(right, len(inside) - right)
            if even.max() > best:
                best, letter, least = int(even.max()), int(even.argmax()), int(value)
            if best * 2 >= right.max():
                break  # higher counts part off still fewer words
        if not best:
            for i, j in halves(one[visitors], two[inside]):
                yield visitors[i], inside[j]
            continue
        goes = counts[:, letter] >= least
        own = mine[visitors, letter]
        lacks, spare = np.maximum(least - own, 0), np.maximum(own - least + 1, 0)
        enter = lacks <= up
        work.append((visitors[enter], (up - lacks)[enter], down[enter], inside[goes]))
        enter = spare <= down
        work.append((visitors[enter], up[enter], (down - spare)[enter], inside[~goes]))


def box_matches(group: pa.Table) -> pa.Table:
    """(word, n_near, best_n, best) of each visitor of one box: how many words of the box are near and
    the one of largest count, of equal ones the smallest."""
    home = pc.is_valid(group["n"])
    own, guests = group.filter(home), group.filter(pc.invert(home))["word"].combine_chunks()
    inside, n = own["word"].to_pylist(), own["n"].to_numpy()
    out = []
    if inside:
        two = letters_of(inside)
        # Rank by count, largest first, then by code points: the best of several is the least rank.
        ranked = sorted(range(len(inside)), key=lambda j: (-n[j], inside[j]))
        rank = np.empty(len(inside), dtype=np.int64)
        rank[ranked] = np.arange(len(inside))
        size = pc.utf8_length(guests)
        for length, gain, loss in ((two.shape[1] - 1, 1, 0), (two.shape[1], 1, 1), (two.shape[1] + 1, 0, 1)):
            words = guests.filter(pc.equal(size, length)).to_pylist()
            if not words:
                continue
            many, best = np.zeros(len(words), dtype=np.int64), np.full(len(words), len(inside))
            for i, j in search(letters_of(words), two, gain, loss):
                many += np.bincount(i, minlength=len(words))
                np.minimum.at(best, i, rank[j])
            for i in np.flatnonzero(many).tolist():
                j = ranked[best[i]]
                out.append((words[i], int(many[i]), int(n[j]), inside[j]))
    columns = zip(*out) if out else [[]] * 4
    kinds = pa.string(), pa.int64(), pa.int64(), pa.string()
    return pa.table(
        [pa.array(c, k) for c, k in zip(columns, kinds)], names=["word", "n_near", "best_n", "best"]
    )


def near_words(words: DataFrame, box: int = BOX, visitors: int = VISITORS) -> DataFrame:
    """word, n_near, best_n, best of every word with a near word; ``words``: (word, n, length)."""
    home, levels = grown(words, box)
    home = store(home.select("word", "n", "node"), "boxes")
    lengths = words.select(F.col("length").cast("string").alias("node")).distinct()
    guests = store(routed(words, lengths, levels), "visitors")
    sizes = home.groupBy("node").agg(F.ceil(F.count(F.lit(1)) / box).cast("int").alias("home_parts"))
    sizes = sizes.join(
        guests.groupBy("node").agg(F.ceil(F.count(F.lit(1)) / visitors).cast("int").alias("guest_parts")), "node"
    )
    sizes = store(sizes, "box-parts")

    def part(parts: str) -> Column:
        return F.pmod(F.xxhash64("word"), F.col(parts)).cast("int")

    def every(parts: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(parts) - 1))

    one = home.join(sizes, "node").select(
        "node", "word", "n", part("home_parts").alias("x"), every("guest_parts").alias("y")
    )
    two = guests.join(sizes, "node").select(
        "node", "word", F.lit(None).cast("bigint").alias("n"), every("home_parts").alias("x"),
        part("guest_parts").alias("y"),
    )
    found = (
        one.unionByName(two).groupBy("node", "x", "y")
        .applyInArrow(box_matches, "word string, n_near bigint, best_n bigint, best string")
    )
    best = F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("first")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select(
        "word", "n_near", (-F.col("first.less")).alias("best_n"), F.col("first.best").alias("best")
    )


# ---- forms and roots -------------------------------------------------------------------------------


def rooted(forms: DataFrame) -> DataFrame:
    """(word, root) of every row of ``forms`` (word, form): forms followed to the last."""
    current = store(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        after = current.select(F.col("word").alias("root"), F.col("root").alias("next"))
        met = current.join(after, "root", "left")
        current = store(met.select("word", F.coalesce("next", "root").alias("root"), "next"), "roots")
        if current.filter("next IS NOT NULL").isEmpty():
            return current.select("word", "root")
        current = current.select("word", "root")


def spelling_variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word."""
    words = store(vocabulary(docs), "vocabulary")
    found = words.join(near_words(words), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        *(F.when(F.col("best_n") >= FACTOR * F.col("n"), F.col(a)).alias(b)
          for a, b in (("best", "form"), ("best_n", "form_n"))),
    )
    found = store(found, "forms")
    roots = rooted(found.filter("form IS NOT NULL"))
    return found.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )

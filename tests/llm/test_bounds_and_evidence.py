"""Learned evidence against plain counts, and operators on inputs that used to take too much time or memory."""

import math
import random
import time
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from shoplens.llm import line_dedup, near_dedup, packing, quality_classifier as qc, secrets, tokens

BIG = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def labelled(spark):
    draw, rows, labels = random.Random(4), [], []
    for i in range(900):
        toxic = i % 9 == 0
        words = [f"w{draw.randint(0, 400)}" for _ in range(60)] + ["Vile!"] * toxic + [f"scumm{draw.randint(0, 99)}"] * toxic
        draw.shuffle(words)
        rows.append((i, " ".join(words) if i % 100 else None, "en", f"s{i % 40}" if i % 7 else None))
        labels.append((i, int(i % 5 > 0), int(toxic)))
    return (
        spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(4),
        spark.createDataFrame([r for r in labels if r[0] % 4], "doc_id long, quality int, toxic int"),
    )


def test_evidence_equals_plain_counts(labelled):
    docs, known = labelled
    labels = qc.labels_of(known)
    found = qc.Evidence.learned(qc.inputs(docs), labels)
    part = {}
    for r in known.collect():
        draw = zlib.crc32(str(r.doc_id).encode())
        part[r.doc_id] = (0 if draw % qc.APART == 0 else 1 + draw // qc.APART % qc.FOLDS, 1 - r.toxic)
    texts = {r.doc_id: (r.text, r.source) for r in docs.collect()}
    for table in (0, 2):
        counts, sources, sizes = [Counter(), Counter()], [Counter(), Counter()], [0, 0]
        for doc, (fold, clean) in part.items():
            if fold in (0, table):
                continue
            sizes[clean] += 1
            held = set()
            for word in (texts[doc][0] or "").split():
                word = word.strip(qc.TRIMMED).lower()
                held |= {qc.place_of(word), *([qc.place_of(" " + word[:4])] if len(word) > 4 else [])}
            counts[clean].update(held)
            source = texts[doc][1]
            sources[clean][qc.PLACES - 1 if source is None else qc.place_of(source)] += 1
        expected = np.zeros(qc.PLACES)
        for place in counts[0] | counts[1]:
            bad, good = counts[0][place] + 0.5, counts[1][place] + 0.5
            odds = math.log(bad / (sizes[0] + 1)) - math.log(good / (sizes[1] + 1))
            if abs(odds) > qc.CERTAIN * math.sqrt(1 / bad + 1 / good):
                expected[place] = odds
        own = np.zeros(qc.PLACES)
        own[found.words.places] = found.words.values[:, qc.TARGETS.index("clean"), table]
        assert np.allclose(own, expected, atol=1e-5)
        assert own[qc.place_of("vile")] > 0 and own[qc.place_of(" scum")] > 0
        base = (sizes[0] + 1) / (sum(sizes) + 2)
        for place in sources[0] | sources[1]:
            rate = (sources[0][place] + 10 * base) / (sources[0][place] + sources[1][place] + 10)
            value = math.log(rate / (1 - rate)) - math.log(base / (1 - base))
            at = found.sources.find(np.array([place]))[0]
            own = found.sources.values[at, qc.TARGETS.index("clean"), table] if at >= 0 else 0
            assert own == pytest.approx(value, abs=1e-5)


def test_kept_documents_are_those_scored_as_kept(labelled):
    docs, known = labelled
    kept = {r.doc_id for r in qc.score_documents(docs, known).collect() if r.kept}
    out = qc.keep_good(docs, known)
    assert out.columns == docs.columns and {r.doc_id for r in out.collect()} == kept
    toxic = {r.doc_id for r in docs.collect() if r.text and "Vile!" in r.text}
    assert not kept & toxic and len(kept) > 500


def test_toxic_documents_of_the_table_are_caught(spark):
    """Held-out labels: most toxic documents of good quality are rejected, few clean ones are."""
    docs, labels = (spark.read.parquet(f"{BIG}/{t}.parquet") for t in ("documents", "labels"))
    kept = {r.doc_id: r.kept for r in qc.score_documents(docs, labels.filter("doc_id % 3 <> 0")).collect()}
    held = labels.filter("doc_id % 3 = 0 AND quality = 1").collect()
    toxic = [kept[r.doc_id] for r in held if r.toxic]
    clean = [kept[r.doc_id] for r in held if not r.toxic]
    assert len(toxic) > 100 and toxic.count(False) >= 0.85 * len(toxic)
    assert clean.count(False) <= 0.02 * len(clean)


# ---- packing -------------------------------------------------------------------------------------


def dense_differencing(sizes, k):
    """Largest sums of the partitions with all k windows written out."""
    parts = [[0] * (k - 1) + [s] for s in sizes]
    while len(parts) > 1:
        parts.sort(key=lambda p: p[0] - p[-1])
        one, two = parts[0], parts[1]
        parts = parts[2:] + [sorted(a + b for a, b in zip(one, reversed(two)))]
    return parts[0]


def test_sparse_partitions_equal_dense_ones():
    draw = random.Random(8)
    for k in (2, 3, 7):
        for _ in range(40):
            sizes = draw.sample(range(1, 10**6), draw.randint(k, 25))  # without ties
            windows = packing.differencing(sizes, k)
            assert sorted(i for w in windows for i in w) == list(range(len(sizes)))
            sums = sorted(sum(sizes[i] for i in w) for w in windows)
            assert [0] * (k - len(sums)) + sums == dense_differencing(sizes, k)


def test_many_very_short_rests_take_little_memory():
    tracemalloc.start()
    windows = packing.pack([1] * packing.RESTS, 4096)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(windows) == packing.RESTS // 4096 and peak < 60 << 20


def test_empty_and_half_long_documents_fill_their_windows(spark):
    library = Tokenizer.from_file(tokens.word_bpe_path())
    half = " ".join(["the"] * 2100)
    assert len(library.encode(half, add_special_tokens=False).ids) == 2100
    rows = [(i, None) for i in range(30_000)] + [(30_000 + i, half) for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    pieces = packing.pack_documents(frame, tokens.word_bpe_path()).collect()
    used = Counter()
    for p in pieces:
        used[p.sequence_id] += p.length
    assert max(used.values()) <= 4096 and sum(used.values()) == 30_000 + 300 * 2101
    assert sum(used.values()) >= 0.9 * 4096 * len(used)
    ids = np.array([*library.encode(half, add_special_tokens=False).ids, 2], dtype="<u4")
    spans = {}
    for p in pieces:
        if p.doc_id >= 30_000:
            assert p.ids_crc32 == zlib.crc32(ids[p.start : p.start + p.length]) and p.doc_tokens == 2101
            spans.setdefault(p.doc_id, []).append((p.start, p.start + p.length))
    assert all(b[0] == a[1] for s in spans.values() for a, b in zip(sorted(s), sorted(s)[1:]))


def test_word_cache_is_bounded_inside_a_slice(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE", 20_000)
    encoder = tokens.LibraryEncoder(tokens.word_bpe_path())
    text = " ".join(f"w{i}x" for i in range(5_000))
    ids, starts = encoder.texts(pa.array([text, text]))
    assert len(encoder.known) < 200
    library = Tokenizer.from_file(tokens.word_bpe_path())
    assert ids[: starts[1]].tolist() == library.encode(text, add_special_tokens=False).ids


# ---- secrets -------------------------------------------------------------------------------------


def plain_nested(found, more):
    for a, b, kind in more:
        if not any(x <= a and b <= y for x, y, _ in found):
            found = [s for s in found if not (a <= s[0] and s[1] <= b)] + [(a, b, kind)]
    return sorted(found)


def test_nested_spans_equal_the_plain_comparison():
    draw = random.Random(3)

    def spans(kind):
        ends = sorted(draw.sample(range(60), 2 * draw.randint(0, 8)))
        return [(a, b, kind) for a, b in zip(ends[::2], ends[1::2])]

    for _ in range(500):
        found = []
        for kind in "abcd":
            more = spans(kind)
            assert secrets.without_nested(found, more) == plain_nested(found, more)
            found = plain_nested(found, more)


def test_added_spans_inside_a_pattern_are_left_out():
    draw = random.Random(5)
    for _ in range(60):
        text = " ".join(
            draw.choice(["token={}", "{}", "x {}/y", "AKIA{}"]).format("".join(draw.choices("abcdefXYZ0189+/", k=draw.randint(5, 60))))
            for _ in range(12)
        )
        base, found = secrets.find_secrets(text)
        added = [s for s in secrets.entropy_spans(text) if not any(b[0] <= s[0] and s[1] <= b[1] for b in base)]
        assert sorted(found) == sorted(base + added)


def test_long_logs_take_time_in_proportion():
    draw = random.Random(1)
    text = " ".join(f'token="{draw.getrandbits(80):x}ab"' for _ in range(40_000))
    run = "".join(draw.choices("abcdefghijklmnopqrstuvwxyzABCDEF0123456789/+", k=1_000_000))
    start = time.perf_counter()
    assert len(secrets.find_secrets(text)[0]) == 40_000 and secrets.find_secrets(run)[1]
    assert time.perf_counter() - start < 30


# ---- workers -------------------------------------------------------------------------------------


class Rows:
    """In the place of a frame: ``mapInArrow`` returns the function that a task would run."""

    def select(self, *columns):
        return self

    def mapInArrow(self, function, schema):
        return function


@pytest.fixture(scope="module")
def long_batch():
    """Six megabytes of text, as one batch."""
    draw = random.Random(6)
    texts = [" ".join(f"w{draw.randint(0, 20_000)}" for _ in range(1_000)) for _ in range(1_000)]
    return pa.RecordBatch.from_arrays([pa.array(range(1_000), pa.int64()), pa.array(texts)], ["doc_id", "text"])


@pytest.mark.parametrize("step", [
    lambda rows: near_dedup.signatures(rows, 5), lambda rows: line_dedup.line_keys(rows, 10), secrets.scan,
])
def test_a_task_holds_little_beside_its_batch(spark, long_batch, step):
    run = step(Rows())
    tracemalloc.start()
    seen = [batch.num_rows for batch in run(iter([long_batch]))]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(seen) >= long_batch.num_rows and max(seen) < long_batch.num_rows / 3 and peak < 16 << 20


def test_packing_leaves_no_words_to_the_next_stage(long_batch):
    run = packing.pack_documents(Rows(), tokens.word_bpe_path())
    pieces = sum(batch.num_rows for batch in run(iter([long_batch])))
    model = tokens.encoder(tokens.word_bpe_path(), packing.WORDS)
    assert pieces >= long_batch.num_rows and not model.known and not model.held

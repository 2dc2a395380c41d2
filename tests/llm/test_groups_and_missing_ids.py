"""Near duplicates in large groups against brute force, and many rows without a doc_id."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shoplens.llm import fingerprints, line_dedup, near_dedup, token_files, tokens


def shingles(text, words):
    own = text.lower().split()
    return {tuple(own[i : i + words]) for i in range(len(own) - words + 1)} or ({tuple(own)} if own else set())


def brute_components(texts, words, percent):
    """Components by trying every pair that shares a shingle."""
    sets = {i: shingles(t or "", words) for i, t in texts.items()}
    held = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            held[x].append(i)
    root = {i: i for i in texts}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i, s in sets.items():
        common = Counter(j for x in s for j in held[x] if j < i)
        for j, c in common.items():
            if 100 * c >= percent * (len(s) + len(sets[j]) - c):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in texts}


@pytest.mark.parametrize("words, percent", [(5, 80), (3, 85)])
def test_both_settings_equal_brute_force_on_the_table(spark, words, percent):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text for r in table.collect()}
    found = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(table, words, percent).collect()}
    assert found == brute_components(texts, words, percent)


def template_family(count, seed):
    """Texts of one template, each with words of its own: alike in most tokens, linked with none; a few pairs
    are true copies with one word changed."""
    draw = random.Random(seed)
    shared = [f"s{i}" for i in range(70)]
    texts = {}
    for i in range(count):
        own = [f"o{draw.randint(0, 10**9)}" for _ in range(14)]
        words = list(shared)
        for k, w in enumerate(own):
            words[5 * k + 2] = w
        texts[i] = " ".join(words)
        if i % 50 == 49:
            texts[i] = texts[i - 7].replace("s69", f"n{i}")
    return texts


def test_templates_are_met_through_rare_shingles(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "NODE", 64)
    monkeypatch.setattr(near_dedup, "DEPTH", 2)
    rows = {}
    for count in (400, 800):
        texts = template_family(count, 3)
        frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
        met = []
        plain = near_dedup.left_over
        monkeypatch.setattr(near_dedup, "left_over", lambda *a: met.append(plain(*a)) or met[-1])
        found = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(frame, 3, 60).collect()}
        monkeypatch.setattr(near_dedup, "left_over", plain)
        assert found == brute_components(texts, 3, 60)
        rows[count] = sum(frame.count() for frame in met)
    assert rows[800] <= 3 * rows[400] + 100


def test_rare_groups_hold_every_linked_pair(spark):
    draw = random.Random(6)
    base = [list(range(k * 100, k * 100 + 60)) for k in range(6)]
    sets = []
    for i in range(300):
        own = set(draw.choice(base)) | set(draw.sample(range(5_000, 9_000), draw.randint(0, 12)))
        sets.append(sorted(own - set(draw.sample(sorted(own), draw.randint(0, 6)))))
    frame = spark.createDataFrame(list(enumerate(sets)), "id long, shingles array<bigint>")
    groups = defaultdict(set)
    for r in near_dedup.rare_groups(frame, 80).collect():
        groups[r.node].add(r.id)
    together = {(a, b) for g in groups.values() for a in g for b in g if a < b}
    for a in range(300):
        for b in range(a + 1, 300):
            x, y = set(sets[a]), set(sets[b])
            if 100 * len(x & y) >= 80 * len(x | y):
                assert (a, b) in together


def test_a_pair_at_the_threshold_survives_at_every_depth():
    """The chance that no child is shared down to a depth, from the draw of positions."""
    for threshold, most in ((0.8, 2e-6), (0.85, 5e-7)):
        two = near_dedup.GROWTH / threshold - 1
        lost = 0.0
        for _ in range(50):
            alone = 1 - threshold + threshold * lost
            lost = (1 - two) * alone + two * alone * alone
        assert lost**near_dedup.TREES < most


# ---- rows without a doc_id -------------------------------------------------------------------------


@pytest.fixture(scope="module")
def missing(spark):
    """A third of the rows without a doc_id, half of them copies of one text."""
    draw = random.Random(4)
    rows = []
    for i in range(900):
        doc = None if i % 3 == 0 else i
        lines = [f"line number {draw.randint(0, 40)} of many" for _ in range(draw.randint(1, 6))] + [f"own line of {i} only"]
        text = "one text that many rows have\nline number 3 of many" if i % 6 == 0 else "\n".join(lines)
        rows.append((doc, text if i % 97 else None, i))
    return rows, spark.createDataFrame(rows, "doc_id long, text string, row long").repartition(3)


def test_lines_of_rows_without_an_id(missing):
    rows, frame = missing
    first = {}
    for doc, text, _ in rows:
        for line in (text or "").split("\n"):
            key = line.strip().lower()
            if len(key) >= 10:
                first.setdefault(key, set()).add(line_dedup.LAST if doc is None else doc)
    expected = Counter()
    for doc, text, _ in rows:
        lines = (text or "").split("\n")
        place = line_dedup.LAST if doc is None else doc
        kept = [x for x in lines if not (len(first.get(x.strip().lower(), ())) > 1 and min(first[x.strip().lower()]) != place)]
        expected[(doc, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest())] += 1
    assert Counter(map(tuple, line_dedup.line_digests(frame).collect())) == expected
    out = line_dedup.without_repeated_lines(frame)
    assert out.columns == frame.columns and out.count() == len(rows)
    assert out.filter("text IS NULL").count() == sum(t is None for _, t, _ in rows)


def test_rows_without_an_id_share_no_single_range(missing, spark):
    _, frame = missing
    placed = fingerprints.with_neighbours(frame)
    rows = placed.withColumn("part", F.spark_partition_id())
    assert rows.filter("donor = 1").count() == rows.select("bucket").distinct().count()
    sizes = [r["count"] for r in rows.filter("donor = 0").groupBy("part").count().collect()]
    assert sum(sizes) == 900 and max(sizes) <= 900 / 3
    assert rows.groupBy("part").agg(F.count_distinct("bucket").alias("n")).filter("n > 1").isEmpty()


def test_neighbours_stand_in_one_descending_order(missing):
    rows, frame = missing
    found = fingerprints.edit_likeness(frame).collect()
    assert len(found) == len(rows)
    own = Counter(r.fingerprint for r in fingerprints.fingerprint_documents(frame).collect())
    assert Counter(r.fingerprint for r in found) == own
    by_id = {r.doc_id: r for r in found if r.doc_id is not None}
    texts = {d: t or "" for d, t, _ in rows if d is not None}
    order = sorted(texts, reverse=True)
    for doc, following in zip(order, order[1:]):
        size = len(texts[doc]) // 3
        changed = texts[doc][: len(texts[doc]) - size] + texts[following][:size]
        assert by_id[doc].edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()


def test_token_files_of_rows_without_an_id(missing):
    rows, frame = missing
    library = Tokenizer.from_file(tokens.word_bpe_path())
    found = token_files.round_trip(frame, tokens.word_bpe_path()).orderBy("start").collect()
    crc = lambda t: zlib.crc32(np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], "<u4").tobytes())
    assert Counter((r.doc_id, r.ids_crc32) for r in found) == Counter((d, crc(t)) for d, t, _ in rows)
    ids = [r.doc_id for r in found]
    assert ids == sorted(ids, key=lambda d: (d is not None, d or 0))
    start = 0
    for r in found:
        assert r.start == start
        start += r.n_tokens


def test_components_look_at_few_edges_twice(spark, monkeypatch):
    draw = random.Random(9)
    names = draw.sample(range(10**6), 1500)
    chain, star = names[:500], names[500:1000]
    edges = list(zip(chain, chain[1:])) + [(star[0], x) for x in star[1:]] + [(7 * 10**6, 7 * 10**6)]
    edges += [(draw.choice(names[1000:]), draw.choice(names[1000:])) for _ in range(200)]
    frame = spark.createDataFrame(edges, "a long, b long")
    plain, met = type(frame).join, []

    def join(self, other, on=None, how=None):
        if isinstance(on, str) and on == "b":
            met.append(self)
        return plain(self, other, on, how)

    monkeypatch.setattr(type(frame), "join", join)
    found = {r.id: r.label for r in near_dedup.components(frame).collect()}
    monkeypatch.undo()
    root = {x: x for edge in edges for x in edge}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    assert found == {x: find(x) for x in root}
    assert sum(frame.count() for frame in met) <= 2 * len(edges)
    none = near_dedup.components(frame.filter("a < 0"))
    assert none.columns == ["id", "label"] and none.isEmpty()


def test_a_family_far_above_a_node_is_not_dealt_again_at_every_level(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "NODE", 64)
    draw, base = random.Random(12), [f"b{i}" for i in range(100)]
    texts = {900: " ".join(base)}
    for i in range(600):
        words = list(base)
        for place in (draw.randrange(5, 45), draw.randrange(55, 95)):
            words[place] = f"n{i}p{place}"
        texts[i] = " ".join(words)
    # Two words further from the base than the copies that they are made of.
    for i in range(10):
        words = texts[i].split()
        words[1], words[98] = f"t{i}", f"u{i}"
        texts[1000 + i] = " ".join(words)
    plain, dealt = near_dedup.store, []

    def store(frame, name):
        stored = plain(frame, name)
        if name.startswith("nodes-"):
            dealt.append(stored.count())
        return stored

    monkeypatch.setattr(near_dedup, "store", store)
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(frame, 3, 85).collect()}
    assert found == brute_components(texts, 3, 85)
    assert sum(dealt) <= 4 * near_dedup.TREES * len(texts)


def test_links_are_merged_into_components(spark):
    draw = random.Random(4)
    first = [(draw.randrange(300), draw.randrange(300)) for _ in range(120)]
    second = [(draw.randrange(400), draw.randrange(400)) for _ in range(80)]
    one, two = (spark.createDataFrame(x, "a long, b long") for x in (first, second))
    labels = near_dedup.components(one)
    expected = {r.id: r.label for r in near_dedup.components(one.unionByName(two)).collect()}
    found = {r.id: r.label for r in near_dedup.merged(labels, two).collect()}
    assert all(expected[x] == label for x, label in found.items())
    assert all(found.get(x, x) == label for x, label in expected.items())
    again = near_dedup.merged(labels, one)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, labels.collect()))

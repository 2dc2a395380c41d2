"""Spelling variants, url filter and ranked search held to brute force, and on awkward tables."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from shoplens.llm import lexical_search, queries, spelling, url_reputation
from sql_check import compare, connect

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id bigint, text string, lang string, word string, node bigint, n int, rank int, item int"
LONG = "Letter" * 5_000 + " " + " ".join(f"wordy{chr(97 + i % 26)}{chr(97 + i % 7)}" for i in range(20_000))
ROWS = [
    (1, None, "en", "a", 1, 1, 1, 1), (2, "", "en", "a", 1, 1, 1, 1), (3, " \t 12 .", None, None, None, 1, 1, 1),
    (4, "Straßen straßen STRASSEN strassen ÷×÷×÷× Ünïcode 中文letter", "en", "a", 1, 1, 1, 1),
    (4, "Straßen straßen STRASSEN strassen ÷×÷×÷× Ünïcode 中文letter", "en", "a", 1, 1, 1, 1),
    (5, LONG, "en", "a", 1, 1, 1, 1), (None, "letters letter lettre Letters " * 3, "en", "a", 1, 1, 1, 1),
    (None, "letters letter lettre Letters " * 3, "en", "a", 1, 1, 1, 1),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def words_of(docs):
    counts = Counter()
    for doc, text in docs:
        for run, times in Counter(re.findall("[A-Za-z\u00c0-\u00ff]+", (text or "").translate(LOWER))).items():
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += times
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def variants(words):
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w in words:
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 5 * words[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {(w, form[w], root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items()}


def rows_of(frame, *names):
    return {tuple(r[n] for n in names) for r in frame.collect()}


NAMES = ("word", "form", "root", "n", "n_near", "form_n")


def test_variants_on_awkward_rows(docs):
    frame = spelling.spelling_variants(docs)
    expected = variants(words_of([(r[0], r[1]) for r in ROWS]))
    assert rows_of(frame, *NAMES) == expected and frame.count() == len(expected)


def test_variants_equal_brute_force_with_small_boxes(spark):
    """Many boxes, parts of boxes and copies of boxes: anagrams that no count can part, ties, hubs."""
    draw = random.Random(5)
    words = {"".join(draw.choices("abcdé", k=draw.randint(6, 8))): draw.choice([5, 5, 9, 60, 700]) for _ in range(700)}
    words |= {"".join(draw.sample("aabbcd", 6)): draw.choice([5, 30, 200]) for _ in range(250)}
    frame = spark.createDataFrame([(w, n, len(w)) for w, n in words.items()], "word string, n bigint, length int")
    expected = {}
    for w in words:
        near = [v for v in words if one_edit(w, v)]
        if near:
            best = min(near, key=lambda v: (-words[v], v))
            expected[w] = (len(near), words[best], best)
    for box, visitors in ((4096, 1 << 18), (40, 100), (3, 20)):
        found = {r.word: (r.n_near, r.best_n, r.best) for r in spelling.near_words(frame, box, visitors).collect()}
        assert found == expected, box


def test_boxes_stay_small(spark):
    draw = random.Random(7)
    words = sorted({"".join(draw.choices("etaoinshr", k=9)) for _ in range(4_000)})
    frame = spark.createDataFrame([(w, 5, 9) for w in words], "word string, n bigint, length int")
    home, levels = spelling.grown(frame, 100)
    sizes = [r["count"] for r in home.groupBy("node").count().collect()]
    assert sum(sizes) == len(words) and max(sizes) <= 100 and len(levels) < 12


def test_search_of_a_box_with_long_words_and_anagrams():
    base = "letter" * 2_000
    one = spelling.letters_of([base, "x" + base[1:]])
    two = spelling.letters_of([base[:-1] + "s", base])
    found = {(i, j) for a, b in spelling.search(one, two, 1, 1) for i, j in zip(a.tolist(), b.tolist())}
    assert found == {(0, 0), (1, 1)}
    draw = random.Random(2)
    words = sorted({"".join(draw.sample("aaabbbcc", 8)) for _ in range(300)})
    more = sorted({w[:i] + "c" + w[i:] for w in words[:60] for i in range(9)})
    one, two = spelling.letters_of(words), spelling.letters_of(more)
    found = [(i, j) for a, b in spelling.search(one, two, 1, 0) for i, j in zip(a.tolist(), b.tolist())]
    assert len(found) == len(set(found))
    assert set(found) == {(i, j) for i, w in enumerate(words) for j, v in enumerate(more) if one_edit(w, v)}


# ---- url filter ------------------------------------------------------------------------------------

URLS = [
    (1, "https://www.Example.NET/en/1?x=/"), (2, "http://a.net"), (3, None), (4, "no scheme"), (5, "://"),
    (6, "https://net/en/"), (7, "x://b.example.com/de/5#a"), (8, "x://b.example.com/de"), (8, "x://b.example.com/de"),
    (9, "http://u:p@shop.co.uk:80/fr/3"), (10, "http://10.0.0.1/4"), (None, "https://fr.org/fr/" + "y" * 200_000),
    (11, "http://notexample.net/en/2"), (12, "http://a.b.org/fr://c/d"), (13, "http://bad.shop.org/9"),
]


def url_parts(url):
    found = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    return (found[1].translate(LOWER), found[2]) if found else ("", "")


def ruled(host, path):
    fits = [
        (len(rule), rule, kind) for kind, rule in url_reputation.RULES
        if (host == rule.split("/")[0] or host.endswith("." + rule.split("/")[0]))
        and path.startswith(rule[rule.index("/") :])
    ]
    return max(fits)[1:] if fits else (None, None)


def test_hosts_paths_and_rules(spark):
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in URLS], "page_id bigint, url string, host string, bad string")
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    rows = url_reputation.judge_pages(pages, labels).collect()
    expected = []
    for page, url in URLS:
        host, path = url_parts(url)
        rule, kind = ruled(host, path)
        expected.append((page, host, path, rule, kind or "allow"))
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(map(tuple, rows), key=key) == sorted(expected, key=key)
    assert url_reputation.judge_pages(pages.limit(0), labels).count() == 0


def pull(children):
    """children: parent -> [(n, bad)]."""
    groups = [[c for c in g if c[0]] for g in children.values()]
    groups = [g for g in groups if g]
    members, parents = sum(map(len, groups)), len(groups)
    linked = 0.5
    if members > parents:
        pages = [sum(n for n, _ in g) for g in groups]
        free = members - parents
        size = (sum(pages) - sum(sum(n * n for n, _ in g) / p for g, p in zip(groups, pages))) / free
        between = sum(sum(f * f / n for n, f in g) - sum(f for _, f in g) ** 2 / p for g, p in zip(groups, pages)) / free
        within = sum(f - f * f / n for g in groups for n, f in g) / max(sum(pages) - members, 1)
        spread = between + (size - 1) * within
        linked = (between - within) / spread if spread > 0 else 0
    return 1 / min(max(linked, 1e-4), 0.5) - 1


def test_reputation_shrinks_and_blocks(spark):
    """A bad host of a good domain is blocked, a host with one bad page is not, one without labels
    goes with its domain."""
    counts = {
        "a.good.org": (200, 4), "b.good.org": (150, 3), "bad.good.org": (40, 36), "one.good.org": (1, 1),
        "a.rot.com": (90, 80), "b.rot.com": (60, 55), "new.rot.com": (0, 0), "x.fine.com": (300, 2), "new.fine.com": (0, 0),
    }
    pages, labels, number = [], [], 0
    for host, (n, bad) in counts.items():
        for k in range(max(n, 1)):
            number += 1
            pages.append((number, f"http://{host}/p/{number}.html"))
            if n:
                labels.append((number, int(k >= bad), 0))
    frame = spark.createDataFrame(pages, "page_id bigint, url string")
    outcomes = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    verdicts = {
        (r.host, r.verdict) for r in url_reputation.judge_pages(frame, outcomes).collect()
    }
    assert verdicts == {(h, "block" if h in ("bad.good.org", "a.rot.com", "b.rot.com", "new.rot.com") else "allow") for h in counts}

    hosts = spark.createDataFrame([(h, n, b) for h, (n, b) in counts.items()], "host string, n bigint, bad bigint")
    found = {r.host: (r.rate, r.bound) for r in url_reputation.reputation(url_reputation.with_levels(hosts)).collect()}
    domains, tops = defaultdict(lambda: [0, 0]), defaultdict(lambda: [0, 0])
    for host, (n, b) in counts.items():
        for level, name in ((domains, host.split(".", 1)[1]), (tops, host.rsplit(".", 1)[1])):
            level[name][0] += n
            level[name][1] += b
    n, b = (sum(v[k] for v in counts.values()) for k in (0, 1))
    by_domain, by_top = defaultdict(list), defaultdict(list)
    for host, v in counts.items():
        by_domain[host.split(".", 1)[1]].append(v)
    for domain, v in domains.items():
        by_top[domain.rsplit(".", 1)[1]].append(v)
    s0, s1, s2 = pull({"": list(tops.values())}), pull(by_top), pull(by_domain)
    for host, (own, bad) in counts.items():
        domain, top = host.split(".", 1)[1], host.rsplit(".", 1)[1]
        rate = (s0 * (b + 1) / (n + 2) + tops[top][1]) / (s0 + tops[top][0])
        rate = (s1 * rate + domains[domain][1]) / (s1 + domains[domain][0])
        rate = (s2 * rate + bad) / (s2 + own)
        bound = rate - 1.645 * math.sqrt(rate * (1 - rate) / (s2 + own + 1))
        assert found[host] == pytest.approx((rate, bound), rel=1e-12)


def test_levels_know_long_suffixes_ports_users_and_addresses(spark):
    hosts = ["a.b.co.uk", "co.uk", "u:p@x.shop.org:8080", "10.0.0.1:80", "localhost", ""]
    frame = spark.createDataFrame([(h,) for h in hosts], "host string")
    found = {r.host: (r.domain, r.suffix) for r in url_reputation.with_levels(frame, ["co.uk"]).collect()}
    assert found == {
        "a.b.co.uk": ("b.co.uk", "co.uk"), "co.uk": ("co.uk", "co.uk"), "u:p@x.shop.org:8080": ("shop.org", "org"),
        "10.0.0.1:80": ("10.0.0.1", "10.0.0.1"), "localhost": ("localhost", "localhost"), "": ("", ""),
    }


# ---- ranked search ---------------------------------------------------------------------------------

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def ranked(docs, items, top):
    own = [Counter(TERM.findall((text or "").translate(LOWER))) for _, text in docs]
    count, total = sum(1 for c in own if c), sum(sum(c.values()) for c in own)
    holding = Counter(t for c in own for t in c)
    out = []
    for item, text in items:
        scores = []
        for (doc, _), c in zip(docs, own):
            m = 75 + 25 * sum(c.values()) * count // max(total, 1)
            score = sum(
                r * math.floor(1000 * math.log((2 * count + 2) / (2 * holding[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                for t, r in Counter(TERM.findall((text or "").translate(LOWER))).items() if c[t]
            )
            if score > 0:
                scores.append((-score, doc is None, doc or 0))
        for rank, (score, null, doc) in enumerate(sorted(scores)[:top], 1):
            out.append((item, rank, None if null else doc, -score))
    return sorted(out, key=repr)


def test_terms_are_what_the_pattern_says():
    draw = random.Random(1)
    texts = ["".join(draw.choices("abAZ09 é中\x00\x7f@[`{/:.\n\x85ß×", k=30)) for _ in range(300)] + ["", "x"]
    found = lexical_search.terms_of(pa.array([*texts, None])[2:])
    strings = found.strings()
    for i, text in enumerate(texts[2:]):
        own = [strings[c] for c in found.codes[found.starts[i] : found.starts[i + 1]]]
        assert own == TERM.findall(text.translate(LOWER))
    assert found.starts[-1] == found.starts[-2]


@pytest.mark.parametrize("top", [3, 20])
def test_search_equals_brute_force(spark, monkeypatch, top):
    """Small vocabulary (many ties and common pairs), copies, long and empty texts, several batches."""
    draw = random.Random(9)
    terms = [f"t{i}" for i in range(60)]
    docs = [(i, " ".join(draw.choices(terms, [1 / (k + 1) for k in range(60)], k=draw.choice([1, 5, 40, 300])))) for i in range(500)]
    docs += [(500 + i, docs[i % 7][1]) for i in range(200)] + [(None, docs[0][1]), (9, docs[3][1]), (800, None), (801, "!?")]
    items = [(i, " ".join(draw.choices(terms, k=draw.randint(1, 12)))) for i in range(30)]
    items += [(0, items[0][1]), (None, "t1 t2 T1"), (40, None), (41, "unheard"), (42, docs[10][1])]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    asked = spark.createDataFrame(items, "item_id bigint, text string")
    expected = ranked(docs, items, top)
    for batch in (lexical_search.BATCH, 900):
        found = lexical_search.rank_documents(frame, asked, top, batch).collect()
        assert sorted(map(tuple, found), key=repr) == expected
    assert lexical_search.rank_documents(frame.limit(0), asked).count() == 0
    assert lexical_search.rank_documents(frame, asked.limit(0)).count() == 0


def test_pair_bounds_spare_documents(spark):
    """Two terms that never meet are bounded by the larger, so documents with only one of them are not
    scored once the threshold is above it."""
    ids = np.arange(40)
    docs = [(int(i), "rare common " if i < 3 else "left" if i % 2 else "right") for i in ids]
    blocks = lexical_search.counted_blocks(
        spark.createDataFrame(docs, "doc_id bigint, text string").coalesce(1),
        {"rare": 0, "common": 1, "left": 2, "right": 3},
    )
    corpus = lexical_search.corpus_of(blocks, 4)
    items = [Counter(rare=1, common=1, left=1, right=1)]
    lexicon = {"rare": 0, "common": 1, "left": 2, "right": 3}
    plans = lexical_search.planned(items, lexicon, corpus)
    pairs = lexical_search.term_pairs(plans)
    assert pairs.tolist() == [[0, 1], [2, 3]]
    index = lexical_search.index_blocks(blocks, corpus, pairs)
    batch = index.toArrow().combine_chunks().to_batches()[0]
    block = lexical_search.Block(batch, 0, 4, 2)
    assert block.intersection(1).tolist() == [] and block.pair_best[block.pair_at[1]] == 0
    best = lexical_search.Best(np.array([10**12] * 3), np.zeros(3, bool), np.arange(3))
    lexical_search.search_block(block, plans[0], [0, 1], best, 3)
    assert best.ids.tolist() == [0, 1, 2] and best.scores[0] == 10**12


def test_search_on_awkward_rows(spark, docs):
    items = spark.createDataFrame([(1, "letters strassen 中文letter 12", 5), (2, None, 5)], "item_id bigint, text string, doc_id int")
    found = lexical_search.rank_documents(docs, items).collect()
    assert sorted(map(tuple, found), key=repr) == ranked([(r[0], r[1]) for r in ROWS], [(r.item_id, r.text) for r in items.collect()], 20)


def test_queries_equal_their_sql(spark, folder):
    connection = connect(folder)
    for name in ("op11_spelling_variants", "op12_url_filter", "op13_lexical_search"):
        assert compare(queries.QUERIES[name](spark, folder), connection, queries.ORACLE_SQL[name]) is None, name

"""Near-duplicate detection by a chosen-path set similarity join.

Every distinct set of word shingles gets ``TOKENS`` minwise tokens. In each of ``trees`` independent
trees a node chooses token positions by its own random draw, ``GROWTH`` / threshold of them on average (one or
two), and its sets go to the child named by their token there. A pair at the threshold expects to share more
than one child, so its chance to be parted by all children of a node does not tend to one with depth: it
solves q = (1 - p) f + p f f, f = 1 - s + s q for threshold s and chance p of two positions, and is 0.25 at
80 % and 0.22 at 85 %, that is 1e-6 and 2e-7 for ten trees, at every depth. Nodes with one set are dropped, nodes of at most ``NODE``
sets are compared exhaustively by their tokens, larger ones branch again. All nodes of a level are
one shuffle; a node never meets more sets in one task than ``NODE``.

Links are confirmed on the full sets. First the widest agreements only: a spanning forest of each
small node's candidates. Then whatever candidates still lie between different components: in pairs
where they are few, and node by node, skipping what is joined meanwhile, where they are many. No list
of all pairs of a group is made, and no candidate between components goes untested.

A set that no token separates from more than ``NODE`` others in ``DEPTH`` levels agrees with them in
nearly all tokens. So do most sets of a larger node that has kept a share of ``DENSE`` of the node above: it branches no
further, since every level would hold the same family in half as many nodes again. Such a node is first cut into
parts that share some sets as bridges, among them the one nearest to the node's commonest tokens, which joins a family
of copies of one text. What that leaves is met through rare shingles: of the sets of such nodes each lists its rarest
shingles, just so many that two sets alike enough must share a listed one, and only sets that share one are compared. Texts of one template
share its shingles, which are common, and list their own. A listed shingle that more than ``NODE`` sets share
is compared block against block, each pair of blocks a node of its own, every set outside its largest
component with all its sets.

Only A-Z are put in lower case. A text with fewer words than a shingle is one shingle. A text without
words, or null, is empty: it links with nothing. Rows with one doc_id are one document. A row with a
null doc_id is not linked: its component is null and it is kept. An empty table gives no rows; extra
columns stay out of the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.llm.words import mix, slices, split_words, window_hashes, word_hashes
from shoplens.sources.stages import store

TOKENS, TREES, NODE, DEPTH, BRIDGES = 64, 10, 1024, 6, 16
DENSE = 0.75  # of such a node a quarter would be left after the other levels
GROWTH = 1.3  # children that a pair at the threshold is expected to share
BLOCK = 1 << 15  # shingles hashed at a time
SLICE = 1 << 20  # bytes of text at a time, one text at least; their words and windows take some 20 times that
FILTER = 1 << 22  # bits of the filter over wanted documents
SPARSE = 4  # candidates per set up to which a node sends pairs


def shingle_sets(texts: pa.Array, words: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    found = split_words(pc.ascii_lower(pc.fill_null(texts, "")))
    if not len(found.codes):
        return [np.empty(0, dtype=np.uint64)] * len(texts)
    own = word_hashes(found.strings())[found.codes]
    windows, bounds = window_hashes(own, words), found.starts.tolist()
    sets = []
    for a, b in zip(bounds, bounds[1:]):
        if b - a >= words:
            sets.append(np.unique(windows[a : b - words + 1]))
        elif b > a:
            sets.append(window_hashes(own[a:b], b - a) ^ np.uint64(b - a))
        else:
            sets.append(own[:0])
    return sets


def minwise_tokens(sets: list[np.ndarray]) -> np.ndarray:
    """A row of TOKENS 32-bit tokens for each set; none of them may be empty."""
    draws = np.random.default_rng(20_241).integers(1, 1 << 62, (2, TOKENS)).astype(np.uint64)
    salts, factors = draws[0], draws[1] * np.uint64(2) + np.uint64(1)
    least = np.empty((len(sets), TOKENS), dtype=np.uint64)
    at = 0
    while at < len(sets):
        end, size = at, 0
        while end < len(sets) and (end == at or size + len(sets[end]) <= BLOCK):
            size += len(sets[end])
            end += 1
        some = np.concatenate(sets[at:end])
        starts = np.cumsum([0, *map(len, sets[at : end - 1])])
        for k in range(TOKENS):
            least[at:end, k] = np.minimum.reduceat((some ^ salts[k]) * factors[k], starts)
        at = end
    return (mix(least) >> np.uint64(32)).astype(np.uint32)


def signatures(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, n_shingles, set_key, tokens); key and tokens are null for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, limit=SLICE):
            sets = shingle_sets(part.column("text"), words)
            full = [s for s in sets if len(s)]
            tokens = iter(minwise_tokens(full).view(np.int32)) if full else iter(())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets],
                          pa.binary()),
                 pa.array([next(tokens) if len(s) else None for s in sets], pa.list_(pa.int32()))],
                ["doc_id", "n_shingles", "set_key", "tokens"],
            )

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        run, "doc_id bigint, n_shingles bigint, set_key binary, tokens array<int>"
    )


# ---- trees -------------------------------------------------------------------------------------


def children(active: DataFrame, threshold: float) -> DataFrame:
    """(node, id, above) one level down from rows (node, id, tokens, n); ``above``: the n of the node above."""

    def draw(salt: int, limit: int) -> Column:
        return F.pmod(F.xxhash64("node", F.lit(salt)), F.lit(limit)).cast("int")

    more = draw(2, 1_000_000) < int((GROWTH / threshold - 1) * 1_000_000)
    one, two = draw(1, TOKENS), draw(3, TOKENS)
    places = F.when(more & (one != two), F.array(one, two)).otherwise(F.array(one))
    return active.select("node", "id", "tokens", "n", F.explode(places).alias("place")).select(
        F.xxhash64("node", "place", F.get("tokens", F.col("place"))).alias("node"), "id", F.col("n").alias("above")
    )


def small_nodes(
    sets: DataFrame, threshold: float, trees: int
) -> tuple[DataFrame, DataFrame | None]:
    """(node, id) of all nodes with 2 to NODE sets and of the parts of nodes that stay larger, and
    (node, id, n) of the larger ones, if any; ``sets``: (id, tokens)."""
    roots = F.explode(F.sequence(F.lit(1), F.lit(trees))).alias("tree")
    active = sets.select("id", "tokens", F.lit(sets.count()).alias("n"), roots).withColumn("node", F.xxhash64("tree"))
    leaves = large = None
    for depth in range(1, DEPTH + 1):
        rows = store(children(active, threshold), f"children-{depth}")
        sizes = rows.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.max("above").alias("above"))
        found = store(rows.drop("above").join(sizes.filter("n > 1"), "node"), f"nodes-{depth}")
        small = found.filter(F.col("n") <= NODE).select("node", "id")
        leaves = small if leaves is None else leaves.unionByName(small)
        larger = found.filter(F.col("n") > NODE)
        dense = F.lit(depth == DEPTH) | (F.col("n") >= DENSE * F.col("above"))
        ended = larger.filter(dense).select("node", "id", "n")
        large = ended if large is None else large.unionByName(ended)
        larger = larger.filter(~dense)
        if larger.isEmpty():
            break
        active = larger.join(sets.select("id", "tokens"), "id")
    if large.isEmpty():
        return leaves, None
    large = store(large, "large-nodes")
    return leaves.unionByName(cut_with_bridges(large, sets)), large


def blocks(size: Column) -> Column:
    """Into how many blocks a node is cut so that two blocks have at most about NODE sets."""
    return F.ceil(size * 2.5 / NODE).cast("int")


def cut_with_bridges(large: DataFrame, sets: DataFrame) -> DataFrame:
    """(node, id) of parts of the large nodes. What the parts separate is left to ``across``."""

    def commonest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_node(batches):
            tokens, nodes, rows = token_matrix(batch), batch.column("node"), []
            for a, b in groups(batch):
                found = (np.unique(column, return_counts=True) for column in tokens[a:b].T)
                rows.append([int(values[counts.argmax()]) for values, counts in found])
            firsts = pa.array([a for a, _ in groups(batch)], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [nodes.take(firsts), pa.array(rows, pa.list_(pa.int32()))], ["node", "centre"]
            )

    rows = large.join(sets.select("id", "tokens"), "id").select("node", "id", "tokens", "n")
    sample = rows.filter(F.pmod(F.xxhash64("node", "id"), F.col("n")) < NODE // 2)
    centres = sorted_nodes(sample.select("node", "id", "tokens")).mapInArrow(
        commonest, "node bigint, centre array<int>"
    )
    equal = F.filter(F.zip_with("tokens", "centre", lambda x, y: x == y), lambda same: same)
    hubs = rows.join(centres, "node").groupBy("node").agg(
        F.max_by("id", F.struct(F.size(equal), -F.col("id"))).alias("hub")
    )
    parts = blocks(F.col("n"))
    own = F.array(F.pmod(F.xxhash64("id", "node"), parts).cast("int"))
    chosen = F.pmod(F.xxhash64("id", "node", F.lit(1)), F.col("n")) < BRIDGES
    bridge = chosen | F.coalesce(F.col("id") == F.col("hub"), F.lit(False))
    every = F.when(bridge, F.sequence(F.lit(0), parts - 1)).otherwise(own)
    cut = large.join(hubs, "node", "left").select("node", "id", F.explode(every).alias("part"))
    return cut.select(F.xxhash64("node", "part").alias("node"), "id")


def across(large: DataFrame, labels: DataFrame) -> DataFrame:
    """(node, id) of pairs of blocks of the large nodes, so that every set outside its node's
    largest component meets all sets of the node; nothing for nodes in one component."""
    known = large.join(labels, "id", "left").select(
        "node", "id", F.coalesce("label", "id").alias("label")
    )
    known = store(known, "large-labelled")
    counts = known.groupBy("node", "label").agg(F.count(F.lit(1)).alias("n"))
    sizes = (
        counts.groupBy("node")
        .agg(F.max(F.struct("n", "label")).alias("top"), F.sum("n").alias("n"))
        .select("node", F.col("top.label").alias("largest"), blocks(F.col("n")).alias("parts"),
                (F.col("n") - F.col("top.n")).alias("outside"))
        .filter("outside > 0")
        .withColumn("outer", blocks(F.col("outside")))
    )
    rows = known.join(sizes, "node")

    def block(salt: int, parts: str) -> Column:
        return F.pmod(F.xxhash64("id", "node", F.lit(salt)), F.col(parts)).cast("int")

    def numbers(parts: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(parts) - 1))

    whole = rows.select("node", "id", numbers("outer").alias("x"), block(1, "parts").alias("y"))
    outside = (
        rows.filter("label <> largest")
        .select("node", "id", block(2, "outer").alias("x"), block(1, "parts").alias("own"),
                numbers("parts").alias("y"))
        .filter("y <> own")
        .drop("own")
    )
    pairs = whole.unionByName(outside).select(F.xxhash64("node", "x", "y").alias("node"), "id")
    return store(pairs, "block-pairs")


def rare_groups(full: DataFrame, percent: int) -> DataFrame:
    """(node, id): sets that share one of their rarest shingles, a node for each such shingle.

    Two sets with a union of which ``percent`` is common share that much of the larger one, so among the
    size - needed + 1 rarest shingles of each, in one order for all, there is a common one.
    """
    held = full.select("id", F.size("shingles").alias("size"), F.explode("shingles").alias("shingle"))
    often = held.groupBy("shingle").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    ranked = held.join(often, "shingle", "left").groupBy("id").agg(
        F.first("size").alias("size"),
        F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(1)).alias("n"), "shingle"))).alias("ranked"),
    )
    listed = (F.col("size") - F.ceil(F.col("size") * percent / 100) + 1).cast("int")
    return ranked.select("id", F.explode(F.slice("ranked", F.lit(1), listed)).alias("at")).filter("at.n > 1").select(
        F.xxhash64("at.shingle").alias("node"), "id"
    )


def left_over(large: DataFrame, full: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """(node, id): what of the large nodes still has to be compared: groups by rare shingles with more than
    one component, those with more than ``NODE`` sets as pairs of blocks."""
    own = full.join(large.select("id").distinct(), "id", "left_semi")
    groups = store(rare_groups(own, percent), "rare-groups")
    marked = groups.join(labels, "id", "left").select("node", "id", F.coalesce("label", "id").alias("label"))
    sizes = marked.groupBy("node").agg(
        F.count(F.lit(1)).alias("n"), F.min("label").alias("low"), F.max("label").alias("high")
    ).filter("low <> high").select("node", "n")
    open_groups = store(groups.join(sizes, "node"), "open-groups")
    small = open_groups.filter(F.col("n") <= NODE).select("node", "id")
    crowded = open_groups.filter(F.col("n") > NODE)
    return small if crowded.isEmpty() else small.unionByName(across(crowded, labels))


def by_node(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows regrouped so that a batch holds whole nodes; they come sorted by node."""
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        nodes = batch.column("node").to_numpy()
        if not len(nodes):
            continue
        if kept and kept[-1].column("node")[-1].as_py() != nodes[0]:
            yield pa.concat_batches(kept)
            kept = []
        cuts = np.flatnonzero(np.diff(nodes)) + 1
        if len(cuts):
            last = int(cuts[-1])
            yield pa.concat_batches([*kept, batch.slice(0, last)])
            kept = [batch.slice(last)]
        else:
            kept.append(batch)
    if kept:
        yield pa.concat_batches(kept)


def groups(batch: pa.RecordBatch) -> list[tuple[int, int]]:
    nodes = batch.column("node").to_numpy()
    bounds = [0, *(np.flatnonzero(np.diff(nodes)) + 1).tolist(), len(nodes)]
    return list(zip(bounds, bounds[1:]))


def token_matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("tokens").flatten().to_numpy().reshape(batch.num_rows, TOKENS)


def agreements(tokens: np.ndarray) -> np.ndarray:
    """How many tokens each two sets have in common."""
    return np.stack([(tokens == row).sum(axis=1, dtype=np.uint8) for row in tokens])


def forest(same: np.ndarray, least: int) -> list[tuple[int, int]]:
    """A spanning forest of the pairs with ``least`` common tokens, the highest agreements first."""
    size = len(same)
    if size == 2:
        return [(0, 1)] if same[0, 1] >= least else []
    best, parent = np.full(size, -1, dtype=np.int16), np.full(size, -1)
    outside = np.ones(size, dtype=bool)
    edges = []
    for _ in range(size):
        new = int(np.where(outside, best, -2).argmax())
        if best[new] >= least:
            edges.append((int(parent[new]), new))
        outside[new] = False
        closer = outside & (same[new] > best)
        best[closer], parent[closer] = same[new][closer], new
    return edges


def pair_batch(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    ordered = [(min(p), max(p)) for p in pairs]
    columns = zip(*ordered) if ordered else ([], [])
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b"])


def sorted_nodes(rows: DataFrame) -> DataFrame:
    return rows.repartition("node").sortWithinPartitions("node")


def first_candidates(nodes: DataFrame, sets: DataFrame, least: int) -> DataFrame:
    """Distinct pairs (a, b) of the nodes' spanning forests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_node(batches):
            ids, tokens = batch.column("id").to_numpy(), token_matrix(batch)
            pairs = []
            for a, b in groups(batch):
                if b - a > 1:
                    own = ids[a:b].tolist()
                    pairs += [(own[i], own[j]) for i, j in forest(agreements(tokens[a:b]), least)]
            yield pair_batch(list(dict.fromkeys(pairs)))

    rows = sorted_nodes(nodes.join(sets.select("id", "tokens"), "id").select("node", "id", "tokens"))
    return rows.mapInArrow(run, "a bigint, b bigint").filter("a <> b").distinct()


def open_candidates(
    nodes: DataFrame, sets: DataFrame, labels: DataFrame, least: int
) -> tuple[DataFrame, DataFrame]:
    """What still lies between components: pairs (a, b), and rows (node, id, label) of the nodes
    with more than SPARSE such pairs a set."""
    known = nodes.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
    known = store(known.select("node", "id", "label"), "labelled")
    mixed = known.groupBy("node").agg(F.min("label").alias("x"), F.max("label").alias("y"))
    known = known.join(mixed.filter("x <> y").select("node"), "node", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_node(batches):
            ids, labels = batch.column("id").to_numpy(), batch.column("label").to_numpy()
            nodes, tokens, out = batch.column("node").to_numpy(), token_matrix(batch), []
            for a, b in groups(batch):
                label = labels[a:b]
                far = np.triu(agreements(tokens[a:b]) >= least) & (label[:, None] != label)
                left, right = np.nonzero(far)
                if len(left) <= SPARSE * (b - a):
                    for i, j in zip(ids[a + left].tolist(), ids[a + right].tolist()):
                        out.append((None, None, min(i, j), max(i, j)))
                else:
                    for i in np.unique(np.concatenate([left, right])).tolist():
                        row = int(nodes[a]), int(label[i]), int(ids[a + i]), None
                        out.append(row)
            columns = zip(*out) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], ["node", "label", "a", "b"]
            )

    rows = known.join(sets.select("id", "tokens"), "id").select("node", "id", "label", "tokens")
    found = store(
        sorted_nodes(rows).mapInArrow(run, "node bigint, label bigint, a bigint, b bigint"), "open"
    )
    pairs = found.filter("node IS NULL").select("a", "b").distinct()
    return pairs, found.filter("node IS NOT NULL").select("node", F.col("a").alias("id"), "label")


# ---- full sets ---------------------------------------------------------------------------------


def full_sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(id, shingles) of the wanted ids, from a second reading of the texts.

    A bit filter of fixed size, sent to all tasks, passes over most texts that are not wanted before
    anything is shuffled; the join behind it is exact.
    """
    place = F.pmod(F.xxhash64("id"), F.lit(FILTER)).cast("int")
    hit = wanted.select(place.alias("place")).distinct().toPandas()["place"].to_numpy(int)
    bits = np.zeros(FILTER // 8, dtype=np.uint8)
    np.bitwise_or.at(bits, hit >> 3, (1 << (hit & 7)).astype(np.uint8))
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column("place").to_numpy()
            passed = (shared.value[at >> 3] >> (at & 7)) & 1 == 1
            for part in slices([batch.filter(pa.array(passed))], limit=SLICE):
                sets = [s.view(np.int64) for s in shingle_sets(part.column("text"), words)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(sets, pa.list_(pa.int64()))], ["id", "shingles"]
                )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("id"), "text").filter("id IS NOT NULL")
    found = rows.withColumn("place", place).mapInArrow(run, "id bigint, shingles array<bigint>")
    return found.join(wanted, "id", "left_semi").groupBy("id").agg(
        F.any_value("shingles").alias("shingles")
    )


def linked(pairs: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are alike enough."""
    one = full.select(F.col("id").alias("a"), F.col("shingles").alias("one"))
    two = full.select(F.col("id").alias("b"), F.col("shingles").alias("two"))
    common = F.size(F.array_intersect("one", "two"))
    union = F.size("one") + F.size("two") - F.col("common")
    return (
        pairs.join(one, "a").join(two, "b").withColumn("common", common)
        .filter(100 * F.col("common") >= percent * union)
        .select("a", "b")
    )


def linked_in_nodes(members: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """Links between components inside nodes with many candidates, by their full sets.

    Every set outside a node's largest component is counted against all sets of the node through the
    sets that hold each shingle; what a link has joined is not looked at again.
    """

    def links(ids: list[int], labels: list[int], sets: list[np.ndarray]) -> list[tuple[int, int]]:
        sizes = np.array([len(s) for s in sets])
        owner = np.repeat(np.arange(len(sets)), sizes)
        everything = np.concatenate(sets)
        order = np.argsort(everything, kind="stable")
        everything, owner = everything[order], owner[order]
        root = {label: label for label in labels}

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        values, counts = np.unique(labels, return_counts=True)
        largest = int(values[counts.argmax()])
        out = []
        for i, label in enumerate(labels):
            if label == largest:
                continue
            start = np.searchsorted(everything, sets[i], "left")
            size = np.searchsorted(everything, sets[i], "right") - start
            take = np.arange(size.sum()) + np.repeat(start - np.cumsum(size) + size, size)
            common = np.bincount(owner[take], minlength=len(sets))
            near = np.flatnonzero(100 * common >= percent * (sizes[i] + sizes - common))
            for j in near.tolist():
                x, y = find(label), find(labels[j])
                if x != y:
                    root[max(x, y)] = min(x, y)
                    out.append((ids[i], ids[j]))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_node(batches):
            out = []
            for a, b in groups(batch):
                part = batch.slice(a, b - a)
                sets = [np.asarray(s.values) for s in part.column("shingles")]
                out += links(part.column("id").to_pylist(), part.column("label").to_pylist(), sets)
            yield pair_batch(out)

    rows = members.join(full, "id").select("node", "id", "label", "shingles")
    return sorted_nodes(rows).mapInArrow(run, "a bigint, b bigint").distinct()


# ---- components --------------------------------------------------------------------------------


def roots(parents: DataFrame) -> DataFrame:
    """(id, label): where each id's chain of parents ends; ``parents``: (id, label) with every label as an id. Chains
    shorten by half in a round."""
    while True:
        further = parents.select(F.col("id").alias("label"), F.col("label").alias("further"))
        stepped = parents.join(further, "label").select("id", F.col("label").alias("old"), F.col("further").alias("label"))
        stepped = store(stepped, "parents")
        parents = stepped.select("id", "label")
        if stepped.filter("label <> old").isEmpty():
            return parents


def components(edges: DataFrame) -> DataFrame:
    """(id, label): the smallest id that each id of an edge reaches.

    Every round an id takes its least neighbour, if that is smaller, as its parent, and its chain of parents ends in
    an id that stands for it. The next round has only the edges between such ids, which are half as many at most; so
    the rows of all rounds grow with the edges. Tables are written to the shared folder between rounds.
    """
    edges, labels = store(edges, "edges"), None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("label"))
        parents = roots(store(least.withColumnRenamed("a", "id"), "parents"))
        if labels is None:
            labels = parents
        else:
            further = parents.select(F.col("id").alias("label"), F.col("label").alias("further"))
            labels = labels.join(further, "label", "left").select("id", F.coalesce("further", "label").alias("label"))
            labels = store(labels, "labels")
        one = parents.select(F.col("id").alias("a"), F.col("label").alias("one"))
        two = parents.select(F.col("id").alias("b"), F.col("label").alias("two"))
        between = edges.join(one, "a").join(two, "b").filter("one <> two")
        ends = F.least("one", "two").alias("a"), F.greatest("one", "two").alias("b")
        edges = store(between.select(*ends).distinct(), "edges")
        if edges.isEmpty():
            return labels


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The components of ``labels`` with what ``links`` (a, b) join; only links between components go on."""
    one = labels.select(F.col("id").alias("a"), F.col("label").alias("one"))
    two = labels.select(F.col("id").alias("b"), F.col("label").alias("two"))
    ends = F.coalesce("one", "a").alias("one"), F.coalesce("two", "b").alias("two")
    between = links.join(one, "a", "left").join(two, "b", "left").select(*ends).filter("one <> two")
    between = between.select(F.least("one", "two").alias("a"), F.greatest("one", "two").alias("b")).distinct()
    between = store(between, "links-between")
    if between.isEmpty():
        return labels
    joined = components(between)
    further = joined.select(F.col("id").alias("label"), F.col("label").alias("further"))
    moved = labels.join(further, "label", "left").select("id", F.coalesce("further", "label").alias("label"))
    # An id that no link had before stood for itself.
    return store(moved.unionByName(joined.join(labels, "id", "left_anti").select("id", "label")), "labels")


def near_duplicates(
    docs: DataFrame, words: int = 5, percent: int = 80, trees: int = TREES
) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row."""
    threshold = percent / 100
    signed = store(signatures(docs, words), "signatures")
    # Copies collapse to one set before any comparison; the smallest doc_id stands for it.
    sets = store(
        signed.filter("set_key IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy("set_key")
        .agg(F.min("doc_id").alias("id"), F.any_value("tokens").alias("tokens")),
        "sets",
    )
    # Four and a half deviations of the estimate below the threshold.
    least = int(TOKENS * threshold - 4.5 * (TOKENS * threshold * (1 - threshold)) ** 0.5)
    nodes, large = small_nodes(sets, threshold, trees)
    nodes = store(nodes, "small-nodes")
    pairs = store(first_candidates(nodes, sets, least), "pairs")
    wanted = pairs.select(F.col("a").alias("id")).union(pairs.select("b"))
    if large is not None:
        wanted = wanted.union(large.select("id"))
    wanted = wanted.distinct()
    full = store(full_sets(docs, wanted, words), "full-sets")
    edges = store(linked(pairs, full, percent), "links")
    # A candidate's two sets are in some forest of its node or in a large node, so ``full`` has all
    # sets asked for here.
    labels = components(edges)
    more, members = open_candidates(nodes, sets, labels, least)
    labels = merged(labels, linked(more, full, percent).unionByName(linked_in_nodes(members, full, percent)))
    if large is not None:
        far = store(left_over(large, full, labels, percent), "left-over")
        if not far.isEmpty():
            more, members = open_candidates(far, sets, labels, least)
            labels = merged(labels, linked(more, full, percent).unionByName(linked_in_nodes(members, full, percent)))
    found = sets.join(labels, "id", "left").select(
        "set_key", F.coalesce("label", "id").alias("component_id")
    )
    own = F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return (
        signed.select("doc_id", "n_shingles", "set_key").join(found, "set_key", "left")
        .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), own))
        .select(
            "doc_id", "n_shingles", "component_id",
            F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"),
        )
    )

"""N-gram Jaccard self-join: a MinHash LSH forest proposes, exact shingle sets decide.

Texts with equal shingle sets are one set from the start. A set has a signature of DEPTH minhashes in each of TREES trees.
The signatures of a tree, sorted, are its prefix trie: sets under one node are a run, and the prefix that a set shares
with its neighbours in the order is the longest that it shares with any. Sets that share a prefix of at least d are
candidates; they are compared exactly, block against block, where blocks are runs of the trie's order too.

The prefixes start at full length and shorten step by step. After each step the recall is estimated from the links
themselves: a link of similarity s meets at depth d with a known chance p, so it stands for 1 / p links. The steps end when
that estimate reaches the target, or at the depth where even links at the threshold are met with that chance.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import drop_table, hash_spans, hash_windows, mix, stage, text_bytes, text_slices, word_bounds

SHINGLE = 5
THRESHOLD = 0.8
TREES, DEPTH, RECALL = 24, 8, 0.9999
#: A side of a comparison is a block of sets that weigh so much together; a set weighs 1 for each UNIT shingles begun.
BLOCK, UNIT = 256, 512
#: Bytes of a minhash in a signature.
WIDTH = 2
_U = np.uint64
_BASE = 0xC2B2AE3D27D4EB4F


def meeting_chance(s, depth: int, trees: int = TREES):
    """The chance that sets of similarity s share a prefix of `depth` minhashes in one of the trees."""
    return 1 - (1 - s**depth) ** trees


def least_depth(trees: int = TREES, depth: int = DEPTH, threshold: float = THRESHOLD, recall: float = RECALL) -> int:
    """The longest prefix at which sets of Jaccard `threshold` meet with chance `recall`; at least 1."""
    while depth > 1 and meeting_chance(threshold, depth, trees) < recall:
        depth -= 1
    return depth


def shingles(batch: pa.RecordBatch, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of the distinct shingles of each row, sorted by row; a text of fewer words, but some, is one shingle."""
    raw, off = text_bytes(batch.column("text"))
    first, last, row = word_bounds(raw, off)
    words = hash_spans(raw, first, last)
    start = np.flatnonzero(row[: max(0, len(words) - size + 1)] == row[size - 1 :]) if len(words) >= size else np.zeros(0, np.int64)
    found, owner = hash_windows(words, size, _BASE)[start], row[start]
    n_words = np.bincount(row, minlength=batch.num_rows)
    short = np.flatnonzero((n_words > 0) & (n_words < size))
    if len(short):
        begin = np.concatenate([[0], np.cumsum(n_words)])
        extra = np.array([int(hash_windows(words[begin[i] : begin[i + 1]], int(n_words[i]), _BASE)[0]) ^ int(n_words[i]) for i in short], _U)
        found, owner = np.append(found, extra), np.append(owner, short)
    order = np.lexsort((found, owner))
    found, owner = found[order], owner[order]
    if len(found):
        fresh = np.append(True, (found[1:] != found[:-1]) | (owner[1:] != owner[:-1]))
        found, owner = found[fresh], owner[fresh]
    return found, owner


def sketch(docs: DataFrame, depth: int, trees: int = TREES, size: int = SHINGLE) -> DataFrame:
    """doc_id, text_hash, set_id (a digest of the shingle set, null without words), its size, and signs (its signatures, tree by tree)."""
    rng = np.random.default_rng(19)
    odd = rng.integers(0, 1 << 63, trees * depth, dtype=np.int64).astype(_U) * _U(2) + _U(1)
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                n = part.num_rows
                found, owner = shingles(part, size)
                some, at = np.unique(owner, return_index=True)
                ids: list[bytes | None] = [None] * n
                signs: list[bytes | None] = [None] * n
                sizes = np.bincount(owner, minlength=n)
                if len(some):
                    a, b = np.add.reduceat(mix(found), at), np.add.reduceat(mix(found ^ _U(_BASE)), at)
                    count = np.diff(np.append(at, len(found)))
                    least = np.empty((len(some), trees * depth), ">u2")
                    for k in range(trees * depth):
                        least[:, k] = mix(np.minimum.reduceat(found * odd[k], at)) >> _U(48)
                    for i, row in enumerate(some):
                        ids[row] = hashlib.blake2b(a[i].tobytes() + b[i].tobytes() + count[i].tobytes(), digest_size=16).digest()
                        signs[row] = least[i].tobytes()
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text_hash"), pa.array(ids, pa.binary()), pa.array(sizes, pa.int64()), pa.array(signs, pa.binary())], ["doc_id", "text_hash", "set_id", "size", "signs"])

    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    return rows.mapInArrow(run, f"doc_id {kind}, text_hash long, set_id binary, size long, signs binary")


def sorted_matches(sets: DataFrame, least: int, depth: int = DEPTH, trees: int = TREES) -> DataFrame:
    """(num, tree, sign, deep) of sets (num, signs) that share a prefix of `least` minhashes or more with another set.

    deep is the length of the longest prefix that the set shares in the tree. Each tree is sorted as a whole, by ranges of
    (tree, signature, number), so a prefix that very many sets share is spread over as many tasks as it needs; every row looks at
    its two neighbours only. A row at the edge of a range counts as matched, whether or not its neighbour beyond matches.
    """
    width = depth * WIDTH
    numbers = F.sequence(F.lit(0), F.lit(trees - 1))
    each = sets.select("num", F.posexplode(F.transform(numbers, lambda t: F.substring("signs", t * width + 1, F.lit(width)))).alias("tree", "sign"))
    line = each.repartitionByRange("tree", "sign", "num").sortWithinPartitions("tree", "sign", "num")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, before = None, depth  # the last row, which still waits for its right neighbour, and its match to the left

        def out(rows: pa.Table, deep: np.ndarray) -> pa.RecordBatch:
            hit = deep >= least
            kept = rows.filter(pa.array(hit)).combine_chunks()
            return pa.RecordBatch.from_arrays([*(kept.column(c).combine_chunks() for c in ("num", "tree", "sign")), pa.array(deep[hit], pa.int32())], ["num", "tree", "sign", "deep"])

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            if held is not None:
                rows = pa.concat_tables([held, rows]).combine_chunks()
            sign = np.frombuffer(b"".join(rows.column("sign").to_pylist()), ">u2").reshape(-1, depth)
            tree = rows.column("tree").to_numpy()
            shared = np.where(tree[1:] == tree[:-1], np.cumprod(sign[1:] == sign[:-1], axis=1, dtype=np.int64).sum(axis=1), 0)
            left = np.concatenate([[before], shared])
            yield out(rows.slice(0, len(rows) - 1), np.maximum(left[:-1], shared))
            held, before = rows.slice(len(rows) - 1), int(left[-1])
        if held is not None:
            yield out(held, np.array([depth]))

    return line.mapInArrow(run, "num long, tree int, sign binary, deep int")


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root): one root for each connected component, from edges (a, b); nodes on edges only.

    Each round every node moves to the smallest node beside it, and on to where that one moves; then the edges are
    drawn between the places that the nodes have moved to and those that fall together vanish, so that a group of near
    copies is one node after the first round or two. Node ids are digests, hence in random order, and chains of falling
    ids are short. Rounds are written to the shared folder; the driver only asks whether an edge is left.
    """
    left = stage(edges.select("a", "b").where("a <> b").distinct(), "edges")
    labels = None
    for _ in range(rounds):
        old = (left, labels)
        near = left.select("a", "b").union(left.select("b", "a")).groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near"))
        step = stage(near.select("node", F.least("node", "near").alias("to")), "steps")
        moved = step.join(step.select(F.col("node").alias("to"), F.col("to").alias("on")), "to", "left").select("node", F.coalesce("on", "to").alias("root"))
        if labels is None:
            labels = moved
        else:
            labels = labels.join(moved.select(F.col("node").alias("root"), F.col("root").alias("on")), "root", "left").select("node", F.coalesce("on", "root").alias("root"))
        labels = stage(labels, "labels")
        a, b = moved.select(F.col("node").alias("a"), F.col("root").alias("_a")), moved.select(F.col("node").alias("b"), F.col("root").alias("_b"))
        left = stage(left.join(a, "a").join(b, "b").select(F.col("_a").alias("a"), F.col("_b").alias("b")).where("a <> b").distinct(), "edges")
        for written in (*old, step):
            drop_table(written)
        if left.isEmpty():
            return labels
    raise RuntimeError(f"edges are left after {rounds} rounds")


_PACK = "block long, nums array<long>, set_ids binary, members binary, signs binary, sizes binary, shingles binary, counts binary, owners binary"
_PACK_TYPES = [pa.int64(), pa.list_(pa.int64()), *[pa.binary()] * 7]


def _packed(size: int):
    """One row per block of sets, which come sorted by block: the distinct shingles, sorted, and which sets hold each."""

    def pack(block: int, rows: list[tuple]) -> tuple:
        nums, ids, members, signs, texts = zip(*rows, strict=True)
        found, owner = shingles(pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"]), size)
        order = np.argsort(found, kind="stable")
        values, counts = np.unique(found[order], return_counts=True)
        sizes = np.bincount(owner, minlength=len(rows))
        return (
            block, list(nums), b"".join(ids), np.array(members, np.int64).tobytes(), b"".join(signs), sizes.astype(np.int64).tobytes(),
            values.tobytes(), counts.astype(np.uint32).tobytes(), owner[order].astype(np.uint32).tobytes(),
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, held = None, []

        def made() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(pack(of, held), _PACK_TYPES, strict=True)], [x.split()[0] for x in _PACK.split(", ")])

        for batch in batches:
            for block, *row in zip(*(batch.column(c).to_pylist() for c in ("block", "num", "set_id", "members", "signs", "text")), strict=True):
                if held and block != of:
                    yield made()
                    held = []
                of = block
                held.append(tuple(row))
        if held:
            yield made()

    return run


class _Block:
    """A side of a comparison, read from a pack."""

    def __init__(self, row: dict, depth: int, trees: int):
        self.ids = [row["set_ids"][k : k + 16] for k in range(0, len(row["set_ids"]), 16)]
        self.members, self.sizes = np.frombuffer(row["members"], np.int64), np.frombuffer(row["sizes"], np.int64)
        self.signs = np.frombuffer(row["signs"], ">u2").reshape(len(self.ids), trees, depth)
        self.values, counts = np.frombuffer(row["shingles"], _U), np.frombuffer(row["counts"], np.uint32)
        self.at, self.owners = np.repeat(np.arange(len(counts)), counts), np.frombuffer(row["owners"], np.uint32)

    def prefixes(self, n: int) -> np.ndarray:
        """A hash of the first n minhashes of each set, tree by tree."""
        out = np.zeros(self.signs.shape[:2], _U)
        for k in range(n):
            out = mix(out + self.signs[:, :, k].astype(_U) + _U(k + 1))
        return np.ascontiguousarray(out.T)

    def columns(self, which: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(set, place in which) of each entry whose shingle is one of which, in order of place."""
        place = np.full(len(self.values), -1)
        place[which] = np.arange(n)
        at = place[self.at]
        return self.owners[at >= 0], at[at >= 0]


def _met_at(a: _Block, b: _Block, level: int, depth: int) -> np.ndarray:
    """Which sets of a and b share a prefix of just `level` minhashes at the longest, over all trees."""
    met = []
    for n in (level, level + 1):
        share = np.zeros((len(a.ids), len(b.ids)), bool)
        if n <= depth:
            x, y = a.prefixes(n), b.prefixes(n)
            for t in range(x.shape[0]):
                share |= x[t][:, None] == y[t][None, :]
        met.append(share)
    return met[0] & ~met[1]


def _shared(a: _Block, b: _Block) -> np.ndarray:
    """How many shingles each set of a shares with each set of b, by products of 0-1 matrices."""
    _, of_a, of_b = np.intersect1d(a.values, b.values, assume_unique=True, return_indices=True)
    n, meet = len(of_a), np.zeros((len(a.ids), len(b.ids)), np.float32)
    (rows_a, at_a), (rows_b, at_b) = a.columns(of_a, n), b.columns(of_b, n)
    step = max(64, (1 << 20) // max(len(a.ids), len(b.ids)))
    for low in range(0, n, step):
        x, y = np.zeros((len(a.ids), step), np.float32), np.zeros((len(b.ids), step), np.float32)
        for m, rows, at in ((x, rows_a, at_a), (y, rows_b, at_b)):
            i, j = np.searchsorted(at, (low, low + step))
            m[rows[i:j], at[i:j] - low] = 1
        meet += x @ y.T
    return meet


def _compare(threshold: float, level: int, depth: int, least: int, trees: int):
    """Stream pairs of packs; per task and set: links, the smallest set that the task has tied it to, how many links of
    sets it has, and how many those stand for at each depth."""
    names = ["set_id", "links", "tied", "met", *[f"all_{d}" for d in range(least, depth + 1)]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tied: dict[bytes, bytes] = {}
        sums: dict[bytes, np.ndarray] = {}

        def root(x: bytes) -> bytes:
            while (up := tied.setdefault(x, x)) != x:
                tied[x] = tied[up]
                x = up
            return x

        def out() -> pa.RecordBatch:
            ids = list(sums)
            of = np.stack([sums[x] for x in ids])
            counted = [pa.array(ids, pa.binary()), pa.array(of[:, 0].astype(np.int64)), pa.array([root(x) for x in ids], pa.binary()), pa.array(of[:, 1].astype(np.int64))]
            return pa.RecordBatch.from_arrays([*counted, *(pa.array(of[:, k]) for k in range(2, of.shape[1]))], names)

        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k].as_py() for c in batch.schema.names}
                same = row["i"] == row["j"]
                a = _Block({c[2:]: v for c, v in row.items() if c.startswith("a_")}, depth, trees)
                b = a if same else _Block({c[2:]: v for c, v in row.items() if c.startswith("b_")}, depth, trees)
                met = _met_at(a, b, level, depth)
                if same:
                    np.fill_diagonal(met, False)
                if not met.any():
                    continue
                meet = _shared(a, b)
                union = a.sizes[:, None] + b.sizes[None, :] - meet
                linked = met & (meet >= threshold * union - 1e-6)
                s = np.clip(meet / union, threshold, 1).astype(float)
                stands = [np.where(linked, 1 / meeting_chance(s, d, trees), 0) for d in range(least, depth + 1)]
                for side, other, axis in ((a, b, 1),) if same else ((a, b, 1), (b, a, 0)):
                    counted = np.stack([(linked @ other.members if axis else a.members @ linked), linked.sum(axis=axis), *(w.sum(axis=axis) for w in stands)], axis=1).astype(float)
                    for i in np.flatnonzero(counted[:, 1]):
                        x = side.ids[i]
                        sums[x] = sums[x] + counted[i] if x in sums else counted[i]
                for i, j in _spanning(linked):
                    x, y = root(a.ids[i]), root(b.ids[j])
                    tied[max(x, y)] = min(x, y)
            if len(sums) > 100_000:
                yield out()
                sums, tied = {}, {}
        if sums:
            yield out()

    return run, "set_id binary, links long, tied binary, met long, " + ", ".join(f"{c} double" for c in names[4:])


def _spanning(linked: np.ndarray) -> Iterator[tuple[int, int]]:
    """Links that tie together all that linked ties together: each row's first link, and each column's."""
    for axis in (1, 0):
        some = np.flatnonzero(linked.any(axis=axis))
        for k, first in zip(some, linked.argmax(axis=axis)[some], strict=True):
            yield (int(k), int(first)) if axis else (int(first), int(k))


def _nodes(matches: DataFrame, level: int) -> DataFrame:
    """(num, node) of the matched sets' trie nodes at a depth."""
    return matches.where(F.col("deep") >= level).select("num", F.xxhash64("tree", F.substring("sign", 1, level * WIDTH)).alias("node"))


def _block_pairs(nodes: DataFrame, placed: DataFrame) -> DataFrame:
    """Blocks (i, j), i <= j, of which some sets share a node.

    A node passes on its distinct blocks and not its sets, 64 to a word of bits. What a node tells of block i is the words
    from its own on, which are united by (i, word) before they become pairs, so a pair comes out once, however many nodes
    tell of it. A node of n blocks is one row of n / 64 words; these are paired as rows of their own, of fixed size, so
    that no row or buffer holds the pairs of a large node, and are dealt anew before they become pairs of blocks.
    """
    held = nodes.join(placed, "num").groupBy("node", "block").agg(F.count("*").alias("n"))
    inside = held.where("n > 1").select(F.col("block").alias("i")).distinct().select("i", F.col("i").alias("j"))
    word, bit = F.floor(F.col("block") / 64), F.expr("shiftleft(1L, cast(pmod(block, 64) AS int))")
    words = held.groupBy("node", word.alias("word")).agg(F.bit_or(bit).alias("mask"))
    met = words.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("word", "mask"))).alias("words"))
    met = met.where("size(words) > 1 OR bit_count(words[0].mask) > 1").select("words").distinct()
    # two explodes of one array, streamed: a row for each pair of words
    ahead = met.select("words", F.posexplode("words").alias("k", "a")).select("a", F.explode(F.slice("words", F.col("k") + 1, F.size("words"))).alias("b"))
    ahead = ahead.select(F.col("a.word").alias("word"), F.col("a.mask").alias("mask"), F.col("b.word").alias("later"), F.col("b.mask").alias("others"))
    ahead = ahead.groupBy("word", "mask", "later").agg(F.bit_or("others").alias("others"))
    own = ahead.select("word", "later", "others", F.explode(_bits("mask")).alias("k"))
    above = F.when(F.col("later") == F.col("word"), F.expr("others & shiftleft(-2L, k)")).otherwise(F.col("others"))
    across = own.select((F.col("word") * 64 + F.col("k")).alias("i"), "later", above.alias("others")).where("others != 0")
    across = across.groupBy("i", "later").agg(F.bit_or("others").alias("others"))
    return inside.unionByName(across.select("i", F.explode(_bits("others")).alias("k"), "later").select("i", (F.col("later") * 64 + F.col("k")).alias("j")))


def _bits(mask: str) -> Column:
    """The places of the bits that are set in a long."""
    return F.filter(F.sequence(F.lit(0), F.lit(63)), lambda k: F.getbit(mask, k) == 1)


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The weight of the sets before each, within the task."""
    total = 0
    for batch in batches:
        weight = np.maximum(1, -(-batch.column("size").to_numpy() // UNIT))
        upto = total + np.cumsum(weight)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(upto - weight), pa.array(upto)], [*batch.schema.names, "before", "upto"])
        total = int(upto[-1]) if len(upto) else total


def _in_blocks(met: DataFrame, block: int) -> DataFrame:
    """met (num, root, sign, set_id, size) with block: runs of about equal weight in the order of group and signature."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in met.schema)
    line = met.repartitionByRange("root", "sign", "set_id").sortWithinPartitions("root", "sign", "set_id").mapInArrow(_running, f"{fields}, before long, upto long")
    line = stage(line.withColumn("task", F.spark_partition_id()), "line")
    ahead = F.coalesce(F.sum("all").over(Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row per task
    starts = line.groupBy("task").agg(F.max("upto").alias("all")).select("task", ahead.alias("ahead"))
    return line.join(F.broadcast(starts), "task").withColumn("block", F.floor((F.col("ahead") + F.col("before")) / block)).drop("task", "ahead", "before", "upto")


def classes(
    docs: DataFrame, threshold: float = THRESHOLD, trees: int = TREES, depth: int = DEPTH, recall: float = RECALL, block: int = BLOCK, size: int = SHINGLE, levels: list | None = None
) -> DataFrame:
    """Per row of docs: doc_id, class_id, n_links.

    Texts are linked if the Jaccard similarity of their sets of `size`-word shingles is at least threshold. class_id is the
    smallest doc_id that links lead to; n_links is the number of other rows that this row is linked to itself. Texts
    without words (null, empty) are linked to nothing and are their own class. A null doc_id is larger than any other; a
    class that has no other id has a null class_id. Rows that share an id count apart. levels, if given, gets (depth,
    estimated recall) of each step.

    Equal sets are counted before the shuffle and appear once from then on. Only sets that share a prefix of the least
    depth leave the sorted tries, and their texts are fetched once. They are cut in blocks that weigh `block`, runs in
    the order of their group and of a trie, and a block is one row from then on: its sets' shingles, each once. A step
    compares only blocks that share a node of its depth, so a long chain of near copies is compared along its length, and
    of those only the sets whose longest shared prefix is of that depth; each task adds up what it finds by set. Counting
    the links of n short sets that are all similar to each other does take n * n / (2 * block * block) rows and matrix
    products, spread over the tasks.
    """
    least = least_depth(trees, depth, threshold, recall)
    sketches = stage(sketch(docs, depth, trees, size), "sketches")
    worded = sketches.where("set_id is not null")
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    sets = worded.groupBy("set_id").agg(F.min(first).alias("first"), F.count("*").alias("members"), F.first("size").alias("size"), F.first("signs").alias("signs"))
    sets = stage(sets.withColumn("num", F.xxhash64("set_id")), "sets")
    matches = stage(sorted_matches(sets.select("num", "signs"), least, depth, trees), "matches")
    nodes = _nodes(matches, least)
    hubs = nodes.groupBy("node").agg(F.min("num").alias("hub"), F.count("*").alias("n")).where("n > 1").select("node", "hub")
    star = nodes.join(hubs, "node").where("num > hub").select(F.col("num").alias("a"), F.col("hub").alias("b")).distinct()
    groups = components(star).withColumnRenamed("node", "num")
    key = [F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_id"), "text_hash"]
    met = sets.join(groups, "num").select("num", "set_id", "members", "size", "signs", "root", F.coalesce(F.col("first.doc_id").cast("string"), F.lit("")).alias("_id"), F.col("first.text_hash").alias("text_hash"))
    line = _in_blocks(met.withColumn("sign", F.substring("signs", 1, depth * WIDTH)), block)
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").select(*key, "text")
    found = texts.join(line.drop("root", "sign", "size").hint("shuffle_hash"), ["_id", "text_hash"]).select("block", "num", "set_id", "members", "signs", "text").dropDuplicates(["set_id"])
    packs = stage(found.repartition("block").sortWithinPartitions("block", "set_id").mapInArrow(_packed(size), _PACK), "packs")
    placed = line.select("num", "block")
    sides = [packs.select(*(F.col(c).alias(f"{side}_{c}") for c in packs.columns if c != "nums")) for side in "ab"]
    compared = None
    for level in range(depth, least - 1, -1):
        run, schema = _compare(threshold, level, depth, least, trees)
        pairs = _block_pairs(_nodes(matches, level), placed).join(sides[0], F.col("i") == F.col("a_block")).join(sides[1], F.col("j") == F.col("b_block"))
        links = stage(pairs.mapInArrow(run, schema), "compared")
        compared = links if compared is None else compared.unionByName(links)
        seen = compared.agg(F.sum("met").alias("met"), F.sum(f"all_{level}").alias("all")).first()
        reached = seen["met"] / seen["all"] if seen["met"] else 1.0
        if levels is not None:
            levels.append((level, reached))
        if seen["met"] and reached >= recall:
            break
    tied = components(compared.where("set_id > tied").select(F.col("set_id").alias("a"), F.col("tied").alias("b")))
    links = compared.groupBy("set_id").agg(F.sum("links").alias("links"))
    rooted = sets.join(tied.withColumnRenamed("node", "set_id"), "set_id", "left").join(links, "set_id", "left").select("set_id", "first", "members", F.coalesce("root", "set_id").alias("root"), F.coalesce("links", F.lit(0)).alias("links"))
    named = rooted.where("root != set_id or links > 0").groupBy("root").agg(F.min(F.struct("first.none", "first.doc_id")).alias("least")).select("root", F.col("least.doc_id").alias("class_id"), F.lit(True).alias("tied"))
    final = rooted.join(named, "root", "left").select(
        "set_id", F.when(F.col("tied"), F.col("class_id")).otherwise(F.col("first.doc_id")).alias("class_id"), (F.col("links") + F.col("members") - 1).alias("n_links")
    )
    with_words = worded.select("doc_id", "set_id").join(final, "set_id").select("doc_id", "class_id", "n_links")
    wordless = sketches.where("set_id is null").select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    return with_words.unionByName(wordless)

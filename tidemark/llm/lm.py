"""Language-model scoring: a log-bilinear model trained with noise-contrastive estimation in numpy.

The model predicts a token's class from the classes of the two before. The OWN most frequent tokens are classes of their
own; all other words, however many there are and known or not, share TAILS classes by their last three bytes, and in
such a class a word has the share of its count, with one more for an unknown word. So every word takes part, as a target
and as context. Counts cover all training texts. Since a context is two classes, every normaliser is an entry of one
matrix product, so scores are exactly normalised and looked up.

All training text counts: since the model sees of a token its class and the two before, Spark adds up the text to counts
of such triples, and training runs over the triples with their counts as weights.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hash_spans, mix, stage, text_bytes, text_slices, word_bounds
from .langid import fold_of

#: Tokens that are classes of their own, and classes of all other words by their ending.
OWN, TAILS = 512, 512
DIMENSIONS = 32
#: Words whose counts are broadcast (12 bytes each); the counts of all others reach the texts by a join.
FREQUENT = 1 << 18
#: Visits that a task holds at once while it trains on a shard; a visit of a triple stands for at most VISIT of its occurrences.
HELD, VISIT = 1 << 20, 16
#: A shard has about so many visits, however many there are in all.
SHARD = 500_000
#: Distinct triples that one task adds up, about, and that one packed row has at most.
PART, BLOCK = 1 << 20, 1 << 16
#: A batch is BATCH groups of at most GROUP visits; RATE goes with that.
ROUNDS, BATCH, GROUP, NOISE, NOISE_PER_TOKEN, RATE = 3, 512, 2, 256, 16, 0.2
PIECES = 64
_U = np.uint64
END = np.frombuffer(np.array([0x5D8A1C0FB3E17A29], _U).tobytes(), _U)[0]
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def endings(raw: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The class by ending, 0 to TAILS - 1, of each byte span: a hash of its last three bytes, or of all if it has fewer."""
    packed = np.zeros(len(first), _U)
    for back in range(3):
        at = last - 1 - back
        packed = packed * _U(256) + np.where(at >= first, raw[np.maximum(at, first)], 0).astype(_U)
    return (mix(packed) % _U(TAILS)).astype(np.int32)


def tokens(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, row, class by ending) of each token of the column text: the words with A-Z lowered, and END after each row's words, whose ending is 0."""
    raw, off = text_bytes(batch.column("text"))
    raw = _LOWER[raw]
    first, last, row = word_bounds(raw, off)
    n = batch.num_rows
    words = np.bincount(row, minlength=n)
    out_row = np.repeat(np.arange(n), words + 1)
    out = np.full(len(first) + n, END, _U)
    ends = np.cumsum(words + 1) - 1
    inner = np.ones(len(out), bool)
    inner[ends] = False
    out[inner] = hash_spans(raw, first, last)
    tail = np.zeros(len(out), np.int32)
    if len(first):
        tail[inner] = endings(raw, first, last)
    return out, out_row, tail


def count_tokens(texts: DataFrame) -> DataFrame:
    """word (64-bit hash), tail (its class by ending), n: counts over all rows of texts. Each task adds up what it has read before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def summed() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            words, tail, n = (np.concatenate([x[i] for x in held]) for i in range(3))
            found, first, at = np.unique(words, return_index=True, return_inverse=True)
            return found, tail[first], np.bincount(at, weights=n).astype(np.int64)

        def out(words: np.ndarray, tail: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
            for at in range(0, len(words), 1 << 16):
                cut = slice(at, at + (1 << 16))
                yield pa.RecordBatch.from_arrays([pa.array(words[cut].view(np.int64)), pa.array(tail[cut]), pa.array(n[cut])], ["word", "tail", "n"])

        for batch in batches:
            for part in text_slices(batch):
                words, _, tail = tokens(part)
                found, first, n = np.unique(words, return_index=True, return_counts=True)
                held.append((found, tail[first], n))
                size += len(found)
                if size > 4_000_000:
                    merged = summed()
                    if len(merged[0]) > 2_000_000:
                        yield from out(*merged)
                        held, size = [], 0
                    else:
                        held, size = [merged], len(merged[0])
        if held:
            yield from out(*summed())

    return texts.select("text").mapInArrow(run, "word long, tail int, n long").groupBy("word").agg(F.max("tail").alias("tail"), F.sum("n").alias("n"))


class Vocabulary:
    """Counts of the most frequent words, and totals by ending: what scoring needs besides the join. Pickled into a broadcast.

    Classes 0 to own - 1 are words, the TAILS after them endings. tail_n and tail_words are the occurrences and the
    distinct words of each ending in all of the training text.
    """

    def __init__(self, words: np.ndarray, tail: np.ndarray, n: np.ndarray, tail_n: np.ndarray, tail_words: np.ndarray, own: int = OWN):
        ranked = np.lexsort((words, -n))[:own]
        self.own, self.size = len(ranked), len(ranked) + TAILS
        self.total, self.distinct = int(tail_n.sum()), int(tail_words.sum())
        place = self.own + tail.astype(np.int32)
        place[ranked] = np.arange(self.own)
        by_hash = np.argsort(words)
        self.words, self.n, self.place = words[by_hash], n[by_hash], place[by_hash]
        self.rest_n = tail_n - np.bincount(tail[ranked], weights=n[ranked], minlength=TAILS).astype(np.int64)
        self.rest_words = tail_words - np.bincount(tail[ranked], minlength=TAILS)
        p = np.append(n[ranked], self.rest_n).astype(float) + 0.5
        self.prior = p / p.sum()
        self.end = int(self.look_up(np.array([END], _U), np.zeros(1, np.int32))[0][0])

    def look_up(self, words: np.ndarray, tail: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(class, count, whether the count is known here) of each word."""
        if not len(self.words):
            return self.own + tail, np.zeros(len(words), np.int64), np.zeros(len(words), bool)
        at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        hit = self.words[at] == words
        return np.where(hit, self.place[at], self.own + tail), np.where(hit, self.n[at], 0), hit

    def rest_logs(self) -> np.ndarray:
        """log10 of what the counts of each class are divided by, once one is added to each and to an unknown word; 0 for words of their own."""
        return np.append(np.zeros(self.own), np.log10(self.rest_n + self.rest_words + 1.0))


def vocabulary(counts: DataFrame, own: int = OWN, frequent: int = FREQUENT) -> Vocabulary:
    """Totals of counts and its at most `frequent` most frequent words; the cut is where a histogram of 16ths of octaves says."""
    tail_n, tail_words = np.zeros(TAILS, np.int64), np.zeros(TAILS, np.int64)
    for r in counts.groupBy("tail").agg(F.count("*").alias("words"), F.sum("n").alias("tokens")).collect():
        tail_n[r["tail"]], tail_words[r["tail"]] = r["tokens"], r["words"]
    octave = F.floor(F.log2("n") * 16)
    kept, least = 0, None
    for step, words in sorted(((r["step"], r["words"]) for r in counts.groupBy(octave.alias("step")).agg(F.count("*").alias("words")).collect()), reverse=True):
        if kept + words > frequent:
            break
        kept, least = kept + words, step
    if least is None:
        return Vocabulary(np.zeros(0, _U), np.zeros(0, np.int32), np.zeros(0, np.int64), tail_n, tail_words, own)
    top = counts.where(octave >= least).select("word", "tail", "n").toArrow()
    words, tail, n = (top.column(c).to_numpy() for c in ("word", "tail", "n"))
    return Vocabulary(words.astype(np.int64).view(_U), tail.astype(np.int32), n.astype(np.int64), tail_n, tail_words, own)


def contexts(ids: np.ndarray, end: int, fresh: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(class one back, class two back) of each token; before a text's first token stand END tokens."""
    one, two = np.empty_like(ids), np.empty_like(ids)
    one[0] = end
    one[1:] = ids[:-1]
    one[fresh] = end
    two[0] = end
    two[1:] = one[:-1]
    two[fresh] = end
    return one, two


def groups(context: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, begin, length): visits in an order that has each group, at most GROUP visits of one context, side by side; random otherwise."""
    n = len(context)
    order = rng.permutation(n)
    order = order[np.argsort(context[order], kind="stable")]
    context = context[order]
    first = np.flatnonzero(np.append(True, context[1:] != context[:-1]))
    place = np.arange(n) - np.repeat(first, np.diff(np.append(first, n)))
    first = np.flatnonzero(place % GROUP == 0)
    length = np.diff(np.append(first, n))
    turn = rng.permutation(len(first))
    first, length = first[turn], length[turn]
    begin = np.cumsum(length) - length
    return order[np.repeat(first - begin, length) + np.arange(n)], begin, length


class Model:
    def __init__(self, v: Vocabulary, dimensions: int = DIMENSIONS, seed: int = 5):
        rng, k, self.trained = np.random.default_rng(seed), v.size, 0
        self.shapes = [(k, dimensions), (k, dimensions), (dimensions, dimensions), (dimensions, dimensions), (k,)]
        eye = np.eye(dimensions)
        self.set(np.concatenate([x.ravel() for x in (rng.normal(0, 0.1, self.shapes[0]), rng.normal(0, 0.1, self.shapes[1]), eye, eye * 0.6, np.log(v.prior))]).astype(np.float32))

    def set(self, flat: np.ndarray) -> None:
        # filled, not copied: np.add.at is slow on the type object of an unpickled array
        self.flat, at, self.parts = np.empty(len(flat), np.float32), 0, []
        self.flat[:] = flat
        for shape in self.shapes:
            n = int(np.prod(shape))
            self.parts.append(self.flat[at : at + n].reshape(shape))
            at += n

    def train(self, ids: np.ndarray, one: np.ndarray, two: np.ndarray, weight: np.ndarray, prior: np.ndarray, rate: float, rng: np.random.Generator, squares: list[np.ndarray]) -> None:
        """One pass of noise-contrastive estimation over weighted triples, Adagrad steps; a batch shares its noise words.

        Visits of one context go in groups of at most GROUP, and a batch is BATCH groups: what the noise words add depends
        on the context alone, so a group computes it once, times its weight. squares, from fresh_squares(), go on from
        call to call. Rows that neither the batch nor its noise names have no gradient and stay.
        """
        r, q, c1, c2, b = self.parts
        k, d = q.shape
        edges = np.cumsum(prior)
        log_kq = np.log(NOISE_PER_TOKEN * prior).astype(np.float32)
        cell = np.arange(max(k, BATCH) * d).reshape(-1, d)
        terms = np.empty((BATCH, NOISE), np.float32)

        def added(rows: np.ndarray, g: np.ndarray, n: int) -> np.ndarray:
            """g's rows added up by number, n rows."""
            out = np.zeros(n * d, np.float32)
            np.add.at(out, cell.take(rows, axis=0).ravel(), g.ravel())
            return out.reshape(n, d)

        def step(part: int, g: np.ndarray, scale: float) -> None:
            squares[part] += g * g
            g *= np.float32(rate * scale)
            g /= np.sqrt(squares[part])
            self.parts[part] += g

        order, begin, length = groups(two * k + one, rng)
        ids, weight = ids[order], weight[order].astype(np.float32)
        one, two, end = one[order[begin]], two[order[begin]], begin + length
        for at in range(0, len(begin), BATCH):
            to = min(at + BATCH, len(begin))
            n, i, j = to - at, begin[at], end[to - 1]
            w, times, w1, w2 = ids[i:j], weight[i:j], one[at:to], two[at:to]
            of = np.repeat(np.arange(n), length[at:to])
            noise = np.minimum(np.searchsorted(edges, rng.random(NOISE)), k - 1)
            r1, r2, qw, qn = r.take(w1, axis=0), r.take(w2, axis=0), q.take(w, axis=0), q.take(noise, axis=0)
            h = r1 @ c1 + r2 @ c2
            hw, less = h.take(of, axis=0), log_kq - b
            size = np.sqrt(times.sum())
            # exp may overflow to infinity, which is a share of 0
            with np.errstate(over="ignore"):
                good = times / size / (1 + np.exp(np.einsum("ij,ij->i", hw, qw) - less[w]))
                bad = np.matmul(h, -qn.T, out=terms[:n])
                bad += less[noise]
                np.exp(bad, out=bad)
            bad += 1
            np.reciprocal(bad, out=bad)
            total = (np.bincount(of, weights=times, minlength=n) * NOISE_PER_TOKEN / NOISE / size).astype(np.float32)
            hw *= good[:, None]
            qw *= good[:, None]
            dh = added(of, qw, n) - total[:, None] * (bad @ qn)
            to_q = added(w, hw, k) - added(noise, bad.T @ (total[:, None] * h), k)
            to_b = (np.bincount(w, weights=good, minlength=k) - np.bincount(noise, weights=total @ bad, minlength=k)).astype(np.float32)
            to_r = added(np.concatenate([w1, w2]), np.concatenate([dh @ c1.T, dh @ c2.T]), k)
            to_c1, to_c2 = r1.T @ dh, r2.T @ dh
            for part, g, scale in ((0, to_r, 1.0), (1, to_q, 1.0), (4, to_b, 0.3), (2, to_c1, 0.1), (3, to_c2, 0.1)):
                step(part, g, scale)

    def fresh_squares(self) -> list[np.ndarray]:
        return [np.full(p.shape, 1e-2, np.float32) for p in self.parts]

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """a1[w1, w] + a2[w2, w] - z[w1, w2] is the log probability of w after w2, w1; all by matrix products."""
        r, q, c1, c2, b = self.parts
        a1, a2 = (r @ c1) @ q.T + b, (r @ c2) @ q.T
        top1, top2 = a1.max(axis=1, keepdims=True), a2.max(axis=1, keepdims=True)
        z = np.log(np.maximum(np.exp(a1 - top1).astype(np.float64) @ np.exp(a2 - top2).astype(np.float64).T, 1e-300)) + top1 + top2.T
        return a1, a2, z.astype(np.float32)


def packed(arrays: dict[str, np.ndarray], keys: dict[str, list]) -> pa.RecordBatch:
    """One row for each range of `arrays`, which are cut at keys["at"]: the values of keys and the arrays' bytes."""
    at = keys.pop("at")
    columns = {k: pa.array(x) for k, x in keys.items()}
    for name, x in arrays.items():
        columns[name] = pa.array([x[i:j].tobytes() for i, j in zip(at[:-1], at[1:], strict=True)], pa.binary())
    return pa.RecordBatch.from_pydict(columns)


def unpacked(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int64)


def pack_triples(texts: DataFrame, v: Vocabulary, part_triples: int = PART) -> DataFrame:
    """first, visits, triple, n: blocks of at most BLOCK distinct triples with their counts, each packed to bytes.

    A triple of classes (two back, one back, here) is one number and lies in one block. Tasks combine what they have
    read and send each part of the triples as one row; parts are as many as keep about part_triples in each.
    """
    shared = texts.sparkSession.sparkContext.broadcast(v)
    # about part_triples distinct triples in a part, and at most 16 times as many occurrences read for it
    parts = max(1, -(-min(v.total, v.size**3) // part_triples), -(-v.total // (16 * part_triples)))

    def triples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def out() -> pa.RecordBatch:
            found, n = np.unique(np.concatenate(held), return_counts=True)
            part = (mix(found.view(_U)) % _U(parts)).astype(np.int32)
            order = np.argsort(part, kind="stable")
            part = part[order]
            at = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
            return packed({"triple": found[order], "n": n[order]}, {"at": np.append(at, len(part)), "part": part[at]})

        for batch in batches:
            for slice_ in text_slices(batch):
                words, row, tail = tokens(slice_)
                ids = shared.value.look_up(words, tail)[0].astype(np.int64)
                one, two = contexts(ids, shared.value.end, np.searchsorted(row, np.arange(slice_.num_rows)))
                held.append((two * shared.value.size + one) * shared.value.size + ids)
                size += len(ids)
                if size > HELD * 2:
                    yield out()
                    held, size = [], 0
        if held:
            yield out()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def summed() -> tuple[np.ndarray, np.ndarray]:
            triple, n = (np.concatenate([x[i] for x in held]) for i in (0, 1))
            order = np.argsort(triple)
            triple = triple[order]
            at = np.flatnonzero(np.append(True, triple[1:] != triple[:-1]))
            return triple[at], np.add.reduceat(n[order], at)

        for batch in batches:
            held.append((unpacked(batch.column("triple")), unpacked(batch.column("n"))))
            size += len(held[-1][0])
            if size > 4 * part_triples:
                held = [summed()]
                # what stays is distinct; twice as much again may come before the next merge
                size = min(len(held[0][0]), 2 * part_triples)
        if not held:
            return
        triple, n = summed()
        # blocks are a fair draw of the part, alike at every run
        order = np.random.default_rng(len(triple)).permutation(len(triple))
        triple, n = triple[order], n[order]
        for at in range(0, len(triple), BLOCK):
            cut = slice(at, at + BLOCK)
            visits = int((-(-n[cut] // VISIT)).sum())
            yield packed({"triple": triple[cut], "n": n[cut]}, {"at": [0, len(triple[cut])], "first": [int(triple[at])], "visits": [visits]})

    sent = texts.select("text").mapInArrow(triples, "part int, triple binary, n binary")
    return sent.repartition(parts, "part").select("triple", "n").mapInArrow(merge, "first long, visits long, triple binary, n binary")


def count_triples(texts: DataFrame, v: Vocabulary) -> DataFrame:
    """triple, n: how often each triple of classes (two back, one back, here) occurs in texts, packed to one number."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(unpacked(batch.column(c))) for c in ("triple", "n")], ["triple", "n"])

    return pack_triples(texts, v).select("triple", "n").mapInArrow(rows, "triple long, n long")


def deal(blocks: DataFrame, shards: int) -> DataFrame:
    """shard, first, triple, n: the blocks' triples dealt over shards, still packed.

    A triple goes to as many shards as it has visits, its occurrences dealt evenly, from a hashed shard on.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                triple, n = (unpacked(batch.column(c).slice(row, 1)) for c in ("triple", "n"))
                of = np.minimum(-(-n // VISIT), shards)
                ends = np.cumsum(of)
                # ranges of the block whose dealt rows are few enough to hold
                cuts = np.unique(np.append(np.searchsorted(ends, np.arange(HELD, ends[-1], HELD), "left") + 1, [0, len(n)]))
                for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                    t, m, o = triple[a:b], n[a:b], of[a:b]
                    k = np.arange(o.sum()) - np.repeat(np.cumsum(o) - o, o)
                    t, m, o = np.repeat(t, o), np.repeat(m, o), np.repeat(o, o)
                    shard = ((mix(t.view(_U)) >> _U(3)) % _U(shards)).astype(np.int64) + k
                    shard %= shards
                    order = np.argsort(shard, kind="stable")
                    shard = shard[order]
                    at = np.flatnonzero(np.append(True, shard[1:] != shard[:-1]))
                    share = m // o + (k < m % o)
                    yield packed({"triple": t[order], "n": share[order]}, {"at": np.append(at, len(shard)), "shard": shard[at].astype(np.int32), "first": t[order][at]})

    return blocks.select("triple", "n").mapInArrow(run, "shard int, first long, triple binary, n binary")


def fit(texts: DataFrame, v: Vocabulary, rounds: int = ROUNDS, held: int = HELD, shard_visits: int = SHARD) -> Model:
    """Train on all texts (doc_id, text): shards train alike and their mean goes on, in rounds.

    The visits of a triple are spread over the shards, of which there are as many as the visits ask for; a task reads a
    shard as a stream in a fixed order and holds about `held` visits of it. The model's attribute trained says how many
    tokens each round saw.
    """
    model = Model(v)
    if not v.total:
        return model
    spark = texts.sparkSession
    shared = spark.sparkContext.broadcast(v)
    counted = stage(pack_triples(texts, v), "triples")
    shards = max(1, -(-int(counted.agg(F.sum("visits")).first()[0] or 0) // shard_visits))
    dealt = deal(counted, shards)
    sample = stage(dealt.repartition(shards, "shard").sortWithinPartitions("shard", F.xxhash64("first", F.lit(3)), "first"), "shards")
    edges = np.linspace(0, len(model.flat), PIECES + 1).astype(int)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(shard, triples, weights) of some visits of a shard; the triples of one shard lie side by side."""
        of, kept, size = None, [], 0

        def made() -> tuple[int, np.ndarray, np.ndarray]:
            triple, weight = np.concatenate([x for x, _ in kept]), np.concatenate([w for _, w in kept])
            # one order, however the triples were cut to blocks
            order = np.argsort(triple, kind="stable")
            return of, triple[order], weight[order]

        for batch in batches:
            for row in range(batch.num_rows):
                s = batch.column("shard")[row].as_py()
                triple, n = (unpacked(batch.column(c).slice(row, 1)) for c in ("triple", "n"))
                if kept and (s != of or size >= held):
                    yield made()
                    kept, size = [], 0
                times = -(-n // VISIT)
                kept.append((np.repeat(triple, times), np.repeat(n / times, times)))
                of, size = s, size + int(times.sum())
        if kept:
            yield made()

    def trainer(turn: int, now):
        def out(m: Model, n: float) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(np.arange(PIECES), pa.int32()), pa.array([round(n)] * PIECES, pa.int64()), pa.array([m.flat[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)], pa.binary())],
                ["piece", "n", "weights"],
            )

        def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            of, n, k = None, 0.0, shared.value.size
            for s, triple, weight in pieces(batches):
                if s != of:
                    if n:
                        yield out(m, n)
                    m, of, n = Model(shared.value), s, 0.0
                    m.set(now.value)
                    rng, squares = np.random.default_rng(100 * turn + s), m.fresh_squares()
                m.train(triple % k, triple // k % k, triple // (k * k), weight, shared.value.prior, RATE / (1 + turn), rng, squares)
                n += weight.sum()
            if n:
                yield out(m, n)

        return train

    def mean(group: pa.Table) -> pa.Table:
        n = group.column("n").to_numpy().astype(float)
        w = np.stack([np.frombuffer(x, np.float32) for x in group.column("weights").to_pylist()])
        return pa.Table.from_arrays([pa.array([group.column("piece")[0].as_py()], pa.int32()), pa.array([int(n.sum())], pa.int64()), pa.array([((n / n.sum()) @ w).astype(np.float32).tobytes()], pa.binary())], ["piece", "n", "weights"])

    for turn in range(rounds):
        now = spark.sparkContext.broadcast(model.flat)
        rows = sample.mapInArrow(trainer(turn, now), "piece int, n long, weights binary").groupBy("piece").applyInArrow(mean, "piece int, n long, weights binary").collect()
        if rows:
            model.trained = rows[0]["n"]
            model.set(np.concatenate([np.frombuffer(r["weights"], np.float32) for r in sorted(rows, key=lambda r: r["piece"])]))
    return model


_CACHE: dict = {}


def score(docs: DataFrame, counts: DataFrame, v: Vocabulary, model: Model) -> DataFrame:
    """docs (doc_id, text, held_out) with n_tokens, n_known, train_tokens, base_score and score.

    Frequent words are scored in the map step; each other word goes once per text to the counts, with its number there,
    and comes back as a sum. Only words outside the FREQUENT most frequent meet that join, so no key of it is hot.
    """
    shared = docs.sparkSession.sparkContext.broadcast((v, model.flat))
    kind = dict(docs.dtypes)["doc_id"]
    names = ["key", "doc_id", "held_out", "n_tokens", "n_known", "base", "model", "word", "times"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voc, flat = shared.value
        if _CACHE.get("of") is not flat:
            m = Model(voc)
            m.set(flat)
            _CACHE.update(of=flat, tables=(*m.tables(), voc.rest_logs()))
        a1, a2, z, rest = _CACHE["tables"]
        key = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in text_slices(batch):
                words, row, tail = tokens(part)
                n = part.num_rows
                ids, c, known = voc.look_up(words, tail)
                fresh = np.searchsorted(row, np.arange(n))
                one, two = contexts(ids, voc.end, fresh)
                logs = (a1[one, ids].astype(np.float64) + a2[two, ids] - z[one, two]) / np.log(10) - rest[ids]
                plus = np.where(known, np.log10(c + 1.0), 0.0)
                keys = key + np.arange(n)
                key += n
                sums = [np.bincount(row, weights=x, minlength=n) for x in (known & (c > 0), plus, logs + np.where(ids >= voc.own, plus, 0.0))]
                size = np.bincount(row, minlength=n)
                none = pa.nulls(n, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys), part.column("doc_id"), part.column("held_out"), pa.array(size, pa.int64()), pa.array(sums[0].astype(np.int64)), *map(pa.array, sums[1:]),
                     pa.array(mix(keys.astype(_U)).view(np.int64)), none],
                    names,
                )
                rare = ~known
                if rare.any():
                    order = np.lexsort((words[rare], row[rare]))
                    w, r = words[rare][order], row[rare][order]
                    at = np.flatnonzero(np.append(True, (w[1:] != w[:-1]) | (r[1:] != r[:-1])))
                    m = len(at)
                    for a in range(0, m, 1 << 16):
                        i = at[a : a + (1 << 16)]
                        k = len(i)
                        times = np.diff(np.append(at, len(w)))[a : a + (1 << 16)]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(keys[r[i]]), pa.nulls(k, part.column("doc_id").type), pa.nulls(k, pa.bool_()), *(pa.nulls(k, pa.int64()) for _ in range(2)), *(pa.nulls(k, pa.float64()) for _ in range(2)),
                             pa.array(w[i].view(np.int64)), pa.array(times, pa.int64())],
                            names,
                        )

    schema = f"key long, doc_id {kind}, held_out boolean, n_tokens long, n_known long, base double, model double, word long, times long"
    marks = docs.select("doc_id", "text", "held_out").mapInArrow(run, schema)
    joined = marks.join(counts.select("word", "n"), "word", "left")
    plus = F.coalesce(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + F.lit(1.0)), F.lit(0.0))
    total: dict[str, Column] = {
        "doc_id": F.max("doc_id"), "held_out": F.max("held_out"), "n_tokens": F.max("n_tokens"),
        "n_known": F.max("n_known") + F.coalesce(F.sum(F.when(F.col("n") > 0, F.col("times"))), F.lit(0)),
        "base": F.max("base"), "model": F.max("model"), "plus": F.sum(plus),
    }
    per_text = joined.groupBy("key").agg(*(c.alias(k) for k, c in total.items()))
    return per_text.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(v.total).cast("long").alias("train_tokens"),
        (F.col("base") + F.col("plus") - F.col("n_tokens") * F.lit(float(np.log10(v.total + v.distinct + 1)))).alias("base_score"),
        (F.col("model") + F.col("plus")).alias("score"),
    )


def score_documents(docs: DataFrame, held_out: int = 2, folds: int = 7) -> DataFrame:
    """Learn from the rows of docs (doc_id, text) outside one fold and score every row, one row each.

    Columns doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10). Null text is an empty text: one
    END token. A null doc_id is not learned from and not held out. Without training rows all words are unknown.
    """
    fold = fold_of(F.col("doc_id"), folds)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce(fold == held_out, F.lit(False)).alias("held_out"))
    training = rows.where(F.col("doc_id").isNotNull() & ~F.col("held_out"))
    counts = stage(count_tokens(training), "counts")
    v = vocabulary(counts)
    return score(rows, counts, v, fit(training, v))

"""The operators against brute force on small tables and on edge cases."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import chat, decontam, jaccard, langid, licenses, lm, media, mixing, queries, recompress, warc
from tidemark.llm.common import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOC = "doc_id long, text string, lang string, source string, n_chars long"


def rows(df):
    return [r.asDict() for r in df.collect()]


def docs_of(spark, texts, **more):
    made = [(i, t, more.get("lang"), more.get("source", "s"), len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(made, DOC)


def odd_docs(spark):
    """Nulls in any column, empty and long texts, repeated rows, clashing extra columns."""
    long = " ".join(f"w{i % 977}" for i in range(30_000))
    made = [
        (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \t\n", None, "a", 3), (None, "no id here but words", "en", None, 20),
        (4, long, "en", "b", len(long)), (5, long, "fr", "b", len(long)), (6, "same row", "en", "c", 8), (6, "same row", "en", "c", 8),
        (7, "é" * 50, "fr", "c", 50), (8, "x " * 400, "en", "c", 800), (9, "12345 !!", "en", "c", 8),
    ]
    df = spark.createDataFrame(made, DOC)
    for name in ("n_words", "hits", "marks", "size", "kept", "score", "block", "_id", "key", "n"):
        df = df.withColumn(name, F.lit("clash"))
    return df


# 1 substring dedup


def brute_repeats(docs, window=13):
    least = {}
    split = [(d["doc_id"], WORD.findall(d["text"] or "")) for d in docs]
    order = lambda i: (i is None, i or 0)
    for i, words in split:
        for k in range(len(words) - window + 1):
            w = tuple(words[k : k + window])
            least[w] = min(least.get(w, (True, math.inf)), order(i))
    out = []
    for i, words in split:
        gone = set()
        for k in range(len(words) - window + 1):
            if least[tuple(words[k : k + window])] < order(i):
                gone.update(range(k, k + window))
        kept = [w for k, w in enumerate(words) if k not in gone]
        out.append((i, len(words), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(out, key=lambda x: (order(x[0]), x[1:]))


def found_repeats(df, **how):
    got = [(r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in recompress.remove_repeats(df, **how).collect()]
    return sorted(got, key=lambda x: ((x[0] is None, x[0] or 0), x[1:]))


def test_repeats_match_brute_force(spark, sf_dir):
    df = table(spark, sf_dir, "documents")
    want = brute_repeats(rows(df.select("doc_id", "text")))
    assert sum(x[2] for x in want) > 100
    assert found_repeats(df) == want


@pytest.mark.parametrize("seed", range(4))
def test_repeats_in_runs_and_small_alphabets(spark, seed):
    rng = np.random.default_rng(seed)
    made = []
    for _ in range(60):
        parts = []
        for _ in range(rng.integers(1, 6)):
            kind = rng.integers(0, 3)
            parts += ["a"] * int(rng.integers(1, 40)) if kind == 0 else list(rng.choice(list("abc"), int(rng.integers(1, 30)))) if kind == 1 else ["x", "y"] * int(rng.integers(1, 20))
        made.append(" ".join(parts))
    df = docs_of(spark, made)
    assert found_repeats(df) == brute_repeats(rows(df.select("doc_id", "text")))


def test_equal_windows_have_equal_keys():
    rng = np.random.default_rng(3)
    core = rng.integers(1, 4, 13).astype(np.uint64)
    seen = set()
    for _ in range(200):
        left, right = rng.integers(1, 4, int(rng.integers(0, 20))).astype(np.uint64), rng.integers(1, 4, int(rng.integers(0, 20))).astype(np.uint64)
        words = np.concatenate([left, core, right])
        start, key = recompress.window_keys(words, np.zeros(len(words), np.int64))
        seen.add(int(key[list(start).index(len(left))]))
    assert len(seen) == 1


def test_marks_of_a_frequent_passage_are_combined_before_the_shuffle():
    low, ids = np.repeat(np.array([5 << 50, 9 << 50], np.uint64), (1000, 1)), np.append(np.arange(1000), 3)
    packets = [b.to_pylist()[0] for b in recompress._gathered(iter([(low, np.zeros(0, np.uint32), ids)]), 4, False)]
    assert sum(p["n"] for p in packets if p["to"] < 0) == 3 and sum(p["n"] for p in packets if p["to"] >= 0) == 1000
    packets = [b.to_pylist()[0] for b in recompress._gathered(iter([(low, np.zeros(0, np.uint32), ids)]), 4, True)]
    assert sum(p["n"] for p in packets if p["to"] < 0) == 2 and sum(p["n"] for p in packets if p["to"] >= 0) == 999


def test_repeats_of_odd_rows(spark):
    df = odd_docs(spark)
    assert found_repeats(df) == brute_repeats(rows(df.select("doc_id", "text")))
    assert recompress.remove_repeats(df.where("false")).count() == 0
    kept = {r["doc_id"]: r["kept_text"] for r in recompress.remove_repeats(df).collect()}
    assert kept[1] is None and kept[3] == " \t\n" and kept[5] == ""


# 2 chat formatting


def brute_chat(turns):
    said = defaultdict(list)
    for t in turns:
        said[t["conv_id"]].append(t)
    out = {}
    for conv, ts in said.items():
        ts.sort(key=lambda t: t["turn"])
        whole = "".join(f"{t['role'] or ''}\n{t['text'] or ''}\n" for t in ts)
        loss = "".join(t["text"] or "" for t in ts if t["role"] == "assistant")
        out[conv] = (len(ts), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_chat_round_trip(spark, sf_dir):
    got = {r["conv_id"]: tuple(r)[1:5] for r in queries.op2_chat_formatting(spark, sf_dir).collect()}
    said = "</s>[INST] ok [/INST]"
    turns = rows(table(spark, sf_dir, "conversations")) + [{"conv_id": -7, "turn": i, "role": r, "text": said} for i, r in enumerate(("user", "assistant"))]
    assert got == brute_chat(turns)


def test_chat_odd_turns(spark):
    made = [
        (1, 0, None, None), (1, 1, "assistant", None), (1, 2, "assistant", "a\\b</s>\\[INST]"), (1, 3, "tool[/ROLE]", "[ROLE]x[/ROLE]"), (2, 0, "assistant", "é‍👩" * 3000),
        (None, 0, "user", "x"), (3, 0, "user", ""), (3, 1, "assistant", "[ASST][/TURN]<s>"), (4, 0, "assistant", "a" * 50_000),
    ]
    df = spark.createDataFrame(made, "conv_id long, turn long, role string, text string").withColumn("input_ids", F.lit("clash"))
    formatted = chat.format_turns(df)
    got = {r["conv_id"]: tuple(r)[1:5] for r in chat.read_back(formatted).collect()}
    assert got == brute_chat([dict(zip(("conv_id", "turn", "role", "text"), m, strict=True)) for m in made])
    assert chat.read_back(chat.format_turns(df.where("false"))).count() == 0
    vocabulary = chat.read_vocabulary(spark)
    c = chat.codec(vocabulary)
    whole = {r["conv_id"]: r for r in chat.conversations(formatted).collect()}
    ids = np.array(whole[3]["input_ids"])
    assert c.render(ids) == "<s>[INST][/INST][ASST][\\ASST][\\/TURN]<\\s></s>"
    assert len(whole[3]["loss_mask"]) == len(ids)
    assert c.decode(ids[np.frombuffer(whole[3]["loss_mask"], np.uint8).astype(bool)].tolist()) == "[\\ASST][\\/TURN]<\\s>"
    # the rendered string, tokenized again with control strings as reserved tokens, has the template's own and no others
    import tiktoken

    special = tiktoken.Encoding("special", pat_str=chat.PATTERN, mergeable_ranks=c.plain._mergeable_ranks, special_tokens=c.ids)
    for row in whole.values():
        ids = np.array(row["input_ids"])
        assert [t for t in special.encode(c.render(ids), allowed_special="all") if t >= c.first] == [t for t in ids if t >= c.first]
    # formatted_chars is the length of what the template makes of the turns
    sizes = {r["conv_id"]: r["formatted_chars"] for r in chat.read_back(formatted).collect()}
    assert sizes == {k: len(c.render(np.array(r["input_ids"]))) for k, r in whole.items()}
    control = sum(len(x) for x in ("<s>", "[INST]", "[/INST]", "[ASST]", "</s>"))
    assert sizes[3] == control + len("[ASST][/TURN]<s>") + 3


def test_chat_ids_do_not_depend_on_length(spark):
    c = chat.codec(chat.read_vocabulary(spark))
    for text in ("see " + "ab" * 1500 + " end", "x" * 2001, " " * 5000 + "y"):
        assert c.encode(text) == c.plain.encode_ordinary(text)

# 3 LM scoring


def brute_base(docs):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    split = [(d["doc_id"], [*WORD.findall((d["text"] or "").translate(lower)), None]) for d in docs]
    fold = lambda i: None if i is None else zlib.crc32(str(i).encode()) % 7
    counts = Counter(t for i, ts in split if fold(i) not in (2, None) for t in ts)
    n, v = sum(counts.values()), len(counts)
    return [(i, fold(i) == 2, len(ts), sum(t in counts for t in ts), n, sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in ts)) for i, ts in split]


def test_lm_base_and_gain(spark):
    df = table(spark, "/root/testdata/sf0.01", "documents")
    got = {r["doc_id"]: r for r in lm.score_documents(df).collect()}
    want = brute_base(rows(df.select("doc_id", "text")))
    assert len(got) == len(want)
    for i, held, n, known, total, base in want:
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held, n, known, total)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9, abs_tol=1e-6)
    held = [r for r in got.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held) * 0.99


def test_lm_is_normalised():
    tail_n, tail_words = np.zeros((2, lm.TAILS), np.int64)
    tail_n[:3], tail_words[:3] = [4, 7, 2], [1, 3, 1]
    v = lm.Vocabulary(np.array([3, 9, int(lm.END)], np.uint64), np.array([1, 2, 0], np.int32), np.array([5, 2, 4]), tail_n, tail_words)
    m = lm.Model(v)
    a1, a2, z = m.tables()
    p = np.exp(a1[:, None, :] + a2[None, :, :] - z[:, :, None])
    assert np.allclose(p.sum(axis=2), 1, atol=1e-4)
    assert (v.total, v.distinct, v.own, v.size) == (13, 5, 3, 3 + lm.TAILS)
    assert v.rest_n[1] == v.rest_n.sum() == 2 and v.rest_words[1] == v.rest_words.sum() == 2 and v.end == 1


class FixedNoise:
    """A generator that leaves visits in their order and draws the same noise at each step, which it counts."""

    def __init__(self, noise):
        self.noise, self.steps = noise, 0

    def permutation(self, n):
        return np.arange(n)

    def random(self, n):
        self.steps += 1
        return self.noise[:n]


def lm_of(own, size):
    tail_n = np.zeros(lm.TAILS, np.int64)
    tail_n[:own] = np.arange(2, own + 2)
    v = lm.Vocabulary(np.arange(1, own + 1).astype(np.uint64), np.arange(own).astype(np.int32), tail_n[:own], tail_n, (tail_n > 0).astype(np.int64), own)
    rng = np.random.default_rng(8)
    m = lm.Model(v)
    m.set(m.flat + rng.normal(0, 0.3, len(m.flat)).astype(np.float32))
    return m, v, (*rng.integers(0, own, (3, size)), rng.integers(1, 17, size).astype(float)), FixedNoise(rng.random(lm.NOISE))


def test_lm_step_matches_brute_force():
    m, v, (ids, one, two, weight), draws = lm_of(6, 400)
    r, q, c1, c2, b = (x.astype(float) for x in m.parts)
    log_kq = np.log(lm.NOISE_PER_TOKEN * v.prior)
    noise = np.searchsorted(np.cumsum(v.prior), draws.noise)
    g = [np.zeros_like(x) for x in (r, q, c1, c2, b)]
    for w, w1, w2, n in zip(ids, one, two, weight, strict=True):
        h = r[w1] @ c1 + r[w2] @ c2
        shares = [(w, n / (1 + math.exp(h @ q[w] + b[w] - log_kq[w])))]
        shares += [(x, -n * lm.NOISE_PER_TOKEN / lm.NOISE / (1 + math.exp(log_kq[x] - h @ q[x] - b[x]))) for x in noise]
        dh = sum(s * q[x] for x, s in shares)
        for x, s in shares:
            g[1][x] += s * h
            g[4][x] += s
        g[0][w1] += c1 @ dh
        g[0][w2] += c2 @ dh
        g[2] += np.outer(r[w1], dh)
        g[3] += np.outer(r[w2], dh)
    m.train(ids, one, two, weight, v.prior, 0.1, draws, m.fresh_squares())
    assert draws.steps == 1
    for part, old, x, scale in zip(m.parts, (r, q, c1, c2, b), g, (1, 1, 0.1, 0.1, 0.3), strict=True):
        x = x / math.sqrt(weight.sum())
        assert np.allclose(part, old + 0.1 * scale * x / np.sqrt(0.01 + x * x), atol=2e-4)


def test_lm_visits_of_one_context_share_their_noise():
    m, v, (ids, one, two, weight), draws = lm_of(4, 4096)
    m.train(ids, one, two, weight, v.prior, 0.1, draws, m.fresh_squares())
    # 16 contexts, each with a group that may be short
    assert draws.steps <= -(-(4096 // 2 + 16) // lm.BATCH)
    order, begin, length = lm.groups(two * v.size + one, np.random.default_rng(1))
    assert np.array_equal(np.sort(order), np.arange(4096)) and np.array_equal(begin, np.cumsum(length) - length) and length.sum() == 4096
    assert all(len({(one[x], two[x]) for x in order[a : a + n]}) == 1 for a, n in zip(begin, length, strict=True))


def test_lm_odd_rows(spark):
    df = odd_docs(spark)
    got = lm.score_documents(df).collect()
    want = brute_base(rows(df.select("doc_id", "text")))
    key = lambda x: (x[0] is None, x[0] or 0, x[2])
    for r, w in zip(sorted((tuple(r) for r in got), key=key), sorted(want, key=key), strict=True):
        assert r[:5] == w[:5] and math.isclose(r[5], w[5], rel_tol=1e-9, abs_tol=1e-6) and math.isfinite(r[6])
    assert lm.score_documents(df.where("false")).count() == 0


def test_lm_trains_on_all_texts_at_any_size(spark):
    rng = np.random.default_rng(3)
    df = docs_of(spark, [" ".join(f"w{x}" for x in rng.integers(0, 40, 30)) for _ in range(200)])
    counts = lm.count_tokens(df)
    v, large = lm.vocabulary(counts), lm.vocabulary(counts)
    large.total = 10**9  # as if of a large corpus
    whole = lm.fit(df, large)
    assert np.array_equal(lm.fit(df, v).flat, whole.flat)
    assert whole.trained == v.total == lm.fit(df, large, rounds=1, held=100).trained == lm.fit(df, v, rounds=1, shard_visits=100).trained


def classes_of(text, v):
    """(word hash, class) of each token, the class of a word without its own by its last three bytes."""
    place = {int(w): int(c) for w, c in zip(v.words, v.place, strict=True) if c < v.own}
    words = lm.tokens(pa.RecordBatch.from_arrays([pa.array([text or ""])], ["text"]))[0]
    plain = [w.translate({k: k + 32 for k in range(65, 91)}).encode() for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    tails = [int(lm.mix(np.array([int.from_bytes(w[:-4:-1].ljust(3, b"\0"), "big")], np.uint64))[0]) % lm.TAILS for w in plain] + [0]
    return [(int(w), place.get(int(w), v.own + t)) for w, t in zip(words, tails, strict=True)]


def brute_triples(docs, v):
    seen = Counter()
    for d in docs:
        ids = [c for _, c in classes_of(d["text"], v)]
        for two, one, here in zip([v.end, v.end, *ids], [v.end, *ids], ids, strict=False):
            seen[(two * v.size + one) * v.size + here] += 1
    return seen


def test_lm_triples_and_scores_match_brute_force(spark, sf_dir):
    df = table(spark, sf_dir, "documents")
    counts = lm.count_tokens(df)
    v = lm.vocabulary(counts, own=200)
    assert {r["triple"]: r["n"] for r in lm.count_triples(df, v).collect()} == brute_triples(rows(df), v)
    model = lm.fit(df, v, rounds=1)
    got = {r["doc_id"]: r["score"] for r in lm.score(df.select("doc_id", "text", F.lit(False).alias("held_out")), counts, v, model).collect()}
    r, q, c1, c2, b = (x.astype(float) for x in model.parts)
    n_of = {x["word"] % (1 << 64): x["n"] for x in counts.collect()}
    own = {w: c for d in rows(df) for w, c in classes_of(d["text"], v)}
    assert len(own) == len(n_of) and v.size == 200 + lm.TAILS
    sizes, distinct = Counter(), Counter()
    for w, c in own.items():
        sizes[c] += n_of[w]
        distinct[c] += 1
    for d in rows(df)[:40]:
        want, history = 0.0, [v.end, v.end]
        for w, here in classes_of(d["text"], v):
            logits = (r[history[-1]] @ c1 + r[history[-2]] @ c2) @ q.T + b
            want += (logits[here] - np.log(np.exp(logits - logits.max()).sum()) - logits.max()) / np.log(10)
            if here >= v.own:
                want += math.log10((n_of.get(w, 0) + 1) / (sizes[here] + distinct[here] + 1))
            history.append(here)
        assert math.isclose(got[d["doc_id"]], want, rel_tol=1e-3)


# 4 n-gram Jaccard join


def brute_classes(docs, threshold=0.8, size=5):
    sets = []
    for d in docs:
        w = WORD.findall(d["text"] or "")
        sets.append({tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    n = len(sets)
    links, root = [0] * n, list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    where = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            where[x].append(i)
    seen = Counter()
    for ids in where.values():
        for a in range(len(ids)):
            for b in range(a):
                seen[ids[b], ids[a]] += 1
    for (a, b), m in seen.items():
        if m >= threshold * (len(sets[a]) + len(sets[b]) - m):
            links[a] += 1
            links[b] += 1
            root[find(a)] = find(b)
    least = {}
    order = lambda i: (i is None, i or 0)
    for i, d in enumerate(docs):
        r = find(i)
        least[r] = min(least.get(r, (True, math.inf)), order(d["doc_id"]))
    name = lambda k: None if k[0] else k[1]
    return sorted(((d["doc_id"], name(least[find(i)]), links[i]) for i, d in enumerate(docs)), key=str)


def test_jaccard_matches_brute_force(spark):
    df = table(spark, "/root/testdata/sf0.01", "documents")
    want = brute_classes(rows(df.select("doc_id", "text")))
    assert any(x[2] for x in want)
    assert sorted((tuple(r) for r in jaccard.classes(df).collect()), key=str) == want


def test_jaccard_large_group_in_small_blocks(spark):
    rng = np.random.default_rng(1)
    base = [f"w{i}" for i in range(120)]
    made = []
    for _ in range(70):
        w = list(base)
        for _ in range(int(rng.integers(0, 3))):
            w[int(rng.integers(0, 120))] = f"z{rng.integers(0, 9)}"
        made.append(" ".join(w))
    made += ["short text", "short text", "", None, "one two three four five six"]
    df = docs_of(spark, made)
    assert sorted((tuple(r) for r in jaccard.classes(df, block=8).collect()), key=str) == brute_classes(rows(df.select("doc_id", "text")))


def test_jaccard_block_pairs_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    placed = [(n, int(rng.integers(0, 300))) for n in range(500)]
    nodes = [(n, int(rng.zipf(1.6)) % 40) for n, _ in placed for _ in range(3)]
    want, block_of = set(), dict(placed)
    for node in {x for _, x in nodes}:
        mine = sorted(block_of[n] for n, x in nodes if x == node)
        want |= {(a, b) for k, a in enumerate(mine) for b in mine[k + 1 :]}
    got = [tuple(r) for r in jaccard._block_pairs(spark.createDataFrame(nodes, "num long, node long"), spark.createDataFrame(placed, "num long, block long")).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_jaccard_hot_node_pairs_without_a_large_row(spark):
    n = 6000
    nodes = spark.range(n).select(F.col("id").alias("num"), F.lit(7).cast("long").alias("node"))
    pairs = jaccard._block_pairs(nodes, nodes.select("num", F.col("num").alias("block")))
    assert tuple(pairs.agg(F.count("*"), F.sum(F.col("j") - F.col("i"))).first()) == (n * (n - 1) // 2, sum(d * (n - d) for d in range(1, n)))


def test_jaccard_odd_rows(spark):
    df = odd_docs(spark)
    assert sorted((tuple(r) for r in jaccard.classes(df).collect()), key=str) == brute_classes(rows(df.select("doc_id", "text")))
    assert jaccard.classes(df.where("false")).count() == 0
    assert jaccard.least_depth() == 5 and jaccard.least_depth(1, 6, 0.5, 0.999) == 1


def test_jaccard_links_at_the_threshold_are_found(spark):
    """Pairs planted at similarities from 0.8 on: the recall is that of the target and the prefixes shorten until then."""
    rng = np.random.default_rng(7)
    made = []
    for i in range(400):
        n = int(rng.integers(60, 200))
        w = [f"p{i}w{k}" for k in range(n)]
        x = list(w)
        for _ in range(int(rng.integers(1, max(2, n // 45)))):
            x[int(rng.integers(0, n))] = "changed"
        made += [" ".join(w), " ".join(x)]
    df = docs_of(spark, made)
    want = brute_classes(rows(df.select("doc_id", "text")))
    linked = {x[0] for x in want if x[2]}
    levels = []
    got = [tuple(r) for r in jaccard.classes(df, levels=levels).collect()]
    assert len(linked) > 300 and len(linked & {x[0] for x in got if x[2]}) >= 0.99 * len(linked)
    assert levels[0][0] == jaccard.DEPTH and all(a[0] == b[0] + 1 for a, b in zip(levels, levels[1:], strict=False))
    assert levels[-1][1] >= jaccard.RECALL or levels[-1][0] == jaccard.least_depth()


def test_jaccard_chain_is_compared_along_its_length(spark):
    """Each text of a chain is similar to its neighbours alone: one class, and links of a few."""
    words = [f"c{k}" for k in range(900)]
    made = [" ".join(words[i * 8 : i * 8 + 120]) for i in range(95)]
    df = docs_of(spark, made)
    got = sorted((tuple(r) for r in jaccard.classes(df, block=4).collect()), key=str)
    assert got == brute_classes(rows(df.select("doc_id", "text"))) and {x[1] for x in got} == {0}


def test_sorted_tries_know_the_longest_shared_prefix(spark):
    rng = np.random.default_rng(2)
    signs = [rng.integers(0, 2, jaccard.TREES * jaccard.DEPTH).astype(">u2").tobytes() for _ in range(60)]
    sets = spark.createDataFrame(list(enumerate(signs)), "num long, signs binary").repartition(1)
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    got = {(r["num"], r["tree"]): r["deep"] for r in jaccard.sorted_matches(sets, 3).collect()}
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    width = jaccard.DEPTH * jaccard.WIDTH
    for t in range(jaccard.TREES):
        mine = [s[t * width : (t + 1) * width] for s in signs]
        for i, a in enumerate(mine):
            deep = max(next((k for k in range(jaccard.DEPTH) if a[2 * k : 2 * k + 2] != b[2 * k : 2 * k + 2]), jaccard.DEPTH) for j, b in enumerate(mine) if j != i)
            edge = (t, a, i) in (min((0, b, j) for j, b in enumerate(mine)), max((jaccard.TREES - 1, b, j) for j, b in enumerate(mine)))
            assert edge or got.get((i, t), 0) == (deep if deep >= 3 else 0)


# 5 decontamination


def brute_hits(docs, bench, size=10):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    split = lambda t: word.findall((t or "").translate(lower))
    wins = defaultdict(set)
    for b in bench:
        w = split(b["text"])
        for i in range(max(1, len(w) - size + 1)) if w and b["item_id"] is not None else ():
            wins[tuple(w[i : i + size])].add(b["item_id"])
    lengths = sorted({len(w) for w in wins})
    out = []
    for d in docs:
        w, hit, items = split(d["text"]), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if found := wins.get(tuple(w[i : i + n])):
                    hit.update(range(i, i + n))
                    items |= found
        out.append((d["doc_id"], len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def test_decontamination_matches_brute_force(spark, sf_dir):
    got = sorted((tuple(r) for r in queries.op5_decontamination(spark, sf_dir).collect()), key=str)
    want = brute_hits(rows(table(spark, sf_dir, "documents")), rows(table(spark, sf_dir, "benchmark")))
    assert got == want and any(x[5] for x in want)


def test_decontamination_in_blocks_and_odd_rows(spark):
    bench = spark.createDataFrame([(1, "Alpha beta gamma"), (2, "W1, w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 w12"), (3, None), (None, "x"), (4, "!!"), (10, "same row"), (11, "x x")], "item_id long, text string")
    df = odd_docs(spark).unionByName(docs_of(spark, ["ALPHA-beta, gamma w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11"]), allowMissingColumns=True)
    want = brute_hits(rows(df), rows(bench))
    assert sorted((tuple(r) for r in decontam.contamination(df, bench).collect()), key=str) == want
    blocks = decontam.scan(df.select("doc_id", "text"), bench, block_windows=1)
    whole = decontam.scan(df.select("doc_id", "text"), bench)
    assert sorted(map(str, blocks.collect())) == sorted(map(str, whole.collect()))
    assert not any(r[5] for r in decontam.contamination(df, bench.where("false")).collect())
    spans = decontam.with_spans(whole.where("doc_id = 0")).collect()[0]
    assert [spans["text"][s["start"] : s["end"]] for s in spans["spans"]] == ["ALPHA-beta, gamma w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11"]


# 6 language ID


def test_language_of_held_out_documents(spark):
    df = table(spark, "/root/testdata/sf0.01", "documents")
    got = {r["doc_id"]: r for r in queries.op6_language_id(spark, "/root/testdata/sf0.01").collect()}
    right = total = 0
    for d in rows(df):
        r = got[d["doc_id"]]
        assert r["held_out"] == (zlib.crc32(str(d["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1
        if r["held_out"] and d["lang"]:
            total += 1
            right += r["lang_pred"] == d["lang"]
    assert right / total > 0.95


def test_language_odd_rows(spark):
    df = odd_docs(spark)
    got = langid.identify(df).collect()
    assert len(got) == df.count()
    assert {r["lang_pred"] for r in got if r["doc_id"] in (1, 2, 3, 9)} == {"und"}
    assert langid.identify(df.where("false")).count() == 0
    none = langid.identify(df.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r["lang_pred"] for r in none} == {"und"}


def test_rare_language_is_learned_from_a_bounded_sample(spark):
    made = [(i, f"the house number {i} stands in the street", "en", "s", 0) for i in range(4000)]
    made += [(10_000 + i, f"zxq vwk jjy qqx {i} kvz", "xx", "s", 0) for i in range(12)]
    langs, matrix = langid.fit(spark.createDataFrame(made, DOC), fit_rows=40)
    assert langs == ["en", "xx"] and (matrix.max(axis=0) > matrix.min(axis=0)).all()
    asked = docs_of(spark, ["zxq vwk kvz", "the street"])
    assert [r["lang_pred"] for r in langid.predict(asked, langs, matrix).orderBy("doc_id").collect()] == ["xx", "en"]


# 7 licenses


def brute_licenses(docs, templates):
    split = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    out = set()
    for d in docs:
        w = split(d["text"])
        h = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
        for name, body in templates.items():
            b = split(body)
            t = {tuple(b[i : i + 5]) for i in range(len(b) - 4)}
            m = len(t)
            if len(t & set(h)) < 0.8 * m:
                continue
            for s in range(max(1, len(h) - m + 1)):
                if len(t & set(h[s : s + m])) >= 0.8 * m:
                    out.add((d["doc_id"], name))
                    break
    return out


def test_licenses_match_brute_force(spark):
    df = table(spark, "/root/testdata/sf0.01", "documents")
    got = {(r["doc_id"], r["license"]) for r in queries.op7_license_scans(spark, "/root/testdata/sf0.01").collect()}
    want = brute_licenses(rows(df.select("doc_id", "text")), licenses.known_templates())
    assert want and got == want


def test_licenses_inside_long_texts_with_changes(spark):
    rng = np.random.default_rng(2)
    filler = lambda n: " ".join(f"f{rng.integers(0, 999)}" for _ in range(n))
    made, want = [], set()
    known = licenses.known_templates()
    for i, name in enumerate(sorted(known)):
        body = known[name].split()
        for at in range(30, len(body) - 30, 60):
            body[at] = "changed"
        made.append(f"{filler(int(rng.integers(0, 300)))} {' '.join(body).upper()}\n{filler(int(rng.integers(0, 300)))}")
        want.add((i, name))
    df = docs_of(spark, made)
    got = {(r["doc_id"], r["license"]) for r in licenses.scan(df).collect()}
    assert want <= got and got == brute_licenses(rows(df), known)
    table = spark.createDataFrame(list(known.items()), "license string, body string")
    assert {(r["doc_id"], r["license"]) for r in licenses.scan(df, table).collect()} == got
    odd = odd_docs(spark)
    assert licenses.scan(odd).count() == 0 and licenses.scan(odd.where("false")).count() == 0 and licenses.scan(odd, {}).count() == 0


# 8 media columns


def brute_media(docs):
    out = []
    for d in docs:
        data = (d["text"] or "").encode()
        padded = data + bytes(-len(data) % 64 if data else 64)
        out.append((d["doc_id"], len(data), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-64:])))
    return sorted(out, key=str)


def test_media_round_trip(spark, sf_dir):
    got = queries.op8_media_columns(spark, sf_dir).collect()
    assert sorted((tuple(r)[:5] for r in got), key=str) == brute_media(rows(table(spark, sf_dir, "documents")))
    stored = {}
    for d in rows(table(spark, sf_dir, "documents")):
        data = (d["text"] or "").encode()
        payload = data + bytes(-len(data) % 64 if data else 64)
        stored[d["doc_id"]] = media.encode(payload), media.declared_type(payload)
    for r in got:
        blob, declared = stored[r["doc_id"]]
        kind = {b"RI": "audio/wav", b".s": "audio/basic", b"BM": "image/bmp", b"\x89P": "image/png"}[blob[:2]]
        assert (r["media_bytes"], r["media_sha256"], r["kind"], r["mislabelled"], r["n_embedded"]) == (len(blob), hashlib.sha256(blob).hexdigest(), kind, kind != declared, 0)
        assert r["feature"].startswith(kind)
    assert {r["mislabelled"] for r in got} == {True, False}
    odd = odd_docs(spark)
    assert sorted((tuple(r)[:5] for r in media.media_digests(odd).collect()), key=str) == brute_media(rows(odd))
    assert media.media_digests(odd.where("false")).count() == 0


def test_sniffing_carves_and_rejects():
    kinds = {}
    for i in range(40):
        blob = media.encode(bytes([i]) * 64)
        found = media.sniff(blob)
        assert len(found) == 1 and (found[0].start, found[0].size) == (0, len(blob))
        assert media.decode_samples(blob, found[0]) == bytes([i]) * 64
        kinds[found[0].kind] = blob
    assert len(kinds) == 4
    joined = b"junk BM GIF89a RIFF" + b"".join(kinds.values()) + b"PK\x03\x04 tail %PDF-"
    assert sorted(f.kind for f in media.sniff(joined)) == sorted(kinds)
    png = kinds["image/png"]
    assert media.sniff(png[:40] + b"?" + png[41:]) == [] and media.sniff(png[:-1]) == []
    gif = b"GIF89a\x01\x00\x01\x00\x80\x00\x00\x00\x00\x00\xff\xff\xff,\x00\x00\x00\x00\x01\x00\x01\x00\x00\x02\x02D\x01\x00;"
    assert [f.kind for f in media.sniff(b"x" + gif)] == ["image/gif"]
    import io
    import zipfile

    z = io.BytesIO()
    with zipfile.ZipFile(z, "w") as f:
        f.writestr("a", "b")
    assert [(f.kind, f.start) for f in media.sniff(b"__" + z.getvalue())] == [("application/zip", 2)]
    with zipfile.ZipFile(z, "w") as f:
        for i, (kind, blob) in enumerate(sorted(kinds.items())):
            f.writestr(f"{i}.wrong", blob)
    found = media.sniff(z.getvalue())
    assert [f.kind for f in found] == ["application/zip", *sorted(kinds)]
    assert all(z.getvalue()[f.start : f.start + f.size] == kinds[f.kind] for f in found[1:])


# 9 mixing


def brute_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, open_, out = 1.5 * sum(sizes.values()), set(order), {}
    while open_:
        level = left / sum(w[s] for s in open_)
        full = [s for s in open_ if w[s] * level > 2 * sizes[s]]
        if not full:
            return out | {s: w[s] * level for s in open_}
        for s in full:
            out[s] = 2 * sizes[s]
            left -= out[s]
            open_.remove(s)
    return out


@pytest.mark.parametrize(("where", "blocks", "parts"), [("sf", 256, 256), ("sf", 2, 3), ("sf", 1, 1), ("odd", 256, 256)])
def test_mix_meets_its_targets(spark, sf_dir, where, blocks, parts):
    df = table(spark, sf_dir, "documents") if where == "sf" else odd_docs(spark)
    mixed = mixing.mix(df, blocks, parts).withColumn("taken", mixing.taken_words())
    got = rows(mixed.select("doc_id", "size", "source_size", "target", "taken"))
    docs = rows(df.select("doc_id", "text", "source"))
    sizes = Counter()
    for d in docs:
        sizes[d["source"]] += len(WORD.findall(d["text"] or ""))
    want = brute_targets(sizes)
    assert len(got) == len(docs)
    by = defaultdict(lambda: [0, 0])
    for r in got:
        assert 0 <= r["taken"] <= 2 * r["size"]
        by[round(r["target"], 6), r["source_size"]][0] += r["taken"]
    for (target, size), (taken, _) in by.items():
        same = [s for s in want if sizes[s] == size and math.isclose(want[s], target, abs_tol=1e-4)]
        assert same and abs(taken - len(same) * target) <= len(same)
    assert sorted(map(str, got)) == sorted(map(str, rows(mixing.mix(df, blocks, parts).withColumn("taken", mixing.taken_words()).select("doc_id", "size", "source_size", "target", "taken"))))
    assert mixing.mix(df.where("false")).count() == 0


def brute_tree(quotas, levels):
    """The left node's tickets are the smaller half by hash, level by level; shard -> source -> draws."""
    digest = lambda *x: int(hashlib.md5(":".join("" if p is None else str(p) for p in x).encode()).hexdigest()[:8], 16)
    nodes = {1: dict(quotas)}
    for _ in range(levels):
        below = defaultdict(Counter)
        for node, of in nodes.items():
            tickets = sorted((digest(node, s, i), s is None, s or "", i) for s, q in of.items() for i in range(1, q + 1))
            for k, (_, none, s, _) in enumerate(tickets):
                below[node * 2 + (k >= (len(tickets) + node % 2) // 2)][None if none else s] += 1
        nodes = below
    return {node - (1 << levels): dict(of) for node, of in nodes.items()}


def test_shards_of_the_tree_reach_documents_and_files(spark, sf_dir, tmp_path):
    df = table(spark, sf_dir, "documents")
    mixed = mixing.mix(df, blocks=16, parts=4)
    got = rows(mixed.select("doc_id", "source", "draws", mixing.shard_words().alias("s")))
    for r in got:
        assert r["s"] == ",".join(f"{d['shard']}:{d['words']}" for d in r["draws"])
    mixing.write_mix(mixed, df, f"file://{tmp_path}/mix")
    written = Counter((r["doc_id"], r["shard"], r["words"]) for r in spark.read.parquet(f"file://{tmp_path}/mix").select("doc_id", "shard", "words").collect())
    assert written == Counter((r["doc_id"], d["shard"], d["words"]) for r in got for d in r["draws"])
    assert len({s for _, s, _ in written}) == 8


def test_splitting_tree_is_exact(spark):
    quotas = {"a": 1000, "b": 37, None: 5, "c": 1}
    got = rows(mixing.split_quotas(spark.createDataFrame(list(quotas.items()), "source string, quota long"), 3))
    per_shard = Counter()
    for s, q in quotas.items():
        mine = sorted((r["first"], r["last"]) for r in got if r["source"] == s)
        assert mine[0][0] == 0 and mine[-1][1] == q and all(a[1] == b[0] for a, b in zip(mine, mine[1:], strict=False))
    by_shard = defaultdict(dict)
    for r in got:
        by_shard[r["shard"]][r["source"]] = r["last"] - r["first"]
    assert by_shard == brute_tree(quotas, 3)
    for r in got:
        per_shard[r["shard"]] += r["last"] - r["first"]
    assert max(per_shard.values()) - min(per_shard.values()) <= 3 and len(per_shard) == 8


# 10 WARC


def test_warc_round_trip(spark, sf_dir, tmp_path):
    same = "<p>" + "é" * 600
    extra = [(10_000 + i, f"http://h/{i}", same) for i in range(5)] + [(20_000, None, None), (20_001, "u", ""), (20_002, "http://a b/", "short"), (20_003, "http://x", "short"), (None, "http://n", same)]
    pages = table(spark, sf_dir, "pages").unionByName(spark.createDataFrame(extra, "page_id long, url string, html string")).withColumn("capture", F.lit("clash"))
    got = sorted((tuple(r) for r in warc.warc_roundtrip(pages).collect()), key=str)
    best = {}
    made = [(r["page_id"], (r["html"] or "").encode()) for r in rows(pages)]
    for i, data in made:
        if len(data) >= 1000 and i is not None:
            best[data] = max(best.get(data, -1), i)
    want = []
    for i, data in made:
        back = len(data) >= 1000 and best[data] != i
        want.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if back else "response", best[data] if back else None))
    assert got == sorted(want, key=str)
    warc.write_warc(pages, f"file://{tmp_path}/w")
    captures = warc.resolve_revisits(warc.assemble(warc.read_warc(spark, f"file://{tmp_path}/w")))
    held = {r["page_id"]: bytes(r["payload"]) for r in captures.collect()}
    assert held["10000"] == same.encode() == held["10004"] and held[None] == same.encode()
    import gzip

    first = next(p for p in sorted((tmp_path / "w").iterdir()) if p.name.startswith("part-"))
    assert gzip.decompress(first.read_bytes()).startswith(b"WARC/1.1\r\n")


def test_warc_keeps_every_record_under_an_id(spark):
    record = lambda i, kind, to, page: (i, kind, to, None, "u", None, None, page, b"p" if kind == "response" else None, 1, "d")
    made = [record("<a>", "response", None, None), record("<a>", "response", None, None), record("<m1>", "metadata", "<a>", None), record("<m2>", "metadata", "<a>", "7"), record("<q>", "request", "<z>", None)]
    got = {r["capture_id"]: r for r in warc.assemble(spark.createDataFrame(made, warc.RECORD_SCHEMA)).collect()}
    assert [len(got["<a>"][k]) for k in ("responses", "requests", "metadata")] == [2, 0, 2] and len(got["<z>"]["requests"]) == 1
    flat = warc.resolve_revisits(warc.assemble(spark.createDataFrame(made, warc.RECORD_SCHEMA))).collect()
    assert [(r["capture_id"], r["page_id"]) for r in flat] == [("<a>", "7")] * 2


def test_warc_files_are_bounded_by_bytes(spark, tmp_path):
    rng = np.random.default_rng(0)
    large = ["".join(map(chr, rng.integers(33, 120, 3_000_000))) for _ in range(3)]
    pages = spark.createDataFrame([(i, "u", t) for i, t in enumerate([*large, "small", "x" * 9_000_000])], "page_id long, url string, html string").coalesce(1)
    warc.write_warc(pages, f"file://{tmp_path}/w", units_per_file=8)
    assert len([p for p in (tmp_path / "w").iterdir() if p.name.startswith("part-") and p.stat().st_size > 1000]) >= 3
    got = {r["page_id"]: bytes(r["payload"]).decode() for r in warc.resolve_revisits(warc.assemble(warc.read_warc(spark, f"file://{tmp_path}/w"))).collect()}
    assert got == {str(i): t for i, t in enumerate([*large, "small", "x" * 9_000_000])}


def test_warc_repeated_rows_and_none(spark):
    twice = spark.createDataFrame([(1, "u", "x" * 2000)] * 2 + [(0, "u", "x" * 2000)], "page_id long, url string, html string")
    got = sorted((r["page_id"], r["record_type"], r["refers_to"]) for r in warc.warc_roundtrip(twice).collect())
    assert [g[:2] for g in got] == [(0, "revisit"), (1, "response"), (1, "response")] and got[0][2] == 1
    assert warc.warc_roundtrip(twice.where("false")).count() == 0

"""Filter audit, line dedup and source divergence against brute force on small and odd tables."""

import hashlib
import itertools
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import divergence, filters, linededup, oracles, queries

DOC = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LINES = ["A line that is long enough to count.", "\t a LINE that is long enough to count. ", "short", "", "ÄÖÜ repeated over and over again", "äöü repeated over and over again", "x" * 19, "y" * 20, "é" * 20]


def odd(spark):
    """Nulls in any column, empty and long texts, repeated rows and ids, ties, and extra columns with names used inside."""
    long = " ".join(f"w{i % 977} Zed" for i in range(20_000)) + "\n" + LINES[0]
    rng = np.random.default_rng(3)
    made = [
        (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \t\n\r\n", None, "a", 3), (None, "no id here\n" + LINES[0], "en", None, 20), (None, None, None, None, None),
        (None, "no id here\n" + LINES[0], "fr", "a", 20), (4, long, "en", "b", len(long)), (5, long, "fr", "b", len(long)), (6, "Same row\n" * 3 + LINES[1], "en", "c", 8), (6, "Same row\n" * 3 + LINES[1], "en", "c", 8),
        (6, LINES[4], "en", "c", 8), (7, "é" * 50 + " ßß", "fr", "c", 50), (8, "x " * 400, "en", "c", 800), (9, "12345 !!", "xx", "lone", 8), (10, "$ tie tie", "yy", "p", 8), (11, "tie", "yy", "q", 8), (-4, long, "yy", None, 9),
    ]
    for i in range(60):
        text = "\n".join(LINES[k] for k in rng.integers(0, len(LINES), rng.integers(0, 7)))
        made.append((100 + i, text + " ".join("abcdefg"[k] * (k + 1) for k in rng.integers(0, 7, 12)), ["en", "fr", None, ""][i % 4], ["a", "b", "c", None, ""][i % 5], 1))
    df = spark.createDataFrame(made, DOC)
    for name in ("part", "mask", "digest", "row", "key", "places", "n_lines", "kept_text", "term", "n", "rank", "value", "_of", "c0"):
        df = df.withColumn(name, F.lit("clash"))
    return df


def labels_of(spark):
    made = [(6, 1, 0), (6, 0, 1), (4, 1, None), (5, None, 1), (None, 1, 1), (8, 1, 1), (8, 1, 1), (777, 1, 1), *[(100 + i, i % 2, i % 3) for i in range(60)]]
    return spark.createDataFrame(made, "doc_id long, quality int, toxic int").withColumn("good", F.lit("clash"))


def of(df):
    return [r.asDict() for r in df.collect()]


def brute_audit(docs, labels):
    good = {x["doc_id"] for x in labels if x["quality"] == 1 and x["doc_id"] is not None}
    toxic = {x["doc_id"] for x in labels if x["toxic"] == 1 and x["doc_id"] is not None}
    order = lambda i: (i is None, i or 0)
    least = {}
    for d in docs:
        t = d["text"] or ""
        least[t] = min(least.get(t, order(d["doc_id"])), order(d["doc_id"]))
    parts = defaultdict(list)
    for d in docs:
        t = d["text"] or ""
        w = WORD.findall(t)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t), "D": any(c in "#$%&*|" for c in t), "E": order(d["doc_id"]) > least[t]}
        parts[d["lang"] or ""].append((d["doc_id"], {k for k, v in fails.items() if v}))
    out = []
    for part, held in parts.items():
        shapley, rows = Counter(), []
        for names in itertools.permutations("ABCDE"):
            alive = list(held)
            for step, f in enumerate(names):
                lost = [i for i, fails in alive if f in fails]
                alive = [x for x in alive if f not in x[1]]
                shapley[f] += len(lost)
                failing = [fails for _, fails in held if f in fails]
                rows.append((part, "".join(names), step + 1, f, len(alive), len(lost), len(failing) - len(lost), sum(x == {f} for x in failing), sum(i in good for i in lost), sum(i in toxic for i in lost)))
        out += [(*r, shapley[r[3]]) for r in rows]
    return out


def test_filter_audit(spark):
    docs, labels = odd(spark), labels_of(spark)
    got = [tuple(r) for r in filters.interaction_audit(docs, labels).collect()]
    assert sorted(got) == sorted(brute_audit(of(docs), of(labels)))
    assert filters.interaction_audit(docs.limit(0), labels.limit(0)).count() == 0


def test_every_order_is_one_swap_from_the_last():
    for k in range(6):
        order, seen = list(range(k)), {tuple(range(k))}
        for i in filters.neighbour_swaps(k):
            order[i], order[i + 1] = order[i + 1], order[i]
            assert tuple(order) not in seen
            seen.add(tuple(order))
        assert len(seen) == len(set(itertools.permutations(range(k))))


def test_walk_of_three_filters_counts_each_order():
    cells = np.random.default_rng(1).integers(0, 50, (8, 3))
    found = filters.walk(cells, "XYZ")
    assert len(found) == 18
    for r in found.itertuples():
        at = {c: 1 << "XYZ".index(c) for c in "XYZ"}
        before = sum(at[c] for c in r.filter_order[: r.step - 1])
        removed = sum(int(cells[m, 0]) for m in range(8) if m & at[r.filter] and not m & before)
        assert (r.removed, r.kept) == (removed, sum(int(cells[m, 0]) for m in range(8) if not m & (before | at[r.filter])))
        assert r.shapley == found[(found["filter"] == r.filter)]["removed"].sum()


def brute_lines(docs, chars=20, least=3):
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\v\f\r"))
    order = lambda i: (i is not None, i or 0)
    held = defaultdict(set)
    for d in docs:
        for line in (d["text"] or "").split("\n"):
            if len(key(line)) >= chars:
                held[key(line)].add(d["doc_id"])
    out = []
    for d in docs:
        lines = (d["text"] or "").split("\n")
        kept = [x for x in lines if not (len(held[key(x)]) >= least and d["doc_id"] != max(held[key(x)], key=order))]
        out.append((d["doc_id"], len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest(), "\n".join(kept) if d["text"] is not None else None))
    return out


def test_line_dedup(spark):
    docs = odd(spark)
    found = linededup.dedup_lines(docs)
    got = [(r["doc_id"], r["n_lines"], r["n_dropped"], r["kept_sha256"], r["kept_text"]) for r in found.collect()]
    assert Counter(got) == Counter(brute_lines(of(docs)))
    assert sum(x[2] for x in got) > 50
    assert {r["part"] for r in found.select("part").distinct().collect()} == {"clash"}  # other columns pass through
    assert linededup.dedup_lines(docs.limit(0)).count() == 0
    two = linededup.dedup_lines(docs.select("doc_id", "text"), min_chars=5, min_docs=2)
    assert Counter((r["doc_id"], r["n_dropped"]) for r in two.collect()) == Counter((x[0], x[2]) for x in brute_lines(of(docs), 5, 2))


def test_line_dedup_takes_ids_of_text_and_int(spark):
    rows = [("b", LINES[0]), ("a", LINES[1] + "\nown"), ("c", LINES[0])]
    for kind, ids in (("string", "bac"), ("int", (2, 1, 3))):
        df = spark.createDataFrame([(i, t) for i, (_, t) in zip(ids, rows, strict=True)], f"doc_id {kind}, text string")
        assert {r["doc_id"]: r["kept_text"] for r in linededup.dedup_lines(df).collect()} == {ids[0]: "", ids[1]: "own", ids[2]: LINES[0]}


def brute_divergence(docs, ranks=200):
    term = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    held, count = defaultdict(Counter), defaultdict(Counter)
    for d in docs:
        lang, source = d["lang"] or "", d["source"] or ""
        words = Counter(w.translate(fold) for w in term.findall(d["text"] or ""))
        held[lang].update(words.keys())
        count[lang, source].update(words)
    out = []
    for lang in {x for x, _ in count}:
        vocabulary = [t for t, n in held[lang].items() if n >= 3]
        sources = [s for x, s in count if x == lang]
        whole = Counter()
        for s in sources:
            whole.update(count[lang, s])

        def price(c, vocabulary=vocabulary):
            size = sum(c[t] for t in vocabulary) + len(vocabulary)
            return {t: 1 + 1_000_000_000 * (c[t] + 1) // size for t in vocabulary}

        p, q = {s: price(count[lang, s]) for s in sources}, price(whole)
        cost = lambda x, y: (x - y) ** 2 // y
        for s in sources:
            pairs = [(-sum(cost(p[s][t], p[o][t]) for t in vocabulary), o) for o in sources if o != s]
            terms = [(-cost(p[s][t], q[t]), t) for t in vocabulary if count[lang, s][t] and p[s][t] > q[t]]
            for part, rows in (("pair", pairs), ("term", terms)):
                best = sorted(rows, key=lambda r: (r[0], r[1].encode()))
                out += [(lang, s, part, item, -v, i + 1) for i, (v, item) in enumerate(best) if part == "pair" or i < ranks]
    return out


@pytest.mark.parametrize("piece", [8 << 20, 64])
def test_divergence(spark, monkeypatch, piece):
    monkeypatch.setattr(divergence, "COUNT_BYTES", piece)
    docs = odd(spark)
    got = [tuple(r) for r in divergence.divergence_audit(docs, ranks=5).collect()]
    assert sorted(got) == sorted(brute_divergence(of(docs), 5))
    assert divergence.divergence_audit(docs.limit(0)).count() == 0


def test_long_texts_are_counted_in_pieces_between_terms(spark, monkeypatch):
    monkeypatch.setattr(divergence, "COUNT_BYTES", 100)
    raw = ("alpha beta " * 200 + "z" * 500 + " é").encode()
    pieces = list(divergence._pieces(np.frombuffer(raw, np.uint8), 100))
    assert b"".join(x.tobytes() for x in pieces) == raw
    words = Counter(w for x in pieces for w in re.findall(rb"[A-Za-z\x80-\xff]+", x.tobytes()))
    assert words == {b"alpha": 200, b"beta": 200, b"z" * 500: 1, "é".encode(): 1}
    df = spark.createDataFrame([(raw.decode(), "en", "a")], "text string, lang string, source string")
    assert {r["term"]: (r["n"], r["docs"]) for r in divergence.count_terms(df).collect()} == {"alpha": (200, 1), "beta": (200, 1), "z" * 500: (1, 1), "é": (1, 1)}


def test_probability_is_exact_where_a_product_would_overflow(spark):
    for n, size in ((0, 1), (10**14, 10**15 + 7), (5 * 10**15, 9 * 10**15), (0, 9 * 10**15), (41, 43)):
        got = spark.range(1).select(divergence.probability(F.lit(n).cast("long"), F.lit(size).cast("long")).alias("p")).head()["p"]
        assert got == 1 + 1_000_000_000 * (n + 1) // size


@pytest.mark.parametrize("name", ["op11_filter_audit", "op12_line_dedup", "op13_source_divergence"])
def test_query_equals_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    df = getattr(queries, name)(spark, sf_dir)
    found = con.execute(oracles.SQL[name])
    at = [c[0] for c in found.description]
    assert Counter(tuple(r) for r in df.select(*at).collect()) == Counter(found.fetchall())

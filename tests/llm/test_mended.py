"""Inputs that once ended a whole job: long blanks, ids of other types, archives of other writers; and language ID by brute force."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import chat, decontam, langid, warc
from tidemark.llm.common import table


@pytest.mark.parametrize("text", [" " * 1_000_000, "a" + " \n" * 600_000 + "b", "　" * 1_200_000, " " * 700_000 + "x"])
def test_long_white_space_is_formatted_and_read_back(spark, text):
    turns = spark.createDataFrame([(1, 0, "user", text), (1, 1, "assistant", "ok" + text)], "conv_id long, turn long, role string, text string")
    found = chat.read_back(chat.format_turns(turns)).head()
    assert found["turns_sha256"] == hashlib.sha256(f"user\n{text}\nassistant\nok{text}\n".encode()).hexdigest()
    assert (found["n_turns"], found["loss_chars"]) == (2, len(text) + 2)


@pytest.mark.parametrize("n", [100_000, 300_000])
def test_cut_white_space_has_the_ids_of_the_whole_text(n):
    c = chat.codec(chat.read_vocabulary(None, chat.VOCABULARY))
    for text in (" " * n, "ab" + " " * n + "c", " " * n + "\n x" + "\t" * n, "ab" + "\n" * n + "1"):
        assert c.encode(text) == c.plain.encode_ordinary(text)


def test_formatted_chars_are_those_of_the_whole_conversation(spark):
    said = "</s>[INST] ok [/INST]"
    turns = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said), (1, 0, "user", ""), (2, 0, "tool", "é")], "conv_id long, turn long, role string, text string")
    formatted = chat.format_turns(turns)
    c = chat.codec(chat.read_vocabulary(spark, chat.VOCABULARY))
    want = {r["conv_id"]: len(c.render(np.array(r["input_ids"]))) for r in chat.conversations(formatted).collect()}
    assert {r["conv_id"]: r["formatted_chars"] for r in chat.read_back(formatted).collect()} == want


@pytest.mark.parametrize("kind", ["int", "smallint", "string", "date", "decimal(9,2)"])
def test_benchmark_ids_of_any_type(spark, kind):
    docs = spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven"), (2, None)], "doc_id int, text string")
    one = F.lit("2024-01-01").cast("date") if kind == "date" else F.lit("7").cast(kind)
    items = spark.createDataFrame([("two three four five six seven eight nine ten eleven",), ("absent words",)], "text string").withColumn("item_id", one)
    found = {r["doc_id"]: r for r in decontam.contamination(docs, items).collect()}
    assert (found[1]["n_hit"], found[1]["n_items"], found[2]["contaminated"]) == (10, 1, False)
    assert decontam.contamination(docs, items.limit(0)).where("contaminated").count() == 0


def _raw(head, block):
    return ("WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()) + f"Content-Length: {len(block)}\r\n\r\n").encode() + block + b"\r\n\r\n"


def test_archives_of_other_writers_are_read(spark, tmp_path):
    http = b"HTTP/1.1 200 OK\r\n\r\nbody"
    plain = (
        _raw({"WARC-Type": "warcinfo", "WARC-Record-ID": "<i>"}, b"software: x\r\n")
        + _raw({"WARC-Type": "response", "WARC-Record-ID": "<dns>", "Content-Type": "text/dns"}, b"20240101\r\nexample. 60 IN A 1.2.3.4\r\n")
        + _raw({"WARC-Type": "response", "Content-Type": "application/http"}, http)
        + _raw({"WARC-Type": "response", "WARC-Record-ID": "<ok>", "Content-Type": "application/http; msgtype=response"}, http)
        + _raw({"WARC-Type": "response", "WARC-Record-ID": "<headless>", "Content-Type": "application/http"}, b"HTTP/1.1 200 OK")
        + b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <short>\r\nContent-Length: 500\r\n\r\nfew"
    )
    (tmp_path / "a.warc").write_bytes(plain)
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    whole = z.compress(_raw({"WARC-Type": "response", "WARC-Record-ID": "<z>"}, http)) + z.flush()
    (tmp_path / "b.warc.gz").write_bytes(whole + whole[:-12])
    (tmp_path / "c.warc.gz").write_bytes(whole + b"\x1f\x8bnonsense")
    (tmp_path / "d.warc").write_bytes(b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <none>\r\n\r\nno length")
    (tmp_path / "e.warc").write_bytes(b"")
    records = warc.read_warc(spark, f"file://{tmp_path}").collect()
    by = defaultdict(list)
    for r in records:
        by[r["record_id"]].append(r)
    assert (by["<dns>"][0]["payload"], by["<dns>"][0]["error"]) == (b"20240101\r\nexample. 60 IN A 1.2.3.4\r\n", None)
    assert (by["<ok>"][0]["payload"], by["<ok>"][0]["error"]) == (b"body", None)
    assert {r["error"] for r in by[None]} >= {"no WARC-Record-ID"}
    assert by["<headless>"][0]["error"] == "no end of the HTTP head" and by["<short>"][0]["error"].startswith("the record is shorter")
    assert by["<none>"][0]["error"] == "no Content-Length"
    assert [r["payload"] for r in by["<z>"] if r["error"] is None][:2] == [b"body"] * 2
    assert any(r["error"] and "gzip" in r["error"] for r in records)
    captures = warc.resolve_revisits(warc.assemble(warc.read_warc(spark, f"file://{tmp_path}"))).select("capture_id").distinct().collect()
    assert {r[0] for r in captures} >= {"<dns>", "<ok>", "<z>"} and None not in {r[0] for r in captures}


def test_many_short_pages_do_not_meet_in_one_key(spark):
    pages = spark.range(500).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.when(F.col("id") % 2 == 0, "short").otherwise(F.repeat(F.lit("l"), 1000)).alias("html"))
    got = {r["page_id"]: r["refers_to"] for r in warc.with_revisits(pages).collect()}
    assert sum(v is not None for v in got.values()) == 249 and got["499"] is None and all(got[str(i)] is None for i in range(0, 500, 2))


def _bucket(gram, buckets):
    """The hash of one n-gram in 32-bit arithmetic, by plain integers."""
    m = (1 << 32) - 1
    points = [ord(c) for c in gram]
    h = points[0] * 0x9E3779B1 & m
    for x in points[1:]:
        h = ((h ^ h >> 15) * 0x85EBCA77 + x * 0xC2B2AE3D) & m
    return (((h ^ h >> 13) * 0x27D4EB2F & m) >> 8) % buckets


def test_language_id_is_the_naive_bayes_of_its_counts(spark, sf_dir):
    """Every prediction against a model of dictionaries, from the same rows."""
    odd = spark.createDataFrame([(10_001, None, "en"), (10_002, "", "en"), (10_003, "12 !", "de"), (None, "the end of the text", None), (10_004, "é", "fr"), (10_004, "é", "fr")], "doc_id long, text string, lang string")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").unionByName(odd).withColumn("score", F.lit("clash"))
    known: dict[str, int] = {}

    def grams(text):
        padded, out = f" {text.lower()} ", Counter()
        for g in (padded[i : i + n] for n in langid.ORDERS for i in range(len(padded) - n + 1)):
            if g not in known:
                known[g] = _bucket(g, langid.BUCKETS)
            out[known[g]] += 1
        return out

    rows = docs.select("doc_id", "text", "lang").collect()
    counts = defaultdict(Counter)
    for r in rows:
        if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 and r["lang"] is not None and r["text"] is not None:
            counts[r["lang"]].update(grams(r["text"]))
    langs = sorted(counts)
    total = {x: sum(counts[x].values()) + langid.SMOOTHING * langid.BUCKETS for x in langs}
    want = Counter()
    for r in rows:
        if not any(map(str.isalpha, r["text"] or "")):
            want[r["doc_id"], langid.UNKNOWN, 0.0] += 1
            continue
        score = {x: sum(n * math.log((counts[x][g] + langid.SMOOTHING) / total[x]) for g, n in grams(r["text"]).items()) for x in langs}
        best = max(langs, key=score.get)
        want[r["doc_id"], best, round(1 / sum(math.exp(v - score[best]) for v in score.values()), 3)] += 1
    got = Counter((r["doc_id"], r["lang_pred"], round(r["score"], 3)) for r in langid.identify(docs).collect())
    assert got == want
    assert langid.identify(docs.limit(0)).count() == 0

"""Artifacts: names, writing, digests of changed files only, the digest tree, diagnosis, and all kinds of issues."""

import hashlib
import json
import random
from datetime import date, datetime
from pathlib import Path

from tidemark.sources import artifacts

FILINGS = "symbol string, period_end date, statement_scope string, url string, content string, source_reference string"


def test_written_once_and_named_by_content(spark, tmp_path):
    root = f"file://{tmp_path}"
    rows = [("a&b", date(2024, 3, 31), "consolidated", "https://x.y/d/f 1.xml?q=2", "<a/>", "r1"), ("T", date(2024, 6, 30), None, None, None, "r2")]
    made = artifacts.artifacts(spark.createDataFrame(rows, FILINGS))
    first = {r["raw_relative_path"]: r["already"] for r in artifacts.write_artifacts(made, root).collect()}
    sha = hashlib.sha256(b"<a/>").hexdigest()
    empty = hashlib.sha256(b"").hexdigest()
    assert first == {f"A_B/2024-03-31/Consolidated/f_1__{sha[:16]}.xml": False, f"T/2024-06-30/Unknown/financial_filing__{empty[:16]}.xml": False}
    assert all(r["already"] for r in artifacts.write_artifacts(made, root).collect())
    side = json.loads((tmp_path / f"A_B/2024-03-31/Consolidated/f_1__{sha[:16]}.json").read_text())
    assert side["sha256"] == sha and side["file_size"] == 4 and side["raw_xml_path"] in first and "content" not in side
    assert not list(tmp_path.rglob("*.part"))


def test_only_changed_files_are_read_again(spark, tmp_path):
    root = f"file://{tmp_path}"
    for n in range(6):
        (tmp_path / f"d{n % 2}").mkdir(exist_ok=True)
        (tmp_path / f"d{n % 2}" / f"{n}.xml").write_text(f"<x><Cash{n}/></x>")
    table = artifacts.inspected_files(artifacts.listing(spark, root), root)
    table.write.parquet(f"file://{tmp_path}-known")
    known = spark.read.parquet(f"file://{tmp_path}-known")
    # a known digest that is wrong shows which files were not opened
    doctored = known.selectExpr("path", "modified", "length", "'kept' AS sha256", "names", "xml_status", "error")
    (tmp_path / "d0" / "0.xml").write_text("<x><other/></x><")
    (tmp_path / "d1" / "1.xml").unlink()
    (tmp_path / "d1" / "7.xml").write_bytes(b"<y/>" * 1)
    got = {r["path"]: (r["sha256"], r["xml_status"]) for r in artifacts.refreshed(doctored, artifacts.listing(spark, root), root).collect()}
    sha = lambda p: hashlib.sha256((tmp_path / p).read_bytes()).hexdigest()
    assert got == {"d0/0.xml": (sha("d0/0.xml"), "INVALID_XML"), "d1/7.xml": (sha("d1/7.xml"), "OK"), **{p: ("kept", "OK") for p in ("d0/2.xml", "d0/4.xml", "d1/3.xml", "d1/5.xml")}}
    gone = spark.createDataFrame([("no.xml", datetime(2024, 1, 1))], "path string, modified timestamp")
    assert artifacts.inspected_files(gone, root).first()["xml_status"] == "READ_ERROR"


def test_a_large_document_is_read_in_pieces(tmp_path):
    import resource
    import subprocess
    import sys

    big = tmp_path / "big.xml"
    with big.open("wb") as out:
        out.write(b"<x>")
        for _ in range(100):
            out.write(b"<CashRow>1</CashRow>" * 50_000)
        out.write(b"</x>")
    code = f"import resource; from tidemark.sources import artifacts as a; before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss; r = a.inspect(a.pieces({str(big)!r})); print(r['xml_status'], r['length'], r['names'], resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before)"
    said = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, timeout=120).stdout.rsplit(" ", 1)
    assert said[0] == f"OK {big.stat().st_size} ['cashrow', 'x']" and int(said[1]) < 60_000 and resource


def test_tree_and_changes_equal_brute_force(spark):
    rng = random.Random(3)
    paths = ["/".join(rng.choice("abc") for _ in range(rng.randint(0, 3))) + ("/" if rng.random() < 2 else "") + f"{n}.xml" for n in range(120)]
    paths = [p.lstrip("/") for p in paths]
    old = {p: str(rng.random()) for p in paths[:100]}
    new = {p: (old.get(p) if rng.random() < 0.9 else "x") or "new" for p in paths if rng.random() < 0.9}
    new.update({p: None for p in paths[:2]})
    schema = "path string, sha256 string"
    left, right = (spark.createDataFrame(list(t.items()), schema) for t in (old, new))
    want = {(p, "removed") for p in old.keys() - new} | {(p, "added") for p in new.keys() - old} | {(p, "changed") for p in old.keys() & new if old[p] != new[p]}
    assert {tuple(r) for r in artifacts.changed_files(left, right).collect()} == want
    assert artifacts.changed_files(left, left).count() == 0 and artifacts.changed_files(left.where("false"), left).count() == 100
    folders = {r["folder"]: r["files"] for r in artifacts.digest_tree(left).collect()}
    assert folders[""] == 100
    assert folders == {f: sum(p.startswith(f"{f}/") if f else True for p in old) for f in {"", *(str(q) for p in old for q in Path(p).parents if str(q) != ".")}}


def test_diagnosis_and_integrity(spark):
    docs = {
        "both": b"<x xmlns:i='u'><i:CashFlowsFromUsedInOperations/><PurchaseOfPropertyPlantAndEquipmentClassifiedAsInvestingActivities/></x>",
        "ocf": b"<x><CashFlowsFromUsedInOperatingActivities/></x>", "capex": b"<x><PurchaseOfPropertyPlantAndEquipmentClassifiedAsInvestingActivities/></x>",
        "cash": b"<x><CashOnHand/></x>", "none": b"<x/>", "broken": b"<x><CashFlowsFromUsedInOperations/>", "empty": None,
    }
    seen = artifacts.inspected_documents(spark.createDataFrame(list(docs.items()), "path string, content binary"))
    got = {r["path"]: (r["classification"], r["cash_concepts"]) for r in artifacts.diagnosis(seen).collect()}
    assert got == {"both": ("BOTH_FOUND", 1), "ocf": ("OCF_ONLY", 1), "capex": ("CAPEX_ONLY", 0), "cash": ("OTHER_CASH_CONCEPTS", 1), "none": ("NO_CASH_CONCEPTS", 0), "broken": ("INVALID_XML", 0), "empty": ("INVALID_XML", 0)}
    sha = hashlib.sha256(b"<x/>").hexdigest()
    rows = [(1, "none", 4, sha.upper()), (2, "none", 5, None), (3, "gone", 4, sha), (4, None, None, None)]
    checked = artifacts.integrity(spark.createDataFrame(rows, "id long, raw_relative_path string, file_size long, sha256 string"), seen)
    assert {r["id"]: (r["file_exists"], r["size_matches"], r["sha256_matches"]) for r in checked.collect()} == {1: (True, True, True), 2: (True, False, False), 3: (False, False, False), 4: (False, False, False)}


def expected(row, files, sides):
    """The issues of one catalogue row, by plain Python."""
    path = row["raw_relative_path"]
    if path not in files:
        return ["missing_xml"]
    if path not in sides:
        return ["missing_json"]
    try:
        data = json.loads(sides[path] or "")
        assert isinstance(data, dict)
    except (ValueError, AssertionError):
        return ["invalid_json"]
    text = lambda v: str(v or "").strip()
    out = set()
    if text(data.get("symbol")).upper() != row["symbol"].upper():
        out.add("symbol_mismatch")
    try:
        if date.fromisoformat(data["period_end"]) != row["period_end"]:
            out.add("period_mismatch")
    except Exception:
        out.add("invalid_period")
    if text(data.get("statement_scope")).lower() != text(row["statement_scope"]).lower():
        out.add("scope_mismatch")
    if text(data.get("source_reference")) != text(row["source_reference"]):
        out.add("reference_mismatch")
    if text(data.get("sha256")).lower() != text(row["sha256"]).lower():
        out.add("sha256_mismatch")
    try:
        if int(data["file_size"]) != row["file_size"]:
            out.add("file_size_mismatch")
    except Exception:
        out.add("invalid_file_size")
    if not data.get("raw_xml_path"):
        out.add("missing_json_xml_path")
    elif data["raw_xml_path"].removeprefix("/data/raw/") != path:
        out.add("xml_path_mismatch")
    for name in ("broadcast_datetime", "revised_datetime"):
        if v := data.get(name):
            try:
                datetime.strptime(v.strip(), "%d-%b-%Y %H:%M:%S")
            except ValueError:
                try:
                    datetime.fromisoformat(v.strip())
                except ValueError:
                    out.add(f"invalid_{name}")
    return [k for k in artifacts.ISSUES if k in out]


def test_all_issue_kinds_equal_brute_force(spark):
    rng = random.Random(11)
    faults = {
        "symbol": ["OTHER", None, " abc "], "period_end": ["2024-06-30", "soon", None, "20240331", 5, "2024-02-31"], "statement_scope": ["Standalone", None, "CONSOLIDATED "], "source_reference": ["zz", None, " r "],
        "sha256": ["00", None, "AB12"], "file_size": [11, "10", None, "ten", 10**30], "raw_xml_path": [None, "", "/data/raw/p{n}.xml", "/else/p{n}.xml"],
        "broadcast_datetime": ["01-jan-2024 10:00:00", "1-Feb-2024 1:02:03", "2024-01-01T10:00:00", "2024-01-01", "gestern", "31-Feb-2024 10:00:00", None], "revised_datetime": ["x", "", "05-MAR-2024 23:59:59"],
    }
    rows, files, sides = [], set(), {}
    for n in range(400):
        path = f"p{n}.xml"
        rows.append({"id": n, "symbol": "ABC", "period_end": date(2024, 3, 31), "statement_scope": None if n % 17 == 0 else "Consolidated", "source_reference": "r", "sha256": "ab12", "file_size": 10, "raw_relative_path": path})
        good = {"symbol": "abc", "period_end": "2024-03-31", "statement_scope": "consolidated", "source_reference": "r", "sha256": "ab12", "file_size": 10, "raw_xml_path": path}
        for name in rng.sample(sorted(faults), rng.choice([0, 1, 1, 2, 4])):
            value = rng.choice(faults[name])
            good[name] = value.replace("{n}", str(n)) if isinstance(value, str) else value
            if rng.random() < 0.1:
                good.pop(name)
        if n % 13:
            files.add(path)
        if n % 11:
            sides[path] = json.dumps(good) if n % 9 else rng.choice(["{", "[1]", "", "{'a': 1}", "null", None])
    schema = "id long, symbol string, period_end date, statement_scope string, source_reference string, sha256 string, file_size long, raw_relative_path string"
    catalogue = spark.createDataFrame([tuple(r.values()) for r in rows], schema)
    table = spark.createDataFrame([(p,) for p in files], "path string")
    said = spark.createDataFrame(list(sides.items()), "path string, content string")
    got = {r["id"]: r["issues"] for r in artifacts.sidecar_issues(catalogue, table, said, "/data/raw").collect()}
    want = {r["id"]: x for r in rows if (x := expected(r, files, sides))}
    assert got == want
    assert {k for x in want.values() for k in x} == set(artifacts.ISSUES)
    assert artifacts.sidecar_issues(catalogue.where("false"), table, said).count() == 0

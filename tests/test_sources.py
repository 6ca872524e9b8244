"""Encodings, preview, the run folder and the graph of stages that records take."""

import csv

import pytest
from pyspark.sql import functions as F

from sieveline.operators import report, schema
from sieveline.plans import catalogue, cli
from sieveline.sources import encoding, ingest, sink

SF = "/root/testdata/sf0.001"


def _lines(spark, rows):
    return spark.createDataFrame([(i, bytearray(b) if b is not None else None) for i, b in rows], "input string, raw binary")


@pytest.mark.parametrize(
    "lines,want",
    [
        ([b"plain"], "utf-8-sig"), (["é€😀".encode()], "utf-8-sig"), ([b"ok", b"caf\xe9"], "cp1252"), ([b"\x80 caf\xe9"], "cp1252"), ([b"\x80", b"\x81"], "latin-1"),
        ([b"\xc0\xaf"], "cp1252"), ([b"\xed\xa0\x80"], "cp1252"), ([b"\xe2\x82"], "cp1252"), ([b""], "utf-8-sig"), ([None], "utf-8-sig"), (["﻿C".encode(), None], "utf-8-sig"),
    ],
)
def test_encoding_is_the_first_that_reads_all_lines(spark, lines, want):
    given = _lines(spark, [("x", b) for b in lines])
    assert [r["encoding"] for r in encoding.encodings(given).collect()] == [want]
    whole = b"\n".join(b or b"" for b in lines)
    for codec in encoding.ENCODINGS:  # the same by Python's strict codecs
        try:
            whole.decode(codec)
        except UnicodeDecodeError:
            continue
        assert codec == want
        break
    said = {r["value"] for r in encoding.decode_lines(given).collect()}
    assert said == {b.decode(want).removeprefix("﻿") if b is not None else None for b in lines}


def test_every_byte_is_read_as_python_reads_it(spark):
    for codec in ("cp1252", "latin-1"):
        known = bytes(b for b in range(256) if codec == "latin-1" or bytes([b]).decode(codec, "ignore"))
        got = _lines(spark, [("x", known)]).select(encoding.decoded(F.col("raw"), F.lit(codec)).alias("v")).first()["v"]
        assert got == known.decode(codec)


def test_no_lines_have_no_encoding(spark):
    assert encoding.decode_lines(_lines(spark, [])).count() == 0


def test_files_each_by_its_own_encoding(spark, tmp_path):
    """A letter on the edge of 64 KiB, the mark of byte order, bytes that UTF-8 lacks far behind the start."""
    files = {"a.csv": ("﻿name,smiles\n" + "".join(f"é{i},C{'C' * (i % 4)}\n" for i in range(9000)), "utf-8"), "b.csv": ("id;smiles\n" + "x;CC\n" * 20000 + "“café”;CCO\n", "cp1252"), "c.csv": ("id;smiles\nna\x81ïve;CCN\n", "latin-1")}
    edge = "name,smiles\n" + "é,C\n"
    edge += "x" * (65535 - len(edge.encode())) + "é,CCl\n"
    files["d.csv"] = (edge, "utf-8")
    assert edge.encode()[:65536].decode("utf-8", "ignore") != edge.encode()[:65536].decode("utf-8", "replace")
    for name, (text, codec) in files.items():
        (tmp_path / name).write_bytes(text.encode(codec))
        got = [r["input_id"] for r in ingest.from_path(spark, str(tmp_path / name)).orderBy("seq").collect()]
        assert got == [line.split("," if "," in line else ";")[0] for line in text.removeprefix("﻿").splitlines()[1:]], name


def test_preview_and_invalid_rows(spark):
    rows = ingest.from_text(spark, "id,smiles\na,CCO\nb,C(C\nc,C1CC\nd,\ne,c1ccccc1\nf,C==C\ng,CC")
    seen = ingest.preview(rows, 2).first()
    assert (seen["total"], seen["n_invalid"], [h["input_id"] for h in seen["head"]]) == (7, 4, ["a", "b"])
    assert {(r["input_id"], r["code"]) for r in ingest.invalid(rows).collect()} == {("b", "ERR_SYNTAX"), ("c", "ERR_SYNTAX"), ("d", "ERR_EMPTY"), ("f", "ERR_SYNTAX")}
    none = ingest.preview(ingest.from_text(spark, ""), 2).first()
    assert (none["total"], none["n_invalid"], none["head"]) == (0, 0, [])


def _plain_counts(records):
    rows = records.select("status", "rejection_code").collect()
    codes = {}
    for r in rows:
        if r["status"] == "REJECTED":
            codes[r["rejection_code"]] = codes.get(r["rejection_code"], 0) + 1
    return len(rows), codes


def test_counts_come_from_the_writing_pass(spark, tmp_path):
    r = catalogue.records(spark, SF)
    r = r.unionByName(r.where("seq < 5").withColumn("seq", F.col("seq") + 100_000)).unionByName(r.where("seq = 7").withColumns({"status": F.lit("REJECTED"), "rejection_code": F.lit("ODD"), "identity": F.lit(None).cast("string")}))
    total, codes = _plain_counts(r)
    codes["UNKNOWN"] = codes.pop("ODD")
    out = str(tmp_path / "run")
    first = sink.write_run(r, out, policy="p")
    assert (first["total"], first["rejection_counts"], first["policy_hash"]) == (total, dict(sorted(codes.items())), "p")
    assert first["passed"] + first["rejected"] == total and set(first["seconds"]) == set(first["outputs"])
    kinds = {x["collision_type"]: x["count"] for x in spark.read.parquet(f"{out}/conflicts").groupBy("collision_type").count().collect()}
    assert first["collision_counts"] == dict(sorted(kinds.items())) and kinds
    assert first["unique"] == r.where("identity is not null and status = 'PASSED'").select("identity").distinct().count()
    (tmp_path / "run" / ".staging-dead").mkdir()
    (tmp_path / "run" / ".staging-dead" / "part").write_text("x")
    again = sink.write_run(r.where("status = 'PASSED'"), out)
    assert again["stale_removed"] == 1 and again["rejected"] == 0 and again["rejection_counts"] == {}
    assert spark.read.parquet(f"{out}/audit").count() == again["total"] == first["passed"]
    assert sorted(p.name for p in (tmp_path / "run").iterdir() if p.name.startswith(".stag")) == []


def test_an_error_leaves_the_earlier_run(spark, tmp_path):
    r = catalogue.records(spark, SF)
    out = str(tmp_path / "run")
    m = sink.write_run(r, out)
    with pytest.raises(Exception):
        sink.write_run(r.withColumn("raw_text", F.when(F.col("seq") == 50, F.raise_error(F.lit("lost"))).otherwise(F.col("raw_text"))), out)
    assert sink.read_manifest(spark, out) == m and spark.read.parquet(f"{out}/audit").count() == m["total"]
    assert not [p for p in (tmp_path / "run").iterdir() if p.name.startswith(".stag")]


def test_empty_records_make_a_complete_run(spark, tmp_path):
    m = sink.write_run(catalogue.records(spark, SF).where("false"), str(tmp_path / "run"))
    assert (m["total"], m["passed"], m["unique"], m["collision_counts"]) == (0, 0, 0, {})
    assert spark.read.parquet(str(tmp_path / "run/curated")).count() == 0


def test_csv_outputs_hold_whole_texts(spark, tmp_path):
    docs = spark.createDataFrame([(1, 'says "yes", twice,\nand then on a second line some more', "s", "en"), (2, "short", "s", "en"), (3, None, None, None)], "doc_id long, text string, source string, lang string")
    from sieveline.operators.curate import curate

    m = sink.write_run(curate(docs), str(tmp_path / "run"), fmt="csv")
    rows = [row for p in sorted((tmp_path / "run/audit").glob("*.csv")) for row in csv.DictReader(p.open(newline=""))]
    assert {r["input_id"]: r["raw_text"] for r in rows} == {"1": 'says "yes", twice,\nand then on a second line some more', "2": "short", "3": ""}
    assert (m["format"], m["total"], m["passed"]) == ("csv", 3, 1)


def test_policy_of_the_command_line(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(spark, "stop", lambda: None)
    import hashlib

    (tmp_path / "policy.md").write_text("rules")
    docs = f"{SF}/documents.parquet"
    for name, given, want in (("a", str(tmp_path / "policy.md"), hashlib.sha256(b"rules").hexdigest()), ("b", str(tmp_path / "none.md"), cli.UNVERSIONED)):
        assert cli.run(["--input", docs, "--out-dir", str(tmp_path / name), "--policy", given, "--quiet"]) == 0
        assert sink.read_manifest(spark, str(tmp_path / name))["policy_hash"] == want


def test_downstream_of_any_graph(spark):
    """Branches, a cycle, a chain as long as the stages, two groups; against a walk over the edges."""
    chain = [("g", a, b) for a, b in zip([*schema.STAGES, schema.DEDUP], [*schema.STAGES, schema.DEDUP][1:])]
    edges = chain + [("h", "a", "b"), ("h", "b", "c"), ("h", "c", "a"), ("h", "b", "d"), ("h", "d", "e"), ("h", "a", "e"), ("h", "a", "e")]
    want = {}
    for g, s in {(g, s) for g, s, _ in edges}:
        front, steps = {s}, 0
        while front:
            steps += 1
            front = {b for h, a, b in edges if h == g and a in front and (g, s, b) not in want}
            want |= {(g, s, b): steps for b in front}
    got = report.downstream(spark.createDataFrame(edges, "grp string, source string, target string"), "grp").collect()
    assert len(got) == len(want) and {(r["grp"], r["source"], r["reachable"]): r["steps"] for r in got} == want
    assert report.downstream(spark.createDataFrame([], "source string, target string")).count() == 0


def test_edges_are_those_that_records_took(spark):
    rows = [("REJECTED", "PARSE", 1), ("REJECTED", "ELIGIBILITY", 2), ("PASSED", None, 3)]
    r = spark.createDataFrame([(s, g) for s, g, n in rows for _ in range(n)], "status string, rejection_stage string")
    got = {(e["source"], e["target"]): e["n"] for e in report.flow_edges(r).collect()}
    assert got == {("PARSE", "STANDARDIZE"): 5, ("STANDARDIZE", "GET_PARENT"): 5, ("GET_PARENT", "VALENCE_GATE"): 5, ("VALENCE_GATE", "ELIGIBILITY"): 5, ("ELIGIBILITY", "CANONICALIZE"): 3, ("CANONICALIZE", "DEDUPLICATION"): 3}


def test_invalid_rows_are_told_where_rows_were_dealt(spark):
    """The filter on the code isn't moved to before the rows are dealt: there, one task would parse them all."""
    rows = spark.createDataFrame([(1, "a", "CCO"), (2, "b", "C(C"), (3, "c", None)], "seq long, input_id string, raw_smiles string").repartition(4)
    bad = ingest.invalid(rows)
    assert {(r["seq"], r["code"]) for r in bad.collect()} == {(2, "ERR_SYNTAX"), (3, "ERR_EMPTY")}
    above, _, below = bad._jdf.queryExecution().optimizedPlan().toString().partition("Repartition")
    assert "regexp_extract_all" in above and "regexp_extract_all" not in below


def test_layouts_keep_cells_in_their_lines(spark):
    """No row for each cell, which sorted all words in a task; inputs that repeat have two first lines, of which the greater name counts."""
    lines = spark.createDataFrame([(1, 0, "id,smiles"), (1, 1, "a,CCO"), (2, 0, "id,smiles"), (2, 0, "zz,zz"), (2, 1, "a,CCO"), (3, 0, "C[x]l CCO"), (4, 0, "a  b ")], "input int, at int, value string")
    found = ingest.layouts(lines)
    assert {tuple(r) for r in found.collect()} == {(1, ",", True, 1, 0), (2, ",", True, 0, 1), (3, None, False, 0, 1), (4, None, False, 1, 0)}
    assert "posexplode(" not in found._jdf.queryExecution().optimizedPlan().toString()

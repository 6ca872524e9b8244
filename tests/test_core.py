import duckdb
import pytest

import __spark_entry__ as entry
from sieveline.functions import structure as S
from sieveline.functions import text as T
from sieveline.operators import curate, dedup, gold, report, validate
from sieveline.plans import catalogue, cli
from sieveline.sources import ingest, sink
from sieveline.streaming import dedup_stream
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "labels", "part", "customer", "lineitem", "events", "benchmark")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.execute("set timezone='UTC'")
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def rows(df, cols):
    return sorted(map(str, df[cols].astype(object).where(df[cols].notna(), None).values.tolist()))


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_query_equals_its_sql(spark, duck, name):
    a, b = catalogue.QUERIES[name](spark, SF).toPandas(), duck.execute(catalogue.ORACLE_SQL[name]).df()
    cols = sorted(a.columns)
    assert cols == sorted(b.columns)
    assert rows(a, cols) == rows(b, cols)


def test_entry(spark):
    assert entry.entry(spark).count() == 6


def test_funnel_reconciles(spark):
    r = catalogue.records(spark, SF)
    steps = report.funnel(r).orderBy("ordinal").collect()
    assert all(a["n_output"] == b["n_input"] for a, b in zip(steps, steps[1:], strict=False))
    assert sum(s["n_excluded"] for s in steps) == r.where("status = 'REJECTED'").count()


def test_conflicts_follow_the_order(spark):
    r = spark.createDataFrame([(1, "a", "X-1-N", "X", "p"), (2, "b", "X-1-N", "X", "q"), (3, "c", "X-1-N", "X", None), (4, "d", "X-2-M", "X", "p"), (5, "e", None, None, "p")], "seq long, input_id string, identity string, block1 string, annotation string")
    got = {x["incoming_id"]: (x["collision_type"], x["existing_id"]) for x in dedup.collisions(r).collect()}
    assert got == {"b": (dedup.ANNOTATION, "a"), "c": (dedup.EXACT, "a"), "d": (dedup.BLOCK1, "a")}
    last = {x["incoming_id"]: x["existing_id"] for x in dedup.collisions(r, keep_first=False).collect()}
    assert last == {"b": "a", "c": "b", "d": "c"}


def test_structure_functions(spark):
    one = lambda e: spark.range(1).select(e.alias("x")).first()["x"]
    assert one(S.formula_delta(F.lit("C2H5NaO"), F.lit("C2H6O"))) == "+H1 -Na1"
    assert one(S.removed_fragments(F.lit("Cl.Cl.CCN"), F.lit("Cl.CCN"))) == "Cl"
    assert one(S.net_charge(F.lit("[Cu+2].[O-]"))) == 1
    events = one(F.transform(S.probe_events(F.lit("CC(=O)O[Na]"), F.lit("CC(=O)[O-].[Na+]"), F.lit("STANDARDIZE")), lambda e: e["rule"]))
    assert events == ["alkali_metal_ionized", "fragments_split"]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("name;structure\nwater;O\nbenzene;c1ccccc1", [("water", "O"), ("benzene", "c1ccccc1")]),
        ("CCCl\nC=C\nC#N", [("CMPD_0000001", "CCCl"), ("CMPD_0000002", "C=C"), ("CMPD_0000003", "C#N")]),
        ("mol|grade\nCCBr|high\n|none\nOCCO|low", [("CMPD_0000001", "CCBr"), ("CMPD_0000002", ""), ("CMPD_0000003", "OCCO")]),
        ("#!\n\n  x7\t C(F)F \nx8\tNCC", [("x7", "C(F)F"), ("x8", "NCC")]),
        ("k1 CCS\nk2\nk3 CCP", [("k1", "CCS"), ("k2", ""), ("k3", "CCP")]),
        ("", []),
    ],
)
def test_ingestion(spark, text, expected):
    got = ingest.from_text(spark, text).orderBy("seq").collect()
    assert [(r["input_id"], r["raw_smiles"]) for r in got] == expected


def test_run_folder(spark, tmp_path):
    r = catalogue.records(spark, SF)
    m = sink.write_run(r, str(tmp_path / "run"))
    assert m["total"] == 200 and m == sink.read_manifest(spark, str(tmp_path / "run"))
    assert sink.read_manifest(spark, str(tmp_path)) is None
    assert spark.read.parquet(str(tmp_path / "run/curated")).count() == m["passed"]


def test_agreement_edges(spark):
    same = spark.createDataFrame([("A", "A")] * 3, "a string, b string")
    assert validate.agreement(same).first()["kappa"] == 1.0
    odd = spark.createDataFrame([("A", "B"), ("B", "A")], "a string, b string")
    assert validate.agreement(odd).first()["kappa"] < 0


def test_empty_and_null_documents(spark):
    d = spark.createDataFrame([(1, None, "en", None, None)], "doc_id long, text string, lang string, source string, n_chars long")
    assert curate.curate(d).first()["rejection_code"] == "ERR_EMPTY"
    assert report.funnel(curate.curate(d.limit(0))).where("stage_status = 'SKIPPED'").count() == 6


def test_structures_by_tokens(spark):
    given = {"CCO": True, "C1CC1": True, "C1CC": False, "C(C": False, "C)C(": False, "[NH4+]": True, "hello": False, "": False, "=C": False}
    got = spark.createDataFrame([(x,) for x in given], "x string").select("x", ingest.parses(F.col("x")).alias("ok")).collect()
    assert {r["x"]: r["ok"] for r in got} == given


def test_multiset_difference(spark):
    cases = [(["b", "a", "b", "b"], ["b"]), (["a"], ["a", "a"]), ([], ["a"]), (["x\0001", "x"], ["x"])]
    got = spark.createDataFrame(cases, "a array<string>, b array<string>").select(T.multiset_difference(F.col("a"), F.col("b")).alias("d")).collect()
    assert [r["d"] for r in got] == [["a", "b", "b"], [], [], ["x\0001"]]


def test_command_line(spark, tmp_path, capsys):
    given = str(tmp_path / "docs.parquet")
    spark.read.parquet(f"{SF}/documents.parquet").write.parquet(given)
    assert cli.run(["--input", given, "--out-dir", str(tmp_path / "out")]) == 0
    assert "total: 200" in capsys.readouterr().out
    spark.read.parquet(given).limit(0).write.parquet(str(tmp_path / "none.parquet"))
    assert cli.run(["--input", str(tmp_path / "none.parquet"), "--out-dir", str(tmp_path / "o")]) == 1
    assert cli.run(["--input", str(tmp_path / "missing"), "--out-dir", str(tmp_path / "o")]) == 2


def test_streams(spark, tmp_path):
    source = spark.read.parquet(f"{SF}/documents.parquet")
    source.write.parquet(str(tmp_path / "in"))
    stream = dedup_stream.curate_stream(spark.readStream.schema(source.schema).parquet(str(tmp_path / "in"))).withColumn("ts", F.timestamp_seconds(F.col("seq") + 1_000_000))
    first = dedup_stream.first_identities(stream, "ts", "1000 seconds").select("identity")
    q = first.writeStream.format("memory").queryName("firsts").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    want = catalogue.records(spark, SF).where("identity is not null").select("identity").distinct().count()
    assert spark.table("firsts").count() == want


def test_lines_of_several_files_stay_in_order(spark, tmp_path):
    """Files of three sizes: Spark reads the largest first, the records follow the names."""
    for name, n in (("a", 2), ("b", 300), ("c", 40)):
        (tmp_path / f"{name}.txt").write_text("".join(f"{name}{i} C{'C' * (i % 5)}\n" for i in range(n)))
    got = [r["input_id"] for r in ingest.from_path(spark, str(tmp_path)).orderBy("seq").collect()]
    assert got == [f"{name}{i}" for name, n in (("a", 2), ("b", 300), ("c", 40)) for i in range(n)]


def test_output_digest_is_of_a_multiset(spark):
    rows = [(i, None if i % 3 == 0 else f"x{i}") for i in range(50)]
    digest = lambda r, n=3: report.output_digest(spark.createDataFrame(r, "a long, b string").repartition(n), "a", "b").first()["digest"]
    assert digest(rows) == digest(rows[::-1], 7) != digest([*rows, rows[0]]) and digest([(1, None)]) != digest([(1, "")])


def test_repeated_records_conflict_one_less_than_they_are(spark):
    r = spark.createDataFrame([(1, "a", "X-1-N", "X", "p")] * 4 + [(2, "b", "X-1-N", "X", None)] * 2 + [(3, "c", None, None, "p")] * 2, "seq long, input_id string, identity string, block1 string, annotation string")
    got = sorted((x["incoming_id"], x["existing_id"], x["collision_type"]) for x in dedup.collisions(r).collect())
    assert got == [("a", "a", dedup.EXACT)] * 3 + [("b", "a", dedup.EXACT)] * 2
    assert dedup.collisions(r.limit(0)).count() == 0


def test_many_inputs_are_ingested_at_once(spark):
    """Each text as an input of its own gives what it gives alone."""
    texts = [
        "name;structure\nwater;O\nbenzene;c1ccccc1", "CCCl\nC=C\nC#N", "mol|grade\nCCBr|high\n|none\nOCCO|low", "#!\n\n  x7\t C(F)F \nx8\tNCC", "k1 CCS\nk2\nk3 CCP", "", None,
        "compound_id,smiles\r\nA1,CCO\r\nA2,c1ccccc1", "SMILES,Tipo\nCCO,ok\n,vazio\nCCN,ok", "CCO first\nCCN second", "hello", "id\tsmiles\nX\tCCO", "\n".join(f"m{i},CC{'C' * (i % 9)}" for i in range(300)),
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc long, t string")
    got = {}
    for r in ingest.ingest_lines(ingest.lines_of(df, "doc", "t")).orderBy("input", "seq").collect():
        got.setdefault(r["input"], []).append((r["seq"], r["input_id"], r["raw_smiles"]))
    for i, text in enumerate(texts):
        alone = [(r["seq"], r["input_id"], r["raw_smiles"]) for r in ingest.from_text(spark, text or "").orderBy("seq").collect()]
        assert got.get(i, []) == alone, text
    assert ingest.ingest_lines(ingest.lines_of(df.limit(0), "doc", "t")).count() == 0


def test_gold_standard_file(spark, tmp_path):
    path = tmp_path / "gold.csv"
    path.write_text('compound_id,raw_smiles,annotator_a,annotator_b,consensus,reason,more\nA1,"C,C",accept,ACCEPT,,"said ""yes""",x\n A2 ,CC,Accept,reject, REJECT ,,x\nA3,C,perhaps,REJECT,no,,x\nA4,C,,REJECT,,,x\nA5,C,ACCEPT,REJECT,,,x\n')
    rows = gold.read(spark, str(path))
    assert {(e["row"], e["field"], e["value"]) for e in gold.errors(rows).collect()} == {(4, "annotator_a", "perhaps"), (4, "consensus", "no"), (5, "annotators", None)}
    got = {e["compound_id"]: e for e in gold.entries(rows).collect()}
    assert {k: (e["row"], e["resolved"]) for k, e in got.items()} == {"A1": (2, "ACCEPT"), "A2": (3, "REJECT"), "A5": (6, None)}
    assert got["A1"]["raw_smiles"] == "C,C" and got["A1"]["reason"] == 'said "yes"'
    report_ = gold.agreement_report(gold.entries(rows)).first()
    assert (report_["n"], report_["disagreements"], report_["unresolved"], report_["sufficient"]) == (3, 2, 1, False)
    (tmp_path / "bad.csv").write_text("compound_id,raw_smiles\nA,C\n")
    with pytest.raises(ValueError, match="annotator_a, annotator_b"):
        gold.read(spark, str(tmp_path / "bad.csv"))
    gold.write_template(spark.createDataFrame([("a", "C"), ("b", "CC")], "input_id string, raw_smiles string"), str(tmp_path / "blank"))
    blank = gold.read(spark, str(tmp_path / "blank"))
    assert blank.count() == 2 and gold.errors(blank).count() == 2 and gold.entries(blank).count() == 0


def test_rows_of_small_files_are_dealt(spark, tmp_path):
    """A small file is one partition; what its rows cost isn't one task's work."""
    spark.range(1, 60).selectExpr("id AS p_partkey", "int(id % 7) AS p_size", "'b' AS p_brand").coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    for name in ("q_formula_delta", "q_formula_parse", "q_mw_ha_carbon"):
        assert catalogue.QUERIES[name](spark, str(tmp_path)).rdd.getNumPartitions() > 1, name


def test_a_formula_is_parsed_once_for_all_its_elements(spark):
    d = spark.createDataFrame([("C9H8O4", "C2H6ONaClN5"), ("C2H6O", "C2H6O"), ("", "C"), ("CHCH", "C2H3+"), (None, "C")], "b string, a string").select(S.formula_delta(F.col("b"), F.col("a")).alias("d"))
    assert [r["d"] for r in d.collect()] == ["-C7 +Cl1 -H2 +N5 +Na1 -O3", "", "", "+H1", None]
    plan = d._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") <= 6

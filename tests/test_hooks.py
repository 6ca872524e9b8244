"""A policy's own standardizer, parent transform and probes; exports of chosen columns."""

import pytest
from pyspark.sql import functions as F

from sieveline.operators import export, structures
from sieveline.operators.structures import Hooks, Probe

ROWS = [("a", "CCO"), ("b", "CC(=O)[O-].[Na+]"), ("c", "C(C"), ("d", None), ("e", "CCN.Cl"), ("f", "O[Cu]"), ("g", "CCBr"), ("a", "CCO")]


def _records(spark, hooks=Hooks(), rows=ROWS, **limits):
    df = spark.createDataFrame([(i, k, v) for i, (k, v) in enumerate(rows)], "seq long, input_id string, raw_smiles string")
    return structures.curate_structures(df, structures.Limits(**limits), hooks)


def test_hooks_that_change_nothing_change_no_record(spark):
    same = Hooks(standardize=lambda s: s, parent_transform=lambda s: s)
    plain, hooked = ({(r["seq"], str(r.asDict())) for r in _records(spark, h).collect()} for h in (Hooks(), same))
    # Bound alkali atoms that stay would be reported at both boundaries; there are none here.
    assert plain == hooked


def test_standardizer_changes_refuses_and_leaves_excluded_ones(spark):
    hooks = Hooks(standardize=lambda s: F.when(s == "CCO", F.lit("CCS")).when(s == "CCBr", F.lit("C(")).when(~s.contains("N"), s))
    got = {r["seq"]: r for r in _records(spark, hooks).collect()}
    assert (got[0]["curated_smiles"], got[0]["raw_smiles"], got[0]["delta_formula"]) == ("CCS", "CCO", "-O1 +S1")
    assert got[0]["identity"] == got[7]["identity"]
    assert [(got[i]["rejection_code"], got[i]["rejection_stage"]) for i in (4, 6)] == [("ERR_STANDARDIZE", "STANDARDIZE")] * 2
    assert [got[i]["rejection_code"] for i in (2, 3)] == ["ERR_SYNTAX", "ERR_EMPTY"]
    assert got[5]["curated_smiles"] == "O[Cu]" and [e["rule"] for e in got[5]["transformations"]] == ["standardization_skipped_excluded"]
    assert all(got[i]["transformations"] == [] for i in (2, 3, 4, 6))


def test_parent_transform_keeps_the_parent_where_it_fails(spark):
    hooks = Hooks(parent_transform=lambda s: F.when(s == "CCO", F.lit("CCCl")).when(s == "CCN", F.lit("C((")).when(s == "CCBr", F.lit("")))
    got = {r["seq"]: r for r in _records(spark, hooks).collect()}
    assert [got[i]["curated_smiles"] for i in (0, 4, 6, 5)] == ["CCCl", "CCN", "CCBr", "O[Cu]"]
    # Of the transformed parent are weight and key; events end before it.
    assert abs(got[0]["parent_mw"] - 64.51) < 0.1 and got[0]["transformations"] == []
    limited = {r["seq"]: r["rejection_code"] for r in _records(spark, hooks, max_weight=60.0).collect()}
    assert limited[0] == "ERR_MW_LIMIT" and limited[4] is None


def test_probes_see_both_boundaries_in_order(spark):
    probes = (Probe("second", lambda b, a, stage: F.when(b["smiles"] != a["smiles"], F.lit(stage))), Probe("atoms", lambda b, a, stage: F.size(a["graph"]["atoms"]).cast("string")))
    hooks = Hooks(standardize=lambda s: F.replace(s, F.lit("[O-].[Na+]"), F.lit("O")), probes=probes)
    got = {r["seq"]: [(e["stage"], e["rule"], e["detail"]) for e in r["transformations"] if e["rule"] in ("second", "atoms")] for r in _records(spark, hooks).collect()}
    assert got[1] == [("STANDARDIZE", "second", "STANDARDIZE"), ("STANDARDIZE", "atoms", "4"), ("GET_PARENT", "atoms", "4")]
    assert got[4] == [("STANDARDIZE", "atoms", "4"), ("GET_PARENT", "second", "GET_PARENT"), ("GET_PARENT", "atoms", "3")]
    assert got[2] == got[3] == []


def test_exports(spark, tmp_path):
    r = _records(spark)
    r.write.parquet(str(tmp_path / "records"))
    r = spark.read.parquet(str(tmp_path / "records"))
    got = {x["input_id"]: x for x in export.export(r, ("input_id", "molecular_formula", "salt_removed", "inchikey_block1", "transformations")).collect()}
    assert (got["a"]["molecular_formula"], got["a"]["salt_removed"], got["c"]["molecular_formula"], got["c"]["inchikey_block1"]) == ("C2H6O", False, "", None)
    assert got["e"]["salt_removed"] and '"rule":"fragments_removed"' in got["e"]["transformations"]
    assert export.export(r).columns == list(export.NATIVE) and export.export(r).count() == len(ROWS)
    for odd in (("input_id", "nothing"), ("input_id", "input_id")):
        with pytest.raises(ValueError):
            export.export(r, odd)
    # Only what is asked for is read.
    plan = export.export(r, ("input_id", "salt_removed"))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<input_id:string,removed_fragments:string>" in plan
    assert export.export(_records(spark, rows=[])).count() == 0

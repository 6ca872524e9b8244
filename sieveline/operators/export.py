"""Exports of chosen columns: native ones of a record, and some that are worked out only where they are asked for."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.functions import graph as G

#: Columns of a record, and those made on demand.
NATIVE = (
    "input_id", "raw_smiles", "curated_smiles", "inchikey", "inchikey_block1", "status", "rejection_code", "rejection_stage", "rejection_detail", "removed_fragments", "salt_removed",
    "delta_net_charge", "delta_formula", "delta_stereocenters", "n_stereocenters_total", "n_components_parent", "parent_mw", "parent_heavy_atoms", "excluded_flag", "transformations",
)
ON_DEMAND = ("molecular_formula",)


def export(records: DataFrame, columns: tuple[str, ...] = NATIVE) -> DataFrame:
    """The columns asked for, in their order, of records of structures; an unknown or repeated one is an error.

    Events are JSON text; ``salt_removed`` says whether a fragment went. The molecular formula is
    parsed from the curated structure; it is empty where there is none. Only what the columns
    asked for need is read from a table of records.
    """
    if unknown := sorted(set(columns) - {*NATIVE, *ON_DEMAND}):
        raise ValueError(f"no such columns: {', '.join(unknown)}")
    if len(set(columns)) < len(columns):
        raise ValueError("columns are asked for twice")
    g = G.parse(F.col("curated_smiles"))
    made = {
        "inchikey": lambda: F.col("identity"), "inchikey_block1": lambda: F.col("block1"), "transformations": lambda: F.to_json("transformations"),
        "salt_removed": lambda: F.coalesce(F.col("removed_fragments") != "", F.lit(False)), "molecular_formula": lambda: F.when(F.col("curated_smiles").isNull(), "").otherwise(G.formula(g, G.valences(g))),
    }
    return records.select(*(made[c]().alias(c) if c in made else F.col(c) for c in columns))

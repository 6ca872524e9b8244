"""Ingestion of loosely structured text: delimiter, header and columns inferred from a bounded sample, ids made up."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sieveline.functions import graph as G
from sieveline.functions.text import held, strip
from sieveline.sources.encoding import decode_lines

#: Delimiters in order, header names, sample size, least share of parseable cells.
DELIMITERS = (",", "\t", ";", "|")
STRUCTURE_NAMES = frozenset({"smiles", "canonical_smiles", "smi", "structure", "mol", "molecule"})
ID_NAMES = frozenset({"id", "input_id", "compound_id", "cmpd_id", "name", "identifier", "chembl_id"})
SAMPLE, LEAST = 50, 0.6
_PLAUSIBLE = r"[A-Za-z0-9@+\-\[\]\(\)=#%./\\]+"


def plausible(col: Column) -> Column:
    """Made of a structure string's characters only (a test without a graph)."""
    return col.rlike(f"^(?:{_PLAUSIBLE})$")


def parses(col: Column) -> Column:
    """A structure string by tokens, balance of brackets and parity of ring labels; no graph is built."""
    body = F.regexp_replace(col, r"\[[^\[\]]+\]", "C")
    turns = F.transform(F.regexp_extract_all(body, F.lit(r"[()]"), F.lit(0)), lambda c: F.when(c == "(", 1).otherwise(-1))
    # The open brackets so far; null once one closes too many.
    open_ = F.aggregate(turns, F.lit(0), lambda n, t: F.when(n + t >= 0, n + t))
    labels = F.regexp_extract_all(body, F.lit(r"%\d\d|\d"), F.lit(0))
    paired = F.forall(F.array_distinct(labels), lambda x: F.size(F.filter(labels, lambda y: y == x)) % 2 == 0)
    # The test of the letters comes first, on what is given: few cells need the others. A bracket counts as C, so that an l may follow.
    letters = col.rlike(r"^(?=[A-Za-z*\[])(?:\[[^\[\]]+\]l?|Br|Cl|[BCNOPSFIbcnops*]|[-=#$:/\\.()]|%\d\d|\d)+$")
    return F.coalesce(letters & (open_ == 0) & paired, F.lit(False))


@dataclass(frozen=True)
class Layout:
    delimiter: str | None
    header: bool
    structure: int
    id: int | None


def _cells(delimiter: str | None) -> Column:
    return F.transform(F.split("value", "\\Q" + delimiter + "\\E" if delimiter else r"\s+"), strip)


def infer(sample: DataFrame) -> Layout:
    """The layout of a sample of lines (``at``, ``value``): two aggregates of it.

    A delimiter stands equally often in all lines; the most frequent one is it. A first
    line with a known name, or without a structure, is a header. Without a named column,
    the one with the highest share of structures among the lines that have it is chosen.
    """
    mark = F.explode(F.array(*[F.struct(F.lit(d).alias("d"), F.lit(i).alias("rank"), (F.length("value") - F.length(F.replace("value", F.lit(d), F.lit("")))).alias("n")) for i, d in enumerate(DELIMITERS)]))
    steady = sample.select(mark.alias("m")).groupBy("m.d", "m.rank").agg(F.min("m.n").alias("n"), F.max("m.n").alias("most")).where("n = most and n > 0")
    found = steady.orderBy(F.desc("n"), "rank").select("d").take(1)
    delimiter = found[0]["d"] if found else None
    lines = sample.select((F.col("at") == F.min("at").over(Window.partitionBy())).alias("top"), F.posexplode(_cells(delimiter)).alias("pos", "cell")).withColumn("ok", parses(F.col("cell")))
    shape = lines.groupBy("pos").agg(
        F.max(F.when(F.col("top"), F.lower("cell"))).alias("name"), F.bool_or(F.col("top") & F.col("ok")).alias("top_ok"), F.bool_or("top").alias("in_top"),
        F.count_if("ok").alias("ok"), F.count("*").alias("n"),
    )
    columns = shape.orderBy("pos").collect()  # one row for each column of the sample
    header = any(c["n"] > 1 for c in columns) and (any(c["name"] in STRUCTURE_NAMES | ID_NAMES for c in columns) or not any(c["top_ok"] for c in columns))
    named = {kind: [c["pos"] for c in columns if header and c["name"] in names] for kind, names in (("structure", STRUCTURE_NAMES), ("id", ID_NAMES))}
    if named["structure"]:
        at = named["structure"][0]
        return Layout(delimiter, True, at, named["id"][0] if named["id"] else None)
    # Lines that have the column, without the header's.
    share = {c["pos"]: (c["ok"] - (header and c["top_ok"])) / held for c in columns if (held := c["n"] - (header and c["in_top"])) > 0}
    ranked = sorted(share, key=share.get, reverse=True)
    at = ranked[0] if ranked and share[ranked[0]] >= LEAST else 0
    others = [*named["id"], *share]
    return Layout(delimiter, header, at, next((pos for pos in others if pos != at), None))


def number(df: DataFrame, *order: str) -> DataFrame:
    """``seq`` from 1 without gaps, by ``order``: rows are range-partitioned, counted, and numbered within partitions."""
    s = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_p", F.spark_partition_id())
    counts = s.groupBy("_p").agg(F.count("*").alias("_n"))  # a row per partition
    before = counts.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("_p", "_before")
    own = Window.partitionBy("_p").orderBy(*order)
    return s.join(F.broadcast(before), "_p").withColumn("seq", F.col("_before") + F.row_number().over(own)).drop("_p", "_before")


def from_lines(lines: DataFrame) -> DataFrame:
    """seq, input_id, raw_smiles from ``value`` in the order of ``at``; blank and # lines are left out."""
    clean = lines.select("at", strip(F.col("value")).alias("value")).where("value <> '' and not startswith(value, '#')")
    sample = clean.orderBy("at").limit(SAMPLE)
    spark = lines.sparkSession
    if sample.isEmpty():
        return spark.createDataFrame([], "seq long, input_id string, raw_smiles string")
    layout = infer(sample)
    rows = number(clean, "at")
    if layout.header:
        rows = rows.where("seq > 1").withColumn("seq", F.col("seq") - 1)
    cells = _cells(layout.delimiter)
    cell = lambda i: F.coalesce(F.get(cells, F.lit(i)), F.lit(""))
    made = F.format_string("CMPD_%07d", "seq")
    given = F.coalesce(F.nullif(cell(layout.id), F.lit("")), made) if layout.id is not None else made
    return rows.select("seq", given.alias("input_id"), cell(layout.structure).alias("raw_smiles"))


def from_text(spark: SparkSession, text: str) -> DataFrame:
    return from_lines(spark.createDataFrame(list(enumerate(text.splitlines())), "at long, value string"))


def from_path(spark: SparkSession, path: str, encoding: str | None = None) -> DataFrame:
    """Text files in the order of their names, then of position; each by the encoding given, else by the first that all of its lines allow.

    Spark packs parts of files into partitions by size; a line's place within a part only
    grows with ``monotonically_increasing_id``, and the file and the part's start come before it.
    """
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("line")).alias("at")
    if encoding is not None:
        raw = spark.read.option("encoding", encoding).text(path)
        return from_lines(raw.select(place, F.regexp_replace("value", r"^\ufeff", "").alias("value")))
    raw = spark.read.text(path).select(place, F.col("value").cast("binary").alias("raw"))
    return from_lines(decode_lines(raw.withColumn("file", F.col("at.file")), "file").select("at", "value"))


def preview(rows: DataFrame, head: int = 5) -> DataFrame:
    """total, n_invalid, head (the first rows: seq, input_id, raw_smiles): one row. ``invalid`` lists what doesn't parse."""
    n = rows.agg(F.count("*").alias("total"), F.count_if(G.parse(F.col("raw_smiles"))["code"].isNotNull()).alias("n_invalid"))
    first = rows.orderBy("seq").limit(head).agg(F.array_sort(F.collect_list(F.struct("seq", "input_id", "raw_smiles"))).alias("head"))
    return n.crossJoin(first)


def invalid(rows: DataFrame) -> DataFrame:
    """seq, input_id, raw_smiles, code: the rows whose structure doesn't parse, as a table (it grows with the input)."""
    return held(rows, "code", G.parse(F.col("raw_smiles"))["code"]).where("code is not null").select("seq", "input_id", "raw_smiles", "code")


def lines_of(texts: DataFrame, input_: str, text: str) -> DataFrame:
    """input, at, value: the lines of each text that aren't blank or comments, numbered from 0; a row is one input."""
    kept = F.filter(F.transform(F.split(F.coalesce(F.col(text), F.lit("")), r"\r\n|\n|\r"), strip), lambda x: (x != "") & ~x.startswith("#"))
    return texts.select(F.col(input_).alias("input"), F.posexplode(kept).alias("at", "value"))


def layouts(lines: DataFrame) -> DataFrame:
    """input, delimiter, header, structure, id: the layout of each input of ``lines`` (input, at, value), all inputs at once.

    Two grouped aggregates over the first ``SAMPLE`` lines of each: how steady each
    delimiter stands, then what stands in each column (numbers of each line, no texts). ``delimiter`` is null for white
    space and ``id`` where ids are to be made up. An input without lines has no layout.
    """
    sample = lines.where(F.col("at") < SAMPLE)
    mark = F.explode(F.array(*[F.struct(F.lit(d).alias("d"), F.lit(i).alias("rank"), (F.length("value") - F.length(F.replace("value", F.lit(d), F.lit("")))).alias("n")) for i, d in enumerate(DELIMITERS)]))
    steady = sample.select("input", mark.alias("m")).groupBy("input", "m.d", "m.rank").agg(F.min("m.n").alias("n"), F.max("m.n").alias("most"))
    best = F.min(F.when((F.col("n") == F.col("most")) & (F.col("n") > 0), F.struct((-F.col("n")).alias("n"), "rank", "d")))
    cut_at = steady.groupBy("input").agg(best["d"].alias("delimiter"))
    # Cells stay in their line's row: of each line go on its number of cells, the places of structures and, of the first, names.
    known = F.array(*map(F.lit, sorted(STRUCTURE_NAMES | ID_NAMES)))
    # A number that grows with the name: odd for known ones, even between them.
    code = lambda c: F.when(F.array_contains(known, c), 2 * F.array_position(known, c).cast("int") - 1).otherwise(2 * F.size(F.filter(known, lambda x: x < c)))
    top, cells = F.col("at") == 0, F.col("cells")
    line = F.struct(
        top.alias("top"), F.size(cells).alias("n"), F.filter(F.transform(cells, lambda c, i: F.when(parses(c), i)), lambda i: i.isNotNull()).alias("ok"),
        F.when(top, F.transform(cells, lambda c: code(F.lower(c)))).alias("codes"),
    )
    seen = sample.join(cut_at, "input").select("input", "delimiter", "at", split_cells("value", "delimiter").alias("cells"))
    held = seen.select("input", "delimiter", line.alias("line")).groupBy("input", "delimiter").agg(F.collect_list("line").alias("seen"))  # at most SAMPLE entries of a text

    def column(p):
        name = F.array_max(F.transform("seen", lambda x: F.get(x["codes"], p)))
        has = lambda x: F.array_contains(x["ok"], p)
        return F.struct(
            p.alias("pos"), F.when(name % 2 == 1, F.get(known, ((name - 1) / 2).cast("int"))).alias("name"), F.exists("seen", lambda x: x["top"] & has(x)).alias("top_ok"),
            F.exists("seen", lambda x: x["top"] & (x["n"] > p)).alias("in_top"), F.size(F.filter("seen", has)).alias("ok"), F.size(F.filter("seen", lambda x: x["n"] > p)).alias("n"),
        )

    # As many entries as the sample's longest line has columns.
    whole = held.select("input", "delimiter", F.transform(F.sequence(F.lit(0), F.array_max(F.transform("seen", lambda x: x["n"])) - 1), column).alias("cols"))
    named = lambda kinds: lambda c: F.coalesce(c["name"].isin(*sorted(kinds)), F.lit(False))
    header = F.exists("cols", lambda c: c["n"] > 1) & (F.exists("cols", named(STRUCTURE_NAMES | ID_NAMES)) | ~F.exists("cols", lambda c: c["top_ok"]))
    whole = whole.withColumn("header", header)
    pos = lambda kinds: F.transform(F.filter("cols", lambda c: F.col("header") & named(kinds)(c)), lambda c: c["pos"])
    less = lambda flag: (F.col("header") & flag).cast("int")
    held = F.filter("cols", lambda c: c["n"] - less(c["in_top"]) > 0)
    share = F.transform(held, lambda c: F.struct((-(c["ok"] - less(c["top_ok"])) / (c["n"] - less(c["in_top"]))).alias("share"), c["pos"].alias("pos")))
    whole = whole.withColumns({"s": F.get(pos(STRUCTURE_NAMES), F.lit(0)), "ids": pos(ID_NAMES), "share": share})
    top = F.array_min("share")
    whole = whole.withColumn("structure", F.coalesce("s", F.when(top["share"] <= -LEAST, top["pos"]), F.lit(0)))
    other = F.get(F.filter(F.concat("ids", F.transform("share", lambda x: x["pos"])), lambda p: p != F.col("structure")), F.lit(0))
    return whole.select("input", "delimiter", "header", "structure", F.when(F.col("s").isNotNull(), F.get("ids", F.lit(0))).otherwise(other).alias("id"))


def split_cells(value: str, delimiter: str) -> Column:
    """The cells of a line by its input's own delimiter; by white space where that is null."""
    d = F.col(delimiter)
    parts = [F.when(d == x, F.split(value, "\\Q" + x + "\\E")) for x in DELIMITERS]
    # White space that isn't \s may stand at the edges of words too, in few lines.
    words = F.split(value, r"\s+")
    return F.when(d.isNull() & ~F.col(value).rlike(r"[\x1c-\x1f\x85\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"), words).otherwise(F.transform(F.coalesce(*parts, words), strip))


def ingest_lines(lines: DataFrame) -> DataFrame:
    """input, seq, input_id, raw_smiles: every line of every input by its input's layout; a join that adaptive execution can split where one input has very many lines."""
    met = lines.join(layouts(lines), "input").withColumn("cells", split_cells("value", "delimiter")).where("not (header and at = 0)")
    met = met.withColumn("seq", (F.col("at") + 1 - F.col("header").cast("int")).cast("long"))
    cell = lambda i: F.coalesce(F.get("cells", i), F.lit(""))
    made = F.format_string("CMPD_%07d", "seq")
    given = F.when(F.col("id").isNotNull(), F.nullif(cell(F.col("id")), F.lit("")))
    return met.select("input", "seq", F.coalesce(given, made).alias("input_id"), cell(F.col("structure")).alias("raw_smiles"))

"""Identity conflicts in input order.

With the first record of an identity as the one kept, firsts are aggregated (within tasks
before any shuffle), later records are joined to them, so that adaptive execution can split
an identity that holds very many records, and only firsts stand in the window over a block.
With the last one kept, each record refers to the one before it, which takes a window over
all records of an identity (it spills).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

EXACT, ANNOTATION, BLOCK1 = "EXACT_DUPLICATE", "ANNOTATION_CONFLICT", "BLOCK1_COLLISION"
#: Texts of the conflict report.
SAYS_EXACT = "InChIKey completo idêntico ao da primeira ocorrência"
SAYS_ANNOTATION = ("mesma estrutura com anotações divergentes: '", "' vs '", "' - requer decisão humana")
SAYS_BLOCK1 = ("mesmo esqueleto de conectividade, identidades distintas: ", " - não é duplicata")
SAYS_STEREO, SAYS_PROTON = "estereoquímica ou isotopologia", "estado de protonação"
SAYS_ODD, SAYS_NOWHERE = "estrutura de InChIKey inesperada", "diferença não localizada"


def block1_difference(left, right) -> F.Column:
    """Which of the later key blocks differ."""
    a, b = F.split(left, "-"), F.split(right, "-")
    parts = F.array(F.when(F.get(a, F.lit(1)) != F.get(b, F.lit(1)), SAYS_STEREO), F.when(F.get(a, F.lit(2)) != F.get(b, F.lit(2)), SAYS_PROTON))
    said = F.concat_ws(" e ", F.filter(parts, lambda p: p.isNotNull()))
    return F.when((F.size(a) < 3) | (F.size(b) < 3), SAYS_ODD).otherwise(F.when(said == "", SAYS_NOWHERE).otherwise(said))


def collisions(records: DataFrame, keep_first: bool = True, annotation: str = "annotation") -> DataFrame:
    """collision_type, incoming_id, existing_id, incoming_key, existing_key, block1, detail: one row at most per passed record.

    Records stand in the order of ``seq`` (of any type that orders, a number for ``keep_first=False``),
    ``input_id``, annotation; of wholly equal ones one is the first. Records without an identity conflict with nothing.
    """
    r = records.where("identity is not null").select("seq", "input_id", "identity", "block1", F.col(annotation).alias("ann"))
    w = _after_first(r) if keep_first else _after_previous(r)
    conflict = F.col("ann").isNotNull() & F.col("first_ann").isNotNull() & (F.col("ann") != F.col("first_ann"))
    kind = F.when(F.col("again"), F.when(conflict, ANNOTATION).otherwise(EXACT)).when(F.col("near_key").isNotNull(), BLOCK1)
    again = F.col("again")
    return w.withColumn("collision_type", kind).where("collision_type is not null").select(
        "collision_type", F.col("input_id").alias("incoming_id"), F.when(again, F.col("same_id")).otherwise(F.col("near_id")).alias("existing_id"), F.col("identity").alias("incoming_key"),
        F.when(again, F.col("identity")).otherwise(F.col("near_key")).alias("existing_key"), "block1",
        F.when(F.col("collision_type") == ANNOTATION, F.concat(F.lit(SAYS_ANNOTATION[0]), "first_ann", F.lit(SAYS_ANNOTATION[1]), "ann", F.lit(SAYS_ANNOTATION[2])))
        .when(F.col("collision_type") == BLOCK1, F.concat(F.lit(SAYS_BLOCK1[0]), block1_difference(F.col("identity"), F.col("near_key")), F.lit(SAYS_BLOCK1[1])))
        .otherwise(SAYS_EXACT).alias("detail"),
    )


def first_records(records: DataFrame) -> DataFrame:
    """identity, block1, seq, input_id, ann: the first record of each identity."""
    place = F.struct("seq", "input_id", "ann")
    return records.groupBy("identity", "block1").agg(F.min(place).alias("f")).select("identity", "block1", "f.*")


def _after_first(r: DataFrame) -> DataFrame:
    firsts = first_records(r)
    of = firsts.select(F.col("identity").alias("same"), F.struct("seq", "input_id", "ann").alias("first"))
    met = r.join(of, F.col("identity") == F.col("same")).withColumn("is_first", F.struct("seq", "input_id", "ann").eqNullSafe(F.col("first")))
    shape = ("input_id", "identity", "block1", "ann", F.col("first.input_id").alias("same_id"), F.col("first.ann").alias("first_ann"))
    none, no_id = F.lit(None).cast("string"), F.lit(None).cast(r.schema["input_id"].dataType)
    later = met.where("not is_first").select(*shape)
    # Wholly equal records: all but one come after it.
    equal = met.where("is_first").groupBy("identity", "block1", "first").agg(F.count("*").alias("n")).where("n > 1").withColumn("turn", F.explode(F.sequence(F.lit(2), F.col("n"))))
    equal = equal.select(F.col("first.input_id").alias("input_id"), "identity", "block1", F.col("first.ann").alias("ann"), F.col("first.input_id").alias("same_id"), F.col("first.ann").alias("first_ann"))
    dup = later.unionByName(equal).withColumns({"again": F.lit(True), "near_key": none, "near_id": no_id})
    block = Window.partitionBy("block1").orderBy("seq", "input_id").rowsBetween(Window.unboundedPreceding, -1)
    near = firsts.withColumns({"near_key": F.min("identity").over(block), "near_id": F.min_by("input_id", "identity").over(block), "again": F.lit(False), "same_id": no_id, "first_ann": none})
    return dup.unionByName(near.drop("seq"))


def _after_previous(r: DataFrame) -> DataFrame:
    key = Window.partitionBy("block1", "identity").orderBy("seq", "input_id")
    block = Window.partitionBy("block1").orderBy("seq", "input_id").rowsBetween(Window.unboundedPreceding, -1)
    w = r.select("*", (F.row_number().over(key) > 1).alias("again"), F.lag("input_id").over(key).alias("same_id"), F.first("ann").over(key).alias("first_ann"))
    return w.withColumns({"near_key": F.min("identity").over(block), "near_id": F.min_by("input_id", F.struct("identity", -F.col("seq"))).over(block)})

"""Column functions on records' texts: normal form, skeleton, identity key, and Python's notion of white space."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Python's str.strip and str.split take these for white space; Spark's trim takes blanks only.
WHITE = r"[\s\x1c-\x1f\x85   -     　]"


def strip(col: Column) -> Column:
    return F.regexp_replace(col, rf"^{WHITE}+|{WHITE}+$", "")


def normalize(col: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(col, r"\s+", " ")))


def skeleton(norm: Column) -> Column:
    return F.regexp_replace(norm, "[^a-z]", "")


def identity_key(norm: Column) -> Column:
    """Three blocks: whole digests of the skeleton and of the normal form, closing mark."""
    return F.concat_ws("-", F.md5(skeleton(norm)), F.md5(norm), F.when(F.right(norm, F.lit(1)) == ".", "N").otherwise("M"))


def block1(key: Column) -> Column:
    return F.substring_index(key, "-", 1)


def let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once, though lambdas inside refer to it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def held(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a column that is worked out once for each row and where it stands: no filter on it is moved below (to before rows are dealt, say), nor is it copied into what refers to it."""
    return df.select("*", F.explode_outer(F.array(value)).alias(name))


def _numbered(members: Column) -> Column:
    """The members in order, each followed by its number among equal ones."""

    def runs(s):
        heads = F.filter(F.transform(s, lambda x, i: F.when((i == 0) | (x != F.get(s, i - 1)), i)), lambda i: i.isNotNull())
        number = lambda i, at: F.concat(F.get(s, i), F.lit("\0"), (i - at).cast("string"))
        of = lambda h: F.transform(h, lambda at, j: F.transform(F.sequence(at, F.coalesce(F.get(h, j + 1), F.size(s)) - 1), lambda i: number(i, at)))
        return let(heads, lambda h: F.flatten(of(h)))

    return let(F.array_sort(members), runs)


def multiset_difference(before: Column, after: Column) -> Column:
    """Members of ``before`` beyond their number in ``after``, sorted; one sort of each and a hash set."""
    return F.transform(F.array_except(_numbered(before), _numbered(after)), lambda x: F.regexp_replace(x, r"\x00\d+$", ""))

"""Encodings of text inputs, told from all their bytes.

Lines end at bytes that stand in no longer UTF-8 sequence, so each line is tested by itself and
an input's encoding is an aggregate over its lines: no probe that could cut a letter, no file
that one task holds whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Encodings in the order in which they are tried. The last one decodes any byte.
ENCODINGS = ("utf-8-sig", "cp1252", "latin-1")
UTF8, CP1252, LATIN1 = ENCODINGS
#: Bytes 128 to 159 that cp1252 has letters for, with these, and those that it has none for.
_LETTERS = {chr(b): letter for b in range(0x80, 0xA0) if (letter := bytes([b]).decode("cp1252", "ignore"))}
_NONE = "".join(chr(b) for b in range(0x80, 0xA0) if chr(b) not in _LETTERS)


def _as_latin1(raw: Column) -> Column:
    return F.decode(raw, "ISO-8859-1")


def encodings(lines: DataFrame, input_: str = "input", raw: str = "raw") -> DataFrame:
    """input, encoding: the first of ``ENCODINGS`` that all lines (binary) of the input can be read by; null lines allow any."""
    utf8 = F.is_valid_utf8(F.col(raw).cast("string"))
    cp1252 = ~_as_latin1(F.col(raw)).rlike(f"[{_NONE}]")
    all_ = lambda test: F.coalesce(F.bool_and(test), F.lit(True))
    return lines.groupBy(input_).agg(F.when(all_(utf8), UTF8).when(all_(cp1252), CP1252).otherwise(LATIN1).alias("encoding"))


def decoded(raw: Column, encoding: Column) -> Column:
    """The text of bytes in one of ``ENCODINGS``, without a mark of byte order."""
    latin1 = _as_latin1(raw)
    utf8 = F.regexp_replace(raw.cast("string"), r"^﻿", "")
    return F.when(encoding == UTF8, utf8).when(encoding == CP1252, F.translate(latin1, "".join(_LETTERS), "".join(_LETTERS.values()))).otherwise(latin1)


def decode_lines(lines: DataFrame, input_: str = "input", raw: str = "raw") -> DataFrame:
    """The lines with ``encoding`` and ``value``, each input by the encoding that all of its lines allow."""
    return lines.join(encodings(lines, input_, raw), input_).withColumn("value", decoded(F.col(raw), F.col("encoding"))).drop(raw)

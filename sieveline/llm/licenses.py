"""License scans by diagonal voting, all native.

One pass over the texts keeps the places of those rolling word 2-grams that may stand in a
template (both words do). Their hashes are joined to the positions of such grams in the
templates; grams are compared as words after the hashes met, so no hash collision counts.
A hit votes for the diagonal ``document position - template position``. Votes are gathered
per (row, template, diagonal); neighbouring diagonals (words inserted or left out) that
overlap are merged, and a merged span is verified by the share of the template's positions
that it holds, each counted once. A phrase counts where all its grams lie on one diagonal.

Edge cases: null text is empty; texts with fewer than two words have no hits; each row has
its own result, whether its id is null, repeated or not; without hits the positions are
null and the labels empty; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sieveline.llm.common import cut

#: Phrases whose places count, with their labels.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
#: Templates of licence notices, with their labels.
TEMPLATES = (
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("this work is licensed under the gnu general public license version 3", "gpl"),
    ("gnu lesser general public license", "lgpl"),
    ("mozilla public license version 2 0", "mpl-2.0"),
    ("licensed under cc by 4 0", "cc-by"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("licensed under cc by sa 4 0", "cc-by-sa"),
    ("creative commons attribution 4 0 international", "cc-by"),
    ("creative commons zero public domain dedication", "cc0"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
)
TOKEN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
DRIFT, SHARE = 2, 0.8


def _words(col) -> F.Column:
    """The words with A-Z in lower case. Letters beyond ASCII are lowered too, which no phrase holds; the two of them that would become ASCII are put aside."""
    text = F.replace(F.replace(F.coalesce(col, F.lit("")), F.lit("K"), F.lit("�")), F.lit("İ"), F.lit("�"))
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def _gram(words, w, i) -> F.Column:
    """Place, hash and words of a 2-gram."""
    after = F.get(words, i + 1)
    return F.struct(i.alias("pos"), F.xxhash64(w, after).alias("h"), F.concat_ws(" ", w, after).alias("g"))


def scan(docs: DataFrame, phrases=PHRASES, templates=TEMPLATES) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score for each document."""
    spark = docs.sparkSession
    entries = [(i, label, i < len(phrases), text, len(text.split()) - 1) for i, (text, label) in enumerate([*phrases, *templates])]
    t = spark.createDataFrame(entries, "template int, label string, base boolean, phrase string, n_grams int")
    # As many rows as the fixed lists have words: a proven bound for the broadcast.
    w = F.split("phrase", " ")
    positions = t.select("template", "label", "base", "n_grams", F.posexplode(F.transform(F.slice(w, 1, F.size(w) - 1), lambda x, i: _gram(w, x, i))).alias("tpl_pos", "gram"))
    positions = F.broadcast(positions.select("template", "label", "base", "n_grams", "tpl_pos", F.col("gram.h").alias("th"), F.col("gram.g").alias("tg")))
    lists = [text.split() for _, _, _, text, _ in entries]
    opens, closes = sorted({x for p in lists for x in p[:-1]}), sorted({x for p in lists for x in p[1:]})

    def read(words):
        hit = lambda x, i: F.when(x.isin(opens) & F.get(words, i + 1).isin(closes), _gram(words, x, i))
        return F.struct(F.size(words).cast("long").alias("n_words"), F.filter(F.transform(words, hit), lambda x: x.isNotNull()).alias("grams"))

    # The one pass over the texts: a row's number, its words' number and its few hits are written down.
    rows = cut(docs.select("doc_id", F.get(F.transform(F.array(_words(F.col("text"))), read), 0).alias("x")).select(F.monotonically_increasing_id().alias("row"), "doc_id", "x.*"))
    hits = rows.select("row", F.explode("grams").alias("x")).select("row", "x.*").join(positions, (F.col("h") == F.col("th")) & (F.col("g") == F.col("tg"))).withColumn("diagonal", F.col("pos") - F.col("tpl_pos"))
    votes = hits.groupBy("row", "template", "label", "base", "n_grams", "diagonal").agg(F.collect_set("tpl_pos").alias("at"), F.min("pos").alias("lo"), F.max("pos").alias("hi"))
    exact = F.col("base") & (F.size("at") == F.col("n_grams"))
    near = Window.partitionBy("row", "template").orderBy("diagonal")
    new = F.coalesce(((F.col("diagonal") - F.lag("diagonal").over(near)) > DRIFT) | ((F.col("lo") - F.lag("hi").over(near)) > 1 + DRIFT) | ((F.lag("lo").over(near) - F.col("hi")) > 1 + DRIFT), F.lit(True))
    merged = votes.withColumn("span", F.sum(F.when(new, 1).otherwise(0)).over(near))
    held = F.size(F.array_distinct(F.flatten(F.collect_list("at"))))
    spans = merged.groupBy("row", "template", "span").agg(
        F.first("label").alias("label"), F.first("base").alias("base"), F.sum(F.when(exact, 1).otherwise(0)).alias("places"), (held / F.first("n_grams")).alias("share"),
        F.min(F.when(exact, F.col("diagonal"))).alias("first"), F.max(F.when(exact, F.col("diagonal"))).alias("last"),
    )
    kept = spans.where(F.when(F.col("base"), F.col("places") > 0).otherwise(F.col("share") >= SHARE))
    found = kept.groupBy(F.col("row").alias("found")).agg(
        F.sum("places").cast("long").alias("n_base"), F.min("first").cast("long").alias("first_word"), F.max("last").cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("base"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"), F.max("share").alias("score"),
    )
    none = lambda c, v: F.coalesce(c, F.lit(v)).alias(c)
    out = rows.join(found, F.col("row") == F.col("found"), "left")
    return out.select("doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word", none("base_labels", ""), none("labels", ""), none("score", 0.0))

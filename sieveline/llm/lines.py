"""Line dedup by content-defined chunks of words that grow to whole repeated spans, all native.

1. A text's lines are cut down to their words, each with the white space behind it, as whole
   lines and sentences are too coarse for a passage of 50 words that begins and ends anywhere.
2. Rolling hashes over two neighbouring words choose boundaries: where one is the least of
   ``RADIUS`` on both sides (and below ``LOW``), at a text's ends and, in stretches of over ``GAP`` words without
   a boundary, of ``FINE`` on both sides, or at every word if that leaves as long a stretch.
   ``min_words`` words from a boundary are a seed, all from one boundary to the next seed's
   end a chunk. A passage of ``GAP + RADIUS + min_words`` words (50) holds a seed, always.
3. Hashes that repeat anywhere are counted before the shuffle. The first place (smallest
   doc_id, then text hash, then place) stays; all later ones are joined to it. Those that
   adjoin and stand in one first text as they stand here are one stretch, which is compared
   with that text byte by byte, and part by part where it differs as a whole. A hash that
   two different texts share removes nothing.
4. Where a stretch of repeated chunks ends, the words beyond it are compared with those
   beside the first place, up to ``REACH`` words, and equal ones go too: a passage goes whole.

No group of places meets in one task: places join the one first place, and first places are
read once for each stretch.

Edge cases: null texts stay null, empty ones empty; rows that repeat an id with the
same text count as one and keep equal texts; a null id counts as less than any other;
repeats of fewer than ``min_words`` words stay, but at the edges of longer ones; input
columns called ``n_units``, ``n_removed`` or ``removed_chars`` are replaced, all others
stay, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sieveline.llm.common import cut

#: A word with the white space behind it, and white space that a text begins with (Java's \s is ASCII).
_UNIT = r"^\s+|\S+\s*"
_BLANK = " \t\n\x0b\f\r"
RADIUS, FINE, GAP = 8, 2, 32
#: A quarter of all hashes are below; few of the least of 17 aren't.
LOW = -(2**62)
#: Words of a passage before its first seed or behind its last, at most.
REACH = GAP + RADIUS


def _units(col) -> F.Column:
    return F.regexp_extract_all(col, F.lit(_UNIT), F.lit(0))


def _let(value, body) -> F.Column:
    """``body`` of a value that is worked out once for each row, even if the optimizer moves the expression into a filter or a lambda."""
    return F.get(F.transform(F.array(value), body), 0)


def _words(units, start, end) -> F.Column:
    return F.slice(units, start + 1, F.greatest(end - start, F.lit(0)))


def _join(units, start, end) -> F.Column:
    return F.array_join(_words(units, start, end), "")


def _bare(col) -> F.Column:
    return F.rtrim(col, F.lit(_BLANK))


def _least(roll, radius: int):
    """Whether the value at a place is the least of so many on both sides; of equal ones the first is."""

    def at(i):
        # The nearest come first and the rest is only looked at if those are greater; beyond the ends there is null.
        out = F.lit(True)
        for r in range(radius, 0, -1):
            out = (F.get(roll, i) < F.get(roll, i - r)) & ((F.get(roll, i) <= F.get(roll, i + r)) & out)
        return F.coalesce(out, F.lit(True))

    return at


def _boundaries(roll, k: int) -> F.Column:
    """Places of a text's boundaries in order, from its rolling hashes (one for each word)."""
    coarse, fine = _least(roll, RADIUS), _least(roll, FINE)
    size = F.size(roll)
    long = lambda at: F.array_max(F.transform(F.slice(at, 2, F.size(at) - 1), lambda x, j: x - F.get(at, j))) > GAP

    def between(at):
        def one(b, j):
            # In runs of one word, or of two in turn, all places of a phase say the same: every eighth will do.
            again = lambda i: ((F.get(roll, i) == F.get(roll, i - 1)) & (i % 8 != 0)) | ((F.get(roll, i) == F.get(roll, i - 2)) & (i % 8 > 1))
            every = F.filter(F.sequence(b + 1, F.get(at, j + 1) - 1), lambda i: ~F.coalesce(again(i), F.lit(False)))
            some = F.filter(F.sequence(b + 1, F.get(at, j + 1) - 1), fine)
            dense = _let(F.concat(F.array(b), some, F.array(F.get(at, j + 1))), lambda d: F.when(long(d), every).otherwise(some))
            return F.when(F.get(at, j + 1) - b > GAP, F.concat(F.array(b), dense)).otherwise(F.array(b))

        return F.flatten(F.transform(at, one))

    inner = F.filter(F.sequence(F.lit(0), size - 1), lambda i: (F.get(roll, i) < LOW) & coarse(i))
    every = _let(F.concat(F.array(F.lit(-1)), inner, F.array(size)), between)
    ends = F.when(size > k, F.array(size - k)).otherwise(F.array().cast("array<int>"))
    return F.concat(F.array(F.lit(0)), F.filter(every, lambda i: (i > 0) & (i < size - k)), ends)


def _chunks(texts: DataFrame, k: int) -> DataFrame:
    """doc_id, th, chunks (start; ch: the seed's hash; next: the next seed's start, link: the hash of the words up to its end, null for the last one): one row per text."""

    def of(units):
        def chunks(pairs):
            # Every second pair has all words; the last word counts without the white space behind it.
            seed = lambda s: F.xxhash64(*(F.get(pairs, s + r) for r in sorted({*range(0, k - 2, 2), k - 3}) if r >= 0), _bare(F.get(units, s + k - 1)))

            def linked(both):
                at, ch = both["at"], both["ch"]

                def one(s, j):
                    to = F.get(at, j + 1)
                    # Words between the seeds, eight at a time; no boundary is further than GAP from the next one.
                    between = [F.when(to - s > r, F.xxhash64(*(F.get(pairs, F.least(s + i, to)) for i in range(r, r + 8, 2)))) for r in range(k - 1, GAP, 8)]
                    link = F.when(to.isNotNull(), F.xxhash64(F.get(ch, j), F.get(ch, j + 1), to - s, *between))
                    return F.struct(s.alias("start"), F.get(ch, j).alias("ch"), to.alias("next"), link.alias("link"))

                return F.transform(at, one)

            return _let(_boundaries(pairs, k), lambda at: _let(F.struct(at.alias("at"), F.transform(at, seed).alias("ch")), linked))

        pairs = F.transform(units, lambda u, i: F.xxhash64(u, F.get(units, i + 1)))
        return F.when(F.size(units) >= k, _let(pairs, chunks))

    return texts.where("text <> ''").select("doc_id", "th", _let(_units(F.col("text")), of).alias("chunks"))


def _places(texts: DataFrame, k: int) -> DataFrame:
    """doc_id, th, start, end, ch, seed and the first place's row as ``first``, of seeds and chunks that stand at an earlier place too; rows that repeat a text repeat its places.

    A chunk's hash says that the seed behind it repeats as well; it ends where that one begins."""
    # Kept as one row per text, a third of the bytes.
    c = cut(_chunks(texts, k)).select("doc_id", "th", F.inline("chunks"))
    twice = c.groupBy("ch").count().where("count > 1").select(F.col("ch").alias("k"))
    again = cut(c.join(twice, c.ch == F.col("k")).drop("k"))
    links = again.where("link is not null").select("doc_id", "th", "start", F.col("next").alias("end"), F.col("link").alias("ch"), F.lit(False).alias("seed"))
    every = again.select("doc_id", "th", "start", (F.col("start") + k).alias("end"), "ch", F.lit(True).alias("seed")).unionByName(links)
    place = F.struct("doc_id", "th", "start", "end")
    first = every.groupBy("ch").agg(F.min(place).alias("first")).select(F.col("ch").alias("k"), "first")
    return every.join(first, every.ch == F.col("k")).drop("k").where(~place.eqNullSafe(F.col("first")))


def _asked(later: DataFrame) -> DataFrame:
    """Stretches: the later places that cover all of them, in runs that stand in one first text as they stand here.

    doc_id, th, start, end, left and right (whether no place adjoins there), f_id, f_th, f_start, f_end and the places as ``parts``."""
    row = Window.partitionBy("doc_id", "th").orderBy("start", "seed", "ch")
    so_far = row.rowsBetween(Window.unboundedPreceding, -1)
    # A seed whose chunk repeats is covered by that one and the next seed; rows that repeat a text repeat its places.
    x = later.withColumns({"before": F.lag("start").over(row), "same": F.lag("ch").over(row) == F.col("ch")})
    x = x.where(F.col("before").isNull() | (F.col("before") < F.col("start")) | ~(F.col("seed") | F.col("same")))
    first = F.struct("first.doc_id", "first.th", (F.col("first.start") - F.col("start")).alias("shift"))
    x = x.select("doc_id", "th", "start", "end", "seed", "ch", first.alias("first"))
    goes_on = (F.lag("end").over(row) >= F.col("start")) & F.lag("first").over(row).eqNullSafe(F.col("first"))
    left = F.coalesce(F.col("start") > F.max("end").over(so_far), F.lit(True))
    right = F.col("seed") & F.coalesce(F.lead("start").over(row) > F.col("end"), F.lit(True))
    x = x.withColumns({"left": left, "right": right, "new": F.when(goes_on, 0).otherwise(1)})
    x = x.withColumn("run", F.sum("new").over(row.rowsBetween(Window.unboundedPreceding, 0)))
    runs = x.groupBy("doc_id", "th", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.max("left").alias("left"), F.max("right").alias("right"), F.first("first").alias("first"), F.collect_list(F.struct("start", "end", "left", "right")).alias("parts"))
    shifted = lambda c: F.col(c) + F.col("first.shift")
    return runs.select("doc_id", "th", "start", "end", "left", "right", F.col("first.doc_id").alias("f_id"), F.col("first.th").alias("f_th"), shifted("start").alias("f_start"), shifted("end").alias("f_end"), "parts")


def _read(texts: DataFrame, places: DataFrame) -> DataFrame:
    """``places`` (doc_id, th, start, end, left, right and others) with the text there, and with what stands beside it where ``left`` or ``right`` asks for it."""
    others = [c for c in places.columns if c not in ("doc_id", "th")]
    lists = places.groupBy("doc_id", "th").agg(F.collect_list(F.struct(*others)).alias("seen")).select(F.col("doc_id").alias("l_id"), F.col("th").alias("l_th"), "seen")
    on = F.col("doc_id").eqNullSafe(F.col("l_id")) & (F.col("th") == F.col("l_th"))

    def read(units):
        def one(s):
            none = F.array().cast("array<string>")
            ahead = F.when(s["left"], _words(units, F.greatest(s["start"] - REACH, F.lit(0)), s["start"])).otherwise(none)
            behind = F.when(s["right"], _words(units, s["end"], s["end"] + REACH)).otherwise(none)
            return F.struct(*(s[c].alias(c) for c in others), _join(units, s["start"], s["end"]).alias("chunk"), ahead.alias("ahead"), behind.alias("behind"))

        return F.transform("seen", one)

    # No filter is inferred from an outer explode, which would read each text twice.
    x = texts.join(lists, on).select("doc_id", "th", F.explode_outer(_let(_units(F.col("text")), read)).alias("x"))
    return x.select("doc_id", "th", "x.*")


def _common(a, b, backwards: bool) -> F.Column:
    """Characters of the words that two lists begin (or end) with alike; the white space behind the last one may differ, but not backwards."""

    def count(both):
        x, y = both["x"], both["y"]
        apart = F.array_position(F.zip_with(x, y, lambda v, w: v == w), F.lit(False))
        same = F.when(apart > 0, apart - 1).otherwise(F.least(F.size(x), F.size(y))).cast("int")
        more = F.lit(0) if backwards else F.when(_bare(F.get(x, same)) == _bare(F.get(y, same)), F.length(F.get(x, same)))
        return _let(same, lambda m: F.length(_join(x, F.lit(0), m)) + F.coalesce(more, F.lit(0)))

    turned = lambda c: F.reverse(c) if backwards else c
    nearest = lambda c: F.get(c, F.size(c) - 1) if backwards else _bare(F.get(c, 0))
    return F.when(nearest(a) == nearest(b), _let(F.struct(turned(a).alias("x"), turned(b).alias("y")), count)).otherwise(0)


def _spans(texts: DataFrame, asked: DataFrame) -> DataFrame:
    """doc_id, th, start, end (units), ahead, behind (characters beyond them): what goes, a stretch in one piece or, where that differs, part by part."""
    firsts = asked.groupBy("f_id", "f_th", "f_start", "f_end").agg(F.max("left").alias("left"), F.max("right").alias("right")).toDF("doc_id", "th", "start", "end", "left", "right")
    f = _read(texts, firsts).drop("left", "right").toDF("k_id", "k_th", "k_start", "k_end", "f_chunk", "f_ahead", "f_behind")
    on = F.col("f_id").eqNullSafe(F.col("k_id")) & (F.col("f_th") == F.col("k_th")) & (F.col("f_start") == F.col("k_start")) & (F.col("f_end") == F.col("k_end"))
    x = _read(texts, asked).join(f, on)
    ahead, behind = _common(F.col("ahead"), F.col("f_ahead"), True), _common(F.col("behind"), F.col("f_behind"), False)

    def span(start, end, left, same):
        # What stands behind goes only if the white space behind the words is the same too.
        return F.struct(start.alias("start"), end.alias("end"), F.when(left, ahead).otherwise(0).alias("ahead"), F.when(same, behind).otherwise(0).alias("behind"))

    def by_parts(both):
        at = lambda side, p: _join(both[side], p["start"] - F.col("start"), p["end"] - F.col("start"))
        equal = F.filter("parts", lambda p: _bare(at("x", p)) == _bare(at("y", p)))
        return F.transform(equal, lambda p: span(p["start"], p["end"], p["left"], p["right"] & (at("x", p) == at("y", p))))

    whole = F.array(span(F.col("start"), F.col("end"), F.lit(True), F.col("chunk") == F.col("f_chunk")))
    parts = _let(F.struct(_units(F.col("chunk")).alias("x"), _units(F.col("f_chunk")).alias("y")), by_parts)
    gone = F.when(_bare(F.col("chunk")) == _bare(F.col("f_chunk")), whole).otherwise(parts)
    return x.select("doc_id", "th", F.explode_outer(gone).alias("x")).select("doc_id", "th", "x.*").where("start is not null")


def _merged(spans: DataFrame) -> DataFrame:
    """doc_id, th, gone: each text's stretches in order, with the characters that go beyond their units."""
    row = Window.partitionBy("doc_id", "th").orderBy("start", "end")
    reached = spans.withColumn("reached", F.max("end").over(row.rowsBetween(Window.unboundedPreceding, -1)))
    x = reached.withColumn("span", F.sum(F.when(F.col("start") <= F.col("reached"), 0).otherwise(1)).over(row.rowsBetween(Window.unboundedPreceding, 0)))
    # Of the chunks that begin a stretch, or end it, the one that goes furthest.
    x = x.groupBy("doc_id", "th", "span").agg(F.max(F.struct((-F.col("start")).alias("at"), "ahead")).alias("a"), F.max(F.struct("end", "behind")).alias("b"))
    part = F.struct((-F.col("a.at")).alias("start"), F.col("b.end").alias("end"), F.col("a.ahead").alias("ahead"), F.col("b.behind").alias("behind"))
    return x.groupBy("doc_id", "th").agg(F.array_sort(F.collect_list(part)).alias("gone"))


def dedup_lines(docs: DataFrame, min_words: int = 10) -> DataFrame:
    """The rows of ``docs`` with ``text`` cut, ``n_units`` (words), ``n_removed`` (words) and ``removed_chars``; other columns stay."""
    mark = "_"
    while any(c.startswith(mark) for c in docs.columns):
        mark += "_"
    own = lambda name: mark + name
    # All joins with texts have the same left side, so that its exchange can be used again.
    keyed = docs.withColumn(own("th"), F.hash("text"))
    texts = keyed.select("doc_id", "text", F.col(own("th")).alias("th"))
    asked = cut(_asked(_places(texts, min_words)))
    gone = _merged(_spans(texts, asked)).select(F.col("doc_id").alias(own("id")), F.col("th").alias(own("key")), F.col("gone").alias(own("gone")))
    out = keyed.join(gone, F.col("doc_id").eqNullSafe(F.col(own("id"))) & (F.col(own("th")) == F.col(own("key"))), "left")
    g, size = F.col(own("gone")), lambda c: F.coalesce(F.length(c), F.lit(0))
    words = lambda c: F.coalesce(F.regexp_count(c, F.lit(r"\S+")), F.lit(0)).cast("long")

    def stays(units):
        bounds = F.concat(g, F.array(F.struct(F.size(units).alias("start"), F.lit(0).alias("end"), F.lit(0).alias("ahead"), F.lit(0).alias("behind"))))

        def between(b, j):
            before = F.get(g, j - 1)
            piece, skip = _join(units, F.coalesce(before["end"], F.lit(0)), b["start"]), F.coalesce(before["behind"], F.lit(0))
            return F.substring(piece, skip + 1, F.greatest(F.length(piece) - skip - b["ahead"], F.lit(0)))

        # White space that a text begins with is a unit, but no word.
        blank = (_bare(F.get(units, 0)) == "").cast("int")
        return F.struct(F.array_join(F.transform(bounds, between), "").alias("text"), (F.size(units) - blank).cast("long").alias("n"))

    out = out.withColumn(own("left"), F.when(g.isNull(), F.struct(F.col("text").alias("text"), words(F.col("text")).alias("n"))).otherwise(_let(_units(F.col("text")), stays)))
    left = F.col(own("left"))["text"]
    n = F.col(own("left"))["n"]
    out = out.withColumns({"n_units": n, "n_removed": F.when(g.isNull(), 0).otherwise(n - words(left)).cast("long"), "removed_chars": (size(F.col("text")) - size(left)).cast("long")})
    return out.withColumn("text", left).drop(*(own(c) for c in ("left", "th", "id", "key", "gone")))

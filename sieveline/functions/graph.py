"""Structure strings (SMILES) as graphs: native folds over their tokens, no shuffle and no Python.

A graph is a struct column: ``code`` (null, ERR_EMPTY or ERR_SYNTAX), ``atoms`` and ``bonds``.
Parsing is one left fold with a stack of branches and the open ring labels; valence, formula,
components, patterns and the canonical listing are higher-order functions over the two arrays,
so all stages of a structure stay in its row. Null strings are empty ones.

Atoms carry what is written: element (``C`` for ``c`` too), aromatic, charge, hydrogens (null
where they are implied), isotope, chiral mark and the place of their token. A bond's ends ``a``
and ``b`` come with the places ``pa`` and ``pb`` of the tokens that made it, which give each
atom's neighbours in written order. Directions of double bonds (``/``, ``\\``) are single bonds.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from sieveline.functions.structure import WEIGHTS
from sieveline.functions.text import let, strip

#: Symbols of the elements, and those that may be written in small letters.
ELEMENTS = (
    "H He Li Be B C N O F Ne Na Mg Al Si P S Cl Ar K Ca Sc Ti V Cr Mn Fe Co Ni Cu Zn Ga Ge As Se Br Kr Rb Sr Y Zr Nb Mo Tc Ru Rh Pd Ag Cd In Sn Sb Te I Xe "
    "Cs Ba La Ce Pr Nd Pm Sm Eu Gd Tb Dy Ho Er Tm Yb Lu Hf Ta W Re Os Ir Pt Au Hg Tl Pb Bi Po At Rn Fr Ra Ac Th Pa U Np Pu Am Cm Bk Cf Es Fm Md No Lr Rf Db Sg Bh Hs Mt Ds Rg Cn Nh Fl Mc Lv Ts Og"
).split()
AROMATIC = "b c n o p s as se te".split()
#: Valences of neutral atoms, rows of the table in which a charge moves an atom, metals that salts are made with.
VALENCES = {"H": (1,), "B": (3,), "C": (4,), "N": (3,), "O": (2,), "F": (1,), "Al": (3,), "Si": (4,), "P": (3, 5), "S": (2, 4, 6), "Cl": (1,), "Ge": (4,), "As": (3, 5), "Se": (2, 4, 6), "Br": (1,), "Te": (2, 4, 6), "I": (1, 3, 5)}
ROWS = (("B", "C", "N", "O", "F"), ("Al", "Si", "P", "S", "Cl"), ("Ga", "Ge", "As", "Se", "Br"), ("In", "Sn", "Sb", "Te", "I"))
COUNTERIONS = ("Li", "Na", "K", "Mg", "Ca")
_SYMBOLS = "|".join(sorted(ELEMENTS, key=len, reverse=True))
ATOM = rf"(?:\[\d*(?:{_SYMBOLS}|{'|'.join(sorted(AROMATIC, key=len, reverse=True))}|\*)@{{0,2}}(?:H\d*)?(?:\+\d+|-\d+|\++|-+)?(?::\d+)?\]|Br|Cl|[BCNOPSFI*]|[bcnops])"
TOKEN = rf"{ATOM}|%\d\d|[\s\S]"
_ORDERS = {"-": 1, "=": 2, "#": 3, "$": 4, ":": 1, "/": 1, "\\": 1}

_BOND = "struct<a:int,b:int,o:string,pa:int,pb:int>"
_STATE = f"struct<n:int,prev:int,last:string,bond:string,stack:array<int>,open:array<struct<l:string,a:int,o:string,p:int>>,bonds:array<{_BOND}>,bad:boolean>"


def _tokens(text: Column) -> Column:
    """Each token with its place, its kind (atom a, ring r, bond b, or itself; x: none) and what it says."""
    said = F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))

    def shaped(t, i):
        kind = F.when(t.isin("(", ")", "."), t).when(t.isin(*_ORDERS), "b").when(t.rlike(r"^(?:\d|%\d\d)$"), "r").when(t.rlike(f"^{ATOM}$"), "a").otherwise("x")
        return F.struct(t.alias("t"), i.cast("int").alias("i"), kind.alias("k"))

    return F.transform(said, shaped)


def _step(s: Column, t: Column) -> Column:
    k, last, prev, i = t["k"], s["last"], s["prev"], t["i"]
    joined = last.isin("a", "r", ")")
    label = F.lpad(F.regexp_replace(t["t"], "%", ""), 2, "0")
    symbol = F.when(t["t"].isin("/", "\\"), "-").otherwise(t["t"])
    bond = lambda a, b, o, pa, pb: F.array(F.struct(a.alias("a"), b.alias("b"), o.alias("o"), pa.alias("pa"), pb.alias("pb")))
    no_bond, no_open = F.array().cast(f"array<{_BOND}>"), F.array().cast("array<struct<l:string,a:int,o:string,p:int>>")
    opened = F.get(F.filter(s["open"], lambda o: o["l"] == label), F.lit(0))
    closes = (k == "r") & opened.isNotNull()
    clash = closes & ((opened["a"] == prev) | ((opened["o"] != "") & (s["bond"] != "") & (opened["o"] != s["bond"])) | F.exists(s["bonds"], lambda b: (F.least(b["a"], b["b"]) == F.least(prev, opened["a"])) & (F.greatest(b["a"], b["b"]) == F.greatest(prev, opened["a"]))))
    allowed = (
        F.when(k == "a", True).when(k == "r", (joined | (last == "b")) & ~clash).when(k == "b", joined | (last == "("))
        .when(k == "(", joined).when(k == ")", joined & (F.size(s["stack"]) > 0)).when(k == ".", joined | (last == "(")).otherwise(False)
    )
    made = F.when((k == "a") & (prev >= 0), bond(prev, s["n"], s["bond"], i, i)).when(closes, bond(opened["a"], prev, F.when(s["bond"] != "", s["bond"]).otherwise(opened["o"]), opened["p"], i)).otherwise(no_bond)
    new = F.struct(
        F.when(k == "a", s["n"] + 1).otherwise(s["n"]).alias("n"),
        F.when(k == "a", s["n"]).when(k == ")", F.get(s["stack"], F.size(s["stack"]) - 1)).when(k == ".", -1).otherwise(prev).alias("prev"),
        k.alias("last"), F.when(k == "b", symbol).otherwise("").alias("bond"),
        F.when(k == "(", F.array_append(s["stack"], prev)).when(k == ")", F.slice(s["stack"], F.lit(1), F.greatest(F.size(s["stack"]) - 1, F.lit(0)))).otherwise(s["stack"]).alias("stack"),
        F.when(closes, F.filter(s["open"], lambda o: o["l"] != label)).when(k == "r", F.concat(s["open"], F.array(F.struct(label.alias("l"), prev.alias("a"), s["bond"].alias("o"), i.alias("p"))))).otherwise(s["open"]).alias("open"),
        F.concat(s["bonds"], made).alias("bonds"), (~allowed).alias("bad"),
    ).cast(_STATE)
    return F.when(s["bad"], s).otherwise(new)


def _atom(t: Column) -> Column:
    text, inside = t["t"], t["t"].startswith("[")
    part = lambda pattern: F.regexp_extract(text, pattern, 1)
    name = F.when(inside, part(rf"^\[\d*({_SYMBOLS}|{'|'.join(sorted(AROMATIC, key=len, reverse=True))}|\*)")).otherwise(text)
    signs = F.when(inside, part(r"([+-]\d+|\++|-+)(?::\d+)?\]$")).otherwise("")
    size = F.when(F.length(F.regexp_replace(signs, "[+-]", "")) > 0, F.regexp_replace(signs, "[+-]", "").try_cast("int")).otherwise(F.length(signs))
    held = F.when(inside, part(r"[^\[\d](H\d*)(?:[+-].*)?(?::\d+)?\]$")).otherwise("")
    return F.struct(
        F.initcap(name).alias("element"), name.isin(*AROMATIC).alias("aromatic"), (size * F.when(signs.startswith("-"), -1).otherwise(1)).alias("charge"),
        F.when(inside, F.when(held == "", 0).when(held == "H", 1).otherwise(F.substring(held, 2, 9).try_cast("int"))).alias("hydrogens"),
        F.coalesce(F.when(inside, part(r"^\[(\d*)").try_cast("int")), F.lit(0)).alias("isotope"), F.when(inside, part(r"(@+)")).otherwise("").alias("chiral"), t["i"].alias("place"),
    )


def parse(smiles: Column) -> Column:
    """struct(code, atoms, bonds). Order of a bond: ``-``, ``=``, ``#``, ``$``, or ``:`` between aromatic atoms where none is written. A structure with an error has neither atoms nor bonds."""
    text = strip(F.coalesce(smiles, F.lit("")))
    start = F.from_json(F.lit('{"n":0,"prev":-1,"last":".","bond":"","stack":[],"open":[],"bonds":[],"bad":false}'), _STATE)

    def whole(tokens):
        return let(F.aggregate(tokens, start, _step), lambda s: let(F.transform(F.filter(tokens, lambda t: t["k"] == "a"), _atom), lambda atoms: shaped(s, atoms)))

    def shaped(s, atoms):
        bad = s["bad"] | ~s["last"].isin("a", "r", ")") | (F.size(s["stack"]) > 0) | (F.size(s["open"]) > 0)
        both = lambda b: F.get(atoms, b["a"])["aromatic"] & F.get(atoms, b["b"])["aromatic"]
        bonds = F.transform(s["bonds"], lambda b: b.withField("o", F.when(b["o"] != "", b["o"]).when(both(b), ":").otherwise("-")))
        return F.struct(F.when(bad, "ERR_SYNTAX").alias("code"), F.when(bad, F.slice(atoms, 1, 0)).otherwise(atoms).alias("atoms"), F.when(bad, F.slice(bonds, 1, 0)).otherwise(bonds).alias("bonds"))

    parsed = let(_tokens(text), whole)
    return F.when(text == "", parsed.withField("code", F.lit("ERR_EMPTY"))).otherwise(parsed)


def _order(o: Column) -> Column:
    return F.coalesce(*[F.when(o == k, v) for k, v in _ORDERS.items()], F.lit(1))


def _map(d: dict) -> Column:
    return F.create_map(*[x for k, v in d.items() for x in (F.lit(k), v if isinstance(v, Column) else F.lit(v))])


def like_neutral(element: Column, charge: Column) -> Column:
    """The neutral element with as many electrons, within a row of the table; null where a row ends or an element stands in none."""
    moved = [F.when(element.isin(*row), F.get(F.array(*map(F.lit, row)), F.array_position(F.array(*map(F.lit, row)), element).cast("int") - 1 - charge)) for row in ROWS]
    at = [F.when(element.isin(*row), F.array_position(F.array(*map(F.lit, row)), element).cast("int") - 1 - charge) for row in ROWS]
    return F.when(F.coalesce(*at) >= 0, F.coalesce(*moved))


def valences(graph: Column) -> Column:
    """For each atom struct(used, hydrogens, ok): bond orders at it, its hydrogens written or implied, and whether some valence of it allows that.

    An aromatic atom gives one more to the ring's double bonds if it is a carbon without one
    of its own, a nitrogen or the like with two neighbours, or one with a positive charge.
    An atom outside brackets takes hydrogens up to its least sufficient valence; one in
    brackets may have any valence up to its greatest. Atoms of other elements are free.
    """

    def of(a, i):
        own = lambda: F.filter(graph["bonds"], lambda b: (b["a"] == i) | (b["b"] == i))
        return let(own(), lambda bonds: let(F.aggregate(bonds, F.lit(0), lambda n, b: n + _order(b["o"])), lambda sigma: known(a, bonds, sigma)))

    def known(a, bonds, sigma):
        held = F.coalesce(a["hydrogens"], F.lit(0))
        double = F.exists(bonds, lambda b: b["o"].isin("=", "#"))
        carbon, pnictogen, chalcogen = a["element"].isin("C", "Si"), a["element"].isin("N", "P", "As"), a["element"].isin("O", "S", "Se", "Te")
        ring = a["aromatic"] & ((carbon & (a["charge"] == 0) & ~double) | (pnictogen & ((a["charge"] == 1) | ((a["charge"] == 0) & (sigma + held == 2)))) | (chalcogen & (a["charge"] == 1)))
        return let(sigma + ring.cast("int"), lambda used: judged(a, used, held))

    def judged(a, used, held):
        table = _map({k: F.array(*map(F.lit, v)) for k, v in VALENCES.items()})
        twin = F.when((a["element"] == "H") | (a["charge"] == 0), a["element"]).otherwise(like_neutral(a["element"], a["charge"]))
        checked = F.element_at(table, a["element"]).isNotNull()
        allowed = F.when(a["element"] == "H", F.array(1 - F.abs(a["charge"]))).otherwise(F.coalesce(F.element_at(table, twin), F.array(F.lit(0))))
        enough = F.array_min(F.filter(allowed, lambda v: v >= used))
        implied = F.when(a["hydrogens"].isNull() & checked, F.coalesce(enough - used, F.lit(0))).otherwise(held)
        ok = ~checked | F.when(a["hydrogens"].isNull(), enough.isNotNull()).otherwise(used + held <= F.array_max(allowed))
        return F.struct(used.alias("used"), implied.alias("hydrogens"), ok.alias("ok"))

    return F.transform(graph["atoms"], of)


def excluded(graph: Column) -> Column:
    """Holds a metal that isn't one of salts: such structures pass the valence gate unjudged."""
    free = [*VALENCES, *COUNTERIONS, "*"]
    return F.exists(graph["atoms"], lambda a: ~a["element"].isin(*free))


def valence_code(graph: Column, valence: Column) -> Column:
    """ERR_VALENCE where an atom has a valence that its element doesn't; an earlier error stays."""
    wrong = F.exists(valence, lambda v: ~v["ok"])
    return F.coalesce(graph["code"], F.when(wrong & ~excluded(graph), "ERR_VALENCE"))


def formula(graph: Column, valence: Column) -> Column:
    """The molecular formula: carbon, hydrogen, then others by name (all by name without carbon), and the charge."""
    named = F.concat(F.transform(graph["atoms"], lambda a: a["element"]), F.flatten(F.transform(valence, lambda v: F.array_repeat(F.lit("H"), v["hydrogens"]))))

    def written(all_):
        carbon = F.array_contains(all_, "C")
        order = lambda e: F.when(carbon & (e == "C"), "0").when(carbon & (e == "H"), "1").otherwise(F.concat(F.lit("2"), e))
        keys = F.sort_array(F.transform(F.array_distinct(all_), lambda e: F.struct(order(e).alias("k"), e.alias("e"))))
        one = lambda k: let(F.size(F.filter(all_, lambda e: e == k["e"])), lambda n: F.concat(k["e"], F.when(n > 1, n.cast("string")).otherwise("")))
        return F.array_join(F.transform(keys, one), "")

    charge = F.aggregate(graph["atoms"], F.lit(0), lambda n, a: n + a["charge"])
    sign = F.when(charge == 0, "").otherwise(F.concat(F.when(charge > 0, "+").otherwise("-"), F.when(F.abs(charge) > 1, F.abs(charge).cast("string")).otherwise("")))
    return F.concat(let(named, written), sign)


def weight(graph: Column, valence: Column) -> Column:
    """Average molecular weight by the weights of ``structure.WEIGHTS``; null where an element has none there."""
    table = _map(WEIGHTS)
    atoms = F.aggregate(graph["atoms"], F.lit(0.0), lambda w, a: w + F.element_at(table, a["element"]))
    return atoms + F.aggregate(valence, F.lit(0), lambda n, v: n + v["hydrogens"]) * F.lit(WEIGHTS["H"])


def neighbours(graph: Column) -> Column:
    """For each atom its neighbours in written order: struct(p, to, o)."""
    both = F.flatten(F.transform(graph["bonds"], lambda b: F.array(F.struct(b["a"].alias("at"), b["pa"].alias("p"), b["b"].alias("to"), b["o"].alias("o")), F.struct(b["b"].alias("at"), b["pb"].alias("p"), b["a"].alias("to"), b["o"].alias("o")))))
    return let(both, lambda all_: F.transform(graph["atoms"], lambda _, i: F.sort_array(F.transform(F.filter(all_, lambda e: e["at"] == i), lambda e: F.struct(e["p"].alias("p"), e["to"].alias("to"), e["o"].alias("o"))))))


def components(graph: Column) -> Column:
    """For each atom the least atom of its component: bonds are contracted one after the other."""
    alone = F.transform(graph["atoms"], lambda _, i: i.cast("int"))

    def joined(c, b):
        x, y = F.get(c, b["a"]), F.get(c, b["b"])
        return F.when(x == y, c).otherwise(F.transform(c, lambda v: F.when((v == x) | (v == y), F.least(x, y)).otherwise(v)))

    return F.aggregate(graph["bonds"], alone, joined)


@dataclass(frozen=True)
class Pattern:
    """Atoms (elements that may stand there, charge or None, degree or None) in an order in which each but a component's first is bonded to an earlier one: bonds (earlier, later, orders)."""

    atoms: tuple[tuple[tuple[str, ...], int | None, int | None], ...]
    bonds: tuple[tuple[int, int, str], ...] = ()


_ANY_ACID = (("O",), None, None)
ALKALI = Pattern(((("Li", "Na", "K"), 0, None), (("N", "O"), 0, None)), ((0, 1, "-"),))
TARTRATE = Pattern(
    ((("C",), 0, 3), (("C",), 0, 3), (("C",), 0, 3), (("C",), 0, 3), _ANY_ACID, _ANY_ACID, (("O",), 0, 1), (("O",), 0, 1), _ANY_ACID, _ANY_ACID),
    ((0, 1, "-"), (1, 2, "-"), (2, 3, "-"), (0, 4, "="), (0, 5, "-"), (1, 6, "-"), (2, 7, "-"), (3, 8, "="), (3, 9, "-")),
)


def matches(graph: Column, pattern: Pattern) -> Column:
    """The sets of atoms that the pattern fits, each once however many ways it fits them: partial fits grow atom by atom."""
    adjacent = neighbours(graph)

    def fits(i, want, near):
        elements, charge, degree = want
        a = F.get(graph["atoms"], i)
        ok = a["element"].isin(*elements)
        if charge is not None:
            ok &= a["charge"] == charge
        return ok if degree is None else ok & (F.size(F.get(near, i)) == degree)

    def grown(near):
        found = F.transform(F.filter(F.transform(graph["atoms"], lambda _, i: i.cast("int")), lambda i: fits(i, pattern.atoms[0], near)), lambda i: F.array(i))
        for j in range(1, len(pattern.atoms)):
            (anchor, _, orders), *more = [b for b in pattern.bonds if b[1] == j] or [(None, None, None)]

            def step(done, j=j, anchor=anchor, orders=orders, more=more):
                def extend(m):
                    start = F.transform(F.filter(F.get(near, F.get(m, F.lit(anchor))), lambda e: e["o"].isin(*orders)), lambda e: e["to"]) if anchor is not None else F.transform(graph["atoms"], lambda _, i: i.cast("int"))
                    bonded = lambda i, x, o: F.exists(F.get(near, F.get(m, F.lit(x))), lambda e: (e["to"] == i) & e["o"].isin(*o))
                    also = lambda i: [bonded(i, x, o) for x, _, o in more]
                    good = lambda i: [fits(i, pattern.atoms[j], near), ~F.array_contains(m, i), *also(i)]

                    def all_of(i):
                        first, *rest = good(i)
                        for c in rest:
                            first &= c
                        return first

                    return F.transform(F.filter(start, all_of), lambda i: F.array_append(m, i))

                return F.flatten(F.transform(done, extend))

            found = step(found)
        return F.array_distinct(F.transform(found, lambda m: F.sort_array(m)))

    return let(adjacent, grown)


def count_matches(graph: Column, pattern: Pattern) -> Column:
    return F.size(matches(graph, pattern))


def _refined(colours: Column, near: Column) -> Column:
    """Colours hashed with their neighbours' and the bonds' orders until their number stays."""

    def once(c):
        met = lambda e: F.xxhash64(F.get(c, e["to"]), e["o"])
        return F.transform(c, lambda own, i: F.xxhash64(own, F.sort_array(F.transform(F.get(near, i), met))))

    def step(s, _):
        return F.when(s["done"], s).otherwise(let(once(s["c"]), lambda c: let(F.size(F.array_distinct(c)), lambda n: F.struct(F.when(n > s["n"], c).otherwise(s["c"]).alias("c"), F.greatest(n, s["n"]).alias("n"), (n <= s["n"]).alias("done")))))

    begin = F.struct(colours.alias("c"), F.size(F.array_distinct(colours)).alias("n"), F.lit(False).alias("done"))
    return F.aggregate(F.sequence(F.lit(0), F.size(colours)), begin, step)["c"]


def ranks(graph: Column, valence: Column) -> Column:
    """struct(classes, rank): a number for each atom that doesn't depend on how the structure is written.

    Classes come from elements and bonds first, then from charges, hydrogens and isotopes,
    so that protonated forms are numbered alike. While atoms share a class one of them is set apart and classes are refined
    anew; atoms that share a refined class are alike in all structures but very regular
    ones, so it doesn't matter which.
    """

    def started(near):
        bare = F.transform(graph["atoms"], lambda a, i: F.xxhash64(a["element"], F.size(F.get(near, i))))
        return let(_refined(bare, near), lambda skeleton: let(labelled(near, skeleton), lambda classes: settled(near, skeleton, classes)))

    def labelled(near, skeleton):
        label = F.transform(graph["atoms"], lambda a, i: F.xxhash64(F.get(skeleton, i), a["aromatic"], a["charge"], a["isotope"], F.get(valence, i)["hydrogens"]))
        return _refined(label, near)

    def settled(near, skeleton, classes):
        def step(c, _):
            shared = lambda: F.array_min(F.filter(c, lambda x: F.size(F.filter(c, lambda y: y == x)) > 1))
            apart = lambda x: F.transform(c, lambda own, i: F.when(i == F.array_position(c, x) - 1, F.xxhash64(own, F.lit("apart"))).otherwise(own))
            return F.when(F.size(F.array_distinct(c)) == F.size(c), c).otherwise(let(shared(), lambda x: _refined(apart(x), near)))

        single = F.aggregate(F.sequence(F.lit(0), F.size(classes)), classes, step)
        place = lambda c: F.sort_array(F.transform(c, lambda x, i: F.struct(F.get(skeleton, i).alias("s"), F.get(classes, i).alias("k"), x.alias("x"))))
        ranked = lambda c: let(place(c), lambda order: F.transform(c, lambda x, i: F.array_position(order, F.struct(F.get(skeleton, i).alias("s"), F.get(classes, i).alias("k"), x.alias("x"))).cast("int")))
        return F.struct(classes.alias("classes"), let(single, ranked).alias("rank"))

    return let(neighbours(graph), started)


def listing(graph: Column, valence: Column) -> Column:
    """struct(skeleton, labels, marks): the structure written by rank, in three layers.

    Elements and bonds; hydrogens and charges; isotopes and chiral marks. Two structures
    with the same three layers are the same, as the layers hold all atoms and bonds. A
    chiral mark is written as the parity of its neighbours' ranks against their written
    order, if no two of the neighbours share a class; otherwise it marks nothing.
    """

    def written(r, near):
        rank, classes = r["rank"], r["classes"]
        in_order = lambda f: F.array_join(F.transform(F.sort_array(F.transform(graph["atoms"], lambda a, i: F.struct(F.get(rank, i).alias("r"), f(a, i).alias("t")))), lambda x: x["t"]), ",")
        ends = lambda b: (F.least(F.get(rank, b["a"]), F.get(rank, b["b"])), F.greatest(F.get(rank, b["a"]), F.get(rank, b["b"])))
        pair = lambda b: F.struct(ends(b)[0].alias("x"), ends(b)[1].alias("y"), b["o"].alias("o"))
        bonds = F.array_join(F.transform(F.sort_array(F.transform(graph["bonds"], pair)), lambda p: F.concat(p["x"].cast("string"), p["o"], p["y"].cast("string"))), ",")
        skeleton = F.concat_ws("/", in_order(lambda a, i: a["element"]), bonds)
        label = lambda a, i: F.concat(F.lit("H"), F.get(valence, i)["hydrogens"].cast("string"), F.format_string("%+d", a["charge"]))

        def parity(a, i):
            hand = F.when(a["hydrogens"] > 0, F.array(F.struct(a["place"].alias("p"), F.lit(1).alias("h"), F.lit(0).alias("r"), F.lit(0).cast("long").alias("k")))).otherwise(F.array().cast("array<struct<p:int,h:int,r:int,k:bigint>>"))
            seen = F.concat(F.transform(F.get(near, i), lambda e: F.struct(e["p"].alias("p"), F.lit(0).alias("h"), F.get(rank, e["to"]).alias("r"), F.get(classes, e["to"]).alias("k"))), hand)

            def sign(order):
                turns = F.aggregate(F.flatten(F.transform(order, lambda x, j: F.transform(F.slice(order, j + 2, F.size(order)), lambda y: (x["r"] > y["r"]).cast("int")))), F.lit(0), lambda n, t: n + t)
                distinct = F.size(F.array_distinct(F.transform(order, lambda x: x["k"]))) == F.size(order)
                return F.when(distinct & (F.size(order) >= 3), F.when((turns + F.length(a["chiral"])) % 2 == 1, "L").otherwise("R")).otherwise("")

            return F.when(a["chiral"] == "", "").otherwise(let(F.sort_array(seen), sign))

        mark = lambda a, i: F.concat(F.when(a["isotope"] > 0, a["isotope"].cast("string")).otherwise(""), parity(a, i))
        return F.struct(skeleton.alias("skeleton"), in_order(label).alias("labels"), in_order(mark).alias("marks"))

    return let(ranks(graph, valence), lambda r: let(neighbours(graph), lambda near: written(r, near)))


def identity_key(graph: Column, valence: Column) -> Column:
    """Three blocks: digests of elements and bonds, of isotopes and chiral marks, and of hydrogens and charges with the sum of these before it; null without atoms."""
    charge = F.aggregate(graph["atoms"], F.lit(0), lambda n, a: n + a["charge"])
    state = F.when(charge == 0, "N").otherwise(F.concat(F.when(charge > 0, "P").otherwise("M"), F.abs(charge).cast("string")))
    return F.when(F.size(graph["atoms"]) > 0, let(listing(graph, valence), lambda t: F.concat_ws("-", F.md5(t["skeleton"]), F.md5(t["marks"]), F.concat(state, F.md5(t["labels"])))))

"""Queries on structures as graphs, each part's structure written by its key and size, with SQL that derives the graphs another way.

The SQL has no stack: an atom's neighbour before it is the last atom or dot of its own or a
shallower branch that is still open; ring labels meet by the number of their occurrence.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sieveline.functions import graph as G
from sieveline.functions.structure import WEIGHTS
from sieveline.functions.text import held
from sieveline.operators import export, structures
from sieveline.plans import catalogue
from sieveline.plans.catalogue import table
from sieveline.sources import ingest


def query(sql: str):
    """Registers a query of the catalogue; its SQL's CTEs are worked out once each."""
    return catalogue.query(re.sub(r"((?:WITH|,)\s*\w+(?:\([\w, ]+\))?) AS \((?=\s*(?:SELECT|VALUES))", r"\1 AS MATERIALIZED (", sql))


#: Parts of a chain, each as written forwards and backwards; the residue of the part's key by a slot's number of choices takes one.
SLOTS = (
    (("C", "C"), ("NC", "CN"), ("OC", "CO"), ("FC(F)(F)C", "CC(F)(F)F"), ("c1ccccc1C", "Cc1ccccc1")),
    (("C", "C"), ("C(=O)", "C(=O)"), ("C(O)", "C(O)"), ("C(N)", "C(N)"), ("N(C)", "N(C)"), ("C(C#N)", "C(C#N)"), ("S(=O)(=O)", "S(=O)(=O)")),
    (("C", "C"), ("C(C)(C)", "C(C)(C)"), ("C1(CC1)", "C1(CC1)"), ("C%12(CCCCC%12)", "C9(CCCCC9)"), ("C=C", "C=C"), ("[13CH2]", "[13CH2]"), ("[C@H](F)", "[C@@H](F)"), ("c2ccc(cc2)", "c2ccc(cc2)"), ("C(O[Na])", "C(O[Na])")),
    (("C", "C"), ("C(=O)N", "NC(=O)"), ("[N+](C)(C)", "[N+](C)(C)"), ("C([O-])", "C([O-])"), ("C(=C", "C(=C"), ("C3CC", "CCC3"), ("C(C)(C)(C)", "C(C)(C)(C)"), ("N(C)(C)", "N(C)(C)"), ("C==C", "C==C"), ("P(=O)(O)", "P(O)(=O)"), ("C(N([K])C)", "C(N(C)[K])")),
    (("C", "C"), ("O", "O"), ("N", "N"), ("Cl", "Cl"), ("Br", "Br"), ("C#N", "N#C"), ("C(=O)O", "OC(=O)"), ("C(=O)[O-].[Na+]", "[Na+].[O-]C(=O)"), ("C(=O)O.Cl", "Cl.OC(=O)"), ("N.OC(=O)[C@H](O)[C@@H](O)C(=O)O", "OC(=O)C(O)C(O)C(=O)O.N"), ("c1ccncc1", "c1cc(ccn1)"), ("O.O", "O.O"), ("O[Cu]", "[Cu]O")),
)
_CHAIN = "CASE p_size % 6 " + " ".join(f"WHEN {n} THEN '{'C' * n}'" for n in range(1, 6)) + " ELSE '' END"


def _slot(i: int, way: int) -> str:
    choices = SLOTS[i]
    return f"CASE p_partkey % {len(choices)} " + " ".join(f"WHEN {j} THEN '{c[way]}'" for j, c in enumerate(choices)) + " END"


def smiles_sql(way: int = 0) -> str:
    """The structure of a part, in the SQL of both engines; forwards or backwards."""
    order = range(len(SLOTS)) if way == 0 else reversed(range(len(SLOTS)))
    parts = [_slot(i, way) for i in order]
    parts.insert(2 if way == 0 else 3, _CHAIN)
    return f"CASE WHEN p_partkey % 97 = 0 THEN ' ' ELSE concat({', '.join(parts)}) END"


def parts(spark, d) -> DataFrame:
    """The parts' few columns, dealt over all cores: a small file is one partition, and each of its keys becomes a structure's work."""
    return table(spark, d, "part").select("p_partkey", "p_size", "p_brand").repartition(spark.sparkContext.defaultParallelism)


def structured(spark, d, way: int = 0) -> DataFrame:
    """p_partkey, smiles, g, v: the parts' structures as graphs with their valences."""
    made = parts(spark, d).select("p_partkey", F.expr(smiles_sql(way)).alias("smiles"))
    return made.withColumn("g", G.parse(F.col("smiles"))).withColumn("v", G.valences(F.col("g")))


def graph_sql(made: str = f"SELECT p_partkey AS id, {smiles_sql()} AS smiles FROM part") -> str:
    """CTEs: made (id, smiles), codes (id, code), atoms, bonds; those of structures with errors are left out."""
    element = "|".join(sorted(G.ELEMENTS, key=len, reverse=True)) + "|" + "|".join(sorted(G.AROMATIC, key=len, reverse=True)) + r"|\*"
    aromatic = ", ".join(f"'{x}'" for x in G.AROMATIC)
    return rf"""
WITH made AS ({made}),
tok AS (SELECT id, unnest(l) AS t, CAST(unnest(range(0, len(l))) AS INTEGER) AS i FROM (SELECT id, regexp_extract_all(trim(smiles), '{G.TOKEN}') AS l FROM made)),
kinds AS (
  SELECT id, i, t, CASE WHEN t IN ('(', ')', '.') THEN t WHEN t IN ('-', '=', '#', '$', ':', '/', '\') THEN 'b' WHEN regexp_full_match(t, '\d|%\d\d') THEN 'r' WHEN regexp_full_match(t, '{G.ATOM}') THEN 'a' ELSE 'x' END AS k FROM tok
), deep AS (SELECT *, sum(CASE k WHEN '(' THEN 1 WHEN ')' THEN -1 ELSE 0 END) OVER (PARTITION BY id ORDER BY i) AS depth, row_number() OVER (PARTITION BY id, k ORDER BY i) - 1 AS n, lag(k) OVER w AS k1, lag(t) OVER w AS t1 FROM kinds WINDOW w AS (PARTITION BY id ORDER BY i)),
cand AS (SELECT c.id, c.i, c.k, c.n, c.depth, coalesce((SELECT min(m.i) FROM deep m WHERE m.id = c.id AND m.i > c.i AND m.depth < c.depth), 1000000000) AS until_ FROM deep c WHERE c.k IN ('a', '.')),
prior AS (SELECT x.id, x.i, x.k, x.n, x.t, CASE WHEN x.k1 = 'b' THEN CASE WHEN x.t1 IN ('/', '\') THEN '-' ELSE x.t1 END ELSE '' END AS o, arg_max(CASE WHEN c.k = 'a' THEN c.n ELSE -1 END, c.i) AS prev
  FROM deep x LEFT JOIN cand c ON c.id = x.id AND c.i < x.i AND c.depth <= x.depth AND x.i < c.until_ WHERE x.k IN ('a', 'r') GROUP BY ALL),
rings AS (SELECT *, row_number() OVER (PARTITION BY id, l ORDER BY i) - 1 AS turn FROM (SELECT *, lpad(replace(t, '%', ''), 2, '0') AS l FROM prior WHERE k = 'r')),
closed AS (SELECT x.id, x.prev AS a, y.prev AS b, x.o AS o1, y.o AS o2, x.i AS pa, y.i AS pb FROM rings x JOIN rings y ON x.id = y.id AND x.l = y.l AND x.turn % 2 = 0 AND y.turn = x.turn + 1),
drawn AS (SELECT id, prev AS a, n AS b, o, i AS pa, i AS pb FROM prior WHERE k = 'a' AND prev >= 0 UNION ALL SELECT id, a, b, CASE WHEN o2 <> '' THEN o2 ELSE o1 END, pa, pb FROM closed),
shape AS (SELECT id, string_agg(k, '' ORDER BY i) AS s, min(depth) AS low, arg_max(depth, i) AS last FROM deep GROUP BY id),
wrong AS (
  SELECT id FROM shape WHERE low < 0 OR last <> 0 OR regexp_matches(s, 'x|^[^a]|[b.(]$|b[^ar]|\([^ab.]|\.[^a]')
  UNION SELECT id FROM rings GROUP BY id, l HAVING count(*) % 2 = 1
  UNION SELECT id FROM closed WHERE a = b OR (o1 <> '' AND o2 <> '' AND o1 <> o2)
  UNION SELECT id FROM drawn GROUP BY id, least(a, b), greatest(a, b) HAVING count(*) > 1
), codes AS (SELECT id, CASE WHEN trim(smiles) = '' THEN 'ERR_EMPTY' WHEN id IN (SELECT id FROM wrong) THEN 'ERR_SYNTAX' END AS code FROM made),
raw AS (SELECT id, n, t, i AS place, starts_with(t, '[') AS inside, CASE WHEN starts_with(t, '[') THEN regexp_extract(t, '^\[\d*({element})', 1) ELSE t END AS name, CASE WHEN starts_with(t, '[') THEN regexp_extract(t, '([+-]\d+|\++|-+)(?::\d+)?\]$', 1) ELSE '' END AS signs,
  CASE WHEN starts_with(t, '[') THEN regexp_extract(t, '[^\[\d](H\d*)(?:[+-].*)?(?::\d+)?\]$', 1) ELSE '' END AS held FROM prior WHERE k = 'a' AND id IN (SELECT id FROM codes WHERE code IS NULL)),
atoms AS (SELECT id, n, upper(name[1]) || name[2:] AS element, name IN ({aromatic}) AS aromatic, (CASE WHEN signs LIKE '-%' THEN -1 ELSE 1 END) * CASE WHEN regexp_matches(signs, '\d') THEN CAST(regexp_replace(signs, '[+-]', '', 'g') AS INTEGER) ELSE length(signs) END AS charge,
  CASE WHEN inside THEN CASE held WHEN '' THEN 0 WHEN 'H' THEN 1 ELSE CAST(held[2:] AS INTEGER) END END AS hydrogens, CASE WHEN inside THEN coalesce(TRY_CAST(regexp_extract(t, '^\[(\d*)', 1) AS INTEGER), 0) ELSE 0 END AS isotope FROM raw),
bonds AS (SELECT d.id, a, b, CASE WHEN o <> '' THEN o WHEN x.aromatic AND y.aromatic THEN ':' ELSE '-' END AS o FROM drawn d JOIN atoms x ON x.id = d.id AND x.n = a JOIN atoms y ON y.id = d.id AND y.n = b),
ends AS (SELECT id, a AS n, b AS other, o FROM bonds UNION ALL SELECT id, b, a, o FROM bonds)"""


_MOVED = " ".join(f"WHEN element = '{e}' AND charge = {q} THEN '{r[r.index(e) - q]}'" for r in G.ROWS for e in r for q in range(-4, 5) if q and 0 <= r.index(e) - q <= 4)
_FREE = ", ".join(f"'{x}'" for x in [*G.VALENCES, *G.COUNTERIONS, "*"])
#: Further CTEs: what each atom uses, its hydrogens and whether that is allowed; codes with the valence gate's.
VALENCE_SQL = rf""", sums AS (SELECT a.*, coalesce(s.sigma, 0) AS sigma, coalesce(s.multiple, FALSE) AS multiple FROM atoms a LEFT JOIN (SELECT id, n, sum(CASE o WHEN '=' THEN 2 WHEN '#' THEN 3 WHEN '$' THEN 4 ELSE 1 END) AS sigma, bool_or(o IN ('=', '#')) AS multiple FROM ends GROUP BY 1, 2) s USING (id, n)),
used AS (SELECT *, sigma + CASE WHEN aromatic AND ((element IN ('C', 'Si') AND charge = 0 AND NOT multiple) OR (element IN ('N', 'P', 'As') AND (charge = 1 OR (charge = 0 AND sigma + coalesce(hydrogens, 0) = 2))) OR (element IN ('O', 'S', 'Se', 'Te') AND charge = 1)) THEN 1 ELSE 0 END AS used,
  CASE WHEN element = 'H' OR charge = 0 THEN element {_MOVED} END AS twin FROM sums),
dim(element, v) AS (VALUES {", ".join(f"('{e}', {v})" for e, vs in G.VALENCES.items() for v in vs)}),
allowed AS (SELECT u.id, u.n, CASE WHEN u.element = 'H' THEN 1 - abs(u.charge) ELSE coalesce(d.v, 0) END AS v FROM used u LEFT JOIN dim d ON d.element = u.twin WHERE u.element IN (SELECT element FROM dim)),
most AS (SELECT u.id, u.n, max(v) AS greatest_, min(v) FILTER (v >= used) AS enough FROM used u JOIN allowed USING (id, n) GROUP BY 1, 2),
filled AS (SELECT u.*, CASE WHEN hydrogens IS NULL THEN coalesce(enough - used, 0) ELSE hydrogens END AS h, CASE WHEN greatest_ IS NULL THEN TRUE WHEN hydrogens IS NULL THEN enough IS NOT NULL ELSE used + hydrogens <= greatest_ END AS ok FROM used u LEFT JOIN most USING (id, n)),
metal AS (SELECT DISTINCT id FROM atoms WHERE element NOT IN ({_FREE})),
gated AS (SELECT id, coalesce(code, CASE WHEN id IN (SELECT id FROM filled WHERE NOT ok) AND id NOT IN (SELECT id FROM metal) THEN 'ERR_VALENCE' END) AS code FROM codes),
counts AS (SELECT id, e, CAST(sum(c) AS INTEGER) AS c FROM (SELECT id, element AS e, 1 AS c FROM filled UNION ALL SELECT id, 'H', h FROM filled WHERE h > 0) GROUP BY 1, 2),
formulas AS (SELECT id, string_agg(e || CASE WHEN c > 1 THEN CAST(c AS VARCHAR) ELSE '' END, '' ORDER BY CASE WHEN carbon AND e = 'C' THEN '0' WHEN carbon AND e = 'H' THEN '1' ELSE '2' || e END) AS atoms_ FROM (SELECT *, bool_or(e = 'C') OVER (PARTITION BY id) AS carbon FROM counts) GROUP BY 1),
charges AS (SELECT id, CAST(sum(charge) AS INTEGER) AS q FROM atoms GROUP BY 1)"""


@query(graph_sql() + """ SELECT p_partkey, code, coalesce(na, 0) AS n_atoms, coalesce(nb, 0) AS n_bonds, coalesce(bonds_, '') AS bonds, coalesce(atoms_, '') AS atoms FROM (SELECT id AS p_partkey, code FROM codes)
LEFT JOIN (SELECT id AS p_partkey, CAST(count(*) AS INTEGER) AS na, string_agg(element || CASE WHEN aromatic THEN '~' ELSE '' END || CASE WHEN charge < 0 THEN '' ELSE '+' END || charge || coalesce('H' || hydrogens, '') || CASE WHEN isotope > 0 THEN '^' || isotope ELSE '' END, ' ' ORDER BY n) AS atoms_ FROM atoms GROUP BY 1) USING (p_partkey)
LEFT JOIN (SELECT id AS p_partkey, CAST(count(*) AS INTEGER) AS nb, string_agg(x || o || y, ' ' ORDER BY x, y) AS bonds_ FROM (SELECT id, least(a, b) AS x, greatest(a, b) AS y, o FROM bonds) GROUP BY 1) USING (p_partkey)""")
def q_parse_graph(spark, d):
    g = F.col("g")
    pairs = F.array_sort(F.transform(g["bonds"], lambda b: F.struct(F.least(b["a"], b["b"]).alias("x"), F.greatest(b["a"], b["b"]).alias("y"), b["o"].alias("o"))))
    said = F.transform(g["atoms"], lambda a: F.concat(a["element"], F.when(a["aromatic"], "~").otherwise(""), F.format_string("%+d", a["charge"]), F.coalesce(F.concat(F.lit("H"), a["hydrogens"].cast("string")), F.lit("")), F.when(a["isotope"] > 0, F.concat(F.lit("^"), a["isotope"].cast("string"))).otherwise("")))
    made = parts(spark, d).select("p_partkey", G.parse(F.expr(smiles_sql())).alias("g"))
    return made.select("p_partkey", "g.code", F.size("g.atoms").alias("n_atoms"), F.size("g.bonds").alias("n_bonds"), F.array_join(F.transform(pairs, lambda p: F.concat(p["x"].cast("string"), p["o"], p["y"].cast("string"))), " ").alias("bonds"), F.array_join(said, " ").alias("atoms"))


def _rows(spark, d) -> DataFrame:
    return parts(spark, d).select(F.col("p_partkey").alias("seq"), F.format_string("P%d", "p_partkey").alias("input_id"), F.expr(smiles_sql()).alias("raw_smiles"))


_GIVEN = f"given AS (SELECT p_partkey AS seq, 'P' || p_partkey AS input_id, {smiles_sql()} AS raw_smiles FROM part)"


@query(graph_sql() + f", {_GIVEN} SELECT (SELECT count(*) FROM codes) AS total, (SELECT count(*) FROM codes WHERE code IS NOT NULL) AS n_invalid, (SELECT string_agg(input_id || ' ' || raw_smiles, ', ' ORDER BY seq) FROM (SELECT * FROM given ORDER BY seq LIMIT 5)) AS head")
def q_preview_head(spark, d):
    said = F.array_join(F.transform("head", lambda h: F.concat(h["input_id"], F.lit(" "), h["raw_smiles"])), ", ")
    return ingest.preview(_rows(spark, d)).withColumn("head", said)


@query(graph_sql() + f", {_GIVEN} SELECT seq, input_id, raw_smiles, code FROM given JOIN codes ON id = seq WHERE code IS NOT NULL")
def q_invalid_rows(spark, d):
    return ingest.invalid(_rows(spark, d))


@query(graph_sql() + VALENCE_SQL + """ SELECT p_partkey, code, excluded, CASE WHEN atoms_ IS NULL THEN '' ELSE atoms_ || CASE WHEN q = 0 THEN '' ELSE CASE WHEN q > 0 THEN '+' ELSE '-' END || CASE WHEN abs(q) > 1 THEN CAST(abs(q) AS VARCHAR) ELSE '' END END END AS formula, hydrogens
FROM (SELECT g.id AS p_partkey, code, g.id IN (SELECT id FROM metal) AS excluded, atoms_, q, coalesce(hh, 0) AS hydrogens FROM gated g LEFT JOIN formulas USING (id) LEFT JOIN charges USING (id) LEFT JOIN (SELECT id, CAST(sum(h) AS INTEGER) AS hh FROM filled GROUP BY 1) USING (id))""")
def q_valence_gate(spark, d):
    g, v = F.col("g"), F.col("v")
    return structured(spark, d).select("p_partkey", G.valence_code(g, v).alias("code"), G.excluded(g).alias("excluded"), G.formula(g, v).alias("formula"), F.aggregate(v, F.lit(0), lambda n, x: n + x["hydrogens"]).alias("hydrogens"))


_DEGREE = "deg AS (SELECT id, n, count(*) AS d FROM ends GROUP BY 1, 2)"
_CARBON = "SELECT a.id, a.n AS c FROM atoms a JOIN deg d USING (id, n) WHERE a.element = 'C' AND a.charge = 0 AND d.d = 3"
_OXYGEN = "SELECT e.id, e.n AS c, e.other AS o_, e.o, x.charge, d.d FROM ends e JOIN atoms x ON x.id = e.id AND x.n = e.other JOIN deg d ON d.id = x.id AND d.n = x.n WHERE x.element = 'O'"
#: Two carbons in the middle with a hydroxyl each, acids at both ends; a match and its mirror image are one set of atoms.
_TARTRATE = """acids AS (SELECT t.id, t.c, x.o_ AS o1, y.o_ AS o2 FROM carbons t JOIN oxygens x ON x.id = t.id AND x.c = t.c AND x.o = '=' JOIN oxygens y ON y.id = t.id AND y.c = t.c AND y.o = '-' AND y.o_ <> x.o_),
cores AS (SELECT t.id, t.c, x.o_ FROM carbons t JOIN oxygens x ON x.id = t.id AND x.c = t.c AND x.o = '-' AND x.charge = 0 AND x.d = 1),
halves AS (SELECT m.id, m.c, m.o_, p.c AS pc, p.o1, p.o2 FROM cores m JOIN ends e ON e.id = m.id AND e.n = m.c AND e.o = '-' JOIN acids p ON p.id = m.id AND p.c = e.other),
tartrate AS (SELECT DISTINCT x.id, list_sort([x.c, x.o_, x.pc, x.o1, x.o2, y.c, y.o_, y.pc, y.o1, y.o2]) AS m FROM halves x JOIN ends e ON e.id = x.id AND e.n = x.c AND e.o = '-' JOIN halves y ON y.id = x.id AND y.c = e.other WHERE len(list_distinct([x.c, x.o_, x.pc, x.o1, x.o2, y.c, y.o_, y.pc, y.o1, y.o2])) = 10)"""
_ALKALI = "alkali AS (SELECT DISTINCT b.id, least(b.n, b.other) AS x, greatest(b.n, b.other) AS y FROM ends b JOIN atoms m ON m.id = b.id AND m.n = b.n JOIN atoms h ON h.id = b.id AND h.n = b.other WHERE b.o = '-' AND m.element IN ('Li', 'Na', 'K') AND m.charge = 0 AND h.element IN ('N', 'O') AND h.charge = 0)"
_COUNTED = "SELECT c.id AS p_partkey, CAST(coalesce(a.k, 0) AS INTEGER) AS alkali, CAST(coalesce(t.k, 0) AS INTEGER) AS tartrate FROM codes c LEFT JOIN (SELECT id, count(*) AS k FROM alkali GROUP BY 1) a USING (id) LEFT JOIN (SELECT id, count(*) AS k FROM tartrate GROUP BY 1) t USING (id)"


@query(graph_sql() + f", {_DEGREE}, carbons AS ({_CARBON}), oxygens AS ({_OXYGEN}), {_ALKALI}, {_TARTRATE} {_COUNTED}")
def q_pattern_counts(spark, d):
    g = parts(spark, d).select("p_partkey", G.parse(F.expr(smiles_sql())).alias("g"))
    return g.select("p_partkey", G.count_matches(F.col("g"), G.ALKALI).alias("alkali"), G.count_matches(F.col("g"), G.TARTRATE).alias("tartrate"))


_BOTH = f"SELECT 2 * p_partkey AS id, {smiles_sql(0)} AS smiles FROM part UNION ALL SELECT 2 * p_partkey + 1, {smiles_sql(1)} FROM part"
#: Colours refined by joins with the neighbours', more rounds than any structure here has atoms in a row.
_ROUNDS = 24
_COLOURS = "c0 AS (SELECT id, n, md5(element || '/' || charge || '/' || h || '/' || isotope) AS c FROM filled)" + "".join(
    f", c{r + 1} AS (SELECT x.id, x.n, md5(any_value(x.c) || coalesce(string_agg(e.o || y.c, ',' ORDER BY e.o || y.c), '')) AS c FROM c{r} x LEFT JOIN ends e ON e.id = x.id AND e.n = x.n LEFT JOIN c{r} y ON y.id = e.id AND y.n = e.other GROUP BY 1, 2)" for r in range(_ROUNDS)
)


@query(graph_sql(_BOTH) + VALENCE_SQL + f", {_COLOURS}, keys AS (SELECT id, string_agg(c, ',' ORDER BY c) AS k FROM c{_ROUNDS} GROUP BY 1) SELECT m.id // 2 AS p_partkey, CAST(m.id % 2 AS INTEGER) AS writing, min(m.id // 2) OVER (PARTITION BY coalesce(k, CAST(m.id AS VARCHAR))) AS class_id FROM made m LEFT JOIN keys USING (id) WHERE k IS NOT NULL")
def q_canonical_class(spark, d):
    key, size = F.col("p_partkey"), table(spark, d, "part").select("p_partkey", "p_size")
    both = size.select(key, F.posexplode(F.array(*(F.expr(smiles_sql(way)) for way in (0, 1)))).alias("writing", "smiles"))
    # A listing is dear: each spelling's is worked out once, and classes are told by spellings, not by rows.
    spelled = held(structures.each_once(both, "smiles", F.min("p_partkey").alias("least")), "g", G.parse(F.col("smiles"))).where("g.code is null")
    listed = spelled.withColumn("v", G.valences(F.col("g"))).select("smiles", "least", G.listing(F.col("g"), F.col("v")).alias("l"))
    # Chiral marks are left out: backwards, some parts are written without.
    known = listed.select("smiles", "least", F.md5(F.concat_ws("|", "l.skeleton", "l.labels", F.regexp_replace("l.marks", "[LR]", ""))).alias("key"))
    classes = known.select("smiles", F.min("least").over(Window.partitionBy("key")).alias("class_id"))
    return both.join(classes, "smiles").select("p_partkey", "writing", "class_id")


def structure_records(spark, d) -> DataFrame:
    given = parts(spark, d).select(F.col("p_partkey").alias("seq"), F.col("p_partkey").cast("string").alias("input_id"), F.expr(smiles_sql()).alias("raw_smiles"), F.col("p_brand").alias("annotation"))
    return structures.curate_structures(given, structures.Limits(max_weight=300.0, max_heavy_atoms=20))


_LISTED = ", ".join(f"'{x}'" for x in structures.LISTED)
_PARENTS = rf"""SELECT id, smiles, frags, list_sort(list_distinct(CASE WHEN len(kept) > 0 THEN kept ELSE frags END)) AS stay FROM (
  SELECT *, list_filter(frags, lambda x: x NOT IN ({_LISTED})) AS kept FROM (SELECT p_partkey AS id, trim({smiles_sql()}) AS smiles, string_split(regexp_replace(trim({smiles_sql()}), '\[\d+([A-Za-z])', '[\1', 'g'), '.') AS frags FROM part))"""
_WEIGHTS = ", ".join(f"('{e}', {w})" for e, w in WEIGHTS.items())
_RECORDS = (
    graph_sql(f"SELECT 2 * id AS id, smiles FROM ({_PARENTS}) UNION ALL SELECT 2 * id + 1, array_to_string(stay, '.') FROM ({_PARENTS})")
    + VALENCE_SQL
    + rf""", parents AS ({_PARENTS}), wt(e, w) AS (VALUES {_WEIGHTS}),
measured AS (SELECT id, round(sum(CAST(w AS DOUBLE) * c), 6) AS mw, CAST(coalesce(sum(c) FILTER (e <> 'H'), 0) AS INTEGER) AS heavy FROM counts LEFT JOIN wt USING (e) GROUP BY 1),
chosen AS (SELECT p.*, g.code AS given_code, 2 * p.id IN (SELECT id FROM metal) AS excluded, CASE WHEN 2 * p.id IN (SELECT id FROM metal) THEN 2 * p.id ELSE 2 * p.id + 1 END AS pid FROM parents p JOIN gated g ON g.id = 2 * p.id),
changed AS (SELECT p, string_agg(CASE WHEN d > 0 THEN '+' ELSE '-' END || e || abs(d), ' ' ORDER BY e) AS delta FROM (SELECT p, e, CAST(sum(d) AS INTEGER) AS d FROM (SELECT h.id AS p, e, c AS d FROM chosen h JOIN counts n ON n.id = h.pid UNION ALL SELECT h.id, e, -c FROM chosen h JOIN counts n ON n.id = 2 * h.id) GROUP BY 1, 2) WHERE d <> 0 GROUP BY 1),
gone AS (SELECT id, string_agg(x, '.' ORDER BY x) AS removed FROM (SELECT id, x, stay, row_number() OVER (PARTITION BY id, x) AS turn FROM (SELECT id, stay, unnest(frags) AS x FROM parents)) WHERE turn > CASE WHEN list_contains(stay, x) THEN 1 ELSE 0 END GROUP BY 1),
judged AS (SELECT h.*, mw, heavy, CASE WHEN given_code IS NOT NULL THEN given_code WHEN NOT excluded AND v.code IS NOT NULL THEN 'ERR_VALENCE' WHEN mw > 300 THEN 'ERR_MW_LIMIT' WHEN heavy > 20 THEN 'ERR_HA_LIMIT' END AS code FROM chosen h JOIN gated v ON v.id = h.pid LEFT JOIN measured m ON m.id = h.pid)
SELECT CAST(j.id AS VARCHAR) AS input_id, CASE WHEN code IS NULL THEN 'PASSED' ELSE 'REJECTED' END AS status, code AS rejection_code, CASE WHEN code IN ('ERR_EMPTY', 'ERR_SYNTAX') THEN 'PARSE' WHEN code = 'ERR_VALENCE' THEN 'VALENCE_GATE' WHEN code IS NOT NULL THEN 'ELIGIBILITY' END AS rejection_stage,
  CASE WHEN code IS NULL THEN CASE WHEN excluded THEN smiles ELSE array_to_string(stay, '.') END END AS curated_smiles, CASE WHEN code IS NULL AND NOT excluded THEN removed END AS removed_fragments,
  CASE WHEN code IS NULL THEN coalesce(b.q, 0) - coalesce(a.q, 0) ELSE 0 END AS delta_net_charge, CASE WHEN code IS NULL THEN coalesce(delta, '') ELSE '' END AS delta_formula,
  CASE WHEN code IS NULL OR code LIKE '%LIMIT' THEN mw END AS parent_mw, CASE WHEN code IS NULL OR code LIKE '%LIMIT' THEN CAST(heavy AS DOUBLE) END AS parent_heavy_atoms, code IS NULL AND excluded AS excluded_flag,
  CASE WHEN code IS NULL THEN CAST(CASE WHEN excluded THEN len(string_split(smiles, '.')) ELSE len(stay) END AS INTEGER) ELSE 0 END AS n_components_parent
FROM judged j LEFT JOIN charges a ON a.id = 2 * j.id LEFT JOIN charges b ON b.id = j.pid LEFT JOIN changed c ON c.p = j.id LEFT JOIN gone x ON x.id = j.id"""
)


@query(_RECORDS)
def q_structure_records(spark, d):
    return structure_records(spark, d).select("input_id", "status", "rejection_code", "rejection_stage", "curated_smiles", "removed_fragments", "delta_net_charge", "delta_formula", "parent_mw", F.col("parent_heavy_atoms").cast("double").alias("parent_heavy_atoms"), "excluded_flag", "n_components_parent")


#: A policy with hooks at every place: salts of acids written as acids, one isotope refused, bromides at the end taken for chlorides, long structures reported.
_LONG, _SALT, _ACID, _REFUSED = 12, "C(=O)[O-].[Na+]", "C(=O)O", "[13CH2]"
HOOKS = structures.Hooks(
    standardize=lambda s: F.when(~s.contains(_REFUSED), F.replace(s, F.lit(_SALT), F.lit(_ACID))),
    parent_transform=lambda s: F.when(s.endswith("Br"), F.concat(F.left(s, F.length(s) - 2), F.lit("Cl"))),
    probes=(structures.Probe("long_structure", lambda before, after, stage: F.when(F.size(after["graph"]["atoms"]) > _LONG, F.size(after["graph"]["atoms"]).cast("string"))),),
)


def _hooked_sql() -> str:
    """The SQL of records with standardized structures for given ones, and parents as the hook rewrites them."""
    head, _, tail = _RECORDS.partition("SELECT CAST(j.id AS VARCHAR) AS input_id")
    changed = "regexp_replace(array_to_string(stay, '.'), 'Br$', 'Cl')"
    head = head.replace(smiles_sql(), f"replace({smiles_sql()}, '{_SALT}', '{_ACID}')").replace("array_to_string(stay, '.')", changed)
    malformed = "given_code IN ('ERR_EMPTY', 'ERR_SYNTAX')"
    head = head.replace("CASE WHEN given_code IS NOT NULL", f"CASE WHEN {malformed} THEN given_code WHEN NOT excluded AND contains(smiles, '{_REFUSED}') THEN 'ERR_STANDARDIZE' WHEN given_code IS NOT NULL")
    long = lambda i: f"CASE WHEN (SELECT count(*) FROM atoms WHERE atoms.id = {i}) > {_LONG} THEN 1 ELSE 0 END"
    return head + f"""SELECT 'P' || j.id AS input_id, CASE WHEN code IS NULL THEN 'PASSED' ELSE 'REJECTED' END AS status, code AS rejection_code,
  CASE WHEN code IN ('ERR_EMPTY', 'ERR_SYNTAX') THEN 'PARSE' WHEN code = 'ERR_STANDARDIZE' THEN 'STANDARDIZE' WHEN code = 'ERR_VALENCE' THEN 'VALENCE_GATE' WHEN code IS NOT NULL THEN 'ELIGIBILITY' END AS rejection_stage,
  CASE WHEN code IS NULL THEN CASE WHEN excluded THEN smiles ELSE {changed} END END AS curated_smiles, CASE WHEN code IS NULL OR code LIKE '%LIMIT' THEN mw END AS parent_mw,
  CASE WHEN coalesce({malformed} OR code = 'ERR_STANDARDIZE', FALSE) THEN 0 ELSE {long('2 * j.id')} + {long('j.pid')} END AS n_long FROM judged j"""


@query(_hooked_sql())
def q_hooked_records(spark, d):
    r = structures.curate_structures(_rows(spark, d), structures.Limits(max_weight=300.0, max_heavy_atoms=20), HOOKS)
    return r.select("input_id", "status", "rejection_code", "rejection_stage", "curated_smiles", "parent_mw", F.size(F.filter("transformations", lambda e: e["rule"] == "long_structure")).alias("n_long"))


@query("SELECT input_id, status, rejection_code, coalesce(removed_fragments <> '', FALSE) AS salt_removed, delta_formula FROM (" + _RECORDS + ")")
def q_export_columns(spark, d):
    return export.export(structure_records(spark, d), ("input_id", "status", "rejection_code", "salt_removed", "delta_formula"))

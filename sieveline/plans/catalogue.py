"""The query catalogue: each query over its whole table, with the SQL of the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.functions import structure as S
from sieveline.operators import curate, dedup, gold, report, schema, validate
from sieveline.sources import encoding, ingest

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(df: DataFrame) -> DataFrame:
    """Rows over all cores: a small file is one partition, and each of its keys becomes a formula's or a structure's work."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curate.curate(table(spark, sf_dir, "documents"))


# The documents as records, in SQL.
RECORDS = r"""
WITH base AS (
  SELECT doc_id AS seq, CAST(doc_id AS VARCHAR) AS input_id, coalesce(text, '') AS raw_text, length(coalesce(text, '')) AS n_chars, source AS annotation, lang,
         lower(trim(regexp_replace(coalesce(text, ''), '\s+', ' ', 'g'))) AS norm,
         len(string_split(trim(regexp_replace(coalesce(text, ''), '\s+', ' ', 'g')), ' ')) AS n_words,
         len(string_split(coalesce(text, ''), chr(10))) > len(list_distinct(string_split(coalesce(text, ''), chr(10)))) AS repeats
  FROM documents
), judged AS (
  SELECT *, CASE WHEN n_chars < 40 THEN 'ERR_EMPTY' WHEN n_chars > 5000 THEN 'ERR_MW_LIMIT' WHEN n_words > 1000 THEN 'ERR_HA_LIMIT' END AS rejection_code,
         concat_ws('-', md5(regexp_replace(norm, '[^a-z]', '', 'g')), md5(norm), CASE WHEN right(norm, 1) = '.' THEN 'N' ELSE 'M' END) AS full_key
  FROM base
), records AS (
  SELECT seq, input_id, raw_text, n_chars, n_words, annotation, lang, rejection_code,
         CASE rejection_code WHEN 'ERR_EMPTY' THEN 'PARSE' WHEN 'ERR_MW_LIMIT' THEN 'ELIGIBILITY' WHEN 'ERR_HA_LIMIT' THEN 'ELIGIBILITY' END AS rejection_stage,
         CASE WHEN rejection_code IS NULL THEN 'PASSED' ELSE 'REJECTED' END AS status,
         CASE WHEN rejection_code IS NULL THEN norm END AS curated_text, CASE WHEN rejection_code IS NULL THEN full_key END AS identity,
         CASE WHEN rejection_code IS NULL THEN split_part(full_key, '-', 1) END AS block1,
         CASE WHEN n_chars >= 40 AND norm <> raw_text THEN 1 ELSE 0 END AS ev_norm, CASE WHEN n_chars >= 40 AND repeats THEN 1 ELSE 0 END AS ev_lines
  FROM judged
)"""
STAGES = "stages(stage, ordinal) AS (VALUES " + ", ".join(f"('{s}', {i})" for i, s in enumerate(schema.STAGES)) + ")"
FUNNEL = f"""{RECORDS}, {STAGES}, gone AS (SELECT rejection_stage AS stage, count(*) AS n FROM records WHERE status = 'REJECTED' GROUP BY 1),
steps AS (SELECT stage, ordinal, coalesce(n, 0) AS n_excluded, (SELECT count(*) FROM records) - coalesce(sum(coalesce(n, 0)) OVER (ORDER BY ordinal ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS n_input FROM stages LEFT JOIN gone USING (stage)),
funnel AS (SELECT stage, CAST(ordinal AS INTEGER) AS ordinal, CAST(n_input AS BIGINT) AS n_input, CAST(n_input - n_excluded AS BIGINT) AS n_output, CAST(n_excluded AS BIGINT) AS n_excluded,
 CASE WHEN n_input = 0 THEN 'SKIPPED' WHEN n_input = n_excluded THEN 'FAILED' WHEN n_excluded > 0 THEN 'WARNING' ELSE 'SUCCESS' END AS stage_status FROM steps)"""


def _conflicts_sql(first: bool = True, ann: str = "annotation") -> str:
    same = "first_value(input_id) OVER k" if first else "lag(input_id) OVER k"
    order = "{'k': identity, 's': seq}" if first else "{'k': identity, 's': -seq}"
    e, a, b = dedup.SAYS_EXACT, [x.replace("'", "''") for x in dedup.SAYS_ANNOTATION], dedup.SAYS_BLOCK1
    return f"""{RECORDS}, w AS (
  SELECT *, {ann} AS ann, row_number() OVER k AS rn, {same} AS same_id, first_value({ann}) OVER k AS first_ann,
         min(identity) OVER b AS near_key, arg_min(input_id, {order}) OVER b AS near_id
  FROM records WHERE identity IS NOT NULL
  WINDOW k AS (PARTITION BY block1, identity ORDER BY seq, input_id), b AS (PARTITION BY block1 ORDER BY seq, input_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), typed AS (SELECT *, CASE WHEN rn > 1 THEN CASE WHEN ann <> first_ann THEN 'ANNOTATION_CONFLICT' ELSE 'EXACT_DUPLICATE' END WHEN near_key IS NOT NULL THEN 'BLOCK1_COLLISION' END AS collision_type FROM w),
conflicts AS (SELECT collision_type, input_id AS incoming_id, CASE WHEN rn > 1 THEN same_id ELSE near_id END AS existing_id, identity AS incoming_key, CASE WHEN rn > 1 THEN identity ELSE near_key END AS existing_key, block1,
  CASE collision_type WHEN 'ANNOTATION_CONFLICT' THEN '{a[0]}' || first_ann || '{a[1]}' || ann || '{a[2]}' WHEN 'EXACT_DUPLICATE' THEN '{e}'
   ELSE '{b[0]}' || CASE WHEN split_part(identity, '-', 2) <> split_part(near_key, '-', 2) AND split_part(identity, '-', 3) <> split_part(near_key, '-', 3) THEN '{dedup.SAYS_STEREO} e {dedup.SAYS_PROTON}'
     WHEN split_part(identity, '-', 2) <> split_part(near_key, '-', 2) THEN '{dedup.SAYS_STEREO}' WHEN split_part(identity, '-', 3) <> split_part(near_key, '-', 3) THEN '{dedup.SAYS_PROTON}' ELSE '{dedup.SAYS_NOWHERE}' END || '{b[1]}' END AS detail
  FROM typed WHERE collision_type IS NOT NULL)"""


CONFLICTS = _conflicts_sql()


@query(f"{RECORDS} SELECT input_id, status, rejection_code, rejection_stage, identity, block1, n_chars, CAST(n_words AS INTEGER) AS n_words, CAST(ev_norm + ev_lines AS INTEGER) AS n_events FROM records")
def q_curate_records(spark, d):
    return records(spark, d).select("input_id", "status", "rejection_code", "rejection_stage", "identity", "block1", "n_chars", "n_words", F.size("transformations").alias("n_events"))


@query(f"{RECORDS} SELECT input_id, curated_text, identity, block1 FROM records WHERE status = 'PASSED'")
def q_curated_projection(spark, d):
    return records(spark, d).where("status = 'PASSED'").select("input_id", "curated_text", "identity", "block1")


@query(f"{RECORDS} SELECT input_id, raw_text, rejection_code, rejection_stage FROM records WHERE status = 'REJECTED'")
def q_rejected_projection(spark, d):
    return records(spark, d).where("status = 'REJECTED'").select("input_id", "raw_text", "rejection_code", "rejection_stage")


@query(f"{RECORDS} SELECT input_id, raw_text, coalesce(curated_text, '') AS curated_text, coalesce(identity, '') AS identity, status, coalesce(rejection_code, '') AS rejection_code FROM records")
def q_audit_projection(spark, d):
    e = lambda c: F.coalesce(c, F.lit("")).alias(c)
    return records(spark, d).select("input_id", "raw_text", e("curated_text"), e("identity"), "status", e("rejection_code"))


@query(f"{FUNNEL} SELECT * FROM funnel")
def q_stage_funnel(spark, d):
    return report.funnel(records(spark, d))


@query(f"{FUNNEL} SELECT * FROM funnel WHERE n_excluded > 0 ORDER BY n_excluded DESC, ordinal LIMIT 1")
def q_largest_reduction(spark, d):
    return report.largest_reduction(report.funnel(records(spark, d)))


@query(f"{RECORDS} SELECT count(*) AS total, count(*) FILTER (status = 'PASSED') AS passed, count(*) FILTER (status <> 'PASSED') AS rejected FROM records")
def q_summary(spark, d):
    return report.summary(records(spark, d))


@query(f"{CONFLICTS} SELECT (SELECT count(*) FROM records) AS total, (SELECT count(*) FROM records WHERE status = 'PASSED') AS approved, (SELECT count(*) FROM records WHERE status = 'REJECTED') AS rejected, (SELECT count(*) FROM records WHERE status = 'PASSED' AND ev_norm + ev_lines > 0) AS warnings, (SELECT count(*) FROM conflicts WHERE collision_type <> 'BLOCK1_COLLISION') AS duplicates")
def q_kpis(spark, d):
    r = records(spark, d)
    return report.kpis(r, dedup.collisions(r))


@query(f"{RECORDS} SELECT lang, count(*) AS total, round(count(*) FILTER (status = 'PASSED') / CAST(count(*) AS DOUBLE), 9) AS pass_rate FROM records GROUP BY lang")
def q_pass_rate_by_lang(spark, d):
    return records(spark, d).groupBy("lang").agg(F.count("*").alias("total"), F.round(report.ratio(F.count_if(F.col("status") == "PASSED"), F.count("*")), 9).alias("pass_rate"))


@query(f"{RECORDS} SELECT rejection_code, count(*) AS n FROM records WHERE status = 'REJECTED' GROUP BY 1 ORDER BY n DESC, 1 LIMIT 5")
def q_top_rejections(spark, d):
    return report.top_rejections(records(spark, d))


_EXCLUDED = f"{CONFLICTS}, excluded AS (SELECT rejection_code AS reason, rejection_stage AS stage, input_id FROM records WHERE status = 'REJECTED' UNION ALL SELECT collision_type, 'DEDUPLICATION', incoming_id FROM conflicts WHERE collision_type <> 'BLOCK1_COLLISION')"


@query(f"{_EXCLUDED} SELECT reason, stage, count(*) AS n FROM excluded GROUP BY 1, 2")
def q_exclusion_groups(spark, d):
    r = records(spark, d)
    return report.exclusion_groups(r, dedup.collisions(r))


@query(f"{_EXCLUDED} SELECT * FROM excluded")
def q_excluded_ids(spark, d):
    r = records(spark, d)
    return report.excluded_ids(r, dedup.collisions(r))


@query(f"{CONFLICTS} SELECT * FROM conflicts")
def q_collisions_keep_first(spark, d):
    return dedup.collisions(records(spark, d))


@query(f"{_conflicts_sql(False)} SELECT * FROM conflicts")
def q_collisions_keep_last(spark, d):
    return dedup.collisions(records(spark, d), keep_first=False)


@query(f"{CONFLICTS} SELECT collision_type, count(*) AS n FROM conflicts GROUP BY 1")
def q_collision_counts(spark, d):
    return report.collision_counts(dedup.collisions(records(spark, d)))


@query(f"{_conflicts_sql(ann='(CASE WHEN seq % 3 <> 0 THEN annotation END)')} SELECT incoming_id, existing_id, detail FROM conflicts WHERE collision_type = 'ANNOTATION_CONFLICT'")
def q_annotation_conflicts(spark, d):
    r = records(spark, d).withColumn("annotation", F.when(F.col("seq") % 3 != 0, F.col("annotation")))
    return dedup.collisions(r).where(F.col("collision_type") == dedup.ANNOTATION).select("incoming_id", "existing_id", "detail")


@query(f"{CONFLICTS} SELECT (SELECT count(*) FROM records WHERE status = 'PASSED') AS n_input, (SELECT count(*) FROM records WHERE status = 'PASSED') - count(*) FILTER (collision_type <> 'BLOCK1_COLLISION') AS n_output, count(*) FILTER (collision_type <> 'BLOCK1_COLLISION') AS duplicates, count(*) FILTER (collision_type = 'BLOCK1_COLLISION') AS block1_collisions FROM conflicts")
def q_dedup_report(spark, d):
    r = records(spark, d)
    return report.dedup_report(r, dedup.collisions(r))


@query(f"{RECORDS} SELECT count(DISTINCT identity) AS n_unique FROM records")
def q_unique_identities(spark, d):
    return records(spark, d).agg(F.countDistinct("identity").alias("n_unique"))


@query(f"{RECORDS} SELECT block1, count(DISTINCT identity) AS n_keys, min(identity) AS first_key FROM records WHERE identity IS NOT NULL GROUP BY 1")
def q_block1_groups(spark, d):
    return records(spark, d).where("identity is not null").groupBy("block1").agg(F.countDistinct("identity").alias("n_keys"), F.min("identity").alias("first_key"))


@query(f"{RECORDS} SELECT identity, min(seq) AS first_seq FROM records WHERE identity IS NOT NULL GROUP BY 1")
def q_first_occurrence(spark, d):
    return records(spark, d).where("identity is not null").groupBy("identity").agg(F.min("seq").alias("first_seq"))


@query(f"{RECORDS} SELECT input_id, status FROM records WHERE seq IN (SELECT doc_id FROM labels)")
def q_records_by_id(spark, d):
    return records(spark, d).join(table(spark, d, "labels").select(F.col("doc_id").alias("seq")), "seq", "left_semi").select("input_id", "status")


@query(f"{RECORDS} SELECT input_id, status FROM records WHERE seq NOT IN (SELECT doc_id FROM labels)")
def q_unlabelled(spark, d):
    return records(spark, d).join(table(spark, d, "labels").select(F.col("doc_id").alias("seq")), "seq", "left_anti").select("input_id", "status")


@query(f"{RECORDS} SELECT input_id, status, 0 AS event_no, 'STANDARDIZE' AS stage, 'text_normalized' AS rule FROM records WHERE ev_norm = 1 UNION ALL SELECT input_id, status, CAST(ev_norm AS INTEGER), 'GET_PARENT', 'lines_removed' FROM records WHERE ev_lines = 1")
def q_lineage(spark, d):
    return report.lineage(records(spark, d))


@query(f"{RECORDS} SELECT input_id, status FROM records WHERE ev_lines = 1")
def q_transformed_by_stage(spark, d):
    return report.transformed_at(records(spark, d), "GET_PARENT").select("input_id", "status")


@query(f"{RECORDS} SELECT count(*) AS n_warnings FROM records WHERE status = 'PASSED' AND ev_norm + ev_lines > 0")
def q_warnings(spark, d):
    return records(spark, d).agg(F.count_if((F.col("status") == "PASSED") & (F.size("transformations") > 0)).alias("n_warnings"))


_NODES = FUNNEL + ", " + CONFLICTS.split(", w AS", 1)[1].join([" w AS", ""]) + ", dd AS (SELECT (SELECT count(*) FROM records WHERE status = 'PASSED') AS i, count(*) FILTER (collision_type <> 'BLOCK1_COLLISION') AS x FROM conflicts), nodes AS (SELECT stage, ordinal, n_input, n_output, n_excluded, stage_status AS node_status FROM funnel UNION ALL SELECT 'DEDUPLICATION', 6, i, i - x, x, CASE WHEN i = 0 THEN 'SKIPPED' WHEN i = x THEN 'FAILED' WHEN x > 0 THEN 'WARNING' ELSE 'SUCCESS' END FROM dd)"
_LABEL = "CASE stage " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in schema.LABELS.items()) + " END"


@query(f"{_NODES} SELECT *, {_LABEL} AS label FROM nodes")
def q_graph_nodes(spark, d):
    r = records(spark, d)
    return report.nodes(r, dedup.collisions(r))


@query(f"{_NODES} SELECT CASE WHEN bool_or(node_status = 'FAILED') THEN 'FAILED' WHEN bool_or(node_status = 'WARNING') THEN 'WARNING' WHEN bool_and(node_status = 'SKIPPED') THEN 'SKIPPED' ELSE 'SUCCESS' END AS run_status FROM nodes")
def q_run_status(spark, d):
    r = records(spark, d)
    return report.run_status(report.nodes(r, dedup.collisions(r)))


_ALL = "s(stage, ordinal) AS (VALUES " + ", ".join(f"('{s}', {i})" for i, s in enumerate([*schema.STAGES, schema.DEDUP])) + ")"
_EDGES = f"""{RECORDS.replace('WITH', 'WITH RECURSIVE', 1)}, {_ALL}, reached AS (SELECT annotation, coalesce((SELECT ordinal FROM s WHERE stage = rejection_stage), {len(schema.STAGES)}) AS last FROM records),
edges AS (SELECT annotation, a.stage AS source, b.stage AS target, count(*) AS n FROM reached JOIN s b ON b.ordinal <= last JOIN s a ON a.ordinal + 1 = b.ordinal GROUP BY ALL)"""


@query(f"{_EDGES} SELECT * FROM edges")
def q_graph_edges(spark, d):
    return report.flow_edges(records(spark, d), "annotation")


@query(f"{_EDGES}, r AS (SELECT annotation, source, target AS reachable, 1 AS steps FROM edges UNION SELECT r.annotation, r.source, e.target, steps + 1 FROM r JOIN edges e ON e.annotation = r.annotation AND e.source = r.reachable) SELECT annotation, source, reachable, min(steps) AS steps FROM r GROUP BY ALL")
def q_downstream(spark, d):
    return report.downstream(report.flow_edges(records(spark, d), "annotation"), "annotation")


#: Formulas and structures that parts are tested with, by part key.
FORMULAS = ("C9H8O4", "C2H6O", "C8H9NO2", "C6H5Na2O4P", "C7H5NaO2", "C10H16N5O13P3", "NaCl", "C4H11N5HCl", "C2H5NO2+", "H2O")
SMILES = ("CC(=O)[O-].[Na+]", "N[C@@H](C)C(=O)O.Cl", "CCO", "[NH4+].[Cl-]", "CC(=O)O[Na]", "O.O.CCO", "[13CH4]", "[2H]C(Cl)(Cl)Cl", "Cl.Cl.CCN", "[Cu+2].CC(=O)[O-].CC(=O)[O-]")
_VALUES = lambda items: "(VALUES " + ", ".join(f"({i}, '{x}')" for i, x in enumerate(items)) + ")"


def _with(spark, d, items, name):
    fixture = spark.createDataFrame(list(enumerate(items)), f"k int, {name} string")  # ten rows
    return dealt(table(spark, d, "part").select("p_partkey", "p_size", F.pmod("p_partkey", F.lit(len(items))).cast("int").alias("k"))).join(F.broadcast(fixture), "k")


_PARSED = f"f(k, formula) AS {_VALUES(FORMULAS)}, x AS (SELECT k, formula, unnest(regexp_extract_all(regexp_extract(formula, '^[^+-]*'), '([A-Z][a-z]?)(\\d*)', 1)) AS e, unnest(regexp_extract_all(regexp_extract(formula, '^[^+-]*'), '([A-Z][a-z]?)(\\d*)', 2)) AS c FROM f), n AS (SELECT k, formula, e, CAST(sum(CASE WHEN c = '' THEN 1 ELSE CAST(c AS INTEGER) END) AS INTEGER) AS n FROM x GROUP BY 1, 2, 3)"


@query(f"WITH {_PARSED} SELECT p_partkey, e AS element, n FROM part JOIN n ON p_partkey % {len(FORMULAS)} = k")
def q_formula_parse(spark, d):
    return _with(spark, d, FORMULAS, "formula").select("p_partkey", F.explode(S.parse_formula(F.col("formula"))).alias("element", "n"))


_MEASURED = f"WITH {_PARSED}, wt(e, w) AS (VALUES {', '.join(f'({chr(39)}{k}{chr(39)}, {v})' for k, v in S.WEIGHTS.items())}), m AS (SELECT k, formula, round(sum(CAST(w AS DOUBLE) * n), 6) AS mw, CAST(sum(CASE WHEN e = 'H' THEN 0 ELSE n END) AS INTEGER) AS heavy, CAST(coalesce(sum(n) FILTER (e = 'C'), 0) AS INTEGER) AS carbons FROM n JOIN wt USING (e) GROUP BY 1, 2)"


def _measured(spark, d):
    f = F.col("formula")
    return _with(spark, d, FORMULAS, "formula").select("p_partkey", "p_size", "formula", F.round(S.molecular_weight(f), 6).alias("mw"), S.heavy_atoms(f).alias("heavy"), S.carbons(f).alias("carbons"))


@query(f"{_MEASURED} SELECT p_partkey, formula, mw, heavy, carbons FROM part JOIN m ON p_partkey % {len(FORMULAS)} = k")
def q_mw_ha_carbon(spark, d):
    return _measured(spark, d).drop("p_size")


@query(f"{_MEASURED} SELECT p_partkey, CASE WHEN carbons = 0 THEN 'ERR_NO_CARBON' WHEN mw > 10 * p_size THEN 'ERR_MW_LIMIT' WHEN heavy > p_size THEN 'ERR_HA_LIMIT' ELSE 'OK' END AS verdict FROM part JOIN m ON p_partkey % {len(FORMULAS)} = k")
def q_eligibility(spark, d):
    m = _measured(spark, d)
    v = F.when(F.col("carbons") == 0, "ERR_NO_CARBON").when(F.col("mw") > 10 * F.col("p_size"), "ERR_MW_LIMIT").when(F.col("heavy") > F.col("p_size"), "ERR_HA_LIMIT").otherwise("OK")
    return m.select("p_partkey", v.alias("verdict"))


@query(f"WITH {_PARSED}, pr AS (SELECT a.k, a.formula AS before, b.formula AS after FROM f a JOIN f b ON b.k = (a.k + 1) % {len(FORMULAS)}), dl AS (SELECT pr.k, e, coalesce((SELECT n FROM n WHERE n.k = (pr.k + 1) % {len(FORMULAS)} AND n.e = q.e), 0) - coalesce((SELECT n FROM n WHERE n.k = pr.k AND n.e = q.e), 0) AS d FROM pr JOIN (SELECT DISTINCT e FROM n) q ON TRUE) SELECT p_partkey, coalesce((SELECT string_agg(CASE WHEN d > 0 THEN '+' ELSE '-' END || e || CAST(abs(d) AS VARCHAR), ' ' ORDER BY e) FROM dl WHERE dl.k = p_partkey % {len(FORMULAS)} AND d <> 0), '') AS delta FROM part")
def q_formula_delta(spark, d):
    n = len(FORMULAS)
    pairs = spark.createDataFrame([(i, FORMULAS[i], FORMULAS[(i + 1) % n]) for i in range(n)], "k int, before string, after string")
    parts = dealt(table(spark, d, "part").select("p_partkey", F.pmod("p_partkey", F.lit(n)).cast("int").alias("k")))
    return parts.join(F.broadcast(pairs), "k").select("p_partkey", S.formula_delta(F.col("before"), F.col("after")).alias("delta"))


_S = f"WITH s(k, smiles) AS {_VALUES(SMILES)}"


@query(f"{_S} SELECT p_partkey, array_to_string(list_sort(string_split(smiles, '.')), '|') AS parts, CAST(len(string_split(smiles, '.')) AS INTEGER) AS n_parts FROM part JOIN s ON p_partkey % {len(SMILES)} = k")
def q_fragments_sorted(spark, d):
    f = S.fragments(F.col("smiles"))
    return _with(spark, d, SMILES, "smiles").select("p_partkey", F.array_join(f, "|").alias("parts"), F.size(f).alias("n_parts"))


_C = "list_transform(range(1, len(regexp_extract_all(smiles, '\\[[^\\]+-]*([+-]+)(\\d*)[^\\]]*\\]', 1)) + 1), lambda i: (CASE WHEN regexp_extract_all(smiles, '\\[[^\\]+-]*([+-]+)(\\d*)[^\\]]*\\]', 2)[i] = '' THEN length(regexp_extract_all(smiles, '\\[[^\\]+-]*([+-]+)(\\d*)[^\\]]*\\]', 1)[i]) ELSE CAST(regexp_extract_all(smiles, '\\[[^\\]+-]*([+-]+)(\\d*)[^\\]]*\\]', 2)[i] AS INTEGER) END) * (CASE WHEN left(regexp_extract_all(smiles, '\\[[^\\]+-]*([+-]+)(\\d*)[^\\]]*\\]', 1)[i], 1) = '+' THEN 1 ELSE -1 END))"


@query(f"{_S} SELECT p_partkey, CAST(coalesce(list_sum({_C}), 0) AS INTEGER) AS charge, regexp_replace(smiles, '\\[\\d+([A-Za-z])', '[\\1', 'g') AS plain FROM part JOIN s ON p_partkey % {len(SMILES)} = k")
def q_net_charge_isotopes(spark, d):
    s = F.col("smiles")
    return _with(spark, d, SMILES, "smiles").select("p_partkey", S.net_charge(s).alias("charge"), S.strip_isotopes(s).alias("plain"))


_KEPT = "CASE WHEN len(list_filter(string_split(smiles, '.'), lambda x: x NOT IN ('Cl', 'O', '[Na+]', '[Cl-]'))) > 0 THEN list_sort(list_filter(string_split(smiles, '.'), lambda x: x NOT IN ('Cl', 'O', '[Na+]', '[Cl-]'))) ELSE list_sort(string_split(smiles, '.')) END"


@query(f"{_S} SELECT p_partkey, array_to_string({_KEPT}, '.') AS parent, CASE WHEN len(list_filter(string_split(smiles, '.'), lambda x: x NOT IN ('Cl', 'O', '[Na+]', '[Cl-]'))) > 0 AND len(list_filter(string_split(smiles, '.'), lambda x: x IN ('Cl', 'O', '[Na+]', '[Cl-]'))) > 0 THEN array_to_string(list_sort(list_filter(string_split(smiles, '.'), lambda x: x IN ('Cl', 'O', '[Na+]', '[Cl-]'))), '.') END AS removed FROM part JOIN s ON p_partkey % {len(SMILES)} = k")
def q_salt_guard(spark, d):
    listed = F.array(*map(F.lit, ("Cl", "O", "[Na+]", "[Cl-]")))
    parent = F.array_join(S.keep_unless_all(S.fragments(F.col("smiles")), listed), ".")
    return _with(spark, d, SMILES, "smiles").withColumn("parent", parent).select("p_partkey", "parent", S.removed_fragments(F.col("smiles"), F.col("parent")).alias("removed"))


def _probes_sql() -> str:
    charge = lambda c: f"CAST(coalesce(list_sum({_C.replace('smiles', c)}), 0) AS INTEGER)"
    bound = lambda c: f"len(regexp_extract_all({c}, '[NO]\\[(?:Li|Na|K)\\]|\\[(?:Li|Na|K)\\][NO]'))"
    signed = lambda c: f"CASE WHEN {c} < 0 THEN '' ELSE '+' END || {c}"
    listed = "('Cl', 'O', '[Na+]', '[Cl-]')"
    rules = (
        ("alkali_metal_ionized", "nb > na", "nb || ' -> ' || na"),
        ("alkali_metal_residual", "na > 0", "CAST(na AS VARCHAR)"),
        ("tartrate_flattened", "regexp_matches(b, 'OC\\(=O\\)\\[C@+H?\\]\\(O\\)\\[C@+H?\\]\\(O\\)C\\(=O\\)O') AND sb > sa", "sb || ' -> ' || sa"),
        ("net_charge_changed", "cb <> ca", f"{signed('cb')} || ' -> ' || {signed('ca')}"),
        ("fragments_removed", "fa < fb", f"array_to_string(list_sort(list_filter(string_split(b, '.'), lambda x: x IN {listed})), '.')"),
        ("fragments_split", "fa > fb", "fb || ' -> ' || fa"),
    )
    events = " UNION ALL ".join(f"SELECT k, '{name}' AS rule, b, a, {detail} AS detail FROM m WHERE {when}" for name, when, detail in rules)
    measured = f"SELECT k, b, a, {bound('b')} AS nb, {bound('a')} AS na, {charge('b')} AS cb, {charge('a')} AS ca, len(string_split(b, '.')) AS fb, len(string_split(a, '.')) AS fa, len(regexp_extract_all(b, '@+')) AS sb, len(regexp_extract_all(a, '@+')) AS sa FROM p"
    return f"{_S}, p AS (SELECT k, smiles AS b, array_to_string({_KEPT}, '.') AS a FROM s), m AS ({measured}), ev AS ({events}) SELECT p_partkey, 'GET_PARENT' AS stage, rule, b AS before_smiles, a AS after_smiles, detail FROM part JOIN ev ON p_partkey % {len(SMILES)} = k"


@query(_probes_sql())
def q_probe_events(spark, d):
    listed = F.array(*map(F.lit, ("Cl", "O", "[Na+]", "[Cl-]")))
    x = _with(spark, d, SMILES, "smiles").withColumn("parent", F.array_join(S.keep_unless_all(S.fragments(F.col("smiles")), listed), "."))
    return x.select("p_partkey", F.explode(S.probe_events(F.col("smiles"), F.col("parent"), F.lit("GET_PARENT"))).alias("e")).select("p_partkey", "e.*")


RATERS = "SELECT CASE quality WHEN 1 THEN 'ACCEPT' WHEN 0 THEN 'REJECT' END AS a, CASE toxic WHEN 0 THEN 'ACCEPT' WHEN 1 THEN 'REJECT' END AS b, doc_id FROM labels"


def _raters(spark, d):
    l = table(spark, d, "labels")  # noqa: E741
    return l.select("doc_id", F.when(F.col("quality") == 1, "ACCEPT").when(F.col("quality") == 0, "REJECT").alias("a"), F.when(F.col("toxic") == 0, "ACCEPT").when(F.col("toxic") == 1, "REJECT").alias("b"))


_BANDS = "CASE " + " ".join(f"WHEN k >= {v} THEN '{n}'" for v, n in validate.BANDS) + f" ELSE '{validate.WORST}' END"


@query(f"WITH r AS ({RATERS}), p AS (SELECT * FROM r WHERE a IS NOT NULL AND b IS NOT NULL), t AS (SELECT count(*) AS n, count(*) FILTER (a = b) AS same, CAST(count(*) FILTER (a = 'ACCEPT') AS DOUBLE) * count(*) FILTER (b = 'ACCEPT') + CAST(count(*) FILTER (a = 'REJECT') AS DOUBLE) * count(*) FILTER (b = 'REJECT') AS ch FROM p), u AS (SELECT n, same, same / CAST(n AS DOUBLE) AS po, ch / (CAST(n AS DOUBLE) * n) AS pe FROM t), v AS (SELECT *, CASE WHEN pe >= 1 THEN 1.0 ELSE (po - pe) / (1 - pe) END AS k FROM u) SELECT n, round(po, 9) AS po, round(pe, 9) AS pe, round(k, 9) AS kappa, n - same AS disagreements, {_BANDS} AS interpretation FROM v")
def q_kappa(spark, d):
    return validate.agreement(_raters(spark, d))


@query(f"WITH r AS ({RATERS}) SELECT doc_id, CASE WHEN a = b THEN a END AS resolved FROM r")
def q_resolved_label(spark, d):
    return _raters(spark, d).select("doc_id", validate.resolved_label(F.lit(None).cast("string"), F.col("a"), F.col("b")).alias("resolved"))


@query(f"{RECORDS}, r AS ({RATERS}), o AS (SELECT CASE WHEN a = b THEN a END AS gold, CASE WHEN status = 'PASSED' THEN 'ACCEPT' ELSE 'REJECT' END AS predicted FROM r JOIN records ON seq = doc_id), c AS (SELECT count(*) FILTER (gold = 'REJECT' AND predicted = 'REJECT') AS tp, count(*) FILTER (gold = 'ACCEPT' AND predicted = 'REJECT') AS fp, count(*) FILTER (gold = 'ACCEPT' AND predicted = 'ACCEPT') AS tn, count(*) FILTER (gold = 'REJECT' AND predicted = 'ACCEPT') AS fn, count(*) FILTER (gold IS NULL) AS unresolved FROM o), m AS (SELECT *, coalesce(tp / nullif(CAST(tp + fp AS DOUBLE), 0), 0) AS p, coalesce(tp / nullif(CAST(tp + fn AS DOUBLE), 0), 0) AS r FROM c) SELECT tp, fp, tn, fn, unresolved, round(p, 9) AS prec, round(r, 9) AS recall, round(coalesce(2 * p * r / nullif(p + r, 0), 0), 9) AS f1, round(coalesce(fp / nullif(CAST(fp + tn AS DOUBLE), 0), 0), 9) AS frr, round(coalesce((tp + tn) / nullif(CAST(tp + fp + tn + fn AS DOUBLE), 0), 0), 9) AS accuracy FROM m")
def q_confusion(spark, d):
    o = _raters(spark, d).join(records(spark, d).select(F.col("seq").alias("doc_id"), "status"), "doc_id")
    return validate.confusion(o.select(validate.resolved_label(F.lit(None).cast("string"), F.col("a"), F.col("b")).alias("gold"), F.when(F.col("status") == "PASSED", "ACCEPT").otherwise("REJECT").alias("predicted")))


@query("SELECT l_returnflag, count(l_quantity) AS n, round(avg(l_quantity), 6) AS mean, round(median(l_quantity), 6) AS median, round(stddev_pop(l_quantity), 6) AS std, min(l_quantity) AS min, max(l_quantity) AS max FROM lineitem GROUP BY 1")
def q_distribution(spark, d):
    return validate.distribution(table(spark, d, "lineitem"), "l_quantity", "l_returnflag")


VARIANTS = (("baseline", 40, 5000), ("short", 40, 1000), ("long_only", 1000, 1000000), ("all", 0, 1000000000))
_ABL = "WITH v(variant, lo, hi) AS (VALUES " + ", ".join(f"('{a}', {b}, {c})" for a, b, c in VARIANTS) + "), r AS (SELECT variant, count(*) AS total, count(*) FILTER (n BETWEEN lo AND hi) AS passed, CAST(coalesce(sum(n) FILTER (n BETWEEN lo AND hi), 0) AS BIGINT) AS chars_kept FROM (SELECT length(coalesce(text, '')) AS n FROM documents) CROSS JOIN v GROUP BY 1)"


def _ablation(spark, d):
    v = spark.createDataFrame(VARIANTS, "variant string, min_chars long, max_chars long")  # four rows
    return validate.ablation(table(spark, d, "documents"), v)


@query(f"{_ABL} SELECT * FROM r")
def q_ablation(spark, d):
    return _ablation(spark, d)


@query(f"{_ABL} SELECT r.variant, r.passed, CASE WHEN r.passed = b.passed THEN '-' ELSE printf('%+d', r.passed - b.passed) END AS delta FROM r, r b WHERE b.variant = 'baseline'".replace("printf('%+d', r.passed - b.passed)", "CASE WHEN r.passed > b.passed THEN '+' ELSE '' END || CAST(r.passed - b.passed AS VARCHAR)"))
def q_ablation_vs_baseline(spark, d):
    return validate.against_baseline(_ablation(spark, d), "baseline")


@query("SELECT doc_id, " + ", ".join(f"CAST(length(t) - length(replace(t, {q}, '')) AS INTEGER) AS {n}" for q, n in (("','", "commas"), ("chr(9)", "tabs"), ("';'", "semicolons"), ("'|'", "bars"))) + " FROM (SELECT doc_id, text AS t FROM documents)")
def q_delimiter_counts(spark, d):
    t = F.col("text")
    n = lambda c: F.length(t) - F.length(F.replace(t, F.lit(c), F.lit("")))
    return table(spark, d, "documents").select("doc_id", n(",").alias("commas"), n("\t").alias("tabs"), n(";").alias("semicolons"), n("|").alias("bars"))


@query("SELECT CAST(p AS INTEGER) AS pos, round(avg(CASE WHEN regexp_full_match(c, '[A-Za-z0-9@+\\-\\[\\]\\(\\)=#%./\\\\]+') THEN 1.0 ELSE 0.0 END), 9) AS parse_rate FROM (SELECT unnest(range(0, 3)) AS p, unnest([c_name, CAST(c_nationkey AS VARCHAR), c_mktsegment || ' x']) AS c FROM customer) GROUP BY 1")
def q_column_inference(spark, d):
    cells = table(spark, d, "customer").select(F.posexplode(F.array("c_name", F.col("c_nationkey").cast("string"), F.concat("c_mktsegment", F.lit(" x")))).alias("pos", "c"))
    return cells.groupBy("pos").agg(F.round(F.avg(F.when(ingest.plausible(F.col("c")), 1.0).otherwise(0.0)), 9).alias("parse_rate"))


@query("SELECT c_custkey, printf('CMPD_%07d', row_number() OVER (ORDER BY c_custkey)) AS input_id FROM customer")
def q_generated_ids(spark, d):
    return ingest.number(table(spark, d, "customer").select("c_custkey"), "c_custkey").select("c_custkey", F.format_string("CMPD_%07d", "seq").alias("input_id"))


@query("SELECT count(*) AS total, count(*) FILTER (length(coalesce(text, '')) < 40) AS n_invalid FROM documents")
def q_preview(spark, d):
    return table(spark, d, "documents").agg(F.count("*").alias("total"), F.count_if(F.length(F.coalesce("text", F.lit(""))) < 40).alias("n_invalid"))


@query("SELECT count(*) FILTER (sha256(source) <> sha256('src0')) AS n_mismatch FROM documents")
def q_policy_mismatch(spark, d):
    return table(spark, d, "documents").agg(F.count_if(F.sha2("source", 256) != F.sha2(F.lit("src0"), 256)).alias("n_mismatch"))


@query("SELECT doc_id, sha256(text) AS row_hash FROM documents")
def q_row_hash(spark, d):
    return table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("row_hash"))


@query(f"{RECORDS} SELECT rejection_stage, rejection_code, count(*) AS n FROM records WHERE status = 'REJECTED' GROUP BY ROLLUP (rejection_stage, rejection_code)")
def q_rollup_rejections(spark, d):
    return records(spark, d).where("status = 'REJECTED'").rollup("rejection_stage", "rejection_code").agg(F.count("*").alias("n"))


@query("SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def q_events_tumbling(spark, d):
    w = table(spark, d, "events").groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return w.select(F.col("w.start").alias("window_start"), "event_type", "n", "total")


_SAID = " || ',' || ".join(f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in ("input_id", "status", "rejection_code", "identity", "curated_text"))
_LIMBS = ", ".join(f"sum(CAST('0x' || substr(h, {8 * i + 1}, 8) AS BIGINT)) AS s{i}" for i in range(report.LIMBS))
_HEX = " || ".join(f"lpad(lower(to_hex(CAST(coalesce(s{i}, 0) % 4294967296 AS BIGINT))), 8, '0')" for i in range(report.LIMBS))


@query(f"{RECORDS}, hashed AS (SELECT sha256({_SAID}) AS h FROM records), summed AS (SELECT count(*) AS n, {_LIMBS} FROM hashed) SELECT n, {_HEX} AS digest FROM summed")
def q_output_hash(spark, d):
    return report.output_digest(records(spark, d), "input_id", "status", "rejection_code", "identity", "curated_text")


_NAMES = lambda kinds: ", ".join(f"'{x}'" for x in sorted(kinds))
_WHITE = r"[\s\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_STRIP = lambda c: f"regexp_replace({c}, '^{_WHITE}+|{_WHITE}+$', '', 'g')"
_CELLS = "CASE WHEN d IS NULL THEN regexp_split_to_array(value, '\\s+') ELSE string_split(value, d) END"
#: Lines of the documents, each document an input; the sample's cells, each judged as a structure by its tokens, brackets and ring labels.
_LAYOUTS = f"""WITH split_ AS (SELECT doc_id AS input, list_filter(list_transform(regexp_split_to_array(coalesce(text, ''), '\\r\\n|\\n|\\r'), lambda x: {_STRIP('x')}), lambda x: x <> '' AND NOT starts_with(x, '#')) AS l FROM documents),
lines AS MATERIALIZED (SELECT input, CAST(unnest(range(0, len(l))) AS INTEGER) AS at_, unnest(l) AS value FROM split_),
marks AS (SELECT input, d, rank, min(n) AS n, max(n) AS most FROM (SELECT input, d, rank, length(value) - length(replace(value, d, '')) AS n FROM lines, (VALUES {', '.join(f"(chr({ord(x)}), {i})" for i, x in enumerate(ingest.DELIMITERS))}) v(d, rank) WHERE at_ < {ingest.SAMPLE}) GROUP BY 1, 2, 3),
cut_at AS MATERIALIZED (SELECT i.input, b.d FROM (SELECT DISTINCT input FROM lines) i LEFT JOIN (SELECT input, d FROM marks WHERE n = most AND n > 0 QUALIFY row_number() OVER (PARTITION BY input ORDER BY n DESC, rank) = 1) b USING (input)),
cells AS MATERIALIZED (SELECT input, at_, CAST(unnest(range(0, len(c))) AS INTEGER) AS pos, unnest(c) AS cell FROM (SELECT input, at_, list_transform({_CELLS}, lambda x: {_STRIP('x')}) AS c FROM lines JOIN cut_at USING (input) WHERE at_ < {ingest.SAMPLE})),
words AS (SELECT cell, regexp_replace(cell, '\\[[^\\[\\]]+\\]', 'C', 'g') AS body FROM (SELECT DISTINCT cell FROM cells)),
turns AS (SELECT cell, min(s) AS low, max_by(s, i) AS last FROM (SELECT cell, i, sum(CASE t WHEN '(' THEN 1 ELSE -1 END) OVER (PARTITION BY cell ORDER BY i) AS s FROM (SELECT cell, unnest(regexp_extract_all(body, '[()]')) AS t, unnest(range(0, len(regexp_extract_all(body, '[()]')))) AS i FROM words)) GROUP BY 1),
odd AS (SELECT DISTINCT cell FROM (SELECT cell, unnest(regexp_extract_all(body, '%\\d\\d|\\d')) AS x FROM words) GROUP BY cell, x HAVING count(*) % 2 = 1),
parsed AS MATERIALIZED (SELECT cell, regexp_full_match(body, '(?:Br|Cl|[BCNOPSFIbcnops*]|[-=#$:/\\\\.()]|%\\d\\d|\\d)+') AND regexp_matches(body, '^[A-Za-z*]') AND coalesce(low >= 0 AND last = 0, TRUE) AND cell NOT IN (SELECT cell FROM odd) AS ok FROM words LEFT JOIN turns USING (cell)),
shape AS MATERIALIZED (SELECT input, pos, max(lower(cell)) FILTER (at_ = 0) AS name, bool_or(at_ = 0 AND ok) AS top_ok, bool_or(at_ = 0) AS in_top, count(*) FILTER (ok) AS k, count(*) AS n FROM cells JOIN parsed USING (cell) GROUP BY 1, 2),
heads AS (SELECT input, bool_or(n > 1) AND (bool_or(coalesce(name IN ({_NAMES(ingest.STRUCTURE_NAMES | ingest.ID_NAMES)}), FALSE)) OR NOT bool_or(top_ok)) AS header FROM shape GROUP BY 1),
shares AS (SELECT s.*, header, CASE WHEN n - CAST(header AND in_top AS INTEGER) > 0 THEN (k - CAST(header AND top_ok AS INTEGER)) / CAST(n - CAST(header AND in_top AS INTEGER) AS DOUBLE) END AS share FROM shape s JOIN heads USING (input)),
firsts AS (SELECT input, any_value(header) AS header, min(pos) FILTER (header AND name IN ({_NAMES(ingest.STRUCTURE_NAMES)})) AS s, min(pos) FILTER (header AND name IN ({_NAMES(ingest.ID_NAMES)})) AS i, max(share) AS top FROM shares GROUP BY 1),
placed AS (SELECT f.*, coalesce(s, CASE WHEN top >= {ingest.LEAST} THEN (SELECT min(pos) FROM shares x WHERE x.input = f.input AND x.share = f.top) END, 0) AS structure FROM firsts f),
layouts AS MATERIALIZED (SELECT p.input, c.d AS delimiter, header, CAST(structure AS INTEGER) AS structure, CAST(CASE WHEN s IS NOT NULL THEN i ELSE coalesce((SELECT min(pos) FROM shares x WHERE x.input = p.input AND p.header AND x.name IN ({_NAMES(ingest.ID_NAMES)}) AND x.pos <> p.structure), (SELECT min(pos) FROM shares x WHERE x.input = p.input AND x.share IS NOT NULL AND x.pos <> p.structure)) END AS INTEGER) AS id FROM placed p JOIN cut_at c USING (input))"""


@query(f"{_LAYOUTS} SELECT input, coalesce(delimiter, 'white space') AS delimiter, header, structure, coalesce(id, -1) AS id FROM layouts")
def q_header_detect(spark, d):
    found = ingest.layouts(ingest.lines_of(table(spark, d, "documents"), "doc_id", "text"))
    return found.select("input", F.coalesce("delimiter", F.lit("white space")).alias("delimiter"), "header", "structure", F.coalesce("id", F.lit(-1)).alias("id"))


@query(f"{_LAYOUTS}, rows_ AS (SELECT l.input, at_ + 1 - CAST(header AS INTEGER) AS seq, id, structure, list_transform({_CELLS.replace('d IS NULL', 'delimiter IS NULL').replace('(value, d)', '(value, delimiter)')}, lambda x: {_STRIP('x')}) AS c FROM lines l JOIN layouts USING (input) WHERE NOT (header AND at_ = 0)) SELECT input, CAST(seq AS BIGINT) AS seq, coalesce(nullif(c[id + 1], ''), printf('CMPD_%07d', seq)) AS input_id, coalesce(c[structure + 1], '') AS raw_smiles FROM rows_")
def q_ingest_lines(spark, d):
    return ingest.ingest_lines(ingest.lines_of(table(spark, d, "documents"), "doc_id", "text"))


#: Documents as lines of some files, each with a tail of bytes that UTF-8, cp1252 or only latin-1 can read.
_FILE, _TAIL = "doc_id % 97", "CASE WHEN doc_id % 97 % 3 = 0 AND doc_id % 7 = 0 THEN 'E980' WHEN doc_id % 97 % 5 = 0 AND doc_id % 4 = 0 THEN '41819C' ELSE 'E282AC' END"
_HIGH = {b: bytes([b]).decode("cp1252", "replace") for b in range(0x80, 0xA0)}
_READ = [b for b, letter in _HIGH.items() if letter != "\ufffd"]
_CODES = lambda codes: " || ".join(f"chr({c})" for c in codes)
_ENCODED = f"""WITH raw AS (SELECT doc_id, {_FILE} AS input, coalesce(text, '') AS t, {_TAIL} AS tail, hex(encode(coalesce(text, ''))) || {_TAIL} AS h FROM documents),
bytes AS MATERIALIZED (SELECT *, list_transform(range(0, length(h) // 2), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS INTEGER)) AS b FROM raw),
judged AS (SELECT input, CASE WHEN bool_and(tail = 'E282AC') THEN 'utf-8-sig' WHEN bool_and(NOT list_has_any(b, [129, 141, 143, 144, 157])) THEN 'cp1252' ELSE 'latin-1' END AS encoding FROM bytes GROUP BY 1),
latin AS (SELECT doc_id, encoding, t, array_to_string(list_transform(b, lambda x: chr(x)), '') AS l FROM bytes JOIN judged USING (input)),
texts AS (SELECT doc_id, encoding, CASE encoding WHEN 'utf-8-sig' THEN t || '€' WHEN 'cp1252' THEN translate(l, {_CODES(_READ)}, {_CODES(ord(_HIGH[b]) for b in _READ)}) ELSE l END AS value FROM latin)"""


@query(f"{_ENCODED} SELECT doc_id, encoding, length(value) AS n_chars, sha256(value) AS value_hash FROM texts")
def q_encodings(spark, d):
    raw = table(spark, d, "documents").select("doc_id", F.expr(_FILE).alias("input"), F.concat(F.coalesce("text", F.lit("")).cast("binary"), F.unhex(F.expr(_TAIL))).alias("raw"))
    return encoding.decode_lines(raw).select("doc_id", "encoding", F.length("value").cast("long").alias("n_chars"), F.sha2("value", 256).alias("value_hash"))


#: The labels as an annotated file: small letters, blanks, missing and unknown labels, some disagreements settled.
_GOLD = {
    "row": "doc_id + 2", "compound_id": "concat(' D', CAST(doc_id AS {text}))", "raw_smiles": "'C'",
    "annotator_a": "CASE WHEN doc_id % 41 = 3 THEN 'maybe' WHEN doc_id % 53 = 5 THEN '  ' WHEN quality = 1 THEN ' accept ' WHEN quality = 0 THEN 'REJECT' END",
    "annotator_b": "CASE WHEN doc_id % 47 = 2 THEN NULL WHEN toxic = 1 THEN 'Reject' WHEN toxic = 0 THEN 'ACCEPT' END",
    "consensus": "CASE WHEN doc_id % 59 = 1 THEN 'YES' WHEN doc_id % 3 = 0 THEN 'accept' WHEN doc_id % 3 = 1 THEN '' END", "reason": "CAST(NULL AS {text})",
}
_CAPS = lambda c: f"nullif(upper(trim(coalesce({c}, ''))), '')"
_GOLD_SQL = "WITH given AS (SELECT " + ", ".join(f"{v.format(text='VARCHAR')} AS {k}" for k, v in _GOLD.items()) + f" FROM labels), capital AS (SELECT row, {', '.join(f'{_CAPS(c)} AS {c}, {c} AS {c}_raw' for c in ('annotator_a', 'annotator_b', 'consensus'))} FROM given)"


def _gold(spark, d):
    return table(spark, d, "labels").select(*(F.expr(v.format(text="STRING")).alias(k) for k, v in _GOLD.items()))


@query(_GOLD_SQL + " " + " UNION ALL ".join(f"SELECT row, '{c}' AS field, {c}_raw AS value, 'neither ACCEPT nor REJECT' AS message FROM capital WHERE {c} NOT IN ('ACCEPT', 'REJECT')" for c in ("annotator_a", "annotator_b", "consensus")) + " UNION ALL SELECT row, 'annotators', NULL, 'both annotators need a label' FROM capital WHERE annotator_a IS NULL OR annotator_b IS NULL")
def q_gold_errors(spark, d):
    return gold.errors(_gold(spark, d))


@query(
    _GOLD_SQL + f""", good AS (SELECT *, coalesce(consensus, CASE WHEN annotator_a = annotator_b THEN annotator_a END) AS resolved FROM capital WHERE annotator_a IN ('ACCEPT', 'REJECT') AND annotator_b IN ('ACCEPT', 'REJECT') AND coalesce(consensus IN ('ACCEPT', 'REJECT'), TRUE)),
t AS (SELECT count(*) AS n, count(*) FILTER (annotator_a = annotator_b) AS same, count(*) FILTER (resolved IS NULL) AS unresolved, CAST(count(*) FILTER (annotator_a = 'ACCEPT') AS DOUBLE) * count(*) FILTER (annotator_b = 'ACCEPT') + CAST(count(*) FILTER (annotator_a = 'REJECT') AS DOUBLE) * count(*) FILTER (annotator_b = 'REJECT') AS ch FROM good),
u AS (SELECT *, same / CAST(n AS DOUBLE) AS po, ch / (CAST(n AS DOUBLE) * n) AS pe FROM t), v AS (SELECT *, CASE WHEN pe >= 1 THEN 1.0 ELSE (po - pe) / (1 - pe) END AS k FROM u)
SELECT n, round(po, 9) AS po, round(pe, 9) AS pe, round(k, 9) AS kappa, n - same AS disagreements, {_BANDS} AS interpretation, unresolved, round(k, 9) >= 0.61 AS sufficient FROM v"""
)
def q_agreement_report(spark, d):
    return gold.agreement_report(gold.entries(_gold(spark, d)))

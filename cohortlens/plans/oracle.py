"""DuckDB oracle SQL for the registered queries.

The CTEs below restate the driver-table adapters of ``sources.adapters`` in SQL; each
query string is self-contained (DuckDB has the driver tables as views).
"""

from __future__ import annotations

from ..functions.hashing import hash_unit_sql

ORACLE_SQL: dict[str, str] = {}

# Driver-table adapters (orders profile).
OL = """ol AS (
  SELECT o.o_custkey AS patient_id, CAST(o.o_orderdate AS DATE) AS event_date, o.o_orderkey AS order_key,
         l.l_linenumber AS line_number, l.l_partkey AS part_key, l.l_quantity AS qty, l.l_extendedprice AS price,
         p.p_type, p.p_brand, p.p_name
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON p.p_partkey = l.l_partkey)"""
EV = OL + """,
ev AS (
  SELECT patient_id, 'DIAG_' || p_type AS event_id, 'DIAG' AS event_class, p_type AS item, event_date, qty AS value,
         order_key, line_number, part_key FROM ol
  UNION ALL SELECT patient_id, 'DRUG_' || p_brand, 'DRUG', p_brand, event_date, qty, order_key, line_number, part_key FROM ol
  UNION ALL SELECT patient_id, 'LAB_' || p_name, 'LAB', p_name, event_date, price, order_key, line_number, part_key FROM ol)"""
MORT = """mort AS (
  SELECT o_custkey AS patient_id, CAST(max(o_orderdate) AS DATE) AS death_date, 1 AS label
  FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0) GROUP BY o_custkey)"""
IDX = """idx AS (
  SELECT patient_id, max(event_date) AS indx_date FROM ev
  WHERE patient_id NOT IN (SELECT patient_id FROM mort) GROUP BY patient_id
  UNION ALL SELECT patient_id, CAST(death_date - INTERVAL 30 DAY AS DATE) FROM mort)"""
FILT = """filt AS (
  SELECT e.patient_id, e.event_id, e.value FROM ev e JOIN idx i ON e.patient_id = i.patient_id
  WHERE date_diff('day', e.event_date, i.indx_date) BETWEEN 0 AND 2000)"""
FMAP = """fmap AS (SELECT CAST(row_number() OVER (ORDER BY event_id) - 1 AS BIGINT) AS idx, event_id
  FROM (SELECT DISTINCT event_id FROM ev))"""
AGG = """agg AS (
  SELECT f.patient_id, m.idx AS feature_id,
         CASE WHEN m.idx <= 30 THEN sum(f.value) ELSE CAST(count(f.value) AS DOUBLE) END AS feature_value
  FROM filt f JOIN fmap m ON f.event_id = m.event_id WHERE f.value IS NOT NULL GROUP BY f.patient_id, m.idx)"""
NORM = """norm AS (
  SELECT a.patient_id, a.feature_id, a.feature_value / NULLIF(mx.m, 0) AS feature_value
  FROM agg a JOIN (SELECT feature_id, max(feature_value) AS m FROM agg GROUP BY feature_id) mx
    ON a.feature_id = mx.feature_id)"""
LAB = """lab AS (
  SELECT p.patient_id, CASE WHEN m.patient_id IS NULL THEN 0 ELSE 1 END AS is_dead
  FROM (SELECT DISTINCT patient_id FROM ev) p LEFT JOIN mort m ON p.patient_id = m.patient_id)"""
SVM = """svm AS (
  SELECT n.patient_id,
         concat_ws(' ', CAST(n.patient_id AS VARCHAR), CAST(l.is_dead AS VARCHAR),
                   string_agg(printf('%d:%.6f', n.feature_id, round(n.feature_value, 6)), ' ' ORDER BY n.feature_id)) AS line
  FROM norm n JOIN lab l ON n.patient_id = l.patient_id GROUP BY n.patient_id, l.is_dead)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def sql(name: str, text: str) -> None:
    ORACLE_SQL[name] = text


COHORT = (EV, MORT)

sql("alive_events", _with(*COHORT) + """
SELECT patient_id, event_id, event_date, value FROM ev WHERE patient_id NOT IN (SELECT patient_id FROM mort)""")

sql("dead_events", _with(*COHORT) + """
SELECT patient_id, event_id, event_date, value FROM ev WHERE patient_id IN (SELECT patient_id FROM mort)""")

sql("alive_dead_label", _with(*COHORT, LAB) + "SELECT patient_id, is_dead FROM lab")

sql("index_dates", _with(*COHORT, IDX) + "SELECT patient_id, indx_date FROM idx")

# the dates are aggregated before the join, and the dead are excluded by an anti-join
sql("window_filter", _with(*COHORT) + """
, per AS MATERIALIZED (SELECT patient_id, max(event_date) AS last FROM ev GROUP BY patient_id),
idx AS MATERIALIZED (SELECT patient_id, last AS indx_date FROM per WHERE NOT EXISTS (SELECT 1 FROM mort WHERE mort.patient_id = per.patient_id)
  UNION ALL SELECT patient_id, CAST(death_date - INTERVAL 30 DAY AS DATE) FROM mort)
SELECT e.patient_id, e.event_id, e.value FROM ev e JOIN idx i ON e.patient_id = i.patient_id
WHERE e.event_date <= i.indx_date AND e.event_date >= i.indx_date - 2000""")

sql("alive_time_difference", _with(*COHORT) + """
, alive AS (SELECT * FROM ev WHERE patient_id NOT IN (SELECT patient_id FROM mort)),
last AS (SELECT patient_id, max(event_date) AS d FROM alive GROUP BY patient_id)
SELECT a.patient_id, a.event_id, a.value, 0 AS label, CAST(date_diff('day', a.event_date, l.d) AS INTEGER) AS time_difference
FROM alive a JOIN last l ON a.patient_id = l.patient_id""")

sql("dead_time_difference", _with(*COHORT) + """
SELECT e.patient_id, e.event_id, e.value, m.label,
       CAST(date_diff('day', e.event_date, CAST(m.death_date - INTERVAL 30 DAY AS DATE)) AS INTEGER) AS time_difference
FROM ev e JOIN mort m ON e.patient_id = m.patient_id""")

_STATUS = """per AS (
  SELECT p.*, CASE WHEN m.patient_id IS NULL THEN 'alive' ELSE 'dead' END AS status
  FROM ({inner}) p LEFT JOIN mort m ON p.patient_id = m.patient_id)"""

sql("event_count_metrics", _with(*COHORT, _STATUS.format(
    inner="SELECT patient_id, count(event_id) AS event_count FROM ev GROUP BY patient_id")) + """
SELECT status, round(avg(event_count), 6) AS avg_event_count, CAST(min(event_count) AS BIGINT) AS min_event_count,
       CAST(max(event_count) AS BIGINT) AS max_event_count FROM per GROUP BY status""")

sql("encounter_count_metrics", _with(*COHORT, _STATUS.format(
    inner="SELECT patient_id, count(DISTINCT event_date) AS encounter_count FROM ev GROUP BY patient_id")) + """
SELECT status, round(avg(encounter_count), 6) AS avg_encounter_count,
       CAST(min(encounter_count) AS BIGINT) AS min_encounter_count,
       CAST(max(encounter_count) AS BIGINT) AS max_encounter_count,
       round(quantile_cont(encounter_count, 0.5), 6) AS median_encounter_count FROM per GROUP BY status""")

sql("record_length_metrics", _with(*COHORT, _STATUS.format(
    inner="SELECT patient_id, date_diff('day', min(event_date), max(event_date)) AS record_length FROM ev GROUP BY patient_id")) + """
SELECT status, round(avg(record_length), 6) AS avg_record_length,
       CAST(min(record_length) AS BIGINT) AS min_record_length,
       CAST(max(record_length) AS BIGINT) AS max_record_length,
       round(quantile_cont(record_length, 0.5), 6) AS median_record_length FROM per GROUP BY status""")

sql("top_events", _with(*COHORT) + """
, c AS (
  SELECT CASE WHEN m.patient_id IS NULL THEN 'alive' ELSE 'dead' END AS status, e.event_id,
         CASE WHEN e.event_id LIKE 'DIAG%' THEN 'DIAG' WHEN e.event_id LIKE 'LAB%' THEN 'LAB'
              WHEN e.event_id LIKE 'DRUG%' THEN 'DRUG' END AS event_class,
         count(*) AS event_count
  FROM ev e LEFT JOIN mort m ON e.patient_id = m.patient_id
  WHERE e.event_id LIKE 'DIAG%' OR e.event_id LIKE 'LAB%' OR e.event_id LIKE 'DRUG%'
  GROUP BY 1, 2, 3),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY status, event_class ORDER BY event_count DESC, event_id) AS INTEGER) AS rank FROM c)
SELECT status, event_class, rank, event_id, event_count FROM r WHERE rank <= 5""")

FEAT = (EV, MORT, IDX, FILT, FMAP)

sql("feature_index", _with(EV, FMAP) + "SELECT idx, event_id FROM fmap")

sql("feature_index_join", _with(*FEAT) + """
SELECT f.patient_id, m.idx AS feature_id, f.value FROM filt f JOIN fmap m ON f.event_id = m.event_id""")

sql("aggregate_sum_count", _with(*FEAT, AGG) + """
SELECT patient_id, feature_id, round(feature_value, 6) AS feature_value FROM agg""")

sql("aggregate_count", _with(*COHORT, IDX, FILT) + """
SELECT patient_id, event_id, count(value) AS feature_value FROM filt WHERE value IS NOT NULL GROUP BY patient_id, event_id""")

sql("minmax_normalize", _with(*FEAT, AGG, NORM) + """
SELECT patient_id, feature_id, round(feature_value, 6) AS feature_value FROM norm""")

sql("svmlight_lines", _with(*FEAT, AGG, NORM, LAB, SVM) + "SELECT patient_id, line FROM svm")

sql("svmlight_parse", _with(*FEAT, AGG, NORM, LAB, SVM) + """
, tok AS (SELECT patient_id, string_split(line, ' ') AS t FROM svm),
kv AS (SELECT patient_id, CAST(t[2] AS DOUBLE) AS label, unnest(t[3:]) AS p FROM tok)
SELECT CAST(string_split(p, ':')[1] AS BIGINT) AS feature_id, CAST(string_split(p, ':')[2] AS DOUBLE) AS feature_value,
       label, patient_id FROM kv""")


# ---- raw loading, phenotype ---------------------------------------------------------

from .profile import CANDIDATE_LABS, PROFILE_RULES, SEQ_TEST_FRACTION, SEQ_TRAIN_SALT  # noqa: E402


def _lits(values) -> str:
    vals = sorted({v.strip().lower() for v in values})
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in vals) + ")"


R = PROFILE_RULES
POL = """pol AS (
  SELECT o.o_custkey AS patient_id, CAST(o.o_orderdate AS DATE) AS date, o.o_orderkey AS order_key,
         l.l_linenumber AS line_number, p.p_name, p.p_brand, p.p_size
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON p.p_partkey = l.l_partkey),
dx AS (SELECT patient_id, date, p_name || '.' || CAST(p_size AS VARCHAR) AS code, order_key, line_number FROM pol),
med AS (SELECT patient_id, date, lower(p_brand) || '-' || CAST(p_size AS VARCHAR) AS medicine, order_key, line_number
        FROM pol),
labr AS (SELECT o_custkey AS patient_id, CAST(o_orderdate AS DATE) AS date, lower(trim(o_orderpriority)) AS test_name,
                round(o_totalprice, 2) AS value, o_orderkey AS order_key
         FROM orders WHERE NOT (""" + hash_unit_sql("o_orderkey", "blank") + """ < 0.05))"""

ABNORMAL = " OR ".join(
    f"(test_name = '{r.test_name.strip().lower()}' AND value {r.op} {r.threshold!r})" for r in R.abnormal_labs)

sql("load_labs_clean", _with(POL) + "SELECT patient_id, date, test_name, value FROM labr")

sql("patient_universe", _with(POL) + """
SELECT patient_id FROM dx UNION SELECT patient_id FROM med UNION SELECT patient_id FROM labr""")

MEDF = """medf AS (
  SELECT patient_id, bool_or(m IN {t1}) AS t1_med, bool_or(m IN {t2}) AS t2_med,
         min(CASE WHEN m IN {t1} THEN date END) AS first_t1_med,
         min(CASE WHEN m IN {t2} THEN date END) AS first_t2_med
  FROM (SELECT patient_id, date, lower(trim(medicine)) AS m FROM med) GROUP BY patient_id)""".format(
    t1=_lits(R.t1_med), t2=_lits(R.t2_med))

sql("phenotype", _with(POL, MEDF) + """
, pts AS (SELECT patient_id FROM dx UNION SELECT patient_id FROM med UNION SELECT patient_id FROM labr),
dxf AS (
  SELECT patient_id, bool_or(c IN {t1}) AS t1_dx, bool_or(c IN {t2}) AS t2_dx,
         bool_or(c IN {rel} OR starts_with(c, '{prefix}')) AS related_dx
  FROM (SELECT patient_id, lower(trim(code)) AS c FROM dx) GROUP BY patient_id),
labf AS (
  SELECT patient_id, bool_or(contains(test_name, '{glu}')) AS has_glucose, bool_or({abn}) AS abnormal_lab
  FROM labr GROUP BY patient_id),
f AS (
  SELECT p.patient_id, coalesce(t1_dx, false) AS t1_dx, coalesce(t2_dx, false) AS t2_dx,
         coalesce(related_dx, false) AS related_dx, coalesce(t1_med, false) AS t1_med,
         coalesce(t2_med, false) AS t2_med, first_t1_med, first_t2_med,
         coalesce(has_glucose, false) AS has_glucose, coalesce(abnormal_lab, false) AS abnormal_lab
  FROM pts p LEFT JOIN dxf ON p.patient_id = dxf.patient_id LEFT JOIN medf ON p.patient_id = medf.patient_id
       LEFT JOIN labf ON p.patient_id = labf.patient_id)
SELECT patient_id,
       CASE WHEN coalesce(NOT t1_dx AND t2_dx AND (NOT t1_med OR (t1_med AND NOT t2_med)
                 OR (t1_med AND t2_med AND first_t2_med < first_t1_med)), false) THEN 1
            WHEN has_glucose AND NOT abnormal_lab AND NOT related_dx THEN 2 ELSE 3 END AS phenotype
FROM f""".format(t1=_lits(R.t1_dx), t2=_lits(R.t2_dx), rel=_lits(R.related_dx),
                 prefix=R.related_dx_prefix.strip().lower(), glu=R.glucose_substring.lower(), abn=ABNORMAL))

sql("abnormal_lab", _with(POL) + f"""
SELECT patient_id, count(*) AS n_abnormal FROM labr WHERE {ABNORMAL} GROUP BY patient_id""")

sql("first_event_order", _with(POL, MEDF) + """
SELECT patient_id, first_t1_med, first_t2_med FROM medf WHERE first_t2_med < first_t1_med""")

# ---- typed feature tuples -----------------------------------------------------------

CNT = """cnt AS (
  SELECT patient_id, code AS feature_name, CAST(count(*) AS DOUBLE) AS feature_value FROM dx GROUP BY 1, 2
  UNION ALL
  SELECT patient_id, medicine, CAST(count(*) AS DOUBLE) FROM med GROUP BY 1, 2)"""
LABAVG = """labavg AS (SELECT patient_id, test_name AS feature_name, avg(value) AS feature_value FROM labr GROUP BY 1, 2)"""

sql("features_count", _with(POL, CNT) + "SELECT patient_id, feature_name, feature_value FROM cnt")

sql("features_lab_avg", _with(POL, LABAVG) + """
SELECT patient_id, feature_name, round(feature_value, 6) AS feature_value FROM labavg""")

sql("features_filtered", _with(POL) + """
SELECT patient_id, code AS feature_name, CAST(count(*) AS DOUBLE) AS feature_value FROM dx
WHERE code IN {cdx} GROUP BY 1, 2
UNION ALL
SELECT patient_id, medicine, CAST(count(*) AS DOUBLE) FROM med WHERE medicine IN {cmed} GROUP BY 1, 2
UNION ALL
SELECT patient_id, test_name, round(avg(value), 6) FROM labr WHERE test_name IN {clab} GROUP BY 1, 2""".format(
    cdx=_lits(R.t1_dx + R.t2_dx + R.related_dx), cmed=_lits(R.t1_med + R.t2_med), clab=_lits(CANDIDATE_LABS)))

sql("feature_vectors", _with(POL, CNT, LABAVG) + """
, tup AS (SELECT * FROM cnt UNION ALL SELECT * FROM labavg),
voc AS (SELECT feature_name, row_number() OVER (ORDER BY feature_name) - 1 AS idx FROM (SELECT DISTINCT feature_name FROM tup)),
n AS (SELECT count(*) AS vec_size FROM voc)
SELECT t.patient_id, n.vec_size, count(*) AS nnz,
       string_agg(printf('%d:%.6f', v.idx, round(t.feature_value, 6)), ' ' ORDER BY v.idx) AS features
FROM tup t JOIN voc v ON t.feature_name = v.feature_name, n
GROUP BY t.patient_id, n.vec_size""")

# ---- visit sequences ----------------------------------------------------------------

SEQ = """adm AS (SELECT o_custkey AS patient_id, o_orderkey AS hadm_id, o_orderdate AS admit_time FROM orders),
dxi AS (SELECT l.l_orderkey AS hadm_id,
               substr(p.p_type, 1, 1) || CAST(p.p_size AS VARCHAR) || CAST(p.p_partkey % 10 AS VARCHAR) AS icd9_code
        FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey),
rc AS (SELECT hadm_id, CASE WHEN starts_with(trim(icd9_code), 'E') THEN substr(trim(icd9_code), 1, 4)
                            ELSE substr(trim(icd9_code), 1, 3) END AS code
       FROM dxi WHERE icd9_code IS NOT NULL),
cmap AS (SELECT code, CAST(row_number() OVER (ORDER BY code) - 1 AS BIGINT) AS code_idx
         FROM (SELECT DISTINCT code FROM rc WHERE hadm_id IN (
               SELECT hadm_id FROM adm WHERE """ + hash_unit_sql("patient_id", SEQ_TRAIN_SALT) + f""" >= {SEQ_TEST_FRACTION}))),
vc AS (SELECT a.patient_id, a.hadm_id, a.admit_time, list_sort(list(m.code_idx)) AS codes
       FROM rc JOIN cmap m ON rc.code = m.code JOIN adm a ON a.hadm_id = rc.hadm_id
       GROUP BY a.patient_id, a.hadm_id, a.admit_time),
flat AS (SELECT v.patient_id, coalesce(mo.label, 0) AS label,
                CAST(row_number() OVER (PARTITION BY v.patient_id ORDER BY v.admit_time, v.hadm_id) - 1 AS BIGINT) AS visit_idx,
                v.codes
         FROM vc v LEFT JOIN mort mo ON v.patient_id = mo.patient_id)"""

sql("code_rollup", _with(SEQ) + """
SELECT DISTINCT icd9_code, CASE WHEN starts_with(trim(icd9_code), 'E') THEN substr(trim(icd9_code), 1, 4)
                                ELSE substr(trim(icd9_code), 1, 3) END AS code FROM dxi""")

sql("codemap", _with(SEQ) + "SELECT code, code_idx FROM cmap")

sql("visit_sequences", _with(MORT, SEQ) + """
SELECT patient_id, label, visit_idx, array_to_string(codes, ',') AS codes FROM flat""")

sql("visit_multihot", _with(MORT, SEQ) + """
SELECT DISTINCT patient_id, visit_idx, unnest(codes) AS code_idx FROM flat""")

sql("padded_sequences", _with(MORT, SEQ) + """
, len AS (SELECT patient_id, count(*) AS seq_length FROM flat GROUP BY patient_id),
pos AS (SELECT *, CAST((row_number() OVER (ORDER BY patient_id) - 1) // 32 AS BIGINT) AS batch_id FROM len),
bat AS (SELECT *, CAST(row_number() OVER (PARTITION BY batch_id ORDER BY seq_length DESC, patient_id) - 1 AS BIGINT) AS batch_row,
               max(seq_length) OVER (PARTITION BY batch_id) AS padded_length FROM pos),
grid AS (SELECT *, unnest(range(padded_length)) AS visit_idx FROM bat)
SELECT g.batch_id, g.batch_row, g.patient_id, g.seq_length, g.padded_length, g.visit_idx,
       coalesce(array_to_string(f.codes, ','), '') AS codes
FROM grid g LEFT JOIN flat f ON f.patient_id = g.patient_id AND f.visit_idx = g.visit_idx""")

sql("num_features", _with(MORT, SEQ) + """
SELECT count(DISTINCT c) AS num_features FROM (SELECT unnest(codes) AS c FROM flat)""")

# ---- multi-label metadata -----------------------------------------------------------

META = """meta AS (
  SELECT x.order_key, x.finding_labels, o.o_custkey AS patient_id FROM (
    SELECT l.l_orderkey AS order_key, string_agg(DISTINCT p.p_type, '|' ORDER BY p.p_type) AS finding_labels
    FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey GROUP BY l.l_orderkey) x
  JOIN orders o ON o.o_orderkey = x.order_key),
ex AS (SELECT order_key, unnest(string_split(finding_labels, '|')) AS label FROM meta),
freq AS (SELECT label, count(*) AS n_cases FROM ex GROUP BY label HAVING count(*) >= 1000 AND label <> 'No Finding')"""

sql("label_frequency", _with(META) + "SELECT label, n_cases FROM freq")

sql("multilabel_indicators", _with(META) + """
SELECT DISTINCT order_key, label, 1 AS indicator FROM ex WHERE label IN (SELECT label FROM freq)""")

SAMPLE = """w AS (SELECT m.order_key, m.finding_labels, coalesce(h.weight, 0) AS weight FROM meta m LEFT JOIN
        (SELECT order_key, count(*) AS weight FROM ex WHERE label IN (SELECT label FROM freq) GROUP BY order_key) h
        ON m.order_key = h.order_key),
tot AS (SELECT sum(weight) AS s, count(*) * 5 // 7 AS n FROM w),
smp AS (SELECT order_key, finding_labels, weight FROM (SELECT w.*, tot.n, row_number() OVER (
    ORDER BY -ln(""" + hash_unit_sql("order_key", "ws") + """) / (coalesce(weight / NULLIF(tot.s, 0), 0.0) + 0.04), order_key) AS pos
    FROM w, tot) WHERE pos <= n)"""

sql("weighted_sample", _with(META, SAMPLE) + "SELECT order_key, weight FROM smp")

sql("sampled_split", _with(META, SAMPLE) + """
, b AS (SELECT order_key, substr(finding_labels, 1, 4) AS stratum, """ + hash_unit_sql("order_key", "strat") + """ AS h FROM smp),
p AS (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY h, order_key) - 1 AS pos,
             count(*) OVER (PARTITION BY stratum) AS n FROM b)
SELECT order_key, stratum, CASE WHEN pos < floor(n * 0.2) THEN 'test' WHEN pos < floor(n * (0.2 + 0.2)) THEN 'valid'
                                ELSE 'train' END AS split FROM p""")

sql("stratified_split", _with(META) + """
, b AS (SELECT order_key, substr(finding_labels, 1, 4) AS stratum, """ + hash_unit_sql("order_key", "strat") + """ AS h FROM meta),
p AS (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY h, order_key) - 1 AS pos,
             count(*) OVER (PARTITION BY stratum) AS n FROM b)
SELECT order_key, stratum, CASE WHEN pos < floor(n * 0.2) THEN 'test' WHEN pos < floor(n * (0.2 + 0.2)) THEN 'valid'
                                ELSE 'train' END AS split FROM p""")

# ---- hash splits --------------------------------------------------------------------

PTS = _with(*COHORT, LAB)

sql("train_test_split", PTS + "SELECT patient_id, CASE WHEN " + hash_unit_sql("patient_id", "split")
    + " <= 0.2 THEN 'test' ELSE 'train' END AS split FROM lab")

sql("kfold_assign", PTS + "SELECT patient_id, CAST(floor(" + hash_unit_sql("patient_id", "kfold")
    + " * 5) AS INTEGER) AS fold FROM lab")


def _salted(expr: str, salt_expr: str) -> str:
    return f"(('0x' || substr(md5({salt_expr} || {expr}::varchar), 1, 8))::ubigint / 4294967296.0)"


sql("shuffle_split", PTS + """
, it AS (SELECT CAST(i AS INTEGER) AS iteration, patient_id FROM lab, range(0, 5) t(i))
SELECT iteration, patient_id, CASE WHEN """ + _salted("patient_id", "'ss' || CAST(iteration AS VARCHAR) || '-'")
    + " < 0.2 THEN 'test' ELSE 'train' END AS split FROM it")

sql("bagging_sample", PTS + """
, it AS (SELECT CAST(i AS INTEGER) AS model_id, patient_id FROM lab, range(0, 5) t(i))
SELECT model_id, patient_id FROM it WHERE """ + _salted("patient_id", "'bag' || CAST(model_id AS VARCHAR) || '-'") + " < 0.5")


# ---- graph --------------------------------------------------------------------------

GRAPH = """gev AS (
  SELECT 'diagnostic' AS kind, patient_id, code AS item, date, CAST(NULL AS DOUBLE) AS value, order_key, line_number FROM dx
  UNION ALL SELECT 'lab', patient_id, test_name, date, value, order_key, 0 FROM labr
  UNION ALL SELECT 'medication', patient_id, medicine, date, CAST(NULL AS DOUBLE), order_key, line_number FROM med),
lat AS (SELECT kind, patient_id, item, date, value, order_key, line_number FROM (
  SELECT *, row_number() OVER (PARTITION BY kind, patient_id, item
                               ORDER BY date DESC, order_key DESC, line_number DESC) AS rn FROM gev) WHERE rn = 1),
pat AS (SELECT c_custkey AS patient_id FROM customer),
itm AS (SELECT (SELECT max(patient_id) FROM pat) + row_number() OVER (ORDER BY kind, name) AS vertex_id, kind, name
        FROM (SELECT DISTINCT kind, item AS name FROM lat)),
ge AS (SELECT l.*, i.vertex_id FROM lat l JOIN itm i ON l.kind = i.kind AND l.item = i.name),
edges AS (SELECT patient_id AS src, vertex_id AS dst, kind, date, value FROM ge
          UNION ALL SELECT vertex_id, patient_id, kind, date, value FROM ge),
pi AS (SELECT src AS patient_id, dst AS item_id FROM edges WHERE src IN (SELECT patient_id FROM pat)),
s AS (SELECT min(patient_id) AS source_id FROM pi)"""

sql("load_graph_events", _with(POL) + """
SELECT 'diagnostic' AS kind, patient_id, code AS item, date, CAST(NULL AS DOUBLE) AS value FROM dx
UNION ALL SELECT 'lab', patient_id, test_name, date, value FROM labr WHERE value IS NOT NULL
UNION ALL SELECT 'medication', patient_id, medicine, date, CAST(NULL AS DOUBLE) FROM med""")

sql("latest_event", _with(POL, GRAPH) + "SELECT * FROM lat")

sql("graph_vertices", _with(POL, GRAPH) + """
SELECT patient_id AS vertex_id, 'patient' AS kind, CAST(patient_id AS VARCHAR) AS name FROM pat
UNION ALL SELECT vertex_id, kind, name FROM itm""")

sql("graph_edges", _with(POL, GRAPH) + "SELECT src, dst, kind, date, value FROM edges")

sql("out_degree", _with(POL, GRAPH) + "SELECT src AS vertex_id, count(*) AS out_degree FROM edges GROUP BY src")

sql("neighbor_sets", _with(POL, GRAPH) + """
SELECT p.patient_id, CAST(coalesce(n.c, 0) AS BIGINT) AS n_neighbors, coalesce(n.s, '') AS neighbors
FROM pat p LEFT JOIN (SELECT patient_id, count(*) AS c, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY item_id) AS s
                      FROM pi GROUP BY patient_id) n ON p.patient_id = n.patient_id""")

sql("jaccard_top10", _with(POL, GRAPH) + """
, si AS (SELECT item_id FROM pi WHERE patient_id = (SELECT source_id FROM s)),
sd AS (SELECT count(*) AS s_deg FROM si),
inter AS (SELECT pi.patient_id, count(*) AS inter FROM pi JOIN si ON pi.item_id = si.item_id GROUP BY pi.patient_id),
deg AS (SELECT patient_id, count(*) AS deg FROM pi GROUP BY patient_id),
cand AS (
  SELECT p.patient_id,
         CASE WHEN coalesce(d.deg, 0) = 0 OR sd.s_deg = 0 THEN 0.0
              ELSE coalesce(i.inter, 0) / (coalesce(d.deg, 0) + sd.s_deg - coalesce(i.inter, 0)) END AS similarity
  FROM pat p LEFT JOIN deg d ON p.patient_id = d.patient_id LEFT JOIN inter i ON p.patient_id = i.patient_id, sd
  WHERE p.patient_id <> (SELECT source_id FROM s))
SELECT CAST(row_number() OVER (ORDER BY similarity DESC, patient_id) AS INTEGER) AS rank, patient_id,
       round(similarity, 6) AS similarity
FROM cand ORDER BY similarity DESC, patient_id LIMIT 10""")

sql("jaccard_all_pairs", _with(POL, GRAPH) + """
, deg AS (SELECT patient_id, count(*) AS deg FROM pi GROUP BY patient_id),
sh AS (SELECT a.patient_id AS p1, b.patient_id AS p2, count(*) AS inter
       FROM pi a JOIN pi b ON a.item_id = b.item_id AND a.patient_id < b.patient_id GROUP BY 1, 2)
SELECT sh.p1 AS patient_id_1, sh.p2 AS patient_id_2, round(sh.inter / (d1.deg + d2.deg - sh.inter), 6) AS similarity
FROM sh JOIN deg d1 ON sh.p1 = d1.patient_id JOIN deg d2 ON sh.p2 = d2.patient_id""")


def _walk_sql(rounds: int = 100, alpha: float = 0.15) -> str:
    keep = repr(1.0 - alpha)
    ctes = ["""w AS (SELECT e.src, e.dst, 1.0 / d.c AS w FROM edges e JOIN (SELECT src, count(*) AS c FROM edges GROUP BY src) d
       ON e.src = d.src)""",
            """verts AS (SELECT patient_id AS vertex_id FROM pat UNION ALL SELECT vertex_id FROM itm)""",
            """r0 AS (SELECT vertex_id, CASE WHEN vertex_id = (SELECT source_id FROM s) THEN 1.0 ELSE 0.0 END AS rank
       FROM verts)"""]
    for i in range(1, rounds + 1):
        ctes.append(f"""r{i} AS (SELECT v.vertex_id,
       CASE WHEN v.vertex_id = (SELECT source_id FROM s) THEN {alpha!r} ELSE 0.0 END + {keep} * coalesce(m.m, 0.0) AS rank
       FROM verts v LEFT JOIN (SELECT w.dst, sum(r.rank * w.w) AS m FROM r{i - 1} r JOIN w ON r.vertex_id = w.src
                               WHERE r.rank <> 0 GROUP BY w.dst) m ON v.vertex_id = m.dst)""")
    body = ",\n".join(ctes)
    return _with(POL, GRAPH) + ", " + body + f"""
, cand AS (SELECT vertex_id AS patient_id, rank, round(rank, 12) AS rr FROM r{rounds}
           WHERE vertex_id IN (SELECT patient_id FROM pat) AND vertex_id <> (SELECT source_id FROM s))
SELECT CAST(row_number() OVER (ORDER BY rr DESC, patient_id) AS INTEGER) AS rank_pos, patient_id,
       round(rank, 6) AS probability
FROM cand ORDER BY rr DESC, patient_id LIMIT 10"""


sql("random_walk", _walk_sql(100, 0.15))


# ---- metrics ------------------------------------------------------------------------

EMB = """emb AS (SELECT vec_id, label AS y_true,
                   CAST(floor(""" + hash_unit_sql("vec_id", "pred") + """ * 10) AS INTEGER) AS y_pred FROM embeddings)"""
DOCS = """sd AS (SELECT l.doc_id, l.quality AS y_true, d.n_chars AS score FROM labels l JOIN documents d ON l.doc_id = d.doc_id),
sg AS (SELECT score AS threshold, sum(CASE WHEN y_true = 1 THEN 1 ELSE 0 END) AS pos,
              sum(CASE WHEN y_true = 1 THEN 0 ELSE 1 END) AS neg FROM sd GROUP BY score)"""

sql("purity", _with(EMB) + """
, c AS (SELECT y_pred, y_true, count(*) AS n FROM emb GROUP BY 1, 2),
k AS (SELECT y_pred, max(n) AS best, sum(n) AS size FROM c GROUP BY y_pred)
SELECT round(sum(best) / sum(size), 6) AS purity FROM k""")

sql("confusion_matrix", _with(EMB) + """
, c AS (SELECT y_true, y_pred, count(*) AS n FROM emb GROUP BY 1, 2)
SELECT y_true, y_pred, n, round(n / sum(n) OVER (PARTITION BY y_true), 6) AS fraction FROM c""")

sql("classification_metrics", _with(DOCS) + f"""
, c AS (SELECT count(*) FILTER (WHERE y_true = 1 AND score >= {1500}) AS tp,
               count(*) FILTER (WHERE y_true <> 1 AND score >= {1500}) AS fp,
               count(*) FILTER (WHERE y_true = 1 AND score < {1500}) AS fn,
               count(*) FILTER (WHERE y_true <> 1 AND score < {1500}) AS tn FROM sd)
SELECT tp, fp, fn, tn, round((tp + tn) / NULLIF(tp + fp + fn + tn, 0), 6) AS accuracy,
       round(tp / NULLIF(tp + fp, 0), 6) AS precision, round(tp / NULLIF(tp + fn, 0), 6) AS recall,
       round(2 * (tp / NULLIF(tp + fp, 0)) * (tp / NULLIF(tp + fn, 0))
             / NULLIF((tp / NULLIF(tp + fp, 0)) + (tp / NULLIF(tp + fn, 0)), 0), 6) AS f1 FROM c""")

sql("roc_curve", _with(DOCS) + """
, t AS (SELECT sum(pos) AS p, sum(neg) AS n FROM sg)
SELECT threshold, round(sum(pos) OVER w / t.p, 6) AS tpr, round(sum(neg) OVER w / t.n, 6) AS fpr
FROM sg, t WINDOW w AS (ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")

sql("roc_auc", _with(DOCS) + """
, b AS (SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY threshold ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb
        FROM sg)
SELECT round(sum(pos * (nb + neg / 2.0)) / (sum(pos) * sum(neg)), 6) AS auc FROM b""")

sql("running_weighted_avg", """
SELECT event_id, round(sum(value * k) OVER w / sum(k) OVER w, 6) AS running_avg
FROM (SELECT event_id, value, CAST(json_extract(props, '$.k') AS DOUBLE) AS k FROM events)
WINDOW w AS (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")

# ---- ML (SQL-expressible parts) -----------------------------------------------------

sql("vector_rows", """
SELECT vec_id, label, CAST(len(embedding) AS INTEGER) AS n_dims,
       round(sqrt(list_reduce(list_prepend(0.0::DOUBLE, list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE))),
                              lambda a, b: a + b)), 6) AS l2_norm
FROM embeddings""")

sql("standardize", """
WITH x AS (SELECT vec_id, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS dim,
                  CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings)
SELECT vec_id, dim, round((v - avg(v) OVER (PARTITION BY dim)) / stddev_samp(v) OVER (PARTITION BY dim), 6) AS value
FROM x""")

ENS = """wts AS (SELECT CAST(m AS INTEGER) AS model_id, f.idx AS feature_id,
                   """ + _salted("f.idx", "'w' || CAST(m AS VARCHAR) || '-'") + """ - 0.5 AS weight
            FROM fmap f, range(0, 5) t(m)),
dots AS (SELECT n.patient_id, w.model_id, sum(n.feature_value * w.weight) AS z
         FROM norm n JOIN wts w ON n.feature_id = w.feature_id GROUP BY 1, 2),
grid AS (SELECT p.patient_id, CAST(m AS INTEGER) AS model_id FROM (SELECT DISTINCT patient_id FROM norm) p, range(0, 5) t(m)),
zz AS (SELECT g.patient_id, coalesce(d.z, 0.0) AS z FROM grid g LEFT JOIN dots d
       ON g.patient_id = d.patient_id AND g.model_id = d.model_id),
ens AS (SELECT patient_id, avg(CASE WHEN z < 0 THEN 1.0 - 1.0 / (1.0 + exp(z)) ELSE 1.0 / (1.0 + exp(-z)) END) AS score
        FROM zz GROUP BY patient_id)"""

sql("ensemble_score", _with(*FEAT, AGG, NORM, ENS) + "SELECT patient_id, round(score, 6) AS score FROM ens")

sql("submission", _with(*FEAT, AGG, NORM, ENS) + """
SELECT patient_id, CASE WHEN score > 0.5 THEN 1 ELSE 0 END AS prediction FROM ens""")

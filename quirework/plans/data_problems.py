"""Queries of the general data problems (p1 to p4) and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirework.operators import compaction, drift, incremental, nested
from quirework.session import read_table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    found = compaction.listings(read_table(spark, d, "ocr_tasks"), read_table(spark, d, "render_results"))
    return compaction.superseded(found)


def p1_containers(spark: SparkSession, d: str) -> DataFrame:
    """Which container each surviving file goes to (1 MiB containers, as the files here are tiny)."""
    found = compaction.listings(read_table(spark, d, "ocr_tasks"), read_table(spark, d, "render_results"))
    kept = compaction.resolve(found.drop("payload")).where("superseded_at IS NULL")
    return compaction.assigned(kept, target_bytes=1 << 20)


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return nested.child_records(read_table(spark, d, "page_results"), read_table(spark, d, "jobs"))


def p2_lines(spark: SparkSession, d: str) -> DataFrame:
    return nested.page_lines(nested.normalise_pages(read_table(spark, d, "page_results"), "page_id", "page_json"))


def p2_points(spark: SparkSession, d: str) -> DataFrame:
    return nested.page_points(nested.normalise_pages(read_table(spark, d, "page_results"), "page_id", "page_json"))


def p2_profile_values(spark: SparkSession, d: str) -> DataFrame:
    return nested.profile_leaves(read_table(spark, d, "jobs"), "job_row_id", "execution_profile_json")


def _fields(spark: SparkSession, d: str) -> DataFrame:
    return drift.file_fields(read_table(spark, d, "export_records"), read_table(spark, d, "field_names"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return drift.changes(_fields(spark, d))


def p3_versions(spark: SparkSession, d: str) -> DataFrame:
    return drift.versions(_fields(spark, d))


def p3_steps(spark: SparkSession, d: str) -> DataFrame:
    """The migration steps of every version."""
    return drift.steps(_fields(spark, d)).select("fingerprint", "field_name", F.array_join("spellings", ",").alias("spellings"), F.array_join("types", ",").alias("types"))


def p3_jobs_table(spark: SparkSession, d: str) -> DataFrame:
    return drift.unified(read_table(spark, d, "export_records"), read_table(spark, d, "field_names"), "jobs")


def p3_pages_table(spark: SparkSession, d: str) -> DataFrame:
    return drift.unified(read_table(spark, d, "export_records"), read_table(spark, d, "field_names"), "pages")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return incremental.to_process(read_table(spark, d, "jobs"), read_table(spark, d, "scan_runs"))


QUERIES = {
    f.__name__: f
    for f in (p1_found, p1_containers, p2_found, p2_lines, p2_points, p2_profile_values, p3_found, p3_versions, p3_steps, p3_jobs_table, p3_pages_table, p4_found)
}

_DOTS = "regexp_replace({0}, '/(\\.?/)+', '/', 'g')"
_UP = "regexp_replace({0}, '/[^/]+/\\.\\./', '/')"


def _canonical(c: str) -> str:
    p = f"CASE WHEN lower({c}[1:5]) = 'file:' THEN url_decode(replace(regexp_replace({c}, '^(?i)file:(//(/))?', '\\2'), '+', '%2B')) ELSE {c} END"
    return _UP.format(_UP.format(_DOTS.format(p)))


_LISTINGS = f"""
listings AS (
  SELECT 'ocr_tasks' AS src, task_id AS row_id, 0 AS item_no, {_canonical('output_json')} AS path, written_at
  FROM ocr_tasks WHERE payload IS NOT NULL
  UNION ALL
  SELECT 'render_results', render_id, (i - 1)::INT, {_canonical('page_paths[i]')}, written_at
  FROM (SELECT *, unnest(range(1, len(page_paths) + 1)) AS i FROM render_results) WHERE page_paths[i] IS NOT NULL)
"""

_KIND = "CASE json_type({0}) WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array' WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'NULL' THEN 'null' ELSE 'number' END"

_PAGES = """
raw AS (SELECT page_id, try_cast(page_json AS JSON) AS j FROM page_results),
un AS (SELECT page_id, CASE WHEN json_type(j) <> 'OBJECT' THEN NULL
         WHEN NOT (json_exists(j, '$.rec_texts') OR json_exists(j, '$.rec_text') OR json_exists(j, '$.rec_polys') OR json_exists(j, '$.dt_polys'))
              AND json_type(j, '$.res') = 'OBJECT' THEN json_extract(j, '$.res') ELSE j END AS p FROM raw),
named AS (SELECT page_id, p, CASE WHEN json_exists(p, '$.rec_texts') THEN 'rec_texts' WHEN json_exists(p, '$.rec_text') THEN 'rec_text' END AS tf,
         CASE WHEN json_exists(p, '$.rec_texts') AND json_exists(p, '$.rec_polys') THEN 'rec_polys' ELSE 'dt_polys' END AS pf FROM un),
taken AS (SELECT page_id, CASE WHEN tf = 'rec_texts' THEN json_extract(p, '$.rec_texts') WHEN tf = 'rec_text' THEN json_extract(p, '$.rec_text') END AS t,
         CASE WHEN pf = 'rec_polys' THEN json_extract(p, '$.rec_polys') ELSE json_extract(p, '$.dt_polys') END AS g FROM named),
arr AS (SELECT page_id, json_extract(t, '$[*]') AS ts, json_extract(g, '$[*]') AS gs FROM taken WHERE json_type(t) = 'ARRAY' AND json_type(g) = 'ARRAY'),
lns AS (SELECT page_id, unnest(range(1, len(ts) + 1)) AS i, ts, gs FROM arr WHERE len(ts) = len(gs)),
pts AS (SELECT page_id, i - 1 AS line_no, ts[i] ->> '$' AS text, json_type(ts[i]) AS tt, json_type(gs[i]) AS gt, json_extract(gs[i], '$[*]') AS pts FROM lns),
judged AS (SELECT page_id, line_no, text, pts, tt = 'VARCHAR' AND gt = 'ARRAY' AND len(pts) >= 4 AND len(list_filter(pts, lambda q:
         json_type(q) = 'ARRAY' AND json_type(q, '$[0]') IN ('BIGINT','UBIGINT','DOUBLE','HUGEINT') AND json_type(q, '$[1]') IN ('BIGINT','UBIGINT','DOUBLE','HUGEINT'))) = len(pts) AS good FROM pts),
good AS (SELECT * FROM judged WHERE page_id NOT IN (SELECT page_id FROM judged WHERE NOT coalesce(good, false)))
"""

_PROFILE = f"""
prof AS (SELECT job_row_id, try_cast(execution_profile_json AS JSON) AS j FROM jobs),
inner_ AS (SELECT job_row_id, CASE WHEN json_type(j) = 'VARCHAR' THEN try_cast(j ->> '$' AS JSON) ELSE j END AS j FROM prof),
tree AS (SELECT job_row_id, '' AS path, j AS v FROM inner_ WHERE json_type(j) = 'OBJECT'
  UNION ALL
  SELECT job_row_id, path || '/' || key, value FROM (
    SELECT t.job_row_id, t.path, e.key, e.value FROM tree t, json_each(t.v) e WHERE json_type(t.v) IN ('OBJECT', 'ARRAY'))),
leaves AS (SELECT job_row_id AS parent_id, path[2:] AS path, {_KIND.format('v')} AS kind, CASE WHEN json_type(v) IN ('VARCHAR', 'BOOLEAN') THEN v ->> '$' END AS value,
  CASE WHEN json_type(v) NOT IN ('VARCHAR', 'BOOLEAN', 'NULL') THEN (v ->> '$')::DOUBLE END AS number
  FROM tree WHERE json_type(v) NOT IN ('OBJECT', 'ARRAY'))
"""

_FIELDS = f"""
rec AS (SELECT feed, file_no, record_kind, try_cast(raw_json AS JSON) AS j FROM export_records WHERE feed IS NOT NULL AND file_no IS NOT NULL),
body AS (SELECT feed, file_no, record_kind, CASE WHEN record_kind = 'pages' AND json_keys(j) = ['res'] AND json_type(j, '$.res') = 'OBJECT' THEN json_extract(j, '$.res') ELSE j END AS b FROM rec WHERE json_type(j) = 'OBJECT'),
kv AS (SELECT DISTINCT feed, file_no, record_kind, e.key AS spelling, {_KIND.format('e.value')} AS type FROM body, json_each(b) e),
nm AS (SELECT DISTINCT record_kind, spelling, field_name FROM field_names),
ff AS (SELECT feed, file_no, coalesce(nm.field_name, kv.spelling) AS field_name,
   array_to_string(list_sort(list(DISTINCT kv.spelling)), ',') AS sp, array_to_string(list_sort(list(DISTINCT type) FILTER (type <> 'null')), ',') AS ty
   FROM kv LEFT JOIN nm ON nm.record_kind = kv.record_kind AND nm.spelling = kv.spelling GROUP BY ALL),
files AS (SELECT feed, file_no, row_number() OVER (PARTITION BY feed ORDER BY file_no) AS seq, lead(file_no) OVER (PARTITION BY feed ORDER BY file_no) AS nxt
   FROM (SELECT DISTINCT feed, file_no FROM rec)),
w AS (SELECT ff.*, seq, nxt, lag(seq) OVER x AS ps, lead(seq) OVER x AS ns, lag(sp) OVER x AS psp,
   last_value(nullif(ty, '') IGNORE NULLS) OVER (x ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pty
   FROM ff JOIN files USING (feed, file_no) WINDOW x AS (PARTITION BY feed, field_name ORDER BY seq))
"""

SQL = {
    "p1_found": f"""WITH {_LISTINGS}
SELECT src, row_id, item_no FROM (SELECT *, row_number() OVER (PARTITION BY src, coalesce(path, row_id || '|' || item_no)
  ORDER BY written_at DESC NULLS LAST, row_id DESC, item_no DESC) AS rn FROM listings) WHERE rn > 1""",
    "p2_found": f"""WITH RECURSIVE {_PAGES}, {_PROFILE}
SELECT 'page_results' AS parent_table, page_id AS parent_id, 'lines/' || line_no || '/polygon/' || k AS child_path
FROM (SELECT page_id, line_no, unnest(range(len(pts))) AS k FROM good)
UNION ALL SELECT 'jobs', parent_id, path FROM leaves""",
    "p2_lines": f"WITH {_PAGES} SELECT page_id, line_no::INT AS line_no, text, len(pts)::INT AS n_points FROM good",
    "p2_points": f"""WITH {_PAGES} SELECT page_id, line_no::INT AS line_no, (k - 1)::INT AS point_no, (pts[k] ->> '$[0]')::DOUBLE AS x, (pts[k] ->> '$[1]')::DOUBLE AS y
FROM (SELECT *, unnest(range(1, len(pts) + 1)) AS k FROM good)""",
    "p2_profile_values": f"WITH RECURSIVE {_PROFILE} SELECT * FROM leaves",
    "p3_found": f"""WITH {_FIELDS}
SELECT feed, file_no, field_name, 'added' AS change FROM w WHERE seq > 1 AND coalesce(ps, 0) <> seq - 1
UNION ALL SELECT feed, nxt, field_name, 'removed' FROM w WHERE nxt IS NOT NULL AND coalesce(ns, 0) <> seq + 1
UNION ALL SELECT feed, file_no, field_name, 'renamed' FROM w WHERE ps = seq - 1 AND sp <> psp
UNION ALL SELECT feed, file_no, field_name, 'retyped' FROM w WHERE ps = seq - 1 AND nullif(ty, '') <> pty""",
    "p3_versions": f"""WITH {_FIELDS}, m AS (SELECT f.feed, f.file_no, sha256(coalesce(array_to_string(list_sort(list(field_name || ':' || sp || ':' || coalesce(ty, '')) FILTER (field_name IS NOT NULL)), '|'), '')) AS fingerprint, count(field_name) AS n_fields
  FROM files f LEFT JOIN ff ON ff.feed = f.feed AND ff.file_no = f.file_no GROUP BY ALL),
v AS (SELECT feed, fingerprint, row_number() OVER (PARTITION BY feed ORDER BY min(file_no))::INT AS version FROM m GROUP BY feed, fingerprint)
SELECT m.feed, m.file_no, v.version, m.fingerprint, m.n_fields FROM m JOIN v ON v.feed = m.feed AND v.fingerprint = m.fingerprint""",
    "p3_steps": f"""WITH {_FIELDS}, m AS (SELECT feed, file_no, sha256(array_to_string(list_sort(list(field_name || ':' || sp || ':' || coalesce(ty, ''))), '|')) AS fingerprint FROM ff GROUP BY ALL)
SELECT DISTINCT fingerprint, field_name, sp AS spellings, coalesce(ty, '') AS types FROM ff JOIN m USING (feed, file_no)""",
    "p4_found": """WITH r AS (SELECT j.*, s.state FROM jobs j JOIN scan_runs s USING (run_no)),
cur AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source_path, stage ORDER BY run_no DESC, job_row_id DESC) AS rn FROM r WHERE state = 'open') WHERE rn = 1),
com AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source_path, stage ORDER BY run_no DESC, job_row_id DESC) AS rn FROM r WHERE state = 'success') WHERE rn = 1)
SELECT cur.source_path, cur.stage FROM cur LEFT JOIN com ON cur.source_path IS NOT DISTINCT FROM com.source_path AND cur.stage IS NOT DISTINCT FROM com.stage
WHERE com.job_row_id IS NULL OR com.status IS DISTINCT FROM 'success' OR com.source_size IS DISTINCT FROM cur.source_size OR com.source_mtime_ns IS DISTINCT FROM cur.source_mtime_ns""",
}

"""Queries over the driver's tables for the engine's own operators, each with its SQL.

Job rows, task rows and page rows are the tables as they are; where an operator
needs facts the tables lack (does a file exist, is it valid), both sides derive them
from row numbers by the same rule.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quirework.functions import geometry, names, paths
from quirework.operators import fold, matching, nested, planning, progress, reporting, retry, validate
from quirework.session import read_table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return register


def latest(spark: SparkSession, d: str) -> DataFrame:
    """The job table as it stands: the last row of every (source_path, stage)."""
    w = Window.partitionBy("source_path", "stage").orderBy(F.desc("run_no"), F.desc("job_row_id"))
    return read_table(spark, d, "jobs").withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


NOW = "now_ AS (SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY source_path, stage ORDER BY run_no DESC, job_row_id DESC) AS rn FROM jobs) WHERE rn = 1)"
BLANK_RE = r"^[\s\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]*$"


def _canonical_sql(c: str) -> str:
    from quirework.plans.data_problems import _canonical

    return _canonical(c)


# ------------------------------------------------------------ reports


@query(f"WITH {NOW} SELECT status, count(*) AS n FROM now_ GROUP BY status")
def q01_status_counts(spark, d):
    return reporting.status_counts(latest(spark, d))


@query(f"WITH {NOW} SELECT stage, status, count(*) AS n FROM now_ GROUP BY stage, status")
def q02_stage_status_matrix(spark, d):
    return reporting.stage_status(latest(spark, d))


@query("SELECT error_class, n, row_number() OVER (ORDER BY n DESC, error_class)::INT AS rank FROM (SELECT error_class, count(*) AS n FROM jobs WHERE error_class <> '' GROUP BY 1)")
def q03_error_class_rank(spark, d):
    return reporting.error_classes(read_table(spark, d, "jobs"))


@query("""SELECT count(*) AS total, coalesce(sum(retry_count), 0)::BIGINT AS retry_total, coalesce(sum(duration_s), 0.0) AS duration_total_s,
  count(*) FILTER (coalesce(intended_result_path, '') <> '') AS with_target, count(*) FILTER (coalesce(execution_profile_json, '') <> '') AS with_profile FROM jobs""")
def q04_totals(spark, d):
    return reporting.totals(read_table(spark, d, "jobs"))


@query(f"WITH {NOW} SELECT source_path, stage, status, retry_count, error_class FROM now_ WHERE status = 'success' AND stage = 'ocr' ORDER BY source_path, stage LIMIT 50 OFFSET 20")
def q05_jobs_page(spark, d):
    page = reporting.jobs_page(latest(spark, d), limit=50, offset=20, status="success", stage="ocr")
    return page.select("source_path", "stage", "status", "retry_count", "error_class")


@query("""SELECT run_no, count(*) AS n, count(intended_result_path) AS targets, count(execution_profile_json) AS profiles FROM (
  SELECT run_no, coalesce(CASE WHEN run_no > 3 THEN intended_result_path END, result_path) AS intended_result_path, CASE WHEN run_no > 3 THEN execution_profile_json END AS execution_profile_json FROM jobs) GROUP BY run_no""")
def q06_legacy_columns(spark, d):
    jobs = read_table(spark, d, "jobs")
    old = jobs.where("run_no <= 3").drop("intended_result_path", "execution_profile_json")
    runs = []
    for part in (old, jobs.where("run_no > 3")):
        # the run number is no column of the job table: carried beside it in the worker column's place
        tagged = part.withColumn("worker", F.col("run_no").cast("string"))
        runs.append(reporting.with_all_columns(tagged, backfill=True).withColumn("run_no", F.col("worker").cast("int")))
    return runs[0].unionByName(runs[1]).groupBy("run_no").agg(F.count(F.lit(1)).alias("n"), F.count("intended_result_path").alias("targets"), F.count("execution_profile_json").alias("profiles"))


# ------------------------------------------------------------ names, matching, orders

IMAGES = r"images AS (SELECT DISTINCT regexp_replace(regexp_replace(source, '/[^/]*$', ''), '^/scan/work/', '') AS dir, regexp_extract(source, '([^/]*)$', 1) AS name FROM ocr_tasks WHERE source IS NOT NULL)"


def _images(spark, d):
    src = read_table(spark, d, "ocr_tasks").where("source IS NOT NULL").select("source").distinct()
    return src.select(F.regexp_replace(paths.parent_dir("source"), "^/scan/work/", "").alias("dir"), paths.base_name("source").alias("name")).distinct()


def _results(spark, d):
    out = read_table(spark, d, "ocr_tasks").where("payload IS NOT NULL").select(paths.canonical_path("output_json").alias("path")).distinct()
    return out.select(F.regexp_replace(F.regexp_replace(paths.parent_dir("path"), "^/scan/out/", ""), "/ocr$", "").alias("dir"), paths.base_name("path").alias("name"))


CANDIDATES = r"""n AS (SELECT *, try_cast(nullif(regexp_extract(name, 'page_([0-9]+)', 1, 'i'), '') AS BIGINT) AS k, regexp_replace(name, '(.)\.[^./]*$', '\1') AS stem FROM images),
lists AS (SELECT dir, name, list_concat(CASE WHEN k IS NULL THEN [] ELSE [printf('page_%05d.json', k), printf('page_%04d_result.json', k), printf('page_%04d.json', k), printf('page_%03d.json', k)] END,
   [stem || '_result.json', stem || '.json', stem || '_ocr.json']) AS l FROM n),
cands AS (SELECT dir, name, unnest(range(1, len(l) + 1)) AS i, list_filter(l, lambda x, i: list_position(l, x) = i) AS l FROM lists),
c AS (SELECT dir, name, (i - 1)::INT AS pos, l[i] AS candidate FROM cands WHERE i <= len(l))"""
RESULTS = f"results AS (SELECT DISTINCT regexp_replace(regexp_replace(regexp_replace(p, '/[^/]*$', ''), '^/scan/out/', ''), '/ocr$', '') AS dir, regexp_extract(p, '([^/]*)$', 1) AS name FROM (SELECT {_canonical_sql('output_json')} AS p FROM ocr_tasks WHERE payload IS NOT NULL))"


@query(f"WITH {IMAGES}, {CANDIDATES} SELECT dir, name, pos, candidate FROM c")
def q07_candidate_names(spark, d):
    return _images(spark, d).select("dir", "name", F.posexplode(names.candidate_names("name")).alias("pos", "candidate"))


@query(f"WITH {IMAGES}, {CANDIDATES}, {RESULTS} SELECT i.dir, i.name, m.result_name FROM images i LEFT JOIN (SELECT c.dir, c.name, arg_min(candidate, pos) AS result_name FROM c JOIN results r ON c.dir = r.dir AND c.candidate = r.name GROUP BY ALL) m ON i.dir = m.dir AND i.name = m.name")
def q08_priority_match(spark, d):
    return matching.match_results(_images(spark, d), _results(spark, d))


@query(f"WITH {IMAGES}, {CANDIDATES}, {RESULTS} SELECT dir, name FROM images i WHERE NOT EXISTS (SELECT 1 FROM c JOIN results r ON c.dir = r.dir AND c.candidate = r.name WHERE c.dir = i.dir AND c.name = i.name)")
def q09_missing_results(spark, d):
    return matching.missing_results(_images(spark, d), _results(spark, d))


@query("""WITH c AS (SELECT source_path, page_no, count(*) AS n FROM page_results WHERE page_no IS NOT NULL GROUP BY ALL),
p AS (SELECT source_path, count(*)::INT AS n_pages, max(n) AS most, min(page_no) AS first, max(page_no)::BIGINT AS last_page, list(page_no) AS have FROM c GROUP BY 1),
g AS (SELECT *, list_filter(range(1, greatest(last_page, 1) + 1), lambda x: NOT list_contains(have, x::INT)) AS gaps FROM p)
SELECT source_path, CASE WHEN first < 1 THEN 'invalid' WHEN most > 1 THEN 'duplicate' WHEN len(gaps) > 0 THEN 'gap' ELSE 'ok' END AS status, n_pages, last_page,
  array_to_string(gaps[1:10], ', ') || CASE WHEN len(gaps) > 10 THEN '...' ELSE '' END AS missing FROM g""")
def q10_page_sequences(spark, d):
    return validate.page_sequences(read_table(spark, d, "page_results"), "source_path", "page_no")


@query("""SELECT coalesce(e.source_path, a.source_path) AS source_path, coalesce(e.page_no, a.page_no) AS page_no, CASE WHEN a.page_no IS NULL THEN 'missing' ELSE 'extra' END AS side
FROM (SELECT DISTINCT source_path, page_no FROM ocr_pages) e FULL JOIN (SELECT DISTINCT source_path, page_no::BIGINT AS page_no FROM page_results) a ON e.source_path = a.source_path AND e.page_no = a.page_no
WHERE e.page_no IS NULL OR a.page_no IS NULL""")
def q11_expected_vs_actual(spark, d):
    actual = read_table(spark, d, "page_results").withColumn("page_no", F.col("page_no").cast("bigint"))
    return validate.expected_against_actual(read_table(spark, d, "ocr_pages"), actual, ["source_path", "page_no"])


@query(f"WITH t AS (SELECT task_id, {_canonical_sql('output_json')} AS output FROM ocr_tasks), w AS (SELECT *, row_number() OVER x AS n, first_value(task_id) OVER x AS first_owner FROM t WINDOW x AS (PARTITION BY output ORDER BY task_id)) SELECT task_id, output, first_owner FROM w WHERE n > 1")
def q12_output_collisions(spark, d):
    tasks = read_table(spark, d, "ocr_tasks").select("task_id", paths.canonical_path("output_json").alias("output"))
    return matching.output_collisions(tasks, "output", "task_id")


@query("""WITH r AS (SELECT DISTINCT regexp_replace(source, '^/scan/', '') AS rel FROM ocr_tasks WHERE source IS NOT NULL),
k AS (SELECT rel, split_part(rel, '/', 1) || '/' || split_part(rel, '/', 2) AS root, str_split(rel, '/') AS parts FROM r)
SELECT rel, row_number() OVER (PARTITION BY root ORDER BY list_transform(parts, lambda x, i: {'a': CASE WHEN i = len(parts) THEN 0 ELSE 1 END, 'b': x}))::INT AS walk_no FROM k""")
def q13_walk_order(spark, d):
    rel = read_table(spark, d, "ocr_tasks").where("source IS NOT NULL").select(F.regexp_replace("source", "^/scan/", "").alias("rel")).distinct()
    root = F.array_join(F.slice(F.split("rel", "/"), 1, 2), "/")
    return rel.select("rel", F.row_number().over(Window.partitionBy(root).orderBy(names.walk_key("rel"))).alias("walk_no"))


@query("""WITH k AS (SELECT p_partkey, p_brand, list_transform(regexp_extract_all(p_name, '([0-9]+|[^0-9]+)'), lambda r: {'k': CASE WHEN regexp_matches(r, '^[0-9]') THEN 0 ELSE 1 END, 'n': try_cast(r AS HUGEINT), 't': r}) AS key FROM part)
SELECT p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY key, p_partkey)::INT AS place FROM k""")
def q14_natural_sort(spark, d):
    w = Window.partitionBy("p_brand").orderBy(names.natural_key("p_name"), "p_partkey")
    return read_table(spark, d, "part").select("p_partkey", F.row_number().over(w).alias("place"))


LEAF = "CASE p_partkey % 8 WHEN 0 THEN 'cov001' WHEN 1 THEN 'Bok' || p_partkey WHEN 2 THEN 'leg' || p_partkey WHEN 3 THEN 'fow' || p_partkey WHEN 4 THEN '!' || p_partkey WHEN 5 THEN (p_partkey % 97) || '_' || p_partkey WHEN 6 THEN 'cov002' ELSE 'z' || p_partkey END"


@query(f"""WITH l AS (SELECT p_partkey, p_brand, lower({LEAF}) AS leaf FROM part),
k AS (SELECT *, CASE WHEN leaf LIKE 'cov001%' THEN -1 WHEN leaf LIKE 'bok%' THEN 0 WHEN leaf LIKE 'leg%' THEN 1 WHEN leaf LIKE 'fow%' THEN 2 WHEN leaf LIKE '!%' THEN 3 WHEN regexp_matches(leaf, '^[0-9]') THEN 4 WHEN leaf LIKE 'cov002%' THEN 5 ELSE 6 END AS r,
  coalesce(try_cast(nullif(regexp_extract(leaf, '^([0-9]+)', 1), '') AS BIGINT), 0) AS n,
  list_transform(regexp_extract_all(leaf, '([0-9]+|[^0-9]+)'), lambda r: {{'k': CASE WHEN regexp_matches(r, '^[0-9]') THEN 0 ELSE 1 END, 'n': try_cast(r AS HUGEINT), 't': r}}) AS nat FROM l)
SELECT p_partkey, r::INT AS leaf_rank, row_number() OVER (PARTITION BY p_brand ORDER BY r, n, nat, p_partkey)::INT AS place FROM k""")
def q15_book_order(spark, d):
    leaves = read_table(spark, d, "part").withColumn("leaf", F.expr(LEAF))
    w = Window.partitionBy("p_brand").orderBy(names.book_key("leaf"), "p_partkey")
    return leaves.select("p_partkey", names.book_rank("leaf").alias("leaf_rank"), F.row_number().over(w).alias("place"))


# ------------------------------------------------------------ geometry


def _lines(spark, d):
    lines = read_table(spark, d, "ocr_lines").withColumn("polygon", F.transform("polygon", lambda p: F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y"))))
    return lines


@query(f"""WITH l AS (SELECT line_id, l.page_id, line_no, list_min(list_transform(polygon, lambda p: p[1])) >= p.width / 2 AS r, list_min(list_transform(polygon, lambda p: p[2])) AS y
  FROM ocr_lines l JOIN ocr_pages p ON l.page_id = p.page_id WHERE text IS NOT NULL AND NOT regexp_matches(text, '{BLANK_RE}'))
SELECT line_id, row_number() OVER (PARTITION BY page_id ORDER BY r, y, line_no, line_id)::INT AS reading_no FROM l""")
def q16_reading_order(spark, d):
    lines = _lines(spark, d).select("line_id", "page_id", "text", "polygon", F.struct("line_no", "line_id").alias("line_no"))
    lines = lines.where("text IS NOT NULL").join(read_table(spark, d, "ocr_pages").select("page_id", "width"), "page_id")
    return geometry.reading_order(lines, ["page_id"]).select("line_id", "reading_no")


@query("""SELECT line_id, trunc(polygon[1][1] * 1.5)::BIGINT AS x0, trunc(polygon[1][2] * 0.5)::BIGINT + 3 AS y0, trunc(polygon[3][1] * 1.5)::BIGINT AS x1, trunc(polygon[3][2] * 0.5)::BIGINT + 3 AS y1 FROM ocr_lines WHERE polygon IS NOT NULL""")
def q17_text_rect(spark, d):
    rect = geometry.text_rect("polygon", 1.5, 0.5, 3)
    return _lines(spark, d).where("polygon IS NOT NULL").select("line_id", rect.alias("r")).select("line_id", "r.*")


@query("""WITH c AS (SELECT vec_id, list_transform(embedding[1:(CASE WHEN vec_id % 3 = 0 THEN 4 WHEN vec_id % 3 = 1 THEN 8 ELSE 6 END)], lambda x: x::DOUBLE * 100) AS c FROM embeddings),
e AS (SELECT vec_id, 'extent' AS mode, CASE len(c) WHEN 8 THEN [list_min([c[1], c[3], c[5], c[7]]), list_min([c[2], c[4], c[6], c[8]]), list_max([c[1], c[3], c[5], c[7]]), list_max([c[2], c[4], c[6], c[8]])] WHEN 4 THEN c END AS b FROM c),
t AS (SELECT vec_id, len(c) AS k, list_transform(c, lambda x: trunc(x)) AS c FROM c),
k AS (SELECT vec_id, 'corners' AS mode, CASE k WHEN 8 THEN [least(c[1], c[7]), least(c[2], c[4]), greatest(c[3], c[5]), greatest(c[6], c[8])] WHEN 4 THEN c END AS b FROM t),
u AS (SELECT vec_id, mode, b[1] * 2 AS x0, b[2] * 0.5 AS y0, b[3] * 2 AS x1, b[4] * 0.5 AS y1 FROM (SELECT * FROM e UNION ALL SELECT * FROM k) WHERE b IS NOT NULL)
SELECT * FROM u WHERE x1 > x0 AND y1 > y0""")
def q18_char_boxes(spark, d):
    n = F.when(F.col("vec_id") % 3 == 0, 4).when(F.col("vec_id") % 3 == 1, 8).otherwise(6)
    vectors = read_table(spark, d, "embeddings").select("vec_id", F.transform(F.slice("embedding", F.lit(1), n), lambda x: x.cast("double") * 100).alias("c"))
    boxes = [vectors.select("vec_id", F.lit(m).alias("mode"), geometry.char_box(F.col("c"), m, F.lit(2.0), F.lit(0.5)).alias("b")) for m in ("extent", "corners")]
    return boxes[0].unionByName(boxes[1]).where("b IS NOT NULL").select("vec_id", "mode", "b.*")


@query("""WITH l AS (SELECT line_id, length(text) AS n, polygon[3][1] - polygon[1][1] AS w, polygon[3][2] - polygon[1][2] AS h FROM ocr_lines WHERE polygon IS NOT NULL AND text IS NOT NULL)
SELECT line_id, greatest(1.0::DOUBLE, least(100.0::DOUBLE, coalesce(list_filter(list_transform(range(0, 201), lambda i: h * 0.9::DOUBLE - i), lambda s: s <= 1 OR n * s <= w)[1], 1.0::DOUBLE))) AS size FROM l""")
def q19_font_size(spark, d):
    lines = _lines(spark, d).where("polygon IS NOT NULL AND text IS NOT NULL")
    p = F.col("polygon")
    width, height = F.get(p, F.lit(2))["x"] - F.get(p, F.lit(0))["x"], F.get(p, F.lit(2))["y"] - F.get(p, F.lit(0))["y"]
    return lines.select("line_id", geometry.font_size(F.col("text"), width, height).alias("size"))


@query("""WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: abs(x::DOUBLE) * 255) AS p FROM embeddings),
t AS (SELECT vec_id, p, greatest(0.0::DOUBLE, least(255.0::DOUBLE, list_avg(p) - list_aggregate(p, 'stddev_pop') / 2)) AS t FROM v)
SELECT vec_id, round(t, 6) AS threshold, len(list_filter(p, lambda x: x > t))::INT AS white FROM t""")
def q20_threshold(spark, d):
    pixels = read_table(spark, d, "embeddings").select("vec_id", F.transform("embedding", lambda x: F.abs(x.cast("double")) * 255).alias("p"))
    return pixels.select("vec_id", F.round(geometry.threshold(F.col("p")), 6).alias("threshold"), F.size(F.filter(geometry.binarise(F.col("p")), lambda x: x == 255)).alias("white"))


def _pages_sql() -> str:
    from quirework.plans.data_problems import _PAGES

    return f"""WITH {_PAGES}
SELECT t.page_id, n.tf AS text_field, CASE WHEN n.p IS NOT NULL THEN n.pf END AS polygon_field,
  CASE WHEN n.p IS NULL OR json_type(n.p) <> 'OBJECT' THEN 'root' WHEN n.tf IS NULL THEN 'text' WHEN json_type(t.g) IS DISTINCT FROM 'ARRAY' THEN 'polygons' WHEN json_type(t.t) IS DISTINCT FROM 'ARRAY' THEN 'texts'
       WHEN len(json_extract(t.t, '$[*]')) <> len(json_extract(t.g, '$[*]')) THEN 'count' WHEN t.page_id IN (SELECT page_id FROM judged WHERE NOT coalesce(good, false)) THEN 'line' ELSE 'ok' END AS verdict
FROM taken t JOIN named n ON t.page_id = n.page_id"""


@query(_pages_sql())
def q21_page_verdicts(spark, d):
    pages = nested.normalise_pages(read_table(spark, d, "page_results"), "page_id", "page_json")
    e = F.col("error")
    verdict = (
        F.when(e.isNull(), "ok").when(e.startswith("root"), "root").when(e.startswith("text field"), "text")
        .when(e.endswith("missing or not an array"), "polygons").when(e.endswith("is not an array"), "texts").when(e.startswith("polygon/text"), "count").otherwise("line")
    )
    return pages.select("page_id", "text_field", "polygon_field", verdict.alias("verdict"))


# ------------------------------------------------------------ job state and plans


def job_events(jobs: DataFrame) -> DataFrame:
    """The operations that a listed job row stands for, in order."""
    ops = F.when(F.col("status") == "success", F.array(F.lit("started"), F.lit("success"))).when(F.col("status") == "failed", F.array(F.lit("started"), F.lit("failure"))).when(F.col("status") == "running", F.array(F.lit("started"))).otherwise(F.array(F.lit("needs_run")))
    rows = jobs.select("*", F.posexplode(ops).alias("_i", "op"))
    return rows.select(
        "source_path", "stage", (F.col("run_no").cast("bigint") * 1_000_000_000_000 + F.col("job_row_id") * 2 + F.col("_i")).alias("seq"), "op", F.col("source_size").alias("size"), F.col("source_mtime_ns").alias("mtime_ns"),
        F.col("intended_result_path").alias("req_result"), F.col("execution_profile_json").alias("req_profile"), F.col("result_path").alias("result"), "worker", "device",
        F.col("error_class").alias("err_class"), F.col("error_message").alias("err_msg"), "duration_s", F.coalesce("finished_at", "started_at").alias("at"),
    )


def _fold_sql() -> str:
    ops = {"started": "x.op = 'started'", "success": "x.op = 'success'", "failure": "x.op = 'failure'"}
    fresh = "(a.status IS NULL OR a.size <> x.size OR a.mtime_ns <> x.mtime_ns OR (x.op <> 'success' AND (coalesce(a.intended <> x.req_result, false) OR coalesce(a.profile <> x.req_profile, false))))"
    want = {"intended": "CASE WHEN x.op <> 'success' THEN x.req_result END", "profile": "CASE WHEN x.op <> 'success' THEN x.req_profile END"}
    base = {f: f"CASE WHEN {fresh} THEN NULL ELSE a.{f} END" for f in fold.FIELDS}
    base["size"], base["mtime_ns"] = (f"CASE WHEN {fresh} THEN x.{f} ELSE a.{f} END" for f in ("size", "mtime_ns"))
    base["status"], base["retry_count"] = f"CASE WHEN {fresh} THEN 'pending' ELSE a.status END", f"CASE WHEN {fresh} THEN 0 ELSE a.retry_count END"
    for f, w in want.items():
        base[f] = f"CASE WHEN {fresh} THEN coalesce({w}, a.{f}) WHEN a.status <> 'success' THEN coalesce(a.{f}, {w}) ELSE a.{f} END"
    after = {
        "status": ("'running'", "'success'", "'failed'"), "result_path": ("NULL", "x.result", "NULL"), "retry_count": (None, None, f"({base['retry_count']}) + 1"),
        "error_class": ("NULL", "NULL", "x.err_class"), "error_message": ("NULL", "NULL", "x.err_msg"), "worker": ("x.worker", None, None), "device": ("x.device", None, None), "started_at": ("x.moment", None, None),
        "finished_at": ("NULL", "x.moment", "x.moment"), "duration_s": ("NULL", "x.duration_s", "x.duration_s"),
        "intended": (f"coalesce(x.req_result, {base['intended']})", f"coalesce({base['intended']}, x.result)", None), "profile": (f"coalesce(x.req_profile, {base['profile']})", None, None),
    }
    kinds = {"bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE"}
    parts = []
    for f in fold.FIELDS:
        cases = " ".join(f"WHEN {cond} THEN {v}" for cond, v in zip(ops.values(), after.get(f, (None,) * 3)) if v is not None)
        value = f"CASE {cases} ELSE {base[f]} END" if cases else base[f]
        parts.append(f"'{f}': CAST({value} AS {kinds[fold.TYPES[f]]})")
    init = ", ".join(f"'{f}': CAST(NULL AS {kinds[fold.TYPES[f]]})" for f in fold.FIELDS)
    return f"""WITH o AS (SELECT *, unnest(CASE status WHEN 'success' THEN ['started', 'success'] WHEN 'failed' THEN ['started', 'failure'] WHEN 'running' THEN ['started'] ELSE ['needs_run'] END) AS op FROM jobs),
e AS (SELECT source_path, stage, run_no::BIGINT * 1000000000000 + job_row_id * 2 + CASE WHEN op IN ('success', 'failure') THEN 1 ELSE 0 END AS seq, op, source_size AS size, source_mtime_ns AS mtime_ns, intended_result_path AS req_result, execution_profile_json AS req_profile,
  result_path AS result, worker, device, error_class AS err_class, error_message AS err_msg, duration_s, coalesce(finished_at, started_at) AS moment FROM o),
h AS (SELECT source_path, stage, list({{'op': op, 'size': size, 'mtime_ns': mtime_ns, 'req_result': req_result, 'req_profile': req_profile, 'result': result, 'worker': worker, 'device': device, 'err_class': err_class, 'err_msg': err_msg, 'duration_s': duration_s, 'moment': moment}} ORDER BY seq) AS l FROM e GROUP BY ALL),
s AS (SELECT source_path, stage, list_reduce(l, lambda a, x: {{{', '.join(parts)}}}, {{{init}}}) AS s FROM h)
SELECT source_path, stage, {', '.join(f's.{f} AS {f}' for f in fold.FIELDS)} FROM s"""


@query(_fold_sql())
def q22_fold_state(spark, d):
    return fold.fold(job_events(read_table(spark, d, "jobs")))


MODES = "modes AS (SELECT unnest([true, true, false, false]) AS resume, unnest([true, false, true, false]) AS overwrite)"


def _in_every_mode(df: DataFrame) -> DataFrame:
    """Each row with all four settings of ``resume`` and ``overwrite``."""
    modes = F.array(*[F.struct(F.lit(r).alias("resume"), F.lit(o).alias("overwrite")) for r in (True, False) for o in (True, False)])
    return df.select("*", F.inline(modes))


@query(f"""WITH {MODES}, {NOW},
tasks AS (SELECT DISTINCT source, {_canonical_sql('output_json')} AS output_json FROM ocr_tasks),
ex AS (SELECT {_canonical_sql('output_json')} AS path, bool_and(coalesce(json_type(try_cast(payload AS JSON)) = 'OBJECT', false)) AS valid FROM ocr_tasks WHERE payload IS NOT NULL GROUP BY 1),
j AS (SELECT source_path, status, result_path FROM now_ WHERE stage = 'ocr'),
f AS (SELECT m.resume AS r, m.overwrite AS o, e.path IS NOT NULL AS e, coalesce(e.valid, false) AS v, j.status IS NOT NULL AS k,
   (coalesce(j.status, '') <> 'success' OR (coalesce(j.result_path, '') <> '' AND r.path IS NULL)) AS n
   FROM modes m, tasks t LEFT JOIN j ON t.source = j.source_path LEFT JOIN ex e ON t.output_json = e.path LEFT JOIN ex r ON j.result_path = r.path),
d AS (SELECT *, CASE WHEN e AND r AND NOT k AND v THEN 1 WHEN e AND r AND NOT k THEN 2 WHEN e AND r AND NOT n AND v THEN 3 WHEN e AND r AND NOT n THEN 4 WHEN e AND NOT o AND k AND n THEN 5 WHEN e AND NOT o THEN 6 ELSE 7 END AS rule FROM f)
SELECT r AS resume, o AS overwrite, rule, CASE WHEN rule IN (1, 3) THEN 'skipped' WHEN rule = 7 THEN 'run' ELSE 'failed' END AS outcome, count(*) AS n FROM d GROUP BY ALL""")
def q23_ocr_plan(spark, d):
    t = read_table(spark, d, "ocr_tasks").withColumn("output_json", paths.canonical_path("output_json"))
    tasks = _in_every_mode(t.select("source", "output_json").distinct())
    valid = F.coalesce(F.expr("schema_of_variant(try_parse_json(payload)) LIKE 'OBJECT%'"), F.lit(False))
    existing = t.where("payload IS NOT NULL").groupBy(F.col("output_json").alias("path")).agg(F.min(valid).alias("valid"))
    planned = planning.plan_ocr(tasks, latest(spark, d), existing, "resume", "overwrite")
    return planned.groupBy("resume", "overwrite", "decision.rule", "decision.outcome").agg(F.count(F.lit(1)).alias("n"))


FACTS = "job_row_id % 3 <> 0 AS e, job_row_id % 5 <> 0 AS v, run_no > 4 AS k, (status <> 'success' OR job_row_id % 7 = 0) AS n, job_row_id % 4 = 0 AS f"


def _facts(spark, d, stage):
    rows = read_table(spark, d, "jobs").where(F.col("stage") == stage).selectExpr(*[x.strip() for x in FACTS.split(", ")])
    return _in_every_mode(rows)


@query(f"""WITH {MODES}, x AS (SELECT {FACTS}, m.resume AS r, m.overwrite AS o FROM jobs, modes m WHERE stage = 'render'),
d AS (SELECT *, CASE WHEN e AND r AND NOT k AND v THEN 1 WHEN e AND r AND NOT k AND NOT v AND NOT o THEN 2 WHEN e AND r AND NOT n AND v THEN 3 WHEN e AND r AND NOT n AND NOT v AND NOT o THEN 4 WHEN e AND NOT o THEN 5 ELSE 6 END AS rule FROM x)
SELECT r AS resume, o AS overwrite, rule, count(*) AS n FROM d GROUP BY ALL""")
def q24_render_plan(spark, d):
    rows = _facts(spark, d, "render").withColumn("d", planning.render_decision("e", "v", "k", "n", "resume", "overwrite"))
    return rows.groupBy("resume", "overwrite", "d.rule").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {MODES}, x AS (SELECT {FACTS}, m.resume AS r, m.overwrite AS o FROM jobs, modes m WHERE stage = 'searchable_pdf'),
d AS (SELECT *, CASE WHEN e AND r AND NOT k AND NOT f AND v THEN 1 WHEN e AND r AND NOT k AND NOT f AND NOT v AND NOT o THEN 2 WHEN e AND f AND NOT o THEN 3 WHEN e AND f THEN 7
  WHEN e AND r AND NOT n AND v THEN 4 WHEN e AND r AND NOT n AND NOT v AND NOT o THEN 5 WHEN e AND NOT o THEN 6 ELSE 7 END AS rule FROM x)
SELECT r AS resume, o AS overwrite, rule, count(*) AS n FROM d GROUP BY ALL""")
def q25_searchable_plan(spark, d):
    rows = _facts(spark, d, "searchable_pdf").withColumn("d", planning.searchable_decision("e", "v", "k", "n", "f", "resume", "overwrite"))
    return rows.groupBy("resume", "overwrite", "d.rule").agg(F.count(F.lit(1)).alias("n"))


#: Facts about files, by rule from the row number.
RETRY_FACTS = [
    "CASE WHEN job_row_id % 11 = 0 THEN NULL WHEN job_row_id % 13 = 0 THEN true ELSE false END AS s_dir",
    "job_row_id % 17 = 0 AS s_linked",
    "source_size + CASE WHEN job_row_id % 19 = 0 THEN 1 ELSE 0 END AS s_size",
    "source_mtime_ns + CASE WHEN job_row_id % 23 = 0 THEN 1 ELSE 0 END AS s_mtime",
    "CASE WHEN job_row_id % 7 = 0 THEN stage = 'render' END AS t_dir",
    "job_row_id % 29 = 0 AS t_linked",
]


def _retry_sql() -> str:
    whole = lambda k: f"CASE WHEN json_type(p, '$.{k}') IN ('BIGINT', 'UBIGINT') THEN (p ->> '$.{k}')::BIGINT END"
    kind = lambda k: f"coalesce(json_type(p, '$.{k}'), '-')"
    text = lambda k: f"(p ->> '$.{k}')"
    keys = lambda path: f"list_sort(json_keys(p, '{path}'))"
    listed = lambda ks: "[" + ", ".join(f"'{k}'" for k in sorted(ks)) + "]"
    rules = lambda *rs: "CASE " + " ".join(f"WHEN NOT coalesce({ok}, false) THEN '{why}'" for ok, why in rs) + " END"
    ocr = rules(
        (f"{whole('schema')} = 2 AND {text('kind')} = 'paddlex_ocr'", "unsupported recognition profile"), (f"{kind('pipeline')} = 'OBJECT'", "no pipeline identity"),
        (f"{text('pipeline.type')} = 'file'", "the pipeline is no local file"), (f"{kind('pipeline.path')} = 'VARCHAR' AND {text('pipeline.path')} <> ''", "no pipeline path"),
        (f"{kind('pipeline.sha256')} = 'VARCHAR' AND length({text('pipeline.sha256')}) = 64", "no pipeline checksum"), (f"{whole('pipeline.size')} >= 0", "no pipeline size"),
        (f"{kind('device')} = 'VARCHAR' AND {text('device')} <> ''", "no device"), (f"{text('device')} NOT IN ('auto', 'gpu')", "the device is not explicit"),
        (f"{text('device')} = 'cpu' OR regexp_matches({text('device')}, '^gpu:[0-9]+$')", "unsupported device"), (f"{kind('engine')} IN ('VARCHAR', 'NULL', '-')", "the engine is neither text nor null"),
        (f"{kind('use_hpip')} IN ('BOOLEAN', 'NULL', '-')", "use_hpip is neither true, false nor null"), (f"{kind('predict')} = 'OBJECT'", "no predict options"),
        (f"{keys('$.predict')} = {listed(retry.PREDICT)}", "wrong set of predict options"), (" AND ".join(f"{kind('predict.' + k)} = 'BOOLEAN'" for k in retry.PREDICT), "a predict option is no boolean"),
    )
    render = rules(
        (f"{keys('$')} = {listed(('schema', 'kind', 'dpi', 'format', 'alpha'))}", "wrong set of render fields"), (f"{whole('schema')} = 1 AND {text('kind')} = 'pdf_render'", "unsupported render profile"),
        (f"{whole('dpi')} BETWEEN 36 AND 1200", "the resolution is out of range"), (f"{text('format')} = 'png' AND {kind('alpha')} = 'BOOLEAN' AND {text('alpha')} = 'false'", "unsupported image format"),
    )
    doc = rules(
        (f"{keys('$')} = {listed(('schema', 'kind', 'fontname', 'y_offset', 'layout', 'images_dir', 'ocr_json_dir', 'expected_page_count'))}", "wrong set of document fields"),
        (f"{whole('schema')} = 2 AND {text('kind')} = 'searchable_pdf'", "unsupported document profile"), (f"{text('layout')} = 'legacy-v7'", "unsupported layout"), (f"{kind('fontname')} = 'VARCHAR' AND {text('fontname')} <> ''", "no font name"),
        (f"{kind('y_offset')} IN ('BIGINT', 'UBIGINT', 'DOUBLE')", "the vertical offset is no number"), (f"{whole('expected_page_count')} >= 1", "no page count"),
        (f"{kind('images_dir')} = 'VARCHAR' AND {text('images_dir')} <> ''", "no folder of images"), (f"{kind('ocr_json_dir')} = 'VARCHAR' AND {text('ocr_json_dir')} <> ''", "no folder of results"),
    )
    return f"""WITH {NOW}, x AS (SELECT *, try_cast(execution_profile_json AS JSON) AS j, {', '.join(RETRY_FACTS)} FROM now_ WHERE status = 'failed'),
y AS (SELECT *, CASE WHEN json_type(j) = 'OBJECT' THEN j END AS p, intended_result_path AS t FROM x),
z AS (SELECT *, CASE WHEN stage NOT IN ('ocr', 'render', 'searchable_pdf') THEN 'unsupported stage' WHEN s_linked THEN 'a part of the source path is a link' WHEN s_dir IS NULL THEN 'the source is gone' WHEN s_dir THEN 'the source is no file'
  WHEN s_size <> source_size THEN 'the source changed in size' WHEN s_mtime <> source_mtime_ns THEN 'the source changed in time' WHEN NOT (starts_with(source_path, '/scan/out/') OR starts_with(source_path, '/scan/in/') OR starts_with(source_path, '/scan/work/')) THEN 'the source is outside inputs and output'
  WHEN coalesce(t, '') = '' THEN 'no target path' WHEN t_linked THEN 'a part of the target path is a link' WHEN NOT starts_with(t, '/scan/out/') AND t <> '/scan/out' THEN 'the target is outside the output' WHEN t = '/scan/out' THEN 'the target is the output itself'
  WHEN t_dir IS NOT NULL THEN '{retry.EXISTS}' WHEN p IS NULL THEN 'the profile is no object' ELSE coalesce(CASE stage WHEN 'ocr' THEN {ocr} WHEN 'render' THEN {render} ELSE {doc} END,
  CASE WHEN stage = 'ocr' AND regexp_replace(t, '/[^/]*$', '') || '/' || regexp_replace(regexp_extract(source_path, '([^/]*)$', 1), '(.)\\.[^./]*$', '\\1') || '_result.json' <> t THEN 'the target is not where the result of the source goes' END) END AS reason FROM y)
SELECT source_path, stage, reason, CASE WHEN reason IS NULL THEN 'eligible' WHEN reason = '{retry.EXISTS}' THEN 'blocked' ELSE 'ineligible' END AS state FROM z"""




@query(_retry_sql())
def q26_retry_reasons(spark, d):
    failed = latest(spark, d).where("status = 'failed'").selectExpr("*", *RETRY_FACTS)
    planned = retry.decide(retry.with_profile(failed), "/scan/out", ["/scan/in", "/scan/work"])
    return planned.select("source_path", "stage", "reason", "state")


@query(f"""WITH {NOW}, p AS (SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY source_path, stage ORDER BY run_no DESC, job_row_id DESC) AS rn FROM jobs WHERE status = 'failed') WHERE rn = 1)
SELECT * FROM (SELECT p.source_path, p.stage, CASE WHEN n.status IS NULL THEN 'gone' WHEN n.status <> 'failed' THEN 'no longer failed' WHEN p.source_size IS DISTINCT FROM n.source_size OR p.source_mtime_ns IS DISTINCT FROM n.source_mtime_ns THEN 'source changed'
  WHEN p.intended_result_path IS DISTINCT FROM n.intended_result_path THEN 'target changed' WHEN p.execution_profile_json IS DISTINCT FROM n.execution_profile_json THEN 'profile changed' END AS change
  FROM p LEFT JOIN now_ n ON p.source_path = n.source_path AND p.stage = n.stage) WHERE change IS NOT NULL""")
def q27_revalidate(spark, d):
    """The last failure of every job, planned when it happened, against the table as it stands."""
    w = Window.partitionBy("source_path", "stage").orderBy(F.desc("run_no"), F.desc("job_row_id"))
    planned = read_table(spark, d, "jobs").where("status = 'failed'").withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")
    return retry.revalidate(planned, latest(spark, d)).select("source_path", "stage", "change")


@query("""WITH r AS (SELECT DISTINCT output_dir AS root FROM render_results WHERE output_dir IS NOT NULL UNION SELECT regexp_replace(source, '/[^/]*$', '') FROM ocr_tasks WHERE source IS NOT NULL),
t AS (SELECT DISTINCT intended_result_path AS p FROM jobs WHERE intended_result_path IS NOT NULL), a AS (SELECT p, unnest(list_transform(range(1, len(string_split(p, '/')) + 1), lambda n: array_to_string(string_split(p, '/')[1:n], '/'))) AS up FROM t)
SELECT DISTINCT p AS intended_result_path FROM a JOIN r ON a.up = rtrim(r.root, '/')""")
def q28_containment(spark, d):
    """Targets that lie in a folder of images or of rendered pages."""
    rendered = read_table(spark, d, "render_results").where("output_dir IS NOT NULL").select(F.col("output_dir").alias("root"))
    images = read_table(spark, d, "ocr_tasks").where("source IS NOT NULL").select(paths.parent_dir("source").alias("root"))
    targets = read_table(spark, d, "jobs").where("intended_result_path IS NOT NULL").select("intended_result_path").distinct()
    return matching.within_roots(targets, rendered.unionByName(images), "intended_result_path")


RENDER_144 = '{"alpha":false,"dpi":144,"format":"png","kind":"pdf_render","schema":1}'


@query(f"WITH {NOW} SELECT source_path, execution_profile_json <> '{RENDER_144}' AS stale FROM now_ WHERE stage = 'render' AND execution_profile_json IS NOT NULL")
def q29_stale_profiles(spark, d):
    rows = latest(spark, d).where("stage = 'render' AND execution_profile_json IS NOT NULL")
    wanted = F.to_json(F.named_struct(F.lit("alpha"), F.lit(False), F.lit("dpi"), F.lit(144), F.lit("format"), F.lit("png"), F.lit("kind"), F.lit("pdf_render"), F.lit("schema"), F.lit(1)))
    return rows.select("source_path", (F.col("execution_profile_json") != wanted).alias("stale"))


@query("SELECT sha256(text) AS sha256, count(*) AS n, min(doc_id) AS first_doc FROM documents WHERE text IS NOT NULL GROUP BY 1")
def q30_content_identity(spark, d):
    return read_table(spark, d, "documents").where("text IS NOT NULL").groupBy(F.sha2("text", 256).alias("sha256")).agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_doc"))


# ------------------------------------------------------------ progress, folders, small scalars


@query("""WITH f AS (SELECT run_no, job_row_id, finished_at::TIMESTAMPTZ AS t, (status = 'failed')::INT AS err, count(*) OVER (PARTITION BY run_no) AS total FROM jobs WHERE finished_at IS NOT NULL),
w AS (SELECT run_no, total, row_number() OVER x AS done, sum(err) OVER x AS errors, epoch_us(t) / 1e6 - first_value(epoch_us(t)) OVER x / 1e6 AS elapsed FROM f WINDOW x AS (PARTITION BY run_no ORDER BY t, job_row_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT run_no, done::INT AS done, errors::BIGINT AS errors, round(elapsed, 3) AS elapsed_s, round(CASE WHEN elapsed > 0 THEN done / elapsed END, 6) AS rate, round(elapsed / done, 6) AS mean_s, total - done AS remaining, round(CASE WHEN elapsed > 0 THEN (total - done) / (done / elapsed) END, 3) AS eta_s, round(done * 100.0::DOUBLE / total, 6) AS percent
FROM w WHERE done % 100 = 0 OR done = total""")
def q31_progress(spark, d):
    jobs = read_table(spark, d, "jobs").where("finished_at IS NOT NULL")
    jobs = jobs.join(jobs.groupBy("run_no").agg(F.count(F.lit(1)).alias("_total")), "run_no")
    done = jobs.select("run_no", "job_row_id", F.to_timestamp("finished_at").alias("ended_at"), (F.col("status") == "failed").alias("is_error"), "_total")
    p = progress.progress(done, "run_no", ["ended_at", "job_row_id"], "_total")
    return p.select("run_no", "done", "errors", *[F.round(c, n).alias(c) for c, n in (("elapsed_s", 3), ("rate", 6), ("mean_s", 6))], "remaining", F.round("eta_s", 3).alias("eta_s"), F.round("percent", 6).alias("percent"))


@query("SELECT source_path, chunk_id, count(*) AS pages, min(page_no) AS first_page FROM (SELECT *, ((row_number() OVER (PARTITION BY source_path ORDER BY page_no) - 1) // 50)::INT AS chunk_id FROM ocr_pages) GROUP BY ALL")
def q32_chunks(spark, d):
    return progress.chunks(read_table(spark, d, "ocr_pages"), "source_path", "page_no").groupBy("source_path", "chunk_id").agg(F.count(F.lit(1)).alias("pages"), F.min("page_no").alias("first_page"))


@query("""SELECT folder, count(*) AS pages, round(coalesce(sum(duration_s), 0.0), 6) AS duration_s, count(*) FILTER (status = 'failed') AS errors FROM (SELECT *, regexp_replace(source_path, '/[^/]*$', '') AS folder FROM jobs) GROUP BY ROLLUP (folder) HAVING count(*) FILTER (status = 'failed') > 0""")
def q33_folder_summary(spark, d):
    rows = read_table(spark, d, "jobs").select(paths.parent_dir("source_path").alias("folder"), "duration_s", F.coalesce(F.col("status") == "failed", F.lit(False)).alias("is_error"))
    return progress.folder_summary(rows, "folder").withColumn("duration_s", F.round("duration_s", 6))


@query("SELECT job_row_id FROM jobs WHERE loaded_at < (SELECT max(loaded_at) FROM jobs) - INTERVAL 10 DAYS")
def q34_expired(spark, d):
    jobs = read_table(spark, d, "jobs").select("job_row_id", "loaded_at")
    newest = jobs.agg(F.max("loaded_at").cast("string").alias("now")).first()["now"]
    return progress.expired(jobs, "loaded_at", F.lit(newest).cast("timestamp"), "10 DAYS").select("job_row_id")


@query(f"SELECT DISTINCT regexp_replace(p, '/[^/]*$', '') AS dir FROM (SELECT {_canonical_sql('output_json')} AS p FROM ocr_tasks) WHERE suffix(p, '.json')")
def q35_json_parents(spark, d):
    files = read_table(spark, d, "ocr_tasks").select(paths.canonical_path("output_json").alias("p")).select(paths.parent_dir("p").alias("dir"), paths.base_name("p").alias("name"))
    return matching.json_parents(files)


@query("""WITH t AS (SELECT DISTINCT source FROM ocr_tasks), s AS (SELECT array_to_string(string_split(source, '/')[1:4], '/') AS root FROM t WHERE source IS NOT NULL UNION SELECT DISTINCT '/scan/gone/run' || run_no FROM scan_runs)
SELECT s.root, count(t.source) AS n FROM s LEFT JOIN t ON starts_with(t.source, s.root || '/') OR t.source = s.root GROUP BY s.root""")
def q36_scan_counts(spark, d):
    """Files under every folder of the third level, and under folders that are not there."""
    top = F.concat_ws("/", F.slice(F.split("source", "/"), 1, 4))
    files = read_table(spark, d, "ocr_tasks").where("source IS NOT NULL").select("source").distinct().select("source", top.alias("source_index"))
    gone = read_table(spark, d, "scan_runs").select(F.concat(F.lit("/scan/gone/run"), "run_no").alias("source_index")).distinct()
    sources = files.select("source_index").distinct().unionByName(gone)
    return matching.counts_per_source(sources, files).select(F.col("source_index").alias("root"), "n")


@query(f"WITH t AS (SELECT task_id, payload, {_canonical_sql('output_json')} AS output_json FROM ocr_tasks) SELECT task_id, output_json FROM t WHERE output_json NOT IN (SELECT output_json FROM t WHERE payload IS NOT NULL)")
def q37_not_done(spark, d):
    tasks = read_table(spark, d, "ocr_tasks").select("task_id", "payload", paths.canonical_path("output_json").alias("output_json"))
    return matching.not_done(tasks.drop("payload"), tasks.where("payload IS NOT NULL")).select("task_id", "output_json")


@query("""SELECT job_row_id, CASE WHEN duration_s IS NOT NULL THEN printf('%02d:%02d:%02d', (floor(duration_s * 1000)::BIGINT // 3600), (floor(duration_s * 1000)::BIGINT % 3600) // 60, floor(duration_s * 1000)::BIGINT % 60) END AS took,
  CASE WHEN source_size IS NULL THEN 'unknown' WHEN source_size < 1024 THEN printf('%.1f B', source_size::DOUBLE) WHEN source_size < 1048576 THEN printf('%.1f KiB', source_size / 1024.0::DOUBLE) WHEN source_size < 1073741824 THEN printf('%.1f MiB', source_size / 1048576.0::DOUBLE) ELSE printf('%.1f GiB', source_size / 1073741824.0::DOUBLE) END AS size,
  strftime(loaded_at AT TIME ZONE 'UTC' + INTERVAL 8 HOURS, '%Y-%m-%d %H:%M:%S') AS local FROM jobs""")
def q38_small_scalars(spark, d):
    jobs = read_table(spark, d, "jobs")
    took = F.when(F.col("duration_s").isNotNull(), names.duration(F.col("duration_s") * 1000))
    return jobs.select("job_row_id", took.alias("took"), names.human_bytes("source_size").alias("size"), names.local_time("loaded_at").alias("local"))


# ------------------------------------------------------------ placement, folders, profiles

_RECT = "trunc(polygon[1][1])::BIGINT AS x0, trunc(polygon[1][2])::BIGINT + 5 AS y0, trunc(polygon[3][1])::BIGINT AS x1, trunc(polygon[3][2])::BIGINT + 5 AS y1"


@query(f"""WITH l AS (SELECT line_id, length(text) AS n, {_RECT} FROM ocr_lines WHERE text IS NOT NULL AND polygon IS NOT NULL AND NOT regexp_matches(text, '{BLANK_RE}')),
s AS (SELECT *, CASE WHEN x1 > x0 AND y1 > y0 THEN greatest(1.0::DOUBLE, least(100.0::DOUBLE, coalesce(list_filter(list_transform(range(0, 201), lambda i: (y1 - y0) * 0.9::DOUBLE - i), lambda s: s <= 1 OR n * s <= x1 - x0)[1], 1.0::DOUBLE))) END AS font_size FROM l)
SELECT line_id, x0, y0, x1, y1, font_size, y0 + 0.85::DOUBLE * font_size AS baseline, CASE WHEN font_size IS NULL THEN 'text rectangle has no area' END AS error FROM s""")
def q39_text_placement(spark, d):
    from quirework.operators import placement

    lines = _lines(spark, d).where("text IS NOT NULL AND polygon IS NOT NULL").select(F.col("line_id").alias("line_no"), "page_id", "text", "polygon")
    lines = lines.join(read_table(spark, d, "ocr_pages").select("page_id", "width"), "page_id")
    plan = placement.placement(lines, ["page_id"], y_offset=5)
    return plan.select(F.col("line_no").alias("line_id"), "x0", "y0", "x1", "y1", "font_size", "baseline", "error")


_PAGE_FILES = "pf AS (SELECT DISTINCT regexp_replace(p, '/[^/]*$', '') AS dir, regexp_extract(p, '([^/]*)$', 1) AS name FROM (SELECT {0} AS p FROM (SELECT unnest(page_paths) AS u FROM render_results) WHERE u IS NOT NULL))".format(_canonical_sql("u"))


def _page_files(spark, d):
    found = read_table(spark, d, "render_results").select(F.explode("page_paths").alias("u")).where("u IS NOT NULL").select(paths.canonical_path("u").alias("path")).distinct()
    return found.select("path", paths.parent_dir("path").alias("dir"), paths.base_name("path").alias("name"))


@query(f"""WITH {_PAGE_FILES}, n AS (SELECT dir, try_cast(regexp_extract(name, 'page_([0-9]+)', 1, 'i') AS BIGINT) AS page FROM pf WHERE regexp_matches(lower(name), '\\.(png|jpg|jpeg|bmp|tif|tiff)$')),
c AS (SELECT dir, page, count(*) AS n FROM n WHERE page IS NOT NULL GROUP BY ALL), p AS (SELECT dir, count(*)::INT AS n_pages, max(n) AS most, min(page) AS first, max(page) AS last_page, list(page) AS have FROM c GROUP BY 1),
g AS (SELECT *, list_filter(range(1, greatest(last_page, 1) + 1), lambda x: NOT list_contains(have, x)) AS gaps FROM p)
SELECT dir, CASE WHEN first < 1 THEN 'invalid' WHEN most > 1 THEN 'duplicate' WHEN len(gaps) > 0 THEN 'gap' ELSE 'ok' END AS status, n_pages, last_page, array_to_string(gaps[1:10], ', ') || CASE WHEN len(gaps) > 10 THEN '...' ELSE '' END AS missing FROM g""")
def q40_image_sequences(spark, d):
    from quirework.operators import folders

    return folders.image_sequences(_page_files(spark, d))


#: Books whose document has been built in some run.
_BUILT = "b AS (SELECT DISTINCT regexp_replace(regexp_replace(source_path, '^.*/', ''), '\\.pdf$', '') AS book FROM jobs WHERE stage = 'searchable_pdf' AND status = 'success')"


def _built(spark, d):
    jobs = read_table(spark, d, "jobs").where("stage = 'searchable_pdf' AND status = 'success'")
    return jobs.select(F.regexp_replace(paths.base_name("source_path"), r"\.pdf$", "").alias("book")).distinct()


@query(f"""WITH {RESULTS}, j AS (SELECT DISTINCT '/scan/work/' || dir || '/ocr' AS dir FROM results), {_PAGE_FILES}, i AS (SELECT DISTINCT dir FROM pf), {_BUILT}
SELECT j.dir, replace(j.dir, '/ocr', '/pages') AS images, CASE WHEN b.book IS NOT NULL THEN 'done' WHEN i.dir IS NOT NULL THEN 'build' ELSE 'no images' END AS state FROM j LEFT JOIN b ON j.dir = '/scan/work/' || b.book || '/ocr' LEFT JOIN i ON i.dir = replace(j.dir, '/ocr', '/pages')""")
def q41_books_to_build(spark, d):
    from quirework.operators import folders

    json_dirs = _results(spark, d).select(F.concat(F.lit("/scan/work/"), "dir", F.lit("/ocr")).alias("dir")).distinct()
    images = _page_files(spark, d).select(F.regexp_replace("dir", "/pages$", "/ocr").alias("dir"))
    done = _built(spark, d).select(F.concat(F.lit("/scan/work/"), "book", F.lit("/ocr")).alias("dir"))
    rows = folders.books_to_build(json_dirs, images, done, "/scan/work", "/scan/work")
    return rows.select("dir", F.replace("images", F.lit("/ocr"), F.lit("/pages")).alias("images"), "state")


@query(f"""WITH {_PAGE_FILES}, r AS (SELECT DISTINCT source_path, page_no FROM page_results),
b AS (SELECT regexp_replace(regexp_replace(dir, '/pages$', ''), '^.*/', '') AS book, name FROM pf), k AS (SELECT DISTINCT book, name FROM b),
w AS (SELECT source_path, page_no, regexp_replace(regexp_replace(source_path, '^.*/', ''), '\\.pdf$', '') AS book FROM r)
SELECT source_path, page_no, k.name AS image FROM w LEFT JOIN k ON k.book = w.book AND k.name = printf('page_%05d.png', page_no)""")
def q42_images_of_results(spark, d):
    from quirework.operators import folders

    book = F.regexp_replace(paths.base_name("source_path"), r"\.pdf$", "")
    results = read_table(spark, d, "page_results").select("source_path", "page_no", book.alias("dir")).distinct()
    images = _page_files(spark, d).select(paths.base_name(F.regexp_replace("dir", "/pages$", "")).alias("dir"), "name")
    return folders.images_of_results(results, images).select("source_path", "page_no", "image")


@query(f"""WITH {IMAGES}, {RESULTS}, s AS (SELECT dir, name, regexp_replace(name, '(.)\\.[^./]*$', '\\1') AS st FROM images)
SELECT s.dir, s.name, min(r.name) AS result FROM s LEFT JOIN results r ON r.dir = s.dir AND starts_with(r.name, s.st) AND suffix(r.name, '_result.json') GROUP BY ALL""")
def q43_result_by_stem(spark, d):
    from quirework.operators import folders

    return folders.result_by_stem(_images(spark, d), _results(spark, d))


@query(f"WITH {IMAGES}, a AS (SELECT name, min(p) AS path FROM (SELECT regexp_extract(p, '([^/]*)$', 1) AS name, p FROM (SELECT {_canonical_sql('u')} AS p FROM (SELECT unnest(page_paths) AS u FROM render_results) WHERE u IS NOT NULL)) GROUP BY 1) SELECT DISTINCT i.name, a.path FROM images i LEFT JOIN a ON a.name = i.name")
def q44_anywhere(spark, d):
    from quirework.operators import folders

    return folders.anywhere(_images(spark, d), _page_files(spark, d))


@query("""WITH p AS (SELECT p_partkey, 'K' || (p_partkey % 50) || '_' || (p_size % 9) || CASE WHEN p_partkey % 7 = 0 THEN '' ELSE '_x' || (p_partkey % 4) END AS folder FROM part), s AS (SELECT *, str_split(folder, '_') AS a FROM p)
SELECT p_partkey, CASE WHEN len(a) >= 3 THEN printf('%04d', ltrim(a[1], 'K')::INT) || '_' || printf('%03d', a[2]::INT) || '_' || a[3] || '_' || printf('%02d', p_partkey) || '.json' END AS by_folder, CASE WHEN regexp_matches(a[len(a)], '^[0-9]+$') THEN folder || '.json' END AS by_stem FROM s""")
def q45_expected_names(spark, d):
    from quirework.operators import folders

    folder = F.concat(F.lit("K"), F.col("p_partkey") % 50, F.lit("_"), F.col("p_size") % 9, F.when(F.col("p_partkey") % 7 == 0, "").otherwise(F.concat(F.lit("_x"), F.col("p_partkey") % 4)))
    part = read_table(spark, d, "part").select("p_partkey", folder.alias("folder"))
    return part.select("p_partkey", folders.expected_name_by_folder("folder", F.col("p_partkey")).alias("by_folder"), folders.expected_name_by_stem(F.concat("folder", F.lit(".png"))).alias("by_stem"))


@query("SELECT worker, job_row_id FROM (SELECT *, row_number() OVER (PARTITION BY worker ORDER BY job_row_id DESC) AS rn FROM jobs) WHERE rn <= 3")
def q46_last_lines(spark, d):
    from quirework.operators import folders

    return folders.last_lines(read_table(spark, d, "jobs").select("worker", "job_row_id"), "worker", "job_row_id")


@query("""SELECT doc_id, '{"alpha":false,"dpi":' || (72 + doc_id % 100) || ',"format":"png","kind":"pdf_render","schema":1}' AS render,
 '{"expected_page_count":' || (1 + doc_id % 9) || ',"fontname":"china-s","images_dir":"/w/' || doc_id || '","kind":"searchable_pdf","layout":"legacy-v7","ocr_json_dir":"/o","schema":2,"y_offset":0.0}' AS document,
 '{"device":"cpu","engine":null,"kind":"paddlex_ocr","pipeline":{"path":"/p.yaml","sha256":"' || sha256(doc_id::VARCHAR) || '","size":' || doc_id || ',"type":"file"},"predict":{"use_doc_orientation_classify":false,"use_doc_unwarping":true,"use_textline_orientation":false},"schema":2,"use_hpip":null}' AS ocr FROM documents""")
def q47_profiles(spark, d):
    from quirework.functions import profiles

    i = F.col("doc_id")
    return read_table(spark, d, "documents").select(
        "doc_id", profiles.render_profile(72 + i % 100).alias("render"), profiles.searchable_profile(F.concat(F.lit("/w/"), i), "/o", 1 + i % 9).alias("document"),
        profiles.ocr_profile("/p.yaml", i, F.sha2(i.cast("string"), 256), "cpu", unwarping=True).alias("ocr"),
    )


@query("""SELECT coalesce(e.source, b.source) AS source, CASE WHEN b.n IS NULL THEN 'missing' WHEN b.n = 0 THEN 'empty' ELSE 'has ' || b.pages || ' pages, not ' || e.pages END AS error
FROM (SELECT source_path AS source, count(*) AS pages FROM ocr_pages GROUP BY 1) e LEFT JOIN (SELECT source_path AS source, count(DISTINCT page_no) AS pages, coalesce(sum(strlen(page_json)), 0) AS n FROM page_results GROUP BY 1) b ON b.source = e.source
WHERE b.n IS NULL OR b.n = 0 OR b.pages <> e.pages""")
def q48_checked_documents(spark, d):
    from quirework.operators import placement

    expected = read_table(spark, d, "ocr_pages").groupBy(F.col("source_path").alias("source")).agg(F.count(F.lit(1)).alias("pages"))
    built = read_table(spark, d, "page_results").groupBy(F.col("source_path").alias("source")).agg(F.countDistinct("page_no").alias("pages"), F.coalesce(F.sum(F.octet_length("page_json")), F.lit(0)).alias("n_bytes")).withColumn("is_symlink", F.lit(False))
    return placement.checked_documents(built, expected, "source")


# ------------------------------------------------------------ scans, totals, copies


@query(f"""WITH f AS (SELECT DISTINCT source FROM ocr_tasks WHERE source IS NOT NULL AND regexp_matches(lower(source), '\\.(png|jpg|jpeg|bmp|tif|tiff)$'))
SELECT source, '/scan/out/' || regexp_replace(source[12:], '\\.[^./]*$', '') || '_result.json' AS output_json FROM f""")
def q49_image_tasks(spark, d):
    """Every image below its root with the place of its result."""
    files = read_table(spark, d, "ocr_tasks").where("source IS NOT NULL").select("source").distinct()
    files = files.select("source", F.lit("/scan/work").alias("root"), F.substring("source", F.lit(12), F.length("source")).alias("rel"))
    return matching.image_tasks(files, "/scan/out").select("source", "output_json")


@query("""SELECT source_path, stage, coalesce(intended_result_path, '') AS target, first_owner FROM (SELECT *, row_number() OVER w AS n, first_value(job_row_id) OVER w AS first_owner FROM jobs WHERE intended_result_path IS NOT NULL
  WINDOW w AS (PARTITION BY run_no, intended_result_path ORDER BY job_row_id)) WHERE n > 1""")
def q50_repeated_targets(spark, d):
    """Jobs of a run that write what an earlier job of it writes already."""
    jobs = read_table(spark, d, "jobs").where("intended_result_path IS NOT NULL").withColumn("owner", F.concat_ws("|", "run_no", "intended_result_path"))
    return matching.output_collisions(jobs, "owner", "job_row_id").select("source_path", "stage", F.col("intended_result_path").alias("target"), "first_owner")


@query("SELECT count(DISTINCT source_path) AS documents, count(*) AS pages, max(page_no) AS longest FROM ocr_pages")
def q51_page_total(spark, d):
    return progress.page_total(read_table(spark, d, "ocr_pages").select(F.col("source_path").alias("doc"), "page_no"))


@query(f"WITH {NOW} SELECT count(*) FILTER (status = 'success') AS success, count(*) FILTER (status = 'skipped') AS skipped, count(*) FILTER (status = 'failed') AS failed FROM now_")
def q52_tally(spark, d):
    return reporting.tally(latest(spark, d))


@query("SELECT source, coalesce(bool_or(status = 'success'), false) AS force FROM ocr_tasks GROUP BY source")
def q53_must_rebuild(spark, d):
    tasks = read_table(spark, d, "ocr_tasks").select(F.col("source").alias("doc"), "status")
    return planning.must_rebuild(tasks, "doc").select(F.col("doc").alias("source"), "force")


@query(f"""WITH {_PAGE_FILES}, x AS (SELECT DISTINCT regexp_replace(regexp_replace(dir, '/pages$', ''), '^.*/', '') AS name FROM pf),
y AS (SELECT DISTINCT regexp_replace(regexp_replace(source_path, '^.*/', ''), '\\.pdf$', '') AS name FROM page_results WHERE source_path IS NOT NULL) SELECT name FROM x JOIN y USING (name)""")
def q54_folder_pairs(spark, d):
    """Books that have pages as well as results."""
    from quirework.operators import folders

    rendered = _page_files(spark, d).select(paths.base_name(F.regexp_replace("dir", "/pages$", "")).alias("name"))
    results = read_table(spark, d, "page_results").where("source_path IS NOT NULL").select(F.regexp_replace(paths.base_name("source_path"), r"\.pdf$", "").alias("name"))
    return folders.folder_pairs(rendered, results)


@query(f"WITH {_PAGE_FILES} SELECT DISTINCT dir FROM pf WHERE regexp_matches(lower(name), '\\.(png|jpg|jpeg|bmp|tif|tiff)$')")
def q55_folders_with_images(spark, d):
    from quirework.operators import folders

    return folders.folders_with_images(_page_files(spark, d))


@query("""SELECT run_no, count(*) AS jobs, round(coalesce(sum(duration_s), 0.0), 3) AS total_s, round(avg(duration_s), 6) AS mean_s, round(max(duration_s), 3) AS longest_s FROM jobs GROUP BY run_no""")
def q56_durations(spark, d):
    rows = progress.durations(read_table(spark, d, "jobs"), "run_no")
    return rows.select("run_no", "jobs", F.round("total_s", 3).alias("total_s"), F.round("mean_s", 6).alias("mean_s"), F.round("longest_s", 3).alias("longest_s"))


@query("""WITH r AS (SELECT source, max(render_id) AS render_id FROM render_results GROUP BY 1), n AS (SELECT source, count(*) AS have FROM (SELECT DISTINCT source, unnest(page_paths) AS p FROM render_results WHERE page_paths IS NOT NULL) WHERE p IS NOT NULL GROUP BY 1)
SELECT r.source, coalesce(x.page_count, 0) AS needed, coalesce(n.have, 0) AS have, greatest(coalesce(x.page_count, 0) - coalesce(n.have, 0), 0) AS missing FROM r JOIN render_results x ON x.render_id = r.render_id LEFT JOIN n ON n.source IS NOT DISTINCT FROM r.source""")
def q57_pages_left(spark, d):
    """Pages that each document needs and has."""
    renders = read_table(spark, d, "render_results")
    needed = renders.groupBy("source").agg(F.max_by("page_count", "render_id").alias("needed"))
    have = renders.select("source", F.explode("page_paths").alias("p")).where("p IS NOT NULL").distinct()
    return progress.pages_left(needed, have, "source")

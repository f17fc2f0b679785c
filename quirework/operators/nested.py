"""Deeply nested records into flat tables that keep their parents' keys.

Method: higher-order SQL projection. Nested ``transform`` calls attach ancestor
keys and positions, ``flatten`` combines the arrays and one ``inline`` per target
table emits rows. Everything stays in the JVM on VARIANT values; there is no
shuffle, so a hot parent costs no more than its own bytes.

Defined results: null, empty, truncated or non-object JSON and text after the
object give no child rows (the page keeps an error text); repeated input rows
give repeated child rows under their own ids; columns of the input that clash
with names used here are not touched, for only the id and the JSON are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirework.functions import variants as V

#: Levels that one projection unrolls; deeper values take further projections.
LEVELS = 8

NUMBER = "^(BIGINT|DOUBLE|FLOAT|DECIMAL)"


def normalise_pages(df: DataFrame, page_id: str, json: str) -> DataFrame:
    """(page_id, text_field, polygon_field, error, lines) of raw page JSON.

    ``lines`` is array<struct<line_no, text, points: array<struct<point_no, x, y>>>>,
    null where ``error`` is set. An envelope ``res`` is unwrapped if it is an
    object and none of the page fields stands beside it. Fields are chosen by
    presence, not by value; coordinates must be numbers, booleans are none.
    """
    V.allow_duplicate_keys(df.sparkSession)
    fields = ("rec_texts", "rec_text", "rec_polys", "dt_polys")
    direct = " OR ".join(f"variant_get(_v, '$.{f}') IS NOT NULL" for f in fields)
    out = df.select(F.col(page_id).alias("page_id"), F.expr(f"try_parse_json(concat('[', {json}, ']'))").alias("_w"))
    out = out.selectExpr("page_id", "CASE WHEN variant_get(_w, '$[1]') IS NULL THEN variant_get(_w, '$[0]') END AS _v")
    out = out.selectExpr(
        "page_id",
        f"CASE WHEN schema_of_variant(_v) NOT LIKE 'OBJECT%' THEN NULL WHEN NOT ({direct}) AND schema_of_variant(variant_get(_v, '$.res')) LIKE 'OBJECT%' THEN variant_get(_v, '$.res') ELSE _v END AS _p",
    )
    out = out.selectExpr(
        "page_id", "_p",
        "CASE WHEN variant_get(_p, '$.rec_texts') IS NOT NULL THEN 'rec_texts' WHEN variant_get(_p, '$.rec_text') IS NOT NULL THEN 'rec_text' END AS text_field",
        "CASE WHEN variant_get(_p, '$.rec_texts') IS NOT NULL AND variant_get(_p, '$.rec_polys') IS NOT NULL THEN 'rec_polys' WHEN _p IS NOT NULL THEN 'dt_polys' END AS polygon_field",
    )
    out = out.selectExpr(
        "page_id", "_p IS NOT NULL AS _object", "text_field", "polygon_field",
        "CASE text_field WHEN 'rec_texts' THEN variant_get(_p, '$.rec_texts') WHEN 'rec_text' THEN variant_get(_p, '$.rec_text') END AS _t",
        "CASE polygon_field WHEN 'rec_polys' THEN variant_get(_p, '$.rec_polys') WHEN 'dt_polys' THEN variant_get(_p, '$.dt_polys') END AS _g",
    )
    out = out.selectExpr("page_id", "_object", "text_field", "polygon_field", f"{V.elements('_t')} AS _texts", f"{V.elements('_g')} AS _polys")
    out = out.selectExpr(
        "*",
        # one entry per point: its numbers, or null for what is no point
        f"""transform(_polys, p -> transform({V.elements('p')}, q ->
              CASE WHEN schema_of_variant(q) LIKE 'ARRAY%' AND variant_get(q, '$[1]') IS NOT NULL
                    AND schema_of_variant(variant_get(q, '$[0]')) RLIKE '{NUMBER}'
                    AND schema_of_variant(variant_get(q, '$[1]')) RLIKE '{NUMBER}'
                   THEN struct(variant_get(q, '$[0]', 'double') AS x, variant_get(q, '$[1]', 'double') AS y) END)) AS _points""",
        "exists(_texts, t -> schema_of_variant(t) <> 'STRING') AS _not_text",
    )
    out = out.selectExpr(
        "*",
        """CASE WHEN NOT _object THEN 'root is not an object'
             WHEN text_field IS NULL THEN 'text field is missing'
             WHEN _polys IS NULL THEN concat(polygon_field, ' is missing or not an array')
             WHEN _texts IS NULL THEN concat(text_field, ' is not an array')
             WHEN size(_polys) <> size(_texts) THEN 'polygon/text count mismatch'
             WHEN _not_text OR exists(_points, g -> g IS NULL OR size(g) < 4 OR exists(g, q -> q IS NULL)) THEN
               CASE WHEN coalesce(array_position(transform(_texts, t -> schema_of_variant(t) <> 'STRING'), true), 0) > 0
                     AND (coalesce(array_position(transform(_points, g -> g IS NULL OR size(g) < 4 OR exists(g, q -> q IS NULL)), true), 0) = 0
                          OR array_position(transform(_texts, t -> schema_of_variant(t) <> 'STRING'), true)
                             <= array_position(transform(_points, g -> g IS NULL OR size(g) < 4 OR exists(g, q -> q IS NULL)), true))
                    THEN concat(text_field, ' has an element that is no string') ELSE concat(polygon_field, ' has a malformed polygon') END
           END AS error""",
    )
    return _with_lines(out)


def _with_lines(checked: DataFrame) -> DataFrame:
    return checked.selectExpr(
        "page_id", "text_field", "polygon_field", "error",
        """CASE WHEN error IS NULL THEN transform(_points, (g, i) -> struct(
             i AS line_no, variant_get(_texts[i], '$', 'string') AS text,
             transform(g, (q, j) -> struct(j AS point_no, q.x AS x, q.y AS y)) AS points)) END AS lines""",
    )


def _emit(df: DataFrame, rows: str, never_null: str, *carried: str) -> DataFrame:
    """One row per element of ``rows``.

    ``inline_outer`` and a filter on its output: a filter on the array itself
    would be pushed below the projections and repeat their parsing.
    """
    return df.selectExpr(*carried, f"inline_outer({rows})").where(f"{never_null} IS NOT NULL")


def page_lines(pages: DataFrame) -> DataFrame:
    """(page_id, line_no, text, n_points): one row per line of the valid pages."""
    rows = "transform(lines, l -> struct(page_id AS page_id, l.line_no AS line_no, l.text AS text, size(l.points) AS n_points))"
    return _emit(pages, rows, "line_no")


def page_points(pages: DataFrame) -> DataFrame:
    """(page_id, line_no, point_no, x, y): one row per polygon point of the valid pages."""
    rows = "flatten(transform(lines, l -> transform(l.points, q -> struct(page_id AS page_id, l.line_no AS line_no, q.point_no AS point_no, q.x AS x, q.y AS y))))"
    return _emit(pages, rows, "line_no")


def _unroll(level: int, last: int) -> str:
    """SQL: the leaves below entries ``e<level>`` of struct<path, v, s>.

    At ``last`` a container is handed on as it is; its path carries on in the
    next projection.
    """
    e = f"e{level}"
    done = f"array(struct({e}.path AS path, {e}.v AS v, {e}.s AS s))"
    if level == last:
        return done
    members = (
        f"CASE WHEN {e}.s LIKE 'OBJECT%' THEN transform(map_entries(variant_get({e}.v, '$', 'map<string,variant>')), m{level} -> struct(concat({e}.path, '/', m{level}.key) AS path, m{level}.value AS v, schema_of_variant(m{level}.value) AS s)) "
        f"ELSE transform(variant_get({e}.v, '$', 'array<variant>'), (m{level}, i{level}) -> struct(concat({e}.path, '/', i{level}) AS path, m{level} AS v, schema_of_variant(m{level}) AS s)) END"
    )
    below = f"flatten(transform({members}, e{level + 1} -> {_unroll(level + 1, last)}))"
    return f"CASE WHEN {e}.s LIKE 'OBJECT%' OR {e}.s LIKE 'ARRAY%' THEN {below} ELSE {done} END"


def nesting_depth(json: str) -> str:
    """SQL: how deep brackets nest outside the strings of valid JSON.

    Escapes go first, then strings, so that neither pattern needs a group.
    """
    bare = f"regexp_replace(regexp_replace(regexp_replace({json}, r'\\\\.', ''), r'\"[^\"]*+\"', ''), r'[^\\[\\]{{}}]', '')"
    return (
        f"aggregate(split({bare}, ''), struct(0 AS d, 0 AS m), (a, c) -> struct("
        "a.d + CASE WHEN c IN ('[', '{') THEN 1 WHEN c IN (']', '}') THEN -1 ELSE 0 END AS d, "
        "greatest(a.m, a.d + CASE WHEN c IN ('[', '{') THEN 1 ELSE 0 END) AS m), a -> a.m)"
    )


def _opened(base: DataFrame) -> DataFrame:
    """(parent_id, _text, v): the JSON text and its object, that of a string of JSON included; null if it is none."""
    # a string of JSON hides its brackets, so it is opened before the depth is taken
    base = base.selectExpr("parent_id", "_j", "try_parse_json(concat('[', _j, ']')) AS _w")
    base = base.selectExpr("parent_id", "_j", "CASE WHEN variant_get(_w, '$[1]') IS NULL THEN variant_get(_w, '$[0]') END AS _v")
    base = base.selectExpr("parent_id", "_v", "CASE WHEN schema_of_variant(_v) = 'STRING' THEN variant_get(_v, '$', 'string') END AS _inner", "_j")
    base = base.selectExpr("parent_id", "_v", "coalesce(_inner, _j) AS _text", "try_parse_json(concat('[', _inner, ']')) AS _w")
    base = base.selectExpr("parent_id", "_text", "CASE WHEN schema_of_variant(_v) <> 'STRING' THEN _v WHEN variant_get(_w, '$[1]') IS NULL THEN variant_get(_w, '$[0]') END AS v")
    return base.selectExpr("parent_id", "_text", "CASE WHEN schema_of_variant(v) LIKE 'OBJECT%' THEN v END AS v")


def profile_leaves(df: DataFrame, parent_id: str, json: str) -> DataFrame:
    """(parent_id, path, kind, value, number): every value that is neither object nor array.

    Numbers are in ``number``, text and booleans in ``value``. JSON nulls are values; array positions are zero-based. A string that holds
    JSON counts as the object inside. Anything that is no complete object gives
    nothing, and so do empty objects and arrays. Any depth is followed: one pass
    finds the deepest nesting, and each projection unrolls ``LEVELS`` of it.
    """
    V.allow_duplicate_keys(df.sparkSession)
    raw = df.select(F.col(parent_id).alias("parent_id"), F.col(json).cast("string").alias("_j"))
    base = _opened(raw)
    # text with no more opening brackets than LEVELS cannot nest deeper; only the rest is looked at
    brackets = "length(_j) - length(replace(replace(_j, '[', ''), '{', ''))"
    many = _opened(raw.where(F.expr(f"{brackets} > {LEVELS}")))
    deepest = many.select(F.max(F.expr(f"CASE WHEN v IS NOT NULL THEN {nesting_depth('_text')} END")).alias("d")).first()["d"] or 0
    rounds = max(1, -(-deepest // LEVELS))
    frontier = base.selectExpr("parent_id", "'' AS path", "v")
    found = None
    for _ in range(rounds):
        rows = f"transform(array(struct(path AS path, v AS v, schema_of_variant(v) AS s)), e0 -> {_unroll(0, LEVELS)})"
        out = _emit(frontier, f"CASE WHEN v IS NOT NULL THEN flatten({rows}) END", "path", "parent_id")
        leaves = out.where("s NOT LIKE 'OBJECT%' AND s NOT LIKE 'ARRAY%'")
        leaves = leaves.selectExpr(
            "parent_id", "substr(path, 2) AS path",
            f"CASE WHEN s = 'STRING' THEN 'string' WHEN s = 'BOOLEAN' THEN 'boolean' WHEN s = 'VOID' THEN 'null' WHEN s RLIKE '{NUMBER}' THEN 'number' ELSE lower(s) END AS kind",
            f"CASE WHEN s NOT RLIKE '{NUMBER}' THEN variant_get(v, '$', 'string') END AS value",
            f"CASE WHEN s RLIKE '{NUMBER}' THEN variant_get(v, '$', 'double') END AS number",
        )
        found = leaves if found is None else found.unionByName(leaves)
        frontier = out.where("s LIKE 'OBJECT%' OR s LIKE 'ARRAY%'").select("parent_id", "path", "v")
    return found


def child_records(page_results: DataFrame, jobs: DataFrame) -> DataFrame:
    """(parent_table, parent_id, child_path) of every innermost child record."""
    points = page_points(normalise_pages(page_results, "page_id", "page_json"))
    leaves = profile_leaves(jobs, "job_row_id", "execution_profile_json")
    return points.selectExpr(
        "'page_results' AS parent_table", "page_id AS parent_id", "concat('lines/', line_no, '/polygon/', point_no) AS child_path"
    ).unionByName(leaves.selectExpr("'jobs' AS parent_table", "parent_id", "path AS child_path"))

"""Records whose fields drift between files, into one table and a list of changes.

Method: versioned schema fingerprints with explicit migration steps. Each file's
fields, spellings and value types make its fingerprint. Consecutive files of one
fingerprint are one version of the feed (``version_starts``); only where a version
begins is anything compared, and added, removed, renamed and retyped fields are
recorded (``changes``). The steps of each fingerprint, which spellings become which
field and of which type they are, are a table of their own (``steps``) that a store
keeps and extends (``store_steps``). A record is routed by the fingerprint of its
file through these rename, default and cast rules to the one target schema
(``unified``), which names every value that could not be cast.

A feed may hold a third of all records: records are reduced to distinct (file,
field, spelling, type) before any shuffle by feed, and the windows that follow run
over files of one field of a feed.

Defined results: null, damaged and non-object records have no fields; a file of
only such records is present and empty; rows without feed or file number belong
to no file; a file delivered twice is one file, the union of its deliveries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirework.functions import variants as V
from quirework.session import cut

#: Target type of each known field; everything else stays text.
TYPES = {
    "source_size": "bigint", "source_mtime_ns": "bigint", "retry_count": "bigint", "duration_s": "double",
    "page_index": "bigint", "return_word_box": "boolean",
}
#: Fields whose target is one string even if a writer wraps it in an object or array.
PATH_PARTS = {"source_path": ("root", "rel"), "intended_result_path": ("dir", "file"), "result_path": ("dir", "file")}


def parsed(records: DataFrame) -> DataFrame:
    """Records with ``body``: the variant of the record's object, unwrapped, else null."""
    V.allow_duplicate_keys(records.sparkSession)
    out = records.withColumn("_w", F.expr("try_parse_json(concat('[', raw_json, ']'))"))
    out = out.withColumn("_v", F.expr("CASE WHEN variant_get(_w, '$[1]') IS NULL THEN variant_get(_w, '$[0]') END"))
    only_res = "record_kind = 'pages' AND schema_of_variant(variant_get(_v, '$.res')) LIKE 'OBJECT%' AND cardinality(map_keys(try_variant_get(_v, '$', 'map<string,variant>'))) = 1"
    body = f"CASE WHEN schema_of_variant(_v) NOT LIKE 'OBJECT%' THEN NULL WHEN {only_res} THEN variant_get(_v, '$.res') ELSE _v END"
    return out.withColumn("body", F.expr(body)).drop("_w", "_v")


def file_fields(records: DataFrame, field_names: DataFrame) -> DataFrame:
    """Distinct (feed, file_no, field_name, spellings, types) with one row per file and field.

    ``spellings`` and ``types`` are sorted arrays; ``types`` lacks JSON null. A
    file without any field has one row with a null field.
    """
    names = field_names.select("record_kind", "spelling", "field_name").distinct()
    rows = parsed(records.where("feed IS NOT NULL AND file_no IS NOT NULL").select("feed", "file_no", "record_kind", "raw_json"))
    # the schema of a value is asked for once, for it walks the whole value
    schemas = "transform(map_entries(try_variant_get(body, '$', 'map<string,variant>')), e -> struct(e.key AS k, schema_of_variant(e.value) AS s))"
    entry = f"transform({schemas}, e -> struct(e.k AS spelling, {V.kind_of_schema('e.s')} AS type))"
    keys = rows.selectExpr("feed", "file_no", "record_kind", f"inline_outer({entry})").distinct()
    keys = keys.join(names, ["record_kind", "spelling"], "left").withColumn("field_name", F.coalesce("field_name", "spelling"))
    return keys.groupBy("feed", "file_no", "field_name").agg(
        F.sort_array(F.collect_set("spelling")).alias("spellings"),
        F.sort_array(F.collect_set(F.when(F.col("type") != "null", F.col("type")))).alias("types"),
    )


def _fingerprint() -> Column:
    part = F.when(F.col("field_name").isNotNull(), F.concat_ws(":", "field_name", F.array_join("spellings", ","), F.array_join("types", ",")))
    return F.sha2(F.array_join(F.sort_array(F.collect_list(part)), "|"), 256)


def fingerprints(fields: DataFrame) -> DataFrame:
    """(feed, file_no, fingerprint, n_fields): files of equal schema have one fingerprint."""
    return fields.groupBy("feed", "file_no").agg(_fingerprint().alias("fingerprint"), F.count("field_name").alias("n_fields"))


def version_starts(marks: DataFrame) -> DataFrame:
    """(feed, file_no, fingerprint): the files with which another version of their feed begins, the first file included."""
    before = F.lag("fingerprint").over(Window.partitionBy("feed").orderBy("file_no"))
    return marks.withColumn("_before", before).where(~F.col("fingerprint").eqNullSafe(F.col("_before"))).select("feed", "file_no", "fingerprint")


def steps(fields: DataFrame) -> DataFrame:
    """(fingerprint, field_name, spellings, types): the migration steps of every version, each once.

    A spelling that is not the field's name is renamed, a field that is not there
    gets its default, types that are not the target's are cast.
    """
    marks = fingerprints(fields).groupBy("fingerprint").agg(F.min(F.struct("feed", "file_no")).alias("f"))
    one = marks.select("fingerprint", "f.feed", "f.file_no")  # any file of the version shows them
    return fields.where("field_name IS NOT NULL").join(one, ["feed", "file_no"]).select("fingerprint", "field_name", "spellings", "types")


def store_steps(fields: DataFrame, folder: str) -> DataFrame:
    """The steps of every version that ``folder`` knows, those of ``fields`` added. Named by its content, so it may be repeated."""
    from quirework import store

    spark = fields.sparkSession
    known = [n for n in store.names(spark, folder) if store.exists(spark, f"{folder}/{n}/_SUCCESS")]
    new = steps(fields)
    if known:
        new = new.join(spark.read.parquet(*[f"{folder}/{n}" for n in known]).select("fingerprint").distinct(), "fingerprint", "left_anti")
    h = F.xxhash64("fingerprint", "field_name")
    total = new.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(h).alias("h")).first()
    if total["n"]:
        name = f"v-{total['n']:x}-{total['h'] & (2**64 - 1):x}"
        new.write.mode("overwrite").parquet(f"{folder}/{name}")
        known.append(name)
    return spark.read.parquet(*[f"{folder}/{n}" for n in known]) if known else new


def changes(fields: DataFrame) -> DataFrame:
    """(feed, file_no, field_name, change) of each file against the one before it.

    Files of one version have no changes between them, so only the files with
    which a version begins are compared, each with the version before.
    """
    fields = cut(fields)  # read once for the fingerprints and once for the comparison
    files = version_starts(fingerprints(fields))
    by_file = Window.partitionBy("feed").orderBy("file_no")
    files = files.select("feed", "file_no", F.row_number().over(by_file).alias("seq"), F.lead("file_no").over(by_file).alias("next_file"))
    rows = fields.where("field_name IS NOT NULL").join(files, ["feed", "file_no"])
    w = Window.partitionBy("feed", "field_name").orderBy("seq")
    earlier = w.rowsBetween(Window.unboundedPreceding, -1)
    types = F.when(F.size("types") > 0, F.col("types"))
    rows = rows.select(
        "feed", "file_no", "field_name", "seq", "next_file", "spellings", types.alias("types"),
        F.lag("seq").over(w).alias("prev_seq"), F.lead("seq").over(w).alias("next_seq"),
        F.lag("spellings").over(w).alias("prev_spellings"),
        F.last(types, ignorenulls=True).over(earlier).alias("prev_types"),
    )
    here = F.col("prev_seq") == F.col("seq") - 1
    change = F.array_compact(F.array(
        F.when((F.col("seq") > 1) & ~F.coalesce(here, F.lit(False)), F.struct("file_no", F.lit("added").alias("change"))),
        F.when(here & (F.col("spellings") != F.col("prev_spellings")), F.struct("file_no", F.lit("renamed").alias("change"))),
        F.when(here & (F.col("types") != F.col("prev_types")), F.struct("file_no", F.lit("retyped").alias("change"))),
        F.when(F.col("next_file").isNotNull() & ~F.coalesce(F.col("next_seq") == F.col("seq") + 1, F.lit(False)), F.struct(F.col("next_file").alias("file_no"), F.lit("removed").alias("change"))),
    ))
    out = rows.select("feed", "field_name", F.inline(change))
    return out.select("feed", "file_no", "field_name", "change")


def versions(fields: DataFrame) -> DataFrame:
    """(feed, file_no, version, fingerprint, n_fields): files of equal schema share a fingerprint.

    ``version`` counts the schemas of the feed in the order of their first file.
    """
    marks = fingerprints(fields)
    first = marks.groupBy("feed", "fingerprint").agg(F.min("file_no").alias("first_file"))
    first = first.withColumn("version", F.row_number().over(Window.partitionBy("feed").orderBy("first_file")))
    return marks.join(first, ["feed", "fingerprint"]).select("feed", "file_no", "version", "fingerprint", "n_fields")


def routes(fields: DataFrame, known: DataFrame) -> DataFrame:
    """(feed, file_no, route): for each file the spellings of each field, by the steps of its version."""
    ways = known.groupBy("fingerprint").agg(F.map_from_entries(F.collect_list(F.struct("field_name", "spellings"))).alias("route"))
    return fingerprints(fields).join(ways, "fingerprint").select("feed", "file_no", "route")


def unified(records: DataFrame, field_names: DataFrame, kind: str) -> DataFrame:
    """One consistent table of a record kind: (record_id, feed, file_no, line_no, exported_at, <fields>, extra, failed, n_failed).

    Each record takes the route of its file's version. Rules, in this order: rename
    (the spellings that the version has for a field; if several stand in a record,
    the field's own name and then the first by name with a value), default (a
    field that is missing is null), cast (to the field's target type; the fields
    whose value could not be cast are null and named in ``failed``). Paths given in
    parts are joined, single values in arrays or objects are taken out, unlisted
    fields go to ``extra`` as JSON by key. Records without a body are left out;
    one of no file, which has no version, may use every known spelling. The fields
    are those of ``field_names``, one column each.
    """
    known = field_names.where(F.col("record_kind") == kind).select("spelling", "field_name").distinct().collect()  # the columns of the result
    fields = file_fields(records.where(F.col("record_kind") == kind), field_names)
    way = routes(fields, steps(fields))
    spellings: dict[str, list[str]] = {}
    for row in known:
        spellings.setdefault(row["field_name"], []).append(row["spelling"])
    rows = records.where(F.col("record_kind") == kind).select("record_id", "feed", "file_no", "line_no", "exported_at", "record_kind", "raw_json").join(way, ["feed", "file_no"], "left")
    body = parsed(rows).withColumn("m", F.expr("try_variant_get(body, '$', 'map<string,variant>')")).drop("body")
    sql = ["record_id", "feed", "file_no", "line_no", "exported_at"]
    raw = {}
    for field, ways in sorted(spellings.items()):
        every = ", ".join(f"'{w}'" for w in sorted(ways, key=lambda w: (w != field, w)))
        here = f"route['{field}']"
        mine = f"CASE WHEN route IS NULL THEN array({every}) WHEN size({here}) < 2 THEN {here} ELSE concat(filter({here}, w -> w = '{field}'), filter({here}, w -> w <> '{field}')) END"
        raw[field] = f"try_element_at(filter(transform({mine}, w -> m[w]), x -> x IS NOT NULL AND schema_of_variant(x) <> 'VOID'), 1)"
    staged = body.selectExpr(*sql, "m", *[f"{e} AS `v_{f}`" for f, e in raw.items()])
    listed = ", ".join(f"'{w}'" for ways in spellings.values() for w in ways)
    cast, failed = [], []
    for field in raw:
        v = f"`v_{field}`"
        value = f"variant_get({v}, '$', 'string')"
        one = f"CASE WHEN schema_of_variant({v}) LIKE 'ARRAY%' AND variant_get({v}, '$[1]') IS NULL THEN coalesce(try_variant_get({v}, '$[0]', 'string'), {value}) ELSE {value} END"
        if field in TYPES:
            cast.append(f"try_cast({value} AS {TYPES[field]}) AS `{field}`")
        elif field in PATH_PARTS:
            a, b = PATH_PARTS[field]
            cast.append(f"CASE WHEN try_variant_get({v}, '$.{a}', 'string') IS NOT NULL THEN concat_ws('/', try_variant_get({v}, '$.{a}', 'string'), try_variant_get({v}, '$.{b}', 'string')) ELSE {one} END AS `{field}`")
        elif field in ("started_at", "finished_at"):
            cast.append(f"CASE WHEN schema_of_variant({v}) = 'BIGINT' THEN to_timestamp(timestamp_seconds(variant_get({v}, '$', 'bigint'))) ELSE try_to_timestamp({value}) END AS `{field}`")
        elif field == "input_path":
            cast.append(f"coalesce(try_variant_get({v}, '$.path', 'string'), {one}) AS `{field}`")
        elif field in ("error_message", "device"):
            cast.append(f"coalesce(try_variant_get({v}, '$.text', 'string'), try_variant_get({v}, '$.kind', 'string'), {one}) AS `{field}`")
        elif kind == "pages":
            cast.append(f"{value} AS `{field}`")
        else:
            cast.append(f"{one} AS `{field}`")
    for field, out in zip(raw, cast):
        failed.append(f"CASE WHEN `v_{field}` IS NOT NULL AND ({out.rpartition(' AS ')[0]}) IS NULL THEN '{field}' END")
    extra = f"map_filter(transform_values(m, (k, x) -> to_json(x)), (k, x) -> k NOT IN ({listed or 'NULL'})) AS extra"
    # a filter on m would be pushed below the parsing and repeat it; one on what is generated stays
    wrong = f"array_compact(array({', '.join(failed)}))" if failed else "CAST(array() AS array<string>)"
    fields = ", ".join([*cast, extra, f"{wrong} AS failed", f"size({wrong}) AS n_failed", "true AS _there"])
    return staged.selectExpr(*sql, f"inline_outer(CASE WHEN m IS NOT NULL THEN array(struct({fields})) END)").where("_there").drop("_there")

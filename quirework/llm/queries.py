"""Queries of the text problems (p5 to p9) and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quirework.llm import lookalikes, noise, packing, sentences, tokens
from quirework.session import read_table


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return noise.noise(read_table(spark, d, "ocr_lines"), read_table(spark, d, "ocr_pages"), read_table(spark, d, "word_list"), read_table(spark, d, "catalog_terms"))


def p5_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    return noise.paragraphs(read_table(spark, d, "ocr_lines"), read_table(spark, d, "ocr_pages"), read_table(spark, d, "word_list"), read_table(spark, d, "catalog_terms"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return lookalikes.headings(read_table(spark, d, "ocr_lines"), read_table(spark, d, "catalog_terms"))


def p6_canonical(spark: SparkSession, d: str) -> DataFrame:
    return lookalikes.canonical_lines(read_table(spark, d, "ocr_lines"), read_table(spark, d, "catalog_terms"))


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokens.encode_documents(read_table(spark, d, "documents"))


def p7_round_trip(spark: SparkSession, d: str) -> DataFrame:
    return tokens.round_trip(read_table(spark, d, "documents"))


def p8_packed(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack_all(read_table(spark, d, "documents"), read_table(spark, d, "capacities"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return sentences.sentences(read_table(spark, d, "documents"))


QUERIES = {f.__name__: f for f in (p5_found, p5_paragraphs, p6_found, p6_canonical, p7_ids, p7_round_trip, p8_packed, p9_found)}

def _shape(c: str) -> str:
    """SQL of a text's mapped form, composed."""
    table = lookalikes.mapping()
    invisible = lookalikes.INVISIBLE.replace(r"\\x{", r"\x{")
    out = f"regexp_replace(regexp_replace({c}, '{invisible}', '', 'g'), '{lookalikes.BLANK}', ' ', 'g')"
    for joined, letters in lookalikes.LIGATURES.items():
        out = f"replace({out}, '{joined}', '{letters}')"
    return f"nfc_normalize(trim(translate({out}, '{_quoted(table)}', '{_quoted(table.values())}'), ' '))"


def _quoted(chars) -> str:
    return "".join(chars).replace("'", "''")


SQL: dict[str, str] = {
    "p6_found": f"""WITH t AS (SELECT term_id, term, {_shape('term')} AS s FROM catalog_terms), x AS (SELECT DISTINCT text, {_shape('text')} AS s FROM ocr_lines WHERE text IS NOT NULL),
m AS (SELECT text, term_id FROM x JOIN t ON t.s = x.s WHERE text <> term) SELECT DISTINCT l.page_id, l.line_no, m.term_id FROM ocr_lines l JOIN m ON m.text = l.text""",
    "p6_canonical": f"""WITH v AS (SELECT value, bool_or(is_term) AS is_term FROM (SELECT text AS value, false AS is_term FROM ocr_lines UNION ALL SELECT term, true FROM catalog_terms) WHERE value IS NOT NULL GROUP BY 1),
f AS (SELECT value, is_term, {_shape('value')} AS form FROM v), b AS (SELECT form, arg_min(value, {{'a': NOT is_term, 'b': length(value), 'c': encode(value)}}) AS canonical FROM f GROUP BY 1)
SELECT l.line_id, l.page_id, l.line_no, l.text, b.canonical FROM ocr_lines l LEFT JOIN f ON f.value = l.text LEFT JOIN b ON b.form = f.form""",
}

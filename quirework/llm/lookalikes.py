"""Texts that look the same but differ in their characters, brought to one form.

Method: values mapped by look-alikes are grouped under an accent-sensitive Unicode
collation in SQL; each equivalence class gets a deterministic canonical member,
which is joined back. The mapping (widths, blanks, invisible characters, radicals,
ligatures, letters shared by scripts) and the collation (combining marks in any
composition) stay in the JVM. Values are made distinct before they are grouped, so
one text in a third of all lines counts once, and only values whose class has
several members are joined back to the lines. Where only catalogue terms matter,
values meet the terms first and nothing else goes on.

The collation ignores a little more than the eye does (digits of other scripts, for
one), so members of a class are compared exactly in their composed mapped form.

Defined results: null texts have no form and match nothing; a text whose mapped
form is empty or blank is a class with its like; an exact repeat is one value; a
class's canonical member is its smallest catalogue term if it has one, else the
shortest and then smallest value.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import cache

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirework.session import cut

# Letters of other scripts that have the shape of a Latin letter.
CYRILLIC = {
    "А": "A", "В": "B", "Е": "E", "Ѕ": "S", "І": "I", "Ј": "J", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X", "Ү": "Y", "Һ": "h", "Ԁ": "d", "Ԛ": "Q", "Ԝ": "W", "Ӏ": "I",
    "а": "a", "е": "e", "ѕ": "s", "і": "i", "ј": "j", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ү": "y", "ӏ": "l",
}
GREEK = {
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "ο": "o", "ν": "v", "ρ": "p", "ϲ": "c", "ϳ": "j", "Ϲ": "C", "Ϳ": "J",
}
CHEROKEE = {
    "Ꭰ": "D", "Ꭱ": "R", "Ꭲ": "T", "Ꭵ": "i", "Ꭹ": "y", "Ꭺ": "A", "Ꭻ": "J", "Ꭼ": "E", "Ꮃ": "W", "Ꮇ": "M", "Ꮋ": "H", "Ꮍ": "Y", "Ꮐ": "G", "Ꮒ": "h", "Ꮓ": "Z", "Ꮟ": "b", "Ꮢ": "R", "Ꮩ": "V", "Ꮪ": "S", "Ꮮ": "L", "Ꮯ": "C", "Ꮲ": "P", "Ꮶ": "K", "Ꮷ": "d", "Ᏻ": "G", "Ᏼ": "B",
}
LISU = {
    "ꓐ": "B", "ꓑ": "P", "ꓒ": "d", "ꓓ": "D", "ꓔ": "T", "ꓖ": "G", "ꓗ": "K", "ꓙ": "J", "ꓚ": "C", "ꓜ": "Z", "ꓝ": "F", "ꓟ": "M", "ꓠ": "N", "ꓡ": "L", "ꓢ": "S", "ꓣ": "R", "ꓦ": "V", "ꓧ": "H", "ꓪ": "W", "ꓫ": "X", "ꓬ": "Y", "ꓮ": "A", "ꓰ": "E", "ꓲ": "I", "ꓳ": "O", "ꓴ": "U",
}
OTHER = {"Օ": "O", "օ": "o", "Ս": "U", "հ": "h", "ɡ": "g", "ɑ": "a", "‐": "-", "‑": "-"}
#: One character that shows several letters: Latin ligatures and roman numerals.
LIGATURES = {chr(c): unicodedata.normalize("NFKC", chr(c)) for c in (*range(0xFB00, 0xFB07), *range(0x2160, 0x2180)) if len(unicodedata.normalize("NFKC", chr(c))) > 1}

#: Characters that show nothing: format characters, fillers, variation selectors, controls.
INVISIBLE = r"[\p{Cf}\x{34F}\x{115F}\x{1160}\x{17B4}\x{17B5}\x{180B}-\x{180D}\x{180F}\x{3164}\x{FFA0}\x{FE00}-\x{FE0F}\x{E0100}-\x{E01EF}\x{0}-\x{8}\x{E}-\x{1F}\x{7F}-\x{84}\x{86}-\x{9F}]"
BLANK = r"[\p{Z}\t\n\x{B}\f\r\x{85}]"


@cache
def mapping() -> dict[str, str]:
    """One character to one: by rule from the Unicode data, and the letters above.

    Full-width and half-width forms, radicals that stand for a character, roman
    numerals of one letter, and every composed letter whose base letter is mapped.
    """
    letters = CYRILLIC | GREEK | CHEROKEE | LISU | OTHER
    out = dict(letters)
    for code in range(0x80, 0x10000):
        c = chr(code)
        kind = unicodedata.decomposition(c).partition(" ")[0]
        if kind in ("<wide>", "<narrow>") or (0x2E80 <= code <= 0x2FDF or 0x2160 <= code <= 0x217F) and kind == "<compat>":
            plain = unicodedata.normalize("NFKC", c)
            if len(plain) == 1 and plain != " ":
                out[c] = letters.get(plain, plain)
        elif kind and not kind.startswith("<"):
            parts = unicodedata.normalize("NFD", c)
            if parts[0] in letters:
                whole = unicodedata.normalize("NFC", letters[parts[0]] + parts[1:])
                if len(whole) == 1:
                    out[c] = whole
    out["ﾞ"], out["ﾟ"] = "゙", "゚"  # half-width voicing marks combine like the full ones
    return {a: b for a, b in out.items() if a != b}


def look_alike(value: Column | str) -> Column:
    """The value in shapes: what looks the same is the same, but for the order and composition of marks."""
    c = F.col(value) if isinstance(value, str) else value
    table = mapping()
    c = F.regexp_replace(F.regexp_replace(c, INVISIBLE, ""), BLANK, " ")
    apart = c
    for joined, letters in LIGATURES.items():
        apart = F.replace(apart, F.lit(joined), F.lit(letters))
    c = F.when(c.rlike("[" + "".join(LIGATURES) + "]"), apart).otherwise(c)
    return F.trim(F.translate(c, "".join(table), "".join(table.values())))


def composed(value: Column) -> Column:
    """Canonical composition, for the exact comparison of the few values that share a class."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(lambda s: None if s is None else unicodedata.normalize("NFC", s))

    return F.pandas_udf(run, "string")(value)


def shaped(values: DataFrame) -> DataFrame:
    """(value, is_term, shape, k): the distinct values with their mapped form and its key under the collation."""
    out = values.where(F.col("value").isNotNull()).groupBy("value").agg(F.max("is_term").alias("is_term"))
    return out.withColumn("shape", look_alike("value")).withColumn("k", F.collate("shape", "UNICODE"))


def classes(values: DataFrame) -> DataFrame:
    """(value, canonical) of every shaped value whose class has several members.

    The collation gathers what may be a class; of what it gathers, only those with
    several members are composed and compared exactly. A class holds spellings of
    one text, so windows over classes are small.
    """
    members = F.count(F.lit(1)).over(Window.partitionBy("k"))
    several = values.withColumn("members", members).where("members > 1").select("value", "is_term", composed(F.col("shape")).alias("form"))
    rank = F.struct((~F.col("is_term")).alias("a"), F.length("value").alias("b"), F.col("value").alias("c"))
    best = F.min(rank).over(Window.partitionBy("form"))
    return several.withColumn("best", best).select("value", F.col("best.c").alias("canonical"))


def _as_values(lines: DataFrame, terms: DataFrame) -> DataFrame:
    of_terms = terms.select(F.col("term").alias("value"), F.lit(True).alias("is_term"))
    return lines.select(F.col("text").alias("value"), F.lit(False).alias("is_term")).unionByName(of_terms)


def canonical_lines(lines: DataFrame, terms: DataFrame) -> DataFrame:
    """(line_id, page_id, line_no, text, canonical): every line with the one form of its text."""
    changed = classes(shaped(_as_values(lines, terms))).where("value <> canonical")
    out = lines.select("line_id", "page_id", "line_no", "text").join(changed, F.col("text") == F.col("value"), "left")
    return out.select("line_id", "page_id", "line_no", "text", F.coalesce("canonical", "text").alias("canonical"))


def headings(lines: DataFrame, terms: DataFrame) -> DataFrame:
    """(page_id, line_no, term_id) of lines that show a catalogue term in other characters."""
    of_terms = shaped(terms.select(F.col("term").alias("value"), F.lit(True).alias("is_term")))
    values = shaped(_as_values(lines, terms)).join(of_terms.select("k").distinct(), "k", "left_semi")
    form = cut(classes(values))  # the spellings of the terms that occur
    shown = terms.select("term_id", "term").join(form, F.col("term") == F.col("value")).select("term_id", "term", "canonical")
    texts = form.join(shown, "canonical").where("value <> term").select(F.col("value").alias("text"), "term_id")
    return lines.select("page_id", "line_no", "text").join(texts, "text").select("page_id", "line_no", "term_id").distinct()

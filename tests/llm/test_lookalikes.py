import unicodedata

from quirework.llm import lookalikes

TERMS = [(1, "Colección Quaélzor 7"), (2, "Фонд Лукор опись 71"), (3, "Office Press No 5"), (4, "北水奥维 80 集"), (5, "ミカサザコレクション 99"), (6, "Αρχείο Κ11"), (7, None), (8, "ATLAS VIII TOM X")]
SAME = {
    1: ["Colección Quaélzor 7", unicodedata.normalize("NFD", "Colección Quaélzor 7"), "Соlеcción Quаélzоr 7", "Ｃｏｌｅｃｃｉóｎ　Ｑｕａéｌｚｏｒ ７", "Colec­ción Quaél​zor 7", "﻿Colección Quaélzor 7 "],
    2: ["Фoнд Лyкop oпиcь 71", "Фонд Лукор опись 71", "Ф‍онд Лукор опи⁠сь 71"],
    3: ["Oﬃce Press No 5", "Offіce Рrеѕѕ Νο 5"],
    4: ["北⽔奥维 ８０ 集"],
    5: ["ﾐｶｻｻﾞｺﾚｸｼｮﾝ 99", "ﾐｶｻｻ゙コレクション 99", "ミカサザコレクション 99"],
    6: ["Αρχείο K11", "Αρχεί‌ο Κ１１", "Αρχείο Κ11"],
}
OTHER = ["Coleccion Quaelzor 7", "COLECCIÓN QUAÉLZOR 7", "colección quaélzor 7", "Colección Quaélzor 8", "Quaélzor Colección 7", "Colección  x Quaélzor 7", "0ffice Press No 5", "Αρχειο Κ11", "ミカササコレクション 99", "北水奥维 80 集b", "Office Press No ٥", "Office Press No ⁵", None, "", "  "]


def tables(spark, texts):
    lines = spark.createDataFrame([(i, i, 0, t, "clash") for i, t in enumerate(texts)], "line_id bigint, page_id bigint, line_no int, text string, canonical string")
    return lines, spark.createDataFrame(TERMS, "term_id int, term string")


def test_headings(spark):
    texts, want = [], set()
    for term, ways in SAME.items():
        for t in ways:
            if t != dict(TERMS)[term]:
                want.add((len(texts), 0, term))
            texts.append(t)
    lines, terms = tables(spark, texts + OTHER)
    assert {tuple(r) for r in lookalikes.headings(lines, terms).collect()} == want
    assert lookalikes.headings(lines.unionByName(lines), terms).count() == len(want)  # each case once
    assert lookalikes.headings(lines.where("false"), terms).count() == 0 == lookalikes.headings(lines, terms.where("false")).count()


def test_one_form_for_each_class(spark):
    texts = [t for ways in SAME.values() for t in ways] + OTHER + ["plаin", "plain", "plain"]
    lines, terms = tables(spark, texts)
    rows = lookalikes.canonical_lines(lines, terms).orderBy("line_id").collect()
    assert len(rows) == len(texts)
    got = [r["canonical"] for r in rows]
    at = 0
    for term, ways in SAME.items():
        assert set(got[at : at + len(ways)]) == {dict(TERMS)[term]}
        at += len(ways)
    assert got[at : at + len(OTHER) - 2] == OTHER[:-2]
    assert len(set(got[-3:])) == 1 and got[-1] in ("plain", "plаin")


def test_mapping_is_one_to_one_in_length():
    table = lookalikes.mapping()
    assert all(len(a) == len(b) == 1 and a != b for a, b in table.items())
    assert table["Ａ"] == "A" and table["ｺ"] == "コ" and table["⽔"] == "水" and table["ѐ"] == "è" and "²" not in table

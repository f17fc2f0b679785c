import pytest

from quirework.llm import noise

WORDS = [(w, "en") for w in "the keeper moved lantern shelf morning archive window under bright lamps harbour a flat-bed clerk".split()] + [(w, "de") for w in ("schluss-register", "für", "archiv")] + [(w, "zh") for w in ("整理了", "破损的页边", "在窗边", "第二遍时")]
LINES = "line_id bigint, page_id bigint, source_path string, line_no int, text string, polygon array<array<double>>, score double, loaded_at timestamp, source string, pos int"
PAGES = "page_id bigint, source_path string, page_no bigint, width int, height int"


def tables(spark, books):
    lines, pages, n = [], [], 0
    for source, book in books.items():
        for no, page in enumerate(book, 1):
            page_id = len(pages) + 1
            pages.append((page_id, source, no, 100, 200))
            for i, text in enumerate(page):
                n += 1
                lines.append((n, page_id, source, i, text, [[0.0, 30.0 * i], [9.0, 30.0 * i], [9.0, 30.0 * i + 20], [0.0, 30.0 * i + 20]], None, None, "clash", 9))
    return spark.createDataFrame(lines, LINES), spark.createDataFrame(pages, PAGES), spark.createDataFrame(WORDS, "word string, lang string")


def body(i):
    return [f"the keeper moved the lantern {i} under", "bright lamps under the window. The keeper", "the harbour archive."]


BOOK = [
    ["Annals of Osny Bay", *body(0), "- 11 -"],
    [*body(1), "5,123", "the clerk moved the arc-", "- 12 -"],
    ["Annals 0f Osny Bav", "hive. The keeper moved the 1antern.", *body(2), "- l3 -"],
    ["- 14 -   Annals of Osny Bay", *body(3), "moved the flat-"],
    ["Annals of Osny Bay", "bed lamps at the window, 12-", "14 lamps under the shelf -", "the Nyvel keeper", "- 15 -"],
    [*body(5), None, "   ", "the rnorning lamps", "- 16 -"],
    ["Annals of Osny Bay", "the southern window", "window —", "- 17 -"],
]


def by_kind(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["noise"], set()).add((r["page_id"], r["line_no"]))
    return out


def test_every_kind(spark):
    lines, pages, words = tables(spark, {"b": BOOK})
    got = by_kind(noise.noise(lines, pages, words))
    assert got["running"] == {(1, 0), (3, 0), (4, 0), (5, 0), (7, 0)}
    assert got["folio"] == {(1, 4), (2, 5), (3, 5), (5, 4), (6, 6), (7, 3)}
    assert got["hyphen"] == {(2, 4), (4, 4)}
    assert got["misread"] == {(3, 1), (6, 5)}


def test_text_without_blanks(spark):
    pages_of = [["第二遍时整理了破损的贞边，在", "窗边整理了破损的页边", "在窗辺，木达整理了"], ["在窗边", "第二遍时"], ["第ニ遍时整理了"]]
    lines, pages, words = tables(spark, {"b": pages_of})
    assert by_kind(noise.noise(lines, pages, words)) == {"misread": {(1, 0), (1, 2), (3, 0)}}


def test_compounds_capitals_and_late_detection(spark):
    book = [["das Schluss-", "Register für das Archiv", "the har-", "Bour"], ["fur das Archiv­", "iv kam"]]
    lines, pages, words = tables(spark, {"b": book})
    got = by_kind(noise.noise(lines, pages, words))
    assert got["hyphen"] == {(1, 0), (2, 0)}


def test_repeats_ties_and_missing_places(spark):
    lines, pages, words = tables(spark, {"b": BOOK, "c": [["the clerk moved a lan¬", "tern"]]})
    want = by_kind(noise.noise(lines, pages, words))
    again = by_kind(noise.noise(lines.unionByName(lines), pages, words))
    assert again == want and (8, 0) in want["hyphen"]
    flat = lines.withColumn("polygon", noise.F.lit(None).cast("array<array<double>>"))
    assert by_kind(noise.noise(flat, pages, words)) == want  # order of detection stands in
    lost = by_kind(noise.noise(lines, pages.where("false"), words))
    assert (8, 0) in lost["hyphen"] and "folio" not in lost
    assert noise.noise(lines.where("false"), pages, words).count() == 0
    assert "misread" not in by_kind(noise.noise(lines, pages, words.where("false")))


def test_paragraphs(spark):
    lines, pages, words = tables(spark, {"b": BOOK})
    got = [r["text"] for r in noise.paragraphs(lines, pages, words).orderBy("page_id", "line_no").collect()]
    whole = " ".join(got)
    assert "the clerk moved the archive. The keeper moved the lantern." in whole and "moved the flat-bed lamps" in whole and "the morning lamps" in whole
    assert "Annals" not in whole and "- 12 -" not in whole and "5,123" in got


LEARNT = ["the keeqer moved the lantern under", "the lamqs in the harbour", "the clerk under the lamps. The keeper", "a shelf in the morninq", "the briqht lamps, the archive", "a window for the clerk", "the wind0w and the c1erk", "the zorb moved", "the zorb under the lamps", "a zorb in the archive", "the zorb", "zorb zorb zorb", "the keeper"]


def test_confusions_are_learnt_from_the_corpus(spark):
    """No list names q for p or g; words that only the corpus knows are left alone."""
    words = spark.createDataFrame(WORDS + [(w, "en") for w in ("in", "and", "for", "orb", "perhaps", "map", "plan")], "word string, lang string")
    lines, pages, _ = tables(spark, {"b": [LEARNT, ["perhaqs the maq moved", "the qlan"]]})
    got = {(r["page_id"], r["line_no"]): r["corrected"] for r in noise._prepared(lines, pages, words, None)[3].collect()}
    assert got[(1, 0)] == "the keeper moved the lantern under" and got[(1, 1)] == "the lamps in the harbour" and got[(1, 3)] == "a shelf in the morning"
    assert got[(1, 4)] == "the bright lamps, the archive" and got[(2, 0)].startswith("perhaps the")
    assert not any("zorb" in LEARNT[no] for page, no in got if page == 1)


def test_exchanges_never_seen_are_smoothed():
    channel = noise.Channel({w: frozenset(["en"]) for w in ("the", "keeper", "window", "lantern", "windows")}, {}, {"the": 50, "keeper": 5, "window": 5}, {})
    for read, meant in (("keeqer", "keeper"), ("wimdow", "window"), ("lamtern", "lantern"), ("windov", "window"), ("win dow", None), ("kxxqer", None), ("tqe", None)):
        found = channel.misread(f"the {read} the", None, None)[1]
        assert [w for *_, w in found] == ([meant] if meant else []), read


def test_model_and_vocabulary_beyond_what_is_sent_out(spark, monkeypatch):
    lines, pages, words = tables(spark, {"b": BOOK})
    text = sorted(tuple(r) for r in noise.paragraphs(lines, pages, words).collect())
    monkeypatch.setattr(noise, "MAX_FACTS", 0)
    monkeypatch.setattr(noise, "MAX_WORDS", 3)
    assert sorted(tuple(r) for r in noise.paragraphs(lines, pages, words).collect()) == text


def test_near_words_against_brute_force():
    import random

    rng = random.Random(4)
    listed = {"".join(rng.choice("abc") for _ in range(rng.randint(2, 6))) for _ in range(60)}
    vocabulary = noise.Vocabulary({w: frozenset(["x"]) for w in listed})
    for _ in range(200):
        read = "".join(rng.choice("abc") for _ in range(rng.randint(1, 7)))
        want = {w for w in listed if w != read and any(read == w[:i] + new + w[j:] for i in range(len(w) + 1) for j in range(i, min(i + 2, len(w)) + 1) for new in {read[i : i + k] for k in (0, 1, 2)})}
        got = vocabulary.near(read)
        assert set(got) == want
        assert all(any(w[i:].startswith(b) and w[:i] + a + w[i + len(b) :] == read for i in range(len(w) + 1)) for w, (a, b) in got.items())


def test_long_line_and_unknown_words():
    channel = noise.Channel({"harbour": frozenset(["en"]), "in": frozenset(["en"])}, {}, {}, {})
    line, found = channel.misread("barbour " * 4000, None, None)
    assert len(found) == 4000 and {w for *_, w in found} == {"harbour"}
    assert channel.misread("page_00123.png K77 12- Nyvel harbour", None, None)[1] == []
    assert channel.misread("x­", None, None)[1] == []


@pytest.mark.parametrize("n,want", [(1, "i"), (4, "iv"), (49, "xlix"), (1994, "mcmxciv"), (0, None)])
def test_roman_numerals(spark, n, want):
    df = spark.createDataFrame([(n,)], "n int").select(noise._roman(noise.F.col("n")).alias("r"))
    df = df.select("r", noise._roman_value(noise.F.col("r")).alias("v"))
    assert df.first()["r"] == want and (want is None or df.first()["v"] == n)


def test_lines_without_page_or_number(spark):
    lines, pages, words = tables(spark, {"b": BOOK})
    odd = lines.limit(3).selectExpr("line_id + 1000 AS line_id", "CAST(NULL AS BIGINT) AS page_id", "source_path", "CAST(NULL AS INT) AS line_no", "'the rnorning lamps' AS text", "polygon", "score", "loaded_at", "source", "pos")
    got = noise.noise(lines.unionByName(odd), pages, words).collect()
    assert (None, None, "misread") in {tuple(r) for r in got} and (6, 5, "misread") in {tuple(r) for r in got}


def test_running_lines_of_a_long_source(spark):
    """A header of five pages counts in a long source as in a short one; usual text at edges does not."""
    titles = ["Of Tides", "Of Lamps", "Of Boats", "Of Ropes", "Of Wells", "Of Coal"]
    rows, want = [], set()
    for no in range(1, 3001):
        first = "the lantern was moved."
        if 500 <= no < 530:
            first = titles[(no - 500) // 5]
            first = first if no % 5 else first.replace("Of", "0f")
        elif no in (1535, 1536, 1537):  # a run over the end of a part
            first = "Of Salt"
        elif no % 499 == 3:  # far apart, but never inside
            first = "Of Snow"
        if first.startswith(("Of", "0f")):
            want.add((no, 1))
        inside = "See p. 5 at top" if no % 10 else "See p. 6 in all"
        edge = "See p. 7 at top" if no % 300 < 2 else "the clerk moved."
        page = [first, "the keeper moved.", inside, "the harbour archive.", "the shelf moved.", edge]
        rows += [("s", no, no, i + 1, text, text, i + 1, len(page)) for i, text in enumerate(page)]
    lines = spark.createDataFrame(rows, "source string, page_no bigint, page_id bigint, line_no int, text string, shape string, pos int, n bigint").withColumn("_page", noise.F.col("page_id").cast("string"))
    got = by_kind(noise.edge_noise(lines.repartition(4)))
    assert got == {"running": want}

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quirework.llm import sentences as sentences_module
from quirework.llm.sentences import Splitter, corpus_evidence, sentences

OPENERS = frozenset(["The", "Der", "Сканер", "Second", "Le", "This"])

#: Sentences are set between bars.
CASES = [
    ("|The keeper left.| |The door closed!| |Who came?|", False),
    ("|Mr. Nyzor and Mrs. Lis signed.| |Dr. Orim moved it to shelf No. 63.| |J. R. Nyrin kept the key... or so the note claims.|", False),
    ("|See vol. 22, pp. 8 to 74, for the older plates (cf. Fig. 82), although it was empty.| |The end.|", False),
    ("|Work resumed at 7 a.m.| |The lamp went out at 1 p.m. and the shift ended.| |Boxes, maps, seals, etc.| |The host scans.example/248 answered after 6.39 s.| |Dr. Orim left.|", False),
    ("|Is page_00532.json really empty?!| |Version 2.10.1 needs 4.6 seconds.|", False),
    ("|“The keeper left. The door closed,” said Dragar.| |“Stop it!” the clerk wrote at once.| |Rinny asked, “Who came?”| |“The door closed.”| |The end.|", False),
    ("|nobody noticed.||The narrow one stayed.|", False),
    ("|The first line\ngoes on here.|\n\n|A heading|\n\n|The second part.|", False),
    ("|first line|\n|WARN v0.5 differs!| |Keeping page_1.png.|\n|no answer in 30 s.| |Retry queued.|", True),
    ("|Der Rand misst 26,3 mm, d. h. etwas mehr.| |Vgl. Bd. 42, S. 63.| |Am 3. Mai kam der Band, z. B. in Raum Nr. 38.| |Karten, Briefe usw.| |Der Plan.|", False),
    ("|„Der Plan lag da. Der Band kam“, sagte Orim.| |Orim fragte: „Wer kam?“| |Der Plan.|", False),
    ("|Quaor demande : « Qui classe ? »| |Le lecteur lit, p. ex. dans page_1.tif, mais dort.| |Arrêtez la machine\xa0!| |M. Vanul et Mme Ny lisent.| |Le no. 80 manque toujours...| |Le lecteur dort.|", False),
    ("|El Sr. Ulv lee la pág. 37 del vol. 65.| |¡Detengan la máquina!| |«El índice guarda. El archivo lee», dijo Orth.|", False),
    ("|Карты, письма и т. д.| |В 1952 г. Зевтис принял страницы, т. е. весь ящик.| |«Он ушёл. Она пришла», — сказал Мордол.| |См. рис. 51 на стр. 44.| |Сканер стоит.|", False),
    ("|Ποιος μέτρησε το κεφάλαιο;| |Ο κ. Τισμορ έχασε τις σελίδες.| |Βλ. σελ. 56 του τόμου.| |Το περιθώριο είναι 35,9 χιλ. περίπου.|", False),
    ("|页边宽39.6毫米。||谁来了？！||他问：“谁来了？”||“相册压平了！”木苏贝在窗边写道。||几册相册.||短暂停机后……最后还是测量了。|", False),
    ("|木达说：“画册来了。信差走了。”||版本3.\n10.5每页需要5秒。||共计42张，其中No.71缺失。|", False),
    ("|すぐに止めて！||「製本班は写した。係員は並べた。」とリソは言った。||ノミテは「閲覧室は保管した」と書いた。|", False),
    ("|ใครคัดลอกบทที่หายไป| |ขอบกว้าง 17.2 มิลลิเมตร| |เครื่องสแกนวัด 50 แผ่นหลังพักสั้นๆ| |ห้องอ่านหนังสือสร้างไฟล์ page_1.json แล้ว|", False),
    ("|रात का लिपिक जाता है।| |“वह गया। वह आया।” मोरवेन ने कहा।| |डॉ. लुक ने पृ. 24 और सं. 19 देखे।| |क्या वह आया?|", False),
    ("|الماسح يقيس الصفحات.| |انظر ص. 79 من المجلد.| |د. مور يحفظ ورقة.| |«الماسح يرتب. السجل ينسخ» كتب لوك في الدفتر.| |هل يرتب؟|", False),
    ("|\tno end mark|", True), ("|12. The heading|", False), ("|(The whole was bracketed.)| |The end|", False), ("|An “open quote.| |That never closes.| |The end.|", False),
]


@pytest.mark.parametrize("marked,hard", CASES)
def test_sentences(marked, hard):
    text, want, at = "", [], None
    for c in marked:
        if c == "|":
            if at is None:
                at = len(text)
            else:
                want.append((at, len(text)))
                at = None
        else:
            text += c
    got = Splitter(openers=OPENERS).split(text, hard)
    want = [(a + (len(text[a:b]) - len(text[a:b].lstrip())), b) for a, b in want]
    assert [text[a:b] for a, b in got] == [text[a:b] for a, b in want]
    assert got == want


PIECES = st.sampled_from(list("aB.!?…。！;;\n\r\t \xa0“”„«»「」()12新かกไ।؟ЖжΑα'-,:") + ["Mr. ", "\n\n", "e.g. ", "...", "The ", " said "])


@settings(max_examples=400, deadline=None)
@given(st.lists(PIECES, max_size=60).map("".join), st.booleans())
def test_sentences_cover_everything_but_blanks(text, hard):
    got = Splitter().split(text, hard)
    covered = [False] * len(text)
    last = 0
    for a, b in got:
        assert last <= a < b <= len(text) and not text[a].isspace() and not text[b - 1].isspace()
        for i in range(a, b):
            covered[i] = True
        last = b
    assert all(covered[i] or text[i].isspace() for i in range(len(text)))


def test_operator(spark):
    rows = [(1, "One. Two.", "en", None), (2, None, None, "hard"), (3, "", "en", "hard"), (4, " \n ", "en", "wrapped"), (5, "a\nb", None, "hard"), (6, "x. Y " * 20_000, "en", "wrapped"), (7, "One. Two.", "en", None), (None, None, None, None)]
    df = spark.createDataFrame([(i, t, lang, m, 1) for i, t, lang, m in rows], "doc_id bigint, text string, lang string, line_mode string, start_pos int")
    got = {}
    for r in sentences(df).collect():
        got.setdefault(r["doc_id"], []).append((r["start_pos"], r["end_pos"]))
    assert got[1] == got[7] == [(0, 4), (5, 9)] and sorted(got[5]) == [(0, 1), (2, 3)] and set(got) == {1, 5, 6, 7} and len(got[6]) > 1000
    assert sentences(df.where("false")).count() == 0


#: Words of the lists that are ordinary words here; what the document or the next word shows must come before the list.
ORDINARY = [
    "|He said no.| |Then he left the room.|", "|She studied art.| |It was hard.|", "|There is no fig.| |A fig fell.| |Nobody ate a fig.|",
    "|Dijo que no.| |Luego salió.|", "|No quiso un vol.| |Nadie lo vio.|", "|Sie malte in ihrer Art.| |Dann ging sie.|", "|Er trug die Nr.| |Dann ging er.|",
    "|Il étudie l’art.| |Puis il part.|", "|Il faut voir.| |Puis il part.|", "|Это старый рис.| |Потом он ушёл.|", "|Она ела рис.| |Рис был вкусный.|", "|Το βιβλίο έχει σελ.| |Μετά έφυγε.|",
    "|他没有来。| |他走了。|", "|彼は来なかった。||そして帰った。|", "|वह नहीं आया।| |फिर वह गया।|", "|لم يأت أحد.| |ثم غادر.|", "|เขาไม่มา| |แล้วเขาก็ไป|",
    # the document shows the word without a period, so it ends a sentence even before a name
    "|The ed was old, an ed like any ed.| |Nyvel left.|",
    # and the other way round: the document shows an unlisted word as an abbreviation
    "|Blz. vier is leeg, blz. acht ook.| |Zie blz. Nyvel.|",
    "|The answer was no.| |Nobody asked, see no. 5 and no. 7.|",
]


@pytest.mark.parametrize("marked", ORDINARY)
def test_the_document_before_the_lists(marked):
    test_sentences(marked, False)


def sets_of(df):
    rows = df.collect()
    return {k: {r["word"] for r in rows if r[k]} for k in ("abbreviation", "ordinary", "opener")}


def test_evidence_is_counted_over_the_corpus(spark):
    rows = [(f"Siehe Abb. {i} und blz. vier.\n\nZebra kam. Der Rest art und no.", "wrapped") for i in range(20)] + [("The art was no\n\nart.\nno x. Out. Out.", "hard")] * 30
    got = sets_of(corpus_evidence(spark.createDataFrame([*rows, (None, None), ("", "hard")], "text string, line_mode string")))
    assert {"abb", "blz"} <= got["abbreviation"] and "no" not in got["abbreviation"]
    assert {"Zebra"} <= got["opener"] and {"art", "no"} <= got["ordinary"]
    # nothing is lost because there is more of something else
    many = spark.createDataFrame([*rows, *[("Nothing goes on. Out. " * 400, "wrapped")] * 40], "text string, line_mode string")
    assert "blz" in sets_of(corpus_evidence(many))["abbreviation"]


def test_python_and_jvm_see_the_same_evidence(spark):
    texts = ["Siehe Abb. 7, z. B. in a.b. c. Wort. und", "x.\n\ny. 5 z.\n a. b\n\nThe End? Yes! No one said Orim, Lis.", "A" * 30 + ". b c.d.e. f", "  \xa0No.\xa05", "а.б. в Э. Слово. 7"]
    for text in texts:
        row = spark.createDataFrame([(text,)], "t string").select(
            sentences_module.F.regexp_extract_all("t", sentences_module.F.lit(sentences_module.JVM_GOES_ON)).alias("g"),
            sentences_module.F.regexp_extract_all("t", sentences_module.F.lit(sentences_module.JVM_INSIDE)).alias("i"),
        ).first()
        assert row["g"] == sentences_module.GOES_ON.findall(text) and row["i"] == sentences_module.INSIDE.findall(text)


def test_evidence_beyond_what_is_sent_out_is_joined(spark, monkeypatch):
    rows = [(i, f"Zie blz. vier. Dit is blz. Nyvel hier.\n\nZebra kam. Siehe xyz. drei. Am xyz. Zebra lief. Am xyz. Orim lief {i % 3}.", "wrapped") for i in range(30)]
    rows += [(100 + i, "Dit is blz. Nyvel hier. Am xyz. Zebra lief.", "wrapped") for i in range(5)] + [(None, "Dit is blz. Nyvel hier.", None), (200, None, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, line_mode string")
    read = lambda: sorted((str(r[0]), r[1], r[2]) for r in sentences(df).collect())
    want = read()
    assert ("None", 0, 23) in want and ("100", 24, 31) in want
    for bound in (0, 1, 2):
        monkeypatch.setattr(sentences_module, "HOT_WORDS", bound)
        assert read() == want


@pytest.mark.parametrize("text", ["“" * 60_000, "“a.” " * 20_000, "Plan B. Then. " * 20_000, "J. R. " * 20_000, ". " * 50_000, "a" * 200_000, "（" * 50_000 + "。", "Dr. " * 30_000, "„" * 60_000 + "”" * 60_000, "ab" * 100_000 + ". X", "no. Then " * 20_000, "a.b." * 40_000 + " Then", " " * 100_000 + "a." + " " * 100_000 + "B"])
def test_long_texts_take_their_time_once(text):
    import time

    began = time.process_time()
    Splitter().split(text, False)
    assert time.process_time() - began < 20


def test_a_document_without_id(spark):
    df = spark.createDataFrame([(None, "One. Two.", "wrapped"), (3, "One.", "wrapped")], "doc_id bigint, text string, line_mode string")
    assert sorted((str(r["doc_id"]), r["start_pos"]) for r in sentences(df).collect()) == [("3", 0), ("None", 0), ("None", 5)]

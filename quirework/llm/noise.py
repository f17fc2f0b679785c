"""Noise in the text of scanned pages, found and repaired.

Method: noisy-channel correction. Character confusion probabilities times corpus
n-gram likelihood are decoded by Viterbi over candidate words per line (over
candidate phrases where a script writes no blanks). The confusions are learnt from
the corpus: unknown tokens are aligned with the vocabulary words that one exchange
of up to two characters makes of them, and the exchanges that many different words
share are counted by expectation maximisation; all others keep a small smoothed
probability. A token far more frequent than its confusions explain is a word of its
own. Around it: running lines and page numbers by recurrence at the edges of a
source's pages, divided words by the next body line wherever it stands, and
paragraphs from what is left.

Where rows meet: a page is a small group by nature, so order and neighbours within
it are windows over the page. Sources may be huge, so nothing but counts, edge
lines and one row per page is ever grouped or ordered by source, and the order of a
source's pages is taken in chunks. Workers get the language model while it has at
most ``MAX_FACTS`` counts; beyond that each line is joined with the counts it needs.
A vocabulary above ``MAX_WORDS`` is first reduced to the words that can matter.

Defined results: null and blank lines are no noise and part of nothing; of repeated
lines (page, number) the one with the largest id counts; lines without a polygon
stand below the others in order of detection; a line without a number repeats no
other; a line whose page is not listed keeps its own source and has no neighbours
on other pages; one without a page stands alone; an empty table gives no rows.
"""

from __future__ import annotations

import math
import unicodedata
import uuid
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex as re
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirework.functions.ranks import last_in_sequence, next_in_sequence
from quirework.llm.lookalikes import LIGATURES, look_alike, mapping
from quirework.session import cut, row_count_at_most, spread

#: Words held by a worker, and counts of the language model sent to it; more are joined.
MAX_WORDS, MAX_FACTS = 1_000_000, 2_000_000
#: A running line stands at the edge of at least so many pages; counted over two parts of STRETCH pages. One on this share of a source's pages is looked for in all its parts.
RUNNING_PAGES, SURE_PAGES, STRETCH, RUNNING_SHARE = 2, 6, 128, 0.005
#: Pages of one part of a paragraph.
SPAN = 16
#: Share of a running line's letters that damage may change.
DAMAGE = 0.3

#: Share of words that are misread, and the weight of an exchange that was never seen, by the characters read and meant.
MISREAD = 0.05
SMOOTHING = {(1, 1): 0.02, (2, 1): 0.005, (1, 2): 0.005, (1, 0): 0.001, (0, 1): 0.001, (2, 2): 0.0005, (2, 0): 0.0002, (0, 2): 0.0002}
#: Weight of all exchanges never seen; what an exchange with an accent takes from the one without, and one from its reverse.
UNSEEN, ACCENTED, REVERSED = 20.0, 0.05, 0.02
#: Cost of a letter of an unknown word: -log of one in 27.
LETTER_COST = 3.3
#: A token seen so often, and so many times as often as confusions explain, is a word of its own.
OWN_COUNT, OWN_TIMES = 5, 100

BLANK = r"[\p{Z}\s]"
HYPHEN = "[-‐‑¬­]"
DIVIDED = rf"\p{{L}}\p{{M}}*{HYPHEN}{BLANK}*$"
TERMINAL = r"[.!?。！？,;:…，；：]$"
DECORATED = r"^(第|p\. ?|[-—–·\[(] ?)?([0-9lIiOoSsBbZzgqxvcdmLXVCDM|!]{1,7})( ?[-—–·\])]|\.|页)?$"
#: The same beside a running line, at its start or end.
BESIDE = r"((?:第|p\. ?|[-—–·\[(] ?)?[0-9lIiOoSsBbxvcdmLXVCDM]{1,7}(?: ?[-—–·\])]|\.|页)?)"
LOOKS = ("lIi|!OoQSsBbZzgq", "11111000558822" + "99")


# ---------------------------------------------------------------- pages and edges

#: A line: its place among the lines of its page, and its own ids.
LINE = ["_page", "pos", "page_id", "line_no"]


def ordered_lines(lines: DataFrame, pages: DataFrame) -> DataFrame:
    """(source, page_no, page_id, _page, line_no, text, shape, pos, n): the lines of each page from top to bottom.

    ``_page`` is the page's name, also of the lines without one.
    """
    own = lines.select("page_id", "line_no", "line_id", F.col("source_path").alias("_own"), "text", F.array_min(F.transform("polygon", lambda p: F.get(p, F.lit(1)))).alias("y"))
    own = own.where(F.col("text").isNotNull() & F.col("text").rlike(r"[^\p{Z}\s\p{Cf}]"))
    place = pages.select("page_id", F.col("source_path").alias("_source"), "page_no")
    rows = own.join(place, "page_id", "left").withColumn("source", F.coalesce("_source", "_own"))
    # lines without a page are no page together; all windows share one partitioning by page
    lone = F.concat_ws("|", F.lit("lone"), "line_id", F.xxhash64("line_id", "_own", "line_no", "text"))
    rows = rows.withColumn("_page", F.coalesce(F.col("page_id").cast("string"), lone))
    page = Window.partitionBy("_page")
    latest = page.orderBy("line_no", F.desc("line_id"))
    repeats = F.coalesce(F.col("line_no") == F.lag("line_no").over(latest), F.lit(False))
    rows = rows.withColumn("_repeats", repeats).where("NOT _repeats")
    order = page.orderBy(F.asc_nulls_last("y"), "line_no", F.desc("line_id"))
    return rows.select("source", "page_no", "page_id", "_page", "line_no", "text", look_alike("text").alias("shape"), F.row_number().over(order).alias("pos"), F.count(F.lit(1)).over(page).alias("n"))


def without_number(shape: Column) -> Column:
    """A line without the words that may be its page number."""
    number = r"^[^\p{L}\p{N}]*(第|p)?[0-9lIiOoSsB]*[0-9][0-9lIiOoSsB]*(页)?[^\p{L}\p{N}]*$|^[ivxlcdm]{1,8}\.?$|^p\.$"
    return F.array_join(F.filter(F.split(shape, " +"), lambda t: ~t.rlike(number)), " ")


def letters(text: Column) -> Column:
    """Its letters, small."""
    return F.lower(F.regexp_replace(text, r"[^\p{L}]", ""))


def _roman(n: Column) -> Column:
    """Small roman numerals of a positive number."""
    marks = [(1000, "m"), (900, "cm"), (500, "d"), (400, "cd"), (100, "c"), (90, "xc"), (50, "l"), (40, "xl"), (10, "x"), (9, "ix"), (5, "v"), (4, "iv"), (1, "i")]
    out, left = F.lit(""), F.when((n > 0) & (n < 4000), n.cast("int"))
    for value, mark in marks:
        out = F.concat(out, F.repeat(F.lit(mark), F.floor(left / value).cast("int")))
        left = left % value
    return out


def _roman_value(s: Column) -> Column:
    """The number of small roman numerals, null for anything else."""
    value = F.create_map(*[F.lit(x) for pair in (("i", 1), ("v", 5), ("x", 10), ("l", 50), ("c", 100), ("d", 500), ("m", 1000)) for x in pair])
    numbers = F.transform(F.split(s, ""), lambda c: F.coalesce(value[c], F.lit(0)))
    total = F.aggregate(
        numbers,
        F.struct(F.lit(0).alias("sum"), F.lit(0).alias("last")),
        lambda a, x: F.struct((a["sum"] + x - F.when(x > a["last"], 2 * a["last"]).otherwise(0)).alias("sum"), x.alias("last")),
        lambda a: a["sum"],
    )
    return F.when(s.rlike("^[ivxlcdm]+$"), total)


def edge_noise(rows: DataFrame, terms: DataFrame | None = None) -> DataFrame:
    """(_page, pos, page_id, line_no, noise): running lines and page numbers among the two outer lines at either end of a page.

    A model of a running line is a line that recurs at edges more often than inside
    pages, starts like a title and has no end mark; with few occurrences it must
    also look like one: no long word in small letters. Headings of ``terms`` that
    happen to lie at edges are none. What recurs is counted over stretches of pages,
    whatever the length of the source, and must there be no text that is as usual in
    the whole source; what recurs only far apart must do so on ``SURE_PAGES`` pages
    and hardly ever inside. Other edge lines are running if damage to few of its
    letters makes them from a model of their part of the source, or from one that
    stands on RUNNING_SHARE of all its pages.
    """
    rest = without_number(F.col("shape"))
    part = F.floor(F.coalesce("page_no", "page_id", F.lit(0)) / STRETCH)
    keyed = rows.withColumn("rest", rest).withColumn("key", letters(F.col("rest"))).withColumn("part", part)
    is_edge = (F.col("pos") <= 2) | (F.col("pos") > F.col("n") - 2)
    title = is_edge & ~F.col("rest").rlike(TERMINAL) & ~F.col("rest").rlike(r"^[^\p{L}]*\p{Ll}") & (F.length("key") >= 3)
    styled = ~F.col("rest").rlike(r"(^|[^\p{L}])\p{Ll}{5,}")
    # a running line stands at edges; what stands in the body as often is text that happens to lie there
    titles = keyed.where(title).groupBy("source", "part", "key").agg(F.count(F.lit(1)).alias("at_edge"), F.count(F.when(styled, 1)).alias("styled"))
    if terms is not None:
        known = terms.where(F.col("term").isNotNull()).select(letters(without_number(look_alike("term"))).alias("key")).distinct()
        titles = titles.join(known, "key", "left_anti")
    titles = cut(titles)
    total = [F.sum(c).alias(c) for c in ("at_edge", "styled")]
    recurs = f"at_edge >= {SURE_PAGES} OR styled >= {RUNNING_PAGES}"
    stretches = F.explode(F.array(F.col("part") - 1, F.col("part")))  # two parts each: a run that a part's end cuts is whole in one of them
    near = titles.withColumn("stretch", stretches).groupBy("source", "stretch", "key").agg(*total).where(recurs)
    sizes = rows.where("pos = 1").groupBy("source").agg(F.count(F.lit(1)).alias("pages"))
    whole = titles.groupBy("source", "key").agg(*total).where(recurs).join(sizes, "source")
    inside = cut(keyed.where(~is_edge).select("source", "part", "key").join(whole, ["source", "key"], "left_semi").groupBy("source", "part", "key").agg(F.count(F.lit(1)).alias("inside")))
    whole = cut(whole.join(inside.groupBy("source", "key").agg(F.sum("inside").alias("inside")), ["source", "key"], "left").fillna(0, ["inside"]))
    # recurring so often that every edge line of the source is compared with it
    often = (F.col("at_edge") >= F.col("pages") * RUNNING_SHARE) & (F.col("at_edge") > F.col("inside"))
    others = whole.where(~often)
    around = inside.withColumn("stretch", stretches).groupBy("source", "stretch", "key").agg(F.sum("inside").alias("here"))
    usual = F.col("inside") * F.least(F.lit(1.0), 2 * STRETCH / F.col("pages"))
    near = near.join(others.select("source", "key", usual.alias("usual")), ["source", "key"]).join(around, ["source", "stretch", "key"], "left")
    near = near.where((F.col("at_edge") > F.coalesce("here", F.lit(0))) & (F.col("at_edge") > 3 * F.col("usual")))
    near = near.select("source", F.explode(F.array("stretch", F.col("stretch") + 1)).alias("part"), "key")
    spread = others.where((F.col("at_edge") >= SURE_PAGES) & (F.col("at_edge") > SURE_PAGES * F.col("inside")))
    near = near.union(titles.join(spread.select("source", "key"), ["source", "key"]).select("source", "part", "key")).distinct()
    near = near.where(~F.coalesce(_roman(_roman_value(F.col("key"))) == F.col("key"), F.lit(False))).withColumnRenamed("key", "model")
    far = whole.where(often).select("source", F.col("key").alias("model"))
    edges = cut(keyed.where(is_edge).select("source", "part", "page_no", *LINE, "shape", "key"))
    limit = F.greatest(F.lit(1), F.floor(F.length("model") * DAMAGE).cast("int"))
    close = (F.abs(F.length("key") - F.length("model")) <= limit) & (F.levenshtein("key", "model") <= limit)
    long_enough = F.length("key") * 2 > F.length("model")
    readable = edges.where("length(key) >= 2")
    running = readable.join(far, "source").where(long_enough & close).select(*LINE)
    running = running.union(readable.join(near, ["source", "part"]).where(long_enough & close).select(*LINE))
    running = cut(running.distinct().withColumn("noise", F.lit("running")))

    alone = F.when(F.length("shape") <= 14, F.col("shape"))
    joined = F.coalesce(F.nullif(F.regexp_extract("shape", rf"^{BESIDE} +\p{{L}}.{{3}}", 1), F.lit("")), F.nullif(F.regexp_extract("shape", rf"\p{{L}}[^ ]* +{BESIDE}$", 1), F.lit("")))
    marked = edges.join(running.select("_page", "pos", "noise"), ["_page", "pos"], "left").withColumn("mark", F.when(F.col("noise").isNotNull(), joined).otherwise(alone)).drop("noise")
    marked = marked.withColumn("num", F.regexp_extract("mark", DECORATED, 2))
    marked = marked.withColumn("pre", F.trim(F.regexp_extract("mark", DECORATED, 1))).withColumn("post", F.trim(F.regexp_extract("mark", DECORATED, 3)))
    digits = F.translate("num", *LOOKS)
    arabic = F.when(digits.rlike("^[0-9]{1,6}$") & F.col("num").rlike("[0-9]"), digits.cast("int"))
    votes = marked.where("num <> ''").select(
        "source", "pre", "post",
        F.explode(F.array_compact(F.array(
            F.when(arabic.isNotNull(), F.struct(F.lit("arabic").alias("kind"), (arabic - F.col("page_no")).alias("shift"))),
            F.when(_roman_value(F.col("num")).isNotNull(), F.struct(F.lit("roman").alias("kind"), (_roman_value(F.col("num")) - F.col("page_no")).alias("shift"))),
        ))).alias("v"),
    )
    styles = votes.groupBy("source", "pre", "post", "v.kind", "v.shift").agg(F.count(F.lit(1)).alias("votes"))
    styles = styles.where("votes >= 2").groupBy("source").agg(F.max(F.struct("votes", "kind", "shift", "pre", "post")).alias("s"))
    styles = styles.select("source", "s.kind", "s.shift", "s.pre", "s.post")
    candidates = edges.where(F.length("shape") <= 14).join(styles, "source")
    due = F.col("page_no") + F.col("shift")
    due_text = F.when(F.col("kind") == "roman", _roman(due)).otherwise(due.cast("string"))
    expected = F.concat("pre", due_text, "post")
    seen = F.regexp_replace("shape", " ", "")
    as_digits = F.when(F.col("kind") == "arabic", F.translate(seen, *LOOKS)).otherwise(seen)
    wanted = F.regexp_replace(F.when(F.col("kind") == "arabic", F.translate(expected, *LOOKS)).otherwise(expected), " ", "")
    slack = F.when(F.length(wanted) <= 2, 0).otherwise(1)
    folio = candidates.where((due > 0) & (F.levenshtein(as_digits, wanted) <= slack)).select(*LINE).distinct()
    folio = folio.join(running, ["_page", "pos"], "left_anti").select(*LINE).withColumn("noise", F.lit("folio"))
    return running.unionByName(folio)


def body_lines(rows: DataFrame, edge: DataFrame) -> DataFrame:
    """Lines of running text with ``before`` and ``after``: the body lines next to them, across pages."""
    body = rows.join(edge.select("_page", "pos"), ["_page", "pos"], "left_anti")
    order = Window.partitionBy("_page").orderBy("pos")
    body = body.withColumn("after", F.lead("text").over(order)).withColumn("before", F.lag("text").over(order))
    ends = body.groupBy("_page").agg(F.first("source").alias("source"), F.first("page_no").alias("page_no"), F.min_by("text", "pos").alias("head"), F.max_by("text", "pos").alias("tail"))
    chain = next_in_sequence(ends.where("page_no IS NOT NULL"), "source", "page_no", F.struct("_page", "head"), "next")
    follow = chain.select("_page", F.col("next.head").alias("_next_head"))
    precede = chain.where("next IS NOT NULL").select(F.col("next._page").alias("_page"), F.col("tail").alias("_prev_tail"))
    body = body.join(follow, "_page", "left").join(precede, "_page", "left")
    return body.withColumn("after", F.coalesce("after", "_next_head")).withColumn("before", F.coalesce("before", "_prev_tail")).drop("_next_head", "_prev_tail")


# ---------------------------------------------------------------- the channel


def shaped(text: str, table: dict[int, str]) -> str:
    """Python's counterpart of ``look_alike`` for one text."""
    if text.isascii():
        return text
    return unicodedata.normalize("NFC", INVISIBLE_PY.sub("", text).translate(table))


INVISIBLE_PY = re.compile(r"[\p{Cf}͏ᅟᅠㅤﾠ︀-️]")
TOKEN = re.compile(r"(?<!\S)[“„«‹(\[{¿¡\"'‘’「『]*(\S+?)[.,;:!?…”“»›)\]}\"'’」』]*(?!\S)")
PLAIN = re.compile(r"[\p{L}\p{M}\p{Nd}@$|!-]+$")
LETTER = re.compile(r"\p{L}")
HAN = re.compile(r"\p{Han}")
#: What may be read for a Chinese character: one, or a sign of another script without case.
SIGN = re.compile(r"\p{Lo}")
ENDS_DIVIDED = re.compile(DIVIDED)


class Vocabulary:
    """Words and phrases, and the words that one exchange of up to two characters may have made into a token.

    The index holds a hash and a number for each place of each word: about 36
    bytes a letter, in arrays.
    """

    def __init__(self, words: dict[str, frozenset[str]]):
        self.words = frozenset(w for w, langs in words.items() if langs - {"zh"})
        self.phrases = frozenset(w for w, langs in words.items() if "zh" in langs)
        self.list = sorted(w for w in self.words if len(w) > 1)
        self.longest = max(map(len, self.list), default=0)
        keys, numbers = [], []
        for n, w in enumerate(self.list):
            found = [hash(k) for k, _ in self.gaps(w)]
            keys += found
            numbers += [n] * len(found)
        order = np.argsort(np.array(keys, dtype="int64"), kind="stable")
        self.keys, self.numbers = np.array(keys, dtype="int64")[order], np.array(numbers, dtype="int32")[order]

    @staticmethod
    def gaps(w: str) -> list[tuple[str, str]]:
        """(what is left around a gap, what stood in it) for every gap of up to two characters."""
        return [(w[:i] + "\0" + w[i + k :], w[i : i + k]) for k in (0, 1, 2) for i in range(len(w) - k + 1)]

    def near(self, read: str) -> dict[str, tuple[str, str]]:
        """word -> (read, meant), the shortest exchange that leads from the word to ``read``."""
        out: dict[str, tuple[str, str]] = {}
        if not self.list or len(read) > self.longest + 2:
            return out
        gaps = self.gaps(read)
        hashes = np.array([hash(k) for k, _ in gaps], dtype="int64")
        lo, hi = np.searchsorted(self.keys, hashes, "left"), np.searchsorted(self.keys, hashes, "right")
        for g in np.nonzero(hi > lo)[0]:
            key, a = gaps[g]
            at = key.index("\0")
            for n in self.numbers[lo[g] : hi[g]]:
                w = self.list[n]
                b = w[at : at + len(w) - len(key) + 1]
                if w != read and w[:at] + "\0" + w[at + len(b) :] == key and len(b) <= 2:
                    if a and b and (a[0] == b[0] or a[-1] == b[-1]):
                        continue  # a shorter exchange says the same
                    if w not in out or (len(a) + len(b), a, b) < (len(out[w][0]) + len(out[w][1]), *out[w]):
                        out[w] = a, b
        return out


def plain_letter(c: str) -> str:
    return "".join(x for x in unicodedata.normalize("NFD", c) if not unicodedata.combining(x))


class Channel:
    """What may have stood where something was read, and how likely it is.

    ``learnt`` tells in how many different words each exchange (read, meant) was
    seen, ``own`` the tokens that are words although the vocabulary lacks them.
    """

    def __init__(self, words: dict[str, frozenset[str]] | Vocabulary, bigrams: dict[tuple[str, str], int], unigrams: dict[str, int], learnt: dict[tuple[str, str], float], own: frozenset[str] = frozenset()):
        self.vocabulary = words if isinstance(words, Vocabulary) else Vocabulary(words)
        self.words, self.phrases = self.vocabulary.words, self.vocabulary.phrases
        self.bigrams, self.unigrams, self.own = bigrams, unigrams, own
        self.total = sum(unigrams.values()) + len(self.words) + 1
        # one word may be a coincidence: each exchange is discounted by one
        self.seen = {p: n - 1 for p, n in learnt.items() if n > 1}
        self.whole = sum(self.seen.values()) + UNSEEN
        self.by_read: dict[str, list[tuple[str, float]]] = defaultdict(list)
        for a, b in sorted({*self.seen, *((b, a) for a, b in self.seen)}):
            if a and self._weight(a, b) >= 1:
                self.by_read[a].append((b, self.cost(a, b)))
        self.longest = max((len(a) for a in self.by_read), default=1)
        self.table = {ord(a): b for a, b in (mapping() | LIGATURES).items()}
        self.table |= {c: " " for c in (0xA0, 0x2007, 0x2009, 0x202F, 0x3000, 0x2002, 0x2003, 0x2004, 0x2005, 0x2006, 0x2008, 0x200A, 0x1680, 0x205F, 0x85, 0x2028, 0x2029)}
        self.openings: dict[str, list[tuple[str, str]]] = defaultdict(list)
        for p in self.phrases:
            for i in range(len(p)):
                self.openings[p[:i] + "\0" + p[i + 1 :]].append((p, p[i]))
        self.lengths = sorted({len(p) for p in self.phrases})
        self.phrase_chars = frozenset("".join(self.phrases))
        self.known: dict[str, tuple[tuple[str, float], ...]] = {}

    def cost(self, a: str, b: str) -> float:
        """-log of the probability that a word is misread by reading ``a`` for ``b``."""
        return -math.log(MISREAD * self._weight(a, b) / self.whole)

    def _weight(self, a: str, b: str) -> float:
        weight = self.seen.get((a, b), 0.0) + REVERSED * self.seen.get((b, a), 0.0) + SMOOTHING[len(a), len(b)]
        plain = plain_letter(b)
        if plain != b:
            weight += ACCENTED * self.seen.get((a, plain), 0.0)
        return weight

    def _edits(self, word: str) -> list[tuple[str, float]]:
        out = []
        for i in range(len(word)):
            for k in range(1, self.longest + 1):
                for b, c in self.by_read.get(word[i : i + k], ()) if i + k <= len(word) else ():
                    out.append((word[:i] + b + word[i + k :], c))
        return out

    def _candidates(self, read: str) -> tuple[tuple[str, float], ...]:
        """(word, cost) that ``read`` may stand for, itself first if it is a word."""
        low = read.lower()
        found: dict[str, float] = {}
        if low in self.words:
            found[low] = 0.03
            if len(low) > 1:
                for once, c in self._edits(low):
                    if once in self.words and len(once) > 1:
                        found[once] = min(found.get(once, 99.0), c)
        elif len(low) > 1 and low not in self.own:
            # an exchange never seen must be less of a wonder than the letters of an unknown word
            most = LETTER_COST * (len(low) - 1)
            for word, (a, b) in self.vocabulary.near(low).items():
                c = self.cost(a, b)
                if self._weight(a, b) >= 1 or c <= most and len(a) == 1 == len(b) or c <= most - LETTER_COST and len(a) and len(b):
                    found[word] = c
            if len(low) > 3 and len(low) <= self.vocabulary.longest + 2 and not any(c < 12 for c in found.values()):
                for once, c in self._edits(low):
                    for twice, d in self._edits(once):
                        if twice in self.words and len(twice) > 3:
                            found[twice] = min(found.get(twice, 99.0), c + d)
        return tuple(sorted(found.items(), key=lambda x: (x[1], x[0])))

    def needs(self, text: str, before: str | None) -> set[tuple[str, str]]:
        """The counts that the decoding of a line may ask for: pairs of words, and tokens that may be words of their own."""
        toks = self.tokens(shaped(text, self.table))
        found = [self.options(t) for t, _, _ in toks]
        if not any(o and (len(o) > 1 or o[0][0] != t.lower()) for o, (t, _, _) in zip(found, toks)):
            return set()
        out = {(t.lower(), OWN) for o, (t, _, _) in zip(found, toks) if o and o[0][0] != t.lower()}
        for left, right in zip(found, found[1:]):
            out |= {(v, w) for v, _ in left for w, _ in right}
        return out

    def with_facts(self, facts) -> None:
        """Counts of one line (a, b, n) instead of those of the whole corpus."""
        self.bigrams = {(a, b): n for a, b, n in facts if b != OWN}
        self.own = frozenset(a for a, b, _ in facts if b == OWN)
        self.known.clear()

    def _follows(self, a: str, b: str) -> float:
        """-log P(b | a), the bigram backed off to the single word."""
        single = (self.unigrams.get(b, 0) + 1) / self.total
        seen = self.unigrams.get(a, 0)
        return -math.log((self.bigrams.get((a, b), 0) + 2 * single) / (seen + 2))

    def tokens(self, text: str) -> list[tuple[str, int, int]]:
        """(word, start, end) between blanks, without the marks around it."""
        return [(m[1], m.start(1), m.end(1)) for m in TOKEN.finditer(text)]

    def options(self, token: str) -> tuple[tuple[str, float], ...]:
        """Candidates of a token; none for names, codes, numbers and other scripts."""
        found = self.known.get(token)
        if found is None:
            found = ()
            if len(token) > 1 and PLAIN.match(token) and LETTER.search(token) and not HAN.search(token):
                found = self._candidates(token)
            if len(self.known) > 200_000:
                self.known.clear()
            self.known[token] = found
        return found

    def decode(self, text: str, first_is_part: bool, last_is_part: bool) -> list[tuple[int, int, str]]:
        """(start, end, word) of the words of a shaped line that were misread, by Viterbi."""
        toks = self.tokens(text)
        if not toks:
            return []
        found = [self.options(t) for t, _, _ in toks]
        if first_is_part:
            found[0] = ()
        if last_is_part:
            found[-1] = ()
        if not any(o and (len(o) > 1 or o[0][0] != t.lower()) for o, (t, _, _) in zip(found, toks)):
            return []
        lattice: list[list[tuple[str, float]]] = []
        for options, (t, _, _) in zip(found, toks):
            if not options:
                lattice.append([("", 0.0)])  # a name, code, number or part of a word: stays as it is
            elif options[0][0] != t.lower():
                passed = 24.0 if re.search(r"[@$|\d]", t) else 13.0 if t[0].isupper() and t[1:].islower() else 20.0
                lattice.append([*options, ("", passed)])
            else:
                lattice.append(list(options))
        back = [[-1] * len(lattice[0])]
        scores = [c for _, c in lattice[0]]
        for i in range(1, len(lattice)):
            new, link = [], []
            for w, c in lattice[i]:
                s, j = min((scores[j] + (self._follows(v, w) if v and w else 6.0 if w else 0.0), j) for j, (v, _) in enumerate(lattice[i - 1]))
                new.append(s + c)
                link.append(j)
            scores = new
            back.append(link)
        k = min(range(len(scores)), key=scores.__getitem__)
        out = []
        for i in range(len(lattice) - 1, -1, -1):
            w = lattice[i][k][0]
            if w and w != toks[i][0].lower():
                out.append((toks[i][1], toks[i][2], w))
            k = back[i][k]
        return out[::-1]

    def decode_phrases(self, before: str, text: str, after: str) -> list[tuple[int, int, str]]:
        """(start, end, character) misread in a line written without blanks; neighbours complete cut phrases."""
        if not self.lengths:
            return []
        reach = self.lengths[-1] - 1
        left = before[-reach:] if before and HAN.search(before[-2:]) else ""
        whole = left + text + (after[:reach] if after and HAN.search(after[:2]) else "")
        n = len(whole)
        if self._covered(whole, len(left), len(left) + len(text)):
            return []
        score, link = [0.0] + [1e9] * n, [(0, -1, "")] * (n + 1)
        for i in range(n):
            s = score[i] + (7.0 if HAN.match(whole[i]) else 0.5)
            if s < score[i + 1]:
                score[i + 1], link[i + 1] = s, (i, -1, "")
            if not SIGN.match(whole[i]):
                continue
            for k in self.lengths:
                if i + k > n:
                    break
                part = whole[i : i + k]
                if part in self.phrases:
                    if score[i] + 5.0 < score[i + k]:
                        score[i + k], link[i + k] = score[i] + 5.0, (i, -1, "")
                    continue
                if k < 3:
                    continue
                for j in range(k):
                    hit = self.openings.get(part[:j] + "\0" + part[j + 1 :])
                    if hit and SIGN.match(part[j]):
                        c = 9.0
                        if part[j] in self.phrase_chars:  # a known character: only well inside the line, where nothing is cut off
                            if k < 4 or i <= len(left) or i + k >= len(left) + len(text):
                                continue
                            c = 16.0
                        if score[i] + 5.0 + c < score[i + k]:
                            score[i + k], link[i + k] = score[i] + 5.0 + c, (i, i + j, min(t for _, t in hit))
        out, at = [], n
        while at > 0:
            i, j, c = link[at]
            if j >= 0 and len(left) <= j < len(left) + len(text):
                out.append((j - len(left), j - len(left) + 1, c))
            at = i
        return out[::-1]

    def _covered(self, whole: str, lo: int, hi: int) -> bool:
        """Whether phrases as they stand cover every Han or like character of whole[lo:hi]."""
        free = {i for i in range(lo, hi) if SIGN.match(whole[i])}
        for i in range(len(whole)):
            for k in self.lengths:
                if whole[i : i + k] in self.phrases:
                    free.difference_update(range(i, i + k))
        return not free

    def misread(self, text: str, before: str | None, after: str | None) -> tuple[str, list[tuple[int, int, str]]]:
        """(shaped line, corrections) of a body line."""
        part_first = bool(before and ENDS_DIVIDED.search(before))
        part_last = bool(ENDS_DIVIDED.search(text))
        line = shaped(text, self.table)
        found = self.decode(line, part_first, part_last)
        if self.phrases and HAN.search(line):
            found += self.decode_phrases(shaped(before or "", self.table), line, shaped(after or "", self.table))
        return line, found


#: Stands for the second word where a count is that of a token that is a word of its own.
OWN = "\0own"


def vocabulary(word_list: DataFrame, body: DataFrame | None = None) -> dict[str, frozenset[str]]:
    """The words and their languages. Above ``MAX_WORDS``, of the words only those that matter to the lines: that
    occur in them, or that one exchange makes into a token of theirs; phrases and compounds always stay."""
    listed = word_list.where("word IS NOT NULL").select(F.lower("word").alias("word"), "lang").distinct()
    rows = row_count_at_most(listed, MAX_WORDS)
    if rows is None and body is not None:
        tokens = body.select(F.explode(F.split(F.lower(look_alike("text")), r"[^\p{L}\p{M}\p{Nd}@$|!-]+")).alias("token")).distinct()
        gaps = lambda c: F.flatten(F.transform(F.sequence(F.lit(0), F.lit(2)), lambda k: F.transform(F.filter(F.sequence(F.lit(0), F.length(c)), lambda i: i + k <= F.length(c)), lambda i: F.concat(F.substring(c, F.lit(1), i), F.lit("\0"), F.substring(c, i + k + 1, F.length(c))))))
        keys = tokens.where(F.length("token") > 1).select(F.explode(gaps(F.col("token"))).alias("key")).distinct()
        matter = listed.select("word", F.explode(gaps(F.col("word"))).alias("key")).join(keys, "key", "left_semi").select("word").distinct()
        rows = listed.join(matter, "word", "left_semi").unionByName(listed.where("lang = 'zh' OR word LIKE '%-%'")).distinct().collect()
    elif rows is None:
        rows = listed.collect()
    out: dict[str, set[str]] = defaultdict(set)
    for r in rows:
        out[r["word"]].add(r["lang"] or "")
    return {w: frozenset(langs) for w, langs in out.items()}


_HELD: dict[str, object] = {}


def held(name: str, make):
    """What ``make`` gives, made once per worker for all tasks with this ``name``."""
    if name not in _HELD:
        _HELD.clear()
        _HELD[name] = make()
    return _HELD[name]


def _counted(name: str, given):
    """A mapInPandas function: (kind, a, b, n) of words, pairs of words and unknown tokens, summed per batch."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        channel = held(f"words-{name}", lambda: Channel(given.value, {}, {}, {}))
        for pdf in batches:
            counts: Counter = Counter()
            for text, before in zip(pdf["text"], pdf["before"]):
                last = ""
                toks = channel.tokens(shaped(text, channel.table))
                first = 1 if before and ENDS_DIVIDED.search(before) else 0
                end = len(toks) - (1 if ENDS_DIVIDED.search(text) else 0)
                for i, (t, _, _) in enumerate(toks):
                    low = t.lower()
                    if low in channel.words:
                        counts["w", low, ""] += 1
                        if last:
                            counts["b", last, low] += 1
                        last = low
                        continue
                    last = ""
                    if first <= i < end and len(low) > 1 and len(low) <= channel.vocabulary.longest + 2 and PLAIN.match(t) and LETTER.search(t) and not HAN.search(t):
                        counts["u", low, "capital" if t[0].isupper() else ""] += 1
            yield pd.DataFrame([(k, a, b, n) for (k, a, b), n in counts.items()], columns=["kind", "a", "b", "n"])

    return run


def _aligned(name: str, given):
    """A mapInPandas function over unknown tokens (a, b, n): the exchanges that may have made them, weighted by the channel so far.

    Names are written with capitals, so only tokens without count. The last round
    also tells which tokens are words of their own.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, unigrams, learnt = given.value
        channel = held(f"aligned-{name}", lambda: Channel(words, {}, unigrams, learnt))
        for pdf in batches:
            counts: Counter = Counter()
            for token, capital, n in zip(pdf["a"], pdf["b"], pdf["n"]):
                near = channel.vocabulary.near(token)
                if not near:
                    continue
                weights = {w: math.exp(-channel.cost(*pair)) * (unigrams.get(w, 0) + 1) for w, pair in near.items()}
                whole = sum(weights.values())
                if not capital and len(token) > 3:
                    for w, pair in near.items():
                        if learnt or len(near) == 1:
                            counts[("c", *pair)] += weights[w] / whole
                if n >= OWN_COUNT and n > OWN_TIMES * whole:
                    counts["o", token, OWN] += n
            yield pd.DataFrame([(k, a, b, float(n)) for (k, a, b), n in counts.items()], columns=["kind", "a", "b", "n"])

    return run


#: Rounds of expectation maximisation; the first takes tokens that only one word explains.
ROUNDS = 3


def channel_of(body: DataFrame, words: dict[str, frozenset[str]]) -> tuple[Channel, DataFrame | None]:
    """The channel of a corpus from counts over all its body lines, and the language model's counts (a, b, n) if they are
    too many to be sent out; then the channel has none."""
    spark = body.sparkSession
    sc, name = spark.sparkContext, uuid.uuid4().hex
    counts = spread(body.select("text", "before")).mapInPandas(_counted(name, sc.broadcast(words)), "kind string, a string, b string, n bigint")
    counts = cut(counts.groupBy("kind", "a", "b").agg(F.sum("n").alias("n")))
    unigrams = {r["a"]: r["n"] for r in counts.where("kind = 'w'").collect()}  # words of the vocabulary
    unknown = counts.where("kind = 'u'").groupBy("a").agg(F.min("b").alias("b"), F.sum("n").alias("n"))
    unknown = cut(unknown)
    learnt: dict[tuple[str, str], float] = {}
    for k in range(ROUNDS):
        found = unknown.mapInPandas(_aligned(f"{name}-{k}", sc.broadcast((words, unigrams, learnt))), "kind string, a string, b string, n double")
        found = found.groupBy("kind", "a", "b").agg(F.sum("n").alias("n"))
        found = cut(found) if k == ROUNDS - 1 else found
        # exchanges of at most two characters that several words share: as many as an alphabet allows
        learnt = {(r["a"], r["b"]): r["n"] for r in found.where("kind = 'c' AND n > 1").collect()}
    facts = counts.where("kind = 'b'").select("a", "b", "n").unionByName(found.where("kind = 'o'").select("a", "b", F.col("n").cast("bigint").alias("n")))
    rows = row_count_at_most(facts, MAX_FACTS)
    if rows is None:
        return Channel(words, {}, unigrams, learnt), facts
    bigrams = {(r["a"], r["b"]): r["n"] for r in rows if r["b"] != OWN}
    return Channel(words, bigrams, unigrams, learnt, frozenset(r["a"] for r in rows if r["b"] == OWN)), None


def corrections(body: DataFrame, channel: Channel, facts: DataFrame | None = None) -> DataFrame:
    """(_page, pos, page_id, line_no, corrected): body lines with a misread word, in visible form and corrected.

    ``facts``: counts of the language model that are joined to the lines that need them.
    """
    name = uuid.uuid4().hex
    model = (channel.vocabulary.words, channel.vocabulary.phrases, channel.bigrams, channel.unigrams, {p: n + 1 for p, n in channel.seen.items()}, channel.own)
    given = body.sparkSession.sparkContext.broadcast(model)

    def of_worker() -> Channel:
        def make() -> Channel:
            plain, phrases, bigrams, unigrams, learnt, own = given.value
            words = {w: frozenset(["zh"] if w in phrases else []) | frozenset([""] if w in plain else []) for w in plain | phrases}
            return Channel(words, bigrams, unigrams, learnt, own)

        return held(f"channel-{name}", make)

    lines = body.select(*LINE, "text", "before", "after")
    if facts is not None:

        def needed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            worker = of_worker()
            for pdf in batches:
                out = [(page, pos, a, b) for page, pos, text, before in zip(pdf["_page"], pdf["pos"], pdf["text"], pdf["before"]) for a, b in worker.needs(text, before)]
                yield pd.DataFrame(out, columns=["_page", "pos", "a", "b"])

        asked = lines.mapInPandas(needed, "_page string, pos int, a string, b string")
        got = asked.join(facts, ["a", "b"]).groupBy("_page", "pos").agg(F.collect_list(F.struct("a", "b", "n")).alias("facts"))
        lines = lines.join(got, ["_page", "pos"], "left")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        worker = of_worker()
        for pdf in batches:
            out = []
            own = pdf["facts"] if "facts" in pdf else [None] * len(pdf)
            for page, pos, key, line, text, before, after, more in zip(pdf["_page"], pdf["pos"], pdf["page_id"], pdf["line_no"], pdf["text"], pdf["before"], pdf["after"], own):
                if "facts" in pdf:
                    worker.with_facts([(f["a"], f["b"], f["n"]) for f in more] if more is not None else [])
                shape, found = worker.misread(text, before, after)
                if found:
                    for a, b, word in sorted(found, reverse=True):
                        old = shape[a:b]
                        shape = shape[:a] + (word[:1].upper() + word[1:] if old[:1].isupper() else word) + shape[b:]
                    out.append((page, pos, key, line, shape))
            yield pd.DataFrame(out, columns=[*LINE, "corrected"]).astype({"page_id": "Int64", "line_no": "Int32"})

    return lines.mapInPandas(run, "_page string, pos int, page_id bigint, line_no int, corrected string")


def divided(body: DataFrame, words: dict[str, frozenset[str]]) -> DataFrame:
    """(_page, pos, page_id, line_no): body lines whose last word goes on in the next body line.

    A capital goes on only in a compound of the vocabulary broken at its own hyphen.
    """
    compounds = sorted(w for w in words if "-" in w)
    last = F.regexp_extract("text", rf"(\p{{L}}[\p{{L}}\p{{M}}]*){HYPHEN}{BLANK}*$", 1)
    first = F.regexp_extract("after", rf"^{BLANK}*(\p{{L}}[\p{{L}}\p{{M}}]*)", 1)
    known = F.lower(F.concat(last, F.lit("-"), first)).isin(compounds) if compounds else F.lit(False)
    goes_on = F.col("text").rlike(DIVIDED) & (first != "") & (~first.rlike(r"^\p{Lu}") | known | (last.rlike(r"^\p{Lu}{2,}$") & first.rlike(r"^\p{Lu}{2,}$")))
    return body.where(goes_on).select(*LINE)


# ---------------------------------------------------------------- results


def _prepared(lines: DataFrame, pages: DataFrame, word_list: DataFrame, terms: DataFrame | None) -> tuple[DataFrame, DataFrame, dict[str, frozenset[str]], DataFrame]:
    """Noise at the edges, body lines with their neighbours, the vocabulary, and the corrections of the body."""
    rows = cut(ordered_lines(lines, pages))
    edge = cut(edge_noise(rows, terms))
    body = cut(body_lines(rows, edge))
    words = vocabulary(word_list, body)
    return edge, body, words, corrections(spread(body), *channel_of(body, words))


def noise(lines: DataFrame, pages: DataFrame, word_list: DataFrame, terms: DataFrame | None = None) -> DataFrame:
    """(page_id, line_no, noise) of every noisy line: running, folio, hyphen, misread."""
    edge, body, words, fixed = _prepared(lines, pages, word_list, terms)
    hyphen = divided(body, words).select("page_id", "line_no", F.lit("hyphen").alias("noise"))
    misread = fixed.select("page_id", "line_no", F.lit("misread").alias("noise"))
    return edge.select("page_id", "line_no", "noise").unionByName(hyphen).unionByName(misread)


def paragraphs(lines: DataFrame, pages: DataFrame, word_list: DataFrame, terms: DataFrame | None = None) -> DataFrame:
    """(source_path, page_id, line_no, part, n_lines, text): repaired paragraphs, named by their first line.

    Running lines and page numbers are gone, misread words corrected, divided words
    joined, lines set together with a blank unless the script has none. A paragraph
    ends with a line that has an end mark and is shorter than its page's lines, and
    around headings and lone numbers. One that runs over more than ``SPAN`` pages is
    given in numbered parts of that many pages, so that no group grows without bound.
    """
    _, body, words, fixed = _prepared(lines, pages, word_list, terms)
    fixed = fixed.select("_page", "pos", "corrected")
    split = divided(body, words).select("_page", "pos", F.lit(True).alias("goes_on"))
    text = body.join(fixed, ["_page", "pos"], "left").join(split, ["_page", "pos"], "left")
    text = text.withColumn("line", F.trim(F.coalesce("corrected", F.regexp_replace("text", r"[\p{Cf}&&[^\u00AD]]", ""))))
    alone = F.col("shape").rlike(r"^[\p{N}\p{P}\s]+$")
    if terms is not None:
        known = terms.where("term IS NOT NULL").select(letters(look_alike("term")).alias("k")).distinct().withColumn("is_term", F.lit(True))
        text = text.withColumn("k", letters(F.col("shape"))).join(known, "k", "left").drop("k")
        alone = alone | F.coalesce("is_term", F.lit(False))
    page = Window.partitionBy("_page")
    width = F.length("line") < F.max(F.length("line")).over(page) * 0.85
    ends = F.col("goes_on").isNull() & F.col("line").rlike("[.!?。！？…”»」』)]$") & width
    text = text.withColumn("alone", alone).withColumn("ends", alone | ends)
    order = page.orderBy("pos")
    starts = F.col("alone") | F.coalesce(F.lag("ends").over(order), F.lit(False)) | F.col("before").isNull()
    text = text.withColumn("begin", F.when(starts, F.struct("page_no", "page_id", "line_no", "_page", "pos")))
    text = text.withColumn("here", F.last("begin", ignorenulls=True).over(order))
    # what a page's first lines belong to began on an earlier page, unless that page ended a paragraph
    tails = text.groupBy("_page").agg(F.first("source").alias("source"), F.first("page_no").alias("page_no"), F.max_by("here", "pos").alias("tail"), F.max_by("ends", "pos").alias("closed"), F.min_by(F.struct("page_no", "page_id", "line_no", "_page", "pos"), "pos").alias("top"))
    carried = last_in_sequence(tails.where("page_no IS NOT NULL"), "source", "page_no", "tail", "earlier")
    closed = next_in_sequence(tails.where("page_no IS NOT NULL"), "source", "page_no", F.struct("_page", "closed"), "next")
    after_close = tails.select("_page", F.col("top")).join(
        closed.where("next IS NOT NULL AND closed").select(F.col("next._page").alias("_page"), F.lit(True).alias("fresh")), "_page", "left"
    )
    text = text.join(carried.select("_page", "earlier"), "_page", "left").join(after_close, "_page", "left")
    start = F.coalesce("here", F.when(F.col("fresh"), F.col("top")), "earlier", "top")
    text = text.withColumn("start", start)
    part = F.floor((F.col("page_no") - F.col("start.page_no")) / SPAN).cast("int")
    joined = F.when(
        F.col("goes_on"), F.regexp_replace("line", rf"{HYPHEN}{BLANK}*$", "")
    ).when(F.col("line").rlike(r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}。，！？；：、”」]$"), F.col("line")).otherwise(F.concat("line", F.lit(" ")))
    compounds = sorted(w for w in words if "-" in w)
    kept = F.lower(F.concat(F.regexp_extract("line", r"(\p{L}+)-$", 1), F.lit("-"), F.regexp_extract("after", r"^(\p{L}+)", 1))).isin(compounds) if compounds else F.lit(False)
    piece = F.when(F.col("goes_on") & kept, F.col("line")).otherwise(joined)
    text = text.select("source", "start._page", "start.pos", "start.page_id", "start.line_no", F.coalesce(part, F.lit(0)).alias("part"), F.struct("page_no", F.col("pos").alias("at"), piece.alias("piece")).alias("x"))
    out = text.groupBy("source", "_page", "pos", "page_id", "line_no", "part").agg(F.sort_array(F.collect_list("x")).alias("xs"))
    return out.select(F.col("source").alias("source_path"), "page_id", "line_no", "part", F.size("xs").alias("n_lines"), F.trim(F.array_join(F.col("xs.piece"), "")).alias("text"))

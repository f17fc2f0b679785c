"""Sentence units with positions, over many languages and scripts.

Method: document-centred disambiguation. Whether a period ends a sentence depends
on whether the word before it is an abbreviation and the word behind it a proper
name. Both are asked of the document first: its unambiguous occurrences (an
abbreviation goes on in small letters or numbers, an ordinary word stands without a
period, a name stands capitalised inside a sentence). Where the document is silent
or contradicts itself, the same evidence counted over the whole corpus decides, and
only then short lists of common abbreviations. What kind of abbreviation it is
(before a name, before a number, at the end) is told by those lists where they have
it. Other scripts have terminator rules of their own.

Corpus evidence is counted in the JVM, summed before any shuffle, and judged by
ratios of counts, so it means the same at every size. The most frequent words of it
(at most ``HOT_WORDS``) are sent to the workers; if there are more, each document is
joined with the others that it has at a period.

Defined results: null, empty and blank texts have no sentences; a text in which no
mark ends anything is one sentence per paragraph (or line, if line breaks are
hard); quotes and brackets that never close are ordinary characters; positions are
code points, end exclusive, without blanks around.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pandas as pd
import regex as re
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirework.session import cut, row_count_at_most, spread

#: Words of the corpus evidence that every worker gets; further ones are joined to the documents that need them.
HOT_WORDS = 50_000
#: Occurrences that make evidence, and how many sentence ends one occurrence as an abbreviation outweighs.
MIN_COUNT, OUTWEIGHS = 5, 10

# Common abbreviations, without their last period.
#: Before a name.
TITLES = frozenset("dr mr mrs ms prof st sr sra srta dra hr fr mme mlle m г-н г-жа д-р ул κ κα".split())
#: Before a number.
NUMBERED = frozenset("no nr nos fig figs vol vols p pp pag pág págs bd bde núm num t ch chap art рис стр σελ αρ".split())
#: Before anything; a sentence goes on behind them.
LEADING = frozenset("s vgl cf ca z d h b e g i ex ej ed resp bzw z.b d.h p.ex p.ej e.g i.e u.a см т.е напр βλ π.χ".split())
#: Often the last word of a sentence.
CLOSING = frozenset("etc usw a.m p.m am pm jr inc ltd co al т.д т.п др мм км mm cm km kg sek min sec κ.λπ κλπ".split())
#: Between the two: the end of a sentence only if the next word opens sentences.
EITHER = frozenset("г гг в вв χιλ".split())
LISTED = {w: kind for kind, words in (("title", TITLES), ("number", NUMBERED), ("leading", LEADING), ("closing", CLOSING), ("either", EITHER)) for w in words}
MONTHS_DE = frozenset("januar februar märz april mai juni juli august september oktober november dezember".split())
#: Words that report speech, where letter case cannot show that a sentence goes on.
REPORTING = re.compile(r"写道|说|說|问道|問道|答道|喊道|叫道|回答|कहा|पूछा|लिखा|बोल|كتب|قال|سأل|أجاب|กล่าว|ถาม|เขียน|พูด")
REPORTING_CASED = re.compile(r"\p{Lu}[\p{L}'’-]*(?:\s+\p{Lu}[\p{L}'’-]*)?\s+(?:said|asked|wrote|replied|answered|cried|sagte|fragte|schrieb|rief|dit|demande|écrit|répond|dijo|preguntó|escribió|сказал|сказала|спросил|спросила|написал|написала|είπε|ρώτησε|έγραψε)\b")

THAI = r"[ก-ฺเ-๎]"
OPEN, CLOSE = "“„«「『‹", "”»」』›“"
PAIR = {"“": "”", "„": "“”", "«": "»", "「": "」", "『": "』", "‹": "›"}
QUOTES = re.compile(r"[“”„«»「」『』‹›]")
EVENT = re.compile(rf"(?P<mark>[.!?。！？।॥؟۔．｡…;;]+)|(?P<thai>(?<={THAI})[^\S\r\n]+(?={THAI}))")
PARAGRAPH = re.compile(r"(?:\r\n|\r|\n)(?:[^\S\r\n]*(?:\r\n|\r|\n))+")
LINE = re.compile(r"\r\n|\r|\n")
STRONG = frozenset("!?。！？।॥؟۔｡")
WORD_CHAR = re.compile(r"[\p{L}\p{M}’'-]")
DOTTED = re.compile(r"(?:\p{L}[\p{L}\p{M}]{0,5}\.){1,4}$")
NUMBER_LIKE = re.compile(r"[\p{Nd}(]|[IVXLCDM]+(?!\p{L})|\p{L}(?![\p{L}\p{M}’'])|\p{L}+[-/]?\p{Nd}|\p{L}{1,4}\.[^\S\r\n]?\p{Nd}")
CJK = re.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}]")
DIGITS_ONLY = re.compile(r"[\p{Nd}ivxlcdmIVXLCDM]{1,7}$")
CLOSERS = "”»」』›)]）］】\"'’"
NEXT_WORD = re.compile(r"\p{L}[\p{L}\p{M}’'-]*")
SPACED = re.compile(r"(?:^|\s)(\p{L})\.[^\S\r\n]?(\p{L})\.$")

#: Evidence in a text: an abbreviation goes on in small letters or numbers, without a paragraph break between ...
GOES_ON = re.compile(r"(?<![\p{L}\p{M}.])((?:\p{L}\.){0,4}\p{L}[\p{L}\p{M}-]{0,5})\.(?=,|[^\S\n]*+(?:\n[^\S\n]*+)?(?<=\s)[\p{Ll}\p{Nd}])")
#: ... a word opens a sentence behind a paragraph break or a strong mark ...
OPENS = re.compile(r"(?:\A|\n\s*\n\s*|[!?]\s+)(\p{Lu}[\p{L}\p{M}’'-]*)")
#: ... and a name stands capitalised behind a small-lettered word.
INSIDE = re.compile(r"\p{Ll},?[ \n](\p{Lu}[\p{L}\p{M}’'-]*)")

# The same for the JVM, whose classes of blanks are written out; lengths are bounded where a group repeats.
_B, _NB = r"[\s\p{Z}\x85]", r"[\t\x0B\f\r\p{Z}\x85]"
JVM_GOES_ON = rf"(?<![\p{{L}}\p{{M}}.])((?:\p{{L}}\.){{0,4}}\p{{L}}[\p{{L}}\p{{M}}-]{{0,5}})\.(?=,|{_NB}*+(?:\n{_NB}*+)?(?<={_B})[\p{{Ll}}\p{{Nd}}])"
JVM_STOPS = rf"(?<![\p{{L}}\p{{M}}.])((?:\p{{L}}\.){{0,4}}\p{{L}}[\p{{L}}\p{{M}}-]{{0,5}})\.{_B}++\p{{Lu}}"
JVM_OPENS = rf"(?:\A|\n\n|[!?]{_B}++)(\p{{Lu}}[\p{{L}}\p{{M}}’'-]*+)"  # in a text whose paragraph breaks are two characters
JVM_INSIDE = r"\p{Ll},?[ \n](\p{Lu}[\p{L}\p{M}’'-]*+)"
JVM_BEFORE = r"(?<![\p{L}\p{M}.])((?:\p{L}\.){0,4}\p{L}[\p{L}\p{M}-]{0,5})\."
JVM_BEHIND = rf"\.[”»」』›)\]\"'’]*+{_B}*+(\p{{Lu}}[\p{{L}}\p{{M}}’'-]*+)"


def _any_of(words: list[str]) -> str:
    """A pattern of the words by their first letters, so that few are tried at each place."""
    heads = sorted({w[0] for w in words})
    return "|".join(h + "(?:" + "|".join(sorted((w[1:] for w in words if w[0] == h), reverse=True)) + ")" for h in heads)


JVM_PLAIN = r"(?<![\p{L}\p{M}\p{Nd}.’'-])(" + _any_of([w for w in LISTED if w.isalpha()]) + r")(?![\p{L}\p{M}\p{Nd}.’'-])"


def corpus_evidence(docs: DataFrame) -> DataFrame:
    """(word, abbreviation, ordinary, opener): what the whole corpus shows of a word, and how often it was seen (n).

    An abbreviation goes on at least ``MIN_COUNT`` times and at least once for
    ``OUTWEIGHS`` times that it stands before a capital; an ordinary word, asked of
    listed ones only, stands without a period more often than it goes on; an opener
    opens sentences more often than it stands inside. Nothing depends on how large
    the corpus is. Nothing goes on over a hard line break.
    """
    text = F.when(F.col("line_mode") == "hard", F.regexp_replace("text", "\r\n|\r|\n", "\n\n")).otherwise(F.col("text"))
    # only paragraph breaks matter to what opens, so runs of blank lines become one
    text = F.regexp_replace(text, rf"\n{_B}*\n{_B}*+", "\n\n")
    kinds = {
        "goes": F.transform(F.regexp_extract_all("t", F.lit(JVM_GOES_ON)), F.lower),
        "stops": F.transform(F.regexp_extract_all("t", F.lit(JVM_STOPS)), F.lower),
        "plain": F.regexp_extract_all("t", F.lit(JVM_PLAIN)),
        "opens": F.regexp_extract_all("t", F.lit(JVM_OPENS)),
        "inside": F.regexp_extract_all("t", F.lit(JVM_INSIDE)),
    }

    def tagged(kind: str, words: Column) -> Column:
        return F.transform(words, lambda w: F.struct(F.lit(kind).alias("kind"), w.alias("word")))

    found = F.concat(*[tagged(k, words) for k, words in kinds.items()])
    rows = docs.where(F.col("text").isNotNull()).select(text.alias("t")).select(F.explode(found).alias("e")).select("e.kind", "e.word")
    counts = rows.groupBy("kind", "word").agg(F.count(F.lit(1)).alias("n"))
    n = {k: F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("n"))), F.lit(0)) for k in kinds}
    seen = (F.col("goes") >= MIN_COUNT) & (F.col("goes") * OUTWEIGHS >= F.col("stops"))
    wide = counts.groupBy("word").agg(F.sum("n").alias("n"), *[e.alias(k) for k, e in n.items()]).select(
        "word", "n",
        seen.alias("abbreviation"),
        ((F.col("plain") >= MIN_COUNT) & (F.col("plain") > F.col("goes"))).alias("ordinary"),
        ((F.col("opens") >= MIN_COUNT) & (F.col("opens") > F.col("inside"))).alias("opener"),
    )
    return wide.where("abbreviation OR ordinary OR opener")


Evidence = tuple[frozenset[str], frozenset[str], frozenset[str]]
KINDS = ("abbreviation", "ordinary", "opener")


def _sets(rows) -> Evidence:
    return tuple(frozenset(r["word"] for r in rows if r[k]) for k in KINDS)


class Splitter:
    """Sentence positions of one text after the other, with the corpus evidence at hand."""

    def __init__(self, abbreviations: frozenset[str] = frozenset(), openers: frozenset[str] = frozenset(), ordinary: frozenset[str] = frozenset()):
        self.abbreviations, self.openers, self.ordinary = abbreviations, openers, ordinary
        self.more: Evidence = (frozenset(), frozenset(), frozenset())

    def split(self, text: str | None, hard: bool, more: Evidence | None = None) -> list[tuple[int, int]]:
        """``more``: corpus evidence of rare words of this text."""
        if not text or text.isspace():
            return []
        self.more = more or (frozenset(), frozenset(), frozenset())
        self.goes: Counter | None = None
        self.seen: dict[str, bool] = {}
        self.text, self.hard = text, hard
        out: list[tuple[int, int]] = []
        at = 0
        for gap in (LINE if hard else PARAGRAPH).finditer(text):
            self._paragraph(at, gap.start(), out)
            at = gap.end()
        self._paragraph(at, len(text), out)
        return out

    def _from_document(self) -> None:
        text = LINE.sub("\n\n", self.text) if self.hard else self.text
        self.goes = Counter(w.lower() for w in GOES_ON.findall(text))
        self.doc_names = set(INSIDE.findall(text))
        self.doc_openers = set(OPENS.findall(text))

    def _quoted(self, lo: int, hi: int) -> list[tuple[int, int]]:
        """The outermost quotations that open and close within the paragraph."""
        spans: list[tuple[int, int]] = []
        stack: list[tuple[str, int]] = []
        closed_by: dict[str, list[tuple[int, int]]] = {}  # closing mark -> (place in the stack, position) of what it may close
        for m in QUOTES.finditer(self.text, lo, hi):
            c = m[0]
            waiting = closed_by.get(c, [])
            while waiting and not (waiting[-1][0] < len(stack) and stack[waiting[-1][0]][1] == waiting[-1][1]):
                waiting.pop()  # closed meanwhile by something around it
            match = waiting[-1][0] if waiting else None
            if match is not None and not (c == "“" and stack[match][0] != "„"):
                begin = stack[match][1]
                del stack[match:]
                while spans and spans[-1][0] > begin:
                    spans.pop()
                spans.append((begin, m.start()))
            elif c in PAIR:
                for mark in PAIR[c]:
                    closed_by.setdefault(mark, []).append((len(stack), m.start()))
                stack.append((c, m.start()))
        return spans

    def _paragraph(self, lo: int, hi: int, out: list[tuple[int, int]]) -> None:
        text = self.text
        while lo < hi and text[lo].isspace():
            lo += 1
        while hi > lo and text[hi - 1].isspace():
            hi -= 1
        if lo >= hi:
            return
        spans = self._quoted(lo, hi) if QUOTES.search(text, lo, hi) else []
        start, at, k = lo, lo, 0
        while at < hi:
            m = EVENT.search(text, at, hi)
            while k < len(spans) and spans[k][1] < at:
                k += 1
            span = spans[k] if k < len(spans) else None
            if span and (not m or m.start() > span[0]):  # the next thing is a quotation: judge its end
                end = span[1] + 1
                inner = span[1] - 1
                while inner > span[0] and text[inner].isspace():
                    inner -= 1
                stop = self._after_closers(end, hi)
                if (text[inner] in STRONG or text[inner] in ".．…;;") and self._quote_ends(start, span[0], stop, hi):
                    start = self._cut(start, stop, hi, out)
                    at = max(start, stop)
                else:
                    at = end
                k += 1
                continue
            if not m:
                break
            if m["thai"]:
                start = self._cut(start, m.start(), hi, out)
                at = m.end()
                continue
            stop = self._after_closers(m.end(), hi)
            if self._ends(m[0], start, m.start(), m.end(), stop, lo, hi):
                start = self._cut(start, stop, hi, out)
            at = stop if stop > m.end() and start >= stop else m.end()
        self._cut(start, hi, hi, out)

    def _cut(self, start: int, stop: int, hi: int, out: list[tuple[int, int]]) -> int:
        text, end = self.text, stop
        while end > start and text[end - 1].isspace():
            end -= 1
        if end > start:
            out.append((start, end))
        while stop < hi and text[stop].isspace():
            stop += 1
        return stop

    def _after_closers(self, at: int, hi: int) -> int:
        while at < hi and self.text[at] in CLOSERS:
            at += 1
        return at

    def _quote_ends(self, start: int, opening: int, stop: int, hi: int) -> bool:
        text, at = self.text, stop
        while at < hi and text[at].isspace():
            at += 1
        if at >= hi:
            return True
        c = text[at]
        if c.islower() or c in ",，、;:；：—–-と" or c in STRONG or c in ".．…":
            return False
        if opening == start and c not in OPEN:  # nothing said before it who speaks; perhaps behind it
            if c.isupper():
                told = REPORTING_CASED.match(text, at, hi)
                return not told or bool(re.match(r"\s*[,:]?\s*[“„«]", text, pos=told.end(), endpos=hi))
            if c.isalpha():
                mark = EVENT.search(text, at, hi)
                return not REPORTING.search(text, at, mark.start() if mark else hi)
        return True

    def _ends(self, mark: str, start: int, begin: int, end: int, stop: int, lo: int, hi: int) -> bool:
        text = self.text
        at = stop
        while at < hi and text[at].isspace():
            at += 1
        if at >= hi:
            return True
        c, blank = text[at], at > stop
        if mark[0] in ";;" and len(set(mark)) == 1:
            i = begin - 1
            while i > lo and (text[i].isspace() or text[i] in CLOSERS):
                i -= 1
            return "Ͱ" <= text[i] <= "Ͽ" or "ἀ" <= text[i] <= "῿"
        if any(x in STRONG for x in mark):
            if c.islower() or c in STRONG or c in ",，、:：;；" or (c.isdigit() and not blank and mark[-1] in "!?"):
                return False
            return True
        if len(mark) > 1 or mark == "…":  # an ellipsis ends only before a capital
            while c in "“«„¿¡" and at + 1 < hi and (text[at + 1].isspace() or text[at + 1].isalpha()):
                at += 1
                c = text[at] if not text[at].isspace() else "«"
            return blank and c.isupper()
        return self._period(start, begin, stop, at, c, blank, hi)

    def _period(self, start: int, begin: int, stop: int, at: int, c: str, blank: bool, hi: int) -> bool:
        text = self.text
        before = text[begin - 1] if begin > start else ""
        if not before or before.isspace():
            return False
        if c in ",，、:：;；-–—_/":
            return False
        if CJK.match(before) or before in "）」』】":
            return not (c.islower() and not blank)
        if "ऀ" <= before <= "ॿ" or "฀" <= before <= "๿":
            return False
        if c.islower():
            return False
        w = self._word_before(start, begin)
        if not blank:
            if stop > begin + 1:  # a closing bracket stands between
                return c.isupper() or c in OPEN
            if c in OPEN or (c.isupper() and (before.islower() or before in ")\"'’" or before.isdigit())) or (c in "¿¡"):
                i = at
                while i < hi and (text[i].isalnum() or text[i] in "._/"):
                    i += 1
                if (LISTED.get(w.lower()) in ("title", "number", "leading") and len(w) < 3 and not self._unit(w, start, begin)) or "/" in text[at:i] or "_" in text[at:i]:
                    return False
                j = begin
                while j > start and not text[j - 1].isspace():
                    j -= 1
                return not re.search(r"[/_@]", text[j:begin]) or c in OPEN or before.isdigit() is False and c.isupper()
            return bool(CJK.match(c)) and before.isdigit() is False
        if "؀" <= before <= "ۿ":
            return len(w) != 1
        if DIGITS_ONLY.match(text, start, begin) and not text[start:begin].isspace():
            return False  # a number in front of a heading or list entry
        if before.isdigit():
            if c.isdigit():
                return not (LINE.search(text, stop, at) and CJK.search(text, max(start, begin - 12), min(hi, at + 12)))
            following = NEXT_WORD.match(text, at, hi)
            if following and following[0].lower() in MONTHS_DE:
                return False
            return True
        if not w:
            return True
        low = w.lower()
        spaced = SPACED.search(text, max(start, begin - 6), begin + 1)
        pair = f"{spaced[1]}.{spaced[2]}".lower() if spaced else ""
        if LISTED.get(pair) == "closing":
            return True
        if pair in LISTED:
            return False
        kind = LISTED.get(low)
        if kind != "either" and self._unit(w, start, begin):
            return not c.isdigit()
        following = NEXT_WORD.match(text, at, hi)
        if len(w) == 1 and w.isupper() and not (kind and c.isdigit()) and kind != "either":
            # an initial, unless what follows is a word that also stands uncapitalised
            if spaced or not following or (len(following[0]) == 1 and text[following.end() : following.end() + 1] == "."):
                return False
            return self._uncapitalised(following[0].lower())
        if kind == "number" and c.isdigit():
            return False  # its number stands here
        is_one = self._abbreviation(w, low, c.isdigit())
        if is_one is None:
            is_one = kind is not None
        if not is_one or kind == "closing":
            return True
        if kind == "number":
            return not NUMBER_LIKE.match(text, at, hi)
        if kind == "title":
            return False
        if kind == "leading":
            return len(w) == 1 and w != "s" and c.isupper() and self._opener(text, at, hi)
        if c.isdigit():
            return False
        return not following or self._opener(text, at, hi)

    def _word_before(self, start: int, begin: int) -> str:
        """The word that ends at ``begin``, with the dotted letters that belong to it."""
        text, i = self.text, begin
        while i > start and WORD_CHAR.match(text[i - 1]):
            i -= 1
        while i < begin and not text[i].isalpha():
            i += 1
        if i == begin:
            return ""
        dotted = DOTTED.search(text, max(start, i - 28), i) if text[i - 1 : i] == "." and i > start else None
        return (dotted[0] if dotted else "") + text[i:begin]

    def _abbreviation(self, w: str, low: str, digit: bool) -> bool | None:
        """Whether a word before a period is an abbreviation: by the document, else by the corpus; None if neither knows."""
        if self.goes is None:
            self._from_document()
        elsewhere = self.goes[low] > (1 if digit else 0)  # a number behind this period has been counted too
        ordinary = w.islower() and self._plain(w)
        if elsewhere != ordinary:
            return elsewhere
        if low in self.abbreviations or low in self.more[0]:
            return True
        if w.islower() and (low in self.ordinary or low in self.more[1]):
            return False
        return None

    def _plain(self, w: str) -> bool:
        """Whether the document has the word in small letters without a period behind it; asked of it once."""
        key = "." + w
        if key not in self.seen:
            text, at, found = self.text, self.text.find(w), False
            while at >= 0 and not found:
                before, behind = text[at - 1 : at] if at else " ", text[at + len(w) : at + len(w) + 1] or " "
                found = not (before.isalnum() or before in ".’'-" or behind.isalnum() or behind in ".’'-" or WORD_CHAR.match(before) or WORD_CHAR.match(behind))
                at = text.find(w, at + 1)
            self.seen[key] = found
        return self.seen[key]

    def _uncapitalised(self, word: str) -> bool:
        """Whether the document has the word in small letters; asked of it once."""
        if word not in self.seen:
            self.seen[word] = bool(re.search(rf"(?<!\p{{L}}){re.escape(word)}(?!\p{{L}})", self.text))
        return self.seen[word]

    def _unit(self, w: str, start: int, begin: int) -> bool:
        """Whether the short word before the period is a unit behind a number, as in ``in 30 s.``"""
        at = begin - len(w)
        if not w.islower() or len(w) > 3:
            return False
        while at > start and self.text[at - 1].isspace():
            at -= 1
        return at > start and self.text[at - 1].isdigit()

    def _opener(self, text: str, at: int, hi: int) -> bool:
        """Whether the word here opens sentences rather than being a name."""
        following = NEXT_WORD.match(text, at, hi)
        if not following:
            return True
        if self.goes is None:
            self._from_document()
        w = following[0]
        name, opens = w in self.doc_names, w in self.doc_openers
        if name != opens:
            return opens
        return w in self.openers or w in self.more[2]


def sentences(docs: DataFrame, evidence: DataFrame | None = None) -> DataFrame:
    """(doc_id, start_pos, end_pos) of every sentence; corpus evidence is counted over ``docs`` unless given."""
    evidence = cut(corpus_evidence(docs) if evidence is None else evidence)
    texts = docs.select("doc_id", "text", "line_mode").where(F.col("text").isNotNull())
    few = row_count_at_most(evidence, HOT_WORDS)
    if few is None:
        hot = evidence.orderBy(F.desc("n"), "word").limit(HOT_WORDS)
        few = hot.collect()
        texts = with_rare_evidence(texts, evidence.join(cut(hot).select("word"), "word", "left_anti"))
    abbreviations, ordinary, openers = _sets(few)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        splitter = Splitter(abbreviations, openers, ordinary)
        for pdf in batches:
            ids, starts, ends = [], [], []
            rare = pdf["more"] if "more" in pdf else [None] * len(pdf)
            for doc_id, text, mode, more in zip(pdf["doc_id"], pdf["text"], pdf["line_mode"], rare):
                for a, b in splitter.split(text, mode == "hard", _sets(more) if more is not None else None):
                    ids.append(doc_id)
                    starts.append(a)
                    ends.append(b)
            yield pd.DataFrame({"doc_id": pd.array(ids, dtype="Int64"), "start_pos": pd.Series(starts, dtype="int64"), "end_pos": pd.Series(ends, dtype="int64")})

    return spread(texts).mapInPandas(run, "doc_id bigint, start_pos bigint, end_pos bigint")


def with_rare_evidence(texts: DataFrame, evidence: DataFrame) -> DataFrame:
    """``texts`` with ``more``: the evidence of those of its words that stand beside a period. Equal texts share it."""
    keyed = texts.withColumns({"_h": F.xxhash64("text"), "_g": F.xxhash64("text", F.lit(1))})
    words = F.concat(F.transform(F.regexp_extract_all("text", F.lit(JVM_BEFORE)), F.lower), F.regexp_extract_all("text", F.lit(JVM_BEHIND)))
    needed = keyed.select("_h", "_g", F.explode(F.array_distinct(words)).alias("word")).distinct()
    found = needed.join(evidence, "word").groupBy("_h", "_g").agg(F.collect_list(F.struct("word", *KINDS)).alias("more"))
    return keyed.join(found, ["_h", "_g"], "left").drop("_h", "_g")

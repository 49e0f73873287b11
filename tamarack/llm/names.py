"""Names of organisations as people type them: one parse shared by every matcher.

A ``Lexicon`` holds the generic words of company names, which ``learn_words`` counts out of the names themselves: words
that make up a share of all words and stand beside many different ones.  Of two generic words side by side the first is
a modifier ("Precision"), the last a trade ("Castings").  ``Lexicon.parse`` is plain Python, used inside Arrow UDFs.  It
splits a name into a modifier, a trade, a given name, a place-like prefix and the distinguishing core (family names),
undoing spelling errors, abbreviations, nicknames, reordered parts, trade-name clauses and site notes on the way.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator, Sequence
from functools import lru_cache
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ..functions.values import FILLERS
from ..session import release, settle

#: Share of all words from which a word is generic: there are at most its inverse of them.
SHARE = 0.002
#: Different words (by their first letters) that must stand beside it.
BESIDE = 15

# Legal forms, words that say nothing, and words that stand for a family.
LEGAL = set("inc incorporated incorp llc lllp corp corporation co company coy comp ltd limited ltda lp llp plc pllc holdings holding group gmbh sa ag".split())
STOP = set("the of and amp n et und y".split())
FAMILY = ("sons", "daughters", "brothers")
#: Short forms that are no prefix or skeleton of one word only.
SHORT = {
    "intl": "international", "int": "international", "internat": "international", "natl": "national", "nat": "national", "nthn": "northern",
    "no": "northern", "sthn": "southern", "so": "southern", "estn": "eastern", "wstn": "western", "utd": "united", "std": "standard",
    "indl": "industrial", "ind": "industrial", "intgr": "integrated", "integ": "integrated", "contl": "continental", "cont": "continental",
    "cons": "consolidated", "consol": "consolidated", "eng": "engineered", "engrd": "engineered", "gen": "general", "genl": "general",
    "prec": "precision", "precis": "precision", "qual": "quality", "qlty": "quality", "univ": "universal", "univl": "universal",
    "spec": "specialty", "splty": "specialty", "hrtg": "heritage", "cust": "custom", "adv": "advanced", "advd": "advanced",
    "frntr": "furniture", "ptg": "printing", "prtg": "printing", "chem": "chemicals", "cntl": "central", "cent": "central", "ctrl": "central", "ctrls": "controls", "pkg": "packaging", "mfg": "manufacturing",
    "wks": "works", "gwks": "gearworks", "fdry": "foundry", "fndry": "foundry", "btrys": "batteries", "brgs": "bearings",
    "try": "batteries",
}
# Given names with the short forms people type for them.
NICKNAMES = {
    "anthony": "tony ant anton", "benjamin": "ben benny", "catherine": "cathy cate", "charles": "charlie chuck chas charley", "christopher": "chris kit",
    "daniel": "dan danny", "david": "dave davy", "deborah": "deb debbie", "donald": "don donny", "dorothy": "dot dottie",
    "edward": "ed eddie ned ted", "elizabeth": "liz beth betty eliza lizzie betsy", "eugene": "gene", "frederick": "fred freddy freddie rick fritz",
    "gerald": "jerry gerry", "gregory": "greg", "henry": "hank harry hal", "james": "jim jimmy jamie", "jennifer": "jen jenny",
    "john": "jack johnny jon", "joseph": "joe joey", "katherine": "kate kathy katie kat kathryn", "kenneth": "ken kenny",
    "lawrence": "larry lars", "leonard": "len lenny leo", "margaret": "maggie peggy meg marge", "matthew": "matt", "michael": "mike mick mickey",
    "nicholas": "nick", "patricia": "pat patty trish tricia", "patrick": "paddy", "peter": "pete", "philip": "phil",
    "raymond": "ray", "rebecca": "becky becca", "richard": "dick rick rich richie", "robert": "bob bobby rob robbie bert", "ronald": "ron",
    "samuel": "sam sammy", "stephen": "steve", "susan": "sue susie", "theodore": "ted teddy theo", "thomas": "tom tommy",
    "timothy": "tim", "victoria": "vicky", "walter": "walt wally", "william": "bill billy will willie liam",
}
PREFIXES = {"fort": "fort", "ft": "fort", "mount": "mount", "mt": "mount", "saint": "saint", "st": "saint", "1": "one", "2": "two", "3": "three", "4": "four",
            "5": "five", "6": "six", "7": "seven", "8": "eight", "9": "nine"} | {w: w for w in "one two three four five six seven eight nine".split()}
_GIVEN: dict[str, tuple[str, ...]] = {}
for _full, _short in NICKNAMES.items():
    _GIVEN.setdefault(_full, ()), _GIVEN.__setitem__(_full, (*_GIVEN[_full], _full))
    for _s in _short.split():
        _GIVEN[_s] = (*_GIVEN.get(_s, ()), _full)
_SPLIT_ALIAS = re.compile(r"\s*[,;(]?\s*\b(?:d/b/a|dba|d\.b\.a\.?|doing business as|trading as|t/a|a/k/a|aka|f/k/a|fka|formerly)\b.*$")
_DIGITS = str.maketrans("01358", "olseb")


class Parsed(NamedTuple):
    core: str
    modifier: str
    trade: str
    given: tuple[str, ...]  # every given name it may stand for
    initial: str
    prefix: str
    family: str


def fold(text: str) -> str:
    return unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode()


def osa(a: str, b: str, most: int) -> int:
    """Edits of one letter or of two swapped neighbours; stops at most + 1."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    if a == b:
        return 0
    if len((x := set(a)) - (y := set(b))) > most or len(y - x) > most:  # each edit brings or takes one letter at most
        return most + 1
    # all of a row's cells at once, a bit each: where the last row's values rise and fall
    at: dict[str, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << i
    ones, top = (1 << len(a)) - 1, 1 << len(a) - 1 if a else 0
    up, down, flat, hit_before, far = ones, 0, 0, 0, len(a)
    for c in b:
        hit = at.get(c, 0)
        swapped = ((~flat & hit) << 1) & hit_before
        flat = ((((hit & up) + up) ^ up) | hit | down | swapped) & ones
        rise, fall = (down | ~(flat | up)) & ones, flat & up
        far += bool(rise & top) - bool(fall & top)
        rise, fall = (rise << 1 | 1) & ones, (fall << 1) & ones
        up, down, hit_before = (fall | ~(flat | rise)) & ones, rise & flat, hit
    return min(far, most + 1) if a else min(len(b), most + 1)


def skeleton(short: str, word: str) -> bool:
    """Whether ``short`` keeps the first letter of ``word`` and others of it in order."""
    if not short or short[0] != word[0] or len(short) >= len(word):
        return False
    rest = iter(word)
    return all(c in rest for c in short)


_HEARD = (("rn", "m"), ("ph", "f"), ("ck", "k"), ("dg", "g"), ("ai", "a"), ("au", "ow"), ("ou", "ow"))
_LIKE = str.maketrans("ywcqz", "ivkks")
_DOUBLED = re.compile(r"(.)\1+")


@lru_cache(1 << 16)
def sound(text: str) -> str:
    """One spelling for letters that are heard or read alike."""
    for a, b in _HEARD:
        if a in text:
            text = text.replace(a, b)
    return _DOUBLED.sub(r"\1", text.translate(_LIKE))


def _mask(word: str) -> int:
    """A bit for each sign that a word has."""
    out = 0
    for c in word:
        out |= 1 << (ord(c) & 63)
    return out


Known = tuple[tuple[str, int, int], ...]


def _known(words) -> Known:
    """Words with their lengths and signs."""
    return tuple((w, len(w), _mask(w)) for w in words)


def _near(token: str, words: Known, most: int) -> list[tuple[int, str]]:
    """The words within so many edits of a token; most are ruled out by their lengths and signs alone."""
    own, n = _mask(token), len(token)
    return [(d, w) for w, length, signs in words if -most <= length - n <= most and (own & ~signs).bit_count() <= most and (signs & ~own).bit_count() <= most and (d := osa(token, w, most)) <= most]


@lru_cache(1 << 16)
def _kin(token: str) -> str:
    """The family word that a token is meant to be, or nothing."""
    if token in FAMILY or len(token) < 4 or token in SHORT:
        return token if token in FAMILY else ""
    near = [(d, f) for f in FAMILY if (d := osa(token, f, 1 if len(f) < 6 else 2)) <= (1 if len(f) < 6 else 2)]
    return min(near)[1] if near else ""


_NAMES_GIVEN = _known(NICKNAMES)


@lru_cache(1 << 15)
def _given(token: str) -> tuple[str, ...]:
    if token in _GIVEN:
        return _GIVEN[token]
    if len(token) >= 5:
        near = _near(token, _NAMES_GIVEN, 1)
        if len(near) == 1:
            return (near[0][1],)
    return ()


def is_filler(text: str | None) -> bool:
    return text is None or " ".join(text.split()).lower() in FILLERS


_APOSTROPHE = re.compile(r"(?<=\w)['`](?=\w)")
_BRACKETS = re.compile(r"\(([^)]*)\)")
_NOTE = re.compile(r"\s(?:/|-|--|\||–|—)\s.*$")
_TAIL = re.compile(r",\s*([a-z]{2})\s*$")
_INITIALS = re.compile(r"\b([a-z])\.\s?(?=[a-z]\b)")
_WORDS = re.compile(r"[a-z0-9]+")
_AFTER_COMMA = re.compile(r",\s*([a-z]+)")


class Lexicon:
    """The generic words of names, and the parse of names by them."""

    def __init__(self, modifiers: tuple[str, ...], trades: tuple[str, ...]) -> None:
        self.words = {"m": frozenset(modifiers), "t": frozenset(trades)}
        self._ordered = {"m": tuple(sorted(modifiers)), "t": tuple(sorted(trades))}
        self._lengths: dict[tuple[str, int], Known] = {}
        self._first = {k: {c: tuple(w for w in v if w[0] == c) for c in {w[0] for w in v}} for k, v in self._ordered.items()}
        self._all = (*self._ordered["t"], *self._ordered["m"])
        self._long = tuple(sorted(self._ordered["t"], key=len, reverse=True)) + tuple(sorted(self._ordered["m"], key=len, reverse=True))
        # what was found of a word or name is kept a while, by this lexicon's caches
        self.meant, self.both, self.parts, self.parse = (lru_cache(1 << 16)(f) for f in (self._meant, self._both, self._parts, self._parse))

    def _meant(self, token: str, kind: str) -> tuple[str, int]:
        """The generic word that a token is meant to be, and how far it is: 0 the word, 1 a misspelling, 2 a short form, 9 none."""
        words = self.words[kind]
        if token in words:
            return token, 0
        plain = token.translate(_DIGITS)
        if len(plain) >= 5:
            others = {plain.replace("m", "rn"), plain.replace("rn", "m"), plain.replace("l", "i", 1), token.replace("1", "i").translate(_DIGITS)} - {plain}
            near = _near(plain, self._about(kind, len(plain)), 1 if len(plain) < 7 else 2)
            for o in others:
                near += _near(o, self._about(kind, len(o)), 1)
            if near:
                return min(near)[1], 1
        if token in SHORT:
            return (SHORT[token], 2) if SHORT[token] in words else ("", 9)
        if 2 <= len(token) <= 9:
            near = sorted((not w.startswith(token), not w.startswith(token.removesuffix("s")), len(w), w) for w in self._first[kind].get(token[0], ()) if skeleton(token, w) or token.endswith("s") and len(token) > 3 and skeleton(token[:-1], w))
            if near and (len(token) >= 3 or not near[0][0]):
                return near[0][3], 2
        return "", 9

    def _both(self, token: str) -> tuple[tuple[str, int], tuple[str, int]]:
        """What a token is meant to be as a trade and as a modifier."""
        return self.meant(token, "t"), self.meant(token, "m")

    def _about(self, kind: str, length: int) -> Known:
        """Generic words of about a length."""
        known = self._lengths.get((kind, length))
        if known is None:
            known = self._lengths[kind, length] = _known(w for w in self._ordered[kind] if abs(len(w) - length) <= 2)
        return known

    def _parts(self, token: str) -> tuple[str, ...]:
        """Parts of a token in which the space before or after a generic word was lost."""
        if token in self._all or not (token.endswith(self._all) or token.startswith(self._all)):
            return (token,)
        for w in self._long:
            if len(token) > len(w) + 2:
                if token.endswith(w):
                    return (*self.parts(token[: -len(w)]), w)
                if token.startswith(w):
                    return (w, *self.parts(token[len(w) :]))
        return (token,)

    def _bracket(self, m: re.Match) -> str:
        return f" {m[1]} " if any(self.meant(x, k)[1] < 2 for x in re.findall("[a-z]+", m[1]) for k in "mt") else " "

    def _parse(self, name: str | None) -> Parsed | None:
        """None for a missing or filler name."""
        if name is None or is_filler(name):
            return None
        text = (fold(html.unescape(name).replace("’", "'")) if not name.isascii() or "&" in name else name).lower()
        if "'" in text or "`" in text:
            text = _APOSTROPHE.sub("", text)
        text = text.strip()
        if "/" in text or "ba" in text or "ka" in text or " as " in text or "formerly" in text or "d.b.a" in text:
            text = _SPLIT_ALIAS.sub("", text) or text
        text = text.replace("amp;", " ")
        if "(" in text and not text.startswith("("):
            text = _BRACKETS.sub(self._bracket, text)
        if "-" in text or "/" in text or "|" in text:
            text = _NOTE.sub(" ", text)
        commas = "," in text
        if commas:
            text = _TAIL.sub(lambda m: m[0] if m[1] in LEGAL else " ", text)
        tokens = _WORDS.findall(_INITIALS.sub(r"\1", text) if "." in text else text)
        kept = [t for t in tokens if t not in STOP]
        while len(kept) > 1 and kept[-1] in LEGAL:
            kept.pop()
        kept = [t for t in kept if t not in LEGAL] or kept
        return self._assign(kept, _AFTER_COMMA.findall(text) if commas else ())

    def _assign(self, tokens: Sequence[str], after_comma: Sequence[str] = ()) -> Parsed | None:
        parts = [p for t in tokens for p in (self.parts(t) if len(t) > 8 else (t,))]
        found = {"m": "", "t": ""}
        given: tuple[str, ...] = ()
        initial = prefix = family = ""
        taken = [False] * len(parts)
        read = [self.both(p) if len(p) > 1 else (("", 9), ("", 9)) for p in parts]
        for grade in (0, 1):
            for side, kind in enumerate("tm"):
                if found[kind]:
                    continue
                for i in range(len(parts) - 1, -1, -1):
                    if not taken[i] and read[i][side][1] == grade and (grade == 0 or parts[i] not in _GIVEN):
                        found[kind], taken[i] = read[i][side][0], True
                        break
        for i, p in enumerate(parts):
            if taken[i]:
                continue
            if p in PREFIXES and i < len(parts) - 1 and not prefix:
                prefix, taken[i] = PREFIXES[p], True
            elif kin := _kin(p):
                family, taken[i] = kin, True
            elif not given and (i == 0 or p in NICKNAMES or p in after_comma or i == 1 and taken[0]) and (g := _given(p)) and sum(len(x) for j, x in enumerate(parts) if not taken[j]) >= len(p) + 5:
                given, taken[i] = g, True
            elif not initial and len(p) == 1 and p.isalpha():
                initial, taken[i] = p, True
        left = [i for i in range(len(parts)) if not taken[i]]
        for kind in "tm":
            if not found[kind] and len(left) > 1:
                for i in reversed(left):
                    w, how = self.meant(parts[i], kind)
                    if how == 2:
                        found[kind], taken[i] = w, True
                        left.remove(i)
                        break
        if not found["t"] and len(left) > 1:  # a word with two errors, or broken in two
            for i in reversed(left[1:]):
                near = sorted((osa(parts[i], w, 3), w) for w in self._ordered["t"] if parts[i][0] == w[0] and len(parts[i]) >= 5)
                if near and near[0][0] <= max(2, len(near[0][1]) // 3):
                    found["t"] = near[0][1]
                    left.remove(i)
                    break
        if not found["t"] and len(left) > 2:
            for i in range(len(left) - 1, 0, -1):
                w, how = self.meant(parts[left[i - 1]] + parts[left[i]], "t")
                if how < 2:
                    found["t"] = w
                    del left[i - 1 : i + 1]
                    break
        if found["t"].endswith("works") and len(left) > 1:
            left = [i for i in left if parts[i] not in ("wks", "works", "work", "wrks")] or left
        core = "".join(parts[i] for i in left).translate(_DIGITS)
        if not (core or given):
            core = "".join(parts)
        return Parsed(core, found["m"], found["t"], given, initial, prefix, family)


def jaro_winkler(a: str, b: str) -> float:
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    used = [False] * len(b)
    hits = []
    for i, x in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not used[j] and b[j] == x:
                used[j] = True
                hits.append(x)
                break
    if not hits:
        return 0.0
    other = [b[j] for j in range(len(b)) if used[j]]
    swaps = sum(x != y for x, y in zip(hits, other)) / 2
    m = len(hits)
    j = (m / len(a) + m / len(b) + (m - swaps) / m) / 3
    lead = 0
    for x, y in zip(a[:4], b[:4]):
        if x != y:
            break
        lead += 1
    return j + lead * 0.1 * (1 - j)


def monge_elkan(a: list[str], b: list[str], similar=jaro_winkler) -> float:
    """Mean over both directions of each token's best partner."""
    if not a or not b:
        return 0.0
    one = lambda x, y: sum(max(similar(s, t) for t in y) for s in x) / len(x)
    return (one(a, b) + one(b, a)) / 2


def core_close(a: str, b: str) -> bool:
    """Whether two family-name cores are spellings of one: equal as heard, or few edits for their length."""
    if a == b or sound(a) == sound(b):
        return True
    n = min(len(a), len(b))
    most = 0 if n < 4 else 1 if n < 7 else 2 if n < 14 else 3
    return osa(a, b, most) <= most or osa(sound(a), sound(b), 1) <= (1 if n >= 6 else 0)


@lru_cache(4)
def lexicon(modifiers: tuple[str, ...], trades: tuple[str, ...]) -> Lexicon:
    return Lexicon(modifiers, trades)


class Vocabulary(NamedTuple):
    """The generic words that a parse goes by; travels to the workers."""

    modifiers: tuple[str, ...] = ()
    trades: tuple[str, ...] = ()


def learn_words(names: DataFrame, name: str, share: float = SHARE, beside: int = BESIDE) -> Vocabulary:
    """The generic words of a column of names, counted over all names.

    A word counts if it makes up ``share`` of all words and ``beside`` different words stand after or before it; legal
    forms, given names, place-like prefixes and words that stand for a family have their own parts in a parse.  Of two
    generic words side by side the last is a trade; a word is one or the other by the majority of its places, and a trade
    if it has none.  At most 1 / share words come to the driver.  Nulls and empty tables give no words.
    """
    def pairs(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            seen: Counter = Counter()
            for text in part["t"]:
                words = _WORDS.findall((text if text.isascii() else fold(text)).lower())
                seen.update(zip(words, [*words[1:], ""]))
            yield pd.DataFrame([(*k, n) for k, n in seen.items()], columns=["word", "next", "n"])

    texts = names.select(F.col(name).alias("t")).filter("t is not null")
    counts = settle(texts.mapInPandas(pairs, "word string, next string, n bigint").groupBy("word", "next").agg(F.sum("n").alias("n")))
    total = counts.agg(F.sum("n").alias("n")).first().n or 0
    sides = counts.select("word", "n", F.substring("next", 1, 4).alias("by")).unionByName(counts.filter("next <> ''").select(F.col("next").alias("word"), F.lit(0).cast("bigint").alias("n"), F.substring("word", 1, 4).alias("by")))
    known = LEGAL | STOP | set(FAMILY) | set(PREFIXES) | set(_GIVEN)
    often = sides.groupBy("word").agg(F.sum("n").alias("n"), F.count_distinct("by").alias("by")).filter((F.col("n") >= share * total) & (F.col("by") >= beside) & F.col("word").rlike("^[a-z]{3,}$") & ~F.col("word").isin(*known))
    generic = sorted(r.word for r in often.select("word").collect())  # bounded: 1 / share
    both = counts.filter(F.col("word").isin(*generic) & F.col("next").isin(*generic)) if generic else counts.limit(0)
    places = both.select("word", F.col("n").alias("d")).unionByName(both.select(F.col("next").alias("word"), (-F.col("n")).alias("d")))
    first = {r.word for r in places.groupBy("word").agg(F.sum("d").alias("d")).filter("d > 0").collect()}  # bounded as well
    release(counts)
    return Vocabulary(tuple(w for w in generic if w in first), tuple(w for w in generic if w not in first))


def name_struct(vocabulary: Vocabulary):
    """Arrow UDF: the parse of a name as a struct of core, its sound, modifier and trade; null for no name."""
    modifiers, trades = vocabulary

    @pandas_udf("core string, sound string, modifier string, trade string")
    def parsed(names: pd.Series) -> pd.DataFrame:
        parse = lexicon(modifiers, trades).parse
        rows = [parse(n) for n in names]
        return pd.DataFrame([(None,) * 4 if p is None else (p.core, sound(p.core), p.modifier, p.trade) for p in rows], columns=["core", "sound", "modifier", "trade"])

    return parsed

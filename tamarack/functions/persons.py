"""Names of persons in texts that a model wrote, found by reading a text word by word."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from .geo import STATES

PERSON = "[PERSON]"
# What words next to a capitalised name say that it is a person's.
TITLES = {"Mr", "Mrs", "Ms", "Miss", "Dr"}
DONE_BY = {"founded", "started", "owned", "led", "run", "established", "headed", "managed"}
KIN_OF = {"son", "daughter", "wife", "husband", "grandson", "granddaughter", "nephew"}
OFFICES = {"founder", "co-founder", "owner", "president", "ceo", "chairman", "chairwoman", "principal"}
OFFICES_AFTER = ("CEO", "President", "Owner", "Founder", "Co-Founder", "Chairman", "Chairwoman", "Principal", "Vice President", "COO", "CFO", "CTO", "Director", "Manager")
ENDINGS = {"Jr", "Sr", "II", "III"}
# Given names.
GIVEN = frozenset(
    """
    aaron adam alan albert alex alexander alice allen amanda amy andrew angela ann anna anne
    anthony arthur barbara betty beverly bill billy bob bobby brandon brenda brian bruce bryan
    carl carol carolyn catherine charles charlie cheryl chris christina christine christopher
    cindy craig cynthia dan daniel danny david deborah debra dennis diana diane donald donna
    doris dorothy doug douglas earl edward elizabeth emily emma eric ernest eugene evelyn frank
    fred gary george gerald gloria grace greg gregory harold harry heather helen henry howard
    jack jacob james jane janet janice jason jean jeff jeffrey jennifer jeremy jerry jessica jim
    jimmy joan joe john johnny jonathan jose joseph joshua joyce juan judith judy julia julie
    justin karen katherine kathleen kathy keith kelly kenneth kevin kimberly larry laura
    lawrence linda lisa lori louis margaret maria marie marilyn mark martha martin mary matthew
    melissa michael michelle mike nancy nicholas nicole pamela patricia patrick paul peter
    philip phillip rachel ralph randy raymond rebecca richard rick robert roger ronald rose
    roy russell ruth ryan samuel sandra sara sarah scott sean sharon shirley stephanie stephen
    steve steven susan teresa terry thomas timothy tina todd tom tony victoria vincent walter
    wayne william willie
    """.split()
)

_WORD = re.compile(r"[A-Za-z][A-Za-z'-]*")
_AFTER = re.compile(r"\s*[,(–-]\s*(?:our\s+)?([A-Za-z-]+)( [A-Za-z]+)?")
_PLACES = {w for name in STATES.values() for w in name.lower().split()}


class _Reader:
    """A text as words with what stands between them."""

    def __init__(self, text: str) -> None:
        self.text = text
        spans = [m.span() for m in _WORD.finditer(text)]
        self.words = [text[a:b] for a, b in spans]
        self.begin, self.end = [a for a, _ in spans], [b for _, b in spans]

    def gap(self, i: int) -> str:
        """What stands between the words i - 1 and i."""
        return self.text[self.end[i - 1] if i else 0 : self.begin[i]]

    def name_word(self, i: int) -> bool:
        return i < len(self.words) and len(self.words[i]) > 1 and self.words[i][0].isupper() and not (self.begin[i] and self.text[self.begin[i] - 1].isalnum())

    def name_end(self, i: int, most: int | None = None) -> int:
        """The index after the name that begins at word i: name words side by side, an initial among them, an ending such as Jr. at last."""
        j, n = i + 1, 1
        while j < len(self.words) and n != most:
            if self.gap(j).isspace() and self.name_word(j):
                j, n = j + 1, n + 1
            elif n == 1 and len(self.words[j]) == 1 and self.words[j].isupper() and self.gap(j).isspace() and j + 1 < len(self.words) and self.name_word(j + 1) and re.fullmatch(r"\.\s+", self.gap(j + 1)):
                j, n = j + 2, n + 1
            else:
                break
        return j

    def close(self, j: int) -> int:
        """Where the name whose last word is j - 1 ends, with the full stop of its ending."""
        at = self.end[j - 1]
        return at + (self.words[j - 1] in ENDINGS and self.text[at : at + 1] == ".")

    def announced(self, i: int) -> bool:
        """Whether a title, an office, or "led by" and its like stand before word i."""
        if i and self.words[i - 1].lower() == "and" and self.gap(i).isspace() and self._cue(i - 1):
            return True
        return i > 0 and self._cue(i)

    def _cue(self, i: int) -> bool:
        if not i:
            return False
        last, gap = self.words[i - 1], self.gap(i)
        if last in TITLES:
            return re.fullmatch(r"\.?\s+", gap) is not None
        if re.fullmatch(r"[,:]?\s+", gap) is None:
            return False
        if last.lower() in OFFICES:
            return True
        led = i > 1 and self.gap(i - 1) == " "
        return led and (last.lower() == "by" and self.words[i - 2].lower() in DONE_BY or last.lower() == "of" and self.words[i - 2].lower() in KIN_OF)

    def explained(self, j: int) -> bool:
        """Whether an office stands after the name whose last word is j - 1."""
        after = _AFTER.match(self.text, self.close(j))
        return after is not None and (after[1] in OFFICES_AFTER or f"{after[1]}{after[2] or ''}" in OFFICES_AFTER)


def _persons(text: str, own: set[str]) -> Iterator[tuple[int, int]]:
    read = _Reader(text)
    i = 0
    while i < len(read.words):
        if not read.name_word(i):
            i += 1
            continue
        word = read.words[i]
        leads = word in TITLES or word.lower() in OFFICES
        j = read.name_end(i)
        if leads and read.name_word(i + 1) and read.announced(i + 1):
            i += 1  # a title or office, which a name follows
            continue
        if not (read.announced(i) or read.explained(j)):
            j = read.name_end(i, 2) if word.lower() in GIVEN else i
            if j < i + 2:
                i += 1
                continue
        named = [w.lower() for w in read.words[i:j] if w not in ENDINGS]
        if any(w not in own for w in named):
            yield read.begin[i], read.close(j)
        i = j


def mask_persons(text: str | None, company: str | None = None, city: str | None = None) -> str | None:
    """A text with names of persons replaced; words of the company's name, its city and of states are nobody's name.

    A name is one or more capitalised words that a title, an office or "led by" and its like announce, that an office
    follows, or two that begin with a given name.  Names that only a comma or "and" parts become one placeholder.
    """
    if not text:
        return text
    own = _PLACES | set(re.findall("[a-z']+", f"{company or ''} {city or ''}".lower()))
    joined: list[list[int]] = []
    for a, b in _persons(text, own):
        if joined and re.fullmatch(r"\s*,?\s*|\s+and\s+", text[joined[-1][1] : a]):
            joined[-1][1] = b
        else:
            joined.append([a, b])
    out, at = [], 0
    for a, b in joined:
        out += [text[at:a], PERSON]
        at = b
    return "".join(out) + text[at:]


def masked(text: Column, company: Column, city: Column) -> Column:
    """Arrow UDF of mask_persons."""

    @F.pandas_udf(StringType())
    def run(t: pd.Series, c: pd.Series, p: pd.Series) -> pd.Series:
        return pd.Series([mask_persons(*x) for x in zip(t, c, p)], dtype=object)

    return run(text, company, city)


def all_masked(texts: Column, company: Column, city: Column) -> Column:
    """Arrow UDF of mask_persons for an array of texts."""

    @F.pandas_udf(ArrayType(StringType()))
    def run(t: pd.Series, c: pd.Series, p: pd.Series) -> pd.Series:
        return pd.Series([None if x is None else [mask_persons(y, *z) for y in x] for x, *z in zip(t, c, p)], dtype=object)

    return run(texts, company, city)

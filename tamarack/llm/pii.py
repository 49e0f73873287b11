"""Personal information in free text: bootstrapped contextual extraction and typed placeholders."""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import settle
from .names import FAMILY, LEGAL, NICKNAMES, Vocabulary, learn_words
from .tables import table

ROUNDS, ACCEPT, SMOOTH = 3, 0.5, 2.0
#: Times a pattern or given name must be seen.
LEAST = 3
#: Characters of texts that are read together with what was learned about their words.
CHUNK = 2_000_000
KINDS = ("email", "phone", "id_number", "address", "name")

# ---- shapes of mail addresses, numbers and street addresses -------------------------------------------------------------

_AT = r"(?:\s?[@＠]\s?|\s?&#64;\s?|%40|\s?[\[({]\s?(?:at|AT|arroba)\s?[\])}]\s?|\sAT\s)"
_DOT = r"(?:\.|\s?[\[({]\s?(?:dot|DOT|punto)\s?[\])}]\s?|\sDOT\s)"
EMAIL = re.compile(rf"(?<![\w.+@＠-])[\w][\w.+%'’-]*{_AT}(?:[\w-]+{_DOT})+[^\W\d_]{{2,}}(?![\w@])")
#: Mail addresses in plain words, which only what stands around them tells from other text.
WORDED_EMAIL = re.compile(r"(?<![\w.+@-])[a-z][\w.+-]*\s(?:at|arroba)\s(?:[a-z0-9-]+\s(?:dot|punto)\s)+[a-z]{2,}(?!\w)")
_SEP = r"[-. \u00a0\u2009\u202f/‐‑–]"
_EXT = r"(?:,?\s?(?:x|ext\.?|extension|Durchwahl|poste)\s?\d{1,5})?"
_WORD_DIGIT = r"(?:zero|oh|one|two|three|four|five|six|seven|eight|nine)"
PHONE = re.compile(
    rf"""(?=[\d+(zofstein])(?<![\w+#/.-])(?:
      (?:\+?1[-. ]?)?(?:\(\d{{3}}\)\s?|\d{{3}}{_SEP}\s?)\d{{3}}{_SEP}\n?(?:\d{{4}}|[A-Z]{{4}}){_EXT}       # North America
    | \+?1[-.]\d{{3}}[-.]\d{{3}}[-.]\n?(?:\d{{4}}|[A-Z]{{4}}){_EXT}
    | (?:\+|00)(?:49|43|41)[ ]?(?:\(0\)[ ]?)?\d{{2,5}}[ /-]?\d{{3,4}}[ -]?\d{{2,5}}(?:-\d{{1,4}})?{_EXT}    # German
    | 0\d{{2,4}}[ ]?[/ -][ ]?\d{{3,6}}(?:[ -]\d{{2,5}})?
    | (?:\+33|0033)[ ]?\(?0?\)?[1-9](?:[ .]?\d{{2}}){{4}} | 0[1-9](?:[ .]\d{{2}}){{4}}                     # French
    | (?:\(\+34\)|\+34|0034)[ ]?\d{{3}}[ -]?\d{{3}}[ -]?\d{{3}} | [6789]\d{{2}}[ ]\d{{3}}[ ]\d{{3}}         # Spanish
    | \+44[ ]?(?:\(0\))?\d{{2,4}}[ ]?\d{{3,4}}[ ]?\d{{3,6}}                                                # British
    | \+\d{{1,3}}[ ]\d{{1,4}}(?:[ -]\d{{2,4}}){{2,4}}
    | {_WORD_DIGIT}(?:[ ,]+{_WORD_DIGIT}){{6,11}}
    )(?![\w-]|[.,]\d)""",
    re.VERBOSE,
)
BARE_PHONE = re.compile(r"(?<![\w#/.-])[2-9]\d{2}[2-9]\d{6}(?![\w-]|[.,]\d)")
NOT_PHONE = re.compile(r"(?:serial|part|model|drawing|lot|batch|ticket|order|invoice|p/n|spec|heat|item|code|ref\w*|référence|código|gasket|asset|po|rev|case|account)\s*(?:no\.?|nr\.?|#|number|:)?\s*#?$", re.I)
ID_VALUE = (
    r"(?:\d{3}[-. ‑]\d{2}[-. ‑]\d{4}|[A-Z]\d{3}-\d{4}-\d{4}|[A-Z]{1,2}\d{6,8}|\d{8}-?[A-Z]|[XYZ]-?\d{7}-?[A-Z]|[12] \d\d \d\d \d\d \d{3} \d{3}(?: \d\d)?"
    r"|[12]\d{12}(?:\d\d)?|\d{2} \d{3} \d{3} \d{3}|\d{11}|\d{9})(?![\w]|-\d|\.\d)"
)
# How numbers of persons are labelled.
ID_LABEL = (
    r"(?:ssn|soc(?:ial)?\.? ?sec(?:urity)?\.?(?: (?:no\.?|number|num))?|social(?: is)?|itin|tin|tax(?:payer)? (?:no\.?|id|number)|passport(?: no\.?| number)?|reisepass(?:nr\.?)?|passeport(?: n°)?|pasaporte"
    r"|(?:driver['’]?s )?licen[cs]e(?: no\.?| number)?|dl|dni|nie|nif|nir|n° de sécurité sociale|numéro de sécurité sociale|steuer-?id(?:nr\.?)?|idnr\.?|(?:personal)?ausweis(?:nr\.?|nummer)?|(?:id|identity) card(?: no\.?)?)"
)
ID_NUMBER = re.compile(rf"(?=[a-z])(?<![\w/]){ID_LABEL}\s*[#:]?\s*({ID_VALUE})", re.I)
ID_ANY = re.compile(rf"(?=[\dA-Z])(?<![\w-])({ID_VALUE})")
_SOME_AT = re.compile(r"[@＠]|&#64;|%40|[\[({]\s?(?:at|AT|arroba)\s?[\])}]|\sAT\s")
_SOME_ID = re.compile(rf"(?=[\dA-Z]){ID_VALUE}")

_CAP = r"(?:[A-ZÀ-Þ][\w'’À-ÿ-]*|\d{1,3}(?:st|nd|rd|th|ST|ND|RD|TH))"
_STREET_DOT = r"(?:St|Dr|Blvd|ST|DR|BLVD)\.?"
_STREET = r"(?:Street|Avenue|Ave|Road|Rd|Drive|Lane|Ln|Court|Ct|Boulevard|Parkway|Pkwy|Highway|Hwy|Way|Trail|Terrace|Circle|Cir|Place|Pl|Square)"
_STREETS = rf"(?:{_STREET_DOT}|{_STREET}|{_STREET.upper()})"
_DIR = r"(?:[NSEW]\.?(?:\s?[EW]\.?)?|North|South|East|West)"
_UNIT = r"(?:,?\s?\n?\s?(?:(?:Suite|Ste\.?|STE\.?|SUITE|Unit|UNIT|Bldg\.?|BLDG\.?|Building|Apt\.?|Room|Rm\.?)\s?[#]?[A-Z0-9-]{1,5}\b|[#]\s?\d+[A-Z]?\b|\d{1,2}(?:st|nd|rd|th|ST|ND|RD|TH)\s(?:Floor|FLOOR|Fl\.?)))?"
_NUMBER = r"(?:\d{1,5}(?:-[A-Z])?|One|Two|Three|Four|Five|Six|Seven|Eight|Nine|Ten|ONE|TWO|THREE|FOUR|FIVE|SIX|SEVEN|EIGHT|NINE|TEN)"
ADDRESS = re.compile(
    rf"""(?=[\dA-ZÄÖÜ])(?<![\w#/.-])(?:
      {_NUMBER}[ ](?:{_DIR}[ ])?(?:(?:County|COUNTY|State|STATE)[ ](?:Road|ROAD|Route|ROUTE|Highway|HIGHWAY)[ ]\d+|{_CAP}(?:[ ]{_CAP}){{0,3}}?[ ]{_STREETS}(?!\w))(?:[ ](?:[NSEW]\.?[EW]\.?|North|South|East|West|[NSEW]\.?)(?![\w]))?{_UNIT}
    | (?:P\.?\s?O\.?\s?Box|PO\sBOX|P\.O\.\sBOX|Post\sOffice\sBox|Postfach|Apartado)\s\d+
    | (?:Rural\sRoute|RURAL\sROUTE|RR|R\.R\.)\s\d+,\s(?:Box|BOX)\s\d+
    | (?:Am|An\sder|Zum|Zur|Auf\sder)[ ]{_CAP}[ ]\d{{1,4}}[a-z]?
    | [A-ZÄÖÜ][\w'’À-ÿ-]*(?:straße|strasse|str\.|weg|allee|gasse|platz|STRASSE|STRAßE|WEG)[ ]\d{{1,4}}[a-z]?
    | (?:C/|Calle|CALLE|Avda\.|Avenida|Camino|Plaza|Paseo)[ ](?:(?:de|del|la|las|los)[ ])*{_CAP}(?:[ ]{_CAP})?,?[ ]\d{{1,4}}(?:,[ ]\d{{1,2}}[ºª](?:[ ][A-Z])?)?
    | \d{{1,4}}(?:[ ](?:bis|ter))?,?[ ](?:rue|avenue|chemin|boulevard|place|allée|impasse|quai)[ ](?:(?:de[ ]la|des|du|de|d['’]|l['’])[ ]?)*{_CAP}
    )(?!\w)""",
    re.VERBOSE,
)

# ---- names -------------------------------------------------------------------------------------------------------------

# Fixed values.
TITLES = set("mr mrs ms miss dr prof frau herr mme mlle m sr sra srta senor senora senorita monsieur madame".split())
BEFORE_M = set("de à par avec chez pour contre".split())  # elsewhere M. is an initial and no title
PARTICLES = set("van von de la del der den di da du".split())
COMPANY = (LEGAL - {"co", "sa", "ag"}) | set(FAMILY)
#: Given names that are words too: in small letters they are no names.
WORDS_TOO = set("will bill rich rob ray sue may pat mark don gene art dot jack hank jean dale glen grant frank rose joy hope faith grace dawn drew chase bob tom dick rick chuck".split())
#: Words that begin sentences or stand in headings: capital letters there say nothing.
NO_NAME = set(
    "the a an and or of in on at to for from by with as is it we our your they this that no not all any each every some please ask call text mail fax tel phone visit reach send ship plant owner president sales contact contacto office "
    "address drawing model serial part order lot batch spec ticket invoice rev page news home about products capabilities dims size code tag follow search "
    "calle camino avda avenida plaza paseo rue chemin impasse quai county road street avenue drive lane court way trail terrace circle parkway highway suite unit bldg box po floor north south east west new fort saint st mount "
    "january february march april may june july august september october november december monday tuesday wednesday thursday friday saturday sunday "
    "hi hello dear best regards thanks cc re subject attached next estate executor buyer media director manager vp ceo cfo "
    "dirección adresse anschrift demandez pregunte escriba écrivez référence código schreiben ansprechpartner fragen seit im die der das el le les une un l en".split()
) | {"i", "he", "she", "you"}
_PART = r"[^\W\d_]+(?:['’](?!s\b)[^\W\d_]+)*"
_TOKEN = re.compile(rf"{_PART}(?:-{_PART})*|\d+|[^\w\s]")
_GAP = re.compile(r"^[ \t   ]+$")


@lru_cache(1 << 18)
def fold(text: str) -> str:
    if text.isascii():
        return text.lower()
    return unicodedata.normalize("NFKD", text.replace("ø", "o").replace("Ø", "O").replace("’", "'").replace("ł", "l")).encode("ascii", "ignore").decode().lower()


def tokens_of(text: str) -> list[tuple[str, int, int]]:
    return [(m[0], m.start(), m.end()) for m in _TOKEN.finditer(text)]


@lru_cache(1 << 16)
def _style(word: str) -> str:
    """How a word is written: T for a capital first, U for all capitals, l for small letters."""
    if word.isupper() and len(word) > 1:
        return "U"
    return "T" if word[:1].isupper() else "l"


def _word(token: str) -> str:
    return "#" if token.isdigit() else token.lower()


def contexts(tokens: list[tuple[str, int, int]], first: int, last: int) -> tuple[str, ...]:
    """The lexical patterns around the tokens first..last: the two words before, the word on either side, the two words after."""
    w = lambda i: _word(tokens[i][0]) if 0 <= i < len(tokens) else "^"
    return (f"L {w(first - 2)} {w(first - 1)}", f"B {w(first - 1)} _ {w(last + 1)}", f"R {w(last + 1)} {w(last + 2)}")


@dataclass
class Learned:
    """What the corpus taught: given names, patterns that stand around names, phone numbers and numbers of persons, and companies' words."""

    given: set[str] = field(default_factory=lambda: {w for k, v in NICKNAMES.items() for w in (k, *v.split())})
    patterns: set[str] = field(default_factory=set)
    #: words of companies' names
    company: set[str] = field(default_factory=lambda: set(COMPANY))


def _gap(text: str, a: tuple, b: tuple) -> bool:
    return bool(_GAP.match(text[a[2] : b[1]]))


def _family(text: str, tokens: list, i: int, style: str, company: set[str]) -> int:
    """Index after a family name with its particles that begins at token i; i if there is none."""
    j = i
    while j < len(tokens) and tokens[j][0].lower() in PARTICLES and j - i < 2 and j + 1 < len(tokens) and _gap(text, tokens[j], tokens[j + 1]):
        j += 1
    if j >= len(tokens):
        return i
    word = tokens[j][0]
    low = fold(word)
    if len(word) < 3 or not word[0].isalpha() or low in NO_NAME or low in company or low in PARTICLES or _style(word) == "l" and style != "l" or style == "l" and _style(word) != "l":
        return i
    return j + 1


def _company(text: str, tokens: list, first: int, end: int, company: set[str]) -> bool:
    """Whether the tokens are a part of a company's name: its other words stand next to them."""

    def words(i: int, step: int) -> Iterator[str]:
        while 0 <= i < len(tokens) and _gap(text, *(sorted((tokens[i - step], tokens[i]), key=lambda t: t[1]))):
            yield tokens[i][0]
            i += step

    for w in words(end, 1):
        if fold(w) in company:
            return True
        if w == "&" or w[0].isupper() and fold(w) not in NO_NAME:
            continue
        break
    before = list(_take(words(first - 1, -1), 3))
    if before[:1] and before[0].lower() == "of" and len(before) > 1 and fold(before[1]) in company:
        return True
    return bool(before) and before[0] == "&" and len(before) > 1 and before[1][0].isupper()


def _take(it: Iterator[str], n: int) -> Iterator[str]:
    for _, x in zip(range(n), it):
        yield x


def person_names(text: str, tokens: list[tuple[str, int, int]], know: Learned, taken: list[tuple[int, int, str]], asked: set[str] | None = None) -> list[tuple[int, int]]:
    """Spans of persons' names, by what is known of given names and patterns; a title inside a span that is taken (Foundry Dr.) is none.

    With ``asked`` every place is looked at, whatever stands before it, and all patterns that could decide are added to it.
    """

    def near(first: int, last: int) -> bool:
        around = contexts(tokens, first, last)
        if asked is not None:
            asked.update(around)
            return False
        return any(p in know.patterns for p in around)

    spans: list[tuple[int, int]] = []
    families: set[str] = set()
    weak: list[tuple[int, int, str]] = []
    i, n = 0, len(tokens)
    words = [t[0] for t in tokens]
    while i < n:
        word = words[i]
        if not word[0].isalpha():
            i += 1
            continue
        low = fold(word)
        style = _style(word)
        if asked is None and low in TITLES and not (word.isupper() and len(word) > 1) and not any(a <= tokens[i][1] < b for a, b, _ in taken) and (low != "m" or words[i + 1 : i + 2] == ["."] and words[i - 1 : i] and words[i - 1].lower() in BEFORE_M) and (word[0].isupper() or low.startswith("se")):
            j = i + 1 + (i + 1 < n and tokens[i + 1][0] == ".")
            if j < n and not text[tokens[i][1] : tokens[j][1]].strip(" . \t") == word:
                i += 1
                continue
            k = _family(text, tokens, j, _style(tokens[j][0]) if j < n and tokens[j][0].lower() not in PARTICLES else "T", know.company) if j < n else j
            if k > j and fold(tokens[j][0]) not in know.given:
                spans.append((tokens[j][1], tokens[k - 1][2]))
                families.add(fold(tokens[k - 1][0]))
                i = k
                continue
        if low in know.given and len(low) > 1 and not (style == "l" and low in WORDS_TOO):
            j = i + 1
            if j + 1 < n and len(tokens[j][0]) == 1 and tokens[j][0].isalpha() and tokens[j + 1][0] == "." and _gap(text, tokens[i], tokens[j]):
                j += 2
            if j < n and _gap(text, tokens[j - 1], tokens[j]):
                k = _family(text, tokens, j, "T" if style == "T" else style, know.company)
                if k > j and not _company(text, tokens, i, k, know.company):
                    if near(i, k - 1) if style == "l" else asked is None:
                        spans.append((tokens[i][1], tokens[k - 1][2]))
                        families.add(fold(tokens[k - 1][0]))
                        i = k
                        continue
        if (style != "l" or low in PARTICLES or len(word) > 3) and "," in (words[i + 1 : i + 4]):
            # family name, given name
            j = _family(text, tokens, i, "l" if style == "l" and low not in PARTICLES else "T", know.company)
            if j > i and j + 1 < n and tokens[j][0] == "," and tokens[j][1] == tokens[j - 1][2] and text[tokens[j][2] : tokens[j + 1][1]] == " ":
                g = tokens[j + 1]
                k = j + 2
                initial = False
                if k + 1 < n and len(tokens[k][0]) == 1 and tokens[k][0].isupper() and tokens[k + 1][0] == "." and _gap(text, g, tokens[k]):
                    k, initial = k + 2, True
                single = len(g[0]) == 1 and g[0].isupper() and k < n and tokens[k][0] == "."
                known = fold(g[0]) in know.given and len(g[0]) > 1
                longer = k < n and _gap(text, tokens[k - 1], tokens[k]) and _family(text, tokens, k, _style(g[0]), know.company) > k and _style(tokens[k][0]) != "l"
                if known and _style(g[0]) == _style(tokens[j - 1][0]) and (not longer or initial) and not _company(text, tokens, i, k, know.company):
                    if near(i, k - 1) if style == "l" else asked is None:
                        spans.append((tokens[i][1], tokens[k - 1][2]))
                        families.add(fold(tokens[j - 1][0]))
                        i = k
                        continue
                if single and near(i, k):
                    spans.append((tokens[i][1], tokens[k][2]))
                    i = k + 1
                    continue
        if len(word) == 1 and word.isupper() and i + 2 < n and tokens[i + 1][0] == "." and tokens[i + 1][1] == tokens[i][2] and _gap(text, tokens[i + 1], tokens[i + 2]):
            j = i + 2
            if j + 2 < n and len(tokens[j][0]) == 1 and tokens[j][0].isupper() and tokens[j + 1][0] == ".":
                j += 2
            k = _family(text, tokens, j, _style(tokens[j][0]) if tokens[j][0].lower() not in PARTICLES else "T", know.company)
            if k > j and _style(tokens[k - 1][0]) != "l" and not _company(text, tokens, i, k, know.company):
                if near(i, k - 1):
                    spans.append((tokens[i][1], tokens[k - 1][2]))
                    families.add(fold(tokens[k - 1][0]))
                    i = k
                    continue
                weak.append((tokens[i][1], tokens[k - 1][2], fold(tokens[k - 1][0])))
        i += 1
    spans += [(a, b) for a, b, f in weak if f in families]
    return spans


def _at(tokens: list[tuple[str, int, int]], a: int, b: int) -> tuple[int | None, int | None]:
    """Numbers of the tokens that begin at a and end at b."""
    i = bisect_left(tokens, a, key=lambda t: t[1])
    j = bisect_left(tokens, b, key=lambda t: t[2])
    return (i if i < len(tokens) and tokens[i][1] == a else None), (j if j < len(tokens) and tokens[j][2] == b else None)


def find_all(text: str, know: Learned) -> list[tuple[int, int, str]]:
    """Spans (begin, end, kind) of personal information in a text, in order and without overlap."""
    taken: list[tuple[int, int, str]] = []

    def add(a: int, b: int, kind: str) -> None:
        if b > a and all(b <= x or a >= y for x, y, _ in taken):
            taken.append((a, b, kind))

    tokens = tokens_of(text)

    def known(a: int, b: int, kind: str) -> bool:
        i, j = _at(tokens, a, b)
        return i is not None and j is not None and any(f"{kind} {p}" in know.patterns for p in contexts(tokens, i, j))

    for m in EMAIL.finditer(text) if _SOME_AT.search(text) else ():
        add(m.start(), m.end(), "email")
    for m in WORDED_EMAIL.finditer(text) if " dot " in text or " punto " in text else ():
        if known(m.start(), m.end(), "email"):
            add(m.start(), m.end(), "email")
    for m in ID_NUMBER.finditer(text) if _SOME_ID.search(text) else ():
        add(m.start(1), m.end(1), "id_number")
    for m in ADDRESS.finditer(text):
        add(m.start(), m.end(), "address")
    for m in PHONE.finditer(text):
        if not NOT_PHONE.search(text[max(0, m.start() - 25) : m.start()]):
            add(m.start(), m.end(), "phone")
    for m in BARE_PHONE.finditer(text):
        if known(m.start(), m.end(), "phone"):
            add(m.start(), m.end(), "phone")
    for m in ID_ANY.finditer(text):
        if all(m.end() <= x or m.start() >= y for x, y, _ in taken) and known(m.start(), m.end(), "id_number"):
            add(m.start(), m.end(), "id_number")
    for a, b in person_names(text, tokens, know, list(taken)):
        add(a, b, "name")
    return sorted(taken)


def patterns_of(text: str, know: Learned) -> set[str]:
    """The patterns of a text that find_all() could look up, by the given names that are known."""
    asked: set[str] = set()
    tokens = tokens_of(text)
    for kind, spans in (("email", [m.span() for m in WORDED_EMAIL.finditer(text)]), ("phone", [m.span() for m in BARE_PHONE.finditer(text)]), ("id_number", [m.span() for m in ID_ANY.finditer(text)])):
        for a, b in spans:
            i, j = _at(tokens, a, b)
            if i is not None and j is not None:
                asked.update(f"{kind} {p}" for p in contexts(tokens, i, j))
    person_names(text, tokens, know, [], asked)
    return asked


# ---- what the corpus teaches --------------------------------------------------------------------------------------------


def evidence(text: str, company: set[str], tokens: list[tuple[str, int, int]]) -> Iterator[tuple[str, str, str, int]]:
    """(kind, instance, pattern, known) of a text's candidates: a string of the right shape, and the words around it.

    Names: the first of two capitalised words is the instance, known if the lexicon has it as a given name.  The other
    kinds: the string itself, known where a label, a separator or its very shape tells what it is, not so a bare one.
    """
    for i in range(len(tokens) - 1):
        a, b = tokens[i], tokens[i + 1]
        if a[0][0].isupper() and b[0][0].isupper() and _style(a[0]) == "T" and len(a[0]) > 2 and _style(b[0]) == "T" and len(b[0]) > 3 and _gap(text, a, b):
            low = fold(a[0])
            if low in NO_NAME or low in company or low in TITLES or fold(b[0]) in NO_NAME or fold(b[0]) in company or _company(text, tokens, i, i + 2, company):
                continue
            for p in contexts(tokens, i, i + 1):
                yield "name", low, p, int(low in _SEEDS)
    spans = [(*m.span(1), "id_number", 1) for m in ID_NUMBER.finditer(text)] if _SOME_ID.search(text) else []
    spans += [(*m.span(), "phone", 1) for m in PHONE.finditer(text) if not NOT_PHONE.search(text[max(0, m.start() - 25) : m.start()])]
    spans += [(*m.span(), "email", 1) for m in EMAIL.finditer(text)] if _SOME_AT.search(text) else []
    covered = {(a, b) for a, b, _, _ in spans}
    bare = [(*m.span(), "phone", 0) for m in BARE_PHONE.finditer(text)] + [(*m.span(1), "id_number", 0) for m in ID_ANY.finditer(text)]
    bare += [(*m.span(), "email", 0) for m in WORDED_EMAIL.finditer(text)] if " dot " in text or " punto " in text else []
    for a, b, kind, seed in [*spans, *(x for x in bare if x[:2] not in covered)]:
        i, j = _at(tokens, a, b)
        if i is not None and j is not None:
            for p in contexts(tokens, i, j):
                yield kind, text[a:b], f"{kind} {p}", seed


_SEEDS = {w for k, v in NICKNAMES.items() for w in (k, *v.split())}


def score_graph(edges: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """Scores of the patterns (kind, pattern, score, n) and instances (kind, instance, score, n) of a graph of (kind, instance, pattern, known, n).

    A pattern's score is the mean of its instances' scores by how often they stand in it, an instance's the mean of its
    patterns' scores; both are drawn to 0 by SMOOTH unseen cases.  Known instances keep the score 1.
    """
    scores = edges.groupBy("kind", "instance").agg(F.max("known").cast("double").alias("score"), F.sum("n").alias("m"))
    patterns = None
    for _ in range(rounds):
        near = edges.join(scores.select("kind", "instance", "score"), ["kind", "instance"])
        patterns = settle(near.groupBy("kind", "pattern").agg((F.sum(F.col("n") * F.col("score")) / (F.sum("n") + SMOOTH)).alias("score"), F.sum("n").alias("n")))
        back = edges.join(patterns.select("kind", "pattern", F.col("score").alias("ps")), ["kind", "pattern"])
        scores = settle(back.groupBy("kind", "instance").agg(F.when(F.max("known") == 1, 1.0).otherwise(F.sum(F.col("n") * F.col("ps")) / (F.sum("n") + SMOOTH)).alias("score"), F.sum("n").alias("m")))
    return patterns, scores


def _gathered(chunked: DataFrame, company: set[str]) -> DataFrame:
    """All that one reading of texts (chunk, t) gives: (kind, instance, pattern, known, n) of candidates, and their words as (word, the word, chunk)."""

    def gather(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            counts: Counter = Counter()
            seen: dict[int, set[str]] = {}
            for c, t in zip(part["chunk"], part["t"]):
                tokens = tokens_of(t)
                counts.update(evidence(t, company, tokens))
                seen.setdefault(c, set()).update([w for w, _, _ in tokens])
            words = {(c, fold(w)) for c, ws in seen.items() for w in ws if len(w) > 1 and w[0].isalpha()}
            yield pd.DataFrame([*((*k, n) for k, n in counts.items()), *(("word", w, str(c), 0, 1) for c, w in words)], columns=["kind", "instance", "pattern", "known", "n"])

    return settle(chunked.mapInPandas(gather, "kind string, instance string, pattern string, known int, n bigint"))


def lessons(gathered: DataFrame) -> DataFrame:
    """(kind, value) of what the whole corpus supports: its patterns (kind pattern) and given names (kind given), however many there are."""
    edges = settle(gathered.filter("kind <> 'word'").groupBy("kind", "instance", "pattern", "known").agg(F.sum("n").alias("n")))
    patterns, scores = score_graph(edges)
    enough = lambda d, n: d.filter((F.col(n) >= LEAST) & (F.col("score") >= ACCEPT))
    given = enough(scores.filter("kind = 'name'"), "m").select(F.lit("given").alias("kind"), F.col("instance").alias("value"))
    return settle(enough(patterns, "n").select(F.lit("pattern").alias("kind"), F.col("pattern").alias("value")).unionByName(given).distinct())


def learn(documents: DataFrame, text: str, words: Vocabulary = Vocabulary()) -> Learned:
    """What the corpus supports in the driver's memory, all of it: for corpora whose lessons fit there; the others stay a table."""
    know = Learned(company=company_words(words))
    texts = documents.select(F.lit(0).alias("chunk"), F.col(text).alias("t")).filter("t is not null and t <> ''")
    for r in lessons(_gathered(texts, know.company)).collect():
        (know.given if r.kind == "given" else know.patterns).add(r.value)
    return know


def _pairs(of: Callable[[str], set[str]], part: pd.DataFrame) -> pd.DataFrame:
    """(chunk, value) of the values of a part's texts, each once."""
    values: dict[int, set[str]] = {}
    for c, t in zip(part["chunk"], part["t"]):
        values.setdefault(c, set()).update(of(t))
    return pd.DataFrame([(c, v) for c, vs in values.items() for v in vs], columns=["chunk", "value"])


def company_words(words: Vocabulary) -> set[str]:
    """Words of companies' names: legal forms, what stands for families, and the generic words that were learned."""
    return {*COMPANY, *words.modifiers, *words.trades}


def _known(lines: pd.DataFrame, company: set[str]) -> Learned:
    know = Learned(company=company)
    know.given |= set(lines["value"][lines["kind"] == "given"])
    know.patterns = set(lines["value"][lines["kind"] == "pattern"])
    return know


def _with_lessons(rows: DataFrame, company: set[str], run: Callable[[Iterator[pd.DataFrame], Learned], Iterator[pd.DataFrame]], schema: str) -> DataFrame:
    """What run() makes of the rows (k, t) with what the same rows teach.

    The rows are dealt into chunks; the words of a chunk, and then the patterns that its texts could look up, are joined
    to what was learned, so a chunk is read with all lessons that matter to it and no place holds all lessons.
    """
    size = rows.agg(F.sum(F.length("t"))).first()[0] or 0
    chunked = rows.withColumn("chunk", F.pmod(F.xxhash64(F.col("k").cast("string"), "t"), F.lit(size // CHUNK + 1).cast("bigint")))
    full = chunked.filter("t is not null and t <> ''")
    gathered = _gathered(full.select("chunk", "t"), company)
    learned = lessons(gathered)

    def patterns(part: pd.DataFrame, lines: pd.DataFrame) -> pd.DataFrame:
        know = _known(lines, company)
        return _pairs(lambda t: patterns_of(t, know), part)

    def read(part: pd.DataFrame, lines: pd.DataFrame) -> pd.DataFrame:
        return pd.concat([*run(iter([part]), _known(lines, company))], ignore_index=True)

    pick = lambda asked, kind: asked.distinct().join(learned.filter(F.col("kind") == kind), "value").select("chunk", "kind", "value")
    by = lambda d: d.groupBy("chunk")
    words = gathered.filter("kind = 'word'").select(F.col("pattern").cast("bigint").alias("chunk"), F.col("instance").alias("value"))
    given = settle(pick(words, "given"))
    near = pick(by(full.select("chunk", "t")).cogroup(by(given)).applyInPandas(patterns, "chunk bigint, value string"), "pattern")
    return by(chunked).cogroup(by(settle(given.unionByName(near)))).applyInPandas(read, schema)


def _apply(rows: DataFrame, know: Learned | None, words: Vocabulary, run: Callable[[Iterator[pd.DataFrame], Learned], Iterator[pd.DataFrame]], schema: str) -> DataFrame:
    return _with_lessons(rows, company_words(words), run, schema) if know is None else rows.mapInPandas(lambda parts: run(parts, know), schema)


def personal_spans(documents: DataFrame, key: str, text: str, know: Learned | None = None, words: Vocabulary = Vocabulary()) -> DataFrame:
    """(key, begin, end, kind, found_text) of every stretch of personal information, offsets in code points.

    What the same documents teach is used if ``know`` isn't given.  Null and empty texts have none; whole texts are
    read, however long.  Rows with a null key are kept.  Columns beside the two are ignored.
    """
    schema = f"k {documents.schema[key].dataType.simpleString()}, begin int, end int, kind string, found_text string"

    def find(parts: Iterator[pd.DataFrame], know: Learned) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = [(k, a, b, kind, t[a:b]) for k, t in zip(part["k"], part["t"]) for a, b, kind in find_all(t, know)]
            yield pd.DataFrame(rows, columns=["k", "begin", "end", "kind", "found_text"])

    rows = documents.select(F.col(key).alias("k"), F.col(text).alias("t")).filter("t is not null and t <> ''")
    return _apply(rows, know, words, find, schema).withColumnRenamed("k", key)


def redact(documents: DataFrame, key: str, text: str, know: Learned | None = None, words: Vocabulary = Vocabulary()) -> DataFrame:
    """(key, text): every text with "[KIND]" in place of each stretch and all else as it was; null stays null."""
    kind_of = documents.schema[key].dataType.simpleString()

    def cover(parts: Iterator[pd.DataFrame], know: Learned) -> Iterator[pd.DataFrame]:
        for part in parts:
            out = []
            for t in part["t"]:
                if not t:
                    out.append(t)
                    continue
                pieces, at = [], 0
                for a, b, kind in find_all(t, know):
                    pieces += [t[at:a], f"[{kind.upper()}]"]
                    at = b
                out.append("".join(pieces) + t[at:])
            yield pd.DataFrame({"k": part["k"], "t": out})

    rows = documents.select(F.col(key).alias("k"), F.col(text).alias("t"))
    return _apply(rows, know, words, cover, f"k {kind_of}, t string").select(F.col("k").alias(key), F.col("t").alias(text))


def _words(spark: SparkSession, folder: str) -> Vocabulary:
    return learn_words(table(spark, folder, "companies"), "canonical_name")


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    return personal_spans(table(spark, folder, "documents"), "doc_id", "text", words=_words(spark, folder)).select("doc_id", "kind", "found_text").distinct()


def p9_redacted(spark: SparkSession, folder: str) -> DataFrame:
    return redact(table(spark, folder, "documents"), "doc_id", "text", words=_words(spark, folder))

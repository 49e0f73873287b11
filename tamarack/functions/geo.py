"""Places as people write them: state, city and country normalisation as Spark expressions."""

from __future__ import annotations

import unicodedata
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .values import let

# US states, district and territory names by postal code.
STATES = {
    "AL": "Alabama", "AK": "Alaska", "AZ": "Arizona", "AR": "Arkansas", "CA": "California", "CO": "Colorado", "CT": "Connecticut",
    "DE": "Delaware", "DC": "District of Columbia", "FL": "Florida", "GA": "Georgia", "HI": "Hawaii", "ID": "Idaho", "IL": "Illinois",
    "IN": "Indiana", "IA": "Iowa", "KS": "Kansas", "KY": "Kentucky", "LA": "Louisiana", "ME": "Maine", "MD": "Maryland",
    "MA": "Massachusetts", "MI": "Michigan", "MN": "Minnesota", "MS": "Mississippi", "MO": "Missouri", "MT": "Montana",
    "NE": "Nebraska", "NV": "Nevada", "NH": "New Hampshire", "NJ": "New Jersey", "NM": "New Mexico", "NY": "New York",
    "NC": "North Carolina", "ND": "North Dakota", "OH": "Ohio", "OK": "Oklahoma", "OR": "Oregon", "PA": "Pennsylvania",
    "PR": "Puerto Rico", "RI": "Rhode Island", "SC": "South Carolina", "SD": "South Dakota", "TN": "Tennessee", "TX": "Texas",
    "UT": "Utah", "VT": "Vermont", "VA": "Virginia", "WA": "Washington", "WV": "West Virginia", "WI": "Wisconsin", "WY": "Wyoming",
}
# The older abbreviations of the states.
OLDER = {
    "ALA": "AL", "ARIZ": "AZ", "ARK": "AR", "CAL": "CA", "CALIF": "CA", "COLO": "CO", "CONN": "CT", "DEL": "DE", "FLA": "FL",
    "ILL": "IL", "IND": "IN", "KAN": "KS", "KANS": "KS", "KEN": "KY", "MASS": "MA", "MICH": "MI", "MINN": "MN", "MISS": "MS",
    "MONT": "MT", "NEB": "NE", "NEBR": "NE", "NEV": "NV", "NMEX": "NM", "NDAK": "ND", "NCAR": "NC", "NCAROLINA": "NC",
    "NDAKOTA": "ND", "OKLA": "OK", "ORE": "OR", "OREG": "OR", "PENN": "PA", "PENNA": "PA", "SCAR": "SC", "SCAROLINA": "SC",
    "SDAK": "SD", "SDAKOTA": "SD", "TENN": "TN", "TEX": "TX", "VIRG": "VA", "WASH": "WA", "WVA": "WV", "WVIRGINIA": "WV",
    "WIS": "WI", "WISC": "WI", "WYO": "WY", "NHAMPSHIRE": "NH", "NJERSEY": "NJ", "NMEXICO": "NM", "NYORK": "NY", "RISLAND": "RI", "WASHINGTONDC": "DC",
}
_NAMES = {n.upper().replace(" ", ""): c for c, n in STATES.items()}
_TABLE = _NAMES | {c: c for c in STATES} | OLDER

_ACCENTS = {}
for _i in range(0xC0, 0x250):
    _b = unicodedata.normalize("NFKD", chr(_i)).encode("ascii", "ignore").decode()
    if len(_b) == 1:
        _ACCENTS[chr(_i)] = _b


def ascii_fold(c: Column) -> Column:
    """Letters without their accents; what has no plain letter vanishes. Null stays null."""
    folded = F.regexp_replace(F.translate(c, "".join(_ACCENTS), "".join(_ACCENTS.values())), "[^\\x00-\\x7F]", "")
    return F.when(F.length(c) == F.octet_length(c), c).otherwise(folded)  # plain already


def literal_map(table: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in table.items() for x in kv])


def state_code(c: Column) -> Column:
    """Postal code of the state that a text means, null where it means none.

    Case, padding, punctuation, "US-", ", USA", "State of" and the older abbreviations are undone; of longer texts a
    spelling within two edits of one state's name (one edit up to seven letters) counts as that state.
    """
    text = F.upper(ascii_fold(F.trim(c)))
    text = F.regexp_replace(text, "^(STATE OF|COMMONWEALTH OF|US[-_/ ])\\s*", "")
    text = F.regexp_replace(text, "[, ]+(U\\.?S\\.?A?\\.?|UNITED STATES)$", "")
    text = F.regexp_replace(text, "[^A-Z]", "")
    names = F.array(*[F.struct(F.lit(n).alias("n"), F.lit(s).alias("s")) for n, s in sorted(_NAMES.items())])

    def code(t: Column) -> Column:
        near = F.array_min(F.transform(names, lambda x: F.struct(F.levenshtein(x["n"], t).alias("d"), x["s"].alias("s"))))
        fuzzy = let(near, lambda n: F.when(n["d"] <= F.when(F.length(t) <= 5, 1).otherwise(2), n["s"]))
        return F.coalesce(F.try_element_at(literal_map(_TABLE), t), F.when(F.length(t) >= 4, fuzzy))

    plain = F.upper(F.trim(c))
    return F.when(plain.isin(*STATES), plain).otherwise(let(text, code))


def state_code_or_text(c: Column) -> Column:
    """Postal code where letters and spaces alone give one, else the text in capitals without padding; blank gives null."""
    letters = F.regexp_replace(F.upper(c), "[^A-Z ]", "")
    squeezed = F.trim(F.regexp_replace(letters, "\\s+", " "))
    table = literal_map({n.upper(): s for s, n in STATES.items()} | {s: s for s in STATES})
    return F.coalesce(F.try_element_at(table, squeezed), F.nullif(F.upper(F.trim(c)), F.lit("")))


def city_key(c: Column) -> Column:
    """Folded lower-case city with Saint and Fort spelt out; a trailing state code after a comma goes. Blank gives null."""
    text = F.lower(ascii_fold(c))
    text = F.when(text.contains(","), F.regexp_replace(text, ",\\s*[a-z]{2}\\s*$", "")).otherwise(text)

    def spelt(t: Column) -> Column:
        long = reduce(lambda x, p: F.regexp_replace(x, f"\\b{p[0]}\\b", p[1]), (("st", "saint"), ("ft", "fort"), ("mt", "mount")), t)
        return F.when(t.rlike("\\b[sfm]t\\b"), long).otherwise(t)

    return F.nullif(let(F.trim(F.regexp_replace(text, "[^a-z0-9]+", " ")), spelt), F.lit(""))


def city_plain(c: Column) -> Column:
    """As city_key, but only Saint and Fort are spelt out and nothing after a comma goes."""
    text = F.trim(F.regexp_replace(F.lower(ascii_fold(c)), "[^a-z0-9]+", " "))
    text = reduce(lambda t, p: F.regexp_replace(t, f"\\b{p[0]}\\b", p[1]), (("st", "saint"), ("ft", "fort")), text)
    return F.nullif(text, F.lit(""))


def country_code(c: Column) -> Column:
    """US for the ways to write the United States, else the text in capitals; blank gives null."""
    letters = F.regexp_replace(F.lower(c), "[^a-z]", "")
    return F.when(letters.isin("us", "usa", "unitedstates", "unitedstatesofamerica"), "US").otherwise(F.nullif(F.upper(F.trim(c)), F.lit("")))


def area_slug(code: Column) -> Column:
    """A state's name as map files are called: small letters, hyphens for spaces; null for what is no state's code."""
    return F.try_element_at(literal_map({c: n.lower().replace(" ", "-") for c, n in STATES.items()}), code)


def city_title(c: Column) -> Column:
    """A city in capitals as it is written: each run of letters with a capital first, also after hyphens, apostrophes and digits."""
    parts = F.regexp_extract_all(F.lower(c), F.lit("\\p{L}+|[^\\p{L}]+"), F.lit(0))
    return F.array_join(F.transform(parts, lambda x: F.concat(F.upper(F.substring(x, 1, 1)), F.substring(x, 2, 1_000_000))), "")

"""What is looked for: sectors, size, place, ownership, exclusions and weights, read from YAML or a dict."""

from __future__ import annotations

import hashlib
import json
import re
from dataclasses import dataclass, field
from pathlib import Path

from ..functions.geo import STATES

PARTS = ("sector", "size", "geography", "ownership")
DEFAULT_WEIGHTS = {"sector": 0.4, "size": 0.2, "geography": 0.2, "ownership": 0.2}
SIGNALS = ("founder_led", "family_owned", "pe_or_strategic_backed", "publicly_traded")


class ThesisError(ValueError):
    """A field and the rule it breaks; never the value."""


@dataclass(frozen=True)
class Range:
    low: float | None = None
    high: float | None = None


@dataclass(frozen=True)
class Thesis:
    name: str
    naics_prefixes: tuple[str, ...]
    states: tuple[str, ...]
    keywords: tuple[str, ...] = ()
    end_markets: tuple[str, ...] = ()
    employees: Range | None = None
    facilities: Range | None = None
    revenue_usd_m: Range | None = None
    countries: tuple[str, ...] = ("US",)
    prefer: tuple[str, ...] = ()
    exclude_keywords: tuple[str, ...] = ()
    exclude_ownership: tuple[str, ...] = ()
    exclude_domains: tuple[str, ...] = ()
    weights: dict[str, float] = field(default_factory=lambda: dict(DEFAULT_WEIGHTS))
    threshold: float = 60.0

    @property
    def digest(self) -> str:
        return hashlib.sha256(json.dumps(self.__dict__, default=lambda r: r.__dict__, sort_keys=True).encode()).hexdigest()


def _state(text: str) -> str:
    letters = " ".join(re.sub("[^A-Za-z ]", "", text).upper().split())
    code = {n.upper(): c for c, n in STATES.items()}.get(letters, letters)
    if code not in STATES:
        raise ThesisError("geography.states: states must be US state codes or names")
    return code


def weights(given: dict[str, float] | None) -> dict[str, float]:
    """Weights that sum to 1; the defaults for none."""
    if not given:
        return dict(DEFAULT_WEIGHTS)
    if set(given) - set(PARTS):
        raise ThesisError(f"weights: valid weights are {', '.join(PARTS)}")
    if min(given.values()) < 0:
        raise ThesisError("weights: weights must not be negative")
    total = sum(given.values())
    if total <= 0:
        raise ThesisError("weights: weights must add up to more than 0")
    return {p: given.get(p, 0.0) / total for p in PARTS}


_FIELDS = {
    "": {"name", "sectors", "size", "geography", "ownership", "exclusions", "weights", "shortlist_threshold"},
    "sectors": {"naics_prefixes", "include_keywords", "end_markets"},
    "size": {"employees", "facilities", "revenue_usd_m"},
    "geography": {"countries", "states"},
    "ownership": {"prefer"},
    "exclusions": {"keywords", "ownership", "domains"},
}


def thesis_from(tree: dict) -> Thesis:
    """A thesis out of a tree of dicts and lists; ThesisError names the first field that breaks a rule."""
    for part, allowed in _FIELDS.items():
        node = tree if not part else tree.get(part) or {}
        if extra := sorted(set(node) - allowed):
            raise ThesisError(f"{part or 'thesis'}: unknown field {extra[0]}")
    sectors, geo, size = (tree.get(k) or {} for k in ("sectors", "geography", "size"))
    prefixes = tuple(str(p).strip() for p in sectors.get("naics_prefixes") or ())
    if not prefixes or any(not re.fullmatch(r"\d{2,6}", p) for p in prefixes):
        raise ThesisError("sectors.naics_prefixes: at least one prefix of 2-6 digits")
    states = tuple(sorted({_state(str(s)) for s in geo.get("states") or ()}))
    if not states:
        raise ThesisError("geography.states: at least one state")
    own, out = tree.get("ownership") or {}, tree.get("exclusions") or {}
    for where, signals in (("ownership.prefer", own.get("prefer")), ("exclusions.ownership", out.get("ownership"))):
        if set(signals or ()) - set(SIGNALS):
            raise ThesisError(f"{where}: valid ownership signals: {', '.join(SIGNALS)}")
    threshold = float(tree.get("shortlist_threshold", 60))
    if not 0 <= threshold <= 100:
        raise ThesisError("shortlist_threshold: 0 to 100")
    span = lambda k: Range(size[k].get("min"), size[k].get("max")) if size.get(k) else None
    return Thesis(str(tree["name"]), prefixes, states, tuple(sectors.get("include_keywords") or ()), tuple(sectors.get("end_markets") or ()), span("employees"), span("facilities"), span("revenue_usd_m"),
                  tuple(geo.get("countries") or ("US",)), tuple(own.get("prefer") or ()), tuple(out.get("keywords") or ()), tuple(out.get("ownership") or ()), tuple(out.get("domains") or ()),
                  weights(tree.get("weights")), threshold)


def load_thesis(path: str | Path) -> tuple[Thesis, str]:
    """The thesis of a YAML file, and the SHA-256 of the file's bytes."""
    import yaml

    data = Path(path).read_bytes()
    return thesis_from(yaml.safe_load(data)), hashlib.sha256(data).hexdigest()

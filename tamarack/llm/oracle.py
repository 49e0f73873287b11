"""Queries of this package in SQL, where SQL can say them on whole tables."""

from __future__ import annotations

from ..functions.geo import _NAMES, _TABLE
from ..oracle import _NOW, _REAL, _map, fold, head_count, with_domain

_RANKED = (
    "several AS (SELECT company_id FROM (SELECT DISTINCT raw_record_id, company_id FROM company_records) GROUP BY 1 HAVING count(*) >= 2), "
    + with_domain("raw_records", _NOW("website"), "id, source, ingested_at, payload_json")
    + f", v AS (SELECT x.company_id, d.id AS raw_record_id, d.source, d.ingested_at, coalesce(p.priority, 1000000) AS trust, {_REAL(_NOW('name'))} AS canonical_name, d.domain, {head_count(_NOW('employees'))} AS employee_count "
    "FROM d JOIN (SELECT DISTINCT raw_record_id, company_id FROM company_records) x ON x.raw_record_id = d.id JOIN several s ON s.company_id = x.company_id LEFT JOIN source_priority p ON p.source = lower(trim(d.source, ' '))), "
    "u AS (SELECT company_id, 'canonical_name' AS field_name, raw_record_id, ingested_at, trust FROM v WHERE canonical_name IS NOT NULL UNION ALL SELECT company_id, 'domain', raw_record_id, ingested_at, trust FROM v WHERE domain IS NOT NULL "
    "UNION ALL SELECT company_id, 'employee_count', raw_record_id, ingested_at, trust FROM v WHERE employee_count IS NOT NULL)"
)

_T = f"regexp_replace(regexp_replace(regexp_replace(upper({fold('trim(state)')}), '^(STATE OF|COMMONWEALTH OF|US[-_/ ])\\s*', ''), '[, ]+(U\\.?S\\.?A?\\.?|UNITED STATES)$', ''), '[^A-Z]', '', 'g')"
_STATES = "[" + ", ".join(f"{{'n': '{n}', 's': '{s}'}}" for n, s in sorted(_NAMES.items())) + "]"
_NEAR = f"list_min(list_transform({_STATES}, lambda x: {{'d': levenshtein(x.n, t), 's': x.s}}))"
_DIGITS = "list_filter(list_transform(list_filter(naics_codes, lambda c: c IS NOT NULL), lambda c: regexp_extract(regexp_replace(c, '[\\s.-]+(\\d)', '\\1', 'g'), '^\\D{0,8}(\\d{3,6})', 1)), lambda x: x <> '' AND NOT regexp_matches(x, '^0+$'))"
_SHORT = (
    f"c AS (SELECT id, {_T} AS t, {_DIGITS} AS l FROM companies), "
    f"k AS (SELECT id, coalesce({_map(_TABLE)}[t], CASE WHEN length(t) >= 4 THEN CASE WHEN {_NEAR}.d <= CASE WHEN length(t) <= 5 THEN 1 ELSE 2 END THEN {_NEAR}.s END END) AS state, l[1][1:3] AS naics3 FROM c), "
    "n AS (SELECT 'state' AS dimension, state AS category, count(*) AS available FROM k GROUP BY 2 UNION ALL SELECT 'naics3', naics3, count(*) FROM k GROUP BY 2), "
    "m AS (SELECT t.dimension, t.category, greatest(min_rows, floor(target_share * (SELECT count(*) // 4 FROM companies) + 0.5 + 1e-9))::BIGINT AS needed, coalesce(n.available, 0) AS available FROM sample_targets t LEFT JOIN n USING (dimension, category))"
)

_GROUPS = (
    "e AS (SELECT DISTINCT a AS u, b AS v FROM (SELECT a, b, decision FROM pair_decisions UNION ALL SELECT b, a, decision FROM pair_decisions) WHERE lower(trim(decision, ' ')) = 'merge' AND a <> b), "
    "cc(id, label) USING KEY (id) AS (SELECT DISTINCT u, u FROM e UNION SELECT e.u, min(c.label) FROM cc c JOIN e ON e.v = c.id JOIN recurring.cc r ON r.id = e.u WHERE c.label < r.label GROUP BY e.u)"
)

ORACLE: dict[str, str] = {
    "p1_found": f"WITH {_RANKED} SELECT company_id, field_name, raw_record_id FROM u QUALIFY row_number() OVER (PARTITION BY company_id, field_name ORDER BY trust, ingested_at DESC NULLS LAST, raw_record_id) = 1",
    "p2_found": f"WITH {_SHORT} SELECT dimension, category FROM m WHERE available < needed",
    "p5_found": f"WITH RECURSIVE {_GROUPS} SELECT id AS record_id, label AS group_id FROM cc",
    "p5_against_companies": f"WITH RECURSIVE {_GROUPS}, b AS (SELECT cc.id, cc.label AS group_id, r.company_id FROM cc LEFT JOIN company_records r ON r.raw_record_id = cc.id), s AS (SELECT company_id FROM b WHERE company_id IS NOT NULL GROUP BY 1 HAVING count(DISTINCT group_id) > 1) "
    "SELECT group_id, count(*)::BIGINT AS records, count(company_id)::BIGINT AS with_company, count(DISTINCT company_id) AS companies, count(DISTINCT CASE WHEN company_id IN (SELECT company_id FROM s) THEN company_id END) AS split_companies FROM b GROUP BY 1",
}

"""The general queries in SQL."""

from __future__ import annotations

from .functions.geo import STATES
from .functions.keys import GENERIC, LEGAL_ENDINGS, SHORT_FORMS, SITE_SHORT
from .functions.text import EMPTY, MAIL
from .functions.values import FILLERS
from .functions.web import SHARED_HOSTS, TWO_LABEL_SUFFIXES


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _list(words) -> str:
    return "[" + ", ".join(_q(w) for w in words) + "]"


def _map(table: dict[str, str]) -> str:
    return "MAP {" + ", ".join(f"{_q(k)}: {_q(v)}" for k, v in table.items()) + "}"


def fold(x: str) -> str:
    return f"regexp_replace(strip_accents({x}), '[^\\x00-\\x7F]', '', 'g')"


def tokens(x: str) -> str:
    return f"regexp_extract_all(replace(regexp_replace(lower({fold(x)}), '[&+]', ' and ', 'g'), '.', ''), '[a-z0-9]+')"


def expanded(x: str) -> str:
    return f"list_transform({tokens(x)}, lambda w: coalesce({_map(SHORT_FORMS)}[w], w))"


def drop_endings(t: str) -> str:
    return f"list_slice({t}, 1, coalesce(list_max(list_transform({t}, lambda w, i: CASE WHEN list_contains({_list(LEGAL_ENDINGS)}, w) THEN 0 ELSE i END)), 0))"


def singular(w: str) -> str:
    return f"CASE WHEN length({w}) <= 3 OR regexp_matches({w}, '(ss|us|is)$') THEN {w} WHEN ends_with({w}, 'ies') THEN regexp_replace({w}, 'ies$', 'y') ELSE regexp_replace({w}, 's$', '') END"


def with_key(source: str, name: str, columns: str) -> str:
    """CTEs that end in keyed: the columns and name_key of a source's rows."""
    return (
        f"e AS (SELECT {columns}, {name} AS the_name, {expanded(name)} AS t FROM {source}), "
        f"k AS (SELECT *, {drop_endings('t')} AS b FROM e), "
        "r AS (SELECT *, CASE WHEN b[1] = 'the' THEN list_slice(b, 2, 1000) ELSE b END AS s FROM k), "
        f"keyed AS (SELECT * EXCLUDE (t, b, s), array_to_string(list_transform(CASE WHEN len(s) > 0 THEN s ELSE t END, lambda w: {singular('w')}), ' ') AS name_key FROM r)"
    )


def state(x: str) -> str:
    names = {n.upper(): s for s, n in STATES.items()} | {s: s for s in STATES}
    return f"coalesce({_map(names)}[trim(regexp_replace(regexp_replace(upper({x}), '[^A-Z ]', '', 'g'), '\\s+', ' ', 'g'))], nullif(upper(trim({x}, ' ')), ''))"


def city(x: str) -> str:
    text = f"trim(regexp_replace(lower({fold(x)}), '[^a-z0-9]+', ' ', 'g'))"
    return f"nullif(regexp_replace(regexp_replace({text}, '\\bst\\b', 'saint', 'g'), '\\bft\\b', 'fort', 'g'), '')"


def country(x: str) -> str:
    return f"CASE WHEN regexp_replace(lower({x}), '[^a-z]', '', 'g') IN ('us','usa','unitedstates','unitedstatesofamerica') THEN 'US' ELSE nullif(upper(trim({x}, ' ')), '') END"


def host(x: str) -> str:
    bare = f"regexp_replace(lower(trim({x}, ' ')), '^([a-z][a-z0-9+.-]*:)?//', '')"
    found = f"regexp_replace(regexp_replace(regexp_extract({bare}, '^([^/?#:\\s]*)', 1), '^\\.+|\\.+$', '', 'g'), '^www\\d*\\.', '')"
    return f"CASE WHEN NOT contains(regexp_extract({bare}, '^([^/?#]*)', 1), '@') AND regexp_matches({found}, '^([a-z0-9]([a-z0-9_-]*[a-z0-9])?\\.)+[a-z]{{2,}}$') THEN {found} END"


def with_domain(source: str, url: str, columns: str, name: str = "d", prefix: str = "") -> str:
    """CTEs that end in {name}: the columns and own domain of a source's rows."""
    p = prefix
    parts = f"list_extract(string_split({p}host, '.'), -2) || '.' || list_extract(string_split({p}host, '.'), -1)"
    shared = f"({p}dom IN (SELECT host FROM platform_hosts) OR list_contains({_list(SHARED_HOSTS)}, {p}dom) OR {p}host IN (SELECT host FROM platform_hosts))"
    return (
        f"{name}0 AS (SELECT {columns}, {host(url)} AS {p}host FROM {source}), "
        f"{name}1 AS (SELECT *, CASE WHEN list_contains({_list(TWO_LABEL_SUFFIXES)}, {parts}) THEN CASE WHEN len(string_split({p}host, '.')) >= 3 THEN list_extract(string_split({p}host, '.'), -3) || '.' || {parts} END ELSE {parts} END AS {p}dom FROM {name}0), "
        f"{name} AS (SELECT * EXCLUDE ({p}host, {p}dom), CASE WHEN NOT {shared} THEN {p}dom END AS {p}domain FROM {name}1)"
    )


_NOW = "json_extract_string(payload_json, '$.{}')".format
_REAL = lambda x: f"CASE WHEN lower(trim(regexp_replace({x}, '\\s+', ' ', 'g'))) NOT IN ({', '.join(_q(f) for f in sorted(FILLERS))}) THEN trim(regexp_replace({x}, '\\s+', ' ', 'g')) END"


def head_count(x: str) -> str:
    """SQL of a clean head count; x is text."""
    t = f"regexp_replace(trim({x}), ',(\\d{{3}})', '\\1', 'g')"
    span = "^\\D{0,12}?(\\d+)(?:\\.\\d+)?\\s*(?:-|–|to)\\s*(\\d+)"
    low, high, one = f"regexp_extract({t}, '{span}', 1)", f"regexp_extract({t}, '{span}', 2)", f"regexp_extract({t}, '(\\d+(?:\\.\\d+)?)', 1)"
    value = f"CASE WHEN {low} <> '' THEN round_even((try_cast({low} AS DOUBLE) + try_cast({high} AS DOUBLE)) / 2, 0) ELSE try_cast(nullif({one}, '') AS DOUBLE) END"
    return f"CASE WHEN NOT regexp_matches({t}, '^\\s*-\\s*\\d') AND NOT regexp_matches({one}, '^9{{4,}}(\\.0*)?$') AND {value} > 0 AND {value} <= 2500000 THEN CAST({value} AS BIGINT) END"


def typed_int(x: str) -> str:
    t = f"replace({x}, ',', '')"
    span = "(\\d+(?:\\.\\d+)?)\\s*(?:-|–|to)\\s*(\\d+(?:\\.\\d+)?)"
    a, b = f"try_cast(nullif(regexp_extract({t}, '{span}', 1), '') AS DOUBLE)", f"try_cast(nullif(regexp_extract({t}, '{span}', 2), '') AS DOUBLE)"
    return f"CAST(coalesce(round_even(({a} + {b}) / 2, 0), round_even(try_cast(nullif(regexp_extract({t}, '\\d+(?:\\.\\d+)?'), '') AS DOUBLE), 0)) AS BIGINT)"


def phrase(p: str, x: str) -> str:
    return f"regexp_matches({x}, '(^|[^a-z0-9]){p.replace(' ', '[\\s]+')}(s|es)?([^a-z0-9]|$)')"


_PREFIXES = "(332|333|3261)"
_IN_THESIS = f"coalesce(len(list_filter(naics_codes, lambda c: regexp_matches(c, '^{_PREFIXES}'))) > 0, false)"
_FOUR = "floor(({}) * 10000 + 0.5) / 10000".format
_FIT = "CASE WHEN {0} < {1} THEN greatest(0.0, 1 - ({1} - {0}) / (0.5 * {1})) WHEN {0} > {2} THEN greatest(0.0, 1 - ({0} - {2}) / (0.5 * {2})) WHEN {0} IS NOT NULL THEN 1.0 END".format


def _scored() -> str:
    """CTEs that end in scored: the components, total, confidence and exclusion of companies."""
    low = "lower(text)"
    return (
        f"says AS (SELECT company_id, max(contains({low}, 'aerospace')::INT) AS m0, max(contains({low}, 'medical device')::INT) AS m1, max(contains({low}, 'family still owns')::INT) AS fam FROM documents WHERE company_id IS NOT NULL AND text IS NOT NULL GROUP BY 1), "
        f"f AS (SELECT c.id AS company_id, coalesce(canonical_name, '') AS name, lower(c.domain) AS domain, {state('c.state')} AS state, {country('c.country')} AS country, naics_codes, employee_count::DOUBLE AS emp, revenue_usd_m AS rev, m0, m1, fam, {_IN_THESIS} AS hit FROM companies c LEFT JOIN says s ON c.id = s.company_id), "
        f"g AS (SELECT *, coalesce(m0, 0) + coalesce(m1, 0) AS hits, {_FIT('emp', '20.0', '250.0')} AS by_staff, {_FIT('rev', '2.0', '40.0')} AS money FROM f), "
        "h AS (SELECT *, 0.6 * hit::INT + 0.4 * least(1.0, hits / 2.0) AS s0, CASE WHEN by_staff IS NOT NULL AND money IS NOT NULL THEN (by_staff + money) / 2 ELSE coalesce(by_staff, money, 0.5) END AS s1, "
        "CASE WHEN country IS NOT NULL AND country <> 'US' THEN 0.0 WHEN state IS NULL THEN 0.5 WHEN state IN ('GA','NC','SC','TN') THEN 1.0 ELSE 0.25 END AS s2, CASE WHEN fam = 1 THEN 1.0 ELSE 0.5 END AS s3, "
        "(hit OR hits > 0)::INT + (by_staff IS NOT NULL OR money IS NOT NULL)::INT + (coalesce(country <> 'US', false) OR state IS NOT NULL)::INT + coalesce(fam = 1, false)::INT AS seen, "
        f"CASE WHEN {phrase('laminates', 'lower(name)')} THEN 'keyword:laminates' WHEN {phrase('cabinetry', 'lower(name)')} THEN 'keyword:cabinetry' END AS exclusion_rule FROM g), "
        f"i AS (SELECT *, {_FOUR('s0')} AS sector, {_FOUR('s1')} AS size, {_FOUR('s2')} AS geography, {_FOUR('s3')} AS ownership FROM h), "
        "scored AS (SELECT *, exclusion_rule IS NOT NULL AS excluded, CASE WHEN exclusion_rule IS NOT NULL THEN 0.0 ELSE floor((0.0 + sector * 0.4::DOUBLE + size * 0.2::DOUBLE + geography * 0.2::DOUBLE + ownership * 0.2::DOUBLE) * 1000 + 0.5) / 10 END AS total, "
        "CASE WHEN seen = 4 THEN 'high' WHEN seen = 3 THEN 'medium' ELSE 'low' END AS confidence FROM i)"
    )


_DECISION = "CASE WHEN lower(trim(decision, ' ')) IN ('pursue','yes','y','1','true','target') THEN 'pursue' WHEN lower(trim(decision, ' ')) IN ('pass','no','n','0','false') THEN 'pass' END"
_GROUPS = f"groups AS (SELECT key, count(*) AS labels, count(DISTINCT d) = 1 AS agree, min(d) AS first_decision FROM (SELECT key, {_DECISION} AS d FROM label_rows) WHERE d IS NOT NULL AND key IS NOT NULL GROUP BY key)"
_AGREED = _GROUPS + ", agreed AS (SELECT key, first_decision AS decision FROM groups WHERE agree)"


def _items() -> str:
    return f"{_REPORT}, items AS (SELECT company_id AS id, score, decision = 'pursue' AS positive, excluded = 'yes' AS excluded FROM report WHERE score IS NOT NULL)"


_SPLIT = (
    _AGREED + ", p AS (SELECT *, row_number() OVER (PARTITION BY decision ORDER BY sha256('7:' || key), key) AS n, count(*) OVER (PARTITION BY decision) AS m FROM agreed), "
    "split AS (SELECT key, decision, CASE WHEN n <= CASE WHEN m < 2 THEN 0 ELSE greatest(1, least(m - 1, floor(m * 0.3::DOUBLE + 0.5))) END THEN 'test' ELSE 'dev' END AS split FROM p)"
)
_MATCH = (
    "WITH " + with_key("match_records", "name", "id, domain AS url, uei") + ", " + with_domain("keyed", "url", "*", "dm") + ", m AS (SELECT id, coalesce(name_key, '') AS key, domain, nullif(trim(uei, ' '), '') AS uei FROM dm), "
    "bk AS (SELECT 'uei' AS kind, uei AS block, id FROM m UNION ALL SELECT 'domain', domain, id FROM m UNION ALL SELECT 'first', string_split(key, ' ')[1], id FROM m WHERE key <> '' UNION ALL SELECT 'prefix', replace(key, ' ', '')[1:4], id FROM m WHERE key <> ''), "
    "blocks AS (SELECT DISTINCT * FROM bk WHERE block IS NOT NULL AND block <> '')"
)
_LAST = "row_number() OVER (PARTITION BY source, source_record_id ORDER BY ingested_at DESC NULLS LAST, id DESC NULLS LAST) = 1"
_CHANGE = "CASE WHEN row_number() OVER w = 1 THEN 'inserted' WHEN lag(payload_hash) OVER w IS NOT DISTINCT FROM payload_hash THEN 'unchanged' ELSE 'updated' END"
_HEX = "('0x' || substr(sha256({}), 1, 12))::BIGINT::DOUBLE / 281474976710656.0".format


_REVIEW = (
    "q AS (SELECT *, lower(trim(decision, ' ')) AS said FROM pair_decisions WHERE a <> b), "
    "review AS (SELECT DISTINCT CASE WHEN method = 'domain_conflict' THEN 'different_domains' ELSE 'possible_match' END AS kind, a, b, score, reason FROM q JOIN company_records x ON x.raw_record_id = a JOIN company_records y ON y.raw_record_id = b WHERE said = 'review' AND x.company_id <> y.company_id "
    "UNION SELECT DISTINCT 'merged_on_domain', a, b, score, reason FROM q WHERE said = 'merge' AND method = 'domain' AND score < 50)"
)
_ELIGIBLE = (
    with_key("companies", "canonical_name", "id, domain AS url, state AS st, country AS ct, naics_codes")
    + ", "
    + with_domain("keyed", "url", "*")
    + f", c AS (SELECT id AS company_id, the_name AS name, domain, {state('st')} AS state, {country('ct')} AS country, naics_codes, name_key FROM d), "
    + with_domain("label_rows", "website", "company_name, state AS lst", "ld", "l_")
    + f", l0 AS (SELECT *, {expanded('company_name')} AS t FROM ld), l1 AS (SELECT *, {drop_endings('t')} AS b FROM l0), l2 AS (SELECT *, CASE WHEN b[1] = 'the' THEN list_slice(b, 2, 1000) ELSE b END AS s FROM l1), "
    f"l3 AS (SELECT coalesce('d:' || l_domain, 'n:' || array_to_string(list_transform(CASE WHEN len(s) > 0 THEN s ELSE t END, lambda w: {singular('w')}), ' ') || '|' || lower(coalesce({state('lst')}, ''))) AS key FROM l2), "
    f"eligible AS (SELECT company_id, name, domain, state, CASE WHEN domain IS NULL THEN 'no_website' WHEN coalesce(len(naics_codes), 0) = 0 THEN 'naics_unknown' WHEN NOT {_IN_THESIS} THEN 'naics_outside' "
    "WHEN coalesce('d:' || domain, 'n:' || name_key || '|' || lower(coalesce(state, ''))) IN (SELECT key FROM l3 WHERE key IS NOT NULL) THEN 'labelled' ELSE 'eligible' END AS what FROM c WHERE state IN ('GA','NC','SC','TN') AND (country IS NULL OR country = 'US'))"
)
_FINDER = (
    with_key("companies", "canonical_name", "id, domain AS url, state AS st, city, country AS ct, naics_codes")
    + ", "
    + with_domain("keyed", "url", "*")
    + ", u AS (SELECT x.company_id, arg_min(json_extract_string(r.payload_json, '$.extra.uei'), r.id) AS uei FROM company_records x JOIN raw_records r ON r.id = x.raw_record_id WHERE json_extract_string(r.payload_json, '$.extra.uei') IS NOT NULL GROUP BY 1), "
    f"o AS (SELECT id AS company_id, the_name AS name, name_key, city, {state('st')} AS state, uei FROM d LEFT JOIN u ON u.company_id = d.id WHERE domain IS NULL AND {state('st')} IN ('GA','NC','SC','TN') AND coalesce({country('ct')}, 'US') = 'US' AND {_IN_THESIS}), "
    "targets AS (SELECT company_id, coalesce('uei:' || uei, 'n:' || name_key || '|' || lower(coalesce(state, ''))) AS search_key, name, city, state, uei, "
    f"(row_number() OVER (PARTITION BY state ORDER BY sha256('3:' || company_id), company_id) - 1 + {_HEX("'3:' || state")}) / count(*) OVER (PARTITION BY state) AS position FROM o)"
)
_REPORT = (
    f"{_scored()}, {_AGREED}, q0 AS (SELECT *, nullif(name, '') AS nm FROM scored), q1 AS (SELECT *, {expanded('nm')} AS t FROM q0), q2 AS (SELECT *, {drop_endings('t')} AS b FROM q1), q3 AS (SELECT *, CASE WHEN b[1] = 'the' THEN list_slice(b, 2, 1000) ELSE b END AS z FROM q2), "
    f"q4 AS (SELECT *, coalesce('d:' || domain, 'n:' || array_to_string(list_transform(CASE WHEN len(z) > 0 THEN z ELSE t END, lambda w: {singular('w')}), ' ') || '|' || lower(coalesce(state, ''))) AS lkey FROM q3), "
    "q5 AS (SELECT lkey, min(company_id) AS company_id FROM q4 WHERE lkey IS NOT NULL GROUP BY 1), "
    "q6 AS (SELECT a.key, a.decision, s.company_id, s.name, s.domain AS site, s.total, s.excluded AS ex, s.exclusion_rule, s.confidence, NOT s.excluded AND s.total >= 40 AS took FROM agreed a LEFT JOIN q5 ON q5.lkey = a.key LEFT JOIN scored s ON s.company_id = q5.company_id), "
    "report AS (SELECT key AS label_key, CASE WHEN total IS NOT NULL THEN name ELSE key END AS company_name, CASE WHEN total IS NOT NULL THEN site WHEN key LIKE 'd:%' THEN key[3:] END AS domain, decision, CASE WHEN total IS NULL THEN 'no' WHEN key LIKE 'd:%' THEN 'domain' ELSE 'name' END AS matched, company_id, total AS score, "
    "CASE WHEN total IS NOT NULL THEN row_number() OVER (PARTITION BY total IS NULL ORDER BY ex, total DESC, company_id, key) END AS rank, CASE WHEN total IS NOT NULL THEN CASE WHEN took THEN 'yes' ELSE 'no' END END AS shortlisted, CASE WHEN total IS NOT NULL THEN CASE WHEN ex THEN 'yes' ELSE 'no' END END AS excluded, exclusion_rule, confidence, "
    "CASE WHEN total IS NULL THEN 'unmatched' WHEN decision = 'pursue' AND ex THEN 'excluded_positive' WHEN decision = 'pursue' AND NOT took THEN 'false_negative' WHEN decision = 'pass' AND took THEN 'false_positive' ELSE '' END AS disagreement FROM q6)"
)

_SQUEEZED = "lower(trim(regexp_replace({}, '\\s+', ' ', 'g'), ' '))".format
_QUOTED = (
    "l AS (SELECT doc_id, text, regexp_extract(text, '^\\s*([^\\n]*)', 1) AS line FROM documents WHERE text IS NOT NULL), "
    "m AS (SELECT doc_id, text, CASE WHEN doc_id % 2 = 0 THEN lower(line) ELSE line || ' zz' END AS quote FROM l), "
    f"q AS (SELECT doc_id, quote, contains({_SQUEEZED('text')}, {_SQUEEZED('quote')}) AS there, list_transform(regexp_extract_all(text, '\\d[\\d,]*'), lambda x: try_cast(replace(x, ',', '') AS BIGINT)) AS numbers FROM m)"
)

ORACLE: dict[str, str] = {
    "name_key_companies": "WITH " + with_key("companies", "canonical_name", "id") + f", w AS (SELECT id, name_key, array_to_string(list_sort(list_distinct(list_transform({expanded('the_name')}, lambda w: {singular('w')}))), ' ') AS word_keys, "
    f"list_filter({tokens('the_name')}, lambda w: w NOT IN ('and', 'the')) AS q FROM keyed) SELECT id, name_key, word_keys, array_to_string(list_filter({drop_endings('q')}, lambda w: NOT list_contains({_list(GENERIC)}, w) AND length(w) >= 3 AND NOT regexp_matches(w, '^[0-9]+$')), ' ') AS distinctive FROM w",
    "guessed_domains": f"WITH a AS (SELECT id, {tokens('canonical_name')} AS t FROM companies), b AS (SELECT id, t, list_filter(t, lambda w: w NOT IN ('and', 'the')) AS q FROM a), c AS (SELECT id, t, {drop_endings('q')} AS w, {drop_endings('t')} AS e FROM b), "
    f"d AS (SELECT *, list_filter(w, lambda x: NOT list_contains({_list(GENERIC)}, x) AND length(x) >= 3 AND NOT regexp_matches(x, '^[0-9]+$')) AS good FROM c), "
    f"g AS (SELECT id, t, e, good, CASE WHEN len(list_filter(good, lambda x: length(x) >= 4)) > 0 THEN [array_to_string(w, ''), array_to_string(w, '-'), array_to_string(list_transform(w, lambda x: coalesce({_map(SITE_SHORT)}[x], x)), ''), "
    "CASE WHEN len(w) >= 3 AND len(list_filter(list_slice(w, 1, 2), lambda x: list_contains(good, x))) > 0 THEN w[1] || w[2] END] ELSE [] END AS l FROM d), "
    "h AS (SELECT id, t, e, list_filter(l, lambda x: x IS NOT NULL AND length(x) BETWEEN 6 AND 40) AS l FROM g) "
    "SELECT id, array_to_string(list_transform(list_slice(list_filter(l, lambda x, i: list_position(l, x) = i), 1, 4), lambda x: x || '.com'), ' ') AS guesses, "
    "array_to_string(list_sort(list_distinct(list_transform(list_filter(list_slice(t, len(e) + 1, 100), lambda x: x IN ('group', 'holding', 'holdings')), lambda x: CASE WHEN x = 'holdings' THEN 'holding' ELSE x END))), ' ') AS entity_words FROM h",
    "own_domain_raw": "WITH " + with_domain("raw_records", _NOW("website"), "id") + " SELECT id, domain FROM d",
    "state_city_country": f"SELECT id, {state('state')} AS state, {city('city')} AS city, {country('country')} AS country FROM companies",
    "label_keys": "WITH " + with_key("label_rows", "company_name", "row_number, website, state") + ", " + with_domain("keyed", "website", "*") + f" SELECT row_number, coalesce('d:' || domain, 'n:' || name_key || '|' || lower(coalesce({state('state')}, ''))) AS label_key FROM d",
    "search_keys": "WITH " + with_key("match_records", "name", "id, uei, state") + " SELECT id, coalesce('uei:' || nullif(trim(uei, ' '), ''), 'n:' || name_key || '|' || lower(coalesce(state, ''))) AS search_key FROM keyed",
    "row_hashes": "SELECT id, substr(sha256('city=' || lower(trim(coalesce(city, ''), ' ')) || chr(31) || 'domain=' || lower(trim(coalesce(domain, ''), ' ')) || chr(31) || 'name=' || lower(trim(coalesce(name, ''), ' ')) || chr(31) || 'state=' || lower(trim(coalesce(state, ''), ' '))), 1, 16) AS row_hash FROM match_records",
    "typed_numbers": f"SELECT id, {typed_int(_NOW('employees'))} AS typed_int, {head_count(_NOW('employees'))} AS head_count, round(try_cast(nullif(regexp_extract(replace({_NOW('revenue_usd_m')}, ',', ''), '-?\\d+(?:\\.\\d+)?'), '') AS DOUBLE), 4) AS revenue FROM raw_records",
    "naics_flags": "SELECT id, x[1:6] AS code, coalesce(nullif(x[7:7], ''), '') AS flag FROM (SELECT id, unnest(string_split(array_to_string(naics_codes, '~'), '~')) AS x FROM companies) WHERE regexp_matches(x, '^\\d{6}')",
    "thesis_rank": f"WITH {_scored()} SELECT company_id, CASE WHEN NOT excluded THEN row_number() OVER (ORDER BY excluded, total DESC, CASE confidence WHEN 'high' THEN 0 WHEN 'medium' THEN 1 ELSE 2 END, company_id) END::INT AS rank, total, sector, size, geography, ownership, confidence, excluded, exclusion_rule FROM scored",
    "score_rollup": f"WITH {_scored()} SELECT 'confidence' AS what, confidence AS value, count(*) AS n FROM scored GROUP BY 2 UNION ALL SELECT 'exclusion', coalesce(exclusion_rule, '(none)'), count(*) FROM scored GROUP BY 2 UNION ALL SELECT 'shortlisted', (NOT excluded AND total >= 60)::VARCHAR, count(*) FROM scored GROUP BY 2",
    "naics_in_thesis": f"SELECT id, {_IN_THESIS} AS in_thesis FROM companies",
    "block_pairs": _MATCH + " SELECT DISTINCT x.id AS a, y.id AS b FROM blocks x JOIN blocks y ON x.kind = y.kind AND x.block = y.block AND x.id < y.id",
    "block_sizes": _MATCH + " SELECT kind, block, count(*) AS records FROM blocks GROUP BY 1, 2",
    "canonical_records": "WITH last AS (SELECT arg_max(id, (ingested_at, id)) AS id FROM raw_records GROUP BY source, source_record_id), x AS (SELECT r.* FROM raw_records r JOIN last USING (id)), " + with_domain("x", _NOW("website"), "id, source, payload_json")
    + f", f AS (SELECT d.id, c.company_id, lower(trim(d.source, ' ')) AS source, {_REAL(_NOW('name'))} AS name, domain, {city(_NOW('city'))} AS city, {state(_NOW('state'))} AS state, {country(_NOW('country'))} AS country, {_NOW('naics')} AS naics, {head_count(_NOW('employees'))} AS emp, try_cast({_NOW('revenue_usd_m')} AS DOUBLE) AS rev FROM d JOIN company_records c ON c.raw_record_id = d.id), "
    "g AS (SELECT f.*, (coalesce(p.priority, 1073741824), -(coalesce(name <> '', false)::INT + coalesce(domain <> '', false)::INT + coalesce(city <> '', false)::INT + coalesce(state <> '', false)::INT + coalesce(country <> '', false)::INT + coalesce(naics <> '', false)::INT + (emp IS NOT NULL)::INT + (rev IS NOT NULL)::INT), f.id) AS o FROM f LEFT JOIN source_priority p ON p.source = f.source) "
    "SELECT company_id, (list(name ORDER BY o))[1] AS canonical_name, arg_min(domain, o) FILTER (domain <> '') AS domain, (list(city ORDER BY o) FILTER (state <> ''))[1] AS city, arg_min(state, o) FILTER (state <> '') AS state, arg_min(country, o) FILTER (country <> '') AS country, "
    "coalesce(string_agg(DISTINCT naics, ',' ORDER BY naics) FILTER (naics <> ''), '') AS naics_codes, arg_min(emp, o) FILTER (emp IS NOT NULL) AS employee_count, arg_min(source, o) FILTER (emp IS NOT NULL) AS employee_count_source, arg_min(rev, o) FILTER (rev IS NOT NULL) AS revenue_usd_m FROM g GROUP BY 1",
    "cache_keys": "SELECT doc_id, sha256('https://' || lower(domain) || coalesce(page_path, '/') || '?lang=' || replace(url_encode(coalesce(lang, '-')), '%20', '+') || '&page=' || doc_id) AS cache_key FROM documents WHERE domain IS NOT NULL",
    "best_evidence": "WITH p AS (SELECT a, b, method, score FROM pair_decisions WHERE lower(trim(decision, ' ')) = 'merge' AND a <> b), t AS (SELECT a AS id, b AS other, method, score FROM p UNION ALL SELECT b, a, method, score FROM p), "
    "g AS (SELECT id, arg_max({'m': method, 's': score}, (coalesce(score, 0.0) + CASE method WHEN 'override' THEN 1000.0 WHEN 'uei' THEN 500.0 WHEN 'domain' THEN 200.0 ELSE 0.0 END, -other)) AS x, count(*) AS n FROM t GROUP BY id) "
    "SELECT c.raw_record_id AS id, c.company_id AS cluster, coalesce(x.m, 'singleton') AS match_method, x.s AS match_score, coalesce(n, 0)::INT AS links FROM company_records c LEFT JOIN g ON g.id = c.raw_record_id",
    "review_between_companies": f"WITH {_REVIEW} SELECT * FROM review",
    "delivery_counts": f"SELECT source, change, count(*) AS records FROM (SELECT source, {_CHANGE} AS change FROM raw_records WINDOW w AS (PARTITION BY source, source_record_id ORDER BY ingested_at, id)) GROUP BY 1, 2",
    "latest_deliveries": f"SELECT id, source, source_record_id, payload_hash FROM raw_records QUALIFY {_LAST}",
    "snapshot_upsert": f"WITH o AS (SELECT * FROM raw_records WHERE ingested_at < TIMESTAMP '2025-08-01' QUALIFY {_LAST}), n AS (SELECT * FROM raw_records WHERE ingested_at >= TIMESTAMP '2025-08-01' QUALIFY {_LAST}), "
    "m AS (SELECT coalesce(o.source, n.source) AS source, CASE WHEN o.id IS NULL THEN 'inserted' WHEN n.id IS NULL THEN 'kept' WHEN o.payload_hash = n.payload_hash THEN 'unchanged' ELSE 'updated' END AS change, o.id AS oid, n.id AS nid FROM o FULL JOIN n ON o.source = n.source AND o.source_record_id = n.source_record_id) "
    "SELECT source, change, count(*) AS records, max(CASE WHEN change IN ('inserted', 'updated') THEN nid ELSE oid END) AS last_id FROM m GROUP BY 1, 2",
    "company_facts": "SELECT c.id, coalesce(d.documents, 0) AS documents, d.longest FROM companies c LEFT JOIN (SELECT company_id, count(*) AS documents, max(n_chars) AS longest FROM documents WHERE company_id IS NOT NULL GROUP BY 1) d ON c.id = d.company_id",
    "company_sources": "SELECT c.id AS company_id, (SELECT string_agg(DISTINCT r.source, '; ' ORDER BY r.source) FROM company_records x JOIN raw_records r ON r.id = x.raw_record_id WHERE x.company_id = c.id) AS sources FROM companies c",
    "company_uei": "SELECT x.company_id, arg_min(json_extract_string(r.payload_json, '$.extra.uei'), r.id) AS uei FROM company_records x JOIN raw_records r ON r.id = x.raw_record_id WHERE json_extract_string(r.payload_json, '$.extra.uei') IS NOT NULL GROUP BY 1",
    "unlabelled_companies": "WITH " + with_key("companies", "canonical_name", "id, domain AS url, state AS st") + ", " + with_domain("keyed", "url", "*") + f", c AS (SELECT id, domain, name_key, {state('st')} AS state FROM d), "
    + with_domain("label_rows", "website", "company_name, state AS lst", "ld", "l_") + f", l0 AS (SELECT *, {expanded('company_name')} AS t FROM ld), l1 AS (SELECT *, {drop_endings('t')} AS b FROM l0), l2 AS (SELECT *, CASE WHEN b[1] = 'the' THEN list_slice(b, 2, 1000) ELSE b END AS s FROM l1), "
    f"l3 AS (SELECT l_domain, array_to_string(list_transform(CASE WHEN len(s) > 0 THEN s ELSE t END, lambda w: {singular('w')}), ' ') AS lkey, {state('lst')} AS lstate FROM l2) "
    "SELECT id FROM c WHERE NOT EXISTS (SELECT 1 FROM l3 WHERE l_domain = domain) AND NOT EXISTS (SELECT 1 FROM l3 WHERE lkey = name_key AND lstate = state)",
    "labelled_in_states": f"SELECT state, id FROM (SELECT id, {state('state')} AS state FROM companies) WHERE state IN ('GA','NC','SC','TN')",
    "latest_run": "SELECT event_type, arg_max(event_id, (ts, event_id)) AS event_id, max(ts) AS ts FROM events GROUP BY 1",
    "status_counts": "SELECT method, count(*) AS pairs, count(*) FILTER (lower(trim(decision, ' ')) = 'merge') AS merges, count(*) FILTER (lower(trim(decision, ' ')) = 'review') AS reviews, count(DISTINCT a) AS records, count(*) FILTER (score >= 93) AS similar FROM pair_decisions GROUP BY 1",
    "latency_percentiles": "WITH v AS (SELECT event_type, list_sort(list(value)) AS l FROM events WHERE value IS NOT NULL GROUP BY 1) SELECT event_type, l[least(floor(len(l) * 0.95::DOUBLE)::BIGINT, len(l) - 1) + 1] AS p95, l[len(l) // 2 + 1] AS p50 FROM v",
    "timing_summary": "SELECT event_type, quantile_cont(value, 0.5) AS median_value, max(value) AS max_value, count(*) AS events FROM events GROUP BY 1",
    "daily_requests": "SELECT event_type, ts::DATE AS day, count(*) AS requests FROM events GROUP BY 1, 2",
    "json_values": "SELECT source, count(json_extract_string(payload_json, '$.extra.batch')) AS with_batch, count(DISTINCT json_extract_string(payload_json, '$.extra.batch')) AS batches, max(try_cast(json_extract_string(payload_json, '$.revenue_usd_m') AS DOUBLE)) AS max_revenue FROM raw_records GROUP BY 1",
    "label_groups": f"WITH {_GROUPS} SELECT * FROM groups",
    "split_contingency": f"WITH {_SPLIT} SELECT split, count(*) FILTER (decision = 'pursue') AS pursue, count(*) FILTER (decision = 'pass') AS pass, count(*) AS labels FROM split GROUP BY ROLLUP (split)",
    "confusion_matrix": f"WITH {_items()}, c AS (SELECT count(*) FILTER (NOT excluded AND score >= 40 AND positive) AS tp, count(*) FILTER (NOT excluded AND score >= 40 AND NOT positive) AS fp, count(*) FILTER (NOT (NOT excluded AND score >= 40) AND positive) AS fn, count(*) FILTER (NOT (NOT excluded AND score >= 40) AND NOT positive) AS tn FROM items) "
    "SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) END AS precision, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) END AS recall, CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) END AS f1 FROM c",
    "precision_interval": f"WITH {_items()}, c AS (SELECT count(*) FILTER (NOT excluded AND score >= 40 AND positive) AS tp, count(*) FILTER (NOT excluded AND score >= 40 AND NOT positive) AS fp FROM items), z AS (SELECT tp, fp, (tp + fp)::DOUBLE AS n, tp::DOUBLE / (tp + fp) AS p, 1.959963984540054::DOUBLE AS z FROM c) "
    "SELECT tp, fp, greatest(0.0, (p + z * z / (2 * n) - z * sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)) AS low, least(1.0, (p + z * z / (2 * n) + z * sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)) AS high FROM z",
    "average_precision": f"WITH {_items()}, o AS (SELECT positive, row_number() OVER w AS n, sum(positive::INT) OVER (w ROWS UNBOUNDED PRECEDING) AS h FROM items WINDOW w AS (ORDER BY excluded, score DESC, id)) SELECT avg(CASE WHEN positive THEN h / n END) AS average_precision FROM o",
    "roc_auc": f"WITH {_items()}, v AS (SELECT CASE WHEN excluded THEN 0.0 ELSE score END AS v, positive FROM items) SELECT (SELECT sum(CASE WHEN p.v > q.v THEN 1.0 WHEN p.v = q.v THEN 0.5 ELSE 0.0 END)::DOUBLE FROM v p, v q WHERE p.positive AND NOT q.positive) / nullif((SELECT count(*) FROM v WHERE positive) * (SELECT count(*) FROM v WHERE NOT positive), 0) AS roc_auc",
    "precision_at_k": f"WITH {_items()}, o AS (SELECT positive, row_number() OVER (ORDER BY excluded, score DESC, id) AS n FROM items), k AS (SELECT DISTINCT least(k, (SELECT count(*) FROM items))::INT AS k FROM (VALUES (10), (25), (50)) x(k)) SELECT k, count(*) FILTER (positive) AS hits, count(*) FILTER (positive) / k AS precision, count(*) FILTER (positive) / nullif((SELECT count(*) FROM items WHERE positive), 0) AS recall FROM k JOIN o ON n <= k GROUP BY k",
    "stratified_split": f"WITH {_SPLIT} SELECT * FROM split",
    "hash_split": f"SELECT c_custkey, CASE WHEN {_HEX("'7:' || c_custkey")} < 0.3 THEN 'test' ELSE 'dev' END AS split FROM customer",
    "spread_sample": f"SELECT id, state, turn::INT AS turn FROM (SELECT id, state, row_number() OVER (PARTITION BY state ORDER BY sha256('3:' || id), id) AS turn FROM (SELECT id, {state('state')} AS state FROM companies) WHERE state IS NOT NULL) WHERE turn <= 5 ORDER BY turn, state LIMIT 120",
    "sample_order": f"SELECT id, state, (row_number() OVER (PARTITION BY state ORDER BY sha256('3:' || id), id) - 1 + {_HEX("'3:' || state")}) / count(*) OVER (PARTITION BY state) AS position FROM (SELECT id, {state('state')} AS state FROM companies) WHERE state IS NOT NULL",
    "hand_check_sample": "SELECT id, ref FROM match_records ORDER BY sha256('5:' || id), id LIMIT 50",
    "size_classes": "WITH c AS (SELECT l_returnflag, l_linestatus, CASE WHEN l_quantity < 10 THEN '210' WHEN l_quantity < 30 THEN '220' ELSE '230' END AS code, count(*) AS n FROM lineitem GROUP BY ALL) SELECT l_returnflag, l_linestatus, sum(n)::BIGINT AS total, string_agg(code || '=' || n, ',' ORDER BY code) AS classes FROM c GROUP BY 1, 2",
    "market_sectors": "WITH c AS (SELECT unnest(naics_codes) AS code FROM companies), d AS (SELECT code, rtrim(code, '0') AS t FROM c WHERE regexp_matches(code, '^[0-9]{2,6}$') AND NOT regexp_matches(code, '^0+$')) SELECT code, count(*) AS companies FROM d WHERE starts_with(t, '332') OR starts_with('332', t) OR starts_with(t, '3332') OR starts_with('3332', t) OR starts_with(t, '311') OR starts_with('311', t) GROUP BY 1",
    "market_areas": "WITH r AS (SELECT n_nationkey, CASE WHEN n_nationkey % 5 = 0 THEN 'us' ELSE 'county' END AS level, n_name || ', ' || r_name AS name FROM nation JOIN region ON n_regionkey = r_regionkey) SELECT * FROM r WHERE level = 'us' OR name IN ('ASIA', 'EUROPE') OR ends_with(name, ', ASIA') OR ends_with(name, ', EUROPE')",
    "recipient_rollup": "WITH f AS (SELECT o_custkey, o_orderpriority[1:1] AS prefix, sum(o_totalprice) AS a, min(o_orderkey) AS o FROM orders WHERE o_custkey IS NOT NULL GROUP BY 1, 2) SELECT o_custkey, round(sum(a), 2) AS total_amount, string_agg(prefix, ',' ORDER BY o) AS prefixes FROM f GROUP BY 1",
    "reject_counts": f"WITH r AS (SELECT {_REAL(_NOW('name'))} AS name, {country(_NOW('country'))} AS country, {state(_NOW('state'))} AS state, {_NOW('naics')} AS naics FROM raw_records) SELECT CASE WHEN name IS NULL THEN 'unnamed' WHEN country <> 'US' THEN 'abroad' WHEN state IS NULL OR state NOT IN ('GA','NC','SC','TN') THEN 'place' WHEN NOT coalesce(regexp_matches(naics, '^{_PREFIXES}'), false) THEN 'sector' ELSE 'kept' END AS reject_reason, count(*) AS records FROM r GROUP BY 1",
    "scrubbed_mail": f"SELECT doc_id, sha256(regexp_replace(text, '{MAIL}', '[removed]', 'g')) AS digest FROM documents WHERE text IS NOT NULL",
    "phrase_hits": "SELECT doc_id, " + ", ".join(f"{phrase(p, 'lower(text)')} AS {p.replace(' ', '_')}" for p in ("medical device", "aerospace", "heat exchanger", "family")) + " FROM documents WHERE text IS NOT NULL",
    "document_numbers": "WITH n AS (SELECT doc_id, list_distinct(list_filter(list_transform(regexp_extract_all(text, '\\d[\\d,]*'), lambda x: try_cast(replace(x, ',', '') AS BIGINT)), lambda x: x IS NOT NULL)) AS n FROM documents WHERE text IS NOT NULL) SELECT doc_id, len(n)::INT AS numbers, list_max(n) AS largest FROM n",
    "distinct_lines": "WITH l AS (SELECT doc_id, list_filter(list_transform(regexp_split_to_array(text, '\\r\\n|\\r|\\n'), lambda x: trim(regexp_replace(x, '\\s+', ' ', 'g'), ' ')), lambda x: length(x) >= 2) AS l FROM documents WHERE text IS NOT NULL) "
    "SELECT doc_id, sha256(array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i), chr(10))) AS lines FROM l",
    "clean_lists": f"WITH x AS (SELECT company_id, list_sort(list(coalesce(lang, 'n/a'))) AS x FROM documents WHERE company_id IS NOT NULL GROUP BY 1), y AS (SELECT company_id, list_filter(list_transform(x, lambda v: trim(v, ' ')), lambda v: NOT list_contains({_list(EMPTY)}, lower(v))) AS x FROM x), z AS (SELECT company_id, x, list_transform(x, lambda v: lower(v)) AS l FROM y) SELECT company_id, array_to_string(list_slice(list_filter(x, lambda v, i: list_position(l, lower(v)) = i), 1, 10), '|') AS langs FROM z",
    "header_parts": "SELECT event_id, 'iso-' || (event_id % 9) AS charset, 'extract ' || event_id || '.zip' AS filename, CASE WHEN event_id % 3 <> 0 THEN event_id % 100 END AS retry_after FROM events",
    "grounded_quotes": f"WITH {_QUOTED} SELECT doc_id, (1 + (NOT list_contains({_list(EMPTY)}, lower(trim(quote, ' '))))::INT)::INT AS quotes, (NOT list_contains({_list(EMPTY)}, lower(trim(quote, ' '))) AND there)::INT AS quoted FROM q",
    "fiscal_windows": "SELECT o_orderkey, year(o_orderdate)::INT + (month(o_orderdate) >= 10)::INT AS fiscal_year, (date_trunc('month', o_orderdate)::DATE + ((7 - dayofweek(date_trunc('month', o_orderdate))) % 7)::INT)::DATE AS first_sunday FROM orders",
    "number_formats": "SELECT p_partkey, format('{:,}', p_partkey * 1000) AS grouped, p_size::VARCHAR AS general, p_size || CASE WHEN p_size % 100 BETWEEN 10 AND 20 THEN 'th' WHEN p_size % 10 = 1 THEN 'st' WHEN p_size % 10 = 2 THEN 'nd' WHEN p_size % 10 = 3 THEN 'rd' ELSE 'th' END AS ordinal FROM part",
    "review_rows": f"WITH {_REVIEW}, r AS (SELECT id, source_record_id AS ref, {_NOW('name')} AS name, {_NOW('website')} AS domain, {_NOW('state')} AS state, {_NOW('city')} AS city FROM raw_records) SELECT kind, reason, round(score, 1) AS name_similarity, "
    "x.ref AS ref_a, x.name AS name_a, x.domain AS domain_a, x.state AS state_a, x.city AS city_a, y.ref AS ref_b, y.name AS name_b, y.domain AS domain_b, y.state AS state_b, y.city AS city_b FROM review JOIN r x ON x.id = a JOIN r y ON y.id = b",
    "ranked_rows": f"WITH {_scored()}, src AS (SELECT x.company_id, string_agg(DISTINCT r.source, '; ' ORDER BY r.source) AS sources FROM company_records x JOIN raw_records r ON r.id = x.raw_record_id GROUP BY 1) "
    "SELECT CASE WHEN NOT excluded THEN row_number() OVER (ORDER BY excluded, total DESC, CASE confidence WHEN 'high' THEN 0 WHEN 'medium' THEN 1 ELSE 2 END, s.company_id) END::INT AS rank, total AS score, confidence, CASE WHEN excluded THEN 'yes' ELSE 'no' END AS excluded, name AS company, s.domain, c.city, s.state, "
    "coalesce(array_to_string(list_filter(s.naics_codes, lambda v: v <> ''), '; '), '') AS naics, c.employee_count AS employees, CASE WHEN c.employee_count IS NOT NULL THEN coalesce(c.employee_count_source, 'records') END AS employees_source, NULL::BIGINT AS facilities, c.revenue_usd_m, NULL::VARCHAR AS business_model, '' AS product_lines, "
    "array_to_string(list_filter([CASE WHEN m0 = 1 THEN 'aerospace' END, CASE WHEN m1 = 1 THEN 'medical device' END], lambda v: v IS NOT NULL), '; ') AS end_markets, 'unknown' AS founder_led, CASE WHEN fam = 1 THEN 'yes' ELSE 'unknown' END AS family_owned, 'unknown' AS pe_backed, src.sources, s.company_id, '2026-01-01T00:00:00Z' AS scored_at, 'makers' AS thesis_name "
    "FROM scored s JOIN companies c ON c.id = s.company_id LEFT JOIN src ON src.company_id = s.company_id",
    "market_rows": f"WITH c AS (SELECT unnest(naics_codes) AS naics, {state('state')} AS geo_code, employee_count FROM companies), g AS (SELECT naics, geo_code, count(*) AS establishments, sum(employee_count)::BIGINT AS employees, rtrim(naics, '0') AS t FROM c WHERE regexp_matches(naics, '^[0-9]{{2,6}}$') AND NOT regexp_matches(naics, '^0+$') AND geo_code IN ('GA','NC','SC','TN') GROUP BY 1, 2) "
    f"SELECT naics, 'sector ' || naics AS naics_label, 2025 AS year, 'state' AS geo_level, geo_code, {_map(STATES)}[geo_code] AS geo_name, establishments, employees, NULL::BIGINT AS annual_payroll_usd_k FROM g WHERE "
    + " OR ".join(f"starts_with(t, '{p}') OR starts_with('{p}', t)" for p in ("332", "333", "3261")),
    "label_eligibility": f"WITH {_ELIGIBLE} SELECT company_id, what FROM eligible",
    "rows_to_label": f"WITH {_ELIGIBLE}, n AS (SELECT *, row_number() OVER (PARTITION BY state ORDER BY sha256('3:' || company_id), company_id) AS turn FROM eligible WHERE what = 'eligible') SELECT company_id, name AS company_name, domain AS website, state, '' AS decision FROM (SELECT * FROM n WHERE turn <= 15 ORDER BY turn, state LIMIT 40)",
    "label_conflicts": f"WITH x AS (SELECT *, {_DECISION} AS d FROM label_rows), t AS (SELECT key FROM x WHERE key IS NOT NULL AND d IS NOT NULL GROUP BY 1 HAVING count(DISTINCT d) > 1) SELECT key AS label_key, row_number, company_name, website, state, d AS decision FROM x WHERE d IS NOT NULL AND key IN (SELECT key FROM t)",
    "finder_targets": f"WITH {_FINDER} SELECT * FROM targets",
    "tokens_per_company": "SELECT coalesce(sum(n_chars), 0)::BIGINT AS tokens, count(DISTINCT company_id) AS companies, coalesce(sum(n_chars), 0)::BIGINT / greatest(count(DISTINCT company_id), 1) AS tokens_per_company FROM documents",
    "evaluation_report": f"WITH {_REPORT} SELECT * FROM report",
    "excluded_positives": f"WITH {_REPORT} SELECT exclusion_rule AS rule, count(*) AS positives FROM report WHERE decision = 'pursue' AND excluded = 'yes' GROUP BY 1",
    "website_records": f"WITH {_FINDER}, kept AS (SELECT source, {_NOW('website')} AS website FROM raw_records r WHERE NOT (source = 'websites' AND source_record_id IN (SELECT search_key FROM targets)) UNION ALL "
    "SELECT 'websites', 'c' || company_id || '.example' FROM (SELECT max(company_id) AS company_id FROM targets GROUP BY search_key) WHERE company_id % 3 = 0) SELECT source, count(*) AS records, max(website) AS last_website FROM kept GROUP BY 1",
    "bootstrap_interval": f"WITH {_items()}, nums AS (SELECT positive, score, row_number() OVER (PARTITION BY positive ORDER BY id) - 1 AS i, count(*) OVER (PARTITION BY positive) AS n FROM items), "
    "draws AS (SELECT r.r, n.positive, ('0x' || substr(sha256('11:' || r.r || ':' || n.positive::INT || ':' || n.i), 1, 12))::BIGINT % n.n AS i FROM nums n, range(2000) r(r)), "
    "gaps AS (SELECT draws.r, avg(n.score) FILTER (n.positive) - avg(n.score) FILTER (NOT n.positive) AS gap FROM draws JOIN nums n ON n.positive = draws.positive AND n.i = draws.i GROUP BY 1), enough_ AS (SELECT count(*) FILTER (positive) >= 5 AND count(*) FILTER (NOT positive) >= 5 AS enough FROM items) "
    "SELECT CASE WHEN (SELECT enough FROM enough_) THEN quantile_cont(gap, 0.025) END AS low, CASE WHEN (SELECT enough FROM enough_) THEN quantile_cont(gap, 0.975) END AS high FROM gaps",
    "grounded_extractions": f"WITH {_QUOTED}, y AS (SELECT *, 1650 + doc_id % 370 AS year, NOT list_contains({_list(EMPTY)}, lower(trim(quote, ' '))) AND there AS kept FROM q) SELECT doc_id, (kept AND list_contains(numbers, year))::INT AS evidence, CASE WHEN list_contains(numbers, year) THEN year END AS founded_year, NOT list_contains(numbers, 5) AS floor_dropped, "
    "array_to_string(list_filter(['family_owned', CASE WHEN year < 1700 THEN 'founded_year' END, CASE WHEN doc_id % 12 IN (0, 11) THEN 'generation' END], lambda x: x IS NOT NULL), ',') AS invalid FROM y",
    "csv_records": "SELECT id, trim(canonical_name, ' ') AS name, nullif(trim(domain, ' '), '') AS website, nullif(trim(city, ' '), '') AS city, nullif(trim(state, ' '), '') AS state, employee_count AS employees, 'Remarks' AS further, 'mail [removed] or [removed], ' || id AS remarks FROM companies WHERE trim(canonical_name, ' ') <> ''",
    "label_file": f"SELECT trim(company_name, ' ') AS company_name, nullif(trim(website, ' '), '') AS website, nullif(trim(state, ' '), '') AS state, {_DECISION} AS decision, count(*) AS labels, count(*) AS rows FROM label_rows WHERE {_DECISION} IS NOT NULL AND trim(company_name, ' ') <> '' GROUP BY 1, 2, 3, 4",
    "streamed_deliveries": f"SELECT id, source, source_record_id, payload_hash FROM raw_records QUALIFY {_LAST}",
    "page_addresses": "WITH " + with_domain("companies", "domain", "id, city, state AS st") + f", x AS (SELECT id, domain, lower({fold('city')}) AS c, {state('st')} AS state FROM d) "
    f"SELECT id, CASE WHEN domain IS NULL THEN '' ELSE 'https://' || domain || '/ https://www.' || domain || '/ http://' || domain || '/' END AS pages, {_map({c: n.lower().replace(' ', '-') for c, n in STATES.items()})}[state] AS area, "
    "array_to_string(list_transform(regexp_extract_all(c, '[a-z]+|[^a-z]+'), lambda w: upper(w[1]) || w[2:]), '') AS city FROM x",
    "kept_facts": "WITH d AS (SELECT company_id, max(n_chars) AS n FROM documents WHERE company_id IS NOT NULL GROUP BY 1), e AS (SELECT *, company_id % 4 <> 0 AS ok FROM d) SELECT c.id AS company_id, CASE WHEN ok THEN 'ok' WHEN NOT ok THEN 'llm_timeout' END AS enrichment_status, CASE WHEN ok THEN 'makes things' END AS summary, CASE WHEN ok THEN n END AS floor, "
    "CASE WHEN ok THEN 'yes' END AS founder_led, CASE WHEN ok THEN 'castings' END AS product_lines FROM companies c LEFT JOIN e ON e.company_id = c.id",
    "spaced_requests": "WITH e AS (SELECT event_id, event_type, epoch(date_trunc('second', ts))::DOUBLE AS asked, row_number() OVER (PARTITION BY event_type ORDER BY epoch(date_trunc('second', ts)), event_id) AS i FROM events) SELECT event_id, max(asked - i * 40.0) OVER (PARTITION BY event_type ORDER BY i ROWS UNBOUNDED PRECEDING) + i * 40.0 AS starts FROM e",
}

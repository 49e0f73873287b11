import random

import pytest
from pyspark.sql import functions as F

from tamarack.functions import geo, keys, persons, text, values, web
from tamarack.functions.pages import best_links, page_links, page_parts, page_verdict, place_match
from tamarack.operators.match import common_subsequence, token_sort_similarities, token_sort_similarity


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize("given,want", [
    ("The Acme Mfg. Co., Inc.", "acme manufacturing"), ("Holdings Inc", "holding inc"), ("Smith & Sons Tools LLC", "smith and son tool"), ("Café Bräu Ltd", "cafe brau"),
    ("Glass Works Group", "glass work"), ("Industries of Ohio", "industry of ohio"), (None, None), ("", ""),
])
def test_name_key(spark, given, want):
    assert one(spark, keys.name_key, given) == want


@pytest.mark.parametrize("given,want", [
    ("HTTPS://WWW2.Acme.Example:8080/a?b#c", "acme.example"), ("shop.acme.co.uk", "acme.co.uk"), ("//acme.test", "acme.test"), (" acme.example. ", "acme.example"), ("info@acme.example", None),
    ("yard.example/x", None), ("me.yard.example", None), ("n/a", None), ("www", None), ("http://", None), (None, None), ("", None), ("co.uk", None), ("facebook.com/acme", None),
])
def test_own_domain(spark, given, want):
    assert one(spark, lambda c: web.own_domain(c, ["yard.example"]), given) == want


@pytest.mark.parametrize("given,want", [
    ("Georgia", "GA"), (" ga ", "GA"), ("G.A.", "GA"), ("US-GA", "GA"), ("GA, USA", "GA"), ("State of Georgia", "GA"), ("Nort hCarolina", "NC"), ("Misssisippi", "MS"), ("W. Va.", "WV"), ("Penna.", "PA"),
    ("unknown", None), ("??", None), ("N/A", None), (None, None), ("", None), ("Ontario", None),
])
def test_state_code(spark, given, want):
    assert one(spark, geo.state_code, given) == want


def test_city_and_country(spark):
    assert one(spark, geo.city_key, "St. Promhurst, GA") == "saint promhurst"
    assert one(spark, geo.city_key, "  ") is None
    assert one(spark, geo.country_code, "united states") == "US"
    assert one(spark, geo.country_code, "ca ") == "CA"


@pytest.mark.parametrize("given,want", [("40-60", 50), ("~36", 36), ("36 FTE", 36), ("1,200", 1200), ("17.0", 17), ("9999", None), ("0", None), ("-1", None), ("n/a", None), ("", None), (None, None)])
def test_head_count(spark, given, want):
    assert one(spark, values.head_count, given) == want


def test_candidate_domains(spark):
    assert one(spark, keys.candidate_domains, "Northfield Precision Manufacturing Inc") == ["northfieldprecisionmanufacturing.com", "northfield-precision-manufacturing.com", "northfieldprecisionmfg.com", "northfieldprecision.com"]
    assert one(spark, keys.candidate_domains, "United Services Group") == []


def test_entity_words_and_keys(spark):
    assert one(spark, keys.entity_words, "Acme Holdings Group Inc") == ["group", "holding"]
    assert one(spark, lambda c: keys.label_key(c, F.lit(None).cast("string"), F.lit("GA")), "Acme Tools Inc") == "n:acme tool|ga"
    assert one(spark, lambda c: keys.search_key(F.lit("U1"), c, F.lit("GA")), "Acme") == "uei:U1"


@pytest.mark.parametrize("a,b,want", [
    ("carolina valve", "carolina valves", 96.6), ("acme tool", "acme tools", 94.7), ("delta machine", "delta marine", 88.0), ("precision machining", "precision machine", 88.9),
    ("apex tool", "ajax tool", 77.8), ("metal works", "metalworks", 100.0), ("", "x", 0.0),
])
def test_similarity(a, b, want):
    assert round(token_sort_similarity(a, b), 1) == want


def test_similarities_of_many_pairs_at_once():
    r = random.Random(6)
    some = [None, "", " ", "a", "é😀 x", "tool acme", "acme tool", "acmetool", "x" * 64, "y" + "x" * 63, "x" * 65, "ab " * 40] + [" ".join("".join(r.choice("abcde") for _ in range(r.randrange(1, 16))) for _ in range(r.randrange(1, 6))) for _ in range(60)]
    a, b = zip(*[(p, q) for p in some for q in some])
    assert list(token_sort_similarities(a, b)) == [token_sort_similarity(p, q) for p, q in zip(a, b)]
    wide = ["".join(chr(0x4E00 + 40 * i + j) for j in range(40)) for i in range(400)]  # 16,000 signs
    assert list(token_sort_similarities(wide, wide[1:] + wide[:1])) == [0.0] * 400
    assert list(token_sort_similarities([], [])) == [] and list(token_sort_similarities([None], ["a"])) == [0.0]


def test_common_subsequence_brute_force():
    import random

    def slow(a, b):
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        return t[-1][-1]

    r = random.Random(1)
    for _ in range(300):
        a, b = ("".join(r.choice("abcd ") for _ in range(r.randrange(0, 20))) for _ in range(2))
        assert common_subsequence(a, b) == slow(a, b)


def test_scrub_contacts(spark):
    for there in ("a.b+c@x-y.example", "(478) 555-1234", "478.555.1234", "+1 478-555-1234", "1-800-FLOWERS", "800-GOT-JUNK", "555-FIXX"):
        assert one(spark, text.scrub_contacts, f"call {there} now") == "call [removed] now"
    for kept in ("range 250-1000", "100 PERCENT", "2024-01-05", "id 4785551234", "555-1234"):
        assert one(spark, text.scrub_contacts, kept) == kept


def test_text_helpers(spark):
    assert one(spark, lambda c: text.phrase_in("medical device", c), "for medical  devices only") is True
    assert one(spark, lambda c: text.phrase_in("tool", c), "toolbox") is False
    assert one(spark, text.numbers_in, "1,200 of 7 and 7") == [7, 1200]
    assert one(spark, text.first_sentences, "One. Two! three? Four.") == "One. Two! three?"
    assert one(spark, text.clean_list, [" a", "A", "n/a", None, "b"], "array<string>") == ["a", "b"]
    assert one(spark, text.distinct_lines, "a\nbb  c\nbb c\n") == "bb c"
    assert one(spark, lambda c: text.snippet(c, "staff"), "x" * 60 + " staff " + "y" * 60).count("staff") == 1
    assert one(spark, text.header_retry_after, " 12 ") == 12 and one(spark, text.header_retry_after, "soon") is None
    pages = [("/", "home"), ("/about", "x" * 50)]
    got = one(spark, lambda c: text.build_document(c, 30, 20), pages, "array<struct<path:string,body:string>>")
    assert got.startswith("### /\nhome\n\n### /about") and len(got) <= 32
    assert one(spark, lambda c: text.cache_url(c, F.create_map(F.lit("b"), F.lit("2"), F.lit("a"), F.lit("1 x"), F.lit("key"), F.lit("s"))), "http://h") == "http://h?a=1+x&b=2"


@pytest.mark.parametrize("given,company,want", [
    ("Founded by John Smith in 1950.", "Acme", "Founded by [PERSON] in 1950."), ("Founded in 1962 by John Smith, Acme is family-owned.", "Acme", "Founded in 1962 by [PERSON], Acme is family-owned."),
    ("Mary Jones, President, and Mr. Bo Lee", "", "[PERSON], President, and Mr. [PERSON]"), ("Our President, Mary Jones, leads the team.", "Acme", "Our President, [PERSON], leads the team."),
    ("owner William Steel", "William Steel Works", "owner William Steel"), ("Founded by Robert and Linda Walsh", "Acme", "Founded by [PERSON]"), ("CEO Tom Harris said", "Acme", "CEO [PERSON] said"),
    ("Dr. Alan Turing designed the line.", "Acme", "Dr. [PERSON] designed the line."), ("Smith & Sons has served Georgia since 1950.", "Smith & Sons", "Smith & Sons has served Georgia since 1950."),
    ("Founded by Taylor Devices engineers", "Taylor Devices", "Founded by Taylor Devices engineers"), ("Precision Machining for Aerospace", "Acme", "Precision Machining for Aerospace"),
    ("Serving New York and North Carolina", "Acme", "Serving New York and North Carolina"), ("run by Otto B. Zed Jr. since", "Acme", "run by [PERSON] since"), ("son of Ole Hansen III (our Vice President)", "", "son of [PERSON] (our Vice President)"),
    ("President and John Ek", "", "President and [PERSON]"), ("Zoe Quill (our Vice President)", "", "[PERSON] (our Vice President)"), ("x" * 50_000 + " Ann Lee", "", "x" * 50_000 + " [PERSON]"), ("", "", ""), (None, None, None),
])
def test_mask_persons(given, company, want):
    assert persons.mask_persons(given, company) == want


def test_city_is_nobodys_name():
    assert persons.mask_persons("Owned by Grand Rapids investors", "Acme", "Grand Rapids") == "Owned by Grand Rapids investors"


PAGE = """<html><head><title>Acme Tools | Home</title><meta name="description" content="We  make"><script>var t="</p>";</script></head>
<body><nav>menu</nav><p>Hello world</p><p>Hello world</p><a href="/about-us">About</a><a href="/contact">Contact</a><a href="mailto:x@y.z">m</a><a href="/p.pdf">products</a>
<footer>12 Main St, Macon, GA 31201</footer></body></html>"""


def test_pages(spark):
    title, description, _, body = page_parts(PAGE)
    assert (title, description) == ("Acme Tools | Home", "We make") and "menu" not in body and body.count("Hello world") == 1 and "Macon" not in body
    assert "Macon" in page_parts(PAGE, keep_footer=True)[3]
    assert one(spark, lambda c: best_links(page_links(c, F.lit("https://acme.example/")), 3), PAGE) == ["https://acme.example/about-us"]
    d = spark.createDataFrame([("title", "city", False), ("body", None, False), ("title_fuzzy", "state", False), ("title", "city", True)], "n string, p string, k boolean")
    got = [tuple(r.v) for r in d.select(page_verdict(F.col("n"), F.col("p"), F.col("k")).alias("v")).collect()]
    assert got == [(0.95, None), (0.0, "no city/state evidence"), (0.0, "fuzzy title needs city"), (0.0, "parked domain")]
    assert one(spark, lambda c: place_match(c, F.lit("macon"), F.lit("GA")), "in Macon today") == "city"
    assert one(spark, lambda c: place_match(c, F.lit("rome"), F.lit("GA")), "Macon, GA 31201") == "state"
    assert one(spark, lambda c: place_match(c, F.lit("rome"), F.lit("GA")), "mega") is None


def test_places_of_pages(spark):
    assert one(spark, web.homepages, "a.test") == ["https://a.test/", "https://www.a.test/", "http://a.test/"]
    assert one(spark, geo.area_slug, "NC") == "north-carolina" and one(spark, geo.area_slug, "XX") is None and one(spark, geo.area_slug, None) is None
    assert [one(spark, geo.city_title, c) for c in ("SAINT PAUL", "O'FALLON", "WINSTON-SALEM", "", None, "3RD BAY")] == ["Saint Paul", "O'Fallon", "Winston-Salem", "", None, "3Rd Bay"]
    assert [web.is_local(u) for u in ("http://localhost:1/x", "http://127.0.0.1", "http://[::1]:5", "http://10.0.0.1", "http://example.com", "x")] == [True, True, True, False, False, False]

import random
from pathlib import Path
from types import SimpleNamespace as NS

import pytest
from pyspark.sql import functions as F

from tamarack import session
from tamarack.llm.components import small_components
from tamarack.llm import linkage
from tamarack.llm.linkage import RADIUS, bit_vector, calibrate, dice, hamming_pairs, match_sources, with_confidence
from tamarack.llm.names import Vocabulary, core_close, learn_words, lexicon, name_struct, osa, sound
from tamarack.llm.variants import RECALL, ROWS, SIMILARITY, band_count, band_keys, collision, entity_links, form_table, hub_links, spelling_pairs, star_clusters

WORDS = Vocabulary(("custom", "general", "precision"), ("bakery", "castings", "turbines", "valves"))

def typed(spark, rows):
    """Rows (key, name, state, city, domain) as the matchers take them."""
    d = spark.createDataFrame(rows, "key bigint, name string, state string, city string, domain string")
    parts = d.select("key", name_struct(WORDS)("name").alias("p"), "state", "city", "domain").select("key", "p.core", "p.sound", "p.modifier", "p.trade", "state", "city", "domain")
    return parts.selectExpr("*", "'clash' form", "1 weight", "'x' tag", "2 hub", "'y' center")


ROWS_ = [
    (1, "Lawrence Truckdale General Turbines LLC", "NC", "rome", None), (2, "TRUCKDALE, LARRY GENL TURBINES", "NC", None, None), (3, "General Turbines of Trukdale Inc", "NC", None, "t.test"), (4, "see notes", None, None, "t.test"),
    (5, "Truckdale General Turbines LLC", "GA", None, None), (6, "Truckdale General Castings LLC", "NC", None, None), (7, "Truckdale General Turbines", None, "rome", None), (8, "Truckdale General Turbines", None, None, None),
    (9, "Bellmont Precision Valves", "OH", None, None), (10, "Belmont Precision Valvs", None, None, None), (11, None, None, None, None), (12, "", "NC", None, None), (None, "Bellmont Precision Valves", "OH", None, None), (9, "Bellmont Precision Valves", "OH", None, None),
    (13, "Oddname Custom Bakery", None, None, None), (14, "Oddname Custom Bakery", None, "rome", None),
]
WANT = {1: 1, 2: 1, 3: 1, 4: 1, 7: 1, 9: 9, 10: 9, 13: 13, 14: 13}


def test_entity_links(spark):
    got = small_components(entity_links(typed(spark, ROWS_), "key"), "key", "hub")
    assert {r.record_id: r.group_id for r in got.collect()} == WANT
    assert small_components(entity_links(typed(spark, ROWS_).limit(0), "key"), "key", "hub").count() == 0


def test_match_sources(spark):
    rows = typed(spark, ROWS_).filter("key is not null").withColumn("side", (F.col("key") % 2).cast("int")).withColumn("record_id", F.col("key"))
    got = {r.record_id: r.group_id for r in small_components(hub_links(match_sources(rows), "key"), "key", "hub").collect()}
    assert got == WANT
    assert match_sources(rows.limit(0)).count() == 0


def spell(r, word):
    i = r.randrange(1, len(word) - 1)
    return r.choice([word[:i] + word[i + 1 :], word[:i] + r.choice("aeioutrn") + word[i:], word[:i] + word[i + 1] + word[i] + word[i + 2 :]])


def cores(seed, n=60, k=4):
    r = random.Random(seed)
    out = []
    for _ in range(n):
        word = "".join(r.choice("bdfgklmnprstvz") + r.choice("aeiou") for _ in range(5))
        out += [word, *(spell(r, word) for _ in range(k))]
    return sorted(set(out))


def linked_cores(spark, names):
    d = typed(spark, [(i, n, "GA", None, None) for i, n in enumerate(names)])
    forms, _ = form_table(d, "key")
    core = {r.form: r.core for r in forms.collect()}
    got = {tuple(sorted((core[r.u], core[r.v]))) for r in spelling_pairs(forms).collect()}
    want = {(a, b) for i, a in enumerate(sorted(core.values())) for b in sorted(core.values())[i + 1 :] if core_close(a, b)}
    return got, want


@pytest.mark.parametrize("rest", [" General Valves", "", " Tormaline Widgetry"])
def test_spelling_recall_against_brute_force(spark, rest):
    """All pairs of a state, whether their names have generic words, none, or words that no vocabulary has."""
    got, want = linked_cores(spark, [w + rest for w in cores(1, n=100, k=6)])
    assert got <= want and len(got) >= 0.99 * len(want)


def test_band_curve():
    assert collision(SIMILARITY, ROWS, band_count(SIMILARITY, RECALL, ROWS)) >= RECALL > collision(SIMILARITY, ROWS, band_count(SIMILARITY, RECALL, ROWS) - 1)


def test_bands_collide_as_the_curve_says():
    r = random.Random(7)
    words = cores(3, n=300, k=2)
    grams = lambda w: {f"^{w}$"[i : i + 2] for i in range(len(w) + 1)}
    keys = dict(zip(words, band_keys(words, 50, ROWS)))
    pairs = [r.sample(words, 2) for _ in range(3000)] + list(zip(words, words[1:]))
    want = got = 0.0
    for a, b in pairs:
        s = len(grams(a) & grams(b)) / len(grams(a) | grams(b))
        want += s**ROWS
        got += (keys[a] == keys[b]).mean()
    assert abs(got - want) < 0.1 * want
    assert (band_keys(["", "é", "\ud800"], 3, 2) != band_keys(["", "é", "x"], 3, 2)).any(axis=1).tolist() == [False, False, True]


def test_hot_buckets_are_compared_whole(spark):
    base = "torvalidemuno"
    names = sorted({base[:i] + c + base[i + 1 :] for i in range(4, 9) for c in "bdfgklmprt"})
    got, want = linked_cores(spark, names)
    assert got <= want and len(got) >= 0.99 * len(want) > 500


def test_spelling_pairs_leave_only_their_result(spark):
    forms, _ = form_table(typed(spark, [(i, n, "GA", None, None) for i, n in enumerate(cores(2, n=5, k=4))]), "key")
    folder = Path(session.ensure_checkpoint_dir(spark).removeprefix("file:"))
    there = lambda: {p.name for p in folder.glob("settled-*")}
    before = there()
    got = spelling_pairs(forms)
    assert there() - before == {got._settled_path.rsplit("/", 1)[1]} and got.count() > 0


def test_match_sources_deletes_what_it_has_read(spark):
    rows = typed(spark, ROWS_).filter("key is not null").withColumn("side", (F.col("key") % 2).cast("int"))
    folder = Path(session.ensure_checkpoint_dir(spark).removeprefix("file:"))
    before = set(folder.glob("settled-*"))
    tags = match_sources(rows)
    left = [spark.read.parquet(str(p)).columns for p in set(folder.glob("settled-*")) - before]
    assert len(left) == 5 and not any(c == ["u", "v"] for c in left) and sum("vector" in c for c in left) == 1
    assert {r.record_id: r.group_id for r in small_components(hub_links(tags, "key"), "key", "hub").collect()} == WANT


def test_a_grown_heap_of_the_driver_is_collected_after_a_step(spark, monkeypatch):
    asked, heap = [], NS(totalMemory=lambda: 74, maxMemory=lambda: 100)
    driver = NS(sparkContext=NS(), _jvm=NS(System=NS(gc=lambda: asked.append(1)), java=NS(lang=NS(Runtime=NS(getRuntime=lambda: heap)))))
    session.tidy(driver)
    assert len(asked) == 1
    driver.sparkContext._tamarack_tidy_at += 60
    session.tidy(driver)  # not again at once
    driver.sparkContext._tamarack_tidy_at, heap.totalMemory = 0, lambda: 26
    session.tidy(driver)  # nor a small one
    assert len(asked) == 1
    monkeypatch.setattr(session, "tidy", asked.append)
    assert session.settle(spark.range(3)).count() == 3 and asked[1:] == [spark]


def test_vocabulary_is_learned(spark):
    r = random.Random(4)
    family = ["".join(r.choice("bdfgklmnprstvz") + r.choice("aeiou") for _ in range(4)) for _ in range(400)]
    names = [(f"{f.title()} {r.choice(['Nordic', 'Prime'])} {r.choice(['Widgets', 'Gaskets', 'Zippers'])} LLC",) for f in family]
    names += [(f"Prime {r.choice(['Widgets', 'Gaskets', 'Zippers'])} {f}",) for f in family[:90]]
    names += [(f"Smith {x}",) for x in ("Nordic", "Prime")] * 200 + [(None,), ("",)]
    d = spark.createDataFrame(names, "name string")
    assert learn_words(d, "name") == Vocabulary(("nordic", "prime"), ("gaskets", "widgets", "zippers"))
    assert learn_words(d.limit(0), "name") == Vocabulary() == learn_words(d.filter("name is null"), "name")


def test_star_cover(spark):
    nodes = spark.createDataFrame([(i, 1) for i in range(7)], "form bigint, weight bigint")
    edges = spark.createDataFrame([(0, 1), (0, 2), (0, 3), (3, 4), (5, 6)], "u bigint, v bigint")
    got = {(r.form, r.center) for r in star_clusters(nodes, edges).collect()}
    assert {(0, 0), (1, 0), (2, 0), (3, 0), (4, 4), (3, 4)} <= got and {(5, 5), (6, 5)} <= got


def test_hamming_is_exact(spark):
    r = random.Random(3)
    base = [r.getrandbits(64) for _ in range(40)]
    vectors = []
    for b in base:
        for flips in (0, 5, 12, RADIUS, RADIUS + 1, 25):
            v = b
            for bit in r.sample(range(64), flips):
                v ^= 1 << bit
            vectors.append(v)
    signed = [v - (1 << 64) if v >> 63 else v for v in vectors]
    d = spark.createDataFrame([(i, v, "m" if i % 2 else "n") for i, v in enumerate(signed)] + [(999, None, "m"), (998, 5, None)], "form bigint, vector bigint, block string")
    got = {(x.u, x.v, x.distance) for x in hamming_pairs(d.filter("form < 100"), d, ["block"]).collect()}
    dist = lambda a, b: (vectors[a] ^ vectors[b]).bit_count()
    assert got == {(a, b, dist(a, b)) for a in range(100) for b in range(len(vectors)) if a != b and a % 2 == b % 2 and dist(a, b) <= RADIUS}


def test_hamming_sends_rows_once_and_none_to_the_driver(spark, monkeypatch):
    monkeypatch.setattr(linkage, "DEALT", 7, raising=False)
    r = random.Random(5)
    rows = [(i, sum(1 << b for b in r.sample(range(63), 12)), "m" if i % 3 else "n", f"c{i}") for i in range(90)]
    d = session.settle(spark.createDataFrame(rows, "form bigint, vector bigint, block string, core string"))
    got = hamming_pairs(d.filter("form < 40"), d, ["block"], ["core"])
    far = lambda a, b: (a[1] ^ b[1]).bit_count()
    want = [(a[0], b[0], far(a, b), a[3], b[3]) for a in rows[:40] for b in rows if a[0] != b[0] and a[2] == b[2] and far(a, b) <= RADIUS]
    assert want and sorted(map(tuple, got.collect())) == sorted(want)  # each pair once, though blocks are dealt out
    plan = got._jdf.queryExecution().executedPlan().toString()
    pairs = plan[: plan.index("SortMergeJoin")]  # what is done with the pairs
    assert "BroadcastHashJoin" not in pairs and "Exchange" not in pairs and "HashAggregate" not in pairs


def test_letters_rule_out_no_close_cores(spark):
    r = random.Random(17)
    words = [*cores(6, n=25, k=3), *cores(7, n=5, k=8), "ab", "abc", "ac", "aab", "phil", "fil", "barn", "bam"]
    pairs = [(a, b, sound(a), sound(b), core_close(a, b)) for a in words for b in r.sample(words, 40) + [w for w in words if core_close(a, w)]]
    d = spark.createDataFrame(pairs, "a string, b string, x string, y string, close boolean")
    d = d.withColumns({n: linkage.letters(F.col(c)) for n, c in (("la", "a"), ("lb", "b"), ("ha", "x"), ("hb", "y"))})
    maybe = linkage.maybe_close("a", "b", "la", "lb", "ha", "hb")
    assert d.filter("close").filter(~maybe).count() == 0 and d.filter(maybe).count() < d.count() / 3


def test_vectors_and_calibration(spark):
    d = spark.createDataFrame([("truckdale", "truckdale"), ("truckdale", "trukdale"), ("truckdale", "zonmish"), (None, "a"), ("", "a")], "a string, b string")
    s = [r.s for r in d.select(dice(bit_vector(F.col("a")), bit_vector(F.col("b"))).alias("s")).collect()]
    assert s[0] == 1.0 and 0.7 < s[1] < 1.0 and s[2] < 0.7 and s[3] is None and s[4] is None
    c = spark.createDataFrame([(0.9, 1)] * 50 + [(0.1, 0)] * 50 + [(0.5, None)], "s double, y int")
    curve = calibrate(c, "s", "y")
    assert curve == sorted(curve) and curve[36] > 0.9 and curve[4] < 0.1


def test_two_edits_lie_within_the_radius(spark):
    r = random.Random(11)
    pairs = []
    for w in cores(9, n=400, k=0):
        x = spell(r, spell(r, w + r.choice(["ford", "", "el"])))
        pairs += [(sound(w), sound(x))] if core_close(w, x) else []
    d = spark.createDataFrame(pairs, "a string, b string")
    far = d.filter(F.bit_count(bit_vector(F.col("a")).bitwiseXOR(bit_vector(F.col("b")))) > RADIUS).count()
    assert len(pairs) > 100 and far <= 0.01 * len(pairs)


def test_confidence_is_of_the_score_it_is_fitted_on(spark):
    rows = [(0.95, 0.15, 0)] * 50 + [(0.15, 0.95, 1)] * 50 + [(0.95, 0.15, None), (0.95, None, None), (1.0, 1.0, None)]
    d = spark.createDataFrame(rows, "score double, blind double, truth int")
    got = with_confidence(d, "blind", "truth").filter("truth is null").select("score", "blind", "confidence").collect()
    by = {r.blind: r.confidence for r in got}
    assert by[0.15] < 0.1 and by[None] is None and by[1.0] > 0.9


def test_p6_confidence_rises_with_name_and_city(spark, monkeypatch):
    scored = []
    monkeypatch.setattr(linkage, "calibrate", lambda rows, score, truth: scored.append(score) or [b / 100 for b in range(linkage.BINS)])
    monkeypatch.setattr(linkage, "weighted_score", lambda sides: F.lit(0.99 if "domain" in sides else 0.01).cast("double"))
    got = {r.confidence for r in linkage.p6_matches(spark, "/root/testdata/sf0.001").select("confidence").distinct().collect()}
    assert scored == ["blind"] and got == {0.0}


def test_osa_brute_force():
    def slow(a, b):
        d = {(i, 0): i for i in range(len(a) + 1)} | {(0, j): j for j in range(len(b) + 1)}
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
                if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                    d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
        return d[len(a), len(b)]

    r = random.Random(2)
    for _ in range(400):
        a, b = ("".join(r.choice("abc") for _ in range(r.randrange(0, 8))) for _ in range(2))
        for most in (1, 2, 3):
            assert min(osa(a, b, most), most + 1) == min(slow(a, b), most + 1)


def test_parse_name_variants():
    parse = lexicon(("general", "precision"), ("castings", "extrusions")).parse

    def same_name(p, q):
        return (p.modifier, p.trade) == (q.modifier, q.trade) and core_close(p.core, q.core)

    want = parse("Lawrence Truckdale General Extrusions, Inc")
    for typed in ("Truckdale, Larry General Extr. Inc", "LAWRENCE TRUCKDALE (GENERAL EXTRUSIONS) LLC", "General Extrusions of Truckdale Corp", "Lawrence Truckdale Genl Extrusoins Co - Springfield", "The Lawrence Truckdale General Extrusions Inc d/b/a Truckdale"):
        assert same_name(want, parse(typed)), typed
    assert not same_name(want, parse("Lawrence Truckdale General Castings Inc"))
    assert not same_name(want, parse("Lawrence Truckdale Precision Extrusions Inc"))
    assert not same_name(want, parse("Lawrence Bellmont General Extrusions Inc"))
    assert parse("n/a") is None and parse(None) is None

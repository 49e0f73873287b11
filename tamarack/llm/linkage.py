"""Matching the records of two sources that share no identifier."""

from __future__ import annotations

from collections.abc import Sequence
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from ..functions.geo import city_key, state_code
from ..functions.web import own_domain
from ..session import release, settle
from .components import small_components
from .names import core_close, learn_words, name_struct
from .tables import payloads, platforms, table
from .variants import SHAPE, entity_tags, form_table, hub_links, maybe_alike

#: Bits of a vector, bits that each q-gram sets, and parts of a vector.
BITS, SETS, PARTS = 64, 1, 8
#: Within this distance two vectors surely agree in one part but for a bit: PARTS * 2 - 1.
RADIUS = PARTS * 2 - 1
#: Items of a block that one task compares with the block's queries.
DEALT = 2000
#: Bins of the score by which confidence is calibrated.
BINS = 40
#: Weights of the attributes in the score.
WEIGHTS = {"name": 0.6, "domain": 0.25, "city": 0.15}


def bit_vector(text: Column) -> Column:
    """A text's padded 2-grams as a vector of 64 bits in a bigint, each q-gram setting SETS of them; null for no text."""
    padded = F.concat(F.lit("^"), text, F.lit("$"))
    grams = F.transform(F.sequence(F.lit(1), F.length(padded) - 1), lambda i: F.substring(padded, i, F.lit(2)))

    def mask(gram: Column) -> Column:
        out = F.lit(0).cast("bigint")
        for k in range(SETS):
            out = out.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(F.xxhash64(gram, F.lit(k)), F.lit(BITS)).cast("int")))
        return out

    return F.when(F.length(text) > 0, F.aggregate(grams, F.lit(0).cast("bigint"), lambda acc, g: acc.bitwiseOR(mask(g))))


def letters(text: Column) -> Column:
    """For each letter a bit if a text has it, and one if it has it twice: an edit of one letter turns two bits at most, an exchange of neighbours none."""
    out = F.lit(0).cast("bigint")
    for i, c in enumerate("abcdefghijklmnopqrstuvwxyz"):
        for bit, holds in ((i, F.contains(text, F.lit(c))), (i + 26, F.substring_index(text, c, 2) != text)):
            out = out.bitwiseOR(F.when(holds, F.lit(1 << bit).cast("bigint")).otherwise(F.lit(0).cast("bigint")))
    return out


def maybe_close(a: str, b: str, letters_a: str, letters_b: str, heard_a: str, heard_b: str) -> Column:
    """False for cores that are surely not ``core_close``, by the ``letters`` of the cores and of their sounds alone."""
    apart = lambda x, y: F.bit_count(F.col(x).bitwiseXOR(F.col(y)))
    short = F.least(F.length(a), F.length(b))
    edits = F.when(short < 4, 0).when(short < 7, 1).when(short < 14, 2).otherwise(3)
    return (apart(heard_a, heard_b) <= 2) | (apart(letters_a, letters_b) <= 2 * edits)


def hamming_pairs(queries: DataFrame, items: DataFrame, block: Sequence[str], carry: Sequence[str] = ()) -> DataFrame:
    """All pairs (u, v, distance) of a query and an item of the same ``block`` values whose vectors differ in RADIUS bits at most.

    Both sides hold (form, vector), where forms are unique, and the block's columns; of the columns ``carry`` of both,
    u_x and v_x come with a pair.  A row is sent once, to its block, whose pairs are met there: with a sixth of all bits
    set, an index of the vectors' PARTS with a bit turned would meet most pairs of a block, many more than once, and
    copy each query 72 times.  The items of a block above DEALT are dealt out to parts, and the queries are copied to each.
    Exact: no pair within the radius is lost.  Nulls of a block are not equal to anything; rows without a vector find nothing.
    """
    some = lambda d: d.filter(F.col("vector").isNotNull()).select("form", "vector", *dict.fromkeys([*block, *carry]))
    queries, items = some(queries), some(items)
    # one row a block above DEALT: less than one for every DEALT items
    large = F.broadcast(items.groupBy(*block).agg(F.ceil(F.count("*") / DEALT).cast("int").alias("parts")).filter("parts > 1"))
    dealt = lambda d: d.join(large, list(block), "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    side = lambda n, x: [F.col("form").alias(n), F.col("vector").alias(x), *[F.col(c).alias(f"{n}_{c}") for c in carry]]
    asked = dealt(queries).select(*block, F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), *side("u", "x"))
    filed = dealt(items).select(*block, F.pmod(F.xxhash64("form"), F.col("parts")).cast("int").alias("part"), *side("v", "y"))
    distance = F.bit_count(F.col("x").bitwiseXOR(F.col("y")))
    met = asked.hint("merge").join(filed, [*block, "part"]).filter((distance <= RADIUS) & (F.col("u") != F.col("v")))
    return met.select("u", "v", distance.alias("distance"), *[f"{n}_{c}" for n in "uv" for c in carry])


def dice(a: Column, b: Column) -> Column:
    """Dice similarity of two bit vectors; null where one is missing."""
    return 2 * F.bit_count(a.bitwiseAND(b)) / (F.bit_count(a) + F.bit_count(b))


def weighted_score(sides: dict[str, tuple[Column, Column]]) -> Column:
    """Mean of the attributes' Dice similarities by WEIGHTS, over the attributes that both sides have; null if they share none."""
    parts = {n: dice(a, b) for n, (a, b) in sides.items()}
    total = sum((F.when(p.isNotNull(), WEIGHTS[n]).otherwise(0.0) for n, p in parts.items()), F.lit(0.0))
    value = sum((F.coalesce(p, F.lit(0.0)) * WEIGHTS[n] for n, p in parts.items()), F.lit(0.0))
    return F.when(total > 0, value / total)


def calibrate(scored: DataFrame, score: str, truth: str) -> list[float]:
    """Confidence by bin of the score: the smoothed share of true pairs of the bin, made to rise with the score.

    ``truth`` is 1 or 0 for pairs whose answer is known otherwise, null for others.  Only BINS rows come to the driver.
    """
    rows = scored.filter(F.col(truth).isNotNull()).groupBy(F.least(F.floor(F.col(score) * BINS), F.lit(BINS - 1)).alias("bin")).agg(F.sum(truth).alias("yes"), F.count("*").alias("n")).collect()
    have = {r.bin: (float(r.yes), float(r.n)) for r in rows}
    blocks: list[list[float]] = []  # pooled neighbours: yes, n, bins
    for b in range(BINS):
        yes, n = have.get(b, (0.0, 0.0))
        blocks.append([yes + (b + 0.5) / BINS, n + 1, 1])
        while len(blocks) > 1 and blocks[-2][0] / blocks[-2][1] > blocks[-1][0] / blocks[-1][1]:
            top = blocks.pop()
            blocks[-1] = [x + y for x, y in zip(blocks[-1], top)]
    return [yes / n for yes, n, k in blocks for _ in range(int(k))]


def with_confidence(scored: DataFrame, score: str, truth: str) -> DataFrame:
    """Pairs with the confidence of their score, by the curve of the same score; null where there is none."""
    curve = F.array(*[F.lit(x) for x in calibrate(scored.filter(F.col(score).isNotNull()), score, truth)])
    place = F.least(F.floor(F.col(score) * BINS), F.lit(BINS - 1)).cast("int")
    return scored.withColumn("confidence", F.when(F.col(score).isNotNull(), F.get(curve, place)))


def _spelled():
    @F.pandas_udf(BooleanType())
    def spelled(a: pd.Series, b: pd.Series) -> pd.Series:
        same = lru_cache(1 << 16)(core_close)
        return pd.Series([same(x, y) for x, y in zip(a, b)], dtype=bool)

    return spelled


def _records(spark: SparkSession, folder: str) -> DataFrame:
    """Both sources in one shape: (key, side, record_id, core, sound, modifier, trade, state, city, domain); side 0 is match_records.

    ``key`` numbers the records of both sides without clashes.  A record without a state has the one that most records
    with its domain have.
    """
    hosts = platforms(spark, folder)
    left = table(spark, folder, "match_records").select(F.col("id"), F.lit(0).alias("side"), "name", "domain", "state", "city")
    right = payloads(table(spark, folder, "raw_records"), "name", "website", "state", "city").select("id", F.lit(1).alias("side"), "name", F.col("website").alias("domain"), "state", "city")
    rows = left.unionByName(right).filter("id is not null")
    words = learn_words(left, "name")
    clean = rows.select((F.col("id") * 2 + F.col("side")).alias("key"), "side", F.col("id").alias("record_id"), name_struct(words)("name").alias("p"),
                        state_code(F.col("state")).alias("own"), city_key(F.col("city")).alias("city"), own_domain(F.col("domain"), hosts).alias("domain"))
    flat = settle(clean.select("key", "side", "record_id", "p.core", "p.sound", "p.modifier", "p.trade", "own", "city", "domain"))
    homes = flat.filter("own is not null and domain is not null").groupBy("domain", "own").count().groupBy("domain").agg(F.max_by("own", F.struct("count", "own")).alias("home"))
    return flat.join(homes, "domain", "left").withColumn("state", F.coalesce("own", "home")).drop("own", "home")


def match_sources(rows: DataFrame) -> DataFrame:
    """(key, tag) for records of two sides (see ``_records``): records with a tag in common are one organisation.

    Forms of names (core, modifier, trade, state) get bit vectors of their q-grams; forms of side 0 are compared with all
    forms of the same modifier, trade and state, and forms without a state with those of the same modifier and trade,
    by their Hamming distance.  Cores of close pairs are then compared letter by letter.  A record without a state
    is placed by its city, or where only one state has its name.  Web domains are exact: equal own domains are one tag.
    Null keys take no part, records with neither name nor domain get no tag, equal rows count once, further columns are
    ignored, and an empty table gives no tag.
    """
    rows = settle(rows.filter("key is not null").select("key", "side", *SHAPE))
    plain, held = form_table(rows, "key")
    forms = settle(plain.withColumns({"vector": bit_vector(F.col("sound")), "letters": letters(F.col("core")), "heard": letters(F.col("sound"))}))
    release(plain)
    # sizes of settled files say little of the rows in memory: such tables aren't sent to the driver
    asking = settle(forms.hint("merge").join(held.hint("merge").join(rows.filter("side = 0").select("key").distinct(), "key", "left_semi").select("form").distinct(), "form", "left_semi"))
    block = ["modifier", "trade"]
    placed = forms.filter("state is not null")
    both = ["core", "sound", "state", "letters", "heard"]
    inside = hamming_pairs(asking.filter("state is not null"), placed, [*block, "state"], both)
    outside = hamming_pairs(forms.filter("state is null"), asking.filter("state is not null"), block, both)
    lost = hamming_pairs(asking.filter("state is null"), forms, block, both)
    maybe = maybe_close("u_core", "v_core", "u_letters", "v_letters", "u_heard", "v_heard")
    exact = lambda pairs: pairs.filter(maybe).filter(maybe_alike("u_core", "v_core", "u_sound", "v_sound")).filter(_spelled()("u_core", "v_core"))
    same = settle(exact(inside).select("u", "v"))
    apart = settle(exact(outside.unionByName(lost)).select("u", "v", F.col("v_state").alias("at")))
    release(asking)
    near = apart.filter("at is not null").select("u", "v")
    equal = apart.filter("at is null").select("u", "v")
    # each asked form is the center of a star of its spellings; every form is a star of its own
    stars = forms.select("form", F.col("form").alias("center")).unionByName(same.select(F.col("v").alias("form"), F.col("u").alias("center"))).unionByName(equal.select(F.col("v").alias("form"), F.col("u").alias("center")))
    members = settle(stars.distinct())
    release(same)
    return entity_tags("key", rows, forms, held, members, near)


def p6_matches(spark: SparkSession, folder: str) -> DataFrame:
    """(match_record_id, raw_record_id, score, confidence) of the records that are one organisation.

    The score is the field-weighted Dice score of all fields, the confidence that of name and city alone, calibrated where
    both sides name a web domain: there equal domains are true and different ones are not.  It holds for pairs that are
    linked, and is null where neither name nor city can be compared.
    """
    rows = settle(_records(spark, folder))
    groups = small_components(hub_links(settle(match_sources(rows)), "key"), "key", "hub")
    named = settle(groups.select(F.col("record_id").alias("key"), "group_id").join(rows, "key"))
    facts = [F.col("record_id"), bit_vector(F.col("sound")).alias("name"), bit_vector(F.col("domain")).alias("domain"), bit_vector(F.col("city")).alias("city")]
    left, right = (named.filter(F.col("side") == s).select("group_id", F.struct(*facts).alias(n)) for s, n in ((0, "a"), (1, "b")))
    # a group holds a handful of match records; its raw records are on the other side of an equi-join
    pairs = left.join(right, "group_id")
    scored = settle(pairs.select(F.col("a.record_id").alias("match_record_id"), F.col("b.record_id").alias("raw_record_id"), weighted_score({n: (F.col(f"a.{n}"), F.col(f"b.{n}")) for n in WEIGHTS}).alias("score"),
                                 weighted_score({"name": (F.col("a.name"), F.col("b.name")), "city": (F.col("a.city"), F.col("b.city"))}).alias("blind"),
                                 F.when(F.col("a.domain").isNotNull() & F.col("b.domain").isNotNull(), (F.col("a.domain") == F.col("b.domain")).cast("int")).alias("truth")))
    return with_confidence(scored, "blind", "truth").select("match_record_id", "raw_record_id", F.round("score", 6).alias("score"), F.round("confidence", 6).alias("confidence"))


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    return p6_matches(spark, folder).select("match_record_id", "raw_record_id")

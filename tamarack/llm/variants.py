"""Linking the spellings of names that people typed."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from ..functions.geo import city_key, state_code
from ..functions.web import own_domain
from ..session import release, settle
from .components import small_components
from .names import core_close, jaro_winkler, learn_words, monge_elkan, name_struct
from .tables import payloads, platforms, table

#: Sharing of q-grams from which two spellings are to be found, the share of such pairs that bands must find, and the hashes of a band.
SIMILARITY, RECALL, ROWS = 0.45, 0.99, 2
#: Columns of rows that are matched.
SHAPE = ["core", "sound", "modifier", "trade", "state", "city", "domain"]
#: Monge-Elkan similarity of the parts of two names from which they are looked at letter by letter.
PARTS = 0.8


def band_count(similarity: float, recall: float, rows: int) -> int:
    """Bands that the collision curve 1 - (1 - s^rows)^bands needs to find pairs of the similarity with the recall."""
    return math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows))


def collision(similarity: float, rows: int, bands: int) -> float:
    return 1 - (1 - similarity**rows) ** bands


@F.pandas_udf(BooleanType())
def _spelling(a: pd.Series, b: pd.Series, words: pd.Series) -> pd.Series:
    """Whether cores a and b, with the same further words, are spellings of one name."""

    @lru_cache(1 << 16)
    def same(x: str, y: str, w: str) -> bool:
        rest = w.split()
        return core_close(x, y) and monge_elkan([x, *rest], [y, *rest], jaro_winkler) >= PARTS  # the cheaper test first

    return pd.Series([same(*sorted((x, y)), w) for x, y, w in zip(a, b, words)], dtype=bool)


_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def _mixed(x: np.ndarray) -> np.ndarray:
    """Well mixed bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def band_keys(texts: list[str], bands: int, rows: int) -> np.ndarray:
    """Keys (texts x bands) of the bands of MinHash signatures over padded 2-grams."""
    salts = _mixed(np.arange(1, bands * rows + 1, dtype=np.uint64))
    codes = np.frombuffer("".join(f"^{t}$" for t in texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    ends = np.cumsum([len(t) + 2 for t in texts])
    inside = np.ones(len(codes), dtype=bool)
    inside[ends - 1] = False  # a text's last sign begins no gram
    at = np.flatnonzero(inside)
    grams = _mixed((codes[at] << np.uint64(32)) | codes[at + 1])
    starts = np.concatenate(([0], ends[:-1])) - np.arange(len(texts))
    least = np.minimum.reduceat(_mixed(grams[:, None] ^ salts[None, :]), starts, axis=0).reshape(len(texts), bands, rows)
    key = _mixed(np.arange(bands, dtype=np.uint64))[None, :]
    for r in range(rows):
        key = _mixed(key ^ least[:, :, r])
    return key.view(np.int64)


def banded(forms: DataFrame, *block: str) -> DataFrame:
    """(band, form) of every form and band: MinHash over the padded 2-grams of ``sound``, within the values of ``block``."""
    bands = band_count(SIMILARITY, RECALL, ROWS)

    def file(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                keys = band_keys(part.column(1).to_pylist(), bands, ROWS).view(np.uint64)
                inside = part.column(2).to_numpy().view(np.uint64)
                band = _mixed(keys ^ inside[:, None]).view(np.int64).ravel()
                yield pa.record_batch([pa.array(band), pa.array(np.repeat(part.column(0).to_numpy(), bands))], names=["band", "form"])

    return forms.select("form", "sound", F.xxhash64(*block).alias("block")).mapInArrow(file, "band bigint, form bigint")


def maybe_alike(a: str, b: str, sound_a: str, sound_b: str) -> Column:
    """False for columns of cores that are surely no spellings of one name: an edit of neighbours that changed places is two edits here."""
    short = F.least(F.length(a), F.length(b))
    room = F.when(short < 4, 0).when(short < 7, 2).when(short < 14, 4).otherwise(6)
    return (F.levenshtein(a, b) <= room) | (F.levenshtein(sound_a, sound_b) <= 2)


def spelt_alike(pairs: DataFrame, forms: DataFrame) -> DataFrame:
    """Those of the pairs (u, v) of forms of the same words whose cores are spellings of one name; not of two forms that one key alone has."""
    side = lambda n, *more: forms.select(F.col("form").alias(n), F.col("core").alias(f"c{n}"), F.col("sound").alias(f"s{n}"), F.when(F.col("low") == F.col("high"), F.col("low")).alias(f"k{n}"), *more)
    both = pairs.join(side("u", F.concat_ws(" ", "modifier", "trade").alias("words")), "u").join(side("v"), "v")
    told = F.coalesce(F.col("ku") == F.col("kv"), F.lit(False))
    return both.filter(~told & maybe_alike("cu", "cv", "su", "sv")).filter(_spelling("cu", "cv", "words")).select("u", "v")


def spelling_pairs(forms: DataFrame) -> DataFrame:
    """Links (u, v) between forms of the same modifier, trade and state whose cores are spellings of one name.

    Forms that share a band bucket are compared, all of them: a bucket of two gives its pair as it is counted, larger ones
    are joined with themselves, where a hot one is split by Spark's skew join.  What one key alone has is one organisation
    without a comparison: blocks of one key are left out, and so are pairs of two forms that only the same key has.
    """
    block = ["modifier", "trade", "state"]
    held = F.min("low") < F.max("high")
    shared = forms.groupBy(*[F.coalesce(c, F.lit("")).alias(f"__{c}") for c in block]).agg(held.alias("several")).filter("several").drop("several")
    alone = forms.join(shared, [F.coalesce(forms[c], F.lit("")) == shared[f"__{c}"] for c in block], "left_semi")
    filed = settle(banded(alone, *block))
    buckets = settle(filed.groupBy("band").agg(F.count("*").alias("n"), F.min("form").alias("u"), F.max("form").alias("v")).filter("u < v"))
    several = settle(filed.join(buckets.filter("n > 2").select("band"), "band", "left_semi"))
    release(filed)
    joined = several.withColumnRenamed("form", "u").join(several.withColumnRenamed("form", "v"), "band").filter("u < v").select("u", "v")
    alike = settle(spelt_alike(buckets.filter("n = 2").select("u", "v").unionByName(joined).distinct(), forms))
    release(buckets, several)
    return alike


def star_clusters(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(form, center) of every node: star cover of the links (u, v).

    Nodes with most links, then weight, then smallest id come first: a node that is first among its open neighbours is a
    center, which closes it and its neighbours.  Rounds go on until no link joins two open nodes; open nodes that are left
    are centers too.  Every node belongs to each center it is linked to, so stars may overlap.
    """
    both = settle(edges.select(F.explode(F.array(F.struct(F.col("u").alias("a"), F.col("v").alias("b")), F.struct(F.col("v").alias("a"), F.col("u").alias("b")))).alias("e")).select("e.a", "e.b"))
    degree = both.groupBy(F.col("a").alias("form")).count()
    ranked = nodes.select("form", "weight").join(degree, "form", "left").select("form", F.struct(F.coalesce("count", F.lit(0)).alias("d"), F.col("weight").alias("w"), (-F.col("form")).alias("i")).alias("rank"))
    ra, rb = ranked.select(F.col("form").alias("a"), F.col("rank").alias("ra")), ranked.select(F.col("form").alias("b"), F.col("rank").alias("rb"))
    open_ = settle(both.join(ra, "a").join(rb, "b"))
    satellites: list[DataFrame] = []
    while open_.take(1):
        first = open_.groupBy("a", "ra").agg(F.max("rb").alias("best")).filter("ra > best").select(F.col("a").alias("form"))
        # a center and its open neighbours are closed
        closed = settle(open_.join(first.withColumnRenamed("form", "a"), "a", "left_semi").select(F.explode(F.array(F.struct(F.col("a").alias("form"), F.lit(True).alias("center")), F.struct(F.col("b").alias("form"), F.lit(False).alias("center")))).alias("x")).select("x.*").distinct())
        satellites.append(closed.filter("not center").select("form"))
        gone = closed.select("form").distinct()
        left = settle(open_.join(gone.withColumnRenamed("form", "a"), "a", "left_anti").join(gone.withColumnRenamed("form", "b"), "b", "left_anti"))
        release(open_)
        open_ = left
    out = nodes.select("form")
    for part in satellites:
        out = out.join(part, "form", "left_anti")
    centers = settle(out.select(F.col("form").alias("center")))
    spokes = both.join(centers, both.b == centers.center, "left_semi").select(F.col("a").alias("form"), F.col("b").alias("center"))
    return centers.select(F.col("center").alias("form"), "center").unionByName(spokes)


def form_table(rows: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Forms of rows (key, core, sound, modifier, trade, state): (distinct forms with their weight, lowest and highest key), and (key, form) of every row.

    Rows that have no core are none.  A null state is a form of its own, which ``spelling_pairs`` links to its equals only.
    """
    named = rows.filter("core is not null and core <> ''").withColumn("form", F.xxhash64("core", "modifier", "trade", F.coalesce("state", F.lit("?"))))
    forms = settle(named.groupBy("form", "core", "sound", "modifier", "trade", "state").agg(F.count("*").alias("weight"), F.min(key).alias("low"), F.max(key).alias("high")))
    return forms, named.select(key, "form")


def placeless_pairs(forms: DataFrame) -> DataFrame:
    """Links (u, v) from forms without a state, u, to forms of any state whose names are spellings of theirs."""
    lost = forms.filter("state is null")
    known = forms.filter("state is not null").join(lost.select("modifier", "trade").distinct(), ["modifier", "trade"], "left_semi")
    met = banded(lost, "modifier", "trade").withColumnRenamed("form", "u").join(banded(known, "modifier", "trade").withColumnRenamed("form", "v"), "band").select("u", "v").distinct()
    return spelt_alike(met, forms)


def placed(key: str, held: DataFrame, forms: DataFrame, cities: DataFrame, near: DataFrame) -> DataFrame:
    """Links (key, form) from rows whose place is not known to the state's form that they belong to.

    Of the forms that are spellings of the row's name, those count with whose rows it shares a city; if it shares none,
    all count if they are of one state, and none otherwise.  ``cities`` holds (key, city) of all rows, ``near`` the links
    (u, v) from forms without a state to the spellings of their names.
    """
    lost = held.join(near.select(F.col("u").alias("form"), F.col("v")), "form").select(F.col(key).alias("k"), F.col("v"))
    lost = lost.join(forms.select(F.col("form").alias("v"), "state"), "v")
    where = held.join(near.select(F.col("v").alias("form")).distinct(), "form", "left_semi").join(cities, key).select(F.col("form").alias("v"), "city").distinct()
    mine = cities.select(F.col(key).alias("k"), F.col("city")).distinct()
    shared = lost.join(mine, "k").join(where, ["v", "city"], "left_semi").select("k", "v").distinct().withColumn("shared", F.lit(True))
    judged = lost.join(shared, ["k", "v"], "left")
    facts = judged.groupBy("k").agg(F.count("shared").alias("n"), F.count_distinct("state").alias("states"))
    return judged.join(facts, "k").filter("shared or (n = 0 and states = 1)").select(F.col("k").alias(key), F.col("v").alias("form")).distinct()


def entity_tags(key: str, rows: DataFrame, forms: DataFrame, held: DataFrame, members: DataFrame, near: DataFrame) -> DataFrame:
    """(key, tag): keys with a tag in common are one organisation.

    Tags are the clusters of name forms in one state (``members``: form, center), web domains, and of names without a
    state the clusters they are ``placed`` in, or their own beside the city; or their own alone, if nothing with a state
    has their name and they give one city at most.
    """
    cities = rows.filter("city is not null").select(key, "city").distinct()
    found = settle(placed(key, held, forms, cities, near))  # a plan of its own: fewer exchanges at once
    lost = forms.filter("state is null").select("form")
    known = held.join(lost, "form", "left_anti").unionByName(found)
    tags = known.join(members, "form").select(key, F.col("center").cast("string").alias("tag"))
    alone = held.join(lost, "form", "left_semi").join(cities, key).join(members, "form").select(key, F.concat_ws("@", F.col("center").cast("string"), "city").alias("tag"))
    # names that only rows without a state have, and of one city at most
    nowhere = held.join(lost, "form", "left_semi").join(near.select(F.col("u").alias("form")).distinct(), "form", "left_anti").join(members, "form")
    narrow = nowhere.join(cities, key, "left").groupBy("center").agg(F.count_distinct("city").alias("n")).filter("n <= 1").select("center")
    loose = nowhere.join(narrow, "center", "left_semi").select(key, F.concat(F.col("center").cast("string"), F.lit("@")).alias("tag"))
    domains = rows.filter("domain is not null").select(key, F.concat(F.lit("d:"), F.col("domain")).alias("tag"))
    return tags.unionByName(alone).unionByName(loose).unionByName(domains).distinct()


def hub_links(tags: DataFrame, key: str) -> DataFrame:
    """Links (key, hub) from every key to the smallest key of each of its tags, a link for each tag; tags of one key give none."""
    hubs = tags.groupBy("tag").agg(F.min(key).alias("hub"), F.count("*").alias("n")).filter("n > 1")
    return tags.join(hubs, "tag").select(key, "hub").filter(F.col(key) != F.col("hub"))


def entity_links(rows: DataFrame, key: str) -> DataFrame:
    """Links (key, hub) between the keys that mean the same organisation.

    ``rows`` holds (key, core, sound, modifier, trade, state, city, domain), any number a key: each spelling of its name,
    each place and each web domain of its own.  Spellings are linked by MinHash bands over padded q-grams, verified by
    Monge-Elkan and letter by letter, and clustered by star clustering; keys of one cluster, or of one domain, are one
    organisation.  Keys without a name or domain, and null keys, are linked to nothing.  Equal rows count once, further
    columns are ignored, and an empty table gives no link.
    """
    rows = settle(rows.filter(F.col(key).isNotNull()).select(key, *SHAPE))
    forms, held = form_table(rows, key)
    members = settle(star_clusters(forms, spelling_pairs(forms)))
    near = settle(placeless_pairs(forms))
    return hub_links(settle(entity_tags(key, rows, forms, held, members, near)), key)


def _company_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Every name, place and domain that companies and the records behind them give."""
    hosts = platforms(spark, folder)
    stored = table(spark, folder, "companies").select(F.col("id").alias("company_id"), F.col("canonical_name").alias("name"), own_domain(F.col("domain"), hosts).alias("domain"),
                                                      state_code(F.col("state")).alias("state"), city_key(F.col("city")).alias("city"), F.lit(1).alias("stored"))
    assigned = table(spark, folder, "company_records").select("company_id", "raw_record_id")
    raw = payloads(table(spark, folder, "raw_records"), "name", "website", "state", "city")
    behind = raw.join(assigned.hint("shuffle_hash"), raw.id == assigned.raw_record_id).select("company_id", "name", own_domain(F.col("website"), hosts).alias("domain"),
                                                                        state_code(F.col("state")).alias("state"), city_key(F.col("city")).alias("city"), F.lit(0).alias("stored"))
    # a company's like names meet in one worker, which reads their words once; a hot company's rows are split
    together = stored.unionByName(behind).hint("rebalance", "company_id")
    words = learn_words(table(spark, folder, "companies"), "canonical_name")
    rows = settle(together.withColumn("parsed", name_struct(words)("name")))
    states = rows.filter("state is not null").groupBy("company_id", "state").agg(F.max("stored").alias("s"), F.count("*").alias("n")).groupBy("company_id").agg(F.max_by("state", F.struct("s", "n", "state")).alias("home"))
    return rows.join(states.hint("shuffle_hash"), "company_id", "left").select("company_id", "parsed.core", "parsed.sound", "parsed.modifier", "parsed.trade", F.col("home").alias("state"), "city", "domain")


def p4_groups(spark: SparkSession, folder: str) -> DataFrame:
    """(company_id, group_id) of every row of companies that shares its organisation with another row."""
    return small_components(entity_links(_company_rows(spark, folder), "company_id"), "company_id", "hub").withColumnRenamed("record_id", "company_id")


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    groups = settle(p4_groups(spark, folder))
    a, b = groups.select("group_id", F.col("company_id").alias("id_a")), groups.select("group_id", F.col("company_id").alias("id_b"))
    return a.join(b, "group_id").filter("id_a < id_b").select("id_a", "id_b")

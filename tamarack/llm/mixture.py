"""Mixtures of sources with given shares of tokens."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.values import source_label
from ..operators.running import running_total, uniform
from ..session import few_rows, settle
from .tables import table
from .tokens import token_count


@dataclass(frozen=True)
class Share:
    weight: float
    max_repeats: int


def _allocate(have: list[tuple[int, int]], wanted: float, most: int) -> tuple[int, float, float]:
    """Whole copies of every document, tokens wanted beyond them, and the factor of inclusion for those.

    ``have``: tokens by multiplicity of the text.  The probability of a further copy is factor / multiplicity, 1 at most.
    """
    tokens = sum(t for _, t in have)
    if tokens <= 0 or wanted <= 0:
        return 0, 0.0, 0.0
    whole = min(most, int(wanted // tokens))
    rest = wanted - whole * tokens if whole < most else 0.0
    low, high = 0.0, float(max(m for m, _ in have))
    for _ in range(100):
        f = (low + high) / 2
        low, high = (f, high) if sum(t * min(1.0, f / m) for m, t in have) < rest else (low, f)
    return whole, rest, high


def mix(documents: DataFrame, key: str, group: str, size: str, text_hash: str, shares: dict[str, Share], total: int, seed: str = "mix") -> DataFrame:
    """(key, source, size, copies) of the documents of a mixture of ``total`` tokens in which each source has its share.

    A source's every document is taken whole as often as fits its target (max_repeats at most); what is then missing is
    drawn without replacement by Pareto order sampling: documents are ranked by the odds of a random number divided by
    their inclusion odds, and the first are taken up to the document that brings the tokens closest to the target.
    Inclusion falls with the number of documents of the same text, so repeated texts don't crowd out others.  Documents
    of no listed (or a null) source, and documents without (or with null) tokens, are in no mixture; a source without
    documents falls short.  Documents with equal keys are drawn together, further columns are ignored, an empty table
    gives an empty mixture.
    Only tokens by source and multiplicity (at most the root of twice the documents a source) come to the driver.
    """
    spark = documents.sparkSession
    rows = documents.filter(F.col(group).isin(*shares) & (F.col(size) > 0)).select(key, group, size, text_hash)
    copies = rows.groupBy(group, text_hash).agg(F.count("*").alias("mult"), F.sum(size).alias("tokens"))
    table_ = copies.groupBy(group, "mult").agg(F.sum("tokens").alias("tokens")).collect()
    plan = []
    for name, share in shares.items():
        have = [(r.mult, r.tokens) for r in table_ if r[group] == name]
        whole, rest, factor = _allocate(have, share.weight * total, share.max_repeats)
        mean = min(0.999, max(0.001, rest / max(1, sum(t for _, t in have))))
        plan.append((name, whole, rest, factor, mean))
    plans = F.broadcast(spark.createDataFrame(plan, "__s string, whole int, rest double, factor double, mean double"))  # bounded: one row a source
    drawn = rows.join(copies.select(group, text_hash, "mult"), [group, text_hash]).join(plans, F.col(group) == F.col("__s"))
    p = F.least(F.lit(1.0), F.col("factor") / F.col("mult"))
    u = uniform(key, seed=seed)
    q = F.when(p >= 1, 0.0).when(p <= 0, 1e300).otherwise((u / (1 - u)) / (p / (1 - p)))
    x = q * F.col("mean") / (1 - F.col("mean"))  # spread evenly: u itself where p is the source's mean
    ordered = drawn.withColumn("__x", F.least(x / (1 + x), F.lit(1 - 2.0**-53)))
    summed = running_total(ordered, [group], "__x", [key], F.col(size), "__upto")
    extra = ((F.col("__upto") - F.col(size) / 2) < F.col("rest")).cast("int")
    return summed.withColumn("copies", F.col("whole") + extra).filter("copies > 0").select(key, group, size, "copies")


def mixture_report(mixed: DataFrame, documents: DataFrame, group: str, size: str, shares: dict[str, Share], total: int) -> DataFrame:
    """A row a source: its target and actual tokens, its share of what was drawn, the most copies of a document, and the tokens it falls short."""
    spark = mixed.sparkSession
    wanted = spark.createDataFrame([(n, s.weight, s.max_repeats, s.weight * total) for n, s in shares.items()], f"{group} string, target_weight double, max_repeats int, target_tokens double")
    there = documents.filter(F.col(group).isin(*shares)).groupBy(group).agg(F.sum(size).alias("available_tokens"), F.count("*").alias("documents"))
    got = mixed.groupBy(group).agg(F.sum(F.col(size) * F.col("copies")).alias("actual_tokens"), F.count("*").alias("documents_used"), F.max("copies").alias("most_copies"))
    out = wanted.join(there, group, "left").join(got, group, "left").fillna(0)
    drawn = out.agg(F.sum("actual_tokens").alias("__drawn"))  # one row
    shared = out.crossJoin(F.broadcast(drawn)).withColumn("actual_share", F.coalesce(F.try_divide("actual_tokens", "__drawn"), F.lit(0.0))).drop("__drawn")
    return shared.withColumn("shortfall_tokens", F.greatest(F.lit(0.0), F.col("target_tokens") - F.col("actual_tokens")))


def _sized(spark: SparkSession, folder: str) -> tuple[DataFrame, dict[str, Share], int]:
    rows = table(spark, folder, "documents").select("doc_id", source_label(F.col("source")).alias("source"), F.xxhash64("text").alias("text_hash"), token_count()("text").cast("bigint").alias("tokens"))
    sized = settle(rows)
    total = sized.agg(F.sum("tokens").alias("t")).first().t or 0
    targets = few_rows(table(spark, folder, "mix_targets"))
    return sized, {r.source: Share(r.target_weight, r.max_repeats) for r in targets}, total


def p8_mix(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, source, tokens, copies) of a mix as large as the corpus."""
    sized, shares, total = _sized(spark, folder)
    return mix(sized, "doc_id", "source", "tokens", "text_hash", shares, total)


def p8_report(spark: SparkSession, folder: str) -> DataFrame:
    """The mix's target and actual shares, source by source."""
    sized, shares, total = _sized(spark, folder)
    return mixture_report(mix(sized, "doc_id", "source", "tokens", "text_hash", shares, total), sized, "source", "tokens", shares, total)

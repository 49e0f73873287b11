"""An evaluation of scores against one split's labels: who is matched, where they disagree, when to refuse, and what is shown."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.evaluate import CUTS, LEAST_CLASS, average_precision, bootstrap, confusion, precision_at, roc_auc, wilson
from ..operators.running import numbered
from ..operators.sample import hash_split
from ..session import settle

# The share of unmatched labels above which nothing is computed, the least number behind a share, the report's columns and order.
MOST_UNMATCHED, FEW = 0.05, 10
REPORT = ["label_key", "company_name", "domain", "decision", "matched", "company_id", "score", "rank", "shortlisted", "excluded", "exclusion_rule", "confidence", "components", "reason", "disagreement"]
ORDER = ["false_negative", "false_positive", "excluded_positive", "unmatched", ""]


class EvaluationRefused(RuntimeError):
    """Why nothing was computed; no company's values."""


def split_labels(labels: DataFrame, assigned: DataFrame, split: str, share: float, seed: int) -> DataFrame:
    """The labels (key, ...) of one split: as ``assigned`` (key, split) says, by the hash rule for keys that it doesn't have."""
    if split not in ("dev", "test"):
        raise ValueError("a split is dev or test")
    held = hash_split(labels, "key", share, seed).withColumnRenamed("split", "__hashed").join(assigned.select("key", F.col("split").alias("__said")), "key", "left")
    return held.filter(F.coalesce("__said", "__hashed") == split).drop("__said", "__hashed")


def refuse_conflicts(labels: DataFrame) -> None:
    """Refuses labels (key, decision) that disagree within a key."""
    torn = labels.groupBy("key").agg(F.count_distinct("decision").alias("n")).filter("n > 1").count()
    if torn:
        raise EvaluationRefused(f"{torn} companies have labels that disagree")


def disagreement(positive: Column, matched: Column, excluded: Column, score: Column, threshold: float) -> Column:
    """unmatched, excluded_positive, false_negative, false_positive, or empty."""
    took = ~excluded & (score >= threshold)
    return F.when(~matched, "unmatched").when(positive & excluded, "excluded_positive").when(positive & ~took, "false_negative").when(~positive & took, "false_positive").otherwise("")


def report(labels: DataFrame, matches: DataFrame, scores: DataFrame, threshold: float) -> DataFrame:
    """A row a label with the report's columns: its company, score and rank among the matched ones, and where label and score disagree.

    ``labels`` holds (key, company_name, domain, decision), ``matches`` (label, company_id, how) with the keys as labels,
    ``scores`` what score() gives.
    """
    company = scores.select("company_id", "name", F.col("domain").alias("site"), "total", "excluded", "exclusion_rule", "confidence", "reason", F.to_json(F.struct("geography", "ownership", "sector", "size")).alias("components"))
    held = settle(labels.join(matches.select(F.col("label").alias("key"), "company_id", "how"), "key", "left").join(company, "company_id", "left"))
    matched, positive = F.col("total").isNotNull(), F.col("decision") == "pursue"
    places = numbered(held.filter(matched).select("key", "excluded", "total", "company_id"), [F.col("excluded"), F.desc("total"), F.col("company_id"), F.col("key")], "rank").select("key", "rank")
    yes = lambda c: F.when(c, "yes").otherwise("no")
    took = ~F.col("excluded") & (F.col("total") >= threshold)
    return held.join(places, "key", "left").select(
        F.col("key").alias("label_key"), F.when(matched, F.col("name")).otherwise(F.col("company_name")).alias("company_name"), F.when(matched, F.col("site")).otherwise(F.col("domain")).alias("domain"), "decision",
        F.when(matched, F.col("how")).otherwise("no").alias("matched"), F.when(matched, F.col("company_id")).alias("company_id"), F.col("total").alias("score"), "rank", F.when(matched, yes(took)).alias("shortlisted"),
        F.when(matched, yes(F.col("excluded"))).alias("excluded"), "exclusion_rule", "confidence", "components", "reason", disagreement(positive, matched, F.col("excluded"), F.col("total"), threshold).alias("disagreement"),
    )


def report_order() -> list[Column]:
    """The order in which a report is written: disagreements first, then by rank and key."""
    place = F.coalesce(*[F.when(F.col("disagreement") == d, i) for i, d in enumerate(ORDER)])
    return [place, F.col("rank").asc_nulls_last(), F.col("label_key")]


def matched_items(rows: DataFrame) -> DataFrame:
    """The items (id, score, positive, excluded, exclusion_rule) of a report's matched rows."""
    return rows.filter("score is not null").select(F.col("company_id").alias("id"), "score", (F.col("decision") == "pursue").alias("positive"), (F.col("excluded") == "yes").alias("excluded"), "exclusion_rule")


def refuse_unmatched(rows: DataFrame, most: float = MOST_UNMATCHED) -> None:
    """Refuses a report without labels, or of which too many match no scored company."""
    n, lost = rows.agg(F.count("*"), F.coalesce(F.sum((F.col("disagreement") == "unmatched").cast("int")), F.lit(0))).first()
    if not n:
        raise EvaluationRefused("the split has no labels")
    if lost > most * n:
        raise EvaluationRefused(f"{lost} of {n} labels ({100 * lost / n:.1f}%) match no scored company; the limit is {100 * most:g}%")


def excluded_positives(items: DataFrame) -> DataFrame:
    """(rule, positives): the positives that each exclusion rule takes away."""
    return items.filter("positive and excluded").groupBy(F.coalesce("exclusion_rule", F.lit("unknown")).alias("rule")).agg(F.count("*").alias("positives"))


def measures(items: DataFrame, threshold: float, seed: int, cuts: Sequence[int] = CUTS) -> dict:
    """All figures of an evaluation, a few numbers, for the driver; confidence bounds are None where a class is too small."""
    c = confusion(items, threshold)
    bounds = lambda k, n: wilson(F.col(k).cast("double"), n.cast("double"))
    one = c.select("*", bounds("tp", F.col("tp") + F.col("fp")).alias("precision_ci"), bounds("tp", F.col("tp") + F.col("fn")).alias("recall_ci")).first().asDict(recursive=True)
    at = precision_at(items, cuts).withColumn("positives", F.lit(one["tp"] + one["fn"]))
    at = at.select("*", bounds("hits", F.col("k")).alias("precision_ci"), bounds("hits", F.col("positives")).alias("recall_ci")).orderBy("k")
    small = min(one["tp"] + one["fn"], one["fp"] + one["tn"]) < LEAST_CLASS
    return one | {
        "n": one["tp"] + one["fp"] + one["fn"] + one["tn"], "positives": one["tp"] + one["fn"], "threshold": threshold, "seed": seed, "small": small,
        "average_precision": average_precision(items).first()[0], "roc_auc": roc_auc(items).first()[0], "gap": tuple(bootstrap(items, seed).first()),
        "at": [r.asDict(recursive=True) for r in at.collect()], "excluded_positives": {r.rule: r.positives for r in excluded_positives(items).orderBy("rule").collect()},
    }


def _figure(x: float | None) -> str:
    return "n/a" if x is None else f"{x:.2f}"


def _bounds(b) -> str:
    low, high = (b["low"], b["high"]) if isinstance(b, dict) else b or (None, None)
    return "[n/a]" if low is None else f"[{low:.2f}, {high:.2f}]"


def shown(m: dict) -> list[str]:
    """The figures as lines: no company's name, site or value; shares of fewer than FEW say so."""
    few = lambda n: " (small n)" if n < FEW else ""
    hint = " (small n)" if m["small"] else ""
    took = m["tp"] + m["fp"]
    lines = [f"average precision {_figure(m['average_precision'])}{hint}", f"ROC AUC {_figure(m['roc_auc'])}{hint}", f"score gap {_bounds(m['gap'])}{hint}"]
    for r in m["at"]:
        lines.append(f"precision@{r['k']} {_figure(r['precision'])} {_bounds(r['precision_ci'])} (hits={r['hits']}, n={r['k']}){few(r['k'])}")
        lines.append(f"recall@{r['k']} {_figure(r['recall'])} {_bounds(r['recall_ci'])} (hits={r['hits']}, n={m['positives']}){few(m['positives'])}")
    lines += [f"from {m['threshold']:g} on: TP={m['tp']} FP={m['fp']} FN={m['fn']} TN={m['tn']}", f"precision {_figure(m['precision'])} {_bounds(m['precision_ci'])}{few(took)}", f"recall {_figure(m['recall'])} {_bounds(m['recall_ci'])}{few(m['positives'])}", f"F1 {_figure(m['f1'])}{hint}"]
    rules = ", ".join(f"{rule} {n}" for rule, n in m["excluded_positives"].items())
    lines.append(f"positives that exclusion rules removed: {sum(m['excluded_positives'].values())}" + (f" ({rules})" if rules else ""))
    return lines


def evaluate(labels: DataFrame, matches: DataFrame, scores: DataFrame, threshold: float, seed: int) -> tuple[DataFrame, list[str]]:
    """(report, lines to show) of one split's labels; EvaluationRefused for labels that disagree, none, or too many without a company."""
    refuse_conflicts(labels)
    rows = settle(report(labels, matches, scores, threshold))
    refuse_unmatched(rows)
    items = settle(matched_items(rows))
    n = rows.count()
    lost = rows.filter("disagreement = 'unmatched'")
    positive = lost.filter("decision = 'pursue'").count()
    m = measures(items, threshold, seed)
    return rows, [f"labels: {n}; matched: {m['n']}; unmatched: {n - m['n']} ({positive} pursue)", *shown(m)]

"""Samples whose categories have given shares."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geo import state_code
from ..operators.running import running_total, uniform
from ..session import few_rows, release, settle
from .tables import table

#: The category of rows whose value has no target.
OTHER = "(other)"
#: Bins that a pass of the search for the last drawn key sends to the driver.
BINS = 4096


def first_naics3(codes):
    """First three digits of the first real code: digits with at most a label before and a flag after them, not all zeros; null if there is none."""
    digits = F.transform(codes, lambda c: F.regexp_extract(F.regexp_replace(c, "[\\s.-]+(?=\\d)", ""), "^\\D{0,8}(\\d{3,6})", 1))
    real = F.filter(digits, lambda d: (d != "") & ~d.rlike("^0+$"))
    return F.substring(F.get(real, 0), 1, 3)


def rake(cells: Mapping[tuple, float], targets: Sequence[Mapping[str, float]], rounds: int = 200, tolerance: float = 1e-9) -> dict[tuple, float]:
    """Weights of the cells of a contingency table, fitted in turn to each margin until all shares agree.

    ``cells`` counts rows by their categories, one for each margin; ``targets`` gives each margin's shares, of which what
    is left to 1 goes to the other categories in proportion to their rows.  Iterative proportional fitting: a cell of no
    rows stays empty, and a margin that no weights can meet is met as closely as fitting gets in ``rounds``.
    """
    weight = {c: float(n) for c, n in cells.items() if n > 0}
    total = sum(weight.values())
    for _ in range(rounds):
        worst = 0.0
        for m, shares in enumerate(targets):
            have: dict[str, float] = defaultdict(float)
            for c, w in weight.items():
                have[c[m]] += w
            listed = {k: v for k, v in shares.items() if have.get(k, 0) > 0}
            free = sum(w for k, w in have.items() if k not in shares)
            rest = max(0.0, 1 - sum(listed.values())) if free else 0.0
            scale = sum(listed.values()) + rest or 1.0
            for c in weight:
                if have[c[m]] <= 0:  # no room is left for the categories without target
                    continue
                want = (listed[c[m]] if c[m] in listed else rest * have[c[m]] / free) / scale * total
                f = want / have[c[m]]
                worst = max(worst, abs(f - 1))
                weight[c] *= f
        if worst < tolerance:
            break
    return {c: w / cells[c] for c, w in weight.items() if w > 0}


def half_up(x: float) -> int:
    return int(np.floor(x + 0.5 + 1e-9))


@dataclass(frozen=True)
class Margin:
    """Target shares and minimums of a column's categories; ``strict`` ones must be met, others only guide the weights."""

    column: str
    shares: Mapping[str, float]
    minimums: Mapping[str, int]
    strict: bool = True


def _quotas(size: int, drawn: dict[tuple, int], cells: dict[tuple, int], margins: Sequence[Margin]) -> dict[tuple, int]:
    """Rows to take of each cell: what the keys drew, repaired so that each category gets what it needs, as far as there are rows, and the size holds, unless the needs are more."""
    quota = {c: min(drawn.get(c, 0), n) for c, n in cells.items()}
    needs = [{k: max(m.minimums.get(k, 0), half_up(s * size)) for k, s in m.shares.items()} if m.strict else {} for m in margins]
    have = [defaultdict(int) for _ in margins]
    for c, q in quota.items():
        for m, h in enumerate(have):
            h[c[m]] += q

    def move(c: tuple, by: int) -> None:
        quota[c] += by
        for m, h in enumerate(have):
            h[c[m]] += by

    def room(c: tuple) -> int:  # rows that a cell can give without a category falling below its need
        return min([quota[c], *(have[m][c[m]] - needs[m].get(c[m], 0) for m in range(len(margins)))])

    for m, need in enumerate(needs):
        for k in sorted(need):
            for c in sorted((c for c in cells if c[m] == k), key=lambda c: (-(cells[c] - quota[c]), c)):
                if (lack := need[k] - have[m][k]) <= 0:
                    break
                move(c, min(lack, cells[c] - quota[c]))
    over = sum(quota.values()) - size
    while over > 0:
        c = max(quota, key=lambda c: (room(c), c))
        if room(c) <= 0:
            break  # the needs add up to more than the size
        move(c, -min(over, room(c)))
        over = sum(quota.values()) - size
    while over < 0:
        c = max(quota, key=lambda c: (OTHER in c, cells[c] - quota[c], c))
        if cells[c] <= quota[c]:
            c = max(quota, key=lambda c: (cells[c] - quota[c], c))
        move(c, min(-over, cells[c] - quota[c]))
        over = sum(quota.values()) - size
    return quota


def last_drawn(rows: DataFrame, value: str, size: int) -> float:
    """The ``size``-th smallest of a column of numbers in [0, 1]; infinity if there are fewer.

    Each pass counts the rows of BINS bins of what is left, and goes on in the bin in which the row lies, until that holds
    one value or is as narrow as numbers get: two passes for a million rows, never more than the bins at the driver.
    """
    low, high, before = 0.0, 1.0, 0
    while True:
        width = (high - low) / BINS
        bin_ = F.least(F.floor((F.col(value) - low) / width), F.lit(BINS - 1)).cast("int")
        inside = rows.filter(F.col(value).between(low, high)).groupBy(bin_.alias("bin")).agg(F.count("*").alias("n"), F.min(value).alias("least"), F.max(value).alias("most"))
        for r in sorted(inside.collect(), key=lambda r: r.bin):
            if before + r.n >= size:
                break
            before += r.n
        else:
            return float("inf")
        if r.least == r.most or before + r.n == size:
            return r.most
        if (r.least, r.most) == (low, high):  # no narrower
            return high
        low, high = r.least, r.most


def proportional_sample(rows: DataFrame, key: str, margins: Sequence[Margin], size: int, seed: str = "sample") -> DataFrame:
    """``size`` rows (key and the margins' columns) whose categories have the margins' shares, as far as there are rows.

    Weights come from raking the cells of all margins; a row's key is the exponential -ln(u)/weight of a number u hashed
    from ``key``, and the smallest keys are drawn.  Then each category of a strict margin gets the greater of its minimum
    and its share times the size, rounded half up, from the next keys of its cells, in exchange for the largest keys of
    cells with more than they need; if the needs are more than the size, the sample is larger.  Null categories and
    categories without target are OTHER.  Only counts of cells (product of the margins' targets plus one each) and of
    the bins of ``last_drawn`` come to the driver.  Rows with a null key are left out; of rows with equal keys any may be
    drawn.  An empty table gives an empty sample.
    """
    spark = rows.sparkSession
    columns = [f"__m{i}" for i in range(len(margins))]
    named = rows.filter(F.col(key).isNotNull())
    for c, m in zip(columns, margins):
        named = named.withColumn(c, F.when(F.col(m.column).isin(*m.shares), F.col(m.column)).otherwise(OTHER))
    named = settle(named.select(key, *columns))
    count = lambda d: {tuple(r[c] for c in columns): r["count"] for r in d.groupBy(*columns).count().collect()}  # noqa: E731  bounded: one row a cell
    cells = count(named)
    size = min(size, sum(cells.values()))
    if not size:
        return named.limit(0).select(key, *[F.col(c).alias(m.column) for c, m in zip(columns, margins)])
    shares = [m.shares if m.strict else _population(cells, i) for i, m in enumerate(margins)]
    weights = rake(cells, shares)
    table_ = lambda d, kind: F.broadcast(spark.createDataFrame([(*c, v) for c, v in d.items()], ", ".join(f"{c} string" for c in columns) + f", {kind}"))  # noqa: E731  bounded: one row a cell
    # 1 - u**(1/weight) orders the rows as -ln(u)/weight does, and lies in [0, 1]
    u = uniform(key, seed=seed)
    keyed = settle(named.join(table_(weights, "__w double"), columns, "left").withColumn("__u", u).withColumn("__x", F.when(F.col("__w") > 0, -F.expm1(F.log(F.greatest(u, F.lit(2.0**-54))) / F.col("__w"))).otherwise(1.0)))
    last = last_drawn(keyed, "__x", size)
    quota = _quotas(size, count(keyed.filter(F.col("__x") <= last)), cells, margins)
    # within a cell the order of the keys is that of u, the largest first
    ranked = running_total(keyed.withColumn("__v", 1 - F.col("__u") - F.lit(2.0**-53)), columns, "__v", [key], F.lit(1), "__rank")
    taken = settle(ranked.join(table_(quota, "__quota bigint"), columns).filter("__rank <= __quota").select(key, *columns))
    release(named, keyed)
    return taken.select(key, *[F.col(c).alias(m.column) for c, m in zip(columns, margins)])


def _population(cells: Mapping[tuple, int], margin: int) -> dict[str, float]:
    """The shares that the categories of a margin have among all rows."""
    have: dict[str, float] = defaultdict(float)
    for c, n in cells.items():
        have[c[margin]] += n
    return {k: n / sum(cells.values()) for k, n in have.items()}


def shortfalls(rows: DataFrame, margin: Margin, size: int, sample: DataFrame) -> DataFrame:
    """A report of one margin: each target category with what is needed, there and drawn, what the sample lacks, and its share of it."""
    spark = rows.sparkSession
    needs = [(k, float(s), int(margin.minimums.get(k, 0)), max(int(margin.minimums.get(k, 0)), half_up(s * size))) for k, s in margin.shares.items()]
    wanted = spark.createDataFrame(needs, "category string, target_share double, min_rows bigint, needed bigint")
    tally = lambda d, n: F.broadcast(d.filter(F.col(margin.column).isin(*margin.shares)).groupBy(F.col(margin.column).alias("category")).agg(F.count("*").alias(n)))  # noqa: E731  one row a target
    filled = wanted.join(tally(rows, "available"), "category", "left").join(tally(sample, "drawn"), "category", "left").fillna(0, ["available", "drawn"])
    return filled.withColumn("gap", F.greatest(F.lit(0), F.col("needed") - F.col("drawn"))).withColumn("actual_share", F.col("drawn") / F.lit(max(size, 1)))


def _companies(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "companies").select("id", state_code(F.col("state")).alias("state"), first_naics3(F.col("naics_codes")).alias("naics3"))


def _margins(spark: SparkSession, folder: str) -> dict[str, Margin]:
    targets: dict[str, Margin] = {}
    for r in sorted(few_rows(table(spark, folder, "sample_targets")), key=lambda r: (r.dimension, r.category)):
        m = targets.setdefault(r.dimension, Margin(r.dimension, {}, {}))
        m.shares[r.category], m.minimums[r.category] = r.target_share, r.min_rows
    return targets


def _samples(spark: SparkSession, folder: str) -> tuple[DataFrame, int, dict[str, tuple[Margin, DataFrame]]]:
    """A sample for each dimension: it has that one's target shares, and of the other dimensions those of all companies."""
    rows = settle(_companies(spark, folder))
    size = rows.count() // 4
    margins = _margins(spark, folder)
    guides = {d: Margin(m.column, m.shares, {}, strict=False) for d, m in margins.items()}
    return rows, size, {d: (m, proportional_sample(rows, "id", [m, *[g for e, g in guides.items() if e != d]], size, seed=d)) for d, m in margins.items()}


def _report(rows: DataFrame, size: int, samples: Mapping[str, tuple[Margin, DataFrame]]) -> DataFrame:
    parts = [shortfalls(rows, margin, size, sample).select(F.lit(d).alias("dimension"), "*") for d, (margin, sample) in samples.items()]
    return reduce(DataFrame.unionByName, parts)


def p2_report(spark: SparkSession, folder: str) -> DataFrame:
    """Each category of sample_targets with what its dimension's sample needs, has and lacks."""
    return _report(*_samples(spark, folder))


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """The categories of which the drawn samples lack rows."""
    return p2_report(spark, folder).filter("gap > 0").select("dimension", "category")


def p2_sample(spark: SparkSession, folder: str) -> DataFrame:
    """(dimension, company_id, category) of each dimension's sample."""
    parts = [sample.select(F.lit(d).alias("dimension"), F.col("id").alias("company_id"), F.col(margin.column).alias("category")) for d, (margin, sample) in _samples(spark, folder)[2].items()]
    return reduce(DataFrame.unionByName, parts)


def _joint(spark: SparkSession, folder: str) -> tuple[DataFrame, int, dict[str, Margin], DataFrame]:
    rows, margins = settle(_companies(spark, folder)), _margins(spark, folder)
    size = rows.count() // 4
    return rows, size, margins, proportional_sample(rows, "id", list(margins.values()), size, seed="joint")


def p2_joint_sample(spark: SparkSession, folder: str) -> DataFrame:
    """One sample raked to all dimensions at once: (company_id, and each dimension's category)."""
    return _joint(spark, folder)[3].withColumnRenamed("id", "company_id")


def p2_joint_report(spark: SparkSession, folder: str) -> DataFrame:
    """As p2_report, for the one sample raked to all dimensions at once."""
    rows, size, margins, sample = _joint(spark, folder)
    return _report(rows, size, {d: (m, sample) for d, m in margins.items()})

"""One surviving record for each group of records about the same thing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.values import head_count, real_text, source_label
from ..functions.web import own_domain
from ..session import settle
from .tables import payloads, platforms, table


def survivors(records: DataFrame, group: str, record: str, fields: Mapping[str, Column], trust: Column, recency: Column) -> DataFrame:
    """The surviving value of each field of each group: (group, field_name, record, source, value).

    ``fields`` gives each field's cleaned value, null where the record has none; only values compete.  They are ranked by
    ``trust`` (smallest first, null last), ``recency`` (latest first, null last) and the record's id.  The rank filter is
    row_number() = 1, which Spark applies before the shuffle too (WindowGroupLimit), so that of a hot group each map
    task passes on one row a field.  Groups or records that are null take no part; a field nobody has gives no row;
    repeated rows give the same result as one; an empty table gives none.  Columns beside those named are ignored, and
    may have any name.
    """
    long = (
        records.select(F.col(group).alias("__g"), F.col(record).alias("__r"), F.col("source").alias("__s"), trust.alias("__t"), recency.alias("__w"),
                       F.explode(F.array(*[F.struct(F.lit(k).alias("field_name"), v.cast("string").alias("value")) for k, v in fields.items()])).alias("__f"))
        .filter("__g is not null and __r is not null and __f.value is not null")
        .select("__g", "__r", "__s", "__t", "__w", "__f.field_name", "__f.value")
    )
    order = Window.partitionBy("__g", "field_name").orderBy(F.col("__t").asc_nulls_last(), F.col("__w").desc_nulls_last(), "__r")
    best = long.withColumn("__n", F.row_number().over(order)).filter("__n = 1")
    return best.select(F.col("__g").alias(group), "field_name", F.col("__r").alias(record), F.col("__s").alias("source"), "value")


def best_record(records: DataFrame, group: str, record: str, fields: Sequence[str], trust: Column, recency: Column) -> DataFrame:
    """The one record of each group that has most of ``fields``, then the most trusted, the latest and the smallest id.

    Gives (group, record, completeness).  Null groups and records take no part.
    """
    filled = sum((F.col(f).isNotNull().cast("int") for f in fields), F.lit(0))
    rows = records.filter(F.col(group).isNotNull() & F.col(record).isNotNull()).select(group, record, filled.alias("completeness"), trust.alias("__t"), recency.alias("__w"))
    order = Window.partitionBy(group).orderBy(F.desc("completeness"), F.col("__t").asc_nulls_last(), F.col("__w").desc_nulls_last(), record)
    return rows.withColumn("__n", F.row_number().over(order)).filter("__n = 1").select(group, record, "completeness")


def _grouped(spark: SparkSession, folder: str) -> DataFrame:
    """The raw records of companies with two or more of them, cleaned."""
    assigned = table(spark, folder, "company_records").select("raw_record_id", "company_id").filter("raw_record_id is not null and company_id is not null").distinct()
    several = assigned.groupBy("company_id").count().filter("count >= 2").select("company_id")
    assigned = assigned.join(several, "company_id", "left_semi")
    trust = table(spark, folder, "source_priority").select(source_label(F.col("source")).alias("__source"), F.col("priority").alias("trust"))
    trust = trust.groupBy("__source").agg(F.min("trust").alias("trust"))
    raw = payloads(table(spark, folder, "raw_records"), "name", "website", "employees")
    rows = raw.join(assigned, raw.id == assigned.raw_record_id)
    rows = rows.join(trust, source_label(rows.source) == trust["__source"], "left")
    hosts = platforms(spark, folder)
    return rows.select("company_id", "raw_record_id", "source", "ingested_at", "trust", real_text(F.col("name")).alias("canonical_name"),
                       own_domain(F.col("website"), hosts).alias("domain"), head_count(F.col("employees")).alias("employee_count"))


def _fields() -> dict[str, Column]:
    return {f: F.col(f) for f in ("canonical_name", "domain", "employee_count")}


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    rows = _grouped(spark, folder)
    return survivors(rows, "company_id", "raw_record_id", _fields(), F.col("trust"), F.col("ingested_at")).select("company_id", "field_name", "raw_record_id")


def p1_survivors(spark: SparkSession, folder: str) -> DataFrame:
    """One built record a company, each value with the raw record and the source it came from, and the best single record beside it."""
    rows = settle(_grouped(spark, folder))
    kept = survivors(rows, "company_id", "raw_record_id", _fields(), F.col("trust"), F.col("ingested_at"))
    pick = lambda f, c: F.max(F.when(F.col("field_name") == f, F.col(c)))
    built = kept.groupBy("company_id").agg(
        pick("canonical_name", "value").alias("canonical_name"), pick("canonical_name", "raw_record_id").alias("name_record_id"), pick("canonical_name", "source").alias("name_source"),
        pick("domain", "value").alias("domain"), pick("domain", "raw_record_id").alias("domain_record_id"), pick("domain", "source").alias("domain_source"),
        pick("employee_count", "value").cast("bigint").alias("employee_count"), pick("employee_count", "raw_record_id").alias("employee_count_record_id"),
        pick("employee_count", "source").alias("employee_count_source"),
    )
    best = best_record(rows, "company_id", "raw_record_id", list(_fields()), F.col("trust"), F.col("ingested_at"))
    return best.withColumnRenamed("raw_record_id", "best_record_id").join(built, "company_id", "left")

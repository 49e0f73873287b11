"""The queries of this package and, where SQL can say the same on whole tables, that SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import components, linkage, mixture, pii, representative, sampling, splits, tokens, variants
from .oracle import ORACLE

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p1_found": representative.p1_found,
    "p1_survivors": representative.p1_survivors,
    "p2_found": sampling.p2_found,
    "p2_report": sampling.p2_report,
    "p2_sample": sampling.p2_sample,
    "p2_joint_sample": sampling.p2_joint_sample,
    "p2_joint_report": sampling.p2_joint_report,
    "p3_found": splits.p3_found,
    "p3_splits": splits.p3_splits,
    "p3_report": splits.p3_report,
    "p4_found": variants.p4_found,
    "p4_groups": variants.p4_groups,
    "p5_found": components.p5_found,
    "p5_against_companies": components.p5_against_companies,
    "p6_found": linkage.p6_found,
    "p6_matches": linkage.p6_matches,
    "p7_ids": tokens.p7_ids,
    "p7_vocabulary_use": tokens.p7_vocabulary_use,
    "p8_mix": mixture.p8_mix,
    "p8_report": mixture.p8_report,
    "p9_found": pii.p9_found,
    "p9_redacted": pii.p9_redacted,
}

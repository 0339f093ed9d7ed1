"""Findability / access / interoperability / reuse audit (§2.7, A20, U3).

A ``submissions`` table (one row per dataset) is exploded against the fixed
15-rule table, so one job audits every dataset; scores are grouped counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool import fixed

M = fixed.AUDIT_MARKERS


def _has(xml: Column, marker: str) -> Column:
    return F.coalesce(xml.contains(marker), F.lit(False))


def rule_results(sub: DataFrame, key: str) -> DataFrame:
    """One row per (dataset, rule): ``rule_id, letter, name, passed, description``.

    ``sub`` columns: ``doi, license_name, xml_text, xml_bytes, dirs
    (array<string>), processed_exts (array<string>), provenance_bytes``.
    """
    xml = F.col("xml_text")
    tests = {
        "F1": F.coalesce(F.col("doi"), F.lit("")).isin("", fixed.PENDING_DOI) == F.lit(False),
        "F2": xml.isNotNull(),
        "F3": _has(xml, M["identifier"]),
        "F4": F.size(F.array_except(F.array(*[F.lit(d) for d in fixed.PACKAGE_DIRS]),
                                    F.coalesce(F.col("dirs"), F.array().cast("array<string>")))) == 0,
        "A1": _has(xml, M["distribution"]),
        "A1.1": F.lit(True),
        "A1.2": _has(xml, M["constraints"]),
        "A2": xml.isNotNull() & (F.coalesce(F.col("xml_bytes"), F.lit(0)) > fixed.STANDALONE_METADATA_MIN_BYTES),
        "I1": F.coalesce(F.arrays_overlap(F.col("processed_exts"),
                                          F.array(*[F.lit(e) for e in fixed.STANDARD_EXTENSIONS])), F.lit(False)),
        "I2": _has(xml, M["keywords"]),
        "I3": _has(xml, M["citation"]),
        "R1": _has(xml, M["rich"][0]) & _has(xml, M["rich"][1]) & _has(xml, M["rich"][2]) & _has(xml, M["rich"][3]),
        "R1.1": F.coalesce(F.col("license_name"), F.lit("")) != "",
        "R1.2": F.coalesce(F.col("provenance_bytes"), F.lit(0)) > 0,
        "R1.3": _has(xml, M["standard"]),
    }
    rules = F.array(*[
        F.struct(F.lit(rid).alias("rule_id"), F.lit(letter).alias("letter"), F.lit(name).alias("name"),
                 F.coalesce(tests[rid], F.lit(False)).alias("passed"), F.lit(desc).alias("description"))
        for rid, letter, name, desc in fixed.AUDIT_RULES
    ])
    return sub.select(key, F.explode(rules).alias("r")).select(key, "r.*")


def score(results: DataFrame, keys: list[str]) -> DataFrame:
    """Passed / total per group, with the failed rule ids in rule order."""
    return results.groupBy(*keys).agg(
        F.count_if("passed").alias("passed"),
        F.count(F.lit(1)).alias("total"),
        F.array_join(F.sort_array(F.collect_list(F.when(~F.col("passed"), F.col("rule_id")))), ",").alias("failed_rules"),
    )

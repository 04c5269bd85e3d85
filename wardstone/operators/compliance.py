"""Layers, tiers and compliance references of findings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardstone.operators import findings, redact, screen
from wardstone.operators.quota import tier_table
from wardstone.operators.verdict import normalise_threat, with_threat_details
from wardstone.sources import fixed_values as fixed
from wardstone.sources.rules import Rule
from wardstone.sources.tables import fixed_table, lookup

# How a reference starts, per framework (fixed values).
FRAMEWORK_PREFIXES = [
    ("GDPR", "GDPR"), ("HIPAA", "HIPAA"), ("ISO 27001", "ISO"), ("SOC 2", "SOC2"), ("NIST", "NIST"),
    ("PCI-DSS", "PCI-DSS"), ("WebMCP", "WebMCP"),
]


def cascade(df: DataFrame, text_col: str, rules: list[Rule], enough: float, out_col: str = "decided_by") -> DataFrame:
    """Cheap layer first: texts that rules decide with enough confidence skip the detectors.

    Undecided texts alone reach the detectors; decided ones give them a null text.
    """
    df = screen.apply_rules(df, text_col, rules, "rule_findings")
    decided = findings.max_confidence(F.col("rule_findings")) >= enough
    df = df.withColumn("__undecided", F.when(~decided, F.col(text_col)))
    df = redact.find_spans(df, "__undecided", "spans")
    layer = F.when(F.col("__undecided").isNull(), "rules").when(F.size("spans") > 0, "personal_data").otherwise("none")
    return df.withColumn(out_col, layer).drop("__undecided")


def within_tier(found: DataFrame, tier: str, layer: str) -> DataFrame:
    """Findings of the layers that a tier has."""
    tiers = tier_table(found.sparkSession).select(F.col("tier").alias(tier), "deepest_layer")
    return lookup(found, tiers, tier, "inner").filter(F.col(layer) <= F.col("deepest_layer")).drop("deepest_layer")


def framework_counts(found: DataFrame, type_col: str) -> DataFrame:
    """Findings per framework and threat type; frameworks without any are listed with 0.

    Findings are counted per type first, so references are only taken of the 18 types.
    """
    spark = found.sparkSession
    typed = normalise_threat(found.withColumnRenamed(type_col, "__raw"), "__raw")
    counts = with_threat_details(typed.groupBy("threat_type").agg(F.count(F.lit(1)).alias("n")))
    # The first reference is the OWASP category, which is no framework.
    refs = counts.select("threat_type", "n", F.explode(F.slice("framework_references", F.lit(2), F.size("framework_references"))).alias("ref"))
    name = F.col("ref")
    for framework, prefix in FRAMEWORK_PREFIXES:
        name = F.when(F.col("ref").startswith(prefix), framework).otherwise(name)
    tagged = refs.select(name.alias("framework"), "threat_type", "n").groupBy("framework", "threat_type").agg(F.sum("n").alias("n"))
    frameworks = fixed_table(spark, ["framework"], [(f,) for f in fixed.FRAMEWORKS])
    return frameworks.join(tagged, "framework", "left").select(
        "framework", F.coalesce("threat_type", F.lit("")).alias("threat_type"), F.coalesce("n", F.lit(0)).alias("n")
    )

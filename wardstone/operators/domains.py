"""Domain screening against the host, ending and word lists, and search escalation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardstone.functions.mapping import confidence_or_half, severity_action, threat_level
from wardstone.functions.text import contains_any
from wardstone.operators.findings import any_severity, finding
from wardstone.sources import fixed_values as fixed


def ends_with_any(col: Column, endings: list[str]) -> Column:
    found = F.lit(False)
    for e in endings:
        found = found | col.endswith(e)
    return found


def domain_findings(
    domains: Column, blocked: list[str] = fixed.BLOCKED_HOSTS, tlds: list[str] = fixed.SUSPICIOUS_TLDS,
    words: list[str] = fixed.SUSPICIOUS_WORDS,
) -> Column:
    """At most one finding per domain and list, in the order of the domains.

    Hosts and words match anywhere in the lower-cased domain, endings only at its end. The lists
    are short and known, so they are plain predicates on the row: no join.
    """

    def tests(domain: Column) -> Column:
        low = F.lower(domain)

        def issue(test: Column, type: str, severity: str, label: str) -> Column:
            text = F.concat(F.lit(label), domain)
            return F.when(test, finding(type, severity, 0.85, "flag", "domain_lists", text, None, None, domain))

        return F.array_compact(
            F.array(
                issue(contains_any(low, blocked), "blocked_domain", "high", "Blocked domain: "),
                issue(ends_with_any(low, tlds), "suspicious_tld", "medium", "Suspicious TLD in domain: "),
                issue(contains_any(low, words), "suspicious_domain", "high", "Suspicious keyword in domain: "),
            )
        )

    return F.flatten(F.transform(F.coalesce(domains, F.array().cast("array<string>")), tests))


def escalate(df: DataFrame) -> DataFrame:
    """Search result from its findings and the query's own answer (safe, severity, confidence).

    Findings raise level, action and confidence; the result is safe only without any.
    """
    found = F.col("findings")
    base_level = threat_level("severity")
    base_action = F.when(F.coalesce(F.col("safe"), F.lit(False)), "allow").otherwise(severity_action("severity"))
    base = confidence_or_half("confidence")
    critical, high, medium = (any_severity(found, s) for s in ("critical", "high", "medium"))
    lift = medium & (base_level == "none")
    return df.withColumns(
        {
            "threat_level": F.when(critical, "critical")
            .when(high, F.when(base_level == "none", "high").otherwise(base_level))
            .when(lift, "medium")
            .otherwise(base_level),
            "action": F.when(critical | high, "block").when(lift, "flag").otherwise(base_action),
            "confidence": F.when(critical, F.greatest(base, F.lit(0.95)))
            .when(high, F.greatest(base, F.lit(0.85)))
            .when(lift, F.greatest(base, F.lit(0.7)))
            .otherwise(base),
            "safe": F.coalesce(F.col("safe"), F.lit(False)) & (F.size(found) == 0),
        }
    )

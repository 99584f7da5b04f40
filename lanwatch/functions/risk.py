"""Risk formulas as column expressions (R1–R5).  No UDF: every step is a
built-in expression, so a risk assessment stays inside whole-stage codegen.

Findings arrive as two maps: ``flags`` (name -> boolean, full weight when
true) and ``confidence`` (name -> number, weight x clamp(value, 0, 1) when
positive).  A name present in ``flags`` is never read from ``confidence``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import AGREEMENT_BONUS, ML_SHARE, RULE_SHARE, RULE_WEIGHTS, TRUSTED_FACTOR

# Explanation texts.
EXPLAIN_RULES = "Rule findings: "
EXPLAIN_ML_FLAG = "ML model marked the traffic window anomalous"
EXPLAIN_ML_SCORE = "ML anomaly score=%.4f"
EXPLAIN_TRUSTED = "Trusted-device adjustment applied"
EXPLAIN_NONE = "No significant detection evidence"


def clamp(x: Column, lo: float = 0.0, hi: float = 100.0) -> Column:
    return F.greatest(F.lit(lo), F.least(F.lit(hi), x))


def _flag(flags: Column, name: str) -> Column:
    return F.element_at(flags, F.lit(name))


def rule_terms(flags: Column, confidence: Column):
    """Per finding: (contribution, active label or null), in weight order."""
    out = []
    for name, weight in RULE_WEIGHTS.items():
        f = _flag(flags, name)
        c = F.element_at(confidence, F.lit(name)).cast("double")
        use_flag = f.isNotNull()
        contrib = (F.when(use_flag, F.when(f, F.lit(float(weight))).otherwise(F.lit(0.0)))
                   .when(c > 0, F.lit(float(weight)) * clamp(c, 0.0, 1.0))
                   .otherwise(F.lit(0.0)))
        label = (F.when(use_flag, F.when(f, F.lit(name)))
                 .when(c > 0, F.format_string(f"{name}=%.2f", c)))
        out.append((contrib, label))
    return out


def rule_score(flags: Column, confidence: Column) -> tuple[Column, Column]:
    """(score clamped to 0–100, array of active findings in weight order)."""
    terms = rule_terms(flags, confidence)
    score = clamp(sum((t[0] for t in terms[1:]), terms[0][0]))
    active = F.filter(F.array(*[t[1] for t in terms]), lambda x: x.isNotNull())
    return score, active


def ml_risk_score(anomaly_score: Column, is_anomaly: Column,
                  normal_reference: float = 0.0, critical_reference: float = -0.5) -> Column:
    """R2: isolation-forest decision value -> 0–100."""
    span = max(0.0001, normal_reference - critical_reference)
    flagged = F.coalesce(is_anomaly, F.lit(False))
    raw = (F.lit(normal_reference) - anomaly_score.cast("double")) / F.lit(span) * F.lit(100.0)
    raw = F.when(flagged, F.greatest(raw, F.lit(50.0))).otherwise(raw)
    return (F.when(anomaly_score.isNull(), F.when(flagged, F.lit(100.0)).otherwise(F.lit(0.0)))
            .when((anomaly_score >= F.lit(normal_reference)) & ~flagged, F.lit(0.0))
            .otherwise(clamp(raw)))


def risk_level(score: Column) -> Column:
    """On the unrounded combined score."""
    return (F.when(score < 25, "LOW").when(score < 50, "MEDIUM")
            .when(score < 75, "HIGH").otherwise("CRITICAL"))


def assess(flags: Column, confidence: Column, anomaly_score: Column, is_anomaly: Column,
           trusted: Column, normal_reference: float = 0.0, critical_reference: float = -0.5) -> Column:
    """One struct with score, level, rule_score, ml_score, rule_findings,
    ml_anomaly, explanation."""
    flags = F.coalesce(flags, F.create_map().cast("map<string,boolean>"))
    confidence = F.coalesce(confidence, F.create_map().cast("map<string,double>"))
    flagged = F.coalesce(is_anomaly, F.lit(False))
    trusted = F.coalesce(trusted, F.lit(False))
    r_score, active = rule_score(flags, confidence)
    # each term stands once in the score and the text, so that no label is formatted again for every branch
    labels = [t[1] for t in rule_terms(flags, confidence)]
    any_active = F.coalesce(*labels).isNotNull()
    m_score = ml_risk_score(anomaly_score, flagged, normal_reference, critical_reference)
    bonus = F.when(flagged & any_active, F.lit(float(AGREEMENT_BONUS))).otherwise(F.lit(0.0))
    factor = F.when(trusted, F.lit(float(TRUSTED_FACTOR))).otherwise(F.lit(1.0))
    combined = clamp((F.lit(RULE_SHARE) * r_score + F.lit(ML_SHARE) * m_score + bonus) * factor)
    # concat_ws leaves out nulls
    explanation = F.concat_ws(
        "; ",
        F.when(any_active, F.concat(F.lit(EXPLAIN_RULES), F.concat_ws(", ", *labels))),
        F.when(flagged, F.lit(EXPLAIN_ML_FLAG))
         .when(anomaly_score.isNotNull(), F.format_string(EXPLAIN_ML_SCORE, anomaly_score.cast("double"))),
        F.when(trusted, F.lit(EXPLAIN_TRUSTED)),
        F.when(~any_active & ~flagged & anomaly_score.isNull() & ~trusted, F.lit(EXPLAIN_NONE)))
    return F.struct(
        F.round(combined, 2).alias("score"),
        risk_level(combined).alias("level"),
        F.round(r_score, 2).alias("rule_score"),
        F.round(m_score, 2).alias("ml_score"),
        active.alias("rule_findings"),
        flagged.alias("ml_anomaly"),
        explanation.alias("explanation"),
    )

"""Risk scores, ladders and named rules as plain column expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerflow import fixed


def ladder(c: Column, steps: list[tuple[float, str]], last: str, strict: bool = False) -> Column:
    """First step whose bound holds the value; `last` also takes NULL."""
    out = None
    for bound, label in steps:
        hit = c < bound if strict else c <= bound
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out.otherwise(last)


# --- score between 0 and 1 -------------------------------------------------
def enhanced_fraud_score(
    aml: Column,
    usd: Column,
    from_country: Column,
    to_country: Column,
    sender_kyc: Column,
    receiver_kyc: Column,
    tiered: bool = False,
) -> Column:
    """AML score plus surcharges, capped at 1.

    Large amounts add 0.1 whatever their size; with `tiered` amounts over 100,000 add 0.2.
    A KYC level of 0 or NULL counts as unknown and adds nothing.
    """
    amount = F.when(usd > 50000, 0.1)
    if tiered:
        amount = F.when(usd > 100000, 0.2).when(usd > 50000, 0.1)

    def weak(kyc: Column) -> Column:
        return F.when((kyc != 0) & (kyc < 2), 0.1).otherwise(0.0)

    border = F.when(~from_country.eqNullSafe(to_country), 0.05).otherwise(0.0)
    score = F.coalesce(aml, F.lit(0.0)) + amount.otherwise(0.0) + border
    return F.least(score + weak(sender_kyc) + weak(receiver_kyc), F.lit(1.0))


def transaction_category(usd: Column) -> Column:
    return ladder(usd, [(1e3, "micro"), (1e4, "small"), (5e4, "medium")], "large")


def risk_category(score: Column) -> Column:
    return ladder(score, [(0.3, "low_risk"), (0.6, "medium_risk")], "high_risk")


def flow_risk_level(score: Column) -> Column:
    return ladder(score, [(0.3, "low"), (0.6, "medium")], "high")


def kyc_compliance_level(sender: Column, receiver: Column) -> Column:
    both = lambda level: (sender >= level) & (receiver >= level)
    return F.when(both(2), "compliant").when(both(1), "partial").otherwise("non_compliant")


def risk_bucket(score: Column) -> Column:
    steps = [
        (20, "Low Risk (0-19)"),
        (50, "Medium Risk (20-49)"),
        (70, "High Risk (50-69)"),
    ]
    return ladder(score, steps, "Critical Risk (70+)", strict=True)


# --- alert ladder ------------------------------------------------------------
def _above(inputs: dict[str, Column], steps: tuple) -> Column:
    """The outcome of the first step whose input exceeds its bound."""
    out = None
    for name, bound, outcome in steps:
        hit = inputs[name] > bound
        out = F.when(hit, outcome) if out is None else out.when(hit, outcome)
    return out


def alert_score(aml: Column, usd: Column) -> Column:
    return _above({"aml": aml, "usd": usd}, fixed.ALERT_SCORES).otherwise(fixed.ALERT_SCORE_ELSE)


def is_alert(flags: Column, score: Column) -> Column:
    """NULL when the flags are NULL and the score alone does not decide."""
    return F.array_contains(flags, "high_amount") | (score > fixed.ALERT_FROM)


def alert_type(aml: Column, usd: Column, sender_kyc: Column) -> Column:
    first = _above({"aml": aml, "usd": usd}, fixed.ALERT_TYPES)
    return first.when(sender_kyc == 1, fixed.LOW_KYC_TYPE).otherwise(fixed.OTHER_TYPE)


def _one_of(c: Column, outcomes: dict) -> Column:
    out = None
    for value, outcome in outcomes.items():
        out = F.when(c == value, outcome) if out is None else out.when(c == value, outcome)
    return out


# --- score between 0 and 100 -------------------------------------------------
def points_risk_score(
    account_type: Column,
    usd: Column,
    kyc: Column,
    country: Column,
    flagged: Column,
    risky_countries: tuple[str, ...] = fixed.HIGH_RISK_COUNTRIES,
) -> Column:
    points = [
        _one_of(account_type, fixed.ACCOUNT_POINTS),
        _above({"usd": usd}, fixed.AMOUNT_POINTS),
        _one_of(kyc, fixed.KYC_POINTS),
        F.when(country.isin(*risky_countries), fixed.COUNTRY_POINTS),
        F.when(flagged, fixed.FLAG_POINTS),
    ]
    total = sum((p.otherwise(0) for p in points), F.lit(0))
    return F.greatest(F.lit(0), F.least(F.lit(100), total))


def points_suspicious(flagged: Column, points: Column) -> Column:
    return F.coalesce(flagged, F.lit(False)) | (points > fixed.SUSPICIOUS_POINTS)


# --- named rules -------------------------------------------------------------
@dataclass(frozen=True)
class RuleInputs:
    """Columns the named rules look at."""

    usd: Column
    aml: Column
    country: Column
    kyc: Column
    symbol: Column


def named_rules(x: RuleInputs) -> dict[str, Column]:
    return {
        "high_amount": x.usd > fixed.RULE_HIGH_AMOUNT,
        "high_aml": x.aml > fixed.RULE_HIGH_AML,
        "risky_country": x.country.isin(*fixed.RULE_COUNTRIES) & (x.usd > fixed.RULE_COUNTRY_AMOUNT),
        "low_kyc_amount": (x.kyc == 1) & (x.usd > fixed.RULE_KYC_AMOUNT),
        "stablecoin_large": x.symbol.isin(*fixed.STABLECOINS) & (x.usd > fixed.RULE_STABLECOIN_AMOUNT),
    }


def rule_hits(rules: dict[str, Column]) -> Column:
    """Names of the rules a row satisfies, in rule order."""
    return F.array_compact(F.array(*[F.when(rule, name) for name, rule in rules.items()]))

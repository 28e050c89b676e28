"""Intent rules and AUTO / ESCALATE routing, as column expressions."""

import re
from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from deskflow import fixed
from deskflow.functions.text import WORD_CLASS, fixed_point


def weak_intent(c: Column, rules: Sequence[tuple[str, str]] = fixed.INTENT_RULES) -> Column:
    """First rule, in priority order, with a phrase in the text; null when none has."""
    lowered = F.lower(c)
    return F.coalesce(*[F.when(lowered.rlike(whole_words(phrases)), F.lit(intent)) for intent, phrases in rules])


def whole_words(phrases: str) -> str:
    """Pattern of phrases (alternatives divided by bars) as whole words.

    A place whose character begins none of the phrases is passed over without trying each of them.
    """
    parts = phrases.split("|")
    plain = all(p and p[0].isalnum() and p[1:2] not in ("?", "*", "{") for p in parts) and "(" not in phrases
    guard = f"(?=[{''.join(sorted({p[0] for p in parts}))}])" if plain else ""
    return rf"\b{guard}(?:{phrases})\b"


def match_keyword(c: Column, keywords: Sequence[str] = fixed.RISKY_KEYWORDS) -> Column:
    """First whole-word keyword, spelled as in the text; null when there is none.

    Alternatives are tried in list order, so "stolen" wins over "stolen phone".
    """
    return F.nullif(_keyword_or_empty(c, keywords), F.lit(""))


def _keyword_or_empty(c: Column, keywords: Sequence[str]) -> Column:
    alternatives = "|".join(re.escape(k) for k in keywords)
    return F.regexp_extract(c, rf"(?iu)(?<![{WORD_CLASS}])({alternatives})(?![{WORD_CLASS}])", 1)


def contains_any(c: Column, parts: Sequence[str]) -> Column:
    """True when the lower-cased text contains one of the parts, also inside words."""
    lowered = F.lower(F.coalesce(c, F.lit("")))
    hit = F.lit(False)
    for part in parts:
        hit = hit | lowered.contains(part)
    return hit


def readable(c: Column) -> Column:
    return F.replace(c, F.lit("_"), F.lit(" "))


def route(
    text: Column,
    intent: Column,
    confidence: Column,
    risky_intents: Sequence[str] = fixed.RISKY_INTENTS,
    keywords: Sequence[str] = fixed.RISKY_KEYWORDS,
    auto: float = fixed.AUTO_CONFIDENCE,
    escalate: float = fixed.ESCALATE_CONFIDENCE,
) -> Column:
    """Struct (decision, reason): risky intent, risky keyword, low, high, middle confidence.

    A missing or NaN confidence counts as low, so that an unscored message is seen by a person.
    """
    intent = F.coalesce(intent, F.lit(""))
    keyword = _keyword_or_empty(F.coalesce(text, F.lit("")), keywords)
    unsure = confidence.isNull() | F.isnan(confidence)
    shown = F.coalesce(fixed_point(confidence, 2), F.lit("unknown"))

    def outcome(decision: str, *parts) -> Column:
        reason = F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])
        return F.struct(F.lit(decision).alias("decision"), reason.alias("reason"))

    return (
        F.when(intent.isin(list(risky_intents)),
               outcome("ESCALATE", "High-risk intent '", intent, "' requires specialist intervention"))
        .when(keyword != "",
              outcome("ESCALATE", "Sensitive keyword '", keyword, "' detected in customer message"))
        .when(unsure | (confidence < F.lit(escalate)),
              outcome("ESCALATE", "Low intent classifier confidence (", shown, f" < {escalate})"))
        .when(confidence >= F.lit(auto),
              outcome("AUTO", "High confidence ", readable(intent), " (", shown, ") with standard resolution path"))
        .otherwise(
              outcome("AUTO", "Standard ", readable(intent), " query (", shown, ") routed to automated guidance"))
    )


def label_escalation(text: Column, intent: Column) -> Column:
    """Routing used as ground truth of evaluation tables: the rules at a fixed, high confidence."""
    return route(text, intent, F.lit(fixed.LABEL_CONFIDENCE))


def baseline_route(
    text: Column,
    intent: Column,
    risky_intents: Sequence[str] = fixed.RISKY_INTENTS,
    parts: Sequence[str] = fixed.BASELINE_KEYWORDS,
) -> Column:
    """Decision of the simple baseline: risky intent, or a keyword anywhere in the text."""
    risky = F.coalesce(intent.isin(list(risky_intents)), F.lit(False)) | contains_any(text, parts)
    return F.when(risky, F.lit("ESCALATE")).otherwise(F.lit("AUTO"))


def is_escalated(decision: Column) -> Column:
    return F.coalesce((decision == "ESCALATE").cast("int"), F.lit(0))

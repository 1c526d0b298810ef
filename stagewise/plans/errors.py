"""Failure messages to outcomes, by ordered rules."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts put before a message, spelled as consumers of the log expect.
CUSTOM_PREFIX = "Failure; "
UNHANDLED_PREFIX = "Unhandled Excpetion..."


@dataclass(frozen=True)
class Rule:
    """For messages of one error kind: text to look for, and the outcome it gives.

    ``contains`` of None matches every message of the kind. ``keep_message`` puts the
    message before the outcome text.
    """

    kind: str
    contains: str | None
    outcome: str
    keep_message: bool = False


# Failures of loads. ValueError counts as custom: the loads raise it for what they refuse.
OUTCOME_RULES = (
    Rule("AnalysisException", "PATH_NOT_FOUND", " [a path is missing]", keep_message=True),
    Rule("AnalysisException", "UNRESOLVED_COLUMN", " [a configured column is missing]", keep_message=True),
    Rule("TimeoutError", None, " [cancelled]", keep_message=True),
    Rule("SparkRuntimeException", "USER_RAISED_EXCEPTION", " [the data broke a rule]", keep_message=True),
)


def classify(kind: Column, message: Column, rules: Sequence[Rule], custom_kind: str = "custom") -> Column:
    """Outcome text of a failure; the first matching rule wins.

    Custom failures get a prefix, known kinds without a matching rule keep their
    message, unknown kinds are marked unhandled.
    """
    branch = F.when(kind == custom_kind, F.concat(F.lit(CUSTOM_PREFIX), message))
    for rule in rules:
        applies = kind == rule.kind
        if rule.contains is not None:
            applies = applies & message.contains(rule.contains)
        outcome = F.concat(message, F.lit(rule.outcome)) if rule.keep_message else F.lit(rule.outcome)
        branch = branch.when(applies, outcome)
    known = list(dict.fromkeys(rule.kind for rule in rules))
    if known:
        branch = branch.when(kind.isin(*known), message)
    return branch.otherwise(F.concat(F.lit(UNHANDLED_PREFIX), message))

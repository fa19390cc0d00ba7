"""Named quality rules compiled to SQL predicates."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from typing import Any

from pyspark.sql import Column, functions as F

# Rule names and the address pattern that documents rely on.
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
RULE_PREDICATES = {
    "notNull": "{field} IS NOT NULL",
    "notEmpty": "length({field}) > 0",
    "positive": "{field} > 0",
    # r'...' keeps the backslash, so the dot before the last part is a literal dot.
    "valid_email": "{field} RLIKE r'" + EMAIL_PATTERN.replace("{", "{{").replace("}", "}}") + "'",
}


def rule_sql(field: str, rule: str) -> str:
    """The predicate of one rule; ``field`` may be a nested path or expression."""
    try:
        predicate = RULE_PREDICATES[rule]
    except KeyError:
        raise ValueError(
            f"unknown rule {rule!r} for field {field!r}; known: {sorted(RULE_PREDICATES)}"
        ) from None
    return predicate.format(field=field)


def compile_rules(validations: Iterable[Mapping[str, Any]]) -> dict[str, str]:
    """``[{field, validations}]`` to ``{valid_<field>_<rule>: (predicate)}``, in order."""
    return {
        f"valid_{item['field']}_{rule}": f"({rule_sql(item['field'], rule)})"
        for item in validations
        for rule in item["validations"]
    }


def sequence_rules(columns: Iterable[str]) -> dict[str, str]:
    """Rules that a keyed table needs: no key and no sequence value may be NULL."""
    return {f"valid_{c}_sequence": f"({c} IS NOT NULL)" for c in columns}


def passes(rules: Mapping[str, str]) -> Column:
    """True when every rule holds. A NULL verdict counts as a failure."""
    if not rules:
        return F.lit(True)
    verdict = reduce(Column.__and__, (F.expr(sql) for sql in rules.values()))
    return F.coalesce(verdict, F.lit(False))


def quarantined(rules: Mapping[str, str]) -> Column:
    """The opposite of :func:`passes`, so each row is on exactly one side."""
    return ~passes(rules)


def failed_codes(rules: Mapping[str, str]) -> Column:
    """Names of the rules a row fails, in rule order."""
    if not rules:
        return F.array().cast("array<string>")
    failed = [
        F.when(~F.coalesce(F.expr(sql), F.lit(False)), F.lit(name)) for name, sql in rules.items()
    ]
    return F.array_compact(F.array(*failed))

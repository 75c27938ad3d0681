"""Plain Python model of the mapping semantics, one event at a time."""

from __future__ import annotations

import json
from functools import reduce

from auditlake.plans.mapping import Condition, EventMapping, Rule, TypeRules


class Unmappable(Exception):
    pass


def at(event, path):
    return reduce(lambda node, key: node.get(key) if isinstance(node, dict) else None, path, event)


def holds(condition: Condition, event) -> bool | None:
    subject = at(event, condition.path) or "System"
    if isinstance(subject, (bool, int, float)):
        return None
    return (condition.value in subject) is not condition.negated


def source_value(rule: Rule, event):
    if rule.branches is None:
        return at(event, rule.source)
    taken = next((b for b in rule.branches if holds(b.condition, event)), None)
    return at(event, taken.source) if taken else None


def normalized(mapping: EventMapping, rules: TypeRules, rule: Rule, path, term):
    if isinstance(term, (list, dict)):
        raise Unmappable
    known = mapping.terms[rules.event_type]
    caption = rule.effective_prefix + (known.get(term, "Other") if isinstance(term, str) else "Other")
    if rule.effective_output_type == "norm_string":
        return caption
    key = path[-2:] if len(path) > 1 else (rules.class_name, path[0])
    return mapping.enums.get(key, {}).get(caption, 0)


def record(mapping: EventMapping, event) -> dict | None:
    """Leaf values by dotted path, later writes over earlier ones."""
    rules = mapping.types.get(event.get("type"))
    if rules is None:
        return None
    written = {path: value for path, value in rules.statics.items()}
    for rule in rules.rules:
        value = source_value(rule, event)
        if value is None:
            continue
        for target in rule.targets:
            out = value
            if rule.normalizes:
                out = normalized(mapping, rules, rule, target.path, value if target.term is None else target.term)
            if not target.blank:
                written[target.path] = out
    return {".".join(path): value for path, value in written.items()}


def as_text(value):
    """Text a VARIANT value casts to."""
    if value is None or isinstance(value, str):
        return value
    if isinstance(value, (bool, int)):
        return json.dumps(value)
    if isinstance(value, float):
        return json.dumps(value)
    return json.dumps(value, separators=(",", ":"), sort_keys=True)

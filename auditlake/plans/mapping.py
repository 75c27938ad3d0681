"""Typed model of a mapping document, with the checks done when it is loaded.

A document is nested JSON keyed by event type::

    {"<TYPE>": {"staticValues":  {"class_name": "<class>", "<dotted.path>": <JSON>},
                "fieldMappings": {"<comma,separated,source>": [
                    {"target_field": "<dotted.path>" | {"<term>": "<dotted.path>"},
                     "transform": "normalize", "output_type": "norm_string" | "integer",
                     "concat_string": "<prefix>",
                     "conditions": [{"condition": "<value> [not] in <dotted.path>",
                                     "source_field": "<dotted.path>"}]}]}}}

It is small, lives on the driver and is read once; executors only ever see the
SQL expressions compiled from it.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field
from typing import Any

from auditlake.functions.sqltext import INT_MAX, INT_MIN

EVENT_CLASSES = ("account_change", "authentication", "scheduled_job_activity")
SAMPLE_KEY = "sample_data"
NORMALIZE = "normalize"
OUTPUT_TYPES = ("norm_string", "integer")
DEFAULT_OUTPUT_TYPE = "norm_string"
DEFAULT_PREFIX = ""
MISSING_CAPTION = "Other"
MISSING_ENUM_ID = 0


class MappingError(ValueError):
    """The mapping, terms or enum document cannot be used."""


@dataclass(frozen=True)
class Condition:
    value: str
    negated: bool
    path: tuple[str, ...]


@dataclass(frozen=True)
class Branch:
    condition: Condition
    source: tuple[str, ...]


@dataclass(frozen=True)
class Target:
    """Where a rule writes. ``term`` is the constant of a keyed target."""

    path_text: str
    term: str | None = None

    @property
    def blank(self) -> bool:
        return not self.path_text.strip()

    @property
    def path(self) -> tuple[str, ...]:
        return tuple(self.path_text.split("."))


@dataclass(frozen=True)
class Rule:
    source_text: str
    targets: tuple[Target, ...]
    branches: tuple[Branch, ...] | None = None
    transform: str | None = None
    output_type: str | None = None
    prefix: str | None = None

    @property
    def source(self) -> tuple[str, ...]:
        return tuple(self.source_text.split(","))

    @property
    def normalizes(self) -> bool:
        return self.transform == NORMALIZE

    @property
    def effective_output_type(self) -> str:
        return DEFAULT_OUTPUT_TYPE if self.output_type is None else self.output_type

    @property
    def effective_prefix(self) -> str:
        return DEFAULT_PREFIX if self.prefix is None else self.prefix


@dataclass(frozen=True)
class TypeRules:
    event_type: str
    class_name: str
    statics: dict[tuple[str, ...], Any]
    rules: tuple[Rule, ...]

    def written_paths(self) -> Iterator[tuple[str, ...]]:
        yield from self.statics
        for rule in self.rules:
            for target in rule.targets:
                if not target.blank:
                    yield target.path


@dataclass(frozen=True)
class EventMapping:
    """All mapped types, with the lookup tables their rules use."""

    types: dict[str, TypeRules]
    wanted_types: tuple[str, ...]
    terms: dict[str, dict[str, str]] = field(repr=False)
    enums: dict[tuple[str, str], dict[str, int]] = field(repr=False)

    def types_of(self, class_name: str) -> list[str]:
        return [t for t, rules in self.types.items() if rules.class_name == class_name]

    def classes(self) -> list[str]:
        return [c for c in EVENT_CLASSES if self.types_of(c)]

    def enum_id(self, class_name: str, path: tuple[str, ...], caption: str) -> int:
        key = path[-2:] if len(path) > 1 else (class_name, path[0])
        return self.enums.get(key, {}).get(caption, MISSING_ENUM_ID)


def prune(document: Any, name: str) -> Any:
    """JSON value without entries that have this key or value, or list elements equal to it.

    Every object and list of the result is filled from a work list, however deep it lies.
    """
    holder: list[Any] = [None]
    waiting = [(holder, 0, document)]
    while waiting:
        parent, place, value = waiting.pop()
        if isinstance(value, dict):
            parent[place] = own = {k: None for k, v in value.items() if name not in (k, v)}
            waiting += [(own, k, value[k]) for k in own]
        elif isinstance(value, list):
            left = [v for v in value if v != name]
            parent[place] = own = [None] * len(left)
            waiting += [(own, i, v) for i, v in enumerate(left)]
        else:
            parent[place] = value
    return holder[0]


def parse_condition(text: str) -> Condition:
    """Split ``value [not] in path``; ``not in`` is looked for first."""
    for operator, negated in ((" not in ", True), (" in ", False)):
        value, found, path = text.partition(operator)
        if found:
            return Condition(value, negated, tuple(path.split(".")))
    raise MappingError(f"condition {text!r} has no 'in' operator")


def parse_terms(document: str | Mapping[str, Any]) -> dict[str, dict[str, str]]:
    terms = json.loads(document) if isinstance(document, str) else dict(document)
    for event_type, captions in terms.items():
        if not isinstance(captions, dict) or not all(isinstance(c, str) for c in captions.values()):
            raise MappingError(f"terms of {event_type!r} must map text to text")
    return terms


def parse_enums(document: str | Mapping[str, Any]) -> dict[tuple[str, str], dict[str, int]]:
    raw = json.loads(document) if isinstance(document, str) else dict(document)
    enums = {}
    for key, ids in raw.items():
        if not (key.startswith("('") and key.endswith("')") and key.count("', '") == 1):
            raise MappingError(f"enum key {key!r} is not of the form ('object', 'attribute')")
        known = {caption: number for caption, number in ids.items() if number is not None}
        for caption, number in known.items():
            if isinstance(number, bool) or not isinstance(number, int) or not INT_MIN <= number <= INT_MAX:
                raise MappingError(f"enum id of {key} {caption!r} is no 32-bit integer")
        obj, _, attribute = key[2:-2].partition("', '")
        enums[obj, attribute] = known
    return enums


def load_mapping(
    document: str | Mapping[str, Any],
    terms: str | Mapping[str, Any],
    enums: str | Mapping[str, Any],
) -> EventMapping:
    raw = json.loads(document) if isinstance(document, str) else dict(document)
    term_table = parse_terms(terms)
    types = {}
    for event_type, body in raw.items():
        pruned = prune(body, SAMPLE_KEY)
        if pruned is None or pruned == []:
            continue  # wanted by the type filter, but nothing maps it
        types[event_type] = _type_rules(event_type, pruned, term_table)
    mapping = EventMapping(types, tuple(raw), term_table, parse_enums(enums))
    for class_name in mapping.classes():
        _check_layout(
            class_name,
            {p for t in mapping.types_of(class_name) for p in types[t].written_paths()},
        )
    return mapping


def _type_rules(event_type: str, body: Any, terms: dict[str, dict[str, str]]) -> TypeRules:
    if not isinstance(body, dict) or not {"staticValues", "fieldMappings"} <= body.keys():
        raise MappingError(f"{event_type}: staticValues and fieldMappings are required")
    class_name = body["staticValues"].get("class_name")
    if class_name not in EVENT_CLASSES:
        raise MappingError(f"{event_type}: unknown class_name {class_name!r}")
    statics: dict[tuple[str, ...], Any] = {}
    for path_text, value in body["staticValues"].items():
        top = tuple(path_text.split("."))
        if isinstance(value, dict) and any(p[: len(top)] == top for p in statics):
            raise MappingError(f"{event_type}: static object {path_text} replaces values written before it")
        for path, leaf in _static_leaves(event_type, top, value):
            statics.pop(path, None)
            statics[path] = leaf
    rules = tuple(
        _rule(event_type, source, item, terms)
        for source, items in body["fieldMappings"].items()
        for item in items
    )
    result = TypeRules(event_type, class_name, statics, rules)
    for rule in rules:
        for target in rule.targets:
            if target.path == ("class_name",):
                raise MappingError(f"{event_type}: a rule may not write class_name")
    _check_layout(event_type, set(result.written_paths()))
    return result


def _static_leaves(
    event_type: str, path: tuple[str, ...], value: Any
) -> Iterator[tuple[tuple[str, ...], Any]]:
    if isinstance(value, dict):
        if not value:
            raise MappingError(f"{event_type}: static value at {'.'.join(path)} is an empty object")
        for key, child in value.items():
            yield from _static_leaves(event_type, (*path, key), child)
    else:
        yield path, value


def _rule(event_type: str, source: str, item: dict[str, Any], terms: dict[str, dict[str, str]]) -> Rule:
    where = f"{event_type}/{source}"
    if "target_field" not in item:
        raise MappingError(f"{where}: target_field is required")
    target_field = item["target_field"]
    if isinstance(target_field, dict):
        targets = tuple(Target(path, term) for term, path in target_field.items())
    else:
        targets = (Target(target_field),)
    if not all(isinstance(t.path_text, str) for t in targets):
        raise MappingError(f"{where}: target paths must be text")
    branches = None
    if "conditions" in item:
        for branch in item["conditions"]:
            if not {"condition", "source_field"} <= branch.keys():
                raise MappingError(f"{where}: a condition needs condition and source_field")
        branches = tuple(
            Branch(parse_condition(b["condition"]), tuple(b["source_field"].split(".")))
            for b in item["conditions"]
        )
    rule = Rule(
        source_text=source,
        targets=targets,
        branches=branches,
        transform=item.get("transform"),
        output_type=_present(item, "output_type", where),
        prefix=item.get("concat_string"),
    )
    if rule.normalizes:
        if rule.effective_output_type not in OUTPUT_TYPES:
            raise MappingError(f"{where}: unknown output_type {rule.output_type!r}")
        if event_type not in terms:
            raise MappingError(f"{where}: {event_type} has no terms entry to normalize with")
        if not isinstance(rule.effective_prefix, str):
            raise MappingError(f"{where}: concat_string must be text")
    return rule


def _present(item: dict[str, Any], name: str, where: str) -> Any:
    """The entry, None when there is none; an explicit null is refused."""
    if name in item and item[name] is None:
        raise MappingError(f"{where}: {name} may be left out, but not null")
    return item.get(name)


def _check_layout(where: str, paths: set[tuple[str, ...]]) -> None:
    """One value per path, none above another, none inside the raw event."""
    spelled: dict[tuple[str, ...], tuple[str, ...]] = {}
    for path in paths:
        if not all(path):
            raise MappingError(f"{where}: empty step in target {'.'.join(path)!r}")
        if path[0].lower() == "data":
            raise MappingError(f"{where}: target {'.'.join(path)} lies in the raw event")
        for depth in range(1, len(path)):
            if path[:depth] in paths:
                raise MappingError(f"{where}: target {'.'.join(path)} overlaps {'.'.join(path[:depth])}")
        for depth in range(1, len(path) + 1):
            step = path[:depth]
            if spelled.setdefault(tuple(s.lower() for s in step), step) != step:
                raise MappingError(f"{where}: target {'.'.join(step)} differs from another only by letter case")

"""What a mapping document may say, and what is refused when it is loaded."""

from __future__ import annotations

import copy

import pytest

from auditlake.fixtures import DEMO_MAPPING, demo_mapping
from auditlake.plans.mapping import MappingError, load_mapping, parse_condition, prune
from auditlake.sources.terms import ENUMS, TERMS


def doc(rules=None, statics=None, event_type="AUTH", class_name="authentication"):
    return {
        event_type: {
            "staticValues": {"class_name": class_name, **(statics or {})},
            "fieldMappings": rules or {},
        }
    }


def load(document):
    return load_mapping(document, TERMS, ENUMS)


def rule(**attributes):
    return {"operation": [{"target_field": "a", **attributes}]}


@pytest.mark.parametrize(
    ("document", "message"),
    [
        (doc(rule(conditions=[{"condition": "x of y", "source_field": "z"}])), "no 'in' operator"),
        (doc(rule(transform="normalize", output_type="float")), "unknown output_type"),
        (doc({"a": [{"target_field": "x"}], "b": [{"target_field": "x.y"}]}), "overlaps"),
        (doc(rule(), {"a": {"b": 1}}), "overlaps"),
        (doc({}, {"a.b": 1, "a": {"c": 2}}), "replaces values"),
        (doc(rule(transform="normalize"), event_type="UNKNOWN"), "no terms entry"),
        (doc(class_name="file_activity"), "unknown class_name"),
        (doc({"operation": [{"target_field": "class_name"}]}), "may not write class_name"),
        (doc({"operation": [{"target_field": "data.id"}]}), "lies in the raw event"),
        (doc({"operation": [{"target_field": "a..b"}]}), "empty step"),
        (doc({"operation": [{"target_field": "Time"}, {"target_field": "time"}]}), "letter case"),
        (doc({"operation": [{"transform": "normalize"}]}), "target_field is required"),
        (doc(rule(conditions=[{"condition": "x in y"}])), "needs condition and source_field"),
        (doc({}, {"a": {}}), "empty object"),
        ({"AUTH": {"staticValues": {"class_name": "authentication"}}}, "required"),
        ({"AUTH": {"staticValues": {}, "fieldMappings": {}}}, "unknown class_name"),
    ],
)
def test_rejected_documents(document, message):
    with pytest.raises(MappingError, match=message):
        load(document)


@pytest.mark.parametrize(
    "enums", [{"account_change.activity_id": {"Create": 1}}, {"('a', 'b')": {"Create": "1"}}, {"('a', 'b')": {"Create": True}}]
)
def test_rejected_enums(enums):
    with pytest.raises(MappingError):
        load_mapping(doc(), TERMS, enums)


def test_types_of_one_class_share_a_layout():
    document = {
        **doc({"a": [{"target_field": "x"}]}, event_type="USER_MANAGEMENT", class_name="account_change"),
        **doc({"a": [{"target_field": "x.y"}]}, event_type="ACCESS_ITEM", class_name="account_change"),
    }
    with pytest.raises(MappingError, match="overlaps"):
        load(document)


def test_empty_terms_entry_is_no_error():
    assert load(doc(rule(transform="normalize"), event_type="PROVISIONING")).types


def test_type_without_rules_is_wanted_but_not_mapped():
    mapping = load({"AUTH": [], "SYSTEM_CONFIG": None, **doc(event_type="ACCESS_ITEM", class_name="account_change")})
    assert mapping.wanted_types == ("AUTH", "SYSTEM_CONFIG", "ACCESS_ITEM")
    assert list(mapping.types) == ["ACCESS_ITEM"]


def test_sample_data_is_pruned_everywhere():
    document = copy.deepcopy(DEMO_MAPPING)
    document["AUTH"]["staticValues"]["label"] = "sample_data"
    mapping = load(document)
    assert ("label",) not in mapping.types["AUTH"].statics
    assert prune({"a": ["s", None, {"s": 1, "b": "s"}], "s": 2}, "s") == {"a": [None, {}]}


def test_defaults_and_sources():
    rules = demo_mapping().types["AUTH"].rules
    assert rules[0].effective_output_type == "norm_string"
    assert rules[0].effective_prefix == ""
    assert rules[2].targets[0].blank
    assert next(r for r in rules if r.source_text == "actor,name").source == ("actor", "name")


def test_conditions_parse_not_in_first():
    parsed = parse_condition("a in b not in c.d")
    assert (parsed.value, parsed.negated, parsed.path) == ("a in b", True, ("c", "d"))
    assert parse_condition("x in y").negated is False


def test_lookup_sizes():
    assert sum(len(c) for c in TERMS.values()) == 52
    assert len(TERMS) == 9
    assert TERMS["SYSTEM_CONFIG"]["DISABLE"] == "Enable"
    assert demo_mapping().enum_id("account_change", ("activity_id",), "Delete") == 6
    assert demo_mapping().enum_id("account_change", ("actor", "user", "type_id"), "Actor User") == 1
    assert demo_mapping().enum_id("account_change", ("activity_id",), "Nope") == 0

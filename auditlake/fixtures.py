"""Audit view over the ``events`` table, and a demo mapping document.

``events`` holds ``(event_id, ts, user_id, event_type, value, props)``. The view
derives raw audit events from it, all of them, one to one.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame

from auditlake.plans.mapping import EventMapping, load_mapping
from auditlake.sources.lake import Tenant
from auditlake.sources.terms import ENUMS, TERMS

NOW = "2024-01-31T00:00:00Z"
CHECKPOINT = "2024-01-10T00:00:00.000Z"
TENANT = Tenant(region="eu-west-1", account_id="012345678901")

_K = "CAST(get_json_object(props, '\\u0024.k') AS INT)"

_AUDIT_COLUMNS = [
    "CAST(event_id AS STRING) AS id",
    # lookups rather than CASE branches: a filter on type repeats this expression at
    # the scan, and each mention of k parses props again
    """coalesce(
         try_element_at(map(0, 'PROVISIONING', 1, 'UNMAPPED'), k % 20),
         try_element_at(map('signup', 'USER_MANAGEMENT', 'error', 'SYSTEM_CONFIG', 'click', 'ACCESS_ITEM',
                            'view', 'AUTH', 'purchase', 'ACCESS_REQUEST'), event_type)) AS type""",
    "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSS'Z'\") AS created",
    """element_at(array('CREATE', 'UPDATE', 'DELETE', 'ADD', 'REQUEST', 'LOGOUT', 'GRANT', 'ZZZ'),
                  k % 8 + 1) AS operation""",
    "CASE WHEN value < 5 THEN 'STARTED' WHEN value < 50 THEN 'PASSED' ELSE 'FAILED' END AS status",
    """named_struct('name', CASE WHEN user_id % 7 <> 0
                               THEN concat('user_', CAST(user_id AS STRING)) END) AS actor""",
    """named_struct('sourceName', concat('Source ', CAST(user_id % 5 AS STRING)),
                   'tags', array(concat('t', CAST(k % 3 AS STRING)), event_type)) AS attributes""",
]


def audit_view(events: DataFrame, *more: str) -> DataFrame:
    """Raw audit events, with more columns of ``events``; a filter on these still reaches
    the scan."""
    return events.selectExpr("*", f"{_K} AS k").selectExpr(*_AUDIT_COLUMNS, *more)


def _demo_rules(class_name: str) -> dict:
    job = class_name == "scheduled_job_activity"
    return {
        "sample_data": {"type": "EXAMPLE", "operation": "CREATE"},
        "staticValues": {
            "class_name": class_name,
            "metadata": {"version": "1.0.0-rc.2"},
            "metadata.product.name": "Identity Audit",
        },
        "fieldMappings": {
            "operation": [
                {"target_field": "activity_name", "transform": "normalize"},
                {"target_field": "activity_id", "transform": "normalize", "output_type": "integer"},
                # computed, never written
                {"target_field": "  ", "transform": "normalize"},
            ],
            "status": [
                {"target_field": "status", "transform": "normalize", "output_type": "norm_string"},
                {
                    "target_field": "status_id",
                    "transform": "normalize",
                    "output_type": "integer",
                    "concat_string": "Job " if job else "",
                },
            ],
            "created": [{"target_field": "time"}],
            "actor,name": [
                {"target_field": "actor.user.name"},
                {
                    "target_field": {"USER": "actor.user.type"},
                    "transform": "normalize",
                },
                {
                    "target_field": {"USER": "actor.user.type_id", "SYSTEM": " "},
                    "transform": "normalize",
                    "output_type": "integer",
                    "concat_string": "Actor ",
                },
            ],
            "attributes,sourceName": [
                {
                    # the later rule wins over actor,name wherever it gives a value
                    "target_field": "actor.user.name",
                    "conditions": [
                        {"condition": "System in actor.name", "source_field": "attributes.sourceName"},
                        {"condition": "user_1 in actor.name", "source_field": "attributes.missing"},
                        {"condition": "t1 not in attributes.tags", "source_field": "id"},
                    ],
                },
                {"target_field": {"first": "src.name", "second": "src.group.name"}},
                {
                    "target_field": "src.kind",
                    "conditions": [
                        {"condition": "sourceName in attributes", "source_field": "operation"}
                    ],
                },
            ],
        },
    }


DEMO_MAPPING = {
    "AUTH": _demo_rules("authentication"),
    "SYSTEM_CONFIG": _demo_rules("scheduled_job_activity"),
    "USER_MANAGEMENT": _demo_rules("account_change"),
    "ACCESS_ITEM": _demo_rules("account_change"),
    "ACCESS_REQUEST": _demo_rules("account_change"),
    "PROVISIONING": _demo_rules("account_change"),
    "PASSWORD_ACTIVITY": _demo_rules("account_change"),
}
TIME_PATHS = ("time",)


# Types that share targets but no rule.
UNLIKE_MAPPING = {
    "AUTH": {
        "staticValues": {"class_name": "authentication", "note": "seen"},
        "fieldMappings": {"operation": [{"target_field": "label"}]},
    },
    "SYSTEM_CONFIG": {
        "staticValues": {"class_name": "scheduled_job_activity", "level": 7},
        "fieldMappings": {
            "operation": [{"target_field": "label", "transform": "normalize", "concat_string": "Job "}]
        },
    },
    "ACCESS_ITEM": {
        "staticValues": {"class_name": "account_change", "note": "item"},
        "fieldMappings": {
            "status": [
                {
                    "target_field": "label",
                    "conditions": [{"condition": "t1 in attributes.tags", "source_field": "status"}],
                }
            ]
        },
    },
    "USER_MANAGEMENT": {
        "staticValues": {"class_name": "account_change"},
        "fieldMappings": {"created": [{"target_field": "note"}], "actor,name": [{"target_field": "level"}]},
    },
}


@cache
def unlike_mapping() -> EventMapping:
    return load_mapping(UNLIKE_MAPPING, TERMS, ENUMS)


@cache
def demo_mapping() -> EventMapping:
    return load_mapping(DEMO_MAPPING, TERMS, ENUMS)

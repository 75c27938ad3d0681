"""Lookup documents shipped with the package: captions of audit terms, enum ids."""

from __future__ import annotations

# Captions of the terms of each event type. They must stay as they
# are, odd rows included, for results to agree.
TERMS: dict[str, dict[str, str]] = {
    "AUTH": {
        "LOGOUT": "Logoff",
        "LOGIN_SUCCESS": "Logon",
        "PASSED": "Success",
        "FAILED": "Failure",
        "USER": "User",
        "REQUEST": "Logon",
    },
    "PASSWORD_ACTIVITY": {
        "UPDATE": "Password Change",
        "CHANGE": "Password Change",
        "ASSIGN": "Attach Policy",
        "STARTED": "Other",
        "PASSED": "Success",
        "SYSTEM": "System",
    },
    "USER_MANAGEMENT": {
        "ACTIVATE": "Other",
        "ANSWERS": "Other",
        "DELETE": "Delete",
        "GRANT": "Other",
        "INVITE": "Other",
        "REGISTER": "Other",
        "UPDATE": "Update",
        "SETUP": "Other",
        "NOTIFY": "Other",
        "SEND": "Other",
        "PASSED": "Success",
        "FAILED": "Failure",
        "STARTED": "Other",
        "USER": "User",
    },
    "PROVISIONING": {},
    "NON_EMPLOYEE": {},
    "IDENTITY_MANAGEMENT": {},
    "ACCESS_ITEM": {
        "CREATE": "Other",
        "PASSED": "Success",
        "FAILED": "Failure",
        "ADD": "Other",
        "UPDATE": "Update",
        "DENIED": "Other",
        "REQUEST": "Other",
        "REVOKE": "Other",
    },
    "ACCESS_REQUEST": {
        "STARTED": "Other",
        "APPROVED": "Access Grant",
        "CANCELLED": "Access Revoke",
        "PROCESSED": "Other",
        "DENIED": "Access Deny",
        "REQUEST": "Other",
        "REVOKE": "Access Revoke",
    },
    "SYSTEM_CONFIG": {
        "CREATE": "Create",
        "UPDATE": "Update",
        "DELETE": "Delete",
        "ADD": "Start",
        "PASSED": "Success",
        "FAILED": "Failure",
        "REQUEST": "Start",
        "MODIFY": "Other",
        "DISABLE": "Enable",
        "SETUP": "Other",
        "REGISTER": "Other",
    },
}

# Our own enum document: ids of captions, keyed by (object, attribute). A one-part
# attribute belongs to its event class.
ENUMS: dict[str, dict[str, int]] = {
    "('account_change', 'activity_id')": {
        "Create": 1,
        "Enable": 2,
        "Password Change": 3,
        "Disable": 5,
        "Delete": 6,
        "Attach Policy": 7,
        "Update": 12,
        "Access Grant": 20,
        "Access Revoke": 21,
        "Access Deny": 22,
        "Other": 99,
    },
    "('authentication', 'activity_id')": {"Logon": 1, "Logoff": 2, "Other": 99},
    "('scheduled_job_activity', 'activity_id')": {
        "Create": 1,
        "Update": 2,
        "Delete": 3,
        "Enable": 4,
        "Disable": 5,
        "Start": 6,
    },
    "('account_change', 'status_id')": {"Success": 1, "Failure": 2, "Other": 99},
    "('authentication', 'status_id')": {"Success": 1, "Failure": 2, "Other": 99},
    "('scheduled_job_activity', 'status_id')": {"Job Success": 1, "Job Failure": 2},
    "('user', 'type_id')": {"Actor User": 1, "Actor System": 3, "Actor Other": 99},
}

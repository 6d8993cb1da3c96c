"""Validity of the names that route a message."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted forms of each name.
NAMESPACE_SUFFIX = ".servicebus.windows.net"
HUB_NAME = r"^[a-zA-Z0-9]([a-zA-Z0-9\-._])*[a-zA-Z0-9]$"
MAPPING_KEY = r"^[A-Z0-9_]+$"
SQL_IDENTIFIER = r"^[A-Za-z0-9_$]+$"
LETTERS_AND_DIGITS = r"^[\p{L}\p{N}]+$"
ACCOUNT = r"^[\p{L}\p{N}\-._]+$"


def is_namespace(name: Column) -> Column:
    return name.endswith(NAMESPACE_SUFFIX)


def is_hub_name(name: Column) -> Column:
    return name.rlike(HUB_NAME)


def stripped(name: Column) -> Column:
    """Without white space at either end, of any kind."""
    return F.regexp_replace(name, r"(?U)^\s+|\s+$", "")


def is_not_blank(name: Column) -> Column:
    return F.length(stripped(name)) > 0


def is_target_identifier(name: Column) -> Column:
    """Letters and digits, once ``_``, ``$`` and ``-`` are taken out."""
    return F.translate(stripped(name), "_$-", "").rlike(LETTERS_AND_DIGITS)


def is_sql_identifier(name: Column) -> Column:
    """The narrower rule of the control-table writer: no ``-`` and only ASCII."""
    return name.rlike(SQL_IDENTIFIER)


def is_mapping_key(name: Column) -> Column:
    return name.rlike(MAPPING_KEY)


def is_account(name: Column) -> Column:
    return is_not_blank(name) & name.rlike(ACCOUNT)


#: Rule name -> (column it reads, predicate).
ROUTING_RULES = {
    "namespace": ("eventhub_namespace", is_namespace),
    "eventhub": ("eventhub", is_hub_name),
    "consumer_group": ("consumer_group", is_not_blank),
    "target_db": ("target_db", is_target_identifier),
    "target_schema": ("target_schema", is_target_identifier),
    "target_table": ("target_table", is_target_identifier),
    "hub_key": ("hub_key", is_mapping_key),
    "target_key": ("target_key", is_mapping_key),
}

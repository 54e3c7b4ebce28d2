"""User-agent text to device, operating system and browser.

The rules are ordered, the first match wins.  Browser names come before Safari
because almost every agent string ends in ``Safari/...``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values: (label, regular expression) in order of precedence.
DEVICE_RULES = (
    ("Tablet", "Tablet|iPad"),
    ("Mobile", "Mobile|iPhone"),
)
DEVICE_DEFAULT = "Laptop"

OS_RULES = (
    ("Windows", "Windows NT"),
    ("Android", "Android"),
    ("iOS", "iPhone|iPad"),
    ("Mac OS X", "Macintosh|Mac OS X"),
    ("Linux", "Linux"),
)

BROWSER_RULES = (
    ("Edge", "Edge?/"),
    ("Opera", "Opera/|OPR/"),
    ("Firefox", "Firefox/"),
    ("Chrome", "Chrome/"),
    ("Safari", "Safari/"),
)

OTHER = "Other"


def first_match(col: Column, rules: tuple[tuple[str, str], ...], default: str) -> Column:
    """Label of the first rule whose pattern is found in ``col``."""
    return F.coalesce(*(F.when(col.rlike(pattern), label) for label, pattern in rules), F.lit(default))


def device_type(agent: Column) -> Column:
    return first_match(agent, DEVICE_RULES, DEVICE_DEFAULT)


def os_family(agent: Column) -> Column:
    return first_match(agent, OS_RULES, OTHER)


def browser_family(agent: Column) -> Column:
    return first_match(agent, BROWSER_RULES, OTHER)

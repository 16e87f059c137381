"""User-agent classification by ordered rules, all as JVM-side expressions.

A rule is tried in order: the first whose token occurs in the agent text wins.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from clickweir.functions.text import blank_to_null, not_blank
from clickweir.schemas import UNKNOWN


@dataclass(frozen=True)
class BrowserRule:
    token: str
    family: str
    version: str  # pattern whose first group is the version


@dataclass(frozen=True)
class SystemRule:
    token: str
    family: str
    name: str
    version: str | None = None  # optional pattern; its group is appended to the name


BROWSERS = [
    BrowserRule("Edg", "Edge", r"Edg(?:e|A|iOS)?/([\d.]+)"),
    BrowserRule("OPR/", "Opera", r"OPR/([\d.]+)"),
    BrowserRule("Opera", "Opera", r"(?:Version/|^(?!.*Version/).*Opera[/ ])([\d.]+)"),
    BrowserRule("Firefox/", "Firefox", r"Firefox/([\d.]+)"),
    BrowserRule("CriOS/", "Chrome", r"CriOS/([\d.]+)"),
    BrowserRule("Chrome/", "Chrome", r"Chrome/([\d.]+)"),
    BrowserRule("MSIE ", "IE", r"MSIE ([\d.]+)"),
    BrowserRule("Trident/", "IE", r"rv:([\d.]+)"),
    BrowserRule("Safari/", "Safari", r"Version/([\d.]+)"),
]

SYSTEMS = [
    SystemRule("Windows NT 10.0", "Windows", "Windows 10"),
    SystemRule("Windows NT 6.3", "Windows", "Windows 8.1"),
    SystemRule("Windows NT 6.2", "Windows", "Windows 8"),
    SystemRule("Windows NT 6.1", "Windows", "Windows 7"),
    SystemRule("Windows NT 6.0", "Windows", "Windows Vista"),
    SystemRule("Windows NT 5.1", "Windows", "Windows XP"),
    SystemRule("Windows", "Windows", "Windows"),
    SystemRule("iPhone", "iOS", "iOS", r"OS (\d+)[_\d]* like"),
    SystemRule("iPad", "iOS", "iOS", r"OS (\d+)[_\d]* like"),
    SystemRule("Android", "Android", "Android", r"Android (\d+(?:\.\d+)?)"),
    SystemRule("Mac OS X", "OS X", "OS X", r"Mac OS X (\d+[._]\d+)"),
    SystemRule("Linux", "Linux", "Linux"),
]


def _first_match(agent: Column, rules: list, value, otherwise: Column) -> Column:
    chain = F.when(agent.contains(rules[0].token), value(rules[0]))
    for rule in rules[1:]:
        chain = chain.when(agent.contains(rule.token), value(rule))
    return F.when(not_blank(agent), chain.otherwise(otherwise))


def browser_of(agent: Column, rules: list[BrowserRule] = BROWSERS) -> Column:
    """Struct (browser, browser_v), null when the agent is blank."""

    def found(rule: BrowserRule) -> Column:
        version = F.regexp_extract(agent, rule.version, 1)
        return F.struct(
            F.lit(rule.family).alias("browser"), blank_to_null(version).alias("browser_v")
        )

    unknown = F.struct(
        F.lit(UNKNOWN).alias("browser"), F.lit(None).cast("string").alias("browser_v")
    )
    return _first_match(agent, rules, found, unknown)


def system_of(agent: Column, rules: list[SystemRule] = SYSTEMS) -> Column:
    """Struct (os, os_v), null when the agent is blank."""

    def name(rule: SystemRule) -> Column:
        if rule.version is None:
            return F.lit(rule.name)
        version = F.translate(F.regexp_extract(agent, rule.version, 1), "_", ".")
        return F.trim(F.concat(F.lit(rule.name + " "), version))

    def found(rule: SystemRule) -> Column:
        return F.struct(F.lit(rule.family).alias("os"), name(rule).alias("os_v"))

    unknown = F.struct(F.lit(UNKNOWN).alias("os"), F.lit(UNKNOWN).alias("os_v"))
    return _first_match(agent, rules, found, unknown)

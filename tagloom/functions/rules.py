"""The small text languages held in the ``rule`` column of tag definitions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_rule(text: str) -> dict[str, str]:
    """``key=value`` lines of one level-4 rule; only the first ``=`` separates, of equal keys the last counts."""
    pairs = (line.strip().partition("=") for line in text.splitlines() if "=" in line)
    return {key.strip(): value.strip() for key, _, value in pairs}


def rule_params(rule) -> Column:
    """The same as a ``map<string,string>`` column, for whole tables of rules."""
    rule = F.col(rule) if isinstance(rule, str) else rule
    lines = F.filter(F.split(rule, r"\r?\n"), lambda line: F.instr(line, "=") > 0)
    pairs = F.transform(
        lines,
        lambda line: F.struct(
            F.trim(F.substring_index(line, "=", 1)).alias("key"),
            F.trim(line.substr(F.instr(line, "=") + 1, F.length(line))).alias("value"),
        ),
    )
    keys = F.transform(pairs, lambda pair: pair["key"])
    last = F.filter(pairs, lambda pair, i: ~F.array_contains(F.slice(keys, i + 2, F.size(keys)), pair["key"]))
    return F.map_from_entries(last)


def range_rule(rule) -> Column:
    """``lo-hi`` as ``struct<lo bigint, hi bigint>``; NULL for any other rule text."""
    rule = F.trim(F.col(rule) if isinstance(rule, str) else rule)
    parts = F.split(rule, "-")
    return F.when(
        rule.rlike(r"^[0-9]+-[0-9]+\z"),
        F.struct(parts[0].cast("bigint").alias("lo"), parts[1].cast("bigint").alias("hi")),
    )

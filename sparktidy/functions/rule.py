"""Cleaning rules as chains of ``Column -> Column`` steps.

Catalyst may inline a rule wherever its result is used, above all when it pushes a filter on a
cleaned column below the projection.  A step that mentions its input several times (``CASE``
branches, guards) would then multiply with every other such step, so steps are written to mention
their input once wherever that is possible: ``null unless it matches`` is :func:`only_if`, not a
``CASE``.  The others are marked :func:`reuses_input`, and :func:`apply_rules` computes their input
in a ``select`` of its own, for all columns together; Catalyst keeps two projections apart exactly
where an intermediate is used more than once and fuses them into one whole-stage-codegen span.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Step = Callable[[Column], Column]


class Rule:
    """A named chain of steps, usable as a plain column function."""

    def __init__(self, name: str, *parts: Rule | Step):
        self.name = name
        self.steps: tuple[Step, ...] = tuple(
            step for part in parts for step in (part.steps if isinstance(part, Rule) else (part,))
        )

    def __call__(self, value: Column | str) -> Column:
        start = F.col(value) if isinstance(value, str) else value
        return reduce(lambda column, step: step(column), self.steps, start)

    def after(self, prefix: Rule) -> Rule:
        """The rest of this rule for input that already went through ``prefix``."""
        n = len(prefix.steps)
        if self.steps[:n] != prefix.steps:
            raise ValueError(f"{self.name} does not start with {prefix.name}")
        return Rule(f"{self.name} after {prefix.name}", *self.steps[n:])

    def __repr__(self) -> str:
        return f"Rule({self.name})"


def only_if(value: Column, pattern: str, group: int = 0) -> Column:
    """The match of ``pattern`` (or one group of it), null where there is none."""
    return F.nullif(F.regexp_extract(value, pattern, group), F.lit(""))


def reuses_input(step: Step) -> Step:
    """Mark a step that mentions its input more than once."""
    step.reuses_input = True
    return step


def _segments(rule: Rule) -> list[list[Step]]:
    """Steps that may share one expression; a step that reuses its input starts a new segment."""
    segments: list[list[Step]] = [[]]
    for step in rule.steps:
        if getattr(step, "reuses_input", False) and segments[-1]:
            segments.append([])
        segments[-1].append(step)
    return segments


def apply_rules(
    df: DataFrame, targets: Mapping[str, tuple[Rule, str]], keep: Iterable[str] = ()
) -> DataFrame:
    """``keep`` columns unchanged, then one column per target: ``{new: (rule, source column)}``."""
    keep = list(keep)
    segments = {name: _segments(rule) for name, (rule, _) in targets.items()}
    current = {name: source for name, (_, source) in targets.items()}
    depth = max((len(parts) for parts in segments.values()), default=0)
    for level in range(depth):
        last = level == depth - 1
        working = {name: name if last else f"__rule_{i}" for i, name in enumerate(targets)}
        columns = []
        for name, parts in segments.items():
            steps = parts[level] if level < len(parts) else []
            value = reduce(lambda column, step: step(column), steps, F.col(current[name]))
            columns.append(value.alias(working[name]))
        df = df.select(*keep, *columns)
        current = working
    return df

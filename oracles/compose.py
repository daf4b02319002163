"""Small helpers for SQL text: shared expressions, and a WITH clause holding just the steps a query refers to."""

from __future__ import annotations

import re


def dbl(x: str) -> str:
    return f"({x})::DOUBLE"


def rnd(x: str, digits: int) -> str:
    """Half away from zero in plain double arithmetic."""
    scale = f"{10**digits}.0::DOUBLE"
    return f"(sign({dbl(x)}) * floor(abs({dbl(x)}) * {scale} + 0.5::DOUBLE) / {scale})"


def div(a: str, b: str) -> str:
    return f"({dbl(a)} / nullif({dbl(b)}, 0.0))"


def pct(a: str, b: str, digits: int = 1) -> str:
    return rnd(f"(100.0::DOUBLE * {dbl(a)}) / nullif({dbl(b)}, 0.0)", digits)


def big(x: str) -> str:
    return f"({x})::BIGINT"


def mean(x: str, where: str = "TRUE") -> str:
    f = f"FILTER (WHERE {where})"
    return f"(sum({x}) {f}::DOUBLE / nullif(count({x}) {f}::DOUBLE, 0.0))"


def union(rows: list[str]) -> str:
    return " UNION ALL ".join(rows)


def compose(steps: dict[str, str], query: str) -> str:
    """query, preceded by the steps it needs directly or through other steps."""
    needed: set[str] = set()
    todo = [query]
    while todo:
        words = set(re.findall(r"\w+", todo.pop()))
        for name in steps:
            if name in words and name not in needed:
                needed.add(name)
                todo.append(steps[name])
    if not needed:
        return query
    body = ",\n".join(f"{name} AS ({sql})" for name, sql in steps.items() if name in needed)
    return f"WITH {body}\n{query}"

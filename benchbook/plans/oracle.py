"""Puts the SQL of a query together with the domain tables that it names."""

from __future__ import annotations

import re

from benchbook.sources.domain import CTES


def with_tables(body: str) -> str:
    """body with a CTE for each domain table that it names, directly or through another."""
    wanted: list[str] = []

    def need(text: str) -> None:
        for name in CTES:
            if name not in wanted and re.search(rf"(?:FROM|JOIN|,)\s+{name}\b", text):
                need(CTES[name])
                if name not in wanted:
                    wanted.append(name)

    need(body)
    if not wanted:
        return body
    ctes = ",\n".join(f"{n} AS ({CTES[n]})" for n in wanted)
    rest = re.match(r"\s*WITH\s+(RECURSIVE\s+)?", body)
    return f"WITH {rest[1] or ''}{ctes}, {body[rest.end():]}" if rest else f"WITH {ctes}\n{body}"

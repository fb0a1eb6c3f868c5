"""Which tables a text of dotted regular expressions selects."""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import lru_cache

from deltaloom.catalog import TableId


def split_unescaped(text: str, mark: str) -> list[str]:
    """Parts between marks that no backslash escapes; an escaped comma loses its backslash."""
    out = re.split(rf"(?<!\\){re.escape(mark)}", text)
    return [x.replace("\\,", ",") if mark == "," else x for x in out]


@lru_cache(maxsize=4096)
def _patterns(text: str) -> tuple[tuple[re.Pattern, ...], ...]:
    out = []
    for one in split_unescaped(text, ","):
        parts = [p.replace("\\.", ".") for p in split_unescaped(one.strip(), ".")]
        if not 1 <= len(parts) <= 3 or not all(parts):
            raise ValueError(f"a table selector has one to three dotted parts: {one.strip()!r}")
        out.append(tuple(re.compile(p) for p in parts))
    return tuple(out)


class Selectors:
    """Comma-separated selectors; one matches a table of as many parts if each part matches in full. A plain dot parts
    names, an escaped one is any character; an escaped comma is a comma."""

    def __init__(self, text: str, exclude: str | None = None) -> None:
        self.patterns = _patterns(text)
        self.excluded = _patterns(exclude) if exclude else ()

    @staticmethod
    def _any(patterns: tuple, table: TableId) -> bool:
        return any(len(p) == len(table.parts) and all(x.fullmatch(y) for x, y in zip(p, table.parts, strict=True)) for p in patterns)

    def matches(self, table: TableId) -> bool:
        return self._any(self.patterns, table) and not self._any(self.excluded, table)

    def select(self, tables: Iterable[TableId]) -> list[TableId]:
        return [t for t in tables if self.matches(t)]

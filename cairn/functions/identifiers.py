"""Table names and identifier quoting."""

from __future__ import annotations

import re
from dataclasses import dataclass

_PLAIN = re.compile(r"[a-z_][a-z0-9_]*\Z")
_PART = re.compile(r'\s*(?:"((?:[^"]|"")+)"|([^".\s][^".]*?))\s*')


def quote(name: str) -> str:
    """Backtick-quoted for Spark SQL unless plain."""
    return name if _PLAIN.match(name) else "`" + name.replace("`", "``") + "`"


@dataclass(frozen=True)
class TableName:
    """``schema.table``: unquoted parts fold to lower case, the default schema is ``public``."""

    schema: str
    table: str

    @classmethod
    def parse(cls, text: str) -> TableName:
        parts, at = [], 0
        while True:
            found = _PART.match(text, at)
            if not found:
                raise ValueError(f"not a table name: {text}")
            parts.append(found[1].replace('""', '"') if found[1] is not None else found[2].lower())
            at = found.end()
            if at == len(text):
                break
            if text[at] != ".":
                raise ValueError(f"not a table name: {text}")
            at += 1
        if len(parts) > 2:
            raise ValueError(f"not a table name: {text}")
        return cls(*(["public", *parts] if len(parts) == 1 else parts))

    def sql(self) -> str:
        return f"{quote(self.schema)}.{quote(self.table)}"

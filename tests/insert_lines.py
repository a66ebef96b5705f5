"""INSERT lines taken apart one by one in Python: what the reader of dumps is compared with."""

from __future__ import annotations

import re

_HEAD = re.compile(r"""\s*INSERT\s+(?:LOW_PRIORITY\s+|DELAYED\s+|HIGH_PRIORITY\s+)?(?:IGNORE\s+)?(?:INTO\s+)?(?:`(?:[^`]|``)+`|[\w$]+)(?:\s*\.\s*(?:`(?:[^`]|``)+`|[\w$]+))?\s*(?:\((?:[^()'"`]|`(?:[^`]|``)+`)*\)\s*)?VALUES?\s*""", re.IGNORECASE)
_STRING = r"""'[^'\\]*+(?:(?:\\.|'')[^'\\]*+)*+'|"[^"\\]*+(?:(?:\\.|"")[^"\\]*+)*+\""""
_SPACE = re.compile(r"\s*")
_TOKEN = re.compile(rf"""\s*(?:(?P<str>(?:_\w+\s*)?(?:{_STRING}))|(?P<null>NULL\b)|(?P<bool>TRUE\b|FALSE\b)|(?P<hex>0x[0-9A-F]+\b|x'[0-9A-F]*')|(?P<float>[0-9]+\.[0-9]*(?:E[+-]?[0-9]+)?|\.[0-9]+(?:E[+-]?[0-9]+)?|[0-9]+E[+-]?[0-9]+)|(?P<int>[0-9]+)\b|(?P<unary>[-+~!]\s*(?:[0-9.]+(?:E[+-]?[0-9]+)?|NULL\b))|(?P<other>[\w$]+(?:\(\))?))\s*[,)]""", re.IGNORECASE | re.DOTALL)


def insert_values(line: str) -> list[list[dict[str, str | None]]] | None:
    """Rows of values of an INSERT line; none for any other line, null if an INSERT can't be read.

    String literals keep their backslashes; doubled quotes count as one.
    """
    head = _HEAD.match(line)
    if not head:
        return None if re.match(r"\s*INSERT\b", line, re.IGNORECASE) else []
    at, rows = head.end(), []
    while True:
        if line[at : at + 1] != "(":
            return None
        at += 1
        row: list[dict[str, str | None]] = []
        while True:
            m = _TOKEN.match(line, at)
            if not m:
                return None
            at = m.end()
            kind = m.lastgroup
            raw = m.group(kind)
            if kind == "str":
                quote = raw.lstrip()[0] if raw[0] in "'\"" else raw[min(i for i in (raw.find("'"), raw.find('"')) if i >= 0)]
                raw = raw[raw.index(quote) + 1 : -1].replace(quote * 2, quote)
            row.append({"kind": kind, "text": None if kind == "null" else raw})
            if line[at - 1] == ")":
                break
        rows.append(row)
        rest = _SPACE.match(line, at).end()
        if line[rest : rest + 1] == ",":
            at = _SPACE.match(line, rest + 1).end()
            continue
        tail = line[rest:].strip()
        return rows if tail in ("", ";") or re.match(r"(?i)ON\s+DUPLICATE\b|RETURNING\b", tail) else None

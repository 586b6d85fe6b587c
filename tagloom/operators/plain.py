"""The common case: rows that are nothing but simple child elements.

Nearly every row has no attributes, comments, entities or nested children. One
pattern recognises such a record as a whole, well formed and complete; its
values then are plain substrings, with no XML parser involved. Everything else
takes the general way of `tagloom.operators.rows`. Both give the same values and
refuse the same rows, so it does not matter which of them a row takes.

Of these records most have the children of a known table, each once and in declared order. One pattern per
table gives the texts of all of them at once; only for the others are children looked up one by one.
"""

from __future__ import annotations

import re
import string
from functools import reduce
from operator import or_

from pyspark.sql import Column, functions as F

from tagloom.spec import Registry, TableSpec

# The pattern recurses once per child element; longer records are parsed instead.
MAX_BYTES = 8192
# Single characters, not ranges, keep Java's pattern matcher on its bit table.
_SPACE = r"[ \t\r\n]*+"
_NAME = f"[{string.ascii_lowercase}_][{string.ascii_lowercase}{string.digits}" + r"_.\-]*+"
_TEXT = "[^<&" + "".join(rf"\x{i:02x}" for i in range(32) if chr(i) not in "\t\n") + "]*+"
# Not allowed in XML text besides what the pattern excludes.
_REFUSED = ("]]>", "\ufffe", "\uffff")
#: Stands before each text of a record in order; the pattern allows it in none.
_MARK = "\x01"


def _qualified(prefix: str) -> str:
    return f"{prefix}:" if prefix else ""


def row_pattern(registry: Registry, prefix: str = "") -> str:
    """Pattern of a plain record.

    Children are looked up by exact name in a plain record but regardless of case
    elsewhere, so a record with a declared name in another case does not match:
    names are lower case, or declared as they are. Names that tables spell in
    several ways do not match at all.
    """
    one, several = registry.spellings()
    mixed = [c for c in one if c != c.lower()]
    refused = "".join(rf"(?!{re.escape(c)}>)" for c in {*(c.lower() for c in [*mixed, *several])})
    names = "|".join([refused + _NAME, *map(re.escape, mixed)])
    q = re.escape(_qualified(prefix))
    child = rf"{_SPACE}<{q}({names})>{_TEXT}</{q}\2>"
    return rf"^([A-Za-z0-9_.\-]+)>(?:{child})*+{_SPACE}</{q}t_\1>{_SPACE}\z"


def is_plain(record: Column, registry: Registry, prefix: str = "") -> Column:
    return F.coalesce(
        (F.octet_length(record) <= MAX_BYTES)
        & record.rlike(row_pattern(registry, prefix))
        & ~reduce(or_, [record.contains(text) for text in _REFUSED])
        & F.is_valid_utf8(record),
        F.lit(False),
    )


def ordered_texts(record: Column, registry: Registry, prefix: str = "") -> Column:
    """The texts of all children of a plain record of a known table with its children in declared order, in that order behind an empty one.

    NULL for all other records. Optional children may be absent, then their text is empty; where they are not, a `<` is behind it.
    """
    joined = F.lit(None).cast("string")
    for spec in registry:
        pattern, texts = _ordered(spec, prefix)
        joined = F.when(record.startswith(f"{spec.name.removeprefix('t_')}>"), F.regexp_replace(record, pattern, texts)).otherwise(joined)
    # what is not UTF-8 has become U+FFFD; where there is one, the other ways tell
    clean = joined.startswith(_MARK) & ~reduce(or_, [joined.contains(text) for text in (*_REFUSED, "\ufffd")])
    return F.when((F.octet_length(record) <= MAX_BYTES) & clean, F.split(joined, _MARK))


def _ordered(spec: TableSpec, prefix: str) -> tuple[str, str]:
    """Pattern of such a record of one table, and what takes its place: the texts with marks before them."""
    q, children = re.escape(_qualified(prefix)), []
    for child in spec.children:
        name = q + re.escape(child)
        required = is_required(spec, child)
        children.append(f"{_SPACE}<{name}>({_TEXT})</{name}>" if required else f"(?:{_SPACE}<{name}>({_TEXT}<)/{name}>)?+")
    row = re.escape(spec.name.removeprefix("t_"))
    pattern = rf"^{row}>{''.join(children)}{_SPACE}</{q}t_{row}>{_SPACE}\z"
    return pattern, _MARK + _MARK.join(f"${i}" for i in range(1, len(children) + 1))


def is_required(spec: TableSpec, child: str) -> bool:
    """Whether a column needs the child."""
    return any(f.required for f in spec.fields if f.source == child)


def ordered_text(texts: Column, number: int, required: bool) -> Column:
    """One text of `ordered_texts`, of the child with that number from 0; NULL where it is absent."""
    text = F.get(texts, F.lit(number + 1))
    return text if required else F.when(text != "", F.substring_index(text, "<", 1))


def plain_tag(record: Column) -> Column:
    return F.concat(F.lit("t_"), F.substring_index(record, ">", 1))


def plain_child(record: Column, child: str, prefix: str = "") -> Column:
    """Text of the last child of that name, NULL where there is none."""
    opening = f"<{_qualified(prefix)}{child}>"
    value = F.substring_index(F.substring_index(record, opening, -1), "<", 1)
    return F.when(record.contains(opening), value)


def plain_elements(record: Column) -> Column:
    """The row and its children; every element of a plain record has an end tag."""
    rest = F.replace(record, F.lit("</"), F.lit(""))
    return ((F.octet_length(record) - F.octet_length(rest)) / 2).cast("bigint")

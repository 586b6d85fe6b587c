"""Fill-in-the-middle rearrangement of texts, in Arrow compute functions over whole batches.

A text is cut into units: white space and the word behind it, or white space at the end. Two
draws, hashed from the document's id, cut the units into prefix, middle and suffix; a
third chooses whether the text is rearranged at all, a fourth how.

Each batch of texts becomes one list array of units. Its flattened values carry their
parent and their ordinal in it; units are filtered by role, rebuilt into lists and
joined to one piece per text and role. No text is handled by itself in Python. Texts are
handled as bytes, since units end at ASCII white space, and a byte that no UTF-8 text
holds marks their ends.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from tagloom.llm.shared import ddl, quoted, text_parts

UNIT_END = b"\xff"
RESULTS = ("n", "form", "prefix_chars", "middle_chars", "output")


@dataclass(frozen=True)
class Marks:
    """Strings that begin the pieces. A text that holds one of them is left plain."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self):
        marks = (self.prefix, self.suffix, self.middle)
        inside = any("<" in m[1:] or ">" in m[:-1] for m in marks)
        if len(set(marks)) < 3 or inside or not all(m[:1] == "<" and m[-1:] == ">" for m in marks):
            raise ValueError("marks must differ and have < at their start and > at their end only")


def draws(doc_id: Column, seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers: the first eight-digit groups of SHA-256 of `seed:doc_id`."""
    digits = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digits, 1 + 8 * k, 8), 16, 10).cast("bigint") for k in range(4)]


def _modulo(a: pa.Array, b) -> pa.Array:
    return pc.subtract(a, pc.multiply(pc.divide(a, b), b))


def _grouped(values: pa.Array, counts: pa.Array) -> pa.Array:
    """Lists of the given sizes over `values`, each joined to one."""
    ends = pa.array(np.concatenate([[0], np.cumsum(counts.to_numpy(zero_copy_only=False))]), pa.int32())
    return pc.binary_join(pa.ListArray.from_arrays(ends, values), pa.scalar(b"", pa.binary()))


def _chars(pieces: pa.Array) -> pa.Array:
    return pc.cast(pc.utf8_length(pieces.view(pa.string())), pa.int64())


def rearrange(texts: pa.Array, h: list[pa.Array], fim_percent: int, spm_percent: int, marks: Marks) -> list[pa.Array]:
    """The columns RESULTS of some texts (binary, no nulls) with the draws h1 to h4."""
    ended = pc.replace_substring_regex(texts, pattern=rb"([^\x20\x09-\x0D])([\x20\x09-\x0D])", replacement=rb"\1" + UNIT_END + rb"\2")
    units = pc.split_pattern(ended, UNIT_END)
    empty = pc.equal(pc.binary_length(texts), 0)
    flat, parent = pc.list_flatten(units), pc.list_parent_indices(units)
    first = units.offsets.slice(0, len(units))
    ordinal = pc.cast(pc.subtract(pa.array(np.arange(len(flat)), pa.int64()), pc.take(pc.subtract(first, units.offsets[0]), parent)), pa.int64())
    found = pc.cast(pc.list_value_length(units), pa.int64())
    n = pc.if_else(empty, 0, found)
    cuts = [_modulo(draw, pc.add(n, 1)) for draw in h[:2]]
    lo, hi = pc.min_element_wise(*cuts), pc.max_element_wise(*cuts)
    after_lo = pc.greater_equal(ordinal, pc.take(lo, parent))
    after_hi = pc.greater_equal(ordinal, pc.take(hi, parent))
    prefix = _grouped(flat.filter(pc.invert(after_lo)), lo)
    middle = _grouped(flat.filter(pc.and_not(after_lo, after_hi)), pc.subtract(hi, lo))
    suffix = _grouped(flat.filter(after_hi), pc.subtract(found, hi))

    plain = pc.or_(empty, pc.greater_equal(_modulo(h[2], 100), fim_percent))
    for mark in (marks.prefix, marks.suffix, marks.middle):
        plain = pc.or_(plain, pc.match_substring(texts, mark.encode()))
    spm = pc.less(_modulo(h[3], 100), spm_percent)
    form = pc.if_else(plain, "plain", pc.if_else(spm, "spm", "psm"))
    p, s, m = (pa.scalar(x.encode(), pa.binary()) for x in (marks.prefix, marks.suffix, marks.middle))
    moved = pc.if_else(
        spm,
        pc.binary_join_element_wise(s, suffix, p, prefix, m, middle, b""),
        pc.binary_join_element_wise(p, prefix, s, suffix, m, middle, b""),
    )
    none = pa.scalar(None, pa.int64())
    return [n, form, pc.if_else(plain, none, _chars(prefix)), pc.if_else(plain, none, _chars(middle)), pc.if_else(plain, texts, moved).view(pa.string())]


def fill_in_middle(
    docs: DataFrame, fim_percent: int = 50, spm_percent: int = 80, seed: int = 42, marks: Marks = Marks()
) -> DataFrame:
    """(all columns of `docs`, n, form, prefix_chars, middle_chars, output) for each row.

    Needs doc_id and text; columns of `docs` named like a result are replaced, others, whatever
    their names, come back as they are. `n`: units of the text. `form`: `spm` (suffix, prefix,
    middle), `psm` (prefix, suffix, middle) or `plain` (the text as it is): empty texts, texts that
    hold a mark, and the rest of `fim_percent`. Lengths are code points of the pieces, null for
    plain. A null text is an empty one; a row without doc_id draws by the seed alone. Rows
    that repeat an id and a text get the same output. An empty table gives an empty one.
    """
    inner = [c for c in docs.columns if c not in RESULTS]
    rows = docs.select(F.coalesce(F.col("text"), F.lit("")), *draws(F.col("doc_id"), seed), *[docs[quoted(c)] for c in inner])
    rows = rows.toDF(*[f"c{k}" for k in range(len(rows.columns))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, texts in text_parts(batch.column(0)):
                part = batch.slice(lo, len(texts))
                made = rearrange(texts.cast(pa.binary()), part.columns[1:5], fim_percent, spm_percent, marks)
                yield pa.RecordBatch.from_arrays([*part.columns[5:], *made], [*inner, *RESULTS])

    schema = [ddl(docs.select(*[docs[quoted(c)] for c in inner]))] if inner else []
    return rows.mapInArrow(run, ", ".join([*schema, "n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"]))


def restored(output: Column, form: Column, marks: Marks = Marks()) -> Column:
    """The exact text, from the output and its form alone; each mark occurs once in a rearranged one."""

    def pieces(first: str, second: str) -> tuple[Column, Column, Column]:
        body = F.substring(output, F.lit(len(first) + 1), F.length(output))
        head, rest = (lambda c: F.substring_index(c, second, 1)), (lambda c: F.substring_index(c, second, -1))
        return head(body), F.substring_index(rest(body), marks.middle, 1), F.substring_index(rest(body), marks.middle, -1)

    suffix, prefix, middle = pieces(marks.suffix, marks.prefix)
    spm = F.concat(prefix, middle, suffix)
    prefix, suffix, middle = pieces(marks.prefix, marks.suffix)
    return F.when(form == "spm", spm).when(form == "psm", F.concat(prefix, middle, suffix)).otherwise(output)

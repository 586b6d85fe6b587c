"""Quality rules as a short-circuit cascade, ordered by rejection per cost.

A rule is a test of a text that rejects it or not. Rules share measures of the text, each
computed at most once and only when a rule asks for it. On a sample of the documents all
rules are timed and their rejections noted; then the rule that rejects most of what is
left per second comes first, and so on. The order decides how soon a text is rejected,
never whether: a text is kept if no rule rejects it.
"""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tagloom.llm.shared import BLANKS, ddl, quoted

SYMBOLS = b"#*$%&|<>"
WINDOW = 3
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


class Text:
    """Measures of one text, each computed when first asked for. Null counts as empty."""

    def __init__(self, text: str | None):
        self.text = text or ""

    @cached_property
    def data(self) -> bytes:
        return self.text.encode()

    @cached_property
    def words(self) -> list[bytes]:
        """Stretches between ASCII white space."""
        return self.data.split()

    @property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        """Code points outside white space."""
        return len(self.text) - sum(map(self.text.count, BLANKS))

    @cached_property
    def n_symbols(self) -> int:
        return sum(map(self.data.count, SYMBOLS))

    @cached_property
    def n_dup_lines(self) -> int:
        """Lines with a word that equal an earlier line."""
        lines = [line for line in self.data.split(b"\n") if line.strip()]
        return len(lines) - len(set(lines))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words in a window of three that the text has twice or more."""
        def windows():
            return zip(*(islice(self.words, k, None) for k in range(WINDOW)))

        total = max(0, self.n_words - WINDOW + 1)
        if len(set(windows())) == total:
            return 0
        found, covered, until = Counter(windows()), 0, 0
        for at, window in enumerate(windows()):
            if found[window] > 1:
                covered += at + WINDOW - max(at, until)
                until = at + WINDOW
        return covered


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Text], bool]


#: Fails that the base measures define.
BASE = (
    Rule("few_words", lambda t: t.n_words < 50),
    Rule("repetition", lambda t: 100 * t.n_repeat_words > 50 * t.n_words),
)
#: Bounds that prose of any language and ordinary lists keep well inside of.
FURTHER = (
    Rule("symbols", lambda t: 4 * t.n_symbols > t.n_words),
    Rule("word_length", lambda t: not 2 * t.n_words <= t.word_chars <= 20 * t.n_words),
    Rule("repeated_lines", lambda t: 2 * t.n_dup_lines > t.data.count(b"\n") + 1),
)
RULES = BASE + FURTHER


def _texts(column: pa.Array) -> Iterator[Text]:
    for value in column:
        yield Text(value.as_py())


def rule_order(docs: DataFrame, rules: Sequence[Rule] = RULES, sample_rows: int = 2000) -> list[Rule]:
    """The rules, the one with the most rejections per second among what is left first.

    Measured on about `sample_rows` documents chosen by a hash of the id (all of fewer). The
    measures a rule needs are counted into its cost. What comes back from the tasks is one
    row per set of rules that reject together: at most as many as sampled documents.
    """
    rows = docs.count()
    share = 1.0 if rows <= sample_rows else sample_rows / rows
    sample = docs.select("doc_id", "text").filter(
        F.pmod(F.xxhash64(F.lit("rule order"), "doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)) + 1
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            masks, costs = [], []
            for text in _texts(batch.column("text")):
                mask, cost = 0, []
                for k, rule in enumerate(rules):
                    fresh = Text(text.text)
                    start = time.perf_counter()
                    mask |= rule.rejects(fresh) << k
                    cost.append(time.perf_counter() - start)
                masks.append(mask)
                costs.append(cost)
            yield pa.RecordBatch.from_arrays(
                [pa.array(masks, pa.int64()), *(pa.array(c, pa.float64()) for c in (zip(*costs) if costs else [()] * len(rules)))],
                ["mask", *(f"c{k}" for k in range(len(rules)))],
            )

    schema = "mask bigint, " + ", ".join(f"c{k} double" for k in range(len(rules)))
    seen = (
        sample.mapInArrow(run, schema)
        .groupBy("mask")
        .agg(F.count("*").alias("n"), *[F.sum(f"c{k}").alias(f"c{k}") for k in range(len(rules))])
        .collect()
    )
    cost = [sum(row[f"c{k}"] for row in seen) + 1e-9 for k in range(len(rules))]
    order: list[int] = []
    while len(order) < len(rules):
        left = [row for row in seen if not any(row["mask"] >> k & 1 for k in order)]
        gain = {
            k: sum(row["n"] for row in left if row["mask"] >> k & 1) / cost[k]
            for k in range(len(rules)) if k not in order
        }
        order.append(max(gain, key=lambda k: (gain[k], -cost[k])))
    return [rules[k] for k in order]


def judge(
    docs: DataFrame,
    rules: Sequence[Rule] = RULES,
    measures: Sequence[str] = (),
    base: Sequence[Rule] = BASE,
    sample_rows: int = 2000,
    prefix: str = "",
) -> DataFrame:
    """(all columns of `docs`, *measures bigint, base_failed, kept) for each row.

    Needs doc_id and text; columns of `docs` named like a result are replaced. `prefix`: what the names
    of the results begin with. Rules run in the order `rule_order` finds, until one rejects. `kept`: no rule rejects. `base_failed`:
    a rule of `base` rejects; known for every row if `measures` are given, else null for rows that are
    not kept, as the cascade ends with the first rule that rejects. A null text counts as an empty one, which has no words and fails.
    """
    ordered = rule_order(docs, rules, sample_rows)
    results = [prefix + m for m in (*measures, "base_failed", "kept")]
    inner = [c for c in docs.columns if c not in results]
    place = inner.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in _texts(batch.column(place)):
                known = [getattr(text, m) for m in measures]
                failed = any(rule.rejects(text) for rule in base) if measures else None
                rejecting = next((rule for rule in ordered if rule.rejects(text)), None) if not failed else base[0]
                if not measures:
                    failed = False if rejecting is None else None
                rows.append([*known, failed, rejecting is None])
            columns = zip(*rows) if rows else [()] * (len(measures) + 2)
            kinds = [pa.int64()] * len(measures) + [pa.bool_()] * 2
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(c, k) for c, k in zip(columns, kinds))], [*inner, *results]
            )

    own = docs.select(*[docs[quoted(c)] for c in inner])
    kinds = [*["bigint"] * len(measures), "boolean", "boolean"]
    return own.mapInArrow(run, ", ".join([ddl(own), *(f"{quoted(r)} {k}" for r, k in zip(results, kinds))]))

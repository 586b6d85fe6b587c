"""Mixing documents to target weights by domain, where a document belongs to domains in part.

A naive-Bayes classifier learnt from the labelled table gives each document a posterior
over domains. A document's rate, the number of times it is expected in the mix, is found
by projected-gradient least squares: sum over documents of rate * tokens * posterior of a
domain shall be that domain's target, with no negative rate.

The gradient of a document depends on its posteriors alone, so rates do, too. Each step
sums over the corpus and brings one number per domain to the driver; the rate after any
number of steps is an expression of the posteriors with those numbers as constants.
"""

from __future__ import annotations

import math
import uuid
import warnings
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from tagloom.llm.shared import Scratch, quoted, unused

#: Domains of the labelled table, as conditions on its columns.
DOMAINS = {"good": "quality = 1 AND toxic = 0", "junk": "quality = 0", "toxic": "quality = 1 AND toxic = 1"}
WORD_BREAK = r"[\t-\r -@\[-`{-~]+"


def words(text: Column) -> Column:
    """Lower-cased stretches without ASCII white space, digits or punctuation; empty ones at the ends."""
    return F.split(F.lower(F.coalesce(text, F.lit(""))), WORD_BREAK)


def n_tokens(found: Column) -> Column:
    """How many of `words` are not empty."""
    ends = F.when(F.element_at(found, 1) == "", 1).otherwise(0) + F.when(
        (F.size(found) > 1) & (F.element_at(found, -1) == ""), 1
    ).otherwise(0)
    return (F.size(found) - ends).cast("bigint")


def _coarse(text: Column) -> Column:
    """Coarse measures of a text as marks: density of symbols, size, share of repeated lines."""
    text = F.coalesce(text, F.lit(""))
    symbols = F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))
    lines = F.split(text, "\n")
    return F.array(
        F.concat(F.lit("symbols="), F.least(F.lit(5), F.floor(40 * symbols / (F.length(text) + 1))).cast("string")),
        F.concat(F.lit("size="), F.least(F.lit(7), F.floor(F.log2(F.length(text) / 64 + 1))).cast("string")),
        F.concat(F.lit("repeats="), F.floor(4 * (1 - F.size(F.array_distinct(lines)) / F.size(lines))).cast("string")),
    )


@dataclass(frozen=True)
class Classifier:
    """Naive Bayes over the presence of marks. weights[m][k]: what mark m adds to domain k."""

    domains: tuple[str, ...]
    base: tuple[float, ...]
    weights: Mapping[str, tuple[float, ...]]
    fitted: bool

    def score(self, docs: DataFrame, tokens: str = "tokens", prefix: str = "p") -> DataFrame:
        """`docs` (with text), its tokens, and one column per domain, p0, p1, ..., that sum to one.

        All of the first domain if nothing was learnt. The steps are columns of their own,
        so that each is computed once.
        """
        k = range(len(self.domains))
        own = unused([*docs.columns, tokens, prefix])
        found, marked = f"{own}words", f"{own}marks"
        out = docs.withColumn(found, words(F.col("text"))).withColumn(tokens, n_tokens(F.col(found)))
        if not self.fitted:
            return out.drop(found).withColumns({f"{prefix}{i}": F.lit(float(i == 0)) for i in k})
        known = F.array(*map(F.lit, self.weights)).cast("array<string>")
        marks = F.concat(F.array_intersect(found, known), F.array_intersect(_coarse(F.col("text")), known))
        out = out.withColumn(marked, marks).drop(found)
        scores = {f"{own}s{i}": self._score(i, marked) for i in k}
        out = out.withColumns(scores).drop(marked)
        most = F.greatest(*map(F.col, scores))
        out = out.withColumns({s: F.exp(F.col(s) - most) for s in scores})
        total = sum((F.col(s) for s in scores), F.lit(0.0))
        out = out.withColumns({f"{prefix}{i}": F.round(F.col(f"{own}s{i}") / total, 6) for i in k})
        return out.drop(*scores)

    def _score(self, k: int, marks: str) -> Column:
        if not self.weights:
            return F.lit(self.base[k])
        table = F.map_from_arrays(
            F.array(*map(F.lit, self.weights)), F.array(*[F.lit(w[k]) for w in self.weights.values()])
        )
        return F.aggregate(marks, F.lit(self.base[k]), lambda total, mark: total + F.element_at(table, mark))


def fit(
    docs: DataFrame, labels: DataFrame, domains: Mapping[str, str] = DOMAINS,
    most_rows: int = 20_000, most_marks: int = 64, least_docs: int = 5, least_gain: float = 30.0,
    least_gap: float = 2.5,
) -> Classifier:
    """Learn domains from labelled documents (labels: doc_id and the columns `domains` names).

    `most_rows` bounds the labelled rows fitted on, in expectation; they are picked by a hash
    of doc_id, so their ids can be broadcast and no text is shuffled. Marks of at least
    `least_docs` documents whose presence tells domains apart (G statistic from
    `least_gain`, log-odds of two domains at least `least_gap` apart) are used, the `most_marks`
    best of them; marks that tell little are many, go together and would be counted again and again. Labels that fit no domain, that
    are null or have no document are passed over.
    """
    rows = labels.count()
    share = min(1.0, most_rows / max(rows, 1))
    case = F.coalesce(*[F.when(F.expr(c), F.lit(k)) for k, c in enumerate(domains.values())])
    picked = labels.select("doc_id", case.alias("k")).filter(
        F.pmod(F.xxhash64(F.lit("mixing"), "doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)) + 1
    ).filter("k IS NOT NULL")
    marked = docs.join(F.broadcast(picked), "doc_id").select(
        "k", F.concat(F.array_distinct(words(F.col("text"))), _coarse(F.col("text"))).alias("marks")
    )
    each = [F.count_if(F.col("k") == k).alias(f"n{k}") for k in range(len(domains))]
    per_mark = marked.select("k", F.explode("marks").alias("mark")).groupBy("mark").agg(*each)
    sizes = marked.agg(*each).first()
    n = [sizes[f"n{k}"] for k in range(len(domains))]
    if sum(x > 0 for x in n) < 2:
        return Classifier(tuple(domains), (0.0,) * len(n), {}, False)
    total = sum(n)
    held = sum((F.col(f"n{k}") for k in range(len(n))), F.lit(0))

    def part(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(F.lit(0.0))

    gain = sum(
        (part(F.col(f"n{k}"), held * (n[k] / total)) + part(n[k] - F.col(f"n{k}"), (total - held) * (n[k] / total))
         for k in range(len(n)) if n[k]),
        F.lit(0.0),
    )
    logits = [F.log((F.col(f"n{k}") + 0.5) / (n[k] - F.col(f"n{k}") + 0.5)) for k in range(len(n)) if n[k]]
    best = (
        per_mark.filter(held >= least_docs)
        .filter(F.greatest(*logits) - F.least(*logits) >= least_gap).withColumn("gain", 2 * gain).filter(F.col("gain") >= least_gain)
        .orderBy(F.desc("gain"), "mark").limit(most_marks).collect()
    )
    odds = lambda seen, of: math.log((seen + 0.5) / (of - seen + 0.5))
    weights = {r["mark"]: tuple(round(odds(r[f"n{k}"], n[k]), 9) for k in range(len(n))) for r in best}
    base = tuple(
        round(math.log((n[k] + 0.5) / total) + sum(math.log((n[k] - r[f"n{k}"] + 0.5) / (n[k] + 1)) for r in best), 9)
        for k in range(len(n))
    )
    return Classifier(tuple(domains), base, weights, True)


def rate(posteriors: Sequence[Column], steps: Sequence[Sequence[float]], most: float | None = None) -> Column:
    """The rate after projected steps from 1; a step takes its dot product with the posteriors.

    The steps are a constant array, not constants in the code, so that Spark compiles the
    same expression once however many steps are tried.
    """
    if not steps:
        return F.lit(1.0)

    def move(value: Column, step: Column) -> Column:
        moved = value - sum((p * step[k] for k, p in enumerate(posteriors)), F.lit(0.0))
        return F.least(F.lit(float("inf") if most is None else float(most)), F.greatest(F.lit(0.0), moved))

    return F.aggregate(F.array(*[F.array(*map(F.lit, s)) for s in steps]), F.lit(1.0), move)


def solve(
    cells: DataFrame, weights: Sequence[float], anchor: int | None = None, most: float | None = None,
    tolerance: float = 1e-6, most_steps: int = 25,
) -> list[list[float]]:
    """Steps of projected gradient for `rate`. cells: tokens, p0, p1, ... (equal posteriors summed up).

    Targets are `weights` (normalised) of all tokens, or, with `anchor`, so many that this
    domain's target is the tokens it has. A domain's miss is weighed by the tokens it has
    and a document's move by its own, so that the plain gradient step is at most as long
    as it may be. Each pass over the cells tries that step and multiples of the one scaled by
    the curvature (domains by domains), and takes the best; it ends when targets are met
    to `tolerance`, or no step brings them nearer. Domains without tokens are left out.
    """
    k = range(len(weights))
    ps = [F.col(f"p{i}") for i in k]

    def tried(paths: list[list[list[float]]]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Token totals and curvature of each path."""
        sums = []
        for c, path in enumerate(paths):
            r = F.col(f"r{c}")
            moves = F.col("tokens") * ((r > 0) if most is None or not path else (r > 0) & (r < most)).cast("double")
            sums += [F.sum(F.col("tokens") * r * p).alias(f"x{c}_{i}") for i, p in enumerate(ps)]
            sums += [F.sum(moves * ps[i] * ps[j]).alias(f"m{c}_{i}_{j}") for i in k for j in k if i <= j]
        rated = cells.select("*", *[rate(ps, path, most).alias(f"r{c}") for c, path in enumerate(paths)])
        row = rated.agg(*sums).first()
        get = lambda name: float(row[name] or 0.0)
        return [
            (np.array([get(f"x{c}_{i}") for i in k]),
             np.array([[get(f"m{c}_{min(i, j)}_{max(i, j)}") for j in k] for i in k]))
            for c in range(len(paths))
        ]

    steps: list[list[float]] = []
    now, curvature = tried([steps])[0]
    have, share = now.copy(), np.array(weights, float) / sum(weights)
    targets = share * (have.sum() if anchor is None else have[anchor] / share[anchor])
    scale = np.where(have > 0, have, np.inf)
    miss = lambda x: float((((x - targets) ** 2) / scale).sum())
    while len(steps) < most_steps and np.max(np.abs(now - targets) / scale) > tolerance:
        plain = (now - targets) / scale
        scaled = np.linalg.lstsq(curvature, np.where(have > 0, now - targets, 0.0), rcond=1e-9)[0]
        moves = [[round(float(v), 12) for v in m] for m in (plain, scaled, scaled / 2, scaled / 8)]
        found = tried([[*steps, m] for m in moves])
        best = min(range(len(moves)), key=lambda c: miss(found[c][0]))
        if not miss(found[best][0]) < miss(now) * (1 - 1e-4):
            break
        steps.append(moves[best])
        now, curvature = found[best]
    off = float(np.max(np.abs(now - targets) / scale))
    if off > tolerance:
        warnings.warn(f"after {len(steps)} steps a domain is {off:.2%} of its tokens off its target", stacklevel=2)
    return steps


def mix(
    docs: DataFrame, labels: DataFrame, weights: Mapping[str, float], domains: Mapping[str, str] = DOMAINS,
    anchor: str | None = None, most: float | None = None, scratch: Scratch | None = None, seed: int = 7,
    keep: Sequence[str] | None = None, prefix: str = "_", **fitting,
) -> DataFrame:
    """(columns of `docs`, _tokens, _p0.._pk posteriors, _rate, _copies) for each row.

    `_rate` is a nonnegative number; `_copies` is its whole part, plus one with the
    probability of the rest, drawn from a hash of doc_id: the same in every run. `most`
    bounds the rate. Rows without words weigh nothing and get the rate of their posteriors.
    Without labelled rows of two domains nothing can be told apart, and all rates are 1.
    `keep`: the columns of `docs` that come back, by default all; `prefix`: what the names of the results
    begin with; columns of `docs` that have such a name are replaced.

    Texts are scored once: scores are written with what comes back, and the rates are found
    and given on that table. A warning tells when the targets are not met.
    """
    scratch = scratch or Scratch(docs.sparkSession)
    model = fit(docs.select("doc_id", "text"), labels, domains, **fitting)
    names = [f"{prefix}p{k}" for k in range(len(domains))]
    made = [f"{prefix}tokens", *names, f"{prefix}rate", f"{prefix}copies"]
    kept = [c for c in (docs.columns if keep is None else keep) if c not in made]
    needed = dict.fromkeys([*kept, "doc_id", "text"])
    scored = model.score(docs.select(*map(quoted, needed)), made[0], f"{prefix}p")
    draw = f"{unused(kept, prefix + 'u')}nit"
    unit = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 40)) / float(1 << 40)
    scored = scratch.keep(_once(scored).select(*map(quoted, kept), made[0], *names, unit.alias(draw)))
    steps = []
    if model.fitted:
        cells = scratch.keep(
            scored.groupBy(*[F.col(n).alias(f"p{k}") for k, n in enumerate(names)]).agg(F.sum(made[0]).alias("tokens"))
        )
        steps = solve(cells, [weights[d] for d in domains], list(domains).index(anchor) if anchor else None, most)
        scratch.drop(cells)
    rated = _once(scored.withColumn(made[-2], F.round(rate([F.col(n) for n in names], steps, most), 6)))
    whole = F.floor(made[-2])
    more = F.when(F.col(draw) < F.col(made[-2]) - whole, 1).otherwise(0)
    return _once(rated.withColumn(made[-1], (whole + more).cast("int")).drop(draw))


def _once(frame: DataFrame) -> DataFrame:
    """A filter above would move below the scores and compute them again for each use; it stops here."""
    return frame.observe(f"mixed_{uuid.uuid4().hex}", F.count("*").alias("rows"))

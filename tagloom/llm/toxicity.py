"""Toxicity by multiple-instance learning: labels of documents, scores of sentences.

A document is toxic if any of its sentences is. Sentence scores are logistic in the words
a sentence has of a learnt lexicon; they combine by noisy-or, with a leak for documents
whose label no sentence explains. The weights are fitted to document labels through the
noisy-or, so no sentence needs a label, and sentences can be ranked afterwards.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

SENTENCE = re.compile(r"[^.!?\n]*[.!?\n]*")
WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Model:
    """A sentence with lexicon words scores sigmoid(bias + their weights); others 0. `leak`: a document's without any."""

    weights: dict[str, float]
    bias: float
    leak: float

    def sentences(self, text: str) -> list[tuple[int, int, float]]:
        """(start, end, score) in code points of each sentence with a lexicon word."""
        lower = text.lower()
        if len(lower) != len(text) or not self.weights:  # letters that change length: keep the places
            lower = "".join(c if len(c.lower()) != 1 else c.lower() for c in text)
        found: dict[tuple[int, int], set[str]] = {}
        ends = None
        for hit in WORD.finditer(lower):
            if hit.group() in self.weights:
                if ends is None:
                    ends = np.array([m.end() for m in SENTENCE.finditer(text)])
                k = int(np.searchsorted(ends, hit.start(), side="right"))
                span = (int(ends[k - 1]) if k else 0, int(ends[k]))
                found.setdefault(span, set()).add(hit.group())
        total = lambda words: self.bias + sum(self.weights[w] for w in sorted(words))
        return [(a, b, float(_sigmoid(np.float64(total(w))))) for (a, b), w in found.items()]

    def score(self, scores: list[float]) -> float:
        """Noisy-or of sentence scores and the leak."""
        return float(1 - (1 - self.leak) * np.prod([1 - p for p in scores]))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def held_out(doc_id: Column) -> Column:
    """Whether a row's label is kept for evaluation: crc32 of the id as text leaves 2 by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(
    docs: DataFrame, labels: DataFrame, most_rows: int = 20_000, most_words: int = 500,
    least_docs: int = 3, least_gain: float = 24.0, decay: float = 1e-3, steps: int = 400,
) -> Model:
    """Learn from labelled documents (labels: doc_id, toxic) that are not held out.

    At most about `most_rows` labelled rows are fitted on, picked by a hash of doc_id; their
    ids are broadcast. The lexicon is found by counts over them: words of at least
    `least_docs` documents that speak for toxicity (G statistic from `least_gain`), the
    `most_words` best. The driver gets, per document, its label and the lexicon words of its
    sentences, and fits the noisy-or by gradient ascent. Null labels and labels without a
    document are passed over; without both classes the model scores everything 0.
    """
    usable = labels.select("doc_id", F.col("toxic").cast("int").alias("y")).filter("y IN (0, 1)").filter(~held_out(F.col("doc_id")))
    share = min(1.0, most_rows / max(usable.count(), 1))
    picked = usable.filter(F.pmod(F.xxhash64(F.lit("toxicity"), "doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)) + 1)
    picked = picked.groupBy("doc_id").agg(F.max("y").alias("y"))
    rows = docs.select("doc_id", "text").filter("text IS NOT NULL").join(F.broadcast(picked), "doc_id")
    words = rows.select("y", F.explode(F.array_distinct(F.split(F.lower("text"), r"[^\p{L}]+"))).alias("word"))
    counts = words.groupBy("word").agg(F.count("*").alias("n"), F.sum("y").alias("t")).filter(F.col("n") >= least_docs)
    size = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("y"), F.lit(0)).alias("t")).first()
    if not 0 < size["t"] < size["n"]:
        return Model({}, 0.0, 0.0)
    base = size["t"] / size["n"]
    n, t = F.col("n"), F.col("t")
    part = lambda seen, expected: F.when(seen > 0, seen * F.log(seen / expected)).otherwise(F.lit(0.0))
    gain = 2 * (part(t, n * base) + part(n - t, n * (1 - base)))
    lexicon = [
        r["word"]
        for r in counts.filter((t > n * base) & (F.length("word") > 1)).withColumn("gain", gain)
        .filter(F.col("gain") >= least_gain).orderBy(F.desc("gain"), "word").limit(most_words).collect()
    ]
    finder = Model(dict.fromkeys(lexicon, 0.0), 0.0, 0.0)
    place = {w: i for i, w in enumerate(lexicon)}

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text in batch.column("text"):
                value = text.as_py()
                spans = finder.sentences(value)
                found.append([sorted({place[w] for w in WORD.findall(value[a:b].lower()) if w in place}) for a, b, _ in spans])
            yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array(found, pa.list_(pa.list_(pa.int32())))], ["y", "s"])

    bags = rows.select("y", "text").mapInArrow(hits, "y int, s array<array<int>>").collect()
    return _train(lexicon, [r["y"] for r in bags], [r["s"] for r in bags], decay, steps)


def _train(lexicon: list[str], labels: list[int], bags: list[list[list[int]]], decay: float, steps: int) -> Model:
    y = np.array(labels, float)
    doc, cell_s, cell_w = [], [], []
    for d, bag in enumerate(bags):
        for sentence in bag:
            for w in sentence:
                cell_s.append(len(doc))
                cell_w.append(w)
            doc.append(d)
    doc, cell_s, cell_w = (np.array(x, np.int64) for x in (doc, cell_s, cell_w))
    w = np.full(len(lexicon), 1.0)
    bare = np.bincount(doc, minlength=len(y)) == 0
    leak = float(np.clip(y[bare].mean() if bare.any() else 0.01, 1e-4, 0.2))
    params, first, second = np.append(w, -1.0), 0.0, 0.0
    for step in range(1, steps + 1):
        z = params[-1] + np.bincount(cell_s, params[cell_w], minlength=len(doc))
        p = _sigmoid(z)
        none = np.log1p(-leak) + np.bincount(doc, np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=len(y))
        toxic = -np.expm1(none)
        pull = np.where(y > 0, np.exp(none) / np.maximum(toxic, 1e-12), -1.0)
        dz = pull[doc] * p
        slope = np.append(np.bincount(cell_w, dz[cell_s], minlength=len(lexicon)), dz.sum()) / max(len(y), 1)
        slope -= decay * params
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        params = params + 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
    return Model({word: round(float(v), 6) for word, v in zip(lexicon, params)}, round(float(params[-1]), 6), round(leak, 6))


def score(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """(doc_id, score, predicted int, sentences array<struct<start, end, score>>) of every row of `docs`.

    `sentences` are the offending ones, worst first, by code points of the text; whole texts
    are read. A null or empty text has no sentences and scores the leak.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
        for batch in batches:
            scores, places = [], []
            for text in batch.column("text"):
                found = model.sentences(text.as_py() or "")
                scores.append(model.score([p for _, _, p in found]))
                places.append([{"start": a, "end": b, "score": p} for a, b, p in sorted(found, key=lambda x: (-x[2], x[0]))])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores, pa.float64()), pa.array([int(s >= threshold) for s in scores], pa.int32()), pa.array(places, kind)],
                ["doc_id", "score", "predicted", "sentences"],
            )

    columns = docs.select("doc_id", "text")
    id_type = columns.schema["doc_id"].dataType.simpleString()
    return columns.mapInArrow(
        run, f"doc_id {id_type}, score double, predicted int, sentences array<struct<start:int,end:int,score:double>>"
    )

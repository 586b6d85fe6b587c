"""Quality cascade, line dedup, mixing, BPE and toxicity against plain versions of themselves."""

from __future__ import annotations

import hashlib
import os
import random
import re
import subprocess
import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tagloom.llm import bpe, linededup, mixing, quality, toxicity
from tagloom.llm.quality import MEASURES, RULES, Rule, Text

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
ODD_TEXTS = [
    None, "", " ", "\n\n", "a", "a b\x0bc\x1cd\x85e f", "ΑΣ ΣΑΣ İstanbul ́x", "x<|startoftext|>y <|endoftext|",
    "日本語 👩‍👧 12 it's ###", "aaaa " * 3000, "q" * 30_000, "A\r\nb\rA\r\n", "\x00�\U0010fffd",
]


def frame(spark, rows, schema="doc_id long, text string, n_words string, ids int, _keep int, kept long, mask int"):
    width = schema.count(",") + 1
    return spark.createDataFrame([(*r, *[None] * (width - len(r))) for r in rows], schema)


# --- quality -----------------------------------------------------------------


def plain_measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    seen = Counter(windows)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
        len({k + j for k, w in enumerate(windows) if seen[w] > 1 for j in range(3)}),
    )


def test_measures_equal_their_definitions():
    rng = random.Random(0)
    made = ["".join(rng.choice("ab c\n#|\t") for _ in range(rng.randrange(80))) for _ in range(400)]
    for text in ODD_TEXTS + made:
        assert tuple(getattr(Text(text), m) for m in MEASURES) == plain_measures(text), repr(text)


def test_judging_is_the_conjunction_of_the_rules_in_any_order(spark):
    rng = random.Random(1)
    made = [" ".join(rng.choice(["alpha", "beta", "###", "gamma\nx", "d"]) for _ in range(rng.randrange(200))) for _ in range(60)]
    rows = list(enumerate(ODD_TEXTS + made)) + [(None, made[0]), (3, "\n\n")]
    docs = frame(spark, rows)
    expected = sorted(
        (str(d), *plain_measures(t), plain_measures(t)[0] < 50 or 100 * plain_measures(t)[4] > 50 * plain_measures(t)[0],
         not any(r.rejects(Text(t)) for r in RULES))
        for d, t in rows
    )
    for rules in (RULES, RULES[::-1]):
        found = quality.judge(docs, rules, MEASURES, sample_rows=10).select("doc_id", *MEASURES, "base_failed", "kept")
        assert sorted((str(r[0]), *r[1:]) for r in found.collect()) == expected
    bare = quality.judge(docs)
    assert bare.columns == ["doc_id", "text", "n_words", "ids", "_keep", "mask", "base_failed", "kept"]
    assert sorted((str(r["doc_id"]), r["kept"]) for r in bare.collect()) == sorted((e[0], e[-1]) for e in expected)
    assert quality.judge(docs.limit(0), measures=MEASURES).collect() == []


def test_the_rule_with_more_rejections_per_second_comes_first(spark):
    import time

    docs = spark.range(40).selectExpr("id AS doc_id", "CAST(id AS STRING) AS text")
    slow = Rule("slow", lambda t: time.sleep(0.002) or int(t.text) % 2 == 0)
    weak = Rule("weak", lambda t: int(t.text) == 1)
    quick = Rule("quick", lambda t: int(t.text) % 2 == 0)
    assert [r.name for r in quality.rule_order(docs, [slow, weak, quick])] == ["quick", "weak", "slow"]


# --- lines -------------------------------------------------------------------


def plain_lines(rows, min_docs, keep_first):
    """A key in so many documents, told apart by their ids, loses its lines in every row; a row without id is no document."""
    blanks, lower = " \t\n\x0b\x0c\r", str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda line: line.strip(blanks).translate(lower)
    documents, first = {}, {}
    for d, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        for p, line in enumerate((text or "").split("\n")):
            if key(line):
                documents.setdefault(key(line), set()).update({d} - {None})
                first.setdefault(key(line), (d, text, p))
    gone = {k for k, ids in documents.items() if len(ids) >= min_docs}
    out = []
    for d, text in rows:
        lines = (text or "").split("\n")
        kept = [x for p, x in enumerate(lines) if key(x) not in gone or keep_first and first[key(x)] == (d, text, p)]
        out.append((d, len(lines) - len(kept), "\n".join(kept) if len(kept) < len(lines) else text))
    return sorted(out, key=repr)


@pytest.mark.parametrize("min_docs,keep_first", [(2, True), (2, False), (4, False), (1, True)])
def test_line_bitmaps_equal_brute_force(spark, min_docs, keep_first):
    rng = random.Random(min_docs)
    pool = ["The End", " the end\t", "É", "é", "", " ", "x", "y", "z\r", "\x0bZ", "only"] + [f"l{k}" for k in range(40)]
    rows = [(k, "\n".join(rng.choice(pool) for _ in range(rng.choice([1, 3, 150])))) for k in range(30)]
    rows += [(100, None), (101, ""), (102, "x"), (102, "x"), (None, "x\ny"), (None, None)]
    if not keep_first:  # rows that share an id and differ
        rows += [(5, "rare one\nrare two\nx"), (5, "x\nown 5"), (5, None), (None, "rare two\nthe END")]
    docs = frame(spark, rows, "doc_id long, text string, n_words string, ids int, _keep int, _id long, text_hash int, h int, _hash int")
    bitmaps = linededup.keep_bitmaps(docs, min_docs=min_docs, keep_first=keep_first)
    found = linededup.apply_bitmaps(docs, bitmaps, "mine")
    text, keep = F.col("text"), F.col("mine")
    out = found.select("doc_id", linededup.dropped_lines(text, keep), linededup.kept_text(text, keep))
    assert sorted(map(tuple, out.collect()), key=repr) == plain_lines(rows, min_docs, keep_first)
    assert found.columns == [*docs.columns, "mine"]
    assert linededup.keep_bitmaps(docs.limit(0)).collect() == []


def test_rows_decide_for_themselves_not_for_their_ids(spark):
    rows = [(k, "Common line\nown") for k in range(10, 30)] + [(5, "rare one\nrare two"), (5, "common LINE\nown 5"), (None, " common line\t\nmine")]
    docs = frame(spark, rows)
    found = linededup.apply_bitmaps(docs, linededup.keep_bitmaps(docs, min_docs=10, keep_first=False))
    out = found.filter("doc_id = 5 OR doc_id IS NULL").select("doc_id", linededup.kept_text(F.col("text"), F.col("_keep")))
    assert sorted(map(tuple, out.collect()), key=repr) == [(5, "own 5"), (5, "rare one\nrare two"), (None, "mine")]


# --- mixing ------------------------------------------------------------------


def mixing_tables(spark):
    rng = random.Random(5)
    docs, labels = [], []
    for k in range(300):
        kind = k % 3
        words = [rng.choice(["alpha", "beta", "gamma", "delta", "rho"]) for _ in range(rng.randrange(5, 60))]
        words += [["fine"], ["junky", "$$$$$$$$$"], ["nasty"]][kind]
        docs.append((k, " ".join(words), "en", "s", 1))
        if k % 2:
            labels.append((k, int(kind != 1), int(kind == 2)))
    docs += [(900, None, None, None, None), (901, "", "x", "y", 0), (902, docs[0][1], "en", "s", 1), (None, "alpha", "", "", 1)]
    labels += [(902, None, None), (5000, 1, 1), (1, None, 0)]
    return (
        spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, p0 long"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )


def test_rates_meet_the_targets_and_equal_projected_gradient(spark):
    docs, labels = mixing_tables(spark)
    weights = {"good": 0.5, "junk": 0.2, "toxic": 0.3}
    found = mixing.mix(docs, labels, weights, least_docs=3, least_gain=10.0).toPandas()
    assert len(found) == docs.count() and list(found.columns[:5]) == docs.columns
    p, tokens, rate = found[["_p0", "_p1", "_p2"]].to_numpy(), found["_tokens"].to_numpy(float), found["_rate"].to_numpy()
    assert (rate >= 0).all() and np.allclose(p.sum(1), 1, atol=1e-5)
    targets = np.array(list(weights.values())) * tokens.sum()
    assert np.allclose((rate * tokens) @ p, targets, rtol=1e-4)
    have, plain = tokens @ p, np.ones(len(found))
    for _ in range(20_000):
        plain = np.maximum(0, plain - p @ (((plain * tokens) @ p - targets) / have))
    assert np.allclose(plain, rate, atol=0.02)
    assert (abs(found["_copies"] - rate) < 1).all()
    truth = found[found.doc_id < 900]
    assert (truth[["_p0", "_p1", "_p2"]].to_numpy().argmax(1) == truth.doc_id % 3).all()


def test_the_anchor_keeps_its_tokens_and_no_rate_passes_the_bound(spark):
    docs, labels = mixing_tables(spark)
    found = mixing.mix(
        docs, labels, {"clean": 0.98, "toxic": 0.02}, {"clean": "toxic = 0", "toxic": "toxic = 1"}, "clean", 1.0,
        least_docs=3, least_gain=10.0,
    ).toPandas()
    assert found["_rate"].max() <= 1
    clean = found[(found.doc_id < 900) & (found.doc_id % 3 != 2)]
    assert (clean["_copies"] == 1).all()
    assert found[(found.doc_id < 900) & (found.doc_id % 3 == 2)]["_rate"].max() < 0.5


@pytest.mark.parametrize("labelled", [0, 1])
def test_without_two_domains_all_rates_are_one(spark, labelled):
    docs, labels = mixing_tables(spark)
    found = mixing.mix(docs, labels.filter("doc_id = 3").limit(labelled), {"good": 0.9, "junk": 0.05, "toxic": 0.05})
    assert {tuple(r) for r in found.select("_rate", "_copies").collect()} == {(1.0, 1)}
    assert mixing.mix(docs.limit(0), labels, {"good": 0.9, "junk": 0.05, "toxic": 0.05}).collect() == []


# --- BPE ---------------------------------------------------------------------


def test_encoding_equals_the_library_and_decodes_to_its_text(spark):
    library = Tokenizer.from_file(VOCABULARY)
    rng = random.Random(2)
    alphabets = ["ab", "abcdefghijklmnopqrstuvwxyz ", "äöüéè' \n", "aA!?#. 12", "".join(map(chr, range(0x100, 0x3000, 37)))]
    made = ["".join(rng.choice(a) for _ in range(rng.randrange(60))) for a in alphabets for _ in range(60)]
    rows = list(enumerate(ODD_TEXTS + made)) + [(3, "again"), (3, "again"), (None, "none")]
    found = bpe.decode(bpe.encode(frame(spark, rows), VOCABULARY), VOCABULARY).collect()
    expected = []
    for d, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        expected.append((d, ids, library.decode(ids, skip_special_tokens=False)))
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)
    assert sorted(map(tuple, bpe.encode(frame(spark, rows), VOCABULARY, decoded=True).collect()), key=repr) == sorted(expected, key=repr)
    assert bpe.encode(frame(spark, rows).limit(0), VOCABULARY).collect() == []


def test_workers_need_no_package(tmp_path):
    """Encoding from a folder and an environment in which workers cannot import the library."""
    script = f"""
import sys
sys.path.insert(0, {str(Path(__file__).resolve().parents[2])!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
from tagloom.llm import bpe
docs = spark.createDataFrame([(1, "hello world")], "doc_id long, text string")
seen = docs.mapInArrow(lambda batches: (b for b in batches if __import__("importlib").util.find_spec("tagloom") is None), "doc_id long, text string")
print("ids", bpe.encode(seen, {VOCABULARY!r}, decoded=True).first().ids)
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    ids = Tokenizer.from_file(VOCABULARY).encode("hello world", add_special_tokens=False).ids
    assert f"ids {ids}" in out.stdout, out.stderr[-2000:]


def test_every_reachable_token_encodes_to_itself():
    vocabulary = bpe.Vocabulary.read(VOCABULARY)
    encoder = bpe.Encoder(vocabulary)
    for token in range(0, 49_406, 7):
        text = vocabulary.tokens[token]
        if vocabulary.usable[token] and text.endswith(vocabulary.ending):
            assert encoder.word(text.removesuffix(vocabulary.ending)) == [token]


# --- toxicity ----------------------------------------------------------------


def toxic_tables(spark):
    rng = random.Random(9)
    docs, labels = [], []
    for k in range(400):
        words = [rng.choice(["sun", "moon", "tree", "river", "stone"]) + rng.choice([".", "", "", " x", "\n"]) for _ in range(40)]
        toxic = k % 5 == 0
        if toxic:
            words[rng.randrange(40)] = rng.choice(["Moron!", "scum", "you idiot."])
        docs.append((k, " ".join(words)))
        labels.append((k, 1, int(toxic)))
    docs += [(900, None), (901, ""), (902, "İ scum. fine"), (None, "idiot"), (903, "a. " * 20_000 + "moron.")]
    labels += [(900, 1, 1), (7000, 1, 1), (3, None, None)]
    return frame(spark, docs, "doc_id long, text string, score int, y int"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxic_documents_and_their_sentences_are_found_on_held_out_rows(spark):
    docs, labels = toxic_tables(spark)
    model = toxicity.fit(docs, labels)
    assert set(model.weights) >= {"moron", "scum", "idiot"}
    found = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    texts = dict(map(tuple, docs.select("doc_id", "text").collect()))
    out = [k for k in range(400) if zlib.crc32(str(k).encode()) % 4 == 2]
    assert len(out) > 60 and all(found[k]["predicted"] == (k % 5 == 0) for k in out)
    for k in out:
        if k % 5 == 0:
            worst = found[k]["sentences"][0]
            assert re.search("moron|scum|idiot", texts[k][worst["start"] : worst["end"]].lower())
    assert found[900]["score"] == found[901]["score"] == pytest.approx(model.leak) and found[900]["predicted"] == 0
    assert found[902]["predicted"] == found[903]["predicted"] == found[None]["predicted"] == 1
    assert texts[902][found[902]["sentences"][0]["start"] : found[902]["sentences"][0]["end"]] == "İ scum."


def plain_noisy_or(text, weights, bias, leak):
    """Sentence by sentence, word by word: the chance that neither the leak nor any sentence makes the document toxic."""
    quiet, scores = 1 - leak, []
    for sentence in re.findall(r"[^.!?\n]*[.!?\n]*", text or ""):
        words = {w for w in re.findall(r"[^\W\d_]+", sentence.lower()) if w in weights}
        if words:
            scores.append(1 / (1 + np.exp(-(bias + sum(weights[w] for w in words)))))
            quiet *= 1 - scores[-1]
    return 1 - quiet, sorted(scores, reverse=True)


def test_scores_are_the_noisy_or_of_sentence_scores(spark):
    docs, _ = toxic_tables(spark)
    model = toxicity.Model({"scum": 1.5, "sun": -0.7, "idiot": 2.25, "moon": 0.1, "moron": 4.0}, -3.0, 0.02)
    texts = docs.select("doc_id", "text").filter("doc_id IS NULL OR doc_id <> 902").collect()
    found = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    for d, text in texts:
        score, sentences = plain_noisy_or(text, model.weights, model.bias, model.leak)
        assert found[d]["score"] == pytest.approx(score, abs=1e-12)
        assert [x["score"] for x in found[d]["sentences"]] == pytest.approx(sentences, abs=1e-12)


def test_training_climbs_the_likelihood_of_the_noisy_or():
    """What `_train` finds is a maximum of the penalised likelihood: every small step away is worse."""
    rng = np.random.default_rng(2)
    bags = [[sorted(set(rng.integers(0, 4, size=rng.integers(1, 3)).tolist())) for _ in range(rng.integers(0, 5))] for _ in range(300)]
    truth = np.array([3.0, -2.0, 1.0, -1.0])
    labels = [int(rng.random() < 1 - 0.98 * np.prod([1 - 1 / (1 + np.exp(1 - truth[s].sum())) for s in bag])) for bag in bags]
    model = toxicity._train(list("abcd"), labels, bags, 1e-3, 3000)

    def value(params):
        total = 0.0
        for y, bag in zip(labels, bags):
            toxic, _ = 1 - (1 - model.leak) * np.prod([1 - 1 / (1 + np.exp(-(params[-1] + params[s].sum()))) for s in bag]), None
            total += np.log(max(toxic, 1e-12)) if y else np.log(1 - toxic)
        return total / len(labels) - 1e-3 / 2 * (params**2).sum()

    best = np.array([*(model.weights[w] for w in "abcd"), model.bias])
    for k in range(5):
        for step in (-0.2, 0.2):
            assert value(best + step * np.eye(5)[k]) < value(best)


def test_held_out_labels_are_never_learnt_from(spark):
    docs, labels = toxic_tables(spark)
    kept = [k for k in range(400) if zlib.crc32(str(k).encode()) % 4 == 2]
    flipped = labels.withColumn("toxic", F.when(F.col("doc_id").isin(kept), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.fit(docs, labels) == toxicity.fit(docs, flipped)
    model = toxicity.fit(docs, labels.limit(0))
    assert {r["score"] for r in toxicity.score(docs, model).collect()} == {0.0}
    assert toxicity.score(docs.limit(0), model).collect() == []


def test_digests_of_the_query(spark):
    from tagloom.llm import queries

    sf = "/root/testdata/sf0.001"
    library = Tokenizer.from_file(VOCABULARY)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    expected = set()
    for d, text in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect():
        ids = library.encode(text or "", add_special_tokens=False).ids
        expected.add((d, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    assert {tuple(r) for r in queries.op9_bpe(spark, sf).collect()} == expected

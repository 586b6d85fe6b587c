from __future__ import annotations

import hashlib
import random
from collections import Counter

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from tagloom.llm.quality import RULES, Text
from tests.llm.test_simhash import brute
from tests.llm.test_text_operators import VOCABULARY, plain_lines


def corpus(spark, folder):
    rng = random.Random(11)
    words = [f"word{k}" for k in range(400)]
    rows = []
    for k in range(80):
        lines = [" ".join(rng.choice(words) for _ in range(40)) for _ in range(4)]
        if k % 4 == 0:
            lines.insert(1, "Shared Boilerplate line")
        if k % 10 == 3:
            lines.append("what a moron he is")
        rows.append((k, "\n".join(lines), "en", f"src{k % 3}", 0))
    for k in range(12):
        rows.append((100 + k, rows[k][1] + ("" if k % 2 else " tail"), "de", "src0", 0))
    rows += [(200, None, None, None, None), (201, "", "en", "s", 0), (202, "### " * 90, "en", "s", 0), (5, rows[5][1], "en", "src2", 0)]
    rows = [(d, t, a, b, len(t or "")) for d, t, a, b, _ in rows]
    labels = [(d, 1, int("moron" in (t or ""))) for d, t, *_ in rows if d < 90]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return rows


def test_stages_equal_brute_force_and_run_is_their_product(spark, tmp_path):
    sf = str(tmp_path)
    rows = corpus(spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = {}
    for name, stage in pipeline.STAGES:
        out = stage(spark, docs, sf)
        out.write.parquet(f"{sf}/{name}")
        docs = spark.read.parquet(f"{sf}/{name}")
        kept[name] = docs.collect()
        if name != pipeline.STAGES[-1][0]:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    good = [r for r in rows if not any(rule.rejects(Text(r[1])) for rule in RULES)]
    assert sorted(map(tuple, kept["quality_rules"]), key=repr) == sorted(good, key=repr)
    cut = plain_lines([r[:2] for r in good], 10, False)
    assert any(n for _, n, _ in cut)
    assert sorted((r["doc_id"], r["text"]) for r in kept["line_dedup"]) == sorted((d, t) for d, _, t in cut)
    assert all(r["n_chars"] == len(r["text"]) for r in kept["line_dedup"])
    first = {d for d, _, c in brute(dict((d, t) for d, _, t in cut).items()) if d == c}
    assert Counter(r["doc_id"] for r in kept["simhash_dedup"]) == Counter(first) and len(first) < len({d for d, _, _ in cut})
    texts = {r["doc_id"]: r["text"] for r in kept["simhash_dedup"]}
    mixed = {r["doc_id"] for r in kept["mixing_to_targets"]}
    clean = {d for d, t in texts.items() if "moron" not in t}
    assert clean <= mixed <= set(texts) and len(mixed - clean) < len(set(texts) - clean)
    library = Tokenizer.from_file(VOCABULARY)
    for r in kept["bpe_codec"]:
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["ids"] == ids and r["n_tokens"] == len(ids)
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert sorted(map(repr, pipeline.run(spark, sf).collect())) == sorted(map(repr, kept["bpe_codec"]))
    assert public_tokenizers.path("word_bpe_49k.json") == VOCABULARY


def test_stages_take_an_empty_table(spark, tmp_path):
    sf = str(tmp_path)
    corpus(spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for name, stage in pipeline.STAGES:
        docs = stage(spark, docs, sf)
        assert docs.collect() == [], name


def test_stages_leave_columns_of_any_name_alone(spark, tmp_path):
    sf = str(tmp_path)
    corpus(spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names = (
        "kept base_failed mask _kept _keep _id _hash _text_hash text_hash h g at pos key line word bits fp node depth part first root component_id "
        "_words _marks _s0 _p0 _p1 p0 p1 k marks mark tokens _tokens _rate rate _copies copies _unit unit ids n_tokens __kept"
    ).split()
    docs = docs.select("*", *[F.concat(F.lit(f"{n} "), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias(n) for n in names])
    for k, (name, stage) in enumerate(pipeline.STAGES):
        out = stage(spark, docs, sf)
        if k + 1 < len(pipeline.STAGES):
            assert out.columns == docs.columns, name
            out.write.parquet(f"{sf}/wide{k}")
            docs = spark.read.parquet(f"{sf}/wide{k}")
            wrong = [n for n in names if docs.filter(F.col(n) != F.concat(F.lit(f"{n} "), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).limit(1).collect()] if k == 3 else []
            assert not wrong, name
        else:
            assert out.count() == docs.count()

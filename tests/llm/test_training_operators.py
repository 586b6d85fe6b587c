"""Hard negatives, fill-in-the-middle and token records against plain versions of themselves."""

from __future__ import annotations

import hashlib
import json
import random
import re
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tagloom.llm import fillmiddle, hardnegatives, queries, tokenrecords
from tagloom.llm.shared import unused

# --- hard negatives ----------------------------------------------------------


def integers(vector):
    if vector is None or any(x is None or not np.isfinite(x) or abs(256 * x) >= 1 << 24 for x in vector):
        return None
    return [int(np.floor(256.0 * x)) for x in vector]


def plain_negatives(rows, every, k_pos=5, k_neg=3):
    """Row by row: each row is its own, whatever its id."""
    rows = [(i, v, lab, integers(x)) for i, (v, x, lab) in enumerate(rows)]
    rows = [r for r in rows if r[1] is not None and r[2] is not None and r[3] is not None]
    out = []
    for i, v, lab, x in rows:
        if v % every:
            continue
        scored = [(-sum(a * b for a, b in zip(x, y)), w, lab == m) for j, w, m, y in rows if i != j and len(x) == len(y)]
        same = sorted((s, w) for s, w, eq in scored if eq)[:k_pos]
        for p, pid in same:
            fit = sorted((s, w) for s, w, eq in scored if not eq and 50 * -p <= 100 * -s <= 95 * -p)[:k_neg]
            out += [(v, pid, n + 1, w, -p, -s) for n, (s, w) in enumerate(fit)]
    return sorted(out)


SCHEMA = "vec_id long, embedding array<float>, label int, row string, copies long, dims int, v int, anchor string"


@pytest.mark.parametrize("block,group", [(4096, 1024), (16, 3)])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, block, group):
    monkeypatch.setattr(hardnegatives, "BLOCK", block)
    monkeypatch.setattr(hardnegatives, "GROUP", group)
    rng = np.random.default_rng(3)
    base = rng.normal(size=(4, 12))
    rows = [(k, [float(np.float32(x)) for x in base[k % 4] + 0.4 * rng.normal(size=12)], k % 3) for k in range(120)]
    rows += [(k, rows[8][1], (k % 2) + 1) for k in range(200, 260)]  # a third of the rows are one vector
    rows += [(20, rows[20][1], rows[20][2])] * 3 + [(7, rows[9][1], 2)]  # repeated rows, and an id with two vectors
    rows += [
        (300, None, 1), (310, [1.0] * 11 + [None], 1), (320, [float("nan")] * 12, 1), (330, [float("inf")] * 12, 1), (None, rows[1][1], 1),
        (340, rows[2][1], None), (350, [0.0] * 12, 1), (360, [1.0, 2.0], 1), (370, [1.0, 2.5], 1), (380, [1.0, 1.5], 2), (390, [], 1),
        (400, [], 1), (401, [], 2), (410, [1e30] * 12, 1), (420, [60000.0] * 12, 1),
    ]
    frame = spark.createDataFrame([(*r, "x", 9, 9, 9, "y") for r in rows], SCHEMA)
    found = hardnegatives.hard_negatives(frame, F.expr("vec_id % 10 = 0"))
    got = sorted(map(tuple, found.collect()))
    assert got == plain_negatives([(v, x, m) for v, x, m in rows], 10)
    assert len(got) > 50
    if block == 16:
        assert hardnegatives.hard_negatives(frame.limit(0), F.expr("vec_id % 10 = 0")).collect() == []


def test_the_scan_reads_less_where_bounds_tell():
    """Far candidates leave before the last dimension; who stays has its exact score."""
    rng = np.random.default_rng(1)
    matrix = rng.integers(-20, 20, size=(64, 500)).astype(np.int16)
    matrix[:, :5] += 200
    row = {
        "ids": np.arange(500).tobytes(), "copies": np.ones(500, np.int64).tobytes(), "labels": np.zeros(500, np.int64).tobytes(),
        "vectors": np.array([64, 2], np.int32).tobytes() + matrix.tobytes(),
    }
    block, anchor, seen = hardnegatives.Block(row), np.full(64, 50, np.int64), []

    def shrink(low, high):
        seen.append(len(low))
        assert (low <= high).all()
        return high >= np.sort(low)[-3]

    at, score = hardnegatives.scan(block, anchor, np.ones(500, bool), shrink)
    assert (score == anchor @ matrix[:, at].astype(np.int64)).all() and set(np.argsort(anchor @ matrix.astype(np.int64))[-3:]) <= set(at)
    assert seen[0] == 500 and seen[-1] <= 5


# --- fill in the middle ------------------------------------------------------


def plain_fim(doc_id, text):
    text = text or ""
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    digits = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digits[8 * k : 8 * k + 8], 16) for k in range(4)]
    lo, hi = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = ("".join(u) for u in (units[:lo], units[lo:hi], units[hi:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return doc_id, len(units), "plain", None, None, text
    if h[3] % 100 < 80:
        return doc_id, len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def fim_texts():
    rng = random.Random(2)
    chars = list("ab<>PSM\x00\x1f\x85 é漢🙂") + list(" \t\n\x0b\x0c\r") * 2
    texts = [None, "", " ", "a", " a", "a ", "x <P> y", "<S>", "a<M>b", "<", "<P", "\n\n", "word " * 60_000, "q" * 300_000]
    return texts + ["".join(rng.choices(chars, k=rng.randint(0, 30))) for _ in range(300)]


def test_fill_in_the_middle_equals_its_definition_and_is_restored(spark):
    rows = [(k, t) for k, t in enumerate(fim_texts())] + [(None, "a b c"), (None, None), (5, "other"), (5, "other"), (-7, "a b")]
    extra = "n string, form int, output int, c0 string, c1 string, `we``ird` int, rows int"
    docs = spark.createDataFrame([(*r, "n", 1, 2, "keep0", "keep1", 3, 4) for r in rows], f"doc_id long, text string, {extra}")
    found = fillmiddle.fill_in_middle(docs).withColumn("again", fillmiddle.restored(F.col("output"), F.col("form"))).collect()
    got = sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in found), key=repr)
    assert got == sorted((plain_fim(*r) for r in rows), key=repr)
    assert {r.form for r in found} == {"plain", "spm", "psm"}
    assert all(r.again == (r.text or "") and (r.c0, r.c1, r["we`ird"], r.rows) == ("keep0", "keep1", 3, 4) for r in found)
    assert fillmiddle.fill_in_middle(docs.limit(0)).collect() == []
    with pytest.raises(ValueError):
        fillmiddle.Marks("<P>", "<P>", "<M>")


# --- token records -----------------------------------------------------------

BYTES = public_tokenizers.path("byte_bpe_50k.json")


def record_texts():
    rng = random.Random(9)
    pieces = ["a", "é", "漢", "🙂", "don't", "12", "...", "#$", " ", "  ", "\n", "\n\n", "\t", "\r\n", "\x0b", "\x1c", "\x85", "᠎", " ", "​", "word.", "<|endoftext|>", "\x00"]
    texts = [None, "", " ", "\n", "a", "<|endoftext|>", "x" * 50_000, "word, " * 20_000, " lead", "trail ", "a\nb c.\nD"]
    return texts + ["".join(rng.choices(pieces, k=rng.randint(0, 12))) for _ in range(400)]


def test_stretches_are_encoded_as_the_library_encodes_texts():
    with open(BYTES, encoding="utf-8") as file:
        source = file.read()
    library, texts = Tokenizer.from_file(BYTES), [t or "" for t in record_texts()]
    expected = [np.array(e.ids, "<u2").tobytes() for e in library.encode_batch(texts, add_special_tokens=False)]
    encoder = tokenrecords.Encoder(source, "<u2")
    assert encoder.in_stretches
    assert encoder.encode(texts) == encoder.encode(texts) == expected
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        other = tokenrecords.Encoder(file.read(), "<u2")
    assert not other.in_stretches and other.encode(["A b"]) == [np.array(other.library.encode("A b", add_special_tokens=False).ids, "<u2").tobytes()]


def plain_frame(data):
    def masked(b):
        crc = zlib.crc32(b)
        return (((crc >> 15) | (crc << 17 & 0xFFFFFFFF)) + 0xA282EAD8) & 0xFFFFFFFF

    length = struct.pack("<Q", len(data))
    return length + struct.pack("<I", masked(length)) + data + struct.pack("<I", masked(data))


def test_records_come_back_in_any_order(spark, tmp_path, monkeypatch):
    rows = [(k * 7 % 500 - 50, t) for k, t in enumerate(record_texts())] + [(None, "nameless"), (None, "other"), (3, "same"), (3, "same"), (3, "not the same")]
    docs = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], "doc_id long, text string, file string, `offset` int, part int")
    path = str(tmp_path / "records")
    tokenrecords.write_records(docs, path, BYTES, 2, parts=5)
    index = tokenrecords.read_index(spark, path)
    found = tokenrecords.read_records(index, path).collect()
    library = Tokenizer.from_file(BYTES)
    of = lambda t: [*library.encode(t or "", add_special_tokens=False).ids, 2]
    assert sorted(((r.doc_id, r.ids) for r in found), key=repr) == sorted(((d, of(t)) for d, t in rows), key=repr)
    # ids before each document, without a gap, in ascending order of ids, rows without one first
    ordered = sorted(found, key=lambda r: r.start)
    assert [r.start for r in ordered] == np.cumsum([0, *(len(r.ids) for r in ordered)])[:-1].tolist()
    names = [r.doc_id for r in ordered]
    assert names[:2] == [None, None] and names[2:] == sorted(names[2:])
    # files are frames of the format and nothing else
    kept = {}
    for r in index.collect():
        kept.setdefault(r.file, []).append((r.offset, r.start))
    ids_at = {r.start: r.ids for r in found}
    for name, places in kept.items():
        data = b"".join(plain_frame(np.array(ids_at[s], "<u2").tobytes()) for _, s in sorted(places))
        assert (tmp_path / "records" / name).read_bytes() == data
    # a shuffled reading gives the same records, packed
    mixed = tokenrecords.shuffled(index, seed=4)
    again = tokenrecords.read_records(mixed, path, packed=True).collect()
    assert {r.start: np.frombuffer(r.ids, "<u4").tolist() for r in again} == ids_at
    assert [r.start for r in again] != sorted(r.start for r in again)
    # damage is refused
    place = sorted(kept)[0]
    file = tmp_path / "records" / place
    data = bytearray(file.read_bytes())
    data[20] ^= 1
    file.write_bytes(bytes(data))
    with pytest.raises(Exception, match="damaged"):
        tokenrecords.read_records(index, path).collect()


def test_records_of_an_empty_table_and_long_files(spark, tmp_path, monkeypatch):
    docs = spark.createDataFrame([(k, f"text {k}") for k in range(50)], "doc_id long, text string")
    empty = str(tmp_path / "empty")
    tokenrecords.write_records(docs.limit(0), empty, BYTES, 2)
    assert tokenrecords.read_records(tokenrecords.read_index(spark, empty), empty).collect() == []
    monkeypatch.setattr(tokenrecords, "FILE_BYTES", 1)
    many = str(tmp_path / "many")
    tokenrecords.write_records(docs, many, BYTES, parts=2)
    index = tokenrecords.read_index(spark, many)
    assert index.select("file").distinct().count() >= 2
    assert tokenrecords.read_records(index, many).count() == 50


def test_digests_of_the_query(spark, tmp_path):
    rows = [(k * 11 % 97, t) for k, t in enumerate(record_texts()[:60])]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.doc_id: tuple(r)[1:] for r in queries.op13_token_records(spark, str(tmp_path)).collect()}
    library, start = Tokenizer.from_file(BYTES), 0
    for doc_id, text in sorted(rows):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        assert found[doc_id] == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_prefixes_that_no_column_has():
    assert unused(["a", "_B", "__c"]) == "___" and unused([]) == "_"


@pytest.mark.parametrize("added", ["<|endoftext|>", "ell", "o!"])
def test_stretches_equal_whole_texts_with_few_words_kept(added, monkeypatch):
    """Added tokens inside a word or its marks, letters beyond ASCII, and words that were forgotten."""
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        data = json.load(file)
    data["added_tokens"][0]["content"] = added
    monkeypatch.setattr(tokenrecords, "MOST_WORDS", 3)
    encoder = tokenrecords.Encoder(json.dumps(data), "<u2")
    texts = ["hello hello! a\nhello, élan Ölé! b\nñ ell x o! <|endoftext|>", "hello élan x\nÿ hello!"] * 2
    whole = [np.array(e.ids, "<u2").tobytes() for e in encoder.library.encode_batch(texts, add_special_tokens=False)]
    assert encoder.in_stretches and encoder.encode(texts) == whole and len(encoder.words) <= 3

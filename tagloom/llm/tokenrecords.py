"""Token ids as length-delimited binary records with checksums, and an index for shuffled reads.

A file is a row of frames: the length of the data as 8 bytes, the masked checksum of these
bytes, the data (ids as little-endian unsigned integers of 2 or 4 bytes), the masked
checksum of the data; numbers are little-endian, checksums CRC-32. Documents are range-partitioned by id
and sorted, so file after file holds them in ascending order; a task encodes the documents of its range and
writes their frames. The index is a Parquet table beside the files: where each document's frame is, and
how many ids are before it. A reader takes index rows in any order and seeks.

A file's name is new for each attempt of a task, and only attempts that Spark has accepted are in
the index; what a lost executor left behind is in none of its rows and is never read.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from array import array
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tokenizers
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tagloom.llm.shared import Scratch, ddl, text_parts

#: Vocabulary files are small next to an executor's memory; larger ones are refused.
MOST_VOCABULARY_BYTES = 64 << 20
#: Stretches of text whose ids a worker remembers, about 200 MB; those not used of late go. No result depends on it.
MOST_STRETCHES = 800_000
#: Words in such stretches whose ids a worker remembers besides, about 100 MB.
MOST_WORDS = 500_000
#: A file is closed once it has this size, and a read of neighbouring frames is at most this long or one frame.
FILE_BYTES, READ_BYTES = 256 << 20, 8 << 20
OPEN_FILES = 32

# --- frames ------------------------------------------------------------------

#: The mask's constant; a masked checksum is turned by 15 bits, so that a checksum over checksums is safe.
MASK = 0xA282EAD8
#: Bytes of a frame besides its data: the length and its checksum before, the data's checksum behind.
BEFORE, BEHIND = 12, 4


def masked(data: bytes) -> int:
    """The masked CRC-32 of some bytes."""
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK) & 0xFFFFFFFF


def frame(data: bytes) -> bytes:
    length = struct.pack("<Q", len(data))
    return b"".join((length, struct.pack("<I", masked(length)), data, struct.pack("<I", masked(data))))


def data_of(framed: memoryview) -> memoryview:
    """The data of the frame at the start of some bytes; ValueError if it is cut off or damaged."""
    length, check = struct.unpack_from("<QI", framed) if len(framed) >= BEFORE else (0, -1)
    data = framed[BEFORE : BEFORE + length]
    end = framed[BEFORE + length : BEFORE + length + BEHIND]
    if masked(framed[:8]) != check or len(end) < BEHIND or struct.unpack("<I", end)[0] != masked(data):
        raise ValueError("a record is cut off or damaged")
    return data


# --- encoding ----------------------------------------------------------------


def _cut_at_blanks(data: dict) -> bool:
    """Whether a vocabulary file's word split ends a word before each space or line end between other characters."""
    split = data["pre_tokenizer"] or {}
    return (
        data["normalizer"] is None
        and split.get("type") == "ByteLevel"
        and split.get("use_regex") is True
        and not split.get("add_prefix_space")
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] or t["content"].split() != [t["content"]] for t in data["added_tokens"])
    )


#: A line end or none, letters, marks or none: up to three words of the split, whatever stands around them.
SIMPLE = re.compile(r"(\n?)([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?#$%&*<>|()]*)")
#: What can be a part of such a stretch.
SIMPLE_PART = re.compile(r"\n?[A-Za-zÀ-ÖØ-öø-ÿ]*[.,;:!?#$%&*<>|()]*")


class Encoder:
    """The library's encoding of whole texts, in stretches.

    Where the word split of a vocabulary file ends a word before each single space or line end between two
    characters that are not white space, the stretches between those are encoded one by one by the library and
    remembered; a stretch of letters and marks goes to the library's model word by word. Texts of other
    vocabulary files go to the library whole.
    """

    def __init__(self, source: str, kind: str):
        data = json.loads(source)
        self.library = tokenizers.Tokenizer.from_str(source)
        self.library.no_truncation()
        self.library.no_padding()
        self.kind, self.in_stretches = kind, _cut_at_blanks(data)
        self.code = "H" if kind == "<u2" else "I"
        #: Ids of stretches used of late, and of those before them, by the piece that `_pieces` gives; ids of words.
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        if self.in_stretches:
            self.model = self.library.model
            self.letters = {k: self.library.pre_tokenizer.pre_tokenize_str(chr(k))[0][0] for k in range(0x20, 0x100)}
            self.blank = self.letters[0x20]
            self.line_end = self._ids(["\n"])[0]
            # only these can be in a simple stretch
            self.added = [t["content"] for t in data["added_tokens"] if SIMPLE_PART.fullmatch(t["content"])]

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = []
        for lo in range(0, len(texts), 1000):
            batch = self.library.encode_batch(texts[lo : lo + 1000], add_special_tokens=False)
            found += [array(self.code, e.ids).tobytes() for e in batch]
        return found

    def _word(self, word: str) -> bytes:
        """The ids of a word not remembered; remembers them."""
        if len(self.words) >= MOST_WORDS:
            self.words.clear()
        if word.isascii():  # of these only the blank has another letter
            letters = self.blank + word[1:] if word[0] == " " else word
        else:
            letters = word.translate(self.letters)
        ids = self.words[word] = array(self.code, [t.id for t in self.model.tokenize(letters)]).tobytes()
        return ids

    def _learn(self, pieces: set[str]) -> None:
        """Put all even pieces into the young."""
        if len(self.young) > MOST_STRETCHES // 4:
            self.old, self.young = self.young, {}
        young, fresh, others = self.young, pieces - self.young.keys(), []
        old, words, word_ids, added, simple_form = self.old, self.words, self._word, self.added, SIMPLE.fullmatch
        for piece in fresh:
            ids = old.get(piece)
            if ids is None:
                simple = simple_form(piece)
                if simple and not (added and any(t in piece for t in added)):
                    line, word, marks = simple.groups()
                    if not line:
                        word = " " + word
                    ids = words.get(word) or word_ids(word)
                    if line:
                        ids = self.line_end + ids
                    if marks:
                        ids += words.get(marks) or word_ids(marks)
                elif _even(piece):
                    others.append(piece)
                    continue
                else:
                    continue
            young[piece] = ids
        young.update(zip(others, self._ids([p if p[0] == "\n" else " " + p for p in others])))

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.in_stretches:
            return self._ids(texts)
        cut = [_pieces(t) for t in texts]
        self._learn(set().union(*(rest for _, rest in cut)))
        out, known = [], self.young.get
        for (first, rest), ids in zip(cut, self._ids([first for first, _ in cut])):
            found = list(map(known, rest))
            whole = not rest or first and not _blank(first[-1]) and None not in found
            out.append(b"".join([ids, *found]) if whole else self._uneven(first, rest, found))
        return out

    def _uneven(self, first: str, rest: list[str], found: list[bytes | None]) -> bytes:
        """A text in which some blanks are not alone between other characters: what is around those stays together."""
        runs, ended = [[first]], bool(first) and not _blank(first[-1])
        known: list[bytes | None] = [None]
        for piece, ids in zip(rest, found):
            text = piece if piece[:1] == "\n" else " " + piece
            if ended and _even_start(piece):
                runs.append([text])
                known.append(ids)
            else:
                runs[-1].append(text)
            ended = len(text) > 1 and not _blank(text[-1])
        alone = [len(r) == 1 and k is not None for r, k in zip(runs, known)]
        rest_ids = iter(self._ids(["".join(r) for r, a in zip(runs, alone) if not a]))
        return b"".join(k if a else next(rest_ids) for k, a in zip(known, alone))


def _blank(char: str) -> bool:
    return char.isspace() or char == "\u180e"


def _pieces(text: str) -> tuple[str, list[str]]:
    """The text up to the first space or line end; what follows each: a line end is kept, a space is not."""
    first, *rest = text.replace("\n", " \n").split(" ")
    return first, rest


def _even_start(piece: str) -> bool:
    word = piece[piece[:1] == "\n" :]
    return bool(word) and not _blank(word[0])


def _even(piece: str) -> bool:
    """Whether a piece begins (behind its line end) and ends with other characters than white space."""
    return _even_start(piece) and not _blank(piece[-1])


# --- files -------------------------------------------------------------------


def _place(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


class _Writer:
    """Writes one part; a new file after FILE_BYTES."""

    def __init__(self, path: str, part: int):
        self.store, self.folder = _place(path)
        self.part, self.stream, self.files = part, None, 0
        self.attempt = uuid.uuid4().hex[:12]

    def add(self, data: bytes) -> tuple[str, int]:
        """Append; the file's name and the offset."""
        if self.stream is None or self.at >= FILE_BYTES:
            self.close()
            self.name, self.at = f"part-{self.part:06d}-{self.files:04d}-{self.attempt}.records", 0
            self.stream = self.store.open_output_stream(f"{self.folder}/{self.name}")
            self.files += 1
        start = self.at
        self.stream.write(data)
        self.at += len(data)
        return self.name, start

    def close(self) -> None:
        if self.stream is not None:
            self.stream.close()


def write_records(
    docs: DataFrame, path: str, vocabulary: str, end_id: int | None = None, parts: int | None = None, scratch: Scratch | None = None
) -> None:
    """Files of records and their index under `path`, a record for each row of `docs` (doc_id, text; others unused).

    `path`: a folder all nodes share, with a scheme that pyarrow.fs knows. `vocabulary`: a file of the tokenizers library, read
    by the driver and sent to the tasks (its size is checked). Ids are those of the library without special tokens
    added, then `end_id`; they take 2 bytes if all ids of the vocabulary fit, else 4. Documents come in ascending order
    of doc_id, rows without one first; rows that share an id follow each other in an order of
    their texts' hashes. A null text is an empty one and gives the end id alone. `parts`: ranges, by default
    `spark.sql.shuffle.partitions`; a range has one or more files of about FILE_BYTES. An empty table gives an empty index.
    """
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark)
    with open(vocabulary, encoding="utf-8") as file:
        source = file.read(MOST_VOCABULARY_BYTES + 1)
    if len(source) > MOST_VOCABULARY_BYTES:
        raise ValueError(f"{vocabulary} is larger than {MOST_VOCABULARY_BYTES} bytes")
    data = json.loads(source)
    most = max([*data["model"]["vocab"].values(), *(t["id"] for t in data["added_tokens"]), end_id or 0])
    kind = "<u2" if most < 1 << 16 else "<u4"
    width = int(kind[-1])
    shipped = spark.sparkContext.broadcast({"source": source})
    end = b"" if end_id is None else np.array([end_id]).astype(kind).tobytes()
    store, folder = _place(path)
    store.create_dir(folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shipped.value
        if "encoder" not in own:
            own["encoder"] = Encoder(own["source"], kind)
        writer, start = _Writer(path, part := TaskContext.get().partitionId()), 0
        for batch in batches:
            for lo, texts in text_parts(batch.column(1)):
                ids = [found + end for found in own["encoder"].encode([t or "" for t in texts.to_pylist()])]
                name, at = writer.add(b"".join(map(frame, ids)))
                sizes = np.array([len(i) for i in ids], np.int64)
                lengths, tokens = sizes + BEFORE + BEHIND, sizes // width
                columns = [
                    pa.array([part] * len(ids), pa.int32()), batch.column(0).slice(lo, len(ids)), pa.array([name] * len(ids)),
                    pa.array(at + np.cumsum(lengths) - lengths), pa.array(sizes), pa.array([width] * len(ids), pa.int32()),
                    pa.array(start + np.cumsum(tokens) - tokens),
                ]
                start += int(tokens.sum())
                yield pa.RecordBatch.from_arrays(columns, ["part", "doc_id", "file", "offset", "bytes", "width", "first"])
        writer.close()

    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    rows = docs.select("doc_id", "text").repartitionByRange(parts, *order).sortWithinPartitions(*order)
    kept = ddl(docs.select("doc_id"))
    written = scratch.keep(
        rows.mapInArrow(run, f"part int, {kept}, file string, offset bigint, bytes bigint, width int, first bigint")
    )
    # one row per range: as many as there are partitions
    totals = written.groupBy("part").agg(F.sum(F.expr("bytes div width")).alias("ids"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("ids").over(earlier), F.lit(0)).alias("base"))
    index = written.join(F.broadcast(bases), "part").select(
        "doc_id", (F.col("base") + F.col("first")).alias("start"), "file", "offset", "bytes", "width"
    )
    index.write.parquet(f"{path}/index")
    scratch.drop(written)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, file, offset, bytes, width): `start` ids are in the documents before, `bytes` of data at `offset`."""
    return spark.read.parquet(f"{path}/index")


def shuffled(index: DataFrame, seed: int, parts: int | None = None) -> DataFrame:
    """The rows of an index in an order that a seed decides, the same in every run."""
    key = F.xxhash64(F.lit(seed), "file", "offset")
    parts = parts or int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return index.repartitionByRange(parts, key).sortWithinPartitions(key)


def read_records(index: DataFrame, path: str, packed: bool = False) -> DataFrame:
    """(doc_id, start, ids) of the records that rows of the index name, in the order of those rows.

    `ids`: array<bigint>, or, if `packed`, their bytes as little-endian unsigned 32-bit integers. Frames that follow
    each other in a file are read at once. A frame whose length or checksums differ stops the reading.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = _place(path)
        files: OrderedDict = OrderedDict()

        def read(name: str, at: int, size: int) -> bytes:
            if name not in files:
                if len(files) >= OPEN_FILES:
                    files.popitem(last=False)[1].close()
                files[name] = store.open_input_file(f"{folder}/{name}")
            files.move_to_end(name)
            return files[name].read_at(size, at)

        for batch in batches:
            names = batch.column(2).to_pylist()
            offsets, sizes, widths = (batch.column(k).to_numpy() for k in (3, 4, 5))
            for lo, hi in _neighbours(names, offsets, sizes):
                held = sizes[lo:hi]
                span = memoryview(read(names[lo], int(offsets[lo]), int(held.sum()) + (BEFORE + BEHIND) * (hi - lo)))
                found = [data_of(span[at:]) for at in (offsets[lo:hi] - offsets[lo]).tolist()]
                if [len(data) for data in found] != held.tolist():
                    raise ValueError(f"the index does not fit the records of {names[lo]}")
                ids = np.frombuffer(b"".join(found), np.uint8).view(f"<u{widths[lo]}").astype(np.uint32)
                ends = pa.array(np.concatenate([[0], np.cumsum(held // widths[lo])]).astype(np.int32))
                if packed:
                    ends = pa.array(ends.to_numpy() * 4)
                    values = pa.Array.from_buffers(pa.binary(), hi - lo, [None, ends.buffers()[1], pa.py_buffer(ids.tobytes())])
                else:
                    values = pa.ListArray.from_arrays(ends, pa.array(ids.astype(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), values], ["doc_id", "start", "ids"])

    index = index.select("doc_id", "start", "file", "offset", "bytes", "width")
    return index.mapInArrow(run, f"{ddl(index.select('doc_id'))}, start bigint, ids {'binary' if packed else 'array<bigint>'}")


def _neighbours(names: list[str], offsets: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose frames follow each other, of READ_BYTES at most or one frame."""
    lo = 0
    for k in range(1, len(names) + 1):
        if (
            k == len(names) or names[k] != names[lo] or offsets[k] != offsets[k - 1] + sizes[k - 1] + BEFORE + BEHIND
            or offsets[k] + sizes[k] + BEFORE + BEHIND - offsets[lo] > READ_BYTES
        ):
            yield lo, k
            lo = k

"""Exact byte-pair encoding by dynamic programming over prefixes, and decoding.

A token sequence is the encoding of its text exactly if every two neighbours are: if the
merges, run over their joined text, give just these two back. So the last token of each
prefix of a word is unique. It is found among the tokens that end there, which an
automaton over all tokens lists: it is the one compatible with the last token of the
prefix it leaves. Back-pointers from the end of the word give the ids. The work is linear
in the word for tokens of bounded length, and no merge is ever run on the text.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field, fields

import ahocorasick
import numpy as np
import pyarrow as pa
import tokenizers
from pyspark.sql import DataFrame

from tagloom.llm.shared import ddl, text_parts

#: Vocabulary files are small next to an executor's memory; larger ones are refused.
MOST_VOCABULARY_BYTES = 64 << 20
#: Stretches, words and pairs remembered by a worker, about 100 MB; beyond these numbers memory
#: starts anew. No result depends on them.
MOST_STRETCHES, MOST_WORDS, MOST_PAIRS = 300_000, 150_000, 200_000


@dataclass
class Vocabulary:
    """Tables of a vocabulary file of kind BPE whose merges each make a token of their own.

    `split[t]`: the two tokens merged into t. `rank[t]`: the place of that merge, -1 for
    single symbols. `joined[l, r]`: the token that l and r merge into.
    """

    source: str
    tokens: list[str]
    ending: str
    split: dict[int, tuple[int, int]] = field(default_factory=dict)
    rank: list[int] = field(default_factory=list)
    joined: dict[tuple[int, int], int] = field(default_factory=dict)
    usable: list[bool] = field(default_factory=list)

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as file:
            source = file.read(MOST_VOCABULARY_BYTES + 1)
        if len(source) > MOST_VOCABULARY_BYTES:
            raise ValueError(f"{path} is larger than {MOST_VOCABULARY_BYTES} bytes")
        data = json.loads(source)
        model = data["model"]
        ids = model["vocab"]
        extra = {t["id"]: t["content"] for t in data["added_tokens"]}
        tokens = [""] * (1 + max([*ids.values(), *extra]))
        for text, i in [*ids.items(), *((t, i) for i, t in extra.items())]:
            tokens[i] = text
        made = cls(source, tokens, model.get("end_of_word_suffix") or "", rank=[-1] * len(tokens))
        for place, (left, right) in enumerate(map(_pair, model["merges"])):
            token, parts = ids[left + right], (ids[left], ids[right])
            if token in made.split or max(made.rank[p] for p in parts) >= place:
                raise ValueError("the merges of this vocabulary are not in order or repeat a token")
            made.split[token], made.rank[token], made.joined[parts] = parts, place, token
        made.usable = [i not in extra for i in range(len(tokens))]
        for token in sorted(made.split, key=made.rank.__getitem__):
            left, right = made.split[token]
            made.usable[token] = (
                made.usable[left] and made.usable[right] and made.compatible(left, right, made.rank[token])
            )
        return made

    def text(self, ids) -> str:
        """What ids decode to: their tokens, joined by a space, as the library does without a decoder."""
        return " ".join(map(self.tokens.__getitem__, ids))

    def compatible(self, left: int, right: int, before: int | None = None) -> bool:
        """Whether no merge crosses between the two, counting merges of a rank under `before`.

        Undoes the merges inside both, last one first. What then faces each other at the
        border must not merge earlier than the merge just undone: earlier by rank, or at
        equal rank further left, which is where merges of one rank begin.
        """
        rank, limit = self.rank, len(self.tokens) if before is None else before
        while True:
            token = self.joined.get((left, right))
            if token is not None and rank[token] < limit:
                return False
            if rank[left] < 0 and rank[right] < 0:
                return True
            if rank[left] > rank[right]:
                limit = min(limit, rank[left])
                left = self.split[left][1]
            else:
                limit = min(limit, rank[right] + 1)
                right = self.split[right][0]


def _pair(merge) -> tuple[str, str]:
    return tuple(merge.split(" ")) if isinstance(merge, str) else tuple(merge)


#: Stands for the ending of a word, so that it is one character to the automaton.
END = "\U0010fffd"


class Encoder:
    """Encodes texts in a worker: the file's own normalisation and word split, then the programme above."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        front = tokenizers.Tokenizer.from_str(vocabulary.source)
        self.normalizer, self.splitter = front.normalizer, front.pre_tokenizer
        data = json.loads(vocabulary.source)
        self.special = ahocorasick.Automaton()
        for t in data["added_tokens"]:
            if t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] or t["content"].split() != [t["content"]]:
                raise ValueError("added tokens with options are not supported")
            self.special.add_word(t["content"], (t["id"], len(t["content"])))
        self.has_special = bool(data["added_tokens"])
        if self.has_special:
            self.special.make_automaton()
        self.tokens = ahocorasick.Automaton()
        for i, text in enumerate(vocabulary.tokens):
            if vocabulary.usable[i] and text:
                ends = bool(vocabulary.ending) and text.endswith(vocabulary.ending)
                word = text.removesuffix(vocabulary.ending) + END if ends else text
                self.tokens.add_word(word, (i, len(word)))
        self.tokens.make_automaton()
        self.letters = {ord(c): w for c in map(chr, range(0x250)) if c.isalpha() and (w := self._alone(c))}
        marks = [c for c in ",.;:!?" if self._alone(c) == c]
        #: Letters that are a word by themselves, whatever their neighbours, then one mark or none.
        self.plain = re.compile(f"([{''.join(map(chr, self.letters))}]+)([{''.join(marks)}]?)") if self.letters and marks else None
        self.stretches: dict[bytes, bytes] = {}
        self.words: dict[str, list[int]] = {}
        self.tested: dict[tuple[int, int], bool] = {}

    def _alone(self, char: str) -> str | None:
        """A character in the vocabulary's alphabet, if the split takes it and its double for one word.

        Letters that the normalisation turns into something else than letters are left out,
        as what follows them might matter.
        """
        normal = self.normalizer.normalize_str(char)
        if char.isalpha() and not normal.isalpha():
            return None
        one, two = (self.splitter.pre_tokenize_str(self.normalizer.normalize_str(c)) for c in (char, char * 2))
        return one[0][0] if len(one) == 1 and [w for w, _ in two] == [one[0][0] * 2] else None

    def word(self, word: str) -> list[int]:
        """Ids of one word, given in the vocabulary's alphabet."""
        text = word + END if self.v.ending else word
        last, size = [-1] * (len(text) + 1), [0] * (len(text) + 1)
        tested = self.tested
        for end, (token, length) in self.tokens.iter(text):
            at = end + 1
            if size[at]:
                continue
            start = at - length
            if start:
                before = last[start]
                if before < 0:
                    continue
                fits = tested.get((before, token))
                if fits is None:
                    fits = tested[before, token] = self.v.compatible(before, token)
                if not fits:
                    continue
            last[at] = token
            size[at] = length
        if len(tested) > MOST_PAIRS:
            tested.clear()
        ids, at = [], len(text)
        while at:
            if not size[at]:
                raise ValueError(f"a symbol of {word!r} is not in the vocabulary")
            ids.append(last[at])
            at -= size[at]
        return ids[::-1]

    def _pieces(self, text: str) -> Iterator[str | int]:
        """Stretches of ordinary text, and ids of added tokens between them."""
        start = 0
        if self.has_special:
            for end, (token, length) in self.special.iter_long(text):
                if start < end + 1 - length:
                    yield text[start : end + 1 - length]
                yield token
                start = end + 1
        if start < len(text):
            yield text[start:]

    def encode(self, text: bytes) -> bytes:
        """The ids of UTF-8 text as 32-bit integers.

        Neither the normalisation nor the word split reaches over ASCII white space, so
        stretches between white space are encoded one by one and remembered.
        """
        known, found = self.stretches, []
        for stretch in text.split():
            ids = known.get(stretch)
            if ids is None:
                if len(known) > MOST_STRETCHES:
                    known.clear()
                ids = known[stretch] = self._stretch(stretch.decode())
            found.append(ids)
        return b"".join(found)

    def _stretch(self, text: str) -> bytes:
        ids: list[int] = []
        if self.plain and (found := self.plain.fullmatch(text)):
            ids += self._known_word(found[1].translate(self.letters))
            if found[2]:
                ids += self._known_word(found[2])
            return array("i", ids).tobytes()
        for piece in self._pieces(text):
            if isinstance(piece, int):
                ids.append(piece)
                continue
            for word, _ in self.splitter.pre_tokenize_str(self.normalizer.normalize_str(piece)):
                ids += self._known_word(word)
        return array("i", ids).tobytes()

    def _known_word(self, word: str) -> list[int]:
        known = self.words.get(word)
        if known is None:
            if len(self.words) > MOST_WORDS:
                self.words.clear()
            known = self.words[word] = self.word(word)
        return known


def _ship(docs: DataFrame, path: str, decoding: bool = False):
    """The tables of a vocabulary as plain lists and dictionaries, which workers need no package to load."""
    vocabulary = Vocabulary.read(path)
    if decoding and json.loads(vocabulary.source)["decoder"] is not None:
        raise ValueError("only vocabularies without a decoder can be decoded")
    return docs.sparkSession.sparkContext.broadcast({f.name: getattr(vocabulary, f.name) for f in fields(vocabulary)})


def _vocabulary(shipped) -> Vocabulary:
    tables = shipped.value
    return Vocabulary(**{name: table for name, table in tables.items() if name != "encoder"})


def _encoder(shipped) -> Encoder:
    """One encoder for each worker process, kept with the broadcast value that its tasks share."""
    tables = shipped.value
    if "encoder" not in tables:
        tables["encoder"] = Encoder(_vocabulary(shipped))
    return tables["encoder"]


def encode(docs: DataFrame, path: str, decoded: bool = False) -> DataFrame:
    """(doc_id, ids array<int>) of every row of `docs` (doc_id, text; others unused).

    `path`: a vocabulary file of the tokenizers library, kind BPE, read by the driver and
    sent to the tasks (its size is checked). Ids equal that library's with special tokens
    in the text recognised and none added. A null text has no ids, like an empty one. With
    `decoded`, the ids are decoded as `decode` does in the same pass.
    """
    shipped = _ship(docs, path, decoded)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shipped)
        for batch in batches:
            for lo, part in text_parts(batch.column("text")):
                ids = [encoder.encode(t.as_py() or b"") for t in part.cast(pa.binary())]
                ends = np.cumsum([0, *(len(i) // 4 for i in ids)], dtype=np.int32)
                values = pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(ids))])
                columns = [batch.column("doc_id").slice(lo, len(part)), pa.ListArray.from_arrays(pa.array(ends), values)]
                if decoded:
                    columns.append(pa.array([encoder.v.text(array("i", i)) for i in ids], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "decoded"][: len(columns)])

    columns = docs.select("doc_id", "text")
    schema = f"doc_id {columns.schema['doc_id'].dataType.simpleString()}, ids array<int>"
    return columns.mapInArrow(run, schema + ", decoded string" * decoded)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """`encoded` (any columns, ids array<int>) with the column `decoded`: the tokens joined by a space.

    That is what the library gives for a vocabulary file without a decoder. Null ids give an
    empty text.
    """
    shipped = _ship(encoded, path, True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(shipped)
        for batch in batches:
            for lo in range(0, len(batch), 256):
                part = batch.slice(lo, 256)
                texts = [vocabulary.text(i.values.to_numpy().tolist() if i.is_valid else ()) for i in part.column("ids")]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], [*part.schema.names, "decoded"])

    return encoded.mapInArrow(run, f"{ddl(encoded)}, decoded string")


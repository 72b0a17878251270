"""Tree concatenation: exact BPE of long unsplit text in parallel.

A text of up to ``leaf`` characters is one leaf. A longer one is cut into
leaves that different tasks encode; neighbours are then concatenated pair by
pair up a tree. At each join a window around the cut is encoded again and
grown on both sides until its first tokens are those that the left half ends
with and its last tokens those that the right half goes on with: the three
sequences then share tokens on either side of the cut, and since a sequence
is the encoding of its text exactly if all its adjacent pairs are, the
spliced sequence is what encoding the whole would give. ``margin`` is the
number of tokens that must agree on each side.

Inside a leaf, pieces between white space are independent (normalisation and
pre-tokenisation never reach over it), so their ids are kept in a bounded
table per worker and only unseen pieces go through the tokenizer.

Defined results: a NULL or empty text has no tokens and decodes to the empty
text; repeated rows each give a row; an empty table gives an empty result. The
strings of special tokens in a text become those tokens, as in the tokenizers
library with add_special_tokens=False; such a text isn't cut.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import texts

LEAF = 32_768  # characters of a leaf
MARGIN = 4  # tokens that agree on each side of a join
PIECES, WORDS = 100_000, 150_000  # remembered in a task (about 60 MB); only speed depends on it
# The pipeline for which pieces go straight to the model.
NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
     "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
# Latin characters that composition and the letter and number classes treat as
# below; without white space beyond ASCII, U+0130 and what may join marks.
EASY = re.compile("[!-~\xa1-\xff\u0100-\u012f\u0131-\u017e]*")
LETTER, NUMBER = "a-zA-Z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u017f", "0-9\xb2\xb3\xb9\xbc-\xbe"
SPLIT = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTER}]+|[{NUMBER}]|[^\\s{LETTER}{NUMBER}]+")
# The printable character that stands for each byte in the vocabulary.
KEPT = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
BYTES = dict(zip(sorted({*range(0x100)} - KEPT), range(0x100, 0x200)))

ENCODED = "doc_id long, ids array<int>, ids_text string, decoded string"


class Bpe:
    """A tokenizers file; ``encode`` is exact for any text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.lib.no_truncation()
        self.lib.no_padding()
        vocab = self.lib.get_vocab(with_added_tokens=True)
        self.token = [""] * (max(vocab.values(), default=-1) + 1)
        for token, i in vocab.items():
            self.token[i] = token
        special = [t.content for t in self.lib.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True))) or r"(?!)")
        self.glue = " " if self.lib.decoder is None else None
        self.known: dict[bytes, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.model = self.lib.model
        self.number = [str(i) for i in range(len(self.token))]
        held = json.loads(self.lib.to_str())
        self.plain = held["normalizer"] == NORMALIZER and held["pre_tokenizer"] == PRE_TOKENIZER

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.lib.encode(text, add_special_tokens=False).ids, np.int32)

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text, piece after piece between ASCII white space."""
        if self.special.search(text):
            return self.whole(text)
        pieces = text.encode().split()
        known = self.known
        try:
            return np.frombuffer(b"".join(map(known.__getitem__, pieces)), np.int32)
        except KeyError:
            pass
        if len(known) > PIECES:
            known.clear()
        for p in pieces:
            if p not in known:
                known[p] = self.piece(p)
        return np.frombuffer(b"".join(map(known.__getitem__, pieces)), np.int32)

    def piece(self, raw: bytes) -> bytes:
        """Ids of text without ASCII white space. For a known pipeline and
        characters it leaves alone but for their case, straight to the model."""
        if self.plain and raw.isascii() and raw.isalnum():
            words = [raw.lower().decode()]
            if not raw.isalpha():
                words = SPLIT.findall(words[0])
        else:
            text = raw.decode()
            if not self.plain or not EASY.fullmatch(text):
                return self.whole(text).tobytes()
            words = [w.encode().decode("latin-1").translate(BYTES) for w in SPLIT.findall(text.lower())]
        known = self.words
        if len(known) > WORDS:
            known.clear()
        for w in words:
            if w not in known:
                known[w] = array("i", [t.id for t in self.model.tokenize(w)]).tobytes()
        return b"".join(map(known.__getitem__, words))

    def forget(self) -> None:
        """Drop what a task remembered: workers live on."""
        self.known.clear()
        self.words.clear()

    def decode(self, ids: np.ndarray) -> str:
        if self.glue is None:
            return self.lib.decode(ids.tolist(), skip_special_tokens=False)
        return self.glue.join(map(self.token.__getitem__, ids.tolist()))

    def written(self, ids: np.ndarray) -> str:
        """Decimal ids, one space between."""
        return " ".join(map(self.number.__getitem__, ids.tolist()))

    def spans(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids with the character at which each token starts."""
        e = self.lib.encode(text, add_special_tokens=False)
        return np.array(e.ids, np.int32), np.array([a for a, _ in e.offsets], np.int64)


@lru_cache(maxsize=4)
def bpe(path: str) -> Bpe:
    return Bpe(path)


Part = tuple[str, np.ndarray, np.ndarray]  # text, ids, start of each token


def join(enc: Bpe, left: Part, right: Part, margin: int = MARGIN) -> Part:
    """The encoding of left + right from both halves and a window that grows
    around the cut until both sides agree with it; the whole text in the end."""
    (a, ia, sa), (b, ib, sb) = left, right
    if not a or not b:
        return (a + b, ia if a else ib, sa if a else sb)
    grow = 2 * margin
    while grow < len(ia) and grow < len(ib):
        start, stop = int(sa[-grow]), int(sb[grow])
        ids, at = enc.spans(a[start:] + b[:stop])
        agree = (len(ids) > 2 * margin
                 and np.array_equal(ids[:margin], ia[len(ia) - grow:len(ia) - grow + margin])
                 and np.array_equal(at[:margin] + start, sa[len(sa) - grow:len(sa) - grow + margin])
                 and np.array_equal(ids[-margin:], ib[grow - margin:grow])
                 and np.array_equal(at[-margin:] - (len(a) - start), sb[grow - margin:grow])
                 and sb[grow - 1] < stop)
        if agree:
            return (a + b, np.concatenate([ia[:len(ia) - grow], ids, ib[grow:]]),
                    np.concatenate([sa[:len(sa) - grow], at + start, sb[grow:] + len(a)]))
        grow *= 2
    ids, at = enc.spans(a + b)
    return (a + b, ids, at)


def tree(enc: Bpe, parts: list[Part], margin: int = MARGIN) -> np.ndarray:
    """Concatenate neighbours pair by pair until one sequence is left."""
    while len(parts) > 1:
        pairs = [join(enc, *parts[i:i + 2], margin) for i in range(0, len(parts) - 1, 2)]
        parts = pairs + parts[len(parts) // 2 * 2:]
    return parts[0][1]


def _rows(doc_ids: list, ids: list[np.ndarray], enc: Bpe) -> pa.RecordBatch:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
    flat = np.concatenate(ids) if ids else np.empty(0, np.int32)
    return pa.RecordBatch.from_arrays(
        [pa.array(doc_ids, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32())),
         pa.array([enc.written(x) for x in ids], pa.string()), pa.array([enc.decode(x) for x in ids], pa.string())],
        names=["doc_id", "ids", "ids_text", "decoded"])


def encode_documents(docs: DataFrame, vocabulary: str, leaf: int = LEAF, margin: int = MARGIN,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, ids_text, decoded): every text encoded by the tokenizers
    file at ``vocabulary``, its ids also as decimal text, and decoded back;
    texts over ``leaf`` characters as trees."""
    d = texts(docs, id_col, text_col)

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = bpe(vocabulary)
        for b in batches:
            for at in range(0, b.num_rows, 500):  # bounds what is encoded at a time
                part = b.slice(at, 500)
                yield _rows(part["doc_id"].to_pylist(), [enc.encode(x) for x in part["text"].to_pylist()], enc)
        enc.forget()

    # A row's own key: repeated rows and NULL ids stay apart.
    long = d.where(F.length("text") > leaf).withColumn("row", F.expr("uuid()"))
    cuts = F.sequence(F.lit(0), F.ceil(F.length("text") / leaf).cast("int") - 1)
    leaves = (long.select("doc_id", "row", "text", F.posexplode(cuts).alias("i", "cut"))
              .select("doc_id", "row", "i", F.substring("text", F.col("cut") * leaf + 1, F.lit(leaf)).alias("text"))
              .repartition("row", "i"))

    def leaf_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = bpe(vocabulary)
        for b in batches:
            for at in range(b.num_rows):
                row = b.slice(at, 1).to_pylist()[0]
                ids, start = enc.spans(row["text"])
                yield pa.RecordBatch.from_pylist([row | {"ids": ids.tolist(), "start": start.tolist()}], schema=pa.schema(
                    [("doc_id", pa.int64()), ("row", pa.string()), ("i", pa.int32()), ("text", pa.string()),
                     ("ids", pa.list_(pa.int32())), ("start", pa.list_(pa.int64()))]))
        enc.forget()

    def merged(pdf: pd.DataFrame) -> pd.DataFrame:
        enc = bpe(vocabulary)
        pdf = pdf.sort_values("i")
        whole = "".join(pdf["text"])
        if enc.special.search(whole):
            ids = enc.whole(whole)
        else:
            ids = tree(enc, [(t, np.asarray(x, np.int32), np.asarray(s, np.int64)) for t, x, s in
                             zip(pdf["text"], pdf["ids"], pdf["start"], strict=True)], margin)
        return pd.DataFrame({"doc_id": pdf["doc_id"].iloc[:1].astype("Int64"), "ids": [ids.tolist()],
                             "ids_text": [enc.written(ids)], "decoded": [enc.decode(ids)]})

    parts = leaves.mapInArrow(leaf_ids, "doc_id long, row string, i int, text string, ids array<int>, start array<long>")
    return (d.where(F.length("text") <= leaf).mapInArrow(short, ENCODED)
            .unionByName(parts.groupBy("row").applyInPandas(merged, ENCODED)))


def digests(encoded: DataFrame) -> DataFrame:
    """Number and SHA-256 of the ids (decimal, one space between) and of the decoded text."""
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                          F.sha2(F.col("ids_text").cast("binary"), 256).alias("ids_sha256"),
                          F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))

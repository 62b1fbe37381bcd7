"""Harmonic packing of tokenised documents into sequences of a fixed capacity.

A document is encoded with a public tokenizer and ended by id 0. Lengths are
partitioned into reciprocal-capacity classes: class k takes pieces no longer
than capacity / k, and each of its bins is filled with exactly k pieces, so a
bin is full by counting and no worker needs to know what another one has put
where. Cuts make the classes fit:

* whole blocks of ``capacity`` ids are class 1;
* of the rest, pieces of capacity/2, capacity/4, .. down to ``whole_below`` ids
  are cut off, one for each binary digit of its length: k of them fill their
  bin to the last id;
* what is left, under ``whole_below`` ids, is not cut: k = capacity // length
  of them make a bin, and at most length - 1 ids of it are padding.

Every task fills its own bins. Pieces that do not fill a bin by its end (at most
k - 1 in each class) are cut to powers of two and put together in sequences
whose length is a power of two, which need no padding. So padding does not grow
with the number of tasks, and nothing is shuffled.

The text is cut before each run of white space and before punctuation after a letter
or digit, where this vocabulary's pre-token pattern always cuts, and the ids of a
piece of text are looked up or made once. They are kept in two generations of about
``CACHE`` entries per Python worker. A text that holds the string of an added token is
encoded whole.

Edge cases: a null or empty text is the single id 0; repeated rows and rows
without doc_id are documents of their own; other columns are not read; an empty
table gives an empty result. A task holds one lot of texts (about a million
characters, or one longer text), the pieces of unfilled bins, and the two generations.
"""

from __future__ import annotations

import json
import re
import sys
import zlib
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callpulse.llm.bpe import _SPACE, _byte_letters, _lots

CACHE = 250_000
#: encoded pieces of text longer than this are not kept
LONG = 48
END = (0).to_bytes(4, "little")
#: ids of sequences: the task's number, then the sequence's within the task
TASK_SHIFT = 36
ROWS = 16_384

#: ASCII punctuation, and letters and digits that every Unicode version knows
_POINT, _ALNUM = r"!-/:-@\[-`{-~", "0-9A-Za-zÀ-ÖØ-öø-ÿ"
#: white space and what follows it, up to the next white space or to punctuation after a letter or digit
_PIECE = re.compile(f"[{_SPACE}]*(?:[{_POINT}]*[{_ALNUM}]++(?=[{_POINT}])|[^{_SPACE}]+)|[{_SPACE}]+")

PACKED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class Encoder(dict):
    """Ids of texts as little-endian 32-bit numbers; the dictionary holds those of pieces of text met lately.

    Pieces of plain letters go through the byte-pair ranks of the same file (a merge's id is its rank there),
    which is several times faster; all others, and texts with the string of an added token, through the tokenizers library.
    """

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        #: ids of one pre-token in bytes, and of a text of plain letters
        self.word = self.plain = None
        ranks = _ranks(path)
        if ranks:
            fast = tiktoken.Encoding("file", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})
            self.word, self.plain = fast._core_bpe.encode_single_piece, fast.encode_ordinary
        self.old: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return _little(self.library.encode(text, add_special_tokens=False).ids)

    def __missing__(self, piece: str) -> bytes:
        out = self.old.get(piece)
        if out is None:
            if self.word is not None and _WORD.fullmatch(piece):
                out = _little(self.word(piece.encode()))
            elif self.plain is not None and _PLAIN.fullmatch(piece):
                out = _little(self.plain(piece))
            else:
                out = self.whole(piece)
        if len(piece) <= LONG:
            self[piece] = out
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self) > CACHE:
            self.old = dict(self)
            self.clear()
        get = self.__getitem__
        return [
            self.whole(x) if any(t in x for t in self.added) else b"".join(map(get, _PIECE.findall(x)))
            for x in texts
        ]


#: one pre-token: letters with at most one space before them
_WORD = re.compile(" ?[A-Za-zÀ-ÖØ-öø-ÿ]+")
#: what one piece of plain letters may hold: ASCII and Latin-1 letters, on which all regex engines agree
_PLAIN = re.compile(f"[{_POINT}{_ALNUM} \\n\\t\\r]+")
#: the pre-token pattern of this vocabulary (fixed value)
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_NATIVE = array("I").itemsize == 4 and sys.byteorder == "little"


def _little(ids: list[int]) -> bytes:
    return array("I", ids).tobytes() if _NATIVE else np.array(ids, "<u4").tobytes()


def _ranks(path: str) -> dict[bytes, int] | None:
    """Bytes of every token to its id, if ids are in the order of merges, so that they serve as ranks; else None."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    letters, vocab = _byte_letters(), model["vocab"]
    merged = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
    singles = [vocab.get(c) for c in letters]
    if None in singles or merged != sorted(set(merged)) or max(singles) > min(merged, default=max(singles) + 1):
        return None
    ids = {vocab[c]: bytes([b]) for c, b in letters.items()}
    known = set(merged)
    for t, i in vocab.items():
        if i in known:
            ids[i] = bytes(letters[c] for c in t)
    return {b: i for i, b in ids.items()}


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


class Bins:
    """The bins of one task. ``add`` and ``close`` give packed rows to ``emit``."""

    def __init__(self, capacity: int, whole_below: int, first_sequence: int):
        if capacity & (capacity - 1) or whole_below & (whole_below - 1) or not 1 <= whole_below <= capacity:
            raise ValueError("capacity and whole_below must be powers of two, whole_below not above capacity")
        self.capacity, self.whole_below, self.next = capacity, whole_below, first_sequence
        self.open: dict[int, list[tuple]] = {}
        self.rows: list[tuple] = []

    def add(self, doc_id, ids: bytes) -> None:
        n, at, size = len(ids) // 4, 0, self.capacity
        while n - at >= size:
            self._put((doc_id, at, size, ids[4 * at : 4 * (at + size)], n))
            at += size
        while size > self.whole_below:
            size >>= 1
            if (n - at) & size:
                self._put((doc_id, at, size, ids[4 * at : 4 * (at + size)], n))
                at += size
        if at < n:
            self._put((doc_id, at, n - at, ids[4 * at :], n))

    def _put(self, piece: tuple) -> None:
        length = piece[2]
        k = self.capacity // length
        # only what may still be cut keeps its ids
        data = piece[3]
        piece = (*piece[:3], data if length & (length - 1) else zlib.crc32(data), piece[4])
        if k == 1:
            self._sequence([piece])
            return
        bin_ = self.open.setdefault(length, [])
        bin_.append(piece)
        if len(bin_) == k:
            self._sequence(bin_)
            self.open[length] = []

    def _sequence(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc_id, at, length, data, n in pieces:
            crc = zlib.crc32(data) if isinstance(data, bytes) else data
            self.rows.append((doc_id, at, length, crc, n, self.next, offset))
            offset += length
        self.next += 1

    def close(self) -> None:
        """Unfilled bins: cut to powers of two, then sequences of as many pieces as make a power of two."""
        for length in [x for x in self.open if x & (x - 1)]:
            for doc_id, at, _, data, n in self.open.pop(length):
                for size in (1 << b for b in range(length.bit_length() - 1, -1, -1)):
                    if length & size:
                        self._put((doc_id, at, size, data[: 4 * size], n))
                        at, data = at + size, data[4 * size :]
        for pieces in self.open.values():
            while pieces:
                some = 1 << (len(pieces).bit_length() - 1)
                self._sequence(pieces[:some])
                pieces = pieces[some:]
        self.open = {}

    def batch(self) -> pa.RecordBatch:
        cols = zip(*self.rows) if self.rows else [[]] * 7
        names = [x.split()[0] for x in PACKED.split(", ")]
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names)


def _packed(path: str, capacity: int, whole_below: int):
    def run(batches):
        enc = encoder(path)
        bins = Bins(capacity, whole_below, TaskContext.get().partitionId() << TASK_SHIFT)
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            for a, b in _lots(texts):
                for doc_id, x in zip(ids[a:b], enc.encode([t or "" for t in texts[a:b]])):
                    bins.add(doc_id, x + END)
                    if len(bins.rows) >= ROWS:
                        yield bins.batch()
        bins.close()
        yield bins.batch()

    return run


def pack_documents(docs: DataFrame, path: str, capacity: int = 1024, whole_below: int = 32) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``sequence_id`` is unique over the result. A sequence is the rows of one sequence_id in the order of
    offset; it holds at most ``capacity`` ids.
    """
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        _packed(path, capacity, whole_below), PACKED
    )


def padding(packed: DataFrame, capacity: int = 1024) -> DataFrame:
    """One row: sequences, ids, padded (ids added so that each sequence has ``capacity``, or a power of two)."""
    s = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    full = F.col("n").bitwiseAND(F.col("n") - 1) == 0
    return s.agg(
        F.count("*").alias("sequences"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("ids"),
        F.coalesce(F.sum(F.when(full, 0).otherwise(capacity - F.col("n"))), F.lit(0)).alias("padded"),
    )

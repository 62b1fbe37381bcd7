"""Byte-pair encoding and decoding with a segment tree over adjacent pair ranks.

The vocabulary and merges come from a byte-level BPE file in the JSON format of
the tokenizers library; its path is a parameter. A text is cut at the strings
of added tokens, then into pre-tokens; in each pre-token the leaves of a
segment tree hold (rank, place) of every adjacent pair that can merge, so the
root is the leftmost pair of lowest rank. A merge changes the leaf of the merged
pair and of its two neighbours, each a logarithmic path to the root, until the
root holds no pair. Short pre-tokens share one array of trees and merge side by
side; long ones have a tree of their own.

Results of pre-tokens are kept in two generations of about ``CACHE`` entries
per task; the older one is given up when the younger is full, and both at the
end of the task, so that a reused Python worker does not hold them.

Edge cases: null and empty texts have no tokens; a pre-token may be as long as
its text; rows are independent, so repeated rows, missing ids and other columns
change nothing; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CACHE = 120_000
SIDE_BY_SIDE = 64
NONE = np.int64(1) << np.int64(62)
PLACE_BITS = 32

#: white space as this vocabulary's pattern means it (fixed values)
_SPACE = "".join(map(chr, [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
#: the pre-token pattern of this vocabulary (fixed value)
_PRETOKEN = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_SPACE}\p{{L}}\p{{N}}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)


def _byte_letters() -> dict[str, int]:
    """The file writes each byte as one printable character: itself, or the next free one from U+0100."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Tokenizer:
    """Encoder and decoder for one byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = _byte_letters()
        vocab: dict[str, int] = spec["model"]["vocab"]
        self.bytes_of: dict[int, bytes] = {
            i: bytes(letters[c] for c in t) if all(c in letters for c in t) else t.encode() for t, i in vocab.items()
        }
        self.byte_id = np.zeros(256, np.int64)
        for c, b in letters.items():
            self.byte_id[b] = vocab[c]
        left, right, merged = [], [], []
        for m in spec["model"]["merges"]:
            x, y = m.split(" ") if isinstance(m, str) else m
            left.append(vocab[x])
            right.append(vocab[y])
            merged.append(vocab[x + y])
        pair = (np.array(left, np.int64) << 32) | np.array(right, np.int64)
        order = np.argsort(pair, kind="stable")
        self.pair, self.rank, self.merged = pair[order], np.arange(len(pair))[order], np.array(merged, np.int64)
        self._hash_table()
        self.rank_of = {int(p): int(r) for p, r in zip(self.pair, self.rank)}
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        for t, i in self.added.items():
            self.bytes_of[i] = t.encode()
        self.cut = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(self.added, key=len, reverse=True)) + ")") if self.added else None
        #: per pre-token its ids as ",id,id.." and the bytes they decode to; and the generation before
        self.ids: dict[str, str] = {}
        self.raw: dict[str, bytes] = {}
        self.old: tuple[dict[str, str], dict[str, bytes]] = ({}, {})

    # -- merging -----------------------------------------------------------

    def _hash_table(self) -> None:
        """Open addressing over all pairs, with as many probes as the fullest run needs."""
        self.shift = np.uint64(64 - max(4, (4 * len(self.pair)).bit_length()))
        size = 1 << (64 - int(self.shift))
        self.slot_pair, self.slot_rank = np.full(2 * size, -1, np.int64), np.full(2 * size, NONE)
        self.probes = 1
        for p, r, h in zip(self.pair.tolist(), self.rank.tolist(), self._slot(self.pair).tolist()):
            k = h
            while self.slot_pair[k] >= 0:
                k += 1
            self.slot_pair[k], self.slot_rank[k] = p, r
            self.probes = max(self.probes, k - h + 1)

    def _slot(self, p: np.ndarray) -> np.ndarray:
        return ((p.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        p = (a << 32) | b
        at = self._slot(p)
        seen = self.slot_pair[at]
        out = np.where(seen == p, self.slot_rank[at], NONE)
        live = np.flatnonzero((seen != p) & (seen >= 0))
        for k in range(1, self.probes):
            if not len(live):
                break
            seen = self.slot_pair[at[live] + k]
            hit = seen == p[live]
            out[live[hit]] = self.slot_rank[at[live[hit]] + k]
            live = live[~hit & (seen >= 0)]
        return out

    def _merge_together(self, parts: list[bytes], width: int) -> list[tuple[int, ...]]:
        """All parts have at most ``width`` bytes (a power of two)."""
        m = len(parts)
        n = np.array([len(p) for p in parts])
        token = np.full((m, width), -1, np.int64)
        fill = np.arange(width) < n[:, None]
        token[fill] = self.byte_id[np.frombuffer(b"".join(parts), np.uint8)]
        follow = np.where(np.arange(width) + 1 < n[:, None], np.arange(width) + 1, -1)
        before = np.broadcast_to(np.arange(width) - 1, (m, width)).copy()
        tree = np.full((m, 2 * width), NONE, np.int64)
        r, c = np.nonzero(follow >= 0)
        rank = self._ranks(token[r, c], token[r, c + 1])
        tree[r, width + c] = np.where(rank < NONE, (rank << PLACE_BITS) | c, NONE)
        k = width
        while k > 1:
            tree[:, k // 2 : k] = np.minimum(tree[:, k : 2 * k : 2], tree[:, k + 1 : 2 * k : 2])
            k //= 2
        levels = width.bit_length() - 1
        rows = np.flatnonzero(tree[:, 1] < NONE)
        while len(rows):
            root = tree[rows, 1]
            p = root & ((1 << PLACE_BITS) - 1)
            token[rows, p] = self.merged[root >> PLACE_BITS]
            q = follow[rows, p]
            token[rows, q] = -1
            nxt = follow[rows, q]
            follow[rows, p] = nxt
            has = nxt >= 0
            before[rows[has], nxt[has]] = p[has]
            tree[rows, width + q] = NONE
            for place, other, ok in ((p, nxt, has), (before[rows, p], p, before[rows, p] >= 0)):
                rr, x, y = rows[ok], place[ok], other[ok]
                rank = self._ranks(token[rr, x], token[rr, y])
                tree[rr, width + x] = np.where(rank < NONE, (rank << PLACE_BITS) | x, NONE)
            tree[rows[~has], width + p[~has]] = NONE
            spots = (q, p, np.maximum(before[rows, p], 0))
            for _ in range(levels):
                spots = tuple((s + width if _ == 0 else s) >> 1 for s in spots)
                for s in spots:
                    tree[rows, s] = np.minimum(tree[rows, 2 * s], tree[rows, 2 * s + 1])
            rows = rows[tree[rows, 1] < NONE]
        alive = token >= 0
        ids = token[alive].tolist()
        ends = np.cumsum(alive.sum(1)).tolist()
        return [tuple(ids[a:b]) for a, b in zip([0, *ends[:-1]], ends)]

    def _merge_alone(self, part: bytes) -> tuple[int, ...]:
        n = len(part)
        width = 1 << max(1, (n - 1).bit_length())
        none = int(NONE)
        token = self.byte_id[np.frombuffer(part, np.uint8)].tolist()
        follow = [*range(1, n), -1]
        before = list(range(-1, n - 1))
        get = self.rank_of.get
        merged = self.merged
        tree = [none] * (2 * width)

        def leaf(i: int, j: int) -> int:
            r = get((token[i] << 32) | token[j])
            return none if r is None else (r << PLACE_BITS) | i

        for i in range(n - 1):
            tree[width + i] = leaf(i, i + 1)
        for i in range(width - 1, 0, -1):
            tree[i] = min(tree[2 * i], tree[2 * i + 1])

        def put(i: int, value: int) -> None:
            i += width
            tree[i] = value
            while i > 1:
                i >>= 1
                low = tree[2 * i]
                if tree[2 * i + 1] < low:
                    low = tree[2 * i + 1]
                if tree[i] == low:
                    break
                tree[i] = low

        while tree[1] < none:
            root = tree[1]
            p = root & ((1 << PLACE_BITS) - 1)
            token[p] = int(merged[root >> PLACE_BITS])
            q = follow[p]
            token[q] = -1
            follow[p] = nxt = follow[q]
            put(q, none)
            if nxt >= 0:
                before[nxt] = p
            put(p, leaf(p, nxt) if nxt >= 0 else none)
            if before[p] >= 0:
                put(before[p], leaf(before[p], p))
        return tuple(t for t in token if t >= 0)

    def learn(self, parts: set[str]) -> None:
        """Encode pre-tokens that are not in the table yet."""
        groups: dict[int, list[tuple[str, bytes]]] = {}
        for s in parts:
            raw = s.encode("utf-8", "surrogatepass")
            if len(raw) > SIDE_BY_SIDE:
                self._keep(s, self._merge_alone(raw))
            else:
                groups.setdefault(1 << max(1, (len(raw) - 1).bit_length()), []).append((s, raw))
        for width, some in groups.items():
            for k in range(0, len(some), 8192):
                lot = some[k : k + 8192]
                for (s, _), ids in zip(lot, self._merge_together([b for _, b in lot], width)):
                    self._keep(s, ids)

    def _keep(self, s: str, ids: tuple[int, ...]) -> None:
        self.ids[s] = "".join([f",{i}" for i in ids])
        self.raw[s] = self.decode_bytes(ids)

    # -- texts ---------------------------------------------------------------

    def pretokens(self, text: str) -> list[str]:
        if self.cut is None or not any(t in text for t in self.added):
            return _PRETOKEN.findall(text)
        out: list[str] = []
        for k, piece in enumerate(self.cut.split(text)):
            if k % 2:
                self._keep(piece, (self.added[piece],))
                out.append(piece)
            else:
                out.extend(_PRETOKEN.findall(piece))
        return out

    def prepare(self, texts: list[str]) -> list[list[str]]:
        """Pre-tokens of each text, all of them in the table afterwards."""
        if len(self.ids) > CACHE:
            self.old = (self.ids, self.raw)
            self.ids, self.raw = {}, {}
        parts = [self.pretokens(t) for t in texts]
        new = set(chain.from_iterable(parts)).difference(self.ids)
        ids, raw = self.old
        again = new.intersection(ids)
        for x in again:
            self.ids[x], self.raw[x] = ids[x], raw[x]
        self.learn(new - again)
        return parts

    def forget(self) -> None:
        self.ids, self.raw, self.old = {}, {}, ({}, {})

    def encode(self, text: str) -> list[int]:
        (parts,) = self.prepare([text])
        return numbers("".join(map(self.ids.__getitem__, parts)))

    def decode_bytes(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def decode(self, ids) -> str:
        """Unknown ids are passed over; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(self.bytes_of.get(i, b"") for i in ids).decode("utf-8", "replace")


def numbers(ids: str) -> list[int]:
    return [int(x) for x in ids[1:].split(",")] if ids else []


@lru_cache(maxsize=2)
def tokenizer(path: str) -> Tokenizer:
    return Tokenizer(path)


def _lots(texts: list[str | None], limit: int = 1 << 20):
    """Row ranges of about ``limit`` characters."""
    a = size = 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= limit:
            yield a, i + 1
            a, size = i + 1, 0
    if a < len(texts):
        yield a, len(texts)


def _encoded(path: str, with_ids: bool):
    def run(batches):
        tok = tokenizer(path)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in _lots(texts):
                parts = tok.prepare([t or "" for t in texts[a:b]])
                n, digest, decoded, ids = [], [], [], []
                for p in parts:
                    got = "".join(map(tok.ids.__getitem__, p))
                    n.append(got.count(","))
                    digest.append(hashlib.sha256(got[1:].encode()).hexdigest())
                    raw = b"".join(map(tok.raw.__getitem__, p))
                    decoded.append(hashlib.sha256(raw.decode("utf-8", "replace").encode()).hexdigest())
                    if with_ids:
                        ids.append(numbers(got))
                cols = [batch.column("doc_id").slice(a, b - a), pa.array(n, pa.int64()), pa.array(digest, pa.string()), pa.array(decoded, pa.string())]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    cols.append(pa.array(ids, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names)
        tok.forget()

    return run


def encode_texts(docs: DataFrame, path: str, with_ids: bool = True) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256 and, with ``with_ids``, ids."""
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if with_ids else "")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        _encoded(path, with_ids), schema
    )


def decode_ids(rows: DataFrame, path: str) -> DataFrame:
    """rows with ids array<int> (null: empty) -> doc_id, text."""

    def run(batches):
        tok = tokenizer(path)
        for batch in batches:
            texts = [tok.decode(x or []) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids")).mapInArrow(
        run, "doc_id long, text string"
    )

"""Removal of byte strings that occur earlier in the corpus (sampled suffix sorting, deep-shallow).

Every ``size``-byte string of a document is *owned* by its leftmost smallest
``GRAM``-byte gram (a hash order). Equal strings own equal grams at the same
offset, so only strings whose gram occurs at least twice can repeat, and equal
strings can be found among the occurrences of one gram. The owned strings of
one gram occurrence are consecutive: together they form a *block* of bytes.

Steps:

1. count the grams (pre-aggregated per document and by the partial groupBy);
2. bring the repeated grams back to their documents and hash their blocks;
   equal blocks collapse onto their earliest one, all strings of the later
   ones are repeats;
3. a gram with several different blocks needs an order: the earliest copy of
   each of these blocks is cut from its document, and the suffixes of all the
   blocks of a gram are sorted deep-shallow (``suffix_sort``) to ``size``
   bytes; in each class of equal prefixes all but the earliest are repeats;
4. the union of the repeats is removed.

Hot grams: steps 1 and 2 aggregate partially and join on hashes, where AQE can
split skewed sides. Step 3 sorts the different blocks of a gram together only
up to ``HOT`` of them. The blocks of other grams are cut into sub-blocks by the
distance from a string's start to the gram (``WIDTHS`` distances each). All
strings of a sub-block share its core, and equal strings share core and
distance, so a core is a narrower gram: equal sub-blocks collapse as in step 2,
up to ``HOT`` different ones are sorted, the rest is cut down to single strings,
of which none differ once equal ones have collapsed.
Blocks of one partition are sorted in lots of about ``LOT`` bytes.

Edge cases: null text is empty; a text of fewer than ``size`` bytes loses
nothing; ties cannot occur (the order is doc_id, then place); rows that repeat
a doc_id with the same text get the same result, judged as one document; rows
without doc_id keep all bytes and cause no removals; other columns are ignored;
an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callpulse.llm import kernels as K
from callpulse.llm.substring_dedup import _lists, _pieces
from callpulse.llm.suffix_sort import classes
from callpulse.llm.workspace import Workspace, splittable

SIZE = 100
GRAM = 24
LOT = 1 << 18
HOT = 2048
WIDTHS = (8, 1)


def _gram(size: int) -> int:
    return max(1, min(GRAM, size // 3))


def blocks(data: np.ndarray, off: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
    """For the owned blocks of all rows: first string start, number of strings, row, gram hash."""
    gram = _gram(size)
    n = len(data) - size + 1
    if n <= 0:
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),)
    full = K.run_hash(K.BYTE[data], gram)
    bits = np.uint64(max(1, int(len(full)).bit_length()))
    key = (full >> bits << bits) | np.arange(len(full), dtype=np.uint64)
    low, span, w = key, 1, size - gram + 1
    while span * 2 <= w:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if span < w:
        low = np.minimum(low[: len(low) - (w - span)], low[w - span :])
    place = (low & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    # strings that lie in one row
    whole = np.zeros(len(data) + 1, np.int32)
    length = np.diff(off)
    long = length >= size
    whole[off[:-1][long]] += 1
    whole[(off[1:] - size + 1)[long]] -= 1
    start = np.flatnonzero(np.cumsum(whole[:n]))
    place = place[start]
    new = np.ones(len(start), bool)
    new[1:] = (place[1:] != place[:-1]) | (start[1:] != start[:-1] + 1)
    lead = np.flatnonzero(new)
    count = np.diff(np.append(lead, len(start)))
    at = start[lead]
    return at, count, np.searchsorted(off, at, "right") - 1, full[place[lead]]


def _gram_rows(size: int):
    def run(batches):
        for batch in batches:
            docs = batch.column("doc_id").to_numpy(zero_copy_only=False)
            for a, b, data, off in _pieces(batch):
                _, _, row, h = blocks(data, off, size)
                order = np.lexsort((h, row))
                h, row = h[order], row[order]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
                lead = np.flatnonzero(new)
                several = np.minimum(np.diff(np.append(lead, len(h))), 2)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(h[lead].view(np.int64)),
                        pa.array(docs[a:b][row[lead]].astype(np.int64)),
                        pa.array(several.astype(np.int32)),
                    ],
                    ["h", "doc", "n"],
                )

    return run


def _block_rows(size: int):
    """Blocks of the repeated grams: gram, 128-bit hash, document, first start, number of strings."""

    def run(batches):
        for batch in batches:
            docs = batch.column("doc_id").to_numpy(zero_copy_only=False)
            for a, b, data, off in _pieces(batch):
                at, count, row, h = blocks(data, off, size)
                hit, hit_row = _lists(batch.column("hs"), a, b)
                known = K.mix(hit.astype(np.int64).view(np.uint64) + K.mix(hit_row.astype(np.uint64)))
                keep = np.isin(K.mix(h + K.mix(row.astype(np.uint64))), known)
                at, count, row, h = at[keep], count[keep], row[keep], h[keep]
                end = at + count + size - 1
                values = K.BYTE[data]
                c1 = K.span_hash(values, at, end)
                c2 = K.mix(K.span_hash(K.mix(values), at, end, K.BASE2) + count.astype(np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(h.view(np.int64)),
                        pa.array(c1.view(np.int64)),
                        pa.array(c2.view(np.int64)),
                        pa.array(docs[a:b][row].astype(np.int64)),
                        pa.array(at - off[row]),
                        pa.array(count.astype(np.int32)),
                    ],
                    ["h", "c1", "c2", "doc", "at", "n"],
                )

    return run


def _cut(size: int):
    """The bytes of the asked blocks of each document."""

    def run(batches):
        for batch in batches:
            for a, b, data, off in _pieces(batch):
                want = batch.column("want").slice(a, b - a)
                row = np.repeat(np.arange(b - a), np.asarray(pa.compute.list_value_length(want)))
                flat = want.flatten()
                h, at, n, hot = (flat.field(k).to_numpy(zero_copy_only=False) for k in ("h", "at", "n", "hot"))
                raw = data.tobytes()
                lo = off[row] + at
                hi = lo + n + size - 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(h),
                        batch.column("doc_id").slice(a, b - a).take(pa.array(row)),
                        pa.array(at),
                        pa.array(n),
                        pa.array(hot),
                        pa.array([raw[x:y] for x, y in zip(lo.tolist(), hi.tolist())], pa.binary()),
                    ],
                    ["gram", "doc", "at", "n", "hot", "bytes"],
                )

    return run


def _narrow(size: int, width: int):
    """Blocks cut by the distance of a string's start to the gram: core hash, 128-bit hash, place and bytes of each part."""
    gram = _gram(size)

    def run(batches):
        for batch in batches:
            whole, off_all = K.utf8(batch.column("bytes"))
            for a, b in K.pieces(off_all):
                data, off = whole[off_all[a] : off_all[b]], off_all[a:b] - off_all[a]
                h, doc, at, n = (batch.column(c).to_numpy(zero_copy_only=False)[a:b].astype(np.int64) for c in ("gram", "doc", "at", "n"))
                values = K.BYTE[data]
                # the gram's place is its leftmost one that all strings of the block hold
                room = size - gram - n + 2
                row = np.repeat(np.arange(b - a), room)
                idx = np.repeat(off + n - 1, room) + K.segments(room)
                same = np.flatnonzero(K.run_hash(values, gram)[idx] == h.view(np.uint64)[row])
                place = np.empty(b - a, np.int64)
                found, lead = np.unique(row[same], return_index=True)
                place[found] = idx[same[lead]]
                low = (place - off - n + 1) // width
                parts = (place - off) // width - low + 1
                row = np.repeat(np.arange(b - a), parts)
                near = (low[row] + K.segments(parts)) * width
                far = np.minimum(near + width - 1, size - gram)
                lo = np.maximum(off[row], place[row] - far)
                hi = np.minimum(off[row] + n[row] - 1, place[row] - near) + size
                core = K.span_hash(values, place[row] - near, place[row] - far + size)
                core = K.mix(core + K.mix(h.view(np.uint64)[row] + near.astype(np.uint64)))
                s1 = K.span_hash(values, lo, hi)
                s2 = K.mix(K.span_hash(K.mix(values), lo, hi, K.BASE2) + (hi - lo).astype(np.uint64))
                raw = data.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(h[row]),
                        pa.array(core.view(np.int64)),
                        pa.array(s1.view(np.int64)),
                        pa.array(s2.view(np.int64)),
                        pa.array(doc[row]),
                        pa.array(at[row] + lo - off[row]),
                        pa.array((hi - lo - size + 1).astype(np.int32)),
                        pa.array([raw[x:y] for x, y in zip(lo.tolist(), hi.tolist())] if width > 1 else [None] * len(row), pa.binary()),
                    ],
                    ["gram", "h", "c1", "c2", "doc", "at", "n", "bytes"],
                )

    return run


def _sorted_repeats(size: int):
    """Repeats among blocks that arrive ordered by gram: doc, first start, number of strings of each run."""

    def settle(table: pa.Table):
        data, off = K.utf8(table["bytes"].combine_chunks())
        doc, at, n = (table[c].to_numpy().astype(np.int64) for c in ("doc", "at", "n"))
        inner = K.segments(n)
        block = np.repeat(np.arange(len(n)), n)
        text = np.concatenate([data, np.zeros(size + 16, np.uint8)])
        order, cls = classes(text, off[block] + inner, size)
        # the earliest member of each class; blocks rank by (doc, at), a repeated row's blocks alike
        by = np.lexsort((at, doc))
        up = np.ones(len(n), bool)
        up[1:] = (doc[by][1:] != doc[by][:-1]) | (at[by][1:] != at[by][:-1])
        rank = np.empty(len(n), np.int64)
        rank[by] = np.cumsum(up)
        mine = rank[block[order]]
        lead = np.flatnonzero(np.append(True, cls[1:] != cls[:-1])) if len(cls) else np.empty(0, np.int64)
        if not len(lead):
            return None
        first = np.repeat(np.minimum.reduceat(mine, lead), np.diff(np.append(lead, len(cls))))
        gone = np.sort(order[mine > first])
        b, p = block[gone], at[block[gone]] + inner[gone]
        new = np.ones(len(gone), bool)
        new[1:] = (b[1:] != b[:-1]) | (p[1:] != p[:-1] + 1)
        s = np.flatnonzero(new)
        return pa.RecordBatch.from_arrays(
            [pa.array(doc[b[s]]), pa.array(p[s]), pa.array(np.diff(np.append(s, len(gone))).astype(np.int32))], ["doc", "at", "n"]
        )

    def run(batches):
        held: list[pa.RecordBatch] = []
        weight = 0
        for batch in batches:
            held.append(batch)
            weight += batch.column("bytes").nbytes
            if weight < LOT:
                continue
            table = pa.Table.from_batches(held)
            h = table["h"].to_numpy()
            cut = int(np.searchsorted(h, h[-1]))  # ascending: the last gram may go on
            if cut:
                if (out := settle(table.slice(0, cut))) is not None:
                    yield out
                held = table.slice(cut).combine_chunks().to_batches()
                weight = sum(x.column("bytes").nbytes for x in held)
        if held and (out := settle(pa.Table.from_batches(held))) is not None:
            yield out

    return run


def _kept(texts: pa.Array, runs: pa.Array, size: int):
    """For pieces of rows: first row, offsets, removed bytes and spans per row, and the kept bytes of each row."""
    whole, off_all = K.utf8(texts)
    for a, b in K.pieces(off_all):
        data, off = whole[off_all[a] : off_all[b]], off_all[a : b + 1] - off_all[a]
        part = runs.slice(a, b - a)
        row = np.repeat(np.arange(b - a), np.asarray(pa.compute.fill_null(pa.compute.list_value_length(part), 0)))
        flat = part.flatten()
        lo = off[row] + flat.field("at").to_numpy(zero_copy_only=False).astype(np.int64)
        hi = np.minimum(lo + flat.field("n").to_numpy(zero_copy_only=False).astype(np.int64) + size - 1, off[row + 1])
        d = np.bincount(lo, minlength=len(data) + 1) - np.bincount(hi, minlength=len(data) + 1)
        gone = np.cumsum(d[: len(data)]) > 0
        starts = gone.copy()
        starts[1:] &= ~gone[:-1]
        edge = off[1:-1][off[1:-1] < len(data)]
        starts[edge] = gone[edge]
        total, spans = (np.concatenate([[0], np.cumsum(x)]) for x in (gone, starts))
        kept = [data[x:y][~gone[x:y]].tobytes() for x, y in zip(off[:-1].tolist(), off[1:].tolist())]
        yield a, b, off, total[off[1:]] - total[off[:-1]], spans[off[1:]] - spans[off[:-1]], kept


def _results(size: int, texts: bool):
    def run(batches):
        for batch in batches:
            for a, b, off, removed, spans, kept in _kept(batch.column("text"), batch.column("runs"), size):
                cols = [
                    batch.column("doc_id").slice(a, b - a),
                    pa.array(np.diff(off)),
                    pa.array(removed),
                    pa.array(spans),
                    pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()),
                ]
                names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
                if texts:  # a cut inside a character drops what is left of it
                    cols.append(pa.array([x.decode("utf-8", "ignore") for x in kept], pa.string()))
                    names.append("kept_text")
                yield pa.RecordBatch.from_arrays(cols, names)

    return run


def _stripped(size: int):
    """The text of each row replaced by what is kept of it, as column __kept."""

    def run(batches):
        for batch in batches:
            out = [x.decode("utf-8", "ignore") for *_, kept in _kept(batch.column("text"), batch.column("__runs"), size) for x in kept]
            i = batch.schema.get_field_index("text")
            null = batch.column("text").is_null().to_pylist()
            text = pa.array([None if z else x for x, z in zip(out, null)], pa.string())
            names = batch.schema.names[:-1]
            yield pa.RecordBatch.from_arrays([text if k == i else batch.column(k) for k in range(len(names))], names)

    return run


def _earliest(blocks: DataFrame) -> DataFrame:
    return blocks.groupBy("h", "c1", "c2").agg(F.min(F.struct("doc", "at", "n")).alias("e")).select("h", "c1", "c2", "e.*")


def _later(blocks: DataFrame, first: DataFrame) -> DataFrame:
    """The blocks that equal an earlier one."""
    both = blocks.alias("f").join(first.alias("e"), ["h", "c1", "c2"])
    return both.where("f.doc > e.doc or (f.doc = e.doc and f.at > e.at)").select("f.doc", "f.at", "f.n")


def _contested(first: DataFrame, hot: int) -> DataFrame:
    """The first of each of several different blocks of one key, and whether they are too many to sort together."""
    many = first.groupBy("h").agg((F.count("*") > hot).alias("hot"), F.count("*").alias("k")).where("k > 1")
    return first.join(splittable(many.select("h", "hot"), "h"), "h")


def _sorted(cut: DataFrame, key: str, size: int) -> DataFrame:
    of = cut.where("not hot").select(F.col(key).alias("h"), "doc", "at", "n", "bytes")
    return of.repartition("h").sortWithinPartitions("h").mapInArrow(_sorted_repeats(size), "doc long, at long, n int")


def repeated_runs(docs: DataFrame, size: int, work: Workspace, hot: int = HOT) -> DataFrame:
    """doc, runs: starts (at) and numbers (n) of consecutive size-byte strings that occur earlier; docs: doc_id, text."""
    named = docs.where("doc_id is not null")
    grams = work.table(named.mapInArrow(_gram_rows(size), "h long, doc long, n int"), "grams")
    shared = grams.groupBy("h").agg(F.sum("n").alias("n")).where("n > 1").select("h")
    lists = work.table(grams.join(splittable(shared, "h"), "h").groupBy("doc").agg(F.collect_set("h").alias("hs")), "shared")
    work.delete("grams")
    found = work.table(
        named.join(lists, named.doc_id == lists.doc).select("doc_id", "text", "hs").mapInArrow(
            _block_rows(size), "h long, c1 long, c2 long, doc long, at long, n int"
        ),
        "blocks",
    )
    work.delete("shared")
    first = work.table(_earliest(found), "first")
    wanted = _contested(first, hot).groupBy("doc").agg(F.collect_list(F.struct("h", "at", "n", "hot")).alias("want"))
    cut = work.table(
        named.join(wanted, F.col("doc_id") == F.col("doc")).select("doc_id", "text", "want").mapInArrow(
            _cut(size), "gram long, doc long, at long, n int, hot boolean, bytes binary"
        ),
        "cut",
    )
    parts = [_later(found, first), _sorted(cut, "gram", size)]
    used = ["blocks", "first", "cut"]
    for width in WIDTHS:
        left = cut.where("hot")
        if left.isEmpty():
            break
        names = [f"{x}-{width}" for x in ("blocks", "first", "cut")]
        used += names
        schema = "gram long, h long, c1 long, c2 long, doc long, at long, n int, bytes binary"
        found = work.table(left.mapInArrow(_narrow(size, width), schema), names[0])
        first = work.table(_earliest(found), names[1])
        parts.append(_later(found, first))
        if width > 1:
            texts = found.select("h", "c1", "c2", "doc", "at", "gram", "bytes")
            cut = work.table(_contested(first, hot).join(texts, ["h", "c1", "c2", "doc", "at"]), names[2])
            parts.append(_sorted(cut, "h", size))
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    runs = work.table(every.groupBy("doc").agg(F.collect_set(F.struct("at", "n")).alias("runs")), "runs")
    for name in used:
        work.delete(name)
    return runs


def _plain(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def remove_repeated_bytes(
    docs: DataFrame, size: int = SIZE, texts: bool = True, work: Workspace | None = None, hot: int = HOT
) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, with ``texts``, kept_text."""
    docs = _plain(docs)
    runs = repeated_runs(docs, size, work or Workspace(docs.sparkSession, "suffix-dedup"), hot)
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept_text string" if texts else "")
    return docs.join(runs, docs.doc_id == runs.doc, "left").select("doc_id", "text", "runs").mapInArrow(_results(size, texts), schema)


def strip_repeated_bytes(docs: DataFrame, size: int = SIZE, work: Workspace | None = None) -> DataFrame:
    """The same rows and columns with every repeated byte taken out of text (an n_chars column follows it)."""
    runs = repeated_runs(_plain(docs), size, work or Workspace(docs.sparkSession, "suffix-dedup"))
    runs = runs.select(F.col("doc").alias("__doc"), F.col("runs").alias("__runs"))
    joined = docs.join(runs, docs["doc_id"] == runs["__doc"], "left").drop("__doc")
    out = joined.mapInArrow(_stripped(size), docs.schema)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out

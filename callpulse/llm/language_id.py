"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1 (``DIMENSIONS`` long, drawn from
its code point). A letter trigram is bound by multiplying its first letter's
vector permuted (rolled) twice, the second's permuted once and the third's. A
document's profile bundles (adds) the vectors of its trigrams; a language's
prototype bundles the unit profiles of its training documents. A document gets
the language of the prototype with the largest cosine.

Letters are lower-cased; everything that is not a letter counts as one
boundary, so trigrams hold word starts and ends. Trigrams of a piece of text are
counted per document and multiplied into the vectors of the distinct ones.

Training uses about ``TRAINING_ROWS`` labelled rows at most (a documented bound,
drawn by a hash of doc_id; up to the bound every labelled row is used). The prototypes, one vector per language,
are the only thing that reaches the driver. They are centred on their mean, so
that what all languages share does not count.

Edge cases: ``und`` with score 0 for a null text or one without a letter, and
for every text if there was no training row; a tie goes to the language first
in order; repeated rows get the same result; a row without doc_id counts as the
empty id; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

DIMENSIONS = 512
GRAM = 3
TRAINING_ROWS = 20_000
PIECE = 1 << 18
DENSE = 1 << 21


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


@lru_cache(maxsize=1 << 14)
def _vector(code: int) -> np.ndarray:
    return np.random.default_rng(1_000_003 + code).integers(0, 2, DIMENSIONS).astype(np.float32) * 2 - 1


def profiles(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Profiles (rows x DIMENSIONS) and whether a row has a letter."""
    low = [(t or "").lower() for t in texts]
    size = np.array([len(t) + 2 for t in low])
    code = np.frombuffer("".join(f" {t} " for t in low).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    row = np.repeat(np.arange(len(low)), size)
    letter = _letters()[code]
    code = np.where(letter, code, 0)
    has = np.bincount(row[letter], minlength=len(low)) > 0
    # one boundary for a run of other characters
    keep = letter.copy()
    keep[0] = True
    keep[1:] |= letter[:-1] | (row[1:] != row[:-1])
    code, row = code[keep], row[keep]
    out = np.zeros((len(low), DIMENSIONS), np.float32)
    n = len(code) - GRAM + 1
    if n <= 0:
        return out, has
    seen = np.zeros(0x110000, bool)
    seen[code] = True
    alphabet = np.flatnonzero(seen)
    index = np.zeros(0x110000, np.int64)
    index[alphabet] = np.arange(len(alphabet))
    c = index[code]
    gram = (c[:n] * len(alphabet) + c[1 : n + 1]) * len(alphabet) + c[2 : n + 2]
    ok = row[:n] == row[2 : n + 2]
    gram, r = gram[ok], row[:n][ok]
    space = len(alphabet) ** GRAM
    if space <= DENSE:
        present = np.flatnonzero(np.bincount(gram, minlength=space))
        back = np.zeros(space, np.int64)
        back[present] = np.arange(len(present))
        gram = back[gram]
    else:
        present, gram = np.unique(gram, return_inverse=True)
    base = np.stack([_vector(int(a)) for a in alphabet])
    a = len(alphabet)
    first, second = np.roll(base, 2, 1), np.roll(base, 1, 1)
    width = 4096
    for k in range(0, len(present), width):
        p = present[k : k + width]
        vectors = first[p // (a * a)] * second[p // a % a] * base[p % a]
        mine = (gram >= k) & (gram < k + width) if len(present) > width else slice(None)
        counts = np.bincount(r[mine] * len(p) + gram[mine] - k, minlength=len(low) * len(p)).astype(np.float32)
        out += counts.reshape(len(low), len(p)) @ vectors
    return out, has


def _rows(texts: list[str | None]):
    """Row ranges whose count matrix stays small."""
    a = size = 0
    for i, t in enumerate(texts):
        size += len(t or "") + 2
        if size >= PIECE or i + 1 - a >= 256:
            yield a, i + 1
            a, size = i + 1, 0
    if a < len(texts):
        yield a, len(texts)


def _unit(x: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, n, out=np.zeros_like(x), where=n > 0)


def _bundles(batches):
    total: dict[str, np.ndarray] = {}
    count: dict[str, int] = {}
    for batch in batches:
        texts, langs = batch.column("text").to_pylist(), np.array(batch.column("lang").to_pylist(), dtype=object)
        for a, b in _rows(texts):
            x, has = profiles(texts[a:b])
            x = _unit(x)
            for lang in set(langs[a:b][has]):
                m = has & (langs[a:b] == lang)
                total[lang] = total.get(lang, 0) + x[m].sum(0, dtype=np.float64)
                count[lang] = count.get(lang, 0) + int(m.sum())
    if total:
        yield pa.RecordBatch.from_pydict(
            {
                "lang": pa.array(list(total), pa.string()),
                "n": pa.array([count[k] for k in total], pa.int64()),
                "v": pa.array([total[k].tolist() for k in total], pa.list_(pa.float64())),
            }
        )


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text modulo 4 is 2; those rows are never learned from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def train(docs: DataFrame, bound: int = TRAINING_ROWS) -> dict[str, np.ndarray]:
    """Prototype of each language from labelled rows (doc_id, text, lang) that are not held out."""
    rows = docs.where(F.col("lang").isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id", "text", "lang")
    labelled = rows.select("lang").groupBy("lang").count().collect()  # one row per language
    total = sum(r["count"] for r in labelled)
    if total > bound:
        # an equal share for each language, small ones keep everything
        share = bound / len(labelled)
        rate = F.lit(1.0)
        for r in labelled:
            rate = F.when(F.col("lang") == r["lang"], F.lit(min(1.0, share / r["count"]))).otherwise(rate)
        rows = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < rate * (1 << 20))
    parts = rows.mapInArrow(_bundles, "lang string, n long, v array<double>")
    sums = parts.select("lang", F.posexplode("v").alias("i", "x")).groupBy("lang").agg(
        F.sort_array(F.collect_list(F.struct("i", "x"))).alias("v")
    )
    found: dict[str, np.ndarray] = {}
    for r in sums.collect():  # DIMENSIONS entries per language and task
        v = np.zeros(DIMENSIONS)
        for e in r["v"]:
            v[e["i"]] += e["x"]
        found[r["lang"]] = v / np.linalg.norm(v) if v.any() else v
    if len(found) > 1:
        mean = np.mean(list(found.values()), axis=0)
        found = {k: v - mean for k, v in found.items()}
    return {k: found[k] for k in sorted(found)}


def free_name(stem: str, columns: list[str]) -> str:
    """A column name that none of ``columns`` has, in any case."""
    used = {c.lower() for c in columns}
    return next(n for n in (f"__{stem}{i}" for i in count()) if n not in used)


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray], into: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """docs with text -> all columns and lang_pred, score (cosine cut to 0..1), or under the two names of ``into``."""
    names = list(prototypes)
    matrix = _unit(np.array([prototypes[k] for k in names], np.float64).reshape(len(names), DIMENSIONS)).astype(np.float32)
    columns = docs.columns

    def run(batches):
        for batch in batches:
            texts = batch.column(at).to_pylist()
            for a, b in _rows(texts):
                x, has = profiles(texts[a:b])
                if names:
                    cos = _unit(x) @ matrix.T
                    best = cos.argmax(1)
                    lang = [names[k] if ok else "und" for k, ok in zip(best, has)]
                    score = np.where(has, np.clip(cos[np.arange(b - a), best], 0, 1), 0).astype(np.float64)
                else:
                    lang, score = ["und"] * (b - a), np.zeros(b - a)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(i).slice(a, b - a) for i in range(len(columns))] + [pa.array(lang, pa.string()), pa.array(score)],
                    [*columns, *into],
                )

    # a text that is a string already is not handed over a second time
    own = "text" in columns and docs.schema["text"].dataType == StringType()
    at = columns.index("text") if own else len(columns)
    cast = [] if own else [F.col("text").cast("string").alias(free_name("text", columns))]
    full = docs.select(*[F.col(f"`{c}`") for c in columns], *cast)
    if {c.lower() for c in into} & {c.lower() for c in columns}:
        raise ValueError(f"columns {' and '.join(into)} are reserved; give other names in into")
    # a schema of its own: add() changes the one that docs keeps, and with it docs.columns
    return full.mapInArrow(run, StructType(list(docs.schema.fields)).add(into[0], "string").add(into[1], "double"))


def identify_languages(docs: DataFrame, bound: int = TRAINING_ROWS) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score."""
    docs = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")
    )
    return predict(docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text"), train(docs, bound)).drop("text")

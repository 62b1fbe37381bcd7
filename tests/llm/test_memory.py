"""What tasks hold at once stays small: row groups, Arrow batches, pieces."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from callpulse.llm import kernels as K
from callpulse.llm.language_id import DIMENSIONS, predict
from callpulse.llm.workspace import Workspace


def test_tables_are_written_in_small_row_groups(spark):
    work = Workspace(spark, "test")
    t = work.table(spark.range(0, 4_000_000, 1, 1).select(F.xxhash64("id").alias("h")), "t")
    (file,) = t.inputFiles()
    meta = pq.ParquetFile(file.removeprefix("file://")).metadata
    assert meta.num_rows == 4_000_000 and meta.row_group(0).column(0).compression == "ZSTD"
    assert max(meta.row_group(i).total_byte_size for i in range(meta.num_row_groups)) < 20 << 20
    work.drop()


def test_batches_of_whole_texts_are_small(spark):
    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], ["n", "size"])

    work = Workspace(spark, "test")
    rows = spark.range(0, 3000, 1, 1).select(F.repeat(F.lit("x"), 8000).alias("text"))
    got = work.table(rows.mapInArrow(run, "n long, size long"), "t").collect()
    assert sum(r["n"] for r in got) == 3000 and max(r["size"] for r in got) < 5 << 20
    work.drop()


def test_prediction_hands_a_string_over_once(spark):
    docs = spark.createDataFrame([(1, b"abc def", "abc def"), (2, None, None)], "doc_id long, raw binary, text string")
    only = {"": np.zeros(DIMENSIONS)}

    def sent(df):
        return df._jdf.queryExecution().analyzed().children().head().output().size()

    once = predict(docs, only)
    assert sent(once) == 3 and [tuple(r)[2:4] for r in once.orderBy("doc_id").collect()] == [("abc def", ""), (None, "und")]
    cast = predict(docs.select("doc_id", F.col("raw").alias("text")), only)
    assert sent(cast) == 3 and [r["lang_pred"] for r in cast.orderBy("doc_id").collect()] == ["", "und"]
    assert cast.schema["text"].dataType.typeName() == "binary"


def test_powers_of_a_piece_fit_its_size():
    assert len(K._powers(K.BASE, 1 << 19)) > K.PIECE
    assert K.powers(K.BASE, K.PIECE + 1).base.nbytes <= 4 << 20

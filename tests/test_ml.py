"""Model fit / score round trip (rows-only queries of the driver)."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import functions as F

from callpulse.config import Config
from callpulse.operators import ml as ML
from callpulse.operators import sinks as SK
from callpulse.plans.catalog import Ctx

SF = "/root/testdata/sf0.01"


def test_train_save_load_score(spark):
    cfg = Config(num_trees=10, min_instances_per_node=5, min_samples_split=12)
    ctx = Ctx(spark, SF, cfg)
    model, metrics = ML.train(ctx.matrix, cfg)
    m = metrics.first()
    assert m["n_train"] > 0
    scored = ML.score_output(model, ML.scoring_matrix(ctx, cfg), cfg)
    rows = scored.collect()
    assert all(0.0 <= r["proba"] <= 1.0 for r in rows)
    path = os.path.join(tempfile.mkdtemp(prefix="callpulse-model-"), "m")
    SK.save_model(spark, model, path)
    again = ML.score_output(SK.load_model(spark, path), ML.scoring_matrix(ctx, cfg), cfg)
    a = {(r["opp_id"], r["proba"]) for r in rows}
    b = {(r["opp_id"], r["proba"]) for r in again.collect()}
    assert a == b
    assert scored.where(F.col("missing_values").isNull()).count() == 0

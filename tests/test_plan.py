"""End-to-end job over layers written as Parquet (WKB geometry)."""

import os

import pytest

from tessera.plans import fixtures as fx
from tessera.plans import grid_model
from tessera.sources import layers as ly

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
def test_grid_model_run_writes_scored_grid(spark, tmp_dir):
    base = os.path.join(tmp_dir, "layers")
    for name, df in fx.layers(spark, SF).items():
        ly.write_layer(df, os.path.join(base, ly.LAYER_FILES[name]))
    out = os.path.join(tmp_dir, "scored.parquet")
    cols = grid_model.Columns(speed="speed", sign_code="mutcddescd", object_id="objectid",
                              material="materiald", median_type="typed")
    res = grid_model.run(spark, base, out, cols)
    written = ly.read_layer(spark, out)
    assert written.count() == 400
    assert {"id", "prediction", "geom"} <= set(written.columns)
    nulls = grid_model.prediction_nulls(written).first()
    road_cells = res.features.count()
    assert nulls["no_prediction"] == 400 - road_cells
    assert res.profile.count() == 9
    assert res.rmse.first()["rmse"] >= 0


def test_forest_does_not_depend_on_partitioning(spark):
    from tessera.operators import model as ml
    rows = [(k, k % 17 + 0.5 * (k % 5), float(k % 11), k % 7) for k in range(300)]
    data = spark.createDataFrame(rows, "grid_id long, a double, b double, crash_count long")
    found = [sorted(ml.score_all(ml.fit_forest(data.repartition(n), num_trees=5)).select("grid_id", "prediction").collect()) for n in (4, 7)]
    assert found[0] == found[1]


def test_checkpoint_folder_must_be_shared():
    from types import SimpleNamespace

    from tessera.session import checkpoint_dir
    context = SimpleNamespace(getCheckpointDir=lambda: None, master="yarn")
    session = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: default))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(session)

"""End-to-end job: layers -> per-cell features -> random forest -> scored grid.

``run(spark, base, out)`` loads the nine layers under ``base`` (Parquet, WKB
or struct geometry), profiles them, builds the wide feature table, fits the
forest on the cells with roads, scores every such cell and writes the grid
with a nullable ``prediction`` column to ``out`` (overwrite), geometry as WKB.

Column names of the source layers are parameters (``Columns``); the defaults
are those of the public county layers the job was written for.

Unlike a chain of actions over an uncached plan, the spatial joins run once:
the long feature table is written to the checkpoint directory and every
later step (value discovery, pivot, training, scoring) reads it.
"""

from __future__ import annotations

import argparse
import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import features as ft
from tessera.operators import model as ml
from tessera.operators import spatial_join as sj
from tessera.sources import layers as ly


@dataclass
class Columns:
    grid_id: str = "id"
    speed: str = "SPEED"
    sign_code: str = "MUTCDDESCD"
    object_id: str = "OBJECTID"
    material: str = "MATERIALD"
    median_type: str = "TYPED"
    areas: bool = False  # a line layer holds polygons: measure their perimeters


SIGN_PREVIEW = 10


@dataclass
class Result:
    profile: DataFrame
    features: DataFrame
    audit: DataFrame
    rmse: DataFrame
    scored_grid: DataFrame
    index: sj.CellIndex | None = None
    signs: DataFrame | None = None
    held_out: DataFrame | None = None


def build(spark: SparkSession, lay: dict[str, DataFrame], cols: Columns | None = None,
          num_trees: int = ml.NUM_TREES, seed: int = ml.SEED) -> Result:
    """All steps on already loaded layers; nothing is written."""
    c = cols or Columns()
    idx = sj.index_cells(lay["grid"], c.grid_id, "geom")
    sel = [c.object_id, c.sign_code, "geom"]
    signs_all = lay["sign_panels"].select(*sel).unionByName(lay["sign_mounts"].select(*sel))
    wide = ft.feature_table(idx, lay["roads"], signs_all, lay["guardrails"], lay["medians"],
                            lay["sidewalks"], lay["crashes"], speed_col=c.speed, desc_col=c.sign_code,
                            material_col=c.material, type_col=c.median_type, objectid_col=c.object_id,
                            areas=c.areas)
    fit = ml.fit_forest(wide, num_trees=num_trees, seed=seed)
    scored = ml.scored_grid(lay["grid"], ml.score_all(fit), c.grid_id)
    return Result(ly.profile_layers(lay), wide, ft.label_audit(wide), ml.rmse(fit.test_predictions), scored,
                  idx, signs_all.select(c.object_id, c.sign_code), fit.test_predictions)


def run(spark: SparkSession, base: str, out: str, cols: Columns | None = None,
        files: dict[str, str] | None = None, preview: int = 20) -> Result:
    """Load, build, write the scored grid; print the small reports."""
    lay = ly.load_layers(spark, base, files)
    res = build(spark, lay, cols)
    for name, df in lay.items():
        print(name, df.schema.simpleString())
    res.profile.show(truncate=False)
    res.signs.show(SIGN_PREVIEW, truncate=False)
    res.audit.show(truncate=False)
    res.held_out.select(ml.KEY, ml.LABEL, "prediction").show(preview, truncate=False)
    res.rmse.show(truncate=False)
    ly.write_layer(res.scored_grid, out)
    spark.read.parquet(out).select((cols or Columns()).grid_id, "prediction").show(preview, truncate=False)
    if res.index is not None:
        res.index.release()
    return res


def prediction_nulls(scored: DataFrame) -> DataFrame:
    """One row: cells, cells without a prediction."""
    return scored.agg(F.count(F.lit(1)).alias("cells"),
                      F.sum(F.col("prediction").isNull().cast("long")).alias("no_prediction"))


def main(argv: list[str] | None = None) -> None:
    from tessera.session import build_session

    ap = argparse.ArgumentParser(description="per-cell features, random forest, scored grid")
    ap.add_argument("base", help="directory holding the nine layer Parquet files")
    ap.add_argument("out", help="output Parquet path for the scored grid")
    ap.add_argument("--files", type=json.loads, default={}, help="JSON: layer name to file name")
    ap.add_argument("--columns", type=json.loads, default={}, help="JSON: field of Columns to column name")
    args = ap.parse_args(argv)
    spark = build_session(app="tessera-grid-model")
    run(spark, args.base, args.out, Columns(**args.columns), {**ly.LAYER_FILES, **args.files})


if __name__ == "__main__":
    main()

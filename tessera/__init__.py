"""tessera: per-cell map features on Spark.

Map layers (points, lines, areas) are assigned to the cells of a grid with
tile-keyed equi-joins, measured with native Column expressions, summed per
cell and category, pivoted into one wide feature table, and fed to a Spark ML
random forest whose predictions are written back onto the grid.

Sub-packages:

* ``functions`` - Column expressions: geometry, sign classes, name cleaning.
* ``sources``   - layer loading, profiling, WKB and GeoJSON ingest.
* ``operators`` - tile-cover spatial joins, feature aggregation, model.
* ``plans``     - end-to-end jobs and the registered queries.
"""

from tessera.session import build_session, checkpoint_dir, scratch_path

__all__ = ["build_session", "checkpoint_dir", "scratch_path"]

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from tessera.functions import geometry as G  # noqa: E402
from tessera.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app="tessera-tests", shuffle_partitions=8)
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tessera-test-ckpt-", dir="/tmp"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="tessera-test-", dir="/tmp")


def boxes(spark, rows):
    """Grid of box cells from (id, xmin, ymin, xmax, ymax)."""
    df = spark.createDataFrame(rows, "id long, xmin double, ymin double, xmax double, ymax double")
    return df.withColumn("geom", G.box("xmin", "ymin", "xmax", "ymax"))


def polygons(spark, rows):
    """Cells from (id, [ring, ring, ...]) with rings as lists of (x, y)."""
    data = [(i, [[{"x": float(x), "y": float(y)} for x, y in ring] for ring in rings]) for i, rings in rows]
    df = spark.createDataFrame(data, "id long, rings array<array<struct<x:double,y:double>>>")
    return df.select("id", G.polygon_from(F.col("rings")).alias("geom"))


def lines(spark, rows, extra_schema="", kind="LineString"):
    """Lines from (id, [(x, y), ...], *extra)."""
    data = [(r[0], [{"x": float(x), "y": float(y)} for x, y in r[1]], *r[2:]) for r in rows]
    schema = "id long, pts array<struct<x:double,y:double>>" + (", " + extra_schema if extra_schema else "")
    df = spark.createDataFrame(data, schema)
    return df.withColumn("geom", G.linestring_from(F.col("pts"))).drop("pts")


def points(spark, rows, extra_schema=""):
    """Points from (id, x, y, *extra)."""
    schema = "id long, x double, y double" + (", " + extra_schema if extra_schema else "")
    df = spark.createDataFrame(rows, schema)
    return df.withColumn("geom", G.point("x", "y")).drop("x", "y")

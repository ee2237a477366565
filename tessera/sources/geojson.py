"""GeoJSON FeatureCollections to layers, and geometry <-> GeoJSON text.

Parsing is native: the ``type`` member is read with ``get_json_object`` and
the coordinates with ``from_json`` under the array depth that type needs, so
mixed geometry types in one file parse without going through an inferred
schema (inference would turn mixed-depth coordinates into strings).

Reading a collection: its features are cut out by many tasks, whatever the
files' sizes (:mod:`tessera.sources.feature_splits`), and laid down one a line.
The ``properties`` schema is inferred once from those lines, which are then
read with ``geometry`` declared as a string, so that the raw JSON text of each
geometry is kept. An empty ``features`` array gives no rows; a ``null``
geometry gives a row with a null ``geom``. Line-delimited collections (one a
line, ``multi_line=False``) are exploded line by line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import geometry as G
from tessera.sources.feature_splits import feature_lines

_C1 = T.ArrayType(T.DoubleType())
_C2 = T.ArrayType(_C1)
_C3 = T.ArrayType(_C2)
_C4 = T.ArrayType(_C3)


def _pt(a: Column) -> Column:
    return F.struct(F.get(a, 0).cast("double").alias("x"), F.get(a, 1).cast("double").alias("y"))


def _run(a: Column) -> Column:
    return F.transform(a, _pt)


#: Collections within collections are followed so deep.
NESTED = 4


def parse_geojson(text: Column | str) -> Column:
    """GeoJSON geometry text to the GEOMETRY struct; JSON null or SQL null give null.

    The members of a collection that is a member itself become members of
    the outer one. Unknown geometry types, and collections nested deeper
    than ``NESTED``, raise an error.
    """
    t = F.col(text) if isinstance(text, str) else text

    def is_collection(x: Column) -> Column:
        return F.get_json_object(x, "$.type") == G.COLLECTION

    def members(x: Column) -> Column:
        return F.from_json(F.get_json_object(x, "$.geometries"), T.ArrayType(T.StringType()))

    def typed(texts: Column) -> Column:
        return F.transform(texts, lambda x: F.struct(F.get_json_object(x, "$.type").alias("kind"), x.alias("text")))

    def flat(found: Column) -> Column:
        """One level of collections less; what holds none stays as it is, without another look at its text."""
        inner = F.flatten(F.transform(found, lambda m: F.when(m["kind"] == G.COLLECTION, typed(members(m["text"]))).otherwise(F.array(m))))
        return F.when(F.exists(found, lambda m: F.coalesce(m["kind"] == G.COLLECTION, F.lit(False))), inner).otherwise(found)
    found = typed(members(t))
    for _ in range(NESTED - 1):
        found = _let(found, flat)
    many = F.filter(F.transform(found, lambda m: _parse_kind(m["text"], m["kind"])), lambda m: m.isNotNull())
    return F.when(F.coalesce(is_collection(t), F.lit(False)), _let(many, G.collect_members)).otherwise(_parse_one(t))


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), 0)


def _parse_one(t: Column) -> Column:
    """A geometry that is no collection."""
    return _let(F.get_json_object(t, "$.type"), lambda kind: _parse_kind(t, kind))


def _parse_kind(t: Column, kind: Column) -> Column:
    """A geometry of a known kind that is no collection; its coordinates are read once."""
    coords = F.get_json_object(t, "$.coordinates")
    c1, c2, c3, c4 = (F.from_json(coords, c) for c in (_C1, _C2, _C3, _C4))
    null_rings = F.lit(None).cast("array<int>")
    empty = F.array().cast(T.ArrayType(T.ArrayType(G.POINT)))

    def geom(k: str, parts: Column, rings: Column = null_rings) -> Column:
        return F.struct(F.lit(k).alias("kind"), parts.alias("parts"), rings.alias("poly_rings"))

    point_parts = _let(c1, lambda c: F.when(F.size(c) >= 2, F.array(F.array(_pt(c)))).otherwise(empty))
    return (F.when(t.isNull() | kind.isNull(), F.lit(None).cast(G.GEOMETRY))
            .when(kind == "Point", geom("Point", point_parts))
            .when(kind == "LineString", geom("LineString", F.array(_run(c2))))
            .when(kind == "MultiPoint", geom("MultiPoint", F.transform(c2, lambda p: F.array(_pt(p)))))
            .when(kind == "Polygon", geom("Polygon", F.transform(c3, _run)))
            .when(kind == "MultiLineString", geom("MultiLineString", F.transform(c3, _run)))
            .when(kind == "MultiPolygon",
                  _let(c4, lambda c: geom("MultiPolygon", F.flatten(F.transform(c, lambda poly: F.transform(poly, _run))),
                                          F.transform(c, lambda poly: F.size(poly)))))
            .otherwise(F.raise_error(F.concat(F.lit("unsupported GeoJSON geometry type: "),
                                              F.coalesce(kind, F.lit("?"))))
                       .cast(G.GEOMETRY)))


def _xy_json(p: Column) -> Column:
    return F.array(p["x"], p["y"])


def to_geojson(g: Column | str) -> Column:
    """GEOMETRY struct to GeoJSON geometry text (null for null)."""
    g = F.col(g) if isinstance(g, str) else g
    texts = F.array_join(F.transform(G.collection_members(g), _one_text), ",")
    return F.when(g["kind"] == G.COLLECTION, F.concat(F.lit('{"type":"GeometryCollection","geometries":['), texts, F.lit("]}"))).otherwise(_one_text(g))


def _one_text(g: Column) -> Column:
    """The text of a geometry that is no collection."""
    parts = g["parts"]
    runs = F.transform(parts, lambda r: F.transform(r, _xy_json))

    def doc(kind: str, coords: Column) -> Column:
        return F.to_json(F.struct(F.lit(kind).alias("type"), coords.alias("coordinates")))

    rings = g["poly_rings"]
    starts = F.transform(F.sequence(F.lit(0), F.size(rings) - 1),
                         lambda i: F.aggregate(F.slice(rings, 1, i), F.lit(0), lambda a, b: a + b))
    polys = F.zip_with(starts, rings, lambda s, n: F.slice(runs, s + 1, n))
    return (F.when(g.isNull(), F.lit(None).cast("string"))
            .when(g["kind"] == "Point", doc("Point", F.when(F.size(parts) > 0, _xy_json(F.get(F.get(parts, 0), 0)))
                                            .otherwise(F.array().cast("array<double>"))))
            .when(g["kind"] == "LineString", doc("LineString", F.get(runs, 0)))
            .when(g["kind"] == "MultiPoint", doc("MultiPoint", F.transform(runs, lambda r: F.get(r, 0))))
            .when(g["kind"] == "Polygon", doc("Polygon", runs))
            .when(g["kind"] == "MultiLineString", doc("MultiLineString", runs))
            .when(g["kind"] == "MultiPolygon", doc("MultiPolygon", polys))
            .otherwise(F.raise_error(F.concat(F.lit("cannot write geometry kind "), g["kind"])).cast("string")))


def _struct_of(schema: T.StructType, name: str) -> T.StructType:
    found = schema[name].dataType if name in schema.fieldNames() else None
    return found if isinstance(found, T.StructType) else T.StructType([])


def _properties(raw: DataFrame) -> T.StructType:
    """Inferred type of ``features[].properties`` of line-delimited collections (empty struct if there is none)."""
    ft = raw.schema["features"].dataType if "features" in raw.columns else None
    if not isinstance(ft, T.ArrayType) or not isinstance(ft.elementType, T.StructType):
        return T.StructType([])
    return _struct_of(ft.elementType, "properties")


def properties_schema(spark: SparkSession, path: str, multi_line: bool = True) -> T.StructType:
    """Inferred type of ``features[].properties`` (empty struct if there is none)."""
    if multi_line:
        return _struct_of(spark.read.json(feature_lines(spark, path)).schema, "properties")
    return _properties(spark.read.json(path))  # bad files fail in the read itself, by name


def read_feature_collections(spark: SparkSession, path: str, multi_line: bool = True,
                             properties: T.StructType | None = None) -> DataFrame:
    """One row per feature: every property as a column, plus ``geom``.

    A file that is no valid JSON, or has no ``features``, fails the read and
    is named; an empty list of features gives no rows.
    """
    def feature(props: T.StructType) -> T.StructType:
        return T.StructType([T.StructField("type", T.StringType()), T.StructField("properties", props), T.StructField("geometry", T.StringType())])
    if multi_line:
        lines = feature_lines(spark, path)
        props = properties if properties is not None else _struct_of(spark.read.json(lines).schema, "properties")
        feats = spark.read.schema(feature(props)).option("mode", "FAILFAST").json(lines)
        prop_cols = [F.col("properties").getField(n).alias(n) for n in props.fieldNames()]
        return feats.select(*prop_cols, parse_geojson(F.col("geometry")).alias("geom"))
    props = properties if properties is not None else properties_schema(spark, path, False)
    schema = T.StructType([T.StructField("type", T.StringType()), T.StructField("features", T.ArrayType(feature(props)))])
    raw = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    missing = F.raise_error(F.concat(F.input_file_name(), F.lit(": not a feature collection"))).cast(schema["features"].dataType)
    feats = raw.select(F.explode(F.coalesce("features", missing)).alias("f"))
    prop_cols = [F.col("f.properties").getField(n).alias(n) for n in props.fieldNames()]
    return feats.select(*prop_cols, parse_geojson(F.col("f.geometry")).alias("geom"))


def write_feature_collections(df: DataFrame, path: str, features_per_file: int = 50_000,
                              geom_col: str = "geom") -> None:
    """Write a layer as multi-line GeoJSON FeatureCollection files of bounded size.

    Rows are dealt round-robin into ``ceil(rows / features_per_file)``
    buckets, one file each, so no file (and no task) holds more than about
    ``features_per_file`` features whatever the data looks like.
    """
    n = max(1, -(-df.count() // features_per_file))
    props = [c for c in df.columns if c != geom_col]
    feat = F.to_json(F.struct(F.lit("Feature").alias("type"),
                              F.struct(*[F.col(c) for c in props]).alias("properties"),
                              F.lit("__GEOM__").alias("geometry")))
    feat = F.replace(feat, F.lit('"__GEOM__"'), F.coalesce(to_geojson(geom_col), F.lit("null")))
    rows = df.select(F.pmod(F.monotonically_increasing_id(), F.lit(n)).alias("bucket"),
                     feat.alias("feature"))
    docs = (rows.groupBy("bucket")
                .agg(F.concat(F.lit('{"type": "FeatureCollection",\n "features": [\n'),
                              F.array_join(F.collect_list("feature"), ",\n"),
                              F.lit("\n]}")).alias("value")))
    (docs.repartition(n, "bucket").write.mode("overwrite").partitionBy("bucket").text(path))


def convert(spark: SparkSession, in_path: str, out_path: str, multi_line: bool = True) -> DataFrame:
    """GeoJSON collections to a Parquet layer (geometry as WKB); returns the written layer."""
    from tessera.sources.layers import read_layer, write_layer
    write_layer(read_feature_collections(spark, in_path, multi_line), out_path)
    return read_layer(spark, out_path)

"""WKB, GeoJSON and Parquet layer sources."""

import json
import os
import struct

import numpy as np
import pyarrow as pa
import pytest
from conftest import lines
from pyspark.sql import functions as F

from tessera.functions import geometry as G
from tessera.sources import geojson, layers, wkb


def _pt(x, y):
    return {"x": float(x), "y": float(y)}


SAMPLES = [
    {"kind": "Point", "parts": [[_pt(1, 2)]], "poly_rings": None},
    {"kind": "LineString", "parts": [[_pt(0, 0), _pt(1, 1), _pt(2, 0)]], "poly_rings": None},
    {"kind": "Polygon", "parts": [[_pt(0, 0), _pt(4, 0), _pt(4, 4), _pt(0, 0)],
                                  [_pt(1, 1), _pt(2, 1), _pt(1, 2), _pt(1, 1)]], "poly_rings": None},
    {"kind": "MultiPoint", "parts": [[_pt(1, 1)], [_pt(3, 4)]], "poly_rings": None},
    {"kind": "MultiLineString", "parts": [[_pt(0, 0), _pt(1, 0)], [_pt(5, 5), _pt(6, 7)]], "poly_rings": None},
    {"kind": "MultiPolygon", "parts": [[_pt(0, 0), _pt(1, 0), _pt(0, 1), _pt(0, 0)],
                                       [_pt(5, 5), _pt(6, 5), _pt(5, 6), _pt(5, 5)],
                                       [_pt(9, 9), _pt(8, 9), _pt(9, 8), _pt(9, 9)]],
     "poly_rings": [2, 1]},
]


GEOMETRY = pa.struct([("kind", pa.string()), ("parts", pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))),
                      ("poly_rings", pa.list_(pa.int32()))])


def _encode(g, le=True):
    return wkb.encode_arrow(pa.array([g], GEOMETRY), np.array([le]))[0].as_py()


def _decode(b):
    return wkb.decode_arrow(pa.array([b], pa.binary()))[0].as_py()


@pytest.mark.parametrize("le", [True, False])
@pytest.mark.parametrize("g", SAMPLES, ids=[s["kind"] for s in SAMPLES])
def test_wkb_codec_round_trip(g, le):
    b = _encode(g, le)
    assert b[0] == (1 if le else 0)
    assert _decode(b) == g


def test_wkb_extended_headers():
    # EWKB point with SRID and Z, big endian
    b = struct.pack(">BII", 0, 0x80000001 | 0x20000000, 4326) + struct.pack(">ddd", 1.5, 2.5, 9.0)
    assert _decode(b) == {"kind": "Point", "parts": [[_pt(1.5, 2.5)]], "poly_rings": None}
    # ISO LineString ZM (3002), little endian
    b = struct.pack("<BII", 1, 3002, 2) + struct.pack("<8d", 0, 0, 1, 2, 3, 4, 5, 6)
    assert _decode(b)["parts"] == [[_pt(0, 0), _pt(3, 4)]]


def test_wkb_rejects_unknown_and_truncated():
    with pytest.raises(wkb.WKBError):
        _decode(struct.pack("<BII", 1, 8, 0))  # a curve
    with pytest.raises(wkb.WKBError):
        _decode(struct.pack("<BII", 1, 2, 3) + b"\x00" * 10)
    assert _decode(None) is None


def _random_geometry(rng):
    run = lambda: [_pt(*rng.normal(size=2).tolist()) for _ in range(rng.integers(0, 6))]
    kind = str(rng.choice(["Point", "LineString", "Polygon", "MultiPoint", "MultiLineString", "MultiPolygon"]))
    rings = [int(rng.integers(0, 4)) for _ in range(rng.integers(0, 5))] if kind == "MultiPolygon" else None
    parts = {"Point": lambda: [[_pt(1.5, -2)]] if rng.random() < 0.8 else [], "LineString": lambda: [run()],
             "MultiPoint": lambda: [[_pt(k, 0.5)] for k in range(rng.integers(0, 5))],
             "MultiPolygon": lambda: [run() for _ in range(sum(rings))]}.get(kind, lambda: [run() for _ in range(rng.integers(0, 5))])()
    return {"kind": kind, "parts": parts, "poly_rings": rings or ([] if kind == "MultiPolygon" else None)}


def test_wkb_batches_of_mixed_values():
    """Values of any kind, byte order and length side by side, in a slice of a batch with nulls."""
    rng = np.random.default_rng(11)
    values = [None if k % 17 == 0 else _random_geometry(rng) for k in range(600)]
    values = [v if v is None or v["poly_rings"] != [] else {**v, "poly_rings": [1], "parts": [[_pt(0, 0)]]} for v in values]
    coded = wkb.encode_arrow(pa.array(values, GEOMETRY), rng.random(600) < 0.5)
    assert wkb.decode_arrow(coded).to_pylist() == values
    assert wkb.decode_arrow(coded.slice(100, 333)).to_pylist() == values[100:433]
    assert wkb.decode_arrow(pa.array([], pa.binary())).to_pylist() == []
    assert wkb.decode_arrow(pa.array([None, None], pa.binary())).to_pylist() == [None, None]


def test_wkb_members_of_another_byte_order_and_ordinates():
    line = struct.pack(">BII", 0, 1002, 1) + struct.pack(">3d", 1, 2, 3) + struct.pack("<BII", 1, 2, 2) + struct.pack("<4d", 4, 5, 6, 7)
    assert _decode(struct.pack("<BII", 1, 5, 2) + line)["parts"] == [[_pt(1, 2)], [_pt(4, 5), _pt(6, 7)]]
    empty = struct.pack("<BI", 1, 3001) + struct.pack("<4d", *[float("nan")] * 4)
    assert _decode(struct.pack("<BII", 1, 4, 2) + empty + struct.pack("<BIdd", 1, 1, 8, 9))["parts"] == [[_pt(8, 9)]]
    with pytest.raises(wkb.WKBError, match="truncated"):
        _decode(struct.pack("<BII", 1, 4, 4_000_000_000))
    with pytest.raises(wkb.WKBError, match="member of type 2 where 1"):
        _decode(struct.pack("<BII", 1, 4, 1) + struct.pack("<BII", 1, 2, 0))
    with pytest.raises(wkb.WKBError, match="byte-order"):
        _decode(b"\x07\x01\x00\x00\x00")


def test_wkb_columns_round_trip_with_nulls(spark):
    df = spark.createDataFrame([(i, g) for i, g in enumerate(SAMPLES)] + [(99, None)],
                               "id long, geom struct<kind:string,parts:array<array<struct<x:double,y:double>>>,"
                               "poly_rings:array<int>>")
    back = df.select("id", "geom", wkb.from_wkb(wkb.to_wkb("geom", F.col("id") % 2 == 0)).alias("g2"))
    rows = back.collect()
    assert all(r["geom"] == r["g2"] for r in rows)
    assert [r["g2"] for r in rows if r["id"] == 99] == [None]


def _write_collection(path, features):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        json.dump({"type": "FeatureCollection", "features": features}, f, indent=2)


def test_geojson_mixed_types_null_geometry_and_properties(spark, tmp_dir):
    feats = [
        {"type": "Feature", "properties": {"OBJECTID": 1, "NAME": "a"},
         "geometry": {"type": "LineString", "coordinates": [[0, 0], [3, 4]]}},
        {"type": "Feature", "properties": {"OBJECTID": 2, "NAME": "b"},
         "geometry": {"type": "MultiLineString", "coordinates": [[[0, 0], [1, 0]], [[2, 2], [2, 5]]]}},
        {"type": "Feature", "properties": {"OBJECTID": 3, "NAME": None}, "geometry": None},
        {"type": "Feature", "properties": {"OBJECTID": 4, "NAME": "d"},
         "geometry": {"type": "Point", "coordinates": [7.5, 8.5]}},
    ]
    path = os.path.join(tmp_dir, "in", "layer.geojson")
    _write_collection(path, feats)
    df = geojson.read_feature_collections(spark, path)
    assert set(df.columns) == {"OBJECTID", "NAME", "geom"}
    rows = {r["OBJECTID"]: r for r in df.select("OBJECTID", "NAME", "geom", G.length("geom").alias("len")).collect()}
    assert rows[1]["geom"]["kind"] == "LineString" and rows[1]["len"] == pytest.approx(5.0)
    assert rows[2]["geom"]["kind"] == "MultiLineString" and rows[2]["len"] == pytest.approx(4.0)
    assert rows[3]["geom"] is None and rows[3]["NAME"] is None
    assert rows[4]["geom"]["parts"][0][0]["x"] == 7.5


def test_geojson_empty_collection_gives_no_rows(spark, tmp_dir):
    path = os.path.join(tmp_dir, "empty", "layer.geojson")
    _write_collection(path, [])
    assert geojson.read_feature_collections(spark, path).count() == 0


def test_geojson_text_round_trip(spark):
    df = spark.createDataFrame([(i, g) for i, g in enumerate(SAMPLES)],
                               "id long, geom struct<kind:string,parts:array<array<struct<x:double,y:double>>>,"
                               "poly_rings:array<int>>")
    back = df.select("geom", geojson.parse_geojson(geojson.to_geojson("geom")).alias("g2")).collect()
    for r in back:
        assert r["g2"] == r["geom"]


def test_convert_writes_wkb_layer(spark, tmp_dir):
    src = lines(spark, [(1, [(0, 0), (1, 1)], "A"), (2, [(2, 2), (3, 5)], None)], "MATERIALD string")
    gj = os.path.join(tmp_dir, "gj")
    geojson.write_feature_collections(src, gj, features_per_file=1)
    out = geojson.convert(spark, gj, os.path.join(tmp_dir, "layer.parquet"))
    raw = spark.read.parquet(os.path.join(tmp_dir, "layer.parquet"))
    assert "geometry" in raw.columns and dict(raw.dtypes)["geometry"] == "binary"
    got = sorted((r["id"], r["MATERIALD"], r["geom"]["parts"][0][1]["y"]) for r in out.collect())
    assert got == [(1, "A", 1.0), (2, None, 5.0)]


def test_layer_without_geometry_names_the_path(spark, tmp_dir):
    p = os.path.join(tmp_dir, "nogeom.parquet")
    spark.createDataFrame([(1,)], "id long").write.parquet(p)
    with pytest.raises(layers.MissingGeometryError, match="nogeom.parquet"):
        layers.read_layer(spark, p)


def test_layer_with_both_columns_keeps_geom(spark, tmp_dir):
    p = os.path.join(tmp_dir, "both.parquet")
    df = lines(spark, [(1, [(0, 0), (1, 0)])])
    df.withColumn("geometry", wkb.to_wkb(G.linestring((5, 5), (6, 6)))).write.parquet(p)
    got = layers.read_layer(spark, p).first()
    assert got["geom"]["parts"][0][1]["x"] == 1.0


def test_write_and_load_layers_and_profile(spark, tmp_dir):
    df = lines(spark, [(1, [(0, 0), (1, 2)]), (2, [(-3, 0), (1, 9)])])
    layers.write_layer(df, os.path.join(tmp_dir, "Roads.parquet"))
    loaded = layers.load_layers(spark, tmp_dir, {"roads": "Roads.parquet"})
    prof = layers.profile_layers(loaded).first()
    assert (prof["layer"], prof["rows"], prof["null_geom"]) == ("roads", 2, 0)
    assert (prof["xmin"], prof["ymin"], prof["xmax"], prof["ymax"]) == (-3.0, 0.0, 1.0, 9.0)


@pytest.mark.parametrize("text", ['{"type": "FeatureCollection", "features": [{"type": ', '{"type": "Feature", "properties": {}, "geometry": null}',
                                  '{"type": "FeatureCollection"}', '{"type": "FeatureCollection", "features": null}'])
def test_bad_geojson_fails_and_leaves_the_target(spark, tmp_dir, text):
    os.makedirs(f"{tmp_dir}/in")
    with open(f"{tmp_dir}/in/bad.geojson", "w") as f:
        f.write(text)
    with pytest.raises(Exception, match="bad.geojson"):
        geojson.convert(spark, f"{tmp_dir}/in", f"{tmp_dir}/out.parquet")
    assert not [f for f in (os.listdir(f"{tmp_dir}/out.parquet") if os.path.isdir(f"{tmp_dir}/out.parquet") else []) if f.endswith(".parquet")]


def test_geojson_without_features_has_no_rows(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/in")
    with open(f"{tmp_dir}/in/none.geojson", "w") as f:
        f.write('{"type": "FeatureCollection", "features": []}')
    assert geojson.read_feature_collections(spark, f"{tmp_dir}/in").count() == 0


def _awkward_collection():
    """Strings with braces, quotes and backslashes, nested properties, other objects and arrays before and after the features."""
    feats = []
    for k in range(60):
        note = ["}", "{", "]}", '"', "\\", 'a "quoted" {brace}', "\\\"}", "é}ü", "[[", ""][k % 10] * (1 + k % 3)
        geometry = [{"type": "Point", "coordinates": [k, -k]}, None, {"type": "LineString", "coordinates": [[k, 0], [k, 5], [0.5, 1e2]]},
                    {"type": "Polygon", "coordinates": [[[0, 0], [k + 1, 0], [0, 1], [0, 0]]]}][k % 4]
        feats.append({"type": "Feature", "properties": {"k": k, "note": note, "deep": {"features": [{"a": k}], "b": [1, {"c": "}"}]}},
                      "geometry": geometry})
    return {"type": "FeatureCollection", "crs": {"type": "name", "properties": {"name": "x}", "features": [{"k": -1}]}},
            "more": [{"k": -2, "properties": {"k": -3}}, [[{"k": -4}]]], "features": feats, "after": [{"k": -5}], "end": {"x": {"k": -6}}}


@pytest.mark.parametrize("split,indent", [("37b", None), ("300b", 1), ("1g", 2)])
def test_a_collection_read_in_splits(spark, tmp_dir, split, indent):
    import json
    doc = _awkward_collection()
    os.makedirs(f"{tmp_dir}/in")
    for name, text in (("a", json.dumps(doc, indent=indent)), ("b", json.dumps(doc, indent=indent, ensure_ascii=False) + "\n\n"),
                       ("c", json.dumps({"features": [], "type": "FeatureCollection"}))):
        with open(f"{tmp_dir}/in/{name}.geojson", "w", encoding="utf-8") as f:
            f.write(text)
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = [spark.conf.get(k) for k in keys]
    try:
        spark.conf.set(keys[0], split)
        spark.conf.set(keys[1], "0")
        from tessera.sources import feature_splits
        tasks = feature_splits._records(spark, f"{tmp_dir}/in").rdd.getNumPartitions()
        assert tasks > 100 if split == "37b" else tasks >= 1
        rows = geojson.read_feature_collections(spark, f"{tmp_dir}/in").collect()
    finally:
        for k, v in zip(keys, old):
            spark.conf.set(k, v)
    want = sorted((f["properties"]["k"], f["properties"]["note"], f["geometry"] and f["geometry"]["type"]) for f in doc["features"] for _ in "ab")
    assert sorted((r["k"], r["note"], r["geom"] and r["geom"]["kind"]) for r in rows) == want
    assert json.loads({r["k"]: r["deep"]["b"][1] for r in rows}[7]) == {"c": "}"}


def test_line_delimited_collections(spark, tmp_dir):
    import json
    with open(f"{tmp_dir}/lines.json", "w") as f:
        for k in range(3):
            f.write(json.dumps({"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"k": k}, "geometry": None}]}) + "\n")
    assert sorted(r["k"] for r in geojson.read_feature_collections(spark, f"{tmp_dir}/lines.json", multi_line=False).collect()) == [0, 1, 2]


@pytest.mark.parametrize("text", ['{"type": "FeatureCollection", "features": [{"type": "Feature"}]', '{"features": [{"a": "}]}', "[]"])
def test_a_file_that_ends_early_is_named(spark, tmp_dir, text):
    with open(f"{tmp_dir}/short.geojson", "w") as f:
        f.write(text)
    with pytest.raises(Exception, match="short.geojson"):
        geojson.read_feature_collections(spark, f"{tmp_dir}/short.geojson").count()


def test_a_layer_written_for_pruning_reads_fewer_rows(spark, tmp_dir):
    rows = spark.range(20_000).select("id", F.lit("kept").alias("note"),
                                      G.linestring((F.col("id") * 7919 % 1000, F.col("id") * 104729 % 997),
                                                   (F.col("id") * 7919 % 1000 + 3, F.col("id") * 104729 % 997 + 2)).alias("geom"))
    rows = rows.withColumn("geom", F.when(F.col("id") > 0, F.col("geom")))  # one null geometry
    path, box = f"{tmp_dir}/layer.parquet", (100, 200, 180, 260)
    layers.write_layer(rows, path, pruned=True, row_group_bytes=16 << 10)
    assert layers.read_layer(spark, path).columns == ["id", "note", "geometry", "geom"]
    assert layers.read_layer(spark, path).count() == 20_000
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    try:
        found = layers.read_layer(spark, path, box).select("id")
        got = {r["id"] for r in found.collect()}
        run = found._jdf.queryExecution()
        run.toRdd().count()
        read = run.executedPlan().collectLeaves().apply(0).metrics().apply("numOutputRows").value()
        text = run.executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "LessThanOrEqual(bbox.xmin" in text and "GreaterThanOrEqual(bbox.ymax" in text
    x, y = (lambda k: k * 7919 % 1000), (lambda k: k * 104729 % 997)
    assert got == {k for k in range(1, 20_000) if x(k) <= 180 and x(k) + 3 >= 100 and y(k) <= 260 and y(k) + 2 >= 200}
    assert len(got) <= read < 6_000
    # a layer without boxes is compared row by row
    layers.write_layer(rows, f"{tmp_dir}/plain.parquet")
    assert {r["id"] for r in layers.read_layer(spark, f"{tmp_dir}/plain.parquet", box).collect()} == got


def test_the_pass_that_writes_a_layer_profiles_it(spark, tmp_dir):
    rows = spark.createDataFrame([(1, 0.0, 5.0), (2, -3.0, 9.0)], "id long, x double, y double").select("id", G.point("x", "y").alias("geom"))
    rows = rows.unionByName(spark.range(1).select("id", F.lit(None).cast(G.GEOMETRY).alias("geom")))
    for pruned in (False, True):
        got = layers.write_layer(rows, f"{tmp_dir}/p{pruned}", pruned=pruned, name="spots")
        assert got == {"layer": "spots", "rows": 3, "null_geom": 1, "xmin": -3.0, "ymin": 5.0, "xmax": 0.0, "ymax": 9.0}
    empty = layers.write_layer(rows.where("id > 9"), f"{tmp_dir}/empty", name="none")
    assert (empty["rows"], empty["null_geom"], empty["xmin"]) == (0, 0, None)
    found = layers.profile_rows(spark, [got, empty])
    assert found.schema == layers.profile_layers({"spots": rows}).schema or found.columns == layers.profile_layers({"spots": rows}).columns
    assert [tuple(r) for r in found.collect()] == [tuple(got.values()), tuple(empty[c] for c in found.columns)]
    assert layers.write_layer(rows, f"{tmp_dir}/plain") is None


def _simple_wkb(kind, rng):
    return {"kind": kind, "parts": {"Point": [[_pt(1, 2)]], "LineString": [[_pt(0, 0), _pt(3, 4)]], "Polygon": [[_pt(0, 0), _pt(4, 0), _pt(0, 3), _pt(0, 0)]],
            "MultiPoint": [[_pt(5, 5)], [_pt(6, 6)]], "MultiLineString": [[_pt(0, 0), _pt(1, 0)], [_pt(2, 0), _pt(2, 2)]],
            "MultiPolygon": [[_pt(0, 0), _pt(1, 0), _pt(0, 1), _pt(0, 0)], [_pt(0.1, 0.1), _pt(0.2, 0.1), _pt(0.1, 0.2), _pt(0.1, 0.1)],
                             [_pt(9, 9), _pt(8, 9), _pt(9, 8), _pt(9, 9)]]}[kind], "poly_rings": [2, 1] if kind == "MultiPolygon" else None}


def test_collections_through_both_codecs(spark):
    """Members of every kind, equal kinds side by side, a collection in a collection, an empty one; other rows stay as they are."""
    kinds = ["Point", "LineString", "Polygon", "MultiPoint", "MultiLineString", "MultiPolygon"]
    rng = np.random.default_rng(2)
    rows = [(k, [_simple_wkb(str(x), rng) for x in rng.choice(kinds, rng.integers(0, 6))]) for k in range(60)]
    kind = "array<struct<kind:string,parts:array<array<struct<x:double,y:double>>>,poly_rings:array<int>>>"
    df = spark.createDataFrame(rows, f"id long, members {kind}")
    df = df.select("id", "members", F.when(F.col("id") % 7 != 6, G.collect_members("members")).otherwise(F.get("members", F.lit(0))).alias("geom"))
    want = {r["id"]: r["members"] if r["id"] % 7 != 6 else r["members"][:1] for r in df.collect()}
    for codec in (lambda g: wkb.from_wkb(wkb.to_wkb(g, F.col("id") % 2 == 0)), lambda g: geojson.parse_geojson(geojson.to_geojson(g))):
        back = df.select("id", codec(F.col("geom")).alias("g")).select("id", "g", G.collection_members("g").alias("m")).collect()
        assert {r["id"]: r["m"] or [] for r in back} == want
        assert {r["g"]["kind"] for r in back if r["id"] % 7 != 6} == {"GeometryCollection"}


def test_nested_collections_become_flat(spark):
    point, line = struct.pack("<BIdd", 1, 1, 1, 2), struct.pack(">BII4d", 0, 2, 2, 0, 0, 3, 4)
    inner = struct.pack(">BII", 0, 7, 2) + line + struct.pack("<BII", 1, 7, 1) + point
    got = _decode(struct.pack("<BII", 1, 7, 3) + point + inner + line)
    assert got["kind"] == "GeometryCollection" and got["parts"] == [[_pt(1, 2)], [_pt(0, 0), _pt(3, 4)], [_pt(1, 2)], [_pt(0, 0), _pt(3, 4)]]
    assert got["poly_rings"] == [0, 1, 0, 1, 2, 0, 2, 1, 0, 3, 2, 0]
    text = json.dumps({"type": "GeometryCollection", "geometries": [
        {"type": "Point", "coordinates": [1, 2]},
        {"type": "GeometryCollection", "geometries": [{"type": "LineString", "coordinates": [[0, 0], [3, 4]]},
                                                      {"type": "GeometryCollection", "geometries": [{"type": "Point", "coordinates": [1, 2]}]}]},
        {"type": "LineString", "coordinates": [[0, 0], [3, 4]]}]})
    rows = spark.createDataFrame([(text,), ('{"type":"GeometryCollection","geometries":[]}',)], "t string").select(geojson.parse_geojson("t").alias("g")).collect()
    assert rows[0]["g"].asDict(True) == got and rows[1]["g"]["parts"] == []
    with pytest.raises(wkb.WKBError, match="nested deeper"):
        _decode(struct.pack("<BII", 1, 7, 1) * 70 + point)


def test_collections_in_line_layers(spark):
    from tessera.operators import spatial_join as sj
    line, area = _simple_wkb("LineString", None), _simple_wkb("Polygon", None)
    kind = "array<struct<kind:string,parts:array<array<struct<x:double,y:double>>>,poly_rings:array<int>>>"
    df = spark.createDataFrame([(1, [_simple_wkb("Point", None), line, line, _simple_wkb("MultiLineString", None)]), (2, [line, area])], f"id long, members {kind}")
    df = df.select("id", G.collect_members("members").alias("geom"))
    grid = spark.range(1).select("id", G.box(F.lit(-10.0), F.lit(-10.0), F.lit(10.0), F.lit(10.0)).alias("geom"))
    idx = sj.index_cells(grid)
    got = sj.pair_lengths(sj.clip_lines_to_cells(idx, df.where("id = 1"), "geom", ["id"]), ["id"]).collect()
    assert [(r["id"], r["seg_len"]) for r in got] == [(1, pytest.approx(5 + 1 + 2))]  # the line twice counts once
    for areas in (False, True):
        with pytest.raises(Exception, match="holds areas"):
            sj.clip_lines_to_cells(idx, df, "geom", ["id"], areas=areas).count()


def test_simple_kinds_are_written_side_by_side(monkeypatch):
    rng = np.random.default_rng(12)
    values = [g for g in (_random_geometry(rng) for _ in range(400)) if g["kind"] in ("LineString", "Polygon") or g["kind"] == "Point" and g["parts"]]
    order = rng.random(len(values)) < 0.5
    alone = [_encode(g, bool(le)) for g, le in zip(values, order)]
    monkeypatch.setattr(wkb, "_bytes_of", None)  # what packs a geometry at a time
    coded = wkb.encode_arrow(pa.array(values, GEOMETRY), order)
    assert coded.to_pylist() == alone and wkb.decode_arrow(coded).to_pylist() == values


def test_no_null_list_goes_to_the_wkb_writer(spark):
    df = spark.createDataFrame([(1, {"kind": "Point", "parts": [[_pt(1.0, 2.0)]], "poly_rings": None}), (2, None), (3, {"kind": "LineString", "parts": None, "poly_rings": None}),
                                (4, {"kind": "Polygon", "parts": [None, [_pt(0.0, 1.0)]], "poly_rings": None})],
                               "id long, geom struct<kind:string,parts:array<array<struct<x:double,y:double>>>,poly_rings:array<int>>")
    got = {r["id"]: r["g"] for r in df.select("id", wkb.from_wkb(wkb.to_wkb("geom")).alias("g")).collect()}
    assert got[1]["parts"] == [[(1.0, 2.0)]] and got[2] is None and got[3] is None and got[4]["parts"] == [[], [(0.0, 1.0)]]
    plan = df.select(wkb.to_wkb("geom").alias("w"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("coalesce") >= 5  # sizes, x, y, rings and the parts themselves


def test_a_member_of_a_collection_is_looked_at_few_times(spark):
    # what is parsed in a lambda is not shared by the engine: each look at the text costs a pass over it
    plan = spark.createDataFrame([("{}",)], "gj string").select(geojson.parse_geojson("gj").alias("g"))._jdf.queryExecution().optimizedPlan()
    assert plan.toJSON().count("catalyst.expressions.GetJsonObject") <= 150

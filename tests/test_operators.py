from collections import Counter

import numpy as np
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from curata.functions import boxes, hashing, labels, strings
from curata.functions import geometry as geo
from curata.operators import evaluation as ev
from curata.operators import manifests as mf
from curata.operators import masks, models, regions
from curata.operators import relational as rel
from curata.operators import splitting as sp
from curata.operators import validation as va
from curata.operators.graph import connected_components
from curata.sources import readers, writers
from curata.streaming import intake


def test_components_of_a_chain_a_star_and_nothing(spark):
    edges = [(k, k + 1) for k in range(1, 40)] + [(100, k) for k in range(101, 130)] + [(200, 200), (None, 3)]
    found = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert found == {**{k: 1 for k in range(1, 41)}, **{k: 100 for k in range(100, 130)}}
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_hamming_pairs_match_a_nested_loop(spark):
    import random

    rng = random.Random(3)
    values = [rng.getrandbits(64) - (1 << 63) for _ in range(40)]
    values += [v ^ (1 << rng.randrange(63)) ^ (1 << rng.randrange(63)) for v in values]
    df = spark.createDataFrame(list(enumerate(values)), "k long, v long")
    found = {(r.a, r.b, r.distance) for r in rel.hamming_pairs(df, "k", "v", 4).collect()}
    mask = (1 << 64) - 1
    wanted = {(a, b, d) for a in range(80) for b in range(a + 1, 80) if (d := ((values[a] ^ values[b]) & mask).bit_count()) <= 4}
    assert found == wanted and wanted


def shape(*xy):
    return [Row(x=float(x), y=float(y)) for x, y in xy]


def test_label_lines(spark):
    whole = "non_simple_polygon"
    cases = {
        "2 0.25 0.2 0.75 0.2 0.5 0.8": [],
        "3 .2 .2 .4 .4": ["bbox_format_in_segmentation_label"],
        "0 0.2 0.2 0.8 0.2": ["bbox_format_in_segmentation_label"],
        "0 0.2 0.2 0.8": ["fewer_than_three_points", "incomplete_coordinate_pair", "insufficient_unique_vertices"],
        "5 0 0 0.5 0 0.5 0.5 0.25": ["incomplete_coordinate_pair"],
        "0 0.2 0.2 0.7 0.3 0.30.4 0.6 0.5 0.9": ["concatenated_numeric_token"],
        "0 0.2 0.2 left 0.3 0.7 0.3 0.5 0.9": ["non_numeric_token"],
        "0 0.2 0.2 0.7 0.3 0.5 -0.9": ["coordinate_out_of_range"],
        "0 0.2 0.2 0.7 0.3 0.5 1_0": ["coordinate_out_of_range"],
        "0 0.2 0.2 0.7 0.3 0.5 1d": ["non_numeric_token", "insufficient_unique_vertices"],
        "leaf 0.25 0.2 0.75 0.2 0.5 0.8": ["invalid_class_id"],
        "1 0.2 0.2 0.8 0.8 0.8 0.2 0.2 0.7": ["self_intersection", whole],
        "1 0.2 0.2 0.8 0.2 0.8 0.8 0.2 0.8 0.8 0.2": ["repeated_vertex", whole],
        "1 0.2 0.2 0.8 0.2 0.8 0.2 0.2 0.8": ["repeated_vertex", "zero_length_edge", whole],
        "1 0.3 0.3 0.3 0.3 0.3 0.3": ["repeated_vertex", "zero_length_edge", "insufficient_unique_vertices", "zero_or_near_zero_area", whole],
        "1 0.2 0.2 0.4 0.4 0.6 0.6": ["zero_or_near_zero_area", whole],
        " \t ": ["empty_line"],
        None: ["empty_line"],
    }
    df = spark.createDataFrame([(k,) for k in cases], "line string")
    out = {r.line: r.p for r in df.select("line", labels.parse_polygon_line(F.col("line")).alias("p")).collect()}
    assert {k: [i.issue for i in v.issues] for k, v in out.items()} == cases
    assert all(v.valid == (not cases[k]) for k, v in out.items())
    assert len(out["2 0.25 0.2 0.75 0.2 0.5 0.8"].points) == 3 and out["3 .2 .2 .4 .4"].points == []
    one = out["0 0.2 0.2 0.7 0.3 0.30.4 0.6 0.5 0.9"].issues[0]
    assert (one.field, one.token) == (6, "0.30.4")
    not_finite = spark.createDataFrame([("0 0.2 nan 0.7 0.3 0.5 -inf 1e999 0.5",)], "line string").select(labels.parse_polygon_line(F.col("line")).alias("p")).first().p
    assert [i.field for i in not_finite.issues if i.issue == "non_finite_coordinate"] == [3, 7, 8]


def test_lines_of_boxes(spark):
    cases = {
        "0 0.5 0.5 0.2 0.2": ("bbox", None),
        "0 0.05 0.5 0.2 0.2": ("bbox", "crosses_border"),
        "0 0.5 1.5 0 0.2": ("invalid", "center_y;width"),
        "-1 0.5 0.5 0.2 0.2": ("invalid", "class_negative"),
        "a 0.5 0.5 0.2 0.2": ("invalid", "class_not_integer"),
        "0 0.5 x 0.2 0.2": ("invalid", "not_numeric"),
        "0 0.5 nan 0.2 0.2": ("invalid", "not_finite"),
        "0 0.5": ("invalid", "fields=2"),
        "4 0 0 1 0 1 1": ("polygon", "polygon"),
        "4 0 0 2 0 1 1": ("polygon", "polygon_out_of_range"),
        "": ("invalid", "fields=0"),
    }
    df = spark.createDataFrame([(k,) for k in cases], "line string").withColumn("a", labels.classify_line(F.col("line")))
    assert {r.line: (r.a.kind, r.a.message) for r in df.collect()} == cases
    row = spark.range(1).select(labels.remap_class(F.lit("7 0.25 0.2 0.75 0.2 0.5 0.8")).alias("a"), labels.remap_class(F.lit("7 0.2")).alias("b"), labels.finite(F.lit("inf")).alias("c"), labels.ratio(F.lit(" 0.5 ")).alias("d")).first()
    assert tuple(row) == ("0 0.25 0.2 0.75 0.2 0.5 0.8", None, None, 0.5)


def test_polygons(spark):
    rows = [("square", shape((0, 0), (1, 0), (1, 1), (0, 1))), ("flat", shape((0.1, 0.1), (0.5, 0.5), (0.9, 0.9))), ("bow", shape((0.1, 0.1), (0.9, 0.9), (0.9, 0.1), (0.1, 0.8))), ("none", [])]
    df = spark.createDataFrame(rows, "name string, p array<struct<x:double,y:double>>")
    out = {r.name: r for r in df.select("name", geo.polygon_area(F.col("p")).alias("area"), geo.topology_issues(F.col("p")).alias("issues"), geo.touches(F.col("p")).alias("t")).collect()}
    assert out["square"].area == 1.0 and out["square"].issues == [] and all(out["square"].t)
    assert out["flat"].issues == ["zero_or_near_zero_area", "non_simple_polygon"]
    assert out["bow"].issues == ["self_intersection", "non_simple_polygon"]
    assert out["none"].area == 0 and out["none"].issues == ["insufficient_unique_vertices", "non_simple_polygon"]
    flat = spark.createDataFrame([([10.0, 10.0, 90.0, 10.0, 50.0, 90.0],), ([10.0, 10.0, 190.0, 10.0, 50.0, 90.0],), ([1.0, 2.0],)], "c array<double>")
    points = [r[0] for r in flat.select(geo.points_of_component(F.col("c"), F.lit(100), F.lit(100))).collect()]
    assert [p and len(p) for p in points] == [3, None, None]


def test_boxes(spark):
    box = F.struct(F.lit(-5.5).alias("x1"), F.lit(2.2).alias("y1"), F.lit(30.1).alias("x2"), F.lit(20.0).alias("y2"))
    turned = F.struct(F.lit(0.0).alias("x1"), F.lit(0.0).alias("y1"), F.lit(4.0).alias("x2"), F.lit(2.0).alias("y2"))
    r = spark.range(1).select(boxes.clip(box, F.lit(25), F.lit(40)).alias("c"), boxes.validate(box, F.lit(25), F.lit(40), 0.9).alias("v"), boxes.hull_of_rotated(turned, F.lit(90.0)).alias("h"), boxes.center_crop(F.lit(5), F.lit(7), 0.5).alias("m"), boxes.letterbox(F.lit(100), F.lit(50), 64, 64).alias("l")).first()
    assert tuple(r.c) == (0, 2, 25, 20) and (r.v.detected, r.v.reason, tuple(r.v.box)) == (False, "too_small", (0, 2, 25, 20))
    assert [round(v, 9) for v in r.h] == [1, -1, 3, 3] and tuple(r.m) == (1, 1, 3, 5)
    assert tuple(r.l) == (0.64, 64, 32, 0, 16, 0, 16)


def test_names(spark):
    paths = {"a/b/Leaf 1_jpg.rf.0ab.jpg": "Leaf 1", "Leaf_PNG.rf.x.png": "Leaf", "x.jpg": "x", ".hidden": ".hidden", "a_jpg.rf.": "a_jpg.rf."}
    df = spark.createDataFrame([(k,) for k in paths], "p string")
    assert {r.p: r.b for r in df.select("p", strings.export_base(F.col("p")).alias("b")).collect()} == paths
    r = spark.range(1).select(
        strings.coordinate(F.lit(10.0)).alias("a"),
        strings.coordinate(F.lit(0.25)).alias("b"),
        strings.split_of(F.lit("x/Val.csv")).alias("c"),
        strings.split_list(F.lit("train, val val")).alias("d"),
        strings.reason_text(F.lit("k"), {"k": "kept"}, F.lit("so")).alias("e"),
        strings.resolve_path(F.lit("a.jpg"), F.lit(""), F.lit("/m/")).alias("f"),
        strings.json_or_column(F.lit("no json"), "k", F.lit("flat")).alias("g"),
        hashing.parse_hash(F.lit("ahash64:ffffffffffffffff")).alias("h"),
        hashing.format_hash(F.lit(-1).cast("long")).alias("i"),
    ).first()
    assert tuple(r) == ("10", "0.25", "val", ["train", "val"], "kept: so", "/m/a.jpg", "flat", -1, "ahash64:ffffffffffffffff")


def test_groups_and_assignment(spark):
    def assign(rows):
        records = spark.createDataFrame(rows, "k int, sha string, source string, small int, bits long")
        roots = sp.related(records, "k", [["sha"]], "bits", 1)
        found = records.join(roots, "k")
        features = sp.group_features(found, "group_root", {"images": F.lit(1), "masks": F.lit(1)}, {"source": F.col("source"), "area": F.col("small")})
        return {r.group_root: r.split for r in sp.assign_splits(features, "group_root").collect()}, found

    spread = [(k, "", "s", 0, k * 7919 * 65537) for k in range(60)]
    got, _ = assign(spread)
    assert Counter(got.values()) == {"train": 42, "val": 9, "test": 9}
    two = [(k, "", "rare" if k < 20 else "often", int(k % 5 == 0), k * 7919 * 65537) for k in range(100)]
    got, _ = assign(two)
    assert Counter(got[str(k)] for k in range(20)) == {"train": 14, "val": 3, "test": 3}
    assert Counter(got[str(k)] for k in range(0, 100, 5)) == {"train": 14, "val": 3, "test": 3}
    chain = [(1, "a", "s", 0, 0), (2, "a", "s", 0, 0b110000), (3, "b", "s", 0, 0b111000), (4, "", "s", 0, 1 << 40 | 0b1010101), (5, "", "s", 0, 1 << 50 | 0b10101010)]
    _, found = assign(chain)
    assert {r.k: r.group_root for r in found.collect()} == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5}


def test_swaps_improve_and_keep_sizes():
    rng = np.random.default_rng(1)
    counts = np.column_stack([np.ones(40), rng.integers(0, 5, (40, 3))])
    a = sp.Assignment([f"g{k:02d}" for k in range(40)], ["images", "masks", "source:a", "area:small"], counts, (0.7, 0.15, 0.15), 1)
    a.greedy()
    sizes = np.bincount(a.split, minlength=3)
    before = sum(float(a.cost(s, a.state[s])) for s in range(3))
    a.swap()
    assert (np.bincount(a.split, minlength=3) == sizes).all() and sizes.tolist() == [28, 6, 6]
    assert sum(float(a.cost(s, a.state[s])) for s in range(3)) <= before + 1e-9
    assert np.allclose(a.state, [counts[a.split == s].sum(0) for s in range(3)])


def test_choices_of_gates_and_thresholds(spark):
    rows = [(0.2, 0.98, 0.91, 0.9, 0.0), (0.4, 0.97, 0.94, 0.9, 0.0), (0.6, 0.95, 0.96, 0.9, 0.0)]
    df = spark.createDataFrame(rows, "selection_threshold double, mean_leaf_pixel_recall double, mean_dice double, mean_leaf_pixel_precision double, fallback_rate double")
    assert ev.choose_threshold(df, 0.97).first().selection_threshold == 0.4
    assert ev.choose_threshold(df, 0.99).first().selection_threshold == 0.2
    assert ev.choose_threshold(df.limit(0)).count() == 0
    gates = spark.createDataFrame([(0.5, 9, 10, 12, 20), (0.7, 8, 8, 12, 20), (0.6, 8, 8, 12, 20)], "max_area double, reliable_good long, reliable long, good long, n long")
    assert ev.recommend_gate(gates, {"max_area": 0.62}).first().max_area == 0.6
    with pytest.raises(Exception, match="no gate reaches"):
        ev.recommend_gate(gates.where("max_area = 0.5"), {"max_area": 0.5}).collect()


def test_masks_match_brute_force(spark):
    rng = np.random.default_rng(3)
    mask = rng.random((20, 20)) < 0.55
    seen, areas = np.zeros_like(mask), []
    for start in zip(*np.nonzero(mask)):
        if not seen[start]:
            stack, n = [start], 0
            seen[start] = True
            while stack:
                y, x = stack.pop()
                n += 1
                for v, u in ((y + 1, x), (y - 1, x), (y, x + 1), (y, x - 1)):
                    if 0 <= v < 20 and 0 <= u < 20 and mask[v, u] and not seen[v, u]:
                        seen[v, u] = True
                        stack.append((v, u))
            areas.append(n)
    assert masks.components(mask).tolist() == sorted(areas, reverse=True)
    inside = masks.fill([[(0.1, 0.1), (0.9, 0.1), (0.9, 0.9), (0.1, 0.9)]], 21)
    assert inside.sum() == 16 * 16 and masks.fill([[(0, 0), (1, 1)]], 9).sum() == 0 and masks.geometry(np.zeros((3, 3), bool)) is None
    square = [[Row(x=0.1, y=0.1), Row(x=0.9, y=0.1), Row(x=0.9, y=0.9), Row(x=0.1, y=0.9)]]
    df = spark.createDataFrame([(1, square), (2, []), (3, None)], "k int, o array<array<struct<x:double,y:double>>>")
    drawn = masks.rasterised(df, "k", "o", 21)
    found = {r.k: r for r in masks.measured(drawn, "k", 21).collect()}
    assert (found[1].area_pixels, found[1].perimeter_edges, found[1].connected_components, found[1].border_contact_count) == (256, 64, 1, 0)
    assert found[1].normalized_perimeter == 4.0 and found[2].area_pixels is None and found[3].area_pixels is None
    pair = drawn.where("k = 1").select(F.col("mask").alias("a")).join(drawn.where("k = 2").select(F.col("mask").alias("b"))).select(masks.overlap(F.col("a"), F.col("b")).alias("o"), masks.overlap(F.col("a"), F.col("a")).alias("s")).first()
    assert tuple(pair.o) == (256, 0, 0) and tuple(pair.s) == (256, 256, 256)


def test_quantiles_and_numbers(spark):
    rng = np.random.default_rng(0)
    rows = [("a", float(v)) for v in rng.integers(0, 50, 301)] + [("b", 3.0)] * 10 + [("c", float(v)) for v in rng.normal(size=77)] + [("c", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    got = {r.g: r for r in rel.exact_quantiles(df, ["g"], "v", (0.25, 0.5, 0.9), bins=16).collect()}
    for g in "abc":
        values = [v for k, v in rows if k == g and v is not None]
        assert got[g].q == pytest.approx(np.quantile(values, (0.25, 0.5, 0.9))) and got[g].n == len(values)
    numbers = [r.at for r in rel.numbered(df.where("g = 'c' and v is not null"), ["v"], "at").orderBy("v").collect()]
    assert numbers == list(range(1, 78))
    plan = rel.numbered(df, ["v"], "at", ["g"])._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_shares_and_samples(spark):
    total = spark.createDataFrame([(7,), (0,), (100,)], "n long")
    parts = rel.largest_remainder(F.col("n"), (0.7, 0.15, 0.15))
    assert {r.n: tuple(r)[1:] for r in total.select("n", *[p.alias(f"p{k}") for k, p in enumerate(parts)]).collect()} == {7: (5, 1, 1), 0: (0, 0, 0), 100: (70, 15, 15)}
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", 3), ("b", 9)], "g string, k int")
    taken = rel.oversample(df, "g", ["k"]).collect()
    assert sorted((r.g, r.k, r.copy) for r in taken) == [("a", 1, 0), ("a", 2, 0), ("a", 3, 0), ("b", 9, 0), ("b", 9, 1), ("b", 9, 2)]
    assert [r.k for r in rel.round_robin(df, "g", ["k"], 3).collect()] == [1, 9, 2]


def test_readers_and_writers(spark, tmp_path):
    df = spark.createDataFrame([(1, "x"), (2, None)], "id int, name string")
    writers.write_csv(df, str(tmp_path / "csv"), ["id", "name"])
    assert readers.read_csv(spark, str(tmp_path / "csv"), "id int, name string", ["id"]).count() == 2
    writers.write_json(df, str(tmp_path / "json"))
    writers.write_split(df.withColumnRenamed("name", "split"), str(tmp_path / "split"))
    (tmp_path / "labels").mkdir()
    (tmp_path / "labels" / "a.txt").write_text("0 1 2\n\n1 3 4\n")
    assert [(r.line_number, r.raw_line) for r in readers.read_label_lines(spark, str(tmp_path / "labels")).collect()] == [(1, "0 1 2"), (2, ""), (3, "1 3 4")]
    ends = spark.createDataFrame([("",), ("a",), ("a\r\nb\x0cc\n\n",), ("\n",)], "t string")
    assert [r[0] for r in ends.select(readers.lines_of(F.col("t"))).collect()] == [[], ["a"], ["a", "b", "c", ""], [""]]
    assert [r[0] for r in ends.select(readers.nth_line(F.col("t"), F.lit(2))).collect()] == [None, None, "b", None]
    (tmp_path / "coco.json").write_text('{"images":[{"id":1,"file_name":"a.jpg","width":4,"height":4}],"categories":[],"annotations":[{"id":5,"image_id":1,"category_id":0,"bbox":[0,0,1,1],"area":1.0,"segmentation":[[0,0,1,0,1,1]]}]}')
    coco = readers.read_coco(spark, str(tmp_path / "coco.json"))
    assert coco["images"].count() == 1 and coco["annotations"].first().segmentation.startswith("[[0")
    (tmp_path / "cvat.xml").write_text('<annotations><image name="a" width="4" height="5"><box label="leaf" xtl="1" ytl="1" xbr="2" ybr="3"/></image></annotations>')
    assert readers.read_cvat(spark, str(tmp_path / "cvat.xml")).first().name == "a"
    (tmp_path / "files").mkdir()
    (tmp_path / "files" / "a.jpg").write_bytes(b"\xff\xd8xx\xff\xd9")
    assert readers.read_files(spark, str(tmp_path / "files"), "*.jpg").first().is_whole_jpeg


def test_more_sources_and_sinks(spark, tmp_path):
    p = lambda name: str(tmp_path / name)
    (tmp_path / "bom.csv").write_bytes("\ufeffimage_id,flag,label\n1,True,GOOD\n2,false,BAD\n".encode())
    assert readers.read_strings(spark, p("bom.csv"), ["image_id"]).columns == ["image_id", "flag", "label"]
    audit = readers.read_audit(spark, p("bom.csv"), ["flag"], "label", ["GOOD", "BAD"], "image_id")
    assert [r.flag for r in audit.orderBy("image_id").collect()] == [True, False]
    with pytest.raises(ValueError, match="unknown_label"):
        readers.read_audit(spark, p("bom.csv"), ["flag"], "label", ["GOOD"], "image_id")
    with pytest.raises(ValueError, match="missing"):
        readers.read_strings(spark, p("bom.csv"), ["other"])
    assert readers.read_csv_or_empty(spark, p("nothing.csv"), "a int").count() == 0
    (tmp_path / "head.csv").write_text("source_dataset,filename\n")
    with pytest.raises(ValueError, match="no reviews"):
        readers.read_reviews(spark, p("head.csv"), ["filename"])
    (tmp_path / "images").mkdir()
    png = b"\x89PNG\r\n\x1a\n" + b"\0\0\0\rIHDR" + (7).to_bytes(4, "big") + (5).to_bytes(4, "big")
    exif = b"Exif\0\0II*\0\x08\0\0\0\x01\0\x12\x01\x03\0\x01\0\0\0\x06\0\0\0\0\0\0\0"
    jpeg = b"\xff\xd8\xff\xe1" + (len(exif) + 2).to_bytes(2, "big") + exif + b"\xff\xc0\x00\x11\x08\x00\x04\x00\x09" + b"\0" * 12
    for name, data in {"A.png": png, "b.jpg": jpeg, "c.jpg": b"\xff\xd8\xff", "d.txt": b"x"}.items():
        (tmp_path / "images" / name).write_bytes(data)
    sizes = {r.path.rsplit("/", 1)[-1]: (r.format, r.width, r.height, r.error) for r in readers.read_image_sizes(spark, p("images")).collect()}
    assert sizes == {"A.png": ("png", 7, 5, None), "b.jpg": ("jpeg", 4, 9, None), "c.jpg": (None, None, None, "truncated"), "d.txt": (None, None, None, "unknown_format")}
    assert [r.stem for r in readers.list_files(spark, p("images")).collect()] == ["a", "b", "c"]
    pairs = {r.stem: r.problem for r in readers.paired_files(spark, p("images"), p("images")).collect()}
    assert pairs == {"a": "image_without_label", "b": "image_without_label", "c": "image_without_label", "d": "label_without_image"}
    (tmp_path / "labels").mkdir()
    (tmp_path / "labels" / "a.txt").write_bytes("\ufeff1 0.2 0.2 0.8 0.2 0.5 0.8\n\n0 bad".encode())
    (tmp_path / "labels" / "b.txt").write_bytes(b"\xff\xfe\xfa")
    assert sorted((r.error or "", (r.text or "")[:1]) for r in readers.label_texts(spark, p("labels")).collect()) == [("", "1"), ("not_utf8", "")]
    lines = readers.read_label_lines(spark, p("labels/a.txt")).withColumn("raw_line", F.regexp_replace("raw_line", "^\ufeff", ""))
    assert [r.class_id for r in readers.valid_polygons(lines).collect()] == [1]
    with pytest.raises(ValueError, match="invalid label lines"):
        readers.valid_polygons(lines, strict=True)
    text = spark.createDataFrame([("path: x\nnames: ['leaf', \"stem\"]\nLicense: CC BY 4.0\n",)], "t string")
    assert tuple(text.select(readers.yaml_names(F.col("t")), readers.licence_name(F.col("t"))).first()) == (["leaf", "stem"], "CC BY 4.0")
    kinds = spark.createDataFrame([("[[1, 2, 3, 4, 5, 6]]",), ('{"counts": [1]}',), (None,), ("[]",)], "s string")
    assert [r[0].kind for r in kinds.select(readers.segmentation_detail(F.col("s"))).collect()] == ["polygon", "rle", "missing", "missing"]
    nested = spark.createDataFrame([Row(b=1, a=Row(z=1, y=[Row(d=1, c=None)]))], "b int, a struct<z:int,y:array<struct<d:int,c:int>>>")
    writers.write_json(nested, p("json"))
    assert spark.read.text(p("json")).first().value == '{"a":{"y":[{"c":null,"d":1}],"z":1},"b":1}'
    writers.write_csv_union([nested.select("b"), nested.select(F.lit("x").alias("c"))], p("union"))
    assert spark.read.csv(p("union"), header=True).columns == ["b", "c"]
    writers.write_csv(nested.select("b").limit(0), p("empty"))
    assert spark.read.csv(p("empty"), header=True).columns == ["b"]
    with pytest.raises(Exception, match="exist"):
        writers.write_csv(nested.select("b"), p("empty"), exclusive=True)
    writers.write_checksums(readers.read_files(spark, p("images")), p("sums"), p("images"))
    assert [r.value.split("  ")[1] for r in spark.read.text(p("sums")).collect()] == ["A.png", "b.jpg", "c.jpg", "d.txt"]
    assert "| b |" in writers.markdown(nested.select("b"), "t") and "  1: b" in writers.dataset_yaml("r", {"train": "t"}, ["a", "b"])


def test_publishing_all_or_nothing(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    one = spark.range(1)
    writers.publish(spark, {a: one.write.parquet, b: one.write.parquet})
    def broken(path):
        raise RuntimeError("disk")
    with pytest.raises(RuntimeError):
        writers.publish(spark, {a: spark.range(5).write.parquet, b: broken})
    writers.publish(spark, {a: spark.range(3).write.parquet})
    assert (spark.read.parquet(a).count(), spark.read.parquet(b).count()) == (3, 1)
    assert sorted(x.name for x in tmp_path.iterdir() if not x.name.startswith(".")) == ["a", "b"]


def test_stream_takes_each_record_once(spark, tmp_path):
    path = lambda n: str(tmp_path / n)
    rows = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("event_id", "ts", "event_type", "value")
    rows.unionAll(rows.limit(50)).write.parquet(path("in"))
    stream = intake.first_seen(intake.read_stream(spark, path("in"), rows.schema), "ts", ["event_id"], "400 days")
    for _ in range(2):  # the second run has nothing to do
        intake.run_available(stream, path("out"), path("state"))
    assert spark.read.parquet(path("out")).count() == rows.count()
    counts = intake.windowed_counts(intake.read_stream(spark, path("in"), rows.schema), "ts", "event_type")
    intake.run_available(counts, path("counts"), path("state2"))
    assert spark.read.parquet(path("counts")).agg(F.sum("n")).first()[0] > 0
    digests = lambda v: spark.createDataFrame(v, "k string, d string")
    assert {r.k: r.problem for r in intake.unchanged(digests([("a", "1"), ("b", "1"), ("c", "1")]), digests([("a", "1"), ("b", "2"), ("d", "1")]), "k", "d").collect()} == {"b": "changed", "c": "removed", "d": "added"}
    made = []
    for print_ in ("x", "x", "y"):
        intake.cached(spark, path("cache"), print_, lambda: made.append(print_) or spark.range(2))
    assert made == ["x", "y"]


def test_validators(spark):
    values = spark.createDataFrame([({"a": 1.0, "b": float("nan")},)], "m map<string,double>")
    assert values.select(va.finite_metrics(F.col("m"), ["a", "b", "c"])).first()[0] == ["b", "c"]
    va.require(spark.range(0), "fine")
    with pytest.raises(ValueError, match="some"):
        va.require(spark.range(2), "some")
    paths = spark.createDataFrame([("a/.git/x",), ("a/b",)], "p string")
    assert [r[0] for r in paths.select(va.forbidden_path(F.col("p"), [".git"])).collect()] == [True, False]
    said = {"mask_too_small 3": "invalid_mask", "confidence_below_threshold": "low_segmentation_confidence", "touches": "no_reliable_instance"}
    traces = spark.createDataFrame([(k, [Row(eligible=False, reason=k)]) for k in said], "k string, t array<struct<eligible:boolean,reason:string>>")
    assert {r.k: r.r for r in traces.select("k", labels.failure_reason(F.lit(1), F.col("t")).alias("r")).collect()} == said


def test_single_boxes(spark):
    texts = {None: ("pending", "no_label"), "": ("ambiguous", "empty_label"), "0 0.5 0.5 0.4 0.4": ("annotated", None), "0 0.5 0.5 0.4 0.4\n0 0.5 0.5 0.4 0.4": ("ambiguous", "boxes=2"), "1 0.5 0.5 0.4 0.4": ("ambiguous", "class"), "0 0.5 0.5 0.4": ("ambiguous", "format"), "0 0 0 1 0 1 1": ("ambiguous", "polygon"), "0 0.5 9 0.4 0.4": ("ambiguous", "coordinates"), "0 0.1 0.5 0.4 0.4": ("annotated", "clipped_to_image")}
    df = spark.createDataFrame([(k,) for k in texts], "t string").withColumn("a", regions.single_box(F.col("t"), F.lit(100), F.lit(50), 0.01))
    assert {r.t: (r.a.status, r.a.note) for r in df.collect()} == texts


def test_models_as_table_functions(spark):
    class Halves:
        """A model that finds two boxes in images of even length."""

        def segment(self, content):
            if content == b"bad":
                raise ValueError("no image")
            return [{"confidence": 0.5, "class_id": k} for k in range(2)] if len(content) % 2 == 0 else []

    images = spark.createDataFrame([("a", b"1234"), ("b", b"12345"), ("c", b"bad")], "name string, content binary")
    out = models.segmented(images, "name", "content", Halves, "confidence double, class_id int").collect()
    assert sorted((r.name, r.source_index, r.class_id, r.error) for r in out if r.source_index is not None) == [("a", 0, 0, None), ("a", 1, 1, None)]
    assert sorted((r.name, r.error) for r in out if r.source_index is None) == [("b", None), ("c", "ValueError: no image")]
    said = {r.name: r.problem for r in models.checked(images, "name", "content", lambda d: "odd" if len(d) % 2 else None).collect()}
    assert said == {"a": None, "b": "odd", "c": "odd"}
    rows = spark.createDataFrame([(1, [0.5, 0.6], [0, 1])], "k int, conf array<double>, cls array<int>")
    assert [tuple(r) for r in models.instances(rows, ["conf", "cls"]).collect()] == [(1, 0, 0.5, 0), (1, 1, 0.6, 1)]
    with pytest.raises(Exception, match="differ in length"):
        models.instances(spark.createDataFrame([(1, [0.5], [0, 1])], "k int, conf array<double>, cls array<int>"), ["conf", "cls"]).collect()
    jpegs = spark.createDataFrame([(b"\xff\xd8x\xff\xd9",), (b"\xff\xd8x",), (b"GIF",)], "c binary").select(models.mended_jpeg(F.col("c")).alias("m")).collect()
    assert [(r.m.method, r.m.content and bytes(r.m.content)) for r in jpegs] == [("copy", b"\xff\xd8x\xff\xd9"), ("append_end", b"\xff\xd8x\xff\xd9"), ("re_encode", None)]


def test_gates_of_records(spark):
    images = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], "stem string, sha256 string")
    texts = spark.createDataFrame([("a",), ("b",), ("d",)], "stem string")
    manifest = spark.createDataFrame([("a", "1"), ("b", "x"), ("b", "y"), ("c", "3")], "stem string, image_sha256 string")
    records, found = sp.split_records(images, texts, manifest)
    assert {r.stem for r in records.collect()} == {"a", "b"}
    assert sorted((r.problem, r.stem) for r in found.collect()) == [("changed_image", "b"), ("contradicting_manifest", "b"), ("no_image", "d"), ("no_label", "c"), ("no_manifest", "d")]
    assert va.same_twice(lambda: images) and not va.same_twice(lambda: spark.range(3).select(F.rand()))
    lock = spark.createDataFrame([("ready", 3)], "status string, images int")
    assert [tuple(r) for r in va.lock_problems(lock, {"status": "ready", "images": 4, "sha": "x"}).collect()] == [("images", "3", "4"), ("sha", None, "x")]
    rows = spark.createDataFrame([("train", 2), ("val", 1)], "split string, masks int")
    assert [r.split for r in va.split_counts(rows, "split", "masks", {"train": (1, 2), "val": (1, 2)}).collect()] == ["val"]
    lines = spark.createDataFrame([("f", 1, "x"), ("f", 2, " "), ("f", 3, "y")], "file string, line_number int, raw_line string")
    assert [r.instance for r in readers.instance_index(lines).orderBy("line_number").collect()] == [1, None, 2]


def test_manifests(spark):
    rows = spark.createDataFrame([("val", "B.jpg"), ("train", "b.jpg"), ("train", "A.jpg"), ("other", "a")], "split string, name string")
    assert [tuple(r) for r in mf.canonical_order(rows, "split", "name").collect()] == [("train", "A.jpg"), ("train", "b.jpg"), ("val", "B.jpg"), ("other", "a")]
    keys = mf.held_out_keys(spark.createDataFrame([("x/A.JPG", "1"), ("y/a.jpg", None), ("", "2")], "p string, d string"), "p", "d")
    assert {k: sorted(r[0] for r in v.collect()) for k, v in keys.items()} == {"path": ["x/a.jpg", "y/a.jpg"], "name": ["a.jpg"], "digest": ["1", "2"]}
    manifest = spark.createDataFrame([("d/a.jpg",), ("d/b.jpg",), ("e/b.jpg",), ("d/z.jpg",)], "derived string")
    kept, wrong = mf.surviving(manifest, "derived", spark.createDataFrame([("a.jpg",), ("b.jpg",), ("c.jpg",)], "name string"), "name")
    assert kept.count() == 3 and {tuple(r) for r in wrong.collect()} == {("b.jpg", 2), ("c.jpg", 0)}
    packages = spark.createDataFrame([(5, "a"), (7, "b"), (7, "c")], "time int, name string")
    assert mf.latest(packages, "time", "name").first().name == "c" and mf.latest(packages.limit(0), "time", "name").count() == 0
    good, bad = mf.payload([spark.createDataFrame([("a/x",), ("a/.git/y",)], "path string"), spark.createDataFrame([("a/x",), ("b",)], "path string")], "path", [".git"])
    assert [r.path for r in good.collect()] == ["a/x", "b"] and [r.path for r in bad.collect()] == ["a/.git/y"]
    rejected = spark.range(1).select(boxes.crop_plan(F.struct(F.lit(5.0).alias("x1"), F.lit(5.0).alias("y1"), F.lit(4.0).alias("x2"), F.lit(9.0).alias("y2")), F.lit(20), F.lit(10), 0.01, 0.1, (8, 8), "reject").alias("p")).first().p
    assert (rejected.crop, rejected.fitted, rejected.fallback, rejected.note) == (None, None, True, "x_inverted")

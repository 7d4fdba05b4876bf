"""Scores, covers, gates, splits, boxes, pixel rows, sources and images on hand-made inputs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from inkwell.operators import dataset as D
from inkwell.operators import images as I
from inkwell.operators import layout as L
from inkwell.operators import scores as S
from inkwell.sources import readers as R

SCORES = "doc_id long, source string, idx int, cer double, jacc_multi double, ratios_mean double"


def test_winners_break_ties_by_index_and_skip_nulls(spark):
    rows = [(1, "a", 0, None, 0.5, 2.0), (1, "a", 1, 0.3, 0.5, 0.9), (1, "a", 2, 0.3, 0.9, 1.1), (2, "a", 0, None, 0.1, 0.0)]
    found = {r.doc_id: r for r in S.winners(spark.createDataFrame(rows, SCORES)).collect()}
    assert (found[1].by_cer, found[1].by_jacc, found[1].by_ratio) == (1, 2, 1)
    assert found[2].by_cer is None and found[2].by_jacc == 0


def test_clip_keeps_null(spark):
    rows = spark.createDataFrame([(3.0,), (None,), (1.0,)], "cer double")
    assert [r.c for r in rows.select(S.clip().alias("c")).collect()] == [2.0, None, 1.0]


def test_greedy_cover_breaks_ties_by_index_and_stops(spark):
    bad = (0.5, 0.1, 5.0)
    ok = (0.01, 0.1, 5.0)
    covers = {1: {0}, 2: {0, 1}, 3: {1, 2}, 4: set()}
    rows = [(d, "a", v, *(ok if v in c else bad)) for d, c in covers.items() for v in range(3)]
    assert [tuple(r) for r in S.greedy_cover(spark.createDataFrame(rows, SCORES)).collect()] == [(1, 0, 2), (2, 1, 1)]


def test_profile_of_a_single_row_has_no_deviation(spark):
    row = S.profile_by_variant(spark.createDataFrame([(1, "a", 0, 0.5, 0.1, 1.0)], SCORES)).first()
    assert row.std_cer is None and row.n_min == row.n_max == 1


def test_gate_measures_before_it_normalises(spark):
    assert D.ctc_limit(320, 4) == 78 and D.ctc_limit(640, 4) == 158
    rows = [("p", "a" * 78), ("p", "a" * 79), ("p", "a" * 77 + "…"), ("p", ""), ("p", "日é√"), (None, "x"), ("p", "")]
    out = [r.status for r in D.gate(spark.createDataFrame(rows, "path string, label string"), 78, charset=D.CHARSET).collect()]
    assert out == ["kept", "too_long", "kept", "kept", "out_of_charset", "malformed", "empty"]


def test_tiers_and_missing_metrics(spark):
    names = "h int, ratio double, edge_ink double, lap_var double, std double, black double, oov int, len int, too_small_h int, crazy_ratio int"
    good = (30, 5.0, 0.01, 100.0, 30.0, 0.5, 0, 10, 0, 0)
    rows = [good, (18, *good[1:]), (15, *good[1:]), (None,) * 10]
    assert [r.t for r in spark.createDataFrame(rows, names).select(D.tier().alias("t")).collect()] == ["A", "B", "C", "C"]


def test_split_is_disjoint_and_rounds_half_to_even(spark):
    rows = spark.range(25).withColumnRenamed("id", "doc_id")
    parts = {r.split: r["count"] for r in D.split(rows, "doc_id", 0.1, 0.02).groupBy("split").count().collect()}
    assert parts == {"val": 2, "test": 1, "train": 22}


def test_until_target_keeps_the_crossing_row(spark):
    rows = spark.createDataFrame([(i, 10) for i in range(10)], "id long, n long")
    assert sorted(r.id for r in D.until_target(rows, "id", "n", 35).collect()) == [0, 1, 2, 3]


def test_boxes(spark):
    rows = spark.createDataFrame([([10.0, 10.0, 5.0, 5.0],), ([10.0, 10.0, 0.0, 5.0],), ([0.5, 1.5, 2.0, 200.0],)], "b array<double>")
    boxes = rows.select(*(c.alias(k) for k, c in D.to_xyxy(F.col("b")).items()))
    assert [tuple(r) for r in boxes.collect()][:2] == [(10.0, 10.0, 15.0, 15.0), (10.0, 10.0, 0.0, 5.0)]
    clipped = boxes.select(*(c.alias(k) for k, c in D.clipped({k: F.col(k) for k in ("x0", "y0", "x1", "y1")}, F.lit(20), F.lit(20)).items()))
    assert tuple(clipped.collect()[2]) == (0, 2, 2, 20)


def test_priority_lookup(spark):
    images = spark.createDataFrame([("a_0001",), ("b",), ("c",), ("h",)], "stem string")
    index = spark.createDataFrame([("1", "a", None, None), ("2", "x", "b", None), ("3", "y", "b", "h")], "json string, json_stem string, original_stem string, page_hash string")
    assert {r.stem: r.json for r in D.priority_lookup(images, index).collect()} == {"a_0001": "1", "b": "3", "c": None, "h": "3"}


def test_bands_and_last_segment(spark):
    dark = {0, 5, 6, 18}  # top run touches the edge and does not count
    rows = spark.createDataFrame([(1, y, 100 if y in dark else 255, 20) for y in range(20)], "page long, y int, max_px int, h int")
    assert [(r.start, r.end) for r in L.bands(rows).orderBy("start").collect()] == [(5, 7), (18, 19)]
    assert [(r.start, r.end) for r in L.segments(rows).orderBy("start").collect()] == [(0, 5), (7, 18)]


def test_lines_follow_the_running_mean(spark):
    rows = [(1, 5.0, 0.0, "b", 3.0), (1, 0.0, 2.0, "a", 3.0), (1, 9.0, 3.5, "c", 3.0), (1, 0.0, 9.0, "d", 3.0)]
    out = L.grouped_lines(spark.createDataFrame(rows, "page long, x double, y double, text string, threshold double")).first()
    assert out.text == "a b c\nd"


def test_training_lines(spark):
    rows = spark.createDataFrame([("a\tb\tc",), ("a  b c",), ("a",), ("  ",), (" a \t b ",)], "v string")
    p, l = R.path_and_label(F.col("v"))
    assert [tuple(r) for r in rows.select(p.alias("p"), l.alias("l")).collect()] == [("a", "b\tc"), ("a", "b c"), (None, None), (None, None), ("a", "b")]


def test_section_values(spark):
    rows = spark.createDataFrame([('["a","b"]',), ("plain",)], "v string")
    assert [r.x for r in rows.select(R.sections_value(F.col("v")).alias("x")).collect()] == [["a", "b"], ["plain"]]


def test_images():
    m = np.zeros((20, 60), np.uint8)
    m[5:10] = 255
    assert I.otsu(m) == 0 and I.quality(m)[:3] == (60, 20, 3.0)
    assert I.letterbox(m, 10, 40).shape == (10, 40) and I.three_channels(m).shape == (20, 60, 3)
    quad = np.array([[2, 4], [12, 4], [12, 11], [2, 11]], float)
    assert (I.warped(m, quad) == m[4:11, 2:12]).all()
    with pytest.raises(ValueError):
        I.warped(m, np.zeros((4, 2)))
    stamp = np.arange(60, dtype=np.uint8).reshape(1, 60).repeat(3, 0) * 4
    both = np.vstack((m, stamp, m))
    assert (I.without_templates(both, [stamp], 0.99, 0) == np.vstack((m, m))).all()
    views = [np.arange(50, dtype=np.uint8)[:, None].repeat(4, 1)] * 2
    assert I.overlap(views[0][:40], views[0][15:], 40) == 25
    line = np.full((10, 200), 0, np.uint8)
    line[:, 95:110] = 255
    assert [p.shape[1] for p in I.split_long(line, 12.0)][0] in range(90, 110)


def test_image_queries_take_whole_images(spark, tmp_path):
    import hashlib

    from inkwell.queries import layout
    from inkwell.registry import queries

    heights = {1: 40, 2: 400}
    rng = np.random.default_rng(7)
    pages = {k: rng.integers(33, 127, (h, 64), np.uint8) for k, h in heights.items()}
    spark.createDataFrame([(k, "u", m.tobytes().decode()) for k, m in pages.items()], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    found = {n: {r.page: tuple(r)[1:] for r in queries()[n](spark, str(tmp_path)).collect()} for n in ("img_split_long", "img_template_remove", "img_popup_bbox", "img_popup_patch", "img_overlap_offset", "img_stitch")}
    for k, h in heights.items():
        assert found["img_split_long"][k] == (len(I.split_long(np.hstack(np.split(pages[k], h // 8)))),)
        assert found["img_template_remove"][k] == (h - 4,)
        x0, y0, x1, y1 = found["img_popup_bbox"][k]  # the stamp is like itself a few rows off
        assert abs(y0 - h // 2) < 6 and (x1 - x0, y1 - y0) == (20, 6)
        assert found["img_popup_patch"][k] == (hashlib.md5(pages[k][:-4].tobytes()).hexdigest(),)
        assert found["img_overlap_offset"][k] == (h - 2 * (h // 8),)
        assert found["img_stitch"][k][0] >= h and (layout._restitched(pages[k])[:h] == pages[k]).all()
    assert found["img_split_long"][2] > found["img_split_long"][1]
    stamp = pages[2][100:106, 8:28]
    assert (I.correlation(pages[2], stamp) == I.correlation(pages[2], stamp, 400)).all()

"""Running sums, ranks and searches that are cut into ranges, against plain definitions; sinks read back."""

import json
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from inkwell.operators import consensus as C
from inkwell.operators import dataset as D
from inkwell.operators import scores as S
from inkwell.sources import sinks as W
from inkwell.sources.readers import lossy_texts
from inkwell.sources.scratch import scratch


@pytest.fixture
def small_slots(monkeypatch):
    monkeypatch.setattr(D, "SLOT_ROWS", 7)


def test_running_sums_by_group(spark, small_slots):
    rng = random.Random(3)
    rows = [(k, rng.choice(["a", "a", "a", "b", None]), rng.choice([None, 0, 1, 5])) for k in range(120)]
    rng.shuffle(rows)
    got = {r.id: r.before for r in D.running(spark.createDataFrame(rows, "id int, g string, n int"), "id", F.col("n"), "g").collect()}
    seen, want = {}, {}
    for k, g, n in sorted(rows, key=lambda r: r[0]):
        want[k] = seen.get(g, 0)
        seen[g] = want[k] + (n or 0)
    assert got == want


def test_running_sums_of_an_empty_table(spark):
    assert D.running(spark.createDataFrame([], "id int, n int"), "id", F.col("n")).collect() == []


def test_hash_places_are_gapless(spark, small_slots):
    rows = spark.range(500).toDF("id")
    places = D.ranked(rows, "id", 42).orderBy(D.hash_order("id", 42)).collect()
    assert [r.place for r in places] == list(range(1, 501))


@pytest.mark.parametrize("most", [0, 1, 40, 55, 90, 100, 120])
def test_nearest_takes_ties_by_key_and_missing_distances_last(spark, small_slots, most):
    rows = [(k, None if k % 10 == 0 else k % 3) for k in range(100)]
    got = D.nearest(spark.createDataFrame(rows, "id int, d int"), "d", "id", most)
    want = sorted(rows, key=lambda r: (r[1] is None, r[1] or 0, r[0]))[:most]
    assert sorted(r.id for r in got.collect()) == sorted(k for k, _ in want)


def test_profile_counts_rates_at_the_extremes(spark):
    rates = [0.5, 0.5, 1.0, None, 2.0, 2.0, 2.0]
    rows = [(k, "s", 0, c, 0.1, 1.0) for k, c in enumerate(rates)] + [(9, "s", 1, None, 0.1, 1.0)]
    got = {r.idx: r for r in S.profile_by_variant(spark.createDataFrame(rows, "doc_id int, source string, idx int, cer double, jacc_multi double, ratios_mean double")).collect()}
    assert (got[0].median_cer, got[0].n_min, got[0].n_max, got[0].n) == (1.5, 2, 3, 6)
    assert (got[1].mean_cer, got[1].median_cer, got[1].n_min, got[1].n_max, got[1].n) == (None, None, 0, 0, 0)


def test_contained_sentences(spark):
    passages = [(1, "the quick brown fox jumps over the lazy dog."), (2, "a dog."), (3, ""), (4, None), (None, "fox")]
    sentences = [(0, "the lazy dog."), (1, "dog."), (2, "brown fox jumps over the lazy cat."), (3, ""), (4, None), (5, "fox"), (6, "dog."), (7, "d")]
    found = C.in_passages(spark.createDataFrame(sentences, "doc_id int, s string"), spark.createDataFrame(passages, "item_id int, t string"))
    want = {(d, i) for d, s in sentences for i, t in passages if s and t and s in t}
    assert sorted(((r.doc_id, r.item_id) for r in found.collect()), key=str) == sorted(want, key=str)


def test_csv_is_appended_under_one_header(spark):
    path = scratch(spark, "csv")
    rows = [(1, 'a "b", c'), (2, "line\nbreak"), (3, None)]
    for part in (rows[:1], rows[1:]):
        W.append_csv(spark.createDataFrame(part, "id int, t string"), path)
    assert sorted(tuple(r) for r in W.appended_csv(spark, path, "id int, t string").collect()) == rows
    with pytest.raises(ValueError, match="other columns"):
        W.append_csv(spark.createDataFrame([(1,)], "id int"), path)
    parts = sorted(f for f in Path(path.removeprefix("file://")).iterdir() if f.suffix == ".csv")
    with open(parts[0]) as f:
        assert parts[0].name == "_header.csv" and f.read() == "id,t\n"
    assert "id,t" not in "".join(f.read_text() for f in parts[1:])


def test_json_arrays(spark):
    path = scratch(spark, "json")
    rows = [(k, "é\n\"x\"" if k % 2 else None) for k in range(25)]
    W.write_json_arrays(spark.createDataFrame(rows, "id int, t string").repartition(3), path)
    arrays = [json.loads(f.read_text()) for f in Path(path.removeprefix("file://")).glob("part-*")]
    assert sorted(o["id"] for a in arrays for o in a) == list(range(25))
    back = spark.read.schema("id int, t string").json(path, multiLine=True)
    assert sorted(tuple(r) for r in back.collect()) == rows
    W.write_json_arrays(spark.createDataFrame([], "id int"), empty := scratch(spark, "json"))
    assert spark.read.schema("id int").json(empty, multiLine=True).where("id IS NOT NULL").count() == 0


def test_rebuild_is_skipped_only_with_all_outputs(spark):
    outputs = [scratch(spark, "out") for _ in range(2)]
    manifest = spark.createDataFrame([(1, 5), (2, 7)], "built long, n_inputs long")
    spark.range(1).write.parquet(outputs[0])
    assert not W.unchanged(7, manifest, outputs)
    spark.range(1).write.parquet(outputs[1])
    assert W.unchanged(7, manifest, outputs) and not W.unchanged(5, manifest, outputs)
    assert not W.unchanged(7, manifest.limit(0), outputs)


def test_stray_bytes_are_left_out(spark):
    path = scratch(spark, "stray")
    stray = F.concat(F.lit("é a").cast("binary"), F.unhex(F.lit("FF"))).cast("string")
    W.write_texts(spark.range(2).select(F.col("id").alias("doc_id"), stray.alias("text")), path)
    assert sorted(tuple(r) for r in lossy_texts(spark, path, folder="doc_id").select("folder", "text").collect()) == [("0", "é a"), ("1", "é a")]

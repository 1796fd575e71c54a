"""Work is done once and without shuffles where a projection suffices."""

from pyspark.sql import functions as F

from textmill.operators import corpus as C
from textmill.operators import lookup as L
from textmill.operators.corpus import KEY
from textmill.plans.build import label_corpus

SCHEMA = "doc_id long, sent_idx int, sentence string, label string"


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def large_case(spark):
    words = [f"w{i}" for i in range(600)] + ["a.b", "C++", "É", "K9", "w1 w2"]
    kwmap = spark.createDataFrame([(i, w, "L" + w[-1]) for i, w in enumerate(words)] + [(0, "w0", "L0")],
                                  "pos int, keyword string, label string")
    rows = [(1, 0, "w1 w2, w599 and a.b in C++", "L1"), (1, 0, "w1 w2, w599 and a.b in C++", "L1"), (None, 1, "xw1 w1x é K9 " + chr(0x212A) + "9", "L9"),
            (2, 0, None, "L2"), (3, 0, "", "L2"), (4, 0, "W7 w7 axb", "L7")]
    return spark.createDataFrame(rows, SCHEMA), kwmap


def results(df, kwmap):
    return [sorted(map(str, x.collect())) for x in (
        C.match_keywords(df, kwmap, "sentence"), C.assign_labels(df, kwmap, "sentence"), C.mentions_any(df, kwmap),
        C.hide_own_keywords(df, kwmap, "sentence"), C.count_removed(df, kwmap, "sentence"))]


def test_large_maps_are_looked_up_inside_rows(spark, monkeypatch):
    df, kwmap = large_case(spark)
    inside = results(df, kwmap)
    assert sorted(r.keyword for r in C.match_keywords(df, kwmap, "sentence").collect()) == sorted(
        ["w1", "w2", "w1 w2", "w599", "a.b"] * 2 + ["É", "K9", "w7"])
    stored = df.repartition(2).localCheckpoint()
    for found in (C.match_keywords(stored, kwmap, "sentence"), C.mentions_any(stored, kwmap)):
        assert "Join" not in plan(found) and "Aggregate" not in plan(found)
    monkeypatch.setattr(L, "SLOT_BYTES", 0)
    assert results(df.repartition(1), kwmap) == inside


def test_parts_of_equal_hash_places_are_told_apart(spark):
    index = spark.range(20_000).select(F.concat(F.lit("p"), "id").alias("_part"), F.col("id").alias("n"))
    df = spark.range(50).select((F.col("id") * 391).alias("n"))
    found = L.with_candidates(df, "n", F.array(F.concat(F.lit("p"), F.col("n"))), index)
    assert all([e.n for e in r["_found"]] == [r.n] for r in found.collect())


def test_a_filter_on_labels_does_not_find_them_twice(spark):
    rows = [(1, 0, "mit license"), (1, 1, "other words"), (2, 0, "apache mit license")]
    df = spark.createDataFrame(rows, "doc_id long, sent_idx int, norm string").repartition(2).localCheckpoint()
    kept = C.exclude_label(label_corpus(df, {"apache": "A", "mit license": "M"}).select(*KEY, "label"))
    assert sorted(map(tuple, kept.collect())) == [(1, 0, "M"), (2, 0, "A")]
    assert plan(kept).count("concat_ws") == 1


def test_files_of_topic_blocks_hold_few_blocks(spark, monkeypatch):
    from textmill.operators import features as V
    from textmill.operators import topics as T
    monkeypatch.setattr(T, "BLOCK_CELLS", 20)
    fitted = []
    fit = T.fit_rows
    monkeypatch.setattr(T, "FIT_CELLS", 8)
    df = spark.createDataFrame([([f"w{i % 7}", f"x{i % 50}"],) for i in range(400)], "terms array<string>").coalesce(1)
    packed = T.term_blocks(df, V.build_vocabulary(df, "terms", None))
    files = packed.blocks.groupBy(F.input_file_name()).count().collect()
    assert sum(r["count"] for r in files) == 40 and max(r["count"] for r in files) <= 4
    # What cells owe is added up batch by batch.
    monkeypatch.setattr(T, "fit_rows", lambda n, *a: fitted.append(len(n)) or fit(n, *a))
    one = packed.blocks.limit(1).toArrow()
    sent = packed.links.where(F.col("block") == one.column("block")[0].as_py()).select(
        "pos", "idx", F.array(F.col("idx") + 1.0, F.lit(2.0)).alias("weights")).toArrow()
    added = T._Sums()
    T._fit_block(one, sent, 2, 0.5, 100, 1e-3, added.add)
    assert max(fitted) <= 8 and sum(fitted) == 20 and abs(added.sums.sum() - 20) < 1e-9

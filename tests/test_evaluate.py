import pytest

from textmill.operators import evaluate as E

# Pairs of (label, prediction) made for these tests, and how often each occurs.
PAIRS = {("A", "A"): 6, ("A", "B"): 2, ("B", "B"): 3, ("B", "C"): 1, ("C", "A"): 4, ("C", "C"): 4}


@pytest.fixture(scope="module")
def judged(spark):
    rows = [pair for pair, n in PAIRS.items() for _ in range(n)]
    return spark.createDataFrame(rows, "label string, prediction string").cache()


def test_report(judged):
    rows = {r.label: r for r in E.classification_report(judged).collect()}
    assert len(rows) == 6
    assert rows["accuracy"].f1 == pytest.approx(13 / 20) and rows["accuracy"].support == 20
    assert [(rows[x].precision, rows[x].recall, rows[x].support) for x in "ABC"] == [
        pytest.approx((6 / 10, 6 / 8, 8)), pytest.approx((3 / 5, 3 / 4, 4)), pytest.approx((4 / 5, 4 / 8, 8))]
    f1 = [2 / 3, 2 / 3, 8 / 13]
    assert rows["macro avg"].f1 == pytest.approx(sum(f1) / 3)
    assert rows["weighted avg"].f1 == pytest.approx((8 * f1[0] + 4 * f1[1] + 8 * f1[2]) / 20)


def test_matrix_has_all_cells(judged):
    cells = E.confusion_matrix(judged).collect()
    assert {(c.label, c.prediction): c.n for c in cells} == {(x, y): PAIRS.get((x, y), 0) for x in "ABC" for y in "ABC"}
    wide = E.confusion_wide(judged, list("ABC"))
    assert wide.count() == 3 and len(wide.columns) == 4


def test_zero_denominators(spark):
    df = spark.createDataFrame([("A", "B"), ("B", "B")], "label string, prediction string")
    rows = {r.label: r for r in E.per_label_metrics(df).collect()}
    assert (rows["A"].precision, rows["A"].recall, rows["A"].f1, rows["A"].support) == (0.0, 0.0, 0.0, 1)
    assert (rows["B"].precision, rows["B"].recall) == (0.5, 1.0)


def test_other_may_still_be_predicted_when_left_out(spark):
    df = spark.createDataFrame([("A", "Other"), ("A", "A"), ("Other", "A")], "label string, prediction string")
    rows = {r.label: r for r in E.metrics_excluding(df).collect()}
    assert rows["Other"].support == 0 and rows["A"].precision == 1.0 and rows["accuracy"].f1 == 0.5


def test_annotators_are_paired_by_key(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k int, label string")
    b = spark.createDataFrame([(2, "z"), (3, "x")], "k int, label string")
    assert list(map(tuple, E.compare_annotators(a, b, ["k"]).collect())) == [(2, "y", "z")]

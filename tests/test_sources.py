import json

import pytest

from textmill.sources import readers as R
from textmill.sources import writers as W


def test_keyword_map_keeps_file_order(spark, tmp_path):
    pairs = {"b k": "B", "a": "A", "é": "B"}
    (tmp_path / "map.json").write_text(json.dumps(pairs, ensure_ascii=False, indent=1), encoding="utf-8")
    got = R.read_keyword_map(spark, str(tmp_path / "map.json")).collect()
    assert [tuple(r) for r in got] == [(i, k, v) for i, (k, v) in enumerate(pairs.items())]


def test_broken_keyword_map_fails(spark, tmp_path):
    (tmp_path / "map.json").write_text("{broken")
    with pytest.raises(Exception):
        R.read_keyword_map(spark, str(tmp_path / "map.json")).collect()


def test_json_arrays(spark, tmp_path):
    (tmp_path / "s.json").write_text(json.dumps(["one", "zwei é"], indent=2))
    (tmp_path / "l.json").write_text(json.dumps([["A", "B"], [], ["C"]], indent=2))
    (tmp_path / "d.json").write_text(json.dumps([
        {"PubMedID": "1", "Abstract": "Text.", "Labels": ["A"]}, {"PubMedID": "2", "Labels": []}], indent=2))
    assert [(r.idx, r.value) for r in R.read_string_array(spark, str(tmp_path / "s.json")).collect()] == [
        (0, "one"), (1, "zwei é")]
    assert [r.labels for r in R.read_label_array(spark, str(tmp_path / "l.json")).collect()] == [["A", "B"], [], ["C"]]
    got = R.read_documents(spark, str(tmp_path / "d.json")).collect()
    assert [tuple(r) for r in got] == [("1", "Text.", ["A"]), ("2", None, [])]


@pytest.fixture
def tiny_splits(spark):
    """Files are split every few bytes."""
    held = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    yield lambda n: (spark.conf.set("spark.sql.files.maxPartitionBytes", n), spark.conf.set("spark.sql.files.openCostInBytes", 0))
    for k, v in held.items():
        spark.conf.set(k, v)


HARD = ["", ",", "a,b", '"', '",", [', "[", "]", "]],[[", "\\", 'x\\"', "\\,", "{é,}", "日本,\n語", "😀, ", None, "a" * 90, "1,2,3" * 20, "end"]


@pytest.mark.parametrize("size", [11, 1000])
@pytest.mark.parametrize("indent", [None, 2])
def test_one_array_over_many_tasks(spark, tmp_path, tiny_splits, size, indent):
    strings = HARD * 2
    lists = [HARD[:i % 5] for i in range(20)] + [[], ["]", ",["], []]
    for name, value in (("s", strings), ("l", lists), ("e", [])):
        (tmp_path / f"{name}.json").write_text(json.dumps(value, ensure_ascii=indent is None, indent=indent), encoding="utf-8")
    tiny_splits(size)
    got = R.read_string_array(spark, str(tmp_path / "s.json")).orderBy("idx").collect()
    assert [(r.idx, r.value) for r in got] == list(enumerate(strings))
    got = R.read_label_array(spark, str(tmp_path / "l.json")).orderBy("idx").collect()
    assert [(r.idx, r.labels) for r in got] == list(enumerate(lists))
    both = R.read_string_array(spark, [str(tmp_path / "s.json"), str(tmp_path / "e.json")])
    assert both.count() == len(strings)


@pytest.mark.parametrize("text", ['["a", "b"', '["a",, "b"]', '["a", ]', '{"a": 1}', '["a"]]', '["a" "b"]', '"a"', '["a", {"b": 1]'])
def test_broken_array_fails(spark, tmp_path, tiny_splits, text):
    (tmp_path / "b.json").write_text(text)
    tiny_splits(5)
    with pytest.raises(Exception):
        R.read_string_array(spark, str(tmp_path / "b.json")).collect()


def test_lines_are_trimmed_and_blank_ones_dropped(spark, tmp_path):
    (tmp_path / "t.txt").write_text("  a b \n\n\t \nc" + chr(0xA0) + "\n", encoding="utf-8")
    assert [r.value for r in R.read_lines(spark, str(tmp_path / "t.txt")).collect()] == ["a b", "c"]


def test_article_xml(spark, tmp_path):
    (tmp_path / "a.xml").write_text("""<PubmedArticleSet>
<PubmedArticle><MedlineCitation Status="x"><PMID Version="1">11</PMID><Article><Abstract>
<AbstractText Label="AIM">First part.</AbstractText><AbstractText>Second.</AbstractText></Abstract></Article></MedlineCitation></PubmedArticle>
<PubmedArticle><MedlineCitation><PMID Version="1">12</PMID><Article><Title>none</Title></Article></MedlineCitation></PubmedArticle>
<PubmedArticle><MedlineCitation><PMID>13</PMID><Article><Abstract><AbstractText>Only.</AbstractText></Abstract></Article></MedlineCitation></PubmedArticle>
</PubmedArticleSet>""")
    got = R.read_article_xml(spark, str(tmp_path / "a.xml")).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == [("11", "First part. Second."), ("13", "Only.")]


def test_article_xml_keeps_text_in_inline_markup(spark, tmp_path):
    (tmp_path / "a.xml").write_text("""<PubmedArticleSet><PubmedArticle><PMID>14</PMID><Abstract><AbstractText Label="A">
Growth of <i>E. coli</i> at 10<sup>6</sup> &lt; 7 &amp;lt; &#x3b1;&#946; cells.</AbstractText><AbstractText/><AbstractText>Second part.</AbstractText>
</Abstract></PubmedArticle></PubmedArticleSet>""", encoding="utf-8")
    got = R.read_article_xml(spark, str(tmp_path / "a.xml")).collect()
    assert [(r.doc_id, r.text.strip()) for r in got] == [
        ("14", "Growth of E. coli at 106 < 7 &lt; αβ cells. Second part.")]


def test_references_are_decoded_once(spark):
    from textmill.functions.text import decode_references, markup_text
    cases = [("&#38;lt;b&#38;gt; &amp;amp;", "&lt;b&gt; &amp;"), ("a &lt; b &#x3b1;&#946;&#x1F600;", "a < b αβ😀"), ("", ""), ("&nbsp; &#0; &#xD800; &#9999999; &", "&nbsp; &#0; &#xD800; &#9999999; &"),
             ("&lt;", "<"), (None, None)]
    df = spark.createDataFrame([(a,) for a, _ in cases], "t string")
    assert [r[0] for r in df.select(decode_references("t")).collect()] == [b for _, b in cases]
    marked = [("x<![CDATA[a <b> &amp; ]] c]]>y &amp;<i>z</i><!-- no -->", "xa <b> &amp; ]] cy &z"), ("<![CDATA[]]>", ""), ("p<![CDATA[1]]><![CDATA[2]]>", "p12")]
    df = spark.createDataFrame([(a,) for a, _ in marked], "t string")
    assert [r[0] for r in df.select(markup_text("t")).collect()] == [b for _, b in marked]


def test_article_xml_reads_cdata(spark, tmp_path):
    (tmp_path / "a.xml").write_text("<S><PubmedArticle><PMID>1</PMID><Abstract><AbstractText>&#38;lt;b&#38;gt; <![CDATA[p < q & r]]></AbstractText>"
                                    "</Abstract></PubmedArticle></S>")
    assert R.read_article_xml(spark, str(tmp_path / "a.xml")).first().text == "&lt;b&gt; p < q & r"


def test_keyword_map_leaves_blank_keywords_out(spark, tmp_path):
    (tmp_path / "k.json").write_text('{"a b": "X", "": "Y", " ": "Z"}')
    assert [r.keyword for r in R.read_keyword_map(spark, str(tmp_path / "k.json")).collect()] == ["a b"]


def test_corpus_formats(spark, tmp_path):
    df = spark.createDataFrame([(1, 0, "Ein Satz é."), (1, 1, "two\nlines")], "doc_id long, sent_idx int, sentence string")
    W.write_corpus(df, str(tmp_path / "t"), "txt")
    assert sorted(r.value for r in R.read_lines(spark, str(tmp_path / "t")).collect()) == ["Ein Satz é.", "two lines"]
    for fmt in ("json", "parquet"):
        W.write_corpus(df, str(tmp_path / fmt), fmt)
        assert sorted(spark.read.schema(df.schema).format(fmt).load(str(tmp_path / fmt)).collect()) == sorted(df.collect())
    with pytest.raises(ValueError):
        W.write_corpus(df, str(tmp_path / "x"), "csv")


def test_records_and_metrics(spark, tmp_path):
    df = spark.createDataFrame([("7", "text", ["A"])], "doc_id string, text string, labels array<string>")
    W.write_abstracts(df, str(tmp_path / "r"))
    assert R.read_documents(spark, str(tmp_path / "r"), "jsonl").collect() == df.collect()
    W.write_abstracts(df, str(tmp_path / "p"), "parquet")
    assert R.read_documents(spark, str(tmp_path / "p"), "parquet").collect() == df.collect()
    metrics = spark.createDataFrame([("A", 0.5, 1.0, 0.6, 3)], "label string, precision double, recall double, f1 double, support long")
    W.write_metrics(metrics, str(tmp_path / "m"))
    assert spark.read.schema(metrics.schema).json(str(tmp_path / "m")).collect() == metrics.collect()

"""Main text of pages, and nearest neighbours against brute force."""

import numpy as np

from textmill.llm import htmltext, neighbours


def page(k: int, body: str) -> str:
    return (f"<html><head><title>t{k}</title><style>x</style></head><body><div class='top'>Site <b>name</b></div>"
            f"<nav><ul><li>Home</ul></nav><div class=box>{body}</div><div>Call us today<script>1</script></div>"
            f"<footer>f</footer></body></html>")


def test_extract_text(spark):
    rows = [(k, f"http://a.example/{k}", page(k, f"<h1>Head {k}</h1><p>One &amp; <i>two</i>\n {k}<p>Three {k * 7}"))
            for k in range(8)]
    rows += [(20, None, "<p>alone<br>here"), (21, "http://a.example/x", None), (22, "no url", ""),
             (22, "no url", ""), (None, "http://b.example/", "<p>cut off <b>te"),
             (23, "http://b.example/", "<article><p>x" + " y" * 50_000 + "</article>")]
    got = htmltext.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")
                                .selectExpr("*", "1 AS _host", "2 AS _html", "3 AS text")).collect()
    text = {r.page_id: r.text for r in got}
    assert len(got) == len(rows)
    for k in range(8):
        assert text[k] == f"Head {k}\nOne & two {k}\nThree {k * 7}"
    assert (text[20], text[21], text[22], text[None]) == ("alone here", "", "", "cut off te")
    assert text[23] == "x" + " y" * 50_000
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert htmltext.extract_text(empty).count() == 0


def test_parts_of_an_article_stay():
    def text(body):
        return htmltext.main_text(htmltext.parse(f"<body><div class=related><p>More</div>{body}</body>"))
    long, short = "<article><p>" + "long " * 100 + "</article>", "<article><h2>Short</h2><p>one</article>"
    assert text(long + short) == ("long " * 100).strip() + "\nShort\none"
    assert text("<article><p>a<section id=discussion><h2>Discussion</h2><p>b</section><div class='related-work'><p>c</div>"
                "</article>") == "a\nDiscussion\nb\nc"
    assert text("<article><p>a<div class=related-posts><ul><li><a>x</a></ul></div><div class='discussion comments'><p>b</div>"
                "<div class=advert><p>c</div></article>") == "a"


def brute(rows, wanted, k=5):
    good = {i: np.array(v, float) for i, v in rows if i is not None and v is not None and None not in v
            and len(v) == 8 and np.isfinite(np.array(v, float)).all() and any(v)}
    out = {}
    for q in wanted:
        if q in good:
            score = {i: v @ good[q] / np.sqrt(v @ v) / np.sqrt(good[q] @ good[q]) for i, v in good.items() if i != q}
            out[q] = sorted(score.items(), key=lambda x: (-round(x[1], 12), x[0]))[:k]
    return out


def test_nearest(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(300)]
    rows += [(i, rows[7][1]) for i in range(300, 340)] + [(5, rows[5][1])]
    rows += [(400, None), (450, [0.0] * 8), (500, [1.0, None] + [1.0] * 6), (550, [float("nan")] * 8), (600, []),
             (650, [float("inf")] + [1.0] * 7), (None, rows[3][1]), (700, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS id", "2 AS score", "3 AS query")
    got = {}
    for r in neighbours.nearest(df, df.where("vec_id % 50 = 0")).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    expected = brute(rows, range(0, 701, 50))
    assert got.keys() == expected.keys()
    for q, best in expected.items():
        mine = sorted(got[q])
        assert [x[0] for x in mine] == [1, 2, 3, 4, 5]
        assert [x[1] for x in mine] == [i for i, _ in best]
        assert np.allclose([x[2] for x in mine], [s for _, s in best], rtol=0, atol=1e-12)
    assert neighbours.nearest(df.where("false"), df.where("false")).count() == 0


def test_recall(spark):
    rng = np.random.default_rng(2)
    centers = rng.normal(size=(40, 8))
    rows = [(i, (centers[i % 40] + 0.3 * rng.normal(size=8)).tolist()) for i in range(12_000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = neighbours.nearest(df, df.where("vec_id % 300 = 0")).collect()
    expected = brute(rows, range(0, 12_000, 300))
    hits = sum((r.vec_id in {i for i, _ in expected[r.query_id]}) for r in got)
    assert len(got) == 5 * len(expected) and hits >= 0.9 * len(got)

"""Spelling variants, lexical search and repeated passages against brute force."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from textmill.llm import lexical, spelling, suffixdedup


def same(got, expected):
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)


# 12 spelling variants

def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:p] + b[p + 1:] == a for p in range(len(b)))


def groups_by_brute_force(words, factor=2):
    out, form = [], {}
    for w, n in words.items():
        close = [(-m, v.encode(), v) for v, m in words.items() if near(w, v)]
        top = min(close) if close else None
        form[w] = top[2] if top and -top[0] >= factor * n else None
        out.append([w, n, len(close), form[w], -top[0] if form[w] else None, None])
    for row in out:
        row[5] = row[0]
        while form[row[5]]:
            row[5] = form[row[5]]
    return [tuple(r) for r in out]


@pytest.mark.parametrize("max_bucket", [4096, 2, 0])
def test_variant_groups(spark, max_bucket):
    r = random.Random(3)
    words = {"": 4, "a": 9, "aa": 2, "aaa": 70, "aaaa": 70, "aaaaa": 3, "éaaa": 30, "x" * 3000: 5, "x" * 3001: 11,
             "x" * 1500 + "y" + "x" * 1499: 2}
    for _ in range(60):
        base = "".join(r.choices("abcñ", k=r.randint(1, 9)))
        words[base] = r.choice([3, 10, 200])
        for _ in range(4):
            p = r.randrange(len(base) + 1)
            words[base[:p] + r.choice(["", "b", "ñ"]) + base[p + r.randint(0, 1):]] = r.choice([3, 3, 5, 20])
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    got = spelling.variant_groups(table, max_bucket=max_bucket).select("word", "n", "n_near", "form", "form_n", "root")
    same(got.collect(), groups_by_brute_force(words))


def test_count_words(spark, docs, texts, no_docs):
    count = Counter()
    for i, t, *_ in texts:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(c.lower() if c.isascii() else c for c in w)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 3 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            count[w] += 1
    expected = [(w, n) for w, n in count.items() if len(w) >= 4 and n >= 2]
    same(spelling.count_words(docs, min_chars=4, min_count=2, slip_every=3).collect(), expected)
    assert spelling.variant_groups(spelling.count_words(no_docs)).count() == 0
    with pytest.raises(ValueError):
        spelling.variant_groups(spelling.count_words(no_docs), factor=1)


# 13 ranked lexical search

def ranking_by_brute_force(texts, queries, k):
    def terms(t):
        return re.findall("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+",
                          "".join(c.lower() if c.isascii() else c for c in t or ""))
    docs = [(i, Counter(terms(t))) for i, t, *_ in texts if terms(t)]
    n_docs, n_terms = len(docs), sum(c.total() for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for name, q in queries:
        scored = []
        for i, c in docs:
            m = 100 - 50 + 50 * c.total() * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * (10 ** 9 * c[t] // (1000 * c[t] + 20 * m)) for t in set(terms(q)) if t in c)
            if score > 0:
                scored.append((-score, i is not None, i or 0, i))
        out += [(name, r, e[3], -e[0]) for r, e in enumerate(sorted(scored)[:k], 1)]
    return out


@pytest.mark.parametrize("sketch, block_queries, k", [(1024, 1000, 50), (4, 3, 5), (1, 1000, 2)])
def test_search(spark, docs, texts, sketch, block_queries, k):
    queries = [(0, "read more on our site"), (1, "SPAM! and, spam_more"), (2, None), (3, ""), (3, "é ñ don't 日本 😀 x"),
               (None, "Two words"), (5, "none-of-these-qqq"), (6, next(t for i, t, *_ in texts if i == 71)), (7, "\n \x00")]
    table = spark.createDataFrame(queries, "item_id long, text string")
    got = lexical.search(docs, table, k=k, sketch=sketch, block_queries=block_queries)
    same(got.collect(), ranking_by_brute_force(texts, queries, k))


def test_search_of_nothing(spark, docs, no_docs):
    table = spark.createDataFrame([(1, "words")], "item_id long, text string")
    assert lexical.search(no_docs, table).count() == 0
    empty = lexical.search(docs, table.where("false"))
    assert empty.count() == 0 and empty.columns == ["item_id", "rank", "doc_id", "score"]


# 11 suffix-array dedup

def cut_by_brute_force(texts, window):
    rows = [(i, (t or "").encode()) for i, t, *_ in texts]
    least = {}
    for i, b in rows:
        for s in range(len(b) - window + 1):
            key = (i is not None, i or 0, xxhash.xxh3_64_intdigest(b) - (1 << 63), s)
            w = b[s:s + window]
            least[w] = min(key, least.get(w, key))
    out = []
    for i, b in rows:
        own = (i is not None, i or 0, xxhash.xxh3_64_intdigest(b) - (1 << 63))
        gone = [False] * len(b)
        for s in range(len(b) - window + 1):
            if least[b[s:s + window]] < (*own, s):
                gone[s:s + window] = [True] * window
        spans = [m.span() for m in re.finditer("x+", "".join("x" if g else "." for g in gone))]
        out.append((i, len(b), sum(gone), spans, bytes(c for c, g in zip(b, gone) if not g)))
    return out


@pytest.mark.parametrize("options", [{}, {"hot_slices": 0}, {"hot_slices": 3, "block_bytes": 2000},
                                     {"block_bytes": 1, "segment_bytes": 1000}])
def test_suffix_dedup(spark, docs, texts, options):
    periodic = [(90, "ab" * 300, ""), (91, "ab" * 90, ""), (92, "a" * 500, ""), (92, "b" + "a" * 200 + "c", "")]
    more = spark.createDataFrame([(i, t, "en", s, 1, "x", 1, 2, 3, True, 4, 5) for i, t, s in periodic], docs.schema)
    # The long text would make brute force slow.
    short = [x for x in texts if len(x[1] or "") < 5000]
    got = suffixdedup.suffix_dedup(docs.where("text is null or length(text) < 5000").unionAll(more), window=40, **options)
    got = [(r[0], r[1], r[2], [tuple(s) for s in r[3]], bytes(r[4])) for r in got.collect()]
    same(got, cut_by_brute_force(short + periodic, 40))


def test_suffix_dedup_leaves_texts_in_place(spark, docs, capsys):
    """Codes and marks are sent to the texts; the texts themselves are not shuffled."""
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        got = suffixdedup.suffix_dedup(docs)
        got.explain()
        plan = capsys.readouterr().out
        assert plan.count("Exchange hashpartitioning(block") == 1 and "Bucketed: true" in plan
        assert got.count() == docs.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)


def test_suffix_dedup_keeps_columns(docs, no_docs):
    got = suffixdedup.suffix_dedup(docs, keep=["id", "row", "size", "text"])
    assert got.columns == ["id", "row", "size", "text", "n_bytes", "n_removed", "spans", "kept"]
    assert got.count() == docs.count()
    assert suffixdedup.suffix_dedup(no_docs).count() == 0
    with pytest.raises(ValueError):
        suffixdedup.suffix_dedup(docs, window=20)


@pytest.mark.parametrize("letters, n", [("ab", 400), ("abcdefgh\x00\xff", 3000)])
def test_deep_shallow(letters, n):
    r = random.Random(5)
    parts = ["".join(r.choices(letters, k=r.randint(1, 60))) for _ in range(12)]
    buf = "".join(r.choice(parts) for _ in range(n // 8)).encode("latin1")
    starts = np.array([r.randrange(len(buf) - 50) for _ in range(n)])
    group = np.array([r.randrange(3) for _ in range(n)])
    order, equal = suffixdedup.deep_shallow(buf + bytes(8), starts, group, 50)
    strings = [(group[i], buf[starts[i]:starts[i] + 50]) for i in order]
    assert sorted(order.tolist()) == list(range(n)) and strings == sorted(strings)
    assert equal.tolist() == [False] + [a == b for a, b in zip(strings, strings[1:])]

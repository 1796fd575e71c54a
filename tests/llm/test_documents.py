"""Operators on documents against brute force, libraries and invariants."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from textmill.llm import jaccard, licenses, linededup, packing, pieces, quality, sharding, tokencounts


def same(got, expected):
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)


def split_words(text):
    return [w.decode() for w in (text or "").encode().split()]


# 1 line dedup

def lines_by_brute_force(texts, least):
    def key(line):
        return line.encode().strip(b" \t\n\x0b\x0c\r").lower()
    count = Counter(k for _, t, *_ in texts for k in {key(x) for x in (t or "").split("\n")} if k)
    out = []
    for i, t, *_ in texts:
        lines = (t or "").split("\n")
        kept = [x for x in lines if count[key(x)] < least]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


@pytest.mark.parametrize("small_keys", [1000, 0])
def test_line_dedup(docs, texts, small_keys):
    got = linededup.line_dedup(docs, min_docs=6, bits=20, small_keys=small_keys)
    same(got.select("doc_id", "n_lines", "n_dropped", "kept").collect(), lines_by_brute_force(texts, 6))


# 2 n-gram Jaccard join

def groups_by_brute_force(texts):
    def of(t):
        w = split_words("".join(c.lower() if c.isascii() else c for c in t or ""))
        return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()
    sets = [of(t) for _, t, *_ in texts]
    group = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            x, y = sets[a], sets[b]
            if x and 100 * len(x & y) >= 75 * len(x | y) and group[a] != group[b]:
                old, new = group[a], group[b]
                group = [new if g == old else g for g in group]
    name = {}
    for g, (i, *_) in zip(group, texts):
        if i is not None:
            name[g] = min(i, name.get(g, i))
    return [(i, len(s), name.get(g)) for (i, *_), s, g in zip(texts, sets, group)]


def test_near_duplicates(docs, texts):
    expected = groups_by_brute_force(texts)
    assert len({c for i, _, c in expected if i in range(10, 30)}) < 10
    same(jaccard.near_duplicates(docs).select("doc_id", "n_shingles", "component_id").collect(), expected)


def test_keep_one_goes_by_text(spark):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(30)) for x in "abcd")
    rows = [(5, a, 1), (30, a, 2), (30, b, 3), (40, c, 4), (40, d, 5), (40, d, 5), (50, c + " end", 6), (None, d, 7), (None, "x y", 8),
            (60, "", 9), (60, "", 9), (70, None, 1), (80, a + "\n", 2), (90, " ".join(b.split()[:20]), 3), (5, a + "\n", 0), (40, d, 4)]
    got = jaccard.keep_one(spark.createDataFrame(rows, "doc_id long, text string, h int")).collect()
    got = sorted((str(r.doc_id), (r.text or "")[:2], r.h) for r in got)
    ends = [g for g in got if g[0] == "5"]
    assert len(ends) == 1 and ends[0][1] == "a0"
    assert [g for g in got if g[0] != "5"] == sorted(
        [("30", "b0", 3), ("40", "c0", 4), ("40", "d0", 4), ("60", "", 9), ("60", "", 9), ("70", "", 1), ("90", "b0", 3), ("None", "x ", 8)])


@pytest.mark.parametrize("sizes", [(40, 40), (20, 26), (7, 8)])
def test_signatures_never_exclude_a_link(sizes):
    rng = np.random.default_rng(3)
    for _ in range(200):
        both = int(rng.integers(0, min(sizes) + 1))
        pool = rng.choice(2 ** 62, sum(sizes), replace=False).astype(np.uint64)
        a, b = np.sort(pool[:sizes[0]]), np.sort(np.concatenate([pool[:both], pool[sizes[0]:][:sizes[1] - both]]))
        if 100 * both >= 75 * (len(a) + len(b) - both):
            assert jaccard.bitmaps_fit(jaccard.bitmap(a), len(a), jaccard.bitmap(b), len(b))


# 3 SentencePiece

@pytest.mark.parametrize("sent_units", [10 ** 6, 0])
def test_sentencepiece(docs, texts, sent_units):
    import sentencepiece
    path = public_tokenizers.path("piece_bpe_32k.model")
    reader = sentencepiece.SentencePieceProcessor(model_file=path)
    some = docs.where("doc_id IS NULL OR doc_id < 13 OR doc_id = 80")
    got = pieces.decode(pieces.encode(some, path, sent_units=sent_units), path, out="decoded").collect()
    expected = [(i, reader.encode(t or ""), (t or "").replace(pieces.MARK, " "))
                for i, t, *_ in texts if i is None or i < 13 or i == 80]
    same([(r.doc_id, list(r.ids), r.decoded) for r in got], expected)


def test_viterbi_takes_the_best_sum(spark):
    units = spark.createDataFrame([("abcd", 1), ("ax", 1)], "unit string, n long")
    table = spark.createDataFrame([("a", 1, -1.0), ("b", 2, -1.0), ("ab", 3, -1.5), ("bcd", 4, -0.2), ("cd", 5, -0.5)],
                                  "piece string, id int, score double")
    got = pieces.lattice(units, table, 3).select(
        "unit", pieces.viterbi_fold(F.col("size"), F.col("edges")).alias("b")).collect()
    same([(r.unit, r.b) for r in got], [("abcd", [0, 1, 4]), ("ax", [0, 1, 2])])


def test_merges_walk_each_unit_once(spark):
    from sentencepiece import SentencePieceProcessor
    path = public_tokenizers.path("piece_bpe_32k.model")
    reader, model = SentencePieceProcessor(model_file=path), pieces.Model(path)
    words = ["a", "the", "internationalization", *[("nationthering" * 9)[:n] for n in range(57, 64)],
             *["e" * n for n in (2, 3, 58, 59, 60, 61)]]
    units = spark.createDataFrame([(pieces.MARK + w, 1) for w in words], "unit string, n long")
    found = pieces.unit_ids(units, model)
    same([(r.unit, list(r.ids)) for r in found.collect()], [(pieces.MARK + w, reader.encode(w)) for w in words])
    # The best edge is sought once a step: the test of an edge stands once in the plan.
    assert found._jdf.queryExecution().optimizedPlan().toString().count("bit_count(") == 1


# 4 quality rules

def rules_by_brute_force(texts):
    out = []
    for i, t, host in texts:
        w = split_words(t)
        grams = [tuple(w[k:k + 5]) for k in range(len(w) - 4)]
        n = Counter(grams)
        repeated = {k + d for k, g in enumerate(grams) if n[g] > 1 for d in range(5)}
        lines = [x for x in (t or "").split("\n") if split_words(x)]
        out.append((i, host, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""),
                    len(lines) - len(set(lines)), len(repeated), len(w) < 10, 100 * len(repeated) > 20 * len(w)))
    hosts = {h: [x for x in out if x[1] == h] for _, _, h in texts if h is not None}
    bad = set()
    for rule in (7, 8):
        rates = [sum(x[rule] for x in v) / len(v) for v in hosts.values()]
        mean, var = float(np.mean(rates)), float(np.var(rates))
        strength = min(1e6, max(1, mean * (1 - mean) / var - 1)) if var > 0 else 1e6
        bad |= {h for h, v in hosts.items()
                if (sum(x[rule] for x in v) + mean * strength) / (len(v) + strength) > quality.MAX_HOST_RATE}
    return [(x[0], *x[2:7], x[7] or x[8], x[1] in bad, not (x[7] or x[8]) and x[1] not in bad) for x in out]


def test_quality_rules(docs, texts):
    expected = rules_by_brute_force(texts)
    assert (70, False) in {(x[0], x[-1]) for x in expected}  # a good text goes with its host
    same(quality.quality_rules(docs).collect(), expected)
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    same([(r.doc_id,) for r in kept.collect()], [(x[0],) for x in expected if x[-1]])


# 6 sharding

@pytest.mark.parametrize("shards", [1, 4, 16])
def test_sharding(docs, texts, shards):
    got = sharding.shard_by_bytes(docs.select("doc_id", "text"), shards=shards, keep=["doc_id", "text"]).collect()
    same([(r.doc_id, r.size, r.text_crc32) for r in got],
         [(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in texts])
    slots, bytes_of, shard_of = {}, Counter(), {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
        bytes_of[r.shard] += r.size
        assert 0 <= r.shard < shards and shard_of.setdefault(r.text or "", r.shard) == r.shard
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    groups = Counter()
    for _, t, *_ in texts:
        groups[t or ""] += len((t or "").encode()) + 1
    assert max(bytes_of.values()) < sum(groups.values()) / shards + 2 * max(groups.values())


def test_smallest_capacity_is_minimax():
    rng = np.random.default_rng(5)
    for _ in range(50):
        sizes = rng.integers(1, 30, 9).tolist()
        best = min(max(sum(p) for p in np.split(np.array(sizes), [a, b]) if len(p))
                   for a in range(1, 9) for b in range(a, 10))
        assert sharding.smallest_capacity(sizes, 3, 0) == best


# 7 license scans

def licenses_by_brute_force(texts):
    def cut(t):
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        return "".join(c if c in "abcdefghijklmnopqrstuvwxyz0123456789" else " " for c in lower).split()
    out = []
    for i, t, *_ in texts:
        w = cut(t)
        for name, body in licenses.TEMPLATES.items():
            x = cut(body)
            n, wanted = len(x), {tuple(x[k:k + 5]) for k in range(len(x) - 4)}
            found = [(len(wanted & {tuple(w[k:k + 5]) for k in range(a, min(a + 2 * n, len(w)) - 4)}), a)
                     for a in range(0, len(w), n)]
            found = [(f, a) for f, a in found if 100 * f >= 75 * len(wanted)]
            if found:
                out.append((i, name, max(f for f, _ in found), len(wanted), min(a for _, a in found)))
    return out


def test_license_scan(docs, texts):
    expected = licenses_by_brute_force(texts)
    assert {x[0] for x in expected} == {80, 81, 82}
    same(licenses.license_scan(docs).collect(), expected)
    assert licenses.license_scan(docs, templates={"short": "no words"}).count() == 0


def test_enough_bands():
    for n in (5, 8, 40, 200):
        s = n - 4
        m = licenses.needed(s)
        assert (1 - m / (s + 2 * n - 4 - m)) ** licenses.bands(n, s) <= licenses.MISS


# 9 token counts

@pytest.mark.parametrize("hot_tokens", [1000, 1])
def test_token_counts(docs, texts, hot_tokens):
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    expected = [(i, len((t or "").encode()), len(tok.encode(t or "", add_special_tokens=False).ids)) for i, t, *_ in texts]
    same(tokencounts.token_counts(docs, path, hot_tokens=hot_tokens).collect(), expected)


# 10 best-fit packing

def pieces_by_library(texts):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    out = []
    for i, t, *_ in texts:
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        out += [(i, a // 2048, a, len(ids[a:a + 2048]), zlib.crc32(ids[a:a + 2048].tobytes()))
                for a in range(0, len(ids), 2048)]
    return out


def check_sequences(rows, slack=1.02):
    ends = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= 2048
    assert len(ends) <= slack * -(-sum(r.length for r in rows) // 2048) + 1


def test_best_fit_packing(docs, texts):
    rows = packing.best_fit_packing(docs, public_tokenizers.path("word_bpe_49k.json")).collect()
    same([(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows], pieces_by_library(texts))
    check_sequences(rows)


def test_fullest_is_a_subset_sum():
    assert sum(packing.fullest(9, {9: 1, 5: 1, 4: 2, 2: 1}, 15)) == 15
    assert sum(packing.fullest(7, {7: 2, 3: 1}, 12)) == 10


# empty tables

def test_empty_tables(no_docs):
    byte, word, piece = map(public_tokenizers.path, ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))
    for out in (linededup.line_dedup(no_docs, bits=20), jaccard.near_duplicates(no_docs), pieces.encode(no_docs, piece),
                quality.quality_rules(no_docs), quality.keep_good(no_docs), sharding.shard_by_bytes(no_docs),
                licenses.license_scan(no_docs), tokencounts.token_counts(no_docs, byte),
                packing.best_fit_packing(no_docs, word)):
        assert out.count() == 0


# the pipeline

def test_pipeline(spark, docs, texts, tmp_path):
    import corpus_pipeline
    docs.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(str(tmp_path / "documents.parquet"))
    good = {(x[0]) for x in rules_by_brute_force(texts) if x[-1]}
    rows = [x for x in texts if x[0] in good]
    rows = [(i, t) for i, _, _, t in lines_by_brute_force(rows, 10)]
    groups = groups_by_brute_force(rows)
    kept = {i: t for (i, t), (_, _, c) in zip(rows, groups) if i is None or i == c}
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    same([(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got], pieces_by_library(list(kept.items())))
    check_sequences(got)


def test_hash_helpers_agree():
    a = jaccard.shingles("A b c d e f")
    assert jaccard.class_of(a) == jaccard.class_of(jaccard.shingles("a  B c d E\nf"))
    assert len(jaccard.shingles(None)) == len(jaccard.shingles(" \n")) == 0
    assert hashlib.sha256(a.tobytes()).digest() != hashlib.sha256(jaccard.shingles("a b c d e").tobytes()).digest()


def test_jaccard_searches_equal_buckets_once(spark, monkeypatch):
    """Three classes that share twenty routing shingles are one bucket of three rows, not twenty."""
    sets = {c: jaccard.shingles(" ".join(f"w{k}" for k in range(80)) + f" end{c}") for c in (1, 2, 3)}
    routed = spark.createDataFrame([(t, c, len(s), t + c, False) for c, s in sets.items() for t in range(20)],
                                   "token long, cls long, size int, place int, hot boolean")
    sketches = spark.createDataFrame([(c, jaccard.bitmap(s)) for c, s in sets.items()], "cls long, sig binary")
    none = spark.createDataFrame([], "node long, component long")
    sent, run = [], jaccard.in_batches
    monkeypatch.setattr(jaccard, "in_batches", lambda df, *rest: sent.append(df) or run(df, *rest))
    got = jaccard.tree_candidates(routed, sketches, none).collect()
    assert sorted(map(tuple, got)) == [(1, 2), (1, 3), (2, 3)]
    assert [(r.cls, r.place) for r in sent[0].orderBy("cls").collect()] == [(1, 1), (2, 2), (3, 3)]


def test_jaccard_reads_postings_once(docs, monkeypatch, capsys):
    """One pass over the texts serves frequent and other shingles; copies are dropped without a second shuffle."""
    stored, store = {}, jaccard.materialize
    monkeypatch.setattr(jaccard, "materialize", lambda df, name: stored.setdefault(name, df) and store(df, name))
    jaccard.near_duplicates(docs)
    capsys.readouterr()
    stored["routed"].explain()
    plan = capsys.readouterr().out
    assert plan.count("MapInArrow") == 1 and plan.count("Exchange hashpartitioning") == 1


def test_most_frequent(spark):
    from textmill.llm.common import most_frequent
    table = spark.range(1, 1001).withColumnRenamed("id", "n")
    for limit in (0, 1, 50, 1000, 5000):
        got = [r.n for r in most_frequent(table, "n", limit).collect()]
        assert len(got) <= limit and set(got) == set(range(1001 - len(got), 1001)) and len(got) >= min(1000, limit) * 0.8 - 60
    assert most_frequent(table.where("false"), "n", 5).count() == 0

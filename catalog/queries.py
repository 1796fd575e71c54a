"""The registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Doubles are rounded to six places, since two engines add in different orders. Arrays are
returned as joined strings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.data import KEYWORDS, LABELS, documents, labelled, normalized, sentences, table
from textmill.functions import keywords as K
from textmill.functions import text as X
from textmill.operators import corpus as C
from textmill.operators import evaluate as E
from textmill.operators import features as V
from textmill.operators import models as M
from textmill.operators import topics as T
from textmill.operators.annotate import annotation_prompts, parse_replies
from textmill.operators.corpus import KEY
from textmill.operators.ranking import rank_within
from textmill.operators.split import stratified_split
from textmill.plans.annotator import annotator_report
from textmill.plans.benchmark import benchmark_library, benchmark_ovr, ovr_rows
from textmill.plans.build import collect_corpus, extract_corpus, preprocess_corpus, preprocess_counted, sentences_per_label
from textmill.plans.runs import load_run, save_run
from textmill.plans.topics import topic_report
from textmill.runtime import materialize, scratch_path, small_table
from textmill.sources import readers as R
from textmill.sources import writers as Wr
from textmill.streaming.score import make_scorer, score_lines, score_stream

QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def joined(df: DataFrame, column: str, sep: str = "|") -> DataFrame:
    return df.withColumn(column, F.array_join(column, sep))


# --- column functions on other tables ---------------------------------------------

@query
def split_semicolons(spark, sf):
    pages = table(spark, sf, "pages", "page_id", "html")
    return pages.select("page_id", F.posexplode(X.split_semicolons("html")).alias("idx", "part"))


@query
def sigmoid(spark, sf):
    events = table(spark, sf, "events", "event_id", "value")
    return events.select("event_id", F.round(X.sigmoid(F.col("value") / 10), 6).alias("p"))


# --- corpus building ----------------------------------------------------------------

@query
def label_counts(spark: SparkSession, sf: str) -> DataFrame:
    return sentences_per_label(documents(spark, sf), KEYWORDS)


@query
def drop_missing_text(spark, sf):
    return C.drop_missing_text(table(spark, sf, "conversations")).select("conv_id", "turn", "text")


@query
def sentence_split(spark, sf):
    return sentences(spark, sf)


@query
def abbreviation_statistics(spark, sf):
    # Adding zero turns the zero of negative sign into the other one.
    return rounded(C.abbreviation_statistics(documents(spark, sf)), "score").withColumn("score", F.col("score") + 0.0)


@query
def sentence_split_abbreviations(spark, sf):
    """Sentences without cuts behind the corpus's own abbreviations (here: whatever its words suggest)."""
    docs = C.drop_missing_text(documents(spark, sf))
    return C.sentences(docs, abbreviations=C.abbreviations(docs))


@query
def keyword_mentions(spark, sf):
    return extract_corpus(documents(spark, sf), KEYWORDS)


@query
def strip_punctuation(spark, sf):
    return documents(spark, sf).select("doc_id", X.strip_punctuation(X.lowercase("text")).alias("clean"))


@query
def word_tokens(spark, sf):
    tokens = X.word_tokens(X.strip_punctuation(X.lowercase("text")))
    return documents(spark, sf).select("doc_id", F.array_join(tokens, "|").alias("tokens"))


@query
def alpha_tokens(spark, sf):
    tokens = X.alpha_tokens(X.word_tokens("text"))
    return documents(spark, sf).select("doc_id", F.array_join(tokens, "|").alias("tokens"))


@query
def remove_stop_words(spark, sf):
    tokens = X.remove_stop_words(X.terms_whitespace(X.lowercase("text")))
    return documents(spark, sf).select("doc_id", X.join_tokens(tokens).alias("tokens"))


@query
def normalize_text(spark, sf):
    return normalized(spark, sf).select(*KEY, "norm")


@query
def lemmatize(spark, sf):
    return preprocess_corpus(sentences(spark, sf).select(*KEY, "sentence"), lemmas=True).select(*KEY, "norm")


@query
def lemmatize_with_lexicon(spark, sf):
    """The lexicon is given: terms that occur in at least three rows."""
    rows = materialize(normalized(spark, sf).select(*KEY, "tokens"), "tokens")
    return C.lemmatize(rows, C.corpus_lexicon(rows, min_df=3)).select(*KEY, "norm")


@query
def match_keywords(spark, sf):
    return C.match_keywords(normalized(spark, sf), KEYWORDS)


def _with_own_map(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Normalised rows and a keyword map made from them: the 1000 most frequent terms,
    labelled by their first letter."""
    rows = materialize(normalized(spark, sf).select(*KEY, "tokens", "norm"), "norm")
    vocab = V.build_vocabulary(rows, "tokens", 1000)
    return rows, small_table(vocab.select(
        F.col("idx").cast("int").alias("pos"), F.col("term").alias("keyword"),
        F.substring("term", 1, 1).alias("label")))


@query
def match_keywords_large_map(spark, sf):
    return C.match_keywords(*_with_own_map(spark, sf))


@query
def assign_labels_large_map(spark, sf):
    return joined(C.assign_labels(*_with_own_map(spark, sf)).select(*KEY, "labels"), "labels")


def _pair_map(spark, sf) -> DataFrame:
    """A keyword map with case, digits and punctuation: pairs of neighbouring words of the
    benchmark texts as written there, labelled by their first letter."""
    pair = F.regexp_extract_all("text", F.lit(f"([{X.WORD_CHARS}]+[^{X.WORD_CHARS}]+[{X.WORD_CHARS}]+)"), 1)
    each = table(spark, sf, "benchmark").select("item_id", F.posexplode(pair).alias("at", "keyword"))
    return small_table(each.groupBy("keyword").agg(
        F.min(F.col("item_id") * 10_000 + F.col("at")).cast("int").alias("pos"),
        F.first(F.substring("keyword", 1, 1)).alias("label")).select("pos", "keyword", "label"))


@query
def match_keywords_raw_large_map(spark, sf):
    """Whole words of raw sentences against a map beyond the projection's limit."""
    return C.match_keywords(materialize(sentences(spark, sf), "sentences"), _pair_map(spark, sf), "sentence")


@query
def hide_own_keywords_raw_large_map(spark, sf):
    rows, kwmap = materialize(sentences(spark, sf), "sentences"), _pair_map(spark, sf)
    first = C.exclude_label(C.first_label(C.assign_labels(rows, kwmap, "sentence")))
    return C.hide_own_keywords(materialize(first.select(*KEY, "label", "sentence"), "first"), kwmap, "sentence")


@query
def keyword_mentions_large_map(spark, sf):
    """Sentences that mention a keyword as a substring, found through four-character parts."""
    return C.mentions_any(materialize(sentences(spark, sf), "sentences"), _pair_map(spark, sf))


@query
def assign_labels(spark, sf):
    return joined(C.assign_labels(normalized(spark, sf), KEYWORDS).select(*KEY, "labels"), "labels")


@query
def assign_labels_normalized_keywords(spark, sf):
    rows = C.assign_labels(normalized(spark, sf), KEYWORDS, normalized_keywords=True)
    return joined(rows.select(*KEY, "labels"), "labels")


@query
def whole_word_raw(spark, sf):
    """Whole-word matches in raw documents, where word boundaries are not only spaces."""
    return C.match_keywords(documents(spark, sf), KEYWORDS, text="text", key=["doc_id"])


@query
def first_label(spark, sf):
    return labelled(spark, sf).select(*KEY, "label")


@query
def flatten_labels(spark, sf):
    return C.flatten_labels(labelled(spark, sf)).select(*KEY, "labels_text")


@query
def corpus_counts(spark, sf):
    rows = C.normalize_text(sentences(spark, sf))
    return C.corpus_counts(documents(spark, sf), rows)


@query
def corpus_counts_observed(spark, sf):
    """The same counts, gathered while the rows are written: one pass."""
    return preprocess_counted(documents(spark, sf))[1]


@query
def label_distribution(spark, sf):
    return C.label_distribution(table(spark, sf, "documents", "lang").select(F.col("lang").alias("label")))


@query
def rare_classes(spark, sf):
    return C.rare_classes(labelled(spark, sf), min_count=20)


@query
def drop_rare_classes(spark, sf):
    return C.drop_rare_classes(labelled(spark, sf).select(*KEY, "label"), min_count=20)


@query
def merge_rare_into_other(spark, sf):
    return C.merge_rare_into_other(labelled(spark, sf).select(*KEY, "label"), min_count=20)


@query
def exclude_label(spark, sf):
    return C.exclude_label(labelled(spark, sf).select(*KEY, "label"))


@query
def keywords_per_label(spark, sf):
    return joined(C.keywords_per_label(_with_own_map(spark, sf)[1]), "keywords")


def _hits(spark, sf) -> DataFrame:
    """Search hits: documents that contain a keyword, ranked by id within the keyword."""
    found = F.array_compact(F.array(*[F.when(K.contains_keyword("text", k), F.lit(k)) for k in KEYWORDS]))
    pairs = materialize(documents(spark, sf).select("doc_id", F.explode(found).alias("keyword")), "hits")
    return rank_within(pairs, ["keyword"], F.floor(F.col("doc_id") / 1024), [F.col("doc_id")], "rank")


@query
def search_hits(spark, sf):
    return _hits(spark, sf).select("keyword", "rank", "doc_id")


@query
def cap_per_keyword(spark, sf):
    return C.cap_per_keyword(_hits(spark, sf).select("keyword", "rank", "doc_id"), 50)


@query
def labels_per_document(spark, sf):
    return joined(C.labels_per_document(_hits(spark, sf), KEYWORDS), "labels")


@query
def dedupe_documents(spark, sf):
    rows = documents(spark, sf).select(F.md5("text").alias("text_id"), "doc_id", F.length("text").alias("n_chars"))
    return C.dedupe_documents(rows, "text_id", ["doc_id"])


@query
def attach_doc_labels(spark, sf):
    labels = C.labels_per_document(_hits(spark, sf), KEYWORDS)
    return joined(C.attach_doc_labels(documents(spark, sf).select("doc_id"), labels), "labels")


@query
def collect_corpus_250(spark, sf):
    rows = collect_corpus(_hits(spark, sf), documents(spark, sf), KEYWORDS, order=["text"])
    return joined(rows, "labels")


@query
def hide_own_keywords(spark, sf):
    return C.hide_own_keywords(labelled(spark, sf).select(*KEY, "label", "norm"), KEYWORDS)


@query
def hide_own_keywords_large_map(spark, sf):
    """Labels and keywords from the data's own vocabulary: the join form."""
    rows, kwmap = _with_own_map(spark, sf)
    first = materialize(C.first_label(C.assign_labels(rows, kwmap)), "first")
    return C.hide_own_keywords(first, kwmap).select(*KEY, "label", "norm")


@query
def count_removed(spark, sf):
    return C.count_removed(labelled(spark, sf), KEYWORDS)


@query
def count_removed_large_map(spark, sf):
    rows, kwmap = _with_own_map(spark, sf)
    return C.count_removed(materialize(C.first_label(C.assign_labels(rows, kwmap)), "first"), kwmap)


@query
def hide_label_names(spark, sf):
    return sentences(spark, sf).select(*KEY, K.hide_label_names("sentence", LABELS).alias("hidden"))


@query
def align_by_index(spark, sf):
    rows = materialize(labelled(spark, sf).select(*KEY, "norm", "labels"), "rows")
    aligned = C.align_by_index(rows.select(*KEY, "norm"), rows.select(*KEY, "labels"), KEY)
    return C.first_label(aligned).select(*KEY, "norm", "label")


@query
def align_labels_table(spark, sf):
    return C.align_by_index(table(spark, sf, "documents", "doc_id", "lang"), table(spark, sf, "labels"),
                            ["doc_id"], strict=False)


@query
def unpaired_rows(spark, sf):
    return C.unpaired_rows(table(spark, sf, "documents", "doc_id", "lang"), table(spark, sf, "labels"), ["doc_id"])


# --- features -----------------------------------------------------------------------

@query
def term_frequency(spark, sf):
    return V.term_frequency(normalized(spark, sf))


@query
def document_frequency(spark, sf):
    return V.document_frequency(normalized(spark, sf))


@query
def build_vocabulary(spark, sf):
    return V.build_vocabulary(normalized(spark, sf))


@query
def vocabulary_all_terms(spark, sf):
    return V.build_vocabulary(normalized(spark, sf), max_features=None)


def _fitted(spark, sf, terms: str = "tokens") -> tuple[DataFrame, DataFrame]:
    words = F.col("tokens") if terms == "tokens" else X.terms_word2("norm").alias(terms)
    rows = materialize(normalized(spark, sf).select(*KEY, words), "terms")
    vocab = small_table(V.build_vocabulary(rows, terms, 1000), 1000)
    return rows, V.fit_idf(rows, vocab, terms)


@query
def idf(spark, sf):
    return rounded(_fitted(spark, sf)[1].select("term", "idx", "df", "idf"), "idf")


@query
def vocab_lookup(spark, sf):
    rows, vocab = _fitted(spark, sf)
    terms = rows.select(*KEY, F.explode("tokens").alias("term"))
    # A broadcast part of 100 terms makes the query take both the hot and the cold branch.
    return V.vocab_lookup(terms, vocab, hot_rows=100).groupBy("term", "idx").agg(F.count("*").alias("n"))


@query
def count_vectors(spark, sf):
    rows, vocab = _fitted(spark, sf)
    return V.count_vectors(rows, vocab)


@query
def count_vectors_all_terms(spark, sf):
    rows = materialize(normalized(spark, sf).select(*KEY, "tokens"), "terms")
    return V.count_vectors(rows, materialize(V.build_vocabulary(rows, max_features=None), "vocab"))


@query
def tfidf_all_terms(spark, sf):
    rows = materialize(normalized(spark, sf).select(*KEY, "tokens"), "terms")
    return rounded(V.tfidf_all_terms(rows, rows), "weight")


@query
def tfidf_terms(spark, sf):
    rows, vocab = _fitted(spark, sf)
    return rounded(V.tfidf(rows, vocab), "weight")


@query
def tfidf_word2(spark, sf):
    rows, vocab = _fitted(spark, sf, "words")
    return rounded(V.l2_normalize(V.tfidf(rows, vocab, "words", relative=False)), "weight")


@query
def l2_norm(spark, sf):
    rows, vocab = _fitted(spark, sf)
    return rounded(V.l2_normalize(V.tfidf(rows, vocab)), "weight")


@query
def tfidf_vectors(spark, sf):
    rows, vocab = _fitted(spark, sf)
    return rounded(V.to_long(V.transform(V.tfidf_model(vocab), rows)), "weight")


@query
def sparse_rows(spark, sf):
    rows, vocab = _fitted(spark, sf)
    packed = V.to_vectors(V.tfidf(rows, vocab), 1000)
    total = F.aggregate("values", F.lit(0.0), lambda a, v: a + v)
    return packed.select(*KEY, F.size("indices").alias("n"), F.array_max("indices").alias("last_idx"),
                         F.round(total, 6).alias("total"))


# --- models -------------------------------------------------------------------------

@query
def split_rows(spark, sf):
    rows = materialize(labelled(spark, sf).select(*KEY, "label"), "labelled")
    return stratified_split(C.exclude_label(C.drop_rare_classes(rows)))


def _run(spark, sf, epochs: int = 3):
    rows = materialize(labelled(spark, sf).select(*KEY, "label", "norm"), "labelled")
    return benchmark_ovr(rows, KEYWORDS, epochs=epochs)


@query
def ovr_gd_weights(spark, sf):
    return rounded(_run(spark, sf).model.weight_table(spark), "weight")


@query
def ovr_gd_bias(spark, sf):
    return rounded(_run(spark, sf).model.bias_table(spark), "bias")


@query
def loss_history(spark, sf):
    return rounded(_run(spark, sf).model.loss_history(spark), "loss")


@query
def ovr_gd_predict(spark, sf):
    return rounded(_run(spark, sf).predictions, "score")


def _scored(spark, sf) -> DataFrame:
    run = _run(spark, sf)
    stored = materialize(labelled(spark, sf).select(*KEY, "label", "norm"), "labelled")
    rows = ovr_rows(stored, KEYWORDS).select(*KEY, "label", "terms")
    ready = materialize(V.transform(run.features, rows).select(*KEY, "label", "features"), "ready")
    scored = M.score_join(V.to_long(ready), run.model.weight_table(spark), run.model.bias_table(spark), ready)
    return scored, ready


@query
def score_join(spark, sf):
    return rounded(_scored(spark, sf)[0], "score")


@query
def argmax_label(spark, sf):
    return rounded(M.argmax_label(_scored(spark, sf)[0]), "score")


@query
def loss_by_label(spark, sf):
    scored, ready = _scored(spark, sf)
    truth = ready.select(*KEY, F.col("label").alias("truth"))
    rows = scored.join(truth, KEY).select(
        "label", (F.col("label") == F.col("truth")).cast("int").alias("y"), F.col("score").alias("p"))
    return rounded(E.loss_by_label(rows), "loss")


@query
def ovr_report(spark, sf):
    return rounded(_run(spark, sf).metrics(), "precision", "recall", "f1")


@query
def model_roundtrip(spark, sf):
    """Save and reload feature pipeline and model, then score the test rows again."""
    run = _run(spark, sf)
    path = scratch_path(spark, "model")
    M.save_model(run.features, f"{path}/features")
    run.model.save(spark, f"{path}/ovr")
    features, model = M.load_model(f"{path}/features"), M.OvrModel.load(spark, f"{path}/ovr")
    stored = materialize(labelled(spark, sf).select(*KEY, "label", "norm"), "labelled")
    rows = ovr_rows(stored, KEYWORDS).select(*KEY, "label", "terms")
    again = M.predict_ovr(model, V.transform(features, rows))
    return again.select(*KEY, "label", "prediction")


@query
def run_roundtrip(spark, sf):
    """Save and reload a whole run, then score all rows with what the manifest names."""
    path = scratch_path(spark, "run")
    save_run(_run(spark, sf), path, KEYWORDS)
    again = load_run(spark, path)
    stored = materialize(labelled(spark, sf).select(*KEY, "label", "norm"), "labelled")
    rows = ovr_rows(stored, again.kwmap).select(*KEY, "label", "terms")
    return M.predict_ovr(again.model, V.transform(again.features, rows)).select(*KEY, "label", "prediction")


@query
def majority_baseline(spark, sf):
    rows = materialize(labelled(spark, sf).select(*KEY, "label"), "labelled")
    return M.predict_majority(M.train_majority(rows), rows)


def _lang_rows(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Documents with their language as label, vectorised: (train, test)."""
    docs = table(spark, sf, "documents", "doc_id", "lang", "text")
    rows = docs.select("doc_id", F.col("lang").alias("label"), X.terms_word2("text").alias("terms"))
    rows = materialize(stratified_split(rows, key=["doc_id"]), "lang")
    features, _ = V.tfidf_fit(rows.filter("split = 'train'"), "terms", 1000)
    ready = materialize(V.transform(features, rows).select("doc_id", "label", "split", "features"), "ready")
    return ready.filter("split = 'train'"), ready.filter("split = 'test'")


@query
def multinomial_lr(spark, sf):
    train, test = _lang_rows(spark, sf)
    return M.predict(M.train_multinomial(train, max_iter=50), test).select("doc_id", "label", "prediction")


@query
def ovr_lr(spark, sf):
    train, test = _lang_rows(spark, sf)
    return M.predict(M.train_ovr(train, max_iter=20), test).select("doc_id", "label", "prediction")


def _converged(df: DataFrame, tolerance: float = 1e-3) -> DataFrame:
    return df.select("label", "rows", (F.col("gradient") < tolerance).alias("optimal"))


@query
def multinomial_certificate(spark, sf):
    """Trained at full length, whether each class's gradient of the penalised loss vanishes."""
    train, _ = _lang_rows(spark, sf)
    n = train.count()
    return _converged(M.optimality(M.train_multinomial(train), train, penalty=1.0 / n))


@query
def ovr_certificate(spark, sf):
    train, _ = _lang_rows(spark, sf)
    return _converged(M.optimality(M.train_ovr(train), train))


@query
def library_certificate(spark, sf):
    """The library benchmark at its stated length."""
    rows = materialize(labelled(spark, sf).select(*KEY, "label", "norm"), "labelled")
    run = benchmark_library(rows)
    ready = materialize(run.train.select("label", "features"), "ready")
    return _converged(M.optimality(run.model, ready, penalty=1.0 / ready.count()))


@query
def predict_certificate(spark, sf):
    """Per true label, test rows, and those whose prediction is not the class of the largest margin."""
    train, test = _lang_rows(spark, sf)
    model = M.train_multinomial(train, max_iter=50)
    best = M.best_margin(model, M.predict(model, test))
    return best.groupBy("label").agg(F.count("*").alias("rows"), F.count_if(F.col("prediction") != F.col("best")).alias("wrong"))


@query
def ovr_gd_full_length(spark, sf):
    """The one-vs-rest benchmark at its 1000 epochs, interrupted at 400 and resumed from its stored state."""
    rows = materialize(labelled(spark, sf).select(*KEY, "label", "norm"), "labelled")
    state = scratch_path(spark, "state")
    benchmark_ovr(rows, KEYWORDS, epochs=400, state_path=state)
    run = benchmark_ovr(rows, KEYWORDS, epochs=1000, state_path=state)
    tested = run.predictions.agg(F.count("*").alias("n_test"), F.avg((F.col("label") == F.col("prediction")).cast("double")).alias("a"))
    top = run.predictions.groupBy("label").count().agg(F.max("count").alias("top"))
    losses = run.model.loss_history(spark).groupBy("label").agg(
        F.max(F.when(F.col("epoch") == 100, F.col("loss"))).alias("early"), F.max(F.when(F.col("epoch") == 1000, F.col("loss"))).alias("late"))
    falls = losses.agg(F.bool_and(F.col("late") < F.col("early")).alias("loss_falls"), F.count("*").alias("n_labels"))
    return tested.join(top).join(falls).select("n_test", "n_labels", (F.col("a") * F.col("n_test") >= F.col("top")).alias("beats_majority"), "loss_falls")


@query
def topics(spark, sf):
    return rounded(topic_report(normalized(spark, sf), n=10)[1], "weight")


def _topic_rows(spark, sf) -> DataFrame:
    return materialize(normalized(spark, sf).select(X.terms_word2("norm").alias("terms")), "topics")


@query
def topics_all_terms(spark, sf):
    """Topics held as a table, over every term of the corpus."""
    return rounded(T.topics_of(_topic_rows(spark, sf))[1], "weight")


def _one_update(spark, sf, k: int = 4) -> tuple[DataFrame, DataFrame]:
    rows = _topic_rows(spark, sf)
    vocab = materialize(V.build_vocabulary(rows, "terms", None), "vocab")
    start = materialize(T.start_topics(vocab, k, 42), "start")
    new = T.update_topics(T.term_blocks(rows, vocab), start, k, 1.0 / k, 1.0 / k, steps=1)
    return materialize(new, "new"), vocab


@query
def topic_update(spark, sf):
    """The topics after one update with one variational step in each row."""
    new, vocab = _one_update(spark, sf)
    return rounded(new.join(vocab, "idx").select("term", F.posexplode("weights").alias("topic", "weight")), "weight")


@query
def topic_top_words(spark, sf):
    """The 20 heaviest terms of each topic, trained at full length over every term of the corpus."""
    return rounded(T.topics_of(_topic_rows(spark, sf), n=20)[1], "weight")


@query
def library_benchmark(spark, sf):
    """Trained at full length, as `library_certificate` certifies it."""
    rows = materialize(labelled(spark, sf).select(*KEY, "label", "norm"), "labelled")
    return rounded(benchmark_library(rows).report(), "precision", "recall", "f1")


# --- evaluation ---------------------------------------------------------------------

def _substring_label() -> Column:
    found = [F.when(K.contains_keyword("sentence", k), F.lit(label)) for k, label in KEYWORDS.items()]
    return F.coalesce(*found, F.lit(K.OTHER))


def _predicted(spark, sf) -> DataFrame:
    """Truth: whole-word label of the normalised sentence. Prediction: first keyword that the
    raw sentence contains as a substring."""
    return labelled(spark, sf).select(*KEY, "label", _substring_label().alias("prediction"))


@query
def accuracy(spark, sf):
    return rounded(E.accuracy(_predicted(spark, sf)), "accuracy")


@query
def confusion_matrix(spark, sf):
    return E.confusion_matrix(_predicted(spark, sf))


@query
def confusion_wide(spark, sf):
    return E.confusion_wide(_predicted(spark, sf), sorted([*LABELS, K.OTHER]))


@query
def per_label_metrics(spark, sf):
    return rounded(E.per_label_metrics(_predicted(spark, sf)), "precision", "recall", "f1")


@query
def metrics_table(spark, sf):
    return E.metrics_table(_predicted(spark, sf))


@query
def classification_report(spark, sf):
    return rounded(E.classification_report(_predicted(spark, sf)), "precision", "recall", "f1")


@query
def metrics_excluding_other(spark, sf):
    return rounded(E.metrics_excluding(_predicted(spark, sf)), "precision", "recall", "f1")


@query
def compare_models(spark, sf):
    rows = materialize(_predicted(spark, sf), "predicted")
    majority = M.predict_majority(M.train_majority(rows), rows.drop("prediction"))
    return rounded(E.compare_models({"substring": rows, "majority": majority}), "precision", "recall", "f1")


@query
def compare_annotators(spark, sf):
    rows = table(spark, sf, "labels")
    named = [F.when(F.col(c) == 1, "yes").otherwise("no").alias("label") for c in ("quality", "toxic")]
    pairs = E.compare_annotators(rows.select("doc_id", named[0]), rows.select("doc_id", named[1]), ["doc_id"])
    return rounded(E.classification_report(pairs), "precision", "recall", "f1")


# --- annotator ----------------------------------------------------------------------

@query
def batch_rows(spark, sf):
    rows = C.batch_rows(sentences(spark, sf), 10)
    return joined(rows, "items")


@query
def prompts(spark, sf):
    rows = table(spark, sf, "conversations", "conv_id", "turn", "text")
    return annotation_prompts(rows, KEYWORDS, 10, "conv_id", "turn", "text")


@query
def parse_annotations(spark, sf):
    replies = table(spark, sf, "conversations", "conv_id", "turn", "text")
    return joined(parse_replies(replies, ["conv_id", "turn"], "text"), "labels")


@query
def annotator_comparison(spark, sf):
    """An annotator that goes by substrings replies in batches of ten sentences."""
    rows = materialize(_predicted(spark, sf), "predicted")
    batches = C.batch_rows(rows, 10, item="prediction")
    replies = batches.select("doc_id", "batch", F.array_join("items", "\n").alias("reply"))
    report = annotator_report(rows.select(*KEY, "label"), replies)
    return rounded(report, "precision", "recall", "f1")


# --- sources, sinks and scoring -----------------------------------------------------

@query
def records_roundtrip(spark, sf):
    labels = C.labels_per_document(_hits(spark, sf), KEYWORDS)
    rows = C.attach_doc_labels(documents(spark, sf), labels)
    path = scratch_path(spark, "records")
    Wr.write_abstracts(rows, path)
    return joined(R.read_documents(spark, path, "jsonl"), "labels")


@query
def corpus_json_roundtrip(spark, sf):
    path = scratch_path(spark, "corpus")
    Wr.write_corpus(normalized(spark, sf).select(*KEY, "norm"), path, "json")
    return spark.read.schema("doc_id long, sent_idx int, norm string").json(path)


@query
def corpus_text_roundtrip(spark, sf):
    path = scratch_path(spark, "corpus")
    Wr.write_corpus(sentences(spark, sf), path, "txt")
    return R.read_lines(spark, path)


@query
def lines_source(spark, sf):
    path = scratch_path(spark, "lines")
    table(spark, sf, "conversations", "text").write.text(path)
    return R.read_lines(spark, path)


def _item_file() -> Column:
    return F.regexp_extract("file", r"item_id=(\d+)", 1).cast("long").alias("item_id")


@query
def string_array_source(spark, sf):
    """One JSON array file per benchmark item, holding its sentences."""
    path = scratch_path(spark, "arrays")
    items = table(spark, sf, "benchmark")
    items.select("item_id", F.to_json(X.split_sentences("text")).alias("value")).write.partitionBy("item_id").text(path)
    return R.read_string_array(spark, f"{path}/*").select(_item_file(), "idx", "value")


@query
def string_array_one_file(spark, sf):
    """One JSON array in one file, holding every turn of every conversation."""
    path = scratch_path(spark, "array")
    turns = table(spark, sf, "conversations", "conv_id", "turn", "text")
    ends = turns.agg(F.min(F.struct("conv_id", "turn")).alias("first"), F.max(F.struct("conv_id", "turn")).alias("last"))
    here = F.struct("conv_id", "turn")
    # The file must be written by one task; it is read by many.
    line = F.concat(F.when(here == F.col("first"), "[").otherwise(""), F.substring(F.to_json(F.array("text")), 2, 1 << 30))
    line = F.concat(F.regexp_replace(line, r"\]$", ""), F.when(here == F.col("last"), "]").otherwise(","))
    (turns.join(F.broadcast(ends)).select("conv_id", "turn", line.alias("value"))
     .repartition(1).sortWithinPartitions("conv_id", "turn").select("value").write.text(path))
    return R.read_string_array(spark, path).select("idx", "value")


@query
def label_array_source(spark, sf):
    """One JSON array file per benchmark item, holding the word list of each sentence."""
    path = scratch_path(spark, "arrays")
    lists = F.transform(X.split_sentences("text"), X.terms_word2)
    items = table(spark, sf, "benchmark")
    items.select("item_id", F.to_json(lists).alias("value")).write.partitionBy("item_id").text(path)
    return joined(R.read_label_array(spark, f"{path}/*").select(_item_file(), "idx", "labels"), "labels")


@query
def keyword_map_source(spark, sf):
    path = scratch_path(spark, "map")
    pairs = F.array_sort(F.collect_list(F.struct("pos", "keyword", "label")))
    entries = F.map_from_entries(F.transform(pairs, lambda e: F.struct(e["keyword"], e["label"])))
    _with_own_map(spark, sf)[1].agg(F.to_json(entries).alias("value")).write.text(path)
    return R.read_keyword_map(spark, path)


@query
def xml_source(spark, sf):
    path = scratch_path(spark, "xml")
    node = lambda c: F.struct(c.alias("_VALUE"), F.lit("1").alias("_Version"))
    section = F.transform(F.split("text", "\n"), lambda s: F.struct(s.alias("_VALUE"), F.lit("BODY").alias("_Label")))
    article = F.struct(F.struct(section.alias("AbstractText")).alias("Abstract")).alias("Article")
    cited = F.struct(node(F.col("doc_id").cast("string")).alias("PMID"), article).alias("MedlineCitation")
    documents(spark, sf).select(cited).write.format("xml").option("rowTag", "PubmedArticle").option(
        "rootTag", "PubmedArticleSet").save(path)
    return R.read_article_xml(spark, path)


@query
def metrics_roundtrip(spark, sf):
    path = scratch_path(spark, "metrics")
    Wr.write_metrics(per_label_metrics(spark, sf), path)
    return spark.read.schema("label string, precision double, recall double, f1 double, support long").json(path)


def _scorer(spark, sf):
    """A model over all labelled rows: words of two letters and more, three epochs."""
    stored = materialize(labelled(spark, sf).select(*KEY, "label", "norm"), "labelled")
    rows = ovr_rows(stored, KEYWORDS).select(*KEY, "label", X.terms_word2("norm").alias("terms"))
    features, _ = V.tfidf_fit(rows, "terms", 1000)
    model = M.train_ovr_gd(V.transform(features, rows), len(features.stages[0].vocabulary), epochs=3)
    return make_scorer(features, model, LABELS)


@query
def score_batch(spark, sf):
    path = scratch_path(spark, "lines")
    table(spark, sf, "conversations", "text").write.text(path)
    return score_lines(spark.read.text(path), _scorer(spark, sf)).select("value", "prediction")


@query
def stream_scoring(spark, sf):
    """The same lines as `score_batch`, read and scored as a stream."""
    base = scratch_path(spark, "stream")
    table(spark, sf, "conversations", "text").write.text(f"{base}/in")
    run = score_stream(spark, f"{base}/in", f"{base}/out", f"{base}/state", _scorer(spark, sf))
    run.awaitTermination()
    return spark.read.schema("value string, prediction string, score double").parquet(f"{base}/out").select(
        "value", "prediction")

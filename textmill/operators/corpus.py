"""Operators on documents, sentences, keywords and labels.

Documents are keyed by `doc_id`, sentences by `(doc_id, sent_idx)`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.functions import keywords as K
from textmill.functions import text as X
from textmill.operators import lookup as L
from textmill.operators.ranking import rank_within, top_per_group
from textmill.runtime import materialize, small_table
from textmill.schemas import KEYWORD_MAP

KEY = ["doc_id", "sent_idx"]
# Up to this many keywords are compiled into the projection; a larger map is joined.
LITERAL_KEYWORDS = 500
# A lemma table of at most this many rows (some 20 bytes each) is looked up inside the rows.
LEMMA_ROWS = 500_000

KeywordMap = dict[str, str] | DataFrame


# --- keyword maps -------------------------------------------------------------------

def keyword_frame(spark: SparkSession, kwmap: KeywordMap) -> DataFrame:
    """The map as a table (pos, keyword, label)."""
    if isinstance(kwmap, DataFrame):
        return kwmap
    rows = [(pos, k, v) for pos, (k, v) in enumerate(kwmap.items())]
    return spark.createDataFrame(rows, KEYWORD_MAP)


def keyword_pairs(kwmap: KeywordMap, limit: int = LITERAL_KEYWORDS) -> list[tuple[str, str]] | None:
    """Ordered (keyword, label) pairs, or None if there are more than `limit`."""
    if isinstance(kwmap, DataFrame):
        rows = kwmap.select("pos", "keyword", "label").limit(limit + 1).collect()
        pairs = [(r.keyword, r.label) for r in sorted(rows, key=lambda r: r.pos)]
    else:
        pairs = list(kwmap.items())
    return pairs if len(pairs) <= limit else None


def normalize_keywords(spark: SparkSession, kwmap: KeywordMap) -> DataFrame:
    """Pass the keywords through the text normaliser, so that ones with punctuation,
    digits or stop words can match normalised text."""
    norm = X.join_tokens(X.normal_tokens("keyword"))
    return keyword_frame(spark, kwmap).withColumn("keyword", norm).filter("keyword <> ''")


def keywords_per_label(kwmap: DataFrame) -> DataFrame:
    """Invert the map: (label, keywords in map order)."""
    ordered = F.array_sort(F.collect_list(F.struct("pos", "keyword")))
    return kwmap.groupBy("label").agg(F.transform(ordered, lambda e: e["keyword"]).alias("keywords"))


# --- documents ----------------------------------------------------------------------

def drop_missing_text(df: DataFrame, text: str = "text") -> DataFrame:
    """Drop rows whose text is NULL or empty (pushed to the scan)."""
    return df.filter(F.col(text) != "")


def cap_per_keyword(hits: DataFrame, n: int = 250) -> DataFrame:
    """At most `n` documents per keyword, in search order."""
    return top_per_group(hits, ["keyword"], [F.col("rank"), F.col("doc_id")], n)


def labels_per_document(hits: DataFrame, kwmap: KeywordMap) -> DataFrame:
    """(doc_id, labels): the distinct labels of each document's hits, in map order."""
    table = small_table(keyword_frame(hits.sparkSession, kwmap))
    first = hits.join(table, "keyword").groupBy("doc_id", "label").agg(F.min("pos").alias("pos"))
    ordered = F.array_sort(F.collect_list(F.struct("pos", "label")))
    return first.groupBy("doc_id").agg(F.transform(ordered, lambda e: e["label"]).alias("labels"))


def dedupe_documents(df: DataFrame, key: str = "doc_id", order: list[str] | None = None) -> DataFrame:
    """The first row of each id by `order`, ties by the other columns. Copies are combined
    before the shuffle, so an id with very many copies costs no task more than any other."""
    first = order or []
    rest = [*first, *[c for c in df.columns if c != key and c not in first]]
    kept = df.groupBy(key).agg(F.min(F.struct(*rest)).alias("_row"))
    return kept.select(key, "_row.*").select(*df.columns)


def attach_doc_labels(docs: DataFrame, doc_labels: DataFrame) -> DataFrame:
    """Left join of the label lists; documents without one get an empty list."""
    empty = F.array().cast("array<string>")
    return docs.join(doc_labels, "doc_id", "left").withColumn("labels", F.coalesce("labels", empty))


# --- sentences ----------------------------------------------------------------------

def sentences(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
              abbreviations: list[str] | None = None) -> DataFrame:
    """One row per sentence, keyed by its position in the document."""
    return df.select(*keep, F.posexplode(X.split_sentences(text, abbreviations)).alias("sent_idx", "sentence"))


def abbreviation_statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """(word, with_stop, without, score): how strongly a word attracts the full stop behind it.

    The score is the log-likelihood ratio of "a stop nearly always follows" against "as often as behind any
    word", scaled down for long words and for occurrences without a stop, and up for stops inside (T. Kiss and J. Strunk,
    Unsupervised Multilingual Sentence Boundary Detection, 2006). One aggregate by word; the totals are one row.
    """
    each = df.select(F.explode(X.stopped_words(text)).alias("w")).select("w.word", "w.stop")
    words = materialize(each.groupBy("word").agg(
        F.count_if("stop").alias("with_stop"), F.count_if(~F.col("stop")).alias("without")), "words")
    total = words.agg(F.sum("with_stop").alias("k"), F.sum(F.col("with_stop") + F.col("without")).alias("n")).first()
    if not total["k"] or total["k"] == total["n"]:
        return words.withColumn("score", F.lit(0.0))
    base = total["k"] / total["n"]

    def likelihood(p: float) -> Column:
        return F.col("with_stop") * F.log(F.lit(p)) + F.col("without") * F.log(F.lit(1 - p))
    size = F.length(F.translate("word", ".", "")).cast("double")
    inner = F.length("word") - size + 1
    ratio = 2 * (likelihood(0.99) - likelihood(base))
    return words.withColumn("score", ratio * F.exp(-size) * inner * F.pow(size, -F.col("without").cast("double")))


def abbreviations(df: DataFrame, text: str = "text", least: float = 0.3, limit: int = 10_000) -> list[str]:
    """The words that score at least `least`, for `sentences`; more than `limit` are refused."""
    found = abbreviation_statistics(df, text).where(F.col("score") >= least).select("word").limit(limit + 1).collect()
    if len(found) > limit:
        raise ValueError(f"more than {limit} abbreviations")
    return sorted(r.word for r in found)


def mentions_any(df: DataFrame, kwmap: KeywordMap | list[str], text: str = "sentence") -> DataFrame:
    """Keep rows that contain a keyword as a case-blind substring.

    A map beyond `LITERAL_KEYWORDS` is searched through an index on the rarest four characters of
    each keyword; only keywords that share them with a row are tested there. The
    rows are then read twice: pass a stored table, not a long plan.
    """
    if isinstance(kwmap, list):
        kwmap = {k: "" for k in kwmap}
    pairs = keyword_pairs(kwmap)
    if pairs is not None:
        return df.filter(K.contains_any(text, [k for k, _ in pairs]))
    words = keyword_frame(df.sparkSession, kwmap).select(F.lower("keyword").alias("_word")).distinct()
    # A keyword shorter than the grams goes by itself.
    sizes = sorted(r[0] for r in words.select(F.least(F.length("_word"), F.lit(L.GRAM))).distinct().collect())
    if sizes and sizes[0] == 0:  # the empty keyword is in every text
        return df.filter(F.col(text).isNotNull())

    def parts(of: Column) -> Column:
        each = [F.when(F.length(of) == n, F.array(of)).otherwise(L.grams(of, n)) for n in sizes]
        return F.flatten(F.array(*each))
    own = F.when(F.length("_word") < L.GRAM, F.array("_word")).otherwise(L.grams("_word", L.GRAM))
    index = L.rarest_part(words, own, ["_word"])
    lowered = F.lower(F.col(text))
    found = L.with_candidates(df, text, parts(lowered), index, "inner")
    return found.filter(F.exists("_found", lambda f: lowered.contains(f["_word"]))).select(*df.columns)


def normalize_text(df: DataFrame, text: str = "sentence", stop: list[str] | None = None) -> DataFrame:
    """Add `tokens` and `norm`, the normalised text without lemmas."""
    out = df.withColumn("tokens", X.normal_tokens(text, stop))
    return out.withColumn("norm", X.join_tokens("tokens"))


def drop_empty_norm(df: DataFrame) -> DataFrame:
    return df.filter(F.size("tokens") > 0)


def normalize_nonempty(df: DataFrame, text: str = "sentence", stop: list[str] | None = None) -> DataFrame:
    """`normalize_text` and `drop_empty_norm` in one step.

    A filter on `tokens` would be pushed below the projection and normalise every row
    twice; exploding an array of one token list, or none, does the work once.
    """
    lists = F.filter(F.array(X.normal_tokens(text, stop)), lambda t: F.size(t) > 0)
    return df.select(*df.columns, F.explode(lists).alias("tokens")).withColumn("norm", X.join_tokens("tokens"))


def corpus_lexicon(df: DataFrame, min_df: int = 2, tokens: str = "tokens") -> DataFrame:
    """Terms that occur in at least `min_df` rows: the default lexicon for lemmas."""
    each = df.select(F.explode(F.array_distinct(tokens)).alias("term"))
    return each.groupBy("term").count().filter(F.col("count") >= min_df).select("term")


def _may_change(term: Column) -> Column:
    # Every suffix rule's ending ends in one of these two.
    return term.endswith("s") | term.endswith("men")


def lemma_table(terms: DataFrame, lexicon: DataFrame) -> DataFrame:
    """(term, lemma) for the distinct `terms` whose shortest form in the lexicon is another word."""
    forms = terms.filter(_may_change(F.col("term"))).select(
        "term", F.explode(X.lemma_candidates("term")).alias("form"))
    known = forms.join(lexicon.select(F.col("term").alias("form")), "form", "left_semi")
    best = known.groupBy("term").agg(F.min(F.struct(F.length("form"), "form"))["form"].alias("lemma"))
    return best.filter(F.col("lemma") != F.col("term"))


def _replaced(sent):
    """Arrow batches with the terms of `tokens` replaced by a table of two columns."""
    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        table = sent.value
        terms, lemmas = (table.column(c).combine_chunks() for c in ("term", "lemma"))
        for batch in batches:
            at = batch.schema.get_field_index("tokens")
            lists = batch.column(at)
            flat = lists.flatten()
            found = lemmas.take(pc.index_in(flat, value_set=terms))
            ends = pa.concat_arrays([pa.array([0], pa.int32()), pc.cumulative_sum(pc.fill_null(lists.value_lengths(), 0))])
            tokens = pa.ListArray.from_arrays(ends, pc.coalesce(found, flat), mask=lists.is_null())
            yield batch.set_column(at, batch.schema.field(at).name, tokens)
    return run


def apply_lemmas(df: DataFrame, lemmas: DataFrame, key: list[str] = KEY) -> DataFrame:
    """Replace tokens by their lemma and rebuild `norm`.

    A table of at most `LEMMA_ROWS` rows is sent to the executors and looked up inside each row, without a shuffle.
    For a larger one, the tokens that some suffix rule may change leave their row; the
    changed positions return to it as one small map per key.
    """
    local = lemmas.select("term", "lemma").limit(LEMMA_ROWS + 1).toArrow()
    if local.num_rows <= LEMMA_ROWS:
        sent = df.sparkSession.sparkContext.broadcast(local)
        return df.mapInArrow(_replaced(sent), df.schema).withColumn("norm", X.join_tokens("tokens"))
    open_tokens = df.select(*key, F.posexplode("tokens").alias("at", "term")).filter(_may_change(F.col("term")))
    patches = (
        open_tokens.join(lemmas, "term").groupBy(*key)
        .agg(F.map_from_entries(F.collect_list(F.struct("at", "lemma"))).alias("_patch"))
    )
    changed = F.transform("tokens", lambda t, i: F.coalesce(F.element_at("_patch", i), t))
    tokens = F.when(F.col("_patch").isNull(), F.col("tokens")).otherwise(changed)
    return (
        df.join(patches, key, "left")
        .withColumn("tokens", tokens).withColumn("norm", X.join_tokens("tokens")).drop("_patch")
    )


def lemmatize(df: DataFrame, lexicon: DataFrame | None = None, key: list[str] = KEY) -> DataFrame:
    """Replace tokens by their noun lemma; lemmas are found once per distinct term.

    Without a lexicon, the terms found in at least two rows serve. `df` is read more than
    once: pass a stored table, not a long plan.
    """
    each = df.select(F.explode(F.array_distinct("tokens")).alias("term"))
    if lexicon is None:
        stats = materialize(each.groupBy("term").agg(F.count("*").alias("df")), "terms")
        terms, lexicon = stats, stats.filter(F.col("df") >= 2)
    else:
        terms = each.filter(_may_change(F.col("term"))).distinct()
    return apply_lemmas(df, materialize(lemma_table(terms, lexicon), "lemmas"), key)


# --- labels -------------------------------------------------------------------------

def match_keywords(df: DataFrame, kwmap: KeywordMap, text: str = "norm", key: list[str] = KEY) -> DataFrame:
    """Long form (key, pos, keyword, label): one row per keyword found as a whole word.

    A map of any size gives the same rows. Up to `LITERAL_KEYWORDS` keywords are compiled into the
    projection; a larger map is looked up by word (see `_with_keywords`).
    """
    pairs = keyword_pairs(kwmap)
    if pairs is None:
        found = _with_keywords(df, keyword_frame(df.sparkSession, kwmap), text, "inner")
        hits = found.select(*key, F.explode(_whole_words(text)).alias("_hit"))
        return hits.select(*key, "_hit.pos", "_hit.keyword", "_hit.label")
    found = [
        F.when(K.has_keyword(text, k, F.col("_folded")), F.struct(F.lit(pos).alias("pos"), F.lit(k).alias("keyword"),
                                                F.lit(label).alias("label")))
        for pos, (k, label) in enumerate(pairs)
    ]
    folded = df.withColumn("_folded", K.fold_case(text))
    return folded.select(*key, F.explode(F.array_compact(F.array(*found))).alias("_hit")).select(*key, "_hit.*")


def _with_keywords(df: DataFrame, kwmap: DataFrame, text: str, how: str = "left") -> DataFrame:
    """Add `_found`: the keywords (pos, keyword, label, pattern, hay, plain) that the text may hold, in map order.

    Where a keyword is a whole word in a text, each run of word characters in it is one of the text;
    a keyword without such a run is one of the runs between words. The index
    goes by the run that the fewest keywords have. `df` is read twice: pass a stored table.
    """
    # With an empty keyword the smaller maps fail, too.
    word = F.when(F.col("keyword") == "", F.raise_error(F.lit("a keyword must not be empty")).cast("string")
                  ).otherwise(F.col("keyword"))
    table = kwmap.select("pos", word.alias("keyword"), "label").withColumns(
        {"pattern": K.pattern_column("keyword"), "hay": K.fold_token("keyword"),
         "plain": F.col("keyword").rlike("^[A-Za-z0-9_]+$")})
    gaps = bool(table.where(~F.col("keyword").rlike(f"[{X.WORD_CHARS}]")).limit(1).count())

    def runs(of: str) -> Column:
        return F.transform(L.word_runs(of, gaps), K.fold_token)
    words = F.transform(L.word_runs("keyword"), K.fold_token)
    index = L.rarest_part(table, F.when(F.size(words) > 0, words).otherwise(runs("keyword")), ["pos"])
    return L.with_candidates(df, text, runs(text), index, how).withColumn("_found", F.sort_array("_found"))


def _whole_words(text: str) -> Column:
    """Those of `_found` that are whole words of the text. A plain keyword, a single run of ASCII word characters, was
    found as a whole run of the text already; for any other the pattern decides."""
    folded = K.fold_token(text)
    return X.bind(folded, lambda hay: F.filter(
        "_found", lambda f: hay.contains(f["hay"]) & (f["plain"] | F.rlike(text, f["pattern"]))))


def assign_labels(
    df: DataFrame, kwmap: KeywordMap, text: str = "norm", other: str = K.OTHER, key: list[str] = KEY,
    normalized_keywords: bool = False,
) -> DataFrame:
    """Add `labels`: the labels of all keywords found, in map order; `[other]` if none."""
    if normalized_keywords:
        kwmap = normalize_keywords(df.sparkSession, kwmap)
    pairs = keyword_pairs(kwmap)
    if pairs is not None:
        # Columns that are used more than once get a projection of their own.
        found = df.withColumn("_folded", K.fold_case(text)).withColumn(
            "_found", K.found_labels(text, pairs, F.col("_folded")))
        # A filter on the labels would be pushed below and find them twice; it stays above an explode.
        once = found.withColumn("_labels", F.explode(F.array(K.label_list("_found", other))))
        return once.withColumn("labels", F.col("_labels")).drop("_folded", "_found", "_labels")
    found = _with_keywords(df, keyword_frame(df.sparkSession, kwmap), text)
    labels = F.transform(_whole_words(text), lambda f: f["label"])
    some = found.withColumn("labels", F.coalesce(labels, F.array().cast("array<string>")))
    return some.withColumn("labels", F.when(F.size("labels") == 0, F.array(F.lit(other))).otherwise(F.col("labels"))
                           ).drop("_found")


def first_label(df: DataFrame, other: str = K.OTHER) -> DataFrame:
    """Add `label`, the first element of `labels`."""
    return df.withColumn("label", F.coalesce(F.get("labels", F.lit(0)), F.lit(other)))


def flatten_labels(df: DataFrame) -> DataFrame:
    """Add `labels_text`, the labels joined by a comma and a space."""
    return df.withColumn("labels_text", F.array_join("labels", ", "))


def label_distribution(df: DataFrame) -> DataFrame:
    return df.groupBy("label").agg(F.count("*").alias("n"))


def rare_classes(df: DataFrame, min_count: int = 2) -> DataFrame:
    """Labels with fewer than `min_count` rows."""
    return label_distribution(df).filter(F.col("n") < min_count)


def drop_rare_classes(df: DataFrame, min_count: int = 2) -> DataFrame:
    rare = small_table(rare_classes(df, min_count).select("label"))
    return df.join(rare, "label", "left_anti").select(*df.columns)


def merge_rare_into_other(df: DataFrame, min_count: int = 2, other: str = K.OTHER) -> DataFrame:
    rare = small_table(rare_classes(df, min_count).select("label", F.lit(True).alias("_rare")))
    label = F.when(F.col("_rare"), F.lit(other)).otherwise(F.col("label"))
    return df.join(rare, "label", "left").withColumn("label", label).select(*df.columns)


def exclude_label(df: DataFrame, label: str = K.OTHER) -> DataFrame:
    return df.filter(F.col("label") != label)


def _by_label(pairs: list[tuple[str, str]]) -> dict[str, list[str]]:
    grouped: dict[str, list[str]] = {}
    for keyword, label in pairs:
        grouped.setdefault(label, []).append(keyword)
    return grouped


def _own_keywords(df: DataFrame, pairs: list[tuple[str, str]], default: Column, make) -> Column:
    """`make(keywords)` for the keywords of the row's own label."""
    out = None
    for label, words in _by_label(pairs).items():
        same = F.col("label") == label
        out = F.when(same, make(words)) if out is None else out.when(same, make(words))
    return default if out is None else out.otherwise(default)


def _with_own_patterns(df: DataFrame, kwmap: DataFrame, text: str) -> DataFrame:
    """Add `_patterns`, patterns of the row's own keywords in map order, for maps too large
    for the projection.

    Removing whole words makes no new runs of word characters, so a keyword that is no candidate now
    is none later. Only a keyword with another character at an end can join two runs when it goes; the labels
    that have one, if any, bring all their keywords.
    """
    keyword = F.col("keyword")
    edge = ~(keyword.rlike(f"^[{X.WORD_CHARS}]") & keyword.rlike(f"[{X.WORD_CHARS}]$"))
    whole = kwmap.join(kwmap.where(edge).select("label").distinct(), "label", "left_semi")
    found = _with_keywords(df, kwmap, text)
    own = F.transform(F.filter("_found", lambda f: f["label"] == F.col("label")), lambda f: f["pattern"])
    if whole.limit(1).count():
        lists = keywords_per_label(whole.withColumn("keyword", K.pattern_column("keyword")))
        found = found.join(small_table(lists.withColumnRenamed("keywords", "_whole")), "label", "left")
        own = F.coalesce("_whole", own)
    return found.withColumn("_patterns", F.coalesce(own, F.array().cast("array<string>")))


def hide_own_keywords(df: DataFrame, kwmap: KeywordMap, text: str = "norm", key: list[str] = KEY) -> DataFrame:
    """Remove the keywords of the row's own label, as whole words and in map order."""
    pairs = keyword_pairs(kwmap)
    if pairs is not None:
        return df.withColumn(
            text, _own_keywords(df, pairs, F.col(text), lambda words: K.hide_keywords(text, words)))
    joined = _with_own_patterns(df, keyword_frame(df.sparkSession, kwmap), text)
    hidden = F.aggregate("_patterns", F.col(text), lambda t, p: F.regexp_replace(t, p, F.lit("")))
    return joined.withColumn(text, hidden).select(*df.columns)


def count_removed(df: DataFrame, kwmap: KeywordMap, text: str = "norm", key: list[str] = KEY) -> DataFrame:
    """How many keywords `hide_own_keywords` removes in all."""
    pairs = keyword_pairs(kwmap)
    if pairs is not None:
        n = _own_keywords(df, pairs, F.lit(0), lambda words: K.count_keywords(text, words))
    else:
        df = _with_own_patterns(df, keyword_frame(df.sparkSession, kwmap), text)
        start = F.struct(F.col(text).alias("rest"), F.lit(0).alias("n"))
        n = F.aggregate(
            "_patterns", start,
            lambda acc, p: F.struct(F.regexp_replace(acc["rest"], p, F.lit("")).alias("rest"),
                                    (acc["n"] + F.regexp_count(acc["rest"], p)).alias("n")),
            lambda acc: acc["n"])
    return df.agg(F.coalesce(F.sum(n), F.lit(0)).cast("long").alias("removed"))


def align_by_index(left: DataFrame, right: DataFrame, on: list[str], strict: bool = True) -> DataFrame:
    """Pair two tables by key. With `strict`, a row without partner fails the query; otherwise such rows
    are left out, and `unpaired_rows` counts them."""
    if not strict:
        return left.join(right, on)
    both = left.withColumn("_l", F.lit(True)).join(right.withColumn("_r", F.lit(True)), on, "full")
    paired = F.when(F.col("_l") & F.col("_r"), F.lit(True)).otherwise(
        F.raise_error(F.lit("the two tables do not have the same keys")).cast("boolean"))
    return both.filter(paired).drop("_l", "_r")


def unpaired_rows(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """(side, n): the rows that `align_by_index(strict=False)` leaves out on either side. Null keys never pair."""
    counts = [a.join(b.select(*on).distinct(), on, "left_anti").agg(F.lit(side).alias("side"), F.count("*").alias("n"))
              for side, a, b in (("left", left, right), ("right", right, left))]
    return counts[0].unionByName(counts[1])


def batch_rows(df: DataFrame, size: int, group: str = "doc_id", order: str = "sent_idx",
               item: str = "sentence") -> DataFrame:
    """Consecutive batches of `size` rows per group: (group, batch, items in order)."""
    ranked = rank_within(df.select(group, order, item), [group], F.floor(F.col(order) / 1024),
                         [F.col(order)], "_rank")
    numbered = ranked.withColumn("batch", F.floor((F.col("_rank") - 1) / size))
    ordered = F.array_sort(F.collect_list(F.struct("_rank", item)))
    return numbered.groupBy(group, "batch").agg(F.transform(ordered, lambda e: e[item]).alias("items"))


def corpus_counts(docs: DataFrame, kept: DataFrame, text: str = "text") -> DataFrame:
    """Rows at each stage: documents, documents with text, sentences, sentences kept."""
    n_docs = docs.agg(
        F.count("*").alias("documents"), F.count_if(F.col(text) != "").alias("with_text"))
    n_sent = kept.agg(
        F.count("*").alias("sentences"), F.count_if(F.size("tokens") > 0).alias("kept"))
    stages = n_docs.select(F.expr("stack(2, 'documents', documents, 'with_text', with_text) AS (stage, n)"))
    return stages.unionByName(
        n_sent.select(F.expr("stack(2, 'sentences', sentences, 'kept', kept) AS (stage, n)")))

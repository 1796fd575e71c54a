from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import functions as F

from catalog.oracles import STOP
from textmill.functions import text as X


def one(spark, text, column):
    return spark.createDataFrame([(text,)], "t string").select(column.alias("r")).first().r


def test_sentences_are_cut_before_capitals_only(spark):
    text = "One fish. Two?  three. É vero!\nNo. 4 stays."
    assert one(spark, text, X.split_sentences("t")) == ["One fish.", "Two?  three.", "É vero!", "No. 4 stays."]


def test_normaliser_cases(spark):
    cases = {
        "The 42 of -- 7.": [],
        "NextSeq 2000 gave M9 data": ["nextseq", "gave", "data"],
        "next-generation": ["nextgeneration"],
        "“word” don’t": ["word"],
        "I cannot; we're gonna": ["gon", "na"],
        "Été" + chr(0xA0) + "à la plage": ["été", "à", "la", "plage"],
        "": [],
    }
    for text, tokens in cases.items():
        assert one(spark, text, X.normal_tokens("t")) == tokens, text


def test_normaliser_equals_its_steps(spark):
    text = "The “Cell” lysates, were cannot re-run  42 times; wanna bet? x_y don't"
    steps = X.remove_stop_words(X.alpha_tokens(X.word_tokens(X.strip_punctuation(X.lowercase("t")))))
    assert one(spark, text, X.normal_tokens("t")) == one(spark, text, steps)


def test_stop_list_of_the_oracle_is_the_one_in_use(spark):
    assert sorted(STOP) == sorted(StopWordsRemover.loadDefaultStopWords("english"))


def test_stop_words_keep_repeats(spark):
    assert one(spark, "a b b the b", X.remove_stop_words(F.split("t", " "))) == ["b", "b", "b"]


def test_terms(spark):
    assert one(spark, " a  b\tb ", X.terms_whitespace("t")) == ["a", "b", "b"]
    assert one(spark, "A Bb c_d é ÉÉ x1-y2", X.terms_word2("t")) == ["bb", "c_d", "éé", "x1", "y2"]


def test_term_counts(spark):
    got = one(spark, "b a b c b a", X.term_counts(F.split("t", " ")))
    assert [(r.term, r.n) for r in got] == [("a", 2), ("b", 3), ("c", 1)]
    assert one(spark, "", X.term_counts(X.terms_whitespace("t"))) == []


def test_lemma_candidates(spark):
    assert one(spark, "boxes", X.lemma_candidates("t")) == ["boxes", "boxe", "box"]
    assert one(spark, "women", X.lemma_candidates("t")) == ["women", "woman"]
    assert one(spark, "studies", X.lemma_candidates("t")) == ["studies", "studie", "study"]


def test_semicolons_and_replies(spark):
    assert one(spark, " a b; ;c;", X.split_semicolons("t")) == ["a b", "c"]
    assert one(spark, "\n A, B \n\n  C\n", X.parse_annotations("t")) == [["A", "B"], ["C"]]


def test_sigmoid(spark):
    assert one(spark, "x", X.sigmoid(F.lit(0.0))) == 0.5
    assert one(spark, "x", X.sigmoid(F.lit(-800.0))) == 0.0


def test_abbreviations_are_learned_and_not_cut(spark):
    from textmill.operators import corpus as C
    texts = [f"Dr. Miller met {a} e.g. Anna. She saw Prof. {b} there. It was late. Dr. Who left!" for a in ("Bo", "Al", "Jo") for b in "XYZ"] * 5
    texts += ["Late that day Anna was there and Miller left"] * 9
    texts += ["The miller met her there and she was late. Anna was late.\n\nWhat? Yes", "", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    short = C.abbreviations(df)
    assert {"dr", "prof", "e.g"} <= set(short) and not {"late", "there", "anna"} & set(short)
    got = [r.sentence for r in C.sentences(df.where("doc_id = 0"), abbreviations=short).orderBy("sent_idx").collect()]
    assert got == ["Dr. Miller met Bo e.g. Anna.", "She saw Prof. X there.", "It was late.", "Dr. Who left!"]
    # White space inside a sentence stays; nothing changes where there is no abbreviation.
    assert one(spark, "  A dr.  Who. B", X.split_sentences("t", ["dr"])) == ["  A dr.  Who.", "B"]
    assert one(spark, " One.  Two!\n\nThree? four", X.split_sentences("t", ["zz"])) == one(spark, " One.  Two!\n\nThree? four", X.split_sentences("t"))
    assert C.abbreviation_statistics(df.where("doc_id < 0")).count() == 0

from textmill.functions.keywords import (
    OTHER, contains_any, contains_keyword, count_keywords, fold_case, found_labels, has_keyword, hide_keywords,
    hide_label_names, keyword_pattern, label_list,
)
from textmill.functions.text import (
    alpha_tokens, join_tokens, lemma_candidates, lowercase, normal_tokens, parse_annotations,
    remove_stop_words, sigmoid, split_semicolons, split_sentences, stop_words, strip_punctuation,
    term_counts, terms_whitespace, terms_word2, trim_space, word_tokens,
)

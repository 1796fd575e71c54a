"""SQL for DuckDB that gives the same rows as the registered queries, written independently."""

from __future__ import annotations

from catalog.data import KEYWORDS, LABELS

# The English stop words of Spark's StopWordsRemover.
STOP = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers
herself it its itself they them their theirs themselves what which who whom this that these those am is are
was were be been being have has had having do does did doing a an the and but if or because as until while of
at by for with about against between into through during before after above below to from up down in out on
off over under again further then once here there when where why how all any both each few more most other
some such no nor not only own same so than too very s t can will just don should now i'll you'll he'll she'll
we'll they'll i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've you've
they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't
mustn't can't couldn't cannot could here's how's let's ought that's there's what's when's where's who's why's
would
""".split()

SPACE = r"[\s\x0B\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
WORD = r"\p{L}\p{N}_"
PUNCT = r"[!-/:-@\[-`{-~]"


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def array(items: list[str]) -> str:
    return "[" + ", ".join(map(lit, items)) + "]"


def clean(text: str) -> str:
    return f"regexp_replace(lower({text}), {lit(PUNCT)}, '', 'g')"


def pieces(text: str) -> str:
    halves = text
    for word, at in [("cannot", 3), ("gonna", 3), ("gotta", 3), ("gimme", 3), ("lemme", 3), ("wanna", 3)]:
        halves = rf"regexp_replace({halves}, '\b({word[:at]})({word[at:]})\b', '\1 \2', 'g')"
    spaced = f"regexp_replace({halves}, '[«»“”‘’„]', ' ', 'g')"
    return f"list_filter(string_split_regex({spaced}, {lit(SPACE + '+')}), lambda t: t <> '')"


def letters_only(tokens: str) -> str:
    return rf"list_filter({tokens}, lambda t: regexp_full_match(t, '\p{{L}}+'))"


def no_stop(tokens: str) -> str:
    return f"list_filter({tokens}, lambda t: NOT list_contains({array(STOP)}, t))"


def words2(text: str) -> str:
    return f"regexp_extract_all(lower({text}), '[{WORD}]{{2,}}')"


def split_text(text: str) -> str:
    marked = rf"regexp_replace({text}, '([.!?]){SPACE}+(\p{{Lu}})', '\1' || chr(1) || '\2', 'g')"
    return f"string_split({marked}, chr(1))"


def marked(text: str) -> str:
    return rf"regexp_replace({text}, '([{WORD}]+)', chr(1) || '\1' || chr(1), 'g')"


def found(cases: list[tuple[str, str]]) -> str:
    parts = ", ".join(f"CASE WHEN {test} THEN {lit(label)} END" for test, label in cases)
    return f"list_filter([{parts}], lambda x: x IS NOT NULL)"


WHOLE = found([(f"contains(' ' || norm || ' ', {lit(' ' + k + ' ')})", v) for k, v in KEYWORDS.items()])
PART = found([(f"contains(lower(sentence), {lit(k)})", v) for k, v in KEYWORDS.items()])


def hide_words(text: str, words: list[str]) -> str:
    """Two passes over padded text: neighbours share a space, so one pass misses every second."""
    out = f"' ' || {text} || ' '"
    for w in words:
        for _ in range(2):
            out = f"replace({out}, {lit(' ' + w + ' ')}, '  ')"
    return f"substr({out}, 2, length({out}) - 2)"


def own_hidden(text: str) -> str:
    cases = " ".join(
        f"WHEN {lit(label)} THEN {hide_words(text, [k for k, v in KEYWORDS.items() if v == label])}"
        for label in LABELS)
    return f"CASE label {cases} ELSE {text} END"


def names_hidden(text: str) -> str:
    out = text
    for label in LABELS:
        for form in (label, label.lower(), label.upper()):
            out = f"replace({out}, {lit(form)}, '')"
    return out


LEMMA_FORMS = "list_filter([term, " + ", ".join(
    f"CASE WHEN suffix(term, {lit(end)}) THEN substr(term, 1, length(term) - {len(end)}) || {lit(new)} END"
    for end, new in [("s", ""), ("ses", "s"), ("ves", "f"), ("xes", "x"), ("zes", "z"), ("ches", "ch"),
                     ("shes", "sh"), ("men", "man"), ("ies", "y")]) + "], lambda x: x IS NOT NULL)"

KEY = "doc_id, sent_idx"

# name -> (names it needs, query)
CTES: dict[str, tuple[list[str], str]] = {
    "kw": ([], "SELECT * FROM (VALUES " + ", ".join(
        f"({i}, {lit(k)}, {lit(v)})" for i, (k, v) in enumerate(KEYWORDS.items())) + ") t(pos, keyword, label)"),
    "sents": ([], f"""SELECT doc_id, CAST(unnest(range(len(p))) AS INTEGER) AS sent_idx, unnest(p) AS sentence
        FROM (SELECT doc_id, {split_text('text')} AS p FROM documents WHERE text <> '')"""),
    "raw_norm": (["sents"], f"SELECT *, {no_stop(letters_only(pieces(clean('sentence'))))} AS tokens FROM sents"),
    "norm": (["raw_norm"], "SELECT *, array_to_string(tokens, ' ') AS norm FROM raw_norm WHERE len(tokens) > 0"),
    "lists": (["norm"], f"SELECT *, {WHOLE} AS found, {PART} AS part FROM norm"),
    "lab": (["lists"], """SELECT doc_id, sent_idx, sentence, tokens, norm,
        CASE WHEN len(found) = 0 THEN ['Other'] ELSE found END AS labels,
        coalesce(found[1], 'Other') AS label, coalesce(part[1], 'Other') AS prediction FROM lists"""),
    "pred": (["lab"], "SELECT doc_id, sent_idx, label, prediction FROM lab"),
    "tok": (["norm"], f"SELECT {KEY}, unnest(tokens) AS term, len(tokens) AS n_terms FROM norm"),
    "vocab": (["tok"], f"""SELECT term, CAST(row_number() OVER (ORDER BY tf DESC, term) - 1 AS INTEGER) AS idx, tf, df
        FROM (SELECT term, count(*) AS tf, count(DISTINCT (doc_id, sent_idx)) AS df FROM tok GROUP BY term)
        ORDER BY tf DESC, term LIMIT 1000"""),
    "vidf": (["vocab", "norm"], "SELECT *, ln(((SELECT count(*) FROM norm) + 1.0) / (df + 1.0)) + 1 AS idf FROM vocab"),
    "counts": (["tok", "vidf"], f"""SELECT {KEY}, idx, idf, n_terms, count(*) AS n
        FROM tok JOIN vidf USING (term) GROUP BY {KEY}, idx, idf, n_terms"""),
    "weights": (["counts"], f"SELECT {KEY}, idx, n / n_terms * idf AS weight FROM counts"),
    "kwvoc": (["vocab"], "SELECT idx AS pos, term AS keyword, term[1] AS label FROM vocab"),
    "kwpair": ([], f"""SELECT CAST(min(item_id * 10000 + spot) AS INTEGER) AS pos, keyword, keyword[1] AS label FROM (
        SELECT item_id, unnest(range(len(p))) AS spot, unnest(p) AS keyword FROM (
            SELECT item_id, regexp_extract_all(text, '[{WORD}]+[^{WORD}]+[{WORD}]+') AS p FROM benchmark)) GROUP BY keyword"""),
    # Every word between two marks: a keyword made of whole words is then a plain substring.
    "marked": (["sents"], f"SELECT *, {marked('sentence')} AS m FROM sents"),
    "pairhit": (["marked", "kwpair"], f"""SELECT {KEY}, m, pos, keyword, label FROM marked
        JOIN kwpair ON contains(lower(m), lower({marked('keyword')}))"""),
    "hits": (["kw"], """SELECT keyword, row_number() OVER (PARTITION BY keyword ORDER BY doc_id) AS rank, doc_id
        FROM documents JOIN kw ON contains(lower(text), keyword)"""),
    "doclab": (["hits"], """SELECT doc_id, list(label ORDER BY pos) AS labels FROM (
        SELECT doc_id, label, min(pos) AS pos FROM hits JOIN kw USING (keyword) GROUP BY doc_id, label) GROUP BY doc_id"""),
    # Benchmark rows: rare labels and Other dropped, own keywords hidden.
    "kept": (["lab"], """SELECT doc_id, sent_idx, label, norm FROM lab WHERE label <> 'Other' AND label IN
        (SELECT label FROM lab GROUP BY label HAVING count(*) >= 2)"""),
    "bench": (["kept"], f"SELECT {KEY}, label, {own_hidden('norm')} AS norm FROM kept"),
}


def split_cte(source: str) -> str:
    return f"""SELECT {KEY}, label, CASE WHEN r <= n_test THEN 'test' ELSE 'train' END AS split FROM (
        SELECT {KEY}, label, row_number() OVER (PARTITION BY label
            ORDER BY md5(concat_ws('|', doc_id, sent_idx, '42')), doc_id, sent_idx) AS r FROM {source})
        JOIN (SELECT label, base + CASE WHEN place <= t - sum(base) OVER () THEN 1 ELSE 0 END AS n_test FROM (
            SELECT label, t, (n * t) // total AS base,
                row_number() OVER (ORDER BY (n * t) % total DESC, label) AS place FROM (
                SELECT label, count(*) AS n, sum(count(*)) OVER () AS total,
                    CAST(ceil(0.2 * sum(count(*)) OVER ()) AS BIGINT) AS t FROM {source} GROUP BY label)))
        USING (label)"""


def model_ctes(rows: str, train: str, terms: str, relative: bool, epochs: int) -> dict[str, tuple[list[str], str]]:
    """Vocabulary, features and unrolled gradient steps; `rows` has key, label and norm."""
    tf = "n / n_terms" if relative else "n"
    out = {
        "m_tok": ([rows], f"SELECT {KEY}, unnest(t) AS term, len(t) AS n_terms FROM (SELECT {KEY}, {terms} AS t FROM {rows})"),
        "m_train": ([train], f"SELECT {KEY}, label FROM {train}"),
        "m_vocab": (["m_tok", "m_train"], f"""SELECT term, CAST(row_number() OVER (ORDER BY tf DESC, term) - 1 AS INTEGER) AS idx,
            ln(((SELECT count(*) FROM m_train) + 1.0) / (df + 1.0)) + 1 AS idf
            FROM (SELECT term, count(*) AS tf, count(DISTINCT (doc_id, sent_idx)) AS df
                  FROM m_tok SEMI JOIN m_train USING ({KEY}) GROUP BY term) ORDER BY tf DESC, term LIMIT 1000"""),
        "m_raw": (["m_vocab"], f"""SELECT {KEY}, idx, {tf} * idf AS x FROM (SELECT {KEY}, idx, idf, n_terms, count(*) AS n
            FROM m_tok JOIN m_vocab USING (term) GROUP BY {KEY}, idx, idf, n_terms)"""),
        "m_x": (["m_raw"], f"SELECT {KEY}, idx, x / sqrt(sum(x * x) OVER (PARTITION BY {KEY})) AS x FROM m_raw"),
        "m_lab": (["m_train"], "SELECT DISTINCT label AS l FROM m_train"),
        "w0": (["m_vocab", "m_lab"], "SELECT l, idx, 0.0::DOUBLE AS w FROM m_lab, m_vocab"),
        "b0": (["m_lab"], "SELECT l, 0.0::DOUBLE AS b FROM m_lab"),
    }
    for e in range(epochs):
        out[f"p{e}"] = ([f"w{e}", f"b{e}", "m_x"], f"""SELECT {KEY}, l, CASE WHEN label = l THEN 1 ELSE 0 END AS y,
            1 / (1 + exp(-(b + coalesce(dot, 0)))) AS p FROM m_train JOIN b{e} ON true LEFT JOIN (
                SELECT {KEY}, l, sum(x * w) AS dot FROM m_x JOIN w{e} USING (idx) GROUP BY {KEY}, l) USING ({KEY}, l)""")
        out[f"w{e + 1}"] = ([f"p{e}"], f"""SELECT l, idx, w + 0.1 * coalesce(g, 0) AS w FROM w{e} LEFT JOIN (
            SELECT l, idx, sum(x * (y - p)) AS g FROM m_x JOIN p{e} USING ({KEY}) GROUP BY l, idx) USING (l, idx)""")
        out[f"b{e + 1}"] = ([f"p{e}"], f"""SELECT l, b + 0.1 * g AS b FROM b{e} JOIN (
            SELECT l, sum(y - p) AS g FROM p{e} GROUP BY l) USING (l)""")
    out["w"] = ([f"w{epochs}"], f"SELECT * FROM w{epochs}")
    out["b"] = ([f"b{epochs}"], f"SELECT * FROM b{epochs}")
    out["m_loss"] = ([f"p{epochs - 1}"], f"""SELECT l AS label, -avg(y * ln(p + 1e-15) + (1 - y) * ln(1 - p + 1e-15)) AS loss
        FROM p{epochs - 1} GROUP BY l""")
    # Scores of all rows, features or not.
    out["m_score"] = (["w", "b", "m_x", rows], f"""SELECT {KEY}, label AS truth, l AS label, 1 / (1 + exp(-(b + coalesce(dot, 0)))) AS score
        FROM {rows} JOIN b ON true LEFT JOIN (
            SELECT {KEY}, l, sum(x * w) AS dot FROM m_x JOIN w USING (idx) GROUP BY {KEY}, l) USING ({KEY}, l)""")
    out["m_best"] = (["m_score"], f"""SELECT {KEY}, truth, label AS prediction, score FROM (SELECT *, row_number() OVER (
        PARTITION BY {KEY} ORDER BY score DESC, label) AS r FROM m_score) WHERE r = 1""")
    return out


SPACE_TERMS = "list_filter(string_split(norm, ' '), lambda t: t <> '')"
EPOCHS = 3
OVR = {
    "split": (["bench"], split_cte("bench")),
    "train": (["split"], "SELECT * FROM split WHERE split = 'train'"),
    **model_ctes("bench", "train", SPACE_TERMS, True, EPOCHS),
    "test": (["m_best", "split"], f"""SELECT {KEY}, truth AS label, prediction, score
        FROM m_best SEMI JOIN (SELECT * FROM split WHERE split = 'test') USING ({KEY})"""),
}
SCORING = {
    **model_ctes("bench", "bench", words2("norm"), False, EPOCHS),
    "lines": ([], """SELECT row_number() OVER () AS id, value FROM (
        SELECT trim(unnest(string_split(text, chr(10)))) AS value FROM conversations) WHERE value <> ''"""),
    "l_tok": (["lines"], f"SELECT id, unnest({words2(names_hidden('value'))}) AS term FROM lines"),
    "l_raw": (["l_tok", "m_vocab"], "SELECT id, idx, count(*) * any_value(idf) AS x FROM l_tok JOIN m_vocab USING (term) GROUP BY id, idx"),
    "l_x": (["l_raw"], "SELECT id, idx, x / sqrt(sum(x * x) OVER (PARTITION BY id)) AS x FROM l_raw"),
    "l_best": (["l_x", "w", "b", "lines"], """SELECT id, value, l AS prediction FROM (SELECT id, value, l, row_number() OVER (
        PARTITION BY id ORDER BY 1 / (1 + exp(-(b + coalesce(dot, 0)))) DESC, l) AS r
        FROM lines JOIN b ON true LEFT JOIN (SELECT id, l, sum(x * w) AS dot FROM l_x JOIN w USING (idx) GROUP BY id, l)
        USING (id, l)) WHERE r = 1"""),
}


def digamma(x: str) -> str:
    y = f"({x} + 6)"
    return (f"(ln({y}) - 0.5 / {y} - 1 / (12 * {y} ** 2) + 1 / (120 * {y} ** 4) - 1 / (252 * {y} ** 6)"
            + "".join(f" - 1 / ({x} + {i})" for i in range(6)) + ")")


def trained_topics(k: int = 10, updates: int = 10, steps: int = 100) -> dict[str, tuple[list[str], str]]:
    """`trained`: the share of every term in every topic after all updates, each with as many steps as a row needs."""
    def each(text: str, sep: str = ", ") -> str:
        return sep.join(text.replace("#", str(t)) for t in range(k))

    # Rows of the same terms have the same mixture.
    out = {
        "bag": (["norm"], f"""SELECT row_number() OVER () AS bag, terms, count(*) AS times FROM (
            SELECT list_sort({words2('norm')}) AS terms FROM norm) WHERE len(terms) > 0 GROUP BY terms"""),
        "cell": (["bag"], """SELECT bag, times, term, count(*)::DOUBLE AS n, any_value(len(terms)) AS size FROM (
            SELECT bag, times, terms, unnest(terms) AS term FROM bag) GROUP BY bag, times, term"""),
        "w0": (["cell"], "SELECT term, " + each("""0.5 + ('0x' || substr(md5(concat_ws('|', term, #, '42')), 1, 8))::BIGINT
            / 4294967296.0::DOUBLE AS w#""") + " FROM (SELECT DISTINCT term FROM cell)"),
    }
    for u in range(1, updates + 1):
        out[f"s{u}"] = ([f"w{u - 1}"], f"SELECT {each('sum(w#) AS s#')} FROM w{u - 1}")
        out[f"c{u}"] = ([f"s{u}"], f"""SELECT bag, times, term, n, size, {each('e#')} FROM cell JOIN (SELECT term,
            {each(f"exp({digamma('w#')} - {digamma('s#')}) AS e#")} FROM w{u - 1}, s{u}) USING (term)""")
        # a: what a row's mixture was before the last step, b: what it is; m: how far the step moved it.
        out[f"r{u}"] = ([f"c{u}"], f"""SELECT bag, 0 AS step, 1e9::DOUBLE AS m, {each('0.0::DOUBLE AS a#')},
                {each(f'(1.0::DOUBLE / {k} + max(size) / {k}::DOUBLE) AS b#')} FROM c{u} GROUP BY bag
            UNION ALL SELECT bag, step + 1, ({each('abs(b# - a#)', ' + ')}) / {k}, {each('a#')}, {each('b#')} FROM (
                SELECT bag, any_value(step) AS step, {each('any_value(b#) AS a#')},
                    {each(f'1.0::DOUBLE / {k} + any_value(x#) * sum(n * e# / z) AS b#')} FROM (
                    SELECT c.*, step, {each('b#')}, {each('x#')}, {each('x# * e#', ' + ')} + 1e-100::DOUBLE AS z FROM c{u} c JOIN (
                        SELECT *, {each(f"exp({digamma('b#')}) AS x#")} FROM r{u} WHERE m >= 1e-3 AND step < {steps}) USING (bag))
                GROUP BY bag)""")
        out[f"w{u}"] = ([f"r{u}"], f"""SELECT term, {each(f'1.0::DOUBLE / {k} + sum(times * n * x# * e# / z) AS w#')} FROM (
            SELECT c.*, {each('x#')}, {each('x# * e#', ' + ')} + 1e-100::DOUBLE AS z FROM c{u} c JOIN (
                SELECT *, {each(f"exp({digamma('a#')}) AS x#")} FROM r{u} WHERE m < 1e-3 OR step = {steps}) USING (bag)) GROUP BY term""")
    out["trained"] = ([f"w{updates}"], f"""SELECT term, topic::INT AS topic, weight / sum(weight) OVER (PARTITION BY topic) AS weight
        FROM (SELECT term, unnest([{each('w#')}]) AS weight, unnest(range({k})) AS topic FROM w{updates})""")
    return out


def sql(body: str, needs: list[str], extra: dict | None = None) -> str:
    defs = {**CTES, **(extra or {})}
    order: list[str] = []

    def visit(name: str) -> None:
        if name not in order:
            for n in defs[name][0]:
                visit(n)
            order.append(name)

    for n in needs:
        visit(n)
    head = ",\n".join(f"{n} AS ({defs[n][1]})" for n in order)
    return f"WITH {head}\n{body}" if order else body


def metrics(pred: str, where: str = "", tag: str = "") -> dict[str, tuple[list[str], str]]:
    """Confusion cells, class names, per-label figures and report of a table; `tag` sets the names apart."""
    cells, names, per, scored = f"cells{tag}", f"names{tag}", f"per{tag}", f"scored{tag}"
    return {
        cells: ([pred], f"SELECT label, prediction, count(*) AS n FROM {pred} {where} GROUP BY label, prediction"),
        names: ([cells], f"SELECT label AS name FROM {cells} UNION SELECT prediction FROM {cells}"),
        per: ([names], f"""SELECT name AS label, CASE WHEN pp > 0 THEN tp / pp ELSE 0.0 END AS precision,
            CASE WHEN s > 0 THEN tp / s ELSE 0.0 END AS recall, CAST(s AS BIGINT) AS support FROM (
            SELECT name, coalesce((SELECT sum(n) FROM {cells} WHERE label = name AND prediction = name), 0)::DOUBLE AS tp,
                coalesce((SELECT sum(n) FROM {cells} WHERE prediction = name), 0)::DOUBLE AS pp,
                coalesce((SELECT sum(n) FROM {cells} WHERE label = name), 0)::DOUBLE AS s FROM {names})"""),
        scored: ([per], f"""SELECT label, precision, recall, CASE WHEN precision + recall > 0
            THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1, support FROM {per}"""),
        f"rep{tag}": ([scored], f"""SELECT * FROM {scored}
            UNION ALL SELECT 'accuracy', NULL, NULL, sum(CASE WHEN label = prediction THEN n ELSE 0 END)::DOUBLE / sum(n),
                CAST(sum(n) AS BIGINT) FROM {cells}
            UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), CAST(sum(support) AS BIGINT) FROM {scored}
            UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT) FROM {scored}"""),
    }


ROUND3 = "label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support"


def prompt_head() -> str:
    known = "".join(f"- {k} = {v}\n" for k, v in KEYWORDS.items())
    return (
        "Give each numbered sentence the labels of the keywords it mentions.\nKeywords and labels:\n" + known
        + "A sentence without any of them is labelled Other. "
        "Reply with one line per sentence: its labels, separated by commas.\n")


def oracles() -> dict[str, str]:
    names = sorted([*LABELS, "Other"])
    q: dict[str, str] = {}
    blank = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    parts = f"list_filter(list_transform(string_split(html, ';'), lambda x: trim(x, {blank})), lambda x: x <> '')"
    q["split_semicolons"] = f"""SELECT page_id, CAST(unnest(range(len(p))) AS INTEGER) AS idx, unnest(p) AS part
        FROM (SELECT page_id, {parts} AS p FROM pages)"""
    q["sigmoid"] = "SELECT event_id, round(1 / (1 + exp(-value / 10)), 6) AS p FROM events"
    q["label_counts"] = sql("SELECT label, count(*) AS n FROM lab GROUP BY label", ["lab"])
    q["drop_missing_text"] = "SELECT conv_id, turn, text FROM conversations WHERE text <> ''"
    q["sentence_split"] = sql(f"SELECT {KEY}, sentence FROM sents", ["sents"])
    run = r"[\p{L}\p{N}](?:[\p{L}\p{N}.-]*[\p{L}\p{N}])?"
    shape = lit(rf"^[(\[\"']*({run})(\.?)[)\]\"',;:]*$")
    abbr = {
        "dots": ([], rf"""SELECT word, stop FROM (SELECT lower(regexp_extract(t, {shape}, 1)) AS word, regexp_extract(t, {shape}, 2) = '.' AS stop
            FROM (SELECT unnest(string_split_regex(text, {lit(SPACE)})) AS t FROM documents)) WHERE regexp_matches(word, '\p{{L}}')"""),
        "dotted": (["dots"], """SELECT word, count(*) FILTER (stop) AS with_stop, count(*) FILTER (NOT stop) AS without FROM dots GROUP BY word"""),
        "abbr": (["dotted"], """SELECT word, with_stop, without, 2 * (with_stop * ln(0.99::DOUBLE) + without * ln(1 - 0.99::DOUBLE)
                - with_stop * ln(base) - without * ln(1 - base)) * exp(-size) * (length(word) - size + 1) * pow(size, -without::DOUBLE) AS score
            FROM (SELECT *, length(replace(word, '.', ''))::DOUBLE AS size FROM dotted),
                 (SELECT sum(with_stop)::DOUBLE / sum(with_stop + without) AS base FROM dotted)"""),
    }
    q["abbreviation_statistics"] = sql("SELECT word, with_stop, without, round(score, 6) + 0.0::DOUBLE AS score FROM abbr", ["abbr"], abbr)
    kept = rf"regexp_replace(text, '([.!?])({SPACE}+\p{{Lu}})', '\1' || chr(1) || '\2', 'g')"
    short = f"list_contains(short, lower(regexp_extract(p[i - 1], {lit('(' + run + ')' + chr(92) + '.$')}, 1)))"
    glued = f"array_to_string(list_transform(p, lambda x, i: CASE WHEN i = 1 OR {short} THEN x ELSE chr(1) || x END), '')"
    clean_cut = rf"string_split(regexp_replace({glued}, chr(1) || {lit(SPACE + '+')}, chr(1), 'g'), chr(1))"
    q["sentence_split_abbreviations"] = sql(f"""SELECT doc_id, CAST(unnest(range(len(s))) AS INTEGER) AS sent_idx, unnest(s) AS sentence
        FROM (SELECT doc_id, {clean_cut} AS s FROM (SELECT doc_id, string_split({kept}, chr(1)) AS p FROM documents WHERE text <> ''),
            (SELECT coalesce(list(word), []) AS short FROM abbr WHERE score >= 0.3))""", ["abbr"], abbr)
    q["keyword_mentions"] = sql(f"""SELECT {KEY}, sentence FROM sents WHERE EXISTS
        (SELECT 1 FROM kw WHERE contains(lower(sentence), keyword))""", ["sents", "kw"])
    q["strip_punctuation"] = f"SELECT doc_id, {clean('text')} AS clean FROM documents"
    q["word_tokens"] = f"SELECT doc_id, array_to_string({pieces(clean('text'))}, '|') AS tokens FROM documents"
    q["alpha_tokens"] = f"SELECT doc_id, array_to_string({letters_only(pieces('text'))}, '|') AS tokens FROM documents"
    q["remove_stop_words"] = f"""SELECT doc_id, array_to_string({no_stop(
        f"list_filter(string_split_regex(lower(text), {lit(SPACE + '+')}), lambda t: t <> '')")}, ' ') AS tokens FROM documents"""
    q["normalize_text"] = sql(f"SELECT {KEY}, norm FROM norm", ["norm"])
    for name, least in (("lemmatize", 2), ("lemmatize_with_lexicon", 3)):
        q[name] = sql(f"""SELECT {KEY}, string_agg(coalesce(lemma, term), ' ' ORDER BY i) AS norm
            FROM (SELECT {KEY}, unnest(tokens) AS term, unnest(range(len(tokens))) AS i FROM norm) LEFT JOIN (
                SELECT term, arg_min(form, (length(form), form)) AS lemma
                FROM (SELECT term, unnest({LEMMA_FORMS}) AS form FROM (SELECT DISTINCT term FROM tok))
                WHERE form IN (SELECT term FROM tok GROUP BY term HAVING count(DISTINCT (doc_id, sent_idx)) >= {least})
                GROUP BY term) USING (term) GROUP BY {KEY}""", ["norm", "tok"])
    q["match_keywords"] = sql(f"""SELECT {KEY}, pos, keyword, label FROM norm JOIN kw
        ON contains(' ' || norm || ' ', ' ' || keyword || ' ')""", ["norm", "kw"])
    q["match_keywords_large_map"] = sql(f"""SELECT DISTINCT {KEY}, pos, keyword, label FROM tok
        JOIN kwvoc ON term = keyword""", ["tok", "kwvoc"])
    q["match_keywords_raw_large_map"] = sql(f"SELECT {KEY}, pos, keyword, label FROM pairhit", ["pairhit"])
    q["keyword_mentions_large_map"] = sql(f"""SELECT {KEY}, sentence FROM sents WHERE EXISTS
        (SELECT 1 FROM kwpair WHERE contains(lower(sentence), lower(keyword)))""", ["sents", "kwpair"])
    hidden = f"""replace(list_reduce(list_prepend(any_value(m), list('(?i)' || regexp_escape({marked('keyword')}) ORDER BY pos)),
        lambda t, p: regexp_replace(t, p, '', 'g')), chr(1), '')"""
    q["hide_own_keywords_raw_large_map"] = sql(f"""SELECT {KEY}, label, {hidden} AS sentence FROM pairhit
        JOIN (SELECT {KEY}, arg_min(label, pos) AS label FROM pairhit GROUP BY {KEY}) USING ({KEY}, label)
        GROUP BY {KEY}, label""", ["pairhit"])
    large = f"""SELECT {KEY}, list(label ORDER BY pos) AS labels FROM (SELECT DISTINCT {KEY}, pos, label
        FROM tok JOIN kwvoc ON term = keyword) GROUP BY {KEY}"""
    q["assign_labels_large_map"] = sql(f"""SELECT {KEY}, coalesce(array_to_string(labels, '|'), 'Other') AS labels
        FROM norm LEFT JOIN ({large}) USING ({KEY})""", ["norm", "tok", "kwvoc"])
    q["assign_labels"] = sql(f"SELECT {KEY}, array_to_string(labels, '|') AS labels FROM lab", ["lab"])
    # Normalised, `licensed under` is `licensed`, and `all rights` is `rights`; `of the` vanishes.
    plain = {"licensed under": "licensed", "all rights": "rights", "of the": ""}
    cases = [(f"contains(' ' || norm || ' ', {lit(' ' + plain.get(k, k) + ' ')})", v)
             for k, v in KEYWORDS.items() if plain.get(k, k)]
    q["assign_labels_normalized_keywords"] = sql(f"""SELECT {KEY}, CASE WHEN len(f) = 0 THEN 'Other'
        ELSE array_to_string(f, '|') END AS labels FROM (SELECT {KEY}, {found(cases)} AS f FROM norm)""", ["norm"])
    q["whole_word_raw"] = " UNION ALL ".join(f"""SELECT doc_id, {i} AS pos, {lit(k)} AS keyword, {lit(v)} AS label
        FROM documents WHERE regexp_matches(text, '(?i)(^|[^{WORD}]){k}([^{WORD}]|$)')"""
        for i, (k, v) in enumerate(KEYWORDS.items()))
    q["first_label"] = sql(f"SELECT {KEY}, label FROM lab", ["lab"])
    q["flatten_labels"] = sql(f"SELECT {KEY}, array_to_string(labels, ', ') AS labels_text FROM lab", ["lab"])
    q["corpus_counts"] = sql("""SELECT 'documents' AS stage, count(*) AS n FROM documents
        UNION ALL SELECT 'with_text', count(*) FROM documents WHERE text <> ''
        UNION ALL SELECT 'sentences', count(*) FROM sents UNION ALL SELECT 'kept', count(*) FROM norm""", ["sents", "norm"])
    q["corpus_counts_observed"] = q["corpus_counts"]
    q["unpaired_rows"] = """SELECT 'left' AS side, count(*) AS n FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
        UNION ALL SELECT 'right', count(*) FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)"""
    q["label_distribution"] = "SELECT lang AS label, count(*) AS n FROM documents GROUP BY lang"
    few = "SELECT label FROM lab GROUP BY label HAVING count(*) < 20"
    q["rare_classes"] = sql("SELECT label, count(*) AS n FROM lab GROUP BY label HAVING count(*) < 20", ["lab"])
    q["drop_rare_classes"] = sql(f"SELECT {KEY}, label FROM lab WHERE label NOT IN ({few})", ["lab"])
    q["merge_rare_into_other"] = sql(f"""SELECT {KEY}, CASE WHEN label IN ({few}) THEN 'Other' ELSE label END AS label
        FROM lab""", ["lab"])
    q["exclude_label"] = sql(f"SELECT {KEY}, label FROM lab WHERE label <> 'Other'", ["lab"])
    q["keywords_per_label"] = sql("""SELECT label, string_agg(keyword, '|' ORDER BY pos) AS keywords
        FROM kwvoc GROUP BY label""", ["kwvoc"])
    q["search_hits"] = sql("SELECT keyword, rank, doc_id FROM hits", ["hits"])
    q["cap_per_keyword"] = sql("SELECT keyword, rank, doc_id FROM hits WHERE rank <= 50", ["hits"])
    q["labels_per_document"] = sql("SELECT doc_id, array_to_string(labels, '|') AS labels FROM doclab", ["doclab"])
    q["dedupe_documents"] = """SELECT md5(text) AS text_id, min(doc_id) AS doc_id, CAST(min(length(text)) AS INTEGER) AS n_chars
        FROM documents GROUP BY md5(text)"""
    q["attach_doc_labels"] = sql("""SELECT doc_id, coalesce(array_to_string(labels, '|'), '') AS labels
        FROM documents LEFT JOIN doclab USING (doc_id)""", ["doclab"])
    q["collect_corpus_250"] = sql("""SELECT doc_id, text, array_to_string(labels, '|') AS labels FROM documents JOIN (
        SELECT doc_id, list(label ORDER BY pos) AS labels FROM (SELECT doc_id, label, min(pos) AS pos
            FROM hits JOIN kw USING (keyword) WHERE rank <= 250 GROUP BY doc_id, label) GROUP BY doc_id)
        USING (doc_id)""", ["hits", "kw"])
    q["hide_own_keywords"] = sql(f"SELECT {KEY}, label, {own_hidden('norm')} AS norm FROM lab", ["lab"])
    q["hide_own_keywords_large_map"] = sql(f"""SELECT {KEY}, any_value(own) AS label,
            string_agg(CASE WHEN label = own THEN '' ELSE term END, ' ' ORDER BY i) AS norm
        FROM (SELECT {KEY}, unnest(tokens) AS term, unnest(range(len(tokens))) AS i FROM norm)
        LEFT JOIN kwvoc ON term = keyword
        JOIN (SELECT {KEY}, coalesce(labels[1], 'Other') AS own FROM norm LEFT JOIN ({large}) USING ({KEY})) USING ({KEY})
        GROUP BY {KEY}""", ["norm", "tok", "kwvoc"])
    # With every space doubled no two matches share one, so a single pass finds them all.
    q["count_removed"] = sql("""SELECT CAST(sum((length(padded) - length(replace(padded, spaced, ''))) // length(spaced)) AS BIGINT)
            AS removed FROM (
        SELECT ' ' || replace(norm, ' ', '  ') || ' ' AS padded, ' ' || replace(keyword, ' ', '  ') || ' ' AS spaced
        FROM lab JOIN kw ON lab.label = kw.label)""", ["lab", "kw"])
    q["count_removed_large_map"] = sql(f"""SELECT CAST(count(*) AS BIGINT) AS removed FROM tok
        JOIN kwvoc ON term = keyword
        JOIN (SELECT {KEY}, labels[1] AS own FROM ({large})) USING ({KEY}) WHERE label = own""", ["tok", "kwvoc"])
    q["hide_label_names"] = sql(f"SELECT {KEY}, {names_hidden('sentence')} AS hidden FROM sents", ["sents"])
    q["align_by_index"] = sql(f"SELECT {KEY}, norm, label FROM lab", ["lab"])
    q["align_labels_table"] = "SELECT doc_id, lang, quality, toxic FROM documents JOIN labels USING (doc_id)"
    # features
    q["term_frequency"] = sql("SELECT term, count(*) AS tf FROM tok GROUP BY term", ["tok"])
    q["document_frequency"] = sql("SELECT term, count(DISTINCT (doc_id, sent_idx)) AS df FROM tok GROUP BY term", ["tok"])
    q["build_vocabulary"] = sql("SELECT term, idx, tf, df FROM vocab", ["vocab"])
    all_terms = """SELECT term, row_number() OVER (ORDER BY count(*) DESC, term) - 1 AS idx,
        count(*) AS tf, count(DISTINCT (doc_id, sent_idx)) AS df FROM tok GROUP BY term"""
    q["vocabulary_all_terms"] = sql(all_terms, ["tok"])
    q["idf"] = sql("SELECT term, idx, df, round(idf, 6) AS idf FROM vidf", ["vidf"])
    q["vocab_lookup"] = sql("SELECT term, idx, tf AS n FROM vocab", ["vocab"])
    q["count_vectors"] = sql(f"SELECT {KEY}, idx, n FROM counts", ["counts"])
    q["tfidf_terms"] = sql(f"SELECT {KEY}, idx, round(weight, 6) AS weight FROM weights", ["weights"])
    normed = f"SELECT {KEY}, idx, round(weight / sqrt(sum(weight * weight) OVER (PARTITION BY {KEY})), 6) AS weight FROM weights"
    q["l2_norm"] = q["tfidf_vectors"] = sql(normed, ["weights"])
    every = {"vocab": (["tok"], all_terms)}
    q["count_vectors_all_terms"] = sql(f"SELECT {KEY}, idx, n FROM counts", ["counts"], every)
    q["tfidf_all_terms"] = sql(normed, ["weights"], every)
    words = {
        "tok": (["norm"], f"SELECT {KEY}, unnest({words2('norm')}) AS term, 1 AS n_terms FROM norm"),
    }
    q["tfidf_word2"] = sql(normed, ["weights"], words)
    q["sparse_rows"] = sql(f"""SELECT {KEY}, CAST(count(*) AS INTEGER) AS n, max(idx) AS last_idx, round(sum(weight), 6) AS total
        FROM weights GROUP BY {KEY}""", ["weights"])
    # models
    q["split_rows"] = sql(split_cte("kept"), ["kept"])
    q["ovr_gd_weights"] = sql("SELECT l AS label, idx, round(w, 6) AS weight FROM w", ["w"], OVR)
    q["ovr_gd_bias"] = sql("SELECT l AS label, round(b, 6) AS bias FROM b", ["b"], OVR)
    q["loss_history"] = sql(f"SELECT label, {EPOCHS} AS epoch, round(loss, 6) AS loss FROM m_loss", ["m_loss"], OVR)
    q["ovr_gd_predict"] = sql(f"SELECT {KEY}, label, prediction, round(score, 6) AS score FROM test", ["test"], OVR)
    q["run_roundtrip"] = q["model_roundtrip"] = sql(f"SELECT {KEY}, truth AS label, prediction FROM m_best", ["m_best"], OVR)
    q["score_join"] = sql(f"SELECT {KEY}, label, round(score, 6) AS score FROM m_score", ["m_score"], OVR)
    q["argmax_label"] = sql(f"SELECT {KEY}, prediction, round(score, 6) AS score FROM m_best", ["m_best"], OVR)
    q["loss_by_label"] = sql("""SELECT label, round(-avg(CASE WHEN truth = label THEN ln(score + 1e-15)
        ELSE ln(1 - score + 1e-15) END), 6) AS loss FROM m_score GROUP BY label""", ["m_score"], OVR)
    q["ovr_report"] = sql("""SELECT l AS label, round(coalesce(precision, 0), 6) AS precision, round(coalesce(recall, 0), 6) AS recall,
        round(coalesce(f1, 0), 6) AS f1, coalesce(support, 0) AS support FROM m_lab LEFT JOIN scored ON l = label""",
        ["m_lab", "scored"], {**OVR, **metrics("test")})
    q["majority_baseline"] = sql(f"""SELECT {KEY}, label, (SELECT label FROM lab GROUP BY label
        ORDER BY count(*) DESC, label LIMIT 1) AS prediction FROM lab""", ["lab"])
    # Every class must have reached its optimum, and every prediction be the largest margin's.
    docs_split = split_cte("langs").replace(KEY, "doc_id")
    langs = {"langs": ([], "SELECT doc_id, lang AS label FROM documents"), "lsplit": (["langs"], docs_split)}
    for name in ("multinomial_certificate", "ovr_certificate"):
        q[name] = sql("""SELECT DISTINCT label, (SELECT count(*) FROM lsplit WHERE split = 'train') AS rows, TRUE AS optimal
            FROM lsplit WHERE split = 'train'""", ["lsplit"], langs)
    q["predict_certificate"] = sql("""SELECT label, count(*) AS rows, 0::BIGINT AS wrong FROM lsplit WHERE split = 'test'
        GROUP BY label""", ["lsplit"], langs)
    merged = {"merged": (["lab"], f"""SELECT {KEY}, CASE WHEN label IN (SELECT label FROM lab GROUP BY label HAVING count(*) < 2)
        THEN 'Other' ELSE label END AS label FROM lab"""), "msplit": (["merged"], split_cte("merged"))}
    q["library_certificate"] = sql("""SELECT DISTINCT label, (SELECT count(*) FROM msplit WHERE split = 'train') AS rows,
        TRUE AS optimal FROM msplit WHERE split = 'train'""", ["msplit"], merged)
    q["ovr_gd_full_length"] = sql("""SELECT count(*) FILTER (split = 'test') AS n_test, count(DISTINCT label) AS n_labels,
        TRUE AS beats_majority, TRUE AS loss_falls FROM split""", ["split"], OVR)
    # In the first variational step all topics have the same share in a row, so a term's occurrences are dealt alike everywhere.
    steps = {
        "tf": (["norm"], f"SELECT term, count(*) AS tf FROM (SELECT unnest({words2('norm')}) AS term FROM norm) GROUP BY term"),
        "start": (["tf"], """SELECT term, tf, topic, 0.5 + ('0x' || substr(md5(concat_ws('|', term, topic, '42')), 1, 8))::BIGINT
            / 4294967296.0::DOUBLE AS w FROM tf, range(4) r(topic)"""),
        "psi": (["start"], f"""SELECT term, tf, topic, exp({digamma('w')} - {digamma('total')}) AS e
            FROM start JOIN (SELECT topic, sum(w) AS total FROM start GROUP BY topic) USING (topic)"""),
        "updated": (["psi"], """SELECT term, topic::INT AS topic, 0.25 + tf * e / sum(e) OVER (PARTITION BY term) AS weight FROM psi"""),
    }
    q["topic_update"] = sql("SELECT term, topic, round(weight, 6) AS weight FROM updated", ["updated"], steps)
    q["topic_top_words"] = sql("""SELECT topic, rank, term, round(weight, 6) AS weight FROM (
        SELECT topic, term, weight, row_number() OVER (PARTITION BY topic ORDER BY weight DESC, term)::INT AS rank FROM trained)
        WHERE rank <= 20""", ["trained"], trained_topics()).replace("WITH ", "WITH RECURSIVE ", 1)
    # evaluation
    q["accuracy"] = sql("""SELECT round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 6) AS accuracy
        FROM pred""", ["pred"])
    q["confusion_matrix"] = sql("""SELECT a.name AS label, b.name AS prediction, coalesce(n, 0) AS n FROM names a JOIN names b ON true
        LEFT JOIN cells c ON c.label = a.name AND c.prediction = b.name""", ["names", "cells"], metrics("pred"))
    cols = ", ".join(f'CAST(count(*) FILTER (prediction = {lit(n)}) AS BIGINT) AS "{n}"' for n in names)
    q["confusion_wide"] = sql(f"""SELECT k.label, {cols} FROM (SELECT unnest({array(names)}) AS label) k
        LEFT JOIN pred USING (label) GROUP BY k.label""", ["pred"])
    per = metrics("pred")
    q["per_label_metrics"] = q["metrics_roundtrip"] = sql(f"SELECT {ROUND3} FROM scored", ["scored"], per)
    q["metrics_table"] = sql(f"SELECT {ROUND3.replace('6', '4')} FROM scored", ["scored"], per)
    q["classification_report"] = q["annotator_comparison"] = sql(f"SELECT {ROUND3} FROM rep", ["rep"], per)
    q["metrics_excluding_other"] = sql(f"SELECT {ROUND3} FROM rep", ["rep"], metrics("pred", "WHERE label <> 'Other'"))
    major = {"major": (["lab"], f"""SELECT label, (SELECT label FROM lab GROUP BY label ORDER BY count(*) DESC, label
        LIMIT 1) AS prediction FROM lab""")}
    two = {**major, **per, **metrics("major", tag="_major")}
    q["compare_models"] = sql(f"""SELECT 'substring' AS model, {ROUND3} FROM rep
        UNION ALL SELECT 'majority' AS model, {ROUND3} FROM rep_major""", ["rep", "rep_major"], two)
    ann = {"ann": ([], """SELECT CASE WHEN quality = 1 THEN 'yes' ELSE 'no' END AS label,
        CASE WHEN toxic = 1 THEN 'yes' ELSE 'no' END AS prediction FROM labels""")}
    q["compare_annotators"] = sql(f"SELECT {ROUND3} FROM rep", ["rep"], {**ann, **metrics("ann")})
    # annotator
    q["batch_rows"] = sql("""SELECT doc_id, CAST(sent_idx // 10 AS BIGINT) AS batch,
        string_agg(sentence, '|' ORDER BY sent_idx) AS items FROM sents GROUP BY ALL""", ["sents"])
    q["prompts"] = f"""SELECT conv_id, CAST((r - 1) // 10 AS BIGINT) AS batch, {lit(prompt_head())} ||
        string_agg(r || '. ' || text || chr(10), '' ORDER BY r) AS prompt
        FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS r FROM conversations) GROUP BY ALL"""
    lines = "list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x)), lambda x: x <> '')"
    q["parse_annotations"] = f"""SELECT conv_id, turn, CAST(unnest(range(len(p))) AS INTEGER) AS line,
        array_to_string(list_transform(string_split(unnest(p), ','), lambda x: trim(x)), '|') AS labels
        FROM (SELECT conv_id, turn, {lines} AS p FROM conversations)"""
    # sources, sinks, scoring
    q["records_roundtrip"] = sql("""SELECT CAST(doc_id AS VARCHAR) AS doc_id, text,
        coalesce(array_to_string(labels, '|'), '') AS labels FROM documents LEFT JOIN doclab USING (doc_id)""", ["doclab"])
    q["corpus_json_roundtrip"] = q["normalize_text"]
    q["corpus_text_roundtrip"] = sql("""SELECT trim(replace(sentence, chr(10), ' ')) AS value FROM sents
        WHERE trim(replace(sentence, chr(10), ' ')) <> ''""", ["sents"])
    q["lines_source"] = sql("SELECT value FROM lines", ["lines"], SCORING)
    q["string_array_source"] = f"""SELECT item_id, CAST(unnest(range(len(p))) AS INTEGER) AS idx, unnest(p) AS value
        FROM (SELECT item_id, {split_text('text')} AS p FROM benchmark)"""
    q["string_array_one_file"] = """SELECT CAST(row_number() OVER (ORDER BY conv_id, turn) - 1 AS INTEGER) AS idx, text AS value
        FROM conversations"""
    q["label_array_source"] = f"""SELECT item_id, idx, array_to_string({words2('value')}, '|') AS labels
        FROM ({q['string_array_source']})"""
    q["keyword_map_source"] = sql("SELECT pos, keyword, label FROM kwvoc", ["kwvoc"])
    q["xml_source"] = """SELECT CAST(doc_id AS VARCHAR) AS doc_id,
        array_to_string(list_transform(string_split(text, chr(10)), lambda x: trim(x)), ' ') AS text FROM documents"""
    q["score_batch"] = q["stream_scoring"] = sql("SELECT value, prediction FROM l_best", ["l_best"], SCORING)
    return q

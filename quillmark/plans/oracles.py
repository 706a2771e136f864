"""The registered queries in SQL, written from the definitions.

Windows are built with SQL window frames over sentence rows, and text features
are measured on the joined window texts, so these statements check the array
based plans by another route.
"""

from __future__ import annotations

from quillmark.config import LANGUAGE_IDS, LANGUAGE_MAP, POS_TAGS, SplitSettings
from quillmark.functions import features as ft
from quillmark.functions import text as T
from quillmark.functions.language import NON_LETTERS
from quillmark.functions.lexicons import AUXILIARIES, PRONOUNS, STOPWORDS, by_language
from quillmark.plans.queries import CHUNKS, SAMPLE, TOP

RADII = (0, 1, 2)


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def gsub(expr: str, pattern: str, repl: str = "") -> str:
    return f"regexp_replace({expr}, {lit(pattern)}, {lit(repl)}, 'g')"


def strip_html(expr: str) -> str:
    return gsub(expr, "(?i)" + T.TAG_PATTERN)


def clean(expr: str) -> str:
    out = strip_html(f"coalesce({expr}, '')")
    for pattern, repl in (
        (T.IMAGE_PATTERN, ""),
        (T.LINK_PATTERN, r"\1"),
        (T.CODE_PATTERN, ""),
        (T.BOLD_PATTERN, r"\1"),
        (T.ITALIC_PATTERN, r"\1"),
    ):
        out = gsub(out, pattern, repl)
    return f"trim({gsub(out, T.SPACES_PATTERN, ' ')})"


def cut(expr: str) -> str:
    out = gsub(expr, T.CUT_PATTERN, "\\1\n")
    for _ in range(2):
        out = gsub(out, T.UNCUT_PATTERN, r"\1\2. ")
    out = gsub(out, T.UNCUT_NUMBER_PATTERN, r"\1\2. \3")
    return f"string_split({out}, chr(10))"


def matches(expr: str, pattern: str) -> str:
    return f"len(regexp_extract_all({expr}, {lit(pattern)}))"


def words(expr: str) -> str:
    return f"list_filter(string_split(lower({expr}), ' '), lambda x: x <> '')"


def row_hash(keys: list[str], seed: int, salt: str) -> str:
    parts = ", ".join([*[f"CAST({k} AS VARCHAR)" for k in keys], lit(str(seed)), lit(salt)])
    return f"CAST(('0x' || substr(md5(concat_ws('|', {parts})), 1, 8)) AS BIGINT)"


def uniform(keys: list[str], seed: int, salt: str) -> str:
    return f"({row_hash(keys, seed, salt)} / CAST(4294967296 AS DOUBLE))"


def r6(expr: str) -> str:
    return f"round({expr}, 6)"


DOCS = "SELECT doc_id, text FROM documents"
LABELLED = (
    "SELECT d.doc_id, d.text, l.quality AS label FROM documents d JOIN labels l ON d.doc_id = l.doc_id"
)
TURNS = (
    "SELECT concat_ws('-', CAST(conv_id AS VARCHAR), CAST(turn AS VARCHAR)) AS doc_id, text, "
    "CAST(role = 'assistant' AS INTEGER) AS label FROM conversations "
    "WHERE role IN ('assistant', 'user')"
)


def language_ctes(source: str = "cleaned") -> str:
    """CTE ``langs``(doc_id, language) from a CTE with doc_id and clean."""
    rows = ", ".join(
        f"({lit(w)}, {lit(code)}, {i})"
        for i, (code, ws) in enumerate(by_language(STOPWORDS).items())
        for w in dict.fromkeys(ws)
    )
    mapping = " ".join(f"WHEN {lit(a)} THEN {lit(b)}" for a, b in LANGUAGE_MAP.items())
    return f"""
    stops(w, code, rank) AS (VALUES {rows}),
    doc_words AS (SELECT doc_id, unnest(regexp_split_to_array(lower(clean), {lit(NON_LETTERS)})) AS w
                  FROM {source}),
    hits AS (SELECT doc_id, code, rank, count(*) AS n FROM doc_words JOIN stops USING (w)
             GROUP BY ALL),
    top_hit AS (SELECT doc_id, code FROM hits
                QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, rank) = 1),
    langs AS (SELECT c.doc_id, CASE coalesce(t.code, 'en') {mapping} ELSE 'en' END AS language
              FROM {source} c LEFT JOIN top_hit t ON c.doc_id = t.doc_id)"""


def sentence_ctes(source: str, carry: tuple[str, ...] = (), limit: int | None = None) -> str:
    """CTEs up to ``sent``(doc_id, sentence_index, sentence, ...carry)."""
    extra = "".join(f", {c}" for c in carry)
    wanted = "" if limit is None else f" WHERE sentence_index < {limit}"
    return f"""
    docs AS ({source}),
    cleaned AS (SELECT doc_id{extra}, {clean('text')} AS clean FROM docs),
    parts AS (SELECT doc_id{extra}, {cut('clean')} AS s FROM cleaned),
    raw_sent AS (SELECT doc_id{extra}, unnest(s) AS sentence,
                        CAST(unnest(range(len(s))) AS INTEGER) AS sentence_index FROM parts),
    sent AS (SELECT * FROM raw_sent{wanted})"""


def frame(r: int) -> str:
    return (
        f"(PARTITION BY doc_id ORDER BY sentence_index "
        f"ROWS BETWEEN {r} PRECEDING AND {r} FOLLOWING)"
    )


def window_cols(radii=RADII) -> str:
    return ", ".join(
        f"string_agg(sentence, ' ') OVER {frame(r)} AS window_{2 * r + 1}" for r in radii
    )


def windows_cte(carry: tuple[str, ...] = (), radii=RADII) -> str:
    extra = "".join(f", {c}" for c in carry)
    return f"wins AS (SELECT doc_id, sentence_index{extra}, {window_cols(radii)} FROM sent)"


def stop_count(expr: str) -> str:
    return matches(expr, "[.!?]")


def lexical_raw(r: int) -> list[str]:
    w = f"window_{2 * r + 1}"
    ws = words(w)
    return [
        f"CASE WHEN len({ws}) = 0 THEN 0.0 ELSE len(list_distinct({ws})) / CAST(len({ws}) AS DOUBLE) END"
        f" AS {w}_type_token_ratio"
    ]


def lexical_cols(r: int) -> list[str]:
    value, name = lexical_raw(r)[0].rsplit(" AS ", 1)
    return [f"{r6(value)} AS {name}"]


def punct_cols(r: int) -> list[str]:
    w = f"window_{2 * r + 1}"
    return [
        f"CASE WHEN {stop_count(w)} > 0 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS {w}_punct_density",
        f"CAST(length({w}) - length(replace({w}, '!', '')) AS INTEGER) AS {w}_exclamations",
        f"CAST((length({w}) - length(replace({w}, '...', ''))) // 3 AS INTEGER) AS {w}_ellipsis",
    ]


def length_cols(r: int) -> list[str]:
    w = f"window_{2 * r + 1}"
    lens = f"list_transform({cut(w)}, lambda s: CAST(len({words('s')}) AS DOUBLE))"
    return [
        r6(f"list_avg({lens})") + f" AS {w}_avg_sentence_length",
        r6(f"coalesce(list_stddev_samp({lens}), 0)") + f" AS {w}_sentence_length_std",
    ]


def measured_cte(language: bool) -> str:
    """CTE ``meas``: sentence counts for readability and, with language, tags."""
    pos = ""
    source = "sent"
    if language:
        source = "sent JOIN langs USING (doc_id)"
        aux, pron = by_language(AUXILIARIES), by_language(PRONOUNS)

        def listed(table: dict, word: str) -> str:
            cases = " ".join(
                f"WHEN {lit(c)} THEN {word} IN ({', '.join(lit(x) for x in ws)})"
                for c, ws in table.items()
                if c != "en"
            )
            return f"CASE language {cases} ELSE {word} IN ({', '.join(lit(x) for x in table['en'])}) END"

        tagged = f"regexp_extract_all(sentence, {lit(ft.TAGGED_WORD)})"
        capital = f"regexp_matches(x, {lit(ft.CAPITAL)}) AND lower(x) <> x"
        pos = f""",
          {matches('sentence', ft.PUNCTUATION_RUN)} AS n_punct,
          {matches('sentence', ft.SYMBOL_RUN)} AS n_x,
          len({tagged}) + {matches('sentence', ft.PUNCTUATION_RUN)} + {matches('sentence', ft.SYMBOL_RUN)} AS n_token,
          len(list_filter({tagged}, lambda x: {listed(aux, 'lower(x)')})) AS n_aux,
          len(list_filter({tagged}, lambda x: {listed(pron, 'lower(x)')} AND NOT {listed(aux, 'lower(x)')})) AS n_pron,
          len(list_filter({tagged}[2:], lambda x: {capital} AND NOT {listed(pron, 'lower(x)')}
              AND NOT {listed(aux, 'lower(x)')})) AS n_propn"""
    return f"""
    meas AS (SELECT doc_id, sentence_index,
          {matches('sentence', ft.LEXICAL_WORD)} AS n_lex,
          length(replace(sentence, ' ', '')) AS n_char,
          {matches('lower(sentence)', ft.POLYSYLLABLE)} AS n_poly{pos}
        FROM {source})"""


def readability_cols(r: int) -> list[str]:
    w, f = f"window_{2 * r + 1}", frame(r)

    def total(c):
        return f"sum({c}) OVER {f}"

    n = f"count(*) OVER {f}"
    smog = f"1.043::DOUBLE * sqrt(30.0::DOUBLE * {total('n_poly')} / {n}) + 3.1291::DOUBLE"
    ari = (
        f"4.71::DOUBLE * ({total('n_char')} / {total('n_lex')}::DOUBLE) "
        f"+ 0.5::DOUBLE * ({total('n_lex')} / ({n})::DOUBLE) - 21.43::DOUBLE"
    )
    return [
        r6(f"CASE WHEN {n} >= 3 AND {total('n_lex')} > 0 THEN {smog} ELSE 0::DOUBLE END")
        + f" AS {w}_smog_index",
        r6(f"CASE WHEN {total('n_lex')} > 0 THEN {ari} ELSE 0::DOUBLE END") + f" AS {w}_ari",
    ]


def pos_cols(r: int) -> list[str]:
    w, f = f"window_{2 * r + 1}", frame(r)
    return [
        r6(
            f"CASE WHEN sum(n_token) OVER {f} > 0 THEN sum(n_{t.lower()}) OVER {f} / "
            f"CAST(sum(n_token) OVER {f} AS DOUBLE) ELSE 0::DOUBLE END"
        )
        + f" AS {w}_pos_{t}"
        for t in POS_TAGS
    ]


def each(make) -> str:
    return ", ".join(c for r in RADII for c in make(r))


def language_id(expr: str) -> str:
    cases = " ".join(f"WHEN {lit(c)} THEN {i}" for c, i in LANGUAGE_IDS.items())
    return f"CAST(CASE {expr} {cases} ELSE -1 END AS INTEGER)"


def features_sql(source: str, carry: tuple[str, ...] = ()) -> str:
    extra = "".join(f", t.{c}" for c in carry)
    return f"""
    WITH {sentence_ctes(source, carry)}, {language_ctes()}, {measured_cte(True)}, {windows_cte(carry)},
    texts AS (SELECT *, {each(lexical_cols)}, {each(punct_cols)}, {each(length_cols)} FROM wins),
    sums AS (SELECT doc_id, sentence_index, {each(readability_cols)}, {each(pos_cols)} FROM meas)
    SELECT t.* EXCLUDE (window_1, window_3, window_5), s.* EXCLUDE (doc_id, sentence_index),
           l.language, {language_id('l.language')} AS language_id
    FROM texts t JOIN sums s USING (doc_id, sentence_index) JOIN langs l USING (doc_id)"""


def simple_features(make, source: str = DOCS) -> str:
    return f"""
    WITH {sentence_ctes(source)}, {windows_cte()}
    SELECT doc_id, sentence_index, {each(make)} FROM wins"""


def measured_features(make, language: bool) -> str:
    langs = f", {language_ctes()}" if language else ""
    return f"""
    WITH {sentence_ctes(DOCS)}{langs}, {measured_cte(language)}
    SELECT doc_id, sentence_index, {each(make)} FROM meas"""


# --- scores ---------------------------------------------------------------


def scored_ctes() -> str:
    """CTEs up to ``scored``(doc_id, sentence_index, label, language, scores, pred)."""

    def prob(r: int) -> str:
        f = frame(r)
        mean = f"(sum(n) OVER {f} / CAST(count(*) OVER {f} AS DOUBLE))"
        return f"{mean} / ({mean} + 16.0::DOUBLE) AS prob_ai_s{2 * r + 1}"

    return f"""
    {sentence_ctes(LABELLED, ('label',))}, {language_ctes()},
    counted AS (SELECT doc_id, sentence_index, label, len({words('sentence')}) AS n FROM sent),
    probs AS (SELECT doc_id, sentence_index, label, {prob(0)}, {prob(1)}, {prob(2)} FROM counted),
    mixed AS (SELECT *, 0.25::DOUBLE * prob_ai_s1 + 0.25::DOUBLE * prob_ai_s3
                     + 0.5::DOUBLE * prob_ai_s5 AS prob_ai FROM probs),
    scored AS (SELECT m.*, l.language, CAST(m.prob_ai >= 0.5 AS INTEGER) AS pred
               FROM mixed m JOIN langs l USING (doc_id))"""


METRICS = """
    count(*) AS n,
    count(*) FILTER (label = 1 AND pred = 1)::DOUBLE AS tp,
    count(*) FILTER (label = 0 AND pred = 1)::DOUBLE AS fp,
    count(*) FILTER (label = 1 AND pred = 0)::DOUBLE AS fn,
    count(*) FILTER (label = 0 AND pred = 0)::DOUBLE AS tn"""


def ratio(top: str, bottom: str) -> str:
    return f"CASE WHEN ({bottom}) = 0 THEN 0::DOUBLE ELSE ({top}) / ({bottom}) END"


SCORES = f"""
    {r6(ratio('tp + tn', 'tp + fp + fn + tn'))} AS accuracy,
    {r6(ratio('2 * tp', '2 * tp + fp + fn'))} AS f1,
    {r6(ratio('tp', 'tp + fp'))} AS precision,
    {r6(ratio('tp', 'tp + fn'))} AS recall"""


def auc_sql(source: str, score: str, by: str = "") -> str:
    """Pair counting by rank: each positive row against the negatives below it."""
    group = f"{by}, " if by else ""
    part = f"PARTITION BY {by} " if by else ""
    return f"""
    (WITH per AS (SELECT {group}{score} AS s, count(*) FILTER (label = 1) AS p,
                         count(*) FILTER (label = 0) AS q FROM {source} GROUP BY ALL),
     run AS (SELECT *, sum(q) OVER ({part}ORDER BY s) - q AS below FROM per)
     SELECT {group}{r6('CASE WHEN sum(p) * sum(q) = 0 THEN NULL ELSE sum(p * (2 * below + q))::DOUBLE / (2.0::DOUBLE * sum(p)::DOUBLE * sum(q)::DOUBLE) END')} AS roc_auc
     FROM run {'GROUP BY ' + by if by else ''})"""


# --- splits ---------------------------------------------------------------


def split_sql(source: str, keys: list[str], stratified: bool, cols: str, split=SplitSettings()) -> str:
    part = "PARTITION BY label " if stratified else ""
    ratio_ = split.train / (split.train + split.val)
    return f"""
    (SELECT {cols}, CASE WHEN rk <= test THEN 'test'
                WHEN rk <= test + floor((n - test) * {ratio_!r}::DOUBLE) THEN 'train' ELSE 'val' END AS split
     FROM (SELECT *, row_number() OVER ({part}ORDER BY h, {', '.join(keys)}) AS rk,
                  count(*) OVER ({part}) AS n,
                  ceil({split.test!r}::DOUBLE * count(*) OVER ({part})) AS test
           FROM (SELECT *, {row_hash(keys, split.seed, 'split')} AS h FROM {source})))"""


def sample_sql(source: str, keys: list[str], n: int, cols: str) -> str:
    return f"""
    (SELECT {cols} FROM
       (SELECT *, row_number() OVER (PARTITION BY label ORDER BY h, {', '.join(keys)}) AS rk,
               (SELECT count(*) FROM {source}) AS total,
               (SELECT count(*) FROM {source} WHERE label = 0) AS zeros
        FROM (SELECT *, {row_hash(keys, 42, 'sample')} AS h FROM {source}))
     WHERE {n} >= total OR rk <= CASE WHEN label = 0 THEN floor({n}::DOUBLE * zeros / total)
                                 ELSE {n} - floor({n}::DOUBLE * zeros / total) END)"""


KEYS = ["doc_id", "sentence_index"]
LABEL_ROWS = "(SELECT doc_id, quality AS label FROM labels)"


def labelled_sent() -> str:
    return sentence_ctes(LABELLED, ("label",))


def grouped_ctes() -> str:
    """CTEs up to ``grouped``(doc_id, sentence_index, label, split)."""
    return f"""
    {labelled_sent()},
    doc_split AS {split_sql(LABEL_ROWS, ['doc_id'], True, 'doc_id, label')},
    grouped AS (SELECT s.doc_id, s.sentence_index, s.label, p.split
                FROM sent s JOIN doc_split p USING (doc_id))"""


def dropout_sql(mode: str) -> str:
    keys = KEYS
    mask, which = uniform(keys, 123, "mask"), uniform(keys, 123, "which")
    bounds = {"prob_ai_s1": (0.0, 0.25), "prob_ai_s3": (0.25, 0.5), "prob_ai_s5": (0.5, 1.0)}
    changed = ", ".join(
        f"round(CASE WHEN {mask} < 0.3::DOUBLE AND {which} >= {lo}::DOUBLE AND {which} < {hi}::DOUBLE "
        f"THEN 0.5::DOUBLE ELSE {c} END, 6) AS {c}"
        for c, (lo, hi) in bounds.items()
    )
    kept = ", ".join(f"round({c}, 6) AS {c}" for c in bounds)
    base = "doc_id, sentence_index, label"
    out = f"SELECT {base}, {changed}, TRUE AS is_augmented FROM scored"
    if mode == "concat":
        out = f"SELECT {base}, {kept}, FALSE AS is_augmented FROM scored UNION ALL {out}"
    return f"WITH {scored_ctes()} {out}"


# --- bigrams --------------------------------------------------------------


def bigram_ctes(source: str) -> str:
    """CTEs up to ``ppl``(doc_id, sentence_index, window_*_perplexity)."""

    def value(r: int) -> str:
        # A pair belongs to a window if both of its sentences do.
        return f"""
        p{r} AS (SELECT s.doc_id, s.sentence_index,
              CASE WHEN any_value(w.n) = 0 THEN 0::DOUBLE
                   WHEN count(lp) = 0 THEN 1::DOUBLE ELSE exp(-sum(lp)::DOUBLE / (count(lp) * 1000000.0::DOUBLE)) END AS v
            FROM sent s
            JOIN (SELECT doc_id, sentence_index, sum(len({words('sentence')})) OVER {frame(r)} AS n FROM sent) w
              USING (doc_id, sentence_index)
            LEFT JOIN logs g ON g.doc_id = s.doc_id AND g.i >= s.sentence_index - {r}
                 AND g.j <= s.sentence_index + {r}
            GROUP BY s.doc_id, s.sentence_index)"""

    return f"""
    {sentence_ctes(source)},
    toks AS (SELECT doc_id, sentence_index, unnest({words('sentence')}) AS w,
                    unnest(range(len({words('sentence')}))) AS pos FROM sent),
    pairs AS (SELECT doc_id, sentence_index AS i, w AS a,
                     lead(w) OVER o AS b, lead(sentence_index) OVER o AS j
              FROM toks WINDOW o AS (PARTITION BY doc_id ORDER BY sentence_index, pos)),
    bi AS (SELECT a, b, count(*) AS n FROM pairs WHERE b IS NOT NULL GROUP BY a, b),
    ctx AS (SELECT a, sum(n) AS n FROM bi GROUP BY a),
    voc AS (SELECT count(*) AS v FROM (SELECT a FROM bi UNION SELECT b FROM bi)),
    logs AS (SELECT p.doc_id, p.i, p.j,
                    CAST(round(1000000.0::DOUBLE * (ln(bi.n + 0.1::DOUBLE) - ln(ctx.n + 0.1::DOUBLE * voc.v))) AS BIGINT) AS lp
             FROM pairs p JOIN bi USING (a, b) JOIN ctx USING (a) CROSS JOIN voc),
    {value(0)}, {value(1)}, {value(2)},
    ppl AS (SELECT p0.doc_id, p0.sentence_index, round(p0.v, 4) AS window_1_perplexity,
                   round(p1.v, 4) AS window_3_perplexity, round(p2.v, 4) AS window_5_perplexity
            FROM p0 JOIN p1 USING (doc_id, sentence_index) JOIN p2 USING (doc_id, sentence_index))"""


def pick(choices: tuple[str, ...], salt: str) -> str:
    options = ", ".join(lit(c) for c in choices)
    return f"([{options}])[{row_hash(['doc_id'], 42, salt)} % {len(choices)} + 1]"


def class_report_sql() -> str:
    def row(name: str, tp: str, fp: str, fn: str) -> str:
        return (
            f"SELECT {lit(name)} AS class, {ratio(tp, f'{tp} + {fp}')} AS precision, "
            f"{ratio(tp, f'{tp} + {fn}')} AS recall, "
            f"{ratio(f'2 * {tp}', f'2 * {tp} + {fp} + {fn}')} AS f1, {tp} + {fn} AS support FROM m"
        )

    names = ("precision", "recall", "f1")
    return f"""
    WITH {scored_ctes()}, m AS (SELECT {METRICS} FROM scored),
    per AS ({row('0', 'tn', 'fn', 'fp')} UNION ALL {row('1', 'tp', 'fp', 'fn')}),
    rep AS (SELECT * FROM per
      UNION ALL SELECT 'macro avg', {', '.join(f'avg({c})' for c in names)}, sum(support) FROM per
      UNION ALL SELECT 'weighted avg', {', '.join(f'sum({c} * support) / sum(support)' for c in names)}, sum(support) FROM per)
    SELECT class, {', '.join(f'{r6(c)} AS {c}' for c in names)}, CAST(support AS BIGINT) AS support FROM rep"""


def evaluate_sql() -> str:
    tall = " UNION ALL ".join(
        f"SELECT {lit(m)} AS model, language, label, {c} AS score, CAST({c} >= 0.5 AS INTEGER) AS pred FROM scored"
        for m, c in (("s1", "prob_ai_s1"), ("s3", "prob_ai_s3"), ("s5", "prob_ai_s5"), ("meta", "prob_ai"))
    )
    counts = ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in ("tp", "fp", "fn", "tn"))
    return f"""
    WITH {scored_ctes()}, tall AS ({tall}),
    m AS (SELECT model, language, {METRICS} FROM tall GROUP BY model, language
          UNION ALL SELECT model, 'all', {METRICS} FROM tall GROUP BY model),
    a AS {auc_sql('tall', 'score', 'model')}
    SELECT m.model, m.language, {counts}, {SCORES},
           CASE WHEN m.language = 'all' THEN a.roc_auc END AS roc_auc
    FROM m JOIN a USING (model)"""


def fragility_sql() -> str:
    terms = {"s1": 0.25, "s3": 0.25, "s5": 0.5}

    def score(gone: str) -> str:
        return " + ".join(
            f"{w}::DOUBLE * " + ("0.5::DOUBLE" if k == gone else f"prob_ai_{k}")
            for k, w in terms.items()
        )

    rates = ", ".join(
        r6(f"sum(CAST((({score(k)}) >= 0.5) <> (prob_ai >= 0.5) AS INTEGER)) / CAST(count(*) AS DOUBLE)")
        + f" AS {k}_flip_rate"
        for k in terms
    )
    return f"WITH {scored_ctes()} SELECT {rates} FROM scored"


def profile_features() -> str:
    return f"""
    {sentence_ctes(LABELLED, ('label',))}, {language_ctes()}, {windows_cte(('label',))},
    feats AS (SELECT w.*, l.language, {each(lexical_cols)}, {each(punct_cols)}, {each(length_cols)}
              FROM wins w JOIN langs l USING (doc_id))"""


def top_features_sql() -> str:
    names = [
        f"window_{2 * r + 1}_{n}"
        for r in RADII
        for n in (
            "type_token_ratio",
            "punct_density",
            "exclamations",
            "ellipsis",
            "avg_sentence_length",
            "sentence_length_std",
        )
    ]
    rows = " UNION ALL ".join(
        f"SELECT {lit(c)} AS feature, round(abs(avg({c}) FILTER (label = 1) - avg({c}) FILTER (label = 0)), 6) "
        f"AS importance FROM feats"
        for c in names
    )
    return f"WITH {profile_features()} SELECT * FROM ({rows}) ORDER BY importance DESC, feature LIMIT {TOP}"


def punctuation_sql() -> str:
    s = "window_1"
    density, exclaim, ellipsis = (c.replace("window_1_", "") for c in punct_cols(0))
    n = f"len({words(s)})"
    return f"""
    WITH {sentence_ctes(DOCS)}, {windows_cte(radii=(0,))}
    SELECT doc_id, sentence_index, {density}, {exclaim}, {ellipsis},
           round(CASE WHEN {n} = 0 THEN 0::DOUBLE ELSE {stop_count(s)} / CAST({n} AS DOUBLE) END, 6) AS punct_per_word
    FROM wins"""


def chunk_sql() -> str:
    return f"CAST({row_hash(['doc_id'], 0, 'chunk')} % {CHUNKS} AS INTEGER)"


def kneser_ney_sql(source: str) -> str:
    """Trigram counts, their continuation counts, and the interpolated probabilities."""

    def window(r: int) -> str:
        n, log = f"sum(n) OVER {frame(r)}", f"sum(lp) OVER {frame(r)}"
        value = f"CASE WHEN {n} = 0 THEN 0::DOUBLE ELSE exp(-({log})::DOUBLE / ({n} * 1000000.0::DOUBLE)) END"
        return f"round({value}, 4) AS window_{2 * r + 1}_perplexity"

    def discount(table: str) -> str:
        ones, twos = (f"count(*) FILTER (WHERE n = {k})" for k in (1, 2))
        return f"(SELECT CASE WHEN {ones} > 0 THEN {ones} / ({ones} + 2.0::DOUBLE * {twos}) ELSE 0.5 END FROM {table})"

    return f"""WITH {sentence_ctes(source)},
    padded AS (SELECT doc_id, sentence_index, len({words('sentence')}) AS n_word,
                      list_concat(list_concat([chr(2), chr(2)], {words('sentence')}), [chr(3)]) AS w FROM sent),
    grams AS (SELECT doc_id, sentence_index, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
              FROM (SELECT *, unnest(range(1, n_word + 2)) AS i FROM padded WHERE n_word > 0)),
    three AS (SELECT a, b, c, count(*) AS n FROM grams GROUP BY a, b, c),
    two AS (SELECT b, c, count(*) AS n FROM three GROUP BY b, c),
    one AS (SELECT c, count(*) AS n FROM two GROUP BY c),
    after3 AS (SELECT a, b, sum(n)::DOUBLE AS total, count(*)::DOUBLE AS kinds FROM three GROUP BY a, b),
    after2 AS (SELECT b, sum(n)::DOUBLE AS total, count(*)::DOUBLE AS kinds FROM two GROUP BY b),
    sizes AS (SELECT {discount('one')} AS d1, {discount('two')} AS d2, {discount('three')} AS d3,
                     (SELECT count(*) FROM two)::DOUBLE AS pairs, (SELECT count(*) FROM one)::DOUBLE AS v),
    probs AS (
        SELECT a, b, c,
            greatest(three.n - d3, 0) / after3.total + d3 * after3.kinds / after3.total * (
                greatest(two.n - d2, 0) / after2.total + d2 * after2.kinds / after2.total * (
                    greatest(one.n - d1, 0) / pairs + d1 * v / pairs * (1.0::DOUBLE / (v + 1.0::DOUBLE)))) AS p
        FROM three JOIN after3 USING (a, b) JOIN two USING (b, c) JOIN after2 USING (b) JOIN one USING (c) CROSS JOIN sizes),
    sums AS (SELECT s.doc_id, s.sentence_index, count(p) AS n,
                    coalesce(sum(CAST(round(1000000.0::DOUBLE * ln(p)) AS BIGINT)), 0) AS lp
             FROM padded s LEFT JOIN grams g USING (doc_id, sentence_index) LEFT JOIN probs USING (a, b, c)
             GROUP BY s.doc_id, s.sentence_index)
    SELECT doc_id, sentence_index, {window(0)}, {window(1)}, {window(2)} FROM sums"""


def language_model_sql() -> str:
    """Trigram counts of held-in documents, one log probability for each, sums per document."""
    log = "CAST(round(1000000.0::DOUBLE * ln({})) AS BIGINT)"
    return f"""WITH d AS (SELECT doc_id, text, lang, {row_hash(['doc_id'], 42, 'language')} % 4 = 0 AS held_out FROM documents),
    w AS (SELECT doc_id, lang, held_out, ' ' || unnest(regexp_extract_all(lower(text), '\\p{{L}}+')) || ' ' AS w FROM d),
    wn AS (SELECT doc_id, lang, held_out, w, count(*) AS n FROM w GROUP BY ALL),
    wg AS (SELECT w, substring(w, i, 3) AS gram
           FROM (SELECT w, unnest(range(1, length(w) - 1)) AS i FROM (SELECT DISTINCT w FROM w))),
    shares AS (SELECT lang, count(*)::DOUBLE AS docs, sum(count(*)) OVER ()::DOUBLE AS every FROM d
               WHERE NOT held_out AND lang IS NOT NULL GROUP BY lang),
    counts AS (SELECT lang, gram, sum(n) AS n FROM wn JOIN wg USING (w) WHERE NOT held_out AND lang IS NOT NULL GROUP BY lang, gram),
    kinds AS (SELECT count(DISTINCT gram) AS kinds FROM counts),
    below AS (SELECT lang, docs, every, coalesce(sum(n), 0) + 0.5::DOUBLE * (any_value(kinds) + 1.0::DOUBLE) AS below
              FROM shares LEFT JOIN counts USING (lang) CROSS JOIN kinds GROUP BY lang, docs, every),
    words AS (SELECT w, lang, sum({log.format('(coalesce(n, 0) + 0.5::DOUBLE) / below')}) AS lp
              FROM wg CROSS JOIN below LEFT JOIN counts USING (lang, gram) GROUP BY w, lang),
    scored AS (SELECT doc_id, words.lang, sum(n * lp) AS lp FROM wn JOIN words USING (w) GROUP BY doc_id, words.lang),
    ranked AS (SELECT d.doc_id, held_out, below.lang, coalesce(lp, 0) + {log.format('docs / every')} AS lp
               FROM d CROSS JOIN below LEFT JOIN scored ON scored.doc_id = d.doc_id AND scored.lang = below.lang)
    SELECT doc_id, any_value(held_out) AS held_out, arg_min(lang, place) AS language,
           CAST(max(lp) - max(lp) FILTER (WHERE place = 2) AS BIGINT) AS margin
    FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY lp DESC, lang) AS place FROM ranked) GROUP BY doc_id"""


def sentence_model_ctes(source: str) -> str:
    """CTEs up to ``short`` and ``starters``(word, score) over ``tok``(doc_id, place, token, next)."""

    def base(x: str) -> str:
        return f"regexp_replace(lower({x}), '\\.$', '')"

    def share(n: str, p: str) -> str:
        return f"CASE WHEN {n} = 0 THEN 0::DOUBLE ELSE {n} * ln({p}) END"

    return f"""docs AS ({source}), cleaned AS (SELECT doc_id, {clean('text')} AS clean FROM docs),
    listed AS (SELECT doc_id, list_filter(string_split(clean, ' '), lambda w: w <> '') AS l FROM cleaned),
    tok AS (SELECT doc_id, place, l[place + 1] AS token, l[place + 2] AS next
            FROM (SELECT doc_id, l, CAST(unnest(range(len(l))) AS INTEGER) AS place FROM listed)),
    counts AS (SELECT {base('token')} AS word, (count(*) FILTER (WHERE token LIKE '%.'))::DOUBLE AS a,
                      (count(*) FILTER (WHERE token NOT LIKE '%.'))::DOUBLE AS b FROM tok GROUP BY 1),
    chance AS (SELECT sum(a) / sum(a + b) AS s FROM counts),
    evidence AS (
        SELECT word, -2 * (({share('a', 's')}) + ({share('b', '1 - s')}) - (({share('a', '0.99::DOUBLE')}) + ({share('b', '1 - 0.99::DOUBLE')})))
            * exp(-letters) * (length(word) - letters + 1) * pow(letters, -b) AS score
        FROM (SELECT *, length(replace(word, '.', ''))::DOUBLE AS letters FROM counts CROSS JOIN chance
              WHERE a > 0 AND regexp_matches(word, '^\\p{{L}}[\\p{{L}}.-]*$'))),
    short AS (SELECT word, score FROM evidence WHERE score >= 0.3),
    after AS (SELECT {base('next')} AS word, count(*)::DOUBLE AS ab FROM tok
              WHERE regexp_matches(token, '[.!?]$') AND NOT regexp_matches(token, '^[0-9.,]+\\.$') AND next IS NOT NULL
                AND {base('token')} NOT IN (SELECT word FROM short) GROUP BY 1),
    sums AS (SELECT (SELECT sum(ab) FROM after) AS a, (SELECT count(*) FROM tok)::DOUBLE AS n),
    sides AS (SELECT word, ab, after.ab / sums.a AS p1, sums.a AS a, n, counts.a + counts.b AS b FROM after JOIN counts USING (word) CROSS JOIN sums),
    places AS (SELECT *, b / n AS p, (b - ab) / greatest(n - a, 1) AS p2, n - a - b + ab AS rest FROM sides),
    starters AS (SELECT * FROM (
        SELECT word, -2 * (({share('ab', 'p')}) + ({share('(a - ab)', '1 - p')}) + ({share('(b - ab)', 'p')}) + ({share('rest', '1 - p')})
            - (({share('ab', 'p1')}) + ({share('(a - ab)', '1 - p1')}) + ({share('(b - ab)', 'p2')}) + ({share('rest', '1 - p2')}))) AS score
        FROM places WHERE regexp_matches(word, '^\\p{{L}}') AND ab / b > a / n) WHERE score >= 30)"""


def sentence_ends_sql(source: str) -> str:
    return f"""WITH {sentence_model_ctes(source)},
    marked AS (SELECT t.*, s.word IS NOT NULL OR regexp_matches(token, '^\\p{{Lu}}\\.$') AS held,
                      f.word IS NOT NULL AND regexp_matches(next, '^\\p{{Lu}}') AS starts
               FROM tok t LEFT JOIN short s ON s.word = regexp_replace(lower(token), '\\.$', '')
               LEFT JOIN starters f ON f.word = regexp_replace(lower(next), '\\.$', '')
               WHERE regexp_matches(token, '[.!?]$') OR next IS NULL),
    done AS (SELECT doc_id FROM marked WHERE CASE WHEN next IS NULL OR token NOT LIKE '%.' THEN true WHEN held THEN starts
                 ELSE NOT (regexp_matches(token, '^[0-9.,]+\\.$') AND regexp_matches(next, '^\\p{{Ll}}')) END)
    SELECT docs.doc_id, count(done.doc_id) AS sentences FROM docs LEFT JOIN done USING (doc_id) GROUP BY docs.doc_id"""


def oracle_sql() -> dict[str, str]:
    turns_matrix = ", ".join(
        f"round(CAST(CAST({c} AS FLOAT) AS DOUBLE), 6) AS {c}"
        for c in [
            *[f"window_{2 * r + 1}_{n}" for r in RADII for n in ("type_token_ratio", "punct_density", "exclamations", "ellipsis")],
        ]
    )
    windows3 = "window_1, window_3, window_5"
    return {
        "load_corpus": "SELECT doc_id, text, CAST(length(text) AS INTEGER) AS n_chars FROM documents",
        "load_split": f"SELECT * FROM {split_sql(LABEL_ROWS, ['doc_id'], True, 'doc_id, label')} WHERE split = 'train'",
        "label_domain": "SELECT quality AS label, count(*) AS n, coalesce(quality IN (0, 1), FALSE) AS valid FROM labels GROUP BY quality",
        "strip_html": f"SELECT page_id, {strip_html('html')} AS text FROM pages",
        "clean_text": f"SELECT doc_id, {clean('text')} AS text FROM documents",
        "detect_language": f"WITH cleaned AS (SELECT doc_id, {clean('text')} AS clean FROM documents), {language_ctes()} SELECT doc_id, language FROM langs",
        "language_id": f"SELECT doc_id, {language_id('lang')} AS language_id FROM documents",
        "split_sentences": f"WITH {sentence_ctes(DOCS)} SELECT doc_id, sentence_index, sentence FROM sent",
        "context_windows": f"WITH {sentence_ctes(DOCS)} SELECT doc_id, sentence_index, {window_cols()} FROM sent",
        "first_sentences": f"WITH {sentence_ctes(DOCS, limit=100)} SELECT doc_id, sentence_index, sentence AS window_1 FROM sent",
        "sentence_table": f"""WITH {labelled_sent()}, {language_ctes()}, {windows_cte(('label',))}
            SELECT {windows3}, language, label, 'doc_' || doc_id AS doc_id, sentence_index FROM wins JOIN langs USING (doc_id)""",
        "blank_documents": "SELECT doc_id, 'en' AS language, 0 AS sentence_index, '' AS window_1, '' AS window_3, '' AS window_5 FROM documents",
        "labelled_sentences": f"WITH {labelled_sent()} SELECT doc_id, sentence_index, label, sentence FROM sent",
        "readability": measured_features(readability_cols, False),
        "type_token_ratio": simple_features(lexical_cols),
        "sentence_length": simple_features(length_cols),
        "pos_shares": measured_features(pos_cols, True).replace(
            "SELECT doc_id, sentence_index, round", "SELECT doc_id, sentence_index, (SELECT language FROM langs l WHERE l.doc_id = meas.doc_id) AS language, round"
        ),
        "punctuation": punctuation_sql(),
        "window_features": features_sql(DOCS, ()),
        "feature_table": f"""SELECT f.*, p.* EXCLUDE (doc_id, sentence_index) FROM ({features_sql(DOCS, ())}) f
            JOIN (WITH {bigram_ctes(DOCS)} SELECT * FROM ppl) p USING (doc_id, sentence_index)""",
        "text_features": features_sql(TURNS, ("label",)),
        "bigram_perplexity": f"WITH {bigram_ctes(DOCS)} SELECT * FROM ppl",
        "kneser_ney": kneser_ney_sql(DOCS),
        "language_model": language_model_sql(),
        "sentence_model": f"""WITH {sentence_model_ctes(DOCS)}
            SELECT 'abbreviation' AS kind, word, round(score, 4) AS score FROM short
            UNION ALL SELECT 'starter', word, round(score, 4) FROM starters""",
        "sentence_ends": sentence_ends_sql(DOCS),
        "assemble_features": f"""WITH {bigram_ctes(TURNS)}, {language_ctes()}, {windows_cte()},
            feats AS (SELECT doc_id, sentence_index, {each(lexical_cols)}, {each(length_cols)} FROM wins)
            SELECT f.*, p.* EXCLUDE (doc_id, sentence_index), d.label, l.language, {language_id('l.language')} AS language_id
            FROM feats f JOIN ppl p USING (doc_id, sentence_index) JOIN docs d USING (doc_id) JOIN langs l USING (doc_id)""",
        "feature_matrix": f"""WITH {sentence_ctes(TURNS, ('label',))}, {language_ctes()}, {windows_cte(('label',))},
            feats AS (SELECT doc_id, sentence_index, label, {each(lexical_raw)}, {each(punct_cols)} FROM wins)
            SELECT doc_id, sentence_index, CAST(label AS DOUBLE) AS label, {turns_matrix},
                   CAST({language_id('language')} AS DOUBLE) AS language_id FROM feats JOIN langs USING (doc_id)""",
        "row_index": """SELECT l_orderkey, l_linenumber,
            CAST(row_number() OVER (ORDER BY l_shipdate NULLS FIRST, l_orderkey, l_linenumber) - 1 AS BIGINT) AS row_index FROM lineitem""",
        "batches_with_indices": "SELECT doc_id, CAST(row_number() OVER (ORDER BY doc_id) - 1 AS BIGINT) AS place FROM documents",
        "table_function": """SELECT source, CAST(count(*) AS BIGINT) AS n_lines, CAST(sum(length(line)) AS BIGINT) AS n_chars
            FROM (SELECT source, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents) GROUP BY source""",
        "apply_batches": f"SELECT doc_id, CAST({matches('text', '[A-Z]')} AS BIGINT) AS n_upper FROM documents",
        "author_profile": f"""WITH {profile_features()}
            SELECT language, label, count(*) AS sentences, {r6('avg(window_5_type_token_ratio)')} AS type_token_ratio,
                   {r6('avg(window_1_punct_density)')} AS punct_density, {r6('avg(window_1_exclamations)')} AS exclamations,
                   {r6('avg(window_5_avg_sentence_length)')} AS avg_sentence_length,
                   {r6('avg(window_5_sentence_length_std)')} AS sentence_length_std
            FROM feats GROUP BY language, label""",
        "stratified_split": f"WITH {labelled_sent()} SELECT * FROM {split_sql('sent', KEYS, True, 'doc_id, sentence_index, label')}",
        "random_split": f"SELECT * FROM {split_sql('(' + TURNS + ')', ['doc_id'], False, 'doc_id, label')}",
        "grouped_split": f"WITH {grouped_ctes()} SELECT * FROM grouped",
        "split_leakage": f"""WITH {labelled_sent()}, x AS {split_sql('sent', KEYS, True, 'doc_id, sentence_index, label')}
            SELECT doc_id, CAST(count(DISTINCT split) AS INTEGER) AS n_splits, count(*) AS n_sentences FROM x
            GROUP BY doc_id HAVING count(DISTINCT split) > 1""",
        "stratified_sample": f"WITH {labelled_sent()} SELECT * FROM {sample_sql('sent', KEYS, SAMPLE, 'doc_id, sentence_index, label')}",
        "meta_split": f"""WITH {labelled_sent()}
            SELECT doc_id, sentence_index, label, CASE WHEN rk <= ceil(0.15::DOUBLE * n) THEN 'val' ELSE 'train' END AS split
            FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY h, doc_id, sentence_index) AS rk,
                         count(*) OVER (PARTITION BY label) AS n
                  FROM (SELECT *, {row_hash(KEYS, 42, 'meta')} AS h FROM sent))""",
        "meta_training_set": f"""WITH {grouped_ctes()}, tr AS (SELECT * FROM grouped WHERE split = 'train')
            SELECT * FROM {sample_sql('tr', KEYS, SAMPLE, 'doc_id, sentence_index, label, split')}
            UNION ALL SELECT doc_id, sentence_index, label, split FROM grouped WHERE split = 'val'""",
        "expert_dropout": dropout_sql("concat"),
        "expert_dropout_replace": dropout_sql("replace"),
        "corpus_counts": f"""WITH {grouped_ctes()}
            SELECT coalesce(split, 'all') AS split, count(DISTINCT doc_id) AS texts, count(*) AS sentences
            FROM grouped GROUP BY ROLLUP (split)""",
        "class_balance": f"""SELECT label, count(*) AS n, {r6('count(*) / CAST(sum(count(*)) OVER () AS DOUBLE)')} AS share
            FROM ({TURNS}) GROUP BY label""",
        "threshold_preds": f"WITH {scored_ctes()} SELECT doc_id, sentence_index, {r6('prob_ai')} AS prob_ai, pred FROM scored",
        "classification_metrics": f"WITH {scored_ctes()}, m AS (SELECT {METRICS} FROM scored) SELECT n, {SCORES} FROM m",
        "roc_auc": f"WITH {scored_ctes()} SELECT * FROM {auc_sql('scored', 'prob_ai')}",
        "confusion_matrix": f"""WITH {scored_ctes()}, grid AS (SELECT * FROM (VALUES (0), (1)) a(label), (VALUES (0), (1)) b(pred))
            SELECT g.label, g.pred, count(s.doc_id) AS n FROM grid g LEFT JOIN scored s ON g.label = s.label AND g.pred = s.pred
            GROUP BY g.label, g.pred""",
        "class_report": class_report_sql(),
        "metrics_per_language": f"""WITH {scored_ctes()},
            m AS (SELECT language, {METRICS} FROM scored GROUP BY language UNION ALL SELECT 'all', {METRICS} FROM scored)
            SELECT language, n, {SCORES} FROM m""",
        "evaluate_models": evaluate_sql(),
        "fragility": fragility_sql(),
        "top_features": top_features_sql(),
        "incremental_remaining": f"""WITH {sentence_ctes(DOCS)} SELECT doc_id, sentence_index FROM sent
            WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
        "resume_point": f"""WITH {labelled_sent()}
            SELECT CAST(max({chunk_sql()}) + 1 AS INTEGER) AS next_chunk, count(*) AS rows_done FROM sent""",
        "progress_status": f"""WITH {sentence_ctes(DOCS)},
            d AS (SELECT count(DISTINCT {chunk_sql()}) AS chunks_done, count(*) AS rows_done FROM sent
                  WHERE doc_id IN (SELECT doc_id FROM labels)), t AS (SELECT count(*) AS total FROM sent)
            SELECT CASE WHEN chunks_done = 0 THEN 'not_started' WHEN total > rows_done THEN 'in_progress' ELSE 'completed' END AS status,
                   chunks_done, rows_done, total - rows_done AS rows_left,
                   {r6('rows_done * 100.0::DOUBLE / total')} AS percent FROM d, t""",
        "concat_chunks": f"""WITH {sentence_ctes(DOCS)}
            SELECT doc_id, sentence_index, sentence AS window_1, {chunk_sql()} AS chunk FROM sent""",
        "gather_chunks": f"""WITH {sentence_ctes(TURNS, ('label',))}, {windows_cte(('label',))}
            SELECT doc_id, sentence_index, label, {chunk_sql()} AS chunk, {each(lexical_cols)} FROM wins""",
        "completed_phases": """SELECT d.source AS phase FROM documents d LEFT JOIN labels l USING (doc_id)
            GROUP BY d.source HAVING count(l.quality) * 5 >= count(*) * 2""",
        "stream_features": f"""WITH {sentence_ctes(DOCS)}, {windows_cte()}
            SELECT doc_id, sentence_index, {each(lexical_cols)}, {each(punct_cols)} FROM wins""",
        "stream_batches": f"WITH {bigram_ctes(DOCS)} SELECT * FROM ppl",
    }

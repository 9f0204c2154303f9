"""DuckDB SQL text equivalent to the registered Spark queries.

Written from the same constants as the Spark side (regexes, stop words,
model parameters), so a change of a fixed value changes both.  Float
literals are written in exponent form: a plain ``0.75`` is a DECIMAL in
SQL and rounds differently.
"""

from __future__ import annotations

from trawl.functions.analyzers import (DIGIT_JOINERS, ENGLISH_STOP_WORDS, HAN, HIRAGANA, KATAKANA, LETTER_JOINERS, LETTER_TOKEN,
                                       SOUTH_EAST_ASIAN)
from trawl.functions.scoring import BM25_B, BM25_K1, DIRICHLET_MU, JM_LAMBDA
from trawl.operators.rank import FORMS, MODEL_RUN_PREFIX, TFIDF_RUN_PREFIX
from trawl.operators.topk import SCORE_DIGITS


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def dbl(x: float) -> str:
    return f"{float(x)!r}e0" if "e" not in repr(float(x)) else repr(float(x))


STOP_LIST = "[" + ", ".join(lit(w) for w in ENGLISH_STOP_WORDS) + "]"
JAVA_TRIM_RE = lit(r"^[\x00-\x20]+|[\x00-\x20]+\z")


def java_trim(expr: str) -> str:
    return f"regexp_replace({expr}, {JAVA_TRIM_RE}, '', 'g')"


# The word breaks in steps, without look-around.  A private-use character goes round every
# ideograph, hiragana character, katakana run and run of a script without spaces (not
# next to a connector, which joins katakana), and another behind every joining mark that
# joins (twice, as neighbours share a letter); then only marks followed by it keep a token together.
_MARK, _EDGE = "\ue000", "\ue001"
_EXT = r"[\p{M}\x{ad}\x{600}-\x{605}\x{61c}\x{200c}-\x{200f}\x{202a}-\x{202e}\x{2060}-\x{206f}\x{feff}]"
_ALONE = [rf"[{HAN}{HIRAGANA}]{_EXT}*", rf"(?:[{KATAKANA}]{_EXT}*)+", rf"(?:[{SOUTH_EAST_ASIAN}]{_EXT}*)+"]
_BASE = r"\p{L}\p{Nl}\p{Nd}\p{Pc}"
_IN_TOKEN = rf"(?:[{_BASE}]|{_EXT})"
_JOINS = (rf"([\p{{L}}\p{{Nl}}]{_EXT}*)([{LETTER_JOINERS}]{_EXT}*)([\p{{L}}\p{{Nl}}])|(\p{{Nd}}{_EXT}*)([{DIGIT_JOINERS}]{_EXT}*)(\p{{Nd}})")
_JOINED_TOKEN = rf"[{_BASE}]{_IN_TOKEN}*(?:[{LETTER_JOINERS}{DIGIT_JOINERS}]{_EXT}*{_MARK}{_IN_TOKEN}+)*"


def _marked(expr: str) -> str:
    return rf"regexp_replace({expr}, {lit(_JOINS)}, '\1\2\4\5{_MARK}\3\6', 'g')"


def _edged(expr: str) -> str:
    for alone in _ALONE:
        expr = rf"regexp_replace({expr}, {lit(f'({alone})')}, '{_EDGE}\1{_EDGE}', 'g')"
    return rf"regexp_replace(regexp_replace({expr}, '(\p{{Pc}}){_EDGE}', '\1', 'g'), '{_EDGE}(\p{{Pc}})', '\1', 'g')"


def tokens(expr: str, analyzer: str = "standard") -> str:
    if analyzer == "standard":
        clean = _edged(f"translate(lower({expr}), '{_MARK}{_EDGE}', '  ')")
        found = f"regexp_extract_all({_marked(_marked(clean))}, {lit(_JOINED_TOKEN)})"
        return (f"list_filter(list_transform({found}, lambda t: replace(t, '{_MARK}', '')), "
                f"lambda t: NOT list_contains({STOP_LIST}, t) AND regexp_matches(t, '[\\p{{L}}\\p{{Nl}}\\p{{Nd}}{KATAKANA}{HAN}{SOUTH_EAST_ASIAN}]'))")
    if analyzer == "keyword":
        return f"[{expr}]"
    if analyzer == "simple":
        return f"regexp_extract_all(lower({expr}), {lit(LETTER_TOKEN)})"
    if analyzer == "stop":
        return (f"list_filter(regexp_extract_all(lower({expr}), {lit(LETTER_TOKEN)}), "
                f"lambda t: NOT list_contains({STOP_LIST}, t))")
    raise ValueError(analyzer)


def tag_text(expr: str, tag: str) -> str:
    bodies = f"regexp_extract_all({expr}, {lit(f'(?is)<{tag}>(.+?)</{tag}>')}, 1)"
    return java_trim(f"array_to_string(list_transform({bodies}, lambda b: {java_trim('b')}), ' ')")


# Topics: the short form is the title of the page with the item's number.
TOPICS_SQL = f"""SELECT CAST(item_id AS INTEGER) AS query_id,
  coalesce({tag_text('html', 'title')}, '') AS title, text AS "desc"
FROM benchmark LEFT JOIN pages ON page_id = item_id"""


# -- common table expressions ----------------------------------------------

def corpus_ctes(analyzer: str = "standard") -> str:
    """corpus, tok, docs (doc_id, dl), postings, terms, cstats."""
    return f"""
corpus AS (SELECT CAST(doc_id AS BIGINT) AS doc_id, CAST(doc_id AS VARCHAR) AS docno,
                  source AS head, lang AS byline, CAST(n_chars AS VARCHAR) AS dateline, text
           FROM documents),
tok AS (SELECT doc_id, docno, {tokens('text', analyzer)} AS toks FROM corpus),
docs AS (SELECT doc_id, docno, CAST(len(toks) AS BIGINT) AS dl FROM tok),
postings AS (SELECT term, doc_id, CAST(count(*) AS BIGINT) AS tf
             FROM (SELECT doc_id, unnest(toks) AS term FROM tok) GROUP BY term, doc_id),
terms AS (SELECT term, CAST(count(*) AS BIGINT) AS df, CAST(sum(tf) AS BIGINT) AS cf
          FROM postings GROUP BY term),
cstats AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(dl) AS BIGINT) AS n_tokens FROM docs)"""


def norm_ctes() -> str:
    """dnorm (doc_id, dl, qn, dlq): quantised norm and the length it decodes to."""
    x = "CAST(CAST(1e0 / sqrt(CASE WHEN dl > 0 THEN CAST(dl AS DOUBLE) END) AS FLOAT) AS DOUBLE)"
    return f"""
nx AS (SELECT doc_id, dl, {x} AS x FROM docs),
ne AS (SELECT doc_id, dl, x, floor(log2(x)) AS e0 FROM nx),
np AS (SELECT doc_id, dl, x, pow(2e0, e0 - CASE WHEN pow(2e0, e0) > x THEN 1 ELSE 0 END
                                       + CASE WHEN pow(2e0, e0 + 1) <= x THEN 1 ELSE 0 END) AS p FROM ne),
dnorm AS (SELECT doc_id, dl, (1e0 + floor((x / p - 1e0) * 4e0) / 4e0) * p AS qn,
                 1e0 / (((1e0 + floor((x / p - 1e0) * 4e0) / 4e0) * p) * ((1e0 + floor((x / p - 1e0) * 4e0) / 4e0) * p)) AS dlq
          FROM np)"""


def topic_ctes(analyzer: str = "standard", forms=("title", "desc")) -> str:
    """topics, queries (query_id, form, text), qterms (query_id, form, term, qtf)."""
    parts = [f"SELECT query_id, '{f}' AS form, \"{f}\" AS text FROM topics" for f in forms]
    return f"""
topics AS ({TOPICS_SQL}),
queries AS ({' UNION ALL '.join(parts)}),
qterms AS (SELECT query_id, form, term, CAST(count(*) AS BIGINT) AS qtf
           FROM (SELECT query_id, form, unnest({tokens('text', analyzer)}) AS term FROM queries)
           GROUP BY query_id, form, term)"""


def adhoc_ctes(text: str, analyzer: str = "standard") -> str:
    return f"""
queries AS (SELECT CAST(0 AS INTEGER) AS query_id, 'adhoc' AS form, {lit(text)} AS text),
qterms AS (SELECT query_id, form, term, CAST(count(*) AS BIGINT) AS qtf
           FROM (SELECT query_id, form, unnest({tokens('text', analyzer)}) AS term FROM queries)
           GROUP BY query_id, form, term)"""


def weighted_ctes() -> str:
    """wq: query terms with df, cf and VSM per-query facts; m: the match table."""
    return f"""
wq0 AS (SELECT q.query_id, q.form, q.term, q.qtf, coalesce(t.df, 0) AS df, coalesce(t.cf, 0) AS cf
        FROM qterms q LEFT JOIN terms t ON q.term = t.term),
qv AS (SELECT query_id, form, sum(qtf) AS clauses,
              1e0 / sqrt(sum(qtf * (ln(CAST(n_docs AS DOUBLE) / (df + 1e0)) + 1e0)
                                 * (ln(CAST(n_docs AS DOUBLE) / (df + 1e0)) + 1e0))) AS vsm_qnorm
       FROM wq0, cstats GROUP BY query_id, form),
wq AS (SELECT wq0.*, qv.clauses, qv.vsm_qnorm FROM wq0 JOIN qv USING (query_id, form)),
m AS (SELECT wq.query_id, wq.form, wq.term, wq.qtf, wq.df, wq.cf, wq.clauses, wq.vsm_qnorm,
             p.doc_id, CAST(p.tf AS DOUBLE) AS tf, d.dl, d.qn, d.dlq, c.n_docs, c.n_tokens,
             CASE WHEN c.n_tokens > 0 THEN CAST(c.n_tokens AS DOUBLE) / c.n_docs ELSE 1e0 END AS avgdl
      FROM wq JOIN postings p ON wq.term = p.term JOIN dnorm d ON p.doc_id = d.doc_id, cstats c
      WHERE wq.df > 0)"""


def model_sums() -> dict[str, str]:
    k1, b, mu, lam = dbl(BM25_K1), dbl(BM25_B), dbl(DIRICHLET_MU), dbl(JM_LAMBDA)
    pc = "((cf + 1e0) / (n_tokens + 1e0))"
    vidf = "(ln(CAST(n_docs AS DOUBLE) / (df + 1e0)) + 1e0)"
    return {
        "tfidf": ("sum(CAST(CAST(tf / qn AS FLOAT) AS DOUBLE) * "
                  "CASE WHEN df > 0 THEN ln(1e0 + CAST(n_docs // df AS DOUBLE)) ELSE 0e0 END)"),
        "bm25": (f"sum(qtf * ln(1e0 + (n_docs - df + 0.5e0) / (df + 0.5e0)) * "
                 f"(tf * ({k1} + 1e0) / (tf + {k1} * ((1e0 - {b}) + {b} * dlq / avgdl))))"),
        "vsm": (f"sum(qtf * {vidf} * {vidf} * sqrt(tf) * qn) * sum(qtf) / max(clauses) * max(vsm_qnorm)"),
        "lm_dirichlet": (f"sum(qtf * greatest(ln(1e0 + tf / ({mu} * {pc})) + ln({mu} / (dlq + {mu})), 0e0))"),
        "lm_jm": f"sum(qtf * ln(1e0 + ((1e0 - {lam}) * tf / dlq) / ({lam} * {pc})))",
    }


def runs_sql(models, k: int, topics: str | None = None, adhoc: str | None = None,
             exclude: str = "false") -> str:
    """Ranked run table for the given models over topics (both forms) or one
    ad-hoc query; documents for which ``exclude`` holds are not ranked."""
    sums = model_sums()
    prefix = dict(MODEL_RUN_PREFIX, tfidf=TFIDF_RUN_PREFIX)
    q_ctes = adhoc_ctes(adhoc) if adhoc is not None else topic_ctes()
    scores = ", ".join(f"{sums[mname]} AS {mname}" for mname in models)
    longs = " UNION ALL ".join(f"SELECT query_id, form, doc_id, '{mname}' AS model, {mname} AS score FROM sc"
                               for mname in models)
    tags = {f: (t, s) for f, t, s in FORMS}
    tags["adhoc"] = ("Q0", "adhoc")
    q_case = "CASE form " + " ".join(f"WHEN '{f}' THEN '{t}'" for f, (t, _) in tags.items()) + " END"
    s_case = "CASE form " + " ".join(f"WHEN '{f}' THEN '{s}'" for f, (_, s) in tags.items()) + " END"
    p_case = "CASE model " + " ".join(f"WHEN '{mname}' THEN '{prefix[mname]}'" for mname in models) + " END"
    return f"""WITH {corpus_ctes()}, {norm_ctes()}, {q_ctes}, {weighted_ctes()},
sc AS (SELECT query_id, form, doc_id, {scores} FROM m WHERE NOT ({exclude}) GROUP BY query_id, form, doc_id),
lg AS ({longs}),
rk AS (SELECT query_id, form, doc_id, model, round(score, {SCORE_DIGITS}) AS score,
              row_number() OVER (PARTITION BY model, query_id, form
                                 ORDER BY round(score, {SCORE_DIGITS}) DESC, doc_id ASC) AS rank
       FROM lg)
SELECT CAST(rk.query_id AS INTEGER) AS query_id, {q_case} AS q, d.docno, CAST(rank AS INTEGER) AS rank,
       CAST(score AS DOUBLE) AS score, {p_case} || '_' || {s_case} AS run_id
FROM rk JOIN docs d ON rk.doc_id = d.doc_id
WHERE rank <= {k}"""

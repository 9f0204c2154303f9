"""Scoring expressions: norms, idf variants and per-term model weights.

Every function maps columns to a column, so a whole topic set is scored
by one aggregation over the match table.  Names of the inputs:

``tf``  term frequency in the document      ``df``  documents with the term
``cf``  occurrences of the term             ``dl``  document length (tokens)
``qtf`` repetitions of the term in a query  ``n_docs``, ``n_tokens`` corpus sizes
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (defaults of the reference's similarity classes).
BM25_K1 = 1.2
BM25_B = 0.75
DIRICHLET_MU = 2000.0
JM_LAMBDA = 0.7
# ---------------------------------------------------------------------------


def _f32(c: Column) -> Column:
    """Round a double to the nearest float and widen it back."""
    return c.cast("float").cast("double")


def _positive(dl: Column) -> Column:
    """dl as double, null when 0: keeps divisions by zero out of ANSI mode."""
    return F.when(dl > 0, dl.cast("double"))


def exact_norm(dl: Column) -> Column:
    """1/sqrt(dl); null for a document without tokens."""
    return F.lit(1.0) / F.sqrt(_positive(dl))


def quantized_norm(dl: Column) -> Column:
    """Length norm as stored in one byte and decoded again.

    The stored value is the float (1/sqrt(dl), computed in double and
    rounded once to single precision) cut down to 3 significant
    bits (leading 1 plus two mantissa bits, truncated).  Written with
    exact power-of-two arithmetic so Spark and the SQL oracle agree;
    null for a document without tokens.
    """
    x = _f32(F.lit(1.0) / F.sqrt(_positive(dl)))
    e0 = F.floor(F.log2(x))
    e = (e0 - F.when(F.pow(F.lit(2.0), e0) > x, 1).otherwise(0)
         + F.when(F.pow(F.lit(2.0), e0 + 1) <= x, 1).otherwise(0))
    p = F.pow(F.lit(2.0), e)
    return (F.lit(1.0) + F.floor((x / p - 1.0) * 4.0) / 4.0) * p


def norm(dl: Column, mode: str = "quantized") -> Column:
    if mode == "quantized":
        return quantized_norm(dl)
    if mode == "exact":
        return exact_norm(dl)
    raise ValueError(f"norm_mode must be 'quantized' or 'exact', not {mode!r}")


# -- home-made TF-IDF ------------------------------------------------------

def tfidf_idf(n_docs: Column, df: Column) -> Column:
    """ln(1 + N div df) with *integer* division; 0 when df is 0."""
    n = n_docs.cast("long")
    d = F.when(df > 0, df.cast("long"))
    quotient = (n - n % d) / d  # exact: n - n % d is a multiple of d
    return F.when(df > 0, F.log(F.lit(1.0) + quotient)).otherwise(0.0)


def tfidf_term(tf: Column, nrm: Column, idf: Column) -> Column:
    """(tf / norm) * idf with the division done in single precision.

    The norm is ~1/sqrt(dl), so dividing by it *multiplies* by sqrt(dl):
    long documents score higher.  That is what the reference computes and
    is kept on purpose; the usual definition would divide by a length.
    """
    return _f32(tf.cast("double") / nrm) * idf


# -- library models --------------------------------------------------------
# ``nrm`` is the (quantised) norm of the document and ``length`` the
# length it decodes to (1/nrm^2); both are computed once per match row.

@dataclass(frozen=True)
class ModelParams:
    """

    avgdl_over: "all" divides the token count by every document (library
    behaviour), "with_terms" only by documents that have terms.
    coord / query_norm: the two query-level factors of the vector space model.
    """
    k1: float = BM25_K1
    b: float = BM25_B
    mu: float = DIRICHLET_MU
    lam: float = JM_LAMBDA
    norm_mode: str = "quantized"
    avgdl_over: str = "all"
    coord: bool = True
    query_norm: bool = True


def bm25_idf(n_docs: Column, df: Column) -> Column:
    return F.log(1.0 + (n_docs - df + 0.5) / (df + 0.5))


def vsm_idf(n_docs: Column, df: Column) -> Column:
    return F.log(n_docs.cast("double") / (df + 1.0)) + 1.0


def collection_prob(cf: Column, n_tokens: Column) -> Column:
    return (cf + 1.0) / (n_tokens + 1.0)


# -- per-row parts, with the per-term weights factored out ----------------

def bm25_saturation(tf, length, avgdl, p: ModelParams = ModelParams()) -> Column:
    return tf * (p.k1 + 1.0) / (tf + p.k1 * ((1.0 - p.b) + p.b * length / avgdl))


def lm_dirichlet_weight(tf, length, p_coll, p: ModelParams = ModelParams()) -> Column:
    s = F.log(1.0 + tf / (p.mu * p_coll)) + F.log(F.lit(p.mu) / (length + p.mu))
    return F.greatest(s, F.lit(0.0))


def lm_jm_weight(tf, length, p_coll, p: ModelParams = ModelParams()) -> Column:
    return F.log(1.0 + ((1.0 - p.lam) * tf / length) / (p.lam * p_coll))

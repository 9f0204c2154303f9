"""Ranking a whole query set against an index in one job.

queries (query_id, form, text)
  -> query terms   (qkey, term, qtf, df, cf, per-term weights, per-query VSM facts)
                   analyzer + count; df/cf from one scan of the term table
  -> postings      common terms' postings ∪ the query's   the buckets stream; only the rows of the
                   rare terms' lists                       query's rare terms are moved, into the buckets
  -> matches       postings ⋈ broadcast(query side)       no shuffle
  -> scores        one row per (qkey, doc)                 hash aggregate inside each doc-id
                                                           bucket (no exchange on a bucketed index)
  -> runs          top-k per (model, qkey)                 WindowGroupLimit, partial then final: the one
                                                           shuffle carries partial top-k rows; with many
                                                           buckets each sends its share of k, and one
                                                           whose last row is a winner is asked again;
                                                           of a large corpus only rows that reach the k-th
                                                           best score of a sample of its documents are sorted
  -> docno         late fetch after top-k                  ⋈ docs, smaller side broadcast

The query side is broadcast while its estimated size is within
``BROADCAST_QUERY_BYTES``; above it the joins shuffle on ``term``, with very common
terms salted.

``ranked_runs(..., skip=True)`` first finds, from the bounds of the terms' postings, the documents
that can be among the best k (see ``operators.skipping``), and scores only these.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawl.functions import scoring as S
from trawl.functions.analyzers import analyze
from trawl.operators import skipping
from trawl.operators.index import Index, estimated_bytes, list_part, list_rows
from trawl.operators.topk import numbered, top_k, top_k_of_buckets, top_k_per_group, worth_two_passes
from trawl.session import scratch_dir

# ---------------------------------------------------------------------------
# Query forms of a topic (field, query tag, run suffix) and
# run-id prefixes of the home-made model and the four library models.
FORMS = (("title", "Q0", "short"), ("desc", "Q1", "long"))
TFIDF_RUN_PREFIX = "myAlgo"
MODEL_RUN_PREFIX = {"bm25": "BM25", "vsm": "VSM", "lm_dirichlet": "LMDS", "lm_jm": "LMJMS"}
# Result depth of every ranked run.
DEFAULT_K = 1000
# ---------------------------------------------------------------------------
MODELS = tuple(MODEL_RUN_PREFIX)
ALL_SCORES = ("tfidf",) + MODELS  # keys of RANKERS

# Query texts up to this size (estimated) are broadcast as term rows, which take
# about ten times the bytes of the texts.
BROADCAST_QUERY_BYTES = 8 << 20
# Documents tables and deleted-id tables up to this size (estimated) are broadcast.
BROADCAST_TABLE_BYTES = 32 << 20
# Up to this many distinct terms of an ad-hoc query are pushed into the parquet scans.
PUSHDOWN_MAX_TERMS = 512
# Shuffle-join fallback: terms in at least this share of the documents are
# salted over SALT_BUCKETS partitions.
HOT_DF_FRACTION = 0.01
HOT_MIN_DF = 1000
SALT_BUCKETS = 64
# Largest hot-term list that is broadcast (at most postings / cut terms exist).
HOT_TERMS_MAX_ROWS = 1_000_000
# Buckets whose top-k rows are merged in one step.
MERGE_AT_ONCE = 256
# A sample bounds the scores from this many documents on, as a multiple of k.
SAMPLE_FROM = 16


FORM_TAGS = {field: (tag, suffix) for field, tag, suffix in FORMS}
FORM_TAGS["adhoc"] = ("Q0", "adhoc")


def query_forms(topics: DataFrame, forms: Sequence[str] = ("title", "desc")) -> DataFrame:
    """(query_id, title, desc) -> (query_id, form, text), one row per form."""
    chosen = [f[0] for f in FORMS if f[0] in forms]
    if not chosen:
        raise ValueError(f"forms must be among {[f[0] for f in FORMS]}")
    structs = [F.struct(F.lit(field).alias("form"), F.col(field).alias("text")) for field in chosen]
    return topics.select("query_id", F.explode(F.array(*structs)).alias("f")).select("query_id", "f.*")


# Query key: query id and form packed in one long, so the per-(query, doc)
# aggregation and the per-query window hash fixed-width keys only.
FORM_CODES = {"title": 0, "desc": 1, "adhoc": 2}
_FORM_SLOTS = 4


def _form_code() -> Column:
    code = F.create_map(*[x for f, c in FORM_CODES.items() for x in (F.lit(f), F.lit(c))])[F.col("form")]
    unknown = F.raise_error(F.concat(F.lit("unknown query form: "), F.coalesce("form", F.lit("null"))))
    return F.coalesce(code, unknown.cast("int"))


def qkey() -> Column:
    return F.col("query_id").cast("long") * _FORM_SLOTS + _form_code()


def unpack_qkey(c: str = "qkey") -> list:
    forms = F.array(*[F.lit(f) for f, _ in sorted(FORM_CODES.items(), key=lambda x: x[1])])
    form = F.element_at(forms, F.pmod(F.col(c), F.lit(_FORM_SLOTS)).cast("int") + 1)
    query_id = (F.col(c) - F.pmod(F.col(c), F.lit(_FORM_SLOTS))) / _FORM_SLOTS     # exact, also below zero
    return [query_id.cast("int").alias("query_id"), form.alias("form")]


def _form_tag(i: int):
    return F.create_map(*[x for form, tags in FORM_TAGS.items() for x in (F.lit(form), F.lit(tags[i]))])[F.col("form")]


def adhoc_queries(spark, text: str, query_id: int = 0) -> DataFrame:
    """A one-row query table for an ad-hoc query string."""
    return spark.range(1).select(F.lit(query_id).cast("int").alias("query_id"), F.lit("adhoc").alias("form"),
                                 F.lit(text).alias("text"))


def query_terms(queries: DataFrame, analyzer: str = "standard") -> DataFrame:
    """(query_id, form, term, qtf): distinct terms with their repetitions."""
    toks = queries.select("query_id", "form", F.explode_outer(analyze("text", analyzer)).alias("term")) \
        .filter(F.col("term").isNotNull())
    return toks.groupBy("query_id", "form", "term").agg(F.count(F.lit(1)).alias("qtf"))


class QuerySide:
    """Query terms with corpus statistics, as lazy joins.

    A query set is small next to the corpus (topics × distinct terms), and it is
    broadcast while the optimizer's size estimate of its texts is within
    ``BROADCAST_QUERY_BYTES`` (term rows are bounded by the texts); beyond
    that the joins shuffle on ``term``.  Building it starts no job.

    ``fetch``: for a single ad-hoc query, fetch its few distinct terms first and
    push them into the parquet scans of the term and postings tables
    (row-group skipping on the term-sorted files).
    """

    def __init__(self, index: Index, queries: DataFrame, exclude: DataFrame | None = None, fetch: bool = False):
        self.index = index
        self.exclude = exclude
        self.pushdown = None
        qt = query_terms(queries, index.analyzer)
        self.broadcast = estimated_bytes(queries) <= BROADCAST_QUERY_BYTES
        if fetch:
            rows = qt.select("term").distinct().limit(PUSHDOWN_MAX_TERMS + 1).collect()
            if len(rows) <= PUSHDOWN_MAX_TERMS:
                self.pushdown = sorted(r["term"] for r in rows)
        self.found = self._scan(index.terms).join(self.small(qt.select("term").distinct()), "term").select("term", "df", "cf")
        self.terms = qt.join(self.small(self.found), "term", "left").fillna(0, ["df", "cf"])
        self._weighted: DataFrame | None = None

    def small(self, df: DataFrame) -> DataFrame:
        return F.broadcast(df) if self.broadcast else df

    def _scan(self, df: DataFrame) -> DataFrame:
        return df.filter(F.col("term").isin(self.pushdown)) if self.pushdown is not None else df

    def weighted(self, vsm: bool = True) -> DataFrame:
        """Per (query, term): qkey, query_id, form, term, qtf, df, cf, the
        per-term model weights and (``vsm``) the per-query VSM facts.  Terms
        absent from the corpus are kept with df = 0 (they count in VSM's norm)."""
        if self._weighted is None:
            st = self.index.stats
            n, c = F.lit(st.n_docs), F.lit(st.tokens)
            w = self.terms
            df, cf, qtf = F.col("df"), F.col("cf"), F.col("qtf")
            vidf = S.vsm_idf(n, df)
            w = w.select(qkey().alias("qkey"), "query_id", "form", "term", "qtf", "df", "cf",
                         S.tfidf_idf(n, df).alias("w_tfidf"),
                         (qtf * S.bm25_idf(n, df)).alias("w_bm25"),
                         (qtf * vidf * vidf).alias("w_vsm"),
                         S.collection_prob(cf, c).alias("p_coll"))
            self._weighted = w
        if not vsm:
            return self._weighted
        per_query = self._weighted.groupBy("qkey").agg(
            F.sum("qtf").alias("clauses"),
            (F.lit(1.0) / F.sqrt(F.sum("w_vsm"))).alias("vsm_qnorm"))
        return self._weighted.join(per_query, "qkey")

    def _salted_join(self, postings: DataFrame, right: DataFrame) -> DataFrame:
        """Shuffle join on term for a query side too large to broadcast.

        A very common term would put a large share of all postings into one
        partition.  Terms with df >= HOT_DF_FRACTION of the documents are
        split: their postings get a salt (a hash of doc_id, SALT_BUCKETS
        values) and their query rows are repeated once per salt, so the join
        on (term, salt) spreads each hot term over SALT_BUCKETS partitions.
        There are at most postings / cut such terms, which is checked before
        they are broadcast; above the bound the plain join is left to AQE skew-join.
        """
        cut = max(HOT_MIN_DF, int(self.index.stats.n_docs * HOT_DF_FRACTION))
        hot = self.index.terms.filter(F.col("df") >= cut).select("term", F.lit(True).alias("hot"))
        if self.index.stats.postings // cut > HOT_TERMS_MAX_ROWS:       # no more terms can be that common
            return postings.join(right.drop("df"), "term")
        p = postings.join(F.broadcast(hot), "term", "left").select(
            *postings.columns,
            F.when(F.col("hot"), F.pmod(F.xxhash64("doc_id"), F.lit(SALT_BUCKETS))).otherwise(0)
            .cast("long").alias("salt"))
        q = right.drop("df").join(F.broadcast(hot), "term", "left")
        q = q.select(*[c for c in right.columns if c != "df"], F.explode(
            F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(SALT_BUCKETS - 1)).cast("array<long>"))
            .otherwise(F.array(F.lit(0).cast("long")))).alias("salt"))
        return p.join(q, ["term", "salt"]).drop("salt")

    def postings(self, chosen: DataFrame | None = None) -> DataFrame:
        """The postings among which the query's are: all of the common terms, and of the
        others the lists of the query's terms (of ``chosen``'s, if given), moved to their documents' buckets."""
        index = self.index
        if index.lists is None:
            return self._scan(index.postings)
        found = self.found if chosen is None else self.found.join(self.small(chosen.select("term").distinct()), "term", "left_semi")
        asked = found.filter(F.col("df") <= index.cut).select("term", list_part("term", index.list_parts).alias("part"))
        rare = list_rows(self._scan(index.lists).join(self.small(asked), ["part", "term"]))
        return self._scan(index.common).unionByName(rare.repartition(index.buckets, "doc_id"))

    def matches(self, vsm: bool = True, chosen: DataFrame | None = None, docs: DataFrame | None = None,
                share: int = 1) -> DataFrame:
        """One row per (query, term, doc) where the doc holds the term.

        ``chosen`` (qkey, term): of these terms only; ``docs`` (doc_id, qkeys): of these documents
        and queries only, met in the documents' buckets before the terms are joined; ``share``: of
        one in that many documents, by a hash, only.
        Deleted documents, those of the index and those of ``exclude`` (a table of
        doc ids), are dropped before scoring; statistics are unchanged,
        as with deletions that are not yet merged away.
        """
        right = self.weighted(vsm).filter(F.col("df") > 0).drop("query_id", "form", "cf")
        if chosen is not None:
            right = right.join(self.small(chosen), ["qkey", "term"], "left_semi")
        postings = self.postings(chosen)
        if share > 1:
            postings = postings.filter(F.pmod(F.xxhash64("doc_id"), F.lit(share)) == 0)
        if docs is not None:
            postings = postings.join(docs.hint("shuffle_hash"), "doc_id")
        if self.broadcast:
            m = postings.join(F.broadcast(right.drop("df")), "term")
        else:
            m = self._salted_join(postings, right)
        if docs is not None:
            m = m.filter(F.array_contains("qkeys", F.col("qkey"))).drop("qkeys")
        if self.index.deleted is not None:
            m = self._without(m, self.index.deleted)
        if self.exclude is not None:
            m = self._without(m, self.exclude.select("doc_id").distinct())
        return m

    def _without(self, m: DataFrame, ids: DataFrame) -> DataFrame:
        """``m`` without the documents of ``ids``: broadcast while that is small, else hashed bucket
        by bucket, to which the match rows are not moved, nor sorted."""
        if estimated_bytes(ids) <= BROADCAST_TABLE_BYTES:
            return m.join(F.broadcast(ids), "doc_id", "left_anti")
        return m.join(ids.hint("shuffle_hash"), "doc_id", "left_anti")


def _tfidf(st, p: S.ModelParams) -> Column:
    # Distinct query terms: repetitions do not count in the home-made model.
    return F.sum(S.tfidf_term(F.col("tf"), F.col("nrm"), F.col("w_tfidf")))


def _bm25(st, p: S.ModelParams) -> Column:
    sat = S.bm25_saturation(F.col("tf").cast("double"), F.col("length"), F.lit(st.avgdl_over(p.avgdl_over)), p)
    return F.sum(F.col("w_bm25") * sat)


def _vsm(st, p: S.ModelParams) -> Column:
    s = F.sum(F.col("w_vsm") * F.sqrt(F.col("tf").cast("double")) * F.col("nrm"))
    if p.coord:
        s = s * F.sum("qtf") / F.max("clauses")
    if p.query_norm:
        s = s * F.max("vsm_qnorm")
    return s


def _lm_dirichlet(st, p: S.ModelParams) -> Column:
    return F.sum(F.col("qtf") * S.lm_dirichlet_weight(F.col("tf").cast("double"), F.col("length"), F.col("p_coll"), p))


def _lm_jm(st, p: S.ModelParams) -> Column:
    return F.sum(F.col("qtf") * S.lm_jm_weight(F.col("tf").cast("double"), F.col("length"), F.col("p_coll"), p))


# Plug point for similarities: name -> (collection stats, params) -> an
# aggregate over the match table.  Per-term weights (w_tfidf, w_bm25, w_vsm,
# p_coll, clauses, vsm_qnorm) come from the query side; per row only the
# parts that depend on tf and the document's norm/length are computed.
RANKERS = {
    "tfidf": _tfidf,
    "bm25": _bm25,
    "vsm": _vsm,
    "lm_dirichlet": _lm_dirichlet,
    "lm_jm": _lm_jm,
}


def score_columns(index: Index, models: Sequence[str], params: S.ModelParams = S.ModelParams()) -> list:
    """Aggregate expressions over the match table, one per requested model."""
    return [RANKERS[m](index.stats, params).alias(m) for m in models]


def _check_models(models: Sequence[str]) -> None:
    unknown = set(models) - set(ALL_SCORES)
    if unknown or not models:
        raise ValueError(f"unknown models {sorted(unknown)}; known: {ALL_SCORES}")


def score(index: Index, queries: DataFrame, models: Sequence[str] = ALL_SCORES,
          params: S.ModelParams = S.ModelParams()) -> DataFrame:
    """(query_id, form, doc_id, <one column per model>) for every candidate document."""
    _check_models(models)
    scored = _score(index, QuerySide(index, queries), models, params)
    return scored.select(*unpack_qkey(), "doc_id", *models)


def _scorable(rows: DataFrame, keys: Sequence[str], vsm: bool, params: S.ModelParams) -> DataFrame:
    """``rows`` of the match table with what the rankers read."""
    nrm = S.norm(F.col("dl"), params.norm_mode)
    extra = ["clauses", "vsm_qnorm"] if vsm else []
    return rows.select(*keys, "tf", "qtf", "w_tfidf", "w_bm25", "w_vsm", "p_coll", *extra,
                       nrm.alias("nrm")).withColumn("length", F.lit(1.0) / (F.col("nrm") * F.col("nrm")))


def _score(index: Index, side: QuerySide, models: Sequence[str], params: S.ModelParams, only=None,
           chosen: DataFrame | None = None, docs: DataFrame | None = None, share: int = 1) -> DataFrame:
    """(qkey, doc_id, <models>): one hash aggregate, partial then final."""
    vsm = "vsm" in models
    m = _scorable(side.matches(vsm, chosen, docs, share), ["qkey", "doc_id"], vsm, params)
    if only is not None:
        m = only(m)
    return m.groupBy("qkey", "doc_id").agg(*score_columns(index, models, params))


def _limits(index: Index, side: QuerySide, models: Sequence[str], params: S.ModelParams) -> DataFrame:
    """(qkey, term, df, <models>): the most that a term can add to a document's score.

    Every model grows with tf and with the document's norm or against it, so its largest
    value is at the term's largest tf and shortest or longest document.
    """
    vsm = "vsm" in models
    bounds = index.terms.join(side.small(side.found.select("term")), "term", "left_semi").select("term", "max_tf", "min_dl", "max_dl")
    rows = side.weighted(vsm).filter(F.col("df") > 0).join(side.small(bounds), "term")
    corners = rows.withColumn("tf", F.col("max_tf")).withColumn("dl", F.explode(F.array_distinct(F.array("min_dl", "max_dl"))))
    keys = ["qkey", "term", "df"]
    at_corner = _scorable(corners, [*keys, "dl"], vsm, params).groupBy(*keys, "dl").agg(*score_columns(index, models, params))
    return at_corner.groupBy(*keys).agg(*[F.max(m).alias(m) for m in models])


def possible_winners(index: Index, side: QuerySide, models: Sequence[str], k: int,
                     params: S.ModelParams = S.ModelParams()) -> DataFrame:
    """(doc_id, qkeys): the documents that can be among the best ``k`` of a query for one of the models.

    All that are, and few others: see :mod:`trawl.operators.skipping`.  What each step finds is
    written to the scratch folder (three jobs).
    """
    spark = index.docs.sparkSession

    def stored(df: DataFrame, name: str) -> DataFrame:
        path = scratch_dir(spark, name)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    # The share of matched clauses is one at most, and known only with all terms.
    loose = replace(params, coord=False)
    limits = stored(_limits(index, side, models, loose), "term-limits")
    partial = _score(index, side, models, params, chosen=skipping.seeds(limits, models, k))
    marked = stored(skipping.essential(limits, side.small(skipping.thresholds(partial, models, k)), models), "essential-terms")
    part = _score(index, side, models, loose, chosen=marked.filter("essential").select("qkey", "term"))
    return stored(skipping.survivors(part, side.small(skipping.rests(marked, models)), models), "possible-winners")


def sample_share(n_docs: int, k: int) -> int:
    """One in how many documents is scored first, or 1: with one in s, n / s are scored twice, and about k * s pass."""
    return math.isqrt(n_docs // k) if n_docs >= SAMPLE_FROM * k else 1


def _sample_bounds(index: Index, side: QuerySide, models: Sequence[str], k: int, params: S.ModelParams, share: int) -> DataFrame:
    """(qkey, t_<models>): the k-th best scores among one in ``share`` documents, written to the scratch folder (a job).

    The k-th best of some documents is no better than that of all, so no winner, tied or not, scores less.  Null, or
    without a row, where fewer of the sample match.
    """
    bounds = skipping.thresholds(_score(index, side, models, params, share=share), models, k)
    path = scratch_dir(index.docs.sparkSession, "sample-bounds")
    bounds.coalesce(1).write.parquet(path)
    return index.docs.sparkSession.read.schema(bounds.schema).parquet(path)


def _bucket(index: Index) -> Column:
    """Bucket of a document: what the bucketed tables and hash exchanges use."""
    return F.pmod(F.hash("doc_id"), F.lit(index.buckets))


def candidate_docs(index: Index, queries: DataFrame) -> DataFrame:
    """Distinct (query_id, form, doc_id) holding at least one query term."""
    m = QuerySide(index, queries).matches(vsm=False).select("qkey", "doc_id").distinct()
    return m.select(*unpack_qkey(), "doc_id")


def with_docno(index: Index, top: DataFrame) -> DataFrame:
    """Late fetch of the stored document number, after top-k.

    A small documents table is broadcast.  Otherwise the join is on the
    table's bucket key: the documents stay where they are, and adaptive execution
    broadcasts the top-k rows instead when they turn out small.
    """
    docs = index.docs.select("doc_id", "docno")
    return top.join(F.broadcast(docs) if estimated_bytes(docs) <= BROADCAST_TABLE_BYTES else docs, "doc_id")


def _run_rows(df: DataFrame, run_id) -> DataFrame:
    return df.select(F.col("query_id").cast("int").alias("query_id"), "q", "docno",
                     F.col("rank").cast("int").alias("rank"), F.col("score").cast("double").alias("score"),
                     run_id.alias("run_id"))


def ranked_runs(index: Index, queries: DataFrame, models: Sequence[str], k: int = DEFAULT_K,
                params: S.ModelParams = S.ModelParams(), run_prefix: dict | None = None,
                exclude: DataFrame | None = None, fetch: bool = False, skip: bool = False) -> DataFrame:
    """Run table for each model × form: query_id, q, docno, rank, score, run_id.

    ``exclude``: optional table with a ``doc_id`` column of deleted documents;
    ``fetch``: see :class:`QuerySide`; ``skip``: score only documents that can be among the best
    k (the same run; it pays where k is a small part of what a query matches).
    """
    if k <= 0:
        raise ValueError("k must be positive")
    _check_models(models)
    prefixes = dict(MODEL_RUN_PREFIX, tfidf=TFIDF_RUN_PREFIX, **(run_prefix or {}))
    side = QuerySide(index, queries, exclude, fetch)
    docs = possible_winners(index, side, models, k, params) if skip else None
    share = sample_share(index.stats.n_docs, k) if side.broadcast and not skip and not fetch else 1
    bounds = _sample_bounds(index, side, models, k, params, share) if share > 1 else None

    # Models are numbered 0..n-1 for the window key (cheaper to sort than
    # names) and turned into run ids after top-k.
    def scored(only=None) -> DataFrame:
        rows = _score(index, side, models, params, only, docs=docs)
        if bounds is None:
            if len(models) == 1:
                return rows.select("qkey", "doc_id", F.lit(0).alias("model"), F.col(models[0]).alias("score"))
            pairs = ", ".join(f"{i}, `{m}`" for i, m in enumerate(models))
            return rows.selectExpr("qkey", "doc_id", f"stack({len(models)}, {pairs}) as (model, score)")
        triples = ", ".join(f"{i}, `{m}`, `t_{m}`" for i, m in enumerate(models))
        each = rows.join(F.broadcast(bounds), "qkey", "left").selectExpr(
            "qkey", "doc_id", f"stack({len(models)}, {triples}) as (model, score, bound)")
        return each.filter(F.coalesce(F.col("score") >= F.col("bound") - skipping.MARGIN, F.lit(True))).drop("bound")

    def again(cells: DataFrame) -> DataFrame:
        pairs = cells.select("qkey", "_bucket").distinct()
        return scored(lambda m: m.withColumn("_bucket", _bucket(index)).join(pairs, ["qkey", "_bucket"], "left_semi"))

    # With many buckets the rows they send meet in two steps.
    parts = math.isqrt(index.buckets) if index.buckets > MERGE_AT_ONCE else 1
    group = ["model", "qkey"]
    if index.buckets > 1 and worth_two_passes(k, index.buckets):
        top = top_k_of_buckets(scored(), again, k, group, _bucket(index), index.buckets, parts=parts)
    else:
        top = top_k_per_group(scored(), k, group, parts=parts)
    run = with_docno(index, top).select("*", *unpack_qkey()).withColumn("q", _form_tag(0))
    prefix = F.array(*[F.lit(prefixes[m]) for m in models])
    return _run_rows(run, F.concat(F.element_at(prefix, F.col("model") + 1), F.lit("_"), _form_tag(1)))


def score_all_docs(index: Index, text: str, model: str = "tfidf",
                   params: S.ModelParams = S.ModelParams()) -> DataFrame:
    """(doc_id, score) of one ad-hoc query for *every* document, 0 where nothing matches.

    Documents ⟕ scores is an equi-join on doc_id; AQE turns it into a
    broadcast when the measured score side is small, else it shuffles.
    """
    _check_models([model])
    queries = adhoc_queries(index.docs.sparkSession, text)
    scored = _score(index, QuerySide(index, queries, fetch=True), [model], params).select(
        "doc_id", F.col(model).alias("score"))
    return index.docs.select("doc_id").join(scored, "doc_id", "left").select(
        "doc_id", F.coalesce(F.col("score"), F.lit(0.0)).alias("score"))


def tfidf_all_docs(index: Index, text: str, params: S.ModelParams = S.ModelParams()) -> DataFrame:
    """K1: (doc_id, score) for all documents, zeros kept, in doc id order."""
    s = score_all_docs(index, text, "tfidf", params)
    return s.select("doc_id", F.round("score", 6).alias("score")).orderBy("doc_id")


def topk_all_docs(index: Index, queries: DataFrame, model: str = "tfidf", k: int = DEFAULT_K,
                  params: S.ModelParams = S.ModelParams(), fetch: bool = False) -> DataFrame:
    """(query_id, form, doc_id, rank, score): best k over *all* documents for every query, zero scores included.

    A query that matches fewer than k documents is filled up with the smallest ids that it does not
    match.  Those are among the k smallest ids of the corpus, as fewer than k of
    these can match, so one array of k ids serves all queries: no document is paired with a query
    it does not match, but for the rows that are returned.  Queries without any term are filled too.
    ``fetch``: see :class:`QuerySide`.
    """
    if k <= 0:
        raise ValueError("k must be positive")
    _check_models([model])
    scored = _score(index, QuerySide(index, queries, fetch=fetch), [model], params)
    best = top_k_per_group(scored.select("qkey", "doc_id", F.col(model).alias("score")), k, ["qkey"]).select(
        "qkey", "doc_id", F.col("rank").cast("int").alias("rank"), "score")
    smallest = index.docs.select("doc_id").orderBy("doc_id").limit(k).agg(F.sort_array(F.collect_list("doc_id"))).scalar()
    found = best.groupBy("qkey").agg(F.count("*").cast("int").alias("n"), F.collect_list("doc_id").alias("ids"))     # k ids at most
    every = queries.select(qkey().alias("qkey")).distinct()
    # One row per query on either side.
    short = every.join(found, "qkey", "left").where(F.col("n").isNull() | (F.col("n") < k))
    n = F.coalesce("n", F.lit(0))
    unmatched = F.array_except(smallest, F.coalesce("ids", F.array().cast("array<bigint>")))
    fill = short.select("qkey", n.alias("n"), F.posexplode(F.slice(unmatched, F.lit(1), F.lit(k) - n)).alias("pos", "doc_id")).select(
        "qkey", "doc_id", (F.col("n") + F.col("pos") + 1).cast("int").alias("rank"), F.lit(0.0).alias("score"))
    return best.unionByName(fill).select(*unpack_qkey(), "doc_id", "rank", "score")


def tfidf_topk_all_docs(index: Index, text: str, k: int = 10,
                        params: S.ModelParams = S.ModelParams()) -> DataFrame:
    """K2: best k over all documents (zero scores may fill the list),
    listed lowest score first."""
    best = topk_all_docs(index, adhoc_queries(index.docs.sparkSession, text), "tfidf", k, params, fetch=True)
    return best.orderBy(F.desc("rank")).select("doc_id", "score")


def all_docs_listing(index: Index, text: str, params: S.ModelParams = S.ModelParams()) -> DataFrame:
    """K1 as the table that is listed: (position, doc_id, score) from 1 in doc id order."""
    scores = score_all_docs(index, text, "tfidf", params).select("doc_id", F.round("score", 6).alias("score"))
    return numbered(scores, ["doc_id"], "position", start=1).select("position", "doc_id", "score")


def topk_listing(index: Index, text: str, k: int = 10, params: S.ModelParams = S.ModelParams()) -> DataFrame:
    """K2 as the table that is listed: (position, doc_id, score) from 1, the lowest of the best k first."""
    best = topk_all_docs(index, adhoc_queries(index.docs.sparkSession, text), "tfidf", k, params, fetch=True)
    return numbered(best.select("doc_id", "rank", "score"), [F.desc("rank")], "position", start=1).select("position", "doc_id", "score")


def runs_at_depths(index: Index, queries: DataFrame, depths: DataFrame, models: Sequence[str],
                   params: S.ModelParams = S.ModelParams()) -> tuple[DataFrame, DataFrame]:
    """Runs with a depth of their own for every query, and the rejects.

    ``depths``: (query_id, k), one row per query.  The rows of a query end at its k; queries whose k is null or
    not positive are not ranked and are rejects (query_id, reason); queries without a depth are left out.
    """
    known = depths.select(F.col("query_id").cast("int").alias("query_id"), F.col("k").cast("long").alias("k"))
    good = known.where("k > 0")
    deepest = good.agg(F.max("k")).first()[0]
    asked = queries.join(good.select("query_id"), "query_id", "left_semi")
    runs = ranked_runs(index, asked, models, int(deepest or 1), params)
    runs = runs.join(good, "query_id").where("rank <= k").drop("k")
    reason = F.concat(F.lit("k must be positive, not "), F.coalesce(F.col("k").cast("string"), F.lit("null")))
    return runs, known.where("k is null or k <= 0").select("query_id", reason.alias("reason"))

"""Source divergence audit: how far each source of a language is from the others.

Term counts come from a token-start pointer sort.  A shard is one Arrow batch:
its texts stay where they are in the batch's buffer, and every word start
becomes a pointer into it.  The pointers are sorted by multikey quicksort with eight
bytes as one character: a slice is quicksorted on the character at its depth,
and runs of equal characters whose words go on become slices of the next
depth.  An equal run at the end is a term; its length, its distinct documents and its
documents' groups are the term's count, document frequency and source counts.  Spark adds the
shards up by (lang, source, term).

A term's divergence needs every two sources of a language once per term.  The kept
counts are dealt by a hash of the term into blocks, and the sources of a language into
blocks of ``SOURCES``; a task holds the terms of one block for two source
blocks, and returns one sum per pair of sources, so nothing is emitted per term and
pair.  All arithmetic is on integers.

Cases: null text, lang and source are ''.  Rows are documents: repeated rows and
repeated ids count each time, ids are not read.  A group without terms takes part in
the pairs; a language without kept terms has pairs of value 0 and no terms.  Ties
go to the smaller item by its bytes.  Very long texts and words are sorted like
others (a word of n bytes takes n / 8 depths).  Empty tables give an
empty result, other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trawl.llm import common

MIN_DOCS = 10
TOP_TERMS = 10
SCALE = 1_000_000_000
SOURCES = 512                  # sources of a block: two blocks' pair sums are 2 MB
TERM_ROWS = 200_000            # counts of a term block, about
SLICE_BYTES = 4 << 20          # text sorted at once

# Bytes of a term, lower-cased; 0 for all others.
_TERM = np.arange(256, dtype=np.uint8)
_TERM[[b for b in range(128) if not chr(b).isalpha()]] = 0
_TERM[65:91] += 32


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string array and the offsets of its values in them, not copied."""
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8), at.astype(np.int64)


def word_pointers(buf: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the words of ``buf``; a word ends where a text of ``starts`` begins."""
    inside = np.empty(len(buf) + 1, dtype=bool)
    inside[:-1], inside[-1] = buf != 0, False
    before = np.concatenate(([False], inside[:-1]))
    before[starts] = False
    begin = np.flatnonzero(inside & ~before)
    after = np.concatenate((inside[1:], [False]))
    after[starts[starts > 0] - 1] = False
    return begin, np.flatnonzero(inside & ~after) + 1 - begin


def multikey_sort(buf: np.ndarray, ptr: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the words at ``ptr`` and, in that order, whether each begins a run of equal words."""
    padded = np.concatenate((buf, np.zeros(8, np.uint8)))
    eight = np.ndarray((len(buf) + 1,), ">u8", padded, strides=(1,))
    order, first = np.arange(len(ptr)), np.zeros(len(ptr), dtype=bool)
    first[:1] = True
    at, depth, run = np.arange(len(ptr)), 0, np.zeros(len(ptr), dtype=np.int64)
    while len(at):
        own = order[at]
        left = size[own] - depth
        shift = (8 * np.maximum(8 - left, 0)).astype(np.uint64)
        key = eight[ptr[own] + depth].astype(np.uint64) >> shift << shift
        by = np.lexsort((key, run)) if depth else np.argsort(key)
        own, key, left = own[by], key[by], left[by]
        order[at] = own                                   # ``run`` is sorted, so slices keep their places
        change = np.ones(len(at), dtype=bool)
        change[1:] = (key[1:] != key[:-1]) | (run[1:] != run[:-1])
        first[at] |= change
        # A word shorter than this character ends in it (no byte of a word is 0), so its run is one of equal words.
        on = left >= 8
        run, at, depth = (np.cumsum(change) - 1)[on], at[on], depth + 8
    return order, first


def shard_counts(texts: pa.Array, group: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Terms, and (term, group, occurrences, documents) of the texts; ``group`` numbers each text's group."""
    raw, offsets = text_buffer(texts)
    buf = _TERM[raw[offsets[0]:offsets[-1]]]
    starts = offsets[:-1] - offsets[0]
    starts = starts[starts < len(buf)]
    ptr, size = word_pointers(buf, np.unique(starts))
    if not len(ptr):
        none = np.empty(0, np.int64)
        return [], none, none, none, none
    order, first = multikey_sort(buf, ptr, size)
    doc = np.searchsorted(offsets[1:] - offsets[0], ptr, side="right")[order]
    term = np.cumsum(first) - 1
    # One number per (term, document), sorted: equal ones are the occurrences.
    pair, n = np.unique(term * len(texts) + doc, return_counts=True)
    term, doc = pair // len(texts), pair % len(texts)
    groups = int(group.max()) + 1
    cell, of = np.unique(term * groups + group[doc], return_inverse=True)
    heads = order[first]
    words = [buf[p:p + s].tobytes() for p, s in zip(ptr[heads], size[heads], strict=True)]
    return (words, cell // groups, cell % groups, np.bincount(of, weights=n).astype(np.int64), np.bincount(of))


def _slices(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows of a batch in runs of about ``SLICE_BYTES`` of text."""
    _, offsets = text_buffer(part.column(2))
    at = 0
    while at < part.num_rows:
        to = int(np.searchsorted(offsets, offsets[at] + SLICE_BYTES, side="right")) - 1
        to = min(max(to, at + 1), part.num_rows)
        yield part.slice(at, to - at)
        at = to


def term_counts(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """lang, source, term, n, df: occurrences and documents of every term in every group."""
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a)
                         for c, a in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in parts:
            for part in _slices(whole):
                keys = pd.MultiIndex.from_arrays([part.column(0).to_pylist(), part.column(1).to_pylist()])
                group, names = keys.factorize()
                words, term, of, n, df = shard_counts(part.column(2), group)
                yield pa.RecordBatch.from_arrays([
                    pa.array([x[0] for x in names], pa.string()).take(pa.array(of)),
                    pa.array([x[1] for x in names], pa.string()).take(pa.array(of)),
                    pa.array(words, pa.binary()).cast(pa.string()).take(pa.array(term)),
                    pa.array(n, pa.int64()), pa.array(df, pa.int64())], names=["lang", "source", "term", "n", "df"])

    counted = common.map_arrow(rows, count, "lang string, source string, term string, n bigint, df bigint")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))


def probability(n: str, total: str, terms: str) -> Column:
    """1 + floor(SCALE * (n + 2) / (total + 2 * terms)) of columns, exact for any 64-bit counts; 1 without terms."""
    share = (f"cast({n} + 2 as decimal(19,0)) * cast({SCALE} as decimal(10,0)) div "
             f"(cast({total} as decimal(20,0)) + cast(2 as decimal(1,0)) * cast({terms} as decimal(19,0)))")
    return F.expr(f"if({terms} = 0, 1L, 1L + {share})")


def _small(df: DataFrame, row_bytes: int = 128) -> DataFrame:
    """``df`` with a broadcast hint if its counted rows are few; otherwise Spark shuffles."""
    return F.broadcast(df) if df.count() * row_bytes <= common.BROADCAST_BYTES else df


def _pair_sums(frame: pd.DataFrame) -> pd.DataFrame:
    """One row for every two sources of a task's two blocks: the sum, over the terms of the
    task, of the divergence less that of two absent terms; and the latter."""
    heads, rows = frame[frame["term"].isna()], frame[frame["term"].notna()]
    names, base = heads["source"].to_numpy(), heads["p"].to_numpy(np.int64)
    block, crossed = heads["sb"].to_numpy(), bool(frame["bi"].iloc[0] != frame["bj"].iloc[0])
    place = pd.Index(names).get_indexer(rows["source"])
    term = pd.factorize(rows["term"])[0]
    by = np.argsort(term, kind="stable")
    term, place, p = term[by], place[by], rows["p"].to_numpy(np.int64)[by]
    out = []
    for a in range(len(names)):
        others = np.flatnonzero(block != block[a]) if crossed else np.arange(a + 1, len(names))
        if crossed and block[a] != frame["bi"].iloc[0] or not len(others):
            continue
        out.append((a, others, np.zeros(len(others), np.int64),
                    (base[a] - base[others]) ** 2 // (base[a] + base[others])))
    step = max(1, (1 << 20) // max(1, len(names)))
    terms = int(term[-1]) + 1 if len(term) else 0
    for low in range(0, terms, step):
        s, e = np.searchsorted(term, [low, low + step])
        dense = np.repeat(base[None, :], min(step, terms - low), axis=0)
        dense[term[s:e] - low, place[s:e]] = p[s:e]
        for a, others, total, absent in out:
            x, y = dense[:, a, None], dense[:, others]
            total += ((x - y) ** 2 // (x + y)).sum(axis=0) - absent * len(dense)
    first = np.concatenate([np.full(len(o), a) for a, o, _, _ in out]) if out else np.empty(0, int)
    pick = (lambda k: np.concatenate([x[k] for x in out])) if out else (lambda k: np.empty(0, np.int64))
    return pd.DataFrame({"lang": frame["lang"].iloc[0], "a": names[first], "b": names[pick(1).astype(int)],
                         "part": pick(2), "absent": pick(3), "terms": heads["terms"].iloc[0] if len(heads) else 0})


def _pairs(kept: DataFrame, groups: DataFrame, langs: DataFrame) -> DataFrame:
    """lang, source, item, value for every two sources of a language, in both directions."""
    spark = kept.sparkSession
    langs = langs.select("lang", "terms", F.greatest(F.lit(1), F.ceil(F.col("rows") / TERM_ROWS)).cast("int").alias("tbs"),
                         F.ceil(F.col("sources") / SOURCES).cast("int").alias("sbs"))
    langs = _small(common.written(langs, "divergence-langs"))
    sb = F.pmod(F.xxhash64("source"), F.col("sbs")).cast("int")
    tb = F.pmod(F.xxhash64("term"), F.col("tbs")).cast("int")
    base = groups.withColumn("p", probability("0L", "total", "terms")).select("lang", "source", "p", "terms").join(
        langs.drop("terms"), "lang")
    heads = base.select("lang", F.explode(F.sequence(F.lit(0), F.col("tbs") - 1)).alias("tb"), sb.alias("sb"), "sbs", "source",
                        F.lit(None).cast("string").alias("term"), "p", "terms")
    rows = kept.join(langs.drop("terms"), "lang").select(
        "lang", tb.alias("tb"), sb.alias("sb"), "sbs", "source", "term", "p", F.lit(0).cast("bigint").alias("terms"))
    other = F.explode(F.sequence(F.lit(0), F.col("sbs") - 1))
    dealt = heads.unionByName(rows).withColumn("other", other).select(
        "lang", "tb", F.least("sb", "other").alias("bi"), F.greatest("sb", "other").alias("bj"), "sb", "source", "term", "p", "terms")
    keys = ["lang", "tb", "bi", "bj"]
    dealt = dealt.repartition(common.partitions(spark), *keys).sortWithinPartitions(*keys)

    def sums(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in common.whole_groups(parts, keys):
            bounds = common.run_bounds(part, keys)
            for s, e in zip(bounds[:-1], bounds[1:], strict=True):
                yield _pair_sums(part.iloc[s:e])

    found = common.map_pandas(dealt, sums, "lang string, a string, b string, part bigint, absent bigint, terms bigint")
    value = F.sum("part") + F.max("terms") * F.max("absent")
    one = found.groupBy("lang", "a", "b").agg(value.alias("value"))
    both = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
                             F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    return one.select("lang", both.alias("x"), "value").select("lang", "x.source", "x.item", "value")


def audit(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text",
          min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank.

    ``pair``: the divergence of a source from each other source of its language;
    ``term``: the ``top`` terms in which a source exceeds its language most.
    """
    counts = common.written(term_counts(docs, lang_col, source_col, text_col), "term-counts")
    of_lang = counts.groupBy("lang", "term").agg(F.sum("n").alias("all"), F.sum("df").alias("df")).where(F.col("df") >= min_docs)
    of_lang = common.written(of_lang.select("lang", "term", "all"), "kept-terms")
    kept = common.written(counts.select("lang", "source", "term", "n").join(_small(of_lang, 96), ["lang", "term"]), "kept-counts")

    names = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in ((lang_col, "lang"), (source_col, "source"))]
    sizes = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("rows"))
    groups = docs.select(*names).distinct().join(sizes, ["lang", "source"], "left").fillna(0, ["total", "rows"])
    by_lang = of_lang.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("all").alias("whole"))
    groups = groups.join(by_lang, "lang", "left").fillna(0, ["terms", "whole"])
    groups = common.written(groups, "divergence-groups")
    langs = groups.groupBy("lang").agg(F.max("terms").alias("terms"), F.sum("rows").alias("rows"), F.count("*").alias("sources"))

    kept = kept.join(_small(groups.drop("rows")), ["lang", "source"]).withColumn("p", probability("n", "total", "terms"))
    lead = kept.withColumn("q", probability("`all`", "whole", "terms")).where("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
        F.expr("(p - q) * (p - q) div (p + q)").alias("value"))
    pairs = _pairs(kept.select("lang", "source", "term", "p"), groups, langs).select(
        "lang", "source", F.lit("pair").alias("part"), "item", "value")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    lead = lead.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return pairs.withColumn("rank", F.row_number().over(order)).unionByName(lead)


_TERMS_RE = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_P = "CAST(1 + CAST({s} AS HUGEINT) * ({n} + 2) // ({t} + 2 * v) AS BIGINT)"

ORACLE_SQL = f"""WITH docs AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
words AS (SELECT row, lang, source, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '{_TERMS_RE}')) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS whole FROM words GROUP BY lang, term HAVING count(DISTINCT row) >= {MIN_DOCS}),
langs AS (SELECT lang, count(*) AS v, sum(whole) AS total FROM kept GROUP BY lang),
grp AS (SELECT DISTINCT lang, source FROM docs),
n AS (SELECT w.lang, w.source, w.term, count(*) AS n FROM words w JOIN kept USING (lang, term) GROUP BY ALL),
sums AS (SELECT lang, source, sum(n) AS total FROM n GROUP BY ALL),
p AS (SELECT g.lang, g.source, k.term, coalesce(n.n, 0) AS n,
        {_P.format(s=SCALE, n="coalesce(n.n, 0)", t="coalesce(s.total, 0)")} AS p,
        {_P.format(s=SCALE, n="k.whole", t="l.total")} AS q
      FROM grp g JOIN kept k ON g.lang = k.lang JOIN langs l ON g.lang = l.lang
      LEFT JOIN n ON n.lang = g.lang AND n.source = g.source AND n.term = k.term
      LEFT JOIN sums s ON s.lang = g.lang AND s.source = g.source),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS BIGINT) AS value
          FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
every AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0) AS value
          FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN pairs x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
lead AS (SELECT lang, source, 'term' AS part, term AS item, CAST((p - q) * (p - q) // (p + q) AS BIGINT) AS value
         FROM p WHERE n > 0 AND p > q),
both_parts AS (SELECT * FROM every UNION ALL SELECT * FROM lead)
SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM both_parts)
WHERE part = 'pair' OR rank <= {TOP_TERMS}"""

"""Personal data: checked base patterns and bootstrapped contextual extraction.

Base spans come from fixed expressions (email, ip, card, phone), leftmost and
non-overlapping per kind, each match checked once.  They are the seeds of the
bootstrap: a mention's lexical patterns are the two words before it, and the
word before with the word after it.  Candidates are tokens with a digit, runs
of numbers and addresses with the signs written out.  Until a round finds
nothing new, Spark scores the bipartite graph of patterns and mentioned strings: a
pattern's confidence for a kind is the score of its known strings of the kind
against that of the strings that contradict it (strings of other kinds, and by half
those whose shape does not fit the kind); other unknown strings do not count.  A string's
score is one minus the product of its patterns' doubts, where a shape that does not
fit halves a confidence, and strings that reach ``LEAST_SCORE`` seed the next round.
Patterns need ``LEAST_SUPPORT`` different known strings.  All mentions of the strings
found this way are added as spans of the pattern's kind; base spans stay.

Only DataFrame functions are used.  The texts are read once; spans,
candidates and contexts are written, and every later step works on those.
``held_out`` measures discovery: a seeded share of the base strings is hidden and looked for.
Positions are code points.  They are sums of the lengths of matches and of what
lies between, taken in blocks so that a text full of matches stays cheap.  The
expressions are the plain ones with starts inside a run of characters ruled out
and no backtracking, so a long run costs its length, not its square.

Cases: null text is empty and has no spans; repeated rows get equal
results; rows with null ids are rows like any other; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawl.llm import common

# The base expressions.
_LOCAL = "[A-Za-z0-9._%+-]"
EMAIL = rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)"
CARD = r"[0-9](?:[\x20-]?+[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
KINDS = ("email", "ip", "card", "phone")

_TOKEN = "[0-9A-Za-z._%+@/-]"
_AT, _DOT = (rf"(?:\x20?+[\[({{<]\x20?+{w}\x20?+[\])}}>]\x20?+|\x20{w}\x20)" for w in ("[aA][tT]", "[dD][oO][tT]"))
_DIGIT_INSIDE = "(?=[A-Za-z._%+@/-]*+[0-9])"
CANDIDATE = "|".join((
    rf"(?<!{_LOCAL}){_LOCAL}++{_AT}[A-Za-z0-9-]++(?:(?:\.|{_DOT})[A-Za-z0-9-]++)++",
    rf"(?<!{_TOKEN}){_DIGIT_INSIDE}(?=[0-9._%+@/-]*+[A-Za-z])[._%+@/-]*+[0-9A-Za-z]++(?:[._%+@/-]++[0-9A-Za-z]++)*+",
    rf"(?<!{_TOKEN})[(]?+[+]?+[0-9]++(?:[\x20().-]{{1,3}}+[0-9]++(?![A-Za-z]))++",
    rf"(?<!{_TOKEN}){_DIGIT_INSIDE}[._%+@/-]*+[0-9]++(?:[._%+@/-]++[0-9]++)*+"))
CONTEXT_CHARS = 48
LEAST_SUPPORT = 5
LEAST_CONFIDENCE = 0.9
LEAST_SCORE = 0.9
MISFIT = 0.5           # weight of a string whose shape does not fit the kind
BLOCK = 128


def _digits(said: Column) -> Column:
    return F.regexp_replace(said, "[^0-9]", "")


def _passes(kind: str, said: Column) -> Column:
    if kind == "ip":
        return said.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")
    if kind == "card":
        return F.length(_digits(said)).between(16, 19) & F.call_function("luhn_check", _digits(said))
    if kind == "phone":
        return F.length(_digits(said)).between(8, 15)
    return F.lit(True)


def _passing(kind: str) -> Column:
    return F.filter(kind, lambda m: _passes(kind, m["said"]))


def _sums(values: Column) -> Column:
    """Running sums of an array of integers, by blocks."""
    def total(part: Column) -> Column:
        return F.aggregate(part, F.lit(0), lambda a, x: a + x)

    def block(b: Column) -> Column:
        return F.slice(values, b * BLOCK + 1, F.lit(BLOCK))

    numbers = F.sequence(F.lit(0), F.floor((F.size(values) - 1) / BLOCK).cast("int"))
    totals = F.transform(numbers, lambda b: total(block(b)))

    def run(b: Column) -> Column:
        return F.transform(block(b), lambda x, j: total(F.slice(totals, F.lit(1), b)) + total(F.slice(block(b), F.lit(1), j + 1)))

    return F.when(F.size(values) > 0, F.flatten(F.transform(numbers, run))).otherwise(F.array().cast("array<int>"))


def _fits(said: Column) -> Column:
    """Whether a candidate has the kinds' shapes, as a bit per kind."""
    numbers = F.length(_digits(said))
    plain = ~said.rlike("[A-Za-z@]")
    shapes = (said.rlike("@|(?i)\\bat\\b"), plain & said.rlike("^[^0-9]*+(?:[0-9]++[^0-9]*+){4,}+$"),
              plain & numbers.between(12, 19), plain & numbers.between(7, 15))
    return sum((F.when(c, F.lit(1 << i)).otherwise(0) for i, c in enumerate(shapes)), F.lit(0))


def _contexts(before: Column, after: Column) -> Column:
    """The lexical patterns of a mention, lower-cased, digits as 0; a side without a word makes none."""
    def plain(words: Column) -> Column:
        return F.lower(F.regexp_replace(words, "[0-9]", "0"))

    tail, head = F.right(before, F.lit(CONTEXT_CHARS)), F.left(after, F.lit(CONTEXT_CHARS))
    two = F.regexp_extract(tail, r"(?:^|\s)((?:\S+\s+)?\S*\s*)$", 1)
    one, right = F.regexp_extract(tail, r"(\S+\s*)$", 1), F.regexp_extract(head, r"^(\s*\S+)", 1)
    left = F.when(F.trim(two) != "", F.concat(F.lit("<\t"), plain(two)))
    both = F.when((one != "") & (right != ""), F.concat(F.lit(">\t"), plain(one), F.lit("\t"), plain(right)))
    return F.array_compact(F.array(left, both))


def _mentions(df: DataFrame, name: str, pattern: str, guard: Column) -> DataFrame:
    """Add ``name``: array<struct<start, end, said, patterns>> of all matches in ``text``."""
    none = F.array().cast("array<string>")
    df = df.withColumn("_m", F.when(guard, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).otherwise(none))
    df = df.withColumn("_p", F.when(F.size("_m") > 0, F.split("text", pattern, -1)).otherwise(none))
    steps = F.transform("_m", lambda m, i: F.length(F.get("_p", i)) + F.when(i > 0, F.length(F.get("_m", i - 1))).otherwise(0))
    df = df.withColumn("_l", steps).withColumn("_s", _sums(F.col("_l")))
    mention = F.transform("_m", lambda m, i: F.struct(
        F.get("_s", i).alias("start"), (F.get("_s", i) + F.length(m)).alias("end"), m.alias("said"),
        _contexts(F.get("_p", i), F.get("_p", i + 1)).alias("patterns")))
    return df.withColumn(name, mention).drop("_m", "_p", "_l", "_s")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, row (a hash of the text), base and candidate mentions of every row."""
    df = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    text = F.col("text")
    guards = {"email": text.contains("@"), "ip": text.rlike(r"[0-9]\.[0-9]"), "card": text.rlike("[0-9]"), "phone": text.contains("+")}
    for kind, pattern in zip(KINDS, (EMAIL, IP, CARD, PHONE), strict=True):
        df = _mentions(df, kind, pattern, guards[kind])
        df = df.withColumn(kind, _passing(kind))
    df = _mentions(df, "other", CANDIDATE, text.rlike(r"[0-9]|[\x20\[({<][aA][tT][\x20\])}>]"))

    def hashed(m: Column, kind: Column) -> Column:
        return F.struct(kind.alias("kind"), m["start"].alias("start"), m["end"].alias("end"),
                        F.xxhash64(F.lower(m["said"])).alias("said"), m["patterns"].alias("patterns"),
                        F.when(kind.isNull(), _fits(m["said"])).otherwise(0).alias("fits"))

    def of_kind(number: int) -> Column:
        return F.transform(KINDS[number], lambda m: hashed(m, F.lit(number)))

    base = F.concat(*[of_kind(i) for i in range(len(KINDS))])
    df = df.withColumn("base", base)
    free = F.filter("other", lambda m: ~F.exists("base", lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"])))
    return df.select("doc_id", F.xxhash64("text").alias("row"), "base",
                     F.transform(free, lambda m: hashed(m, F.lit(None).cast("int"))).alias("other"))


def discover(mentions: DataFrame, least_support: int = LEAST_SUPPORT, least_confidence: float = LEAST_CONFIDENCE,
             least_score: float = LEAST_SCORE) -> DataFrame:
    """(said, kind) of the strings found from contexts.

    ``mentions``: pattern, said, kind (null for candidates), fits, one row per mention and pattern.
    """
    # One row per pattern and string; a pattern with a third of all mentions is combined before it moves.
    edges = common.written(mentions.groupBy("pattern", "said").agg(F.min("kind").alias("kind"), F.max("fits").alias("fits")), "pattern-graph")
    known = edges.where("kind is not null").groupBy("said").agg(F.min("kind").alias("seed")).withColumn("score", F.lit(1.0))
    found = None
    fit = F.getbit("fits", F.col("seed")) == 1
    while True:                                      # every round but the last finds a string
        told = edges.select("pattern", "said", "fits").join(known, "said", "left")
        sums = [F.count_if(F.col("seed").isNull()).alias("unknown"), F.sum("score").alias("all")]
        for i in range(len(KINDS)):
            of_kind = F.col("seed") == i
            misfit = F.col("seed").isNull() & (F.col("fits").bitwiseAND(1 << i) == 0)
            sums += [F.sum(F.when(of_kind, F.col("score"))).alias(f"score{i}"), F.count_if(of_kind).alias(f"n{i}"),
                     F.count_if(misfit).alias(f"misfits{i}")]
        kinds = F.array(*[F.struct(F.lit(i).alias("seed"), F.col(f"n{i}").alias("n"), (F.col(f"score{i}") / (
            F.col("all") + MISFIT * F.col(f"misfits{i}"))).alias("confidence")) for i in range(len(KINDS))])
        patterns = common.written(told.groupBy("pattern").agg(*sums).where("unknown > 0").select("pattern", F.inline(kinds)).where(
            (F.col("n") >= least_support) & (F.col("confidence") >= least_confidence)).drop("n"), "patterns")
        # Qualified patterns are few; a common phrase among them then meets its strings where these are.
        patterns = F.broadcast(patterns) if patterns.count() * 128 <= common.BROADCAST_BYTES else patterns
        unknown = told.where("seed is null").select("pattern", "said", "fits")
        doubt = F.sum(F.log(F.greatest(F.lit(1e-9), 1 - F.col("confidence") * F.when(fit, 1.0).otherwise(MISFIT))))
        scored = unknown.join(patterns, "pattern").groupBy("said", "seed").agg((1 - F.exp(doubt)).alias("score")).groupBy("said").agg(
            F.max_by("seed", F.struct("score", -F.col("seed"))).alias("seed"), F.max("score").alias("score"))
        new = common.written(scored.where(F.col("score") >= least_score), "found-strings")
        found = new if found is None else found.unionAll(new)
        if new.isEmpty():
            break
        known = known.unionAll(new.select(*known.columns))
    return found.select("said", F.col("seed").alias("kind"))


def _edges(scanned: DataFrame) -> DataFrame:
    """pattern, said, kind, fits of every mention and pattern."""
    return scanned.select(F.explode(F.concat("base", "other")).alias("m")).select(
        F.explode("m.patterns").alias("pattern"), "m.said", "m.kind", "m.fits")


def held_out(docs: DataFrame, share: float = 0.2, seed: int = 11, **limits) -> DataFrame:
    """One row: ``hidden`` base strings (their mentions become candidates), how many of them were ``found``,
    how many with their own kind (``right``), and all strings ``added``."""
    edges = common.written(_edges(scan(docs)), "pii-edges")
    hides = F.pmod(F.xxhash64("said", F.lit(seed)), F.lit(1 << 20)) < share * (1 << 20)
    true = edges.where("kind is not null").where(hides).groupBy("said").agg(F.min("kind").alias("true"))
    hidden = F.col("kind").isNotNull() & hides
    told = edges.withColumn("fits", F.when(hidden, F.lit((1 << len(KINDS)) - 1)).otherwise(F.col("fits"))).withColumn(
        "kind", F.when(~hidden, F.col("kind")))
    strings = discover(told, **limits)
    return true.join(strings.withColumn("got", F.lit(True)), "said", "full").agg(
        F.count("true").alias("hidden"), F.count_if(F.col("true").isNotNull() & F.col("got")).alias("found"),
        F.count_if(F.col("true") == F.col("kind")).alias("right"), F.count("got").alias("added"))


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.sort_array(spans), lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find(docs: DataFrame, **limits) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_found of every row."""
    scanned = common.written(scan(docs), "pii-scan")
    strings = common.written(discover(_edges(scanned), **limits), "pii-strings")
    small = strings.count() * 32 <= common.BROADCAST_BYTES
    other = scanned.where(F.size("other") > 0).select("doc_id", "row", F.explode("other").alias("m")).select(
        "doc_id", "row", "m.start", "m.end", "m.said")
    added = other.distinct().join(F.broadcast(strings) if small else strings, "said").groupBy("doc_id", "row").agg(
        F.collect_list(F.struct("kind", "start", "end")).alias("added"))

    none = F.array().cast("array<struct<kind:int,start:int,end:int>>")
    base = F.transform("base", lambda b: F.struct(b["kind"].alias("kind"), b["start"].alias("start"), b["end"].alias("end")))
    rows = scanned.select("doc_id", "row", base.alias("base"))
    same = rows["doc_id"].eqNullSafe(added["doc_id"]) & (rows["row"] == added["row"])
    joined = rows.join(added, same, "left").select(rows["doc_id"], "base", F.coalesce("added", none).alias("added"))
    kinds = F.transform("base", lambda b: b["kind"])
    counts = [(F.size("base") - F.size(F.array_remove(kinds, i))).cast("bigint").alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return joined.select("doc_id", *counts, F.sha2(_listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                         _listed(F.concat("base", "added")).alias("spans"), F.size("added").cast("bigint").alias("n_found"))

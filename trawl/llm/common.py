"""Small helpers shared by the operators: table access, written
intermediates in the shared folder, and vectorised word hashing."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.session import scratch_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back.

    Cuts the lineage on storage that every executor can read, so a lost
    executor costs no recomputation of what came before.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


BROADCAST_BYTES = 32 << 20

_SHIPPED: set[str] = set()


def map_pandas(df: DataFrame, fn, schema) -> DataFrame:
    """``df.mapInPandas`` with this package's sources on every executor."""
    ship_sources(df.sparkSession)
    return df.mapInPandas(fn, schema)


def map_arrow(df: DataFrame, fn, schema) -> DataFrame:
    """``df.mapInArrow`` with this package's sources on every executor."""
    ship_sources(df.sparkSession)
    return df.mapInArrow(fn, schema)


ARROW_BATCH_BYTES = 8 << 20
ARROW_DEFAULT = "67108864b"    # Spark's own default


def ship_sources(spark: SparkSession) -> None:
    """Hand this package out once per application, as a zip through Spark's own
    file distribution, so no executor needs it installed.  Batches to Python are
    bounded in bytes, so that long texts do not add up."""
    sc = spark.sparkContext
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(limit) == ARROW_DEFAULT:               # a limit set by the user stays
        spark.conf.set(limit, str(ARROW_BATCH_BYTES))
    if sc.applicationId not in _SHIPPED:
        folder = tempfile.mkdtemp(prefix="trawl-src-")       # on the driver, which hands it out
        root = Path(__file__).resolve().parents[1]
        with zipfile.ZipFile(f"{folder}/trawl-src.zip", "w") as z:
            for file in sorted(root.rglob("*.py")):
                z.write(file, file.relative_to(root.parent))
        sc.addPyFile(f"{folder}/trawl-src.zip")
        _SHIPPED.add(sc.applicationId)


def without(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """``rows`` whose ``key`` is not among the (distinct, non-null) ``ids``.

    The ids are broadcast while they are small, so the rows stay where
    they are; beyond that both sides are shuffled.
    """
    ids = written(ids.select(F.col(ids.columns[0]).alias(key)).where(F.col(key).isNotNull()).distinct(), "ids")
    small = ids.count() * 32 <= BROADCAST_BYTES
    return rows.join(F.broadcast(ids) if small else ids, key, "left_anti").select(*rows.columns)


def only(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """``rows`` whose ``key`` is among the distinct, written or cheap ``keys``; these are broadcast while they are small."""
    keys = written(keys, "keys")
    small = keys.count() * 32 <= BROADCAST_BYTES
    return rows.join(F.broadcast(keys) if small else keys, key, "left_semi").select(*rows.columns)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_hash(text_col: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))


def without_texts(rows: DataFrame, found: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``rows`` whose id (null-safe) and text are not among the (id, own) of ``found``; ``own`` is a text's hash."""
    found = written(found.select("id", "own").distinct(), "found-texts")
    small = found.count() * 48 <= BROADCAST_BYTES
    same = (F.col(f"r.{id_col}").cast("bigint").eqNullSafe(F.col("f.id")) & (text_hash(f"r.{text_col}") == F.col("f.own")))
    return rows.alias("r").join((F.broadcast(found) if small else found).alias("f"), same, "left_anti").select(*rows.columns)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# --- word hashing -----------------------------------------------------------

_P = np.uint64(0x9E3779B97F4A7C15 | 1)          # odd, so it has an inverse mod 2**64
_PINV = np.uint64(pow(int(_P), -1, 1 << 64))
_CHUNK = 1 << 22


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser; spreads every input bit over the word."""
    x = x.copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_POW = powers(_P, _CHUNK)
_POWINV = powers(_PINV, _CHUNK)
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
# Everything in ASCII but letters and digits.
PUNCTUATION = np.zeros(256, dtype=bool)
PUNCTUATION[[b for b in range(128) if not chr(b).isalnum()]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def run_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each byte run ``buf[start:end]``.

    A polynomial in the run's bytes, read off running sums of the whole
    buffer and mixed with the run's length; no loop over runs.
    """
    n = len(buf)
    pw, pinv = (powers(_P, n), powers(_PINV, n)) if n > _CHUNK else (_POW[:n], _POWINV[:n])
    run = np.empty(n + 1, dtype=np.uint64)
    run[0] = 0
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * pw, out=run[1:])
    hashes = (run[ends] - run[starts]) * pinv[starts]
    return mix(hashes + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_hashes(texts: list[str], between: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words (A-Z lower-cased) of each text, one after the
    other, and the number of words per text.  ``between`` marks the bytes that
    separate words: white space, or all ASCII punctuation too."""
    raws = [t.encode("utf-8", "surrogatepass") for t in texts]
    # A separator after each text keeps words from touching.
    buf = np.frombuffer(b"\n".join(raws) + b"\n", dtype=np.uint8)
    lens = np.fromiter((len(r) + 1 for r in raws), dtype=np.int64, count=len(raws))
    space = between[buf]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if not space[0]:
        edge = np.concatenate(([0], edge))
    starts, ends = edge[0::2], edge[1::2]          # the last byte is a space
    if not len(starts):
        return np.empty(0, np.uint64), np.zeros(len(raws), np.int64)
    hashes = run_hashes(_LOWER[buf], starts, ends)
    doc_ends = np.cumsum(lens)
    upto = np.searchsorted(starts, doc_ends, side="left")
    return hashes, np.diff(np.concatenate(([0], upto)))


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words; all words as one when fewer."""
    if not len(words):
        return words
    size = min(size, len(words))
    n = len(words) - size + 1
    out = np.full(n, np.uint64(size), dtype=np.uint64)
    for k in range(size):
        out = mix(out * np.uint64(0xFF51AFD7ED558CCD) + words[k:k + n])
    return out


def flat_shingles(words: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of texts given one after the other, and their number per text;
    texts with fewer words than ``size`` have none."""
    found = np.maximum(counts - size + 1, 0)
    if not found.any():
        return np.empty(0, np.uint64), found
    return flat_positions(counts, size, shingles(words, size)), found


def flat_positions(counts: np.ndarray, size: int, values: np.ndarray) -> np.ndarray:
    """``values`` (one per word) at the first word of every shingle inside a text."""
    found = np.maximum(counts - size + 1, 0)
    starts = np.arange(found.sum()) + np.repeat(np.cumsum(counts) - counts - (np.cumsum(found) - found), found)
    return values[starts]


def batches(values: list, weight, limit: int):
    """Runs of ``values`` whose summed weight stays near ``limit`` (at least one each)."""
    run, total = [], 0
    for v in values:
        w = weight(v)
        if run and total + w > limit:
            yield run
            run, total = [], 0
        run.append(v)
        total += w
    if run:
        yield run


# --- sorted groups in mapInPandas -------------------------------------------

def whole_groups(parts, keys: list[str]):
    """Frames of complete groups from a stream sorted by ``keys``.

    Groups may cross batch bounds; only the last, perhaps unfinished one is
    held back, so memory is a batch and the largest group.
    """
    held: list[pd.DataFrame] = []
    for part in parts:
        if not len(part):
            continue
        change = np.zeros(len(part), dtype=bool)
        for k in keys:
            v = part[k].to_numpy()
            change[1:] |= v[1:] != v[:-1]
        cut = int(np.flatnonzero(change)[-1]) if change.any() else 0
        new = bool(held) and any(held[-1][k].iloc[-1] != part[k].iloc[0] for k in keys)
        if cut or new:
            done = pd.concat([*held, part.iloc[:cut]], ignore_index=True) if held else part.iloc[:cut].reset_index(drop=True)
            if len(done):
                yield done
            held = [part.iloc[cut:]]
        else:
            held.append(part)
    if held:
        yield pd.concat(held, ignore_index=True)


def run_bounds(frame: pd.DataFrame, keys: list[str]) -> np.ndarray:
    """First row of each group, and the number of rows."""
    change = np.ones(len(frame), dtype=bool)
    change[1:] = False
    for k in keys:
        v = frame[k].to_numpy()
        change[1:] |= v[1:] != v[:-1]
    return np.append(np.flatnonzero(change), len(frame))


def block_pairs(df: DataFrame, key: str, blocks: Column, spread_by: str) -> DataFrame:
    """Deal groups out so that every two rows of a group meet in a task.

    ``blocks`` is the number of blocks of the row's group: one block means one
    task (bi = bj = 0); of more, every two blocks meet in a task of their own,
    so no task holds more than two blocks however large the group is.
    """
    own = F.pmod(F.xxhash64(spread_by), F.col("_blocks"))
    other = F.explode(F.when(F.col("_blocks") == 1, F.array(F.lit(0).cast("bigint")))
                      .otherwise(F.filter(F.sequence(F.lit(0).cast("bigint"), F.col("_blocks") - 1), lambda o: o != F.col("_own"))))
    dealt = (df.withColumn("_blocks", blocks.cast("bigint")).withColumn("_own", own).withColumn("_other", other)
             .withColumn("bi", F.least("_own", "_other")).withColumn("bj", F.greatest("_own", "_other"))
             .drop("_blocks", "_own", "_other"))
    return (dealt.repartition(partitions(df.sparkSession), key, "bi", "bj")
            .sortWithinPartitions(key, "bi", "bj"))

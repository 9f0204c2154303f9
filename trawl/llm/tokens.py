"""Token-ID output: one id array per block, document bounds in Elias-Fano form.

File format (a Parquet table, one row per block, written through Spark's
committer, so any store Spark can reach will do and a lost executor costs
one task):

    shard, block      blocks in (shard, block) order hold ascending doc ids
    shard_start       ids in this shard before the block
    n_ids, width      length of the id array, bytes per id (2 or 4)
    ids               little-endian ids of all documents of the block
    ends_*            Elias-Fano code of the documents' end offsets
    doc_ids           the documents' ids, ascending (nulls first)

For n ends below U the code keeps ``floor(log2(U / n))`` low bits of each end
in a packed array and the high parts in unary, so a document costs about
``2 + log2(U / n)`` bits instead of a 64-bit offset.  ``EliasFano.select``
answers one offset from a sampled directory without unpacking the rest.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trawl.llm import common
from trawl.session import scratch_dir

SAMPLE = 64            # every 64th set bit has its position in the directory
BLOCK_IDS = 1 << 19    # a block is closed at the document that reaches this many ids
CACHE_PIECES = 2_000_000
BATCH_CHARS = 1 << 21


class EliasFano:
    """Non-decreasing integers below or at ``universe`` in near-minimal space."""

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes, samples: bytes):
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def encode(cls, values: np.ndarray) -> "EliasFano":
        v = np.asarray(values, dtype=np.uint64)
        n = len(v)
        if not n:
            return cls(0, 0, b"", b"", b"")
        bits = max(0, int(int(v[-1]) // n).bit_length() - 1)
        low = (v[:, None] >> np.arange(bits, dtype=np.uint64) & np.uint64(1)).astype(np.uint8)
        ones = (v >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(ones[-1]) + 1, dtype=np.uint8)
        high[ones] = 1
        pack = lambda b: np.packbits(b, bitorder="little").tobytes()
        return cls(n, bits, pack(low.reshape(-1)), pack(high), ones[::SAMPLE].astype("<u4").tobytes())

    def decode(self) -> np.ndarray:
        if not self.n:
            return np.empty(0, np.int64)
        bits = np.unpackbits(np.frombuffer(self.high, np.uint8), bitorder="little")
        high = np.flatnonzero(bits)[: self.n] - np.arange(self.n)
        if not self.low_bits:
            return high
        low = np.unpackbits(np.frombuffer(self.low, np.uint8), bitorder="little")[: self.n * self.low_bits]
        weight = np.int64(1) << np.arange(self.low_bits, dtype=np.int64)
        return (high << self.low_bits) + low.reshape(self.n, -1).astype(np.int64) @ weight

    def select(self, i: int) -> int:
        """The i-th value, read from the directory entry before it."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at = int(np.frombuffer(self.samples, "<u4")[i // SAMPLE])
        left = i % SAMPLE                           # set bits still to pass after ``at``
        byte, seen = at // 8, -bin(self.high[at // 8] & ((1 << at % 8) - 1)).count("1")
        while seen + self.high[byte].bit_count() <= left:
            seen += self.high[byte].bit_count()
            byte += 1
        rest = self.high[byte]
        for _ in range(left - seen):
            rest &= rest - 1
        high = byte * 8 + (rest & -rest).bit_length() - 1 - i
        start = i * self.low_bits
        word = int.from_bytes(self.low[start // 8:(start + self.low_bits + 7) // 8], "little")
        return (high << self.low_bits) + (word >> start % 8 & ((1 << self.low_bits) - 1))


class PieceEncoder:
    """The tokenizers library behind a cache of text pieces.

    Texts are cut where byte-level pre-tokenising always cuts: before white
    space that follows a visible character, before and after a line feed that
    stands before a visible character (the last of a run of white space is a
    pre-token of its own there), and before a full stop or comma that follows
    an ASCII letter.  So the pieces' ids in a row are the text's ids.  The pieces of a batch are
    told apart by 64-bit hashes; the library sees each new one once.  Texts
    with other white space or with an added token's string go to it whole.
    """

    ODD = re.compile("[\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200b\u2028\u2029\u202f\u205f\u3000\ufeff]")

    def __init__(self, tokenizer_file: str):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"   # Spark runs one task per core
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.dtype = np.dtype(f"<u{self.width}")
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self._forget()

    def _forget(self) -> None:
        self.keys = np.empty(0, np.uint64)              # ascending piece hashes
        self.offset = np.empty(0, np.int64)             # of the piece's ids in the pool
        self.length = np.empty(0, np.int64)
        self.pool = np.empty(0, self.dtype)

    def _library(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype=self.dtype) for e in found]

    def _learn(self, raw: bytes, keys: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        """Add pieces' ids to the pool.  A run of letters, after a space or
        not, is one pre-token, so the library's model takes it directly."""
        ids, rest = [], []
        tokenize = self.tokenizer.model.tokenize
        for i, (s, e) in enumerate(zip(starts.tolist(), ends.tolist(), strict=True)):
            piece = raw[s:e].decode("utf-8", "surrogatepass")
            if (piece[1:] if piece[0] == " " else piece).isalpha():
                chars = (piece.replace(" ", SPACE_CHAR) if piece.isascii()
                         else raw[s:e].decode("latin-1").translate(BYTE_CHARS))
                ids.append([t.id for t in tokenize(chars)])
            else:
                ids.append(())
                rest.append((i, piece))
        for (i, _), piece in zip(rest, self._library([p for _, p in rest]), strict=True):
            ids[i] = piece.tolist()
        length = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        offset = len(self.pool) + np.cumsum(length) - length
        at = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, at, keys)
        self.offset = np.insert(self.offset, at, offset)
        self.length = np.insert(self.length, at, length)
        self.pool = np.concatenate([self.pool, np.fromiter(chain.from_iterable(ids), dtype=self.dtype)])

    def _cut(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        raws = [t.encode("utf-8", "surrogatepass") for t in texts]
        raw = b"".join(raws)
        sizes = np.fromiter(map(len, raws), dtype=np.int64, count=len(raws))
        firsts = np.cumsum(sizes) - sizes
        buf = np.frombuffer(raw, np.uint8)
        if not len(buf):
            return np.empty(0, self.dtype), np.zeros(len(texts), np.int64)
        space = common.SPACE[buf]
        start = np.zeros(len(buf), dtype=bool)
        after = buf[:-1]
        line = (after == 10) & ~space[1:]
        line[firsts[(sizes > 0) & (firsts > 0)] - 1] = False      # the next byte is another text's
        start[1:] = space[1:] & ~space[:-1] | line | ((buf[1:] == 46) | (buf[1:] == 44)) & _LETTER[after]
        start[:-1] |= line
        start[firsts[sizes > 0]] = True
        starts = np.flatnonzero(start)
        ends = np.append(starts[1:], len(buf))
        keys, first, inverse = np.unique(common.run_hashes(buf, starts, ends), return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        new = self.keys[at] != keys if len(self.keys) else np.ones(len(keys), bool)
        if new.any():
            self._learn(raw, keys[new], starts[first[new]], ends[first[new]])
            at = np.searchsorted(self.keys, keys)
        length, offset = self.length[at][inverse], self.offset[at][inverse]
        ends_ids = np.cumsum(length)
        ids = self.pool[np.repeat(offset - (ends_ids - length), length) + np.arange(ends_ids[-1])]
        upto = np.concatenate(([0], ends_ids))[np.searchsorted(starts, np.cumsum(sizes))]
        return ids, np.diff(np.concatenate(([0], upto)))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        if len(self.keys) > CACHE_PIECES:
            self._forget()
        whole = [i for i, t in enumerate(texts) if any(a in t for a in self.added) or self.ODD.search(t)]
        odd = dict(zip(whole, self._library([texts[i] for i in whole]), strict=True)) if whole else {}
        ids, counts = self._cut(["" if i in odd else t for i, t in enumerate(texts)])
        out = np.split(ids, np.cumsum(counts)[:-1]) if texts else []
        return [odd.get(i, x) for i, x in enumerate(out)]


# The byte-level alphabet: visible Latin-1 bytes stand for themselves, the rest for U+0100 onwards.
_VISIBLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_CHARS = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in _VISIBLE)}
SPACE_CHAR = BYTE_CHARS[32]
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True


@lru_cache(maxsize=2)
def encoder_for(tokenizer_file: str) -> PieceEncoder:
    """One encoder per Python worker; its cache outlives a task."""
    return PieceEncoder(tokenizer_file)


BLOCK_SCHEMA = ("shard int, block int, shard_start bigint, n_docs int, n_ids bigint, width int, ids binary, "
                "ends_low_bits int, ends_low binary, ends_high binary, ends_samples binary, doc_ids array<bigint>")


def _block(shard: int, number: int, start: int, docs: list[tuple]) -> dict:
    ids = np.concatenate([x for _, x in docs])
    code = EliasFano.encode(np.cumsum([len(x) for _, x in docs]))
    return {"shard": shard, "block": number, "shard_start": start, "n_docs": len(docs),
            "n_ids": len(ids), "width": ids.dtype.itemsize, "ids": ids.tobytes(), "ends_low_bits": code.low_bits,
            "ends_low": code.low, "ends_high": code.high, "ends_samples": code.samples,
            "doc_ids": [d for d, _ in docs]}


def write_token_file(docs: DataFrame, path: str, tokenizer_file: str, end_id: int | None = 2,
                     id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every text and write the blocks in ascending ``id_col`` order.

    Documents are range-partitioned by id (the text moves once, before it
    is tokenised) and sorted inside each partition; a partition is one shard
    of the file.  A null text is empty, a null id sorts first, rows with
    one id stay apart, ordered by text.  An empty table gives a file
    without blocks.  Other columns are ignored.
    """
    spark = docs.sparkSession

    def encode(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = encoder_for(tokenizer_file)
        end = np.array([] if end_id is None else [end_id], dtype=encoder.dtype)
        shard, number, start, held, size = None, 0, 0, [], 0
        for part in parts:
            shard = int(part["shard"].iloc[0]) if len(part) else shard
            rows = [(None if pd.isna(d) else int(d), t) for d, t in zip(part["id"], part["text"], strict=True)]
            for run in common.batches(rows, lambda r: len(r[1]), BATCH_CHARS):
                for (doc, _), ids in zip(run, encoder.encode([t for _, t in run]), strict=True):
                    held.append((doc, np.concatenate([ids, end])))
                    size += len(held[-1][1])
                    if size >= BLOCK_IDS:
                        yield pd.DataFrame([_block(shard, number, start, held)])
                        number, start, held, size = number + 1, start + size, [], 0
        if held:
            yield pd.DataFrame([_block(shard, number, start, held)])

    ordered = (
        docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
        .repartitionByRange(common.partitions(spark), "id")
        .sortWithinPartitions("id", "text")
        .select(F.spark_partition_id().alias("shard"), "id", "text"))
    blocks = common.map_pandas(ordered, encode, BLOCK_SCHEMA)
    blocks.write.option("compression", "zstd").parquet(path)


def read_token_file(spark: SparkSession, path: str) -> DataFrame:
    """Blocks of a token file with ``base``, the ids before their shard.

    Only one row per shard is ordered to find the bases.
    """
    blocks = spark.read.parquet(path)
    sizes = blocks.groupBy("shard").agg(F.sum("n_ids").alias("ids"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("shard", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))
    return blocks.join(F.broadcast(bases), "shard")      # one row per shard


def document_digests(spark: SparkSession, path: str) -> DataFrame:
    """Per document of a token file: doc_id, start, n_tokens, ids_crc32."""

    def digest(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for b in part.itertuples(index=False):
                ends = EliasFano(b.n_docs, b.ends_low_bits, b.ends_low, b.ends_high, b.ends_samples).decode()
                ids = np.frombuffer(b.ids, dtype=f"<u{b.width}").astype("<u4")
                starts = np.concatenate(([0], ends[:-1]))
                yield pd.DataFrame({
                    "doc_id": pd.array(list(b.doc_ids), dtype="Int64"),
                    "start": starts + b.base + b.shard_start,
                    "n_tokens": ends - starts,
                    "ids_crc32": [zlib.crc32(ids[s:e].tobytes()) for s, e in zip(starts, ends, strict=True)]})

    return common.map_pandas(
        read_token_file(spark, path), digest, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def encode_documents(docs: DataFrame, tokenizer_file: str, end_id: int = 2) -> DataFrame:
    """Write ``docs`` as a token file in the shared folder and digest it from there."""
    spark = docs.sparkSession
    path = scratch_dir(spark, "token-file")
    write_token_file(docs, path, tokenizer_file, end_id)
    return document_digests(spark, path)

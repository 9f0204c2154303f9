"""Plain-Python scoring of a tiny corpus, for checking the Spark plans.

Norms are coded bit by bit (float32 packing), independent of the
power-of-two arithmetic the Spark expression uses.
"""

from __future__ import annotations

import math
import struct
from collections import Counter

import regex

from trawl.functions.analyzers import ENGLISH_STOP_WORDS, STANDARD_TOKEN

K1, B, MU, LAM = 1.2, 0.75, 2000.0, 0.7


def f32(x: float) -> float:
    return struct.unpack(">f", struct.pack(">f", x))[0]


def norm_byte(f: float) -> int:
    """float -> one byte: 3 significant bits, exponent offset 15."""
    bits = struct.unpack(">i", struct.pack(">f", f))[0]
    small = bits >> 21
    floor = (63 - 15) << 3
    if small <= floor:
        return 0 if bits <= 0 else 1
    if small >= floor + 0x100:
        return 255
    return small - floor


def byte_norm(b: int) -> float:
    if b == 0:
        return 0.0
    bits = ((b & 0xFF) << 21) + ((63 - 15) << 24)
    return struct.unpack(">f", struct.pack(">i", bits))[0]


def qnorm(dl: int) -> float:
    return byte_norm(norm_byte(f32(1.0 / math.sqrt(dl))))


def tokens(text: str) -> list[str]:
    # The same pattern in this module's notation of code points and nested classes.
    pattern = regex.sub(r"\\x\{([0-9a-f]+)\}", lambda m: chr(int(m[1], 16)), STANDARD_TOKEN)
    out = regex.findall(pattern, text.lower(), flags=regex.V1)
    return [t for t in out if len(t) <= 255 and t not in ENGLISH_STOP_WORDS]


class Corpus:
    def __init__(self, docs: dict[int, str]):
        self.tf = {d: Counter(tokens(t)) for d, t in docs.items()}
        self.dl = {d: sum(c.values()) for d, c in self.tf.items()}
        self.n = len(docs)
        self.c = sum(self.dl.values())
        self.df = Counter(t for c in self.tf.values() for t in c)
        self.cf = Counter()
        for c in self.tf.values():
            self.cf.update(c)

    def scores(self, query: str) -> dict[str, dict[int, float]]:
        q = Counter(tokens(query))
        out = {m: {} for m in ("tfidf", "bm25", "vsm", "lm_dirichlet", "lm_jm")}
        if not q:
            return out
        avgdl = self.c / self.n
        vidf = {t: 1 + math.log(self.n / (self.df[t] + 1)) for t in q}
        qn = 1 / math.sqrt(sum(q[t] * vidf[t] ** 2 for t in q))
        clauses = sum(q.values())
        for d, tfs in self.tf.items():
            hit = [t for t in q if tfs[t] > 0]
            if not hit:
                continue
            nrm = qnorm(self.dl[d])
            length = 1 / (nrm * nrm)
            out["tfidf"][d] = sum(f32(tfs[t] / nrm) * math.log(1 + self.n // self.df[t]) for t in hit)
            out["bm25"][d] = sum(q[t] * math.log(1 + (self.n - self.df[t] + 0.5) / (self.df[t] + 0.5))
                                 * tfs[t] * (K1 + 1) / (tfs[t] + K1 * (1 - B + B * length / avgdl))
                                 for t in hit)
            coord = sum(q[t] for t in hit) / clauses
            out["vsm"][d] = coord * qn * sum(q[t] * math.sqrt(tfs[t]) * vidf[t] ** 2 * nrm for t in hit)
            p = {t: (self.cf[t] + 1) / (self.c + 1) for t in hit}
            out["lm_dirichlet"][d] = sum(q[t] * max(0.0, math.log(1 + tfs[t] / (MU * p[t]))
                                                    + math.log(MU / (length + MU))) for t in hit)
            out["lm_jm"][d] = sum(q[t] * math.log(1 + ((1 - LAM) * tfs[t] / length) / (LAM * p[t]))
                                  for t in hit)
        return out

"""Operator 9: secret scan, patterns plus a character convolutional network.

Three patterns give the base findings.  Every other long run of key characters
is a candidate: a small convolutional network (numpy: character embedding,
one convolution, maximum over places, one linear layer) scores the candidate
with its surrounding characters.  It is trained on labelled findings: base
findings are positive, other candidates negative.  Scores are calibrated on
held-out findings (Platt), and the threshold is the highest that keeps the
wanted recall there.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The base patterns and the kinds, in their order.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex", "model")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 6, 20, 24

CANDIDATE_CHARS = "A-Za-z0-9+/_="
MIN_CANDIDATE = 16
BEFORE, INSIDE, AFTER = 24, 48, 8
LEARN_DOCS, LEARN_FINDINGS = 20_000, 4_000  # bounds of the learning sample: documents read, findings of each label

_ASSIGN = re.compile(ASSIGN, re.IGNORECASE | re.ASCII)
_HINTS = ("passw", "secret", "token", "api")
_ACCESS = re.compile(ACCESS)
_HEX = re.compile(r"[0-9a-f]{24,}")  # a run of 24 or more is the same match as a longer run of any length
_CANDIDATE = re.compile(f"[{CANDIDATE_CHARS}-]{{{MIN_CANDIDATE},}}")

_KEY = np.zeros(128, bool)
_KEY[[ord(c) for c in map(chr, range(128)) if re.match(f"[{CANDIDATE_CHARS}-]", c)]] = True


def base_spans(text: str, long_run: bool = True) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base findings; ``long_run``: a run of 16 key characters exists."""
    low = text.lower()
    out = []
    if any(h in low for h in _HINTS):
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_ASSIGN]
    if long_run:
        if "AKIA" in text:
            out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
        out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(out)


def has_long_runs(texts: list[str]) -> np.ndarray:
    """For each text, whether it holds a run of MIN_CANDIDATE key characters."""
    raw = np.frombuffer("\x00".join(texts).encode("utf-8", "surrogatepass") + b"\x00", np.uint8)
    key = np.zeros(256, bool)
    key[:128] = _KEY
    gaps = np.flatnonzero(~key[raw])
    long = np.diff(gaps, prepend=-1) > MIN_CANDIDATE
    ends = np.cumsum([len(t.encode("utf-8", "surrogatepass")) + 1 for t in texts]) - 1
    out = np.zeros(len(texts), bool)
    out[np.searchsorted(ends, gaps[long])] = True
    return out


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Runs of key characters that no base finding touches."""
    out = []
    for m in _CANDIDATE.finditer(text):
        if not any(a < m.end() and m.start() < z for a, _, z in base):
            out.append((m.start(), m.end()))
    return out


def window(text: str, start: int, end: int) -> bytes:
    """The candidate and its context, one byte per character, fixed length."""
    inside = text[start:end]
    if len(inside) > INSIDE:
        inside = inside[:INSIDE // 2] + inside[-INSIDE // 2:]
    s = text[max(0, start - BEFORE):start].rjust(BEFORE, "\x00") + inside.ljust(INSIDE, "\x00") + text[end:end + AFTER].ljust(AFTER, "\x00")
    return bytes(ord(c) if ord(c) < 127 else 127 for c in s)


class CharCNN:
    """Embedding, convolution, ReLU, maximum over places, logistic output; trained with Adam."""

    WIDTH, EMBED, FILTERS = 5, 8, 24

    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        e = self.EMBED + 1  # and whether the place is inside the candidate
        self.p = {"emb": r.normal(0, 0.3, (128, self.EMBED)), "conv": r.normal(0, 0.2, (self.WIDTH * e, self.FILTERS)),
                  "cb": np.zeros(self.FILTERS), "out": r.normal(0, 0.2, self.FILTERS), "ob": np.zeros(1)}
        inside = np.zeros(BEFORE + INSIDE + AFTER)
        inside[BEFORE:BEFORE + INSIDE] = 1
        self.inside = inside

    def _forward(self, x: np.ndarray):
        n, size = x.shape
        seen = np.concatenate([self.p["emb"][x], np.broadcast_to((self.inside * (x > 0))[:, :, None], (n, size, 1))], axis=2)
        places = size - self.WIDTH + 1
        cols = np.concatenate([seen[:, k:k + places] for k in range(self.WIDTH)], axis=2)
        act = cols @ self.p["conv"] + self.p["cb"]
        best = act.argmax(axis=1)
        top = np.take_along_axis(act, best[:, None], axis=1)[:, 0]
        return cols, best, top, np.maximum(top, 0) @ self.p["out"] + self.p["ob"]

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([self._forward(x[i:i + 256])[3] for i in range(0, len(x), 256)]) if len(x) else np.zeros(0)

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 12, batch: int = 64, rate: float = 0.01, seed: int = 7) -> None:
        r = np.random.default_rng(seed)
        m, v = ({k: np.zeros_like(a) for k, a in self.p.items()} for _ in range(2))
        t = 0
        for _ in range(epochs):
            order = r.permutation(len(x))
            for i in range(0, len(x), batch):
                xb, yb = x[order[i:i + batch]], y[order[i:i + batch]]
                cols, best, top, z = self._forward(xb)
                dz = (1 / (1 + np.exp(-z)) - yb) / len(xb)
                dtop = np.outer(dz, self.p["out"]) * (top > 0)
                picked = np.take_along_axis(cols, best[:, :, None], axis=1)  # n x filters x inputs
                dseen = dtop[:, :, None] * self.p["conv"].T[None]
                demb = np.zeros_like(self.p["emb"])
                e = self.EMBED + 1
                for k in range(self.WIDTH):
                    chars = np.take_along_axis(xb, best + k, axis=1)
                    np.add.at(demb, chars.ravel(), dseen[:, :, k * e:k * e + self.EMBED].reshape(-1, self.EMBED))
                grad = {"emb": demb, "conv": np.einsum("nf,nfi->if", dtop, picked), "cb": dtop.sum(0),
                        "out": np.maximum(top, 0).T @ dz, "ob": np.array([dz.sum()])}
                t += 1
                for k, g in grad.items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    self.p[k] = self.p[k] - rate * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.999 ** t)) + 1e-8)


class Detector:
    """A trained network, its calibration and its threshold."""

    def __init__(self, net: CharCNN, scale: float, shift: float, threshold: float):
        self.net, self.scale, self.shift, self.threshold = net, scale, shift, threshold

    def scores(self, windows: list[bytes]) -> np.ndarray:
        if not windows:
            return np.zeros(0)
        x = np.frombuffer(b"".join(windows), np.uint8).reshape(len(windows), -1).astype(np.int64)
        return 1 / (1 + np.exp(-(self.scale * self.net.logits(x) + self.shift)))


def train(positive: list[bytes], negative: list[bytes], recall: float = 0.98, seed: int = 7) -> Detector | None:
    """Fit on four fifths of the findings; calibrate and set the threshold on the rest.  None if a label has under 20."""
    if min(len(positive), len(negative)) < 20:
        return None
    r = np.random.default_rng(seed)
    size = BEFORE + INSIDE + AFTER
    arrays = [np.frombuffer(b"".join(sorted(w)), np.uint8).reshape(-1, size).astype(np.int64) for w in (positive, negative)]
    # a secret must be known without its label too: half the positives get the context of a negative
    pos, neg = arrays
    odd = np.arange(len(pos)) % 2 == 1
    lent = neg[r.integers(0, len(neg), len(pos))]
    pos[odd, :BEFORE], pos[odd, -AFTER:] = lent[odd, :BEFORE], lent[odd, -AFTER:]
    x, y = np.concatenate([pos, neg]), np.concatenate([np.ones(len(pos)), np.zeros(len(neg))])
    order = r.permutation(len(x))
    held = order[: len(x) // 5]
    rest = order[len(x) // 5:]
    net = CharCNN(seed)
    net.fit(x[rest], y[rest])
    z, t = net.logits(x[held]), y[held]
    scale, shift = 1.0, 0.0
    for _ in range(200):  # Platt: two parameters by gradient descent
        p = 1 / (1 + np.exp(-(scale * z + shift)))
        scale -= 0.1 * float(((p - t) * z).mean())
        shift -= 0.1 * float((p - t).mean())
    found = np.sort((1 / (1 + np.exp(-(scale * z + shift))))[t == 1])
    threshold = float(found[int((1 - recall) * len(found))]) if len(found) else 1.0
    return Detector(net, max(scale, 1e-3), shift, threshold)


def _findings(batches):
    for pdf in batches:
        rows = []
        for text in pdf["text"]:
            base = base_spans(text)
            rows += [(1, window(text, *_value(text, a, k, z))) for a, k, z in base]
            rows += [(0, window(text, a, z)) for a, z in candidates(text, base)]
        yield pd.DataFrame(rows, columns=["label", "w"])


def _value(text: str, start: int, kind: int, end: int) -> tuple[int, int]:
    """The secret itself: for an assignment the part after the sign."""
    if kind:
        return start, end
    m = _ASSIGN.match(text, start)
    return (m.start(2), m.end(2)) if m else (start, end)


def fit_detector(docs: DataFrame, learn_docs: int = LEARN_DOCS, findings: int = LEARN_FINDINGS, recall: float = 0.98) -> Detector | None:
    """Train on a sample bounded by ``learn_docs`` documents and ``findings`` per label, both picked by hashes."""
    n = docs.count()
    if not n:
        return None
    docs = docs.select("doc_id", "text").where("text is not null")
    picked = docs.where(F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("learn")), F.lit(1_000_000)) < int(1_000_000 * min(1.0, learn_docs / n)))
    rows = picked.select("text").mapInPandas(_findings, "label int, w binary").distinct()
    by = {k: [bytes(r[0]) for r in rows.where(F.col("label") == k).orderBy(F.xxhash64("w"), "w").limit(findings).select("w").collect()]
          for k in (1, 0)}
    return train(by[1], by[0], recall)


def _scan(detector: Detector | None):
    def run(batches):
        for batch in batches:
            ids, texts = batch.column("id").to_pylist(), [t or "" for t in batch.column("text").to_pylist()]
            for lo in range(0, len(ids), 128):
                part = texts[lo:lo + 128]
                long = has_long_runs(part)
                found = [base_spans(t, bool(z)) for t, z in zip(part, long, strict=True)]
                if detector:
                    at, seen = [], []
                    for i in np.flatnonzero(long):
                        for a, z in candidates(part[i], found[i]):
                            at.append((i, a, z))
                            seen.append(window(part[i], a, z))
                    for (i, a, z), p in zip(at, detector.scores(seen), strict=True):
                        if p >= detector.threshold:
                            found[i].append((a, 3, z))
                out = {k: [] for k in ("n_assign", "n_access", "n_hex", "base_sha256", "spans")}
                for own in found:
                    own.sort()
                    base = ",".join(f"{KINDS[k]}:{a}:{z}" for a, k, z in own if k < 3)
                    for j, c in enumerate(("n_assign", "n_access", "n_hex")):
                        out[c].append(sum(k == j for _, k, _ in own))
                    out["base_sha256"].append(hashlib.sha256(base.encode()).hexdigest())
                    out["spans"].append(",".join(f"{KINDS[k]}:{a}:{z}" for a, k, z in own))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[lo:lo + 128], pa.string())] + [pa.array(out[c], pa.int64()) for c in ("n_assign", "n_access", "n_hex")]
                    + [pa.array(out[c], pa.string()) for c in ("base_sha256", "spans")], names=["id", *out])
    return run


def scan(docs: DataFrame, detector: Detector | None) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of every whole text (null: empty, so no finding).

    ``spans`` is kind:start:end in code points, end exclusive, by start and then
    kind; ``model`` marks the network's findings.  Without a detector only the
    patterns count.  Repeated rows are all scanned; other columns are not read.
    """
    rows = docs.select(F.col("doc_id").cast("string").alias("id"), F.col("text").alias("text"))
    out = rows.mapInArrow(_scan(detector), "id string, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string")
    return out.select(F.col("id").cast(docs.schema["doc_id"].dataType).alias("doc_id"), "n_assign", "n_access", "n_hex", "base_sha256", "spans")

"""Toxic span tagging with a linear-chain conditional random field.

Labels exist per document, a CRF learns from labelled tokens. Token labels are
derived: word and word-prefix *signs* whose document frequency is
significantly higher in toxic documents get a strength (lower bound of their
log odds ratio); in a toxic document the tokens of strong signs are labelled
toxic, all tokens of clean documents clean. The signs come from one half of
the training documents, the CRF and the document model from the other half,
so that signs which are strong by chance are seen failing; for scoring, the
signs are then counted on both halves.

Tags are clean (0) and toxic (1). A token's feature is its strength bucket;
the CRF has a weight per bucket and the four transitions, fitted by gradient
ascent on the forward-backward marginals. Scoring runs the same
forward-backward recursion over whole texts: stretches of tokens without a
sign all have the same factor, so their steps are powers of one 2 x 2 matrix
and only signs and their neighbours are visited one by one. Marginals are
aggregated to the document score (logistic model on the largest marginal, the
expected number of toxic tokens and their density) and to offending offsets
(runs of tokens with marginal 1/2 or more, in characters).

Bounds (documented parameters): about ``fit_rows`` labelled documents by hash
of their id, ``fit_pieces`` pieces of ``PIECE`` tokens for the CRF, at most
``most_signs`` signs. What is scored is never bounded.

Defined cases: null or empty text has no tokens and gets the score of a text
without signs; labels that are null or of unknown documents are ignored; with
several labels a document is toxic if any says so; without training labels
every score is 0; repeated rows score alike; other columns are ignored.
"""

from __future__ import annotations

import pickle
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.session import materialize

FIT_ROWS = 20_000
FIT_PIECES = 30_000
MOST_SIGNS = 50_000
PIECE = 64
PREFIXES = range(3, 9)
STEP = 0.75                                            # strength per bucket
BUCKETS = 9                                            # 0: no sign
STRONG = 3                                             # bucket that labels a token toxic
LEAST_TOXIC = 3
NEAR = 64                                              # gaps whose powers are listed
FAR = 10_000                                           # longer gaps remembered
MEMO_BYTES = 24_000_000
OUT = ("doc_id long, score double, n_tokens long, expected_toxic double, "
       "offsets array<struct<start:int,end:int,p:double>>")
_WORD = re.compile(r"[^\W\d_]+")


def signs_of(word: str) -> list[str]:
    """The word itself and its proper prefixes."""
    return ["=" + word, *(word[:k] for k in PREFIXES if k < len(word))]


class _Buckets(dict):
    """Strength bucket of a token, remembered in about ``MEMO_BYTES``."""

    def __init__(self, signs: dict[str, float]):
        super().__init__()
        self.signs, self.held = signs, 0

    def __missing__(self, token: str) -> int:
        self.held += 160 + 2 * len(token)
        if self.held > MEMO_BYTES:
            self.clear()
            self.held = 160 + 2 * len(token)
        get = self.signs.get
        best = max((get(s, 0.0) for s in signs_of(token.lower())), default=0.0)
        b = min(BUCKETS - 1, 1 + int(best / STEP)) if best > 0 else 0
        self[token] = b
        return b


class Crf:
    """Weights: emission of tag 1 per bucket, transition[from, to], first tag 1."""

    def __init__(self, emission=None, transition=None, first: float = 0.0):
        self.emission = np.zeros(BUCKETS) if emission is None else np.asarray(emission, float)
        self.transition = np.zeros((2, 2)) if transition is None else np.asarray(transition, float)
        self.first = first
        self._ready = None

    def _powers(self):
        """The transition, and powers of (transition x factor of a token
        without sign), each scaled to sum 1: up to ``NEAR``, and every 2^k."""
        if self._ready is None:
            t = np.exp(self.transition)
            base = t * np.array([1.0, np.exp(self.emission[0])])
            near, twice = [np.eye(2)], [base / base.sum()]
            for _ in range(NEAR):
                m = near[-1] @ base
                near.append(m / m.sum())
            for _ in range(62):
                m = twice[-1] @ twice[-1]
                twice.append(m / m.sum())
            self._ready = [t.tolist(), [m.tolist() for m in near], twice, {}]
        return self._ready

    def _power(self, gap: int) -> list[list[float]]:
        """The power of a gap of any length, by its binary digits."""
        _, near, twice, far = self._powers()
        if gap <= NEAR:
            return near[gap]
        got = far.get(gap)
        if got is None:
            m = np.eye(2)
            for k in range(gap.bit_length()):
                if gap >> k & 1:
                    m = m @ twice[k]
                    m = m / m.sum()
            if len(far) >= FAR:
                far.clear()
            got = far[gap] = m.tolist()
        return got

    def marginals(self, at: list[int], bucket: list[int], n: int) -> list[float]:
        """P(tag 1) of the tokens at the sorted places ``at`` of n tokens; all
        other tokens have bucket 0."""
        t, power = self._powers()[0], self._power
        e = np.exp(self.emission).tolist()
        first = float(np.exp(self.first))
        factors, states = [], []
        a0, a1 = 1.0, first
        last = -1
        for p, b in zip(at, bucket):
            if last < 0:
                if p:                                      # p tokens without sign come first
                    x0, x1 = a0, a1 * e[0]
                    m = power(p - 1)
                    x0, x1 = x0 * m[0][0] + x1 * m[1][0], x0 * m[0][1] + x1 * m[1][1]
                    a0, a1 = x0 * t[0][0] + x1 * t[1][0], x0 * t[0][1] + x1 * t[1][1]
            else:
                m = power(p - last - 1)
                x0, x1 = a0 * m[0][0] + a1 * m[1][0], a0 * m[0][1] + a1 * m[1][1]
                a0, a1 = x0 * t[0][0] + x1 * t[1][0], x0 * t[0][1] + x1 * t[1][1]
            a1 *= e[b]
            s = a0 + a1
            a0, a1 = a0 / s, a1 / s
            states.append((a0, a1))
            last = p
        out = [0.0] * len(at)
        m = power(n - 1 - last)
        b0, b1 = m[0][0] + m[0][1], m[1][0] + m[1][1]
        for k in range(len(at) - 1, -1, -1):
            a0, a1 = states[k]
            out[k] = a1 * b1 / (a0 * b0 + a1 * b1)
            if k:
                f1 = e[bucket[k]] * b1
                x0, x1 = t[0][0] * b0 + t[0][1] * f1, t[1][0] * b0 + t[1][1] * f1
                m = power(at[k] - at[k - 1] - 1)
                b0, b1 = m[0][0] * x0 + m[0][1] * x1, m[1][0] * x0 + m[1][1] * x1
                s = b0 + b1
                b0, b1 = b0 / s, b1 / s
        return out

    def fit(self, pieces: np.ndarray, lengths: np.ndarray, tags: np.ndarray, rounds: int = 80) -> Crf:
        """Gradient ascent (Adam) on the mean log-likelihood of tagged pieces;
        ``pieces`` and ``tags`` are padded to one width."""
        n, width = pieces.shape
        theta = np.zeros(BUCKETS + 5)
        theta[0], theta[BUCKETS + 4] = -2.0, -2.0
        m, v = np.zeros_like(theta), np.zeros_like(theta)
        live = np.arange(width)[None, :] < lengths[:, None]
        tags = tags * live
        want = np.zeros_like(theta)
        want[:BUCKETS] = np.bincount(pieces[live], weights=tags[live], minlength=BUCKETS)
        pair = live[:, 1:]
        for a in (0, 1):
            for b in (0, 1):
                want[BUCKETS + 2 * a + b] = ((tags[:, :-1] == a) & (tags[:, 1:] == b) & pair).sum()
        want[BUCKETS + 4] = tags[:, 0].sum()
        for turn in range(1, rounds + 1):
            g = (want - self._expected(theta, pieces, lengths, live)) / n - 1e-4 * theta
            m = 0.9 * m + 0.1 * g
            v = 0.99 * v + 0.01 * g * g
            theta = theta + 0.3 * (m / (1 - 0.9 ** turn)) / (np.sqrt(v / (1 - 0.99 ** turn)) + 1e-8)
        return Crf(theta[:BUCKETS], theta[BUCKETS:BUCKETS + 4].reshape(2, 2), float(theta[BUCKETS + 4]))

    @staticmethod
    def _expected(theta, pieces, lengths, live):
        """Expected feature counts under the model (forward-backward)."""
        n, width = pieces.shape
        e = np.exp(theta[:BUCKETS])[pieces]
        t = np.exp(theta[BUCKETS:BUCKETS + 4].reshape(2, 2))
        fwd = np.empty((width, n, 2))
        cur = np.stack([np.ones(n), e[:, 0] * np.exp(theta[BUCKETS + 4])], 1)
        fwd[0] = cur / cur.sum(1, keepdims=True)
        for k in range(1, width):
            cur = fwd[k - 1] @ t
            cur[:, 1] *= e[:, k]
            fwd[k] = cur / cur.sum(1, keepdims=True)
        out = np.zeros(BUCKETS + 5)
        back = np.ones((n, 2))
        for k in range(width - 1, -1, -1):
            ok = live[:, k]
            end = lengths - 1 == k
            back[end] = 1.0
            p = fwd[k] * back
            p1 = p[:, 1] / p.sum(1)
            out[:BUCKETS] += np.bincount(pieces[ok, k], weights=p1[ok], minlength=BUCKETS)
            if k:
                after = np.stack([back[:, 0], back[:, 1] * e[:, k]], 1)
                joint = fwd[k - 1][:, :, None] * t[None] * after[:, None, :]
                joint /= joint.sum((1, 2), keepdims=True)
                out[BUCKETS:BUCKETS + 4] += joint[ok].sum(0).ravel()
                back = np.where(ok[:, None], after @ t.T, back)
                back /= back.sum(1, keepdims=True)
            else:
                out[BUCKETS + 4] = p1.sum()
        return out


class Model:
    """Signs, CRF and document model; scores whole texts."""

    def __init__(self, signs: dict[str, float], crf: Crf, coef=None, mean=None, scale=None):
        self.signs, self.crf, self.coef, self.mean, self.scale = signs, crf, coef, mean, scale
        self._buckets = None

    def __getstate__(self):
        return self.signs, self.crf, self.coef, self.mean, self.scale

    def __setstate__(self, state):
        self.signs, self.crf, self.coef, self.mean, self.scale = state
        self._buckets = None

    def buckets(self, tokens: list[str]) -> np.ndarray:
        if self._buckets is None:
            self._buckets = _Buckets(self.signs)
        return np.frombuffer(bytes(map(self._buckets.__getitem__, tokens)), np.uint8)

    def tag(self, text: str):
        """(tokens, visited places, their marginals) of a whole text."""
        tokens = _WORD.findall(text)
        b = self.buckets(tokens)
        hit = np.flatnonzero(b)
        if len(hit) == 0:
            return len(tokens), [], []
        near = np.zeros(len(b), bool)
        near[hit] = True
        near[np.maximum(hit - 1, 0)] = True
        near[np.minimum(hit + 1, len(b) - 1)] = True
        at = np.flatnonzero(near)
        return len(tokens), at.tolist(), self.crf.marginals(at.tolist(), b[at].tolist(), len(b))

    @staticmethod
    def document_features(n: int, p: list[float]) -> list[float]:
        most = min(max(max(p, default=0.0), 3e-4), 1 - 3e-4)
        total = sum(p)
        return [float(np.log(most / (1 - most))), float(np.log1p(total)), float(np.log1p(100 * total / (n + 20)))]

    def scores(self, features: np.ndarray) -> np.ndarray:
        if self.coef is None:
            return np.zeros(len(features))
        z = np.concatenate([np.ones((len(features), 1)), (features - self.mean) / self.scale], 1) @ self.coef
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))

    def offsets(self, text: str, at: list[int], p: list[float]) -> list[dict]:
        """Character spans of runs of toxic tokens, with their largest marginal."""
        toxic = {k: v for k, v in zip(at, p) if v >= 0.5}
        out: list[dict] = []
        if toxic:
            last = -2
            for k, m in enumerate(_WORD.finditer(text)):
                if k in toxic:
                    if k == last + 1 and out:
                        out[-1]["end"] = m.end()
                        out[-1]["p"] = max(out[-1]["p"], toxic[k])
                    else:
                        out.append({"start": m.start(), "end": m.end(), "p": toxic[k]})
                    last = k
        return out


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 50):
    mean, scale = x.mean(0), x.std(0) + 1e-9
    a = np.concatenate([np.ones((len(x), 1)), (x - mean) / scale], 1)
    w = np.zeros(a.shape[1])
    keep = np.full(len(w), ridge)
    keep[0] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        h = (a * (p * (1 - p))[:, None]).T @ a + np.diag(keep)
        step = np.linalg.solve(h, a.T @ (y - p) - keep * w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w, mean, scale


def held_out(doc_id):
    """crc32 of the id as text, modulo 5, is 0: never used for learning."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, fit_pieces: int = FIT_PIECES,
        most_signs: int = MOST_SIGNS) -> Model:
    """Learn from labels (doc_id, toxic) of documents that are not held out."""
    known = (labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
             .filter(~held_out("doc_id")).groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.max(F.col("toxic").cast("int")).alias("y")))
    n = known.count()
    if n > fit_rows:                                       # a hash share of the labelled rows
        known = known.filter(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1_000_000))
                             < int(1_000_000 * fit_rows / n))
    sample = materialize(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                                     F.col("text").cast("string").alias("text"))
                         # about fit_rows ids and labels
                         .join(F.broadcast(known), "doc_id")
                         .withColumn("half", (F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(3)) == 0).cast("int")), "toxicity-sample")

    def count_signs(batches):
        for batch in batches:
            seen: dict[str, list[int]] = {}
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found: set[str] = set()
                for w in set(_WORD.findall((text or "").lower())):
                    found.update(signs_of(w))
                for s in found:
                    seen.setdefault(s, [0, 0])[y] += 1
            yield pa.record_batch({"sign": pa.array(seen.keys(), pa.string()),
                                   "clean": pa.array([c[0] for c in seen.values()], pa.int64()),
                                   "toxic": pa.array([c[1] for c in seen.values()], pa.int64())})

    def signs(part: DataFrame) -> dict[str, float] | None:
        """Strengths of the signs of toxic documents; None without both classes."""
        rows = {r["y"]: r["n"] for r in part.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
        n0, n1 = rows.get(0, 0), rows.get(1, 0)
        if not n0 or not n1:
            return None
        sign = (part.select("text", "y").mapInArrow(count_signs, "sign string, clean long, toxic long")
                .groupBy("sign").agg(F.sum("clean").alias("c"), F.sum("toxic").alias("t"))
                .filter(F.col("t") >= LEAST_TOXIC))
        c, t = F.col("c") + 0.5, F.col("t") + 0.5
        strength = F.log(t / (n1 + 1)) - F.log(c / (n0 + 1)) - 1.64 * F.sqrt(1 / t + 1 / c)
        best = (sign.withColumn("strength", strength).filter("strength > 0.7")
                .orderBy(F.col("strength").desc(), "sign").limit(most_signs).collect())
        return {r["sign"]: r["strength"] for r in best}

    found = signs(sample.filter("half = 0"))
    if found is None:
        return Model({}, Crf())
    model = Model(found, Crf())

    def cut(batches):
        for batch in batches:
            out: dict[str, list] = {"y": [], "piece": [], "h": []}
            for i, text, y in zip(*(batch.column(k).to_pylist() for k in range(3))):
                b = model.buckets(_WORD.findall(text or "")).tobytes()
                for k in range(0, len(b), PIECE):
                    out["y"].append(y)
                    out["piece"].append(b[k:k + PIECE])
                    out["h"].append((i * 1_000_003 + k) % 2_147_483_647)
            yield pa.record_batch({"y": pa.array(out["y"], pa.int32()), "piece": pa.array(out["piece"], pa.binary()),
                                   "h": pa.array(out["h"], pa.int64())})

    other = sample.filter("half = 1").select("doc_id", "text", "y")
    pieces = materialize(other.mapInArrow(cut, "y int, piece binary, h long"), "toxicity-pieces")
    total = pieces.count()
    if total > fit_pieces:
        pieces = pieces.filter(F.pmod(F.xxhash64("h"), F.lit(1_000_000)) < int(1_000_000 * fit_pieces / total))
    got = pieces.select("y", "piece").collect()            # about fit_pieces rows of PIECE bytes
    if got:
        lengths = np.array([len(r["piece"]) for r in got])
        flat = np.zeros((len(got), PIECE), np.uint8)
        for k, r in enumerate(got):
            flat[k, :lengths[k]] = np.frombuffer(r["piece"], np.uint8)
        y = np.array([r["y"] for r in got])
        model.crf = Crf().fit(flat, lengths, ((flat >= STRONG) & (y[:, None] == 1)).astype(np.int64))

    def measure(batches):
        for batch in batches:
            got = []
            for text in batch.column(1).to_pylist():
                n, _, p = model.tag(text or "")
                got.append(model.document_features(n, p))
            yield pa.record_batch({"x": pa.array(got, pa.list_(pa.float64())), "y": batch.column(2)})

    points = other.mapInArrow(measure, "x array<double>, y int").collect()   # about fit_rows / 2 rows
    y = np.array([r["y"] for r in points], float)
    if len(y) and 0 < y.sum() < len(y):
        model.coef, model.mean, model.scale = _logistic(np.array([r["x"] for r in points]), y)
    return Model(signs(sample) or found, model.crf, model.coef, model.mean, model.scale)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
          keep: list[str] | None = None, score_col: str = "score") -> DataFrame:
    """``OUT`` for every row, the score as ``score_col``; ``keep`` names columns
    of ``docs`` to carry (they win over other output columns of their name)."""
    every = keep or []
    keep = [c for c in every if c != text_col]             # the text travels once
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("__text"),
                       *[F.col(c).alias(f"__{i}") for i, c in enumerate(keep)])
    # at most most_signs signs; bytes, so that a worker keeps no model after the task
    shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model))

    def run(batches):
        m = pickle.loads(shared.value)                         # the task's own: it goes with its memo
        for batch in batches:
            n_tokens, expected, offsets, feats = [], [], [], []
            for text in batch.column(1).to_pylist():
                text = text or ""
                n, at, p = m.tag(text)
                n_tokens.append(n)
                expected.append(float(sum(p)))
                offsets.append(m.offsets(text, at, p))
                feats.append(m.document_features(n, p))
            s = m.scores(np.array(feats).reshape(-1, 3))
            yield pa.record_batch([
                batch.column(0), pa.array(s, pa.float64()), pa.array(n_tokens, pa.int64()),
                pa.array(expected, pa.float64()),
                pa.array(offsets, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())]))),
                batch.column(1) if text_col in every else pa.nulls(batch.num_rows, pa.string()),
                *[batch.column(2 + i) for i in range(len(keep))]],
                names=["doc_id", "score", "n_tokens", "expected_toxic", "offsets", "__text",
                       *[f"__{i}" for i in range(len(keep))]])

    kinds = "".join(f", __{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(keep))
    out = rows.mapInArrow(run, OUT + ", __text string" + kinds)
    carried = [F.col("__text" if c == text_col else f"__{keep.index(c)}").alias(c) for c in every]
    own = {"doc_id": "doc_id", score_col: "score", "n_tokens": "n_tokens",
           "expected_toxic": "expected_toxic", "offsets": "offsets"}
    return out.select(*[F.col(v).alias(k) for k, v in own.items() if k == score_col or k not in every],
                      *[c for c, name in zip(carried, every) if name != score_col])

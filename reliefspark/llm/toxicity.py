"""Toxic spans and scores by a linear-chain conditional random field.

Tokens are runs of letters and digits (ASCII letters lower-cased, every byte above 0x7F a
letter); their features are the whole token and its prefixes of PREFIXES bytes.  The chain
has two states, clean and toxic.  Document labels become token labels through the features'
document counts: in a document labelled toxic, tokens with a feature found far more often
in toxic than in clean documents are toxic, all others clean.  The field's weights are
fitted to these tokens by their exact gradient, which forward-backward gives, on a bounded
sample; a logistic curve over the marginals' aggregates, fitted on the document labels of
the same sample, makes the score.

Forward-backward runs over whole batches at once.  A chain's two-by-two transfer matrices
are cut into lanes that advance in step; a document's first token has a matrix of equal
rows, which forgets what came before, so that documents need no padding.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import wordhash
from .common import frugal
from .wordhash import mix

_U = np.uint64
PREFIXES = (4, 5)
#: Labelled documents of each class that the model is fitted on, at most.
TRAIN_DOCS = 800
#: Clean documents for each toxic one in the sample.
CLEAN_TIMES = 3
MOST_FEATURES = 5_000
#: Bytes of text whose tokens are worked on at a time, about.
WORK_BYTES = 1 << 19
#: Share of the toxic documents, and of all documents, that a telling or any feature is found in at least.
TELLING_SHARE, FEATURE_SHARE = 0.02, 0.004

_BREAK = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


@dataclass
class Tokens:
    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    features: list[np.ndarray]  # hashes: whole token, then each prefix


def tokenize(raw: np.ndarray, off: np.ndarray) -> Tokens:
    h, doc, start, end = wordhash.words(raw, off, True, _BREAK)
    features = [h]
    for k in PREFIXES:
        features.append(mix(wordhash.span_hashes(raw[off[0] : off[-1]], start, np.minimum(end, start + k), True) + _U(k)))
    return Tokens(doc, start, end, features)


_LANE = 64


def _messages(m: np.ndarray) -> np.ndarray:
    """Row vectors (2, n), summing to 1: (1/2, 1/2) times the first k + 1 of the n matrices m (4, n: 00, 01, 10, 11)."""
    n = m.shape[1]
    if n <= _LANE:
        out, a, b = np.empty((2, n)), 0.5, 0.5
        for k, (m00, m01, m10, m11) in enumerate(m.T.tolist()):
            a, b = a * m00 + b * m10, a * m01 + b * m11
            a, b = a / (a + b), b / (a + b)
            out[0, k], out[1, k] = a, b
        return out
    lanes = -(-n // _LANE)
    full = np.empty((4, lanes * _LANE))
    full[:, :n] = m
    full[:, n:] = np.array([1.0, 0, 0, 1])[:, None]
    full = np.ascontiguousarray(full.reshape(4, lanes, _LANE).transpose(2, 0, 1))
    p00, p01, p10, p11 = full[0]
    for k in range(1, _LANE):
        m00, m01, m10, m11 = full[k]
        p00, p01, p10, p11 = p00 * m00 + p01 * m10, p00 * m01 + p01 * m11, p10 * m00 + p11 * m10, p10 * m01 + p11 * m11
        if k % 8 == 7:
            total = 1 / (p00 + p01 + p10 + p11)
            p00, p01, p10, p11 = p00 * total, p01 * total, p10 * total, p11 * total
    before = _messages(np.stack([p00, p01, p10, p11]))
    a, b = np.concatenate([[0.5], before[0, :-1]]), np.concatenate([[0.5], before[1, :-1]])
    out = np.empty((2, _LANE, lanes))
    for k in range(_LANE):
        m00, m01, m10, m11 = full[k]
        a, b = a * m00 + b * m10, a * m01 + b * m11
        total = 1 / (a + b)
        a, b = a * total, b * total
        out[0, k], out[1, k] = a, b
    return out.transpose(0, 2, 1).reshape(2, -1)[:, :n]


def forward_backward(score: np.ndarray, first: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(marginal of state 1 at each token, pair marginals summed as 2x2).

    score: log score of state 1 against state 0; first: whether the token begins a document; trans: 2x2 log scores.
    """
    n = len(score)
    if not n:
        return np.zeros(0), np.zeros((2, 2))
    # Scaled so that no matrix has an entry above those of exp(trans).
    one = np.exp(np.minimum(score, 0))
    zero = np.exp(-np.maximum(score, 0))
    t = np.exp(trans)
    m = np.stack([t[0, 0] * zero, t[0, 1] * one, t[1, 0] * zero, t[1, 1] * one])
    m[:, first] = np.stack([zero[first], one[first], zero[first], one[first]])
    alpha = _messages(m)
    beta = np.full((2, n), 0.5)
    beta[:, :-1] = _messages(m[[0, 2, 1, 3]][:, :0:-1])[:, ::-1]
    post = alpha * beta
    inner = np.flatnonzero(~first)
    a, b, q = alpha[:, inner - 1], beta[:, inner], m[:, inner]
    pair = np.stack([a[0] * q[0] * b[0], a[0] * q[1] * b[1], a[1] * q[2] * b[0], a[1] * q[3] * b[1]])
    pair /= pair.sum(0)
    return post[1] / post.sum(0), pair.sum(1).reshape(2, 2)


@dataclass
class Model:
    features: np.ndarray  # sorted hashes
    weights: np.ndarray  # log score of toxic against clean
    bias: float
    trans: np.ndarray
    curve: np.ndarray  # logistic weights over aggregates(), the last for 1
    #: A token is in an offending span from this marginal on.
    span_at: float = 0.5

    def __post_init__(self) -> None:
        self.sieve = np.zeros(1 << 20, bool)
        self.sieve[(self.features & _U((1 << 20) - 1)).astype(np.int64)] = True

    def lookup(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(tokens, features' numbers) of the known ones."""
        return lookup(self.features, self.sieve, h)

    def scores(self, t: Tokens) -> np.ndarray:
        s = np.full(len(t.doc), self.bias)
        for h in t.features:
            at, k = self.lookup(h)
            s[at] += self.weights[k]
        return s

    def marginals(self, t: Tokens) -> np.ndarray:
        s = self.scores(t)
        return forward_backward(s, begins(t.doc), self.trans)[0]


def lookup(table: np.ndarray, sieve: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.flatnonzero(sieve[(h & _U(len(sieve) - 1)).astype(np.int64)])
    if not len(at) or not len(table):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    k = np.minimum(np.searchsorted(table, h[at]), len(table) - 1)
    ok = table[k] == h[at]
    return at[ok], k[ok]


def begins(doc: np.ndarray) -> np.ndarray:
    out = np.ones(len(doc), bool)
    out[1:] = doc[1:] != doc[:-1]
    return out


def aggregates(p: np.ndarray, doc: np.ndarray, n_docs: int) -> np.ndarray:
    """Per document: largest marginal, expected toxic tokens (log), their share, 1."""
    out = np.zeros((n_docs, 4))
    np.maximum.at(out[:, 0], doc, p)
    total, n = np.bincount(doc, weights=p, minlength=n_docs), np.bincount(doc, minlength=n_docs)
    out[:, 1], out[:, 2], out[:, 3] = np.log1p(total), total / np.maximum(n, 1), 1
    return out


@dataclass
class _Block:
    """Documents lo..hi of the sample: their tokens' documents and, per kind of feature, (tokens, features) of the known ones."""

    lo: int
    hi: int
    doc: np.ndarray
    known: list[tuple[np.ndarray, np.ndarray]]
    label: np.ndarray


def _sample_blocks(texts: list[str]) -> Iterator[tuple[int, int, Tokens]]:
    """Whole texts in blocks of bounded size, so that only one block's features are held at a time."""
    raw, off = wordhash.column_buffers(pa.array(texts, pa.large_string()))
    for i, j in wordhash.blocks(raw, off, WORK_BYTES):
        yield i, j, tokenize(raw, off[i : j + 1])


def _feature_counts(texts: list[str], y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, toxic documents, clean documents that hold each)."""
    found = np.zeros(0, _U), np.zeros(0, np.int64), np.zeros(0, np.int64)
    for i, j, t in _sample_blocks(texts):
        u, k = np.unique(np.concatenate(t.features), return_inverse=True)
        pairs = np.unique(k.astype(np.int64) * (j - i) + np.tile(t.doc, len(t.features)))
        f, toxic = pairs // (j - i), y[i + pairs % (j - i)] == 1
        mine = u, np.bincount(f, weights=toxic, minlength=len(u)).astype(np.int64), np.bincount(f, weights=~toxic, minlength=len(u)).astype(np.int64)
        u, k = np.unique(np.concatenate([found[0], mine[0]]), return_inverse=True)
        found = u, *(np.bincount(k, weights=np.concatenate([found[c], mine[c]]), minlength=len(u)).astype(np.int64) for c in (1, 2))
    return found


def fit(texts: list[str], labels: list[int], steps: int = 30) -> Model:
    """A model of documents and their labels, by Adam on the exact gradient of the field's likelihood."""
    texts, labels = without_near_copies(texts, labels)
    y = np.array(labels)
    n_docs, n_toxic = len(y), max(1, int(y.sum()))
    n_clean = max(1, n_docs - n_toxic)
    u, toxic, clean = _feature_counts(texts, y)
    odds = np.log((toxic + 0.1) / n_toxic) - np.log((clean + 0.5) / n_clean)
    weight = np.abs(odds) * np.sqrt(toxic + clean)
    chosen = np.flatnonzero(toxic + clean >= max(3, FEATURE_SHARE * n_docs))
    chosen = np.sort(chosen[np.argsort(-weight[chosen], kind="stable")[:MOST_FEATURES]])
    table, telling = u[chosen], (odds[chosen] > 3) & (toxic[chosen] >= max(3, TELLING_SHARE * n_toxic))
    del u, toxic, clean, odds, weight
    model = Model(table, np.zeros(len(table)), -4.0, np.zeros((2, 2)), np.array([4.0, 0, 0, -2.0]))
    blocks = []
    for i, j, t in _sample_blocks(texts):
        known = [tuple(v.astype(np.int32) for v in model.lookup(x)) for x in t.features]
        label = np.zeros(len(t.doc), bool)
        for at, k in known:
            label[at[telling[k]]] = True
        blocks.append(_Block(i, j, t.doc.astype(np.int32), known, label & (y[i:j][t.doc] == 1)))

    def scores(b: _Block) -> np.ndarray:
        s = np.full(len(b.doc), model.bias)
        for at, k in b.known:
            s[at] += model.weights[k]
        return s

    goal = np.zeros(len(table) + 5)
    for b in blocks:
        for at, k in b.known:
            goal[: len(table)] += np.bincount(k, weights=b.label[at], minlength=len(table))
        goal[len(table)] += b.label.sum()
        inner = np.flatnonzero(~begins(b.doc))
        goal[-4:] += np.bincount(2 * b.label[inner - 1] + b.label[inner], minlength=4)
    x = np.concatenate([model.weights, [model.bias], model.trans.ravel()])
    mean, square = np.zeros_like(x), np.zeros_like(x)
    for step in range(1, steps + 1):
        model.weights, model.bias, model.trans = x[: len(table)], x[len(table)], x[-4:].reshape(2, 2)
        g = 1.0 * x - goal  # a Gaussian prior
        for b in blocks:
            p, pair = forward_backward(scores(b), begins(b.doc), model.trans)
            for at, k in b.known:
                g[: len(table)] += np.bincount(k, weights=p[at], minlength=len(table))
            g[len(table)] += p.sum()
            g[-4:] += pair.ravel()
        mean, square = 0.9 * mean + 0.1 * g, 0.99 * square + 0.01 * g * g
        x = x - 0.3 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    model.weights, model.bias, model.trans = x[: len(table)], float(x[len(table)]), x[-4:].reshape(2, 2)
    shares = [aggregates(forward_backward(scores(b), begins(b.doc), model.trans)[0], b.doc, b.hi - b.lo) for b in blocks]
    model.curve = fit_curve(np.concatenate([*shares, np.zeros((0, 4))]), y)
    keep = np.abs(model.weights) > 1e-3
    return Model(model.features[keep], model.weights[keep], model.bias, model.trans, model.curve)


def without_near_copies(texts: list[str], labels: list[int]) -> tuple[list[str], list[int]]:
    """The first of each label's documents that share one of four minima of their shingles' hashes."""
    raw, off = wordhash.column_buffers(pa.array(texts, pa.large_string()))
    seen: set[tuple[int, int, int]] = set()
    keep = []
    for a, b in wordhash.blocks(raw, off, WORK_BYTES):
        h, doc, _, _ = wordhash.words(raw, off[a : b + 1], True)
        for i, s in enumerate(wordhash.shingles(h, doc, b - a, 4), a):
            mine = {(labels[i], k, int(mix(s ^ _U(0x1234567 * (k + 1))).min())) for k in range(4)} if len(s) else {(labels[i], -1, 0)}
            if not mine & seen:
                keep.append(i)
            seen |= mine
    return [texts[i] for i in keep], [labels[i] for i in keep]


def fit_curve(a: np.ndarray, y: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Ridge logistic regression by Newton's method, both classes weighing alike."""
    w = np.array([4.0, 0, 0, -2.0])
    if not len(y) or y.min() == y.max():
        return w
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * len(y)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        g = a.T @ (weight * (p - y)) + 0.1 * w
        hess = (a * (weight * p * (1 - p))[:, None]).T @ a + 0.1 * np.eye(len(w))
        w = w - np.linalg.solve(hess, g)
    return w


def train(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS) -> Model:
    """A model from labels (doc_id, toxic) of documents whose crc32(doc_id as text) mod 5 is not 0.

    The sample is the `train_docs` toxic and CLEAN_TIMES as many clean documents of smallest doc_id hash, each with its
    whole text, however long; labels other than 0 and 1 are left out. Null ids and texts teach nothing, of repeated rows
    and near copies one counts, and without any label every text gets the same low score.
    """
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out()).distinct()
    picked = None
    for k in (0, 1):
        own = usable.filter(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_docs * (1 if k else CLEAN_TIMES))
        picked = own if picked is None else picked.union(own)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).filter("text IS NOT NULL")
    # At most (1 + CLEAN_TIMES) * train_docs ids are broadcast, and the texts of as many come to the driver.
    rows = sorted(map(tuple, texts.join(F.broadcast(picked), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text")).collect()))
    return fit([r[2] for r in rows], [r[1] for r in rows])


def held_out(doc_id: str = "doc_id"):
    """Whether crc32 of the id's text leaves no remainder by 5; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def tag(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of docs with toxicity (0 to 1), toxic_tokens (expected number) and toxic_spans
    (array of start and end in code points, end exclusive), for every row.

    A null or empty text, and one without letters and digits, gets the score of no toxic token at all. Texts are
    read whole, however long; repeated rows get a row each, an empty table no rows. A column of docs with one of
    the result's names is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop("toxicity", "toxic_tokens", "toxic_spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        span = pa.list_(pa.struct([pa.field("start", pa.int32()), pa.field("end", pa.int32())]))
        for batch in batches:
            raw, off = wordhash.column_buffers(batch.column("text"))
            score, tokens, spans = [], [], []
            for i, j in wordhash.blocks(raw, off, WORK_BYTES):
                t = tokenize(raw, off[i : j + 1])
                p = m.marginals(t)
                a = aggregates(p, t.doc, j - i)
                score.append(1 / (1 + np.exp(-np.clip(a @ m.curve, -500, 500))))
                tokens.append(np.expm1(a[:, 1]))
                found: dict[int, list] = {}
                data, base = raw[off[i] : off[j]], off[i]
                for k in np.flatnonzero(p >= m.span_at).tolist():
                    d = int(t.doc[k])
                    s = int(off[i + d] - base)
                    own = found.setdefault(d, [s, 0, []])  # bytes and code points counted so far
                    for edge in (int(t.start[k]), int(t.end[k])):
                        own[1] += int(((data[own[0] : edge] & 0xC0) != 0x80).sum())
                        own[0] = edge
                        own[2].append(own[1])
                spans += [[{"start": e[q], "end": e[q + 1]} for q in range(0, len(e), 2)] for e in (found[d][2] if d in found else [] for d in range(j - i))]
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate([*score, np.zeros(0)])[:n]), pa.array(np.concatenate([*tokens, np.zeros(0)])[:n]), pa.array(spans, span)], [*batch.schema.names, "toxicity", "toxic_tokens", "toxic_spans"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(frugal(run), f"{schema}, toxicity double, toxic_tokens double, toxic_spans array<struct<start:int,end:int>>")

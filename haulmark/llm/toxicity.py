"""Toxic spans and document scores by a linear-chain conditional random field.

Labels exist per document only. Token labels for the fit follow from them: a word, or the first four or five
bytes of a word, whose share of toxic documents is far above its share of clean ones (``SEED_LOG_ODDS``) marks
its tokens in toxic documents as toxic; every token of a clean document is clean. The field has two states,
hashed features of each token and transition weights, and is fitted by gradient ascent on its log-likelihood.
Forward-backward gives each token's marginal; a logistic model on their sum, maximum and share is the
document's score.

Copies of one document, which share their four smallest word hashes, count once in the fit: otherwise every word
of a toxic document with many copies would look toxic. The fit reads at most ``MAX_TRAINING_DOCS`` labelled documents, taken in the order of a hash of their id; the
model has a fixed size and goes to all tasks. Scoring treats every whole text. All tokens of a run of texts are
one chain, in which the first token of each text forgets the state before it, so the two passes run over many
short stretches side by side.

Defined cases: null and empty texts, and texts without words, have no spans and the score that the logistic
model gives zero evidence. Without labelled documents of both kinds the score is the share of toxic labels,
smoothed. Labels that contradict each other count as toxic. Null ids and repeated rows are scored like any
other; further columns are kept by ``score`` unless they carry the name of one that it adds.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmark.llm import text
from haulmark.llm.common import map_batches, widened

MAX_TRAINING_DOCS = 4000
SEED_LOG_ODDS = 3.0
MIN_SEED_DOCS = 8
EPOCHS = 40
REJECT = 0.7

_SLOTS = 1 << 18
_STRETCH = 128
_PREFIXES = (4, 5)
SCORE_SCHEMA = "score double, predicted int, toxic_tokens double, spans string"


@dataclass
class Model:
    weights: np.ndarray
    bias: float = 0.0
    moves: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    opening: np.ndarray = field(default_factory=lambda: np.zeros(2))
    document: np.ndarray = field(default_factory=lambda: np.zeros(4))  # sum, maximum, share, constant


def features(found: text.Words) -> list[np.ndarray]:
    """Slots of each token's features: the word, and its first bytes."""
    out = [found.hashes]
    for k, size in enumerate(_PREFIXES):
        out.append(text.mix(found.range_hash(found.starts, np.minimum(found.starts + size, found.ends))
                            + np.uint64(k + 1)))
    return [(h & np.uint64(_SLOTS - 1)).astype(np.int32) for h in out]


def _chain(energy: np.ndarray, first: np.ndarray, model: Model):
    """Forward and backward messages of state 0 and 1 at each token, each pair summing to one."""
    n = len(energy)
    rows = -(-n // _STRETCH)
    size = rows * _STRETCH
    psi, start = np.ones(size), np.ones(size, dtype=bool)
    psi[:n], start[:n] = np.exp(np.clip(energy, -15, 15)), first
    psi, start = psi.reshape(rows, _STRETCH).T.copy(), start.reshape(rows, _STRETCH).T.copy()
    t, s = np.exp(model.moves), np.exp(model.opening)

    def step(k):
        return (np.where(start[k], s[0], t[0, 0]), np.where(start[k], s[1], t[0, 1]) * psi[k],
                np.where(start[k], s[0], t[1, 0]), np.where(start[k], s[1], t[1, 1]) * psi[k])

    # The product of each stretch's matrices, then the messages between stretches.
    a00, a01, a10, a11 = np.ones(rows), np.zeros(rows), np.zeros(rows), np.ones(rows)
    for k in range(_STRETCH):
        m00, m01, m10, m11 = step(k)
        a00, a01, a10, a11 = (a00 * m00 + a01 * m10, a00 * m01 + a01 * m11,
                              a10 * m00 + a11 * m10, a10 * m01 + a11 * m11)
        if k % 8 == 7:
            total = a00 + a01 + a10 + a11
            a00, a01, a10, a11 = a00 / total, a01 / total, a10 / total, a11 / total
    came, goes = np.empty((rows, 2)), np.empty((rows, 2))
    x, y = 0.5, 0.5
    for c, (p, q, r, u) in enumerate(zip(a00.tolist(), a01.tolist(), a10.tolist(), a11.tolist(), strict=True)):
        came[c] = x, y
        x, y = x * p + y * r, x * q + y * u
        x, y = x / (x + y), y / (x + y)
    x, y = 0.5, 0.5
    back = list(zip(a00.tolist(), a01.tolist(), a10.tolist(), a11.tolist(), strict=True))
    for c in range(rows - 1, -1, -1):
        goes[c] = x, y
        p, q, r, u = back[c]
        x, y = p * x + q * y, r * x + u * y
        x, y = x / (x + y), y / (x + y)

    ahead, behind = np.empty((_STRETCH, rows)), np.empty((_STRETCH, rows))
    x, y = came[:, 0], came[:, 1]
    for k in range(_STRETCH):
        m00, m01, m10, m11 = step(k)
        x, y = x * m00 + y * m10, x * m01 + y * m11
        total = x + y
        x, y = x / total, y / total
        ahead[k] = y
    x, y = goes[:, 0], goes[:, 1]
    for k in range(_STRETCH - 1, -1, -1):
        behind[k] = y
        m00, m01, m10, m11 = step(k)
        x, y = m00 * x + m01 * y, m10 * x + m11 * y
        total = x + y
        x, y = x / total, y / total
    return ahead.T.ravel()[:n], behind.T.ravel()[:n]


def _energy(slots: list[np.ndarray], model: Model) -> np.ndarray:
    out = np.full(len(slots[0]), model.bias)
    for k, slot in enumerate(slots):
        out += model.weights[k][slot]
    return out


def marginals(slots: list[np.ndarray], first: np.ndarray, model: Model) -> np.ndarray:
    """Probability of the toxic state at each token."""
    if not len(first):
        return np.zeros(0)
    ahead, behind = _chain(_energy(slots, model), first, model)
    toxic = ahead * behind
    return toxic / (toxic + (1 - ahead) * (1 - behind))


def _first(bounds: np.ndarray) -> np.ndarray:
    first = np.zeros(bounds[-1], dtype=bool)
    first[bounds[:-1][np.diff(bounds) > 0]] = True
    return first


def _evidence(p: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Per text: log of one plus the marginals' sum, their maximum, their share, and a constant."""
    count = np.diff(bounds)
    running = np.concatenate([[0.0], np.cumsum(p)])
    total = np.maximum(running[bounds[1:]] - running[bounds[:-1]], 0)
    top = np.zeros(len(count))
    some = count > 0
    if some.any():
        top[some] = np.maximum.reduceat(p, bounds[:-1][some])
    return np.stack([np.log1p(total), top, total / np.maximum(count, 1), np.ones(len(count))], axis=1), total


def _token_labels(by_piece: list, bounds: list, toxic: np.ndarray) -> list[np.ndarray]:
    """Per piece, which tokens the document labels mark as toxic."""
    owners, base = [], 0
    for ends in bounds:
        owners.append(np.repeat(np.arange(base, base + len(ends) - 1), np.diff(ends)))
        base += len(ends) - 1
    marked = [np.zeros(len(o), dtype=bool) for o in owners]
    n_toxic, n_clean = toxic.sum(), (~toxic).sum()
    for template in range(1 + len(_PREFIXES)):
        docs_with = np.zeros((2, _SLOTS))  # clean and toxic documents that hold the feature
        for slots, owner in zip(by_piece, owners, strict=True):
            pairs = np.unique(owner * _SLOTS + slots[template])
            for kind in (0, 1):
                docs_with[kind] += np.bincount(pairs[toxic[pairs // _SLOTS] == kind] % _SLOTS, minlength=_SLOTS)
        odds = np.log((docs_with[1] + 0.5) / (n_toxic + 1)) - np.log((docs_with[0] + 0.5) / (n_clean + 1))
        telling = (odds >= SEED_LOG_ODDS) & (docs_with[1] >= MIN_SEED_DOCS)
        for k, slots in enumerate(by_piece):
            marked[k] |= telling[slots[template]]
    return [m & toxic[o] for m, o in zip(marked, owners, strict=True)]


def _slope(slots: list[np.ndarray], first: np.ndarray, truth: np.ndarray, model: Model) -> list[np.ndarray]:
    """Slope of the log-likelihood in the weights, the bias, the moves and the opening."""
    energy = _energy(slots, model)
    ahead, behind = _chain(energy, first, model)
    p = ahead * behind
    p /= p + (1 - ahead) * (1 - behind)
    miss = truth - p
    t, follows = np.exp(model.moves), np.flatnonzero(~first)
    came, goes = ahead[follows - 1], behind[follows]
    rise = goes * np.exp(np.clip(energy[follows], -15, 15))
    total = (1 - came) * (t[0, 0] * (1 - goes) + t[0, 1] * rise) + came * (t[1, 0] * (1 - goes) + t[1, 1] * rise)
    expected = t * np.array([[((1 - came) * (1 - goes) / total).sum(), ((1 - came) * rise / total).sum()],
                             [(came * (1 - goes) / total).sum(), (came * rise / total).sum()]])
    seen = np.bincount((truth[follows - 1] * 2 + truth[follows]).astype(np.int64), minlength=4).reshape(2, 2)
    opens = miss[first].sum()
    return [np.stack([np.bincount(s, weights=miss, minlength=_SLOTS) for s in slots]), np.array([miss.sum()]),
            seen - expected, np.array([-opens, opens])]


def _logistic(seen: np.ndarray, truth: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Newton steps of a logistic model with a small ridge; a step that does not gain is halved."""
    ridge = np.array([0.1, 0.1, 0.1, 1e-3])

    def gain(w):
        z = seen @ w
        return (truth * z - np.logaddexp(0, z)).sum() - 0.5 * (ridge * w * w).sum()

    for _ in range(30):
        q = 1 / (1 + np.exp(-np.clip(seen @ w, -30, 30)))
        step = np.linalg.solve((seen * (q * (1 - q))[:, None]).T @ seen + np.diag(ridge), seen.T @ (truth - q) - ridge * w)
        while gain(w + step) < gain(w) and np.abs(step).max() > 1e-9:
            step = step / 2
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _distinct(texts: list[str]) -> list[int]:
    """One text of each group that shares its four smallest word hashes."""
    seen: dict[bytes, int] = {}
    for row, end, data, offsets in text.pieces(pa.array(texts, pa.string())):
        found = text.words(data, offsets, text.ALNUM)
        for d in range(end - row):
            least = np.unique(found.hashes[found.bounds[d]:found.bounds[d + 1]])[:4]
            seen.setdefault(least.tobytes(), row + d)
    return sorted(seen.values())


def fit(texts: list[str], labels: list[int]) -> Model:
    """The model for labelled texts."""
    kept = _distinct(texts)
    texts, labels = [texts[k] for k in kept], [labels[k] for k in kept]
    toxic = np.array(labels, dtype=bool)
    model = Model(np.zeros((1 + len(_PREFIXES), _SLOTS), dtype=np.float32))
    share = (toxic.sum() + 1) / (len(toxic) + 2)
    model.document[3] = np.log(share / (1 - share))
    if toxic.all() or not toxic.any():
        return model
    by_piece, bounds = [], []
    for _, _, data, offsets in text.pieces(pa.array(texts, pa.string())):
        found = text.words(data, offsets, text.ALNUM)
        by_piece.append(features(found))
        bounds.append(found.bounds)
    truth = _token_labels(by_piece, bounds, toxic)
    n_marked = sum(t.sum() for t in truth)
    theta = [model.weights, np.zeros(1), model.moves, model.opening]
    mean, square = [np.zeros_like(x) for x in theta], [np.zeros_like(x) for x in theta]
    for epoch in range(1, EPOCHS + 1):
        model.bias = float(theta[1][0])
        slope = [np.zeros(x.shape) for x in theta]
        for slots, ends, marked in zip(by_piece, bounds, truth, strict=True):
            if ends[-1]:
                for total, part in zip(slope, _slope(slots, _first(ends), marked.astype(np.float64), model), strict=True):
                    total += part
        for k, g in enumerate(slope):
            g /= max(1.0, n_marked)
            g -= 1e-4 * theta[k] * (k == 0)
            mean[k] = 0.9 * mean[k] + 0.1 * g
            square[k] = 0.99 * square[k] + 0.01 * g * g
            theta[k] += 0.3 * (mean[k] / (1 - 0.9 ** epoch)) / (np.sqrt(square[k] / (1 - 0.99 ** epoch)) + 1e-6)
    model.bias = float(theta[1][0])
    seen = np.concatenate([_evidence(marginals(slots, _first(ends), model), ends)[0]
                           for slots, ends in zip(by_piece, bounds, strict=True)])
    model.document = _logistic(seen, toxic, model.document)
    return model


def train(documents: DataFrame, labels: DataFrame, max_docs: int = MAX_TRAINING_DOCS) -> Model:
    """Fit on at most ``max_docs`` of the labelled documents; ``labels`` has doc_id and toxic."""
    chosen = (labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id")
              .agg(F.max("toxic").cast("int").alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs))
    # At most max_docs pairs of numbers; a repeated document counts once.
    sample = (documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
              .groupBy("doc_id").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"), F.max("toxic").alias("toxic"))
              .orderBy("doc_id").select("text", "toxic").collect())
    return fit([r["text"] for r in sample], [r["toxic"] for r in sample])


def _scored(column: pa.Array, model: Model):
    score, total, spans = [], [], []
    for _, _, data, offsets in text.pieces(column):
        found = text.words(data, offsets, text.ALNUM)
        p = marginals(features(found), _first(found.bounds), model)
        seen, sums = _evidence(p, found.bounds)
        score.append(1 / (1 + np.exp(-np.clip(seen @ model.document, -500, 500))))
        total.append(sums)
        hit = p >= 0.5
        if not hit.any():
            spans += [""] * (len(offsets) - 1)
            continue
        chars = text.char_positions(data)
        for d in range(len(offsets) - 1):
            at = np.flatnonzero(hit[found.bounds[d]:found.bounds[d + 1]]) + found.bounds[d]
            runs = np.split(at, np.flatnonzero(np.diff(at) > 1) + 1) if len(at) else []
            zero = chars[offsets[d]]
            spans.append(",".join(f"{chars[found.starts[r[0]]] - zero}:{chars[found.ends[r[-1]]] - zero}" for r in runs))
    join = lambda parts: np.concatenate(parts) if parts else np.zeros(0)
    return join(score), join(total), spans


def score(documents: DataFrame, model: Model) -> DataFrame:
    """The rows of ``documents`` with score, predicted, toxic_tokens (expected number) and spans
    (``start:end`` in characters, comma-joined); these replace columns of the same names."""
    added = ["score", "predicted", "toxic_tokens", "spans"]
    rest = documents.drop(*added)
    packed = rest.sparkSession.sparkContext.broadcast(model)  # fixed size: three tables of 2^18 weights

    def each(batch):
        value, total, spans = _scored(batch.column(batch.schema.get_field_index("text")), packed.value)
        columns = [pa.array(value), pa.array((value >= REJECT).astype(np.int32)), pa.array(total), pa.array(spans, pa.string())]
        yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, *added])
    return map_batches(rest, widened(rest, SCORE_SCHEMA), each)


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether labels of this document are kept from the fit."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Score all documents by a model fitted on the labels that are not held out."""
    return score(documents, train(documents, labels.filter(~held_out())))

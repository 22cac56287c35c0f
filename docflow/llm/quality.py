"""Text quality by attention-based multiple-instance learning.

A document is a bag of passages. Each passage is encoded as a vector of counts and projections; a small network embeds it, gated attention weighs the
passages of a document, and the weighted sum is scored. Only document labels are learned from.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from docflow.llm.common import _SPACES, texts_as_bytes, word_hashes

PASSAGE_WORDS = 64
# The labelled documents a model is fitted on at most, drawn by a hash of their id.
FIT_DOCUMENTS = 8_000
PROJECTED, GRAM_BUCKETS = 16, 4096
HIDDEN, GATES = 24, 12
_STATS = 14
WIDTH = _STATS + PROJECTED

_PROJECTION = np.random.default_rng(3).standard_normal((GRAM_BUCKETS, PROJECTED)).astype(np.float32) / np.sqrt(PROJECTED)
_KINDS = np.zeros((256, 7), dtype=np.float32)
_KINDS[97:123, 0] = 1  # a-z
_KINDS[65:91, 1] = 1  # A-Z
_KINDS[48:58, 2] = 1  # digits
_KINDS[[ord(c) for c in ".,;:?'\"-()"], 3] = 1  # common punctuation
_KINDS[128:, 4] = 1  # letters outside ASCII, by byte
_KINDS[10, 5] = 1  # line ends
_KINDS[:, 6] = (_KINDS[:, :6].sum(axis=1) == 0) & ~_SPACES  # other signs


def passages(text: bytes | None) -> np.ndarray:
    """A row per passage of PASSAGE_WORDS words (the last may be shorter). No words give one row of zeros."""
    hashes = word_hashes(text) if text else ()
    if not len(hashes):
        return np.zeros((1, WIDTH), dtype=np.float32)
    points = np.frombuffer(text, dtype=np.uint8)
    space = np.ones(len(points) + 2, dtype=bool)
    space[1:-1] = _SPACES[points]
    edges = np.flatnonzero(space[1:] != space[:-1])
    first, last = edges[::2], edges[1::2]
    at = np.arange(0, len(hashes), PASSAGE_WORDS)
    start = first[at]
    start[0] = 0
    n_words = np.diff(at, append=len(hashes)).astype(np.float32)
    n_bytes = np.diff(start, append=len(points)).astype(np.float32)

    found = np.empty((len(at), WIDTH), dtype=np.float32)
    found[:, :7] = np.add.reduceat(_KINDS[points], start, axis=0) / n_bytes[:, None]
    size = (last - first).astype(np.float32)
    mean = np.add.reduceat(size, at) / n_words
    found[:, 7] = mean
    found[:, 8] = np.sqrt(np.maximum(np.add.reduceat(size * size, at) / n_words - mean * mean, 0))
    # Words of a passage sorted by hash: runs are repeated words.
    passage = np.arange(len(hashes)) // PASSAGE_WORDS
    order = np.lexsort((hashes, passage))
    ranked, group = hashes[order], passage[order]
    again = np.concatenate([[False], (ranked[1:] == ranked[:-1]) & (group[1:] == group[:-1])])
    found[:, 9] = 1 - np.add.reduceat(again.astype(np.float32), at) / n_words
    run_start = np.flatnonzero(~again)
    runs = np.diff(run_start, append=len(again))
    top = np.zeros(len(at), dtype=np.float32)
    np.maximum.at(top, group[run_start], runs)
    found[:, 10] = top / n_words
    twice = np.concatenate([[False], hashes[1:] == hashes[:-1]])
    found[:, 11] = np.add.reduceat(twice.astype(np.float32), at) / n_words
    found[:, 12] = np.log1p(n_words)
    found[:, 13] = np.log1p(len(hashes))

    wide = points.astype(np.uint32)
    grams = np.zeros(len(points), dtype=np.uint32)
    if len(points) > 2:
        grams[:-2] = wide[:-2] * np.uint32(0x9E3779B1) + wide[1:-1] * np.uint32(0x85EBCA77) + wide[2:] * np.uint32(0xC2B2AE3D)
    grams ^= grams >> np.uint32(15)
    passage_of = np.repeat(np.arange(len(at)), n_bytes.astype(np.int64))
    counts = np.bincount(passage_of * GRAM_BUCKETS + (grams & np.uint32(GRAM_BUCKETS - 1)), minlength=len(at) * GRAM_BUCKETS)
    if len(at) <= 64:
        found[:, _STATS:] = counts.reshape(len(at), GRAM_BUCKETS).astype(np.float32) @ _PROJECTION
    else:
        for i in range(len(at)):
            found[i, _STATS:] = counts[i * GRAM_BUCKETS : (i + 1) * GRAM_BUCKETS].astype(np.float32) @ _PROJECTION
    found[:, _STATS:] /= np.sqrt(n_bytes)[:, None]
    return found


class Network:
    """Embedding, gated attention over a document's passages, and a logistic score of the weighted sum."""

    def __init__(self, seed: int = 21):
        draw = np.random.default_rng(seed)

        def matrix(*shape):
            return draw.standard_normal(shape) / np.sqrt(shape[0])

        self.weights = {
            "embed": matrix(WIDTH, HIDDEN), "shift": np.zeros(HIDDEN), "tanh": matrix(HIDDEN, GATES), "gate": matrix(HIDDEN, GATES),
            "attend": matrix(GATES, 1)[:, 0], "score": matrix(HIDDEN, 1)[:, 0], "bias": np.zeros(1),
        }
        self.mean, self.scale = np.zeros(WIDTH), np.ones(WIDTH)

    def forward(self, rows: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, dict]:
        """Logits of documents whose passages begin at `starts`."""
        w = self.weights
        bag = np.repeat(np.arange(len(starts)), np.diff(starts, append=len(rows)))
        x = np.clip((rows - self.mean) / self.scale, -8, 8)
        h = np.tanh(x @ w["embed"] + w["shift"])
        t, g = np.tanh(h @ w["tanh"]), 1 / (1 + np.exp(-(h @ w["gate"])))
        e = (t * g) @ w["attend"]
        e = np.exp(e - np.maximum.reduceat(e, starts)[bag])
        a = e / np.add.reduceat(e, starts)[bag]
        z = np.add.reduceat(a[:, None] * h, starts, axis=0)
        return z @ w["score"] + w["bias"][0], {"bag": bag, "x": x, "h": h, "t": t, "g": g, "a": a, "z": z}

    def gradients(self, rows: np.ndarray, starts: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        w = self.weights
        logits, s = self.forward(rows, starts)
        d = (1 / (1 + np.exp(-logits)) - labels) / len(labels)
        dz = d[:, None] * w["score"][None, :]
        along = (dz[s["bag"]] * s["h"]).sum(axis=1)
        de = s["a"] * (along - np.add.reduceat(s["a"] * along, starts)[s["bag"]])
        du = de[:, None] * w["attend"][None, :]
        dt, dg = du * s["g"] * (1 - s["t"] ** 2), du * s["t"] * s["g"] * (1 - s["g"])
        dh = s["a"][:, None] * dz[s["bag"]] + dt @ w["tanh"].T + dg @ w["gate"].T
        dp = dh * (1 - s["h"] ** 2)
        return {
            "embed": s["x"].T @ dp, "shift": dp.sum(axis=0), "tanh": s["h"].T @ dt, "gate": s["h"].T @ dg,
            "attend": (s["t"] * s["g"]).T @ de, "score": s["z"].T @ d, "bias": np.array([d.sum()]),
        }

    def fit(self, bags: list[np.ndarray], labels: np.ndarray, epochs: int = 30, batch: int = 128, rate: float = 0.01, decay: float = 1e-4) -> None:
        """Adam on the cross entropy; the bags in an order of their own in each epoch."""
        rows = np.concatenate(bags).astype(np.float64)
        self.mean, self.scale = rows.mean(axis=0), rows.std(axis=0) + 1e-6
        draw = np.random.default_rng(22)
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        step = 0
        for _ in range(epochs):
            order = draw.permutation(len(bags))
            for at in range(0, len(order), batch):
                chosen = order[at : at + batch]
                own = [bags[i] for i in chosen]
                starts = np.cumsum([0, *map(len, own[:-1])])
                step += 1
                for name, grad in self.gradients(np.concatenate(own), starts, labels[chosen]).items():
                    grad = grad + decay * self.weights[name]
                    first[name] = 0.9 * first[name] + 0.1 * grad
                    second[name] = 0.999 * second[name] + 0.001 * grad * grad
                    move = first[name] / (1 - 0.9**step) / (np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8)
                    self.weights[name] = self.weights[name] - rate * move

    def scores(self, bags: list[np.ndarray]) -> np.ndarray:
        starts = np.cumsum([0, *map(len, bags[:-1])])
        return 1 / (1 + np.exp(-np.clip(self.forward(np.concatenate(bags), starts)[0], -500, 500)))


def learn(docs: DataFrame, labels: DataFrame, fit_documents: int = FIT_DOCUMENTS) -> Network | None:
    """A network fitted on at most `fit_documents` labelled documents, drawn by a hash of doc_id.

    docs: doc_id, text; labels: doc_id, quality (0 or 1; null is no label; several labels of a document are averaged). None if nothing
    is labelled.
    """
    labels = labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.avg("quality").alias("quality"))
    drawn = labels.orderBy(F.xxhash64("doc_id", F.lit(9)), "doc_id").limit(fit_documents)
    chosen = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bags = [passages(text) for text in texts_as_bytes(batch.column("text"))]
            rows = pa.array([bag.ravel() for bag in bags], pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("quality"), rows], names=["doc_id", "quality", "rows"])

    found = chosen.mapInArrow(run, "doc_id long, quality double, rows array<float>").toArrow().sort_by("doc_id")
    if not found.num_rows:
        return None
    bags = [np.asarray(row.values).reshape(-1, WIDTH) for row in found.column("rows")]
    network = Network()
    network.fit(bags, found.column("quality").to_numpy())
    return network


def score(docs: DataFrame, network: Network | None) -> DataFrame:
    """Add score (0 to 1) to docs, from whole texts; a column of this name is replaced.

    Null and empty texts are one empty passage. Without a network, for want of labels, every score is 0.5.
    """
    docs = docs.drop("score")
    schema = T.StructType([*docs.schema, T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, bags, held = [], [], 0
            for text in texts_as_bytes(batch.column("text")):
                bags.append(passages(text))
                held += len(bags[-1])
                if held > 20_000:
                    found.append(_scores(network, bags))
                    bags, held = [], 0
            if bags:
                found.append(_scores(network, bags))
            column = np.concatenate(found) if found else np.empty(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(column, pa.float64())], names=schema.names)

    return docs.mapInArrow(run, schema)


def _scores(network: Network | None, bags: list[np.ndarray]) -> np.ndarray:
    return np.full(len(bags), 0.5) if network is None else network.scores(bags)

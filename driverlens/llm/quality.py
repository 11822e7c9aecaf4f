"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words. A passage is encoded from hashed trigrams of character classes
and a few ratios (capitals, symbols, digits, distinct words, common words, word length), then by a learned layer. Gated
attention gives every passage a weight; the weighted mean is scored by a logistic output. All
layers are learned from document labels alone, on a sample of at most ``sample_rows`` labelled
documents (about as many of each label, chosen by hashes of the id) with at most ``passages`` passages each, drawn
from the whole text by hashes of their places, which bounds what the driver holds.

Every text is scored whole, in pieces; the attention's sums are carried from piece to piece. Null and empty texts are
a single empty passage. A document with several labels counts with its smallest, a null label
not at all; without any label the score is 0.5. Repeated ids count once in the sample, with the text
of the smallest hash, whatever the order of rows; rows are scored each by itself.
Input columns named like an output column are replaced, other columns are left alone.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driverlens.llm.common import one_text, pieces, sample_ids, with_columns
from driverlens.llm.langid import held_out
from driverlens.llm.spotsigs import ANCHORS

PASSAGE = 64  # words
PIECE = 1 << 17  # characters encoded at a time, cut at white space
HASHED = 240
RATIOS = 8
FEATURES = HASHED + RATIOS
HIDDEN, GATE = 32, 16
SAMPLE_ROWS = 2000
PASSAGES = 32  # of a document, to learn from; scores use all
STEPS, RATE, DECAY = 250, 0.01, 1e-4

COMMON = frozenset(ANCHORS)
SPACE, UPPER, LOWER, DIGIT, OTHER = 0, 1, 2, 3, 4
CLASSES = 40


def _class_table() -> np.ndarray:
    """Character classes of the first 592 code points; ASCII symbols have one each."""
    table = np.full(592, OTHER, np.int64)
    symbols = 0
    for code in range(592):
        c = chr(code)
        if c.isspace():
            table[code] = SPACE
        elif c.isupper():
            table[code] = UPPER
        elif c.isalpha():
            table[code] = LOWER
        elif c.isdigit():
            table[code] = DIGIT
        elif 32 < code < 127:
            table[code] = OTHER + 1 + symbols
            symbols += 1
    return table


TABLE = _class_table()


def encode(piece: str) -> np.ndarray:
    """A row of features per passage of a piece; none if there is no word."""
    words = piece.split()
    if not words:
        return np.zeros((0, FEATURES), np.float32)
    groups = [words[i : i + PASSAGE] for i in range(0, len(words), PASSAGE)]
    spaced = "\n" + " ".join(words)
    codes = np.frombuffer(spaced.encode("utf-32-le", "surrogatepass"), np.uint32)
    classes = np.where(codes < len(TABLE), TABLE[np.minimum(codes, len(TABLE) - 1)], LOWER)
    passage = (np.cumsum((codes == 32) | (codes == 10)) - 1) // PASSAGE
    n = len(groups)
    sizes = np.bincount(passage, minlength=n).astype(np.float64)
    grams = (classes[:-2] * CLASSES + classes[1:-1]) * CLASSES + classes[2:]
    bucket = (grams * 2654435761 >> 7) % HASHED
    out = np.empty((n, FEATURES), np.float32)
    out[:, :HASHED] = np.sqrt(np.bincount(passage[:-2] * HASHED + bucket, minlength=n * HASHED).reshape(n, HASHED) / sizes[:, None])
    share = [np.bincount(passage, classes == kind, n) / sizes for kind in (UPPER, DIGIT)]
    share.append(np.bincount(passage, classes >= OTHER, n) / sizes)
    lengths = np.array([len(g) for g in groups], float)
    share += [
        np.array([len(set(g)) for g in groups]) / lengths,
        np.array([sum(map(COMMON.__contains__, g)) for g in groups]) / lengths,
        np.minimum(sizes / lengths / 10, 3),
        lengths / PASSAGE,
        np.array([sum(a == b for a, b in zip(g, g[1:])) for g in groups]) / lengths,
    ]
    out[:, HASHED:] = np.stack(share, axis=1)
    return out


def bag(text: str | None) -> np.ndarray:
    """The passages of a whole text, at least one."""
    found = [encode(p) for p in pieces(text or "", PIECE)]
    found = [f for f in found if len(f)]
    return np.concatenate(found) if found else np.zeros((1, FEATURES), np.float32)


def _start(rng) -> dict[str, np.ndarray]:
    def layer(a, b):
        return rng.normal(0, 1 / np.sqrt(a), (a, b))

    return {"W": layer(FEATURES, HIDDEN), "b": np.zeros(HIDDEN), "V": layer(HIDDEN, GATE), "U": layer(HIDDEN, GATE), "w": layer(GATE, 1)[:, 0], "c": layer(HIDDEN, 1)[:, 0], "d": np.zeros(1)}


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _gradient(p: dict, x: np.ndarray, starts: np.ndarray, owner: np.ndarray, y: np.ndarray) -> dict:
    """Gradient of the mean logistic loss over all bags; ``owner`` is each passage's bag."""
    h = np.tanh(x @ p["W"] + p["b"])
    t, s = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
    e = (t * s) @ p["w"]
    a = np.exp(e - np.maximum.reduceat(e, starts)[owner])
    a /= np.add.reduceat(a, starts)[owner]
    z = np.add.reduceat(a[:, None] * h, starts)
    wrong = (_sigmoid(z @ p["c"] + p["d"][0]) - y) / len(y)
    dz = (wrong[:, None] * p["c"])[owner]
    da = (dz * h).sum(1)
    de = a * (da - np.add.reduceat(a * da, starts)[owner])
    dt, ds = de[:, None] * p["w"] * s * (1 - t**2), de[:, None] * p["w"] * t * s * (1 - s)
    dh = (a[:, None] * dz + dt @ p["V"].T + ds @ p["U"].T) * (1 - h**2)
    return {"W": x.T @ dh, "b": dh.sum(0), "V": h.T @ dt, "U": h.T @ ds, "w": (t * s).T @ de, "c": z.T @ wrong, "d": np.array([wrong.sum()])}


def drawn(bag: np.ndarray, passages: int) -> np.ndarray:
    """At most so many passages of a document, spread over all of it by a hash of their places."""
    places = np.arange(len(bag), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return bag[np.sort(np.argsort(places, kind="stable")[:passages])]


def train(bags: list[np.ndarray], labels: np.ndarray, steps: int = STEPS) -> dict[str, np.ndarray]:
    """Fit all layers with Adam over the whole sample, from a fixed start."""
    x = np.concatenate(bags).astype(np.float64)
    mean, scale = x.mean(0), x.std(0) + 1e-3
    x -= mean
    x /= scale
    sizes = np.array([len(b) for b in bags])
    starts, owner = np.concatenate([[0], np.cumsum(sizes)[:-1]]), np.repeat(np.arange(len(bags)), sizes)
    p = _start(np.random.default_rng(0))
    first, second = {k: np.zeros_like(v) for k, v in p.items()}, {k: np.zeros_like(v) for k, v in p.items()}
    for step in range(1, steps + 1):
        for k, g in _gradient(p, x, starts, owner, labels.astype(np.float64)).items():
            g = g + DECAY * p[k]
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g**2
            p[k] = p[k] - RATE * first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return p | {"mean": mean, "scale": scale}


def score(model: dict, text: str | None) -> float:
    """The document's score; attention sums are carried over the text's pieces."""
    top, weight, mean = -np.inf, 0.0, np.zeros(HIDDEN)
    for x in (encode(p) for p in pieces(text or "", PIECE)):
        if len(x):
            top, weight, mean = _attend(model, x, top, weight, mean)
    if not weight:
        top, weight, mean = _attend(model, np.zeros((1, FEATURES)), top, weight, mean)
    return float(_sigmoid(mean / weight @ model["c"] + model["d"][0]))


def _attend(model: dict, x: np.ndarray, top: float, weight: float, mean: np.ndarray):
    h = np.tanh((x - model["mean"]) / model["scale"] @ model["W"] + model["b"])
    e = (np.tanh(h @ model["V"]) * _sigmoid(h @ model["U"])) @ model["w"]
    new = max(top, e.max())
    a, old = np.exp(e - new), np.exp(top - new)
    return new, weight * old + a.sum(), mean * old + a @ h


def fit(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality", sample_rows: int = SAMPLE_ROWS, passages: int = PASSAGES) -> dict | None:
    """Fit on labelled rows whose id is not held out; None without any.

    At most ``sample_rows`` documents teach, each with at most ``passages`` passages drawn from its whole text.
    """
    known = labels.where(F.col(label).isNotNull() & ~held_out(F.col(id), 3, 1)).groupBy(F.col(id).alias("id")).agg(F.min(label).cast("int").alias("label"))
    named = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    learnable = one_text(named.join(known, "id"), "id", "text", "label")
    given = named.withColumn("hash", F.xxhash64("text")).join(sample_ids(learnable, "label", sample_rows), ["id", "hash"])
    featured = with_columns(given, ["text"], "bag BINARY", lambda: lambda value: (drawn(bag(value), passages).astype("<f4").tobytes(),), drop=("text",))
    first = featured.groupBy("id", "label").agg(F.min("bag").alias("bag"))
    rows = sorted(tuple(r) for r in first.collect())
    if not rows:
        return None
    bags = [np.frombuffer(data, "<f4").reshape(-1, FEATURES) for _, _, data in rows]
    return train(bags, np.array([label for _, label, _ in rows]))


def predict(docs: DataFrame, model: dict | None, text: str = "text", drop: tuple[str, ...] = ()) -> DataFrame:
    """Add ``score`` and ``predicted`` (1 from a score of 0.5)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        model = shared.value

        def row(value):
            found = 0.5 if model is None else score(model, value)
            return found, int(found >= 0.5)

        return row

    return with_columns(docs, [text], "score DOUBLE, predicted INT", make, drop)

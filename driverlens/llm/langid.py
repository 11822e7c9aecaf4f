"""Language identification by sparse multinomial logistic regression.

Features are character n-grams of 1 to 3 characters, lower-cased, with runs of non-letters as one
blank, hashed into ``DIM`` buckets and weighted by TF-IDF. Document frequencies are counted over
all learnable documents. The weights are fitted by follow-the-regularised-leader with
elastic-net penalties on a sample of at most ``sample_rows`` of them (about as many of each
language, chosen by hashes of the id), and a temperature is fitted on a fifth of the sample that the weights
have not seen.

A document is learnable if its language is not null and its id not held out. Texts that are null
or have no letter are ``und`` with score 0; without any learnable document all are. Texts are
taken whole, in blocks, so a long one needs little memory. Repeated ids count once in the
sample, with the text of the smallest hash and its language, whatever the order of rows; rows are scored each by itself. Input columns named like an output column are replaced, other columns are left alone.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driverlens.llm.common import one_text, pieces, sample_ids, with_columns

DIM = 1 << 14
BLOCK = 1 << 17  # characters turned into n-grams at a time, cut at white space
SAMPLE_ROWS = 2000
CALIBRATION_ROWS = 20  # the fewest that fit a temperature
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 1e-3, 1e-4
UNKNOWN = "und"


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # DIM + 1 rows (the last is the bias), a column per language
    temperature: float


def held_out(id: Column, folds: int = 5, fold: int = 0) -> Column:
    """Whether the id's fold is kept from learning; null ids have no fold."""
    return F.crc32(id.cast("string")) % folds == fold


def counts(text: str | None) -> np.ndarray | None:
    """How often each bucket's n-grams occur; None for a text without letters."""
    if not text or not any(map(str.isalpha, text)):
        return None
    total = np.zeros(DIM, np.int64)
    for piece in pieces(text, BLOCK):
        lower = f" {piece.lower()} "
        codes = np.frombuffer(lower.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        letter = (codes >= 97) & (codes <= 122) | (codes >= 170) & (codes != 215) & (codes != 247)
        codes = np.where(letter, codes, 32).astype(np.uint64)
        codes = codes[np.concatenate([[True], letter[1:] | letter[:-1]])]
        hashed = np.zeros(len(codes), np.uint64)
        for n in range(1, 4):
            size = len(codes) - n + 1
            if size <= 0:
                break
            hashed = (hashed[:size] ^ codes[n - 1 :]) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(n)
            total += np.bincount((hashed >> np.uint64(50)).astype(np.int64), minlength=DIM)
    return total


def vector(found: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-zero buckets and their TF-IDF values, of length one."""
    at = np.flatnonzero(found)
    values = (1 + np.log(found[at])) * idf[at]
    norm = np.sqrt((values**2).sum())
    return at, values / norm if norm > 0 else values


def _frequencies(docs: DataFrame, text: str) -> tuple[np.ndarray, int]:
    """Documents per bucket and in all, over every row."""

    def count(batches):
        seen, n = np.zeros(DIM, np.int64), 0
        for batch in batches:
            column = batch.column(text)
            for i in range(batch.num_rows):
                if (found := counts(column[i].as_py())) is not None:
                    seen += found > 0
                    n += 1
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(seen[at], n))], ["bucket", "n"])

    summed = docs.select(text).mapInArrow(count, "bucket BIGINT, n BIGINT").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    seen = np.zeros(DIM + 1, np.int64)
    for bucket, n in summed:  # at most DIM + 1 rows
        seen[bucket] = n
    return seen[:DIM], int(seen[DIM])


def _sample(docs: DataFrame, id: str, text: str, lang: str, rows: int) -> list:
    """(id, language, buckets, counts) of at most ``rows`` documents."""
    named = docs.select(F.col(id).alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    chosen = sample_ids(one_text(named, "id", "text", "lang"), "lang", rows)
    given = named.withColumn("hash", F.xxhash64("text")).join(chosen, ["id", "hash", "lang"])

    def make():
        def row(value):
            found = counts(value)
            at = np.flatnonzero(found) if found is not None else np.empty(0, np.int64)
            return at.astype("<i4").tobytes(), (found[at] if found is not None else at).astype("<i4").tobytes()

        return row

    featured = with_columns(given, ["text"], "buckets BINARY, counts BINARY", make, drop=("text",))
    first = featured.groupBy("id", "lang").agg(F.min(F.struct("buckets", "counts")).alias("first"))
    return sorted(tuple(row) for row in first.select("id", "lang", "first.*").collect())


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int, epochs: int = EPOCHS) -> np.ndarray:
    """Follow-the-regularised-leader over (buckets, values, class) rows: L1 leaves most weights at zero."""
    z, n = np.zeros((DIM + 1, classes)), np.zeros((DIM + 1, classes))

    def weights(z, n):
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    for epoch in range(epochs):
        for k in np.random.default_rng(epoch).permutation(len(rows)):
            at, values, label = rows[k]
            at, values = np.append(at, DIM), np.append(values, 1.0)
            zs, ns = z[at], n[at]
            w = weights(zs, ns)
            error = _softmax(values @ w)
            error[label] -= 1
            g = values[:, None] * error
            grown = ns + g**2
            z[at] = zs + g - (np.sqrt(grown) - np.sqrt(ns)) / ALPHA * w
            n[at] = grown
    return weights(z, n)


def calibrate(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature under which the labels are likeliest; 1 for too few labels to tell."""
    if len(labels) < CALIBRATION_ROWS:
        return 1.0
    grid = np.geomspace(0.05, 5, 121)
    loss = [-np.log(_softmax(logits / t)[np.arange(len(labels)), labels] + 1e-12).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def fit(docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on the learnable rows of ``docs``: language not null, id not held out."""
    learnable = docs.where(F.col(lang).isNotNull() & ~held_out(F.col(id)))
    seen, n = _frequencies(learnable, text)
    idf = np.log((1 + n) / (1 + seen)) + 1
    sample = [(i, lang, np.frombuffer(at, "<i4"), np.frombuffer(c, "<i4")) for i, lang, at, c in _sample(learnable, id, text, lang, sample_rows)]
    sample = [row for row in sample if len(row[2])]
    languages = sorted({row[1] for row in sample})
    rows = []
    for _, language, at, found in sample:
        whole = np.zeros(DIM, np.int64)
        whole[at] = found
        rows.append((*vector(whole, idf), languages.index(language)))
    kept = [row for k, row in enumerate(rows) if k % 5]
    rest = [row for k, row in enumerate(rows) if k % 5 == 0]
    weights = train(kept or rows, max(1, len(languages)))
    logits = np.array([v @ weights[at] + weights[DIM] for at, v, _ in rest]).reshape(len(rest), weights.shape[1])
    return Model(languages, idf, weights, calibrate(logits, np.array([label for _, _, label in rest], int)))


def predict(
    docs: DataFrame, model: Model, text: str = "text", lang_out: str = "lang_pred", score_out: str = "score", drop: tuple[str, ...] = ()
) -> DataFrame:
    """Add the predicted language and its calibrated probability."""
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.idf, model.weights, model.temperature))

    def make():
        languages, idf, weights, temperature = shared.value

        def row(value):
            found = counts(value)
            if found is None or not languages:
                return UNKNOWN, 0.0
            at, values = vector(found, idf)
            chances = _softmax((values @ weights[at] + weights[DIM]) / temperature)
            best = int(chances.argmax())
            return languages[best], float(chances[best])

        return row

    return with_columns(docs, [text], f"`{lang_out}` STRING, `{score_out}` DOUBLE", make, drop)

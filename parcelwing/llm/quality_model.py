"""Quality of documents by multiple-instance learning with gated attention.

A document is a bag of passages; only the bag has a label. Each passage is
encoded as a vector, a gate learned from the labels gives it a weight, and the
weighted sum of the bag is scored. So a long clean text with one page of junk
and a page of junk alone are told apart by what the gate attends to.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelwing.llm.common import bounded, encoded, stored
from parcelwing.llm.shingles import word_hashes

PASSAGE = 64            # words
SAMPLE = 4_000          # labelled documents that training sees, half of each label
HIDDEN = 12
EPOCHS = 250
SYMBOLS = np.isin(np.arange(256), list(b"#*$%&|<>"))
_CODES = np.arange(256)
CLASSES = np.stack([
    (_CODES >= 65) & (_CODES <= 90), (_CODES >= 97) & (_CODES <= 122), (_CODES >= 48) & (_CODES <= 57), SYMBOLS,
    _CODES == 33, np.isin(_CODES, list(b".,;:?'\"-()")), _CODES >= 128, _CODES == 10,
]).astype(np.float32)
FEATURES = len(CLASSES) + 9


def _runs(values: np.ndarray, bag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per passage the number of distinct words, and of words equal to the word before."""
    order = np.lexsort((values, bag))
    b, v = bag[order], values[order]
    new = np.concatenate(([True], (b[1:] != b[:-1]) | (v[1:] != v[:-1])))
    same = np.concatenate(([False], (values[1:] == values[:-1]) & (bag[1:] == bag[:-1])))
    n = int(bag[-1]) + 1
    return np.bincount(b[new], minlength=n), np.bincount(bag[same], minlength=n)


def passages(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Features of the passages of PASSAGE words of all texts, and each passage's text number.

    Every text has a passage; one without words has zeros and a flag.
    """
    joined = b"\n".join(texts) + b"\n"
    data = np.frombuffer(joined, np.uint8)
    bounds = np.cumsum([len(t) + 1 for t in texts])
    hashes, starts, ends = word_hashes(data)
    per_text = np.diff(np.concatenate(([0], np.searchsorted(starts, bounds))))
    bags = np.maximum(1, -(-per_text // PASSAGE))
    owner = np.repeat(np.arange(len(texts)), bags)
    out = np.zeros((len(owner), FEATURES), np.float32)
    first_bag = np.concatenate(([0], np.cumsum(bags)[:-1]))
    out[first_bag[per_text == 0], -1] = 1
    if not len(hashes):
        return out, owner
    text_of = np.repeat(np.arange(len(texts)), per_text)
    rank = np.arange(len(hashes)) - np.repeat(np.concatenate(([0], np.cumsum(per_text)[:-1])), per_text)
    bag = first_bag[text_of] + rank // PASSAGE
    opens = np.flatnonzero(np.concatenate(([True], bag[1:] != bag[:-1])))
    live = bag[opens]
    begin = starts[opens]
    for k, chosen in enumerate(CLASSES):
        out[live, k] = np.add.reduceat(chosen[data], begin)
    size = np.add.reduceat((ends - starts).astype(np.float32), opens)
    words = np.bincount(bag, minlength=len(owner))[live]
    distinct, repeated = (x[live] for x in _runs(hashes, bag))
    loud = np.add.reduceat((np.add.reduceat(CLASSES[1][data], starts) == 0).astype(np.float32), opens)
    symbol_end = np.add.reduceat(SYMBOLS[data[ends - 1]].astype(np.float32), opens)
    alone = np.add.reduceat((SYMBOLS[data[starts]] & (ends - starts == 1)).astype(np.float32), opens)
    out[live, :len(CLASSES)] /= np.maximum(size, 1)[:, None]
    at = len(CLASSES)
    for k, value in enumerate((size / words / 10, distinct / words, repeated / words, loud / words, symbol_end / words,
                               alone / words, np.log1p(words) / 5, size < 4)):
        out[live, at + k] = value
    return out, owner


class Attention:
    """Gated attention pooling: weights and mean of the features, and the learned matrices."""

    def __init__(self, seed: int = 5):
        draw = np.random.default_rng(seed)
        self.mean, self.scale = np.zeros(FEATURES), np.ones(FEATURES)
        self.p = {"E": draw.normal(0, 0.3, (FEATURES, HIDDEN)), "e": np.zeros(HIDDEN),
                  "V": draw.normal(0, 0.3, (HIDDEN, HIDDEN)), "U": draw.normal(0, 0.3, (HIDDEN, HIDDEN)),
                  "w": np.zeros(HIDDEN), "c": draw.normal(0, 0.3, HIDDEN), "b": np.zeros(1)}

    def forward(self, x: np.ndarray, owner: np.ndarray):
        """Score of each bag; owner is sorted and names every bag from 0."""
        p = self.p
        z = (x - self.mean) / self.scale
        h = np.tanh(z @ p["E"] + p["e"])
        t, g = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        a = (t * g) @ p["w"]
        cuts = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
        a = np.exp(a - np.maximum.reduceat(a, cuts)[owner])
        a /= np.add.reduceat(a, cuts)[owner]
        bag = np.add.reduceat(a[:, None] * h, cuts)
        score = 1 / (1 + np.exp(-np.clip(bag @ p["c"] + p["b"], -30, 30)))
        return score, (z, h, t, g, a, bag, cuts)

    def fit(self, x: np.ndarray, owner: np.ndarray, label: np.ndarray, epochs: int = EPOCHS) -> None:
        """Full-batch Adam on the cross entropy of the bags, both labels weighted alike."""
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-3
        p, m, v = self.p, {k: 0.0 for k in self.p}, {k: 0.0 for k in self.p}
        weight = np.where(label == 1, 0.5 / max(1, (label == 1).sum()), 0.5 / max(1, (label == 0).sum()))
        for step in range(1, epochs + 1):
            score, (z, h, t, g, a, bag, _) = self.forward(x, owner)
            d = (score - label) * weight
            d_bag = d[:, None] * p["c"]
            d_a = (h * d_bag[owner]).sum(1)
            inner = np.bincount(owner, a * d_a, len(score))
            d_logit = a * (d_a - inner[owner])
            d_t, d_g = d_logit[:, None] * p["w"] * g, d_logit[:, None] * p["w"] * t
            d_v, d_u = d_t * (1 - t * t), d_g * g * (1 - g)
            d_h = a[:, None] * d_bag[owner] + d_v @ p["V"].T + d_u @ p["U"].T
            d_e = d_h * (1 - h * h)
            grad = {"E": z.T @ d_e, "e": d_e.sum(0), "V": h.T @ d_v, "U": h.T @ d_u, "w": (t * g).T @ d_logit,
                    "c": bag.T @ d, "b": np.array([d.sum()])}
            for k in p:
                grad[k] = grad[k] + 1e-4 * p[k]
                m[k] = 0.9 * m[k] + 0.1 * grad[k]
                v[k] = 0.999 * v[k] + 0.001 * grad[k] ** 2
                p[k] -= 0.03 * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)


def held_out(doc_id: Column) -> Column:
    """Rows that training never sees: crc32 of the doc_id's text leaves 1 modulo 3; a null doc_id is held out too."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(True))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in bounded(batches, "text"):
        x, owner = passages(encoded(batch, "text"))
        rows = [x[owner == k].astype("<f4").tobytes() for k in range(batch.num_rows)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("quality"), pa.array(rows, pa.binary())],
                                         names=["doc_id", "quality", "features"])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Attention:
    """Fit on at most `sample` labelled documents that are not held out, half of each label.

    The sample is drawn by a hash of doc_id, so it is the same on every run.
    Only its passage features come to the driver. Labels that are null, or that
    name a document twice with both values, are not used. Without any usable
    label the model stays at an even score.
    """
    usable = labels.filter("doc_id is not null and quality in (0, 1)").filter(~held_out(F.col("doc_id"))).groupBy(
        F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.min("quality").cast("int").alias("quality"), F.max("quality").alias("other")).filter(
        "quality = other").drop("other")
    known = docs.filter("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    usable = usable.join(known, "doc_id", "left_semi").withColumn("draw", F.xxhash64(F.lit(11), "doc_id"))
    picked = None
    for label in (0, 1):
        half = usable.filter(F.col("quality") == label).orderBy("draw").limit(sample // 2).select("doc_id", "quality")
        picked = half if picked is None else picked.union(half)
    picked = F.broadcast(stored(picked, "sample"))      # at most `sample` rows
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(picked, "doc_id").dropDuplicates(
        ["doc_id"])
    rows = texts.select("doc_id", "quality", "text").mapInArrow(
        _features, "doc_id long, quality int, features binary").orderBy("doc_id").collect()
    model = Attention()
    if rows:
        parts = [np.frombuffer(r["features"], "<f4").reshape(-1, FEATURES) for r in rows]
        owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        model.fit(np.concatenate(parts).astype(float), owner, np.array([r["quality"] for r in rows], float))
    return model


def _score(model: Attention, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in bounded(batches, "text"):
        score, _ = model.forward(*passages(encoded(batch, "text")))
        columns = [batch.column(name) for name in batch.schema.names if name != "text"]
        names = [name for name in batch.schema.names if name != "text"]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(score, pa.float64())], names=[*names, "score"])


def score_documents(docs: DataFrame, model: Attention) -> DataFrame:
    """doc_id and score (0 to 1) of every row; a null text counts as empty, which has a score as well."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return base.mapInArrow(partial(_score, model), "doc_id long, score double")


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """docs' rows whose text scores the threshold or more; all columns as they were."""
    model = train(docs, labels)

    def judge(batches):
        for batch in bounded(batches, "text"):
            score, _ = model.forward(*passages(encoded(batch, "text")))
            yield batch.filter(pa.array(score >= threshold))

    return docs.mapInArrow(judge, docs.schema)

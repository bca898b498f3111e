"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages with one label. Each passage is encoded (hashed byte trigrams and some measures of its
form, then a learned layer), gated attention learns from the document labels how much each passage counts, and the
document is scored on the weighted mean of its passages. Spark encodes the training documents and scores all documents;
the fit itself runs on a bounded sample of labelled documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyflow.llm.common import fold, materialize, narrow, table, text_rows, whole

#: Measures of a passage's form: shares of kinds of characters, repetition, size.
FORMS = 14


@dataclass(frozen=True)
class BagRule:
    """``sample`` bounds the labelled documents of the fit. Passages have ``passage`` bytes, more in texts of over ``most``
    passages, so that a bag of any text has at most ``most`` passages and still covers all of it."""

    passage: int = 512
    most: int = 64
    slots: int = 512
    hidden: int = 32
    attention: int = 16
    sample: int = 5000
    epochs: int = 12
    batch: int = 64
    rate: float = 0.004
    decay: float = 1e-4
    seed: int = 17

    @property
    def width(self) -> int:
        return self.slots + FORMS


def passages(text: str, rule: BagRule) -> np.ndarray:
    """(passages, width) float32: what the model sees of each passage; an empty text is one empty passage."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    size = len(data)
    if not size:
        return np.zeros((1, rule.width), dtype=np.float32)
    length = max(rule.passage, -(-size // rule.most))
    count = -(-size // length)
    of = np.arange(size) // length
    wide = np.concatenate([data, [0, 0]]).astype(np.uint32)
    mixed = (wide[:-2] * 0x9E3779B1 + wide[1:-1] * 0x85EBCA6B + wide[2:] * 0xC2B2AE35).astype(np.uint32)
    slot = ((mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> np.uint32(16)) % rule.slots
    grams = np.bincount(of * rule.slots + slot, minlength=count * rule.slots).reshape(count, rule.slots)

    def share(flags: np.ndarray) -> np.ndarray:
        return np.bincount(of, weights=flags, minlength=count) / np.bincount(of, minlength=count)

    space = (data == 32) | ((data >= 9) & (data <= 13))
    upper, lower = (data >= 65) & (data <= 90), (data >= 97) & (data <= 122)
    digit, high = (data >= 48) & (data <= 57), data >= 128
    sign = ~(space | upper | lower | digit | high)
    starts = np.concatenate([[True], space[:-1]]) & ~space
    after = np.concatenate([[0], data[:-1]])
    words = [data[k : k + length].tobytes().split() for k in range(0, size, length)]
    form = [
        np.array([sum(map(eq, w, w[1:])) / max(len(w), 1) for w in words]) * 2,
        np.array([len({*w}) / max(len(w), 1) for w in words]),
        share(upper), share(lower), share(digit), share(high), share(sign), share(space), share(starts) * 4,
        share(sign & (data != 46) & (data != 44)) * 2, share(sign & (after == data)) * 4, share(data == 10) * 20,
        (grams > 0).sum(axis=1) / np.minimum(np.bincount(of, minlength=count), rule.slots),
        np.full(count, np.log1p(size) / 10),
    ]
    root = np.sqrt(grams)
    norm = np.sqrt((root * root).sum(axis=1, keepdims=True))
    return np.concatenate([root / np.maximum(norm, 1) * 4, np.stack(form, axis=1)], axis=1).astype(np.float32)


@dataclass
class Bags:
    """Bags of passages, one after another: ``starts`` has the first row of each bag."""

    rows: np.ndarray
    starts: np.ndarray

    @classmethod
    def of(cls, bags: list[np.ndarray]) -> Bags:
        return cls(np.concatenate(bags), np.cumsum([0, *map(len, bags)])[:-1])


class AttentionModel:
    """tanh layer, gated attention over the passages of a bag, logistic output. Plain arrays, so it is small to send."""

    def __init__(self, weights: dict[str, np.ndarray]):
        self.w = weights

    @classmethod
    def fresh(cls, rule: BagRule, rng: np.random.Generator) -> AttentionModel:
        d, h, a = rule.width, rule.hidden, rule.attention
        near = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)
        flat = lambda *shape: np.zeros(shape, dtype=np.float32)
        return cls({
            "enc": near(d, h), "enc0": flat(h), "v": near(h, a), "v0": flat(a), "u": near(h, a), "u0": flat(a),
            "att": near(a), "out": near(h), "out0": flat(1),
        })

    def forward(self, bags: Bags) -> dict[str, np.ndarray]:
        w, starts = self.w, bags.starts
        sizes = np.diff(np.append(starts, len(bags.rows)))
        of = np.repeat(np.arange(len(starts)), sizes)
        h = np.tanh(bags.rows @ w["enc"] + w["enc0"])
        t, g = np.tanh(h @ w["v"] + w["v0"]), 1 / (1 + np.exp(-(h @ w["u"] + w["u0"])))
        e = (t * g) @ w["att"]
        e = np.exp(e - np.maximum.reduceat(e, starts)[of])
        a = e / np.add.reduceat(e, starts)[of]
        z = np.add.reduceat(h * a[:, None], starts, axis=0)
        p = 1 / (1 + np.exp(-np.clip(z @ w["out"] + w["out0"], -30, 30)))
        return {"of": of, "h": h, "t": t, "g": g, "a": a, "z": z, "p": p}

    def gradients(self, bags: Bags, label: np.ndarray) -> dict[str, np.ndarray]:
        w, f = self.w, self.forward(bags)
        of, h, t, g, a = f["of"], f["h"], f["t"], f["g"], f["a"]
        dy = ((f["p"] - label) / len(label)).astype(np.float32)
        dz = dy[:, None] * w["out"]
        da = (h * dz[of]).sum(axis=1)
        de = a * (da - np.add.reduceat(a * da, bags.starts)[of])
        dt, dg = de[:, None] * w["att"] * g * (1 - t * t), de[:, None] * w["att"] * t * g * (1 - g)
        dh = (dz[of] * a[:, None] + dt @ w["v"].T + dg @ w["u"].T) * (1 - h * h)
        return {
            "enc": bags.rows.T @ dh, "enc0": dh.sum(0), "v": h.T @ dt, "v0": dt.sum(0), "u": h.T @ dg, "u0": dg.sum(0),
            "att": (t * g).T @ de, "out": f["z"].T @ dy, "out0": dy.sum(keepdims=True),
        }

    def score(self, bags: Bags) -> np.ndarray:
        return self.forward(bags)["p"].astype(np.float64)


def fit(bags: list[np.ndarray], labels: np.ndarray, rule: BagRule) -> AttentionModel:
    """Adam on batches of whole bags; the order of the bags and the seed fix the result."""
    rng = np.random.default_rng(rule.seed)
    model = AttentionModel.fresh(rule, rng)
    first = {k: np.zeros_like(v) for k, v in model.w.items()}
    second = {k: np.zeros_like(v) for k, v in model.w.items()}
    step = 0
    for epoch in range(rule.epochs):
        rate = rule.rate * (1 - epoch / rule.epochs)
        order = rng.permutation(len(bags))
        for start in range(0, len(order), rule.batch):
            chosen, step = order[start : start + rule.batch], step + 1
            slopes = model.gradients(Bags.of([bags[k].astype(np.float32) for k in chosen]), labels[chosen])
            for k, slope in slopes.items():
                slope = slope + rule.decay * model.w[k]
                first[k] = 0.9 * first[k] + 0.1 * slope
                second[k] = 0.999 * second[k] + 0.001 * slope * slope
                model.w[k] = model.w[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return model


def train(docs: DataFrame, labels: DataFrame, rule: BagRule = BagRule(), text_col: str = "text") -> AttentionModel | None:
    """Fits on at most ``rule.sample`` labelled documents: those of smallest hashed id. ``labels`` has doc_id and label.

    Of several labels of a document the smallest counts; null labels and labels of unknown documents don't. Of rows that
    share a labelled id the text of smallest digest counts, once, so the bound holds for bags as it does for ids. None if no
    labelled document is left.
    """
    known = narrow(labels, doc_id="doc_id", label="label").dropna().groupBy("doc_id").agg(F.min("label").alias("label"))
    chosen = materialize(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rule.sample), "mil-sample")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_rows(batches):
            bags = [passages(t, rule).astype(np.float16).tobytes() for t in texts]
            kept = [batch.column(c) for c in ("doc_id", "label", "digest")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(bags, pa.binary())], names=["doc_id", "label", "digest", "bag"])

    # at most rule.sample rows are broadcast, and one bag of at most rule.most passages for each comes back
    rows = narrow(docs, doc_id="doc_id", text=text_col).join(F.broadcast(chosen), "doc_id")
    rows = rows.select("doc_id", "label", "text", F.md5(whole("text")).alias("digest"))
    kinds = dict(rows.dtypes)
    encoded = rows.mapInArrow(encode, f"doc_id {kinds['doc_id']}, label {kinds['label']}, digest string, bag binary")
    single = encoded.groupBy("doc_id", "label").agg(F.min_by("bag", "digest").alias("bag"))
    bags = single.toArrow().sort_by("doc_id")
    if not bags.num_rows:
        return None
    shaped = [np.frombuffer(b.as_py(), dtype=np.float16).reshape(-1, rule.width) for b in bags.column("bag")]
    return fit(shaped, bags.column("label").to_numpy().astype(np.float32), rule)


def score_documents(docs: DataFrame, model: AttentionModel | None, rule: BagRule = BagRule(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score (0 to 1) of every row; without a model every score is 0.5.

    A null text is an empty one, which has one empty passage. Repeated rows score alike. Further columns are not returned.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_rows(batches):
            scores: list[float] = []
            for start in range(0, len(texts), 64):
                part = texts[start : start + 64]
                scores += model.score(Bags.of([passages(t, rule) for t in part])).tolist() if model else [0.5] * len(part)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    return narrow(docs, doc_id=id_col, text=text_col).mapInArrow(work, f"doc_id {kind}, score double")


def quality_scores(docs: DataFrame, labels: DataFrame, rule: BagRule = BagRule(), threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``.

    The model learns from rows of ``labels`` (doc_id, quality) outside the held-out fifth, by the text only. An empty
    table gives no rows, an empty ``labels`` scores of 0.5.
    """
    learn = labels.filter(fold("doc_id", 5) != 0).select("doc_id", F.col("quality").alias("label"))
    model = train(docs, learn, rule)
    scored = score_documents(docs, model, rule)
    return scored.select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def keep_good(docs: DataFrame, labels: DataFrame, rule: BagRule = BagRule(), threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that the classifier doesn't reject, with all their columns.

    The verdict is a function of the text alone, so rows of the same doc_id are judged each by their own text.
    """
    learn = labels.filter(fold("doc_id", 5) != 0).select("doc_id", F.col("quality").alias("label"))
    model = train(docs, learn, rule)
    at = docs.columns.index("text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_rows(batches, at):
            score = model.score(Bags.of([passages(t, rule) for t in texts])) if model else np.full(len(texts), 0.5)
            yield batch.filter(pa.array(score >= threshold))

    return docs.mapInArrow(work, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))

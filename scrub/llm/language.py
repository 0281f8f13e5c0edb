"""Language of texts: averaged hashed subword embeddings under a linear softmax.

Subwords are the byte n-grams of the lower-case text, in which everything but letters is a blank; each is
hashed to a row of an embedding table, a text is the average of its rows, and one linear layer with a
softmax gives a probability per language. The model is trained on the driver by stochastic gradient
descent in numpy, on a sample whose size is a parameter: different texts, evenly many of each language as far as
there are, of any length; of a text with many different subwords a part drawn by hash stands for all. Averaging and the layer are both linear, so
for prediction they are multiplied out to a table of scores per subword, which tasks add up.

A part of the sample is held back from training. It sets a temperature, so that the score is the
probability of being right, and the score under which a prediction is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import kernels as K

UNKNOWN = "und"
GRAMS = (3, 4)
BUCKETS = 1 << 16
DIMENSIONS = 16
#: The sample: labelled texts at most, and different subwords of each at most.
SAMPLE_ROWS, SAMPLE_GRAMS = 4_000, 8_192
EPOCHS, BATCH, RATE = 6, 32, 4.0
#: Of the sampled texts, one in so many is held back to set temperature and rejection.
HELD_BACK = 5
#: How often accepted predictions should be right.
ACCEPTED = 0.99

_BLANK = np.uint8(0x20)
_LOWER = np.full(256, _BLANK)
for _b in range(256):
    if _b >= 0x80 or chr(_b).isalpha():
        _LOWER[_b] = _b | 0x20 if _b < 0x80 else _b


def folded(data: np.ndarray) -> np.ndarray:
    """Lower case for ASCII and the Latin letters that take the bytes C3 80 to C3 9E; else blanks."""
    out = _LOWER[data]
    if len(data) > 1:
        upper = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)) + 1
        out[upper] += np.uint8(0x20)
    return out


def lettered(texts: K.Texts) -> np.ndarray:
    """Which texts have a letter."""
    ascii_ = np.append(0, np.cumsum((_LOWER[texts.data] != _BLANK) & (texts.data < 0x80)))
    some = ascii_[texts.offsets[1:]] > ascii_[texts.offsets[:-1]]
    for i in np.flatnonzero(~some):
        some[i] = any(c.isalpha() for c in texts.text(i).decode("utf-8", "replace"))
    return some


def subwords(texts: K.Texts) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n-gram length the buckets of all n-grams and the document of each."""
    values = K.byte_values(folded(texts.data))
    for n in GRAMS:
        if len(values) < n:
            continue
        inside = np.flatnonzero(K.within(texts.offsets, n, len(values)))
        buckets = (K.grams(values, n)[inside] >> np.uint64(64 - 16)).astype(np.int64)
        yield buckets, np.searchsorted(texts.offsets, inside, "right") - 1


@dataclass
class Model:
    languages: list[str]
    scores: np.ndarray  # (BUCKETS, languages)
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0

    def logits(self, texts: K.Texts) -> np.ndarray:
        n, classes = len(texts), len(self.languages)
        total, count = np.zeros((n, classes)), np.zeros(n)
        for buckets, document in subwords(texts):
            count += np.bincount(document, minlength=n)
            for k in range(classes):
                total[:, k] += np.bincount(document, weights=self.scores[buckets, k], minlength=n)
        return total / np.maximum(count, 1)[:, None] + self.bias

    def predict(self, texts: K.Texts) -> tuple[np.ndarray, np.ndarray]:
        """The most likely language of each text, as a number, and its probability."""
        p = softmax(self.logits(texts) / self.temperature)
        best = p.argmax(axis=1)
        return best, p[np.arange(len(p)), best]


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


#: Buckets of a text's subwords, and how often each occurs.
Features = tuple[np.ndarray, np.ndarray]


def features(texts: K.Texts, most: int = SAMPLE_GRAMS) -> list[Features]:
    """Of each text the buckets and counts of its subwords; of more than ``most`` buckets those of the smallest hashes.

    The hash depends on the text, so the buckets left are a fair sample of those that the text has.
    """
    parts = list(subwords(texts))
    document = np.concatenate([d for _, d in parts] or [np.zeros(0, np.int64)])
    buckets = np.concatenate([b for b, _ in parts] or [np.zeros(0, np.int64)])
    keys, counts = np.unique(document * BUCKETS + buckets, return_counts=True)
    edges = np.searchsorted(keys, np.arange(len(texts) + 1) * BUCKETS)
    out = []
    for i in range(len(texts)):
        own, n = keys[edges[i]:edges[i + 1]] % BUCKETS, counts[edges[i]:edges[i + 1]]
        if len(own) > most:
            drawn = np.sort(np.argsort(K.mix(own.astype(np.uint64) + np.uint64(n.sum()) * np.uint64(BUCKETS)))[:most])
            own, n = own[drawn], n[drawn]
        out.append((own, n))
    return out


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, text, h) to (lang, h, buckets, counts), the last two as the bytes of 32-bit numbers."""
    for batch in batches:
        for part, texts in K.chunks(batch):
            found = features(texts)
            packed = [pa.array([x.astype(np.int32).tobytes() for x in column], pa.binary()) for column in zip(*found, strict=True)]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), *packed], ["lang", "h", "buckets", "counts"])


def train(rows: list[tuple[Features, str]], seed: int = 0) -> Model:
    """Fit a model to (subwords of a text, language) pairs, in an order that the seed decides."""
    languages = sorted({lang for _, lang in rows})
    label = np.array([languages.index(lang) for _, lang in rows])
    random = np.random.default_rng(seed)
    order = random.permutation(len(rows))
    held, used = order[::HELD_BACK], np.setdiff1d(order, order[::HELD_BACK]) if len(rows) > HELD_BACK else order
    features = [f for f, _ in rows]
    table = random.normal(0, 0.1, (BUCKETS, DIMENSIONS))
    layer, bias = random.normal(0, 0.1, (len(languages), DIMENSIONS)), np.zeros(len(languages))
    steps = EPOCHS * -(-len(used) // BATCH)
    for step in range(steps):
        if step * BATCH % max(len(used), 1) < BATCH:
            used = random.permutation(used)
        at = step * BATCH % len(used)
        batch = [i for i in used[at:at + BATCH] if len(features[i][0])]
        if not batch:
            continue
        buckets = np.concatenate([features[i][0] for i in batch])
        weight = np.concatenate([features[i][1] / features[i][1].sum() for i in batch])
        owner = np.repeat(np.arange(len(batch)), [len(features[i][0]) for i in batch])
        mean = np.stack([np.bincount(owner, table[buckets, d] * weight, len(batch)) for d in range(DIMENSIONS)], 1)
        error = softmax(mean @ layer.T + bias)
        error[np.arange(len(batch)), label[batch]] -= 1
        rate = RATE * (1 - step / steps) / len(batch)
        back = error @ layer
        layer -= rate * error.T @ mean
        bias -= rate * error.sum(axis=0)
        for d in range(DIMENSIONS):
            # A subword of a text has a share of about a thousandth; its row moves by the text's error.
            table[:, d] -= 50 * rate * np.bincount(buckets, back[owner, d] * weight, BUCKETS)
    model = Model(languages, (table @ layer.T).astype(np.float32), bias)
    return calibrated(model, [rows[i] for i in held])


def calibrated(model: Model, rows: list[tuple[Features, str]]) -> Model:
    """Set the temperature by likelihood, and the least score from which on predictions are right often enough."""
    label = np.array([model.languages.index(lang) for _, lang in rows])
    logits = np.stack([n @ model.scores[b] / max(n.sum(), 1) for (b, n), _ in rows]) + model.bias
    at = np.arange(len(rows))
    tried = np.exp(np.linspace(-5, 2, 71))
    loss = [-np.log(softmax(logits / t)[at, label] + 1e-12).mean() for t in tried]
    model.temperature = float(tried[int(np.argmin(loss))])
    p = softmax(logits / model.temperature)
    score, right = p.max(axis=1), p.argmax(axis=1) == label
    order = np.argsort(-score)
    share = np.cumsum(right[order]) / (at + 1)
    enough = np.flatnonzero(share >= ACCEPTED)
    model.threshold = float(score[order][enough[-1]]) if len(enough) else 1.0
    return model


def _predict(model: Model | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in K.chunks(batch):
                some = lettered(texts)
                if model:
                    best, score = model.predict(texts)
                    names = np.where(some, np.array(model.languages, object)[best], UNKNOWN)
                    score = np.where(some, score, 0.0)
                    rejected = score < model.threshold
                else:
                    names, score, rejected = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts)), np.ones(len(texts), bool)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array(names, pa.string()), pa.array(score), pa.array(rejected | ~some)],
                    ["key", "held_out", "lang_pred", "score", "rejected"],
                )

    return run


def held_out(key: Column) -> Column:
    """Rows that training never sees: the CRC of the key as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def quota(counts: list[int], rows: int) -> int:
    """The largest number that may be taken of each kind, as far as there are, so that ``rows`` suffice; 1 at least."""
    left, kinds = rows, len(counts)
    for n in sorted(counts):
        if n * kinds > left:
            return max(1, left // kinds)
        left, kinds = left - n, kinds - 1
    return max(1, *counts)


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang", rows: int = SAMPLE_ROWS) -> Model | None:
    """Train on ``rows`` different labelled texts, evenly many of each language as far as there are; None without any.

    Of a language the texts of the smallest hashes are taken, whatever their length and however often they are repeated;
    one row is taken of each language at least. Rows without text or label, and held-out rows, are left out. A text under
    several labels counts once for each. Labels are few: their counts come to the driver, and the model has a column for each.
    """
    usable = docs.where(~held_out(F.col(key)) & F.col(label).isNotNull() & (F.octet_length(text) > 0)).select(
        F.col(label).cast("string").alias("lang"), F.col(text).alias("text"), F.xxhash64(text).alias("h")
    )
    # Repeated texts count once, about; the margin below is wider than the error.
    counts = {r.lang: r.n for r in usable.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).collect()}
    if not counts:
        return None
    each = quota(list(counts.values()), rows)
    # Each task sends few texts more than are wanted: those below a hash that leaves half as many again per language.
    shares = {lang: min(1.0, (1.5 * each + 30) / max(n, 1)) for lang, n in counts.items()}
    limits = F.create_map(*[F.lit(x) for lang, p in shares.items() for x in (lang, min(int(p * 2**64) - 2**63, 2**63 - 1))])
    picked = usable.where(F.col("h") <= limits[F.col("lang")]).groupBy("lang", "h").agg(F.min("text").alias("text"))
    first = Window.partitionBy("lang").orderBy("h")
    chosen = picked.withColumn("at", F.row_number().over(first)).where(F.col("at") <= each)
    found = chosen.select("lang", "text", "h").mapInArrow(_features, "lang string, h long, buckets binary, counts binary")
    sample = sorted(found.collect(), key=lambda r: (r.h, r.lang))
    numbers = lambda b: np.frombuffer(b, np.int32).astype(np.int64)
    return train([((numbers(r.buckets), numbers(r.counts)), r.lang) for r in sample])


def identify(docs: DataFrame, model: Model | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, held_out, lang_pred, score, rejected for every row of ``docs``.

    ``lang_pred`` is always the most likely learned language, or ``und`` (with score 0) for a text that is
    NULL or has no letter; ``rejected`` says that the score is below the calibrated threshold. Only the
    text decides, so equal texts get equal answers; other columns play no part.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), held_out(F.col(key)).alias("held_out"))
    kind = dict(docs.dtypes)[key]
    found = rows.mapInArrow(_predict(model), f"key {kind}, held_out boolean, lang_pred string, score double, rejected boolean")
    return found.withColumnRenamed("key", key)

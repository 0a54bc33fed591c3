"""Quality rules: counts of a text, and a calibrated linear model over hashed word and character n-grams.

The counts give fixed rules that reject a text at once. The others are scored by logistic regression on
relative frequencies of words, pairs of words and runs of 3 and 5 bytes, each hashed to a fixed number
of weights. It is fitted on at most ``per_class`` labelled rows of each class, those with the smallest hash of
their id; a fifth of them calibrates the score to a probability, weighted to the classes' shares among
all labelled rows. A text is kept if the probability of good quality reaches a fixed threshold.

Null and empty texts have no words and are rejected. Repeated rows and ids stay and are judged one by one. If
the labels lack a class, the counts alone decide. Other columns are carried, names of the
result's own columns are replaced. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.llm.common import by_bytes, map_batches

#: Labelled rows of each class that the model is fitted on, and the longest text among them.
PER_CLASS = 1_000
LONGEST = 20_000
THRESHOLD = 0.5
WINDOW = 8
#: Characters that are scored at a time.
GROUP = 500_000
_BITS = 16
_RUNS = (3, 5)
# White space and symbols of the counts.
SPACE = b" \t\n\v\f\r"
SYMBOLS = b"#*$%&|<>"
_IN_WORD = np.array([(b & 0xC0) != 0x80 and b not in SPACE for b in range(256)])
_SYMBOL = np.array([b in SYMBOLS for b in range(256)])
_MIX = np.uint64(0x9E3779B97F4A7C15)


class Texts:
    """A batch of texts as bytes and word hashes, one text after the other."""

    def __init__(self, texts: list[str]):
        self.raw = [t.encode() for t in texts]
        words = [t.split() for t in self.raw]  # bytes: ASCII white space only
        self.n_words = np.array([len(w) for w in words], np.int64)
        digest = xxhash.xxh64_intdigest
        self.words = np.array([digest(w) for ws in words for w in ws], np.uint64)
        self.data = np.frombuffer(b"".join(self.raw), np.uint8)
        self.n_bytes = np.array([len(t) for t in self.raw], np.int64)
        self.word_text = np.repeat(np.arange(len(words)), self.n_words)

    def per_text(self, values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(values, dtype=np.float64 if values.dtype.kind == "f" else np.int64)])
        ends = np.cumsum(sizes)
        return total[ends] - total[ends - sizes]

    def counts(self) -> dict[str, np.ndarray]:
        lines = [[x for x in t.split(b"\n") if x and not x.isspace()] for t in self.raw]
        return {
            "n_words": self.n_words,
            "word_chars": self.per_text(_IN_WORD[self.data], self.n_bytes),
            "n_symbols": self.per_text(_SYMBOL[self.data], self.n_bytes),
            "n_dup_lines": np.array([len(x) - len(set(x)) for x in lines], np.int64),
            "n_repeat_words": self.repeated(),
        }

    def repeated(self) -> np.ndarray:
        """Words inside a window of eight that stands in the text at least twice."""
        n = len(self.words) - WINDOW + 1
        covered = np.zeros(len(self.words) + 1, np.int64)
        if n > 0:
            key = self.word_text[:n].astype(np.uint64)
            for k in range(WINDOW):
                key = (key ^ self.words[k : k + n]) * _MIX
                key ^= key >> np.uint64(29)
            at = np.flatnonzero(self.word_text[:n] == self.word_text[WINDOW - 1 :])
            order = at[np.argsort(key[at], kind="stable")]
            same = key[order][1:] == key[order][:-1]
            twice = np.zeros(len(order), bool)
            twice[1:] |= same
            twice[:-1] |= same
            np.add.at(covered, order[twice], 1)
            np.add.at(covered, order[twice] + WINDOW, -1)
        return self.per_text(np.cumsum(covered)[:-1] > 0, self.n_words)

    def features(self) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For words, pairs and runs of bytes: the text of each, its hashed feature, and how many the text has."""
        shift = np.uint64(64 - _BITS)
        out = [(self.word_text, (self.words * _MIX >> shift).astype(np.int64), self.n_words)]
        pair = self.word_text[1:] == self.word_text[:-1]
        first, second = self.words[:-1][pair], self.words[1:][pair]
        # a word after itself is one feature, whatever the word
        hashed = np.where(first == second, 0, ((first * np.uint64(3) ^ second) * _MIX >> shift).astype(np.int64))
        out.append((self.word_text[1:][pair], hashed, np.maximum(self.n_words - 1, 0)))
        text = np.repeat(np.arange(len(self.raw)), self.n_bytes)
        for size in _RUNS:
            n = max(len(self.data) - size + 1, 0)
            key = np.zeros(n, np.uint32)
            for k in range(size):
                key = key * np.uint32(0x01000193) + self.data[k : k + n]
            inside = text[:n] == text[size - 1 :][:n]
            key = (key * np.uint32(0x9E3779B1)) >> np.uint32(32 - _BITS)
            out.append((text[:n][inside], key[inside].astype(np.int64), np.maximum(self.n_bytes - size + 1, 0)))
        return out


class Model:
    """Weights of every kind of feature, and the calibration of their sum."""

    def __init__(self, weights: np.ndarray, bias: float, slope: float, offset: float):
        self.weights, self.bias, self.slope, self.offset = weights, bias, slope, offset

    def raw_scores(self, texts: Texts) -> np.ndarray:
        score = np.full(len(texts.raw), self.bias)
        for kind, (text, feature, n) in enumerate(texts.features()):
            score += np.bincount(text, self.weights[kind][feature], len(n)) / np.maximum(n, 1)
        return score

    def probabilities(self, texts: Texts) -> np.ndarray:
        return _sigmoid(self.slope * self.raw_scores(texts) + self.offset)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def fit(texts: list[str], good: np.ndarray, share: float, steps: int = 100, rate: float = 0.8, decay: float = 1e-5) -> Model:
    """``share``: of good texts among all labelled rows, for the calibration."""
    rows, cols, values, kinds = [], [], [], 2 + len(_RUNS)
    for at in range(0, len(texts), 256):
        for kind, (text, feature, n) in enumerate(Texts(texts[at : at + 256]).features()):
            key, count = np.unique(text * (1 << _BITS) + feature, return_counts=True)
            text = key >> _BITS
            rows.append((text + at).astype(np.int32))
            cols.append(((key & ((1 << _BITS) - 1)) + (kind << _BITS)).astype(np.int32))
            values.append((count / n[text]).astype(np.float32))
    row, col, value = (np.concatenate(x) for x in (rows, cols, values))
    # each kind of feature on one scale, so that the rows have a length of about one
    size = np.repeat(np.sqrt(np.bincount(col >> _BITS, value * value, kinds) / len(texts)) + 1e-12, 1 << _BITS)
    value = (value / size[col]).astype(np.float32)
    held = np.arange(len(texts)) % 5 == 4
    want = good.astype(float)
    weight = np.where(held, 0, np.where(good, 0.5 / max(1, (good & ~held).sum()), 0.5 / max(1, (~good & ~held).sum())))
    # accelerated gradient descent on the logistic loss
    w = ahead = np.zeros((kinds << _BITS) + 1)
    for k in range(steps):
        err = (_sigmoid(np.bincount(row, ahead[col] * value, len(texts)) + ahead[-1]) - want) * weight
        g = np.append(np.bincount(col, err[row] * value, kinds << _BITS) + decay * ahead[:-1], err.sum())
        after = ahead - rate * g
        ahead = after + k / (k + 3) * (after - w)
        w = after
    w, bias = w[:-1], float(w[-1])
    score = (np.bincount(row, w[col] * value, len(texts)) + bias)[held]
    mass = np.where(good[held], share / max(1, good[held].sum()), (1 - share) / max(1, (~good[held]).sum()))
    slope, offset = _platt(score, good[held], mass)
    return Model((w / size).reshape(kinds, -1), bias, slope, offset)


def _platt(score: np.ndarray, good: np.ndarray, mass: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a sigmoid by damped Newton steps; a ridge keeps separable scores finite."""
    if len(score) == 0 or good.all() or not good.any():
        return 1.0, 0.0
    x = np.stack([score, np.ones(len(score))], 1)
    first, ridge = np.array([1.0, 0.0]), 1e-2

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float(mass @ (np.logaddexp(0, z) - good * z) + ridge / 2 * ((w - first) ** 2).sum())

    w = first
    for _ in range(50):
        p = _sigmoid(x @ w)
        g = x.T @ (mass * (p - good)) + ridge * (w - first)
        h = (x * (mass * p * (1 - p))[:, None]).T @ x + ridge * np.eye(2)
        step, size = np.linalg.solve(h, g), 1.0
        while size > 1e-6 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
        if size * np.abs(step).max() < 1e-9:
            break
    return float(max(w[0], 1e-3)), float(w[1])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", per_class: int = PER_CLASS) -> Model | None:
    """Fit on a bounded sample; None if a class is missing."""
    marked = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("good")).where("id IS NOT NULL AND good IN (0, 1)").groupBy("id").agg(F.max("good").alias("good"))
    sizes = {r["good"]: r["n"] for r in marked.groupBy("good").agg(F.count("*").alias("n")).collect()}
    share = sizes.get(1, 0) / max(1, sum(sizes.values()))
    # the hash leaves about three times as many of each class as are wanted, so that no class meets in one task
    part = F.pmod(F.xxhash64("id"), F.lit(1_000_000)) / 1_000_000
    few = [(F.col("good") == good) & (part < 3 * per_class / n) for good, n in sizes.items()]
    marked = marked.where(few[0] | few[-1]) if few else marked
    order = W.partitionBy("good").orderBy(part, "id")
    known = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(F.length("text").between(1, LONGEST))
    ids = marked.join(known.select("id").distinct(), "id").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= per_class)
    sample = known.join(ids, "id").groupBy("id", "good").agg(F.min("text").alias("text"))
    rows = sorted(sample.collect())  # at most two classes of ``per_class`` rows of at most LONGEST characters
    good = np.array([r["good"] == 1 for r in rows], bool)
    if not good.any() or good.all():
        return None
    mixed = np.random.default_rng(9).permutation(len(rows))
    return fit([rows[i]["text"] for i in mixed], good[mixed], float(share))


def judge(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """All columns of the rows with the counts, ``base_failed``, ``probability`` and ``kept``."""
    counted = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    given = docs.drop(*counted, "base_failed", "probability", "kept")
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # a fixed number of weights
    kind = T.StructType([*given.schema.fields, *(T.StructField(c, T.LongType()) for c in counted), T.StructField("probability", T.DoubleType())])

    names = given.columns

    def score(batch: pa.RecordBatch) -> dict:
        made: dict[str, list] = {c: [] for c in (*counted, "probability")}
        for group in by_bytes([t or "" for t in batch.column(text_col).to_pylist()], GROUP):
            texts = Texts(group)
            for c, values in texts.counts().items():
                made[c].append(values)
            made["probability"].append(shared.value.probabilities(texts) if shared.value else np.ones(len(group)))
        return {c: batch.column(c) for c in names} | {c: np.concatenate(x) if x else [] for c, x in made.items()}

    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    scored = map_batches(given, score, kind).withColumn("base_failed", failed)
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("probability") >= threshold))

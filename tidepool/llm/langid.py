"""Language identification by cross-parsing with suffix automata.

For each language a suffix automaton is built from labelled text. A text is parsed greedily into the
longest phrases that occur in the language's sample; few phrases mean that the text is written the way
the sample is. The number of phrases, times the bits to point into the sample, per character estimates the
cross entropy, and the language with the smallest wins (ties: the smaller name).

An automaton knows every letter of its sample: a table holds the next states for the letters most common in it, with a
mark where a phrase ends, and sorted pairs of state and letter hold those for the others, so many stretches of text walk through it at once. Texts are walked in stretches of ``STRETCH`` characters; a phrase ends with its stretch, in every
language alike, and a text of any length is read whole.

The sample is bounded: of each language, whole texts in the order of a hash of their id, up to ``SAMPLE``
characters and at least one text (of which then only so much is used to build the automaton). Rows of the
held-out third, null ids, null texts and null languages teach nothing. Null texts, texts without a
letter and all texts if nothing could be learned are ``und`` with score 0. Letters that no sample has are a phrase each
in every language, so a text of such letters alone goes to the language with the shortest pointers (the smallest
sample, then the smaller name) with a score of about one in the number of languages. Repeated rows stay. Other columns are not looked at. An
empty table gives an empty result.
"""

from __future__ import annotations

import math
import unicodedata
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidepool.llm.common import by_bytes, map_batches, per_process

SAMPLE = 30_000
#: Texts of each language that the sample is taken from.
SAMPLE_TEXTS = 200
STRETCH = 256
#: Characters of the texts that are parsed together.
GROUP = 1 << 20
#: Letters of a language that its table has columns for; the transitions by all others are looked up.
LETTERS = 60


def clean(text: str) -> str:
    """Lower-cased, with one space for anything but letters."""
    return " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split())


def automaton(text: list[int], letters: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``table``, ``start``, ``keys`` and ``to``; text and letters are numbers below ``letters``, 0 is in no text.

    ``table`` is state x letter -> 2 * next state + 1 if a phrase ends before the letter, for the letters up to
    ``LETTERS``; ``start`` is the state after each letter at the start. Sorted ``keys`` are state * ``letters`` + letter
    of the transitions by further letters, ``to`` the states they lead to. State 0 is the start.

    Suffix automaton by Blumer's construction: states are classes of substrings with the same ends.
    """
    step: list[dict[int, int]] = [{}]
    link, size, last = [-1], [0], 0
    for c in text:
        new = len(step)
        step.append({})
        size.append(size[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = new
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if size[p] + 1 == size[q]:
                link[new] = q
            else:
                twin = len(step)
                step.append(dict(step[q]))
                size.append(size[p] + 1)
                link.append(link[q])
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = twin
                    p = link[p]
                link[q] = link[new] = twin
        last = new
    lost = len(step)  # behind a letter that the sample has not
    start = np.full(letters, lost, np.int32)
    for c, to in step[0].items():
        start[c] = to
    width = min(letters, LETTERS + 1)
    table = np.tile(start[:width] * 2 + 1, (lost + 1, 1))
    table[0] = start[:width] * 2  # no phrase is open yet
    rare = []
    for state, steps in enumerate(step):
        for c, to in steps.items():
            if c < width:
                table[state, c] = to * 2
            else:
                rare.append((state * letters + c, to))
    rare.sort()
    return table, start, np.array([k for k, _ in rare], np.int64), np.array([to for _, to in rare], np.int32)


class Languages:
    def __init__(self, samples: dict[str, str]):
        self.names = sorted(samples)
        texts = {name: clean(samples[name])[:SAMPLE] for name in self.names}
        # class 0: a letter that no sample has, class 1: anything else
        self.codes = {" ": 1} | {c: k + 2 for k, c in enumerate(sorted(set("".join(texts.values())) - {" "}))}
        self.kind = np.min_scalar_type(len(self.codes) + 1)
        self.automata = []
        for name in self.names:
            counts = Counter(texts[name])
            # the language's own numbers: the commonest letters first, 0 for those its sample has not
            own = {c: k + 1 for k, c in enumerate(sorted(counts, key=lambda c: (-counts[c], c)))}
            number = np.zeros(len(self.codes) + 1, np.int32)
            for c, k in own.items():
                number[self.codes[c]] = k
            self.automata.append((number, len(own) + 1, *automaton([own[c] for c in texts[name]], len(own) + 1)))
        self.bits = np.array([math.log2(max(2, len(texts[n]))) for n in self.names])

    def encode(self, text: str) -> np.ndarray:
        points = np.frombuffer(text.lower().encode("utf-32-le"), "<u4")
        out = self.classes[points]
        space = out == 1
        keep = ~(space & np.concatenate([[True], space[:-1]])) if len(out) else space
        return out[keep]

    @property
    def classes(self) -> np.ndarray:
        """Class of each code point."""
        if "_classes" not in self.__dict__:
            found = np.ones(0x110000, self.kind)
            for point in range(0x110000):
                if unicodedata.category(chr(point))[0] == "L":
                    found[point] = self.codes.get(chr(point), 0)
            self._classes = found
        return self._classes

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Number of phrases, text x language."""
        n = np.array([-(-len(t) // STRETCH) for t in texts])
        owner = np.repeat(np.arange(len(texts)), n)
        lanes = np.zeros((len(owner), STRETCH), self.kind)
        sizes = np.zeros(len(owner), np.int64)
        at = 0
        for t, k in zip(texts, n.tolist(), strict=True):
            flat = lanes[at : at + k].reshape(-1)
            flat[: len(t)] = t
            sizes[at : at + k] = STRETCH
            if k:
                sizes[at + k - 1] = len(t) - (k - 1) * STRETCH
            at += k
        order = np.argsort(-sizes, kind="stable")
        letters = np.ascontiguousarray(lanes[order].T)
        going = np.searchsorted(-sizes[order], -np.arange(STRETCH), side="left")  # lanes longer than k
        counts = np.zeros((len(texts), len(self.names)), np.int64)
        for k, (number, size, table, start, keys, nexts) in enumerate(self.automata):
            flat, width = table.ravel(), table.shape[1]
            state = np.zeros(len(owner), np.int32)
            ended = np.zeros(len(owner), np.int32)
            for j in range(STRETCH):
                m = going[j]
                if not m:
                    break
                letter = number[letters[j, :m]]
                if len(keys):
                    to = flat[state[:m] * width + np.minimum(letter, width - 1)]
                    rare = np.flatnonzero(letter >= width)
                    if len(rare):
                        at, c = state[rare], letter[rare]
                        key = at.astype(np.int64) * size + c
                        place = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                        to[rare] = np.where(keys[place] == key, nexts[place] * 2, start[c] * 2 + (at > 0))
                else:
                    to = flat[state[:m] * width + letter]
                ended[:m] += to & 1
                state[:m] = to >> 1
            # an ended phrase is counted where the next begins, so each stretch has one more
            counts[:, k] = np.bincount(owner[order], ended + 1, len(texts)).astype(np.int64)
        return counts

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score of each text, by groups of ``GROUP`` characters, whose codes and lanes alone are held."""
        made = [self._predict(group) for group in by_bytes([t or "" for t in texts], GROUP)]
        return [name for names, _ in made for name in names], np.concatenate([np.zeros(0), *[scores for _, scores in made]])

    def _predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        coded = [self.encode(t) for t in texts]
        some = np.array([bool((c != 1).any()) for c in coded], bool)
        if not self.names:
            return ["und"] * len(texts), np.zeros(len(texts))
        cost = self.phrases(coded) * self.bits
        best = np.argmin(cost, axis=1)
        ease = (cost.min(axis=1, keepdims=True) / np.maximum(cost, 1e-9)) ** 4
        score = np.where(some, ease.max(axis=1) / np.maximum(ease.sum(axis=1), 1e-9), 0.0)
        return [self.names[b] if s else "und" for b, s in zip(best, some, strict=True)], np.clip(score, 0, 1)


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", held_out: int = 1) -> dict[str, str]:
    """Text of each language from rows outside the held-out third; bounded, so the driver may hold it."""
    crc = F.crc32(F.col(id_col).cast("string"))
    rows = docs.where(F.col(id_col).isNotNull() & F.col(lang_col).isNotNull() & (F.length(text_col) > 0) & (crc % 3 != held_out))
    order = W.partitionBy("lang").orderBy("h", "id")
    ranked = rows.select(F.col(lang_col).alias("lang"), F.xxhash64(id_col).alias("h"), F.col(id_col).alias("id")).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= SAMPLE_TEXTS)
    # only as much of a chosen text as the automaton can use goes to the driver
    chosen = rows.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.substring(text_col, 1, 2 * SAMPLE).alias("text")).join(ranked.select("id", "lang", "h").distinct(), ["id", "lang"])
    before = F.sum(F.length("text")).over(W.partitionBy("lang").orderBy("h", "id", "text").rowsBetween(W.unboundedPreceding, -1))
    picked = chosen.withColumn("before", F.coalesce(before, F.lit(0))).where(F.col("before") < SAMPLE)
    samples: dict[str, list[str]] = {}
    for row in picked.orderBy("lang", "before", "h", "id").collect():
        samples.setdefault(row["lang"], []).append(row["text"])
    return {name: " ".join(texts) for name, texts in samples.items()}


def identify(docs: DataFrame, samples: dict[str, str], id_col: str = "doc_id", text_col: str = "text", held_out: int = 1) -> DataFrame:
    """``id_col``, ``held_out``, ``lang_pred`` and ``score`` of every row."""
    kind = docs.schema[id_col].dataType.simpleString()
    crc = F.crc32(F.col(id_col).cast("string"))
    given = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(crc % 3 == held_out, F.lit(False)).alias("held_out"), F.col(text_col).alias("text"))
    key = ("languages", hash(tuple(sorted(samples.items()))))

    def work(batch: pa.RecordBatch) -> dict:
        languages = per_process(key, lambda: Languages(samples))
        names, scores = languages.predict(batch.column("text").to_pylist())
        return {"doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"), "lang_pred": names, "score": scores}

    return map_batches(given, work, f"doc_id {kind}, held_out boolean, lang_pred string, score double").withColumnRenamed("doc_id", id_col)

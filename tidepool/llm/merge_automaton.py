"""Byte-level BPE by a tokenization automaton: encoding and decoding of whole texts.

Compilation. A deterministic automaton over tokens starts as one state with a loop for every byte, which accepts
every string. The merges are then built into it one by one, each by a gadget: for the merge of u and v, the state that u
leads to loses its arc v (the arcs of other tokens into it first get a state of their own, a copy without the loss), and
wherever u had an arc there is now one for uv, to where v led. After the last merge the automaton accepts the one
correct segmentation of every string and nothing else. All arcs of a token lead to the same state, so the automaton
is kept as a target per token, and a copy of a state is kept as its origin and the moment of the split; an arc is looked
up along origins and left halves and noted in a table.

Encoding. A prefix of a correct segmentation is the correct one of its own text, so each place of a word is reached by
one token: of the labels that end there, the one that the automaton has an arc for in the state where it starts. What
matters of the text before is the longest prefix of a label that it ends with, and the automaton's states along that
prefix. So a word is encoded byte by byte through a table of such places and bytes, filled as texts need it, and read
back from its end. That takes linear time, whatever the word.

Decoding emits the labels of the arcs, one per id. Bytes that are not UTF-8 become replacement characters, ids of special
tokens their strings.

Words are cut by the tokenizer's own pre-splitter, strings of special tokens are found first. Null and empty texts have
no ids. Repeated rows and ids stay separate rows. Very long texts and words are encoded whole. An empty table gives an
empty result. Other columns are not looked at.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import map_batches, per_process, whole_text
from tidepool.llm.encoders import PartEncoder

#: Places of the table that a worker keeps; a full table is begun anew. Bounds memory, never the result.
KEPT_PLACES = 150_000
START = 0
_LETTERS = re.compile(" ?[A-Za-zÀ-ÖØ-öø-ÿ]+")


def byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: printable ones themselves, the rest from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


class MergeAutomaton:
    """Tokens are numbers; ``labels`` has each one's bytes, ``merges`` (u, v, uv) in order of rank."""

    def __init__(self, labels: dict[int, bytes], merges: list[tuple[int, int, int]]):
        self.size = max(labels, default=0) + 1
        made = {w for _, _, w in merges}
        if len(made) < len(merges):
            raise ValueError("a token has more than one merge")
        #: per state: the state it was split from, and the merge that did so
        self.origin, self.birth, users = [START], [-1], [1]  # the start counts as a user: it stays as it is
        self.target, self.left, self.born = {}, {}, {}
        self.lost: dict[int, int] = {}  # (state, token) -> the merge that took the arc
        for t in labels:
            if t not in made:
                self.target[t], self.left[t], self.born[t] = START, None, -1
                users[START] += 1
        for rank, (u, v, w) in enumerate(merges):
            if w in self.target or any(x in made and x not in self.born for x in (u, v)):
                raise ValueError("a merge comes before those of its halves")
            q, self.born[w] = self.target.get(u), rank
            if q is None or v not in self.target or not self.arc(q, v):
                continue  # u is never followed by v when its turn comes: no text holds this token
            self.target[w], self.left[w] = self.target[v], u
            users[self.target[v]] += 1
            if users[q] > 1:
                users[q] -= 1
                self.origin.append(q)
                self.birth.append(rank)
                users.append(1)
                q = self.target[u] = len(users) - 1
            self.lost[q * self.size + v] = rank
        self.lengths = {t: len(label) for t, label in labels.items()}
        self._suffixes({t: labels[t] for t in self.target})
        self.tokens: list[int] = []
        self._forget()

    def _suffixes(self, labels: dict[int, bytes]) -> None:
        """For each prefix of a label: the labels that it ends with, longest first, and where each byte leads."""
        self.goto, own, self.depth, parent = {}, [-1], [0], [(0, 0)]
        for t, label in labels.items():
            node = 0
            for b in label:
                at, node = node, self.goto.setdefault(node << 8 | b, len(own))
                if node == len(own):
                    own.append(-1)
                    self.depth.append(self.depth[at] + 1)
                    parent.append((at, b))
            own[node] = t
        self.shorter = [0] * len(own)
        self.ending: list[tuple[int, ...]] = [()] * len(own)
        for node in sorted(range(1, len(own)), key=self.depth.__getitem__):
            at, b = parent[node]
            self.shorter[node] = self._lead(self.shorter[at], b) if at else 0
            self.ending[node] = ((own[node],) if own[node] >= 0 else ()) + self.ending[self.shorter[node]]

    def _lead(self, node: int, b: int) -> int:
        """The longest prefix of a label that a node's text ends with once ``b`` is added."""
        while (to := self.goto.get(node << 8 | b)) is None and node:
            node = self.shorter[node]
        return to or 0

    def _forget(self) -> None:
        self.tokens.clear()
        self.places: list[tuple[int, tuple[int, ...]]] = []
        self.numbers: dict[tuple[int, tuple[int, ...]], int] = {}
        self.steps: dict[int, int] = {}
        self.arcs: dict[int, bool] = {}
        self._number(0, (START,), -1)

    def _number(self, node: int, states: tuple[int, ...], token: int) -> int:
        place = (node, states)
        if (k := self.numbers.get(place)) is None:
            k = self.numbers[place] = len(self.places)
            self.places.append(place)
            self.tokens.append(token)
        return k

    def _step(self, place: int, b: int) -> int:
        """The next place, worked out once: the token that ends there starts where the automaton has an arc for it."""
        node, states = self.places[place]
        if len(self.places) >= KEPT_PLACES:
            token = self.tokens[place]
            self._forget()
            place = self._number(node, states, token)
        to = self._lead(node, b)
        for t in self.ending[to]:
            q = states[-self.lengths[t]]
            if (ok := self.arcs.get(q * self.size + t)) is None:
                ok = self.arcs[q * self.size + t] = self.arc(q, t)
            if ok:
                break
        k = self.steps[place << 8 | b] = self._number(to, (states + (self.target[t],))[-self.depth[to] - 1 :], t)
        return k

    def arc(self, q: int, t: int) -> bool:
        """Whether state ``q`` has an arc for token ``t``, as far as the merges have been built in."""
        lost, size, born, birth = self.lost, self.size, self.born, self.birth
        before = len(born)
        while True:
            if lost.get(q * size + t, before) < before:
                return False
            if birth[q] > born[t]:
                before, q = birth[q], self.origin[q]  # the copy has what its origin had then
            elif self.left[t] is None:
                return True
            else:
                before, t = born[t] + 1, self.left[t]  # uv came where u was, after u's own loss

    def encode(self, word: bytes) -> list[int]:
        """The tokens of one pre-split word."""
        place, steps, tokens, sizes, last = 0, self.steps, self.tokens, self.lengths, []
        for b in word:
            to = steps.get(place << 8 | b)
            if to is None:
                to = self._step(place, b)
                steps = self.steps
            place = to
            last.append(tokens[place])
        out, n = [], len(word)
        while n:
            t = last[n - 1]
            out.append(t)
            n -= sizes[t]
        return out[::-1]


class Vocabulary:
    """What a tokenizer's file says, and the labels of its ids."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            given = json.load(file)
        model, added = given["model"], given["added_tokens"]
        if given["normalizer"] or model["type"] != "BPE" or any(model.get(k) for k in ("dropout", "byte_fallback", "ignore_merges", "continuing_subword_prefix", "end_of_word_suffix")):
            raise ValueError("only plain byte-level BPE is compiled")
        if any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("only plain special tokens are known")
        vocab, letter = model["vocab"], byte_letters()
        self.special = {t["content"]: t["id"] for t in added}
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.merges = [(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs]
        self.labels = {i: bytes(letter[c] for c in s) for s, i in vocab.items() if s not in self.special}


class Decoder:
    """Arc labels in arrays; without the automaton, as its states do not matter for them."""

    def __init__(self, path: str):
        vocabulary = Vocabulary(path)
        labels = vocabulary.labels | {i: s.encode() for s, i in vocabulary.special.items()}
        every = [labels.get(i, b"") for i in range(max(labels) + 1)]
        self.bytes = np.frombuffer(b"".join(every), np.uint8)
        self.sizes = np.array([len(s) for s in every])
        self.starts = np.cumsum(self.sizes) - self.sizes

    def decode(self, ids: np.ndarray) -> bytes:
        """The labels of ``ids``, one after the other."""
        n = self.sizes[ids]
        ends = np.cumsum(n)
        places = np.repeat(self.starts[ids] - (ends - n), n) + np.arange(ends[-1] if len(ids) else 0)
        return self.bytes[places].tobytes()


class AutomatonEncoder(PartEncoder):
    """Whole texts in Arrow, with a part between white space encoded once per worker."""

    def __init__(self, path: str):
        vocabulary = Vocabulary(path)
        self.automaton = MergeAutomaton(vocabulary.labels, vocabulary.merges)
        self.special_ids = vocabulary.special
        longest_first = sorted(self.special_ids, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if longest_first else None
        super().__init__(path)

    def _ids(self, text: str) -> list[int]:
        pieces = self.cut.split(text) if self.cut else [text]
        ids, presplit, encode = [], self.tokenizer.pre_tokenizer.pre_tokenize_str, self.automaton.encode
        for k, piece in enumerate(pieces):
            if k % 2:
                ids.append(self.special_ids[piece])
            elif piece:
                for _, (start, end) in presplit(piece):
                    ids.extend(encode(piece[start:end].encode()))
        return ids

    def _raw(self, texts: list[str]) -> list[bytes]:
        return [np.array(self._ids(t), self.dtype).tobytes() for t in texts]

    def _words(self, words: list[str]) -> list[bytes]:
        """Letters behind at most one space are one word for the pre-splitter, so it need not be asked."""
        encode, dtype, one = self.automaton.encode, self.dtype, _LETTERS.fullmatch
        return [np.array(encode(w.encode()) if one(w) else self._ids(w), dtype).tobytes() for w in words]


def automaton(path: str) -> AutomatonEncoder:
    return per_process(("automaton", path), lambda: AutomatonEncoder(path))


def decoder(path: str) -> Decoder:
    return per_process(("arc labels", path), lambda: Decoder(path))


def _buffers(ids: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    data, ends = ids.astype("<u4").tobytes(), np.cumsum(sizes) * 4
    return [data[a:b] for a, b in zip(ends - sizes * 4, ends, strict=True)]


def _texts(emit: Decoder, buffers: list[bytes | None]) -> list[str]:
    return [emit.decode(np.frombuffer(b or b"", "<u4")).decode("utf-8", "replace") for b in buffers]


def _mapped(df: DataFrame, id_col: str, given: Column, fn: Callable[[pa.Array], dict[str, Any]], results: str) -> DataFrame:
    rows = df.select(F.col(id_col).alias("key"), given.alias("given"))
    schema = f"key {df.schema[id_col].dataType.simpleString()}, {results}"
    return map_batches(rows, lambda batch: {"key": batch.column("key"), **fn(batch.column("given"))}, schema).withColumnRenamed("key", id_col)


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``ids``, little-endian unsigned 32-bit numbers one after the other."""
    return _mapped(docs, id_col, whole_text(text_col), lambda texts: {"ids": _buffers(*automaton(path).encode(texts))}, "ids binary")


def decode_documents(encoded: DataFrame, path: str, id_col: str = "doc_id") -> DataFrame:
    """``id_col`` and the ``text`` of ``ids``; ids beyond the vocabulary are an error, null ids an empty text."""
    return _mapped(encoded, id_col, F.col("ids"), lambda ids: {"text": _texts(decoder(path), ids.to_pylist())}, "text string")


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``ids`` and the ``text`` that they decode to, in one pass: a worker then holds a batch once."""

    def both(texts: pa.Array) -> dict:
        ids = _buffers(*automaton(path).encode(texts))
        return {"ids": ids, "text": _texts(decoder(path), ids)}

    return _mapped(docs, id_col, whole_text(text_col), both, "ids binary, text string")

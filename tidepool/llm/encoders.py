"""Whole-text encoding with the tokenizers library, one word at a time and each word once per worker.

Both vocabularies used here cut a text into words before they merge anything, and always cut at a
single space, and on both sides of a single line feed, between two characters that are not white
space. The ids of a text are therefore those of its parts between such places, and a part seen before
need not be encoded again. Texts with other white space or with special strings are encoded whole.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from tidepool.llm.common import per_process

#: Parts kept per worker, and the longest part that is kept: bounds memory, never the result.
KEPT_PARTS = 150_000
KEPT_LENGTH = 40
GROUP = 2 << 20

_WHITE = "[\\x09-\\x0D\\x1C-\\x20\\x85\\xA0\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]"
_UNEVEN = f"[ \\n]{_WHITE}|{_WHITE}[ \\n]|\\A{_WHITE}|{_WHITE}\\z"


_SAMPLES = ("a", " a", "Of", " The", " there", " Reoushwhere", "inationalXqz", " Über", "éàßÿ")
_LETTERS = re.compile(" ?[A-Za-zÀ-ÖØ-öø-ÿ]+")


def _with_space(word: str) -> str:
    """How byte-level vocabularies write a word and the space before it."""
    return word.replace(" ", "Ġ")


def _lowered(word: str) -> str:
    return word.strip().lower()


def _strings(texts: pa.Array) -> list[str]:
    return texts.to_numpy(zero_copy_only=False).tolist()  # several times faster than to_pylist


class PartEncoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.code = "H" if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "I"
        self.dtype = np.dtype(self.code)
        bytes_of = ByteLevel(add_prefix_space=False, use_regex=False)
        self.letters = {c: bytes_of.pre_tokenize_str(chr(c))[0][0] for c in range(0xC0, 0x100)}
        self.plain = None
        for form in (_with_space, _lowered):
            if all(self._model(form(w).translate(self.letters)) == self._raw([w])[0] for w in _SAMPLES):
                self.plain = form
        self.line_feed, *marks = self._raw(["\n", ".", ","])
        self.marks = dict(zip(".,", marks, strict=True))
        # a part met again moves from the trial to those kept; a full trial is emptied, full kept ones are tried anew
        self.kept: dict[str, bytes] = {}
        self.trial: dict[str, bytes] = {}

    def _raw(self, texts: list[str]) -> list[bytes]:
        got = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array(self.code, e.ids).tobytes() for e in got]

    def _model(self, word: str) -> bytes:
        return array(self.code, [t.id for t in self.tokenizer.model.tokenize(word)]).tobytes()

    def _words(self, words: list[str]) -> list[bytes]:
        """Western letters are their own normal form and one word, so the merges can run on them at once."""
        out: list[bytes] = [b""] * len(words)
        rest = []
        tokenize, plain, code = self.tokenizer.model.tokenize, self.plain, self.code
        for i, w in enumerate(words):
            bare = w[1:] if w[:1] == " " else w
            if plain and bare.isascii() and bare.isalpha():
                out[i] = array(code, [t.id for t in tokenize(plain(w))]).tobytes()
            elif plain and _LETTERS.fullmatch(w):
                out[i] = array(code, [t.id for t in tokenize(plain(w).translate(self.letters))]).tobytes()
            else:
                rest.append(i)
        for i, ids in zip(rest, self._raw([words[i] for i in rest]), strict=True):
            out[i] = ids
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and the number of ids of each text."""
        texts = texts.cast(pa.large_string())
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False)) // GROUP
        cuts = [0, *(np.flatnonzero(np.diff(ends)) + 1), len(texts)]
        done = [self._encode(texts[i:j]) for i, j in zip(cuts, cuts[1:], strict=False) if j > i]
        if not done:
            return np.empty(0, self.dtype), np.empty(0, np.int64)
        return tuple(np.concatenate(x) for x in zip(*done, strict=True))

    def _encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        odd = pc.match_substring_regex(texts, _UNEVEN)
        for s in self.special:
            odd = pc.or_(odd, pc.match_substring(texts, s))
        lines = pc.split_pattern(pc.if_else(odd, "", texts), "\n")
        n_lines = np.diff(lines.offsets.to_numpy())
        split = pc.split_pattern(lines.values, " ")
        offsets = split.offsets.to_numpy()
        parts = split.values
        heads = np.zeros(len(parts), bool)
        heads[offsets[:-1]] = True
        first = parts.filter(pa.array(heads)).dictionary_encode()
        later = parts.filter(pa.array(~heads)).dictionary_encode()
        nothing, space = (pa.scalar(x, pa.large_string()) for x in ("", " "))
        spaced = pc.binary_join_element_wise(nothing, later.dictionary, space)

        whole = texts.filter(odd).to_pylist()
        values = self._lookup(_strings(first.dictionary)) + self._lookup(_strings(spaced)) + self._raw(whole) + [self.line_feed, b""]
        feed = len(values) - 2
        # a place for each part, and one behind each line for its line feed
        sizes = np.diff(offsets)
        last_lines = np.cumsum(n_lines) - 1
        own = np.empty(len(parts), np.int64)
        own[heads] = first.indices.to_numpy()
        own[~heads] = later.indices.to_numpy().astype(np.int64) + len(first.dictionary)
        own[offsets[last_lines[odd.to_numpy(zero_copy_only=False)]]] = feed - len(whole) + np.arange(len(whole))
        which = np.full(len(parts) + len(sizes), feed)
        which[np.arange(len(parts)) + np.repeat(np.arange(len(sizes)), sizes)] = own
        last = (np.cumsum(sizes + 1) - 1)[last_lines]
        which[last] = feed + 1

        lengths = np.fromiter(map(len, values), np.int64, len(values)) // self.dtype.itemsize
        ids = np.frombuffer(b"".join(values), self.dtype)
        n = lengths[which]
        ends = np.cumsum(n)
        shift = (np.cumsum(lengths) - lengths)[which] - (ends - n)
        return ids[np.repeat(shift, n) + np.arange(ends[-1])], np.diff(ends[last], prepend=0)

    def _lookup(self, words: list[str]) -> list[bytes]:
        """Ids of each part. A sentence end behind a letter is a word of its own, so only the letters are new."""
        kept, trial, marks = self.kept, self.trial, self.marks
        found = list(map(kept.get, words))
        todo, stems = [], {}
        for i, ids in enumerate(found):
            if ids is None:
                w = words[i]
                ids = trial.get(w)
                if ids is not None:
                    found[i] = kept[w] = ids
                    continue
                todo.append(i)
                if w[-1:] in marks and w[-2:-1].isalpha() and w[-2] < "Ā":
                    w = w[:-1]
                stems[w] = kept.get(w) or trial.get(w)
        new = [w for w, ids in stems.items() if ids is None]
        for w, ids in zip(new, self._words(new), strict=True):
            stems[w] = ids
            if len(w) <= KEPT_LENGTH:
                trial[w] = ids
        for i in todo:
            w = words[i]
            if w in stems:
                found[i] = stems[w]
            else:
                ids = found[i] = stems[w[:-1]] + marks[w[-1]]
                if len(w) <= KEPT_LENGTH:
                    trial[w] = ids
        if len(kept) > KEPT_PARTS:
            self.kept, self.trial = {}, kept
        elif len(trial) > 2 * KEPT_PARTS:
            self.trial = {}
        return found


def encoder(path: str) -> PartEncoder:
    return per_process(("tokenizers", path), lambda: PartEncoder(path))

"""N-best segmentation with SentencePiece pieces, and decoding.

A text becomes a lattice: an edge for every piece that matches, weighted with the piece's score; a
character that no piece covers is one edge below all scores and is written as its bytes. A forward
Viterbi pass gives every place its best score from the start. These scores are the exact remaining cost of
a backward A* search from the end, so each path that it takes up is the next best one, and the first N that
reach the start are the N best.

No piece crosses a place whose two neighbouring characters stand in no piece side by side, so the lattice
falls into units there (at the latest between words), and equal units have equal results. A second pass from
the end tells how much a unit's second best path costs; only the N - 1 units where a change costs least can
differ in the N best of a text, and the search runs for those alone.

Order: higher score first. Within a unit equal scores are ordered by the lengths of the pieces from the end,
longer first; in a text by the ranks of its units from the start, lower first.

A very long stretch that no cut divides is one unit: its time and memory grow with its length alone.

Null and empty texts have one segmentation, without pieces. Texts with fewer than N segmentations have fewer
rows. Repeated rows stay. Other columns are not looked at. An empty table gives an empty result.
"""

from __future__ import annotations

import gc
import math
import zlib
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import by_bytes, map_batches, per_process, whole_text

SPACE = "▁"
#: How far an uncovered character lies below the lowest score.
UNKNOWN_PENALTY = 10.0
#: Words kept per worker, and how many of them survive when there are more: bounds memory, never the result.
KEPT_WORDS = 500_000
SURVIVORS = 60_000
KEPT_LENGTH = 40
#: Texts of up to so many characters are solved together, so many places of them at a time.
SHORT = 48
PLACES = 200_000
#: Characters of text whose new words are solved together.
GROUP = 4_000_000


#: An edge of the lattice, and how many are walked at a time.
EDGE = np.dtype([("start", np.int32), ("end", np.int32), ("score", np.float64)])
WALKED = 100_000


class Unit:
    """Best path of a stretch of text that pieces do not leave, and what the second best costs more."""

    __slots__ = ("ids", "score", "gap")

    def __init__(self, ids: bytes, score: float, gap: float):
        self.ids, self.score, self.gap = ids, score, gap


class _Open:
    """A path from the end: score of its best whole path, lengths of its pieces, where it stands and its own score."""

    __slots__ = ("total", "sizes", "at", "behind")

    def __init__(self, total: float, sizes: np.ndarray, at: int, behind: float):
        self.total, self.sizes, self.at, self.behind = total, sizes, at, behind

    def __lt__(self, other: _Open) -> bool:
        if self.total != other.total:
            return self.total > other.total
        k = _common(self.sizes, other.sizes)
        return k < min(len(self.sizes), len(other.sizes)) and bool(self.sizes[k] > other.sizes[k])


class _Growing:
    """An array that grows at its end."""

    def __init__(self, kind: type):
        self.data, self.n = np.empty(1024, kind), 0

    def add(self, more: np.ndarray) -> None:
        need = self.n + len(more)
        if need > len(self.data):
            self.data = np.concatenate([self.data[: self.n], np.empty(need, self.data.dtype)])
        self.data[self.n : need] = more
        self.n = need


class _Solved:
    """Numbered units, and numbered words that are runs of units, in arrays."""

    def __init__(self) -> None:
        self.score, self.gap, self.first, self.size, self.ids = map(_Growing, (np.float64, np.float64, np.int64, np.int64, np.uint32))
        self.texts: list[str] = []
        self.members, self.word_first, self.word_size, self.uses = map(_Growing, (np.int64,) * 4)
        self.words: dict[str, int] = {}
        self.parts: dict[str, int] = {}
        self.ranked: dict[int, list[tuple[float, bytes]]] = {}


class Segmenter:
    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        special = [i for i in range(len(model)) if model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i)]
        normal = sorted(set(range(len(model))) - set(special))
        self.pieces = {model.id_to_piece(i): (i, float(model.get_score(i))) for i in normal}
        self.unknown_score = min(s for _, s in self.pieces.values()) - UNKNOWN_PENALTY
        self.bytes = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.fallback = all(model.is_byte(i) for i in self.bytes)
        self.unknown = model.unk_id()
        self.starts = {p[:k] for p in self.pieces for k in range(1, len(p) + 1)}
        self.joined = {p[i : i + 2] for p in self.pieces for i in range(len(p) - 1)}
        self.by_word = not any(pair[1] == SPACE and pair[0] != SPACE for pair in self.joined)
        self.surface = [model.id_to_piece(i).replace(SPACE, " ").encode() for i in range(len(model))]
        for b, i in enumerate(self.bytes):
            self.surface[i] = bytes([b]) if self.fallback else self.surface[i]
        for i in range(len(model)):
            if model.is_control(i):
                self.surface[i] = b""
        self.table = _Table(self.starts, self.pieces)
        self.pairs = np.sort(np.array([(ord(p[0]) << 21) | ord(p[1]) for p in self.joined], np.int64))
        self.solved = _Solved()

    def edges(self, text: str) -> Iterator[tuple[int, int, float]]:
        """(start, end, score) of every piece that matches, by start."""
        pieces, starts, n = self.pieces, self.starts, len(text)
        for i in range(n):
            single = False
            for j in range(i + 1, n + 1):
                part = text[i:j]
                if part not in starts:
                    break
                if part in pieces:
                    yield i, j, pieces[part][1]
                    single = single or j == i + 1
            if not single:
                yield i, i + 1, self.unknown_score

    def piece_ids(self, part: str) -> list[int]:
        if part in self.pieces:
            return [self.pieces[part][0]]
        return [self.bytes[b] for b in part.encode()] if self.fallback else [self.unknown]

    def _forward(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The edges, the best score of every place from the start, and where the last piece of that path starts."""
        edges = np.fromiter(self.edges(text), EDGE)
        ahead = array("d", [0.0]) + array("d", [-math.inf]) * len(text)
        last = array("q", [0]) * (len(text) + 1)
        for some in _parts(edges):
            for i, j, score in some.tolist():  # a tie goes to the longer last piece, which starts earlier
                total = ahead[i] + score
                if total > ahead[j]:
                    ahead[j], last[j] = total, i
        return edges, np.frombuffer(ahead), np.frombuffer(last, np.int64)

    def _written(self, text: str, sizes: np.ndarray) -> bytes:
        """Ids of the pieces with these lengths from the end."""
        ends = np.cumsum(sizes[::-1]).tolist()
        return array("I", [x for i, j in zip([0, *ends], ends, strict=False) for x in self.piece_ids(text[i:j])]).tobytes()

    def solve(self, text: str) -> Unit:
        """Best path and the cost of the second best, by a pass in each direction."""
        edges, ahead, last = self._forward(text)
        n = len(text)
        places = _way(last, n)
        back = array("d", [-math.inf]) * n + array("d", [0.0])
        for some in reversed(list(_parts(edges))):
            for i, j, score in reversed(some.tolist()):
                rest = score + back[j]
                if rest > back[i]:
                    back[i] = rest
        on = np.zeros(n + 1, bool)
        on[places] = True
        start, end = edges["start"], edges["end"]
        off = ~on[end] | (last[end] != start)
        through = ahead[start] + (edges["score"] + np.frombuffer(back)[end])
        second = float(through[off].max(initial=-math.inf))
        return Unit(self._written(text, -np.diff(places)), float(ahead[n]), float(ahead[n]) - second)

    def search(self, text: str, n_best: int) -> list[tuple[float, bytes]]:
        """Backward A*: the next best (score, ids) until there are ``n_best``.

        The forward scores are exact, so what is taken from the open list goes straight on to the start, and every
        edge beside that way opens another path, whose score is known. Each open path leads to a different
        segmentation, so only as many stay open as are still wanted: memory is a few numbers an edge.
        """
        edges, ahead, last = self._forward(text)
        n = len(text)
        start, end, score = edges["start"], edges["end"], edges["score"]
        found: list[tuple[float, bytes]] = []
        opened = [_Open(float(ahead[n]), np.zeros(0, np.int64), n, 0.0)]
        while opened and len(found) < n_best:
            path = opened.pop(0)
            places = _way(last, path.at)
            sizes = np.concatenate([path.sizes, -np.diff(places)])
            # scores from the end up to each place of the way
            depth = np.full(n + 1, -1)
            depth[places] = np.arange(len(places))
            beside = np.flatnonzero(depth[end] >= 0)
            taken = last[end[beside]] == start[beside]
            steps = np.zeros(len(places))
            steps[depth[end[beside[taken]]] + 1] = score[beside[taken]]
            steps[0] = path.behind
            behind = np.cumsum(steps)
            found.append((float(behind[-1]), self._written(text, sizes)))
            if not (wanted := n_best - len(found)):
                break
            beside = beside[~taken]
            total = ahead[start[beside]] + score[beside] + behind[depth[end[beside]]]
            if len(beside) > wanted:
                high = total >= np.partition(total, -wanted)[-wanted]
                beside, total = beside[high], total[high]
            # equal scores: a longer piece than the way's stands before all that follow the way further, a shorter one after them
            at = depth[end[beside]]
            size = (end[beside] - start[beside]).astype(np.int64)
            shorter = size < (end[beside] - last[end[beside]])
            for k in np.lexsort((-size, np.where(shorter, -at, at), shorter, -total))[:wanted].tolist():
                d = int(at[k])
                passed = np.append(sizes[: len(path.sizes) + d], size[k])
                opened.append(_Open(float(total[k]), passed, int(start[beside[k]]), float(behind[d] + score[beside[k]])))
            opened = sorted(opened)[:wanted]
        return found

    def words(self, text: str) -> list[str]:
        """The text cut before its spaces; each word stands without the space before it."""
        if not text:
            return []
        words = text.replace(SPACE, " ").split(" ")
        if not self.by_word:
            return [SPACE.join(words)]
        if "" in words:
            joined, gap = [], ""
            for w in words[:-1]:
                gap += SPACE
                if w:
                    joined.append(gap[1:] + w)
                    gap = ""
            words = [*joined, gap + words[-1]]
        return words

    def units_of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of all texts' units, and how many each text has; what is new in any text is solved together."""
        self._forget()
        split = [self.words(t) for t in texts]
        words = list(chain.from_iterable(split))
        numbers = list(map(self.solved.words.get, words))
        missing = [k for k, number in enumerate(numbers) if number is None]
        if missing:
            new = dict.fromkeys([words[k] for k in missing])
            self._learn(new)
            for k in missing:
                numbers[k] = new[words[k]]
        known = self.solved
        word = np.array(numbers, np.int64)
        known.uses.data[: known.uses.n] += np.bincount(word, minlength=known.uses.n)
        size = known.word_size.data[word]
        units = known.members.data[_ranges(known.word_first.data[word], size)]
        ends = np.concatenate([[0], np.cumsum(size)])[np.cumsum([0, *map(len, split)])]
        return units, np.diff(ends)

    def _forget(self) -> None:
        """Beyond the bound only the words used most stay, and are solved again."""
        old = self.solved
        if max(len(old.words), len(old.parts), old.score.n // 2, old.ids.n // 8) > KEPT_WORDS:
            uses = old.uses.data
            often = sorted([w for w, k in old.words.items() if uses[k] > 2], key=lambda w: -uses[old.words[w]])[:SURVIVORS]
            self.solved = _Solved()
            self._learn(dict.fromkeys(often))

    def _learn(self, words: dict[str, int | None]) -> None:
        """Cut new words where no piece can cross, solve the parts that are new, and number the words."""
        if not words:
            return
        known = self.solved
        joined = SPACE + SPACE.join(words)
        points = np.frombuffer(joined.encode("utf-32-le"), "<u4").astype(np.int64)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        pair = (points[:-1] << 21) | points[1:]
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        cut = np.append(self.pairs[at] != pair, True) if len(self.pairs) else np.ones(len(points), bool)
        cut[ends - 1] = True
        stops = np.flatnonzero(cut) + 1
        places = stops.tolist()
        parts = [joined[i:j] for i, j in zip([0, *places], places, strict=False)]
        last = np.searchsorted(stops, ends, side="right")
        size = np.diff(last, prepend=0)

        # a part that is a whole word is new with it, others may be known
        numbers: list[int | None] = [None] * len(parts)
        shared = np.flatnonzero(np.repeat(size > 1, size)).tolist()
        new = dict.fromkeys([parts[k] for k in shared])
        for part in new:
            new[part] = known.parts.get(part)
        fresh = [part for part, number in new.items() if number is None]
        new.update(zip(fresh, range(known.score.n, known.score.n + len(fresh)), strict=True))
        for k in shared:
            numbers[k] = new[parts[k]]
        whole = np.flatnonzero(np.repeat(size == 1, size)).tolist()
        for k, number in zip(whole, range(known.score.n + len(fresh), known.score.n + len(fresh) + len(whole)), strict=True):
            numbers[k] = number
        known.parts.update({p: new[p] for p in fresh if len(p) <= KEPT_LENGTH})
        texts = fresh + [parts[k] for k in whole]
        score, gap, first, length, ids = self._solve(texts)
        known.first.add(first + known.ids.n)
        for kept, more in ((known.score, score), (known.gap, gap), (known.size, length), (known.ids, ids)):
            kept.add(more)
        known.texts += texts

        number = known.word_first.n
        words.update(zip(words, range(number, number + len(words)), strict=True))
        known.words.update({w: k for w, k in words.items() if len(w) <= KEPT_LENGTH})
        known.word_first.add(known.members.n + last - size)
        known.word_size.add(size)
        known.uses.add(np.zeros(len(words), np.int64))
        known.members.add(np.array(numbers, np.int64))

    def solve_all(self, texts: list[str]) -> list[Unit]:
        """``solve`` for many texts, the short ones together."""
        score, gap, first, size, ids = self._solve(texts)
        return [Unit(ids[i : i + n].tobytes(), s, g) for s, g, i, n in zip(score.tolist(), gap.tolist(), first.tolist(), size.tolist(), strict=True)]

    def _solve(self, texts: list[str]) -> tuple[np.ndarray, ...]:
        """Score, gap, first id and number of ids of each text, and the ids."""
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        score, gap = np.zeros(len(texts)), np.zeros(len(texts))
        first, size = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        order = np.argsort(-sizes, kind="stable")
        at = int(np.searchsorted(-sizes[order], -SHORT))
        alone, found, held = order[:at].tolist(), [np.zeros(0, np.uint32)], 0
        while at < len(order):
            some = order[at : at + max(1, PLACES // max(1, int(sizes[order[at]])))]
            at += len(some)
            ok, score[some], gap[some], ids, n = self._solve_short([texts[k] for k in some.tolist()], sizes[some])
            alone += some[~ok].tolist()
            first[some], size[some] = held + np.cumsum(n) - n, n
            found.append(ids)
            held += len(ids)
        for k in alone:
            unit = self.solve(texts[k])
            ids = np.frombuffer(unit.ids, np.uint32)
            score[k], gap[k], first[k], size[k] = unit.score, unit.gap, held, len(ids)
            found.append(ids)
            held += len(ids)
        return score, gap, first, size, np.concatenate(found)

    def _solve_short(self, texts: list[str], sizes: np.ndarray) -> tuple[np.ndarray, ...]:
        """Both passes over texts of falling sizes, place by place for all texts; not ok is a text with an uncovered character."""
        n, width = len(texts), int(sizes[0])
        inside = np.arange(width)[:, None] < sizes
        points = np.zeros((n, width), np.uint64)
        points[inside.T] = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4")
        flat = points.T.ravel()  # place by place: a step of n is the next character

        # score and id of the piece of each length from each place
        alive = np.flatnonzero(inside)
        key = np.zeros(len(alive), np.uint64)
        scores, idents = [], []
        while len(alive):
            key = _mix(key, flat[alive + len(scores) * n])
            found, value, ident = self.table.look(key)
            piece = found & (ident >= 0)
            scores.append(np.full(width * n, -np.inf))
            idents.append(np.zeros(width * n, np.uint32))
            scores[-1][alive[piece]] = value[piece]
            idents[-1][alive[piece]] = ident[piece]
            on = alive + len(scores) * n
            found &= on < width * n
            found[found] = inside.ravel()[on[found]]
            alive, key = alive[found], key[found]
        longest = len(scores)
        score = np.stack(scores).reshape(longest, width, n)
        ok = ((score[0] > -np.inf) | ~inside).all(axis=0)

        ahead = np.full((width + 1, n), -np.inf)
        ahead[0] = 0
        by = np.zeros((width + 1, n), np.int64)
        for j in range(1, width + 1):
            m = int(np.searchsorted(-sizes, -j, side="right"))
            for length in range(min(j, longest), 0, -1):  # a tie goes to the longer last piece
                total = ahead[j - length, :m] + score[length - 1, j - length, :m]
                better = total > ahead[j, :m]
                np.copyto(ahead[j, :m], total, where=better)
                np.copyto(by[j, :m], length, where=better)
        back = np.full((width + 1, n), -np.inf)
        back[sizes, np.arange(n)] = 0
        for i in range(width - 1, -1, -1):
            for length in range(1, min(longest, width - i) + 1):
                np.maximum(back[i], score[length - 1, i] + back[i + length], out=back[i])

        # the best path from its end; its edges are taken out to find the second best
        ident = np.stack(idents).reshape(longest, width, n)
        at, text, path = sizes.copy(), np.flatnonzero(ok), []
        while len(text):
            length = by[at[text], text]
            at[text] -= length
            path.append((text, ident[length - 1, at[text], text]))
            score[length - 1, at[text], text] = -np.inf
            text = text[at[text] > 0]
        owner = np.concatenate([t for t, _ in path[::-1]]) if path else np.zeros(0, np.int64)
        ids = np.concatenate([i for _, i in path[::-1]]) if path else np.zeros(0, np.uint32)
        second = np.full(n, -np.inf)
        for length in range(1, longest + 1):
            through = ahead[: width + 1 - length] + (score[length - 1, : width + 1 - length] + back[length:])
            np.maximum(second, through.max(axis=0), out=second)
        best = np.where(ok, ahead[sizes, np.arange(n)], 0.0)
        return ok, best, best - second, ids[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=n)

    def ranked(self, unit: int, n_best: int) -> list[tuple[float, bytes]]:
        """The unit's own N best."""
        known = self.solved
        found = known.ranked.get(unit)
        if found is None or len(found) < n_best and known.gap.data[unit] != math.inf:
            found = known.ranked[unit] = self.search(known.texts[unit], n_best)
        return found[:n_best]

    def _combined(self, units: np.ndarray, ids: bytes, ends: np.ndarray, n_best: int) -> list[tuple[float, bytes]]:
        """The N best of a text from its units, the ids of its best path and where each unit's ids end in them."""
        gaps = self.solved.gap.data[units]
        total = float(self.solved.score.data[units].sum())
        few = min(n_best - 1, len(gaps))
        near: list[int] = []
        if few:
            low = np.flatnonzero((gaps <= np.partition(gaps, few - 1)[few - 1]) & (gaps != math.inf))
            near = sorted(low[np.lexsort((-low, gaps[low]))][:few].tolist())
        # (cost, changes): a change is a unit's place and its other ids
        best: list[tuple[float, tuple[int, ...], tuple]] = [(0.0, (), ())]
        for k in near:
            options = self.ranked(int(units[k]), n_best)
            top = options[0][0]
            grown = [(cost + top - score, (*ranks, r), (*changes, (k, ids)) if r else changes) for cost, ranks, changes in best for r, (score, ids) in enumerate(options)]
            best = sorted(grown, key=lambda x: x[:2])[:n_best]
        out = []
        for cost, _, changes in best:
            done, made = 0, []
            for k, other in changes:
                made += [ids[done : 4 * int(ends[k])], other]
                done = 4 * int(ends[k + 1])
            out.append((total - cost, b"".join([*made, ids[done:]])))
        return out

    def nbest(self, texts: list[str], n_best: int) -> list[list[tuple[float, bytes]]]:
        """The ``n_best`` segmentations of each text: score, and ids as native 32-bit integers."""
        out = []
        was = gc.isenabled()
        gc.disable()  # there are no cycles here, and walking over all words kept takes long
        try:
            for group in by_bytes(texts, GROUP):
                units, sizes = self.units_of(group)
                known = self.solved
                length = known.size.data[units]
                ids = known.ids.data[_ranges(known.first.data[units], length)]
                ends = np.concatenate([[0], np.cumsum(length)])
                stops = np.cumsum(sizes).tolist()
                for i, j in zip([0, *stops], stops, strict=False):
                    start, stop = int(ends[i]), int(ends[j])
                    out.append(self._combined(units[i:j], ids[start:stop].tobytes(), ends[i : j + 1] - start, n_best))
        finally:
            if was:
                gc.enable()
        return out

    def same_text(self, a: np.ndarray, b: np.ndarray) -> bool:
        """Whether both decode to one text; only what lies between equal ends is decoded."""
        head = _common(a, b)
        tail = _common(a[head:][::-1], b[head:][::-1])
        left, right = (b"".join(map(self.surface.__getitem__, x[head : len(x) - tail].tolist())) for x in (a, b))
        return left == right

    def decode(self, ids: np.ndarray | list[int]) -> str:
        """The text of the ids; the space before the first word is taken off."""
        raw = b"".join(map(self.surface.__getitem__, ids.tolist() if isinstance(ids, np.ndarray) else ids))
        return raw.removeprefix(b" ").decode(errors="replace")


def _ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``size`` numbers from each ``first`` on, one range after the other."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - ends + size, size)


def _parts(edges: np.ndarray) -> Iterator[np.ndarray]:
    return (edges[k : k + WALKED] for k in range(0, len(edges), WALKED))


def _way(last: np.ndarray, at: int) -> np.ndarray:
    """Places of the best path from ``at`` back to the start."""
    places, before = [at], memoryview(last)
    while at:
        at = before[at]
        places.append(at)
    return np.array(places, np.int64)


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """How many ids are equal from the start."""
    n = min(len(a), len(b))
    other = np.flatnonzero(a[:n] != b[:n])
    return int(other[0]) if len(other) else n


def _mix(key: np.ndarray, point: np.ndarray) -> np.ndarray:
    key = (key ^ point) * np.uint64(0x9E3779B97F4A7C15)
    return key ^ (key >> np.uint64(31))


class _Table:
    """Hash table of the beginnings of all pieces: score and id where a beginning is a piece, else id -1."""

    BITS = 20

    def __init__(self, starts: set[str], pieces: dict[str, tuple[int, float]]):
        texts = sorted(starts)
        keys = np.zeros(len(texts), np.uint64)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        first = np.cumsum(sizes) - sizes
        points = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4").astype(np.uint64)
        for j in range(int(sizes.max(initial=0))):
            longer = np.flatnonzero(sizes > j)
            keys[longer] = _mix(keys[longer], points[first[longer] + j])
        if len(np.unique(keys)) < len(keys):
            raise ValueError("two beginnings of pieces have one hash")
        self.keys = np.zeros(1 << self.BITS, np.uint64)
        self.place = np.full(1 << self.BITS, -1, np.int32)
        self.probes = 1
        for k, (key, slot) in enumerate(zip(keys.tolist(), (keys >> np.uint64(64 - self.BITS)).tolist(), strict=True)):
            probe = 0
            while self.place[(slot + probe) % (1 << self.BITS)] >= 0:
                probe += 1
            self.probes = max(self.probes, probe + 1)
            self.keys[(slot + probe) % (1 << self.BITS)] = key
            self.place[(slot + probe) % (1 << self.BITS)] = k
        self.scores = np.array([pieces[t][1] if t in pieces else 0.0 for t in texts])
        self.ids = np.array([pieces[t][0] if t in pieces else -1 for t in texts], np.int64)

    def look(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Whether each key is there, its score and its id."""
        slot = (key >> np.uint64(64 - self.BITS)).astype(np.int64)
        place = np.full(len(key), -1, np.int64)
        left = np.arange(len(key))
        for probe in range(self.probes):
            at = (slot[left] + probe) % (1 << self.BITS)
            there = self.place[at]
            hit = (there >= 0) & (self.keys[at] == key[left])
            place[left[hit]] = there[hit]
            left = left[~hit & (there >= 0)]
            if not len(left):
                break
        found = place >= 0
        return found, np.where(found, self.scores[place], 0.0), np.where(found, self.ids[place], -1)


def segmenter(path: str) -> Segmenter:
    return per_process(("segmenter", path), lambda: Segmenter(path))


def _given(docs: DataFrame, id_col: str, text: Column) -> tuple[DataFrame, str]:
    return docs.select(F.col(id_col).alias("doc_id"), text.alias("text")), docs.schema[id_col].dataType.simpleString()


def encode_nbest(docs: DataFrame, path: str, n_best: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``rank`` (from 0), ``score`` and ``ids`` of the best segmentations of every row."""
    given, kind = _given(docs, id_col, whole_text(text_col))

    def encode(batch: pa.RecordBatch) -> dict:
        best = segmenter(path).nbest(batch.column("text").to_pylist(), n_best)
        found = [(k, r, score, np.frombuffer(ids, np.uint32)) for k, some in enumerate(best) for r, (score, ids) in enumerate(some)]
        rows, ranks, scores, ids = zip(*found, strict=True) if found else ((), (), (), ())
        return {"doc_id": batch.column("doc_id").take(pa.array(rows, pa.int64())), "rank": ranks, "score": scores, "ids": ids}

    return map_batches(given, encode, f"doc_id {kind}, rank int, score double, ids array<int>")


def decode_ids(encoded: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """All columns and ``text``; null for null ids."""
    names = [c for c in encoded.columns if c != "text"]
    given = encoded.select(*names)

    def decode(batch: pa.RecordBatch) -> dict:
        model = segmenter(path)
        texts = [None if ids is None else model.decode(ids) for ids in batch.column(ids_col).to_pylist()]
        return {c: batch.column(c) for c in names} | {"text": texts}

    kind = given.withColumn("text", F.lit("")).schema
    return map_batches(given, decode, kind)


def nbest_digests(docs: DataFrame, path: str, n_best: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``encode_nbest`` with ``n_tokens`` and ``ids_crc32`` (little-endian unsigned 32 bits) for the ids, and whether decoding gives the text back."""
    given, kind = _given(docs, id_col, whole_text(text_col))

    def encode(batch: pa.RecordBatch) -> dict:
        model = segmenter(path)
        out: dict[str, list] = {c: [] for c in ("row", "rank", "score", "n_tokens", "ids_crc32", "round_trip")}
        texts = batch.column("text").to_pylist()
        for k, (text, best) in enumerate(zip(texts, model.nbest(texts, n_best), strict=True)):
            first = np.frombuffer(best[0][1], np.uint32)
            same = model.decode(first) == text.replace(SPACE, " ")
            for r, (score, ids) in enumerate(best):
                numbers = np.frombuffer(ids, np.uint32)
                row = (k, r, score, len(numbers), zlib.crc32(numbers.astype("<u4", copy=False)), same and (r == 0 or model.same_text(first, numbers)))
                for c, x in zip(out, row, strict=True):
                    out[c].append(x)
        out["doc_id"] = batch.column("doc_id").take(pa.array(out.pop("row"), pa.int64()))
        return out

    return map_batches(given, encode, f"doc_id {kind}, rank int, score double, n_tokens bigint, ids_crc32 bigint, round_trip boolean")

"""The most similar texts of a block, found exactly: bounds that no similarity can exceed decide which pairs are aligned.

Bounds, from cheap to dear: the letters two texts have in common (as bit sets, for a whole block at once), their longest
common subsequence (bit-parallel, for all texts left at once), and what an alignment can still reach while it runs. A pair
is left out only where its bound is below the best score found so far, so the best one is the same as by trying all.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import lru_cache

import numpy as np
import pandas as pd

#: Bits of a set of letters; the most frequent (letter, how many) of a block have one each, all others share them.
BITS = 320
#: The junk heuristic of the similarity begins at so many characters; such texts are aligned by the library itself.
JUNK = 200
#: So many pairs left are aligned at once, more are bounded by their common subsequence before.
FEW = 6
SLACK = 1e-9


@lru_cache(maxsize=20_000)
def _repeated(rows: int, stride: int) -> int:
    return sum(1 << i * stride for i in range(rows))


def ratio(a: str, b: str, least: float = 0.0) -> float:
    """The Ratcliff-Obershelp similarity of two strings with the junk heuristic where it is at least ``least``, else 0."""
    n, m = len(a), len(b)
    if a == b:
        return 1.0
    if not n or not m:
        return 0.0
    if m >= JUNK:
        r = SequenceMatcher(None, a, b).ratio()
        return r if r >= least else 0.0
    need = least * (n + m) / 2 - SLACK
    # a table of equal letters, one row of bits for each letter of a, with a free column at the end of each
    width = m // 8 + 1
    stride = 8 * width
    masks: dict[str, int] = {}
    for j, c in enumerate(b):
        masks[c] = masks.get(c, 0) | 1 << j
    none = bytes(width)
    rows = {c: masks[c].to_bytes(width, "little") if c in masks else none for c in set(a)}
    table = int.from_bytes(b"".join([rows[c] for c in a]), "little")
    every = _repeated(n, stride)
    done, bound, todo = 0, min(n, m), [(0, n, 0, m)]
    while todo:
        alo, ahi, blo, bhi = todo.pop()
        bound -= min(ahi - alo, bhi - blo)
        here = table >> alo * stride & ((1 << (ahi - alo) * stride) - 1)
        if blo or bhi < m:
            here &= ((1 << bhi) - (1 << blo)) * every
        size, runs, last = 0, here, 0
        while runs:
            last = runs
            size += 1
            runs = here & runs << stride + 1
        if not size:
            if done + bound < need:
                return 0.0
            continue
        # the longest run that begins first in a, then in b
        i, j = divmod((last & -last).bit_length() - 1, stride)
        done += size
        for part in ((alo, alo + i + 1 - size, blo, j + 1 - size), (alo + i + 1, ahi, j + 1, bhi)):
            if part[0] < part[1] and part[2] < part[3]:
                todo.append(part)
                bound += min(part[1] - part[0], part[3] - part[2])
        if done + bound < need:
            return 0.0
    r = 2.0 * done / (n + m)
    return r if r >= least else 0.0


class Texts:
    """Texts of a block, null ones as empty, ready for bounds on their similarity to another text."""

    def __init__(self, texts: list[str]) -> None:
        self.texts = texts
        self.length = np.array([len(t) for t in texts], dtype=np.int64)
        letters = Counter(c for t in texts for c in t)
        self.code = {c: i + 1 for i, (c, _) in enumerate(letters.most_common())}
        items = [self._items(t) for t in texts]
        self.bit = {x: k % BITS for k, (x, _) in enumerate(Counter(x for own in items for x in own).most_common())}
        self.sets = np.zeros((BITS // 64, len(texts)), dtype=np.uint64)
        for row, own in enumerate(items):
            self.sets[:, row] = self._set(own)
        self.spare = self.length - np.bitwise_count(self.sets).sum(axis=0, dtype=np.int64)
        self.codes: np.ndarray | None = None

    @staticmethod
    def _items(text: str) -> list[tuple[str, int]]:
        return [(c, k) for c, n in Counter(text).items() for k in range(n)]

    def _set(self, items: list[tuple[str, int]]) -> np.ndarray:
        held = 0
        for x in items:
            k = self.bit.get(x)
            if k is not None:
                held |= 1 << k
        return np.frombuffer(held.to_bytes(BITS // 8, "little"), dtype=np.uint64)

    def by_letters(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """(a bound on the similarity of ``text`` to each text, whether one of the two may stand in the other)."""
        own = self._items(text)
        known = [x for x in own if x in self.bit]
        held = self._set(known)
        both = np.zeros(len(self.texts), dtype=np.int64)
        for word, bits in zip(held, self.sets, strict=True):
            if word:
                both += np.bitwise_count(bits & word)
        size = int(np.bitwise_count(held).sum())
        # a bit that only one of them has is a letter that the other lacks
        most = both + np.minimum(len(known) - size, self.spare)
        inside = (both == size) | (self.spare + both == self.length)
        return 2.0 * most / np.maximum(1, self.length + len(text)), inside

    def by_subsequence(self, text: str, at: np.ndarray) -> np.ndarray:
        """A bound on the similarity of ``text`` to the texts at these places, from the longest common subsequence."""
        if self.codes is None:  # one text after the other, so that a long one takes no more than its own room
            self.codes = np.array([min(self.code[c], 65535) for t in self.texts for c in t], dtype=np.uint16)
            self.starts = np.cumsum(self.length) - self.length
        n = len(text)
        words = max(1, -(-n // 64))
        masks = np.zeros((words, min(len(self.code), 65535) + 1), dtype=np.uint64)
        for i, c in enumerate(text):
            k = self.code.get(c)
            if k is not None:
                masks[i // 64, min(k, 65535)] |= np.uint64(1 << i % 64)
        order = np.argsort(-self.length[at], kind="stable")  # the texts that have ended are left out of each step
        lengths, starts = self.length[at][order], self.starts[at][order]
        alive = np.searchsorted(-lengths, -np.arange(int(lengths[0]) if len(at) else 0), side="left")
        state = np.full((words, len(at)), np.uint64(0xFFFFFFFFFFFFFFFF))
        for step, live in enumerate(alive.tolist()):
            own, carry = self.codes[starts[:live] + step], None
            for k in range(words):
                v = state[k, :live]
                u = v & masks[k][own]
                s = v + u
                over = s < v
                if carry is not None:
                    s += carry
                    over |= s < carry
                if k + 1 < words:
                    carry = over.astype(np.uint64)
                state[k, :live] = s | (v - u)
        if n % 64:
            state[-1] |= np.uint64(0xFFFFFFFFFFFFFFFF << n % 64 & 0xFFFFFFFFFFFFFFFF)
        common = np.empty(len(at), dtype=np.int64)
        common[order] = 64 * words - np.bitwise_count(state).sum(axis=0, dtype=np.int64)
        return 2.0 * common / np.maximum(1, self.length[at] + n)


class Words:
    """Which texts of a block hold a word."""

    def __init__(self, lists: list[str | None]) -> None:
        held: dict[str, list[int]] = {}
        for row, own in enumerate(lists):
            for w in own.split(" ") if own else ():
                held.setdefault(w, []).append(row)
        self.n, self.held = len(lists), {w: np.array(x) for w, x in held.items()}

    def overlap(self, words: str | None) -> np.ndarray:
        """The share of these different words that each text has; 0 without words."""
        out = np.zeros(self.n)
        own = words.split(" ") if words else []
        for w in own:
            if w in self.held:
                out[self.held[w]] += 1
        return out / len(own) if own else out


class Best:
    """The best candidate of one text: the highest score, then the smallest URL."""

    def __init__(self, least: float) -> None:
        self.score, self.url = least, None

    def offer(self, score: float, url: str) -> None:
        if score > self.score or score == self.score and (self.url is None or url < self.url):
            self.score, self.url = score, url


def _null(x: object) -> bool:
    return x is None or x != x


def _listed(column: pd.Series) -> list[str | None]:
    return [None if _null(x) else x for x in column]


def by_path(least: float, contained: float):  # noqa: ANN201
    """A function of two frames, (raw_url, p, hl, hw) and (url, q, title, tw): (raw_url, url, score) of the best by path and title."""

    def find(_: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            known, paths, titles = list(right["url"]), Texts(list(right["q"])), _listed(right["title"])
            heads, words = Texts([t or "" for t in titles]), Words(_listed(right["tw"]))
            titled = np.array([t is not None for t in titles])

            def refined(rows: np.ndarray, p: str, hl: str | None, at: np.ndarray, inside: np.ndarray, share: np.ndarray | None) -> np.ndarray:
                bound = paths.by_subsequence(p, at[rows])
                bound = np.where(inside[rows], np.maximum(bound, contained), bound)
                if hl is None:
                    return bound
                ok = np.flatnonzero(bound >= least - SLACK)  # titles count only for these
                own = np.ones(len(rows))
                most = np.minimum(1.0, np.maximum(heads.by_subsequence(hl, at[rows][ok]), share[at[rows][ok]]))
                own[ok] = np.where(titled[at[rows][ok]], 0.55 + 0.45 * most, 1.0)
                return bound * own

            for raw, p, hl, hw in zip(left["raw_url"], left["p"], _listed(left["hl"]), _listed(left["hw"]), strict=True):
                best = Best(least)
                bound, inside = paths.by_letters(p)
                bound = np.where(inside, np.maximum(bound, contained), bound)
                at = np.flatnonzero(bound >= least - SLACK)
                bound, inside = bound[at], inside[at]
                share = None
                factor = np.ones(len(at))
                if hl is not None and len(at):
                    share = 0.7 * words.overlap(hw)
                    most = np.minimum(1.0, np.maximum(heads.by_letters(hl)[0][at], share[at]))
                    factor = np.where(titled[at], 0.55 + 0.45 * most, 1.0)

                def tried(row: int, p=p, hl=hl, share=share, best=best) -> None:
                    q, title, full = paths.texts[row], titles[row], 1.0
                    within = p in q or q in p
                    if hl is not None and title is not None:
                        # the path is aligned first, but only as far as the best titles could still help it
                        top = ratio(p, q, least if within else max(least, best.score))
                        score = max(top, contained) if within else top
                        if score < max(least, best.score):
                            return
                        full = 0.55 + 0.45 * max(ratio(hl, title), float(share[row]))
                    else:
                        top = ratio(p, q, least)
                        score = max(top, contained) if within else top
                    if score >= least and (score := min(1.0, score * full)) >= least:
                        best.offer(score, known[row])

                search(at, bound * factor, best, tried, lambda rows, p=p, hl=hl, at=at, inside=inside, share=share: refined(rows, p, hl, at, inside, share))
                if best.url is not None:
                    out.append((raw, best.url, best.score))
        return pd.DataFrame(out, columns=["raw_url", "url", "score"])

    return find


def by_title(least: float):  # noqa: ANN201
    """A function of two frames, (raw_url, hl, hw) and (url, title, tw): (raw_url, url, score) of the best by title."""

    def find(_: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            known, heads, words = list(right["url"]), Texts(list(right["title"])), Words(_listed(right["tw"]))
            for raw, hl, hw in zip(left["raw_url"], left["hl"], _listed(left["hw"]), strict=True):
                best = Best(least)
                share = 0.7 * words.overlap(hw)
                bound = np.maximum(heads.by_letters(hl)[0], share)
                at = np.flatnonzero(bound >= least - SLACK)

                def tried(row: int, hl=hl, share=share, best=best) -> None:
                    score = max(ratio(hl, heads.texts[row], best.score), float(share[row]))
                    if score >= least:
                        best.offer(score, known[row])

                def refined(rows: np.ndarray, hl=hl, at=at, share=share) -> np.ndarray:
                    return np.maximum(heads.by_subsequence(hl, at[rows]), share[at[rows]])

                search(at, bound[at], best, tried, refined)
                if best.url is not None:
                    out.append((raw, best.url, best.score))
        return pd.DataFrame(out, columns=["raw_url", "url", "score"])

    return find


def search(at: np.ndarray, bound: np.ndarray, best: Best, tried, refined) -> None:  # noqa: ANN001
    """Try the rows ``at`` by falling bounds until none can reach the best; many of them are bounded anew before."""
    if not len(at):
        return
    first = int(bound.argmax())
    tried(int(at[first]))
    bound[first] = -1.0
    rows = np.flatnonzero(bound >= best.score - SLACK)
    limits = bound[rows]
    if len(rows) > FEW:
        limits = np.minimum(limits, refined(rows))
    for k in _falling(limits):
        if limits[k] < best.score - SLACK:
            break
        tried(int(at[rows[k]]))


def _falling(limits: np.ndarray) -> Iterator[int]:
    yield from np.argsort(-limits, kind="stable").tolist()

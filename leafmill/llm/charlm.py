"""Character n-gram language models with interpolated Kneser-Ney smoothing.

The n-grams of all languages lie in one sorted array of 64-bit hashes for each
order, with a row of log-probabilities by language beside it. A probability is
interpolated when the model is built, so that a text costs one search for each
character, and further ones only where an n-gram is unknown to every language.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import numpy as np

from .canon import tables

#: n-grams of up to so many characters.
ORDER = 4
_MIX, _STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(29)
_NOT_LETTERS = re.compile(r"(?<![^\W_])[^\W\d_]*+\d\w*|[\W\d_]+")
_LETTERS = re.compile(r"[^\W\d_]")


@lru_cache(1)
def _odd() -> tuple[re.Pattern, dict[int, str]]:
    table, marks = tables()
    # characters beyond the first plane would make the class a list; texts that have any are looked up
    first = "".join(c for c in [*table, *marks] if ord(c) < 0x10000)
    return re.compile(f"[{re.escape(first)}]|[\U00010000-\U0010FFFF]"), str.maketrans(table)


def plain(text: str) -> str:
    """Words in lower case with one space between; words that hold digits, and all signs, count as space. Characters that only look like others count as these."""
    odd, table = _odd()
    if odd.search(text):
        text = unicodedata.normalize("NFC", text.translate(table))
    return " " + _NOT_LETTERS.sub(" ", text.lower()).strip() + " "


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def _hashes(c: np.ndarray) -> list[np.ndarray]:
    """For each order n, the hashes of the n-grams that end at each position; the first ones run over the start and are shorter."""
    out, context = [], np.zeros(len(c), np.uint64)
    for _ in range(ORDER):
        h = (context * _MIX + c + np.uint64(1)) * _MIX
        h ^= h >> _STEP
        out.append(h)
        context = np.concatenate([[np.uint64(0)], h[:-1]])
    return out


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = 0
    return at, keys[at] == wanted


class Model:
    """Languages, and by order the sorted hashes with log-probabilities (n-grams) and log backoff weights (contexts)."""

    def __init__(self, languages: list[str], texts: dict[str, list[str]]):
        self.languages = languages
        width = len(languages)
        counts, contexts, links = [{} for _ in range(ORDER)], [{} for _ in range(ORDER)], {}
        for k, language in enumerate(languages):
            c = points("".join(map(plain, texts[language])))
            c = np.concatenate([np.full(1, 32, np.uint64), c])
            h = _hashes(c)
            raw, first, n = np.unique(h[-1], return_index=True, return_counts=True)
            for order in range(ORDER - 1, -1, -1):
                # the context of an n-gram and, one order down, the n-gram without its first character
                context = h[order - 1][first - 1] if order else np.zeros(len(raw), np.uint64)
                context[first == 0] = 0
                suffix = h[order - 1][first] if order else None
                counts[order][k] = (raw, n)
                links[order, k] = (raw, context, suffix)
                if order:
                    # lower orders count in how many contexts they stand
                    raw, at, n = np.unique(suffix, return_index=True, return_counts=True)
                    first = first[at]
        self.keys, self.logs, self.backs, self.back_keys = [], [], [], []
        below = None
        for order in range(ORDER):
            keys = np.unique(np.concatenate([counts[order][k][0] for k in range(width)]))
            context, suffix = np.zeros(len(keys), np.uint64), np.zeros(len(keys), np.uint64)
            for k in range(width):
                raw, c, s = links[order, k]
                at = np.searchsorted(keys, raw)
                context[at] = c
                if s is not None:
                    suffix[at] = s
            backs = np.unique(context)
            where = np.searchsorted(backs, context)
            if order:
                lower = below[np.searchsorted(self.keys[-1], suffix)]
            else:
                lower = np.full((len(keys), width), 1.0 / (len(keys) + 1))
            p, gamma = np.empty((len(keys), width)), np.ones((len(backs), width))
            for k in range(width):
                raw, n = counts[order][k]
                n1, n2 = int((n == 1).sum()), int((n == 2).sum())
                discount = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
                mine = np.zeros(len(keys))
                mine[np.searchsorted(keys, raw)] = n
                total = np.bincount(where, mine, len(backs))
                kinds = np.bincount(where, mine > 0, len(backs))
                seen = total > 0
                gamma[seen, k] = discount * kinds[seen] / total[seen]
                share = np.maximum(mine - discount, 0) / np.where(seen, total, 1)[where]
                p[:, k] = share + gamma[where, k] * lower[:, k]
            below = p
            self.keys.append(keys)
            self.logs.append(np.log(p).astype(np.float32))
            self.back_keys.append(backs)
            self.backs.append(np.log(gamma).astype(np.float32))
        self.unknown = np.float32(-np.log(len(self.keys[0]) + 1)) + self.backs[0][0]

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy in nats per character by language, and the number of characters, of plain texts."""
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        if not len(texts) or not lengths.sum():
            return np.zeros((len(texts), len(self.languages)), np.float32), lengths
        c = points("".join(texts))
        h = _hashes(c)
        out = np.zeros((len(c), len(self.languages)), np.float32)
        rest = np.arange(len(c))
        for order in range(ORDER - 1, -1, -1):
            at, hit = _find(self.keys[order], h[order][rest])
            out[rest[hit]] += self.logs[order][at[hit]]
            rest = rest[~hit]
            if not len(rest):
                break
            if order:
                context = np.where(rest > 0, h[order - 1][rest - 1], np.uint64(0))
                at, hit = _find(self.back_keys[order], context)
                out[rest[hit]] += self.backs[order][at[hit]]
            else:
                out[rest] += self.unknown
        sums = np.concatenate([np.zeros((1, out.shape[1])), np.cumsum(out, axis=0, dtype=np.float64)])
        ends = np.cumsum(lengths)
        total = sums[ends] - sums[ends - lengths]
        return (-total / np.maximum(lengths, 1)[:, None]).astype(np.float32), lengths


def letters(text: str) -> int:
    return len(_LETTERS.findall(text))

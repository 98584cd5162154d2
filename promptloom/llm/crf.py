"""A linear-chain conditional random field over word-shape features, in numpy."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np

TAGS = ("O", "email", "ip", "card", "phone")
_RUN = re.compile(r"a+|A+|9+|.", re.S)


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if k % 2:
            n = n * 2 - 9 if n > 4 else n * 2
        total += n
    return total % 10 == 0


def features(word: str) -> tuple[str, ...]:
    """Shape features of a word: its collapsed and its bounded shape, first and last character class, digits, the card checksum."""
    if word.rstrip(".,;:!?").isalpha():
        return ("letters",)
    digits = "".join(c for c in word if "0" <= c <= "9")
    kinds = "".join("9" if "0" <= c <= "9" else "A" if c.isupper() else "a" if c.isalpha() else c for c in (word if len(word) <= 60 else word[:40] + word[-20:]))
    runs = [m.group() for m in _RUN.finditer(kinds)]
    runs = runs if len(runs) <= 12 else runs[:8] + runs[-4:]
    n = len(digits)
    return (
        "short:" + "".join(r[0] for r in runs), "long:" + "".join(r[0] * min(len(r), 4) for r in runs), "first:" + kinds[0], "last:" + kinds[-1],
        "digits:" + ("0" if not n else "1-3" if n < 4 else "4" if n == 4 else "5-7" if n < 8 else "8-15" if n < 16 else "16-19" if n < 20 else "20+"),
        *(["at"] if "@" in word[1:-1] else []), *(["dots3"] if word.count(".") >= 3 else []), *(["luhn"] if 16 <= n <= 19 and luhn(digits) else []),
    )


@dataclass(frozen=True)
class Model:
    """Weights: of the word's own, the word before's and the word behind's features by tag, and of tag pairs."""

    names: dict[str, int]
    own: np.ndarray
    before: np.ndarray
    behind: np.ndarray
    pairs: np.ndarray

    def rows(self, word: str) -> np.ndarray:
        """The three tag vectors that a word contributes: to itself, to the word behind it and to the word before it."""
        at = [self.names[f] for f in features(word) if f in self.names]
        return np.stack([w[at].sum(axis=0) for w in (self.own, self.before, self.behind)]).astype(np.float32)


def _padded(sequences: list[list[int]], fill: int) -> np.ndarray:
    out = np.full((len(sequences), max(map(len, sequences))), fill, np.int64)
    for row, s in zip(out, sequences):
        row[: len(s)] = s
    return out


def train(sentences: list[tuple[list[str], list[int]]], steps: int = 80, rate: float = 0.15, penalty: float = 1e-4) -> Model:
    """Fit by gradient ascent with momentum scaling on the likelihood of the labelled sentences (words, tags)."""
    kinds: dict[tuple[str, ...], int] = {}
    coded = [[kinds.setdefault(features(w), len(kinds)) for w in words] for words, _ in sentences]
    names: dict[str, int] = {}
    for kind in kinds:
        for f in kind:
            names.setdefault(f, len(names))
    # One row per kind of word; the last row, of no word, is empty.
    hot = np.zeros((len(kinds) + 1, len(names)))
    for kind, k in kinds.items():
        hot[k, [names[f] for f in kind]] = 1
    none, n = len(kinds), len(TAGS)
    x, y = _padded(coded, none), _padded([tags for _, tags in sentences], 0)
    mask = x != none
    left = np.concatenate([np.full((len(x), 1), none), x[:, :-1]], 1)
    right = np.concatenate([x[:, 1:], np.full((len(x), 1), none)], 1)
    gold = np.eye(n)[y] * mask[:, :, None]
    linked = mask[:, 1:] & mask[:, :-1]
    gold_pairs = np.einsum("stk,stl->kl", gold[:, :-1], gold[:, 1:] * linked[:, :, None])
    weights = [np.zeros((len(names), n)) for _ in range(3)] + [np.zeros((n, n))]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for step in range(1, steps + 1):
        own, before, behind = (hot @ w for w in weights[:3])
        scores = own[x] + before[left] + behind[right]
        expected, expected_pairs = _expectations(scores, weights[3], mask, linked)
        error = (gold - expected) * mask[:, :, None]
        slopes = []
        for codes in (x, left, right):
            sums = np.zeros((len(kinds) + 1, n))
            np.add.at(sums, codes.ravel(), error.reshape(-1, n))
            slopes.append(hot.T @ sums)
        slopes.append(gold_pairs - expected_pairs)
        for k, slope in enumerate(slopes):
            slope = slope / len(x) - penalty * weights[k]
            first[k] = 0.9 * first[k] + 0.1 * slope
            second[k] = 0.99 * second[k] + 0.01 * slope**2
            weights[k] = weights[k] + rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
    return Model(names, *weights)


def _sum_exp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def _expectations(scores, pairs, mask, linked):
    """Tag marginals of every word and expected counts of tag pairs, by the forward and backward recursions."""
    count, length, n = scores.shape
    forward, backward = np.zeros_like(scores), np.zeros_like(scores)
    forward[:, 0] = scores[:, 0]
    for t in range(1, length):
        new = scores[:, t] + _sum_exp(forward[:, t - 1, :, None] + pairs, 1)
        forward[:, t] = np.where(mask[:, t, None], new, forward[:, t - 1])
    for t in range(length - 2, -1, -1):
        new = _sum_exp(pairs + (scores[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
        backward[:, t] = np.where(mask[:, t + 1, None], new, 0.0)
    total = _sum_exp(forward[:, -1], 1)
    marginal = np.exp(forward + backward - total[:, None, None]) * mask[:, :, None]
    joint = np.zeros((n, n))
    for t in range(1, length):
        p = forward[:, t - 1, :, None] + pairs + (scores[:, t] + backward[:, t])[:, None, :] - total[:, None, None]
        joint += (np.exp(np.minimum(p, 0)) * linked[:, t - 1, None, None]).sum(axis=0)
    return marginal, joint


def emissions(model: Model, table: np.ndarray, kinds: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Tag scores of the words of many texts laid end to end. ``table`` holds ``Model.rows`` per kind of word, ``ends`` the texts' ends."""
    scores = table[kinds, 0]
    if len(kinds) > 1:
        joined = np.ones(len(kinds) - 1, bool)
        inner = ends[(ends > 0) & (ends < len(kinds))]
        joined[inner - 1] = False
        scores[1:] += table[kinds[:-1], 1] * joined[:, None]
        scores[:-1] += table[kinds[1:], 2] * joined[:, None]
    return scores


def decode(model: Model, scores: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Most likely tags of texts laid end to end (Viterbi).

    A word whose score of tag O leads all others by more than twice the spread of the pair weights is O on the best path whatever
    stands around it. Such words cut the texts into short pieces, which are decoded side by side.
    """
    tags = np.zeros(len(scores), np.int64)
    if not len(scores):
        return tags
    pairs = model.pairs.astype(np.float32)
    spread = 2 * float(pairs.max() - pairs.min())
    open_ = scores[:, 0] - scores[:, 1:].max(axis=1) <= spread
    if not open_.any():
        return tags
    starts_text = np.zeros(len(scores), bool)
    starts_text[np.concatenate([[0], ends[ends < len(scores)]])] = True
    # A piece begins at an open word behind a closed one or at a text's beginning.
    begins = open_ & (starts_text | ~np.concatenate([[False], open_[:-1]]))
    at = np.flatnonzero(begins)
    group = np.cumsum(begins) - 1
    sizes = np.bincount(group[open_], minlength=len(at))
    for low in range(0, len(at), 4096):
        part, size = at[low : low + 4096], sizes[low : low + 4096]
        order = np.argsort(-size, kind="stable")
        part, size = part[order], size[order]
        # Closed neighbours within the text are O; at a text's edge nothing stands before or behind.
        after_edge = starts_text[part]
        last = part + size
        before_edge = (last >= len(scores)) | starts_text[np.minimum(last, len(scores) - 1)]
        state = scores[part] + np.where(after_edge[:, None], 0, pairs[0])
        best = [state]
        back = []
        for t in range(1, int(size[0])):
            live = int((size > t).sum())
            options = best[-1][:live, :, None] + pairs
            back.append(options.argmax(axis=1))
            best.append(options.max(axis=1) + scores[part[:live] + t])
        for t in range(int(size[0]) - 1, -1, -1):
            live, ended = int((size > t).sum()), int((size > t + 1).sum())
            now = np.empty(live, np.int64)
            final = best[t][ended:live] + np.where(before_edge[ended:live, None], 0, pairs[:, 0])
            now[ended:] = final.argmax(axis=1)
            if ended:
                now[:ended] = back[t][np.arange(ended), following[:ended]]
            tags[part[:live] + t] = now
            following = now
    return tags

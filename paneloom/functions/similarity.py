"""Similarity of strings by their longest common subsequence.

The subsequence lengths of many pairs are computed at once with bit vectors
(Hyyro 2004): a text is a row of machine words, whose carries run from word to word,
so texts of any length take the same path.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property, lru_cache
from itertools import combinations
from math import ceil, comb

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

#: Characters compared at once, which bounds the memory.
_CELLS = 1 << 22
#: Buckets that characters are counted in for the bound on what two texts share.
_BUCKETS = 32
#: Most promising partners that are compared before the others.
_FIRST = 8
#: Longest text that walks down trees, texts that walk together, states of a step, texts on a side of a comparison by pairs.
_LONG, _ASKED, _STATES, _PAIRED = 256, 512, 1 << 16, 1_024
#: Edits above which characters are counted before a walk, texts that this is done for at once, and cells that it may take.
_NEAR, _COUNTED, _LADDER = 4, 64, 1 << 25
#: Pairs that a walk compares in the time of one subsequence: up to so many edits, and beyond. Subsequences that are listed at once.
_WALKED, _LISTED = (16, 1), 1 << 23


def characters(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def code_matrix(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points plus one, a row per text, padded with zeros; and the lengths."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    matrix = np.zeros((len(texts), max(1, lengths.max(initial=0))), np.uint32)
    flat = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    matrix[np.arange(matrix.shape[1]) < lengths[:, None]] = flat + 1
    return matrix, lengths


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Longest common subsequence of each row of ``a`` with the same row of ``b``."""
    words = -(-a.shape[1] // 64)
    b = np.where(b == 0, 0xFFFFFFFF, b)  # padding equals no character
    state = np.full((words, len(a)), 2**64 - 1, np.uint64)
    bits = np.zeros((len(a), 8 * words), np.uint8)
    used = (a.shape[1] + 7) // 8
    for column in b.T:
        bits[:, :used] = np.packbits(a == column[:, None], axis=1, bitorder="little")
        matches = bits.view("<u8")
        carry = np.zeros(len(a), np.uint64)
        for word, before in enumerate(state):
            common = before & matches[:, word]
            once = before + common
            total = once + carry
            carry = ((once < before) | (total < once)).astype(np.uint64)
            state[word] = total | (before - common)
    return np.bitwise_count(~state).sum(axis=0, dtype=np.int64)


def pair_lengths(a: np.ndarray, a_sizes: np.ndarray, b: np.ndarray, b_sizes: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Longest common subsequence of the texts i of one code matrix with the texts j of the other."""
    result = np.zeros(len(i), np.int64)
    widths = np.maximum(a_sizes[i], b_sizes[j])
    order = np.argsort(widths, kind="stable")
    at = 0
    while at < len(order):
        # Pairs of like width go together; the widest of a chunk decides how many.
        end = min(len(order), at + max(1, _CELLS // max(1, int(widths[order[at]]))))
        while end > at + 1 and (end - at) * int(widths[order[end - 1]]) > 2 * _CELLS:
            end = at + (end - at) // 2
        part = order[at:end]
        wide = max(1, int(a_sizes[i[part]].max())), max(1, int(b_sizes[j[part]].max()))
        result[part] = _common(a[i[part], : wide[0]], b[j[part], : wide[1]])
        at = end
    return result


def common_lengths(left: Sequence[str], right: Sequence[str]) -> np.ndarray:
    """Longest common subsequence of each pair."""
    every = np.arange(len(left))
    return pair_lengths(*code_matrix(left), *code_matrix(right), every, every).astype(np.int32)


def _bags(codes: np.ndarray, size: int) -> np.ndarray:
    """Characters of each text in each bucket (bucket x text)."""
    row, place = np.nonzero(codes)
    bucket = codes[row, place].astype(np.int64) % _BUCKETS
    return np.bincount(bucket * size + row, minlength=_BUCKETS * size).reshape(_BUCKETS, size).astype(np.int32)


def _best_of_long(left: Sequence[str], right: Sequence[str], threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, score) as ``best_of_each``, pair by pair.

    Characters that two texts share regardless of order bound the similarity; only pairs
    whose bound reaches the threshold, and the best found so far, are compared.
    """
    a, a_sizes = code_matrix(left)
    b, b_sizes = code_matrix(right)
    a_bags, b_bags = _bags(a, len(left)), _bags(b, len(right))
    shared = np.zeros((len(left), len(right)), np.int32)
    for mine, other in zip(a_bags, b_bags, strict=True):
        shared += np.minimum(mine[:, None], other[None, :])
    total = a_sizes[:, None] + b_sizes[None, :]
    bound = 200.0 * shared / np.maximum(total, 1)
    i, j = np.nonzero((bound >= threshold) & (total > 0))
    bounds = bound[i, j]
    order = np.lexsort((j, -bounds, i))
    i, j, bounds = i[order], j[order], bounds[order]
    rank = np.arange(len(i)) - np.searchsorted(i, i)
    best = np.full(len(left), float(threshold))
    score = np.full(len(i), -1.0)
    for wave in (rank < _FIRST, rank >= _FIRST):
        todo = np.flatnonzero(wave & (bounds >= best[i]))
        score[todo] = 200.0 * pair_lengths(a, a_sizes, b, b_sizes, i[todo], j[todo]) / total[i[todo], j[todo]]
        np.maximum.at(best, i[todo], score[todo])
    good = np.flatnonzero(score >= threshold)
    return _firsts(i[good], j[good], score[good])


def _firsts(i: np.ndarray, j: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each i the pair of the highest score, the smallest j of equals."""
    order = np.lexsort((j, -score, i))
    i, j, score = i[order], j[order], score[order]
    first = np.ones(len(i), bool)
    first[1:] = i[1:] != i[:-1]
    return i[first], j[first], score[first]


class _Tree:
    """The prefixes of texts of one length: what texts with a common prefix share is compared once."""

    def __init__(self, texts: Sequence[str], own: Sequence[int]) -> None:
        order = sorted(own, key=texts.__getitem__)  # stable: of equal texts the first stays
        codes, _ = code_matrix([texts[n] for n in order])
        apart = codes[1:] != codes[:-1]
        shared = np.where(apart.any(axis=1), apart.argmax(axis=1), codes.shape[1])
        self.length = codes.shape[1]
        starts = [np.flatnonzero(np.concatenate(([True], shared < depth))) for depth in range(self.length + 1)]
        self.member = np.array(order, np.int64)[starts[-1]]
        #: Per depth: the character of every node, and where the nodes below those of the depth before begin.
        self.letters = [codes[at, depth] for depth, at in enumerate(starts[1:])]
        self.below = [np.append(np.searchsorted(b, a), len(b)) for a, b in zip(starts, starts[1:], strict=False)]
        #: Per depth: where the texts below every node begin.
        self.span = [np.append(np.searchsorted(starts[-1], at), len(starts[-1])) for at in starts]
        self.texts = codes[starts[-1]]
        self.bags = _bags(self.texts, len(self.texts))

    @cached_property
    def spelled(self) -> tuple[np.ndarray, np.ndarray]:
        """The alphabet of the texts, and their letters as places in it."""
        alphabet, letter = np.unique(self.texts, return_inverse=True)
        return alphabet, letter.reshape(self.texts.shape).astype(np.int64)


def _may_share(bags: np.ndarray, tree: _Tree, need: np.ndarray) -> np.ndarray | None:
    """For each text (a column of ``bags``), how many texts of the tree before each place share as many characters as needed, in any order.

    None if that took too much memory. Counts are written as rungs of a ladder, so that a product of matrices sums the lesser of both.
    """
    rungs = [(n, step) for n in range(_BUCKETS) for step in range(1, min(bags[n].max(), tree.bags[n].max()) + 1)]
    if not rungs or max(len(rungs), bags.shape[1]) * len(tree.member) > _LADDER:
        return None
    bucket, step = np.array(rungs).T
    climbed = [(own[bucket] >= step[:, None]).astype(np.float32) for own in (bags, tree.bags)]
    before = np.zeros((bags.shape[1], len(tree.member) + 1), np.int32)
    np.cumsum(climbed[0].T @ climbed[1] >= need[:, None], axis=1, out=before[:, 1:])
    return before


class _Asked:
    """Texts of at most so many machine words, as bits of the places of each character."""

    def __init__(self, texts: Sequence[str]) -> None:
        codes, self.sizes = code_matrix(texts)
        self.bags = _bags(codes, len(texts))
        row, place = np.nonzero(codes)
        self.alphabet, letter = np.unique(codes[row, place], return_inverse=True)
        words = -(-codes.shape[1] // 64)
        # The last letter stands for all that no text has.
        self.places = np.zeros((words, len(texts), len(self.alphabet) + 1), np.uint64)
        np.bitwise_or.at(self.places, (place // 64, row, letter), np.uint64(1) << (place % 64).astype(np.uint64))

    def letters(self, codes: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.alphabet, codes), len(self.alphabet) - 1)
        return np.where(self.alphabet[at] == codes, at, len(self.alphabet))


_LOW = np.array([(1 << n) - 1 for n in range(65)], np.uint64)


def _in_tree(asked: _Asked, tree: _Tree, least: np.ndarray, far: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, score) of pairs that reach ``least``, among them the best of each text; ``least`` rises to the scores found.

    A text and a prefix end if what they share so far, and all that is left of both, is too little. With ``far`` they also end
    if no text with that prefix has enough of the characters.
    """
    letters = [asked.letters(codes) for codes in tree.letters]
    total = asked.sizes + tree.length
    need = np.ceil(least * total / 200.0 - 1e-9).astype(np.int64)
    start = np.flatnonzero(need <= np.minimum(asked.sizes, tree.length))
    words = len(asked.places)
    found, open_parts = [], []
    size = _COUNTED if far else max(1, len(start))
    for at in range(0, len(start), size):
        part = start[at : at + size]
        state = np.full((words, len(part)), 2**64 - 1, np.uint64)
        open_parts.append((0, part, np.zeros(len(part), np.int64), state))
    place, before = np.zeros(len(least), np.int64), None
    while open_parts:
        depth, row, node, state = open_parts.pop()
        if far and not depth and len(node):
            place[row] = np.arange(len(row))
            before = _may_share(asked.bags[:, row], tree, need[row])
        first = tree.below[depth][node]
        many = tree.below[depth][node + 1] - first
        ends = np.cumsum(many)
        if len(row) > 1 and ends[-1] > _STATES:
            cut = min(max(1, int(np.searchsorted(ends, _STATES))), len(row) - 1)
            open_parts.append((depth, row[cut:], node[cut:], state[:, cut:]))
            row, first, many, state, ends = row[:cut], first[:cut], many[:cut], state[:, :cut], ends[:cut]
        if not len(row):
            continue
        parent = np.repeat(np.arange(len(row)), many)
        node = np.arange(len(parent)) + (first - ends + many)[parent]
        row = row[parent]
        if before is not None:
            span = tree.span[depth + 1]
            open_nodes = np.flatnonzero(before[place[row], span[node + 1]] > before[place[row], span[node]])
            parent, node, row = parent[open_nodes], node[open_nodes], row[open_nodes]
        letter = letters[depth][node]
        left = tree.length - depth - 1
        upto = np.maximum(asked.sizes[row] - left, 0)
        common = np.minimum(asked.sizes[row], left)
        after = np.empty((words, len(row)), np.uint64)
        carry = np.zeros(len(row), np.uint64)
        for word in range(words):
            old = state[word, parent]
            matches = old & asked.places[word, row, letter]
            once = old + matches
            if words > 1:
                sums = once + carry
                carry = ((once < old) | (sums < once)).astype(np.uint64)
                once = sums
            after[word] = once | (old - matches)
            common += np.bitwise_count(~after[word] & _LOW[np.clip(upto - 64 * word, 0, 64)])
        if left:
            kept = np.flatnonzero(common >= need[row])
            if len(kept):
                open_parts.append((depth + 1, row[kept], node[kept], after[:, kept]))
        else:
            score = 200.0 * common / total[row]
            kept = np.flatnonzero(score >= least[row])
            np.maximum.at(least, row[kept], score[kept])
            need = np.ceil(least * total / 200.0 - 1e-9).astype(np.int64)
            found.append((row[kept], tree.member[node[kept]], score[kept]))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    return _firsts(*(np.concatenate(part) for part in zip(*found, strict=True)))


def best_of_each(left: Sequence[str], right: Sequence[str], threshold: float, edits: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, score): of each left text the most similar right text, the first of equals, if it reaches the threshold.

    Texts walk down the trees of the right texts of each length. First only partners one deletion away are
    looked for, then two, four and so on; a text that has one is done, since all that is left is less similar. Trees whose lists of
    subsequences cost less than a walk are not walked. With ``edits`` only partners at least as similar as a text without so many of its characters count.
    """
    found = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
    sizes = np.fromiter(map(len, left), np.int64, len(left))
    lengths: dict[int, list[int]] = {}
    for j, text in enumerate(right):
        if text:
            lengths.setdefault(len(text), []).append(j)
    trees = [_Tree(right, own) for length, own in lengths.items() if length <= 4 * _LONG] if (sizes <= _LONG).any() else []
    every = np.flatnonzero((sizes > 0) & (sizes <= _LONG))
    for words in range(1, _LONG // 64 + 1):
        found += _walks(left, every[-(-sizes[every] // 64) == words], trees, sizes, threshold, edits)
    far = [j for j, text in enumerate(right) if len(text) > 4 * _LONG]
    for rows, others in ((every, far), (np.flatnonzero(sizes > _LONG), range(len(right)))):
        for x in range(0, len(rows), _PAIRED):
            for y in range(0, len(others), _PAIRED):
                own, other = rows[x : x + _PAIRED], np.array(others[y : y + _PAIRED], np.int64)
                i, j, score = _best_of_long([left[n] for n in own], [right[n] for n in other], threshold)
                good = score >= floor_of(sizes[own[i]], edits, threshold)
                found.append((own[i][good], other[j][good], score[good]))
    return _firsts(*(np.concatenate(part) for part in zip(*found, strict=True)))


@lru_cache(maxsize=256)
def _weights(length: int, common: int, base: int) -> np.ndarray:
    """A column for each choice of so many places: codes times a column are the number of the letters there, in order."""
    chosen = np.array(list(combinations(range(length), common)), np.int64).reshape(-1, common)
    weights = np.zeros((length, len(chosen)), np.int64)
    weights[chosen.T, np.arange(len(chosen))] = np.array([base**n for n in range(common)], np.int64)[:, None]
    return weights


def _needed(least: float, total: int) -> int:
    return ceil(least * total / 200.0 - 1e-9)


def _levels(length: int, tree: _Tree, floor: float, above: float) -> range:
    """What a text of this length shares with a text of the tree if they reach ``floor`` and not ``above``, most first."""
    total = length + tree.length
    most = _needed(above, total)
    if 200.0 * most / total >= above:
        most -= 1
    return range(min(length, tree.length, most), max(1, _needed(floor, total)) - 1, -1)


def _end(tree: _Tree, count: int) -> int:
    """More than the number of any text of the tree and of any text that asks."""
    return max(int(tree.member.max()) + 1, count)


def _lists_pay(length: int, count: int, tree: _Tree, levels: range, far: bool) -> bool:
    """Whether so many texts look up subsequences in less time than they walk down the tree."""
    held = len(tree.member)
    pairs = held * count // _WALKED[far]
    if not levels or held + count > pairs or max(held * comb(tree.length, levels[-1]), count * comb(length, levels[-1])) > pairs:
        return False
    if sum(held * comb(tree.length, n) + count * comb(length, n) for n in levels) > pairs:
        return False
    # A subsequence and its text are one machine word.
    return (len(tree.spelled[0]) + 1) ** levels[0] * _end(tree, count) < 1 << 63


def _in_lists(texts: np.ndarray, rows: np.ndarray, tree: _Tree, levels: range, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, score) as ``_in_tree``, of texts ``rows`` (codes, all of one length), by common subsequences.

    Two texts share n characters in order if and only if a subsequence of n is the same, so the first text listed under one is
    enough: what shares more was found before. ``levels`` are the n, most first. The work grows with the texts, not with the pairs.
    """
    total = texts.shape[1] + tree.length
    alphabet, codes = tree.spelled
    base, end = len(alphabet) + 1, _end(tree, len(rows))
    at = np.minimum(np.searchsorted(alphabet, texts), base - 2)
    texts = np.where(alphabet[at] == texts, at, base - 1)  # the last letter stands for all that no text of the tree has
    best = np.full(len(rows), end, np.int64)
    shared = np.zeros(len(rows), np.int64)
    for common in levels:
        score = 200.0 * common / total
        weights, held = _weights(texts.shape[1], common, base), _weights(tree.length, common, base)
        step, width = max(1, _LISTED // held.shape[1]), max(1, _LISTED // (8 * weights.shape[1]))
        asks = np.flatnonzero((shared == 0) & (score >= least[rows]))
        if not len(asks):
            continue
        for start in range(0, len(tree.member), step):
            own = slice(start, start + step)
            listed = codes[own] @ held
            listed *= end
            listed += tree.member[own, None]
            listed = np.sort(listed.ravel())
            for first in range(0, len(asks), width):
                part = asks[first : first + width]
                wanted = texts[part] @ weights
                wanted *= end
                wanted += part[:, None]
                wanted = np.sort(wanted.ravel())  # neighbours look where the one before them did
                text = wanted % end
                wanted -= text
                spot = listed[np.minimum(np.searchsorted(listed, wanted), len(listed) - 1)] - wanted
                hit = np.flatnonzero((spot >= 0) & (spot < end))
                np.minimum.at(best, text[hit], spot[hit])
        met = asks[best[asks] < end]
        shared[met] = common
        least[rows[met]] = score
    met = np.flatnonzero(shared)
    return rows[met], best[met], 200.0 * shared[met] / total


def floor_of(sizes: np.ndarray, edits: int | None, threshold: float) -> np.ndarray:
    """What a text is alike to itself without so many characters, the threshold at least."""
    if edits is None:
        return np.full(len(sizes), float(threshold))
    return np.maximum(threshold, 100.0 - 100.0 * edits / np.maximum(1, 2 * sizes - edits))


def _walks(left: Sequence[str], rows: np.ndarray, trees: Sequence[_Tree], sizes: np.ndarray, threshold: float, edits: int | None) -> list:
    """(i, j, score) of the best partners of the texts ``rows``, in the lists or down the trees."""
    last = floor_of(sizes[rows], edits, threshold)
    found, near = [], 1
    above = np.full(len(rows), 201.0)  # no partner of the texts left is so similar
    while len(rows):
        floor = np.maximum(last, floor_of(sizes[rows], near, threshold))
        least = floor.copy()
        met = np.zeros(len(rows), bool)
        listed = np.zeros((len(trees), len(rows)), bool)
        lengths, firsts, counts = np.unique(sizes[rows], return_index=True, return_counts=True)
        for length, first, count in zip(lengths.tolist(), firsts, counts.tolist(), strict=True):
            own, codes = np.flatnonzero(sizes[rows] == length), None
            for n, tree in enumerate(trees):
                levels = _levels(length, tree, floor[first], above[first])
                if not _lists_pay(length, count, tree, levels, near > _NEAR):
                    continue
                codes = code_matrix([left[m] for m in rows[own]])[0] if codes is None else codes
                listed[n, own] = True
                i, j, score = _in_lists(codes, own, tree, levels, least)
                found.append((rows[i], j, score))
                met[i] = True
        for at in range(0, len(rows), _ASKED):
            part = slice(at, at + _ASKED)
            if listed[:, part].all():
                continue
            asked = _Asked([left[n] for n in rows[part]])
            for tree, done in zip(trees, listed[:, part], strict=True):
                bound = np.where(done, 201.0, least[part])  # more than any score
                i, j, score = _in_tree(asked, tree, bound, near > _NEAR)
                np.maximum.at(least, at + i, score)
                found.append((rows[at + i], j, score))
                met[at + i] = True
        more = ~met & (floor > last)
        rows, last, above, near = rows[more], last[more], floor[more], 2 * near
    return found


def _lengths_of_batch(left: pd.Series, right: pd.Series) -> pd.Series:
    known = (left.notna() & right.notna()).to_numpy()
    result = pd.array([None] * len(left), dtype="Int32")
    if known.any():
        result[known] = common_lengths(left[known].tolist(), right[known].tolist())
    return pd.Series(result)


def common_length(left: Column, right: Column) -> Column:
    """Length of the longest common subsequence.

    Declared non-deterministic so that a filter on the result does not make it
    run twice.
    """
    function = F.pandas_udf(_lengths_of_batch, IntegerType())
    return function.asNondeterministic()(left, right)


def ratio(common: Column, length: Column, other_length: Column) -> Column:
    """Similarity 0-100: twice the common length over the summed lengths."""
    return F.try_divide(F.lit(200.0) * common, length + other_length)


def text_ratio(left: Column, right: Column) -> Column:
    """Similarity of two strings; null when both are empty."""
    return ratio(common_length(left, right), F.length(left), F.length(right))

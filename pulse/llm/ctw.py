"""Language-model scores by context-tree weighting (operator 9).

A text is a sequence of bytes (A-Z lower-cased) and an end mark; each byte is
eight binary decisions, and every node of that binary tree has a context tree of
its own over the preceding bytes. A context's Krichevsky-Trofimov estimate and
the product of its children's weighted probabilities are mixed half and half, at
every depth from none to ``DEPTH`` bytes; the exact posterior weights of that
mixture give the probability of a bit, so no depth has to be chosen. Scores are
code lengths: log10 of the text's probability, and bits per byte.

Every context of the training texts is a node of the trees, so what the model keeps
grows with the corpus; a caller may leave out contexts by a ``share`` of the bytes,
then the rarer children of a node form one child together. The model is a table of
the log probability of every byte sequence that any text holds, trained or held out:
sequences are dealt by their three nearest context bytes, a task mixes the subtrees
of its contexts upwards and downwards with numpy, and what they pass to the contexts
of at most two bytes (at most 2^16 contexts) is mixed on the driver.

Counting and scoring are maps over documents with numpy; byte sequences and words
are counted per task, then summed by a shuffle. Scores take the table in two ways: the
most frequent sequences (at most ``MOST_SHARED``) travel to the tasks, all others are
joined by sequence. The word unigram base score does the same: words with at least
``WORD_SHARE`` of all tokens (so at most ``1 / WORD_SHARE``) travel, all others are
joined by word.

Defined cases: a null text is empty; a null doc_id counts as the empty text and is
held out; an untrained model gives every byte 1/256 and a base score of 0; equal
rows get equal scores; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .storage import ship_package, texts_of, written

DEPTH = 6
#: share of the training bytes below which a context is no node; 0: none
SHARE = 0.0
#: byte sequences whose log probabilities travel to the tasks (12 bytes a slot, two to four slots each)
MOST_SHARED = 1 << 21
#: context bytes by which subtrees are dealt to tasks
NEAR = 3
WORD_SHARE = 2.0 ** -17
#: a byte that UTF-8 never uses: before the beginning and at the end of a text
EDGE = 0xFF
#: white space is no word, so it can stand for the end token
END_WORD = b"\n"
HELD_OUT = 10
#: places that are worked on at a time, so that they stay in the cache
BLOCK = 1 << 15


def prepared(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Texts in lower case with ``depth`` edges before and one after each, and
    the places of the bytes to predict."""
    pad = bytes([EDGE]) * depth
    data = np.frombuffer(b"".join([pad + t.lower() + b"\xff" for t in texts]), np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    ends = np.cumsum(sizes)
    return data, np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(depth * np.arange(1, len(texts) + 1), sizes)


def gram_counts(texts: list[bytes], depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """Distinct sequences of ``depth`` context bytes and the next byte, as
    numbers with the next byte lowest, and their counts."""
    return np.unique(gram_codes(texts, depth), return_counts=True)


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """``summed`` over all of ``parts``, which is emptied: the single parts are
    free before the sort takes its memory."""
    joined = [np.concatenate(x) for x in zip(*parts)]
    parts.clear()
    order = np.argsort(joined[0], kind="stable")
    codes = joined[0][order]
    counts = joined.pop()[order]
    joined.clear()
    del order
    first = np.flatnonzero(np.diff(codes, prepend=-1)) if len(codes) else np.empty(0, np.int64)
    return codes[first], np.add.reduceat(counts, first) if len(first) else counts


def summed(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(codes, kind="stable")
    codes, counts = codes[order], counts[order]
    first = np.flatnonzero(np.diff(codes, prepend=-1)) if len(codes) else np.empty(0, np.int64)
    return codes[first], np.add.reduceat(counts, first) if len(first) else counts


def text_ranges(sizes: list[int], most: int = 2 << 20):
    lo = held = 0
    for i, n in enumerate(sizes):
        if held and held + n > most:
            yield lo, i
            lo, held = i, 0
        held += n
    if lo < len(sizes):
        yield lo, len(sizes)


def count_grams(texts: DataFrame, depth: int = DEPTH, most: int = 2 << 20) -> DataFrame:
    """``code, n, uses``: byte sequences of texts given as ``held_out, body``
    (binary), their counts in training texts and in all.

    A task sums what it meets, gives out its sums when they exceed ``most``
    entries and at its end; a shuffle adds them up.
    """
    ship_package(texts.sparkSession)

    def give(codes: np.ndarray, counts: np.ndarray, held_out: bool) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(codes), pa.array(counts * (not held_out)), pa.array(counts)], ["code", "n", "uses"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # per side what is summed so far, first, and what was met since
        parts: dict[bool, list[tuple[np.ndarray, np.ndarray]]] = {out: [(np.empty(0, np.int64),) * 2] for out in (False, True)}
        for batch in batches:
            for out in (False, True):
                side = parts[out]
                for _, _, body in texts_of(batch.column(1).filter(pc.equal(batch.column(0), out)), text_ranges):
                    side.append(gram_counts(body, depth))
                    if sum(len(c) for c, _ in side[1:]) > max(1 << 20, len(side[0][0])):
                        side.append(merged(side))
                    if len(side[0][0]) > most:
                        yield give(*side.pop(0), out)
                        side.insert(0, (np.empty(0, np.int64),) * 2)
        for out in (False, True):
            yield give(*merged(parts[out]), out)

    return (texts.select("held_out", "body").mapInArrow(run, "code long, n long, uses long")
            .groupBy("code").agg(F.sum("n").alias("n"), F.sum("uses").alias("uses")))


def count_words(texts: DataFrame, most: int = 1 << 19) -> DataFrame:
    """``word, c``: words and end tokens of texts given as ``body`` (binary)."""

    def give(words: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(words), pa.binary()), pa.array(list(words.values()), pa.int64())], ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter = Counter()
        for batch in batches:
            for lo, hi, body in texts_of(batch.column(0), text_ranges):
                words.update(b"\n".join(body).lower().split())
                words[END_WORD] += hi - lo
                if len(words) > most:
                    yield give(words)
                    words = Counter()
        yield give(words)

    return texts.select("body").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("c"))


def log_gamma(x: np.ndarray) -> np.ndarray:
    """ln Gamma(x) for x > 0: Stirling's series after a shift by eight."""
    z = x + 8
    shift = np.prod([x + k for k in range(8)], axis=0, dtype=float) if np.max(x, initial=0) < 1e30 else x
    series = 1 / (12 * z) - 1 / (360 * z ** 3) + 1 / (1260 * z ** 5) - 1 / (1680 * z ** 7)
    return (z - 0.5) * np.log(z) - z + 0.5 * math.log(2 * math.pi) + series - np.log(shift)


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """ln of the Krichevsky-Trofimov probability of so many zeros and ones."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - math.log(math.pi) - log_gamma(zeros + ones + 1.0)


def _sums(counts: np.ndarray) -> np.ndarray:
    """Running sums of rows of 256 byte counts, from 0."""
    out = np.zeros((len(counts), 257))
    np.cumsum(counts, axis=1, out=out[:, 1:])
    return out


def _decisions(sums: np.ndarray, nodes: range) -> tuple[np.ndarray, np.ndarray]:
    """Zeros and ones at inner nodes of the binary tree over bytes.

    Node 1 is the root, the children of i are 2 i and 2 i + 1, so a node of level
    l stands for a run of 256 >> l bytes.
    """
    level = [i.bit_length() - 1 for i in nodes]
    width = np.array([256 >> n for n in level])
    low = np.array([i - (1 << n) for i, n in zip(nodes, level)]) * width
    middle = sums[:, low + width // 2]
    return middle - sums[:, low], sums[:, low + width] - middle


class Model:
    """The weighted context trees of a corpus that fits one process.

    ``child[node, byte]`` is the node of the context that is longer by ``byte``
    (the number of nodes where there is none), ``log10[node, byte]`` the log
    probability of the next byte where no longer context is a node.
    """

    def __init__(self, level: np.ndarray, context: np.ndarray, byte: np.ndarray, count: np.ndarray, depth: int = DEPTH):
        """One entry per context (its depth and bytes) and next byte."""
        self.depth = depth
        if not len(level):
            level = context = byte = count = np.zeros(1, np.int64)
        order = np.lexsort((context, level))
        level, context, byte, count = (np.asarray(x, np.int64)[order] for x in (level, context, byte, count))
        new = np.ones(len(level), bool)
        new[1:] = (level[1:] != level[:-1]) | (context[1:] != context[:-1])
        node = np.cumsum(new) - 1
        levels, names = level[new], context[new]
        n = len(names)
        counts = np.zeros((n, 256))
        counts[node, byte] = count
        parent = np.zeros(n, np.int64)
        self.child = np.full((n + 1, 256), n, np.int32)
        for d in range(1, levels.max() + 1):
            at, above = np.flatnonzero(levels == d), np.flatnonzero(levels == d - 1)
            parent[at] = above[np.searchsorted(names[above], names[at] & ((1 << 8 * (d - 1)) - 1))]
            self.child[parent[at], names[at] >> 8 * (d - 1)] = at
        inner = (self.child[:n] != n).any(axis=1)
        sums = _sums(counts)
        np.subtract.at(counts, parent[1:], counts[1:].copy())
        rests = _sums(counts)
        del counts
        one = np.full((n, 256), 0.5)
        for lo in range(0, 256, 16):  # the binary nodes are independent of each other
            nodes = range(max(1, lo), lo + 16)
            one[:, nodes.start:nodes.stop] = self._mixed(levels, parent, inner, *_decisions(sums, nodes), *_decisions(rests, nodes))
        del sums, rests
        self.log10 = np.empty((n, 256), np.float32)
        for lo in range(0, n, 4096):
            p = one[lo:lo + 4096]
            path = np.zeros((len(p), 512))
            for i in range(1, 256):
                path[:, 2 * i] = path[:, i] + np.log10(1 - p[:, i])
                path[:, 2 * i + 1] = path[:, i] + np.log10(p[:, i])
            self.log10[lo:lo + 4096] = path[:, 256:]

    @staticmethod
    def _mixed(levels, parent, inner, zeros, ones, rest0, rest1) -> np.ndarray:
        """Probability of a one where no longer context is a node."""
        here, other = log_kt(zeros, ones), log_kt(rest0, rest1)
        # upwards: ln of the weighted probability of every node
        below = np.where(inner[:, None], other, 0.0)
        weighted = here.copy()
        for d in range(levels.max(), -1, -1):
            at = np.flatnonzero(levels == d)
            split = at[inner[at]]
            weighted[split] = np.logaddexp(here[split], below[split]) - math.log(2)
            if d:
                np.add.at(below, parent[at], weighted[at])
        # downwards: the mass that stops at each depth of the path
        stop = np.where(inner[:, None], np.exp(here - math.log(2) - weighted), 1.0)
        kt = (ones + 0.5) / (zeros + ones + 1)
        sure, left, one = np.zeros_like(here), np.ones_like(here), np.empty_like(here)
        for d in range(levels.max() + 1):
            at = np.flatnonzero(levels == d)
            before, mass = (sure[parent[at]], left[parent[at]]) if d else (0.0, 1.0)
            sure[at] = before + mass * stop[at] * kt[at]
            left[at] = mass * (1 - stop[at])
            one[at] = sure[at] + left[at] * (rest1[at] + 0.5) / (rest0[at] + rest1[at] + 1)
        return one

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """log10 probability of every text with its end mark."""
        if not texts:
            return np.empty(0)
        data, at = prepared(texts, self.depth)
        none = len(self.log10)
        flat = self.child.ravel()
        node = np.zeros(len(at), np.int64)
        best = node
        for back in range(1, self.depth + 1):
            node = flat[node * 256 + data[at - back]].astype(np.int64)
            best = np.where(node != none, node, best)
        value = self.log10.ravel()[best * 256 + data[at]].astype(np.float64)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        return np.add.reduceat(value, np.cumsum(sizes) - sizes)


_HALVES = log_gamma(np.arange(1 << 16) + 0.5)
_WHOLES = log_gamma(np.arange(1 << 16) + 1.0)


def count_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """``log_kt`` of integers, those of small ones looked up."""
    both = zeros + ones
    large = np.flatnonzero(both >= len(_HALVES))
    if len(large):
        zeros, ones, rest = zeros.copy(), ones.copy(), log_kt(zeros[large], ones[large])
        zeros[large] = ones[large] = both[large] = 0
    out = _HALVES[zeros] + _HALVES[ones] - math.log(math.pi) - _WHOLES[both]
    if len(large):
        out[large] = rest
    return out


class Level:
    """Binary nodes of the contexts of one length; ``parent`` is the place of
    each in the level above, ``node`` whether its context is a node of the tree,
    ``inner`` whether a longer one is. ``rest0, rest1, below``: the counts that
    are in no longer node, and ln of the weighted probability of those that are."""

    def __init__(self, zeros, ones, node, inner, parent=None):
        self.zeros, self.ones, self.node, self.inner, self.parent = zeros, ones, node, inner, parent
        self.rest0, self.rest1, self.below = zeros, ones, 0.0

    def take(self, at: np.ndarray, zeros: np.ndarray, ones: np.ndarray, weighted: np.ndarray) -> None:
        """Children at ``at`` that are nodes."""
        add = lambda x: np.bincount(at, x, len(self.zeros))
        self.rest0, self.rest1 = (self.rest0 - add(zeros)).astype(np.int64), (self.rest1 - add(ones)).astype(np.int64)
        self.below = self.below + add(weighted)


def mix(levels: list[Level]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Levels from short to long contexts: ln of the weighted probability of the
    first, and of the last the part of a one's probability that is sure, the mass
    left for longer contexts, and the probability where no longer one is a node."""
    stops = []
    for up, level in zip([None, *levels[:-1]][::-1], levels[::-1]):
        here = count_kt(level.zeros, level.ones)
        weighted = np.where(level.inner, np.logaddexp(here, level.below + count_kt(level.rest0, level.rest1)) - math.log(2), here)
        stops.append(np.where(level.inner, np.exp(here - math.log(2) - weighted), 1.0))
        if up is not None:
            at = level.node
            up.take(level.parent[at], level.zeros[at], level.ones[at], weighted[at])
    sure, left, one = np.zeros(1), np.ones(1), np.full(1, np.nan)
    for level, stop in zip(levels, stops[::-1]):
        at = np.zeros(len(level.zeros), np.int64) if level.parent is None else level.parent
        before, mass, above = sure[at], left[at], one[at]
        sure = before + mass * stop * (level.ones + 0.5) / (level.zeros + level.ones + 1)
        left = mass * (1 - stop)
        one = np.where(level.node, sure + left * (level.rest1 + 0.5) / (level.rest0 + level.rest1 + 1), above)
        sure, left = np.where(level.node, sure, before), np.where(level.node, left, mass)
    return weighted, sure, left, one


def nearest_first(codes: np.ndarray, depth: int) -> np.ndarray:
    """Sequences with the context bytes turned round, the nearest highest."""
    context, out = codes >> 8, np.zeros_like(codes)
    for _ in range(depth):
        out, context = (out << 8) | (context & 255), context >> 8
    return (out << 8) | (codes & 255)


def starts(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the run of equal neighbours of each key, first place of each run."""
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    return np.cumsum(new) - 1, np.flatnonzero(new)


def subtrees(codes: np.ndarray, counts: np.ndarray, depth: int, top: int, least: int):
    """The trees below whole contexts of ``top`` bytes, of distinct sequences.

    Returns ``p``, eight probabilities of a one per sequence given that contexts
    of less than ``top`` bytes are passed (NaN: not a node), and rows for the level
    above: binary node, zeros, ones, those of nodes, ln of their weighted
    probability, number of nodes.
    """
    keys = nearest_first(codes, depth)
    # sequences of every context length, and the place of each in the next shorter
    grams, sums, ups = [], [], []
    for d in range(depth, top - 1, -1):
        if d == depth:
            key, inverse = np.unique(keys, return_inverse=True)
            n = np.bincount(inverse, counts, len(key)).astype(np.int64)
            at = inverse
        else:
            short = ((grams[-1] >> 16) << 8) | (grams[-1] & 255)
            key, inverse = np.unique(short, return_inverse=True)
            n = np.bincount(inverse, sums[-1], len(key)).astype(np.int64)
            ups.append(inverse)
        grams.append(key)
        sums.append(n)
    grams, sums, ups = grams[::-1], sums[::-1], [None, *ups[::-1]]
    nodes, inners, child = [], [], None
    for d in range(depth, top - 1, -1):
        key, n, up = grams[d - top], sums[d - top], ups[d - top]
        number, first = starts(key >> 8)
        node = (np.bincount(number, n) >= least) | (d == 0)
        inner = np.zeros(len(first), bool)
        if child is not None:
            inner[number[child]] = True
        nodes.append(node[number])
        inners.append(inner[number])
        child = up[first[node]] if up is not None else None
    nodes, inners = nodes[::-1], inners[::-1]
    p, rows = np.empty((len(codes), 8)), []
    for bit in range(8):
        levels, entry = [], None
        for key, n, up, node, inner in zip(grams, sums, ups, nodes, inners):
            above, (entry, first) = entry, starts(key >> (8 - bit))
            one = (key >> (7 - bit)) & 1
            levels.append(Level(np.add.reduceat(n * (1 - one), first), np.add.reduceat(n * one, first), node[first], inner[first],
                                None if up is None else above[up[first]]))
            if up is None:
                # the binary node of the context that is shorter by its farthest byte
                place = (((key[first] >> 16) << 8) | (1 << bit) | ((key[first] & 255) >> (8 - bit)))
        weighted, _, _, ones = mix(levels)
        p[:, bit] = ones[entry][at]
        z, o, kept = levels[0].zeros, levels[0].ones, levels[0].node
        rows.append((place, z, o, z * kept, o * kept, weighted * kept, kept.astype(np.int64)))
    return p, [np.concatenate(x) for x in zip(*rows)]


def shorter(place: np.ndarray, zeros, ones, kept0, kept1, weighted, kept, top: int, least: int):
    """The trees of contexts of less than ``top`` bytes, from what the subtrees
    gave (one row a binary node): sorted binary nodes of ``top - 1`` bytes, sure,
    left and one of each as ``mix`` returns them."""
    levels, names = [], []
    for d in range(top - 1, -1, -1):
        if d == top - 1:
            order = np.argsort(place)
            place, zeros, ones, kept0, kept1, weighted, kept = (x[order] for x in (place, zeros, ones, kept0, kept1, weighted, kept))
        else:
            place, inverse = np.unique(((names[-1] >> 16) << 8) | (names[-1] & 255), return_inverse=True)
            levels[-1].parent = inverse
            zeros, ones = (np.bincount(inverse, x, len(place)).astype(np.int64) for x in (levels[-1].zeros, levels[-1].ones))
        number, first = starts(place >> 8)
        # every context has the binary node 1, which counts all its bytes
        node = (zeros[first] + ones[first] >= least) | (d == 0)
        inner = np.zeros(len(first), bool)
        if d == top - 1:
            inner[:] = kept[first] > 0
        else:
            inner[number[inverse[below_first[below_node]]]] = True
        level = Level(zeros, ones, node[number], inner[number])
        if d == top - 1:
            level.rest0, level.rest1, level.below = zeros - kept0, ones - kept1, weighted
        below_first, below_node = first, node
        levels.append(level)
        names.append(place)
    _, sure, left, one = mix(levels[::-1])
    return names[0], sure, left, one


def log_probabilities(grams: DataFrame, depth: int = DEPTH, share: float = SHARE) -> DataFrame:
    """``code, uses, value``: log10 probability of the last byte of every sequence
    after the others. ``grams`` is a written table, trained on its counts ``n``."""
    spark = grams.sparkSession
    total = grams.agg(F.sum("n")).first()[0] or 0
    least, top = max(1, math.ceil(share * total)), min(NEAR, depth)
    near = F.shiftright("code", 8).bitwiseAND(F.lit((1 << 8 * top) - 1))
    names = ["code", "uses", "p", "place", "zeros", "ones", "kept0", "kept1", "weighted", "kept"]
    types = [pa.int64(), pa.int64(), pa.binary(), *[pa.int64()] * 5, pa.float64(), pa.int64()]

    def mixed(codes: np.ndarray, counts: np.ndarray, uses: np.ndarray) -> Iterator[pa.RecordBatch]:
        p, rows = subtrees(codes, counts, depth, top, least)
        p = pa.Array.from_buffers(pa.binary(), len(codes), [None, pa.py_buffer(np.arange(0, 64 * len(codes) + 1, 64, dtype=np.int32)), pa.py_buffer(p.tobytes())])
        yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(uses), p, *[pa.nulls(len(codes), t) for t in types[3:]]], names)
        if top:
            # one row a binary node
            place, inverse = np.unique(rows[0], return_inverse=True)
            add = [np.bincount(inverse, x, len(place)) for x in rows[1:]]
            yield pa.RecordBatch.from_arrays([*[pa.nulls(len(place), t) for t in types[:3]], pa.array(place),
                                              *[pa.array(x.astype(t.to_pandas_dtype())) for x, t in zip(add, types[4:])]], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[list[np.ndarray]] = []
        held = 0
        for batch in batches:
            waiting.append([batch.column(i).to_numpy() for i in range(4)])
            held += batch.num_rows
            if held >= 1 << 18:
                codes, counts, uses, nearest = map(np.concatenate, zip(*waiting))
                whole = np.searchsorted(nearest, nearest[-1])  # the last context may go on
                if whole:
                    yield from mixed(codes[:whole], counts[:whole], uses[:whole])
                waiting = [[x[whole:] for x in (codes, counts, uses, nearest)]]
                held = 0 if whole else -len(codes)  # a large context doubles before it is tried again
        if waiting and sum(len(w[0]) for w in waiting):
            codes, counts, uses, _ = map(np.concatenate, zip(*waiting))
            yield from mixed(codes, counts, uses)

    parts = written(
        grams.select("code", "n", "uses", near.alias("near")).repartition("near").sortWithinPartitions("near")
        .mapInArrow(run, "code long, uses long, p binary, place long, zeros long, ones long, kept0 long, kept1 long, weighted double, kept long"), "ctw-parts")
    above = None
    if top:
        rows = parts.where("place is not null").groupBy("place").agg(*[F.sum(c).alias(c) for c in names[4:]]).toArrow()
        if rows.num_rows:
            above = shorter(*(rows.column(c).to_numpy() for c in names[3:]), top, least)
    shared = spark.sparkContext.broadcast(above)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        above = shared.value
        for batch in batches:
            codes = batch.column(0).to_numpy()
            if not len(codes):
                continue
            p = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.float64).reshape(-1, 8)
            byte = codes & 255
            nearest = nearest_first(codes, depth) >> 8 * (depth - top + 2) if top else None
            value = np.zeros(len(codes))
            for bit in range(8):
                q = p[:, bit]
                if top:
                    place, sure, left, one = above
                    at = np.searchsorted(place, (nearest << 8) | (1 << bit) | (byte >> (8 - bit)))
                    q = np.where(np.isnan(q), one[at], sure[at] + left[at] * q)
                value += np.log10(np.where((byte >> (7 - bit)) & 1, q, 1 - q))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(value.astype(np.float32))], ["code", "uses", "value"])

    out = written(parts.where("code is not null").select("code", "uses", "p").mapInArrow(finish, "code long, uses long, value float"), "ctw-values")
    shared.destroy()
    return out


def most_used(values: DataFrame, most: int) -> int:
    """The least number of uses that at most ``most`` sequences reach."""
    bucket = F.floor(F.log2("uses") * 16).cast("int")
    counts = sorted(values.groupBy(bucket.alias("b")).agg(F.count("*").alias("c"), F.min("uses").alias("least")).collect(), key=lambda r: -r["b"])
    held, least = 0, None
    for r in counts:
        held += r["c"]
        if held > most:
            break
        least = r["least"]
    return (1 << 62) if least is None else least


class Lookup:
    """Values of byte sequences in an open hash table of two arrays."""

    def __init__(self, codes: np.ndarray, values: np.ndarray):
        self.bits = max(1, (2 * len(codes)).bit_length())
        self.codes = np.full(1 << self.bits, -1, np.int64)
        self.values = np.zeros(1 << self.bits, np.float32)
        slot = self._slots(codes)
        while len(codes):
            free = self.codes[slot] == -1
            self.codes[slot[free]] = codes[free]  # of several one stays
            placed = self.codes[slot] == codes
            self.values[slot[placed]] = values[placed]
            codes, values, slot = codes[~placed], values[~placed], (slot[~placed] + 1) & (len(self.codes) - 1)

    def _slots(self, codes: np.ndarray) -> np.ndarray:
        return ((codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values (0 where there is none), and whether there is one."""
        value, hit = np.empty(len(codes)), np.empty(len(codes), bool)
        for lo in range(0, len(codes), BLOCK):
            value[lo:lo + BLOCK], hit[lo:lo + BLOCK] = self._find(codes[lo:lo + BLOCK])
        return value, hit

    def _find(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        slot = self._slots(codes)
        found = self.codes[slot]
        hit = found == codes
        value = self.values[slot] * hit
        open_ = np.flatnonzero(~hit & (found != -1))
        at = slot[open_]
        while len(open_):
            at = (at + 1) & (len(self.codes) - 1)
            found = self.codes[at]
            same = found == codes[open_]
            hit[open_[same]] = True
            value[open_[same]] = self.values[at[same]]
            on = ~same & (found != -1)
            open_, at = open_[on], at[on]
        return value, hit


def gram_codes(texts: list[bytes], depth: int) -> np.ndarray:
    """The sequence of ``depth`` context bytes and the byte at every place.

    Shifts run over neighbours in blocks that stay in the cache; the places
    among the edges are left out at the end.
    """
    data, at = prepared(texts, depth)
    code = np.empty(max(len(data) - depth, 0), np.int64)
    for lo in range(0, len(code), BLOCK):
        part = code[lo:lo + BLOCK]
        part[:] = data[lo:lo + len(part)]
        for ahead in range(1, depth + 1):
            np.left_shift(part, 8, out=part)
            np.bitwise_or(part, data[lo + ahead:lo + ahead + len(part)], out=part)
    return code[at - depth]


def score(docs: DataFrame, depth: int = DEPTH, share: float = SHARE, word_share: float = WORD_SHARE,
          most_shared: int = MOST_SHARED) -> DataFrame:
    """Scores of all documents, learnt from those that are not held out.

    Returns ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score, n_bytes, bits_per_byte``.
    """
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % HELD_OUT == 0).alias("held_out"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("body"))
    values = log_probabilities(written(count_grams(rows, depth), "ctw-grams"), depth, share)
    common = values.where(F.col("uses") >= most_used(values, most_shared)).select("code", "value", "uses").toArrow()
    # the most used sequence of a slot is the last put there, and stays
    common = common.take(np.argsort(common.column("uses").to_numpy(), kind="stable"))
    words = written(count_words(rows.where(~F.col("held_out"))), "ctw-words")
    tokens, distinct = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    often = words.where(F.col("c") >= max(1, math.ceil(word_share * tokens))).collect()
    shared = spark.sparkContext.broadcast((Lookup(common.column("code").to_numpy(), common.column("value").to_numpy()),
                                           [bytes(r["word"]) for r in often], np.array([r["c"] for r in often], np.int64)))
    del common
    names = ["doc_id", "held_out", "n_tokens", "n_known", "logs", "score", "n_bytes", "rare", "grams"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup, frequent, times = shared.value
        number = {w: i for i, w in enumerate(frequent)}.get
        logs = np.append(np.log10(times + 0.1), 0.0)
        for batch in batches:
            for lo, hi, part in texts_of(batch.column(2), text_ranges):
                cut = [b.lower().split() for b in part]
                sizes = np.fromiter(map(len, cut), np.int64, len(cut)) + 1
                flat = [w for words in cut for w in (*words, END_WORD)]
                at = np.fromiter(map(number, flat, repeat(len(frequent))), np.int64, len(flat))
                begin = np.cumsum(sizes) - sizes
                far = np.flatnonzero(at == len(frequent))
                n_far = np.add.reduceat((at == len(frequent)).astype(np.int64), begin)
                bounds = np.concatenate(([0], np.cumsum(n_far))).astype(np.int32)
                lengths = np.fromiter(map(len, part), np.int64, len(part))
                first = np.cumsum(lengths + 1) - lengths - 1
                codes = gram_codes(part, depth)
                value, hit = lookup.find(codes)
                missed = np.concatenate(([0], np.cumsum(np.add.reduceat((~hit).astype(np.int64), first)))).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), pa.array(sizes), pa.array(sizes - n_far),
                    pa.array(np.add.reduceat(logs[at], begin)), pa.array(np.add.reduceat(value, first)), pa.array(lengths),
                    pa.ListArray.from_arrays(pa.array(bounds), pa.array([flat[i] for i in far.tolist()], pa.binary())),
                    pa.ListArray.from_arrays(pa.array(missed), pa.array(codes[~hit]))], names)

    scored = written(rows.mapInArrow(
        run, "doc_id long, held_out boolean, n_tokens long, n_known long, logs double, score double, n_bytes long, rare array<binary>, grams array<long>")
        .withColumn("row", F.monotonically_increasing_id()), "ctw-scored")
    shared.destroy()
    rare = (scored.select("row", F.explode("rare").alias("word")).join(words, "word", "left").groupBy("row")
            .agg(F.sum(F.log10(F.coalesce("c", F.lit(0)) + 0.1)).alias("rare_logs"), F.count("c").alias("rare_known")))
    seldom = (scored.select("row", F.explode("grams").alias("code")).join(values.select("code", "value"), "code")
              .groupBy("row").agg(F.sum(F.col("value").cast("double")).alias("seldom")))
    norm = math.log10(tokens + 0.1 * (distinct + 1))
    return scored.drop("rare", "grams").join(rare, "row", "left").join(seldom, "row", "left").withColumn(
        "score", F.col("score") + F.coalesce("seldom", F.lit(0.0))).select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("logs") + F.coalesce("rare_logs", F.lit(0.0)) - F.col("n_tokens") * F.lit(norm)).alias("base_score"), "score",
        "n_bytes", (-F.col("score") / math.log10(2) / (F.col("n_bytes") + 1)).alias("bits_per_byte"))


def op9_ctw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))

"""Near-duplicate groups by BagMinHash (operator 7).

A document is the bag of its five-word shingles (of all its words if it has
fewer); its weight of a shingle is how often it occurs. BagMinHash draws, for
every shingle, a Poisson process of points over time x weight x signature slot
that depends on the shingle alone; a document sees the points whose weight
coordinate lies below its own weight, and a slot of its signature is the first
point it sees there. Two documents agree in a slot with probability equal to
their weighted Jaccard similarity sum(min) / sum(max). The weight axis is cut
into the dyadic ranges [0,1), [1,2), [2,4), ... with a process of its own each; a
range that a weight covers in part is split in halves, and the points of the
parent are dealt to the halves, so equal shingles see equal points whatever their
weights. Points are drawn in the order of time and only until no slot can
improve, so most shingles cost one or two draws.

Signatures are cut into bands; documents that share a band are candidates. In a
bucket every member is compared with the bucket's best connected text only, the
verified links are joined to classes, and where members of several classes are
left in a bucket, members of different classes are compared, chunk by chunk,
unless their signatures rule out the threshold (by 5.5 standard deviations). So
a bucket of n copies costs n comparisons, not n squared. The outsiders of a bucket
(members outside its largest class) meet all its members, to lose no link; that is
done block by block in arrays within a task, texts beside signatures, and only the
links between classes leave it: no table holds these pairs.

Equal texts are one node from the start (by MD5, pre-aggregated), so exact
copies cost nothing after the first scan. Only candidates' texts are shuffled.

Defined cases: a null text is empty; a text without words is near nothing but its
own copies; rows with equal text form a class, also under one id; the class is
named by its smallest doc_id (null counts as the largest), and one row of the
class is the kept one; an empty table gives an empty result; further columns are
ignored or carried along.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .storage import ship_package, small_or_shuffled, texts_of, written

SHINGLE = 5
THRESHOLD = 0.8
BANDS = 42
ROWS = 6
#: slots of a signature: the bands take the first ones, all tell how alike two
#: candidates are
SLOTS = 512
#: bits of every slot kept for ruling out pairs, and how many standard
#: deviations beyond its expectation a similar pair's difference may lie
SLOT_BITS = 4
SIGMAS = 5.5
#: outsiders of a bucket, and shingles of theirs, that a task holds at a time
CHUNK = 256
CHUNK_SHINGLES = 1 << 21
#: pairs whose signatures are compared at a time
PAIRS = 8192

_MIX1, _MIX2, _STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """SplitMix64's finishing permutation."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


_BYTE = mix((np.arange(1, 257, dtype=np.uint64)) * _STEP)
_BASE = np.uint64(0xD6E8FEB86659FD93)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[:1] = 1
    done = 1
    while done < n:
        step = min(done, n - done)
        out[done:done + step] = out[:step] * np.uint64(int(out[done - 1]) * int(base) % (1 << 64))
        done += step
    return out


def hashed_runs(data: np.ndarray, separator: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Begins and 64-bit hashes (after lower-casing A-Z) of the runs of bytes
    that are not marked in ``separator``; ``data`` ends with a separator."""
    # prefix sums of a polynomial hash; a run's hash is the difference of two
    power = _powers(_BASE, len(data) + 1)
    prefix = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[_LOWER[data]] * power[:-1])))
    edge = np.diff(separator[data].astype(np.int8), prepend=1)
    begin, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    return begin, mix((prefix[end] - prefix[begin]) * _powers(inverse, len(data) + 1)[begin])


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, one after the other, and the number of
    words of each text."""
    begin, words = hashed_runs(np.frombuffer(b"\n".join(texts) + b"\n", np.uint8))
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    return words, np.diff(np.searchsorted(begin, np.cumsum(sizes)), prepend=0)


def bags(texts: list[bytes], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of all texts: text index, shingle hash, weight; sorted."""
    words, counts = word_hashes(texts)
    first = np.cumsum(counts) - counts
    windows = np.where(counts > 0, np.maximum(counts - size + 1, 1), 0)
    doc = np.repeat(np.arange(len(texts)), windows)
    at = np.arange(int(windows.sum())) - np.repeat(np.cumsum(windows) - windows, windows) + first[doc]
    length = np.minimum(size, counts)[doc]
    shingle = length.astype(np.uint64)
    for k in range(size):
        here = at + np.minimum(k, length - 1)
        shingle = np.where(k < length, mix((shingle ^ words[here]) * _STEP + np.uint64(k + 1)), shingle)
    order = np.lexsort((shingle, doc))
    doc, shingle = doc[order], shingle[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (shingle[1:] != shingle[:-1])
    start = np.flatnonzero(new)
    return doc[start], shingle[start], np.diff(np.append(start, len(doc)))


def _unit(bits: np.ndarray) -> np.ndarray:
    """Uniform numbers in (0, 1]."""
    return ((bits >> np.uint64(11)).astype(np.float64) + 1) * 2.0 ** -53


class _Slots:
    """Signatures of a batch: first time and point of every slot."""

    def __init__(self, docs: int, slots: int):
        self.m = slots
        self.time = np.full(docs * slots, np.inf)
        self.point = np.zeros(docs * slots, np.uint64)

    def offer(self, doc: np.ndarray, slot: np.ndarray, time: np.ndarray, point: np.ndarray) -> None:
        at = doc * self.m + slot
        better = time < self.time[at]
        at, time, point = at[better], time[better], point[better]
        np.minimum.at(self.time, at, time)
        won = self.time[at] == time
        self.point[at[won]] = point[won]

    def latest(self, doc: np.ndarray) -> np.ndarray:
        """Time of the last slot of each entry of the sorted ``doc``."""
        first = np.flatnonzero(np.diff(doc, prepend=-1))
        of = self.time.reshape(-1, self.m)[doc[first]].max(axis=1)
        return np.repeat(of, np.diff(np.append(first, len(doc))))


def signatures(doc: np.ndarray, shingle: np.ndarray, weight: np.ndarray, docs: int, slots: int) -> np.ndarray:
    """BagMinHash signatures: (docs, slots) hashes, zero for empty bags.

    One entry per (text, shingle); weights are whole numbers from 1.
    """
    out = _Slots(docs, slots)
    top = int(weight.max(initial=0))
    low, width = 0, 1
    while low < top:
        # the process of the range [low, low + width) of all shingles that reach it
        here = np.flatnonzero(weight > low)
        seed = mix(shingle[here] + np.uint64((2 * low + 1) * int(_STEP) % (1 << 64)))
        _process(out, doc[here], seed, np.minimum(weight[here] - low, width), width, slots)
        low, width = low + width, width if low == 0 else 2 * width
    return out.point.reshape(docs, slots)


def _process(out: _Slots, doc: np.ndarray, seed: np.ndarray, covered: np.ndarray, width: int, slots: int) -> None:
    """Points of one weight range in the order of time; ``doc`` is sorted.

    Each draw is the next point of the whole range; its place on the weight axis
    is found by halving, one random bit a level, which deals the points to the
    processes of the halves. Points above the weight are not seen, and a shingle
    goes on until its time is past the latest slot of its document.
    """
    time, state = np.zeros(len(doc)), seed.copy()
    levels = width.bit_length() - 1
    while len(doc):
        # few shingles left: draw ahead, what comes too late improves nothing
        ahead = 1 if len(doc) > 4096 else 16
        steps = state[:, None] + np.arange(1, ahead + 1, dtype=np.uint64) * _STEP
        bits = mix(steps)
        times = time[:, None] + np.cumsum(-np.log(_unit(bits)), axis=1) / (width * slots)
        latest = out.latest(doc)
        seen = times < latest[:, None]
        if levels:
            place = mix(bits ^ _MIX1) >> np.uint64(64 - levels)
            seen &= place < covered.astype(np.uint64)[:, None]
        entry, _ = np.nonzero(seen)
        bits_seen = bits[seen]
        slot = ((mix(bits_seen ^ _MIX2) >> np.uint64(32)) * np.uint64(slots) >> np.uint64(32)).astype(np.int64)
        out.offer(doc[entry], slot, times[seen], bits_seen | np.uint64(1))
        live = times[:, -1] < latest
        doc, covered, time, state = doc[live], covered[live], times[live, -1], steps[live, -1]


def similarity(a: bytes, b: bytes) -> float:
    """Weighted Jaccard similarity of two texts' bags (0 for empty bags)."""
    doc, shingle, weight = bags([a, b])
    return _overlap(shingle[doc == 0], weight[doc == 0], shingle[doc == 1], weight[doc == 1])


def _overlap(s1: np.ndarray, w1: np.ndarray, s2: np.ndarray, w2: np.ndarray) -> float:
    if not len(s1) or not len(s2):
        return 0.0
    at = np.minimum(np.searchsorted(s2, s1), len(s2) - 1)
    common = int(np.where(s2[at] == s1, np.minimum(w1, w2[at]), 0).sum())
    return common / (int(w1.sum()) + int(w2.sum()) - common)


def _short(sig: np.ndarray) -> np.ndarray:
    """The top bits of every slot, packed into 64-bit words."""
    per = 64 // SLOT_BITS
    docs, slots = sig.shape
    top = np.zeros((docs, -(-slots // per) * per), np.uint64)
    top[:, :slots] = sig >> np.uint64(64 - SLOT_BITS)
    shift = np.arange(per, dtype=np.uint64) * np.uint64(SLOT_BITS)
    return np.bitwise_or.reduce(top.reshape(docs, -1, per) << shift, axis=2)


def different_slots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of unequal kept parts of each pair of packed signatures."""
    x = a ^ b
    x |= x >> np.uint64(1)
    x |= x >> np.uint64(2)
    return np.bitwise_count(x & np.uint64(0x1111111111111111)).sum(axis=1, dtype=np.int64)


def most_different_slots(slots: int, threshold: float) -> int:
    """Differing kept parts beyond which a pair is ruled out.

    A similar pair's slots differ with probability 1 - threshold at most, and of
    unequal slots all but one in ``2 ** SLOT_BITS`` have unequal parts.
    """
    p = (1 - threshold) * (1 - 2.0 ** -SLOT_BITS)
    return int(np.ceil(slots * p + SIGMAS * np.sqrt(slots * p * (1 - p))))


def text_key(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary")))


def text_ranges(sizes: list[int], most: int = 1 << 20):
    """Ranges of about ``most`` bytes, one text at least."""
    lo = held = 0
    for i, n in enumerate(sizes):
        if held and held + n > most:
            yield lo, i
            lo, held = i, 0
        held += n
    if lo < len(sizes):
        yield lo, len(sizes)


def sketch(texts: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``key, n, bands, slots`` of texts given as ``key, body`` (binary).

    ``n`` is the size of the bag, ``bands`` one hash per band (empty for an
    empty bag), ``slots`` a few bits of every slot.
    """
    ship_package(texts.sparkSession)
    slots = max(SLOTS, bands * rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, part in texts_of(batch.column(1), text_ranges):
                doc, shingle, weight = bags(part)
                sig = signatures(doc, shingle, weight, len(part), slots)
                size = np.bincount(doc, weight, len(part)).astype(np.int64)
                grouped = sig[:, :bands * rows].reshape(len(part), bands, rows)
                band = np.zeros((len(part), bands), np.uint64)
                for r in range(rows):
                    band = mix((band ^ grouped[:, :, r]) * _STEP + np.uint64(r + 1))
                band = mix(band + np.arange(bands, dtype=np.uint64) * _STEP)
                kept = np.where(size > 0, bands, 0)
                bounds = np.concatenate(([0], np.cumsum(kept))).astype(np.int32)
                short = _short(sig)
                longs = short.shape[1]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(lo, hi - lo), pa.array(size),
                    pa.ListArray.from_arrays(pa.array(bounds), pa.array(band[size > 0].ravel().view(np.int64))),
                    pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1, dtype=np.int32) * longs),
                                             pa.array(short.ravel().view(np.int64)))], ["key", "n", "bands", "slots"])

    return texts.select("key", "body").mapInArrow(run, "key binary, n long, bands array<long>, slots array<long>")


def verified(pairs: DataFrame, docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The pairs ``a, b`` of text keys whose bags are similar enough.

    Texts come to the pairs by two joins, that of ``a`` (which many pairs may
    share) last, so it is not shuffled with the pairs. ``docs`` has ``key,
    body``, one row per text that occurs in a pair.
    """
    ship_package(pairs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            ok = np.zeros(len(a), bool)
            for lo, hi in text_ranges([len(x) + len(y) for x, y in zip(a, b)]):
                # equal texts follow each other, so each is cut into shingles once
                distinct = {t: i for i, t in enumerate(dict.fromkeys(a[lo:hi] + b[lo:hi]))}
                doc, shingle, weight = bags(list(distinct))
                edge = np.searchsorted(doc, np.arange(len(distinct) + 1))
                of = lambda t: slice(edge[distinct[t]], edge[distinct[t] + 1])  # noqa: B023, E731
                for k in range(lo, hi):
                    x, y = of(a[k]), of(b[k])
                    ok[k] = _overlap(shingle[x], weight[x], shingle[y], weight[y]) >= threshold
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(ok)) for c in batch.columns[:2]], ["a", "b"])

    left = docs.select(F.col("key").alias("a"), F.col("body").alias("body_a"))
    right = docs.select(F.col("key").alias("b"), F.col("body").alias("body_b"))
    return (pairs.select("a", "b").join(right, "b").join(left, "a").select("a", "b", "body_a", "body_b")
            .mapInArrow(run, "a binary, b binary"))


def components(links: DataFrame) -> DataFrame:
    """``key, root``: the smallest key of every linked key's component.

    Every round a node takes the smallest root among its own, its neighbours'
    and that root's own root (pointer jumping), until nothing changes; each
    round's table is written, so a lost executor costs one round's tasks.
    """
    links = written(links.select("a", "b"), "minhash-links")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    roots = written(both.groupBy(F.col("a").alias("key")).agg(F.least(F.min("b"), F.col("key")).alias("root")), "minhash-roots")
    while True:
        known = small_or_shuffled(roots)
        near = both.join(known, both.b == known.key).groupBy(F.col("a").alias("key")).agg(F.min("root").alias("near"))
        step = roots.join(near, "key", "left").select("key", "root", F.least("root", F.coalesce("near", "root")).alias("next"))
        up = small_or_shuffled(roots.select(F.col("key").alias("next"), F.col("root").alias("above")))
        fresh = written(step.join(up, "next", "left").select(
            "key", F.least("next", F.coalesce("above", "next")).alias("root"),
            (F.least("next", F.coalesce("above", "next")) != F.col("root")).alias("moved")), "minhash-roots")
        roots = fresh.select("key", "root")
        if not fresh.where("moved").limit(1).count():
            return roots


class _Rows:
    """Members of open buckets as arrays: a batch of them, or outsiders that are held."""

    def __init__(self, batch: pa.RecordBatch):
        column = lambda name: batch.column(batch.schema.get_field_index(name))
        wide = lambda name: column(name).flatten().to_numpy().view(np.uint64).reshape(batch.num_rows, -1)
        self.bucket, self.chunk, self.n = (column(c).to_numpy() for c in ("bucket", "chunk", "n"))
        self.own, self.inside, self.star = (column(c).to_numpy(zero_copy_only=False) for c in ("own", "inside", "star"))
        self.slots, self.bands, self.body = wide("slots"), wide("bands"), column("body")
        self.key, self.root = column("key").to_pylist(), column("root").to_pylist()


class _Outsiders:
    """The outsiders of one bucket and chunk; every member of the bucket meets them."""

    def __init__(self, bucket: int, threshold: float, slots: int):
        self.bucket, self.threshold, self.most = bucket, threshold, most_different_slots(slots, threshold)
        self.n, self.star = np.zeros(0, np.int64), np.zeros(0, bool)
        self.slots = self.bands = None
        self.key, self.root, self.body, self.bag = [], [], [], {}
        self.number: dict[bytes, int] = {}  # of the outsiders' roots
        self.of = np.zeros(0, np.int64)
        self.joined: set[tuple[bytes, bytes]] = set()

    def hold(self, rows: _Rows, lo: int, hi: int) -> None:
        self.n, self.star = np.append(self.n, rows.n[lo:hi]), np.append(self.star, rows.star[lo:hi])
        self.slots, self.bands = (new[lo:hi] if old is None else np.concatenate((old, new[lo:hi]))
                                  for old, new in ((self.slots, rows.slots), (self.bands, rows.bands)))
        self.key += rows.key[lo:hi]
        self.root += rows.root[lo:hi]
        self.body += rows.body.slice(lo, hi - lo).to_pylist()
        self.of = np.append(self.of, [self.number.setdefault(r, len(self.number)) for r in rows.root[lo:hi]])

    def meet(self, rows: _Rows, lo: int, hi: int) -> Iterator[tuple[bytes, bytes]]:
        """Roots of two classes that a similar pair of an outsider and a row joins."""
        held, own = len(self.key), int(rows.own[lo:hi].sum())
        if own:  # they come first
            self.hold(rows, lo, lo + own)
        if not self.key:
            return
        n = rows.n[lo:hi]
        root = np.array([self.number.get(r, -1) for r in rows.root[lo:hi]])
        # outsiders of this chunk meet those before them
        after = np.where(rows.own[lo:hi], held + np.arange(hi - lo), len(self.key))
        mask = (self.of[:, None] != root) & (np.arange(len(self.key))[:, None] < after)
        mask &= np.minimum(self.n[:, None], n) >= self.threshold * np.maximum(self.n[:, None], n)
        mask &= ~(self.star[:, None] | rows.star[lo:hi])  # the star has met all
        one, two = np.nonzero(mask)
        two += lo
        for at in range(0, len(one), PAIRS):
            i, j = one[at:at + PAIRS], two[at:at + PAIRS]
            close = different_slots(self.slots[i], rows.slots[j]) <= self.most
            i, j = i[close], j[close]
            # a pair is taken in the first bucket that it shares, and there once
            band = (self.bands[i] == rows.bands[j]).argmax(axis=1)
            first = rows.bands[j, band].view(np.int64) == self.bucket
            yield from self.similar(rows, i[first].tolist(), j[first].tolist())

    def similar(self, rows: _Rows, one: list[int], two: list[int]) -> Iterator[tuple[bytes, bytes]]:
        pairs = {}
        for i, j in zip(one, two):
            if rows.own[j] or rows.inside[j] or self.key[i] < rows.key[j]:
                pairs.setdefault(j, []).append(i)
        held = sorted({i for some in pairs.values() for i in some} - self.bag.keys())
        self.bag.update(zip(held, _each_bag([self.body[i] for i in held])))
        for (j, some), y in zip(pairs.items(), _each_bag([rows.body[j].as_py() for j in pairs])):
            for i in some:
                link = min(self.root[i], rows.root[j]), max(self.root[i], rows.root[j])
                if link not in self.joined and _overlap(*self.bag[i], *y) >= self.threshold:
                    self.joined.add(link)
                    yield link


def _each_bag(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Shingles and weights of each text."""
    for lo, hi in text_ranges([len(t) for t in texts]):
        doc, shingle, weight = bags(texts[lo:hi])
        edge = np.searchsorted(doc, np.arange(hi - lo + 1))
        for a, b in zip(edge, edge[1:]):
            yield shingle[a:b], weight[a:b]


def class_links(members: DataFrame, threshold: float = THRESHOLD, slots: int = SLOTS) -> DataFrame:
    """``a, b``: roots of classes that a similar pair of a bucket's members joins.

    One row per member and chunk of its bucket's outsiders: ``bucket, chunk, own``
    (an outsider of this chunk), ``inside`` (of the largest class), ``star, key,
    root, n, slots, bands, body``.
    """
    ship_package(members.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = block = None
        for batch in batches:
            rows, found = _Rows(batch), set()
            edge = np.ones(batch.num_rows, bool)
            edge[1:] = (rows.bucket[1:] != rows.bucket[:-1]) | (rows.chunk[1:] != rows.chunk[:-1])
            begin = np.flatnonzero(edge).tolist()
            for lo, hi in zip(begin, [*begin[1:], batch.num_rows]):
                here = int(rows.bucket[lo]), int(rows.chunk[lo])
                if here != last:
                    last, block = here, _Outsiders(here[0], threshold, slots)
                found.update(block.meet(rows, lo, hi))
            yield pa.RecordBatch.from_arrays([pa.array([link[k] for link in found], pa.binary()) for k in (0, 1)], ["a", "b"])

    return (members.select("bucket", "chunk", "own", "inside", "star", "key", "root", "n", "slots", "bands", "body")
            .repartition("bucket", "chunk").sortWithinPartitions("bucket", "chunk", F.col("own").desc())
            .mapInArrow(run, "a binary, b binary"))


def text_classes(docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``key, root`` of all texts that are similar to another text.

    ``docs`` has ``key, body`` and may repeat texts.
    """
    sketches = written(sketch(docs, bands, rows), "minhash-sketches")
    texts = written(sketches.groupBy("key").agg(F.first("n").alias("n"), F.first("bands").alias("bands"),
                                                F.first("slots").alias("slots")).where("n > 0"), "minhash-texts")
    spread = texts.select("key", F.explode("bands").alias("bucket"))
    full = spread.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1")
    shared = written(spread.join(full, "bucket"), "minhash-shared")
    # a bucket's star is the member that meets most others in all its buckets: of
    # a group of copies that is the text nearest to all of them
    degree = shared.groupBy("key").agg(F.sum("members").alias("degree"))
    stars_of = (shared.select("bucket", "key").join(degree, "key").groupBy("bucket")
                .agg(F.max(F.struct("degree", "key")).alias("best")).select("bucket", F.col("best.key").alias("first")))
    buckets = written(shared.join(stars_of, "bucket"), "minhash-buckets")

    def bodies_of(wanted: DataFrame) -> DataFrame:
        return docs.select("key", "body").join(wanted, "key", "left_semi").dropDuplicates(["key"])

    def bodies(pairs: DataFrame) -> DataFrame:
        return written(bodies_of(small_or_shuffled(written(
            pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct(), "minhash-wanted"))), "minhash-bodies")

    stars = written(buckets.where("key != first").select(
        F.least("first", "key").alias("a"), F.greatest("first", "key").alias("b")).distinct(), "minhash-stars")
    roots = components(verified(stars, bodies(stars), threshold))

    # buckets in which several classes are left: of two members of different
    # classes one at least is outside the bucket's largest class
    state = buckets.join(roots, "key", "left").select("bucket", "key", "first", F.coalesce("root", "key").alias("root"))
    mixed = (state.join(texts.select("key", "n"), "key").groupBy("bucket", "root")
             .agg(F.count("*").alias("n"), F.sum("n").alias("shingles")).groupBy("bucket")
             .agg(F.max(F.struct("n", "root", "shingles")).alias("major"), F.sum("n").alias("n"),
                  F.sum("shingles").alias("shingles"), F.count("*").alias("roots")).where("roots > 1")
             .select("bucket", F.col("major.root").alias("major"), F.greatest(
                 F.ceil((F.col("n") - F.col("major.n")) / CHUNK),
                 F.ceil((F.col("shingles") - F.col("major.shingles")) / CHUNK_SHINGLES)).cast("int").alias("chunks")))
    open_ = written(state.join(mixed, "bucket").select(
        "bucket", "key", "root", "chunks", (F.col("root") == F.col("major")).alias("inside"),
        (F.col("key") == F.col("first")).alias("star")), "minhash-open")
    wanted = small_or_shuffled(written(open_.select("key").distinct(), "minhash-wanted"))
    members = (open_.join(texts.join(wanted, "key", "left_semi"), "key").join(bodies_of(wanted), "key")
               .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
               .withColumn("own", ~F.col("inside") & (F.pmod(F.hash("key"), F.col("chunks")) == F.col("chunk"))))
    more = written(class_links(members, threshold, max(SLOTS, bands * rows)), "minhash-class-links")
    if not more.limit(1).count():
        return roots
    merged = components(more).select(F.col("key").alias("old"), F.col("root").alias("new"))
    alone = merged.join(roots, merged.old == roots.key, "left_anti").select(F.col("old").alias("key"), F.col("new").alias("root"))
    return roots.join(merged, roots.root == merged.old, "left").select("key", F.coalesce("new", "root").alias("root")).unionByName(alone)


def near_classes(docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """The class of every row: ``doc_id, key, class_id, class_rows, kept``.

    ``key`` is the MD5 of the text, ``class_id`` the smallest doc_id of the
    class, ``class_rows`` its number of rows; ``kept`` is true for one row of
    each class, one with that id. A table in the shared scratch folder.
    """
    body = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    narrow = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("key"),
                                 F.monotonically_increasing_id().alias("row")), "minhash-rows")
    texts = narrow.groupBy("key").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), "row")).alias("own"),
        F.count("*").alias("copies"))
    roots = text_classes(docs.select(text_key(F.col("text")).alias("key"), body.alias("body")), threshold, bands, rows)
    known = written(texts.join(roots, "key", "left").select("key", "own", "copies", F.coalesce("root", "key").alias("root")),
                    "minhash-known")
    classes = known.groupBy("root").agg(F.min("own").alias("best"), F.sum("copies").alias("class_rows"))
    of_text = known.join(classes, "root").select("key", "best", "class_rows")
    return written(narrow.join(of_text, "key").select(
        "doc_id", "key", F.col("best.id").alias("class_id"), "class_rows", (F.col("best.row") == F.col("row")).alias("kept")),
        "minhash-classes")


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one row of every class, and its columns.

    Rows are dropped by text and id; of rows that repeat the kept one's text and
    id one stays.
    """
    classes = near_classes(docs.select("doc_id", "text"), threshold)
    per = classes.groupBy("key", "doc_id").agg(F.max("kept").alias("kept"), F.count("*").alias("n"))
    key, gone = "_key", "_gone"
    while key in docs.columns or gone in docs.columns:
        key, gone = key + "_", gone + "_"
    keyed = docs.withColumn(key, text_key(F.col("text")))
    same = (F.col(key) == F.col(f"{gone}.key")) & F.col("doc_id").cast("long").eqNullSafe(F.col(f"{gone}.doc_id"))

    def listed(rows: DataFrame) -> DataFrame:
        return small_or_shuffled(written(rows.select(F.struct("key", "doc_id").alias(gone)), "minhash-dropped"))

    left = keyed.join(listed(per.where(~F.col("kept"))), same, "left_anti")
    repeated = per.where("kept and n > 1")
    if repeated.limit(1).count():
        twice = listed(repeated)
        left = left.join(twice, same, "left_anti").unionByName(left.join(twice, same, "left_semi").dropDuplicates([key]))
    return left.select(*docs.columns)


def op7_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return near_classes(docs).select("doc_id", "class_id", "class_rows", "kept")

"""Near duplicates: all pairs of documents whose word shingles have a Jaccard similarity of a threshold or more, exactly.

Method: universe-partition pigeonhole. Sets are handled in bands of sizes. In a band the hash universe is cut into segments; the
part of a set in a segment is one signature. Two sets with a similarity of t differ in at most ``(1 - t) / (1 + t)`` times the sum of
their sizes, so among any H + 1 non-empty segments of a set at least one is equal in every partner (H: that bound over all possible
partners in the band). Every set gives its first H + 1 signatures in the order of the universe; two sets both give the segments
up to the nearer of their last ones, so they meet.

Allocation by cost: signatures that a great many documents share (found by mergeable Misra-Gries counters, a bounded list) are
skipped, budget 0, as long as H + 1 others are left. A set that has too few gives all its signatures; if even these are too
few, it adds the one-deletion neighbourhoods of its segments of two and more shingles, which count twice; and if that
is not enough, its first H + 1 shingles. A pair meets at the first level at which one of the two has enough, as the other
has then given all of the level as well.

From signatures to links: the members of a signature are tied to its smallest document as a star. The partner with most common
signatures is verified first, which joins most groups of near copies at once. Only pairs that share a signature and are
still in different components are looked at further, and signatures with the same members only once: first by the number of signatures
they share (of the first H + 1 of one of them all but the differing ones, which sizes close to each other allow fewer of), by a bound from
histograms of the sets (exact, it only discards pairs that cannot be similar), with a bin for about four shingles compared in blocks
inside tasks and then with about as many bins as shingles, at last by exact comparison of the whole sets. No group of
copies is expanded into its pairs, and no link between different components is left out, so the components are exact.

Defined cases: null and empty texts have the empty set and no links. Rows with a null id take no part and have a null component. Rows
that repeat an id are one document with the links of all its rows. Ids are bigints. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellflow.llm.common import arrow_bytes, quoted, stored, text_of
from cellflow.llm.components import components
from cellflow.llm.shingles import PIECE, Sets, mixed, shingle_sets, words_collide

WIDTH = 5
#: Similarity as a fraction: intersection * DEN >= union * NUM.
NUM, DEN = 3, 4
#: Sizes of a band are within this factor, and segments per shingle of its largest set.
BAND, SEGMENTS = 1.5, 0.45
#: Counters of a task's summary of frequent signatures; the merged list is no longer than this and one.
COUNTERS = 20_000
#: A signature is worth skipping from so many documents on.
COMMON = 48
#: A histogram has a power of two of bins. The coarse one has about one for every SHARE shingles: unlike sets of n shingles then differ in some
#: 0.57 n of them and similar ones in 0.29 n, whatever n is. The fine one has at least as many bins as the set has shingles.
BINS, SHARE, MOST_COARSE, MOST_BINS = 128, 4, 1 << 13, 1 << 16
#: Numbers of histograms that are compared at a time.
COMPARED = 1 << 22
#: Documents in a block of a signature whose members are compared with each other.
BLOCK = 1024
#: Bits of the filter that names the documents whose texts are fetched: 4 MB whatever the input.
FILTER_BITS = 1 << 25


def bands(largest: int) -> list[int]:
    """Least sizes of the bands up to a size; a set of one or two shingles equals its partners and needs none."""
    out = [3]
    while out[-1] <= largest:
        out.append(max(out[-1] + 1, int(out[-1] * BAND)))
    return out


_EDGES = np.array(bands(1 << 40), dtype=np.int64)


def differ_most(s: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Largest symmetric difference of similar sets of these sizes."""
    return ((DEN - NUM) * (s + t)) // (DEN + NUM)


def _grouped(flags: np.ndarray, values: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, np.flatnonzero(flags)) if len(values) else values[:0]


def needed(size: np.ndarray, band: np.ndarray) -> np.ndarray:
    """H + 1: one more than a set of this size can differ from a partner in a pair whose smaller set is of the band."""
    top = _EDGES[band + 1] - 1  # the largest size of the band
    return differ_most(size, np.where(size > top, top, size * DEN // NUM)) + 1


def signatures(sets: Sets, common: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, signature) of all sets, and the texts that had too few of the first level; texts count from the piece's first.

    common: sorted signatures to be skipped.
    """
    sizes, starts = sets.sizes, sets.starts
    own = np.searchsorted(_EDGES, sizes, side="right") - 1
    least = np.searchsorted(_EDGES, -(-sizes * NUM // DEN), side="right") - 1
    out: list[tuple[np.ndarray, np.ndarray]] = []
    for below in range(int(np.max(own - np.maximum(least, 0), initial=0)) + 1):
        band = own - below
        texts = np.flatnonzero((band >= 0) & (band >= least))
        if len(texts):
            out.append(_of_band(sets, starts, texts, band[texts], common))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate([o[0] for o in out]), np.concatenate([o[1] for o in out]), np.unique(np.concatenate([o[2] for o in out]))


def _of_band(sets: Sets, starts: np.ndarray, texts: np.ndarray, band: np.ndarray, common: np.ndarray):
    size = sets.sizes[texts]
    need = needed(size, band)
    top = _EDGES[band + 1] - 1
    m = np.maximum(1, np.ceil(SEGMENTS * top)).astype(np.uint64)
    row = np.repeat(np.arange(len(texts)), size)
    at = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(starts[texts], size)
    h = sets.hashes[at]
    segment = ((h >> np.uint64(32)) * m[row]) >> np.uint64(32)
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (segment[1:] != segment[:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(row)))
    srow, sseg = row[first], segment[first]
    place = sseg * np.uint64(0xD6E8FEB86659FD93) + band[srow].astype(np.uint64) * np.uint64(0xA0761D6478BD642F)
    part = mixed(h, 1)
    total = _grouped(new, part)
    exact = mixed(total + place, 2)
    cold = np.ones(len(exact), dtype=bool)
    if len(common):
        where = np.minimum(np.searchsorted(common, exact), len(common) - 1)
        cold = common[where] != exact
    n_cold = np.bincount(srow, cold, minlength=len(texts)).astype(np.int64)
    n_all = np.bincount(srow, minlength=len(texts))
    n_two = np.bincount(srow, count >= 2, minlength=len(texts)).astype(np.int64)
    begin = np.cumsum(n_all) - n_all
    so_far = np.cumsum(cold)
    rank = so_far - (so_far - cold)[begin[srow]]
    short = n_cold < need
    keep = short[srow] | (cold & (rank <= need[srow]))
    out_row, out_sig = [srow[keep]], [exact[keep]]
    fewer = short & (n_all < need)
    if fewer.any():  # one shingle left out, of every segment with two and more
        of = np.repeat(np.arange(len(first)), count)
        drop = fewer[row] & (count >= 2)[of]
        out_row.append(row[drop])
        out_sig.append(mixed(total[of[drop]] - part[drop] + place[of[drop]], 2))
        # an exact part is met by a larger one without one shingle: both are signatures of the same place
    fewest = fewer & (n_all + n_two < need)
    if fewest.any():
        nth = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
        lone = fewest[row] & (nth < need[row])
        out_row.append(row[lone])
        out_sig.append(mixed(h[lone] + band[row[lone]].astype(np.uint64), 3))
    return texts[np.concatenate(out_row)], np.concatenate(out_sig), texts[short]


def pruned(keys: np.ndarray, counts: np.ndarray, counters: int) -> tuple[np.ndarray, np.ndarray]:
    """A Misra-Gries summary cut back to its counters."""
    if len(keys) <= counters:
        return keys, counts
    cut = np.partition(counts, len(counts) - counters - 1)[len(counts) - counters - 1]
    left = counts > cut
    return keys[left], counts[left] - cut


def _digests(sets: Sets) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of every set."""
    full = np.flatnonzero(sets.sizes)
    out = np.zeros((2, len(sets.sizes)), dtype=np.uint64)
    for k in (0, 1):
        if len(full):
            out[k, full] = np.add.reduceat(mixed(sets.hashes, 11 + k), sets.starts[full])
    return out[0], out[1]


def _histograms(sets: Sets, shingles: int, most: int) -> list[bytes]:
    """A histogram of each set with about so many shingles a bin, cut at 255."""
    bins = np.clip(1 << np.ceil(np.log2(np.maximum(sets.sizes, 1) / shingles)).clip(0).astype(np.int64), BINS, most)
    begin = np.cumsum(bins) - bins
    row = np.repeat(np.arange(len(sets.sizes)), sets.sizes)
    at = begin[row] + (sets.hashes % bins[row].astype(np.uint64)).astype(np.int64)
    flat = np.minimum(np.bincount(at, minlength=int(bins.sum())), 255).astype(np.uint8).tobytes()
    return [flat[b:b + n] for b, n in zip(begin.tolist(), bins.tolist(), strict=True)]


def folded(histogram: np.ndarray, bins: int) -> np.ndarray:
    """A histogram with fewer bins, as if it had been made so: it is cut at 255 again."""
    return np.minimum(histogram.reshape(-1, bins).sum(axis=0, dtype=np.int64), 255).astype(np.int16)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, Sets]]:
    for batch in batches:
        for sets in shingle_sets(batch.column(1), WIDTH):
            yield batch.column(0).slice(sets.first, len(sets.sizes)), sets


class _Unseen:
    """Leaves out sets that this task has met before."""

    def __init__(self):
        self.seen: set[tuple[int, int]] = set()

    def __call__(self, sets: Sets) -> np.ndarray:
        a, b = _digests(sets)
        new = np.zeros(len(a), dtype=bool)
        for i, key in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
            if key not in self.seen:
                self.seen.add(key)
                new[i] = True
        return new


SET_SCHEMA = "id bigint, n int, d1 bigint, d2 bigint, bins binary, fine binary, signature bigint, count bigint"


def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size, digest and histogram of every set; at the end the task's frequent signatures."""
    keys, counts, unseen = np.zeros(0, np.uint64), np.zeros(0, np.int64), _Unseen()
    schema = pa.schema([("id", pa.int64()), ("n", pa.int32()), ("d1", pa.int64()), ("d2", pa.int64()), ("bins", pa.binary()), ("fine", pa.binary()),
                        ("signature", pa.int64()), ("count", pa.int64())])
    for ids, sets in _pieces(batches):
        a, b = _digests(sets)
        rows = len(ids)
        none = pa.nulls(rows, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [ids.cast(pa.int64()), pa.array(sets.sizes.astype(np.int32)), pa.array(a.view(np.int64)), pa.array(b.view(np.int64)),
             pa.array(_histograms(sets, SHARE, MOST_COARSE), pa.binary()), pa.array(_histograms(sets, 1, MOST_BINS), pa.binary()), none, none],
            schema=schema)
        new = unseen(sets)
        text, found, _ = signatures(sets, np.zeros(0, np.uint64))
        values, n = np.unique(found[new[text]], return_counts=True)
        keys, back = np.unique(np.concatenate([keys, values]), return_inverse=True)
        counts = np.bincount(back, np.concatenate([counts, n]), minlength=len(keys)).astype(np.int64)
        keys, counts = pruned(keys, counts, COUNTERS)
    keys, counts = keys[counts > 1], counts[counts > 1]  # what a task met once says nothing about costs
    none = lambda kind: pa.nulls(len(keys), kind)
    yield pa.RecordBatch.from_arrays(
        [none(pa.int64()), none(pa.int32()), none(pa.int64()), none(pa.int64()), none(pa.binary()), none(pa.binary()), pa.array(keys.view(np.int64)), pa.array(counts)],
        schema=schema)


def emit(common: np.ndarray):
    """(signature, id, marker) of all sets; a marker is no signature but says that the set went beyond the first level."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unseen = _Unseen()
        for ids, sets in _pieces(batches):
            new = unseen(sets)
            text, found, short = signatures(sets, common)
            text, found = np.concatenate([text, short]), np.concatenate([found, mixed(short.astype(np.uint64) + np.uint64(sets.first << 20), 4)])
            marker = np.arange(len(text)) >= len(text) - len(short)
            keep = new[text]
            yield pa.RecordBatch.from_arrays(
                [pa.array(found[keep].view(np.int64)), ids.cast(pa.int64()).take(pa.array(text[keep])), pa.array(marker[keep])], ["signature", "id", "marker"])

    return run


def stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (signature, id) to (signature, id, leader, more) of all members but the smallest; markers pass with no leader.

    Only the last row and the leader of an open run are carried over, so a signature may have any number of members. more: the run is
    known to have three members or more.
    """
    last, leader, length = None, 0, 0
    for batch in batches:
        marks = batch.filter(batch.column(2))
        if marks.num_rows:
            yield pa.RecordBatch.from_arrays(
                [marks.column(0), marks.column(1), pa.nulls(marks.num_rows, pa.int64()), pa.nulls(marks.num_rows, pa.bool_())],
                ["signature", "id", "leader", "more"])
            batch = batch.filter(pc.invert(batch.column(2)))
        s, d = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        if not len(s):
            continue
        same = np.zeros(len(s), dtype=bool)
        same[1:] = s[1:] == s[:-1]
        again = np.zeros(len(s), dtype=bool)
        again[1:] = same[1:] & (d[1:] == d[:-1])
        if last is not None and s[0] == last[0]:
            same[0] = True
            again[0] = d[0] == last[1]
        run = np.cumsum(~same) - 1  # -1: goes on from the batch before
        heads = d[~same]
        lead = np.where(run < 0, leader, heads[np.maximum(run, 0)]) if len(heads) else np.full(len(s), leader)
        members = np.bincount(run[~again] + 1, minlength=int(run[-1]) + 2)
        members[0] += length if run[0] < 0 else 0
        keep = ~again & (d != lead)
        more = members[run + 1] > 2
        # the last run may grow: a pair there is kept as a larger run
        more |= run == run[-1]
        yield pa.RecordBatch.from_arrays(
            [pa.array(s[keep]), pa.array(d[keep]), pa.array(lead[keep]), pa.array(more[keep])], ["signature", "id", "leader", "more"])
        last, leader, length = (s[-1], d[-1]), lead[-1], int(members[run[-1] + 1])


def enough_shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, shared, n_a, n_b, any) to the (a, b) that share as many signatures as a similar pair of these sizes must.

    Of the first H + 1 signatures of one of the two, those that differ are at most as many as shingles differ. any: pairs of which this
    is not known, as both went beyond the first level or an id repeats.
    """
    for batch in batches:
        shared, n, m = (batch.column(i).to_numpy().astype(np.int64) for i in (2, 3, 4))
        band = np.maximum(np.searchsorted(_EDGES, np.minimum(n, m), side="right") - 1, 0)
        least = np.minimum(needed(n, band), needed(m, band)) - differ_most(n, m)
        mask = pa.array((shared >= least) | batch.column(5).to_numpy(zero_copy_only=False).astype(bool))
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], ["a", "b"])


def close_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, n_a, n_b, fine_a, fine_b) to the (a, b) that may be similar."""
    for batch in batches:
        n, m = (batch.column(i).to_numpy().astype(np.int64) for i in (2, 3))
        most = differ_most(n, m)
        keep = np.zeros(batch.num_rows, dtype=bool)
        for i in range(batch.num_rows):
            x, y = (np.frombuffer(batch.column(c)[i].as_buffer(), dtype=np.uint8) for c in (4, 5))
            bins = min(len(x), len(y))
            gap = np.abs(folded(x, bins) - folded(y, bins)).sum(dtype=np.int64)
            keep[i] = gap <= most[i] and DEN * min(n[i], m[i]) >= NUM * max(n[i], m[i])
        mask = pa.array(keep)
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], ["a", "b"])


def close_in_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (signature, i, j) and of one pair of blocks each time, to the (a, b, shared) of different components that may be similar.

    shared: how many signatures have these members. An id that repeats has several sets, so its histogram discards nothing here. A pair of blocks has few members (about twice BLOCK); they are held together.
    """
    held: list[pa.RecordBatch] = []
    key = None

    def pairs(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(parts)
        ids, parent, n, rows, block, weight = (table.column(c).to_numpy() for c in ("id", "component", "n", "rows", "block", "weight"))
        n = n.astype(np.int64)
        histograms = [np.frombuffer(h, dtype=np.uint8) for h in table.column("bins").to_pylist()]
        width = np.array([len(h) for h in histograms])
        tables: dict[int, np.ndarray] = {}  # by number of bins: the histograms with at least so many
        places = np.zeros(len(ids), dtype=np.int64)

        def near(x: np.ndarray, y: np.ndarray) -> np.ndarray:
            """Which pairs are close enough, by the bins that both have."""
            out = np.zeros(len(x), dtype=bool)
            both = np.minimum(width[x], width[y])
            for bins in np.unique(both).tolist():
                wide = width >= bins
                if bins not in tables:
                    tables[bins] = np.stack([folded(h, bins) for h, w in zip(histograms, wide.tolist(), strict=True) if w])
                places[wide] = np.arange(int(wide.sum()))
                at = np.flatnonzero(both == bins)
                for part in np.array_split(at, -(-len(at) * bins // COMPARED)):
                    gap = np.abs(tables[bins][places[x[part]]] - tables[bins][places[y[part]]]).sum(axis=1, dtype=np.int64)
                    out[part] = gap <= differ_most(n[x[part]], n[y[part]])
            return out

        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        out_a, out_b = [], []
        step = max(1, 20_000 // max(1, len(right)))
        for lo in range(0, len(left), step):
            x, y = np.meshgrid(left[lo:lo + step], right, indexing="ij")
            x, y = x.ravel(), y.ravel()
            other = parent[x] != parent[y]
            other &= (DEN * np.minimum(n[x], n[y]) >= NUM * np.maximum(n[x], n[y])) | (rows[x] > 1) | (rows[y] > 1)
            if i == j:
                other &= x < y
            x, y = x[other], y[other]
            kept = near(x, y) | (rows[x] > 1) | (rows[y] > 1)
            out_a.append(ids[x[kept]])
            out_b.append(ids[y[kept]])
        a = np.concatenate(out_a) if out_a else np.zeros(0, np.int64)
        b = np.concatenate(out_b) if out_b else np.zeros(0, np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(np.full(len(a), weight[0], np.int64))], ["a", "b", "shared"])

    for batch in batches:
        keys = np.stack([batch.column(c).to_numpy() for c in range(3)])
        cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            if lo == hi:
                continue
            own = tuple(keys[:, lo].tolist())
            if own != key and held:
                yield pairs(held)
                held = []
            key = own
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield pairs(held)


def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, text_a, text_b) to the (a, b) whose sets are similar.

    Sets are compared by the hashes of their shingles after all words of the texts that share a hash were compared themselves; if two of
    them differ, the sets are made of words.
    """
    for batch in batches:
        for part in _short(batch):
            if words_collide(pa.chunked_array([part.column(2), part.column(3)]).combine_chunks()):
                both = [[_spelled(t) for t in part.column(c).to_pylist()] for c in (2, 3)]
                shared = lambda x, y: len(x & y)
            else:
                both = [_listed(part.column(c)) for c in (2, 3)]
                shared = lambda x, y: len(np.intersect1d(x, y, assume_unique=True))
            keep = []
            for x, y in zip(*both, strict=True):
                common = shared(x, y) if DEN * min(len(x), len(y)) >= NUM * max(len(x), len(y)) else 0
                keep.append(common > 0 and DEN * common >= NUM * (len(x) + len(y) - common))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([part.column(0).filter(mask), part.column(1).filter(mask)], ["a", "b"])


def _short(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch of pairs of texts in parts of at most 256 pairs and PIECE bytes; a longer pair is a part of its own."""
    size = sum(pc.fill_null(pc.binary_length(batch.column(c)), 0).to_numpy().astype(np.int64) for c in (2, 3))
    upto, lo = np.cumsum(size), 0
    while lo < batch.num_rows:
        hi = int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + PIECE, side="right"))
        hi = max(lo + 1, min(hi, lo + 256))
        yield batch.slice(lo, hi - lo)
        lo = hi


def _spelled(text: str | None) -> set[tuple[bytes, ...]]:
    """The shingles of a text as words."""
    words = (text or "").encode().lower().split()  # of bytes: A-Z, and the white space of the contract
    return {tuple(words[i:i + WIDTH]) for i in range(max(1, len(words) - WIDTH + 1))} if words else set()


def _listed(texts: pa.Array) -> list[np.ndarray]:
    out = []
    for sets in shingle_sets(texts, WIDTH):
        out += np.split(sets.hashes, sets.starts[1:-1])
    return out


def wanted(frame: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of a frame whose id is among ids, and few others.

    A bitmap of fixed size is made by an aggregate and sent to all tasks, so that what belongs to other documents is not shuffled.
    """
    place = F.pmod(F.xxhash64("id"), F.lit(FILTER_BITS)) + 1  # Spark numbers bit p as bit (p - 1) % 32768 of bucket (p - 1) / 32768 + 1
    rows = ids.select(place.alias("p")).groupBy(F.bitmap_bucket_number("p").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits")).collect()
    bits = np.zeros(FILTER_BITS // 8, dtype=np.uint8)
    for r in rows:
        at = (r["bucket"] - 1) * 4096
        bits[at:at + 4096] = np.frombuffer(r["bits"], dtype=np.uint8)
    sent = frame.sparkSession.sparkContext.broadcast(bits.tobytes())
    names = frame.columns

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(sent.value, dtype=np.uint8)
        for batch in batches:
            p = batch.column(len(names)).to_numpy() - 1
            mask = pa.array(((bits[p >> 3] >> (p & 7)) & 1).astype(bool))
            yield pa.RecordBatch.from_arrays([c.filter(mask) for c in batch.columns[:-1]], names)

    return frame.where("id IS NOT NULL").withColumn("p", place).mapInArrow(chosen, frame.schema)


def both_sides(pairs: DataFrame, frame: DataFrame) -> DataFrame:
    """Pairs (a, b) with the other columns of the frame for both ids, named c_a and c_b. pairs is a stored table."""
    rows = wanted(frame, pairs.select(F.explode(F.array("a", "b")).alias("id")))
    for side in ("a", "b"):
        pairs = pairs.join(rows.select(F.col("id").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in rows.columns if c != "id"]), side)
    return pairs


def verified(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) whose texts are similar. pairs is a stored table."""
    both = both_sides(pairs, docs).select("a", "b", "text_a", "text_b")
    return stored(both.mapInArrow(similar, "a bigint, b bigint"), "links")


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: id, ``n_shingles`` and ``component_id``, the smallest id that links reach."""
    with arrow_bytes(docs.sparkSession):  # all jobs with Python run here, what is returned has none
        return _joined(docs, id_column, text)


def _joined(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    own = docs.select(F.col(quoted(id_column)).cast("bigint").alias("id"), text_of(text).alias("text"))
    told = stored(own.mapInArrow(describe, SET_SCHEMA), "sets")
    sets = told.where("n IS NOT NULL")
    linkable = sets.where("n > 0 AND id IS NOT NULL")
    # stored, so that both sides of the join come straight from an exchange and a large group of copies is split
    first = stored(linkable.groupBy("d1", "d2").agg(F.min("id").alias("a")), "copies")
    copies = linkable.join(first, ["d1", "d2"]).select("a", F.col("id").alias("b")).where("a < b")

    summaries = told.where("signature IS NOT NULL").groupBy("signature").agg(F.sum("count").alias("count"))
    total = summaries.agg(F.sum("count")).first()[0] or 0
    frequent = summaries.where(F.col("count") >= max(COMMON, total / (COUNTERS + 1))).select("signature").collect()
    common = np.sort(np.array([r[0] for r in frequent], dtype=np.int64).view(np.uint64))

    met = own.where("id IS NOT NULL").mapInArrow(emit(common), "signature bigint, id bigint, marker boolean")
    shared = stored(
        met.repartition("signature").sortWithinPartitions("signature", "id")
        .mapInArrow(stars, "signature bigint, id bigint, leader bigint, more boolean"), "shared")
    short = shared.where("leader IS NULL").select("id").distinct().withColumn("short", F.lit(True))
    shared = shared.where("leader IS NOT NULL")
    counted = linkable.groupBy("id").agg(F.first("n").alias("n"), F.first("bins").alias("bins"), F.count("*").alias("rows"))
    coarse = stored(counted.join(short, "id", "left").withColumn("short", F.coalesce("short", F.lit(False))), "histograms")
    fine = linkable.select("id", "n", "fine")

    def close(pairs: DataFrame) -> DataFrame:
        """Repeated ids meet as several rows; a pair stays if any of them may be similar."""
        sides = both_sides(pairs, fine).select("a", "b", "n_a", "n_b", "fine_a", "fine_b")
        return stored(sides.mapInArrow(close_pairs, "a bigint, b bigint").distinct(), "close")

    star = stored(shared.groupBy(F.col("leader").alias("a"), F.col("id").alias("b")).agg(F.count("*").alias("n")), "stars")
    best = star.groupBy("b").agg(F.max_by("a", F.struct("n", "a")).alias("a"))
    links = copies.unionByName(verified(own, close(stored(best.select("a", "b"), "pairs"))))
    so_far = stored(components(links), "components")

    def parent(frame: DataFrame, column: str, name: str) -> DataFrame:
        known = so_far.select(F.col("node").alias(column), F.col("component").alias("_found"))
        return frame.join(known, column, "left").withColumn(name, F.coalesce("_found", column)).drop("_found")

    # signatures of two documents only
    lone = shared.where("NOT more").groupBy(F.col("leader").alias("a"), F.col("id").alias("b")).agg(F.count("*").alias("shared"))
    lone = parent(parent(lone, "a", "ca"), "b", "cb").where("ca <> cb").select("a", "b", "shared")
    rows = shared.where("more")
    members = rows.select("signature", "id").unionByName(rows.select("signature", F.col("leader").alias("id")).distinct())
    members = stored(parent(members, "id", "component"), "members")
    mixed_runs = members.groupBy("signature").agg(
        F.count("*").alias("members"), F.min("component").alias("low"), F.max("component").alias("high"),
        F.sum(F.xxhash64("id").cast("decimal(38,0)")).alias("x"), F.bit_xor(F.xxhash64("id", F.lit(1))).alias("y"))
    mixed_runs = mixed_runs.where("low <> high").groupBy("members", "x", "y").agg(
        F.min("signature").alias("signature"), F.count("*").alias("weight"))
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    placed = members.join(mixed_runs.select("signature", "weight", blocks.alias("blocks")), "signature")
    placed = placed.join(coarse, "id").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    placed = placed.select("signature", "id", "component", "n", "bins", "rows", "block", "weight", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    placed = placed.select(
        "signature", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "id", "component", "n", "bins", "rows", "block", "weight")
    in_runs = (
        placed.repartition("signature", "i", "j").sortWithinPartitions("signature", "i", "j")
        .mapInArrow(close_in_blocks, "a bigint, b bigint, shared bigint"))
    met_often = lone.unionByName(in_runs).groupBy("a", "b").agg(F.sum("shared").alias("shared"))
    facts = coarse.select("id", "n", "short", (F.col("rows") > 1).alias("several"))
    for side in ("a", "b"):
        met_often = met_often.join(facts.select(*[F.col(c).alias(side if c == "id" else f"{c}_{side}") for c in facts.columns]), side)
    unsure = F.expr("(short_a AND short_b) OR several_a OR several_b")
    rest = met_often.select("a", "b", "shared", "n_a", "n_b", unsure.alias("any")).mapInArrow(enough_shared, "a bigint, b bigint")
    rest = close(stored(rest, "pairs"))
    more_links = verified(own, rest)
    whole = components(links.unionByName(more_links))
    whole = whole.select(F.col("node").alias("id"), F.col("component").alias("component_id"))
    return sets.select("id", "n").join(whole, "id", "left").select(
        F.col("id").alias(id_column), F.col("n").cast("bigint").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"))

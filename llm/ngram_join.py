"""Exact n-gram Jaccard join of texts in metric space (operator 3).

The Jaccard distance is a metric, but word shingles make a space in which nearly all
distances are exactly 1: no choice of document pivots splits it. So the join goes from
cheap pivots to real ones, and every step is lossless for the threshold:

1.  Texts with equal shingle sets are one class.
2.  One-shingle pivots. Under any fixed order of the shingles, two sets that share
    ``alpha`` shingles share ``l`` of their first ``n - alpha + l``. A set of which fewer
    than ``n // 20`` head shingles occur in another head links with nothing.
3.  Among the rest, shingles are ordered by their number of holders. A shingle is the
    pivot of a region: the sets that hold it among their first ``n - alpha + 1``. Linked
    sets meet in a region; sets that chain through regions form a cell.
4.  Document pivots. A cell is joined by pivots: the distance to a pivot is exact, of every
    member that shares enough first shingles with it, by holders in the cell; members within
    the threshold are linked to it and need no comparison with each other; around a pivot of
    many only such stay for the next as the triangle inequality leaves within reach of a
    member outside. A cell too large for one task is first
    dealt to Voronoi regions of several pivots: a set goes to its nearest pivot and, by
    the triangle inequality, to every pivot at most twice the threshold farther. A cell
    whose regions do not halve it is joined as pairs of bounded blocks.

Only a spanning set of links is emitted, never all pairs of a group. Shingles are
64-bit hashes, set identities 128-bit hashes. Cells and links name a set by 63 bits of its
identity; of sets that share these bits each gets a number of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from llm import common
from salesmart.operators.staging import stage

#: Bits of the map of texts that stay after step 2; a full map only filters less.
MAP_BITS = 1 << 25

#: Low bytes of a head shingle and of the set that posts it. Step 2 only filters: equal
#: low bytes of different shingles let more sets pass, never fewer. Sets that share the
#: low bytes of their id all pass.
HEAD_BYTES, OWNER_BYTES = 5, 6

#: Shingles that a task counts at once in search of the frequent ones.
SKETCH_KEYS = 200_000


@dataclass(frozen=True)
class Join:
    """words: words of a shingle. percent: least 100 * shared / union of a link.
    bucket_postings: (shingle, set) rows of a task. heavy_keys: how many of the most
    frequent shingles are broadcast (8 bytes each and a count). leaf_shingles: largest
    cell, in shingles, joined in one task. pivots: document pivots of a larger cell.
    id_bytes: bytes of a set's identity that its short id has."""

    words: int = 5
    percent: int = 75
    bucket_postings: int = 250_000
    heavy_keys: int = 50_000
    leaf_shingles: int = 2_000_000
    pivots: int = 8
    id_bytes: int = 8

    def overlap(self, n):
        """Shingles that a set of n shares at least with any set it links to."""
        return -(-self.percent * n // 100)

    def linked(self, shared, a, b):
        return 100 * shared >= self.percent * (a + b - shared)


# --- shingles ----------------------------------------------------------------

def shingle_sets(column: pa.Array, words: int) -> Iterator[np.ndarray]:
    """Per text the sorted distinct shingle hashes; A-Z lower-cased, null is empty."""
    raw, bounds = common.text_buffer(column)
    raw = np.where((raw >= 65) & (raw <= 90), raw + 32, raw).astype(np.uint8)
    starts, ends = common.word_spans(raw, bounds)
    hashes = common.word_hashes(raw, starts, ends)
    cut = np.searchsorted(starts, bounds)
    for first, last in zip(cut[:-1], cut[1:]):
        own = hashes[first:last]
        if not len(own):
            yield np.zeros(0, np.int64)
        elif len(own) < words:
            yield common.mix(common.chained(own, len(own)) + np.uint64(len(own))).view(np.int64)
        else:
            yield np.unique(common.chained(own, words).view(np.int64))


def _head(n: int, join: Join) -> int:
    """Head shingles a set posts: enough for the test of any set it may link to."""
    return n - int(join.overlap(n)) + max(1, -(-n // 15))


def _summaries(join: Join):
    def run(batches):
        for batch in common.slices(batches, 1):
            sets = list(shingle_sets(batch.column(1), join.words))
            digests = [_digest(s) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array(digests, pa.binary()),
                 pa.array([d and _short(d, join) for d in digests], pa.int64()),
                 pa.array([_low_bytes(s[: _head(len(s), join)], HEAD_BYTES).tobytes()
                           if len(s) else None for s in sets],
                          pa.binary()),
                 batch.column(2)],
                ["doc_id", "n", "digest", "sid", "head", "text_key"])
    return run


def _digest(own: np.ndarray) -> bytes:
    return hashlib.blake2b(own.tobytes(), digest_size=16).digest()


def _short(digest: bytes, join: Join) -> int:
    """A set's short id: odd. 0 stands for several sets, other even numbers are for sets
    whose short ids are equal."""
    return int.from_bytes(digest[: join.id_bytes], "little", signed=join.id_bytes == 8) | 1


def _low_bytes(values: np.ndarray, width: int) -> np.ndarray:
    """The low bytes of 64-bit values, a row each."""
    return np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8)[:, :width]


def _flat(column, kind=np.int64) -> np.ndarray:
    """The packed values of all rows of a binary column, one after the other."""
    parts = []
    for chunk in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        if len(chunk):
            _, ends, data = chunk.buffers()
            wide = np.int64 if pa.types.is_large_binary(chunk.type) else np.int32
            ends = np.frombuffer(ends, wide)[chunk.offset : chunk.offset + len(chunk) + 1]
            if data is not None and ends[-1] > ends[0]:
                parts.append(np.frombuffer(data, np.uint8)[ends[0] : ends[-1]])
    raw = np.concatenate(parts) if len(parts) > 1 else parts[0] if parts else np.zeros(0, np.uint8)
    return np.ascontiguousarray(raw).view(kind)


def _sizes(column: pa.Array, width: int) -> np.ndarray:
    """How many values of ``width`` bytes each row of a binary column packs."""
    return pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64) // width


def _wide(column, width: int) -> np.ndarray:
    """64-bit values of packed low bytes."""
    raw = _flat(column, np.uint8).reshape(-1, width)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, :width] = raw
    return out.view(np.int64).reshape(-1)


def _packed(bucket, *columns) -> Iterator[list[tuple]]:
    """Rows (bucket, packed columns) of values dealt by bucket."""
    order = np.argsort(bucket, kind="stable")
    found, first = np.unique(bucket[order], return_index=True)
    for b, rows in zip(found.tolist(), np.split(order, first[1:])):
        yield b, *[c[rows].tobytes() for c in columns]


def _spread(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (common.mix(keys.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    """By bits of the region's name."""
    return ((keys & KEY_MASK).view(np.uint64) % np.uint64(buckets)).astype(np.int64)


# --- step 2: sets with too few shared head shingles ----------------------------

def _post_heads(buckets: int):
    """Each head shingle once per batch, with its set, or 0 for several sets; shingles
    that several sets of the batch hold are counted here."""
    def run(batches):
        for batch in common.slices(batches, 1):
            copies = batch.column(2).dictionary_encode().indices.to_numpy()
            _, first = np.unique(copies, return_index=True)
            batch = batch.take(pa.array(np.sort(first)))
            ids = np.repeat(batch.column(0).to_numpy(), _sizes(batch.column(1), HEAD_BYTES))
            keys = _wide(batch.column(1), HEAD_BYTES)
            order = np.argsort(keys, kind="stable")
            keys, ids = keys[order], ids[order]
            first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            many = np.diff(np.r_[first, len(keys)]) > 1
            held, counts = np.unique(ids[np.repeat(many, np.diff(np.r_[first, len(keys)]))],
                                     return_counts=True)
            posted, owner = keys[first], np.where(many, 0, ids[first])
            rows = [(b, False, k, i) for b, k, i in _packed(
                _spread(posted, buckets), _low_bytes(posted, HEAD_BYTES), _low_bytes(owner, OWNER_BYTES))]
            rows += [(b, True, i, c) for b, i, c in _packed(
                _spread(held, buckets), _low_bytes(held, OWNER_BYTES), counts.astype(np.uint32))]
            yield pa.RecordBatch.from_pylist(
                [dict(zip(("bucket", "counted", "left", "right"), r)) for r in rows],
                pa.schema([("bucket", pa.int64()), ("counted", pa.bool_()),
                           ("left", pa.binary()), ("right", pa.binary())]))
    return run


def _distinct(*columns: np.ndarray) -> list[np.ndarray]:
    """Distinct rows, sorted."""
    order = np.lexsort(columns[::-1])
    columns = [c[order] for c in columns]
    fresh = np.zeros(len(order), bool)
    fresh[:1] = True
    for c in columns:
        fresh[1:] |= c[1:] != c[:-1]
    return [c[fresh] for c in columns]


def _shared_heads(group: pa.Table) -> pa.Table:
    """(owner, how many of its head shingles in this bucket another set posted)."""
    posted, counted = group.filter(pc.invert(group.column("counted"))), group.filter(group.column("counted"))
    keys, ids = _wide(posted.column("left"), HEAD_BYTES), _wide(posted.column("right"), OWNER_BYTES)
    done_ids = _wide(counted.column("left"), OWNER_BYTES)
    done = _flat(counted.column("right"), np.uint32)
    if len(keys):
        keys, ids = _distinct(keys, ids)
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        size = np.diff(np.r_[first, len(keys)])
        shared = ids[np.repeat(size > 1, size)]
        shared, counts = np.unique(shared[shared != 0], return_counts=True)
        done_ids, done = np.r_[done_ids, shared], np.r_[done, counts]
    ids, where = np.unique(done_ids, return_inverse=True)
    return pa.table({"owner": ids, "c": np.bincount(where, done, len(ids)).astype(np.int64)})


# --- step 3: regions of one-shingle pivots ------------------------------------

def _in_map(bits: bytes):
    """The rows whose bit (the last column) is in the map, without it."""
    def run(batches):
        held = np.frombuffer(bits, np.uint8)
        for batch in batches:
            bit = batch.column(batch.num_columns - 1).to_numpy()
            keep = np.flatnonzero(held[bit >> 3] >> (bit & 7).astype(np.uint8) & 1)
            yield batch.select(range(batch.num_columns - 1)).take(pa.array(keep))
    return run


def _kept_sets(bits: bytes, renamed: dict[bytes, int], join: Join):
    def run(batches):
        held = np.frombuffer(bits, np.uint8)
        for batch in common.slices(batches, 1):
            bit = batch.column(2).to_numpy()
            keep = np.flatnonzero(held[bit >> 3] >> (bit & 7).astype(np.uint8) & 1)
            if len(keep):
                sets = list(shingle_sets(batch.column(1).take(pa.array(keep)), join.words))
                sets = [s for s in sets if len(s)]
                digests = [_digest(s) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([renamed.get(d) or _short(d, join) for d in digests], pa.int64()),
                     pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([s.tobytes() for s in sets], pa.binary())],
                    ["sid", "n", "shingles"])
    return run


#: Low bytes of a shingle that name its region. Shingles with equal low bytes share one
#: region and one count everywhere, so the order stays one order for all sets.
KEY_BYTES = 6
KEY_MASK = np.int64((1 << 8 * KEY_BYTES) - 1)


def _often(batches):
    """Shingles that more than two sets of a task hold, with lower bounds of how many: a
    bounded sketch goes over its batches, which loses no shingle that is more frequent
    than one in SKETCH_KEYS."""
    keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in common.slices(batches, 0):
        more, times = np.unique(_flat(batch.column(0)) & KEY_MASK, return_counts=True)
        joined, own = np.unique(np.r_[keys, more], return_inverse=True)
        keys, counts = joined, np.bincount(own, np.r_[counts, times], len(joined)).astype(np.int64)
        if len(keys) > SKETCH_KEYS:
            counts -= np.partition(counts, -SKETCH_KEYS)[-SKETCH_KEYS]
            keys, counts = keys[counts > 0], counts[counts > 0]
    keys, counts = keys[counts > 2], counts[counts > 2]
    yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], ["key", "c"])


def _post_sets(heavy: np.ndarray, buckets: int):
    """All shingles but the heavy ones, dealt by shingle."""
    def run(batches):
        for batch in common.slices(batches, 2):
            keys = _flat(batch.column(2))
            ids = np.repeat(batch.column(0).to_numpy(), _sizes(batch.column(2), 8))
            light = ~np.isin(keys & KEY_MASK, heavy)
            keys, ids = keys[light], ids[light]
            rows = list(_packed(_bucket(keys, buckets), _low_bytes(keys, KEY_BYTES), ids))
            yield pa.RecordBatch.from_pylist(
                [dict(zip(("bucket", "keys", "ids"), r)) for r in rows],
                pa.schema([("bucket", pa.int64()), ("keys", pa.binary()), ("ids", pa.binary())]))
    return run


_PLACED = "bucket long, keys binary, ids binary, holders binary, own boolean"
_PLACED_ARROW = pa.schema([("bucket", pa.int64()), ("keys", pa.binary()), ("ids", pa.binary()),
                           ("holders", pa.binary()), ("own", pa.bool_())])


def _placed(rows) -> pa.Table:
    return pa.Table.from_pylist(
        [dict(zip(_PLACED_ARROW.names, r)) for r in rows], _PLACED_ARROW)


def _held_by_several(buckets: int):
    """Back to the sets: their shingles with several holders, and how many."""
    def run(group: pa.Table) -> pa.Table:
        keys, ids = _distinct(_wide(group.column("keys"), KEY_BYTES), _flat(group.column("ids")))
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        size = np.diff(np.r_[first, len(keys)])
        holders = np.repeat(size, size)
        live = holders > 1
        keys, ids, holders = keys[live], ids[live], holders[live]
        return _placed([(*row, False) for row in _packed(
            _spread(ids, buckets), _low_bytes(keys, KEY_BYTES), ids, holders.astype(np.uint32))])
    return run


def _own_rows(heavy: np.ndarray, counts: np.ndarray, buckets: int):
    """Of every set: its size (as holders 0) and its heavy shingles."""
    def run(batches):
        for batch in common.slices(batches, 2):
            ids = batch.column(0).to_numpy()
            keys, owners, holders = [batch.column(1).to_numpy()], [ids], [np.zeros(len(ids), np.int64)]
            if len(heavy):
                own = _flat(batch.column(2)) & KEY_MASK
                at = np.minimum(np.searchsorted(heavy, own), len(heavy) - 1)
                hit = heavy[at] == own
                keys.append(own[hit])
                owners.append(np.repeat(ids, _sizes(batch.column(2), 8))[hit])
                holders.append(counts[at[hit]])
            keys, owners, holders = map(np.concatenate, (keys, owners, holders))
            yield from _placed([(*row, True) for row in _packed(
                _spread(owners, buckets), _low_bytes(keys, KEY_BYTES), owners,
                holders.astype(np.uint32))]).to_batches()
    return run


def _region_members(join: Join):
    """(region, doc_id, n): pivots among the first n - overlap + 1 shingles of a set by
    rising number of holders; shingles of one holder come first and are no pivots."""
    def run(group: pa.Table) -> pa.Table:
        keys, ids = _wide(group.column("keys"), KEY_BYTES), _flat(group.column("ids"))
        holders = _flat(group.column("holders"), np.uint32)
        is_size = holders == 0
        docs, sizes = _distinct(ids[is_size], keys[is_size])
        ids, _, keys = _distinct(ids[~is_size], holders[~is_size], keys[~is_size])
        at = np.searchsorted(docs, ids)
        first = np.searchsorted(ids, docs)
        several = np.diff(np.r_[first, len(ids)])
        room = sizes - -(-join.percent * sizes // 100) + 1 - (sizes - several)
        keep = np.arange(len(ids)) - first[at] < room[at]
        return pa.table({"region": keys[keep], "doc_id": ids[keep], "n": sizes[at[keep]]})
    return run


# --- step 4: document pivots ----------------------------------------------------

class _Sets:
    """Shingle sets of one task with distances to a member."""

    def __init__(self, sets: list[np.ndarray]):
        self.size = np.array([len(s) for s in sets], np.int64)
        self.end = np.r_[0, np.cumsum(self.size)]
        _, self.codes = np.unique(np.concatenate(sets), return_inverse=True)
        self.flag = np.zeros(int(self.codes.max()) + 1, np.int64)

    def shared(self, pivot: int, members: np.ndarray) -> np.ndarray:
        own = self.codes[self.end[pivot] : self.end[pivot + 1]]
        self.flag[own] = 1
        at = np.concatenate([np.arange(self.end[m], self.end[m + 1]) for m in members])
        sums = np.add.reduceat(self.flag[self.codes[at]],
                               np.r_[0, np.cumsum(self.size[members])[:-1]])
        self.flag[own] = 0
        return sums


def _run(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first, first + 1, ... of every run, one run after another."""
    return np.arange(int(size.sum())) + np.repeat(first - np.r_[0, np.cumsum(size)[:-1]], size)


class _Beginnings:
    """The first shingles of a task's sets, in the order of their holders in the task. Linked
    sets share ``least`` of these, or the smaller set's ``least``, as in step 2."""

    def __init__(self, held: _Sets, join: Join):
        self.sets = len(held.size)
        self.least = np.maximum(1, held.size // 15)
        length = held.size - -(-join.percent * held.size // 100) + self.least
        holders = np.bincount(held.codes)
        rank = np.empty(len(holders), np.int64)
        rank[np.argsort(holders, kind="stable")] = np.arange(len(holders))
        owner = np.repeat(np.arange(self.sets), held.size)
        codes = held.codes[np.lexsort((rank[held.codes], owner))]
        keep = (_run(np.zeros(self.sets, np.int64), held.size) < length[owner]) & (holders[codes] > 1)
        self.codes, owner = codes[keep], owner[keep]
        self.own = np.r_[0, np.cumsum(np.bincount(owner, minlength=self.sets))]
        self.members = owner[np.argsort(self.codes, kind="stable")]
        self.first = np.r_[0, np.cumsum(np.bincount(self.codes, minlength=len(holders)))]

    def met(self, pivot: int) -> np.ndarray:
        """Members that share enough of their first shingles with the pivot's."""
        codes = self.codes[self.own[pivot] : self.own[pivot + 1]]
        found = self.members[_run(self.first[codes], self.first[codes + 1] - self.first[codes])]
        if 8 * len(found) > self.sets:
            times = np.bincount(found, minlength=self.sets)
            found = np.flatnonzero(times)
            times = times[found]
        else:
            found, times = np.unique(found, return_counts=True)
        return found[times >= np.minimum(self.least[found], self.least[pivot])]


def _tops(above: np.ndarray, members: np.ndarray) -> np.ndarray:
    """The top of each member's group."""
    top = above[members]
    while True:
        higher = above[top]
        if (higher == top).all():
            above[members] = top
            return top
        top = higher


def pivot_links(ids: np.ndarray, sets: list[np.ndarray], join: Join,
                side: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that connect the same members as all links do. With ``side`` (0 or 1 per
    member) only links between the sides are looked for. A pivot is compared with members
    that share enough first shingles with it and that no link joins to it yet."""
    held = _Sets(sets)
    first = _Beginnings(held, join)
    reach = 1 - join.percent / 100
    above, groups = np.arange(len(ids)), len(ids)
    stays = np.ones(len(ids), bool)
    # The pivot is the largest set, so sets too small for it leave the window at once.
    order = np.lexsort((ids, -held.size))
    links = []
    for pivot in order:
        if not stays[pivot]:
            continue
        stays[pivot] = False
        near = first.met(pivot)
        near = near[stays[near] & (100 * held.size[near] >= join.percent * held.size[pivot])]
        if side is not None:
            near = near[side[near] != side[pivot]]
        own = _tops(above, np.array([pivot]))[0]
        tops = _tops(above, near)
        near, tops = near[tops != own], tops[tops != own]
        if not len(near):
            continue
        inner = join.linked(held.shared(pivot, near), held.size[near], held.size[pivot])
        # One link per group that the pivot joins: a spanning forest of all links.
        joined, one = np.unique(tops[inner], return_index=True)
        links += [(int(ids[pivot]), int(ids[m])) for m in near[inner][one]]
        above[joined] = own
        groups -= len(joined)
        if groups == 1:
            break
        if side is None and 4 * inner.sum() >= np.count_nonzero(stays):
            stays &= ~_out_of_reach(held, pivot, np.flatnonzero(stays), join, reach)
    return links


def _out_of_reach(held: _Sets, pivot: int, rest: np.ndarray, join: Join, reach: float) -> np.ndarray:
    """Members linked to the pivot that by the triangle inequality link with none that is not."""
    out = np.zeros(len(held.size), bool)
    window = 100 * held.size[rest] >= join.percent * held.size[pivot]
    near = rest[window]
    shared = held.shared(pivot, near)
    union = held.size[near] + held.size[pivot] - shared
    inner = 100 * shared >= join.percent * union
    distance = 1 - shared / union
    # A member below the pivot's size window has the distance that its size implies.
    least = np.r_[distance[~inner], 1 - held.size[rest[~window]] / held.size[pivot]].min(initial=2)
    out[near[inner][distance[inner] < least - reach - 1e-12]] = True
    return out


_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _join_cell(join: Join):
    def run(group: pa.Table) -> pa.Table:
        ids = group.column("doc_id").to_numpy()
        sets = [np.frombuffer(s, np.int64) for s in group.column("shingles").to_pylist()]
        block = group.column("block").to_numpy()
        side = None if (block == block[0]).all() else (block != block.min()).astype(np.int64)
        links = pivot_links(ids, sets, join, side)
        return pa.Table.from_pylist([{"a": a, "b": b} for a, b in links], _LINKS)
    return run


def _to_pivots(join: Join):
    """Exact distances of members to the pivots of their cell."""
    reach = 1 - join.percent / 100

    def run(batches):
        schema = pa.schema([("cell", pa.int64()), ("pivot", pa.int64()), ("doc_id", pa.int64()),
                            ("n", pa.int64()), ("distance", pa.float64())])
        for batch in batches:
            rows = []
            for cell, doc, n, own, pivots in zip(*(batch.column(i).to_pylist() for i in range(5))):
                own = np.frombuffer(own, np.int64)
                found = []
                for p in pivots:
                    other = np.frombuffer(p["shingles"], np.int64)
                    shared = len(np.intersect1d(own, other, assume_unique=True))
                    found.append((1 - shared / (n + len(other) - shared), p["doc_id"]))
                nearest = min(found)[0]
                rows += [dict(cell=cell, pivot=p, doc_id=doc, n=n, distance=d)
                         for d, p in found if d <= nearest + 2 * reach + 1e-12]
            yield pa.RecordBatch.from_pylist(rows, schema)
    return run


def _voronoi(cells: DataFrame, sets: DataFrame, join: Join) -> tuple[DataFrame, DataFrame]:
    """One round for cells too large for a task: links to pivots, and smaller cells."""
    salted = cells.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(join.pivots)))
    pivots = (
        salted.groupBy("cell", "salt").agg(F.min_by("doc_id", F.xxhash64("doc_id", F.lit(1))).alias("doc_id"))
        .join(sets.select("doc_id", "shingles"), "doc_id")
        .groupBy("cell").agg(F.collect_list(F.struct("doc_id", "shingles")).alias("pivots"))
    )
    dealt = stage(
        cells.join(sets.select("doc_id", "shingles"), "doc_id").join(pivots, "cell")
        .select("cell", "doc_id", "n", "shingles", "pivots")
        .mapInArrow(_to_pivots(join),
                    "cell long, pivot long, doc_id long, n long, distance double"),
        "jaccard_dealt",
    )
    limit = 1 - join.percent / 100
    links = dealt.where((F.col("distance") <= limit + 1e-12) & (F.col("doc_id") != F.col("pivot"))) \
        .select(F.col("pivot").alias("a"), F.col("doc_id").alias("b"))
    least = dealt.where(F.col("distance") > limit + 1e-12).groupBy("cell", "pivot") \
        .agg(F.min("distance").alias("least"))
    inside = dealt.join(least, ["cell", "pivot"]).where(
        (F.col("distance") > 0) & (F.col("distance") >= F.col("least") - limit - 1e-12))
    rest = inside.select(F.xxhash64("cell", "pivot").alias("cell"), F.col("cell").alias("parent"),
                         "doc_id", "n")
    return links, stage(rest, "jaccard_regions")


def _weights(cells: DataFrame) -> DataFrame:
    return cells.groupBy("cell").agg(F.sum("n").alias("weight"), F.count("*").alias("members"))


def _regions_or_cell(large: DataFrame, parts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Regions of the cells whose regions together hold half of the cell at most, and the
    other cells as they were. A set goes to several regions: regions that are smaller one by
    one, but not together, would multiply their sets with every round."""
    after = parts.groupBy("parent").agg(F.sum("n").alias("after"))
    halved = large.groupBy(F.col("cell").alias("parent")).agg(F.max("weight").alias("before")) \
        .join(after, "parent", "left") \
        .where(F.coalesce("after", F.lit(0)) * 2 <= F.col("before")).select("parent")
    return (parts.join(halved, "parent").select("cell", "doc_id", "n"),
            large.join(halved.withColumnRenamed("parent", "cell"), "cell", "left_anti"))


def cell_links(cells: DataFrame, sets: DataFrame, join: Join) -> DataFrame:
    """Links within cells (cell, doc_id, n). Cells within ``leaf_shingles`` are a task
    each; larger ones are dealt to Voronoi regions until they fit or stop shrinking."""
    links, leaves, blocked = [], [], []
    while True:
        sized = cells.join(_weights(cells), "cell")
        fits = F.col("weight") <= join.leaf_shingles
        leaves.append(sized.where(fits & (F.col("members") > 1))
                      .select("cell", "doc_id", F.lit(0).cast("long").alias("block")))
        large = stage(sized.where(~fits), "jaccard_large")
        if large.isEmpty():
            break
        found, parts = _voronoi(large.select("cell", "doc_id", "n"), sets, join)
        links.append(found)
        cells, whole = _regions_or_cell(large, parts)
        whole = whole.withColumn(
            "blocks", F.ceil(F.lit(2.0) * F.col("weight") / join.leaf_shingles))
        whole = whole.withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")))
        other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
        blocked.append(
            whole.select("*", other.alias("other"))
            .select(F.xxhash64("cell", F.least("block", "other"), F.greatest("block", "other"))
                    .alias("cell"), "doc_id", "block"))
    tasks = leaves[0]
    for more in leaves[1:] + blocked:
        tasks = tasks.union(more)
    within = (
        tasks.join(sets.select("doc_id", "shingles"), "doc_id")
        .groupBy("cell").applyInArrow(_join_cell(join), "a long, b long")
    )
    for more in links:
        within = within.union(more)
    return within


# --- the operator -----------------------------------------------------------------

def _bitmap(bits: DataFrame) -> bytes:
    """A map of the given bits; its size is fixed."""
    rows = bits.select((F.col("bit") + 1).alias("v")) \
        .groupBy(F.expr("bitmap_bucket_number(v)").alias("b")) \
        .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(v))").alias("bits")).collect()
    out = bytearray(MAP_BITS // 8)
    for row in rows:
        out[(row["b"] - 1) * 4096 : row["b"] * 4096] = row["bits"]
    return bytes(out)


def _bit(column: str):
    return F.pmod(F.xxhash64(column), F.lit(MAP_BITS))


def _cells(sets: DataFrame, buckets: int, join: Join) -> DataFrame:
    """(cell, doc_id, n): sets that chain through regions of one-shingle pivots."""
    often = (
        sets.select("shingles").mapInArrow(_often, "key long, c long")
        .groupBy("key").agg(F.sum("c").alias("c")).where("c >= 64")
        .orderBy(F.desc("c"), "key").limit(join.heavy_keys).toPandas().sort_values("key")
    )
    heavy, counts = often["key"].to_numpy(np.int64), often["c"].to_numpy(np.int64)
    members = stage(
        sets.mapInArrow(_post_sets(heavy, buckets), "bucket long, keys binary, ids binary")
        .groupBy("bucket").applyInArrow(_held_by_several(buckets), _PLACED)
        .union(sets.mapInArrow(_own_rows(heavy, counts, buckets), _PLACED))
        .groupBy("bucket").applyInArrow(_region_members(join), "region long, doc_id long, n long"),
        "jaccard_members")
    centre = members.groupBy("region").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("z")) \
        .where("a < z")
    chained = common.smallest_reachable(
        members.join(centre, "region").select("a", F.col("doc_id").alias("b")), "jaccard_cells")
    sizes = members.select("doc_id", "n").distinct()
    return stage(chained.select(F.col("component").alias("cell"), F.col("node").alias("doc_id"))
                 .join(sizes, "doc_id").select("cell", "doc_id", "n"), "jaccard_cell_members")


def _renamed(classes: DataFrame) -> dict[bytes, int]:
    """Numbers of the sets whose short ids are equal. Of n sets about n^2 / 2^64 are: none
    but in very large tables, and then a few."""
    met = [row["sid"] for row in classes.groupBy("sid").count().where("count > 1").collect()]
    rows = classes.where(F.col("sid").isin(met)).select("digest").collect() if met else []
    return {bytes(row["digest"]): 2 * k for k, row in enumerate(rows, 1)}


def _with_node(classes: DataFrame, renamed: dict[bytes, int]) -> DataFrame:
    if not renamed:
        return classes.withColumn("node", F.col("sid"))
    other = classes.sparkSession.createDataFrame(list(renamed.items()), "digest binary, other long")
    return classes.join(F.broadcast(other), "digest", "left") \
        .withColumn("node", F.coalesce("other", "sid")).drop("other")


def _text_key(text: str):
    return F.unhex(F.md5(F.col(text).cast("binary")))


def _keyed(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return docs.select(F.col(id_column).cast("long").alias("doc_id"),
                       F.col(text_column).alias("text"), _text_key(text_column).alias("text_key"))


def _one_of_each_class(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """Rows that are enough to find every class, with their place in the map: its smallest
    id, or where no row of it has an id, a text without one."""
    named = docs.where("doc_id is not null").withColumn("bit", _bit("doc_id"))
    if classes.where("first_id is null").isEmpty():
        return named
    nameless = docs.where("doc_id is null").dropDuplicates(["text_key"])
    return named.unionByName(nameless.withColumn("bit", _bit("text_key")))


def _linked(docs: DataFrame, join: Join) -> tuple[DataFrame, DataFrame]:
    """The set of every row, and of every class its component's root and smallest id."""
    common.bound_batches(docs.sparkSession)
    sets = stage(
        docs.select("doc_id", "text", "text_key").mapInArrow(
            _summaries(join),
            "doc_id long, n long, digest binary, sid long, head binary, text_key binary"),
        "jaccard_sets")
    held = sets.where("n > 0")
    buckets = max(256, int((held.agg(F.sum(F.length("head"))).first()[0] or 0)
                           // HEAD_BYTES // join.bucket_postings))
    shared = (
        held.select("sid", "head", "digest").mapInArrow(
            _post_heads(buckets), "bucket long, counted boolean, left binary, right binary")
        .groupBy("bucket").applyInArrow(_shared_heads, "owner long, c long")
        .groupBy("owner").agg(F.sum("c").alias("c"))
    )
    classes = stage(
        held.groupBy("digest", "sid", "n").agg(F.min("doc_id").alias("first_id"),
                                               F.min("text_key").alias("text_key")),
        "jaccard_classes")
    renamed = _renamed(classes)
    classes = _with_node(classes, renamed)
    same_owner = F.count("*").over(Window.partitionBy("owner"))
    stays = stage(
        classes.withColumn("owner", F.col("sid").bitwiseAND(F.lit((1 << 8 * OWNER_BYTES) - 1)))
        .join(shared, "owner", "left").withColumn("same", same_owner)
        .where("same > 1 or c >= greatest(1, n div 20)")
        .select("first_id", "text_key"), "jaccard_stays")
    # A class without any id is found by its texts, since all rows of a null id are one.
    unnamed = sets.where("n > 0 and doc_id is null").select("digest", "text_key") \
        .join(classes.where("first_id is null").select("digest"), "digest", "left_semi")
    bits = stays.where("first_id is not null").select(_bit("first_id").alias("bit")).union(
        unnamed.select(_bit("text_key").alias("bit")))
    kept = stage(
        _one_of_each_class(docs, classes).select("doc_id", "text", "bit")
        .mapInArrow(_kept_sets(_bitmap(bits), renamed, join), "sid long, n long, shingles binary"),
        "jaccard_kept")
    shingles = kept.agg(F.sum("n")).first()[0] or 0
    cells = _cells(kept, max(256, int(shingles // join.bucket_postings)), join)
    # Only the sets of cells are dealt out again, but for what the map lets through.
    members = _bitmap(cells.select(_bit("doc_id").alias("bit")))
    celled = kept.select(F.col("sid").alias("doc_id"), "n", "shingles",
                         _bit("sid").alias("bit")).mapInArrow(
        _in_map(members), "doc_id long, n long, shingles binary")
    links = cell_links(cells, celled, join)
    reach = common.smallest_reachable(links, "jaccard")
    rooted = classes.join(reach, "node", "left") \
        .select("digest", "first_id", F.coalesce("component", "node").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("first_id").alias("lowest"))
    return sets, stage(rooted.join(lowest, "root").select("digest", "root", "lowest"),
                       "jaccard_components")


def jaccard_components(
    docs: DataFrame, join: Join = Join(), id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(doc_id, n_shingles, component_id), a row per input row.

    A text's set is its distinct shingles of ``join.words`` words, A-Z lower-cased; a
    shorter text is one shingle. Two sets link when 100 * shared >= percent * union.
    ``component_id`` is the smallest id that links reach, the row's own included. Null
    texts and texts without words have no shingle and link with nothing; their component
    is their own id. Repeated rows are links like others; one id with several texts has a
    row and a component for each. A row without an id links like others, also where it is
    the only bridge of two; it never names a component, and a component without any id is
    null. Links are not counted. Other columns are not read. An empty table gives an empty
    result. The shingles of one text must fit a batch, so a text has 250 million words at most.
    """
    sets, component = _linked(_keyed(docs, id_column, text_column), join)
    own = ["doc_id", F.col("n").alias("n_shingles")]
    # Rows without words share a null digest: they stay out of the join.
    return sets.where("n > 0").join(component, "digest", "left") \
        .select(*own, F.col("lowest").alias("component_id")) \
        .unionByName(sets.where("n = 0").select(*own, F.col("doc_id").alias("component_id")))


def one_of_each(
    docs: DataFrame, join: Join = Join(), id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Of the rows that links connect, the one with the smallest id, null ids last, and of
    these the one whose text has the smallest digest. All columns are kept.

    The choice is by row, not by id: of two unrelated texts under one id, or without one,
    both stay. Of rows that repeat an id and a text one stays, also of those without words;
    other rows without words link with nothing and all stay.
    """
    sets, component = _linked(_keyed(docs, id_column, text_column), join)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_key"))
    chosen = stage(
        sets.where("n > 0").join(component, "digest").groupBy("root").agg(first.alias("one"))
        .select("one.doc_id", "one.text_key")
        .unionByName(sets.where("n = 0").select("doc_id", "text_key").distinct()), "jaccard_chosen")
    stays = chosen.select(F.col("doc_id").alias("_own_id"), F.col("text_key").alias("_own_key"))
    own_id, own_key = F.col(id_column).cast("long"), _text_key(text_column)
    kept = docs.join(stays, own_id.eqNullSafe(F.col("_own_id"))
                     & own_key.eqNullSafe(F.col("_own_key")), "left_semi")
    repeated = sets.groupBy("doc_id", "text_key").count().where("count > 1")
    if repeated.isEmpty():
        return kept
    return kept.withColumn("_own_key", own_key).dropDuplicates([id_column, "_own_key"]).drop("_own_key")

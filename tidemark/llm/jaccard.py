"""Documents that share most of their word shingles, found without comparing all pairs.

A document's set holds the 64-bit hashes of its distinct shingles (``words``).  Two sets of
sizes ``a <= b`` reach the threshold exactly if their symmetric difference has at most
``H = (a + b) * (1 - t) / (1 + t)`` members.  The hash universe is cut into segments; a
difference touches at most ``H`` of them, so two linked sets agree on all others.

* **Bands.**  The number of segments depends on the size band ``(2**(k-1), 2**k]`` of the larger
  set.  A set takes part in its own band and, if a partner may be larger than that, in the next.
* **Allocation by cost.**  A segment that holds nothing, or only shingles that many documents
  have, is the likeliest to agree by chance, so a set leaves such segments out and indexes its
  ``H + 1`` segments of most rare shingles (ties by hash: an order of contents, the same for all).  Linked sets agree on at
  least ``n - H`` of the ``n`` non-empty segments of the one that has more, so they share one
  indexed content if that ``n`` exceeds ``H``.
* **One-deletion neighbourhoods.**  Sets too short for that (``n <= H``) are indexed once more, in
  half as many segments, by each segment's content and its contents less one shingle.  Two of
  them differ by at most one in some segment and meet there.  It costs more entries, so
  only they take it.
* **Exact check.**  Every candidate is decided by the whole shingle sets, after sizes and short
  bitmaps, whose differing bits are never more than the differing shingles, have ruled out most.

Agreeing documents are not expanded into pairs.  The members of a content are compared by sizes and
bitmaps, block with block inside tasks, which report a forest and no pairs.  What that leaves alike
are far fewer documents in small clusters, and only their whole sets are dealt and compared, again
block with block.  In a large cluster each document is first compared with one that it met; only
contents whose documents then stay in several components go on to blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import components, words
from tidemark.llm.frames import buckets_for, small, small_batches
from tidemark.workspace import durable

_U = np.uint64
_FLUSH = 750_000
_HELD = 2_000_000
_PIECE = 2 << 20
#: Pairs whose bitmaps are compared at once: 8 bytes each, or fewer of longer bitmaps.
_PAIRS = 1 << 19
#: A block of a group has at most about so many sets, and so many shingles in all.
_BLOCK, _BLOCK_ITEMS = 1024, 1_000_000
#: A cluster that bitmaps leave alike is compared as a whole up to this many sets ...
_WHOLE = 4096
#: ... in at most so many blocks.
_NEAR = 4
#: A shingle of one document in this many is common, and of no fewer documents than the second.
_COMMON, _LEAST_COMMON = 4000, 20
#: Rounds of comparing with one chosen member before any comparison of pairs or blocks.
_TURNS = 1
_ROUTED = "bucket int, kind string, id long, sid long, n long, sigs binary, sids binary"
_FOUND = "kind string, id long, sid long, n long, content long"


def set_id(h: np.ndarray) -> int:
    """A 64-bit name of a set; the order of its members does not matter."""
    return int(words.mix(np.sum(words.mix(h), keepdims=True) + _U(len(h)))[0])


def segments_of(top: int) -> int:
    """Segments of the band whose largest set has ``top`` members: enough that a set keeps a few
    non-empty ones to spare."""
    return int(np.ceil(0.33 * top + 0.6 * np.sqrt(top))) + 1


def _segment(h: np.ndarray, band: int, m, salt: int) -> np.ndarray:
    x = words.mix(h ^ _U((band * 0x9E3779B97F4A7C15 + salt) & (1 << 64) - 1)) >> _U(32)
    return ((x * np.asarray(m, dtype=np.uint64)) >> _U(32)).astype(np.int64)


def _sums(at: np.ndarray, h: np.ndarray, size: int) -> np.ndarray:
    """Sums modulo 2**64 of ``h`` by place, through two exact sums of 32-bit halves."""
    low = np.bincount(at, (h & _U(0xFFFFFFFF)).astype(np.float64), size)
    high = np.bincount(at, (h >> _U(32)).astype(np.float64), size)
    return low.astype(np.uint64) + (high.astype(np.uint64) << _U(32))


def _named(content: np.ndarray, band: int, segment, tag: int) -> np.ndarray:
    key = (np.asarray(segment).astype(np.uint64) * _U(64) + _U(band)) * _U(2) + _U(tag)
    return words.mix(content ^ words.mix(key + _U(0x2545F4914F6CDD1D)))


def band_of(n: int) -> int:
    return (n - 1).bit_length()


def plans(n: int, num: int, den: int) -> list[tuple[int, int]]:
    """(band, H + 1) of a set of ``n`` members for the threshold ``num / den``."""
    widest = n * den // num
    if (n + widest) * (den - num) // (den + num) == 0:
        return []  # linked with equal sets only
    k = band_of(n)
    out = [(k, (n + min(1 << k, widest)) * (den - num) // (den + num) + 1)]
    if widest > 1 << k:
        out.append((k + 1, (n + widest) * (den - num) // (den + num) + 1))
    return out


def signatures(h: np.ndarray, rare: np.ndarray, num: int, den: int) -> np.ndarray:
    """The contents under which one set is indexed; ``rare`` marks shingles of few documents."""
    out = []
    mixed = words.mix(h)
    for band, need in plans(len(h), num, den):
        m = segments_of(1 << band)
        at = _segment(h, band, m, 1)
        full = np.flatnonzero(np.bincount(at, minlength=m))
        named = _named(_sums(at, mixed, m)[full], band, full, 0)
        if len(full) >= need:
            weight = np.minimum(np.bincount(at, rare, m)[full], 255).astype(np.uint64)
            order = ((_U(255) - weight) << _U(56)) | (named >> _U(8))
            out.append(named[np.argpartition(order, need - 1)[:need]])
            continue
        out.append(named)
        half = ((2 << band) * (den - num) // (den + num) + 2) // 2
        at = _segment(h, band, half, 2)
        parts = _sums(at, mixed, half)
        out.append(_named(parts, band, np.arange(half), 1))
        out.append(_named(parts[at] - mixed, band, at, 1))
    return np.unique(np.concatenate(out)) if out else np.zeros(0, np.uint64)


def _is_rare(h: np.ndarray, common: np.ndarray) -> np.ndarray:
    if not len(common):
        return np.ones(len(h), dtype=bool)
    at = np.minimum(np.searchsorted(common, h), len(common) - 1)
    return common[at] != h


def common_shingles(rows: DataFrame, text_col: str, k: int) -> np.ndarray:
    """The sorted hashes of the shingles of at least one document in ``_COMMON``.

    Every document is counted; a slice of the table reports the shingles that reach half that
    share in it.  At most ``2 * _COMMON`` times the mean number of shingles are reported, whatever
    the size of the table.  They only steer which contents are indexed, so a shingle near the
    limit may fall on either side without any effect on the result.
    """
    def report(parts: list[np.ndarray], n: int) -> pa.RecordBatch:
        values, counts = np.unique(np.concatenate(parts), return_counts=True)
        keep = counts >= max(2, n // (2 * _COMMON))
        return pa.RecordBatch.from_arrays(
            [pa.array(np.append(values[keep].view(np.int64), 0)),
             pa.array(np.append(counts[keep], 0), pa.int64()),
             pa.array(np.append(np.zeros(keep.sum()), n), pa.int64())], ["h", "n", "docs"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, parts = 0, []
        for batch in batches:
            for piece in words.pieces(batch, text_col, _PIECE):
                w = words.words(piece.column(text_col), words.NOT_SPACE)
                h, at = words.shingles(w, w.hashes(), k)
                text = np.searchsorted(w.first, at, "right")
                order = np.lexsort((text, h)) if len(h) else np.zeros(0, np.int64)
                h, text = h[order], text[order]
                new = np.ones(len(h), dtype=bool)
                new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
                parts.append(h[new])
                n += piece.num_rows
                if sum(map(len, parts)) >= _HELD:
                    yield report(parts, n)
                    n, parts = 0, []
        if n:
            yield report(parts, n)

    found = durable(rows.select(text_col).mapInArrow(count, "h long, n long, docs long")
                    .groupBy("h").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")),
                    "common")
    docs = found.agg(F.sum("docs")).first()[0] or 0
    kept = found.filter(F.col("n") >= max(_LEAST_COMMON, docs // _COMMON)).select("h")
    return np.sort(np.array([r[0] for r in kept.collect()], np.int64).view(np.uint64))


_ROUTED_ARROW = pa.schema([("bucket", pa.int32()), ("kind", pa.string()), ("id", pa.int64()),
                           ("sid", pa.int64()), ("n", pa.int64()), ("sigs", pa.binary()),
                           ("sids", pa.binary())])


def _packed(parts: list[tuple[np.ndarray, int]], buckets: int) -> pa.RecordBatch:
    """Entries of many documents, one row for each bucket."""
    sig = np.concatenate([s for s, _ in parts])
    sid = np.repeat(np.array([i for _, i in parts], dtype=np.uint64), [len(s) for s, _ in parts])
    bucket = (sig % _U(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    sig, sid = sig[order], sid[order]
    cut = np.concatenate([[0], np.cumsum(np.bincount(bucket, minlength=buckets))])
    some = np.flatnonzero(np.diff(cut))
    n = len(some)
    return pa.RecordBatch.from_arrays(
        [pa.array(some, pa.int32()), pa.array(["entries"] * n), *[pa.nulls(n, pa.int64())] * 3,
         pa.array([sig[cut[b]:cut[b + 1]].tobytes() for b in some], pa.binary()),
         pa.array([sid[cut[b]:cut[b + 1]].tobytes() for b in some], pa.binary())],
        schema=_ROUTED_ARROW)


def _route(k: int, num: int, den: int, buckets: int, id_col: str, text_col: str, common):
    """Each document, to the bucket of its set; and its entries, to the buckets of the contents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, held, seen = [], 0, set()
        listed = common.value
        for batch in batches:
            for piece in words.pieces(batch, text_col, _PIECE):
                sets = list(words.shingle_sets(piece.column(text_col), k))
                n = len(sets)
                names = np.array([set_id(h) if len(h) else 0 for h in sets], dtype=np.uint64)
                rare = _is_rare(np.concatenate(sets), listed)
                end = np.cumsum([len(h) for h in sets])
                yield pa.RecordBatch.from_arrays(
                    [pa.array((names % _U(buckets)).astype(np.int32)), pa.array(["doc"] * n),
                     piece.column(id_col), pa.array(names.view(np.int64)),
                     pa.array([len(h) for h in sets], pa.int64()),
                     *[pa.nulls(n, pa.binary())] * 2], schema=_ROUTED_ARROW)
                for name, h, e in zip(names.tolist(), sets, end):
                    if name in seen or not len(h):
                        continue  # an equal set is waiting already
                    s = signatures(h, rare[e - len(h):e], num, den)
                    if len(s):
                        seen.add(name)
                        waiting.append((s, name))
                        held += len(s)
                if held >= _FLUSH:
                    yield _packed(waiting, buckets)
                    waiting, held, seen = [], 0, set()
        if waiting:
            yield _packed(waiting, buckets)
    return run


def _signed(a: int) -> int:
    return a - (a >> 63 << 64)


_FOUND_ARROW = pa.schema([("kind", pa.string()), ("id", pa.int64()), ("sid", pa.int64()),
                          ("n", pa.int64()), ("content", pa.int64())])


def _met(sig: np.ndarray, sid: np.ndarray):
    """Members of the contents that two or more sets share; equal member lists once."""
    order = np.lexsort((sid, sig))
    sig, sid = sig[order], sid[order]
    fresh = np.ones(len(sig), dtype=bool)
    fresh[1:] = (sig[1:] != sig[:-1]) | (sid[1:] != sid[:-1])
    sig, sid = sig[fresh], sid[fresh]
    starts = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]])) if len(sig) else \
        np.zeros(0, np.int64)
    sizes = np.diff(np.append(starts, len(sig)))
    if not len(starts):
        return None
    lists = words.mix(np.add.reduceat(words.mix(sid), starts) + sizes.astype(np.uint64))
    shared = np.flatnonzero(sizes > 1)
    shared = shared[np.unique(lists[shared], return_index=True)[1]]
    if not len(shared):
        return None
    reps = sizes[shared]
    within = np.arange(reps.sum()) - np.repeat(np.cumsum(reps) - reps, reps)
    at = np.repeat(starts[shared], reps) + within
    return sid[at], np.repeat(lists[shared], reps)


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One bucket: documents pass; entries become the members of shared contents.

    A bucket holds about as many bytes of entries as one input split has of text.  A content
    that very many sets share stays in one bucket, 16 bytes a set.
    """
    sigs, sids = [], []
    for batch in batches:
        entries = pc.equal(batch.column("kind"), "entries")
        docs = batch.filter(pc.invert(entries))
        if docs.num_rows:
            yield pa.RecordBatch.from_arrays(
                [docs.column(c) for c in ("kind", "id", "sid", "n")] + [pa.nulls(docs.num_rows, pa.int64())],
                schema=_FOUND_ARROW)
        part = batch.filter(entries)
        sigs += [np.frombuffer(x.as_buffer(), np.uint64) for x in part.column("sigs")]
        sids += [np.frombuffer(x.as_buffer(), np.uint64) for x in part.column("sids")]
    found = _met(np.concatenate(sigs), np.concatenate(sids)) if sigs else None
    if found is None:
        return
    member, content = found
    for a in range(0, len(member), 100_000):
        cut = slice(a, a + 100_000)
        n = len(member[cut])
        yield pa.RecordBatch.from_arrays(
            [pa.array(["member"] * n), pa.nulls(n, pa.int64()),
             pa.array(member[cut].view(np.int64)), pa.nulls(n, pa.int64()),
             pa.array(content[cut].view(np.int64))], schema=_FOUND_ARROW)


def _bits(h: np.ndarray) -> bytes:
    """For each hash one of as many bits as there are hashes, about, is turned over.

    Two sets that differ in ``d`` hashes have bitmaps that differ in ``d`` bits at most.
    """
    size = max(64, 1 << band_of(len(h)))
    return np.packbits(np.bincount((h >> _U(20)).astype(np.int64) & (size - 1),
                                   minlength=size).astype(np.uint8) & 1).tobytes()


def _sets(k: int, text_col: str, whole: bool):
    """(sid, n) of the texts that have a set, with its bitmap or with the whole of it."""
    name, made = ("items", np.ndarray.tobytes) if whole else ("bits", _bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in words.pieces(batch, text_col, _PIECE):
                found = [h for h in words.shingle_sets(piece.column(text_col), k) if len(h)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([_signed(set_id(h)) for h in found], pa.int64()),
                     pa.array([len(h) for h in found], pa.int64()),
                     pa.array([made(h) for h in found], pa.binary())], ["sid", "n", name])
    return run


def _sets_of(rows: DataFrame, reps: DataFrame, k: int, whole: bool) -> DataFrame:
    """The sets of the rows whose ids are in ``reps`` (rep), each once."""
    name = "items" if whole else "bits"
    kept = small(reps)
    sets = durable(rows.join(kept, rows.id.eqNullSafe(kept.rep), "left_semi").mapInArrow(
        _sets(k, "text", whole), f"sid long, n long, {name} binary"), "sets")
    # an id that is repeated with one text has given that set several times
    again = durable(sets.groupBy("sid").count().filter("count > 1").select("sid"), "again")
    if again.isEmpty():
        return sets
    return durable(sets.join(small(again), "sid", "left_anti").unionByName(
        sets.join(small(again), "sid", "left_semi").dropDuplicates(["sid"])), "sets")


def _merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``label``, the first member of each one's component, after ``a`` and ``b`` are linked."""
    while len(a):
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while (label[label] != label).any():
            label = label[label]
        apart = label[a] != label[b]
        a, b = a[apart], b[apart]
    return label


def _folded(bits: np.ndarray, width: int) -> np.ndarray:
    while bits.shape[1] > width:
        half = bits.shape[1] // 2
        bits = bits[:, :half] ^ bits[:, half:]
    return bits


def _close_rows(rows: pa.RecordBatch, num: int, den: int) -> pa.RecordBatch:
    """(a, b): a forest of what sizes and bitmaps leave alike within each of the rows' tiles."""
    g, ti, tj, sid, block, n = (rows.column(c).to_numpy(zero_copy_only=False)
                                for c in ("g", "ti", "tj", "sid", "block", "n"))
    fresh = np.ones(len(g), dtype=bool)
    fresh[1:] = (g[1:] != g[:-1]) | (ti[1:] != ti[:-1]) | (tj[1:] != tj[:-1])
    group = np.cumsum(fresh)
    order = np.lexsort((n, group))
    group, sid, block, n, cross = group[order], sid[order], block[order], n[order], (ti != tj)[order]
    maps = rows.column("bits").take(pa.array(order))
    width = np.array([len(x.as_buffer()) // 8 for x in maps])
    of, tables = np.zeros(len(n), np.int64), {}
    for w in np.unique(width).tolist():
        own = np.flatnonzero(width == w)
        of[own] = np.arange(len(own))
        tables[w] = np.frombuffer(b"".join(maps[i].as_py() for i in own.tolist()), np.uint64).reshape(-1, w)
    key = group << 40
    last = np.searchsorted(key + n, key + n * den // num, "right")  # larger ones that may still be alike
    count = last - np.arange(len(n)) - 1
    label, a, done = np.arange(len(n)), 0, np.cumsum(count)
    while a < len(n):
        b = max(a + 1, int(np.searchsorted(done, (done[a - 1] if a else 0) + _PAIRS, "right")))
        c = count[a:b]
        i = np.repeat(np.arange(a, b), c)
        j = i + 1 + np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c)
        open_ = (label[i] != label[j]) & ~(cross[i] & (block[i] == block[j]))
        i, j = i[open_], j[open_]
        kind = width[i] << 32 | width[j]
        for w in np.unique(kind).tolist():
            here = np.flatnonzero(kind == w)
            left = tables[w >> 32]
            right = _folded(tables[w & (1 << 32) - 1], w >> 32)
            step = max(1, _PAIRS // (w >> 32))
            for at in range(0, len(here), step):
                p, q = i[here[at:at + step]], j[here[at:at + step]]
                differ = np.bitwise_count(left[of[p]] ^ right[of[q]]).sum(1, dtype=np.int64)
                near = differ <= (n[p] + n[q]) * (den - num) // (den + num)
                label = _merge(label, p[near], q[near])
        a = b
    other = np.flatnonzero(label != np.arange(len(label)))
    return pa.RecordBatch.from_arrays([pa.array(sid[other]), pa.array(sid[label[other]])], ["a", "b"])


def _close_tiles(num: int, den: int):
    """The rows come sorted by their tiles, each of which is whole when it is compared."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            held = batch if held is None else pa.concat_batches([held, batch])
            g, ti, tj = (held.column(c).to_numpy() for c in ("g", "ti", "tj"))
            ended = np.flatnonzero((g != g[-1]) | (ti != ti[-1]) | (tj != tj[-1]))
            if not len(ended):
                continue
            cut = int(ended[-1]) + 1
            yield _close_rows(held.slice(0, cut), num, den)
            held = held.slice(cut)
        if held is not None:
            yield _close_rows(held, num, den)
    return run


def _in_tiles(rows: DataFrame) -> DataFrame:
    """``rows`` with blocks of their group, once for each tile (ti, tj), a pair of blocks, that has theirs."""
    block = F.pmod(F.xxhash64("sid"), F.col("blocks")).cast("int")
    tiles = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1),
                        lambda j: F.struct(F.least("block", j).alias("ti"),
                                           F.greatest("block", j).alias("tj")))
    return (rows.withColumn("block", block).withColumn("t", F.explode(tiles))
            .withColumns({"ti": F.col("t.ti"), "tj": F.col("t.tj")}).drop("t", "blocks"))


def _close(groups: DataFrame, bits: DataFrame, num: int, den: int) -> DataFrame:
    """Clusters (node, label) of the members of each group (g, sid) that sizes and bitmaps leave alike.

    Linked members of a group are in one cluster.  Members that are alike to none are left out.
    """
    large = (groups.groupBy("g").agg(F.count("*").alias("n")).filter(F.col("n") > _BLOCK)
             .select("g", F.ceil(F.col("n") / _BLOCK).cast("int").alias("blocks")))
    rows = (groups.join(F.broadcast(large), "g", "left").fillna(1, ["blocks"]).join(bits, "sid"))
    tiles = _in_tiles(rows).select("g", "ti", "tj", "sid", "block", "n", "bits")
    found = (tiles.repartition("g", "ti", "tj").sortWithinPartitions("g", "ti", "tj")
             .mapInArrow(_close_tiles(num, den), "a long, b long"))
    return components.connected(durable(found, "close"))


def _tile_links(num: int, den: int):
    def run(tile: pa.Table) -> pa.Table:
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for c in tile.column("items").chunks
                for x in c]
        sids, labels, block = (tile.column(c).to_numpy() for c in ("sid", "label", "block"))
        n = len(sets)
        sizes = np.array([len(s) for s in sets])
        root = list(range(n))
        places: dict[int, int] = {}
        for i, label in enumerate(labels.tolist()):
            root[i] = places.setdefault(label, i)

        def top(x: int) -> int:
            while root[x] != x:
                root[x] = x = root[root[x]]
            return x

        first = np.flatnonzero(block == tile.column("ti")[0].as_py())
        other = np.flatnonzero(block == tile.column("tj")[0].as_py())
        items = np.concatenate([sets[i] for i in first]) if len(first) else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(first)), sizes[first])
        order = np.argsort(items, kind="stable")
        items, owner = items[order], owner[order]
        out = []
        apart = {top(i) for i in first.tolist()}
        for j in other.tolist():
            if len(apart) > 1:
                apart = {top(i) for i in apart}
            if apart == {top(j)}:  # nothing here is left to join to it
                continue
            lo, hi = (np.searchsorted(items, sets[j], side) for side in ("left", "right"))
            span = hi - lo
            at = np.repeat(lo - np.cumsum(span) + span, span) + np.arange(span.sum())
            both = np.bincount(owner[at], minlength=len(first))
            near = den * both >= num * (sizes[first] + sizes[j] - both)
            for i in first[near].tolist():
                p, q = top(i), top(j)
                if p != q:
                    root[max(p, q)] = min(p, q)
                    out.append((i, j))
        return pa.table({"a": pa.array([int(sids[i]) for i, _ in out], pa.int64()),
                         "b": pa.array([int(sids[j]) for _, j in out], pa.int64())})
    return run


def _tiles(groups: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Links that join the components (label) of the members of each group (g, sid, label).

    A group is dealt into blocks by its sets and their shingles; each pair of blocks is one task, which reports
    at most one link for each set it joins to another component.
    """
    dealt = groups.join(_blocks(groups, sets), "g")
    return _tiled(_in_tiles(dealt), sets, num, den)


def _blocks(groups: DataFrame, sets: DataFrame) -> DataFrame:
    """(g, d, blocks): members of each group and the blocks that hold them."""
    return (groups.join(sets.select("sid", "n"), "sid").groupBy("g")
            .agg(F.count("*").alias("d"), F.greatest(F.ceil(F.count("*") / _BLOCK),
                                                     F.ceil(F.sum("n") / _BLOCK_ITEMS)).cast("int").alias("blocks")))


def _tiled(tiles: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    rows = small(durable(tiles.select("g", "ti", "tj", "sid", "label", "block"), "tiles"))
    return (sets.select("sid", "items").join(rows, "sid")
            .groupBy("g", "ti", "tj").applyInArrow(_tile_links(num, den), "a long, b long"))


def _star_links(stars: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Those of the pairs (pivot, sid) whose whole sets reach the threshold."""
    members = stars.select(F.col("pivot").alias("g"), "sid")
    dealt = durable(members.join(_blocks(members, sets), "g").select(
        "g", "sid", (F.pmod(F.xxhash64("sid"), F.col("blocks")) + 1).cast("int").alias("tj")), "stars")
    centres = dealt.select("g", F.col("g").alias("sid"), "tj", F.lit(0).alias("block")).distinct()
    rows = dealt.withColumn("block", F.col("tj")).unionByName(centres)
    return _tiled(rows.withColumns({"ti": F.lit(0), "label": F.col("sid")}), sets, num, den)


def _apart(met: DataFrame, labels: DataFrame) -> DataFrame:
    """Members (content, sid, label) of the contents whose members lie in several components."""
    named = (met.join(labels, met.sid == labels.node, "left")
             .select("content", "sid", F.coalesce("label", "sid").alias("label")))
    several = (named.groupBy("content")
               .agg(F.min("label").alias("least"), F.max("label").alias("most"))
               .filter("least <> most").select("content"))
    return durable(named.join(several, "content"), "apart")


def _turned(apart: DataFrame, turn: int) -> DataFrame:
    """(pivot, sid): for each set one of other components: of those chosen by hash in its contents, one."""
    rank = F.xxhash64("content", "sid", F.lit(turn))
    chosen = apart.groupBy("content").agg(F.min(F.struct(rank.alias("r"), "sid", "label"))
                                          .alias("p"))
    return (apart.join(chosen, "content").filter("label <> p.label").groupBy("sid")
            .agg(F.min(F.struct(F.xxhash64("p.sid", "sid"), F.col("p.sid").alias("pivot"))).alias("p"))
            .select("p.pivot", "sid"))


def _large_links(met: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Links that join all sets that are linked through the contents of ``met`` (content, sid)."""
    links, labels = None, met.sparkSession.createDataFrame([], "node long, label long")
    for turn in range(_TURNS):
        stars = _turned(_apart(met, labels), turn)
        found = durable(_star_links(stars, sets, num, den), "links")
        links = found if links is None else links.unionByName(found)
        labels = components.connected(links)
    apart = _apart(met, labels)
    if apart.isEmpty():
        return links
    # each set is linked to the least set of its contents: contents are no nodes
    centres = apart.groupBy("content").agg(F.min("sid").alias("a"))
    together = components.connected(apart.select("content", F.col("sid").alias("b"))
                                    .join(centres, "content").select("a", "b").distinct())
    named = durable(apart.join(together, apart.sid == together.node).select(
        "content", "sid", apart.label, together.label.alias("cluster")), "crowd")
    alone = (named.groupBy("cluster", "content").agg(F.count("*").alias("n")).groupBy("cluster")
             .agg(F.sum(F.col("n") * F.col("n")).alias("alone")))
    picked = named.groupBy("cluster").agg(F.countDistinct("sid").alias("d")).join(
        alone, "cluster").select("cluster", (F.col("d") * F.col("d") <= F.col("alone"))
                                 .alias("whole"))
    groups = durable(named.join(picked, "cluster").select(
        F.when(F.col("whole"), F.col("cluster")).otherwise(F.col("content")).alias("g"),
        "sid", "label").distinct(), "groups")
    return links.unionByName(_tiles(groups, sets, num, den))


def link(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5,
         threshold: tuple[int, int] = (3, 4)) -> DataFrame:
    """(id_col, n_shingles, component_id) of every row of ``docs``.

    Two rows link when the Jaccard similarity of their shingle sets reaches ``threshold`` (a
    ratio of integers); the component's id is its least id.  A null or wordless text has an empty
    set, links with nothing and is its own component.  Repeated rows stay repeated.  A null id is
    allowed; a component of null ids alone has a null id.  Only the two named columns are read.
    """
    with small_batches(docs.sparkSession):
        return _link(docs, id_col, text_col, k, *threshold)


def _link(docs: DataFrame, id_col: str, text_col: str, k: int, num: int, den: int) -> DataFrame:
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    buckets = buckets_for(rows)
    common = spark.sparkContext.broadcast(common_shingles(rows, "text", k))
    found = durable(rows.mapInArrow(_route(k, num, den, buckets, "id", "text", common), _ROUTED)
                    .repartitionById(buckets, F.col("bucket")).mapInArrow(_meet, _FOUND), "met")
    docs_of = found.filter("kind = 'doc'").select("id", "sid", "n")
    met = durable(found.filter("kind = 'member'").select("content", "sid").distinct(), "members")
    wanted = met.select("sid").distinct()
    reps = durable(docs_of.join(wanted, "sid").groupBy("sid").agg(F.min("id").alias("rep")), "reps")
    bits = _sets_of(rows, durable(reps.select("rep").distinct(), "reps"), k, False)
    close = _close(met.withColumnRenamed("content", "g"), bits, num, den)
    sets = _sets_of(rows, durable(reps.join(close, reps.sid == close.node, "left_semi").select("rep").distinct(),
                                  "reps"), k, True)
    groups = close.select(F.col("label").alias("g"), F.col("node").alias("sid"), F.col("node").alias("label"))
    fits = durable(_blocks(groups, sets).select(
        "g", ((F.col("d") <= _WHOLE) & (F.col("blocks") <= _NEAR)).alias("fits")), "fits")
    links = durable(_tiles(groups.join(fits.filter("fits"), "g").drop("fits"), sets, num, den), "links")
    large = groups.join(fits.filter("not fits"), "g").select("g", "sid")
    rest = durable(met.select("content", "sid").join(large, "sid")
                   .select(F.xxhash64("content", "g").alias("content"), "sid").distinct(), "rest")
    if not rest.isEmpty():
        links = durable(links.unionByName(_large_links(rest, sets, num, den)).distinct(), "links")
    labels = components.connected(links)
    least = docs_of.filter("n > 0").groupBy("sid").agg(F.min("id").alias("least"),
                                                       F.count("*").alias("copies"))
    named = least.join(labels, least.sid == labels.node, "left").filter(
        "label is not null or copies > 1").select(
        "sid", F.coalesce("label", "sid").alias("label"), "least")
    groups = durable(named, "groups")
    lowest = groups.groupBy("label").agg(F.min("least").alias("component_id"))
    grouped = durable(groups.join(lowest, "label").select("sid", "component_id"), "groups")
    return (docs_of.join(small(grouped), "sid", "left")
            .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                    F.coalesce("component_id", "id").alias("component_id")))

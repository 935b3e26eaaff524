"""Token ids in Huffman-coded files, in order of document id.

Documents are tokenized once; the ids go into a written table by range of document id.  Global
counts of the ids give one canonical code whose words have at most ``MAX_BITS`` bits.  Each range
becomes one file: code lengths, document ids and lengths, and the coded ids, with a checkpoint (a
bit offset) every ``LANE`` ids.  The stretches between checkpoints are decoded independently, all of
a file side by side, through one table lookup per id.

File: ``TMHF1\\n``, the length of a JSON header in 4 bytes, the header, then zlib-compressed code
lengths (uint8), document ids (int64), ids per document (int64), checkpoints (int64) and the bits,
each as long as the header says; numbers are little-endian, bits begin with the highest.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import shards, words
from tidemark.llm.frames import block_of, buckets_for, key_edges, small_batches
from tidemark.workspace import new_path

_U = np.uint64
MAX_BITS = 16
LANE = 512
_SLICE = 512 * LANE
#: Words whose ids a worker remembers from one piece to the next.
REMEMBERED = 800_000
#: Stands for a null document id, which comes first.
NO_ID = -(1 << 63)
_MAGIC = b"TMHF1\n"


# tokenizing

_APART, _LETTER, _SIGN, _JOINED = 0, 1, 2, 3
_CLASS = np.full(256, _SIGN, dtype=np.uint8)
_CLASS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = _APART
_CLASS[0x61:0x7B] = _LETTER
_CLASS[0x80:] = _JOINED
_CLASS[[0x27, 0x5F, *range(0x00, 0x09), *range(0x0E, 0x20), 0x7F]] = _JOINED


_PROBES = ["The quick Brown fox, it's 42 o'clock!", "  two  spaces\nand\ta tab ", "UPPER lower MiXeD",
           "na\u00efve caf\u00e9 \u00c9T\u00c9", "a-b_c.d/e(f)[g]{h}", "x=1;y+=2;z!=3", "1234567 12.5%",
           "don't 'quote' \"double\"", "\u4f60\u597d \u4e16\u754c", "\U0001f600 smile", "", "...", "a\r\nb\x0bc"]


class Encoder:
    """Ids of whole texts, through a memory of the ids of their chunks.

    For tokenizers that drop white space, lower-case, and split letters from signs.  A text is cut
    at white space and between ASCII letters and other ASCII signs, never at an apostrophe or next
    to other characters, so no token reaches over a cut.  Texts with ``<|``, where a special token
    could be, go to the tokenizer whole.  A tokenizer of another kind shows on the probes, and then
    all texts go to it whole.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self._forget()
        self.by_chunks = True
        ids, _ = self.encode(pa.array(_PROBES, pa.string()), 0)
        self.by_chunks = ids.tolist() == [x for t in _PROBES for x in [*self._whole(t), 0]]
        self._forget()

    def _forget(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.start = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def _whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _learn(self, hashes: np.ndarray, chunks: list[bytes]) -> None:
        model = self.tokenizer.model
        ids = [[t.id for t in model.tokenize(c.decode())] if c.isalpha() and c.isascii()
               else self._whole(c.decode()) for c in chunks]
        count = np.array([len(i) for i in ids], np.int64)
        start = len(self.flat) + np.cumsum(count) - count
        self.flat = np.concatenate([self.flat, np.array([x for i in ids for x in i], np.uint32)])
        at = np.searchsorted(self.known, hashes)
        self.known, self.start, self.count = (np.insert(a, at, b) for a, b in (
            (self.known, hashes), (self.start, start), (self.count, count)))

    def encode(self, column: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each closed by ``end``; ids per text)."""
        if not self.by_chunks:
            parts = [np.array([*self._whole(t or ""), end], np.uint32) for t in column.to_pylist()]
            return (np.concatenate(parts) if parts else np.zeros(0, np.uint32),
                    np.array([len(p) for p in parts], np.int64))
        data, at = words.text_bytes(column)
        data = words._LOWER[data]
        kind = _CLASS[data]
        n = len(at) - 1
        inside = kind != _APART
        cut = np.ones(len(data) + 1, dtype=bool)  # a chunk may begin here
        if len(data):
            pair = kind[1:] * 4 + kind[:-1]
            cut[1:-1] = (~inside[:-1] | (pair == _LETTER * 4 + _SIGN)
                         | (pair == _SIGN * 4 + _LETTER))
        cut[at] = True
        starts = np.flatnonzero(inside & cut[:-1])
        last = np.append(~inside[1:], True) if len(data) else np.zeros(0, bool)
        ends = np.flatnonzero(inside & (cut[1:] | last)) + 1
        w = words.Words(data, starts, ends, np.searchsorted(starts, at).astype(np.int64), n)
        hashes = w.hashes()
        unique, first, place = np.unique(hashes, return_index=True, return_inverse=True)
        known = self._find(unique)
        new = np.flatnonzero(known < 0)
        if len(new):
            if len(self.known) + len(new) > REMEMBERED:
                self._forget()
                new = np.arange(len(unique))
            for a in range(0, len(new), REMEMBERED):
                part = new[a:a + REMEMBERED]
                self._learn(unique[part], [w.word(i) for i in first[part].tolist()])
            known = self._find(unique)
            if (known < 0).any():
                raise ValueError(f"{int((known < 0).sum())} chunks of a piece have no ids")
        count, start = self.count[known][place], self.start[known][place]
        text = w.text_of()
        each = np.bincount(text, count, n).astype(np.int64) + 1
        # where each chunk's ids go: after those before it and the ends of earlier texts
        to = np.cumsum(count) - count + text
        total = int(count.sum())
        within = np.arange(total) - np.repeat(np.cumsum(count) - count, count)
        ids = np.full(total + n, end, dtype=np.uint32)
        ids[np.repeat(to, count) + within] = self.flat[np.repeat(start, count) + within]
        if len(self.known) > REMEMBERED:  # one piece had more
            self._forget()
        special = np.flatnonzero((data[:-1] == 0x3C) & (data[1:] == 0x7C))
        if len(special):
            return self._with_whole(column, ids, each, np.unique(
                np.searchsorted(at, special, "right") - 1), end)
        return ids, each

    def _with_whole(self, column, ids, each, texts, end) -> tuple[np.ndarray, np.ndarray]:
        parts = np.split(ids, np.cumsum(each)[:-1])
        for i in texts.tolist():
            parts[i] = np.array(self._whole(column[i].as_py()) + [end], np.uint32)
        return np.concatenate(parts), np.array([len(p) for p in parts], np.int64)

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.known):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.known, hashes), len(self.known) - 1)
        return np.where(self.known[at] == hashes, at, -1)


# the code

def code_lengths(counts: np.ndarray, most: int = MAX_BITS) -> np.ndarray:
    """Lengths of an optimal prefix code of at most ``most`` bits, by package-merge; 0: unused."""
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.uint8)
    n = len(used)
    if n < 2:
        out[used] = 1
        return out
    if n > 1 << most:
        raise ValueError(f"{n} ids do not fit into codes of {most} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.float64)
    level, leaf = leaves, [np.ones(n, dtype=bool)]
    for _ in range(most - 1):
        half = len(level) // 2 * 2
        both = np.concatenate([leaves, level[0:half:2] + level[1:half:2]])
        sort = np.argsort(both, kind="stable")
        level = both[sort]
        leaf.append(sort < n)
    take = 2 * n - 2
    for flags in reversed(leaf):
        own = int(flags[:take].sum())
        out[order[:own]] += 1
        take = 2 * (take - own)
    return out


def canonical(lengths: np.ndarray) -> np.ndarray:
    """The code words: counted upwards in order of length and id."""
    codes = np.zeros(len(lengths), np.int64)
    used = np.flatnonzero(lengths)
    if not len(used):
        return codes
    order = used[np.lexsort((used, lengths[used]))]
    most = int(lengths.max())
    size = np.left_shift(1, most - lengths[order].astype(np.int64))
    codes[order] = (np.cumsum(size) - size) >> (most - lengths[order].astype(np.int64))
    return codes


def pack(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[bytes, np.ndarray]:
    """(bits, bit offset of every ``LANE``-th id), made in slices to bound the memory."""
    out, points, at_bit = bytearray(), [], 0
    for a in range(0, len(ids), _SLICE):
        part = ids[a:a + _SLICE]
        size = lengths[part].astype(np.int64)
        end = np.cumsum(size)
        at = end - size + (at_bit & 7)
        window = codes[part] << (40 - (at & 7) - size)  # five bytes hold any shifted code
        total = (int(end[-1]) + (at_bit & 7) + 7) // 8
        some = np.zeros(total + 5)
        for j in range((7 + int(size.max()) + 7) // 8):
            some += np.bincount((at >> 3) + j, ((window >> (32 - 8 * j)) & 0xFF)
                                .astype(np.float64), total + 5)
        some = some[:total].astype(np.uint8)
        if at_bit & 7:  # the first byte is the rest of the last one
            some[0] |= out.pop()
        points.append(at[::LANE] - (at_bit & 7) + at_bit)
        out += some.tobytes()
        at_bit += int(end[-1])
    return bytes(out), np.concatenate(points) if points else np.zeros(0, np.int64)


def unpack(bits: bytes, lengths: np.ndarray, checkpoints: np.ndarray, n: int) -> np.ndarray:
    """The ids again: step by step, in all stretches at once."""
    if not n:
        return np.zeros(0, np.uint32)
    most = int(lengths.max())
    used = np.flatnonzero(lengths)
    order = used[np.lexsort((used, lengths[used]))]
    repeat = np.left_shift(1, most - lengths[order].astype(np.int64))
    symbol = np.zeros(1 << most, np.uint32)
    width = np.ones(1 << most, np.int64)
    filled = int(repeat.sum())
    symbol[:filled] = np.repeat(order, repeat)
    width[:filled] = np.repeat(lengths[order], repeat)
    data = np.frombuffer(bits + bytes(8), np.uint8)
    at = checkpoints.astype(np.int64)
    out = np.zeros((LANE, len(at)), np.uint32)
    spare = n - (len(at) - 1) * LANE  # ids in the last stretch
    for step in range(LANE if len(at) > 1 else spare):
        if step == spare:
            at = at[:-1]
        byte = at >> 3
        window = np.zeros(len(at), np.int64)
        for j in range(4):
            window = window << 8 | data[byte + j]
        key = (window >> (32 - most - (at & 7))) & ((1 << most) - 1)
        out[step, :len(at)] = symbol[key]
        at = at + width[key]
    return out.T.reshape(-1)[:n]


def as_file(ids: np.ndarray, each: np.ndarray, docs: np.ndarray, start: int,
            lengths: np.ndarray) -> bytes:
    bits, checkpoints = pack(ids, lengths, canonical(lengths))
    parts = [zlib.compress(lengths.tobytes()), docs.astype("<i8").tobytes(),
             each.astype("<i8").tobytes(), checkpoints.astype("<i8").tobytes(), bits]
    head = json.dumps({"start": start, "docs": len(docs), "ids": len(ids), "lane": LANE,
                       "sizes": [len(p) for p in parts],
                       "crc32": zlib.crc32(b"".join(parts))}).encode()
    return b"".join([_MAGIC, len(head).to_bytes(4, "little"), head, *parts])


def from_file(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(ids, ids per document, document ids, number of ids before the file)."""
    if data[:len(_MAGIC)] != _MAGIC:
        raise ValueError("not a token file")
    at = len(_MAGIC) + 4
    size = int.from_bytes(data[at - 4:at], "little")
    head = json.loads(data[at:at + size])
    at += size
    if zlib.crc32(data[at:]) != head["crc32"]:
        raise ValueError("a token file is damaged")
    parts = []
    for size in head["sizes"]:
        parts.append(data[at:at + size])
        at += size
    lengths = np.frombuffer(zlib.decompress(parts[0]), np.uint8)
    ids = unpack(parts[4], lengths, np.frombuffer(parts[3], "<i8"), head["ids"])
    return ids, np.frombuffer(parts[2], "<i8"), np.frombuffer(parts[1], "<i8"), head["start"]


# the job

_TOKENS = "block int, n long, docs binary, counts binary, ids binary"


def _tokenize(path: str, end: int, edges: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, squeeze = Encoder(path), zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for piece in words.pieces(batch, "text", 2 << 20):
                ids, each = encoder.encode(piece.column("text"), end)
                keys = piece.column("id").fill_null(NO_ID).to_numpy(zero_copy_only=False)
                block = piece.column("block").to_numpy(zero_copy_only=False)
                begin = np.cumsum(each) - each
                rows = {c: [] for c in ("block", "n", "docs", "counts", "ids")}
                for b in np.unique(block).tolist():
                    own = np.flatnonzero(block == b)
                    part = np.concatenate([ids[begin[i]:begin[i] + each[i]] for i in own])
                    rows["block"].append(b)
                    rows["n"].append(len(part))
                    rows["docs"].append(keys[own].astype("<i8").tobytes())
                    rows["counts"].append(each[own].astype("<i8").tobytes())
                    rows["ids"].append(squeeze.compress(_narrow(part)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows["block"], pa.int32()), pa.array(rows["n"], pa.int64()),
                     *(pa.array(rows[c], pa.binary()) for c in ("docs", "counts", "ids"))],
                    list(rows))
    return run


def _narrow(ids: np.ndarray) -> bytes:
    return b"\2" + ids.astype("<u2").tobytes() if ids.max(initial=0) < 1 << 16 else \
        b"\4" + ids.astype("<u4").tobytes()


def _wide(squeezed: bytes) -> np.ndarray:
    data = zstandard.ZstdDecompressor().decompress(squeezed)
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype(np.uint32)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(0, np.int64)
    for batch in batches:
        for x in batch.column("ids"):
            more = np.bincount(_wide(x.as_py()))
            if len(more) > len(total):
                total, more = more, total
            total[:len(more)] += more
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["id", "n"])


_WRITTEN = "block int, temporary string, name string, bytes long, docs long, ids long"


def _write(root: str, shared):
    """The file of each block that comes, all of whose rows come together."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, starts = shared.value

        def file(block: int, rows: list[dict]) -> pa.RecordBatch:
            docs, each = (np.concatenate([np.frombuffer(r[c], "<i8") for r in rows])
                          for c in ("docs", "counts"))
            ids = np.concatenate([_wide(r["ids"]) for r in rows])
            begin = np.cumsum(each) - each
            # equal ids by their tokens, so that a rerun writes the same bytes
            order = np.argsort(docs, kind="stable")
            same = docs[order]
            for a in np.flatnonzero(np.diff(same) == 0).tolist():
                if a and same[a - 1] == same[a]:
                    continue
                b = int(np.searchsorted(same, same[a], "right"))
                order[a:b] = sorted(order[a:b], key=lambda i: ids[begin[i]:begin[i] + each[i]]
                                    .tobytes())
            ids = np.concatenate([ids[begin[i]:begin[i] + each[i]] for i in order.tolist()])
            data = as_file(ids, each[order], docs[order], starts[block], lengths)
            shard = shards.Shard(root, f"tokens-{block:07d}.tmhf")
            shard.write(data)
            row = shard.close() | {"block": block, "docs": len(docs), "ids": len(ids)}
            return pa.RecordBatch.from_pylist([row], pa.schema(
                [("block", pa.int32()), ("temporary", pa.string()), ("name", pa.string()),
                 ("bytes", pa.int64()), ("docs", pa.int64()), ("ids", pa.int64())]))

        block, rows = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if row["block"] != block and rows:
                    yield file(block, rows)
                    rows = []
                block = row["block"]
                rows.append(row)
        if rows:
            yield file(block, rows)
    return run


def write(docs: DataFrame, root: str, tokenizer_path: str, end: int, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """Writes the files into the folder ``root`` and returns the manifest.

    A null text is the empty text (its only id is ``end``).  A null document id comes first and is
    read back as null; equal ids are ordered by their tokens.  Without rows there are no files.
    """
    with small_batches(docs.sparkSession):
        return _write_all(docs, root, tokenizer_path, end, id_col, text_col)


def _write_all(docs: DataFrame, root: str, tokenizer_path: str, end: int, id_col: str,
               text_col: str) -> DataFrame:
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    edges = key_edges(rows, "id", buckets_for(rows))
    path = new_path(spark, "tokens")
    (rows.withColumn("block", block_of(F.col("id"), edges).cast("int"))
     .mapInArrow(_tokenize(tokenizer_path, end, edges), _TOKENS).write.parquet(path))
    tokens = spark.read.schema(_TOKENS).parquet(path)
    counted = tokens.select("ids").mapInArrow(_count, "id long, n long").groupBy("id").agg(
        F.sum("n").alias("n")).collect()  # one row for each id of the vocabulary
    counts = np.zeros(max((r["id"] for r in counted), default=-1) + 1, np.int64)
    for r in counted:
        counts[r["id"]] = r["n"]
    starts, before = {}, 0
    for r in tokens.groupBy("block").agg(F.sum("n").alias("n")).orderBy("block").collect():
        starts[r["block"]], before = before, before + r["n"]
    # longer codes where the vocabulary needs them; unpacking takes up to 24 bits
    most = min(24, max(MAX_BITS, int(np.count_nonzero(counts)).bit_length() + 1))
    shared = spark.sparkContext.broadcast((code_lengths(counts, most), starts))
    written = (tokens.repartitionById(len(edges) + 1, F.col("block")).sortWithinPartitions("block")
               .mapInArrow(_write(root, shared), _WRITTEN))
    return shards.publish(written, root)


def read(manifest: DataFrame, root: str, with_ids: bool = True) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and ids) of every document in the manifest's files."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column("name").to_pylist():
                with shards.read_bytes(root, name) as f:
                    ids, each, docs, start = from_file(f.readall())
                ends = np.cumsum(each)
                for a in range(0, len(docs), 512):
                    cut = slice(a, a + 512)
                    parts = [ids[e - n:e] for e, n in zip(ends[cut], each[cut])]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(docs[cut], pa.int64(), mask=docs[cut] == NO_ID),
                         pa.array(start + ends[cut] - each[cut]), pa.array(each[cut]),
                         pa.array([zlib.crc32(p.astype("<u4").tobytes()) for p in parts],
                                  pa.int64()),
                         *([pa.array([p.astype(np.int32) for p in parts], pa.list_(pa.int32()))]
                           if with_ids else [])], columns)
    columns = ["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids
    n = max(1, manifest.count())
    return manifest.select("name").repartition(n).mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long"
             + ", ids array<int>" * with_ids)

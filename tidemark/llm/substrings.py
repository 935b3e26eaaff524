"""Removal of word sequences that a corpus holds more than once, by suffix automata of shards.

A window is ``length`` consecutive words.  A window is repeated if its words also start anywhere else.
All words that repeated windows cover go, in every place, so what goes are maximal spans.

Streaming every text through an automaton of every shard would be quadratic in the corpus, so texts
meet only the shards that can hold their windows:

1.  Of each window one short word sequence is chosen by its content, the one of least hash; it is
    the window's anchor.  Neighbouring windows that share an anchor form a piece of the text.  Equal
    windows have equal anchors, so only pieces whose anchor occurs twice are looked at further.
2.  Equal pieces of one anchor are one reference entry with a count.  The entries of an anchor belong
    to one shard.  An anchor with very many different contexts is split: there each window is an
    entry by itself, and equal windows meet wherever they come from.
3.  A shard is a generalised suffix automaton of bounded size, weighted by the counts.  Pieces are
    streamed through it for their matching statistics: the longest sequence that ends at each word and
    starts at least twice.  Where it reaches ``length``, a repeated window ends.
4.  The windows found go back to their texts, which are read once more to drop the spans.

Texts move once: they are written in buckets by a number of their own, and all later joins are on it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import words
from tidemark.llm.frames import buckets_for, small_batches, token
from tidemark.workspace import durable, fan_out, new_path

LENGTH = 35
#: Words of an anchor.  Shorter ones give longer pieces, longer ones are seldom equal by chance.
GRAM = 8
#: Words of a shard's automaton; one entry more may exceed it.
SHARD_WORDS = 50_000
#: An anchor with more different contexts than this is split into single windows.
CONTEXTS = 1000
_U = np.uint64
#: Bytes of text that a task turns into arrays at once.
_PART = 1 << 20
#: A key of more than one in so many rows is dealt to several tasks; there are fewer such keys.
_SLICES = 1000
_OUT = ("doc_id long, n_words long, n_removed long, kept string, "
        "spans array<struct<start: int, end: int>>")


class Automaton:
    """A generalised suffix automaton whose states count the weighted starts of their sequences."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.count = [-1], [0], [0]
        self.often: list[int] = []

    def add(self, sequence: list[int], weight: int) -> None:
        last, count = 0, self.count
        for symbol in sequence:
            last = self._extend(last, symbol)
            count[last] += weight

    def _state(self, length: int, link: int, moves: dict[int, int]) -> int:
        self.next.append(moves)
        self.length.append(length)
        self.link.append(link)
        self.count.append(0)
        return len(self.length) - 1

    def _split(self, p: int, symbol: int, q: int) -> int:
        """The state of the sequences of ``q`` that ``p`` leads to, apart from the longer ones."""
        moves, link = self.next, self.link
        clone = self._state(self.length[p] + 1, link[q], dict(moves[q]))
        while p >= 0 and moves[p].get(symbol) == q:
            moves[p][symbol] = clone
            p = link[p]
        link[q] = clone
        return clone

    def _extend(self, last: int, symbol: int) -> int:
        moves, link, length = self.next, self.link, self.length
        q = moves[last].get(symbol)
        if q is not None:
            return q if length[q] == length[last] + 1 else self._split(last, symbol, q)
        new, p = self._state(length[last] + 1, 0, {}), last
        while p >= 0 and symbol not in moves[p]:
            moves[p][symbol] = new
            p = link[p]
        if p >= 0:
            q = moves[p][symbol]
            link[new] = q if length[q] == length[p] + 1 else self._split(p, symbol, q)
        return new

    def finish(self, least: int = 2) -> None:
        """Sums the counts up the suffix links; per state the longest of its suffixes, not itself, that
        starts ``least`` times."""
        order = np.argsort(np.array(self.length), kind="stable").tolist()
        for state in reversed(order[1:]):
            self.count[self.link[state]] += self.count[state]
        self.often, self.least = [0] * len(order), least
        for state in order[1:]:
            up = self.link[state]
            self.often[state] = self.length[up] if self.count[up] >= least else self.often[up]

    def statistics(self, sequence: list[int]) -> list[int]:
        """Per symbol, the length of the longest sequence that ends there and starts often enough."""
        out, state, long = [], 0, 0
        for symbol in sequence:
            while state and symbol not in self.next[state]:
                state = self.link[state]
                long = self.length[state]
            state = self.next[state].get(symbol, 0)
            long = long + 1 if state else 0
            out.append(long if self.count[state] >= self.least else self.often[state])
        return out


def anchored(column: pa.Array, length: int = LENGTH, gram: int = GRAM):
    """(text, first window, number of windows, anchor, digest) of the pieces of texts, as arrays."""
    w = words.words(column, words.NOT_SPACE, lower=False)
    h, n = w.hashes(), length - gram + 1
    starts = len(h) - length + 1
    if starts < 1:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, _U),) * 2
    grams = len(h) - gram + 1
    g = words.shingle_hashes(h, gram)
    least = (g >> _U(32) << _U(32)) | np.arange(grams, dtype=_U)
    have = 1
    while 2 * have <= n:  # least over runs of 1, 2, 4, ... places, then of n
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    if have < n:
        least = np.minimum(least[:starts], least[n - have:n - have + starts])
    chosen = (least[:starts] & _U(0xFFFFFFFF)).astype(np.int64)
    text = w.text_of()
    valid = np.flatnonzero(text[:starts] == text[length - 1:])
    if not len(valid):
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, _U),) * 2
    cut = np.flatnonzero(np.r_[True, (chosen[valid[1:]] != chosen[valid[:-1]])
                               | (text[valid[1:]] != text[valid[:-1]])])
    first, many = valid[cut], np.diff(np.r_[cut, len(valid)])
    return (text[first], first - w.first[text[first]], many, g[chosen[first]],
            words.span_hashes(h, first, first + many + length - 1))


def _pieces(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """(h, pd, rid, at, n): one row per piece of each text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.pieces(batch, "text", _PART):
                text, first, n, h, pd = anchored(part.column("text"), length, gram)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)), pa.array(pd.view(np.int64)),
                     part.column("rid").take(pa.array(text)), pa.array(first, pa.int32()),
                     pa.array(n, pa.int32())], ["h", "pd", "rid", "at", "n"])

    return docs.select("rid", "text").mapInArrow(run, "h long, pd long, rid long, at int, n int")


def _joined(rows: DataFrame, known: DataFrame, on: list[str], hot: DataFrame) -> DataFrame:
    """``rows`` whose key is in ``known`` (unique keys); rows of the ``hot`` keys are spread."""
    salts = fan_out(rows.sparkSession)
    hot = F.broadcast(hot.select(*on, F.lit(True).alias("hot")))
    left = rows.join(hot, on, "left").withColumn(
        "salt", F.when(F.col("hot"), F.pmod("rid", F.lit(salts))).otherwise(F.lit(0).cast("long")))
    right = known.join(hot, on, "left").withColumn("salt", F.explode(F.when(
        F.col("hot"), F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long")))
        .otherwise(F.array(F.lit(0).cast("long")))))
    return left.drop("hot").join(right.drop("hot"), [*on, "salt"]).drop("salt")


def _hot(counted: DataFrame, n: str) -> DataFrame:
    """The keys of ``counted`` with more than one in ``_SLICES`` of all that ``n`` counts."""
    total = counted.agg(F.sum(n).alias("total")).first()["total"] or 0
    return counted.filter(F.col(n) * _SLICES > total)


def _contents(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """(h, pd, weight, piece): the words of the pieces that ``wanted`` lists by text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.pieces(batch, "text", _PART):
                out: tuple[list, list, list, list] = ([], [], [], [])
                for text, pieces in zip(part.column("text").to_pylist(),
                                        part.column("pieces").to_pylist()):
                    own = text.encode().split()
                    for p in pieces:
                        for to, value in zip(out, (
                                p["h"], p["pd"], p["weight"],
                                b" ".join(own[p["at"]:p["at"] + p["n"] + length - 1]).decode())):
                            to.append(value)
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(x, pa.int64()) for x in out[:3]), pa.array(out[3], pa.string())],
                    ["h", "pd", "weight", "piece"])

    return (docs.join(wanted.hint("shuffle_hash"), "rid").select("text", "pieces")
            .mapInArrow(run, "h long, pd long, weight long, piece string"))


def _repeated(entries: DataFrame, length: int, shard_words: int) -> DataFrame:
    """(h, pd, bits): the windows of each entry that start at least twice in its shard.

    ``entries`` are (h, pd, weight, piece), each once; those of one h are in one shard.  A partition
    holds whole shards, one after the other.
    """
    def flush(shard: dict[tuple[int, int], tuple[int, bytes]]) -> pa.RecordBatch:
        symbols: dict[bytes, int] = {}
        automaton, sequences = Automaton(), []
        for weight, piece in shard.values():
            sequences.append([symbols.setdefault(x, len(symbols)) for x in piece.split()])
            automaton.add(sequences[-1], weight)
        automaton.finish()
        bits = [sum(1 << i for i, long in enumerate(automaton.statistics(s)[length - 1:])
                    if long >= length) for s in sequences]
        hs, pds = zip(*shard) if shard else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (hs, pds, bits)],
                                          ["h", "pd", "bits"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, size, last = {}, 0, None
        for batch in batches:
            for h, pd, weight, piece in zip(*(batch.column(c).to_pylist() for c in (
                    "h", "pd", "weight", "piece"))):
                if h != last and size >= shard_words:
                    yield flush(shard)
                    shard, size = {}, 0
                last = h
                shard[h, pd] = (weight, piece.encode())
                size += piece.count(" ") + 1
        yield flush(shard)

    return (entries.repartition(fan_out(entries.sparkSession), "h").sortWithinPartitions("h")
            .mapInArrow(run, "h long, pd long, bits long").filter("bits <> 0"))


def _single(entries: DataFrame, length: int) -> DataFrame:
    """The windows of entries, each with hashes of its own: (h, pd, place, wh, wpd, weight, window)."""
    own = F.split("piece", " ")
    window = F.expr(f"transform(sequence(0, size(own) - {length}), "
                    f"i -> concat_ws(' ', slice(own, i + 1, {length})))")
    return (entries.withColumn("own", own)
            .select("h", "pd", "weight", F.posexplode(window).alias("place", "window"))
            .withColumn("wh", F.xxhash64("window"))
            .withColumn("wpd", F.xxhash64("window", F.lit(1))))


def repeated_windows(docs: DataFrame, length: int = LENGTH, gram: int = GRAM,
                     shard_words: int = SHARD_WORDS, contexts: int = CONTEXTS) -> DataFrame:
    """(rid, found: array of (first window, bits)) of the texts of ``docs`` (rid, text)."""
    pieces = durable(_pieces(docs, length, gram), "pieces")
    often = durable(pieces.groupBy("h").agg(F.count("*").alias("many")).filter("many > 1"), "anchors")
    met = durable(_joined(pieces, often.select("h"), ["h"], _hot(often, "many")), "met")
    distinct = durable(met.groupBy("h", "pd").agg(
        F.count("*").alias("weight"), F.min(F.struct("rid", "at", "n")).alias("in")), "entries")
    wanted = distinct.groupBy("in.rid").agg(F.collect_list(F.struct(
        "h", "pd", "weight", "in.at", "in.n")).alias("pieces"))
    entries = durable(_contents(docs, wanted, length), "contents")
    contexts_of = distinct.groupBy("h").agg(F.count("*").alias("many"))
    wide = durable(contexts_of.filter(F.col("many") > contexts), "wide")
    if wide.isEmpty():
        found = durable(_repeated(entries, length, shard_words), "repeated")
    else:
        narrow = entries.join(wide.select("h"), "h", "left_anti")
        broad = _joined(entries.withColumn("rid", F.col("pd")), wide.select("h"), ["h"],
                        _hot(wide, "many"))
        single = durable(_single(broad, length), "single")
        windows = (single.groupBy("wh", "wpd").agg(F.sum("weight").alias("weight"),
                                                   F.first("window").alias("piece"))
                   .withColumnsRenamed({"wh": "h", "wpd": "pd"}))
        again = durable(_repeated(windows, length, shard_words)
                        .select(F.col("h").alias("wh"), F.col("pd").alias("wpd")), "again")
        places = single.select("h", "pd", "place", "wh", "wpd", F.col("pd").alias("rid"))
        counted = single.groupBy("wh", "wpd").agg(F.count("*").alias("many"))
        split = (_joined(places, again, ["wh", "wpd"], _hot(durable(counted, "counted"), "many"))
                 .groupBy("h", "pd").agg(F.bit_or(F.expr("shiftleft(1L, place)")).alias("bits")))
        found = durable(_repeated(narrow, length, shard_words).unionByName(split), "repeated")
    return durable(_joined(met, found, ["h", "pd"], _hot(distinct, "weight"))
                   .groupBy("rid").agg(F.collect_list(F.struct("at", "bits")).alias("found")),
                   "found")


def _spans(found: list[dict], n: int, length: int) -> list[tuple[int, int]]:
    """Maximal spans of covered words from the windows found."""
    edge = np.zeros(n + 1, np.int64)
    for f in found:
        for i in range(f["bits"].bit_length()):
            if f["bits"] >> i & 1:
                edge[f["at"] + i] += 1
                edge[f["at"] + i + length] -= 1
    inside = np.r_[0, (np.cumsum(edge)[:-1] > 0).astype(np.int8), 0]
    step = np.diff(inside)
    return list(zip(np.flatnonzero(step == 1).tolist(), np.flatnonzero(step == -1).tolist()))


def _without(length: int):
    """Texts (doc_id, text, found) without the windows found."""
    def rows(part: pa.RecordBatch) -> pa.RecordBatch:
        sizes, removed, kept, spans = [], [], [], []
        for text, found in zip(part.column("text").to_pylist(), part.column("found").to_pylist()):
            own = text.encode().split()
            gone = _spans(found, len(own), length) if found else []
            sizes.append(len(own))
            removed.append(sum(b - a for a, b in gone))
            left = zip([0, *(b for _, b in gone)], [*(a for a, _ in gone), len(own)])
            kept.append(b" ".join(x for a, b in left for x in own[a:b]).decode())
            spans.append([{"start": a, "end": b} for a, b in gone])
        pair = pa.struct([("start", pa.int32()), ("end", pa.int32())])
        return pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()),
             pa.array(kept, pa.string()), pa.array(spans, pa.list_(pair))],
            ["doc_id", "n_words", "n_removed", "kept", "spans"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.pieces(batch, "text", _PART):
                yield rows(part)
    return run


def remove(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, shard_words: int = SHARD_WORDS,
           contexts: int = CONTEXTS) -> DataFrame:
    """(doc_id, n_words, n_removed, kept, spans) of every row: the text without its repeated windows.

    ``kept`` are the words left, joined by one space; ``spans`` the word ranges removed.  Windows are
    judged on the input.  Null and empty texts have no words; texts of fewer words than a window keep
    all of them.  Equal rows count as two texts, so both go.  Null and repeated ids are only carried
    along.  Very long texts are read whole.  No rows give no rows; extra columns are not read.
    """
    if not 0 < length - gram + 1 <= 62:
        raise ValueError("a window holds its anchor and at most 61 words more")
    spark = docs.sparkSession
    name, buckets = f"tidemark_texts_{token()}", buckets_for(docs)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.coalesce("text", F.lit("")).alias("text"))
    (texts.withColumn("rid", F.monotonically_increasing_id())
     .repartition(buckets, "rid").write.bucketBy(buckets, "rid")
     .option("path", new_path(spark, "texts")).option("compression", "zstd").saveAsTable(name))
    try:
        dealt = spark.table(name)
        with small_batches(spark):
            found = repeated_windows(dealt, length, gram, shard_words, contexts)
        return (dealt.join(found.hint("shuffle_hash"), "rid", "left")
                .select("doc_id", "text", "found").mapInArrow(_without(length), _OUT))
    finally:
        # the files stay, and the plan knows them
        spark.sql(f"DROP TABLE IF EXISTS {name}")

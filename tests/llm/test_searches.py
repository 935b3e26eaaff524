"""Substring removal, Merkle manifests and lexical search against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import make
from tests_llm_tools import TEXT
from tidemark.llm import lexical, merkle, substrings, words
from tidemark.llm.frames import crc_of_id

LOWER = {i: i + 32 for i in range(65, 91)}


# --- removal of repeated windows --------------------------------------------------

def without(texts, length):
    split = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    starts = Counter(tuple(w[i:i + length]) for w in split for i in range(len(w) - length + 1))
    for w in split:
        gone = {p for i in range(len(w) - length + 1) if starts[tuple(w[i:i + length])] > 1
                for p in range(i, i + length)}
        yield len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone)


def removed(df, **how):
    return sorted((r.doc_id is None, r.doc_id or 0, r.n_words, r.n_removed, r.kept)
                  for r in substrings.remove(df, **how).collect())


def expected(rows, length=35):
    return sorted((i is None, i or 0, *x) for (i, *_), x in zip(
        rows, without([r[1] for r in rows], length)))


def passages(seed, n):
    """Texts that share passages, repeat themselves and copy each other."""
    rnd = random.Random(seed)
    shared = [[f"s{k}w{rnd.randrange(9)}" for _ in range(rnd.choice([20, 34, 35, 36, 60, 200]))]
              for k in range(6)]
    rows = []
    for i in range(n):
        own = []
        for _ in range(rnd.randrange(5)):
            own += [f"u{rnd.randrange(30)}" for _ in range(rnd.randrange(40))]
            part = rnd.choice(shared)
            a = rnd.randrange(len(part))
            own += part[a:a + rnd.randrange(5, 90)]
            if rnd.random() < 0.3 and own:
                own[rnd.randrange(len(own))] = "changed"
        rows.append((i, rnd.choice([" ", "\n", "\t \x0b"]).join(own), "en", "a"))
        if rnd.random() < 0.2:
            rows.append((1000 + i, rows[-1][1], "en", "b"))
    return rows


@pytest.mark.parametrize("how", [{}, {"contexts": 1}, {"shard_words": 1}, {"gram": 3}])
def test_repeated_windows_equal_brute_force(spark, how):
    rows = passages(7, 60)
    assert removed(make(spark, rows).repartition(4), **how) == expected(rows)


def test_periodic_and_long_texts(spark):
    rows = [(1, "a " * 34, "en", "a"), (2, "a " * 35, "en", "a"), (3, "b " * 36, "en", "a"),
            (4, "a b " * 300, "en", "a"), (5, "x" * 3_000_000, "en", "a"),
            (6, " ".join(f"w{i}" for i in range(120_000)), "en", "a"), (7, "\n" * 100_000, "en", "a"),
            (8, " ".join(f"w{i}" for i in range(70_000, 70_040)), "en", "a")]
    assert removed(make(spark, rows)) == expected(rows)


def test_odd_rows_of_substrings(spark, odd, none):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert removed(odd, length=12) == expected(rows, 12)
    assert removed(none) == []
    with pytest.raises(ValueError):
        substrings.remove(odd, length=200)


def test_many_edited_copies_meet(spark):
    """One anchor in more contexts than are compared in one shard."""
    base = [f"w{i}" for i in range(90)]
    rows = []
    for i in range(400):
        own = list(base)
        own[random.Random(i).randrange(90)] = f"x{i}"
        rows.append((i, " ".join(own), "en", "a"))
    assert removed(make(spark, rows).repartition(5), contexts=20) == expected(rows)


def test_automaton_statistics():
    rnd = random.Random(2)
    for _ in range(60):
        many = [[rnd.randrange(3) for _ in range(rnd.randrange(25))] for _ in range(4)]
        weights = [rnd.choice([1, 1, 2]) for _ in many]
        automaton = substrings.Automaton()
        for s, w in zip(many, weights):
            automaton.add(s, w)
        automaton.finish()
        starts = Counter()
        for s, w in zip(many, weights):
            for a in range(len(s)):
                for b in range(a + 1, len(s) + 1):
                    starts[tuple(s[a:b])] += w
        query = [rnd.randrange(4) for _ in range(20)]
        want = [max([n for n in range(1, i + 2) if starts[tuple(query[i + 1 - n:i + 1])] > 1],
                    default=0) for i in range(20)]
        assert automaton.statistics(query) == want


def test_equal_windows_have_equal_anchors():
    rnd = random.Random(4)
    texts = [" ".join(rnd.choice("abc") for _ in range(rnd.randrange(60))) for _ in range(80)]
    text, first, n, h, _ = substrings.anchored(pa.array(texts), 9, 3)
    seen, total = {}, 0
    for t, a, m, anchor in zip(text.tolist(), first.tolist(), n.tolist(), h.tolist()):
        for s in range(a, a + m):
            total += 1
            assert seen.setdefault(tuple(texts[t].split()[s:s + 9]), anchor) == anchor
    assert total == sum(max(0, len(t.split()) - 8) for t in texts)


def test_span_hashes_stand_for_runs():
    h = words.words(pa.array(["a b c a b", "b c"]), words.NOT_SPACE).hashes()
    got = words.span_hashes(h, np.array([0, 3, 1, 5]), np.array([2, 5, 3, 7]))
    assert got[0] == got[1] and got[2] == got[3] and got[0] != got[2]


# --- Merkle manifest --------------------------------------------------------------

def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def climb(nodes):
    """The root of ``nodes`` and the siblings and sides of each."""
    paths, where = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, at in enumerate(where):
            other = at ^ 1
            paths[i].append((nodes[other], at & 1) if other < len(nodes) else None)
            where[i] = at // 2
        nodes = [H(*nodes[i:i + 2]) for i in range(0, len(nodes), 2)]
    return nodes[0], paths


def proofs(rows, tampered):
    by = {}
    for row in rows:
        by.setdefault(row[2], []).append(row)
    order = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    trees = {k: climb([leaf(r) for r in sorted(by[k], key=lambda r: (
        r[0] is not None, r[0] or 0, leaf(r)))]) for k in order}
    root, above = climb([trees[k][0] for k in order])
    for k, over in zip(order, above):
        own = sorted(by[k], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        for row, path in zip(own, trees[k][1]):
            folded, path = leaf(tampered(row)), [p for p in path + over]
            for p in path:
                folded = H(folded) if p is None else H(p[0], folded) if p[1] else H(folded, p[0])
            yield (row[0], leaf(row), trees[k][0], root, H(*(p[0] for p in path if p)), folded,
                   folded == root)


def tamper(row):
    hit = zlib.crc32(("" if row[0] is None else str(row[0])).encode()) % 7 == 0
    return (*row[:3], row[3] + 1, row[4]) if hit and row[3] is not None else row


@pytest.mark.parametrize("height", [1, 2, 3, 12])
def test_proofs_equal_plain_python(spark, odd, height):
    many = [(i, None if i % 13 == 0 else f"text é{i}", ["en", None, "fr", "", "ß", "de"][min(
        5, i % 11)], "a") for i in range(90)]
    df = make(spark, many).unionByName(odd)
    rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in df.collect()]
    hit = F.when(crc_of_id(F.col("doc_id")) % 7 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    manifest = merkle.build(df, {"n_chars": hit}, height)
    got = merkle.prove(manifest).drop("tree").collect()
    key = lambda r: tuple((v is not None, v) for v in r)
    assert sorted((tuple(r) for r in got), key=key) == sorted(proofs(rows, tamper), key=key)
    assert manifest.root().hex() == got[0].root


def test_empty_and_lone_documents(spark, none):
    assert merkle.prove(merkle.build(none)).count() == 0 and merkle.build(none).root() is None
    lone = make(spark, [(3, "text", "en", "a")])
    row = merkle.prove(merkle.build(lone)).first()
    assert row.leaf == row.subroot == row.root == row.folded_root and row.verified
    assert row.proof_sha256 == H()


@pytest.mark.parametrize("levels", [1, 2, 3, 5, 8, 13])
def test_addresses_are_a_layout_by_halves(levels):
    places = [merkle.address(levels, d, np.arange(1 << d)) for d in range(levels)]
    assert sorted(np.concatenate(places).tolist()) == list(range((1 << levels) - 1))
    if levels > 2:  # each lower subtree is contiguous and follows the upper half
        upper = levels // 2
        size = (1 << (levels - upper)) - 1
        for k in range(1 << upper):
            own = np.concatenate([places[d][(k << (d - upper)):((k + 1) << (d - upper))]
                                  for d in range(upper, levels)])
            assert own.min() == (1 << upper) - 1 + k * size and own.max() - own.min() == size - 1


# --- lexical search ---------------------------------------------------------------

def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def ranked(docs, items, k):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    N, L = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    w = {t: math.floor(1000 * math.log((2 * N + 2) / (2 * n + 1))) for t, n in df.items()}
    for item, text in items:
        scores = []
        for i, b in bags:
            m = 10 + 90 * sum(b.values()) * N // L
            s = sum(w[t] * (10**9 * b[t] // (1000 * b[t] + 8 * m)) for t in set(terms(text)) if t in b)
            if s > 0:
                scores.append((-s, i is not None, i or 0))
        for rank, (s, known, i) in enumerate(sorted(scores)[:k], 1):
            yield item, rank, i if known else None, -s


def searched(docs, items, **how):
    return Counter(tuple(r) for r in lexical.search(docs, items, **how).collect())


@pytest.mark.parametrize("how", [{}, {"bits": 3}, {"k": 3, "most": 20}])
def test_search_equals_brute_force(spark, how):
    rnd = random.Random(8)
    word = lambda: f"T{min(rnd.randrange(60), rnd.randrange(60))}"
    docs = [(i, " ".join(word() for _ in range(rnd.choice([1, 5, 30, 200, 900]))), "en", "a")
            for i in range(150)]
    docs += [(500, docs[3][1], "en", "a"), (2, docs[3][1], "en", "a"), (501, "t1 " * 400, "en", "a")]
    items = [(i, ", ".join(word() for _ in range(rnd.randrange(12)))) for i in range(25)]
    items += [(3, items[3][1]), (90, None), (91, "unknown"), (92, "")]
    got = searched(make(spark, docs).repartition(4),
                   spark.createDataFrame(items, "item_id long, text string"), **how)
    assert got == Counter(ranked([d[:2] for d in docs], items, how.get("k", 10)))


def test_odd_rows_of_search(spark, odd, none):
    items = spark.createDataFrame([(1, TEXT), (None, "fox été"), (2, "mot")],
                                  "item_id int, text string")
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    want = Counter(ranked(rows, [tuple(r) for r in items.collect()], 10))
    assert searched(odd, items) == want
    assert searched(none, items) == searched(odd, items.limit(0)) == Counter()


def test_sketches_bound_every_term():
    texts = ["a b b c", None, "", "é É x " * 300, "T" * 2_000_000, " ".join(map(str, range(50_000)))]
    for text, (n, places, counts) in zip(texts, lexical.sketch(pa.array(texts), 6)):
        bag = Counter(terms(text))
        assert n == sum(bag.values()) and len(set(places.tolist())) == len(places)
        by = dict(zip(places.tolist(), counts.tolist()))
        for t, tf in bag.items():
            h = words.words(pa.array([t]), words.ALNUM).hashes()[0]
            assert by[int(h >> np.uint64(58))] >= min(tf, 255)

"""Components by odd sketches against all pairs of full sets."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.llm import oddsketch

FOLDER = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_set(text):
    words = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def plain(rows):
    """Sorted (doc_id, n_shingles, component_id, kept) for (doc_id, text) rows, by all pairs."""
    by_set = {}
    for i, text in rows:
        by_set.setdefault(plain_set(text), []).append(i)
    sets = [s for s in by_set if s]
    above = {s: s for s in by_set}

    def root(s):
        while above[s] is not s:
            s = above[s]
        return s

    for k, a in enumerate(sets):
        for b in sets[k + 1 :]:
            if 100 * min(len(a), len(b)) >= 85 * max(len(a), len(b)):
                inter = len(a & b)
                if 100 * inter >= 85 * (len(a) + len(b) - inter):
                    above[root(a)] = root(b)
    lowest = {}
    for s, ids in by_set.items():
        known = [i for i in ids if i is not None] + lowest.get(root(s), [])
        lowest[root(s)] = [min(known)] if known else []
    out = []
    for i, text in rows:
        s = plain_set(text)
        component = i if not s else (lowest[root(s)] or [None])[0]
        out.append((i, len(s), component, i == component))
    return sorted(out, key=str)


def found(df):
    rows = df.select("doc_id", "n_shingles", "component_id", "kept").collect()
    return sorted(map(tuple, rows), key=str)


def test_query_equals_all_pairs(spark, sample_docs):
    rows = [(r.doc_id, r.text) for r in sample_docs.select("doc_id", "text").collect()]
    assert found(oddsketch.op13_odd_sketches(spark, FOLDER)) == plain(rows)


def copies(base, count, changes, rng):
    out = []
    for _ in range(count):
        words = list(base)
        for _ in range(rng.randrange(changes + 1)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**9)}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("small_blocks", [False, True])
def test_groups_of_near_copies(spark, docs, monkeypatch, small_blocks):
    """Copies on either side of the threshold, groups that chain, and passages many share."""
    if small_blocks:
        for name, value in (("BLOCK", 7), ("BLOCK_BYTES", 4000), ("COMPARED_AT_ONCE", 50), ("HEAVY", 20)):
            monkeypatch.setattr(oddsketch, name, value)
    rng = random.Random(9)
    texts = []
    for group in range(6):
        base = [f"g{group}w{i}" for i in range(150)]
        texts += copies(base, 50, 5, rng)
    chain = [f"c{i}" for i in range(400)]
    texts += [" ".join(chain[k : k + 200]) for k in range(0, 200, 7)]
    passage = [f"p{i}" for i in range(120)]
    texts += [" ".join(passage + [f"o{k}v{i}" for i in range(rng.randrange(5, 60))]) for k in range(80)]
    texts += ["Same Text here"] * 60
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    got = found(oddsketch.near_duplicates(docs(rows)))
    assert got == plain(rows)
    assert 8 < len({r[2] for r in got}) < len(rows) - 200


def test_odd_rows(spark, docs):
    long = " ".join(f"w{i % 7001}" for i in range(60_000))
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "a b"), (5, "A  B\n"), (6, "a b c d e"), (6, "A b c d e"),
            (7, long), (8, long + " more"), (None, long), (None, None), (None, "only these words without id now"),
            (None, "only these words without id now"), (9, "é x y z ü"), (10, "É x y z ü"), (11, "x" * 50_000),
            (12, "\x00 a b c d e f"), (13, "\x00\x00 a b c d e f")]
    table = docs(rows)
    for name in ("row", "node", "bucket", "set_key", "size", "root", "group", "text_hash", "kept"):
        table = table.withColumn(name, F.lit("x"))
    assert found(oddsketch.near_duplicates(table)) == plain(rows)
    assert found(oddsketch.near_duplicates(table.filter("false"))) == []


def test_shingles_are_those_of_words():
    rng = random.Random(2)
    alphabet = "aAbBzZé中 \t\n\x0b\x0c\r\x1c\x00  "
    texts = ["".join(rng.choices(alphabet, k=rng.randrange(60))) for _ in range(2000)]
    texts += ["abcdefgh ABCDEFGHI abcdefghijklmnopq " * 3, "x" * 100 + " y", None]
    seen = {}
    for text, hashed in zip(texts, oddsketch.shingle_sets(texts)):
        words = plain_set(text)
        assert len(words) == len(hashed)
        assert seen.setdefault(words, hashed.tobytes()) == hashed.tobytes()
    assert len(set(seen.values())) == len(seen)


def test_estimates_are_close():
    rng = np.random.default_rng(6)
    errors, ones_at_threshold = [], []
    for _ in range(300):
        pool = rng.integers(0, 2**64, 2000, dtype=np.uint64)
        shared = rng.integers(600, 1000)
        a = pool[: shared + (1000 - shared) // 2]
        b = np.concatenate([pool[:shared], pool[1000 : 1000 + (1000 - shared) // 2]])
        similarity = shared / len(np.union1d(a, b))
        _, sketches = oddsketch.buckets_and_sketches(np.array([oddsketch.samples(np.unique(s)) for s in (a, b)]))
        ones = int(np.bitwise_count((sketches[0] ^ sketches[1]).view(np.uint64)).sum())
        if similarity > 0.7:
            errors.append(oddsketch.estimate(ones) - similarity)
        if similarity >= 0.85:
            ones_at_threshold.append(ones)
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.04
    assert max(ones_at_threshold) < oddsketch.most_ones(85)

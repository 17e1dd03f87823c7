import random

import numpy as np
import xxhash

from tillroll.llm import simhash
from tillroll.llm.components import star_components


def plain_fingerprint(text):
    found = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
             .translate({c: " " for c in range(9, 14)}).split(" ") if w]
    if not found:
        return 0
    shingles = [" ".join(found[i : i + 3]) for i in range(max(1, len(found) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps, max_bits=3):
    """Smallest reachable id of each (id, fingerprint), by comparing all."""
    label = {i: i for i, _ in fps}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in fps:
        for j, b in fps:
            if i < j and (a ^ b).bit_count() <= max_bits:
                x, y = sorted((root(i), root(j)))
                label[y] = x
    return {i: root(i) for i, _ in fps}


def near(base, rng, bits):
    for b in rng.sample(range(64), bits):
        base ^= 1 << b
    return base


def test_fingerprints_and_components_equal_brute_force(sample_docs):
    rows = {r.doc_id: r for r in simhash.simhash_components(sample_docs).collect()}
    texts = {r.doc_id: r.text for r in sample_docs.collect()}
    fps = [(i, plain_fingerprint(t)) for i, t in sorted(texts.items())]
    assert {i: rows[i].fp % 2**64 for i in texts} == dict(fps)
    assert {i: rows[i].component_id for i in texts} == plain_components(fps)
    assert len(set(plain_components(fps).values())) < len(fps)


def test_odd_texts(docs):
    long = " ".join(f"w{i % 7001}" for i in range(200_000))
    given = [(1, None), (2, ""), (3, " \t\n"), (4, "One"), (5, "one"), (6, "one two"), (7, "a b É"),
             (8, long), (9, long), (9, long), (None, "x y z q"), (None, "x y z q"), (10, "Ü b c d")]
    rows = simhash.simhash_components(docs(given)).collect()
    texts = {}
    for i, t in given:
        texts.setdefault(i, t)
    for r in rows:
        assert r.fp % 2**64 == plain_fingerprint(texts[r.doc_id])
    found = {r.doc_id: r.component_id for r in rows}
    assert found[1] == found[2] == found[3] == 1 and found[4] == found[5] == 4
    assert found[9] == 8 and found[None] is None and len(rows) == len(given)
    assert simhash.simhash_components(docs([])).count() == 0


def test_one_row_stays_of_each_group(docs):
    given = docs([(3, "a b c d"), (2, "a b c d"), (2, "a b c d"), (5, "other text here now"), (None, "q")])
    kept = simhash.one_per_component(given.withColumn("fp", given.doc_id)).collect()
    assert sorted((r.doc_id or 0, r.text, r.fp or 0) for r in kept) == [
        (0, "q", 0), (2, "a b c d", 2), (5, "other text here now", 5)]


def test_shards_lose_no_link(spark, monkeypatch):
    """Deep trees, large shards and blocks against brute force, on clustered fingerprints."""
    monkeypatch.setattr(simhash, "LEAF_POINTS", 16)
    monkeypatch.setattr(simhash, "BLOCK", 40)
    monkeypatch.setattr(simhash, "COMPARED_AT_ONCE", 500)
    rng = random.Random(5)
    bases = [rng.getrandbits(64) for _ in range(40)]
    fps = {near(rng.choice(bases), rng, rng.randint(0, 6)) for _ in range(700)}
    fps |= {near(bases[0], rng, rng.randint(0, 3)) for _ in range(300)}
    signed = [int(np.uint64(f).astype(np.int64)) for f in fps]
    points = spark.createDataFrame([(f,) for f in signed], "fp long").repartition(5)
    roots = {r.node: r.root for r in star_components(simhash.fingerprint_links(points)).collect()}
    expected = plain_components([(f, f % 2**64) for f in sorted(signed)])
    assert {f: roots.get(f, f) for f in signed} == expected


def test_fit_does_not_change_the_reach():
    rng = np.random.default_rng(3)
    halves = rng.integers(0, 2**32, 500, dtype=np.uint32)
    tree = simhash.VantageTree.fit(halves[:50], 5, 1)
    row, leaf = tree.reached(halves, 1)
    reached = set(zip(row.tolist(), leaf.tolist()))
    for bit in range(32):
        home = tree.leaves(halves ^ np.uint32(1 << bit))
        assert all((i, n) in reached for i, n in enumerate(home.tolist()))


def test_long_chain_is_one_component(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(0, 400)] + [(9000, 9001)], "a long, b long")
    found = {r.node: r.root for r in star_components(chain).collect()}
    assert found == {i: 0 for i in range(401)} | {9000: 9000, 9001: 9000}


def test_deep_trees_lose_nothing():
    """A tree that is deeper than its sample can fill still finds every half within reach."""
    rng = np.random.default_rng(8)
    halves = rng.integers(0, 2**32, 4000, dtype=np.uint32)
    near = halves ^ (np.uint32(1) << rng.integers(0, 32, 4000, dtype=np.uint32))
    tree = simhash.VantageTree.fit(halves[:500], 15, 1)
    home = tree.leaves(halves)
    row, leaf = tree.reached(near, 1)
    reached = set(zip(row.tolist(), leaf.tolist()))
    assert all((i, home[i]) in reached for i in range(4000))
    assert len(np.unique(home)) > 400


def test_large_leaves_are_cut_without_python(spark, monkeypatch):
    """Cutting large leaves in Python, in small batches, took most of the time at some GB."""
    monkeypatch.setattr(simhash, "LEAF_POINTS", 8)
    monkeypatch.setattr(simhash, "BLOCK", 8)
    points = spark.range(300).selectExpr("xxhash64(id) AS fp")
    plan = simhash.fingerprint_links(points)._jdf.queryExecution().toString()
    assert "FlatMapGroupsInPandas" in plan and "MapInPandas" not in plan.replace(
        "FlatMapGroupsInPandas", "")


def test_two_halves_meet_in_one_leaf(spark):
    """Of two fingerprints with close halves one is searched for in the other's leaf, not both."""
    rng = np.random.default_rng(4)
    high = rng.integers(0, 2**32, 60, dtype=np.uint64)
    high = np.concatenate([high, high ^ (np.uint64(1) << rng.integers(0, 32, 60, dtype=np.uint64))])
    fps = (high << np.uint64(32)) + rng.integers(0, 2**32, 120, dtype=np.uint64)
    trees = [simhash.VantageTree.fit(half, 5, 1) for half in simhash._halves(fps)]
    points = spark.createDataFrame([(int(f),) for f in fps.view(np.int64)], "fp long")
    rows = simhash._routed(points, trees, 1).filter("leaf < 1 << 24").collect()
    home = {r.fp: r.leaf for r in rows if r.is_point}
    searched = {(r.fp, r.leaf) for r in rows if not r.is_point}
    pairs = list(zip(fps[:60].view(np.int64).tolist(), fps[60:].view(np.int64).tolist()))
    for a, b in pairs:
        met = [(a, home[b]) in searched, (b, home[a]) in searched]
        assert any(met) and (home[a] == home[b] or not all(met))
    assert any(home[a] != home[b] for a, b in pairs)

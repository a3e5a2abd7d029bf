"""Fingerprints and components against brute force."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from brute import DOCS, clash, documents
from tidewater.llm import catalog, simhash as S
from tidewater.llm.common import table
from tidewater.llm.components import smallest_reachable


def fingerprint(text, k=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def union(nodes, edges):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for a, b in edges:
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def brute(texts):
    """{doc_id: (fingerprint, component)} of {doc_id: text}."""
    prints = {i: fingerprint(t) for i, t in texts.items()}
    ids = sorted(prints)
    at = np.array([prints[i] for i in ids], np.uint64)
    edges = [(ids[i], ids[int(j) + i + 1]) for i in range(len(ids)) for j in np.flatnonzero(np.bitwise_count(at[i + 1:] ^ at[i]) <= 3)]
    groups = union(ids, edges)
    return {i: (f"{prints[i]:016x}", groups[i]) for i in ids}


def as_dict(df):
    return {r.doc_id: (r.fingerprint, r.component_id) for r in df.collect()}


def test_whole_table_matches_brute_force(spark, sf_dir):
    texts = {r.doc_id: r.text for r in table(spark, sf_dir, "documents").collect()}
    assert as_dict(catalog.queries()["op10_simhash_dedup"](spark, sf_dir)) == brute(texts)


def test_small_and_awkward_texts(spark):
    texts = [None, "", " \n", "one", "ONE", "one two", "É é", "a b c", "a b c d", "x " * 50_000, "a\x0bb\x0cc"] + ["same words in here"] * 30
    docs = clash(documents(spark, texts), "fp", "key", "row", "id")
    assert as_dict(S.near_groups(docs)) == brute(dict(enumerate(texts)))
    kept = S.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, c in brute(dict(enumerate(texts))).values()})
    assert S.near_groups(docs.limit(0)).count() == 0


def test_null_and_repeated_ids(spark):
    docs = spark.createDataFrame([(None, "t u v", None, None, 1), (7, "t u v", None, None, 1), (7, "t u v", None, None, 1), (None, "other words here now", None, None, 1)], DOCS)
    got = sorted((r.doc_id, r.component_id) for r in S.near_groups(docs).collect() if r.doc_id)
    assert got == [(7, 7), (7, 7)]
    assert sum(r.doc_id is None for r in S.near_groups(docs).collect()) == 2


def test_one_row_per_component_with_null_and_repeated_ids(spark):
    """Id 5 has a text that stays and a near copy of id 1's; null ids hold a
    near copy of id 1's text and a text of their own."""
    words = [[f"{c}{i}" for i in range(400)] for c in "abcd"]
    a, b, c, d = (" ".join(w) for w in words)
    rows = [(1, a), (5, a + " "), (5, b), (None, a + "  "), (None, c), (None, c + " "), (8, d), (8, d + " "), (8, d), (9, d)]
    docs = spark.createDataFrame([(i, t, None, None, 1) for i, t in rows], DOCS)
    got = [(r.doc_id, r.text.strip()) for r in S.drop_near_copies(docs.repartition(3)).collect()]
    assert sorted(got, key=str) == sorted([(1, a), (5, b), (None, c), (8, d)], key=str)


@pytest.mark.parametrize("block", [1024, 16])
def test_ring_of_segments_loses_no_link(spark, block):
    """Fingerprints with one to six bits changed, in clusters; with small
    blocks one key's fingerprints are compared in many tasks."""
    rnd = random.Random(2)
    centres = [rnd.getrandbits(64) for _ in range(80)]
    prints = set(centres)
    for centre, copies, bits in [(c, 10, 4) for c in centres] + [(centres[0], 600, 6)]:
        for _ in range(copies):
            x = centre
            for _ in range(rnd.randint(1, bits)):
                x ^= 1 << rnd.randrange(64)
            prints.add(x)
    at = np.array(sorted(prints), np.uint64)
    signed = at.view(np.int64).tolist()
    edges = [(signed[i], signed[int(j) + i + 1]) for i in range(len(at)) for j in np.flatnonzero(np.bitwise_count(at[i + 1:] ^ at[i]) <= 3)]
    links = S.near_links(spark.createDataFrame([(x,) for x in signed], "fp bigint"), block)
    want = union(signed, edges)
    assert union(signed, [(r.a, r.b) for r in links.collect()]) == want
    roots = {r.node: r.root for r in smallest_reachable(links).collect()}
    assert {x: roots.get(x, x) for x in signed} == want


def _hot_neighbour():
    """3 fingerprints under one 32-bit key, 400 under a key one bit away."""
    rnd = random.Random(4)
    prints = {i * 7 << 32 | 0x00050000 for i in range(3)} | {rnd.getrandbits(12) << 40 | rnd.getrandbits(8) << 32 | 0x00070000 for _ in range(400)}
    return np.array(sorted(prints), np.uint64)


def test_lookups_of_a_hot_neighbour_are_cut_into_blocks(spark):
    at = _hot_neighbour()
    prints = spark.createDataFrame([(x,) for x in at.view(np.int64).tolist()], "fp bigint")
    groups = S._dealt(prints, 16).groupBy("key", "own", "other", "probe").count()
    assert max(r["count"] for r in groups.collect()) <= 4 * 16
    signed = at.view(np.int64).tolist()
    edges = [(signed[i], signed[int(j) + i + 1]) for i in range(len(at)) for j in np.flatnonzero(np.bitwise_count(at[i + 1:] ^ at[i]) <= 3)]
    assert edges and union(signed, [(r.a, r.b) for r in S.near_links(prints, 16).collect()]) == union(signed, edges)


def test_one_group_is_compared_in_slices(monkeypatch):
    at, seen, within = _hot_neighbour().view(np.int64), [], S._within_budget
    monkeypatch.setattr(S, "BLOCK", 8)
    monkeypatch.setattr(S, "_within_budget", lambda key, x: seen.append(len(x)) or within(key, x))
    fp, probe = np.r_[at[:100], at], np.r_[np.zeros(100, np.int32), np.ones(len(at), np.int32)]
    zero = pa.array(np.zeros(len(fp), np.int64))
    batch = pa.RecordBatch.from_arrays([zero, zero, zero, pa.array(probe), pa.array(fp)], ["key", "own", "other", "probe", "fp"])
    got = [(x, y) for out in S._compare([batch]) for x, y in zip(out["a"].to_pylist(), out["b"].to_pylist(), strict=True)]
    assert sum(seen) == 100 * len(at) and max(seen) <= 4 * 8 * 8
    key = np.zeros(len(at), np.int64)
    edges = [(int(at[i]), int(at[j])) for i in range(100) for j in np.flatnonzero(within(key, (at ^ at[i]).view(np.uint64)))]
    assert union(at.tolist(), got) == union(at.tolist(), edges)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(-5, 200), (200, -9), (300, 300)]
    got = {r.node: r.root for r in smallest_reachable(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    want = union({x for e in edges for x in e} - {300}, edges[:-1])
    assert got == want


@pytest.mark.parametrize("piece, slice_", [(1, 1), (7, 3), (50, 100), (1 << 19, 1 << 17)])
def test_pieces_and_slices_change_nothing(monkeypatch, piece, slice_):
    monkeypatch.setattr(S, "PIECE", piece)
    monkeypatch.setattr(S, "SLICE", slice_)
    rnd = random.Random(piece)
    words = lambda n: "".join(rnd.choice(["x", "Yy", "é", "long" * 5]) + rnd.choice(["", " ", "\t", "\x0b"]) for _ in range(n))
    texts = [None, "", " \n", "one", "Two words", "a b c", "a b c d"] + [words(rnd.randrange(300)) for _ in range(60)]
    assert S.fingerprint_batch(texts).tolist() == [fingerprint(t) for t in texts]
    assert S.fingerprint_batch(texts, 1).tolist() == [fingerprint(t, 1) for t in texts]

"""The hash tree against a plain one, with small superblocks so that trees of
a few dozen leaves have several layers."""

import random
import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from brute import DOCS, clash
from tidewater.llm import merkle

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return sha256(text.encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def tree(nodes):
    """The root, and of each node the runs above it as (place, run)."""
    runs, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, k in enumerate(at):
            start = k // 8 * 8
            runs[i].append((k - start, nodes[start:start + 8]))
        nodes = [sha("".join(nodes[i:i + 8])) for i in range(0, len(nodes), 8)]
        at = [k // 8 for k in at]
    return nodes[0], runs


def plain(rows):
    langs = {}
    for row in rows:
        langs.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, leaf(*row), row))
    keys = sorted(langs, key=lambda k: (k is not None, (k or "").encode()))
    subtrees = {k: tree([m[2] for m in sorted(langs[k], key=lambda m: m[:3])]) for k in keys}
    root, above = tree([subtrees[k][0] for k in keys])
    out = []
    for k, over in zip(keys, above):
        for (_, _, h, row), under in zip(sorted(langs[k], key=lambda m: m[:3]), subtrees[k][1]):
            doc_id, text = row[0], row[1]
            hit = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0
            node = leaf(doc_id, text.translate(LOWER), *row[2:]) if hit and text is not None else h
            proof = ""
            for place, run in under + over:
                proof += "".join(run[:place] + run[place + 1:])
                node = sha("".join(run[:place] + [node] + run[place + 1:]))
            out.append((doc_id, h, subtrees[k][0], root, sha(proof), node, node == root))
    return out


def compare(spark, rows):
    docs = spark.createDataFrame(rows, DOCS)
    got = merkle.manifest(docs).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(plain(rows), key=repr)
    return got


def random_rows(rnd, n, langs):
    return [(i, rnd.choice(["Some Text", "no capitals", "", None, "Ünïcode ÄÖ", "x" * 3000]), rnd.choice(langs), rnd.choice(["a", None, ""]), rnd.choice([1, None]))
            for i in rnd.sample(range(10 * n), n)]


@pytest.mark.parametrize("n, langs", [(1, ["en"]), (9, ["en"]), (300, ["en"]), (200, [None, "", "en", "de", "é"]), (70, [f"l{i}" for i in range(40)])])
def test_tree_matches_plain_tree(spark, monkeypatch, n, langs):
    monkeypatch.setattr(merkle, "DEPTH", 1)
    monkeypatch.setattr(merkle, "SPAN", 8)
    got = compare(spark, random_rows(random.Random(n), n, langs))
    assert any(r.verified for r in got) or n == 1


def test_production_superblocks(spark):
    rows = random_rows(random.Random(5), 600, ["en", "en", "en", "de", None])
    got = compare(spark, rows)
    assert 0 < sum(r.verified for r in got) < len(got)


def test_tampering_is_found_and_nothing_else(spark):
    rows = [(i, f"Title {i}" if i % 2 else f"title {i}", "en", "s", 7) for i in range(60)]
    for r in compare(spark, rows):
        hit = zlib.crc32(str(r.doc_id).encode()) % 3 == 0
        assert r.verified == (not (hit and r.doc_id % 2))


def test_repeated_rows_null_ids_and_clashing_columns(spark):
    rows = [(1, "A", "en", "s", 1)] * 5 + [(1, "B", "en", "s", 1)] * 3 + [(None, "A", "en", "s", 1)] * 2 + [(None, None, None, None, None)]
    got = compare(spark, rows)
    docs = clash(spark.createDataFrame(rows, DOCS), "tree", "node", "idx", "n", "leaf", "slice", "path")
    again = merkle.manifest(docs).select(*got[0].__fields__).collect()
    assert sorted(map(tuple, again), key=repr) == sorted(map(tuple, got), key=repr)


def test_order_of_the_input_does_not_matter(spark):
    docs = spark.createDataFrame(random_rows(random.Random(8), 120, ["en", "de"]), DOCS)
    one, other = (sorted(map(tuple, merkle.manifest(d).collect()), key=repr) for d in (docs, docs.orderBy(F.rand(3)).repartition(5)))
    assert one == other


def test_empty_table(spark):
    assert merkle.manifest(spark.createDataFrame([], DOCS)).count() == 0

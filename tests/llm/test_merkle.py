"""Merkle trees, versions and proofs against plain Python."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from monthtide.llm import merkle, queries


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def levels(nodes):
    found = [list(nodes)]
    while len(found[-1]) > 1:
        found.append([digest("".join(found[-1][i : i + 8])) for i in range(0, len(found[-1]), 8)])
    return found


def way(tree, at):
    path = []
    for below in tree[:-1]:
        start = at - at % 8
        path.append((below[start:at], below[at + 1 : start + 8]))
        at //= 8
    return path


def plain(rows):
    """(group, id, leaf, changed) rows to (group, id, leaf, subroot, root, proof, folded root)."""
    groups = {}
    for row in sorted(rows, key=lambda r: (r[1] is None, r[1] or 0, r[2])):
        groups.setdefault(row[0], []).append(row)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: levels([r[2] for r in groups[g]]) for g in names}
    top, found = levels([trees[g][-1][0] for g in names]), []
    for k, g in enumerate(names):
        for at, (_, key, leaf, changed) in enumerate(groups[g]):
            path, folded = way(trees[g], at) + way(top, k), changed or leaf
            for before, after in path:
                folded = digest("".join([*before, folded, *after]))
            found.append((g, key, leaf, trees[g][-1][0], top[-1][0], "".join(d for b, a in path for d in b + a), folded))
    return sorted(found, key=str)


def got(spark, rows):
    found = merkle.manifest(spark.createDataFrame(rows, "group string, id long, leaf string, changed string, at int, size string"))
    return sorted(((r.group, r.id, r.leaf, r.subroot, r.root, "".join(r.proof), r.folded_root) for r in found.collect()), key=str)


def test_versions_share_all_nodes_that_are_not_above_the_change():
    rng = random.Random(1)
    for n in (1, 2, 7, 8, 9, 64, 65, 200):
        nodes = [digest(f"{n}-{k}") for k in range(n)]
        tree, at, new = merkle.Tree(nodes, merkle.height(n)), rng.randrange(n), digest("new")
        version, again = tree.changed(at, new), levels([new if k == at else d for k, d in enumerate(nodes)])
        assert tree.levels == levels(nodes) and version.top == again[-1][0]
        assert len(version.copied) == merkle.height(n) + 1
        for level, below in enumerate(again):
            assert [version.node(level, k) for k in range(len(below))] == below


@pytest.mark.parametrize("block_levels", [1, 2, 4])
def test_manifest_equals_plain_python(spark, monkeypatch, block_levels):
    """Blocks of 8, 64 and 4,096 nodes, so that there are up to four storeys; groups of 0, 1, 8, 9 and many leaves, one of half of all rows."""
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", block_levels)
    monkeypatch.setattr(merkle, "BLOCK", 8**block_levels)
    rng, rows = random.Random(2), []
    for group, n in ((None, 9), ("", 1), ("a", 8), ("b", 530), ("ä", 65), *((f"g{k}", 3) for k in range(10))):
        for k in range(n):
            rows.append((group, rng.choice([k * 3, -k * 5]), digest(f"{group}/{k}"), digest(f"new {k}") if rng.random() < 0.3 else None, 1, "x"))
    assert got(spark, rows) == plain([r[:4] for r in rows])


def test_odd_rows(spark):
    rows = [("g", None, "b", "c", 0, ""), ("g", None, "a", None, 0, ""), ("g", 3, "d", "e", 0, ""), ("g", 3, "d", "e", 0, ""), ("g", 3, "c", None, 0, "")]
    assert got(spark, rows) == plain([r[:4] for r in rows])
    assert got(spark, [("only", 1, "leaf", "other", 0, "")]) == [("only", 1, "leaf", "leaf", "leaf", "", "other")]
    assert got(spark, []) == []


def test_leaves_tell_null_from_empty(spark):
    rows = spark.createDataFrame([(1, None, "é"), (1, "", "-"), (None, "-", None)], "a long, b string, c string")
    found = [r.h for r in rows.select(merkle.leaf([F.col("a"), F.col("b"), F.col("c")]).alias("h")).collect()]
    assert found == [digest("1:1-2:é"), digest("1:10:1:-"), digest("-1:--")]


def test_query_equals_plain_python(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()

    def leaf(d, text):
        told = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (d.doc_id, d.source, d.lang, d.n_chars, text)]
        return digest("".join(told))

    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    rows = [(d.lang, d.doc_id, leaf(d, d.text), leaf(d, d.text.translate(lower)) if zlib.crc32(str(d.doc_id).encode()) % 3 == 0 else None) for d in docs]
    wanted = sorted((key, leaf, subroot, root, digest(proof), folded, folded == root) for _, key, leaf, subroot, root, proof, folded in plain(rows))
    assert sorted(map(tuple, queries.op12_merkle(spark, "/root/testdata/sf0.001").collect())) == wanted
    assert {r[-1] for r in wanted} == {True, False}

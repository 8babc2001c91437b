"""Merkle manifest against plain recursion over lists."""

import hashlib

from messy import empty, messy
from pyspark.sql import functions as F

from ratingloom.llm.merkle import FAN, FIELDS, address, layers, lay_out, levels_of, manifest, siblings, tree_size


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    values = [row.doc_id, row.source, row.lang, row.n_chars, text]
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(nodes):
    """Root and, for each leaf, the lists of siblings left and right of its path."""
    paths = [[] for _ in nodes]
    at, places = list(nodes), list(range(len(nodes)))
    while len(at) > 1:
        for i, p in enumerate(places):
            run = at[p - p % FAN : p - p % FAN + FAN]
            paths[i].append((run[: p % FAN], run[p % FAN + 1 :]))
        at = [sha("".join(at[i : i + FAN])) for i in range(0, len(at), FAN)]
        places = [p // FAN for p in places]
    return at[0], paths


def brute(rows, tampered):
    order = lambda r: (r.doc_id is not None, r.doc_id or 0, leaf(r, r.text))
    by_source = {}
    for r in sorted(rows, key=order):
        by_source.setdefault(r.source, []).append(r)
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: climb([leaf(r, r.text) for r in by_source[s]]) for s in names}
    root, above = climb([trees[s][0] for s in names])
    out = []
    for s, high in zip(names, above):
        for r, low in zip(by_source[s], trees[s][1]):
            node = leaf(r, r.text if tampered(r) is None else tampered(r))
            for left, right in low + high:
                node = sha("".join(left) + node + "".join(right))
            proof = sha("".join("".join(left + right) for left, right in low + high))
            out.append((str(r.doc_id), leaf(r, r.text), trees[s][0], root, proof, node, node == root))
    return sorted(out)


def rows_of(result):
    return sorted((str(r.doc_id), *list(r)[1:]) for r in result.collect())


def test_addresses_fill_the_layout():
    for levels in range(1, 6):
        places = [address(levels, k, i) for k in range(levels) for i in range(FAN ** (levels - 1 - k))]
        assert sorted(places) == list(range(tree_size(levels)))
        assert address(levels, levels - 1, 0) == 0  # the root comes first


def test_parts_are_contiguous():
    levels = 5
    low, high = layers(levels)
    assert (low, high) == (3, 2)
    for part in (0, 7, 255):
        root = address(levels, low - 1, part)
        inside = [
            address(levels, k, i) for k in range(low) for i in range(part << 4 * (low - 1 - k), (part + 1) << 4 * (low - 1 - k))
        ]
        assert sorted(inside) == list(range(root, root + tree_size(low)))
        assert inside[0] == root + address(low, 0, 0)


def test_siblings_by_address():
    leaves = [sha(str(i)) for i in range(200)]
    nodes = lay_out(3, leaves)
    left, right = siblings(3, nodes, 199)
    root, paths = climb(leaves)
    assert nodes[0] == root
    assert [(a, b) for a, b in zip(left, right)] == [("".join(a), "".join(b)) for a, b in paths[199]]


def test_levels(spark):
    sizes = [1, 2, 16, 17, 256, 257, 4096, 4097]
    found = spark.createDataFrame([(n,) for n in sizes], "n long").select("n", levels_of(F.col("n")).alias("l")).collect()
    assert [r.l for r in sorted(found)] == [1, 2, 2, 3, 3, 4, 4, 5]


def test_awkward_rows(spark):
    docs = messy(spark)
    changed = F.when(F.col("doc_id") % 3 == 0, F.lower("text"))
    trees, top, result = manifest(docs, changed)
    tampered = lambda r: r.text.lower() if r.doc_id is not None and r.doc_id % 3 == 0 and r.text is not None else None
    assert rows_of(result) == brute(docs.select(*FIELDS).collect(), tampered)
    assert manifest(empty(spark), changed)[2].count() == 0
    one = docs.where("doc_id = 8")
    assert rows_of(manifest(one, F.lit(None).cast("string"))[2]) == brute(one.select(*FIELDS).collect(), lambda r: None)


def test_trees_of_several_layers_and_many_sources(spark):
    docs = spark.range(6500).select(
        F.col("id").alias("doc_id"),
        F.concat(F.lit("Text "), F.col("id")).alias("text"),
        F.lit(None).cast("string").alias("lang"),
        # a source with 5,000 rows, one with 400, and 1,100 of one row each
        F.when(F.col("id") < 5000, "big").when(F.col("id") < 5400, None).otherwise(F.concat(F.lit("s"), F.col("id"))).alias("source"),
        F.lit(7).cast("long").alias("n_chars"),
    )
    trees, top, result = manifest(docs, F.when(F.col("doc_id") % 100 == 0, F.lower("text")))
    expected = brute(docs.collect(), lambda r: r.text.lower() if r.doc_id % 100 == 0 else None)
    assert rows_of(result) == expected
    nodes = {r.address: r.digest for r in trees.nodes().where("tree = '=big'").collect()}
    by_id = {r[0]: r[1] for r in expected}
    order = sorted(range(5000))
    assert all(nodes[address(5, 0, i)] == by_id[str(d)] for i, d in enumerate(order))
    assert nodes[0] == next(r[2] for r in expected if r[0] == "0")
    assert len(nodes) == 5000 + 313 + 20 + 2 + 1

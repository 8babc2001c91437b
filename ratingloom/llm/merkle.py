"""Manifest of a dataset as Merkle trees in van Emde Boas layout.

A tree of FAN children per node is split at half its height, again and again, until its parts have at most
BLOCK_LEVELS levels: an upper part, stored first, and aligned subtrees below it, one after the other. The place of a
node follows from the height of the tree, its level and its index alone (`address`), whatever the block size of the
store is.

Such an aligned part is one row of a table here. Construction takes one shuffle per layer of parts: it puts the
leaves, or the roots of the parts below, into the parts they belong to, and goes on over the roots. Proofs go the
other way: each part hands the siblings on the path from its root down to the parts below it. No task ever holds more
than one part at a time, and every layer has at least 16 times fewer rows than the one below.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingloom.llm.native import lower_ascii
from ratingloom.llm.registry import load, prepare, query
from ratingloom.operators.running import running_totals
from ratingloom.session import durable

FAN = 16
BITS = 4  # of an index that say which child
BLOCK_LEVELS = 3
MOST_LEVELS = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def tree_size(levels: int) -> int:
    """Nodes of a full tree of that many levels."""
    return (FAN**levels - 1) // (FAN - 1)


def address(levels: int, level: int, index: int) -> int:
    """Place of node `index` of `level`, leaves being 0, in the layout of a tree of `levels` levels."""
    place = 0
    while levels > 1:
        low = (levels + 1) // 2
        if level >= low:
            levels, level = levels - low, level - low
            continue
        shift = BITS * (low - 1 - level)
        subtree = index >> shift
        place += tree_size(levels - low) + subtree * tree_size(low)
        index -= subtree << shift
        levels = low
    return place


def layers(levels: int) -> list[int]:
    """Levels of the parts that such a tree is split into, lowest layer first."""
    if levels <= BLOCK_LEVELS:
        return [levels]
    low = (levels + 1) // 2
    return layers(low) + layers(levels - low)


def levels_of(size: Column) -> Column:
    """Levels of a tree over that many leaves: the hexadecimal digits of the greatest index, and one."""
    return F.when(size <= 1, F.lit(1)).otherwise(1 + F.length(F.hex(size - 1))).cast("int")


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def parents(nodes: list[str]) -> list[str]:
    """Digest of every run of FAN consecutive nodes; the last one may be shorter."""
    return [digest("".join(nodes[i : i + FAN])) for i in range(0, len(nodes), FAN)]


def lay_out(levels: int, bottom: list[str]) -> list[str | None]:
    """The nodes of a part above `bottom`, in the order of the layout; None where the tree has no node."""
    placed, level = {}, 0
    while True:
        placed.update((address(levels, level, i), node) for i, node in enumerate(bottom))
        if level == levels - 1:
            break
        level, bottom = level + 1, parents(bottom)
    return [placed.get(i) for i in range(max(placed) + 1)]


def siblings(levels: int, nodes: list[str | None], index: int) -> tuple[list[str], list[str]]:
    """Digests left and right of the path from bottom node `index` of a part up to its root, one text per level."""
    left, right = [], []
    for level in range(levels - 1):
        first = index - index % FAN
        places = [address(levels, level, i) for i in range(first, first + FAN)]
        run = [nodes[p] if p < len(nodes) else None for p in places]
        left.append("".join(run[: index - first]))
        right.append("".join(n for n in run[index - first + 1 :] if n))
        index >>= BITS
    return left, right


def fold(node: str, left: list[str], right: list[str]) -> str:
    """Root that a node and the siblings on its path lead to."""
    for before, after in zip(left, right):
        node = digest(before + node + after)
    return node


def one_by_one(batch: pa.RecordBatch) -> Iterator[dict]:
    """Rows of a batch as Python objects, one part at a time."""
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


def per_levels(column: Column, values: dict[int, int]) -> Column:
    """A number looked up by the levels of a tree; null where it has none."""
    return F.element_at(F.create_map(*[F.lit(x) for pair in values.items() for x in pair]), column)


def layer_levels(layer: int) -> dict[int, int]:
    """For trees of each height that have this layer, the levels of its parts."""
    return {n: layers(n)[layer] for n in range(1, MOST_LEVELS + 1) if len(layers(n)) > layer}


@dataclass
class Trees:
    """One tree per value of `tree`. `parts` holds a table for each layer: tree, levels, block, first (address of the
    part), below (what it was made of: idx, digest and payload), nodes (digests in layout order)."""

    parts: list[DataFrame]

    def roots(self) -> DataFrame:
        """(tree, digest)."""
        return _union([self._tops(layer).select("tree", F.col("nodes")[0].alias("digest")) for layer in range(len(self.parts))])

    def _tops(self, layer: int) -> DataFrame:
        last = {n: len(layers(n)) - 1 for n in range(1, MOST_LEVELS + 1)}
        return self.parts[layer].where(per_levels(F.col("levels"), last) == layer)

    def nodes(self) -> DataFrame:
        """(tree, address, digest): the stored manifest, one row per node."""
        tables = [
            part.select("tree", "first", F.posexplode("nodes").alias("at", "digest")).select(
                "tree", (F.col("first") + F.col("at")).alias("address"), "digest"
            )
            for part in self.parts
        ]
        return _union(tables).where("digest IS NOT NULL")


def _union(tables: list[DataFrame]) -> DataFrame:
    whole = tables[0]
    for table in tables[1:]:
        whole = whole.unionByName(table)
    return whole


def build(leaves: DataFrame, *payload: str) -> Trees:
    """Trees over `leaves` (tree, idx, size, digest): idx counts from 0 in each tree, size is its number of leaves."""
    current = leaves.select("tree", "idx", levels_of(F.col("size")).alias("levels"), "digest", *payload)
    deepest = current.agg(F.max("levels").alias("n")).first().n or 1
    parts: list[DataFrame] = []
    for layer in range(len(layers(deepest))):
        extra = payload if layer == 0 else ()
        # leaves are the lowest level of their part; roots are the children of the lowest level of theirs
        shifts = {n: BITS * (size - (layer == 0)) for n, size in layer_levels(layer).items()}
        block = F.expr("idx").cast("long")
        block = F.call_function("shiftright", block, per_levels(F.col("levels"), shifts))
        grouped = (
            current.withColumn("block", block)
            .groupBy("tree", "levels", "block")
            .agg(F.sort_array(F.collect_list(F.struct("idx", "digest", *extra))).alias("below"))
        )
        part = durable(_laid_out(grouped, layer))
        parts.append(part)
        more = F.col("levels").isin(*(list(layer_levels(layer + 1)) or [0]))
        current = part.where(more).select("tree", F.col("block").alias("idx"), "levels", F.col("nodes")[0].alias("digest"))
    return Trees(parts)


def _laid_out(grouped: DataFrame, layer: int) -> DataFrame:
    sizes = layer_levels(layer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, nodes = [], []
            columns = [batch.column(batch.schema.names.index(c)).to_pylist() for c in ("levels", "block")]
            below = batch.column(batch.schema.names.index("below"))
            for levels, block, row in zip(*columns, below):
                bottom = [str(d) for d in row.values.field("digest")]
                own = sizes[levels]
                root = sum(layers(levels)[: layer + 1]) - 1
                first.append(address(levels, root, block))
                nodes.append(lay_out(own, bottom if layer == 0 else parents(bottom)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(first, pa.int64()), pa.array(nodes, pa.list_(pa.string()))],
                names=[*batch.schema.names, "first", "nodes"],
            )

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in grouped.schema.fields)
    return grouped.mapInArrow(run, f"{kinds}, first long, nodes array<string>")


def paths(trees: Trees, above: DataFrame) -> DataFrame:
    """(tree, levels, below, nodes, left, right, and further columns of `above`) for every part of the lowest layer.

    `above` (tree, left, right, ...) has the siblings above the root of each tree, lists of one text per level.
    """
    further = [c for c in above.columns if c not in ("tree", "left", "right")]
    carried: DataFrame | None = None
    for layer in range(len(trees.parts) - 1, -1, -1):
        here = trees._tops(layer).join(above, "tree")
        if carried is not None:
            inner = trees.parts[layer].join(carried, ["tree", "block"])
            here = here.unionByName(inner.select(*here.columns))
        if layer == 0:
            return here
        carried = durable(_handed_down(here.select("tree", "levels", "below", "nodes", "left", "right", *further), layer))


def _handed_down(parts: DataFrame, layer: int) -> DataFrame:
    """(tree, block, left, right, ...) for the parts of the layer below."""
    sizes = layer_levels(layer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in one_by_one(batch):
                own = sizes[row["levels"]]
                roots = [b["digest"] for b in row["below"]]
                first = row["below"][0]["idx"]
                out = []
                for i, root in enumerate(roots):
                    run_of = i - i % FAN
                    left, right = siblings(own, row["nodes"], i >> BITS)
                    given = {k: v for k, v in row.items() if k not in ("levels", "below", "nodes", "left", "right")}
                    out.append(
                        given
                        | {
                            "block": first + i,
                            "left": ["".join(roots[run_of:i]), *left, *row["left"]],
                            "right": ["".join(roots[i + 1 : run_of + FAN]), *right, *row["right"]],
                        }
                    )
                yield pa.RecordBatch.from_pylist(out, schema)

    kept = [f for f in parts.schema.fields if f.name not in ("levels", "below", "nodes")]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", block long"
    schema = pa.schema(
        [(f.name, pa.list_(pa.string()) if f.name in ("left", "right") else pa.string()) for f in kept] + [("block", pa.int64())]
    )
    return parts.mapInArrow(run, kinds)


def proofs(parts: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified for the leaves of the parts that `paths`
    returns; payload: doc_id, tampered (null unless the leaf is to be replaced)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in one_by_one(batch):
                levels, out = sizes[row["levels"]], []
                for i, leaf in enumerate(row["below"]):
                    left, right = siblings(levels, row["nodes"], i)
                    left, right = left + row["left"], right + row["right"]
                    folded = fold(leaf["tampered"] or leaf["digest"], left, right)
                    out.append(
                        {
                            "doc_id": leaf["doc_id"],
                            "leaf": leaf["digest"],
                            "subroot": row["subroot"],
                            "root": row["root"],
                            "proof_sha256": digest("".join(a + b for a, b in zip(left, right))),
                            "folded_root": folded,
                            "verified": folded == row["root"],
                        }
                    )
                yield pa.RecordBatch.from_pylist(out, schema)

    sizes = layer_levels(0)
    text = ("leaf", "subroot", "root", "proof_sha256", "folded_root")
    schema = pa.schema([("doc_id", pa.int64()), *[(n, pa.string()) for n in text], ("verified", pa.bool_())])
    return parts.select("levels", "below", "nodes", "left", "right", "subroot", "root").mapInArrow(
        run, "doc_id long, " + ", ".join(f"{n} string" for n in text) + ", verified boolean"
    )


def field(value: Column) -> Column:
    """One column of a leaf: `-` for null, else byte count, colon, value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(text: Column) -> Column:
    return F.sha2(F.concat(*[field(F.col(c)) for c in FIELDS if c != "text"], field(text)), 256)


def manifest(docs: DataFrame, tampered: Column) -> tuple[Trees, Trees, DataFrame]:
    """Trees per source, the tree over their roots, and (doc_id, leaf, subroot, root, proof_sha256, folded_root,
    verified) per row of `docs` (doc_id, text, lang, source, n_chars); other columns are not read.

    `tampered` is a text put in place of the own one when a proof is checked, null for none. Leaves ascend by doc_id,
    null first, rows of the same id by digest, so repeated rows are interchangeable. The null source comes first.
    Without rows there are no trees and no result.
    """
    prepare(docs.sparkSession)
    # a name that orders as the sources do, null first, and can be joined
    tree = F.when(F.col("source").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col("source").cast("string")))
    # kept, so that sorting by range does not digest all texts twice
    leaves = durable(docs.select(
        tree.alias("tree"),
        F.col("doc_id").cast("long").alias("doc_id"),
        leaf_digest(F.col("text")).alias("digest"),
        F.when(tampered.isNotNull(), leaf_digest(tampered)).alias("tampered"),
    ))
    numbered = running_totals(leaves, ["doc_id", "digest"], {"rows": F.lit(1)}, ["tree"]).select(
        "tree", F.col("before_rows").alias("idx"), F.col("all_rows").alias("size"), "digest", "doc_id", "tampered"
    )
    trees = build(numbered, "doc_id", "tampered")
    roots = trees.roots().select(F.lit("").alias("whole"), F.col("tree").alias("name"), "digest")
    ranked = running_totals(roots, ["name"], {"rows": F.lit(1)}).select(
        F.col("whole").alias("tree"), F.col("before_rows").alias("idx"), F.col("all_rows").alias("size"), "digest", "name"
    )
    top = build(ranked, "name")
    no_path = F.array().cast("array<string>")
    start = top.roots().select("tree", no_path.alias("left"), no_path.alias("right"), F.col("digest").alias("root"))
    above = durable(_leaf_paths(paths(top, start)))
    return trees, top, proofs(paths(trees, above))


def _leaf_paths(parts: DataFrame) -> DataFrame:
    """(tree, left, right, root, subroot): the path above each tree whose root is a leaf here; payload: name."""
    sizes = layer_levels(0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in one_by_one(batch):
                out = []
                for i, leaf in enumerate(row["below"]):
                    left, right = siblings(sizes[row["levels"]], row["nodes"], i)
                    out.append(
                        {
                            "tree": leaf["name"],
                            "left": left + row["left"],
                            "right": right + row["right"],
                            "root": row["root"],
                            "subroot": leaf["digest"],
                        }
                    )
                yield pa.RecordBatch.from_pylist(out, schema)

    lists = pa.list_(pa.string())
    schema = pa.schema(
        [("tree", pa.string()), ("left", lists), ("right", lists), ("root", pa.string()), ("subroot", pa.string())]
    )
    return parts.select("levels", "below", "nodes", "left", "right", "root").mapInArrow(
        run, "tree string, left array<string>, right array<string>, root string, subroot string"
    )


def _oracle(levels: int = 8) -> str:
    """The same trees level by level in SQL, for up to 16 ** levels rows."""
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

    def cell(value: str) -> str:
        return f"coalesce(strlen({value}) || ':' || {value}, '-')"

    def leaf(text: str) -> str:
        plain = " || ".join(cell(f"CAST({c} AS VARCHAR)") for c in FIELDS if c != "text")
        return f"sha256({plain} || {cell(text)})"

    crc = (
        "xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''),"
        " x -> ascii(x)::UBIGINT)), lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[],"
        " lambda u, v: xor(u >> 1, 3988292384::UBIGINT * (u & 1)))), 4294967295::UBIGINT)"
    ).replace("x -> ascii", "lambda x: ascii")
    steps = [
        f"""leaves AS (SELECT row_number() OVER (ORDER BY source NULLS FIRST, doc_id NULLS FIRST) AS row, doc_id,
            coalesce('=' || source, '') AS tree, {leaf("text")} AS leaf,
            CASE WHEN {crc} % 5 = 0 THEN {leaf(lower)} END AS tampered FROM documents)""",
        """numbered AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY row) - 1 AS idx,
            count(*) OVER (PARTITION BY tree) AS n FROM leaves)""",
    ]

    def tree(name: str, source: str) -> str:
        """Levels 0 to `levels` of the trees over (tree, idx, n, digest), then their roots."""
        steps.append(f"{name}0 AS (SELECT tree, idx, n, digest FROM {source})")
        for k in range(levels):
            steps.append(
                f"""{name}{k + 1} AS (SELECT tree, idx >> 4 AS idx, max((n + 15) >> 4) AS n,
                sha256(string_agg(digest, '' ORDER BY idx)) AS digest FROM {name}{k} WHERE n > 1 GROUP BY tree, idx >> 4)"""
            )
        tops = " UNION ALL ".join(f"SELECT tree, digest FROM {name}{k} WHERE n = 1" for k in range(levels + 1))
        steps.append(f"{name}_roots AS ({tops})")
        return f"{name}_roots"

    steps.append("low_source AS (SELECT tree, idx, n, leaf AS digest FROM numbered)")
    tree("low", "low_source")
    steps.append(
        """top_source AS (SELECT '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS idx, count(*) OVER () AS n, digest,
            tree AS name FROM low_roots)"""
    )
    tree("top", "top_source")
    steps.append(
        """walk0 AS (SELECT r.doc_id, r.leaf, r.tree, r.idx, t.idx AS top_idx, l.digest AS subroot, g.digest AS root,
            '' AS proof, coalesce(r.tampered, r.leaf) AS folded FROM numbered r JOIN low_roots l USING (tree)
            JOIN top_source t ON t.name = r.tree CROSS JOIN top_roots g)"""
    )
    at = 0
    for name, index, key in (("low", "idx", "w.tree"), ("top", "top_idx", "''")):
        for k in range(levels):
            steps.append(
                f"""{name}_runs{k} AS (SELECT tree, idx >> 4 AS run, list(digest ORDER BY idx) AS run_of FROM {name}{k}
                WHERE n > 1 GROUP BY tree, idx >> 4)"""
            )
            own = f"(({index} >> {4 * k}) & 15)"
            left, right = f"array_to_string(run_of[:{own}], '')", f"array_to_string(run_of[{own} + 2:], '')"
            steps.append(
                f"""walk{at + 1} AS (SELECT w.* REPLACE (proof || coalesce({left} || {right}, '') AS proof,
                CASE WHEN run_of IS NULL THEN folded ELSE sha256({left} || folded || {right}) END AS folded)
                FROM walk{at} w LEFT JOIN {name}_runs{k} u ON u.tree = {key} AND u.run = {index} >> {4 * k + 4})"""
            )
            at += 1
    return f"""WITH {", ".join(steps)}
        SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
        FROM walk{at}"""


@query("op12_merkle_manifest", _oracle(5))
def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Proof of every document, checked with the text of every fifth one changed."""
    docs = load(spark, folder, "documents", *FIELDS)
    fifth = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return manifest(docs, F.when(fifth, lower_ascii(F.col("text"))))[2]

"""Merkle manifest of a dataset in van Emde Boas layout.

Every document is a leaf, the leaves of a source (ascending by id) form a
ternary hash tree, and the roots of the sources (null first) form another one,
whose root stands for the dataset.

A tree is cut into aligned blocks of ``HEIGHT`` levels above their leaves. A
block is one array of digests in van Emde Boas order: its upper half of levels
first, then each subtree below it, both halves laid out the same way again. So
any path of the tree touches few memory pages whatever their size. ``places``
has the addresses by that rule; ``lay`` builds a block by the same recursion
(lower subtrees first, their roots are what the upper half stands on); a proof
reads the siblings' addresses. The roots of the blocks are the leaves of the
next round, so a tree of any size takes log(leaves) / (HEIGHT log 3) rounds.

Dealing out: leaves are hashed by Spark's own functions and written once
without the text; positions come from a range shuffle over (source, id), so
one source may hold any share of the rows; a task holds one block (2,187
leaves at most). Proofs go the other way: a block takes the siblings above its
root from the block above and hands them to its children.

Cases: a null field is ``-``; null ids come first and are never tampered with;
rows with equal ids are ordered by their leaf; repeated rows are leaves of
their own. A source with one document has that leaf as its root, a manifest of
one source has that source's root. An empty table gives no rows and no root.
Other columns are not read.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import arrow_groups, arrow_rows, numbered, table, written

ARITY = 3
#: Levels of a block above its leaves: 3**7 leaves, 3,280 digests, 105 KB.
HEIGHT = 7
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "path array<struct<place:int,others:binary>>"


# --- layout ------------------------------------------------------------------

def nodes(levels: int) -> int:
    """Nodes of a full tree with so many levels."""
    return (ARITY ** levels - 1) // (ARITY - 1)


def levels_for(leaves: int) -> int:
    """Levels of the least tree over so many leaves."""
    levels = 1
    while ARITY ** (levels - 1) < leaves:
        levels += 1
    return levels


@functools.lru_cache(maxsize=None)
def places(levels: int) -> tuple[np.ndarray, ...]:
    """Per depth, the addresses of its nodes from left to right."""
    if levels == 1:
        return (np.zeros(1, np.int64),)
    top = levels // 2
    below = levels - top
    starts = nodes(top) + nodes(below) * np.arange(ARITY ** top, dtype=np.int64)
    return places(top) + tuple((starts[:, None] + own[None, :]).ravel() for own in places(below))


def digest_of(parts: list[bytes]) -> bytes:
    """The digest of digests, concatenated as hex text."""
    return sha256(b"".join(parts).hex().encode()).digest()


def lay(out: bytearray, at: int, levels: int, leaves: list[bytes]) -> bytes:
    """Write the tree over ``leaves`` (one at least) from address ``at`` on; returns its root."""
    if levels == 1:
        out[32 * at:32 * at + 32] = leaves[0]
        return leaves[0]
    top = levels // 2
    below = levels - top
    width = ARITY ** (below - 1)
    first, step = at + nodes(top), nodes(below)
    roots = [lay(out, first + k * step, below, leaves[at_:at_ + width])
             for k, at_ in enumerate(range(0, len(leaves), width))]
    return lay(out, at, top, [digest_of(roots[k:k + ARITY]) for k in range(0, len(roots), ARITY)])


def paths(block: bytes, levels: int, leaves: int) -> list[list[tuple[int, bytes]]]:
    """For every leaf of a block (place in its run, the run's other digests), from the leaf's level up."""
    at = places(levels)
    above: list[list[tuple[int, bytes]]] = [[]]
    for depth in range(1, levels):
        width = ARITY ** (levels - 1 - depth)
        count = -(-leaves // width)
        own = [block[32 * a:32 * a + 32] for a in at[depth][:count].tolist()]
        now = []
        for k in range(count):
            first = k - k % ARITY
            others = b"".join(own[j] for j in range(first, min(first + ARITY, count)) if j != k)
            now.append([(k - first, others), *above[k // ARITY]])
        above = now
    return above


def folded(digest: bytes, path: list[tuple[int, bytes]]) -> bytes:
    """The root that a digest and its path give."""
    for place, others in path:
        digest = sha256((others[:32 * place] + digest + others[32 * place:]).hex().encode()).digest()
    return digest


# --- manifest ----------------------------------------------------------------

@dataclass
class Manifest:
    """The blocks of all rounds, lowest first; the root is None for an empty table.

    ``sources`` are the trees over documents (tree: the source), ``top`` the
    tree over sources. A block row: tree, block (its place in the round),
    n (nodes of the round in its tree), levels, nodes (the digests in layout
    order), root; in the lowest round ``ids`` and ``copies`` beside them, in
    the lowest round of ``top`` the sources in ``names``.
    """

    sources: list[DataFrame]
    top: list[DataFrame]
    root: str | None


def leaf(source: dict[str, Column]) -> Column:
    """The leaf of a document as hex: sha256 over its fields with their lengths."""
    def field(c: Column) -> Column:
        text = c.cast("string")
        return F.when(c.isNull(), F.lit("-")).otherwise(
            F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))

    return F.sha2(F.concat(*[field(source[name]) for name in FIELDS]).cast("binary"), 256)


def leaves(docs: DataFrame, copy: Column | None = None) -> DataFrame:
    """(doc_id, source, leaf, copy): the leaf of every document and, with ``copy`` (the text
    as another copy of the dataset holds it), the leaf of that copy, as bytes."""
    own = {name: F.col(name) for name in FIELDS}
    hashed = leaf(own)
    other = hashed if copy is None else F.when(
        copy.eqNullSafe(F.col("text")), hashed).otherwise(leaf(own | {"text": copy}))
    return docs.select("doc_id", F.col("source").cast("string").alias("source"),
                       F.unhex(hashed).alias("leaf"), F.unhex(other).alias("copy"))


def _round(rows: DataFrame, extras: dict[str, str], height: int) -> DataFrame:
    """Blocks of (tree, pos, n, digest, *extras); each extra column becomes a list of the block's leaves."""
    width = ARITY ** height
    kinds = dict(rows.dtypes)

    def build(key: tuple, own: pa.Table) -> dict:
        digests, n = own["digest"].to_pylist(), own["n"][0].as_py()
        levels = levels_for(n) if n <= width else height + 1
        out = bytearray(32 * nodes(levels))
        root = lay(out, 0, levels, digests)
        found = {"tree": [key[0]], "block": [key[1]], "n": [n], "levels": [levels], "leaves": [len(digests)],
                 "nodes": [bytes(out)], "root": [root]}
        return found | {many: [own[one].to_pylist()] for one, many in extras.items()}

    schema = (f"tree {kinds['tree']}, block long, n long, levels int, leaves int, nodes binary, root binary"
              + "".join(f", {many} array<{kinds[one]}>" for one, many in extras.items()))
    keyed = rows.withColumn("block", F.floor(F.col("pos") / width).cast("long"))
    return written(arrow_groups(keyed, ["tree", "block"], ["pos"], build, schema), "blocks")


def trees(rows: DataFrame, extras: dict[str, str], height: int = HEIGHT) -> list[DataFrame]:
    """The blocks of all rounds over (tree, pos, n, digest, *extras), lowest round first."""
    width = ARITY ** height
    rounds = [_round(rows, extras, height)]
    most = rounds[0].agg(F.max("n")).first()[0] or 0
    while most > width:
        most = -(-most // width)
        upper = rounds[-1].where(F.col("n") > width).select(
            "tree", F.col("block").alias("pos"), F.ceil(F.col("n") / width).cast("long").alias("n"),
            F.col("root").alias("digest"))
        rounds.append(_round(upper, {}, height))
    return rounds


def roots(rounds: list[DataFrame], height: int = HEIGHT) -> DataFrame:
    """(tree, digest): the root of every tree, from the round where one block was left."""
    last = [r.where(F.col("n") <= ARITY ** height).select("tree", F.col("root").alias("digest")) for r in rounds]
    return functools.reduce(DataFrame.unionByName, last)


def build(found: DataFrame, height: int = HEIGHT) -> Manifest:
    """The manifest of ``leaves``."""
    held = written(found.withColumn("row", F.monotonically_increasing_id()), "leaves")
    placed = numbered(held, "source", ["doc_id", "leaf", "row"], "manifest")
    rows = placed.select(F.col("source").alias("tree"), "pos", "n", F.col("leaf").alias("digest"), "doc_id", "copy")
    sources = trees(rows, {"doc_id": "ids", "copy": "copies"}, height)
    over = numbered(roots(sources, height).select(F.lit("all").alias("all"), "tree", "digest"), "all", ["tree"], "top")
    top = trees(over.select(F.col("all").alias("tree"), "pos", "n", "digest", F.col("tree").alias("name")),
                {"name": "names"}, height)
    last = roots(top, height).first()
    return Manifest(sources, top, bytes(last["digest"]).hex() if last else None)


# --- proofs ------------------------------------------------------------------

def _handed_down(blocks: DataFrame, above: DataFrame, also: dict[str, str]) -> DataFrame:
    """(tree, block, path, *also): the path of every leaf of ``blocks``, given the paths of the blocks.

    The leaf's position in its tree is the ``block`` of the round below;
    ``also`` names list columns to hand out leaf by leaf.
    """
    kinds = dict(blocks.dtypes)
    joined = blocks.join(above.select(F.col("tree").alias("__tree"), F.col("block").alias("__block"), "path"),
                         F.col("tree").eqNullSafe(F.col("__tree")) & (F.col("block") == F.col("__block")))

    def split(row: dict) -> dict:
        found = paths(row["nodes"], row["levels"], row["leaves"])
        first = row["block"] * ARITY ** (row["levels"] - 1)
        return {"tree": [row["tree"]] * len(found), "block": list(range(first, first + len(found))),
                "path": [[{"place": p, "others": o} for p, o in own] + row["path"] for own in found]
                } | {one: row[many] for many, one in also.items()}

    handed = "".join(f", {one} {kinds[many][6:-1]}" for many, one in also.items())
    return arrow_rows(joined.select("tree", "block", "levels", "leaves", "nodes", "path", *also),
                      split, f"tree {kinds['tree']}, block long, {PATH}{handed}")


def _outer(rounds: list[DataFrame], ends: DataFrame, height: int) -> DataFrame:
    """(tree, block, path) for every block of the lowest round; ``ends`` has (tree, path) of whole trees."""
    nothing = ends.select("tree", F.lit(0).cast("long").alias("block"), "path")
    above = None
    for r in reversed(rounds):
        last = r.where(F.col("n") <= ARITY ** height).select(F.col("tree").alias("__of"))
        own = nothing.join(last, F.col("tree").eqNullSafe(F.col("__of"))).select("tree", "block", "path")
        own = own if above is None else own.unionByName(above)
        if r is rounds[0]:
            return own
        above = written(_handed_down(r, own, {}), "paths")
    raise ValueError("a manifest has one round at least")


def verified(manifest: Manifest, height: int = HEIGHT) -> DataFrame:
    """Per document its proof, and the root that its copy gives with that proof.

    doc_id, leaf, subroot, root, proof (the siblings' digests as hex, bottom
    up, joined), folded_root and verified (whether that is the root).
    """
    root = manifest.root
    start = roots(manifest.top, height).select("tree", F.array().cast(PATH.split(" ", 1)[1]).alias("path"))
    top = manifest.top[0]
    by_source = _handed_down(top, _outer(manifest.top, start, height), {"names": "name"})
    ends = written(by_source.select(F.col("name").alias("tree"), "path"), "ends")
    outer = _outer(manifest.sources, ends, height).alias("o")
    final = roots(manifest.sources, height).select(F.col("tree").alias("__of"), F.col("digest").alias("subroot"))
    lowest = manifest.sources[0].alias("b")
    joined = lowest.join(outer, F.col("b.tree").eqNullSafe(F.col("o.tree")) & (F.col("b.block") == F.col("o.block")))
    joined = joined.join(final, F.col("b.tree").eqNullSafe(F.col("__of"))).select(
        "ids", "copies", "levels", "leaves", "nodes", "path", "subroot")
    kind = dict(lowest.dtypes)["ids"][6:-1]

    def check(row: dict) -> dict:
        outer = [(p["place"], p["others"]) for p in row["path"]]
        above = b"".join(others for _, others in outer)
        block, found = row["nodes"], paths(row["nodes"], row["levels"], row["leaves"])
        return {
            "doc_id": row["ids"],
            "leaf": [block[32 * a:32 * a + 32].hex() for a in places(row["levels"])[-1][:len(found)].tolist()],
            "subroot": [row["subroot"].hex()] * len(found),
            "proof": [(b"".join(others for _, others in own) + above).hex() for own in found],
            "folded_root": [folded(copy, own + outer).hex() for copy, own in zip(row["copies"], found)]}

    found = arrow_rows(joined, check, f"doc_id {kind}, leaf string, subroot string, proof string, folded_root string")
    return found.withColumns({"root": F.lit(root).cast("string"),
                              "verified": F.coalesce(F.col("folded_root") == F.lit(root), F.lit(False))})


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: the manifest of ``documents``, and a copy whose even-crc32 ids lost their line ends."""
    docs = table(spark, sf_dir, "documents", *FIELDS)
    even = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(2)) == 0, F.lit(False))
    copy = F.when(even, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    found = verified(build(leaves(docs, copy)))
    return found.select("doc_id", "leaf", "subroot", "root", F.sha2(F.col("proof").cast("binary"), 256).alias("proof_sha256"),
                        "folded_root", "verified")


#: crc32 of an id's decimal text in DuckDB, bit by bit (fixed value: the reflected polynomial 0xEDB88320).
_CRC_ODD = """list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
    lambda c: CAST(ascii(c) AS UBIGINT))), lambda crc, byte: list_reduce(list_prepend(xor(crc, byte),
    [0::UBIGINT, 0::UBIGINT, 0::UBIGINT, 0::UBIGINT, 0::UBIGINT, 0::UBIGINT, 0::UBIGINT, 0::UBIGINT]),
    lambda x, _: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::UBIGINT) ELSE x // 2 END))"""


def _sql_field(c: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR) END"


_SQL_LEAF = " || ".join(_sql_field(c) for c in FIELDS)
_SQL_COPY = " || ".join(_sql_field(c if c != "text" else "other") for c in FIELDS)

#: DuckDB SQL for the query: the trees level by level, then every path from its leaf up.
OP11_SQL = f"""
WITH RECURSIVE copies AS (
  SELECT *, CASE WHEN doc_id IS NOT NULL AND xor({_CRC_ODD}, 1::UBIGINT) % 2 = 0
                 THEN replace(text, chr(10), '') ELSE text END AS other FROM documents
), hashed AS (
  SELECT doc_id, source, sha256({_SQL_LEAF}) AS leaf, sha256({_SQL_COPY}) AS copy FROM copies
), leaves AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree FROM hashed
), lower AS (
  SELECT tree, 0 AS level, pos, leaf AS h, count(*) OVER (PARTITION BY tree) AS n FROM leaves
  UNION ALL
  SELECT tree, level + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + 2) // 3
  FROM lower WHERE n > 1 GROUP BY tree, level, pos // 3
), subroots AS (
  SELECT tree, h AS subroot FROM lower WHERE n = 1
), upper AS (
  SELECT 0 AS level, tree AS pos, subroot AS h, count(*) OVER () AS n FROM subroots
  UNION ALL
  SELECT level + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + 2) // 3
  FROM upper WHERE n > 1 GROUP BY level, pos // 3
), low_runs AS (
  SELECT tree, level, pos // 3 AS run, list(h ORDER BY pos) AS hs FROM lower WHERE n > 1 GROUP BY tree, level, pos // 3
), high_runs AS (
  SELECT level, pos // 3 AS run, list(h ORDER BY pos) AS hs FROM upper WHERE n > 1 GROUP BY level, pos // 3
), up AS (
  SELECT doc_id, leaf, copy, tree, pos AS start, 0 AS level, pos, copy AS x, '' AS proof FROM leaves
  UNION ALL
  SELECT doc_id, leaf, copy, u.tree, start, u.level + 1, pos // 3,
    sha256(array_to_string(list_concat(hs[:pos % 3], [x], hs[pos % 3 + 2:]), '')),
    proof || array_to_string(list_concat(hs[:pos % 3], hs[pos % 3 + 2:]), '')
  FROM up u JOIN low_runs r ON u.tree = r.tree AND u.level = r.level AND u.pos // 3 = r.run
), reached AS (
  SELECT doc_id, leaf, tree, start, x, proof FROM up QUALIFY row_number() OVER (PARTITION BY tree, start ORDER BY level DESC) = 1
), over AS (
  SELECT doc_id, leaf, tree, start, 0 AS level, tree AS pos, x, proof FROM reached
  UNION ALL
  SELECT doc_id, leaf, tree, start, o.level + 1, pos // 3,
    sha256(array_to_string(list_concat(hs[:pos % 3], [x], hs[pos % 3 + 2:]), '')),
    proof || array_to_string(list_concat(hs[:pos % 3], hs[pos % 3 + 2:]), '')
  FROM over o JOIN high_runs r ON o.level = r.level AND o.pos // 3 = r.run
), ended AS (
  SELECT * FROM over QUALIFY row_number() OVER (PARTITION BY tree, start ORDER BY level DESC) = 1
), root AS (SELECT h AS root FROM upper WHERE n = 1)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, x AS folded_root, x = root AS verified
FROM ended JOIN subroots USING (tree) CROSS JOIN root
"""

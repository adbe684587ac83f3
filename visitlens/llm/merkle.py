"""Merkle manifest of a dataset: a root digest, and a proof for each document.

A leaf is the digest of a document's fields, each with its length in front. The
leaves of one lang in doc_id order are paired up level by level to a subroot,
and the subroots in lang order in the same way to the root. A node is the digest
of its two children's hex texts one after the other, or of its only child's.

Each leaf gets its rank in its lang (``ranked``: a range partitioning, places in
each partition, and the counts of the partitions before). The rank's digits to
base 16 are then grouped away, the lowest first: the up to 16 nodes that differ
in that digit only become one row, a struct of the four levels between and of
the children's structs. Two digits make a block of at most 256 nodes. Blocks are
the nodes of the next table, and so on until each lang has one block; a row
never holds more than 256 nodes, however many documents a lang has. On the way
back a block row meets the path of its own top in one grouping by its key, and a
transform over the nested structs with one explode emits the rows below it. No
join makes a proof, no group is larger than a block.

Null fields are written ``-``. Documents without a lang are a lang of their own,
the first; those without a doc_id come first in their lang. Rows of one doc_id
are ordered by their digests, and equal rows are leaves each. Other columns are
not read. An empty table gives no rows. The path of a lone document of a lone
lang is empty, and its leaf is the root.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
BASE, DIGITS = 16, 2  # children of a struct, structs in each other in a block row
LEVELS = 4  # of pairs below a digit: BASE is 2 to that

PATH = "array<struct<left: boolean, sibling: string>>"


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(**other: Column) -> Column:
    """The leaf of a row, ``other`` in the place of its own fields."""
    return F.sha2(F.concat(*[_field(other.get(name, F.col(name))) for name in FIELDS]), 256)


def ranked(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` with ``at``, their places (from 0) in their ``grp`` by ``order``.

    ``order`` must tell all rows apart. The rows of a group that spans several
    range partitions are counted on by those of the partitions before."""
    in_order = saved(
        rows.repartitionByRange("grp", *order).sortWithinPartitions("grp", *order)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    part = F.shiftright("_place", 33)
    found = in_order.groupBy(part.alias("_part"), F.col("grp").alias("_grp")).agg(F.count("*").alias("_n"), F.min("_place").alias("_lo"))
    before = Window.partitionBy("_grp").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    base = found.select("_part", "_grp", (F.col("_lo") - F.coalesce(F.sum("_n").over(before), F.lit(0))).alias("_base"))
    same = (part == F.col("_part")) & F.col("grp").eqNullSafe(F.col("_grp"))
    return in_order.join(base, same).withColumn("at", F.col("_place") - F.col("_base")).drop("_place", "_part", "_grp", "_base")


def _without_digit(nodes: DataFrame, keys: list[str]) -> DataFrame:
    """One row for all nodes that differ in the lowest digit of ``at``: their
    levels and structs in ``node``, ``digest`` four levels up, and ``top``, what
    remains of them if there are no others in the group."""
    kid = F.struct((F.col("at") % BASE).alias("digit"), "digest", "top", "node")
    rows = nodes.select(*keys, F.floor(F.col("at") / BASE).alias("at"), kid.alias("kid"))
    rows = rows.groupBy(*keys, "at").agg(F.sort_array(F.collect_list("kid")).alias("kids"))
    rows = rows.withColumn("l0", F.expr("transform(kids, k -> k.digest)"))
    for k in range(LEVELS):
        pair = f"sha2(concat(l{k}[i], coalesce(get(l{k}, i + 1), '')), 256)"
        rows = rows.withColumn(f"l{k + 1}", F.expr(f"transform(sequence(0, size(l{k}) - 1, 2), i -> {pair})"))
    top = f"CASE WHEN size(l0) = 1 THEN kids[0].top {' '.join(f'WHEN size(l{k}) = 1 THEN l{k}[0]' for k in range(1, LEVELS + 1))} END"
    levels = ", ".join(f"l{k}" for k in range(LEVELS))
    node = f"named_struct('levels', array({levels}), 'kids', transform(kids, k -> k.node))"
    return rows.selectExpr(*keys, "at", f"l{LEVELS}[0] AS digest", f"{top} AS top", f"{node} AS node")


def _blocks(nodes: DataFrame) -> DataFrame:
    """The blocks of nodes (grp, at, digest, top, node), in the same columns."""
    rows = nodes.withColumn("block", F.floor(F.col("at") / BASE**DIGITS))
    rows = rows.repartition("grp", "block")  # serves all digits of a block
    for _ in range(DIGITS):
        rows = _without_digit(rows, ["grp", "block"])
    return rows.drop("block")


def _steps(levels: str, i: str, lone: str) -> str:
    """The siblings of child ``i`` up to the struct's own digest, or, where the
    struct is all there is, up to its top."""
    height = f"CASE WHEN NOT {lone} THEN {LEVELS} {' '.join(f'WHEN size({levels}[0]) <= {1 << k} THEN {k}' for k in range(LEVELS))} ELSE {LEVELS} END"
    at = f"shiftright({i}, k)"
    step = f"named_struct('left', {at} % 2 = 1, 'sibling', get({levels}[k], {at} ^ 1))"
    return f"slice(transform(sequence(0, {LEVELS - 1}), k -> {step}), 1, {height})"


def _emitted(blocks: DataFrame) -> DataFrame:
    """(grp, node, digest, up) of the nodes in blocks (grp, node, up)."""

    def below(node: str, up_path: str, lone: str, depth: int) -> str:
        i, kid, path, alone = f"i{depth}", f"kid{depth}", f"path{depth}", f"alone{depth}"
        here = f"concat({_steps(f'{node}.levels', i, lone)}, {up_path})"
        only = f"({lone} AND size({node}.kids) = 1)"
        if depth == 1:
            made = f"array(named_struct('node', {kid}, 'digest', {node}.levels[0][{i}], 'path', {here}, 'lone', {only}))"
        else:  # bound to names, so that each is worked out once
            inner = below(kid, f"{path}.path", f"{path}.{alone}", depth - 1)
            made = f"flatten(transform(array(named_struct('path', {here}, '{alone}', {only})), {path} -> {inner}))"
        return f"flatten(transform({node}.kids, ({kid}, {i}) -> {made}))"

    kids = blocks.selectExpr("grp", "up", f"explode({below('node', 'up.path', 'up.lone', DIGITS)}) AS kid")
    up = "named_struct('path', kid.path, 'lone', kid.lone, 'subroot', up.subroot, 'root', up.root) AS up"
    return kids.selectExpr("grp", "kid.node", "kid.digest", up)


def _proved(nodes: DataFrame, finish: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(grp, node, digest, up) of nodes (grp, at, digest, top, node); ``finish``
    gives (grp, up) for the groups' tops (grp, top)."""
    blocks = saved(_blocks(nodes))
    if blocks.agg(F.max("at")).first()[0]:
        above = blocks.select("grp", "at", "digest", "top", F.struct("at").alias("node"))
        above = _proved(above, finish).selectExpr("grp", "node.at", "up")
    else:
        above = finish(blocks.select("grp", "top")).selectExpr("grp", "0L AS at", "up")
    rows = blocks.select("grp", "at", "node").unionByName(above, allowMissingColumns=True)
    met = rows.groupBy("grp", "at").agg(F.first("node", True).alias("node"), F.first("up", True).alias("up"))
    return _emitted(met)


def _up(subroot: str, root: str, path: str = f"CAST(array() AS {PATH})") -> str:
    return f"named_struct('path', {path}, 'lone', true, 'subroot', {subroot}, 'root', {root}) AS up"


def proofs(docs: DataFrame, **altered: Column) -> DataFrame:
    """doc_id, lang, leaf, checked, path, subroot, root of each document.

    ``path`` holds, from the leaf's level to the one below the root, whether the
    sibling stands on the left, and its digest (null: the node has none).
    ``checked`` is the leaf of the row with ``altered`` fields: what a later
    reader of a changed copy would find."""
    found = docs.select(
        F.col("lang").cast("string").alias("grp"), F.col("doc_id").cast("long").alias("doc_id"), leaf_digest().alias("leaf"),
        (leaf_digest(**altered) if altered else F.lit(None).cast("string")).alias("checked"),
        F.monotonically_increasing_id().alias("row"),
    )
    found = saved(found.withColumn("checked", F.expr("nullif(checked, leaf)")))
    nodes = ranked(found, "doc_id", "leaf", "row").selectExpr(
        "grp", "at", "leaf AS digest", "leaf AS top", "named_struct('doc_id', doc_id, 'checked', checked) AS node"
    )

    def over_langs(subroots: DataFrame) -> DataFrame:
        langs = ranked(subroots.selectExpr("0 AS grp", "grp AS lang", "top"), "lang")
        langs = langs.selectExpr("grp", "at", "top AS digest", "top", "named_struct('lang', lang) AS node")
        proved = _proved(langs, lambda tops: tops.selectExpr("grp", _up("top", "top")))
        return proved.selectExpr("node.lang AS grp", _up("digest", "up.root", "up.path"))

    rows = _proved(nodes, over_langs)
    return rows.selectExpr(
        "node.doc_id", "grp AS lang", "digest AS leaf", "coalesce(node.checked, digest) AS checked", "up.path", "up.subroot", "up.root"
    )


def folded(leaf: str, path: str) -> Column:
    """The root that ``leaf`` and the siblings of ``path`` lead to."""
    both = "CASE WHEN p.sibling IS NULL THEN acc WHEN p.left THEN concat(p.sibling, acc) ELSE concat(acc, p.sibling) END"
    return F.expr(f"aggregate({path}, {leaf}, (acc, p) -> sha2({both}, 256))")


def verified(docs: DataFrame, **altered: Column) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified."""
    return proofs(docs, **altered).select(
        "doc_id", "leaf", "subroot", "root",
        F.expr("sha2(concat_ws('', path.sibling), 256)").alias("proof_sha256"),
        folded("checked", "path").alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))

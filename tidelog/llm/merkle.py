"""A Merkle manifest of a table: one tree per source, and a tree over the sources' roots.

Every ``arity`` consecutive nodes, the last run possibly fewer, become one node of the next
level, until one is left. Only every ``keep`` levels are written. What lies between is made
again where a proof needs it: the stored nodes below a stored node are an aligned subtree of
``arity ** keep`` nodes at most, so one row regenerates its interior, emits the siblings of its
nodes and drops it. Ranks within a source come from a blocked prefix scan and subtrees are keyed
by (source, place), so a source that holds most of the rows is many small groups.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import Stored
from tidelog.plans.prefix import Scan, prefix

ARITY = 16
KEEP = 2
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# One level of a proof: the digests of a run to the left and to the right of a node, joined.
_PATH = "array<struct<left:string,right:string>>"


def field_text(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*[field_text(v) for v in values]), 256)


def lowered(text: Column) -> Column:
    """A tampered text: A-Z in lower case, all else as it was."""
    return F.translate(text, _UPPER, _UPPER.lower())


def _tree_key(source: Column) -> Column:
    """Orders sources by their bytes, null first; never null itself."""
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit(""))


def _next_level(digests: Column, arity: int) -> Column:
    runs = F.sequence(F.lit(0), F.floor((F.size(digests) - 1) / arity).cast("int"))
    return F.transform(
        runs, lambda i: F.sha2(F.array_join(F.slice(digests, i * arity + 1, F.lit(arity)), ""), 256)
    )


@dataclass
class Forest:
    """Trees by ``tree``: stored levels (tree, idx, digest), the lowest first, and leaf counts.

    The lowest level may have further columns. ``reach`` is the height of the tallest tree in
    stored levels.
    """

    stored: list[Stored]
    sizes: Stored
    arity: int
    keep: int
    reach: int = field(default=0)

    @property
    def span(self) -> int:
        return self.arity**self.keep

    def subtrees(self, level: int, carried: Sequence[str] = ()) -> DataFrame:
        """One row per aligned subtree between stored levels: (tree, g, nodes, size).

        ``nodes`` are those of the lower level in order. ``size`` is how many the tree has
        there, null if more than a subtree holds.
        """
        nodes = self.stored[level].df
        rows = nodes.groupBy("tree", F.floor(F.col("idx") / self.span).alias("g")).agg(
            F.sort_array(F.collect_list(F.struct("idx", "digest", *carried))).alias("nodes")
        )
        n = F.col("n")
        for _ in range(level):
            n = F.ceil(n / self.span)
        small = self.sizes.df.select("tree", F.lit(0).cast("long").alias("g"), n.cast("long").alias("size"))
        return rows.join(small.where(F.col("size") <= self.span), ["tree", "g"], "left")

    def _interior(self, subtrees: DataFrame) -> DataFrame:
        """Adds the regenerated levels ``_0`` (the stored one) to ``_<keep>`` of each subtree."""
        out = subtrees.withColumn("_0", F.transform("nodes", lambda x: x["digest"]))
        for level in range(self.keep):
            out = out.withColumn(f"_{level + 1}", _next_level(F.col(f"_{level}"), self.arity))
        return out

    def _tall(self, level: int) -> Column:
        """Whether the tree of a subtree has more than one node ``level`` levels further up."""
        return F.col("size").isNull() | (F.col("size") > self.arity**level)

    def raise_level(self) -> None:
        """Writes the stored level above the highest one."""
        inner = self._interior(self.subtrees(len(self.stored) - 1))
        top = F.col("_0")
        for level in range(self.keep):
            top = F.when(self._tall(level), F.col(f"_{level + 1}")).otherwise(top)
        self.stored.append(Stored(inner.select("tree", F.col("g").alias("idx"), top[0].alias("digest")), "nodes"))

    def descend(self, level: int, above: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
        """From proofs of the nodes of stored level ``level + 1`` to those of ``level``.

        ``above`` has (tree, idx, path, subroot); the result these and ``digest`` and what is
        ``carried`` of the lower level. Interior nodes exist within a row only.
        """
        parents = above.withColumnRenamed("idx", "g")
        inner = self._interior(self.subtrees(level, carried)).join(parents, ["tree", "g"])
        each = inner.select("*", F.posexplode("nodes").alias("_at", "_node"))
        steps = []
        for up in range(self.keep):
            place = F.floor(F.col("_at") / self.arity**up).cast("int")
            digests, inside = F.col(f"_{up}"), place % self.arity
            left = F.slice(digests, place - inside + 1, inside)
            right = F.slice(digests, place + 2, F.lit(self.arity - 1) - inside)
            step = F.struct(F.array_join(left, "").alias("left"), F.array_join(right, "").alias("right"))
            steps.append(F.when(self._tall(up), F.array(step)).otherwise(F.array().cast(_PATH)))
        return each.select(
            "tree",
            F.col("_node.idx").alias("idx"),
            F.col("_node.digest").alias("digest"),
            *[F.col("_node")[c].alias(c) for c in carried],
            F.concat(*steps, "path").alias("path"),
            "subroot",
        )

    def delete(self) -> None:
        for table in [*self.stored, self.sizes]:
            table.delete()


def plant(nodes: DataFrame, order: Sequence[str], arity: int = ARITY, keep: int = KEEP) -> Forest:
    """Trees over ``nodes`` (tree, digest and the columns of ``order``), each in that order."""
    placed = prefix(nodes, ["tree"], order, {"idx": Scan("count", inclusive=False)})
    lowest = Stored(placed, "nodes")
    sizes = Stored(lowest.df.groupBy("tree").agg(F.count(F.lit(1)).alias("n")), "sizes")
    forest = Forest([lowest], sizes, arity, keep)
    most = sizes.df.agg(F.max("n")).first()[0] or 0
    while most > 1:
        forest.raise_level()
        most = -(-most // forest.span)
        forest.reach += 1
    return forest


@dataclass
class Manifest:
    """The stored levels of the trees of all sources and of the tree over their roots."""

    sources: Forest
    top: Forest
    root: str | None

    def subroots(self) -> DataFrame:
        """One row per source: (source, subroot)."""
        source = F.when(F.col("tree") != "", F.substring("tree", 2, 2**31 - 1)).alias("source")
        return self.sources.stored[-1].df.select(source, F.col("digest").alias("subroot"))

    def proofs(self) -> DataFrame:
        """One row per leaf: its key columns, ``leaf``, ``subroot`` and ``path``.

        ``path`` holds, from the leaf up to the root, the digests left and right of the node
        in its run, each side joined into one string; a level where a tree has but one node
        has no entry.
        """
        none = F.array().cast(_PATH).alias("path")
        start = self.top.stored[-1].df.select("tree", "idx", none, F.lit(None).cast("string").alias("subroot"))
        carried = ["of"]
        for level in reversed(range(self.top.reach)):
            start = self.top.descend(level, start, carried if level == 0 else [])
        if not self.top.reach:
            start = self.top.stored[0].df.select("digest", "of", none)
        subroots = start.select(F.col("of").alias("tree"), "path", F.col("digest").alias("subroot"))
        held = self.sources.stored
        down = held[-1].df.join(subroots, "tree")
        keys = [c for c in held[0].df.columns if c not in ("tree", "idx", "digest")]
        for level in reversed(range(self.sources.reach)):
            above = down.select("tree", "idx", "path", "subroot")
            down = self.sources.descend(level, above, keys if level == 0 else [])
        return down.select(*keys, F.col("digest").alias("leaf"), "subroot", "path")

    def delete(self) -> None:
        """Deletes the stored levels; proofs cannot be read afterwards."""
        self.sources.delete()
        self.top.delete()


def build(leaves: DataFrame, *, arity: int = ARITY, keep: int = KEEP) -> Manifest:
    """The manifest of ``leaves``: ``source``, ``doc_id``, ``leaf`` and any further columns.

    Leaves of a source ascend by doc_id (null first), equal ids by digest; sources by their
    bytes, null first. Further columns come back with the proofs.
    """
    nodes = leaves.withColumn("tree", _tree_key(F.col("source"))).drop("source")
    forest = plant(nodes.withColumnRenamed("leaf", "digest"), ["doc_id", "digest"], arity, keep)
    tops = forest.stored[-1].df.select(F.substring("tree", 1, 0).alias("tree"), F.col("tree").alias("of"), "digest")
    over = plant(tops, ["of"], arity, keep)
    root = over.stored[-1].df.select("digest").first()
    return Manifest(forest, over, root and root.digest)


def proof_digest(path: Column) -> Column:
    """The digest of all siblings of a proof, from the leaf up, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(path, leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def audit(documents: DataFrame, tampered: Column, altered: Column, **shape) -> DataFrame:
    """One row per document: its proof against the manifest of the table, after tampering.

    Rows (doc_id, leaf, subroot, root, proof_sha256, folded_root, verified). The text of the
    rows where ``tampered`` holds becomes ``altered`` (both over the columns of ``documents``)
    before the proof is checked.

    Nulls in any column are part of a leaf, and differ from empty texts; a null source is a
    source of its own. Texts count whole, however long. Repeated rows are leaves each, next to
    each other in any order, which changes nothing. Other columns, whatever their names, are
    no part of a leaf. An empty table has no root and gives no rows.
    """
    first = [F.col(c) for c in COLUMNS[:-1]]
    changed = F.when(F.coalesce(tampered, F.lit(False)), leaf_digest(*first, altered))
    leaves = documents.select(
        F.col("doc_id"), F.col("source").cast("string"),
        leaf_digest(*first, F.col("text")).alias("leaf"), changed.alias("found"),
    )
    stored = Stored(leaves, "leaves")
    manifest = build(stored.df, **shape)
    stored.delete()
    root = F.lit(manifest.root).cast("string")
    end = folded(F.coalesce("found", "leaf"), F.col("path"))
    proved = manifest.proofs().select(
        "doc_id", "leaf", "subroot", root.alias("root"),
        proof_digest(F.col("path")).alias("proof_sha256"), end.alias("folded_root"),
    )
    return proved.withColumn("verified", F.col("folded_root") == F.col("root"))

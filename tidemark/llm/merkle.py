"""A Merkle manifest of a dataset: a tree of SHA-256 digests per group, and one over the groups.

A node is the hash of at most 16 consecutive digests of the level below. While a run of children is
hashed, the state before each child is copied and kept, so that a changed child is folded up by
resuming the state at its slot with the replacement and the siblings to its right; what is left of
it is never read again.

Trees are built in blocks of 16^2 consecutive nodes: a block is one bounded group and gives one node
two levels up, so a level costs no shuffle of its own and a group of any size is spread over its
blocks; wider blocks would hold more proofs at once. Then the blocks are gone through from the root down; each passes on what lies beside the
way up from each of its nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import indexed, stored, without

RUN = 16
#: levels that one block spans, and its width
LEVELS = 2
BLOCK = RUN**LEVELS

_NODES = "tree long, at long, n long, digest string"
_WAY = "lefts array<string>, rights array<string>"


def leaves(df: DataFrame, columns: list[str], keep: list[str], digests: dict[str, dict[str, Callable[[bytes], bytes]]] | None = None) -> DataFrame:
    """Some columns of all rows, with the digest of each row's values as `leaf`: of each value's
    UTF-8 length, a colon and the value, one after the other, `-` for null.

    `digests` names the digests otherwise, and gives for each the changes of values before hashing;
    a null value stays null. Kept columns with these names are replaced.
    """
    digests = {"leaf": {}} if digests is None else digests
    kept = without(df.select(*[F.col(f"`{c}`") for c in keep]), list(digests))
    values = [F.col(f"`{c}`").cast("string").alias(f"_{i}") for i, c in enumerate(columns)]
    source = df.select(F.struct(*[F.col(f"`{c}`") for c in kept.columns]).alias("_row"), *values)
    changed = [[changes.get(c) for c in columns] for changes in digests.values()]

    def run(batches):
        for batch in batches:
            fields = [batch[f"_{i}"].cast(pa.binary()).to_pylist() for i in range(len(columns))]
            found = [[_leaf(row, change) for row in zip(*fields)] for change in changed]
            yield pa.RecordBatch.from_arrays([batch["_row"], *[pa.array(f, pa.string()) for f in found]], names=["_row", *digests])

    schema = T.StructType([source.schema["_row"], *[T.StructField(n, T.StringType()) for n in digests]])
    found = source.mapInArrow(run, schema)
    return found.select(*[F.col(f"_row.`{c}`").alias(c) for c in kept.columns], *digests)


def _leaf(values: tuple[bytes | None, ...], changes: list) -> str:
    state = hashlib.sha256()
    for value, change in zip(values, changes):
        if value is None:
            state.update(b"-")
            continue
        value = change(value) if change else value
        state.update(b"%d:" % len(value))
        state.update(value)
    return state.hexdigest()


def fold(digest: str, way: list) -> str:
    """The root above a digest: each kept state takes the digest and its right siblings."""
    for state, right in way:
        resumed = state.copy()
        resumed.update((digest + right).encode())
        digest = resumed.hexdigest()
    return digest


def _hashed(run: list[str]) -> tuple[str, list]:
    """The digest of a run of children, and the copied states before each of them."""
    state, kept = hashlib.sha256(), []
    for child in run:
        kept.append(state.copy())
        state.update(child.encode())
    return state.hexdigest(), kept


def _levels(digests: list[str], count: int) -> list[list[tuple[str, list]]]:
    """The nodes of a block, level by level; `count` is how many nodes the whole tree has below."""
    out = []
    while count > 1 and len(out) < LEVELS:
        out.append([_hashed(digests[i : i + RUN]) for i in range(0, len(digests), RUN)])
        digests, count = [d for d, _ in out[-1]], -(-count // RUN)
    return out


def _ways(digests: list[str], levels: list, lefts: list[str], rights: list[str]) -> list[tuple]:
    """For each digest of a block: (left siblings, right siblings, kept states) per level up to the root."""
    # above the block the left siblings are hashed once; the state is kept for all its nodes
    above = tuple((left, right, hashlib.sha256(left.encode())) for left, right in zip(lefts, rights))
    found = [above]
    below = [digests, *[[d for d, _ in level] for level in levels]]
    for children, level in zip(reversed(below[:-1]), reversed(levels)):
        now = []
        for i in range(len(children)):
            parent, slot = divmod(i, RUN)
            run = children[parent * RUN : parent * RUN + RUN]
            step = ("".join(run[:slot]), "".join(run[slot + 1 :]), level[parent][1][slot])
            now.append((step, *found[parent]))
        found = now
    return found


def _up(nodes: DataFrame) -> DataFrame:
    """(tree, at, n, digest) of the nodes that stand over the blocks; n counts the tree's nodes there."""

    def top(block: pa.Table) -> pa.Table:
        block = block.sort_by("at")
        digests, n = block["digest"].to_pylist(), block["n"][0].as_py()
        levels = _levels(digests, n)
        for _ in levels:
            n = -(-n // RUN)
        digest = levels[-1][0][0] if levels else digests[0]
        return pa.table({"tree": block["tree"][:1], "at": [block["at"][0].as_py() // BLOCK], "n": [n], "digest": [digest]})

    block = F.floor(F.col("at") / BLOCK).alias("block")
    return nodes.groupBy("tree", block).applyInArrow(top, _NODES)


def _down(children: DataFrame, ways: DataFrame) -> DataFrame:
    """(tree, at, lefts, rights): what lies beside the way up from each child; ways has it for the blocks."""

    def spread(block: pa.Table, above: pa.Table) -> pa.Table:
        block, found = _way_of(block, above)
        columns = {"tree": block["tree"], "at": block["at"]}
        for i, name in enumerate(("lefts", "rights")):
            columns[name] = pa.array([[s[i] for s in way] for way in found], pa.list_(pa.string()))
        return pa.table(columns)

    return _met(children, ways).applyInArrow(spread, f"tree long, at long, {_WAY}")


def _met(children: DataFrame, ways: DataFrame):
    left = children.withColumn("block", F.floor(F.col("at") / BLOCK)).groupBy("tree", "block")
    return left.cogroup(ways.withColumn("block", F.col("at")).groupBy("tree", "block"))


def _way_of(block: pa.Table, above: pa.Table) -> tuple[pa.Table, list]:
    block = block.sort_by("at")
    digests = block["digest"].to_pylist()
    levels = _levels(digests, block["n"][0].as_py())
    return block, _ways(digests, levels, above["lefts"][0].as_py(), above["rights"][0].as_py())


def _climbed(leaves: DataFrame) -> list[DataFrame]:
    """Leaves, and the nodes over blocks, over blocks of blocks and so on to one node a tree."""
    tiers = [leaves]
    most = leaves.agg(F.max("n")).first()[0] or 1
    while most > 1:
        tiers.append(stored(_up(tiers[-1].select("tree", "at", "n", "digest")), "merkle"))
        for _ in range(LEVELS):
            most = -(-most // RUN)
    return tiers


def manifest(df: DataFrame, digest: str = "leaf", group: str = "source", order: tuple[str, ...] = ("doc_id",), replacement: str | None = None) -> DataFrame:
    """All rows and columns, with each row's place in the tree: `subroot` of its group, `root` of all,
    `proof` (the siblings' digests from the row up to the root, left to right in each level), and
    `folded_root`, which the kept states and right siblings give for `replacement` (a column of
    digests; where it is null, or not given, the row's own).

    Rows ascend by `order` (nulls first) in their group, ties by digest; groups by their UTF-8 bytes,
    null first. Rows that are alike in all of these are alike in the tree but for their places. An
    empty table gives an empty one. Columns with the names above are replaced. df's `digest` must not
    be null.
    """
    new = ("subroot", "root", "proof", "folded_root")
    kept = without(df, list(new))
    named = kept.select(
        F.col(f"`{group}`").alias("_group"),
        *[F.col(f"`{c}`").alias(f"_order_{i}") for i, c in enumerate(order)],
        F.col(f"`{digest}`").alias("digest"),
        (F.lit(None).cast("string") if replacement is None else F.col(f"`{replacement}`")).alias("_other"),
        F.struct(*[F.col(f"`{c}`") for c in kept.columns]).alias("_row"),
    )
    placed = indexed(stored(named, "leaves"), ["_group", *[f"_order_{i}" for i in range(len(order))], "digest"], "_index")
    # a group's rows lie side by side, so its trees begin at its least index
    sizes = stored(placed.groupBy("_group").agg(F.min("_index").alias("_first"), F.count(F.lit(1)).alias("n")), "groups")
    trees = stored(indexed(sizes, ["_group"], "tree"), "groups")
    same = placed["_group"].eqNullSafe(trees["_group"])
    leaves = placed.join(trees.select("_group", "_first", "n", "tree"), same)
    leaves = stored(leaves.select("tree", (F.col("_index") - F.col("_first")).alias("at"), "n", "digest", "_other", "_row"), "leaves")

    tiers = _climbed(leaves)
    subroots = stored(tiers[-1].select("tree", "digest"), "subroots")
    count = trees.count()
    over = subroots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("at"), F.lit(count).cast("long").alias("n"), "digest")
    roots = _climbed(over)
    none = F.array().cast("array<string>")
    ways = roots[-1].select("tree", "at", none.alias("lefts"), none.alias("rights"))
    for tier in reversed(roots[:-1]):
        ways = _down(tier, ways)
    ways = stored(ways.select(F.col("at").alias("tree"), F.lit(0).cast("long").alias("at"), "lefts", "rights"), "ways")
    for tier in reversed(tiers[1:-1]):
        ways = stored(_down(tier.select("tree", "at", "n", "digest"), ways), "ways")

    def settle(block: pa.Table, above: pa.Table) -> pa.Table:
        block, found = _way_of(block, above)
        digests, others = block["digest"].to_pylist(), block["_other"].to_pylist()
        folded = [fold(o or d, [(state, right) for _, right, state in way]) for d, o, way in zip(digests, others, found)]
        proofs = ["".join(left + right for left, right, _ in way) for way in found]
        return pa.table({"tree": block["tree"], "_row": block["_row"], "proof": proofs, "folded_root": folded})

    schema = T.StructType([leaves.schema["tree"], leaves.schema["_row"]]).add("proof", "string").add("folded_root", "string")
    done = _met(leaves, ways).applyInArrow(settle, schema)
    root = roots[-1].first()  # one row, none for an empty table
    tops = subroots.select("tree", F.col("digest").alias("subroot"), F.lit(root and root["digest"]).cast("string").alias("root"))
    return done.join(tops, "tree").select(*[F.col(f"_row.`{c}`").alias(c) for c in kept.columns], *new)

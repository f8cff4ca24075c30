"""Operator 12: Merkle manifest of a table, proved by octopus multiproofs.

Leaves of a source ascend by id (null first; equal ids by digest) and every
``ARITY`` consecutive nodes become their hash until one is left; the sources' last
nodes, ordered by source (null first, bytewise), make one more tree whose last node
is the root. A leaf partition is one aligned block of ``ARITY ** LOW`` leaves:

1. a block hashes its own interior, gives its top node, and names the coordinates of
   all nodes outside it that its proofs lack (``missing``), each only once;
2. the tops are hashed upwards in blocks of the same size, a pass per ``LOW`` levels;
3. one join fetches the named nodes, and each block expands the proofs of its leaves
   from its own interior and what was fetched, and folds them to the root.

No group exceeds ``ARITY ** LOW`` rows, whatever the size of a source; positions come
from range partitions. Nodes that many blocks name are joined, never collected.

Defined cases: a null column is hashed as ``-``, an empty text as ``0:``; repeated
rows are leaves of their own and prove alike up to their places; other columns are
ignored; an empty table has no leaves and gives no rows.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickspark.llm.common import stored
from tickspark.operators.ranking import ranked

ARITY = 3
LOW = 7  # levels inside a block: at most 2,187 leaves
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(parts: list[str]) -> str:
    """Lower-case hex SHA-256 of the digests, joined as text."""
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def heights(n: int) -> list[int]:
    """Number of nodes on every level of a tree over n leaves, from the leaves up."""
    out = [n]
    while out[-1] > 1:
        out.append(-(-out[-1] // ARITY))
    return out


def grow(nodes: list[str], levels: int) -> list[list[str]]:
    """The given consecutive nodes and up to ``levels`` levels above them."""
    out = [nodes]
    while len(out) <= levels:
        below = out[-1]
        out.append([digest(below[k:k + ARITY]) for k in range(0, len(below), ARITY)])
    return out


def missing(held: list[int], n: int, level: int = 0) -> list[tuple[int, int]]:
    """(level, index) of the fewest nodes that, with the ``held`` nodes of ``level``, give
    the root of a tree over n leaves and every proof of a held node.

    Per level: the run mates of the held nodes that are not held; the runs' parents
    are then held as well.
    """
    counts, want, mine = heights(n), [], sorted(set(held))
    for k in range(level, len(counts) - 1):
        have = set(mine)
        runs = sorted({i // ARITY for i in mine})
        want += [(k, i) for r in runs for i in range(r * ARITY, min((r + 1) * ARITY, counts[k])) if i not in have]
        mine = runs
    return want


def proof(index: int, n: int, node, levels: range | None = None) -> list[tuple[list[str], int]]:
    """(siblings left to right, own place among them) on each level; ``node(level, index)``."""
    counts, out = heights(n), []
    for k in levels if levels is not None else range(len(counts) - 1):
        i = index // ARITY ** k
        start = i - i % ARITY
        run = range(start, min(start + ARITY, counts[k]))
        out.append(([node(k, j) for j in run if j != i], i - start))
    return out


def fold(leaf: str, steps: list[tuple[list[str], int]]) -> str:
    """The root that a leaf and its proof lead to."""
    for siblings, place in steps:
        leaf = digest([*siblings[:place], leaf, *siblings[place:]])
    return leaf


def _climb(low: int):
    """One block of consecutive nodes -> its levels above, and (null digest) the nodes it lacks."""
    def run(key, table):
        return _climbed(table, low)

    return run


def _climbed(table: pa.Table, low: int) -> pa.Table:
    rows = sorted(zip(table["idx"].to_pylist(), table["digest"].to_pylist()))
    tree, n, base, block = table["tree"][0].as_py(), table["n"][0].as_py(), table["level"][0].as_py(), rows[0][0] // ARITY ** low
    tops = len(heights(n)) - 1
    up = min(low, tops - base)
    grown = grow([d for _, d in rows], up)
    out = [(base + k, block * ARITY ** (low - k) + j, d) for k in range(1, up + 1) for j, d in enumerate(grown[k])]
    if base == 0:
        out = [out[-1]] if out else [(0, 0, rows[0][1])]
        out += [(k, i, None) for k, i in missing([block], n, up)]
    level, idx, digests = zip(*out) if out else ((), (), ())
    return pa.table({"tree": pa.array([tree] * len(out), pa.string()), "n": pa.array([n] * len(out), pa.int64()),
                     "block": pa.array([block] * len(out), pa.int64()), "level": pa.array(level, pa.int32()),
                     "idx": pa.array(idx, pa.int64()), "digest": pa.array(digests, pa.string())})


_NODES = "tree string, n long, block long, level int, idx long, digest string"


def _block(low: int) -> Column:
    return F.floor(F.col("idx") / ARITY ** low)


def _grown(nodes: DataFrame, low: int) -> DataFrame:
    return nodes.groupBy("tree", _block(low).alias("__block")).applyInArrow(_climb(low), _NODES)


def upper_nodes(tops: DataFrame, most: int, low: int) -> DataFrame:
    """All nodes from the block tops upwards; ``most``: leaves of the largest tree."""
    nodes, level = tops, low
    while level < len(heights(most)) - 1:
        tops = stored(_grown(tops.where((F.col("level") == level) & (F.col("level") < F.col("height")))
                             .select("tree", "n", "level", "idx", "digest"), low)
                      .select("tree", "n", "level", "idx", "digest", _height(F.col("n")).alias("height")), "merkle-upper")
        nodes, level = nodes.unionByName(tops), level + low
    return nodes


def _height(n: Column) -> Column:
    """Levels above the leaves of a tree over n leaves, in exact integer steps."""
    return sum(F.when(n > ARITY ** k, 1).otherwise(0) for k in range(40)).cast("int")


def _expand(with_steps: bool, low: int):
    """A block's leaves and its fetched nodes -> proof, folded root and own root of each leaf."""
    def run(key, leaves, fetched):
        order = leaves.sort_by("idx")
        idx, n = order["idx"].to_pylist(), order["n"][0].as_py()
        first, block = idx[0], idx[0] // ARITY ** low
        top = len(heights(n)) - 1
        up = min(low, top)
        inside = grow(order["digest"].to_pylist(), up)
        outside = {(k, i): d for k, i, d in zip(fetched["level"].to_pylist(), fetched["idx"].to_pylist(), fetched["digest"].to_pylist())}
        above = proof(first, n, lambda k, i: outside[k, i], range(up, top))
        root = fold(inside[up][0], above)
        proofs, folded, lists, places = [], [], [], []
        for i, shown in zip(idx, order["shown"].to_pylist()):
            steps = proof(i, n, lambda k, j: inside[k][j - block * ARITY ** (low - k)], range(up)) + above
            flat = [d for siblings, _ in steps for d in siblings]
            proofs.append("".join(flat))
            folded.append(fold(shown, steps))
            if with_steps:
                lists.append([s for s, _ in steps])
                places.append([p for _, p in steps])
        out = {"tree": order["tree"], "idx": order["idx"], "proof": pa.array(proofs, pa.string()),
               "folded": pa.array(folded, pa.string()), "top": pa.array([root] * len(idx), pa.string())}
        if with_steps:
            out |= {"siblings": pa.array(lists, pa.list_(pa.list_(pa.string()))), "places": pa.array(places, pa.list_(pa.int32()))}
        return pa.table(out)

    return run


_PROOFS = "tree string, idx long, proof string, folded string, top string"
_STEPS = ", siblings array<array<string>>, places array<int>"


def prove(leaves: DataFrame, with_steps: bool = False, low: int = LOW) -> DataFrame:
    """Proofs of all leaves of all trees.

    ``leaves``: tree string, idx long (0-based, without gaps), n long, digest string,
    shown string (the digest to fold, equal to ``digest`` where nothing was changed).
    Gives tree, idx, proof (all siblings joined), folded (root from ``shown``), top (the
    tree's own last node) and, ``with_steps``, siblings per level and the own places.
    """
    most = leaves.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    found = stored(_grown(leaves.select("tree", "n", F.lit(0).alias("level"), "idx", "digest"), low), "merkle-blocks")
    tops = found.where("digest is not null").select("tree", "n", "level", "idx", "digest", _height(F.col("n")).alias("height"))
    nodes = upper_nodes(tops, most, low).select("tree", "level", "idx", "digest")
    wants = found.where("digest is null").select("tree", "block", "level", "idx")
    fetched = wants.join(nodes, ["tree", "level", "idx"]).select("tree", F.col("block").alias("block"), "level", "idx", "digest")
    mine = leaves.select("tree", "idx", "n", "digest", "shown", _block(low).alias("block")).groupBy("tree", "block")
    return mine.cogroup(fetched.groupBy("tree", "block")).applyInArrow(_expand(with_steps, low), _PROOFS + (_STEPS if with_steps else ""))


def _piece(col: Column) -> Column:
    text = col.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(columns: list[Column]) -> Column:
    """SHA-256 of the columns: null as ``-``, else the byte count, a colon and the value."""
    return F.sha2(F.concat(*map(_piece, columns)), 256)


def manifest(docs: DataFrame, tampered: Column, columns: tuple[str, ...] = COLUMNS, id_col: str = "doc_id", source_col: str = "source",
             text_col: str = "text", with_steps: bool = False, low: int = LOW) -> DataFrame:
    """One row per row of ``docs``: id, source, leaf, subroot, root, proof_sha256,
    folded_root, verified and, ``with_steps``, the siblings and own places of the proof
    in the source's tree and in the tree of sources.

    ``tampered``: a condition on the id; where it is true, the text is shown without its
    line ends when its proof is folded.
    """
    whole = leaf_digest([F.col(c) for c in columns])
    cut = leaf_digest([F.replace(F.col(c).cast("string"), F.lit("\n"), F.lit("")) if c == text_col else F.col(c) for c in columns])
    tree = F.coalesce(F.concat(F.lit("s"), F.col(source_col).cast("string")), F.lit(""))  # null sorts first
    named = docs.select(F.col(id_col).alias("id"), tree.alias("tree"), whole.alias("digest"),
                        F.when(tampered, cut).otherwise(whole).alias("shown"))
    leaves = stored(ranked(named, ["tree"], [F.col("id").asc_nulls_first(), F.col("digest")], rank="idx", size="n", name="merkle-order"),
                    "merkle-leaves")
    own = stored(prove(leaves, with_steps, low), "merkle-proofs")
    subroots = own.where("idx = 0").select("tree", F.col("top").alias("digest"))
    roots = ranked(subroots, [], [F.col("tree")], rank="idx", size="n", name="merkle-sources").withColumn("source_tree", F.col("tree"))
    above = prove(roots.select(F.lit("").alias("tree"), "idx", "n", "digest", F.col("digest").alias("shown")), True, low)
    above = stored(above.join(roots.select("idx", "source_tree"), "idx").select(
        F.col("source_tree").alias("tree"), F.col("proof").alias("up_proof"), F.col("siblings").alias("up_siblings"),
        F.col("places").alias("up_places"), F.col("top").alias("root")), "merkle-above")
    folded = F.aggregate(F.arrays_zip("up_siblings", "up_places"), F.col("folded"), lambda node, step: F.sha2(F.concat_ws(
        "", F.slice(step["up_siblings"], F.lit(1), step["up_places"]), node,
        F.slice(step["up_siblings"], step["up_places"] + 1, F.size(step["up_siblings"]) + 1)), 256))
    out = (leaves.select("tree", "idx", "id", "digest").join(own, ["tree", "idx"]).join(above, "tree")
           .select(F.col("id").alias(id_col), F.when(F.col("tree") != "", F.substring("tree", 2, 1 << 30)).alias(source_col),
                   F.col("digest").alias("leaf"), F.col("top").alias("subroot"), "root",
                   F.sha2(F.concat("proof", "up_proof"), 256).alias("proof_sha256"), folded.alias("folded_root"),
                   *([c for c in ("siblings", "places", "up_siblings", "up_places")] if with_steps else [])))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))

"""Merkle manifest of a dataset, with proofs by butterfly exchange.

1. A leaf is a digest of one row's id, source, language, length and text. From here on only ids and digests move.
2. Leaves are range-partitioned and sorted by source and id; counts of the stretch that each source has in each partition give
   every leaf its place in its source. FANOUT ** LEVELS leaves at aligned places form a part, a row with bounded lists.
3. A task hashes its part's lower levels by itself, up to the part's root.
4. Then parts exchange roots round by round. In round r a part swaps the digest of its ancestor with the
   parts whose number differs in digit r only (to base FANOUT). Each gets the digests of its ancestor's run, keeps
   the siblings, and hashes the next ancestor itself, as all parts below that ancestor do. After the last round
   every part holds the root and the upper siblings; nothing is passed down a tree. Where the last run lacks parts
   with the same lower digits, those it has stand in for them.
5. The roots of the sources are leaves of a tree of the same kind over the sources.
6. A second pass over the parts joins the siblings of the parts and of the sources to the lower ones, and folds each
   leaf to the root again.

A message is one digest, and a part sends at most FANOUT of them a round, but for parts of an incomplete run, whose messages are
made by an explode and shuffled by receiver. A hot source is many parts, and no task or group holds more than a part.

Defined cases: a null field is `-` in a leaf, a null source is a source and comes first; a null doc_id comes first in its
source and is not tampered with; rows with one doc_id are ordered by leaf, equal rows are leaves of their own; a
lone leaf is its source's root, a lone source's root is the root; empty and very long texts are hashed like others; an empty
table has no rows and no root; columns beside the five are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caudal.llm.shared import in_batches, scope, staged

FANOUT = 16
LEVELS = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPER = 5
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def leaf_of(fields: Iterable[Column]) -> Column:
    """Digest of a row: of each field its byte count and value, or a dash."""
    texts = [field.cast("string") for field in fields]
    return F.sha2(F.concat(*(
        F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")) for text in texts)), 256)


def leaves_of(docs: DataFrame, every: int = TAMPER) -> DataFrame:
    """doc_id, source, leaf, and the leaf of the tampered row where the checksum of its id is divisible by `every`."""
    docs = docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), F.col("lang").cast("string"),
                       F.col("n_chars").cast("long"), F.col("text").cast("string"))
    changed = F.translate("text", _UPPER, _UPPER.lower())
    fields = [F.col(name) for name in FIELDS]
    return docs.select("doc_id", "source", leaf_of(fields).alias("leaf"), F.when(
        F.crc32(F.col("doc_id").cast("string").cast("binary")) % every == 0,
        leaf_of([*fields[:-1], changed])).alias("tampered"))


def joined(digests: Iterable[str]) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def climbed(leaves: list[str], fanout: int, levels: int | None) -> list[list[str]]:
    """The rows of a tree from its leaves up: `levels` more of them, or as many as lead to one node."""
    out = [leaves]
    while len(out) <= levels if levels is not None else len(out[-1]) > 1:
        row = out[-1]
        out.append([joined(row[at:at + fanout]) for at in range(0, len(row), fanout)])
    return out


def own_levels(leaves: int, total: int, fanout: int, levels: int) -> int | None:
    """How many levels a part climbs: all of them in a tree of several parts, or to its only node."""
    return levels if total > fanout ** levels else None


def placed(leaves: DataFrame, tree: list[str], order: list[str]) -> DataFrame:
    """The leaves, staged, with `tree_id` (rising with the columns of `tree`), `place` in the tree and `total`.

    No window runs over the leaves: only over one row for each tree and partition that holds some of it.
    """
    rows = (leaves.repartitionByRange(*tree, *order).sortWithinPartitions(*tree, *order)
            .withColumn("_id", F.monotonically_increasing_id()).withColumn("_task", F.shiftright("_id", 33)))
    with scope() as work:
        rows = staged(rows, "zstd")
        spans = rows.groupBy("_task", *tree).agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_count"))
        in_tree = Window.partitionBy(*tree)
        spans = staged(spans.select(
            "_task", *tree, "_first", F.min("_first").over(in_tree).alias("tree_id"),
            F.sum("_count").over(in_tree).alias("total"),
            (F.sum("_count").over(in_tree.orderBy("_task")) - F.col("_count")).alias("_before")))
        spans = spans.select(*(F.col(c).alias(f"_{c}") for c in tree), F.col("_task").alias("_of"), "_first",
                             "tree_id", "total", "_before")
        match = F.col("_task") == F.col("_of")
        for name in tree:
            match &= F.col(name).eqNullSafe(F.col(f"_{name}"))
        out = rows.join(spans, match).withColumn("place", F.col("_before") + F.col("_id") - F.col("_first"))
        return work.result(out.select("tree_id", "total", "place", *leaves.columns), "zstd")


def parts_of(rows: DataFrame, fanout: int, levels: int, *carried: str) -> DataFrame:
    """Aligned parts of at most fanout ** levels leaves: tree_id, part, total, lists in the order of places."""
    size = fanout ** levels
    lists = F.array_sort(F.collect_list(F.struct("place", "leaf", *carried)))
    return (rows.groupBy("tree_id", F.floor(F.col("place") / size).alias("part"))
            .agg(F.first("total").alias("total"), lists.alias("_rows"))
            .select("tree_id", "part", "total", F.col("_rows.leaf").alias("leaf"),
                    *(F.col(f"_rows.{name}").alias(name) for name in carried)))


def part_roots(parts: DataFrame, fanout: int, levels: int) -> DataFrame:
    """tree_id, part, parts in the tree, and the digest of each part's root."""
    def each(columns):
        yield {"tree_id": columns["tree_id"], "part": columns["part"], "parts": [
            -(-total // fanout ** levels) for total in columns["total"]], "digest": [
            climbed(leaf, fanout, own_levels(len(leaf), total, fanout, levels))[-1][0]
            for leaf, total in zip(columns["leaf"], columns["total"], strict=True)]}

    return in_batches(parts, each, "tree_id long, part long, parts long, digest string",
                      "tree_id", "part", "total", "leaf")


def swapped(state: DataFrame, fanout: int, below: int) -> DataFrame:
    """One round: parts whose ancestor covers `below` parts swap its digest and hash the next ancestor.

    Parts of a tree that has one node already are left as they are.
    """
    node = F.floor(F.col("part") / below)
    nodes = F.ceil(F.col("parts") / below)
    first = node * below
    there = F.least(F.lit(below).cast("long"), F.col("parts") - first)  # parts below this ancestor
    run = F.floor(node / fanout) * fanout
    # The parts of each neighbour that have this part's lower digits, or those it stands in for.
    targets = F.expr(f"""
        filter(flatten(transform(sequence(_run, least(_run + {fanout}, _nodes) - 1), n ->
            transform(sequence(_low, {below} - 1L, _there), low -> n * {below} + low))), t -> t < parts)""")
    going = state.filter(nodes > 1)
    sent = (going.withColumn("_run", run).withColumn("_nodes", nodes).withColumn("_there", there)
            .withColumn("_low", F.col("part") - first).withColumn("_node", node)
            .select("tree_id", "part", "parts", "digest", "siblings", "_node", F.explode(targets).alias("to")))
    own = F.col("part") == F.col("to")
    met = sent.groupBy("tree_id", F.col("to").alias("part")).agg(
        F.first("parts").alias("parts"), F.max(F.when(own, F.col("siblings"))).alias("siblings"),
        F.array_sort(F.collect_list(F.struct("_node", "digest"))).alias("_run"))
    mine = F.floor(F.col("part") / below)
    others = F.transform(F.filter("_run", lambda n: n["_node"] != mine), lambda n: n["digest"])
    position = mine - F.col("_run")[0]["_node"]
    return met.select(
        "tree_id", "part", "parts", F.sha2(F.concat_ws("", "_run.digest"), 256).alias("digest"),
        F.concat("siblings", F.array(F.struct(position.cast("int").alias("at"), others.alias("others")))).alias("siblings"),
    ).unionByName(state.filter(nodes <= 1))


def exchanged(roots: DataFrame, fanout: int) -> DataFrame:
    """tree_id, part, root of the tree, and the siblings of each ancestor of the part, from below up."""
    none = F.array().cast("array<struct<at:int,others:array<string>>>")
    with scope() as work:
        state = staged(roots.withColumn("siblings", none))
        most = state.agg(F.max("parts")).first()[0] or 0
        below = 1
        while below < most:
            before, state = state, staged(swapped(state, fanout, below))
            work.drop(before)
            below *= fanout
        return work.result(state.select("tree_id", "part", F.col("digest").alias("root"), "siblings"))


def lower_siblings(rows: list[list[str]], place: int, fanout: int) -> list[tuple[int, list[str]]]:
    """(position, siblings) of the ancestors of one leaf, below the last row."""
    out = []
    for row in rows[:-1]:
        first = place - place % fanout
        out.append((place - first, row[first:place] + row[place + 1:first + fanout]))
        place //= fanout
    return out


def folded(leaf: str, siblings: Iterable[tuple[int, list[str]]]) -> str:
    """The root that a leaf leads to with these siblings."""
    for at, others in siblings:
        leaf = joined([*others[:at], leaf, *others[at:]])
    return leaf


def _upper(structs) -> list[tuple[int, list[str]]]:
    return [(s["at"], s["others"]) for s in structs]


def source_proofs(roots: DataFrame, fanout: int, levels: int) -> DataFrame:
    """The tree over the sources: source_id, its siblings up to the root, and the root."""
    rows = placed(roots.select(F.lit(0).alias("all"), "source_id", F.col("root").alias("leaf")), ["all"], ["source_id"])
    parts = staged(parts_of(rows, fanout, levels, "source_id"))
    above = exchanged(part_roots(parts, fanout, levels), fanout)

    def each(columns):
        out = {"source_id": [], "siblings": [], "root": []}
        for total, leaf, ids, upper, root in zip(
                *(columns[c] for c in ("total", "leaf", "source_id", "siblings", "root")), strict=True):
            tree = climbed(leaf, fanout, own_levels(len(leaf), total, fanout, levels))
            for place, source in enumerate(ids):
                whole = lower_siblings(tree, place, fanout) + _upper(upper)
                out["source_id"].append(source)
                out["siblings"].append([{"at": at, "others": others} for at, others in whole])
                out["root"].append(root)
        yield out

    return in_batches(parts.join(above, ["tree_id", "part"]), each,
                      "source_id long, siblings array<struct<at:int,others:array<string>>>, root string")


def merkle_manifest(docs: DataFrame, fanout: int = FANOUT, levels: int = LEVELS, every: int = TAMPER) -> DataFrame:
    """One row per row: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified."""
    with scope() as work:
        leaves = staged(leaves_of(docs, every), "zstd")
        rows = placed(leaves, ["source"], ["doc_id", "leaf"])
        work.drop(leaves)
        parts = staged(parts_of(rows, fanout, levels, "doc_id", "tampered"), "zstd")
        work.drop(rows)
        above = exchanged(part_roots(parts, fanout, levels), fanout)
        sources = above.filter("part = 0").select(F.col("tree_id").alias("source_id"), "root")
        proofs = staged(source_proofs(sources, fanout, levels))
        above = above.select("tree_id", "part", F.col("root").alias("subroot"), "siblings").join(
            proofs.select(F.col("source_id").alias("tree_id"), F.col("siblings").alias("top"), "root"), "tree_id")

        def each(columns):
            names = ("total", "leaf", "tampered", "doc_id", "siblings", "subroot", "top", "root")
            for total, leaves, tampered, ids, siblings, subroot, top, root in zip(
                    *(columns[c] for c in names), strict=True):
                tree = climbed(leaves, fanout, own_levels(len(leaves), total, fanout, levels))
                upper = _upper(siblings) + _upper(top)
                tail = "".join("".join(others) for _, others in upper)
                proof, reached = [], []
                for place, (leaf, other) in enumerate(zip(leaves, tampered, strict=True)):
                    lower = lower_siblings(tree, place, fanout)
                    proof.append(joined([*("".join(others) for _, others in lower), tail]))
                    reached.append(folded(other or leaf, lower + upper))
                yield {"doc_id": list(ids), "leaf": leaves, "subroot": [subroot] * len(leaves),
                       "root": [root] * len(leaves), "proof_sha256": proof, "folded_root": reached,
                       "verified": [value == root for value in reached]}

        return work.result(in_batches(
            parts.join(above, ["tree_id", "part"]), each,
            "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
            "verified boolean"), "zstd")

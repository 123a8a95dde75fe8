"""Best-fit packing of documents into sequences by a grouping genetic algorithm on islands.

A document is its ids and an end id. One longer than a sequence is cut so that all pieces but the first
are whole sequences. The other pieces are dealt by hash into blocks of bounded size, and each block is
packed on several islands:

* An individual assigns the pieces of the block to bins. The first one is best-fit decreasing, the
  others are best-fit in randomly disturbed order.
* Crossover injects whole well-filled bins of one parent into the other, removes the bins that then
  hold a piece twice, and best-fits the displaced pieces, longest first.
* Fewer bins are better, then the larger sum of squared fills. The fittest survive.
* After each epoch the best individual of an island migrates to the next island of its block.

The best island of a block gives its bins. Pieces of bins that are not well filled are dealt
into new blocks and packed once more, so that blocks do not each leave a half-empty bin.

A block and its islands are one Spark group each; groups are as large at any size of input.

Defined cases: a null text is empty and has only the end id; equal rows and null ids are packed like
others; columns beside id and text are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caudal.llm.shared import in_batches, staged
from caudal.llm.tokens import byte_level_core

SIZE = 2048
BLOCK = 8192
ISLANDS = 2
EPOCHS = 2
POPULATION = 4
OFFSPRING = 8
WELL_FILLED = 0.97
_PACKED = "block long, island int, uid long, length long, bin long, bins long, squares double"


def cut(total: int, size: int = SIZE) -> list[tuple[int, int]]:
    """(start, length) of each piece of a document of `total` ids."""
    first = total % size or size
    ends = range(first, total + 1, size)
    return [(max(0, end - size) if end > first else 0, min(size, end)) for end in ends]


def document_pieces(docs: DataFrame, tokenizer: str, end_id: int = 0, size: int = SIZE) -> DataFrame:
    """doc_id, piece, start, length and crc32 of the ids of all pieces of (doc_id, text)."""
    end = np.array([end_id], "<u4").tobytes()

    def each(columns):
        encode = byte_level_core(tokenizer)
        out = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32")}
        for doc_id, text in zip(columns["doc_id"], columns["text"], strict=True):
            ids = memoryview(encode(text) + end)
            for piece, (start, length) in enumerate(cut(len(ids) // 4, size)):
                out["doc_id"].append(doc_id)
                out["piece"].append(piece)
                out["start"].append(start)
                out["length"].append(length)
                out["ids_crc32"].append(zlib.crc32(ids[4 * start:4 * (start + length)]))
        yield out

    return in_batches(docs.select(F.col("doc_id").cast("long"), "text"), each,
                      "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit(order, lengths: list[int], bin_of: np.ndarray, free: list[int], size: int) -> None:
    """Put the pieces of `order` where least room is left; `bin_of` and `free` are changed."""
    with_room: list[list[int]] = [[] for _ in range(size + 1)]
    rooms = 0  # bit r: a bin with r free places exists
    for number, room in enumerate(free):
        if room:
            with_room[room].append(number)
            rooms |= 1 << room
    for item in order:
        length = lengths[item]
        fitting = rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            number = with_room[room].pop()
            if not with_room[room]:
                rooms ^= 1 << room
        else:
            room, number = size, len(free)
            free.append(size)
        room -= length
        free[number] = room
        bin_of[item] = number
        if room:
            with_room[room].append(number)
            rooms |= 1 << room


def fitness(bin_of: np.ndarray, lengths: np.ndarray, size: int) -> tuple[int, float]:
    """Sorts better individuals first."""
    fill = np.bincount(bin_of, weights=lengths)
    return int(bin_of.max()) + 1, -float(((fill / size) ** 2).sum())


def crossover(into: np.ndarray, donor: np.ndarray, lengths: np.ndarray, as_list: list[int],
              size: int, random: np.random.Generator) -> np.ndarray:
    """A child of `into` with whole bins of `donor`."""
    fill = np.bincount(donor, weights=lengths)
    well = np.flatnonzero(fill >= WELL_FILLED * size)
    if not len(well):
        well = np.argsort(-fill)[:max(1, len(fill) // 4)]
    chosen = np.full(len(fill), -1)
    taken = well[random.random(len(well)) < random.uniform(0.2, 0.8)]
    chosen[taken] = np.arange(len(taken))
    injected = chosen[donor] >= 0
    bins = int(into.max()) + 1
    broken = np.zeros(bins, bool)
    broken[into[injected]] = True
    number = np.cumsum(~broken) - 1
    staying = ~broken[into]
    child = np.where(injected, chosen[donor], len(taken) + number[into])
    placed = injected | staying
    free = (size - np.bincount(child[placed], weights=lengths[placed],
                               minlength=len(taken) + int((~broken).sum()))).astype(int).tolist()
    displaced = np.flatnonzero(~placed)  # already by length, longest first
    best_fit(displaced.tolist(), as_list, child, free, size)
    return child


def evolve(lengths: np.ndarray, seeds: list[np.ndarray], size: int,
           random: np.random.Generator) -> np.ndarray:
    """The best of one island after an epoch. `lengths` descend; `seeds` are individuals."""
    as_list = lengths.tolist()
    population = list(seeds)
    while len(population) < POPULATION:
        noise = random.uniform(0.9, 1.1, len(lengths)) if population else 1.0
        individual, free = np.zeros(len(lengths), np.int64), []
        best_fit(np.argsort(-lengths * noise, kind="stable").tolist(), as_list, individual, free, size)
        population.append(individual)
    ranked = sorted(((fitness(p, lengths, size), n, p) for n, p in enumerate(population)))
    least = -(-int(lengths.sum()) // size)
    for turn in range(OFFSPRING):
        if ranked[0][0][0] <= least:
            break
        first, second = random.choice(len(ranked), 2, replace=False)
        child = crossover(ranked[first][2], ranked[second][2], lengths, as_list, size, random)
        ranked = sorted([*ranked, (fitness(child, lengths, size), POPULATION + turn, child)])[:POPULATION]
    return ranked[0][2]


def _epoch(epoch: int, size: int):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        block, island = key
        rows = rows.sort_values(["length", "uid"], ascending=[False, True], kind="stable")
        own = rows[rows["origin"] == 0]
        lengths = own["length"].to_numpy()
        seeds = [part["bin"].to_numpy() for _, part in rows.groupby("origin")] if epoch else []
        best = evolve(lengths, seeds, size, np.random.default_rng([epoch, island, block]))
        bins, squares = fitness(best, lengths, size)
        return pd.DataFrame({"block": block, "island": island, "uid": own["uid"], "length": lengths,
                             "bin": best, "bins": bins, "squares": squares})
    return run


def _round(items: DataFrame, size: int) -> DataFrame:
    """(uid, length, block, bin) of items (uid, length), each block by its best island."""
    blocks = -(-items.count() // BLOCK)
    if not blocks:
        return items.select("uid", "length", F.lit(0).cast("long").alias("block"),
                            F.lit(0).cast("long").alias("bin"))
    dealt = (items.withColumn("block", F.pmod(F.xxhash64("uid"), F.lit(blocks)))
             .withColumn("island", F.explode(F.array(*map(F.lit, range(ISLANDS)))))
             .withColumn("bin", F.lit(0).cast("long")).withColumn("origin", F.lit(0)))
    best = None
    for epoch in range(EPOCHS):
        if best is not None:
            native = best.select("block", "island", "uid", "length", "bin", F.lit(0).alias("origin"))
            migrant = best.select("block", ((F.col("island") + 1) % ISLANDS).alias("island"), "uid",
                                  "length", "bin", F.lit(1).alias("origin"))
            dealt = native.unionByName(migrant)
        best = staged(dealt.groupBy("block", "island").applyInPandas(_epoch(epoch, size), _PACKED))
    winner = (best.groupBy("block").agg(F.min(F.struct("bins", "squares", "island")).alias("best"))
              .select("block", F.col("best.island").alias("island")))
    return best.join(winner, ["block", "island"]).select("uid", "length", "block", "bin")


def pack(items: DataFrame, size: int = SIZE) -> DataFrame:
    """uid, sequence_id and offset of items (uid, length) with lengths from 1 to `size`."""
    whole = items.filter(F.col("length") == size).select(
        "uid", (-F.col("uid") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    first = staged(_round(items.filter(F.col("length") < size).select("uid", "length"), size))
    filled = first.groupBy("block", "bin").agg(F.sum("length").alias("filled"))
    marked = first.join(filled, ["block", "bin"]).withColumn("well", F.col("filled") >= WELL_FILLED * size)
    again = _round(staged(marked.filter(~F.col("well")).select("uid", "length")), size)
    packed = (marked.filter("well").select("uid", "length", "block", "bin", F.lit(0).alias("round"))
              .unionByName(again.select("uid", "length", "block", "bin", F.lit(1).alias("round"))))
    # A block has fewer than 2 ** 24 bins.
    numbered = packed.select("uid", "length", F.expr(
        "shiftleft(block, 25) | shiftleft(bin, 1) | round").alias("sequence_id"))
    return numbered.groupBy("sequence_id").agg(
        F.sort_array(F.collect_list(F.struct("length", "uid")), asc=False).alias("held")).select(
        "sequence_id", F.posexplode("held").alias("place", "item"), "held").select(
        F.col("item.uid").alias("uid"), "sequence_id",
        F.expr("aggregate(slice(held, 1, place), 0L, (a, x) -> a + x.length)").alias("offset")
    ).unionByName(whole.select("uid", "sequence_id", "offset"))


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 0, size: int = SIZE) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = staged(document_pieces(docs, tokenizer, end_id, size)
                    .withColumn("uid", F.monotonically_increasing_id()))
    return pieces.join(pack(pieces.select("uid", "length"), size), "uid").drop("uid")

"""Best-fit packing of token pieces by a grouping genetic algorithm on islands."""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faremeld.llm.common import settle, table
from faremeld.llm.word_ids import WordIds

CAPACITY = 2048
#: Pieces that one island packs, islands for each block, and their steps.
BLOCK_ITEMS, ISLANDS, POPULATION, GENERATIONS, EPOCHS = 8192, 2, 4, 4, 2

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, capacity: int = CAPACITY, end_id: int = 0, vocabulary: str | None = None) -> DataFrame:
    """One row per piece of every text (null: empty): its ids and `end_id`, cut after `capacity` ids."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, end = WordIds(vocabulary), int(end_id).to_bytes(4, "little")
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                ids = words.encode(text or "") + end
                total = len(ids) // 4
                for piece, start in enumerate(range(0, total, capacity)):
                    part = ids[4 * start : 4 * (start + capacity)]
                    rows.append((doc_id, piece, start, len(part) // 4, zlib.crc32(part)))
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(cut, PIECES)


# ---- one block: assignments are arrays that give each item's bin


def best_fit(order: list[int], sizes: list[int], assign: np.ndarray, rooms: list[tuple[int, int]], capacity: int, fresh: int) -> None:
    """Puts the items, in this order, where the least room is left; `rooms`: sorted (room, bin)."""
    for item in order:
        size = sizes[item]
        at = bisect_left(rooms, (size, -1))
        if at < len(rooms):
            room, number = rooms.pop(at)
        else:
            room, number, fresh = capacity, fresh, fresh + 1
        assign[item] = number
        if room > size:
            insort(rooms, (room - size, number))


def fills(assign: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return np.bincount(assign, weights=sizes).astype(np.int64)


def compact(assign: np.ndarray) -> np.ndarray:
    return np.unique(assign, return_inverse=True)[1].astype(np.int32)


def fitness(assign: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[int, float]:
    """Fewer bins first, then unevenly filled ones, which leave room for more."""
    full = fills(assign, sizes)
    return len(full), -float(np.mean((full / capacity) ** 2))


def seeded(sizes: np.ndarray, capacity: int, noise: float, rng: np.random.Generator) -> np.ndarray:
    """Best fit over sizes that fall, up to some noise."""
    order = np.argsort(-sizes * (1 + noise * rng.random(len(sizes))), kind="stable")
    assign = np.zeros(len(sizes), np.int32)
    best_fit(order.tolist(), sizes.tolist(), assign, [], capacity, 0)
    return assign


def crossover(host: np.ndarray, donor: np.ndarray, sizes: np.ndarray, capacity: int, rng: np.random.Generator) -> np.ndarray:
    """Whole well-filled bins of the donor enter the host; the host's bins that
    hold any of their items go, and the items so displaced are best-fitted."""
    full = fills(donor, sizes)
    good = np.flatnonzero(full >= np.quantile(full, 0.5))
    chosen = np.zeros(len(full), bool)
    chosen[rng.choice(good, max(1, len(good) // 3), replace=False)] = True
    injected = chosen[donor]
    broken = np.zeros(host.max() + 1, bool)
    broken[host[injected]] = True
    child = host.copy()
    child[injected] = donor[injected] + host.max() + 1
    displaced = np.flatnonzero(broken[host] & ~injected)
    room = capacity - fills(host, sizes)
    rooms = sorted((int(room[b]), int(b)) for b in np.flatnonzero(~broken & (room > 0)))
    injected_room = capacity - full
    first = int(host.max()) + 1
    rooms += [(int(injected_room[b]), first + int(b)) for b in np.flatnonzero(chosen & (injected_room > 0))]
    rooms.sort()
    order = displaced[np.argsort(-sizes[displaced], kind="stable")].tolist()
    best_fit(order, sizes.tolist(), child, rooms, capacity, first + len(full))
    return compact(child)


def evolve(population: list[np.ndarray], sizes: np.ndarray, capacity: int, generations: int, keep: int, seed: list[int]) -> list[np.ndarray]:
    rng = np.random.default_rng(seed)
    least = -(-int(sizes.sum()) // capacity)
    ranked = sorted(population, key=lambda x: fitness(x, sizes, capacity))[:keep]
    for _ in range(generations):
        if len(ranked) < 2 or fitness(ranked[0], sizes, capacity)[0] == least:
            break
        mates = rng.permutation(len(ranked))
        born = [crossover(ranked[i], ranked[j], sizes, capacity, rng) for i, j in zip(mates[::2], mates[1::2])]
        ranked = sorted([*ranked, *born], key=lambda x: fitness(x, sizes, capacity))[:keep]
    return ranked


STATE = "block long, island int, units binary, sizes binary, population binary, bins long"


def _state(block: int, island: int, units: np.ndarray, sizes: np.ndarray, population: list[np.ndarray], capacity: int) -> dict:
    return {"block": block, "island": island, "units": units.tobytes(), "sizes": sizes.astype(np.int32).tobytes(), "population": np.concatenate(population).astype(np.int32).tobytes(), "bins": fitness(population[0], sizes, capacity)[0]}


def pack(
    items: DataFrame,
    capacity: int = CAPACITY,
    block_items: int = BLOCK_ITEMS,
    islands: int = ISLANDS,
    population: int = POPULATION,
    generations: int = GENERATIONS,
    epochs: int = EPOCHS,
) -> DataFrame:
    """(unit, sequence_id, offset) for items (unit, length), lengths from 1 to `capacity`.

    Items are dealt by a hash to blocks of about `block_items`, whose number
    grows with the input. Each block has islands that evolve its packing; after
    each epoch every island takes its neighbour's best. A block wastes at most
    about one sequence. Items of full length are sequences by themselves.
    Equal lengths are taken in the order of their units.
    """
    whole = items.where(F.col("length") == capacity).select("unit", (-1 - F.col("unit")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = items.where(F.col("length") < capacity).select("unit", "length")
    blocks = max(1, -(-rest.count() // block_items))

    def found(block_rows: pd.DataFrame) -> pd.DataFrame:
        block_rows = block_rows.sort_values(["length", "unit"], ascending=[False, True])
        units, sizes = block_rows["unit"].to_numpy(np.int64), block_rows["length"].to_numpy(np.int64)
        block, out = int(block_rows["block"].iloc[0]), []
        for island in range(islands):
            rng = np.random.default_rng(block * islands + island)
            start = [seeded(sizes, capacity, (0.0 if i == 0 else 0.04 * (i + island)), rng) for i in range(population)]
            out.append(_state(block, island, units, sizes, start, capacity))
        return pd.DataFrame(out)

    def step(epoch: int):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                out = []
                for row in batch.itertuples(index=False):
                    sizes = np.frombuffer(row.sizes, np.int32).astype(np.int64)
                    members = list(np.frombuffer(row.population, np.int32).reshape(-1, len(sizes)))
                    if row.guest is not None:
                        members.append(np.frombuffer(row.guest, np.int32))
                    members = evolve(members, sizes, capacity, generations, population, seed=[row.block, row.island, epoch])
                    out.append(_state(row.block, row.island, np.frombuffer(row.units, np.int64), sizes, members, capacity))
                yield pd.DataFrame(out, columns=["block", "island", "units", "sizes", "population", "bins"])

        return run

    state = rest.withColumn("block", F.pmod(F.xxhash64("unit"), F.lit(blocks))).groupBy("block").applyInPandas(found, STATE)
    for epoch in range(epochs):
        if epoch:
            elite = F.expr("substring(population, 1, length(sizes))").alias("guest")
            guests = state.select("block", F.pmod(F.col("island") + 1, F.lit(islands)).alias("island"), elite)
            state = state.join(guests, ["block", "island"], "left")
        else:
            state = state.withColumn("guest", F.lit(None).cast("binary"))
        state = settle(state.mapInPandas(step(epoch), STATE))

    best = state.groupBy("block").agg(F.min_by(F.struct("units", "sizes", "population"), F.struct("bins", "island")).alias("best")).select("block", "best.*")

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                sizes = np.frombuffer(row.sizes, np.int32).astype(np.int64)
                assign = np.frombuffer(row.population, np.int32)[: len(sizes)]
                order = np.argsort(assign, kind="stable")
                bins, ends = assign[order], np.cumsum(sizes[order])
                starts = ends - sizes[order]
                first = np.r_[True, bins[1:] != bins[:-1]]
                offset = starts - np.maximum.accumulate(np.where(first, starts, 0))
                yield pd.DataFrame({"unit": np.frombuffer(row.units, np.int64)[order], "sequence_id": row.block * (1 << 32) + bins.astype(np.int64), "offset": offset})

    return best.mapInPandas(placed, "unit long, sequence_id long, offset long").union(whole)


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None, **settings) -> DataFrame:
    """Every piece of every document with its place in a sequence of at most `capacity` ids.

    Null or empty text is the end id alone. Repeated rows are packed each for
    itself. An empty table gives an empty table; other columns are not read.
    """
    pieces = settle(token_pieces(docs, capacity, vocabulary=vocabulary).withColumn("unit", F.monotonically_increasing_id()))
    return pieces.join(pack(pieces, capacity, **settings), "unit").drop("unit")


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))

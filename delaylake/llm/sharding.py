"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix.

Rows lie in blocks (a hash of the row decides, so a re-run task finds the same block). The driver draws how many rows
of each block go to each cell of each shard, as a uniform shuffle of all rows would deal them: row by row of the matrix, each
entry hypergeometric. Then the rows of a block are ranked by a keyed hash (the local permutation), the
ranks are cut by the block's row of the matrix, rows travel to their cells, and are ranked there by another hash (the second
permutation). Cells have exact sizes, so the slots of a shard have no gaps.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from delaylake.llm.shared import col, free_name, hashable

MOST_BLOCKS = 2048
MOST_CELLS = 512


def hypergeometric(rng: np.random.Generator, good: int, bad: int, drawn: int) -> int:
    """One draw: how many of `drawn` items, taken without replacement, are among the good ones. Populations of any size."""
    low, high = max(0, drawn - bad), min(good, drawn)
    if low == high:
        return low
    total = good + bad
    mean = drawn * good / total
    spread = (mean * (bad / total) * (total - drawn) / max(1, total - 1)) ** 0.5
    # Beyond 40 deviations the mass is under the resolution of a double.
    low, high = max(low, int(mean - 40 * spread) - 40), min(high, int(mean + 40 * spread) + 40)
    k = np.arange(low, high, dtype=np.float64)
    steps = np.log(good - k) + np.log(drawn - k) - np.log(k + 1) - np.log(bad - drawn + k + 1)
    mass = np.concatenate([[0.0], np.cumsum(steps)])
    mass = np.cumsum(np.exp(mass - mass.max()))
    return low + int(np.searchsorted(mass, rng.random() * mass[-1], side="right").clip(0, high - low))


def communication_matrix(block_rows: list[int], cell_rows: list[int], seed: int) -> list[list[int]]:
    """Rows of each block for each cell: row sums are block_rows, column sums are cell_rows, both exact."""
    rng = np.random.default_rng(seed)
    left, matrix = list(cell_rows), []
    for rows in block_rows:
        rest, out = sum(left), []
        for k, free in enumerate(left):
            out.append(hypergeometric(rng, free, rest - free, rows) if rows else 0)
            rest, rows = rest - free, rows - out[-1]
            left[k] = free - out[-1]
        matrix.append(out)
    return matrix


def even(total: int, parts: int) -> list[int]:
    """Sizes at most one apart."""
    return [total // parts + (k < total % parts) for k in range(parts)]


def shard(docs: DataFrame, n_shards: int, seed: int = 1, most_blocks: int = MOST_BLOCKS, most_cells: int = MOST_CELLS) -> DataFrame:
    """All rows, each with its shard (int, 0 to n_shards - 1) and slot (long, gapless from 0 in its shard).

    Shard sizes are at most one row apart. Every row takes part: nulls, empty texts and repeated rows are rows like others (rows equal
    in all columns may trade places). An empty table gives an empty result. A clashing input column named shard or slot
    is replaced. The result depends on the rows and the seed alone, not on their order or partitions.

    The driver holds the matrix, blocks times cells. Blocks grow with the root of the row count up to most_blocks, the
    cells likewise up to most_cells (or one for each shard); beyond that, blocks and cells get longer and their sorts spill.
    """
    if n_shards < 1:
        raise ValueError("n_shards must be positive")
    docs = docs.drop(*[c for c in docs.columns if c.lower() in ("shard", "slot")])
    total = docs.count()
    n_blocks = min(most_blocks, 1 + int(total**0.5 / 8))
    block, rank, upto, spot, key = (free_name(docs, n) for n in ("block", "rank", "upto", "cell", "order"))
    named = hashable(docs) or [F.lit(0)]
    placed = docs.withColumn(block, F.pmod(F.xxhash64(F.lit(seed), *named), F.lit(n_blocks)).cast("int"))
    found = {r[0]: r[1] for r in placed.groupBy(col(block)).count().collect()}
    block_rows = [found.get(b, 0) for b in range(n_blocks)]

    shard_rows = even(sum(block_rows), n_shards)
    cells = max(1, min(n_blocks, most_cells) // n_shards)
    cell_rows = [n for rows in shard_rows for n in even(rows, cells)]
    starts = [sum(even(rows, cells)[:k]) for rows in shard_rows for k in range(cells)]
    matrix = communication_matrix(block_rows, cell_rows, seed)
    bounds = docs.sparkSession.createDataFrame(
        [(b, [int(x) for x in np.cumsum(row)]) for b, row in enumerate(matrix)], f"`{block}` int, `{upto}` array<long>"
    )

    first = W.partitionBy(col(block)).orderBy(F.xxhash64(F.lit(seed + 1), *named), *named)
    ranked = placed.withColumn(rank, F.row_number().over(first))
    dealt = ranked.join(bounds, block).withColumn(spot, F.size(F.filter(col(upto), lambda x: x < col(rank))))
    second = W.partitionBy(col(spot)).orderBy(F.xxhash64(F.lit(seed + 2), *named), *named)
    start = F.element_at(F.array(*[F.lit(int(s)).cast("long") for s in starts]), col(spot) + 1)
    return (
        dealt.drop(block, rank, upto)
        .withColumn(key, F.row_number().over(second))
        .withColumn("shard", (col(spot) / cells).cast("int"))
        .withColumn("slot", start + col(key) - 1)
        .drop(spot, key)
    )

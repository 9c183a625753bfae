"""Hard negatives of vectors: exact search in an inverted multi-index, block by block."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terraloom.session import checkpointed

#: Codewords of each half space, and rows that they are fitted on at most: those with the smallest hashes.
CODES, SAMPLE_ROWS = 16, 4096
ROUNDS = 8
#: Components of a block of rows, and of a block of anchors; and rows of a block at least where there are more tasks than such blocks.
BLOCK_VALUES, LEAST_ROWS = 1 << 22, 1024
#: Components are whole numbers below this; a sum of products of up to 2^14 of them is a long.
LIMIT = 1 << 24
#: Rows that are scored together as cells are visited.
TOGETHER = 512


def whole_vectors(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", scale: int = 256) -> DataFrame:
    """(row, id, label, x): x is floor(scale * component), label is moved on by one where 7 divides the id.

    Rows with a null id, label or vector, with a null or non-finite component, or with one beyond LIMIT take no part."""
    x = F.transform(vector_col, lambda v: F.floor(F.lit(float(scale)) * v.cast("double")))
    usable = F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.forall(vector_col, lambda v: v.isNotNull() & (F.abs(v.cast("double")) < float(LIMIT) / scale))
    kept = table.where(F.coalesce(usable, F.lit(False)))
    label = F.when(F.col(id_col) % 7 == 0, (F.col(label_col) + 1) % 10).otherwise(F.col(label_col))
    return kept.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), x.cast("array<int>").alias("x"))


def matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Vectors as rows; missing components are 0."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.array(flat.value_lengths().fill_null(0), np.int64)
    out = np.zeros((len(sizes), width))
    out[np.arange(width) < sizes[:, None]] = np.array(flat.flatten())
    return out


def codebook(x: np.ndarray, codes: int = CODES, rounds: int = ROUNDS) -> np.ndarray:
    """Codewords by Lloyd's rounds. They begin at distinct rows, each as far from those before it as can be."""
    if not len(x):
        return np.zeros((1, x.shape[1]))
    chosen = [x[0]]
    far = ((x - x[0]) ** 2).sum(1)
    while len(chosen) < codes and far.max() > 0:
        chosen.append(x[int(far.argmax())])
        far = np.minimum(far, ((x - chosen[-1]) ** 2).sum(1))
    book = np.array(chosen)
    for _ in range(rounds):
        near = nearest(x, book)
        n = np.bincount(near, minlength=len(book))
        sums = np.zeros_like(book)
        np.add.at(sums, near, x)
        book[n > 0] = sums[n > 0] / n[n > 0, None]
    return book


def nearest(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    return ((book**2).sum(1) - 2 * (x @ book.T)).argmin(1)


class MultiIndex:
    """The rows of a block by cells: pairs of a codeword of the first half and one of the second.

    What a row of a cell can score with a query is at most the sum of two half scores: query and codeword, and the
    query's length times the codeword's radius in this block (the farthest of its rows).
    """

    def __init__(self, x: np.ndarray, books: tuple[np.ndarray, np.ndarray]) -> None:
        self.half, self.books = x.shape[1] // 2, books
        parts = x[:, : self.half], x[:, self.half :]
        codes = [nearest(p, b) for p, b in zip(parts, books, strict=True)]
        self.radii = [np.zeros(len(b)) for b in books]
        for r, p, b, c in zip(self.radii, parts, books, codes, strict=True):
            np.maximum.at(r, c, np.sqrt(((p - b[c]) ** 2).sum(1)))
        cell = codes[0] * len(books[1]) + codes[1]
        self.order = np.argsort(cell, kind="stable")
        self.starts = np.searchsorted(cell[self.order], np.arange(len(books[0]) * len(books[1]) + 1))
        self.largest = float(np.abs(x).max(initial=0)) * x.shape[1]
        self.x = x[self.order]

    def scores(self, query: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Inner products. Sums of products below 2^53 are exact as doubles; others are done in whole numbers."""
        part = self.x[places]
        if self.largest * float(np.abs(query).max(initial=0)) < 2**53:
            return (part @ query).astype(np.int64)
        return part.astype(np.int64) @ query.astype(np.int64)

    def visits(self, query: np.ndarray) -> Iterator[tuple[float, np.ndarray]]:
        """(bound, places) of the cells that have rows, the highest bound first: a heap over the two sequences of half scores,
        each in falling order; a pair comes after the pairs that are better in both."""
        halves = query[: self.half], query[self.half :]
        bounds = [b @ h + np.sqrt(h @ h) * r for b, h, r in zip(self.books, halves, self.radii, strict=True)]
        slack = 1e-6 + 1e-9 * max(float(np.abs(b).max()) for b in bounds)
        first, second = (np.argsort(-b, kind="stable") for b in bounds)
        u, v = bounds[0][first].tolist(), bounds[1][second].tolist()
        heap, wide = [(-u[0] - v[0], 0, 0)], len(v)
        while heap:
            bound, i, j = heapq.heappop(heap)
            cell = int(first[i]) * wide + int(second[j])
            a, b = self.starts[cell], self.starts[cell + 1]
            if b > a:
                yield slack - bound, np.arange(a, b)
            if j + 1 < wide:
                heapq.heappush(heap, (-u[i] - v[j + 1], i, j + 1))
            if j == 0 and i + 1 < len(u):
                heapq.heappush(heap, (-u[i + 1] - v[0], i + 1, 0))

    def search(self, query: np.ndarray, usable: np.ndarray, ids: np.ndarray, windows: list[tuple[int | None, int | None]], most: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Of each window (least and highest score, None: open): the places and scores of the first `most` usable rows, higher scores
        first, smaller ids first among equals. Cells are visited until each window is certified: its rows are `most` and
        no cell that is left can reach the last one's score, or none can reach the window."""
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in windows]
        reach = [-np.inf if low is None else low for low, _ in windows]
        held: list[np.ndarray] = []

        def take() -> None:
            at = np.concatenate(held) if held else np.zeros(0, np.int64)
            held.clear()
            at = at[usable[at]]
            score = self.scores(query, at)
            for w, (_, high) in enumerate(windows):
                inside = score >= reach[w]
                if high is not None:
                    inside &= score <= high
                if inside.any():
                    p, s = np.concatenate([found[w][0], at[inside]]), np.concatenate([found[w][1], score[inside]])
                    pick = np.lexsort((ids[p], -s))[:most]
                    found[w] = p[pick], s[pick]
                    if len(pick) == most:
                        reach[w] = max(reach[w], int(s[pick[-1]]))

        n = 0
        for bound, places in self.visits(query):
            if n >= TOGETHER:
                take()
                n = 0
            if all(bound < r for r in reach):
                break
            held.append(places)
            n += len(places)
        take()
        return found


def _first(order: list[Column], by: list[str], most: int, rows: DataFrame, name: str) -> DataFrame:
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col(name) <= most)


def blocks_of(vectors: DataFrame, anchors: DataFrame) -> tuple[int, int]:
    """How many blocks of rows and of anchors there are: as many as bound a task's memory, and rows enough for all tasks."""
    n, width = vectors.agg(F.count("*"), F.max(F.size("x"))).head()
    width = max(width or 1, 1)
    tasks = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    up = lambda a, b: max(1, -(-a // b))
    return max(up(n * width, BLOCK_VALUES), min(tasks, up(n, LEAST_ROWS))), up(anchors.count() * width, BLOCK_VALUES)


def searched(vectors: DataFrame, anchors: DataFrame, books: tuple[np.ndarray, np.ndarray], width: int, blocks: tuple[int, int], positives: bool, most: int) -> DataFrame:
    """(anchor_row, anchor_id, wanted, row, id, score): of each anchor and block of rows the first rows that match. With `positives`
    those of the anchor's label, else those of other labels, for each score in `wanted` in the window that it sets.

    Rows meet anchors in blocks that are dealt by hash, so neither a label nor a vector decides what a task gets."""
    rows = vectors.withColumn("b", F.pmod(F.xxhash64("row"), F.lit(blocks[0]))).withColumn("q", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks[1] - 1).cast("long"))))
    asked = anchors.withColumn("q", F.pmod(F.xxhash64("anchor_row", "anchor_id"), F.lit(blocks[1]))).withColumn("b", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks[0] - 1).cast("long"))))

    def search(block: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[list] = [[] for _ in range(6)]
        if block.num_rows and queries.num_rows:
            index = MultiIndex(matrix(block["x"], width), books)
            row, ids, label = (np.array(block[c])[index.order] for c in ("row", "id", "label"))
            for query, a, a_id, a_label, wanted in zip(matrix(queries["anchor_x"], width), *(queries[f"anchor_{c}"].to_pylist() for c in ("row", "id", "label")), queries["wanted"].to_pylist(), strict=True):
                # The least and highest score s with 30 w <= 100 s <= 90 w; none if w is below 0.
                windows = [(None, None)] if positives else [(-(-30 * w // 100), 90 * w // 100) for w in wanted]
                usable = (label == a_label) & (row != a) if positives else label != a_label
                for w, (places, scores) in zip(wanted, index.search(query, usable, ids, windows, most), strict=True):
                    for column, values in zip(out, ([a] * len(places), [a_id] * len(places), [w] * len(places), row[places].tolist(), ids[places].tolist(), scores.tolist()), strict=True):
                        column += values
        return pa.table([pa.array(c, pa.int64()) for c in out], names=["anchor_row", "anchor_id", "wanted", "row", "id", "score"])

    return rows.groupBy("b", "q").cogroup(asked.groupBy("b", "q")).applyInArrow(search, "anchor_row long, anchor_id long, wanted long, row long, id long, score long")


def mine(table: DataFrame, every: int = 100, n_positives: int = 5, n_negatives: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): hard negatives of the rows whose id `every` divides.

    Which rows take part, and their scores' terms, are in `whole_vectors`; vectors of different lengths count as if zeros
    followed. Higher scores come first, then smaller ids, then earlier rows. Repeated ids are rows each for itself; of a
    repeated anchor all rows have their results, and one may be a positive of the other. An anchor without another row of
    its label, or whose windows are empty (a positive's score below 0 has an empty one), has no rows. An empty table: no
    rows. Extra columns are not read.

    The search is exact. Codebooks are fitted on at most SAMPLE_ROWS rows; all rows are indexed, in blocks of bounded
    size, and meet the anchors in blocks. The work is that of anchors times rows, less what the bounds save.
    """
    vectors = checkpointed(whole_vectors(table, id_col, vector_col, label_col))
    anchors = vectors.where(F.col("id") % every == 0).toDF("anchor_row", "anchor_id", "anchor_label", "anchor_x")
    width = max(vectors.agg(F.max(F.size("x"))).head()[0] or 1, 1)
    sample = vectors.orderBy(F.xxhash64("id", "x"), "row").limit(SAMPLE_ROWS).select("x").toArrow()
    x = matrix(sample["x"], width)
    books = codebook(x[:, : width // 2]), codebook(x[:, width // 2 :])
    blocks = blocks_of(vectors, anchors)
    order = [F.desc("score"), F.asc("id"), F.asc("row")]
    none = F.array(F.lit(0).cast("long"))
    near = searched(vectors, anchors.withColumn("wanted", none), books, width, blocks, True, n_positives)
    positives = checkpointed(_first(order, ["anchor_row"], n_positives, near, "k"))
    wanted = positives.groupBy("anchor_row").agg(F.array_sort(F.collect_set("score")).alias("wanted"))
    far = searched(vectors, anchors.join(wanted, "anchor_row"), books, width, blocks, False, n_negatives)
    negatives = _first(order, ["anchor_row", "wanted"], n_negatives, far, "rank").select("anchor_row", "wanted", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    pairs = positives.select("anchor_row", "anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("wanted"))
    return pairs.join(negatives, ["anchor_row", "wanted"]).select("anchor_id", "positive_id", "rank", "negative_id", F.col("wanted").alias("positive_score"), "negative_score")

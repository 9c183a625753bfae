"""SimHash near-duplicates, joined through anchor points of a covering code."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terraloom.llm.frames import map_texts, text_or_empty
from terraloom.operators.components import connected_components
from terraloom.session import checkpointed, unused

SHINGLE, SEED, DISTANCE = 4, 42, 4

#: Three bands of bits, each of stretches (first bit, bits): of four differing bits, one band at least has no more than one.
BANDS = (((0, 21),), ((21, 21),), ((42, 22),))
#: Ten bands, the pairs of five stretches: of four differing bits, two stretches at least have no more than one together.
#: Four times as many rows, but sixteen to thirty-two times as many anchors: for more than some 10^8 different fingerprints,
#: where BANDS' anchors, whose number does not grow, would be crowded. The links are the same.
_STRETCHES = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))
FINE_BANDS = tuple((a, b) for i, a in enumerate(_STRETCHES) for b in _STRETCHES[i + 1 :])
#: In a band the low 15 bits are covered by the Hamming code of length 15, of radius 1; the others stand as they are.
COVERED = 15
#: An anchor with more rows is dealt out in pairs of parts of about this many rows.
PART_ROWS = 8192
#: Pairs compared in one numpy step.
STEP_PAIRS = 1_000_000

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def fingerprint(text: str) -> int:
    """The text's 64 bits, unsigned; 0 if it has no word."""
    words = text.encode("utf-8", "replace").translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - SHINGLE + 1)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate([[0], ends[:-1]])[:n].tolist()
    stops = (ends[-n:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, stops, strict=True)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, 65536):
        part = h[i : i + 65536]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", also: tuple[str, ...] = ()) -> DataFrame:
    """(id, also, fp): fp is the fingerprint's bits as a long. Null text counts as empty."""
    columns = [id_col, *also]

    def work(frame: pd.DataFrame) -> pd.DataFrame:
        fp = np.array([fingerprint(t) for t in frame[given]], np.uint64).view(np.int64)
        return pd.DataFrame({"fp": fp})

    given = unused(docs.select(*columns), "text")
    return map_texts(docs.select(*columns, text_or_empty(text_col).alias(given)), columns, work, "fp long", given)


#: Parts that a class is dealt to where its name is joined to its fingerprints.
SPREAD = 16
#: A fingerprint with more than one in so many rows is hot. There are fewer hot ones than this number, at any size.
HOT_SHARE = 1000


def classes_of(distinct: DataFrame, distance: int, bands: tuple = BANDS) -> DataFrame:
    """(fp, first, component): the rows of `distinct` (one a fingerprint) that are linked to others, with the smallest
    fingerprint of their class."""
    return distinct.join(connected_components(link_fingerprints(distinct, distance, bands)).select(F.col("node").alias("fp"), "component"), "fp")


def _syndrome(x: np.ndarray) -> np.ndarray:
    """Of 15-bit words: the sum of the positions (1 to 15) of their set bits, bit by bit."""
    s = np.zeros_like(x)
    for i in range(COVERED):
        s ^= np.where(x >> i & 1, i + 1, 0)
    return s


def _errors() -> tuple[np.ndarray, np.ndarray]:
    """By syndrome: the patterns of at most two bits that lead to a codeword, the shortest first, and which are real."""
    found: list[list[int]] = [[] for _ in range(16)]
    singles = [1 << i for i in range(COVERED)]
    for e in [0, *singles, *(a | b for i, a in enumerate(singles) for b in singles[:i])]:
        found[int(_syndrome(np.array([e]))[0])].append(e)
    width = max(map(len, found))
    real = np.array([[k < len(f) for k in range(width)] for f in found])
    return np.array([f + f[:1] * (width - len(f)) for f in found]), real


def anchor_rows(fp: np.ndarray, bands: tuple = BANDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, fp, home) for every anchor that a fingerprint goes to. Its home is the codeword that covers it; it is
    replicated to every anchor within the covering radius plus one, counted on the covered bits and the others apart:
    two fingerprints that differ in one bit of a band meet at the home of either."""
    errors, real = _errors()
    keys, fps, homes = [], [], []
    for band, stretches in enumerate(bands):
        x, bits = np.zeros(len(fp), np.int64), 0
        for shift, n in stretches:
            x |= ((fp.view(np.uint64) >> np.uint64(shift)).astype(np.int64) & ((1 << n) - 1)) << bits
            bits += n
        low, high = x & ((1 << COVERED) - 1), x >> COVERED
        s = _syndrome(low)
        near = (high[:, None] << COVERED) | (low[:, None] ^ errors[s])
        mask = real[s]
        flips = (high[:, None] ^ (1 << np.arange(bits - COVERED))) << COVERED | (low ^ errors[s, 0])[:, None]
        key = np.concatenate([near, flips], 1)
        mask = np.concatenate([mask, np.ones(flips.shape, bool)], 1)
        home = np.zeros(key.shape, bool)
        home[:, 0] = True
        keys.append((key | (band << 32))[mask])
        fps.append(np.broadcast_to(fp[:, None], key.shape)[mask])
        homes.append(home[mask])
    return np.concatenate(keys), np.concatenate(fps), np.concatenate(homes)


class _Forest:
    """Smallest-label classes of the rows of one batch."""

    def __init__(self, n: int) -> None:
        self.label = np.arange(n)

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        label = self.label
        while True:
            a, b = label[i], label[j]
            if (a == b).all():
                return
            low = np.minimum(a, b)
            np.minimum.at(label, a, low)
            np.minimum.at(label, b, low)
            while not (label == label[label]).all():
                label[:] = label[label]


def links_of_sorted(group: np.ndarray, fp: np.ndarray, home: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that span the classes inside each group of rows; equal values of `group` stand together."""
    n = len(fp)
    start = np.concatenate([[0], np.flatnonzero((group[1:] != group[:-1]).any(1)) + 1]) if n else np.zeros(0, int)
    size = np.diff(np.concatenate([start, [n]]))
    of = np.repeat(np.arange(len(start)), size)
    mine = np.flatnonzero(home & (size[of] > 1))
    forest = _Forest(n)
    cost = np.cumsum(size[of[mine]])
    at = 0
    while at < len(mine):
        to = max(at + 1, int(np.searchsorted(cost, (cost[at - 1] if at else 0) + STEP_PAIRS, "right")))
        h = mine[at:to]
        width = size[of[h]]
        left = np.repeat(h, width)
        right = np.arange(int(width.sum())) - np.repeat(np.cumsum(width) - width, width) + np.repeat(start[of[h]], width)
        hit = np.bitwise_count((fp[left] ^ fp[right]).view(np.uint64)) <= distance
        forest.link(left[hit], right[hit])
        at = to
    linked = np.flatnonzero((forest.label != np.arange(n)) & (fp != fp[forest.label]))
    return fp[linked], fp[forest.label[linked]]


def link_fingerprints(distinct: DataFrame, distance: int = DISTANCE, bands: tuple = BANDS) -> DataFrame:
    """(src, dst): links that join the same classes as all pairs of different `fp` at `distance` or fewer bits."""

    def spread(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            key, fp, home = anchor_rows(frame["fp"].to_numpy(), bands)
            yield pd.DataFrame({"anchor": key, "fp": fp, "home": home})

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for frame in frames:
            held = frame if held is None else pd.concat([held, frame], ignore_index=True)
            group = held[["anchor", "a", "b"]].to_numpy()
            same = int((group == group[-1]).all(1).argmax())
            if same:
                src, dst = links_of_sorted(group[:same], held["fp"].to_numpy()[:same], held["home"].to_numpy()[:same], distance)
                held = held.iloc[same:].reset_index(drop=True)
                yield pd.DataFrame({"src": src, "dst": dst})
        if held is not None:
            src, dst = links_of_sorted(held[["anchor", "a", "b"]].to_numpy(), held["fp"].to_numpy(), held["home"].to_numpy(), distance)
            yield pd.DataFrame({"src": src, "dst": dst})

    rows = distinct.select("fp").mapInPandas(spread, "anchor long, fp long, home boolean")
    # Never more than a PART_ROWS-th of the rows; with BANDS never more than the code has anchors (3 * 2^18), and the planner
    # broadcasts it where it is small.
    parts = rows.groupBy("anchor").count().where(F.col("count") > PART_ROWS).select("anchor", F.ceil(F.col("count") / PART_ROWS).cast("int").alias("parts"))
    mine = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    dealt = (
        rows.join(F.broadcast(parts) if bands is BANDS else parts, "anchor", "left")
        .withColumn("mine", F.when(F.col("parts").isNull(), F.lit(0)).otherwise(mine))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("parts"), F.lit(1)) - 1)))
        .select("anchor", F.least("mine", "other").alias("a"), F.greatest("mine", "other").alias("b"), "fp", "home")
    )
    return dealt.repartition("anchor", "a", "b").sortWithinPartitions("anchor", "a", "b").mapInPandas(compare, "src long, dst long")


def near_duplicates(docs: DataFrame, distance: int = DISTANCE, id_col: str = "doc_id", text_col: str = "text", bands: tuple = BANDS) -> DataFrame:
    """(id, fingerprint, component_id) of every document; component_id is the smallest id reachable over links.

    Bands: 64 bits cannot be covered whole at a bearable cost, so three bands share the threshold and each has a
    covering code of its own (`anchor_rows`); the full fingerprints are compared at each anchor. Equal fingerprints are
    one row before any anchor is made, so copies cost nothing. A crowded anchor is dealt out in pairs of parts, and a
    task emits links that span its classes, never all pairs. Null and empty texts have fingerprint zero and link like
    any other. Repeated rows stay repeated. An empty table: no rows. Only id and text are read.

    The rows of hot fingerprints (`HOT_SHARE`) get their class by a broadcast and stay where they are, so copies of one
    text never meet in one task, however many there are.
    """
    each = checkpointed(fingerprints(docs, id_col, text_col))
    distinct = each.groupBy("fp").agg(F.min(id_col).alias("first"), F.count("*").alias("n"))
    linked = checkpointed(classes_of(distinct, distance, bands).withColumn("salt", F.pmod("fp", F.lit(SPREAD))))
    smallest = linked.groupBy("component").agg(F.min("first").alias("component_id")).withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SPREAD - 1).cast("long"))))
    named = linked.join(smallest, ["component", "salt"]).select("fp", "component_id")
    by_fp = distinct.join(named, "fp", "left").select("fp", F.coalesce("component_id", "first").alias("component_id"), "n")
    hot = checkpointed(by_fp.where(F.col("n") * HOT_SHARE > each.count()).drop("n"))
    rest = each.join(F.broadcast(hot.select("fp")), "fp", "left_anti").join(by_fp.drop("n"), "fp")
    both = each.join(F.broadcast(hot), "fp").unionByName(rest)
    return both.select(id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, distance: int = DISTANCE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without near copies: exactly one row of each class stays, with all columns. It is the one with the
    smallest id (a null id comes last), of rows with that id the one whose key is smallest, of rows with that key one.

    A row's key is a digest of its id and text, so a null or repeated id neither loses a document nor keeps two. Rows
    with one key are reduced before the shuffle (window group limit), and the rows are shuffled once, by the key.
    """
    part = lambda c: F.coalesce(F.concat(F.lit("="), c), F.lit("null"))
    key = F.sha2(F.concat(part(F.col(id_col).cast("string")), F.lit("\n"), part(F.col(text_col))), 256)
    others = [c for c in docs.columns if c not in (id_col, text_col)]
    by, rank = unused(docs, "key"), unused(docs, "rank")
    order = Window.partitionBy(by).orderBy(F.xxhash64(*others) if others else F.lit(0))
    keyed = docs.withColumn(by, key)
    given = docs.select(key.alias("key"), F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    each = checkpointed(fingerprints(given, "key", "text", ("id",)))
    first = F.min(F.struct(F.col("id").isNull().alias("none"), F.col("id").cast(docs.schema[id_col].dataType).alias("id"), F.col("key").alias("key")))
    distinct = each.groupBy("fp").agg(first.alias("first"))
    linked = checkpointed(classes_of(distinct, distance).select("fp", "first", "component"))
    smallest = linked.groupBy("component").agg(F.min("first").alias("first"))
    alone = distinct.join(linked.select("fp"), "fp", "left_anti")
    keep = smallest.select("first").union(alone.select("first")).select(F.col("first.key").alias(by))
    single = keyed.withColumn(rank, F.row_number().over(order)).where(F.col(rank) == 1).drop(rank)
    return single.join(keep, by, "left_semi").select(*docs.columns)

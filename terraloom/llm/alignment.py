"""Alignment of two tokenizers' tokens of one text: groups between common ends, found by merging along the path."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator
from hashlib import sha256
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from terraloom.llm.frames import Numbered, by_bytes, kept, text_or_empty
from terraloom.session import checkpointed, shared_dir, unused
from terraloom.sinks.publish import remove

#: Ends of A and B that a piece of the merge has together.
WORK = 1 << 16
#: Token pairs that are written out at once; a group with more is counted by its distinct tokens.
PAIRS = 1 << 20
#: Bytes that a Python worker's table of distinct segments may take; when it is full it starts anew. And what an entry takes
#: besides its characters.
MEMORY, ENTRY = 112 << 20, 500
#: Rows of pair counts that are broadcast at most; beyond, the documents' pairs are joined with them by pair and salt.
BROADCAST_ROWS = 1_000_000
SPREAD = 16
BLANK = "▁"
#: Stretches of a text that both tokenizers cut at: each begins with a blank or line end that stands alone between others.
SEGMENT = re.compile(r"\s*\S+(?:(?![ \n]\S)\s+\S*)*|\s+")


def byte_values() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1 for itself, the rest from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return {chr(b if b in shown else next(spare)): b for b in range(256)}


def path_cuts(a: np.ndarray, b: np.ndarray, work: int = WORK) -> tuple[np.ndarray, np.ndarray]:
    """Where the merge of two rising sequences is cut into pieces of `work` steps: how many of a and of b come before each cut.
    All cuts are searched together, each along its diagonal; equal values of a come before those of b."""
    n, m = len(a), len(b)
    d = np.minimum(np.arange(0, n + m + work, work), n + m)
    low, high = np.maximum(0, d - m), np.minimum(d, n)
    while (open_ := low < high).any():
        mid = (low + high) // 2
        before = np.zeros(len(d), bool)
        before[open_] = a[mid[open_]] <= b[(d - mid - 1)[open_]]
        low, high = np.where(open_ & before, mid + 1, low), np.where(open_ & ~before, mid, high)
    return low, d - low


def common_ends(a: np.ndarray, b: np.ndarray, work: int = WORK) -> tuple[np.ndarray, np.ndarray]:
    """(how many of a, how many of b) end at or before each end that both have.

    Pieces between cuts are done each by itself; a piece looks at one value before its own, as a pair of equal ends may be
    cut apart. The places found are stitched by their order, so a group may span pieces."""
    at_a, at_b = path_cuts(a, b, work)
    found_a, found_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for i, i_to, j, j_to in zip(at_a, at_a[1:], at_b, at_b[1:], strict=False):
        part = b[j:j_to]
        upto = i + np.searchsorted(a[i:i_to], part, "right")
        hit = (upto > 0) & (a[np.maximum(upto, 1) - 1] == part) if len(a) else np.zeros(len(part), bool)
        found_a.append(upto[hit])
        found_b.append(j + np.flatnonzero(hit) + 1)
    return np.concatenate(found_a), np.concatenate(found_b)


def spread(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For stretches of these sizes, laid end to end: (the stretch of each place, its place in the stretch)."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def summed(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each key once, with the sum of its times."""
    order = np.argsort(keys, kind="stable")
    keys, times = keys[order], times[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(times, first) if len(first) else times


class Aligner:
    """Both tokenizers of a worker, and what is known of distinct segments of text."""

    def __init__(self, path_a: str, path_b: str) -> None:
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a task a core
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        value = byte_values()
        entries = sorted((i, s) for s, i in self.a.get_vocab(with_added_tokens=True).items())
        self.bytes_a = [b""] * (entries[-1][0] + 1)
        for i, s in entries:
            self.bytes_a[i] = bytes(value[c] for c in s) if all(c in value for c in s) else s.encode()
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(BLANK, " ").encode() for i, p in enumerate(pieces)]
        self.blank = self.b.piece_to_id(BLANK)
        if any(BLANK in p.lstrip(BLANK) or "\n" in p for i, p in enumerate(pieces) if not (self.b.is_control(i) or self.b.is_unknown(i))):
            raise ValueError("a model with pieces over blanks or line ends can't be cut at them")
        self.width = len(self.bytes_b)
        self.names = [str(i) for i in range(max(len(self.bytes_a), self.width))]
        self.size_a, self.size_b = (np.array(list(map(len, t)), np.int64) for t in (self.bytes_a, self.bytes_b))
        self.reset()

    def reset(self) -> None:
        self.index = Numbered()
        self.held = 0
        self.groups: list[str] = []
        #: Of each segment: tokens of A and of B, groups, links, and 1 if the tokens spell the segment.
        self.facts = np.zeros((0, 5), np.int64)
        self.pairs, self.times, self.ends = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(1, np.int64)

    def tokens_of_b(self, segments: list[str]) -> list[list[int]]:
        """The model puts a blank before what it encodes: it stands for a segment's own, or goes where that is a line end."""
        found = self.b.encode([s[1:] if s[0] == " " else s for s in segments], num_threads=1)
        return [f if s[0] == " " else f[1:] if f[:1] == [self.blank] else [] for s, f in zip(segments, found, strict=True)]

    def spelled(self, segments: list[str], *tokens: list[list[int]]) -> list[bool]:
        """Whether both tokens spell each segment. Mostly all do, which one comparison of all bytes and of all lengths shows."""
        given = list(map(str.encode, segments))
        sizes, whole = np.fromiter(map(len, given), np.int64, len(given)), b"".join(given)
        for ids, table, width in zip(tokens, (self.bytes_a, self.bytes_b), (self.size_a, self.size_b), strict=True):
            flat = np.fromiter(chain.from_iterable(ids), np.int64)
            ends = np.concatenate([[0], np.cumsum(width[flat])])[np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)))]
            if not np.array_equal(np.diff(ends, prepend=0), sizes) or b"".join(map(table.__getitem__, flat.tolist())) != whole:
                a, b = ([b"".join(map(t.__getitem__, x)) for x in ids] for ids, t in zip(tokens, (self.bytes_a, self.bytes_b), strict=True))
                return [x == s == y for s, x, y in zip(given, a, b, strict=True)]
        return [True] * len(segments)

    def learn(self, segments: list[str]) -> None:
        """Segments that the index has just numbered, in the order of their numbers."""
        tokens = [e.ids for e in self.a.encode_batch_fast(segments, add_special_tokens=False)], self.tokens_of_b(segments)
        spelled = self.spelled(segments, *tokens)
        a, b = (np.fromiter(chain.from_iterable(t for t, ok in zip(ids, spelled, strict=True) if ok), np.int64) for ids in tokens)
        counts = np.array([[len(x), len(y)] if ok else [0, 0] for x, y, ok in zip(*tokens, spelled, strict=True)], np.int64).reshape(-1, 2)
        to_a, to_b = common_ends(np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b]))
        from_a, from_b = np.concatenate([[0], to_a[:-1]]), np.concatenate([[0], to_b[:-1]])
        owner = np.searchsorted(np.cumsum(counts[:, 0]), to_a)
        product = (to_a - from_a) * (to_b - from_b)
        names_a, names_b = (list(map(self.names.__getitem__, t.tolist())) for t in (a, b))
        lines: list[list[str]] = [[] for _ in segments]
        for k, i, i_to, j, j_to in zip(*(x.tolist() for x in (owner, from_a, to_a, from_b, to_b)), strict=True):
            lines[k].append(f"{','.join(names_a[i:i_to])}|{','.join(names_b[j:j_to])}")
        # Pairs of all groups but very large ones, written out a bounded number at a time.
        keys, times = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        usual = np.flatnonzero(product <= PAIRS)
        cuts = np.searchsorted(np.cumsum(product[usual]), np.arange(1, product[usual].sum() // PAIRS + 2) * PAIRS, "right")
        for part in np.split(usual, np.unique(cuts)):
            g, place = spread(product[part])
            g = part[g]
            i, j = np.divmod(place, (to_b - from_b)[g])
            found = summed((owner[g] * len(self.bytes_a) + a[from_a[g] + i]) * self.width + b[from_b[g] + j], np.ones(len(g), np.int64))
            keys.append(found[0])
            times.append(found[1])
        for g in np.flatnonzero(product > PAIRS).tolist():
            (x, nx), (y, ny) = (np.unique(t, return_counts=True) for t in (a[from_a[g] : to_a[g]], b[from_b[g] : to_b[g]]))
            keys.append(((owner[g] * len(self.bytes_a) + x)[:, None] * self.width + y).ravel())
            times.append((nx[:, None] * ny).ravel())
        key, time = summed(np.concatenate(keys), np.concatenate(times))
        each = len(self.bytes_a) * self.width
        number = np.bincount(key // each, minlength=len(segments))
        self.groups += map(";".join, lines)
        sums = np.zeros((2, len(segments)), np.int64)
        np.add.at(sums[0], owner, 1)
        np.add.at(sums[1], owner, product)
        self.facts = np.concatenate([self.facts, np.column_stack([counts, *sums, np.array(spelled, np.int64)])])
        self.pairs, self.times = np.concatenate([self.pairs, key % each]), np.concatenate([self.times, time])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(number)])
        self.held += len(segments) * ENTRY + 4 * sum(map(len, segments)) + 16 * len(key)

    def documents(self, texts: list[str]) -> dict[str, list]:
        """Of each text: n_a, n_b, n_groups, n_links, groups_sha256, and the distinct linked pairs with how often each is linked."""
        if self.held > MEMORY:
            self.reset()
        cut = [SEGMENT.findall(f" {t}") if t else [] for t in texts]
        number = np.fromiter(map(len, cut), np.int64, len(cut))
        at = np.fromiter(map(self.index.__getitem__, chain.from_iterable(cut)), np.int64, int(number.sum()))
        known = len(self.groups)
        if len(self.index) > known:
            self.learn(list(islice(self.index, known, None)))
        doc = np.repeat(np.arange(len(cut)), number)
        bad = np.zeros(len(cut), bool)
        bad[doc[self.facts[at, 4] == 0]] = True
        good = ~bad[doc]
        facts = np.zeros((len(cut), 4), np.int64)
        np.add.at(facts, doc[good], self.facts[at[good], :4])
        ends = np.cumsum(number)
        shas = ["" if bad[k] or not n else sha256(";".join(map(self.groups.__getitem__, at[to - n : to].tolist())).encode()).hexdigest() for k, (n, to) in enumerate(zip(number.tolist(), ends.tolist(), strict=True))]
        # Distinct segments of each text first, then their pairs.
        seg, times = np.unique(doc[good] * len(self.groups) + at[good], return_counts=True)
        doc, seg = np.divmod(seg, max(1, len(self.groups)))
        sizes = self.ends[seg + 1] - self.ends[seg]
        k, place = spread(sizes)
        pick = self.ends[seg[k]] + place
        each = len(self.bytes_a) * self.width
        keys, linked = summed(doc[k] * each + self.pairs[pick], times[k] * self.times[pick])
        offsets = np.concatenate([[0], np.cumsum(np.bincount(keys // each, minlength=len(cut)))]).astype(np.int32)
        lists = lambda x: pa.ListArray.from_arrays(pa.array(offsets), pa.array(x))
        return dict(zip(("n_a", "n_b", "n_groups", "n_links"), map(pa.array, facts.T.copy()), strict=True)) | {"groups_sha256": pa.array(shas, pa.string()), "pairs": lists(keys % each), "times": lists(linked)}


def aligned(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, line, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times) of every whole text. `line` numbers the rows; a pair of
    identifiers is a * (entries of B) + b, and `times` says how often each is linked in the text. Nothing is shuffled.

    Null and empty texts, and texts that the tokens do not spell (they hold B's own blank sign), have no tokens."""
    given = unused(docs.select(id_col), "text")
    added = StructType.fromDDL("line long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<long>")
    made = StructType([docs.schema[id_col], *added.fields])
    arrow = to_arrow_schema(added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        line = TaskContext.get().partitionId() << 36
        for batch in by_bytes(batches, given):
            aligner = kept(("alignment", path_a, path_b), lambda: Aligner(path_a, path_b))
            found = aligner.documents(batch.column(given).to_pylist()) | {"line": pa.array(range(line, line + batch.num_rows), pa.int64())}
            line += batch.num_rows
            yield pa.RecordBatch.from_arrays([batch.column(id_col), *(found[f.name].cast(f.type) for f in arrow)], names=[id_col, *arrow.names])

    return docs.select(id_col, text_or_empty(text_col).alias(given)).mapInArrow(run, made)


def pair_counts(lines: DataFrame, width: int) -> DataFrame:
    """(pair, count, best): how many texts hold each pair linked, and whether that is the highest of its A identifier. Pairs are
    counted before they are shuffled; there are no more groups by A than entries."""
    counts = checkpointed(lines.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("count")))
    entry = F.floor(F.col("pair") / width).cast("long")
    highest = counts.groupBy(entry.alias("a")).agg(F.max("count").alias("highest"))
    return counts.withColumn("a", entry).join(highest, "a").select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every text, by a byte-level tokenizer A of space and
    text and a piece model B of the text.

    Texts without tokens (see `aligned`) have zeros and an empty string. Ties for the highest count are all best. Very
    long texts are taken whole; a group of many tokens is counted by its distinct ones. Repeated rows count and stay
    each for itself, null ids too; extra columns are not read. An empty table: no rows. Both files must exist on the
    driver and on every worker.

    Each text is encoded once; its distinct pairs go to a table in the shared folder, which is removed at the end. The
    pairs' counts are broadcast behind a check of their number; beyond it the pairs are joined with them, salted, as a
    pair may be in every text.
    """
    import sentencepiece

    width = sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
    spark = docs.sparkSession
    path = f"{shared_dir(spark)}/aligned-{uuid.uuid4().hex[:12]}"
    aligned(docs, path_a, path_b, id_col, text_col).write.parquet(path)
    lines = spark.read.parquet(path)
    counts = checkpointed(pair_counts(lines, width))
    each = lines.select("line", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("line", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))
    if counts.count() <= BROADCAST_ROWS:
        joined = each.join(F.broadcast(counts), "pair")
    else:
        copies = counts.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SPREAD - 1).cast("long"))))
        joined = each.withColumn("salt", F.pmod(F.col("line"), F.lit(SPREAD))).join(copies, ["pair", "salt"])
    sums = joined.groupBy("line").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("count")).alias("count_sum"))
    facts = lines.select(id_col, "line", "n_a", "n_b", "n_groups", "n_links", "groups_sha256").join(sums, "line", "left")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    out = checkpointed(facts.select(id_col, "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256"))
    remove(spark, path)
    return out

"""Bounded-space online packing of token sequences into windows of fixed length."""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from terraloom.llm.frames import Numbered, by_bytes, kept, text_or_empty
from terraloom.session import unused

WINDOW = 4096
OPEN_WINDOWS = 8

#: How the vocabulary's own splitter cuts Latin-1 text in lower case; line ends stand between runs. Its white
#: space is spelled out, as Python's \s has U+001C to U+001F besides.
SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\t-\r \x85\xa0\p{L}\p{N}]+|\n")
#: The same for text of ASCII alone, for which the plain module is faster.
SPLIT_ASCII = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\t-\r a-z0-9]+|\n")
#: What the vocabulary does not spell as itself.
UNSHOWN = re.compile("[^!-~]")
#: The end of a vocabulary entry that ends a word.
WORD_END = "</w>"

#: Bytes that a Python worker's table of distinct runs may take; when it is full it starts anew.
MEMORY = 96 << 20
#: What an entry of the table takes besides its characters and identifiers.
ENTRY = 150
#: New words that go to the tokenizer in one piece.
PIECE_WORDS = 4096


class RunIds:
    """Token identifiers of whole texts, by way of the runs between blanks.

    The vocabulary drops white space, so the identifiers of a text are those of its runs, one after the other. All runs
    of a batch that are not known are cut into the splitter's words in one pass; distinct words go to the vocabulary's
    merges together, as byte symbols with blanks between them, and the word ends among the identifiers tell them apart.
    Runs with special tokens or with characters beyond Latin-1, which the tokenizer may normalise, go to it whole.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer, pre_tokenizers

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a task a core
        self.tokenizer = Tokenizer.from_file(path)
        self.merges = Tokenizer(self.tokenizer.model)
        self.merges.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.ends_word = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.ends_word[[i for s, i in self.merges.get_vocab(with_added_tokens=False).items() if s.endswith(WORD_END)]] = True
        self.symbols = byte_symbols()
        self.reset()

    def reset(self) -> None:
        self.index = Numbered()
        self.size = 0
        self.flat = np.zeros(0, np.uint32)
        #: Where each run's identifiers begin, and how many they are.
        self.first, self.length = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def ids_of_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(all identifiers, the end of each word among them)."""
        shown = words
        if UNSHOWN.search("".join(words)):
            shown = [w if w.isascii() and w.isprintable() else w.encode("utf-8").decode("latin-1").translate(self.symbols) for w in words]
        parts = [np.array(self.merges.encode(" ".join(shown[i : i + PIECE_WORDS]), add_special_tokens=False).ids, np.uint32) for i in range(0, len(shown), PIECE_WORDS)]
        ids = np.concatenate([np.zeros(0, np.uint32), *parts])
        return ids, np.flatnonzero(self.ends_word[ids]) + 1

    def plain_runs(self, runs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(all identifiers, the end of each run) of runs of Latin-1 characters."""
        text = b"\n".join(runs).decode("utf-8").lower()
        tokens = (SPLIT_ASCII if text.isascii() else SPLIT).findall(text)
        words = Numbered({"\n": 0})
        at = np.fromiter(map(words.__getitem__, tokens), np.int64, len(tokens)) - 1
        ids, ends = self.ids_of_words(list(words)[1:])
        stops = np.flatnonzero(at < 0)
        first, length = np.concatenate([[0], ends])[at], np.where(at < 0, 0, np.diff(ends, prepend=0)[at] if len(ends) else 0)
        to = np.cumsum(length)
        return gather(ids, first, length, to), np.concatenate([to[stops], [len_of(to)]])

    def learn(self, runs: list[bytes]) -> None:
        """Runs that the index has just numbered, in the order of their numbers."""
        kinds: tuple[list[int], ...] = [], [], []  # ASCII, the rest of Latin-1, and what goes to the tokenizer whole
        special = b"<|" in b"\n".join(runs)
        for k, run in enumerate(runs):
            if special and b"<|" in run:
                kinds[2].append(k)
            elif run.isascii():
                kinds[0].append(k)
            else:
                kinds[2 if max(run.decode("utf-8")) > "\xff" else 1].append(k)
        before, first, length = len(self.flat), np.zeros(len(runs), np.int64), np.zeros(len(runs), np.int64)
        parts = [self.flat]
        for kind, places in enumerate(kinds):
            if not places:
                continue
            some = [runs[k] for k in places]
            if kind < 2:
                ids, ends = self.plain_runs(some)
            else:
                found = [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast([r.decode("utf-8") for r in some], add_special_tokens=False)]
                ids, ends = np.concatenate(found), np.cumsum([len(f) for f in found])
            first[places], length[places] = before + np.concatenate([[0], ends[:-1]]), np.diff(ends, prepend=0)
            parts.append(ids)
            before += len(ids)
        self.size += sum(map(len, runs)) + len(runs) * ENTRY + 4 * (before - len(self.flat))
        self.flat = np.concatenate(parts)
        self.first, self.length = np.concatenate([self.first, first]), np.concatenate([self.length, length])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(all identifiers, the end of each text among them)."""
        if self.size > MEMORY:
            self.reset()
        runs = [t.encode("utf-8", "replace").split() for t in texts]
        known = len(self.first)
        counts = np.fromiter(map(len, runs), np.int64, len(runs))
        at = np.fromiter(map(self.index.__getitem__, chain.from_iterable(runs)), np.int64, int(counts.sum()))
        if len(self.index) > known:
            self.learn(list(islice(self.index, known, None)))
        first, length = self.first[at], self.length[at]
        to = np.cumsum(length)
        last = np.cumsum(counts)
        return gather(self.flat, first, length, to), np.where(last > 0, np.concatenate([[0], to])[last], 0)


def len_of(to: np.ndarray) -> int:
    return int(to[-1]) if len(to) else 0


def gather(flat: np.ndarray, first: np.ndarray, length: np.ndarray, to: np.ndarray) -> np.ndarray:
    """The stretches of `flat` that start at `first`, one after the other; `to` is the running sum of their lengths."""
    total = len_of(to)
    return flat[np.arange(total) + np.repeat(first - (to - length), length)] if total else np.zeros(0, np.uint32)


def byte_symbols() -> dict[int, str]:
    """The printable stand-in of each byte: printable Latin-1 stands for itself, the rest follow from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return {b: chr(b if b in shown else next(spare)) for b in range(256)}


def encoder(path: str) -> RunIds:
    return kept(("packing", path), lambda: RunIds(path))


class Packer:
    """Fills windows as documents come by, holding at most `open_windows` unfinished ones.

    A document longer than a window first fills whole windows of its own. What is left goes into the open window that
    it fits most tightly, else into a new one; when none fits and no more may be opened, it is cut to fill the fullest
    window, which is emitted, and the rest goes on. At the end the unfinished windows are poured together, fullest
    first; the very last one is cut into lengths that are powers of two, which need no padding.
    """

    def __init__(self, first_sequence: int, size: int = WINDOW, open_windows: int = OPEN_WINDOWS) -> None:
        self.size, self.most, self.next = size, open_windows, first_sequence
        self.open: list[list] = []  # [tokens, pieces]; a piece is (doc_id, start, ids, tokens of the document)
        self.rows: list[tuple] = []

    def emit(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc, start, ids, total in pieces:
            self.rows.append((doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total, self.next, offset))
            offset += len(ids)
        self.next += 1

    def put(self, window: list, piece: tuple) -> None:
        window[0] += len(piece[2])
        window[1].append(piece)
        if window[0] == self.size:
            self.emit(window[1])
            self.open = [w for w in self.open if w is not window]

    def add(self, doc: int, ids: np.ndarray) -> None:
        start, total = 0, len(ids)
        while total - start >= self.size:
            self.emit([(doc, start, ids[start : start + self.size], total)])
            start += self.size
        while start < total:
            rest = total - start
            fits = [w for w in self.open if self.size - w[0] >= rest]
            if fits:
                window = max(fits, key=lambda w: w[0])
            elif len(self.open) < self.most:
                self.open.append(window := [0, []])
            else:
                window = max(self.open, key=lambda w: w[0])
            n = min(rest, self.size - window[0])
            self.put(window, (doc, start, ids[start : start + n], total))
            start += n

    def finish(self) -> None:
        pieces = [p for w in sorted(self.open, key=lambda w: -w[0]) for p in w[1]]
        self.open = []
        left = sum(len(p[2]) for p in pieces)
        while left:
            length = self.size if left >= self.size else 1 << (left.bit_length() - 1)
            row, room = [], length
            while room:
                doc, start, ids, total = pieces.pop(0)
                n = min(room, len(ids))
                row.append((doc, start, ids[:n], total))
                if n < len(ids):
                    pieces.insert(0, (doc, start + n, ids[n:], total))
                room -= n
            self.emit(row)
            left -= length


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 2, size: int = WINDOW, open_windows: int = OPEN_WINDOWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Each partition packs what it reads, in one pass and with `open_windows` windows in memory; nothing is shuffled.
    Null or empty text: the end identifier alone. Equal texts and repeated rows are packed each for itself. An empty
    table: no rows. Sequence numbers hold the partition's number, so they are unique and the same if a task is repeated.
    The file named by `tokenizer_path` must exist on every worker.
    """

    given = unused(docs.select(id_col), "text")
    made = StructType([docs.schema[id_col], *StructType.fromDDL("start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long").fields])
    arrow = to_arrow_schema(made)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*packer.rows, strict=True), arrow, strict=True)], schema=arrow)
            packer.rows = []
            return out

        packer = Packer(TaskContext.get().partitionId() << 36, size, open_windows)
        end = np.array([end_id], np.uint32)
        for batch in by_bytes(batches, given):
            ids, ends = encoder(tokenizer_path).encode(batch.column(given).to_pylist())
            begin = 0
            for doc, to in zip(batch.column(id_col).to_pylist(), ends.tolist(), strict=True):
                packer.add(doc, np.concatenate([ids[begin:to], end]))
                begin = to
            if packer.rows:
                yield rows()
        packer.finish()
        if packer.rows:
            yield rows()

    return docs.select(id_col, text_or_empty(text_col).alias(given)).mapInArrow(run, made)

"""SentencePiece encoding and decoding: batched merges by score for a byte-pair model, a batched Viterbi for others."""

from __future__ import annotations

import heapq
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import StringType, StructField, StructType

from terraloom.llm.frames import kept, map_texts, text_or_empty
from terraloom.session import unused

#: Bytes that a Python worker's table of distinct words may take; when it is full it starts anew. And what an entry takes
#: besides its characters and pieces.
MEMORY = 64 << 20
ENTRY = 190
#: Words of one length that advance together.
TOGETHER = 20_000
#: Words longer than this are merged one by one with a heap: a search of the whole word at each merge is quadratic.
LONG = 256
BLANK = "▁"
_UNITS = regex.compile(r" *[^ \n]+| +|\n")
_STEP = np.uint64(0x9E3779B97F4A7C15)


class PieceModel:
    """The pieces of a model file with their scores, sorted by a hash of their characters."""

    def __init__(self, path: str) -> None:
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        spec = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            spec.ParseFromString(f.read())
        self.by_merges = spec.trainer_spec.model_type == spec.trainer_spec.BPE
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        self.bytes = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if sp.is_byte(i)}
        self.unknown = sp.unk_id()
        usable = [i for i in range(len(self.pieces)) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.longest = max(len(self.pieces[i]) for i in usable)
        keys = np.array([self.hash_of(self.pieces[i]) for i in usable], np.uint64)
        order = np.argsort(keys)
        self.keys = keys[order]
        self.ids = np.array(usable)[order]
        # Scores as the file has them; each piece also costs a step, so that fewer pieces win over better ranks.
        scores = np.array([sp.get_score(i) for i in usable])[order]
        # The place of each score among all, best first; equal scores share a place.
        self.places = np.unique(-scores, return_inverse=True)[1].astype(np.int32)
        self.never = np.int32(len(scores))
        self.scores = scores / (1 + abs(scores).max()) - 1.0
        self.fallback = -10.0
        self.known = {self.pieces[i]: i for i in usable}
        self.place_of = {self.pieces[i]: int(p) for i, p in zip(self.ids.tolist(), self.places.tolist(), strict=True)}
        self.reset()

    def reset(self) -> None:
        self.index: dict[str, int] = {}
        self.flat, self.ends, self.size = array("i"), array("q", [0]), 0

    @staticmethod
    def hash_of(s: str) -> int:
        h = 0
        for c in s:
            h = (h * int(_STEP) + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
        return h

    def best_paths(self, words: list[str]) -> list[list[int]]:
        """Pieces of words of one length: position by position, every length of last piece is tried for all words at
        once; a substring's hash is looked up among the sorted keys, and the best predecessor is kept."""
        m, n = len(words), len(words[0])
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(m, n).astype(np.uint64)
        best = np.full((m, n + 1), -np.inf)
        best[:, 0] = 0
        step = np.zeros((m, n + 1), np.int32)
        piece = np.full((m, n + 1), -1, np.int32)
        longest = min(self.longest, n)
        hashes = np.zeros((longest + 1, m), np.uint64)  # of the substrings that end here, by their length
        for end in range(1, n + 1):
            c = points[:, end - 1] + np.uint64(1)
            best[:, end] = best[:, end - 1] + self.fallback
            step[:, end] = 1
            hashes[1:] = hashes[:-1] * _STEP + c
            for k in range(1, min(longest, end) + 1):
                h = hashes[k]
                at = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
                found = self.keys[at] == h
                total = np.where(found, best[:, end - k] + self.scores[at], -np.inf)
                better = total > best[:, end]
                best[better, end] = total[better]
                step[better, end] = k
                piece[better, end] = self.ids[at[better]]
        out = []
        for i, word in enumerate(words):
            path: list[int] = []
            end = n
            while end:
                if piece[i, end] >= 0:
                    path.append(int(piece[i, end]))
                else:
                    raw = word[end - 1].encode("utf-8", "replace")
                    path += [self.bytes[b] for b in reversed(raw)] if self.bytes else [self.unknown]
                end -= step[i, end]
            out.append(path[::-1])
        return out

    def merged(self, words: list[str]) -> list[list[int]]:
        """Pieces of words of one length as the library merges them: of all neighbours whose join is a piece, the pair
        with the best score first, the leftmost of equal ones. The places of all substrings' scores are looked up once;
        then one merge a step is made in all words together."""
        m, n = len(words), len(words[0])
        if n > LONG:
            return [self.path_of(w, self.ends_of_long(w)) for w in words]
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(m, n).astype(np.uint64) + np.uint64(1)
        longest = min(self.longest, n)
        place = np.full((m, n + 1, longest + 1), self.never, np.int32)  # by first character and length
        h = np.zeros((m, n), np.uint64)
        for k in range(1, longest + 1):
            h = h[:, : n - k + 1] * _STEP + points[:, k - 1 :]
            at = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
            found = self.keys[at] == h
            place[:, : n - k + 1, k] = np.where(found, self.places[at], self.never)
        after = np.broadcast_to(np.minimum(np.arange(1, n + 2), n), (m, n + 1)).copy()
        before = np.broadcast_to(np.arange(-1, n), (m, n + 1)).copy()
        if n > 1:
            pair = place[:, :n, 2].copy()
            live = np.arange(m)
            while len(live):
                left = pair[live].argmin(1)
                some = pair[live, left] < self.never
                live, left = live[some], left[some]
                mid = after[live, left]
                end = after[live, mid]
                after[live, left] = end
                before[live, end] = left
                pair[live, mid] = self.never
                size = after[live, end] - left
                pair[live, left] = np.where((end < n) & (size <= longest), place[live, left, np.minimum(size, longest)], self.never)
                first = before[live, left]
                size = end - first
                was = np.maximum(first, 0)
                joined = np.where(size <= longest, place[live, was, np.minimum(size, longest)], self.never)
                pair[live, was] = np.where(first >= 0, joined, pair[live, was])
        return [self.path_of(word, after[i].tolist()) for i, word in enumerate(words)]

    def path_of(self, word: str, ends: list[int]) -> list[int]:
        """The pieces of a word whose piece at place i ends before ends[i]; a character that is no piece goes as its bytes."""
        path: list[int] = []
        at, n = 0, len(word)
        while at < n:
            end = ends[at]
            i = self.known.get(word[at:end], -1)
            if i >= 0:
                path.append(i)
            else:
                raw = word[at].encode("utf-8", "replace")
                path += [self.bytes[b] for b in raw] if self.bytes else [self.unknown]
            at = end
        return path

    def ends_of_long(self, word: str) -> list[int]:
        """The same merges of one long word, with a heap over a linked list: memory is linear in its length."""
        n, longest, place = len(word), self.longest, self.place_of.get
        follow, lead = [*range(1, n + 1)], [*range(-1, n)]
        heap = [(p, i, i + 2) for i in range(n - 1) if (p := place(word[i : i + 2])) is not None]
        heapq.heapify(heap)
        gone = bytearray(n + 1)
        while heap:
            _, left, end = heapq.heappop(heap)
            if gone[left] or follow[left] == n or follow[follow[left]] != end:
                continue
            gone[follow[left]] = 1
            follow[left], lead[end] = end, left
            for a, b in ((left, follow[end] if end < n else n + longest), (lead[left], end)):
                if a >= 0 and b - a <= longest and (p := place(word[a:b])) is not None:
                    heapq.heappush(heap, (p, a, b))
        return follow

    def learn(self, words: list[str]) -> None:
        by_length = defaultdict(list)
        for w in words:
            by_length[len(w)].append(w)
        for n, group in by_length.items():
            size = max(1, TOGETHER // max(1, n // 16))
            for at in range(0, len(group), size):
                part = group[at : at + size]
                for w, path in zip(part, self.merged(part) if self.by_merges else self.best_paths(part), strict=True):
                    self.flat.extend(path)
                    self.index[w] = len(self.ends) - 1
                    self.ends.append(len(self.flat))
                    self.size += ENTRY + len(w) + 4 * len(path)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Identifiers of each text: a blank goes before it, and blanks are part of the word after them."""
        if self.size > MEMORY:
            self.reset()
        units = [_UNITS.findall(" " + t.replace(BLANK, " ")) if t else [] for t in texts]
        units = [[u.replace(" ", BLANK) for u in unit] for unit in units]
        new = list(dict.fromkeys(u for unit in units for u in unit if u not in self.index))
        if new:
            self.learn(new)
        ends, flat = np.frombuffer(self.ends, np.int64), np.frombuffer(self.flat, np.int32)
        out = []
        for unit in units:
            at = np.fromiter(map(self.index.__getitem__, unit), np.int64, len(unit))
            size = ends[at + 1] - ends[at]
            to = np.cumsum(size)
            pick = np.arange(int(to[-1]) if len(to) else 0) + np.repeat(ends[at] - (to - size), size)
            out.append(flat[pick].astype(np.uint32))
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The text of identifiers; runs of byte pieces are read as UTF-8, and the blank before the text goes."""
        value = {i: b for b, i in self.bytes.items()}
        out, held = [], bytearray()
        for i in ids.tolist():
            if i in value:
                held.append(value[i])
                continue
            if held:
                out.append(held.decode("utf-8", "replace"))
                held = bytearray()
            out.append(self.pieces[i])
        if held:
            out.append(held.decode("utf-8", "replace"))
        text = "".join(out).replace(BLANK, " ")
        return text[1:] if text.startswith(" ") else text


def model(path: str) -> PieceModel:
    return kept(("piece_viterbi", path), lambda: PieceModel(path))


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids): the pieces of every whole text. Null or empty text: no pieces. Repeated rows stay repeated."""

    def work(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"ids": [a.astype(np.int32) for a in model(model_path).encode(list(frame[given]))]})

    given = unused(docs.select(id_col), "text")
    return map_texts(docs.select(id_col, text_or_empty(text_col).alias(given)), [id_col], work, "ids array<int>", given)


def decode(encoded: DataFrame, model_path: str, id_col: str = "doc_id") -> DataFrame:
    """(id, text) of `encode`'s rows; null identifiers: an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [model(model_path).decode(np.asarray(a)) if a is not None else "" for a in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(id_col), pa.array(texts, pa.string())], names=[id_col, "text"])

    return encoded.select(id_col, "ids").mapInArrow(run, StructType([encoded.schema[id_col], StructField("text", StringType())]))


def round_trips(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_pieces, ids_crc32, decoded_sha256, same): digests of every whole text's pieces and of their decoding, which
    is the text again (`same`), but for the model's own blank sign, which decodes as a space."""

    def work(frame: pd.DataFrame) -> pd.DataFrame:
        m, texts = model(model_path), list(frame[given])
        ids = m.encode(texts)
        back = [m.decode(a) for a in ids]
        return pd.DataFrame(
            {
                "n_pieces": [len(a) for a in ids],
                "ids_crc32": [zlib.crc32(a.astype("<u4").tobytes()) for a in ids],
                "decoded_sha256": [sha256(t.encode("utf-8", "replace")).hexdigest() for t in back],
                "same": [a == b for a, b in zip(texts, back, strict=True)],
            }
        )

    given = unused(docs.select(id_col), "text")
    return map_texts(docs.select(id_col, text_or_empty(text_col).alias(given)), [id_col], work, "n_pieces long, ids_crc32 long, decoded_sha256 string, same boolean", given)

"""Token counts of byte-level BPE by merging on a heap over a linked list."""

from __future__ import annotations

import heapq
import json
import re

import pandas as pd
import regex
from pyspark.sql import DataFrame

from terraloom.llm.frames import kept, map_texts, text_or_empty
from terraloom.session import unused

#: The splitting pattern of the byte-level vocabularies.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: White space beyond ASCII.
OTHER_BLANKS = re.compile("[\x85\xa0\u1680\u2000-\u200f\u2028-\u202f\u205f\u3000\ufeff]")

#: Bytes that a Python worker's tables of distinct words and of runs between blanks may take together; when they are full they
#: start anew. And what an entry takes besides its characters.
MEMORY = 192 << 20
ENTRY = 170


class Runs(dict):
    """What stands between two blanks -> its tokens; `before` is the blank that goes with it, or nothing. A run that is one word
    is held here alone, and not among the words too."""

    def __init__(self, owner: "MergeCounter", before: str) -> None:
        super().__init__()
        self.owner, self.before = owner, before

    def __missing__(self, run: str) -> int:
        owner = self.owner
        words = owner.words.findall(self.before + run)
        if len(words) == 1:
            n = owner.get(words[0]) or owner.merged(words[0].encode("utf-8", "surrogatepass"))
        else:
            n = sum(map(owner.__getitem__, words))
        owner.hold(run)
        self[run] = n
        return n


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte: printable Latin-1 stands for itself, the rest follow from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in shown else next(spare)) for b in range(256)]


class MergeCounter(dict):
    """Word -> number of tokens; a word that is not known yet is merged and remembered."""

    def __init__(self, path: str) -> None:
        super().__init__()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        ids = model["vocab"]
        self.rank = {ids[a] << 32 | ids[b]: k for k, (a, b) in enumerate(pairs)}
        self.made = [ids[a + b] for a, b in pairs]
        self.first = [ids[s] for s in byte_symbols()]
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.cut = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.words = regex.compile(SPLIT)
        self.after_blank, self.at_start = Runs(self, " "), Runs(self, "")
        self.size = 0

    def hold(self, key: str) -> None:
        """Room for one more entry; when there is none, all tables start anew."""
        self.size += ENTRY + len(key)
        if self.size > MEMORY:
            for table in (self, self.after_blank, self.at_start):
                table.clear()
            self.size = ENTRY + len(key)

    def __missing__(self, word: str) -> int:
        n = self.merged(word.encode("utf-8", "surrogatepass"))
        self.hold(word)
        self[word] = n
        return n

    def merged(self, data: bytes) -> int:
        """Initial symbols minus merges. The heap holds (rank, place) of adjacent pairs, packed in one integer, so equal
        ranks merge from left to right; an entry whose pair has another rank by now is stale and skipped."""
        n = len(data)
        if n < 2:
            return n
        rank, made, symbol = self.rank.get, self.made, [self.first[b] for b in data]
        heap = [r << 32 | i for i in range(n - 1) if (r := rank(symbol[i] << 32 | symbol[i + 1], -1)) >= 0]
        if not heap:
            return n
        heapq.heapify(heap)
        pop, push = heapq.heappop, heapq.heappush
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        merges = 0
        while heap:
            top = pop(heap)
            r, i = top >> 32, top & 0xFFFFFFFF
            j = after[i]
            if j < 0 or symbol[i] < 0 or rank(symbol[i] << 32 | symbol[j]) != r:
                continue
            merges += 1
            new = symbol[i] = made[r]
            symbol[j] = -1
            k = after[i] = after[j]
            if k >= 0:
                before[k] = i
                if (r := rank(new << 32 | symbol[k], -1)) >= 0:
                    push(heap, r << 32 | i)
            h = before[i]
            if h >= 0 and (r := rank(symbol[h] << 32 | new, -1)) >= 0:
                push(heap, r << 32 | h)
        return n - merges

    def split_and_count(self, text: str) -> int:
        return sum(map(self.__getitem__, self.words.findall(text)))

    def plain(self, text: str) -> int:
        """A text without special tokens. Where blanks and line ends stand alone and there is no other white space, the splitting pattern gives each line
        end a token of its own and each blank to the run after it, so runs can be counted one by one."""
        if not text.isascii() and OTHER_BLANKS.search(text) or any(c in text for c in "\r\t\x0b\x0c\x1c\x1d\x1e\x1f"):
            return self.split_and_count(text)
        if "  " in text or "\n\n" in text or " \n" in text or "\n " in text or text[:1] in ("", " ") or text[-1:] == " ":
            return self.split_and_count(text)
        n, rest, head = text.count("\n"), self.after_blank.__getitem__, self.at_start
        for line in text.split("\n"):
            if line:
                runs = line.split(" ")
                n += head[runs[0]]
                if len(runs) > 1:
                    del runs[0]
                    n += sum(map(rest, runs))
        return n

    def count(self, text: str) -> int:
        if self.cut and any(s in text for s in self.special):
            parts = self.cut.split(text)
            return len(parts) - 1 + sum(map(self.plain, parts))
        return self.plain(text)


def counter(path: str) -> MergeCounter:
    """One counter a Python worker and vocabulary, kept over tasks."""
    return kept(("token_counts", path), lambda: MergeCounter(path))


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every whole text; no identifiers are made.

    Null or empty text: 0 bytes, 0 tokens, not over the limit. Repeated rows stay repeated; extra columns are not read.
    A special token inside a text counts one, as the library has it by default. The file named by `tokenizer_path` is
    read where the work runs, so it must exist on every worker.
    """

    def work(frame: pd.DataFrame) -> pd.DataFrame:
        c = counter(tokenizer_path)
        n = [c.count(t) for t in frame[given]]
        out = pd.DataFrame({"n_bytes": [len(t.encode("utf-8", "surrogatepass")) for t in frame[given]], "n_tokens": n})
        return out.assign(over_limit=out["n_tokens"] > limit)

    given = unused(docs.select(id_col), "text")
    return map_texts(docs.select(id_col, text_or_empty(text_col).alias(given)), [id_col], work, "n_bytes long, n_tokens long, over_limit boolean", given)

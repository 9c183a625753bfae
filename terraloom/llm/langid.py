"""Language of whole texts: script ranges narrow the candidates, and Viterbi over word scores labels mixed spans."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terraloom.llm.frames import by_characters, crc32_mod, map_texts, text_or_empty
from terraloom.session import checkpointed, unused

#: Documents a language that training takes at most: those with the smallest id hashes.
TRAIN_ROWS = 500
#: Letter grams up to this length, hashed to so many rows.
GRAM, BUCKETS = 4, 1 << 16
#: What a change of language costs, and how much weight the grams of a word, which depend on each other, have.
SWITCH, WEIGHT = 6.0, 0.35
#: A language is a candidate for a script if so large a part of its letters is in it.
SCRIPT_SHARE = 0.02
#: Letters of a unit in scripts that are written without blanks.
PIECE = 6
#: How many times TRAIN_ROWS documents of a language are ranked to choose its training documents from.
OVERSAMPLE = 4
#: Languages whose numbers of documents are broadcast at most, so that only ranked documents are shuffled.
BROADCAST_ROWS = 100_000
#: Bytes that a task's table of distinct runs may take; when it is full it starts anew. And what an entry takes besides.
MEMORY = 64 << 20
ENTRY = 160

#: First code points of runs of letters and their scripts.
SCRIPTS = (
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"), (0x0600, "arabic"),
    (0x0780, "other"), (0x0900, "devanagari"), (0x0980, "indic"), (0x0E00, "thai"), (0x0E80, "other"), (0x10A0, "georgian"),
    (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"), (0x3040, "kana"),
    (0x3100, "other"), (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"), (0xD800, "other"), (0xF900, "han"), (0xFB00, "other"),
)
_FIRST = np.array([s[0] for s in SCRIPTS])
_NAMES = list(dict.fromkeys(s[1] for s in SCRIPTS))
_SCRIPT = np.array([_NAMES.index(s[1]) for s in SCRIPTS])
_UNSPACED = np.array([n in ("thai", "kana", "han", "other") for n in _NAMES])


def scripts_of(points: np.ndarray) -> np.ndarray:
    return _SCRIPT[np.searchsorted(_FIRST, points, "right") - 1]


def gram_rows(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(buckets of the grams of all words, the word of each); a word is framed by blanks."""
    text = "".join(f" {w} " for w in words)
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    sizes = np.array([len(w) + 2 for w in words], np.int64)
    owner = np.repeat(np.arange(len(words)), sizes)
    rolled = np.zeros(len(points), np.uint64)
    rows, owners = [], []
    for k in range(GRAM):
        at = len(points) - k
        if at <= 0:
            break
        rolled = rolled[:at] * np.uint64(0x9E3779B97F4A7C15) + points[k:] + np.uint64(k + 1)
        inside = owner[:at] == owner[k:]
        if k == 0:
            inside &= points != 32
        mixed = (rolled ^ (rolled >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        rows.append((mixed >> np.uint64(40))[inside].astype(np.int64) % BUCKETS)
        owners.append(owner[:at][inside])
    return np.concatenate(rows), np.concatenate(owners)


_LETTERS = regex.compile(r"\p{L}+")


def letters_of(run: str) -> str:
    """The letters of a run between blanks in lower case; signs and digits inside it become blanks."""
    return run.lower() if run.isalpha() else " ".join(_LETTERS.findall(run.lower()))


def points_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(code points of all words, the number of each word's)."""
    return np.frombuffer("".join(words).encode("utf-32-le", "replace"), np.uint32), np.array([len(w) for w in words], np.int64)


def units_of(runs: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(units, the script of each, the number of units of each run).

    A unit is the letters of a run in one script: a run is cut where its script changes, and in scripts that are written
    without blanks also after every PIECE letters, so that a language may change inside it.
    """
    words = [letters_of(r) for r in runs]
    counts = np.array([bool(w) for w in words], np.int64)
    full = [w for w in words if w]
    if not full:
        return [], np.zeros(0, np.int64), counts
    points, sizes = points_of(full)
    script = scripts_of(points)
    starts = np.cumsum(sizes) - sizes
    blank = points == 32
    low = np.minimum.reduceat(np.where(blank, 99, script), starts)
    high = np.maximum.reduceat(np.where(blank, -1, script), starts)
    mixed = (low != high) | (_UNSPACED[low] & (sizes > PIECE))
    if not mixed.any():
        return full, low, counts
    units: list[str] = []
    scripts: list[int] = []
    number = np.ones(len(full), np.int64)
    for i, word in enumerate(full):
        if not mixed[i]:
            units.append(word)
            scripts.append(int(low[i]))
            continue
        before = len(units)
        held, now = "", -1
        for c, k in zip(word, script[starts[i] : starts[i] + sizes[i]].tolist(), strict=True):
            if held and c != " " and (k != now or (_UNSPACED[k] and len(held) >= PIECE)):
                units.append(held.rstrip())
                scripts.append(now)
                held = ""
            if c != " ":
                now = k
            held += c
        units.append(held.rstrip())
        scripts.append(now)
        number[i] = len(units) - before
    counts[counts > 0] = number
    return units, np.array(scripts, np.int64), counts


class Model:
    """Scores of units by language. `allowed` says which languages use a script."""

    def __init__(self, languages: list[str], table: np.ndarray, allowed: np.ndarray) -> None:
        self.languages, self.table, self.allowed = languages, table, allowed
        self.reset()

    def __getstate__(self) -> tuple:
        return self.languages, self.table, self.allowed

    def __setstate__(self, state: tuple) -> None:
        self.languages, self.table, self.allowed = state
        self.reset()

    def reset(self) -> None:
        self.index: dict[str, int] = {}
        self.ends = np.zeros(1, np.int64)  # of a run's units among all
        self.scores = np.zeros((0, len(self.languages)), np.float32)
        self.letters, self.known = np.zeros(0, np.int32), np.zeros(0, bool)
        self.size = 0

    def learn(self, runs: list[str]) -> None:
        """Scores of new runs' units: their grams' log-likelihoods against the mean language; a language that isn't used
        with the unit's script gets the lowest score less one a letter, 4 at least. A unit whose script no language uses is not known."""
        units, script, counts = units_of(runs)
        self.index.update(zip(runs, range(len(self.index), len(self.index) + len(runs)), strict=True))
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(counts)])
        self.size += sum(map(len, runs)) + ENTRY * len(runs) + (4 * len(self.languages) + 13) * len(units)
        if not units:
            return
        rows, owner = gram_rows(units)
        sums = np.zeros((len(units), len(self.languages)), np.float32)
        for k in range(len(self.languages)):
            sums[:, k] = np.bincount(owner, self.table[rows, k], len(units))
        sums *= WEIGHT
        may = self.allowed[script]
        low = np.where(may, sums, np.inf).min(1, initial=np.inf)
        some = may.any(1)
        letters = np.array([len(u) - u.count(" ") for u in units], np.int32)
        sums = np.where(may, sums, (np.where(some, low, 0) - np.maximum(letters, 4))[:, None]).astype(np.float32)
        self.scores = np.concatenate([self.scores, sums])
        self.letters = np.concatenate([self.letters, letters])
        self.known = np.concatenate([self.known, some])

    def spans(self, s: np.ndarray) -> np.ndarray:
        """The best language of each unit, a change costing SWITCH; of equal paths the one with the first language.

        One language throughout is the best path if no stretch of units gains more than SWITCH in another language over
        the best single one (so that a path with that one can't win), and the best beginning and the best end together
        gain no more than SWITCH (so that a path without it can't either). Only other texts are searched.
        """
        best = int(s.sum(0).argmax())
        gain = np.cumsum(s - s[:, best : best + 1], 0, dtype=np.float64)
        low = np.minimum.accumulate(np.concatenate([np.zeros((1, s.shape[1])), gain[:-1]]), 0)
        if (gain - low).max() <= SWITCH and gain.max() + (gain[-1] - low).max() <= SWITCH:
            return np.full(len(s), best)
        total = s[0].tolist()
        back = np.zeros((len(s), s.shape[1]), np.uint16)
        for first in range(1, len(s), 4096):
            for t, row in enumerate(s[first : first + 4096].tolist(), first):
                top = max(total)
                moved, at = top - SWITCH, total.index(top)
                back[t] = [i if v >= moved else at for i, v in enumerate(total)]
                total = [(v if v >= moved else moved) + x for v, x in zip(total, row, strict=True)]
        path = np.zeros(len(s), np.int64)
        path[-1] = total.index(max(total))
        for t in range(len(s) - 1, 0, -1):
            path[t - 1] = back[t, path[t]]
        return path

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        if self.size > MEMORY:
            self.reset()
        runs = [t.split() for t in texts]
        new = list(set().union(*runs).difference(self.index))
        if new:
            self.learn(new)
        out = []
        for text in runs:
            at = np.fromiter(map(self.index.__getitem__, text), np.int64, len(text))
            first, number = self.ends[at], self.ends[at + 1] - self.ends[at]
            to = np.cumsum(number)
            unit = np.arange(int(to[-1]) if len(to) else 0) + np.repeat(first - (to - number), number)
            if not len(unit) or not self.languages:
                out.append(("und", 0.0))
                continue
            n = self.letters[unit]
            unit = unit[self.known[unit]]
            letters = np.bincount(self.spans(self.scores[unit]), self.letters[unit], len(self.languages)) if len(unit) else np.zeros(len(self.languages))
            top = int(letters.argmax())
            out.append((self.languages[top], float(letters[top] / n.sum())))
        return out


def gram_counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(occurrences of each gram bucket, letters of each script) in texts."""
    words = Counter(r for t in texts for r in t.split())
    units, script, counts = units_of(list(words))
    grams, letters = np.zeros(BUCKETS), np.zeros(len(_NAMES))
    if units:
        times = np.repeat(np.array(list(words.values()), float), counts)
        rows, owner = gram_rows(units)
        grams += np.bincount(rows, times[owner], BUCKETS)
        letters += np.bincount(script, times * [len(u) - u.count(" ") for u in units], len(_NAMES))
    return grams, letters


def fit(counted: dict[str, tuple[np.ndarray, np.ndarray]]) -> Model:
    """From each language's counts: log-likelihoods of hashed grams, and the scripts of each language."""
    languages = sorted(counted)
    table = np.full((BUCKETS, len(languages)), 0.5)
    seen = np.zeros((len(_NAMES), len(languages)))
    for k, lang in enumerate(languages):
        table[:, k] += counted[lang][0]
        seen[:, k] = counted[lang][1]
    if languages:
        table = np.log(table / table.sum(0))
        table -= table.mean(1, keepdims=True)
    return Model(languages, table.astype(np.float32), (seen >= SCRIPT_SHARE * seen.sum(0)) & (seen > 0))


def train(docs: DataFrame, most: int = TRAIN_ROWS, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """A model of at most `most` documents a language. Null languages, ids and texts teach nothing.

    Documents whose hash is in a part of the hashes that holds about OVERSAMPLE times `most` are ranked, so a common
    language sends no more rows to its task than a rare one. The numbers of documents by language that this needs are
    broadcast behind a check of their rows. Grams are counted where the texts are; one row a bucket and
    language, at most BUCKETS and the scripts, comes to the driver, and no text does.
    """
    given = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where("id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL")
    hashed = given.withColumn("h", F.xxhash64("id"))
    numbers = given.groupBy("lang").count()
    in_part = F.col("h") / float(1 << 63) < 2.0 * OVERSAMPLE * most / F.col("count") - 1
    order = Window.partitionBy("lang").orderBy("h", "id", F.xxhash64("text"))
    numbers = checkpointed(numbers)
    small = F.broadcast(numbers) if numbers.count() <= BROADCAST_ROWS else numbers
    few = hashed.join(small, "lang").where(in_part).withColumn("k", F.row_number().over(order)).where(F.col("k") <= most)

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for lang, group in frame.groupby("lang"):
                for part in by_characters(iter([group]), "text"):
                    found = np.concatenate(gram_counts(list(part["text"])))
                    at = np.flatnonzero(found)
                    yield pd.DataFrame({"lang": lang, "at": at, "n": found[at].astype(np.int64)})

    rows = few.select("lang", "text").mapInPandas(count, "lang string, at int, n long").groupBy("lang", "at").agg(F.sum("n").alias("n")).toPandas()
    counted = {}
    for lang, group in rows.groupby("lang"):
        both = np.zeros(BUCKETS + len(_NAMES))
        both[group["at"]] = group["n"]
        counted[lang] = both[:BUCKETS], both[BUCKETS:]
    return fit(counted)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) of every whole text; score is the share of letters in spans of that language.

    Letters of a script that no language was learned with are in no span: they lower the score, to 0 for a text of such
    letters alone, whose language is then the first by name. `und` with score 0 if the text is null, has no letter, or
    nothing could be learned."""

    def work(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(model.predict(list(frame[given])), columns=["lang_pred", "score"])

    given = unused(docs.select(id_col), "text")
    return map_texts(docs.select(id_col, text_or_empty(text_col).alias(given)), [id_col], work, "lang_pred string, score double", given)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(id, held_out, lang_pred, score): learns only from documents whose id's crc32 modulo 5 is not 0.

    The prediction depends on the text alone; null, letterless and unlearned texts as in `predict`. Very long texts are
    taken whole, in memory linear in their length. Repeated rows stay repeated; extra columns are not read. An empty
    table: no rows. No shuffle but for the choice of training rows and their counts.
    """
    model = train(docs.where(crc32_mod(id_col, 5) != 0), id_col=id_col, text_col=text_col, lang_col=lang_col)
    return predict(docs, model, id_col, text_col).select(id_col, (crc32_mod(id_col, 5) == 0).alias("held_out"), "lang_pred", "score")

"""Quality classifier: a factorisation machine over hashed words, word shapes and structure statistics."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terraloom.llm.frames import crc32_mod, kept, map_texts, text_or_empty
from terraloom.session import unused

#: Labelled rows that training takes at most: those with the smallest id hashes.
TRAIN_ROWS = 4000
WORDS, SHAPES, BINS = 1 << 13, 1 << 10, 8
RANK, EPOCHS, BATCH, RATE, DECAY = 8, 12, 64, 0.08, 1e-5
STATS = ("words", "distinct", "most_common", "word_length", "dup_lines", "line_words", "upper", "signs")
#: Columns of metadata that there is room for, and the bins of each.
NUMBERS, NUMBER_BINS = 4, 24
SIZE = WORDS + SHAPES + len(STATS) * BINS + NUMBERS * NUMBER_BINS
#: Columns that are read as metadata where `docs` has them. Languages, sources, identifiers and labels never are.
METADATA = ("n_chars",)

#: Bytes that a Python worker's table of distinct words may take; when it is full it starts anew. And what an entry takes
#: besides its characters.
MEMORY = 40 << 20
ENTRY = 270
_KINDS = [(re.compile(r"[^\W\d_]+"), "a"), (re.compile(r"\d+"), "0")]


def _hash(s: str, size: int) -> int:
    return zlib.crc32(s.encode("utf-8", "replace")) % size


class Words(dict):
    """Word -> (word bucket, shape bucket, all capitals, has signs). A shape keeps signs and puts one letter for a run of letters."""

    size = 0

    def __missing__(self, word: str) -> tuple[int, int, bool, bool]:
        core = word.strip(".,;:?")
        upper = len(core) > 1 and core.isupper()
        shape = core
        for pattern, kind in _KINDS:
            shape = pattern.sub(kind, shape)
        facts = (_hash(core.lower(), WORDS), WORDS + _hash(("A" if upper else "a") + shape, SHAPES), upper, not shape.isalnum() and shape != "")
        self.size += ENTRY + len(word)
        if self.size > MEMORY:
            self.clear()
            self.size = ENTRY + len(word)
        self[word] = facts
        return facts


def _bin(x: float, step: float) -> int:
    return min(BINS - 1, int(x / step))


def features(text: str, numbers: tuple = ()) -> tuple[list[int], list[float]]:
    """Feature numbers, each once, and values of a whole text; an empty one has its structure statistics only. `numbers`
    are the document's metadata, in bins of their logarithms; a missing one has a bin of its own."""
    known = kept(("quality_fm", "words"), Words)
    counts = Counter(text.split())
    n = sum(counts.values())
    total = max(n, 1)
    sums: dict[int, int] = {}
    upper = signs = letters = 0
    for word, k in counts.items():
        bucket, shape, is_upper, has_signs = known[word]
        sums[bucket] = sums.get(bucket, 0) + k
        sums[shape] = sums.get(shape, 0) + k
        upper += k * is_upper
        signs += k * has_signs
        letters += k * len(word)
    index, value = list(sums), [k / total for k in sums.values()]
    lines = [x for x in text.split("\n") if x.strip()]
    stats = (
        _bin(np.log2(n + 1), 2),
        _bin(len(counts) / total, 0.125),
        _bin(max(counts.values(), default=0) / total, 0.06),
        _bin(letters / total, 1.5),
        _bin(1 - len(set(lines)) / max(len(lines), 1), 0.125),
        _bin(np.log2(n / max(len(lines), 1) + 1), 1),
        _bin(upper / total, 0.125),
        _bin(signs / total, 0.125),
    )
    base = WORDS + SHAPES
    index.extend(base + i * BINS + b for i, b in enumerate(stats))
    base += len(STATS) * BINS
    for i, x in enumerate(numbers[:NUMBERS]):
        missing = x is None or x != x
        index.append(base + i * NUMBER_BINS + (0 if missing else 1 + min(NUMBER_BINS - 2, int(np.log2(max(float(x), 0) + 1)))))
    value.extend([0.5] * (len(index) - len(value)))
    return index, value


class Machine:
    """Weights of a second-order factorisation machine; scores are linear in a text's features, by
    sum over pairs = half of (square of the sum - sum of the squares)."""

    def __init__(self, bias: float, linear: np.ndarray, low_rank: np.ndarray) -> None:
        self.bias, self.linear, self.low_rank = bias, linear, low_rank

    def logits(self, index: np.ndarray, value: np.ndarray, starts: np.ndarray) -> np.ndarray:
        if not len(starts):
            return np.zeros(0)
        vx = self.low_rank[index] * value[:, None]
        total, squares = np.add.reduceat(vx, starts), np.add.reduceat(vx * vx, starts)
        return self.bias + np.add.reduceat(self.linear[index] * value, starts) + 0.5 * (total * total - squares).sum(1)

    def scores(self, texts: list[str], numbers: list[tuple] | None = None) -> np.ndarray:
        rows = [features(t, m) for t, m in zip(texts, numbers or [()] * len(texts), strict=True)]
        sizes = np.array([len(r[0]) for r in rows], np.int64)
        index = np.fromiter((i for r in rows for i in r[0]), np.int64, int(sizes.sum()))
        value = np.fromiter((v for r in rows for v in r[1]), np.float32, int(sizes.sum()))
        return 1 / (1 + np.exp(-self.logits(index, value, np.cumsum(sizes) - sizes)))


def fit(rows: list[tuple[list[int], list[float], int]], rank: int = RANK, epochs: int = EPOCHS, seed: int = 7) -> Machine:
    """Adagrad on the logistic loss. The two labels weigh the same as they occur; no rows: every score is 0.5."""
    rng = np.random.default_rng(seed)
    machine = Machine(0.0, np.zeros(SIZE, np.float32), rng.normal(0, 0.05, (SIZE, rank)).astype(np.float32))
    if not rows:
        machine.low_rank[:] = 0
        return machine
    share = min(max(np.mean([r[2] for r in rows]), 0.01), 0.99)
    machine.bias = float(np.log(share / (1 - share)))
    seen_w, seen_v = np.full(SIZE, 1e-6, np.float32), np.full((SIZE, rank), 1e-6, np.float32)
    data = [(np.array(i), np.array(v, np.float32), y) for i, v, y in rows]
    for _ in range(epochs):
        order = rng.permutation(len(data))
        for at in range(0, len(order), BATCH):
            part = [data[k] for k in order[at : at + BATCH]]
            index, value = np.concatenate([p[0] for p in part]), np.concatenate([p[1] for p in part])
            sizes = np.array([len(p[0]) for p in part])
            starts, owner = np.cumsum(sizes) - sizes, np.repeat(np.arange(len(part)), sizes)
            error = 1 / (1 + np.exp(-machine.logits(index, value, starts))) - np.array([p[2] for p in part])
            vx = machine.low_rank[index] * value[:, None]
            total = np.add.reduceat(vx, starts)
            step = error[owner] * value
            grad_w, grad_v = np.zeros(SIZE, np.float32), np.zeros((SIZE, rank), np.float32)
            np.add.at(grad_w, index, step)
            np.add.at(grad_v, index, step[:, None] * (total[owner] - vx))
            used = np.unique(index)
            for weights, grad, seen in ((machine.linear, grad_w, seen_w), (machine.low_rank, grad_v, seen_v)):
                g = grad[used] + DECAY * weights[used]
                seen[used] += g * g
                weights[used] -= RATE * g / np.sqrt(seen[used])
    return machine


def _metadata(docs: DataFrame, metadata: tuple[str, ...]) -> Column:
    """One column with the numbers that are there, null where `docs` hasn't the column or it isn't a number."""
    there = dict(docs.dtypes)
    return F.array(*(F.expr(f"try_cast(`{c}` AS double)") if c in there and not there[c].startswith(("array", "map", "struct", "binary")) else F.lit(None).cast("double") for c in metadata))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", most: int = TRAIN_ROWS, id_col: str = "doc_id", text_col: str = "text", metadata: tuple[str, ...] = METADATA) -> Machine:
    """A machine fitted on at most `most` labelled documents; their features, at most SIZE a document and never their
    texts, come to the driver.

    Rows with a null id or label are left out; an id with several labels takes the largest, an id on several rows is
    taught by the row whose text and metadata have the smallest hash.
    """
    chosen = (
        labels.select(id_col, F.col(label).cast("int").alias("y"))
        .where(F.col(id_col).isNotNull() & F.col("y").isNotNull())
        .groupBy(id_col)
        .agg(F.max("y").alias("y"))
        .orderBy(F.xxhash64(id_col), id_col)
        .limit(most)
    )

    def work(frame: pd.DataFrame) -> pd.DataFrame:
        rows = [features(t, tuple(m)) for t, m in zip(frame["text"], frame["numbers"], strict=True)]
        return pd.DataFrame({"i": [r[0] for r in rows], "v": [r[1] for r in rows]})

    given = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"), _metadata(docs, metadata).alias("numbers"))
    taught = given.join(F.broadcast(chosen.withColumnRenamed(id_col, "id")), "id").withColumn("h", F.xxhash64("text", "numbers"))
    made = map_texts(taught, ["id", "y", "h"], work, "i array<int>, v array<float>")
    # One row an id, so `most` rows at most, whatever the input's size; an id's rows are reduced before the shuffle.
    each = made.groupBy(F.col("id").cast("string").alias("id"), "y").agg(F.min(F.struct("h", "i", "v")).alias("least"))
    rows = each.select("id", "y", "least.i", "least.v").collect()
    return fit([(r.i, r.v, r.y) for r in sorted(rows, key=lambda r: (zlib.crc32(r.id.encode()), r.id, r.i))])


def score(docs: DataFrame, machine: Machine, id_col: str = "doc_id", text_col: str = "text", metadata: tuple[str, ...] = METADATA) -> DataFrame:
    """(all columns of `docs`, score, predicted) of every whole text. Null text counts as empty. Nothing is shuffled.
    Columns of `docs` with the names of the result's give way to them."""
    names = [c for c in docs.columns if c not in ("score", "predicted")]
    given, numbers = unused(docs, "given"), unused(docs, "numbers")

    def work(frame: pd.DataFrame) -> pd.DataFrame:
        s = machine.scores(list(frame[given]), [tuple(m) for m in frame[numbers]]).astype(float)
        return pd.DataFrame({"score": s, "predicted": (s >= 0.5).astype("int32")})

    seen = docs.select(*names, text_or_empty(text_col).alias(given), _metadata(docs, metadata).alias(numbers))
    return map_texts(seen, names, work, "score double, predicted int", given)


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, score, predicted): learns only from labels whose id's crc32 modulo 3 is not 1; the others are held out.

    A score depends on the text and on the metadata (n_chars, where there is such a column) alone. Empty or null texts get
    the score of their structure statistics; without labels every score is 0.5. Very long texts have at most SIZE
    features. Equal scores mean equal predictions. Repeated rows stay repeated; other columns are not read.
    """
    machine = train(docs, labels.where(crc32_mod(id_col, 3) != 1), id_col=id_col, text_col=text_col)
    there = [c for c in METADATA if c in docs.columns and c not in (id_col, text_col)]
    out = score(docs.select(id_col, text_col, *there), machine, id_col, text_col)
    return out.select(id_col, (crc32_mod(id_col, 3) == 1).alias("held_out"), "score", "predicted")

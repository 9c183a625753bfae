"""Personal data: fixed patterns, and a skip-chain conditional random field that keeps labels consistent in a document."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terraloom.llm.frames import frames_of, map_texts, text_or_empty
from terraloom.session import unused

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)

#: Documents that the weights are fitted on at most: those with the smallest id hashes. And how many times as many are looked
#: through for them.
TRAIN_DOCS, OVERSAMPLE = 2000, 4
#: Kinds of edges between tokens, and pairs that agree and that do not, which each is taken to have been seen with already.
EDGES = ("same", "similar", "next")
PRIOR = {"same": (20.0, 0.1), "similar": (2.0, 1.0), "next": (1.0, 1.0)}
ROUNDS, DAMPING, SURE = 20, 0.5, 0.6

#: The patterns.
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
#: A match that may begin inside a run of digits would also begin at its start, so none is tried there, and none goes back.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: What else may be personal data: digits with separators, and addresses that are spelled out. Cue words stand up to LEAD
#: characters before it.
NUMBER = re.compile(r"(?<![\w.+])\(?[0-9](?:[\x20().-]{0,2}[0-9]){6,}(?![\w])")
SPELLED = re.compile(r"(?<![\w.%+-])[A-Za-z0-9._%+-]++\x20?(?:[\[(]at[\])]|@)\x20?[A-Za-z0-9-]++(?:\x20?(?:\.|[\[(]dot[\])])\x20?[A-Za-z0-9-]++)+")
LEAD = 24
CUES = (("mail", "contact"), ("ip", "host", "server"), ("card", "visa", "credit"), ("phone", "tel", "call", "fax", "mobile"))

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def digits_of(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """The patterns' matches by kind and start, leftmost and not overlapping within a kind; failing ones are dropped."""
    found: list[Span] = []
    at, before = text.find("@"), 0
    while at >= 0:
        tail = DOMAIN.match(text, at)
        start = at
        if tail:
            low = before
            step = 64
            while True:  # the local part's start, in growing steps, so that a long text is not searched anew each time
                head = LOCAL.search(text[max(low, at - step) : at])
                start = at - (len(head[0]) if head else 0)
                if start > max(low, at - step) or at - step <= low:
                    break
                step *= 4
        if tail and start < at:
            found.append(("email", start, tail.end()))
            before = tail.end()
            at = text.find("@", before)
        else:
            at = text.find("@", at + 1)
    found += [("ip", m.start(), m.end()) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split("."))]
    found += [("card", m.start(), m.end()) for m in CARD.finditer(text) if 16 <= len(d := digits_of(m[0])) <= 19 and luhn(d)]
    found += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 8 <= len(digits_of(m[0])) <= 15]
    return found


def candidates(text: str, taken: list[Span]) -> list[tuple[int, int]]:
    """Spans outside the patterns' that look like numbers or addresses."""
    ends = sorted((s, e) for _, s, e in taken)
    out, i = [], 0
    for m in sorted([*NUMBER.finditer(text), *SPELLED.finditer(text)], key=lambda m: m.start()):
        while i < len(ends) and ends[i][1] <= m.start():
            i += 1
        clear = i >= len(ends) or ends[i][0] >= m.end()
        if clear and (not out or out[-1][1] <= m.start()):
            out.append((m.start(), m.end()))
    return out


def describe(text: str, start: int, end: int) -> list[float]:
    """A token's features: its digits, its separators, and the cue words before it."""
    s = text[start:end]
    d = digits_of(s)
    lead = text[max(0, start - LEAD) : start].lower()
    size = np.searchsorted([8, 11, 13, 16, 17, 20], len(d), "right")
    return [
        1.0,
        *(float(size == k) for k in range(7)),
        float(" " in s), float("(" in s), float("-" in s), float(s.count(".") == 3), float(s[:1] == "+"),
        float(len(d) >= 13 and luhn(d)), float("@" in s), float(bool(re.search(r"[\[(]at[\])]", s))),
        *(float(any(w in lead for w in words)) for words in CUES),
    ]


WIDTH = len(describe("", 0, 0))


def links(keys: list[str]) -> list[tuple[int, int, int]]:
    """Skip edges and their kind: each token to the previous one with the same digits (or letters), or with the same last
    eight digits; and to its neighbour. A token has two edges backwards at most, so their number is linear."""
    edges, same, similar = [], {}, {}
    for i, key in enumerate(keys):
        if key in same:
            edges.append((same[key], i, 0))
        elif len(key) >= 8 and key[-8:] in similar:
            edges.append((similar[key[-8:]], i, 1))
        if i:
            edges.append((i - 1, i, 2))
        same[key] = i
        if len(key) >= 8:
            similar[key[-8:]] = i
    return edges


def beliefs(unary: np.ndarray, edges: list[tuple[int, int, float]]) -> np.ndarray:
    """Marginals by loopy sum-product message passing, damped; an edge (i, j, w) multiplies by e^w where both have one label.

    A message is log(sum of e^b + (e^w - 1) e^b(x)) of what its sender believes, so memory is linear in edges and labels."""
    k = unary.shape[1]
    total = unary.astype(float)
    if edges:
        i, j, w = (np.array(x) for x in zip(*edges, strict=True))
        src, dst, gain = np.concatenate([i, j]), np.concatenate([j, i]), np.expm1(np.concatenate([w, w]).astype(float))[:, None]
        back = np.roll(np.arange(len(src)), len(i))
        message = np.zeros((len(src), k))
        for _ in range(ROUNDS):
            out = total[src] - message[back]
            out = np.exp(out - out.max(1, keepdims=True))
            new = np.log(out.sum(1, keepdims=True) + gain * out)
            new -= new.max(1, keepdims=True)
            moved = np.abs(new - message).max()
            message = DAMPING * message + (1 - DAMPING) * new
            total = unary + np.stack([np.bincount(dst, message[:, x], len(unary)) for x in range(k)], 1)
            if moved < 1e-4:
                break
    p = np.exp(total - total.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def key_of(s: str) -> str:
    """What tokens are compared by: an address' letters and digits in lower case, else the digits."""
    if "@" in s or re.search(r"[\[(]at[\])]", s):
        return re.sub(r"[^a-z0-9]+", "", re.sub(r"[\[(](?:at|dot)[\])]", "", s.lower()))
    return digits_of(s)


class Field:
    """Weights of the random field: of a token's features by label, and of the kinds of edges."""

    def __init__(self, unary: np.ndarray, edges: np.ndarray) -> None:
        self.unary, self.edges = unary, edges


def tokens_of(text: str) -> list[tuple[int, int, int, bool]]:
    """(start, end, label, observed) in order: the patterns' spans are observed, the candidates beside them are not."""
    base = base_spans(text)
    return sorted([(s, e, LABELS.index(k), True) for k, s, e in base] + [(s, e, 0, False) for s, e in candidates(text, base)])


def find_spans(text: str, field: Field) -> tuple[list[Span], list[Span]]:
    """(the patterns' spans, those that the field adds). The patterns' tokens are observed; the field labels the others."""
    tokens = tokens_of(text)
    base = sorted(((LABELS[y], s, e) for s, e, y, observed in tokens if observed), key=lambda x: (KINDS.index(x[0]), x[1]))
    if len(tokens) == len(base):
        return base, []
    unary = np.array([describe(text, s, e) for s, e, _, _ in tokens]) @ field.unary
    for i, (_, _, label, observed) in enumerate(tokens):
        if observed:
            unary[i] = -50
            unary[i, label] = 0
    p = beliefs(unary, [(i, j, field.edges[kind]) for i, j, kind in links([key_of(text[s:e]) for s, e, _, _ in tokens])])
    added = [(LABELS[int(row.argmax())], s, e) for (s, e, _, observed), row in zip(tokens, p, strict=True) if not observed and row.argmax() and row.max() >= SURE]
    return base, added


def observations(text: str) -> Counter:
    """What a document teaches: its tokens' features and labels, and the agreement of the ends of its edges.

    A candidate that repeats a pattern's token is what the field is to decide: it teaches nothing, nor do its edges. Beside
    each number that a pattern found, another number in its place that no pattern takes teaches that digits and cue words
    alone make no personal data; what is added must be linked to what is known."""
    tokens = tokens_of(text)
    keys = [key_of(text[s:e]) for s, e, _, _ in tokens]
    sure = {k for k, t in zip(keys, tokens, strict=True) if t[3]}
    taught = [t[3] or k not in sure for k, t in zip(keys, tokens, strict=True)]
    seen: Counter = Counter((",".join(f"{v:g}" for v in describe(text, s, e)), y) for (s, e, y, _), ok in zip(tokens, taught, strict=True) if ok)
    for s, e, y, observed in tokens:
        if observed and LABELS[y] != "email":
            other = "".join(str((int(c) + 1) % 10) for c in digits_of(text[s:e]))
            if not luhn(other):
                lead = text[max(0, s - LEAD) : s]
                seen[",".join(f"{v:g}" for v in describe(lead + other, len(lead), len(lead) + len(other))), 0] += 1
    seen.update((EDGES[kind], int(tokens[i][2] == tokens[j][2])) for i, j, kind in links(keys) if taught[i] and taught[j])
    return seen


def fit(seen: dict[tuple[str, int], int], steps: int = 300, rate: float = 0.5) -> Field:
    """Unary weights: softmax regression of the labels on the tokens' features, each as often as it occurs. Edge weights: the
    log-odds that two ends agree, over what they would be if labels were drawn anew. Nothing seen: nothing is added."""
    rows = sorted((k, y, n) for (k, y), n in seen.items() if k not in EDGES)
    unary = np.zeros((WIDTH, len(LABELS)))
    shares = np.full(len(LABELS), 1 / len(LABELS))
    if rows:
        x = np.array([[float(v) for v in k.split(",")] for k, _, _ in rows])
        want = np.eye(len(LABELS))[[y for _, y, _ in rows]]
        weight = np.array([n for _, _, n in rows], float)
        weight /= weight.sum()
        shares = weight @ want
        for _ in range(steps):
            z = x @ unary
            p = np.exp(z - z.max(1, keepdims=True))
            unary += rate * ((x * weight[:, None]).T @ (want - p / p.sum(1, keepdims=True)) - 1e-4 * unary)
    else:
        unary[0, 0] = 5.0
    chance = min(max(float(shares @ shares), 0.05), 0.95)
    edges = []
    for kind in EDGES:
        agree, differ = (PRIOR[kind][1 - y] + seen.get((kind, y), 0) for y in (1, 0))
        edges.append(max(0.0, float(np.log(agree / differ) - np.log(chance / (1 - chance)))))
    return Field(unary, np.array(edges))


def train(docs: DataFrame, most: int = TRAIN_DOCS, id_col: str = "doc_id", text_col: str = "text") -> Field:
    """A field fitted on at most `most` documents; only counts of features, labels and agreements come to the driver."""
    ids = docs.select(F.col(id_col).alias("id")).where("id IS NOT NULL").withColumn("h", F.xxhash64("id"))
    # A part of the hashes that holds about OVERSAMPLE times `most` rows: no more ids than that are made distinct.
    few = ids.where(F.col("h") / float(1 << 63) < 2.0 * OVERSAMPLE * most / max(1, docs.count()) - 1)
    chosen = few.distinct().orderBy("h", "id").limit(most).select(F.col("id").alias(id_col))

    def work(frame: pd.DataFrame) -> pd.DataFrame:
        seen: Counter = Counter()
        for text in frame["text"]:
            seen.update(observations(text))
        rows = [(k, y, n) for (k, y), n in seen.items()]
        return pd.DataFrame(rows, columns=["k", "y", "n"]).astype({"k": object, "y": "int32", "n": "int64"})

    taught = docs.select(id_col, text_or_empty(text_col).alias("text")).join(F.broadcast(chosen), id_col)
    return fit({(r.k, r.y): r.n for r in frames_of(taught, work, "k string, y int, n long").groupBy("k", "y").agg(F.sum("n").alias("n")).collect()})


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (KINDS.index(x[0]), x[1])))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added) of every whole text.

    The counts and the hash are of the patterns' matches alone; `spans` has theirs and those that the field adds.
    Null or empty text: no spans. Very long texts are taken whole, in time linear in their length. Of equally likely labels
    the first of LABELS counts. Repeated rows stay repeated; extra columns are not read. An empty table: no rows. Nothing
    is shuffled but the choice of training documents.
    """
    field = train(docs, id_col=id_col, text_col=text_col)

    def work(frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        for text in frame[given]:
            base, added = find_spans(text, field)
            n = [sum(k == kind for k, _, _ in base) for kind in KINDS]
            out.append((*n, hashlib.sha256(joined(base).encode()).hexdigest(), joined(base + added), len(added)))
        names = [*(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"]
        return pd.DataFrame(out, columns=names)

    given = unused(docs.select(id_col), "text")
    schema = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"
    return map_texts(docs.select(id_col, text_or_empty(text_col).alias(given)), [id_col], work, schema, given)


def masked(text: str, spans: list[Span]) -> str:
    """The text with a mark for each stretch of personal data; stretches that overlap become one, marked by the first."""
    out, at = [], 0
    for kind, s, e in sorted(spans, key=lambda x: (x[1], -x[2])):
        if s >= at:
            out += [text[at:s], f"<{kind.upper()}>"]
        at = max(at, e)
    return "".join(out) + text[at:]


def mask(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with marks instead of personal data, the other columns as they are; null texts stay null."""
    field = train(docs, id_col=id_col, text_col=text_col)
    names, given, marked = docs.columns, unused(docs, "given"), unused(docs, "marked")

    def work(frame: pd.DataFrame) -> pd.DataFrame:
        new = [masked(t, [x for part in find_spans(t, field) for x in part]) for t in frame[given]]
        return pd.DataFrame({marked: new}, dtype=object)

    out = map_texts(docs.select(*names, text_or_empty(text_col).alias(given)), names, work, f"{marked} string", given)
    return out.select(*(F.when(F.col(c).isNotNull(), F.col(marked)).alias(c) if c == text_col else c for c in names))

"""The operators against brute force on small fixtures: nulls, empty and long texts, ties, repeats, empty tables, clashing names."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from terraloom.llm import fingerprints, html_extract, langid, packing, piece_viterbi, pii, quality_fm, quality_rules, simhash, token_counts

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, kept string, fingerprint string, start string"
WORD_BPE, BYTE_BPE, PIECES = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"))


def make_texts():
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    long = prose(6000)
    near = prose(300)
    texts = [
        None, "", " \n\t ", "A", "one two three", "É à ü ß x", "日本語 тест 😀", prose(60), prose(200), long, long.upper(),
        near, near + " tail", near.replace(" ", "  ", 1), near, "\n".join(["same line here"] * 40), "a " * 500, "<|endoftext|> mid <|endoftext|>",
        "mail me.x@host.example.com or 10.0.0.1, 300.1.1.1 and 4111 1111 1111 1111 or +45 (12) 34 56 78 now", "It's \r\n x\x0bx ## $$ | <b>",
    ]
    return texts + [prose(rng.randint(1, 120)) for _ in range(40)]


@pytest.fixture(scope="module")
def rows():
    texts = make_texts()
    out = [(i, t, ["en", "fr", None][i % 3], "s", len(t) if t else 0, "x", "y", "z", "w") for i, t in enumerate(texts)]
    return [*out, (7, texts[7], "en", "s", 1, None, None, None, None)]  # a repeated row


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark, rows):
    return spark.createDataFrame([(r[0], int(len(r[1] or "") > 50), 0) for r in rows[:-1]], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def text_of(rows):
    return {r[0]: r[1] or "" for r in rows}


def test_fingerprints(docs, none, rows, text_of):
    got = fingerprints.compare_with_edited(docs).toPandas()
    assert len(got) == len(rows)
    assert fingerprints.compare_with_edited(none).count() == 0
    order = sorted(rows, key=lambda r: (-r[0], r[1] or ""))
    texts = [r[1] or "" for r in order]
    by_id = {i: g for i, g in got.groupby("doc_id")}

    def terms(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", t.lower())
        return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()

    def jaccard(a, b):
        keys = set(a) | set(b)
        return sum(min(a[k], b[k]) for k in keys) / sum(max(a[k], b[k]) for k in keys) if keys else 1.0

    errors = []
    for k, r in enumerate(order):
        t, following = texts[k], texts[(k + 1) % len(texts)]
        half = len(t) // 2
        e = t[: len(t) - half] + following[:half]
        g = by_id[r[0]]
        assert hashlib.sha256(e.encode()).hexdigest() in set(g.edited_sha256)
        assert set(g.n_chars) == {len(t)}
        if len(g) == 1:
            errors.append((jaccard(terms(t), terms(e)) - g.near_edited.iloc[0], len(terms(t))))
    assert abs(np.mean([e for e, _ in errors])) < 0.02
    assert max(abs(e) for e, _ in errors) < 0.15
    same = {}
    for i, f in zip(got.doc_id, got.fingerprint, strict=True):
        assert same.setdefault(text_of[i], f) == f
    assert got.near_next.between(0, 1).all()


@pytest.mark.parametrize("terms", [1, 5, 50, 500])
def test_collision_rate_is_the_generalised_jaccard_similarity(spark, terms):
    """Every pair counts, with few terms as with many, heavy weights among them: mean absolute error and bias are small."""
    rng = random.Random(terms)
    out = []
    for k in range(150):
        share = rng.random()
        a = {f"t{k}_{i}": rng.choice([1, 1, 2, 3, 9, 30]) for i in range(terms)}
        b = {t: rng.choice([w, w, w + 2, max(1, w // 3)]) for t, w in a.items() if rng.random() < share} | {f"n{k}_{i}": rng.choice([1, 4]) for i in range(int(terms * (1 - share)))}
        # A term is a word: with terms of one word the texts' weights are these numbers.
        text = lambda d: " ".join(" ".join([t] * w) for t, w in d.items())
        out.append((text(a), text(b), sum(min(a.get(t, 0), b.get(t, 0)) for t in a | b) / max(1, sum(max(a.get(t, 0), b.get(t, 0)) for t in a | b))))
    of = lambda c: fingerprints.sketch(F.col(c))
    was = fingerprints.weighted_terms.__defaults__
    fingerprints.weighted_terms.__defaults__ = (1,)
    try:
        got = spark.createDataFrame(out, "a string, b string, want double").select(fingerprints.likeness(of("a"), of("b")).alias("s"), "want").toPandas()
    finally:
        fingerprints.weighted_terms.__defaults__ = was
    error = got.s - got.want
    assert error.abs().mean() < 0.03
    assert abs(error.mean()) < 0.01


def test_units_are_the_occurrences(spark):
    """Short texts: the similarity is exact where every unit has a bin of its own."""
    df = spark.createDataFrame([("a " * 8, "a " * 8 + "b"), ("a b c", "a b c"), ("", ""), ("", "x")], "a string, b string")
    got = df.select(fingerprints.likeness(fingerprints.sketch(F.col("a")), fingerprints.sketch(F.col("b"))).alias("s")).toPandas().s
    assert list(got) == [pytest.approx(0.8), 1.0, 1.0, 0.0]


@pytest.mark.parametrize("hot_share", [1, 30, 1000])
def test_simhash_links_equal_brute_force(docs, none, rows, text_of, monkeypatch, hot_share):
    """With no hot fingerprint, with some, and with nothing else."""
    monkeypatch.setattr(simhash, "HOT_SHARE", hot_share)
    got = simhash.near_duplicates(docs).toPandas()
    assert len(got) == len(rows)
    assert simhash.near_duplicates(none).count() == 0

    def slow(text):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
        w = re.findall(r"[^\x20\x09-\x0D]+", low)
        if not w:
            return 0
        h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 4]).encode(), 42) for i in range(max(1, len(w) - 3))]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    ids = sorted(text_of)
    fp = {i: slow(text_of[i]) for i in ids}
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in ids:
        for b in ids:
            if a < b and (fp[a] ^ fp[b]).bit_count() <= 4:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    for r in got.itertuples():
        assert int(r.fingerprint, 16) == fp[r.doc_id]
        assert r.component_id == find(r.doc_id)


@pytest.mark.parametrize("bands", [simhash.BANDS, simhash.FINE_BANDS])
@pytest.mark.parametrize("seed", range(4))
def test_every_close_pair_meets(seed, bands, monkeypatch):
    """All pairs at up to four bits of random fingerprints and their perturbations meet at an anchor, also in parts."""
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 1 << 63, 60, dtype=np.int64)
    fp = [base]
    for bits in range(1, 5):
        flip = np.zeros(60, np.int64)
        for i in range(60):
            for b in rng.choice(64, bits, replace=False):
                flip[i] ^= np.int64(np.uint64(1 << int(b)).astype(np.int64))
        fp.append(base ^ flip)
    fp = np.unique(np.concatenate(fp))
    key, value, home = simhash.anchor_rows(fp, bands)
    order = np.lexsort((value, key))
    if seed % 2:
        monkeypatch.setattr(simhash, "STEP_PAIRS", 7)
    src, dst = simhash.links_of_sorted(key[order][:, None], value[order], home[order], 4)
    root = {int(f): int(f) for f in fp}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in zip(src.tolist(), dst.tolist(), strict=True):
        assert ((a ^ b) & (2**64 - 1)).bit_count() <= 64
        root[find(a)] = find(b)
    for a in fp.tolist():
        for b in fp.tolist():
            if ((a ^ b) & (2**64 - 1)).bit_count() <= 4:
                assert find(a) == find(b)


def test_simhash_parts_of_a_crowded_anchor(spark, monkeypatch):
    monkeypatch.setattr(simhash, "PART_ROWS", 5)
    rng = np.random.default_rng(3)
    base = int(rng.integers(1 << 60))
    near = sorted({base} | {base ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 60, (80, 2))})
    df = spark.createDataFrame([(v, i) for i, v in enumerate(near)], "fp long, first long")
    links = simhash.link_fingerprints(df).toPandas()
    root = {v: v for v in near}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links.itertuples(index=False):
        root[find(a)] = find(b)
    assert len({find(v) for v in near}) == 1


def test_packing_is_whole_and_tight(docs, none, rows, text_of):
    from tokenizers import Tokenizer

    got = packing.pack(docs, WORD_BPE, size=256, open_windows=3).toPandas()
    assert packing.pack(none, WORD_BPE).count() == 0
    library = Tokenizer.from_file(WORD_BPE)
    pieces = got[got.doc_id != 7].sort_values(["doc_id", "start"])
    for doc, g in pieces.groupby("doc_id"):
        ids = [*library.encode(text_of[doc], add_special_tokens=False).ids, 2]
        assert set(g.doc_tokens) == {len(ids)}
        at = 0
        for r in g.itertuples():
            assert r.start == at
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    assert set(got.doc_id) == set(text_of)
    for _, g in got.sort_values(["sequence_id", "offset"]).groupby("sequence_id"):
        assert list(g.offset) == [0, *np.cumsum(g.length)[:-1]]
        n = g.length.sum()
        assert n <= 256
        assert n == 256 or n & (n - 1) == 0


@pytest.mark.parametrize("seed", range(5))
def test_packing_equals_a_plain_packer(seed):
    """Best fit among the open windows, the fullest cut when none fits, leftovers poured together: step by step."""
    rng = random.Random(seed)
    size, most = 64, 4
    docs = [rng.choice([1, 3, 10, 40, 63, 64, 65, 200]) for _ in range(200)]
    windows, want, emitted = [], [], 0

    def out(pieces):
        nonlocal emitted
        at = 0
        for doc, start, n in pieces:
            want.append((doc, start, n, emitted, at))
            at += n
        emitted += 1

    for doc, n in enumerate(docs):
        start = 0
        while n - start >= size:
            out([(doc, start, size)])
            start += size
        while start < n:
            room = [size - sum(p[2] for p in w) for w in windows]
            fitting = [(r, i) for i, r in enumerate(room) if r >= n - start]
            if fitting:
                i = min(fitting)[1]
            elif len(windows) < most:
                windows.append([])
                room.append(size)
                i = len(windows) - 1
            else:
                i = min((r, k) for k, r in enumerate(room))[1]
            take = min(room[i], n - start)
            windows[i].append((doc, start, take))
            start += take
            if take == room[i]:
                out(windows.pop(i))
    windows.sort(key=lambda w: -sum(p[2] for p in w))
    units = [(doc, start + k) for w in windows for doc, start, n in w for k in range(n)]
    while units:
        n = size if len(units) >= size else 1 << (len(units).bit_length() - 1)
        row, units = units[:n], units[n:]
        pieces = []
        for doc, at in row:
            if pieces and pieces[-1][0] == doc and pieces[-1][1] + pieces[-1][2] == at:
                pieces[-1] = (doc, pieces[-1][1], pieces[-1][2] + 1)
            else:
                pieces.append((doc, at, 1))
        out(pieces)
    packer = packing.Packer(0, size, most)
    for doc, n in enumerate(docs):
        packer.add(doc, np.arange(n, dtype=np.uint32))
    packer.finish()
    got = [(r[0], r[1], r[2], r[5], r[6]) for r in packer.rows]
    whole = lambda rows: sorted((d, s + k, q, o + k) for d, s, n, q, o in rows for k in range(n))
    assert whole(got) == whole(want)


def test_token_counts_equal_the_library(docs, none, rows, text_of):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(BYTE_BPE)
    got = token_counts.count_tokens(docs, BYTE_BPE).toPandas()
    assert len(got) == len(rows)
    assert token_counts.count_tokens(none, BYTE_BPE).count() == 0
    for r in got.itertuples():
        t = text_of[r.doc_id]
        n = len(library.encode(t, add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(t.encode()), n, n > 512)


def test_token_counts_of_odd_white_space():
    from tokenizers import Tokenizer

    library, ours, rng = Tokenizer.from_file(BYTE_BPE), token_counts.MergeCounter(BYTE_BPE), random.Random(2)
    for _ in range(500):
        t = "".join(rng.choice(["a", "Foo", " ", " ", "\n", "\t", "\r\n", "'s", "!!", "12", "é", " "]) for _ in range(rng.randint(0, 12)))
        assert ours.count(t) == len(library.encode(t, add_special_tokens=False).ids), repr(t)


def test_pieces_round_trip(docs, none, rows, text_of):
    got = piece_viterbi.round_trips(docs, PIECES).toPandas()
    assert len(got) == len(rows)
    assert got.same.all()
    assert piece_viterbi.round_trips(none, PIECES).count() == 0
    encoded = piece_viterbi.encode(docs.where("doc_id <> 7"), PIECES)
    back = piece_viterbi.decode(encoded, PIECES).toPandas().set_index("doc_id").text
    assert all(back[i] == t for i, t in text_of.items() if i != 7)


def test_viterbi_equals_exhaustive_search():
    m = piece_viterbi.PieceModel(PIECES)
    score = dict(zip(m.ids.tolist(), m.scores.tolist(), strict=True))
    known = {m.pieces[i]: i for i in score}

    def best(word):
        table = [0.0]
        for end in range(1, len(word) + 1):
            options = [table[-1] + m.fallback]
            options += [table[start] + score[known[word[start:end]]] for start in range(end) if word[start:end] in known]
            table.append(max(options))
        return table[-1]

    for word in ["▁hello", "▁worlds", "abcdefgh", "▁日本xx", "q"]:
        path = m.best_paths([word])[0]
        total = sum(score.get(i, 0.0) for i in path)
        raw = [i for i in path if i not in score]
        chars = bytes(int(m.pieces[i][3:5], 16) for i in raw).decode() if raw else ""
        assert total + m.fallback * len(chars) == pytest.approx(best(word))


def test_pii_base_equals_brute_force(docs, none, rows, text_of):
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }

    def slow(t):
        out = []
        for kind, pattern in patterns.items():
            for m in re.finditer(pattern, t):
                d = re.sub(r"[^0-9]", "", m[0])
                good = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else True, "card": 16 <= len(d) <= 19 and pii.luhn(d), "phone": 8 <= len(d) <= 15}[kind]
                if good:
                    out.append((kind, m.start(), m.end()))
        return out

    got = pii.find(docs).toPandas()
    assert len(got) == len(rows)
    assert pii.find(none).count() == 0
    for r in got.itertuples():
        want = slow(text_of[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(pii.joined(want).encode()).hexdigest()
        assert set(pii.joined(want).split(",")) <= set(r.spans.split(","))
    rng = random.Random(4)
    for _ in range(2000):
        t = "".join(rng.choice(["a@b.c", "@", ".", "x", "1", "+1", "-", " ", "(", "10.0.0.1", "4111111111111111", "é", "_%"]) for _ in range(rng.randint(0, 9)))
        assert pii.base_spans(t) == slow(t), repr(t)


def test_pii_base_is_linear_in_runs_of_digits():
    import time

    began = time.perf_counter()
    for text in ("1" * 300_000, "1." * 150_000 + "x", "+1" * 100_000, "1 " * 100_000 + "x", "a@" * 100_000, "a" * 300_000 + "@", "(1" * 100_000):
        pii.candidates(text, pii.base_spans(text))
    assert time.perf_counter() - began < 20


def test_pii_beliefs_equal_exact_enumeration():
    """On trees the marginals are exact; with loops the best label agrees where it is clear."""
    import itertools

    rng = np.random.default_rng(4)

    def exact(unary, edges):
        p = np.zeros_like(unary)
        for y in itertools.product(range(unary.shape[1]), repeat=len(unary)):
            z = np.exp(sum(unary[i, k] for i, k in enumerate(y)) + sum(w for i, j, w in edges if y[i] == y[j]))
            for i, k in enumerate(y):
                p[i, k] += z
        return p / p.sum(1, keepdims=True)

    for _ in range(20):
        unary = rng.normal(0, 2, (5, 3))
        tree = [(int(rng.integers(j)), j, float(rng.uniform(0, 4))) for j in range(1, 5)]
        assert np.abs(pii.beliefs(unary, tree) - exact(unary, tree)).max() < 0.01
        want, got = exact(unary, [*tree, (0, 4, 1.0)]), pii.beliefs(unary, [*tree, (0, 4, 1.0)])
        clear = want.max(1) > 0.8
        assert (want.argmax(1) == got.argmax(1))[clear].all()


def test_pii_field_carries_labels_over_the_document():
    seen = Counter()
    for t in ["call +45 12 34 56 78 now, +45 12 34 56 78", "see 123456789 x", "no 98765432 y", "mail a@b.com z", "id 1234 5678 1234 5678 z"] * 20:
        seen.update(pii.observations(t))
    w = pii.fit(seen)
    text = "call +45 12 34 56 78 today, or later " + "word " * 300 + "again 45 12345678 and 87654321 too"
    base, added = pii.find_spans(text, w)
    assert [k for k, _, _ in base] == ["phone"]
    assert [(k, text[s:e]) for k, s, e in added] == [("phone", "45 12345678")]
    assert pii.masked("a +4512345678 b", [("phone", 2, 13)]) == "a <PHONE> b"
    assert pii.find_spans("1111 1111 1111 1112 twice 1111 1111 1111 1112", w)[1] == []
    spelled = "write to jo.doe@mail.example.com or jo.doe (at) mail.example (dot) com or jo.doe @ mail.example.com now"
    assert [(k, spelled[s:e]) for k, s, e in pii.find_spans(spelled, w)[1]] == [("email", "jo.doe (at) mail.example (dot) com"), ("email", "jo.doe @ mail.example.com")]
    assert pii.fit({}).unary[0, 0] > 0


def planted_repeats(texts):
    """(text, spans that repeat a pattern's in another form, decoys) of texts that have patterns' spans."""
    rng = random.Random(6)
    for text in texts:
        base = [(k, text[s:e]) for k, s, e in pii.base_spans(text)]
        if not base:
            continue
        repeats, decoys = [], []
        for kind, s in base[:3]:
            if kind == "email":
                form = s.replace("@", rng.choice([" (at) ", " [at] ", " @ "]))
            elif kind == "phone":
                form = s[1:]
            elif kind == "card":
                form = ".".join(re.findall("....|.+", pii.digits_of(s)))
            else:
                continue
            start = len(text) + 7
            text = f"{text} again {form} here"
            repeats.append((kind, start, start + len(form)))
            decoy = "".join(rng.choice("0123456789") for _ in range(rng.choice([8, 10, 12, 16])))
            decoys.append((len(text) + 7, len(text) + 7 + len(decoy)))
            text = f"{text} order {decoy} sent"
        if repeats:
            yield text, repeats, decoys


def test_pii_field_finds_planted_repeats(spark):
    """Repeats without the plus sign, with other separators or spelled out are found, decoys are not."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    field = pii.train(docs)
    right = wrong = missed = 0
    for text, repeats, _ in planted_repeats([r.text or "" for r in docs.select("text").collect()]):
        added = set(pii.find_spans(text, field)[1])
        right += len(added & set(repeats))
        missed += len(set(repeats) - added)
        wrong += len(added - set(repeats))
    print("planted repeats: precision", right / max(1, right + wrong), "recall", right / max(1, right + missed), right + missed, field.edges)
    assert right + missed > 100
    assert right / (right + wrong) > 0.95
    assert right / (right + missed) > 0.9


def test_pii_mask_keeps_columns_and_nulls(docs, rows):
    got = pii.mask(docs)
    assert got.columns == docs.columns
    p = got.toPandas()
    assert len(p) == len(rows)
    assert p[p.doc_id == 0].text.iloc[0] is None


def test_quality_machine(docs, none, labels, rows):
    got = quality_fm.classify(docs, labels).toPandas()
    assert len(got) == len(rows)
    assert got.score.between(0, 1).all()
    assert ((got.score >= 0.5).astype(int) == got.predicted).all()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in got.doc_id]).all()
    assert quality_fm.classify(none, labels).count() == 0
    blank = quality_fm.classify(docs, labels.limit(0)).toPandas()
    assert (blank.score == 0.5).all()
    assert quality_fm.score(docs, quality_fm.fit([])).columns == [*[c for c in docs.columns if c != "score"], "score", "predicted"]


def test_machine_uses_pair_interactions():
    """Labels that only a pair of features tells (exclusive or) can be learned, and the linear-time form equals all pairs."""
    rng = np.random.default_rng(0)
    data = []
    for _ in range(600):
        a, b = rng.integers(2, size=2)
        data.append(([int(a), 2 + int(b)], [1.0, 1.0], int(a != b)))
    m = quality_fm.fit(data, epochs=30)
    index, value, starts = np.array([0, 3, 0, 2]), np.ones(4, np.float32), np.array([0, 2])
    z = m.logits(index, value, starts)
    assert z[0] > 0 > z[1]
    assert z[0] == pytest.approx(m.bias + m.linear[0] + m.linear[3] + m.low_rank[0] @ m.low_rank[3], abs=1e-4)


def test_quality_held_out_accuracy(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    y = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    p = quality_fm.classify(d, y).join(y, "doc_id").where("held_out").toPandas()
    assert (p.predicted == p.quality).mean() > 0.95


def test_quality_rules_equal_brute_force(docs, none, labels, rows, text_of):
    def slow(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        seen = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        covered = {i + k for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for k in range(3)}
        return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered)

    def grams(t):
        import regex

        tokens = regex.split(r"(?<=[\p{L}\p{N}])(?=[^\p{L}\p{N} \t\n\x0b\f\r])|[ \t\n\x0b\f\r]+", t, flags=regex.V1)
        one = [xxhash.xxh64_intdigest(x.encode(), 42) for x in tokens]
        two = [xxhash.xxh64_intdigest(y.encode(), h) for h, y in zip(one, tokens[1:], strict=False)] + one[-1:]
        signed = [h - (1 << 64) if h >> 63 else h for h in one + two]
        return [h % quality_rules.BUCKETS for h in signed]

    trusted = labels.where("quality = 1").select("doc_id")
    good = {r.doc_id for r in trusted.collect()}
    raw, target = Counter(), Counter()
    for i, t, *_ in rows:
        raw.update(grams(t or ""))
        target.update(grams(t or "") if i in good else [])
    n, m = sum(raw.values()), sum(target.values())
    prior = quality_rules.SMOOTHING * m
    weight = {g: np.log((target[g] + prior * c / n) / (m + prior) / (c / n)) for g, c in raw.items()}
    got = quality_rules.apply_rules(docs, trusted).toPandas()
    assert len(got) == len(rows)
    for r in got.itertuples():
        g = grams(text_of[r.doc_id])
        assert r.llr == pytest.approx(sum(weight[x] for x in g) / len(g), abs=1e-4), r.doc_id
    for r in got.itertuples():
        want = slow(text_of[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, r.doc_id
        failed = want[0] < 50 or 100 * want[4] > 50 * want[0]
        assert r.base_failed == failed
        assert r.kept == (not failed and r.llr >= quality_rules.THRESHOLD)
    assert quality_rules.apply_rules(none, trusted).count() == 0
    assert (quality_rules.apply_rules(docs, trusted.limit(0)).toPandas().llr == 0).all()


def test_languages(docs, none, rows, spark):
    got = langid.identify(docs).toPandas()
    assert len(got) == len(rows)
    assert got.score.between(0, 1).all()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]).all()
    assert set(got[got.doc_id.isin([0, 1, 2])].lang_pred) == {"und"}
    assert langid.identify(none).count() == 0
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    p = langid.identify(d).join(d.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert (p.lang_pred == p.lang).mean() > 0.95


def test_language_spans_and_scripts():
    rows = [("en", "the cat sat on the mat with that hat"), ("de", "der hund und die katze sind nicht schön"), ("ru", "кошка и собака это хорошо")] * 5
    m = langid.fit({lang: langid.gram_counts([t for k, t in rows if k == lang]) for lang, _ in rows})
    en, de = "the cat sat on that mat with the hat ", "die katze und der hund sind nicht schön "
    assert m.predict([en * 3 + de * 10])[0][0] == "de"
    s = m.predict([en * 10 + de * 3])[0]
    assert s[0] == "en" and 0.6 < s[1] < 0.95
    assert m.predict(["собака и кошка"])[0] == ("ru", 1.0)
    assert m.predict(["123 !!", ""]) == [("und", 0.0), ("und", 0.0)]
    # Letters of a script that nobody learned are in no span.
    assert m.predict(["สวัสดีครับ ผมชื่อ", "γάτα και σκύλος"]) == [("de", 0.0), ("de", 0.0)]
    lang, share = m.predict(["the cat sat on the mat γάτα"])[0]
    assert lang == "en" and share == pytest.approx(17 / 21)
    # A run is cut where its script changes, and no first letter decides for what follows it.
    assert m.predict(["xкошка" + "исобакаэтохорошо" * 3])[0][0] == "ru"
    assert langid.units_of(["latin漢字", "漢字漢字漢字漢字", "don't", "12", "aя-я"])[0] == ["latin", "漢字", "漢字漢字漢字", "漢字", "don t", "a", "я я"]
    # The scores of units are the sums of their grams' scores, gram by gram.
    counted = {lang: Counter() for lang in m.languages}
    grams = lambda w: [f" {w} "[i : i + k] for k in range(1, 5) for i in range(len(w) + 3 - k) if k > 1 or f" {w} "[i] != " "]
    for lang, t in rows:
        counted[lang].update(g for w in t.split() for g in grams(w))
    total = {lang: sum(c.values()) + 0.5 * langid.BUCKETS for lang, c in counted.items()}
    m.predict(["katze"])
    i = int(m.ends[m.index["katze"]])
    want = np.array([sum(np.log((counted[lang][g] + 0.5) / total[lang]) for g in grams("katze")) for lang in m.languages])
    got = m.scores[i]
    latin = [m.languages.index(x) for x in ("de", "en")]
    assert got[latin[0]] - got[latin[1]] == pytest.approx(langid.WEIGHT * (want[latin[0]] - want[latin[1]]), abs=0.02)
    # The shortcut for texts of one language gives the path that the full search gives.
    rng = np.random.default_rng(1)
    for _ in range(200):
        s = rng.normal(0, 2, (12, 3))
        path = m.spans(s)
        value = lambda p: s[np.arange(12), p].sum() - langid.SWITCH * (np.diff(p) != 0).sum()
        table = s[0].copy()
        for t in range(1, 12):
            table = np.maximum(table, table.max() - langid.SWITCH) + s[t]
        assert value(path) == pytest.approx(table.max())


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a = "</p>";</script></head><body><header><p>Site</p></header><nav><ul><li><a href="/x">x</a></li></ul></nav>
<div class="cookie-banner">Accept</div><div class="share">Share</div>{open}<h1>{t} &amp; more</h1><p><b>{a}<br><p>{b}&nbsp;end <i>in</i>line</p><aside>side</aside><form><input><p>sign up</p></form>
<section id="comments"><p>reader says</p></section>{close}<div id="ad-1">Buy</div><footer>&copy; us</footer></body></html>"""


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(k, f"https://h{k % 2}.example.com/{k}", PAGE.format(open="<article>", close="</article>", t=f"Title {k}", a=f"first {k * 7}", b=f"second\n {k}"), "c") for k in range(8)]
    rows += [(20 + k, f"http://plain.example.org/{k}", PAGE.format(open='<div class="content">', close="</div>", t=f"Title {k}", a=f"first {k * 7} " * 9, b=f"second {k}").replace("Buy", "Constant words"), "c") for k in range(5)]
    rows += [(30, None, None, "c"), (31, "nonsense", "", "c"), (32, "http://h0.example.com/x", "<p>a<p>b &lt;c&gt; <div>d</div></article></b> tail <", "c"), (0, rows[0][1], rows[0][2], "c")]
    return spark.createDataFrame(rows, "page_id long, url string, html string, host string")


def test_html_extraction(pages, spark):
    got = html_extract.extract_pages(pages).toPandas()
    assert len(got) == 17
    text = got.drop_duplicates().set_index("page_id").text
    for k in range(8):
        assert text[k] == f"Title {k} & more\nfirst {k * 7}\nsecond {k} end inline"
    for k in range(5):
        assert text[20 + k].startswith(f"Title {k} & more\nfirst {k * 7}")
        assert "Constant" not in text[20 + k]
        assert "Accept" not in text[20 + k]
    assert text[30] == "" and text[31] == ""
    assert text[32] == "a\nb <c>\nd\ntail <"
    assert (got.n_chars == got.text.str.len()).all()
    assert html_extract.extract_pages(pages.limit(0)).count() == 0


def entries(page, text):
    """The entries of one text of a page."""
    return {html_extract.entry_of(path, t) for path, t in html_extract.texts_of(html_extract.parse(page)) if t == text}


def test_wrapper_finds_template_and_slots():
    page = "<body><div><p>Always here</p></div><div class='x'><p>{}</p><p>{}</p></div></body>"
    w = html_extract.induce([page.format(f"one {k} long enough to vary", f"two {k * 31}") for k in range(4)])
    assert set(w["constant"]) == entries(page, "Always here")
    assert len(w["slot"]) == 1
    copies = html_extract.induce([page.format("same", "same")] * 3)
    assert copies["constant"] == []


def test_tree_matching_equals_exhaustive_search():
    """The number of matched nodes of small random trees against a plain recursive matcher that tries all."""

    def best(p, q):
        if isinstance(p, str) or isinstance(q, str):
            return (2 if p == q else 1) if isinstance(p, str) and isinstance(q, str) else 0
        return 0 if p.name != q.name else 1 + lists(tuple(p.children), tuple(q.children))

    def lists(x, y):
        return 0 if not x or not y else max(lists(x[1:], y), lists(x, y[1:]), best(x[0], y[0]) + lists(x[1:], y[1:]))

    rng = random.Random(8)

    def tree(depth):
        inner = "".join(tree(depth - 1) for _ in range(rng.randint(0, 3))) if depth else rng.choice("ab")
        return f"<{(t := rng.choice(['div', 'section']))}>{inner}</{t}>"

    def plain(count, found):
        # Equal texts weigh two, so what is matched is worth its count and one more for each pair of equal texts.
        return count + sum(t == u for _, t, u, _ in found)

    for _ in range(60):
        a, b = html_extract.parse(tree(3)), html_extract.parse(tree(3))
        assert plain(*html_extract.matched(a, b)) == best(a, b)


def test_broken_and_deep_pages(spark):
    deep = "<div>" * 3000 + "<p>{k} inside</p>" + "</div>" * 3000 + "<p>Foot of the site</p>"
    pages = [deep.replace("{k}", f"page {k}") for k in range(3)]
    w = html_extract.induce(pages)
    assert html_extract.extract(pages[0], frozenset(w["constant"]), w["slot"]) == "page 0 inside"
    for broken in ("<a '" * 50_000, '<a =">"' * 30_000, "<p>x</p>" + "<script>" * 20_000, "<script></script" * 20_000, "<!--" * 50_000, "<b>" * 20_000 + "<p>" * 20_000, "</article>" * 50_000 + "<article>" * 20_000):
        html_extract.extract(broken)
    assert html_extract.extract("<p>a<b c='d>e' f=\"g>h\">i</b> < j <k") == "ai < j <k"
    rows = [(k, "http://a.example.com/", p) for k, p in enumerate(pages)]
    got = {r.page_id: r.text for r in html_extract.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {k: f"page {k} inside" for k in range(3)}


def test_wrappers_too_large_to_broadcast_are_salted(pages, monkeypatch):
    want = sorted(tuple(r) for r in html_extract.extract_pages(pages).collect())
    monkeypatch.setattr(html_extract, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(html_extract, "BROADCAST_ROWS", 0)
    assert sorted(tuple(r) for r in html_extract.extract_pages(pages).collect()) == want


def test_pieces_equal_the_library(rows, text_of):
    import random

    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    m = piece_viterbi.PieceModel(PIECES)
    rng = random.Random(5)
    parts = ["a", "the ", " ", "  ", "\n", "\t", "unbelievably", "é", "日本", "x" * 40, "1234", "'s", "ing", "🙂", "▁", "\r\n"]
    texts = [*text_of.values(), "", " ", "newest lowers", "internationalisation", *("".join(rng.choices(parts, k=rng.randint(1, 30))) for _ in range(500))]
    texts += ["".join(rng.choices("abcdeinrst", k=n)) for n in (255, 256, 257, 3000)] + ["z" * 1000, " " * 300, " " * 300 + "end"]
    for t, ids in zip(texts, m.encode(texts), strict=True):
        assert ids.tolist() == library.encode(t), repr(t[:80])


def test_aligned_trees_choose_the_content_not_article(spark):
    page = "<body><article><a>Teaser {k}</a></article><div class=head><h1>Title {k}</h1></div><div class=text><p>Main {k}</p><ul><li>point {k}</ul></div><div class=end><p>Always here</p></div></body>"
    rows = [(k, "http://a.example.com/", page.format(k=k)) for k in range(4)] + [(9, "http://b.example.com/", page.format(k=9))]
    got = {r.page_id: r.text for r in html_extract.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[k] == f"Teaser {k}\nTitle {k}\nMain {k}\npoint {k}" for k in range(4))
    assert got[9] == "Teaser 9"


def test_copies_and_other_layouts_leave_the_template(spark):
    page = "<body><div class=text><p>Main {k}</p></div><div class=end><p>Always here, and more of it than the rest</p></div></body>"
    copies = [(100 + k, "http://a.example.com/", page.format(k="copied")) for k in range(20)]
    odd = [(200, "http://a.example.com/", ""), (201, "http://a.example.com/", None), (202, "http://a.example.com/", "<body><table><tr><td>404</table>")]
    rows = [(k, "http://a.example.com/", page.format(k=k)) for k in range(3)] + copies + odd
    got = {r.page_id: r.text for r in html_extract.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [got[k] for k in (0, 1, 2, 100, 200, 201, 202)] == ["Main 0", "Main 1", "Main 2", "Main copied", "", "", "404"]


def test_wide_nodes_are_aligned_exactly():
    import random

    def weight(p, q) -> int:
        if isinstance(p, str) or isinstance(q, str):
            return (2 if p == q else 1) if isinstance(p, str) and isinstance(q, str) else 0
        x, y = html_extract._inner(p), html_extract._inner(q)
        above = [0] * (len(y) + 1)
        for c in x if p.name == q.name else []:
            row = [0]
            for j, d in enumerate(y):
                row.append(max(above[j + 1], row[j], above[j] + weight(c, d)))
            above = row
        return 1 + above[-1] if p.name == q.name else 0

    rng = random.Random(3)
    for n in (5, 30, html_extract.WIDE + 20):
        make = lambda n=n: html_extract.parse("".join(rng.choice(["<p>a</p>", "<p>b</p>", "<i>a</i>", "text", "<p></p>", "<div><p>a</p>b</div>", "<div><p>b</p></div>"]) for _ in range(n)))
        x, y = make().children, make().children
        best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
        for i, p in enumerate(x):
            for j, q in enumerate(y):
                best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + weight(p, q))
        total, hit = html_extract.wide_pairs(x, y, weight)
        assert total == best[-1][-1]
        assert all(a < c and b < d for (a, b), (c, d) in zip(hit, hit[1:], strict=False))
    page = "<body>{}<p>Foot of the site</p></body>"
    pages = [page.format("".join(f"<p>{k} {i}</p>" for i in range(500 + k))) for k in range(4)]
    w = html_extract.induce(pages)
    assert html_extract.extract(pages[1], frozenset(w["constant"]), w["slot"]).endswith("1 500")


def test_templates_of_all_sections_of_a_host(spark):
    page = "<body><div class=s{s}><div><p>Main {k} of {s}</p></div></div><div class=end{s}><p>Foot of section {s}</p></div></body>"
    rows = [(10 * s + k, "http://a.example.com/", page.format(k=k, s=s)) for s in range(12) for k in range(4)] * 2
    got = {r.page_id: r.text for r in html_extract.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {10 * s + k: f"Main {k} of {s}" for s in range(12) for k in range(4)}


def test_packing_cuts_plain_runs_by_the_plain_splitter(monkeypatch):
    """Also where other runs of the batch have letters beyond ASCII; the identifiers are the tokenizer's."""
    seen = []

    class Recorder:
        def findall(self, text):
            seen.append(text)
            return split.findall(text)

    split = packing.SPLIT
    monkeypatch.setattr(packing, "SPLIT", Recorder())
    made = packing.RunIds(public_tokenizers.path("word_bpe_49k.json"))
    texts = ["It's plain abc", "", "né plain ÀB", "abc 日本 <|endoftext|> 12"]
    for _ in range(2):
        ids, ends = made.encode(texts)
        found = [list(p) for p in np.split(ids, ends[:-1])]
        assert found == [made.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert seen == ["né\nàb"]


def test_every_page_of_a_host_is_counted_in_its_template(spark):
    """A text that only the page with the greatest hash says otherwise is no template, nor is one of another layout's; what a
    table's pages teach is what all of them teach in memory."""
    page = "<body><div class=text><p>Main {k}</p></div><div class=note><p>{n}</p></div><div class=end><p>Foot of the site</p></div></body>"
    other = "<body><table><tr><td>Row {k}</td></tr></table><table><tr><td>Always below</td></tr></table></body>"
    made = [page.format(k=k, n="As before") for k in range(30)]
    hashed = lambda texts: spark.createDataFrame([(t,) for t in texts], "html string").select(F.xxhash64("html").alias("key"), "html").orderBy("key").collect()
    odd = hashed(page.format(k=k, n=f"New words {k}") for k in range(10**6, 10**6 + 2000))[-1]
    assert odd.key > hashed(made)[html_extract.PAGES].key
    pages = [*made, odd.html, *(other.format(k=k) for k in range(40, 48)), "<body><img></body>", "<ul><li>Alone</ul>"]
    df = spark.createDataFrame([(k, "http://a.example.com/", t) for k, t in enumerate(pages)], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_extract.extract_pages(df).collect()}
    assert [got[k] for k in range(30)] == [f"Main {k}\nAs before" for k in range(30)]
    assert [got[31 + k] for k in range(8)] == [f"Row {40 + k}" for k in range(8)]
    assert (got[39], got[40]) == ("", "Alone")
    want = html_extract.induce([r.html for r in hashed(pages)])
    for most in (1, 2, html_extract.PAGES):
        (w,) = html_extract.wrappers(df, most).collect()
        assert set(w.constant) == set(want["constant"]) and w.slot == bool(want["slot"])

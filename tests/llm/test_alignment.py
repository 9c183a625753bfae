"""Alignment against a plain version that encodes whole texts and walks the ends of their tokens."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from terraloom.llm import alignment

A_PATH, B_PATH = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
SCHEMA = "doc_id long, text string, line string, pairs string, n_a string"


def make_texts():
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefghéü") for _ in range(rng.randint(1, 9))) for _ in range(80)]
    odd = [
        None, "", " ", "\n", "  ", " \n x", "a", "\n\nb", "tab\tand \t more\t\n", "end  ", "two  blanks   three", "line\nend\n\nand\n  more \n", "日本語のテキスト です。", "emoji 😀😀 👩‍👩‍👧 x", "U+2581 ▁ inside", "<s> </s> <unk> <|endoftext|> <0x0A>",
        "á combining", "\x00\x01 \x1c x\x1fy\x85z\xa0", "1234567890 12,345.67", "don't we'll I'd", "﻿mark", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaa" * 40, "=" * 3000, "中" * 500, "x" * 70000, "　wide blanks", "same text", "same text", "\r\nend\r\n", "क्षत्रिय हिन्दी", "𝔘𝔫𝔦" * 30,
    ]
    blanks = [" ", " ", " ", "\n", "  ", "\n\n", "\t", " ", "\x1d"]
    return odd + ["".join(rng.choice(words) + rng.choice(blanks[: rng.choice([4, 9])]) for _ in range(rng.randint(1, 200))) for _ in range(40)]


def plain(texts):
    import sentencepiece
    from tokenizers import Tokenizer

    one, other = Tokenizer.from_file(A_PATH), sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    one.encode_special_tokens = True
    value = alignment.byte_values()
    held, out = Counter(), []
    for text in texts:
        links, groups, n = Counter(), [], (0, 0)
        if text:
            a, b = one.encode(" " + text, add_special_tokens=False).ids, other.encode(text)
            spell_a = [bytes(value[c] for c in one.id_to_token(i)) for i in a]
            spell_b = [bytes([int(other.id_to_piece(i)[3:5], 16)]) if other.is_byte(i) else other.id_to_piece(i).replace("▁", " ").encode() for i in b]
            if b"".join(spell_a) == b"".join(spell_b) == (" " + text).encode():
                n = len(a), len(b)
                both = set(np.cumsum([len(x) for x in spell_a]).tolist()) & set(np.cumsum([len(x) for x in spell_b]).tolist())
                parts = []
                for ids, spelled in ((a, spell_a), (b, spell_b)):
                    cut, end, now = [], 0, []
                    for i, s in zip(ids, spelled):
                        now.append(i)
                        end += len(s)
                        if end in both:
                            cut.append(now)
                            now = []
                    parts.append(cut)
                groups = list(zip(*parts))
                for x, y in groups:
                    links.update({(i, j): cx * cy for i, cx in Counter(x).items() for j, cy in Counter(y).items()})
        held.update(links.keys())
        out.append((n, groups, links))
    best = {}
    for (i, _), k in held.items():
        best[i] = max(best.get(i, 0), k)
    rows = []
    for n, groups, links in out:
        sha = hashlib.sha256(";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups).encode()).hexdigest() if groups else ""
        rows.append((*n, len(groups), sum(links.values()), sum(k for p, k in links.items() if held[p] == best[p[0]]), sum(k * held[p] for p, k in links.items()), sha))
    return rows


@pytest.mark.parametrize(("rows_most", "work", "pairs", "memory"), [(10**6, 1 << 16, 1 << 20, 64 << 20), (0, 7, 9, 20_000)])
def test_equals_plain_version(spark, rows_most, work, pairs, memory, monkeypatch):
    texts = make_texts()
    for name, value in (("BROADCAST_ROWS", rows_most), ("WORK", work), ("PAIRS", pairs), ("MEMORY", memory)):
        monkeypatch.setattr(alignment, name, value)
    ids = [None, 2**60 + 1, 7, 7, *range(4, len(texts))]
    docs = spark.createDataFrame([(i, t, "x", "y", "z") for i, t in zip(ids, texts)], SCHEMA).repartition(3)
    got = alignment.align(docs, A_PATH, B_PATH).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()
    assert sorted(map(tuple, got), key=str) == sorted(((i, *r) for i, r in zip(ids, plain(texts))), key=str)


def test_small_pieces_and_tables_in_one_process(monkeypatch):
    """The settings above do not reach Spark's workers, so here they hold in this process."""
    monkeypatch.setattr(alignment, "PAIRS", 9)
    monkeypatch.setattr(alignment, "MEMORY", 20_000)
    cut = alignment.common_ends
    monkeypatch.setattr(alignment, "common_ends", lambda a, b: cut(a, b, 7))
    texts, aligner, got = make_texts(), alignment.Aligner(A_PATH, B_PATH), []
    for i in range(0, len(texts), 4):
        found = aligner.documents([t or "" for t in texts[i : i + 4]])
        for k in range(len(texts[i : i + 4])):
            got.append((*(found[c][k].as_py() for c in ("n_a", "n_b", "n_groups", "n_links", "groups_sha256")), sum(found["times"][k].as_py())))
    assert got == [(*r[:4], r[6], r[3]) for r in plain(texts)]


@pytest.mark.parametrize("seed", range(30))
def test_pieces_do_equal_work_and_find_every_common_end(seed):
    rng = np.random.default_rng(seed)
    a, b = (np.cumsum(rng.integers(1, 4, rng.integers(0, 60))) for _ in range(2))
    for work in (1, 2, 5, 1000):
        at_a, at_b = alignment.path_cuts(a, b, work)
        steps = np.diff(at_a + at_b)
        assert (steps[:-1] == work).all() and at_a[-1] == len(a) and at_b[-1] == len(b)
        merged = sorted([(v, 0) for v in a.tolist()] + [(v, 1) for v in b.tolist()])
        assert [sum(k == 0 for _, k in merged[:d]) for d in (at_a + at_b)] == at_a.tolist()
        got = list(zip(*(x.tolist() for x in alignment.common_ends(a, b, work))))
        assert got == [(a.tolist().index(v) + 1, b.tolist().index(v) + 1) for v in sorted(set(a.tolist()) & set(b.tolist()))]


def test_empty_table(spark):
    assert alignment.align(spark.createDataFrame([], SCHEMA), A_PATH, B_PATH).count() == 0


def test_spelled_tells_each_segment_by_itself():
    """One comparison where all are spelled; else each by itself, also where the bytes of all together are the same."""
    made = alignment.Aligner(A_PATH, B_PATH)
    segments = [" plain", " né", "\nnext"]
    a, b = [e.ids for e in made.a.encode_batch_fast(segments, add_special_tokens=False)], made.tokens_of_b(segments)
    assert made.spelled(segments, a, b) == [True] * 3
    assert made.spelled(segments, a, [b[0], [], b[2]]) == [True, False, True]
    assert made.spelled(segments, [[*a[0], *a[1]], [], a[2]], b) == [False, False, True]
    made.documents(["plain", "plain né"])
    assert len(made.index) == len(made.groups) == len(made.facts)

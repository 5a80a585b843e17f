import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest_data import ODD

from reviewloom.llm import packing
from reviewloom.llm.units import UnitIds

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def best_fit(lengths, tokens, documents, cost, rule, weights):
    """Best-fit decreasing, one piece after another."""
    capacity, bins = np.array([tokens, documents, cost], float), []
    for x in sorted(lengths, reverse=True):
        need = np.array([x, 1, x * x])
        fits = [b for b in range(len(bins)) if (bins[b] >= need).all()]
        if fits:
            score = lambda b: ((bins[b] - need) / capacity) ** 2 @ weights if rule == "norm" else -(bins[b] / capacity) @ (need / capacity * weights)
            bins[min(fits, key=score)] -= need
        else:
            bins.append(np.array([tokens, documents, cost]) - need)
    return len(bins)


def check_packing(rows, tokens, documents, cost):
    """Every sequence within all capacities and without a gap."""
    seqs = defaultdict(list)
    for r in rows:
        seqs[r.sequence_id].append((r.offset, r.length))
    for seq in seqs.values():
        at = 0
        for offset, length in sorted(seq):
            assert offset == at
            at += length
        assert at <= tokens and len(seq) <= documents and sum(n * n for _, n in seq) <= cost
    return len(seqs)


@pytest.mark.parametrize("seed", range(4))
def test_runs_equal_one_by_one(seed):
    rnd = random.Random(seed)
    lengths = [min(64, int(rnd.expovariate(1 / 12)) + 1) for _ in range(400)] + [1] * 100
    for rule, weights in packing.RULES[:1]:
        runs, bins = packing.pack_lengths(Counter(lengths), 64, 64, 4096, rule, weights)
        assert bins == best_fit(lengths, 64, 64, 4096, rule, np.array(weights))
    _, bins = packing.best_packing(Counter(lengths), 64, 64, 4096)
    assert bins <= math.ceil(sum(lengths) / 64) + 1


@pytest.mark.parametrize(("tokens", "documents", "cost"), [(64, 64, 4096), (64, 3, 4096), (64, 64, 1500), (64, 2, 900)])
def test_every_constraint_holds(tokens, documents, cost):
    rnd = random.Random(documents)
    counts = Counter(rnd.randint(1, math.isqrt(min(cost, tokens**2))) for _ in range(3000))
    for rule, weights in packing.RULES:
        runs, bins = packing.pack_lengths(counts, tokens, documents, cost, rule, weights)
        seen, got = defaultdict(list), Counter()
        for length, first, n, seq, offset in runs:
            got[length] += n
            for k in range(n):
                seen[seq + k].append((offset, length))
        assert got == counts and len(seen) == bins
        for seq in seen.values():
            at = 0
            for offset, length in sorted(seq):
                assert offset == at
                at += length
            assert at <= tokens and len(seq) <= documents and sum(n * n for _, n in seq) <= cost


def test_steps_do_not_grow_with_pieces():
    counts = {k: 10**9 + 7 * k for k in range(1, 1025)}
    runs, bins = packing.best_packing(counts, 1024, 1024, 1024**2)
    assert len(runs) < 50_000 and bins <= 1.001 * sum(k * n for k, n in counts.items()) / 1024


def test_unit_ids_equal_the_library(tokenizer):
    rnd = random.Random(5)
    parts = ["the", " cat", "\n", "  ", "\t", "é", "日本", " ", "'s", "'", "1234", "<|endoftext|>", "\x1c", " ", "😀", ".", "<|", "a" * 90, "\r\n", "\x85"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 12))) for _ in range(3000)]
    ids = UnitIds(PATH, 50)
    for a in range(0, len(texts), 100):
        part = texts[a : a + 100]
        want = [e.ids for e in tokenizer.encode_batch(part, add_special_tokens=False)]
        assert [np.frombuffer(x, "<u4").tolist() for x in ids.encode(part)] == want


def test_pieces_and_sequences(frame, tokenizer):
    rnd = random.Random(9)
    rows = [(i, " ".join(rnd.choice(["alpha", "be", "gamma ray", "<|endoftext|>", "zx9"]) for _ in range(rnd.choice([0, 2, 30, 400, 2500])))) for i in range(60)]
    rows += [(d, t) for d, t in ODD if d is not None]
    out = packing.pack_sequences(frame(rows + [(None, "no id here")]), PATH, rows_per_run=5).collect()
    check_packing(out, 1024, 1024, 1024**2)
    by_id = defaultdict(list)
    for r in out:
        by_id[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
    want = defaultdict(list)
    for d, t in [*rows, (None, "no id here")]:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
        first = len(ids) % 1024 or 1024
        edges = [0, *range(min(first, len(ids)), len(ids) + 1, 1024)]
        want[d] += [(k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False))]
    assert {d: sorted(x) for d, x in by_id.items()} == {d: sorted(x) for d, x in want.items()}
    assert len({r.sequence_id for r in out}) == best_fit([r.length for r in out], 1024, 1024, 1024**2, "norm", np.array([1, 0, 0]))


def test_empty_table(frame):
    assert packing.pack_sequences(frame([]), PATH).collect() == []


def test_every_token_is_what_its_bytes_merge_to(tokenizer):
    """What makes merging by ids the same as merging by the list (see ``byte_ranks``)."""
    words = [t for t in tokenizer.get_vocab() if t not in tokenizer.get_added_tokens_decoder().values() and t != "<|endoftext|>"]
    assert all([x.value for x in tokenizer.model.tokenize(t)] == [t] for t in words)
    assert UnitIds(PATH, 10).merger is not None


def test_ascii_units_equal_the_library(tokenizer):
    rnd = random.Random(6)
    chars = [chr(c) for c in range(128)]
    texts = ["".join(rnd.choice(chars) if rnd.random() < 0.3 else rnd.choice("etaoin srhld'") for _ in range(rnd.randint(1, 40))) for _ in range(20_000)]
    ids = UnitIds(PATH, 10**6)
    want = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in ids.encode(texts)] == want

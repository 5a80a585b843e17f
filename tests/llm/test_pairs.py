import hashlib
import random

import numpy as np
from conftest_data import ODD

from reviewloom.llm import neardup, repeats, topk
from reviewloom.llm.graph import components


def shingle_set(text, n):
    words = (text or "").encode().lower().split()
    k = min(n, len(words))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set()


def brute_components(rows, n):
    sets = [shingle_set(t, n) for _, t in rows]
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = root[i], root[j]
                root = [b if x == a else x for x in root]
    least = {}
    for (d, _), r in zip(rows, root, strict=True):
        least[r] = min(least.get(r, d), d)
    return {d: least[r] for (d, _), r in zip(rows, root, strict=True)}


def near_copies(rnd, count):
    words = ["".join(rnd.choice("aeioubcdlnrst") for _ in range(rnd.randint(2, 7))) for _ in range(900)]
    rows = []
    for _ in range(count):
        base = [rnd.choice(words) for _ in range(rnd.choice([1, 3, 8, 40, 150]))]
        for _ in range(rnd.randint(1, 6)):
            own = list(base)
            for _ in range(rnd.randint(0, 1 + len(own) // 20)):
                own[rnd.randrange(len(own))] = rnd.choice(words)
            rows.append((len(rows), " ".join(own)))
    return rows


def test_components_equal_brute_force(frame):
    rows = near_copies(random.Random(1), 120)
    for n in (4, 5):
        out = neardup.near_duplicates(frame(rows), words=n).collect()
        assert {r.doc_id: r.component_id for r in out} == brute_components(rows, n)
        assert all(r.kept == (r.doc_id == r.component_id) and r.n_shingles == len(shingle_set(rows[r.doc_id][1], n)) for r in out)


def test_large_groups_in_small_blocks(frame, monkeypatch):
    """Groups beyond one block and regions beyond their bound still give all components."""
    rnd = random.Random(2)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for d in range(300):
        own = list(base)
        for _ in range(rnd.randint(0, 4)):
            own[rnd.randrange(150)] = f"x{rnd.randrange(10**6)}"
        rows.append((d, " ".join(own)))
    monkeypatch.setattr(neardup, "BLOCK", 40)
    out = neardup.near_duplicates(frame(rows)).collect()
    assert {r.doc_id: r.component_id for r in out} == brute_components(rows, 5)


def test_nodes_with_many_copies(frame, monkeypatch):
    monkeypatch.setattr(neardup, "HOT_COPIES", 2)
    rows = near_copies(random.Random(7), 20)
    rows += [(1000 + i, rows[i % 3][1]) for i in range(30)] + [(2000 + i, None) for i in range(5)]
    out = neardup.near_duplicates(frame(rows)).collect()
    assert len(out) == len(rows) and {r.doc_id: r.component_id for r in out} == brute_components(rows, 5)


def test_no_link_between_blocks_is_lost(frame, monkeypatch):
    """A chain, where each document links to its neighbours alone, over blocks that show next to nothing of themselves."""
    words = [f"w{i}" for i in range(2000)]
    rows = [(d, " ".join(words[8 * d : 8 * d + 100])) for d in range(200)]
    monkeypatch.setattr(neardup, "BLOCK", 30)
    monkeypatch.setattr(neardup, "DELEGATES", 1)
    monkeypatch.setattr(neardup, "HUBS", 1)
    out = neardup.near_duplicates(frame(rows)).collect()
    assert {r.component_id for r in out} == set(brute_components(rows, 5).values()) == {0}


def test_regions_cover_common_prefixes():
    prefix = np.sort(np.random.default_rng(0).integers(0, 3, (5000, 6)).view([("", np.int64)] * 6).reshape(-1)).view(np.int64).reshape(-1, 6)
    for a, b in neardup._regions(prefix):
        assert 1 < b - a <= neardup.REGION and (prefix[a, :3] == prefix[b - 1, :3]).all()


def test_large_regions_lose_no_pair(spark):
    """Pairs of one sketch, apart in a region beyond REGION and over several tasks, where longer prefixes differ."""
    rng = np.random.default_rng(5)
    looks = [rng.bytes(64) for _ in range(1500)]
    order = rng.permutation(3000).tolist()
    rows = [(0, 7, (7 << 32) + at, at, i.to_bytes(16, "big"), looks[i // 2]) for i, at in enumerate(order)]
    rows += [(1, 7, 7 << 32, 0, (5000 + i).to_bytes(16, "big"), looks[i]) for i in range(2)]
    trees = spark.createDataFrame(rows, "tree int, p1 long, p2 long, p3 long, key binary, sketch binary")
    out = {tuple(sorted(int.from_bytes(x, "big") for x in r)) for r in neardup.proposed_links(trees, 100).collect()}
    assert out == {(i, i + 1) for i in range(0, 3000, 2)}


def test_pairs_among_texts_that_share_boilerplate(frame, monkeypatch):
    rnd = random.Random(8)
    rows = []
    for pair in range(60):
        base = [f"b{i}" for i in range(90)] + [f"p{pair}x{i}" for i in range(40)]
        for copy in range(2):
            own = list(base)
            for _ in range(2):
                own[90 + rnd.randrange(40)] = f"c{pair}x{copy}x{rnd.randrange(10**6)}"
            rows.append((len(rows), " ".join(own)))
    monkeypatch.setattr(neardup, "REGION", 4)
    monkeypatch.setattr(neardup, "BLOCK", 20)
    out = neardup.near_duplicates(frame(rows)).collect()
    assert {r.doc_id: r.component_id for r in out} == brute_components(rows, 5)


def test_odd_documents(frame):
    out = neardup.near_duplicates(frame(ODD)).toPandas()
    assert len(out) == len(ODD) and out[out.doc_id.isin([1, 2, 3])].n_shingles.sum() == 0
    assert set(out[out.doc_id.isin([5, 6])].component_id) == {5}
    left = neardup.drop_near_duplicates(frame(ODD))
    assert left.columns == ["doc_id", "text", "source", "kept", "size"]
    assert sorted((str(r.doc_id), len(r.text or "")) for r in left.collect()) == [("1", 0), ("2", 0), ("3", 5), ("4", 150_000), ("5", 9), ("None", 10)]
    assert neardup.drop_near_duplicates(frame(ODD[:6])).count() == 6
    assert neardup.near_duplicates(frame([])).count() == 0 and neardup.drop_near_duplicates(frame([])).count() == 0


def test_graph_components(spark):
    rnd = random.Random(4)
    edges = [(i, i + 1) for i in range(40)] + [(100, rnd.randint(101, 160)) for _ in range(40)] + [(200, 200)]
    out = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {out[i] for i in range(41)} == {0} and {v for k, v in out.items() if k >= 100} == {100} and 200 not in out


def brute_repeats(rows, width):
    seen, out = set(), []
    for _, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        b = (t or "").encode()
        gone = [False] * len(b)
        for i in range(len(b) - width + 1):
            if b[i : i + width] in seen:
                gone[i : i + width] = [True] * width
            seen.add(b[i : i + width])
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone, strict=True) if not g)).hexdigest()))
    return sorted(out)


def test_repeats_equal_brute_force(frame):
    rnd = random.Random(6)
    passages = ["".join(rnd.choice("abcé ") for _ in range(n)) for n in (60, 99, 100, 101, 180, 400)]
    rows = []
    for d in range(80):
        parts = [rnd.choice(passages) if rnd.random() < 0.5 else "".join(rnd.choice("abcdefgh ü") for _ in range(rnd.randint(0, 200))) for _ in range(6)]
        rows.append((d, "".join(parts)))
    rows += [(90, "z" * 700), (91, "z" * 99), *((None if i is None else 100 + i, t) for i, t in ODD[:4] + ODD[5:]), (200, "word " * 400)]
    for options in ({}, {"bucket_bytes": 3000}, {"bucket_bytes": 3000, "hot_bytes": 1}):
        out = repeats.remove_repeats(frame(rows), **options).collect()
        got = sorted((r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in out)
        assert got == brute_repeats(rows, 100)
    assert repeats.remove_repeats(frame([])).count() == 0


def test_difference_cover():
    assert {(a - b) % repeats.COVER for a in repeats.DIFFERENCES for b in repeats.DIFFERENCES} == set(range(repeats.COVER))


def test_top_products(spark):
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(700, 12)) * rng.exponential(size=(700, 1))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    rows += [(700, None), (750, [float("nan")] * 12), (800, [None, 1.0]), (801, [2.0]), (850, []), (None, [9.0] * 12), (900, rows[3][1]), (901, rows[3][1])]
    out = topk.top_products(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), block_rows=100, query_rows=5, probes=20, stages=(2, 5))
    clean = [(i, np.floor(256 * np.array(v + [0.0] * (12 - len(v)))).astype(int)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    expected = []
    for q, v in clean:
        if q % 50 == 0:
            best = sorted((-int(v @ c), i) for i, c in clean if i != q)[:5]
            expected += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert sorted(tuple(r) for r in out.select("query_id", "rank", "vec_id", "score").collect()) == sorted(expected)
    few = topk.top_products(spark.createDataFrame(rows[:3], "vec_id long, embedding array<double>"))
    assert few.count() == 2
    assert topk.top_products(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_words_that_a_polynomial_cannot_tell_apart(frame):
    """The Thue-Morse word of 1,024 letters and its complement have equal polynomials modulo 2**64 for any odd base."""
    one = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    other = one.translate(str.maketrans("ab", "ba"))
    out = neardup.near_duplicates(frame([(1, one), (2, other), (3, one)])).collect()
    assert {r.doc_id: r.component_id for r in out} == {1: 1, 2: 2, 3: 1}


def test_products_for_repeated_query_ids(spark):
    """Rows of one id in several blocks: the smallest vector asks, with its own length."""
    rnd = random.Random(8)
    rows = [(0, [9.0, -30.0]), (0, [-40.0, 1.0])] + [(2000 + i, [float(rnd.randint(-9, 9)), float(rnd.randint(-9, 9))]) for i in range(147)] + [(50, [0.0, 0.0])]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "vec_id long, embedding array<float>, v string, block string")
    got = [tuple(r) for r in topk.top_products(df, scale=1, block_rows=20, query_rows=1, probes=7).orderBy("query_id", "rank").collect()]
    want = []
    for q in sorted({i for i, _ in rows if i % 50 == 0}):
        v = min(x for i, x in rows if i == q)
        scored = sorted((-int(v[0] * x[0] + v[1] * x[1]), i) for i, x in rows if i != q)[:5]
        want += [(q, k, i, -s) for k, (s, i) in enumerate(scored, 1)]
    assert got == want

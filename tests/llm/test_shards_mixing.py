import zlib

import numpy as np
import pytest
from conftest_data import ODD

from reviewloom.llm import mixing, shards


def test_shards_are_gapless_and_balanced(frame):
    rng = np.random.default_rng(1)
    rows = [(i, " ".join(["w"] * int(n))) for i, n in enumerate(rng.integers(1, 400, 600))]
    rows += [(1000 + i, "copies of one text") for i in range(300)]
    out = shards.assign_shards(frame(rows), 5).toPandas()
    assert len(out) == len(rows)
    for _, g in out.groupby("shard"):
        assert sorted(g["slot"]) == list(range(len(g)))
    total = out.groupby("shard")["size"].sum()
    assert len(total) == 5 and total.max() < 1.02 * total.min()
    counts = out[out.doc_id < 1000].merge(out[out.doc_id < 1000], on="text_crc32")
    assert (counts.shard_x == counts.shard_y).all()  # only a group beyond a shard's capacity is split


def test_many_short_copies_stay_together(frame):
    rng = np.random.default_rng(2)
    rows = [(i, "é" * int(n)) for i, n in enumerate(rng.integers(200, 900, 600))]
    rows += [(1000 + i, "") for i in range(400)]  # two fifths of the rows, few of the bytes
    rows += [(2000 + i, None) for i in range(50)]
    out = shards.assign_shards(frame(rows), 5).toPandas()
    texts = dict(rows)
    homes = out.groupby(out.doc_id.map(lambda i: (texts[i] is None, texts[i]))).shard.nunique()
    assert homes.max() == 1
    total = out.groupby("shard")["size"].sum()
    assert len(total) == 5 and total.max() < 1.02 * total.min()
    for r in out.itertuples():
        data = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(data) + 16, zlib.crc32(data))


def test_shards_of_odd_rows(frame):
    out = shards.assign_shards(frame(ODD), 3).toPandas()
    assert len(out) == len(ODD)
    null_text = out[out.doc_id == 1].iloc[0]
    assert null_text["size"] == 16 and null_text.text_crc32 == 0
    assert shards.assign_shards(frame([]), 3).count() == 0


def test_place_prefers_highest_dot_product():
    homes = shards.place(np.array([[4.0, 4, 1], [3, 3, 1], [2, 2, 1], [1, 1, 1]]), 2)
    assert homes[0] == homes[3] != homes[1] == homes[2]


def test_water_fill_shares_the_excess():
    got = mixing.water_fill([100, 10, 50], [3, 1, 2], 1.5, 2)
    assert got == pytest.approx([132, 20, 88])
    assert all(t <= 2 * s + 1e-9 for t, s in zip(got, [100, 10, 50], strict=True))
    assert mixing.water_fill([0, 0], [3, 1], 1.5, 2) == [0.0, 0.0]


def test_quotas_are_exact():
    q = mixing.split_quotas([7, 0, 30], 5, np.random.default_rng(0))
    assert q.sum(axis=0).tolist() == [7, 0, 30] and q.min() >= 0 and set(q.sum(axis=1)) <= {7, 8}


def test_mix_comes_near_its_targets(frame):
    rng = np.random.default_rng(2)
    rows = [(i, "w " * int(n), f"s{i % 4}" if i % 9 else None) for i, n in enumerate(rng.integers(0, 60, 3000))]
    rows += [(9000 + i, "w " * 20, "s1") for i in range(4000)]
    first, again = (mixing.mix_sources(frame(rows)).orderBy("doc_id").toPandas() for _ in range(2))
    assert first.taken.equals(again.taken) and first.shards.map(list).equals(again.shards.map(list))
    assert (first.taken <= 2 * first["size"]).all() and (first.taken == first.copies * first["size"]).all()
    for _, g in first.groupby("source", dropna=False):
        assert abs(g.taken.sum() - g.target.iloc[0]) <= 60
    assert first["shards"].map(len).eq(first.copies).all()


def test_mix_with_a_text_of_half_its_source(frame):
    for long in range(6):
        rows = [(i, "w " * 100, "even") for i in range(400)] + [(1000 + long, "w " * 40_000, "even")]
        rows += [(2000 + i, "w " * 20, "fine") for i in range(2000)] + [(5000 + long, "w " * 60_000, "fine")]
        out = mixing.mix_sources(frame(rows), weights=(1,)).toPandas()
        for _, g in out.groupby("source"):
            assert abs(g.taken.sum() - g.target.iloc[0]) <= 0.002 * g.source_size.iloc[0]


def test_long_texts_leave_what_short_ones_can_fill():
    for at in range(0, 201, 20):
        sizes = [200] * at + [60_000] + [200] * (200 - at)
        for rest, short, near in ((65_000, 0, 0), (60_000, 0, 0), (50_000, 0, 10_000), (30_000, 0, 0), (45_000, 5_000, 0), (62_500, 0, 100)):
            got = sum(sizes[k] for k in mixing.choose_long(sizes, rest, short))
            assert rest - short - near <= got <= rest + near
    assert mixing.choose_long([], 10, 10) == []


def test_mix_and_draw_of_odd_rows(frame):
    out = mixing.mix_sources(frame(ODD)).toPandas()
    assert len(out) == len(ODD) and out[out["size"] == 0].taken.sum() == 0
    drawn = mixing.draw(frame(ODD))
    assert drawn.columns == ["doc_id", "text", "source", "kept", "size"] and drawn.count() == out.copies.sum()
    assert mixing.mix_sources(frame([])).count() == 0 and mixing.draw(frame([])).count() == 0

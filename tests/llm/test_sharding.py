import random
import zlib
from collections import Counter, defaultdict

from tickwise.llm import sharding as S


def check(rows, got, shards, spare):
    assert len(got) == len(rows)
    texts = {i: t for i, t in rows}
    sizes, slots = defaultdict(int), defaultdict(list)
    for r in got:
        raw = (texts[r.doc_id] or "").encode()
        assert r.size == len(raw) + 16 and r.text_crc32 == zlib.crc32(raw) and 0 <= r.shard < shards
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    mean = sum(sizes.values()) / shards
    assert all(abs(sizes[s] - mean) <= spare for s in range(shards)), (mean, dict(sizes))
    groups = defaultdict(set)
    for r in got:
        if texts[r.doc_id] is not None:
            groups[texts[r.doc_id]].add(r.shard)
    return {t: len(s) for t, s in groups.items()}, mean


def test_even_and_whole(spark, docs_of):
    rng = random.Random(1)
    rows = [(i, "x" * rng.choice([0, 5, 50, 500, 3000]) + str(i)) for i in range(1500)]
    for g in range(60):
        rows += [(10_000 + 100 * g + k, f"group {g} é " * 20) for k in range(rng.randrange(2, 9))]
    rows += [(90_000, None), (90_001, None), (90_002, ""), (90_003, "")]
    got = S.sharded(docs_of(rows), 8).collect()
    homes, _ = check(rows, got, 8, 200)
    copies = Counter(t for _, t in rows)
    parted = sum(homes[t] > 1 for t in homes if copies[t] > 1)
    assert parted <= 3 and {r.law for r in got} == {"bytes"} and {r.grown_shard for r in got} == {None}


def test_a_group_larger_than_a_shard_takes_few(spark, docs_of):
    rows = [(i, "same text " * 30) for i in range(400)] + [(1000 + i, f"other {i} " * 20) for i in range(700)]
    got = S.sharded(docs_of(rows), 8).collect()
    homes, mean = check(rows, got, 8, 700)
    assert homes["same text " * 30] <= -(-400 * 316 // mean) + 2


def test_all_linked_none_and_few(spark, docs_of):
    rows = [(i, f"t{i // 2} " * 40) for i in range(600)]
    check(rows, S.sharded(docs_of(rows), 8).collect(), 8, 400)
    assert S.sharded(docs_of([])).count() == 0
    got = S.sharded(docs_of([(1, "a"), (None, None), (1, "a")])).collect()
    assert len(got) == 3 and len({(r.shard, r.slot) for r in got}) == 3


def test_level():
    import numpy as np
    assert S.level(np.array([5.0, 1.0, 9.0]), 6).tolist() == [1.0, 5.0, 0.0]
    assert S.level(np.array([0.0, 0.0]), 0).tolist() == [0.0, 0.0]
    assert S.level(np.array([1.0, 3.0]), 10).tolist() == [6.0, 4.0]


def test_few_groups_are_parted_however_many_are_linked(spark, docs_of):
    """Pairs and groups of three, nine tenths and all of the documents linked."""
    for copies, alone in [(2, 0), (2, 300), (3, 0)]:
        rows = [(i, f"text {i // copies:05d} " * 20) for i in range(1500 * copies)]
        rows += [(100_000 + i, f"alone {i:04d} " * 20) for i in range(alone)]
        homes, _ = check(rows, S.sharded(docs_of(rows), 10).collect(), 10, 600)
        assert sum(homes[t] > 1 for t in homes) <= 2 * 10, (copies, alone)


def test_what_leaves_a_shard_makes_room():
    import numpy as np
    flow = np.array([[0.0, 4.0, 0.0], [0.0, 0.0, 4.0], [0.0, 0.0, 0.0]])
    assert S.admitted(flow, np.array([10.0, 10.0, 6.0]), 10.0).tolist() == [0.0, 1.0, 1.0]
    assert S.admitted(flow, np.array([10.0, 10.0, 10.0]), 10.0).tolist() == [0.0, 0.0, 0.0]

from tickwise.llm import mixing as M


def brute_targets(sizes, weights=(3, 1, 2), total=1.5, cap=2):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    need, free, out = total * sum(sizes.values()), set(names), {}
    while free:
        rate = need / sum(w[s] for s in free)
        over = {s for s in free if w[s] * rate >= cap * sizes[s]}
        if not over:
            return out | {s: w[s] * rate for s in free}
        for s in over:
            out[s] = cap * sizes[s]
            need -= out[s]
        free -= over
    return out


def test_targets_and_draws(docs_of):
    rows = [(i, "a b\tc\nd " * (i % 17), [None, "b", "a", "é", "z"][i % 5]) for i in range(2000)] + [(5000, None, "a"), (None, "x y", "b"), (5001, "", "b")]
    got = M.rated(docs_of(rows)).collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want, taken = brute_targets(sizes), {}
    for r in got:
        assert abs(r._target - want[r.source]) < 1e-6 and r._source_size == sizes[r.source] and 0 <= r._copies <= 2
        taken[r.source] = taken.get(r.source, 0) + r._copies * r._size
    for s in sizes:
        assert abs(taken[s] - want[s]) < 0.12 * want[s], s
    again = {(r.doc_id, r._copies) for r in M.rated(docs_of(rows[::-1])).collect()}
    assert again == {(r.doc_id, r._copies) for r in got}


def test_mix_repeats_rows_and_keeps_columns(docs_of):
    d = docs_of([(1, "a b", "s"), (1, "a b", "s"), (2, "c", "t")])
    m = M.mix(d)
    assert m.columns == d.columns
    by = {r.doc_id: r._copies for r in M.rated(d).collect()}
    assert m.count() == 2 * by[1] + by[2]


def test_empty_and_wordless(docs_of):
    assert M.mix(docs_of([])).count() == 0
    assert [r._target for r in M.rated(docs_of([(1, "", "s"), (2, None, None)])).collect()] == [0.0, 0.0]


def test_mix_keeps_columns_of_any_name(spark):
    rows = [(i, "a b c", "s", 7, 8, 9, 10, "r") for i in range(50)]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string, _n int, _size int, _copies int, _target int, _row string")
    m = M.mix(d)
    assert m.columns == d.columns and {tuple(r)[1:] for r in m.collect()} == {rows[0][1:]}
    assert {r._size for r in M.rated(d).collect()} == {3}

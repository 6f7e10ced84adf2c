import numpy as np

from tiermart.llm.components import connected_components
from tiermart.llm.vectors import MISS, SAMPLE, TREES, _cells, _grow, _walk, leaves, near_duplicate_vectors

SCHEMA = "vec_id long, embedding array<float>, label int, kept boolean, n_links string"


def expected(rows, least=0.98):
    """Compare everything with everything."""
    good = []
    for vec_id, values, label in rows:
        usable = (
            vec_id is not None and label is not None and values
            and all(v is not None and np.isfinite(np.float32(v)) for v in values) and any(values)
        )
        x = np.array(values, dtype=np.float32).astype(float) if usable else None
        good.append(x / np.linalg.norm(x) if usable else None)
    n = len(rows)
    links = [
        [j for j in range(n) if j != i and good[i] is not None and good[j] is not None
         and rows[i][2] == rows[j][2] and len(good[i]) == len(good[j]) and good[i] @ good[j] >= least]
        for i in range(n)
    ]
    out = []
    for i in range(n):
        seen, waiting = {i}, [i]
        while waiting:
            for j in links[waiting.pop()]:
                if j not in seen:
                    seen.add(j)
                    waiting.append(j)
        ids = [rows[j][0] for j in seen]
        smallest = None if rows[i][0] is None else min(ids)
        out.append((rows[i][0], len(links[i]), smallest, smallest is None or smallest == rows[i][0]))
    return sorted(out, key=repr)


def cloud(rng, n, size, spread):
    centre = rng.standard_normal(size)
    return [(centre + spread * rng.standard_normal(size)).astype(np.float32).tolist() for _ in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, None, "x") for r in rows], SCHEMA)


def result(df):
    assert df.columns == ["vec_id", "n_links", "component_id", "kept"]
    return sorted(map(tuple, df.collect()), key=repr)


def test_against_all_pairs(spark):
    rng = np.random.default_rng(1)
    vectors = [v for _ in range(30) for v in cloud(rng, 4, 16, 0.15)]
    vectors += cloud(rng, 60, 16, 0.1) + [vectors[0]] * 5
    rows = [(i, v, i % 2) for i, v in enumerate(vectors)]
    rows += [(500, None, 1), (501, [0.0] * 16, 1), (502, [None, 1.0], 1), (503, [float("nan")] * 16, 1)]
    rows += [(504, vectors[0], None), (None, vectors[0], 0), (505, [], 0), (506, [1.0, 2.0], 0)]
    rows += [rows[3], (3, vectors[9], 1)]  # a repeated row, and an id with another vector
    want = expected(rows)
    got = result(near_duplicate_vectors(frame(spark, rows)))
    repeated = {3}
    assert [r for r in got if r[0] not in repeated and r[2] not in repeated] == [
        r for r in want if r[0] not in repeated and r[2] not in repeated
    ]
    assert len(got) == len(rows)
    # several cells and blocks for one label give the same
    assert result(near_duplicate_vectors(frame(spark, rows), cell=40, block=16)) == got


def test_copies_that_differ_by_rounding_only(spark):
    """Scaled copies are not equal after rounding, and no direction tells them apart."""
    rng = np.random.default_rng(5)
    base = rng.standard_normal(8)
    rows = [(i, (base * (1 + i / 7)).tolist(), 1) for i in range(400)]
    rows += [(1000 + i, rng.standard_normal(8).tolist(), 1) for i in range(50)]
    want = expected(rows)
    assert sum(r[1] == 399 for r in want) >= 400
    assert result(near_duplicate_vectors(frame(spark, rows), cell=64, block=50)) == want


def test_cells_are_small_and_bounded_in_number(spark):
    rng = np.random.default_rng(6)
    vectors = rng.standard_normal((6000, 12))
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    same = np.ones((300, 12)) / 12**0.5
    rows = [(i, "a", v.tobytes()) for i, v in enumerate(vectors)]
    rows += [(10_000 + i, "b", v.tobytes()) for i, v in enumerate(same)]
    found = _cells(spark.createDataFrame(rows, "node long, label string, unit binary"), 100).collect()
    sizes, places = {}, {}
    for row in found:
        sizes[row.cell] = sizes.get(row.cell, 0) + 1
        places[row.node] = places.get(row.node, 0) + 1
    assert set(places) == {r[0] for r in rows} and min(places.values()) >= TREES
    assert max(sizes.values()) <= 160
    assert len(found) < 4 * TREES * len(rows)


def test_no_rows(spark):
    assert result(near_duplicate_vectors(frame(spark, []))) == []
    assert result(near_duplicate_vectors(frame(spark, [(1, None, None)]))) == [(1, 0, 1, True)]


def test_leaves_cover_all_rows_and_are_small():
    rng = np.random.default_rng(2)
    dense = 1 + 0.01 * rng.standard_normal((3000, 8))
    vectors = np.concatenate([rng.standard_normal((500, 8)), dense])
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    parts = list(leaves(vectors, 0, 100))
    assert set(np.concatenate(parts)) == set(range(3500))
    assert max(map(len, parts)) <= 100 and sum(map(len, parts)) < 4 * 3500
    assert [len(x) for x in leaves(np.ones((300, 3)), 0, 100)] == [300]


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 2), (5, 5), (None, 1), (9, 8), (8, 7), (7, 6), (6, 10), (4, 3)]
    edges += [(100, i) for i in range(101, 150)] + [(i, i + 1) for i in range(200, 240)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    want = {i: 1 for i in (1, 2, 3, 4)} | {i: 6 for i in range(6, 11)}
    want |= {i: 100 for i in range(100, 150)} | {i: 200 for i in range(200, 241)}
    assert got == want
    assert connected_components(spark.createDataFrame([], "a long, b long"), "a", "b").collect() == []


def met(n, alike, limit, pairs=200, size=64):
    """Share of lone pairs of cosine 0.981 that some tree brings together, and the number of trees, among
    vectors with about `alike` as cosine to each other."""
    rng = np.random.default_rng(8)
    centre = rng.standard_normal(size)
    vectors = rng.standard_normal((n, size))
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    vectors = alike**0.5 * centre / np.linalg.norm(centre) + (1 - alike) ** 0.5 * vectors
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    one, aside = vectors[:pairs], rng.standard_normal((pairs, size))
    aside -= (aside * one).sum(axis=1)[:, None] * one
    aside /= np.linalg.norm(aside, axis=1)[:, None]
    vectors = np.concatenate([vectors, 0.981 * one + (1 - 0.981**2) ** 0.5 * aside])
    sample = vectors[rng.choice(len(vectors), SAMPLE, replace=False)]
    trees = {}
    for point in _grow("c", sample, len(vectors), limit, 0.2, True):
        trees.setdefault(point["tree"], {})[point["node"]] = point["middle"], point["strip"]
    found = np.zeros(pairs, dtype=bool)
    for _, _, rows in _walk("c", vectors, trees, {}):
        found |= np.isin(np.arange(pairs), rows) & np.isin(np.arange(n, n + pairs), rows)
    return found.mean(), len(trees)


def test_dense_labels_get_more_trees_and_lose_no_pairs():
    loose, few = met(60_000, 0.0, 512)
    dense, many = met(60_000, 0.95, 512)
    assert loose >= 1 - 2 * MISS and dense >= 1 - 2 * MISS
    assert few == TREES < many

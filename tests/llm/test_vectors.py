import brute
import numpy as np

from strata.llm import vectors as V


def _expected(rows, min_cos=.95):
    ok, ids = [], []
    out = []
    for i, v in rows:
        a = None if v is None else np.array([np.nan if c is None else c for c in v], float)
        if i is None or a is None or len(a) != 16 or not np.isfinite(a).all() or not a.any():
            out.append((i, 0, i, True))
        else:
            ok.append(a / np.linalg.norm(a))
            ids.append(i)
    x, parent = np.array(ok), brute.forest(len(ok))
    near = x @ x.T >= min_cos
    for a, b in zip(*np.nonzero(np.triu(near, 1))):
        brute.union(parent, int(a), int(b))
    low = {}
    for i, vid in enumerate(ids):
        r = brute.find(parent, i)
        low[r] = min(low.get(r, vid), vid)
    for i, vid in enumerate(ids):
        c = low[brute.find(parent, i)]
        out.append((vid, int(near[i].sum()) - 1, c, vid == c))
    return sorted(out, key=str)


def _rows(seed=4):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(40, 16))
    rows = []
    for i in range(900):
        rows.append((i, (base[i % 40] + rng.normal(size=16) * rng.choice([0, .05, .2, 2])).astype(np.float32).tolist()))
    return rows


def test_links_and_components_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(V, "BLOCK", 64)  # several blocks a list
    rows = _rows()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 as id", "2 as v", "3 as list")
    got = sorted((tuple(r) for r in V.near_vectors(df).collect()), key=str)
    want = _expected(rows)
    links = sum(w[1] for w in want)
    assert links > 1000
    # Recall of links, and no link that is none.
    by = {r[0]: r for r in got}
    found = sum(min(by[w[0]][1], w[1]) for w in want)
    assert found >= .99 * links and all(by[w[0]][1] <= w[1] for w in want)
    assert np.mean([g == w for g, w in zip(got, want)]) > .97


def test_odd_vectors(spark):
    v = [float(i) for i in range(16)]
    rows = [(1, v), (2, v), (2, v), (3, [2 * c for c in v]), (4, None), (5, []), (6, [0.0] * 16), (7, v[:-1] + [None]),
            (8, v[:-1] + [float("nan")]), (9, v[:-1] + [float("inf")]), (10, [1.0] * 3), (None, v), (11, [-c for c in v])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted((tuple(r) for r in V.near_vectors(df).collect()), key=str) == _expected(rows)
    assert V.near_vectors(df.where("false")).count() == 0
    assert V.near_vectors(df.where("vec_id in (4, 5)")).count() == 2


def test_approximate_cosines_are_within_their_margin():
    x = np.random.default_rng(1).normal(size=(2000, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    index = V.Index(x, 10, .95)
    own = V.nearest(x, index.lists)
    back = index.lists[own] + index.decode(index.encode(x - index.lists[own]))
    y = x + np.random.default_rng(2).normal(size=x.shape) * .04
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    gap = np.abs((y * back).sum(axis=1) - (y * x).sum(axis=1))
    assert (gap <= V.ADC_SIGMAS * index.error).mean() > .999


def test_links_beside_a_group_of_near_copies(spark):
    """A large group that its codes fit well must not hide the links of the
    vectors that they fit badly: counted per vector, not per link."""
    rng = np.random.default_rng(5)

    def unit(x):
        return x / np.linalg.norm(x, axis=1, keepdims=True)
    a = unit(rng.normal(size=(300, 64)))
    t = rng.normal(size=a.shape)
    t = unit(t - (t * a).sum(axis=1, keepdims=True) * a)
    c = rng.uniform(.955, .99, (300, 1))
    group = unit(rng.normal(size=(1, 64))) + rng.normal(size=(900, 64)) * .05 / 8
    x = np.concatenate([a, c * a + np.sqrt(1 - c * c) * t, group])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in V.near_vectors(df).collect()}
    near = unit(x) @ unit(x).T >= .95
    found = [got[i][0] == near[i].sum() - 1 for i in range(len(x))]
    assert np.mean(found[:600]) > .99 and np.mean(found[600:]) > .99
    assert np.mean([got[i][1] == got[i + 300][1] for i in range(300)]) > .99


def test_every_length_is_compared(spark):
    rng = np.random.default_rng(6)
    x, y = rng.normal(size=(30, 16)), rng.normal(size=(5, 7))
    rows = list(enumerate([*x.tolist(), *x[:3].tolist(), *y.tolist(), *y[:2].tolist(), (y[2] * 1.5 + .001).tolist()]))
    # Huge and tiny finite components; an id of vectors of two lengths is one node.
    rows += [(50, [1e200, 2e200, 3.0]), (51, [1e-200, 2e-200, 0.0]), (60, (2 * x[9]).tolist()), (60, (3 * y[4]).tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in V.near_vectors(df).collect()}
    pairs = {30: 0, 31: 1, 32: 2, 38: 33, 39: 34, 40: 35, 51: 50}
    for a, b in pairs.items():
        assert got[a] == got[b] == (1, b)
    assert got[9][1] == got[37][1] == got[60][1] == 9
    assert all(got[i] == (0, i) for i in (3, 10, 29, 36))


def test_an_id_with_unlike_vectors_joins_their_groups(spark):
    a, b, c, d = np.eye(4)[:, :].tolist()
    rows = [(1, a), (2, a), (2, b), (3, b),  # 2 holds a and b
            (10, c), (15, c), (12, d), (15, d), (16, (np.array(d) * 2 + .01).tolist())]  # 15 is the smallest of neither
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = V.near_vectors(df).collect()
    assert sorted((r.vec_id, r.component_id) for r in got) == [(1, 1), (2, 1), (2, 1), (3, 1), (10, 10), (12, 10), (15, 10), (15, 10), (16, 10)]
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)

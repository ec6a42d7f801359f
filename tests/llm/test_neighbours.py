import numpy as np

from inkwell.llm import neighbours as N


def brute(ids, vecs, k=5):
    v = np.asarray(vecs, dtype=np.float64)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    cos = np.round(v @ v.T, 9)
    out = set()
    for i, name in enumerate(ids):
        best = sorted((-cos[i, j], other) for j, other in enumerate(ids) if j != i)[:k]
        out |= {tuple(sorted((name, o))) for _, o in best}
    return out


def make(spark, n=900, extra=True):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(40, 64))
    vecs = (centres[rng.integers(0, 40, n)] + 0.4 * rng.normal(size=(n, 64))).astype(np.float32)
    vecs[10] = vecs[11] * 2.5
    vecs[300:620] = vecs[300]  # a third of all rows has one vector
    ids = [f"k{(i * 7919) % n:04d}" for i in range(n)]
    rows = [(i, v.tolist(), 1, "x") for i, v in zip(ids, vecs)]
    if extra:
        bad = [[0.0] * 64, [1.0] * 63, [float("nan")] + [1.0] * 63, [None] + [1.0] * 63, None, [float("inf")] * 64]
        rows += [(f"bad{i}", b, 1, "x") for i, b in enumerate(bad)] + rows[:20] + [(None, vecs[0].tolist(), 1, "x"), (ids[5], vecs[6].tolist(), 0, "x")]
    return ids, vecs, spark.createDataFrame(rows, "chunk_id string, embedding array<float>, embedded_at int, rank string")


def test_recall_against_brute_force(spark):
    ids, vecs, df = make(spark)
    found = {tuple(r) for r in N.neighbour_pairs(N.neighbours(df)).collect()}
    want = brute(ids, vecs)
    assert len(found & want) >= 0.95 * len(want)
    assert len(found) <= 1.05 * len(want)


def test_every_cell_visited_is_exact(spark):
    ids, vecs, df = make(spark)
    found = {tuple(r) for r in N.neighbour_pairs(N.neighbours(df, candidates=10**9)).collect()}
    assert found == brute(ids, vecs)


def test_a_vector_of_many_ids_is_joined_in_parts(spark, monkeypatch):
    monkeypatch.setattr(N, "_HOT", 100)
    ids, vecs, df = make(spark)
    assert {tuple(r) for r in N.neighbour_pairs(N.neighbours(df, candidates=10**9)).collect()} == brute(ids, vecs)


def test_few_and_no_vectors(spark):
    ids, vecs, df = make(spark, 900, False)
    three = spark.createDataFrame([(f"k{i}", vecs[i].tolist(), 1) for i in range(3)], "chunk_id string, embedding array<float>, embedded_at int")
    assert N.neighbours(three).count() == 6
    assert N.neighbours(three.limit(0)).count() == 0
    assert N.neighbours(three.limit(1)).count() == 0


def test_cells_come_in_order_of_summed_distance():
    rng = np.random.default_rng(1)
    d1, d2 = rng.random(9), rng.random(7)
    o1, o2 = d1.argsort(), d2.argsort()
    counts = rng.integers(0, 3, (9, 7)).tolist()
    got = N.visit(d1[o1].tolist(), d2[o2].tolist(), o1.tolist(), o2.tolist(), counts, 10**9)
    sums = [d1[a] + d2[b] for a, b in got]
    assert sums == sorted(sums) and len(got) == int((np.array(counts) > 0).sum())


def test_candidates_by_default(spark):
    """Of 1,450 vectors without any clusters the default reaches each, so the answer is exact."""
    vecs = np.random.default_rng(9).normal(size=(1450, 64)).astype(np.float32)
    ids = [f"k{i:04d}" for i in range(len(vecs))]
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in zip(ids, vecs)], "chunk_id string, embedding array<float>, embedded_at int")
    assert {tuple(r) for r in N.neighbour_pairs(N.neighbours(df, centroids=32)).collect()} == brute(ids, vecs)


def test_units_hold_every_entry_once():
    rng = np.random.default_rng(3)
    counts = rng.integers(0, 40, (7, 9)) * (rng.random((7, 9)) < 0.5)
    counts[2, 3] = 250
    slices, begins = N.units_of(counts, 60)
    seen = np.zeros((7, 9), int)
    for u in range(len(begins) - 1):
        part = slices[:, begins[u] : begins[u + 1]]
        assert len(set(part[0])) == 1 and 0 < (part[3] - part[2]).sum() < 120 and (part[3] - part[2]).max() <= 60
        for a, b, lo, hi in part.T:
            assert lo == seen[a, b]
            seen[a, b] = hi
    assert (seen == counts).all()
    assert N.units_of(np.zeros((2, 2), int), 5)[1].tolist() == [0]


def test_tiles_give_the_cells_of_the_heap():
    rng = np.random.default_rng(2)
    for shape, share, enough in (((40, 50), 0.4, 300), ((33, 7), 0.05, 10), ((64, 64), 1.0, 10**9), ((20, 20), 0.02, 5)):
        d1, d2 = rng.random(shape[0]), rng.random(shape[1])
        o1, o2 = d1.argsort(), d2.argsort()
        counts = rng.integers(1, 9, shape) * (rng.random(shape) < share)
        want = N.visit(d1[o1].tolist(), d2[o2].tolist(), o1.tolist(), o2.tolist(), counts.tolist(), enough)
        assert {tuple(x) for x in N.stream(d1[o1], d2[o2], o1, o2, counts, enough).T.tolist()} == set(want)


def test_copies_make_no_cells(spark, monkeypatch):
    """Cells and candidates go by different vectors: of 300 vectors in 40 copies the cells are those of 300."""
    made = []
    monkeypatch.setattr(N, "codebook", lambda points, k, *x, f=N.codebook, **y: made.append(k) or f(points, k, *x, **y))
    vecs = np.random.default_rng(6).normal(size=(300, 64)).astype(np.float32)
    df = spark.createDataFrame([(f"{c:02d}-{i:03d}", v.tolist(), 1) for c in range(40) for i, v in enumerate(vecs)], "chunk_id string, embedding array<float>, embedded_at int")
    found = N.neighbours(df).where("chunk_id = '07-123'").orderBy("rank").collect()
    assert [r.neighbour for r in found] == ["00-123", "01-123", "02-123", "03-123", "04-123"]
    assert made == [4, 4]


def test_cells_that_lie_apart_are_read_alone(tmp_path):
    """A block takes no more bytes of the index than its own candidates have, whatever lies around them."""
    import pyarrow as pa

    class Sum:
        n = 0

        def add(self, x):
            self.n += x

    rng = np.random.default_rng(8)
    n, dim = 20_000, 64
    vecs = rng.normal(size=(n, dim)).astype(np.float32)
    a, b = np.sort(rng.integers(0, 4, n)), rng.integers(0, 500, n)
    b = np.concatenate([np.sort(b[a == x]) for x in range(4)])
    names = ["a", "b", "k1", "k2", "vec", "ids"]
    rows = [pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32)), pa.array(np.arange(n)), pa.array(np.arange(n)), pa.array([x.tobytes() for x in N.packed(vecs)], pa.binary()), pa.array([[f"é{i}"] for i in range(n)], pa.list_(pa.string()))]
    name, (ca, cb, held) = N.write_cells(f"file://{tmp_path}/index", iter(pa.RecordBatch.from_arrays(rows, names=names).slice(x, 777) for x in range(0, n, 777)))
    counts, places = np.zeros((4, 500), np.int32), np.zeros((2, 4, 500), np.int32)
    counts[ca, cb], places[1][ca, cb] = held, np.cumsum(held) - held
    assert counts.sum() == n
    asked = np.array([0, 1, 3]), np.array([7, 499, 250])
    for mapped in (True, False):
        index = N.Cells(f"file://{tmp_path}/index", [name], places, counts, dim)
        index.mapped, index.reading = mapped, Sum()
        number, place = index.rows_of(*asked)
        want = np.concatenate([np.nonzero((a == x) & (b == y))[0] for x, y in zip(*asked)])
        got = index.vectors(number, place)
        assert (np.abs(N.unit(got[:, :dim])[0] - N.unit(vecs[want])[0]) < 1e-12).all()
        assert index.ids(number, place) == [[f"é{i}"] for i in want] and (index.keys(number, place)[:, 0] == want).all()
        assert index.reading.n == len(want) * (dim + 1) * 4

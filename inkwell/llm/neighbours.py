"""Problem 5: the most similar vectors of every vector, by an inverted multi-index.

The two halves of the unit vectors are quantised apart, with codebooks of `centroids` entries each
trained on a bounded sample. Every vector is in the cell of its two nearest centroids. The index is a
folder of Arrow files in the shared folder, each cell in one stretch of one of them; workers map the files
where the folder can be opened by path, so that a cell costs what its own vectors take, whatever lies
around it. Queries of one cell are a block. A heap over the two sorted lists of distances (multi-sequence) gives cells in the order
of the summed distance of their centroids to the block's halves, a centroid's distance to a block being
that to the nearest query of it. Of these cells each query takes those nearest to itself by the same sum,
until they hold enough candidates; so the heap runs once a block and the choice is every query's own. The
block is answered over all cells that one of its queries took: cosines as a matrix product, the best of
them reranked exactly in double precision.

Equal vectors are one entry with its least ids, so that a vector of a third of all rows costs one query.
"""

from __future__ import annotations

import ctypes
import glob
import heapq
import os
import uuid
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.session import cut, scratch_table

DIM = 64
#: Vectors that the codebooks are trained on, about so many or 32 a centroid; all vectors are indexed.
SAMPLE = 16_384
#: Centroids of a half at most: 2^22 cells.
MOST_CENTROIDS = 2_048
#: Different vectors of a cell on average, before rounding. Coarser cells cost recall: 61 a cell of a million vectors gave 0.936, 15 gave 0.989.
CELL = 28
#: Candidates that a query's cells must hold, for up to GROWS_FROM different vectors; for more of them the
#: number grows with the fourth root of theirs.
CANDIDATES = 1_500
GROWS_FROM = 20_000
#: The heap goes on until its cells hold so many times the candidates of a query.
_STREAM = 12
#: Queries of a block at most.
_TOGETHER = 64
#: Centroids of a side of a tile, the heap's step.
_TILE = 16
#: An equal vector of more than so many ids, or of a thousandth of all, is joined in _SALTS parts.
_HOT = 10_000
_SALTS = 64
#: What a worker keeps of an index that it can't map.
_CACHE_BYTES = 160 << 20
#: Entries of a group, the least that is read where files can't be mapped; all groups of a file but the last are full.
_GROUP = 1_500
_OPEN_FILES = 500


def is_valid(vector: Column, dim: int = DIM) -> Column:
    """Whether a vector has dim components, none null, NaN or infinite, and not all zero."""
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & (F.size(vector) == dim) & F.coalesce(whole, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def unit(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(double-precision vectors of length 1, the same in single precision)."""
    wide = raw.astype(np.float64)
    wide /= np.abs(wide).max(axis=1, keepdims=True)
    wide /= np.sqrt((wide * wide).sum(axis=1, keepdims=True))
    return wide, wide.astype(np.float32)


def packed(raw: np.ndarray) -> np.ndarray:
    """Vectors times a power of two, which changes no cosine, with greatest components of 0.5 to 1, and behind each 1 by its length."""
    wide = raw.astype(np.float64)
    wide = np.ldexp(wide, -np.frexp(np.abs(wide).max(axis=1, keepdims=True))[1])
    return np.hstack([wide, 1 / np.sqrt((wide * wide).sum(axis=1, keepdims=True))]).astype(np.float32)


def codebook(points: np.ndarray, k: int, rounds: int = 10, seed: int = 5) -> np.ndarray:
    """k centroids by Lloyd's algorithm; centroids that lose all their points begin again at far ones."""
    rng = np.random.default_rng(seed)
    distinct = np.unique(points, axis=0)
    if len(distinct) <= k:
        return distinct.astype(np.float32)
    centres = distinct[rng.choice(len(distinct), k, replace=False)].astype(np.float32)
    for _ in range(rounds):
        gap = (centres * centres).sum(1)[None] - 2 * points @ centres.T
        near = gap.argmin(1)
        n = np.bincount(near, minlength=k)
        order = np.argsort(near, kind="stable")
        full = np.nonzero(n)[0]
        sums = np.add.reduceat(points[order], (np.cumsum(n) - n)[full], axis=0)
        centres[full] = sums / n[full, None]
        empty = np.nonzero(n == 0)[0]
        if len(empty):
            centres[empty] = points[np.argsort(-gap.min(1))[: len(empty)]]
    return centres


def distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (centres * centres).sum(1)[None] - 2 * points @ centres.T


def visit(near: list[float], far: list[float], first: list[int], second: list[int], counts: np.ndarray, enough: int) -> list[tuple[int, int]]:
    """Cells in order of near[a] + far[b], both ascending, until they hold `enough`; empty ones left out.

    first and second give the centroids at the places of near and far. Each pair enters the heap once:
    (a, b + 1) after (a, b), and (a + 1, 0) after (a, 0). Cell by cell: stream() gives the same ones by tiles.
    """
    heap = [(near[0] + far[0], 0, 0)]
    found, held = [], 0
    na, nb = len(near), len(far)
    while heap and held < enough:
        _, a, b = heapq.heappop(heap)
        n = counts[first[a]][second[b]]
        if n:
            found.append((first[a], second[b]))
            held += n
        if b + 1 < nb:
            heapq.heappush(heap, (near[a] + far[b + 1], a, b + 1))
        if b == 0 and a + 1 < na:
            heapq.heappush(heap, (near[a + 1] + far[0], a + 1, 0))
    return found


def stream(near: np.ndarray, far: np.ndarray, first: np.ndarray, second: np.ndarray, counts: np.ndarray, enough: int, tile: int = _TILE) -> np.ndarray:
    """The cells that visit() gives, as rows a, b, in no order, and those with sums equal to its last one's.

    The heap is over tiles of `tile` places a side, by the sum at their nearest corner; it goes on until no
    tile left can hold a cell nearer than the farthest one needed.
    """
    heap = [(near[0] + far[0], 0, 0)]
    cells, held, limit = [], 0, np.inf
    while heap:
        corner, i, j = heapq.heappop(heap)
        if corner > limit:
            break
        a, b = first[i : i + tile], second[j : j + tile]
        n = counts[a[:, None], b]
        x, y = np.nonzero(n)
        if len(x):
            size = n[x, y]
            cells.append((near[i + x] + far[j + y], a[x], b[y], size))
            held += int(size.sum())
            if held >= enough and limit == np.inf:
                sums, sizes = np.concatenate([c[0] for c in cells]), np.concatenate([c[3] for c in cells])
                order = sums.argsort()
                limit = sums[order[np.searchsorted(sizes[order].cumsum(), enough)]]
        if j + tile < len(far):
            heapq.heappush(heap, (near[i] + far[j + tile], i, j + tile))
        if j == 0 and i + tile < len(near):
            heapq.heappush(heap, (near[i + tile] + far[0], i + tile, 0))
    sums, a, b, sizes = (np.concatenate(x) for x in zip(*cells))
    if held >= enough:
        order = sums.argsort()
        keep = sums <= sums[order[np.searchsorted(sizes[order].cumsum(), enough)]]
        a, b = a[keep], b[keep]
    return np.stack([a, b])


def taken(sums: np.ndarray, sizes: np.ndarray, enough: int, steps: int = 512) -> np.ndarray:
    """Numbers of the cells that a query takes: by its own sums (a row of sums), until they hold `enough`.

    Sums are counted in `steps` steps between a row's least and greatest; the last step is taken whole.
    """
    least, most = sums.min(1, keepdims=True), sums.max(1, keepdims=True)
    step = ((sums - least) * ((steps - 1) / np.maximum(most - least, 1e-12))).astype(np.int32)
    at = step + np.arange(len(sums), dtype=np.int32)[:, None] * steps
    held = np.bincount(at.ravel(), np.broadcast_to(sizes.astype(float), sums.shape).ravel(), len(sums) * steps).reshape(-1, steps).cumsum(1)
    last = (held < enough).sum(1, keepdims=True)
    return np.nonzero((step <= last).any(0))[0]


def entries(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Rows (a, b, k1, k2, vec, ids) sorted by the first four; those of one vector, one a batch, become one with its `most` least ids."""
    carry: pa.RecordBatch | None = None
    for b in batches:
        if not b.num_rows:
            continue
        b = b if carry is None else pa.concat_batches([carry, b])
        same = np.ones(b.num_rows - 1, bool)
        for c in range(4):
            values = b.column(c).to_numpy()
            same &= values[1:] == values[:-1]
        first = np.append(0, np.nonzero(~same)[0] + 1)
        n = np.diff(np.append(first, b.num_rows))
        several = np.nonzero(n > 1)[0]
        if len(several):
            ids = b.column(5)
            at = np.arange(len(first))
            at[several] = len(first) + np.arange(len(several))
            united = [sorted({name for names in ids.slice(first[x], n[x]).to_pylist() for name in names})[:most] for x in several.tolist()]
            ids = pa.concat_arrays([ids.take(pa.array(first)), pa.array(united, ids.type)]).take(pa.array(at))
            b = pa.RecordBatch.from_arrays([*b.take(pa.array(first)).columns[:5], ids], names=b.schema.names)
        # the last entry may go on in the next batch
        carry = b.slice(b.num_rows - 1)
        if b.num_rows > 1:
            yield b.slice(0, b.num_rows - 1)
    if carry is not None:
        yield carry


def write_cells(uri: str, batches: Iterator[pa.RecordBatch]) -> tuple[str, list[np.ndarray]]:
    """(name of a new pair of files in the index's folder with the entries, its cells in the order of the file: a, b, entries)."""
    from pyarrow import fs

    files, root = fs.FileSystem.from_uri(uri)
    files.create_dir(root, recursive=True)
    name = uuid.uuid4().hex  # of this attempt: a task that is run again writes another
    cells = [[np.empty(0, np.int64)] * 3]
    schema = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("ids", pa.list_(pa.string()))])
    with files.open_output_stream(f"{root}/{name}.vectors") as vectors, files.open_output_stream(f"{root}/{name}.arrow") as out, pa.ipc.new_file(out, schema) as writer:
        rest: pa.RecordBatch | None = None
        for b in batches:
            pair = np.stack([b.column(0).to_numpy(), b.column(1).to_numpy()]).astype(np.int64)
            first = np.append(0, np.nonzero((pair[:, 1:] != pair[:, :-1]).any(0))[0] + 1)
            cells.append([*pair[:, first], np.diff(np.append(first, b.num_rows))])
            vec = b.column(4)
            begin, end = np.frombuffer(vec.buffers()[1], np.int32)[[vec.offset, vec.offset + len(vec)]].tolist()
            vectors.write(vec.buffers()[2].slice(begin, end - begin))
            b = pa.RecordBatch.from_arrays([b.column(c).cast(f.type) for c, f in zip((2, 3, 5), schema)], schema=schema)
            b = b if rest is None else pa.concat_batches([rest, b])
            whole = b.num_rows // _GROUP * _GROUP
            for at in range(0, whole, _GROUP):
                writer.write_batch(b.slice(at, _GROUP))
            rest = b.slice(whole)
        if rest is not None and rest.num_rows:
            writer.write_batch(rest)
    a, b, n = (np.concatenate(x) for x in zip(*cells))
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])  # a cell may go on in the next batch
    first = np.nonzero(new)[0]
    return name, [a[first], b[first], np.add.reduceat(n, first) if len(first) else n]


class Cells:
    """The index's cells in a worker: mapped files, or, where the folder has no path, the last used groups up to a number of bytes."""

    def __init__(self, uri: str, names: list[str], places: np.ndarray, counts: np.ndarray, dim: int, keep: int = _CACHE_BYTES):
        """places: for each cell the number of its file and the place of its first entry there."""
        from pyarrow import fs

        self.reading = None  # an accumulator that the bytes of gathered vectors are added to

        self.fs, self.root = fs.FileSystem.from_uri(uri)
        self.mapped = isinstance(self.fs, fs.LocalFileSystem)
        self.names, self.places, self.counts, self.width, self.keep = names, places, counts, dim + 1, keep
        self.files: OrderedDict[int, tuple] = OrderedDict()
        self.held: OrderedDict[tuple, tuple] = OrderedDict()
        self.bytes = 0

    def _file(self, number: int) -> tuple:
        """(vectors as of packed(), an array of the mapped file or an open file; reader of keys and ids)."""
        if number not in self.files:
            path = f"{self.root}/{self.names[number]}"
            if self.mapped:
                self.files[number] = (np.memmap(f"{path}.vectors", np.float32, "r").view(np.ndarray).reshape(-1, self.width), pa.ipc.open_file(pa.memory_map(f"{path}.arrow")))
            else:
                self.files[number] = (self.fs.open_input_file(f"{path}.vectors"), pa.ipc.open_file(self.fs.open_input_file(f"{path}.arrow")))
            if len(self.files) > _OPEN_FILES:
                self.files.popitem(last=False)
        self.files.move_to_end(number)
        return self.files[number]

    def _keep(self, key: tuple, load) -> tuple:
        """What load() gives, its bytes last."""
        if key in self.held:
            self.held.move_to_end(key)
            return self.held[key]
        one = self.held[key] = load()
        self.bytes += one[-1]
        while self.bytes > self.keep and len(self.held) > 1:
            self.bytes -= self.held.popitem(last=False)[1][-1]
        return one

    def _vectors(self, number: int, rows: np.ndarray, out: np.ndarray) -> None:
        file = self._file(number)[0]
        if self.mapped:
            file.take(rows, 0, out, "clip")
            return
        row = self.width * 4
        for group in np.unique(rows // _GROUP).tolist():
            some = np.nonzero(rows // _GROUP == group)[0]

            def load(group=group):
                data = file.read_at(_GROUP * row, group * _GROUP * row)
                return np.frombuffer(data, np.float32).reshape(-1, self.width), len(data)

            out[some] = self._keep((number, group, "vectors"), load)[0][rows[some] - group * _GROUP]

    def _names(self, number: int, group: int) -> tuple:
        """(keys in two, begins of the lists of ids, begins of the ids, their letters, bytes)."""

        def load():
            t = self._file(number)[1].get_batch(group)
            ids = t.column(2)
            of_ids = np.frombuffer(ids.values.buffers()[1], np.int32)[ids.values.offset :]
            return t.column(0).to_numpy(), t.column(1).to_numpy(), ids.offsets.to_numpy(), of_ids, memoryview(ids.values.buffers()[2] or b""), t.nbytes

        return self._keep((number, group, "names"), load)

    def rows_of(self, a: np.ndarray, b: np.ndarray, lo: np.ndarray | int = 0, hi: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(numbers of files, places) of the cells' entries, of each the entries lo to hi, the cells in the order given."""
        number, begin = self.places[:, a, b].astype(np.int64)
        n = (self.counts[a, b] if hi is None else hi).astype(np.int64) - lo
        return np.repeat(number, n), np.arange(n.sum()) + np.repeat(begin + lo - (n.cumsum() - n), n)

    def vectors(self, number: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Vectors at places of files, as of packed(); places of one file next to each other."""
        out = np.empty((len(place), self.width), np.float32)
        ends = np.append(np.nonzero(np.diff(number))[0] + 1, len(number)).tolist()
        begin = 0
        for end in ends:
            self._vectors(int(number[begin]), place[begin:end], out[begin:end])
            begin = end
        if self.reading is not None:
            self.reading.add(out.nbytes)
        return out

    def ids(self, number: np.ndarray, place: np.ndarray) -> list[list[str]]:
        out = []
        for f, p in zip(number.tolist(), place.tolist()):
            _, _, lists, begins, letters, _ = self._names(f, p // _GROUP)
            p %= _GROUP
            out.append([str(letters[begins[y] : begins[y + 1]], "utf8") for y in range(lists[p], lists[p + 1])])
        return out

    def keys(self, number: np.ndarray, place: np.ndarray) -> np.ndarray:
        return np.array([[self._names(f, p // _GROUP)[c][p % _GROUP] for c in (0, 1)] for f, p in zip(number.tolist(), place.tolist())], np.int64)


_CELLS: dict[str, Cells] = {}


def cells_of(uri: str, *index) -> Cells:
    """One per Python worker, for all its tasks over one index."""
    if uri not in _CELLS:
        _one_thread()
        _CELLS.clear()
        _CELLS[uri] = Cells(uri, *index)
    return _CELLS[uri]


def _one_thread() -> None:
    """Products run on one thread: the cores have tasks of their own, and threads that wait would only spin."""
    for path in glob.glob(os.path.join(os.path.dirname(np.__file__), os.pardir, "numpy.libs", "*openblas*")):
        library = ctypes.CDLL(path)
        for name in ("scipy_openblas_set_num_threads64_", "openblas_set_num_threads64_", "openblas_set_num_threads"):
            if hasattr(library, name):
                getattr(library, name)(1)
                return


def units_of(counts: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(slices of cells as rows a, b, begin, end, each of at most `most` entries; the first slice of each unit).

    A unit is one or more slices next to each other in one row of cells, of less than 2 `most` entries.
    """
    a, b = np.nonzero(counts)
    size = counts[a, b].astype(np.int64)
    times = -(-size // most)
    a, b, size = (np.repeat(x, times) for x in (a, b, size))
    lo = (np.arange(len(a)) - np.repeat(np.cumsum(times) - times, times)) * most
    hi = np.minimum(lo + most, size)
    before = np.cumsum(hi - lo) - (hi - lo)
    row_begin = np.searchsorted(a, a)
    unit = (before - before[row_begin]) // most
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (unit[1:] != unit[:-1])
    return np.stack([a, b, lo, hi]).astype(np.int32), np.append(np.nonzero(new)[0], len(a))


def centroids_for(different: int) -> int:
    """Centroids of a half for so many different vectors."""
    return int(min(MOST_CENTROIDS, max(4, 2 ** round(np.log2(max(1.0, different / CELL)) / 2))))


def near_order(centres: np.ndarray) -> np.ndarray:
    """Centroids along a chain that goes on to the nearest one not yet taken."""
    left = list(range(1, len(centres)))
    chain = [0]
    while left:
        gap = ((centres[left] - centres[chain[-1]]) ** 2).sum(1)
        chain.append(left.pop(int(gap.argmin())))
    return centres[chain]


def near_best(values: np.ndarray, k: int, slack: float, width: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """(rows, columns), by row, of what may be among a row's k greatest values, or less than `slack` below.

    The k-th greatest of the maxima of `width` columns each is a bound that the k-th greatest value
    reaches; only in columns whose maximum reaches it are values looked at one by one.
    """
    n = values.shape[1]
    whole = n // width
    if whole < k:
        bound = np.partition(values, n - min(k, n), axis=1)[:, n - min(k, n)] - slack
        return np.nonzero(values >= bound[:, None])
    parts = values[:, : whole * width].reshape(len(values), whole, width)
    maxima = parts.max(2)
    bound = np.partition(maxima, whole - k, axis=1)[:, whole - k] - slack
    row, part = np.nonzero(maxima >= bound[:, None])
    at, inner = np.nonzero(parts[row, part] >= bound[row, None])
    more, rest = np.nonzero(values[:, whole * width :] >= bound[:, None])
    rows, cols = np.concatenate([row[at], more]), np.concatenate([part[at] * width + inner, rest + whole * width])
    order = rows.argsort(kind="stable")
    return rows[order], cols[order]


def answer(index: Cells, queries: np.ndarray, number: np.ndarray, place: np.ndarray, take: int) -> list[list[str]]:
    """For each query the `take` best ids among entries at places of files: by cosine to 9 decimals, then by id."""
    wide, single = unit(queries)
    dim = queries.shape[1]
    vectors = index.vectors(number, place)
    near = single @ vectors[:, :dim].T
    near *= vectors[:, dim]
    rows, cols = near_best(near, take, 4e-6)
    wanted, inverse = np.unique(cols, return_inverse=True)
    ids = index.ids(number[wanted], place[wanted])
    cosine = np.round(np.einsum("ij,ij->i", wide[rows], unit(vectors[wanted, :dim])[0][inverse]), 9)
    begin = np.searchsorted(rows, np.arange(len(queries) + 1))
    cos, inv = (-cosine).tolist(), inverse.tolist()
    out = []
    for q in range(len(queries)):
        best = sorted((cos[x], name) for x in range(begin[q], begin[q + 1]) for name in ids[inv[x]])
        out.append([name for _, name in best[:take]])
    return out


def search_unit(index: Cells, books: list[np.ndarray], slices: np.ndarray, enough: int, take: int) -> tuple[np.ndarray, list[list[str]]]:
    """(keys in two columns, the `take` best ids of each) of the entries of slices of cells (rows a, b, begin, end)."""
    a, b, lo, hi = slices.astype(np.int64)
    number, place = index.rows_of(a, b, lo, hi)
    raw = index.vectors(number, place)[:, :-1]
    half = raw.shape[1] // 2
    found: list[list[str]] = []
    # blocks: those of one cell, as the cells nearest to all of a block are no one's nearest if its queries lie apart
    ends = (hi - lo).cumsum()
    cuts = np.unique(np.concatenate([ends[:-1], *(np.arange(x, y, _TOGETHER) for x, y in zip(ends - hi + lo, ends))]))
    for q in np.split(raw, cuts[cuts > 0]):
        points = unit(q)[1]
        d = [distances(points[:, :half], books[0]), distances(points[:, half:], books[1])]
        least = [x.min(0) for x in d]
        order = [x.argsort() for x in least]
        cells = stream(*[x[o] for x, o in zip(least, order)], *order, index.counts, _STREAM * enough)
        cells = cells[:, taken(d[0][:, cells[0]] + d[1][:, cells[1]], index.counts[cells[0], cells[1]], enough)]
        at = index.places[:, cells[0], cells[1]]
        found += answer(index, q, *index.rows_of(*cells[:, np.lexsort((at[1], at[0]))]), take)
    return index.keys(number, place), found


def neighbours(vectors: DataFrame, k: int = 5, id_col: str = "chunk_id", vector_col: str = "embedding", version: str | None = "embedded_at", dim: int = DIM, centroids: int | None = None, candidates: int | None = None, sample: int = SAMPLE, reading=None) -> DataFrame:
    """(id, rank, neighbour): up to k other ids with the most similar valid vectors, for every valid one.

    Cosines are in double precision, rounded to 9 decimals; equal ones are ordered by id. Invalid
    vectors (see is_valid) and null ids have no part; rows of one id are one vector, the one of the
    greatest version. With fewer than k + 1 ids there are fewer neighbours; no vectors give no rows.
    The number of centroids, if not given, grows with the square root of the number of different vectors,
    that of the candidates with its fourth root.
    """
    spark = vectors.sparkSession
    v = F.col(version) if version else F.lit(0)
    data = vectors.where(F.col(id_col).isNotNull() & is_valid(F.col(vector_col), dim)).select(
        F.col(id_col).cast("string").alias("id"), v.alias("v"), F.xxhash64(vector_col).alias("k1"), F.xxhash64(F.lit(3), vector_col).alias("k2"), F.col(vector_col).cast("array<float>").alias("vec"))
    key = F.struct("k1", "k2")
    latest = data.groupBy("id").agg(F.max(F.struct("v", "k1", "k2")).alias("s"), (F.min(key) != F.max(key)).alias("several"))
    members = cut(latest.select("id", "s.k1", "s.k2", "several"))
    # different vectors to some percent: copies are in no cell, and must not make more cells than hold something
    n, several, different = members.agg(F.count(F.lit(1)), F.max("several"), F.approx_count_distinct("k1")).first()
    schema = f"{id_col} STRING, rank INT, neighbour STRING"
    if not n:
        return spark.createDataFrame([], schema)
    if several:
        data = data.join(members.where("several").select("id", F.col("k1").alias("m1"), F.col("k2").alias("m2")), "id", "left")
        data = data.where("m1 IS NULL OR (k1 = m1 AND k2 = m2)")
    size = centroids or centroids_for(different)
    chance = min(1.0, max(sample, 32 * size) / n)
    drawn = data.where(F.pmod(F.xxhash64(F.lit(11), "id"), F.lit(1_000_000)) < int(chance * 1_000_000) + 1).select("vec").toArrow()
    if not len(drawn):
        drawn = data.select("vec").limit(1).toArrow()
    points = unit(drawn["vec"].combine_chunks().flatten().to_numpy().reshape(-1, dim))[1]
    half = dim // 2
    books = [near_order(codebook(points[:, :half], size)), near_order(codebook(points[:, half:], size, seed=6))]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = b.column(3).flatten().to_numpy().reshape(b.num_rows, dim)
            points = unit(raw)[1]
            cells = [distances(points[:, :half], books[0]).argmin(1), distances(points[:, half:], books[1]).argmin(1)]
            k1, k2 = b.column(1).to_numpy(), b.column(2).to_numpy()
            names = b.column(0)
            order = np.lexsort((k2, k1))
            new = np.append(True, (np.diff(k1[order]) != 0) | (np.diff(k2[order]) != 0))
            at = np.nonzero(new)[0]
            times = np.diff(np.append(at, b.num_rows))
            first = order[at]
            united = [[x] for x in names.take(pa.array(first)).to_pylist()]
            for x in np.nonzero(times > 1)[0].tolist():
                united[x] = sorted(set(names.take(pa.array(order[at[x] : at[x] + times[x]])).to_pylist()))[: k + 1]
            vec = packed(raw[first])
            width = vec.shape[1] * vec.itemsize
            vec = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(np.arange(0, (len(first) + 1) * width, width, np.int32)), pa.py_buffer(vec)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(cells[0][first].astype(np.int32)), pa.array(cells[1][first].astype(np.int32)), pa.array(k1[first]), pa.array(k2[first]), vec, pa.array(united, pa.list_(pa.string()))],
                names=["a", "b", "k1", "k2", "vec", "ids"])

    fields = "a INT, b INT, k1 BIGINT, k2 BIGINT, vec BINARY, ids ARRAY<STRING>"
    parts = data.select("id", "k1", "k2", "vec").mapInArrow(assign, fields)
    # equal vectors are in one cell and next to each other; their rows, one a batch, become one entry
    # a first centroid's cells are cut into as many groups as keep all tasks busy, so files stay few
    groups = -(-4 * int(spark.conf.get("spark.sql.shuffle.partitions")) // size)
    sorted_parts = parts.repartition("a", F.floor(F.col("b") / -(-size // groups))).sortWithinPartitions("a", "b", "k1", "k2")

    uri = scratch_table(spark, "multi-index")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, cells = write_cells(uri, entries(batches, k + 1))
        if len(cells[0]):
            yield pa.RecordBatch.from_arrays([pa.array([name]), *(pa.array([x.astype(np.int32)]) for x in cells)], names=["file", "a", "b", "n"])

    files = sorted_parts.mapInArrow(write, "file STRING, a ARRAY<INT>, b ARRAY<INT>, n ARRAY<INT>").toArrow()  # 12 bytes a cell at most
    counts = np.zeros((len(books[0]), len(books[1])), np.int32)
    places = np.zeros((2, *counts.shape), np.int32)
    for number in range(len(files)):
        a, b, held = (np.array(files[c][number].values) for c in ("a", "b", "n"))
        counts[a, b] = held
        places[:, a, b] = [np.full(len(a), number), np.cumsum(held) - held]
    names = files["file"].to_pylist()
    total = int(counts.sum())
    enough = candidates or int(CANDIDATES * max(1.0, total / GROWS_FROM) ** 0.25)
    slices, begins = units_of(counts, max(500, total // 20_000))
    n_units = len(begins) - 1
    tasks = min(n_units, max(spark.sparkContext.defaultParallelism * 3, n_units // 64))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = cells_of(uri, names, places, counts, dim)
        index.reading = reading
        for batch in batches:
            for u in batch.column(0).to_pylist():
                keys, found = search_unit(index, books, slices[:, begins[u] : begins[u + 1]], enough, k + 1)
                yield pa.RecordBatch.from_arrays([pa.array(keys[:, 0]), pa.array(keys[:, 1]), pa.array(found, pa.list_(pa.string()))], names=["k1", "k2", "best"])

    best = spark.range(0, n_units, 1, tasks).mapInArrow(search, "k1 BIGINT, k2 BIGINT, best ARRAY<STRING>")
    own = members.select("id", "k1", "k2")
    hot = [r[0] for r in own.groupBy("k1", "k2").count().where(F.col("count") > max(_HOT, n // 1000)).select("k1").collect()]  # at most 1,000
    if hot:
        salted = F.col("k1").isin(hot)
        own = own.withColumn("salt", F.when(salted, F.pmod(F.xxhash64("id"), F.lit(_SALTS)).cast("int")).otherwise(0))
        best = best.withColumn("salt", F.explode(F.when(salted, F.sequence(F.lit(0), F.lit(_SALTS - 1))).otherwise(F.array(F.lit(0)))))
    # the planner takes the result of a range for small, whatever it grows to: no broadcast
    own = own.join(best.hint("merge"), ["k1", "k2", "salt"] if hot else ["k1", "k2"])
    others = F.slice(F.filter("best", lambda x: x != F.col("id")), 1, k)
    return own.select(F.col("id").alias(id_col), F.posexplode(others).alias("rank", "neighbour")).select(id_col, (F.col("rank") + 1).alias("rank"), "neighbour")


def neighbour_pairs(found: DataFrame, id_col: str = "chunk_id") -> DataFrame:
    """(chunk_a, chunk_b): each pair once, the lesser id first."""
    a, b = F.col(id_col), F.col("neighbour")
    return found.select(F.least(a, b).alias("chunk_a"), F.greatest(a, b).alias("chunk_b")).distinct()

"""Approximate nearest neighbours by cross-polytope hashing with multiprobe tables.

1. A vector of length one is turned by a pseudo-rotation: three rounds of fixed
   random signs and a fast Hadamard transform.  Its hash is the nearest signed
   axis; a table's code is a pair of such axes of two rotations (the second one
   over at most ``SECOND`` coordinates).
2. Every row is indexed in ``tables`` tables.  The codes of a table are cut into
   blocks of about ``BLOCK_VALUES`` vector components; one code with more rows is
   dealt over several blocks.
3. A query probes codes in the order of their gaps: the squared distances of its
   turned coordinates to the largest one, added over both rotations.  How many
   codes it takes is measured: for at most ``sample`` queries the exact
   neighbours are found in one pass over all rows, and the number of probes is
   the least that reaches ``recall`` of them.  With vectors in no order at all
   that is a good part of all codes, with clustered ones a few.
4. Queries visit the blocks that hold probed codes.  A visited block compares
   the query with the rows of probed codes only, by exact distance in double
   precision, and returns the best ones; the best of all blocks are the result.

A block is visited by at most ``VISITS`` queries in one task: a hot block goes to
as many tasks as its visits ask for.  Vectors are dealt once for each table; the
driver receives the sample, its neighbours and the first codes of the blocks
(no more than there are codes).

Defined cases: vectors that are null, empty or zero or hold a null or non-finite
component take no part, neither as query nor as candidate; vectors are near only
to those of their own dimension; repeated rows are rows of their own (a copy of
the query is its neighbour at distance 0); a null id is a candidate and comes
last among ties; ties of one id go by row; a query without candidates has no
rows; an empty table gives none; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import broadcast_if_small, map_arrow, mix, written

TABLES = 3
SECOND = 64
RECALL = 0.97
#: queries whose exact neighbours set the number of probes
SAMPLE = 128
#: vector components of a block, and the fewest rows of one
BLOCK_VALUES, BLOCK_ROWS = 1 << 19, 256
VISITS = 1 << 14
#: visited blocks whose numbers of tasks may be broadcast (40 bytes each)
MAX_BROADCAST_ROWS = 1_000_000
#: entries of one table of distances
_CELLS = 1 << 20
_BLOCK = ["dim", "tab", "block", "sub"]


# ---- vectors and hashes --------------------------------------------------------------------

def _signs(table: int, half: int, turn: int, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        seed = mix(np.array([(table * 2 + half) * 3 + turn + 1], np.uint64))
        bits = mix(np.arange(n, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + seed)
    return np.where(bits >> np.uint64(63), 1.0, -1.0)


def hadamard(x: np.ndarray) -> np.ndarray:
    """Rows of ``x`` (a power of two long) times the Hadamard matrix, by additions."""
    n, h = x.shape[1], 1
    while h < n:
        y = x.reshape(len(x), -1, 2, h)
        x = np.concatenate([y[:, :, :1] + y[:, :, 1:], y[:, :, :1] - y[:, :, 1:]], axis=2).reshape(len(x), n)
        h *= 2
    return x


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def turned(u: np.ndarray, table: int, half: int) -> np.ndarray:
    """Signed coordinates of the turned vectors: the axes first, then the opposite ones."""
    size = 1 << max(0, int(u.shape[1] - 1).bit_length())
    x = np.zeros((len(u), size))
    x[:, :u.shape[1]] = u
    for turn in range(3):
        x = hadamard(x * _signs(table, half, turn, size)) / np.sqrt(size)
    x = x[:, :SECOND] if half else x
    return np.concatenate([x, -x], axis=1)


def codes_of(u: np.ndarray, table: int) -> np.ndarray:
    return turned(u, table, 0).argmax(axis=1) * (2 * SECOND) + turned(u, table, 1).argmax(axis=1)


def gaps_of(u: np.ndarray, table: int) -> tuple[np.ndarray, np.ndarray]:
    """How far each signed axis of either rotation is behind the nearest one."""
    both = [turned(u, table, half) for half in (0, 1)]
    first, second = [(s.max(axis=1, keepdims=True) - s) ** 2 for s in both]
    return first, second


def _all_gaps(u: np.ndarray, table: int) -> np.ndarray:
    """Gap of every code of the table (one row per vector)."""
    first, second = gaps_of(u, table)
    out = np.full((len(u), first.shape[1], 2 * SECOND), np.inf)
    out[:, :, :second.shape[1]] = first[:, :, None] + second[:, None, :]
    return out.reshape(len(u), -1)


def _decoded(col, dim: int, kind: str) -> np.ndarray:
    raw = b"".join(col.to_pylist())
    return np.frombuffer(raw, kind).reshape(-1, dim).astype(np.float64)


# ---- index ---------------------------------------------------------------------------------

def index_rows(vectors: DataFrame, *, vec_id: str = "vec_id", vector: str = "embedding", tables: int = TABLES) -> DataFrame:
    """``id, dim, vec, codes`` of the rows that take part; ``vec`` are the components as bytes."""
    key = vectors.schema[vec_id].dataType.simpleString()
    kind = "<f4" if vectors.schema[vector].dataType.elementType.simpleString() == "float" else "<f8"
    component = pa.float32() if kind == "<f4" else pa.float64()

    def run(batches):
        for batch in batches:
            ids, lists = batch.column(0), batch.column(1).cast(pa.list_(component))
            bounds = lists.offsets.to_numpy().astype(np.int64)
            flat = lists.values
            bad = np.zeros(len(flat), bool)
            if flat.null_count:
                bad = flat.is_null().to_numpy(zero_copy_only=False)
                flat = flat.fill_null(0)
            x = flat.to_numpy(zero_copy_only=False)
            bad |= ~np.isfinite(x)
            dims = np.diff(bounds)
            if lists.null_count:
                dims = np.where(lists.is_null().to_numpy(zero_copy_only=False), 0, dims)
            for dim in np.unique(dims[dims > 0]).tolist():
                rows = np.flatnonzero(dims == dim)
                at = bounds[rows][:, None] + np.arange(dim)
                v = x[at]
                good = ~bad[at].any(axis=1) & (v != 0).any(axis=1)
                rows, v = rows[good], np.ascontiguousarray(v[good])
                if not len(rows):
                    continue
                u = unit(v.astype(np.float64))
                codes = np.stack([codes_of(u, t) for t in range(tables)], axis=1).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(rows)), pa.array(np.full(len(rows), dim, np.int32)),
                     pa.array([r.tobytes() for r in v.astype(kind)], pa.binary()),
                     pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * tables), pa.array(codes.ravel()))],
                    ["id", "dim", "vec", "codes"])

    return map_arrow(vectors.select(vec_id, vector), run, f"id {key}, dim int, vec binary, codes array<int>")


def _block_starts(index: DataFrame) -> dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]:
    """By dimension and table: the first code of every block, and over how many sub-blocks it is dealt."""
    size = F.greatest(F.lit(BLOCK_ROWS), F.expr(f"{BLOCK_VALUES} div dim"))
    counts = written(index.select("dim", F.posexplode("codes").alias("tab", "code")).groupBy("dim", "tab", "code").agg(
        F.count(F.lit(1)).alias("c")), "ann_codes")
    before = Window.partitionBy("dim", "tab").orderBy("code").rowsBetween(Window.unboundedPreceding, -1)
    blocks = counts.withColumn("size", size).withColumn(
        "cut", F.floor(F.coalesce(F.sum("c").over(before), F.lit(0)) / F.col("size"))).groupBy("dim", "tab", "size", "cut").agg(
        F.min("code").alias("start"), F.ceil(F.sum("c") / (2 * F.col("size"))).cast("int").alias("subs"))
    out: dict = {}
    for r in blocks.orderBy("dim", "tab", "start").collect():
        out.setdefault((r["dim"], r["tab"]), []).append((r["start"], r["subs"]))
    return {k: (np.array([a for a, _ in v], np.int64), np.array([b for _, b in v], np.int64)) for k, v in out.items()}


# ---- exact distances -----------------------------------------------------------------------

def _scale(*xs: np.ndarray) -> float:
    """A power of two that keeps squares in the range of a double; 1 for usual vectors."""
    top = max((float(np.abs(x).max()) for x in xs if x.size), default=1.0)
    return 1.0 if 1e-140 < top < 1e140 else 2.0 ** np.floor(np.log2(top))


def distances(x: np.ndarray, y: np.ndarray, scale: float = 1.0) -> np.ndarray:
    d = x / scale - y / scale if scale != 1.0 else x - y
    return np.sqrt((d * d).sum(axis=1)) * scale


def best_of(q: np.ndarray, x: np.ndarray, allowed, k: int, ids: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` nearest allowed rows of every query: positions in ``q`` and ``x``, and distances.

    ``allowed(lo, hi)`` masks the rows for the queries ``lo`` to ``hi``.  A matrix
    product leaves out rows that cannot be among the nearest; the others are
    compared by their exact distance, ties by id, then row.
    """
    scale = _scale(q, x)
    qs, xs = (q / scale, x / scale) if scale != 1.0 else (q, x)
    q2, x2 = (qs * qs).sum(axis=1), (xs * xs).sum(axis=1)
    slack = 1e-9 * (q2 + (x2.max() if len(x2) else 0.0))
    step = max(1, _CELLS // max(1, len(x)))
    out = []
    for lo in range(0, len(q), step):
        hi = min(lo + step, len(q))
        near = q2[lo:hi, None] + x2[None, :] - 2.0 * (qs[lo:hi] @ xs.T)
        near[~allowed(lo, hi)] = np.inf
        if near.shape[1] > k:
            kth = np.partition(near, k - 1, axis=1)[:, k - 1]
            take = (near <= (kth + slack[lo:hi])[:, None]) & np.isfinite(near)
        else:
            take = np.isfinite(near)
        a, b = np.nonzero(take)
        d = np.empty(len(a))
        wide = max(1, _CELLS // x.shape[1])
        for s in range(0, len(a), wide):
            d[s:s + wide] = distances(x[b[s:s + wide]], q[lo + a[s:s + wide]], scale)
        order = np.lexsort((rows[b], ids[b], d, a))
        a, b, d = a[order], b[order], d[order]
        first = np.searchsorted(a, np.arange(hi - lo))
        keep = np.arange(len(a)) - first[a] < k
        out.append((lo + a[keep], b[keep], d[keep]))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return tuple(np.concatenate(x) for x in zip(*out))


def _id_order(col) -> np.ndarray:
    """Places of ids among each other, nulls last (any type of id)."""
    values = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    code = pa.compute.rank(values, sort_keys="ascending", null_placement="at_end", tiebreaker="dense")
    return code.to_numpy(zero_copy_only=False)


# ---- calibration ---------------------------------------------------------------------------

def _probes(index: DataFrame, queries: DataFrame, kind: str, tables: int, k: int, recall: float, sample: int) -> dict[int, int]:
    """Codes to probe in each table, by dimension; dimensions without a sampled query probe all of theirs."""
    some = queries.orderBy(F.xxhash64("row"), "row").limit(sample).collect()
    if not some:
        return {}
    of: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for dim in {r["dim"] for r in some}:
        mine = [r for r in some if r["dim"] == dim]
        of[dim] = (np.array([r["row"] for r in mine]),
                   np.stack([np.frombuffer(r["vec"], kind).astype(np.float64) for r in mine]))

    def run(batches):
        kept: dict[int, list] = {}
        for batch in batches:
            dims = batch.column(1).to_numpy()
            rows = batch.column(0).to_numpy()
            for dim in np.unique(dims).tolist():
                if dim not in of:
                    continue
                at = np.flatnonzero(dims == dim)
                x = _decoded(batch.column(2).take(pa.array(at)), dim, kind)
                own, q = of[dim]
                r = rows[at]
                a, b, d = best_of(q, x, lambda lo, hi: r[None, :] != own[lo:hi, None], k, r, r)
                codes = np.array(batch.column(3).take(pa.array(at[b])).to_pylist(), np.int64).reshape(-1, tables)
                a0, d0, r0, c0 = kept.get(dim, (np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64), np.zeros((0, tables), np.int64)))
                a, d, r, c = np.concatenate([a0, a]), np.concatenate([d0, d]), np.concatenate([r0, r[b]]), np.concatenate([c0, codes])
                order = np.lexsort((r, d, a))
                a, d, r, c = a[order], d[order], r[order], c[order]
                keep = np.arange(len(a)) - np.searchsorted(a, a) < k
                kept[dim] = (a[keep], d[keep], r[keep], c[keep])
        for dim, (a, d, r, c) in kept.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(of[dim][0][a]), pa.array(np.full(len(a), dim, np.int32)), pa.array(d), pa.array(r),
                 pa.array(c.astype(np.int32).tolist(), pa.list_(pa.int32()))], ["q", "dim", "d", "row", "codes"])

    found = map_arrow(index.select("row", "dim", "vec", "codes"), run, "q long, dim int, d double, row long, codes array<int>")
    place = F.row_number().over(Window.partitionBy("q").orderBy("d", "row"))
    nearest = found.withColumn("place", place).where(F.col("place") <= k).collect()
    out = {}
    for dim, (own, q) in of.items():
        u = unit(q)
        need = []
        for t in range(tables):
            gaps = _all_gaps(u, t)
            for i, r in enumerate(own.tolist()):
                codes = np.array([x["codes"][t] for x in nearest if x["q"] == r], np.int64)
                ordered = np.sort(gaps[i])
                need.append((i, np.searchsorted(ordered, gaps[i][codes] * (1 + 1e-12), "right")))
        least = []
        for i in range(len(own)):
            least.extend(np.min([n for j, n in need if j == i], axis=0).tolist())
        least.sort()
        out[dim] = least[min(len(least) - 1, int(np.ceil(recall * len(least))) - 1)] if least else 1
    return out


# ---- search --------------------------------------------------------------------------------

def nearest_neighbours(vectors: DataFrame, is_query: Column, *, k: int = 10, vec_id: str = "vec_id", vector: str = "embedding",
                       tables: int = TABLES, recall: float = RECALL, sample: int = SAMPLE) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest rows found of every row with ``is_query`` (on ``vec_id``)."""
    key = vectors.schema[vec_id].dataType.simpleString()
    kind = "<f4" if vectors.schema[vector].dataType.elementType.simpleString() == "float" else "<f8"
    index = written(index_rows(vectors, vec_id=vec_id, vector=vector, tables=tables).withColumn(
        "row", F.monotonically_increasing_id()), "ann_rows")
    asked = written(index.withColumnRenamed("id", vec_id).withColumn("_q", is_query).where("_q").select(
        "row", F.col(vec_id).alias("id"), "dim", "vec"), "ann_queries")
    starts = _block_starts(index)
    probes = _probes(index, asked, kind, tables, k, recall, sample)

    def dealt(batches):
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            row = batch.column("row").to_numpy()
            codes = batch.column("codes").values.to_numpy().reshape(-1, tables)
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                part = batch.take(pa.array(at))
                for t in range(tables):
                    first, subs = starts[dim, t]
                    code = codes[at, t]
                    block = np.searchsorted(first, code, "right") - 1
                    with np.errstate(over="ignore"):
                        sub = mix(row[at].astype(np.uint64)) % subs[block].astype(np.uint64)
                    yield pa.RecordBatch.from_arrays(
                        [part.column("dim"), pa.array(np.full(len(at), t, np.int32)), pa.array(block), pa.array(sub.astype(np.int32)),
                         part.column("row"), part.column("id"), part.column("vec"), pa.array(code.astype(np.int32))],
                        [*_BLOCK, "row", "id", "vec", "code"])

    def visiting(batches):
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                every = np.flatnonzero(dims == dim)
                step = max(1, 4 * _CELLS // (4 * SECOND << int(dim - 1).bit_length()))
                for lo in range(0, len(every), step):
                    at = every[lo:lo + step]
                    part = batch.take(pa.array(at))
                    u = unit(_decoded(part.column("vec"), dim, kind))
                    for t in range(tables):
                        first, subs = starts[dim, t]
                        gaps = _all_gaps(u, t)
                        m = probes.get(dim, gaps.shape[1])
                        cut = np.partition(gaps, m - 1, axis=1)[:, m - 1] * (1 + 1e-12) if m < gaps.shape[1] else np.full(len(u), np.inf)
                        # whether a block holds a probed code (blocks are ranges of codes)
                        hit = np.logical_or.reduceat(gaps <= cut[:, None], first, axis=1)
                        hit[:, :] |= ~np.isfinite(cut)[:, None]
                        a, b = np.nonzero(hit)
                        again = subs[b]
                        a, b = np.repeat(a, again), np.repeat(b, again)
                        sub = np.arange(len(a)) - np.repeat(np.cumsum(again) - again, again)
                        yield pa.RecordBatch.from_arrays(
                            [part.column("dim").take(pa.array(a)), pa.array(np.full(len(a), t, np.int32)), pa.array(b),
                             pa.array(sub.astype(np.int32)), part.column("row").take(pa.array(a)), part.column("id").take(pa.array(a)),
                             part.column("vec").take(pa.array(a)), pa.array(cut[a])],
                            [*_BLOCK, "row", "id", "vec", "cut"])

    block = "dim int, tab int, block long, sub int"
    visits = written(map_arrow(asked.select("row", "id", "dim", "vec"), visiting,
                               f"{block}, row long, id {key}, vec binary, cut double"), "ann_visits")
    parts = written(visits.groupBy(*_BLOCK).agg(F.ceil(F.count(F.lit(1)) / VISITS).cast("int").alias("parts")), "ann_parts")
    parts = broadcast_if_small(parts, MAX_BROADCAST_ROWS)
    data = map_arrow(index.select("row", "id", "dim", "vec", "codes"), dealt, f"{block}, row long, id {key}, vec binary, code int")
    data = data.join(parts, _BLOCK).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    visits = visits.join(parts, _BLOCK).withColumn("part", F.pmod(F.xxhash64("row"), F.col("parts")).cast("int")).drop("parts")
    schema = f"query long, query_id {key}, row long, vec_id {key}, score double"

    def compared(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["query", "query_id", "row", "vec_id", "score"]
        none = pa.table([pa.array([], pa.int64()), right.column("id").slice(0, 0), pa.array([], pa.int64()),
                         left.column("id").slice(0, 0), pa.array([], pa.float64())], names)
        if not left.num_rows or not right.num_rows:
            return none
        dim, t = left.column("dim")[0].as_py(), left.column("tab")[0].as_py()
        x, q = _decoded(left.column("vec"), dim, kind), _decoded(right.column("vec"), dim, kind)
        code, row = left.column("code").to_numpy().astype(np.int64), left.column("row").to_numpy()
        own, cut = right.column("row").to_numpy(), right.column("cut").to_numpy()
        first, second = code // (2 * SECOND), code % (2 * SECOND)

        def allowed(lo, hi):
            g1, g2 = gaps_of(unit(q[lo:hi]), t)
            return (g1[:, first] + g2[:, second] <= cut[lo:hi, None]) & (row[None, :] != own[lo:hi, None])

        a, b, d = best_of(q, x, allowed, k, _id_order(left.column("id")), row)
        a, b = pa.array(a), pa.array(b)
        return pa.table([right.column("row").take(a), right.column("id").take(a), left.column("row").take(b),
                         left.column("id").take(b), pa.array(d)], names)

    by = [*_BLOCK, "part"]
    near = data.groupBy(*by).cogroup(visits.groupBy(*by)).applyInArrow(compared, schema)
    # a row found in several tables has equal figures each time, so one place
    place = F.dense_rank().over(Window.partitionBy("query").orderBy("score", F.col("vec_id").asc_nulls_last(), "row"))
    return near.withColumn("rank", place.cast("int")).where(F.col("rank") <= k).dropDuplicates(["query", "rank"]).select(
        "query_id", "rank", "vec_id", "score")

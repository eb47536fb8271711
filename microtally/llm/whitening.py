"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

Entries are put on a grid of whole numbers (``scale`` steps to the unit), so sums and squared deviations
are exact. The principal components are the right singular vectors of the centred rows X. The
bidiagonalisation takes alternating products with X in all tasks: X v gives the next left vector u,
Xᵀu the next right vector. Both are orthogonalised against all earlier ones, so no component is found
twice. Singular values and vectors of the small bidiagonal matrix give components and deviations.

How it is spread: rows are packed once into blocks of whole numbers in the narrowest type that holds
them, and checkpointed; each product reads the blocks, with nothing shuffled but one vector a task.
A left vector has an entry per row and is never stored or moved: it is X times a vector w as long as a
row is wide, so tasks make their part of it, and of all earlier left vectors, from the w that the
driver sends. The driver holds vectors of the width of a row only. Two products a step, as many
steps as dimensions, so that eigenvalues that lie close together or repeat are found as well.

Defined results
    Rows whose vector is null or holds a null or non-finite entry are left out. Repeated rows count each;
    null and repeated ids stay as they are. A vector shorter than the longest counts as ending in zeros.
    Grid values beyond 2^53 count as 2^53. Components without variance, which cannot be scaled, have null
    ``whitened`` and ``explained`` 0 (null if nothing varies). Fewer dimensions than components: so many
    components. Tied eigenvalues: any basis of their space, the same for all rows. Empty table, or empty
    vectors only: no rows. Columns other than id and vector are ignored, whatever their names.
"""

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F

from microtally.llm.registry import query, read, send_package
from microtally.session import checkpointed

COMPONENTS, SCALE = 32, 64

# Grid values are kept up to this size, and sums of them in two parts of so many low bits.
LARGEST, LOW_BITS = 1 << 53, 31

# Bytes of a block, entries worked on at once, and vectors that may come to the driver from one pass.
BLOCK_BYTES, CHUNK_ENTRIES, FAN_IN = 1 << 22, 1 << 19, 512

# Relative to the largest singular value: what counts as a breakdown of the recurrence, and as no variance.
BREAKDOWN, NO_VARIANCE = 1e-13, 1e-12

BLOCKS = "ids array<long>, width int, kind string, cells binary"


def grid(column, scale, width):
    """The usable rows of an Arrow list column on the grid: which rows, and their whole numbers."""
    if pa.types.is_large_list(column.type):
        column = column.cast(pa.list_(column.type.value_type))
    lengths = np.diff(column.offsets.to_numpy())
    there = ~column.is_null().to_numpy(zero_copy_only=False)
    values = column.values.slice(column.offsets[0].as_py(), int(lengths.sum())).cast(pa.float64())
    numbers = values.to_numpy(zero_copy_only=False)  # a null becomes NaN
    row = np.repeat(np.arange(len(column)), lengths)
    usable = there & (np.bincount(row, ~np.isfinite(numbers), len(column)) == 0)
    place = np.arange(len(numbers)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    rows = np.flatnonzero(usable)
    out = np.zeros((len(column), width), dtype=np.int64)
    fine = usable[row]
    out[row[fine], place[fine]] = np.clip(np.floor(numbers[fine] * scale), -LARGEST, LARGEST)
    return rows, out[rows]


def _pack(scale, width):
    def pack(batches):
        for batch in batches:
            step = max(1, BLOCK_BYTES // (8 * max(width, 1)))
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                rows, cells = grid(part.column("vector"), scale, width)
                if not len(rows):
                    continue
                kind = next(k for k in ("int8", "int16", "int32", "int64") if np.abs(cells).max(initial=0) <= np.iinfo(k).max)
                ids = part.column("id").take(pa.array(rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids.to_pylist()], pa.list_(pa.int64())), pa.array([width], pa.int32()), pa.array([kind]),
                     pa.array([cells.astype(kind).tobytes()], pa.binary())], ["ids", "width", "kind", "cells"])

    return pack


def _blocks(batches):
    """Ids and whole numbers of each block of a task."""
    for batch in batches:
        for at in range(batch.num_rows):
            cells = np.frombuffer(batch.column("cells")[at].as_buffer(), dtype=batch.column("kind")[at].as_py())
            yield batch.column("ids")[at].values, cells.reshape(-1, batch.column("width")[at].as_py()).astype(np.int64)


class Rows:
    """Packed rows with their number and exact column sums, and passes over them."""

    def __init__(self, vectors, id, vector, scale):
        spark = vectors.sparkSession
        send_package(spark)
        rows = vectors.select(F.col(id).cast("long").alias("id"), F.col(vector).alias("vector"))
        self.width = rows.agg(F.max(F.size("vector"))).first()[0] or 0
        packed = rows.mapInArrow(_pack(scale, self.width), BLOCKS) if self.width > 0 else spark.createDataFrame([], BLOCKS)
        self.blocks = checkpointed(packed)
        counted = self.add_up(_sums, 2 * self.width + 1)
        self.n, parts = int(counted[0]), counted[1:].astype(object)
        self.sums = parts[:self.width] * (1 << LOW_BITS) + parts[self.width:]

    def add_up(self, each_block, size, kind=np.int64):
        """Sum over all rows of the vectors of ``size`` that ``each_block`` makes of whole numbers.

        Every task adds up its own blocks. If there are many tasks, groups of them are added up in tasks
        before the sums come to the driver, always in the same order.
        """
        def partial(batches):
            total = np.zeros(size, kind)
            for _, cells in _blocks(batches):
                total += each_block(cells)
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()]), pa.array([total.tobytes()])], ["task", "total"])

        def gather(table):
            return pa.table({"task": [table.column("task")[0].as_py()], "total": [added(table.column("task").to_pylist(), table.column("total").to_pylist()).tobytes()]})

        def added(tasks, totals):
            ordered = [total for _, total in sorted(zip(tasks, totals))]
            return np.sum([np.frombuffer(total, kind) for total in ordered] or [np.zeros(size, kind)], axis=0)

        totals = self.blocks.mapInArrow(partial, "task long, total binary")
        if self.blocks.rdd.getNumPartitions() > FAN_IN:
            totals = totals.groupBy((F.col("task") % FAN_IN).alias("group")).applyInArrow(gather, "task long, total binary")
        found = totals.collect()
        return added([row.task for row in found], [bytes(row.total) for row in found])

    def centred(self):
        """A function from whole numbers to centred rows: (n x - S) / n, the numerator exact."""
        n, numerators = self.n, self.numerators()

        def centre(cells):
            return numerators(cells).astype(np.float64) / n

        return centre

    def numerators(self):
        """A function from whole numbers to n x - S, in 64 bits where that is enough."""
        n, sums = self.n, self.sums
        room = (1 << 62) - max((abs(int(s)) for s in sums), default=0)
        narrow = None if room < 0 else sums.astype(np.int64)

        def numerator(cells):
            if narrow is not None and int(np.abs(cells).max(initial=0)) * n < room:
                return cells * n - narrow
            return cells.astype(object) * n - sums

        return numerator


def _sums(cells):
    """Rows, and sums of the high and the low bits of each column."""
    return np.concatenate([[len(cells)], (cells >> LOW_BITS).sum(0), (cells & ((1 << LOW_BITS) - 1)).sum(0)])


def _chunks(cells):
    step = max(1, CHUNK_ENTRIES // max(1, cells.shape[1]))
    return (cells[start:start + step] for start in range(0, len(cells), step))


def forward_product(rows, w, earlier):
    """Over all rows: the square of X w, and its products with the ``earlier`` left vectors X w'."""
    centre, names = rows.centred(), np.column_stack([w, *earlier])

    def product(cells):
        total = np.zeros(names.shape[1])
        for chunk in _chunks(cells):
            left = centre(chunk) @ names
            total += left[:, 0] @ left
        return total

    found = rows.add_up(product, names.shape[1], np.float64)
    return found[0], found[1:]


def backward_product(rows, w):
    """Over all rows: Xᵀu for the left vector u = X w, and the square of u."""
    centre = rows.centred()

    def product(cells):
        total = np.zeros(len(w) + 1)
        for chunk in _chunks(cells):
            part = centre(chunk)
            left = part @ w
            total[1:] += part.T @ left
            total[0] += left @ left
        return total

    found = rows.add_up(product, len(w) + 1, np.float64)
    return found[1:], found[0]


def _against(vector, others):
    """The vector made orthogonal to the others, twice, as once leaves rounding errors."""
    for _ in range(2):
        for other in others:
            vector = vector - other * (other @ vector)
    return vector


def bidiagonalise(rows):
    """Right vectors (rows of a matrix) and the upper bidiagonal matrix of the centred rows.

    Where the recurrence breaks down, the directions reached so far hold all that those vectors have to do
    with each other; it goes on from a new direction orthogonal to them. A right vector that X maps to
    nothing gets an empty left vector and a deviation of zero.
    """
    width, random = rows.width, np.random.default_rng(7)
    rights, lefts = [], []
    diagonal, upper = np.zeros(width), np.zeros(width)
    largest, beta = 0.0, 0.0
    right = None
    for step in range(width):
        if right is None:
            fresh = _against(random.standard_normal(width), rights)
            right = fresh / np.linalg.norm(fresh)
        rights.append(right)
        w = right - beta * lefts[-1] if beta else right
        square, along = forward_product(rows, w, lefts)
        largest = max(largest, np.sqrt(square))
        for left, share in zip(lefts, along):
            w = w - share * left
        image, square = backward_product(rows, w)
        alpha = np.sqrt(square)
        if alpha <= BREAKDOWN * largest or not alpha:
            lefts.append(np.zeros(width))
            right, beta = None, 0.0
            continue
        lefts.append(w / alpha)
        diagonal[step] = alpha
        rest = _against(image / alpha - alpha * right, rights)
        beta = np.linalg.norm(rest)
        largest = max(largest, alpha, beta)
        if beta <= BREAKDOWN * largest:
            right, beta = None, 0.0
        else:
            right = rest / beta
            if step + 1 < width:
                upper[step] = beta
    return np.array(rights).reshape(width, width), np.diag(diagonal) + np.diag(upper[:-1], 1) if width else np.zeros((0, 0))


class Whitening:
    """Components (rows), their variances, and the whole variance."""

    def __init__(self, rows, components=COMPONENTS):
        rights, small = bidiagonalise(rows)
        _, values, turned = np.linalg.svd(small) if rows.width else (None, np.zeros(0), np.zeros((0, 0)))
        kept = min(components, rows.width)
        self.components = (turned @ rights)[:kept]
        self.components = self.components / np.linalg.norm(self.components, axis=1, keepdims=True)
        varies = values[:kept] > NO_VARIANCE * max(values, default=0.0)
        self.variances = np.where(varies, values[:kept] ** 2 / max(rows.n, 1), 0.0)
        centre = rows.centred()
        self.whole = rows.add_up(lambda cells: np.array([(centre(cells) ** 2).sum()]), 1, np.float64)[0] / max(rows.n, 1)

    def projection(self):
        """Columns that take centred rows to whitened ones; NaN for a component without variance."""
        return (self.components / np.sqrt(np.where(self.variances > 0, self.variances, np.nan))[:, None]).T

    def identity_error(self, rows):
        """Largest absolute entry of the covariance of the whitened rows minus the identity."""
        used = self.projection()[:, self.variances > 0]
        centre, width = rows.centred(), used.shape[1]
        if not width:
            return 0.0

        def moments(cells):
            white = centre(cells) @ used
            return np.concatenate([white.sum(0), (white.T @ white).ravel()])

        found = rows.add_up(moments, width + width * width, np.float64)
        mean = found[:width] / rows.n
        covariance = found[width:].reshape(width, width) / rows.n - np.outer(mean, mean)
        return float(np.abs(covariance - np.eye(width)).max())


def whiten(vectors, id="vec_id", vector="embedding", components=COMPONENTS, scale=SCALE):
    """One row per usable vector and component.

    ``vec_id, component`` (from 1, by falling variance), ``n`` (usable vectors), ``deviation`` (sum over the
    dimensions of (n x - S)^2, exact, as ``decimal(38,0)``, null beyond it), ``whitened``, ``explained`` (share of the
    variance) and ``identity_error``.
    """
    rows = Rows(vectors, id, vector, scale)
    found = Whitening(rows, components)
    numerators, centre, project = rows.numerators(), rows.centred(), found.projection()

    def white(batches):
        for ids, cells in _blocks(batches):
            step = max(1, CHUNK_ENTRIES // cells.shape[1])
            for start in range(0, len(cells), step):
                part = cells[start:start + step]
                squares = [str(each) for each in deviations(numerators(part)).tolist()]
                numbers = (centre(part) @ project).ravel()
                flat = pa.array(numbers, mask=np.isnan(numbers))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1, dtype=np.int32) * project.shape[1]), flat)
                yield pa.RecordBatch.from_arrays([ids.slice(start, step), pa.array(squares, pa.string()), lists], ["vec_id", "squares", "white"])

    made = rows.blocks.mapInArrow(white, "vec_id long, squares string, white array<double>")
    share = [float(each) for each in found.variances / found.whole] if found.whole > 0 else [None] * len(found.variances)
    shares = F.array(*[F.lit(each).cast("double") for each in share]) if share else F.array().cast("array<double>")
    error = found.identity_error(rows)
    return made.select("vec_id", F.expr("try_cast(squares AS decimal(38,0))").alias("deviation"), F.posexplode("white").alias("place", "whitened")).select(
        "vec_id", (F.col("place") + 1).cast("int").alias("component"), F.lit(rows.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("place")).alias("explained"), F.lit(error).cast("double").alias("identity_error"))


def deviations(over):
    """Sums of the squares of each row of whole numbers, exact."""
    if over.dtype != object and int(np.abs(over).max(initial=0)) ** 2 * over.shape[1] < 1 << 63:
        return (over * over).sum(1)
    over = over.astype(object)
    return (over * over).sum(1)


@query("op11_embedding_whitening")
def op11_embedding_whitening(spark, sf_dir):
    """All usable vectors on their first 32 components; a deviation that no long can hold is null."""
    out = whiten(read(spark, sf_dir, "embeddings"))
    return out.withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))

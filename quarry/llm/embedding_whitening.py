"""Embedding whitening: projections on the leading eigenvectors of the covariance, scaled to variance one.

Entries become whole numbers, x = floor(64 c) + 1,000,000, so that sums and deviations are
exact. Three passes over the vectors: sums; products of the centred vectors; products of the
whitened ones, whose distance from the identity is reported. Every pass adds up one array per
partition on the executors; one matrix of dimension x dimension comes to the driver, where
`spectrum.leading_eigenpairs` slices it. MAX_DIMENSION bounds that matrix to 32 MB.

Results (each function): vectors that are null, empty, or hold null, NaN or infinite entries
take no part, nor do those with an entry of 2^56 or more, whose x is no long. All vectors of a
table should have one length; where they don't, those of the most frequent length take part
(the longest of several). Repeated rows count as often as they stand there; ids play no part
and may be null. Components of variance zero, to double precision, have no whitened value and
are left out: a table of one vector, or of equal ones, gives no component, and an empty table
nothing. Other columns stay as they are.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from quarry.llm.spectrum import leading_eigenpairs

MAX_DIMENSION = 2048
SCALE, OFFSET = 64, 1_000_000
SLICE_ROWS = 2000


@dataclass(frozen=True)
class Whitening:
    """What is learned: count, sums per dimension of x - OFFSET, eigenvalues, eigenvectors as rows, trace."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def dimension(self):
        return len(self.sums)


def usable(df, vector):
    """The rows whose vector takes part, and its length (None without any)."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) >= F.lit(2.0**56))
    entries = F.col(vector).cast("array<double>")
    finite = df.filter(F.col(vector).isNotNull() & (F.size(vector) > 0)).filter(~F.exists(entries, bad))
    lengths = finite.groupBy(F.size(vector).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    if not lengths:
        return finite, None
    dimension = lengths[0]["d"]
    if dimension > MAX_DIMENSION:
        raise ValueError(f"vectors of {dimension} entries; at most {MAX_DIMENSION} are supported")
    return finite.filter(F.size(vector) == dimension), dimension


def whole_numbers(column, dimension):
    """x - OFFSET of a batch's vectors, one row each."""
    values = column.cast(pa.list_(pa.float64())).flatten().to_numpy(zero_copy_only=False)
    return np.floor(SCALE * values).astype(np.int64).reshape(-1, dimension)


def slices_of(batch):
    for at in range(0, batch.num_rows, SLICE_ROWS):
        yield batch.slice(at, SLICE_ROWS)


def total(df, vector, dimension, make, shape, kind):
    """Sum over all rows of `make(x)`, an array of `shape` per slice of rows: added up per partition, then per row of the array."""
    numpy_kind, arrow_kind = {"long": (np.int64, pa.int64()), "double": (np.float64, pa.float64())}[kind]

    def run(batches):
        out = np.zeros(shape, numpy_kind)
        for batch in batches:
            for part in slices_of(batch):
                out += make(whole_numbers(part.column(0), dimension))
        yield pa.RecordBatch.from_arrays([pa.array(range(shape[0]), pa.int32()), pa.array(list(out), pa.list_(arrow_kind))], names=["row", "part"])

    def add(group):
        parts = group["part"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, shape[1])
        return pa.table({"row": group["row"].slice(0, 1), "part": pa.array([parts.sum(axis=0)], pa.list_(arrow_kind))})

    schema = f"row int, part array<{kind}>"
    rows = df.select(vector).mapInArrow(run, schema).groupBy("row").applyInArrow(add, schema).collect()
    out = np.zeros(shape, numpy_kind)
    for r in rows:
        out[r["row"]] = r["part"]
    return out


def fit(df, vector="embedding", components=32):
    """A `Whitening` with at most `components` components; None if no vector takes part."""
    rows, dimension = usable(df, vector)
    if dimension is None:
        return None
    ones = lambda x: np.concatenate([x.sum(axis=0), [len(x)]])[None, :]
    sums = total(rows, vector, dimension, ones, (1, dimension + 1), "long")[0]
    n, sums = int(sums[-1]), sums[:-1]
    mean = sums / n

    def products(x):
        centred = x - mean
        return centred.T @ centred

    covariance = total(rows, vector, dimension, products, (dimension, dimension), "double") / n
    covariance = (covariance + covariance.T) / 2
    values, vectors = leading_eigenpairs(covariance, components)
    return Whitening(n, sums, values, vectors, float(np.trace(covariance)))


def project(x, model):
    return (x - model.sums / model.n) @ (model.vectors / np.sqrt(model.values)[:, None]).T


def deviations(x, model):
    """Exact sums of (n x - S)^2; None where they exceed a long."""
    wide = np.abs(model.n * x.astype(float) - model.sums)
    if not len(x) or (wide**2).sum(axis=1).max() < 2.0**62:
        return pa.array(((model.n * x - model.sums) ** 2).sum(axis=1), pa.int64())
    sums = [int(s) for s in model.sums]
    exact = [sum((model.n * int(c) - s) ** 2 for c, s in zip(row, sums)) for row in x]
    return pa.array([v if v < 1 << 63 else None for v in exact], pa.int64())


def identity_error(df, model, vector="embedding"):
    """The largest absolute entry of the whitened vectors' covariance minus the identity (0 without components)."""
    count = len(model.values)
    if not count:
        return 0.0
    rows, dimension = usable(df, vector)

    def products(x):
        # The last row holds the sums; whitened vectors are centred up to rounding.
        white = project(x, model)
        return np.concatenate([white.T @ white, white.sum(axis=0)[None, :]])

    found = total(rows, vector, dimension, products, (count + 1, count), "double") / model.n
    return float(np.abs(found[:-1] - np.outer(found[-1], found[-1]) - np.eye(count)).max())


def whiten(df, model, vector="embedding"):
    """The rows of `df` that take part, with `deviation` (long) and `whitened` (array of doubles), which replace columns of these names."""
    taken = {"deviation", "whitened"}
    rows, dimension = usable(df.drop(*[c for c in df.columns if c.lower() in taken and c != vector]), vector)
    schema = StructType([*rows.schema.fields, StructField("deviation", LongType()), StructField("whitened", ArrayType(DoubleType()))])
    if model is None or dimension is None:
        return rows.withColumns({"deviation": F.lit(None).cast("long"), "whitened": F.lit(None).cast("array<double>")}).filter("false")

    def run(batches):
        for batch in batches:
            for part in slices_of(batch):
                x = whole_numbers(part.column(vector), model.dimension)
                white = pa.array(list(project(x, model)), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([*part.columns, deviations(x, model), white], names=schema.names)

    return rows.mapInArrow(run, schema)


def whitening_report(df, vector="embedding", vec_id="vec_id", components=32):
    """One row per vector that takes part and component: (vec_id, component, n, deviation, whitened, explained, identity_error)."""
    model = fit(df, vector, components)
    slim = df.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(vector).alias("embedding"))
    rows = whiten(slim, model, "embedding")
    long = rows.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    if model is None:
        error, explained, n = F.lit(0.0), F.lit(0.0), F.lit(0).cast("bigint")
    else:
        error = F.lit(identity_error(df, model, vector))
        shares = [float(v) / model.trace for v in model.values] or [0.0]
        explained, n = F.element_at(F.array(*[F.lit(s) for s in shares]), F.col("at") + 1), F.lit(model.n).cast("bigint")
    return long.select(
        "vec_id", (F.col("at") + 1).alias("component"), n.alias("n"), "deviation", "whitened", explained.alias("explained"), error.alias("identity_error")
    )

"""Approximate nearest neighbours by multiprobe p-stable hashing.

A hash is floor((a . x + b) / width) with Gaussian a, on vectors scaled to length one; a
table's bucket is the tuple of its `hashes` values. A query visits, in each table, its own
bucket and the neighbours that its point lies nearest to: perturbations by one cell per
hash, in the order of the sum of squared distances to the crossed borders, which is the
order of their estimated success. All candidates of a bucket are ranked by the exact
cosine in double precision, so a bucket gives its best `k` per query, and the best of all
visited buckets are merged.

Buckets meet their queries in a cogroup. A bucket with more than `BLOCK` vectors or queries
is dealt out in a grid of blocks by a hash of the ids, so no task holds an unbounded group;
the table of such buckets is small (see `attach`). Every vector is indexed. Queries that
found fewer than `k` while there are more vectors are answered by an exact pass in blocks.

Memory per group: BLOCK vectors, BLOCK queries, and tiles of `TILE` scores. Rows that move:
`tables` copies of each vector, and `tables` x `probes` copies of each query. Vectors of
unrelated directions are the hard case: with the default parameters about three quarters of
such a table are candidates, and the recall of the first five is 0.95. For tables of
billions, raise `hashes` by one for each threefold growth and `probes` along with it.
"""

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import Window, functions as F

from quarry.llm.common import LEAST_HOT, MOST_HOT, stored

TABLES, HASHES, WIDTH, PROBES, SEED = 6, 4, 1.5, 15, 7
BLOCK = 4096
TILE = 4_000_000
U64 = np.uint64


class Hashes:
    """The random projections for vectors of one dimension, and the order of perturbations."""

    def __init__(self, dimension, tables, hashes, width, seed):
        random = np.random.default_rng([seed, dimension])
        self.tables, self.hashes, self.width, self.dimension = tables, hashes, width, dimension
        self.directions = random.standard_normal((dimension, tables * hashes))
        self.offsets = random.uniform(0, width, tables * hashes)
        self.moves = np.array(list(itertools.product((0, -1, 1), repeat=hashes)))

    def places(self, unit):
        """Cells [vector, table, hash] and the position inside the cell, 0 to 1."""
        at = ((unit @ self.directions + self.offsets) / self.width).reshape(len(unit), self.tables, self.hashes)
        cells = np.floor(at)
        return cells.astype(np.int64), at - cells

    def keys(self, cells, table):
        """64-bit bucket keys of cells [..., hash] of a table; a collision only adds candidates."""
        with np.errstate(over="ignore"):
            key = np.full(cells.shape[:-1], U64(self.dimension) * U64(0x9E3779B97F4A7C15) + U64(table + 1))
            for k in range(self.hashes):
                key = (key ^ (key >> U64(29))) * U64(0xBF58476D1CE4E5B9) + cells[..., k].astype(U64)
            key = (key ^ (key >> U64(32))) * U64(0x94D049BB133111EB)
        return (key ^ (key >> U64(31))).view(np.int64)

    def probes(self, cells, inside, table, count):
        """Keys [vector, probe] of the `count` likeliest buckets of a table."""
        low, high = (inside * self.width) ** 2, ((1 - inside) * self.width) ** 2
        cost = low @ (self.moves == -1).T.astype(float) + high @ (self.moves == 1).T.astype(float)
        chosen = np.argsort(cost, axis=1, kind="stable")[:, :count]
        return self.keys(cells[:, None, :] + self.moves[chosen], table)


def usable(column):
    """(rows, vectors) of the usable vectors of a list column, by dimension."""
    groups = {}
    for row, values in enumerate(column.to_pylist()):
        if values and None not in values:
            groups.setdefault(len(values), []).append((row, values))
    for rows in groups.values():
        vectors = np.array([v for _, v in rows], np.float64)
        numbers = np.array([r for r, _ in rows])
        with np.errstate(over="ignore", invalid="ignore"):
            norms = np.sqrt((vectors * vectors).sum(axis=1))
        good = np.isfinite(norms) & (norms > 0)
        if good.any():
            yield numbers[good], vectors[good] / norms[good, None]


def hashed(df, settings, count):
    """(bucket, id, vector): with `count` None the own bucket of each table, else the probed ones."""

    def run(batches):
        made = {}
        for batch in batches:
            for rows, unit in usable(batch.column("vector")):
                dimension = unit.shape[1]
                hashes = made.setdefault(dimension, Hashes(dimension, **settings))
                part = batch.take(pa.array(rows))
                cells, inside = hashes.places(unit)
                for table in range(hashes.tables):
                    if count is None:
                        keys = hashes.keys(cells[:, table], table)[:, None]
                    else:
                        keys = hashes.probes(cells[:, table], inside[:, table], table, count)
                    again = part.take(pa.array(np.repeat(np.arange(len(unit)), keys.shape[1])))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys.ravel()), again.column("id"), again.column("vector")], names=["bucket", "id", "vector"]
                    )

    vector = df.schema["vector"].dataType.simpleString()
    return df.select("id", "vector").mapInArrow(run, f"bucket long, id long, vector {vector}")


def matrix(column):
    flat = column.combine_chunks()
    flat = flat.flatten() if not isinstance(flat, pa.ChunkedArray) else flat.chunk(0).flatten()
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def best_of_block(ids, vectors, queries, points, k):
    """(query, id, score) rows: the best `k` other ids of a block for each query, each with its best row."""
    by_id = np.argsort(ids, kind="stable")
    ids, vectors = ids[by_id], vectors[by_id]
    names, firsts = np.unique(ids, return_index=True)
    norms, sizes = np.sqrt((vectors * vectors).sum(axis=1)), np.sqrt((points * points).sum(axis=1))
    found = []
    step = max(1, TILE // max(len(ids), 1))
    for at in range(0, len(queries), step):
        rough = (points[at : at + step] / sizes[at : at + step, None]) @ (vectors / norms[:, None]).T
        # The k-th best id decides, not the k-th best row: repeated ids would crowd out the others.
        best = np.maximum.reduceat(rough, firsts, axis=1) if len(names) < len(ids) else rough
        for row, query in enumerate(queries[at : at + step].tolist()):
            scores = best[row, names != query]
            if not len(scores):
                continue
            others = ids != query
            if len(scores) > k:
                others &= rough[row] >= np.partition(scores, len(scores) - k)[len(scores) - k] - 1e-9
            others = np.flatnonzero(others)
            # Equal vectors get equal scores only if summed alike, which a matrix product doesn't promise.
            exact = (vectors[others] * points[at + row]).sum(axis=1) / (norms[others] * sizes[at + row])
            order = np.lexsort((ids[others], -exact))
            if len(names) < len(ids):
                order = order[np.sort(np.unique(ids[others[order]], return_index=True)[1])]
            found += [(query, int(ids[others[o]]), float(exact[o])) for o in order[:k]]
    return found


def meet(vectors, queries, k):
    """(query_id, vec_id, score) of all (bucket, block, query_block) groups of the two sides."""
    fields = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def run(left, right):
        if not left.num_rows or not right.num_rows:
            return fields.empty_table()
        rows = best_of_block(left["id"].to_numpy(), matrix(left["vector"]), right["id"].to_numpy(), matrix(right["vector"]), k)
        columns = list(zip(*rows)) or [(), (), ()]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, fields)], schema=fields)

    keys = ["bucket", "block", "query_block"]
    return vectors.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInArrow(run, "query_id long, vec_id long, score double")


def large_buckets(hashed_rows, name):
    """(bucket, `name`): the number of blocks of buckets with more than a block of rows."""
    counts = stored(hashed_rows.groupBy("bucket").agg(F.count("*").alias("n")))
    total = counts.agg(F.sum("n")).first()[0] or 0
    most = max(BLOCK, LEAST_HOT, total // MOST_HOT)
    large = counts.filter(F.col("n") > most)
    return F.broadcast(large.select("bucket", F.ceil(F.col("n") / most).cast("int").alias(name)))


def dealt(rows, own, blocks, others, copies):
    """Rows get one of their side's blocks and a copy for every block of the other side."""
    slot = F.pmod(F.xxhash64("id"), F.coalesce(blocks, F.lit(1))).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.coalesce(copies, F.lit(1)) - 1))
    return rows.withColumn(own, slot).withColumn(others, every).select("bucket", "block", "query_block", "id", "vector")


def grid(vectors, queries):
    """Both sides with (bucket, block, query_block)."""
    wide, busy = large_buckets(vectors, "blocks"), large_buckets(queries, "query_blocks")
    both = lambda rows: rows.join(wide, "bucket", "left").join(busy, "bucket", "left")
    return (
        dealt(both(vectors), "block", F.col("blocks"), "query_block", F.col("query_blocks")),
        dealt(both(queries), "query_block", F.col("query_blocks"), "block", F.col("blocks")),
    )


def first_of(found, k):
    """The best `k` per query, ties to the smaller id; an id that was found again counts once."""
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return once.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest(vectors, queries, k=5, vec_id="vec_id", vector="embedding", tables=TABLES, hashes=HASHES, width=WIDTH, probes=PROBES, seed=SEED):
    """(query_id, rank, vec_id, score): the `k` nearest of `vectors` found for every row of `queries`.

    Nearness is the cosine. A row with the query's id is never its neighbour; rows that share
    an id count as one, with the better score. Rows with a null id, and vectors that are null,
    empty, zero or hold nulls or non-finite numbers take no part on either side. Vectors of
    different dimensions are never compared. With fewer than `k` other vectors all are returned.
    Other columns are ignored.
    """
    settings = {"tables": tables, "hashes": hashes, "width": width, "seed": seed}
    slim = lambda df: df.select(F.col(vec_id).cast("bigint").alias("id"), F.col(vector).alias("vector")).filter("id IS NOT NULL AND vector IS NOT NULL")
    index, asked = stored(hashed(slim(vectors), settings, None)), stored(hashed(slim(queries), settings, probes))
    visited = asked.join(index.select("bucket").distinct(), "bucket", "left_semi")
    found = stored(first_of(meet(*grid(index, visited), k), k))
    # Queries that found too few, if there is more to find among the vectors of their dimension.
    few = asked.groupBy("id").agg(F.max(F.size("vector")).alias("dimension")).join(
        found.groupBy(F.col("query_id").alias("id")).agg(F.count("*").alias("n")), "id", "left"
    ).filter(F.coalesce("n", F.lit(0)) < k)
    there = index.groupBy(F.size("vector").alias("dimension")).agg(F.count_distinct("id").alias("there"))
    few = stored(few.join(there, "dimension").filter(F.coalesce("n", F.lit(0)) < F.col("there") - 1).select("id"))
    if few.isEmpty():
        return found
    whole = lambda rows: rows.dropDuplicates(["id", "vector"]).withColumn("bucket", F.size("vector").cast("bigint"))
    left = whole(asked.join(few, "id", "left_semi"))
    exact = first_of(meet(*grid(whole(index), left), k), k)
    return found.join(few, found["query_id"] == few["id"], "left_anti").unionByName(exact)

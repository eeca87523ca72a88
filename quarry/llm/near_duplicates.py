"""Near-duplicate groups: fast similarity sketches, banding, exact verification.

1. `sketch_documents` turns a text into its set of word shingles (64-bit hashes), a 128-bit
   digest of the set, and a sketch of `COORDINATES` minima. The sketch throws the whole set
   into bins, round after round with new hashes; values of a later round are larger by one,
   so each coordinate keeps the minimum of the first round that reached it. After
   `COORDINATES` random rounds, round COORDINATES + k puts everything into bin k, so that
   every coordinate is filled. Large sets need one round, that is time O(t log t + n).
2. Documents with equal sets form a class; only the class's smallest document goes on.
3. Bands of coordinates are hashed. Every band value links its documents to the smallest one
   (star candidates, never all pairs), and links are confirmed on the full sets.
4. A band value whose documents are not all connected by then may hide links between the
   others. Its documents go through an exact prefix filter: with shingles ordered from the
   rarest, two sets over the threshold share one of their first n - ceil(share * n) + 1
   shingles. First each such shingle's most central document meets the others, round by
   round; then the documents of such a hub that are still in different components are
   compared in blocks, where what each has for itself doesn't rule a link out.
5. Components of the confirmed links. Every document gets the smallest one it can reach.

`band_rows` picks the longest band for which a pair at the threshold is missed with a
probability of at most 1e-8.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Window, functions as F

from quarry.llm.common import attach, broadcast_up_to, stored
from quarry.operators.components import connected_components

COORDINATES = 256
BIN_BITS = 8
MISS = 1e-8
STAR_ROUNDS = 3
BROADCAST_ROWS = 1_000_000
SLICE_BYTES = 2 << 20
BLOCK_SHINGLES = 500_000
U64 = np.uint64

SKETCH = "doc_id long, n_shingles long, set_low long, set_high long, bands array<long>"


def band_rows(percent, coordinates=COORDINATES, miss=MISS):
    share, rows = percent / 100, 1
    while (1 - share ** (rows + 1)) ** (coordinates // (rows + 1)) <= miss:
        rows += 1
    return rows


def mix(x):
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def mixed_numbers(start, count):
    with np.errstate(over="ignore"):
        return mix((np.arange(count, dtype=U64) + U64(start)) * U64(0x9E3779B97F4A7C15))


BYTE_VALUES = mixed_numbers(1, 256)
ROUND_SEEDS = mixed_numbers(1 << 20, 2 * COORDINATES)
WORD_STEP, SHINGLE_STEP = U64(0xD6E8FEB86659FD93), U64(0xA0761D6478BD642F)


def powers(step, count):
    out = np.full(count, step, dtype=U64)
    out[0] = 1
    return np.multiply.accumulate(out)


def word_hashes(data, ends):
    """Hashes of all words of concatenated UTF-8 texts, and the number of words before each text's end.

    Words are runs without space, tab and line breaks; A-Z count as lower case.
    """
    space = (data == 32) | ((data >= 9) & (data <= 13))
    lower = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    begins = ~space
    begins[1:] &= space[:-1]
    cuts = ends[:-1][ends[:-1] < len(data)]
    begins[cuts] = ~space[cuts]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return np.zeros(0, U64), np.zeros(len(ends), np.int64)
    place = np.zeros(len(data), np.int64)
    word_starts = np.repeat(starts, np.diff(np.append(starts, len(data))))
    place[starts[0] :] = np.arange(starts[0], len(data)) - word_starts
    place[space] = 0
    step = powers(WORD_STEP, int(place.max()) + 1)
    parts = BYTE_VALUES[lower] * step[place]
    parts[space] = 0
    return mix(np.add.reduceat(parts, starts)), np.searchsorted(starts, ends)


def shingle_sets(texts, size):
    """The sorted distinct shingle hashes of every text of a list-like Arrow string array."""
    sizes = np.diff(np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1])
    ends = np.cumsum(sizes, dtype=np.int64)
    first = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset]
    total = int(ends[-1]) if len(ends) else 0
    data = np.frombuffer(texts.buffers()[2], np.uint8)[first : first + total] if total else np.zeros(0, np.uint8)
    with np.errstate(over="ignore"):
        hashes, counts = word_hashes(data, ends) if total else (np.zeros(0, U64), np.zeros(len(ends), np.int64))
        runs = np.zeros(max(len(hashes) - size + 1, 0), U64)
        for k in range(size):
            runs = runs * SHINGLE_STEP + hashes[k : k + len(runs)]
        runs = mix(runs + U64(size))
        before = 0
        for count in counts.tolist():
            n = count - before
            if n >= size:
                yield np.unique(runs[before : count - size + 1])
            elif n:
                short = U64(0)
                for h in hashes[before:count]:
                    short = short * SHINGLE_STEP + h
                yield np.array([mix(short + U64(n))])
            else:
                yield np.zeros(0, U64)
            before = count


def sketches(sets):
    """One row of `COORDINATES` values per non-empty set."""
    sizes = np.array([len(s) for s in sets])
    items, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    table = np.full(len(sets) * COORDINATES, np.iinfo(np.uint64).max, U64)
    empty, shift = U64(1 << 63), U64(54)
    with np.errstate(over="ignore"):
        for number, seed in enumerate(ROUND_SEEDS):
            x = mix(items ^ seed)
            if number < COORDINATES:
                bins = (x & U64(COORDINATES - 1)).astype(np.int64)
            else:
                bins = np.full(len(x), number - COORDINATES)
            np.minimum.at(table, owner * COORDINATES + bins, (U64(number) << shift) | (x >> U64(10)))
            open_sets = (table.reshape(len(sets), COORDINATES) >= empty).any(axis=1)
            if not open_sets.any():
                break
            left = open_sets[owner]
            items, owner = items[left], owner[left]
    return table.reshape(len(sets), COORDINATES)


def band_hashes(table, rows):
    count = COORDINATES // rows
    with np.errstate(over="ignore"):
        out = mixed_numbers(1 << 30, count)[None, :].repeat(len(table), axis=0)
        for k in range(rows):
            out = mix(out * SHINGLE_STEP + table[:, k : count * rows : rows])
    return out.view(np.int64)


def text_slices(batch, limit=SLICE_BYTES, column="text"):
    """Parts of a batch of about `limit` text bytes, so that arrays stay small."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    at = 0
    while at < len(sizes):
        count = max(1, int(np.searchsorted(np.cumsum(sizes[at : at + 4096]), limit, side="right")))
        yield batch.slice(at, count)
        at += count


def plain_texts(batch, column="text"):
    texts = pc.fill_null(batch.column(column).cast(pa.string()), "")
    return texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts


def signed_list(values, ends):
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(values.view(np.int64)))


def digests(sets):
    """Two 64-bit numbers per set that don't depend on the order of its members."""
    with np.errstate(over="ignore"):
        low = [np.add.reduce(mix(s ^ U64(0x5851F42D4C957F2D))) for s in sets]
        high = [np.bitwise_xor.reduce(mix(s + U64(0x14057B7EF767814F))) for s in sets]
    return np.array(low, U64).view(np.int64), np.array(high, U64).view(np.int64)


def sketch_documents(docs, size, rows):
    """Rows of `SKETCH` for (doc_id, text); digest and bands are null for empty sets."""

    def run(batches):
        for batch in batches:
            for part in text_slices(batch):
                sets = list(shingle_sets(plain_texts(part), size))
                full = [s for s in sets if len(s)]
                counts = np.array([len(s) for s in sets], np.int64)
                at = np.cumsum(counts > 0) - 1
                if full:
                    low, high = digests(full)
                    bands = band_hashes(sketches(full), rows)
                else:
                    low = high = np.zeros(1, np.int64)
                    bands = np.zeros((1, 1), np.int64)
                none = counts == 0
                at = np.maximum(at, 0)
                width = bands.shape[1]
                lists = pa.FixedSizeListArray.from_arrays(pa.array(bands[at].ravel()), width).cast(pa.list_(pa.int64()))
                lists = pc.if_else(pa.array(none), pa.scalar(None, pa.list_(pa.int64())), lists)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(counts), pa.array(low[at], mask=none), pa.array(high[at], mask=none), lists],
                    names=["doc_id", "n_shingles", "set_low", "set_high", "bands"],
                )

    return docs.mapInArrow(run, SKETCH)


def shingles_of(docs, size):
    """(doc_id, shingles array<long>) for (doc_id, text)."""

    def run(batches):
        for batch in batches:
            for part in text_slices(batch):
                sets = list(shingle_sets(plain_texts(part), size))
                lists = signed_list(np.concatenate(sets), np.cumsum([len(s) for s in sets]))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), lists], names=["doc_id", "shingles"])

    return docs.mapInArrow(run, "doc_id long, shingles array<long>")


def confirmed(pairs, sets, percent):
    """The pairs (a, b) whose full sets reach the threshold."""
    side = lambda c: sets.select(F.col("doc_id").alias(c), F.col("shingles").alias(f"set_{c}"))
    both = pairs.join(side("b"), "b").join(side("a"), "a")
    shared = F.size(F.array_intersect("set_a", "set_b"))
    union = F.size("set_a") + F.size("set_b") - F.col("shared")
    return both.withColumn("shared", shared).filter(100 * F.col("shared") >= percent * union).select("a", "b").distinct()


def labelled(members, links):
    """`members` with the component of their document under `links`."""
    found = connected_components(links, "a", "b").select(F.col("node").alias("doc_id"), "component")
    return members.join(found, "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))


def rare_shingles(members, links, sets, percent):
    """(shingle, doc_id, n, alone): prefixes of the documents whose band values are not all connected.

    `alone` counts shingles that no other of these documents has. They come first in the
    order, so a document with as many as its prefix is long can't have a partner here.
    """
    known = stored(labelled(members, links))
    mixed = known.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    open_bands = mixed.filter("low <> high").select("band")
    documents = known.join(open_bands, "band", "left_semi").select("doc_id").distinct()
    rows = stored(sets.join(documents, "doc_id").select("doc_id", F.size("shingles").alias("n"), F.explode("shingles").alias("shingle")))
    counts = rows.groupBy("shingle").agg(F.count("*").alias("n_docs"))
    prefix = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    shared = attach(rows, stored(counts.filter("n_docs > 1").withColumn("size", F.col("n_docs"))), ["shingle"], ["doc_id"], "size")
    alone = F.count(F.when(F.col("n_docs").isNull(), True)).over(Window.partitionBy("doc_id"))
    rank = F.row_number().over(Window.partitionBy("doc_id").orderBy("n_docs", "shingle"))
    ranked = shared.withColumn("alone", alone).filter("n_docs IS NOT NULL").filter(F.col("alone") < prefix)
    rare = ranked.withColumn("rank", rank + F.col("alone")).filter(F.col("rank") <= prefix)
    return stored(rare.select("shingle", "doc_id", "n", "alone"))


def may_link(percent, n, alone, other_n, other_alone):
    """What two sets can share at most is the smaller of their parts that others have too."""
    shared = F.least(n - alone, other_n - other_alone)
    return 100 * shared >= percent * (n + other_n - shared)


def open_shingles(rare, links):
    """`rare` with components, where a shingle still spans several of them."""
    known = stored(labelled(rare, links))
    spans = known.groupBy("shingle").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return stored(known.join(spans.filter("low <> high").select("shingle"), "shingle", "left_semi"))


def with_hubs(known):
    """`known` with `hub`: the shingle's most central document, the one with the least of its own."""
    hubs = known.groupBy("shingle").agg(
        F.min(F.struct((F.col("alone") / F.col("n")).alias("share"), "doc_id", "component", "n", "alone")).alias("hub"), F.count("*").alias("size")
    )
    return attach(known, stored(hubs), ["shingle"], ["doc_id"], "size")


def star_pairs(known, percent):
    """Pairs of hubs and the other documents of their shingles, in other components."""
    both = with_hubs(known).filter(F.col("hub.component") != F.col("component"))
    both = both.filter(may_link(percent, F.col("n"), F.col("alone"), F.col("hub.n"), F.col("hub.alone")))
    return stored(both.select(F.col("hub.doc_id").alias("a"), F.col("doc_id").alias("b")).distinct())


def block_links(left, right, percent):
    """Confirmed links between two blocks of documents: one per pair of components."""
    flat = [t["shingles"].combine_chunks().flatten().to_numpy() for t in (left, right)]
    starts = np.concatenate([[0], np.cumsum(right["n"].to_numpy())[:-1]])
    values, codes = np.unique(np.concatenate(flat), return_inverse=True)
    own, other = codes[: len(flat[0])], codes[len(flat[0]) :]
    ends = np.cumsum(left["n"].to_numpy())
    n, alone, component, ids = (right[c].to_numpy() for c in ("n", "alone", "component", "doc_id"))
    mark, done, out = np.zeros(len(values), bool), set(), []
    for row, (doc, label, size, extra) in enumerate(zip(*(left[c].to_pylist() for c in ("doc_id", "component", "n", "alone")))):
        most = np.minimum(size - extra, n - alone)
        open_rows = (component != label) & (100 * most >= percent * (n + size - most))
        if not open_rows.any():
            continue
        mine = own[ends[row] - size : ends[row]]
        mark[mine] = True
        shared = np.add.reduceat(mark[other], starts, dtype=np.int64)
        mark[mine] = False
        for hit in np.flatnonzero(open_rows & (100 * shared >= percent * (n + size - shared))).tolist():
            pair = (min(label, int(component[hit])), max(label, int(component[hit])))
            if pair not in done:
                done.add(pair)
                out.append((doc, int(ids[hit])))
    return out


def cross_links(known, sets, percent):
    """Confirmed links between different components among the documents of a hub.

    Documents that share a rare shingle share its hub, so they meet here. A hub's documents
    are dealt out in blocks of about `BLOCK_SHINGLES`, and blocks meet in pairs, each pair a
    group of its own; only links leave a group, never pairs.
    """
    members = stored(with_hubs(known).select(F.col("hub.doc_id").alias("hub"), "doc_id", "component", "n", "alone").distinct())
    spans = members.groupBy("hub").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.sum("n").alias("shingles"), F.count("*").alias("size")
    )
    spans = spans.filter("low <> high").select("hub", "size", F.ceil(F.col("shingles") / BLOCK_SHINGLES).cast("int").alias("blocks"))
    dealt = attach(members, stored(spans), ["hub"], ["doc_id"], "size").filter("blocks IS NOT NULL")
    dealt = dealt.withColumns({"own": F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"), "every": F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))})
    dealt = stored(dealt.join(sets.dropDuplicates(["doc_id"]), "doc_id").withColumn("n", F.size("shingles").cast("bigint")))
    columns = ["hub", "doc_id", "component", "n", "alone", "shingles"]
    left = dealt.filter("own <= every").select(*columns, F.col("own").alias("i"), F.col("every").alias("j"))
    right = dealt.filter("every <= own").select(*columns, F.col("every").alias("i"), F.col("own").alias("j"))
    fields = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(x, y):
        if not x.num_rows or not y.num_rows:
            return fields.empty_table()
        links = block_links(x, y, percent)
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})

    keys = ["hub", "i", "j"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, "a long, b long").distinct()


def residue_links(members, links, sets, percent):
    """All links, with the further ones of step 4."""
    rare = rare_shingles(members, links, sets, percent)
    for _ in range(STAR_ROUNDS):
        known = open_shingles(rare, links)
        more = stored(confirmed(star_pairs(known, percent), sets, percent))
        if more.isEmpty():
            break
        links = stored(links.unionByName(more))
    else:
        known = open_shingles(rare, links)
    return stored(links.unionByName(cross_links(known, sets, percent)))


def confirmed_links(docs, sketched, percent, size):
    """(a, b) links between class representatives: all that steps 3 and 4 confirm."""
    classes = sketched.filter("set_low IS NOT NULL AND doc_id IS NOT NULL").groupBy("set_low", "set_high", "n_shingles")
    firsts = classes.agg(F.min("doc_id").alias("doc_id"), F.first("bands").alias("bands"))
    bands = stored(firsts.select("doc_id", F.explode("bands").alias("band")))
    shared = bands.groupBy("band").agg(F.min("doc_id").alias("hub"), F.count("*").alias("n")).filter("n > 1")
    members = stored(attach(bands, stored(shared), ["band"], ["doc_id"]).filter("hub IS NOT NULL"))
    pairs = stored(members.filter("hub < doc_id").select(F.col("hub").alias("a"), F.col("doc_id").alias("b")).distinct())
    involved = members.select("doc_id").distinct()
    texts = docs.join(broadcast_up_to(stored(involved), BROADCAST_ROWS), "doc_id", "left_semi")
    sets = stored(shingles_of(texts, size))
    links = stored(confirmed(pairs, sets, percent))
    return residue_links(members, links, sets, percent)


def near_duplicate_groups(docs, percent=80, size=5, doc_id="doc_id", text="text"):
    """One row per document: (doc_id, n_shingles, component_id, kept).

    Words are ASCII-lowercased; a text of fewer than `size` words is one shingle, a text
    without words (or null) has none and is linked with nothing. Documents are linked from a
    Jaccard similarity of `percent` / 100 on. `component_id` is the smallest id reachable;
    `kept` says whether it is the document's own. Rows that share an id count as one document
    and each get their row. A row with a null id reports the smallest id of equal texts (null
    if there is none), is kept only without one, and links nothing. Other columns are ignored.
    """
    docs = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    rows = band_rows(percent)
    sketched = stored(sketch_documents(docs, size, rows))
    keys = ["set_low", "set_high"]
    links = confirmed_links(docs, sketched, percent, size)
    found = connected_components(links, "a", "b").select(F.col("node").alias("first_id"), "component")
    classes = sketched.filter("set_low IS NOT NULL").groupBy(*keys).agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n"))
    groups = classes.join(found, "first_id", "left").filter("n > 1 OR component IS NOT NULL")
    groups = groups.select(*keys, "n", F.coalesce("component", "first_id").alias("component"))
    joined = attach(sketched.drop("bands"), stored(groups), keys, ["doc_id"])
    return joined.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")).select(
        "*", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def keep_one_per_group(docs, percent=80, size=5, doc_id="doc_id", text="text"):
    """The rows of `docs`, one for every group of near duplicates: the one with the smallest id.

    Of repeated rows with that id one stays; rows without an id stay.
    """
    report = stored(near_duplicate_groups(docs, percent, size, doc_id, text))
    known = report.filter("doc_id IS NOT NULL")
    other = stored(known.filter("NOT kept").select("doc_id").distinct())
    twice = stored(known.filter("kept").groupBy("doc_id").count().filter("count > 1").select("doc_id"))
    left = docs.join(broadcast_up_to(other, BROADCAST_ROWS), docs[doc_id] == other["doc_id"], "left_anti")
    if twice.isEmpty():
        return left
    once = left.join(twice, left[doc_id] == twice["doc_id"], "left_semi").dropDuplicates([doc_id])
    return left.join(twice, left[doc_id] == twice["doc_id"], "left_anti").unionByName(once)

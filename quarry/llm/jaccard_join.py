"""N-gram Jaccard join in metric space: pivots, Voronoi regions, triangle-inequality windows.

One minus the Jaccard similarity of two shingle sets is a metric d; documents link where
d <= r. The join is exact and has no cap on partners.

1. Documents with equal sets form a class; one set per class goes on.
2. A set with a partner shares with it all but a few of any of its shingles. So it is left out
   if too few of its shingles in a fixed third of the hash range occur in a second set.
3. Most pairs are at distance one, where no pivot can part them. Two sets within r share one
   of their rarest shingles (n - ceil(share * n) + 1 of each), so the pivots of the first level
   stand for these shingles: the most central set of each. A set is a member of the regions of
   its shingles' pivots, and partners always meet in one. Distances to the pivot give links.
4. Only what these links leave in different components has to be compared. In a region, a set
   of the pivot's component at a distance below the window (the nearest foreign member's
   distance less r) can't have a partner there and goes.
5. A heavy region draws pivots from its members, and all distances to them are taken, which
   gives links. A member within CORE of its nearest pivot is of that pivot's Voronoi region. It
   is repeated, as a boundary document, in the region of every other pivot q with d(x, q) <=
   CORE + r and d(x, q) <= d(x, nearest) + 2 r: by the triangle inequality no partner of a
   region's own member is elsewhere. Members farther than CORE - r from all pivots form one more
   region. Where the windows would repeat more than REPEATED times the members (a tight cluster,
   which the links mostly join), the region stays whole. Then 4 and 5 again, until it is light.
6. A light region is compared inside one task: the members outside of its largest component with
   all. What is heavy after LEVELS rounds is dealt in blocks of bounded size, each a task. Only
   links leave a task, at most one for every pair of components, and members whose distances to
   the pivot differ by more than r, or whose sizes or unshared parts rule a link out, aren't compared.
7. Components of all links; every document gets the smallest id it can reach.

Hot shingles, pivots and classes are salted (`attach`), regions and blocks have a size bound.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from quarry.llm.common import Scratch, attach, broadcast_up_to, stored
from quarry.llm.near_duplicates import digests, plain_texts, shingle_sets, signed_list, text_slices
from quarry.operators.components import connected_components

SAMPLE_SHARE = 3
# A region above this weight is split, so that a task holds some megabytes; a member weighs its shingles and MEMBER_WEIGHT.
LEAF_WEIGHT, MEMBER_WEIGHT = 500_000, 50
PIVOTS, CORE, LEVELS, REPEATED = 16, 0.5, 4, 2
BROADCAST_ROWS = 1_000_000

DESCRIBED = "doc_id long, row long, n_shingles long, set_low long, set_high long, sample array<long>"
SETS = "set_low long, set_high long, shingles array<long>"
FAR_FIELDS = pa.schema([("region", pa.string()), ("set_id", pa.int64()), ("n", pa.int64()), ("alone", pa.int64()), ("component", pa.int64())])
MEMBERS = ["region", "set_id", "n", "alone", "component", "delta"]


def describe(docs, size):
    """Per row of (doc_id, row, text): set size, 128-bit digest (null if empty), and the set's shingles in a third of the hash range."""

    def run(batches):
        for batch in batches:
            for part in text_slices(batch):
                sets = list(shingle_sets(plain_texts(part), size))
                counts = np.array([len(s) for s in sets], np.int64)
                low, high = digests(sets)
                samples = [s[s % np.uint64(SAMPLE_SHARE) == 0] for s in sets]
                lists = signed_list(np.concatenate(samples), np.cumsum([len(s) for s in samples]))
                none = counts == 0
                columns = [part.column("doc_id"), part.column("row"), pa.array(counts), pa.array(low, mask=none), pa.array(high, mask=none), lists]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "row", "n_shingles", "set_low", "set_high", "sample"])

    return docs.select("doc_id", "row", "text").mapInArrow(run, DESCRIBED)


def sets_of(texts, size):
    """(set_low, set_high, shingles), once per set."""

    def run(batches):
        for batch in batches:
            for part in text_slices(batch):
                sets = [s for s in shingle_sets(plain_texts(part), size) if len(s)]
                if sets:
                    low, high = digests(sets)
                    lists = signed_list(np.concatenate(sets), np.cumsum([len(s) for s in sets]))
                    yield pa.RecordBatch.from_arrays([pa.array(low), pa.array(high), lists], names=["set_low", "set_high", "shingles"])

    return texts.select("text").mapInArrow(run, SETS).groupBy("set_low", "set_high").agg(F.first("shingles").alias("shingles"))


def least_shared(n, percent):
    """How many of its n shingles a set has in common with any partner, at least."""
    return F.ceil(n * percent / 100)


def with_shared_counts(rows, scratch):
    """`rows` of (set_id, shingle) whose shingle is in several sets, with `n_sets`."""
    counts = rows.groupBy("shingle").agg(F.count("*").alias("n_sets")).filter("n_sets > 1")
    counts = scratch.keep(counts.withColumn("n", F.col("n_sets")))
    return attach(rows, counts, ["shingle"], ["set_id"]).filter("n_sets IS NOT NULL")


def with_partners_possible(described, classes, percent, scratch):
    """Step 2: the classes whose sample does not rule a partner out.

    Of a class the rows with its `row` take part; equal rows only raise the counts.
    """
    keys = ["row", "set_low", "set_high"]
    firsts = described.join(broadcast_up_to(classes.select(*keys, "set_id"), BROADCAST_ROWS), keys)
    parts = firsts.select("set_id", F.explode("sample").alias("shingle"))
    hits = with_shared_counts(parts, scratch).groupBy("set_id").agg(F.count("*").alias("hits"))
    sizes = firsts.groupBy("set_id").agg(F.max(F.size("sample")).alias("size"))
    least = F.col("size") - (F.col("n_shingles") - least_shared(F.col("n_shingles"), percent))
    return classes.join(sizes, "set_id").join(hits, "set_id", "left").filter(F.coalesce("hits", F.lit(0)) >= least)


def rare_shingles(sets, percent, scratch):
    """(shingle, set_id, n, alone): of every set the shared ones among its n - ceil(share n) + 1 rarest.

    Ties are ordered by the hash, alike in all sets. `alone` counts the shingles that no other set has; they come first.
    """
    shared = with_shared_counts(sets.select("set_id", F.explode("shingles").alias("shingle")), scratch)
    lists = shared.groupBy("set_id").agg(F.sort_array(F.collect_list(F.struct("n_sets", "shingle"))).alias("shared"))
    lists = lists.join(sets.select("set_id", "n"), "set_id")
    alone = F.col("n") - F.size("shared")
    left = F.col("n") - least_shared(F.col("n"), percent) + 1 - F.col("alone")
    prefix = lists.withColumn("alone", alone).filter(left > 0)
    return prefix.select("set_id", "n", "alone", F.explode(F.slice("shared", F.lit(1), left.cast("int"))).alias("s")).select("s.shingle", "set_id", "n", "alone")


def may_link(percent, n, alone, other_n, other_alone):
    """Sets can have in common at most the smaller of their parts that other sets have too."""
    most = F.least(n - alone, other_n - other_alone)
    return 100 * most >= percent * (n + other_n - most)


def first_regions(rare, sets, percent, scratch):
    """(region, set_id, n, alone, delta) of the first level; `delta` is null where a bound already rules a link to the pivot out."""
    centre = F.min(F.struct((F.col("alone") / F.col("n")).alias("share"), "set_id", "n", "alone")).alias("pivot")
    pivots = scratch.keep(rare.groupBy("shingle").agg(centre, F.count("*").alias("size")).filter("size > 1"))
    both = attach(rare, pivots, ["shingle"], ["set_id"], "size").filter("pivot IS NOT NULL")
    near = may_link(percent, F.col("n"), F.col("alone"), F.col("pivot.n"), F.col("pivot.alone"))
    members = scratch.keep(both.select(F.col("pivot.set_id").alias("region"), "set_id", "n", "alone", near.alias("near")).distinct())
    pairs = scratch.keep(members.filter("near AND region <> set_id").select("region", "set_id"))
    sizes = pairs.groupBy("region").agg(F.count("*").alias("size"))
    centres = scratch.keep(sizes.join(sets.select(F.col("set_id").alias("region"), F.col("shingles").alias("centre")), "region"))
    measured = attach(pairs, centres, ["region"], ["set_id"], "size").join(sets.select("set_id", "shingles"), "set_id")
    shared = F.size(F.array_intersect("shingles", "centre"))
    union = F.size("shingles") + F.size("centre") - F.col("shared")
    measured = measured.withColumn("shared", shared).select("region", "set_id", "shared", union.alias("whole"))
    measured = scratch.keep(measured)
    delta = F.when(F.col("region") == F.col("set_id"), F.lit(0.0)).otherwise(1 - F.col("shared") / F.col("whole"))
    rows = members.join(measured, ["region", "set_id"], "left").withColumn("delta", delta)
    links = measured.filter(100 * F.col("shared") >= percent * F.col("whole")).select(F.col("region").alias("a"), F.col("set_id").alias("b"))
    return scratch.keep(rows.select(F.col("region").cast("string").alias("region"), "set_id", "n", "alone", "delta")), scratch.keep(links)


def with_components(members, links, scratch):
    found = connected_components(links, "a", "b").select(F.col("node").alias("set_id"), F.col("component").alias("_found"))
    joined = members.drop("component").join(found, "set_id", "left")
    return scratch.keep(joined.withColumn("component", F.coalesce("_found", "set_id")).select(*MEMBERS))


def open_members(members, radius, scratch):
    """Step 4: members of regions with several components, without those the window rules out.

    The region's core is the component of its nearest member. `weight` and `members` are the region's.
    """
    keys = members.groupBy("region").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("size"),
        F.min_by("component", F.coalesce("delta", F.lit(2.0))).alias("core"),
    )
    keys = scratch.keep(keys.filter("low <> high").select("region", "size", "core"))
    several = scratch.keep(attach(members, keys, ["region"], ["set_id"], "size").filter("core IS NOT NULL"))
    foreign = several.groupBy("region", "core").agg(
        F.min(F.when(F.col("component") != F.col("core"), F.coalesce("delta", F.lit(0.0)))).alias("nearest"), F.count("*").alias("size")
    )
    outer = attach(several.drop("core"), scratch.keep(foreign), ["region"], ["set_id"], "size")
    slack = 1e-9
    left = outer.filter((F.col("component") != F.col("core")) | F.col("delta").isNull() | (F.col("delta") >= F.col("nearest") - radius - slack))
    left = scratch.keep(left.select(*MEMBERS))
    weights = left.groupBy("region").agg(F.sum(F.col("n") + MEMBER_WEIGHT).alias("weight"), F.count("*").alias("size"), F.count("*").alias("members"))
    weighed = attach(left, scratch.keep(weights), ["region"], ["set_id"], "size")
    return scratch.keep(weighed)


def codes_of(left, right):
    """The shingles of both tables as small numbers, and how many numbers there are."""
    flat = [t["shingles"].combine_chunks().flatten().to_numpy() for t in (left, right)]
    values, codes = np.unique(np.concatenate(flat), return_inverse=True)
    return codes[: len(flat[0])], codes[len(flat[0]) :], len(values)


def starts_of(table):
    return np.concatenate([[0], np.cumsum(table["n"].to_numpy())[:-1]]).astype(np.int64)


def assign_regions(members, pivots, percent, radius):
    """Step 5 for a slice of a region: rows of (region, set_id, n, alone, component, delta, pivot, linked)."""
    own, other, count = codes_of(members, pivots)
    starts, size = starts_of(members), members["n"].to_numpy()
    at, sizes, ids = starts_of(pivots), pivots["n"].to_numpy(), pivots["set_id"].to_pylist()
    mark, shared = np.zeros(count, bool), np.zeros((len(ids), len(size)), np.int64)
    for k in range(len(ids)):
        mine = other[at[k] : at[k] + sizes[k]]
        mark[mine] = True
        shared[k] = np.add.reduceat(mark[own], starts, dtype=np.int64)
        mark[mine] = False
    union = size[None, :] + sizes[:, None] - shared
    distance, slack = 1 - shared / union, 1e-9
    nearest = distance.min(axis=0)
    home = distance.argmin(axis=0)
    here = (distance <= min(CORE + radius, 1.0) + slack) & (distance <= nearest + 2 * radius + slack)
    here |= (np.arange(len(ids))[:, None] == home[None, :]) & (nearest <= CORE)
    linked = 100 * shared >= percent * union
    far = nearest > CORE - radius - slack
    kept = [np.flatnonzero(here[k] | linked[k]) for k in range(len(ids))]
    parts = [(rows, pa.array([name] * len(rows), pa.int64()), distance[k, rows], linked[k, rows]) for k, (name, rows) in enumerate(zip(ids, kept))]
    rows, names, deltas, links = (list(x) for x in zip(*parts))
    lone = int(far.sum())
    table = members.select(["region", "set_id", "n", "alone", "component"]).take(pa.array(np.concatenate([*rows, np.flatnonzero(far)])))
    return (
        table.append_column("delta", pa.chunked_array([*[pa.array(d) for d in deltas], pa.nulls(lone, pa.float64())]))
        .append_column("pivot", pa.chunked_array([*names, pa.nulls(lone, pa.int64())]))
        .append_column("linked", pa.array(np.concatenate([*links, np.zeros(lone, bool)])))
    )


def split_regions(heavy, sets, level, percent, radius, scratch):
    """The Voronoi regions of heavy ones, and the links to their pivots."""
    draw = F.pmod(F.xxhash64("set_id", F.lit(level)), F.col("members"))
    drawn = heavy.filter(draw < PIVOTS)
    blocks = F.ceil(F.col("weight") / LEAF_WEIGHT).cast("int")
    side = heavy.withColumn("slice", F.pmod(F.xxhash64("set_id"), blocks).cast("int")).drop("delta", "weight", "members")
    members = side.join(sets.select("set_id", "shingles"), "set_id")
    pivots = drawn.withColumn("slice", F.explode(F.sequence(F.lit(0), blocks - 1))).select("region", "set_id", "n", "slice")
    # New names for the columns of this side, as both stem from the same tables.
    pivots = pivots.join(sets.select("set_id", "shingles"), "set_id").select(*[F.expr(c).alias(c) for c in ("region", "slice", "set_id", "n", "shingles")])
    fields = "region string, set_id long, n long, alone long, component long, delta double, pivot long, linked boolean"

    def run(x, y):
        # Without a pivot drawn, all members are far.
        columns = ["region", "set_id", "n", "alone", "component"]
        if x.num_rows and y.num_rows:
            return assign_regions(x, y, percent, radius)
        far = x.select(columns) if x.num_rows else pa.Table.from_pylist([], FAR_FIELDS)
        far = far.append_column("delta", pa.nulls(far.num_rows, pa.float64())).append_column("pivot", pa.nulls(far.num_rows, pa.int64()))
        return far.append_column("linked", pa.array([False] * far.num_rows, pa.bool_()))

    keys = ["region", "slice"]
    found = scratch.keep(members.groupBy(*keys).cogroup(pivots.groupBy(*keys)).applyInArrow(run, fields))
    links = found.filter("linked AND pivot <> set_id").select(F.col("pivot").alias("a"), F.col("set_id").alias("b"))
    before = heavy.groupBy("region").agg(F.count("*").alias("size"))
    after = found.groupBy("region").agg(F.count("*").alias("rows"))
    split = scratch.keep(before.join(after, "region").filter(F.col("rows") <= REPEATED * F.col("size")).select("region"))
    name = F.concat_ws("/", "region", F.coalesce(F.col("pivot").cast("string"), F.lit(f"far{level}")))
    parts = found.join(broadcast_up_to(split, BROADCAST_ROWS), "region", "left_semi").withColumn("region", name)
    whole = heavy.join(broadcast_up_to(split, BROADCAST_ROWS), "region", "left_anti")
    return parts.select(*MEMBERS).unionByName(whole.select(*MEMBERS)), links


def block_links(left, right, percent, radius):
    """Confirmed links between two blocks of a region's members: one for every pair of components."""
    own, other, count = codes_of(left, right)
    starts, begins = starts_of(right), starts_of(left)
    n, alone, component, ids = (right[c].to_numpy() for c in ("n", "alone", "component", "set_id"))
    place = right["delta"].to_numpy(zero_copy_only=False)
    mark, done, out = np.zeros(count, bool), set(), []
    rows = zip(*(left[c].to_pylist() for c in ("set_id", "component", "n", "alone", "delta")))
    for row, (key, label, size, extra, delta) in enumerate(rows):
        most = np.minimum(size - extra, n - alone)
        pairs = (component != label) & (100 * most >= percent * (n + size - most))
        if delta is not None:
            pairs &= ~(np.abs(place - delta) > radius + 1e-9)
        if not pairs.any():
            continue
        mine = own[begins[row] : begins[row] + size]
        mark[mine] = True
        shared = np.add.reduceat(mark[other], starts, dtype=np.int64)
        mark[mine] = False
        for hit in np.flatnonzero(pairs & (100 * shared >= percent * (n + size - shared))).tolist():
            pair = (min(label, int(component[hit])), max(label, int(component[hit])))
            if pair not in done:
                done.add(pair)
                out.append((key, int(ids[hit])))
    return out


def join_blocks(members, sets, percent, radius, scratch):
    """Step 6: links inside regions, each dealt in as many blocks as its weight asks for."""
    own = F.col("n") + MEMBER_WEIGHT
    parts = members.groupBy("region", "weight", "members", "component").agg(F.sum(own).alias("part"))
    largest = parts.groupBy("region", "weight", "members").agg(F.max_by("component", F.struct("part", "component")).alias("main"), F.max("part").alias("part"))
    blocks = lambda c: F.ceil(c / LEAF_WEIGHT).cast("int")
    largest = largest.withColumns({"wide": blocks(F.col("weight")), "high": blocks(F.col("weight") - F.col("part"))})
    largest = scratch.keep(largest.select("region", "main", "wide", "high", F.col("members").alias("size")).filter("high > 0"))
    dealt = attach(members.select(*MEMBERS), largest, ["region"], ["set_id"], "size").join(sets.select("set_id", "shingles"), "set_id")
    slot = lambda c: F.pmod(F.xxhash64("set_id"), F.col(c)).cast("int")
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    # New names for the columns of each side, as both stem from one table.
    columns = [F.expr(c).alias(c) for c in (*MEMBERS, "shingles")]
    left = dealt.filter("component <> main").select(*columns, slot("high").alias("i"), every("wide").alias("j"))
    right = dealt.select(*columns, every("high").alias("i"), slot("wide").alias("j"))
    fields = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(x, y):
        links = block_links(x, y, percent, radius) if x.num_rows and y.num_rows else []
        return pa.Table.from_pylist([{"a": a, "b": b} for a, b in links], fields)

    keys = ["region", "i", "j"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, "a long, b long").distinct()


def set_links(described, classes, docs, percent, size, scratch):
    """(a, b): links between classes that connect what any pair of sets within the threshold connects."""
    radius = 1 - percent / 100
    possible = scratch.keep(with_partners_possible(described, classes, percent, scratch).select("set_id", "set_low", "set_high", "row", F.col("n_shingles").alias("n")))
    wanted = broadcast_up_to(possible.select("row").distinct(), BROADCAST_ROWS)
    texts = docs.join(wanted, "row", "left_semi")
    sets = scratch.keep(sets_of(texts, size).join(possible, ["set_low", "set_high"]).select("set_id", "n", "shingles"))
    rare = scratch.keep(rare_shingles(sets, percent, scratch))
    members, links = first_regions(rare, sets, percent, scratch)
    level = 0
    while True:
        members = open_members(with_components(members, links, scratch), radius, scratch)
        light = members.filter(F.col("weight") <= LEAF_WEIGHT)
        heavy = members.filter(F.col("weight") > LEAF_WEIGHT)
        if level == LEVELS or heavy.isEmpty():
            return scratch.keep(links.unionByName(join_blocks(members, sets, percent, radius, scratch)))
        level += 1
        inner = scratch.keep(join_blocks(light, sets, percent, radius, scratch))
        members, more = split_regions(heavy, sets, level, percent, radius, scratch)
        links = scratch.keep(links.unionByName(inner).unionByName(more))


def jaccard_components(docs, percent=80, size=5, doc_id="doc_id", text="text"):
    """One row per row of `docs`: (doc_id, n_shingles, component_id).

    Words are ASCII-lowercased; a text of fewer than `size` words is one shingle, a text without
    words (or null) has none, is linked with nothing, and names itself. Documents link from a
    Jaccard similarity of `percent` / 100 on; `component_id` is the smallest id reachable. Rows
    that share an id are documents of their own (equal ones link like any equal texts). A
    null id is never a component's name: such a row gets the smallest id it reaches, or null.
    Other columns are ignored. An empty table gives no rows.
    """
    docs = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    # What finds a text again: its id, or a hash of it where that is null.
    docs = docs.withColumn("row", F.coalesce("doc_id", F.xxhash64("text")))
    scratch, keys = Scratch(), ["set_low", "set_high"]
    described = stored(describe(docs, size))
    classes = described.filter("set_low IS NOT NULL").groupBy(*keys, "n_shingles").agg(
        F.min("doc_id").alias("first_id"), F.min("row").alias("row"), F.count("*").alias("copies")
    )
    classes = scratch.keep(classes.withColumn("set_id", F.monotonically_increasing_id()))
    links = set_links(described, classes, docs, percent, size, scratch)
    found = connected_components(links, "a", "b").select(F.col("node").alias("set_id"), "component")
    named = classes.select("set_id", *keys, "first_id", "copies").join(found, "set_id", "left")
    named = scratch.keep(named.withColumn("component", F.coalesce("component", "set_id")))
    names = named.groupBy("component").agg(F.min("first_id").alias("name"), F.count("*").alias("n_classes"))
    names = scratch.keep(names.filter("n_classes > 1").withColumn("n", F.col("n_classes")))
    groups = attach(named, names, ["component"], ["set_id"]).filter("copies > 1 OR n_classes > 1")
    groups = stored(groups.select(*keys, F.col("copies").alias("n"), F.coalesce("name", "first_id").alias("name")))
    scratch.clear()
    joined = attach(described.select("doc_id", "n_shingles", *keys), groups, keys, ["doc_id"])
    return joined.select("doc_id", "n_shingles", F.coalesce("name", "doc_id").alias("component_id"))

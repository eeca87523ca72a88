"""Benchmark decontamination with a distributed positional inverted index.

1. `build_index` stores the postings of the training texts: (document, term, position) for
   every occurrence of a term of the benchmark, plus one end marker per document whose
   position is the number of words. Postings stay in the partition of their document, as
   segments; nothing is shuffled by term, so a frequent term is never one task.
2. `anchor_terms` takes, for every window of an item, its rarest terms by their counts in
   the index. A window with a term that never occurs can't match and is left out.
3. `phrase_candidates` reads the postings of those terms, subtracts the term's offset in the
   item, and intersects the lists: a (document, item, shift) where enough rare terms agree.
   Only the rarest terms of windows are expanded, never the lists of frequent words.
4. `verify_phrases` compares the words of candidate documents exactly, on whole texts.

`proximity_matches` uses the same index for items whose rarest terms stand close together;
the report counts them if asked for a span. All steps are built-in DataFrame functions. Tables
that grow with the benchmark (terms, anchors, items) are broadcast only after their rows
(`BROADCAST_ROWS`) and bytes have been counted; above that the joins shuffle.
"""

from pyspark.sql import Window, functions as F

from quarry.llm.common import ascii_lower, broadcast_up_to, stored

# Fixed value: a word of the contract is a maximal run without these ASCII characters.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 13
RAREST = 2
BROADCAST_ROWS = 1_000_000
END = ""  # no word is empty, so this term marks the end of a document


def words(text):
    """The words of a text column; null has none."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    low = F.when(ascii_only, F.lower(text)).otherwise(ascii_lower(text))
    return F.coalesce(F.regexp_extract_all(low, F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def prepare_items(benchmark, item_id="item_id", text="text"):
    """(item_key, item_id string, item_words) of items with a word; repeated items once. A null id is ''."""
    items = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item_id"), words(F.col(text)).alias("item_words"))
    items = items.filter(F.size("item_words") > 0).distinct()
    return items.select(F.xxhash64("item_id", "item_words").alias("item_key"), "item_id", "item_words")


def build_index(docs, items, doc_id="doc_id", text="text"):
    """Stored postings (doc_id, text_key, term, pos) of the items' terms, and the end markers."""
    terms = items.select(F.explode("item_words").alias("term")).distinct()
    end = docs.sparkSession.range(1).select(F.lit(END).alias("term"))
    tokens = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.xxhash64(text).alias("text_key"),
        F.posexplode(F.concat(words(F.col(text)), F.array(F.lit(END)))).alias("pos", "term"),
    )
    return stored(tokens.join(broadcast_up_to(terms.unionByName(end), BROADCAST_ROWS), "term"))


def term_counts(index):
    return index.filter(F.col("term") != END).groupBy("term").agg(F.count("*").alias("count"))


def item_terms(items):
    return items.select("item_key", F.size("item_words").alias("n"), F.posexplode("item_words").alias("offset", "term"))


def anchor_terms(items, counts, window=WINDOW, rarest=RAREST):
    """(term, item_key, offset, n, need): the rarest terms of every window that can match."""
    found = item_terms(items).join(counts, "term", "left").withColumn("count", F.coalesce("count", F.lit(0)))
    length = F.least(F.lit(window), F.col("n"))
    first = F.greatest(F.lit(0), F.col("offset") - length + 1)
    last = F.least(F.col("offset"), F.col("n") - length)
    members = found.withColumn("start", F.explode(F.sequence(first, last)))
    of_window = Window.partitionBy("item_key", "start")
    ranked = members.withColumns({
        "rank": F.row_number().over(of_window.orderBy("count", "offset")),
        "least": F.min("count").over(of_window),
    })
    chosen = ranked.filter((F.col("rank") <= rarest) & (F.col("least") > 0))
    need = F.least(F.lit(rarest), length).alias("need")
    return chosen.select("term", "item_key", "offset", "n", need).distinct()


def phrase_candidates(index, anchors):
    """(doc_id, text_key, item_key, shift, n) where at least `need` rare terms agree on the shift."""
    postings = index.join(broadcast_up_to(anchors, BROADCAST_ROWS), "term")
    shifted = postings.withColumn("shift", F.col("pos") - F.col("offset"))
    agreed = shifted.groupBy("doc_id", "text_key", "item_key", "shift", "n", "need").agg(F.collect_set("offset").alias("offsets"))
    return agreed.filter(F.size("offsets") >= F.col("need")).select("doc_id", "text_key", "item_key", "shift", "n")


def same_document(left, right):
    return left["doc_id"].eqNullSafe(right["doc_id"]) & (left["text_key"] == right["text_key"])


def verify_phrases(docs, items, candidates, window=WINDOW, doc_id="doc_id", text="text"):
    """(doc_id, text_key, item_id, hit_words) of items with an occurring window.

    `hit_words` are the positions of document words inside occurrences.
    """
    spots = candidates.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("item_key", "shift", "n")).alias("spots"))
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("text_key"), F.col(text).alias("text"))
    spots = broadcast_up_to(spots, BROADCAST_ROWS // 10)
    chosen = texts.join(spots, same_document(texts, spots)).select(texts["doc_id"], texts["text_key"], "text", "spots")
    cut = chosen.withColumn("w", words(F.col("text"))).select(
        "doc_id", "text_key",
        F.explode(F.transform("spots", lambda s: F.struct(
            s["item_key"].alias("item_key"), s["shift"].alias("shift"),
            F.slice("w", F.greatest(s["shift"], F.lit(0)) + 1, s["n"]).alias("part"),
        ))).alias("spot"),
    ).select("doc_id", "text_key", "spot.*")
    pairs = cut.join(broadcast_up_to(items, BROADCAST_ROWS // 10), "item_key")
    length = F.least(F.lit(window), F.size("item_words"))
    skipped = F.greatest(-F.col("shift"), F.lit(0))
    pairs = pairs.withColumns({
        "length": length, "begin": F.greatest("shift", F.lit(0)),
        "expected": F.slice("item_words", skipped + 1, F.greatest(F.size("item_words") - skipped, F.lit(0))),
    })
    last = F.least(F.size("part"), F.size("expected")) - F.col("length")
    starts = F.filter(
        F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
        lambda s: (s <= last) & (F.slice("part", s + 1, F.col("length")) == F.slice("expected", s + 1, F.col("length"))),
    )
    spread = F.flatten(F.transform("starts", lambda s: F.sequence(F.col("begin") + s, F.col("begin") + s + F.col("length") - 1)))
    matched = pairs.withColumn("starts", starts).filter(F.size("starts") > 0)
    return matched.select("doc_id", "text_key", "item_id", F.array_distinct(spread).alias("hit_words"))


def contamination_report(docs, benchmark, window=WINDOW, share=20, doc_id="doc_id", text="text", item_id="item_id", near_span=None):
    """One row per document: (doc_id, text_key, n_words, n_hit, n_items, items_sha256, contaminated).

    With `near_span` also n_near_items: how many items have their rarest terms within so many words.

    A document is contaminated if at least one word in `share` is hit. Null and wordless texts
    have no words and are clean; items without words match nothing; an empty benchmark leaves
    every document clean. Repeated rows each get their row. Rows with the same id but other
    texts are judged apart. Other columns are ignored.
    """
    items = stored(prepare_items(benchmark, item_id, text))
    index = build_index(docs, items, doc_id, text)
    counts = stored(term_counts(index))
    anchors = stored(anchor_terms(items, counts, window))
    candidates = stored(phrase_candidates(index, anchors))
    phrases = verify_phrases(docs, items, candidates, window, doc_id, text)
    hits = phrases.groupBy("doc_id", "text_key").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("hit_words")))).cast("bigint").alias("n_hit"),
        F.array_sort(F.collect_set("item_id")).alias("items"),
    )
    ends = index.filter(F.col("term") == END).select("doc_id", "text_key", F.col("pos").cast("bigint").alias("n_words"))
    joined = ends.join(hits, same_document(ends, hits), "left").select(
        ends["doc_id"], ends["text_key"], "n_words", F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )
    extra = []
    if near_span:
        near = stored(proximity_matches(index, items, counts, near_span).groupBy("doc_id", "text_key").agg(F.count_distinct("item_id").alias("n_near_items")))
        joined = joined.join(near, same_document(joined, near), "left").drop(near["doc_id"], near["text_key"])
        extra = [F.coalesce("n_near_items", F.lit(0).cast("bigint")).alias("n_near_items")]
    return joined.select(
        "doc_id", "text_key", "n_words", "n_hit", *extra, F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )


def remove_contaminated(docs, benchmark, window=WINDOW, share=20, doc_id="doc_id", text="text", item_id="item_id"):
    """The rows of `docs`, with their columns, that are not contaminated."""
    bad = contamination_report(docs, benchmark, window, share, doc_id, text, item_id).filter("contaminated")
    bad = bad.select("doc_id", "text_key").distinct()
    return docs.join(bad, docs[doc_id].eqNullSafe(bad["doc_id"]) & (F.xxhash64(docs[text]) == bad["text_key"]), "left_anti")


def proximity_matches(index, items, counts, span=20, terms=3):
    """(doc_id, text_key, item_id): the item's `terms` rarest distinct terms (all, if it has fewer)
    stand within `span` consecutive words of the document, in any order.

    Items with a term that never occurs are no match. Positions meet in blocks of twice the
    span, so a group holds at most 2 * span positions of the item's terms.
    """
    known = item_terms(items).select("item_key", "term").distinct().join(counts, "term", "left")
    rank = F.row_number().over(Window.partitionBy("item_key").orderBy(F.coalesce("count", F.lit(0)), "term"))
    rare = known.withColumn("rank", rank).filter(F.col("rank") <= terms)
    need = Window.partitionBy("item_key")
    rare = rare.withColumns({"need": F.count("*").over(need), "least": F.min(F.coalesce("count", F.lit(0))).over(need)})
    rare = rare.filter("least > 0").select("term", "item_key", "need")
    postings = index.join(broadcast_up_to(rare, BROADCAST_ROWS), "term")
    block = F.floor(F.col("pos") / span)
    in_blocks = postings.withColumn("block", F.explode(F.array(block, block - 1)))
    groups = in_blocks.groupBy("doc_id", "text_key", "item_key", "need", "block").agg(F.collect_set(F.struct("pos", "term")).alias("found"))
    near = lambda x: F.size(F.array_distinct(F.transform(
        F.filter("found", lambda y: (y["pos"] >= x["pos"]) & (y["pos"] < x["pos"] + span)), lambda y: y["term"]
    )))
    close = groups.filter(F.exists("found", lambda x: near(x) >= F.col("need")))
    return close.select("doc_id", "text_key", "item_key").distinct().join(items.select("item_key", "item_id"), "item_key").drop("item_key")

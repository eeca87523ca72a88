"""Golden values, invariants and brute-force comparisons on small fixtures."""

import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.functions import columns, text as modify
from quarry.operators import (
    blend, chat, components, custom, exact_dedup, extraction, filters, layout, minhash, packing, quality, records,
    retrieval, rollouts, sharding, spans, synthetic, tabular, tokens,
)
from quarry.plans.checkpoints import cut_lineage_and_shuffles
from quarry.plans.prefix import hash_rank, position, quantile_bucket, running_total
from quarry.plans.skew import join_groups
from quarry.sources import readers, writers
from quarry.sources import jsonl_zstd
from quarry.sources.tokenidx import index_bytes, parse_index


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


# --- plan helpers ------------------------------------------------------------


def test_join_groups_slices_hot_keys(spark):
    rows = [("hot", i) for i in range(300)] + [(f"k{i}", i) for i in range(100)] + [(None, i) for i in range(70)]
    members = frame(spark, rows, "k string, id long")
    groups = members.groupBy("k").agg(F.count("*").alias("n"), F.min("id").alias("low"))
    out = join_groups(members, groups, ["k"], ["id"], hot_rows=50)
    got = sorted((str(r.k), r.id, r.low, r.n) for r in out.collect())
    count, low = Counter(k for k, _ in rows), {}
    for k, i in rows:
        low[k] = min(i, low.get(k, i))
    assert got == sorted((str(k), i, low[k], count[k]) for k, i in rows)


def test_running_total_matches_plain_window(spark):
    rng = random.Random(1)
    rows = [("a" if rng.random() < 0.7 else None, i, rng.randrange(9)) for i in range(500)]
    rng.shuffle(rows)
    df = quantile_bucket(frame(spark, rows, "g string, id long, w long"), "id", buckets=7)
    got = {r.id: r.running for r in running_total(df, "w", ["id"], by=["g"]).collect()}
    sums, want = defaultdict(int), {}
    for g, i, w in sorted(rows, key=lambda r: r[1]):
        sums[g] += w
        want[i] = sums[g]
    assert got == want


def test_position_of_timestamps(spark):
    df = spark.range(50).select((F.lit(49) - F.col("id")).alias("id")).withColumn(
        "ts", F.timestamp_seconds(F.lit(1700000000) + F.col("id") * 60)
    )
    assert all(r.position == r.id for r in position(df, "ts", buckets=5).collect())


def test_hash_rank_is_a_permutation(spark):
    out = hash_rank(spark.range(200), "id", 3, digits=1).collect()
    assert sorted(r["rank"] for r in out) == list(range(1, 201))


# --- records and filters -----------------------------------------------------


def test_sft_drops_missing(spark):
    df = frame(spark, [("Hello", "Hi", "s"), ("x", None, "s")], "q string, a string, s string")
    assert [tuple(r) for r in records.sft(df, "q", "a", "s").collect()] == [("Hello", "Hi", "s")]


def test_require_keys_keeps_nulls(spark):
    df = frame(spark, [('{"a": null, "b": 1}',), ('{"b": 1}',)], "value string")
    assert records.require_keys(df, "value", "a").count() == 1


def test_rl_messages_empty_tools(spark):
    schema = "responses_create_params struct<input:array<struct<role:string,content:string>>,tools:array<struct<name:string>>>"
    rows = [(([("user", "Hi")], [("search",)]),), (([("user", "Hi")], []),), ((None, [("search",)]),)]
    out = records.rl_messages(frame(spark, rows, schema)).collect()
    assert [bool(r.tools) for r in out] == [True, False]


@pytest.mark.parametrize(
    "path,keep",
    [("train-00000.parquet", 1), ("data/train-0.parquet", 1), ("train/file.parquet", 1), ("train.jsonl", 1),
     ("data/train", 1), ("training-data.parquet", 0), ("retrain-00000.parquet", 0)],
)
def test_files_for_split(spark, path, keep):
    assert readers.files_for_split(frame(spark, [(path,)], "path string"), "train").count() == keep


def test_row_modulus_disjoint_and_complete(spark):
    parts = [{r.id for r in filters.row_modulus(spark.range(20), 4, k, "id").collect()} for k in range(4)]
    assert parts[0] == {0, 4, 8, 12, 16} and set().union(*parts) == set(range(20)) and sum(map(len, parts)) == 20


def test_used_in(spark):
    df = frame(spark, [("a", "x, sft"), ("b", "sft"), ("c", "sft2"), ("d", None)], "id string, used_in string")
    assert {r.id for r in filters.used_in(df, "used_in", "sft").collect()} == {"a", "b"}
    lists = frame(spark, [("a", ["sft"]), ("b", ["x"]), ("c", None)], "id string, used_in array<string>")
    assert {r.id for r in filters.used_in(lists, "used_in", "sft").collect()} == {"a"}


def test_text_modifiers(spark):
    df = frame(spark, [('say "hi" Paraphrased Text: "x y" ',)], "t string")
    row = df.select(modify.slice_after("t", "Paraphrased Text:").alias("s")).select("s", modify.unquote("s").alias("u")).first()
    assert (row.s, row.u) == ('"x y"', "x y")
    md = frame(spark, [("**b** *i* __u__ [l](http://x)",)], "t string").select(modify.remove_markdown("t")).first()[0]
    assert md == "b i u l"
    fixed = frame(spark, [("cafÃ©",), ("é\x00",), ("plain é",)], "t string").select(modify.fix_unicode("t").alias("t"))
    assert [r.t for r in fixed.collect()] == ["café", "é", "plain é"]


# --- deduplication -----------------------------------------------------------


def test_exact_dedup_is_idempotent(spark):
    df = frame(spark, [(i, f"t{i % 7}") for i in range(50)], "doc_id long, text string")
    once = exact_dedup.exact_dedup(df)
    assert {r.doc_id for r in once.collect()} == set(range(7))
    assert exact_dedup.exact_duplicates(once).count() == 0


def test_minhash_family_and_recall(spark):
    rng = random.Random(5)
    body = lambda: "".join(rng.choice("abcdefgh ") for _ in range(900))
    rows, pairs = [], []
    for i in range(15):
        text = body()
        rows += [(2 * i, text), (2 * i + 1, text[:450] + "#" + text[450:])]
        pairs.append((2 * i, 2 * i + 1))
    rows.append((99, "short"))
    found = {r.doc_id for r in minhash.fuzzy_duplicates(frame(spark, rows, "doc_id long, text string")).collect()}
    assert found == {b for _, b in pairs}


def test_lsh_edges_with_hot_bucket(spark):
    rows = [(i, [b"same", bytes([i % 256, i // 256])]) for i in range(400)]
    buckets = minhash.lsh_buckets(frame(spark, rows, "doc_id long, keys array<binary>"))
    plain, sliced = minhash.lsh_edges(buckets), minhash.lsh_edges(buckets, hot_rows=30)
    want = {(i, 0) for i in range(1, 400)}
    assert {tuple(r) for r in plain.collect()} == want == {tuple(r) for r in sliced.collect()}


def test_components_against_union_find(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)]
    edges += [(i, i + 1) for i in range(400, 440)] + [(500, i) for i in range(501, 560)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    want = {x: find(x) for e in edges if e[0] != e[1] for x in e}
    out = components.connected_components(frame(spark, edges, "src long, dst long"), hot_rows=20)
    assert {r.node: r.component for r in out.collect()} == want


@pytest.mark.parametrize("keep", ["first", "none"])
def test_repeated_spans_brute_force(spark, keep):
    rng = random.Random(3)
    shared = [rng.choice("abc") + str(rng.randrange(50)) for _ in range(9)]
    docs = {}
    for d in range(12):
        words = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(0, 30))]
        if d % 3 == 0:
            at = rng.randrange(len(words) + 1)
            words[at:at] = shared
        docs[d] = words
    k, seen, dead = 4, defaultdict(list), defaultdict(set)
    for d, w in docs.items():
        for i in range(len(w) - k + 1):
            seen[tuple(w[i : i + k])].append((d, i))
    for spots in seen.values():
        if len(spots) > 1:
            for d, i in sorted(spots)[1 if keep == "first" else 0 :]:
                dead[d].update(range(i, i + k))
    df = frame(spark, list(docs.items()), "doc_id long, tokens array<string>")
    got = defaultdict(set)
    for r in spans.repeated_spans(df, k, keep, hot_rows=2).collect():
        got[r.doc_id].update(range(r.start, r.end))
    assert got == {d: s for d, s in dead.items() if s}
    left = spans.remove_spans(df, spans.repeated_spans(df, k, keep))
    assert {r.doc_id: r.tokens for r in left.collect()} == {
        d: [t for i, t in enumerate(w) if i not in dead[d]] for d, w in docs.items()
    }


def test_normalize_spans_sequential(spark):
    """Against a step-by-step walk over documents and ranges."""
    rng = random.Random(8)
    sizes = [rng.randrange(10, 90) for _ in range(12)]
    starts = [sum(sizes[:i]) for i in range(len(sizes) + 1)]
    ranges, at = [], 0
    while at < starts[-1] - 5:
        at += rng.randrange(0, 25)
        end = at + rng.randrange(1, 60)
        ranges.append((at, min(end, starts[-1])))
        at = end
    ranges = [r for r in ranges if r[0] < r[1]]
    sep, unit, least, want = 4, 2, 6, []
    for i in range(len(sizes)):
        base = starts[i] + sep
        free = base
        for s, e in ranges:
            s, e = max(s, starts[i]), min(e, starts[i + 1])
            if s >= e:
                continue
            s = max(s, free)
            s = base + -(-(s - base) // unit) * unit
            e = base + (e - base) // unit * unit
            if e - s >= least:
                want.append((i, s, e))
                free = e
    docs = frame(spark, [(i, starts[i], starts[i + 1]) for i in range(len(sizes))], "doc_id long, doc_start long, doc_end long")
    out = spans.normalize_spans(frame(spark, ranges, "start long, end long"), docs, least, unit, sep, block=32)
    assert sorted(tuple(r) for r in out.collect()) == want


def test_substring_dedup_keeps_emptied_documents(spark):
    text = " ".join(f"w{i}" for i in range(60)) + "\n"
    out = spans.substring_dedup(frame(spark, [(1, text, "a"), (2, text, "b")], "doc_id long, text string, tag string"), k=50)
    assert {r.doc_id: (r.text, r.tag) for r in out.collect()} == {1: (text, "a"), 2: ("", "b")}


# --- extraction --------------------------------------------------------------


def test_extract_html(spark):
    stops = frame(spark, [("en", ["the", "of", "and", "a", "to", "in"])], "lang string, stop_words array<string>")
    good = "the cat of the house and the dog in a garden went to the river of the town and the boat " * 4
    page = (
        "<html lang='en'><head><title>T</title><style>p{}</style></head><body><nav><a href='/'>home of the site</a></nav>"
        f"<p>{good}</p><p>short one</p><p>{good}</p><script>var x='<p>';</script><p>Copyright 2020 {good}</p></body></html>"
    )
    df = frame(spark, [(1, page), (2, "<p>nothing</p>"), (3, None)], "page_id long, html string")
    out = {r.page_id: r.text for r in extraction.extract_html(df, stops).collect()}
    assert out == {1: f"{good.strip()}\nshort one\n{good.strip()}", 2: "", 3: ""}


def test_language_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = extraction.language_id(docs, extraction.trigram_profiles(docs))
    share = found.agg(F.avg((F.col("lang") == F.col("language")).cast("double"))).first()[0]
    assert share > 0.9


# --- quality -----------------------------------------------------------------


def test_thresholds_and_digitize(spark):
    rng = random.Random(4)
    rows = [(i, round(rng.random(), 2), rng.randrange(1, 50)) for i in range(300)]
    df = frame(spark, rows, "id long, s double, w long")
    table = quality.thresholds(df, ["s"], "w")
    total, cut = sum(r[2] for r in rows), {}
    for p in range(5, 100, 5):
        run = 0
        for _, s, w in sorted(rows, key=lambda r: r[1]):
            run += w
            if run / total >= p / 100:
                break
        cut[p] = s
    # Equal scores are one step of the running weight, so the score found is the same.
    assert {r.percentile: r.value for r in table.collect()} == cut
    bins = {r.id: r["s-int"] for r in quality.digitize(df, ["s"], table).collect()}
    assert bins == {i: sum(c <= s for c in cut.values()) for i, s, _ in rows}


# --- tokens, chat, packing ---------------------------------------------------


def test_truncation_loses_eos_unless_kept(spark):
    df = frame(spark, [(1, [5, 6, 7]), (2, []), (3, [8])], "id long, input_ids array<int>")
    with_eos = tokens.add_special(df, eos=2)
    out = {r.id: r.input_ids for r in tokens.truncate_tokens(with_eos, 3).collect()}
    assert out == {1: [5, 6, 7], 2: [2], 3: [8, 2]}
    kept = {r.id: r.input_ids for r in tokens.truncate_tokens(with_eos, 3, keep_eos=True).collect()}
    assert kept[1] == [5, 6, 2]


def test_index_bytes():
    import struct

    import numpy as np

    data = index_bytes([3, 1], "uint16")
    assert data[:9] == b"MMIDIDX\x00\x00" and struct.unpack("<QBQQ", data[9:34]) == (1, 8, 2, 3)
    assert np.frombuffer(data[34:42], np.int32).tolist() == [3, 1]
    assert np.frombuffer(data[42:58], np.int64).tolist() == [0, 6]
    assert np.frombuffer(data[58:], np.int64).tolist() == [0, 1, 2]


def test_token_index_sink(spark, tmp_path):
    import glob

    import numpy as np

    df = frame(spark, [([1, 2, 3],), ([],), ([7],)], "input_ids array<int>").coalesce(1)
    writers.write_token_index(df, str(tmp_path / "out"), "int32")
    (bin_file,) = glob.glob(str(tmp_path / "out" / "*.bin"))
    assert np.fromfile(bin_file, np.int32).tolist() == [1, 2, 3, 7]
    (idx_file,) = glob.glob(str(tmp_path / "out" / "*.idx"))
    assert open(idx_file, "rb").read() == index_bytes([3, 1], "int32")


def test_token_index_reader(spark, tmp_path):
    path = str(tmp_path / "out")
    for top in (300, 1000):
        # The second run overwrites the first.
        df = frame(spark, [([i, i + 1][: i % 3],) for i in range(top)], "input_ids array<int>").repartition(4)
        writers.write_token_index(df, path, "uint16")
    rows = writers.read_token_index(spark, path).collect()
    assert sorted(r.input_ids for r in rows) == sorted([i, i + 1][: i % 3] for i in range(1000) if i % 3)
    per_file = Counter(r.file for r in rows)
    assert Counter((r.file, r.document) for r in rows) == Counter((f, d) for f, n in per_file.items() for d in range(n))
    (tmp_path / "out" / "_SUCCESS").unlink()
    with pytest.raises(Exception, match="no finished token index"):
        writers.read_token_index(spark, path).collect()


@pytest.mark.parametrize(
    "change, message",
    [
        (lambda d: b"X" + d[1:], "known version"),
        (lambda d: d[:-8], "as long as"),
        (lambda d: d[:20], "shorter than its header"),
        (lambda d: d[:34] + (99).to_bytes(4, "little") + d[38:], "outside of the data"),
        (lambda d: d[:-8] + bytes(8), "borders"),
    ],
)
def test_broken_index(change, message):
    good = index_bytes([3, 1], "int32")
    assert parse_index(good, 16)[0] == "int32"
    with pytest.raises(ValueError, match=message):
        parse_index(change(good), 16)


def test_jsonl_zstd_frames(spark, tmp_path):
    """Lines of all lengths, separators inside of texts, small splits, and files of other tools."""
    import random

    import zstandard

    draw, path = random.Random(1), str(tmp_path / "out")
    text = lambda n: "".join(draw.choice("P*M\x18\x00ab\nü\r") for _ in range(n))
    rows = [(i, text(draw.choice([0, 5, 400, 3000]))) for i in range(400)] + [(400, "x" * 3_000_000), (401, None)]
    df = frame(spark, rows, "id long, t string").repartition(3)
    assert writers.write_jsonl(df, path, compression="zstd") == {"written": 402, "skipped": 0}
    plain = b"".join(
        zstandard.ZstdDecompressor().stream_reader(f.open("rb"), read_across_frames=True).read()
        for f in (tmp_path / "out").glob("part-*")
    )
    assert plain.count(b"\n") == 402
    (tmp_path / "out" / "other.jsonl.zst").write_bytes(zstandard.compress(b'{"id":-1,"t":"q"}\r\n\n{"id":-2}'))
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        back = {r.id: r.t for r in writers.read_jsonl_zstd(spark, path, df.schema).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert back == dict(rows) | {-1: "q", -2: None}
    writers.write_jsonl(df.filter("false"), path, compression="zstd")
    assert writers.read_jsonl_zstd(spark, path, df.schema).count() == 0


def test_frame_without_separator():
    """Random bytes are stored as they are; with the separator among them another level or an error is due."""
    import os

    data = os.urandom(5000) + jsonl_zstd.EMPTY_FRAME.encode() + os.urandom(5000)
    with pytest.raises(ValueError, match="separator"):
        jsonl_zstd.compressed(data)


CHAT = "messages array<struct<role:string,content:string,reasoning_content:string,tool_calls:array<struct<name:string,arguments:map<string,string>>>>>"


def conversation(*turns):
    return [tuple(t) + (None,) * (4 - len(t)) for t in turns]


def test_chat_golden_with_tools(spark):
    turns = conversation(
        ("system", "Be kind."), ("user", "Hi"), ("assistant", "Look", "think hard", [("find", {"q": "x"})]),
        ("tool", "r1"), ("tool", "r2"), ("assistant", "Done "), ("user", "More"), ("assistant", "ok", "r"),
    )
    out = chat.render_chat(frame(spark, [(turns,)], CHAT)).first().rendered
    s, e = "<|im_start|>", "<|im_end|>\n"
    assert out == (
        f"{s}system\nBe kind.{e}{s}user\nHi{e}"
        f"{s}assistant\n<think></think>Look\n<tool_call>\n<function=find>\n<parameter=q>\nx\n</parameter>\n</function>\n</tool_call>\n{e}"
        f"{s}user\n<tool_response>\nr1\n</tool_response>\n<tool_response>\nr2\n</tool_response>\n{e}"
        f"{s}assistant\n<think></think>Done{e}{s}user\nMore{e}{s}assistant\n<think>\nr\n</think>\nok{e}"
    )


def test_tools_block(spark):
    schema = CHAT + (
        ", tools array<struct<name:string,description:string,parameters_xml:string>>,"
        "props array<struct<name:string,type:string,description:string,enum:array<string>>>, req array<string>"
    )
    row = (conversation(("user", "Hi")), [("f", " does it ", None)], [("a", "string", "d", ["x", "y"])], ["a"])
    df = frame(spark, [row], schema)
    filled = df.withColumn(
        "tools",
        F.transform("tools", lambda t: F.struct(t["name"], t["description"], chat.tool_parameters("props", "req").alias("parameters_xml"))),
    )
    out = chat.render_chat(filled, tools="tools").first().rendered
    assert out.startswith(
        "<|im_start|>system\n# Tools\n\nYou have access to the following functions:\n\n<tools>\n<function>\n<name>f</name>"
        "\n<description>does it</description>\n<parameters>\n<parameter>\n<name>a</name>\n<type>string</type>\n<description>d</description>"
        '\n<enum>["x", "y"]</enum>\n</parameter>\n<required>["a"]</required>\n</parameters>\n</function>\n</tools>\n\nIf you choose'
    )


def test_chunks_join_to_rendered_and_masks(spark):
    rows = [
        (conversation(("user", "a"), ("assistant", "b"), ("user", "c"), ("assistant", "d", "why")),),
        (conversation(("user", "a"), ("assistant", "b", None, [("f", {})]), ("tool", "1"), ("tool", "2"), ("assistant", "e")),),
        (conversation(("user", "a"), ("assistant", "b"), ("user", "c")),),
        (conversation(("user", "a"), ("user", "b"), ("assistant", "c")),),
    ]
    df = chat.droppable(chat.expand_turns(frame(spark, rows, CHAT)))
    kept = df.filter("not droppable")
    assert df.count() == 5 and kept.count() == 3
    both = chat.role_chunks(chat.render_chat(kept))
    for r in both.collect():
        assert "".join(c.content for c in r.chunks) == r.rendered
        roles = [c.role for c in r.chunks]
        assert roles in (["system", "user", "assistant"], ["user", "assistant", "tool", "assistant"])
    coded = chat.loss_mask(chat.split_system_user(both)).collect()
    assert all(len(r.input_ids) == len(r.loss_mask) and 0 < sum(r.loss_mask) < len(r.loss_mask) for r in coded)


def plain_next_fit(lengths, capacity):
    bins, current, used = [], 0, 0
    for length in lengths:
        if used + length > capacity:
            current, used = current + 1, 0
        bins.append(current)
        used += length
    return bins


def expanded(plan):
    """{(length, rank): (bin, pos)} of a run-length plan."""
    out = {}
    for length, start, stop, first, each, pos in plan:
        for rank in range(start, stop):
            out[length, rank] = (first + (rank - start) // each, pos + (rank - start) % each)
    return out


@pytest.mark.parametrize("lengths,bins", [([], 0), ([50], 1), ([100], 1), ([40, 60], 1), ([60, 60], 2), ([80, 20, 70, 30], 2)])
def test_bin_counts(lengths, bins):
    order = sorted(lengths, reverse=True)
    assert len(set(packing.first_fit(order, 100))) == bins
    plan = packing.run_plan([x for x in dict.fromkeys(order)], [order.count(x) for x in dict.fromkeys(order)], 100)
    assert len({b for b, _ in expanded(plan).values()}) == bins
    assert len(set(plain_next_fit(lengths, 100))) == bins


@pytest.mark.parametrize("seed", range(12))
def test_run_plan_equals_first_fit(seed):
    rng = random.Random(seed)
    capacity = rng.choice((10, 37, 100))
    lengths = sorted((rng.randrange(0 if seed % 3 == 0 else 1, capacity + 1) for _ in range(rng.randrange(1, 900))), reverse=True)
    counts = Counter(lengths)
    plan = packing.run_plan(list(counts), list(counts.values()), capacity)
    seen, held, want = Counter(), Counter(), {}
    for length, number in zip(lengths, packing.first_fit(lengths, capacity)):
        want[length, seen[length]] = (number, held[number])
        seen[length] += 1
        held[number] += 1
    assert expanded(plan) == want


@pytest.mark.parametrize("seed", range(12))
def test_blocks_equal_next_fit(seed):
    rng = random.Random(seed)
    capacity = rng.choice((10, 37, 100))
    lengths = [rng.randrange(0, rng.choice((3, capacity + 1))) for _ in range(400)]
    cuts = sorted({0, 400, *(rng.randrange(400) for _ in range(rng.randrange(12)))})
    blocks = [np.array(lengths[a:b], dtype=np.int64) for a, b in zip(cuts, cuts[1:])]
    states = packing.chain_entries([(k, packing.block_exits(b, capacity)) for k, b in enumerate(blocks)])
    got = [pair for b, (_, *state) in zip(blocks, states) for pair in zip(*(x.tolist() for x in packing.fill_block(b, capacity, *state)))]
    want = plain_next_fit(lengths, capacity)
    held = Counter()
    for (number, pos), expect in zip(got, want):
        assert (number, pos) == (expect, held[expect])
        held[expect] += 1


def test_pack_across_blocks(spark, monkeypatch):
    """One part, many blocks, ids that are text, one length with most of the rows."""
    rng = random.Random(2)
    monkeypatch.setattr(packing, "BLOCK_ROWS", 40)
    rows = [(k % 2, f"s{k:04d}", rng.choice((50, 50, 50, 130, rng.randrange(1, 60)))) for k in range(900)]
    df = frame(spark, rows, "shard int, seq_id string, length int")
    for algorithm in ("concatenative", "first_fit_decreasing"):
        got = {r.seq_id: (r.bin_id, r.pos, r.length) for r in packing.pack(df, 100, algorithm).collect()}
        for shard in (0, 1):
            mine = [(s, min(n, 100)) for k, s, n in rows if k == shard]
            if algorithm == "first_fit_decreasing":
                mine.sort(key=lambda x: (-x[1], x[0]))
            lengths, held = [n for _, n in mine], Counter()
            bins = packing.first_fit(lengths, 100) if algorithm == "first_fit_decreasing" else plain_next_fit(lengths, 100)
            for (name, n), number in zip(mine, bins):
                assert got[name] == (number, held[number], n)
                held[number] += 1
        assert packing.pack(df.filter("false"), 100, algorithm).count() == 0
    with pytest.raises(ValueError):
        packing.pack(df, 0)


def test_first_fit_equals_linear_scan():
    rng = random.Random(6)
    lengths = [rng.randrange(1, 60) for _ in range(500)]
    room, want = [], []
    for length in lengths:
        b = next((i for i, r in enumerate(room) if r >= length), len(room))
        if b == len(room):
            room.append(100)
        room[b] -= length
        want.append(b)
    assert packing.first_fit(lengths, 100) == want


def test_pack_every_sequence_once(spark):
    rows = [(i % 2, i, 1 + i * 7 % 90) for i in range(200)]
    df = frame(spark, rows, "shard int, seq_id long, length int")
    for algorithm in ("concatenative", "first_fit_decreasing", "first_fit_shuffle"):
        out = packing.pack(df, 100, algorithm, parts=3).collect()
        assert sorted(r.seq_id for r in out) == list(range(200))
        fill = Counter()
        for r in out:
            fill[r.shard, r.part, r.bin_id] += r.length
        assert max(fill.values()) <= 100 and len({r.part for r in out}) > 1


def test_materialize_golden(spark):
    seqs = frame(spark, [(0, 0, [1, 2, 3], [1, 1, 1]), (0, 1, [4, 5], [0, 1])], "shard int, seq_id long, input_ids array<int>, loss_mask array<int>")
    plan = frame(spark, [(0, 0, 0, 0, 0), (0, 0, 0, 1, 1)], "shard int, part int, bin_id long, pos long, seq_id long")
    row = packing.materialize_bins(seqs, plan, 10).first()
    assert (row.input_ids, row.loss_mask, row.seq_start_id) == ([1, 2, 3, 4, 5], [1, 1, 0, 1, 0], [0, 3])
    short = packing.materialize_bins(seqs, plan, 4).first()
    assert (short.input_ids, short.loss_mask, short.seq_start_id) == ([1, 2, 3, 4], [1, 1, 0, 0], [0, 3])
    mask = frame(spark, [([1, 0, 1, 1],), ([1],)], "m array<int>").select(packing.align_mask("m").alias("m"))
    assert [r.m for r in mask.collect()] == [[0, 1, 1, 0], [0]]


# --- shards, blends, rollouts ------------------------------------------------


def test_balanced_shards(spark):
    df = frame(spark, [("d", "a", 7), ("d", "b", 3), ("d", "c", 3), ("d", "e", 2), ("z", "x", 0), ("z", "y", 0), ("z", "w", 0)], "dataset string, path string, size long")
    out = {(r.dataset, r.path): r.shard for r in sharding.balanced_shards(df, 2).collect()}
    assert out == {("d", "a"): 0, ("d", "b"): 1, ("d", "c"): 1, ("d", "e"): 1, ("z", "w"): 0, ("z", "x"): 1, ("z", "y"): 0}


def test_user_aggregate(spark, monkeypatch):
    """Null keys, null values, groups without any, many keys in one task, and a hot key."""
    monkeypatch.setattr(custom, "HELD_KEYS", 3)
    rows = [("hot", i % 5, float(i % 17), 1.0 + i % 3) for i in range(3000)] + [(f"k{i}", 1, float(i), 2.0) for i in range(40)]
    rows += [(None, None, 4.0, 1.0), (None, None, 6.0, 1.0), ("none", 2**60 + 1, None, 1.0), ("none", 2**60 + 1, 3.0, 0.0)]
    df = frame(spark, rows, "k string, j long, x double, w double").repartition(6)
    out = custom.aggregate(df, custom.weighted_moments("x", "w"), ["k", "j"], slices=2).collect()
    got = {(r.k, r.j): (r.n, round(r.weight, 6), round(r.mean, 6), round(r.squares, 4)) for r in out}
    want = {}
    for key in {(k, j) for k, j, _, _ in rows}:
        mine = [(x, w) for k, j, x, w in rows if (k, j) == key and x is not None and w > 0]
        total = sum(w for _, w in mine)
        mean = sum(x * w for x, w in mine) / total if mine else 0.0
        want[key] = (len(mine), round(total, 6), round(mean, 6), round(sum(w * (x - mean) ** 2 for x, w in mine), 4))
    assert got == want and len(out) == len(want)
    assert custom.aggregate(df.filter("false"), custom.weighted_moments("x", "w"), ["k"]).count() == 0


def plain_lightest_shard(files, shards):
    """The rule in a loop: {(dataset, path): shard}."""
    out = {}
    for dataset in {d for d, _, _ in files}:
        mine = sorted((f for f in files if f[0] == dataset), key=lambda f: (-(f[2] or 0), f[2] is None, f[1]))
        loads = [0] * shards
        for i, (_, path, size) in enumerate(mine):
            best = loads.index(min(loads)) if mine[0][2] else i % shards
            loads[best] += size or 0
            out[dataset, path] = best
    return out


@pytest.mark.parametrize("shards", [1, 3, 7, 50])
def test_balanced_shards_in_classes(spark, shards):
    import random

    draw = random.Random(shards)
    files = [("few sizes", f"p{i:04d}", draw.choice([1, 2, 3, 1000])) for i in range(600)]
    files += [("one size", f"p{i:04d}", 5) for i in range(300)]
    files += [("all sizes", f"p{i:04d}", draw.randrange(10**12)) for i in range(200)]
    files += [("gaps", f"p{i:04d}", draw.choice([0, None, 9, 9 * 10**9])) for i in range(200)]
    files += [("without", f"p{i:04d}", draw.choice([0, None])) for i in range(100)]
    files += [(None, f"p{i:04d}", 4) for i in range(20)]
    df = frame(spark, files, "dataset string, path string, size long")
    out = {(r.dataset, r.path): r.shard for r in sharding.balanced_shards(df, shards).collect()}
    assert out == plain_lightest_shard(files, shards)
    assert sharding.balanced_shards(df.filter("false"), shards).count() == 0


def test_ranks_of_one_size():
    """One giant file and a million small ones: ranks far below the top load, without a loop over files."""
    import heapq

    import numpy as np

    loads, size, count = np.array([50_000, 3, 0, 7, 0]), 3, 40_000
    heap, want = [(int(x), i) for i, x in enumerate(loads)], []
    heapq.heapify(heap)
    for _ in range(count):
        load, i = heap[0]
        want.append(i)
        heapq.heapreplace(heap, (load + size, i))
    assert sharding.shards_of(loads, size, np.arange(count)).tolist() == want
    assert sharding.loads_after(loads, size, count).tolist() == [x for x, _ in sorted(heap, key=lambda h: h[1])]


def test_splits(spark):
    shards = lambda n: spark.range(n).withColumnRenamed("id", "path")
    count = lambda df: {r.split: r["count"] for r in df.groupBy("split").count().collect()}
    assert count(sharding.shard_splits(shards(10), 2, 3, 42)) == {"train": 5, "valid": 2, "test": 3}
    assert count(sharding.ratio_splits(shards(2), 0.5, 0.5, 42)) == {"train": 2}
    assert count(sharding.ratio_splits(shards(10), 0, 0.01, 42)) == {"train": 9, "test": 1}
    assert count(sharding.ratio_splits(shards(20), 0.1, 0.05, 42)) == {"train": 17, "valid": 2, "test": 1}
    assert count(sharding.ratio_splits(shards(3), 0.9, 0.9, 42)) == {"train": 1, "valid": 1, "test": 1}


def test_holdout_small_table_is_all_train(spark):
    out = sharding.holdout_split(spark.range(5), 5, "id")
    assert {r.split for r in out.collect()} == {"train"}


def test_fingerprint_is_a_function_of_the_data_set(spark):
    import hashlib

    row = lambda d, i: (d, f"p{i:02d}", i, "e")
    shape = "dataset string, path string, size long, etag string"
    small, large = [row("d", i) for i in range(3)], [row("z", i) for i in range(40)]
    print_of = lambda rows: {r.dataset: r.fingerprint for r in sharding.fingerprint(frame(spark, rows, shape)).collect()}
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    groups = {}
    for _, path, size, etag in small:
        groups.setdefault(hashlib.md5(path.encode()).hexdigest()[:3], []).append(f"{path}:{size}:{etag}")
    want = "sha256:" + sha("\n".join(sorted(f"{p}:" + sha("\n".join(sorted(lines))) for p, lines in groups.items())))
    assert print_of(small) == {"d": want} and print_of(small + large)["d"] == want
    both = print_of((small + large)[::-1])
    assert both == print_of(small + large)
    changed = [("z", "p07", 1, "e") if r[1] == "p07" else r for r in large]
    assert print_of(small + changed)["z"] != both["z"] and print_of(small + changed)["d"] == want
    dated = frame(spark, [(*r, "m1") for r in small], shape + ", mtime string")
    assert sharding.fingerprint(dated, parts=("size", "etag", "mtime")).first().fingerprint != want


def test_row_transform_keeps_null_integers(spark):
    df = frame(spark, [(1, None), (2, 5)], "id long, n int")
    out = records.apply_transform(df, lambda r: {"id": r["id"], "kind": type(r["n"]).__name__}, "id long, kind string")
    assert {r.id: r.kind for r in out.collect()} == {1: "NoneType", 2: "int"}


def test_blend_needs_one_kind():
    with pytest.raises(ValueError):
        blend.blend_sources({})
    with pytest.raises(ValueError):
        blend.blend_sources({"datasets": [{"name": "a"}], "train": [{"name": "b"}]})
    assert [s["blend_split"] for s in blend.blend_sources({"train": [{"name": "a"}], "test": [{"name": "b"}]})] == ["train", "test"]


def test_question_templates(spark):
    df = frame(spark, [("Solve.\n\nWhat?\n\nMore\n\nEnd",), ("plain",)], "q string")
    out = df.select(rollouts.restore_wrapped("q", F.lit("<"), F.lit(">\n\n")).alias("r")).collect()
    assert [r.r for r in out] == ["<What?\n\nMore>", "<plain>"]
    path = frame(spark, [([("2+2",)],)], "prompt array<struct<content:string>>")
    row = path.select(rollouts.get_path(F.struct("prompt"), ["prompt", 0, "content"]).alias("a"), rollouts.get_path(F.struct("prompt"), ["prompt", 3, "content"]).alias("b")).first()
    assert (row.a, row.b) == ("2+2", None)


@pytest.mark.parametrize("raw,want", [('["42", 1]', "42"), ('{"z": "v", "a": "w"}', "v"), ("7", "7"), ('"s"', "s"), ("x = 1", "x = 1"), ("[]", "[]"), (None, None)])
def test_parse_answer(spark, raw, want):
    assert frame(spark, [(raw,)], "a string").select(rollouts.parse_answer("a")).first()[0] == want


def test_circular_pairs(spark):
    df = frame(spark, [("p", i, f"r{i}") for i in range(3)] + [("q", 0, "s")], "prompt string, i long, rollout string")
    out = {(r.rollout, r.next_rollout) for r in rollouts.circular_pairs(df).collect()}
    assert out == {("r0", "r1"), ("r1", "r2"), ("r2", "r0"), ("s", "s")}


# --- retrieval, layout, tabular ----------------------------------------------


@pytest.mark.parametrize("cosine", [True, False])
def test_knn_in_tiles(spark, cosine):
    """Many blocks on both sides, norms of very different size, ties, null vectors."""
    rng = np.random.default_rng(0)
    vectors = (rng.normal(size=(300, 8)) * rng.choice([0.01, 1, 20], (300, 1))).astype("float32")
    vectors[100:110] = vectors[7]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)] + [(900, None)]
    q, i = frame(spark, rows, "query_id long, vector array<float>"), frame(spark, rows, "item_id long, vector array<float>")
    out = retrieval.knn(q, i, 4, cosine=cosine, query_bytes=600, item_bytes=1500)
    exact = vectors.astype("float64")
    if cosine:
        exact = exact / np.linalg.norm(exact, axis=1, keepdims=True)
    scores = np.round(exact @ exact.T, 9)
    best = np.array([np.lexsort((np.arange(300), -row))[:4] for row in scores])
    got = {(r.query_id, r["rank"]): r.item_id for r in out.collect()}
    assert got == {(a, k + 1): best[a, k] for a in range(300) for k in range(4)}
    assert retrieval.knn(q, i.filter("false"), 4, cosine=cosine).count() == 0
    assert retrieval.knn(q.filter("false"), i, 4, cosine=cosine).count() == 0


@pytest.mark.parametrize("cosine", [True, False])
def test_tiles_are_bounded_by_rows(spark, cosine, monkeypatch):
    """Narrow vectors: blocks of bytes alone would meet in one task."""
    monkeypatch.setattr(retrieval, "TILE_QUERIES", 50)
    monkeypatch.setattr(retrieval, "TILE_ITEMS", 100)
    met, plain = [], retrieval.tiles
    monkeypatch.setattr(retrieval, "tiles", lambda x, y, *rest: (met.append(rest[-1]), plain(x, y, *rest))[1])
    rows = [(i, [float(i % 17), float(i % 5)]) for i in range(300)]
    q, i = frame(spark, rows, "query_id long, vector array<float>"), frame(spark, rows, "item_id long, vector array<float>")
    assert retrieval.knn(q, i, 2, cosine=cosine).count() == 600 and met == [18]


@pytest.mark.parametrize("cosine", [True, False])
def test_rows_are_shuffled_to_one_block(spark, cosine, monkeypatch):
    """More blocks on one side don't mean more rows to write for the other, and few rows leave a task."""
    monkeypatch.setattr(retrieval, "TILE_QUERIES", 50)
    monkeypatch.setattr(retrieval, "TILE_ITEMS", 20)
    monkeypatch.setattr(retrieval, "LEAST_TASKS", 1)
    met, plain = [], retrieval.tiles
    monkeypatch.setattr(retrieval, "tiles", lambda x, y, *rest: met.append((x.count(), y.count(), plain(x, y, *rest))) or met[-1][2])
    rng = np.random.default_rng(4)
    vectors = rng.integers(0, 4, (200, 3)).astype("float32")
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    q, i = frame(spark, rows, "query_id long, vector array<float>"), frame(spark, rows, "item_id long, vector array<float>")
    got = {(r.query_id, r["rank"]): r.item_id for r in retrieval.knn(q, i, 3, cosine=cosine).collect()}
    exact = vectors.astype("float64")
    if cosine:
        exact = exact / np.maximum(np.linalg.norm(exact, axis=1, keepdims=True), 1e-12)
    best = [np.lexsort((np.arange(200), -row))[:3] for row in np.round(exact @ exact.T, 9)]
    assert got == {(a, k + 1): best[a][k] for a in range(200) for k in range(3)}
    assert [m[:2] for m in met] == [(200, 200)] and met[0][2].count() == 600


def test_least_scores_leave_out_lower_items_only():
    rng = np.random.default_rng(5)
    ids, vectors = rng.permutation(6000), rng.integers(0, 3, (6000, 4)).astype(float)
    queries = vectors[:700]
    whole = retrieval._scan_all(ids, vectors, queries, 5)
    best = retrieval._scan(ids[:3000], vectors[:3000], queries, 5)
    best = [best[0], ids[best[1]], best[2]]
    found = retrieval._scan(ids[3000:], vectors[3000:], queries, 5, retrieval._least(best, 5, 700))
    both = retrieval._better(best, [found[0], ids[3000:][found[1]], found[2]], 5, 700)
    order = np.lexsort((both[1], -both[2], both[0]))
    assert (both[0][order] == whole[0]).all() and (both[1][order] == ids[whole[1]]).all() and np.allclose(both[2][order], whole[2], 0, 2e-9)


@pytest.mark.parametrize("hot", [1_000_000, 3])
def test_rerank_in_rounds(spark, hot, monkeypatch):
    """As in one go, with repeated texts, items near to many queries and a null text."""
    texts = [(i, f"a{i % 5} b{i % 7} c" if i else None, [1.0, float(i % 5), float(i % 7)]) for i in range(60)]
    q, i = (frame(spark, texts, f"{c} long, text string, vector array<float>") for c in ("query_id", "item_id"))
    kinds = frame(spark, [(n, [n, -n]) for n in range(50)], "item_id long, kinds array<long>")
    monkeypatch.setattr(retrieval, "HOT_ROWS", hot)
    rows = {}
    for pairs in (1000, 100):
        monkeypatch.setattr(retrieval, "RERANK_PAIRS", pairs)
        seen = []
        out = retrieval.retrieve_and_rerank(q, i, 2, about=kinds, each=lambda hits: seen.append(hits) or hits.drop("score"))
        rows[pairs] = sorted(map(repr, out.collect()))
        assert len(seen) == (1 if pairs == 1000 else 3)
    assert rows[1000] == rows[100] and len(rows[100]) == 120
    one = out.filter("query_id = 8").orderBy("rerank").collect()
    assert [(r.item_id, r.query, r.passage, r.rerank_score, r.kinds) for r in one] == [(8, "a3 b1 c", "a3 b1 c", 1.0, [8, -8]), (43, "a3 b1 c", "a3 b1 c", 1.0, [43, -43])]
    assert retrieval.retrieve_and_rerank(q.filter("false"), i, 2).count() == 0
    twice = retrieval.retrieve_and_rerank(q, i.unionByName(i), 10, fetch=4).filter("query_id = 8")
    assert sorted(r.item_id for r in twice.collect()) == [8] * 4 + [43] * 4


def test_shuffles_go_with_their_job(spark):
    def files():
        return {f.getName() for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(
            spark._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()) if f.getName().startswith("shuffle_")}

    before = files()
    kept = cut_lineage_and_shuffles(spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count())
    for _ in range(50):
        if not files() - before:
            break
        time.sleep(0.2)
    assert not files() - before and kept.count() == 10
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) is None


def test_two_passes_find_what_all_scores_find():
    """Copies, ties by rounding, tiny and zero vectors, scores that are nearly all alike."""
    rng = np.random.default_rng(2)
    cases = [rng.normal(size=(5000, 8)), rng.integers(0, 3, (5000, 4)).astype(float), rng.normal(size=(300, 4)) * 1e-6,
             np.ones((5000, 4)), np.zeros((50, 4)), 1 + rng.normal(size=(5000, 4)) * 1e-5, rng.normal(size=(3, 4))]
    for vectors in cases:
        ids, queries = rng.permutation(len(vectors)), vectors[:60]
        got = retrieval._scan(ids, vectors, queries, 5)
        want = retrieval._scan_all(ids, vectors, queries, 5)
        assert all((a == b).all() for a, b in zip((got[0], ids[got[1]]), (want[0], ids[want[1]]))) and np.allclose(got[2], want[2], 0, 2e-9)


def test_words_are_those_of_the_pattern():
    texts = ["".join(map(chr, range(0x300))), "na\u00efve\u2019s \u00d7\u00f7 a\u00a0b\x85c \x00d\x1fe ?f? \u4e2dg\U0001f600h \u0178i _1", "", "\u4e2d"]
    for text in texts:
        assert [w.decode("latin-1") for w in retrieval.words_of(text)] == re.findall(columns.WORD, text)


def test_lexical_score_of_missing_texts(spark):
    rows = [(None, "a b"), ("a", None), ("", None), ("", "a"), ("A b b", "a c")]
    pairs = frame(spark, rows, "q string, p string").coalesce(1)
    assert [r.s for r in pairs.select(retrieval.lexical_score(F.col("q"), F.col("p")).alias("s")).collect()] == [0.0, None, 0.0, 0.0, 0.5]


def test_norms_bound_the_bands(spark):
    """Queries that find k large items don't meet the small ones."""
    rows = [(i, [1000.0 if i < 40 else 0.001, float(i % 7)]) for i in range(400)]
    q, i = frame(spark, [(0, [1.0, 0.0])], "query_id long, vector array<float>"), frame(spark, rows, "item_id long, vector array<float>")
    met, plain = [], retrieval.tiles
    try:
        retrieval.tiles = lambda x, y, *rest: (met.append(x), plain(x, y, *rest))[1]
        assert [r.item_id for r in retrieval.knn(q, i, 3, cosine=False, item_bytes=200).orderBy("rank").collect()] == [0, 1, 2]
    finally:
        retrieval.tiles = plain
    assert met[0].count() > 0 and met[1].count() < 4


def test_chunks_cover_the_text(spark):
    rng = random.Random(1)
    text = "".join(rng.choice(["word ", "longerword ", "line\n", "para\n\n", "x" * 130 + " "]) for _ in range(400))
    parts = [r.chunk for r in retrieval.chunk(frame(spark, [(1, text)], "doc_id long, text string"), size=120, overlap=30).orderBy("chunk_id").collect()]
    assert max(map(len, parts)) <= 120
    at = 0
    for part in parts:
        begin = text.find(part, max(0, at - 30))
        assert 0 <= begin <= at
        at = begin + len(part)
    assert at == len(text)


def test_table_cells_escape():
    cells = layout.table_cells(r"\begin{tabular}{ll} a \& b & \textit{c} \\ \multirow{2}{*}{d} & e \\ f \end{tabular}")
    assert [(c["row"], c["col"], c["content"]) for c in cells] == [(0, 0, "a & b"), (0, 1, "<i>c</i>"), (1, 0, "d"), (1, 1, "e"), (2, 1, "f")]


def test_table_cells_nested_braces():
    cells = layout.table_cells(r"\begin{tabular}{|p{3cm}|l|} \hline \multicolumn{2}{c}{a {b} c} \\ x & {y & z} \\ \hline \end{tabular}")
    assert [(c["row"], c["col"], c["colspan"], c["content"]) for c in cells] == [(0, 0, 2, "a {b} c"), (1, 0, 1, "x"), (1, 1, 1, "{y & z}")]


def test_medians(spark):
    df = frame(spark, [(float(x), None if x == 3 else float(x * x)) for x in range(1, 7)], "a double, b double")
    assert {r.column: r.median for r in tabular.medians(df, ["a", "b"]).collect()} == {"a": 3.5, "b": 16.0}


def test_block_stage_may_drop(spark):
    out = custom.block_stage(spark.range(10, numPartitions=2), lambda b: None if b["id"].min() < 5 else b, "id long")
    assert {r.id for r in out.collect()} == set(range(5, 10))


def test_generation_retries(spark):
    def factory():
        calls = Counter()

        def client(prompt):
            calls[prompt] += 1
            if calls[prompt] < 3:
                raise RuntimeError("busy")
            return prompt[::-1]

        return client

    df = frame(spark, [("ab",), ("cd",)], "prompt string")
    out = synthetic.generate(df, factory, out="retry_test", delay=0.01)
    assert {r.retry_test for r in out.collect()} == {"ba", "dc"}


def test_shingle_digests(spark):
    import hashlib

    long = "".join(chr(97 + k * k % 23) for k in range(400))
    rows = [(1, long), (1, long[50:90]), (1, "short"), (2, "é" * 30), (3, ""), (4, None), (None, "x y" * 20), (None, long)]
    df = frame(spark, rows, "doc_id long, text string")
    sets = [(k, {t[i : i + 24] for i in range(max(len(t) - 23, 1))}) for k, t in rows if t]
    want = {k: (sum(len(s) for j, s in sets if j == k), min(hashlib.md5(g.encode()).hexdigest() for j, s in sets if j == k for g in s)) for k, _ in sets}
    out = minhash.shingle_digests(df)
    assert {r.doc_id: (r.n, r.lowest) for r in out.collect()} == want
    assert Counter((r.doc_id, r.shingle) for r in minhash.shingles(df).collect()) == Counter((k, g) for k, s in sets for g in s)
    # No sort below the aggregation meets one row per shingle.
    assert "Generate" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_generation_asks_once_per_prompt(spark, tmp_path):
    def factory():
        def client(prompt):
            with open(tmp_path / "calls", "a") as calls:
                calls.write("x\n")
            return "Paraphrased Text: " + "word " * 80

        return client

    df = frame(spark, [(i, f"text {i} " * 60) for i in range(9)] + [(9, None), (9, "short")], "doc_id long, text string")
    done = synthetic.run_tasks(df, factory, tasks=("distill",))["distill"]
    rows = done.collect()
    assert {(r.doc_id, r.segment_id, r.segment_token_count, r.rephrased_document_token_count) for r in rows} == {(i, 0, 120, 80) for i in range(9)}
    assert len((tmp_path / "calls").read_text().split()) == 9


def test_token_counts_agree(spark):
    import re

    texts = ["", "a", " a b\t", "é×ÿÀ-ß", "ªºµ a\u00a0b", "日本 語x😀é", "a\x0b\x1c\x1f\x7fb_9", "“q” … x", "ÿ", "Āaé", None]
    texts += ["".join(chr(c) + "a" * (c % 3) for c in range(1, 0x250, step)) for step in (1, 2, 3)]
    plan = filters.token_count_filter(frame(spark, [(t,) for t in texts], "t string"), "t", min=0)
    got = {r.t: r.token_count for r in plan.collect()}
    want = {t: len(re.findall(columns.TOKEN, t, re.ASCII)) for t in texts if t is not None}
    assert got == want == {t: synthetic.count_tokens(t) for t in texts if t is not None}
    cut = frame(spark, [(t,) for t in texts], "t string").select("t", columns.token_strings("t").alias("tokens"), spans.pieces("t").alias("pieces"))
    for r in cut.filter("t is not null").collect():
        assert r.tokens == re.findall(columns.TOKEN, r.t, re.ASCII) and r.pieces == re.findall(spans.PIECE, r.t, re.ASCII)


def test_markdown_by_marks(spark):
    texts = ["*a* _b_", "**a*b**", "__a__ *c", "[x](y) [z] (q)", "*[a_b](c_d)*", "_*x*_", "]( [", "", None]

    def plain(t):
        import re

        for p in (r"\*\*([^*]*)\*\*", r"\*([^*]*)\*", r"__([^_]*)__", r"_([^_]*)_", r"\[([^\]]*)\]\([^)]*\)"):
            t = re.sub(p, r"\1", t)
        return t

    out = frame(spark, [(t,) for t in texts], "t string").select("t", modify.remove_markdown("t").alias("out")).collect()
    assert {r.t: r.out for r in out} == {t: None if t is None else plain(t) for t in texts}


def test_read_jsonl_fails_on_bad_line(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"a": 1}\nnot json\n')
    with pytest.raises(Exception):
        readers.read_jsonl(spark, str(tmp_path / "x.jsonl"), "a int").collect()


def plain_windows(texts, k):
    """(id, pos) of all windows of k tokens but the first of each text."""
    import re

    seen, out = set(), set()
    for key in sorted(texts):
        tokens = re.findall(spans.PIECE, texts[key] or "")
        for pos in range(len(tokens) - k + 1):
            window = tuple(tokens[pos : pos + k])
            if window in seen:
                out.add((key, pos))
            seen.add(window)
    return out


def test_rolling_hashes_are_polynomials():
    values = np.random.default_rng(3).integers(-(1 << 63), 1 << 63, 40, dtype=np.int64)
    for width in (1, 2, 7, 40, 41):
        got = spans.rolling(values, width, spans.BASES[0])
        want = [sum(int(v) * spans.BASES[0] ** (width - 1 - j) for j, v in enumerate(values[i : i + width])) % (1 << 64) for i in range(40 - width + 1)]
        assert got.tolist() == want
    assert len(spans.rolling([], 3, spans.BASES[1])) == 0


@pytest.mark.parametrize("ids", [(5, 6, 7), (-(1 << 62), 0, 1 << 62), (-(1 << 63), 6, (1 << 63) - 1), (-9, -8, (1 << 32) - 10), (-9, -8, (1 << 32) - 9)])
def test_spans_with_ids_far_apart(spark, ids):
    text = " ".join(f"w{i}" for i in range(30))
    df = frame(spark, [(ids[2], text), (ids[0], "x y " + text), (ids[1], "z " + text), (None, text)], "doc_id long, text string")
    found = spans.repeated_spans(df, 10, column="text")
    # The first token of the last text has no space before it, so its first window differs.
    assert {tuple(r) for r in found.collect()} == {(ids[2], 1, 30), (ids[1], 1, 31)}
    left = spans.remove_spans(df, found, column="text")
    assert Counter((r.doc_id, len(r.text)) for r in left.collect())[(ids[0], 32)] == 1
    near = 1 << 32 > ids[2] - ids[0]
    assert ("decimal" in spans.places(df.filter("doc_id is not null"), "doc_id")._jc.toString().lower()) != near


@pytest.mark.parametrize("k", [1, 2, 7, 20])
def test_windows_against_plain_python(spark, k):
    rng = random.Random(k)
    base = " ".join(f"w{rng.randrange(60)}" for _ in range(300))
    words = base.split()
    texts = {0: base, 1: base, 2: None, 3: "", 4: "a " * 90, 5: "one"}
    for key in range(6, 60):
        at = rng.randrange(250)
        texts[key] = " ".join([f"x{rng.randrange(99)}" for _ in range(rng.randrange(20))] + words[at : at + rng.randrange(60)] + [f"y{rng.randrange(99)}"] * rng.randrange(9))
    df = frame(spark, list(texts.items()), "doc_id long, text string").select("doc_id", spans.pieces().alias("tokens"))
    got = {(r.doc_id, r.pos) for r in spans.repeated_windows(df, k, hot_rows=50).collect()}
    assert got == plain_windows(texts, k)

"""Arrow functions hold few rows as Python objects at a time; tables of words have a bound in bytes."""

import pickle

import pyarrow as pa
from pyspark.sql import functions as F, types as T

from quarry.operators import bpe, tokens
from quarry.plans import slices
from quarry.plans.slices import SLICE, in_slices


class Letters(bpe.Tokenizer):
    def words(self, text):
        return text.split(" ")

    def pieces(self, word):
        return [ord(c) for c in word]


def test_functions_see_few_rows_at_a_time(spark):
    most = in_slices(lambda values: [len(values)] * len(values), T.IntegerType())
    seen = [r[0] for r in spark.range(1000).coalesce(1).select(most("id")).collect()]
    assert len(seen) == 1000 and max(seen) == SLICE


def test_results_leave_before_the_batch_ends(monkeypatch):
    monkeypatch.setattr(slices, "OUT_BYTES", 1000)
    double = in_slices(lambda values: [v and v * 2 for v in values], T.StringType())
    texts = pa.array(["aé", None, "", "x" * 300] * 200)
    parts = list(double.func(iter([texts, texts.slice(0, 0), texts.slice(1, 5)])))
    assert len(parts) > 20 and max(p.nbytes for p in parts) < 1000 + 40 * 600
    want = [t and t * 2 for t in texts.to_pylist()]
    assert [t for p in parts for t in p.to_pylist()] == want + want[1:6]


def test_texts_are_encoded_once_for_two_columns(spark):
    letters = Letters()
    ids = tokens.tokenize(spark.createDataFrame([("ab c",), (None,)], "text string"), tokenizer=letters)
    out = ids.select(F.size("input_ids").alias("n"), letters.ids_of(F.array_join(F.col("input_ids").cast("array<string>"), " ")).alias("more"))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("run(text#") == 1 and {(r.n, r.more and len(r.more)) for r in out.collect()} == {(3, 6), (None, None)}


def test_bytes_come_in_small_batches():
    texts = pa.array(["aé", None, "", "𝄞"] * 300)
    parts = list(tokens.byte_ids.func(iter([texts, texts.slice(1, 5), texts.slice(0, 0)])))
    assert max(len(p) for p in parts) <= tokens.BYTE_ROWS
    want = [None if t is None else list(t.encode()) for t in texts.to_pylist()]
    assert [ids for p in parts for ids in p.to_pylist()] == want + want[1:6]


def test_the_table_of_words_has_a_bound(monkeypatch):
    monkeypatch.setattr(bpe, "TABLE_BYTES", 5000)
    letters, most = Letters(), 0
    for k in range(500):
        assert letters.encode(f"{k} same") == [ord(c) for c in f"{k}same"]
        most = max(most, len(letters.known))
    assert 5 < most < 25


def test_a_worker_keeps_one_copy_of_a_tokenizer():
    letters = Letters()
    sent = pickle.dumps((letters, Letters()))
    (one, other), (again, _) = pickle.loads(sent), pickle.loads(sent)
    assert one is again and one is not other and one.encode("ab c") == [97, 98, 99]


def test_plugin_errors_stay_in_their_rows(spark):
    def factory():
        return lambda text: [1 // len(text)]

    df = spark.createDataFrame([(i, "" if i % 7 == 0 else "ab") for i in range(100)], "id long, text string").coalesce(1)
    run = tokens.plugin_tokenizer("lengths_of_test", factory)
    rows = tokens.tokenize(df, tokenizer=run, on_error="skip").collect()
    assert all((r.input_ids, r.error is None) == ((None, False) if r.id % 7 == 0 else ([0], True)) for r in rows)
    assert df.select(F.size(tokens.byte_ids("text")).alias("n")).agg(F.sum("n")).first()[0] == 170

"""Byte-pair tokenizers: ids equal to those of the public libraries, and the way back."""

import random

import pytest

from quarry.operators import bpe, tokens

FOLDER = "/opt/tokenizers"


def texts():
    rng = random.Random(8)
    letters = ["a", "b", "e", "th", "ing", " ", "  ", "\n", "\t", "'s", "'LL", "1", "23", "é", "Σ", "İ", "漢", "💾", "‍", "ﬁ", "é", ".", "!?", "\x00", "<s>"]
    drawn = ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(400)]
    return ["", " ", "  x", "a  b\n\nc  ", "x" * 5000, "ab" * 3000, "the quick brown fox, it's 2024.", *drawn]


@pytest.mark.parametrize("name", ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"])
def test_rank_file_equals_library(name):
    import tiktoken

    own = bpe.RankFile(f"{FOLDER}/{name}")
    library = tiktoken.Encoding("own", pat_str=bpe.RANK_PATTERN, mergeable_ranks=own.ranks, special_tokens={})
    for text in texts():
        ids = own.encode(text)
        assert ids == library.encode_ordinary(text) and own.decode(ids) == text


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_merge_list_equals_library(name):
    from tokenizers import Tokenizer

    own, library = bpe.MergeList(f"{FOLDER}/{name}"), Tokenizer.from_file(f"{FOLDER}/{name}")
    library.encode_special_tokens = True
    for text in texts():
        ids = own.encode(text)
        assert ids == library.encode(text, add_special_tokens=False).ids
        assert own.folds or own.decode(ids) == text


def test_piece_model_equals_library():
    import sentencepiece

    own = bpe.PieceModel(f"{FOLDER}/piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=f"{FOLDER}/piece_bpe_32k.model")
    for text in texts():
        text = text.replace("\x00", "")
        ids = own.encode(text)
        assert ids == library.encode(text) and own.decode(ids) == text


def test_merge_against_plain_scan():
    """The heap takes the same pairs as a scan over all neighbours after every merge."""
    rng = random.Random(3)
    ranks = {a + b: k for k, (a, b) in enumerate(rng.sample([(x, y) for x in "abcd" for y in "abcd"], 10))}
    for _ in range(60):
        three = rng.choice(list(ranks)) + rng.choice("abcd")
        ranks.setdefault(three, len(ranks))

    def plain(symbols):
        while True:
            known = [(ranks[a + b], k) for k, (a, b) in enumerate(zip(symbols, symbols[1:])) if a + b in ranks]
            if not known:
                return symbols
            k = min(known)[1]
            symbols = [*symbols[:k], symbols[k] + symbols[k + 1], *symbols[k + 2 :]]

    for _ in range(300):
        word = [rng.choice("abcd") for _ in range(rng.randrange(40))]
        assert bpe.merge(word, lambda a, b: ranks.get(a + b)) == plain(word)


def test_word_table_is_emptied(monkeypatch):
    monkeypatch.setattr(bpe, "WORDS", 5)
    own = bpe.RankFile(f"{FOLDER}/byte_bpe_50k.tiktoken")
    assert own.decode(own.encode("one two three four five six seven eight")) == "one two three four five six seven eight"
    assert len(own.known) <= 5


def test_limit_of_entries(monkeypatch):
    monkeypatch.setattr(bpe, "MOST_ENTRIES", 100)
    for kind, name in ((bpe.RankFile, "byte_bpe_50k.tiktoken"), (bpe.MergeList, "byte_bpe_50k.json"), (bpe.PieceModel, "piece_bpe_32k.model")):
        with pytest.raises(ValueError):
            kind(f"{FOLDER}/{name}")


def test_columns(spark):
    df = spark.createDataFrame([(1, "two words"), (2, ""), (3, None)], "id long, text string")
    own = bpe.RankFile(f"{FOLDER}/byte_bpe_50k.tiktoken")
    coded = tokens.tokenize(df, tokenizer=own)
    got = {r["id"]: (r["input_ids"], r["back"]) for r in coded.withColumn("back", own.texts_of(coded["input_ids"])).collect()}
    assert got == {1: (own.encode("two words"), "two words"), 2: ([], ""), 3: (None, None)}

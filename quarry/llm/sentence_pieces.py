"""Encoding and decoding with a piece vocabulary by shared-prefix Viterbi.

A text is cut into marked words: a space becomes the mark, one mark is put in front, and a
word is a run of marks with the characters up to the next mark. No piece of the vocabulary
has a mark behind another character, so the best path of a text is that of its words.

The distinct words of a batch are sorted. Sorted order is the depth-first order of their
trie, and the words between two branchings share a prefix: the walk keeps one stack of
forward scores, cuts it back to the common prefix of neighbouring words, and scores only the
characters behind it. A position's best score is the maximum over the pieces that end
there. A character that no piece spells is written as its bytes; so is a mark in the text
itself, which would otherwise be read back as a space. Decoding is exact for every text.

Encoding is row-local: no shuffle. A task turns parts of a batch of about `SLICE_BYTES` into
Python objects, one at a time.
"""

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from quarry.llm.pieces import MARK, VOCABULARY, vocabulary

SLICE_BYTES, SLICE_IDS = 2 << 20, 1 << 20
# Worse than any piece, so that bytes appear only where nothing spells a character.
BYTE_COST = -1e4
WORD = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
LITERAL_MARK = ""  # as a word: the mark as a character of the text


def cut_words(text):
    """The marked words of a text."""
    if not text:
        return []
    if MARK not in text:
        return WORD.findall(MARK + text.replace(" ", MARK))
    first, *others = text.split(MARK)
    words = WORD.findall(MARK + first.replace(" ", MARK))
    for part in others:
        words.append(LITERAL_MARK)
        words += WORD.findall(part.replace(" ", MARK))
    return words


def encode_words(words, vocab):
    """Piece ids of every word of a sorted list of distinct words: a depth-first walk of their trie."""
    scores, ids, endings, longest = vocab.scores, vocab.ids, vocab.endings, vocab.longest
    best, back = [0.0], [0]  # the stack: score of the best path to a position, and its last piece's start
    before, out = "", []
    for word in words:
        shared, most = 0, min(len(word), len(before))
        while shared < most and word[shared] == before[shared]:
            shared += 1
        del best[shared + 1 :], back[shared + 1 :]
        for end in range(shared + 1, len(word) + 1):
            top, start = best[end - 1] + BYTE_COST, end - 1
            for begin in range(end - 1, max(end - longest, 0) - 1, -1):
                part = word[begin:end]
                if part in scores:
                    score = best[begin] + scores[part]
                    if score > top:
                        top, start = score, begin
                if part not in endings:
                    break
            best.append(top)
            back.append(start)
        path, end = [], len(word)
        while end:
            start = back[end]
            piece = ids.get(word[start:end])
            if piece is not None:
                path.append(piece)
            else:
                path.extend(vocab.byte_ids[b] for b in reversed(word[start:end].encode("utf-8", "surrogatepass")))
            end = start
        path.reverse()
        out.append(path)
        before = word
    return out


def encode_texts(texts, vocab):
    """(ids of all texts one after the other, end of each text)."""
    lists = [cut_words(t) for t in texts]
    distinct = sorted({w for words in lists for w in words})
    paths = encode_words(distinct, vocab)
    if distinct and distinct[0] == LITERAL_MARK:
        paths[0] = [vocab.byte_ids[b] for b in MARK.encode()]
    place = {w: k for k, w in enumerate(distinct)}
    sizes = np.array([len(p) for p in paths], np.int64)
    starts = np.cumsum(sizes) - sizes
    flat = np.fromiter((i for p in paths for i in p), np.int32, int(sizes.sum()))
    counts = [len(words) for words in lists]
    used = np.fromiter((place[w] for words in lists for w in words), np.int64, sum(counts))
    lengths = sizes[used]
    before = np.cumsum(lengths) - lengths
    ids = flat[np.repeat(starts[used] - before, lengths) + np.arange(int(lengths.sum()))]
    ends = np.concatenate([[0], np.cumsum(lengths)])[np.cumsum(counts)] if counts else np.zeros(0, np.int64)
    return ids, ends


def decode_ids(ids, table):
    """The text of a list of piece ids; `table` holds the bytes of every piece."""
    return b"".join([table[i] for i in ids])[1:].decode("utf-8", "replace")


def piece_bytes(vocab):
    table = [p.replace(MARK, " ").encode() for p in vocab.pieces]
    for byte, number in vocab.byte_ids.items():
        table[number] = bytes([byte])
    table[vocab.unknown] = b"\xef\xbf\xbd"
    return table


def with_columns(docs, kinds, make):
    """`docs` with the columns `kinds` (name -> type) from an Arrow function over parts of batches."""
    docs = docs.drop(*kinds)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields]

    def run(batches):
        for batch in batches:
            for part in make.parts(batch):
                yield pa.RecordBatch.from_arrays([*part.columns, *make(part)], names=[*part.schema.names, *kinds])

    return docs.mapInArrow(run, ", ".join([*fields, *(f"`{name}` {kind}" for name, kind in kinds.items())]))


def parts_of(batch, sizes, limit):
    """Parts of a batch whose `sizes` add up to about `limit`: nothing larger becomes Python objects at once."""
    sizes, first = np.maximum(pc.fill_null(sizes, 0).to_numpy(zero_copy_only=False), 1), 0
    while first < len(sizes):
        count = max(1, int(np.searchsorted(np.cumsum(sizes[first:]), limit, side="right")))
        yield batch.slice(first, count)
        first += count


def list_values(column):
    """A numpy array, or None, per row of an Arrow list column."""
    flat, at = column.flatten().to_numpy(zero_copy_only=False), 0
    for size in pc.list_value_length(column).to_pylist():
        yield None if size is None else flat[at : at + size]
        at += size or 0


class Encoder:
    """Arrow columns of the piece ids of a text column; with `check` also whether decoding gives it back."""

    def __init__(self, text, path, check=False):
        self.text, self.path, self.check = text, path, check

    def parts(self, batch):
        return parts_of(batch, pc.binary_length(batch.column(self.text)), SLICE_BYTES)

    def __call__(self, part):
        vocab, texts = vocabulary(self.path), part.column(self.text).to_pylist()
        ids, ends = encode_texts(texts, vocab)
        starts = np.concatenate([[0], ends])
        offsets = pa.array(starts.astype(np.int32), mask=np.array([t is None for t in texts] + [False]))
        columns = [pa.ListArray.from_arrays(offsets, pa.array(ids))]
        if self.check:
            table = piece_bytes(vocab)
            back = (decode_ids(ids[a:b].tolist(), table) for a, b in zip(starts.tolist(), ends.tolist()))
            columns.append(pa.array([None if t is None else t == x for t, x in zip(texts, back)], pa.bool_()))
        return columns


class Decoder:
    """An Arrow column of the texts of a column of piece ids."""

    def __init__(self, ids, path):
        self.ids, self.path = ids, path

    def parts(self, batch):
        return parts_of(batch, pc.list_value_length(batch.column(self.ids)), SLICE_IDS)

    def __call__(self, part):
        table = piece_bytes(vocabulary(self.path))
        values = list_values(part.column(self.ids))
        return [pa.array([None if x is None else decode_ids(x.tolist(), table) for x in values], pa.string())]


def encode(docs, text="text", out="piece_ids", path=VOCABULARY):
    """`docs` with the piece ids of `text` (array<int>). Null stays null, an empty text has none.

    An input column named `out` is replaced.
    """
    return with_columns(docs, {out: "array<int>"}, Encoder(text, path))


def encode_checked(docs, text="text", out="piece_ids", exact="exact", path=VOCABULARY):
    """`encode`, and in `exact` whether decoding the ids gives the text back (null for null)."""
    return with_columns(docs, {out: "array<int>", exact: "boolean"}, Encoder(text, path, check=True))


def decode(docs, ids="piece_ids", out="decoded", path=VOCABULARY):
    """`docs` with the text of the piece ids. Null stays null; the unknown id gives U+FFFD.

    Bytes that are no UTF-8 together give U+FFFD. An input column named `out` is replaced.
    """
    return with_columns(docs, {out: "string"}, Decoder(ids, path))


def encoding_report(docs, doc_id="doc_id", text="text", path=VOCABULARY):
    """(doc_id, piece_ids, n_pieces, exact) of every row; all but doc_id are null for null texts."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return encode_checked(rows, path=path).select("doc_id", "piece_ids", F.size("piece_ids").cast("bigint").alias("n_pieces"), "exact")

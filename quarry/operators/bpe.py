"""Byte-pair tokenizers from public vocabulary files: rank files, merge lists and piece models.

A text is cut into words that no merge crosses, and a word's symbols are merged by rank: the
pair with the lowest rank (the leftmost of several) becomes one symbol until no pair of
neighbours can be merged. The symbols are linked, and their pairs wait in a heap, so a word of
n symbols takes O(n log n). Words repeat, so every worker keeps a table of the words it has
merged, which is emptied at WORDS entries or TABLE_BYTES.

Encoding is row-local (Arrow batches, no shuffle). The driver reads the vocabulary, checks its
size (MOST_ENTRIES) and sends it along with the tasks, so that executors need no file.
"""

import base64
import heapq
import json
import sys
import types
import unicodedata
import uuid
from functools import lru_cache

from pyspark.sql import types as T

from quarry.plans.slices import in_slices

WORDS, MOST_ENTRIES, LONG_WORD = 500_000, 1_000_000, 4_000
# Bytes of the table of merged words, and of an entry besides its word and ids.
TABLE_BYTES, ENTRY_BYTES = 32 << 20, 240

# The published patterns that split text before merging.
RANK_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
MARK = "▁"  # stands for a space in piece models


def merge(symbols, rank_of):
    """`symbols` after all merges; `rank_of(a, b)` is None where a pair can't be merged."""
    count = len(symbols)
    if count < 2:
        return symbols
    left, right = list(range(-1, count - 1)), [*range(1, count), -1]
    symbols = list(symbols)
    heap = []

    def offer(a):
        b = right[a]
        if b >= 0:
            rank = rank_of(symbols[a], symbols[b])
            if rank is not None:
                heapq.heappush(heap, (rank, a, symbols[a], symbols[b]))

    for a in range(count - 1):
        offer(a)
    while heap:
        _, a, x, y = heapq.heappop(heap)
        b = right[a]
        # An entry is stale once one of its two symbols was merged with another.
        if symbols[a] != x or b < 0 or symbols[b] != y or symbols[a] is None:
            continue
        symbols[a], symbols[b] = x + y, None
        right[a] = right[b]
        if right[b] >= 0:
            left[right[b]] = a
        offer(a)
        if left[a] >= 0:
            offer(left[a])
    return [s for s in symbols if s is not None]


@lru_cache(maxsize=8)
def compiled(pattern):
    import regex

    return regex.compile(pattern)


@lru_cache(maxsize=1)
def byte_letters():
    """The letter that stands for each byte in merge lists: printable Latin-1 for itself, the others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


def checked(entries, path):
    if len(entries) > MOST_ENTRIES:
        raise ValueError(f"{path} has {len(entries)} entries, more than {MOST_ENTRIES}")
    return entries


def restored(kind, key, state):
    """The worker's one copy of a tokenizer, which all functions of a task share; the last two stay."""
    # Not a global of this module, so that no function takes the copies along when it is sent.
    loaded = sys.modules.setdefault("_loaded_tokenizers", types.ModuleType("_loaded_tokenizers")).__dict__
    keys = [k for k in loaded if not k.startswith("__")]
    if key not in loaded:
        for old in keys[:-1]:
            del loaded[old]
        loaded[key] = kind.__new__(kind)
        loaded[key].__dict__.update(state)
    return loaded[key]


class Tokenizer:
    """Base of the three kinds: `words`, `pieces` and `text_of` differ."""

    def __reduce__(self):
        key = self.__dict__.setdefault("key", uuid.uuid4().hex)
        return restored, (type(self), key, {k: v for k, v in self.__dict__.items() if k not in ("known", "held")})

    def encode(self, text):
        """Token ids of a text; None for None."""
        if text is None:
            return None
        known = self.__dict__.setdefault("known", {})
        out = []
        for word in self.words(text):
            ids = known.get(word)
            if ids is None:
                ids = self.pieces(word)
                if len(word) <= LONG_WORD:
                    held = self.__dict__.get("held", 0)
                    if len(known) >= WORDS or held >= TABLE_BYTES:
                        known.clear()
                        held = 0
                    known[word] = ids
                    self.held = held + ENTRY_BYTES + 4 * len(word) + 8 * len(ids)
            out += ids
        return out

    def decode(self, ids):
        """The text of token ids; bytes that are no UTF-8 become U+FFFD."""
        return None if ids is None else self.text_of(ids)

    def ids_of(self, text):
        """Column of token ids for a column of texts."""
        return coder(self.encode, T.ArrayType(T.IntegerType()))(text)

    def texts_of(self, ids):
        """Column of texts for a column of token ids."""
        return coder(self.decode, T.StringType())(ids)


def coder(function, kind):
    return in_slices(lambda values: [function(value) for value in values], kind)


class RankFile(Tokenizer):
    """A file with a base64 token and its rank, which is its id, per line."""

    def __init__(self, path, pattern=RANK_PATTERN):
        with open(path, "rb") as file:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file if line.strip())}
        self.pattern, self.tokens = pattern, {rank: token for token, rank in checked(self.ranks, path).items()}
        self.singles = [bytes([b]) for b in range(256)]

    def words(self, text):
        return compiled(self.pattern).findall(text)

    def pieces(self, word):
        data = word.encode("utf-8", "surrogatepass")
        get = self.ranks.get
        whole = get(data)
        if whole is not None:
            return [whole]
        return [self.ranks[s] for s in merge([self.singles[b] for b in data], lambda a, b: get(a + b))]

    def text_of(self, ids):
        return b"".join(self.tokens[i] for i in ids).decode("utf-8", "replace")


class MergeList(Tokenizer):
    """A JSON file with `vocab` and `merges` over letters that stand for bytes.

    With `end_of_word_suffix` the last symbol of a word carries it, and texts are composed
    (NFC), lower-cased and lose their white space, so that decoding gives words and spaces.
    """

    def __init__(self, path, pattern=None):
        with open(path, encoding="utf-8") as file:
            found = json.load(file)
        model = found["model"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in checked(model["merges"], path)]
        self.ranks = {pair: k for k, pair in enumerate(pairs)}
        self.vocabulary, self.suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        self.tokens = {i: token for token, i in self.vocabulary.items()}
        self.folds = bool(self.suffix)
        self.pattern = pattern or (split_pattern(found["pre_tokenizer"]) if self.folds else RANK_PATTERN)

    def words(self, text):
        if self.folds:
            text = compiled(r"\s+").sub(" ", unicodedata.normalize("NFC", text))
            # Letter by letter: the form of a letter does not depend on its neighbours.
            text = "".join(c.lower() for c in text)
        return compiled(self.pattern).findall(text)

    def pieces(self, word):
        letters = byte_letters()
        symbols = [letters[b] for b in word.encode("utf-8", "surrogatepass")]
        symbols[-1] += self.suffix
        return [self.vocabulary[s] for s in merge(symbols, lambda a, b: self.ranks.get((a, b)))]

    def text_of(self, ids):
        bytes_of = {letter: b for b, letter in byte_letters().items()}
        text = "".join(self.tokens[i].replace(self.suffix, " ") if self.suffix else self.tokens[i] for i in ids)
        data = b"".join(bytes([bytes_of[c]]) if c in bytes_of else c.encode() for c in text)
        return data.decode("utf-8", "replace").rstrip(" ") if self.suffix else data.decode("utf-8", "replace")


def split_pattern(node):
    """The first splitting pattern of a file's pre-tokenizer."""
    for part in [node, *node.get("pretokenizers", [])]:
        if part.get("type") == "Split":
            return part["pattern"]["Regex"]
    return RANK_PATTERN


class PieceModel(Tokenizer):
    """A piece model: spaces are marks, a text gets one in front, bytes stand for what no piece spells."""

    def __init__(self, path):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [model.id_to_piece(i) for i in range(len(checked(range(model.get_piece_size()), path)))]
        special = lambda i: model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)
        self.ids = {p: i for i, p in enumerate(names) if not special(i)}
        self.ranks = {p: -model.get_score(i) for p, i in self.ids.items()}
        self.bytes = {int(p[3:5], 16): i for i, p in enumerate(names) if model.is_byte(i)}
        self.tokens = {i: p.replace(MARK, " ").encode() for p, i in self.ids.items()} | {i: bytes([b]) for b, i in self.bytes.items()}
        # Merges never go from another letter to a mark, so a word ends before a run of marks.
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError(f"{path} has pieces with a space inside")

    def words(self, text):
        return compiled(f"{MARK}*[^{MARK}]+|{MARK}+").findall(MARK + text.replace(" ", MARK)) if text else []

    def pieces(self, word):
        out = []
        for symbol in merge(list(word), lambda a, b: self.ranks.get(a + b)):
            number = self.ids.get(symbol)
            out += [number] if number is not None else [self.bytes[b] for b in symbol.encode("utf-8", "surrogatepass")]
        return out

    def text_of(self, ids):
        text = b"".join(self.tokens.get(i, b"") for i in ids).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text

"""Column helpers shared by the operators. All of them stay inside the JVM."""

from pyspark.sql import functions as F

# Token pattern, special ids and hash modulus of the built-in tokenizer.
WORD = r"[A-Za-z0-9_À-ÿ]+"
TOKEN = r"[A-Za-z0-9_À-ÿ]+|[^A-Za-z0-9_À-ÿ\s]"
LETTERS = "A-Za-z0-9_À-ÿ"
PRIME31 = 2147483647
VOCAB = 50000
PAD_ID, BOS_ID, EOS_ID, FIRST_ID = 0, 1, 2, 3


def col(c):
    return F.col(c) if isinstance(c, str) else c


def spelled(pattern):
    """The same pattern with every letter of LETTERS listed: Java looks single characters up in a
    bit set, but tests ranges one after another, which takes four times as long."""
    ranges = ("AZ", "az", "09", "__", "Àÿ")
    return pattern.replace(LETTERS, "".join(chr(c) for first, last in ranges for c in range(ord(first), ord(last) + 1)))


def base_hash(c):
    """31-bit hash: the first 8 hex digits of md5, modulo 2^31 - 1."""
    return F.conv(F.substring(F.md5(col(c)), 1, 8), 16, 10).cast("bigint") % PRIME31


def words(c):
    return F.regexp_extract_all(col(c), F.lit(spelled(WORD)), F.lit(0))


def token_strings(c):
    return F.regexp_extract_all(col(c), F.lit(spelled(TOKEN)), F.lit(0))


def token_count(c):
    """Number of regex tokens; counts without building the array."""
    return F.regexp_count(col(c), F.lit(spelled(TOKEN))).cast("bigint")


def token_ids(c):
    return F.transform(token_strings(c), lambda t: (base_hash(t) % VOCAB + FIRST_ID).cast("int"))


def strip(c):
    """Trim white space (space, tab, line breaks) on both sides."""
    return F.regexp_replace(col(c), r"^[ \t\n\r\f]+|[ \t\n\r\f]+$", "")


def let(value, body):
    """Bind `value` once for use inside lambdas.

    A lambda body that mentions an outer expression evaluates it again for every
    element; bound as a lambda variable it is evaluated once per row.
    """
    return F.get(F.transform(F.array(value), lambda x: body(x)), F.lit(0))


def windows(array, n, make):
    """`make(slice)` for every run of n consecutive entries; none if shorter."""

    def build(a):
        last = F.size(a) - F.lit(n - 1)
        starts = F.when(last >= 1, F.sequence(F.lit(1), F.greatest(last, F.lit(1)))).otherwise(
            F.array().cast("array<int>")
        )
        return F.transform(starts, lambda i: make(F.slice(a, i, n)))

    return let(array, build)


def ngrams(array, n):
    return windows(array, n, lambda run: run)


def char_ngrams(c, n):
    """Character n-grams of a text; a shorter text is its own single n-gram.

    The look-ahead captures n characters at every position in one pass.
    """
    c = col(c)
    grams = F.regexp_extract_all(c, F.lit(rf"(?s)(?=(.{{{n}}}))."), F.lit(1))
    return F.when(F.char_length(c) < n, F.array(c)).otherwise(grams)


def hash_fraction(key, seed):
    """Repeatable number in [0, 1) from a key, for seeded sampling."""
    text = F.md5(F.concat_ws(":", F.lit(str(seed)), col(key).cast("string")))
    return F.conv(F.substring(text, 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def nested(c, path):
    """Read a path of keys and list positions; anything missing gives null."""
    c = col(c)
    for step in path:
        c = F.get(c, F.lit(step)) if isinstance(step, int) else c[step]
    return c

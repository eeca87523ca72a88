"""Text modifiers on string columns."""

import unicodedata

from pyspark.sql import functions as F, types as T

from quarry.functions.columns import col, let, strip
from quarry.plans.slices import in_slices


def remove_markdown(c):
    """Bold, italics, underline and links to plain text; only texts with a mark meet its patterns."""

    def plain(c, mark, *patterns):
        out = c
        for pattern in patterns:
            out = F.regexp_replace(out, pattern, "$1")
        return F.when(F.contains(c, F.lit(mark)), out).otherwise(c)

    stars = let(col(c), lambda x: plain(x, "*", r"\*\*([^*]*)\*\*", r"\*([^*]*)\*"))
    lines = let(stars, lambda x: plain(x, "_", r"__([^_]*)__", r"_([^_]*)_"))
    return let(lines, lambda x: plain(x, "](", r"\[([^\]]*)\]\([^)]*\)"))


def remove_lines(c, patterns):
    """Drop the lines that equal one of the patterns."""
    lines = F.split(col(c), "\n")
    return F.array_join(F.filter(lines, lambda x: ~x.isin(*patterns)), "\n")


def slice_after(c, left):
    """Text behind the first `left` marker, trimmed; empty without a marker."""
    c = col(c)
    at = F.instr(c, left)
    rest = F.substring(c, at + F.lit(len(left)), F.char_length(c))
    return F.when(at > 0, strip(rest)).otherwise("")


def unquote(c):
    """Remove one pair of double quotes around the text."""
    return F.regexp_replace(col(c), r'^"([\s\S]*)"$', "$1")


def truncate_chars(c, n):
    return F.substring(col(c), 1, n)


def split_thinking(c):
    """Reasoning and final answer of a model reply, cut at the first `</think>`."""
    c = col(c)
    end = "</think>"
    has = F.contains(c, F.lit(end))
    head = F.substring_index(c, end, 1)
    tail = F.substring(c, F.instr(c, end) + F.lit(len(end)), F.char_length(c))
    reasoning = F.when(has, strip(F.replace(head, F.lit("<think>"), F.lit("")))).otherwise("")
    return F.struct(reasoning.alias("reasoning"), F.when(has, strip(tail)).otherwise(c).alias("answer"))


def fix_unicode(c):
    """Undo UTF-8 read as Latin-1, compose characters, drop control characters."""

    def repaired(text):
        if text is None:
            return None
        try:
            back = text.encode("latin-1").decode("utf-8")
        except UnicodeError:
            back = text
        text = back if len(back) < len(text) else text
        text = unicodedata.normalize("NFC", text)
        return "".join(ch for ch in text if ch in "\n\t\r" or unicodedata.category(ch) != "Cc")

    return in_slices(lambda texts: [repaired(text) for text in texts], T.StringType())(c)

"""Row filters. Each is a plain predicate, so Catalyst can combine and push it."""

from pyspark.sql import functions as F

from quarry.functions.columns import let, token_count, windows, words
from quarry.plans.once import compute_once
from quarry.plans.prefix import position

# Patterns for personal data, valid in both Java and RE2.
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
SSN = r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b"
PHONE = r"(\+[0-9]{1,3}[ .-])?\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}\b"
ROLES = ("system", "user", "assistant", "tool")


def min_chars(df, n, text="text"):
    return df.filter(F.col(text).isNotNull() & (F.char_length(text) >= n))


def keep_languages(df, languages, lang="lang"):
    return df.filter(F.upper(lang).isin(*[code.upper() for code in languages]))


def score_filter(df, score, min=None, max=None):
    keep = F.lit(True)
    if min is not None:
        keep = keep & (F.col(score) >= min)
    if max is not None:
        keep = keep & (F.col(score) <= max)
    return df.filter(keep)


def token_count_filter(df, text="text", min=None, max=None, out="token_count"):
    return score_filter(compute_once(df, **{out: token_count(text)}), out, min, max)


def substring_filter(df, column, text, position="any"):
    c = F.col(column)
    test = {"prefix": c.startswith, "suffix": c.endswith, "any": c.contains}[position]
    return df.filter(test(text))


def used_in(df, column, value):
    """Membership in a list column, or in a comma-separated string column."""
    if dict(df.dtypes)[column].startswith("array"):
        return df.filter(F.array_contains(column, value))
    parts = F.transform(F.split(column, ","), lambda x: F.trim(x))
    return df.filter((F.col(column) == value) | F.array_contains(parts, value))


def non_empty(df, column="messages"):
    return df.filter(F.col(column).isNotNull() & (F.size(column) > 0))


def valid_conversation(df, messages="messages"):
    """Drop conversations with `<tool_call>` text but no `# Tools` header anywhere."""

    def mentions(marker):
        def test(m):
            found = F.coalesce(m["content"].contains(marker), F.lit(False))
            if "reasoning_content" in fields:
                found = found | F.coalesce(m["reasoning_content"].contains(marker), F.lit(False))
            return found

        return F.exists(messages, test)

    fields = df.schema[messages].dataType.elementType.fieldNames()
    return df.filter(~mentions("<tool_call>") | mentions("# Tools"))


def max_length(df, n, length="length"):
    return df.filter(F.col(length) <= n)


def row_modulus(df, modulus, remainder, order, by=()):
    """Keep rows whose 0-based position (per source file) is congruent to `remainder`."""
    placed = position(df, order, by=by, out="_position")
    return placed.filter(F.col("_position") % modulus == remainder).drop("_position")


def repetition_share(text="text", n=4):
    """1 - distinct / all word n-grams; 0 for texts with fewer than n words."""
    return let(
        windows(words(text), n, lambda run: F.array_join(run, " ")),
        lambda g: F.when(F.size(g) > 0, 1 - F.size(F.array_distinct(g)) / F.size(g)).otherwise(0.0),
    )


def repetition_filter(df, n=4, max_share=0.3, text="text", out="repetition_share"):
    return compute_once(df, **{out: repetition_share(text, n)}).filter(F.col(out) <= max_share)


def structural_filter(df, messages="messages", roles=ROLES):
    """Keep conversations that are not empty, only use known roles, have an
    assistant turn and no blank turn."""
    m = F.col(messages)
    return df.filter(
        (F.size(m) > 0)
        & F.forall(m, lambda x: x["role"].isin(*roles))
        & F.exists(m, lambda x: x["role"] == "assistant")
        & F.forall(m, lambda x: F.char_length(F.trim(x["content"])) > 0)
    )


def pii_flags(df, text="text"):
    return df.withColumns(
        {
            "n_emails": F.regexp_count(text, F.lit(EMAIL)).cast("bigint"),
            "n_ssns": F.regexp_count(text, F.lit(SSN)).cast("bigint"),
            "n_phones": F.regexp_count(text, F.lit(PHONE)).cast("bigint"),
        }
    )


def pii_redact(df, text="text"):
    c = F.regexp_replace(text, EMAIL, "[EMAIL]")
    c = F.regexp_replace(c, SSN, "[SSN]")
    return df.withColumn(text, F.regexp_replace(c, PHONE, "[PHONE]"))


def filter_subtype(df, subtype, metadata="metadata"):
    """Extracted items by content type or, for structured items, by subtype."""
    kind = F.coalesce(
        F.col(f"{metadata}.content_metadata.subtype"), F.col(f"{metadata}.content_metadata.type")
    )
    return df.filter(kind == subtype)


def modality(df, metadata="metadata", text="text", out="modality"):
    """image_text when an item has both, else image or text."""
    image = F.length(F.coalesce(F.col(f"{metadata}.image_metadata.content"), F.lit(""))) > 0
    words_ = F.length(F.coalesce(F.col(text), F.lit(""))) > 0
    return df.withColumn(
        out,
        F.when(image & words_, "image_text").when(image, "image").when(words_, "text"),
    )

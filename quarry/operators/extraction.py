"""Main text of web pages and language identification."""

import re
from collections import Counter
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Window, functions as F

from quarry.functions.columns import char_ngrams, words

# Paragraph tags, skipped tags and the published length and density limits.
BLOCK_TAGS = "body blockquote caption center col colgroup dd div dl dt fieldset form legend optgroup option p pre table td textarea tfoot th thead tr ul li h1 h2 h3 h4 h5 h6 article section nav header footer aside main br title".split()
SKIP_TAGS = "script style noscript template head".split()
LENGTH_LOW, LENGTH_HIGH = 70, 200
STOPWORDS_LOW, STOPWORDS_HIGH = 0.30, 0.32
MAX_LINK_DENSITY = 0.2

OWNER_SIGN = re.compile("©|&copy|copyright", re.IGNORECASE)


class _Paragraphs(HTMLParser):
    """Collects (text, characters inside links) per block of a page."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.found, self.parts, self.linked = [], [], 0
        self.skip, self.links = 0, 0

    def flush(self):
        text = " ".join("".join(self.parts).split())
        if text:
            self.found.append({"text": text, "link_chars": self.linked})
        self.parts, self.linked = [], 0

    def handle_starttag(self, tag, attrs):
        if tag in SKIP_TAGS:
            self.skip += 1
        elif tag in BLOCK_TAGS:
            self.flush()
        elif tag == "a":
            self.links += 1

    def handle_endtag(self, tag):
        if tag in SKIP_TAGS:
            self.skip = max(self.skip - 1, 0)
        elif tag in BLOCK_TAGS:
            self.flush()
        elif tag == "a":
            self.links = max(self.links - 1, 0)

    def handle_data(self, data):
        if not self.skip:
            self.parts.append(data)
            if self.links:
                self.linked += len(" ".join(data.split()))


def page_paragraphs(page):
    parser = _Paragraphs()
    parser.feed(page or "")
    parser.close()
    parser.flush()
    return parser.found


def stop_words(df, text="text", lang="lang", top=100):
    """The `top` most frequent words per language, one row with an array each."""
    counted = (
        df.select(lang, F.explode(words(F.lower(text))).alias("word")).groupBy(lang, "word").count()
    )
    order = Window.partitionBy(lang).orderBy(F.desc("count"), "word")
    best = counted.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= top)
    return best.groupBy(lang).agg(F.collect_list("word").alias("stop_words"))


def own_kind(text, link_chars, stops):
    """Rating of one paragraph by its links, length and share of stop words."""
    n = len(text)
    if link_chars / n > MAX_LINK_DENSITY or OWNER_SIGN.search(text):
        return "bad"
    if n < LENGTH_LOW:
        return "bad" if link_chars else "short"
    tokens = text.lower().split(" ")
    density = sum(t in stops for t in tokens) / len(tokens)
    if density >= STOPWORDS_HIGH and n > LENGTH_HIGH:
        return "good"
    return "near-good" if density >= STOPWORDS_LOW else "bad"


def nearest(kinds, wanted):
    """For every position the nearest earlier kind of `wanted`; 'bad' before the first."""
    out, last = [], "bad"
    for kind in kinds:
        out.append(last)
        if kind in wanted:
            last = kind
    return out


def good_paragraphs(paragraphs, stops):
    """Texts of the paragraphs to keep: unsure ones follow their neighbours on both sides."""
    kinds = [own_kind(p["text"], p["link_chars"], stops) for p in paragraphs]
    sides = []
    for order in (1, -1):
        seen = kinds[::order]
        firm, long = nearest(seen, ("good", "bad")), nearest(seen, ("good", "bad", "near-good"))
        sides.append(list(zip(firm, long))[::order])
    kept = []
    for paragraph, kind, (before, long_before), (after, long_after) in zip(paragraphs, kinds, *sides):
        if kind == "near-good":
            kind = "bad" if before == after == "bad" else "good"
        elif kind == "short":
            if before == after:
                kind = before
            else:
                touched = (before == "bad" and long_before == "near-good") or (after == "bad" and long_after == "near-good")
                kind = "good" if touched else "bad"
        if kind == "good":
            kept.append(paragraph["text"])
    return kept


def extract_html(df, stops, html="html", id="page_id", default_lang="en"):
    """(id, text): main text per page; pages without any keep an empty text.

    Row by row, without a shuffle. `stops` is bounded (100 words per language) and travels
    with the tasks.
    """
    words_of = {r["lang"]: frozenset(r["stop_words"]) for r in stops.select("lang", "stop_words").collect()}
    code = F.lower(F.regexp_extract(html, r"(?i)<html[^>]*\blang=[\"']?([A-Za-z]{2})", 1))
    pages = df.select(id, F.when(code == "", default_lang).otherwise(code).alias("lang"), F.col(html).alias("html"))
    kind = dict(df.dtypes)[id]

    def texts(batches):
        for batch in batches:
            found = [
                "\n".join(good_paragraphs(page_paragraphs(page), words_of.get(lang, frozenset())))
                for lang, page in zip(batch.column("lang").to_pylist(), batch.column("html").to_pylist())
            ]
            yield pa.RecordBatch.from_arrays([batch.column(id), pa.array(found, pa.string())], names=[id, "text"])

    return pages.mapInArrow(texts, f"`{id}` {kind}, text string")


def trigram_profiles(df, text="text", lang="lang", top=300):
    """(lang, gram, weight): log-probability of the most frequent trigrams above
    the floor of an unseen one. At most `top` rows per language."""
    grams = df.select(lang, F.explode(char_ngrams(F.lower(text), 3)).alias("gram"))
    counted = grams.groupBy(lang, "gram").agg(F.count("*").alias("n"))
    totals = counted.groupBy(lang).agg(F.sum("n").alias("total"))
    order = Window.partitionBy(lang).orderBy(F.desc("n"), "gram")
    best = counted.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= top)
    weight = F.log(F.col("n") / F.col("total")) - F.log(0.5 / F.col("total"))
    return best.join(totals, lang).select(lang, "gram", weight.alias("weight"))


def language_id(df, profiles, text="text", id="doc_id"):
    """Best language and its share of the score, row by row without a shuffle.

    The profiles are bounded (300 rows per language) and travel with the tasks.
    """
    weights = {}
    for row in profiles.collect():
        weights.setdefault(row["gram"], []).append((row["lang"], row["weight"]))
    low = df.withColumn("_low", F.lower(text))
    names = df.columns
    shape = ", ".join(f"`{name}` {kind}" for name, kind in df.dtypes)

    def best(value):
        grams = Counter([value] if len(value) < 3 else [value[k : k + 3] for k in range(len(value) - 2)])
        sums = {}
        for gram, count in grams.items():
            for lang, weight in weights.get(gram, ()):
                sums[lang] = sums.get(lang, 0.0) + count * weight
        if not sums:
            return "unknown", 0.0
        score, lang = max((s, lang) for lang, s in sums.items())
        return lang, score / sum(sums.values())

    def rows(batches):
        for batch in batches:
            found = [best(v) if v is not None else ("unknown", 0.0) for v in batch.column("_low").to_pylist()]
            columns = [batch.column(name) for name in names]
            columns += [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "language", "language_score"])

    return low.mapInArrow(rows, f"{shape}, language string, language_score double")


def language_label(score, code):
    """The string form `[0.95, 'EN']`."""
    return F.concat(F.lit("["), F.round(score, 2).cast("string"), F.lit(", '"), F.upper(code), F.lit("']"))


def language_code(label):
    """Code from the string form."""
    return F.regexp_extract(label, r"'([A-Za-z]+)'", 1)

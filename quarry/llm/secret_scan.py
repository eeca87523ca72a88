"""Secret scan with corpus-wide ownership frequency.

A pass over the texts finds candidate spans by pattern and hashes their values; only spans
and hashes leave it. The hashes are then counted over the corpus by distinct owner and
repository. A value that several owners have is a copied example (documentation, test
fixtures); a value of few owners looks live. Counting combines before each shuffle, and the
counts go back to the rows by a join that cuts hot values into slices.
"""

import hashlib
import re

import pyarrow as pa
from pyspark.sql import functions as F

from quarry.llm.common import attach, broadcast_up_to, stored

# The patterns of the contract ...
ASSIGN = re.compile(
    r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_VALUE = 6
BASE_KINDS = ("assign", "access", "hex")
# ... and public token formats that the method adds.
ADDED = {
    "github": ("gh", re.compile(r"gh[pousr]_[A-Za-z0-9]{36,}")),
    "google": ("AIza", re.compile(r"AIza[0-9A-Za-z_-]{35}")),
    "slack": ("xox", re.compile(r"xox[abprs]-[A-Za-z0-9-]{10,}")),
    "jwt": ("eyJ", re.compile(r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]+")),
}
# A PEM key is found by its markers. Where the END marker is missing, the key ends with its base64
# run: PEM headers, chunks of 16 and more, and a last shorter chunk that fills a line or is padded.
MARKER = re.compile(r"-----(BEGIN|END) [A-Z ]{0,20}PRIVATE KEY-----")
_GAP = r"""(?:\s|\\[nrt]|["'+>#*|,])"""
BASE64_RUN = re.compile(
    rf"""(?:{_GAP}*+(?:Proc-Type|DEK-Info):\x20*[A-Za-z0-9,-]+)*+"""
    rf"""(?:{_GAP}*+[A-Za-z0-9+/]{{16,}}+(?!=))*+"""
    rf"""(?:{_GAP}*+[A-Za-z0-9+/]++(?:={{1,2}}|(?<![A-Za-z0-9+/]{{16}})(?=["']?(?:[\r\n]|\\[nr]|\Z))))?"""
)
# What may stand between both markers: the same, with a last chunk of any length.
KEY_BODY = re.compile(
    rf"""(?:{_GAP}*+(?:Proc-Type|DEK-Info):\x20*[A-Za-z0-9,-]+)*+"""
    rf"""(?:{_GAP}*+[A-Za-z0-9+/]{{16,}}+(?!=))*+(?:{_GAP}*+[A-Za-z0-9+/]++={{0,2}})?{_GAP}*+"""
)
NOT_KEY = re.compile(r"\\[nrt]|[^A-Za-z0-9]")
KINDS = (*BASE_KINDS, *ADDED, "key")
MAX_OWNERS = 2
MASK = "[SECRET]"
BROADCAST_ROWS = 1_000_000

SPANS = "array<struct<kind:int,start:int,end:int,hash:bigint>>"
ARROW_SPANS = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("hash", pa.int64())]))


def find_keys(text):
    """(start, end, value) of PEM private keys; the value is the body without line breaks and punctuation.

    A key runs to its END marker if only key material stands in between, else to the end of its
    base64 run. A BEGIN marker without a body stands for itself.
    """
    markers = list(MARKER.finditer(text))
    for mark, after in zip(markers, [*markers[1:], None]):
        if mark[1] == "END":
            continue
        if after and after[1] == "END" and KEY_BODY.fullmatch(text, mark.end(), after.start()):
            body, end = text[mark.end() : after.start()], after.end()
        else:
            end = BASE64_RUN.match(text, mark.end()).end()
            body = text[mark.end() : end]
        yield mark.start(), end, NOT_KEY.sub("", body) or mark[0]


def find_spans(text):
    """(kind number, start, end, value) of all candidates, by start, then kind; offsets in code points."""
    if not text:
        return []
    found, low = [], text.lower()
    if "passw" in low or "secret" in low or "token" in low or "api" in low:
        # Matches are taken before the length test: a match that fails it still covers its text.
        found += [(0, *m.span(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_VALUE]
    if "AKIA" in text:
        found += [(1, *m.span(), m[0]) for m in ACCESS.finditer(text)]
    found += [(2, *m.span(), m[0]) for m in HEX.finditer(text)]
    for number, (sign, pattern) in enumerate(ADDED.values(), len(BASE_KINDS)):
        if sign in text:
            found += [(number, *m.span(), m[0]) for m in pattern.finditer(text)]
    if "-----BEGIN" in text:
        found += [(KINDS.index("key"), *key) for key in find_keys(text)]
    return sorted(found, key=lambda s: (s[1], s[0]))


def value_hash(value):
    return int.from_bytes(hashlib.blake2b(value.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def scan_texts(docs):
    """(doc_id, text_key, repository, owner, text) -> the same without text, with `spans`."""

    def run(batches):
        for batch in batches:
            spans = [
                [{"kind": k, "start": a, "end": b, "hash": value_hash(v)} for k, a, b, v in find_spans(t)]
                for t in batch.column("text").to_pylist()
            ]
            columns = [batch.column(c) for c in ("doc_id", "text_key", "repository", "owner")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(spans, ARROW_SPANS)], names=["doc_id", "text_key", "repository", "owner", "spans"]
            )

    ids = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {ids}, text_key bigint, repository string, owner string, spans {SPANS}")


def ownership(scanned):
    """(hash, n_owners, n_repositories, n): how widely every candidate value is spread."""
    values = scanned.select("owner", "repository", F.explode("spans.hash").alias("hash"))
    places = values.groupBy("hash", "owner", "repository").agg(F.count("*").alias("n"))
    owners = places.groupBy("hash", "owner").agg(F.count("*").alias("repositories"), F.sum("n").alias("n"))
    return owners.groupBy("hash").agg(
        F.count("*").alias("n_owners"), F.sum("repositories").alias("n_repositories"), F.sum("n").alias("n")
    )


def scan(docs, doc_id="doc_id", text="text", repository="source", owner="source", max_owners=MAX_OWNERS):
    """One row per document: (doc_id, text_key, spans, live).

    `spans` are structs (kind number in `KINDS`, start, end, hash) by start, then kind; `live`
    are the (start, end) of those whose value at most `max_owners` owners have. Null and empty
    texts have no spans. A null owner or repository counts as one more, named ''. Repeated rows
    each get their row, and copies within one owner count once. `repository` and `owner` are
    column names or expressions. Other columns are ignored.
    """
    column = lambda c: F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("text_key"),
        column(repository).alias("repository"), column(owner).alias("owner"), F.col(text).alias("text"),
    )
    scanned = stored(scan_texts(rows).select(F.monotonically_increasing_id().alias("row"), "*"))
    held = scanned.filter(F.size("spans") > 0)
    found = held.select("row", F.explode("spans").alias("span")).select("row", "span.*")
    known = attach(found, stored(ownership(held)), ["hash"], ["row"])
    is_live = F.when(F.col("n_owners") <= max_owners, F.struct("start", "end"))
    live = known.groupBy("row").agg(F.array_sort(F.collect_list(is_live)).alias("live"))
    none = F.array().cast("array<struct<start:int,end:int>>").alias("live")
    out = ["doc_id", "text_key", "spans", "live"]
    return held.join(live, "row").select(*out).unionByName(scanned.filter(F.size("spans") == 0).select("doc_id", "text_key", "spans", none))


def span_text(spans):
    """'kind:start:end,...' of a span column."""
    names = F.split(F.lit(",".join(KINDS)), ",")
    named = F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")))
    return F.concat_ws(",", named)


def secret_report(docs, **options):
    """The digest of `scan`: counts per base kind, base_sha256, spans, n_live, n_shared."""
    base = F.filter("spans", lambda s: s["kind"] < len(BASE_KINDS))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("bigint")
    return scan(docs, **options).select(
        "doc_id", *[count(k).alias(f"n_{kind}") for k, kind in enumerate(BASE_KINDS)],
        F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"),
        F.size("live").cast("bigint").alias("n_live"), (F.size("spans") - F.size("live")).cast("bigint").alias("n_shared"),
    )


def redacted(text, live, mask=MASK):
    """`text` with the (start, end) spans of `live` replaced; overlapping spans give one mask."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(state, span):
        fresh = span["start"] >= state["at"]
        before = F.concat(state["out"], F.substring(text, state["at"] + 1, span["start"] - state["at"]), F.lit(mask))
        return F.struct(F.when(fresh, before).otherwise(state["out"]).alias("out"), F.greatest(state["at"], span["end"]).alias("at"))

    return F.aggregate(live, start, step, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.char_length(text))))


def redact_live(docs, doc_id="doc_id", text="text", mask=MASK, **options):
    """All rows and columns of `docs`, live-looking values masked in the text."""
    live = scan(docs, doc_id=doc_id, text=text, **options).filter(F.size("live") > 0)
    live = stored(live.select("doc_id", "text_key", "live").dropDuplicates(["doc_id", "text_key"]))
    same = docs[doc_id].eqNullSafe(live["doc_id"]) & (F.xxhash64(docs[text]) == live["text_key"])
    joined = docs.join(broadcast_up_to(live, BROADCAST_ROWS), same, "left")
    clean = F.when(live["live"].isNull(), docs[text]).otherwise(redacted(docs[text], live["live"], mask))
    return joined.select(*[clean.alias(c) if c == text else docs[c] for c in docs.columns])

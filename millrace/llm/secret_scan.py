"""Secrets in texts: fixed patterns, and strings in sensitive places that a primed compressor finds new.

For every long string near a sensitive word, the marginal cost is measured: the
bytes that zstandard, primed with a dictionary of identifiers, needs for the
surrounding text with the string, less those without it. Names and words that
the dictionary or the surroundings hold cost little; random strings cost about
as many bytes as they have characters, and are reported.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import mapped

# The base patterns, and the least length of what they find.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 8, 16, 32
BASE_KINDS = ("assign", "access", "hex")

SENSITIVE = "password passwd passphrase pwd secret token apikey api_key api-key access_key private_key auth bearer credential signature".split()
IDENTIFIERS = """
    access account admin algorithm apikey application argument array async authorization await backend base64 boolean
    branch buffer build cache callback certificate channel class client cluster column commit config configuration
    connection console const constructor container content context controller cookie credentials database dataset
    debug default delete dependency description development directory document domain element email encoding endpoint
    environment error event example exception export expression factory false field file filename filter float format
    function gateway generate global handler hash header hostname identifier image implementation import index input
    instance integer interface iterator javascript json key keyspace language length library listener localhost
    location logger login manager message metadata method middleware module namespace network none null number object
    operation option output package parameter password path pattern payload permission pipeline placeholder plugin
    pointer policy port postgres prefix private process production profile project property protocol provider proxy
    public python query queue reference refresh register region release remote repository request resource response
    result return role route runtime sample schema scope secret security select sender server service session setting
    signature socket source staging state static status storage stream string struct table target template test thread
    timeout timestamp token transaction true undefined unique update upload username utils value variable vendor
    version virtual webhook workflow workspace your_api_key_here changeme example_password xxxxxxxxxxxxxxxx
    abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 1234567890 00000000000000000000
""".split()


@dataclass(frozen=True)
class Novelty:
    """When a string is reported: characters, reach of a sensitive word, marginal bytes per character."""

    least_chars: int = 16
    reach: int = 40
    around: int = 256
    least_cost: float = 0.6
    sensitive: tuple[str, ...] = tuple(SENSITIVE)
    identifiers: tuple[str, ...] = field(default=tuple(IDENTIFIERS), repr=False)


def merged(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """The same places as disjoint spans in order."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = out[-1][0], max(end, out[-1][1])
        else:
            out.append((start, end))
    return out


class Places:
    """Disjoint spans in order, found by place."""

    def __init__(self, spans: Iterable[tuple[int, int]]):
        self.spans = list(spans)
        self.starts, self.ends = [s for s, _ in self.spans], [e for _, e in self.spans]

    def touching(self, start: int, end: int) -> list[tuple[int, int]]:
        """Spans that overlap [start, end) or end or begin at its edges."""
        return self.spans[bisect_left(self.ends, start):bisect_right(self.starts, end)]


class Scanner:
    """Finds spans (kind, start, end) in one text; places are code points, ends exclusive."""

    def __init__(self, novelty: Novelty):
        self.novelty = novelty
        self.assign, self.access, self.hex = re.compile(ASSIGN, re.ASCII), re.compile(ACCESS), re.compile(HEX)
        self.assign_words = [w.encode() for w in ("password", "passwd", "secret", "token", "apikey", "api_key")]
        self.words = [w.encode() for w in novelty.sensitive]
        self.near = re.compile("(?i:" + "|".join(map(re.escape, sorted(novelty.sensitive, key=len, reverse=True))) + ")", re.ASCII)
        self.string = re.compile(r"[A-Za-z0-9+/_.=~!@#$%^&*-]{" + str(novelty.least_chars) + ",}")
        self.hex_marks = bytes(1 if chr(c) in "0123456789abcdef" else 0 for c in range(256))
        primer = zstandard.ZstdCompressionDict("\n".join(novelty.identifiers).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.packer = zstandard.ZstdCompressor(level=19, dict_data=primer, write_content_size=False)

    def base(self, text: str, raw: bytes, lower: bytes) -> list[tuple[int, int, str]]:
        found = []
        if any(w in lower for w in self.assign_words):
            found += [(m.start(), m.end(), "assign") for m in self.assign.finditer(text) if len(m[2]) >= LEAST_VALUE]
        if b"AKIA" in raw:
            found += [(m.start(), m.end(), "access") for m in self.access.finditer(text) if len(m[0]) >= LEAST_ACCESS]
        if b"\1" * LEAST_HEX in raw.translate(self.hex_marks):
            found += [(m.start(), m.end(), "hex") for m in self.hex.finditer(text)]
        return found

    def cost(self, text: str, start: int, end: int) -> float:
        """Marginal compressed bytes per character of text[start:end] within its surroundings."""
        before, after = text[max(0, start - self.novelty.around):start], text[end:end + self.novelty.around]
        size = lambda s: len(self.packer.compress(s.encode("utf-8", "replace")))
        return (size(before + text[start:end] + after) - size(before + after)) / (end - start)

    def novel(self, text: str, lower: bytes, taken: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
        """Long strings within reach of a sensitive word, before, after or around it, that cost enough.

        A string that base spans cover needs no second report; one that is longer is
        reported as well. Of a string that costs too little as a whole, for it holds
        sensitive words or base spans, the parts between these are measured.
        """
        if not any(w in lower for w in self.words):
            return []
        reach, least = self.novelty.reach, self.novelty.least_cost
        words, base = Places(m.span() for m in self.near.finditer(text)), Places(merged((s, e) for s, e, _ in taken))
        found: list[tuple[int, int, str]] = []
        for m in self.string.finditer(text):
            start, end = m.span()
            if not words.touching(start - reach, end + reach) or any(s <= start and end <= e for s, e in base.touching(start, end)):
                continue
            if self.cost(text, start, end) >= least:
                found.append((start, end, "novel"))
                continue
            inner = [(s, e) for s, e in (*words.touching(start, end), *base.touching(start, end)) if s < end and start < e]
            if not inner:
                continue
            cuts = merged(inner)
            for s, e in zip([start, *[e for _, e in cuts]], [*[s for s, _ in cuts], end], strict=True):
                if e - s >= self.novelty.least_chars and words.touching(s - reach, e + reach) and self.cost(text, s, e) >= least:
                    found.append((s, e, "novel"))
        return found

    def spans(self, text: str) -> list[tuple[str, int, int]]:
        """By start, then kind in the order assign, access, hex, novel."""
        raw = text.encode("utf-8", "replace")
        lower = raw.lower()
        found = self.base(text, raw, lower)
        found += self.novel(text, lower, found)
        kinds = (*BASE_KINDS, "novel")
        return [(k, s, e) for s, e, k in sorted(found, key=lambda f: (f[0], kinds.index(f[2]), f[1]))]

    def redacted(self, text: str, mark: str) -> str:
        out, at = [], 0
        for _, start, end in self.spans(text):
            if end <= at:
                continue
            if start >= at:
                out += [text[at:start], mark]
            at = end
        return "".join([*out, text[at:]])


SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


class SecretScan:
    """Secrets of whole texts. Null and empty texts hold none; rows are scanned one by one, so repeated
    rows give equal results and an empty table none; other columns stay as they are."""

    def __init__(self, novelty: Novelty | None = None):
        self.novelty = novelty or Novelty()

    def spans(self, df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
        """Per row: doc_id and all spans, an array of (kind, start, end)."""
        novelty = self.novelty

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            scanner = Scanner(novelty)
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
            for batch in batches:
                spans = [[{"kind": k, "start": s, "end": e} for k, s, e in scanner.spans(t.as_py() or "")] for t in batch.column(1)]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], names=["doc_id", "spans"])

        plain = df.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.col(f"`{text_column}`"))
        return plain.mapInArrow(run, T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("spans", SPANS)]))

    def redacted(self, text: Column, mark: str = "[SECRET]") -> Column:
        """The text with every found span replaced by `mark`; null stays null."""
        novelty = self.novelty
        scanners: list[Scanner] = []

        def redact(texts: pa.Array) -> pa.Array:
            if not scanners:
                scanners.append(Scanner(novelty))
            return mapped(lambda t: None if t is None else scanners[0].redacted(t, mark), texts, pa.string())

        return F.arrow_udf(redact, "string")(text)


def listed(spans: Column) -> Column:
    """Spans as text: kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(spans_by_document: DataFrame) -> DataFrame:
    """Per document: doc_id, counts of the base kinds, the hash of the base spans, and all spans as text."""
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["kind"].isin(*BASE_KINDS))

    def count(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return spans_by_document.select("doc_id", *map(count, BASE_KINDS), F.sha2(listed(base), 256).alias("base_sha256"), listed(spans).alias("spans"))

"""Jaccard self-join of documents' word n-grams by several global token orders.

Two sets of n1 and n2 tokens with Jaccard >= t differ in at most
d = (1 - t) / (1 + t) * (n1 + n2) tokens. Cut the range of hashes into more than
d parts, each the head of an order of its own that begins with its tokens: a
differing token changes one head, so at least one of any d + 1 heads is equal in
both sets. A set gives its d + 1 fullest heads as signatures, by an order of
heads that all sets agree on, so similar sets meet. Heads hold several tokens, so
texts that share a token by chance don't meet, however many texts there are. As d
depends on the sizes, a set does so in each interval of sizes that it may share
with a similar one. Where too few heads hold tokens, sets give their prefixes too:
the first n - ceil(t * n) + 1 tokens of one order, in which similar sets meet as
well. A pair then has to share prefix tokens under two further, independent orders
before its sets are fetched and compared.

Equal sets are one class from the start. Between classes, groups that share a
signature are first compared with one representative each (a linear number of
pairs); pairs of members are formed only where representatives have not already
shown that both lie in one component. So a large group of near copies needs few
pairs, and no link between components is lost.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from functools import cache, lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import written
from millrace.llm.components import components

# An interval of sizes begins at this share of the one before; the parts of the range are this share of the signatures.
NEXT_SIZE = (4, 3)
PARTS = (3, 2)
MOST_TOKENS = 1 << 40
# Classes with more rows than this (or than a 20,000th of the table) give their signatures once.
MANY_COPIES = 100
MOST_HOT_CLASSES = 20_000
# One class in 256 is looked at to find signatures of very many documents, which are then counted without moving
# their rows. At most MOST_HOT_TOKENS of them are broadcast; missing one costs time, no result.
LOOK = 256
HOT_IN_LOOK = 64
MOST_HOT_TOKENS = 50_000
BLOCK = 1 << 16
# Bits of the filter that says whose sets are needed, by number of ids: 32 KB to 16 MB.
FILTER_BITS = range(18, 28)
# Representatives of a signature in a round: groups up to about this size are compared whole at once. Near copies
# share most of their signatures, so few do.
REPRESENTATIVES = 8
# Another round follows if at least this share of the pairs compared were links.
WORTH_A_ROUND = 0.1
PARITY = ("b0", "b1", "b2", "b3")
SHARED = ("token", "node", "n", *PARITY)
MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A permutation of 64-bit numbers without visible pattern; each seed gives another."""
    x = x + np.uint64((seed * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * MIX[1]
    x = (x ^ (x >> np.uint64(27))) * MIX[2]
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's `size`-word shingles, A-Z lower-cased.

    Fewer words make one shingle of all of them; no word makes none.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(size, len(words))
    out = np.full(len(words) - width + 1, width, np.uint64)
    for k in range(width):
        out = mixed(out * MIX[0] + hashes[k:len(hashes) - width + 1 + k])
    return np.unique(out)


def set_hash(tokens: np.ndarray) -> int:
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(tokens.tobytes())).astype(np.int64)))


def parity(tokens: np.ndarray) -> list[int]:
    """256 bits as four numbers: whether an odd number of the tokens fall on each."""
    at = (mixed(tokens, 5) >> np.uint64(56)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=256) & 1).view(">i8").tolist()


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


@cache
def intervals(percent: int) -> list[tuple[int, int, int]]:
    """Intervals of sizes (first, last, d) of which one holds any two similar sets; such sets differ in at most d tokens.

    The smaller set is below the next interval's first size.
    """
    out, first = [], 1
    while first < MOST_TOKENS:
        after = max(first + 1, first * NEXT_SIZE[0] // NEXT_SIZE[1])
        last = (after - 1) * 100 // percent
        out.append((first, last, (100 - percent) * (after - 1 + last) // (100 + percent)))
        first = after
    return out


@lru_cache(512)
def parts(at: int, d: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the parts of an interval's range end, the last aside, and a mark of each part."""
    n = -(-(d + 1) * PARTS[0] // PARTS[1])
    return np.arange(1, n, dtype=np.uint64) * np.uint64((1 << 64) // n), mixed(np.arange(n, dtype=np.uint64) + np.uint64(at << 50), 6)


def heads(tokens: np.ndarray, percent: int) -> np.ndarray:
    """The signatures of a set, given its tokens in order; similar sets that aren't equal have one in common."""
    n, known = len(tokens), intervals(percent)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(tokens, 7))])
    out, whole = [np.zeros(0, np.uint64)], True
    at = bisect_right(known, (n, MOST_TOKENS * 200, 0)) - 1
    while at >= 0 and known[at][1] >= n:
        if d := known[at][2]:  # sets that differ in none are equal
            limits, marks = parts(at, d)
            ends = np.concatenate([[0], np.searchsorted(tokens, limits), [n]])
            held = np.diff(ends)
            fullest = np.argsort((held.astype(np.uint64) << np.uint64(24)) | (marks >> np.uint64(40)), kind="stable")[-(d + 1):]
            chosen = fullest[held[fullest] > 0]
            whole &= len(chosen) > d
            out.append(mixed(sums[ends[chosen + 1]] - sums[ends[chosen]] + marks[chosen]))
        at -= 1
    if not whole:
        out.append(mixed(tokens[:prefix_length(n, percent)], 9))
    return np.concatenate(out)


def _signatures(df: DataFrame, size: int, percent: int) -> DataFrame:
    """Per document its set's size, hash, parities and signatures."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, held = [], 0
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                tokens = shingle_set(text.as_py(), size)
                signs = heads(tokens, percent) if len(tokens) else tokens
                rows.append((doc, len(tokens), set_hash(tokens), *parity(tokens), signs.view(np.int64)))
                held += len(signs)
                if held > 200_000:
                    yield _rows(rows)
                    rows, held = [], 0
            if rows:
                yield _rows(rows)

    def _rows(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (*[pa.int64()] * 7, pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["doc_id", "n", "h", *PARITY, "signs"])

    return df.mapInArrow(run, f"doc_id long, n long, h long, {', '.join(f'{c} long' for c in PARITY)}, signs array<long>")


def _places(ids: np.ndarray, width: int) -> np.ndarray:
    """The bits of each id in a filter of 2 ** width ones, one row per hash."""
    return np.stack([mixed(ids.astype(np.uint64), k) >> np.uint64(64 - width) for k in (11, 12, 13)]).astype(np.int64)


def _membership(nodes: DataFrame, width: int) -> bytes:
    """A Bloom filter over the ids: none is missing; beyond some ten million ids, ever more others pass."""
    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << width, np.bool_)
        for batch in batches:
            bits[_places(batch.column(0).to_numpy(), width).ravel()] = True
        packed = np.packbits(bits)
        parts = [(k, packed[k:k + BLOCK]) for k in range(0, len(packed), BLOCK)]
        if rows := [(k, p.tobytes()) for k, p in parts if p.any()]:
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows], pa.int32()), pa.array([p for _, p in rows], pa.binary())], names=["block", "bits"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, part in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                part = np.frombuffer(part.as_py(), np.uint8)
                out[k] = out[k] | part if k in out else part
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(list(out), pa.int32()), pa.array([p.tobytes() for p in out.values()], pa.binary())], names=["block", "bits"])

    bits = bytearray((1 << width) // 8)
    for row in nodes.mapInArrow(fill, "block int, bits binary").repartition(16, "block").mapInArrow(merge, "block int, bits binary").collect():
        bits[row["block"]:row["block"] + len(row["bits"])] = row["bits"]
    return bytes(bits)


def _sets(df: DataFrame, size: int, percent: int, member) -> DataFrame:
    """Of the documents that pass the filter: id (as node), prefixes under two further orders, and the set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(member.value, np.uint8)
        for batch in batches:
            batch = batch.filter(batch.column(0).is_valid())
            ids = batch.column(0).to_numpy()
            at = _places(ids, (len(bits) * 8).bit_length() - 1)
            passed = np.flatnonzero((bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).all(0)) if len(ids) else []
            rows, held = [], 0
            for k in passed:
                tokens = shingle_set(batch.column(1)[int(k)].as_py(), size)
                if n := len(tokens):
                    p = prefix_length(n, percent)
                    ends = [tokens[np.argsort(mixed(tokens, o))[:p]].view(np.int64) for o in (2, 3)]
                    rows.append((int(ids[k]), *ends, tokens.view(np.int64)))
                    held += n
                if held > 500_000:
                    yield _batch(rows)
                    rows, held = [], 0
            if rows:
                yield _batch(rows)

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), *[pa.list_(pa.int64())] * 3)
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["node", "second", "third", "tokens"])

    return df.mapInArrow(run, "node long, second array<long>, third array<long>, tokens array<long>")


class NgramJaccardJoin:
    """Links between documents whose sets of `size`-word shingles have Jaccard >= `percent` / 100.

    `links` is a spanning set, enough to connect every component: pairs already in one
    component are not compared, so it is not the whole join and its size no number of
    similar pairs.

    Null and empty texts, and texts of white space, have the empty set and link
    with nothing; rows without an id are listed but link with nothing either.
    Rows that share an id are one document, whose texts' links all count. Copies
    form one class, whatever their number. Columns besides id and text are not
    read.
    """

    def __init__(self, df: DataFrame, id_column: str = "doc_id", text_column: str = "text", size: int = 5, percent: int = 80):
        self.size, self.percent = size, percent
        self.docs = df.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.col(f"`{text_column}`").alias("text"))
        self.signatures = written(_signatures(self.docs, size, percent), "signatures")
        self.rows = self.signatures.select("doc_id", "n", "h", *PARITY)
        self.classes = written(
            self.rows.where(F.col("n") > 0).groupBy("n", "h")
            .agg(F.min("doc_id").alias("node"), F.count("doc_id").alias("copies"), *[F.first(b).alias(b) for b in PARITY]).where(F.col("node").isNotNull()),
            "classes",
        )
        self.shared = self._shared_tokens()
        self.sets: DataFrame | None = None
        self.links = self._links()

    def _tokens(self) -> DataFrame:
        """Signatures with the hashes of their documents' sets: h, token."""
        rows = self.classes.agg(F.sum("copies")).first()[0] or 0
        many = F.broadcast(self.classes.where(F.col("copies") > max(MANY_COPIES, rows // MOST_HOT_CLASSES)).select("n", "h"))
        known = self.signatures.where((F.col("n") > 0) & F.col("doc_id").isNotNull()).select("n", "h", "signs")
        once = known.join(many, ["n", "h"], "left_semi").groupBy("n", "h").agg(F.first("signs").alias("signs"))
        kept = known.join(many, ["n", "h"], "left_anti").unionByName(once)
        return kept.select("h", F.explode("signs").alias("token"))

    def _shared_tokens(self) -> DataFrame:
        """Signatures that several classes hold: token, node, n and parities. Of signatures of the same classes, one is kept."""
        tokens = self._tokens()
        looked = tokens.where(F.pmod(F.xxhash64("h"), F.lit(LOOK)) == 0).select("token")
        least = max(HOT_IN_LOOK, looked.count() // MOST_HOT_TOKENS + 1)
        hot = written(looked.groupBy("token").count().where(F.col("count") >= least).select("token"), "hot-tokens")
        # The holders as a set: their number and two sums of 32 bits each of another hash.
        own, half = F.xxhash64("h"), F.lit((1 << 32) - 1)
        holders = {"low": F.min("h"), "high": F.max("h"), "held": F.count("*"), "sum1": F.sum(own.bitwiseAND(half)), "sum2": F.sum(F.shiftrightunsigned(own, 32))}
        counts = tokens.join(F.broadcast(hot), "token").groupBy("token").agg(*[c.alias(name) for name, c in holders.items()])
        by_token = Window.partitionBy("token")
        rest = tokens.join(F.broadcast(hot), "token", "left_anti").select("*", *[c.over(by_token).alias(name) for name, c in holders.items()])
        several = rest.unionByName(tokens.join(F.broadcast(counts), "token")).where(F.col("low") != F.col("high")).drop("low", "high")
        several = written(several, "several")
        kept = several.groupBy("held", "sum1", "sum2").agg(F.min("token").alias("token")).select("token")
        one = several.join(kept, "token", "left_semi").select("token", "h").distinct()  # copies of a text
        return written(one.join(self.classes, "h").select(*SHARED), "shared")

    def _possible(self) -> Column:
        """Whether sizes and parities leave room for enough common tokens.

        Bits in which the parities differ are tokens that only one of the sets has.
        """
        n1, n2 = F.col("l.n"), F.col("r.n")
        sizes = (100 * F.least(n1, n2)) >= (self.percent * F.greatest(n1, n2))
        differing = sum((F.bit_count(F.col(f"l.{b}").bitwiseXOR(F.col(f"r.{b}"))) for b in PARITY[1:]), F.bit_count(F.col("l.b0").bitwiseXOR(F.col("r.b0"))))
        return sizes & ((100 + self.percent) * differing <= (100 - self.percent) * (n1 + n2))

    def _fetch(self, pairs: DataFrame) -> None:
        """Have the sets of all documents in the pairs at hand."""
        nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        if self.sets is not None:
            nodes = nodes.join(self.sets.select("node"), "node", "left_anti")
        nodes = written(nodes, "nodes")
        missing = nodes.count()
        if self.sets is not None and not missing:
            return
        width = min(max((missing * 16).bit_length(), FILTER_BITS[0]), FILTER_BITS[-1])
        member = self.docs.sparkSession.sparkContext.broadcast(_membership(nodes, width))
        more = written(_sets(self.docs, self.size, self.percent, member).join(nodes, "node", "left_semi"), "sets")
        self.sets = more if self.sets is None else self.sets.unionByName(more)

    def _verified(self, pairs: DataFrame) -> DataFrame:
        """Those of the pairs (a, b) that share prefix tokens under the further orders and are similar enough."""
        ends = self.sets.select("node", "second", "third")
        near = (
            pairs.join(ends.toDF("a", "second_a", "third_a"), "a").join(ends.toDF("b", "second_b", "third_b"), "b")
            .where(F.arrays_overlap("second_a", "second_b") & F.arrays_overlap("third_a", "third_b")).select("a", "b")
        )
        near = written(near, "near")  # small and of known size: only sets of its documents are shuffled
        needed = near.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        full = self.sets.select("node", "tokens").join(needed, "node", "left_semi")
        common = F.size(F.array_intersect("tokens_a", "tokens_b")).cast("long")
        union = F.size("tokens_a") + F.size("tokens_b") - common
        return near.join(full.toDF("a", "tokens_a"), "a").join(full.toDF("b", "tokens_b"), "b").where(100 * common >= self.percent * union).select("a", "b")

    def _pairs(self, left: DataFrame, right: DataFrame, labels: Column) -> DataFrame:
        """Distinct pairs that share a token, may be similar, and whose labels fulfil the condition."""
        met = left.alias("l").join(right.alias("r"), (F.col("l.token") == F.col("r.token")) & labels & self._possible())
        return written(met.select(F.least("l.node", "r.node").alias("a"), F.greatest("l.node", "r.node").alias("b")).distinct(), "pairs")

    def _open(self, labelled: DataFrame) -> tuple[DataFrame, int, int]:
        """The rows of tokens that documents of different labels hold, their number, and how many such pairs they form."""
        parts = labelled.groupBy("token", "label").agg(F.count("*").cast("double").alias("c"))
        tokens = parts.groupBy("token").agg(F.sum("c").alias("m"), F.sum(F.col("c") * F.col("c")).alias("own"), F.count("*").alias("labels")).where(F.col("labels") > 1)
        tokens = written(tokens.select("token", "m", ((F.col("m") * F.col("m") - F.col("own")) / 2).alias("pairs")), "open-tokens")
        totals = tokens.agg(F.coalesce(F.sum("m"), F.lit(0.0)).alias("rows"), F.coalesce(F.sum("pairs"), F.lit(0.0)).alias("pairs")).first()
        return written(labelled.join(tokens.select("token"), "token"), "open"), int(totals["rows"]), int(totals["pairs"])

    def _links(self) -> DataFrame:
        """Links enough to connect every component (a, b).

        Rounds with a few representatives per token, others each round, go on as
        long as a good part of their pairs are links and the pairs of different
        components still left are many: more than another round would form, and
        by the share of this round's pairs that stayed apart, more than a pair a
        row to compare. Then all those left are compared.
        """
        links = self.docs.sparkSession.range(0).select(F.col("id").alias("a"), F.col("id").alias("b"))  # rows from Python would start other workers
        rest, rows, left = self._open(self.shared.withColumn("label", F.col("node")))
        seed = 0
        while left > REPRESENTATIVES * rows:
            drawn = rest.withColumn("draw", F.xxhash64("node", F.lit(seed)))
            first = F.min(F.struct("draw", *SHARED[1:], "label")).alias("r")
            chosen = drawn.groupBy("token", F.pmod("draw", F.lit(REPRESENTATIVES)).alias("k")).agg(first).select("token", "r.*")
            pairs = self._pairs(rest, chosen, F.col("l.label") != F.col("r.label"))
            found = self._compared(pairs)
            links, seed = links.unionByName(found), seed + 1
            whole, formed = components(links), REPRESENTATIVES * rows
            labelled = rest.drop("label").join(whole, "node", "left").select(*SHARED, F.coalesce("component", "node").alias("label"))
            rest, rows, left = self._open(written(labelled, "labelled"))  # read twice
            ends = [whole.select(F.col("node").alias(c), F.col("component").alias(f"of_{c}")) for c in "ab"]
            of = [F.coalesce(f"of_{c}", c) for c in "ab"]
            apart = pairs.join(ends[0], "a", "left").join(ends[1], "b", "left").where(of[0] != of[1]).count()
            if found.count() <= WORTH_A_ROUND * pairs.count() or apart * left <= rows * formed:
                break
        return links.unionByName(self._compared(self._pairs(rest, rest, F.col("l.label") < F.col("r.label"))))

    def _compared(self, pairs: DataFrame) -> DataFrame:
        self._fetch(pairs)
        return written(self._verified(pairs), "links")

    def documents(self) -> DataFrame:
        """One row per input row: doc_id, n_shingles, component_id (its smallest doc_id; its own without links)."""
        found = components(self.links)
        labels = self.classes.join(found, "node", "left").select("n", "h", F.coalesce("component", "node").alias("component_id"))
        joined = self.rows.join(labels, ["n", "h"], "left")
        own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
        return joined.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))

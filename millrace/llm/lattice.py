"""Sampled segmentations over a SentencePiece vocabulary, and lossless decoding.

A text is cut before its blanks into chunks, which no piece crosses. Every
chunk's lattice has an edge for each piece that matches at each place, and byte
pieces for characters without a piece. Forward filtering sums the weights of all
paths to each place; backward sampling then draws a path from the end, each
edge with the probability that it lies on a path of the full distribution. The
random numbers are a function of the row's key and the place in the text alone,
so a segmentation can be drawn again anywhere.

Work is shared: forward filtering runs once per distinct chunk of a batch, and
each step of either pass handles all chunks at once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANK = 0x2581  # the character that stands for a blank in pieces
UNKNOWN = 0x110000  # no character: stands for one that pieces can't hold
CHUNK = re.compile(" *[^ ]+| +")
BATCH_CHARS = 1_000_000
U = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def extended(h: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    """Hashes of strings from those of the strings without their last symbol."""
    return mixed(h * U(0x9E3779B97F4A7C15) + symbol.astype(U) + U(1))


def uniform(key: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Numbers in [0, 1) that depend on row key and place only."""
    return (mixed(mixed(key) + place.astype(U) * U(0x9E3779B97F4A7C15)) >> U(11)) * 2.0**-53


def row_key(key: int | None, seed: int) -> int:
    """Null keys share one value outside the range of the others."""
    low = (key if key is not None else 1 << 63) & 0xFFFFFFFFFFFFFFFF
    return int(mixed(np.array([low ^ (seed * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)], U))[0])


def piece_bytes(model) -> list[bytes]:
    """What each piece of a SentencePiece model stands for."""
    pieces = [model.id_to_piece(k) for k in range(model.get_piece_size())]
    return [bytes([int(p[3:5], 16)]) if model.is_byte(k) else p.replace(chr(BLANK), " ").encode() for k, p in enumerate(pieces)]


class Vocabulary:
    """Pieces of a SentencePiece model with their log weights.

    A unigram model's scores are log probabilities and taken as they are. Those
    of a BPE model are merge ranks; a piece of rank r gets -sharpness * log(1 + r).
    """

    def __init__(self, model_path: str, sharpness: float = 1.0):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        size = model.get_piece_size()
        pieces = [model.id_to_piece(k) for k in range(size)]
        scores = np.array([model.get_score(k) for k in range(size)])
        kinds = [model.is_control(k) or model.is_unknown(k) or model.is_unused(k) for k in range(size)]
        byte = {int(p[3:5], 16): k for k, p in enumerate(pieces) if model.is_byte(k)}
        if len(byte) != 256:
            raise ValueError("the vocabulary needs a piece for every byte")
        ranks = scores.min() < -100
        weights = -sharpness * np.log1p(np.maximum(0, -scores)) if ranks else sharpness * scores
        usable = [k for k in range(size) if not kinds[k] and not model.is_byte(k) and pieces[k] and chr(BLANK) not in pieces[k].lstrip(chr(BLANK))]
        least = min((weights[k] for k in usable), default=0.0)
        self.byte_ids = np.array([byte[b] for b in range(256)], np.int64)
        self.byte_weight = float(least) - 1.0
        self.bytes = piece_bytes(model)
        self.longest = max((len(pieces[k]) for k in usable), default=0)
        # By length: hashes of all pieces of that length and of all beginnings of longer
        # ones, in order; the piece of each (-1: none), and whether longer ones begin so.
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        self.weights = weights
        own = np.array(usable, np.int64)
        lengths = np.array([len(pieces[k]) for k in usable], np.int64)
        symbols = np.array([[ord(c) for c in pieces[k].ljust(self.longest, "\0")] for k in usable], np.int64).reshape(len(usable), self.longest)
        h = np.zeros(len(usable), U)
        for n in range(1, self.longest + 1):
            h = extended(h, symbols[:, n - 1])
            known, number = np.unique(h[lengths >= n], return_inverse=True)
            piece, longer = np.full(len(known), -1, np.int64), np.zeros(len(known), bool)
            piece[number[lengths[lengths >= n] == n]] = own[lengths == n]
            longer[number[lengths[lengths >= n] > n]] = True
            if (piece >= 0).sum() != (lengths == n).sum():
                raise ValueError("two pieces share a hash")
            self.by_length[n] = known, piece, longer

    def decode(self, ids: Sequence[int]) -> str:
        return b"".join([self.bytes[k] for k in ids]).decode("utf-8", "replace")


def found(sorted_values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(whether each wanted value is there, where)."""
    if not len(sorted_values):
        return np.zeros(len(wanted), bool), np.zeros(len(wanted), np.int64)
    at = np.minimum(np.searchsorted(sorted_values, wanted), len(sorted_values) - 1)
    return sorted_values[at] == wanted, at


class Lattice:
    """The lattices of many chunks, forward filtered.

    Chunk c's places are nodes; edges are sorted by the node they end at, and
    `upto` holds node number plus cumulative probability, so a draw for any node
    is one search.
    """

    def __init__(self, vocabulary: Vocabulary, chunks: list[str]):
        lengths = np.array([len(c) for c in chunks], np.int64)
        codes = np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        symbols = np.where(codes == ord(" "), BLANK, np.where(codes == BLANK, UNKNOWN, codes))
        first = np.cumsum(lengths) - lengths
        chunk = np.repeat(np.arange(len(chunks)), lengths)
        place = np.arange(len(codes)) - first[chunk]
        self.base = first + np.arange(len(chunks))
        self.end = self.base + lengths
        node = self.base[chunk] + place
        left = lengths[chunk] - place
        sources, widths, weights, ids = [], [], [], []
        alive, h = np.arange(len(codes)), np.zeros(len(codes), U)
        covered = np.zeros(len(codes), bool)
        for n in range(1, vocabulary.longest + 1):
            fits = left[alive] >= n
            alive, h = alive[fits], h[fits]
            if not len(alive):
                break
            h = extended(h, symbols[alive + n - 1])
            known, piece, longer = vocabulary.by_length[n]
            there, at = found(known, h)
            alive, h, at = alive[there], h[there], at[there]
            own = piece[at]
            hit = own >= 0
            sources.append(alive[hit])
            widths.append(np.full(int(hit.sum()), n))
            weights.append(vocabulary.weights[own[hit]])
            ids.append(own[hit])
            if n == 1:
                covered[alive[hit]] = True
            alive, h = alive[longer[at]], h[longer[at]]
        # Characters without a piece: one edge of byte pieces, numbered below 0.
        bare = np.flatnonzero(~covered)
        self.runs: list[list[int]] = []
        listed: dict[int, int] = {}
        numbers = np.zeros(len(bare), np.int64)
        for k, code in enumerate(codes[bare].tolist()):
            if code not in listed:
                listed[code] = len(self.runs)
                self.runs.append(vocabulary.byte_ids[np.frombuffer(chr(code).encode("utf-8", "surrogatepass"), np.uint8)].tolist())
            numbers[k] = listed[code]
        run_lengths = np.array([len(r) for r in self.runs] or [0], np.int64)
        sources.append(bare)
        widths.append(np.ones(len(bare), np.int64))
        weights.append(vocabulary.byte_weight * run_lengths[numbers] if len(bare) else np.zeros(0))
        ids.append(-1 - numbers)
        source, width = np.concatenate(sources), np.concatenate(widths)
        start, weight, self.ids = node[source], np.concatenate(weights), np.concatenate(ids)
        goal, local = start + width, place[source] + width
        order = np.argsort(local * (len(codes) + len(chunks) + 1) + goal, kind="stable")
        start, goal, weight, self.ids, local = start[order], goal[order], weight[order], self.ids[order], local[order]
        total = np.zeros(len(codes) + len(chunks))
        share = np.zeros(len(start))
        bounds = np.searchsorted(local, np.arange(1, int(lengths.max(initial=0)) + 2))
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if a == b:
                continue
            value, to = total[start[a:b]] + weight[a:b], goal[a:b]
            heads = np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1]]))
            counts = np.diff(np.append(heads, b - a))
            most = np.maximum.reduceat(value, heads)
            part = np.exp(value - np.repeat(most, counts))
            sums = np.add.reduceat(part, heads)
            total[to[heads]] = most + np.log(sums)
            share[a:b] = part / np.repeat(sums, counts)
        order = np.argsort(goal, kind="stable")
        self.start, goal, self.ids, share = start[order], goal[order], self.ids[order], share[order]
        heads = np.flatnonzero(np.concatenate([[True], goal[1:] != goal[:-1]])) if len(goal) else np.zeros(0, np.int64)
        sums = np.cumsum(share)
        before = np.repeat(np.concatenate([[0.0], sums])[heads], np.diff(np.append(heads, len(goal)))) if len(goal) else sums
        self.upto = goal + np.minimum(sums - before, 1.0)
        # The last edge of a node takes whatever rounding leaves.
        if len(goal):
            self.upto[np.append(heads[1:], len(goal)) - 1] = goal[np.append(heads[1:], len(goal)) - 1] + 1
        self.total = total

    def sample(self, chunk: np.ndarray, key: np.ndarray, offset: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For occurrences of chunks, each with its row's key and its offset in the text: the edges drawn,
        occurrence by occurrence in text order, and how many each has."""
        at, base = self.end[chunk].copy(), self.base[chunk]
        active = np.flatnonzero(at > base)
        owners, edges = [], []
        while len(active):
            nodes = at[active]
            u = uniform(key[active], offset[active] + nodes - base[active])
            edge = np.searchsorted(self.upto, nodes + u, side="right")
            owners.append(active)
            edges.append(edge)
            at[active] = self.start[edge]
            active = active[self.start[edge] > base[active]]
        counts = np.bincount(np.concatenate(owners), minlength=len(chunk)) if owners else np.zeros(len(chunk), np.int64)
        out = np.zeros(int(counts.sum()), np.int64)
        last = np.cumsum(counts) - 1
        for step, (owner, edge) in enumerate(zip(owners, edges, strict=True)):
            out[last[owner] - step] = edge
        return out, counts


class SampledEncoder:
    """Draws segmentations of texts; equal (key, seed, text) give equal ids."""

    def __init__(self, vocabulary: Vocabulary, seed: int = 0):
        self.vocabulary, self.seed = vocabulary, seed

    def encode(self, keys: Sequence[int | None], texts: Sequence[str | None]) -> list[np.ndarray]:
        chunks = [CHUNK.findall(t or "") for t in texts]
        number = {c: k for k, c in enumerate(dict.fromkeys(c for own in chunks for c in own))}
        numbers = np.fromiter((n for own in chunks for n in map(number.__getitem__, own)), np.int64)
        if not len(numbers):
            return [np.zeros(0, np.int64) for _ in texts]
        lattice = Lattice(self.vocabulary, list(number))
        per_text = np.array([len(own) for own in chunks], np.int64)
        owner = np.repeat(np.arange(len(texts)), per_text)
        lengths = np.array([len(c) for c in number], np.int64)[numbers]
        before = np.cumsum(lengths) - lengths
        offset = before - np.concatenate([before, [0]])[(np.cumsum(per_text) - per_text)][owner]
        row_keys = np.array([row_key(k, self.seed) for k in keys], U)
        edges, counts = lattice.sample(numbers, row_keys[owner], offset)
        ids = lattice.ids[edges]
        in_text = np.bincount(owner, weights=counts, minlength=len(texts)).astype(np.int64)
        out = []
        for part in np.split(ids, np.cumsum(in_text)[:-1]):
            if (part < 0).any():
                part = np.array([k for i in part.tolist() for k in ([i] if i >= 0 else lattice.runs[-1 - i])], np.int64)
            out.append(part)
        return out


def sample_ids(df: DataFrame, model_path: str, id_column: str = "doc_id", text_column: str = "text", seed: int = 0, sharpness: float = 1.0) -> DataFrame:
    """Per row: doc_id, the text, and a sampled segmentation as ids (32-bit little-endian binary).

    Null and empty texts have no ids; rows of equal id and text get equal ids,
    rows without an id draw as one common key. Other columns are not read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = SampledEncoder(Vocabulary(model_path, sharpness), seed)
        for batch in batches:
            begin = 0
            while begin < batch.num_rows:
                end, held, texts = begin, 0, []
                while end < batch.num_rows and (not texts or held < BATCH_CHARS):
                    texts.append(batch.column(1)[end].as_py())
                    held += len(texts[-1] or "")
                    end += 1
                ids = encoder.encode(batch.column(0).slice(begin, end - begin).to_pylist(), texts)
                part = batch.slice(begin, end - begin)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array([i.astype("<u4").tobytes() for i in ids], pa.binary())], names=["doc_id", "text", "ids"])
                begin = end

    plain = df.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.col(f"`{text_column}`").cast("string").alias("text"))
    return plain.mapInArrow(run, "doc_id long, text string, ids binary")


def decoded(ids: Column, model_path: str) -> Column:
    """The text that ids of this vocabulary stand for."""
    pieces: list[list[bytes]] = []

    def run(batch: pa.Array) -> pa.Array:
        if not pieces:
            import sentencepiece

            pieces.append(piece_bytes(sentencepiece.SentencePieceProcessor(model_file=model_path)))
        own = pieces[0]
        texts = [None if i is None else b"".join([own[k] for k in np.frombuffer(i, "<u4").tolist()]).decode("utf-8", "replace") for i in batch.to_pylist()]
        return pa.array(texts, pa.string())

    return F.arrow_udf(run, "string")(ids)

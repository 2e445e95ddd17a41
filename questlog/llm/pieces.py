"""SentencePiece encoding by forward filtering and backward sampling.

A text's segmentations into pieces are the paths of a lattice; a path's weight
is the product of its pieces' probabilities to the power of a temperature. The
forward pass sums the weights of all paths to each character; the backward pass
draws a path from the end, each step in proportion to what its piece adds to
that sum, which samples whole segmentations exactly by their weight. The draws
are a keyed function of the row's key and the place in the text, so a row gets
the same segmentation on any run, machine or partitioning.

No piece crosses from a letter to a space, so the lattice falls apart at words:
each distinct word's forward pass is kept, and the backward pass runs over all
words of a batch together. Characters without a piece are spelt in bytes, and
so is the piece marker itself where a text has it: decoding gives back every text.

The model's pieces have ranks, not probabilities; a piece of rank r counts as
drawn with probability in proportion to 1 / (r + 10).
"""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, table, text_batches

MODEL = "piece_bpe_32k.model"
TEMPERATURE = 0.2
SEED = 42
SPACE = "▁"
# Edge ids from here on stand for a character (its code point) that is spelt in several bytes.
SPELT = 1 << 20
# Edges kept before the words are forgotten; characters of words learnt at once.
KEPT_EDGES = 3_000_000
LEARNT = 200_000
SLOT_BITS = 17
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
CHARS = 4_000_000  # of text sampled at once


class Lattices:
    """Pieces of a model, and the forward passes of the words seen."""

    def __init__(self, path: str, temperature: float = TEMPERATURE):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.bytes_of: list[bytes] = [b""] * n
        self.byte_id = [0] * 256
        self.piece: dict[str, tuple[int, float]] = {}
        rank = 0
        for i in range(n):
            p = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_id[int(p[3:5], 16)] = i
                self.bytes_of[i] = bytes([int(p[3:5], 16)])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                text = p.replace(SPACE, " ")
                self.bytes_of[i] = text.encode()
                self.piece[text] = (i, (8.0 * (rank + 10)) ** -temperature)
                rank += 1
        self.spelt = (8.0 * (rank + 10)) ** -temperature
        self.longest = max(map(len, self.piece))
        crosses = any(re.search("[^ ] ", p) for p in self.piece)
        lines = any("\n" in p for p in self.piece)
        # Where words end: before a space that follows anything else, and around line ends (no piece has one).
        self.words = re.compile(r"(?s).+" if crosses or lines else r" *[^ \n]+| +|\n")
        # Pieces by a hash of their characters, in a table with one entry a slot (of several a later table has the rest).
        hashes = np.array([_hash(p) for p in self.piece], np.uint64)
        ids, weights = (np.array(x) for x in zip(*self.piece.values()))
        self.tables = []
        while len(hashes):
            slot = (hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
            _, first = np.unique(slot, return_index=True)
            keys, at, weight = np.zeros(1 << SLOT_BITS, np.uint64), np.full(1 << SLOT_BITS, -1), np.zeros(1 << SLOT_BITS)
            keys[slot[first]], at[slot[first]], weight[slot[first]] = hashes[first], ids[first], weights[first]
            self.tables.append((keys, at, weight))
            rest = np.setdiff1d(np.arange(len(hashes)), first)
            hashes, ids, weights = hashes[rest], ids[rest], weights[rest]
        self._clear()

    def _clear(self) -> None:
        self.index: dict[str, int] = {}
        self.base = np.empty(0, np.int64)  # first node of each word
        self.size = np.empty(0, np.int64)  # characters of each word
        self.first = np.empty(0, np.int64)  # first edge into each node
        self.share = np.empty(0)  # edges by their end node: cumulated shares of the node's weight, the last is 2
        self.prev = np.empty(0, np.int64)  # node the edge comes from
        self.id = np.empty(0, np.int64)  # piece

    def _find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece and weight of each hash; -1 and 0 where there is none."""
        slot = (hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        keys, at, weight = self.tables[0]
        same = keys[slot] == hashes
        ids, w = np.where(same, at[slot], -1), np.where(same, weight[slot], 0.0)
        for keys, at, weight in self.tables[1:]:
            same = keys[slot] == hashes
            ids[same], w[same] = at[slot[same]], weight[slot[same]]
        return ids, w

    def _learn(self, words: list[str]) -> None:
        """Forward pass over the lattices of ``words`` together, one character place after the other."""
        size = np.array([len(w) for w in words])
        chars = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.uint64)
        n = len(chars)
        word = np.repeat(np.arange(len(words)), size)
        close = np.cumsum(size)
        left = close[word] - np.arange(n)  # characters from here to the word's end
        base = close - size + np.arange(len(words))  # first node: a word has one more node than characters
        node = np.arange(n) + word  # node before each character
        h = np.zeros(n, np.uint64)
        weight, begin, end, ids = [], [], [], []
        by_length = np.zeros((min(self.longest, int(size.max())) + 1, n))
        with np.errstate(over="ignore"):
            for k in range(1, len(by_length)):
                at = np.flatnonzero(left >= k)
                h[at] = (h[at] + chars[at + k - 1] + np.uint64(1)) * MULTIPLIER
                got, w = self._find(h[at])
                if k == 1:
                    alone = np.flatnonzero(got < 0)  # spelt in bytes
                    code = chars[at[alone]].astype(np.int64)
                    got[alone] = np.where(code < 128, np.array(self.byte_id)[code & 127], SPELT + code)
                    w[alone] = self.spelt
                there = got >= 0
                at, got, w = at[there], got[there], w[there]
                by_length[k, at] = w
                weight.append(w), begin.append(node[at]), end.append(node[at] + k), ids.append(got)
        alpha = np.zeros(n + len(words))
        alpha[base] = 1.0
        live, scale = np.arange(len(words)), np.zeros(n + len(words))
        for t in range(1, int(size.max()) + 1):
            live = live[size[live] >= t]
            to, char = base[live] + t, close[live] - size[live] + t
            total = np.zeros(len(live))
            for k in range(1, min(t, len(by_length) - 1) + 1):
                # weights of long words are kept in range by a power of two that their nodes carry
                total += alpha[to - k] * by_length[k, char - k] * np.exp2(scale[to - k] - scale[to - 1])
            _, power = np.frexp(total)
            alpha[to], scale[to] = np.ldexp(total, -power), scale[to - 1] + power
        begin, end, weight, ids = (np.concatenate(x) for x in (begin, end, weight, ids))
        order = np.argsort(end, kind="stable")
        begin, end, weight, ids = begin[order], end[order], weight[order], ids[order]
        share = alpha[begin] * weight / alpha[end] * np.exp2(scale[begin] - scale[end])
        run = np.cumsum(share)
        opens = np.flatnonzero(np.append(True, end[1:] != end[:-1]))
        counts = np.diff(np.append(opens, len(end)))
        within = run - np.repeat(run[opens] - share[opens], counts)
        within[np.append(opens[1:], len(end)) - 1] = 2.0
        first = np.zeros(n + len(words), np.int64)
        first[end[opens]] = opens
        nodes, edges, known = len(self.first), len(self.share), len(self.base)
        self.index.update(zip(words, range(known, known + len(words))))
        self.base, self.size = np.append(self.base, base + nodes), np.append(self.size, size)
        self.first = np.append(self.first, first + edges)
        self.share, self.prev, self.id = np.append(self.share, within), np.append(self.prev, begin + nodes), np.append(self.id, ids)

    def sample(self, texts: list[str], keys: np.ndarray) -> list[np.ndarray]:
        """Sampled piece ids of each text (empty text: none); a space is put in front, as decoders expect."""
        if len(self.share) > KEPT_EDGES:
            self._clear()
        words: list[str] = []
        count = np.zeros(len(texts), np.int64)
        for i, t in enumerate(texts):
            if t:
                found = self.words.findall(" " + t)
                count[i] = len(found)
                words += found
        fresh = sorted(set(words).difference(self.index), key=len)
        total = np.cumsum([len(w) for w in fresh])
        for part in np.split(np.arange(len(fresh)), np.flatnonzero(np.diff(total // LEARNT)) + 1):
            if len(part):
                self._learn(fresh[part[0] : part[-1] + 1])
        at = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        base, size = self.base[at], self.size[at]
        owner = np.repeat(np.arange(len(texts)), count)
        end = np.cumsum(size)
        text_first = np.zeros(len(texts) + 1, np.int64)
        text_first[1:] = np.cumsum(np.bincount(owner, size, len(texts)).astype(np.int64))
        shift = end - size - text_first[owner] - base  # from a node to its place in the text
        key = keys.astype(np.uint64)[owner]
        node, live, drawn = base + size, np.arange(len(at)), []
        while len(live):
            now = node[live]
            u = uniform(key[live], (shift[live] + now).astype(np.uint64))
            edge = self.first[now]
            look = np.flatnonzero(self.share[edge] <= u)
            while len(look):
                edge[look] += 1
                look = look[self.share[edge[look]] <= u[look]]
            drawn.append((live, self.id[edge]))
            now = self.prev[edge]
            node[live] = now
            live = live[now > base[live]]
        steps = np.zeros(len(at), np.int64)
        for who, _ in drawn:
            steps[who] += 1
        close = np.cumsum(steps)
        flat = np.empty(int(close[-1]) if len(close) else 0, np.int64)
        for k, (who, got) in enumerate(drawn):  # drawn from the end of each word
            flat[close[who] - 1 - k] = got
        bounds = np.cumsum(np.bincount(owner, steps, len(texts)).astype(np.int64))[:-1]
        return [self._spell(x) for x in np.split(flat, bounds)]

    def _spell(self, ids: np.ndarray) -> np.ndarray:
        if not len(ids) or ids.max() < SPELT:
            return ids.astype("<u4")
        out: list[int] = []
        for i in ids.tolist():
            out.extend([i] if i < SPELT else [self.byte_id[b] for b in chr(i - SPELT).encode()])
        return np.array(out, "<u4")

    def decode(self, ids) -> str:
        """The text of piece ids: the inverse of :meth:`sample`."""
        return b"".join([self.bytes_of[i] for i in ids])[1:].decode()


def _hash(piece: str) -> int:
    h = 0
    for c in piece:
        h = (h + ord(c) + 1) * int(MULTIPLIER) & (2**64 - 1)
    return h


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit hash (the finaliser of SplitMix64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def row_keys(ids: list[int | None], seed: int = SEED) -> np.ndarray:
    raw = np.array([(0x5DEECE66D if i is None else i) & (2**64 - 1) for i in ids], np.uint64)
    with np.errstate(over="ignore"):
        return mix(raw + np.uint64(0x9E3779B97F4A7C15) * np.uint64(seed + 1))


def uniform(key: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Uniform in [0, 1) from a row's key and a place in its text."""
    with np.errstate(over="ignore"):
        return (mix(key + np.uint64(0x9E3779B97F4A7C15) * (place + np.uint64(1))) >> np.uint64(11)) * (1 - 1e-6) * 2.0**-53


def model_path(name: str = MODEL) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


_open: dict[tuple[str, float], Lattices] = {}


def lattices(path: str, temperature: float = TEMPERATURE) -> Lattices:
    if (path, temperature) not in _open:
        _open[path, temperature] = Lattices(path, temperature)
    return _open[path, temperature]


def _sampled(batches, path: str, temperature: float, seed: int):
    """(Arrow rows, their texts, their ids), a bounded number of characters at a time."""
    for b, texts in text_batches(batches):
        keys, model = row_keys(b.column(0).to_pylist(), seed), lattices(path, temperature)
        first = size = 0
        for i, t in enumerate(texts):
            size += len(t)
            if size >= CHARS or i == len(texts) - 1:
                yield b.slice(first, i + 1 - first), texts[first : i + 1], model.sample(texts[first : i + 1], keys[first : i + 1])
                first, size = i + 1, 0


def encode(docs: DataFrame, path: str | None = None, temperature: float = TEMPERATURE, seed: int = SEED) -> DataFrame:
    """(doc_id, ids): a sampled segmentation of every text, reproducible by doc_id.

    Null and empty text: no ids. A null doc_id has a key of its own; rows of one
    doc_id draw alike. Other columns are not read. Empty table: no rows.
    """
    path = path or model_path()

    def run(batches):
        for b, _, ids in _sampled(batches, path, temperature, seed):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x.astype("i4") for x in ids], pa.list_(pa.int32()))], names=["doc_id", "ids"])

    prepare(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, text) of (doc_id, ids); no or null ids give the empty text."""
    path = path or model_path()

    def run(batches):
        model = lattices(path)
        for b in batches:
            texts = [model.decode(x) if x else "" for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    prepare(encoded.sparkSession)
    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


DIGEST = "doc_id long, n_pieces long, ids_crc32 long, decoded_sha256 string, lossless boolean"


def digests(docs: DataFrame, path: str | None = None, temperature: float = TEMPERATURE, seed: int = SEED) -> DataFrame:
    """Per document: the number and checksum (unsigned, little-endian 32-bit ids)
    of its sampled pieces, the SHA-256 of what they decode to, and whether that is the text."""
    path = path or model_path()

    def run(batches):
        for b, texts, ids in _sampled(batches, path, temperature, seed):
            model = lattices(path, temperature)
            back = [model.decode(x.tolist()) for x in ids]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0),
                    pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([zlib.crc32(x) for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(t.encode()).hexdigest() for t in back]),
                    pa.array([t == u for t, u in zip(texts, back)]),
                ],
                names=[f.split()[0] for f in DIGEST.split(", ")],
            )

    prepare(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, DIGEST)


def op3_pieces(spark, sf_dir) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))

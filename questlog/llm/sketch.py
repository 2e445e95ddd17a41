"""Document fingerprints: threshold-scaled sketches of word shingles.

Every hash of a text's five-word shingles that falls below a fixed fraction of
the hash range is kept, so a sketch grows with its text, sketches of parts
merge into the sketch of the whole, and the containment of a short text in a
long one is estimated as well as that of equals. Texts too short for the
fraction keep their lowest hashes besides, which makes short sketches exact;
the highest hash up to which a sketch is complete (its reach) is kept with it,
and two sketches are compared up to the smaller reach.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks_for, ordered_blocks, prepare, table

WORDS = 5
FRACTION = 1 / 8
LEAST = 64
SEED = 42
ALL = 2**64 - 1  # the reach of a sketch that holds every hash


def shingle_hashes(text: str, words: int = WORDS) -> np.ndarray:
    """Distinct sorted hashes (XXH64) of ``text``'s shingles: lower-cased A-Z,
    words separated by ASCII white space; fewer words are one shingle."""
    w = text.encode().lower().split()
    if not w:
        return np.empty(0, np.uint64)
    joined, h = b" ".join(w), xxhash.xxh64_intdigest
    if len(w) <= words:
        return np.array([h(joined, SEED)], np.uint64)
    size = np.fromiter(map(len, w), np.int64, len(w))
    end = np.cumsum(size + 1) - 1
    begin = (end - size)[: 1 - words].tolist()
    return np.unique(np.array([h(joined[a:b], SEED) for a, b in zip(begin, end[words - 1 :].tolist())], np.uint64))


def sketch(hashes: np.ndarray, fraction: float = FRACTION, least: int = LEAST) -> tuple[np.ndarray, int]:
    """The kept part of sorted ``hashes`` and its reach."""
    limit = int(fraction * 2**64)
    n = int(np.searchsorted(hashes, np.uint64(limit), "right"))
    if n >= least:
        return hashes[:n], limit
    if len(hashes) <= least:
        return hashes, ALL
    return hashes[:least], int(hashes[least - 1])


def merge(a: tuple[np.ndarray, int], b: tuple[np.ndarray, int]) -> tuple[np.ndarray, int]:
    """The sketch of two parts together, complete up to the smaller reach."""
    reach = min(a[1], b[1])
    both = np.union1d(a[0], b[0])
    return both[both <= np.uint64(reach)], reach


def containment(a: tuple[np.ndarray, int], b: tuple[np.ndarray, int]) -> tuple[float, float]:
    """Estimated shares of ``a`` in ``b`` and of ``b`` in ``a``; two empty texts are alike."""
    reach = np.uint64(min(a[1], b[1]))
    x, y = a[0][: np.searchsorted(a[0], reach, "right")], b[0][: np.searchsorted(b[0], reach, "right")]
    if not len(a[0]) and not len(b[0]):
        return 1.0, 1.0
    common = len(np.intersect1d(x, y, assume_unique=True))
    return (common / len(x) if len(x) else 0.0), (common / len(y) if len(y) else 0.0)


def likeness(a: tuple[np.ndarray, int], b: tuple[np.ndarray, int]) -> float:
    """Estimated share of shingles that two texts have in common (Jaccard), 0 to 1."""
    if not len(a[0]) and not len(b[0]):
        return 1.0
    reach = np.uint64(min(a[1], b[1]))
    x, y = a[0][: np.searchsorted(a[0], reach, "right")], b[0][: np.searchsorted(b[0], reach, "right")]
    common = len(np.intersect1d(x, y, assume_unique=True))
    union = len(x) + len(y) - common
    return common / union if union else 0.0


def as_text(s: tuple[np.ndarray, int]) -> str:
    """Reach and hashes as 16 hex digits each."""
    return s[1].to_bytes(8, "big").hex() + s[0].astype(">u8").tobytes().hex()


def from_text(s: str) -> tuple[np.ndarray, int]:
    raw = bytes.fromhex(s)
    return np.frombuffer(raw[8:], ">u8").astype(np.uint64), int.from_bytes(raw[:8], "big")


def edited(text: str, following: str) -> str:
    """``text`` with its last floor(n/2) code points replaced by the first as many of ``following``."""
    k = len(text) // 2
    return text[: len(text) - k] + following[:k]


FIELDS = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _neighbours(batches):
    """Compare each document of a sorted block with the one after it; holds one document."""
    names = [f.split()[0] for f in FIELDS.split(", ")]
    held = None  # (block, role, doc_id, text, sketch)
    for b in batches:
        out = []
        get = lambda name: b.column(b.schema.get_field_index(name)).to_pylist()  # noqa: E731, B023
        for block, role, doc_id, text in zip(get("_block"), get("_role"), get("doc_id"), get("text")):
            text = text or ""
            now = (block, role, doc_id, text, sketch(shingle_hashes(text)))
            if held and held[0] == block and held[1] == 0:
                _, _, last_id, last, own = held
                changed = edited(last, text)
                other = sketch(shingle_hashes(changed))
                out.append(
                    (
                        last_id, len(last), hashlib.sha256(changed.encode()).hexdigest(), as_text(own), as_text(other),
                        likeness(own, other), likeness(own, now[4]),
                    )
                )
            held = now
        columns = zip(*out) if out else [[]] * len(names)
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def neighbour_sketches(docs: DataFrame) -> DataFrame:
    """Per document: its sketch, and its likeness to its edited text and to the
    document after it (ascending doc_id; after the last comes the first).

    Null text: empty. A null doc_id comes first. Rows of one doc_id are ordered
    by their text's hash. A text without words has an empty sketch, alike only
    to another such. Other columns are not read. Empty table: no rows.
    """
    prepare(docs.sparkSession)
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tie"))
    rows = ordered_blocks(narrow, ["doc_id"], blocks_for(narrow), ("tie",)).where("_role >= 0").select("_block", "_role", "doc_id", "text")
    return rows.mapInArrow(_neighbours, FIELDS)


def op8_sketch(spark, sf_dir) -> DataFrame:
    return neighbour_sketches(table(spark, sf_dir, "documents"))

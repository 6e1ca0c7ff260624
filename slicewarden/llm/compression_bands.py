"""Quality rules: base counts per text and zstandard compression bands.

A whole text and chunks of it of two lengths are compressed with zstandard.
Chunks overlap by half, and the last one ends with the text, so a stretch of
noise cannot hide across a border.  The share ``compressed / raw`` is low for repetitive text and high for noise; both
depend on the length (short texts hold little to repeat, and carry the frame
header), so each length band has its own lower limit, and the upper limit
follows the length.

Defined cases: a null or empty text has no words, fails the base rule and is
not kept.  A text no longer than a chunk is judged as a whole only.  Columns of the input that clash with an output name are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slicewarden.llm.common import bound_batches, utf8

SCHEMA = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, ratio double, min_chunk_ratio double, max_chunk_ratio double, kept boolean")
_FIELDS = pa.struct([
    ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()),
    ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()), ("ratio", pa.float64()),
    ("min_chunk_ratio", pa.float64()), ("max_chunk_ratio", pa.float64()), ("kept", pa.bool_()),
])
SYMBOLS = b"[#*$%&|<>]"[1:-1]
SPACES = b" \t\n\x0b\x0c\r"
WINDOW = 8


@dataclass(frozen=True)
class Bands:
    """Limits of the share compressed / raw.

    ``whole``: (shortest length in bytes, lower limit, upper limit).  The lower
    limit of the last length reached counts; between two lengths the upper limit
    is interpolated over the length's logarithm.  ``chunks``: (length in bytes,
    step, lower limit, upper limit) of the chunks that every longer text is cut
    into; one chunk outside its limits rejects the text.

    Upper limits lie between measured shares (level 3) of prose and of noise.
    Prose of sf0.1 reached 0.855 at 200 bytes and 0.604 at 1,024, where base64
    started at 0.94 and random lower-case letters at 0.631.  Chunks of about 300
    real texts (licenses, manuals, package descriptions) had a 99% share and a
    greatest share of 0.628 and 0.674 at 1,024 bytes, 0.557 and 0.606 at 2,048,
    0.508 and 0.532 at 4,096; random lower-case letters 0.632, 0.614 and 0.604,
    base64 0.788, 0.764 and 0.753.  So single chunks of 1,024 bytes only rule out
    denser noise, and letters are told apart over 2,048 bytes and more.  Below
    about 750 bytes the shares of random letters and of prose overlap.
    """

    whole: tuple[tuple[int, float, float], ...] = (
        (0, 0.0, 9.9), (95, 0.0, 9.9), (96, 0.0, 1.094), (128, 0.25, 0.99), (160, 0.25, 0.93), (200, 0.25, 0.895),
        (256, 0.22, 0.87), (300, 0.22, 0.845), (400, 0.22, 0.80), (512, 0.20, 0.76), (640, 0.20, 0.69),
        (768, 0.20, 0.64), (900, 0.20, 0.629), (1024, 0.18, 0.622), (1536, 0.18, 0.605), (2048, 0.18, 0.595),
        (4096, 0.14, 0.575), (8192, 0.14, 0.56), (16384, 0.08, 0.56))
    chunks: tuple[tuple[int, int, float, float], ...] = (
        (4096, 2048, 0.08, 0.575), (2048, 512, 0.0, 0.588), (1024, 512, 0.0, 0.70))
    level: int = 3

    @property
    def chunk(self) -> tuple[float, float]:
        """Limits of the longest chunks, whose least and greatest share are reported."""
        return self.chunks[0][2:]

    def limits(self, n: int) -> tuple[float, float]:
        at = max(i for i, (least, _, _) in enumerate(self.whole) if n >= least)
        least, lo, hi = self.whole[at]
        if at + 1 < len(self.whole) and least:
            after, _, to = self.whole[at + 1]
            hi += (to - hi) * math.log(n / least) / math.log(after / least)
        return lo, hi


def chunks(data: bytes, size: int, step: int) -> list[bytes]:
    """Chunks that begin ``step`` bytes apart, the last one taken from the end;
    none of a text no longer than one chunk."""
    if len(data) <= size:
        return []
    return [data[i:i + size] for i in [*range(0, len(data) - size, step), len(data) - size]]


def repeat_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside ``window``-word windows that occur twice or more.

    Windows get exact ids by doubling: the id of 2 words from two word ids, of
    4 from two pairs, of 8 from two fours; other window lengths add words one
    by one.  No hash, so no false match.
    """
    n = len(words) - window + 1
    if n < 2:
        return 0
    seen: dict[bytes, int] = {}
    one = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    if len(seen) == len(words):
        return 0
    ids, have = one, 1
    while have < window:
        step = have if 2 * have <= window else 1
        right = ids if step == have else one
        m = len(ids) - step
        pair = ids[:m] * np.int64(len(words) + 1) + right[have:have + m]
        _, ids, counts = np.unique(pair, return_inverse=True, return_counts=True)
        have += step
        if counts.max() < 2:
            return 0
    hit = np.flatnonzero(counts[ids] > 1)
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, hit, 1)
    np.add.at(cover, hit + window, -1)
    return int((np.cumsum(cover[:-1]) > 0).sum())


def measure(data: bytes, bands: Bands, packer) -> tuple:
    """One text's row of ``SCHEMA``."""
    words = data.split()
    bytes_seen = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    code_points = len(data) - int(bytes_seen[0x80:0xC0].sum())
    word_chars = code_points - int(bytes_seen[list(SPACES)].sum())
    n_symbols = int(bytes_seen[list(SYMBOLS)].sum())
    lines: set[bytes] = set()
    n_lines = 0
    for line in data.split(b"\n"):
        if line.strip():
            n_lines += 1
            lines.add(line)
    repeats = repeat_words(words)
    failed = len(words) < 20 or 100 * repeats > 30 * len(words)
    ratio = low = high = None
    kept = not failed
    if data:
        ratio = len(packer.compress(data)) / len(data)
        lo, hi = bands.limits(len(data))
        kept = kept and lo <= ratio <= hi
        for k, (size, step, least, most) in enumerate(bands.chunks):
            shares = [len(packer.compress(part)) / len(part) for part in chunks(data, size, step)]
            if shares:
                kept = kept and least <= min(shares) and max(shares) <= most
                if not k:
                    low, high = min(shares), max(shares)
    return (len(words), word_chars, n_symbols, n_lines - len(lines), repeats, failed, ratio, low, high, kept)


def quality_rules(df: DataFrame, text_col: str = "text", bands: Bands | None = None) -> DataFrame:
    """``df`` with the columns of ``SCHEMA`` for each row's whole text."""
    bands = bands or Bands()
    bound_batches(df.sparkSession)

    @F.arrow_udf(SCHEMA)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import zstandard

        packer = zstandard.ZstdCompressor(level=bands.level)
        for texts in batches:
            rows = [measure(t.as_buffer().to_pybytes(), bands, packer) for t in texts]
            cols = list(zip(*rows)) if rows else [()] * len(_FIELDS)
            yield pa.StructArray.from_arrays(
                [pa.array(c, f.type) for c, f in zip(cols, _FIELDS)], fields=list(_FIELDS))

    out = [f.name for f in _FIELDS]
    kept = [c for c in df.columns if c not in out and c != "_measured"]
    done = df.withColumn("_measured", run(utf8(F.col(text_col))))
    return done.select(*kept, *[F.col(f"_measured.{c}").alias(c) for c in out])

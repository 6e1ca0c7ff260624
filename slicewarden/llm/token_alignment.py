"""Cross-tokenizer alignment through white-space anchors.

Every whole text is tokenised by two tokenizers, A and B.  Byte offsets where
tokens of both end cut the tokens into groups.  Shared ends before a
space-marked token are anchors: they are verified on the byte offsets, never
assumed, and split a document into windows.  What happens inside a window
depends on its two tuples of ids alone, so a chunk's windows are reduced to the
distinct tuples, each of those is aligned once, and every occurrence takes its
alignment from there.

Corpus-wide link counts take three steps.  Tasks align chunks of documents of
bounded size and write a row for each chunk: its documents, its distinct
windows and its distinct id pairs.  Pairs are summed over the corpus and ranked
per B id.  Each chunk's pairs then meet their sums, and the chunk's documents
add them up window by window.  Rows that move are a chunk's distinct pairs, not
the corpus's links, and no table of pairs is broadcast or collected.

Defined cases: texts that are null, empty, not UTF-8, or whose joined token
bytes differ from a space and the text (a tokenizer normalised them) have no
tokens: zeros and empty groups.  Null ids and repeated rows each get a row; an
empty table gives an empty result.  Very long texts are handed to a tokenizer
in parts cut between ASCII words, where neither joins tokens.  Only the id
and the text are read, so other columns may have any name.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slicewarden.llm.common import stored, utf8

CHUNK_BYTES = 2 << 20            # text of a chunk, one longer document apart
PART_CHARS = 1 << 19             # text handed to a tokenizer at once
CUT = re.compile(r"(?<=[0-9A-Za-z]) (?=[0-9A-Za-z])")


# -- tokenizers ----------------------------------------------------------------

def byte_letters() -> dict[str, int]:
    """Letter of each byte in byte-level vocabularies: printable Latin-1
    bytes stand for themselves, the others follow from code point 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


@dataclass
class Tool:
    """A loaded tokenizer: ``encode`` takes texts whose leading space is
    implied, ``table`` has each id's bytes."""

    encode: object
    table: list[bytes]

    def __post_init__(self):
        self.size = np.array([len(t) for t in self.table], np.int64)
        self.spaced = np.array([t[:1] == b" " for t in self.table])
        self.flat = np.frombuffer(b"".join(self.table), np.uint8)
        self.at = np.cumsum(self.size) - self.size
        width = len(str(len(self.table)))
        # Each id's decimal digits and a comma, filled up with zero bytes.
        self.digits = np.array([b"%d," % k for k in range(len(self.table))], f"S{width + 1}").view(np.uint8).reshape(
            len(self.table), width + 1)
        self.comma = (self.digits > 0).sum(1) - 1


# Fixed value: how byte-level vocabularies of this kind split texts.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Letters, digits and white space that every Unicode version knows alike.
COMMON = re.compile("[\x00-\u024f\u2010-\u2027]*")


def _ranked(path: str, table: list[bytes], special: set[int]):
    """A faster encoder over the same vocabulary for texts of common letters,
    if ids follow the order of the merges and texts are split by ``SPLIT``;
    None if not."""
    import json

    from tiktoken import Encoding

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    split, merges = spec.get("pre_tokenizer") or {}, spec["model"].get("merges") or []
    vocab = spec["model"]["vocab"]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
    order = [vocab.get(x + y, -1) for x, y in pairs]
    ranks = {t: k for k, t in enumerate(table) if k not in special}
    if (spec.get("normalizer") or split.get("type") != "ByteLevel" or split.get("add_prefix_space")
            or not split.get("use_regex", True) or order != sorted(set(order)) or order[:1] == [-1]
            or any(bytes([x]) not in ranks for x in range(256))
            or len(ranks) != len(order) + 256 or ranks.keys() & {b""}):
        return None
    return Encoding("ranked", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})


def _byte_bpe(path: str) -> Tool:
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.encode_special_tokens = True
    tok.no_truncation()
    tok.no_padding()
    letters, table = byte_letters(), [b""] * tok.get_vocab_size()
    for entry, k in tok.get_vocab().items():
        known = all(c in letters for c in entry)
        table[k] = bytes(letters[c] for c in entry) if known else entry.encode()
    fast = _ranked(path, table, set(tok.get_added_tokens_decoder()))

    def encode(texts: list[str]) -> list:
        out = [fast.encode_to_numpy(" " + t, disallowed_special=()) if fast and (t.isascii() or COMMON.fullmatch(t)) else None for t in texts]
        rest = [k for k, ids in enumerate(out) if ids is None]
        for k, e in zip(rest, tok.encode_batch_fast([" " + texts[k] for k in rest], add_special_tokens=False)):
            out[k] = e.ids
        return out

    return Tool(encode, table)


def _pieces(path: str) -> Tool:
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=path)
    table = [bytes([int(sp.id_to_piece(k)[1:-1], 16)]) if sp.is_byte(k)
             else sp.id_to_piece(k).replace("▁", " ").encode() for k in range(sp.get_piece_size())]
    return Tool(lambda texts: sp.encode(texts, num_threads=1), table)


LOADERS = {"byte_bpe": _byte_bpe, "pieces": _pieces}


@lru_cache(maxsize=4)
def load(kind: str, path: str) -> Tool:
    return LOADERS[kind](path)


def parts(text: str) -> list[str]:
    """The text cut before spaces between ASCII words, at least ``PART_CHARS``
    apart; the space that starts a part is left out, as before the text."""
    out, at = [], 0
    while len(text) - at > PART_CHARS and (m := CUT.search(text, at + PART_CHARS)):
        out.append(text[at:m.start()])
        at = m.end()
    return [*out, text[at:]]


def token_ids(tool: Tool, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All ids of the UTF-8 texts, each after a space, and their number in each
    text; none where a text is empty or not UTF-8."""
    found, count = [], np.zeros(len(texts), np.int64)
    wait, size = [], 0

    def flush():
        for k, ids in zip([k for k, _ in wait], tool.encode([p for _, p in wait]) if wait else []):
            found.append(np.asarray(ids, np.int32))
            count[k] += len(ids)
        wait.clear()

    for k, data in enumerate(texts):
        try:
            text = data.decode()
        except UnicodeDecodeError:
            continue
        for p in parts(text) if text else []:
            wait.append((k, p))
            size += len(p)
            if size >= PART_CHARS:
                flush()
                size = 0
    flush()
    return np.concatenate([np.zeros(0, np.int32), *found]), count


def _sums(values: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Sums of consecutive stretches of ``count`` values."""
    upto, end = np.concatenate([[0], np.cumsum(values, dtype=np.int64)]), np.cumsum(count)
    return upto[end] - upto[end - count]


def _ragged(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its length, end to end."""
    return np.arange(length.sum()) + np.repeat(start - (np.cumsum(length) - length), length)


def verified(texts: list[bytes], tools) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """Which texts both tokenizers give back byte by byte, a space before
    them, and their ids and numbers of ids in A and in B."""
    ids, count = (list(x) for x in zip(*[token_ids(t, texts) for t in tools]))
    size = np.array([len(t) + 1 for t in texts], np.int64)
    live = np.logical_and.reduce([(n > 0) & (_sums(t.size[i], n) == size) for t, i, n in zip(tools, ids, count)])
    for s in (0, 1):
        ids[s], count[s] = ids[s][np.repeat(live, count[s])], count[s][live]
    want = np.frombuffer(b" ".join([b"", *[t for t, ok in zip(texts, live) if ok]]), np.uint8)
    same = np.ones(int(live.sum()), bool)
    for t, i in zip(tools, ids):
        same &= _sums(t.flat[_ragged(t.at[i], t.size[i])] != want, size[live]) == 0
    for s in (0, 1):
        ids[s], count[s] = ids[s][np.repeat(same, count[s])], count[s][same]
    live[live] = same
    return live, ids, count


# -- alignment -----------------------------------------------------------------

def _marks(sides, tools) -> tuple[list[np.ndarray], np.ndarray]:
    """Ends of the tokens of A and of B in bytes, and for each byte offset 1 if
    a token of A ends there plus 2 if one of B does."""
    ends = [np.cumsum(t.size[i]) for t, i in zip(tools, sides)]
    mark = np.zeros(int(ends[0][-1]) + 1, np.uint8)
    mark[ends[0]] = 1
    mark[ends[1]] += 2
    return ends, mark


def align_windows(sides, tools) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Alignment of windows laid end to end, each over the same bytes in A and
    B: the text of each window's groups, each closed by ``;``, its number of
    links, and all links (A id << 32 | B id).  ``sides`` has the ids of A and of
    B and the windows' ends in them."""
    (a, stop_a), (b, stop_b) = sides
    ends, mark = _marks((a, b), tools)
    # Each stretch between two neighbouring ends lies in one token of A and one of B: a link.
    at = np.flatnonzero(mark)
    is_a, is_b = (mark[at] & 1).astype(np.int64), (mark[at] >> 1).astype(np.int64)
    of_a, of_b = np.cumsum(is_a) - is_a, np.cumsum(is_b) - is_b
    links = a[of_a].astype(np.int64) << 32 | b[of_b]
    n_links = np.diff(np.flatnonzero(is_a)[stop_a - 1], prepend=-1)
    # Groups end where both do; A's ids of a group come before B's.
    closes = (is_a & is_b) > 0
    last_a, last_b = of_a[closes], of_b[closes]
    n_a, n_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
    place_a = np.arange(len(a)) + np.repeat(np.cumsum(n_b) - n_b, n_a)
    place_b = np.arange(len(b)) + np.repeat(np.cumsum(n_a), n_b)
    width = max(t.digits.shape[1] for t in tools)
    letters = np.zeros((len(a) + len(b), width), np.uint8)
    for ids, place, last, tool, close in ((a, place_a, last_a, tools[0], b"|"), (b, place_b, last_b, tools[1], b";")):
        letters[place, :tool.digits.shape[1]] = tool.digits[ids]
        letters[place[last], tool.comma[ids[last]]] = close[0]
    used = letters > 0
    whole, cut = letters[used].tobytes(), np.cumsum(used.sum(1))[stop_a + stop_b - 1].tolist()
    return [whole[lo:hi] for lo, hi in zip([0, *cut], cut)], n_links, links


def anchors(sides, tools) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Window ends, as token counts of A and of B, and the tokens of A that
    close a group.  Texts lie end to end; each begins with a space, so an anchor
    ends each."""
    ends, mark = _marks(sides, tools)
    shared = np.flatnonzero(mark[ends[0]] == 3)                       # verified: a token of B ends there too
    spaced = np.append(tools[0].spaced[sides[0][1:]], True)[shared]   # the next token is marked by a space
    of_b = np.cumsum(mark >> 1, dtype=np.int64)[ends[0][shared[spaced]]]
    return shared[spaced] + 1, of_b, shared


def _mixed(ids: np.ndarray, place: np.ndarray, side: int) -> np.ndarray:
    x = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + place.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03)
    x += np.uint64(side)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(31))


def distinct_windows(sides) -> tuple[np.ndarray, np.ndarray]:
    """Number of each window among the distinct ones, and a window with each
    number.  ``sides``: ids, window starts and window lengths of A and of B.
    Windows meet by a hash; each is then compared with the one it was taken for."""
    n = len(sides[0][1])
    total = np.zeros(n, np.uint64)
    for k, (ids, start, length) in enumerate(sides):
        total += np.add.reduceat(_mixed(ids, np.arange(len(ids)) - np.repeat(start, length), k + 1), start)
    _, first, codes = np.unique(total, return_index=True, return_inverse=True)
    for ids, start, length in sides:
        like = first[codes]
        if not (length == length[like]).all() or not (
                ids == ids[np.arange(len(ids)) + np.repeat(start[like] - start, length)]).all():
            keys = [tuple(ids[s:s + m].tobytes() for ids, start, length in sides for s, m in [(start[w], length[w])])
                    for w in range(n)]                                         # two windows with one hash
            seen: dict = {}
            codes = np.array([seen.setdefault(k, len(seen)) for k in keys])
            first = np.zeros(len(seen), np.int64)
            first[codes[::-1]] = np.arange(n)[::-1]
            return codes, first
    return codes, first


def align_chunk(texts: list[bytes], tool_a: Tool, tool_b: Tool, digest: bool) -> dict:
    """Columns of a chunk's row for ``texts``."""
    tools, n = (tool_a, tool_b), len(texts)
    out = {c: np.zeros(n, np.int64) for c in ("n_a", "n_b", "n_groups", "n_links")}
    out |= {c: np.zeros(0, np.int64) for c in ("windows", "times", "window_links", "links", "pairs", "pair_times")}
    out |= {"doc_windows": np.zeros(n, np.int64), "groups": [""] * n}
    has, ids, count = verified(texts, tools)
    live = np.flatnonzero(has)
    if not len(live):
        return out
    *stops, closes = anchors(ids, tools)
    sides = [(i, np.concatenate([[0], stop[:-1]]), np.diff(stop, prepend=0)) for i, stop in zip(ids, stops)]
    last = np.cumsum(count[0])
    out["n_a"][live], out["n_b"][live] = count
    out["n_groups"][live] = np.diff(np.searchsorted(closes, last), prepend=0)
    out["n_links"][live] = out["n_a"][live] + out["n_b"][live] - out["n_groups"][live]
    n_windows = np.diff(np.searchsorted(stops[0], last, side="right"), prepend=0)
    codes, first = distinct_windows(sides)

    # The distinct windows, end to end.
    laid = [(i[_ragged(start[first], length[first])], np.cumsum(length[first])) for i, start, length in sides]
    text, out["window_links"], links = align_windows(laid, tools)
    numbers, at = codes.tolist(), 0
    for k, m in zip(live.tolist(), n_windows.tolist()):
        joined = b"".join([text[c] for c in numbers[at:at + m]])[:-1]
        out["groups"][k] = hashlib.sha256(joined).hexdigest() if digest else joined.decode()
        at += m
    of_doc = np.repeat(np.arange(len(live)), n_windows)
    # Which windows a document holds, and how often.
    held, out["times"] = np.unique(of_doc * len(first) + codes, return_counts=True)
    out["windows"] = held % len(first)
    out["doc_windows"][live] = np.bincount(held // len(first), minlength=len(live))
    times = np.bincount(codes, minlength=len(first))
    out["pairs"], out["links"] = np.unique(links, return_inverse=True)
    out["pair_times"] = np.zeros(len(out["pairs"]), np.int64)
    np.add.at(out["pair_times"], out["links"], np.repeat(times, out["window_links"]))
    return out


# -- over the corpus -------------------------------------------------------------

CHUNK = {"ids": None, "n_a": "long", "n_b": "long", "n_groups": "long", "n_links": "long", "groups": "string",
         "pairs": "long", "pair_times": "long"}
KINDS = {"long": pa.int64(), "string": pa.string()}
# Columns with a number for each window or link: only Python reads them, so they move as one value of bytes.  As
# arrays they would be megabytes a row, copied again by every reader, writer and sort of the executor's heap.
PACKED = ("doc_windows", "windows", "times", "window_links", "links")


def pack(columns: list[np.ndarray]) -> bytes:
    """Numbers from 0 to 2**32 - 1 as bytes: how many each column has, its size,
    then all first bytes of its numbers, all second ones and so on, compressed."""
    codec, out = pa.Codec("zstd", compression_level=1), []
    for values in columns:
        planes = np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T)
        out.append(codec.compress(planes.tobytes(), asbytes=True))
    sizes = np.array([[len(v), len(c)] for v, c in zip(columns, out)], "<i8")
    return b"".join([sizes.tobytes(), *out])


def unpack(data: bytes, n: int) -> list[np.ndarray]:
    """The ``n`` columns of :func:`pack`."""
    codec, at, out = pa.Codec("zstd"), 16 * n, []
    for length, size in np.frombuffer(data[:at], "<i8").reshape(n, 2).tolist():
        planes = np.frombuffer(codec.decompress(data[at:at + size], 4 * length, asbytes=True), np.uint8)
        out.append(np.ascontiguousarray(planes.reshape(4, length).T).view("<u4").reshape(-1).astype(np.int64))
        at += size
    return out


def chunks(docs: DataFrame, id_col: str, text_col: str, a: tuple[str, str], b: tuple[str, str], digest: bool,
           chunk_bytes: int) -> DataFrame:
    """A row for each chunk of documents of a task."""
    id_type = docs.schema[id_col].dataType.simpleString()
    ddl = "chunk long, " + ", ".join(f"{c} array<{kind or id_type}>" for c, kind in CHUNK.items()) + ", packed binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = load(*a), load(*b)
        ids, texts, size, number = [], [], 0, TaskContext.get().partitionId() << 32

        def row(id_kind):
            cols = align_chunk(texts, *tools, digest) | {"ids": ids}
            arrays = [pa.array([number], pa.int64())]
            for c, kind in CHUNK.items():
                values = pa.array(cols[c], KINDS.get(kind, id_kind))
                arrays.append(pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values))
            arrays.append(pa.array([pack([cols[c] for c in PACKED])], pa.binary()))
            return pa.RecordBatch.from_arrays(arrays, ["chunk", *CHUNK, "packed"])

        for batch in batches:
            id_kind = batch.schema.field(0).type
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids.append(doc)
                texts.append(text.as_buffer().to_pybytes())
                size += len(texts[-1])
                if size >= chunk_bytes:
                    yield row(id_kind)
                    number += 1
                    ids, texts, size = [], [], 0
        if ids:
            yield row(id_kind)

    return docs.select(F.col(id_col).alias("id"), utf8(F.col(text_col)).alias("text")).mapInArrow(run, ddl)


def pair_counts(found: DataFrame) -> DataFrame:
    """(pair, n, best): how many links of the corpus hold an id pair, and
    whether no other pair of its B id has more."""
    each = found.select(F.explode(F.arrays_zip("pairs", "pair_times")).alias("p")).select("p.*")
    counts = stored(each.groupBy(F.col("pairs").alias("pair")).agg(F.sum("pair_times").alias("n"))
                    .withColumn("b", F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))), "pair_counts")
    most = counts.groupBy(F.col("b").alias("of")).agg(F.max("n").alias("most"))
    return counts.join(most, F.col("b") == F.col("of")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def align(docs: DataFrame, a: tuple[str, str], b: tuple[str, str], id_col: str = "doc_id", text_col: str = "text",
          digest: bool = False, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per document: its id, n_a, n_b, n_groups, n_links, n_best,
    count_sum and ``groups`` (``a1,a2|b1;a3|b2,b3``; with ``digest`` their
    SHA-256, so that texts larger than the corpus need not move).  ``a`` and
    ``b`` are (kind, path) of the tokenizers, kinds as in ``LOADERS``."""
    found = stored(chunks(docs, id_col, text_col, a, b, digest, chunk_bytes), "chunks")
    counts = stored(pair_counts(found), "pair_ranks")
    sums = (found.select(F.col("chunk").alias("of"), F.posexplode("pairs").alias("place", "pair")).join(counts, "pair")
            .select("of", "place", "n", "best"))
    keep = found.select("chunk", *[c for c in CHUNK if c not in ("pairs", "pair_times")], "packed")
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType)]
                          + [T.StructField(c, T.LongType()) for c in
                             ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")]
                          + [T.StructField("groups", T.StringType())])

    def add_up(chunk: pa.Table, pairs: pa.Table) -> pa.Table:
        def own(c):
            return chunk.column(c).combine_chunks().flatten()

        packed = dict(zip(PACKED, unpack(chunk.column("packed")[0].as_py(), len(PACKED))))
        place = pairs.column("place").to_numpy()
        of_pair = {c: np.zeros(len(place), np.int64) for c in ("n", "best")}
        for c in of_pair:
            of_pair[c][place] = pairs.column(c).to_numpy().astype(np.int64)
        sums = {}
        start, ends = np.concatenate([[0], np.cumsum(packed["doc_windows"])]), np.cumsum(packed["window_links"])
        for c, values in of_pair.items():
            run = np.concatenate([[0], np.cumsum(values[packed["links"]])])
            of_window = run[ends] - run[ends - packed["window_links"]]
            upto = np.concatenate([[0], np.cumsum(of_window[packed["windows"]] * packed["times"])])
            sums[c] = (upto[start[1:]] - upto[start[:-1]]).astype(np.int64)
        return pa.Table.from_arrays([own("ids"), *[own(c) for c in ("n_a", "n_b", "n_groups", "n_links")],
                                     pa.array(sums["best"]), pa.array(sums["n"]), own("groups")],
                                    names=schema.names)

    return keep.groupBy("chunk").cogroup(sums.groupBy("of")).applyInArrow(add_up, schema)

"""BPE encoding and decoding by a tokenization automaton.

The merges are compiled, one after the other, into a deterministic automaton
over tokens whose paths from the start are exactly the token sequences that
the merges yield.  The automaton starts with one state in which any symbol may
follow any symbol.  The gadget of merge ``(u, v)`` then

* splits the state that ``u`` leads to: its copy has no arc ``v``;
* gives every state with an arc ``u`` an arc ``uv`` to the state of ``v``.

Only the last token decides the state, and a copy inherits the arcs its
original has lost, so a state is stored as (original, lost arc) and an arc is
looked up from two chains (``Automaton.arc``); arcs in use are kept in a
transition table.  Each prefix of a word has exactly one path, so a word is
read by taking the longest arc that leads on and stepping back from positions
that do not; no position fails twice, which bounds the work by word length
times longest token, also for words of a million letters.

Decoding emits the arc labels, joined as the tokenizer file says (no decoder:
by spaces).

Text is cut at ASCII white space, which no token spans, and the pieces' ids are
kept in a bounded table per Python worker.  Defined cases: a null text is
empty; an empty text has no tokens and decodes to the empty text.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from collections.abc import Iterator

import pyarrow as pa
import regex
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slicewarden.llm.common import bound_batches, utf8

MAX_PIECES = 400_000        # pieces kept per worker
MAX_PIECE_BYTES = 64        # longer pieces are not kept
MAX_ARCS = 500_000
MAX_STATES = 5_000


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies:
    printable Latin-1 bytes stand for themselves, the rest for U+0100 onwards."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(b) for b in printable}
    for b in range(256):
        letters.setdefault(b, chr(0x100 + len(letters) - len(printable)))
    return [letters[b] for b in range(256)]


class Automaton:
    """Token automaton built by successive merge gadgets."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], end: str):
        self.vocab, self.end = vocab, end
        self.longest = max(map(len, vocab), default=0)
        self._spell(vocab)
        # State 0 is the start.  A gadget's new state is a copy of original[s]
        # that has lost the arc lost[s]; made_by[s] is the gadget's merge.
        self.original, self.lost, self.made_by = [0], [-1], [-1]
        self.rank: dict[int, int] = {}              # token -> merge that makes it
        self.left: dict[int, int] = {}              # token -> its left part
        self.state: dict[int, int] = {}             # token -> state it leads to
        self.arcs: dict[tuple[int, int], bool] = {}     # the transition table
        self.losses: dict[int, dict[int, int]] = {}
        built = {a + b for a, b in merges}
        if len(built) < len(merges):
            raise ValueError("two merges make one token; the gadgets need one merge per token")
        # Tokens that no arc carries: their merge never applies.
        self.dead: set[int] = set()
        for r, (a, b) in enumerate(merges):
            u, v, uv = vocab[a], vocab[b], vocab[a + b]
            for name, part in ((a, u), (b, v)):
                if name in built and part not in self.rank:
                    raise ValueError(f"merge {r} uses {name!r} before it is made")
            self.rank[uv], self.left[uv] = r, u
            at, target = self.state.get(u, 0), self.state.get(v, 0)
            if {u, v} & self.dead or not self._has_arc(at, v):
                self.dead.add(uv)
                continue
            self.original.append(at)
            self.lost.append(v)
            self.made_by.append(r)
            self.state[u] = len(self.lost) - 1
            self.state[uv] = target

    def _lost_arcs(self, state: int) -> dict[int, int]:
        """Arc -> merge whose gadget took it, for a state and its originals."""
        got = self.losses.get(state)
        if got is None:
            got, at = {}, state
            while at:
                got[self.lost[at]] = self.made_by[at]
                at = self.original[at]
            if len(self.losses) >= MAX_STATES:
                self.losses.clear()
            self.losses[state] = got
        return got

    def _has_arc(self, state: int, token: int) -> bool:
        """The arc ``uv`` came from the arc ``u`` as the state had it when
        merge ``uv`` was compiled: it is missing if ``u`` was lost by then,
        and so on down the left parts, or if it was lost itself later."""
        lost, limit = self._lost_arcs(state), len(self.rank)
        while token is not None:
            if lost.get(token, limit + 1) <= limit:
                return False
            limit = self.rank.get(token, -1)
            token = self.left.get(token)
        return True

    def arc(self, state: int, token: int) -> bool:
        """Whether ``token`` may follow in ``state`` (kept in the table)."""
        key = (state, token)
        got = self.arcs.get(key)
        if got is None:
            if len(self.arcs) >= MAX_ARCS:
                self.arcs.clear()
            got = self.arcs[key] = token not in self.dead and self._has_arc(state, token)
        return got

    def word(self, letters: str) -> list[int]:
        """Token ids of one pre-split word, given in byte letters."""
        n = len(letters)
        if not n:
            return []
        arc, leads = self.arc, self.state
        whole = self.vocab.get(letters + self.end)
        if whole is not None and (n == 1 or whole in self.rank and whole not in self.dead):
            return [whole]      # one arc from the start, and paths are unique
        # Walk the longest arcs first and step back where none leads on.  A
        # prefix has one path, so a position that failed once has failed.
        failed: set[int] = set()
        at, state = 0, 0
        choices = self._choices(letters, 0)
        path: list[tuple[int, int, int, list]] = []     # token, start, state before, choices left
        while True:
            while choices:
                to, t = choices.pop()
                if to not in failed and arc(state, t):
                    break
            else:
                if not path:
                    raise ValueError(f"no path for {letters!r}: a byte symbol is not in the vocabulary")
                failed.add(at)
                _, at, state, choices = path.pop()
                continue
            path.append((t, at, state, choices))
            if to == n:
                return [step[0] for step in path]
            at, state = to, leads.get(t, 0)
            choices = self._choices(letters, at)

    def _spell(self, vocab: dict[str, int]) -> None:
        """Letter tree of the tokens: steps[node][letter] is the next node;
        inner and final hold the token a node spells within and at the end of
        a word."""
        self.steps: list[dict[str, int]] = [{}]
        self.inner, self.final = [-1], [-1]
        cut = len(self.end)
        for token, i in vocab.items():
            is_final = cut > 0 and token.endswith(self.end) and len(token) > cut
            node = 0
            for letter in token[:-cut] if is_final else token:
                nxt = self.steps[node].get(letter)
                if nxt is None:
                    nxt = self.steps[node][letter] = len(self.steps)
                    self.steps.append({})
                    self.inner.append(-1)
                    self.final.append(-1)
                node = nxt
            for kind in ([self.final] if is_final else [self.inner] if cut else [self.inner, self.final]):
                kind[node] = i

    def _choices(self, letters: str, at: int) -> list[tuple[int, int]]:
        """(end, token) of the tokens that start at a position, shortest first."""
        steps, inner, out, node, to, last = self.steps, self.inner, [], 0, at, len(letters)
        for letter in letters[at:at + self.longest]:
            node = steps[node].get(letter)
            if node is None:
                break
            to += 1
            t = inner[node] if to < last else self.final[node]
            if t >= 0:
                out.append((to, t))
        return out


class Tokenizer:
    """A word-level byte BPE tokenizer file (NFC, white space, lower case,
    pattern split, byte letters) run by the automaton.  A file with other
    steps is refused."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, steps = spec["model"], spec["normalizer"]["normalizers"]
        split, byte_level = spec["pre_tokenizer"]["pretokenizers"]
        asked = ([s["type"] for s in steps], split["type"], split["behavior"], split["invert"], byte_level["type"],
                 byte_level["add_prefix_space"], byte_level["use_regex"], spec["decoder"], spec["post_processor"])
        known = (["NFC", "Replace", "Lowercase"], "Split", "Removed", True, "ByteLevel", False, False, None, None)
        plain = all(not model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "fuse_unk",
                                               "byte_fallback", "ignore_merges"))
        if asked != known or steps[1]["pattern"] != {"Regex": r"\s+"} or not plain:
            raise ValueError(f"{path}: steps other than this operator's")
        vocab = dict(model["vocab"])
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.automaton = Automaton(vocab, merges, model.get("end_of_word_suffix") or "")
        self.labels = {i: t for t, i in vocab.items()}
        self.special = {}
        for t in spec["added_tokens"]:
            if t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"]:
                raise ValueError(f"{path}: added token {t['content']!r} with options")
            self.special[t["content"]] = t["id"]
            self.labels[t["id"]] = t["content"]
        longest_first = sorted(self.special, key=len, reverse=True)
        self.split_special = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if longest_first else None
        # White space is Unicode's property, which the regex module's \s widens.
        pattern = split["pattern"]["Regex"].replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}")
        self.words = regex.compile(pattern)
        # Letters beyond Latin: the two Unicode tables may differ in version, so
        # the tokenizers library normalises and splits those pieces.
        self.rare = re.compile("[^\\x00-\u024f]")
        self.library = tokenizers.Tokenizer.from_file(path)
        self.letters = byte_letters()
        self.pieces: dict[bytes, bytes] = {}
        self.known_words: dict[str, bytes] = {}

    def _word(self, word: str) -> bytes:
        got = self.known_words.get(word)
        if got is None:
            plain = word.isascii() and word.isprintable()      # these letters stand for themselves
            letters = word if plain else "".join([self.letters[b] for b in word.encode()])
            got = array("I", self.automaton.word(letters)).tobytes()
            if len(word) <= MAX_PIECE_BYTES:
                if len(self.known_words) >= MAX_PIECES:
                    self.known_words.clear()
                self.known_words[word] = got
        return got

    def _segment(self, text: str) -> bytes:
        if self.rare.search(text):
            text = self.library.normalizer.normalize_str(text)
            words = [letters for letters, _ in self.library.pre_tokenizer.pre_tokenize_str(text)]
            return b"".join([array("I", self.automaton.word(w)).tobytes() for w in words])
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
        return b"".join([self._word(w) for w in self.words.findall(text.lower())])

    def piece(self, data: bytes) -> bytes:
        """Packed ids of a text without ASCII white space."""
        if data.isalpha():                                     # ASCII letters only
            got = self._word(data.lower().decode())
        elif data[:-1].isalpha() and data[-1:] in b",.!?;:":
            got = self._word(data[:-1].lower().decode()) + self._word(data[-1:].decode())
        elif self.split_special and b"<" in data:
            parts = enumerate(self.split_special.split(data.decode("utf-8", "replace")))
            got = b"".join([array("I", [self.special[p]]).tobytes() if k % 2 else self._segment(p) for k, p in parts])
        else:
            got = self._segment(data.decode("utf-8", "replace"))
        if len(data) <= MAX_PIECE_BYTES:
            if len(self.pieces) >= MAX_PIECES:
                self.pieces.clear()
            self.pieces[data] = got
        return got

    def encode(self, data: bytes) -> bytes:
        """Token ids, little-endian unsigned 32-bit."""
        known, piece = self.pieces.get, self.piece
        return b"".join([known(p) or piece(p) for p in data.split()])

    def decode(self, packed: bytes) -> str:
        """Labels of the arcs, special ones too."""
        ids = array("I", packed)
        return " ".join(map(self.labels.__getitem__, ids))


_LOADED: dict[str, Tokenizer] = {}


def load(path: str) -> Tokenizer:
    """The compiled tokenizer, once per process."""
    if path not in _LOADED:
        _LOADED[path] = Tokenizer(path)
    return _LOADED[path]


def encode(df: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """``df`` with ``ids`` (binary, little-endian unsigned 32-bit token ids),
    ``n_tokens`` and ``decoded`` (the text the ids decode to); columns of these
    names are replaced.  ``path`` must exist on every executor."""
    bound_batches(df.sparkSession)

    @F.arrow_udf("ids binary, decoded string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokenizer = load(path)
        for texts in batches:
            ids = [tokenizer.encode(t.as_buffer().to_pybytes()) for t in texts]
            yield pa.StructArray.from_arrays(
                [pa.array(ids, pa.binary()), pa.array([tokenizer.decode(i) for i in ids], pa.string())],
                names=["ids", "decoded"])

    names = ("ids", "n_tokens", "decoded")
    done = df.withColumn("_encoded", run(utf8(F.col(text_col))))
    return done.select(*[c for c in df.columns if c not in names], F.col("_encoded.ids").alias("ids"),
                       (F.octet_length("_encoded.ids") / 4).cast("long").alias("n_tokens"),
                       F.col("_encoded.decoded").alias("decoded"))


def decode(df: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """``df`` with ``decoded`` from stored packed ids (null: empty)."""
    bound_batches(df.sparkSession)

    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokenizer = load(path)
        for packed in batches:
            yield pa.array([tokenizer.decode(p.as_buffer().to_pybytes()) for p in packed], pa.string())

    return df.withColumn("decoded", run(F.coalesce(F.col(ids_col), F.lit(b""))))

"""Token counts by compiled finite-state transducers.

Two deterministic transducers give the number of tokens of a byte-level BPE vocabulary without building the tokens:

* `Scanner` cuts a text into the pieces that merges never cross. Its input are classes of code points, its output are
  marks "a piece starts here" or "one earlier". Texts of a batch are cut into chunks of equal length that are run side by
  side. A chunk is first run from all states at once (its state map); the maps are composed by a parallel prefix scan,
  which gives the true start state of every chunk; then each chunk is run once from that state.
* `Merger` reads the bytes of a piece. A state holds, for every suffix that may still grow to a token, the place in the
  vocabulary's prefix tree, the last token before that suffix and how many tokens less were emitted up to there. The
  encoding of a prefix is unique, and neighbours in it are exactly the pairs that encode to themselves, so one state has
  one successor per byte; the transition is annotated with the change of the number of emitted tokens. States are
  compiled when they are first met and kept per worker; those beyond `MAX_STATES` are dropped after their batch and
  compiled again if they return, which costs time and changes no result.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .shared import over_batches, run_hashes, slices, text_bytes

LIMIT = 512
CHUNK = 256
MAX_STATES = 100_000
#: States by which the transition table grows.
ROWS = 16_384

# ---- the scanner: classes of code points, states, transitions
ONE, R, V, L, E, LETTER, NUMBER, SPACE, BLANK, QUOTE, OTHER = range(11)
#: Added to the class of the first code point of a text.
FIRST = 11
SYMBOLS = 22
START, WORD, DIGITS, SIGNS, ONE_SPACE, SPACES, ONE_BLANK, BLANKS, QUOTED, QUOTED_RV, QUOTED_L, DONE = range(12)
STATES = 12
HERE, BEFORE = 1, 2


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """Class of every code point by its Unicode category."""
    out = np.full(0x110000, OTHER, np.uint8)
    for i in range(0x110000):
        kind = unicodedata.category(chr(i))
        if kind[0] == "L":
            out[i] = LETTER
        elif kind[0] == "N":
            out[i] = NUMBER
        elif kind[0] == "Z" or 9 <= i <= 13 or i == 0x85:
            out[i] = BLANK
    out[0x20] = SPACE
    out[0x27] = QUOTE
    for c in "stmd":
        out[ord(c)] = ONE
    for c, kind in zip("rvle", (R, V, L, E)):
        out[ord(c)] = kind
    return out


def _begin(symbol: int) -> int:
    """State after a piece's first code point."""
    if symbol <= LETTER:
        return WORD
    return {NUMBER: DIGITS, SPACE: ONE_SPACE, BLANK: ONE_BLANK, QUOTE: QUOTED, OTHER: SIGNS}[symbol]


def _move(state: int, symbol: int) -> tuple[int, int]:
    """Next state and marks for a code point that is not the first of a text."""
    run = {WORD: WORD, DIGITS: DIGITS, SIGNS: SIGNS}
    kind = WORD if symbol <= LETTER else DIGITS if symbol == NUMBER else SIGNS if symbol in (QUOTE, OTHER) else None
    if state in (START, DONE):
        return _begin(symbol), HERE
    if state in run:
        return (state, 0) if kind == state else (_begin(symbol), HERE)
    if state in (ONE_SPACE, SPACES, ONE_BLANK, BLANKS):
        if kind is None:
            return (SPACES if symbol == SPACE else BLANKS), 0
        marks = BEFORE if state in (SPACES, BLANKS) else 0
        if state in (ONE_BLANK, BLANKS):
            return _begin(symbol), marks | HERE
        return kind, marks  # the space belongs to the piece that starts
    if state == QUOTED:
        if symbol == ONE:
            return DONE, 0
        if symbol in (R, V):
            return QUOTED_RV, 0
        if symbol == L:
            return QUOTED_L, 0
        return (SIGNS, 0) if kind == SIGNS else (_begin(symbol), HERE)
    if (state, symbol) in ((QUOTED_RV, E), (QUOTED_L, L)):
        return DONE, 0
    after, marks = _move(WORD, symbol)
    return after, marks | BEFORE


@lru_cache(maxsize=1)
def scanner() -> tuple[np.ndarray, np.ndarray]:
    """Next state and marks by state * SYMBOLS + symbol."""
    step, marks = np.zeros((STATES, SYMBOLS), np.int64), np.zeros((STATES, SYMBOLS), np.uint8)
    for state in range(STATES):
        for symbol in range(FIRST):
            step[state, symbol], marks[state, symbol] = _move(state, symbol)
            step[state, FIRST + symbol] = _begin(symbol)
            marks[state, FIRST + symbol] = HERE | (BEFORE if state in (QUOTED_RV, QUOTED_L) else 0)
    return step.ravel(), marks.ravel()


def scan(symbols: np.ndarray, chunk: int = CHUNK) -> np.ndarray:
    """Sorted positions at which pieces start, in a sequence of symbols."""
    step, marks = scanner()
    n = len(symbols)
    lanes = -(-(n + 1) // chunk)
    padded = np.full(lanes * chunk, FIRST + OTHER, np.uint8)  # what follows ends the last text as a next text would
    padded[:n] = symbols
    columns = np.ascontiguousarray(padded.reshape(lanes, chunk).T)
    # the state map of each chunk: from all states until they have met, then from one
    at = np.repeat(np.arange(STATES)[None, :], lanes, 0)
    for k in range(chunk):
        at = step[at * SYMBOLS + columns[k][:, None]]
        if at.shape[1] > 1 and (at == at[:, :1]).all():
            at = at[:, :1]
    maps = np.array(np.broadcast_to(at, (lanes, STATES)))
    # inclusive scan: maps[i] becomes the composition of the maps 0..i
    shift = 1
    while shift < lanes:
        maps[shift:] = np.take_along_axis(maps[shift:], maps[:-shift].copy(), 1)
        shift *= 2
    state = np.concatenate([[START], maps[:-1, START]])
    out = np.empty((chunk, lanes), np.uint8)
    for k in range(chunk):
        key = state * SYMBOLS + columns[k]
        out[k] = marks[key]
        state = step[key]
    found = out.T.ravel()[: n + 1]
    starts = (found & HERE).astype(bool)
    starts[:-1] |= (found[1:] & BEFORE).astype(bool)
    return np.flatnonzero(starts[:n])


# ---- the merger: bytes of a piece to a number of tokens
def byte_letters() -> dict[str, int]:
    """The printable letters by which vocabulary files of this kind write bytes."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Merger:
    def __init__(self, path: str, max_states: int = MAX_STATES) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        raw = lambda token: bytes(letters[c] for c in token)
        self.special = [t["content"].encode() for t in spec["added_tokens"]]
        tokens = [t for t in spec["model"]["vocab"] if t.encode() not in self.special]
        self.ids = {raw(t): i for i, t in enumerate(tokens)}
        self.text = list(self.ids)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.rank = {(self.ids[raw(a)], self.ids[raw(b)]): (i, self.ids[raw(a) + raw(b)]) for i, (a, b) in enumerate(pairs)}
        self.max_states = max_states
        self.children: list[dict[int, int]] = [{}]  # the prefix tree
        self.token = [-1]
        for word, ident in self.ids.items():
            node = 0
            for b in word:
                if b not in self.children[node]:
                    self.children[node][b] = len(self.children)
                    self.children.append({})
                    self.token.append(-1)
                node = self.children[node][b]
            self.token[node] = ident
        self.fits: dict[tuple[int, int], bool] = {}
        self.known: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.column = np.full(256, -1, np.int64)  # of the table, given to a byte when it is first met
        self.bytes: list[int] = []
        self.next = np.full((ROWS, 64), -1, np.int32)
        self.emits = np.zeros((ROWS, 64), np.int8)
        self.state(((0, -1, 0),))

    def trim(self) -> None:
        """Drop what was compiled beyond the limit."""
        if len(self.states) > self.max_states:
            for key in self.states[self.max_states :]:
                del self.known[key]
            del self.states[self.max_states :]
            self.next[self.next >= self.max_states] = -1
            self.next[self.max_states :] = -1
        if len(self.fits) > 4 * self.max_states:
            self.fits.clear()

    def columns(self, raw: np.ndarray) -> np.ndarray:
        for b in np.flatnonzero((np.bincount(raw, minlength=256) > 0) & (self.column < 0)):
            self.column[b] = len(self.bytes)
            self.bytes.append(int(b))
        if (wide := len(self.bytes) - self.next.shape[1]) > 0:
            wide = max(wide, min(64, 256 - self.next.shape[1]))
            self.next = np.pad(self.next, ((0, 0), (0, wide)), constant_values=-1)
            self.emits = np.pad(self.emits, ((0, 0), (0, wide)))
        return self.column[raw]

    def state(self, key: tuple) -> int:
        ident = self.known.get(key)
        if ident is None:
            ident = self.known[key] = len(self.states)
            self.states.append(key)
            if ident >= len(self.next):
                self.next = np.pad(self.next, ((0, ROWS), (0, 0)), constant_values=-1)
                self.emits = np.pad(self.emits, ((0, ROWS), (0, 0)))
        return ident

    def encode(self, piece: bytes) -> list[int]:
        """Merges in the order of their ranks; only for pairs of tokens when a transition is compiled."""
        parts = [self.ids[bytes([b])] for b in piece]
        while len(parts) > 1:
            best = min((self.rank[p][0], p) if p in self.rank else (len(self.rank), p) for p in zip(parts, parts[1:]))
            if best[0] == len(self.rank):
                break
            merged, i, out = self.rank[best[1]][1], 0, []
            while i < len(parts):
                if tuple(parts[i : i + 2]) == best[1]:
                    out.append(merged)
                    i += 2
                else:
                    out.append(parts[i])
                    i += 1
            parts = out
        return parts

    def neighbours(self, before: int, token: int) -> bool:
        """Whether `token` may follow `before` (-1: the start) in an encoding."""
        have = self.fits.get((before, token))
        if have is None:
            want = [token] if before < 0 else [before, token]
            have = self.fits[before, token] = self.encode(b"".join(self.text[t] for t in want)) == want
        return have

    def compile(self, ident: int, column: int) -> None:
        grown, last, count, byte = [], -1, 0, self.bytes[column]
        for node, before, less in self.states[ident]:
            child = self.children[node].get(byte)
            if child is None:
                continue
            token = self.token[child]
            if last < 0 and token >= 0 and self.neighbours(before, token):
                last, count = token, less + 1
            if self.children[child]:
                grown.append((child, before, less))
        key = tuple((node, before, less - count) for node, before, less in grown) + ((0, last, 0),)
        after = self.state(key)
        self.next[ident, column] = after
        self.emits[ident, column] = count

    def counts(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Number of tokens of each piece; the pieces are run side by side, the longest first."""
        self.trim()
        raw = self.columns(raw)
        length = ends - starts
        order = np.argsort(-length, kind="stable")
        at = starts[order]
        alive = np.searchsorted(-length[order], -np.arange(1, int(length.max(initial=0)) + 1), side="right")
        state, total = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
        for k, n in enumerate(alive):
            byte = raw[at[:n] + k]
            now = state[:n]
            after = self.next[now, byte]
            if (after < 0).any():
                for key in np.unique(now[after < 0] * 256 + byte[after < 0]):
                    self.compile(int(key) >> 8, int(key) & 255)
                after = self.next[now, byte]
            total[:n] += self.emits[now, byte]
            state[:n] = after
        out = np.empty_like(total)
        out[order] = total
        return out


@lru_cache(maxsize=2)
def merger(path: str) -> Merger:
    return Merger(path)


def token_counts(column: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and tokens of each text."""
    raw, offsets = text_bytes(column)
    sizes = np.diff(offsets)
    total = np.zeros(len(sizes), np.int64)
    if not len(raw):
        return sizes, total
    machine = merger(path)
    data = raw.tobytes()
    points = np.frombuffer(data.decode("utf-8").encode("utf-32-le"), np.uint32)
    symbols = classes()[points]
    where = np.flatnonzero((raw & 0xC0) != 0x80)  # first byte of each code point
    fresh = offsets[:-1][sizes > 0]
    special = []
    for word in machine.special:
        found = data.find(word)
        while found >= 0:
            owner = np.searchsorted(offsets, found, side="right") - 1
            if found + len(word) <= offsets[owner + 1]:
                special.append((found, found + len(word)))
                found = data.find(word, found + len(word))
            else:
                found = data.find(word, found + 1)
    if special:
        edges = np.array(special).ravel()
        fresh = np.union1d(fresh, edges[edges < len(raw)])
    symbols[np.searchsorted(where, fresh)] += FIRST
    starts = where[scan(symbols)]
    ends = np.append(starts[1:], len(raw))
    _, first, same = np.unique(run_hashes(_spread(raw), starts, ends), return_index=True, return_inverse=True)
    counts = machine.counts(raw, starts[first], ends[first])[same]
    for lo, hi in special:
        a, b = np.searchsorted(starts, (lo, hi))
        counts[a:b] = 0
        counts[a] = 1
    np.add.at(total, np.searchsorted(offsets, starts, side="right") - 1, counts)
    return sizes, total


def _spread(raw: np.ndarray) -> np.ndarray:
    from .shared import _BYTES

    return _BYTES[raw]


def count_tokens(documents: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """Per document: doc_id, n_bytes, n_tokens and over_limit.

    `path` names the vocabulary file (byte-level BPE in the JSON of `tokenizers`), which every executor must have. Special
    tokens inside a text count as one token each. A missing or empty text has 0 bytes and 0 tokens; repeated rows are
    counted one by one, a missing doc_id stays missing and other columns are ignored.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 3_000_000):
                size, tokens = token_counts(part.column("text"), path)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(size), pa.array(tokens), pa.array(tokens > limit)],
                    names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
                )

    return over_batches(
        documents.select("doc_id", "text"), work, "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    )

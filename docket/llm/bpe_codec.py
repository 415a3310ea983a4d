"""Byte-level BPE encoding and decoding without regular expressions (operator 6).

Texts of a batch become one array of code points; a table gives each its class,
a look at the neighbours gives each a symbol, and an automaton over symbols says
before which characters a piece begins. The automaton's transition functions are
closed under composition (a small monoid), so that its run over millions of
characters is an associative scan: columns of blocks are composed with one table
lookup for all blocks at a time, and the blocks' own products once more.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import sys
import unicodedata
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of the pattern's \\s.
SPACES = [9, 10, 11, 12, 13, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288]
#: What follows an apostrophe in a contraction.
SUFFIXES_1, SUFFIXES_2 = "stmd", ("re", "ve", "ll")
CACHE = 1_000_000
SLICE = 1 << 21  # characters scanned at a time; longer texts are scanned whole

OTHER, LETTER, NUMBER, SPACE, BREAK = range(5)  # BREAK: between texts
# Symbols: the classes, and the characters that need a look at their neighbours.
S_OTHER, S_LETTER, S_NUMBER, S_SPACE, S_BREAK, S_GLUE, S_LAST, S_QUOTE1, S_QUOTE2 = range(9)
# States: what the next character meets.
FRESH, IN_LETTERS, IN_NUMBERS, IN_OTHERS, GLUED, IN_SPACES, ONE_MORE, TWO_MORE = range(8)


@functools.cache
def classes(spaces: tuple[int, ...] = tuple(SPACES)) -> np.ndarray:
    """Class of every code point, from the Unicode categories."""
    out = np.zeros(sys.maxunicode + 2, np.uint8)
    for c in range(sys.maxunicode + 1):
        k = unicodedata.category(chr(c))[0]
        if k in "LN":
            out[c] = LETTER if k == "L" else NUMBER
    out[list(spaces)] = SPACE
    out[-1] = BREAK
    return out


def step(state: int, symbol: int) -> tuple[int, bool]:
    """The state after a symbol, and whether a piece begins before it."""
    if symbol == S_BREAK:
        return FRESH, True
    if symbol == S_GLUE:  # a space that belongs to what follows
        return GLUED, True
    if symbol == S_LAST:  # the last white space of a run, a piece of its own
        return FRESH, True
    if symbol == S_SPACE:
        return IN_SPACES, state != IN_SPACES
    if state == TWO_MORE:
        return ONE_MORE, False
    if state == ONE_MORE:
        return FRESH, False
    run = {S_LETTER: IN_LETTERS, S_NUMBER: IN_NUMBERS}.get(symbol, IN_OTHERS)
    if state == GLUED:
        return run, False
    if state == run:
        return run, False
    if symbol == S_QUOTE1:
        return ONE_MORE, True
    if symbol == S_QUOTE2:
        return TWO_MORE, True
    return run, True


@functools.cache
def monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(element of each symbol, product table, state after an element from FRESH, begins[state, symbol])."""
    states, symbols = range(8), range(9)
    of = [tuple(step(q, s)[0] for q in states) for s in symbols]
    index = {f: i for i, f in enumerate(dict.fromkeys([tuple(states), *of]))}
    todo = list(index)
    while todo:
        f = todo.pop()
        for g in of:
            h = tuple(g[q] for q in f)
            if h not in index:
                index[h] = len(index)
                todo.append(h)
    every = list(index)
    product = np.array([[index[tuple(g[q] for q in f)] for g in every] for f in every], np.uint16)
    return np.array([index[f] for f in of], np.uint16), product, np.array([f[FRESH] for f in every], np.uint8), np.array([[step(q, s)[1] for s in symbols] for q in states])


def symbols(points: np.ndarray) -> np.ndarray:
    """A symbol for each code point; points ends with a break (sys.maxunicode + 1)."""
    kind = classes()[points]
    out = kind.copy()
    ahead = np.empty_like(kind)
    ahead[:-1], ahead[-1] = kind[1:], BREAK
    last = (kind == SPACE) & (ahead != SPACE) & (ahead != BREAK)
    out[last] = S_LAST
    out[last & (points == 32)] = S_GLUE
    at = np.flatnonzero(points[:-1] == 39)
    if len(at):
        one = points[at + 1]
        two = points[np.minimum(at + 2, len(points) - 1)]
        out[at[np.isin(one, [ord(c) for c in SUFFIXES_1])]] = S_QUOTE1
        for a, b in SUFFIXES_2:
            out[at[(one == ord(a)) & (two == ord(b))]] = S_QUOTE2
    return out


def starts(points: np.ndarray) -> np.ndarray:
    """Where pieces (and breaks) begin, by the associative scan."""
    if len(points) == 0:
        return np.zeros(0, np.int64)
    sym = symbols(points)
    element, product, after, begins = monoid()
    n = len(sym)
    width = max(1, int(np.sqrt(n)))
    rows = -(-n // width)
    padded = np.full(rows * width, S_BREAK, np.uint8)
    padded[:n] = sym
    steps = np.ascontiguousarray(element[padded].reshape(rows, width).T)
    for j in range(1, width):  # all blocks at once
        steps[j] = product[steps[j - 1], steps[j]]
    before = np.zeros(rows, np.uint16)  # product of all earlier blocks; 0 is the identity
    for r in range(1, rows):
        before[r] = product[before[r - 1], steps[-1, r - 1]]
    reached = after[product[before, steps]].T.ravel()[:n]
    state = np.empty(n, np.uint8)
    state[0], state[1:] = FRESH, reached[:-1]
    return np.flatnonzero(begins[state, sym])


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a piece: the adjacent pair of lowest rank is merged first, the left one among equals."""
    if (whole := ranks.get(piece)) is not None:
        return [whole]
    n = len(piece)
    ends, prev = list(range(1, n + 1)), list(range(-1, n - 1))  # the part at i is piece[i:ends[i]]
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapify(heap)
    while heap:
        _, i, end = heappop(heap)
        j = ends[i] if i >= 0 else n
        if not j or j >= n or ends[j] != end:
            continue
        ends[i], ends[j] = end, 0
        if end < n:
            prev[end] = i
            if (r := ranks.get(piece[i : ends[end]])) is not None:
                heappush(heap, (r, i, ends[end]))
        if (p := prev[i]) >= 0 and (r := ranks.get(piece[p:end])) is not None:
            heappush(heap, (r, p, end))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : ends[i]]])
        i = ends[i]
    return out


class Codec:
    """Encodes and decodes by a rank file (base64 token, rank)."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        size = max(self.ranks.values()) + 1
        words = [b""] * size
        for w, i in self.ranks.items():
            words[i] = w
        self.lengths = np.array([len(w) for w in words], np.int64)
        self.offsets = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(words), np.uint8)
        self.young: dict[str, np.ndarray] = {}
        self.old: dict[str, np.ndarray] = {}

    def ids(self, piece: str) -> bytes:
        """The ids of a piece as little-endian 32-bit integers, from the cache if it has them."""
        if (found := self.young.get(piece)) is None:
            if (found := self.old.get(piece)) is None:
                found = np.array(merge(piece.encode("utf-8"), self.ranks), "<u4").tobytes()
            if len(self.young) >= CACHE // 2:
                self.old, self.young = self.young, {}
            self.young[piece] = found
        return found

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each text its ids, and the character offset at which each piece begins."""
        joined = "\x00".join(texts) + "\x00"
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        sizes = np.array([len(t) for t in texts], np.int64)
        ends = np.cumsum(sizes + 1) - 1
        points[ends] = sys.maxunicode + 1
        begin = starts(points)
        first = np.searchsorted(begin, ends - sizes)
        last = np.searchsorted(begin, ends)
        bound = begin.tolist()
        young, ids, out = self.young, self.ids, []
        for k in range(len(texts)):
            lo, hi = int(first[k]), int(last[k])
            at = bound[lo : hi + 1]
            parts = []
            for a, b in zip(at, at[1:], strict=False):
                piece = joined[a:b]
                found = young.get(piece)
                if found is None:
                    found = ids(piece)
                    young = self.young
                parts.append(found)
            out.append((np.frombuffer(b"".join(parts), "<u4"), begin[lo:hi] - (ends[k] - sizes[k])))
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of ids: their places in the vocabulary's bytes are gathered at once."""
        size = self.lengths[ids]
        total = int(size.sum())
        if not total:
            return b""
        shift = np.repeat(self.offsets[ids] - (np.cumsum(size) - size), size)
        return self.bytes[shift + np.arange(total)].tobytes()


@functools.cache
def codec(path: str) -> Codec:
    return Codec(path)


def slices(texts: list[str]) -> Iterator[list[str]]:
    """Runs of texts of about SLICE characters; a longer text is a run of its own."""
    part, size = [], 0
    for t in texts:
        if part and size + len(t) > SLICE:
            yield part
            part, size = [], 0
        part.append(t)
        size += len(t)
    if part:
        yield part


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = True) -> DataFrame:
    """(id, n_tokens, ids binary, piece_offsets binary, ids_sha256, decoded_sha256) for every row.

    ids: little-endian 32-bit; piece_offsets: the character (32-bit) at which each
    piece begins; decoded from ids alone for decoded_sha256. keep_ids=False leaves the
    two binaries out. Null texts count as empty: no ids, hashes of the empty string.
    Repeated rows and null ids are kept; an empty table gives no rows; other columns
    are not read. One pass, no shuffle.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    extra = ", ids binary, piece_offsets binary" if keep_ids else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        words = np.array([str(i) for i in range(len(c.lengths))], object)
        for b in batches:
            n, ids, offsets, sha, back = [], [], [], [], []
            for part in slices([t if t is not None else "" for t in b.column(1).to_pylist()]):
                for got, at in c.encode(part):
                    n.append(len(got))
                    sha.append(hashlib.sha256(" ".join(words[got]).encode()).hexdigest())
                    back.append(hashlib.sha256(c.decode(got)).hexdigest())
                    if keep_ids:
                        ids.append(got.tobytes())
                        offsets.append(at.astype("<u4").tobytes())
            cols = [b.column(0), pa.array(n, pa.int64()), pa.array(sha), pa.array(back)]
            names = ["k", "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep_ids:
                cols += [pa.array(ids, pa.binary()), pa.array(offsets, pa.binary())]
                names += ["ids", "piece_offsets"]
            yield pa.RecordBatch.from_arrays(cols, names)

    narrow = docs.select(F.col(id_col).alias("k"), F.col(text_col).alias("t"))
    out = narrow.mapInArrow(run, f"k {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string{extra}")
    return out.withColumnRenamed("k", id_col)

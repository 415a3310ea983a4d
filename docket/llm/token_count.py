"""Token counts by heap-and-linked-list byte-pair merging (operator 2).

A word's count is its number of initial symbols minus the merges made, taken
lowest rank first from a heap of adjacent pairs; no identifiers are emitted.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The split pattern of byte-level vocabularies.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words kept by a worker; beyond that the older half is forgotten.
CACHE = 1_000_000
NAN = float("nan")


def byte_letters() -> dict[int, str]:
    """Byte to the letter that stands for it: itself if printable, else the next letter from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def merges_left(symbols: list[str], ranks: dict[tuple[str, str], int]) -> int:
    """How many symbols remain after all merges.

    The heap holds (rank, left index); an entry whose pair has changed since is
    skipped. nxt and prv link what is still there.
    """
    n = len(symbols)
    if n < 2:
        return n
    heap = [(r, i) for i in range(n - 1) if (r := ranks.get((symbols[i], symbols[i + 1]))) is not None]
    if not heap:
        return n
    heapq.heapify(heap)
    nxt, prv, left = list(range(1, n + 1)), list(range(-1, n - 1)), n
    while heap:
        r, i = heapq.heappop(heap)
        if symbols[i] is None or (j := nxt[i]) >= n or ranks.get((symbols[i], symbols[j])) != r:
            continue
        symbols[i] += symbols[j]
        symbols[j] = None
        left -= 1
        k = nxt[i] = nxt[j]
        if k < n:
            prv[k] = i
            if (s := ranks.get((symbols[i], symbols[k]))) is not None:
                heapq.heappush(heap, (s, i))
        if (p := prv[i]) >= 0 and (s := ranks.get((symbols[p], symbols[i]))) is not None:
            heapq.heappush(heap, (s, p))
    return left


class _Words(dict):
    """Count of " " + word; nan for a word next to further white space, where counts depend on the neighbours."""

    def __init__(self, counter: "Counter") -> None:
        self.counter, self.older = counter, {}

    def __missing__(self, word: str) -> float:
        if (found := self.older.get(word)) is None:
            found = NAN if not word or word[0].isspace() or word[-1].isspace() else self.counter.whole(" " + word)
        if len(self) >= CACHE // 2:
            self.older = dict(self)
            self.clear()
        self[word] = found
        return found


class Counter:
    """Counts tokens as the tokenizers library does for a byte-level vocabulary file."""

    def __init__(self, path: str) -> None:
        spec = json.load(open(path, encoding="utf-8"))
        pairs = (tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"])
        self.ranks = {p: i for i, p in enumerate(pairs)}
        letters = byte_letters()
        self.table = {chr(b): c for b, c in letters.items()}
        self.pattern = regex.compile(SPLIT)
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.marks = special
        self.pieces: dict[str, int] = {}
        self.words = _Words(self)
        self.trans = str.maketrans(self.table)

    def piece(self, piece: str) -> int:
        if (found := self.pieces.get(piece)) is None:
            if len(self.pieces) >= CACHE // 2:
                self.pieces.clear()
            found = merges_left(list(piece.encode("utf-8").decode("latin-1").translate(self.trans)), self.ranks)
            self.pieces[piece] = found
        return found

    def whole(self, text: str) -> int:
        """Split by the pattern, with special strings taken out first as one token each."""
        if self.special and any(m in text for m in self.marks):
            parts = self.special.split(text)
            return len(parts) - 1 + sum(sum(map(self.piece, self.pattern.findall(p))) for p in parts)
        return sum(map(self.piece, self.pattern.findall(text)))

    def count(self, text: str) -> int:
        """A single space between other characters always begins a piece, so words are counted one by one.

        Texts with a space beside other white space give nan and go through the whole pattern.
        """
        first, *rest = text.split(" ")
        total = sum(map(self.words.__getitem__, rest))
        if total != total or (rest and (not first or first[-1].isspace())):
            return self.whole(text)
        return total + self.whole(first)


_counters: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    if path not in _counters:
        _counters[path] = Counter(path)
    return _counters[path]


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 512) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) for every row of docs.

    path: a byte-level BPE vocabulary in the tokenizers library's JSON form, present
    on every executor. Null and empty texts count 0 bytes and 0 tokens; repeated rows
    and null ids are kept as they are; an empty table gives no rows; other columns
    are not read. One pass, no shuffle; memory is one batch and a bounded cache.
    """

    text: Column = F.col(text_col)
    kind = docs.schema[id_col].dataType.simpleString()
    narrow = docs.select(F.col(id_col).alias("k"), text.alias("t"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path).count
        for b in batches:
            n = pa.array([count(t.as_py()) if t.is_valid else 0 for t in b.column(1)], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), n], ["k", "n_bytes", "n_tokens"])

    out = narrow.mapInArrow(run, f"k {kind}, n_bytes long, n_tokens long")
    return out.select(F.col("k").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))

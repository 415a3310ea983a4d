"""Token ids as files of frequency-ranked, byte-aligned codes (operator 1).

Ids are replaced by their rank in the corpus' frequency order, so that common ones
take one byte. Four ranks share a control byte that holds their lengths (two bits
each); control bytes and data bytes are kept apart, and decoding looks the lengths
of all ranks up in a table and gathers the data bytes with numpy.

Files: a Parquet table of blocks, so that any Hadoop file system can hold it and
failed tasks leave nothing behind. A row is a block of whole documents in
ascending id order: shard and block (their order is the order of documents), the
shard's tokens before it, keys and counts per document, and the two byte streams.
The rank table (rank, id, count) lies beside them.
"""

from __future__ import annotations

import functools
import json
import os
import string
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import remove_later, scratch, written

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a worker per core

#: Pieces kept by a worker; beyond that the older half is forgotten.
CACHE = 1_000_000
#: A last letter or digit that stays one character once normalised; characters whose case is
#: dropped alike everywhere; the ASCII marks at the end of a word.
LAST = "[0-9A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f]$"
SIMPLE = r"^[\x{00}-\x{12f}]*$"
TAIL = r"(?P<tail>[!-/:-@\[-`{-~]*)$"
#: Stands between words that are encoded together; its id must be one that it alone has.
SEPARATOR = "€"
#: Tokens after which a block is closed; tokens of a shard, and shards at most (their bounds are held by the driver).
BLOCK = 1 << 18
SHARD = 1 << 23
SHARDS = 20_000


def length_table() -> np.ndarray:
    """The four lengths that each control byte stands for."""
    return (((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3) + 1).astype(np.uint8)


def pack(ranks: np.ndarray, counts: np.ndarray) -> tuple[bytes, bytes, np.ndarray]:
    """Control bytes, data bytes and data sizes of documents (of so many ranks each, one after the other).

    Every document's control bytes begin anew, so that it can be decoded alone.
    """
    ranks = ranks.astype("<u4")
    size = 1 + (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    code = np.zeros(4 * int((-(-counts // 4)).sum()), np.uint8)
    code[places(counts)] = size - 1
    control = code[0::4] | code[1::4] << 2 | code[2::4] << 4 | code[3::4] << 6
    end = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
    data = np.empty(int(end[-1]), np.uint8)
    data[end[:-1]] = ranks
    for k in (1, 2, 3):
        more = np.flatnonzero(size > k)
        if len(more):
            data[end[more] + k] = ranks[more] >> np.uint32(8 * k)
    return control.tobytes(), data.tobytes(), np.diff(end[np.concatenate([[0], np.cumsum(counts)])])


def places(counts: np.ndarray) -> np.ndarray:
    """Where each rank's code is, when every document's begin at a multiple of four."""
    padded = 4 * -(-counts // 4)
    return np.arange(int(counts.sum())) + np.repeat(np.cumsum(padded) - padded - (np.cumsum(counts) - counts), counts)


def unpack(control: bytes, data: bytes, counts: np.ndarray) -> np.ndarray:
    """The ranks of documents' streams, one after the other: the lengths are looked up, the bytes gathered."""
    size = length_table()[np.frombuffer(control, np.uint8)].ravel()[places(counts)]
    at = np.cumsum(size, dtype=np.int64) - size
    raw = np.frombuffer(data + b"\0\0\0", np.uint8).astype(np.uint32)
    out = raw[at]
    for k in (1, 2, 3):
        more = np.flatnonzero(size > k)
        if len(more):
            out[more] |= raw[at[more] + k] << np.uint32(8 * k)
    return out


class Words:
    """Ids of texts by the tokenizers library, a word at a time.

    No piece spans a space or line feed and the normaliser works on single words, so
    that a text's ids are those of its words one after the other. ASCII marks after a
    letter or digit are pieces of their own, and case is dropped, so that words that
    differ in these alone are encoded once. Missing words go to the library in one
    text, with a separator between them whose one id no other piece has.
    """

    def __init__(self, path: str) -> None:
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        found = self.library.encode(SEPARATOR, add_special_tokens=False).ids
        self.separator = found[0] if len(found) == 1 else None
        spec = json.loads(self.library.to_str())
        self.marks = [t["content"] for t in spec["added_tokens"]]
        self.flag = next((c for c in "".join(self.marks) if all(c in m for m in self.marks)), "")
        self.simple = simple_library(spec)
        self.plain = spec["normalizer"] is not None and "Lowercase" in json.dumps(spec["normalizer"])

    def stems(self, words: pa.Array) -> tuple[pa.Array, pa.Array]:
        """What is encoded of each word, and the marks after it; a word of which more isn't certain is left whole."""
        stem = pc.utf8_rtrim(words, string.punctuation)
        apart = pc.match_substring_regex(stem, LAST)
        if self.flag:
            apart = pc.and_(apart, pc.invert(pc.match_substring(words, self.flag)))
        if not self.plain or (self.marks and not self.flag):
            apart = pa.array(np.zeros(len(words), bool))
        low = pc.if_else(pc.match_substring_regex(stem, SIMPLE), pc.utf8_lower(stem), stem)
        return pc.if_else(apart, low, words), pc.if_else(apart, pc.struct_field(pc.extract_regex(words, TAIL), 0), "")

    def library_ids(self, some: list[str], simple: bool = False) -> list[bytes]:
        library = self.simple if simple else self.library
        text = f" {SEPARATOR} ".join(some)
        if self.separator is not None and text.count(SEPARATOR) == len(some) - 1:
            ids = np.array(library.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
            cut = np.flatnonzero(ids == self.separator)
            if len(cut) == len(some) - 1:
                raw = ids.tobytes()
                return [raw[i:j] for i, j in zip([0, *((cut + 1) * 4).tolist()], [*(cut * 4).tolist(), len(raw)], strict=True)]
        return [np.array(e.ids, "<u4").tobytes() for e in library.encode_batch_fast(some, add_special_tokens=False)]

    def learn(self, pieces: list[str]) -> list[bytes]:
        """The ids of each piece; those that are missing go to the library together."""
        if len(self.young) > CACHE // 2:
            self.old, self.young = self.young, {}
        young, old, missing = self.young, self.old, []
        for p in pieces:
            if p not in young:
                if (found := old.get(p)) is None:
                    missing.append(p)
                else:
                    young[p] = found
        letters = {p for p in missing if p.isascii() and p.isalpha() and p.islower()} if self.simple else set()
        for kind in (True, False):
            own = [p for p in missing if (p in letters) == kind]
            for i in range(0, len(own), 512):
                some = own[i : i + 512]
                young.update(zip(some, self.library_ids(some, kind), strict=True))
        return list(map(young.__getitem__, pieces))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, how many each has); null texts have none."""
        lists = pc.split_pattern(pc.replace_substring(pc.fill_null(texts, ""), "\n", " "), " ")
        flat = lists.flatten().dictionary_encode()
        both = pa.concat_arrays(self.stems(flat.dictionary)).dictionary_encode()
        found = self.learn(both.dictionary.to_pylist())
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        ids = np.frombuffer(b"".join(found), "<u4")
        ids, size = gathered(ids, size, both.indices.to_numpy().reshape(2, -1).T.ravel())
        ids, size = gathered(ids, size.reshape(-1, 2).sum(1), flat.indices.to_numpy())
        end = np.concatenate([[0], np.cumsum(size)])
        return ids, np.diff(end[np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())])])


def simple_library(spec: dict) -> Tokenizer | None:
    """The same model for words of small ASCII letters only, which its pattern keeps whole and its normaliser as they are.

    Only for files that split by a pattern and then go by bytes; else None.
    """
    steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or []
    if [p["type"] for p in steps] != ["Split", "ByteLevel"] or "\\p{L}]+" not in json.dumps(steps[0], ensure_ascii=False).replace("\\\\", "\\"):
        return None
    own = spec | {"normalizer": None, "added_tokens": [], "pre_tokenizer": {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, steps[1]]}}
    return Tokenizer.from_str(json.dumps(own))


def gathered(values: np.ndarray, size: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of values that index names, one after the other, and their sizes."""
    n = size[index]
    shift = (np.cumsum(size) - size)[index] - (np.cumsum(n) - n)
    return values[np.repeat(shift, n) + np.arange(int(n.sum()))], n


@functools.cache
def words(path: str) -> Words:
    return Words(path)


def parts(column: pa.Array, size: int = 6 << 20) -> Iterator[tuple[int, pa.Array]]:
    """The batch's texts in runs of about so many bytes, with the row each begins at."""
    group = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy().astype(np.int64)) // size
    edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(column)]
    for a, b in zip(edges, edges[1:], strict=False):
        if b > a:
            yield a, column.slice(a, b - a)


def cut(data: bytes, sizes: np.ndarray) -> list[bytes]:
    end = np.cumsum(sizes).tolist()
    return [data[i:j] for i, j in zip([0, *end], end, strict=False)]


def encoded(docs: DataFrame, path: str, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """(k, n, c, d): every document's ids, coded as they are."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = words(path)
        for b in batches:
            for start, texts in parts(b.column(1)):
                ids, n = w.encode(texts)
                ids = np.insert(ids, np.cumsum(n), end_id)
                n = n + 1
                c, d, sizes = pack(ids, n)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(start, len(texts)), pa.array(n), pa.array(cut(c, -(-n // 4)), pa.binary()), pa.array(cut(d, sizes), pa.binary())], ["k", "n", "c", "d"])

    return docs.select(F.col(id_col).alias("k"), F.col(text_col).alias("t")).mapInArrow(run, f"k {kind}, n long, c binary, d binary")


def by_tokens(batches: Iterator[pa.RecordBatch], most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The rows in runs of about so many ids, so that their arrays stay small; a longer document is a run of its own."""
    for b in batches:
        group = np.cumsum(b.column("n").to_numpy()) // most
        edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), b.num_rows]
        for i, j in zip(edges, edges[1:], strict=False):
            if j > i:
                yield b.slice(i, j - i)


def ids_in(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    n = b.column("n").to_numpy(zero_copy_only=False)
    return unpack(b"".join(b.column("c").to_pylist()), b"".join(b.column("d").to_pylist()), n), n


def id_counts(coded: DataFrame) -> DataFrame:
    """(id, n): how often the whole corpus has each id, summed within tasks first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for b in by_tokens(batches):
            more = np.bincount(ids_in(b)[0], minlength=len(total))
            more[: len(total)] += total
            total = more
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], ["id", "n"])

    return coded.select("n", "c", "d").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write_ids(docs: DataFrame, path: str, out: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", shards: int | None = None) -> None:
    """Encode docs and write the files to the folder out, with end_id after each document.

    Ids are numbers. Null texts count as empty (end id only); repeated rows are all written; null ids
    come first; an empty table writes no block. There are as many shards as their tokens ask for (SHARD),
    and at least as many as the session's shuffle partitions. The rank table has one row per id of
    the vocabulary that occurs, so that its size is bounded by the vocabulary.
    """
    spark = docs.sparkSession
    coded = written(encoded(docs, path, end_id, id_col, text_col), "token-ids")
    count = {r.id: r.n for r in id_counts(coded).collect()}
    order = sorted(count, key=lambda i: (-count[i], i))
    rank = np.zeros(max(order, default=0) + 1, np.uint32)
    rank[order] = np.arange(len(order))
    schema = "rank long, id long, n long"
    spark.createDataFrame([(k, int(i), int(count[i])) for k, i in enumerate(order)], schema).coalesce(1).write.parquet(f"{out}/ranks")

    shards = shards or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")), min(SHARDS, -(-sum(count.values()) // SHARD)))
    kind = docs.schema[id_col].dataType.simpleString()
    bounds = np.array(sorted(set(coded.approxQuantile("k", [i / shards for i in range(1, shards)], 0.2 / shards))) if shards > 1 and order else [])
    table = spark.sparkContext.broadcast(rank)

    def ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in by_tokens(batches):
            ids, n = ids_in(b)
            c, d, sizes = pack(table.value[ids], n)
            at = np.array([np.searchsorted(bounds, k, "right") if k is not None else 0 for k in b.column("k").to_pylist()], np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(at), b.column("k"), b.column("n"), pa.array(cut(c, -(-n // 4)), pa.binary()), pa.array(cut(d, sizes), pa.binary())], ["shard", "k", "n", "c", "d"])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, number, before, rows, tokens = None, 0, 0, [], 0

        def close() -> pa.RecordBatch:
            cols = {
                "shard": pa.array([shard], pa.int32()),
                "block": pa.array([number], pa.int32()),
                "before": pa.array([before], pa.int64()),
                "tokens": pa.array([tokens], pa.int64()),
                "keys": pa.array([[r["k"] for r in rows]], pa.list_(kinds["k"])),
                "counts": pa.array([[r["n"] for r in rows]], pa.list_(pa.int64())),
                "control": pa.array([b"".join(r["c"] for r in rows)], pa.binary()),
                "data": pa.array([b"".join(r["d"] for r in rows)], pa.binary()),
            }
            return pa.RecordBatch.from_pydict(cols)

        kinds = {}
        for b in batches:
            kinds["k"] = b.schema.field("k").type
            for r in b.to_pylist():
                if rows and (r["shard"] != shard or tokens >= BLOCK):
                    yield close()
                    same = r["shard"] == shard
                    number, before = (number + 1, before + tokens) if same else (0, 0)
                    rows, tokens = [], 0
                shard = r["shard"]
                rows.append(r)
                tokens += r["n"]
        if rows:
            yield close()

    # a task per shard: dealt by a hash of their numbers, several would meet in one
    dealt = coded.mapInArrow(ranked, f"shard int, k {kind}, n long, c binary, d binary").repartitionById(shards, "shard").sortWithinPartitions("shard", F.col("k").asc_nulls_first(), "n", "d")
    packed = dealt.mapInArrow(blocks, f"shard int, block int, before long, tokens long, keys array<{kind}>, counts array<long>, control binary, data binary")
    packed.write.option("compression", "none").parquet(f"{out}/blocks")


def read_ids(spark: SparkSession, out: str, id_col: str = "doc_id", keep_ids: bool = True) -> DataFrame:
    """(id, start, n_tokens, ids_crc32, ids) of every document in the files of the folder out.

    start: ids of all documents before it, from the blocks' own totals; ids: decoded,
    as little-endian 32-bit integers (left out with keep_ids=False).
    """
    ranks = spark.read.parquet(f"{out}/ranks").orderBy("rank").collect()
    table = spark.sparkContext.broadcast(np.array([r.id for r in ranks], "<u4"))
    files = spark.read.parquet(f"{out}/blocks")
    kind = files.schema["keys"].dataType.elementType.simpleString()

    # One row per shard; there are as many as partitions were written.
    total = files.groupBy("shard").agg(F.sum("tokens").alias("t"))
    shard = total.select("shard", (F.sum("t").over(Window.orderBy("shard")) - F.col("t")).alias("base"))
    whole = files.join(F.broadcast(shard), "shard").select("keys", "counts", "control", "data", (F.col("base") + F.col("before")).alias("begin"))
    extra = ", ids binary" if keep_ids else ""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = table.value
        for b in batches:
            for i in range(b.num_rows):
                r = b.slice(i, 1)
                n = np.array(r.column("counts")[0].as_py(), np.int64)
                ids = ids_of[unpack(r.column("control")[0].as_py(), r.column("data")[0].as_py(), n)]
                each = cut(ids.tobytes(), 4 * n)
                starts = r.column("begin")[0].as_py() + np.cumsum(n) - n
                cols = [r.column("keys").flatten(), pa.array(starts), pa.array(n), pa.array(list(map(zlib.crc32, each)), pa.int64())]
                names = ["k", "start", "n_tokens", "ids_crc32"]
                if keep_ids:
                    cols.append(pa.array(each, pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names)

    return whole.mapInArrow(decode, f"k {kind}, start long, n_tokens long, ids_crc32 long{extra}").withColumnRenamed("k", id_col)


def round_trip(docs: DataFrame, path: str, folder: str, end_id: int = 2, id_col: str = "doc_id") -> DataFrame:
    """Write the files to a new folder within folder and read them back, without the ids. The folder is removed when the driver ends."""
    out = f"{folder}/token-ids-{uuid.uuid4().hex}"
    remove_later(docs.sparkSession, out)
    with scratch(docs.sparkSession):
        write_ids(docs, path, out, end_id, id_col)
    return read_ids(docs.sparkSession, out, id_col, keep_ids=False)

"""Token-id files: canonical length-limited Huffman codes in checkpointed blocks.

One pass over the texts writes their ids as plain numbers and counts every id,
a second writes each document's ids as a bit string under the code of the
global counts. Texts are cut at spaces and line feeds, which never lie
inside a token of this kind of tokenizer; the tokenizers library encodes each
distinct part of the pieces once a batch, and frequent ones once per task.

A file row is a segment: documents in ascending doc_id order, each starting at
a byte, with the bit offset of every block of BLOCK ids (a block ends with its
document). ``code`` lists the code length of each id; canonical codes follow
from the lengths. Blocks are independent: a reader decodes all blocks of a
segment side by side, one table lookup per id.

Null and empty texts are the end id alone. Documents of equal doc_id follow
each other in the order of their length and bytes, a null doc_id comes first.
An empty table writes no segment and reads back empty.
"""

from __future__ import annotations

import functools
import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattline.llm.common import cut, shared_dir, table

END = 1
LIMIT = 18          # longest code in bits
BLOCK = 512         # ids between two checkpoints
SEGMENT = 1 << 20   # bytes of a segment, about
PART = 2048         # documents of a file part, about
CHARS = 1 << 24     # bytes of text encoded at once
PACK = 1 << 17      # ids packed at once
MEMO = 400_000      # parts of pieces remembered by a task, about


def word_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


#: A word of Latin letters, each of which the tokenizer keeps in one run, and
#: punctuation after it; such a piece has the ids of both parts in turn.
LATIN = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f"
PIECE = f"^(?P<head>[{LATIN}]+)(?P<tail>[!-&(-/:-@\\[-`{{-~]*)$"


class Pieces:
    """Ids of texts by the tokenizers library, through a memo of the ids of their parts."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        # the same model for words that its normalizer would leave as they are
        self.plain = Tokenizer.from_file(path)
        self.plain.normalizer = normalizers.Sequence([])
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.known = pa.array([], pa.string())      # frequent parts and their ids
        self.ids = np.empty(0, np.uint32)
        self.start, self.size = np.empty(0, np.int64), np.empty(0, np.int64)

    def fresh(self, words: list[str], others: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their number for parts; words go to the library joined, which is much faster."""
        ids, size = [], []
        for at in range(0, len(words), 20_000):
            part = words[at:at + 20_000]
            e = self.plain.encode(" ".join(part), add_special_tokens=False)
            ids.append(np.array(e.ids, np.uint32))
            size.append(np.bincount(np.array(e.word_ids, np.int64), minlength=len(part)))
        found = [e.ids for e in self.tokenizer.encode_batch_fast(others, add_special_tokens=False)]
        ids.append(np.fromiter((x for f in found for x in f), np.uint32))
        size.append(np.fromiter(map(len, found), np.int64, len(found)))
        return np.concatenate(ids), np.concatenate(size)

    def parts(self, pieces: pa.Array, seen: np.ndarray) -> tuple[np.ndarray, ...]:
        """(ids, start, size, places): two places for each piece, the second of many empty.

        ``seen`` counts the pieces; parts that occur again are remembered.
        """
        cut = pc.extract_regex(pieces, PIECE)
        fits = pc.is_valid(cut)
        heads = pc.if_else(fits, pc.utf8_lower(pc.struct_field(cut, "head")), pieces)
        tails = pc.if_else(fits, pc.struct_field(cut, "tail"), "")
        coded = pa.concat_arrays([heads, tails]).dictionary_encode()
        at = coded.indices.to_numpy()
        place = pc.fill_null(pc.index_in(coded.dictionary, value_set=self.known), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        new = np.flatnonzero(place < 0)
        word = np.zeros(len(place), bool)
        word[at[:len(pieces)][fits.to_numpy(zero_copy_only=False)]] = True
        new = np.concatenate([new[word[new]], new[~word[new]]])
        texts = coded.dictionary.take(pa.array(new))
        n = int(word[new].sum())
        more, size = self.fresh(texts[:n].to_pylist(), texts[n:].to_pylist())
        start = len(self.ids) + np.cumsum(size) - size
        place[new] = len(self.known) + np.arange(len(new))
        ids, start, size = np.concatenate([self.ids, more]), np.concatenate([self.start, start]), np.concatenate([self.size, size])
        if len(self.known) < MEMO:
            often = np.bincount(at, np.tile(seen, 2), len(place))[new] > 1
            keep = len(self.known) + np.flatnonzero(often)
            self.known = pa.concat_arrays([self.known, texts.filter(pa.array(often))])
            runs = np.concatenate([np.arange(len(self.size)), keep])
            self.ids, self.size = ragged(ids, start[runs], size[runs]), size[runs]
            self.start = np.cumsum(self.size) - self.size
        return ids, start, size, np.stack([place[at[:len(pieces)]], place[at[len(pieces):]]], axis=1).reshape(-1)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, each document closed by END, and the number of ids of each."""
        lists = pc.split_pattern(pc.replace_substring(pc.fill_null(texts, ""), "\n", " "), " ")
        coded = lists.flatten().dictionary_encode()
        at = coded.indices.to_numpy()
        ids, start, size, parts = self.parts(coded.dictionary, np.bincount(at, minlength=len(coded.dictionary)))
        ids = ragged(ids, start[parts], size[parts])
        size = size[parts].reshape(-1, 2).sum(axis=1)
        start = np.cumsum(size) - size
        ends = np.concatenate([[0], np.cumsum(size[at])])[np.cumsum(pc.list_value_length(lists).to_numpy())]
        return np.insert(ragged(ids, start[at], size[at]), ends, END), np.diff(ends, prepend=0) + 1


def ragged(values: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """values[start:start + size] of all runs, end to end."""
    ends = np.cumsum(size)
    n = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if max(n, len(values)) < 1 << 31 else np.int64
    at = np.repeat((start - (ends - size)).astype(kind), size)
    at += np.arange(n, dtype=kind)
    return values[at]


@functools.lru_cache(maxsize=2)
def pieces_of(path: str) -> Pieces:
    return Pieces(path)


def groups(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows of about CHARS bytes of text at a time."""
    size = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy()
    run = np.cumsum(size)
    at = 0
    while at < len(size):
        to = max(at + 1, int(np.searchsorted(run, run[at] - size[at] + CHARS, "right")))
        yield batch.slice(at, to - at)
        at = to


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Optimal code lengths <= limit by package-merge; 0 for ids that don't occur."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.int64)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    limit = max(limit, int(len(used) - 1).bit_length())
    used = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[used].astype(np.int64)
    level, flags = leaves, [np.ones(len(leaves), bool)]
    for _ in range(limit - 1):
        pairs = len(level) // 2
        packed = level[0:2 * pairs:2] + level[1:2 * pairs:2]
        level = np.concatenate([leaves, packed])
        order = np.argsort(level, kind="stable")
        level = level[order]
        flags.append(order < len(leaves))
    need = 2 * len(leaves) - 2
    for flag in reversed(flags):
        n = int(flag[:need].sum())
        lengths[used[:n]] += 1
        need = 2 * (need - n)
    return lengths


def canonical(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of (length, id)."""
    used = np.flatnonzero(lengths)
    used = used[np.argsort(lengths[used], kind="stable")]
    codes = np.zeros(len(lengths), np.uint64)
    longest = int(lengths.max(initial=0))
    room = np.uint64(1) << (longest - lengths[used]).astype(np.uint64)
    first = np.cumsum(room) - room
    codes[used] = first >> (longest - lengths[used]).astype(np.uint64)
    return codes


def decoder(lengths: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """(bits of a lookup, id by bits, code length by bits)."""
    used = np.flatnonzero(lengths)
    used = used[np.argsort(lengths[used], kind="stable")]
    longest = int(lengths.max(initial=1))
    room = 1 << (longest - lengths[used])
    ids, size = np.repeat(used, room), np.repeat(lengths[used], room)
    pad = (1 << longest) - len(ids)
    return longest, np.pad(ids, (0, pad)).astype(np.uint32), np.pad(size, (0, pad), constant_values=1).astype(np.int64)


def pack(ids: np.ndarray, n: np.ndarray, codes: np.ndarray, lengths: np.ndarray
         ) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """Bits of all documents, the first byte of each and the end, all checkpoints and the number of each."""
    size = lengths.astype(np.uint8)[ids]
    run = np.cumsum(size, dtype=np.int64)
    ends = np.cumsum(n)
    first = ends - n
    begin = run[first] - size[first]
    byte = np.concatenate([[0], np.cumsum((run[ends - 1] - begin + 7) // 8)])
    bit = run - size + np.repeat(byte[:-1] * 8 - begin, n)
    word = bit >> 5
    value = codes[ids] << (64 - size - (bit & 31)).astype(np.uint64)
    # the bits of a token lie in its word and the next one; tokens of a word are neighbours
    heads = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
    at = word[heads]
    out = np.zeros(int(byte[-1] + 3) // 4 + 2, np.uint32)
    out[at] = np.bitwise_or.reduceat((value >> np.uint64(32)).astype(np.uint32), heads)
    out[at + 1] |= np.bitwise_or.reduceat(value.astype(np.uint32), heads)
    blocks = (n + BLOCK - 1) // BLOCK
    heads = np.repeat(first, blocks) + (np.arange(int(blocks.sum())) - np.repeat(np.cumsum(blocks) - blocks, blocks)) * BLOCK
    return out.astype(">u4").tobytes(), byte, bit[heads] - np.repeat(byte[:-1] * 8, blocks), blocks


def unpack(payload: bytes, marks: np.ndarray, n: np.ndarray, table: tuple) -> np.ndarray:
    """Ids of a segment: n ids per document, marks the bit offset of every block."""
    bits, symbol, size = table
    blocks = (n + BLOCK - 1) // BLOCK
    last = np.cumsum(blocks) - 1
    count = np.full(int(blocks.sum()), BLOCK)
    count[last] = n - (blocks - 1) * BLOCK
    begin = np.cumsum(count) - count
    order = np.argsort(-count, kind="stable")
    pos, to = marks[order].astype(np.int64), begin[order]
    live = len(count) - np.searchsorted(np.sort(count), np.arange(BLOCK), "right")   # blocks longer than t
    words = np.frombuffer(payload + bytes(12 - len(payload) % 4), ">u4").astype(np.uint64)
    out = np.empty(int(n.sum()), np.uint32)
    shift = np.uint64(64 - bits)
    for t in range(int(count.max(initial=0))):
        k = int(live[t])
        pos, to = pos[:k], to[:k]
        w = pos >> 5
        x = (((words[w] << np.uint64(32)) | words[w + 1]) << (pos & 31).astype(np.uint64)) >> shift
        out[to + t] = symbol[x]
        pos = pos + size[x]
    return out


def tokenized(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n, ids): ids as little-endian numbers of 16 bits, or 32 for a vocabulary beyond.

    A last row of each task, with n = -1, has its counts of all ids instead.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pieces_of(path)
        size = max(p.tokenizer.get_vocab_size(with_added_tokens=True), END + 1)
        kind, names, seen = id_type(size), ["doc_id", "n", "ids"], np.zeros(size, np.int64)
        for batch in batches:
            for b in groups(batch):
                ids, n = p.encode(b.column(1))
                seen += np.bincount(ids, minlength=size)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int32()), rows_of(ids.astype(kind), n)], names)
        yield pa.RecordBatch.from_arrays(
            [pa.array([None], pa.int64()), pa.array([-1], pa.int32()), pa.array([seen.astype("<i8").tobytes()], pa.binary())], names)

    return docs.mapInArrow(run, "doc_id long, n int, ids binary")


def id_type(vocabulary: int) -> str:
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows of about PACK ids at a time: what the processor's cache holds."""
    run = np.cumsum(batch.column(1).to_numpy(), dtype=np.int64)
    at = 0
    while at < len(run):
        to = max(at + 1, int(np.searchsorted(run, (run[at - 1] if at else 0) + PACK, "right")))
        yield batch.slice(at, to - at)
        at = to


def rows_of(values: np.ndarray, n: np.ndarray) -> pa.Array:
    """A binary row for each n values."""
    data = values.tobytes()
    ends = np.concatenate([[0], np.cumsum(n)]) * values.itemsize
    return pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data)])


def values_of(column: pa.Array, kind: str) -> np.ndarray:
    """All values of the binary rows, end to end."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    if not len(column) or offsets[0] == offsets[-1]:
        return np.empty(0, kind)
    return np.frombuffer(memoryview(column.buffers()[2])[int(offsets[0]):int(offsets[-1])], kind)


def count_ids(counts: DataFrame) -> np.ndarray:
    """Sum of the tasks' counts by id; the vocabulary bounds the result."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.column(0).to_pylist():
                seen = np.frombuffer(row, "<i8")
                at = np.flatnonzero(seen)
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], ["id", "n"])

    found = counts.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(max([END, *(r["id"] for r in found)]) + 1, np.int64)
    for r in found:
        out[r["id"]] = r["n"]
    return out


def write_ids(docs: DataFrame, tokenizer: str, out: str, limit: int = LIMIT) -> None:
    """Write the ids of docs (doc_id, text) under ``out`` as code/ and segments/."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    table = cut(tokenized(docs, tokenizer), "tokens", "snappy")
    tokens = table.where("n >= 0")
    kind = id_type(pieces_of(tokenizer).tokenizer.get_vocab_size(with_added_tokens=True))
    lengths = code_lengths(count_ids(table.where("n < 0")), limit)
    codes = canonical(lengths)
    spark.createDataFrame([(int(i), int(lengths[i])) for i in np.flatnonzero(lengths)], "id long, length int") \
        .coalesce(1).write.parquet(f"{out}/code")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (part for whole in batches for part in slices(whole)):
            ids, n = values_of(b.column(2), kind), b.column(1).to_numpy().astype(np.int64)
            payload, byte, marks, blocks = pack(ids, n, codes, lengths)
            yield pa.RecordBatch.from_arrays([
                b.column(0), b.column(1), rows_of(np.frombuffer(payload, np.uint8)[:byte[-1]], np.diff(byte)),
                rows_of(marks.astype("<i8"), blocks)], ["doc_id", "n", "payload", "marks"])

    # parts of ascending doc ids from quantiles of the ids alone, so that no text is read for them
    rows = tokens.count()
    parts = max(1, min(rows // PART, 1 << 14))
    bounds = tokens.agg(F.percentile_approx("doc_id", [i / parts for i in range(1, parts)] or [0.5], 20 * parts + 1000)).first()[0]
    bounds = sorted({b for b in bounds or [] if b is not None}) if parts > 1 else []
    from wattline.llm.shard import range_of
    part = F.coalesce(range_of(F.col("doc_id"), bounds), F.lit(0)).cast("int")

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["part", "seg", "doc_ids", "n", "marks", "payload"]

        def close():
            return pa.RecordBatch.from_arrays([
                pa.array([now], pa.int32()), pa.array([seg], pa.int32()), pa.array([ids], pa.list_(pa.int64())),
                pa.array([n], pa.list_(pa.int32())), pa.array([np.concatenate(marks).astype("<i8").tobytes()], pa.binary()),
                pa.array([b"".join(load)], pa.binary())], names)
        now, seg, ids, n, marks, load, held = None, 0, [], [], [], [], 0
        for b in batches:
            for d, k, data, m, p in zip(*(b.column(c).to_pylist() for c in ("doc_id", "n", "payload", "marks", "part")), strict=True):
                if ids and (p != now or held >= SEGMENT):
                    yield close()
                    seg, ids, n, marks, load, held = seg + 1 if p == now else 0, [], [], [], [], 0
                elif p != now:
                    seg = 0
                now = p
                marks.append(np.frombuffer(m, "<i8") + held * 8)
                ids.append(d)
                n.append(k)
                load.append(data)
                held += len(data)
        if ids:
            yield close()

    tokens.mapInArrow(encode, "doc_id long, n int, payload binary, marks binary").withColumn("part", part) \
        .repartition("part").sortWithinPartitions("part", "doc_id", "n", "payload") \
        .mapInArrow(segments, "part int, seg int, doc_ids array<long>, n array<int>, marks binary, payload binary") \
        .write.option("compression", "uncompressed").parquet(f"{out}/segments")


def read_ids(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of the files, with the ids if asked for."""
    schema = "part int, seg int, doc_ids array<long>, n array<int>, marks binary, payload binary"
    files = spark.read.schema(schema).parquet(f"{path}/segments")
    code = spark.read.parquet(f"{path}/code").collect()  # bounded by the vocabulary
    lengths = np.zeros(max([0, *(r["id"] for r in code)]) + 1, np.int64)
    for r in code:
        lengths[r["id"]] = r["length"]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = decoder(lengths)
        for b in batches:
            for part, seg, doc_ids, n, marks, payload in zip(*(b.column(i).to_pylist() for i in range(6)), strict=True):
                n = np.array(n, np.int64)
                raw = unpack(payload, np.frombuffer(marks, "<i8"), n, look).astype("<u4")
                ends = np.cumsum(n)
                spans = [raw[a:e] for a, e in zip((ends - n).tolist(), ends.tolist(), strict=True)]
                cols = [pa.array(np.full(len(n), part, np.int32)), pa.array(np.full(len(n), seg, np.int32)),
                        pa.array(doc_ids, pa.int64()), pa.array(ends - n), pa.array(n),
                        pa.array([zlib.crc32(s) for s in spans], pa.int64())]
                names = ["part", "seg", "doc_id", "before", "n_tokens", "ids_crc32"]
                if with_ids:
                    cols, names = [*cols, pa.array([s.astype(np.int64) for s in spans], pa.list_(pa.int64()))], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(cols, names)

    # where each segment starts: sums of parts, then of segments inside a part
    sizes = files.select("part", "seg", F.aggregate("n", F.lit(0).cast("long"), lambda a, x: a + x).alias("k"))
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = sizes.groupBy("part").agg(F.sum("k").alias("k")) \
        .select("part", F.coalesce(F.sum("k").over(ahead), F.lit(0)).alias("p0"))  # at most 2**14 parts
    inside = Window.partitionBy("part").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("s0", F.coalesce(F.sum("k").over(inside), F.lit(0))).join(totals, "part") \
        .select("part", "seg", (F.col("p0") + F.col("s0")).alias("at"))
    kind = "part int, seg int, doc_id long, before long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    return files.mapInArrow(decode, kind).join(starts, ["part", "seg"]).select(
        "doc_id", (F.col("at") + F.col("before")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = f"{shared_dir(spark)}/ids-{uuid.uuid4().hex}"
    write_ids(table(spark, sf_dir, "documents"), word_tokenizer(), out)
    return read_ids(spark, out)

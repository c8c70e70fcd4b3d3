"""Language-model scores by deleted interpolation.

P_k(w | history) = l P_ML(w | last k - 1 tokens) + (1 - l) P_(k-1), from the unigram
(mixed with 1 / (V + 1)) up to order ORDER. l depends on the order and on the
bucket (whole log2) of how often the context was seen. It is learned on held-out
counts by deletion: the training documents are four parts (crc32(doc_id) mod 5 is 0,
2, 3 or 4); every token of a part is an event whose counts are those of the other
three parts, and expectation-maximisation sets the weights, order by order.

Distribution. Texts are cut into blocks, as codes into the block's own list of words. A
block sends each of its different n-grams once, with its counts by part, to
the place that a hash names, so an n-gram, however frequent, comes at most once
from a block; places hold at most about PLACE entries. There the counts add up, a range of hashes after the other, and the
totals by part go back to the block in the order they came. What travels are packed arrays, a row for each block and place:
these rows are as many as blocks times places, so both are as large as a task's memory allows.
Blocks are not written before they are counted: they are cut once for the requests and
once more for the answers. A block's key is a digest of its place in the scan and
of its codes, so blocks cut in another way find no answer, which is an error. The answers
are written before they go back, so that the shuffle that brought the requests can be dropped.
The events of a pass over the blocks become a histogram of likelihood ratios by order
and bucket (BINS a bucket; a bin counts its events and has their mean ratio), which
bounds what the driver sees; all events are in it, and EM runs on it.

Words are known by 64-bit hashes: two of m different words of the corpus share one by
a chance of m * m / 2**65. Longer n-grams are known by place and 42 bits, so a count is
mixed with a strange one by a chance of PLACE / 2**42, one in a million, at any size.

A null text is an empty one: its only token is the end. A null doc_id is learned from,
in part 0. Repeated rows are documents like others. Very long texts are whole. With
no training document all words are unknown and every token has probability 1. Where
all training documents are of one part, deleting it leaves no count, and the weights
of all orders are 0. Columns besides
doc_id and text are ignored; an empty table gives no row.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.llm.common import cut_last, table, whole_groups

ORDER, HELD, PARTS = 3, 1, 5
#: The training parts: a count has a lane for each.
TRAIN = [p for p in range(PARTS) if p != HELD]
LANES = len(TRAIN)
#: Bytes of text in a block's slice of a batch, entries at a place and those of it that are added up at a time.
SLICE, PLACE, RANGE_OF = 6 << 20, 4_000_000, 1 << 19
#: Bits by which a longer n-gram is known at its place.
BITS = 42
END, BEGIN = 0x9E3779B97F4A7C15, 0xD1B54A32D192ED03
#: Histogram of ln(ratio): BINS bins over +-RANGE, bin 0 for a ratio of zero.
BUCKETS, BINS, RANGE = 48, 2561, 40.0


def part(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % PARTS, F.lit(0)).cast("int")


def tokens(texts: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The different words in ASCII lower case, their places in the texts' tokens (-1 for an end), and where the texts end.

    Arrow splits at the white space of the contract; an empty string before or after it is no word.
    """
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    flat = lists.flatten().dictionary_encode()
    words = flat.dictionary.cast(pa.large_binary()).to_numpy(zero_copy_only=False).tolist()
    code, is_word = flat.indices.to_numpy(zero_copy_only=False), np.array([bool(w) for w in words], bool)
    real = is_word[code]
    of = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))[real]
    ends = np.cumsum(np.bincount(of, minlength=len(texts)) + 1)
    seen = np.full(len(of) + len(texts), -1, np.int32)
    seen[np.arange(len(of)) + of] = (np.cumsum(is_word) - 1)[code[real]]
    return [w for w in words if w], seen, ends


def ranked(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """np.unique() of whole numbers from 0 on, with the inverse, at a fraction of its time.

    Numbers that hold a key and its place are sorted as they are, without a list of places beside them. Where both do not
    fit 64 bits the keys' lowest bits are left out, and the few keys that differ in those alone are put in order after it.
    """
    n = len(x)
    if not n:
        return x, np.empty(0, np.int64)
    keys = x.astype(np.uint64, copy=False)
    bits = np.uint64(max(1, (n - 1).bit_length()))
    drop = np.uint64(max(0, int(keys.max()).bit_length() + int(bits) - 64))
    packed = ((keys >> drop) << bits) | np.arange(n, dtype=np.uint64)
    packed.sort()
    at = (packed & ((np.uint64(1) << bits) - np.uint64(1))).view(np.int64)
    if drop:
        ordered = keys[at]
        if (ordered[1:] < ordered[:-1]).any():
            again = np.argsort(ordered, kind="stable")     # nearly in order, which this sort makes use of
            at, ordered = at[again], ordered[again]
    else:
        ordered = packed >> bits
    new = np.ones(n, bool)
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    inverse = np.empty(n, np.int64)
    inverse[at] = np.cumsum(new) - 1
    return ordered[new].astype(x.dtype, copy=False), inverse


BLOCK = "block long, ids array<long>, parts binary, ends binary, words binary, codes binary"


def texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), part(F.col("doc_id")).alias("part"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


@dataclass
class Parsed:
    """A block: its key, its documents (ids, parts, ends in codes), its words' hashes, ascending, and the codes into them."""
    key: int
    ids: pa.Array
    parts: np.ndarray
    ends: np.ndarray
    words: np.ndarray
    codes: np.ndarray


def parsed(place: tuple[int, int], ids: pa.Array, parts: np.ndarray, text: pa.Array) -> Parsed:
    different, seen, ends = tokens(text)
    hashes = np.array([xxhash.xxh64_intdigest(w, 42) for w in different] + [END], np.uint64)
    words, code = ranked(hashes)                              # the end, -1, is the last hash
    codes = code.astype("<u4")[seen]
    key = xxhash.xxh64_intdigest(np.array([*place, xxhash.xxh64_intdigest(codes) >> 1], "<i8").tobytes())
    return Parsed(key >> 1, ids, parts.astype(np.uint8), ends.astype("<i8"), words, codes)


def block(p: Parsed) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([p.key], pa.int64()), pa.array([p.ids.to_pylist()], pa.list_(pa.int64())), pa.array([p.parts.tobytes()], pa.binary()),
         pa.array([p.ends.tobytes()], pa.binary()), pa.array([hashes_packed(p.words)], pa.binary()),
         pa.array([planed(p.codes)], pa.binary())], names(BLOCK))


def parsed_of(batches: Iterator[pa.RecordBatch]) -> Iterator[Parsed]:
    """Blocks of the rows of texts()."""
    task, n = TaskContext.get().partitionId(), 0
    for b in batches:
        size = np.cumsum(pc.binary_length(b.column(2)).to_numpy(zero_copy_only=False).astype(np.int64))
        slices = max(1, -(-int(size[-1]) // SLICE)) if b.num_rows else 0
        cuts = np.flatnonzero(np.diff(np.minimum(size * slices // max(int(size[-1]), 1), slices - 1))) + 1 if slices else []
        for lo, hi in zip([0, *cuts], [*cuts, b.num_rows], strict=True):
            if hi > lo:
                s = b.slice(lo, hi - lo)
                n += 1
                yield parsed((task, n), s.column(0), s.column(1).to_numpy(), s.column(2))


def blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """BLOCK rows of the rows of texts()."""
    return map(block, parsed_of(batches))


def tokenized(docs: DataFrame) -> DataFrame:
    """BLOCK rows: whole documents and their parts, the end of each counted in.

    ``words`` are the different hashes of the block, ascending; ``codes``
    index them (both packed). ``ends`` are positions in codes where documents end.
    """
    return texts(docs).mapInArrow(blocks_of, BLOCK)


def names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


@functools.cache
def zstd() -> tuple[zstandard.ZstdCompressor, zstandard.ZstdDecompressor]:
    """A worker's own, made once: it packs very many small arrays."""
    return zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def squeezed(raw: bytes) -> bytes:
    """Bytes for the shuffle: codes and counts shrink far below what Spark's own compression makes of them."""
    return zstd()[0].compress(raw)


def released(raw: bytes) -> bytes:
    return zstd()[1].decompress(raw)


def mixed(a: np.ndarray, b: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit hash of two hashes."""
    with np.errstate(over="ignore"):
        x = (a ^ np.uint64(seed)) * np.uint64(0xFF51AFD7ED558CCD)
        x = ((x ^ (x >> np.uint64(32))) + b) * np.uint64(0xC4CEB9FE1A85EC53)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(32))


@dataclass
class Grams:
    """n-grams of a block by order: how many different ones, each token's index among them, and their hashes, if asked for."""
    sizes: list[int]
    at: list[np.ndarray]
    starts: np.ndarray
    hashes: list[np.ndarray]


def grams(words: np.ndarray | int, codes: np.ndarray, ends: np.ndarray, order: int) -> Grams:
    """``words`` are their hashes, or just how many there are."""
    hashed = not isinstance(words, int)
    n = len(words) if hashed else words
    bits = n.bit_length()
    starts = np.concatenate([[0], ends[:-1]])
    sizes, at, hashes = [n], [codes.astype(np.int64)], [words] if hashed else []
    for k in range(2, order + 1):
        before = np.empty(len(codes), np.int64)
        before[1:] = at[-1][:-1]
        before[starts] = sizes[-1]                    # the begin of a document
        key, index = ranked((before << bits) | at[0])
        if hashed:
            history = np.append(hashes[-1], np.uint64(BEGIN))[key >> bits]
            hashes.append(mixed(history, words[key & ((1 << bits) - 1)], k))
        sizes.append(len(key))
        at.append(index)
    return Grams(sizes, at, starts, hashes)


def places(h: np.ndarray, n: int) -> np.ndarray:
    return ((h >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)


@dataclass
class Sent:
    """What a block sends: words by place and hash; longer n-grams by place and BITS bits, equal ones once."""
    word_place: np.ndarray
    keys: np.ndarray
    index: np.ndarray


def sent(g: Grams, n: int) -> Sent:
    place = places(g.hashes[0], n)                    # hashes ascend, and so do their places
    longer = np.concatenate([np.empty(0, np.uint64), *g.hashes[1:]])
    keys, index = ranked((places(longer, n) << np.uint64(BITS)) | (longer & np.uint64((1 << BITS) - 1)))
    return Sent(place, keys, index)


def deltas(low: np.ndarray) -> bytes:
    """Ascending numbers as differences, of as many bytes each as the largest one needs.

    Only the bytes above the third have a shape worth compressing; they go last, by themselves.
    """
    d = np.diff(low, prepend=np.uint64(0))
    size = max(4, -(-int(d.max(initial=0)).bit_length() // 8))
    planes = d.astype("<u8").view(np.uint8).reshape(-1, 8)
    return bytes([size]) + planes[:, :3].tobytes() + squeezed(planes[:, 3:size].T.tobytes())


def undeltas(raw: bytes, n: int) -> np.ndarray:
    size, planes = raw[0], np.zeros((n, 8), np.uint8)
    planes[:, :3] = np.frombuffer(raw, np.uint8, 3 * n, offset=1).reshape(n, 3)
    planes[:, 3:size] = np.frombuffer(released(raw[1 + 3 * n:]), np.uint8).reshape(size - 3, n).T
    return np.cumsum(planes.view("<u8")[:, 0])


def planed(x: np.ndarray) -> bytes:
    """Whole numbers byte plane by byte plane, packed: the upper planes are nearly all zero."""
    return squeezed(np.ascontiguousarray(x.view(np.uint8).reshape(-1, x.itemsize).T).tobytes())


def unplaned(raw: bytes, n: int) -> np.ndarray:
    raw = released(raw)
    size = len(raw) // n
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, n).T).view(f"<u{size}")[:, 0]


def hashes_packed(h: np.ndarray) -> bytes:
    """Ascending hashes as their number and differences, whose top bytes are small."""
    return len(h).to_bytes(4, "little") + (planed(np.diff(h, prepend=np.uint64(0))) if len(h) else b"")


def hashes_read(raw: bytes) -> np.ndarray:
    n = int.from_bytes(raw[:4], "little")
    return np.cumsum(unplaned(raw[4:], n).astype(np.uint64)) if n else np.empty(0, np.uint64)


def small(x: np.ndarray) -> bytes:
    return planed(narrow(x))


def large(raw: bytes, n: int) -> np.ndarray:
    return unplaned(raw, n).astype(np.int64) if n else np.empty(0, np.int64)


def block_of(r: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return hashes_read(r["words"]), *codes_of(r)


def codes_of(r: dict) -> tuple[np.ndarray, np.ndarray]:
    ends = np.frombuffer(r["ends"], "<i8")
    return unplaned(r["codes"], int(ends[-1])).astype(np.int32), ends


def lane_of(parts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Of each token its document's lane; LANES if it is held out."""
    lanes = np.full(PARTS, LANES, np.int64)
    lanes[TRAIN] = np.arange(LANES)
    return np.repeat(lanes[parts], np.diff(ends, prepend=0))


def narrow(x: np.ndarray) -> np.ndarray:
    """Counts in the fewest of 1, 2, 4 or 8 bytes each."""
    top = int(x.max(initial=0))
    return x.astype("<u1" if top < 1 << 8 else "<u2" if top < 1 << 16 else "<u4" if top < 1 << 32 else "<u8")


def lanes_coded(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts by lane: most n-grams were seen once or never, which takes a code of a byte before packing; the rest are listed."""
    if not x.shape[1]:
        return np.empty(0, np.uint8), np.empty((LANES, 0), np.uint8)
    total, code = x.sum(0), np.full(x.shape[1], LANES + 1, np.uint8)
    code[total == 0] = LANES
    for i in range(LANES):
        code[(total == 1) & (x[i] == 1)] = i
    return code, narrow(x[:, code > LANES])


def lanes_joined(coded: list[tuple[np.ndarray, np.ndarray]]) -> bytes:
    codes = squeezed(np.concatenate([c for c, _ in coded]).tobytes())
    return len(codes).to_bytes(4, "little") + codes + small(np.concatenate([x for _, x in coded], axis=1).ravel())


def lanes_packed(x: np.ndarray) -> bytes:
    return lanes_joined([lanes_coded(x)])


def lanes_split(raw: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The codes and the counts listed, as lanes_coded() gives them."""
    if not n:
        return np.empty(0, np.uint8), np.empty((LANES, 0), np.uint8)
    at = 4 + int.from_bytes(raw[:4], "little")
    code = np.frombuffer(released(raw[4:at]), np.uint8)
    listed = LANES * int(np.count_nonzero(code > LANES))
    return code, (unplaned(raw[at:], listed) if listed else np.empty(0, np.uint8)).reshape(LANES, -1)


def lanes_wide(code: np.ndarray, listed: np.ndarray) -> np.ndarray:
    """Counts by lane, as int32 where the bytes listed tell that it is enough."""
    out = np.zeros((LANES, len(code)), np.int32 if listed.itemsize < 4 else np.int64)
    for i in range(LANES):
        out[i] = code == i
    out[:, code > LANES] = listed
    return out


def lanes_upto(raw: bytes, n: int, upto: int) -> np.ndarray:
    """Counts by lane of the first ``upto`` of ``n``."""
    code, listed = lanes_split(raw, n)
    code = code[:upto]
    return lanes_wide(code, listed[:, :int(np.count_nonzero(code > LANES))])


def lanes_read(raw: bytes, n: int) -> np.ndarray:
    return lanes_upto(raw, n, n)


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows one by one: a block's row is large, a batch holds many."""
    for b in batches:
        for i in range(b.num_rows):
            yield b.slice(i, 1).to_pylist()[0]


CELL = "block long, place long, n_words int, words binary, word_counts binary, n int, keys binary, counts binary"


def requests(docs: DataFrame, n_places: int, order: int) -> DataFrame:
    """A row for each block and place: the different n-grams of the block that live there, with their counts by part.

    Blocks are made in the same worker: another one for them would hold as much memory again.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return map(cells, parsed_of(batches))

    def cells(p: Parsed) -> pa.RecordBatch:
        words = p.words
        g = grams(words, p.codes, p.ends, order)
        s = sent(g, n_places)
        lane = lane_of(p.parts, p.ends)

        def by_lane(index: np.ndarray, size: int) -> np.ndarray:
            return np.bincount(lane * size + index, minlength=(LANES + 1) * size)[:LANES * size].reshape(LANES, size).astype(np.int32)

        of_words = by_lane(g.at[0], len(words))
        longer = np.zeros((LANES, len(s.keys)), np.int32)
        apart, at = len(s.keys) == len(s.index), 0         # no two n-grams share a key, as nearly always
        for index, size in zip(g.at[1:], g.sizes[1:], strict=True):
            to, own = s.index[at:at + size], by_lane(index, size)
            for i in range(LANES):
                if apart:
                    longer[i, to] = own[i]
                else:
                    np.add.at(longer[i], to, own[i])
            at += size
        place = np.unique(np.concatenate([s.word_place, s.keys >> np.uint64(BITS)]))
        w = np.searchsorted(s.word_place, np.append(place, np.uint64(n_places)))
        k = np.searchsorted(s.keys >> np.uint64(BITS), np.append(place, np.uint64(n_places)))
        low = s.keys & np.uint64((1 << BITS) - 1)
        cols = [[p.key] * len(place), place.astype(np.int64), np.diff(w).astype(np.int32),
                [hashes_packed(words[i:j]) for i, j in zip(w, w[1:])], [lanes_packed(of_words[:, i:j]) for i, j in zip(w, w[1:])],
                np.diff(k).astype(np.int32), [deltas(low[i:j]) for i, j in zip(k, k[1:])],
                [lanes_packed(longer[:, i:j]) for i, j in zip(k, k[1:])]]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int32(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names(CELL))

    return texts(docs).mapInArrow(run, CELL)


def totals(keys: list[np.ndarray], counts: list[bytes]) -> tuple[list[bytes], int]:
    """Of each cell, its keys ascending, the sums (by lane) over equal keys of all cells, and how many keys training has.

    Counts come and go packed. Ranges of keys are added up one after the other, so that a range is all that is held wide.
    """
    full = [k for k in keys if len(k)]
    low, top = min((int(k[0]) for k in full), default=0), max((int(k[-1]) for k in full), default=0)
    ranges = max(1, -(-sum(map(len, full)) // RANGE_OF))
    edges = np.array([low + (top - low + 1) * i // ranges for i in range(1, ranges)], np.uint64)
    cuts = [[0, *np.searchsorted(k, edges).tolist(), len(k)] for k in keys]
    coded, used = [lanes_split(x, len(k)) for k, x in zip(keys, counts, strict=True)], [0] * len(keys)
    out, known = [[] for _ in keys], 0
    for r in range(ranges):
        different, g = ranked(np.concatenate([k[c[r]:c[r + 1]] for k, c in zip(keys, cuts, strict=True)]))
        n = len(different)
        own, more = [], []
        for j, ((code, listed), c) in enumerate(zip(coded, cuts, strict=True)):
            at, code = used[j], code[c[r]:c[r + 1]]
            used[j] += int(np.count_nonzero(code > LANES))
            own.append(code)
            more.append(listed[:, at:used[j]])
        code, more = np.concatenate(own), np.concatenate(more, axis=1)
        # those seen once by their codes, those listed by their counts
        total = np.bincount(code * np.int64(n) + g, minlength=(LANES + 2) * n)[:LANES * n].reshape(LANES, n)
        listed = g[code > LANES]
        for i in range(LANES):
            total[i] += np.bincount(listed, weights=more[i], minlength=n).astype(np.int64)
        known += int(total.any(0).sum())
        code, at = lanes_coded(total)[0], 0
        for o, c in zip(out, cuts, strict=True):
            to = g[at:(at := at + c[r + 1] - c[r])]
            found = code[to]
            o.append((found, narrow(total[:, to[found > LANES]])))
    return [lanes_joined(o) for o in out], known


ANSWER = "block long, place long, known long, n_words int, word_total binary, n int, total binary"


def answers(cells: DataFrame, n_places: int) -> DataFrame:
    """Cells with counts replaced by totals; ``known`` is the place's number of training words, on its first row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, ["place"]):
            place = t.column("place").to_numpy()
            edges = np.flatnonzero(np.diff(place, prepend=place[0] - 1))
            for lo, hi in zip(edges, [*edges[1:], len(place)], strict=True):
                yield answer(t.slice(lo, hi - lo).to_pydict())

    def answer(t: dict) -> pa.RecordBatch:
        (wt, known), (gt, _) = (
            totals([read(x, m) for x, m in zip(t[keys], t[size], strict=True)], t[counts])
            for size, keys, counts, read in (("n_words", "words", "word_counts", lambda x, n: hashes_read(x)),
                                             ("n", "keys", "counts", undeltas)))
        return pa.RecordBatch.from_arrays([
            pa.array(t["block"], pa.int64()), pa.array(t["place"], pa.int64()), pa.array([known] + [0] * (len(gt) - 1), pa.int64()),
            pa.array(t["n_words"], pa.int32()), pa.array(wt, pa.binary()), pa.array(t["n"], pa.int32()), pa.array(gt, pa.binary())], names(ANSWER))

    # a place each, whose size is bounded: hashes would put several into some tasks
    return cells.repartitionById(n_places, F.col("place").cast("int")).sortWithinPartitions("place", "block").mapInArrow(run, ANSWER)


COUNTED = "block long, ids array<long>, parts binary, ends binary, n_words int, codes binary, known long, n int, totals binary"


def counted(blocks: DataFrame, found: DataFrame, n_places: int, order: int) -> DataFrame:
    """Blocks with the totals by part of their different n-grams, order by order as grams() lists them."""
    both = blocks.select("block", F.lit(-1).cast("long").alias("place"), "ids", "parts", "ends", "words", "codes") \
        .unionByName(found, allowMissingColumns=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, got = None, []
        for r in rows_of(batches):
            if r["place"] < 0:
                if head is not None:
                    yield joined(head, got)
                head, got = r, []
            else:
                if head is None or head["block"] != r["block"]:
                    raise RuntimeError("answers for a block that is not there: the documents changed between two scans")
                got.append(r)
        if head is not None:
            yield joined(head, got)

    def joined(head: dict, got: list[dict]) -> pa.RecordBatch:
        words, codes, ends = block_of(head)
        s = sent(grams(words, codes, ends, order), n_places)
        if sum(r["n_words"] for r in got) != len(words) or sum(r["n"] for r in got) != len(s.keys):
            raise RuntimeError("a block without its answers: the documents changed between two scans")
        coded = [lanes_split(r["word_total"], r["n_words"]) for r in got]
        longer = [lanes_split(r["total"], r["n"]) for r in got]
        code = np.concatenate([c for c, _ in longer])
        listed, at = np.concatenate([x for _, x in longer], axis=1), np.cumsum(code > LANES) - 1
        code = code[s.index]
        coded.append((code, listed[:, at[s.index[code > LANES]]]))
        cols = [[head["block"]], [head["ids"]], [head["parts"]], [head["ends"]], [len(words)], [head["codes"]],
                [sum(r["known"] for r in got)], [len(words) + len(code)], [lanes_joined(coded)]]
        kinds = [pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.int32(), pa.binary(), pa.int64(), pa.int32(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names(COUNTED))

    return cut_last(both.repartition("block").sortWithinPartitions("block", "place").mapInArrow(run, COUNTED), "counted")


@dataclass
class Model:
    """Sizes of the training set by lane (documents, tokens), its number of words, and the weights by order and bucket."""
    docs: np.ndarray
    size: np.ndarray
    vocabulary: int
    weights: list[np.ndarray]
    order: int


def buckets(n: np.ndarray) -> np.ndarray:
    """0 for an unseen context, then whole log2 + 1."""
    return np.where(n > 0, np.frexp(np.maximum(n, 1).astype(np.float64))[1], 0)


def mixture(r: dict, m: Model, delete: bool, upto: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, Grams, np.ndarray]:
    """Per token the ML estimate of order ``upto``, its context's bucket and the mixture of the orders below.

    With ``delete`` only for tokens of training documents, whose counts are without their own part. Also
    the n-grams, and each token's count in all of the training set.
    """
    codes, ends = codes_of(r)
    g = grams(r["n_words"], codes, ends, upto)
    lanes = np.split(lanes_upto(r["totals"], r["n"], sum(g.sizes)), np.cumsum(g.sizes)[:-1], axis=1)
    lane = lane_of(np.frombuffer(r["parts"], np.uint8), ends)
    held = lane == LANES

    def at(k: int) -> np.ndarray:
        """Of each token the count of its n-gram of order k."""
        total = lanes[k - 1].sum(0)
        # without the token's own lane, or none
        return np.vstack([total - lanes[k - 1], total]).ravel()[lane * len(total) + g.at[k - 1]] if delete else total[g.at[k - 1]]

    def of(x: np.ndarray) -> np.ndarray:
        """Of each token a size of the training set."""
        return np.append(x.sum() - x, x.sum())[lane] if delete else np.full(len(codes), x.sum())

    below = np.full(len(codes), 1.0 / (m.vocabulary + 1))
    context = of(m.size)
    for k in range(1, upto + 1):
        count = at(k)
        ml, bucket = count / np.maximum(context, 1), buckets(context)
        if k < upto:
            w = m.weights[k - 1][bucket]
            below = w * ml + (1 - w) * below
            context = np.empty(len(codes), np.int64)     # the count of the n-gram before is that of the context
            context[1:] = count[:-1]
            context[g.starts] = of(m.docs)[g.starts]
    known = lanes[0].sum(0)[g.at[0]]
    if delete:
        keep = ~held
        return ml[keep], bucket[keep], below[keep], g, known
    return ml, bucket, below, g, known


def learned(blocks: DataFrame, m: Model, k: int) -> np.ndarray:
    """Weights of order k by bucket: EM on the held-out events, which a pass gathers as a histogram."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc = np.zeros((2, BUCKETS * BINS))
        for r in rows_of(batches):
            ml, bucket, below, _, _ = mixture(r, m, True, k)
            with np.errstate(divide="ignore"):
                ratio = np.clip(np.log(ml / below), -RANGE, RANGE)
            at = np.where(ml > 0, 1 + np.rint((ratio + RANGE) * ((BINS - 2) / (2 * RANGE))), 0).astype(np.int64)
            acc += [np.bincount(bucket * BINS + at, weights=w, minlength=BUCKETS * BINS) for w in (None, ratio)]
        at = np.flatnonzero(acc[0])
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), *map(pa.array, acc[:, at])], ["at", "n", "s"])

    rows = blocks.mapInArrow(run, "at int, n double, s double").groupBy("at").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect()
    events = np.zeros((2, BUCKETS * BINS))
    events[:, [r["at"] for r in rows]] = np.array([(r["n"], r["s"]) for r in rows]).reshape(-1, 2).T
    return em(*events.reshape(2, BUCKETS, BINS))


def em(events: np.ndarray, logs: np.ndarray, rounds: int = 500) -> np.ndarray:
    """Maximum-likelihood weight of each bucket, with one event more for and against; 0 for unseen contexts.

    ``events`` counts the events of a bin, ``logs`` is the sum of their ln(ratio):
    a bin stands for its mean.
    """
    mean = np.divide(logs, events, out=np.zeros_like(logs), where=events > 0)
    ratio = np.exp(mean)
    ratio[:, 0] = 0
    out = np.zeros(BUCKETS)
    for b in range(1, BUCKETS):
        n, w, r = events[b].sum(), 0.5, ratio[b]
        if not n:
            continue
        for _ in range(rounds):
            new = ((events[b] * (w * r / (w * r + 1 - w))).sum() + 1) / (n + 2)
            w, old = new, w
            if abs(w - old) < 1e-10:
                break
        out[b] = w
    return out


def fit(docs: DataFrame, order: int = ORDER) -> tuple[DataFrame, Model]:
    """Counted blocks of the documents, and the model."""
    chars = docs.agg(F.sum(F.length(F.col("text").cast("string")))).first()[0] or 0
    n_places = max(1, -(-int(chars) * order // (6 * PLACE)))       # a token takes six characters, about
    # written, the answers need the shuffle of the requests no more, the largest there is
    found = cut_last(answers(requests(docs, n_places, order), n_places), "answers")
    full = counted(tokenized(docs), found, n_places, order)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for parts, ends, known in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                parts, size = np.frombuffer(parts, np.uint8), np.diff(np.frombuffer(ends, "<i8"), prepend=0)
                docs = np.bincount(parts, minlength=PARTS)
                tokens = np.bincount(parts, weights=size, minlength=PARTS).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(TRAIN, pa.int32()), pa.array(docs[TRAIN]), pa.array(tokens[TRAIN]),
                                                  pa.array([known] + [0] * (LANES - 1))], ["part", "docs", "size", "known"])

    found = full.select("parts", "ends", "known").mapInArrow(measure, "part int, docs long, size long, known long") \
        .groupBy("part").agg(*[F.sum(c).alias(c) for c in ("docs", "size", "known")]).collect()
    of = {r.part: r for r in found}
    m = Model(*(np.array([of[p][c] if p in of else 0 for p in TRAIN], np.int64) for c in ("docs", "size")),
              sum(r.known for r in found), [], order)
    for k in range(1, order + 1):
        m.weights.append(learned(full, m, k))
    return full, m


def scores(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score): a row per document."""
    full, m = fit(docs, order)
    size = int(m.size.sum())
    kind = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in rows_of(batches):
            ml, bucket, below, g, c = mixture(r, m, False, order)
            w = m.weights[order - 1][bucket]
            best = np.log10(w * ml + (1 - w) * below)
            base = np.log10((c + 0.5) / (size + 0.5 * (m.vocabulary + 1)))
            ends = np.frombuffer(r["ends"], "<i8")
            yield pa.RecordBatch.from_arrays([
                pa.array(r["ids"], pa.int64()), pa.array(np.frombuffer(r["parts"], np.uint8) == HELD), pa.array(np.diff(ends, prepend=0)),
                pa.array(np.add.reduceat((c > 0).astype(np.int64), g.starts)), pa.array(np.full(len(ends), size)),
                pa.array(np.add.reduceat(base, g.starts)), pa.array(np.add.reduceat(best, g.starts))], names(kind))

    return full.mapInArrow(run, kind)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores(table(spark, sf_dir, "documents"))

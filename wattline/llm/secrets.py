"""Secret scans by dictionary-primed zstandard novelty.

Base patterns give spans of three kinds (assign, access, hex). Beyond them,
every token of SHORTEST characters or more that overlaps a sensitive context is
a candidate, whole. A context reaches REACH characters to both sides of a hint
word, on to the end of its statement (a line end, a semicolon, a stop before
white space), and through tokens that ``.``, ``:``, ``/``, ``=``, ``~`` or ``@`` join to it, so all
parts of a composite token belong to it. A candidate's
marginal compressed bytes are what a compressor primed with an identifier
dictionary and the surrounding text needs for the text with it over the text
without it; other occurrences of the candidate are taken out of the
surroundings, so copies do not hide each other. A candidate that costs at least NOVELTY bytes a character is
reported as kind ``novel``, unless a base span overlaps it; of a token that
holds a hint word and is not novel as a whole, the parts beside the hint are
candidates.

Offsets are code points, ends exclusive. Null texts count as empty; an empty
text has no span. Repeated rows give repeated rows, an empty table an empty
result. Whole texts are read whatever their length.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.llm.common import table

KINDS = ("assign", "access", "hex", "novel")
#: Fixed values of the base patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KEYS = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: Words that make a context sensitive.
CONTEXT = re.compile(r"passw|passphrase|secret|token|api.?key|access.?key|private.?key|credential|authorization|bearer"
                     r"|client.?id|signature|connection.?string|webhook", re.I)
HINTS = ("passw", "passphrase", "secret", "token", "key", "credential", "authorization", "bearer", "client", "signature",
         "connection", "webhook")
SHORTEST = 8
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_-]{{{SHORTEST},}}={{0,2}}")
GOES_ON = re.compile(r"[A-Za-z0-9+/_-][A-Za-z0-9+/_=-]|==")
#: A context reaches so many characters before and, at least, after the hint.
REACH = 64
#: Where the statement of a hint ends, and what joins tokens.
STATEMENT = re.compile(r"[\n;]|[.!?](?=\s)")
JOINED = re.compile(r"[A-Za-z0-9+/_=.:~@-]*")
#: Characters of surrounding text that prime the compressor.
AROUND = 512
NOVELTY = 0.62
LEVEL = 9

#: Identifiers and phrases that code and configuration are made of.
DICTIONARY = (
    "import from return class function const public private static void string integer boolean false true null none self "
    "this async await export default module require include define struct interface implements extends package "
    "username user_name email address host hostname localhost port database connection config configuration settings "
    "environment variable production development staging example placeholder changeme your_api_key_here "
    "authorization bearer basic header content-type application/json access_token refresh_token client_id "
    "client_secret secret_key private_key public_key api_key password passphrase credential signature webhook "
    "https://api.example.com/v1/ http://localhost:8080/ postgresql://user:password@host:5432/database "
    "aws_access_key_id aws_secret_access_key region us-east-1 bucket endpoint timeout retries version created_at "
    "updated_at description identifier reference document_id session_id request_id response status message error "
    "abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 00000000000000000000000000000000").encode()


@functools.lru_cache(maxsize=1)
def primed() -> zstandard.ZstdCompressor:
    known = zstandard.ZstdCompressionDict(DICTIONARY, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    known.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_content_size=False, write_checksum=False)


def base_spans(text: str, low: str) -> list[tuple[int, int, str]]:
    found = []
    if any(k in low for k in KEYS):
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def marginal(compressor: zstandard.ZstdCompressor, before: bytes, candidate: bytes, after: bytes) -> float:
    """Compressed bytes per byte that the candidate adds to its surroundings."""
    return (len(compressor.compress(before + candidate + after)) - len(compressor.compress(before + after))) / len(candidate)


def candidates(text: str) -> Iterator[tuple[int, int, list[tuple[int, int]]]]:
    """(start, end, parts beside the hints inside) of every token that overlaps a context."""
    hints = [m.span() for m in CONTEXT.finditer(text)]
    done, h, statement = 0, 0, -1
    for first, last in hints:
        if statement < last:
            ends = STATEMENT.search(text, last)
            statement = ends.start() if ends else len(text)
        a, end = max(done, first - REACH), max(min(len(text), last + REACH), statement)
        while done < a < len(text) and GOES_ON.match(text, a - 1):
            a -= 1                                  # a token may start before the context
        stop = max(end, JOINED.match(text, end - 1).end())
        for m in CANDIDATE.finditer(text, a, stop):
            if m.end() <= first - REACH:
                continue
            while h < len(hints) and hints[h][1] <= m.start():
                h += 1
            inside, k = [], h
            while k < len(hints) and hints[k][0] < m.end():
                inside.append(hints[k])
                k += 1
            edges = [m.start(), *(x for s in inside for x in s), m.end()]
            parts = [p.span() for x, y in zip(edges[::2], edges[1::2], strict=True) for p in CANDIDATE.finditer(text, x, y)]
            yield m.start(), m.end(), parts if inside else []
        done = max(done, stop)


def novel_spans(text: str, low: str, base: list[tuple[int, int, str]], compressor) -> list[tuple[int, int, str]]:
    if not any(h in low for h in HINTS):
        return []

    def novel(a: int, b: int) -> bool:
        if any(s < b and a < e for s, e, _ in base):
            return False
        token = text[a:b]
        around = text[max(0, a - AROUND):a].replace(token, ""), text[b:b + AROUND].replace(token, "")
        return marginal(compressor, around[0].encode(), token.encode(), around[1].encode()) >= NOVELTY

    found = []
    for a, b, parts in candidates(text):
        if novel(a, b):
            found.append((a, b, "novel"))
        else:
            found += [(x, y, "novel") for x, y in parts if novel(x, y)]
    return found


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, their digest, and all spans of each document."""
    names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor = primed()
        for b in batches:
            counts, digests, spans = [], [], []
            for t in b.column(1).to_pylist():
                text = t or ""
                low = text.lower()
                base = base_spans(text, low)
                kinds = [k for *_, k in base]
                counts.append([kinds.count(k) for k in KINDS[:3]])
                digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
                more = novel_spans(text, low, base, compressor)
                spans.append(joined(sorted(base + more, key=lambda s: (s[0], KINDS.index(s[2])))))
            cols = [pa.array([c[i] for c in counts], pa.int64()) for i in range(3)]
            yield pa.RecordBatch.from_arrays([b.column(0), *cols, pa.array(digests, pa.string()), pa.array(spans, pa.string())], names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))

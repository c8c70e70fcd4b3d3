"""Merkle manifest of a dataset by time-forward processing.

A row is a leaf; the leaves of a source, ascending by doc_id, are the bottom of a
tree of fan-out 16, and the subroots, ordered by source, are the bottom of one more
tree whose top is the root. A node's label is (tree, level, position). Nodes are
worked off in label order, and what a node sends waits in a priority queue for the
label it is sent to: digests go forward to parents, and in the reversed sweep the
siblings on the way to the root go back to the leaves.

The queue is external: between sweeps its messages are a written table, and Spark's
range partitioning and sort put them in label order. One sweep drains DEPTH levels,
so that the labels a task meets lie in aligned runs of FAN ** DEPTH nodes of one
tree, whatever the size of the tree; within a run a heap holds the messages. A
tree of a third of all rows is thereby spread like any other. The number of sweeps
is the logarithm of the largest source to base FAN ** DEPTH, both ways. Going back,
a run gets one message with the proof of its top; leaves get theirs in the task, so
no proof of a leaf is ever shuffled or written.

Leaves are numbered by one range sort; each partition's part of a source has its
count, and sums of these counts give positions.

Nulls count as ``-`` in a leaf. Within a source a null doc_id comes first, and rows
of one doc_id are ordered by their digests, so repeated rows have leaves (and
proofs) of their own and reruns agree. The null source comes first, then "". A lone leaf
is its subroot, a lone subroot the root, with the digest of no siblings as proof. A null doc_id is not
tampered with; tampering with a text without A-Z, or a null one, changes nothing,
so such a row verifies. An empty table gives no row. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattline.llm.common import cut, table

FAN, DEPTH = 16, 2
RUN = FAN ** DEPTH
#: Rows of a table that may be broadcast, after counting them.
SMALL = 100_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def digest(parts: list[bytes]) -> bytes:
    """H of digests, which are joined as hex text."""
    return hashlib.sha256(b"".join(parts).hex().encode()).digest()


def leaf(columns: dict[str, Column]) -> Column:
    """H of the fields of a row, as binary."""
    fields = [F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c))
              for c in (columns[f].cast("string") for f in FIELDS)]
    return F.unhex(F.sha2(F.concat(*fields).cast("binary"), 256))


def leaves(docs: DataFrame) -> DataFrame:
    """(tree, doc_id, leaf, tampered): tampered is null where the row isn't tampered with."""
    own = {f: F.col(f) for f in FIELDS}
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    # no tree is named "": the null source comes before all others
    tree = F.when(F.col("source").isNull(), F.lit("")).otherwise(F.concat(F.lit("+"), F.col("source").cast("string")))
    return docs.select(tree.alias("tree"), F.col("doc_id").cast("long").alias("doc_id"), leaf(own).alias("leaf"),
                       F.when(chosen, leaf({**own, "text": F.translate(F.col("text").cast("string"), UPPER, LOWER)})).alias("tampered"))


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """rows with pos (from 0 in each group, by ``order``) and n, the size of the group.

    ``order`` must end in something that tells equal rows apart, or a group of equal
    rows would be one range.
    """
    rows = cut(rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
               .withColumn("_at", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_at", 33)), "sorted")
    runs = rows.groupBy(group, "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    w = Window.partitionBy(group)
    runs = cut(runs.select(group, "_part", "_first", F.sum("_n").over(w).alias("n"),
                           (F.sum("_n").over(w.orderBy("_part")) - F.col("_n")).alias("_before")), "runs")
    if runs.count() <= SMALL:
        runs = F.broadcast(runs)
    return rows.join(runs, [group, "_part"]).withColumn("pos", F.col("_at") - F.col("_first") + F.col("_before")) \
        .drop("_at", "_part", "_first", "_before")


def width(n: int, level: int) -> int:
    """Nodes on a level of a tree of n leaves."""
    return -(-n // FAN ** level)


def height(n: int) -> int:
    h = 0
    while width(n, h) > 1:
        h += 1
    return h


def by_run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, Iterator[dict]]]:
    """Rows of runs in order, run by run; no more than a batch and a run are held."""
    rows = (r for b in batches for r in b.to_pylist())
    return groupby(rows, key=lambda r: (r["tree"], r["run"]))


NODE = "tree string, n long, level int, pos long, digest binary"


def sweep(front: DataFrame, level: int) -> DataFrame:
    """One forward sweep: nodes above ``front``, which are of ``level``, up to DEPTH levels higher."""
    def drain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for (tree, _), rows in by_run(batches):
            queue, n = [], 0
            for r in rows:                            # in label order: a list in order is a heap
                n = r["n"]
                queue.append((level + 1, r["pos"] // FAN, r["pos"], r["digest"]))
            while queue:
                label, children = queue[0][:2], []
                while queue and queue[0][:2] == label:
                    children.append(heapq.heappop(queue)[3])
                own = digest(children)
                out.append((tree, n, *label, own))
                if label[0] < level + DEPTH and width(n, label[0]) > 1:
                    heapq.heappush(queue, (label[0] + 1, label[1] // FAN, label[1], own))
            if len(out) >= 10_000:
                yield nodes_batch(out)
                out = []
        yield nodes_batch(out)

    run = F.floor(F.col("pos") / RUN)
    rows = front.where(F.col("n") > FAN ** level).select("tree", "n", run.alias("run"), "pos", "digest")
    return cut(rows.repartitionByRange("tree", "run").sortWithinPartitions("tree", "run", "pos").mapInArrow(drain, NODE), "nodes")


def nodes_batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [[]] * 5
    kinds = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], ["tree", "n", "level", "pos", "digest"])


def build(bottom: DataFrame) -> list[DataFrame]:
    """Inner nodes by sweep (the k-th holds levels k * DEPTH + 1 and up) over (tree, n, pos, digest)."""
    most = bottom.agg(F.max("n")).first()[0] or 0
    out: list[DataFrame] = []
    front = bottom
    for level in range(0, height(most), DEPTH):
        out.append(sweep(front, level))
        front = out[-1].where(F.col("level") == level + DEPTH)
    return out


def tops(bottom: DataFrame, nodes: list[DataFrame]) -> DataFrame:
    """(tree, n, digest): the top node of each tree."""
    found = bottom.where("n = 1").select("tree", "n", "digest")
    for i, part in enumerate(nodes):
        for level in range(i * DEPTH + 1, (i + 1) * DEPTH + 1):
            first = part.where((F.col("level") == level) & (F.col("pos") == 0))
            found = found.unionByName(first.where((F.col("n") <= FAN ** level) & (F.col("n") > FAN ** (level - 1)))
                                      .select("tree", "n", "digest"))
    return found


def siblings(run: list[bytes], slot: int) -> bytes:
    """A step of a proof: slot, number of siblings, siblings."""
    return bytes([slot, len(run) - 1]) + b"".join(run[:slot] + run[slot + 1:])


def steps(path: bytes) -> Iterator[tuple[int, list[bytes]]]:
    at = 0
    while at < len(path):
        slot, n = path[at], path[at + 1]
        yield slot, [path[i:i + 32] for i in range(at + 2, at + 2 + 32 * n, 32)]
        at += 2 + 32 * n


def fold(own: bytes, path: list[tuple[int, list[bytes]]]) -> bytes:
    """The root that a node's digest and its proof lead to."""
    for slot, others in path:
        own = digest([*others[:slot], own, *others[slot:]])
    return own


def back(messages: DataFrame, inner: DataFrame, bottom: DataFrame, level: int, kind: str, visit) -> DataFrame:
    """One reversed sweep: the proofs of run tops go down to the nodes of ``bottom``, of ``level``.

    ``messages`` (tree, n, level, pos, path, subroot) are proofs of nodes up to DEPTH
    levels higher, ``inner`` the nodes between, ``bottom`` (tree, n, pos, digest,
    ...). ``visit(rows, run, path, subroot, own)`` yields the results of siblings
    ``rows``, whose digests are ``run``, from their parent's proof ``path``; for a
    tree's top node, ``own``, path is its own proof.
    """
    top = F.floor(F.col("pos") * F.pow(F.lit(float(FAN)), F.col("level") - F.lit(level)) / RUN)
    extra = [c for c in bottom.columns if c not in ("tree", "n", "pos", "digest")]
    typed = {f.name: f.dataType for f in [*bottom.schema.fields, *messages.schema.fields]}
    cols = ["tree", "n", "pos", "digest", *extra, "path", "subroot"]

    def rows(df: DataFrame, lv: Column, sent: int) -> DataFrame:
        return df.select(top.cast("long").alias("run") if "level" in df.columns else F.floor(F.col("pos") / RUN).alias("run"),
                         lv.cast("int").alias("level"), F.lit(sent).alias("sent"),
                         *[F.col(c) if c in df.columns else F.lit(None).cast(typed[c]).alias(c) for c in cols])

    between = inner.where((F.col("level") > level) & (F.col("level") < level + DEPTH))
    every = rows(messages, F.col("level"), 0).unionByName(rows(between, F.col("level"), 1)).unionByName(rows(bottom, F.lit(level), 1))

    def deliver(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = None
        out: list[dict] = []
        for _, members in by_run(batches):
            queue: list[tuple] = []                   # messages by label, higher levels first
            subroot = None
            for (lv, _), group in groupby(members, key=lambda r: (r["level"], (r["sent"], r["pos"] // FAN))):
                group = list(group)
                if not group[0]["sent"]:              # the proof of the run's top comes first
                    subroot = group[0]["subroot"]
                    queue.append((-lv, group[0]["pos"], group[0]["path"]))
                    continue
                if queue and (-queue[0][0], queue[0][1]) == (lv, group[0]["pos"]):
                    path, own = heapq.heappop(queue)[2], True
                else:
                    while (-queue[0][0], queue[0][1]) != (lv + 1, group[0]["pos"] // FAN):
                        heapq.heappop(queue)          # read by its children already
                    path, own = queue[0][2], False
                run = [r["digest"] for r in group]
                if lv == level:
                    out += visit(group, run, path, subroot, own)
                else:
                    for slot, r in enumerate(group):
                        heapq.heappush(queue, (-lv, r["pos"], path if own else siblings(run, slot) + path))
            if len(out) >= 5_000:
                yield pa.RecordBatch.from_pylist(out, schema=names or (names := arrow(kind)))
                out = []
        yield pa.RecordBatch.from_pylist(out, schema=arrow(kind))

    return every.repartitionByRange("tree", "run") \
        .sortWithinPartitions("tree", "run", F.desc("level"), "sent", "pos").mapInArrow(deliver, kind)


def arrow(kind: str) -> pa.Schema:
    types = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_()}
    return pa.schema([(f.split()[0], types[f.split()[1]]) for f in kind.split(", ")])


MESSAGE = "tree string, n long, level int, pos long, path binary, subroot binary"


def send_back(messages: DataFrame, nodes: list[DataFrame], bottom: DataFrame, kind: str, visit) -> DataFrame:
    """All reversed sweeps: ``messages`` are the proofs of the tops; the result is that of visit() over the bottom."""
    def pass_on(rows, run, path, subroot, own):
        for slot, r in enumerate(rows):
            yield {"tree": r["tree"], "n": r["n"], "level": r["level"], "pos": r["pos"],
                   "path": path if own else siblings(run, slot) + path, "subroot": subroot}

    for i in range(len(nodes) - 1, 0, -1):
        level = i * DEPTH
        front = nodes[i - 1].where(F.col("level") == level).select("tree", "n", "pos", "digest")
        due = messages.where(F.col("level") >= level)
        messages = messages.where(F.col("level") < level).unionByName(
            cut(back(due, nodes[i], front, level, MESSAGE, pass_on), "proofs"))
    inner = nodes[0] if nodes else bottom.select("tree", "n", F.lit(0).alias("level"), "pos", "digest").where("false")
    return back(messages, inner, bottom, 0, kind, visit)


PROOF = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def heights(n: Column) -> Column:
    """height() of n leaves, from whole-number comparisons."""
    return sum(((n > F.lit(FAN ** k)).cast("int") for k in range(15)), F.lit(0))


def manifest(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified): a row per document."""
    rows = cut(leaves(docs).withColumn("_u", F.monotonically_increasing_id()), "leaves")
    forest = numbered(rows, "tree", ["doc_id", "leaf", "_u"]).drop("_u").withColumnRenamed("leaf", "digest")
    forest = cut(forest, "forest")
    nodes = build(forest.select("tree", "n", "pos", "digest"))

    subroots = tops(forest, nodes).withColumn("all", F.lit("*"))
    subroots = cut(numbered(subroots.withColumnRenamed("n", "size"), "all", ["tree"]).select(
        F.col("all").alias("tree"), "n", "pos", "digest", F.col("tree").alias("source"), "size"), "subroots")
    upper = build(subroots.select("tree", "n", "pos", "digest"))
    found = tops(subroots.select("tree", "n", "pos", "digest"), upper).first()
    if found is None:
        return docs.sparkSession.createDataFrame([], PROOF)
    root = bytes(found.digest)

    def to_source(rows, run, path, subroot, own):
        for slot, r in enumerate(rows):
            yield {"tree": r["source"], "n": r["size"], "level": height(r["size"]), "pos": 0,
                   "path": path if own else siblings(run, slot) + path, "subroot": r["digest"]}

    start = docs.sparkSession.createDataFrame([("*", found.n, height(found.n), 0, b"", root)], MESSAGE)
    messages = cut(send_back(start, upper, subroots, MESSAGE, to_source), "proofs")

    def verify(rows, run, path, subroot, own):
        above = list(steps(path))
        suffix = path_hex(above)
        for slot, r in enumerate(rows):
            first = [] if own else [(slot, run[:slot] + run[slot + 1:])]
            given = r["tampered"] if r["tampered"] is not None else r["digest"]
            folded = fold(given, first + above)
            yield {"doc_id": r["doc_id"], "leaf": r["digest"].hex(), "subroot": subroot.hex(), "root": root.hex(),
                   "proof_sha256": hashlib.sha256(path_hex(first) + suffix).hexdigest(),
                   "folded_root": folded.hex(), "verified": folded == root}

    return send_back(messages, nodes, forest, PROOF, verify)


def path_hex(path: list[tuple[int, list[bytes]]]) -> bytes:
    return b"".join(b for _, others in path for b in others).hex().encode()


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(table(spark, sf_dir, "documents"))


def sql(levels: int = 6) -> str:
    """The manifest in DuckDB SQL for sources (and numbers of sources) up to 16 ** levels."""
    def field(c):
        return f"coalesce(CAST(strlen(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || {c}, '-')"

    def h(text):
        return "sha256(" + " || ".join(field(c) for c in FIELDS[:-1]) + f" || {field(text)})"

    crc = ("xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), "
           "lambda ch: CAST(ascii(ch) AS BIGINT))), lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], "
           "[0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda v, z: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END)), 4294967295)")
    lower = f"translate(text, '{UPPER}', '{LOWER}')"

    def tree(name, bottom):
        """Levels of a forest over ``bottom`` (tree, pos, digest): digests, and the runs they lie in."""
        out = [f"{name}0 AS (SELECT tree, pos, digest FROM {bottom})"]
        for k in range(levels):
            out.append(f"{name}r{k} AS (SELECT tree, pos // 16 AS pos, string_agg(digest, '' ORDER BY pos) AS run, "
                       f"sum(count(*)) OVER (PARTITION BY tree) AS n FROM {name}{k} GROUP BY tree, pos // 16)")
            out.append(f"{name}{k + 1} AS (SELECT tree, pos, CASE WHEN n = 1 THEN run ELSE sha256(run) END AS digest FROM {name}r{k})")
        return out

    def climb(name, start):
        """Proof and fold of ``start`` (id, tree, pos, cur, proof) along a forest."""
        out, at = [], start
        for k in range(levels):
            slot = f"CAST(64 * (s.pos // CAST(16 ** {k} AS BIGINT) % 16) AS INTEGER)"
            before, after = f"left(r.run, {slot})", f"substr(r.run, {slot} + 65)"
            out.append(f"{name}c{k} AS (SELECT s.id, s.tree, s.pos, s.proof || CASE WHEN r.n = 1 THEN '' ELSE {before} || {after} END AS proof, "
                       f"CASE WHEN r.n = 1 THEN s.cur ELSE sha256({before} || s.cur || {after}) END AS cur "
                       f"FROM {at} s JOIN {name}r{k} r ON r.tree = s.tree AND r.pos = s.pos // CAST(16 ** {k + 1} AS BIGINT))")
            at = f"{name}c{k}"
        return out, at

    docs = [f"""d AS (SELECT doc_id, coalesce('+' || source, '') AS tree, {h('text')} AS leaf,
            CASE WHEN doc_id IS NOT NULL AND {crc} % 5 = 0 THEN {h(lower)} ELSE {h('text')} END AS given FROM documents)""",
            "f AS (SELECT *, row_number() OVER () AS id, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM d)",
            "fb AS (SELECT tree, pos, leaf AS digest FROM f)"]
    sub = [f"s AS (SELECT '*' AS tree, tree AS source, digest, row_number() OVER (ORDER BY tree) - 1 AS pos FROM a{levels})"]
    low, low_end = climb("a", "a_start")
    high, high_end = climb("b", "b_start")
    ctes = [*docs, *tree("a", "fb"), *sub, *tree("b", "s"), f"top AS (SELECT digest AS root FROM b{levels})",
            "a_start AS (SELECT id, tree, pos, given AS cur, '' AS proof FROM f)", *low,
            f"b_start AS (SELECT c.id, s.tree, s.pos, c.cur, c.proof FROM {low_end} c JOIN s ON s.source = c.tree)", *high]
    # levels are read by two others each; written once they are not planned again and again
    ctes = [c.replace(" AS (", " AS MATERIALIZED (", 1) for c in ctes]
    return ("WITH " + ",\n".join(ctes) + f"""
SELECT f.doc_id, f.leaf, s.digest AS subroot, top.root, sha256(c.proof) AS proof_sha256, c.cur AS folded_root, c.cur = top.root AS verified
FROM f JOIN s ON s.source = f.tree JOIN {high_end} c ON c.id = f.id, top""")


SQL = sql()

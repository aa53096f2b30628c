"""A manifest of a dataset: one root digest, and for each row the proof that it belongs to it.

A parent's digest is taken over its children's digests one after the other. While it is built it keeps a copy of the
hash state before each child's slot. To see what the root becomes when one child changes, the state before that slot
is resumed with the replacement and the siblings to the right; what lies to the left is in the state already.

Rows are sorted by range and numbered by adding up the ranges, so a group that holds most rows is spread
like any other. Numbers fall into blocks, subtrees of ``BLOCK`` leaves, each built in one task. The
blocks' roots are numbered already and form blocks again, until one node is left: two rounds for 16 million
rows in a group, three for 68 billion. Each block then gets its path, the children lists above it, and
its rows are folded within the block and on along the path, whose states are resumed for all rows of the block.
"""

from __future__ import annotations

import hashlib
import string
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.common import equal, query, table
from millrace.session import looked_up, stored

FANOUT = 8
#: Levels that one task builds at once, and the leaves below them.
LEVELS = 4
BLOCK = FANOUT**LEVELS
HEX = 64

PATH = "array<struct<slot:int,children:binary>>"


def leaf_digest(columns: list[Column]) -> Column:
    """The digest of a row: each value behind its length in bytes, `-` for NULL."""
    texts = [c.cast("string") for c in columns]
    sized = [F.concat(F.octet_length(t).cast("string"), F.lit(":"), t) for t in texts]
    return F.sha2(F.concat(*[F.coalesce(s, F.lit("-")) for s in sized]), 256)


class Subtree:
    """Levels of digests above some children, with the hash states before each child's slot.

    ``height`` levels are built, or as many as lead to one node if it is None. ``rows[l]`` are
    the hex digests of level l in one run of bytes, ``states[l]`` the states of the level above.
    """

    def __init__(self, digests: list[bytes], height: int | None = None):
        level = [d.hex().encode() for d in digests]
        self.rows: list[bytes] = []
        self.states: list[list] = []
        while len(level) > 1 if height is None else len(self.rows) < height:
            states, above = [], []
            for begin in range(0, len(level), FANOUT):
                state = hashlib.sha256()
                for child in level[begin:begin + FANOUT]:
                    states.append(state.copy())
                    state.update(child)
                above.append(state.hexdigest().encode())
            self.rows.append(b"".join(level))
            self.states.append(states)
            level = above
        self.top = level[0]

    def run(self, depth: int, at: int) -> tuple[bytes, bytes]:
        """The siblings of a node to its left and to its right."""
        row, begin = self.rows[depth], at - at % FANOUT
        return row[begin * HEX:at * HEX], row[(at + 1) * HEX:(begin + FANOUT) * HEX]

    def fold(self, at: int, replacement: bytes) -> bytes:
        """The top with the child ``at`` replaced."""
        for depth, states in enumerate(self.states):
            state = states[at].copy()
            state.update(replacement)
            state.update(self.run(depth, at)[1])
            replacement = state.hexdigest().encode()
            at //= FANOUT
        return replacement

    def siblings(self, at: int) -> Iterator[bytes]:
        for depth in range(len(self.rows)):
            yield from self.run(depth, at)
            at //= FANOUT

    def path(self, at: int) -> list[dict]:
        """For each level the children of the run, and the slot of the node among them."""
        path = []
        for row in self.rows:
            begin = at - at % FANOUT
            run = bytes.fromhex(row[begin * HEX:(begin + FANOUT) * HEX].decode())
            path.append({"slot": at % FANOUT, "children": run})
            at //= FANOUT
        return path


class Path:
    """What lies above a block: the states before its slots, made once for all its rows."""

    def __init__(self, path: list[dict]):
        self.steps, siblings = [], []
        for step in path:
            run, slot = step["children"].hex().encode(), step["slot"]
            left, right = run[:slot * HEX], run[(slot + 1) * HEX:]
            self.steps.append((hashlib.sha256(left), right))
            siblings += [left, right]
        self.siblings = b"".join(siblings)

    def fold(self, replacement: bytes) -> bytes:
        for before, right in self.steps:
            state = before.copy()
            state.update(replacement)
            state.update(right)
            replacement = state.hexdigest().encode()
        return replacement


def _height(total: int, block: int) -> int | None:
    """A block that is all of its group ends in one node; others have all their levels."""
    if total <= block:
        return None
    height = 0
    while FANOUT**height < block:
        height += 1
    return height


def numbered(df: DataFrame, order: list[str]) -> DataFrame:
    """``df`` with ``at``, the place of the row in its group (``part``) by ``order``, and the group's ``total``.

    The first of ``order`` is the group. Rows are sorted in ranges; what lies before a range is added up over ranges.
    """
    ranged = stored(
        df.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("place", F.monotonically_increasing_id()), "ranges",
    )
    group = order[0]
    # the upper bits of a place are its range
    spans = ranged.groupBy(group, F.shiftright("place", 33).alias("range")).agg(
        F.min("place").alias("low"), F.count(F.lit(1)).alias("n")
    )
    every = Window.partitionBy(group)
    before = every.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select(
        group, "range", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("low")).alias("ahead"),
        F.sum("n").over(every).alias("total"),
    )
    rows = ranged.withColumn("range", F.shiftright("place", 33))
    spans = looked_up(stored(spans, "spans"))
    return rows.join(spans, equal(rows, spans, [group, "range"])).select(
        *[rows[c] for c in df.columns], (F.col("place") + F.col("ahead")).alias("at"), "total",
    )


def _climbed(nodes: DataFrame, block: int) -> DataFrame:
    """part, at, total, above, path, top of each node (part, at, total, digest): its way up in its block."""
    above = F.expr(f"at div {block}").alias("above")
    members = nodes.groupBy("part", above, "total").agg(
        F.sort_array(F.collect_list(F.struct("at", "digest"))).alias("members")
    )

    def climb(batches):
        for batch in batches:
            for row in batch.to_pylist():
                digests = [m["digest"] for m in row["members"]]
                tree = Subtree(digests, _height(row["total"], block))
                ways = [tree.path(i) for i in range(len(digests))]
                n = len(digests)
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["part"]] * n, batch.schema.field("part").type),
                    pa.array([m["at"] for m in row["members"]], pa.int64()),
                    pa.array([row["total"]] * n, pa.int64()), pa.array([row["above"]] * n, pa.int64()),
                    pa.array(ways, pa.list_(pa.struct([("slot", pa.int32()), ("children", pa.binary())]))),
                    pa.array([bytes.fromhex(tree.top.decode())] * n, pa.binary()),
                ], ["part", "at", "total", "above", "path", "top"])

    part = nodes.schema["part"].dataType.simpleString()
    return members.select("part", "above", "total", "members").mapInArrow(
        climb, f"part {part}, at long, total long, above long, path {PATH}, top binary"
    )


def _ways_up(nodes: DataFrame, most: int, block: int) -> tuple[DataFrame, DataFrame]:
    """(part, at, path) of all nodes up to the top of their part, and (part, digest) of the tops."""
    ways = nodes.select("part", "at", F.col("at").alias("above"), F.array().cast(PATH).alias("path"))
    while most > 1:
        climbed = stored(_climbed(nodes, block), "climbed")
        step = climbed.select(
            F.col("part").alias("of"), F.col("at").alias("reached"), F.col("above").alias("next"), F.col("path").alias("on"),
        )
        ways = stored(
            ways.join(looked_up(step), ways["part"].eqNullSafe(F.col("of")) & (ways["above"] == F.col("reached")))
            .select("part", "at", F.col("next").alias("above"), F.concat("path", "on").alias("path")), "ways",
        )
        # of each block its first member speaks for the node above
        nodes = climbed.where(F.col("at") % block == 0).select(
            "part", F.col("above").alias("at"), F.ceil(F.col("total") / block).cast("long").alias("total"),
            F.col("top").alias("digest"),
        )
        most = -(-most // block)
    return ways.select("part", "at", "path"), nodes.select("part", "digest")


def manifest(leaves: DataFrame, block: int = BLOCK) -> DataFrame:
    """key, leaf, subroot, root, proof_sha256, folded_root, verified of each row of ``leaves``.

    ``leaves`` has part, key (long), leaf and given (hex digests). Per part the leaves ascend by key, and
    rows with one key by leaf; every 8 consecutive nodes become their parent until one is left, the
    subroot. Subroots, ordered by part (NULL first, else by bytes), form the root likewise. ``proof_sha256`` is
    the digest of all siblings on the way up. ``folded_root`` is the root with ``given`` in the leaf's place (the
    leaf itself where it is NULL), from the original siblings; ``verified`` says that it is the root. An empty
    table has no root and no rows. ``block``, a power of 8, is how many leaves one task takes at once.
    """
    rows = stored(leaves.select(
        "part", F.col("key").cast("long").alias("key"), F.unhex("leaf").alias("leaf"), F.unhex("given").alias("given"),
    ), "leaves")
    placed = numbered(rows, ["part", "key", "leaf"])
    blocks = stored(
        placed.groupBy("part", F.expr(f"at div {block}").alias("at"), "total").agg(
            F.sort_array(F.collect_list(F.struct("at", "key", "leaf", "given"))).alias("rows")
        ), "blocks",
    )
    most = blocks.agg(F.max("total")).first()[0] or 0
    nodes = stored(_block_tops(blocks, block), "nodes")
    ways, subroots = _ways_up(nodes, -(-most // block), block)

    parts = stored(numbered(
        subroots.select(F.lit(0).alias("one"), F.col("part").alias("name"), "digest"), ["one", "name"],
    ).select(F.col("one").alias("part"), "name", "at", "total", "digest"), "parts")
    top_ways, root = _ways_up(parts.drop("name"), parts.count(), block)
    top_ways, root = top_ways.withColumnRenamed("path", "on"), root.withColumnRenamed("digest", "root")
    tops = parts.join(top_ways, ["part", "at"]).join(root, "part").select(
        "name", "on", "root", F.col("digest").alias("subroot"),
    )
    paths = ways.join(looked_up(stored(tops, "tops")), ways["part"].eqNullSafe(F.col("name"))).select(
        ways["part"].alias("of"), ways["at"].alias("nth"), F.concat("path", "on").alias("path"), "subroot", "root",
    )
    paths = looked_up(stored(paths, "paths"))
    joined = blocks.join(paths, blocks["part"].eqNullSafe(F.col("of")) & (blocks["at"] == F.col("nth")))
    return _folded(joined.select("total", "rows", "path", "subroot", "root"), block)


def _block_tops(blocks: DataFrame, block: int) -> DataFrame:
    def tops(batches):
        for batch in batches:
            found = []
            leaves, totals = batch.column(2), batch.column(3).to_pylist()
            for i, total in enumerate(totals):
                tree = Subtree(leaves[i].values.to_pylist(), _height(total, block))
                found.append(bytes.fromhex(tree.top.decode()))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array([-(-t // block) for t in totals], pa.int64()), pa.array(found, pa.binary()),
            ], ["part", "at", "total", "digest"])

    part = blocks.schema["part"].dataType.simpleString()
    return blocks.select("part", "at", F.col("rows.leaf").alias("leaves"), "total").mapInArrow(
        tops, f"part {part}, at long, total long, digest binary"
    )


def _folded(joined: DataFrame, block: int) -> DataFrame:
    def fold(batches):
        for batch in batches:
            for i in range(len(batch)):
                total, rows, path, subroot, root = (batch.column(c)[i] for c in range(5))
                rows, subroot = rows.values, subroot.as_py().hex()
                leaves, given = (rows.field(name).to_pylist() for name in ("leaf", "given"))
                tree, above = Subtree(leaves, _height(total.as_py(), block)), Path(path.as_py())
                root, proofs, roots = root.as_py().hex(), [], []
                for at, (leaf, other) in enumerate(zip(leaves, given)):
                    proof = hashlib.sha256()
                    for sibling in tree.siblings(at):
                        proof.update(sibling)
                    proof.update(above.siblings)
                    proofs.append(proof.hexdigest())
                    roots.append(above.fold(tree.fold(at, (leaf if other is None else other).hex().encode())).decode())
                n = len(leaves)
                yield pa.RecordBatch.from_arrays([
                    rows.field("key"), pa.array([x.hex() for x in leaves], pa.string()), pa.array([subroot] * n, pa.string()),
                    pa.array([root] * n, pa.string()), pa.array(proofs, pa.string()), pa.array(roots, pa.string()),
                    pa.array([r == root for r in roots], pa.bool_()),
                ], ["key", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])

    return joined.mapInArrow(
        fold, "key long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    )


def documents_manifest(docs: DataFrame, tampered: Column, text: Column) -> DataFrame:
    """The manifest of documents by language; where ``tampered`` holds, rows are verified with ``text`` instead.

    A row is its doc_id, source, lang, n_chars and text, NULL and empty told apart; further columns are not looked at.
    Repeated rows are leaves of their own.
    """
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    return manifest(docs.select(
        F.col("lang").alias("part"), F.col("doc_id").alias("key"),
        leaf_digest([*fields, F.col("text")]).alias("leaf"),
        F.when(tampered, leaf_digest([*fields, text])).alias("given"),
    )).withColumnRenamed("key", "doc_id")


@query("op11_merkle", """
    WITH RECURSIVE docs AS (
        SELECT row_number() OVER () AS r, doc_id, lang, text,
               concat_ws('', coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'),
                         coalesce(strlen(source) || ':' || source, '-'), coalesce(strlen(lang) || ':' || lang, '-'),
                         coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-')) AS head,
               flatten(list_transform(string_split(doc_id::VARCHAR, ''),
                                      lambda c: [ascii(c), -1, -1, -1, -1, -1, -1, -1, -1])) AS steps
        FROM documents
    ), leaves AS (
        SELECT r, doc_id, lang, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
               CASE WHEN xor(list_reduce(list_prepend(4294967295::BIGINT, steps),
                                         lambda c, x: CASE WHEN x >= 0 THEN xor(c, x::BIGINT)
                                                      ELSE xor(c >> 1, 3988292384 * (c & 1)) END),
                             4294967295) % 3 = 0
                    THEN sha256(head || coalesce(strlen(text) || ':' || translate(
                        text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) END AS given
        FROM docs
    ), placed AS (
        SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
               count(*) OVER (PARTITION BY lang) AS n
        FROM leaves
    ), nodes AS (
        SELECT lang, 0 AS level, place, n, leaf AS digest FROM placed
        UNION ALL
        SELECT lang, level + 1, place // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY place))
        FROM nodes WHERE n > 1 GROUP BY lang, level, place // 8, n
    ), subroots AS (
        SELECT lang, digest, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place, count(*) OVER () AS n
        FROM nodes WHERE n = 1
    ), tops AS (
        SELECT 0 AS level, place, n, digest FROM subroots
        UNION ALL
        SELECT level + 1, place // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY place))
        FROM tops WHERE n > 1 GROUP BY level, place // 8, n
    ), up AS (
        SELECT r, lang, 0 AS level, place, n, coalesce(given, leaf) AS folded, '' AS proof FROM placed
        UNION ALL
        SELECT r, u.lang, u.level + 1, u.place // 8, (u.n + 7) // 8,
               sha256(string_agg(CASE WHEN x.place = u.place THEN u.folded ELSE x.digest END, '' ORDER BY x.place)),
               u.proof || coalesce(string_agg(x.digest, '' ORDER BY x.place) FILTER (x.place <> u.place), '')
        FROM up u JOIN nodes x ON x.lang IS NOT DISTINCT FROM u.lang AND x.level = u.level
                              AND x.place // 8 = u.place // 8
        WHERE u.n > 1 GROUP BY r, u.lang, u.level, u.place, u.n, u.proof
    ), over AS (
        SELECT r, 0 AS level, s.place, s.n, u.folded, u.proof, s.digest AS subroot
        FROM up u JOIN subroots s ON s.lang IS NOT DISTINCT FROM u.lang WHERE u.n = 1
        UNION ALL
        SELECT r, o.level + 1, o.place // 8, (o.n + 7) // 8,
               sha256(string_agg(CASE WHEN x.place = o.place THEN o.folded ELSE x.digest END, '' ORDER BY x.place)),
               o.proof || coalesce(string_agg(x.digest, '' ORDER BY x.place) FILTER (x.place <> o.place), ''),
               o.subroot
        FROM over o JOIN tops x ON x.level = o.level AND x.place // 8 = o.place // 8
        WHERE o.n > 1 GROUP BY r, o.level, o.place, o.n, o.proof, o.subroot
    )
    SELECT l.doc_id, l.leaf, o.subroot, t.digest AS root, sha256(o.proof) AS proof_sha256,
           o.folded AS folded_root, o.folded = t.digest AS verified
    FROM leaves l JOIN over o ON o.r = l.r AND o.n = 1 JOIN tops t ON t.n = 1
""")
def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third document (by the check sum of its doc_id) is verified with its text in lower case."""
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    lowered = F.translate(F.col("text"), string.ascii_uppercase, string.ascii_lowercase)
    return documents_manifest(table(spark, sf_dir, "documents"), tampered, lowered)

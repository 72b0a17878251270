"""Merkle manifest of a dataset, its levels held as concatenated strings.

Every row is a leaf: the SHA-256 of its fields. Within a source the leaves
ascend by id; while several nodes remain, every 16 consecutive ones become the
hash of their digests. What remains is the source's subroot; the subroots, by
source, give the root in the same way.

A block is an aligned stretch of 16^3 nodes of one tree. Each of its levels is
one string of hex digests, 64 characters a node: a parent is the hash of a
substring of 1,024 characters, and the siblings of a node are the substrings
beside it in its run. A block ends in one node; the nodes of the blocks of a
tree are blocks again (recursion), until a tree has one block. Proofs come down
the same way: the segments above a block are found once and joined to it, and
only inside a block's task do they meet its leaves.

What is shuffled are ids and digests, never texts; a hot source is many blocks,
and no group holds more than 16^3 nodes. Places of leaves come from
:func:`strata.llm.common.ranked`, without a sort in one task.

Defined results: NULL fields are hashed as ``-``, an empty text as ``0:``.
Repeated rows are leaves of their own; rows of one id are ordered by their leaf,
NULL ids come first. A row with a NULL id is never tampered with. NULL is a
source, before all others. An empty table has no leaves and no root. Other
columns of the table are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import let, ranked, stored

FAN = 16
DIGEST = 64  # hex characters of a node
RUN = FAN * DIGEST
SPAN = FAN ** 3  # nodes of a block
NO_SEGMENTS = "array<struct<left:string,right:string>>"


def sha(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def field(value: Column) -> Column:
    """Length in UTF-8, a colon and the value; ``-`` for NULL."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def row_hash(values: list[Column]) -> Column:
    return sha(F.concat(*(field(v) for v in values)))


def low(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def runs(length: Column, size: int) -> Column:
    """0, 1, ... one for each started stretch of ``size``."""
    return F.sequence(F.lit(0), F.ceil(length / size).cast("int") - 1)


def parents(level: Column) -> Column:
    """The level above: the hash of every fixed-width substring."""
    return let(level.cast("binary"), lambda b: F.array_join(F.transform(
        runs(F.octet_length(b), RUN), lambda i: F.sha2(F.substring(b, i * RUN + 1, F.lit(RUN)), 256)), ""))


def flanks(run: Column, at: Column) -> Column:
    """The digests before and behind node ``at`` of a run."""
    return F.struct(F.substring(run, F.lit(1), at * DIGEST).alias("left"),
                    F.substring(run, at * DIGEST + DIGEST + 1, F.lit(RUN)).alias("right"))


def beside(level: Column, at: Column) -> Column:
    """The segments beside node ``at`` of a level; no item if there is no such level."""
    run = F.substring(level.cast("binary"), F.floor(at / FAN).cast("int") * RUN + 1, F.lit(RUN)).cast("string")
    return F.when(level.isNotNull(), F.array(flanks(run, at % FAN))).otherwise(F.array().cast(NO_SEGMENTS))


def block_levels(nodes: DataFrame) -> DataFrame:
    """(tree, n, block, nodes, low, mid, high, top) of nodes (tree, n, pos, hash,
    item): the levels that have parents, and the one digest a block ends in."""
    grouped = (nodes.groupBy("tree", "n", F.floor(F.col("pos") / SPAN).alias("block"))
               .agg(F.sort_array(F.collect_list(F.struct("pos", "hash", "item"))).alias("nodes")))
    level = grouped.withColumn("l0", F.array_join("nodes.hash", ""))
    for k in range(1, 4):
        level = level.withColumn(f"l{k}", F.when(F.col("n") > FAN ** (k - 1), parents(F.col(f"l{k - 1}"))))
    held = [F.when(F.col("n") > FAN ** k, F.col(f"l{k}")).alias(name) for k, name in enumerate(("low", "mid", "high"))]
    return level.select("tree", "n", "block", "nodes", *held, F.coalesce("l3", "l2", "l1", "l0").alias("top"))


def layers(nodes: DataFrame, name: str) -> list[DataFrame]:
    """Blocks of the nodes, blocks of what these end in, and so on until every tree has one block."""
    found = []
    while True:
        blocks = stored(block_levels(nodes), name)
        found.append(blocks)
        more = blocks.where(F.col("n") > SPAN)
        if more.isEmpty():
            return found
        nodes = more.select("tree", F.ceil(F.col("n") / SPAN).alias("n"), F.col("block").alias("pos"),
                            F.col("top").alias("hash"), F.struct("top").alias("item"))


def ends(found: list[DataFrame]) -> DataFrame:
    """(tree, top) the last node of every tree."""
    done = [b.where(F.col("n") <= SPAN).select("tree", "top") for b in found]
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def below(blocks: DataFrame) -> DataFrame:
    """(tree, pos, hash, item, segments, own) of the nodes of blocks that carry
    the segments ``above`` them."""
    def run_of(i: Column) -> Column:
        return F.struct(
            F.slice("nodes", i * FAN + 1, F.lit(FAN)).alias("nodes"),
            F.substring(F.col("low").cast("binary"), i * RUN + 1, F.lit(RUN)).cast("string").alias("low"),
            F.concat(beside(F.col("mid"), i), beside(F.col("high"), F.floor(i / FAN).cast("int")), F.col("above")).alias("above"))
    some = blocks.select("tree", "own", F.inline(F.transform(runs(F.size("nodes"), FAN), run_of)))
    own = F.transform("nodes", lambda x, k: F.struct(
        x["pos"].alias("pos"), x["hash"].alias("hash"), x["item"].alias("item"),
        F.concat(F.when(F.col("low").isNotNull(), F.array(flanks(F.col("low"), k))).otherwise(
            F.array().cast(NO_SEGMENTS)), F.col("above")).alias("segments")))
    return some.select("tree", "own", F.inline(own))


def paths(found: list[DataFrame], tails: DataFrame) -> DataFrame:
    """(tree, pos, hash, item, segments, own) of every node of the first layer:
    all segments from it upwards. ``tails(tree, above, own)`` continue each tree
    beyond its last node."""
    tail = tails.select(F.struct("tree", "above", "own").alias("_t"))
    out = None
    for blocks in reversed(found):
        last = blocks.where(F.col("n") <= SPAN).join(tail, F.col("tree").eqNullSafe(F.col("_t.tree")))
        if out is not None:
            upper = out.select(F.struct("tree", "pos", F.col("segments").alias("above"), "own").alias("_t"))
            more = blocks.where(F.col("n") > SPAN).join(
                upper, (F.col("block") == F.col("_t.pos")) & F.col("tree").eqNullSafe(F.col("_t.tree")))
            last = (last.select(*blocks.columns, "_t.above", "_t.own")
                    .unionByName(more.select(*blocks.columns, "_t.above", "_t.own")))
        else:
            last = last.select(*blocks.columns, "_t.above", "_t.own")
        out = below(last)
    return out


def folded(start: Column, segments: Column) -> Column:
    """The root that a node and the segments of its path lead to."""
    return F.aggregate(segments, start, lambda node, s: sha(F.concat(s["left"], node, s["right"])))


def proof(segments: Column) -> Column:
    """All siblings of a path as one string."""
    return F.array_join(F.transform(segments, lambda s: F.concat(s["left"], s["right"])), "")


def manifest(leaves: DataFrame) -> DataFrame:
    """(item, leaf, segments, subroot, root) of ``leaves(source, order, leaf, item)``,
    ``order`` a column that sorts the leaves of a source."""
    placed = ranked(leaves, "source", [F.col("order").asc_nulls_first(), F.col("leaf")], "leaves")
    found = layers(placed.select(F.col("source").alias("tree"), "n", "pos", F.col("leaf").alias("hash"), "item"), "blocks")
    subroots = stored(ends(found).select(F.lit("").alias("all"), F.col("tree").alias("source"), F.col("top").alias("hash")),
                      "subroots")
    trees = ranked(subroots, "all", [F.col("source").asc_nulls_first()], "sources")
    top = layers(trees.select(F.col("all").alias("tree"), "n", "pos", "hash", F.struct("source").alias("item")), "roots")
    whole = ends(top).select("tree", F.array().cast(NO_SEGMENTS).alias("above"), F.struct(F.col("top").alias("root")).alias("own"))
    tails = paths(top, whole).select(
        F.col("item.source").alias("tree"), F.col("segments").alias("above"),
        F.struct(F.col("hash").alias("subroot"), F.col("own.root").alias("root")).alias("own"))
    out = paths(found, stored(tails, "tails"))
    return out.select("item", F.col("hash").alias("leaf"), "segments", "own.subroot", "own.root")


def verify(docs: DataFrame, modulus: int = 5) -> DataFrame:
    """The manifest of ``docs(doc_id, source, lang, n_chars, text)``, each row
    checked against the root after the text of every row with
    crc32(doc_id) % ``modulus`` = 0 lost its capitals: (doc_id, source, leaf,
    subroot, root, siblings, proof_sha256, folded_root, verified)."""
    d = docs.select(*(docs[c] for c in ("doc_id", "source", "lang", "n_chars", "text")))
    rest = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == 0
    leaves = stored(d.select("source", F.col("doc_id").alias("order"), row_hash([*rest, F.col("text")]).alias("leaf"),
                             F.struct("doc_id", "source", F.when(hit, row_hash([*rest, low(F.col("text"))])).alias("changed")
                                      ).alias("item")), "rows")
    out = manifest(leaves).select(
        "item.doc_id", "item.source", "leaf", "subroot", "root",
        F.size("segments").alias("levels"), sha(proof(F.col("segments"))).alias("proof_sha256"),
        folded(F.coalesce("item.changed", "leaf"), F.col("segments")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))

"""Merkle manifest of a dataset with an inclusion proof for every row (operator 12).

Rows of a group are ranked by their order column and hashed up in runs of three.
A rank's base-3 digits name the runs: grouping by all digits but the lowest puts
the nodes of a run together, so the tree of a block of 3^6 = 729 consecutive
nodes grows by six ``groupBy`` s over one shuffle on (group, block), each of
which nests the structs of the one before. A block is one row of at most 729
leaves whatever the group's size, so a hot group only has more blocks. The
blocks' digests are the leaves of the next pass, until one node is left; the
groups' roots are rolled up likewise into the root of the dataset.

Downwards a block's row is ``transform`` ed level by level: a child's proof is its
parent's proof after the digests left and right of the child within its run,
and one ``explode`` emits all leaves of the block. What lies above a block is brought
to it by a union and a ``groupBy`` on (group, block), a row for 729 leaves; nothing
is joined to the leaves.

A run of one node is hashed like any other as long as its level has more
nodes; the one node of a level is left as it is.

Defined cases: a null is written ``-`` in a leaf's input; null order values come
first, null groups are a group of their own before all others, and groups are in
bytewise order of their names; rows with equal order values are in order of their
leaf digests, so repeated rows are leaves of their own; a row with a null id is
never tampered with; an empty table gives an empty result; further columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulse.operators.sequence import number_rows

from .storage import small_or_shuffled, written

ARITY = 3
DIGITS = 6
BLOCK = ARITY ** DIGITS

_PROOF = "array<struct<l:string,r:string>>"


def digest(*parts: Column) -> Column:
    """Lower-case hexadecimal SHA-256 of the parts, one after the other."""
    return F.sha2(F.concat(*parts) if len(parts) > 1 else parts[0], 256)


def framed(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def _group_key(group: Column) -> Column:
    """A null-free key that sorts null first and names in bytewise order."""
    return F.when(group.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), group.cast("string")))


def _nodes_at(n: Column, level: int) -> Column:
    """Nodes of ``level`` over ``n`` nodes of level 0."""
    return F.floor((n + F.lit(ARITY ** level - 1)) / F.lit(ARITY ** level))


def _blocks(nodes: DataFrame) -> DataFrame:
    """Trees of the blocks: ``grp, n, block, digest, tree`` (children nested).

    ``nodes`` has ``grp, n`` (nodes of the group), ``rank`` from 0, ``digest, item``.
    """
    place = F.col("rank") % BLOCK
    df = nodes.select(
        "grp", "n", F.floor(F.col("rank") / BLOCK).alias("block"), F.col("digest"),
        F.col("item").alias("tree"),
        *[(F.floor(place / ARITY ** k) % ARITY).cast("int").alias(f"d{k}") for k in range(DIGITS)])
    df = df.repartition("grp", "n", "block")
    for level in range(DIGITS):
        higher = [f"d{k}" for k in range(level + 1, DIGITS)]
        run = df.groupBy("grp", "n", "block", *higher).agg(
            F.array_sort(F.collect_list(F.struct(F.col(f"d{level}").alias("d"), F.col("digest").alias("h"), F.col("tree").alias("t")))).alias("tree"))
        df = run.withColumn("digest", F.when(_nodes_at(F.col("n"), level) > 1, digest(F.array_join("tree.h", "")))
                            .otherwise(F.col("tree")[0]["h"]))
    return df.select("grp", "n", "block", "digest", "tree")


def _unnested(blocks: DataFrame, *keep: str) -> DataFrame:
    """Leaves of the blocks with their proofs: ``grp, rank, digest, item, proof, keep``.

    ``blocks`` also has ``proof``, the block's own way to the root.
    """
    def children(level: int):
        def of(e: Column) -> Column:
            kids = e["t"]

            def child(c: Column, i: Column) -> Column:
                step = F.struct(F.array_join(F.slice(kids["h"], F.lit(1), i), "").alias("l"),
                                F.array_join(F.slice(kids["h"], i + 2, F.lit(ARITY)), "").alias("r"))
                longer = F.concat(F.array(step), e["p"])
                return F.struct(c["t"].alias("t"), c["h"].alias("h"), F.when(_nodes_at(F.col("n"), level) > 1, longer).otherwise(e["p"]).alias("p"))
            return F.transform(kids, child)
        return of

    paths = F.array(F.struct(F.col("tree").alias("t"), F.col("digest").alias("h"), F.col("proof").alias("p")))
    df = blocks.withColumn("paths", paths)
    for level in reversed(range(DIGITS)):
        df = df.withColumn("paths", F.flatten(F.transform("paths", children(level))))
    # the outer form: for the plain one Spark adds a filter that evaluates the paths a second time
    leaves = df.select("grp", "block", *keep, F.posexplode_outer("paths").alias("pos", "leaf"))
    return leaves.select("grp", (F.col("block") * BLOCK + F.col("pos")).alias("rank"), F.col("leaf.h").alias("digest"),
                         F.col("leaf.t").alias("item"), F.col("leaf.p").alias("proof"), *keep)


def _rolled(nodes: DataFrame) -> list[DataFrame]:
    """Block tables from the leaves up to one block a group."""
    out = []
    while True:
        blocks = written(_blocks(nodes), "merkle-blocks")
        out.append(blocks)
        if (blocks.agg(F.max("block")).first()[0] or 0) == 0:
            return out
        nodes = blocks.select("grp", _nodes_at(F.col("n"), DIGITS).alias("n"), F.col("block").alias("rank"), "digest",
                              F.lit(None).cast("boolean").alias("item"))


def _beside(blocks: DataFrame, above: DataFrame, key: list[str]) -> DataFrame:
    """Blocks with the columns of the one row ``above`` each, by union and grouping."""
    own = [c for c in blocks.columns if c not in key]
    more = [c for c in above.columns if c not in key]
    types = {**dict(blocks.dtypes), **dict(above.dtypes)}
    # complex columns as one struct each, null on the other side
    left = blocks.select(*key, F.struct(*own).alias("_own"), F.lit(None).cast(
        "struct<" + ",".join(f"{c}:{types[c]}" for c in more) + ">").alias("_more"))
    right = above.select(*key, F.lit(None).cast(left.schema["_own"].dataType).alias("_own"), F.struct(*more).alias("_more"))
    return left.unionByName(right).groupBy(*key).agg(
        F.first("_own", ignorenulls=True).alias("_own"), F.first("_more", ignorenulls=True).alias("_more")
    ).select(*key, "_own.*", "_more.*")


def _descended(tables: list[DataFrame], above: DataFrame, *keep: str) -> DataFrame:
    """Leaves of the lowest table; ``above`` has ``grp, proof, keep`` of every group."""
    up = above.select("grp", F.lit(0).cast("long").alias("block"), "proof", *keep)
    for k, blocks in reversed(list(enumerate(tables))):
        leaves = _unnested(_beside(blocks, up, ["grp", "block"]), *keep)
        if k:
            up = leaves.select("grp", F.col("rank").alias("block"), "proof", *keep)
    return leaves


def manifest(leaves: DataFrame) -> DataFrame:
    """Proofs of all leaves of ``grp`` (any name, null allowed), ``at`` (order), ``digest, item``.

    Returns ``digest, item, subroot, root, proof``; ``proof`` lists the steps from
    the leaf to the root, each with the digests ``l`` before and ``r`` after the node.
    """
    keyed = leaves.select(_group_key(F.col("grp")).alias("grp"), "at", "digest", "item")
    ranked = number_rows(keyed, ["grp"], ["at", "digest"], name="rank")
    sizes = small_or_shuffled(written(ranked.groupBy("grp").agg(F.count(F.lit(1)).alias("n")), "merkle-sizes"))
    tables = _rolled(ranked.join(sizes, "grp").select("grp", "n", (F.col("rank") - 1).alias("rank"), "digest", "item"))
    subroots = written(tables[-1].select("grp", "digest"), "merkle-subroots")
    groups = number_rows(subroots, [], ["grp"], name="rank")
    over = _rolled(groups.select(F.lit("").alias("grp"), F.lit(subroots.count()).cast("long").alias("n"), (F.col("rank") - 1).alias("rank"),
                                 "digest", F.col("grp").alias("item")))
    root = over[-1].select("grp", F.lit(None).cast(_PROOF).alias("proof"), F.col("digest").alias("root"))
    root = root.withColumn("proof", F.array().cast(_PROOF))
    by_group = _descended(over, root, "root").select(
        F.col("item").alias("grp"), "proof", "root", F.col("digest").alias("subroot"))
    return _descended(tables, written(by_group, "merkle-groups"), "root", "subroot").select("digest", "item", "subroot", "root", "proof")


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf digest and a proof lead to."""
    return F.aggregate(proof, leaf, lambda h, step: digest(step["l"], h, step["r"]))


def document_leaf(text: Column) -> Column:
    """Leaf digest of a row of ``documents`` with ``text`` in the text's place."""
    return digest(*[framed(c) for c in (F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text)])


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.lit(False))
    leaves = docs.select(
        F.col("source").alias("grp"), F.col("doc_id").alias("at"), document_leaf(F.col("text")).alias("digest"),
        F.struct("doc_id", F.when(tampered, document_leaf(F.translate("text", "\n", ""))).alias("tampered")).alias("item"))
    rows = manifest(leaves).select(
        "item.doc_id", F.col("digest").alias("leaf"), "subroot", "root",
        digest(F.array_join(F.transform("proof", lambda s: F.concat(s["l"], s["r"])), "")).alias("proof_sha256"),
        folded(F.coalesce("item.tampered", "digest"), F.col("proof")).alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


#: nodes level by level from list positions, proofs by looking the siblings up
SQL_OP12 = r"""
WITH RECURSIVE
d AS (SELECT doc_id, source, text, lang, n_chars, list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: ascii(substr(doc_id::VARCHAR, i::INT, 1))) AS bytes FROM documents),
e AS (SELECT *, coalesce(xor(list_reduce(bytes, lambda c, b: list_reduce(range(8), lambda v, k: xor(v >> 1, (v & 1) * 3988292384), xor(c, b)), 4294967295::BIGINT), 4294967295) % 2 = 0, false) AS hit,
  concat(coalesce(octet_length(encode(doc_id::VARCHAR)) || ':' || doc_id, '-'), coalesce(octet_length(encode(source)) || ':' || source, '-'),
         coalesce(octet_length(encode(lang)) || ':' || lang, '-'), coalesce(octet_length(encode(n_chars::VARCHAR)) || ':' || n_chars, '-')) AS head FROM d),
f AS (SELECT doc_id, source, sha256(head || coalesce(octet_length(encode(text)) || ':' || text, '-')) AS leaf,
  CASE WHEN hit THEN replace(text, chr(10), '') ELSE text END AS t2, head FROM e),
leaves AS (SELECT doc_id, source, leaf, sha256(head || coalesce(octet_length(encode(t2)) || ':' || t2, '-')) AS changed,
  row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM f),
nodes AS (
  SELECT source, 0 AS lvl, pos, leaf AS h, count(*) OVER (PARTITION BY source) AS n FROM leaves
  UNION ALL
  SELECT source, lvl + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (n + 2) // 3 FROM nodes WHERE n > 1 GROUP BY source, lvl, pos // 3, n),
subs AS (SELECT source, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS lvl, pos, subroot AS h, count(*) OVER () AS n FROM subs
  UNION ALL
  SELECT lvl + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (n + 2) // 3 FROM tops WHERE n > 1 GROUP BY lvl, pos // 3, n),
steps AS (
  SELECT a.source, a.lvl, a.pos, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l,
         coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r
  FROM nodes a JOIN nodes b ON a.source IS NOT DISTINCT FROM b.source AND a.lvl = b.lvl AND a.pos // 3 = b.pos // 3 WHERE a.n > 1 GROUP BY ALL),
topsteps AS (
  SELECT a.lvl, a.pos, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l,
         coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r
  FROM tops a JOIN tops b ON a.lvl = b.lvl AND a.pos // 3 = b.pos // 3 WHERE a.n > 1 GROUP BY ALL),
walk AS (
  SELECT doc_id, source, leaf, changed AS h, '' AS proof, 0 AS lvl, pos, pos AS id FROM leaves
  UNION ALL
  SELECT w.doc_id, w.source, w.leaf, sha256(s.l || w.h || s.r), w.proof || s.l || s.r, w.lvl + 1, w.pos // 3, w.id
  FROM walk w JOIN steps s ON w.source IS NOT DISTINCT FROM s.source AND w.lvl = s.lvl AND w.pos = s.pos),
high AS (SELECT * FROM walk QUALIFY row_number() OVER (PARTITION BY source, id ORDER BY lvl DESC) = 1),
walk2 AS (
  SELECT g.doc_id, g.source, g.leaf, g.h, g.proof, 0 AS lvl, s.pos, g.id, s.subroot FROM high g JOIN subs s ON g.source IS NOT DISTINCT FROM s.source
  UNION ALL
  SELECT w.doc_id, w.source, w.leaf, sha256(s.l || w.h || s.r), w.proof || s.l || s.r, w.lvl + 1, w.pos // 3, w.id, w.subroot
  FROM walk2 w JOIN topsteps s ON w.lvl = s.lvl AND w.pos = s.pos),
fin AS (SELECT * FROM walk2 QUALIFY row_number() OVER (PARTITION BY source, id ORDER BY lvl DESC) = 1)
SELECT doc_id, leaf, subroot, (SELECT h FROM tops WHERE n = 1) AS root, sha256(proof) AS proof_sha256, h AS folded_root,
       h = (SELECT h FROM tops WHERE n = 1) AS verified
FROM fin
"""

"""A Merkle manifest of a dataset: a hash tree per source, one tree over their roots, and the proof of every row.

Rows are leaves, in the order of their ids inside their source. Every ``FANOUT`` consecutive nodes become one node until one
is left. Positions come from range partitions and their sizes, so a source of any size is spread over many tasks. Built
levels are tables of node rows; each knows its parent and the digests of its siblings. A recursive query then climbs from
the leaves to the root: a step joins the parent, appends the siblings and folds each leaf's hash. The up to ``FANOUT``
leaves of one parent climb in one row, as all their siblings above are the same; digests travel as 32 bytes, and only this
narrow part is shuffled again at every step.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.operators.index import with_group_index, with_row_index
from quayside.plans.session import Scratch, hinted

FANOUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPERED_EVERY = 5
# The tree over the roots of the sources; sources are numbered from 0.
TOP_TREE = -1
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_OUT = "doc_id, leaf, subroot, root, proof_sha256, folded_root, verified"


def field_text(c: Column) -> Column:
    """A value so written that a row's values cannot run into each other: ``-``, or its length in bytes, ``:`` and itself."""
    text = c.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def _hash(*parts: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*parts), 256))


def _hex(c: Column) -> Column:
    return F.lower(F.hex(c))


def leaf(values: list[Column]) -> Column:
    """The 32-byte digest of a row's values."""
    return _hash(*[field_text(c) for c in values])


def _joined(digests: Column) -> Column:
    """Digests of an array one after another, still as bytes."""
    return F.aggregate(digests, F.lit(b""), lambda a, d: F.concat(a, d))


def _parents(nodes: DataFrame, *more: str) -> DataFrame:
    """(tree, n, at, kids): runs of ``FANOUT`` nodes, at most so many to a row; ``n`` is the length of the parents' level."""
    kid = F.struct("at", "digest", *more)
    up = nodes.groupBy("tree", F.floor((F.col("n") + FANOUT - 1) / FANOUT).cast("bigint").alias("up"), F.floor(F.col("at") / FANOUT).cast("bigint").alias("place"))
    return up.agg(F.array_sort(F.collect_list(kid)).alias("kids")).select("tree", F.col("up").alias("n"), F.col("place").alias("at"), "kids")


def _digest(kids: Column) -> Column:
    return _hash(_hex(_joined(F.transform(kids, lambda k: k["digest"]))))


def _linked(parents: DataFrame, key: list[Column], level: int) -> DataFrame:
    """A node row per child: its key, its parent's, and the digests of its siblings to the left and to the right."""
    rows = parents.select("tree", "at", "kids", F.posexplode("kids").alias("pos", "kid"))
    before = F.slice(F.col("kids"), F.lit(1), F.col("pos"))
    after = F.slice(F.col("kids"), F.col("pos") + 2, F.lit(FANOUT))
    digests = [_joined(F.transform(part, lambda k: k["digest"])) for part in (before, after)]
    return rows.select(
        *key, F.col("tree").alias("up_tree"), F.lit(level + 1).alias("up_level"), F.col("at").alias("up_at"), digests[0].alias("before"), digests[1].alias("after")
    )


class Manifest:
    """The built trees: ``blocks`` (leaves by parent), ``nodes`` (all nodes above them but the root), ``tops`` (a root per
    source), and the digest and key of the root."""

    def __init__(self, blocks: DataFrame, nodes: DataFrame, tops: DataFrame, root: bytes, key: tuple[int, int]) -> None:
        self.blocks, self.nodes, self.tops, self.root, self.key = blocks, nodes, tops, root, key


def _climbed_levels(level: DataFrame, longest: int, kept: list[DataFrame], scratch: Scratch, number: int, key) -> tuple[list[DataFrame], int]:
    """Levels above ``level`` (tree, n, at, digest) until each tree has one node; adds node rows to ``kept``.

    Gives the single nodes met on the way as (tree, level, digest), and the number of the last level.
    """
    tops = []
    while True:
        tops.append(level.where("n = 1").select("tree", F.lit(number).alias("level"), "digest"))
        if longest <= 1:
            return tops, number
        parents = scratch.keep(_parents(level.where("n > 1")), f"level-{number + 1}")
        kept.append(scratch.keep(_linked(parents, key(number), number), f"nodes-{number}"))
        level = parents.select("tree", "n", "at", _digest(F.col("kids")).alias("digest"))
        longest, number = -(-longest // FANOUT), number + 1


def build(docs: DataFrame, scratch: Scratch, fields: tuple[str, ...] = FIELDS) -> Manifest | None:
    """The trees over ``docs``; None for an empty table. ``fields`` are id, source, further columns, and the text last."""
    ident, source, text = fields[0], fields[1], fields[-1]
    cols = {f: F.col(f"`{f}`") for f in fields}
    lowered = cols | {text: F.translate(cols[text].cast("string"), _UPPER, _LOWER)}
    tampered = F.coalesce(F.crc32(cols[ident].cast("string")) % TAMPERED_EVERY == 0, F.lit(False))
    leaves = docs.select(
        cols[source].cast("string").alias("source"), cols[ident].alias("id"),
        leaf(list(cols.values())).alias("digest"), F.when(tampered, leaf(list(lowered.values()))).alias("changed"),
    )
    leaves = scratch.keep(leaves, "leaves")
    sources = scratch.keep(leaves.groupBy("source").agg(F.count(F.lit(1)).alias("n")), "sources")
    count, longest = sources.agg(F.count(F.lit(1)), F.max("n")).first()
    if not count:
        return None
    numbered = with_row_index(sources, [F.asc_nulls_first("source")], "tree", unique=True, scratch=scratch)
    numbered = hinted(numbered.select(F.col("source").alias("_source"), "n", "tree"), count)
    placed = with_group_index(leaves, ["source"], [F.asc_nulls_first("id"), F.col("digest")], "at", scratch=scratch)
    placed = placed.join(numbered, placed["source"].eqNullSafe(numbered["_source"]))
    whole = F.floor((F.col("n") + FANOUT - 1) / FANOUT).cast("bigint")
    blocks = placed.groupBy("tree", (F.col("n") == 1).alias("lone"), whole.alias("up"), F.floor(F.col("at") / FANOUT).cast("bigint").alias("block")).agg(
        F.array_sort(F.collect_list(F.struct("at", "digest", "id", "changed"))).alias("kids")
    )
    blocks = scratch.keep(blocks.select("tree", "lone", F.col("up").alias("n"), "block", "kids"), "blocks")

    kept: list[DataFrame] = []
    own = F.when(F.col("lone"), F.col("kids")[0]["digest"]).otherwise(_digest(F.col("kids")))
    first = blocks.select("tree", "n", F.col("block").alias("at"), own.alias("digest"))
    tops, last = _climbed_levels(first, -(-longest // FANOUT), kept, scratch, 1, lambda k: [F.col("tree"), F.lit(k).alias("level"), F.col("kid")["at"].alias("at")])
    tops = scratch.keep(reduce(DataFrame.unionByName, tops), "tops")
    if count == 1:
        return Manifest(blocks, _nodes(kept, blocks), tops, tops.first()["digest"], (0, last))

    # the tree over the sources' roots: its leaves are nodes of the source trees, each on its own level
    under = tops.select(F.lit(TOP_TREE).cast("bigint").alias("tree"), F.lit(count).cast("bigint").alias("n"), F.col("tree").alias("at"), "digest", "level")
    parents = scratch.keep(_parents(under, "level"), "level-1-of-roots")
    kept.append(scratch.keep(_linked(parents, [F.col("kid")["at"].alias("tree"), F.col("kid")["level"].alias("level"), F.lit(0).cast("bigint").alias("at")], 0), "nodes-of-roots"))
    first = parents.select("tree", "n", "at", _digest(F.col("kids")).alias("digest"))
    found, last = _climbed_levels(first, -(-count // FANOUT), kept, scratch, 1, lambda k: [F.col("tree"), F.lit(k).alias("level"), F.col("kid")["at"].alias("at")])
    root = reduce(DataFrame.unionByName, found).first()["digest"]
    return Manifest(blocks, _nodes(kept, blocks), tops, root, (TOP_TREE, last))


def _nodes(kept: list[DataFrame], blocks: DataFrame) -> DataFrame:
    if kept:
        return reduce(DataFrame.unionByName, kept)
    return _linked(blocks.where(F.lit(False)).select("tree", F.col("block").alias("at"), "kids"), [F.col("tree"), F.lit(1).alias("level"), F.col("at").alias("at")], 1)


_CLIMB = """
WITH RECURSIVE climb(tree, block, node_tree, node_level, node_at, folds, proof) MAX RECURSION LEVEL 1000 AS (
  SELECT tree, block, tree, 1, block, folds, CAST('' AS BINARY) FROM {starts}
  UNION ALL
  SELECT c.tree, c.block, n.up_tree, n.up_level, n.up_at,
         transform(c.folds, f -> unhex(sha2(lower(hex(concat(n.before, f, n.after))), 256))),
         concat(c.proof, n.before, n.after)
  FROM climb c JOIN {nodes} n ON c.node_tree = n.tree AND c.node_level = n.level AND c.node_at = n.at
)
SELECT tree, block, folds, proof FROM climb WHERE node_tree = {tree} AND node_level = {level}
"""


def climb(made: Manifest, scratch: Scratch) -> DataFrame:
    """(tree, block, folds, proof) at the root: every leaf's folded hash, and the siblings met above its parent."""
    spark = scratch.spark
    # a leaf's first step: its run with the leaf replaced by what the row hashes to now
    folded = F.transform(
        F.col("kids"),
        lambda k: _hash(_hex(_joined(F.transform(F.col("kids"), lambda o: F.when(o["at"] == k["at"], F.coalesce(k["changed"], k["digest"])).otherwise(o["digest"]))))),
    )
    only = F.transform(F.col("kids"), lambda k: F.coalesce(k["changed"], k["digest"]))
    starts = made.blocks.select("tree", "block", F.when(F.col("lone"), only).otherwise(folded).alias("folds"))
    names = {"starts": f"starts_{id(made)}", "nodes": f"nodes_{id(made)}"}
    starts.createOrReplaceTempView(names["starts"])
    made.nodes.createOrReplaceTempView(names["nodes"])
    limit = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(limit)
    try:
        spark.conf.set(limit, "-1")  # the rows grow with the table; the levels with its logarithm
        return scratch.keep(spark.sql(_CLIMB.format(**names, tree=made.key[0], level=made.key[1])), "climbed")
    finally:
        spark.conf.set(limit, before)
        for name in names.values():
            spark.catalog.dropTempView(name)


def proofs(docs: DataFrame, scratch: Scratch, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """Every row's leaf, roots, digest of its proof, and the root its tampered form folds to.

    Null ids come first in their source and are never tampered; the null source is one of its own, before all others. Rows
    with the same id follow each other by their digest; equal rows are leaves of their own. A row alone in its only source
    is the root itself, and its proof is empty. An empty table gives no rows. Further columns are not read.
    """
    made = build(docs, scratch, fields)
    if made is None:
        return docs.where(F.lit(False)).select(F.col(f"`{fields[0]}`").alias("doc_id"), *[F.lit("").alias(c) for c in _OUT.split(", ")[1:-1]], F.lit(False).alias("verified"))
    top = hinted(made.tops.select(F.col("tree").alias("_tree"), F.col("digest").alias("subroot")), made.tops.count())
    up = climb(made, scratch).select(F.col("tree").alias("_t"), F.col("block").alias("_b"), "folds", "proof")
    rows = made.blocks.join(up, (F.col("tree") == F.col("_t")) & (F.col("block") == F.col("_b"))).join(top, F.col("tree") == F.col("_tree"))
    each = rows.select("kids", "folds", "proof", "subroot", F.posexplode("kids").alias("pos", "kid"))
    rest = F.concat(*[_joined(F.transform(part, lambda k: k["digest"])) for part in (F.slice("kids", F.lit(1), F.col("pos")), F.slice("kids", F.col("pos") + 2, F.lit(FANOUT)))])
    root = F.lit(made.root)
    fold = F.get(F.col("folds"), F.col("pos"))
    return each.select(
        F.col("kid")["id"].alias("doc_id"), _hex(F.col("kid")["digest"]).alias("leaf"), _hex(F.col("subroot")).alias("subroot"), _hex(root).alias("root"),
        F.sha2(_hex(F.concat(rest, F.col("proof"))).cast("binary"), 256).alias("proof_sha256"), _hex(fold).alias("folded_root"), (fold == root).alias("verified"),
    )


def oracle_sql(levels: int = 6) -> str:
    """The same rows in DuckDB SQL, by levels written out one by one (up to ``FANOUT ** levels`` rows a source)."""
    fields = " || ".join(f"CASE WHEN {f} IS NULL THEN '-' ELSE strlen(CAST({f} AS VARCHAR)) || ':' || {f} END" for f in FIELDS[:-1])

    def text(value: str) -> str:
        return f"CASE WHEN text IS NULL THEN '-' ELSE strlen({value}) || ':' || {value} END"

    # crc32 bit by bit: each byte is mixed in and followed by eight steps
    steps = "list_reduce(list_prepend(4294967295::UBIGINT, flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: [ascii(c)::UBIGINT, 256, 256, 256, 256, 256, 256, 256, 256]))), lambda a, v: CASE WHEN v < 256 THEN xor(a, v) ELSE xor(a >> 1, 3988292384::UBIGINT * (a & 1)) END)"
    crc = f"xor({steps}, 4294967295::UBIGINT)"
    parts = [
        f"""d AS (SELECT doc_id, source, sha256({fields} || {text("text")}) AS leaf,
               CASE WHEN {crc} % {TAMPERED_EVERY} = 0 THEN sha256({fields} || {text(f"translate(text, '{_UPPER}', '{_LOWER}')")}) END AS changed FROM documents)""",
        "s AS (SELECT source, count(*) AS n, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS tree FROM d GROUP BY source)",
        "l AS (SELECT doc_id, leaf, coalesce(changed, leaf) AS f0, '' AS p0, tree, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source)",
        "a0 AS (SELECT tree, n, pos, leaf AS digest, CAST([] AS VARCHAR[]) AS kids FROM l JOIN s USING (tree))",
    ]

    def level(name: str, k: int) -> str:
        return f"""{name}{k + 1} AS (SELECT tree, (n + {FANOUT - 1}) // {FANOUT} AS n, pos // {FANOUT} AS pos, CASE WHEN n > 1 THEN sha256(string_agg(digest, '' ORDER BY pos)) ELSE min(digest) END AS digest,
               CASE WHEN n > 1 THEN list(digest ORDER BY pos) ELSE CAST([] AS VARCHAR[]) END AS kids FROM {name}{k} GROUP BY tree, n, pos // {FANOUT}, CAST(pos // {FANOUT} AS BIGINT))"""

    def step(name: str, rows: str, k: int) -> str:
        place = f"u.pos // {FANOUT ** k} % {FANOUT}"
        left, right = f"array_to_string(v.kids[1:{place}], '')", f"array_to_string(v.kids[{place} + 2:], '')"
        return f"""{rows}{k + 1} AS (SELECT u.* EXCLUDE (f0, p0), CASE WHEN len(v.kids) = 0 THEN f0 ELSE sha256({left} || f0 || {right}) END AS f0,
               CASE WHEN len(v.kids) = 0 THEN p0 ELSE p0 || {left} || {right} END AS p0 FROM {rows}{k} u JOIN {name}{k + 1} v ON u.{"tree" if name == "a" else "zero"} = v.tree AND u.pos // {FANOUT ** (k + 1)} = v.pos)"""

    parts += [level("a", k) for k in range(levels)]
    parts += ["x0 AS (SELECT * FROM l)", *[step("a", "x", k) for k in range(levels)]]
    parts += [f"b0 AS (SELECT 0 AS tree, (SELECT count(*) FROM s) AS n, tree AS pos, digest, CAST([] AS VARCHAR[]) AS kids FROM a{levels})"]
    parts += [level("b", k) for k in range(levels)]
    parts += [f"y0 AS (SELECT x.* EXCLUDE (pos), x.tree AS pos, 0 AS zero, a.digest AS subroot FROM x{levels} x JOIN a{levels} a USING (tree))", *[step("b", "y", k) for k in range(levels)]]
    return f"WITH {', '.join(parts)} SELECT doc_id, leaf, subroot, b.digest AS root, sha256(p0) AS proof_sha256, f0 AS folded_root, f0 = b.digest AS verified FROM y{levels}, b{levels} b"

"""Merkle manifest of a table: digest-to-children records, proofs by descent from the root.

Leaves are digests of rows. In each tree (one a language) they ascend by doc_id;
every FAN consecutive nodes become one node until one is left, the tree's
subroot. The subroots, by language, are the leaves of a last tree: its top is the root.

1. Leaves are digested in one pass over the texts and placed in their trees by a
   range sort, so a language that holds most rows is spread over all tasks.
2. Each height is one grouping by (tree, run); its records, digest to children, are
   written. A record is addressed by its content alone: equal subtrees share one.
3. Requests descend from the root. Those that share all digits of their rank so far
   travel as one row, which holds the digest to open next and the path: the children
   not selected, left and right, one segment a height. At each height the record is
   looked up by digest, and the requested digits select the children to go on with.
   Paths run from the root to the leaf; proofs are the reversed paths.

Nothing but the largest tree's size reaches the driver. Joins of the upper heights
are small; those below are dealt by digest, which are distinct. Spark chooses by the
written sizes what to broadcast.

Defined results: a null field is ``-``; a null doc_id comes first in its tree and is not
tampered with; a null language is a tree of its own, the first one; empty and very long texts are
digested whole; rows of one doc_id are ordered by their digests, and repeated rows have a place
and a proof each; an empty table gives no rows; columns other than FIELDS are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import lower_ascii, stored
from tripmart.llm.positions import with_positions

FAN = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def field(value: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, ``:`` and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaf_of(**replaced: Column) -> Column:
    """The digest of a row's FIELDS, some of them replaced."""
    return digest(*[field(replaced.get(c, F.col(c))) for c in FIELDS])


@dataclass
class Manifest:
    """leaves (tree, doc_id, leaf, ..., rank, n); records by height, from 1; the trees' tops; the same of the tree of trees."""

    leaves: DataFrame
    records: list[DataFrame]
    trees: DataFrame
    top_records: list[DataFrame]
    root: DataFrame


def build_tree(nodes: DataFrame, name: str) -> tuple[list[DataFrame], DataFrame]:
    """Records (digest, children) of each height, and a row a tree: tree, digest, height.

    nodes: tree, rank, n (nodes of its tree), digest; written already.
    """
    most = nodes.agg(F.max("n")).first()[0] or 0
    level, records, tops = nodes.select("tree", "rank", "n", "digest"), [], []
    tops.append(level.where("n = 1").select("tree", "digest", F.lit(0).alias("height")))
    while most > 1:
        run = F.floor(F.col("rank") / FAN).alias("rank")
        kids = F.sort_array(F.collect_list(F.struct(F.pmod("rank", F.lit(FAN)).alias("digit"), "digest")))
        above = level.where("n > 1").groupBy("tree", run, F.ceil(F.col("n") / FAN).alias("n")).agg(kids.alias("kids"))
        above = above.select("tree", "rank", "n", F.col("kids.digest").alias("children"))
        above = above.withColumn("digest", digest(F.array_join("children", "")))
        level = stored(above, f"{name}_height")
        records.append(level.select("digest", "children"))
        tops.append(level.where("n = 1").select("tree", "digest", F.lit(len(records)).alias("height")))
        most = -(-most // FAN)
    return records, reduce(DataFrame.union, tops)


def build_manifest(docs: DataFrame, **more: Column) -> Manifest:
    """The manifest of docs; ``more`` columns are computed in the same pass and stay with the leaves."""
    leaves = docs.select("doc_id", "lang", field(F.col("lang")).alias("tree"), leaf_of().alias("leaf"), *[c.alias(n) for n, c in more.items()])
    placed = with_positions(stored(leaves, "merkle_leaves"), "tree", ["doc_id", "leaf"], "rank", "merkle_ranks")
    sizes = stored(placed.groupBy("tree").agg(F.count(F.lit(1)).alias("n"), F.first("lang").alias("lang")), "merkle_sizes")
    # one row a tree: Spark broadcasts it by its written size; of a tree that holds most rows only the small key is repeated
    leaves = placed.join(sizes.drop("lang"), "tree")
    records, tops = build_tree(stored(leaves.select("tree", "rank", "n", F.col("leaf").alias("digest")), "merkle_nodes"), "merkle")
    langs = stored(tops.join(sizes.select("tree", "lang"), "tree").withColumn("one", F.lit("")), "merkle_trees")
    trees = with_positions(langs, "one", ["lang"], "rank", "merkle_tree_ranks")
    trees = stored(trees.join(trees.groupBy("one").agg(F.count(F.lit(1)).alias("n")), "one"), "merkle_top")
    top_records, root = build_tree(trees.select(F.col("one").alias("tree"), "rank", "n", "digest"), "merkle_top")
    return Manifest(leaves, records, trees, top_records, root)


def descend(tops: DataFrame, records: list[DataFrame], asked: DataFrame) -> DataFrame:
    """asked (tree, rank and more) with what lies above each: the columns of tops, and path from the top downwards.

    tops: tree, digest, height, path and more columns; path already holds what lies above the top.
    """
    own = [c for c in asked.columns if c not in ("tree", "rank")]
    carried = [c for c in tops.columns if c not in ("tree", "digest", "height", "path")]
    digit = F.pmod("rank", F.lit(FAN)).cast("int").alias("digit")
    # each height's requests are written: they are read for its own step and for the height above
    runs = asked.groupBy("tree", F.floor(F.col("rank") / FAN).alias("prefix")).agg(F.collect_list(F.struct(digit, "rank", *own)).alias("asked"))
    wanted = [stored(runs, "merkle_asked")]
    for _ in records[1:]:
        part = F.pmod("prefix", F.lit(FAN)).cast("int")
        above = wanted[-1].groupBy("tree", F.floor(F.col("prefix") / FAN).alias("prefix")).agg(F.collect_set(part).alias("asked"))
        wanted.append(stored(above, "merkle_asked"))
    ends = [tops.where("height = 0").join(asked, "tree").select("tree", "rank", *own, *carried, "digest", "path")]
    frontier = None
    for height in range(len(records), 0, -1):
        started = tops.where(F.col("height") == height).select("tree", F.lit(0).cast("long").alias("prefix"), "digest", "path", *carried)
        frontier = started if frontier is None else frontier.union(started)
        record = records[height - 1].groupBy("digest").agg(F.first("children").alias("children"))
        opened = frontier.join(record, "digest").drop("digest").join(wanted[height - 1], ["tree", "prefix"])
        opened = opened.withColumn("one", F.explode("asked"))
        at = F.col("one") if height > 1 else F.col("one.digit")
        beside = F.struct(F.array_join(F.slice("children", F.lit(1), at), "").alias("left"), F.array_join(F.slice("children", at + 2, F.lit(FAN)), "").alias("right"))
        taken = [F.get("children", at).alias("digest"), F.concat("path", F.array(beside)).alias("path")]
        if height > 1:
            frontier = opened.select("tree", (F.col("prefix") * FAN + at).alias("prefix"), *taken, *carried)
        else:
            ends.append(opened.select("tree", "one.rank", *[F.col(f"one.{c}").alias(c) for c in own], *carried, *taken))
    return reduce(DataFrame.unionByName, ends)


def prove(manifest: Manifest, requests: DataFrame | None = None) -> DataFrame:
    """requests (tree, rank and more; every leaf by default) with tree, rank, subroot, root, digest (the leaf's) and proof.

    proof: an array of (left, right), the siblings' digests joined, from the leaf's run up to the root's.
    """
    requests = manifest.leaves.drop("n", "lang", "leaf") if requests is None else requests
    no_path = F.array().cast("array<struct<left:string,right:string>>")
    root = manifest.root.select("tree", "digest", "height", no_path.alias("path"), F.col("digest").alias("root"))
    trees = manifest.trees.select(F.col("one").alias("tree"), "rank", F.col("tree").alias("of"), F.col("height").alias("of_height"))
    tops = descend(root, manifest.top_records, trees)
    tops = tops.select(F.col("of").alias("tree"), "digest", F.col("of_height").alias("height"), "path", F.col("digest").alias("subroot"), "root")
    return descend(stored(tops, "merkle_subroots"), manifest.records, requests).withColumn("proof", F.reverse("path")).drop("path")


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and a proof lead to."""
    return F.aggregate(proof, leaf, lambda node, beside: digest(beside["left"], node, beside["right"]))


def proof_digest(proof: Column) -> Column:
    return digest(F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), ""))


def is_tampered(doc_id: Column) -> Column:
    """Documents that the check alters: 3 divides the unsigned CRC-32 of the decimal doc_id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 0, F.lit(False))


def check_manifest(docs: DataFrame) -> DataFrame:
    """Every row's leaf, subroot, root and proof, and whether its text still leads to the root after tampering."""
    altered = F.when(is_tampered(F.col("doc_id")), leaf_of(text=lower_ascii(F.col("text"))))
    proved = prove(build_manifest(docs.select(*FIELDS), altered=altered))
    folded = proved.withColumn("folded_root", fold(F.coalesce("altered", "digest"), F.col("proof")))
    return folded.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("digest").alias("leaf"), "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))

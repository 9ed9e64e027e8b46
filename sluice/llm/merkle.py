"""Merkle manifest of a table as a content-addressed DAG.

Every row is a leaf digest.  Leaves of one source, in order, are grouped into
runs of ``ARITY``; the digest of a run becomes a node of the next level until one
node, the subroot, is left.  The subroots, in order of their sources, form one
more tree with the root of the table.  ``store`` keeps one record per distinct
node: digest -> children.  A proof is found by descent: a request starts at the
root with the rank of its leaf, each digit of the rank (base ``ARITY``) picks one
child of the record, the other children are kept, and the path is reversed at the
end.  Requests that share a prefix of digits descend together, so a record is
looked up once however many leaves lie below it and no digest is a hot key.

Ranks come from a range-partitioned sort and one row count per partition; the
driver sees the number of levels only.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.operators.sequence import numbered
from sluice.session import new_run_dir

ARITY = 16
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(text: Column) -> Column:
    return F.sha2(text, 256)


def row_digest(columns: dict[str, Column]) -> Column:
    """Digest of a row: every value with its length in bytes, ``-`` for null."""
    def part(c: Column) -> Column:
        s = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))
    return digest(F.concat(*[part(c) for c in columns.values()]))


def kept(df: DataFrame, place: str) -> DataFrame:
    """``df`` written to the shared folder and read back."""
    df.write.parquet(place)
    return df.sparkSession.read.parquet(place)


def store(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Records of all trees of ``nodes`` and their tops.

    ``nodes`` (tree, pos, digest, size): size is the number of nodes of the tree.
    Returns the levels from the bottom, each (tree, pos, digest, children, size
    of that level), and (tree, height, digest) of the top node of each tree.
    """
    folder = new_run_dir(nodes.sparkSession, "merkle-store")
    most = nodes.agg(F.max("size")).first()[0] or 0
    levels, tops = [], nodes.where("size = 1").select("tree", F.lit(0).alias("height"), "digest")
    while most > 1:
        most = -(-most // ARITY)
        runs = (nodes.where("size > 1")
                .groupBy("tree", F.expr(f"pos div {ARITY}").alias("pos"),
                         F.expr(f"(size + {ARITY - 1}) div {ARITY}").alias("size"))
                .agg(F.sort_array(F.collect_list(F.struct("pos", "digest")))["digest"].alias("children")))
        nodes = kept(runs.withColumn("digest", digest(F.array_join("children", ""))), f"{folder}/{len(levels) + 1}")
        levels.append(nodes)
        tops = tops.union(nodes.where("size = 1").select("tree", F.lit(len(levels)), "digest"))
    return levels, tops


def descend(levels: list[DataFrame], tops: DataFrame, requests: DataFrame) -> DataFrame:
    """``requests`` (tree, pos, ...) with ``path``: what was not selected on the way
    down to each, from the top, appended to the ``path`` of the tree's top.

    ``tops``: (tree, height, digest, path).  A step of the path holds the children
    left and right of the selected one.  ``wanted[k]`` has one row per node of level
    ``k`` on the way to any request.
    """
    folder = new_run_dir(requests.sparkSession, "merkle-requests")
    wanted = [requests]
    for k, _ in enumerate(levels[1:], 1):
        w = wanted[-1].select("tree", F.expr(f"pos div {ARITY}").alias("pos")).distinct()
        wanted.append(kept(w, f"{folder}/{k}"))

    def arrive(k: int) -> DataFrame:
        return tops.where(F.col("height") == k).select("tree", F.lit(0).cast("long").alias("pos"), "digest", "path")

    at = arrive(len(levels))
    for k in range(len(levels), 0, -1):
        records = levels[k - 1].groupBy("digest").agg(F.any_value("children").alias("children"))
        found = at.join(records, "digest").select("tree", F.col("pos").alias("parent"), "children", "path")
        below = wanted[k - 1].withColumns({"parent": F.expr(f"pos div {ARITY}"), "digit": (F.col("pos") % ARITY).cast("int")})
        i, c = F.col("digit"), F.col("children")
        step = F.struct(F.array_join(F.slice(c, F.lit(1), i), "").alias("left"),
                        F.array_join(F.slice(c, i + 2, F.lit(ARITY)), "").alias("right"))
        at = found.join(below, ["tree", "parent"]).select(
            *[x for x in below.columns if x not in ("parent", "digit")],
            c[i].alias("digest"), F.array_append("path", step).alias("path"))
        ends = arrive(k - 1)
        if k == 1:  # leaves that are the top of their tree
            ends = ends.drop("pos").join(requests, "tree").select(*at.columns)
        at = at.unionByName(ends)
    return at if levels else arrive(0).drop("pos").join(requests, "tree")


def proof(path: Column) -> Column:
    """Digest of all siblings, from the leaf up, left to right."""
    return digest(F.array_join(F.transform(F.reverse(path), lambda s: F.concat(s["left"], s["right"])), ""))


def fold(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` gives with the siblings of ``path``."""
    return F.aggregate(F.reverse(path), leaf, lambda d, s: digest(F.concat(s["left"], d, s["right"])))


def manifest(docs: DataFrame, tampered: Column, changed: dict[str, Column]) -> DataFrame:
    """Leaf, subroot, root and proof of every row, and a check of a tampered copy.

    Rows where ``tampered`` holds are read again with the columns in ``changed``;
    ``folded_root`` comes from that leaf and the siblings of the original.  Nulls
    count as ``-`` in a digest and sort first (sources and ids); rows of equal
    source and id go by their digest; equal rows are leaves of their own; an empty
    text is not a null one.  An empty table has no rows.  Other columns are ignored.
    """
    own = {c: F.col(c) for c in COLUMNS}
    folder = new_run_dir(docs.sparkSession, "merkle-leaves")
    leaves = kept(docs.select("doc_id", "source", row_digest(own).alias("leaf"),
                              F.when(tampered, row_digest({**own, **changed})).alias("other")), f"{folder}/leaves")
    leaves = numbered(leaves.withColumn("row", F.monotonically_increasing_id()), ["source", "doc_id", "leaf", "row"], "rank")

    per_source = leaves.groupBy("source").agg(F.min("rank").alias("first"), F.count("*").alias("size"))
    sources = numbered(per_source, ["first"], "tree").withColumnRenamed("source", "name")
    requests = kept(leaves.join(sources, F.col("source").eqNullSafe(F.col("name"))).select(
        "doc_id", "leaf", "other", "tree", (F.col("rank") - F.col("first")).alias("pos"), "size"), f"{folder}/requests")

    none = F.array().cast("array<struct<left:string,right:string>>")
    levels, tops = store(requests.select("tree", "pos", F.col("leaf").alias("digest"), "size"))
    tops = kept(tops, f"{folder}/subroots")
    n = tops.count()
    over, top = store(tops.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("pos"), "digest",
                                  F.lit(n).cast("long").alias("size")))
    root = top.withColumn("path", none)
    to_sources = descend(over, root, tops.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("pos"), "height"))
    starts = kept(to_sources.select(F.col("pos").alias("tree"), "height", "digest", "path"), f"{folder}/starts")
    found = descend(levels, starts, requests.drop("size"))
    subroots = starts.select("tree", F.col("digest").alias("subroot"))
    top_digest = top.select(F.col("digest").alias("root"))
    folded = fold(F.coalesce("other", "leaf"), F.col("path"))
    return (found.select("doc_id", "leaf", "tree", proof(F.col("path")).alias("proof_sha256"), folded.alias("folded_root"))
            .join(subroots, "tree").join(F.broadcast(top_digest))  # one row
            .select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root",
                    (F.col("folded_root") == F.col("root")).alias("verified")))


def lowered() -> Column:
    """``text`` with A-Z, and no other letters, in lower case."""
    return F.translate("text", string.ascii_uppercase, string.ascii_lowercase)


def manifest_of_documents(docs: DataFrame) -> DataFrame:
    """The manifest, with texts lower-cased where 5 divides the CRC-32 of the id."""
    return manifest(docs, F.crc32(F.col("doc_id").cast("string")) % 5 == 0, {"text": lowered()})


def manifest_sql(heights: tuple[int, int] = (6, 4)) -> str:
    """DuckDB twin; up to 16^6 rows a source and 16^4 sources."""
    def row(text: str) -> str:
        def part(c: str) -> str:
            return f"coalesce(octet_length(encode(({c})::VARCHAR)) || ':' || ({c})::VARCHAR, '-')"
        return "sha256(" + " || ".join(part(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    bits = "lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    chars = "list_transform(string_split(doc_id::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT)"
    crc = (f"xor(list_reduce(list_concat([4294967295::BIGINT], {chars}), lambda a, b: "
           f"list_reduce(list_concat([xor(a, b)], [0, 0, 0, 0, 0, 0, 0, 0]), {bits})), 4294967295)")
    low = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"

    def tree(name: str, height: int) -> list[str]:
        """Levels ``name``0.. of (tree, pos, d, size) with the siblings of each node."""
        out = []
        for k in range(height):
            run = f"PARTITION BY tree, pos // {ARITY} ORDER BY pos ROWS BETWEEN"
            out.append(f"""{name}s{k} AS (SELECT tree, pos, d, size,
  coalesce(string_agg(d, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
  coalesce(string_agg(d, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name}{k} WHERE size > 1)""")
            out.append(f"""{name}{k + 1} AS (SELECT tree, pos // {ARITY} AS pos, (size + {ARITY - 1}) // {ARITY} AS size,
  sha256(string_agg(d, '' ORDER BY pos)) AS d FROM {name}{k} WHERE size > 1 GROUP BY ALL)""")
        tops = " UNION ALL ".join(f"SELECT tree, d FROM {name}{k} WHERE size = 1" for k in range(height + 1))
        return [*out, f"{name}top AS ({tops})"]

    def climb(name: str, height: int, start: str, tree_col: str, pos_col: str) -> tuple[list[str], str]:
        steps, at = [], start
        for k in range(height):
            steps.append(f"""{name}c{k} AS (SELECT a.* EXCLUDE (p, f),
  a.p || coalesce(s.l || s.r, '') AS p, CASE WHEN s.d IS NULL THEN a.f ELSE sha256(s.l || a.f || s.r) END AS f
  FROM {at} a LEFT JOIN {name}s{k} s ON s.tree = a.{tree_col} AND s.pos = a.{pos_col} // {ARITY ** k})""")
            at = f"{name}c{k}"
        return steps, at

    up, leaf_end = climb("n", heights[0], "start", "tree", "pos")
    up2, end = climb("m", heights[1], leaf_end, "zero", "tree")
    ctes = [
        f"leaves AS (SELECT doc_id, source, {row('text')} AS leaf, CASE WHEN {crc} % 5 = 0 THEN {row(low)} END AS other FROM documents)",
        """numbered AS (SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
  row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
  count(*) OVER (PARTITION BY source) AS size FROM leaves)""",
        "n0 AS (SELECT tree, pos, leaf AS d, size FROM numbered)", *tree("n", heights[0]),
        "m0 AS (SELECT 0 AS tree, tree AS pos, d, (SELECT count(*) FROM ntop) AS size FROM ntop)", *tree("m", heights[1]),
        "start AS (SELECT doc_id, leaf, tree, pos, 0 AS zero, '' AS p, coalesce(other, leaf) AS f FROM numbered)", *up, *up2]
    return "WITH " + ",\n".join(ctes) + f"""
SELECT e.doc_id, e.leaf, t.d AS subroot, m.d AS root, sha256(e.p) AS proof_sha256, e.f AS folded_root, e.f = m.d AS verified
FROM {end} e JOIN ntop t ON t.tree = e.tree CROSS JOIN mtop m"""

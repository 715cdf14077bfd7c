"""A Merkle manifest of a table, and a proof of every row against it.

Each row is a leaf, the hash of its fields. The leaves of a source ascend by doc_id; while
a level has several nodes, every 16 consecutive ones become the hash of their digests. What
is left is the source's subroot, and the subroots, by source, give the root the same way.

The built levels are stored as rows that name their parent, with the digests beside them in
their run. A recursive query climbs from the leaves: at each step it joins the node's row,
appends the siblings and folds its own, perhaps tampered, digest into the parent's. The 16
leaves of a run share every node above them, so they climb in one row that holds the digest
of each leaf, folded on its own, and the siblings once: the recursion carries a sixteenth
of the rows and of the proofs.

Near the root many rows meet at one node. Node rows are therefore repeated for every block
of ``BLOCK`` runs beneath them, and rows climb within their block, so that a join key has
no more than ``BLOCK`` rows however large a source is; a node of the lower levels lies in
one or two blocks, and those above repeat once in 65,536 leaves. Leaves are numbered by a
range sort and the totals of its partitions, never by a window over a source.

Defined cases: a null field is ``-``, so a null text is another leaf than an empty one, and
tampering leaves it; a null doc_id comes first in its source and is never tampered; equal
doc_ids of a source are ordered by their leaves, and equal rows each get their row, with the
proof of their own place; a source of one row has its leaf as subroot, and a table of one
source its subroot as root; a proof without siblings is the hash of the empty text; an empty
table gives an empty table; further columns are left out of the leaves and of the result.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rowtide.llm.common import LOWER, UPPER, lower_ascii, settle

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FAN = 16
#: Leaf runs of a block: the most rows that join one copy of a node's row.
BLOCK = 4096
#: Sources that one window numbers.
SPAN = 65_536
#: The tree above the sources, whose own trees are numbered from 0.
_TOP = -1
RESULT = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaves(docs: DataFrame) -> DataFrame:
    """doc_id, source, leaf, and ``changed``, the leaf of the tampered row where there is one."""
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    one = lambda text: digest(*[_field(text if c == "text" else F.col(c)) for c in FIELDS])
    return docs.select("doc_id", "source", one(F.col("text")).alias("leaf"), F.when(tampered, one(lower_ascii(F.col("text")))).alias("changed"))


def _placed(df: DataFrame, *order: str) -> DataFrame:
    """``df`` sorted and settled, with ``part`` and ``at``, a row's partition and place in it."""
    sorted_ = settle(df.repartitionByRange(*order).sortWithinPartitions(*order))
    number = F.monotonically_increasing_id()
    return sorted_.withColumn("__no", number).select(*df.columns, F.shiftright("__no", 33).alias("part"), F.col("__no").bitwiseAND((1 << 33) - 1).alias("at"))


def _sources(parts: DataFrame) -> DataFrame:
    """Every source with its number, its leaves ``n``, its runs ``r`` and the first run's number."""
    placed = _placed(settle(parts.groupBy("source").agg(F.sum("n").alias("n"))), "source")
    # One row per partition.
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    base = placed.groupBy("part").agg(F.count("*").alias("c")).select("part", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("base"))
    numbered = placed.join(base, "part").select(
        "source", "n", F.ceil(F.col("n") / FAN).alias("r"), (F.col("base") + F.col("at")).alias("tree")
    ).withColumn("span", F.floor(F.col("tree") / SPAN))
    totals = numbered.groupBy("span").agg(F.sum("r").alias("t"))
    totals = totals.select("span", F.coalesce(F.sum("t").over(W.orderBy("span").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("t"))
    within = W.partitionBy("span").orderBy("tree").rowsBetween(W.unboundedPreceding, -1)
    first = (F.col("t") + F.coalesce(F.sum("r").over(within), F.lit(0))).alias("first")
    return settle(numbered.join(totals, "span").select("source", "tree", "n", "r", first))


def leaf_runs(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The leaves in runs of 16 (tree, idx, g, block, n, own), and the sources."""
    ordered = _placed(settle(leaves(docs)), "source", "doc_id", "leaf")
    parts = settle(ordered.groupBy("part", "source").agg(F.min("at").alias("begin"), F.count("*").alias("n")))
    sources = _sources(parts)
    # A source has a row in each partition that it reaches, so no key has more leaves than a partition.
    before = W.partitionBy("tree").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    p, s = parts.withColumnRenamed("n", "c").alias("p"), sources.alias("s")
    offsets = p.join(s, F.col("p.source").eqNullSafe(F.col("s.source"))).select(
        "p.part", "p.source", "s.tree", "s.n", "s.first", (F.coalesce(F.sum("c").over(before), F.lit(0)) - F.col("begin")).alias("shift")
    )
    o = ordered.alias("o").join(offsets.alias("f"), (F.col("o.part") == F.col("f.part")) & F.col("o.source").eqNullSafe(F.col("f.source")))
    numbered = o.select("o.doc_id", "o.leaf", "o.changed", "f.tree", "f.n", "f.first", (F.col("at") + F.col("shift")).alias("place"))
    run = F.floor(F.col("place") / FAN)
    own = F.array_sort(F.collect_list(F.struct("place", "doc_id", "leaf", "changed")))
    runs = numbered.groupBy("tree", run.alias("idx"), "n", "first").agg(own.alias("own"))
    g = F.col("first") + F.col("idx")
    return settle(runs.select("tree", "idx", g.alias("g"), F.floor(g / BLOCK).alias("block"), "n", "own")), sources


def _beside(run: Column, at: Column) -> tuple[Column, Column]:
    """The digests before and after a place of a run, joined."""
    return F.array_join(F.slice(run, F.lit(1), at), ""), F.array_join(F.slice(run, at + 2, F.lit(FAN)), "")


def _risen(level: DataFrame, height: int) -> tuple[DataFrame, DataFrame]:
    """Of the nodes of one level that aren't alone: their rows with their parents, and the next level."""
    members = F.array_sort(F.collect_list(F.struct("idx", "digest", "low", "high")))
    runs = settle(level.filter("r > 1").groupBy("tree", F.floor(F.col("idx") / FAN).alias("up"), "r").agg(members.alias("m")))
    each = runs.select("tree", "up", F.col("m.digest").alias("run"), F.posexplode("m").alias("at", "own"))
    left, right = _beside(F.col("run"), F.col("at"))
    rows = each.select(
        "tree", F.lit(height).alias("level"), "own.idx",
        F.col("tree").alias("p_tree"), F.lit(height + 1).alias("p_level"), F.col("up").alias("p_idx"),
        left.alias("left"), right.alias("right"), "own.low", "own.high",
    )
    above = runs.select(
        "tree", F.col("up").alias("idx"), F.ceil(F.col("r") / FAN).alias("r"), F.sha2(F.array_join("m.digest", ""), 256).alias("digest"),
        F.array_min("m.low").alias("low"), F.array_max("m.high").alias("high"),
    )
    return rows, above


def _tree(level: DataFrame, height: int) -> tuple[list[DataFrame], list[tuple[int, DataFrame]]]:
    """The node rows of all levels, and by height what is left alone at the end."""
    rows, ends, most = [], [], level.agg(F.max("r")).first()[0] or 0
    while True:
        ends.append((height, level.filter("r = 1")))
        if most <= 1:
            return rows, ends
        risen, level = _risen(level, height)
        rows.append(risen)
        most, height = -(-most // FAN), height + 1


def _all(frames: list[DataFrame]) -> DataFrame:
    whole = frames[0]
    for f in frames[1:]:
        whole = whole.unionByName(f)
    return whole


def levels(runs: DataFrame, sources: DataFrame) -> tuple[DataFrame, DataFrame, tuple[int, int], str]:
    """The node rows, the sources' subroots, the root's place (tree, level) and its digest."""
    own = F.array_join("own.leaf", "")
    # A run of a source of one leaf is that leaf, all others are hashes.
    first = runs.select(
        "tree", "idx", F.ceil(F.col("n") / FAN).alias("r"), F.when(F.col("n") == 1, own).otherwise(F.sha2(own, 256)).alias("digest"),
        F.col("g").alias("low"), F.col("g").alias("high"),
    )
    rows, ends = _tree(first, 1)
    subroots = settle(_all([e.select("tree", F.lit(h).alias("level"), "digest", "low", "high") for h, e in ends]))
    n = subroots.count()
    if n < 2:
        one = subroots.first()
        return _all(rows) if rows else _no_nodes(runs.sparkSession), subroots, (one.tree, one.level), one.digest
    # The subroots are the lowest level of the tree above the sources.
    top = subroots.select(F.lit(_TOP).cast("long").alias("tree"), F.col("tree").alias("idx"), F.lit(n).cast("long").alias("r"), "digest", "low", "high")
    above, ends = _tree(top, 0)
    height, root = ends[-1]
    entry = subroots.select(F.col("tree").alias("idx"), F.col("tree").alias("s_tree"), F.col("level").alias("s_level"))
    crossing = above[0].join(entry, "idx").select(
        F.col("s_tree").alias("tree"), F.col("s_level").alias("level"), F.lit(0).cast("long").alias("idx"), *above[0].columns[3:]
    )
    return _all([*rows, crossing, *above[1:]]), subroots, (_TOP, height), root.first().digest


def _no_nodes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [], "tree long, level int, idx long, p_tree long, p_level int, p_idx long, left string, right string, low long, high long"
    )


@contextmanager
def _no_row_limit(spark: SparkSession):
    """Recursive queries of the session without a limit on their rows, which Spark sets to a million."""
    name = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        yield
    finally:
        spark.conf.set(name, before)


CLIMB = """
WITH RECURSIVE climb MAX RECURSION LEVEL 64 AS (
  SELECT block, g, tree, level, idx, folded, CAST('' AS STRING) AS proof FROM {runs}
  UNION ALL
  SELECT c.block, c.g, n.p_tree, n.p_level, n.p_idx,
         transform(c.folded, f -> sha2(concat(n.left, f, n.right), 256)),
         concat(c.proof, n.left, n.right)
  FROM climb c JOIN {nodes} n
    ON c.block = n.block AND c.tree = n.tree AND c.level = n.level AND c.idx = n.idx
)
SELECT block, g, folded AS tops, proof FROM climb WHERE tree = {tree} AND level = {level}
"""


def climbed(runs: DataFrame, nodes: DataFrame, root: tuple[int, int]) -> DataFrame:
    """For every run its number, its leaves' digests folded up to the root, and the siblings on the way."""

    def folded(leaf: Column, at: Column) -> Column:
        left, right = _beside(F.col("own.leaf"), at)
        mine = F.coalesce(leaf["changed"], leaf["leaf"])
        return F.when(F.col("n") == 1, mine).otherwise(digest(left, mine, right))

    start = settle(runs.select("block", "g", "tree", F.lit(1).alias("level"), "idx", F.transform("own", folded).alias("folded")))
    blocks = F.explode(F.sequence(F.floor(F.col("low") / BLOCK), F.floor(F.col("high") / BLOCK)))
    stored = settle(nodes.select("*", blocks.alias("block")).drop("low", "high"))
    with _no_row_limit(runs.sparkSession):
        return settle(runs.sparkSession.sql(CLIMB, runs=start, nodes=stored, tree=root[0], level=root[1]))


def manifest(docs: DataFrame) -> DataFrame:
    """Every row's leaf, subroot and root, its proof's hash, and the root folded from the row as it may have been tampered with."""
    runs, sources = leaf_runs(docs)
    if runs.isEmpty():
        kind = docs.schema["doc_id"].dataType
        nothing = docs.sparkSession.createDataFrame([], "leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
        return nothing.withColumn("doc_id", F.lit(None).cast(kind)).select(*RESULT)
    nodes, subroots, place, root = levels(runs, sources)
    blocks = F.explode(F.sequence(F.floor(F.col("low") / BLOCK), F.floor(F.col("high") / BLOCK)))
    subroot = subroots.select("tree", F.col("digest").alias("subroot"), blocks.alias("block"))
    done = runs.join(climbed(runs, nodes, place).drop("block"), "g").join(subroot, ["tree", "block"])
    each = done.select("*", F.posexplode("own").alias("at", "mine"))
    left, right = _beside(F.col("own.leaf"), F.col("at"))
    top = F.get(F.col("tops"), F.col("at"))
    return each.select(
        "mine.doc_id", "mine.leaf", "subroot", F.lit(root).alias("root"), digest(left, right, F.col("proof")).alias("proof_sha256"),
        top.alias("folded_root"), (top == F.lit(root)).alias("verified"),
    )


def _sql_field(name: str, value: str | None = None) -> str:
    text = value or f"CAST({name} AS VARCHAR)"
    return f"CASE WHEN {name} IS NULL THEN '-' ELSE strlen({text}) || ':' || {text} END"


def _sql_leaf(text: str | None = None) -> str:
    return "sha256(" + " || ".join(_sql_field(c, text if c == "text" else None) for c in FIELDS) + ")"


# The CRC of a decimal number's text, bit by bit: xor the byte in, then eight times halve and xor.
_SQL_CRC = (
    "xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), "
    "list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda b: CAST(ascii(b) AS BIGINT))), "
    "lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))))"
)

ORACLE = f"""
WITH RECURSIVE leaf AS MATERIALIZED (
  SELECT *, row_number() OVER () AS row_no, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
         count(*) OVER (PARTITION BY source) AS n, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree
  FROM (
    SELECT doc_id, source, {_sql_leaf()} AS leaf,
           CASE WHEN {_SQL_CRC} % 5 = 0 THEN {_sql_leaf(f"translate(text, '{UPPER}', '{LOWER}')")} ELSE {_sql_leaf()} END AS changed
    FROM documents)
), up(tree, level, idx, digest, n) AS (
  SELECT tree, 0, idx, leaf, n FROM leaf
  UNION ALL
  SELECT tree, level + 1, idx // 16, sha256(string_agg(digest, '' ORDER BY idx)), (any_value(n) + 15) // 16
  FROM up WHERE n > 1 GROUP BY tree, level, idx // 16
), subroot AS MATERIALIZED (
  SELECT tree, level, digest, count(*) OVER () AS n FROM up WHERE n = 1
), above(level, idx, digest, n) AS (
  SELECT 0, tree, digest, n FROM subroot
  UNION ALL
  SELECT level + 1, idx // 16, sha256(string_agg(digest, '' ORDER BY idx)), (any_value(n) + 15) // 16
  FROM above WHERE n > 1 GROUP BY level, idx // 16
), run AS MATERIALIZED (
  SELECT tree, level, idx // 16 AS up, list(digest ORDER BY idx) AS ds FROM up WHERE n > 1 GROUP BY ALL
  UNION ALL
  SELECT -1, level, idx // 16, list(digest ORDER BY idx) FROM above WHERE n > 1 GROUP BY ALL
), top AS (
  SELECT digest AS root FROM above WHERE n = 1
), climb(row_no, home, tree, level, idx, folded, proof) AS (
  SELECT row_no, tree, tree, 0, idx, changed, '' FROM leaf
  UNION ALL
  SELECT * FROM (
    SELECT c.row_no, c.home, r.tree, r.level + 1 AS level, r.up AS idx,
           sha256(array_to_string(ds[:c.idx % 16], '') || c.folded || array_to_string(ds[c.idx % 16 + 2:], '')),
           c.proof || array_to_string(ds[:c.idx % 16], '') || array_to_string(ds[c.idx % 16 + 2:], '')
    FROM climb c JOIN run r ON c.tree = r.tree AND c.level = r.level AND c.idx // 16 = r.up
    UNION ALL
    SELECT c.row_no, c.home, -1, 0, c.home, c.folded, c.proof
    FROM climb c JOIN subroot s ON c.tree = s.tree AND c.level = s.level)
)
SELECT l.doc_id, l.leaf, s.digest AS subroot, t.root, sha256(c.proof) AS proof_sha256,
       c.folded AS folded_root, c.folded = t.root AS verified
FROM climb c JOIN above a ON c.tree = -1 AND c.level = a.level AND a.n = 1
JOIN leaf l USING (row_no) JOIN subroot s ON s.tree = l.tree, top t
"""

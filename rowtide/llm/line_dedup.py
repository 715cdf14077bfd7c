"""Cross-site boilerplate lines: HyperLogLog spread per line hash, exact near the threshold.

A line (between ``\\n``, outer blanks off, ``min_words`` words or more) that stands on
``min_sites`` sites or more is boilerplate. Each line's sites are gathered in one
HyperLogLog sketch per line hash; sketches are merged by aggregation, on the map side
first, so a line that stands in a third of all documents costs one sketch a task. Where
the estimate is further than ``band`` from the threshold it decides; the others get exact
distinct counts. Boilerplate stays where it comes first, by (doc_id, line number), and is
taken from everywhere else: a text that is only ever seen as copies is not lost.

Defined cases: a null or empty text has no lines to lose and comes back as it was; a null
site counts as one site of its own; a null doc_id sorts first; rows repeated with the same
doc_id and text are treated alike, so if one keeps a line all of them do; other columns
pass through, whatever their names; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.llm.common import SPACE_CHARS, let, settle, text_of, words

MIN_SITES = 5
MIN_WORDS = 3
#: 2**10 registers: a standard error of about 3 %, exact in effect for a few dozen sites.
LOG_K = 10


def _lines(docs: DataFrame, doc_id: str, text: str, site: str, min_words: int) -> DataFrame:
    """doc, version (hash of the text), pos, site and two hashes of each line that may be boilerplate."""
    line = F.trim(F.col("__line"), F.lit(SPACE_CHARS))
    return (
        docs.select(
            F.col(doc_id).alias("doc"),
            F.xxhash64(text).alias("version"),
            F.coalesce(F.concat(F.lit("="), F.col(site).cast("string")), F.lit("")).alias("site"),
            F.posexplode(F.split(F.col(text), "\n")).alias("pos", "__line"),
        )
        .withColumn("__line", line)
        .filter(F.size(words(F.col("__line"))) >= min_words)
        .select("doc", "version", "pos", "site", F.xxhash64("__line").alias("h"), F.crc32("__line").alias("g"))
    )


def line_spread(lines: DataFrame, log_k: int = LOG_K) -> DataFrame:
    """Per line hash: the estimated number of its sites, and where it stands first."""
    return lines.groupBy("h", "g").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(log_k))).alias("estimate"),
        F.min(F.struct("doc", "pos")).alias("first"),
    )


def removals(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    site: str = "source",
    min_sites: int = MIN_SITES,
    min_words: int = MIN_WORDS,
    log_k: int = LOG_K,
) -> DataFrame:
    """Per document and text that loses lines: ``doc``, ``version`` and the line numbers to drop."""
    band = max(1.0, 6 * 1.04 * min_sites / 2 ** (log_k / 2))
    lines = _lines(docs, doc_id, text, site, min_words)
    spread = line_spread(lines, log_k).filter(F.col("estimate") >= min_sites - band)
    met = settle(lines.join(spread, ["h", "g"]))
    near = met.filter(F.col("estimate") <= min_sites + band)
    exact = near.groupBy("h", "g").agg(F.count_distinct("site").alias("sites")).filter(F.col("sites") >= min_sites)
    far = met.filter(F.col("estimate") > min_sites + band)
    boilerplate = near.join(exact.select("h", "g"), ["h", "g"], "left_semi").unionByName(far)
    here = F.struct("doc", "pos")
    return (
        boilerplate.filter(~here.eqNullSafe(F.col("first")))
        .groupBy("doc", "version")
        .agg(F.collect_set("pos").alias("drop"))
    )


def remove_boilerplate(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    site: str = "source",
    counts: tuple[str, str] | None = None,
    **rule,
) -> DataFrame:
    """``docs`` with boilerplate lines taken from ``text``.

    ``counts`` names two more columns: the lines of the text and those taken from it.
    """
    drop = removals(docs, doc_id, text, site, **rule)
    left, right = docs.alias("d"), drop.alias("r")
    key = F.col(f"d.`{doc_id}`").eqNullSafe(F.col("r.doc")) & (F.xxhash64(F.col(f"d.`{text}`")) == F.col("r.version"))
    joined = left.join(right, key, "left")
    own, gone = F.col(f"d.`{text}`"), F.col("r.drop")
    columns = [F.col(f"d.`{c}`") for c in docs.columns if c != text]
    if counts:
        n = F.when(own.isNull() | (own == ""), F.lit(0)).otherwise(F.size(F.split(own, "\n")))
        columns += [n.cast("long").alias(counts[0]), F.coalesce(F.size(gone), F.lit(0)).cast("long").alias(counts[1])]
    left_over = let(
        F.split(own, "\n"),
        lambda ls: F.array_join(
            F.transform(F.array_except(F.sequence(F.lit(0), F.size(ls) - 1), gone), lambda i: F.get(ls, i)), "\n"
        ),
    )
    kept = F.when(gone.isNull(), own).otherwise(left_over)
    return joined.select(*columns, kept.alias(text)).select(
        *[F.col(f"`{c}`") for c in docs.columns], *(counts or ())
    )


def line_report(docs: DataFrame, **rule) -> DataFrame:
    """doc_id, n_lines, n_removed and the SHA-256 of the text that stays (null: empty)."""
    done = remove_boilerplate(docs.select("doc_id", "text", "source"), counts=("n_lines", "n_removed"), **rule)
    return done.select("doc_id", "n_lines", "n_removed", F.sha2(text_of(), 256).alias("text_sha256"))


ORACLE = f"""
WITH d AS (SELECT doc_id, source, text, string_split(text, chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, source, generate_subscripts(ls, 1) AS pos, unnest(ls) AS raw FROM d),
t AS (SELECT doc_id, coalesce('=' || source, '') AS site, pos, raw,
        trim(raw, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS line FROM l),
c AS (SELECT line, min((doc_id, pos)) AS first_at FROM t
      WHERE len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) >= {MIN_WORDS}
      GROUP BY line HAVING count(DISTINCT site) >= {MIN_SITES}),
m AS (SELECT t.*, c.line IS NOT NULL AND (t.doc_id, t.pos) <> c.first_at AS gone
      FROM t LEFT JOIN c ON t.line = c.line),
r AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
        coalesce(string_agg(raw, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS text FROM m GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL OR d.text = '' THEN 0 ELSE r.n_lines END::BIGINT AS n_lines,
  coalesce(r.n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(r.text, '')) AS text_sha256
FROM documents d LEFT JOIN r ON d.doc_id = r.doc_id
"""

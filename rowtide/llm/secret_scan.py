"""Secrets found through a trigram inverted index.

From each rule's regular expression come trigrams that a match must hold, as a Boolean
query (``trigram_query``): alternatives are ORed, the trigrams of one alternative ANDed. The index holds the
postings (trigram, document) of every trigram that any query names, letters folded to
lower case; a rule's postings are intersected per document, and only documents that meet
its query are verified with the expression itself. Rules without mandatory trigrams, such
as runs of hexadecimal digits, are run over every document.

Trigrams are looked for with plain substring search and postings meet in one aggregate
per document, a bit for each trigram in as many masks as it takes, combined on the map side:
however common a trigram is, a document costs one row.

Defined cases: a null text is empty; an empty text has no spans; spans are code points
from 0, the end exclusive; matches of one rule don't overlap, those of different rules
may; rows repeated with the same doc_id and text each get the same spans; other columns
pass through where asked for; an empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.llm.common import lower_ascii, text_of
from rowtide.llm.regex_trigrams import Clause, trigram_query


@dataclass(frozen=True)
class Rule:
    """A kind of secret."""

    kind: str
    pattern: str
    #: A group and the characters it must have at least, else the match is dropped.
    least: tuple[int, int] = (0, 1)

    def query(self) -> tuple[Clause, ...]:
        """A match holds, of every clause, all trigrams of one set; empty if nothing is certain."""
        return trigram_query(self.pattern)


RULES = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        (2, 6),
    ),
    Rule("access", r"AKIA[A-Z0-9]+", (0, 20)),
    # A run of 24 and more is found at the same place as the whole run cut by length.
    Rule("hex", r"[0-9a-f]{24,}"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
BASE = ("assign", "access", "hex")


#: Trigrams of one mask: the bits of a long but for its sign.
MASK = 63


def vocabulary(rules: tuple[Rule, ...] = RULES) -> list[str]:
    """The trigrams that any rule asks for."""
    return sorted({t for r in rules for clause in r.query() for way in clause for t in way})


def postings(docs: DataFrame, doc_id: str, text: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(trigram, doc, version): where each trigram of the rules occurs."""
    folded = docs.select(F.col(doc_id).alias("doc"), F.xxhash64(text).alias("version"), lower_ascii(text_of(text)).alias("__t"))
    looked = [F.when(F.contains("__t", F.lit(t)), F.lit(t)) for t in vocabulary(rules)]
    held = F.array_compact(F.array(*looked).cast("array<string>"))
    return folded.select("doc", "version", F.explode(held).alias("trigram"))


def candidates(index: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc, version, rules): documents that meet the trigram query of a rule, by the numbers of the rules."""
    place = {t: divmod(i, MASK) for i, t in enumerate(vocabulary(rules))}
    masks = max((m for m, _ in place.values()), default=-1) + 1
    if not masks:
        return index.select("doc", "version", F.array().cast("array<int>").alias("rules")).limit(0)
    bits = [F.create_map(*[F.lit(x) for t, (k, b) in place.items() if k == m for x in (t, 1 << b)]) for m in range(masks)]
    met = index.groupBy("doc", "version").agg(*[F.bit_or(bits[m][F.col("trigram")]).alias(f"held{m}") for m in range(masks)])

    def holds(way: frozenset[str]) -> Column:
        need = [0] * masks
        for t in way:
            need[place[t][0]] |= 1 << place[t][1]
        return reduce(lambda a, b: a & b, [F.col(f"held{m}").bitwiseAND(F.lit(n)) == n for m, n in enumerate(need) if n])

    wanted = []
    for i, rule in enumerate(rules):
        clauses = [reduce(lambda a, b: a | b, [holds(way) for way in clause]) for clause in rule.query()]
        if clauses:
            # A mask without any posting is null, and so is a clause that asks for it: no candidate.
            wanted.append(F.when(reduce(lambda a, b: a & b, clauses), F.lit(i)))
    return met.select("doc", "version", F.array_compact(F.array(*wanted)).alias("rules")).filter(F.size("rules") > 0)


def _spans(text: Column, rule: Rule) -> Column:
    """(start, end) of the rule's matches: lengths of the matches and of what stands between, added up."""
    group, least = rule.least
    hits = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    sized = hits if group == 0 else F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(group))
    each = F.zip_with(
        F.zip_with(F.split(text, rule.pattern), hits, lambda gap, hit: F.struct(gap.alias("gap"), hit.alias("hit"))),
        sized,
        lambda x, part: F.struct(x["gap"].alias("gap"), x["hit"].alias("hit"), F.char_length(part).alias("n")),
    )
    none = F.array().cast("array<struct<start:int,end:int,n:int>>")
    state = F.aggregate(
        F.filter(each, lambda x: x["hit"].isNotNull()),
        F.struct(F.lit(0).alias("at"), none.alias("found")),
        lambda s, x: F.struct(
            (s["at"] + F.char_length(x["gap"]) + F.char_length(x["hit"])).alias("at"),
            F.array_append(
                s["found"],
                F.struct(
                    (s["at"] + F.char_length(x["gap"])).alias("start"),
                    (s["at"] + F.char_length(x["gap"]) + F.char_length(x["hit"])).alias("end"),
                    x["n"].alias("n"),
                ),
            ).cast("array<struct<start:int,end:int,n:int>>").alias("found"),
        ),
    )
    return F.filter(state["found"], lambda x: x["n"] >= least)


def _named(spans: Column, no: int, kind: str) -> Column:
    return F.transform(
        spans,
        lambda x: F.struct(x["start"].alias("start"), F.lit(no).alias("kind_no"), F.lit(kind).alias("kind"), x["end"].alias("end")),
    )


def find_secrets(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """``docs`` with ``secrets``: an array of (start, kind_no, kind, end), in that order."""
    hits = candidates(postings(docs, doc_id, text, rules), rules)
    same = F.col(f"d.`{doc_id}`").eqNullSafe(F.col("c.doc")) & (F.xxhash64(F.col(f"d.`{text}`")) == F.col("c.version"))
    joined = docs.alias("d").join(hits.alias("c"), same, "left")
    own, wanted = F.coalesce(F.col(f"d.`{text}`"), F.lit("")), F.col("c.rules")
    empty = F.array().cast("array<struct<start:int,kind_no:int,kind:string,end:int>>")
    per_rule = []
    for i, rule in enumerate(rules):
        verify = own.rlike(rule.pattern)
        if rule.query():
            verify = F.coalesce(F.array_contains(wanted, i), F.lit(False)) & verify
        per_rule.append(F.when(verify, _named(_spans(own, rule), i, rule.kind)).otherwise(empty))
    return joined.select(*[F.col(f"d.`{c}`") for c in docs.columns], F.sort_array(F.concat(*per_rule)).alias("secrets"))


def _text_of_spans(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def secret_report(docs: DataFrame, **names) -> DataFrame:
    """The counts of the three base kinds, a digest of their spans, and all spans as text."""
    found = find_secrets(docs.select("doc_id", "text"), **names)
    count = lambda kind: F.size(F.filter("secrets", lambda x: x["kind"] == kind)).cast("long")
    base = F.filter("secrets", lambda x: x["kind"].isin(*BASE))
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in BASE],
        F.sha2(_text_of_spans(base), 256).alias("base_sha256"),
        _text_of_spans(F.col("secrets")).alias("spans"),
    )


def mask_secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", mark: str = "<secret>") -> DataFrame:
    """``docs`` with every span, overlapping ones taken together, replaced by ``mark``."""
    found = find_secrets(docs, doc_id, text)
    own = F.col(f"`{text}`")
    state = F.aggregate(
        "secrets",
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda s, x: F.struct(
            F.greatest(s["at"], x["end"]).alias("at"),
            F.when(x["start"] < s["at"], s["out"])
            .otherwise(F.concat(s["out"], own.substr(s["at"] + 1, x["start"] - s["at"]), F.lit(mark)))
            .alias("out"),
        ),
    )
    masked = F.when(F.size("secrets") == 0, own).otherwise(
        F.concat(state["out"], own.substr(state["at"] + 1, F.char_length(own)))
    )
    return found.withColumn("__masked", masked).select(
        *[F.col("__masked").alias(text) if c == text else F.col(f"`{c}`") for c in docs.columns]
    )

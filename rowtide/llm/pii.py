"""Personal data replaced by keyed surrogates.

Found are e-mail and IP addresses, card and phone numbers, and names after a form of
address. Each distinct value becomes one entity, and each entity gets one surrogate, so
that a value keeps its identity in all documents (coreference) and two values never share
one (distinctness). A surrogate is drawn from SHA-256 of key, kind, value and a round:

- digits, small and capital letters are replaced by their like, letters of other scripts
  by letters of that script, or small Latin ones for scripts that aren't listed; signs and
  lengths stay (format);
- a card number that meets the Luhn check still does; an IP address stays a valid one; a
  phone number keeps its country code; an e-mail address keeps its last label, and its
  domain depends on the domain alone, so that colleagues stay colleagues;
- given names after a male or female form of address get endings of that gender, family
  names neutral ones.

Collision check: surrogates met twice, or equal to any value that stands in the corpus,
are drawn anew with the next round for all but the least value, until none is left. After
some rounds addresses and names grow, so that a format without room, or without a character
that could change, ends the rounds too; where a number's format has no room left, it is an error.

Entities, not documents, are shuffled for this; a value that stands in a third of all
documents is one row after map-side combining. Texts are joined once with the surrogates
of their own document.

Defined cases: a null text stays null and an empty one empty; rows repeated with the same
doc_id and text get the same text; other columns pass through, whatever their names; an
empty table gives an empty table. Values are found left to right without overlap, kinds
in the order below where two start at the same place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.llm.common import let, settle

_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
# Forms of address by gender.
_MALE = "Mr|Herr|Señor|Monsieur|Господин"
_FEMALE = "Mrs|Miss|Frau|Señora|Madame|Mme|Госпожа"
_NAME = r"\p{Lu}\p{Ll}{1,30}"

KINDS = {
    "email": r"(?<![\p{L}\p{M}\p{N}._%+-])[\p{L}\p{M}\p{N}._%+-]{1,64}+@[\p{L}\p{M}\p{N}-]{1,63}(?:\.[\p{L}\p{M}\p{N}-]{1,63}){1,8}",
    "ip": rf"(?<![\p{{L}}\p{{N}}.]){_OCTET}(?:\.{_OCTET}){{3}}(?![\p{{L}}\p{{N}}]|\.\d)",
    "card": r"(?<![\p{L}\p{N}])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3})(?![\p{L}\p{N}])",
    "phone": r"(?<![\p{L}\p{N}+])\+?\d{1,3}[ .-]?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{4}(?!\d)|(?<![\p{L}\p{N}+])\+\d[\d .-]{7,14}\d(?!\d)",
    # Looked for backwards only where a capital follows a space.
    "given_m": rf"(?<= )(?=\p{{Lu}})(?<=\b(?:{_MALE})\.? ){_NAME}(?= {_NAME})",
    "given_f": rf"(?<= )(?=\p{{Lu}})(?<=\b(?:{_FEMALE})\.? ){_NAME}(?= {_NAME})",
    "family": rf"(?<= )(?=\p{{Lu}})(?<=\b(?:{_MALE}|{_FEMALE})\.? (?:{_NAME} )?){_NAME}",
}
ANY = "|".join(f"({p})" for p in KINDS.values())
NUMBERS = "|".join(f"(?:{KINDS[k]})" for k in ("email", "ip", "card", "phone"))
FORMS = rf"\b(?:{_MALE}|{_FEMALE})\.? \p{{Lu}}"

_SMALL, _CAPITAL, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
#: (first, last code point, letters to draw from), by script.
_SCRIPTS = (
    (0xC0, 0xDE, "ÀÁÂÄÈÉÊËÌÍÎÏÑÒÓÔÖÙÚÛÜ"),
    (0xDF, 0x24F, "àáâäèéêëìíîïñòóôöùúûü"),
    (0x391, 0x3A9, "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ"),
    (0x3B1, 0x3C9, "αβγδεζηθικλμνξοπρστυφχψω"),
    (0x410, 0x42F, "АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЭЮЯ"),
    (0x430, 0x44F, "абвгдежзиклмнопрстуфхцчшэюя"),
)
#: (first, last code point) of letters without case that stand together; a letter becomes any of its range.
_RANGES = (
    (0x5D0, 0x5EA),  # Hebrew
    (0x621, 0x63A),  # Arabic
    (0x905, 0x939),  # Devanagari
    (0xE01, 0xE2E),  # Thai
    (0x10D0, 0x10F0),  # Georgian
    (0x3041, 0x3096),  # Hiragana
    (0x30A1, 0x30FA),  # Katakana
    (0x4E00, 0x9FA5),  # Han
    (0xAC00, 0xD7A3),  # Hangul
)
#: Rounds after which letters or syllables are added, one for each so many rounds.
_GROW = 3
#: No value needs so many rounds unless its format has no room for as many as there are.
ROUNDS = 100
_SYLLABLES = {
    "latin": ("ba be bi bo da de di do fa fe fi ka ke ki la le li lo ma me mi mo na ne ni ra re ri ro sa se si ta te ti to va ve vi za".split(), ("n", "a", "er")),
    "cyrillic": ("ба бе ва ве га да де ди ка ке ки ла ле ли ма ме ми на не ни ра ре ри са се си та те ти то".split(), ("н", "а", "ин")),
}


def entities_of(text: Column) -> Column:
    """The values of a text in their order, as (kind, value).

    A value tells its kind, but for names: only texts with forms of address are searched
    group by group.
    """
    groups = [F.regexp_extract_all(text, F.lit(ANY), F.lit(i + 1)) for i in range(len(KINDS))]
    zipped = F.arrays_zip(*[g.alias(k) for g, k in zip(groups, KINDS, strict=True)])
    entity = lambda kind, value: F.struct(kind.alias("kind"), value.alias("value"))
    grouped = F.transform(zipped, lambda x: F.coalesce(*[F.when(x[k] != "", entity(F.lit(k), x[k])) for k in KINDS]))

    def kind(v: Column) -> Column:
        return (
            F.when(F.contains(v, F.lit("@")), "email")
            .when(F.contains(v, F.lit("(")) | F.startswith(v, F.lit("+")), "phone")
            .when(F.contains(v, F.lit(".")), "ip")
            .otherwise("card")
        )

    plain = F.transform(F.regexp_extract_all(text, F.lit(NUMBERS), F.lit(0)), lambda v: entity(kind(v), v))
    return F.when(text.rlike(FORMS), grouped).otherwise(plain)


def _bytes(seed: Column, n: Column) -> Column:
    """At least ``n`` numbers of 0..65535 drawn from the seed."""
    blocks = F.transform(F.sequence(F.lit(0), F.floor(n / 16).cast("int")), lambda b: F.sha2(F.concat_ws("|", seed, b), 256))
    return let(
        F.array_join(blocks, ""),
        lambda digits: F.transform(
            F.sequence(F.lit(0), n.cast("int")), lambda i: F.conv(F.substring(digits, i * 4 + 1, F.lit(4)), 16, 10).cast("int")
        ),
    )


def _pick(letters: str, at: Column) -> Column:
    return F.substring(F.lit(letters), at % len(letters) + 1, F.lit(1))


def _like(text: Column, seed: Column) -> Column:
    """The text with each letter and digit replaced by one of its kind."""

    def one(c: Column, r: Column) -> Column:
        code = F.ascii(c)
        case = F.when((code >= 48) & (code <= 57), _pick(_DIGITS, r))
        case = case.when((code >= 97) & (code <= 122), _pick(_SMALL, r)).when((code >= 65) & (code <= 90), _pick(_CAPITAL, r))
        for low, high, letters in _SCRIPTS:
            case = case.when((code >= low) & (code <= high), _pick(letters, r))
        for low, high in _RANGES:
            at = F.lpad(F.hex(low + r % (high - low + 1)), 4, "0")
            case = case.when((code >= low) & (code <= high), F.decode(F.unhex(at), "UTF-16BE"))
        # Letters of any other script, and numbers that are no digits.
        return case.when((code > 127) & c.rlike(r"^[\p{L}\p{N}]"), _pick(_SMALL, r)).otherwise(c)

    chars = F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0))
    return F.array_join(F.zip_with(chars, F.slice(_bytes(seed, F.char_length(text)), F.lit(1), F.char_length(text)), one), "")


def _luhn(digits: Column) -> Column:
    """The Luhn sum, modulo 10, of a text of digits."""
    n = F.char_length(digits)
    each = F.transform(
        F.regexp_extract_all(digits, F.lit("[0-9]"), F.lit(0)),
        lambda c, i: F.when((n - i) % 2 == 1, c.cast("int")).otherwise((c.cast("int") * 2) % 10 + F.floor(c.cast("int") / 5).cast("int")),
    )
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10


def _card(value: Column, seed: Column) -> Column:
    """Same length, first digit and signs; the last digit restores the Luhn check where it held."""
    drawn = F.concat(F.substring(value, 1, 1), _like(F.substring(value, F.lit(2), F.char_length(value)), seed))
    bare, old = F.regexp_replace(drawn, "[^0-9]", ""), F.regexp_replace(value, "[^0-9]", "")
    zero = F.concat(F.substring(bare, F.lit(1), F.char_length(bare) - 1), F.lit("0"))
    last = ((10 - _luhn(zero)) % 10).cast("string")
    mended = F.concat(F.substring(drawn, F.lit(1), F.char_length(drawn) - 1), last)
    return F.when(_luhn(old) == 0, mended).otherwise(drawn)


def _ip(seed: Column) -> Column:
    b = _bytes(seed, F.lit(4))
    return F.concat_ws(".", b[0] % 99 + 128, b[1] % 256, b[2] % 256, b[3] % 256)


def _phone(value: Column, seed: Column) -> Column:
    head = F.regexp_extract(value, r"^(\+?\d{1,3}(?=[ .(-])|\+\d)?", 0)
    return F.concat(head, _like(F.substring(value, F.char_length(head) + 1, F.char_length(value)), seed))


def _grown(round_no: Column) -> Column:
    return F.floor(round_no / _GROW).cast("int")


def _email(value: Column, seed: Column, round_no: Column, key: str) -> Column:
    local, domain = F.substring_index(value, "@", 1), F.substring_index(value, "@", -1)
    last = F.substring_index(domain, ".", -1)
    host = F.substring(domain, F.lit(1), F.char_length(domain) - F.char_length(last))
    more = F.repeat(F.lit("a"), _grown(round_no))  # where short ones have run out, or nothing in it can change
    return F.concat(_like(F.concat(local, more), seed), F.lit("@"), _like(host, F.concat_ws("|", F.lit(key), F.lit("domain"), F.lower(domain))), last)


def _name(value: Column, kind: Column, seed: Column, round_no: Column) -> Column:
    def of(script: str) -> Column:
        syllables, (male, female, neutral) = _SYLLABLES[script]
        pool = F.array(*[F.lit(s) for s in syllables])
        n = 4 + _grown(round_no)
        body = F.array_join(F.transform(F.slice(_bytes(seed, n), F.lit(1), n), lambda r: F.get(pool, r % len(syllables))), "")
        end = F.when(kind == "given_m", male).when(kind == "given_f", female).otherwise(neutral)
        return F.initcap(F.concat(body, end))

    return F.when(value.rlike(r"^\p{IsCyrillic}"), of("cyrillic")).otherwise(of("latin"))


def draw(kind: Column, value: Column, round_no: Column, key: str) -> Column:
    """The surrogate of an entity in a round."""
    seed = F.concat_ws("|", F.lit(key), kind, F.lower(value), round_no)
    return (
        F.when(kind == "email", _email(value, seed, round_no, key))
        .when(kind == "ip", _ip(seed))
        .when(kind == "card", _card(value, seed))
        .when(kind == "phone", _phone(value, seed))
        .otherwise(_name(value, kind, seed, round_no))
    )


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """(kind, value, surrogate): distinct values keep distinct surrogates, none of which is itself a value."""
    drawn = entities.select("kind", "value", F.lit(0).alias("round"))
    for _ in range(ROUNDS):
        drawn = settle(drawn.select("kind", "value", "round", draw(F.col("kind"), F.col("value"), F.col("round"), key).alias("surrogate")))
        firsts = drawn.groupBy("surrogate").agg(F.min(F.struct("kind", "value")).alias("holder"), F.count("*").alias("n"))
        taken = drawn.select(F.col("value").alias("surrogate")).distinct().withColumn("is_value", F.lit(True))
        clash = firsts.join(taken, "surrogate", "left").filter((F.col("n") > 1) | F.col("is_value"))
        again = settle(
            drawn.join(clash, "surrogate").filter(F.col("is_value") | (F.struct("kind", "value") != F.col("holder"))).select("kind", "value")
        )
        if again.isEmpty():
            return drawn.select("kind", "value", "surrogate")
        redo = F.col("redo").isNotNull()
        drawn = drawn.join(again.withColumn("redo", F.lit(1)), ["kind", "value"], "left").select(
            "kind", "value", F.when(redo, F.col("round") + 1).otherwise(F.col("round")).alias("round")
        )
    kinds = ", ".join(sorted(r.kind for r in again.select("kind").distinct().collect()))
    raise RuntimeError(f"no distinct surrogates are left for values of these kinds: {kinds}")


def replace_personal(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", key: str = "rowtide", count: str | None = None
) -> DataFrame:
    """``docs`` with surrogates in the text; ``count`` names a column for the number of values replaced."""
    found = docs.select(F.col(doc_id).alias("doc"), F.col(text).alias("__t")).filter(F.col("__t").rlike("[@0-9]") | F.col("__t").rlike(FORMS))
    found = settle(
        found.select("doc", F.xxhash64("__t").alias("version"), F.explode(F.array_distinct(entities_of(F.col("__t")))).alias("e"))
        .select("doc", "version", "e.*")
        .distinct()
    )
    named = surrogates(found.select("kind", "value").distinct(), key)
    own = (
        found.join(named, ["kind", "value"])
        .groupBy("doc", "version")
        .agg(F.map_from_entries(F.collect_list(F.struct(F.concat_ws(":", "kind", "value"), "surrogate"))).alias("names"))
    )
    t = F.col(f"d.`{text}`")
    same = F.col(f"d.`{doc_id}`").eqNullSafe(F.col("o.doc")) & (F.xxhash64(t) == F.col("o.version"))
    joined = docs.alias("d").join(own.alias("o"), same, "left").select("d.*", F.col("o.names").alias("__names"))
    hits = F.when(F.col("__names").isNotNull(), entities_of(F.col(f"`{text}`")))
    joined = joined.withColumn("__hits", hits)
    put = F.zip_with(
        F.when(F.col(f"`{text}`").rlike(FORMS), F.split(F.col(f"`{text}`"), ANY)).otherwise(F.split(F.col(f"`{text}`"), NUMBERS)),
        "__hits",
        lambda gap, e: F.concat(gap, F.coalesce(F.try_element_at("__names", F.concat_ws(":", e["kind"], e["value"])), e["value"], F.lit(""))),
    )
    done = F.when(F.col("__names").isNotNull(), F.array_join(put, "")).otherwise(F.col(f"`{text}`"))
    columns = [done.alias(text) if c == text else F.col(f"`{c}`") for c in docs.columns]
    if count:
        columns.append(F.coalesce(F.size("__hits"), F.lit(0)).cast("long").alias(count))
    return joined.select(*columns)

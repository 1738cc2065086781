"""Surrogate generation: personal data replaced by keyed stand-ins of the same type, in the same format.

Found are e-mail addresses, secrets (``password=``, ``token = "..."``, access key ids), IP addresses, payment cards, other long
account numbers, phone numbers, social security numbers, and names that follow a title. An entity is its mention
without what only formats it: the digits of a phone number, an address in lower case, a name without its title. A name under a neutral
title is the person of the one gender that its other titles tell; if they tell both, the man, the woman and the neutral one are three. All mentions of an entity, in any
document and format, get one surrogate (coreference); two entities never share one (distinctness); no surrogate is a real entity of the
table. A surrogate is drawn from SHA-256 over the key, the kind, the entity and an attempt number. All proposals are checked against each other
and against the real entities; those that collide are drawn again until none does.

Type and format: digits stand where digits stood; cards keep their first digit and a valid check digit; mail addresses keep the
length, marks, digits' places and script of the local part, and script and top level of the domain, whose second level is the script's word for
an example, and are in small letters however they are written; secrets keep the class of each character, and marks as they are if at least six letters
or digits change; names keep title, script (Latin, Cyrillic, Greek), number of parts, and an ending that fits the title's gender. Names and secrets
that collide grow with each attempt, as do domains of addresses, so their formats never run out of surrogates.

Only DataFrame functions are used. Documents without mentions pass through untouched; the others are numbered and written once, their mentions
are joined with the surrogates, and each text is put together again from the parts between mentions. A document is one group of
its own mentions, and one text is put together in one row.

Null and empty texts pass through. Long texts are searched whole. Repeated rows are replaced alike. An empty table gives an empty table. The columns
are those of the input, in order; helper columns that the input has too are no harm, since only the text and a struct of the row are used.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakesync.llm.common import stored

# Titles by the gender that they tell; the patterns of the formats.
MALE = "Mr|Herr|Monsieur|Señor|Sr|Don|Г-н|Господин|Κύριος"
FEMALE = "Mrs|Ms|Miss|Frau|Madame|Mme|Señora|Sra|Doña|Г-жа|Госпожа|Κυρία"
NEUTRAL = "Mx|Dr|Prof"

EMAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)++"
SECRET_LABEL = r"""\b(?:[Pp]assword|[Pp]asswd|[Ss]ecret|[Tt]oken|[Aa]pi[_-]?[Kk]ey)[ \t]{0,3}[=:][ \t]{0,3}["']?"""
SECRET = SECRET_LABEL + r"""[^\s"']{6,}+"""
ACCESS_KEY = r"\b(?:AKIA|ASIA)[0-9A-Z]{16}\b"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
IP = rf"(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\d|\.\d)"
CARD = (
    r"(?<!\d)(?:\d{13,19}|\d{4} \d{4} \d{4} \d{4}|\d{4}-\d{4}-\d{4}-\d{4}|\d{4} \d{6} \d{5}|\d{4}-\d{6}-\d{5})(?!\d)"
)
PHONE = (
    r"(?<![\p{L}\d+])\+\d{1,3}[ .-]?\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}(?!\d)"
    r"|(?<![\p{L}\d+])\+\d{1,3}(?:[ .-]?\d{2,4}){3,5}(?!\d)"
    r"|(?<!\d)\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)|(?<![\d.-])\d{3}[.-]\d{3}[.-]\d{4}(?!\d)"
)
SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
NAME = rf"(?<!\p{{L}})(?:{MALE}|{FEMALE}|{NEUTRAL})\b\.?[ \t]\p{{Lu}}[\p{{L}}'’-]++(?:[ \t]\p{{Lu}}[\p{{L}}'’-]++){{0,2}}"

# A look at the first character spares most places the rest of the alternatives.
_NUMBERS = "|".join((IP, CARD, PHONE, SSN))
_FIRST = "".join(sorted({t[0] for t in f"{MALE}|{FEMALE}|{NEUTRAL}".split("|")}))
ANY = rf"{EMAIL}|(?=[0-9+(])(?:{_NUMBERS})|(?=[PpSsTtAa])(?:{SECRET}|{ACCESS_KEY})|(?=[{_FIRST}])(?:{NAME})"
# Every mention holds a digit, an at sign or one of these; plain searches cost a tenth of the patterns.
CLUES = ("assw", "ecret", "oken", "key", "Key", *f"{MALE}|{FEMALE}|{NEUTRAL}".split("|"))

_SYLLABLES = {
    "latin": "ba be bi do du fa fe ga go ha jo ka ki la le li lo ma me mi mo na ne ni no pa ra re ri ro sa ta".split(),
    "cyrillic": "ба бе бо ва ве да до ка ко ла ле ли ло ма ме ми мо на не ни но па ра ре ри ро са се со та те то".split(),
    "greek": "βα βε γα δα δη δο κα κο λα λε λι λο μα με μη μι να νε νι νο πα πε ρα ρε ρι ρο σα σε σι σο τα τε".split(),
}
# Endings of the name's first part (of its only part where the script's family names tell gender).
_ENDINGS = {
    ("latin", "male"): "n", ("latin", "female"): "nna", ("latin", "any"): "s",
    ("cyrillic", "male"): "ков", ("cyrillic", "female"): "кова", ("cyrillic", "any"): "ко",
    ("greek", "male"): "νος", ("greek", "female"): "νη", ("greek", "any"): "ς",
}
_ATTEMPTS = 200
_SYMBOLS = "!#$%&*+-=?@^_~"
_DIGITS = ("card", "account", "phone", "ssn")


def _digits(mention: Column) -> Column:
    return F.regexp_replace(mention, r"\D", "")


def luhn_sum(digits: Column) -> Column:
    """The check sum of a string of digits whose last digit is the check digit."""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substr(digits, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(F.pmod(n - i, F.lit(2)) == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add)


def kind_of(mention: Column) -> Column:
    """The kind of a mention; a long number without a card's check sum is an account."""
    whole = lambda p: mention.rlike(rf"\A(?:{p})\z")
    card = F.when(F.pmod(luhn_sum(_digits(mention)), F.lit(10)) == 0, "card").otherwise("account")
    return (
        F.when(whole(EMAIL), "email")
        .when(whole(SECRET) | whole(ACCESS_KEY), "secret")
        .when(whole(IP), "ip")
        .when(whole(CARD), card)
        .when(whole(SSN), "ssn")
        .when(whole(PHONE), "phone")
        .when(whole(NAME), "name")
    )


def _gender(mention: Column) -> Column:
    return F.when(mention.rlike(rf"\A(?:{FEMALE})\b"), "female").when(mention.rlike(rf"\A(?:{MALE})\b"), "male").otherwise("any")


def _label(mention: Column) -> Column:
    """What stands before a secret's value, or a name's title: it is kept."""
    title = rf"\A((?:{MALE}|{FEMALE}|{NEUTRAL})\b\.?[ \t])"
    return F.when(mention.rlike(r"\A" + SECRET_LABEL), F.regexp_extract(mention, rf"\A({SECRET_LABEL})", 1)).otherwise(
        F.regexp_extract(mention, title, 1)
    )


def _value(mention: Column) -> Column:
    return F.substr(mention, F.length(_label(mention)) + 1)


def entity_of(mention: Column, kind: Column) -> Column:
    """What all mentions of an entity have in common."""
    name = F.concat_ws(":", _gender(mention), F.lower(F.regexp_replace(_value(mention), r"[ \t]+", " ")))
    return (
        F.when(kind.isin(*_DIGITS), _digits(mention))
        .when(kind == "email", F.lower(mention))
        .when(kind == "secret", _value(mention))
        .when(kind == "name", name)
        .otherwise(mention)
    )


def _stream(key: str, kind: Column, entity: Column, attempt: Column, size: Column) -> Column:
    """At least ``size`` bytes, in hex, that the key, the entity and the attempt decide."""
    part = lambda i: F.sha2(F.concat_ws("\x1f", F.lit(key), kind, entity, attempt, i.cast("string")), 256)
    return F.array_join(F.transform(F.sequence(F.lit(0), F.ceil(size / 32).cast("int")), part), "")


def _byte(stream: Column, i: Column) -> Column:
    return F.conv(F.substr(stream, 2 * i + 1, F.lit(2)), 16, 10).cast("int")


def _join(indices: Column, piece) -> Column:
    return F.array_join(F.transform(indices, piece), "")


def _upto(n: Column) -> Column:
    """0 .. n - 1, none for n = 0."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def _pick(stream: Column, i: Column, choices: str) -> Column:
    return F.substr(F.lit(choices), F.pmod(_byte(stream, i), F.lit(len(choices))) + 1, F.lit(1))


def _new_digits(stream: Column, n: Column) -> Column:
    return _join(_upto(n), lambda i: _pick(stream, i, "0123456789"))


def _new_card(entity: Column, stream: Column) -> Column:
    body = F.concat(F.substr(entity, F.lit(1), F.lit(1)), _new_digits(stream, F.length(entity) - 2))
    check = F.pmod(10 - F.pmod(luhn_sum(F.concat(body, F.lit("0"))), F.lit(10)), F.lit(10))
    return F.concat(body, check.cast("string"))


def _letter(stream: Column, i: Column, like: Column) -> Column:
    """A small letter of the script of ``like``."""
    cyrillic, greek = "абвгдежзиклмнопрстуфхцчшэюя", "αβγδεζηθικλμνξοπρστυφχψω"
    return (
        F.when(like.rlike(r"\p{IsCyrillic}"), _pick(stream, i, cyrillic))
        .when(like.rlike(r"\p{IsGreek}"), _pick(stream, i, greek))
        .otherwise(_pick(stream, i, "abcdefghijklmnopqrstuvwxyz"))
    )


def _new_email(entity: Column, stream: Column, attempt: int) -> Column:
    local, domain, top = F.substring_index(entity, "@", 1), F.substring_index(entity, "@", -1), F.substring_index(entity, ".", -1)

    def char(i: Column) -> Column:
        c = F.substr(local, i + 1, F.lit(1))
        digit = F.when(c.rlike(r"\p{N}"), _pick(stream, i, "0123456789"))
        return digit.when(c.rlike(r"\p{L}"), _letter(stream, i, c)).otherwise(c)

    label = F.concat(*[_letter(stream, F.length(local) + i, domain) for i in range(8 + attempt)])
    word = F.when(domain.rlike(r"\p{IsCyrillic}"), "пример").when(domain.rlike(r"\p{IsGreek}"), "παράδειγμα").otherwise("example")
    return F.concat(_join(_upto(F.length(local)), char), F.lit("@"), label, F.lit("."), word, F.lit("."), top)


def _new_ip(stream: Column) -> Column:
    octet = lambda i, least, span: (F.pmod(_byte(stream, F.lit(i)), F.lit(span)) + least).cast("string")
    return F.concat_ws(".", octet(0, 1, 223), octet(1, 0, 256), octet(2, 0, 256), octet(3, 1, 254))


def _new_secret(entity: Column, stream: Column, attempt: int) -> Column:
    hexed = entity.rlike(r"\A[0-9a-f]+\z")
    few = F.length(F.regexp_replace(entity, r"[^\p{L}0-9]", "")) < 6
    keep = F.length(F.regexp_extract(entity, r"\A(?:AKIA|ASIA)(?=[0-9A-Z]{16}\z)", 0))

    def char(i: Column) -> Column:
        c = F.substr(entity, i + 1, F.lit(1))
        return (
            F.when(i < keep, c)
            .when(hexed, _pick(stream, i, "0123456789abcdef"))
            .when(c.rlike("[0-9]"), _pick(stream, i, "0123456789"))
            .when(c.rlike(r"\p{Lu}"), _pick(stream, i, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
            .when(c.rlike(r"\p{L}"), _pick(stream, i, "abcdefghijklmnopqrstuvwxyz"))
            .when(few, _pick(stream, i, _SYMBOLS))
            .otherwise(c)
        )

    more = [_pick(stream, F.length(entity) + i, "0123456789abcdef") for i in range(attempt)]
    return F.concat(_join(_upto(F.length(entity)), char), *more)


def _new_name(entity: Column, stream: Column, attempt: int) -> Column:
    gender, name = F.substring_index(entity, ":", 1), F.regexp_replace(entity, r"\A[^:]*:", "")
    parts = F.split(name, " ")

    def part(script: str):
        syllables = F.array(*[F.lit(s) for s in _SYLLABLES[script]])
        syllable = lambda i: F.element_at(syllables, F.pmod(_byte(stream, i), F.lit(32)) + 1)
        ending = F.when(gender == "male", _ENDINGS[script, "male"]).when(gender == "female", _ENDINGS[script, "female"])
        ending = ending.otherwise(_ENDINGS[script, "any"])
        more = F.concat(*[syllable(F.lit(16 + i)) for i in range(attempt)], ending)
        return lambda j: F.concat(
            syllable(4 * j), syllable(4 * j + 1), syllable(4 * j + 2), F.when(j == 0, more).otherwise("")
        )

    chosen = (
        F.when(name.rlike(r"\p{IsCyrillic}"), F.transform(_upto(F.size(parts)), part("cyrillic")))
        .when(name.rlike(r"\p{IsGreek}"), F.transform(_upto(F.size(parts)), part("greek")))
        .otherwise(F.transform(_upto(F.size(parts)), part("latin")))
    )
    return F.concat(gender, F.lit(":"), F.array_join(chosen, " "))


def propose(kind: Column, entity: Column, stream: Column, attempt: int = 0) -> Column:
    """The surrogate of an entity, from its ``stream``, before collisions are known."""
    return (
        F.when(kind == "email", _new_email(entity, stream, attempt))
        .when(kind == "card", _new_card(entity, stream))
        .when(kind == "ip", _new_ip(stream))
        .when(kind == "secret", _new_secret(entity, stream, attempt))
        .when(kind == "name", _new_name(entity, stream, attempt))
        .when(kind == "phone", _new_phone(entity, stream))
        .otherwise(_new_digits(stream, F.length(entity)))
    )


def _new_phone(entity: Column, stream: Column) -> Column:
    """Digits before the last ten, the country code, are kept; of a number of ten or fewer, none."""
    code = F.greatest(F.length(entity) - 10, F.lit(0))
    return F.concat(F.substr(entity, F.lit(1), code), _new_digits(stream, F.length(entity) - code))


def render(mention: Column, kind: Column, surrogate: Column) -> Column:
    """The surrogate in the format of the mention."""

    def place(state: Column, c: Column) -> Column:
        is_digit = c.rlike("[0-9]")
        put = F.concat(state["out"], F.when(is_digit, F.substr(surrogate, state["at"], F.lit(1))).otherwise(c))
        return F.struct(put.alias("out"), (state["at"] + is_digit.cast("int")).alias("at"))

    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))
    laid = F.aggregate(F.split(mention, ""), start, place, lambda s: s["out"])
    name = F.initcap(F.regexp_replace(surrogate, r"\A[^:]*:", ""))
    name = F.when(_value(mention).rlike(r"\A[^\p{Ll}]{2,}\z"), F.upper(name)).otherwise(name)
    return (
        F.when(kind.isin(*_DIGITS), laid)
        .when(kind == "secret", F.concat(_label(mention), surrogate))
        .when(kind == "name", F.concat(_label(mention), name))
        .otherwise(surrogate)
    )


def assign(entities: DataFrame, key: str) -> DataFrame:
    """(kind, entity, surrogate): one for each row of ``entities`` (distinct kind and entity), no two of a kind alike.

    Each round settles every entity whose proposal nobody of its kind has, proposes first or bears; the rest
    tries again. The first of those that propose alike is the one whose entity sorts first.
    """
    left, settled = entities.select("kind", "entity"), None
    for attempt in range(_ATTEMPTS):
        kind, entity, size = F.col("kind"), F.col("entity"), F.greatest(F.length("entity") + 8, F.lit(64)) + attempt
        streams = left.withColumn("stream", _stream(key, kind, entity, F.lit(str(attempt)), size))
        tried = streams.select("kind", "entity", propose(kind, entity, F.col("stream"), attempt).alias("surrogate"))
        taken = entities.select("kind", F.col("entity").alias("surrogate"))
        if settled is not None:
            taken = taken.unionByName(settled.select("kind", "surrogate"))
        free = stored(tried.join(taken, ["kind", "surrogate"], "left_anti"), "proposed")
        won = free.groupBy("kind", "surrogate").agg(F.min("entity").alias("entity"))
        won = stored(won.select("kind", "entity", "surrogate"), "surrogates")
        settled = won if settled is None else settled.unionByName(won)
        left = stored(left.join(won, ["kind", "entity"], "left_anti"), "collided")
        if left.isEmpty():
            return settled
    raise ValueError("no free surrogates are left for some format")


def one_person(found: DataFrame) -> DataFrame:
    """(kind, found, entity) of distinct ``found`` (kind, entity): names of a neutral title under the one gender that others tell."""
    name = F.when(F.col("kind") == "name", F.regexp_replace("entity", r"\A[^:]*:", ""))
    told = found.withColumn("name", name).withColumn("gender", F.substring_index("entity", ":", 1))
    tells = lambda g: F.max((F.col("gender") == g).cast("int")).alias(g)
    genders = told.filter("name IS NOT NULL").groupBy("name").agg(tells("male"), tells("female"))
    both = told.join(genders, "name", "left")
    only = F.when(F.col("male") > F.col("female"), "male").when(F.col("female") > F.col("male"), "female")
    entity = F.when((F.col("gender") == "any") & only.isNotNull() & F.col("name").isNotNull(), F.concat(only, F.lit(":"), "name"))
    return both.select("kind", F.col("entity").alias("found"), F.coalesce(entity, "entity").alias("entity"))


def replace_pii(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``docs`` with every mention in ``text`` replaced, the other columns as they are."""
    body = F.col(text)
    mentions = F.regexp_extract_all(body, F.lit(f"({ANY})"), F.lit(1))
    clue = reduce(lambda a, b: a | b, [body.contains(c) for c in CLUES], body.rlike("[0-9@]"))
    bears = F.coalesce(clue & body.rlike(ANY), F.lit(False))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    bearing = stored(
        docs.filter(bears).select(F.monotonically_increasing_id().alias("rid"), row, body.alias("body"), mentions.alias("m")),
        "bearing",
    )
    each = bearing.select("rid", F.posexplode("m").alias("pos", "mention"))
    each = each.withColumn("kind", kind_of(F.col("mention")))
    each = stored(each.withColumn("entity", entity_of(F.col("mention"), F.col("kind"))), "mentions")
    people = stored(one_person(stored(each.select("kind", "entity").distinct(), "found")), "people")
    surrogates = assign(stored(people.select("kind", "entity").distinct(), "entities"), key)
    settled = stored(people.join(surrogates, ["kind", "entity"]).select("kind", F.col("found").alias("entity"), "surrogate"), "settled")
    shown = each.join(settled, ["kind", "entity"]).select(
        "rid", "pos", render(F.col("mention"), F.col("kind"), F.col("surrogate")).alias("shown")
    )
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("pos", "shown"))), lambda s: s["shown"])
    by_row = stored(shown.groupBy("rid").agg(ordered.alias("shown")), "shown")
    gaps = F.split("body", ANY, -1)
    whole = F.array_join(
        F.flatten(F.zip_with(gaps, "shown", lambda g, s: F.array(g, F.coalesce(s, F.lit(""))))), ""
    )
    done = bearing.join(by_row, "rid").select("row", whole.alias("body"))
    columns = [F.col("body").alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    return docs.filter(~bears).unionByName(done.select(*columns))

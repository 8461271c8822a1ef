"""PII surrogates: detected entities get keyed, type-consistent replacements (native).

One pattern finds e-mail addresses, IPv4 addresses, card, bank, social security and phone numbers,
credentials, and names after a title.  Every entity has a canonical form (digits of a number, lower-cased
address ...), so all spellings of one entity meet.  Its surrogate is drawn from SHA-256 over a key, the type
and the canonical form, character class by character class: digits stay digits, letters keep script and
case, a card number keeps its first digit and whether its check digit is right, an address its private range
or top-level domain, a given name the gender of its title.  A mention is rendered in its own format.

Distinctness is checked over the whole corpus: two entities of a type with one surrogate, or a surrogate
that is itself an entity, make all but the first draw again, until there is no clash.  Names, credentials and
addresses get longer with each attempt, so their space cannot run out.  Phone, social security and private IP
numbers keep their length: where entities fill more than a quarter of the numbers with one head, they are not
drawn but given free numbers by rank, and where they fill more than half, so that not every one can have a
number that is no entity, a keyed permutation without fixed points gives each another number of that space.
What is shuffled is entities, pre-aggregated to distinct ones, never texts without entities.

Defined cases: a null text stays null and has no entities; a text without entities is unchanged; rows that
repeat get the same surrogates; null ids are kept; an empty table gives no rows; extra columns are kept by
:func:`with_surrogates`, except that ``n_entities`` is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import let, staged, table

KEY = "surrogates-1"
NO_ID = -(1 << 63)

# Titles by gender, and the patterns of the types, tried in this order.
MALE = r"Mr|Herr|Monsieur|Señor|Sr|г-н"
FEMALE = r"Mrs|Ms|Miss|Frau|Mme|Madame|Mlle|Señora|Señorita|Sra|Srta|г-жа"
NEUTRAL = r"Dr|Prof"
_WORD = r"\p{Lu}[\p{L}'’-]{1,30}"
_NAME = r"(?=\p{Lu})(?<= )"  # cheap tests before a look behind of many lengths
_BYTE = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
SECRET_NAME = r"(?:[Pp]assw(?:or)?d|PASSWORD|[Tt]oken|TOKEN|[Ss]ecret|SECRET|[Aa]pi[_-]?[Kk]ey|API_KEY)[ \t]{0,2}[=:][ \t]{0,2}[\"']?"
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]{1,64}+@[\p{L}\p{N}-]{1,63}(?:\.[\p{L}\p{N}-]{1,63})+",
    "secret": SECRET_NAME + r"[^\s\"']{6,}"
    r"|(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}|(?:ghp|gho|sk|pk|xox[abp])[_-][A-Za-z0-9_-]{16,})",
    "ip": rf"(?<![0-9.])(?:{_BYTE}\.){{3}}{_BYTE}(?![0-9]|\.[0-9])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "card": r"(?<![0-9])(?:[0-9]{4}(?:[ -]?[0-9]{4}){3}|3[47][0-9]{2}[ -]?[0-9]{6}[ -]?[0-9]{5})(?![0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "phone": r"(?<![0-9.])(?:\+[0-9]{1,3}(?:[ .-]?\([0-9]{1,4}\))?(?:[ .-]?[0-9]{2,4}){2,5}"
    r"|\([0-9]{2,4}\)[ .-]?[0-9]{3,4}[ .-][0-9]{3,4}|[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4})(?![0-9])",
    "given_m": rf"{_NAME}(?<=(?<!\p{{L}})(?:{MALE})\.? ){_WORD}(?= \p{{Lu}}\p{{L}})",
    "given_f": rf"{_NAME}(?<=(?<!\p{{L}})(?:{FEMALE})\.? ){_WORD}(?= \p{{Lu}}\p{{L}})",
    "given_n": rf"{_NAME}(?<=(?<!\p{{L}})(?:{NEUTRAL})\.? ){_WORD}(?= \p{{Lu}}\p{{L}})",
    "family": rf"{_NAME}(?<=(?<!\p{{L}})(?:{MALE}|{FEMALE}|{NEUTRAL})\.? (?:{_WORD} )?){_WORD}",
}
PATTERN = "|".join(f"({p})" for p in PATTERNS.values())
TYPES = list(PATTERNS)
NUMBERS = ("card", "ssn", "phone")

# Parts of invented names by script; endings by gender.
SYLLABLES = {
    "latin": "ba be bo da de do fa fe ga ge ka ke ko la le li lo ma me mi mo na ne ni no ra re ri ro sa se ta".split(),
    "cyrillic": "ба бе бо да де до га ге ка ке ко ла ле ли ло ма ме ми мо на не ни но ра ре ри ро са се та те ва".split(),
    "greek": "βα βε βο δα δε δο γα γε κα κε κο λα λε λι λο μα με μι μο να νε νι νο ρα ρε ρι ρο σα σε τα τε πα".split(),
}
ENDINGS = {
    "latin": {"m": "n", "f": "na", "n": "lin", "family": "rd"},
    "cyrillic": {"m": "н", "f": "на", "n": "лин", "family": "рд"},
    "greek": {"m": "ν", "f": "να", "n": "λιν", "family": "ρδ"},
}
LETTERS = {
    "[a-z]": "abcdefghijklmnopqrstuvwxyz",
    "[A-Z]": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    r"[\p{IsCyrillic}&&\p{Ll}]": "абвгдежзиклмнопрстуфхцчшэюя",
    r"[\p{IsCyrillic}&&\p{Lu}]": "АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЭЮЯ",
    r"[\p{IsGreek}&&\p{Ll}]": "αβγδεζηθικλμνξοπρστυφχψω",
    r"[\p{IsGreek}&&\p{Lu}]": "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ",
    r"\p{Ll}": "abcdefghijklmnopqrstuvwxyz",
    r"\p{L}": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
}
SIGNS = "!#$%&*+-.:=?@^_~"
ADDED = "abcdefghijklmnopqrstuvwxyz0123456789"
PRIVATE = r"^(10|127)\.|^192\.168\.|^172\.(1[6-9]|2[0-9]|3[01])\.|^169\.254\."
PHONE_HEAD = r"^(\+?[0-9])"


def has_entities(text: Column) -> Column:
    """Whether the pattern is found.  Every match needs a digit or one of @=:_-, AKIA, or a title: asked first."""
    title = rf"(?<!\p{{L}})(?:{MALE}|{FEMALE}|{NEUTRAL})\.? \p{{Lu}}"
    needs = text.rlike("[0-9@=:_-]|AKIA") | text.rlike(title)
    return F.coalesce(needs & text.rlike(PATTERN), F.lit(False))


def mentions(text: Column) -> Column:
    """Array of (mention, type) in order of the text."""
    found = F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))
    groups = [F.regexp_extract_all(text, F.lit(PATTERN), F.lit(k + 1)) for k in range(len(TYPES))]

    def typed(arrays: Column) -> Column:
        def one(mention: Column, i: Column) -> Column:
            kind = F.coalesce(*[F.when(F.get(arrays[f"g{k}"], i) != "", F.lit(name)) for k, name in enumerate(TYPES)])
            return F.struct(mention.alias("mention"), kind.alias("type"))

        return F.transform(arrays["all"], one)

    return let(F.struct(found.alias("all"), *[g.alias(f"g{k}") for k, g in enumerate(groups)]), typed)


def canonical(kind: Column, mention: Column) -> Column:
    return (
        F.when(kind == "phone", F.regexp_replace(mention, "[^0-9+]", ""))
        .when(kind.isin(*NUMBERS), F.regexp_replace(mention, "[^0-9]", ""))
        .when(kind == "iban", F.regexp_replace(mention, " ", ""))
        .when(kind == "secret", F.regexp_replace(mention, "^" + SECRET_NAME, ""))
        .when(kind.isin("email", "given_m", "given_f", "given_n", "family"), F.lower(mention))
        .otherwise(mention)
    )


def _stream(seed: Column, length: Column) -> Column:
    """Hex digits, two for each of ``length`` characters, from SHA-256 over the seed and a counter."""
    blocks = F.sequence(F.lit(0), F.floor(length / 32).cast("int"))
    return F.array_join(F.transform(blocks, lambda k: F.sha2(F.concat_ws("|", seed, k.cast("string")).cast("binary"), 256)), "")


def _number(stream: Column, i: Column) -> Column:
    return F.conv(F.substr(stream, 2 * i + 1, F.lit(2)), 16, 10).cast("int")


def _character(c: Column, n: Column) -> Column:
    """Another character of the same class."""
    out = F.when(c.rlike("^[0-9]$"), (n % 10).cast("string"))
    for pattern, letters in LETTERS.items():
        out = out.when(c.rlike(f"^{pattern}$"), F.substr(F.lit(letters), n % len(letters) + 1, F.lit(1)))
    return out.otherwise(c)


def _like(value: Column, stream: Column) -> Column:
    """A value with each character replaced by one of its class."""
    return let(
        stream,
        lambda s: F.array_join(F.transform(F.split(value, ""), lambda c, i: _character(c, _number(s, i))), ""),
    )


def _one_of(letters: str, n: Column) -> Column:
    return F.substr(F.lit(letters), n % len(letters) + 1, F.lit(1))


def _signs(value: Column, stream: Column) -> Column:
    """As many signs: for a credential without letters and digits, of which :func:`_like` changes nothing."""
    return let(stream, lambda s: F.array_join(F.transform(F.split(value, ""), lambda c, i: _one_of(SIGNS, _number(s, i))), ""))


def _added(value: Column, attempt: Column, stream: Column) -> Column:
    """A further character for each attempt after the first."""
    places = F.slice(F.sequence(F.lit(0), attempt), F.lit(2), attempt)
    return let(
        stream,
        lambda s: F.array_join(F.transform(places, lambda k: _one_of(ADDED, _number(s, F.length(value) + k - 1))), ""),
    )


def _luhn(digits: Column) -> Column:
    """Sum of the check-digit rule modulo 10, the last digit not doubled."""
    def weight(c: Column, i: Column) -> Column:
        d = c.cast("int")
        doubled = (F.length(digits) - i) % 2 == 0
        return F.when(doubled, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d)

    return F.aggregate(F.transform(F.split(digits, ""), weight), F.lit(0), lambda a, x: a + x) % 10


def _card(value: Column, stream: Column) -> Column:
    drawn = F.concat(F.left(value, F.lit(1)), F.substr(_like(value, stream), F.lit(2)))
    body = F.substr(drawn, F.lit(1), F.length(value) - 1)

    def ended(known: Column) -> Column:
        right = (10 - _luhn(F.concat(known, F.lit("0")))) % 10
        valid = _luhn(value) == 0
        last = F.when(valid, right).otherwise((right + 1 + _number(stream, F.lit(31)) % 9) % 10)
        return F.concat(known, last.cast("string"))

    return let(body, ended)


def _ip(value: Column, stream: Column) -> Column:
    parts = F.split(value, r"\.")
    private = value.rlike(PRIVATE)
    first = F.when(private, F.get(parts, F.lit(0))).otherwise((11 + _number(stream, F.lit(0)) % 110).cast("string"))
    second = F.when(private, F.get(parts, F.lit(1))).otherwise((_number(stream, F.lit(1)) % 254 + 1).cast("string"))
    return F.concat_ws(".", first, second, *[(_number(stream, F.lit(k)) % 254 + 1).cast("string") for k in (2, 3)])


def _email(value: Column, key: str, attempt: Column, stream: Column) -> Column:
    """The domain is drawn from the domain alone, so that addresses of one host stay together."""
    domain = F.substring_index(value, "@", -1)
    top = F.substring_index(domain, ".", -1)
    host = F.substr(domain, F.lit(1), F.length(domain) - F.length(top) - 1)
    hidden = _like(host, _stream(F.concat_ws("|", F.lit(key), F.lit("host"), domain), F.length(host)))
    local = F.concat(_like(F.substring_index(value, "@", 1), stream), _added(value, attempt, stream))
    return F.concat(local, F.lit("@"), hidden, F.lit("."), top)


def _name(kind: Column, value: Column, attempt: Column, stream: Column) -> Column:
    """An invented name of the same script and gender; a new attempt has one syllable more."""
    def of(script: str) -> Column:
        parts = F.array(*[F.lit(s) for s in SYLLABLES[script]])
        many = F.least(F.when(kind == "family", 3).otherwise(2) + attempt, F.lit(14))
        body = F.array_join(F.transform(F.sequence(F.lit(0), many - 1), lambda i: F.get(parts, _number(stream, i) % len(SYLLABLES[script]))), "")
        ends = ENDINGS[script]
        end = F.when(kind == "given_m", ends["m"]).when(kind == "given_f", ends["f"]).when(kind == "family", ends["family"])
        return F.concat(body, end.otherwise(ends["n"]))

    return F.when(value.rlike(r"\p{IsCyrillic}"), of("cyrillic")).when(value.rlike(r"\p{IsGreek}"), of("greek")).otherwise(of("latin"))


def surrogate(kind: Column, value: Column, attempt: Column, key: str = KEY) -> Column:
    """The surrogate, in canonical form, of an entity's canonical form."""
    seed = F.concat_ws("|", F.lit(key), kind, value, attempt.cast("string"))

    def drawn(stream: Column) -> Column:
        like = _like(value, stream)
        hexed = F.array_join(
            F.transform(F.split(value, ""), lambda c, i: F.when(c.rlike("[0-9a-f]"), F.lower(F.hex(_number(stream, i) % 16))).otherwise(c)), ""
        )
        more = _added(value, attempt, stream)
        head = F.regexp_extract(value, "^(AKIA|(?:ghp|gho|sk|pk|xox[abp])[_-])?", 1)
        return (
            F.when(kind == "card", _card(value, stream))
            .when(kind == "ip", _ip(value, stream))
            .when(kind == "email", _email(value, key, attempt, stream))
            .when(kind == "iban", F.concat(F.left(value, F.lit(2)), F.substr(like, F.lit(3))))
            .when(kind == "phone", F.concat(F.regexp_extract(value, PHONE_HEAD, 1), F.substr(like, F.length(F.regexp_extract(value, PHONE_HEAD, 1)) + 1)))
            .when((kind == "secret") & value.rlike("^[0-9a-f]+$"), F.concat(hexed, more))
            .when((kind == "secret") & ~value.rlike(r"[0-9\p{L}]"), F.concat(_signs(value, stream), more))
            .when(kind == "secret", F.concat(head, F.substr(like, F.length(head) + 1), more))
            .when(kind == "ssn", like)
            .otherwise(_name(kind, value, attempt, stream))
        )

    return let(_stream(seed, F.greatest(F.length(value) + attempt, F.lit(32))), drawn)


def with_spaces(entities: DataFrame) -> DataFrame:
    """``entities`` with ``head, left, right``: numbers of this head are ``left`` * ``right``; null if not bounded."""
    kind, value = F.col("type"), F.col("canonical")
    head = (
        F.when((kind == "ip") & value.rlike(PRIVATE), F.substring_index(value, ".", 2))
        .when(kind == "phone", F.regexp_extract(value, PHONE_HEAD, 1))
        .when(kind == "ssn", F.lit(""))
    )
    digits = F.least(F.length(value) - F.length("head"), F.lit(18))
    power = lambda n: F.when(kind == "ip", 256).otherwise(F.pow(F.lit(10), n)).cast("long")
    bounded = F.col("head").isNotNull()
    of = entities.withColumn("head", head).withColumn("_digits", F.when(bounded, digits))
    of = of.withColumn("left", F.when(bounded, power(F.floor(F.col("_digits") / 2))))
    return of.withColumn("right", F.when(bounded, power(F.ceil(F.col("_digits") / 2)))).drop("_digits")


SPACE = ("type", "head", "left", "right")


def _numbered(n: Column) -> Column:
    """The ``n``-th number of a space."""
    digits = F.length(F.col("left").cast("string")) + F.length(F.col("right").cast("string")) - 2
    octets = F.concat_ws(".", "head", F.floor(n / 256).cast("string"), (n % 256).cast("string"))
    return F.when(F.col("type") == "ip", octets).otherwise(F.concat("head", F.lpad(n.cast("string"), digits, "0")))


def _permuted(key: str) -> Column:
    """Another number of the space for ``canonical``: a keyed permutation, a step on, and the permutation back."""
    left, right = F.col("left"), F.col("right")
    rest = F.substr(F.col("canonical"), F.length("head") + 1)
    parts = F.split(F.col("canonical"), r"\.")
    octets = F.get(parts, F.lit(2)).cast("long") * 256 + F.get(parts, F.lit(3)).cast("long")
    at = F.when(F.col("type") == "ip", octets).otherwise(rest.try_cast("long"))
    halves = lambda n: F.struct(F.floor(n / right).alias("l"), (n % right).alias("r"))

    def turned(state: Column, k: int, sign: int) -> Column:
        def drawn(x: Column) -> Column:
            seed = F.concat_ws("|", F.lit(key), "type", "head", F.lit(str(k)), x.cast("string"))
            return F.conv(F.substr(F.sha2(seed.cast("binary"), 256), F.lit(1), F.lit(15)), 16, 10).cast("long")

        if k % 2:
            return let(state, lambda s: F.struct(s["l"].alias("l"), F.pmod(s["r"] + sign * (drawn(s["l"]) % right), right).alias("r")))
        return let(state, lambda s: F.struct(F.pmod(s["l"] + sign * (drawn(s["r"]) % left), left).alias("l"), s["r"].alias("r")))

    state = halves(at)
    for k in range(4):
        state = turned(state, k, 1)
    state = let(state, lambda s: halves((s["l"] * right + s["r"] + 1) % (left * right)))
    for k in reversed(range(4)):
        state = turned(state, k, -1)
    return let(state, lambda s: _numbered(s["l"] * right + s["r"]))


def crowded(entities: DataFrame) -> DataFrame:
    """``type, head, left, right, n``: spaces of numbers of which more than a quarter are entities."""
    counted = with_spaces(entities).where("head is not null").groupBy(*SPACE).agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") / F.col("left") > F.col("right") / 4)


def placed(entities: DataFrame, spaces: DataFrame, key: str = KEY) -> DataFrame:
    """``type, canonical, surrogate`` of the entities of crowded spaces, see the head of this module."""
    own = with_spaces(entities).join(spaces, [*SPACE])
    full = 2 * F.col("n") > F.col("left") * F.col("right")
    order = Window.partitionBy(*SPACE).orderBy(F.sha2(F.concat_ws("|", F.lit(key), "canonical").cast("binary"), 256))
    every = spaces.where(~full).withColumn("l", F.explode(F.sequence(F.lit(0).cast("long"), F.col("left") - 1)))
    every = every.withColumn("r", F.explode(F.sequence(F.lit(0).cast("long"), F.col("right") - 1)))
    every = every.withColumn("canonical", _numbered(F.col("l") * F.col("right") + F.col("r")))
    free = every.join(own.select("type", "canonical"), ["type", "canonical"], "left_anti").withColumn("place", F.row_number().over(order))
    ranked = own.where(~full).withColumn("place", F.row_number().over(order))
    given = ranked.join(free.select(*SPACE, "place", F.col("canonical").alias("surrogate")), [*SPACE, "place"])
    moved = own.where(full).withColumn("surrogate", _permuted(key))
    return given.select("type", "canonical", "surrogate").unionByName(moved.select("type", "canonical", "surrogate"))


def rendered(kind: Column, mention: Column, value: Column) -> Column:
    """A canonical surrogate in the format of a mention."""
    fills = F.regexp_replace(value, "[^0-9A-Z]", "")
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("k"))

    def step(a: Column, c: Column) -> Column:
        slot = c.rlike("[0-9A-Z]")
        return F.struct(
            F.concat(a["out"], F.when(slot, F.substr(fills, a["k"], F.lit(1))).otherwise(c)).alias("out"),
            (a["k"] + F.when(slot, 1).otherwise(0)).alias("k"),
        )

    filled = F.aggregate(F.split(mention, ""), start, step, lambda a: a["out"])
    shouted = (F.upper(mention) == mention) & (F.length(mention) > 1)
    name = F.when(shouted, F.upper(value)).otherwise(F.concat(F.upper(F.left(value, F.lit(1))), F.substr(value, F.lit(2))))
    return (
        F.when(kind.isin(*NUMBERS, "iban"), filled)
        .when(kind == "email", F.when(shouted, F.upper(value)).otherwise(value))
        .when(kind == "secret", F.concat(F.regexp_extract(mention, f"^({SECRET_NAME})?", 1), value))
        .when(kind == "ip", value)
        .otherwise(name)
    )


def assigned(entities: DataFrame, key: str = KEY) -> DataFrame:
    """``type, canonical, surrogate`` for distinct entities, without clashes inside a type.

    Distinctness joins the three kinds of given names, which look alike in a text.
    """
    family = F.when(F.col("type").startswith("given"), "given").otherwise(F.col("type"))
    own = staged(entities.select("type", "canonical").distinct(), "entities")
    spaces = staged(crowded(own), "crowded-spaces")
    given = None
    if not spaces.isEmpty():
        given = staged(placed(own, spaces, key), "placed")
        own = own.join(given, ["type", "canonical"], "left_anti")  # no draw leaves its space or enters another
    own = own.withColumn("attempt", F.lit(0))

    def drawn(rows: DataFrame) -> DataFrame:
        made = rows.withColumn("surrogate", surrogate(F.col("type"), F.col("canonical"), F.col("attempt"), key))
        return staged(made.withColumn("kind", family), "surrogates")

    rows = drawn(own)
    while True:
        first = rows.groupBy("kind", "surrogate").agg(
            F.min(F.struct("canonical", "type")).alias("first"), F.count(F.lit(1)).alias("n")
        )
        shared = rows.join(first.where("n > 1"), ["kind", "surrogate"]).where(
            F.struct("canonical", "type") != F.col("first")
        )
        real = rows.join(rows.select("kind", F.col("canonical").alias("surrogate")).distinct(), ["kind", "surrogate"], "left_semi")
        again = shared.select("type", "canonical").unionByName(real.select("type", "canonical")).distinct()
        again = staged(again.withColumn("more", F.lit(1)), "clashes")
        if again.isEmpty():
            known = rows.select("type", "canonical", "surrogate")
            return known.unionByName(given) if given else known
        rows = drawn(
            rows.join(again, ["type", "canonical"], "left").select(
                "type", "canonical", (F.col("attempt") + F.coalesce("more", F.lit(0))).alias("attempt")
            )
        )


def with_surrogates(docs: DataFrame, key: str = KEY) -> DataFrame:
    """``docs`` with entities of ``text`` replaced, and ``n_entities``."""
    columns = [c for c in docs.columns if c != "n_entities"]
    marked = docs.select(
        *[F.col(f"`{c}`") for c in columns],
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("_id"),
        F.xxhash64("text").alias("_hash"),
    )
    has = has_entities(F.col("text"))
    with_some = staged(marked.where(has), "texts-with-entities")  # the pattern runs over all texts twice, not thrice
    found = with_some.select("_id", "_hash", F.posexplode(mentions(F.col("text"))).alias("i", "e")).select(
        "_id", "_hash", "i", "e.mention", "e.type", canonical(F.col("e.type"), F.col("e.mention")).alias("canonical")
    )
    found = staged(found.distinct(), "mentions")
    known = assigned(found, key)
    out = found.join(known, ["type", "canonical"]).select(
        "_id", "_hash", F.struct("i", rendered(F.col("type"), F.col("mention"), F.col("surrogate")).alias("v")).alias("e")
    )
    out = out.groupBy("_id", "_hash").agg(F.transform(F.array_sort(F.collect_list("e")), lambda e: e["v"]).alias("_new"))
    gaps = F.split(F.col("text"), PATTERN, -1)
    text = let(gaps, lambda g: F.array_join(F.zip_with(g, F.concat("_new", F.array(F.lit(""))), lambda a, b: F.concat(a, b)), ""))
    changed = with_some.join(out, ["_id", "_hash"]).withColumns({"text": text, "n_entities": F.size("_new").cast("long")})
    rest = marked.where(~has).withColumn("n_entities", F.lit(0).cast("long"))
    wanted = [F.col(f"`{c}`") for c in columns] + [F.col("n_entities")]
    return changed.select(*wanted).unionByName(rest.select(*wanted))


def op1_pii_surrogates(spark: SparkSession, directory: str) -> DataFrame:
    return with_surrogates(table(spark, directory, "documents").select("doc_id", "text"))

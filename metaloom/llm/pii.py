"""Personal data replaced by keyed surrogates of the same kind."""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame, functions as F

from metaloom.operators.joins import skew_safe_join
from metaloom.session import stage

# Formats of what is detected. What may repeat without bound is a class of characters, never a group:
# Java matches a repeated group by recursion, and a long text would overflow the stack.
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-][A-Za-z0-9.-]*\.[A-Za-z]{2,}"
#: A keyword, also at the end of a longer name or in quotes, and what assigns.
ASSIGNED = r"""(?i:password|passwd|pwd|secret|token|api[_-]?key)(?:\\?["'])?\s{0,3}[=:]"""
SECRET = ASSIGNED + r"""\s{0,3}(?:\\?["'])?(?=[_+/-]*[A-Za-z0-9])[A-Za-z0-9_+/-]{8,}"""
ACCESS_KEY = r"\b(?:AKIA|ASIA)[0-9A-Z]{16}\b"
IPV4 = r"(?<![\d.vV])(?<![Vv]ersion )(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\.?\d)"
PHONE = (
    r"\+1[ .-]?\(?\d{3}\)?[ .-]?\d{3}[ .-]?\d{4}(?!\d)|\+(?!\d{16})\d(?:[ ./-]?\(?\d\)?){6,22}(?!\d)"
    r"|\+\d{1,3}(?:[ -]\(?\d{1,4}\)?){2,5}(?![\d.])|\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}(?!\d)"
    r"|(?<![\d-])\d{3}[ .-]\d{3}[ .-]\d{4}(?![\d-])|(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
)
CARD = r"(?<!\d)(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3}|\d{4}[ -]\d{6}[ -]\d{5})(?!\d)"
MALE_TITLES = r"Mr|Herr|Monsieur|Señor|Sr|г-н"
FEMALE_TITLES = r"Mrs|Ms|Miss|Frau|Mme|Madame|Señora|Sra|г-жа"
TITLES = rf"(?:{MALE_TITLES}|{FEMALE_TITLES}|Dr)\.? "
NAME = rf"(?<!\p{{L}}){TITLES}\p{{Lu}}\p{{L}}+(?: \p{{Lu}}\p{{L}}+)?"
#: What tells that a text may hold any of these; each of them has one.
CUE = rf"[0-9@]|(?<!\p{{L}}){TITLES}\p{{Lu}}|{ASSIGNED}|AKIA|ASIA"
ENTITY = "|".join([EMAIL, SECRET, ACCESS_KEY, IPV4, NAME, CARD, PHONE])
# Syllables of surrogate names, by script.
LATIN = ("ba", "be", "da", "de", "fi", "ga", "ka", "la", "le", "ma", "mi", "na", "ne", "pe", "ra", "ri", "sa", "so", "ta", "vi")
CYRILLIC = ("ба", "бе", "ва", "ве", "га", "да", "де", "ка", "ла", "ле", "ма", "ми", "на", "не", "ра", "ри", "са", "со", "та", "ти")

#: Times a surrogate is drawn anew in its own length; later ones are longer by so many characters for each turn.
ROUNDS, LONGER = 12, 8
#: Characters of a piece whose form its surrogate has. What is longer, as no name or address is, is replaced whole too.
MOST_SHAPED = 4096


def _all_of(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, r"\D", "")


def _luhn(digits: Column) -> Column:
    """The Luhn sum modulo 10 of digits read from the right, the last one undoubled."""
    places = F.transform(
        F.split(F.reverse(digits), ""),
        lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
            (c.cast("int") * 2) % 10 + F.floor(c.cast("int") / 5).cast("int")
        ),
    )
    return F.aggregate(places, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10


def _units(raw: Column) -> Column:
    """What is to be replaced in a match: pieces of one kind each, in canonical form. Empty if it is no entity.

    Forms of one entity share its canonical piece: numbers their digits, addresses and names their lower case. An
    address has its domain as second piece, so that addresses of one domain stay together.
    """

    def one(kind: str, text: Column) -> Column:
        return F.array(F.struct(F.lit(kind).alias("kind"), text.alias("canon")))

    digits = _digits(raw)
    names = F.split(F.regexp_replace(raw, rf"^{TITLES}", ""), " ")
    kind = F.when(raw.rlike(rf"^(?:{FEMALE_TITLES})\.? "), "female").when(raw.rlike(rf"^(?:{MALE_TITLES})\.? "), "male")
    address = F.lower(raw)
    domain = F.struct(F.lit("domain").alias("kind"), F.substring_index(address, "@", -1).alias("canon"))
    surname = F.struct(F.lit("surname").alias("kind"), F.lower(F.element_at(names, -1)).alias("canon"))
    given = F.struct(F.coalesce(kind, F.lit("given")).alias("kind"), F.lower(F.element_at(names, 1)).alias("canon"))
    return (
        F.when(raw.rlike(rf"^(?:{EMAIL})$"), F.concat(one("email", address), F.array(domain)))
        .when(raw.rlike(rf"^(?:{SECRET})$"), one("secret", F.regexp_extract(raw, r"([A-Za-z0-9_+/-]{8,})$", 1)))
        .when(raw.rlike(rf"^(?:{ACCESS_KEY})$"), one("key", raw))
        .when(raw.rlike(rf"^(?:{IPV4})$"), one("ip", raw))
        .when(raw.rlike(rf"^(?:{NAME})$"), F.when(F.size(names) > 1, F.array(given, surname)).otherwise(F.array(surname)))
        .when(raw.rlike(rf"^(?:{CARD})$") & (_luhn(digits) == 0), one("card", digits))
        .when(raw.rlike(rf"^(?:{PHONE})$"), one("phone", F.concat(F.when(raw.startswith("+"), "+").otherwise(""), digits)))
        .otherwise(F.array().cast("array<struct<kind:string,canon:string>>"))
    )


def _seed(key: str, kind: Column, canon: Column, turn: int) -> Column:
    return F.sha2(F.concat_ws("\x1f", F.lit(key), kind, canon, F.lit(str(turn))), 256)


def _stream(seed: Column, canon: Column) -> Column:
    """Keyed bytes, one for each character of the piece at least, as blocks of 64 hex digits."""
    shaped = F.least(F.length(canon), F.lit(MOST_SHAPED))
    blocks = F.sequence(F.lit(0), F.floor((shaped + 8) / 32).cast("int"))
    return F.transform(blocks, lambda i: F.sha2(F.concat_ws("\x1f", seed, i), 256))


def _byte(stream: Column, i: Column) -> Column:
    block = F.get(stream, F.floor(i / 32).cast("int"))
    return F.conv(F.substr(block, (i % 32).cast("int") * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _like(text: Column, stream: Column, hexadecimal: Column) -> Column:
    """Characters of the same class for each digit and letter; all others stay."""

    def other(c: Column, i: Column) -> Column:
        v = _byte(stream, i.cast("int"))
        wide = F.when(hexadecimal, F.lit(6)).otherwise(26)
        return (
            F.when(c.rlike("^[0-9]$"), (v % 10).cast("string"))
            .when(c.rlike("^[a-z]$"), F.char(v % wide + 97))
            .when(c.rlike("^[A-Z]$"), F.char(v % wide + 65))
            .otherwise(c)
        )

    return F.array_join(F.transform(F.split(F.left(text, F.lit(MOST_SHAPED)), ""), other), "")


def _drawn(seed: Column, stream: Column, hexadecimal: Column, kind: Column, canon: Column, turn: int) -> Column:
    """A surrogate of the same kind, from a seed made of the key, the piece and the turn, and its stream.

    One for an e-mail address has the old domain, as the domain is replaced by a surrogate of its own. From turn
    ``ROUNDS`` on, surrogates are longer with each turn, and those of IPv4 addresses are private IPv6 addresses, so
    that there are always more of them than pieces.
    """
    blocks = max(0, turn - ROUNDS + 1) * LONGER // 64 + 1
    more = F.concat(*(F.sha2(F.concat_ws("\x1f", seed, F.lit(f"more {i}")), 256) for i in range(blocks)))
    free = F.substr(more, F.lit(1), F.lit(max(0, turn - ROUNDS + 1) * LONGER))
    free_digits = F.translate(free, "abcdef", "012345")
    like = _like(canon, stream, hexadecimal)

    top = F.substring_index(canon, ".", -1)
    host = F.substr(canon, F.lit(1), F.length(canon) - F.length(top))
    dot = F.when(F.length(host) > MOST_SHAPED, ".").otherwise("")
    domain = F.concat(free, _like(host, stream, F.lit(False)), dot, top)
    local = F.substring_index(canon, "@", 1)
    email = F.concat(_like(local, stream, F.lit(False)), free, F.lit("@"), F.substring_index(canon, "@", -1))

    if turn < ROUNDS:
        octets = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: (_byte(stream, i) % 254 + 1).cast("string"))
        ip = F.array_join(octets, ".")
    else:
        parts = F.concat(F.lit("fd"), F.substr(more, F.lit(1), F.lit(30)))
        ip = F.concat_ws(":", *(F.substr(parts, F.lit(i), F.lit(4)) for i in range(1, 32, 4)))
    card = F.concat(F.substr(canon, F.lit(1), F.lit(1)), F.substr(like, F.lit(2), F.length(canon) - 2), free_digits)
    card = F.concat(card, ((10 - _luhn(F.concat(card, F.lit("0")))) % 10).cast("string"))

    code = F.regexp_extract(canon, r"^(\+(?:1|[2-9]\d)?)?", 0)
    start = F.length(code)
    lead = (_byte(stream, start) % 8 + 2).cast("string")
    phone = F.concat(code, lead, F.substr(like, start + 2, F.length(canon)), free_digits)

    cyrillic = canon.rlike(r"\p{IsCyrillic}")
    pick = F.transform(
        F.sequence(F.lit(0), F.lit(2) + F.lit(turn // 2)),
        lambda i: F.when(
            cyrillic, F.element_at(F.array(*(F.lit(s) for s in CYRILLIC)), _byte(stream, i) % len(CYRILLIC) + 1)
        ).otherwise(F.element_at(F.array(*(F.lit(s) for s in LATIN)), _byte(stream, i) % len(LATIN) + 1)),
    )
    ending = (
        F.when(kind == "female", F.when(cyrillic, "на").otherwise("na"))
        .when(kind == "male", F.when(cyrillic, "н").otherwise("n"))
        .when(kind == "surname", F.when(cyrillic, "к").otherwise("k"))
        .otherwise("")
    )
    name = F.concat(F.array_join(pick, ""), ending)
    return (
        F.when(kind == "email", email)
        .when(kind == "domain", domain)
        .when(kind == "ip", ip)
        .when(kind == "card", card)
        .when(kind == "phone", phone)
        .when(kind == "key", F.concat(F.substr(canon, F.lit(1), F.lit(4)), F.substr(like, F.lit(5), F.lit(16)), F.upper(free)))
        .when(kind.isin("female", "male", "given", "surname"), name)
        .otherwise(F.concat(like, free))
    )


def surrogates(pieces: DataFrame, key: str) -> DataFrame:
    """``kind, canon, surrogate`` for distinct pieces: distinct within a kind, and never a piece of the input.

    Pieces whose surrogate another one has, or that hit a piece, draw again; the least piece keeps a shared one. After
    ``ROUNDS`` draws, the open ones draw from longer surrogates, which do not run out.
    """
    pieces = stage(pieces.select("kind", "canon").distinct(), "pieces")
    open_pieces, done = pieces, None
    for turn in count():
        drawn = open_pieces.withColumn("seed", _seed(key, F.col("kind"), F.col("canon"), turn))
        drawn = drawn.withColumn("stream", _stream(F.col("seed"), F.col("canon")))
        hexadecimal = F.col("canon").rlike("^[0-9a-f]+$") | F.col("canon").rlike("^[0-9A-F]+$")
        drawn = drawn.withColumn("hexadecimal", hexadecimal)  # a column, as it would else be worked out for each character
        one = _drawn(*(F.col(c) for c in ("seed", "stream", "hexadecimal", "kind", "canon")), turn)
        drawn = stage(drawn.select("kind", "canon", one.alias("surrogate")), "drawn")
        first = drawn.groupBy("kind", "surrogate").agg(F.min("canon").alias("canon"))
        taken = pieces.select("kind", F.col("canon").alias("surrogate"))
        if done is not None:
            taken = taken.unionByName(done.select("kind", "surrogate"))
        won = first.join(taken, ["kind", "surrogate"], "left_anti").select("kind", "canon", "surrogate")
        done = won if done is None else done.unionByName(won)
        left = drawn.join(won, ["kind", "canon"], "left_anti").select("kind", "canon")
        if left.isEmpty():
            return done
        open_pieces, done = stage(left, "undrawn"), stage(done, "surrogates")


def _rendered(raw: Column, kinds: Column, new: Column) -> Column:
    """The match with its pieces replaced, in its own layout and case."""
    kind, one = F.element_at(kinds, 1), F.element_at(new, 1)
    digits = _digits(one)
    laid = F.aggregate(
        F.split(raw, ""),
        F.struct(F.lit("").alias("text"), F.lit(0).alias("used")),
        lambda a, c: F.struct(
            F.concat(
                a["text"], F.when(c.rlike(r"^\d$"), F.substr(digits, a["used"] + 1, F.lit(1))).otherwise(c)
            ).alias("text"),
            (a["used"] + c.rlike(r"^\d$").cast("int")).alias("used"),
        ),
        # a longer surrogate has digits left
        lambda a: F.concat(a["text"], F.substr(digits, a["used"] + 1, F.length(digits))),
    )
    title = F.regexp_extract(raw, rf"^{TITLES}", 0)
    rest = F.substr(raw, F.length(title) + 1, F.length(raw))
    names = F.array_join(F.transform(new, lambda n: F.initcap(n)), " ")
    names = F.concat(title, F.when((rest == F.upper(rest)), F.upper(names)).otherwise(names))
    email = F.concat(F.substring_index(one, "@", 1), F.lit("@"), F.get(new, F.lit(1)))
    upper = (raw == F.upper(raw)) & (raw != F.lower(raw))
    value = F.regexp_extract(raw, r"([A-Za-z0-9_+/-]{8,})$", 1)
    return (
        F.when(kind == "email", F.when(upper, F.upper(email)).otherwise(email))
        .when(kind.isin("card", "phone"), laid)
        .when(kind == "secret", F.concat(F.substr(raw, F.lit(1), F.length(raw) - F.length(value)), one))
        .when(kind.isin("female", "male", "given", "surname"), names)
        .otherwise(one)
    )


def replace_private(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``docs`` with detected personal data and secrets replaced, and ``n_replaced``, how many places were.

    Detected are e-mail and IPv4 addresses, phone numbers, card numbers (by Luhn's sum), access keys, assigned
    passwords and tokens, and names behind a title. A surrogate is drawn from ``key`` and the entity, so an entity
    has the same one everywhere, in every layout it is written in. It has the same kind and form: letters, digits and
    separators in the same places, the country code, the first digit and a valid sum of a card, the domain of
    addresses that share one, the script and the title's gender of a name. Only where a form has too few surrogates for
    all its entities are some of them longer, and some IPv4 addresses become private IPv6 ones. Surrogates are checked over the whole
    table: no two entities of a kind share one, and none is an entity of the input.

    Null texts stay null, and texts without entities stay as they are; repeated rows are treated alike, and no length of
    a text or an entity is too long. Columns are kept, whatever their names, but for one named ``n_replaced``, which is
    replaced. An empty table gives no rows. Texts are searched once, and what is found in them is staged with what lies
    between. Only texts with entities are moved, to meet the surrogates of their own list of entities; lists and
    entities that many rows share are split.
    """
    rows = docs.drop("n_replaced")
    value = F.col("text")
    others = [F.col(f"`{c}`") for c in rows.columns if c != text]
    row = F.struct(*others) if others else F.struct(F.lit(0))
    found = rows.select(row.alias("row"), F.col(f"`{text}`").cast("string").alias("text"))
    found = found.withColumn("found", F.when(value.rlike(CUE), _all_of(value, ENTITY)))
    found = found.withColumn("found", F.when(F.size("found") > 0, F.col("found")))
    some = F.col("found").isNotNull()
    gaps = F.when(some, F.split(value, ENTITY, -1)).alias("gaps")
    own = F.when(some, F.md5(F.to_json("found"))).alias("list")  # stands for the list, which may be long, in keys
    found = stage(found.select("row", F.when(~some, value).alias("text"), "found", gaps, own), "found")
    plain = found.filter(~some).select("row", "text", F.lit(0).alias("n_replaced"))
    found = found.filter(some)

    lists = found.groupBy("list").agg(F.any_value("found").alias("found"))
    raws = lists.select(F.explode("found").alias("raw")).distinct()
    raws = stage(raws.withColumn("units", _units(F.col("raw"))).filter("size(units) > 0"), "entities")
    pieces = raws.select("raw", F.posexplode("units").alias("at", "unit")).select("raw", "at", "unit.*")
    named = skew_safe_join(pieces, surrogates(pieces, key), ["kind", "canon"], "inner")
    whole = named.groupBy("raw").agg(F.sort_array(F.collect_list(F.struct("at", "kind", "surrogate"))).alias("new"))
    made = whole.select("raw", _rendered(F.col("raw"), F.col("new.kind"), F.col("new.surrogate")).alias("made"))

    entries = lists.select("list", F.posexplode("found").alias("at", "raw"))
    entries = skew_safe_join(entries, stage(made, "rendered"), ["raw"], "left")
    replaced = entries.groupBy("list").agg(
        F.sort_array(F.collect_list(F.struct("at", F.coalesce("made", "raw").alias("made")))).alias("new"),
        F.count("made").cast("int").alias("n_replaced"),
    )
    both = skew_safe_join(found.select("row", "gaps", "list"), replaced, ["list"], "inner")
    made_text = F.zip_with("gaps", "new.made", lambda gap, new: F.concat(gap, F.coalesce(new, F.lit(""))))
    both = both.select("row", F.array_join(made_text, "").alias("text"), "n_replaced").unionByName(plain)
    kept = [F.col("text" if c == text else f"row.`{c}`").alias(c) for c in rows.columns]
    return both.select(*kept, "n_replaced")

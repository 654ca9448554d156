"""Personal data: every entity found gets a keyed surrogate of its own kind. DataFrame functions only.

The same entity gets the same surrogate everywhere, however it's written (coreference), and different ones
different surrogates that are nobody's in the corpus (distinctness): the table of distinct entities is checked for
collisions, and who loses one draws again.

Not found: names without a title, postal addresses, national phone numbers in other groups than 3-3-4 or
parentheses, cards of 17 to 19 digits, secrets under 16 characters or other key names, unquoted ones without
a digit, and IPv6.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._util import forget, stored

# Titles by gender, and given names by gender and script.
TITLES = {
    "f": ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "госпожа", "κυρία"],
    "m": ["Mr", "Herr", "Monsieur", "Señor", "Sr", "господин", "κύριος"],
}
GIVEN = {
    ("f", "latin"): ["Ada", "Clara", "Edith", "Greta", "Ines", "Karin", "Lena", "Mara", "Nora", "Petra", "Rosa", "Vera"],
    ("m", "latin"): ["Adam", "Bruno", "Carl", "David", "Emil", "Hugo", "Jonas", "Leo", "Marco", "Oscar", "Paul", "Viktor"],
    ("f", "cyrillic"): ["Анна", "Вера", "Дарья", "Елена", "Ирина", "Мария", "Нина", "Ольга"],
    ("m", "cyrillic"): ["Антон", "Борис", "Виктор", "Глеб", "Егор", "Иван", "Олег", "Павел"],
    ("f", "greek"): ["Άννα", "Δάφνη", "Ειρήνη", "Ζωή", "Μαρία", "Σοφία"],
    ("m", "greek"): ["Ανδρέας", "Γιώργος", "Ηλίας", "Νίκος", "Πέτρος", "Φώτης"],
}
SYLLABLES = {
    "latin": ["ba", "de", "ki", "lo", "mu", "ra", "se", "ti", "vo", "wen", "hal", "mor", "nis", "tor", "ul", "ger"],
    "cyrillic": ["ба", "де", "ки", "ло", "му", "ра", "се", "ти", "во", "лен", "гал", "мор", "нис", "тор", "ул", "гер"],
    "greek": ["βα", "δε", "κι", "λο", "μου", "ρα", "σε", "τι", "βο", "λεν", "γαλ", "μορ", "νισ", "τορ", "ουλ", "γερ"],
}
SURNAME_ENDS = {("f", "latin"): "man", ("m", "latin"): "man", ("f", "cyrillic"): "ова", ("m", "cyrillic"): "ов", ("f", "greek"): "ίδου", ("m", "greek"): "ίδης"}
ALPHABETS = ["0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "абвгдежзийклмнопрстуфхцчшщъыьэюя", "АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯ", "αβγδεζηθικλμνξοπρστυφχψω", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ"]

HEX = ["0123456789", "abcdef", "ABCDEF"]

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
#: Each alternative starts where a word starts, and loops are over single character classes, so a search is linear.
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "card": r"(?<![0-9])(?:[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}|[0-9]{4}[ -]?[0-9]{6}[ -]?[0-9]{5}|[0-9]{13,15})(?![0-9])",
    "ip": rf"(?<![0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9]|\.[0-9])",
    "phone": r"(?<![0-9])(?:\+[0-9]{1,3}[ .-]?)?\([0-9]{2,4}\)[ .-]?[0-9]{3}[ .-][0-9]{4}(?![0-9])|\+[0-9]{1,3}(?:[ .-][0-9]{2,4}){2,4}(?![0-9])"
    r"|(?<![0-9])(?:\+[0-9]{1,3}[ .-]?)?\([0-9]{2,5}\)[ .-]?(?:[0-9]{6,9}|[0-9]{3,5}(?:[ .-][0-9]{2,4}){1,2})(?![0-9])"
    r"|\+[0-9]{7,15}(?![0-9])|\+[0-9]{1,3}(?:[ .-][0-9]{2,5}){1,3}[ .-][0-9]{4,8}(?![0-9])"
    r"|(?<![0-9.-])[0-9]{3}(?:-[0-9]{3}-|\.[0-9]{3}\.| [0-9]{3} )[0-9]{4}(?![0-9])",
    "secret": r"(?<=(?i:token|secret|password|api_key)[\"']? ?[=:] ?\")[A-Za-z0-9_+/=-]{16,}(?=\")|(?<=(?i:token|secret|password|api_key)[\"']? ?[=:] ?')[A-Za-z0-9_+/=-]{16,}(?=')"
    r"|(?<=(?i:token|secret|password|api_key) ?[=:] ?)(?=[A-Za-z_+/-]*[0-9])[A-Za-z0-9_+/-][A-Za-z0-9_+/=-]{15,}",
    "person": r"(?<!\p{L})(?:" + "|".join(t for of in TITLES.values() for t in of) + r")\.? \p{Lu}[\p{Ll}]+(?: \p{Lu}[\p{Ll}]+)?",
}
ANY = "|".join(PATTERNS.values())
ROUNDS = 12
MARK = "\ufdd0"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _blocks(seed: Column, text: Column, more: Column) -> Column:
    """A seed's row of numbers below 65536, long enough for a text and some ``more``: sha256 digests, four hexadecimal digits a number."""
    return F.transform(F.sequence(F.lit(0), F.floor((F.length(text) + more) / 16).cast("int")), lambda b: F.sha2(F.concat_ws(":", seed, b.cast("string")), 256))


def _number(blocks: Column, i: Column) -> Column:
    return F.conv(F.substring(F.get(blocks, F.floor(i / 16).cast("int")), (i % 16 * 4 + 1).cast("int"), F.lit(4)), 16, 10).cast("int")


def _pick(words: list[str], number: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, words)), (number % len(words) + 1).cast("int"))


def _reshaped(text: Column, blocks: Column, alphabets: list[str] = ALPHABETS) -> Column:
    """Each digit and letter replaced by one of its own class, case and script; all else stays."""
    every = F.lit("".join(alphabets))

    def one(char: Column, number: Column) -> Column:
        def swap(at: Column) -> Column:
            out, end = char, sum(map(len, alphabets))
            for alphabet in reversed(alphabets):
                first = end - len(alphabet)
                out = F.when((at > first) & (at <= end), F.substring(every, first + 1 + number % len(alphabet), F.lit(1))).otherwise(out)
                end = first
            return out

        return _let(F.instr(every, char), swap)

    chars = F.transform(F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1))), lambda i: one(F.substring(text, i, F.lit(1)), _number(blocks, i)))
    return F.when(F.length(text) > 0, F.array_join(chars, "")).otherwise("")


def _luhn(digits: Column) -> Column:
    """The Luhn sum of a string of digits, the last one not doubled."""
    at = F.sequence(F.lit(1), F.greatest(F.length(digits), F.lit(1)))
    each = F.transform(at, lambda i: F.substring(digits, i, F.lit(1)).try_cast("int") * F.when((F.length(digits) - i) % 2 == 1, 2).otherwise(1))
    return F.aggregate(each, F.lit(0), lambda total, x: total + F.coalesce(x, F.lit(0)) - F.when(x > 9, 9).otherwise(0))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def kind_of(value: Column) -> Column:
    """The type of a match of ANY; null for a number of 13 to 16 digits that isn't a card number."""
    is_card = value.rlike(r"^(?:[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}|[0-9]{4}[ -]?[0-9]{6}[ -]?[0-9]{5}|[0-9]{13,15})$")
    titles = r"^(?:" + "|".join(t for of in TITLES.values() for t in of) + r")\.? \p{Lu}"
    return (
        F.when(F.instr(value, "@") > 0, "email").when(is_card, F.when(_let(_digits(value), _luhn) % 10 == 0, "card"))
        .when(value.rlike(rf"^(?:{_OCTET}\.){{3}}{_OCTET}$"), "ip").when(value.rlike(r"^[+(]|^[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}$"), "phone").when(value.rlike(titles), "person").otherwise("secret")
    )


# --- entities: what stays the same however it's written


def _sex_and_script(value: Column) -> tuple[Column, Column]:
    title = F.regexp_replace(F.regexp_extract(value, r"^\S+", 0), r"\.$", "")
    sex = F.when(title.isin(TITLES["f"]), "f").otherwise("m")
    return sex, F.when(value.rlike(r" \p{IsCyrillic}"), "cyrillic").when(value.rlike(r" \p{IsGreek}"), "greek").otherwise("latin")


def keys_of(kind: Column, value: Column) -> Column:
    """The entities that a match stands for, as structs (kind, value): one, or a surname and a given name for a person.

    Mail addresses are one entity in any case, cards and phones with any separators. A person is the same with any title
    of one gender, spelt with a point or without, and shares the surname with those named by it alone. Surnames
    have a gender only where the script's surnames show it.
    """
    sex, script = _sex_and_script(value)
    names = F.split(value, " ")
    told = F.when(script == "latin", "").otherwise(sex)
    surname = F.struct(F.lit("surname").alias("kind"), F.concat_ws("|", told, script, F.element_at(names, -1)).alias("value"))
    given = F.struct(F.lit("given").alias("kind"), F.concat_ws("|", sex, script, F.get(names, F.lit(1))).alias("value"))
    plain = (
        F.when(kind == "email", F.translate(value, _UPPER, _LOWER))
        .when(kind == "card", _digits(value))
        .when(kind == "phone", F.concat(F.when(value.startswith("+"), "+").otherwise(""), _digits(value)))
        .otherwise(value)
    )
    people = F.when(F.size(names) > 2, F.array(surname, given)).otherwise(F.array(surname))
    return F.when(kind == "person", people).when(kind.isNotNull(), F.array(F.struct(kind.alias("kind"), plain.alias("value"))))


_UPPER, _LOWER = "".join(ALPHABETS[2::2]), "".join(ALPHABETS[1::2])
# Country codes of two digits; 1 and 7 have one, all others three.
COUNTRIES = "20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split()
#: First octets of addresses that are neither reserved nor in a range that is in part.
PUBLIC = [n for n in range(1, 224) if n not in (10, 100, 127, 169, 172, 192, 198, 203)]


def _drawn_email(value: Column, blocks: Column) -> Column:
    top = F.regexp_extract(value, r"\.[a-z]{2,}$", 0)
    return _let(top, lambda t: F.concat(_reshaped(F.substring(value, F.lit(1), F.length(value) - F.length(t)), blocks), t))


def _drawn_card(value: Column, blocks: Column) -> Column:
    """The first digit stays; the last one makes it valid."""
    body = F.concat(F.substring(value, 1, 1), _reshaped(F.substring(value, F.lit(2), F.length(value) - 2), blocks))
    last = lambda digits: ((10 - _luhn(digits) % 10) % 10).cast("string")
    return _let(body, lambda b: F.concat(b, _let(F.concat(b, F.lit("0")), last)))


def _drawn_phone(value: Column, blocks: Column) -> Column:
    """The country code stays."""
    two = F.substring(value, 2, 2).isin(COUNTRIES)
    size = F.when(~value.startswith("+"), 0).when(F.substring(value, 2, 1).isin("1", "7"), 2).when(two, 3).otherwise(4)
    return _let(size, lambda n: F.concat(F.substring(value, F.lit(1), n), _reshaped(F.substring(value, n + 1, F.length(value)), blocks)))


def _drawn_ip(value: Column, blocks: Column) -> Column:
    """An address of the same class: loopback, private, link-local and multicast ones keep the octets that make them so."""
    octet = [F.split_part(value, F.lit("."), F.lit(i)).cast("int") for i in (1, 2)]
    free = [(_number(blocks, F.lit(i)) % 256).cast("string") for i in (1, 2, 3)]
    first, second = (o.cast("string") for o in octet)
    public = F.element_at(F.array(*map(F.lit, PUBLIC)), (_number(blocks, F.lit(0)) % len(PUBLIC) + 1).cast("int")).cast("string")
    within = lambda least, n: (_number(blocks, F.lit(1)) % n + least).cast("string")
    pairs = ((octet[0] == 192) & (octet[1] == 168)) | ((octet[0] == 169) & (octet[1] == 254))
    return (
        F.when(octet[0].isin(0, 10, 127) | (octet[0] >= 224), F.concat_ws(".", first, *free))
        .when(pairs, F.concat_ws(".", first, second, *free[1:]))
        .when((octet[0] == 172) & octet[1].between(16, 31), F.concat_ws(".", first, within(16, 16), *free[1:]))
        .when((octet[0] == 100) & octet[1].between(64, 127), F.concat_ws(".", first, within(64, 64), *free[1:]))
        .otherwise(F.concat_ws(".", public, *free))
    )


def _syllables(script: str, blocks: Column, attempt: Column) -> Column:
    return F.array_join(F.transform(F.sequence(F.lit(1), F.lit(3) + attempt), lambda i: _pick(SYLLABLES[script], _number(blocks, i))), "")


def _drawn_name(kind: Column, value: Column, blocks: Column, attempt: Column) -> Column:
    """A name of the same script, and gender where it shows. Each further draw has a syllable more, so its names are sixteen times as many."""
    sex, script = F.split_part(value, F.lit("|"), F.lit(1)), F.split_part(value, F.lit("|"), F.lit(2))
    out = F.lit("")
    for (who, of), names in GIVEN.items():
        syllables = _syllables(of, blocks, attempt)
        surname = F.initcap(F.concat(syllables, F.lit(SURNAME_ENDS[who, of])))
        given = F.when(attempt == 0, _pick(names, _number(blocks, F.lit(0)))).otherwise(F.initcap(syllables))
        fits = (script == of) & ((sex == who) | ((sex == "") & F.lit(who == "m")))
        out = F.when(fits, F.when(kind == "surname", surname).otherwise(given)).otherwise(out)
    return F.concat_ws("|", sex, script, out)


def surrogate(kind: Column, value: Column, key: str, attempt: Column) -> Column:
    """The entity that takes the place of an entity (kind, value) in the attempt-th draw (0 at first)."""

    def drawn(seed: Column) -> Column:
        def new(blocks: Column) -> Column:
            secret = F.when(value.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$"), _reshaped(value, blocks, HEX)).otherwise(_reshaped(value, blocks))
            return (
                F.when(kind == "email", _drawn_email(value, blocks))
                .when(kind == "card", _drawn_card(value, blocks))
                .when(kind == "ip", _drawn_ip(value, blocks))
                .when(kind == "phone", _drawn_phone(value, blocks))
                .when(kind.isin("surname", "given"), _drawn_name(kind, value, blocks, attempt))
                .otherwise(secret)
            )

        out = _let(_blocks(seed, value, attempt + 4), new)
        return F.when((attempt >= ROUNDS) & ~kind.isin("surname", "given"), F.concat(out, F.lit("-"), F.substring(seed, 1, 16))).otherwise(out)

    return _let(F.sha2(F.concat_ws("|", F.lit(key), kind, attempt.cast("string"), value), 256), drawn)


def _in_form(digits: Column, form: Column) -> Column:
    """Digits written with the separators of ``form``, which has as many; what is over is added."""
    place = lambda i: F.struct(F.substring(form, i, F.lit(1)).alias("c"), F.length(_digits(F.substring(form, F.lit(1), i))).alias("n"))
    places = F.transform(F.sequence(F.lit(1), F.length(form)), place)
    chars = F.transform(places, lambda p: F.when(p["c"].rlike("[0-9]"), F.substring(digits, p["n"], F.lit(1))).otherwise(p["c"]))
    return F.concat(F.array_join(chars, ""), F.substring(digits, F.length(_digits(form)) + 1, F.length(digits)))


def _in_case(text: Column, form: Column) -> Column:
    """Capitals where ``form`` has them."""

    def one(i: Column) -> Column:
        capital = F.instr(F.lit(_UPPER), F.substring(form, i, F.lit(1))) > 0
        return _let(F.substring(text, i, F.lit(1)), lambda c: F.when(capital & (i <= F.length(form)), F.translate(c, _LOWER, _UPPER)).otherwise(c))

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(text)), one), "")


def written(kind: Column, value: Column, new: Column) -> Column:
    """A match with its entities replaced by ``new`` (in the order of keys_of()), written as the match is."""
    first = F.get(new, F.lit(0))
    name = lambda x: F.split_part(x, F.lit("|"), F.lit(3))
    title = F.regexp_extract(value, r"^\S+ ", 0)
    people = F.concat(title, F.when(F.size(new) > 1, F.concat(name(F.get(new, F.lit(1))), F.lit(" "))).otherwise(""), name(first))
    digits = F.regexp_replace(first, r"^\+", "")
    return F.when(kind == "person", people).when(kind == "email", _in_case(first, value)).when(kind.isin("card", "phone"), _in_form(digits, value)).otherwise(first)


def _worth_a_look(text: Column) -> Column:
    """Whether a text can hold an entity at all: each kind needs a digit, an at sign, a quote or a title."""
    out = text.rlike("[0-9@\"]|[=:] ?'")
    for of in TITLES.values():
        for title in of:
            out = out | F.contains(text, F.lit(title))
    return F.coalesce(out, F.lit(False))


def _found(text: Column) -> Column:
    """All matches of a text, from one search; none for null."""
    return F.when(_worth_a_look(text), F.regexp_extract_all(text, F.lit(ANY), 0)).otherwise(F.array().cast("array<string>"))


def _parts(text: Column) -> Column:
    """A text cut into what stands before, in and after its matches, by turns, from one search that marks them.

    A text that has the mark itself, a code point that is never a character, is searched twice instead.
    """
    marked = F.split(F.regexp_replace(text, f"({ANY})", f"{MARK}$1{MARK}"), MARK, -1)
    pairs = F.zip_with(F.split(text, ANY, -1), F.concat(F.regexp_extract_all(text, F.lit(ANY), 0), F.array(F.lit(""))), lambda a, b: F.array(a, b))
    slow = F.flatten(pairs)
    return F.when(_worth_a_look(text), F.when(F.contains(text, F.lit(MARK)), F.slice(slow, F.lit(1), F.size(slow) - 1)).otherwise(marked))


def entities(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The distinct entities (kind, value) of a table's texts; matches are made distinct before the shuffle."""
    values = docs.select(F.explode(_found(F.col(text_col))).alias("value")).distinct()
    return values.select(F.explode(keys_of(kind_of(F.col("value")), F.col("value"))).alias("x")).select("x.*").distinct()


def draws(known: DataFrame, key: str) -> DataFrame:
    """Of entities (kind, value) the final ``attempt`` and ``surrogate``: all different within a kind, and none a value of the table.

    Where entities collide, the one that drew first keeps the surrogate (equal ones: the first in order of
    text); the others draw again, and so do those whose surrogate is a real value. Groups are as small as
    collisions are rare. Names grow with the attempt. In the last round part of a digest is added to all but
    names, which tells apart whoever still collides. The entities are written once; texts aren't read again.
    """
    known = stored(known.select("kind", "value"), "entities")
    now = known.withColumn("attempt", F.lit(0))
    for i in range(ROUNDS + 1):
        now = stored(now.withColumn("surrogate", surrogate(F.col("kind"), F.col("value"), key, F.col("attempt"))), "draws")
        ranked = now.groupBy("kind", "surrogate").agg(F.min(F.struct("attempt", "value")).alias("owner"), F.count("*").alias("n"))
        taken = ranked.where("n > 1").select("kind", "surrogate", F.col("owner.value").alias("owner"))
        real = known.select("kind", F.col("value").alias("surrogate")).withColumn("real", F.lit(True))
        lost = F.coalesce(F.col("real"), F.lit(False)) | F.coalesce(F.col("owner") != F.col("value"), F.lit(False))
        judged = now.join(taken, ["kind", "surrogate"], "left").join(real, ["kind", "surrogate"], "left").withColumn("lost", lost)
        judged = stored(judged.select("kind", "value", "attempt", "surrogate", "lost"), "collisions")
        forget(now)
        if i == ROUNDS or judged.where("lost").isEmpty():
            return judged.select("kind", "value", "attempt", "surrogate")
        now = judged.select("kind", "value", (F.col("attempt") + F.col("lost").cast("int")).alias("attempt"))
    raise AssertionError


def replace(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows with entities in ``text_col`` replaced, all columns as they were, and n_entities and kinds added.

    ``n_entities`` counts the places replaced, ``kinds`` lists their types, sorted and comma-joined. Texts
    without an entity, empty and null ones stay as they are (0, empty). Repeated rows are treated alike.
    Columns that are called n_entities or kinds already are replaced. First-draw surrogates are functions of
    key and entity alone, so the texts aren't shuffled for them; only entities that had to draw again
    are looked up.
    """
    return _apply(docs, key, draws(entities(docs, text_col), key).where("attempt > 0"), id_col, text_col)


def _apply(docs: DataFrame, key: str, again: DataFrame, id_col: str, text_col: str) -> DataFrame:
    names = [c for c in docs.columns if c not in ("n_entities", "kinds")]
    text = F.col("r").getField(text_col)
    rows = docs.select(F.struct(*names).alias("r")).withColumn("parts", _parts(text))
    label = lambda x: F.concat_ws("|", x["kind"], x["value"])
    if again.isEmpty():
        attempt = lambda x: F.lit(0)
    else:
        rows = rows.withColumns({"k": F.col("r").getField(id_col), "h": F.xxhash64(text)})
        values = F.array_distinct(F.filter("parts", lambda _, i: i % 2 == 1))
        sought = F.flatten(F.transform(values, lambda v: F.coalesce(keys_of(kind_of(v), v), F.array().cast("array<struct<kind:string,value:string>>"))))
        hits = rows.select("k", "h", F.explode(F.array_distinct(sought)).alias("x")).select("k", "h", "x.kind", "x.value").distinct().join(again.select("kind", "value", "attempt"), ["kind", "value"])
        entry = F.struct(label({"kind": F.col("kind"), "value": F.col("value")}).alias("label"), "attempt")
        redrawn = hits.groupBy("k", "h").agg(F.map_from_entries(F.collect_list(entry)).alias("attempts")).select(F.col("k").alias("k2"), F.col("h").alias("h2"), "attempts")
        rows = rows.join(redrawn, F.col("k").eqNullSafe(F.col("k2")) & (F.col("h") == F.col("h2")), "left")
        attempt = lambda x: F.coalesce(F.try_element_at("attempts", label(x)), F.lit(0))

    def drawn(value: Column) -> Column:
        """(kind, new) of a match; both null if it's nothing personal."""

        def of(kind: Column) -> Column:
            new = F.transform(keys_of(kind, value), lambda x: surrogate(x["kind"], x["value"], key, attempt(x)))
            return F.struct(kind.alias("kind"), _let(new, lambda n: written(kind, value, n)).alias("new"))

        return _let(kind_of(value), of)

    rows = rows.withColumn("found", F.transform("parts", lambda v, i: F.when(i % 2 == 1, drawn(v))))
    kinds = F.filter(F.coalesce("found.kind", F.array().cast("array<string>")), lambda x: x.isNotNull())
    rows = rows.withColumn("some", kinds)
    put = lambda old, x: F.when(x["kind"].isNotNull(), x["new"]).otherwise(old)
    new = F.when(F.size("some") > 0, F.array_join(F.zip_with("parts", "found", put), "")).otherwise(text)
    return rows.select(
        *(new.alias(c) if c == text_col else F.col("r").getField(c).alias(c) for c in names),
        F.size("some").cast("long").alias("n_entities"),
        F.array_join(F.array_sort(F.array_distinct("some")), ",").alias("kinds"),
    )

"""Surrogates for personal data, by DataFrame functions alone.

Mentions are found by one pattern. Each mention has a type and a canonical form
(the digits of a phone number, the lower-case address), so that all mentions of one
entity agree however they are written. A surrogate is drawn from a keyed hash of
the canonical form, letter for letter of the same script and case, digit for digit.
Surrogates that meet another surrogate or a real entity are drawn again, so
different entities stay different; the same entity has the same surrogate
everywhere. Only texts that hold a mention are ever shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronlens.llm.common import free_name
from patronlens.session import materialize

# Honorifics by the gender they tell, and given names by script and gender.
MALE_TITLES = ("Mr", "Herr", "Herrn", "Señor", "Monsieur", "Signor", "господин", "κύριος")
FEMALE_TITLES = ("Mrs", "Miss", "Ms", "Frau", "Señora", "Señorita", "Madame", "Mademoiselle", "Signora", "госпожа", "κυρία")
GIVEN = {
    ("latin", "m"): ("Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Hugo", "Ivan", "Jonas", "Leo", "Martin", "Nico", "Oscar", "Paul", "Robert", "Simon"),
    ("latin", "f"): ("Anna", "Berta", "Clara", "Diana", "Elena", "Flora", "Greta", "Helena", "Irene", "Julia", "Laura", "Maria", "Nora", "Olivia", "Rosa", "Sofia"),
    ("cyrillic", "m"): ("Антон", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Иван", "Павел"),
    ("cyrillic", "f"): ("Анна", "Вера", "Галина", "Дарья", "Елена", "Ирина", "Мария", "Ольга"),
    ("greek", "m"): ("Αλέξης", "Γιώργος", "Δήμος", "Κώστας", "Λεωνίδας", "Μάρκος", "Νίκος", "Πέτρος"),
    ("greek", "f"): ("Άννα", "Δάφνη", "Ελένη", "Ζωή", "Ιωάννα", "Κατερίνα", "Μαρία", "Σοφία"),
}
ALPHABETS = {"latin": "abcdefghijklmnopqrstuvwxyz", "cyrillic": "абвгдежзиклмнопрстуфхцчшэюя", "greek": "αβγδεζηθικλμνξοπρστυφχψω"}
#: Letters of scripts without capitals; those of any other script become Latin.
CASELESS = {
    r"\p{IsHan}": "安白成大方高国海和江金林明平青山石天文新",
    r"\p{IsArabic}": "ابتجحدرزسشصطعفقكلمنهوي",
    r"\p{IsHebrew}": "אבגדהוזחטיכלמנסעפצקרשת",
    r"\p{IsHangul}": "가나다라마바사아자차카타파하",
    r"\p{IsDevanagari}": "कखगघचछजझटठडढतथदधनपफबभमयरलवसह",
}
SCRIPTS = {"latin": r"\p{IsLatin}", "cyrillic": r"\p{IsCyrillic}", "greek": r"\p{IsGreek}"}

# Calling codes of one and two digits (all others have three), and ranges of private addresses.
CALLING_CODE = r"^\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"
PRIVATE = r"^(?:10|127|169\.254|172\.(?:1[6-9]|2\d|3[01])|192\.168)\."

_TITLE = "(?:" + "|".join(sorted(MALE_TITLES + FEMALE_TITLES, key=len, reverse=True)) + ")"
_WORD = r"\p{Lu}\p{Ll}++"
#: National numbers of 9 to 11 digits that begin with 0, parted by one kind of sign.
_NATIONAL = "|".join(
    rf"(?<![\p{{N}}.+\-])0(?=(?:{sep}?\d){{8,10}}(?!{sep}?\d))\d{{1,4}}(?:{sep}\d{{2,7}}){{1,4}}(?!\d)" for sep in (" ", "[.]", "-")
)
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
#: One alternative per type, tried in this order.
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+\-])[\p{L}\p{N}._%+\-]++@[\p{L}\p{N}\-]++(?:\.[\p{L}\p{N}\-]++)+",
    "ip": rf"(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\d|\.\d)",
    "iban": r"(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    "phone": r"(?<![\p{N}+])\+\d{1,3}(?:[ .\-]?(?:\(\d{1,4}\)|\d{2,4})){2,5}(?!\d)|(?<!\d)(?:\(\d{3}\) ?|\d{3}[ .\-])\d{3}[ .\-]\d{4}(?!\d)|"
    + _NATIONAL,
    "ssn": r"(?<!\d)\d{3}-\d{2}-\d{4}(?!\d)",
    "card": r"(?<!\d)(?:\d{13,19}|\d{4}(?:[ \-]\d{4}){3})(?!\d)",
    "name": rf"(?<!\p{{L}}){_TITLE}\.? {_WORD}(?: {_WORD})?",
}
MENTION = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: A text that holds a mention holds this; it is cheap to look for.
HINT = rf"[0-9@]|{_TITLE}\.? \p{{Lu}}"
#: After so many collisions in a row a surrogate grows by one sign a time, for formats that hold few values.
TIGHT = 3


def holds_mention(text: str | Column) -> Column:
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(text.rlike(HINT) & text.rlike(MENTION), F.lit(False))


def mentions(text: str | Column) -> Column:
    """All mentions of a text, in order."""
    return F.regexp_extract_all(text, F.lit(MENTION), F.lit(0))


def mention_type(mention: Column) -> Column:
    kinds = list(PATTERNS)
    out = F.lit(kinds[-1])
    for kind in reversed(kinds[:-1]):
        out = F.when(mention.rlike(f"^(?:{PATTERNS[kind]})$"), kind).otherwise(out)
    return out


def canonical(kind: Column, mention: Column) -> Column:
    """What all mentions of one entity share: ``+`` and digits, an address in lower case, gender and name."""
    name = F.regexp_replace(mention, rf"^{_TITLE}\.? ", "")
    title = F.regexp_extract(mention, rf"^({_TITLE})", 1)
    gender = F.when(title.isin(*MALE_TITLES), "m").otherwise("f")
    return (
        F.when(kind == "email", F.lower(mention))
        .when(kind == "name", F.concat(gender, F.lit(":"), name))
        .when(kind == "iban", F.regexp_replace(mention, " ", ""))
        .when(kind == "ip", mention)
        .otherwise(F.regexp_replace(mention, r"[^0-9+]", ""))
    )


def _draw(hashes: Column, place: Column | int, size: Column | int) -> Column:
    """A number below ``size`` from the four digits of the hash that belong to ``place``."""
    at = F.lit(place) if isinstance(place, int) else place
    digits = F.substr(hashes, at % 32 * 4 + 1, F.lit(4))
    return F.pmod(F.conv(digits, 16, 10).cast("int") + F.floor(at / 32).cast("int"), F.lit(size) if isinstance(size, int) else size)


def _like(text: Column, hashes: Column) -> Column:
    """``text`` with each letter and digit redrawn within its script and case, Latin for rarer scripts; other signs stay."""

    def redraw(sign: Column, place: Column) -> Column:
        out = F.when(sign.rlike(r"^[0-9]$"), _draw(hashes, place, 10).cast("string"))
        for script, letters in ALPHABETS.items():
            drawn = F.substr(F.lit(letters), _draw(hashes, place, len(letters)) + 1, F.lit(1))
            out = out.when(sign.rlike(rf"^(?=\p{{Lu}}){SCRIPTS[script]}$"), F.upper(drawn))
            out = out.when(sign.rlike(rf"^(?=\p{{L}}){SCRIPTS[script]}$"), drawn)
        for script, letters in CASELESS.items():
            drawn = F.substr(F.lit(letters), _draw(hashes, place, len(letters)) + 1, F.lit(1))
            out = out.when(sign.rlike(rf"^(?=\p{{L}}){script}$"), drawn)
        drawn = F.substr(F.lit(ALPHABETS["latin"]), _draw(hashes, place, 26) + 1, F.lit(1))
        out = out.when(sign.rlike(r"^\p{Lu}$"), F.upper(drawn)).when(sign.rlike(r"^\p{L}$"), drawn)
        return out.when(sign.rlike(r"^\p{N}$"), _draw(hashes, place, 10).cast("string")).otherwise(sign)

    return F.array_join(F.transform(F.split(text, ""), redraw), "")


def _luhn(number: Column) -> Column:
    return F.call_function("luhn_check", number)


def mod97(text: Column) -> Column:
    """Remainder of an account number by 97, letters read as 10 to 35."""

    def step(rest: Column, sign: Column) -> Column:
        digit = sign.rlike("^[0-9]$")
        value = F.ascii(sign) - F.when(digit, 48).otherwise(55)
        return (rest * F.when(digit, 10).otherwise(100) + value) % 97

    return F.aggregate(F.split(text, ""), F.lit(0), step)


def _account(entity: Column, like: Column) -> Column:
    """``like`` with the country of ``entity``, and with check digits that are right if those of ``entity`` are."""
    country, rest = F.substring(entity, 1, 2), F.substr(like, F.lit(5))
    right = F.lpad((F.lit(98) - mod97(F.concat(rest, country, F.lit("00")))).cast("string"), 2, "0")
    was_right = mod97(F.concat(F.substr(entity, F.lit(5)), F.substring(entity, 1, 4))) == 1
    return F.concat(country, F.when(was_right, right).otherwise(F.substr(like, F.lit(3), F.lit(2))), rest)


def _address(entity: Column, hashes: Column) -> Column:
    """Four new numbers, but for those that make an address a private one."""
    octets = F.array(*[(_draw(hashes, i, 223 if i == 0 else 254) + 1).cast("string") for i in range(4)])
    range_ = F.regexp_extract(entity, PRIVATE, 0)
    kept = F.length(range_) - F.length(F.replace(range_, F.lit("."), F.lit("")))
    return F.concat(range_, F.array_join(F.slice(octets, kept + 1, 4 - kept), "."))


def surrogate(kind: Column, entity: Column, key: str, attempt: Column) -> Column:
    """Canonical form of the replacement of a canonical ``entity``."""
    hashes = F.sha2(F.concat_ws("\x1f", F.lit(key), kind, entity, attempt.cast("string")), 512)
    like = _like(entity, hashes)
    # An address keeps its last label, an account its country, an international number its calling code.
    ending = F.substring_index(entity, ".", -1)
    email = F.concat(_like(F.regexp_replace(entity, r"[^.]+$", ""), hashes), ending)
    stem = F.concat(F.substring(entity, 1, 1), F.substr(like, F.lit(2), F.length(like) - 2))
    valid = F.filter(F.transform(F.sequence(F.lit(0), F.lit(9)), lambda d: F.concat(stem, d.cast("string"))), _luhn)
    card = F.when(_luhn(entity), F.element_at(valid, 1)).otherwise(F.concat(stem, F.substr(like, F.length(like), F.lit(1))))
    code = F.regexp_extract(entity, CALLING_CODE, 0)
    code = F.when(code == "", F.substring(entity, 1, 2)).otherwise(code)
    plus = F.concat(code, F.substr(like, F.length(code) + 1))
    out = (
        F.when(kind == "email", email)
        .when(kind == "ip", _address(entity, hashes))
        .when(kind == "card", card)
        .when(kind == "iban", _account(entity, like))
        .when(kind == "name", _person(entity, hashes))
        .when(entity.startswith("+"), plus)
        .otherwise(like)
    )
    more = F.greatest(attempt - TIGHT, F.lit(0))
    digits = F.translate(F.substr(hashes, F.lit(1), more), "abcdef", "012345")
    # An address grows at its front, so that its ending stays one.
    return F.when(kind == "email", F.concat(digits, out)).when(kind == "ip", out).otherwise(F.concat(out, digits))


def _person(entity: Column, hashes: Column) -> Column:
    """``gender:Name`` or ``gender:Given Name`` with a given name of the gender and script, and a new surname."""
    gender, name = F.substring(entity, 1, 1), F.substr(entity, F.lit(3))
    words = F.split(name, " ")
    given = F.lit(None).cast("string")
    for (script, of), names in GIVEN.items():
        listed = F.array(*map(F.lit, names))
        here = name.rlike(SCRIPTS[script]) & (gender == of)
        given = F.when(here, F.element_at(listed, _draw(hashes, 31, len(names)) + 1)).otherwise(given)
    surname = _like(F.element_at(words, -1), hashes)
    whole = F.when(F.size(words) > 1, F.concat_ws(" ", F.coalesce(given, _like(words[0], hashes)), surname)).otherwise(surname)
    return F.concat(gender, F.lit(":"), whole)


def render(kind: Column, mention: Column, replacement: Column) -> Column:
    """The canonical ``replacement`` written as ``mention`` was: its title, separators and capitals."""
    signs = F.regexp_replace(replacement, r"\+", "")
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))

    def step(state: Column, sign: Column) -> Column:
        fits = sign.rlike(r"^[A-Z0-9]$")
        return F.struct(
            F.concat(state["out"], F.when(fits, F.substr(signs, state["at"], F.lit(1))).otherwise(sign)).alias("out"),
            F.when(fits, state["at"] + 1).otherwise(state["at"]).alias("at"),
        )

    written = F.aggregate(F.split(mention, ""), start, step, lambda s: F.concat(s["out"], F.substr(signs, s["at"])))
    title = F.regexp_extract(mention, rf"^({_TITLE}\.? )", 1)
    return (
        F.when((kind == "email") & (mention == F.upper(mention)), F.upper(replacement))
        .when(kind.isin("email", "ip"), replacement)
        .when(kind == "name", F.concat(title, F.substr(replacement, F.lit(3))))
        .otherwise(written)
    )


def entity_surrogates(entities: DataFrame, key: str) -> DataFrame:
    """(kind, entity, surrogate) of distinct (kind, entity): no surrogate occurs twice or equals an entity.

    Entities whose surrogate is taken, by an entity of an earlier round or by a
    smaller one of this round, are drawn again with the next attempt.
    """
    rest, done, attempt = entities.select("kind", "entity"), None, 0
    while True:
        drawn = rest.withColumn("surrogate", surrogate(F.col("kind"), F.col("entity"), key, F.lit(attempt)))
        drawn = materialize(drawn)
        real = entities.select("kind", F.col("entity").alias("surrogate"))
        taken = real if done is None else real.unionByName(done.select("kind", "surrogate"))
        free = drawn.join(taken, ["kind", "surrogate"], "left_anti")
        first = free.groupBy("kind", "surrogate").agg(F.min("entity").alias("entity"))
        won = materialize(first.select("kind", "entity", "surrogate"))
        done = won if done is None else done.unionByName(won)
        rest = materialize(drawn.join(won, ["kind", "entity"], "left_anti").select("kind", "entity"))
        if rest.isEmpty():
            return done
        attempt += 1


def replace_personal_data(
    docs: DataFrame, key: str, text_col: str = "text", count_col: str | None = None
) -> DataFrame:
    """``docs`` with every mention in ``text_col`` replaced; ``count_col`` adds the number of mentions.

    Rows without a mention, null and empty texts included, come out as they are.
    Repeated rows and copies of a text get the same replacements.
    """
    text = F.col(text_col)
    found = materialize(
        docs.filter(holds_mention(text))
        .select(F.sha2(text, 256).alias("_key"), F.array_distinct(mentions(text)).alias("_all"))
        .dropDuplicates(["_key"])
    )
    each = found.select("_key", F.explode("_all").alias("mention"))
    known = each.select("mention").distinct().withColumn("kind", mention_type(F.col("mention")))
    known = materialize(known.withColumn("entity", canonical(F.col("kind"), F.col("mention"))))
    chosen = entity_surrogates(known.select("kind", "entity").distinct(), key)
    written = known.join(chosen, ["kind", "entity"]).select(
        "mention", render(F.col("kind"), F.col("mention"), F.col("surrogate")).alias("_new")
    )
    # The mentions of one text: no group is larger than a row.
    by_text = each.join(written, "mention").groupBy("_key").agg(
        F.map_from_entries(F.collect_list(F.struct("mention", "_new"))).alias("_map")
    )
    by_text = materialize(by_text)

    count = [F.lit(0).alias(count_col)] if count_col else []
    others = [c for c in docs.columns if c != count_col]
    plain = docs.filter(~holds_mention(text)).select(*others, *count)
    id_key, id_map = free_name(docs, "_key"), free_name(docs, "_map")
    bearing = docs.filter(holds_mention(text)).withColumn(id_key, F.sha2(text, 256))
    joined = bearing.join(by_text.toDF(id_key, id_map), id_key)
    between, inside = F.split(text, MENTION, -1), mentions(text)
    new = F.transform(inside, lambda m: F.element_at(F.col(id_map), m))
    woven = F.array_join(F.zip_with(between, new, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    count = [F.size(inside).alias(count_col)] if count_col else []
    return plain.unionByName(joined.select(*[woven.alias(c) if c == text_col else F.col(c) for c in others], *count))


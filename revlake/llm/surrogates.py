"""Personal data replaced by keyed surrogates, with DataFrame functions only.

Found are e-mail addresses, IPv4 and IPv6 addresses, phone numbers, payment card and account numbers (13 to 19 digits), IBANs,
social security numbers, secrets (values of tokens and keys, also in JSON or after ``Bearer``, long hexadecimal strings), names
after one or more honorifics, and bare mentions of their words later in the same document.
Every entity has a canonical form (digits of a number, lower-case address, a word of a name), and its surrogate is drawn
from a keyed digest of kind, canonical form and attempt: digits for digits, letters of the same script and case, an
address for an address, a card number that passes the check digit exactly if the original does, name words that end as
the honorific's gender asks. The written form (separators, case, country code, top-level domain) stays, so different
spellings of one entity keep naming one person. A given name that a document has with and without a gender has the gendered
surrogate throughout it. A possessive ending stays behind its name.

Distinctness: all entities of the corpus are one table of distinct rows. A surrogate that another entity already has, or
that is itself an entity of the corpus, is drawn again with the next attempt until none clashes. Almost all entities need
attempt 0, which every document computes for itself; only the others are joined to the texts they occur in.

A null text stays null and an empty one empty, with no entities. Repeated rows get equal texts. Columns of *docs* other
than ``text`` pass through unchanged, whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlake.functions.text import let
from revlake.llm.shared import written

# Honorifics that announce a name: fixed values.
MALE = ("Mr", "Herr", "Herrn", "Monsieur", "Señor", "Sr", "г-н", "Господин")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "г-жа", "Госпожа")
NEUTRAL = ("Dr", "Prof")
#: Capitalized words that follow an honorific's spelling without being a name: fixed values.
NO_NAMES = ("Developer", "Engineer", "Manager", "Director", "Analyst", "Consultant", "Architect", "Universe", "World", "America")

# Letters that stand for letters of the same script and case.
ALPHABETS = (
    "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "àáâäãåçèéêëìíîïñòóôöõøùúûüýß",
    "ÀÁÂÄÃÅÇÈÉÊËÌÍÎÏÑÒÓÔÖÕØÙÚÛÜÝ", "абвгдежзийклмнопрстуфхцчшщъыьэюяё", "АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯЁ",
    "αβγδεζηθικλμνξοπρστυφχψω", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ",
)
#: Consonants, vowels, and endings of male, female and family names, by script.
SYLLABLES = {
    "latin": ("bdfgklmnprstvz", "aeiou", ("on", "er", "as", "in"), ("ia", "ela", "ina", "a"), ("son", "mann", "ard", "ez")),
    "cyrillic": ("бвгдзклмнпрст", "аеиоу", ("ан", "ор", "ил", "ей"), ("ина", "ия", "ена", "а"), ("ов", "ин", "енко", "ский")),
}

_OUT = r"(?<![\p{L}\p{N}])"
_END = r"(?![\p{L}\p{N}])"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_KEYS = "(?i:token|secret|password|passwd|pwd|api_key|apikey)"
# What may stand between a key word and its value; look-behind needs a bounded length.
_IS = "[\"']? ?[=:] ?[\"']?"
_TITLES = "|".join((*MALE, *FEMALE, *NEUTRAL))
_UPPER_TITLES = "|".join(t.upper() for t in (*MALE, *FEMALE, *NEUTRAL) if t.isascii() and len(t) > 1)
#: Two letters at least; an apostrophe may stand between letters, but not that of a possessive.
_NAME = r"\p{Lu}(?=[\p{L}'’])\p{L}*+(?:['’](?![sS](?!\p{L}))\p{L}++)*+(?<!^\p{Lu}|[^\p{L}'’]\p{Lu})"
_HONORIFICS = r"(?:(?:" + _TITLES + "|" + _UPPER_TITLES + r")\.? )+"
# An entity begins where no letter or digit stands before it, which settles most positions at once.
PATTERN = _OUT + "(?:" + "|".join((
    r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)*\.\p{L}{2,}+",
    r"[0-9a-fA-F]{32,}+" + _END,
    r"(?:AKIA[0-9A-Z]{16}|(?:sk|ghp|pat)[-_][A-Za-z0-9]{16,}+)" + _END,
    # Eight characters at least; dots join the parts of a value but do not end it.
    # Shorter ones and ones with punctuation: with a digit, and without white space, quotes, or marks that end a clause.
    r"(?<=[\"'=: ])(?<=(?:" + _KEYS + r")" + _IS + r")(?:(?=[A-Za-z0-9_+/.-]{7}[A-Za-z0-9_+/-])[A-Za-z0-9_+/-]++(?:\.++[A-Za-z0-9_+/-]++)*+(?![!#$%&*@^])"
    r"|(?=[^\s\"',;<>]{0,64}\d)[^\s\"',;<>(){}]{3,}+(?<![.:?]))",
    r"(?<=\b[Bb]earer )[A-Za-z0-9._~+/-]{8,}+=*+",
    r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?" + _END,
    r"(?<![\p{L}\p{N}.]|(?i:version|release|build) )(?:" + _OCTET + r"\.){3}" + _OCTET + r"(?![\p{L}\p{N}]|\.\d)",
    r"(?<![\p{L}\p{N}:])(?:(?:[0-9a-fA-F]{1,4}:){7}[0-9a-fA-F]{1,4}|(?=[0-9a-fA-F:]{0,36}[0-9a-fA-F]{3})(?:[0-9a-fA-F]{1,4}:){2,6}(?::[0-9a-fA-F]{1,4}){1,5})(?![\p{L}\p{N}:])",
    r"\d{3}-\d{2}-\d{4}" + _END,
    r"(?<![\p{L}\p{N}+])\+\d{1,3}[ .-]?(?:\(\d{2,4}\)|\d{2,4})(?:[ .-]?\d{2,4}){2,4}" + _END,
    r"(?<![\p{L}\p{N}])\(\d{3}\) ?\d{3}[ .-]\d{4}" + _END,
    r"\d{3}[.-]\d{3}[.-]\d{4}" + _END,
    r"\d(?:[ -]?\d){12,18}" + _END,
    _HONORIFICS + "(?!(?:" + "|".join(NO_NAMES) + r")(?!\p{L}))" + _NAME + "(?:[ -]" + _NAME + "){0,2}",
)) + ")"
#: A text without these has no entity; most texts end here.
_SUSPECT = r"[0-9@]|" + _KEYS + r"[\"']? ?[=:]|[Bb]earer |(?:" + _TITLES + "|" + _UPPER_TITLES + r")\.? \p{Lu}"


def entities(text: Column) -> Column:
    """Entities of a text, in order."""
    return F.when(text.rlike(_SUSPECT), F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))).otherwise(F.array().cast("array<string>"))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def kind_of(entity: Column) -> Column:
    return (
        F.when(entity.contains("@"), "email")
        .when(entity.rlike("^" + _HONORIFICS), "name")
        .when(entity.rlike(r"^\d+(?:\.\d+){3}$"), "ip")
        .when(entity.rlike(r"^[0-9a-fA-F]{1,4}(?::[0-9a-fA-F]{0,4}){3,7}$"), "ip6")
        .when(entity.rlike(r"^\d{3}-\d{2}-\d{4}$"), "ssn")
        .when(entity.rlike(r"^\+[0-9 .()-]+$|^\(|^\d{3}[.-]\d{3}[.-]\d{4}$"), "phone")
        .when(entity.rlike(r"^\d(?:[ -]?\d){12,18}$"), "card")
        .when(entity.rlike(r"^[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?$"), "iban")
        .otherwise("secret"))


def _name_kinds(entity: Column) -> Column:
    """Kind of the given names after honorifics: that of the first one with a gender."""
    def of(titles: tuple[str, ...]) -> str:
        return r"(?i)^(?:(?:" + "|".join(NEUTRAL) + r")\.? )*(?:" + "|".join(titles) + r")\.? "
    return F.when(entity.rlike(of(MALE)), "male").when(entity.rlike(of(FEMALE)), "female").otherwise("neutral")


def _titles(entity: Column) -> Column:
    return F.regexp_extract(entity, "^" + _HONORIFICS, 0)


def _name_words(entity: Column) -> Column:
    return F.split(F.regexp_replace(entity, "^" + _HONORIFICS, ""), "[ -]")


def units(entity: Column, found: Column | None = None) -> Column:
    """What has a surrogate of its own: (kind, canonical form); for a name every word after the honorifics.

    A given name whose own honorifics say no gender has that of the first mention among the entities *found* that does.
    """
    kind, words = kind_of(entity), _name_words(entity)
    given = _name_kinds(entity)
    if found is not None:
        first_word = F.lower(F.get(words, 0))
        same = F.filter(found, lambda e: (kind_of(e) == "name") & (_name_kinds(e) != "neutral") & (F.size(_name_words(e)) > 1)
                        & (F.lower(F.get(_name_words(e), 0)) == first_word))
        given = F.when((kind == "name") & (given == "neutral"), F.coalesce(_name_kinds(F.get(same, 0)), given)).otherwise(given)
    canonical = (
        F.when(kind.isin("email", "ip6"), F.lower(entity)).when(kind.isin("phone", "card", "ssn"), _digits(entity))
        .when(kind == "iban", F.replace(entity, F.lit(" "), F.lit(""))).otherwise(entity))
    return F.when(kind == "name", F.transform(words, lambda w, i: F.struct(
        F.when(i == F.size(words) - 1, "family").otherwise(given).alias("kind"), F.lower(w).alias("form")))
    ).otherwise(F.array(F.struct(kind.alias("kind"), canonical.alias("form"))))


def _noise(key: str, unit: Column, attempt: Column) -> Column:
    """256 hexadecimal digits of the keyed digest."""
    seed = F.concat_ws("\x1f", F.lit(key), unit["kind"], unit["form"], attempt.cast("string"))
    return F.concat(F.sha2(F.concat(F.lit(key), F.sha2(seed, 512)), 512), F.sha2(F.concat(F.lit(key), F.sha2(seed, 384)), 512))


def _byte(noise: Column, at: Column) -> Column:
    return F.conv(F.substr(noise, F.lit(1) + (at % 128) * 2, F.lit(2)), 16, 10).cast("int")


def _pick(letters: str, byte: Column) -> Column:
    return F.substr(F.lit(letters), byte % len(letters) + 1, F.lit(1))


def _spell(text: Column, letter) -> Column:
    """Letters of *text* (not empty) replaced by letter(letter, position from 0)."""
    return F.array_join(F.transform(F.split(text, ""), letter), "")


def _same_alphabet(char: Column, byte: Column) -> Column:
    return reduce(lambda rest, a: F.when(F.instr(F.lit(a), char) > 0, _pick(a, byte)).otherwise(rest),
                  reversed(ALPHABETS), F.when(char.rlike(r"\p{L}"), F.lit("x")).otherwise(char))


def _luhn_sum(digits: Column, shift: int) -> Column:
    """Weighted digit sum; with shift 1 a further digit is going to follow."""
    n = F.length(digits)
    def value(i: Column) -> Column:
        digit = F.substr(digits, i + 1, F.lit(1)).cast("int")
        double = digit * 2
        return F.when((n - 1 - i + shift) % 2 == 1, F.when(double > 9, double - 9).otherwise(double)).otherwise(digit)
    return F.aggregate(F.transform(F.sequence(F.lit(0), n - 1), value), F.lit(0), lambda s, v: s + v)


def surrogate(key: str, unit: Column, attempt: Column) -> Column:
    """Canonical form of the surrogate of a unit (kind, form)."""
    return let(F.struct(unit.alias("unit"), attempt.alias("attempt"), _noise(key, unit, attempt).alias("noise")), lambda bound: _drawn(
        bound["unit"], bound["attempt"], bound["noise"]))


def _drawn(unit: Column, attempt: Column, noise: Column) -> Column:
    kind, form = unit["kind"], unit["form"]
    later = F.when(attempt > 7, attempt.cast("string")).otherwise("")
    charwise = F.concat(later, _spell(form, lambda c, i: _same_alphabet(c, _byte(noise, i))))
    top = F.length(form) - F.length(F.substring_index(form, ".", -1))  # the top-level domain stays
    email = F.concat(later, _spell(form, lambda c, i: F.when(i >= top, c).otherwise(_same_alphabet(c, _byte(noise, i)))))
    hexadecimal = _spell(form, lambda c, i: F.when(F.instr(F.lit("abcdef"), c) > 0, _pick("abcdef", _byte(noise, i)))
                         .when(F.instr(F.lit("ABCDEF"), c) > 0, _pick("ABCDEF", _byte(noise, i))).otherwise(_pick("0123456789", _byte(noise, i))))
    digits = _spell(form, lambda c, i: F.when(i == 0, c).otherwise(_pick("0123456789", _byte(noise, i))))
    ssn = _spell(form, lambda c, i: _pick("0123456789", _byte(noise, i)))
    body = F.substr(digits, F.lit(1), F.length(form) - 1)
    card = F.when(_luhn_sum(form, 0) % 10 == 0, F.concat(body, ((10 - _luhn_sum(body, 1) % 10) % 10).cast("string"))).otherwise(digits)
    ip = F.concat_ws(".", *[(_byte(noise, F.lit(i)) % 254 + 1).cast("string") for i in range(4)])
    ip6 = _spell(form, lambda c, i: F.when(c == ":", c).otherwise(_pick("0123456789abcdef", _byte(noise, i))))
    iban = _spell(form, lambda c, i: F.when(i < 2, c).otherwise(_same_alphabet(c, _byte(noise, i))))

    def name(script: str) -> Column:
        consonants, vowels, male, female, family = SYLLABLES[script]
        def ending(of: tuple[str, ...]) -> Column:
            return F.element_at(F.array(*map(F.lit, of)), _byte(noise, F.lit(40)) % len(of) + 1)
        count = 2 + _byte(noise, F.lit(41)) % 2 + attempt
        body = F.array_join(F.transform(F.sequence(F.lit(1), count), lambda i: F.concat(
            _pick(consonants, _byte(noise, i * 2)), _pick(vowels, _byte(noise, i * 2 + 1)))), "")
        return F.concat(body, F.lit("n" if script == "latin" else "н"), F.when(kind == "family", ending(family)).when(kind == "male", ending(male))
                        .when(kind == "female", ending(female)).otherwise(ending(male + female)))

    script = F.when(form.rlike(r"\p{IsCyrillic}"), name("cyrillic")).otherwise(name("latin"))
    return (
        F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "ip6", ip6).when(kind == "card", card).when(kind == "phone", digits)
        .when(kind == "ssn", ssn).when(kind == "iban", iban)
        .when((kind == "secret") & form.rlike("^[0-9a-fA-F]+$"), hexadecimal).when(kind == "secret", charwise)
        .otherwise(script))


def _attempts(found: DataFrame, key: str) -> DataFrame:
    """(kind, form, attempt) of the entities whose first surrogate clashes."""
    every = written(found.select("kind", "form").distinct(), "entities")
    unit = F.struct("kind", "form")
    drawn = every.withColumn("attempt", F.lit(0)).withColumn("made", surrogate(key, unit, F.col("attempt")))
    taken = every.select("kind", F.col("form").alias("made"))
    settled, attempt = None, 0
    while True:
        # Of the entities that drew the same surrogate, the first keeps it; none keeps one that is in use.
        first = drawn.groupBy("kind", "made").agg(F.min("form").alias("winner"))
        free = first.join(taken, ["kind", "made"], "left_anti")
        judged = drawn.join(free, ["kind", "made"], "left").withColumn("kept", F.coalesce(F.col("winner") == F.col("form"), F.lit(False)))
        judged = written(judged.select("kind", "form", "attempt", "made", "kept"), "surrogates")
        settled = judged.where("kept") if settled is None else settled.union(judged.where("kept"))
        lost = judged.where("not kept")
        if lost.isEmpty():
            return written(settled.where("attempt > 0").select("kind", "form", "attempt"), "attempts")
        attempt += 1
        taken = taken.union(judged.where("kept").select("kind", "made"))
        drawn = lost.select("kind", "form").withColumn("attempt", F.lit(attempt)).withColumn("made", surrogate(key, unit, F.col("attempt")))


def _written(entity: Column, kind: Column, made: Column) -> Column:
    """The surrogate in the written form of the entity."""
    words, title, first = _name_words(entity), _titles(entity), made[0]
    # Digits of a number go where its digits were; an address keeps its capitals.
    placed = _spell(entity, lambda c, i: F.when(
        c.rlike("[0-9]"), F.substr(first, F.length(_digits(F.substr(entity, F.lit(1), i + 1))), F.lit(1))).otherwise(c))
    spaced = _spell(entity, lambda c, i: F.when(c == " ", c).otherwise(
        F.substr(first, F.length(F.replace(F.substr(entity, F.lit(1), i + 1), F.lit(" "), F.lit(""))), F.lit(1))))
    joints = F.regexp_replace(F.substr(entity, F.length(title) + 1), r"[^ -]", "")
    named = F.concat(title, F.array_join(F.transform(words, lambda w, i: F.concat(
        F.when(i > 0, F.substr(joints, i, F.lit(1))).otherwise(""),
        F.when((F.length(w) > 1) & (w == F.upper(w)), F.upper(made[i])).otherwise(F.initcap(made[i])))), ""))
    cased = F.when(F.length(first) == F.length(entity), _spell(entity, lambda c, i: F.when(
        c == F.lower(c), F.substr(first, i + 1, F.lit(1))).otherwise(F.upper(F.substr(first, i + 1, F.lit(1)))))).otherwise(first)
    return (
        F.when(kind.isin("phone", "card", "ssn"), placed).when(kind == "iban", spaced).when(kind == "name", named)
        .when(kind == "email", cased).otherwise(first))


def _known(shown: Column) -> Column:
    """Words of the names among the entities as written: (word, its surrogate, number of the first entity with it), once each."""
    words = F.flatten(F.transform(shown, lambda s, i: F.when(s["kind"] == "name", F.transform(s["words"], lambda w, j: F.struct(
        w.alias("word"), s["made"][j].alias("made"), i.alias("first")))).otherwise(F.array())))
    return let(words, lambda all_: F.transform(F.array_distinct(all_["word"]), lambda w: F.get(all_, (F.array_position(all_["word"], w) - 1).cast("int"))))


def _mentions(gap: Column, number: Column, known: Column) -> Column:
    """The text before entity *number*, with the words of names that came earlier replaced where they stand alone."""
    def word(w: Column) -> Column:
        at = F.array_position(known["word"], F.lower(w))
        entry = F.get(known, (at - 1).cast("int"))
        made = F.when((F.length(w) > 1) & (w == F.upper(w)), F.upper(entry["made"])).otherwise(F.initcap(entry["made"]))
        return F.when((at > 0) & (entry["first"] < number), made).otherwise(w)

    pattern = _OUT + _NAME + _END
    parts = F.struct(F.split(gap, pattern, -1).alias("rest"), F.regexp_extract_all(gap, F.lit(pattern), F.lit(0)).alias("words"))
    return let(parts, lambda p: F.array_join(F.transform(p["rest"], lambda r, i: F.concat(
        r, F.coalesce(word(F.get(p["words"], i)), F.lit("")))), ""))


def pseudonymized(docs: DataFrame, key: str) -> DataFrame:
    """*docs* with surrogates in ``text``, followed by ``pii_entities``, the surrogates as written, in order.

    *key* decides all surrogates; keep it secret and use one key for all that shall stay linkable.
    """
    columns = docs.columns
    base = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.col("text").cast("string").alias("text"))
    units_of = F.flatten(F.transform("found", lambda e: units(e, F.col("found"))))
    with_found = base.where(F.col("text").rlike(_SUSPECT)).withColumn("found", entities(F.col("text"))).where(F.size("found") > 0)
    listed = with_found.select(F.explode(F.array_distinct(units_of)).alias("u"), F.sha2("text", 256).alias("id"))
    attempts = _attempts(listed.select("u.kind", "u.form"), key)
    again = None
    if not attempts.isEmpty():
        again = written(
            listed.select("u.kind", "u.form", "id").distinct().join(attempts, ["kind", "form"])
            .groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct(
                F.concat_ws("\x1f", "kind", "form"), F.col("attempt")))).alias("attempts")), "again")

    empty = F.create_map().cast("map<string,int>")
    rows = base.withColumn("found", entities(F.col("text")))
    if again is None:
        rows = rows.withColumn("attempts", empty)
    else:
        rows = rows.withColumn("id", F.when(F.size("found") > 0, F.sha2("text", 256))).join(again, "id", "left")

    def made(unit: Column) -> Column:
        attempt = F.coalesce(F.element_at("attempts", F.concat_ws("\x1f", unit["kind"], unit["form"])), F.lit(0))
        return surrogate(key, unit, attempt)

    def shown(entity: Column) -> Column:
        return let(F.struct(entity.alias("entity"), kind_of(entity).alias("kind"), F.transform(units(entity, F.col("found")), made).alias("made")),
                   lambda bound: F.struct(_written(bound["entity"], bound["kind"], bound["made"]).alias("text"), bound["kind"].alias("kind"),
                                          F.transform(_name_words(bound["entity"]), F.lower).alias("words"), bound["made"].alias("made")))

    rows = rows.withColumn("shown", F.when(F.size("found") > 0, F.transform("found", shown)))
    gaps = F.split("text", PATTERN, -1)
    names = F.filter("shown", lambda s: s["kind"] == "name")
    rows = rows.withColumn("known", F.when(F.size(names) > 0, _known(F.col("shown"))))
    text = F.when(F.size("found") == 0, F.col("text")).otherwise(F.array_join(F.transform(gaps, lambda g, i: F.concat(
        F.when(F.col("known").isNotNull(), _mentions(g, i, F.col("known"))).otherwise(g), F.coalesce(F.get("shown", i)["text"], F.lit("")))), ""))
    return rows.select(*[text.alias(c) if c == "text" else F.col("row").getField(c).alias(c) for c in columns],
                       F.coalesce(F.col("shown.text"), F.array().cast("array<string>")).alias("pii_entities"))

"""Surrogates for personal data, in SQL expressions only: keyed, type-consistent, distinct and the same everywhere.

Entities are found by one pattern of alternatives. Each has a normal form (case, punctuation and layout removed), and
its surrogate depends on the secret key, the type and the normal form alone, so that one entity is replaced alike in
all documents and layouts. Characters keep their kind and place: digits stay digits, letters keep case and script, IP
octets stay in range, phone numbers keep the country, card numbers their first digit and a valid check digit, names keep
the gender of their title. A name's entity is its surname: with or without given name or title it is replaced alike. A
name is found behind a title, and without one where the same document has it behind a title.

Distinctness is checked over the whole corpus: normal forms are reduced to distinct ones, grouped by surrogate, and
where several share one, or one equals an entity of the corpus in any case, all but the first are drawn again. Names,
mailboxes and secrets with other characters get more room with later draws. What is left of formats with few values
after that gets the free values in a keyed order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saleloom.operators.work import freeze

ATTEMPTS = 8  # draws for an entity whose surrogate is taken, before values of a small format are dealt
WIDEN = 2  # from this draw on, open formats get more room
SMALL = 4  # random characters up to which the values of a format are listed: 26^4 or 10^4 each
MAX_ATTEMPTS = 200  # more draws mean that a large format is full
BROADCAST_ROWS = 1_000_000  # corrected rows are broadcast up to so many

_MALE_TITLES = ("Mr", "Mister", "Sir", "Herrn", "Herr", "Monsieur", "Señor", "Sr", "господин")
_FEMALE_TITLES = ("Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Mme", "Mlle", "Señora", "Señorita", "Sra", "госпожа")
_MALE = f"(?:{'|'.join(_MALE_TITLES)})"
_FEMALE = f"(?:{'|'.join(_FEMALE_TITLES)})"
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
_IPV4 = rf"(?:{_OCTET}\.){{3}}{_OCTET}"
_HEX = r"[0-9A-Fa-f]{1,4}"
_PARTICLE = r"(?:van|von|der|den|del|della|des|de|di|da|dos|du|la|le|zu|bin|ibn|al|el)"
_WORD = r"\p{Lu}[\p{L}\p{M}'’-]+"
_BEFORE_WORD = rf"(?:\p{{Lu}}\.\s?|{_PARTICLE}\s){{0,4}}"
_NAME = rf"{_BEFORE_WORD}{_WORD}(?:\s{_BEFORE_WORD}{_WORD}){{0,2}}"
_LABELS = r"(?i:password|passwd|passphrase|pwd|token|secret(?:[_-]?key)?|(?:api|access|private)[_-]?key)[\"']?\s*+(?::=|=>|[=:])\s*+"
# An API key keeps this part.
_KEY_PREFIX = r"(?:AKIA|ASIA|AIza|gh[pousr]_|github_pat_|glpat-|npm_|xox[abeoprs]-|[spr]k_(?:live|test)_|sk-|eyJ)"

# Type -> pattern, in the order in which they are tried.
PATTERNS = {
    "key": r"(?:AKIA|ASIA)[0-9A-Z]{16}(?![0-9A-Za-z])|AIza[0-9A-Za-z_-]{35}(?![0-9A-Za-z_-])|gh[pousr]_[0-9A-Za-z]{20,}+"
           r"|(?:github_pat_|npm_|[spr]k_(?:live|test)_)[0-9A-Za-z_]{16,}+|(?:glpat-|xox[abeoprs]-)[0-9A-Za-z_-]{10,}+"
           r"|sk-(?=[A-Za-z_-]*[0-9])[0-9A-Za-z_-]{20,}+|eyJ[0-9A-Za-z_-]{8,}+(?:\.[0-9A-Za-z_-]++){1,4}",
    "secret": rf"{_LABELS}(?:\"(?=[^\"\n]*[\p{{L}}\p{{N}}])[^\"\n]{{6,}}+\"|'(?=[^'\n]*[\p{{L}}\p{{N}}])[^'\n]{{6,}}+'|\"?(?=[^\s\"]*[\p{{L}}\p{{N}}])[^\s\"]{{6,}}+\"?)",
    "email": r"[\p{L}\p{N}][\p{L}\p{M}\p{N}._%+'-]*+@(?:[\p{L}\p{M}\p{N}-]{1,63}\.){1,126}(?:xn--[A-Za-z0-9-]{1,59}|[\p{L}\p{M}]{2,63})(?![\p{L}\p{N}])",
    "ip": rf"(?<![0-9.]){_IPV4}(?![0-9]|\.[0-9])",
    "ip6": rf"(?=[0-9A-Fa-f:.]*[0-9]|(?:[A-Fa-f]{{1,4}}:){{2}})(?:(?:{_HEX}:){{6}}{_IPV4}|(?:(?:{_HEX}:){{1,5}}|:)(?::{_HEX}){{0,5}}:{_IPV4}"
           rf"|(?:{_HEX}:){{7}}{_HEX}|(?:{_HEX}:){{1,7}}(?::{_HEX}){{1,6}}|::{_HEX}(?::{_HEX}){{0,6}}|(?:{_HEX}:){{1,7}}:)(?![\p{{L}}\p{{N}}]|[:.][0-9A-Fa-f])",
    "iban": r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z_])",
    "card": r"(?<![0-9-])(?:[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}[ -][0-9]{1,7}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5}|[0-9]{13,19})(?![0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    # North America, international with + or 00, national: with 3+4 last digits, with trunk 0, unseparated.
    "phone": r"(?<![0-9])(?:\+1[ .-]?(?:\([0-9]{3}\)|[0-9]{3})[ .-]?[0-9]{3}[ .-]?[0-9]{4}|\+[1-9](?:[ ./-]?\(?[0-9]\)?){6,14}"
             r"|00[1-9][0-9]{0,2}[ ./-](?:\(?[0-9]\)?[ ./-]?){5,12}[0-9]|(?:\([0-9]{2,4}\)|[0-9]{2,4})[ .-]?[0-9]{3}[ .-][0-9]{4}"
             r"|(?<![.,])0[1-9](?:[ .-]?[0-9]{2}){4}|\(?0[1-9][0-9]{1,3}\)?[ -][0-9]{3,4}[ -][0-9]{3,4}|\(?0[1-9][0-9]{1,4}\)? ?[ /-] ?[0-9]{5,8}"
             r"|(?<![.,+-])1?[2-9][0-9]{2}[2-9][0-9]{6}(?![.,][0-9]))(?![0-9])",
    "male": rf"{_MALE}\.?\s{_NAME}",
    "female": rf"{_FEMALE}\.?\s{_NAME}",
}


def _any_of(*kinds: str) -> str:
    return "(?:" + "|".join(PATTERNS[kind] for kind in kinds) + ")"


# Cheap tests of the place and the first character come before the alternatives.
_START = r"(?<![\p{L}\p{M}\p{N}])"
_ANY = (rf"(?=[\p{{L}}\p{{N}}+(:])(?:{_START}(?:(?=[AEGNPRSTXaegnprstx]){_any_of('key', 'secret')}|{_any_of('email')})|(?=[0-9+(])(?:{_any_of('ip')}|(?<![\p{{L}}\p{{N}}:]){_any_of('ip6')}"
        rf"|{_any_of('card', 'ssn', 'phone')})|(?=[A-Fa-f:])(?<![\p{{L}}\p{{N}}:.]){_any_of('ip6')}|(?<![\p{{L}}\p{{N}}_]){_any_of('iban', 'male', 'female')})")
_TITLE = rf"^(?:{_MALE}|{_FEMALE})\.?\s"
_LABEL = rf"^{_LABELS}[\"']?"
_COUNTRY = r"^\+(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"

_LOWER, _CYRILLIC = "abcdefghijklmnopqrstuvwxyz", "абвгдежзиклмнопрстуфхцчшэюя"
_GIVEN = {
    ("latin", "male"): ["Adam", "Bruno", "Carl", "Dario", "Emil", "Felix", "Georg", "Hugo", "Ivan", "Jonas", "Karim", "Leon"],
    ("latin", "female"): ["Alma", "Berta", "Clara", "Dora", "Elena", "Frida", "Greta", "Helena", "Irma", "Julia", "Klara", "Lena"],
    ("cyrillic", "male"): ["Антон", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Захар", "Игорь", "Лев", "Марк", "Олег", "Павел"],
    ("cyrillic", "female"): ["Анна", "Белла", "Вера", "Галина", "Дарья", "Ева", "Зоя", "Инна", "Лидия", "Мария", "Ольга", "Полина"],
}
_SYLLABLES = {
    "latin": ["ba", "de", "fi", "go", "hu", "ka", "le", "mi", "no", "pu", "ra", "se", "ti", "vo", "wu", "za"],
    "cyrillic": ["ба", "де", "фи", "го", "ху", "ка", "ле", "ми", "но", "пу", "ра", "се", "ти", "во", "жу", "за"],
}


def may_hold_entities(text: Column) -> Column:
    """False only if no pattern can match: without a digit, @, ::, key prefix, label or title. Much cheaper than the patterns."""
    found = text.rlike("[0-9]")
    for mark in ("@", "::", "AKIA", "ASIA", "AIza", "gh", "glpat-", "npm_", "xox", "k_live_", "k_test_", "eyJ", *_MALE_TITLES, *_FEMALE_TITLES):
        found = found | F.contains(text, F.lit(mark))
    assigned = F.contains(text, F.lit("=")) | F.contains(text, F.lit(":"))
    return found | (assigned & text.rlike(rf"{_LABELS}|(?:[A-Fa-f]{{1,4}}:){{2}}"))


def known_names(text: Column) -> Column:
    """Untitled forms, as a pattern, of the names that the text has behind a title: whole names and surnames. Else null."""
    titled = F.regexp_extract_all(text, F.lit(rf"(?<![\p{{L}}\p{{N}}_]){_any_of('male', 'female')}"), F.lit(0))
    whole = F.filter(F.transform(titled, lambda m: F.regexp_replace(m, _TITLE, "")), lambda n: ~n.rlike(r"[\r\n]"))
    forms = F.flatten(F.transform(whole, lambda n: F.array(n, F.regexp_extract(n, r"(\S+)$", 1))))
    forms = F.array_distinct(F.flatten(F.transform(forms, lambda n: F.array(n, F.upper(n), F.initcap(n)))))
    longest = F.array_sort(F.transform(forms, lambda n: F.struct((-F.length(n)).alias("n"), n.alias("form"))))
    has_title = F.lit(False)
    for mark in (*_MALE_TITLES, *_FEMALE_TITLES):
        has_title = has_title | F.contains(text, F.lit(mark))
    literal = F.transform(longest, lambda n: F.concat(F.lit(r"\Q"), n["form"], F.lit(r"\E")))
    pattern = F.concat(F.lit(r"(?<![\p{L}\p{M}\p{N}_'’-])(?:"), F.array_join(literal, "|"), F.lit(r")(?![\p{L}\p{M}\p{N}_-])"))
    return F.when(has_title & (F.size(titled) > 0) & (F.size(forms) > 0), pattern)


def kind_of(entity: Column) -> Column:
    """Type of a found entity: the first pattern that matches it whole. Digits without a check digit are no card."""
    found = F.lit(None).cast("string")
    for kind, pattern in reversed(PATTERNS.items()):
        matches = entity.rlike(f"^(?:{pattern})$")
        if kind == "card":
            matches = matches & (entity.rlike("[ -]") | F.call_function("luhn_check", entity))
        found = F.when(matches, kind).otherwise(found)
    return found


def with_untitled(found: Column) -> Column:
    """array<struct<entity,kind>> with the kind of untitled names, taken from the titled mention of the surname."""
    def surname(entity: Column) -> Column:
        return F.lower(F.regexp_extract(entity, r"(\S+)$", 1))

    titled = F.filter(found, lambda e: e["kind"].isin("male", "female"))
    men = F.transform(F.filter(titled, lambda e: e["kind"] == "male"), lambda e: surname(e["entity"]))
    women = F.transform(F.filter(titled, lambda e: e["kind"] == "female"), lambda e: surname(e["entity"]))

    def one(e: Column) -> Column:
        name = surname(e["entity"])
        kind = F.when(e["kind"].isNotNull(), e["kind"]).when(F.array_contains(men, name), "male").when(F.array_contains(women, name), "female")
        return F.struct(e["entity"].alias("entity"), kind.alias("kind"))

    return F.when(F.size(titled) > 0, F.transform(found, one)).otherwise(found)


def _expanded(address: Column) -> Column:
    """The 32 hexadecimal digits of an IPv6 address."""
    last = F.substring_index(address, ":", -1)
    bytes_ = F.transform(F.split(last, r"\."), lambda x: F.lpad(F.hex(x.cast("int")), 2, "0"))
    pair = F.concat(F.array_join(F.slice(bytes_, 1, 2), ""), F.lit(":"), F.array_join(F.slice(bytes_, 3, 2), ""))
    address = F.when(F.contains(address, F.lit(".")), F.concat(F.substring(address, F.lit(1), F.length(address) - F.length(last)), pair)).otherwise(address)

    def groups(part: Column) -> Column:
        return F.filter(F.split(part, ":"), lambda g: g != "")

    left, right = groups(F.substring_index(address, "::", 1)), groups(F.substring_index(address, "::", -1))
    zeros = F.array_repeat(F.lit("0"), F.greatest(8 - F.size(left) - F.size(right), F.lit(0)))
    all_ = F.when(F.contains(address, F.lit("::")), F.concat(left, zeros, right)).otherwise(left)
    return F.lower(F.array_join(F.transform(all_, lambda g: F.lpad(g, 4, "0")), ""))


def normal_of(kind: Column, entity: Column) -> Column:
    """What makes two mentions the same entity. Card numbers: their digits. Names: the surname without case.

    International phone numbers start with +; North American ones are the same with and without +1.
    """
    digits = F.regexp_replace(entity, "[^0-9]", "")
    phone = (
        F.when(entity.startswith("+"), F.concat(F.lit("+"), digits))
        .when(digits.startswith("00"), F.concat(F.lit("+"), F.substring(digits, F.lit(3), F.length(digits))))
        .when(digits.rlike("^[2-9][0-9]{9}$"), F.concat(F.lit("+1"), digits))
        .when(digits.rlike("^1[2-9][0-9]{9}$"), F.concat(F.lit("+"), digits))
        .otherwise(digits)
    )
    secret = F.regexp_replace(F.regexp_replace(entity, _LABEL, ""), "[\"']$", "")
    return (
        F.when(kind == "phone", phone)
        .when(kind.isin("card", "ssn"), digits)
        .when(kind == "iban", F.regexp_replace(entity, " ", ""))
        .when(kind == "email", F.lower(entity))
        .when(kind == "ip6", _expanded(entity))
        .when(kind.isin("male", "female"), F.lower(F.regexp_extract(entity, r"(\S+)$", 1)))
        .when(kind == "secret", secret)
        .otherwise(entity)
    )


def given_of(kind: Column, entity: Column) -> Column:
    """What stands before a surname, without title, case and particles; null without one."""
    name = F.lower(F.regexp_replace(entity, _TITLE, ""))
    given = F.regexp_replace(F.regexp_replace(name, r"\S+$", ""), rf"(?<!\p{{L}}){_PARTICLE}(?!\p{{L}})", "")
    given = F.trim(F.regexp_replace(given, r"[\s.]+", " "))
    return F.when(kind.isin("male", "female") & (given != ""), given)


def parts_of(entity: Column) -> Column:
    """array<struct<kind,normal>> to draw for a mention: its surrogate, or those of surname and given name.

    Given names are drawn for each gender and surname, so that two of one surname differ.
    """
    name = entity["kind"].isin("male", "female")
    first = F.struct(F.when(name, "name").otherwise(entity["kind"]).alias("kind"), entity["normal"].alias("normal"))
    given = F.struct(F.concat_ws(" ", F.lit("given"), entity["kind"], entity["normal"]).alias("kind"), entity["given"].alias("normal"))
    return F.when(entity["given"].isNotNull(), F.array(first, given)).otherwise(F.array(first))


def _number(stream: Column, i: Column, digits: int = 4) -> Column:
    """The i-th number of a hexadecimal stream that is read in a circle."""
    at = (i * digits) % 120 + 1
    return F.conv(F.substring(stream, at, F.lit(digits)), 16, 10).cast("int")


def _stream(key: str, kind: Column, normal: Column, attempt: Column) -> Column:
    """128 hexadecimal digits that only the key's holder can derive."""
    seed = F.concat_ws("\x1f", F.lit(key), kind, attempt.cast("string"), normal)
    return F.sha2(seed, 512)


def _by_character(text: Column, stream: Column) -> Column:
    """Every digit and letter replaced by one of its kind (Cyrillic or Latin); small hexadecimal strings stay hexadecimal."""
    hexadecimal = text.rlike("^[0-9a-f]+$") & text.rlike("[a-f]")

    def cyrillic(n: Column) -> Column:
        return F.substring(F.lit(_CYRILLIC), n % len(_CYRILLIC) + 1, F.lit(1))

    def one(c: Column, i: Column) -> Column:
        # A stream has 30 numbers; the position is mixed in, so that longer entities do not repeat.
        n = _number(stream, i) + i * 7
        letter = F.substring(F.lit(_LOWER), n % 26 + 1, F.lit(1))
        return (
            F.when(hexadecimal, F.substring(F.lit("0123456789abcdef"), n % 16 + 1, F.lit(1)))
            .when(c.between("0", "9"), (n % 10).cast("string"))
            .when(c.between("a", "z"), letter)
            .when(c.between("A", "Z"), F.upper(letter))
            .when(c < "\x80", c)
            .when(c.rlike(r"\p{N}"), (n % 10).cast("string"))
            .when(c.rlike(r"\p{IsCyrillic}"), F.when(c == F.lower(c), cyrillic(n)).otherwise(F.upper(cyrillic(n))))
            .when(c.rlike(r"\p{L}"), F.when(c == F.lower(c), letter).otherwise(F.upper(letter)))
            .otherwise(c)
        )

    return F.array_join(F.transform(F.split(text, ""), one), "")


def _digits(count: Column, stream: Column) -> Column:
    places = F.sequence(F.lit(0), F.greatest(count, F.lit(1)) - 1)
    return F.array_join(F.transform(places, lambda i: ((_number(stream, i) + i * 7) % 10).cast("string")), "")


def _with_check_digit(digits: Column) -> Column:
    """The last digit replaced so that the Luhn sum is a multiple of ten."""
    body = F.substring(digits, F.lit(1), F.length(digits) - 1)
    reverse = F.split(F.reverse(body), "")

    def add(total: Column, x: Column) -> Column:
        return total + x

    def weigh(c: Column, i: Column) -> Column:
        n = c.cast("int")
        double = n * 2
        return F.when(i % 2 == 0, F.when(double > 9, double - 9).otherwise(double)).otherwise(n)

    total = F.aggregate(F.transform(reverse, weigh), F.lit(0), add)
    return F.concat(body, ((10 - total % 10) % 10).cast("string"))


def _pick(pool: list[str], n: Column) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in pool]), n % len(pool) + 1)


def _syllables(script: str, stream: Column, count: Column) -> Column:
    parts = F.transform(F.sequence(F.lit(1), count), lambda k: _pick(_SYLLABLES[script], _number(stream, k)))
    return F.initcap(F.array_join(parts, ""))


def _surname(script: str, stream: Column, attempt: Column) -> Column:
    """Four syllables, 16^4 names; from the draw WIDEN on eight."""
    return _syllables(script, stream, F.when(attempt < WIDEN, 4).otherwise(8))


def _by_script(normal: Column, of: Callable[[str], Column]) -> Column:
    return F.when(normal.rlike(r"\p{IsCyrillic}"), of("cyrillic")).otherwise(of("latin"))


def _given(normal: Column, gender: str, stream: Column, attempt: Column) -> Column:
    """A given name of the same gender and script; a double one where the first draw is taken."""

    def of(script: str) -> Column:
        pool = _GIVEN[script, gender]
        second = _syllables(script, stream, F.when(attempt < WIDEN, 3).otherwise(8))
        first = _pick(pool, _number(stream, F.lit(0)))
        return F.when(attempt == 0, first).otherwise(F.concat_ws("-", first, second))

    return _by_script(normal, of)


def surrogate_of(key: str, kind: Column, normal: Column, attempt: Column) -> Column:
    """Surrogate of a normal form, itself in normal form. The stream is bound once; copies of it would make a huge plan."""
    stream = F.array(_stream(key, kind, normal, attempt))
    return F.get(F.transform(stream, lambda s: _surrogate(key, kind, normal, attempt, s)), F.lit(0))


def _surrogate(key: str, kind: Column, normal: Column, attempt: Column, stream: Column) -> Column:
    digits = _digits(F.length(normal), stream)
    prefix = F.regexp_extract(normal, _COUNTRY, 0)
    older = F.substring(normal, F.lit(1), F.greatest(F.length(normal) - 10, F.lit(0)))
    country = F.when(prefix != "", prefix).when(normal.startswith("0") & (older == ""), "0").otherwise(older)
    key_prefix = F.regexp_extract(normal, f"^{_KEY_PREFIX}", 0)
    octets = [(_number(stream, F.lit(k)) % 254 + 1).cast("string") for k in range(4)]
    # Mailboxes of one domain stay together; the domain is one that is reserved for examples.
    domain = F.substring(F.translate(_stream(key, F.lit("domain"), F.substring_index(normal, "@", -1), F.lit(0)), "0123456789", "ghijklmnop"), 1, 10)
    mailbox = _by_character(F.substring_index(normal, "@", 1), stream)
    more = F.translate(F.substring(stream, 117, 12), "0123456789", "ghijklmnop")
    mailbox = F.when(attempt < WIDEN, mailbox).otherwise(F.concat(mailbox, more))
    # A secret of few letters and digits: other characters become letters too.
    open_secret = F.when(attempt < WIDEN, normal).otherwise(F.regexp_replace(normal, r"[^\p{L}\p{N}]", "a"))
    return (
        F.when(kind == "ip", F.concat_ws(".", *octets))
        .when(kind == "card", _with_check_digit(F.concat(F.substring(normal, 1, 1), F.substring(digits, F.lit(2), F.length(digits)))))
        .when(kind == "phone", F.concat(country, F.substring(digits, F.length(country) + 1, F.length(digits))))
        .when(kind == "ssn", digits)
        .when(kind == "email", F.concat(mailbox, F.lit("@"), domain, F.lit(".example.org")))
        .when(kind == "iban", F.concat(F.substring(normal, 1, 2), _by_character(F.substring(normal, F.lit(3), F.length(normal)), stream)))
        .when(kind == "key", F.concat(key_prefix, _by_character(F.substring(normal, F.length(key_prefix) + 1, F.length(normal)), stream)))
        .when(kind == "ip6", F.concat(F.lit("20010db8"), F.substring(stream, 1, 24)))  # the network reserved for examples
        .when(kind == "name", _by_script(normal, lambda script: _surname(script, stream, attempt)))
        .when(kind.startswith("given male "), _given(normal, "male", stream, attempt))
        .when(kind.startswith("given female "), _given(normal, "female", stream, attempt))
        .otherwise(_by_character(open_secret, stream))
    )


def _same(kind: Column, value: Column) -> Column:
    """Real entities and surrogates are compared in this form."""
    return F.when(kind.isin("name", "email"), F.lower(value)).otherwise(value)


def _frame(kind: Column, normal: Column) -> Column:
    """The format of an entity with at most SMALL random characters, these as 9 or a; null for all others.

    Phone numbers keep their country; only lower-case ASCII secrets and phone numbers have so few.
    """
    country = F.regexp_extract(normal, _COUNTRY, 0)
    free = F.substring(normal, F.length(country) + 1, F.length(normal))
    nines = F.regexp_replace(free, "[0-9]", "9")
    phone = F.when((country != "") & (F.length(free) <= SMALL), F.concat(country, nines))
    shape = F.regexp_replace(F.regexp_replace(normal, "[0-9]", "9"), "[a-z]", "a")
    secret = F.when((F.length(normal) <= SMALL) & normal.rlike("^[0-9a-z]+$") & ~(normal.rlike("^[0-9a-f]+$") & normal.rlike("[a-f]")), shape)
    return F.when(kind == "phone", phone).when(kind == "secret", secret)


def _deal_free_values(drawn: DataFrame, left: DataFrame, key: str, attempt: int) -> DataFrame:
    """(kind, normal, surrogate, attempt) for ``left`` (kind, normal): the n-th entity of a format gets its n-th free value, both in a keyed order."""
    framed = left.withColumn("frame", _frame(F.col("kind"), F.col("normal"))).where("frame is not null")

    def ranked(df: DataFrame, value: str) -> DataFrame:
        order = F.sha2(F.concat_ws("\x1f", F.lit(key), "kind", F.lit(value), value), 256)
        return df.withColumn("place", F.row_number().over(Window.partitionBy("kind", "frame").orderBy(order, value)))

    start = F.length(F.regexp_extract("frame", _COUNTRY, 0))
    values = framed.select("kind", "frame").distinct().withColumn("value", F.substring("frame", F.lit(1), start))
    for k in range(SMALL):
        c = F.substring("frame", start + 1 + k, F.lit(1))
        choices = F.when(c == "9", F.split(F.lit("0123456789"), "")).when(c == "a", F.split(F.lit(_LOWER), "")).otherwise(F.array(F.lit("")))
        values = values.withColumn("c", F.explode(choices)).withColumn("value", F.concat("value", "c")).drop("c")
    owned = drawn.join(left, ["kind", "normal"], "left_anti").select("kind", F.col("surrogate").alias("value"))
    used = owned.union(drawn.select("kind", F.col("normal").alias("value")))
    free = ranked(values.join(used, ["kind", "value"], "left_anti"), "value")
    return ranked(framed, "normal").join(free, ["kind", "frame", "place"]).select(
        "kind", "normal", F.col("value").alias("surrogate"), F.lit(attempt).alias("attempt"))


def _laid_out(kind: Column, entity: Column, surrogate: Column, given: Column) -> Column:
    """The surrogate, for names with the one of the given name or null, in the layout of this mention."""
    # Phone numbers from the right: a mention may leave out the country or have 00 before it.
    count = F.length(F.regexp_replace(entity, "[^0-9]", ""))
    phone = F.right(F.regexp_replace(surrogate, r"\+", ""), count)
    digits = F.when(kind == "phone", F.lpad(phone, count, "0")).otherwise(surrogate)

    def fill(state: Column, c: Column) -> Column:
        slot = F.when(kind == "iban", c != " ").otherwise(c.between("0", "9"))
        text = F.concat(state["text"], F.when(slot, F.substring(digits, state["at"], F.lit(1))).otherwise(c))
        return F.struct(text.alias("text"), (state["at"] + slot.cast("int")).alias("at"))

    start = F.struct(F.lit("").alias("text"), F.lit(1).alias("at"))
    spread = F.aggregate(F.split(entity, ""), start, fill, lambda s: s["text"])
    title = F.regexp_extract(entity, _TITLE, 0)
    name = F.concat_ws(" ", given, surrogate)
    bare = F.substring(entity, F.length(title) + 1, F.length(entity))
    name = F.when(bare == F.upper(bare), F.upper(name)).otherwise(name)
    address = F.regexp_replace(surrogate, "(.{4})(?!$)", "$1:")
    label = F.regexp_extract(entity, _LABEL, 0)
    return (
        F.when(kind.isin("card", "ssn", "phone", "iban"), spread)
        .when(kind.isin("male", "female"), F.concat(title, name))
        .when(kind == "secret", F.concat(label, surrogate, F.regexp_extract(entity, "[\"']$", 0)))
        .when(kind == "ip6", F.when(entity.rlike("[A-F]"), F.upper(address)).otherwise(address))
        .otherwise(surrogate)
    )


def distinct_surrogates(entities: DataFrame, key: str, attempts: int = ATTEMPTS) -> DataFrame:
    """(kind, normal, surrogate, attempt) for distinct (kind, normal): no two of a kind share a surrogate.

    Each round finds the surrogates that several entities share, or that are themselves entities of the corpus, and
    draws all but the least normal form again, until none is left. After ``attempts`` rounds the entities of small
    formats get free values. Raises an error only where a format has fewer free values than entities.
    """
    kind = F.col("kind")
    drawn = entities.select("kind", "normal", F.lit(0).alias("attempt"))
    dealt = None
    for attempt in range(MAX_ATTEMPTS):
        surrogate = surrogate_of(key, kind, F.col("normal"), F.col("attempt"))
        drawn = drawn.select("kind", "normal", "attempt", surrogate.alias("surrogate"))
        if dealt is not None:
            drawn = drawn.join(dealt.select("kind", "normal"), ["kind", "normal"], "left_anti").unionByName(dealt)
        drawn = freeze(drawn, "surrogates")
        same = drawn.withColumn("same", _same(kind, F.col("surrogate")))
        owner = same.groupBy("kind", "same").agg(
            F.min_by("normal", F.struct("attempt", "normal")).alias("owner"), F.count(F.lit(1)).alias("n"))
        # Given names are drawn for each surname, which is never a real one.
        real = drawn.where(~kind.startswith("given ")).select("kind", _same(kind, F.col("normal")).alias("same"), F.lit(True).alias("real")).distinct()
        taken = owner.join(real, ["kind", "same"], "left").where("n > 1 or real")
        again = same.join(taken, ["kind", "same"]).where("real or normal <> owner").select("kind", "normal")
        again = freeze(again, "taken")
        if not again.limit(1).count():
            return drawn
        if dealt is None and attempt + 1 >= attempts:
            small = again.where(_frame(kind, F.col("normal")).isNotNull())
            dealt = freeze(_deal_free_values(drawn, small, key, attempt + 1), "dealt")
            if dealt.count() < small.count():
                raise ValueError("surrogates collide: a format has fewer free values than entities")
        next_draw = again.withColumn("again", F.lit(attempt + 1))
        drawn = drawn.join(next_draw, ["kind", "normal"], "left").select(
            "kind", "normal", F.coalesce("again", "attempt").alias("attempt"))
    raise ValueError(f"surrogates still collide after {MAX_ATTEMPTS} draws: a format is full")


def replace_entities(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """``docs`` with ``text_col`` rewritten, and two more columns: n_entities long and entities array<struct<kind,surrogate>>.

    Every row is kept, with all its columns. A null text stays null without entities, an empty one stays empty. Input
    columns named n_entities or entities are replaced. Equal entities get equal surrogates in all rows.
    """
    columns = [c for c in docs.columns if c not in ("n_entities", "entities")]
    rest = [c for c in columns if c != text_col]
    text = F.col(text_col).cast("string")
    # One pass over the texts: the parts between entities, and the entities, stored once for everything that follows.
    names = known_names(text)
    pattern = F.when(names.isNotNull(), F.concat(F.lit(f"{_ANY}|"), names)).otherwise(F.lit(_ANY))
    cut = docs.select(F.monotonically_increasing_id().alias("__row"), F.struct(*rest).alias("__rest") if rest else F.lit(None).alias("__rest"),
                      text.alias("__text"), F.when(may_hold_entities(text), pattern).alias("__pattern"))
    cut = cut.select("__row", "__rest",
                     F.when(F.col("__pattern").isNotNull(), F.split("__text", F.col("__pattern"), -1)).when(F.col("__text").isNotNull(), F.array("__text")).alias("__gaps"),
                     F.when(F.col("__pattern").isNotNull(), F.regexp_extract_all("__text", F.col("__pattern"), F.lit(0))).alias("__found"))
    cut = cut.withColumn("__found", F.transform("__found", lambda m: F.struct(m.alias("entity"), kind_of(m).alias("kind"))))
    cut = cut.withColumn("__found", with_untitled(F.col("__found")))
    normal = F.transform("__found", lambda e: F.struct(e["entity"].alias("entity"), e["kind"].alias("kind"),
                                                       normal_of(e["kind"], e["entity"]).alias("normal"), given_of(e["kind"], e["entity"]).alias("given")))
    cut = freeze(cut.withColumn("__found", normal), "entities")

    # Place in the map of redrawn parts: twice the number of the mention, one more for the given name.
    mentions = cut.select("__row", F.posexplode("__found").alias("n", "e")).where("e.kind is not null")
    mentions = mentions.select("__row", "n", F.posexplode(parts_of(F.col("e"))).alias("part", "p"))
    mentions = mentions.select("__row", (F.col("n") * 2 + F.col("part")).alias("at"), "p.kind", "p.normal")
    chosen = distinct_surrogates(mentions.select("kind", "normal").distinct(), key)
    redrawn = chosen.where("attempt > 0").select("kind", "normal", F.col("surrogate").alias("drawn"))
    moved = mentions.join(redrawn, ["kind", "normal"]).groupBy("__row").agg(
        F.map_from_entries(F.collect_list(F.struct("at", "drawn"))).alias("__drawn"))
    moved = freeze(moved, "redrawn")
    if moved.count() <= BROADCAST_ROWS:
        moved = F.broadcast(moved)
    cut = cut.join(moved, "__row", "left")

    def drawn(part: Column, at: Column) -> Column:
        return F.coalesce(F.element_at("__drawn", at), surrogate_of(key, part["kind"], part["normal"], F.lit(0)))

    def written(e: Column, i: Column) -> Column:
        parts = F.transform(parts_of(e), lambda p, k: drawn(p, i * 2 + k))
        new = _laid_out(e["kind"], e["entity"], F.get(parts, F.lit(0)), F.get(parts, F.lit(1)))
        return F.struct(e["kind"].alias("kind"), F.when(e["kind"].isNull(), e["entity"]).otherwise(new).alias("surrogate"))

    done = cut.withColumn("__written", F.transform("__found", written))
    joined = F.array_join(F.transform("__gaps", lambda g, i: F.concat(g, F.coalesce(F.get("__written.surrogate", i), F.lit("")))), "")
    values = {c: F.col(f"__rest.`{c}`") for c in rest} | {text_col: joined}
    empty = F.array().cast("array<struct<kind:string,surrogate:string>>")
    entities = F.coalesce(F.filter("__written", lambda e: e["kind"].isNotNull()), empty)
    return done.select(*[values[c].alias(c) for c in columns], F.size(entities).cast("long").alias("n_entities"), entities.alias("entities"))

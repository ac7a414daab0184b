"""Personal data replaced by keyed surrogates.

*Detection.*  One regular expression marks the candidates of all kinds in one left-to-right
scan of a text; a candidate's kind is then told by its shape, and card and account numbers
have to pass their check digits, so that other long numbers stay.  Names are found after a
title, and what names a document has are looked for in all of it: every further mention of
a name's parts, without a title, becomes a candidate too.  Secrets are found by a label
before them or by the prefix that their issuer gives them.  The scan's result, the text cut
into gaps and candidates, is written, so that no text is scanned again.

*Surrogates.*  Every entity has a normal form, and the normal forms of one kind and one
format are permuted among themselves: each character moves within its own class (digits,
letters of one case, vowels or consonants of one script, octets, the first digits of an
area), by a Feistel network whose round function is HMAC-SHA-256 under a secret key.
Distinct entities have distinct surrogates by construction, however full a format is.  The
permutation is ``back(step(forth(x)))`` with a step that changes one symbol, so no entity
is its own surrogate.  Kept are the length and punctuation, upper and lower case, the
country code of a phone number, a fictional exchange (555), the network digit and a valid
check digit of a card, country and valid check digits of an account number, private
networks and the zero groups of an IP address, the top-level domain of an address, hexadecimal secrets as such,
a name's script and its pattern of vowels and consonants; a given name gets an ending of
the gender that its title tells.

*Coreference.*  Normal forms ignore case, separators, diacritics of names (with German
umlauts spelt out), the short form of an IPv6 address and a North American country code that is left out.  Each part of a name
and an address's domain are mapped for themselves.  A surrogate depends on the normal form
alone, so all mentions of an entity, in any document, stay mentions of one.

*Collision checks.*  A surrogate that is itself an entity of the corpus would be mistaken
for it.  The distinct entities and their surrogates are brought together by value; those
that meet an entity draw from further permutations until they meet neither an entity nor
a surrogate, ``ROUNDS`` times at most.  In a format so full that this fails, entities keep
their first surrogate: another entity's value, but still theirs alone.  Only the few
entities with another permutation go back to the documents.

Everything is DataFrame functions.

Defined cases: a null text stays null; texts without entities stay as they are; texts and
secrets of any length are treated whole, in linear time; of candidates that overlap, the
leftmost and then the first in the order of ``SHAPES`` is taken; rows that repeat get the
same answer; null ids are fine; an empty table gives an empty result; all columns of the
input are kept, and ours stay in structs on the way so that names can't clash.
"""

from __future__ import annotations

import hashlib
import unicodedata
from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadrel.llm.shared import let, written

#: Entities with further permutations, up to this many rows (about 60 bytes each), are broadcast; beyond, they are joined by shuffle.
BROADCAST_ROWS = 200_000
#: Further permutations that an entity may draw from.
ROUNDS = 8
#: Rounds of the Feistel network, there and back each.
TURNS = 4

# Shapes of the entities, titles that come before names, labels and prefixes of secrets.
EMAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]+@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)*\.\p{L}{2,}"
IBAN = r"(?=[A-Z]{2}[0-9])(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
PREFIXES = ("AKIA", "ASIA", "gho_", "ghp_", "ghr_", "ghs_", "ghu_", "github_pat_", "glpat-", "xoxa-", "xoxb-", "xoxp-", "xoxr-", "xoxs-", "sk-", "AIza", "eyJ")
ACCESS = (
    r"(?=[Agsxe])(?<![A-Za-z0-9])(?:A(?:KIA|SIA)[A-Z0-9]{16}(?![A-Za-z0-9])|(?:gh[oprsu]_|github_pat_|glpat-|xox[abprs]-|sk-|AIza)[A-Za-z0-9_-]{16,}"
    r"|eyJ[A-Za-z0-9_-]{8,}(?:\.[A-Za-z0-9_-]{2,}){1,2})"
)
LABELS = "token|secret|passwd|password|passphrase|pwd|api[_-]?key|access[_-]?key|passwort|contraseña|пароль"
_LABEL = "(?i:" + LABELS + ")[\"' ]{0,2}[:=] {0,2}[\"']?"
_SECRET = r"[\p{L}\p{N}/+_=!@#$%^&*.~-]{7,}[\p{L}\p{N}/+_=#$%^&*~-]"
SECRET = "(?:(?<=[:= \"'])(?<=[:=] {0,2}[\"']?)(?<=" + _LABEL + ")" + _SECRET + r"|(?<= )(?<=(?i:bearer) )[A-Za-z0-9/+_=.~-]{15,}[A-Za-z0-9/+_=~-])"
#: What a secret holds, so that it has room for surrogates and isn't a line of dashes: a digit or four letters.
ROOM = r"[0-9]|(?:\p{L}\P{L}*){4}"
IP = r"(?=[0-9])(?<![0-9.])(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}(?!\.?[0-9])"
_GROUP = "[0-9A-Fa-f]{1,4}"
IP6 = rf"(?=[0-9A-Fa-f]{{0,4}}:)(?<![\p{{L}}\p{{N}}:.])(?:(?:{_GROUP}:){{7}}{_GROUP}|{_GROUP}(?::{_GROUP}){{0,5}}::(?:{_GROUP}(?::{_GROUP}){{0,5}})?|::{_GROUP}(?::{_GROUP}){{0,6}})(?![\p{{L}}\p{{N}}:])"
_LABELLED_SSN = "(?=[0-9])(?<=(?i:ssn|social security)[^0-9\n]{0,12})[0-9]{3}[ -]?[0-9]{2}[ -]?[0-9]{4}(?![0-9-])"
SSN = r"(?=[0-9])(?:(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])|" + _LABELLED_SSN + ")"
PHONE = (
    r"(?=[0-9+(])(?:(?<![0-9A-Za-z+])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[.-])[0-9]{3}[ .-][0-9]{4}(?![0-9])|(?<![0-9A-Za-z+])\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){3,4}(?![0-9])"
    r"|(?<![0-9A-Za-z+.-])(?<![0-9] )[2-9][0-9]{2} [2-9][0-9]{2} [0-9]{4}(?! ?[0-9])|(?<![0-9A-Za-z+])(?:\(0[1-9][0-9]{0,3}\) ?|0[1-9][0-9]{1,3}[ /-])[0-9]{3,4}[ -]?[0-9]{3,5}(?! ?[0-9]))"
)
CARD = r"(?=[0-9])(?<![0-9A-Za-z])[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z])"
TITLES_MALE = ("Mr", "Mister", "Sir", "Lord", "Herr", "Herrn", "Monsieur", "Señor", "Sr", "Don", "Signor", "господин", "κύριος")
TITLES_FEMALE = ("Mrs", "Ms", "Miss", "Lady", "Dame", "Frau", "Fräulein", "Madame", "Mme", "Mademoiselle", "Mlle", "Señora", "Sra", "Señorita", "Srta", "Doña", "Signora", "госпожа", "κυρία")
TITLES_EITHER = ("Dr", "Doctor", "Doktor", "Docteur", "Dra", "Prof", "Professor", "Professeur", "Profesor", "Profesora", "доктор", "профессор")
PARTICLES = ("von", "van", "de", "der", "den", "del", "della", "di", "da", "du", "la", "le", "zu", "zur", "ten", "ter", "bin", "ibn", "al")
_PARTICLES = "(?:(?:" + "|".join(PARTICLES) + ") ){0,3}"


def _either(*titles: str) -> str:
    """Titles as they are and in capitals."""
    return "(?:" + "|".join(dict.fromkeys(x for t in titles for x in (t, t.upper()))) + ")"


_FIRST = "".join(sorted({x for t in (*TITLES_MALE, *TITLES_FEMALE, *TITLES_EITHER) for x in (t[0], t[0].upper())}))
_TITLED = "(?=[" + _FIRST + r"])(?<!\p{L})(?:" + _either(*TITLES_MALE, *TITLES_FEMALE, *TITLES_EITHER) + r"\.? ){1,3}" + _PARTICLES
#: A part of a name, without an s that an apostrophe parts from it; or an initial.
_PART = r"\p{Lu}(?:(?:[\p{L}\p{M}-]|['’](?![sS](?!\p{L})))*\p{L}\p{M}*|\.)"
NAME = _TITLED + _PART + "(?: " + _PARTICLES + _PART + "){0,3}"
#: In the order in which a candidate's kind is told; each shape first looks at the next characters, which most places of a text fail.
SHAPES = (("email", EMAIL), ("name", NAME), ("access", ACCESS), ("secret", SECRET), ("ip6", IP6), ("ip", IP), ("ssn", SSN), ("phone", PHONE), ("iban", IBAN), ("card", CARD))
ANY = "|".join(x for _, x in SHAPES)
#: Country codes of phone numbers, by the numbering plan.
COUNTRY = "^(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"
#: First octets of an IP address that stay, besides those from 224: their networks are private or reserved, or in part.
HELD_OCTETS = (10, 127, 172, 192)

# Classes of characters, each permuted within itself.
DIGITS = "0123456789"
LOWER = "abcdefghijklmnopqrstuvwxyz"
HEXADECIMAL = ("abcdef", "ghijklmnopqrstuvwxyz", "ABCDEF", "GHIJKLMNOPQRSTUVWXYZ")
NAMES = ("given-f", "given-m", "given-n", "family")
NAME_CLASSES = ("aeiou", "bcdfghjklmnpqrstvwxyz", "αεηιουω", "βγδζθκλμνξπρστφχψ", "аеиоуыэюя", "бвгджзйклмнпрстфхцчшщ")
#: Endings of given names by script and gender.
ENDINGS = (("IsCyrillic", "ин", "ина"), ("IsGreek", "ος", "ίνα"), ("IsLatin", "en", "ina"))


def _letters() -> tuple[str, str, tuple[str, ...]]:
    """Lower-case letters with diacritics and the letters below them, and the classes of all other lower-case letters, by script."""
    marked, plain, scripts = "", "", {}
    known = "".join(NAME_CLASSES) + "йäöüæœßς"
    for c in map(chr, range(0x80, 0xFFFF)):
        if unicodedata.category(c) != "Ll" or c in known:
            continue
        base = unicodedata.normalize("NFD", c)[0]
        if base != c and base in known + "ßς":
            marked, plain = marked + c, plain + base
        else:
            script = unicodedata.name(c, "other").split()[0]
            scripts[script] = scripts.get(script, "") + c
    return marked, plain, tuple(scripts.values())


MARKED, PLAIN, OTHER_CLASSES = _letters()


def _each(text: Column, then: Callable[[Column, Column], Column]) -> Column:
    """Characters of ``text`` mapped by (character, place) and joined."""
    return F.array_join(F.transform(F.split(text, ""), then), "")


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _tail(text: Column, start: int | Column) -> Column:
    """``text`` from its character number ``start``, counted from one."""
    return F.substring(text, F.lit(start) if isinstance(start, int) else start, F.length(text))


def _luhn(digits: Column) -> Column:
    """Luhn sum of a string of digits, modulo 10."""
    values = F.transform(
        F.split(F.reverse(digits), ""),
        lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(F.pmod(c.cast("int") * 2, F.lit(10)) + F.floor(c.cast("int") / 5).cast("int")),
    )
    return F.pmod(F.aggregate(values, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))), F.lit(10))


def _mod97(account: Column) -> Column:
    """Remainder modulo 97 of an account number in check order, letters as 10 to 35."""
    return F.aggregate(
        F.split(F.concat(_tail(account, 5), F.substring(account, F.lit(1), F.lit(4))), ""),
        F.lit(0),
        lambda a, c: F.when(c == "", a).when(c.rlike("^[0-9]$"), F.pmod(a * 10 + F.conv(c, 36, 10).cast("int"), F.lit(97))).otherwise(F.pmod(a * 100 + F.conv(c, 36, 10).cast("int"), F.lit(97))),
    )


def kind_of(value: Column) -> Column:
    """Kind of a candidate; null if its check digits fail."""
    out = F.when(value.rlike("^" + EMAIL + "$"), F.lit("email")).when(value.rlike("^" + NAME + "$"), F.lit("name"))
    out = out.when(value.rlike("^" + ACCESS + "$"), F.lit("access"))
    groups = F.size(F.filter(F.split(value, ":"), lambda g: g != ""))
    # Fewer than three groups are rather a scope in a program.
    out = out.when(value.rlike("^" + IP6 + "$") & (groups >= 3) & value.rlike("[0-9]"), F.lit("ip6"))
    out = out.when(value.rlike("^" + IP + "$"), F.lit("ip")).when(value.rlike("^[0-9]{3}([ -]?)[0-9]{2}\\1[0-9]{4}$"), F.lit("ssn"))
    out = out.when(value.rlike("^(?:" + PHONE + ")$"), F.lit("phone"))
    plain = F.replace(value, F.lit(" "), F.lit(""))
    out = out.when(value.rlike("^" + IBAN + "$") & (_mod97(plain) == 1), F.lit("iban"))
    card = value.rlike("^" + CARD + "$")
    out = out.when(card & (_luhn(_digits(value)) == 0), F.lit("card"))
    return out.when(~card & ~value.rlike("^" + IBAN + "$") & value.rlike("^" + _SECRET + "$") & value.rlike(ROOM), F.lit("secret"))


def normal_of(kind: Column, value: Column) -> Column:
    """The form in which mentions of one entity are equal; of a part of a name, without diacritics."""
    phone = F.when(value.startswith("+") | _digits(value).startswith("0"), _digits(value)).otherwise(F.concat(F.lit("1"), _digits(value)))
    plain = F.replace(value, F.lit(" "), F.lit(""))
    spelt = F.lower(value)
    for mark, letters in (("ä", "ae"), ("ö", "oe"), ("ü", "ue"), ("æ", "ae"), ("œ", "oe"), ("ß", "ss"), ("ς", "σ")):
        spelt = F.replace(spelt, F.lit(mark), F.lit(letters))
    return (
        F.when(kind == "phone", phone)
        .when(kind.isin("card", "ssn"), _digits(value))
        .when(kind == "iban", F.concat(F.substring(plain, F.lit(1), F.lit(2)), F.lit("00"), _tail(plain, 5)))
        .when(kind == "email", F.lower(value))
        .when(kind == "ip", F.array_join(F.transform(F.split(value, r"\."), lambda o: o.cast("int").cast("string")), "."))
        .when(kind == "ip6", _expanded(value))
        .when(kind.isin(*NAMES), F.translate(spelt, MARKED, PLAIN))
        .otherwise(value)
    )


def _expanded(value: Column) -> Column:
    """An IPv6 address as eight groups, without leading zeros, in lower case."""
    plain = lambda part: F.transform(F.filter(F.split(part, ":"), lambda g: g != ""), lambda g: F.lower(F.conv(g, 16, 16)))
    before, after = plain(F.substring_index(value, "::", 1)), F.when(value.contains("::"), plain(F.substring_index(value, "::", -1))).otherwise(F.array().cast("array<string>"))
    return F.array_join(F.concat(before, F.array_repeat(F.lit("0"), F.greatest(8 - F.size(before) - F.size(after), F.lit(0))), after), ":")


def _name_parts(value: Column) -> tuple[Column, Column]:
    """Title with its space, and the parts of the name."""
    title = F.regexp_extract(value, "^" + _TITLED, 0)
    return title, F.split(_tail(value, F.length(title) + 1), " ")


def units(kind: Column, value: Column, people: Column | None = None) -> Column:
    """array<struct<kind, normal>>: what of an entity is mapped for itself, the parts of a name or the whole; ``people`` says what a mention is."""
    titled = lambda *titles: value.rlike(r"^(?:\p{L}+\.? )*?" + _either(*titles) + "[. ]")
    given = F.when(titled(*TITLES_FEMALE), F.lit("given-f")).when(titled(*TITLES_MALE), F.lit("given-m")).otherwise(F.lit("given-n"))

    def of_parts(parts: Column) -> Column:
        def one(p: Column, i: Column) -> Column:
            own = F.when(p.isin(*PARTICLES), F.lit("particle")).when(i < F.size(parts) - 1, given).otherwise(F.lit("family"))
            return F.struct(own.alias("kind"), normal_of(own, p).alias("normal"))

        return F.transform(parts, one)

    out = F.when(kind == "name", let(_name_parts(value)[1], of_parts))
    if people is not None:
        out = out.when(kind == "mention", F.array(F.get(F.filter(people, lambda x: F.lower(x["part"]) == F.lower(value)), F.lit(0))["unit"]))
    return out.otherwise(F.array(F.struct(kind.alias("kind"), normal_of(kind, value).alias("normal"))))


def people_of(body: Column) -> Column:
    """array<struct<part, unit>>: the parts of all titled names of a text, initials and particles left out, the longest first."""
    of_name = lambda n: F.arrays_zip(_name_parts(n)[1].alias("part"), units(F.lit("name"), n).alias("unit"))
    parts = F.flatten(F.transform(F.array_distinct(F.regexp_extract_all(body, F.lit(NAME), F.lit(0))), of_name))
    whole = F.filter(parts, lambda x: (F.length(x["part"]) > 1) & ~x["part"].endswith(".") & (x["unit"]["kind"] != "particle"))
    ordered = F.array_sort(F.transform(F.array_distinct(whole), lambda x: F.struct((-F.length(x["part"])).alias("n"), x["part"].alias("part"), x["unit"].alias("unit"))))
    return F.transform(ordered, lambda x: F.struct(x["part"].alias("part"), x["unit"].alias("unit")))


def _mac(key: str, *message: Column) -> Column:
    """HMAC-SHA-256 in hexadecimal, of strings joined by a control character."""
    block = key.encode("utf-8")
    block = (block if len(block) <= 64 else hashlib.sha256(block).digest()).ljust(64, b"\0")
    inner, outer = (F.lit(bytearray(b ^ pad for b in block)) for pad in (0x36, 0x5C))
    text = F.encode(F.concat_ws("\x1f", *message), "UTF-8")
    return F.sha2(F.concat(outer, F.unhex(F.sha2(F.concat(inner, text), 256))), 256)


def _symbol(v: Column | int, r: Column | int, of: Column | str) -> Column:
    """A symbol: value ``v`` of ``r`` many, and the characters that the values stand for."""
    return F.struct((F.lit(v) if isinstance(v, int) else v).alias("v"), (F.lit(r) if isinstance(r, int) else r).alias("r"), (F.lit(of) if isinstance(of, str) else of).alias("of"))


def _class(c: Column, *classes: str) -> Column:
    """The class, a string of characters, that a character is in; itself if it is in none."""
    return reduce(lambda out, x: out.when(F.lit(x).contains(c), F.lit(x)), classes, F).otherwise(c)


def _in_class(c: Column, of: Column) -> Column:
    """The symbol of a character within its class."""
    return let(of, lambda k: _symbol(F.position(c, k) - 1, F.greatest(F.length(k), F.lit(1)), k))


def _symbols(kind: Column, normal: Column) -> Column:
    """array<struct<v, r, of>> of a normal form (of an address, its local part); classes depend only on what stays."""
    n = F.length(normal)
    country = F.length(F.regexp_extract(normal, COUNTRY, 0))
    exchange = F.substring(normal, F.lit(5), F.lit(3))
    prefix = F.length(F.regexp_extract(normal, "^(?:" + "|".join(PREFIXES) + ")", 0))
    american = normal.rlike("^1[0-9]{10}$")

    def of_phone(c: Column, i: Column) -> Column:
        # An exchange other than 555 never becomes 555.
        five = ((i == 4) | ((i == 5) & exchange.startswith("5")) | ((i == 6) & exchange.startswith("55")))
        lead = F.when(five & (i == 4), _class(c, "2346789", "01")).when(i == 1, _class(c, "23456789", "01")).when(five & (c != "5"), F.lit("012346789"))
        return F.when(i < country, c).when(~american, F.lit(DIGITS)).otherwise(F.coalesce(lead, F.when(five, c), F.lit(DIGITS)))

    def of(c: Column, i: Column) -> Column:
        return (
            F.when(kind == "phone", of_phone(c, i))
            .when(kind == "card", F.when((i == 0) | (i == n - 1), c).otherwise(F.lit(DIGITS)))
            .when((kind == "particle") | ((kind == "iban") & (i < 4)) | ((kind == "access") & (i < prefix)), c)
            .when(kind.isin("iban", "access", "secret"), _class(c, DIGITS, *HEXADECIMAL, *NAME_CLASSES[2:], MARKED, *OTHER_CLASSES))
            .when(kind.isin(*NAMES), _class(c, *NAME_CLASSES, *OTHER_CLASSES))
            .otherwise(_class(c, DIGITS, LOWER, *NAME_CLASSES[2:], MARKED, *OTHER_CLASSES))
        )

    def of_octets(o: Column) -> Column:
        a, b = (F.get(o, k) for k in (0, 1))
        held = a.isin(0, *HELD_OCTETS) | (a >= 224)
        rank = reduce(lambda x, h: x - F.when(a > h, 1).otherwise(0), HELD_OCTETS, a) - 1
        first = F.when(held, _symbol(0, 1, "")).otherwise(_symbol(rank, 223 - len(HELD_OCTETS), ""))
        private = (a == 172) & b.between(16, 31)
        second = (
            F.when(private, _symbol(b - 16, 16, "")).when(a == 172, _symbol(b - F.when(b > 31, 16).otherwise(0), 240, ""))
            .when((a == 192) & (b == 168), _symbol(0, 1, "")).when(a == 192, _symbol(b - F.when(b > 168, 1).otherwise(0), 255, ""))
            .otherwise(_symbol(b, 256, ""))
        )
        return F.array(first, second, *(_symbol(F.get(o, k), 256, "") for k in (2, 3)))

    def of_group(g: Column, i: Column) -> Column:
        # Groups of zeros stay, as does a first group outside the global addresses from 2000 to 3fff.
        v = F.conv(g, 16, 10).cast("int")
        free = F.when(i > 0, _symbol(v - 1, 65535, "")).when(v.between(0x2000, 0x3FFF), _symbol(v - 0x2000, 0x2000, ""))
        return F.when(v == 0, _symbol(0, 1, "")).otherwise(F.coalesce(free, _symbol(0, 1, "")))

    octets = F.transform(F.split(normal, r"\."), lambda o: o.cast("int"))
    return F.when(kind == "ip", let(octets, of_octets)).when(kind == "ip6", F.transform(F.split(normal, ":"), of_group)).otherwise(F.transform(F.split(normal, ""), lambda c, i: _in_class(c, of(c, i))))


def permuted(symbols: Column, key: str, *tweak: Column) -> Column:
    """array<int>: the values of ``symbols`` after a keyed permutation of all values that such symbols can have; never the same values."""
    radices = F.transform(symbols, lambda s: s["r"])
    # The last symbol that has another value to go to.
    last = F.size(symbols) - F.array_position(F.transform(F.reverse(radices), lambda r: r > 1), F.lit(True)).cast("int")

    def step(values: Column, number: Column) -> Column:
        turn = F.least(number, 2 * TURNS - number)
        sign = F.when(number > TURNS, -1).otherwise(1)
        rest = F.array_join(F.transform(values, lambda x, i: F.when(F.pmod(i + turn, F.lit(2)) == 0, F.lit("")).otherwise(x.cast("string"))), ",")

        def moved(seed: Column) -> Column:
            def one(x: Column, i: Column) -> Column:
                radix = F.get(radices, i)
                by = F.pmod(F.xxhash64(seed, i), radix.cast("long")).cast("int")
                return F.when(F.pmod(i + turn, F.lit(2)) == 0, F.pmod(x + sign * by, radix)).otherwise(x)

            return F.transform(values, one)

        def stepped(seed: Column) -> Column:
            def one(x: Column, i: Column) -> Column:
                radix = F.get(radices, i)
                by = F.pmod(F.xxhash64(seed, F.lit(-1)), F.greatest(radix - 1, F.lit(1)).cast("long")).cast("int") + 1
                return F.when(i == last, F.pmod(x + by, radix)).otherwise(x)

            return F.transform(values, one)

        fixed = F.array_join(F.transform(radices, lambda r: r.cast("string")), ",")
        turned = let(_mac(key, F.lit("turn"), *tweak, turn.cast("string"), rest), moved)
        return F.when(number == TURNS, let(_mac(key, F.lit("step"), *tweak, fixed), stepped)).otherwise(turned)

    return F.aggregate(F.sequence(F.lit(0), F.lit(2 * TURNS)), F.transform(symbols, lambda s: s["v"]), step)


def _spelt(symbols: Column, values: Column) -> Column:
    return F.array_join(F.zip_with(symbols, values, lambda s, v: F.substring(s["of"], v + 1, F.lit(1))), "")


def _address(symbols: Column, values: Column, normal: Column) -> Column:
    """Octets of symbols' values, in dotted form; those of ``normal`` where the symbols are fixed."""

    def of_first(a: Column) -> Column:
        b = F.get(values, 1)
        fixed = F.substring_index(F.substring_index(normal, ".", 2), ".", -1).cast("int")
        second = (
            F.when(F.get(symbols, 1)["r"] == 1, fixed)
            .when(F.get(symbols, 1)["r"] == 16, b + 16)
            .when(a == 172, b + F.when(b >= 16, 16).otherwise(0))
            .when(a == 192, b + F.when(b >= 168, 1).otherwise(0))
            .otherwise(b)
        )
        return F.concat_ws(".", a.cast("string"), second.cast("string"), F.get(values, 2).cast("string"), F.get(values, 3).cast("string"))

    free = reduce(lambda x, h: x + F.when(x >= h, 1).otherwise(0), HELD_OCTETS, F.get(values, 0) + 1)
    return let(F.when(F.get(symbols, 0)["r"] == 1, F.substring_index(normal, ".", 1).cast("int")).otherwise(free), of_first)


def _address6(symbols: Column, values: Column, normal: Column) -> Column:
    """Eight groups of symbols' values; those of ``normal`` where the symbols are fixed."""
    groups = F.split(normal, ":")

    def one(v: Column, i: Column) -> Column:
        free = F.lower(F.hex((v + F.when(i > 0, 1).otherwise(0x2000)).cast("long")))
        return F.when(F.get(symbols, i)["r"] == 1, F.get(groups, i)).otherwise(free)

    return F.array_join(F.transform(values, one), ":")


def drawn(kind: Column, normal: Column, key: str, counter: Column) -> Column:
    """Normal form of the surrogate of a unit, from the permutation number ``counter``."""
    email = kind == "email"
    domain = F.substring_index(normal, "@", -1)
    own = F.when(email, F.substring_index(normal, "@", 1)).otherwise(normal)
    place = F.when(email, domain).otherwise(F.lit(""))
    top = F.substring_index(domain, ".", -1)
    hosts = F.substring(domain, F.lit(1), F.length(domain) - F.length(top) - 1)

    def ending(script: str, male: str, female: str) -> Column:
        return F.when(normal.rlike(rf"\p{{{script}}}"), F.when(kind == "given-m", F.lit(male)).otherwise(F.lit(female)))

    def of_symbols(x: Column) -> Column:
        symbols, values = x["symbols"], x["values"]
        text = _spelt(symbols, values)
        host = let(_symbols(F.lit("domain"), hosts), lambda s: _spelt(s, permuted(s, key, F.lit("domain"), F.lit(""), top)))
        body = F.substring(text, F.lit(1), F.length(text) - 1)
        check = let(body, lambda b: F.concat(b, F.pmod(10 - _luhn(F.concat(b, F.lit("0"))), F.lit(10)).cast("string")))
        return (
            F.when(kind == "ip", _address(symbols, values, normal))
            .when(kind == "ip6", _address6(symbols, values, normal))
            .when(email, F.concat(text, F.lit("@"), host, F.lit("."), top))
            .when(kind == "card", check)
            .when(kind.isin("given-f", "given-m") & ~normal.endswith("."), F.concat(text, F.coalesce(*(ending(*e) for e in ENDINGS), F.lit(""))))
            .otherwise(text)
        )

    def of_known(symbols: Column) -> Column:
        return let(F.struct(symbols.alias("symbols"), permuted(symbols, key, kind, counter.cast("string"), place).alias("values")), of_symbols)

    return let(_symbols(kind, own), of_known)


def _into_format(value: Column, digits: Column) -> Column:
    """``value`` with its digits replaced by as many last ones of ``digits``, in order."""
    spare = F.length(digits) - F.length(_digits(value))
    return _each(
        value,
        lambda c, i: F.when(c.rlike("^[0-9]$"), F.substring(digits, spare + F.length(_digits(F.substring(value, F.lit(1), i + 1))), F.lit(1))).otherwise(c),
    )


def _cased_name(part: Column, found: Column) -> Column:
    """A name's surrogate in the case of its mention: all capitals, or a capital where a piece of the mention begins with one."""
    pieces = F.split(part, "['’-]")

    def one(piece: Column, i: Column) -> Column:
        capital = F.substring(F.coalesce(F.get(pieces, i), part), F.lit(1), F.lit(1)).rlike(r"^\p{Lu}")
        return F.when(capital, F.concat(F.upper(F.substring(piece, F.lit(1), F.lit(1))), _tail(piece, 2))).otherwise(piece)

    marks = F.transform(F.split(F.regexp_replace(found, "[^'’-]", ""), ""), lambda m: m)
    joined = F.array_join(F.zip_with(F.transform(F.split(found, "['’-]"), one), marks, lambda p, m: F.concat(F.coalesce(p, F.lit("")), F.coalesce(m, F.lit("")))), "")
    shouted = part.rlike(r"^[^\p{Ll}]*\p{Lu}[^\p{Ll}]*\p{Lu}[^\p{Ll}]*$")
    return F.when(shouted, F.upper(found)).otherwise(joined)


def _shortened(value: Column, groups: Column) -> Column:
    """Eight groups written as the mention is: short or in full, in its case, padded as it is."""
    whole = F.split(groups, ":")
    n_before = F.size(F.filter(F.split(F.substring_index(value, "::", 1), ":"), lambda g: g != ""))
    n_after = F.size(F.filter(F.split(F.substring_index(value, "::", -1), ":"), lambda g: g != ""))
    said = F.filter(F.split(value, ":"), lambda g: g != "")
    padded = lambda part, skipped: F.array_join(F.transform(part, lambda g, i: F.lpad(g, F.greatest(F.length(g), F.length(F.coalesce(F.get(said, i + skipped), F.lit("")))), "0")), ":")
    short = F.concat(padded(F.slice(whole, F.lit(1), n_before), F.lit(0)), F.lit("::"), padded(F.slice(whole, 9 - n_after, n_after), n_before))
    text = F.when(value.contains("::"), short).otherwise(padded(whole, F.lit(0)))
    return F.when(value.rlike("[A-F]"), F.upper(text)).otherwise(text)


def surrogate(entity: Column, key: str, counter: Callable[[Column], Column], people: Column | None = None) -> Column:
    """The surrogate of an entity(kind, value) in the format of its mention, ``counter`` giving a unit's permutation; its value where kind is null."""
    plain = lambda t: F.replace(t, F.lit(" "), F.lit(""))

    def of_drawn(x: Column) -> Column:
        kind, value, found = x["kind"], x["value"], x["found"]
        one = F.get(found, 0)
        check = F.lpad((98 - _mod97(one)).cast("string"), 2, "0")
        account = let(F.concat(F.substring(one, F.lit(1), F.lit(2)), check, _tail(one, 5)), lambda w: _each(value, lambda c, i: F.when(c == " ", c).otherwise(F.substring(w, F.length(plain(F.substring(value, F.lit(1), i + 1))), F.lit(1)))))
        cased = F.array_join(F.zip_with(F.split(value, ""), F.split(one, ""), lambda c, s: F.when(c.rlike(r"^\p{Lu}$"), F.upper(s)).otherwise(s)), "")
        return (
            F.when(kind == "name", F.concat(_name_parts(value)[0], F.array_join(F.zip_with(_name_parts(value)[1], found, _cased_name), " ")))
            .when(kind == "mention", _cased_name(value, one))
            .when(kind == "ip6", _shortened(value, one))
            .when(kind == "email", cased)
            .when(kind.isin("phone", "card", "ssn"), _into_format(value, one))
            .when(kind == "iban", account)
            .otherwise(one)
        )

    def of_entity(e: Column) -> Column:
        found = F.transform(units(e["kind"], e["value"], people), lambda u: drawn(u["kind"], u["normal"], key, counter(u)))
        return F.when(e["kind"].isNull(), e["value"]).otherwise(let(F.struct(e["kind"].alias("kind"), e["value"].alias("value"), found.alias("found")), of_drawn))

    return let(entity, of_entity)


def _unit_key(unit: Column) -> Column:
    return F.concat_ws("|", unit["kind"], unit["normal"])


def further_permutations(pool: DataFrame, key: str) -> DataFrame:
    """(kind, normal, counter) of the distinct units ``pool(kind, normal)`` that draw from a permutation other than the first."""
    real = pool.select("kind", F.col("normal").alias("drawn"))
    first = written(pool.withColumn("drawn", drawn(F.col("kind"), F.col("normal"), key, F.lit(0))), "surrogates")
    pending = written(first.join(real, ["kind", "drawn"], "left_semi").select("kind", "normal"), "surrogates-met")
    moved = pending.select("kind", "normal", F.lit(0).alias("counter")).limit(0)
    taken = first.select("kind", "drawn")
    for counter in range(1, ROUNDS + 1):
        if pending.isEmpty():
            break
        again = pending.withColumn("drawn", drawn(F.col("kind"), F.col("normal"), key, F.lit(counter)))
        free = again.join(real, ["kind", "drawn"], "left_anti").join(taken, ["kind", "drawn"], "left_anti")
        won = written(free.groupBy("kind", "drawn").agg(F.min("normal").alias("normal")), "surrogates-again")
        if won.isEmpty():
            continue
        taken = taken.unionByName(won.select("kind", "drawn"))
        moved = moved.unionByName(won.select("kind", "normal", F.lit(counter).alias("counter")))
        pending = written(pending.join(won, ["kind", "normal"], "left_anti"), "surrogates-met")
    return moved


def _cut(body: Column, pattern: Column) -> Column:
    """array<string>: a text's gaps and candidates by turns, a gap first and last."""
    mark = F.when(body.contains("\x01"), F.concat(F.lit("\x01"), F.md5(F.encode(body, "UTF-8")), F.lit("\x01"))).otherwise(F.lit("\x01"))
    return let(mark, lambda m: F.split(F.regexp_replace(body, pattern, F.concat(m, F.lit("$0"), m)), m, -1))


def _may_hold(body: Column, titled: Column) -> Column:
    """Whether a text holds what some entity has, told by what is quickly looked for; others are not scanned further."""
    marked = reduce(or_, (body.contains(x) for x in ("::", *PREFIXES, "earer ", "EARER ")))
    labelled = body.rlike("[:=]") & body.rlike("(?i:" + LABELS + ")[\"' ]{0,2}[:=]")
    return body.rlike("[@0-9]") | titled | marked | labelled


def _of_people(people: Column) -> Column:
    """The pattern of all candidates and of the people's names, as they are and in capitals."""
    spelt = F.flatten(F.transform(people, lambda x: F.array_distinct(F.array(x["part"], F.upper(x["part"])))))
    words = F.array_join(F.transform(spelt, lambda w: F.concat(F.lit("\\Q"), w, F.lit("\\E"))), "|")
    return F.concat(F.lit(ANY + r"|(?<![\p{L}\p{M}\p{N}])(?:"), words, F.lit(r")(?![\p{L}\p{M}\p{N}])"))


def replace_entities(df: DataFrame, key: str, text: str = "text", ident: str = "doc_id", report: bool = False) -> DataFrame:
    """``df`` with the entities of ``text`` replaced under ``key``; with ``report``, (ident, text, replaced, kinds) instead."""
    body = F.col(f"`{text}`").cast("string")
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("whole"), body.alias("body"))
    rows = rows.withColumn("titled", F.col("body").rlike(_TITLED))
    rows = rows.withColumn("people", F.when(F.col("titled"), people_of(F.col("body"))))
    named = F.size("people") > 0
    cut = F.when(named, _cut(F.col("body"), _of_people(F.col("people")))).when(_may_hold(F.col("body"), F.col("titled")), _cut(F.col("body"), F.lit(ANY)))
    rows = rows.withColumn("parts", cut)
    mentioned = lambda v: F.coalesce(F.exists("people", lambda x: (x["part"] == v) | (F.upper(x["part"]) == v)), F.lit(False))
    rows = rows.withColumn("kinds", F.transform(F.filter("parts", lambda p, i: i % 2 == 1), lambda v: F.when(mentioned(v), "mention").otherwise(kind_of(v))))
    some = F.exists("kinds", lambda k: k.isNotNull())
    # A text that is cut is written as its parts alone.
    stored = rows.select(
        F.monotonically_increasing_id().alias("row"),
        F.when(some, F.col("whole").withField(f"`{text}`", F.lit(None).cast(df.schema[text].dataType))).otherwise(F.col("whole")).alias("whole"),
        F.when(some, F.col("parts")).alias("parts"),
        F.when(some, F.col("kinds")).alias("kinds"),
        F.when(some, F.col("people")).alias("people"),
    )
    stored = written(stored, "entity-rows")
    values = F.filter("parts", lambda p, i: i % 2 == 1)
    met = F.flatten(F.transform(F.filter(F.arrays_zip(F.col("kinds").alias("kind"), values.alias("value")), lambda e: e["kind"].isNotNull()), lambda e: units(e["kind"], e["value"], F.col("people"))))
    met = F.filter(met, lambda u: u["kind"] != "particle")
    found = written(stored.where("kinds IS NOT NULL").select("row", F.explode(F.array_distinct(met)).alias("u")).select("row", "u.*"), "entities")
    moved = further_permutations(written(found.select("kind", "normal").distinct(), "entity-pool"), key)
    moved = written(moved, "surrogates-moved")
    few = moved.limit(BROADCAST_ROWS + 1).count()
    if few == 0:
        told = stored.withColumn("counters", F.lit(None).cast("map<string,int>"))
    else:
        entry = F.struct(_unit_key(F.struct("kind", "normal")).alias("key"), "counter")
        back = found.join(F.broadcast(moved) if few <= BROADCAST_ROWS else moved, ["kind", "normal"])
        back = written(back.groupBy("row").agg(F.map_from_entries(F.collect_set(entry)).alias("counters")), "surrogates-of-rows")
        rows_back = back.limit(BROADCAST_ROWS + 1).count()
        told = stored.join(F.broadcast(back) if rows_back <= BROADCAST_ROWS else back, "row", "left")

    def counter(unit: Column) -> Column:
        return F.coalesce(F.try_element_at(F.col("counters"), _unit_key(unit)), F.lit(0))

    def put(part: Column, i: Column) -> Column:
        entity = F.struct(F.get(F.col("kinds"), F.floor(i / 2).cast("int")).alias("kind"), part.alias("value"))
        return F.when(i % 2 == 0, part).otherwise(surrogate(entity, key, counter, F.col("people")))

    clean = F.when(F.col("kinds").isNull(), F.col(f"whole.`{text}`").cast("string")).otherwise(F.array_join(F.transform("parts", put), ""))
    if report:
        kinds = F.filter(F.coalesce("kinds", F.array().cast("array<string>")), lambda k: k.isNotNull())
        return told.select(F.col(f"whole.`{ident}`").alias(ident), clean.alias(text), F.size(kinds).cast("long").alias("replaced"), F.array_join(kinds, ",").alias("kinds"))
    return told.select(F.col("whole").withField(f"`{text}`", clean).alias("whole")).select("whole.*")

"""Personal data replaced by keyed surrogates of the same type, in DataFrame functions only."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

_START, _STOP = r"(?<![\p{L}\p{N}_.+-])", r"(?![\p{L}\p{N}_])"
_NAME = r"\p{Lu}[\p{L}'’]*+(?:-\p{Lu}[\p{L}'’]*+)*+"
_MALE = r"(?:Mr\.?|Mister|Sir|Herrn?|Monsieur|Señor|Sr\.|Don|Господин|г-н)"
_FEMALE = r"(?:Mrs\.?|Ms\.?|Miss|Madam|Frau|Mme\.?|Madame|Mlle\.?|Señora|Señorita|Sra\.|Doña|Госпожа|г-жа)"
_OTHER = r"(?:Dr\.?|Prof\.?|[Mm]y name is|[Ii]ch heiße|[Jj]e m['’]appelle|[Mm]e llamo)"

_INITIAL = r"(?:\p{Lu}\.)++"
_PARTICLE = r"(?:von|van|der|den|de|la|di|da|del|zu)"
_TITLE = rf"(?:{_MALE}|{_FEMALE}|{_OTHER})\x20"
#: All name words behind a title, with initials and particles between them; the last one is the family name.
_PEOPLE = (
    rf"(?:{_INITIAL}\x20?)*+{_NAME}"
    rf"(?:\x20{_INITIAL}(?=\x20(?:{_PARTICLE}\x20)*+\p{{Lu}})|\x20(?:{_PARTICLE}\x20)*+{_NAME})*+"
)
_WORD = rf"{_INITIAL}|{_NAME}|\p{{Ll}}++"

#: A digit of a phone number with what may stand before it; written out as Java wants to see the length of what it looks back at.
_DIGIT = r"[\x20.()-]{0,2}[0-9]"

#: Kind and regex, in the order in which they claim a place.  No two parts of one regex can trade characters.
KINDS = (
    ("email", r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)+"),
    ("iban", _START + r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?" + _STOP),
    ("ssn", _START + r"[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\p{L}\p{N}_-])"),
    (
        "ip",
        _START + r"(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?!\.?[\p{L}\p{N}_])",
    ),
    (
        "card",
        _START + r"(?:[0-9]{13,19}|[0-9]{4}(?:[\x20-][0-9]{4}){2}[\x20-][0-9]{1,7}|[0-9]{4}[\x20-][0-9]{6}[\x20-][0-9]{5})" + _STOP,
    ),
    (
        "phone",
        r"(?<![\p{L}\p{N}_.+-])(?:\+[0-9]{1,3}[\x20.-]?(?:\([0-9]{1,4}\)[\x20.-]?)?[0-9]{2,12}(?:[\x20.-][0-9]{2,8}){0,4}"
        # A number in this form has 7 to 15 digits; "+100" and "+1.25" are none.
        + rf"(?<=\+{_DIGIT * 7}{f'(?:{_DIGIT})?' * 8})"
        + r"|\([0-9]{2,4}\)[\x20.-]?[0-9]{3,4}[\x20.-][0-9]{3,4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4})" + _STOP,
    ),
    ("person", rf"(?<![\p{{L}}\p{{N}}]){_TITLE}{_PEOPLE}"),
)
_BY_KIND = {k: f"(?:{r})" for k, r in KINDS}
# What a number or a title can begin with is tested first; that alone rules out most places of a text.
_NUMBER = rf"(?=[0-9A-Z+(])(?:{'|'.join(_BY_KIND[k] for k in ('iban', 'ssn', 'ip', 'card', 'phone'))})"
PERSON = rf"(?=[MSHDFPГгmiIjJ])(?:{_BY_KIND['person']})"
ANY = f"{_BY_KIND['email']}|{_NUMBER}|{PERSON}"
_SEP = "\x1f"
ENTITIES = "__entities"
#: After so many attempts a surrogate grows, and again after as many more: the names of its format may have taken all others.
GROWS = 6


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def kind_of(hit: Column) -> Column:
    """The kind whose regex takes the whole hit, in the order of claims."""
    found = F.lit("person")
    for kind, regex in reversed(KINDS[:-1]):
        found = F.when(hit.rlike(f"^(?:{regex})$"), F.lit(kind)).otherwise(found)
    return found


def digits_of(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def title_of(hit: Column) -> Column:
    """The title with its space; empty for a name that stands alone."""
    return F.regexp_extract(hit, rf"^({_TITLE})", 1)


def words_of(hit: Column) -> Column:
    """The words of a titled name: names, initials, particles."""
    return F.regexp_extract_all(F.substr(hit, F.length(title_of(hit)) + 1), F.lit(_WORD), F.lit(0))


def parts_of(hit: Column) -> Column:
    """``array<struct<kind, name>>``: what a hit names, in a form that does not depend on how it is written.

    Numbers go by their digits, mail addresses by lower case, account numbers
    without spaces.  A titled name has a part for each word: the last name word
    is the family name, those before it are given names, whose kind tells the
    gender of the title; names carry their script.  Initials and particles are
    kinds of their own.
    """
    kind = kind_of(hit)
    gender = F.when(hit.rlike(rf"^{_MALE}\x20"), "m").when(hit.rlike(rf"^{_FEMALE}\x20"), "f").otherwise("n")
    script = lambda w: F.when(w.rlike(r"^\p{IsCyrillic}"), "cyrillic").when(w.rlike(r"^\p{IsGreek}"), "greek").otherwise("latin")

    def pair(kind: Column, name: Column) -> Column:
        return F.struct(kind.alias("kind"), name.alias("name"))

    def word(w: Column, i: Column, last: Column) -> Column:
        of = F.when(i + 1 == last, F.concat(F.lit("family_"), script(w))).otherwise(
            F.concat_ws("_", F.lit("given"), gender, script(w))
        )
        return (
            F.when(w.rlike(rf"^{_INITIAL}$"), pair(F.lit("initial"), w))
            .when(w.rlike(r"^\p{Ll}"), pair(F.lit("particle"), w))
            .otherwise(pair(of, F.lower(w)))
        )

    words = bound(words_of(hit), lambda own: F.transform(own, lambda w, i: word(w, i, F.size(own))))
    plain = (
        F.when(kind == "email", F.lower(hit))
        .when(kind == "iban", F.replace(hit, F.lit(" "), F.lit("")))
        .when(kind == "ip", hit)
        .when(hit.startswith("+"), F.concat(F.lit("+"), digits_of(hit)))
        .otherwise(digits_of(hit))
    )
    return F.when(kind == "person", words).otherwise(F.array(pair(kind, plain)))


def named_parts(hit: Column) -> Column:
    """The parts that have surrogates of their own to keep apart."""
    return F.filter(parts_of(hit), lambda p: ~p["kind"].isin("initial", "particle"))


def _byte(stream: Column, i: Column) -> Column:
    return F.conv(F.substr(stream, i * 2 % 128 + 1, F.lit(2)), 16, 10).cast("int")


def _drawn(stream: Column, i: Column, alphabet: str) -> Column:
    return F.substr(F.lit(alphabet), _byte(stream, i) % len(alphabet) + 1, F.lit(1))


_LOWER = {"latin": "abcdefghijklmnopqrstuvwxyz", "cyrillic": "абвгдежзиклмнопрстуфхцчшэюя", "greek": "αβγδεζηθικλμνξοπρστυφχψω"}
#: Consonants and vowels that make names, and endings by gender.
_SOUNDS = {
    "latin": ("bdfgklmnprstvz", "aeiou", {"m": "nrsk", "f": "a", "n": "le"}),
    "cyrillic": ("бвгдзклмнпрст", "аеиоу", {"m": "нрлк", "f": "а", "n": "ие"}),
    "greek": ("βγδζκλμνπρστφ", "αεηιου", {"m": "ςν", "f": "α", "n": "ιο"}),
}


def _characters(text: Column, stream: Column, shift: int = 0) -> Column:
    """Letters to letters of their script, digits to digits, all else as it is."""

    def one(c: Column, i: Column) -> Column:
        i = i + shift
        return (
            F.when(c.rlike("[0-9]"), _drawn(stream, i, "0123456789"))
            .when(c.rlike(r"\p{IsCyrillic}"), _drawn(stream, i, _LOWER["cyrillic"]))
            .when(c.rlike(r"\p{IsGreek}"), _drawn(stream, i, _LOWER["greek"]))
            .when(c.rlike(r"\p{L}"), _drawn(stream, i, _LOWER["latin"]))
            .otherwise(c)
        )

    return F.array_join(F.transform(F.split(text, ""), one), "")


def _digits(text: Column, stream: Column) -> Column:
    """A digit for every digit; a number keeps a leading zero or has none, and ``+`` keeps the digit after it."""
    return F.array_join(
        F.transform(
            F.split(text, ""),
            lambda c, i: F.when(~c.rlike("[0-9]") | ((i == 1) & text.startswith("+")) | ((i == 0) & (c == "0")), c)
            .when(i == 0, _drawn(stream, i, "123456789"))
            .otherwise(_drawn(stream, i, "0123456789")),
        ),
        "",
    )


def _luhn(digits: Column) -> Column:
    """The weighted digit sum that a valid card number has as a multiple of ten."""

    def add(total: Column, row: Column) -> Column:
        twice = row["d"] * 2
        return total + F.when(row["i"] % 2 == 1, twice - F.when(twice > 9, 9).otherwise(0)).otherwise(row["d"])

    rows = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.struct(c.cast("int").alias("d"), i.alias("i")))
    return F.aggregate(rows, F.lit(0), add)


def _card(digits: Column, stream: Column) -> Column:
    """Valid if the original is."""

    def last(drawn: Column) -> Column:
        head = F.substr(drawn, F.lit(1), F.length(drawn) - 1)
        check = F.pmod(-_luhn(F.concat(head, F.lit("0"))), F.lit(10))
        return F.when(_luhn(digits) % 10 == 0, F.concat(head, check.cast("string"))).otherwise(drawn)

    return bound(_digits(digits, stream), last)


def _rest97(account: Column) -> Column:
    """An account number's remainder by 97, the first four characters put last and letters counted from 10."""
    moved = F.concat(F.substr(account, F.lit(5)), F.substr(account, F.lit(1), F.lit(4)))

    def add(rest: Column, c: Column) -> Column:
        return F.when(c.rlike("[0-9]"), rest * 10 + c.cast("int")).otherwise(rest * 100 + F.ascii(c) - 55) % 97

    return F.aggregate(F.split(moved, ""), F.lit(0), add)


def _iban(account: Column, stream: Column) -> Column:
    """Country kept, check digits right if the original's are."""

    def checked(body: Column) -> Column:
        country = F.substr(account, F.lit(1), F.lit(2))
        digits = F.lpad((98 - _rest97(F.concat(country, F.lit("00"), body))).cast("string"), 2, "0")
        keeps = F.when(_rest97(account) == 1, digits).otherwise(F.substr(account, F.lit(3), F.lit(2)))
        return F.concat(country, keeps, body)

    return bound(F.upper(_characters(F.substr(account, F.lit(5)), stream)), checked)


def _email(address: Column, stream: Column, key: str, attempt: Column) -> Column:
    """Local part by the address, domain by the domain, the last label kept; later attempts grow the local part."""
    local, domain = F.split_part(address, F.lit("@"), F.lit(1)), F.split_part(address, F.lit("@"), F.lit(2))
    top = F.substring_index(domain, ".", -1)
    under = F.substr(domain, F.lit(1), F.length(domain) - F.length(top))
    longer = F.when(attempt > 2, F.concat(*(_drawn(stream, F.lit(50 + i), _LOWER["latin"]) for i in range(4)))).otherwise("")
    return F.concat(
        _characters(local, stream),
        longer,
        F.lit("@"),
        bound(F.sha2(F.concat_ws(_SEP, F.lit(key), F.lit("domain"), domain), 512), lambda s: _characters(under, s)),
        top,
    )


def _name(kind: Column, stream: Column, attempt: Column) -> Column:
    """Three or four syllables in the script, more in late attempts, ending by gender."""

    def of(script: str) -> Column:
        consonants, vowels, ends = _SOUNDS[script]
        syllables = [F.concat(_drawn(stream, F.lit(2 * i), consonants), _drawn(stream, F.lit(2 * i + 1), vowels)) for i in range(4)]
        gender = (
            F.when(kind.startswith("given_m"), _drawn(stream, F.lit(20), ends["m"]))
            .when(kind.startswith("given_f"), F.concat(_drawn(stream, F.lit(21), consonants), F.lit(ends["f"])))
            .otherwise(F.concat(_drawn(stream, F.lit(21), consonants), _drawn(stream, F.lit(20), ends["n"])))
        )
        fourth = F.when(_byte(stream, F.lit(30)) % 2 == 0, syllables[3]).otherwise("")
        more = F.transform(
            F.sequence(F.lit(1), F.floor(attempt / GROWS).cast("int")),
            lambda i: F.concat(_drawn(stream, i * 2 + 32, consonants), _drawn(stream, i * 2 + 33, vowels)),
        )
        longer = F.when(attempt >= GROWS, F.array_join(more, "")).otherwise("")
        return F.concat(*syllables[:3], fourth, longer, gender)

    return F.when(kind.endswith("cyrillic"), of("cyrillic")).when(kind.endswith("greek"), of("greek")).otherwise(of("latin"))


#: Capitals that may be initials, by script.
_CAPITALS = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЭЮЯ", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ")


def initials(word: Column, key: str) -> Column:
    """Each letter moved on in its alphabet by a step that the key gives, so that different ones stay different."""
    step = int.from_bytes(hashlib.sha256(f"initials{_SEP}{key}".encode()).digest()[:4], "big")
    moved = "".join(a[1 + step % (len(a) - 1) :] + a[: 1 + step % (len(a) - 1)] for a in _CAPITALS)
    return F.translate(word, "".join(_CAPITALS), moved)


def surrogate(kind: Column, name: Column, key: str, attempt: Column) -> Column:
    """The keyed surrogate of a named thing; another attempt gives another one."""

    def of(stream: Column) -> Column:
        octets = F.array_join(F.transform(F.split(name, r"\."), lambda o, i: (_byte(stream, i) % 254 + 1).cast("string")), ".")
        more = F.array_join(
            F.transform(F.sequence(F.lit(1), (F.floor(attempt / GROWS) * 4).cast("int")), lambda i: _drawn(stream, i + 40, "0123456789")), ""
        )
        longer = F.when((attempt >= GROWS) & kind.isin("phone", "ssn", "card"), more).otherwise("")
        return (
            F.when(kind == "email", _email(name, stream, key, attempt))
            .when(kind == "iban", _iban(name, stream))
            .when(kind == "ip", octets)
            .when(kind == "card", F.concat(_card(name, stream), longer))
            .when(kind.isin("phone", "ssn"), F.concat(_digits(name, stream), longer))
            .otherwise(_name(kind, stream, attempt))
        )

    return bound(F.sha2(F.concat_ws(_SEP, F.lit(key), kind, name, attempt.cast("string")), 512), of)


def written_like(hit: Column, names: Column) -> Column:
    """The surrogates in the form of the hit: its marks, spaces, title and letter case."""

    def digits_in(number: Column) -> Column:
        plain = digits_of(number)
        return F.concat(within(plain), F.substr(plain, F.length(digits_of(hit)) + 1))

    def within(plain: Column) -> Column:
        return F.array_join(
            F.transform(
                F.split(hit, ""),
                lambda c, i: F.when(
                    c.rlike("[0-9]"), F.substr(plain, F.length(digits_of(F.substr(hit, F.lit(1), i + 1))), F.lit(1))
                ).otherwise(c),
            ),
            "",
        )

    def spaced(account: Column) -> Column:
        return F.array_join(
            F.transform(
                F.split(hit, ""),
                lambda c, i: F.when(c == " ", c).otherwise(
                    F.substr(account, F.length(F.replace(F.substr(hit, F.lit(1), i + 1), F.lit(" "), F.lit(""))), F.lit(1))
                ),
            ),
            "",
        )

    kind, first = kind_of(hit), F.element_at(names, 1)
    title = title_of(hit)
    rest = F.substr(hit, F.length(title) + 1)

    def cased(new: Column, old: Column) -> Column:
        return (
            F.when(old.rlike(rf"^(?:{_INITIAL}|\p{{Ll}}.*)$"), new)
            .when((old == F.upper(old)) & (F.length(old) > 1), F.upper(new))
            .otherwise(F.initcap(new))
        )

    people = F.concat(
        F.array_join(
            F.zip_with(F.split(rest, _WORD, -1), F.zip_with(names, words_of(hit), cased), lambda gap, n: F.concat(gap, F.coalesce(n, F.lit("")))),
            "",
        )
    )
    return (
        F.when(kind == "email", F.when(hit == F.upper(hit), F.upper(first)).otherwise(first))
        .when(kind == "ip", first)
        .when(kind == "iban", spaced(first))
        .when(kind == "person", F.concat(title, people))
        .otherwise(digits_in(first))
    )


def holds(text: Column) -> Column:
    """Whether a text has a hit; only a title can be one where there is neither a digit nor an at sign."""
    return F.when(text.contains("@") | text.rlike("[0-9]"), text.rlike(ANY)).otherwise(text.rlike(PERSON))


def found_in(text: Column) -> Column:
    """All hits of a text, in order."""
    return F.when(holds(text), F.regexp_extract_all(text, F.lit(ANY), F.lit(0))).otherwise(F.array().cast("array<string>"))


def settled(named: DataFrame, key: str, rounds: int = 64) -> DataFrame:
    """``(kind, name, attempt, surrogate)`` for every row of ``named(kind, name)``, all surrogates of a kind distinct.

    A surrogate that another name has, or that is itself a name in the corpus,
    is drawn again; of several names the one with the fewest attempts keeps
    it, then the smallest.  Only the distinct names are shuffled.
    """
    table = stored(
        named.distinct().withColumn("attempt", F.lit(0)).withColumn("surrogate", surrogate(F.col("kind"), F.col("name"), key, F.col("attempt")))
    )
    real = table.select("kind", F.col("name").alias("surrogate"))
    for _ in range(rounds):
        keeper = table.groupBy("kind", "surrogate").agg(F.min(F.struct("attempt", "name")).alias("keeper"), F.count(F.lit(1)).alias("n"))
        taken = real.join(keeper.select("kind", "surrogate").distinct(), ["kind", "surrogate"], "left_semi").withColumn("taken", F.lit(True))
        judged = table.join(keeper, ["kind", "surrogate"]).join(taken, ["kind", "surrogate"], "left")
        judged = judged.withColumn("again", F.col("taken").isNotNull() | (F.struct("attempt", "name") != F.col("keeper")))
        judged = stored(judged.select("kind", "name", "attempt", "surrogate", "again"))
        if not judged.where("again").limit(1).count():
            return table
        attempt = F.col("attempt") + F.col("again").cast("int")
        table = stored(
            judged.withColumn("attempt", attempt).withColumn(
                "surrogate", F.when(F.col("again"), surrogate(F.col("kind"), F.col("name"), key, F.col("attempt"))).otherwise(F.col("surrogate"))
            ).drop("again")
        )
    raise ValueError("a kind has more names than its format has surrogates")


def _genders(named: DataFrame) -> DataFrame:
    """``(kind, name, one)``: given names that stand behind titles of several genders, and the kind that all of them get.

    A name behind titles of one gender and behind neutral ones has that
    gender; one behind titles of both has none.
    """
    given = named.where(F.col("kind").startswith("given_")).select(
        "name", F.split("kind", "_")[1].alias("gender"), F.split("kind", "_")[2].alias("script")
    )
    seen = given.groupBy("name", "script").agg(F.collect_set("gender").alias("genders")).where(F.size("genders") > 1)
    has = lambda g: F.array_contains("genders", g)
    gender = F.when(has("m") & ~has("f"), "m").when(has("f") & ~has("m"), "f").otherwise("n")
    kind = lambda g: F.concat_ws("_", F.lit("given"), g, "script")
    return seen.select("name", kind(gender).alias("one"), F.explode(F.transform("genders", kind)).alias("kind"))


def with_surrogates(docs: DataFrame, text: str, key: str) -> DataFrame:
    """``docs`` with its text column rewritten and ``__entities`` (``array<struct<kind, start, end>>``) added.

    Mail addresses, phone, card, account and social security numbers, IP
    addresses and titled names are replaced by surrogates that depend on the
    key, the kind and the normal form alone: one thing has one surrogate in
    all documents, two things have two.  All name words behind a title belong
    to the name; where a document names a person with a title, the same name
    words without one are replaced in it too.  A given name has one surrogate,
    whatever titles it stands behind.  Places are those of the original, in
    code points, the end exclusive.  Other text stays as it is; a null text
    stays null and has no entity.  ``docs`` should be a stored table.

    First attempts are computed in place.  Only if collisions, or titles of
    several genders, gave some name another surrogate, those are joined to the
    documents that hold the names; otherwise no document is shuffled.
    """
    plain = docs.where(holds(F.col(text))).select(F.explode(found_in(F.col(text))).alias("hit"))
    named = plain.distinct().select(F.explode(named_parts(F.col("hit"))).alias("p")).select("p.kind", "p.name")
    named = stored(named.distinct())
    genders = stored(_genders(named))
    one = named.join(genders, ["kind", "name"], "left").select(F.coalesce("one", "kind").alias("kind"), "name")
    final = settled(one, key)
    later = final.where("attempt > 0").select("kind", "name", "surrogate")
    moved = genders.where("kind <> one").join(final.withColumnRenamed("kind", "one"), ["one", "name"])
    later = later.unionByName(moved.select("kind", "name", "surrogate"))
    if later.limit(1).count():
        numbered = docs.withColumn("__uid", F.monotonically_increasing_id())
        held = numbered.where(holds(F.col(text))).select("__uid", F.explode(found_in(F.col(text))).alias("hit"))
        held = held.select("__uid", F.explode(named_parts(F.col("hit"))).alias("p")).select("__uid", "p.kind", "p.name").distinct()
        maps = (
            held.join(later, ["kind", "name"])
            .groupBy("__uid")
            .agg(F.map_from_entries(F.collect_list(F.struct(F.concat_ws(_SEP, "kind", "name"), "surrogate"))).alias("__later"))
        )
        docs = numbered.join(maps, "__uid", "left").drop("__uid")
    else:
        docs = docs.withColumn("__later", F.lit(None).cast("map<string,string>"))

    source, people = F.col(text), F.col("__people")
    titled = F.filter(found_in(source), lambda h: kind_of(h) == "person")
    forms = F.filter(F.flatten(F.transform(titled, words_of)), lambda w: w.rlike(r"^\p{Lu}[^.]") & (F.length(w) > 1))
    out = docs.withColumns(
        {
            "__people": F.when(source.rlike(PERSON), F.array_distinct(F.flatten(F.transform(titled, named_parts)))),
            "__forms": F.when(source.rlike(PERSON), F.array_distinct(F.flatten(F.transform(forms, lambda w: F.array(w, F.upper(w)))))),
        }
    )
    # Names hold letters, apostrophes and hyphens only, so they are patterns of themselves.
    longest = F.array_sort("__forms", lambda a, b: F.length(b) - F.length(a))
    own = F.concat(F.lit(ANY + r"|(?<![\p{L}\p{N}])(?:"), F.array_join(longest, "|"), F.lit(r")(?![\p{L}\p{N}])"))
    pattern = F.when(F.size("__forms") > 0, own)

    def parts(hit: Column) -> Column:
        """What a hit names; a name without a title is what the document's titled names say."""
        alone = (kind_of(hit) == "person") & (title_of(hit) == "")
        known = F.filter(people, lambda p: p["name"] == F.lower(hit))
        return F.when(alone, F.slice(known, F.lit(1), F.lit(1))).otherwise(parts_of(hit))

    def new_name(p: Column) -> Column:
        return (
            F.when(p["kind"] == "initial", initials(p["name"], key))
            .when(p["kind"] == "particle", p["name"])
            .otherwise(
                F.coalesce(
                    F.try_element_at(F.col("__later"), F.concat_ws(_SEP, p["kind"], p["name"])),
                    surrogate(p["kind"], p["name"], key, F.lit(0)),
                )
            )
        )

    def replaced(hit: Column) -> Column:
        return bound(F.transform(parts(hit), new_name), lambda n: written_like(hit, n))

    hits, gaps = F.col("__hits"), F.col("__gaps")
    out = out.withColumn("__own", pattern)
    own = F.col("__own")
    every = F.when(own.isNotNull(), F.regexp_extract_all(source, own, F.lit(0))).otherwise(found_in(source))
    out = out.withColumn("__hits", F.coalesce(every, F.array().cast("array<string>")))
    between = F.when(own.isNotNull(), F.split(source, own, -1)).otherwise(F.split(source, ANY, -1))
    out = out.withColumn("__gaps", F.when(F.size("__hits") > 0, between))
    joined = F.concat(
        F.array_join(F.zip_with(F.slice(gaps, F.lit(1), F.size(hits)), hits, lambda g, h: F.concat(g, replaced(h))), ""),
        F.element_at(gaps, -1),
    )

    def place(done: Column, row: Column) -> Column:
        start = done["at"] + F.length(row["gap"])
        end = start + F.length(row["hit"])
        span = F.struct(kind_of(row["hit"]).alias("kind"), start.alias("start"), end.alias("end"))
        return F.struct(end.alias("at"), F.concat(done["spans"], F.array(span)).alias("spans"))

    none = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    rows = F.slice(F.arrays_zip(gaps.alias("gap"), hits.alias("hit")), F.lit(1), F.size(hits))
    spans = F.aggregate(rows, F.struct(F.lit(0).alias("at"), none.alias("spans")), place, lambda d: d["spans"])
    has = F.size(hits) > 0
    return out.withColumns(
        {"__entities": F.when(has, spans).otherwise(none), text: F.when(has, joined).otherwise(source)}
    ).drop("__hits", "__gaps", "__later", "__people", "__forms", "__own")

"""Personal data: keyed surrogates of the same type and form, in SQL functions only.

Detected: secrets after a key word, e-mail addresses, payment card numbers, IPv4 addresses,
telephone numbers (after + and a country code in any groups; without one in North American groups, French pairs,
German area code and number, or Spanish groups; not a bare run of digits that opens with 1 to 9), and names behind a
form of address. Each distinct entity (its normal form) gets one
surrogate in the whole corpus, from SHA-512 over key, type, normal form and a
collision counter:

* digits become digits and letters letters of the same case and script, in
  place, so separators, lengths and country codes stay;
* card numbers that satisfy the check digit keep satisfying it; octets stay
  within 1-254; hexadecimal secrets stay hexadecimal;
* names keep their form of address and get a given name of the same gender
  and script, and a made-up family name of the same script.

A mention gives only its layout (separators, form of address). The country code is read from the
normal form by the list of calling codes, and the gender is decided once for each entity: that of the
mentions which state one, "u" where both are stated or none.

The counter is 0 for nearly all entities. Each count draws anew and, where the layout alone may
not hold enough values, grows the surrogate: names by a syllable, addresses and secrets by a character from
the second count on, telephone numbers by a digit from the tenth. ``collisions`` finds, over the
distinct entities of the corpus, those whose surrogate equals another's or a
real entity, raises their counter and looks again until none is left; only
these exceptions, and names whose mentions differ in the gender they state, are joined back (broadcast within the checked bound, by
shuffle beyond it). All others are rewritten in the scan, so a hot entity
moves no rows. The patterns see each text once: its gaps and mentions are staged
in the shared folder (about the size of the input), and both the entities and the rewriting read them there.

Defined results: null text stays null, empty text empty; texts without
entities are unchanged. Equal entities get equal surrogates everywhere, unequal
ones unequal. Repeated rows are rewritten alike. An empty table gives an empty one. All
other columns stay, whatever their names; only an input column ``n_entities`` is replaced. A very long text is one
row of one task, in time in proportion to its length: no pattern recurses or rereads a run.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hebdo.llm.common import fresh, small_side, stage

# Forms of address by the gender they state (any: "u").
TITLES = {
    "f": ["Mrs.", "Mrs", "Ms.", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra.", "Госпожа"],
    "m": ["Mr.", "Mr", "Herr", "Monsieur", "Señor", "Sr.", "Господин"],
    "u": ["Dr.", "Prof."],
}
# Given names by gender and script.
GIVEN = {
    ("f", "latin"): ["Alma", "Bea", "Clara", "Dora", "Elena", "Freya", "Greta", "Hanna", "Ida", "Julia", "Karin",
                     "Laura", "Mara", "Nora", "Olga", "Paula"],
    ("m", "latin"): ["Adam", "Bruno", "Carl", "Dario", "Emil", "Felix", "Georg", "Hugo", "Ivan", "Jonas", "Karl",
                     "Leon", "Marco", "Nils", "Otto", "Paul"],
    ("u", "latin"): ["Alex", "Andrea", "Chris", "Dominique", "Eli", "Jean", "Jo", "Kim", "Luca", "Maxime", "Nico",
                     "Noa", "Robin", "Sam", "Sascha", "Toni"],
    ("f", "cyrillic"): ["Анна", "Вера", "Дарья", "Елена", "Ирина", "Мария", "Ольга", "Софья"],
    ("m", "cyrillic"): ["Антон", "Борис", "Иван", "Кирилл", "Максим", "Олег", "Павел", "Сергей"],
    ("u", "cyrillic"): ["Валя", "Женя", "Паша", "Саша", "Слава", "Тоня", "Шура", "Юля"],
}
# Syllables of made-up family names by script.
SYLLABLES = {
    "latin": ["ba", "den", "for", "gal", "hin", "jor", "kel", "lan", "mor", "nev", "pol", "ras", "sten", "tor", "vel", "wes"],
    "cyrillic": ["ба", "вен", "гор", "дал", "жин", "зор", "кел", "лан", "мор", "нев", "пол", "рас", "сте", "тор", "фел", "шин"],
}
#: Calling codes of one and two digits; all others have three.
CALLING = (r"^\+(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})")
TITLE = "|".join(t.replace(".", r"\.") for t in sorted((t for v in TITLES.values() for t in v), key=lambda t: (-len(t), t)))
#: A word of a name; a form of address is none.
NAME = r"(?!(?:%s)(?!\p{L}))\p{Lu}\p{Ll}+(?:-\p{Lu}\p{Ll}+)?" % TITLE
#: type -> Java regular expression; at one place the first that matches wins.
PATTERNS = {
    "secret": r"""(?i:\b(?:token|secret|password|passwd|api[_-]?key)\b)["']?\s*[:=]\s*["']?[A-Za-z0-9_/+.-]{8,}""",
    # the domain is one character class: a repeated group recurses once a label in Java, and a long text would end the JVM
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-][A-Za-z0-9.-]*\.[A-Za-z]{2,}",
    "card": r"(?<![\d.])\d(?:[ -]?\d){12,18}(?!\d)",
    "ip": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\.?\d)",
    "phone": r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]\d{3,4}(?!\d)"
             # country code and 7 to 14 digits in any groups
             r"|(?<![\w+])\+\d(?:(?:[ ./-]|[ .-]?\(|\)[ .-]?)?\d){7,14}(?!\d)"
             # national: pairs after 0 (French), 0 and area code before one long part (German), 0 unbroken, 9 digits with pairs (Spanish)
             r"|(?<![\w+.,/-])(?:0[1-9](?<gap>[ .-])\d\d(?:\k<gap>\d\d){3}|0[1-9]\d{1,4}[ /-]\d{5,9}|\(0[1-9]\d{1,4}\) ?\d{5,9}"
             r"|0[1-9]\d{8,10}|(?:[89]\d[ .-]\d{3}|[6-9]\d\d[ .-]\d\d)(?:[ .-]\d\d){2})(?!\d)",
    "key": r"(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|[0-9a-f]{40}|[0-9a-f]{64})(?![A-Za-z0-9])",
    "name": r"(?<!\p{L})(?:%s) %s(?: %s)?" % (TITLE, NAME, NAME),
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
SECRET_HEAD = r"""^(?i:[a-z_-]+)["']?\s*[:=]\s*["']?"""


def kind(mention: Column) -> Column:
    """Type of a mention found by ``ANY``; bare keys count as secrets."""
    return reduce(lambda rest, t: F.when(mention.rlike(f"^(?:{PATTERNS[t]})$"), t).otherwise(rest),
                  reversed([t for t in PATTERNS if t != "key"]), F.lit("secret"))


def normal_form(mention: Column, typ: Column) -> Column:
    """What makes two mentions the same entity: digits (with a leading +), lower case, or the bare secret or name."""
    return (F.when(typ == "card", F.regexp_replace(mention, r"\D", ""))
            .when(typ == "phone", F.regexp_replace(mention, r"(?!^\+)\D", ""))
            .when(typ == "secret", F.regexp_replace(mention, SECRET_HEAD, "")).when(typ == "email", F.lower(mention))
            .when(typ == "name", F.regexp_replace(mention, f"^(?:{TITLE}) ", "")).otherwise(mention))


def _number(digest: Column, i: Column | int, mod: int) -> Column:
    """A number below ``mod`` from the i-th pair of hex digits (two bytes, wrapping)."""
    at = (F.lit(i) if isinstance(i, int) else i) % 31 * 4 + 1
    return (F.conv(F.substr(digest, at, F.lit(4)), 16, 10).cast("int") % mod).cast("int")


def _mapped(norm: Column, digest: Column, letters: str) -> Column:
    """Digits to digits and letters to letters of the same case, place by place."""
    def one(c, i):
        seed = F.sha2(F.concat(digest, (i / 31).cast("int").cast("string")), 512)
        pick = lambda alphabet: F.substr(F.lit(alphabet), _number(seed, i, len(alphabet)) + 1, F.lit(1))
        return (F.when(c.between("0", "9"), pick("0123456789")).when(c.between("a", "z"), pick(letters))
                .when(c.between("A", "Z"), pick(letters.upper())).otherwise(c))
    return F.array_join(F.transform(F.split(norm, ""), one), "")


def _filled(mention: Column, digits: Column) -> Column:
    """``mention`` with its digits replaced, in order, by the array ``digits``."""
    return F.array_join(F.zip_with(F.split(mention, r"\d", -1), F.concat(digits, F.array(F.lit(""))),
                                   lambda gap, d: F.concat(gap, d)), "")


def _luhn(digits: Column) -> Column:
    """Sum of the check-digit rule over a digit string; a valid number gives a multiple of 10."""
    values = F.transform(F.reverse(F.split(digits, "")), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
        (c.cast("int") * 2) % 10 + F.floor(c.cast("int") / 5).cast("int")))
    return F.aggregate(values, F.lit(0), lambda a, v: a + v)


def _card(mention: Column, norm: Column, digest: Column) -> Column:
    """Same separators and first digit; the last digit restores the check where it held."""
    new = F.transform(F.split(norm, ""), lambda c, i: F.when(i == 0, c).otherwise(_number(digest, i, 10).cast("string")))
    body = F.slice(new, F.lit(1), F.size(new) - 1)
    check = (10 - _luhn(F.concat(F.array_join(body, ""), F.lit("0"))) % 10) % 10
    return _filled(mention, F.when(_luhn(norm) % 10 == 0, F.concat(body, F.array(check.cast("string")))).otherwise(new))


def _grown(digest: Column, n: Column, alphabet: str) -> Column:
    """``n`` further characters, none for 0 or less: what a short layout grows by where its values are used up."""
    pick = lambda i: F.substr(F.lit(alphabet), _number(F.sha2(digest, 512), i, len(alphabet)) + 1, F.lit(1))
    return F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(1), n), pick), "")).otherwise("")


def _phone(mention: Column, norm: Column, digest: Column, bump: Column) -> Column:
    """New digits after the country code or the leading 0; 0 and 1 never open the number.

    From the tenth count on each adds a digit at the end.
    """
    code = F.greatest(F.length(F.regexp_extract(norm, CALLING, 0)) - 1, norm.startswith("0").cast("int"))
    new = F.transform(F.split(F.ltrim(norm, F.lit("+")), ""), lambda c, i: F.when(i < code, c).when(
        i == code, (_number(digest, i, 8) + 2).cast("string")).otherwise(_number(digest, i, 10).cast("string")))
    last = F.concat(F.element_at(new, -1), _grown(digest, bump - 9, "0123456789"))
    return _filled(mention, F.concat(F.slice(new, F.lit(1), F.size(new) - 1), F.array(last)))


def stated_gender(mention: Column) -> Column:
    """Gender that the form of address of a name states."""
    title = F.regexp_extract(mention, r"^(\S+) ", 1)
    return F.when(title.isin(TITLES["f"]), "f").when(title.isin(TITLES["m"]), "m").otherwise("u")


def _name(mention: Column, norm: Column, digest: Column, bump: Column, gender: Column) -> Column:
    """Form of address of the mention, name from the entity alone; each count of the counter adds a syllable."""
    title = F.regexp_extract(mention, r"^(\S+) ", 1)
    cyr = norm.rlike(r"^\p{IsCyrillic}")
    arr = lambda values: F.array(*[F.lit(v) for v in values])

    def parts(script):
        given = reduce(lambda rest, g: F.when(gender == g, F.element_at(arr(GIVEN[g, script]), _number(
            digest, 0, len(GIVEN[g, script])) + 1)).otherwise(rest), ("f", "m"),
            F.element_at(arr(GIVEN["u", script]), _number(digest, 0, len(GIVEN["u", script])) + 1))
        syl = arr(SYLLABLES[script])
        one = lambda k: F.element_at(syl, _number(digest, k, 16) + 1)
        more = F.when(bump > 0, F.array_join(F.transform(F.sequence(F.lit(5), bump + 4), one), "")).otherwise("")
        family = F.initcap(F.concat(*[one(k) for k in (1, 2, 3, 4)], more))
        two = norm.contains(" ")
        return F.when(two, F.concat_ws(" ", title, given, family)).otherwise(F.concat_ws(" ", title, family))

    return F.when(cyr, parts("cyrillic")).otherwise(parts("latin"))


def digest_of(typ: Column, norm: Column, bump: Column, key: str) -> Column:
    return F.sha2(F.concat_ws("\x1f", F.lit(key), typ, norm, bump.cast("string")), 512)


def surrogate(mention: Column, typ: Column, norm: Column, digest: Column, bump: Column, gender: Column) -> Column:
    """Replacement for a mention, of its type and layout; its normal form follows from the other arguments alone."""
    alphabet = "abcdefghijklmnopqrstuvwxyz"
    hexa = norm.rlike("^[0-9a-f]+$|^[0-9A-F]+$")
    bare = F.when(hexa, _mapped(norm, digest, "abcdef")).otherwise(_mapped(norm, digest, alphabet))
    tail = F.regexp_extract(norm, r"(\.[a-z]{2,})$", 1)
    mail = F.concat(_mapped(F.substr(norm, F.lit(1), F.length(norm) - F.length(tail)), digest, alphabet), tail)
    mail = F.concat(F.substring_index(mail, "@", 1), _grown(digest, bump - 1, alphabet), F.lit("@"), F.substring_index(mail, "@", -1))
    octets = F.array_join(F.transform(F.split(mention, r"\."), lambda c, i: (
        _number(digest, i, 254) + 1).cast("string")), ".")
    return (F.when(typ == "email", mail).when(typ == "ip", octets).when(typ == "card", _card(mention, norm, digest))
            .when(typ == "phone", _phone(mention, norm, digest, bump)).when(typ == "name", _name(mention, norm, digest, bump, gender))
            .otherwise(F.concat(F.regexp_extract(mention, SECRET_HEAD, 0), bare, _grown(digest, bump - 1, "0123456789"))))


def pieces(text: Column) -> Column:
    """array<string> of a text: gap, mention, gap and so on, up to a last gap.

    One pass of the patterns: mentions are set between NUL characters, and the text is cut there.
    A text that has NUL characters of its own is read twice instead, for its mentions and for its gaps.
    """
    marked = F.split(F.regexp_replace(text, ANY, "\0$0\0"), "\\x00", -1)
    found = F.concat(F.regexp_extract_all(text, F.lit(ANY), F.lit(0)), F.array(F.lit("")))
    pairs = F.flatten(F.zip_with(F.split(text, ANY, -1), found, lambda g, m: F.array(g, m)))
    return F.when(F.contains(text, F.lit("\0")), F.slice(pairs, F.lit(1), F.size(pairs) - 1)).otherwise(marked)


def mentions(cut: Column) -> Column:
    """array<struct<mention, type, norm>> of the ``pieces`` of a text, in order."""
    found = F.filter(cut, lambda _, i: i % 2 == 1)
    typed = F.transform(found, lambda m: F.struct(m.alias("mention"), kind(m).alias("type")))
    return F.transform(typed, lambda m: F.struct(m["mention"].alias("mention"), m["type"].alias("type"),
                                                 normal_form(m["mention"], m["type"]).alias("norm")))


def cut_texts(docs: DataFrame) -> tuple[DataFrame, str, str]:
    """``docs`` with the gaps and mentions of each text, staged, and the names of these two columns.

    All later steps read this table, so the patterns see each text once. Both columns are null, and ``text``
    is kept, where there is no mention; elsewhere gaps and mentions hold the text, and ``text`` is null.
    """
    cut, gaps, found = fresh(docs, "_c", "_g", "_m")
    text = F.col("text").cast("string")
    work = docs.withColumn("text", text).withColumn(cut, pieces(text))
    some = F.size(cut) > 1
    work = work.select(*[F.when(~F.coalesce(some, F.lit(False)), F.col("text")).alias("text") if c == "text" else F.col(f"`{c}`")
                         for c in docs.columns],
                       F.when(some, F.filter(cut, lambda _, i: i % 2 == 0)).alias(gaps),
                       F.when(some, mentions(F.col(cut))).alias(found))
    return stage(work, "pii-cut"), gaps, found


def entities(work: DataFrame, found: str = "_m") -> DataFrame:
    """Distinct (type, norm) of the mentions in column ``found`` with one mention each, reduced before the shuffle.

    ``gender`` is the entity's; ``mixed`` says that not every mention states it and a given name depends on it.
    """
    found = work.select(F.explode(found).alias("m"))
    states = lambda g: F.max((stated_gender(F.col("m.mention")) == g).cast("int")).alias(g)
    found = found.groupBy(F.col("m.type").alias("type"), F.col("m.norm").alias("norm")).agg(
        F.min("m.mention").alias("mention"), states("f"), states("m"), states("u"))
    gender = F.when(F.col("f") > F.col("m"), "f").when(F.col("m") > F.col("f"), "m").otherwise("u")
    mixed = (F.col("type") == "name") & F.col("norm").contains(" ") & (F.col("f") + F.col("m") + F.col("u") > 1)
    return found.select("type", "norm", "mention", gender.alias("gender"), mixed.alias("mixed"))


def collisions(found: DataFrame, key: str, rounds: int = 60) -> DataFrame:
    """(type, norm, bump, gender) of the entities whose surrogate needs a counter above 0 or whose mentions are ``mixed``.

    Of entities with one surrogate, that with the least hash of its normal form keeps it;
    a surrogate that is itself an entity of the corpus goes to nobody. Each
    round looks at all entities again with the counters of the last. Names, addresses,
    secrets and telephone numbers grow with the counter, so they always resolve;
    card numbers and octets keep their length, and their values run out only where the
    corpus holds most of all card numbers of a length, or of all addresses.
    """
    found = stage(found, "pii-entities")
    own = found.select(F.col("type").alias("t"), F.col("norm").alias("n"))
    bumped = None
    for _ in range(rounds):
        now = found if bumped is None else found.join(small_side(bumped), ["type", "norm"], "left")
        bump = F.lit(0) if bumped is None else F.coalesce("bump", F.lit(0))
        now = now.select("type", "norm", "mention", "gender", bump.alias("bump")).withColumn(
            "digest", digest_of(F.col("type"), F.col("norm"), F.col("bump"), key))
        now = now.select("type", "norm", "bump", normal_form(surrogate(
            F.col("mention"), F.col("type"), F.col("norm"), F.col("digest"), F.col("bump"), F.col("gender")), F.col("type")).alias("new"))
        now = stage(now, "pii-surrogates")
        order = F.struct(F.xxhash64("norm"), "norm")
        keep = now.groupBy("type", "new").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n"))
        clash = keep.filter("n > 1").select("type", "new", F.col("first.norm").alias("first"))
        twice = now.join(clash, ["type", "new"]).filter(F.col("norm") != F.col("first")).select("type", "norm", "bump")
        real = now.join(own, (F.col("type") == F.col("t")) & (F.col("new") == F.col("n")), "left_semi").select(
            "type", "norm", "bump")
        again = stage(twice.union(real).distinct(), "pii-clashes")
        if again.isEmpty():
            break
        raised = again.select("type", "norm", (F.col("bump") + 1).alias("bump"))
        old = bumped.join(again, ["type", "norm"], "left_anti") if bumped is not None else None
        bumped = stage(raised if old is None else raised.unionByName(old), "pii-bumps")
    else:
        raise RuntimeError(f"surrogates still collide after {rounds} rounds: the corpus holds most card numbers of a length or most addresses")
    if bumped is None:
        found = found.filter("mixed").withColumn("bump", F.lit(0))
    else:
        found = found.join(small_side(bumped), ["type", "norm"], "left").filter("mixed or bump is not null")
    return stage(found.select("type", "norm", F.coalesce("bump", F.lit(0)).alias("bump"), "gender"), "pii-exceptions")


def replace(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with ``text`` rewritten and ``n_entities`` added."""
    work, gaps, found = cut_texts(docs)
    exceptions = collisions(entities(work, found), key)
    (bumps,) = fresh(work, "_bumps")
    n = exceptions.count()
    if n == 0:
        own = lambda m: F.lit(None).cast("struct<bump:int,gender:string>")
    else:
        bound = F.concat_ws("\x1f", "type", "norm")
        work = _with_bumps(work, exceptions.select(bound.alias("_e"), F.struct("bump", "gender").alias("_b")), n, found, bumps)
        own = lambda m: F.element_at(bumps, F.concat_ws("\x1f", m["type"], m["norm"]))
    bump = lambda m: F.coalesce(own(m)["bump"], F.lit(0))
    keyed = F.transform(found, lambda m: m.withField("bump", bump(m)).withField(
        "gender", F.coalesce(own(m)["gender"], stated_gender(m["mention"]))).withField(
        "digest", digest_of(m["type"], m["norm"], bump(m), key)))
    new = F.transform(keyed, lambda m: surrogate(m["mention"], m["type"], m["norm"], m["digest"], m["bump"], m["gender"]))
    out = F.array_join(F.zip_with(gaps, F.concat(new, F.array(F.lit(""))), lambda g, s: F.concat(g, s)), "")
    return (work.withColumn("text", F.when(F.col(found).isNull(), F.col("text")).otherwise(out))
            .withColumn("n_entities", F.when(F.col(found).isNull(), 0).otherwise(F.size(found)).cast("long"))
            .drop(gaps, found, bumps))


def _with_bumps(work: DataFrame, exceptions: DataFrame, n: int, found: str, bumps: str) -> DataFrame:
    """Attach map ``bumps`` of the row's own exceptions: one row per distinct list of mentions takes part."""
    key = F.sha2(F.to_json(found), 256)
    (name,) = fresh(work, "_k")
    pairs = (work.filter(F.col(found).isNotNull()).select(key.alias("_k"), F.explode(F.array_distinct(F.transform(
        found, lambda m: F.concat_ws("\x1f", m["type"], m["norm"])))).alias("_e")).distinct()
        .join(small_side(exceptions, n), "_e"))
    maps = stage(pairs.groupBy(F.col("_k").alias(name)).agg(
        F.map_from_entries(F.collect_set(F.struct("_e", "_b"))).alias(bumps)), "pii-maps")
    return work.withColumn(name, key).join(small_side(maps), name, "left").drop(name)

"""PII: surrogate generation, in DataFrame functions only.

Detected entities give way to keyed surrogates of their own kind: an address of mail
stays one, a card number passes the check its original passes, a person keeps gender and
script, and every surface keeps its format (separators, letter case, country code).

1. All surfaces are taken from the texts and reduced to their canonical form, so that
   two ways of writing one entity share one surrogate in the whole corpus (coreference).
2. Each distinct entity draws a surrogate from a keyed hash. Where two entities drew the
   same one, or one drew what is itself an entity of the corpus, all but the first draw
   again with the next count, until no collision is left (distinctness). Names and mail
   boxes grow with the count, so there is room for any number of them. Numbers keep their
   length: where a corpus holds so many of one length that ``ROUNDS`` draws find no free
   one, those left change places in a keyed order, which is distinct as it stands.
3. Surrogates are joined to the distinct surfaces of each text, and the pieces between
   and in place of the matches are put together again.

Persons draw by the word: a family name has one surrogate wherever it stands, so a lone
surname meets its full name. A text that names a person behind a title loses the words of
that name everywhere, with a title or without.

Only texts that hold an entity are shuffled. Equal texts share their surfaces, so many
copies cost one. The number of collisions is all the driver sees.

Defined results: null and empty texts stay as they are. Repeated rows are rewritten
alike. Other columns pass through untouched, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import column, fresh_name, read, written

KEY = "surrogate-key-1"
ROUNDS = 6  # draws of an entity whose surrogates have a fixed length before it changes places with others like it

# Titles announce a person; the name after them is replaced. By gender, "u" where they tell none.
TITLES = {
    "m": ("Mr", "Mister", "Sir", "Herr", "Monsieur", "Señor", "Sr", "Signor", "г-н", "Г-н", "господин", "Господин", "κύριος", "Κύριος"),
    "f": ("Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Mme", "Señora", "Sra", "Signora", "г-жа", "Г-жа", "госпожа", "Госпожа", "κυρία", "Κυρία"),
    "u": ("Dr", "Doctor", "Docteur", "Prof", "Professor", "Professeur", "Profesor", "Rev", "Reverend", "Judge", "Captain", "д-р", "Д-р", "доктор", "Доктор", "проф", "Проф", "профессор", "Профессор", "δρ", "Δρ", "καθηγητής", "Καθηγητής"),
}
# Parts of surrogate names by script; given names by gender.
GIVEN = {
    "latin-m": "Adam Albert Anton Bruno Carl Daniel David Edgar Emil Eric Felix Frank George Henry Hugo Ivan Jacob John Julian Karl Leo Leon Louis Lucas Mark Martin Max Michael Nathan Noah Oliver Oscar Otto Paul Peter Philip Robert Samuel Simon Thomas Victor Walter",
    "latin-f": "Ada Alice Amelia Anna Beatrice Bella Carla Clara Diana Edith Elena Elise Emma Eva Flora Grace Hanna Helen Ida Irene Iris Jane Julia Karin Laura Lena Lily Linda Lucia Maria Martha Mia Monica Nadia Nora Olga Paula Rosa Ruth Sara Sofia Teresa Vera",
    "cyrillic-m": "Александр Алексей Андрей Антон Борис Виктор Глеб Денис Дмитрий Егор Иван Игорь Кирилл Максим Никита Олег Павел Пётр Роман Сергей Степан Фёдор Юрий",
    "cyrillic-f": "Алина Алла Анна Вера Галина Дарья Елена Жанна Зоя Инна Ирина Карина Лидия Марина Мария Нина Ольга Полина Раиса Софья Тамара Ульяна Юлия",
    "greek-m": "Αλέξης Ανδρέας Γιάννης Γιώργος Δημήτρης Ηλίας Κώστας Λεωνίδας Μάριος Νίκος Πέτρος Σπύρος Στέφανος",
    "greek-f": "Άννα Βασιλική Γεωργία Δήμητρα Ειρήνη Ελένη Ζωή Ιωάννα Κατερίνα Μαρία Νίκη Σοφία Χριστίνα",
}
GIVEN |= {f"{s}-u": GIVEN[f"{s}-m"] + " " + GIVEN[f"{s}-f"] for s in ("latin", "cyrillic", "greek")}
SYLLABLES = {
    "latin": "bar ben dal der fen gar hol kem lan mar nor pel ras sel tor van wen zan",
    "cyrillic": "бар бел вол гор дан зор кор лен мал нор пет род сем тол хар чер",
    "greek": "βαρ γαλ δημ θεο καλ λαμ μαν νικ παπ ραλ σταθ τσα φωτ χατ",
}
ENDINGS = {"latin": "", "cyrillic-m": "ов", "cyrillic-f": "ова", "cyrillic-u": "енко", "greek-m": "ης", "greek-f": "η", "greek-u": "ίδη"}
# Words of names that are no name by themselves.
PARTICLES = "al bin da de del della den der des di do dos du el ibn la le los van von zu".split()

_TITLE = "|".join(t for ts in TITLES.values() for t in ts)
_START = "[" + "".join(sorted({t[0] for ts in TITLES.values() for t in ts})) + "]"
# A title is no name, nor is the 's after one a part of it.
_WORD = r"(?!(?:" + _TITLE + r")(?!\p{L}))\p{Lu}(?:(?![\x27’-](?:s(?!\p{L})|(?!\p{L})))[\p{L}\x27’-])+"
_BETWEEN = r"(?:(?:de|de la|de los|del|della|di|da|dos|van|van de|van den|van der|von|von der|bin|ibn|al) )?"
_NAME = rf"{_WORD}(?: {_BETWEEN}{_WORD}){{0,2}}"
# Kinds in order of preference where two could begin at one place.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "card": r"(?<![A-Za-z0-9.-])(?:\d{4}([ -])\d{4}\1\d{4}\1\d{1,7}|\d{4}([ -])\d{6}\2\d{5}|\d{13,19})(?![A-Za-z0-9])(?![.-]\d)",
    "ip": r"(?<![\d.])(?<![vV])(?<![vV]ersion )(?<![vV]\. )(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\.?\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?!-?\d)",
    # A country code or an area in brackets, or three, three and four digits with one sign between: plain numbers, lists
    # of years and versions have none of them.
    "phone": r"(?<![A-Za-z0-9-])(?:(?:\+\d{1,3}[ .-]?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])|\(\d{2,4}\)[ .-]?)\d{3,4}[ .-]\d{3,4}"
    r"|[2-9]\d{2}(?:-[2-9]\d{2}-|\.[2-9]\d{2}\.| [2-9]\d{2} )\d{4})(?!-?[A-Za-z0-9])",
    "intl": r"(?<![A-Za-z0-9+])\+(?=\d(?:[ .-]?\d){7})\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?!\d)",
    # Only at a capital letter are titles looked for.
    "person": r"(?=\p{Lu})(?<=(?<!\p{L})(?:" + _TITLE + r")\.? )" + _NAME,
}


ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())  # only the card pattern has groups
# Cheap signs without which no pattern can match; an ip may be of single digits.
SIGN = r"@|\d{2}|\d\.\d|(?=" + _START + r")(?:" + _TITLE + r")\.? "


def digits(c: Column) -> Column:
    return F.regexp_replace(c, r"[^0-9]", "")


def kind_of(surface: Column) -> Column:
    """The first kind whose pattern covers the whole surface; what has none is a person."""
    out = F
    for kind, pattern in PATTERNS.items():
        if kind != "person":
            out = out.when(surface.rlike(f"^(?:{pattern})$"), F.lit(kind))
    return out.otherwise(F.lit("person"))


def gender_of(title: Column) -> Column:
    return F.when(title.isin(*TITLES["f"]), "f").when(title.isin(*TITLES["u"]), "u").otherwise("m")


def canonical(kind: Column, surface: Column, gender: Column) -> Column:
    """One form for all ways to write an entity."""
    number = digits(surface)
    # A number of ten digits is the same with the country code 1 and without it.
    phone = F.when(number.rlike("^1[0-9]{10}$"), F.substring(number, 2, 10)).otherwise(number)
    return (
        F.when(kind == "email", F.lower(surface))
        .when(kind == "iban", F.regexp_replace(surface, " ", ""))
        .when(kind == "ip", surface)
        .when(kind.isin("phone", "intl"), phone)
        .when(kind == "person", F.concat(gender, F.lit(":"), F.lower(surface)))
        .otherwise(number)
    )


def _nibbles(seed: Column) -> Column:
    """192 hexadecimal digits that depend on the seed."""
    return F.concat(*[F.sha2(F.concat(seed, F.lit(f"#{i}")), 256) for i in range(3)])


def _value(stream: Column, i: Column) -> Column:
    """A number from 0 to 255 at place ``i`` (from 0, wrapping) of the stream."""
    return F.conv(F.substring(stream, (i % 96 * 2 + 1).cast("int"), F.lit(2)), 16, 10).cast("int")


def _redraw(text: Column, stream: Column) -> Column:
    """``text`` with each ASCII letter and digit replaced by another of its class."""
    # Streams hold 96 places; longer texts take them again, shifted by the round.
    chars = F.filter(F.split(text, ""), lambda x: x != "")

    def one(x, i):
        v = _value(stream, i) + F.floor(i / 96).cast("int")
        return (
            F.when(x.rlike("[0-9]"), F.substring(F.lit("0123456789"), (v % 10 + 1).cast("int"), F.lit(1)))
            .when(x.rlike("[a-z]"), F.substring(F.lit("abcdefghijklmnopqrstuvwxyz"), (v % 26 + 1).cast("int"), F.lit(1)))
            .when(x.rlike("[A-Z]"), F.substring(F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), (v % 26 + 1).cast("int"), F.lit(1)))
            .otherwise(x)
        )

    return F.array_join(F.transform(chars, one), "")


def _luhn_sum(number: Column, doubled_last: bool) -> Column:
    """Sum of the digits by Luhn's rule; ``doubled_last``: the last digit counts twice."""
    places = F.reverse(F.filter(F.split(number, ""), lambda x: x != ""))

    def worth(x, i):
        v = x.cast("int") * F.when(i % 2 == (0 if doubled_last else 1), 2).otherwise(1)
        return F.when(v > 9, v - 9).otherwise(v)

    return F.aggregate(F.transform(places, worth), F.lit(0), lambda a, x: a + x)


def draw(current: DataFrame, key: str) -> DataFrame:
    """``kind, canon, attempt`` with the ``surrogate`` of each entity at its attempt, in canonical form."""
    kind, canon, stream, changed = (F.col(c) for c in ("kind", "canon", "stream", "changed"))
    domain = F.when(kind == "email", F.substring_index(canon, "@", -1))
    # Domains are redrawn by themselves: one domain stays one domain.
    steps = (
        current.withColumn("stream", _nibbles(F.concat_ws("|", F.lit(key), kind, canon, F.col("attempt").cast("string"))))
        .withColumn("domain", domain)
        .withColumn("mails", _nibbles(F.concat(F.lit(f"{key}|domain|"), "domain")))
        .withColumn("changed", _redraw(F.when(kind == "email", F.substring_index(canon, "@", 1)).otherwise(canon), stream))
    )
    # A redrawn mail box grows by a letter a time, as short ones of a domain are few.
    grown = F.substring(F.translate(stream, "0123456789", "ghijklmnop"), F.lit(1), F.col("attempt"))
    mail = F.concat(changed, grown, F.lit("@"), _redraw(F.regexp_replace("domain", r"\.[^.]*$", ""), F.col("mails")), F.lit(".example"))
    rest = lambda n: F.concat(F.substring(canon, 1, n), F.substring(changed, F.lit(n + 1), F.length(canon)))
    body = F.concat(F.substring(canon, 1, 1), F.substring(changed, F.lit(2), F.length(canon) - 2))
    check = ((10 - _luhn_sum(body, True) % 10) % 10).cast("string")
    card = F.when(_luhn_sum(canon, False) % 10 == 0, F.concat(body, check)).otherwise(rest(1))
    ip = F.concat_ws(".", *[(_value(stream, F.lit(i)) % 254 + 1).cast("string") for i in range(4)])
    # No area code or exchange begins with 0 or 1; longer numbers keep two digits of their country.
    first, fourth = ((_value(stream, F.lit(i)) % 8 + 2).cast("string") for i in (90, 91))
    phone = F.when(
        F.length(canon) == 10, F.concat(first, F.substring(changed, 2, 2), fourth, F.substring(changed, 5, 6))
    ).otherwise(rest(2))
    surrogate = (
        F.when(kind == "email", mail).when(kind == "card", card).when(kind == "ip", ip)
        .when(kind == "phone", phone).when(kind == "iban", rest(2))
        .when(kind == "word", _name_word(canon, stream, F.col("attempt"))).otherwise(changed)
    )
    return steps.select("kind", "canon", "attempt", surrogate.alias("surrogate"))


def _name_word(canon: Column, stream: Column, attempt: Column) -> Column:
    """A given or family name of the script and gender of a word, in small letters.

    Family names have three syllables; each further attempt puts one more before the name.
    """
    parts = F.split(canon, ":")
    role, gender, name = parts[0], parts[1], parts[2]
    script = F.when(name.rlike(r"\p{IsCyrillic}"), "cyrillic").when(name.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")

    def pick(table: dict[str, str], name: Column, i: Column) -> Column:
        words = F.create_map(*[x for k, v in table.items() for x in (F.lit(k), F.split(F.lit(v), " "))])[name]
        return F.element_at(words, (_value(stream, i) % F.size(words) + 1).cast("int"))

    def syllables(n: Column) -> Column:
        return F.array_join(F.transform(F.array_repeat(F.lit(0), n), lambda _, i: pick(SYLLABLES, script, i + 1)), "")

    ending = F.create_map(*[x for k, v in ENDINGS.items() for x in (F.lit(k), F.lit(v))])
    family = F.concat(syllables(attempt + 3), F.coalesce(ending[script], ending[F.concat(script, F.lit("-"), gender)]))
    given = F.concat(syllables(attempt), F.lower(pick(GIVEN, F.concat(script, F.lit("-"), gender), F.lit(0))))
    return F.when(role == "g", given).otherwise(family)


def _words(canon: Column) -> Column:
    """The words of a person, each with its role (given or family) and gender; Latin family names have none."""
    words = F.split(F.substring(canon, F.lit(3), F.length(canon)), " ")
    gender = F.substring(canon, 1, 1)

    def word(x, i):
        role = F.when((i == 0) & (F.size(words) > 1), "g").otherwise("f")
        bare = (role == "f") & ~x.rlike(r"\p{IsCyrillic}|\p{IsGreek}")
        return F.struct(role.alias("role"), F.when(bare, "").otherwise(gender).alias("gender"), x.alias("word"))

    return F.transform(words, word)


def _written_as(surface: Column, name: Column) -> Column:
    """A name in small letters, in the letter case of a surface."""
    upper, lower = (surface == F.upper(surface)) & (surface != F.lower(surface)), surface == F.lower(surface)
    return F.when(upper, F.upper(name)).when(lower, name).otherwise(F.initcap(name))


def render(kind: Column, surface: Column, surrogate: Column) -> Column:
    """The surrogate in the format of a surface."""
    fill = F.when(kind.isin("card", "ssn", "phone", "intl"), digits(surrogate)).otherwise(surrogate)
    places = F.filter(F.split(surface, ""), lambda x: x != "")
    kept = F.greatest(F.length(digits(surface)) - F.length(fill), F.lit(0))  # a country code that is no part of it

    def place(a, x):
        n = a["n"]
        return F.struct(
            F.concat(a["text"], F.when(x.rlike("[0-9]") & (n >= kept), F.substring(fill, n - kept + 1, F.lit(1))).otherwise(x)).alias("text"),
            (n + x.rlike("[0-9]").cast("int")).alias("n"),
        )

    numbers = F.aggregate(places, F.struct(F.lit("").alias("text"), F.lit(0).alias("n")), place)["text"]

    def letter(a, x):
        n = a["n"]
        return F.struct(
            F.concat(a["text"], F.when(x == " ", x).otherwise(F.substring(fill, n + 1, F.lit(1)))).alias("text"), (n + (x != " ").cast("int")).alias("n")
        )

    iban = F.aggregate(places, F.struct(F.lit("").alias("text"), F.lit(0).alias("n")), letter)["text"]
    upper = (surface == F.upper(surface)) & (surface != F.lower(surface))
    mail = F.when(upper, F.upper(fill)).otherwise(fill)
    person = _written_as(surface, F.substring(fill, F.lit(3), F.length(fill)))
    return F.when(kind == "email", mail).when(kind == "iban", iban).when(kind == "ip", fill).when(kind == "person", person).otherwise(numbers)


def _cut(t: Column, pattern: Column | None = None) -> Column:
    """The text as pairs of a gap and the surface after it; the last surface is null."""
    pattern = F.lit(ANY) if pattern is None else pattern
    return F.arrays_zip(F.split(t, pattern), F.regexp_extract_all(t, pattern, F.lit(0))).cast("array<struct<gap:string,surface:string>>")


def entities(docs: DataFrame, text: str) -> DataFrame:
    """``id`` (a hash of the text), ``surface, kind, canon``: the distinct surfaces of each text."""
    t = column(docs, text)
    hits = docs.filter(t.rlike(SIGN)).select(t.alias("t")).filter(F.col("t").rlike(ANY))
    at = hits.select(
        F.md5("t").alias("id"),
        F.explode(_cut(F.col("t"))).alias("m"),
    ).select("id", "m.surface", F.regexp_extract("m.gap", rf"(?:^|[^\p{{L}}])({_TITLE})\.? $", 1).alias("title"))
    at = at.filter(F.col("surface").isNotNull()).select("id", "surface", gender_of(F.col("title")).alias("gender"))
    at = at.withColumn("kind", kind_of(F.col("surface")))
    at = at.withColumn("gender", F.when(F.col("kind") == "person", F.col("gender")).otherwise(""))
    return at.select("id", "surface", "kind", "gender", canonical(F.col("kind"), F.col("surface"), F.col("gender")).alias("canon")).distinct()


FIXED = ("card", "iban", "ip", "phone", "ssn")


def _moved(left: DataFrame, key: str) -> DataFrame:
    """``kind, canon, surrogate``: each number of those left takes the next one's place, by length and check, in a keyed order.

    They are few where numbers are long, and no more than there are numbers where they are
    short. Whatever is alone of its length stays out. Others' surrogates are no entities, so
    none of these meets one.
    """
    check = F.when(F.col("kind") == "card", _luhn_sum(F.col("canon"), False) % 10 == 0).otherwise(F.lit(True))
    head = F.when(F.col("kind") == "iban", F.substring("canon", 1, 2)).otherwise("")
    group = Window.partitionBy("kind", "head", "size", "check").orderBy(F.sha2(F.concat(F.lit(f"{key}|place|"), "canon"), 256), "canon")
    whole = group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    placed = left.filter(F.col("kind").isin(*FIXED)).select("kind", "canon", head.alias("head"), F.length("canon").alias("size"), check.alias("check"))
    next_ = F.coalesce(F.lead("canon").over(group), F.first("canon").over(whole))
    return placed.withColumn("surrogate", next_).filter("surrogate <> canon").select("kind", "canon", "surrogate")


def surrogates(found: DataFrame, key: str = KEY) -> DataFrame:
    """``kind, canon, surrogate``: one for each entity, all different, none of them an entity."""
    base = F.when(F.col("kind") == "intl", "phone").otherwise(F.col("kind"))
    whole = written(found.select(base.alias("kind"), "canon").distinct(), "pii-entities")
    people = whole.filter("kind = 'person'").select("canon", F.posexplode(_words(F.col("canon"))).alias("at", "w")).select("canon", "at", "w.*")
    # A name behind a title without gender is that of the man or woman of the corpus, where there is one.
    told = F.max(F.when(F.col("gender") != "u", F.col("gender"))).over(Window.partitionBy("role", "word"))
    sexed = F.when(F.col("gender") == "u", F.coalesce(told, "gender")).otherwise(F.col("gender"))
    names = written(
        people.select("role", "gender", "word").distinct().withColumn("unit", F.concat_ws(":", "role", sexed, "word")), "pii-names"
    )
    todo = whole.filter("kind <> 'person'").unionByName(names.select(F.lit("word").alias("kind"), F.col("unit").alias("canon")).distinct())
    bare = F.when(F.col("kind") == "word", F.substring_index("canon", ":", -1)).otherwise(F.col("canon"))
    every = todo.select("kind", bare.alias("surrogate")).distinct().withColumn("taken", F.lit(True))
    current, rounds, moved = todo.withColumn("attempt", F.lit(0)), 0, None
    while True:
        drawn = written(draw(current, key).join(every, ["kind", "surrogate"], "left"), "pii-drawn")
        place = F.row_number().over(Window.partitionBy("kind", "surrogate").orderBy("attempt", "canon"))
        checked = drawn.withColumn("again", F.col("taken").isNotNull() | (place > 1))
        if checked.filter("again").isEmpty():
            break
        rounds += 1
        if rounds == ROUNDS:
            moved = written(_moved(checked.filter("again"), key), "pii-moved")
            checked = checked.join(moved.select("kind", "canon"), ["kind", "canon"], "left_anti")
        elif rounds == 2 * ROUNDS:  # one number alone of its length, all others of which are taken: it may take an entity's
            every = every.filter(~F.col("kind").isin(*FIXED))
        # Who drew first keeps it: an entity that draws again has a higher count than those it meets.
        current = checked.select("kind", "canon", (F.col("attempt") + F.col("again").cast("int")).alias("attempt"))
    drawn = drawn.select("kind", "canon", "surrogate")
    drawn = drawn if moved is None else drawn.unionByName(moved)
    units = drawn.filter("kind = 'word'").select(F.col("canon").alias("unit"), "surrogate")
    new = people.join(names.join(units, "unit"), ["role", "gender", "word"])
    parts = F.transform(F.array_sort(F.collect_list(F.struct("at", "surrogate"))), lambda x: x["surrogate"])
    persons = new.groupBy("canon").agg(F.array_join(parts, " ").alias("name")).select(
        F.lit("person").alias("kind"), "canon", F.concat(F.substring("canon", 1, 2), "name").alias("surrogate")
    )
    return drawn.filter("kind <> 'word'").select("kind", "canon", "surrogate").unionByName(persons)


def _repeats(surface: Column, surrogate: Column) -> Column:
    """What stands for a name and its words where they have no title: as written, in capitals, with capital initials."""
    name = F.substring(surrogate, F.lit(3), F.length(surrogate))
    pairs = F.transform(F.split(surface, " "), lambda x, i: F.struct(x.alias("old"), F.get(F.split(name, " "), i).alias("new")))
    pairs = F.filter(pairs, lambda p: ~F.lower(p["old"]).isin(*PARTICLES))
    pairs = F.array_append(pairs, F.struct(surface.alias("old"), name.alias("new")))
    forms = lambda x: F.array_distinct(F.array(x, F.upper(x), F.initcap(x)))
    return F.flatten(F.transform(pairs, lambda p: F.transform(
        forms(p["old"]), lambda o: F.struct(o.alias("k"), _written_as(o, p["new"]).alias("v")))))


def pseudonymize(docs: DataFrame, text: str = "text", key: str = KEY) -> DataFrame:
    """``docs`` with the entities in ``text`` replaced; all columns, in their order."""
    found = written(entities(docs, text), "pii-surfaces")
    base = F.when(F.col("kind") == "intl", "phone").otherwise(F.col("kind"))
    drawn = surrogates(found, key).withColumnRenamed("kind", "base")
    names = {n: fresh_name(docs, n) for n in ("_id", "_of", "_map", "_names")}
    again = F.when(F.col("kind") == "person", _repeats(F.col("surface"), F.col("surrogate")))
    # One surrogate where two names of a text share a word; long names before the words in them.
    first = F.filter(F.col("r"), lambda x, i: F.coalesce(F.get(F.col("r"), i - 1)["k"] != x["k"], F.lit(True)))
    long = F.array_sort(F.transform(first, lambda x: F.struct((-F.length(x["k"])).alias("n"), x["k"].alias("k"))))
    repeats = F.transform(first, lambda x: F.struct(F.concat(F.lit("w|"), x["k"]).alias("k"), x["v"].alias("v")))
    swaps = (
        found.withColumn("base", base).join(drawn, ["base", "canon"])
        .select("id", again.alias("r"), F.struct(F.concat("gender", F.lit("|"), "surface").alias("k"), render(F.col("kind"), F.col("surface"), F.col("surrogate")).alias("v")).alias("e"))
        .groupBy("id").agg(F.collect_list("e").alias("e"), F.array_sort(F.flatten(F.collect_list("r"))).alias("r"))  # as many as one text holds
        .select(
            F.col("id").alias(names["_of"]), F.map_from_entries(F.concat("e", repeats)).alias(names["_map"]),
            F.array_join(F.transform(long, lambda x: x["k"]), "|").alias(names["_names"]),
        )
    )
    t = column(docs, text)
    holds = F.coalesce(t.rlike(SIGN) & t.rlike(ANY), F.lit(False))
    plain = docs.filter(~holds)
    joined = docs.filter(holds).withColumn(names["_id"], F.md5(t)).join(swaps, F.col(names["_id"]) == F.col(names["_of"]))
    swap, known = F.col(names["_map"]), F.col(names["_names"])
    repeat = F.concat(F.lit(ANY + r"|(?<![\p{L}\d])(?:"), known, F.lit(r")(?![\p{L}\d]|[A-Za-z0-9._%+-]*@)"))
    pattern = F.when(known == "", ANY).otherwise(repeat)

    def piece(p):
        gap, surface = p["gap"], p["surface"]
        title = F.regexp_extract(gap, rf"(?:^|[^\p{{L}}])({_TITLE})\.? $", 1)
        titled = F.when(title != "", swap[F.concat(gender_of(title), F.lit("|"), surface)])
        return F.concat(gap, F.coalesce(swap[F.concat(F.lit("|"), surface)], titled, swap[F.concat(F.lit("w|"), surface)], F.lit("")))

    pieces = F.transform(_cut(t, pattern), piece)
    rewritten = joined.withColumn(text, F.array_join(pieces, ""))
    return plain.unionByName(rewritten.select(*[column(docs, c) for c in docs.columns]))


def op9_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymize(read(spark, sf_dir, "documents"))

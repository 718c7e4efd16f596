"""Personal data: keyed surrogates of the same type, gender, script and format, distinct and consistent over the corpus."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import numbered, staged

# Forms of address by gender.
TITLES_M = ("Mr", "Sir", "Herr", "Monsieur", "Señor", "Господин", "Κύριος")
TITLES_F = ("Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Señora", "Госпожа", "Κυρία")
TITLES_N = ("Dr", "Prof", "Doctor", "Professor", "Rev", "Mx", "Docteur", "Доктор", "Профессор")
TITLES = TITLES_M + TITLES_F + TITLES_N
# Common first names, found in texts and given as surrogates, by script and gender.
GIVEN = {
    ("latin", "m"): ("James", "John", "Robert", "Michael", "William", "David", "Richard", "Joseph", "Thomas", "Charles", "Daniel", "Paul", "Mark", "George", "Peter", "Hans", "Pierre", "Carlos"),
    ("latin", "f"): ("Mary", "Patricia", "Jennifer", "Linda", "Elizabeth", "Barbara", "Susan", "Jessica", "Sarah", "Karen", "Anna", "Laura", "Julia", "Emma", "Alice", "Greta", "Claire", "Carmen"),
    ("cyrillic", "m"): ("Иван", "Пётр", "Сергей", "Алексей", "Дмитрий", "Николай", "Михаил", "Андрей"),
    ("cyrillic", "f"): ("Анна", "Мария", "Ольга", "Елена", "Наталья", "Татьяна", "Ирина", "Светлана"),
    ("greek", "m"): ("Γιώργος", "Νίκος", "Κώστας", "Δημήτρης", "Γιάννης", "Παύλος"),
    ("greek", "f"): ("Μαρία", "Ελένη", "Κατερίνα", "Σοφία", "Άννα", "Ειρήνη"),
}
# Parts of made-up family names, and letters, by script.
SYLLABLES = {
    "latin": "bar ber bin bor dal den dor fal fen gar gil han hol jen kal ker lan lor mar mel mon nor pal per ran ros sal ser tal ten tor val ven wal wel win zan zer",
    "cyrillic": "бар бел вол гор дан дор зим кал кор лан мак мел мир нор пал пет род сав сол тар ток чер",
    "greek": "βαρ γαλ δαν δορ ζαν καλ κορ λαμ μαν μελ νικ παλ περ ραν σαλ στα ταρ τορ φιλ χαρ",
}
LETTERS = {"latin": "abcdefghijklmnopqrstuvwxyz", "cyrillic": "абвгдежзиклмнопрстуфхцчшэюя", "greek": "αβγδεζηθικλμνξοπρστυφχψω"}

OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
LOCAL = r"\p{L}\p{N}._%+-"
EMAIL = rf"(?<![{LOCAL}])[{LOCAL}]++@[\p{{L}}\p{{N}}-]+(?:\.[\p{{L}}\p{{N}}-]+)+"
COUNTRY = r"\+\d{1,3}"
# International with a plus, or national: an area in parentheses or three digits, then three and four.
PHONE = rf"(?<!\w){COUNTRY}[ (.-]+\d[\d() .-]{{4,}}\d(?!\d)"
NATIONAL = r"(?<![\w(-])(?:\(\d{2,5}\)[ .-]?\d{3,4}|\d{3}[ .-]\d{3})[ .-]\d{4}(?![\w-])"
ADDRESS = rf"(?<![\d.])(?:{OCTET}\.){{3}}{OCTET}(?!\.?\d)"
GROUP = "[0-9A-Fa-f]{1,4}"
# Eight groups, or fewer about a double colon; a digit among them, so that names of code do not count.
ADDRESS6 = (
    rf"(?<![\w:.])(?=[A-Fa-f:]*+[0-9])(?:(?:{GROUP}:){{7}}{GROUP}"
    rf"|{GROUP}(?::{GROUP}){{0,5}}::(?:{GROUP}(?::{GROUP}){{0,5}})?|::{GROUP}(?::{GROUP}){{0,6}})(?![\w:])"
)
CARD = r"(?<!\d)\d(?:[ -]?\d){12,18}(?!\d)"


def _any_of(words: Iterable[str]) -> str:
    """Pattern of any of the words, grouped by first letter, longer ones first."""
    groups: dict[str, list[str]] = {}
    for word in sorted(words, key=lambda w: (w[0], -len(w), w)):
        groups.setdefault(word[0], []).append(word[1:])
    return "(?:" + "|".join(f"{first}(?:{'|'.join(rest)})" for first, rest in groups.items()) + ")"


NAMES = tuple(n for names in GIVEN.values() for n in names)
NAME = r"\p{Lu}[\p{L}'’-]*\p{L}"
# A capital that may begin one is looked for first, since few letters of a text are.
PERSON = (
    f"(?=[{''.join(sorted({w[0] for w in TITLES + NAMES}))}])(?<!\\p{{L}})"
    rf"(?:{_any_of(TITLES)}\.? {NAME}(?: {NAME})?|{_any_of(NAMES)} {NAME})(?!\p{{L}})"
)
ENTITY = "|".join((EMAIL, PHONE, ADDRESS6, ADDRESS, CARD, NATIONAL, PERSON))


def entities(text: Column) -> Column:
    """All entities of a text in order, without overlap. Texts without digit and @ can hold persons only."""
    return (
        F.when(text.rlike("[@0-9]"), F.regexp_extract_all(text, F.lit(f"({ENTITY})"), F.lit(1)))
        .when(text.rlike(PERSON), F.regexp_extract_all(text, F.lit(f"({PERSON})"), F.lit(1)))
        .otherwise(F.array().cast("array<string>"))
    )


def kind_of(entity: Column) -> Column:
    return (
        F.when(entity.contains("@"), "email")
        .when(entity.startswith("+") | entity.startswith("("), "phone")
        .when(entity.contains(":"), "ip6")
        .when(entity.rlike(f"^{ADDRESS}$"), "ip")
        .when(entity.rlike(f"^{NATIONAL}$"), "phone")
        .when(entity.rlike(r"^\d"), "card")
        .otherwise("person")
    )


def _words(entity: Column) -> Column:
    return F.split(entity, " ")


def _is_title(word: Column) -> Column:
    return F.rtrim(word, F.lit(".")).isin(*TITLES)


def _gender(entity: Column) -> Column:
    """m, f, or n where neither the form of address nor a known first name tells."""
    first, second = (F.rtrim(F.get(_words(entity), F.lit(k)), F.lit(".")) for k in (0, 1))
    known = {g: [n for (_, own), names in GIVEN.items() if own == g for n in names] for g in "mf"}
    of_name = lambda w: F.when(w.isin(*known["m"]), "m").when(w.isin(*known["f"]), "f").otherwise("n")
    return F.when(first.isin(*TITLES_M), "m").when(first.isin(*TITLES_F), "f").when(first.isin(*TITLES_N), of_name(F.coalesce(second, F.lit("")))).otherwise(of_name(first))


def _script(word: Column) -> Column:
    return F.when(word.rlike(r"^\p{IsCyrillic}"), "cyrillic").when(word.rlike(r"^\p{IsGreek}"), "greek").otherwise("latin")


def parts(entity: Column) -> Column:
    """What has an identity of its own in an entity: array of (kind, token), tokens in one normal form.

    The two halves of an e-mail address, the digits of a number, the names of a person. So a domain, and a family
    name with or without a first name, gets the same surrogate wherever it stands.
    """
    one = lambda kind, token: F.struct((F.lit(kind) if isinstance(kind, str) else kind).alias("kind"), token.alias("token"))
    names = F.filter(_words(entity), lambda w: ~_is_title(w))
    given = F.size(names) > 1

    def named(word: Column, at: Column) -> Column:
        role = F.when(given & (at == 0), F.concat(F.lit("given-"), _gender(entity))).otherwise(F.lit("family"))
        return one(F.concat(role, F.lit("-"), _script(word)), F.lower(word))

    return (
        F.when(kind_of(entity) == "email", F.array(one("local", F.lower(F.split_part(entity, F.lit("@"), F.lit(1)))), one("domain", F.lower(F.split_part(entity, F.lit("@"), F.lit(2))))))
        .when(kind_of(entity) == "phone", F.array(one("phone", _national(entity))))
        .when(kind_of(entity) == "ip", F.array(one("ip", entity)))
        .when(kind_of(entity) == "ip6", F.array(one("ip6", F.lower(entity))))
        .when(kind_of(entity) == "card", F.array(one("card", F.regexp_replace(entity, r"\D", ""))))
        .otherwise(F.transform(names, named))
    )


def _national(phone: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(phone, f"^{COUNTRY}", ""), r"\D", "")


def _draw(digest: Column, at: Column) -> Column:
    """A number below 65,536 for each place."""
    return F.conv(F.substring(digest, F.pmod(at, F.lit(31)) * 4 + 1, F.lit(4)), 16, 10).cast("int")


def _scrambled(token: Column, digest: Column) -> Column:
    """Every letter and digit changed for one of its script; the first digit of all is not 0."""

    def change(i: Column) -> Column:
        char = F.substring(token, i, F.lit(1))
        pick = _draw(digest, i)
        out = F.when(char.rlike("[0-9]"), F.when(i == 1, pick % 9 + 1).otherwise(pick % 10).cast("string"))
        for name, letters in LETTERS.items():
            found = F.substring(F.lit(letters), pick % len(letters) + 1, F.lit(1))
            out = out.when(char.rlike(r"\p{L}") & (_script(char) == name), found)
        return out.otherwise(char)

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(token)), change), "")


def _luhn(digits: Column) -> Column:
    """Luhn sum of a number whose last digit is the check digit."""
    size = F.length(digits)

    def value(i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return F.when((size - i) % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.transform(F.sequence(F.lit(1), size), value), F.lit(0), lambda a, x: a + x)


def _hexed(token: Column, digest: Column) -> Column:
    """Every hexadecimal digit changed for another, none that begins a group for 0."""

    def change(i: Column) -> Column:
        char, pick = F.substring(token, i, F.lit(1)), _draw(digest, i)
        begins = (i == 1) | (F.substring(token, i - 1, F.lit(1)) == ":")
        digit = F.lower(F.hex(F.when(begins, pick % 15 + 1).otherwise(pick % 16)))
        return F.when(char == ":", char).otherwise(digit)

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(token)), change), "")


def surrogate(kind: Column, token: Column, attempt: Column, key: Column | str) -> Column:
    """The replacement of a token in its normal form; a keyed hash decides, `attempt` gives further ones.

    Domains keep their last label, addresses their four numbers, card numbers their first digit and a right or
    wrong check digit. First names come from the list of their gender and script; from the second attempt on two are
    joined, from the tenth three. Family names are made of three syllables, from the fifth attempt on of four.
    """
    key = F.lit(key) if isinstance(key, str) else key
    digest = F.sha2(F.concat_ws("\0", key, kind, token, attempt.cast("string")), 512)
    # Bound to a name by `transform`, so that it is made once and not for every letter.
    return F.get(F.transform(F.array(digest), lambda d: _drawn(kind, token, attempt, d)), F.lit(0))


def _drawn(kind: Column, token: Column, attempt: Column, digest: Column) -> Column:
    label = F.regexp_extract(token, r"\.[^.]+$", 0)
    domain = F.concat(_scrambled(F.substring(token, F.lit(1), F.length(token) - F.length(label)), digest), label)
    octets = F.concat_ws(".", *[(_draw(digest, F.lit(k)) % 254 + 1).cast("string") for k in range(4)])
    body = F.concat(F.substring(token, 1, 1), F.substring(_scrambled(token, digest), F.lit(2), F.length(token) - 2))
    last = F.pmod(-_luhn(F.concat(body, F.lit("0"))), F.lit(10))
    shift = F.when(_luhn(token) % 10 == 0, 0).otherwise(_draw(digest, F.lit(30)) % 9 + 1)
    card = F.concat(body, F.pmod(last + shift, F.lit(10)).cast("string"))
    out = F.when(kind == "domain", domain).when(kind == "ip", octets).when(kind == "ip6", _hexed(token, digest)).when(kind == "card", card)
    given = GIVEN | {(script, "n"): GIVEN[script, "m"] + GIVEN[script, "f"] for script in SYLLABLES}
    for (script, gender), names in given.items():
        listed = F.lit([n.lower() for n in names])
        pick = [F.get(listed, _draw(digest, F.lit(k)) % len(names)) for k in range(3)]
        many = F.when(attempt == 0, 1).when(attempt < 9, 2).otherwise(3)
        out = out.when(kind == f"given-{gender}-{script}", F.array_join(F.slice(F.array(*pick), 1, many), "-"))
    for script, held in SYLLABLES.items():
        listed = F.lit(held.split())
        some = [F.get(listed, _draw(digest, F.lit(k)) % len(held.split())) for k in range(4)]
        out = out.when(kind == f"family-{script}", F.array_join(F.slice(F.array(*some), 1, F.when(attempt < 4, 3).otherwise(4)), ""))
    return out.otherwise(_scrambled(token, digest))


def _as_written(word: Column, found: Column) -> Column:
    return F.when((F.upper(word) == word) & (F.length(word) > 1), F.upper(found)).when(F.lower(word) == word, found).otherwise(F.initcap(F.regexp_replace(found, "-", "- "))).alias("w")


def _cased(written: Column, found: Column) -> Column:
    """`found`, which is as long, with capitals where `written` has them."""

    def one(i: Column) -> Column:
        char = F.substring(found, i, F.lit(1))
        return F.when(F.substring(written, i, F.lit(1)).rlike("[A-Z]"), F.upper(char)).otherwise(char)

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(found)), one), "")


def _rendered(written: Column, digits: Column) -> Column:
    """`written` with its digits, one after another, replaced by `digits`."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("k"))

    def put(a: Column, c: Column) -> Column:
        digit = c.rlike("[0-9]")
        return F.struct(
            F.concat(a["out"], F.when(digit, F.substring(digits, a["k"] + 1, F.lit(1))).otherwise(c)).alias("out"),
            (a["k"] + digit.cast("int")).alias("k"),
        )

    return F.aggregate(F.split(written, ""), start, put)["out"]


def replacement(entity: Column, attempt_of, key: Column | str, roles: Column | None = None) -> Column:
    """The whole entity replaced, in its own format; attempt_of(kind, token) tells the attempt of each part.

    `roles` maps names that stand alone to their kind.
    """
    held = parts(entity)
    if roles is not None:
        alone = F.array(F.struct(roles[entity].alias("kind"), F.lower(entity).alias("token")))
        held = F.when(F.coalesce(F.map_contains_key(roles, entity), F.lit(False)), alone).otherwise(held)
    made = F.transform(held, lambda p: surrogate(p["kind"], p["token"], attempt_of(p["kind"], p["token"]), key))
    first = F.get(made, F.lit(0))
    country = F.regexp_extract(entity, f"^{COUNTRY}", 0)
    titles = F.filter(_words(entity), _is_title)
    names = F.filter(_words(entity), lambda w: ~_is_title(w))
    written = F.zip_with(names, made, lambda w, s: F.regexp_replace(_as_written(w, s), "- ", "-"))
    return (
        F.when(kind_of(entity) == "email", _cased(entity, F.array_join(made, "@")))
        .when(kind_of(entity) == "phone", F.concat(country, _rendered(F.substring(entity, F.length(country) + 1, F.length(entity)), first)))
        .when(kind_of(entity) == "ip", first)
        .when(kind_of(entity) == "ip6", F.when(F.upper(entity) == entity, F.upper(first)).otherwise(first))
        .when(kind_of(entity) == "card", _rendered(entity, first))
        .otherwise(F.array_join(F.concat(titles, written), " "))
    )


def keyed(rows: DataFrame, key: str) -> DataFrame:
    """The rows with the key in a column __key, by a subquery: no plan, and so no log of plans, shows it."""
    if not key:
        raise ValueError("surrogates need a key")
    return rows.withColumn("__key", rows.sparkSession.createDataFrame([(key,)], "key string").scalar())


def names_alone(hits: Column) -> Column:
    """Map from each word of the persons' names, as written and in capitals, to its kind."""
    persons = F.filter(hits, lambda e: kind_of(e) == "person")

    def named(entity: Column) -> Column:
        words = F.filter(_words(entity), lambda w: ~_is_title(w))
        return F.zip_with(words, parts(entity), lambda w, p: F.struct(w.alias("word"), p["kind"].alias("kind")))

    found = F.flatten(F.transform(persons, named))
    both = F.concat(found, F.transform(found, lambda f: F.struct(F.upper(f["word"]).alias("word"), f["kind"].alias("kind"))))
    # A name that is someone's first and another's family name counts as the first by name of its kinds.
    words = F.array_distinct(F.transform(both, lambda f: f["word"]))
    kind = lambda w: F.array_min(F.transform(F.filter(both, lambda f: f["word"] == w), lambda f: f["kind"]))
    return F.map_from_arrays(words, F.transform(words, kind))


def later_attempts(tokens: DataFrame, key: str) -> DataFrame | None:
    """Rows (kind, token, attempt) of tokens whose first surrogate would collide; None if there are none.

    `tokens` has distinct (kind, token). A surrogate collides if it is some token of its kind, or also another token's
    surrogate; then the smallest of these tokens keeps it and the others take their next attempt, until all differ.
    """
    state = staged(tokens.withColumn("attempt", F.lit(0)), "attempts")
    moved = False
    while True:
        named = keyed(state, key).withColumn("s", surrogate(F.col("kind"), F.col("token"), F.col("attempt"), F.col("__key"))).drop("__key")
        # Longest standing first: a token that has moved gives way to one that has not.
        claims = named.select("kind", "s", F.col("token").alias("claim"), "attempt")
        real = state.select("kind", F.col("token").alias("s"), F.lit(None).cast("string").alias("claim"), F.lit(-1).alias("attempt"))
        held = claims.union(real).groupBy("kind", "s").agg(F.count("*").alias("n"), F.min(F.struct("attempt", "claim")).alias("first")).where("n > 1")
        lost = named.join(held, ["kind", "s"]).where("first.claim IS NULL OR first.claim <> token").select("kind", "token", F.lit(1).alias("next"))
        lost = staged(lost, "lost")
        if not lost.take(1):
            break
        moved = True
        state = staged(
            state.join(lost, ["kind", "token"], "left").select("kind", "token", (F.col("attempt") + F.coalesce("next", F.lit(0))).alias("attempt")), "attempts"
        )
    return state.where("attempt > 0") if moved else None


def replace_entities(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of `docs` with personal data in the text replaced, and `n_entities`.

    Finds e-mail addresses, international and ten-digit national phone numbers, IPv4 and IPv6 addresses, card numbers and
    persons (a form of address or a common first name before a name); names of a document's persons are replaced where they
    stand alone in it too. Equal entities get equal surrogates in all documents and spellings of their format,
    different ones different surrogates, none of which is an entity of the corpus; the same key gives the same result for the
    same corpus. Null texts stay null (n_entities null), rows without entities unchanged. A row without id is replaced by
    first attempts. Rows that share an id are each replaced. A column n_entities is replaced. Only DataFrame functions run.
    """
    names = [c for c in docs.columns if c != "n_entities"]
    found = docs.select(docs[id_col].alias("doc_id"), F.explode(F.array_distinct(F.flatten(F.transform(entities(docs[text_col]), parts)))).alias("p")).select("doc_id", "p.kind", "p.token")
    found = staged(found, "entities")
    later = later_attempts(found.select("kind", "token").distinct(), key)
    rows, own_id, own_text = numbered(docs, names), f"__{names.index(id_col)}", f"__{names.index(text_col)}"
    moved = F.lit(None).cast("map<string,int>")
    if later is not None:
        of_doc = found.join(later, ["kind", "token"]).groupBy(F.col("doc_id").alias("_moved_id")).agg(
            F.map_from_entries(F.collect_set(F.struct(F.concat_ws("\0", "kind", "token"), "attempt"))).alias("_moved")
        )
        of_doc = staged(of_doc, "moved")
        rows = rows.join(of_doc, F.col(own_id) == F.col("_moved_id"), "left").drop("_moved_id")
        moved = F.col("_moved")

    def attempt_of(kind: Column, token: Column) -> Column:
        return F.coalesce(moved[F.concat_ws("\0", kind, token)], F.lit(0))

    text, secret = F.col(own_text), F.col("__key")
    found = keyed(rows, key).withColumn("__found", entities(text)).withColumn("__roles", names_alone(F.col("__found")))
    roles = F.col("__roles")
    # A row with persons has a pattern of its own, with their names at its end.
    alone = F.concat(F.lit(r"|(?<!\p{L})(?:"), F.array_join(F.map_keys(roles), "|"), F.lit(r")(?!\p{L})"))
    has_names = F.size(roles) > 0
    again = F.regexp_extract_all(text, F.concat(F.lit(f"({ENTITY}"), alone, F.lit(")")), F.lit(1))
    hits = found.withColumn("_hits", F.when(has_names, again).otherwise(F.col("__found")))
    pieces = F.when(has_names, F.split(text, F.concat(F.lit(f"(?:{ENTITY}"), alone, F.lit(")")), -1)).otherwise(F.split(text, f"(?:{ENTITY})", -1))
    swapped = F.transform("_hits", lambda e: replacement(e, attempt_of, secret, roles))
    rebuilt = F.array_join(F.zip_with(pieces, F.concat(swapped, F.array(F.lit(""))), lambda p, s: F.concat(p, s)), "")
    new_text = F.when(F.size("_hits") > 0, rebuilt).otherwise(text)
    columns = [(new_text if c == text_col else F.col(f"__{k}")).alias(c) for k, c in enumerate(names)]
    return hits.select(*columns, F.when(text.isNotNull(), F.size("_hits")).alias("n_entities"))

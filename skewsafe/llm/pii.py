"""Operator 3: personal data replaced by keyed, type-consistent surrogates.

Native: DataFrame functions only.

* Detection: one regular expression finds e-mail addresses, quoted secrets, names
  after a title, IPv4 addresses, payment cards (Luhn checked), social security
  and telephone numbers. A match that fails its check stays as it is.
* An entity is the canonical form of a match (digits of a number, an address in
  lower case, each name by itself), so all spellings of one entity get one
  surrogate: coreference. Its surrogate is derived from a keyed SHA-256 and keeps
  type and format: digits stay digits (a card keeps its first digit and passes
  Luhn, a private address stays private), addresses end in a reserved example
  domain, names keep gender, script and the title.
* Collision check over all distinct entities of the corpus: a surrogate that two
  entities share, that another entity already has, or that is a real entity
  itself is drawn again (for all but the smallest holder) until all differ:
  distinctness.
* Only documents with entities are joined with the surrogates; the others pass
  through. Entities are made distinct with map-side combine before they move, so
  one that a third of all documents hold is a row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skewsafe.llm.common import discard, staged

# Titles by gender of the person (fixed values).
MALE = ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Don", "Господин", "Κύριος")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra", "Doña", "Госпожа", "Κυρία")
NEUTRAL = ("Dr", "Prof")

# Given names by script and gender, family name parts by script (fixed values).
GIVEN = {
    ("latin", "m"): ("Adam", "Bruno", "Carlos", "David", "Emil", "Felix", "Hugo", "Ivan", "Jonas", "Leon", "Martin", "Oskar"),
    ("latin", "f"): ("Alice", "Berta", "Clara", "Diana", "Elena", "Flora", "Greta", "Helena", "Irma", "Julia", "Laura", "Nora"),
    ("latin", "n"): ("Alex", "Chris", "Dominique", "Eli", "Jona", "Kim", "Luca", "Maxime", "Robin", "Sascha", "Toni", "Uli"),
    ("cyrillic", "m"): ("Андрей", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Игорь", "Кирилл", "Максим", "Олег"),
    ("cyrillic", "f"): ("Анна", "Вера", "Галина", "Дарья", "Елена", "Ирина", "Лидия", "Мария", "Нина", "Ольга"),
    ("cyrillic", "n"): ("Саша", "Женя", "Валя", "Слава", "Шура", "Паша"),
    ("greek", "m"): ("Ανδρέας", "Βασίλης", "Γιώργος", "Δημήτρης", "Κώστας", "Νίκος", "Πέτρος", "Σπύρος"),
    ("greek", "f"): ("Άννα", "Βασιλική", "Δήμητρα", "Ελένη", "Ιωάννα", "Κατερίνα", "Μαρία", "Σοφία"),
    ("greek", "n"): ("Άγγελο", "Φώτι", "Χάρι", "Σίμο"),
}
SYLLABLES = {
    "latin": ("ba", "den", "fal", "gor", "hel", "kin", "lan", "mar", "nes", "or", "pel", "rin", "sol", "tam", "ver", "wick"),
    "cyrillic": ("ба", "вел", "гор", "дан", "жен", "зор", "кам", "лев", "мир", "ник", "пет", "род", "сев", "тим", "хар", "юн"),
    "greek": ("βα", "γερ", "δαν", "θεο", "καλ", "λεο", "μαρ", "νικ", "παν", "ραλ", "σταμ", "τριαν", "φιλ", "χρισ", "ανδρ", "οικ"),
}

LETTERS = {"latin": "ABCDEFGHIJKLMNOPRSTUVWZ", "cyrillic": "АБВГДЕЖЗИКЛМНОПРСТУФ", "greek": "ΑΒΓΔΕΖΗΘΙΚΛΜΝΟΠΡΣΤΦΧ"}

_TITLES = "|".join(sorted(MALE + FEMALE + NEUTRAL, key=len, reverse=True))
_END = r"(?![\p{L}\p{N}])"
#: A name of two letters or more (initials may touch it) or initials with dots; single letters may stand before either.
_NAME = rf"(?:\p{{Lu}} )*+(?:(?:\p{{Lu}}\.)*+\p{{Lu}}[\p{{L}}'’-]*\p{{L}}|(?:\p{{Lu}}\.)++){_END}"
_INITIALS = r"^\p{Lu}(?:\.\p{Lu})*\.?$"
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9])",
    "secret": r"(?<![A-Za-z0-9])(?i:token|secret|password|passwd|api_?key)[\"']? ?[=:] ?[\"'][^\"'\s]{8,}+[\"']",
    "name": rf"(?<![\p{{L}}\p{{N}}])(?:{_TITLES})\.? {_NAME}(?: {_NAME})*+",
    "ipv4": r"(?<![A-Za-z0-9.])(?:\d{1,3}\.){3}\d{1,3}(?![A-Za-z0-9]|\.\d)",
    "card": r"(?<![A-Za-z0-9.])(?:\d{13,19}|\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{1,7}|\d{4}[ -]\d{6}[ -]\d{5})(?![A-Za-z0-9])",
    "ssn": r"(?<![A-Za-z0-9-])\d{3}-\d{2}-\d{4}(?![A-Za-z0-9-])",
    "phone": r"(?<![A-Za-z0-9+])(?:\+1[ .-]?\(?\d{3}\)?[ .-]?\d{3}[ .-]?\d{4}|\+\d{1,3}(?:[ .-]?\(?\d{2,4}\)?){2,5}"
    r"|\(\d{3}\) ?\d{3}[ .-]\d{4}|(?:1[ .-])?\d{3}[ .-]\d{3}[ .-]\d{4})(?![A-Za-z0-9])",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
# Every match of ANY contains a match of this, which is cheaper to look for.
SIGN = rf"@|\d{{3}}|\d\.\d{{1,3}}\.\d|\+\d|[=:] ?[\"']|(?:{_TITLES})\.? \p{{Lu}}"

_SEP = "\u0001"


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, r"\D", "")


def _kind(match: Column) -> Column:
    """Kind of a match, by the first pattern that is all of it; null if its check fails."""
    kind = F.lit(None).cast("string")
    for name, pattern in reversed(PATTERNS.items()):
        kind = F.when(match.rlike(f"^(?:{pattern})$"), name).otherwise(kind)
    octets = F.transform(F.split(match, r"\."), lambda o: o.try_cast("int"))
    length = F.length(_digits(match))
    return (
        F.when((kind == "ipv4") & ~F.forall(octets, lambda o: o <= 255), None)
        .when((kind == "card") & ~F.call_function("luhn_check", _digits(match)), None)
        .when((kind == "phone") & ~length.between(7, 15), None)
        .otherwise(kind)
    )


def _gender(match: Column) -> Column:
    title = F.regexp_extract(match, rf"^({_TITLES})", 1)
    return F.when(title.isin(*MALE), "m").when(title.isin(*FEMALE), "f").otherwise("n")


def _names(match: Column) -> Column:
    """All words after the title."""
    words = F.split(match, " ")
    return F.slice(words, F.lit(2), F.size(words) - 1)


def _name_keys(match: Column) -> Column:
    """Entity keys of the names of a match: the last is the family name, the others are given names; initials are their own kind."""
    words = _names(match)

    def of(w: Column, i: Column) -> Column:
        kind = F.when(i == F.size(words) - 1, "family").otherwise(F.concat(F.lit("given_"), _gender(match)))
        initials = F.concat(F.lit("initials" + _SEP), F.regexp_replace(w, r"\.$", ""))
        return F.when(w.rlike(_INITIALS), initials).otherwise(F.concat(kind, F.lit(_SEP), w))

    return F.transform(words, of)


def _key(kind: Column, match: Column) -> Column:
    """Entity key ``kind, canonical form`` of a match that is one entity."""
    number = _digits(match)
    national = F.when((F.length(number) == 11) & number.startswith("1"), F.substring(number, 2, 10)).otherwise(number)
    inner = F.regexp_extract(match, r"[\"']([^\"'\s]*)[\"']$", 1)
    value = (
        F.when(kind == "email", F.lower(match)).when(kind == "phone", national).when(kind.isin("card", "ssn"), number)
        .when(kind == "secret", inner).otherwise(match)
    )
    return F.concat(kind, F.lit(_SEP), value)


def _entities(matches: Column) -> Column:
    """Distinct entity keys of a document's matches."""

    def of(m: Column) -> Column:
        kind = _kind(m)
        return F.when(kind.isNull(), F.array().cast("array<string>")).when(kind == "name", _name_keys(m)).otherwise(
            F.array(_key(kind, m))
        )

    return F.array_distinct(F.flatten(F.transform(matches, of)))


# --- surrogates of distinct entities ---------------------------------------------


def _stream(secret: str, key: Column, attempt: Column, words: int = 8) -> Column:
    """``64 * words`` keyed hex digits for an entity and attempt."""
    parts = [F.sha2(F.concat_ws(_SEP, F.lit(secret), F.lit(str(i)), attempt.cast("string"), key), 256) for i in range(words)]
    return F.concat(*parts)


def _number(stream: Column, i: Column, bound: Column | int) -> Column:
    """Number below ``bound`` from the ``i``-th three hex digits of the stream (which is used cyclically)."""
    at = F.pmod(i * 3, F.length(stream) - 3).cast("int") + 1
    return F.pmod(F.conv(stream.substr(at, F.lit(3)), 16, 10).cast("long"), F.lit(bound) if isinstance(bound, int) else bound).cast("int")


_LOWER, _UPPER, _DIGIT, _HEX = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "0123456789abcdef"


_CYRILLIC, _GREEK = "абвгдежзиклмнопрстуфхцчшщэюя", "αβγδεζηθικλμνξοπρστυφχψω"
#: From this attempt on, kinds with few values may leave their usual space.
WIDER_FROM = 4
#: Drawing fails with an error after so many rounds; each round from WIDER_FROM on has a larger space.
MAX_ROUNDS = 64


def _shaped(value: Column, stream: Column, shift: int = 0, scripts: bool = False) -> Column:
    """``value`` with every ASCII letter and digit replaced by another of its class (``scripts``: Cyrillic and Greek too)."""

    def replaced(c: Column, i: Column) -> Column:
        out = c
        if scripts:
            for script, alphabet in (("Cyrillic", _CYRILLIC), ("Greek", _GREEK)):
                n = _number(stream, i + shift, len(alphabet))
                out = F.when(c.rlike(rf"\p{{Is{script}}}"), F.lit(alphabet).substr(n + 1, F.lit(1))).otherwise(out)
        for alphabet in (_LOWER, _UPPER, _DIGIT):
            n = _number(stream, i + shift, len(alphabet))
            out = F.when((c != "") & F.lit(alphabet).contains(c), F.lit(alphabet).substr(n + 1, F.lit(1))).otherwise(out)
        return out

    return F.array_join(F.transform(F.split(value, ""), replaced), "")


def _script(word: Column) -> Column:
    return F.when(word.rlike(r"\p{IsCyrillic}"), "cyrillic").when(word.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def _pick(options: tuple[str, ...], stream: Column, i: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, options)), _number(stream, i, len(options)) + 1)


def _several(options: tuple[str, ...], stream: Column, n: Column, between: str) -> Column:
    return F.array_join(F.transform(F.sequence(F.lit(1), n), lambda i: _pick(options, stream, i)), between)


def surrogate(key: Column, attempt: Column, secret: str) -> Column:
    """The surrogate of an entity key; another one for each attempt.

    Kinds with few values get longer with the attempts, so drawing ends.
    """
    kind, value = F.split_part(key, F.lit(_SEP), F.lit(1)), F.split_part(key, F.lit(_SEP), F.lit(2))
    stream = _stream(secret, key, attempt)
    shaped = _shaped(value, stream)

    local, domain = F.split_part(value, F.lit("@"), F.lit(1)), F.split_part(value, F.lit("@"), F.lit(2))
    # At least six characters of local part, one more for each attempt.
    pad = F.greatest(F.lit(0), 6 - F.length(local)) + attempt
    padding = F.array_join(
        F.transform(F.sequence(F.lit(1), pad), lambda i: F.lit(_LOWER).substr(_number(stream, i + 70, 26) + 1, F.lit(1))), ""
    )
    top = F.substring_index(domain, ".", -1)
    host = F.substring(F.sha2(F.concat_ws(_SEP, F.lit(secret), F.lit("domain"), domain), 256), 1, 8)
    email = F.concat(
        _shaped(local, stream), F.when(pad > 0, padding).otherwise(""), F.lit("@m"), host, F.lit(".example."),
        F.when(top.isin("com", "org", "net"), top).otherwise("com"),
    )

    octet = [_number(stream, F.lit(i), 256).cast("string") for i in range(4)]
    public = F.element_at(
        # First octets of ordinary public addresses.
        F.array(*(F.lit(str(i)) for i in range(11, 223) if i not in (100, 127, 169, 172, 192, 198, 203))),
        _number(stream, F.lit(9), 205) + 1,
    )
    second = (16 + _number(stream, F.lit(8), 16)).cast("string")
    ipv4 = (
        F.when(value.startswith("10."), F.concat_ws(".", F.lit("10"), octet[1], octet[2], octet[3]))
        .when(value.startswith("192.168.") & (attempt < WIDER_FROM), F.concat_ws(".", F.lit("192.168"), octet[2], octet[3]))
        # A private range that is used up goes on in the largest one.
        .when(value.startswith("192.168."), F.concat_ws(".", F.lit("10"), octet[1], octet[2], octet[3]))
        .when(value.rlike(r"^172\.(1[6-9]|2\d|3[01])\.") & (attempt >= WIDER_FROM), F.concat_ws(".", F.lit("10"), octet[1], octet[2], octet[3]))
        .when(value.rlike(r"^172\.(1[6-9]|2\d|3[01])\."), F.concat_ws(".", F.lit("172"), second, octet[2], octet[3]))
        .when(value.startswith("127."), F.concat_ws(".", F.lit("127"), octet[1], octet[2], octet[3]))
        .otherwise(F.concat_ws(".", public, octet[1], octet[2], octet[3]))
    )

    body = F.concat(F.substring(value, 1, 1), shaped.substr(F.lit(2), F.length(value) - 2))
    checks = F.filter(F.array(*(F.lit(c) for c in _DIGIT)), lambda c: F.call_function("luhn_check", F.concat(body, c)))
    card = F.concat(body, F.element_at(checks, 1))

    # A national number of ten digits changes whole (not starting with 0 or 1);
    # others keep their first two digits, the country.
    lead = F.when((F.length(value) == 10) | (attempt >= WIDER_FROM), (2 + _number(stream, F.lit(90), 8)).cast("string")).otherwise(F.substring(value, 1, 2))
    phone = F.concat(lead, shaped.substr(F.length(lead) + 1, F.length(value)))

    hexed = F.array_join(
        F.transform(F.split(value, ""), lambda c, i: F.lit(_HEX).substr(_number(stream, i, 16) + 1, F.lit(1))), ""
    )
    letters = F.array_join(
        F.transform(F.split(value, ""), lambda c, i: F.lit(_LOWER).substr(_number(stream, i, 26) + 1, F.lit(1))), ""
    )
    # A value without a letter or digit of these scripts is replaced whole; each round from WIDER_FROM on adds a letter.
    secret_value = (
        F.when(value.rlike("^[0-9a-f]+$"), hexed)
        .when(~value.rlike(r"[A-Za-z0-9\p{IsCyrillic}\p{IsGreek}]"), letters)
        .otherwise(_shaped(value, stream, scripts=True))
    )
    longer = F.greatest(F.lit(0), attempt - WIDER_FROM + 1)
    more = F.array_join(F.transform(F.sequence(F.lit(1), longer), lambda i: F.lit(_LOWER).substr(_number(stream, i + 40, 26) + 1, F.lit(1))), "")
    secret_value = F.concat(secret_value, F.when(longer > 0, more).otherwise(""))

    script, gender = _script(value), F.substring(kind, -1, 1)
    family, given = F.lit(""), F.lit("")
    for name, syllables in SYLLABLES.items():
        whole = F.initcap(_several(syllables, stream, 3 + attempt, ""))
        family = F.when(script == name, whole).otherwise(family)
    initials = F.lit("")
    for name, letters in LETTERS.items():
        # As many as there were, one more for each attempt.
        whole = _several(tuple(letters), stream, F.ceil((F.length(value) + 1) / 2).cast("int") + attempt, ".")
        initials = F.when(script == name, whole).otherwise(initials)
    for (name, g), options in GIVEN.items():
        # Double names once the single ones are taken, and so on.
        given = F.when((script == name) & (gender == g), _several(options, stream, 1 + attempt, "-")).otherwise(given)

    return (
        F.when(kind == "email", email).when(kind == "ipv4", ipv4).when(kind == "card", card).when(kind == "phone", phone)
        .when(kind == "secret", secret_value).when(kind == "family", family).when(kind.startswith("given_"), given)
        .when(kind == "initials", initials).otherwise(shaped)
    )


def _class(key: Column) -> Column:
    """Kinds whose surrogates must differ from each other: names of any gender share one space."""
    kind = F.split_part(key, F.lit(_SEP), F.lit(1))
    return F.when(kind.startswith("given_"), "given").otherwise(kind)


def surrogates(entities: DataFrame, secret: str) -> DataFrame:
    """``key, surrogate`` of each distinct ``key``: no two alike, none equal to a real entity.

    Each round draws for the open entities, keeps the draws that are new, and
    goes on with the rest. A kind whose space is used up gets a larger one from
    round ``WIDER_FROM`` on; after ``MAX_ROUNDS`` an error names an entity that is
    left. All rounds are distributed and written down; only
    the number of open entities reaches the driver.
    """
    keys = staged(entities.select("key").distinct(), "pii-entities")
    real = keys.select(F.concat(_class(F.col("key")), F.lit(_SEP), F.split_part("key", F.lit(_SEP), F.lit(2))).alias("drawn"))
    # A person of either gender may have a given name that another has too.
    real = staged(real.distinct(), "pii-real")
    open_, settled, attempt = keys, None, 0
    tasks = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    while True:
        drawn = staged(
            # Drawing is costly and its input small: spread it over the cluster.
            open_.repartition(tasks, "key").select("key", surrogate(F.col("key"), F.lit(attempt), secret).alias("surrogate")).withColumn(
                "drawn", F.concat(_class(F.col("key")), F.lit(_SEP), F.col("surrogate"))
            ),
            "pii-drawn",
        )
        owners = drawn.groupBy("drawn").agg(F.min("key").alias("key")).join(real, "drawn", "left_anti")
        if settled is not None:
            owners = owners.join(settled.select("drawn"), "drawn", "left_anti")
        new = drawn.join(owners, ["drawn", "key"], "left_semi").select("key", "surrogate", "drawn")
        before, settled = settled, staged(new if settled is None else settled.unionByName(new), "pii-settled")
        rest = staged(open_.join(settled, "key", "left_anti"), "pii-open")
        # What this round read and nothing reads again.
        for table in filter(None, (drawn, before, open_ if attempt else None)):
            discard(table)
        open_ = rest
        if open_.isEmpty():
            return settled.select("key", "surrogate")
        attempt += 1
        if attempt == MAX_ROUNDS:
            raise RuntimeError(f"no free surrogates for {open_.count()} entities after {attempt} rounds, such as {open_.first()['key']!r}")


# --- documents ----------------------------------------------------------------------


def _laid_over(match: Column, digits: Column) -> Column:
    """``match`` with its last digits replaced by ``digits``, its format kept."""
    spare = F.length(_digits(match)) - F.length(digits)
    chars = F.split(match, "")
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("seen"))

    def step(state: Column, c: Column) -> Column:
        is_digit = c.rlike("[0-9]")
        at = state["seen"] - spare
        new = F.when(is_digit & (at >= 0), digits.substr(at + 1, F.lit(1))).otherwise(c)
        return F.struct(F.concat(state["out"], new).alias("out"), (state["seen"] + is_digit.cast("int")).alias("seen"))

    return F.aggregate(chars, start, step, lambda state: state["out"])


def _rendered(match: Column, known: Column) -> Column:
    """What replaces a match, from the document's map of surrogates."""
    kind = _kind(match)
    given = known[_key(kind, match)]
    title = F.split_part(match, F.lit(" "), F.lit(1))
    names = F.array_join(
        # Initials keep their last dot.
        F.zip_with(_names(match), _name_keys(match), lambda w, k: F.concat(known[k], F.when(w.endswith("."), ".").otherwise(""))), " "
    )
    quoted = F.concat(
        F.regexp_extract(match, r"^(.*[\"'])[^\"'\s]*[\"']$", 1), given, F.substring(match, -1, 1)
    )
    return (
        F.when(kind.isNull(), match).when(kind == "name", F.concat(title, F.lit(" "), names))
        .when(kind == "secret", quoted).when(kind.isin("phone", "card", "ssn"), _laid_over(match, given))
        .otherwise(given)
    )


def _free(docs: DataFrame, name: str) -> str:
    while name in docs.columns:
        name += "_"
    return name


def with_surrogates(docs: DataFrame, secret: str, text: str = "text") -> DataFrame:
    """``docs`` with all columns, entities in ``text`` replaced.

    One output row per input row, whole texts, in no particular order. A null
    text stays null, an empty one empty; repeated rows get equal results; texts
    without entities are unchanged. An empty table gives no rows.
    """
    row, found, known = (_free(docs, n) for n in ("_row", "_found", "_known"))
    matches = F.regexp_extract_all(F.col(text), F.lit(ANY), F.lit(0))
    none = F.array().cast("array<string>")
    marked = staged(
        docs.withColumn(found, F.when(F.col(text).rlike(SIGN), _entities(matches)).otherwise(none))
        .withColumn(row, F.monotonically_increasing_id()),
        "pii-documents",
    )
    mentions = marked.where(F.size(found) > 0).select(row, F.explode(found).alias("key"))
    replaced_by = staged(surrogates(mentions, secret), "pii-surrogates")
    of_row = mentions.join(replaced_by, "key").groupBy(row).agg(
        # A document's own distinct entities: bounded by its text.
        F.map_from_entries(F.collect_list(F.struct("key", "surrogate"))).alias(known)
    )
    changed = marked.where(F.size(found) > 0).join(of_row, row)
    pieces = F.split(F.col(text), ANY, -1)
    rendered = F.transform(F.regexp_extract_all(F.col(text), F.lit(ANY), F.lit(0)), lambda m: _rendered(m, F.col(known)))
    woven = F.array_join(
        F.zip_with(pieces, rendered, lambda p, r: F.concat(p, F.coalesce(r, F.lit("")))), ""
    )
    changed = changed.withColumn(text, woven).select(*docs.columns)
    return marked.where(F.size(found) == 0).select(*docs.columns).unionByName(changed)

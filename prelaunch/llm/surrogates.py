"""Surrogates for personal data: keyed, type-consistent replacements, in DataFrame functions only.

Entities are found by one regular expression (in texts that have a digit, ``@``, ``=``, ``:``, a title or an access key's prefix at all): e-mail addresses, IPv4 addresses, phone numbers, payment cards (Luhn-checked),
IBANs, social-security numbers, secrets (assigned passwords and tokens, access keys) and person names after a title. Each
has a canonical form (case, punctuation and spacing removed), so variants of one entity share one surrogate
(coreference). The surrogate is drawn from a SHA-512 stream of key, type, canonical form and attempt:

* digits become digits, letters letters of the same script and case, everything else stays (format);
* cards and IBANs keep their first digit or country and get valid check digits, IPv4 octets keep their width and stay valid, phone numbers
  keep their country code, e-mail domains map by themselves and keep the top-level label, hexadecimal secrets stay so;
* names take first names of the title's gender, or where the title has none that of the first name, and generated surnames, both in the
  script they are written in.

Collision checks keep distinct entities distinct: over the distinct entities of the whole corpus, a surrogate that two
entities share, or that is itself an entity of the corpus, is drawn again with the next attempt for all but the
smallest entity, until no collision is left. Domains of e-mail addresses are checked alike, before the addresses. After ``GROW_AFTER`` attempts the format gives way, by one symbol more an attempt, so
that a corpus with more entities than a narrow format holds settles too: surnames get further syllables, octets any width, local
parts letters, secrets, IBANs, cards and international phone numbers digits. Formats of one fixed length (social-security and local phone
numbers, access keys; addresses once every octet is free) get digits at the end after ``FULL_AFTER`` attempts, when they are full.

Scale: replacing is row-local. Collision checks shuffle only distinct entities (map-side combined, so an entity that a
third of the rows name is one row a task). The few redrawn entities reach the texts by a join on a text hash, broadcast
only behind a row count.

Edge cases: a null text stays null with 0 entities; an empty text stays empty. Very long texts and runs (a hundred thousand labels,
letters or digits) are read whole; an address ends after the 127 labels that a domain can have. Repeated rows change alike. An empty table
gives an empty result. ``doc_id`` may be null or repeated: nothing depends on it. Further columns stay as they are,
whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prelaunch.llm.components import shared_checkpoint

MAX_ATTEMPTS = 60
GROW_AFTER = 4               # attempts inside the mention's own format
FULL_AFTER = 30              # the same for formats of fixed length
BROADCAST_ROWS = 100_000     # redrawn entities up to this many are broadcast

# Titles and the gender they imply ("x" where they imply none).
TITLES = {
    "f": ["Mrs", "Ms", "Miss", "Madam", "Frau", "Mme", "Madame", "Mlle", "Sra", "Señora", "Srta", "Signora", "госпожа"],
    "m": ["Mr", "Sir", "Herr", "Monsieur", "Señor", "Signor", "господин"],
    "x": ["Dr", "Prof"],
}
# First names by script and gender.
FIRST = {
    ("latin", "f"): "Ada Alice Amelie Anna Beatriz Camille Carla Clara Elena Elsa Emma Eva Greta Hanna Helen Ines Irene Isabel Jana Julia Karin Laura Lena Lucia Maria Marta Nadine Nina Olga Paula Rosa Sara Silvia Sofia Tessa Vera".split(),
    ("latin", "m"): "Adam Alan Anton Bruno Carlos Daniel David Diego Emil Erik Felix Frank Georg Hugo Ivan Jakob Jan Jorge Karl Lars Leon Louis Lukas Marc Martin Max Miguel Nils Oscar Otto Paul Peter Rafael Simon Theo Victor".split(),
    ("cyrillic", "f"): "Анна Вера Дарья Елена Ирина Мария Нина Ольга Софья Юлия".split(),
    ("cyrillic", "m"): "Антон Борис Виктор Денис Иван Лев Максим Олег Павел Роман".split(),
}
# Syllables of generated surnames.
SYLLABLES = {
    "latin": "ba ber cor dal den far gel gor hal hem jor kar kel lan lem mar mel mor nal nor pal per ral ros sal sen tar tel tor val ver wal".split(),
    "cyrillic": "ба бер вал вер гор дан зар кар кол лан мар мел нов пав рас сар тал тер хал чер".split(),
}
ALPHABETS = {"upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "lower": "abcdefghijklmnopqrstuvwxyz", "digit": "0123456789", "hex": "0123456789abcdef",
             "cyr_upper": "АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЭЮЯ", "cyr_lower": "абвгдежзиклмнопрстуфхцчшэюя"}

_NAME = r"\p{Lu}\p{Ll}+(?:[-' ]\p{Lu}\p{Ll}+){0,2}"
_TITLE = "|".join(sorted((t for ts in TITLES.values() for t in ts), key=len, reverse=True))
_TITLE_START = "[" + "".join(sorted({t[0] for ts in TITLES.values() for t in ts})) + "]"
# What begins with a digit, + or (.
NUMBERS = {
    "ip": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?!\.?\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "card": r"(?<![\d.-])[3-6]\d{3}(?:[ -]?\d{4}){2}[ -]?\d{1,7}(?!\d)",
    "phone": r"(?<![\d.])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}(?!\d)|(?<![\d.+])\(\d{3}\) ?\d{3}-\d{4}(?!\d)"
             r"|(?<![\d.-])\d{3}[.-]\d{3}[.-]\d{4}(?![.-]?\d)",
}
# A domain has at most 127 labels: the bound also keeps the engine, which goes a step deeper with each, from running out of stack.
# Of a longer run the first 127 labels are taken where a top-level label follows them, else nothing; the rest stays.
EMAIL = r"[A-Za-z0-9][A-Za-z0-9._%+-]*+@(?:[A-Za-z0-9-]++\.){1,126}[A-Za-z]{2,24}"
# What begins with a letter, after anything but a letter or digit.
WORDS = {
    "secret": r"(?=[PpSsTtAa])(?:(?i:password|passwd|pwd|secret|token|api[_-]?key)\s{0,2}[=:]\s{0,2}\"?[A-Za-z0-9_/+.-]{6,}+\"?|(?:AKIA|ASIA)[0-9A-Z]{16}\b)",
    "iban": r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b",
    "name": rf"(?={_TITLE_START})(?:{_TITLE})\b\.? {_NAME}",
}
# Each branch is tried only where its first character fits, and words only from their beginning. Only an e-mail address may not
# begin after the punctuation that it can hold.
ENTITY = (rf"(?=[A-Za-z0-9])(?<![\p{{L}}\d._%+-]){EMAIL}|(?=[0-9+(])(?:{'|'.join(NUMBERS.values())})"
          rf"|(?=\p{{L}})(?<![\p{{L}}\d])(?:{'|'.join(WORDS.values())})")
# Every entity has one of these characters, a title or an access key's prefix.
HINT = rf"[0-9@=:]|A(?:KI|SI)A|(?={_TITLE_START})(?<!\p{{L}})(?:{_TITLE})\b"
LONG = 128                   # longer secrets and address parts are drawn in chunks, each from a block of its own
CHUNK = 32


def _type_of(e: Column) -> Column:
    """The type of a found entity, by its shape."""
    return (F.when(F.contains(e, F.lit("@")) & ~e.rlike(r"[=:]"), "email")
            .when(e.rlike(r"[=:]") | e.rlike("^(?:AKIA|ASIA)[0-9A-Z]{16}$"), "secret")
            .when(e.rlike(r"^[A-Z]{2}\d{2}"), "iban")
            .when(e.rlike(r"^\d{1,3}(?:\.\d{1,3}){3}$"), "ip")
            .when(e.rlike(r"^\d{3}-\d{2}-\d{4}$"), "ssn")
            .when(e.rlike(r"^\+|^\(|^\d{3}[.-]\d{3}[.-]\d{4}$"), "phone")
            .when(e.rlike(r"^\d"), "card").otherwise("name"))


def _luhn(digits: Column) -> Column:
    """Luhn sum of a digit string whose last digit is the check digit."""
    n = F.length(digits)
    value = lambda i: F.substr(digits, i, F.lit(1)).cast("int")
    parts = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.when(
        (n - i) % 2 == 1, F.when(value(i) * 2 > 9, value(i) * 2 - 9).otherwise(value(i) * 2)).otherwise(value(i)))
    return F.aggregate(parts, F.lit(0), lambda a, x: a + x)


def _mod97(e: Column) -> Column:
    """Letters (10 to 35) and digits read as one number, modulo 97."""
    value = lambda c: F.when(c.rlike("[0-9]"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
    chars = F.filter(F.transform(F.sequence(F.lit(1), F.length(e)), lambda i: F.substr(e, i, F.lit(1))), lambda c: c.rlike("[0-9A-Z]"))
    return F.aggregate(F.transform(chars, value), F.lit(0), lambda a, v: (a * F.when(v > 9, 100).otherwise(10) + v) % 97)


def _digits(e: Column) -> Column:
    return F.regexp_replace(e, r"\D", "")


def _prefix_length(e: Column, kind: Column) -> Column:
    """Leading characters that stay: a secret's name and quote, an access key's prefix, a country code, a title."""
    return (F.when(kind == "secret", F.when(e.rlike("^(?:AKIA|ASIA)"), 4)
                   .otherwise(F.length(F.regexp_extract(e, r"^[^=:]*[=:]\s*\"?", 0))))
            .when(kind == "phone", F.length(F.regexp_extract(e, r"^\+\d{1,3}(?=[ .(-])", 0)))
            .when(kind == "iban", 2).when(kind == "card", 1)
            .when(kind == "name", F.length(F.regexp_extract(e, rf"^(?:{_TITLE})\b\.? ", 0))).otherwise(0))


def canonical(e: Column, kind: Column) -> Column:
    """What two mentions of one entity have in common."""
    body = F.substr(e, _prefix_length(e, kind) + 1)
    return (F.when(kind.isin("card", "ssn"), _digits(e))
            .when(kind == "phone", _digits(e))
            .when(kind == "iban", F.regexp_replace(e, " ", ""))
            .when(kind == "secret", F.regexp_replace(body, '"$', ""))
            .when(kind == "name", F.concat(_gender(e), F.lit(" "), F.lower(F.regexp_replace(body, r"[-' ]+", " "))))
            .otherwise(F.lower(e)))


def _gender(e: Column) -> Column:
    """The title's gender; where it implies none, that of a known first name."""
    g = F.lit("x")
    for gender in ("f", "m"):
        known = "|".join(n for (_, of), names in FIRST.items() if of == gender for n in names)
        titled = rf"(?:{'|'.join(TITLES[gender])})\b|(?:{'|'.join(TITLES['x'])})\b\.? (?:{known})(?!\p{{L}})"
        g = F.when(e.rlike(rf"^(?:{titled})"), gender).otherwise(g)
    return g


def _stream(key: str, kind: Column, canon: Column, attempt: Column) -> Column:
    """Hexadecimal digits of a keyed hash, two for each character of the canonical form and 32 more."""
    blocks = F.sequence(F.lit(0), F.ceil((F.length(canon) + 16) / 64).cast("int"))
    return F.array_join(F.transform(blocks, lambda b: F.sha2(F.concat_ws("|", F.lit(key), kind, canon, attempt.cast("string"), b.cast("string")).cast("binary"), 512)), "")


def _number(stream: Column, at: Column) -> Column:
    """A 16-bit number from the stream's position; each position is 8 bits further."""
    return F.conv(F.substr(stream, (2 * at + 1).cast("int"), F.lit(4)), 16, 10).cast("int")


def _pick(values: list[str], number: Column) -> Column:
    return F.element_at(F.split(F.lit(" ".join(values)), " "), (number % len(values) + 1).cast("int"))


def _letter(c: Column, number: Column, hexadecimal: Column) -> Column:
    """The replacement of one character: same class, script and case."""
    alphabet = (F.when(hexadecimal & c.rlike("[0-9a-f]"), ALPHABETS["hex"]).when(c.rlike("[0-9]"), ALPHABETS["digit"])
                .when(c.rlike("[a-z]"), ALPHABETS["lower"]).when(c.rlike("[A-Z]"), ALPHABETS["upper"])
                .when(c.rlike("[а-яё]"), ALPHABETS["cyr_lower"]).when(c.rlike("[А-ЯЁ]"), ALPHABETS["cyr_upper"]).otherwise(c))
    return F.substr(alphabet, number % F.length(alphabet) + 1, F.lit(1))


def _fill(part: Column) -> Column:
    """A part's characters after its prefix replaced one by one. The n-th letter or digit takes the n-th draw, so
    punctuation does not change what is drawn. A part that stays whole, as an address's domain of any length, is not taken apart."""
    text, prefix = part["text"], part["prefix"]
    drawn = F.transform(F.sequence(F.lit(1), F.length(text)), lambda i: F.struct(
        F.substr(text, i, F.lit(1)).alias("c"), (i <= prefix).alias("stays"),
        _number(part["stream"], F.length(F.regexp_replace(F.substr(text, F.lit(1), i), r"[^\p{L}\d]", ""))).alias("n")))
    filled = F.array_join(F.transform(drawn, lambda d: F.when(d["stays"], d["c"]).otherwise(_letter(d["c"], d["n"], part["hex"]))), "")
    return F.when(prefix >= F.length(text), text).when(F.length(text) > 0, filled).otherwise("")


def _part(text: Column, stream: Column, prefix: Column, hexadecimal: Column) -> Column:
    return F.struct(text.alias("text"), stream.alias("stream"), prefix.cast("int").alias("prefix"), hexadecimal.alias("hex"))


def _pieces(text: Column, stream: Column) -> Column:
    """The parts of an address's local part or domain, in time linear in its length."""
    once = F.array(F.substr(stream, F.lit(1), F.lit(64)))        # bound, or the stream would be made again for every chunk
    chunks = F.element_at(F.transform(once, lambda seed: F.transform(F.regexp_extract_all(text, F.lit(rf".{{1,{CHUNK}}}"), F.lit(0)), lambda c, i: _part(
        c, F.sha2(F.concat_ws("|", seed, i.cast("string")).cast("binary"), 512), F.lit(0), F.lit(False)))), 1)
    return F.when(F.length(text) <= LONG, F.array(_part(text, stream, F.lit(0), F.lit(False)))).otherwise(chunks)


def _chunks(e: Column, kind: Column, canon: Column, attempt: Column, key: str) -> Column:
    """The parts of a long secret, in time linear in its length."""
    once = F.array(F.struct(F.sha2(F.concat_ws("|", F.lit(key), kind, canon, attempt.cast("string")).cast("binary"), 512).alias("seed"),
                            canon.rlike("^[0-9a-f]+$").alias("hex"), _prefix_length(e, kind).alias("prefix")))
    parts = F.transform(once, lambda o: F.concat(
        F.array(_part(F.substr(e, F.lit(1), o["prefix"]), o["seed"], o["prefix"], o["hex"])),
        F.transform(F.regexp_extract_all(F.substr(e, o["prefix"] + 1), F.lit(rf".{{1,{CHUNK}}}"), F.lit(0)), lambda c, i: _part(
            c, F.sha2(F.concat_ws("|", o["seed"], i.cast("string")).cast("binary"), 512), F.lit(0), o["hex"]))))
    return F.element_at(parts, 1)


def _domain(domain: Column, attempt: Column, key: str) -> Column:
    """A domain's surrogate: its top-level label stays, the others are replaced; late attempts have letters before them."""
    top = F.substring_index(domain, ".", -1)
    parts = _pieces(F.substr(domain, F.lit(1), F.length(domain) - F.length(top)), _stream(key, F.lit("domain"), domain, attempt))
    more = F.greatest(attempt - GROW_AFTER + 1, F.lit(0)).cast("int")
    tail = F.sha2(F.concat_ws("|", F.lit(key), F.lit("domain tail"), domain, attempt.cast("string")).cast("binary"), 512)
    return F.concat(F.translate(F.substr(tail, F.lit(1), more), "0123456789", "ghijklmnop"), F.array_join(F.transform(parts, _fill), ""), top)


def with_stream(e: Column, kind: Column, canon: Column, attempt: Column, key: str, domain_attempt: Column | None = None) -> Column:
    """All that :func:`surrogate` needs of one mention; ``domain_attempt`` is that of an e-mail's domain."""
    domain_attempt = F.lit(0) if domain_attempt is None else domain_attempt
    long = (kind == "secret") & (F.length(canon) > LONG)
    return F.struct(e.alias("mention"), kind.alias("kind"), canon.alias("canon"), _prefix_length(e, kind).alias("prefix"),
                    F.when(long, "").otherwise(_stream(key, kind, canon, attempt)).alias("stream"),
                    F.when(long, _chunks(e, kind, canon, attempt, key)).alias("chunks"),
                    # symbols that the surrogate has more than the mention, and what they are drawn from
                    F.greatest(attempt - F.when(_is_fixed(e, kind), FULL_AFTER).otherwise(GROW_AFTER) + 1, F.lit(0)).alias("grown"),
                    F.when(attempt >= GROW_AFTER, F.sha2(F.concat_ws("|", F.lit(key), kind, F.sha2(canon.cast("binary"), 512), attempt.cast("string"),
                                                                     F.lit("tail")).cast("binary"), 512)).alias("tail"),
                    (attempt >= GROW_AFTER).alias("wide"),
                    # an e-mail's domain maps by itself, whatever the local part
                    F.when(kind == "email", _domain(F.substring_index(canon, "@", -1), domain_attempt, key))
                    .when(kind == "domain", _domain(canon, attempt, key)).alias("domain"))


def _is_fixed(e: Column, kind: Column) -> Column:
    """Formats that a further digit breaks."""
    return kind.isin("ssn", "ip") | ((kind == "phone") & ~e.startswith("+")) | ((kind == "secret") & e.rlike("^(?:AKIA|ASIA)[0-9A-Z]{16}$"))


def _tail(x: Column, alphabet: str) -> Column:
    """The symbols that the surrogate has more than the mention."""
    drawn = F.transform(F.sequence(F.lit(0), F.greatest(x["grown"], F.lit(1)) - 1), lambda i: F.substr(
        F.lit(ALPHABETS[alphabet]), (_number(x["tail"], i) % len(ALPHABETS[alphabet]) + 1).cast("int"), F.lit(1)))
    return F.when(x["grown"] > 0, F.array_join(drawn, "")).otherwise("")


def _grown(filled: Column, x: Column) -> Column:
    """Further digits at the end, or before the closing quote of a secret."""
    quoted = (x["kind"] == "secret") & filled.endswith('"')
    return F.when(x["grown"] == 0, filled).when(quoted, F.concat(F.substr(filled, F.lit(1), F.length(filled) - 1), _tail(x, "digit"), F.lit('"'))).otherwise(
        F.concat(filled, _tail(x, "digit")))


def _filled(x: Column) -> Column:
    """The mention with characters replaced: one part, or an e-mail's local part and its domain's surrogate."""
    e, kind = x["mention"], x["kind"]
    whole = F.array(_part(e, x["stream"], x["prefix"], (kind == "secret") & x["canon"].rlike("^[0-9a-f]+$")))
    mail = F.concat(_pieces(F.substring_index(F.lower(e), "@", 1), x["stream"]),
                    F.array(_part(F.concat(_tail(x, "lower"), F.lit("@")), x["stream"], x["grown"] + 1, F.lit(False))),
                    F.array(_part(x["domain"], x["stream"], F.length(x["domain"]), F.lit(False))))
    filled = F.array_join(F.transform(F.when(kind == "email", mail).when(x["chunks"].isNotNull(), x["chunks"]).otherwise(whole), _fill), "")
    return F.when(kind == "email", filled).otherwise(_grown(filled, x))


def _octets(x: Column) -> Column:
    """Octets of the same width: 1-9, 10-99, 100-254; later attempts: 1-254."""
    octets = F.array_join(F.transform(F.split(x["mention"], r"\."), lambda o, i: (
        F.when(x["wide"], 1 + _number(x["stream"], i * 2) % 254).when(F.length(o) == 1, 1 + _number(x["stream"], i * 2) % 9).when(F.length(o) == 2, 10 + _number(x["stream"], i * 2) % 90)
        .otherwise(100 + _number(x["stream"], i * 2) % 155)).cast("string")), ".")
    return F.when(x["grown"] > 0, F.concat(octets, F.lit("."), _tail(x, "digit"))).otherwise(octets)


def _person(x: Column) -> Column:
    """Title, first name of its gender (where the mention has one) and a generated surname, in the mention's script."""
    e, stream = x["mention"], x["stream"]
    body = F.substr(e, x["prefix"] + 1)
    cyrillic = body.rlike(r"\p{IsCyrillic}")
    gender = _gender(e)
    female = (gender == "f") | ((gender == "x") & (_number(stream, F.lit(0)) % 2 == 0))
    n = _number(stream, F.lit(2))
    first = (F.when(cyrillic & female, _pick(FIRST["cyrillic", "f"], n)).when(cyrillic, _pick(FIRST["cyrillic", "m"], n))
             .when(female, _pick(FIRST["latin", "f"], n)).otherwise(_pick(FIRST["latin", "m"], n)))
    syllable = lambda i: F.when(cyrillic, _pick(SYLLABLES["cyrillic"], _number(stream, i * 2 + 4))).otherwise(
        _pick(SYLLABLES["latin"], _number(stream, i * 2 + 4)))
    last = F.initcap(F.array_join(F.transform(F.sequence(F.lit(0), 2 + x["grown"]), syllable), ""))
    return F.concat(F.substr(e, F.lit(1), x["prefix"]), F.when(body.rlike(r"[-' ]"), F.concat(first, F.lit(" "))).otherwise(""), last)


def surrogates(xs: Column) -> Column:
    """The replacements of an array of mentions (structs made by :func:`with_stream`); without a kind a mention stays."""
    drafts = F.transform(xs, lambda x: F.struct(x["kind"].alias("kind"), (
        F.when(x["kind"].isNull(), x["mention"]).when(x["kind"] == "ip", _octets(x)).when(x["kind"] == "name", _person(x)).when(x["kind"] == "domain", x["domain"])
        .otherwise(_filled(x))).alias("draft")))
    # check digits of cards and IBANs follow from the rest
    checked = F.transform(drafts, lambda d: F.struct(d["kind"].alias("kind"), d["draft"].alias("draft"), F.when(d["kind"] == "card", (
        10 - _luhn(F.concat(_digits(F.substr(d["draft"], F.lit(1), F.length(d["draft"]) - 1)), F.lit("0"))) % 10) % 10)
        .when(d["kind"] == "iban", 98 - _mod97(F.concat(F.substr(d["draft"], F.lit(5)), F.substr(d["draft"], F.lit(1), F.lit(2)), F.lit("00")))).alias("check")))
    return F.transform(checked, lambda d: F.when(d["kind"] == "card", F.concat(
        F.substr(d["draft"], F.lit(1), F.length(d["draft"]) - 1), d["check"].cast("string"))).when(d["kind"] == "iban", F.concat(
            F.substr(d["draft"], F.lit(1), F.lit(2)), F.lpad(d["check"].cast("string"), 2, "0"), F.substr(d["draft"], F.lit(5)))).otherwise(d["draft"]))


def _is_entity(e: Column, kind: Column) -> Column:
    """Digit runs that only look like cards are no entities."""
    return ~((kind == "card") & ((_luhn(_digits(e)) % 10 != 0) | ~F.length(_digits(e)).between(13, 19)))


def _found(docs: DataFrame) -> DataFrame:
    """``docs`` with w_found: the entities of the text, in order, as (kind, canon, mention)."""
    mentions = F.when(F.col("text").rlike(HINT), F.regexp_extract_all(F.col("text"), F.lit(ENTITY), F.lit(0))).otherwise(F.array().cast("array<string>"))
    typed = F.transform(mentions, lambda e: F.struct(_type_of(e).alias("kind"), e.alias("mention")))
    return docs.withColumn("w_found", F.transform(typed, lambda x: F.struct(
        F.when(_is_entity(x["mention"], x["kind"]), x["kind"]).alias("kind"),
        canonical(x["mention"], x["kind"]).alias("canon"), x["mention"].alias("mention"))))


def _domain_of(canon: Column) -> Column:
    return F.substring_index(canon, "@", -1)


def distinct_entities(docs: DataFrame) -> DataFrame:
    """(kind, canon, mention) of every distinct entity; mention is one of its mentions (the smallest). Domains of e-mail addresses
    are entities of their own."""
    found = (_found(docs.select("text")).select(F.explode("w_found").alias("x")).where("x.kind is not null")
             .groupBy(F.col("x.kind").alias("kind"), F.col("x.canon").alias("canon")).agg(F.min("x.mention").alias("mention")))
    found = shared_checkpoint(found)
    domains = found.where("kind = 'email'").select(_domain_of(F.col("canon")).alias("canon")).distinct()
    return found.unionByName(domains.select(F.lit("domain").alias("kind"), "canon", F.col("canon").alias("mention")))


def redrawn_entities(entities: DataFrame, key: str, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """(kind, canon, attempt > 0) of the entities whose first surrogates collide. Domains settle first; addresses are drawn
    with the domains they end with."""
    entities = shared_checkpoint(entities)
    domains = _settled(entities.where("kind = 'domain'").withColumn("domain_attempt", F.lit(0)), key, max_attempts)
    known = domains.select(F.col("canon").alias("w_domain"), F.col("attempt").alias("domain_attempt"))
    rest = (entities.where("kind <> 'domain'").withColumn("w_domain", F.when(F.col("kind") == "email", _domain_of(F.col("canon"))))
            .join(known, "w_domain", "left").drop("w_domain").withColumn("domain_attempt", F.coalesce("domain_attempt", F.lit(0))))
    return domains.unionByName(_settled(rest, key, max_attempts))


def _settled(entities: DataFrame, key: str, max_attempts: int) -> DataFrame:
    """(kind, canon, attempt > 0) of ``entities`` (kind, canon, mention, domain_attempt)."""
    draw = F.element_at(surrogates(F.array(with_stream(F.col("mention"), F.col("kind"), F.col("canon"), F.col("attempt"), key, F.col("domain_attempt")))), 1)
    drawn_canon = canonical(F.col("drawn"), F.col("kind"))
    entities = shared_checkpoint(entities)
    drawn = shared_checkpoint(entities.withColumn("attempt", F.lit(0)).withColumn("drawn", draw).withColumn("drawn_canon", drawn_canon))
    for _ in range(max_attempts):
        # shared by two entities: all but the first draw again
        least = drawn.groupBy("kind", "drawn_canon").agg(F.min("canon").alias("keeps"), F.count("*").alias("n"))
        shared = (drawn.join(least.where("n > 1"), ["kind", "drawn_canon"]).where("canon <> keeps").select("kind", "canon"))
        # or itself an entity of the corpus
        real = drawn.join(entities.select("kind", F.col("canon").alias("drawn_canon")), ["kind", "drawn_canon"], "left_semi").select("kind", "canon")
        again = shared_checkpoint(shared.unionByName(real).distinct().withColumn("again", F.lit(1)))
        if again.isEmpty():
            return drawn.where("attempt > 0").select("kind", "canon", "attempt")
        drawn = shared_checkpoint(drawn.join(again, ["kind", "canon"], "left")
                                  .withColumn("attempt", F.col("attempt") + F.coalesce("again", F.lit(0)))
                                  .withColumn("drawn", F.when(F.col("again") == 1, draw).otherwise(F.col("drawn")))
                                  .withColumn("drawn_canon", F.when(F.col("again") == 1, drawn_canon).otherwise(F.col("drawn_canon"))).drop("again"))
    raise ValueError(f"some entities have no free surrogate after {max_attempts} attempts; their formats are exhausted")


def replace_entities(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with ``text`` rewritten, and w_n (entities replaced)."""
    columns = docs.columns
    found = _found(docs)
    redrawn = redrawn_entities(distinct_entities(docs), key)
    n = redrawn.count()
    if n:
        found = _with_attempts(found, F.broadcast(redrawn) if n <= BROADCAST_ROWS else redrawn)
        attempt = lambda kind, canon: F.coalesce(F.element_at("w_again", F.concat_ws("|", kind, canon)), F.lit(0))
    else:
        attempt = lambda kind, canon: F.lit(0)
    pieces = F.split("text", ENTITY, -1)
    ready = F.transform("w_found", lambda x: with_stream(x["mention"], x["kind"], x["canon"], attempt(x["kind"], x["canon"]), key,
                                                         attempt(F.lit("domain"), _domain_of(x["canon"]))))
    new = surrogates(ready)
    joined = F.concat(F.element_at(pieces, 1), F.array_join(F.zip_with(
        new, F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0))), lambda a, b: F.concat(a, b)), ""))
    text = F.when(F.size("w_found") > 0, joined).otherwise(F.col("text"))
    count = F.coalesce(F.size(F.filter("w_found", lambda x: x["kind"].isNotNull())), F.lit(0))
    kept = [F.col(f"`{c}`") if c != "text" else text.alias("text") for c in columns]
    return found.select(*kept, F.greatest(count, F.lit(0)).cast("long").alias("w_n"))


def _with_attempts(found: DataFrame, redrawn: DataFrame) -> DataFrame:
    """Adds w_again: "kind|canon" -> attempt of the text's redrawn entities. The text hash only carries the join: maps are
    looked up by entity, so texts that share a hash do no harm."""
    keyed = found.withColumn("w_key", F.xxhash64("text"))
    named = F.transform("w_found", lambda x: F.struct(x["kind"].alias("kind"), x["canon"].alias("canon")))
    domains = F.transform(F.filter("w_found", lambda x: x["kind"] == "email"), lambda x: F.struct(F.lit("domain").alias("kind"), _domain_of(x["canon"]).alias("canon")))
    used = (keyed.where(F.size("w_found") > 0).select("w_key", F.explode(F.concat(named, domains)).alias("x"))
            .select("w_key", F.col("x.kind").alias("kind"), F.col("x.canon").alias("canon")).distinct())
    maps = (used.join(redrawn, ["kind", "canon"]).groupBy("w_key")
            .agg(F.map_from_entries(F.collect_set(F.struct(F.concat_ws("|", "kind", "canon"), "attempt"))).alias("w_again")))
    return keyed.join(maps, "w_key", "left").drop("w_key")


QUERY_KEY = "surrogates-v1"


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, text with surrogates, n_entities of every document. The key is a parameter of the operator; the query uses
    a fixed one, so that its result can be compared."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return replace_entities(docs, QUERY_KEY).withColumnRenamed("w_n", "n_entities")

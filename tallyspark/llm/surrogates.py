r"""PII surrogates (5): keyed, type-consistent replacements for personal data. DataFrame functions only.

One pattern finds e-mail addresses, phone numbers, IPv4 addresses, card numbers, social security numbers and
names after a title. An entity is known by a canonical key: the lower-cased e-mail address, the digits of a phone
(with country code) or card number, each word of a name with the gender of its title. The distinct entities of
all texts get surrogates from a keyed SHA-256: letters become letters and digits digits; an e-mail's domain
follows the domain alone, so addresses of one domain stay together; a valid card number stays valid (Luhn); an
IPv4 address stays one; names are built from syllables of their script, with an ending that matches the title's
gender. Each mention is written in its own format: letter case, separators, title and number of names.

Collision rounds preserve distinctness: a candidate is taken by one entity only and never equals an entity of
the corpus; the others try again with the next attempt number, until none is left. One entity has one surrogate
in all documents and spellings (coreference): "Mr Smith" and "Mr. John Smith" share the surrogate of "Smith", and
a document's other mentions of a titled name's words, with or without the rest, are replaced by the same words. Only entities and rows that have some are shuffled; other documents pass by.
A very frequent entity meets a table with one row for each entity, so its rows can be split freely.

Names are found by a title only, in scripts with letter case; ``kinds`` counts what the pattern finds, not the
untitled mentions.

Defined results: null and empty texts stay; documents without entities stay as they are; null and repeated
ids are rows like others; other columns stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.storage import cut, fresh
from tallyspark.operators.joins import MAX_BROADCAST_ROWS, bounded_broadcast

#: Titles by gender of the person.
TITLES_M = ["Mr", "Herr", "Señor", "Sr", "Monsieur", "Don", "Господин", "Κύριος"]
TITLES_F = ["Mrs", "Ms", "Miss", "Frau", "Señora", "Sra", "Madame", "Mme", "Doña", "Госпожа", "Κυρία"]

#: A run of these characters is looked at once, from its start; local parts have at most 256 characters (mail allows
#: 64), domains at most 126 labels before the last (names allow 127), so no text makes the search deep or long.
EMAIL = (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]{1,256}+@"
         r"(?:[A-Za-z0-9-]++\.){1,126}[A-Za-z]{2,}")
PHONE = r"\+\d{1,3}[ .-]?\(?\d{2,4}\)?(?:[ .-]?\d{2,4}){2,4}(?!\d)|\(\d{3}\) ?\d{3}-\d{4}(?!\d)|(?<![\w.-])\d{3}-\d{3}-\d{4}(?![\w-])"
SSN = r"(?<![\w.-])\d{3}-\d{2}-\d{4}(?![\w-])"
IPV4 = r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d)"
CARD = (r"(?<![\w.-])(?:[3-6]\d{3}(?:[ -]?\d{4}){2}[ -]?\d{1,4}|3\d{3}[ -]?\d{6}[ -]?\d{4,5}"
        r"|(?:222[1-9]|22[3-9]\d|2[3-6]\d{2}|27[01]\d|2720)(?:[ -]?\d{4}){3})(?![\w-])")
NAME = r"(?<!\p{L})(?:" + "|".join(TITLES_M + TITLES_F) + r")\.? \p{Lu}\p{Ll}+(?: \p{Lu}\p{Ll}+)?(?!\p{L})"
KINDS = {"email": EMAIL, "phone": PHONE, "ssn": SSN, "ip": IPV4, "card": CARD, "name": NAME}
ANY = "|".join(f"(?:{p})" for p in KINDS.values())

#: Country codes of one and two digits; all others have three.
COUNTRY = r"^(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"
#: Starts the keys of names, which no text matched by a pattern has.
MARK = "\x1f"

#: Syllables of the scripts that names are built from.
SYLLABLES = {
    "latin": "ba be da do fa ga ha jo ka la li ma mi na no pe ra ri sa ta te va vi za",
    "cyrillic": "ба бе да до фа га ка ла ли ма ми на но пе ра ри са та те ва ви за",
    "greek": "βα δα δο φα γα κα λα λι μα μι να νο πε ρα ρι σα τα τε ζα",
}
ENDINGS = {"latin": ("n", "a"), "cyrillic": ("н", "на"), "greek": ("ς", "α")}


def kind_of(entity: Column) -> Column:
    out = None
    for kind, pattern in KINDS.items():
        hit = entity.rlike(f"^(?:{pattern})$")
        out = F.when(hit, F.lit(kind)) if out is None else out.when(hit, F.lit(kind))
    return out


def _byte(digest: Column, i: Column | int) -> Column:
    """Byte ``i`` of a SHA-256 in hex, as a number; the 32 bytes repeat."""
    i = F.lit(i) if isinstance(i, int) else i
    return F.conv(F.substr(digest, ((i % 32) * 2 + 1).cast("int"), F.lit(2)), 16, 10).cast("int")


def _digest(key: str, what: str, attempt: Column, value: Column) -> Column:
    return F.sha2(F.concat_ws("\x1f", F.lit(key), F.lit(what), attempt.cast("string"), value), 256)


def _same_format(value: Column, digest: Column) -> Column:
    """Letters for letters (case kept) and digits for digits; the rest stays."""

    def swap(c: Column, i: Column) -> Column:
        b = _byte(digest, i)
        return F.when(c.rlike("^[0-9]$"), (b % 10).cast("string")) \
            .when(c.rlike("^[a-z]$"), F.char(b % 26 + 97)).when(c.rlike("^[A-Z]$"), F.char(b % 26 + 65)).otherwise(c)

    return F.array_join(F.transform(F.split(value, ""), swap), "")


def _luhn(digits: Column) -> Column:
    """The Luhn sum of a digit string, modulo 10."""
    reversed_ = F.split(F.reverse(digits), "")

    def value(c: Column, i: Column) -> Column:
        d = c.cast("int")
        twice = d * 2
        return F.when(i % 2 == 0, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.transform(reversed_, value), F.lit(0), lambda a, x: a + x) % 10


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _card(digits: Column, digest: Column) -> Column:
    # the first digit, and the whole prefix where only some of that digit are cards, stay
    stay = F.when(digits.startswith("2"), 4).otherwise(1)
    swapped = F.concat(F.substr(digits, F.lit(1), stay),
                       F.substr(_same_format(digits, digest), stay + 1, F.char_length(digits)))
    body = F.substr(swapped, F.lit(1), F.char_length(swapped) - 1)
    check = (10 - _luhn(F.concat(body, F.lit("0")))) % 10
    return F.when(_luhn(digits) == 0, F.concat(body, check.cast("string"))).otherwise(swapped)


def _phone(digits: Column, digest: Column) -> Column:
    lead = F.regexp_extract(digits, COUNTRY, 0)
    return F.concat(lead, _same_format(F.substr(digits, F.char_length(lead) + 1, F.char_length(digits)), digest))


def _name(value: Column, digest: Column, attempt: Column) -> Column:
    """The surrogate of one word of a name, by its key (``name_key``)."""
    female, word = F.substr(value, F.lit(2), F.lit(1)) == "f", _plain(value)

    def built(script: str) -> Column:
        syllables = SYLLABLES[script].split()
        table = F.array(*[F.lit(s) for s in syllables])
        parts = F.transform(F.sequence(F.lit(0), 2 + attempt.cast("int")),
                            lambda k: F.element_at(table, _byte(digest, k) % len(syllables) + 1))
        m, f = ENDINGS[script]
        return F.initcap(F.concat(F.array_join(parts, ""), F.when(female, F.lit(f)).otherwise(F.lit(m))))

    return F.when(word.rlike(r"^\p{IsCyrillic}"), built("cyrillic")) \
        .when(word.rlike(r"^\p{IsGreek}"), built("greek")).otherwise(built("latin"))


def _title(mention: Column) -> Column:
    return F.regexp_extract(mention, r"^\p{L}+\.?", 0)


def _names(mention: Column) -> Column:
    """The words after the title."""
    return F.split(F.substr(mention, F.char_length(_title(mention)) + 2, F.char_length(mention)), " ")


def _gender(mention: Column) -> Column:
    return F.when(F.regexp_replace(_title(mention), r"\.", "").isin(TITLES_F), "f").otherwise("m")


def name_key(gender: Column, word: Column) -> Column:
    return F.concat(F.lit(MARK), gender, word)


def _plain(key: Column) -> Column:
    """A key as it stands in a text: of a name's the word."""
    return F.when(key.startswith(MARK), F.substr(key, F.lit(3), F.char_length(key))).otherwise(key)


def canonical(mention: Column, kind: Column) -> Column:
    """The key all spellings of an entity share."""
    national = F.when(mention.startswith("+"), "").otherwise("1")
    return F.when(kind == "email", F.lower(mention)).when(kind == "card", _digits(mention)) \
        .when(kind == "phone", F.concat(national, _digits(mention))).otherwise(mention)


def _filled(mention: Column, digits: Column) -> Column:
    """``mention`` with its digits replaced in order; more digits follow at the end."""

    def fill(c: Column, i: Column) -> Column:
        nth = F.char_length(_digits(F.substr(mention, F.lit(1), i + 1)))
        return F.when(c.rlike("^[0-9]$"), F.substr(digits, nth, F.lit(1))).otherwise(c)

    more = F.substr(digits, F.char_length(_digits(mention)) + 1, F.char_length(digits))
    return F.concat(F.array_join(F.transform(F.split(mention, ""), fill), ""), more)


def _cased(mention: Column, surrogate: Column) -> Column:
    """``surrogate`` with capitals where ``mention`` has them, counted from the end."""
    ahead = F.char_length(surrogate) - F.char_length(mention)

    def case(c: Column, i: Column) -> Column:
        upper = (i >= ahead) & F.substr(mention, F.greatest(i - ahead, F.lit(0)) + 1, F.lit(1)).rlike("^[A-Z]$")
        return F.when(upper, F.upper(c)).otherwise(c)

    return F.when(mention == F.lower(mention), surrogate).otherwise(
        F.array_join(F.transform(F.split(surrogate, ""), case), ""))


def rendered(mention: Column, kind: Column, surrogate: Column) -> Column:
    """The surrogate of an entity in a mention's format."""
    number = F.when(mention.startswith("+"), surrogate).otherwise(F.substr(surrogate, F.lit(2), F.char_length(surrogate)))
    return F.when(kind == "email", _cased(mention, surrogate)).when(kind == "card", _filled(mention, surrogate)) \
        .when(kind == "phone", _filled(mention, number)).otherwise(surrogate)


def candidate(entity: Column, kind: Column, attempt: Column, key: str) -> Column:
    """The surrogate that the key gives an entity at an attempt."""
    digest = _digest(key, "entity", attempt, entity)
    parts = F.split(entity, "@")
    domain = F.element_at(parts, -1)
    top = F.regexp_extract(domain, r"\.[A-Za-z]{2,}$", 0)
    host = F.substr(domain, F.lit(1), F.char_length(domain) - F.char_length(top))
    email = F.concat(_same_format(F.element_at(parts, 1), digest), F.lit("@"),
                     _same_format(host, _digest(key, "domain", F.lit(0), domain)), top)
    ip = F.concat_ws(".", F.lit("10"), *[_byte(digest, k).cast("string") for k in range(3)])
    # a short format can run out of values; late attempts are longer, so the rounds always end
    more = F.greatest(attempt.cast("int") - 7, F.lit(0))
    letters = _same_format(F.repeat(F.lit("a"), more), F.reverse(digest))
    digits = _same_format(F.repeat(F.lit("0"), more), F.reverse(digest))
    wide_ip = F.concat_ws(".", *[_byte(digest, k).cast("string") for k in range(4)])
    return F.when(kind == "email", F.concat(letters, email)) \
        .when(kind == "phone", F.concat(_phone(entity, digest), digits)) \
        .when(kind == "ip", F.when(more > 0, wide_ip).otherwise(ip)) \
        .when(kind == "card", F.concat(_card(entity, digest), digits)) \
        .when(kind == "name", _name(entity, digest, attempt)) \
        .otherwise(F.concat(_same_format(entity, digest), digits))


def surrogate_table(entities: DataFrame, key: str) -> DataFrame:
    """(entity, kind, surrogate) for distinct keys of entities: all surrogates of a kind differ, and none is an
    entity. Different kinds are never written alike."""
    if "kind" not in entities.columns:
        entities = entities.withColumn("kind", kind_of(F.col("entity")))
    entities = cut(entities.select("entity", "kind").distinct(), "entities")
    known = entities.select(_plain(F.col("entity")).alias("surrogate"), "kind").distinct()
    taken = None
    pending, attempt = entities, 0
    while attempt == 0 or not pending.isEmpty():
        offered = pending.withColumn("surrogate", candidate(F.col("entity"), F.col("kind"), F.lit(attempt), key))
        free = offered.join(known, ["surrogate", "kind"], "left_anti")
        if taken is not None:
            free = free.join(taken, ["surrogate", "kind"], "left_anti")
        won = free.groupBy("surrogate", "kind").agg(F.min("entity").alias("entity")) \
            .select("entity", "kind", "surrogate")
        won = cut(won, "surrogates")
        taken = won if taken is None else taken.unionByName(won)
        pending = cut(pending.join(won.select("entity", "kind"), ["entity", "kind"], "left_anti"), "pending")
        attempt += 1
    return taken


def entities_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(ANY), F.lit(0))


def _same(kind: str):
    return lambda k: k == kind


def replace_pii(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``docs`` with the personal data of ``text`` replaced and a last column ``kinds``: entities by kind."""
    found, rid, kinds, own = fresh(docs, "found", "rid", "kinds", "own")
    has = F.coalesce(F.col(text).rlike(ANY), F.lit(False))
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<int>"))
    hit = cut(docs.where(has).withColumn(found, entities_of(F.col(text))).withColumn(
        rid, F.monotonically_increasing_id()), "entity-documents")
    is_name = lambda e: e.rlike(f"^(?:{NAME})$")
    words = F.flatten(F.transform(F.filter(found, is_name), lambda e: F.transform(
        _names(e), lambda w: name_key(_gender(e), w))))
    each = hit.select(F.col(rid).alias("rid"), F.explode(F.array_distinct(F.concat(
        F.filter(found, lambda e: ~is_name(e)), words))).alias("mention"))
    each = each.withColumn("kind", F.when(F.col("mention").startswith(MARK), "name").otherwise(kind_of(F.col("mention"))))
    each = each.withColumn("entity", canonical(F.col("mention"), F.col("kind")))
    table = cut(surrogate_table(each, key), "surrogate-table")
    table = bounded_broadcast(table, table.limit(MAX_BROADCAST_ROWS + 1).count())
    maps = each.join(table, ["entity", "kind"]).withColumn(
        "surrogate", rendered(F.col("mention"), F.col("kind"), F.col("surrogate"))).groupBy("rid").agg(
        F.collect_list(F.struct("mention", "kind", "surrogate")).alias("own")).withColumnRenamed("own", own)
    joined = hit.join(maps, hit[rid] == maps["rid"]).drop(maps["rid"])
    lookup = F.map_from_arrays(F.transform(own, lambda x: x["mention"]), F.transform(own, lambda x: x["surrogate"]))
    kind_map = F.map_from_arrays(F.transform(own, lambda x: x["mention"]), F.transform(own, lambda x: x["kind"]))
    named = F.exists(own, lambda x: x["kind"] == "name")

    def word(w: Column) -> Column:
        known = [F.element_at(lookup, name_key(F.lit(g), w)) for g in "mf"]
        return F.when(w.rlike(r"^\p{Lu}\p{Ll}+$"), F.coalesce(*known, w)).otherwise(w)

    def untitled(piece: Column) -> Column:
        return F.when(named, F.array_join(F.transform(F.split(piece, r"(?<=\p{L})(?!\p{L})|(?<!\p{L})(?=\p{L})"), word), "")) \
            .otherwise(piece)

    def titled(e: Column) -> Column:
        return F.concat(_title(e), F.lit(" "), F.array_join(F.transform(
            _names(e), lambda w: F.element_at(lookup, name_key(_gender(e), w))), " "))

    pieces = F.split(F.col(text), ANY, -1)
    new = F.transform(F.arrays_zip(pieces.alias("p"), F.col(found).alias("e")), lambda z: F.concat(
        untitled(z["p"]), F.coalesce(F.element_at(lookup, z["e"]), titled(z["e"]), F.lit(""))))
    seen = F.transform(found, lambda e: F.coalesce(F.element_at(kind_map, e), F.lit("name")))
    count = F.map_from_arrays(F.array(*[F.lit(k) for k in KINDS]), F.array(
        *[F.size(F.array_remove(F.transform(seen, _same(kind)), False)) for kind in KINDS]))
    replaced = joined.withColumn(kinds, F.map_filter(count, lambda k, v: v > 0)).withColumn(text, F.array_join(new, ""))
    return docs.where(~has).withColumn(kinds, none).unionByName(replaced.select(*docs.columns, kinds))

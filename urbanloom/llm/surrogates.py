"""Surrogates for personal data, in DataFrame operations only.

1. One pattern finds e-mail and IPv4 addresses, card and phone numbers, long hexadecimal
   keys and names behind a title. Each entity gets a canonical form (lower case, digits
   only for numbers, the bare name for names), so one entity in two notations is one.
   Sixteen digits that fail the Luhn check are no card number: they stay and do not count.
2. Distinct entities get a surrogate from a keyed hash of type, canonical form and attempt:
   the same everywhere (coreference). A surrogate that equals another entity's surrogate or
   a real entity is drawn again with the next attempt (distinctness); only these rows
   take part in the next round. A number whose format has no free surrogate left loses its
   leading zero and then gets longer, so every entity finds one.
3. Occurrences get the surrogate in their own notation: digits go into the separators of
   the number, upper case stays, a name keeps its number of words, its title's gender and
   its script (Latin or Cyrillic). Card numbers pass the Luhn check.
4. Texts are put together again from the pieces between the occurrences. Only rows with
   entities are joined; an entity that a third of all rows hold is one row on its side.

Without the key a surrogate tells nothing about the entity. Null text stays null. Rows of
equal id and text get one result. All other columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import OWN, named, row_key, stored

_MALE = "Mr|Sir|Herr|Señor|Sr|Monsieur|Don|господин|г-н"
_FEMALE = "Mrs|Ms|Miss|Madam|Frau|Señora|Sra|Madame|Mme|Doña|госпожа|г-жа"
_NAME = rf"(?<![\p{{L}}])(?:{_MALE}|{_FEMALE})\.? \p{{Lu}}[\p{{Ll}}'-]+(?: \p{{Lu}}[\p{{Ll}}'-]+)?"
#: In order of preference at one place.
PATTERNS = {
    # a run is looked at from its start only and no group repeats, so time is linear and the stack flat
    "email": r"(?<![\p{L}0-9._%+-])[\p{L}0-9._%+-]++@[\p{L}0-9-]++\.[\p{L}0-9.-]*[\p{L}0-9-]",
    "ip": r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?![0-9]|\.[0-9])",
    "key": r"(?<![\p{L}0-9])(?=[a-fA-F]*[0-9])[0-9a-fA-F]{32,64}(?![\p{L}0-9])",
    "card": r"(?<![\p{L}0-9])[0-9]{4}(?:[ -]?[0-9]{4}){3}(?![\p{L}0-9])",
    "phone": r"(?<![\p{L}0-9])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?|[0-9]{2,4}[ .-])[0-9]{3,4}[ .-][0-9]{3,4}(?![\p{L}0-9])",
    "name": _NAME,
}
PATTERN = "|".join(f"(?:{p})" for p in PATTERNS.values())
_GIVEN = {
    "male latin": "Adam Bruno Carl David Emil Felix Hugo Ivan Jonas Karl Leon Marco Nils Oscar Paul Robert Simon Tom Victor Walter",
    "female latin": "Anna Berta Clara Diana Emma Flora Greta Helena Ines Julia Klara Lena Maria Nora Olivia Paula Rosa Sofia Tina Vera",
    "male cyrillic": "Иван Пётр Олег Игорь Борис Глеб Денис Егор Захар Кирилл Лев Максим Никита Павел Роман Семён Тимур Фёдор Юрий Яков",
    "female cyrillic": "Анна Вера Галина Дарья Елена Жанна Зоя Ирина Клара Лидия Мария Нина Ольга Полина Раиса София Тамара Ульяна Юлия Яна",
}
_SYLLABLES = {
    "latin": "ba be bo da de do fa fe ga go ha ka ke ko la le li lo ma me mi mo na ne no ra re ri ro sa se so",
    "cyrillic": "ба бе бо ва ве да де до за ка ке ко ла ле ли ло ма ме ми мо на не но па ра ре ри ро са се со та",
}


def _pick(words: str, code: Column) -> Column:
    items = words.split()
    return F.element_at(F.array(*map(F.lit, items)), (F.pmod(code, F.lit(len(items))) + 1).cast("int"))


def _nibbles(digest: Column, start: int, size: int) -> Column:
    return F.conv(F.substring(digest, start, size), 16, 10).cast("long")


def _kind(value: Column) -> Column:
    found = F.lit(None).cast("string")
    for kind, pattern in reversed(PATTERNS.items()):
        found = F.when(value.rlike(f"^(?:{pattern})$"), F.lit(kind)).otherwise(found)
    return F.when((found == "card") & ~_is_card(value), F.lit(None)).otherwise(found)


def _is_card(value: Column) -> Column:
    """The last digit is the check digit of those before it."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    return _luhn(F.substring(digits, 1, 15)) == digits


def _canonical(kind: Column, value: Column) -> Column:
    bare = F.regexp_replace(value, rf"^(?:{_MALE}|{_FEMALE})\.? ", "")
    return (
        F.when(kind == "card", F.regexp_replace(value, "[^0-9]", ""))
        .when(kind == "phone", F.concat_ws("|", *(F.regexp_replace(part, "[^0-9]", "") for part in _phone(value))))
        .when(kind == "name", F.concat(_form(value), F.lit(":"), F.lower(bare)))
        .otherwise(F.lower(value))
    )


def _phone(value: Column) -> tuple[Column, Column]:
    """The country code, empty if there is none, and the rest."""
    code = F.regexp_extract(value, r"^\+[0-9]{1,3}[ .-]?", 0)
    return code, value.substr(F.length(code) + 1, F.length(value))


def _form(value: Column) -> Column:
    """Gender and script of a name, and whether it has two words."""
    gender = F.when(value.rlike(rf"^(?:{_FEMALE})(?:\.? )"), "female").otherwise("male")
    script = F.when(value.rlike(r"\p{IsCyrillic}"), "cyrillic").otherwise("latin")
    words = F.when(F.size(F.split(value, " ")) > 2, "2").otherwise("1")
    return F.concat_ws(" ", gender, script, words)


def _luhn(payload: Column) -> Column:
    """The digits with their check digit."""
    digits = F.transform(F.split(F.reverse(payload), ""), lambda c: c.cast("int"))

    def weigh(x: Column, i: Column) -> Column:
        return F.when(i % 2 == 0, F.when(x > 4, 2 * x - 9).otherwise(2 * x)).otherwise(x)

    total = F.aggregate(F.transform(digits, weigh), F.lit(0), lambda a, x: a + x)
    return F.concat(payload, F.pmod(F.lit(10) - total % 10, F.lit(10)).cast("string"))


def _surrogate(key: str, kind: Column, canonical: Column, attempt: Column) -> Column:
    """The canonical surrogate. Later attempts draw from another hash; names get longer."""
    digest = F.sha2(F.concat_ws("|", F.lit(key), kind, attempt.cast("string"), canonical), 256)
    more = F.sha2(F.concat(F.lit(key), digest), 256)
    digits = F.concat(*[F.lpad((_nibbles(digest, 1 + 8 * k, 8) % 100_000_000).cast("string"), 8, "0") for k in range(4)])
    lead = (_nibbles(more, 1, 4) % 9 + 1).cast("string")
    bare = F.substring_index(canonical, "|", -1)
    # A format that is used up lets the leading zero go, then takes more digits.
    zero, longer = bare.startswith("0") & (attempt < 8), F.greatest(F.lit(0), F.floor((attempt - 12) / 4)).cast("int")
    number = F.concat(F.when(zero, "0").otherwise(lead), F.substring(digits, 1, 31))
    same = number.substr(F.lit(1), F.length(bare) + longer)
    letters = F.translate(digest, "0123456789abcdef", "abcdefghijklmnop")
    domain = F.sha2(F.concat_ws("|", F.lit(key), F.lit("domain"), F.substring_index(canonical, "@", -1)), 256)
    host = F.translate(F.substring(domain, 1, 8), "0123456789abcdef", "bcdfghjklmnprstv")
    octet = [(_nibbles(digest, 1 + 4 * k, 4) % (223 if k == 0 else 256) + (1 if k == 0 else 0)).cast("string") for k in range(4)]
    form, length = F.substring_index(canonical, ":", 1), attempt + 4
    family, given = F.lit(None).cast("string"), F.lit(None).cast("string")
    for script, syllables in _SYLLABLES.items():
        parts = F.array(*[_pick(syllables, _nibbles(digest, 1 + 4 * k, 4)) for k in range(12)])
        family = F.when(form.contains(script), F.array_join(F.slice(parts, F.lit(1), F.least(length, F.lit(12))), "")).otherwise(family)
    for name, words in _GIVEN.items():
        given = F.when(form.startswith(name), F.lower(_pick(words, _nibbles(more, 9, 4)))).otherwise(given)
    person = F.when(form.endswith("2"), F.concat_ws(" ", given, family)).otherwise(family)
    return (
        F.when(kind == "email", F.concat(F.substring(letters, 1, 12), F.lit("@"), host, F.lit(".example")))
        .when(kind == "ip", F.concat_ws(".", *octet))
        .when(kind == "key", F.concat(digest, more).substr(F.lit(1), F.length(canonical)))
        .when(kind == "card", _luhn(F.substring(same, 1, 15)))
        .when(kind == "phone", F.concat_ws("|", F.substring_index(canonical, "|", 1), same))
        .otherwise(F.concat(form, F.lit(":"), person))
    )


def _noted(kind: Column, value: Column, surrogate: Column) -> Column:
    """The surrogate in the notation of ``value``."""
    code, rest = _phone(value)
    chars, surrogate_digits = F.split(rest, ""), F.substring_index(surrogate, "|", -1)
    rank = F.transform(chars, lambda c, i: F.size(F.filter(F.slice(chars, F.lit(1), i + 1), lambda d: d.rlike("^[0-9]$"))))
    filled = F.array_join(
        F.zip_with(chars, rank, lambda c, r: F.when(c.rlike("^[0-9]$"), surrogate_digits.substr(r, F.lit(1))).otherwise(c)), ""
    )
    filled = F.concat(filled, surrogate_digits.substr(F.element_at(rank, -1) + 1, F.length(surrogate_digits)))
    title = F.regexp_extract(value, rf"^(?:{_MALE}|{_FEMALE})\.? ", 0)
    person = F.concat(title, F.initcap(F.substring_index(surrogate, ":", -1)))
    cased = F.when((value == F.upper(value)) & value.rlike("[A-F]"), F.upper(surrogate)).otherwise(surrogate)
    return (
        F.when(kind.isin("card", "phone"), F.concat(code, filled)).when(kind == "name", person).when(kind == "key", cased).otherwise(surrogate)
    )


def surrogate_table(entities: DataFrame, key: str) -> DataFrame:
    """(kind, canonical, surrogate) for distinct (kind, canonical), one to one."""
    real = stored(entities.select("kind", "canonical").distinct(), "pii-entities")
    pending, done, attempt = real, None, 0
    while True:
        drawn = stored(
            pending.withColumn("surrogate", _surrogate(key, F.col("kind"), F.col("canonical"), F.lit(attempt))), "pii-drawn"
        )
        taken = real.select("kind", F.col("canonical").alias("surrogate"))
        taken = taken if done is None else taken.unionByName(done.select("kind", "surrogate"))
        free = drawn.join(taken, ["kind", "surrogate"], "left_anti")
        winners = free.groupBy("kind", "surrogate").agg(F.min("canonical").alias("canonical")).select("kind", "canonical", "surrogate")
        done = stored(winners if done is None else done.unionByName(winners), "pii-surrogates")
        pending = stored(real.join(done, ["kind", "canonical"], "left_anti"), "pii-pending")
        if pending.isEmpty():
            return done
        attempt += 1


def replaced(
    docs: DataFrame, *, key: str, id_col: str = "doc_id", text_col: str = "text", counts: bool = False
) -> DataFrame:
    """``docs`` with every entity in the text replaced; with ``counts`` the column
    ``n_entities`` replaces any of that name."""
    found, at, of = f"{OWN}found", f"{OWN}id", f"{OWN}hash"
    text = named(text_col)
    columns = [c for c in docs.columns if not (counts and c == "n_entities")]
    has = F.coalesce(text.rlike(PATTERN), F.lit(False))
    keyed = row_key(docs.select(*[named(c) for c in columns]), id_col, text_col)
    clean = keyed.filter(~has).select(*[named(c) for c in columns], F.lit(0).cast("long").alias(f"{OWN}n"))
    marked = stored(keyed.filter(has).withColumn(found, F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))), "pii-rows")
    spans = marked.select(at, of, F.posexplode(found).alias("pos", "value")).dropDuplicates([at, of, "pos"])
    spans = spans.withColumn("kind", _kind(F.col("value"))).withColumn("canonical", _canonical(F.col("kind"), F.col("value")))
    spans = stored(spans, "pii-spans")
    real = spans.filter(F.col("kind").isNotNull())
    drawn = surrogate_table(real, key)
    new = real.join(drawn, ["kind", "canonical"]).select(
        at, of, "pos", _noted(F.col("kind"), F.col("value"), F.col("surrogate")).alias("new"), F.lit(1).alias("n")
    )
    # What only looks like an entity keeps its place among the pieces, as it is.
    same = spans.filter(F.col("kind").isNull()).select(at, of, "pos", F.col("value").alias("new"), F.lit(0).alias("n"))
    notes = (
        new.unionByName(same)
        .groupBy(at, of)
        .agg(F.array_sort(F.collect_list(F.struct("pos", "new"))).alias("notes"), F.sum("n").alias("n"))
        .withColumnsRenamed({at: f"{OWN}a", of: f"{OWN}o", "notes": f"{OWN}notes", "n": f"{OWN}n"})
    )
    pieces = F.split(text, PATTERN, -1)
    news = F.concat(F.col(f"{OWN}notes.new"), F.array(F.lit("")))
    again = F.array_join(F.zip_with(pieces, news, lambda p, n: F.concat(p, F.coalesce(n, F.lit("")))), "")
    joined = marked.join(notes, F.col(at).eqNullSafe(F.col(f"{OWN}a")) & (F.col(of) == F.col(f"{OWN}o")))
    dirty = joined.select(
        *[again.alias(c) if c == text_col else named(c) for c in columns], F.col(f"{OWN}n").cast("long")
    )
    out = clean.unionByName(dirty)
    return out.withColumnRenamed(f"{OWN}n", "n_entities") if counts else out.drop(f"{OWN}n")

"""Private data replaced by keyed surrogates. DataFrame expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from chondria.functions.casts import bound
from chondria.llm.common import row_of, stored, unpacked

ATTEMPTS = 16           # ways to make a surrogate, until it is distinct

# Words that stand before a name, and the gender that they tell.
MALE = ["Mr", "Sir", "Herr", "Herrn", "Monsieur", "Señor", "Sr", "Don"]
FEMALE = ["Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Mme", "Mademoiselle", "Señora", "Señorita", "Sra", "Srta", "Doña"]
NEUTRAL = ["Dr", "Prof", "Mx"]
MALE_CYRILLIC = ["Господин", "Г-н"]
FEMALE_CYRILLIC = ["Госпожа", "Г-жа"]
# Given names by gender and script, and syllables for family names.
GIVEN = {
    "male_latin": ["Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Hugo", "Ivan", "Jonas", "Leon", "Martin", "Oscar", "Paul", "Samuel", "Victor"],
    "female_latin": ["Alma", "Bella", "Clara", "Diana", "Elena", "Flora", "Greta", "Helena", "Ida", "Julia", "Laura", "Maria", "Nina", "Rosa", "Sofia"],
    "neutral_latin": ["Alex", "Charlie", "Dominique", "Eli", "Jules", "Kim", "Mika", "Noa", "Robin", "Sascha"],
    "male_cyrillic": ["Алексей", "Борис", "Виктор", "Дмитрий", "Иван", "Николай", "Олег", "Павел"],
    "female_cyrillic": ["Анна", "Вера", "Елена", "Ирина", "Мария", "Нина", "Ольга", "Софья"],
}
SYLLABLES = {"latin": ["bar", "cor", "dan", "fel", "gar", "hol", "ker", "lin", "mar", "nor", "pel", "ros", "sal", "tor", "ven", "wil"],
             "cyrillic": ["бар", "вол", "гор", "дон", "кар", "лен", "мар", "нов", "пет", "рож", "сол", "тар"]}

LABELS = r"(?i:password|passwd|pwd|secret|token|api[_-]{0,1}key|access[_-]{0,1}key)[\"']{0,1}\x20{0,2}[=:]"
LABEL = LABELS + r"\x20{0,2}[\"']{0,1}"
WORD = r"\p{Lu}[\p{L}'’-]+"
TITLES = {"male_latin": MALE, "female_latin": FEMALE, "neutral_latin": NEUTRAL, "male_cyrillic": MALE_CYRILLIC, "female_cyrillic": FEMALE_CYRILLIC}
TITLE = r"(?<![\p{L}\p{N}])(?:" + "|".join(w for t in TITLES.values() for w in sorted(t, key=len, reverse=True)) + r")\.?\x20"


#: Kinds in the order in which they are looked for at a place. Lookarounds keep digits from being cut out of longer runs.
KINDS = {
    "email": r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9._%+\-]++@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)*\.[A-Za-z]{2,}",
    "secret": rf"(?<=[=:\x20\"'])(?<={LABEL})[A-Za-z0-9_+/.\-]{{8,}}",
    "key": r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])",
    "hex": r"(?<![A-Za-z0-9])(?=[a-fA-F]*[0-9])[0-9a-fA-F]{32,}+(?![A-Za-z0-9])",
    "ip": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\.?\d)",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "card": r"(?<![\d.])(?:\d[\x20-]?){12,18}\d(?![\d.]?\d)",
    "ssn": r"(?<!\d)\d{3}-\d{2}-\d{4}(?!\d)",
    "phone": r"(?<![\d\w+])(?:(?:\+\d{1,3}[\x20.-]?)?(?:\(\d{2,4}\)[\x20.-]?)?\d{2,4}[\x20.-]\d{3,4}(?:[\x20.-]\d{2,4})?|0\d(?:[\x20.-]\d{2}){4}|\+\d(?:[\x20.()-]{0,2}\d){7,14})(?!\d)",
    "name": rf"(?<=\x20)(?=\p{{Lu}})(?<={TITLE}){WORD}(?:\x20{WORD})?",
}
FAMILY = "family"
NAMES = [*TITLES, FAMILY]       # kinds of a name's words: given names by the title's gender, and family names
POSSESSIVE = r"['’][sS]?$"
#: Words that may follow a name with a capital, and are none when they stand alone.
COMMON = ["He", "She", "It", "They", "We", "You", "The", "This", "That", "These", "Those", "And", "But", "Or", "If", "In", "On", "At", "As", "Of", "For", "From", "With", "To", "By", "His", "Her", "Their",
          "My", "Our", "Your", "Who", "When", "Where", "What", "Why", "How", "Is", "Was", "Are", "Has", "Had", "Will", "Not", "No", "So", "Then", "There", "Said"]
ANY = "|".join(f"(?:{p})" for p in KINDS.values())
#: Whatever a pattern finds has one of these: a digit, an at sign, a label or a key's first letters, or a title before a capital. One cheap look, which goes on
#: at few letters only, spares most texts the search.
HINT = (r"[@0-9]|(?=[apstAPST])" + LABELS + r"|A[KS]IA[A-Z]|["
        + "".join(sorted({w[0] for t in TITLES.values() for w in t})) + r"](?:" + "|".join(sorted({w[1:] for t in TITLES.values() for w in t})) + r")\.?\x20\p{Lu}")


def kind_of(value: Column, before: Column) -> Column:
    """The first kind whose whole pattern the entity has, so that a label or title doesn't change it; else ``before``, the text up to it, tells secrets and names."""
    told = F
    for kind, pattern in KINDS.items():
        if kind not in ("secret", "name"):
            told = told.when(value.rlike(f"^(?:{pattern})$"), F.lit(kind))
    told = told.when(before.rlike(LABEL + "$"), F.lit("secret"))
    for gender, titles in TITLES.items():
        told = told.when(before.rlike(rf"(?<![\p{{L}}\p{{N}}])(?:{'|'.join(titles)})\.?\x20$"), F.lit(gender))
    return told.otherwise("secret")


def canonical(kind: Column, value: Column) -> Column:
    """What makes two mentions the same entity: digits of numbers, small letters of addresses and hashes, words of names in one case and without 's, else the text as it is."""
    return (F.when(kind.isin("card", "ssn", "phone"), F.regexp_replace(value, r"[^0-9+]", "")).when(kind.isin("email", "hex"), F.lower(value))
            .when(kind == "iban", F.regexp_replace(value, " ", "")).when(kind.isin(*NAMES), F.initcap(F.lower(F.regexp_replace(value, POSSESSIVE, "")))).otherwise(value))


def stream(key: str, kind: Column, canon: Column, attempt: Column, length: Column) -> Column:
    """At least ``length`` numbers below 65536, that only who has the key can tell from the entity."""
    seed = F.concat_ws("\x1f", F.lit(key), kind, canon, attempt.cast("string"))
    blocks = F.transform(F.sequence(F.lit(0), F.floor(length / 16).cast("int")), lambda b: F.sha2(F.concat_ws("\x1f", F.lit(key), seed, b.cast("string")), 256))
    return bound(F.array_join(blocks, ""), lambda text: F.transform(
        F.sequence(F.lit(0), F.floor(F.length(text) / 4).cast("int") - 1), lambda i: F.conv(F.substring(text, i * 4 + 1, F.lit(4)), 16, 10).cast("int")))


def characters(value: Column) -> Column:
    return F.filter(F.split(value, ""), lambda c: c != "")


def letter(alphabet: str, number: Column) -> Column:
    return F.substring(F.lit(alphabet), number % len(alphabet) + 1, F.lit(1))


def in_format(value: Column, numbers: Column, upper: str = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", lower: str = "abcdefghijklmnopqrstuvwxyz", keep: Column | int = 0) -> Column:
    """``value`` with each letter and digit beyond the first ``keep`` replaced by one of its class; all else stays, so the format does."""
    at = F.lit(keep) if isinstance(keep, int) else keep
    return F.array_join(F.transform(characters(value), lambda c, i: F.when(i < at, c).when(c.rlike("[0-9]"), letter("0123456789", F.get(numbers, i)))
                                    .when(c.rlike("[A-Z]"), letter(upper, F.get(numbers, i))).when(c.rlike("[a-z]"), letter(lower, F.get(numbers, i))).otherwise(c)), "")


def digits_in_format(value: Column, digits: Column) -> Column:
    """The digits of ``value`` replaced, in order, by those of ``digits``; its separators stay."""
    return bound(characters(value), lambda cs: F.array_join(F.transform(cs, lambda c, i: F.when(
        c.rlike("[0-9]"), F.substring(digits, F.size(F.filter(F.slice(cs, 1, i + 1), lambda x: x.rlike("[0-9]"))), F.lit(1))).otherwise(c)), ""))


def luhn(digits: Column) -> Column:
    """``digits`` with the last one made to fit the checksum of card numbers."""
    def worth(c: Column, place: Column) -> Column:
        doubled = c * 2
        return F.when(place % 2 == 1, F.when(doubled > 9, doubled - 9).otherwise(doubled)).otherwise(c)

    n = F.length(digits)
    total = F.aggregate(F.transform(F.sequence(F.lit(1), n - 1), lambda i: worth(F.substring(digits, i, F.lit(1)).cast("int"), n - i)), F.lit(0), lambda a, x: a + x)
    return F.concat(F.substring(digits, F.lit(1), n - 1), ((10 - total % 10) % 10).cast("string"))


def renumbered(kind: Column, canon: Column, numbers: Column) -> Column:
    """New digits for a number: a country code, a card's first digit stay; a card fits its checksum if the original did."""
    plain = F.regexp_replace(canon, r"[^0-9]", "")
    code = F.length(F.regexp_extract(canon, r"^\+(1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})", 1))
    keep = F.when(kind == "card", F.lit(1)).when(kind == "phone", code).otherwise(F.lit(0))
    fresh = in_format(plain, numbers, keep=keep)
    return F.when((kind == "card") & (luhn(plain) == plain), luhn(fresh)).otherwise(fresh)


def address(canon: Column, numbers: Column) -> Column:
    """A mail address of the same build: local part and host names replaced, dots, digits' places and top level kept."""
    top = F.regexp_extract(canon, r"\.[a-z]+$", 0)
    return F.concat(in_format(F.regexp_replace(canon, r"\.[a-z]+$", ""), numbers), top)


def octets(canon: Column, numbers: Column) -> Column:
    """An address of four numbers below 256, each with as many digits as before."""
    return F.array_join(F.transform(F.split(canon, r"\."), lambda o, i: F.when(F.length(o) == 1, F.get(numbers, i) % 10).when(
        F.length(o) == 2, F.get(numbers, i) % 90 + 10).otherwise(F.get(numbers, i) % 156 + 100).cast("string")), ".")


def person(kind: Column, canon: Column, numbers: Column, attempt: Column) -> Column:
    """A word of a name, of the same gender and script; given names are few, so later attempts put two together, or a given name and syllables."""
    def pick(values: list[str], at: Column) -> Column:
        return F.element_at(F.array(*map(F.lit, values)), (at % len(values) + 1).cast("int"))

    def given(at: int) -> Column:
        out = pick(GIVEN["neutral_latin"], F.get(numbers, F.lit(at)))
        for name, values in GIVEN.items():
            out = F.when(kind == name, pick(values, F.get(numbers, F.lit(at)))).otherwise(out)
        return out

    cyrillic = kind.endswith("cyrillic") | canon.rlike(r"\p{IsCyrillic}")
    syllables = [F.when(cyrillic, pick(SYLLABLES["cyrillic"], F.get(numbers, F.lit(k)))).otherwise(pick(SYLLABLES["latin"], F.get(numbers, F.lit(k)))) for k in (0, 1, 2, 3, 7, 8)]
    family = F.initcap(F.when(attempt < 4, F.concat(*syllables[:4])).otherwise(F.concat(*syllables)))
    return F.when(kind == FAMILY, family).when(attempt == 0, given(5)).when(attempt < 3, F.concat_ws("-", given(5), given(6))).otherwise(F.concat_ws("-", given(5), family))


def surrogate(key: str, kind: Column, canon: Column, attempt: Column) -> Column:
    """The canonical form of an entity's replacement."""
    names = kind.isin(*NAMES)
    return bound(stream(key, kind, canon, attempt, F.length(canon)), lambda n: (
        F.when(kind.isin("card", "ssn", "phone"), renumbered(kind, canon, n)).when(kind == "ip", octets(canon, n)).when(kind == "email", address(canon, n))
        .when((kind == "hex") | ((kind == "secret") & canon.rlike("^[0-9a-f]+$")), in_format(canon, n, "ABCDEF", "abcdef"))
        .when(kind == "key", in_format(canon, n, keep=4)).when(kind == "iban", in_format(canon, n, keep=2)).when(names, person(kind, canon, n, attempt)).otherwise(in_format(canon, n))))


def rendered(kind: Column, value: Column, fresh: Column) -> Column:
    """A canonical replacement in the format of one mention."""
    return (F.when(kind.isin("card", "ssn", "phone"), digits_in_format(value, fresh))
            .when(kind == "iban", bound(characters(value), lambda cs: F.array_join(F.transform(cs, lambda c, i: F.when(c == " ", c).otherwise(
                F.substring(fresh, F.size(F.filter(F.slice(cs, 1, i + 1), lambda x: x != " ")), F.lit(1)))), "")))
            .when(kind.isin(*NAMES), F.concat(F.when((F.length(value) > 1) & (F.upper(value) == value), F.upper(fresh)).otherwise(fresh), F.regexp_extract(value, POSSESSIVE, 0)))
            .when(kind.isin("email", "hex") & (F.upper(value) == value) & (F.lower(value) != value), F.upper(fresh)).otherwise(fresh))


def assigned(entities: DataFrame, key: str) -> DataFrame:
    """(kind, canon, fresh) for distinct ``entities(kind, canon)``: replacements that differ from each other, and from all real entities of the kind.

    All are made at once from the key. Where two meet, or one meets a real entity, the one that has been tried fewest times (then the smaller)
    keeps it, the others try again; what still meets after ``ATTEMPTS`` gets a replacement that names its kind and a keyed digest.
    """
    kind, canon = F.col("kind"), F.col("canon")
    taken = entities.select(F.col("kind").alias("k"), F.when(F.col("kind").isin("card", "ssn", "phone"), F.regexp_replace("canon", "[^0-9]", "")).otherwise(F.col("canon")).alias("c")).distinct()
    now = stored(entities.select("kind", "canon", F.lit(0).alias("attempt"), surrogate(key, kind, canon, F.lit(0)).alias("fresh")), "surrogates")
    for attempt in range(1, ATTEMPTS + 1):
        first = now.groupBy(F.col("kind").alias("gk"), F.col("fresh").alias("gf")).agg(F.min(F.struct("attempt", "canon")).alias("keeper"), F.count(F.lit(1)).alias("n"))
        real = taken.join(now.select("kind", "fresh").distinct(), (F.col("k") == kind) & (F.col("c") == F.col("fresh")), "left_semi")
        met = first.where("n > 1").select("gk", "gf", "keeper.canon").unionByName(real.select(F.col("k").alias("gk"), F.col("c").alias("gf"), F.lit(None).cast("string").alias("canon")))
        met = met.groupBy("gk", "gf").agg(F.max(F.struct(F.col("canon").isNull().alias("none"), "canon")).alias("w")).select("gk", "gf", F.when(~F.col("w.none"), F.col("w.canon")).alias("keeps"))
        if met.isEmpty():
            return now.select("kind", "canon", "fresh")
        clash = F.col("gk").isNotNull() & ~F.col("canon").eqNullSafe(F.col("keeps"))
        again = surrogate(key, kind, canon, F.lit(attempt)) if attempt < ATTEMPTS else F.concat(F.lit("["), kind, F.lit("-"), F.substring(F.sha2(F.concat_ws("\x1f", F.lit(key), kind, canon), 256), 1, 32), F.lit("]"))
        now = stored(now.join(met, (kind == F.col("gk")) & (F.col("fresh") == F.col("gf")), "left").select(
            "kind", "canon", F.when(clash, F.lit(attempt)).otherwise(F.col("attempt")).alias("attempt"), F.when(clash, again).otherwise(F.col("fresh")).alias("fresh")), "surrogates")
    return now.select("kind", "canon", "fresh")


def linked(mentions: DataFrame) -> DataFrame:
    """(key, at, part, value, kind, canon, first) of ``mentions(key, at, part, value, kind)``: names as their words, with the bare ones found, too.

    A text's own names are the words found after titles. Where one stands without a title anywhere in the text, alone or in a run of them, it is a
    mention. A word is a given name if a text's titled names have it only before another, else a family name; both are what they are without
    regard to the title, but for the gender of a given name, that of most of its titles in all texts (those that tell none count last).
    ``at`` orders the pieces of a text; ``first`` tells the first word of a mention.
    """
    titled = mentions.where(F.col("kind").isin(*TITLES)).select("key", "kind", F.split("value", " ").alias("w"))
    bare = F.regexp_replace("x", POSSESSIVE, "")
    words = titled.select("key", "kind", (F.size("w") > 1).alias("two"), F.posexplode("w").alias("i", "x")).select("key", "kind", bare.alias("x"), (F.col("two") & (F.col("i") == 0)).alias("given"), (F.col("i") > 0).alias("last"))
    canon = canonical(F.lit(FAMILY), F.col("x"))
    own = words.groupBy(F.col("key").alias("of"), canon.alias("name")).agg((F.bool_or("given") & ~F.bool_or("last")).alias("given"))
    own = own.groupBy("of").agg(F.collect_list(F.when(F.col("given"), F.col("name"))).alias("givens"), F.sort_array(F.collect_list(F.when(
        (F.length("name") > 2) & ~F.col("name").isin(COMMON), F.col("name"))), asc=False).alias("names"))
    # in any case from a capital on; a longer name before one that it begins with
    one = F.concat(F.lit(r"(?=\p{Lu})(?iu:"), F.array_join("names", "|"), F.lit(")"))
    own = own.select("of", "givens", F.when(F.size("names") > 0, F.concat(F.lit(r"(?<![\p{L}\p{N}])"), one, F.lit(r"(?:\x20"), one, F.lit(r")*(?![\p{L}\p{N}])"))).alias("pattern"))
    met = mentions.join(stored(own, "names"), F.col("key") == F.col("of"), "left").drop("of")
    part = F.coalesce(F.col("part"), F.lit(""))
    some = F.col("pattern").isNotNull() & F.rlike(part, F.col("pattern"))
    last = F.struct(F.col("value").alias("value"), F.col("kind").alias("kind"))
    found = F.transform(F.regexp_extract_all(part, F.col("pattern"), F.lit(0)), lambda v: F.struct(v.alias("value"), F.lit(FAMILY).alias("kind")))
    pieces = F.when(some, F.arrays_zip(F.split(part, F.col("pattern"), -1).alias("part"), F.concat(found, F.array(last)).alias("m"))).otherwise(F.array(F.struct(part.alias("part"), last.alias("m"))))
    met = met.select("key", "at", "givens", F.posexplode(pieces).alias("j", "p")).select("key", "at", "j", "givens", "p.part", "p.m.value", "p.m.kind")
    name = F.coalesce(F.col("kind").isin(*NAMES), F.lit(False))
    met = met.select("key", "at", "j", "givens", "part", "kind", F.posexplode(F.when(name, F.split("value", " ")).otherwise(F.array("value"))).alias("k", "value"))
    # words of a mention after its first are parted by a space
    met = met.select("key", F.struct("at", "j", "k").alias("at"), F.when(F.col("k") == 0, F.col("part")).otherwise(" ").alias("part"), "value", "kind",
                     F.when(name, canonical(F.lit(FAMILY), F.col("value"))).alias("canon"), (F.col("k") == 0).alias("first"), "givens")
    given = F.coalesce(name & F.array_contains("givens", F.col("canon")), F.lit(False))
    met = stored(met.select(*[c for c in met.columns if c != "givens"], given.alias("given")), "linked")
    told = met.where(F.col("given") & F.col("kind").isin(*TITLES)).groupBy(F.col("canon").alias("name"), F.col("kind").alias("gender")).agg(F.count(F.lit(1)).alias("n"))
    told = told.groupBy("name").agg(F.max(F.struct(~F.col("gender").startswith("neutral"), "n", "gender")).alias("most")).select("name", F.col("most.gender").alias("gender"))
    # only given names meet their genders; a piece without one has no key to be joined by
    asked = met.where("given").join(told, F.col("canon") == F.col("name"), "left").drop("name")
    met = asked.unionByName(met.where("not given").withColumn("gender", F.lit(None).cast("string")))
    kind = F.when(F.col("given"), F.coalesce("gender", F.lit("neutral_latin"))).when(name, F.lit(FAMILY)).otherwise(F.col("kind"))
    met = met.select("key", "at", "part", "value", kind.alias("kind"), "canon", "first")
    return met.withColumn("canon", F.when(F.col("value").isNotNull(), F.coalesce("canon", canonical(F.col("kind"), F.col("value")))))


def replaced(df: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row of ``df`` with ``text_col`` cleaned and ``n_entities``, the number of mentions replaced.

    Mail and network addresses, card, account, social-security and phone numbers, keys, hashes, secrets after their labels and names after their titles are found by
    pattern, and a text's own names where they stand without a title. An entity's replacement depends on ``key``, kind and canonical form: mentions of one entity stay mentions of one entity in all documents,
    whatever their format; different entities stay different. Type, length, case, separators, script, gender and checksum are kept.

    Texts without an entity pass straight through. Of the others, each different text is taken apart once: its mentions meet the
    replacements of the distinct entities in a join that adaptive execution splits at hot ones, then it is put together again and goes to its rows
    by its digest. NULL text stays NULL with 0 entities. Repeated rows come out alike. Extra columns are kept; one named
    ``n_entities`` is replaced. An empty table gives an empty result.
    """
    own = [c for c in df.columns if c != "n_entities"]
    text = df[text_col].cast("string")
    rest = [c for c in own if c != text_col]
    # written once, as the search is the dear part and three ways lead on from it
    rows = stored(df.select(row_of(df, rest) if rest else F.struct(F.lit(0).alias("_")).alias("row"), text.alias("text"),
                            F.when(text.rlike(HINT), F.regexp_extract_all(text, F.lit(ANY), F.lit(0))).otherwise(F.array().cast("array<string>")).alias("found")), "found")
    some = F.coalesce(F.size("found") > 0, F.lit(False))

    def out(cleaned: DataFrame, clean: Column, n: Column) -> DataFrame:
        return cleaned.select(*[clean.alias(c) if c == text_col else unpacked([c])[0] for c in own], n.cast("long").alias("n_entities"))

    free = out(rows.where(~some), F.col("text"), F.lit(0))
    held = rows.where(some).withColumn("digest", F.sha2("text", 256))
    texts = held.groupBy(F.col("digest").alias("key")).agg(F.min("text").alias("text"), F.min("found").alias("found"))
    parts = F.split("text", ANY, -1)
    mentions = texts.select("key", F.posexplode(F.arrays_zip(parts.alias("part"), F.col("found").alias("value"))).alias("at", "x")).select("key", "at", "x.part", "x.value")
    # what stands before a mention may reach back over the last one only as far as its own part
    kind = kind_of(F.col("value"), F.coalesce(F.col("part"), F.lit("")))
    mentions = stored(mentions.withColumn("kind", F.when(F.col("value").isNotNull(), kind)), "mentions")
    mentions = stored(linked(mentions), "mentions")
    fresh = assigned(mentions.where("value is not null").select("kind", "canon").distinct(), key).select(F.col("kind").alias("k"), F.col("canon").alias("c"), "fresh")
    met = mentions.where("value is not null").join(fresh, (F.col("kind") == F.col("k")) & (F.col("canon") == F.col("c"))).select(
        "key", "at", "part", "first", rendered(F.col("kind"), F.col("value"), F.col("fresh")).alias("value"))
    # the last piece of a text has no mention and goes past the join
    joined = met.unionByName(mentions.where("value is null").select("key", "at", "part", "first", F.lit(None).cast("string").alias("value")))
    whole = joined.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("at", "part", "value"))).alias("parts"), F.count_if(F.col("value").isNotNull() & F.col("first")).alias("n"))
    whole = whole.select("key", "n", F.array_join(F.transform("parts", lambda p: F.concat(F.coalesce(p["part"], F.lit("")), F.coalesce(p["value"], F.lit("")))), "").alias("clean"))
    met = held.select("row", "digest").join(whole, F.col("digest") == F.col("key"))
    return free.unionByName(out(met, F.col("clean"), F.col("n")))

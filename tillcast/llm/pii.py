"""Surrogates for personal data.

Mentions are found by one pattern, reduced to entities (the same address in other letter case, the
same number in another layout, are one entity) and every entity gets a replacement drawn from a keyed
hash: of its kind, in its script and gender, laid out as the mention is. A draw that another entity got
before, or that is itself an entity of the data, is drawn again, so distinct entities stay distinct and
every mention of an entity reads the same in all texts.

Found are: mail addresses in ASCII; IPv4 addresses; IPv6 addresses, full or shortened (these beginning with four digits,
as all addresses of hosts do); card numbers of 13 to 19 digits; US social security numbers; phone numbers in
international form (+ and 8 to 15 digits, in groups or not), in groups of which the last two have 3 or 4 digits, in the
national groups of France, Spain and Germany, and of 10 digits without groups (beginning with 2 to 9, or with 0: up to 12);
listed given names before a name, and names after a listed given name or title, with hyphens, apostrophes, an
initial or particles such as von and de, also all in capitals. Not found: names without a listed given name or title before
them, second family names without a hyphen, mail addresses outside ASCII, street addresses, dates and other numbers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.functions.lineage import discard, materialise
from tillcast.llm.common import column, fresh

# Given names by script and gender (detected, and put for one another), titles, syllables.
GIVEN = {
    ("latin", "f"): ["Maria", "Anna", "Emma", "Laura", "Sophie", "Julia", "Sarah", "Elena", "Claire", "Carmen", "Ingrid", "Alice"],
    ("latin", "m"): ["John", "Peter", "Michael", "Thomas", "Pierre", "Carlos", "Hans", "David", "Robert", "Louis", "Javier", "Stefan"],
    ("cyrillic", "f"): ["Анна", "Мария", "Елена", "Ольга", "Наталья", "Ирина"],
    ("cyrillic", "m"): ["Иван", "Сергей", "Дмитрий", "Алексей", "Николай", "Павел"],
    ("greek", "f"): ["Μαρία", "Ελένη", "Κατερίνα", "Σοφία"],
    ("greek", "m"): ["Γιώργος", "Νίκος", "Δημήτρης", "Κώστας"],
}
TITLES = ["Mr", "Mrs", "Ms", "Miss", "Dr", "Herr", "Frau", "Señor", "Señora", "Monsieur", "Madame", "Mme", "Г-н", "Г-жа", "Κύριος", "Κυρία"]
SYLLABLES = {
    "latin": ["ba", "den", "fi", "gor", "hal", "ke", "lin", "mo", "nor", "pe", "ras", "sil", "ta", "ver", "wen", "zo"],
    "cyrillic": ["ба", "ден", "фи", "гор", "хал", "ке", "лин", "мо", "нор", "пе", "рас", "сил", "та", "вер", "вен", "зо"],
    "greek": ["βα", "δεν", "φι", "γορ", "χαλ", "κε", "λιν", "μο", "νορ", "πε", "ρασ", "σιλ", "τα", "βερ", "θεν", "ζο"],
}
FAMILY_ENDS = {"latin": "", "cyrillic": "ов", "greek": "ίδης"}
FAMILY_ENDS_F = {"latin": "", "cyrillic": "ова", "greek": "ίδου"}

_BARE = str.maketrans("ΆΈΉΊΌΎΏ", "ΑΕΗΙΟΥΩ")  # Greek capitals are mostly written without accents
#: Given names as written to the listed form.
WRITTEN = {form: n for names in GIVEN.values() for n in names for form in (n, n.upper(), n.upper().translate(_BARE))}
_GIVENS = "|".join(WRITTEN)
_TITLES = "|".join(dict.fromkeys([*TITLES, *(t.upper() for t in TITLES if t != "Ms")]))  # MS is mostly no title
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
_HEX = r"[0-9A-Fa-f]{1,4}"
#: What may stand between a given name or title and the family name.
_PARTICLE = r"(?:(?:von|van|vom|zu|zur|de|der|den|del|della|la|las|los|le|du|da|dos|di|y)\x20)?"
_BETWEEN = rf"(?:\p{{Lu}}\.\x20)?{_PARTICLE}{_PARTICLE}"  # written twice: Java wants an obvious length behind
_PHONES = (
    r"(?:\+33[ .-]?(?:\(0\)[ .-]?)?[1-9]|0[1-9])(?:[ .-]?\d{2}){4}(?!\w|-\w)",  # France
    r"(?:\+34[ .-]?)?[6-9]\d{2}(?:[ .-]\d{2}){3}(?!\w|-\w)",  # Spain
    r"(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]\d{3,4}(?!\d)",
    r"\(?0[1-9]\d{1,3}\)?(?: ?[/-] ?| )(?:\d{5,9}|\d{2,4}(?:[ -]\d{2,6}){1,3})(?!\d)",  # Germany
    r"\+[1-9](?:[ ()./-]{0,2}\d){7,14}(?!\d)",
    r"(?<!\d[.,-])(?:[2-9]\d{9}|0[1-9]\d{8,10})(?!\w|[.,-]\d)",
)
#: Kinds in the order in which the pattern tries them.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+(?<=[A-Za-z]{2})",
    "ip": rf"(?<![\d.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\d|\.\d)",
    "ip6": rf"(?<![\w:.])(?:{_HEX}(?::{_HEX}){{7}}|[0-9A-Fa-f]{{4}}(?::{_HEX}){{0,6}}::(?:{_HEX}(?::{_HEX}){{0,6}})?)(?![\w:]|\.\d)",
    "card": r"(?<![\w+-])\d(?:[ -]?\d){12,18}(?!\d)",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "phone": rf"(?<![\w+])(?:{'|'.join(_PHONES)})",
    "given": rf"(?=\p{{Lu}})(?<!\p{{L}})(?:{_GIVENS})(?=(?:-(?:{_GIVENS}))?\x20{_BETWEEN}\p{{Lu}}['’]?\p{{L}})(?!\p{{L}})",
    "family": rf"(?=\p{{Lu}})(?<=(?<!\p{{L}})(?:{_GIVENS}|{_TITLES})\.?\x20{_BETWEEN})\p{{Lu}}(?:['’]\p{{Lu}})?\p{{L}}+(?:[-'’]\p{{Lu}}\p{{L}}+)*",
}
MENTION = "|".join(PATTERNS.values())
#: A text without this has no mention; one cheap look at each character.
HINT = rf"[0-9@]|::|(?=\p{{Lu}})(?<!\p{{L}})(?:{_GIVENS}|{_TITLES})\.?\x20{_BETWEEN}\p{{Lu}}"
#: Country codes of one and two digits; all others have three.
COUNTRY = r"(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"
KEY = "tillcast"  # the secret of the keyed hash: give your own
DRAWS = 64  # after so many a kind's space is used up, and the call fails


def _kind(m: Column) -> Column:
    """The kind of a mention, from its own letters."""
    out = F.when(m.contains("@"), "email").when(m.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"), "ip").when(m.contains("::") | m.rlike(r"^[0-9A-Fa-f]{1,4}:"), "ip6")
    digits = F.length(F.regexp_replace(m, r"\D", ""))
    out = out.when(m.rlike(r"^\d{3}-\d{2}-\d{4}$"), "ssn").when(m.rlike(r"^\d(?:[ -]?\d)+$") & (digits >= 13), "card").when(digits > 0, "phone")
    return out.when(m.isin(list(WRITTEN)), "given").otherwise("family")


def _canonical(kind: Column, m: Column) -> Column:
    """What all mentions of an entity have in common."""
    digits = F.regexp_replace(m, r"\D", "")
    national = F.when(m.startswith("+"), F.regexp_replace(digits, f"^{COUNTRY}", "")).otherwise(digits)
    listed = F.create_map(*[F.lit(x) for pair in WRITTEN.items() for x in pair])
    name = F.array_join(F.transform(F.split(F.lower(m), r"(?<=[-'’])"), F.initcap), "")  # MÜLLER-SCHMIDT is Müller-Schmidt
    return (F.when(kind == "email", F.lower(m)).when(kind == "phone", F.regexp_replace(national, "^0", ""))
            .when(kind.isin("card", "ssn"), digits).when(kind == "ip6", _groups(m))
            .when(kind == "given", F.get(F.array(F.element_at(listed, m)), F.lit(0))).when(kind == "family", name).otherwise(m))


def _groups(m: Column) -> Column:
    """An IPv6 address in small letters with all its groups, without zeros in front of them."""
    def part(at):
        return F.array_remove(F.split(F.substring_index(F.lower(m), "::", at), ":"), "")
    left, right = part(1), F.when(m.contains("::"), part(-1)).otherwise(F.array().cast("array<string>"))
    zeros = F.array_repeat(F.lit("0"), F.greatest(F.lit(0), 8 - F.size(left) - F.size(right)))
    return F.array_join(F.transform(F.concat(left, zeros, right), lambda g: F.regexp_replace(g, "^0+(?=.)", "")), ":")


def _script(m: Column) -> Column:
    return F.when(m.rlike(r"^\p{IsCyrillic}"), "cyrillic").when(m.rlike(r"^\p{IsGreek}"), "greek").otherwise("latin")


def _number(h: Column, at: int, below: int) -> Column:
    """A whole number below ``below`` from six hexadecimal digits of the hash."""
    return (F.conv(F.substring(h, at, 6), 16, 10).cast("long") % below).cast("int")


def _digits(h: Column) -> Column:
    """64 decimal digits."""
    return F.translate(h, "abcdef", "385017")


def _luhn(digits: Column) -> Column:
    """Sum of a card number's digits, every second from the right doubled; a multiple of ten if valid."""
    reversed_digits = F.split(F.reverse(digits), "")

    def weight(d, i):
        doubled = d.cast("int") * 2
        return F.when(i % 2 == 0, d.cast("int")).when(doubled > 9, doubled - 9).otherwise(doubled)
    return F.aggregate(F.transform(reversed_digits, weight), F.lit(0), lambda a, b: a + b)


def _pick(names: list[str], index: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, names)), index + 1)


def _draw(kind: Column, c: Column, attempt: Column, key: str) -> Column:
    """The replacement of an entity, in canonical form."""
    h = F.sha2(F.concat_ws("\x1f", F.lit(key), kind, c, attempt.cast("string")), 256)
    n, digits = F.length(c), _digits(h)
    letters = F.lit("bcdfghjklmnprstvwz")

    def local(ch, i):
        some = F.conv(F.substring(h, (i % 62) + 1, 2), 16, 10).cast("int")
        return (F.when(ch.rlike("[a-z]"), F.substring(letters, some % 18 + 1, F.lit(1)))
                .when(ch.rlike("[0-9]"), (some % 10).cast("string")).otherwise(ch))

    name, domain = F.substring_index(c, "@", 1), F.substring_index(c, "@", -1)
    email = F.concat(F.array_join(F.transform(F.split(name, ""), local), ""), F.lit("@m"),
                     F.substring(F.sha2(F.concat_ws("\x1f", F.lit(key), domain), 256), 1, 6), F.lit(".example.net"))
    ip = F.concat_ws(".", *[(_number(h, 1 + 7 * k, 16 if k == 0 else 256) + (240 if k == 0 else 0)).cast("string") for k in range(4)])  # reserved block
    groups = F.array(*[F.regexp_replace(F.substring(h, 1 + 4 * k, 4), "^0+(?=.)", "") for k in range(6)])
    ip6 = F.concat(F.lit("2001:db8:"), F.array_join(groups, ":"))  # block for documentation
    body = F.concat(F.left(c, F.lit(1)), F.substring(digits, F.lit(1), n - 2))
    check = ((10 - _luhn(F.concat(body, F.lit("0"))) % 10) % 10).cast("string")
    card = F.concat(body, F.when(_luhn(c) % 10 == 0, check).otherwise(F.right(digits, F.lit(1))))
    phone = F.concat((_number(h, 1, 8) + 2).cast("string"), F.substring(digits, F.lit(8), n - 1))
    ssn = F.concat(F.lit("9"), F.substring(digits, 2, 8))  # never issued
    out = F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "ip6", ip6).when(kind == "card", card).when(kind == "phone", phone).when(kind == "ssn", ssn)
    for (script, gender), names in GIVEN.items():
        # A keyed rotation of the list: distinct names stay distinct, in script and gender.
        shift = int.from_bytes(f"{key}{script}{gender}".encode(), "big") % (len(names) - 1) + 1
        turned = F.create_map(*[F.lit(x) for i, a in enumerate(names) for x in (a, names[(i + shift) % len(names)])])
        out = out.when((kind == "given") & c.isin(names), F.get(F.array(F.element_at(turned, c)), F.lit(0)))
    for script, syllables in SYLLABLES.items():
        parts = [_pick(syllables, _number(h, 1 + 6 * k, len(syllables))) for k in range(4)]
        extra = F.when(attempt > 8, _pick(syllables, _number(h, 40, len(syllables)))).otherwise("")  # room for very many names
        if script == "cyrillic":
            end = F.when(c.rlike("(?:ова|ева|ина|ая)$"), FAMILY_ENDS_F[script]).otherwise(FAMILY_ENDS[script])
        elif script == "greek":
            end = F.when(c.rlike("ου$"), FAMILY_ENDS_F[script]).otherwise(FAMILY_ENDS[script])
        else:
            end = F.lit("")
        out = out.when((kind == "family") & (_script(c) == script), F.concat(F.initcap(F.concat(*parts, extra)), end))
    return out


def _laid_out(kind: Column, m: Column, drawn: Column) -> Column:
    """The replacement in the layout of a mention."""
    digits = F.regexp_replace(m, r"\D", "")
    new = F.concat(F.left(digits, F.length(digits) - F.length(drawn)), drawn)  # a country code or 0 in front stays

    def place(ch, i):
        at = F.length(F.regexp_replace(F.substring(m, F.lit(1), i + 1), r"\D", ""))
        return F.when(ch.rlike(r"\d"), F.substring(new, at, F.lit(1))).otherwise(ch)

    numbers = F.array_join(F.transform(F.split(m, ""), place), "")
    upper = (m == F.upper(m)) & (F.length(m) > 1) & kind.isin("email", "given", "family") | (kind == "ip6") & m.rlike("[A-F]")
    return F.when(kind.isin("card", "ssn", "phone"), numbers).when(upper, F.upper(drawn)).otherwise(drawn)


def surrogates(entities: DataFrame, key: str = KEY) -> DataFrame:
    """``kind, canonical, drawn`` for distinct ``kind, canonical``: no two entities of a kind get the same, and
    none gets what is an entity of the data. (Given names are turned within their list: distinct by
    construction, but a name of the data may stand for another.)"""
    spark: SparkSession = entities.sparkSession
    pending = materialise(entities.select("kind", "canonical", F.lit(0).alias("attempt")))
    own = entities.select("kind", F.col("canonical").alias("drawn")).filter("kind <> 'given'")
    done: list[DataFrame] = []
    for _ in range(DRAWS):
        drawn = pending.withColumn("drawn", _draw(F.col("kind"), F.col("canonical"), F.col("attempt"), key))
        taken = reduce(DataFrame.unionByName, [d.select("kind", "drawn") for d in done], own).distinct().withColumn("taken", F.lit(True))
        first = drawn.groupBy("kind", "drawn").agg(F.min("canonical").alias("first"))
        judged = materialise(drawn.join(first, ["kind", "drawn"]).join(taken, ["kind", "drawn"], "left")
                             .withColumn("good", (F.col("canonical") == F.col("first")) & F.col("taken").isNull()))
        done.append(judged.filter("good").select("kind", "canonical", "drawn"))
        pending = judged.filter("not good").select("kind", "canonical", (F.col("attempt") + 1).alias("attempt"))
        if pending.isEmpty():
            return reduce(DataFrame.unionByName, done)
    raise RuntimeError(f"no free replacement after {DRAWS} draws; entities left: {pending.count()}")


def replace_pii(df: DataFrame, key: str = KEY, text_col: str = "text", count_col: str | None = None) -> DataFrame:
    """All rows and columns of ``df`` with the mentions in ``text_col`` replaced; ``count_col``, if named, gets their
    number.

    A null text stays null and an empty one empty. Rows without a mention are passed through and not moved;
    of the others one text of each kind is worked on, so copies and repeated rows come out alike. Null or
    repeated ids do not matter, as texts are told apart by themselves. An empty table gives an empty result."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    k1, k2, made = fresh(df, "key_1", "key_2", "replacements")
    hinted = text.rlike(HINT)
    some = df.filter(hinted).withColumns({k1: F.xxhash64(text), k2: F.xxhash64(F.lit(1), text)})
    found = materialise(some.select(F.col(k1), F.col(k2), F.regexp_extract_all(text, F.lit(MENTION), F.lit(0)).alias("mentions"))
                        .filter(F.size("mentions") > 0).dropDuplicates([k1, k2]))
    listed = found.select(k1, k2, F.posexplode("mentions").alias("at", "mention"))
    mentions = materialise(listed.select("mention").distinct().withColumn("kind", _kind(F.col("mention")))
                           .withColumn("canonical", _canonical(F.col("kind"), F.col("mention"))))
    drawn = surrogates(mentions.select("kind", "canonical").distinct(), key)
    written = materialise(mentions.join(drawn, ["kind", "canonical"]).select(
        "mention", _laid_out(F.col("kind"), F.col("mention"), F.col("drawn")).alias("new")))
    per_text = materialise(listed.join(written, "mention").groupBy(k1, k2).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("at", "new"))), lambda x: x["new"]).alias(made)))
    discard(found, mentions, written)
    new = F.col(made)
    rebuilt = F.array_join(F.transform(F.split(F.col(text_col), MENTION, -1), lambda p, i: F.concat(p, F.coalesce(F.get(new, i), F.lit("")))), "")
    counted = [F.coalesce(F.size(new), F.lit(0)).alias(count_col)] if count_col else []
    columns = [F.when(new.isNull(), F.col(text_col)).otherwise(rebuilt).alias(c) if c == text_col else column(c) for c in df.columns]
    changed = some.join(per_text, [k1, k2], "left").select(*columns, *counted)
    same = df.filter(~hinted).select("*", *([F.lit(0).alias(count_col)] if count_col else []))
    return same.unionByName(changed)

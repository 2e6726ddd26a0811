"""PII surrogates: every detected entity gets a keyed replacement of its own kind.

1. One pattern finds the mentions of a whole text: e-mail addresses, phone and
   payment card numbers, social security numbers, IP addresses and persons named
   with a title.
2. A mention names one entity, or for a person one for every name word (given names,
   initials, and the last word as surname), in a canonical form, so that all
   spellings of an entity share its surrogate.  A given name whose title tells no
   gender takes that of the titles seen with the name elsewhere in the corpus.
3. The distinct entities get candidate surrogates from a keyed hash: character by
   character of the same class and script (digit, vowel, consonant; Latin, Greek,
   Cyrillic), octets within range, given names from a list of the title's gender.
4. Collision checks: a candidate that another entity of its kind also has, or that
   is itself an entity of the corpus, is drawn anew for all but one, until none
   collides.  So different entities stay different.
5. The surrogates are joined back to the mentions' documents and put into the
   format of each mention.

All steps are SQL expressions and joins.  Only documents with mentions, and of
them only their distinct entities, are shuffled before their texts are rewritten.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docrel.llm.common import stored, text_of

_TITLE = {  # title: gender
    "Mr": "m", "Mister": "m", "Herr": "m", "Monsieur": "m", "Señor": "m", "Sr": "m", "Господин": "m", "Κύριος": "m",
    "Mrs": "f", "Ms": "f", "Miss": "f", "Madam": "f", "Frau": "f", "Madame": "f", "Mme": "f", "Señora": "f",
    "Sra": "f", "Госпожа": "f", "Κυρία": "f", "Dr": "n", "Prof": "n"}
_TITLE |= {t.upper(): g for t, g in _TITLE.items()} | {"ΚΥΡΙΟΣ": "m", "ΚΥΡΙΑ": "f"}
_TITLES = r"(?:" + "|".join(sorted(_TITLE, key=lambda t: (-len(t), t))) + r")"

#: Lower-case words inside a name, kept as they are; joined to a name word they are part of it (d'Arc, al-Sayed).
_PARTICLES = ("van von der den des del dello della dei de di da do dos das du la las le les lo los el al ul bin ibn "
              "bint ben abu zu zum zur ten ter te af av e y i 't ’t фон ван дер де ди да ντε φον").split()
_JOINED = r"(?:dell|de|di|da|du|la|le|van|von|al|el|ul|ibn|bin|mac|mc|fitz|d|l)"
#: Words after the surname, kept as they are.
_SUFFIXES = "Jr JR Sr SR Junior Senior II III IV Esq ESQ PhD MD".split()
#: Words at which a run of capitalised words ends, in titles and texts in capitals.
_ENDS = r"(?i:and|of|is|was|who|with|from|und)(?!\p{L})"
_LETTERS = r"[\p{L}\p{M}]"
_TAIL = rf"(?:-{_LETTERS}++|['’](?![sS](?!\p{{L}})){_LETTERS}++)*+"  # without the 's of a genitive
_PARTICLE = r"(?:(?:" + "|".join(sorted(_PARTICLES, key=lambda t: (-len(t), t))) + r")\x20)"
_LONG = rf"(?:{_JOINED}['’-]?)?\p{{Lu}}(?:{_LETTERS}++|(?=['’-](?:\p{{Lu}}|\p{{L}}{{3}}))){_TAIL}"
_INITIALS = r"\p{Lu}\p{M}*+\.(?:-\p{Lu}\p{M}*+\.)*+"
_BARE = rf"\p{{Lu}}\p{{M}}*+(?!{_LETTERS})"  # an initial without a point: the first word, or one before another
_START = rf"(?!{_TITLES}\.?\x20\p{{Lu}}){_PARTICLE}*+"
_FIRST = rf"{_START}(?:{_LONG}|{_INITIALS}|{_BARE})"
_NEXT = rf"(?:\x20|(?<=\.))(?!{_ENDS}){_START}(?:{_LONG}|{_INITIALS}|{_BARE}(?=\x20{_PARTICLE}*+\p{{Lu}}))"
#: All loops are possessive, which Java runs without recursion, so a run may have any number of words.
_TITLE_RUN = rf"(?:{_TITLES}\.?\x20){{1,4}}"
_NAMES = rf"{_FIRST}(?:{_NEXT})*+"

#: The parts of the pattern, tried in this order.  Each first looks at one character,
#: so that most places of a text are passed over at little cost.
PERSON = rf"(?=[{''.join(sorted({t[0] for t in _TITLE}))}])(?<![\p{{L}}\p{{N}}]){_TITLE_RUN}{_NAMES}"
EMAIL = (r"(?=[A-Za-z0-9_%+-])(?:(?<![A-Za-z0-9._%+-])|(?<=\.)(?<![A-Za-z0-9_%+-]\.{1,64}))[A-Za-z0-9_%+-][A-Za-z0-9._%+-]*+@"
         # labels up to the last that starts with a letter and has two characters at least
         r"[A-Za-z0-9-]++(?:(?:\.(?![A-Za-z][A-Za-z0-9-])[A-Za-z0-9-]++)*+\.[A-Za-z][A-Za-z0-9-]++)++")
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
IP = rf"(?<![0-9.]){_OCTET}(?:\.{_OCTET}){{3}}(?![0-9]|\.[0-9])"
CARD = (r"(?<![0-9])(?:[0-9]{4}(?<gap>[\x20-]?)[0-9]{4}\k<gap>[0-9]{4}\k<gap>[0-9]{4}"
        r"|[0-9]{4}(?<amex>[\x20-]?)[0-9]{6}\k<amex>[0-9]{5})(?![0-9])")
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
PHONE = (r"(?<![0-9+])(?:\+[0-9]{1,3}[\x20.-]?)?(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])"
         r"[0-9]{3}[\x20.-][0-9]{4}(?![0-9])")
#: After '+', 8 to 15 digits with or without separators; a last digit that stands alone is not of the number.
WORLD = (rf"(?<![0-9+]|UTC|GMT)\+(?!{IP}|(?:[0-9]{{4}}[\x20-]){{3}}[0-9]{{4}}(?![0-9]))"
         r"[1-9](?:[\x20.()/-]{0,2}[0-9]){7,14}(?<=[0-9]{2})(?![0-9])")
#: A North American number without separators, not part of a word or a longer number.
PLAIN = r"(?<![\p{L}\p{N}_+])(?<![0-9][.,])1?[2-9][0-9]{9}(?![\p{L}\p{N}_]|[.,][0-9])"
MENTION = "|".join((PERSON, EMAIL, f"(?=[0-9(+])(?:{'|'.join((IP, CARD, SSN, PHONE, WORLD, PLAIN))})"))
#: What every text with a mention has somewhere; cheaper to look for.
HINT = rf"@|[0-9]{{3}}|[0-9]\.[0-9]|\+[0-9]|(?=[{''.join(sorted({t[0] for t in _TITLE}))}]){_TITLES}\.?\x20"

#: Given names by gender and script, for people with a title.  (Latin, Cyrillic, Greek)
GIVEN = {
    "f": (["Alice", "Beata", "Clara", "Diana", "Elena", "Flora", "Greta", "Helena", "Irena", "Julia", "Karla",
           "Laura", "Marta", "Nadia", "Olga", "Paula", "Rosa", "Sofia", "Tilda", "Vera"],
          ["Анна", "Вера", "Дарья", "Елена", "Ирина", "Мария", "Нина", "Ольга", "Софья", "Яна"],
          ["Άννα", "Ελένη", "Ζωή", "Ιωάννα", "Μαρία", "Νίκη", "Σοφία", "Χριστίνα"]),
    "m": (["Adam", "Boris", "Carl", "David", "Emil", "Felix", "Georg", "Henrik", "Igor", "Jonas", "Konrad",
           "Lukas", "Martin", "Nikolas", "Oskar", "Peter", "Robert", "Simon", "Thomas", "Viktor"],
          ["Антон", "Борис", "Виктор", "Денис", "Иван", "Максим", "Олег", "Павел", "Роман", "Степан"],
          ["Αλέξης", "Γιώργος", "Δημήτρης", "Κώστας", "Νίκος", "Πέτρος", "Σπύρος", "Χρήστος"]),
}
GIVEN["n"] = tuple(a + b for a, b in zip(GIVEN["f"], GIVEN["m"]))

#: Letters that replace a letter, by script: vowels and consonants, lower case.
_SETS = (("aeiou", "bcdfghklmnprstvz"), ("аеиоу", "бвгдзклмнпрст"), ("αειου", "βγδζκλμνπρτ"))
_VOWELS = r"^[aeiouyàâäáãåæèéêëìíîïòóôöõøùúûüýÿ]$", r"^[аеёиоуыэюя]$", r"^[αάεέηήιίοόυύωώϊϋΐΰ]$"

#: After so many draws a surrogate may be longer than its entity.
LONGER_AFTER = 12


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def kind_of(mention: Column) -> Column:
    """Kind of a whole mention."""
    return (F.when(mention.contains("@"), "email").when(mention.rlike(r"^\p{L}"), "person")
            .when(mention.rlike(f"^{_OCTET}(\\.{_OCTET}){{3}}$"), "ip").when(mention.rlike(f"^(?:{SSN})$"), "ssn")
            .when(F.length(_digits(mention)).isin(15, 16) & ~mention.startswith("+"), "card").otherwise("phone"))


def _title(mention: Column) -> Column:
    """The title or titles before a name, with what parts them from it."""
    return F.regexp_extract(mention, f"^{_TITLE_RUN}", 0)


def _gender(mention: Column) -> Column:
    """Gender of the first title that has one."""
    titles = F.filter(F.split(_title(mention), r"[.\x20]+"), lambda t: t.isin([t for t, g in _TITLE.items() if g != "n"]))
    title = F.get(titles, F.lit(0))
    return F.when(title.isin([t for t, g in _TITLE.items() if g == "f"]), "f").when(title.isNotNull(), "m").otherwise("n")


def _names(mention: Column) -> Column:
    """array<struct<word, gap, kind>> of a name's words without the title; gap is what
    follows a word, and kind is null for particles and suffixes, which are kept."""
    words = F.transform(
        F.regexp_extract_all(F.regexp_replace(mention, f"^{_TITLE_RUN}", ""), F.lit(r"[^.\x20]+(?:\.-|[.\x20]*)"), F.lit(0)),
        lambda t: F.struct(F.regexp_extract(t, r"^[^.\x20]+", 0).alias("word"),
                           F.regexp_extract(t, r"^[^.\x20]+(.*)$", 1).alias("gap")))
    places = F.transform(words, lambda w, i: F.when(~w["word"].isin(_SUFFIXES), i))
    whole = F.struct(words.alias("words"), F.coalesce(F.array_max(places), F.lit(0)).alias("last"),
                     F.concat(F.lit("given_"), _gender(mention)).alias("given"))
    kind = lambda s, w, i: (
        F.when((i > s["last"]) | ((i < s["last"]) & w["word"].isin(_PARTICLES)), F.lit(None).cast("string"))
        .when(w["word"].rlike(r"^\p{L}\p{M}*$"), "initial").when(i == s["last"], "surname").otherwise(s["given"]))
    # an array of one, so that the last place and the gender are worked out once a name
    return F.get(F.transform(F.array(whole), lambda s: F.transform(s["words"], lambda w, i: F.struct(
        w["word"].alias("word"), w["gap"].alias("gap"), kind(s, w, i).alias("kind")))), 0)


def _name_entity(word: Column) -> Column:
    return F.struct(word["kind"].alias("kind"), F.initcap(word["word"]).alias("entity"))


def entities_of(mention: Column) -> Column:
    """array<struct<kind, entity>> of one mention, in canonical form."""
    entity = lambda kind, x: F.struct(kind.alias("kind"), x.alias("entity"))
    kind = kind_of(mention)
    names = F.array_distinct(F.transform(F.filter(_names(mention), lambda w: w["kind"].isNotNull()), _name_entity))
    plain = F.when(kind == "email", F.lower(mention)).when(kind == "ip", mention).otherwise(_digits(mention))
    return F.when(kind == "person", names).otherwise(F.array(entity(kind, plain)))


def _number(key: Column, *parts) -> Column:
    """A keyed number of some parts: 15 hex digits of a digest, from 0 on."""
    text = F.concat_ws("\x1f", key, *[F.lit(p) if isinstance(p, (str, int)) else p.cast("string") for p in parts])
    return F.conv(F.substring(F.sha2(F.encode(text, "UTF-8"), 256), 1, 15), 16, 10).cast("long")


def _pick(values: str, n: Column) -> Column:
    return F.substring(F.lit(values), (n % len(values) + 1).cast("int"), F.lit(1))


def _char(c: Column, n: Column) -> Column:
    """A character of the same class and script, and case."""
    low = F.lower(c)
    out = F.when(c.rlike("^[0-9]$"), _pick("0123456789", n))
    scripts = (r"^[a-zà-öø-ÿ]$", r"^[а-яё]$", r"^[α-ωά-ώΐΰϊϋ]$")
    for script, vowel, (vowels, rest) in zip(scripts, _VOWELS, _SETS):
        new = F.when(low.rlike(vowel), _pick(vowels, n)).otherwise(_pick(rest, n))
        out = out.when(low.rlike(script), F.when(c != low, F.upper(new)).otherwise(new))
    return out.otherwise(c)


def _spelled(x: Column, key: Column, draw: Column, kind: Column) -> Column:
    chars = F.filter(F.split(x, ""), lambda c: c != "")
    # an array of one, so that a long entity is hashed once and not for every character
    whole = F.array(F.struct(chars.alias("chars"), F.sha2(F.encode(x, "UTF-8"), 256).alias("of")))
    return F.array_join(F.get(F.transform(whole, lambda s: F.transform(
        s["chars"], lambda c, i: _char(c, _number(key, kind, s["of"], draw, i)))), 0), "")


def _octet(o: Column, n: Column) -> Column:
    """An octet of as many digits."""
    return F.when(F.length(o) == 3, n % 156 + 100).when(F.length(o) == 2, n % 90 + 10).otherwise(n % 9 + 1)


def candidate(kind: Column, entity: Column, draw: Column, key: Column) -> Column:
    """The surrogate that an entity gets at a draw, in canonical form."""
    n = _number(key, kind, entity, draw)
    # the domain's last label stays, as does a number's first digit or a phone's country
    tail = F.regexp_extract(entity, r"(\.[^.]*)$", 1)
    email = F.concat(_spelled(F.regexp_replace(entity, r"\.[^.]*$", ""), key, draw, kind), tail)
    ip = F.array_join(F.transform(F.split(entity, r"\."),
                                  lambda o, i: _octet(o, _number(key, kind, entity, draw, i)).cast("string")), ".")
    head = F.when(kind == "phone", F.least(F.greatest(F.length(entity) - 10, F.lit(0)), F.lit(3))) \
            .when(kind == "card", F.lit(1)).otherwise(F.lit(0))
    number = F.concat(F.substring(entity, F.lit(1), head),
                      _spelled(F.substring(entity, head + 1, F.length(entity)), key, draw, kind))
    script = F.when(entity.rlike(r"\p{IsCyrillic}"), 1).when(entity.rlike(r"\p{IsGreek}"), 2).otherwise(0)
    given = None
    for gender, lists in GIVEN.items():
        for s, names in enumerate(lists):
            name = F.get(F.array(*[F.lit(x) for x in names]), (n % len(names)).cast("int"))
            case = (kind == f"given_{gender}") & (script == s)
            given = F.when(case, name) if given is None else given.when(case, name)
    # a given name alone has few choices: a spelled ending tells more of them apart
    more = F.when(draw > 0, F.lower(_spelled(F.substring(entity, F.lit(1), F.least(draw, F.lit(4))), key, draw, kind))) \
            .otherwise("")
    base = F.when(kind == "email", email).when(kind == "ip", ip).when(kind.startswith("given_"), F.concat(given, more)) \
            .when(kind == "surname", F.initcap(_spelled(entity, key, draw, kind))) \
            .when(kind == "initial", F.initcap(_spelled(F.repeat(entity, F.least(draw, F.lit(4)) + 1), key, draw, kind))) \
            .otherwise(number)
    longer = F.lpad((n % 100_000_000).cast("string"), 8, "0")
    tied = F.when(kind == "email", F.concat(longer, base)).when(kind == "ip", F.concat(F.lit("10."), F.array_join(
        F.transform(F.sequence(F.lit(1), F.lit(3)), lambda i: (_number(key, entity, draw, i) % 256).cast("string")), "."))) \
        .when(kind.startswith("given_") | kind.isin("surname", "initial"), F.concat(base, F.lower(F.translate(
            longer, "0123456789", "abdeiklnor")))).otherwise(F.concat(base, longer))
    return F.when(draw > LONGER_AFTER, tied).otherwise(base)


def surrogates(entities: DataFrame, key: Column) -> DataFrame:
    """(kind, entity, surrogate) of distinct (kind, entity) rows: no two entities of a
    kind have the same surrogate, and no surrogate is an entity.

    Given names of all genders count as one kind here.  Entities whose draw
    collides are drawn anew; the one with the smallest keyed number keeps it.
    """
    group = F.regexp_replace("kind", "_.*$", "")
    names = stored(entities.select("kind", "entity", group.alias("group")).distinct(), "entities")
    real = names.select(F.col("group"), F.col("entity").alias("surrogate")).distinct()
    done, todo, draw = None, names, 0
    while True:
        drawn = todo.withColumn("surrogate", candidate(F.col("kind"), F.col("entity"), F.lit(draw), key)) \
                    .withColumn("rank", _number(key, F.col("kind"), F.col("entity")))
        if done is not None:
            drawn = drawn.join(done.select("group", "surrogate"), ["group", "surrogate"], "left_anti")
        w = Window.partitionBy("group", "surrogate").orderBy("rank", "kind", "entity")
        won = drawn.join(real, ["group", "surrogate"], "left_anti") \
                   .withColumn("place", F.row_number().over(w)).filter("place = 1")
        won = won.select("kind", "entity", "group", "surrogate")
        done = stored(won if done is None else done.unionByName(won), "surrogates")
        todo = stored(names.join(done, ["kind", "entity"], "left_anti"), "collided")
        if todo.isEmpty():
            return done.select("kind", "entity", "surrogate")
        draw += 1


def settled(counted: DataFrame) -> DataFrame:
    """(kind, entity, as_kind) of distinct (kind, entity, n): given names of no gender
    get the one seen with the name, the more frequent of two; f where equally so."""
    w = Window.partitionBy("entity")
    seen = lambda g: F.max(F.when(F.col("kind") == f"given_{g}", F.col("n"))).over(w)
    names = counted.filter(F.col("kind").startswith("given_")).withColumn("f", seen("f")).withColumn("m", seen("m")) \
        .select("kind", "entity", F.when((F.col("kind") != "given_n") | F.coalesce("f", "m").isNull(), F.col("kind"))
                .when(F.col("m").isNull() | (F.col("f") >= F.col("m")), "given_f").otherwise("given_m").alias("as_kind"))
    rest = counted.filter(~F.col("kind").startswith("given_")).select("kind", "entity", F.col("kind").alias("as_kind"))
    return names.unionByName(rest)


def _digits_into(mention: Column, digits: Column) -> Column:
    """The mention with its digits replaced in order; more digits follow at the end."""
    chars = F.filter(F.split(mention, ""), lambda c: c != "")
    place = lambda i: F.length(_digits(F.substring(mention, F.lit(1), i + 1)))
    laid = F.array_join(F.transform(chars, lambda c, i: F.when(
        c.rlike("^[0-9]$"), F.substring(digits, place(i), F.lit(1))).otherwise(c)), "")
    return F.concat(laid, F.substring(digits, F.length(_digits(mention)) + 1, F.length(digits)))


def _cased(like: Column, x: Column) -> Column:
    return F.when((F.upper(like) == like) & (F.length(like) > 1), F.upper(x)) \
            .when(F.lower(like) == like, F.lower(x)).otherwise(x)


def rendered(mention: Column, of) -> Column:
    """A mention's replacement; ``of(kind, entity)`` looks a surrogate up."""
    kind = kind_of(mention)
    first = of(F.get(entities_of(mention), F.lit(0)))
    name = F.array_join(F.transform(_names(mention), lambda w: F.concat(
        F.when(w["kind"].isNull(), w["word"]).otherwise(_cased(w["word"], of(_name_entity(w)))), w["gap"])), "")
    return F.when(kind == "email", _cased(mention, first)).when(kind == "ip", first) \
            .when(kind == "person", F.concat(_title(mention), name)) \
            .otherwise(_digits_into(mention, first))


def scrubbed(df: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_mentions, n_entities, and text with every mention replaced.

    The same ``key`` gives the same surrogates for the same entities of a corpus.
    Null and empty texts have no mentions and give an empty text; null ids and
    repeated rows are treated like others.  Empty table: no rows.
    """
    secret = F.lit(key)
    id_type = df.schema[id_col].dataType
    base = df.select(F.col(id_col).isNull().alias("none"),
                     F.coalesce(F.col(id_col), F.lit(0).cast(id_type)).alias("id"),
                     text_of(text_col).alias("body")) \
             .withColumn("h", F.xxhash64("body"))
    keyed = ["none", "id", "h"]
    hint = F.col("body").rlike(HINT)
    mentions = F.regexp_extract_all("body", F.lit(MENTION), F.lit(0))
    found = base.filter(hint).select(*keyed, mentions.alias("mentions")).filter(F.size("mentions") > 0) \
                .groupBy(*keyed).agg(F.first("mentions").alias("mentions"))  # repeated rows have the same
    found = stored(found, "mentions")
    each = found.select(*keyed, F.explode(F.array_distinct("mentions")).alias("m")) \
                .select(*keyed, F.explode(entities_of(F.col("m"))).alias("e")).select(*keyed, "e.*").distinct()
    names = stored(settled(each.groupBy("kind", "entity").agg(F.count("*").alias("n"))), "settled")
    known = surrogates(names.select(F.col("as_kind").alias("kind"), "entity"), secret)
    known = names.join(known.withColumnRenamed("kind", "as_kind"), ["as_kind", "entity"])
    pair = F.concat_ws("\x1f", "kind", "entity")
    # entities of a kind differ in their surrogates
    one = F.concat_ws("\x1f", "as_kind", "surrogate")
    table = each.join(known, ["kind", "entity"]).groupBy(*keyed) \
                .agg(F.map_from_entries(F.collect_list(F.struct(pair, "surrogate"))).alias("table"),
                     F.size(F.collect_set(one)).alias("n_entities"))
    look = lambda e: F.element_at("table", F.concat_ws("\x1f", e["kind"], e["entity"]))
    news = found.join(table, keyed).select(*keyed, "n_entities",
                                           F.transform("mentions", lambda m: rendered(m, look)).alias("news"))
    news = stored(news, "replacements")
    hit = base.filter(hint).join(news, keyed, "left")
    parts = F.zip_with(F.split("body", MENTION, -1), F.col("news"),
                       lambda gap, new: F.concat(gap, F.coalesce(new, F.lit(""))))
    own = F.when(~F.col("none"), F.col("id")).alias(id_col)
    none = F.lit(0).cast("long")
    changed = hit.select(own, F.coalesce(F.size("news").cast("long"), none).alias("n_mentions"),
                         F.coalesce(F.col("n_entities").cast("long"), none).alias("n_entities"),
                         F.when(F.col("news").isNull(), F.col("body")).otherwise(F.array_join(parts, "")).alias("text"))
    same = base.filter(~hint).select(own, none.alias("n_mentions"), none.alias("n_entities"),
                                     F.col("body").alias("text"))
    return changed.unionByName(same)


__all__ = ["MENTION", "candidate", "entities_of", "kind_of", "rendered", "scrubbed", "settled", "surrogates"]

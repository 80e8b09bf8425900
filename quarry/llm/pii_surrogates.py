"""Personal data replaced by keyed surrogates of the same type (native).

Detected entities become one table; each gets a surrogate from a keyed hash,
in the script, gender and format of the original.  Surrogates are checked
against each other and against all real values, so distinct entities stay
distinct, and one entity has one surrogate wherever it occurs.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import cut, drop_path, id_text, known_groups, salted, written

#: Titles by gender: fixed values.
MALE = "Mr Mister Sir Herr Herrn Monsieur Señor Sr Don Signor Lord г-н господин κύριος".split()
FEMALE = "Mrs Ms Miss Madam Frau Madame Mme Mademoiselle Señora Señorita Sra Doña Signora Lady г-жа госпожа κυρία".split()
#: Alphabets that letters are drawn from, and syllables of names by script: fixed values.
ALPHABETS = {"latin": "abcdefghijklmnopqrstuvwxyz", "cyrillic": "абвгдежзиклмнопрстуфхцчшэюя", "greek": "αβγδεζηθικλμνξοπρστυφχψω"}
SYLLABLES = {"latin": "al ba be bo da de do el fa fi ga ge ka ko la le li lo ma me mi mo na ne no ra re ro sa so ta vi".split(),
             "cyrillic": "ал ба бе бо да де до ел фа фи га ге ка ко ла ле ли ло ма ме ми мо на не но ра ре ро са со та ви".split(),
             "greek": "αλ βα βε βο δα δε δο ελ φα φι γα γε κα κο λα λε λι λο μα με μι μο να νε νο ρα ρε ρο σα σο τα βι".split()}
ENDINGS = {("latin", "m"): "n r s rd".split(), ("latin", "f"): "a ia na ra".split(), ("latin", "s"): "nd ler man ser".split(),
           ("cyrillic", "m"): "н р с м".split(), ("cyrillic", "f"): "я на ра ия".split(), ("cyrillic", "s"): "нко рук дзе лян".split(),
           ("greek", "m"): "ς νος ρης ων".split(), ("greek", "f"): "α ια νη ρα".split(), ("greek", "s"): "δης κος λος ριν".split()}

_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_TITLE = "(?:" + "|".join(sorted(map(re.escape, MALE + FEMALE), key=len, reverse=True)) + r")\.? "
_NAME = r"\p{Lu}[\p{L}'’-]*+"
#: Entity patterns, linear in the text: no run of characters is tried twice.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*(?<=\.[A-Za-z]{2,24})",
    "ip": rf"(?<![0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9]|\.[0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "card": r"(?<![0-9A-Za-z])[3-6][0-9]{3}(?:[ -]?[0-9]{4}){2}[ -]?[0-9]{1,7}(?![0-9A-Za-z])",
    "phone": (r"(?<![0-9A-Za-z])(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,5}\)|[0-9]{1,5})(?:[ .-]?[0-9]{2,5}){1,4}"
              r"|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4})(?![0-9])"),
    "name": rf"(?<!\p{{L}}){_TITLE}{_NAME}(?: {_NAME})?",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())


def script_of(text: Column) -> Column:
    return (F.when(text.rlike(r"\p{IsCyrillic}"), "cyrillic").when(text.rlike(r"\p{IsGreek}"), "greek").otherwise("latin"))


def parts_of(match: Column) -> Column:
    """The entities of one match: (literal before it, raw, kind, norm)."""
    def part(lead: Column, raw: Column, kind: Column, norm: Column) -> Column:
        return F.struct(lead.cast("string").alias("lead"), raw.alias("raw"), kind.alias("kind"), norm.alias("norm"))

    none = F.lit("")
    at = F.instr(match, "@")
    local, domain = F.substring_index(match, "@", 1), F.substring_index(match, "@", -1)
    email = F.array(part(none, local, F.lit("local"), F.lower(local)), part(F.lit("@"), domain, F.lit("domain"), F.lower(domain)))
    digits = F.regexp_replace(match, "[^0-9]", "")
    title = F.regexp_extract(match, f"^{_TITLE}", 0)
    names = F.split(F.regexp_replace(match, f"^{_TITLE}", ""), " ")
    gender = F.when(F.rtrim(F.replace(title, F.lit("."), F.lit(""))).isin(FEMALE), "f").otherwise("m")
    first, last = F.element_at(names, 1), F.element_at(names, -1)
    given = part(title, first, F.concat(F.lit("given-"), gender, F.lit("-"), script_of(first)), F.lower(first))
    surname = lambda lead: part(lead, last, F.concat(F.lit("surname-"), script_of(last)), F.lower(last))
    person = F.when(F.size(names) > 1, F.array(given, surname(F.lit(" ")))).otherwise(F.array(surname(title)))
    number = F.when(match.rlike(f"^(?:{PATTERNS['ip']})$"), "ip").when(match.rlike(f"^(?:{PATTERNS['ssn']})$"), "ssn").when(
        match.rlike(f"^(?:{PATTERNS['card']})$"), "card").otherwise("phone")
    return (F.when(at > 0, email).when(match.rlike(f"^(?:{PATTERNS['name']})$"), person)
            .otherwise(F.array(part(none, match, number, F.when(number == "ip", match).otherwise(digits)))))


def _byte(hex_: Column, k: Column | int) -> Column:
    """Byte k of a hash in hex (it goes round after 64 bytes)."""
    at = F.pmod(F.lit(k) if isinstance(k, int) else k, F.lit(64)) * 2 + 1
    return F.conv(F.substring(hex_, at, F.lit(2)), 16, 10).cast("int")


def _letters(text: Column, hex_: Column) -> Column:
    """Letters and digits of ``text`` replaced by others of their script."""
    def one(c: Column, k: Column) -> Column:
        out = c
        for name, letters in reversed(ALPHABETS.items()):
            test = {"latin": r"\p{IsLatin}", "cyrillic": r"\p{IsCyrillic}", "greek": r"\p{IsGreek}"}[name]
            out = F.when(c.rlike(test), F.substring(F.lit(letters), F.pmod(_byte(hex_, k), F.lit(len(letters))) + 1, F.lit(1))).otherwise(out)
        return F.when(c.rlike("[0-9]"), F.pmod(_byte(hex_, k), F.lit(10)).cast("string")).otherwise(out)

    return F.array_join(F.transform(F.filter(F.split(text, ""), lambda c: c != ""), one), "")


def _luhn(digits: Column) -> Column:
    """Luhn sum of a digit string, modulo 10."""
    reverse = F.filter(F.split(F.reverse(digits), ""), lambda c: c != "")
    double = F.transform(reverse, lambda c, k: F.when(k % 2 == 1, F.pmod(c.cast("int") * 2, F.lit(10)) + F.floor(c.cast("int") * 2 / 10).cast("int"))
                         .otherwise(c.cast("int")))
    return F.pmod(F.aggregate(double, F.lit(0), lambda a, x: a + x), F.lit(10))


def _pick(values: list[str], k: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), F.pmod(k, F.lit(len(values))) + 1)


def _syllables(values: list[str], hex_: Column, attempt: Column) -> Column:
    """Two syllables, and one more after every four collisions."""
    return F.array_join(F.transform(F.sequence(F.lit(2), 3 + F.floor(attempt / 4).cast("int")),
                                    lambda k: _pick(values, _byte(hex_, k))), "")


def surrogate(kind: Column, norm: Column, attempt: Column, key: str) -> Column:
    """Surrogate (lower case, digits only for numbers) of one entity."""
    h = F.sha2(F.concat_ws("\u001f", F.lit(key), kind, norm, attempt.cast("string")), 512)
    digits = F.array_join(F.transform(F.filter(F.split(norm, ""), lambda c: c != ""),
                                      lambda c, k: F.pmod(_byte(h, k), F.lit(10)).cast("string")), "")
    card = F.concat(F.substring(norm, 1, 1), F.substring(digits, F.lit(2), F.length(norm) - 2))  # the issuer's digit stays
    check = F.pmod(10 - _luhn(F.concat(card, F.lit("0"))), F.lit(10)).cast("string")
    card = F.concat(card, F.when(_luhn(norm) == 0, check).otherwise(F.substring(digits, -1, 1)))
    phone = F.concat(F.substring(norm, 1, 1), F.substring(digits, F.lit(2), F.length(norm) - 1))
    ip = F.concat_ws(".", *[(F.pmod(_byte(h, k), F.lit(254)) + 1).cast("string") for k in range(4)])
    # where short values leave no room, letters are added after every four collisions
    grown = F.when(attempt >= 4, F.array_join(F.transform(F.sequence(F.lit(40), 39 + F.floor(attempt / 4).cast("int")),
                                                          lambda k: _pick(list(ALPHABETS["latin"]), _byte(h, k))), "")).otherwise("")
    domain = F.concat(_letters(F.regexp_extract(norm, r"^(.*)\.[^.]*$", 1), h), grown, F.regexp_extract(norm, r"\.[^.]*$", 0))
    out = F.concat(_letters(norm, h), grown)
    for script, syllables in SYLLABLES.items():
        name = _syllables(syllables, h, attempt)
        for gender, word in (("m", "given-m"), ("f", "given-f"), ("s", "surname")):
            end = _pick(ENDINGS[script, gender], _byte(h, 1))
            out = F.when(kind == f"{word}-{script}", F.concat(name, end)).otherwise(out)
    return (F.when(kind == "ip", ip).when(kind == "ssn", digits).when(kind == "card", card).when(kind == "phone", phone)
            .when(kind == "domain", domain).otherwise(out))


def surrogates(entities: DataFrame, key: str, max_rounds: int = 40) -> DataFrame:
    """``kind, norm, fake`` for the distinct entities ``kind, norm``.

    An entity tries again while its surrogate is a real value of its kind or
    one that another entity (the least by ``norm``) has."""
    old: list[str] = []
    rows = entities.select("kind", "norm").distinct().withColumn("attempt", F.lit(0))
    for _ in range(max_rounds):
        rows = written(rows.select("kind", "norm", "attempt").withColumn("fake", surrogate(F.col("kind"), F.col("norm"), F.col("attempt"), key)), "pii-fakes", old)
        owner = rows.groupBy("kind", "fake").agg(F.min(F.struct("attempt", "norm")).alias("owner"), F.count(F.lit(1)).alias("n")).filter("n > 1")
        taken = rows.select("kind", F.col("norm").alias("fake"), F.lit(True).alias("real"))
        rows = written(rows.join(owner, ["kind", "fake"], "left").join(taken, ["kind", "fake"], "left").select(
            "kind", "norm", "attempt", "fake",
            (F.coalesce("real", F.lit(False)) | (F.col("n").isNotNull() & (F.col("owner.norm") != F.col("norm")))).alias("again")), "pii-fakes", old)
        while len(old) > 1:
            drop_path(entities.sparkSession, old.pop(0))
        if not rows.filter("again").limit(1).count():
            return rows.select("kind", "norm", "fake")
        rows = rows.withColumn("attempt", F.col("attempt") + F.col("again").cast("int"))
    raise RuntimeError(f"surrogates still collide after {max_rounds} rounds")


def formatted(raw: Column, kind: Column, fake: Column) -> Column:
    """``fake`` in the layout of ``raw``: digits in its places, or its case."""
    chars = F.filter(F.split(raw, ""), lambda c: c != "")
    marks = F.transform(chars, lambda c: c.rlike("[0-9]").cast("int"))
    laid = F.array_join(F.transform(chars, lambda c, k: F.when(
        c.rlike("[0-9]"), F.substring(fake, F.aggregate(F.slice(marks, F.lit(1), k + 1), F.lit(0), lambda a, x: a + x), F.lit(1))).otherwise(c)), "")
    upper_first = F.concat(F.upper(F.substring(fake, 1, 1)), F.substring(fake, F.lit(2), F.length(fake)))
    cased = (F.when((F.length(raw) > 1) & (raw == F.upper(raw)) & (raw != F.lower(raw)), F.upper(fake))
             .when(F.substring(raw, 1, 1) != F.lower(F.substring(raw, 1, 1)), upper_first).otherwise(fake))
    return F.when(kind.isin("ssn", "card", "phone"), laid).otherwise(cased)


def replace(df: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, text`` with surrogates, and
    ``n_entities``.

    Entities are e-mail addresses (local part and domain each keep their
    identity), IPv4 addresses, social security, card and phone numbers, and
    names after a title, whose gender and script the surrogate has.  Card
    numbers that pass the Luhn check still do.  The same ``key`` gives the
    same surrogates but for collisions.

    A null text is empty; texts without entities stay as they are.  Null and
    repeated ids and repeated rows are safe (a document is its id and text).
    An empty table gives an empty result.
    """
    docs = id_text(df, id_col, text_col)
    some = docs.filter(F.col("text").rlike(ANY)).select(F.struct("doc_id", F.xxhash64("text").alias("h")).alias("_key"), "text")
    found = some.select("_key", F.posexplode(F.regexp_extract_all("text", F.lit(ANY), F.lit(0))).alias("pos", "match")).distinct()
    parts = (found.select("_key", "pos", F.posexplode(parts_of(F.col("match"))).alias("part", "p"))
             .select("_key", "pos", "part", "p.*").withColumn("_salt", salted("_key", "pos")))
    parts = cut(parts)
    fakes = surrogates(parts, key)
    # an entity that a third of the mentions name is sent to each (entity, salt)
    known = known_groups(parts, ["kind", "norm"], {"n": F.count(F.lit(1))}, {"n": F.sum("n")}).drop("n")
    known = known.join(fakes, ["kind", "norm"])
    pieces = parts.join(known, ["kind", "norm", "_salt"]).select(
        "_key", F.struct("pos", "part", F.concat("lead", formatted(F.col("raw"), F.col("kind"), F.col("fake"))).alias("piece")).alias("p"))
    by_doc = pieces.groupBy("_key").agg(F.sort_array(F.collect_list("p")).alias("pieces"))
    between = F.split("text", ANY, -1)
    filled = F.array_join(F.transform("pieces", lambda p: F.when(p["part"] == 0, F.concat(F.element_at("between", p["pos"] + 1), p["piece"]))
                                      .otherwise(p["piece"])), "")
    changed = (some.join(by_doc, "_key").withColumn("between", between)
               .select(F.col("_key.doc_id").alias("doc_id"), F.concat(filled, F.element_at("between", -1)).alias("text"),
                       F.size(F.filter("pieces", lambda p: p["part"] == 0)).cast("bigint").alias("n_entities")))
    same = docs.filter(~F.col("text").rlike(ANY)).select("doc_id", "text", F.lit(0).cast("bigint").alias("n_entities"))
    return same.unionByName(changed)

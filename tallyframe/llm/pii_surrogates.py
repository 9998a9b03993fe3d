"""Surrogates for personal data: detected entities get keyed replacements of the same type, format and script.

All work is in DataFrame functions. Entities (mail addresses, phone numbers, card numbers, network addresses,
social security numbers, secrets and titled names) are found with one pattern; the distinct normalised values of
the whole corpus get surrogates from a keyed hash, and a value whose surrogate another value holds, or that
occurs in the corpus itself, draws again until all are distinct. The same value gets the same surrogate
everywhere, so does a name's part, whatever its title, and its further mentions in the document without one. Results for odd rows: a null text stays null; a text
without entities stays as it is; long texts and long values (a name or secret of a million letters) are replaced whole; repeated rows get the same text; an empty table gives an empty one; a doc_id may
be null; other columns, whatever their names, stay as they are.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import hinted, stored

KEY = "tallyframe-surrogates"
#: Draws after which a value that still collides raises an error: its format has no free surrogates left.
DRAWS = 200

# Titles by gender, given names by gender and script, syllables of surnames by script.
TITLES = {
    "m": "Mr Herr Monsieur Señor Sr г-н господин κύριος".split(),
    "f": "Mrs Ms Miss Frau Madame Mme Mlle Señora Señorita Sra г-жа госпожа κυρία".split(),
    "n": "Dr Prof".split(),
}
GIVEN = {
    "latin": {
        "m": "Adam Arthur Bruno Carl Daniel Edgar Felix Gustav Henry Ivan Jonas Karl Leon Martin Noah Oscar Paul Robert Simon Victor".split(),
        "f": "Alice Anna Beate Clara Diana Emma Flora Greta Helen Irene Julia Karin Laura Maria Nina Olga Paula Rosa Sara Vera".split(),
        "n": "Alex Andrea Charlie Dana Eden Jamie Kim Luca Robin Sascha".split(),
    },
    "cyrillic": {
        "m": "Антон Борис Виктор Глеб Денис Егор Иван Кирилл Максим Олег".split(),
        "f": "Анна Вера Галина Дарья Елена Ирина Ксения Мария Ольга Софья".split(),
        "n": "Женя Саша Валя Слава".split(),
    },
    "greek": {
        "m": "Αλέξης Γιώργος Δημήτρης Κώστας Νίκος Πέτρος".split(),
        "f": "Άννα Ελένη Ζωή Κατερίνα Μαρία Σοφία".split(),
        "n": "Αλέξης Άγγελος".split(),
    },
}
SYLLABLES = {
    "latin": "bal bor dan del fen gar hol kel lan mar nor pel rin sal tor val ven wil zan mon".split(),
    "cyrillic": "бел вол гор дан зор кра лем мир нов пет рас сол тур хол чер".split(),
    "greek": "βαλ γορ δαν καλ λεμ μαρ νικ παπ ραλ σολ τερ φιλ".split(),
}
LATIN, CYRILLIC, GREEK = "abcdefghijklmnopqrstuvwxyz", "абвгдежзиклмнопрстуфхцчшэюя", "αβγδεζηθικλμνξοπρστυφχψω"
#: Letters of other scripts by their name in regular expressions (first and last code point, at most 256), and their digits.
SCRIPTS = {
    "Han": (0x4E00, 0x4EFF), "Hiragana": (0x3041, 0x3096), "Katakana": (0x30A1, 0x30FA), "Hangul": (0xAC00, 0xACFF),
    "Arabic": (0x0621, 0x064A), "Hebrew": (0x05D0, 0x05EA), "Devanagari": (0x0905, 0x0939), "Bengali": (0x0985, 0x09B9),
    "Tamil": (0x0B85, 0x0BB9), "Telugu": (0x0C05, 0x0C39), "Thai": (0x0E01, 0x0E2E), "Khmer": (0x1780, 0x17A2),
    "Armenian": (0x0561, 0x0586), "Georgian": (0x10D0, 0x10F0), "Ethiopic": (0x1200, 0x12BE),
}
LETTERS = {script: "".join(chr(c) for c in range(low, high + 1) if chr(c).isalpha() and unicodedata.category(chr(c)) != "Lm")
           for script, (low, high) in SCRIPTS.items()}
DIGITS = ["".join(chr(zero + i) for i in range(10)) for zero in (0x0660, 0x06F0, 0x0966, 0x09E6, 0x0E50, 0xFF10)]

#: Country calling codes.
COUNTRY_CODES = r"(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"

# Entity patterns (Java regular expressions); the first that matches at a place counts.
_TITLE = "|".join(sorted((t for own in TITLES.values() for t in own), key=len, reverse=True))
# Possessive throughout: a repeated group that may give characters back is matched by recursion, one level each.
_NAME = r"\p{Lu}(?=\p{L}|['-]\p{L})\p{L}*+(?:['-](?!s(?!\p{L}))\p{L}++)*+"  # without a possessive 's
_STEP = r"(?:[ ./-]|\) ?| ?\()?"  # what may stand between two digits of a phone number
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}_.+%-])[\p{L}\p{N}_.+%-]{1,64}@[\p{L}\p{N}-]{1,63}(?:\.[\p{L}\p{N}-]{1,63}){0,8}\.\p{L}{2,24}",
    "secret": r"(?i:\b(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)\b\s{0,3}[=:]\s{0,3}[\"']?)[^\s\"',;]{6,}+",
    "cloud_key": r"\b(?:AKIA|ASIA)[0-9A-Z]{16}\b",
    "ip": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\.?\d)",
    "card": r"(?<!\d)(?:\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{4}|\d{4}[ -]\d{6}[ -]\d{5})(?!\d)",
    "ssn": r"(?<!\d)\d{3}-\d{2}-\d{4}(?!\d)",
    "phone": rf"(?=[+(\d])(?:(?<!\d)\+(?!1[ .(-])\d(?:{_STEP}\d){{7,14}}(?!\d)"  # + country code, but for North America
    r"|(?<![\d\p{L}])(?:\+\d{1,3}[ .-]?(?:\(\d{2,4}\) ?|\d{2,4}[ .-])|\(\d{2,4}\) ?)\d{3}[ .-]\d{3,4}(?!\d)"
    r"|(?<![\d\p{L}]|\d[.,/-])[2-9]\d\d[ .-]\d{3}[ .-]\d{4}(?![.,/-]?\d)"  # groups of 3, 3 and 4: no figure is grouped so
    r"|(?<![\d\p{L}]|\d[.,/-])(?:0[1-9](?:[ .-]\d\d){4}|[6-9]\d\d(?:[ .-]\d\d){3}|9\d[ .-]\d{3}(?:[ .-]\d\d){2})(?![.,/-]?\d)"
    rf"|(?<![\d\p{{L}}]|\d[.,/-])(?=\(\d{{2,5}}\)|0\d{{1,4}}[ ./-])(?!\d\d[ ./-]\d\d[ ./-](?:19|20)\d\d(?!\d))(?:\(0?|00?)[1-9](?:{_STEP}\d){{7,13}}(?!\d))",
    "name": rf"\b(?:{_TITLE})\.? {_NAME}(?: {_NAME})?",
}
PATTERN = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: What goes before the value of a secret or cloud key.
_LEAD = r"^(?:AKIA|ASIA|[^=:]*[=:]\s*[\"']?)"


def kind(entity: Column) -> Column:
    """The type of an entity that PATTERN found; NULL for what is left alone: a number in the form of a card's whose
    first or check digit is not a card's, and a secret without any letter or digit (a mask or an underline)."""
    out = F.lit("name")
    for name, pattern in reversed([x for x in PATTERNS.items() if x[0] != "name"]):
        found = F.lit(name)
        if name == "card":
            digits = F.regexp_replace(entity, r"\D", "")
            found = F.when((_check_digit(F.substring(digits, F.lit(1), F.length(digits) - 1)) == F.substring(digits, -1, 1)) & entity.rlike("^[2-6]"), found)
        if name == "secret":
            found = F.when(F.regexp_replace(entity, _LEAD, "").rlike(r"[\p{L}\p{N}]"), found)
        out = F.when(entity.rlike(f"^(?:{pattern})$"), found).otherwise(out)
    return out


def _script(word: Column) -> Column:
    return F.when(word.rlike(r"\p{IsCyrillic}"), "cyrillic").when(word.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def _part(type_: Column | str, norm: Column, shown: Column) -> Column:
    return F.struct((F.lit(type_) if isinstance(type_, str) else type_).alias("type"), norm.alias("norm"), shown.alias("shown"))


def parts(entity: Column, type_: Column) -> Column:
    """An entity as parts (type, normalised value, as shown); a part of type null is kept as it is."""
    keep = lambda c: _part(F.lit(None).cast("string"), F.lit(None).cast("string"), c)
    digits = F.regexp_replace(entity, r"\D", "")
    title = F.regexp_extract(entity, rf"^(?:{_TITLE})\.? ", 0)
    bare = F.regexp_replace(title, r"[. ]+$", "")
    gender = F.when(bare.isin(TITLES["m"]), "m").when(bare.isin(TITLES["f"]), "f").otherwise("n")
    words = F.split(F.substring(entity, F.length(title) + 1, F.length(entity)), " ")
    last = F.element_at(words, -1)
    surname = _part(F.concat(F.lit("surname:"), _script(last)), F.lower(last), last)
    first = F.element_at(words, 1)
    given = _part(F.concat(F.lit("given:"), _script(first), F.lit(":"), gender), F.lower(first), first)
    name = F.when(F.size(words) > 1, F.array(keep(title), given, keep(F.lit(" ")), surname)).otherwise(F.array(keep(title), surname))
    lead = F.regexp_extract(entity, _LEAD, 0)
    value = F.substring(entity, F.length(lead) + 1, F.length(entity))
    abroad = entity.startswith("+") | digits.startswith("00")
    own = F.when(abroad, F.regexp_replace(digits, f"^(?:00)?{COUNTRY_CODES}0?", "")).when(digits.startswith("0"), F.substring(digits, F.lit(2), F.length(digits)))
    own = F.coalesce(own, F.when(F.length(digits) > 10, F.substring(digits, -10, 10)), digits)
    national = F.when(F.length(own) < 7, digits).otherwise(own)  # the country code and a leading 0 stay as they are
    return (
        F.when(type_.isNull(), F.array(keep(entity)))
        .when(type_ == "name", name)
        .when(type_.isin("secret", "cloud_key"), F.array(keep(lead), _part(type_, value, value)))
        .when(type_ == "phone", F.array(_part(type_, national, entity)))
        .when(type_.isin("card", "ssn"), F.array(_part(type_, digits, entity)))
        .when(type_ == "email", F.array(_part(type_, F.lower(entity), entity)))
        .otherwise(F.array(_part(type_, entity, entity)))
    )


def _number(i: Column | int, bound: int, stream: Column | str = "hex") -> Column:
    """The i-th number below ``bound`` of 32 that a keyed hash (64 hexadecimal digits) holds."""
    at = i if isinstance(i, Column) else F.lit(i)
    return F.conv(F.substring(stream, (at * 2 + 1).cast("int"), F.lit(2)), 16, 10).cast("int") % bound


def _reshaped(value: Column, base: Column, hexadecimal: Column) -> Column:
    """The value with every letter and digit replaced by another of its script, case and kind (of a script that is
    not listed, by a Latin letter; of another kind of number, by a digit). Each stretch of 32 characters has a hash of
    its own, so the work is in proportion to the length."""

    def one(c: Column, i: Column, stream: Column) -> Column:
        low = F.lower(c)
        number = lambda bound: _number(i, bound, stream)
        place = lambda letters: F.substring(F.lit(letters), (number(len(letters)) + 1).cast("int"), F.lit(1))
        out = F.when(c.rlike(r"^\p{L}$"), place(LATIN)).when(c.rlike(r"^\p{N}$"), number(10).cast("string")).otherwise(c)
        for own, letters in [*((f"[{d}]", d) for d in DIGITS), *((rf"\p{{L}}(?<=\p{{Is{n}}})", x) for n, x in LETTERS.items())]:
            out = F.when(c.rlike(f"^{own}$"), place(letters)).otherwise(out)
        for letters in (GREEK, CYRILLIC, LATIN):
            new = place(letters)
            mine = F.instr(F.lit(letters), low) > 0 if letters != LATIN else low.rlike(r"^\p{IsLatin}$")
            out = F.when(mine, F.when(c == low, new).otherwise(F.upper(new))).otherwise(out)
        hexed = place("0123456789abcdef")
        out = F.when(c.rlike("^[0-9]$"), number(10).cast("string")).otherwise(out)
        return F.when(hexadecimal & c.rlike("^[0-9a-f]$"), hexed).otherwise(out)

    stretches = F.transform(F.regexp_extract_all(value, F.lit("(?s).{1,32}"), 0), lambda x, b: F.struct(
        x.alias("x"), F.sha2(F.concat(base, b.cast("string")), 256).alias("h")))
    return F.array_join(F.transform(stretches, lambda s: F.array_join(
        F.transform(F.split(s["x"], ""), lambda c, i: one(c, i, s["h"])), "")), "")


def _check_digit(body: Column) -> Column:
    """Luhn digit for the digits that go before it."""
    total = F.aggregate(
        F.transform(F.split(F.reverse(body), ""), lambda c, i: F.when(
            i % 2 == 0, F.when(c.try_cast("int") > 4, c.try_cast("int") * 2 - 9).otherwise(c.try_cast("int") * 2)).otherwise(c.try_cast("int"))),
        F.lit(0), lambda s, x: s + x)
    return ((10 - total % 10) % 10).cast("string")


def drawn(values: DataFrame, draw: int, key: str = KEY) -> DataFrame:
    """Adds ``surrogate`` to rows of (type, norm); later draws get longer, so that no format runs out: mail names,
    secrets, keys and personal names in themselves, numbers by an extension after an x."""
    norm, type_ = F.col("norm"), F.col("type")
    n = F.length(norm)
    base = F.sha2(F.concat_ws("\u0001", F.lit(key), type_, norm, F.lit(str(draw))), 256)
    # Bound once, so that no function of the whole value is worked out again for each of its characters.
    whole = F.array(F.struct(norm.alias("norm"), F.col("base"), norm.rlike("^(?=.*[a-f])[0-9a-f]{8,}$").alias("hexadecimal")))
    shape = F.element_at(F.transform(whole, lambda w: _reshaped(w["norm"], w["base"], w["hexadecimal"])), 1)

    def pick(i: int, options: list[str]) -> Column:
        return F.element_at(F.array(*map(F.lit, options)), (_number(i, len(options)) + 1).cast("int"))

    # 64 bits of the hash, whatever the value holds, so that values of few changeable characters do not run out.
    tail = F.substring("hex", 17, 16)
    longer = [tail] if draw > 7 else [_number(i, 100).cast("string") for i in (3, 4)] if draw > 3 else []
    grown = F.concat("shape", F.when(type_ == "cloud_key", F.upper(tail)).otherwise(tail)) if draw > 3 else F.col("shape")
    extension = [F.lit("x"), F.conv(tail, 16, 10)] if draw > 11 else []
    email = F.concat(F.regexp_extract("shape", "^[^@]*", 0), *longer, F.lit("@mail"), _number(0, 10).cast("string"),
                     F.lit(".example."), pick(1, ["com", "net", "org"]))
    ip = F.concat(F.concat_ws(".", *[(_number(i, 254) + 1).cast("string") for i in range(4)]), *extension)
    phone = F.concat((_number(0, 8) + 2).cast("string"), F.substring("shape", F.lit(2), n), *extension)
    body = F.concat(F.substring(norm, 1, 1), F.substring("shape", F.lit(2), n - 2))
    card = F.concat(body, _check_digit(body), *extension)
    out = F.when(type_ == "email", email).when(type_ == "ip", ip).when(type_ == "phone", phone).when(type_ == "card", card)
    out = out.when(type_.isin("secret", "cloud_key"), grown)
    for script, syllables in SYLLABLES.items():
        size = 2 if draw == 0 else 3 if draw < 3 else 5 if draw < 7 else 8
        out = out.when(type_ == f"surname:{script}", F.initcap(F.concat(*[pick(i, syllables) for i in range(size)])))
        for gender, names in GIVEN[script].items():
            given = [pick(0, names)] + [F.lit("-"), pick(1, names)] * (draw > 0)
            given += [F.lit("-"), F.initcap(F.concat(*[pick(i, syllables) for i in (2, 3, 4, 5)]))] * (draw > 4)
            out = out.when(type_ == f"given:{script}:{gender}", F.concat(*given))
    hashed = values.withColumn("base", base).withColumn("hex", F.sha2(F.concat("base", F.lit("more")), 256)).withColumn("shape", shape)
    return hashed.withColumn("surrogate", out.otherwise(F.concat("shape", *extension))).drop("base", "hex", "shape")


def _space(type_: Column) -> Column:
    """Given names of all genders share one space of surrogates, as do surnames; other types have their own."""
    return F.regexp_replace(type_, ":.*$", "")


def assign(values: DataFrame, key: str = KEY) -> DataFrame:
    """(type, norm, surrogate) for distinct (type, norm): no two values of a space share a surrogate, and none is a
    value of the corpus."""
    waiting = stored(values.select("type", "norm", _space(F.col("type")).alias("space")).distinct(), "pii-values")
    originals = waiting.select("space", F.lower("norm").alias("low"))
    settled, draw = None, 0
    while True:
        tried = drawn(waiting, draw, key).withColumn("low", F.lower("surrogate"))
        taken = originals if settled is None else originals.unionByName(settled.select("space", F.lower("surrogate").alias("low")))
        free = tried.join(taken.distinct(), ["space", "low"], "left_anti")
        first = free.groupBy("space", "low").agg(F.min(F.struct("type", "norm", "surrogate")).alias("w"))
        won = first.select("space", "w.type", "w.norm", "w.surrogate")
        settled = stored(won if settled is None else settled.unionByName(won), "pii-settled")
        left = stored(waiting.join(settled.select("type", "norm"), ["type", "norm"], "left_anti"), "pii-waiting")
        if not left.limit(1).count():
            return settled.select("type", "norm", "surrogate")
        waiting, draw = left, draw + 1
        if draw > DRAWS:
            raise RuntimeError(f"after {DRAWS} draws values still collide; their formats have too few surrogates")


def shown(part: Column, new: Column) -> Column:
    """A surrogate in the format of the occurrence: its digits in the places of the last digits, its case."""
    old, main = part["shown"], F.regexp_extract(new, "^[0-9]*", 0)
    spare = F.length(F.regexp_replace(old, r"\D", "")) - F.length(main)

    def digit(c: Column, i: Column) -> Column:
        at = F.length(F.regexp_replace(F.substring(old, F.lit(1), i + 1), r"\D", "")) - spare
        return F.when(c.rlike("^[0-9]$") & (at > 0), F.substring(main, at, F.lit(1))).otherwise(c)

    extension = F.regexp_replace(new, "^[0-9]*(?=x|$)", "")
    formatted = F.concat(F.array_join(F.transform(F.split(old, ""), digit), ""), F.when(extension == "", "").otherwise(F.concat(F.lit(" "), extension)))
    word = F.when((old == F.upper(old)) & (F.length(old) > 1), F.upper(new)).otherwise(new)
    return (
        F.when(part["type"].isNull(), old).when(part["type"].isin("phone", "card", "ssn"), formatted)
        .when(part["type"].rlike("^(given|surname|email)"), word).otherwise(new)
    )


def bare_mentions(gap: Column, names: Column) -> tuple[Column, Column]:
    """``gap`` with each capitalised whole word of ``names`` (norm, surrogate) replaced, and the number of these."""
    own = F.transform(F.sort_array(F.transform(names, lambda x: F.struct(F.length(x["norm"]).alias("n"), x["norm"].alias("norm"))), asc=False), lambda x: x["norm"])
    pattern = F.concat(F.lit(r"(?<![\p{L}\p{N}_])(?=\p{Lu})(?iu:"), F.array_join(F.array_distinct(own), "|"), F.lit(r")(?![\p{L}\p{N}_])"))
    words = F.regexp_extract_all(gap, pattern, 0)

    def one(old: Column) -> Column:
        new = F.element_at(F.filter(names, lambda x: x["norm"] == F.lower(old)), 1)["surrogate"]
        return F.coalesce(F.when((old == F.upper(old)) & (F.length(old) > 1), F.upper(new)).otherwise(new), old)

    new = F.transform(words, one)
    text = F.array_join(F.transform(F.split(gap, pattern, -1), lambda g, i: F.concat(g, F.coalesce(F.get(new, i), F.lit("")))), "")
    has = F.size(names) > 0
    return F.when(has, text).otherwise(gap), F.when(has, F.size(words)).otherwise(0)


def replace_entities(docs: DataFrame, key: str = KEY, count: str = "n_entities") -> DataFrame:
    """``docs`` with replaced texts and a last column ``count``, the number of entities."""
    has = F.coalesce(F.col("text").rlike(PATTERN), F.lit(False))
    entities = F.regexp_extract_all("text", F.lit(PATTERN), 0)
    hits = stored(docs.where(has).select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), entities.alias("entities")), "pii-hits")
    distinct = hits.select("entities").distinct()
    typed = distinct.select("entities", F.posexplode("entities").alias("i", "entity"))
    split = typed.withColumn("type", kind(F.col("entity"))).select("entities", "i", F.posexplode(parts(F.col("entity"), F.col("type"))).alias("j", "part"))
    split = stored(split.select("entities", "i", "j", "part", F.col("part.type").alias("type"), F.col("part.norm").alias("norm")), "pii-parts")
    chosen = assign(split.where("type IS NOT NULL").select("type", "norm"), key)
    known = split.where("type IS NOT NULL").join(hinted(chosen), ["type", "norm"]).select(
        "entities", "i", "j", shown(F.col("part"), F.col("surrogate")).alias("new"), F.lit(1).alias("real"),
        F.when(F.col("type").rlike("^(given|surname):"), F.struct("j", "norm", "surrogate")).alias("name"))
    kept = split.where("type IS NULL").select("entities", "i", "j", F.col("part.shown").alias("new"), F.lit(0).alias("real"))
    rebuilt = known.unionByName(kept, allowMissingColumns=True).groupBy("entities", "i").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("j", "new"))), lambda p: p["new"]), "").alias("new"), F.max("real").alias("real"),
        F.array_sort(F.collect_list("name")).alias("names"))
    rebuilt = rebuilt.groupBy("entities").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "new"))), lambda p: p["new"]).alias("news"),
        F.sum("real").alias("n_real"), F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("i", "names"))), lambda p: p["names"])).alias("names"))
    # Further mentions of a document's names, without a title, get the surrogate of the first mention with one.
    gaps = F.transform(F.split(F.col("row.text"), PATTERN, -1), lambda g: F.struct(*[
        c.alias(n) for c, n in zip(bare_mentions(g, F.col("names")), ("text", "n"))]))
    text = F.array_join(F.transform("__tf_gaps", lambda g, i: F.concat(g["text"], F.coalesce(F.get(F.col("news"), i), F.lit("")))), "")
    changed = hits.join(rebuilt, "entities").withColumn("__tf_gaps", gaps).withColumn("__tf_new", text).select(
        *[F.col("__tf_new").alias("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns],
        (F.col("n_real") + F.aggregate("__tf_gaps", F.lit(0).cast("long"), lambda t, g: t + g["n"])).alias(count))
    same = docs.where(~has).select(*[docs[f"`{c}`"] for c in docs.columns], F.lit(0).cast("long").alias(count))
    return same.unionByName(changed)

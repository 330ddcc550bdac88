"""Replacement of personal data by keyed surrogates, in DataFrame expressions only.

Entities are found by one pattern. Their distinct values (not their mentions)
form a table; each gets a surrogate from a keyed digest, is checked against
all other surrogates and all real values, and tries again where it collides.
Rows without an entity are never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom.llm.common import text_or_empty
from linkloom.sources.scratch import materialize

# Titles that announce a name, by gender (fixed values).
FEMALE = ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Госпожа", "г-жа"]
MALE = ["Mr", "Herr", "Monsieur", "Señor", "Sr", "Господин", "г-н"]
EITHER = ["Dr", "Prof"]
# Surrogate given names by gender and script.
GIVEN = {
    ("f", "latin"): ["Anna", "Clara", "Elena", "Irene", "Julia", "Laura", "Maria", "Nora", "Olga", "Sara"],
    ("m", "latin"): ["Adam", "Bruno", "David", "Erik", "Felix", "Hugo", "Leon", "Martin", "Oscar", "Paul"],
    ("x", "latin"): ["Alex", "Andrea", "Charlie", "Kim", "Luca", "Noa", "Robin", "Sascha", "Sam", "Toni"],
    ("f", "cyrillic"): ["Анна", "Вера", "Елена", "Ирина", "Мария", "Нина", "Ольга", "Софья"],
    ("m", "cyrillic"): ["Андрей", "Борис", "Виктор", "Иван", "Максим", "Олег", "Павел", "Сергей"],
    ("x", "cyrillic"): ["Саша", "Женя", "Валя", "Слава", "Никита", "Шура"],
}
# Syllables of surrogate surnames.
SYLLABLES = {
    "latin": ["ba", "den", "for", "gal", "hin", "ker", "lo", "mar", "nel", "or", "pas", "rin", "sel", "tor", "ul", "ven"],
    "cyrillic": ["ба", "вер", "гор", "дан", "жел", "кор", "лен", "мар", "нов", "пет", "рус", "сол", "тар", "фил"],
}

#: Attempts after which a surrogate may be one character longer than its value.
WIDEN = 8

_MARK = r"\p{L}\p{N}._%+\-"
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
#: Kind -> pattern, in order of precedence. Every run is possessive or bounded, so matching is linear.
KINDS = {
    "email": rf"(?<![{_MARK}])[{_MARK}]++@[\p{{L}}\p{{N}}\-]++(?:\.[\p{{L}}\p{{N}}\-]++)+",
    "ip": rf"(?<![0-9.]){_OCTET}(?:\.{_OCTET}){{3}}(?![0-9])(?!\.[0-9])",
    "ssn": r"(?<![0-9\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9\-])",
    "card": r"(?<![0-9+])(?:[0-9][ \-]?){12,18}[0-9](?![0-9])",
    "phone": r"(?<![0-9+])(?:\+[0-9]{1,3}[ .\-]?)?(?:\([0-9]{2,4}\)[ .\-]?|[0-9]{2,4}[ .\-])[0-9]{3,4}[ .\-]?[0-9]{3,4}(?![0-9])"
    r"|(?<![0-9+])\+[0-9]{8,15}(?![0-9])",
    "name": rf"(?<!\p{{L}})(?:{'|'.join(FEMALE + MALE + EITHER)})\.? \p{{Lu}}\p{{L}}++(?: \p{{Lu}}\p{{L}}++)?",
}
ENTITY = "|".join(KINDS.values())


def spans(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0))


def _full(kind: str) -> str:
    return f"^(?:{KINDS[kind]})$"


def _kind(span: Column) -> Column:
    out = F.when(F.contains(span, F.lit("@")), "email")
    for kind in ("ip", "ssn", "card", "phone"):
        out = out.when(span.rlike(_full(kind)), kind)
    return out.otherwise("name")


def _atoms(span: Column) -> Column:
    """``(kind, value)`` of what is replaced in a span, with what is kept as kind ``''``.

    A name is its title, perhaps a given name, and a surname, each by itself: a
    person is the same with and without the given name.
    """
    words = F.split(span, " ")
    title = F.regexp_replace(F.get(words, F.lit(0)), r"\.$", "")
    script = F.when(span.rlike(r"\p{IsCyrillic}"), "cyrillic").otherwise("latin")
    gender = F.when(title.isin(FEMALE), "f").when(title.isin(MALE), "m").otherwise("x")

    def atom(kind: Column | str, value: Column) -> Column:
        return F.struct((F.lit(kind) if isinstance(kind, str) else kind).alias("kind"), value.alias("value"))

    surname = F.concat(F.lit("surname-"), script)
    given = F.concat(F.lit("given-"), gender, F.lit("-"), script)
    head = atom("", F.concat(F.get(words, F.lit(0)), F.lit(" ")))
    name = F.when(F.size(words) == 2, F.array(head, atom(surname, F.get(words, F.lit(1))))).otherwise(
        F.array(
            head, atom(given, F.get(words, F.lit(1))), atom("", F.lit(" ")), atom(surname, F.get(words, F.lit(2)))
        )
    )
    kind = _kind(span)
    return F.when(kind == "name", name).otherwise(F.array(atom(kind, span)))


def _canon(kind: Column, value: Column) -> Column:
    """The value that mentions of one entity share, whatever their punctuation and case."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    return F.when(kind == "email", F.lower(value)).when(kind.isin("ssn", "card", "phone"), digits).when(
        kind == "ip", value
    ).otherwise(F.lower(value))


def _numbers(key: str, kind: Column, canon: Column, attempt: Column) -> Column:
    """16-bit numbers from a keyed digest, at least as many as ``canon`` has characters, and 16 more."""
    secret = F.sha2(F.lit(key), 256)
    inner = F.sha2(F.concat_ws("\x1f", secret, kind, attempt.cast("string"), canon), 256)
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor(F.char_length(canon) / 16).cast("int") + 1),
        lambda b: F.sha2(F.concat_ws("\x1f", secret, inner, b.cast("string")), 256),
    )
    return F.transform(
        F.regexp_extract_all(F.array_join(blocks, ""), F.lit("[0-9a-f]{4}"), F.lit(0)),
        lambda h: F.conv(h, 16, 10).cast("int"),
    )


def _char(c: Column, n: Column) -> Column:
    """A character of the class and script of ``c``; others stay."""

    def letter(first: str, count: int) -> Column:
        return F.get(F.split(F.lit("".join(chr(ord(first) + i) for i in range(count))), ""), n % count)

    return (
        F.when(c == "0", F.get(F.split(F.lit("0123456789"), ""), n % 10))
        .when(c.rlike("^[1-9]$"), F.get(F.split(F.lit("123456789"), ""), n % 9))
        .when(c.rlike(r"^\p{IsCyrillic}$"), letter("а", 32))
        .when(c.rlike(r"^\p{L}$"), letter("a", 26))
        .otherwise(c)
    )


def _luhn(digits: Column) -> Column:
    """Sum of the check-digit rule; a valid number's is divisible by 10."""
    doubled = F.transform(
        F.reverse(F.split(digits, "")),
        lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
            (2 * c.cast("int")) % 10 + F.floor(2 * c.cast("int") / 10).cast("int")
        ),
    )
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x)


def _pick(numbers: Column, words: list[str]) -> Column:
    return F.transform(numbers, lambda n: F.get(F.array(*map(F.lit, words)), n % len(words)))


def surrogate(key: str) -> Column:
    """The canonical surrogate of a row ``(kind, canon, attempt)`` with ``numbers``."""
    kind, canon, attempt, n = F.col("kind"), F.col("canon"), F.col("attempt"), F.col("numbers")
    shaped = F.array_join(F.transform(F.split(canon, ""), lambda c, i: _char(c, F.get(n, i))), "")
    size = F.char_length(canon)
    # A country code or an issuer's first digit stays.
    head = F.when(kind == "phone", F.greatest(size - 10, F.lit(0))).when(kind == "card", F.lit(1)).otherwise(F.lit(0))
    number = F.concat(F.substring(canon, F.lit(1), head), F.substring(shaped, head + 1, size))
    open_ = F.concat(F.substring(number, F.lit(1), size - 1), F.lit("0"))
    valid = F.concat(F.substring(number, F.lit(1), size - 1), ((10 - _luhn(open_) % 10) % 10).cast("string"))
    card = F.when(_luhn(canon) % 10 == 0, valid).otherwise(number)
    ip = F.array_join(F.transform(F.slice(n, 1, 4), lambda x: (1 + x % 254).cast("string")), ".")
    top = F.regexp_extract(canon, r"\.[^.]*$", 0)
    email = F.concat(F.substring(shaped, F.lit(1), size - F.char_length(top)), top)
    # Each four attempts make names one part longer, so that names never run out.
    parts = F.slice(n, F.lit(1), F.floor(attempt / 4).cast("int") + 1)
    more = F.slice(n, F.lit(1), F.floor(attempt / 4).cast("int") + 3)
    out = F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "card", card)
    out = out.when(kind.isin("ssn", "phone"), number)
    for (gender, script), names in GIVEN.items():
        out = out.when(kind == f"given-{gender}-{script}", F.lower(F.array_join(_pick(parts, names), "-")))
    for script, syllables in SYLLABLES.items():
        out = out.when(kind == f"surname-{script}", F.array_join(_pick(more, syllables), ""))
    # Short shapes can be used up, so the others become longer at their end, a character each few attempts.
    longer = F.slice(n, F.char_length(canon) + 1, F.floor(attempt / WIDEN).cast("int"))
    tail = F.transform(longer, lambda x: F.when(kind == "email", _char(F.lit("a"), x)).otherwise(_char(F.lit("0"), x)))
    return F.when(kind.isin("email", "ssn", "phone", "card"), F.concat(out, F.array_join(tail, ""))).otherwise(out)


def assign(entities: DataFrame, key: str) -> DataFrame:
    """``(kind, canon, fake)`` for distinct ``entities (kind, canon)``.

    In each round a surrogate stands if no real value and no standing surrogate
    of its kind equals it and it is the first of those that ask for it; the rest
    try their next one, which in time is longer, so that every shape has room. The
    first to ask is the smallest value, so reruns agree.
    """
    real = materialize(entities, "entities")
    waiting, standing, attempt = real, None, 0
    while True:
        asked = waiting.withColumn("attempt", F.lit(attempt))
        asked = asked.withColumn("numbers", _numbers(key, F.col("kind"), F.col("canon"), F.col("attempt")))
        asked = asked.select("kind", "canon", surrogate(key).alias("fake"))
        first = Window.partitionBy("kind", "fake").orderBy("canon")
        asked = asked.withColumn("turn", F.row_number().over(first))
        taken = real.select("kind", F.col("canon").alias("fake"))
        if standing is not None:
            taken = taken.union(standing.select("kind", "fake"))
        taken = taken.distinct().withColumn("taken", F.lit(True))
        asked = materialize(asked.join(taken, ["kind", "fake"], "left"), "asked")
        won = asked.where("turn = 1 and taken is null").select("kind", "canon", "fake")
        waiting = asked.where("turn > 1 or taken").select("kind", "canon")
        standing = won if standing is None else standing.union(won)
        if waiting.isEmpty():
            return standing
        attempt += 1


def _cased(value: Column, fake: Column) -> Column:
    title = F.array_join(F.transform(F.split(fake, "-"), lambda x: F.initcap(x)), "-")
    return F.when(value == F.upper(value), F.upper(fake)).otherwise(title)


def _pour(value: Column, fake: Column) -> Column:
    """``fake``'s letters and digits in the format of the mention ``value``; what it has more stands at the end."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))
    plain = F.split(F.regexp_replace(fake, r"[^\p{L}\p{N}]", ""), "")

    def step(acc: Column, c: Column) -> Column:
        mark = c.rlike(r"^[\p{L}\p{N}]$")
        new = F.get(plain, acc["at"] - 1)
        new = F.when(c.rlike(r"^\p{Lu}$"), F.upper(new)).otherwise(new)
        return F.struct(
            F.concat(acc["out"], F.when(mark, new).otherwise(c)).alias("out"),
            (acc["at"] + F.when(mark, 1).otherwise(0)).alias("at"),
        )

    def ended(acc: Column) -> Column:
        return F.concat(acc["out"], F.array_join(F.slice(plain, acc["at"], F.greatest(F.size(plain) - acc["at"] + 1, F.lit(0))), ""))

    return F.aggregate(F.split(value, ""), start, step, ended)


def _mention(kind: Column, value: Column, fake: Column) -> Column:
    poured = F.when(kind == "ip", fake).when(F.instr(kind, "name") > 0, _cased(value, fake)).when(
        F.instr(kind, "given") > 0, _cased(value, fake)
    )
    return poured.otherwise(_pour(value, fake))


def replace_entities(docs: DataFrame, key: str = "surrogates") -> DataFrame:
    """``docs`` with the entities in ``text`` replaced; all columns and rows kept, plus a count, the last column.

    The count is ``n_entities``, with a ``_`` more at its end where that is a column already.
    Equal entities get equal surrogates in all documents, different ones
    different surrogates, none a real value of its kind. Null text stays null.
    Text without an entity stays as it is. ``n_chars``, where there is one,
    follows the new text. Spans are replaced all, however many.
    """
    names = docs.columns
    counted = "n_entities"
    while counted in names:
        counted += "_"
    renamed = {c: f"_{i}" for i, c in enumerate(names)}
    plain = docs.select([F.col(c).alias(renamed[c]) for c in names])
    text = F.col(renamed["text"])
    has = F.coalesce(text.rlike(ENTITY), F.lit(False))
    clean = plain.where(~has).withColumn("n_entities", F.lit(0).cast("long"))
    found = plain.where(has).withColumn("_spans", spans(text)).withColumn("_list", F.md5(F.array_join("_spans", "\x1f")))

    lists = materialize(plain.where(has).select(spans(text).alias("_spans")).distinct(), "lists")
    lists = lists.withColumn("_list", F.md5(F.array_join("_spans", "\x1f")))
    at = lists.select("_list", F.posexplode("_spans").alias("_at", "_span"))
    atoms = at.select("_list", "_at", F.posexplode(_atoms(F.col("_span"))).alias("_part", "_atom"))
    atoms = atoms.select(
        "_list", "_at", "_part", F.col("_atom.kind").alias("kind"), F.col("_atom.value").alias("value")
    ).withColumn("canon", _canon(F.col("kind"), F.col("value")))
    fakes = assign(atoms.where("kind <> ''").select("kind", "canon").distinct(), key)
    mended = atoms.join(fakes, ["kind", "canon"], "left").withColumn(
        "new", F.when(F.col("kind") == "", F.col("value")).otherwise(_mention(F.col("kind"), F.col("value"), F.col("fake")))
    )
    spans_new = mended.groupBy("_list", "_at").agg(F.sort_array(F.collect_list(F.struct("_part", "new"))).alias("parts"))
    spans_new = spans_new.select("_list", "_at", F.array_join("parts.new", "").alias("new"))
    by_list = spans_new.groupBy("_list").agg(F.sort_array(F.collect_list(F.struct("_at", "new"))).alias("spans"))
    by_list = materialize(by_list.select("_list", F.col("spans.new").alias("_new")), "replacements")

    gaps = F.split(text, ENTITY, -1)
    woven = F.array_join(F.zip_with(gaps, F.col("_new"), lambda g, s: F.concat(g, F.coalesce(s, F.lit("")))), "")
    mixed = found.join(by_list, "_list").withColumn("_text", woven)
    size = F.size("_spans").cast("long").alias("n_entities")
    columns = [
        F.col("_text").alias(c) if c == renamed["text"]
        else F.char_length("_text").cast(docs.schema["n_chars"].dataType).alias(c) if c == renamed.get("n_chars")
        else F.col(c)
        for c in renamed.values()
    ]
    both = clean.unionByName(mixed.select(*columns, size))
    return both.select(*[F.col(renamed[c]).alias(c) for c in names], F.col("n_entities").alias(counted))

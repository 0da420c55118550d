"""Personal data: surrogates that keep type, gender, script and format.

Entities are found with one regular expression. Each distinct entity (e-mail
address, phone or card number, ... or a single part of a person's name) gets
one surrogate, drawn from a keyed digest of its kind and normalised value, so
the same entity reads the same in every document. Draws are checked over the
whole corpus: an entity whose draw equals another entity's surrogate, or an
entity that really occurs, draws again, until all are distinct. Then every
mention is rewritten in its own format (digits between the same separators,
names in the same case and script, of the same gender) and put back in place.

Only DataFrame and SQL functions are used. Entities are counted and joined,
never gathered: a frequent entity is combined before its shuffle, and the join
back to the mentions is one that AQE can split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import checkpointed

# Titles with the gender they tell (n: neither).
TITLES = {
    "m": ["Mr", "Herr", "Monsieur", "Señor", "Sr", "Don", "г-н"],
    "f": ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra", "Srta", "Doña", "г-жа"],
    "n": ["Dr", "Prof"],
}
# Given names and surnames by script, to find and to draw from.
GIVEN = {
    ("m", "Latin"): ["James", "John", "Robert", "Michael", "William", "David", "Thomas", "Charles", "Peter", "Paul",
                     "Hans", "Klaus", "Jürgen", "Stefan", "Pierre", "Jean", "Luc", "Carlos", "José", "Miguel"],
    ("f", "Latin"): ["Mary", "Patricia", "Jennifer", "Linda", "Elizabeth", "Susan", "Sarah", "Karen", "Emma", "Alice",
                     "Ursula", "Monika", "Heike", "Sabine", "Marie", "Claire", "Sophie", "Carmen", "Lucía", "Pilar"],
    ("m", "Cyrillic"): ["Иван", "Пётр", "Сергей", "Андрей", "Дмитрий", "Николай", "Павел", "Олег"],
    ("f", "Cyrillic"): ["Анна", "Мария", "Елена", "Ольга", "Наталья", "Ирина", "Татьяна", "Светлана"],
}
SURNAMES = {
    "Latin": ["Smith", "Johnson", "Brown", "Miller", "Wilson", "Taylor", "Clark", "Lewis", "Walker", "Young",
              "Müller", "Schneider", "Fischer", "Weber", "Becker", "Dupont", "Moreau", "Laurent", "García", "López"],
    "Cyrillic": ["Шевчук", "Коваленко", "Ткаченко", "Мороз", "Бондарь", "Савченко", "Мельник", "Гончар"],
}
# Signs that stand for each other in a surrogate.
ALPHABETS = ["0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
             "àáâãäåçèéêëìíîïñòóôõöùúûüýß", "ÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝ",
             "абвгдежзийклмнопрстуфхцчшщъыьэюя", "АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯ",
             "αβγδεζηθικλμνξοπρστυφχψω", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ"]

_EDGE, _END = r"(?<![\p{L}\p{N}])", r"(?![\p{L}\p{N}])"
_CAP = r"\p{Lu}[\p{L}'’-]+"
# Formats of the entities, in the order in which they are tried.
FORMATS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)+",
    "ip": r"(?<![\p{L}\p{N}.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\p{L}\p{N}]|\.\d)",
    "iban": _EDGE + r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?" + _END,
    "ssn": r"(?<![\p{L}\p{N}-])\d{3}-\d{2}-\d{4}(?![\p{L}\p{N}-])",
    "card": _EDGE + r"\d{4}(?:[ -]?\d{4}){2}[ -]?\d{1,7}" + _END,
    "phone": r"(?<![\p{L}\p{N}.+])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}"
             r"|(?:\(\d{3}\) ?|\d{3}[.-])\d{3}[.-]\d{4})" + _END,
    "name": r"(?<!\p{L})(?:(?:" + "|".join(sorted(sum(TITLES.values(), []), key=len, reverse=True))
            + rf")\.? {_CAP}(?: {_CAP})?|(?:" + "|".join(sorted({n for v in GIVEN.values() for n in v}))
            + rf") {_CAP})(?!\p{{L}})",
}
PATTERN = "|".join(f"(?:{p})" for p in FORMATS.values())
_DIGITS = ("ssn", "card", "phone")
MAX_ROUNDS = 40


def _kind(mention: Column) -> Column:
    out = F.lit("name")
    for kind, pattern in reversed(list(FORMATS.items())[:-1]):
        # a mention is matched whole; the look-arounds then hold at its ends
        out = F.when(mention.rlike(f"^(?:{pattern})$"), kind).otherwise(out)
    return out


def _among(value: Column, values: list[str]) -> Column:
    return value.isin(values)


def _name_parts(mention: Column) -> Column:
    """Parts of a name: struct(kind, raw); the title's kind is null."""
    parts = F.split(mention, " ")
    head = F.regexp_replace(parts[0], r"\.$", "")
    titled = _among(head, sum(TITLES.values(), []))
    male = sum((v for (g, _), v in GIVEN.items() if g == "m"), [])
    female = sum((v for (g, _), v in GIVEN.items() if g == "f"), [])

    def gender(given: Column) -> Column:
        return (F.when(_among(head, TITLES["m"]) | _among(given, male), "given_m")
                .when(_among(head, TITLES["f"]) | _among(given, female), "given_f").otherwise("given_n"))

    return F.transform(parts, lambda p, i: F.struct(
        F.when((i == 0) & titled, F.lit(None).cast("string"))
        .when(i == F.size(parts) - 1, "surname").otherwise(gender(p)).alias("kind"), p.alias("raw")))


def _norm(kind: Column, raw: Column) -> Column:
    """Value that all mentions of one entity share."""
    return (F.when(kind.isin(*_DIGITS), F.regexp_replace(raw, r"[^0-9+]", ""))
            .when(kind == "iban", F.regexp_replace(raw, " ", ""))
            .otherwise(F.lower(raw)))


def _stream(key: str, *cols: Column) -> Column:
    """256 keyed hexadecimal digits."""
    return F.concat(*[F.sha2(F.concat_ws("|", F.lit(key), F.lit(str(k)), *cols), 256) for k in range(4)])


def _number(stream: Column, at: Column, below: Column | int) -> Column:
    """A number under ``below`` from the stream's four digits for place ``at``."""
    part = F.substring(stream, (F.pmod(at, F.lit(64)) * 4 + 1).cast("int"), F.lit(4))
    return F.pmod(F.conv(part, 16, 10).cast("int"), F.lit(below) if isinstance(below, int) else below)


def _like(value: Column, stream: Column, keep: Column) -> Column:
    """Every sign replaced by another of its alphabet; the first ``keep`` signs stay."""
    def other(sign: Column, at: Column) -> Column:
        out = sign
        for letters in ALPHABETS:
            pick = F.substring(F.lit(letters), (_number(stream, at, len(letters)) + 1).cast("int"), F.lit(1))
            out = F.when(F.instr(F.lit(letters), sign) > 0, pick).otherwise(out)
        return F.when(at < keep, sign).otherwise(out)
    return F.array_join(F.transform(F.split(value, ""), other), "")


def _luhn(digits: Column) -> Column:
    """Luhn sum of a digit string, modulo 10."""
    n = F.length(digits)
    parts = F.transform(F.split(digits, ""), lambda d, i: F.when(
        F.pmod(n - i, F.lit(2)) == 0,
        F.when(d.cast("int") > 4, d.cast("int") * 2 - 9).otherwise(d.cast("int") * 2)).otherwise(d.cast("int")))
    return F.pmod(F.aggregate(parts, F.lit(0), lambda a, x: a + x), F.lit(10))


def _drawn_name(stream: Column, attempt: Column, norm: Column, pools: dict[str, list[str]]) -> Column:
    """A name of the value's script; later attempts add syllables, so names do not run out."""
    def of(pool: list[str], syllables: list[str]) -> Column:
        arr = F.array(*map(F.lit, pool))
        syl = F.array(*map(F.lit, syllables))
        name = F.get(arr, _number(stream, F.lit(0), len(pool)))
        more = F.transform(F.sequence(F.lit(1), F.greatest(attempt, F.lit(1))),
                           lambda k: F.get(syl, _number(stream, k, len(syllables))))
        return F.when(attempt > 0, F.concat(name, F.array_join(more, ""))).otherwise(name)
    return F.when(norm.rlike(r"\p{IsCyrillic}"), of(pools["Cyrillic"], ["ов", "ин", "ко", "ра", "ле", "ми"])) \
        .otherwise(of(pools["Latin"], ["son", "er", "man", "ley", "ard", "in"]))


def _draw(key: str) -> Column:
    """The surrogate that an entity draws in its present attempt."""
    kind, norm, attempt = F.col("kind"), F.col("norm"), F.col("attempt")
    stream = _stream(key, kind, norm, attempt.cast("string"))
    plus = norm.startswith("+")
    digits = _like(norm, stream, F.when(plus, F.lit(2)).when(kind == "card", F.lit(1)).otherwise(F.lit(0)))
    body = F.expr("substring(norm, 1, length(norm) - 1)")
    base = _like(body, stream, F.lit(1))
    check = F.pmod(F.lit(10) - _luhn(F.concat(base, F.lit("0"))), F.lit(10))
    card = F.when(_luhn(norm) == 0, F.concat(base, check.cast("string"))).otherwise(digits)
    private = norm.rlike(r"^(10\.|192\.168\.|172\.(1[6-9]|2[0-9]|3[01])\.)")
    octet = lambda at: (_number(stream, F.lit(at), 254) + 1).cast("string")
    ip = F.concat_ws(".", F.when(private, F.lit("10")).otherwise((_number(stream, F.lit(0), 89) + 11).cast("string")),
                     octet(1), octet(2), octet(3))
    top = F.regexp_extract(norm, r"(\.[^.@]+)$", 1)
    email = F.concat(_like(F.expr(r"regexp_replace(norm, '\\.[^.@]+$', '')"), stream, F.lit(0)), top)
    given = lambda g: _drawn_name(
        stream, attempt, norm, {s: sum((v for (x, y), v in GIVEN.items() if y == s and x in g), []) for s in SURNAMES})
    return (F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "card", card)
            .when(kind == "iban", _like(norm, stream, F.lit(2)))
            .when(kind == "given_m", given("m")).when(kind == "given_f", given("f")).when(kind == "given_n", given("mf"))
            .when(kind == "surname", _drawn_name(stream, attempt, norm, SURNAMES)).otherwise(digits))


def draw_surrogates(entities: DataFrame, key: str) -> DataFrame:
    """``(kind, norm, surrogate)``: one for each distinct entity, all distinct and none a real entity.

    Given names of all genders and surnames share one space, so a part of a
    name never turns into another's.
    """
    space = F.when(F.col("kind").rlike("^(given|surname)"), "name").otherwise(F.col("kind"))
    state = checkpointed(entities.select("kind", "norm").distinct().withColumn("space", space)
                         .withColumn("attempt", F.lit(0)))
    real = state.select("space", F.col("norm").alias("shown")).distinct().withColumn("real", F.lit(True))
    for _ in range(MAX_ROUNDS):
        drawn = state.withColumn("surrogate", _draw(key)).withColumn("shown", F.lower("surrogate"))
        first = drawn.groupBy("space", "shown").agg(F.min(F.struct("attempt", "kind", "norm")).alias("first"))
        drawn = drawn.join(first, ["space", "shown"]).join(real, ["space", "shown"], "left")
        again = F.col("real").isNotNull() | (F.struct("attempt", "kind", "norm") != F.col("first"))
        checked = checkpointed(drawn.select("kind", "norm", "space", "attempt", "surrogate", again.alias("again")))
        if checked.where("again").isEmpty():
            return checked.select("kind", "norm", "surrogate")
        state = checked.select("kind", "norm", "space",
                               (F.col("attempt") + F.col("again").cast("int")).alias("attempt"))
    raise RuntimeError("surrogates still collide after MAX_ROUNDS draws")


def _formatted(kind: Column, raw: Column, surrogate: Column) -> Column:
    """The surrogate in the mention's own format."""
    spaced = F.array_join(F.transform(F.split(raw, ""), lambda c, i: F.when(
        c.rlike(r"[0-9+]"), F.substring(surrogate, F.length(F.regexp_replace(
            F.substring(raw, F.lit(1), (i + 1).cast("int")), r"[^0-9+]", "")), F.lit(1))).otherwise(c)), "")
    blocks = F.array_join(F.transform(F.split(raw, ""), lambda c, i: F.when(
        c != " ", F.substring(surrogate, F.length(F.regexp_replace(
            F.substring(raw, F.lit(1), (i + 1).cast("int")), " ", "")), F.lit(1))).otherwise(c)), "")
    named = F.when((raw == F.upper(raw)) & (F.length(raw) > 1), F.upper(surrogate)).otherwise(surrogate)
    return (F.when(kind.isin(*_DIGITS), spaced).when(kind == "iban", blocks)
            .when(kind.rlike("^(given|surname)"), named).otherwise(surrogate))


def replace_entities(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text, n_entities, kinds)``: texts with every entity replaced by its surrogate.

    Texts without entities come back as they are, null stays null. Rows that
    repeat an id and text get the same result each; rows without an id are
    treated alike. An empty table gives an empty result. The same key gives
    the same surrogates on the same corpus.
    A very long text is read whole, by one task; nothing is cut off.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    found = F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0))
    by = F.xxhash64("text")
    parts = (rows.select("doc_id", by.alias("by"), F.posexplode(found).alias("pos", "mention"))
             .withColumn("__kind", _kind(F.col("mention")))
             .select("doc_id", "by", "pos", F.posexplode(
                 F.when(F.col("__kind") == "name", _name_parts(F.col("mention"))).otherwise(
                     F.array(F.struct(F.col("__kind").alias("kind"), F.col("mention").alias("raw"))))).alias("part", "p"))
             .select("doc_id", "by", "pos", "part", "p.kind", "p.raw")
             .withColumn("norm", _norm(F.col("kind"), F.col("raw"))))
    parts = checkpointed(parts)
    surrogates = draw_surrogates(parts.where("kind is not null"), key)
    ready = (parts.join(surrogates, ["kind", "norm"], "left")
             .withColumn("new", F.coalesce(_formatted(F.col("kind"), F.col("raw"), F.col("surrogate")), "raw")))
    # the parts of a mention, then the mentions of a text; repeated rows give the same parts again
    mentions = (ready.groupBy("doc_id", "by").agg(F.sort_array(F.collect_set(
        F.struct("pos", "part", "new", "kind"))).alias("all"))
        .select(F.col("doc_id").alias("__id"), F.col("by").alias("__by"), "all"))
    joined = rows.withColumn("__by", by).join(mentions.withColumnRenamed("__by", "__of"),
                                              F.col("doc_id").eqNullSafe(F.col("__id"))
                                              & (F.col("__by") == F.col("__of")), "left")
    texts = F.transform(F.sequence(F.lit(0), F.element_at("all", -1)["pos"]), lambda k: F.array_join(
        F.transform(F.filter("all", lambda x: x["pos"] == k), lambda x: x["new"]), " "))
    gaps = F.split("text", PATTERN, -1)
    return (joined.withColumn("__new", F.when(F.col("all").isNotNull(), texts))
            .withColumn("__gaps", F.when(F.col("all").isNotNull(), gaps))
            .select("doc_id",
                    F.when(F.col("all").isNull(), F.col("text")).otherwise(F.array_join(F.flatten(F.transform(
                        "__gaps", lambda gap, i: F.array(gap, F.coalesce(F.get("__new", i), F.lit(""))))), "")).alias("text"),
                    F.when(F.col("all").isNull(), 0).otherwise(F.size("__new")).cast("long").alias("n_entities"),
                    F.coalesce(F.transform(F.filter("all", lambda x: x["kind"].isNotNull()), lambda x: x["kind"]),
                               F.array().cast("array<string>")).alias("kinds")))

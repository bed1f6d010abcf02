"""Personal data replaced by keyed surrogates of the same type and form.

Entities are found by one pattern, their surrogates derived from a keyed hash
of type and value, so an entity gets the same surrogate wherever it stands
(coreference). All distinct entities of the table are then checked together:
no two share a surrogate and no surrogate is an entity that occurs. Only
DataFrame functions are used.
"""

from __future__ import annotations

from hashlib import sha256

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import stage
from .common import let

# Titles and first names by gender and script, and syllables of surnames by script.
TITLES = {
    "m": "Mr Mister Sir Lord Herr Herrn Monsieur monsieur Señor señor Sr Господин господин Г-н г-н".split(),
    "f": "Mrs Ms Miss Lady Frau Madame madame Mme Mademoiselle mademoiselle Mlle Señora señora Señorita señorita Sra Srta Госпожа госпожа Г-жа г-жа".split(),
    "": "Dr Prof Professor Doktor Docteur Доктор Профессор".split(),
}
FIRST = {
    ("m", "latin"): """Adam Bruno Carl Daniel Emil Felix George Henri Ivan Jorge Karl Louis Martin Oscar Paul Robert Simon Thomas Victor William John James Michael David Richard Joseph Charles
        Christopher Matthew Anthony Andrew Joshua Kenneth Kevin Brian Edward Ronald Timothy Jason Jeffrey Ryan Jacob Gary Nicholas Eric Jonathan Stephen Steven Larry Justin Scott Brandon Benjamin
        Samuel Gregory Alexander Patrick Jack Dennis Jerry Tyler Aaron Peter Henry Douglas Nathan Zachary Kyle Walter Harold Arthur Albert Philip Hans Klaus Jürgen Wolfgang Günter Günther Uwe Bernd
        Dieter Heinz Helmut Horst Manfred Werner Stefan Andreas Matthias Sebastian Florian Tobias Lukas Jonas Maximilian Moritz Friedrich Heinrich Johann Johannes Joachim Gerhard Rainer Ulrich Kurt
        Otto Ernst Franz Ludwig Jean Pierre Michel Philippe Alain Jacques Bernard Christophe François Nicolas Laurent Frédéric Éric Stéphane Olivier Pascal Thierry Gérard André Julien Guillaume
        Antoine Mathieu Luc Yves Marc Claude René Étienne Juan José Antonio Manuel Francisco Javier Carlos Miguel Rafael Pedro Ángel Alejandro Fernando Luis Pablo Sergio Diego Álvaro Enrique Andrés
        Ramón Vicente Alberto Gabriel Mario Eduardo Roberto Jaime Ricardo Santiago""".split(),
    ("f", "latin"): """Alice Berta Clara Diana Emma Flora Greta Helena Ingrid Julia Katharina Laura Maria Nora Olivia Paula Rosa Sofia Teresa Vera Mary Patricia Jennifer Linda Elizabeth Barbara Susan
        Jessica Sarah Karen Lisa Nancy Betty Sandra Margaret Ashley Kimberly Emily Donna Michelle Carol Amanda Melissa Deborah Stephanie Rebecca Sharon Cynthia Dorothy Kathleen Amy Angela Anna Anne
        Brenda Pamela Nicole Ruth Katherine Catherine Samantha Christine Rachel Carolyn Janet Heather Diane Jane Joan Julie Ursula Monika Petra Sabine Renate Helga Karin Brigitte Erika Gisela Andrea
        Claudia Susanne Birgit Heike Kerstin Martina Anja Silke Ute Johanna Hannah Lena Lea Marie Sophie Charlotte Jeanne Françoise Monique Nathalie Isabelle Sylvie Catalina Valérie Véronique
        Sandrine Céline Chantal Aurélie Camille Élodie Hélène Juliette Manon Chloé Carmen Ana Isabel Dolores Pilar Josefa Cristina Lucía Marta Mercedes Elena Raquel Beatriz Rocío Inés Irene
        Silvia Alicia Eva Concepción María""".split(),
    ("m", "cyrillic"): "Антон Борис Виктор Григорий Дмитрий Егор Иван Максим Николай Олег Александр Сергей Андрей Алексей Владимир Михаил Евгений Юрий Павел Пётр Петр Игорь Константин Василий Фёдор".split(),
    ("f", "cyrillic"): "Анна Вера Галина Дарья Елена Ирина Мария Наталья Ольга Татьяна Светлана Людмила Екатерина Юлия Валентина Анастасия Александра Ксения Тамара Софья".split(),
}
SYLLABLES = {"latin": ["ba", "de", "fi", "go", "ha", "ke", "li", "mo", "na", "pe", "ri", "so", "ta", "ve", "wi", "zu"], "cyrillic": ["ба", "ве", "ги", "до", "за", "ке", "ли", "мо", "на", "пе", "ри", "со", "та", "фе", "хи", "чу"]}

#: Capitalised words that open or close sentences and are no part of a name.
STOP = """The A An And But Or If In On At To Of For From With By As He She It We You They I This That These Those There Then When Where While Who What Is Was Are Were His Her Our My Your Their No Not Yes
    Der Die Das Ein Eine Und Oder Aber Er Sie Es Wir Ihr Ich Ist War Mit Von Zu Im Am Auf Für Als Wenn Dann Dies Diese Le La Les Un Une Et Ou Mais Il Elle Nous Vous Ils Elles Je Ce Cette Dans Sur Pour
    El Los Las Una Y O Pero Él Ella En Con Por Para Este Esta Monday Tuesday Wednesday Thursday Friday Saturday Sunday January February April July August September October November December""".split()
PARTICLES = "van von vom der den de la las los del della di da dos du des le el al bin ibn ben zu zum zur ter ten".split()


def _trie(words: list[str]) -> str:
    """A pattern of the words that looks at each letter once; the longest is tried first."""
    heads: dict[str, list[str]] = {}
    for w in sorted({w for w in words if w}):
        heads.setdefault(w[0], []).append(w[1:])
    inner = "|".join(h + _trie(rest) for h, rest in heads.items())
    return (f"(?:{inner})" + ("?" if "" in words else "")) if inner else ""


_TITLE = _trie([t for group in TITLES.values() for t in group])
_NAME = _trie([n for names in FIRST.values() for n in names])
# a capitalised part, with an elided article, inner capitals, apostrophes and hyphens: O'Brien, McDonald, D'Angelo, García-Lorca
_CAP = rf"(?!{_trie(STOP)}(?![\p{{L}}'’-]))(?:[dDlL]['’])?+\p{{Lu}}(?:['’]\p{{Lu}})?[\p{{L}}\p{{M}}]++(?:['’-]\p{{Lu}}[\p{{L}}\p{{M}}]++)*+"
_SEP = r"[ \t ]{1,2}"
_RUN = rf"(?:(?:{'|'.join(PARTICLES)}){_SEP}|\p{{Lu}}\.[ \t ]?|\p{{Lu}}{_SEP}|{_CAP}{_SEP}){{0,6}}{_CAP}"
_IPV4 = r"(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)"
_H = "[0-9A-Fa-f]{1,4}"
#: Type and pattern, in the order in which they are tried at a place.
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+){0,126}\.[A-Za-z]{2,}(?![\p{L}\p{N}-])",
    "secret": r"(?<![\p{L}\p{N}])(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk-(?=[A-Za-z_-]*+\d)[A-Za-z0-9_-]{20,}+|sk-[A-Za-z0-9]{20,}+|[0-9a-f]{32,}+)(?![\p{L}\p{N}])",
    "iban": r"(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    "ipv4": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "phone": r"(?<![\d+])\+\d{1,3} ?\(0\) ?\d{2,5}(?:[ ./-]?\d{2,9}){1,4}(?!\d)|(?<![\d+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\) ?\d{3}[ .-]?\d{3,4}|\d{3}[ .-]\d{3}[ .-]\d{4})(?!\d)|(?<![\d+])\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?!\d)",
    "card": r"(?<![\d-])\d(?:[ -]?\d){12,18}(?![\d-])",
    # national forms: France, Germany, Spain by threes or twos, North America without separators
    "national": r"(?<![\p{L}\p{N}+])(?<!\p{N}[.,-])(?:0[1-9](?:[ .-]?\d{2}){4}|\(?0\d{2,4}\)?[ /-]{1,3}(?:\d{5,9}|\d{2,5}(?:[ -]\d{2,5}){1,3})|[6-9]\d{2}(?:[ .-]?\d{3}){2}|[6-9]\d{2}(?:[ .-]\d{2}){3}|[2-9]\d{9})(?![\p{L}\p{N}])",
    "ipv6": rf"(?<![\p{{L}}\p{{N}}:.])(?=[0-9A-Fa-f:]*\d)(?:(?:{_H}:){{6}}{_IPV4}|(?:{_H}:){{7}}{_H}|(?:{_H}(?::{_H}){{0,6}})?::(?:{_H}:){{0,5}}(?:{_IPV4}|{_H})|{_H}(?::{_H}){{0,6}}::)(?![\p{{L}}\p{{N}}:]|\.\d)",
    "name": rf"(?<![\p{{L}}\p{{N}}])(?=\p{{L}})(?:(?:{_TITLE}\.?\s{{1,2}}){{1,3}}{_RUN}|(?=\p{{Lu}}){_NAME}(?:-\p{{Lu}}[\p{{L}}\p{{M}}]++)?{_SEP}{_RUN})(?!\p{{L}})",
}
#: An entity starts after a character that is no letter or digit, or with one of
#: a few characters; told first, this spares all patterns inside of words.
ANY = r"(?:(?<![\p{L}\p{N}])|(?=[\p{N}+(._%:-]))(?:" + "|".join(PATTERNS.values()) + ")"


def kind_of(value: Column) -> Column:
    out = F.lit("name")
    for name in reversed([k for k in PATTERNS if k != "name"]):
        out = F.when(value.rlike(f"^(?:{PATTERNS[name]})$"), name).otherwise(out)
    return out


def _byte(digest: Column, i: Column) -> Column:
    """The i-th of 128 numbers below 256 of a digest string."""
    return F.conv(F.substring(digest, F.pmod(i, F.lit(128)) * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _digest(key: str, kind: Column, value: Column, attempt: Column) -> Column:
    parts = [F.sha2(F.concat_ws("\x1f", F.lit(key), F.lit(str(k)), kind, value, attempt.cast("string")), 256) for k in range(4)]
    return F.concat(*parts)


def _grown(value: Column, attempt: Column) -> Column:
    """The value, its last character once more for every second attempt: no form runs out of values."""
    return F.concat(value, F.repeat(F.substring(value, F.char_length(value), F.lit(1)), F.floor(attempt / 2).cast("int")))


def _letters(value: Column, digest: Column, fixed: Column) -> Column:
    """Each letter and digit from ``fixed`` on by one of its own class; all other characters stay."""

    def one(c: Column, i: Column) -> Column:
        b = _byte(digest, i)
        pick = lambda chars: F.substring(F.lit(chars), b % len(chars) + 1, F.lit(1))
        new = F.when(c.rlike(r"^\d$"), pick("0123456789")).when(c.rlike(r"^\p{IsCyrillic}$"), pick("бвгдзклмнпрст")).when(c.rlike(r"^\p{Lu}$"), pick("BCDFGHJKLMNPRSTVWZ"))
        return F.when(i < fixed, c).otherwise(new.when(c.rlike(r"^\p{L}$"), pick("abcdefghijklmnoprstuvwyz")).otherwise(c))

    return F.array_join(F.transform(F.split(value, "(?!^)(?!$)"), one), "")


def _luhn(digits: Column) -> Column:
    """Luhn sum of a string of digits, its last digit counting once."""
    d = F.reverse(F.split(digits, "(?!^)(?!$)"))
    step = lambda x, i: F.when(i % 2 == 0, x.cast("int")).otherwise((x.cast("int") * 2) % 10 + F.floor(x.cast("int") / 5).cast("int"))
    return F.aggregate(F.transform(d, step), F.lit(0), lambda a, x: a + x)


def _card(value: Column, long: Column, digest: Column) -> Column:
    """Other digits in the places of ``long``; the first stays, and a valid check digit stays valid."""

    def fix(new: Column) -> Column:
        bare = lambda c: F.regexp_replace(c, r"\D", "")
        body = F.substring(new, F.lit(1), F.char_length(new) - 1)
        check = F.pmod(-_luhn(F.concat(bare(body), F.lit("0"))), F.lit(10)).cast("string")
        return F.when(_luhn(bare(value)) % 10 == 0, F.concat(body, check)).otherwise(new)

    return let(_letters(long, digest, F.lit(1)), fix)


def _mod97(account: Column) -> Column:
    """The remainder of an account number without spaces, country and check digits moved to its end."""
    turned = F.concat(F.substring(account, F.lit(5), F.char_length(account)), F.substring(account, 1, 4))

    def step(a: Column, c: Column) -> Column:
        return F.when(c.rlike(r"^\d$"), (a * 10 + F.try_to_number(c, F.lit("9")).cast("int")) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97)

    return F.aggregate(F.split(turned, "(?!^)(?!$)"), F.lit(0), step)


def _iban(value: Column, long: Column, digest: Column) -> Column:
    """Other letters and digits behind the country; valid check digits stay valid."""
    bare = lambda c: F.regexp_replace(c, " ", "")

    def fix(new: Column) -> Column:
        zero = F.concat(F.substring(bare(new), 1, 2), F.lit("00"), F.substring(bare(new), F.lit(5), F.char_length(new)))
        check = F.lpad((F.lit(98) - _mod97(zero)).cast("string"), 2, "0")
        valid = F.concat(F.substring(new, 1, 2), check, F.substring(new, F.lit(5), F.char_length(new)))
        return F.when(_mod97(bare(value)) == 1, valid).otherwise(new)

    return let(_letters(long, digest, F.lit(2)), fix)


_TOKEN = r"\s+|[^\s.]+\.?|\."


def _tokens(value: Column) -> Column:
    return F.regexp_extract_all(value, F.lit(_TOKEN), F.lit(0))


def _is_surname(tokens: Column, t: Column, i: Column) -> Column:
    """The last part of a name, and every other that is no title, particle, initial or listed first name."""
    kept = rf"^(?:(?:{_TITLE}|\p{{Lu}})\.?|{_NAME}|{'|'.join(PARTICLES)}|[\s.]+)$"
    return (i == F.size(tokens) - 1) | ~t.rlike(kept)


def parts(kind: Column, value: Column) -> Column:
    """What of an entity gets a surrogate of its own: (value, kind) of its surnames, or of itself."""
    whole = F.array(F.struct(value.alias("value"), kind.alias("kind")))
    names = let(_tokens(value), lambda t: F.filter(t, lambda x, i: _is_surname(t, x, i)))
    return F.when(kind == "name", F.transform(names, lambda x: F.struct(x.alias("value"), F.lit("name").alias("kind")))).otherwise(whole)


def _others(values: list[str], key: str) -> Column:
    """A map of each value to another one, by a keyed order: no two share one, none keeps its own."""
    order = sorted(values, key=lambda v: sha256(f"{key}\x1f{v}".encode()).digest())
    return F.create_map(*[F.lit(x) for pair in zip(order, order[1:] + order[:1]) for x in pair])


def _name(value: Column, key: str, late: Column | None = None) -> Column:
    """Titles and particles kept; first names of the same gender and script, other initials, surnames of syllables.

    Surnames are entities of their own, so all mentions of a surname agree;
    first names and initials are exchanged one to one. So different names differ.
    """
    given = F.map_concat(*[_others(names, key) for names in _by_group().values()])
    initial = F.map_concat(_others([chr(c) for c in range(65, 91)], key), _others([chr(c) for c in range(0x410, 0x430)], key))

    def of(tokens: Column) -> Column:
        def one(t: Column, i: Column) -> Column:
            new = surrogate(F.lit("name"), t, F.lit(0), key)
            new = new if late is None else F.coalesce(F.try_element_at(late, t), new)
            letter = F.try_element_at(initial, F.substring(t, F.lit(1), F.lit(1)))
            short = F.when(t.rlike(r"^\p{Lu}\.?$"), F.concat(letter, F.substring(t, F.lit(2), F.lit(1))))
            return F.when(_is_surname(tokens, t, i), new).otherwise(F.coalesce(short, F.try_element_at(given, t), t))

        return F.array_join(F.transform(tokens, one), "")

    return let(_tokens(value), of)


def _by_group() -> dict[tuple[str, str], list[str]]:
    """First names by gender and script; a name of several groups counts for the first."""
    seen: set[str] = set()
    return {g: [n for n in names if not (n in seen or seen.add(n))] for g, names in FIRST.items()}


def _surname(value: Column, digest: Column, attempt: Column) -> Column:
    """Syllables of the same script, in capitals if the surname is."""

    def made(s: str) -> Column:
        options = F.array(*map(F.lit, SYLLABLES[s]))
        places = F.sequence(F.lit(0), 3 + F.floor(attempt / 2).cast("int"))
        return F.initcap(F.array_join(F.transform(places, lambda i: F.get(options, _byte(digest, i) % len(SYLLABLES[s]))), ""))

    new = F.when(value.rlike(r"\p{IsCyrillic}"), made("cyrillic")).otherwise(made("latin"))
    return F.when(value == F.upper(value), F.upper(new)).otherwise(new)


def _ipv6(value: Column, digest: Column, attempt: Column) -> Column:
    """Other digits in the same groups; a last part in the form of IPv4 is written in two groups."""
    bare = F.regexp_replace(value, _IPV4 + "$", "7f00:1")

    def one(c: Column, i: Column) -> Column:
        hexa = F.substring(F.lit("0123456789abcdef"), _byte(digest, i) % 16 + 1, F.lit(1))
        return F.when(c.rlike("^[0-9A-Fa-f]$"), hexa).otherwise(c)

    # short forms grow within the last group, then by groups
    long = F.concat(bare, F.when(bare.endswith(":"), "0").otherwise(""), F.repeat(F.lit(":0000"), F.floor(attempt / 2).cast("int")))
    return F.array_join(F.transform(F.split(F.when(attempt >= 2, long).otherwise(bare), "(?!^)(?!$)"), one), "")


def surrogate(kind: Column, value: Column, attempt: Column, key: str) -> Column:
    d = _digest(key, kind, value, attempt)

    def make(d: Column) -> Column:
        octet = lambda i, least, span: (least + _byte(d, F.lit(i)) % span).cast("string")
        at = F.instr(value, "@")
        host = F.substring(value, at, F.char_length(value))
        top = F.regexp_extract(value, r"(\.[A-Za-z]+)$", 1)
        local = _letters(_grown(F.substring(value, F.lit(1), at - 1), attempt), d, F.lit(0))
        long = _grown(value, attempt)
        # the domain changes too, but for its last part
        domain = _letters(F.substring(host, F.lit(1), F.char_length(host) - F.char_length(top)), F.reverse(d), F.lit(0))
        code = F.char_length(F.regexp_extract(value, r"^(\+\d{1,3}(?: ?\(0\))?)", 1))
        return (
            F.when(kind == "email", F.concat(local, domain, top))
            .when(kind == "ipv4", F.concat_ws(".", octet(0, 11, 200), octet(1, 0, 256), octet(2, 0, 256), octet(3, 1, 254), F.when(attempt >= 64, octet(4, 1, 254))))
            .when(kind == "phone", _letters(long, d, code))
            .when(kind == "card", _card(value, long, d))
            .when(kind == "iban", _iban(value, long, d))
            .when(kind == "secret", F.when(value.rlike("^[0-9a-f]+$"), F.substring(F.repeat(F.concat(F.reverse(d), d), F.ceil(F.char_length(value) / 512).cast("int")), F.lit(1), F.char_length(value))).otherwise(_letters(value, d, F.lit(4))))
            .when(kind == "name", _surname(value, d, attempt))
            .when(kind == "national", _letters(long, d, F.when(value.startswith("("), 2).otherwise(1)))
            .when(kind == "ipv6", _ipv6(value, d, attempt))
            .otherwise(_letters(long, d, F.lit(0)))
        )

    return let(d, make)  # of a name, this is the surrogate of a surname


def resolve(entities: DataFrame, key: str) -> DataFrame:
    """(value, surrogate) of all distinct entities, without collisions.

    An entity whose surrogate another one has, or which occurs as an entity
    itself, takes its next attempt; of those that share one, the least value
    keeps it. Surrogates grow with the attempts, so every form has free values;
    ends when nothing changes.
    """
    values = entities.select("value")
    taken = stage(entities.withColumn("attempt", F.lit(0)).withColumn("surrogate", surrogate(F.col("kind"), F.col("value"), F.lit(0), key)), "surrogates")
    while True:
        # settled entities first, so that a new attempt never takes what another one keeps
        rank = F.row_number().over(Window.partitionBy("surrogate").orderBy("attempt", "value"))
        real = values.select(F.col("value").alias("surrogate"), F.lit(True).alias("real"))
        counts = taken.groupBy("surrogate").count().where("count > 1").select("surrogate")
        bad = taken.join(counts, "surrogate", "left_semi").withColumn("rank", rank).where("rank > 1").select("value")
        bad = stage(bad.union(taken.join(real, "surrogate").select("value")).distinct(), "collisions")
        if bad.isEmpty():
            return taken.select("value", "surrogate", "attempt")
        moved = taken.join(bad, "value").withColumn("attempt", F.col("attempt") + 1)
        moved = moved.withColumn("surrogate", surrogate(F.col("kind"), F.col("value"), F.col("attempt"), key))
        taken = stage(taken.join(bad, "value", "left_anti").unionByName(moved), "surrogates")


def replace_entities(df: DataFrame, key: str = "surrogate-key", text: str = "text", counts: bool = False) -> DataFrame:
    """The same rows with every entity of ``text`` replaced; other columns pass through.

    Null texts stay null and empty ones empty; equal rows give equal rows. With
    ``counts``, ``n_entities`` is added, in place of a column of that name. The texts are scanned twice: for the distinct entities, and to
    replace them; entities that needed more than one attempt are joined by
    value, all others are derived again in place, so no text is shuffled.
    """
    found = F.regexp_extract_all(F.col(text), F.lit(ANY), F.lit(0))
    of_hit = lambda v: parts(kind_of(v), v)
    entities = df.select(F.explode(F.flatten(F.transform(found, of_hit))).alias("e")).select("e.value", "e.kind").distinct()
    # a surname may look like nothing else, but a value is resolved once
    resolved = resolve(stage(entities.dropDuplicates(["value"]), "entities"), key)
    late = stage(resolved.where("attempt > 0").select("value", "surrogate"), "late-surrogates")

    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), F.when(F.col(text).isNotNull(), found).alias("_hits"))
    # surnames of a text are found again where they stand alone
    names = F.array_distinct(F.flatten(F.transform(F.filter("_hits", lambda v: kind_of(v) == "name"), lambda v: F.transform(of_hit(v), lambda e: e["value"]))))
    rows = rows.withColumn("_names", F.when(F.size("_hits") > 0, names))
    longest = F.array_sort("_names", lambda a, b: F.coalesce(F.nullif(F.char_length(b) - F.char_length(a), F.lit(0)), F.when(a < b, -1).when(a > b, 1).otherwise(0)))
    alone = F.concat(F.lit(rf"{ANY}|(?<![\p{{L}}\p{{N}}])(?:"), F.array_join(longest, "|"), F.lit(r")(?![\p{L}\p{N}])"))
    rows = rows.withColumn("_any", F.when(F.size("_names") > 0, alone))
    body = F.col(f"_row.`{text}`")
    rows = rows.withColumn("_hits", F.when(F.col("_any").isNull(), F.col("_hits")).otherwise(F.regexp_extract_all(body, F.col("_any"), F.lit(0))))
    if late.isEmpty():
        rows = rows.withColumn("_late", F.lit(None).cast("map<string,string>"))
    else:
        # equal lists of entities share a map; rows without any get keys of their own
        rows = rows.withColumn("_k", F.when(F.size("_hits") > 0, F.xxhash64("_hits")).otherwise(F.xxhash64("_row")))
        values = F.array_distinct(F.transform(F.flatten(F.transform("_hits", of_hit)), lambda e: e["value"]))
        which = rows.select("_k", F.explode(values).alias("value")).join(late, "value")
        maps = which.groupBy("_k").agg(F.map_from_entries(F.collect_set(F.struct("value", "surrogate"))).alias("_late"))
        rows = rows.join(maps, "_k", "left")

    def new_of(v: Column) -> Column:
        other = F.coalesce(F.try_element_at("_late", v), let(kind_of(v), lambda k: surrogate(k, v, F.lit(0), key)))
        return F.when(kind_of(v) == "name", _name(v, key, F.col("_late"))).otherwise(other)

    rows = rows.withColumn("_new", F.transform("_hits", new_of))
    gaps = F.when(F.col("_any").isNull(), F.split(body, ANY, -1)).otherwise(F.split(body, F.col("_any"), -1))
    pieces = F.zip_with(gaps, "_new", lambda g, n: F.concat(g, F.coalesce(n, F.lit(""))))
    new = F.when(F.size("_new") > 0, F.array_join(pieces, "")).otherwise(body)
    out = [new.alias(c) if c == text else F.col(f"_row.`{c}`").alias(c) for c in df.columns if not (counts and c == "n_entities")]
    return rows.select(*out, *([F.greatest(F.size("_hits"), F.lit(0)).alias("n_entities")] if counts else []))

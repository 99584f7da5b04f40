"""Personal data: keyed surrogates that keep type, format, gender and script (operator 3, native).

Detection.  One pattern finds e-mail and IPv4 addresses, phone, card and social security numbers, access keys,
passwords and tokens after their name, and names after a title: up to five words, initials and particles, with
hyphens and apostrophes.  A text with such names is searched a second time, with its own names added to the
pattern, so that they are found without a title too.  A mention is a row of parts, each literal (a title,
``password=``, a particle) or an entity (kind, canonical form): digits alone for numbers, lower case for e-mail
and for each word of a name.  So one phone number in two notations, or a surname with and without a given
name, is one entity.  Its gender is what the titles before it as a given name agree on in the whole corpus.

Dictionary.  The distinct entities of the corpus get surrogates from a keyed SHA-256 of key, kind, attempt
and canonical form: each letter or digit is replaced within its class; cards keep their first digit and a right
check digit, addresses come from ranges that no one can own, names are made of syllables with endings
of the entity's gender in the mention's script.  A surrogate is taken only if it is no entity's canonical
form and no other entity of its kind has it; entities that lose try again with the next attempt, whose
surrogates grow from the ``WIDEN``-th on, so rounds end.  Distinct entities thus stay distinct.

Replacement.  Texts are split by the same pattern, and each mention is written again in its own
notation.  Only texts with a mention, once for each distinct text, take part in joins; texts without
one are never shuffled.  The entity table is pre-aggregated, and a very frequent entity's rows meet it in a
join that Spark can split.

Edge cases: null text stays null, empty text empty; overlapping matches go to the leftmost, then to the kind
listed first; repeated rows are replaced alike; an empty table gives an empty result; extra columns are ignored
(operator) or carried (stage, which also sets ``n_chars`` if the table has it).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C

KEY_CONF = "spark.lanwatch.surrogateKey"
DEFAULT_KEY = "change-me"
WIDEN = 6

# fixed values: titles with the gender they tell
FEMALE = ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "г-жа", "Κυρία"]
MALE = ["Mr", "Herr", "Monsieur", "Señor", "Sr", "г-н", "Κύριος"]
EITHER = ["Dr", "Prof"]

WORD = r"[\p{L}\p{N}_]"
TITLE = "|".join(FEMALE + MALE + EITHER)
PARTICLES = ["de", "da", "do", "dos", "das", "di", "del", "della", "der", "den", "des", "du", "la", "le", "las", "los", "y", "e",
             "van", "von", "vom", "zu", "zur", "ten", "ter", "bin", "ibn", "al", "el"]
PARTICLE = f"(?:{'|'.join(PARTICLES)})"
_JOINED = rf"(?:['’\-](?!s(?!{WORD}))[\p{{L}}\p{{M}}]+)"
#: one word of a name, or an initial
NAME = (rf"(?:(?:[dl]['’])?\p{{Lu}}(?:[\p{{L}}\p{{M}}]+{_JOINED}{{0,3}}|{_JOINED}{{1,3}})"
        r"|\p{Lu}\.|\p{Lu}(?= \p{Lu}\p{L}))")
#: more forms of phone numbers: + or 00 and a country, ten digits, a trunk 0 and groups
PHONES = [rf"\+[1-9](?:[ .\-/]?(?:\([0-9]{{1,4}}\)|[0-9])){{6,14}}(?!{WORD}|\.[0-9])",
          rf"00 ?[1-9](?:[ .\-/]?[0-9]){{7,12}}(?!{WORD}|\.[0-9])",
          rf"(?<![\-/])(?:1?[2-9]|0[1-9])[0-9]{{9}}(?!{WORD}|\.[0-9])",
          *[rf"0[1-9](?=(?:{sep}?[0-9]){{7,9}}(?!{sep}?[0-9]|{WORD}))[0-9]{{0,3}}(?:{sep}[0-9]{{2,8}}){{1,4}}(?!{WORD})" for sep in (" ", r"\.", r"\-")]]
#: kind -> pattern; the first that matches a place names it
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9._%+\-]{1,64}+@(?:[A-Za-z0-9\-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9\-])",
    "access": rf"(?<!{WORD})AKIA[0-9A-Z]{{16}}(?!{WORD})",
    "secret": r"(?i:password|passwd|token|secret|api[_\-]?key)\s{0,8}[=:]\s{0,8}[\"']?(?=[A-Za-z_\-+/]*[0-9])[0-9A-Za-z_\-+/]{8,}",
    "address": rf"(?<![\p{{L}}\p{{N}}_.])(?:[0-9]{{1,3}}\.){{3}}[0-9]{{1,3}}(?!{WORD}|\.[0-9])",
    "social": rf"(?<!{WORD})[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}(?!{WORD})",
    "card": rf"(?<!{WORD})[3-6](?:[0-9]{{12,18}}|[0-9]{{3}}(?:[ \-][0-9]{{4}}){{3}})(?!{WORD})",
    "phone": rf"(?<![\p{{L}}\p{{N}}_+.])(?:(?:\+?[0-9]{{1,3}}[ .\-]?)?(?:\([0-9]{{2,4}}\)[ .\-]?[0-9]{{3,4}}|[0-9]{{3}}[ .\-][0-9]{{3}})[ .\-][0-9]{{4}}(?!{WORD})"
             rf"|{'|'.join(PHONES)})",
    "person": rf"(?<!{WORD})(?:(?:{TITLE})\.?[ \n]){{1,3}}(?:{PARTICLE} ){{0,3}}{NAME}(?:(?:(?<=\.)| )(?:{PARTICLE} ){{0,3}}{NAME}){{0,4}}",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
# a text without any of these characters or titles has no mention
HINT = r"[@0-9]|" + "|".join(FEMALE + MALE + EITHER)

# syllables of surrogate names by script, and the endings by gender
SCRIPTS = {
    "latin": (r"\p{IsLatin}", ["ba", "de", "li", "mo", "nu", "ra", "se", "ti", "vo", "ka", "len", "mar", "nor", "sol", "ter", "win"], {"f": "a", "m": "o", "": "is"}),
    "cyrillic": (r"\p{IsCyrillic}", ["ба", "де", "ли", "мо", "ну", "ра", "се", "ти", "во", "ка", "лен", "мар", "нор", "сол", "тер", "вин"], {"f": "а", "m": "ов", "": "ко"}),
    "greek": (r"\p{IsGreek}", ["βα", "δε", "λι", "μο", "νυ", "ρα", "σε", "τι", "φο", "κα", "λεν", "μαρ", "νορ", "σολ", "τερ", "φιν"], {"f": "α", "m": "ος", "": "ης"}),
}


def _kind(m: Column) -> Column:
    """Kind of a whole match: the first pattern that matches all of it (look-around has nothing around)."""
    out = F.lit("person")
    for kind in reversed([k for k in PATTERNS if k != "person"]):
        out = F.when(F.rlike(m, F.lit(f"^(?:{PATTERNS[kind]})$")), kind).otherwise(out)
    return out


def _part(kind, canon, raw, gender="") -> Column:
    as_text = lambda x: F.lit(x).cast("string") if x is None or isinstance(x, str) else x
    return F.struct(as_text(kind).alias("kind"), as_text(canon).alias("canon"), as_text(raw).alias("raw"), as_text(gender).alias("gender"))


def _title(m: Column) -> Column:
    return F.regexp_extract(m, rf"^((?:(?:{TITLE})\.?[ \n])+)", 1)


def _name_words(m: Column) -> Column:
    """Words, initials and what separates them, of a person's mention without its title."""
    return F.regexp_extract_all(F.substr(m, F.length(_title(m)) + 1), F.lit(r"[ \-]+|[^ \-.]+\.?"), F.lit(0))


def _person(m: Column) -> Column:
    """Parts of a person's mention: each word an entity, titles, particles and separators literal."""
    title, words = _title(m), _name_words(m)
    says = lambda titles: F.rlike(title, F.lit(rf"(?:^|[ \n])(?:{'|'.join(titles)})\.?[ \n]"))
    gender = F.when(says(FEMALE) & ~says(MALE), "f").when(says(MALE) & ~says(FEMALE), "m").otherwise("")

    def one(t: Column, i: Column) -> Column:
        script = F.lit("latin")
        for s, (pattern, _, _) in SCRIPTS.items():
            script = F.when(F.rlike(t, F.lit(f"^{pattern}")), s).otherwise(script)
        initial = F.rlike(t, F.lit(r"^\p{Lu}\.?$"))
        literal = F.rlike(t, F.lit(r"^[ \-]+$")) | t.isin(PARTICLES)
        # a surname has no gender: what follows the last space is one
        given = F.exists(F.slice(words, i + 1, F.size(words)), lambda x: x.contains(" "))
        return _part(F.when(literal, F.lit(None)).otherwise(F.concat(F.when(initial, "initial-").otherwise("name-"), script, F.lit("-"))),
                     F.when(~literal, F.lower(t)), t, F.when(given, gender).otherwise(""))

    return F.concat(F.array(_part(None, None, title)), F.transform(words, one))


def _names(m: Column) -> Column:
    """The distinct words of the titled names among mentions, in the cases in which they may be written, longest first."""
    words = F.filter(F.flatten(F.transform(F.filter(m, lambda x: F.length(_title(x)) > 0), _name_words)),
                     lambda t: F.rlike(t, F.lit(r"^[\p{L}\p{M}'’]{2,}$")) & ~t.isin(PARTICLES))
    cases = F.array_distinct(F.flatten(F.transform(words, lambda t: F.array(t, F.upper(t), F.initcap(t)))))
    return F.transform(F.sort_array(F.transform(cases, lambda t: F.struct(F.length(t).alias("n"), t.alias("t"))), False), lambda x: x["t"])


def _parts(m: Column) -> Column:
    """The parts of one mention; literals have no kind."""
    kind = _kind(m)
    value = F.regexp_extract(m, r"([0-9A-Za-z_\-+/]{8,})$", 1)
    digits = F.regexp_replace(m, r"[^0-9]", "")
    return (F.when(kind == "person", _person(m))
            .when(kind == "secret", F.array(_part(None, None, F.substr(m, F.lit(1), F.length(m) - F.length(value))), _part(kind, value, value)))
            .when(kind.isin("card", "phone", "social"), F.array(_part(kind, digits, m)))
            .otherwise(F.array(_part(kind, F.when(kind == "email", F.lower(m)).otherwise(m), m))))


def _pick(alphabet: str, r: Column) -> Column:
    return F.substr(F.lit(alphabet), (F.pmod(r, F.lit(len(alphabet))) + 1).cast("int"), F.lit(1))


def surrogate(kind: Column, canon: Column, attempt: Column, key: str) -> Column:
    """The surrogate of one entity at one attempt; the digest is what depends on the key."""
    digest = F.sha2(F.concat_ws("\x1f", F.lit(key), kind, attempt.cast("string"), canon), 256)
    rand = lambda i: F.xxhash64(digest, i)
    more = F.greatest(F.lit(0), attempt - (WIDEN - 1))

    def mapped(text: Column, keep=None, letters="abcdefghijklmnopqrstuvwxyz") -> Column:
        def one(c, i):
            out = (F.when((c >= "0") & (c <= "9"), F.when((i < 2) & (c != "0"), _pick("23456789", rand(i))).otherwise(_pick("0123456789", rand(i))))
                   .when((c >= "a") & (c <= "z"), _pick(letters, rand(i)))
                   .when((c >= "A") & (c <= "Z"), _pick(letters.upper(), rand(i))).otherwise(c))
            return out if keep is None else F.when(keep(i), c).otherwise(out)
        return F.array_join(F.transform(F.split(text, ""), one), "")

    def wide(alphabet: str) -> Column:
        return F.array_join(F.transform(F.slice(F.sequence(F.lit(1), more + 1), F.lit(1), more), lambda i: _pick(alphabet, rand(i + 1000))), "")

    digits = wide("0123456789")
    hexes = F.rlike(canon, F.lit("^[0-9a-f]+$"))
    # e-mail: the last label becomes "example", which no one can register
    email = F.concat(wide("abcdefghijklmnopqrstuvwxyz"), mapped(F.regexp_extract(canon, r"^(.*)\.", 1)), F.lit(".example"))
    # IPv4: 240.0.0.0/4 belongs to no host
    octet = lambda i, low, n: (F.pmod(rand(F.lit(i)), F.lit(n)) + low).cast("string")
    address = F.concat_ws(".", octet(0, 240, 15), octet(1, 0, 256), octet(2, 0, 256), octet(3, 0, 256))
    body = F.concat(mapped(F.substr(canon, F.lit(1), F.length(canon) - 1), lambda i: i == 0), digits)
    n = F.length(body)
    luhn = F.aggregate(F.transform(F.split(body, ""), lambda c, i: F.when(
        (n - i) % 2 == 1, F.element_at(F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), c.cast("int") + 1)).otherwise(c.cast("int"))),
        F.lit(0), lambda a, x: a + x)
    card = F.concat(body, ((10 - luhn % 10) % 10).cast("string"))
    country = (F.length(canon) == 11) & canon.startswith("1")
    phone = F.concat(mapped(canon, lambda i: country & (i == 0)), digits)
    social = F.concat(F.lit("9"), F.substr(mapped(canon), F.lit(2)), digits)
    names = F.lit(None).cast("string")
    for s, (_, syllables, ends) in SCRIPTS.items():
        stem = F.array_join(F.transform(F.sequence(F.lit(1), 3 + more), _syllable(syllables, rand)), "")
        end = F.lit(ends[""])
        for g in ("f", "m"):
            end = F.when(kind.endswith(f"-{g}"), ends[g]).otherwise(end)
        names = F.when(kind.contains(f"-{s}-"), F.concat(stem, end)).otherwise(names)
    return (F.when(kind == "email", email).when(kind == "address", address).when(kind == "card", card)
            .when(kind == "phone", phone).when(kind == "social", social)
            .when(kind == "access", F.concat(F.lit("AKIA"), F.upper(F.substr(mapped(F.lower(canon)), F.lit(5))), F.upper(digits)))
            .when(kind == "secret", F.concat(F.when(hexes, mapped(canon, letters="abcdef")).otherwise(mapped(canon)), digits))
            .otherwise(names))


def _syllable(syllables: list[str], rand):
    table = F.array(*[F.lit(x) for x in syllables])
    return lambda i: F.element_at(table, (F.pmod(rand(i), F.lit(len(syllables))) + 1).cast("int"))


def _written(kind: Column, raw: Column, found: Column) -> Column:
    """The surrogate in the mention's notation."""
    chars = F.split(raw, "")
    is_digit = lambda c: (c >= "0") & (c <= "9")
    # digits are taken in order, separators stay; further digits follow at the end
    spread = F.aggregate(chars, F.struct(F.lit("").alias("out"), F.lit(1).alias("at")), lambda a, c: F.struct(
        F.concat(a["out"], F.when(is_digit(c), F.substr(found, a["at"], F.lit(1))).otherwise(c)).alias("out"),
        (a["at"] + is_digit(c).cast("int")).alias("at")))
    return (F.when(found.isNull(), raw)
            .when(kind.isin("card", "phone", "social"), F.concat(spread["out"], F.substr(found, spread["at"])))
            .when(kind.startswith("initial-"), F.concat(F.upper(F.substr(found, F.lit(1), F.lit(1))), F.substr(raw, F.lit(2))))
            .when(kind.contains("-"), F.when(raw == F.upper(raw), F.upper(found)).otherwise(F.initcap(found)))
            .when((kind == "email") & (raw == F.upper(raw)), F.upper(found))
            .otherwise(found))


def dictionary(entities: DataFrame, key: str) -> DataFrame:
    """(kind, canon, found): a surrogate for each distinct entity, distinct within its kind and no entity's own form."""
    # a gender holds if no mention tells the other; "f" < "m"
    told = F.when(F.col("gender") != "", F.col("gender"))
    real = C.staged(entities.groupBy("kind", "canon").agg(
        F.when(F.min(told) == F.max(told), F.min(told)).otherwise("").alias("gender")), "entities")
    taken, left, attempt = None, real, 0
    while True:
        tried = C.staged(left.withColumn("found", surrogate(F.concat("kind", "gender"), F.col("canon"), F.lit(attempt), key)), "tried")
        # one entity for each surrogate; equality is judged without case, as mentions are
        first = tried.groupBy("kind", F.lower("found").alias("low")).agg(F.min(F.struct("canon", "found")).alias("x"))
        won = first.select("kind", "x.canon", "x.found", "low").join(
            real.select("kind", F.lower("canon").alias("low")).distinct(), ["kind", "low"], "left_anti")
        if taken is not None:
            won = won.join(taken.select("kind", F.lower("found").alias("low")), ["kind", "low"], "left_anti")
        won = C.staged(won.select("kind", "canon", "found"), "won")
        taken = won if taken is None else taken.union(won)
        left = C.staged(tried.drop("found").join(won, ["kind", "canon"], "left_anti"), "left")
        if left.isEmpty():
            return taken
        attempt += 1


def _digest(t: str) -> Column:
    return F.struct(F.xxhash64(t).alias("a"), F.xxhash64(F.lit(1), t).alias("b"), F.length(t).alias("n"))


def _replaced(texts: DataFrame, key: str) -> DataFrame:
    """(id, new, n) for each distinct text that has a mention; ``texts`` has one column, text."""
    own = F.concat(F.lit(rf"{ANY}|(?<!{WORD})(?:"), F.array_join(_names(F.col("m")), "|"), F.lit(rf")(?!{WORD})"))
    titled = F.exists("m", lambda x: F.length(_title(x)) > 0)
    mentions = (texts.filter(F.rlike("text", F.lit(HINT)))
                .withColumn("m", F.regexp_extract_all("text", F.lit(ANY), F.lit(0))).filter(F.size("m") > 0)
                # a text's own names are found without a title too
                .withColumn("own", F.when(titled & (F.size(_names(F.col("m"))) > 0), own))
                .select(_digest("text").alias("id"),
                        F.when(F.col("own").isNull(), F.split("text", ANY)).otherwise(F.split("text", F.col("own"))).alias("pieces"),
                        F.when(F.col("own").isNull(), F.col("m")).otherwise(F.regexp_extract_all("text", F.col("own"), F.lit(0))).alias("m"))
                .groupBy("id").agg(F.first("pieces").alias("pieces"), F.first("m").alias("m")))
    mentions = C.staged(mentions.withColumn("parts", F.transform("m", _parts)).drop("m"), "mentions")
    parts = (mentions.select("id", F.posexplode("parts").alias("i", "p"))
             .select("id", "i", F.posexplode("p").alias("k", "x")).select("id", "i", "k", "x.kind", "x.canon", "x.raw", "x.gender"))
    known = dictionary(parts.filter("kind is not null").select("kind", "canon", "gender"), key)
    # each part brings the piece of text before its mention; a text's parts are bounded by the text
    written = (parts.join(known, ["kind", "canon"], "left")
               .select("id", "i", "k", _written(F.col("kind"), F.col("raw"), F.col("found")).alias("w"))
               .groupBy("id").agg(F.array_sort(F.collect_list(F.struct("i", "k", "w"))).alias("w")))
    return C.staged(written.join(mentions.select("id", "pieces"), "id").select(
        "id", F.concat(F.array_join(F.transform("w", lambda x: F.concat(
            F.when(x["k"] == 0, F.get("pieces", x["i"])).otherwise(""), x["w"])), ""), F.element_at("pieces", -1)).alias("new"),
        (F.size("pieces") - 1).alias("n")), "replaced")


def _apply(rows: DataFrame, key: str | None) -> DataFrame:
    """``rows`` has ``text``; add ``new`` and ``n``, the text after replacement and its number of mentions."""
    spark = rows.sparkSession
    changed = _replaced(rows.select("text"), key or spark.conf.get(KEY_CONF, DEFAULT_KEY))
    has = F.coalesce(F.rlike("text", F.lit(HINT)) & F.rlike("text", F.lit(ANY)), F.lit(False))
    with_any = rows.filter(has).withColumn("id", _digest("text")).join(changed, "id").drop("id")
    return rows.filter(~has).select("*", F.col("text").alias("new"), F.lit(0).alias("n")).unionByName(with_any)


def replace_personal_data(docs: DataFrame, key: str | None = None) -> DataFrame:
    """doc_id, the text with surrogates, and how many mentions were replaced, for every row of ``docs``."""
    return _apply(docs.select("doc_id", "text"), key).select("doc_id", F.col("new").alias("text"), F.col("n").cast("long").alias("n_replaced"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every row of ``docs`` with its text replaced."""
    out = _apply(C.packed(docs, "text"), None)
    new = F.col("_row").withField("text", F.col("new"))
    if "n_chars" in docs.columns:
        new = new.withField("n_chars", F.length("new").cast(docs.schema["n_chars"].dataType))
    return out.select(new.alias("_row")).select("_row.*")

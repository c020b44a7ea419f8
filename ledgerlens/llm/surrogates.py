"""Personal data replaced by keyed surrogates of the same type and format. DataFrame functions only.

Entities are e-mail addresses, payment cards, IPv4 addresses, social-security and phone numbers, and names after a form
of address; of a name found so, mentions without one in the same text count too, as written or in capitals. Parts of a
name alone do not. A surrogate is a function of a secret key, the entity's type and its canonical form (digits of a
number, lower-cased address, lower-cased name), so one entity gets the same surrogate everywhere, in the format of each
occurrence: separators, length, letter case and script stay, cards pass the check-digit test, octets stay below 256.
Names end by the gender that most occurrences in the corpus have by their form of address; none if it is even.

Two checks over the whole corpus keep entities distinct: no two entities may share a surrogate and no surrogate may be
an entity that occurs. The domains of e-mail addresses are entities of their own in this. Those that clash
(``exceptions``) draw again with the next attempt number until none is left; if there are none, the inline surrogates
stand. A domain that clashes ``LONGER`` times gets four more letters, since short ones may all be taken. Null texts count
as empty. Rows with equal or null ``doc_id`` are all kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.spans import found, gaps, starts
from ledgerlens.session import shared_folder

# Forms of address by gender, and name endings by gender for Latin and Cyrillic script.
MALE = ("Mr", "Sir", "Herr", "Señor", "Sr", "Monsieur", "Don", "Господин")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Señora", "Sra", "Madame", "Mme", "Doña", "Госпожа")
ANY = ("Dr", "Prof")
ADDRESS = rf"^({'|'.join((*MALE, *FEMALE, *ANY))})\.?\x20"
LONGER = 8
LATIN = ("ba", "ca", "da", "fe", "ga", "he", "ja", "ke", "lo", "mi", "no", "pe", "ra", "so", "ti", "ve")
CYRILLIC = ("ба", "ва", "го", "де", "жа", "зи", "ко", "ла", "ми", "но", "па", "ро", "со", "ти", "фа", "ше")

NAME = rf"(?<![\p{{L}}])(?:{'|'.join((*MALE, *FEMALE, *ANY))})\.?\x20\p{{Lu}}\p{{Ll}}+(?:\x20\p{{Lu}}\p{{Ll}}+)?"
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
IP = rf"(?<![0-9.])(?:{OCTET}\.){{3}}{OCTET}(?![0-9]|\.[0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
CARD = r"(?<![A-Za-z0-9])(?:[0-9]{4}[\x20-]){3}[0-9]{1,7}(?![A-Za-z0-9])|(?<![A-Za-z0-9])[0-9]{13,19}(?![A-Za-z0-9])"
PHONE = (r"(?<![A-Za-z0-9])(?:\+[0-9]{1,3}[\x20.-]?)?(?:\([0-9]{2,4}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}"
         r"(?![A-Za-z0-9])|(?<![A-Za-z0-9])\+[0-9]{1,3}(?:[\x20.-]?[0-9]{2,4}){2,4}(?![A-Za-z0-9])")
TYPES = {"email": EMAIL, "ip": IP, "ssn": SSN, "card": CARD, "phone": PHONE, "name": NAME}
ENTITY = "|".join(f"(?:{p})" for p in TYPES.values())


def type_of(value: Column) -> Column:
    """Type of a match: the first pattern that fits all of it."""
    out = F.lit("name")
    for kind in reversed([k for k in TYPES if k != "name"]):
        out = F.when(value.rlike(f"^(?:{TYPES[kind]})$"), F.lit(kind)).otherwise(out)
    return out


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def canonical(kind: Column, value: Column) -> Column:
    """What makes two occurrences the same entity."""
    return (F.when(kind.isin("ssn", "card", "phone"), _digits(value))
            .when(kind == "name", F.lower(F.regexp_replace(value, ADDRESS, "")))
            .otherwise(F.lower(value)))


def gender_of(value: Column) -> Column:
    """``f``, ``m`` or nothing by the form of address; null without one."""
    word = F.regexp_extract(value, ADDRESS, 1)
    return F.when(word.isin(*FEMALE), F.lit("f")).when(word.isin(*MALE), F.lit("m")).when(word != "", F.lit(""))


def domain_of(address: Column) -> Column:
    return F.substring_index(address, "@", -1)


def mentions(names: Column) -> Column:
    """A pattern of entities and of these names without a form of address, as written or in capitals."""
    forms = F.array_distinct(F.concat(names, F.transform(names, F.upper)))
    longest = F.array_sort(forms, lambda a, b: F.length(b) - F.length(a))
    return F.concat(F.lit(ENTITY + r"|(?<![\p{L}\p{M}\p{N}])(?=\p{Lu})(?:"), F.array_join(longest, "|"),
                    F.lit(r")(?![\p{L}\p{M}\p{N}])"))


def _stream(key: str, kind: Column, of: Column, attempt: Column) -> Column:
    """128 keyed hexadecimal digits."""
    seed = F.concat_ws("\x1f", F.lit(key), kind, of, attempt.cast("string"))
    return F.sha2(seed, 512)


def _draw(stream: Column, place: Column, choices: str | tuple[str, ...]) -> Column:
    """One of the choices by two digits of the stream; places beyond its end begin again, offset by one."""
    at = F.pmod(place * 2, F.lit(126)) + F.pmod(F.floor(place / 63).cast("int"), F.lit(2)) + 1
    number = F.conv(F.substr(stream, at.cast("int"), F.lit(2)), 16, 10).cast("int")
    options = F.array(*[F.lit(c) for c in choices])
    return F.element_at(options, F.pmod(number, F.lit(len(choices))) + 1)


def _shaped(value: Column, stream: Column, keep: int = 0) -> Column:
    """The value with each digit and letter drawn anew, in its case; the first ``keep`` characters stay."""
    chars = F.transform(F.split(value, ""), lambda c, i: F.when(i < keep, c)
                        .when(c.rlike("^[0-9]$"), _draw(stream, i, "0123456789"))
                        .when(c.rlike("^[a-z]$"), _draw(stream, i, "abcdefghijklmnopqrstuvwxyz"))
                        .when(c.rlike("^[A-Z]$"), _draw(stream, i, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
                        .otherwise(c))
    return F.concat_ws("", chars)


def _luhn(digits: Column) -> Column:
    """A number with its last digit set so that the check-digit test passes."""
    body = F.reverse(F.substr(digits, F.lit(1), F.length(digits) - 1))
    doubled = lambda c, i: F.when(i % 2 == 0, F.when(c.cast("int") > 4, c.cast("int") * 2 - 9)
                                  .otherwise(c.cast("int") * 2)).otherwise(c.cast("int"))
    total = F.aggregate(F.transform(F.split(body, ""), doubled), F.lit(0), lambda a, x: a + x)
    last = F.pmod(F.lit(10) - F.pmod(total, F.lit(10)), F.lit(10))
    return F.concat(F.substr(digits, F.lit(1), F.length(digits) - 1), last.cast("string"))


def _poured(value: Column, digits: Column) -> Column:
    """Digits put into the places of the value's digits."""
    nothing = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))
    return F.aggregate(
        F.split(value, ""), nothing,
        lambda a, c: F.when(c.rlike("^[0-9]$"), F.struct(
            F.concat(a["out"], F.substr(digits, a["at"], F.lit(1))).alias("out"), (a["at"] + 1).alias("at")))
        .otherwise(F.struct(F.concat(a["out"], c).alias("out"), a["at"].alias("at"))),
        lambda a: a["out"])


def _domain(key: str, domain: Column, attempt: Column) -> Column:
    """A domain's surrogate, shared by all addresses of that domain; its last label stays."""
    stream = _stream(key, F.lit("domain"), domain, attempt)
    more = F.concat(*[_draw(stream, F.lit(50 + k), "abcdefghijklmnopqrstuvwxyz") for k in range(4)])
    return F.concat(_shaped(F.regexp_replace(domain, r"\.[^.]+$", ""), stream),
                    F.when(attempt >= LONGER, more).otherwise(F.lit("")), F.regexp_extract(domain, r"(\.[^.]+)$", 1))


def canonical_surrogate(key: str, kind: Column, entity: Column, attempt: Column, gender: Column | None = None,
                        domain_attempt: Column | None = None) -> Column:
    """Surrogate of an entity's canonical form, a name with its ending. Country codes of phones and the issuer digit of
    cards stay."""
    gender = F.lit("") if gender is None else gender
    domain_attempt = F.lit(0) if domain_attempt is None else domain_attempt
    stream = _stream(key, kind, entity, attempt)
    longer = F.concat(*[_draw(stream, F.lit(50 + k), "abcdefghijklmnopqrstuvwxyz") for k in range(4)])
    email = F.concat(_shaped(F.substring_index(entity, "@", 1), stream),
                     F.when(attempt >= LONGER, longer).otherwise(F.lit("")), F.lit("@"), _domain(key, domain_of(entity), domain_attempt))
    short = lambda o, n: (F.length(o) == n) & (attempt < LONGER)
    octets = F.transform(F.split(entity, r"\."), lambda o, i: F.when(short(o, 1), _draw(stream, i, "123456789"))
                         .when(short(o, 2), F.concat(_draw(stream, i, "123456789"),
                                                          _draw(stream, i + 8, "0123456789")))
                         .otherwise(F.concat(F.lit("1"), _draw(stream, i + 4, "0123456789"),
                                             _draw(stream, i + 8, "0123456789"))))
    return (F.when(kind == "email", email).when(kind == "domain", _domain(key, entity, attempt))
            .when(kind == "ip", F.concat_ws(".", octets))
            .when(kind == "card", _luhn(_shaped(entity, stream, 1)))
            .when(kind == "phone", F.concat(F.substr(entity, F.lit(1), F.greatest(F.length(entity) - 10, F.lit(0))),
                                            _shaped(F.substr(entity, F.greatest(F.length(entity) - 9, F.lit(1)),
                                                            F.lit(10)), stream)))
            .when(kind == "ssn", _shaped(entity, stream))
            .otherwise(_name(entity, stream, gender)))


def _name(entity: Column, stream: Column, gender: Column) -> Column:
    """Lower-cased names of four drawn syllables for each part, in the script of the part. The first ends in the vowel
    that female names end in, in a consonant for male ones, as drawn for others."""
    cyrillic = entity.rlike(r"\p{IsCyrillic}")
    ending = (F.when(gender == "f", F.when(cyrillic, F.lit("а")).otherwise(F.lit("a")))
              .when(gender == "m", F.when(cyrillic, F.lit("н")).otherwise(F.lit("n"))).otherwise(F.lit("")))
    part = lambda word, i: F.concat(*[F.when(
        word.rlike(r"\p{IsCyrillic}"), _draw(stream, i * 8 + k, CYRILLIC)).otherwise(_draw(stream, i * 8 + k, LATIN))
        for k in range(4)])
    return F.concat_ws(" ", F.transform(F.split(entity, " "), lambda word, i: F.when(
        i == 0, F.concat(part(word, i), ending)).otherwise(part(word, i))))


def _named(value: Column, made: Column) -> Column:
    """The form of address stays, if there is one; a name in capitals stays in capitals."""
    bare = F.regexp_replace(value, ADDRESS, "")
    return F.concat(F.regexp_extract(value, ADDRESS, 0), F.when(bare == F.upper(bare), F.upper(made)).otherwise(
        F.initcap(made)))


def occurrence(kind: Column, value: Column, made: Column) -> Column:
    """The surrogate in the format of one occurrence."""
    cased = F.when(value.rlike("[A-Z]") & ~value.rlike("[a-z]"), F.upper(made)).otherwise(made)
    return (F.when(kind.isin("card", "phone", "ssn"), _poured(value, made))
            .when(kind == "name", _named(value, made)).otherwise(cased))


STATE = ("kind", "entity", "gender", "mixed", "domain_attempt", "attempt")


def exceptions(entities: DataFrame, key: str, rounds: int = 20) -> DataFrame | None:
    """``kind, entity, attempt, gender`` of distinct entities, domains among them, whose first surrogate clashes or
    whose occurrences (rows of ``kind, entity`` and, for names, ``gender``) differ in gender; None if there are none.

    Every round redraws for all but the first of the entities that share a surrogate, and for those whose surrogate is
    an entity itself. Where real entities fill a format (one-letter mailboxes, one-digit addresses), an entity that has
    clashed ``LONGER`` times gets a longer surrogate: four more letters in a mailbox or domain, three digits an octet."""
    gender = F.col("gender") if "gender" in entities.columns else F.lit(None).cast("string")
    state = entities.groupBy("kind", "entity").agg(*[F.count(F.when(gender == g, 1)).alias(g) for g in ("f", "m")],
                                                   F.count(F.lit(1)).alias("n"))
    most = F.greatest("f", "m")
    state = state.select(
        "kind", "entity", F.when(F.col("f") > F.col("m"), "f").when(F.col("m") > F.col("f"), "m").otherwise("").alias(
            "gender"), ((most > 0) & (most < F.col("n"))).alias("mixed"), F.lit(0).alias("domain_attempt"),
        F.lit(0).alias("attempt")).checkpoint()
    domains = state.where("kind = 'email'").select(domain_of(F.col("entity")).alias("entity")).distinct()
    domains = _settled(domains.selectExpr("'domain' as kind", "entity", "'' as gender", "false as mixed",
                                          "0 as domain_attempt", "0 as attempt"), key, rounds)
    moved = domains.where("attempt > 0")
    if not moved.isEmpty():
        of = moved.select(F.col("entity").alias("domain"), F.col("attempt").alias("moved"))
        emails = state.where("kind = 'email'").withColumn("domain", domain_of(F.col("entity"))).join(of, "domain", "left")
        state = state.where("kind <> 'email'").union(
            emails.withColumn("domain_attempt", F.coalesce("moved", F.lit(0))).select(*STATE))
    changed = _settled(state, key, rounds).where("attempt > 0 or mixed").union(moved)
    changed = changed.select("kind", "entity", "attempt", "gender")
    return None if changed.isEmpty() else changed


def _settled(state: DataFrame, key: str, rounds: int) -> DataFrame:
    """The rows of ``STATE`` with attempts that leave no clash."""
    for _ in range(rounds):
        made = state.withColumn("made", canonical_surrogate(
            key, *[F.col(c) for c in ("kind", "entity", "attempt", "gender", "domain_attempt")]))
        shared = made.groupBy("kind", "made").agg(F.count(F.lit(1)).alias("n"), F.min("entity").alias("first"))
        shared = shared.where("n > 1").select("kind", "made", "first")
        real = state.select("kind", F.col("entity").alias("made"), F.lit(True).alias("real"))
        judged = made.join(shared, ["kind", "made"], "left").join(real, ["kind", "made"], "left")
        clash = F.coalesce(F.col("entity") != F.col("first"), F.lit(False)) | F.coalesce(F.col("real"), F.lit(False))
        judged = judged.select(*STATE[:-1], (F.col("attempt") + clash.cast("int")).alias("attempt"),
                               clash.alias("clash")).checkpoint()
        state = judged.select(*STATE)
        if judged.where("clash").isEmpty():
            return state
    raise ValueError("surrogates still clash; the type has too few of them")


def matched(rows: DataFrame) -> DataFrame:
    """``rows`` with ``_names``, the names found by a form of address, and ``_found``, a structure of each match."""
    first = F.when(F.col("text").rlike(ENTITY), found(F.col("text"), ENTITY)).otherwise(
        F.array().cast("array<string>"))
    rows = rows.withColumn("_first", first)
    rows = rows.withColumn("_names", F.array_distinct(F.transform(
        F.filter("_first", lambda v: v.rlike(ADDRESS)), lambda v: F.regexp_replace(v, ADDRESS, ""))))
    every = F.when(F.size("_names") > 0, F.regexp_extract_all("text", mentions(F.col("_names")), F.lit(0))).otherwise(
        F.col("_first"))
    typed = F.transform(every, lambda v: F.struct(type_of(v).alias("kind"), v.alias("value")))
    told = F.transform(typed, lambda t: F.struct(
        t["kind"].alias("kind"), canonical(t["kind"], t["value"]).alias("entity"), t["value"].alias("value"),
        F.when(t["kind"] == "name", gender_of(t["value"])).alias("gender")))
    rows = rows.withColumn("_told", told)
    titled = F.filter("_told", lambda x: x["gender"].isNotNull())
    rows = rows.withColumn("_titled", titled)
    # a mention without a form of address has the gender of the name it repeats
    heard = F.transform("_told", lambda f: F.when((f["kind"] == "name") & f["gender"].isNull(), F.struct(
        f["kind"].alias("kind"), f["entity"].alias("entity"), f["value"].alias("value"), F.get(F.filter(
            "_titled", lambda x: x["entity"] == f["entity"]), F.lit(0))["gender"].alias("gender"))).otherwise(f))
    return rows.withColumn("_found", F.when(F.size("_names") > 0, heard).otherwise(F.col("_told"))).drop(
        "_first", "_told", "_titled")


def replace(docs: DataFrame, key: str) -> DataFrame:
    """``doc_id, text, n_entities, entities`` of each row: the text with surrogates, and the replaced spans of the
    input as ``type:start:end`` in code points. A text without entities comes back as it is."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = matched(docs.select(F.col("doc_id"), text.alias("text")))
    path = shared_folder(docs.sparkSession, "surrogates")
    occurring = rows.select("doc_id", F.xxhash64("text").alias("_key"), F.explode_outer("_found").alias("f"))
    occurring.where("f is not null").select("doc_id", "_key", "f.kind", "f.entity", "f.gender").write.option(
        "compression", "zstd").parquet(path)
    occurring = docs.sparkSession.read.schema(
        f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, _key long, kind string, entity string, gender string"
    ).parquet(path)
    changed = exceptions(occurring.select("kind", "entity", "gender"), key)
    if changed is None:
        rows = rows.withColumn("_attempts", F.lit(None).cast("map<string,struct<attempt:int,gender:string>>"))
    else:
        ids = occurring.select("doc_id", "_key", "kind", "entity")
        ids = ids.union(ids.where("kind = 'email'").select(
            "doc_id", "_key", F.lit("domain"), domain_of(F.col("entity"))))
        per_row = (ids.join(changed, ["kind", "entity"]).groupBy(F.col("doc_id").alias("_id"), "_key")
                   .agg(F.map_from_entries(F.collect_set(F.struct(
                       F.concat_ws("\x1f", "kind", "entity"), F.struct("attempt", "gender")))).alias("_attempts")))
        same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_key"))
        rows = rows.join(per_row, same, "left").drop("_id", "_key")
    settled = lambda kind, entity: F.col("_attempts")[F.concat_ws("\x1f", kind, entity)]
    drawn = F.transform("_found", lambda f: F.struct(
        f["kind"].alias("kind"), f["entity"].alias("entity"), f["value"].alias("value"),
        F.coalesce(settled(f["kind"], f["entity"])["attempt"], F.lit(0)).alias("attempt"),
        F.coalesce(settled(f["kind"], f["entity"])["gender"], f["gender"], F.lit("")).alias("gender"),
        F.coalesce(settled(F.lit("domain"), domain_of(f["entity"]))["attempt"], F.lit(0)).alias("domain_attempt")))
    made = F.transform(drawn, lambda f: occurrence(f["kind"], f["value"], canonical_surrogate(
        key, f["kind"], f["entity"], f["attempt"], f["gender"], f["domain_attempt"])))
    rows = rows.withColumn("_between", F.when(F.size("_names") > 0, F.split(
        "text", mentions(F.col("_names")), -1)).otherwise(gaps(F.col("text"), ENTITY)))
    between = F.col("_between")
    woven = F.concat(F.element_at(between, 1), F.concat_ws("", F.transform(
        F.arrays_zip(made.alias("made"), F.slice(between, 2, F.size("_found")).alias("gap")),
        lambda x: F.concat(x["made"], x["gap"]))))
    whole = F.size("_found") > 0
    places = starts(between, F.transform("_found", lambda f: f["value"]))
    spans = F.transform(F.arrays_zip(places.alias("at"), F.col("_found").alias("f")), lambda x: F.concat_ws(
        ":", x["f"]["kind"], x["at"].cast("string"), (x["at"] + F.length(x["f"]["value"])).cast("string")))
    return rows.select(
        "doc_id", F.when(whole, woven).otherwise(F.col("text")).alias("text"),
        F.size("_found").cast("long").alias("n_entities"),
        F.when(whole, F.concat_ws(",", spans)).otherwise(F.lit("")).alias("entities"))

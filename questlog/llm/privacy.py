"""PII surrogates with DataFrame functions only.

Detected entities (e-mail addresses, phone and card numbers, IP addresses,
account and social security numbers, secrets, titled names) are replaced by
keyed surrogates of the same type and format: digits stay digits, letters keep
their case and script, a valid card number stays valid, an address octet stays
an octet, a name keeps the gender its title tells. Given names are entities of
their own, by gender. A surrogate depends on the
key and the entity's canonical form (case, spaces and separators don't count),
so mentions of one entity agree wherever they stand. Over all distinct entities
surrogates are checked for collisions, with each other and with the originals,
and drawn anew until each entity has its own.

The full names and surnames that a text's titled names give are replaced
wherever else they stand in that text, without a title too. A name is replaced as a
whole: up to two given names, initials, particles (kept, as ``de`` or ``von``), and a surname with its hyphens,
apostrophes and inner capitals.

Texts are cut into mentions and what lies between them once; both are written, and all later steps
read them. Texts without an entity pass by with no shuffle. Mentions are gathered once for
each distinct text that has any, so copies cost one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import table, written

KEY = "questlog"
ATTEMPTS = 16
# From this attempt on a surrogate is lengthened: its format alone has too few values.
LENGTHEN = 8
# Copies of a text's replacements on the way to its documents: spreads a text that many documents share.
SALTS = 8

# The detectors, in the order in which they are tried.
MALE = "Mr|Herr|Señor|Sr|Sir|Г-н|г-н|Κύριος"
FEMALE = "Mrs|Ms|Mme|Mlle|Frau|Señora|Sra|Madam|Г-жа|г-жа|Κυρία"
NEUTRAL = r"Dr|Dra|Doctor|Prof|Professor|(?<![.\p{L}])M(?=\. )"
# The particles of surnames.
PARTICLE = "de|del|della|di|da|dos|du|la|le|van|von|der|den|ter|zu"
# A word of a name: hyphens, apostrophes and inner capitals are part of it.
WORD = r"\p{Lu}(?:\p{Ll}|['’-](?=\p{Lu}\p{Ll})|(?<=[\p{Ll}'’-])\p{Lu}(?=\p{Ll}))+"
SURNAME = rf"(?:(?:{PARTICLE}) |[dl]['’]){{0,3}}{WORD}"
TITLE = rf"(?:{MALE}|{FEMALE}|{NEUTRAL})\.? "
DETECTORS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]{1,64}@[\p{L}\p{N}-]{1,63}(?:\.[\p{L}\p{N}-]{1,63}){1,8}",
    "secret": r"(?<!\p{L})(?i:token|secret|password|passwd|api[_-]?key|access[_-]?key)[\"']? ?[:=] ?[\"']?[A-Za-z0-9_+/.-]{8,}",
    "key": r"(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{30,}|sk-[A-Za-z0-9_-]{20,}|[0-9a-f]{40}|[0-9a-f]{32})(?![A-Za-z0-9])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ip": r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]{1,2})\.){3}(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]{1,2})(?![0-9])",
    "phone": r"(?<![A-Za-z0-9+])(?:\+1[ .-]?\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4}|\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}"
    r"|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4})(?![0-9])",
    "card": r"(?<![A-Za-z0-9])(?:[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{13,19})(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "name": rf"(?<!\p{{L}}){TITLE}(?:{WORD} )?(?:\p{{Lu}}\. ?){{0,3}}(?:{WORD} )?{SURNAME}",
}
# The surname's own word at the end of a name, and the given names and initials before it.
LAST = rf"(?:^|[ .]|[dl]['’])({WORD})$"
GIVEN = rf"{WORD}|\p{{Lu}}(?=\.)"
# Stands around mentions while a text is cut (texts that hold it are cut without it).
MARK = "\ue000"
# Country codes of one and of two digits; all others have three.
COUNTRY = "^(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
ANY = "|".join(f"(?:{p})" for p in DETECTORS.values())
# What a text must have for any detector to match: quick to look for.
HINT = rf"[0-9@]|sk-|gh[pousr]_|AKIA|[0-9a-f]{{32}}|(?i:token|secret|password|passwd|key)[\"']? ?[:=]|(?:{MALE}|{FEMALE}|{NEUTRAL})[. ]"

# Letters a surrogate letter is drawn from, by script.
LETTERS = (
    ("a-z", "abcdefghijklmnopqrstuvwxyz"),
    ("A-Z", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("à-öø-ÿ", "àáâäçèéêëíîïñóôöùúûü"),
    ("À-ÖØ-Þ", "ÀÁÂÄÇÈÉÊËÍÎÏÑÓÔÖÙÚÛÜ"),
    ("а-яё", "абвгдежзиклмнопрстуфхцчшэюя"),
    ("А-ЯЁ", "АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЭЮЯ"),
    ("α-ωά-ώ", "αβγδεζηθικλμνξοπρστυφχψω"),
    ("Α-ΩΆ-Ώ", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ"),
)
# Consonants, vowels, and the endings of male, female and other first names, by script.
SYLLABLES = {
    "а": ("бвгдзклмнпрст", "аеиоу", "ин", "на", "ей"),
    "α": ("βγδζκλμνπρστ", "αειου", "ος", "να", "ης"),
    "a": ("bdfgklmnprstvz", "aeiou", "on", "na", "el"),
}


def kind_of(raw: Column) -> Column:
    """The type of a mention: the first detector that matches all of it."""
    out = F.lit("name")
    for kind, p in reversed(list(DETECTORS.items())):
        # a mention stands alone here, so what the detector wants around it is met
        out = F.when(raw.rlike(f"^(?:{p})$"), kind).otherwise(out)
    return out


DIGIT_KINDS = ("phone", "card", "ssn")


def canonical(kind: str, raw: str) -> str:
    """SQL: the form in which mentions of one entity agree."""
    digits = f"regexp_replace({raw}, '[^0-9]', '')"
    return f"""case
        when {kind} = 'phone' then case
            when {digits} rlike '^1[0-9]{{10}}$' then substr({digits}, 2)
            when startswith({raw}, '+') then concat('+', {digits}) else {digits} end
        when {kind} in ('card', 'ssn') then {digits}
        when {kind} = 'iban' then replace({raw}, ' ', '')
        when {kind} = 'secret' then regexp_extract({raw}, '[A-Za-z0-9_+/.-]{{8,}}$', 0)
        when {kind} = 'email' then lower({raw})
        else {raw} end"""


def stream(key: str, what: str, length: str) -> str:
    """SQL: a keyed hexadecimal string with two digits for each of ``length`` places."""
    return f"array_join(transform(sequence(0, cast({length} / 32 as int)), b -> sha2(concat_ws('|', '{key}', {what}, b), 256)), '')"


def drawn(place: str, letters: str) -> str:
    """SQL: the letter of ``letters`` that the stream ``h`` gives at ``place`` (from 1)."""
    return f"substr('{letters}', cast(conv(substr(h, 2 * ({place}) - 1, 2), 16, 10) as int) % {len(letters)} + 1, 1)"


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """``entities`` (kind, entity, attempt) with a drawn ``surrogate``."""
    cases = " ".join(f"when c rlike '[{span}]' then {drawn('i + 1', letters)}" for span, letters in LETTERS)
    code = f"case when substr(entity, 2) rlike '{COUNTRY}' then length(regexp_extract(substr(entity, 2), '{COUNTRY}', 0)) else 3 end"
    keep_first = f"case when kind = 'card' then 1 when kind = 'iban' then 2 when kind = 'phone' and startswith(entity, '+') then 1 + {code} else 0 end"
    keep_last = "case when kind = 'email' then length(regexp_extract(entity, '[.][^.]*$', 0)) else 0 end"
    prefix = "length(regexp_extract(entity, '^(?:AKIA|gh[pousr]_|sk-)', 0))"
    by_class = f"""array_join(transform(filter(split(entity, ''), c -> c <> ''), (c, i) -> case
        when i < greatest({keep_first}, {prefix}) or i >= length(entity) - {keep_last} then c
        when kind in ('secret', 'key') and entity rlike '^[0-9a-f]+$' then {drawn('i + 1', '0123456789abcdef')}
        when i = 0 and kind = 'phone' then {drawn('i + 1', '23456789')}
        when c rlike '[0-9]' then {drawn('i + 1', '0123456789')}
        {cases} when c rlike '\\\\p{{L}}' then {drawn('i + 1', LETTERS[0][1])} else c end), '')"""
    octet = "cast(conv(substr(h, 4 * i + 1, 4), 16, 10) as int)"
    address = f"""array_join(transform(split(entity, '[.]'), (o, i) -> cast(case length(o)
        when 1 then {octet} % 9 + 1 when 2 then {octet} % 90 + 10 else {octet} % 156 + 100 end as string)), '.')"""
    script = "case when entity rlike '[а-яё]' then 'а' when entity rlike '[α-ωά-ώ]' then 'α' else 'a' end"
    names = " ".join(
        f"when '{s}' then array_join(transform(sequence(1, greatest(4, length(entity))), i -> case when substr(entity, i, 1) rlike \"[-'’]\" then substr(entity, i, 1) when i % 2 = 1 then {drawn('i', c)} else {drawn('i', v)} end), '')"
        for s, (c, v, *_) in SYLLABLES.items()
    )
    given = " ".join(
        f"when '{s}' then concat(array_join(transform(sequence(1, 4 + 2 * greatest(0, attempt - {LENGTHEN - 1})), i -> case when i % 2 = 1 then {drawn('i', c)} else {drawn('i', v)} end), ''), case kind when 'given male' then '{male}' when 'given female' then '{female}' else '{other}' end)"
        for s, (c, v, male, female, other) in SYLLABLES.items()
    )
    made = entities.withColumn("h", F.expr(stream(key, "kind, entity, attempt", "length(entity) + 16"))).withColumn(
        "surrogate",
        F.expr(f"case kind when 'ip' then {address} when 'name' then case {script} {names} end"
            f" when 'given male' then case {script} {given} end when 'given female' then case {script} {given} end"
            f" when 'given other' then case {script} {given} end else {by_class} end"),
    )
    # a card number with a valid check digit gets one
    valid = f"{_luhn('entity')} % 10 = 0"
    fixed = f"concat(substr(surrogate, 1, length(surrogate) - 1), cast((10 - {_luhn('concat(substr(surrogate, 1, length(surrogate) - 1), 0)')} % 10) % 10 as string))"
    longer = f"case when attempt >= {LENGTHEN} and not startswith(kind, 'given') then concat(surrogate, substr(sha2(concat_ws('|', h, attempt), 256), 1, 8)) else surrogate end"
    return (
        made.withColumn("surrogate", F.expr(f"case when kind = 'card' and {valid} then {fixed} else surrogate end"))
        .withColumn("surrogate", F.expr(longer))
        .drop("h")
    )


def _luhn(digits: str) -> str:
    """SQL: the Luhn sum of a string of digits."""
    twice = "2 * cast(d as int) - case when cast(d as int) > 4 then 9 else 0 end"
    return f"aggregate(transform(filter(split(reverse({digits}), ''), d -> d <> ''), (d, i) -> case when i % 2 = 1 then {twice} else cast(d as int) end), 0, (a, d) -> a + d)"


def assigned(entities: DataFrame, key: str, attempts: int = ATTEMPTS) -> DataFrame:
    """A surrogate of its own for each distinct (kind, entity); none is any entity's original.

    An entity whose draw is taken draws again; the lowest entity keeps a draw
    that several made. Each round is one aggregation over the values in play.
    """
    entities = written(entities, "entities")
    pending, done = entities.withColumn("attempt", F.lit(0)), None
    originals = entities.select("kind", F.col("entity").alias("value"))
    # a given name is no surrogate of any gender
    every = F.explode(F.array(*[F.lit(f"given {g}") for g in ("male", "female", "other")])).alias("kind")
    originals = originals.union(originals.where("startswith(kind, 'given')").select(every, "value"))
    for attempt in range(attempts):
        made = written(surrogates(pending, key), "drawn")
        taken = originals if done is None else originals.union(done.select("kind", F.col("surrogate").alias("value")))
        first = made.groupBy("kind", "surrogate").agg(F.min("entity").alias("entity"))
        good = first.join(taken, (first.kind == taken.kind) & (first.surrogate == taken.value), "left_anti")
        good = written(good.select("kind", "entity", "surrogate"), "assigned")
        done = good if done is None else done.unionByName(good)
        pending = made.join(good, ["kind", "entity"], "left_anti").withColumn("attempt", F.lit(attempt + 1)).drop("surrogate")
        if pending.isEmpty():
            return done
    raise RuntimeError(f"no free surrogate after {attempts} draws")


def poured() -> str:
    """SQL: the replacement of a mention ``raw`` by its entity's ``surrogate`` (and a new ``head`` of given names before the
    surname ``last``), in the mention's own format; a mention without a surrogate is no entity and stays."""
    place = "length(surrogate) - length(regexp_replace(substr(raw, i + 1), '[^0-9]', '')) + 1"
    digits = f"array_join(transform(filter(split(raw, ''), c -> c <> ''), (c, i) -> case when c rlike '[0-9]' and {place} >= 1 then substr(surrogate, {place}, 1) else c end), '')"
    letters = "array_join(transform(filter(split(raw, ''), c -> c <> ''), (c, i) -> case when c = lower(c) then substr(surrogate, i + 1, 1) else upper(substr(surrogate, i + 1, 1)) end), '')"
    spaced = "array_join(transform(filter(split(raw, ''), c -> c <> ''), (c, i) -> case when c = ' ' then c else substr(surrogate, i + 1 - (length(substr(raw, 1, i + 1)) - length(replace(substr(raw, 1, i + 1), ' ', ''))), 1) end), '')"
    title = "regexp_extract(raw, '^[^ ]+ ', 0)"
    cased = "array_join(transform(filter(split(surrogate, ''), c -> c <> ''), (c, i) -> case when lower(substr(last, i + 1, 1)) <> substr(last, i + 1, 1) then upper(c) else c end), '')"
    longer = f"length(surrogate) > length(entity) and kind <> 'name'"
    return f"""case
        when surrogate is null then raw
        when kind = 'secret' then concat(substr(raw, 1, length(raw) - length(entity)), surrogate)
        when kind = 'name' then concat({title}, head, {cased})
        when {longer} then surrogate
        when kind in {DIGIT_KINDS} then {digits}
        when kind = 'iban' then {spaced}
        when kind = 'email' then {letters}
        else surrogate end"""


def replacements(mentions: DataFrame, key: str) -> DataFrame:
    """(raw, replacement) for each distinct mention of ``mentions`` (raw)."""
    told = mentions.select("raw").distinct().withColumn("kind", kind_of(F.col("raw")))
    name = F.col("kind") == "name"
    told = told.withColumn("last", F.when(name, F.regexp_extract("raw", LAST, 1)))
    told = told.withColumn("entity", F.when(name, F.lower("last")).otherwise(F.expr(canonical("kind", "raw"))))
    before = F.expr("substr(body, 1, length(body) - length(last))")
    told = told.withColumn("body", F.when(name, untitled("raw"))).withColumn("before", before).drop("body")
    told = told.withColumn("given", F.regexp_extract_all("before", F.lit(GIVEN), F.lit(0))).withColumn("between", F.split("before", GIVEN, -1))
    gender = F.when(F.col("raw").rlike(f"^(?:{MALE})[. ]"), "given male").when(F.col("raw").rlike(f"^(?:{FEMALE})[. ]"), "given female")
    # a bare run of digits of no usual length is a card number if its check digit says so
    number = F.expr(f"kind = 'card' and length(raw) <> 16 and raw rlike '^[0-9]+$' and {_luhn('raw')} % 10 <> 0")
    told = written(told.withColumn("given_kind", gender.otherwise("given other")).withColumn("number", number), "mentions")
    parts = told.where(name & (F.size("given") > 0)).select("raw", "given_kind", F.posexplode("given").alias("at", "part"))
    parts = parts.withColumn("given", F.lower("part"))
    own = assigned(told.where("not number").select("kind", "entity").union(parts.select("given_kind", "given")).distinct(), key)
    of_given = own.where("startswith(kind, 'given')").toDF("given_kind", "given", "given_surrogate")
    one = F.when(F.length("part") == 1, F.upper(F.substring("given_surrogate", 1, 1))).otherwise(F.initcap("given_surrogate"))
    heads = parts.join(of_given, ["given_kind", "given"]).groupBy("raw").agg(F.sort_array(F.collect_list(F.struct("at", one.alias("new")))).alias("heads"))
    joined = told.join(own, ["kind", "entity"], "left").join(heads, "raw", "left")
    head = F.array_join(F.zip_with("between", F.coalesce("heads.new", F.array().cast("array<string>")), lambda gap, new: F.concat(gap, F.coalesce(new, F.lit("")))), "")
    return joined.withColumn("head", head).select("raw", F.expr(poured()).alias("replacement"))


def untitled(raw) -> Column:
    return F.regexp_replace(raw, f"^{TITLE}", "")


def surname(name: Column) -> Column:
    """The last word of a name or of its replacement (which may have been lengthened)."""
    word = F.regexp_extract(name, LAST, 1)
    return F.when(word != "", word).otherwise(F.regexp_extract(name, "([^ ]+)$", 1))


def pattern(people: Column) -> Column:
    """What is replaced in a text whose titled mentions give the names ``people``."""
    names = F.array_join(F.transform(people, lambda x: F.replace(x, F.lit("."), F.lit("\\."))), "|")
    return F.concat(F.lit(ANY + r"|(?<![\p{L}\p{N}])(?:"), names, F.lit(r")(?![\p{L}\p{N}])"))


def cut(text: Column, what: Column) -> Column:
    """``text`` as an array: what lies before the first match of ``what``, the match, what lies before the next, and so on."""
    marked = F.split(F.regexp_replace(text, what, F.lit(f"{MARK}$0{MARK}")), MARK, -1)
    slowly = F.zip_with(F.split(text, what, -1), F.regexp_extract_all(text, what, F.lit(0)), lambda gap, m: F.array(gap, m))
    return F.when(text.contains(MARK), F.array_compact(F.flatten(slowly))).otherwise(marked)


def scanned(docs: DataFrame, text_col: str) -> DataFrame:
    """One row for each of ``docs``: ``row`` (its text null where it has mentions), and for texts with mentions ``h``, a hash of
    the text, ``mentions`` (raw, source) and ``gaps``, what lies before each mention and after the last.

    Full names and surnames that a text's titled mentions give are
    mentions wherever else they stand in it. ``source`` is the titled mention that
    tells the entity, one with a gender first; null: the mention itself.
    """
    text = F.col(f"`{text_col}`")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    out = docs.select(whole.alias("row"), text.alias("text"))
    out = out.withColumn("cut", F.when(F.col("text").rlike(HINT), cut(F.col("text"), F.lit(ANY))))
    mentions = lambda pieces: F.filter(pieces, lambda _, i: i % 2 == 1)
    is_name = lambda r: r.rlike(f"^{DETECTORS['name']}$")
    out = out.withColumn("titled", F.array_distinct(F.filter(mentions("cut"), is_name)))
    neutral = f"^(?:{NEUTRAL})[. ]"
    out = out.withColumn("titled", F.concat(F.filter("titled", lambda r: ~r.rlike(neutral)), F.filter("titled", lambda r: r.rlike(neutral))))
    last = lambda r: F.regexp_extract(r, LAST, 1)
    lead = lambda r: F.regexp_extract(untitled(r), f"^({WORD}) .* ", 1)
    short = lambda r: F.when(lead(r) != "", F.concat(lead(r), F.lit(" "), last(r)))
    out = out.withColumn("who", F.transform("titled", lambda r: F.struct(r.alias("raw"), untitled(r).alias("full"), short(r).alias("short"), last(r).alias("last"))))
    people = F.array_distinct(F.array_compact(F.concat(F.col("who.full"), F.col("who.short"), F.col("who.last"))))
    longest_first = lambda a, b: F.length(b) - F.length(a)
    out = out.withColumn("people", F.array_sort(people, longest_first))
    out = out.withColumn("cut", F.when(F.size("people") > 0, cut(F.col("text"), pattern(F.col("people")))).otherwise(F.col("cut")))
    first = lambda field, body: F.get(F.filter("who", lambda w: w[field] == body), F.lit(0))["raw"]
    source = lambda raw: F.coalesce(*[first(field, untitled(raw)) for field in ("full", "short", "last")])
    hit = F.size("cut") > 1
    told = F.transform(mentions("cut"), lambda r: F.struct(r.alias("raw"), F.when(F.size("people") > 0, source(r)).alias("source")))
    row = F.struct(*[(F.when(~F.coalesce(hit, F.lit(False)), F.col("text")) if c == text_col else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
    return out.select(
        row.alias("row"), F.when(hit, F.sha2("text", 256)).alias("h"), F.when(hit, told).alias("mentions"),
        F.when(hit, F.filter("cut", lambda _, i: i % 2 == 0)).alias("gaps"),
    )


def rewrite(docs: DataFrame, key: str = KEY, text_col: str = "text", count_as: str | None = None) -> DataFrame:
    """``docs`` with surrogates in ``text_col``; with ``count_as``, a last column
    of that name tells how many mentions were replaced.

    Null text stays null, with 0 mentions. Copies of a text are rewritten alike;
    repeated rows come out repeated. Other columns pass through, whatever their
    names. Empty table: no rows.
    """
    if "'" in key or "\\" in key:
        raise ValueError("the key may not hold quotes or backslashes")
    rows = written(scanned(docs, text_col), "scanned")
    rebuilt = lambda new, n: [*[(new if c == text_col else F.col(f"row.`{c}`")).alias(c) for c in docs.columns], *([n.alias(count_as)] if count_as else [])]
    free = rows.where("h is null").select(*rebuilt(F.col(f"row.`{text_col}`"), F.lit(0)))
    hits = rows.where("h is not null")
    raws = written(hits.groupBy("h").agg(F.first("mentions").alias("mentions")), "raws")
    spread = raws.select("h", F.posexplode("mentions").alias("at", "m"))
    spread = spread.select("h", "at", "m.raw", F.coalesce("m.source", "m.raw").alias("source"))
    told = spread.join(replacements(spread.select(F.col("source").alias("raw")), key).toDF("source", "replacement"), "source")
    # another mention of a titled name: its own title, and as much of the name as it has
    body, new = untitled("raw"), untitled("replacement")
    part = F.when(body == untitled("source"), new)
    part = part.when(body.contains(" "), F.concat(F.regexp_extract(new, "^([^ ]+)", 1), F.lit(" "), surname(new))).otherwise(surname(new))
    own = F.when(F.col("raw") == F.col("source"), F.col("replacement")).otherwise(F.concat(F.regexp_extract("raw", f"^{TITLE}", 0), part))
    told = told.withColumn("replacement", own).withColumn("changed", F.col("replacement") != F.col("raw"))
    by_text = told.groupBy("h").agg(F.sort_array(F.collect_list(F.struct("at", "replacement", "changed"))).alias("news"))
    by_text = by_text.select("h", "news", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    # rows of one text are spread by whatever else they hold
    salted = hits.select("h", "row", "gaps", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int").alias("salt"))
    joined = salted.join(by_text, ["h", "salt"])
    text = F.array_join(F.zip_with("gaps", "news.replacement", lambda gap, r: F.concat(gap, F.coalesce(r, F.lit("")))), "")
    return free.unionByName(joined.select(*rebuilt(text, F.size(F.filter("news", lambda x: x["changed"])))))


def op9_privacy(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return rewrite(docs, count_as="n_entities")

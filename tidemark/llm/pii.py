"""PII surrogates, with SQL functions only.

Entities are found by patterns; each distinct one gets a surrogate drawn by a keyed
hash, of its own kind and form: an address stays an address with parts of the
same length, a card number keeps its first digit and a valid checksum, an IBAN its
country and valid check digits, a telephone number its country code, a name its
gender and script. One entity has one surrogate wherever it occurs, whatever its
spelling: separators, case, a country code that is written or understood, the form
of address before a name. Two entities never share one, and no surrogate is an
entity of its kind that the corpus holds (of names: any name): entities and
surrogates are compared in one normal form, and those that clash are drawn
anew, from a pool that widens, until none does.

Only entities are shuffled, and of the texts only those that hold some.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shared import written

# Forms of address that tell a gender.
MALE = ["Mr", "Herr", "Señor", "Monsieur", "Signor", "Господин", "г-н", "Κύριος"]
FEMALE = ["Mrs", "Ms", "Miss", "Frau", "Señora", "Señorita", "Madame", "Mme", "Signora", "Госпожа", "г-жа", "Κυρία"]
NEUTRAL = ["Dr", "Prof", "Mx"]
# Given names by script and gender.
GIVEN = {
    "latin_m": "Adam Bruno Carl David Emil Felix Georg Henri Ivan Jonas Karl Leon Marco Nils Oscar Paul Roman Simon Tomas Viktor",
    "latin_f": "Anna Berta Clara Dora Emma Flora Greta Helena Irene Julia Karin Laura Maria Nora Olga Paula Rosa Sofia Teresa Vera",
    "latin_u": "Alex Andrea Chris Dominique Eli Francis Jamie Jordan Kim Lee Morgan Noel Quinn Robin Sam Sasha Taylor Toni Val Yael",
    "cyrillic_m": "Андрей Борис Виктор Глеб Денис Егор Иван Кирилл Лев Максим Никита Олег Павел Роман Сергей Тимур",
    "cyrillic_f": "Анна Вера Галина Дарья Елена Жанна Зоя Ирина Ксения Лариса Мария Нина Ольга Полина Софья Юлия",
    "cyrillic_u": "Саша Женя Валя Слава",
    "greek_m": "Αλέξης Γιώργος Δημήτρης Κώστας Λεωνίδας Μάρκος Νίκος Παύλος Στέφανος Πέτρος",
    "greek_f": "Άννα Βασιλική Δήμητρα Ελένη Ζωή Ιωάννα Κατερίνα Μαρία Σοφία Χριστίνα",
    "greek_u": "Αλέξ Φώτη",
}
SYLLABLES = {
    "latin": "ba be bo da de do fa fe ga go ha he ka ke ko la le lo ma me mo na ne no ra re ro sa se so ta va".split(),
    "cyrillic": "ба бе бо ва ве да де до за ка ке ко ла ле ло ма ме мо на не но па пе по ра ре ро са се со та те".split(),
    "greek": "βα βε βο γα γε δα δε δο ζα κα κε κο λα λε λο μα με μο να νε νο πα πε πο ρα ρε ρο σα σε σο τα τε".split(),
}

# Lengths of an IBAN by country.
IBAN = {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU",
    31: "MT SC", 32: "LC", 33: "RU",
}
# Fixed value: country codes of telephone numbers; all others have three digits.
CALLING = r"^(1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"


def _iban() -> str:
    """Country, check digits and as many groups of four as the country's length has, with what is left."""
    forms = []
    for n, countries in IBAN.items():
        rest = f" ?[A-Z0-9]{{{n % 4}}}" if n % 4 else ""
        forms.append(f"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{n // 4 - 1}}}{rest}")
    return r"(?<![A-Za-z0-9])(?=[A-Z]{2}[0-9]{2})(?:" + "|".join(forms) + ")(?![A-Za-z0-9])"


_address = "|".join(sorted(MALE + FEMALE + NEUTRAL, key=len, reverse=True))
# A word of a name with its hyphens, and an apostrophe before a capital.
_word = r"\p{Lu}(?:[\p{L}\p{M}]++|(?=['’]\p{Lu}))(?:(?:-\p{L}|['’]\p{Lu})[\p{L}\p{M}]*+)*+"
_first = "(?=[" + "".join(sorted({w[0] for w in MALE + FEMALE + NEUTRAL})) + "])"
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,6}\.[A-Za-z]{2,24}(?![A-Za-z0-9])",
    "key": r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])",
    # One character back first: the long look back is for the few places that pass. Marks alone are no secret.
    "secret": r"(?<=[=: \"'])(?<=[=:] {0,2}[\"']{0,1})(?<=(?i:password|passwd|secret|token|api_key|apikey) {0,2}[=:] {0,2}[\"']{0,1})(?=[+/_-]*+[A-Za-z0-9])[A-Za-z0-9+/_-]{8,}+(?:\.[A-Za-z0-9+/_-]++)*+",
    "ip": r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?![0-9]|\.[0-9])",
    "iban": _iban(),
    "ssn": r"(?<![A-Za-z0-9_-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![A-Za-z0-9_-])",
    "card": r"(?<![A-Za-z0-9_.-])(?:3[47][0-9]{2}[ -]?[0-9]{6}[ -]?[0-9]{5}|[3-6][0-9]{3}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{1,7})(?![A-Za-z0-9_-])",
    "phone": r"(?<![A-Za-z0-9_+])\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?(?:[ .-]?[0-9]{2,4}){2,4}(?![0-9])|(?<![A-Za-z0-9_(])\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}(?![0-9])|(?<![A-Za-z0-9_-])[0-9]{3}-[0-9]{3}-[0-9]{4}(?![A-Za-z0-9_-])",
    "name": _first + r"(?<![\p{L}\p{N}])(?:" + _address + r")\.? " + _word + "(?: " + _word + ")*+",
}
#: Texts that none of these finds, and that hold no access key's first letters, hold no entity; each is a scan with a cheap first character.
GATES = ["[0-9@]", r"[=:](?<=(?i:password|passwd|secret|token|api_key|apikey) {0,2}[=:])", _first + "(?:" + _address + r")\.? \p{Lu}"]


def _may_hold(text: Column) -> Column:
    found = F.contains(text, F.lit("AKIA")) | F.contains(text, F.lit("ASIA"))
    for g in GATES:
        found = found | text.rlike(g)
    return found


def _sql(s: str) -> str:
    """A raw literal of the pattern or word."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _array(words: list[str]) -> str:
    return "array(" + ", ".join(map(_sql, words)) + ")"


def _number(i: str, of: str = "hex") -> str:
    """The i-th byte (from 1, again from the start past the 64th) of a string of 128 hex digits."""
    return f"cast(conv(substring({of}, cast(2 * (({i} - 1) % 64) + 1 as int), 2), 16, 10) as int)"


def _letters(value: str, first: str = "1", of: str = "hex", alphabet: str = "abcdefghijklmnopqrstuvwxyz") -> str:
    """value with letters and digits from place `first` on drawn anew: lower, upper and digits for their like."""
    n = len(alphabet)
    i = "(i + 1)"
    return f"""array_join(transform(split({value}, ''), (c, i) -> case
        when {i} < {first} then c
        when c rlike '[a-z]' then substring('{alphabet}', {_number(i, of)} % {n} + 1, 1)
        when c rlike '[A-Z]' then upper(substring('{alphabet}', {_number(i, of)} % {n} + 1, 1))
        when c rlike '[0-9]' then cast({_number(i, of)} % 10 as string)
        else c end), '')"""


def _digits(count: str, skip: int = 0) -> str:
    return f"aggregate(sequence(1, greatest({count}, 1)), '', (a, i) -> concat(a, cast({_number(f'(i + {skip})')} % 10 as string)))"


def _luhn(digits: str) -> str:
    """The checksum of a string of digits, 0 if it holds."""
    return f"""aggregate(sequence(1, greatest(length({digits}), 1)), 0, (a, i) -> a + case
        when i % 2 = 1 then cast(substring(reverse({digits}), i, 1) as int)
        when cast(substring(reverse({digits}), i, 1) as int) > 4 then 2 * cast(substring(reverse({digits}), i, 1) as int) - 9
        else 2 * cast(substring(reverse({digits}), i, 1) as int) end) % 10"""


def _mod97(iban: str) -> str:
    """The remainder of an IBAN's number: its first four characters go to the end, letters count from 10."""
    moved = f"concat(substring({iban}, 5), substring({iban}, 1, 4))"
    return f"""aggregate(split({moved}, ''), 0, (a, c) -> case when c rlike '[0-9]' then (a * 10 + cast(c as int)) % 97
        when c rlike '[A-Z]' then (a * 100 + ascii(c) - 55) % 97 else a end)"""


def _keyed(key: str, *parts: str) -> str:
    """128 hex digits that the key and the parts decide."""
    own = f"concat_ws('\\u0001', {', '.join(parts)})"
    half = "sha2(concat({k}, sha2(concat({k}, '{n}', {own}), 256)), 256)"
    return f"concat({half.format(k=_sql(key), n=0, own=own)}, {half.format(k=_sql(key), n=1, own=own)})"


def _syllables(script: str, first: int, count: str) -> str:
    """So many syllables that the bytes from the first on draw."""
    words = SYLLABLES[script]
    return f"array_join(transform(sequence(1, {count}), i -> element_at({_array(words)}, {_number(f'(i + {first - 1})')} % {len(words)} + 1)), '')"


def _drawn() -> Column:
    """The surrogate of (kind, norm, gender) at an attempt, from the column hex; in normal form but for a name's capitals.

    Later attempts draw from wider pools: more letters, more syllables, more first digits.
    """
    wider = "repeat('x', greatest(attempt - 2, 0))"
    code = f"regexp_extract(norm, '{CALLING}', 1)"
    national = f"(length(norm) - length({code}))"
    octet = f"cast(if(attempt < 20, 240 + {_number('1')} % 16, {_number('1')}) as string)"
    cases = [f"""when kind = 'email' then concat(
            {_letters(f"concat(substring_index(norm, '@', 1), {wider})")}, '@',
            {_letters("regexp_extract(norm, '@(.*[.])[^.]+$', 1)", of="domain_hex")},
            regexp_extract(norm, '[^.]+$', 0))""",
        f"when kind = 'key' then {_letters('norm', '5')}",
        f"when kind = 'secret' and (norm rlike '^[0-9a-f]+$' or norm rlike '^[0-9A-F]+$') then {_letters(f'concat(norm, {wider})', alphabet='abcdef')}",
        f"when kind = 'secret' then {_letters(f'concat(norm, {wider})')}",
        f"when kind = 'ip' then concat_ws('.', {octet}, cast({_number('2')} as string), cast({_number('3')} as string), cast({_number('4')} as string))",
        f"when kind = 'iban' then concat(substring(norm, 1, 2), lpad(cast(98 - {_mod97('body')} as string), 2, '0'), substring(body, 5))",
        f"when kind = 'ssn' then concat(if(attempt < 20, '9', cast({_number('1')} % 10 as string)), {_digits('8', 1)})",
        "when kind = 'card' then concat(body, cast(pmod(0 - " + _luhn("concat(body, '0')") + ", 10) as string))",
        # North American numbers have no 0 or 1 where the area's and the exchange's digits begin.
        f"""when kind = 'phone' then concat({code}, array_join(transform(sequence(1, {national}), i -> cast(
            if(i = 1 or (i = 4 and {code} = '1' and {national} = 10), 2 + {_number('i')} % 8, {_number('i')} % 10) as string)), ''))""",
    ]
    for s, names in GIVEN.items():
        script, gender = s.split("_")
        options = names.split()
        pick = f"element_at({_array(options)}, {_number('1')} % {len(options)} + 1)"
        # A given name is completed by syllables: the list alone is too short to keep people apart.
        tail = f"if(attempt = 0, '', concat('-', initcap({_syllables(script, 2, '(attempt + 1)')})))"
        cases.append(f"when kind = 'given_{script}' and gender = '{gender}' then concat({pick}, {tail})")
    for s in SYLLABLES:
        cases.append(f"when kind = 'surname_{s}' then initcap({_syllables(s, 1, '(4 + attempt)')})")
    return F.expr("case " + " ".join(cases) + " end")


def _with_surrogates(entities: DataFrame, key: str) -> DataFrame:
    """entities (kind, norm, gender, attempt) with the surrogate that this attempt draws, and its normal form."""
    out = entities.select("kind", "norm", "gender", "attempt")
    out = out.withColumn("hex", F.expr(_keyed(key, "kind", "norm", "cast(attempt as string)")))
    out = out.withColumn("domain_hex", F.expr(_keyed(key, "'domain'", "substring_index(norm, '@', -1)")))
    # All of a number but its check digits, which stand as zeros in an IBAN.
    card, iban = f"concat(substring(norm, 1, 1), {_digits('length(norm) - 2', 1)})", f"concat(substring(norm, 1, 2), '00', substring({_letters('norm', '5')}, 5))"
    out = out.withColumn("body", F.expr(f"case kind when 'card' then {card} when 'iban' then {iban} end"))
    out = out.withColumn("surrogate", _drawn())
    return out.select("kind", "norm", "gender", "attempt", "surrogate", _group().alias("group"), F.when(_group() == "name", F.lower("surrogate")).otherwise(F.col("surrogate")).alias("form"))


def _group() -> Column:
    """What entities and surrogates are kept apart in: all names together, other kinds each for itself."""
    return F.when(F.col("kind").rlike("^(?:given|surname)_"), "name").otherwise(F.col("kind"))


def surrogates(entities: DataFrame, key: str, max_rounds: int = 200) -> DataFrame:
    """(kind, norm, attempt, surrogate) of the distinct (kind, norm[, gender]): injective, and apart from all norms of the kind (a name: of all names).

    Each round draws for those that have none yet. Of entities that draw one
    surrogate the smallest keeps it; what a round settles stays. A pool that
    has nothing left for an entity (more distinct numbers than the form has)
    ends the rounds with an error.
    """
    if "gender" not in entities.columns:
        entities = entities.withColumn("gender", F.lit("u"))
    start = written(entities.select("kind", "norm", "gender", _group().alias("group")), "entities")
    held = start.select("group", F.col("norm").alias("form")).distinct()
    pending, settled = start.withColumn("attempt", F.lit(0)), []
    for _ in range(max_rounds):
        drawn = written(_with_surrogates(pending, key), "drawn")
        free = drawn.join(held, ["group", "form"], "left_anti")
        for before in settled:
            free = free.join(before, ["group", "form"], "left_anti")
        keeps = free.groupBy("group", "form").agg(F.min(F.struct("kind", "norm")).alias("keeps"))
        now = drawn.join(keeps, ["group", "form"], "left")
        now = written(now.withColumn("kept", F.coalesce(F.struct("kind", "norm") == F.col("keeps"), F.lit(False))).drop("keeps"), "round")
        settled.append(now.where("kept"))
        pending = now.where("not kept").select("kind", "norm", "gender", (F.col("attempt") + 1).alias("attempt"))
        if pending.isEmpty():
            out = settled[0]
            for more in settled[1:]:
                out = out.unionByName(more)
            return out.select("kind", "norm", "attempt", "surrogate")
    raise RuntimeError(f"surrogates still clash after {max_rounds} rounds")


def _combined(kinds: list[str]) -> str:
    """All patterns as one, a group each: the group that matched tells the kind, with what stands around the mention.

    All but an address's begin behind a character that is no letter or digit of
    ASCII; looking at that first passes over the inside of words at once. No two
    patterns match at one place in different order by that.
    """
    guarded = "|".join(f"({PATTERNS[k]})" for k in kinds if k != "ip")
    alone = [f"({PATTERNS[k]})" for k in kinds if k == "ip"]
    return "|".join([f"(?<![A-Za-z0-9])(?:{guarded})"] * bool(guarded) + alone)


def _in_order(kinds: list[str]) -> list[str]:
    """The kinds in the order of their groups."""
    return [k for k in kinds if k != "ip"] + [k for k in kinds if k == "ip"]


# Noncharacters of Unicode, which texts don't hold as a rule, mark off mentions and groups.
_START, _NEXT, _END = "\ufdd0", "\ufdd1", "\ufdd2"


def _marked(text: Column, kinds: list[str]) -> Column:
    """The text split at its mentions by one scan: each piece but the first holds a mention's groups and the text behind it. Null for texts with such marks."""
    marks = _START + _NEXT.join(f"${i + 1}" for i in range(len(kinds))) + _END
    pieces = F.split(F.regexp_replace(text, F.lit(_combined(kinds)), F.lit(marks)), _START, -1)
    return F.when(~text.rlike(f"[{_START}-{_END}]"), pieces)


def _mention(kinds: list[str], groups: list[Column]) -> Column:
    kind, raw = F.lit(kinds[-1]), groups[-1]
    for k, own in reversed([*zip(kinds[:-1], groups)]):
        kind, raw = F.when(own != "", k).otherwise(kind), F.when(own != "", own).otherwise(raw)
    return F.struct(kind.alias("kind"), raw.alias("raw"))


def _found(text: Column, pieces: Column, kinds: list[str]) -> Column:
    """The mentions (kind, raw) in order of place; texts with marks of their own are scanned once for each group."""

    def mention(piece: Column) -> Column:
        fields = F.split(F.substring_index(piece, _END, 1), _NEXT, -1)
        return _mention(kinds, [fields[i] for i in range(len(kinds))])

    zipped = F.arrays_zip(*(F.regexp_extract_all(text, F.lit(_combined(kinds)), F.lit(i + 1)).alias(f"g{i}") for i in range(len(kinds))))
    slowly = F.transform(zipped, lambda x: _mention(kinds, [x[f"g{i}"] for i in range(len(kinds))]))
    return F.when(pieces.isNull(), slowly).otherwise(F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), mention))


def _gaps(text: Column, pieces: Column, kinds: list[str]) -> Column:
    """What stands before each mention, and behind the last."""
    after = F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), lambda x: F.substring_index(x, _END, -1))
    return F.when(pieces.isNull(), F.split(text, _combined(kinds), -1)).otherwise(F.concat(F.slice(pieces, 1, 1), after))


def _escaped(word: str) -> str:
    return word.replace("-", "\\-")


def _parts() -> Column:
    """The parts of a mention (k, raw): (kind, norm, gender, raw, before); a name's words apart, others whole."""

    def address(words: list[str]) -> str:
        return _sql("^(?:" + "|".join(map(_escaped, words)) + ")[. ]")

    gender = f"case when raw rlike {address(FEMALE)} then 'f' when raw rlike {address(MALE)} then 'm' else 'u' end"
    script = "case when w rlike '\\\\p{IsCyrillic}' then 'cyrillic' when w rlike '\\\\p{IsGreek}' then 'greek' else 'latin' end"
    words = "slice(split(raw, ' '), 2, size(split(raw, ' ')))"
    named = f"""transform({words}, (w, i) -> named_struct(
        'kind', concat(if(i = size({words}) - 1, 'surname_', 'given_'), {script}),
        'norm', lower(w), 'gender', {gender}, 'raw', w, 'before', if(i = 0, concat(substring_index(raw, ' ', 1), ' '), ' ')))"""
    digits = "regexp_replace(raw, '[^0-9]', '')"
    # A number without its country code is a North American one: that is what the pattern finds.
    norm = f"""case k when 'email' then lower(raw) when 'card' then {digits} when 'ssn' then {digits} when 'iban' then replace(raw, ' ', '')
        when 'phone' then if(raw like '+%', {digits}, concat('1', {digits}))
        when 'ip' then array_join(transform(split(raw, '[.]'), x -> cast(cast(x as int) as string)), '.') else raw end"""
    # A number of a card's or an IBAN's form whose checksum fails is another number: it stays.
    kind = f"case when k = 'card' and {_luhn(digits)} <> 0 then 'other' when k = 'iban' and {_mod97(norm)} <> 1 then 'other' else k end"
    whole = f"array(named_struct('kind', {kind}, 'norm', {norm}, 'gender', 'u', 'raw', raw, 'before', ''))"
    return F.expr(f"if(k = 'name', {named}, {whole})")


# A surrogate takes the mention's form: its digits and letters go to the mention's places, its separators stay;
# a telephone number written without its country code takes the last digits only.
_FORM = """case
    when kind in ('card', 'ssn', 'iban', 'phone') then aggregate(sequence(1, length(raw)), named_struct('out', '', 'at', greatest(length(surrogate) - length(regexp_replace(raw, '[^0-9A-Z]', '')), 0) + 1), (a, i) -> if(
        substring(raw, i, 1) rlike '[0-9A-Z]',
        named_struct('out', concat(a.out, substring(surrogate, a.at, 1)), 'at', a.at + 1),
        named_struct('out', concat(a.out, substring(raw, i, 1)), 'at', a.at)), a -> a.out)
    when kind = 'email' and raw <> norm then aggregate(sequence(1, length(surrogate)), '', (a, i) -> concat(a, if(
        substring(raw, i, 1) rlike '[A-Z]', upper(substring(surrogate, i, 1)), substring(surrogate, i, 1))))
    when (kind like 'given%' or kind like 'surname%') and raw = upper(raw) and length(raw) > 1 then upper(surrogate)
    else surrogate end"""


def mentions(docs: DataFrame, kinds: list[str] | None = None, text_col: str = "text") -> DataFrame:
    """(d, key, found, gaps): the rows of docs whose text holds entities as structs, a key of the text, the mentions (kind, raw) in order of place, and the text around them."""
    kinds = _in_order(list(kinds or PATTERNS))
    text = F.col(text_col).cast("string")
    # The first mention is enough to tell; texts that have one are read to their end.
    rows = docs.where(_may_hold(text) & text.rlike(_combined(kinds)))
    # The pieces are a step of their own, as both columns made of them need the scan.
    rows = rows.select(F.struct(*docs.columns).alias("d"), text.alias("t"), _marked(text, kinds).alias("pieces"))
    t, pieces = F.col("t"), F.col("pieces")
    return rows.select("d", F.sha2(t, 256).alias("key"), _found(t, pieces, kinds).alias("found"), _gaps(t, pieces, kinds).alias("gaps"))


def replace_entities(docs: DataFrame, key: str = "tidemark", kinds: list[str] | None = None, text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """docs with the text's entities replaced; its columns and rows stay as they are otherwise, whatever the columns' names.

    key: keep it secret; with another key all surrogates differ. kinds: of
    PATTERNS, all by default. length_col: a column that holds the text's length
    and follows it. Null and empty texts, and those without entities, are
    unchanged. Repeated rows are replaced alike. An empty table gives an empty
    result. Names are found after a form of address only; a name's gender is that
    of most of its forms of address. Numbers count as cards and IBANs only if
    their checksum holds, and a credential needs a letter or a digit.
    """
    kinds = list(kinds or PATTERNS)
    text = F.col(text_col).cast("string")
    hits = written(mentions(docs, kinds, text_col), "hits")
    # Equal texts have equal replacements: they share a key.
    each = hits.select("key", F.posexplode("found").alias("pos", "m")).select("key", "pos", F.col("m.kind").alias("k"), F.col("m.raw").alias("raw")).distinct()
    each = written(each.select("key", "pos", F.posexplode(_parts()).alias("part", "p")).select("key", "pos", "part", "p.*"), "mentions")
    known = each.where("kind <> 'other'").groupBy("kind", "norm").agg(F.expr("sign(count_if(gender = 'm') - count_if(gender = 'f'))").alias("more"))
    known = known.select("kind", "norm", F.when(F.col("more") > 0, "m").when(F.col("more") < 0, "f").otherwise("u").alias("gender"))
    new = each.join(surrogates(known, key).select("kind", "norm", "surrogate"), ["kind", "norm"], "left")
    new = new.withColumn("out", F.concat("before", F.when(F.col("kind") == "other", F.col("raw")).otherwise(F.expr(_FORM))))
    outs = new.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("pos", "part", "out"))).alias("outs"))
    met = hits.select("d", "key", "gaps").join(written(outs, "replacements"), "key")
    # Gaps and replacements in turn; a name's later words belong to the gap of its first.
    by_place = F.expr("aggregate(outs, array(cast(null as string)), (a, x) -> if(x.part = 0, concat(a, array(x.out)), concat(slice(a, 1, size(a) - 1), array(concat(element_at(a, -1), x.out)))), a -> slice(a, 2, size(a)))")
    joined = F.array_join(F.zip_with("gaps", by_place, lambda g, o: F.concat(g, F.coalesce(o, F.lit("")))), "")
    changed = met.select("d", joined.alias("t"))
    columns = []
    for c in docs.columns:
        value = F.col(f"d.`{c}`")
        if c == text_col:
            value = F.col("t")
        elif c == length_col:
            value = F.length("t").cast(docs.schema[c].dataType)
        columns.append(value.alias(c))
    clean = docs.where(text.isNull() | ~_may_hold(text) | ~text.rlike(_combined(kinds)))
    return clean.unionByName(changed.select(*columns))

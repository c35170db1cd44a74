"""Surrogates once more in plain Python, one text after another: what the SQL has to equal."""

import hashlib
from collections import Counter, defaultdict

import regex

from tidemark.llm import pii

COMBINED = regex.compile("|".join(f"(?P<{k}>{p})" for k, p in pii.PATTERNS.items()))


def luhn(digits):
    d = [int(c) for c in reversed(digits)]
    return (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10


def mod97(iban):
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def keyed(key, *parts):
    own = "\x01".join(parts)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return bytes.fromhex("".join(sha(key + sha(key + n + own)) for n in "01"))


def letters(value, b, first=0, alphabet="abcdefghijklmnopqrstuvwxyz"):
    out = []
    for i, c in enumerate(value):
        n = b[i % 64]
        if i >= first and "a" <= c <= "z":
            c = alphabet[n % len(alphabet)]
        elif i >= first and "A" <= c <= "Z":
            c = alphabet[n % len(alphabet)].upper()
        elif i >= first and "0" <= c <= "9":
            c = str(n % 10)
        out.append(c)
    return "".join(out)


def drawn(kind, norm, gender, attempt, key):
    b = keyed(key, kind, norm, str(attempt))
    digits = lambda n, skip=0: "".join(str(b[i % 64] % 10) for i in range(skip, skip + n))
    if kind == "email":
        local, domain = norm.split("@")
        head, top = domain.rsplit(".", 1)
        return f"{letters(local + 'x' * max(attempt - 2, 0), b)}@{letters(head + '.', keyed(key, 'domain', domain))}{top}"
    if kind == "key":
        return letters(norm, b, 4)
    if kind == "secret":
        hexadecimal = regex.fullmatch("[0-9a-f]+|[0-9A-F]+", norm)
        return letters(norm + "x" * max(attempt - 2, 0), b, 0, "abcdef" if hexadecimal else "abcdefghijklmnopqrstuvwxyz")
    if kind == "ip":
        return ".".join(map(str, [240 + b[0] % 16 if attempt < 20 else b[0], *b[1:4]]))
    if kind == "iban":
        body = norm[:2] + "00" + letters(norm, b, 4)[4:]
        return f"{body[:2]}{98 - mod97(body):02d}{body[4:]}"
    if kind == "ssn":
        return ("9" if attempt < 20 else str(b[0] % 10)) + digits(8, 1)
    if kind == "card":
        body = norm[0] + digits(len(norm) - 2, 1)
        return body + str(-luhn(body + "0") % 10)
    if kind == "phone":
        code = regex.match(pii.CALLING, norm)[1]
        n = len(norm) - len(code)
        return code + "".join(str(2 + b[i] % 8 if i == 0 or (i == 3 and code == "1" and n == 10) else b[i] % 10) for i in range(n))
    what, script = kind.split("_")
    syllable = lambda first, n: "".join(pii.SYLLABLES[script][b[i % 64] % len(pii.SYLLABLES[script])] for i in range(first, first + n)).capitalize()
    if what == "surname":
        return syllable(0, 4 + attempt)
    names = pii.GIVEN[f"{script}_{gender}"].split()
    return names[b[0] % len(names)] + (f"-{syllable(1, attempt + 1)}" if attempt else "")


def surrogates(entities, key):
    """{(kind, norm): surrogate} of {(kind, norm): gender}."""
    group = lambda kind: "name" if kind.startswith(("given", "surname")) else kind
    held = {(group(k), n) for k, n in entities}
    out, used, pending, attempt = {}, set(), dict(entities), 0
    while pending:
        claims = defaultdict(list)
        for (k, n), g in pending.items():
            s = drawn(k, n, g, attempt, key)
            form = (group(k), s.lower() if group(k) == "name" else s)
            if form not in held and form not in used:
                claims[form].append((k, n, s))
        for form, own in claims.items():
            k, n, s = min(own)
            out[k, n] = s
            used.add(form)
            del pending[k, n]
        attempt += 1
    return out


def parts(kind, raw):
    digits = regex.sub("[^0-9]", "", raw)
    if kind == "name":
        address, *words = raw.split(" ")
        gender = "f" if address.rstrip(".") in pii.FEMALE else "m" if address.rstrip(".") in pii.MALE else "u"
        out = []
        for i, w in enumerate(words):
            script = "cyrillic" if regex.search(r"\p{IsCyrillic}", w) else "greek" if regex.search(r"\p{IsGreek}", w) else "latin"
            out.append((("surname_" if i == len(words) - 1 else "given_") + script, w.lower(), gender, w, address + " " if i == 0 else " "))
        return out
    norm = {
        "email": raw.lower(), "card": digits, "ssn": digits, "iban": raw.replace(" ", ""), "phone": digits if raw[0] == "+" else "1" + digits,
        "ip": ".".join(str(int(x)) for x in raw.split(".")) if kind == "ip" else "",
    }.get(kind, raw)
    if (kind == "card" and luhn(digits)) or (kind == "iban" and mod97(norm) != 1):
        kind = "other"
    return [(kind, norm, "u", raw, "")]


def formed(kind, norm, raw, s):
    if kind in ("card", "ssn", "iban", "phone"):
        places = len(regex.sub("[^0-9A-Z]", "", raw))
        own = iter(s[max(len(s) - places, 0) :])
        return "".join(next(own) if regex.match("[0-9A-Z]", c) else c for c in raw)
    if kind == "email":
        return "".join(c.upper() if i < len(raw) and "A" <= raw[i] <= "Z" else c for i, c in enumerate(s))
    if kind.startswith(("given", "surname")) and raw == raw.upper() and len(raw) > 1:
        return s.upper()
    return s


def replaced(texts, key="tidemark"):
    found = {t: [(m.start(), m.end(), parts(m.lastgroup, m[0])) for m in COMBINED.finditer(t)] for t in set(texts) if t}
    genders = defaultdict(Counter)
    for own in found.values():
        for _, _, ps in own:
            for kind, norm, gender, _, _ in ps:
                if kind != "other":
                    genders[kind, norm][gender] += 1
    table = surrogates({e: "m" if c["m"] > c["f"] else "f" if c["f"] > c["m"] else "u" for e, c in genders.items()}, key)

    def one(t):
        out, at = [], 0
        for start, end, ps in found[t]:
            out.append(t[at:start])
            out += [before + (raw if kind == "other" else formed(kind, norm, raw, table[kind, norm])) for kind, norm, _, raw, before in ps]
            at = end
        return "".join([*out, t[at:]])

    return [one(t) if t else t for t in texts]

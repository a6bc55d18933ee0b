"""Format-preserving Feistel pseudonyms for personal data.

Found values are checked (Luhn, mod 97, calendar, octets, number ranges), written as a number below the size of their
format, put through a keyed permutation of 0 .. size - 1 (a balanced Feistel network over the next even number of
bits, walked until the number is below the size) and written back in the same format with check digits made anew.
Equal values get equal pseudonyms in every document; different values never get the same one.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Callable
from datetime import date
from functools import lru_cache
from ipaddress import IPv6Address

import pyarrow as pa
from pyspark.sql import DataFrame

from flightlake.llm.common import add_columns

ROUNDS = 8
# Characters permuted together; longer values go piece by piece, each under the pieces before it.
LONGEST = 128
FIRST_DAY, LAST_DAY = date(1900, 1, 1).toordinal(), date(2099, 12, 31).toordinal()


def permute(value: int, size: int, key: bytes, tweak: str) -> int:
    """Keyed bijection of 0 .. size - 1; ``tweak`` names the format, so formats have unrelated permutations."""
    half = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
    mask, width, seed = (1 << half) - 1, (half + 7) // 8, tweak.encode()
    while True:
        left, right = value >> half, value & mask
        for r in range(ROUNDS):
            mixed = hashlib.blake2b(seed + bytes([r]) + right.to_bytes(width, "big"), key=key, digest_size=max(8, width)).digest()
            left, right = right, left ^ (int.from_bytes(mixed, "big") & mask)
        value = left << half | right
        if value < size:
            return value


def _symbols(text: str, key: bytes, kind: str, ranges: list[tuple[int, int]]) -> str:
    """``text`` with the characters at places where ``ranges`` gives (first code, count) permuted together."""
    if len(text) > LONGEST:
        n, before, out = -(-len(text) // LONGEST), hashlib.blake2b(key=key, digest_size=16), []
        cuts = [len(text) * i // n for i in range(n + 1)]
        for a, b in zip(cuts, cuts[1:]):
            out.append(_symbols(text[a:b], key, f"{kind}:{before.hexdigest()}", ranges[a:b]))
            before.update(text[a:b].encode("utf-8", "surrogatepass"))
        return "".join(out)
    value, size = 0, 1
    for ch, (low, count) in zip(text, ranges):
        value, size = value * count + ord(ch) - low, size * count
    if size == 1:
        return text
    value = permute(value, size, key, f"{kind}:{','.join(f'{a}.{b}' for a, b in ranges)}")
    out = []
    for low, count in reversed(ranges):
        value, digit = divmod(value, count)
        out.append(chr(low + digit))
    return "".join(reversed(out))


# First code and number of the Latin-1 letters in a row.
_LATIN = ((0xC0, 23), (0xD8, 7), (0xE0, 23), (0xF8, 8))


def _classes(text: str, fixed: Callable[[int, str], bool] = lambda i, ch: False, hexa: bool = False) -> list[tuple[int, int]]:
    """Each character's class: digits, capitals, small letters (a to f if ``hexa``), Latin-1 letters; all others stay."""
    out = []
    for i, ch in enumerate(text):
        if fixed(i, ch):
            out.append((ord(ch), 1))
        elif "0" <= ch <= "9":
            out.append((48, 10))
        elif "A" <= ch <= "Z":
            out.append((65, 6 if hexa else 26))
        elif "a" <= ch <= "z":
            out.append((97, 6 if hexa else 26))
        elif (latin := next((r for r in _LATIN if r[0] <= ord(ch) < r[0] + r[1]), None)) and not hexa:
            out.append(latin)
        else:
            out.append((ord(ch), 1))
    return out


def _cased(new: str, found: str) -> str:
    """``new`` (small letters) with the capitals of ``found``."""
    return "".join(a.upper() if b != b.lower() and len(a.upper()) == 1 else a for a, b in zip(new, found))


def _folded(found: str) -> str:
    """Small letters, where that keeps the length."""
    return "".join(ch.lower() if len(ch.lower()) == 1 else ch for ch in found)


def luhn_digit(digits: str) -> str:
    """The digit that makes ``digits`` plus it pass the Luhn check."""
    total = sum(d if i % 2 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits))))
    return str(-total % 10)


# First digits that stay: 2 to 6 are the travel and banking industries as a whole; of the others the ranges given to card
# issuers: UATP (15 digits), GPN, UnionPay and RuPay 81 and 82, UzCard, Napas, Troy, Humo.
_ISSUER = re.compile(r"[2-6]|1(?=\d{14}\Z)|8[12](?=\d{14,17}\Z)|(?:1946|8600|9704|9792|9860)(?=\d{12}(?:\d{3})?\Z)", re.ASCII)


def _card(found: str, key: bytes) -> str | None:
    digits = re.sub(r"\D", "", found)
    issuer = _ISSUER.match(digits)
    if not 13 <= len(digits) <= 19 or not issuer or luhn_digit(digits[:-1]) != digits[-1]:
        return None
    first = issuer[0]
    body = _symbols(digits[len(first):-1], key, "card" + first, [(48, 10)] * (len(digits) - len(first) - 1))
    fresh = iter(first + body + luhn_digit(first + body))
    return "".join(next(fresh) if ch.isdigit() else ch for ch in found)


def _iban(found: str, key: bytes) -> str | None:
    """Written in capitals or not, with spaces or not: one number."""
    compact = found.replace(" ", "").upper()

    def remainder(code: str) -> int:
        return int("".join(str(int(ch, 36)) for ch in code[4:] + code[:4])) % 97

    if not 15 <= len(compact) <= 34 or remainder(compact) != 1:
        return None
    body = _symbols(compact[4:], key, "iban" + compact[:2], _classes(compact[4:]))
    check = 98 - remainder(compact[:2] + "00" + body)
    small = found != found.upper()
    fresh = iter((f"{compact[:2]}{check:02d}{body}").lower() if small else f"{compact[:2]}{check:02d}{body}")
    return "".join(ch if ch == " " else next(fresh) for ch in found)


# Country calling codes of one and two digits (all others have three).
_COUNTRY = re.compile(r"1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3}")


def _phone(found: str, key: bytes) -> str | None:
    """Country code, a trunk (0) and all marks stay; the number's own digits move together, the same in every notation."""
    digits = [i for i, ch in enumerate(found) if "0" <= ch <= "9"]
    text = "".join(found[i] for i in digits)
    if found[0] == "+":
        code = _COUNTRY.match(text)
        if not code:
            return None
        country, own = code[0], digits[code.end():]
        if own and found[own[0] - 1:own[0] + 2] == "(0)":
            own = own[1:]
    else:
        country, own = ("0", digits[1:]) if text[0] == "0" and len(text) != 10 or found[0] == "0" else ("1", digits)
    if not 6 <= len(own) <= 14 or len(own) + len(country) < 8:
        return None
    number = "".join(found[i] for i in own)
    ranges = [(48, 10)] * len(number)
    if country == "1" and re.fullmatch(r"[2-9]\d\d[2-9]\d{6}", number):
        ranges[0] = ranges[3] = (50, 8)  # a North American number stays one
    elif country == "0" and number[0] != "0":
        ranges[0] = (49, 9)
    out = list(found)
    for i, ch in zip(own, _symbols(number, key, "phone" + country, ranges)):
        out[i] = ch
    return "".join(out)


def _ssn(found: str, key: bytes) -> str | None:
    area, group, serial = found[:3], found[4:6], found[7:]
    if area in ("000", "666") or area[0] == "9" or group == "00" or serial == "0000":
        return None
    areas = [a for a in range(1, 900) if a != 666]
    value = (areas.index(int(area)) * 99 + int(group) - 1) * 9999 + int(serial) - 1
    value, last = divmod(permute(value, len(areas) * 99 * 9999, key, "ssn"), 9999)
    first, middle = divmod(value, 99)
    return f"{areas[first]:03d}{found[3]}{middle + 1:02d}{found[6]}{last + 1:04d}"


def _address(found: str, key: bytes) -> str | None:
    """Octets keep their number of digits and stay at most 255."""
    octets = found.split(".")
    if any(int(x) > 255 or (len(x) > 1 and x[0] == "0") for x in octets):
        return None
    bounds = [{1: (0, 10), 2: (10, 90), 3: (100, 156)}[len(x)] for x in octets]
    return ".".join(str(ord(ch)) for ch in _symbols("".join(chr(int(x)) for x in octets), key, "ip", bounds))


def _email(found: str, key: bytes) -> str | None:
    """Letters and digits of the mailbox and the host move together, capitals or not; the last two names (of two, the last) stay."""
    domain = found.index("@") + 1
    names = found[domain:].split(".")
    kept = found.rindex(".".join(names[-2:])) if len(names) > 2 else len(found) - len(names[-1]) - 1
    small = _folded(found)
    return _cased(_symbols(small, key, "email", _classes(small, lambda i, ch: i >= kept)), found)


def _address6(found: str, key: bytes) -> str | None:
    """Hexadecimal digits move, capitals or not; colons and the number of digits stay."""
    try:
        IPv6Address(found)
    except ValueError:
        return None
    if len(re.sub(r"[^0-9a-fA-F]", "", found)) < 4:
        return None
    small, out = found.lower(), []
    groups = [(m.start(), m.end()) for m in re.finditer(r"[0-9a-f]+", small)]
    # Each group is a number of its width (no leading zero made or lost), all groups permuted together.
    value, size = 0, 1
    lows = []
    for a, b in groups:
        wide, n = b - a, int(small[a:b], 16)
        low = 0 if wide == 1 or small[a] == "0" else 16 ** (wide - 1)
        top = 16 ** (wide - 1) if small[a] == "0" and wide > 1 else 16 ** wide
        lows.append((low, top - low, wide))
        value, size = value * (top - low) + n - low, size * (top - low)
    value = permute(value, size, key, "ip6:" + ",".join(f"{a}.{b}.{c}" for a, b, c in lows))
    for low, count, wide in reversed(lows):
        value, own = divmod(value, count)
        out.append(f"{own + low:0{wide}x}")
    text, last = [], 0
    for (a, b), new in zip(groups, reversed(out)):
        text += [found[last:a], new.upper() if found != small else new]
        last = b
    return "".join([*text, found[last:]])


def _secret(found: str, key: bytes) -> str | None:
    """Access keys: the letters that name their kind stay."""
    if kind := re.match(r"AKIA|gh[pousr]_|sk-(?:[a-z]+-)*|eyJ", found):
        body = found[kind.end():]
        if kind[0][:2] in ("sk", "gh") and not re.search(r"\d", body):
            return None
        return kind[0] + _symbols(body, key, kind[0].lower(), _classes(body))
    if not re.search(r"\d", found) or not re.search(r"[a-fA-F]", found):
        return None
    return _symbols(found, key, "hex", _classes(found, hexa=True))


def _password(found: str, key: bytes) -> str | None:
    """A value assigned to a name such as password; letters and digits move, all-hexadecimal values stay so."""
    if not re.search(r"[A-Za-z0-9]", found):
        return None
    return _symbols(found, key, "password", _classes(found, hexa=bool(re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", found))))


def _day(found: str, key: bytes) -> str | None:
    parts = re.split(r"(\D)", found)
    a, mark, b, _, c = parts
    year_first = len(a) == 4
    year, month, day = (int(a), int(b), int(c)) if year_first else (int(c), int(b), int(a))
    american = mark in "/-" and not year_first and month > 12
    if american:
        month, day = day, month
    try:
        ordinal = date(year, month, day).toordinal()
    except ValueError:
        return None
    if not FIRST_DAY <= ordinal <= LAST_DAY:
        return None
    # Among the days written in the same way: equal widths, and where only one order of day and month is possible, that.
    wide = (len(b), len(c)) if year_first else (len(a), len(b))
    days = _days(wide, year_first, american)
    place = _find(days, ordinal)
    if place is None:
        return None
    # Two digits each: one permutation of all days, whatever their order and mark. (Forms with one digit, and the month-first
    # form, which shows by a day above 12, must stay such and have their own.)
    form = "" if wide == (2, 2) and not american else f"{wide if year_first or american else wide[::-1]}{american}"
    new = date.fromordinal(days[permute(place, len(days), key, f"day{form}")])
    if year_first:
        return f"{new.year:04d}{mark}{new.month:0{wide[0]}d}{mark}{new.day:0{wide[1]}d}"
    first, second = (new.month, new.day) if american else (new.day, new.month)
    return f"{first:0{wide[0]}d}{mark}{second:0{wide[1]}d}{mark}{new.year:04d}"


def _find(days: tuple[int, ...], ordinal: int) -> int | None:
    at = bisect_left(days, ordinal)
    return at if at < len(days) and days[at] == ordinal else None


@lru_cache(maxsize=64)
def _days(wide: tuple[int, int], year_first: bool, american: bool) -> tuple[int, ...]:
    """Days whose text in this form has these widths and is read the same way again."""
    out = []
    for n in range(FIRST_DAY, LAST_DAY + 1):
        d = date.fromordinal(n)
        pair = (d.month, d.day) if year_first or american else (d.day, d.month)
        if all(len(str(v)) == w if w == 1 else True for v, w in zip(pair, wide)) and not (american and d.day <= 12):
            out.append(n)
    return tuple(out)


# A further digit of an international number, with what stands before it (no IP address or date begins there); no-break
# spaces are usual in French text. North American numbers have ten digits, so that what follows them stays apart.
_GAP = "[ .  /-]{0,2}"
_DIGIT = rf"(?:(?=\d)|\.(?=\d)|(?!\.\d){_GAP[:-5]}{{1,2}}(?!\d{{1,3}}(?:\.\d{{1,3}}){{3}}(?!\d)|\d{{4}}-\d\d?-\d\d?(?!\d)))\(?\d(?:\)(?={_GAP}\d))?"
# Assigned values: quoted ones whole; without quotes after a space, a plain word is a value of passwords only ("the token: nothing").
_SET = "A-Za-z0-9._~+/!@#$%^*=-"
_VALUE = rf"(?:[{_SET}]{{5,}}[A-Za-z0-9]|[A-Za-z0-9._~+/-]{{6,}}(?![A-Za-z0-9]))"
_PLAIN = r"[A-Za-z][a-z]*(?:[-/][a-z]+)*[^A-Za-z0-9\s\"']*(?:[\s\"']|\Z)"
_PASS, _KEYS, _SIGN = "password|passwd|pwd", "secret|token|api[_-]?key", r"[\"']?[ \t]{0,3}[=:][ \t]{0,3}"
_ASSIGNED = (rf"(?<![A-Za-z0-9])(?:(?i:{_PASS}|{_KEYS}){_SIGN}(?:\"([^\"\n]{{6,}})\"|'([^'\n]{{6,}})')|"
             rf"(?:(?i:{_PASS}){_SIGN}|(?i:{_KEYS})(?:[=:]|{_SIGN}(?!{_PLAIN})))[\"']?({_VALUE}))")
# Letters of names beyond ASCII (fixed values: the Latin-1 ones).
_MORE = "\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
# Kinds in the order they are tried at a place; each pattern takes whole values only (the group that matched, if it has any).
KINDS: list[tuple[str, str, Callable[[str, bytes], str | None]]] = [
    ("email", rf"(?<![A-Za-z0-9._%+{_MORE}-])[A-Za-z0-9{_MORE}][A-Za-z0-9._%+{_MORE}-]{{0,63}}@[A-Za-z0-9](?:[A-Za-z0-9-]{{0,62}}\.)+[A-Za-z]{{2,24}}(?![A-Za-z0-9-])", _email),
    ("iban", r"(?<![A-Za-z0-9])(?:[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?|[a-z]{2}\d{2}(?: ?[a-z0-9]{4}){2,7}(?: ?[a-z0-9]{1,3})?)(?![A-Za-z0-9])", _iban),
    ("secret", r"(?<![A-Za-z0-9])(?:AKIA[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{30,255}|sk-[A-Za-z0-9_-]{20,255}|"
     r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}|[0-9a-f]{32,64}|[0-9A-F]{32,64})(?![A-Za-z0-9_-])", _secret),
    ("password", _ASSIGNED, _password),
    ("ip", r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?![\d]|\.\d)", _address),
    ("ip6", r"(?<![\w:.])(?:[0-9a-fA-F]{0,4}:){2,7}[0-9a-fA-F]{0,4}(?![\w:]|\.\d)", _address6),
    ("day", r"(?<![\d/.-])(?:\d{4}\.\d{2}\.\d{2}|\d{4}-\d{1,2}-\d{1,2}|\d{4}/\d{1,2}/\d{1,2}|\d{1,2}\.\d{1,2}\.\d{4}|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}-\d{1,2}-\d{4})(?![\d/-]|\.\d)", _day),
    ("ssn", r"(?<![\d-])(?:\d{3}-\d{2}-\d{4}|(?<!\d )\d{3} \d{2} \d{4}(?! \d))(?![\d-])", _ssn),
    ("card", r"(?<![\d.-])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3}|\d{4}[ -]\d{6}[ -]\d{4,5})(?![\d-]|\.\d)", _card),
    ("phone", rf"(?<![\w+])(?:\+1{_GAP}\(?\d{{3}}\)?{_GAP}\d{{3}}{_GAP}\d{{4}}(?!\d)|\+\d{{1,3}}(?!\d)(?:{_DIGIT}){{7,14}}|\+\d(?:{_DIGIT}){{7,14}}|"
     r"\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4}|"
     r"(?<!\d )(?:[2-9]\d{2} [2-9]\d{2} \d{4}|0[1-9](?:[ .]\d{2}){4}|0[1-9]\d{1,3}[ /]\d{6,8})(?! \d))(?!\d)", _phone),
]
_ANY = re.compile("|".join(f"(?P<{name}>{pattern})" for name, pattern, _ in KINDS), re.ASCII)
_RULES = {name: (re.compile(pattern, re.ASCII), rule) for name, pattern, rule in KINDS}
_HINT = re.compile(r"[0-9@=:]")


def _elsewhere(found: str, key: bytes) -> tuple[str, str] | None:
    """Kind and pseudonym of an assigned value that is a whole value of another kind, as it has where nothing is assigned."""
    for name, (pattern, rule) in _RULES.items():
        if name != "password" and pattern.fullmatch(found) and (new := rule(found, key)) is not None:
            return name, new
    return None


def pseudonymize(text: str, key: bytes) -> tuple[str, list[tuple[int, int, str]]]:
    """The text with every valid value replaced, and (start, end, kind) of each in the new text.

    Where a value of one kind is not valid, the later kinds are tried at the same place; then the search goes on at the next character.
    """
    if not _HINT.search(text):
        return text, []
    out, found, done, at, size = [], [], 0, 0, 0
    while match := _ANY.search(text, at):
        start = match.start()
        names = list(_RULES)
        hit = None
        for name in names[names.index(match.lastgroup):]:
            pattern, rule = _RULES[name]
            own = pattern.match(text, start)
            value = (own.lastindex or 0) if own else 0  # 0: the whole match
            if own and (new := rule(own[value], key)) is not None:
                if name == "password":
                    name, new = _elsewhere(own[value], key) or (name, new)
                hit = (own.end(value), name, new)
                start = own.start(value)
                break
        if hit is None:
            at = start + 1
            continue
        end, name, new = hit
        out += [text[done:start], new]
        size += start - done
        found.append((size, size + len(new), name))
        size += len(new)
        done = at = end
    return "".join([*out, text[done:]]), found


def with_pseudonyms(docs: DataFrame, key: bytes, text_col: str = "text", keep: list[str] | None = None,
                    name: str = "n_pseudonyms", spans: str = "pii_spans") -> DataFrame:
    """``keep`` columns (default: all but the text), the new text under its old name, the number of replaced values and
    their places as text: ``kind:start-end`` (code points of the new text), in order, by commas.

    Texts are read whole; text without valid values, empty and null texts stay as they are (null keeps null). Every row is
    worked on by itself: repeated rows give repeated results, and an empty table an empty one.
    """
    if not 8 <= len(key) <= 64:
        raise ValueError("the key must have 8 to 64 bytes")

    def run(texts: pa.Array) -> list:
        made = [pseudonymize(t, key) if t else (t, []) for t in texts.to_pylist()]
        return [[t for t, _ in made], [len(f) for _, f in made], [",".join(f"{k}:{a}-{b}" for a, b, k in f) for _, f in made]]

    kept = [c for c in docs.columns if c != text_col] if keep is None else keep
    return add_columns(docs, [text_col], [(text_col, "string"), (name, "long"), (spans, "string")], run, kept)


def replace_pii(docs: DataFrame, key: bytes, text_col: str = "text") -> DataFrame:
    """``docs`` with pseudonyms in the text: same columns in the same order; formats keep their length."""
    cols = docs.columns
    at = f"c{cols.index(text_col)}"
    rows = with_pseudonyms(docs.toDF(*[f"c{i}" for i in range(len(cols))]), key, at)
    return rows.select(*[f"c{i}" for i in range(len(cols))]).toDF(*cols)

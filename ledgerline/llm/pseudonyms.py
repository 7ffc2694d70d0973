"""Format-preserving pseudonyms for personal data.

Cards, phone numbers, social security and bank numbers, addresses of hosts, dates, mail names and keys
are found by pattern, validated, and replaced by a keyed permutation of all valid values of the same
format: a Feistel network on two halves of the value's index, walked until it falls inside the format
again. Equal values get equal pseudonyms in every document, different values different ones, and a
pseudonym is again a valid value (check digits are made anew).

One pass over each text, no shuffle. Defined results: a null text stays null, a text without findings
stays as it is; findings never overlap (the leftmost, longest pattern wins); invalid look-alikes such as
numbers that fail their check digit stay; findings of any length are replaced, long ones in blocks; what holds
neither letter nor digit has no other value of its format and stays; other columns are passed through untouched.
"""

from __future__ import annotations

import re
from datetime import date, timedelta
from hashlib import blake2b
from math import isqrt

import pyarrow as pa
from pyspark.sql import Column

from ledgerline.llm.common import text_function

ROUNDS = 10
# Characters that are permuted as one number.
BLOCK = 256
FIRST_DAY, LAST_DAY = date(1900, 1, 1), date(2099, 12, 31)
FOUND = "struct<text:string,found:array<struct<kind:string,start:int,length:int,pseudonym:string>>>"

_PATTERNS = (
    ("email", r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9._%+\-]++@[A-Za-z0-9\-]++(?:\.[A-Za-z0-9\-]++)+"),
    ("secret", r"(?i:\b(?:token|secret|password|passwd|api[_-]?key|access[_-]?key|key)\b)\s{0,3}[=:]\s{0,3}[\"']?(?P<value>[A-Za-z0-9+/_\-]{16,}+)"),
    ("cloud_key", r"(?<![A-Za-z0-9])AKIA[A-Z0-9]{16}(?![A-Za-z0-9])"),
    ("iban", r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}[A-Z0-9]{11,30}+(?![A-Za-z0-9])"),
    ("ip", r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\.?\d)"),
    ("date", r"(?<!\d)(?:\d{4}-\d{2}-\d{2}|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}\.\d{1,2}\.\d{4})(?!\d)"),
    ("ssn", r"(?<![\d\-])\d{3}-\d{2}-\d{4}(?![\d\-])"),
    ("phone", r"(?<!\d)(?:\+?1[ .\-]?)?(?:\([2-9]\d{2}\) ?|[2-9]\d{2}[ .\-])[2-9]\d{2}[ .\-]\d{4}(?!\d)"),
    ("phone_abroad", r"(?<![\d+])\+[2-9]\d{0,2}(?:[ .\-]?\d){7,12}(?!\d)"),
    ("card", r"(?<!\d)(?:\d{13,19}|\d{4}(?P<sep>[ \-])\d{4}(?P=sep)\d{4}(?P=sep)\d{4}|\d{4}[ \-]\d{6}[ \-]\d{5})(?!\d)"),
)


def feistel(value: int, size: int, key: bytes, kind: str, forward: bool = True) -> int:
    """Keyed permutation of ``range(size)``; ``forward=False`` undoes it."""
    if size < 2:
        return value
    rows = isqrt(size - 1) + 1
    columns = -(-size // rows)

    def mix(turn: int, half: int, modulus: int) -> int:
        message = f"{kind}|{size}|{turn}|{half}".encode()
        width = modulus.bit_length() // 8 + 9
        digest = b"".join(
            blake2b(message + bytes([i]), key=key[:64], digest_size=64).digest() for i in range(-(-width // 64))
        )
        return int.from_bytes(digest[:width], "big") % modulus

    sign = 1 if forward else -1
    turns = range(ROUNDS) if forward else range(ROUNDS - 1, -1, -1)
    while True:
        left, right = divmod(value, columns)
        for turn in turns:
            if turn % 2:
                right = (right + sign * mix(turn, left, columns)) % columns
            else:
                left = (left + sign * mix(turn, right, rows)) % rows
        value = left * columns + right
        if value < size:
            return value


def luhn_digit(digits: str) -> str:
    """Check digit that completes ``digits``."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def _refill(shape: str, digits: str) -> str:
    """Put ``digits`` where ``shape`` has digits."""
    source = iter(digits)
    return "".join(next(source) if c.isdigit() else c for c in shape)


def _permuted(text: str, alphabets: list[tuple[int, str]], key: bytes, kind: str) -> str:
    """Permute a text among all texts of its shape: at each place the characters from a first one on."""
    value, size = 0, 1
    for c, (n, zero) in zip(text, alphabets):
        value, size = value * n + (int(c, 16) if n == 16 else ord(c) - ord(zero)), size * n
    shape = "".join(zero for _, zero in alphabets)
    value, out = feistel(value, size, key, f"{kind} {shape}"), []
    for n, zero in reversed(alphabets):
        value, digit = divmod(value, n)
        out.append("0123456789abcdef"[digit] if n == 16 else chr(ord(zero) + digit))
    return "".join(reversed(out))


def _characters(text: str, key: bytes, kind: str, hexadecimal: bool = False) -> str:
    """Permute letters among letters and digits among digits, all positions together.

    A long text is permuted block by block, from its start under a digest of the blocks before, then from its
    end under a digest of those behind: every character of the result depends on all of the text, it can be
    undone, and the work grows with the length.
    """
    plain = [(10, "0") if "0" <= c <= "9" else (26, "a") if "a" <= c <= "z" else (26, "A") if "A" <= c <= "Z" else (1, c) for c in text]
    alphabets = [(16, "0")] * len(text) if hexadecimal else plain
    if len(text) <= BLOCK:
        return _permuted(text, alphabets, key, kind)
    cuts = range(0, len(text), BLOCK)
    blocks, shapes = [text[i : i + BLOCK] for i in cuts], [alphabets[i : i + BLOCK] for i in cuts]
    for turn, order in enumerate((range(len(blocks)), range(len(blocks) - 1, -1, -1))):
        passed = blake2b(f"{len(text)}".encode(), key=key[:64], digest_size=16)
        for i in order:
            before = blocks[i]
            blocks[i] = _permuted(before, shapes[i], key, f"{kind} {turn} {i} {passed.hexdigest()}")
            passed.update(before.encode())
    return "".join(blocks)


def _card(text: str, key: bytes) -> str | None:
    digits = re.sub(r"\D", "", text)
    if luhn_digit(digits[:-1]) != digits[-1] or len(set(digits)) == 1:
        return None
    n = len(digits) - 1
    body = str(feistel(int(digits[:-1]), 10**n, key, "card")).zfill(n)
    return _refill(text, body + luhn_digit(body))


def _phone(text: str, key: bytes) -> str:
    digits = re.sub(r"\D", "", text)
    area, exchange, line = int(digits[-10:-7]), int(digits[-7:-4]), int(digits[-4:])
    value = feistel(((area - 200) * 800 + exchange - 200) * 10_000 + line, 800 * 800 * 10_000, key, "phone")
    value, line = divmod(value, 10_000)
    area, exchange = divmod(value, 800)
    return _refill(text, f"{digits[:-10]}{area + 200}{exchange + 200}{line:04d}")


def _phone_abroad(text: str, key: bytes) -> str:
    digits = re.sub(r"\D", "", text)
    # The first two digits stay: they hold most of the country code.
    n = len(digits) - 2
    return _refill(text, digits[:2] + str(feistel(int(digits[2:]), 10**n, key, "phone " + digits[:2])).zfill(n))


def _ssn(text: str, key: bytes) -> str | None:
    area, group, serial = map(int, text.split("-"))
    if area in (0, 666) or area >= 900 or not group or not serial:
        return None
    value = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
    value, serial = divmod(feistel(value, 898 * 99 * 9999, key, "ssn"), 9999)
    area, group = divmod(value, 99)
    area += 1 + (area + 1 >= 666)
    return f"{area:03d}-{group + 1:02d}-{serial + 1:04d}"


def _ip(text: str, key: bytes) -> str | None:
    parts = [int(p) for p in text.split(".")]
    if max(parts) > 255:
        return None
    value = feistel(int.from_bytes(bytes(parts), "big"), 1 << 32, key, "ip")
    return ".".join(map(str, value.to_bytes(4, "big")))


def _date(text: str, key: bytes) -> str | None:
    mark = next(c for c in text if not c.isdigit())
    parts = text.split(mark)
    numbers = [int(p) for p in parts]
    orders = {"-": ("ymd",), "/": ("mdy", "dmy"), ".": ("dmy",)}[mark]
    for order in orders:
        try:
            day = date(**{{"y": "year", "m": "month", "d": "day"}[o]: n for o, n in zip(order, numbers)})
        except ValueError:
            continue
        if not FIRST_DAY <= day <= LAST_DAY:
            continue
        while True:
            index = feistel((day - FIRST_DAY).days, (LAST_DAY - FIRST_DAY).days + 1, key, f"date {order}")
            day = FIRST_DAY + timedelta(days=index)
            # A day-first date is known by its day over 12, and so is its pseudonym.
            if order != "dmy" or mark != "/" or day.day > 12:
                break
        values = {"y": day.year, "m": day.month, "d": day.day}
        padded = mark == "-" or any(len(p) == 2 and p[0] == "0" for p in parts) or all(len(p) >= 2 for p in parts)
        return mark.join(f"{values[o]:02d}" if padded else str(values[o]) for o in order)
    return None


def _iban(text: str, key: bytes) -> str | None:
    def remainder(country: str, check: str, rest: str) -> int:
        return int("".join(str(int(c, 36)) for c in rest + country + check)) % 97

    country, check, rest = text[:2], text[2:4], text[4:]
    if remainder(country, check, rest) != 1:
        return None
    rest = _characters(rest, key, "iban " + country)
    return f"{country}{98 - remainder(country, '00', rest):02d}{rest}"


def _secret(text: str, key: bytes) -> str:
    if re.fullmatch(r"[0-9a-f]+", text):
        return _characters(text, key, "hex", hexadecimal=True)
    return _characters(text, key, "secret")


def _cloud_key(text: str, key: bytes) -> str:
    return text[:4] + _characters(text[4:], key, "cloud key")


def _email(text: str, key: bytes) -> str:
    name, _, host = text.partition("@")
    return f"{_characters(name, key, 'email')}@{host}"


_MAKERS = {
    "secret": _secret,
    "cloud_key": _cloud_key,
    "email": _email,
    "iban": _iban,
    "ip": _ip,
    "date": _date,
    "ssn": _ssn,
    "phone": _phone,
    "phone_abroad": _phone_abroad,
    "card": _card,
}


def _compiled() -> list[tuple[str, re.Pattern]]:
    return [(kind, re.compile(p, re.ASCII)) for kind, p in _PATTERNS]


def pseudonymise_text(text: str, key: bytes, patterns=None) -> tuple[str, list[tuple[str, int, int, str]]]:
    """New text, and (kind, start, length, pseudonym) of each finding in the old one."""
    candidates = []
    for order, (kind, pattern) in enumerate(patterns or _compiled()):
        for m in pattern.finditer(text):
            group = "value" if kind == "secret" else 0
            candidates.append((m.start(group), -m.end(group), order, kind))
    found, out, at = [], [], 0
    for start, end, _, kind in sorted(candidates):
        end = -end
        if start < at:
            continue
        value = text[start:end]
        new = _MAKERS[kind](value, key)
        if new is None:
            continue
        out += [text[at:start], new]
        found.append((kind, start, end - start, new))
        at = end
    return "".join([*out, text[at:]]), found


def pseudonymise(text: Column, key: str) -> Column:
    """Struct column: ``text`` with pseudonyms, and ``found`` with kind and place in the old text."""
    secret = blake2b(key.encode(), digest_size=32).digest()

    def replace(batches):
        patterns = _compiled()
        kind = pa.struct(
            [
                ("text", pa.string()),
                ("found", pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("length", pa.int32()), ("pseudonym", pa.string())]))),
            ]
        )
        for texts in batches:
            rows = []
            for t in texts.to_pylist():
                new, found = (t, []) if t is None else pseudonymise_text(t, secret, patterns)
                rows.append({"text": new, "found": [dict(zip(("kind", "start", "length", "pseudonym"), f)) for f in found]})
            yield pa.array(rows, type=kind)

    return text_function(replace, FOUND)(text)

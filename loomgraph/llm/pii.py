"""PII: detected entities are replaced by keyed surrogates of the same type, script, gender and format.

Surrogates are permutations, keyed by a secret that the caller must name: the letters and digits of an entity are read as one number in the
mixed radix of its format (a digit stays a digit, a hex digit a hex digit, a vowel a vowel of its script, a capital a
capital), which a keyed Feistel network permutes. The network is conjugated with a step by one, so no entity is its own
surrogate; equal entities get equal surrogates everywhere (coreference), different ones different ones. Entities of more than
``SEGMENT`` such characters are permuted piece by piece, each keyed by all before it. Given
names move within their list of one gender and script. Validity (Luhn, IBAN check digits, ranges of national ids) is kept
by following the permutation until it meets a valid number. A check over all entities of the corpus then groups
surrogates and looks for one that stands for two originals, or that is itself an original of the corpus (names of lists
aside, which move among themselves); if there is any, the distinct entities are tried under the next key, and the texts are done anew with the first key that passes.
Where no key passes the second test (long corpora hold phone numbers close to one another), the first that passes the other stands.

Types: email; secret (keys and tokens by prefix, values after a word such as "password" and a sign or "is", of under 9 characters only with letters and digits, what follows "Bearer",
private key blocks); card (13 to 19 digits, Luhn-valid or, of 16, after a word such as "card"); ip (4 and 6, but no version numbers); phone (international, national forms, digits after a label);
iban; national_id (ddd-dd-dddd, after "SSN" also parted otherwise or not at all); person: names after an honorific or a phrase that introduces one (also of a
listed given name in small letters), and a listed given name with a capitalised family name, with particles, initials and hyphens, as written or in capitals; each word of a person's name, and
each part of a hyphenated one, is replaced wherever it stands alone in the same document, also in capitals and before a possessive 's. Honorifics stay. No match has a greatest length.
Kinds within a type are kept: addresses stay private, loopback or public, cards keep the digit of their issuer.

Each group of types has a mark (``MARKS``) that a linear scan of a whole batch looks for; the expressions of a group run only over texts that hold its mark.
Of matches that overlap, the one that begins first stays, of such the one of the type named first.

Not detected: names without such context and outside the list (``given`` extends it), postal addresses, dates of birth, other national ids.

Defined results: null and empty texts stay as they are, without entities; a null doc_id is carried through; repeated rows get the
same result; an empty table gives no rows; very long texts are scanned whole, one at a time; columns named in carry are returned (they may be named like the outputs' sources, not like the outputs), others are not read.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
import unicodedata
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.llm.common import attach, pieces, stored, table

#: Given names by script and gender (fixed values).
GIVEN = {
    ("latin", "f"): "Aisha Alice Amina Anna Barbara Carla Carmen Claire Clara Elena Emma Eva Fatima Hannah Helen Ingrid Isabel Jane Julia Karen Laura Layla Linda Lucy Maria Marie Martha Mary Mei Monica Nina Paula Priya Rosa Sarah Sofia Sophie Susan Yuki Zainab".split(),
    ("latin", "m"): "Adam Ahmed Albert Ali Amit Andrew Anton Bernard Carlos Charles Daniel David Diego Eric Felix Frank George Hans Henry Hiroshi Hugo James John Joseph Juan Karl Louis Lucas Martin Michael Mohammed Omar Oscar Paul Peter Raj Robert Thomas Wei William".split(),
    ("cyrillic", "f"): "Анна Вера Дарья Елена Ирина Мария Нина Ольга София Татьяна".split(),
    ("cyrillic", "m"): "Андрей Борис Виктор Дмитрий Иван Максим Николай Олег Павел Сергей".split(),
    ("greek", "f"): "Άννα Ελένη Ειρήνη Κατερίνα Μαρία Σοφία".split(),
    ("greek", "m"): "Αλέξανδρος Γιώργος Δημήτρης Κώστας Νίκος Πέτρος".split(),
}
HONORIFICS = ("Mr", "Mrs", "Ms", "Miss", "Dr", "Prof", "Sir", "Lady", "Lord", "Herr", "Herrn", "Frau", "Mme", "Mlle", "Madame", "Monsieur", "Señor", "Señora", "Señorita", "Sr", "Sra", "Don", "Doña", "Господин", "Госпожа", "г-н", "г-жа", "Κύριος", "Κυρία")
#: Phrases that introduce a name of one word or more, and such as need two.
INTRODUCED = ("my name is", "mein Name ist", "ich heiße", "me llamo", "mi nombre es", "je m'appelle", "mon nom est", "меня зовут", "με λένε")
SIGNED = ("name:", "full name:", "author:", "written by", "signed by", "sent by", "contact:", "contact person:", "attn:", "patient:", "customer:", "sincerely,", "regards,", "dear")
PARTICLES = ("van", "von", "der", "den", "de", "del", "della", "di", "da", "dos", "la", "le", "bin", "ibn", "al", "el", "y", "zu")
#: Letters that stand for each other in a surrogate name or word.
CLASSES = ("aeiouy", "bcdfghjklmnpqrstvwxz", "áàâäéèêëíìîïóòôöúùûü", "ñçß", "аеёиоуыэюя", "бвгджзйклмнпрстфхцчшщ", "ьъ", "αεηιουω", "βγδζθκλμνξπρστφχψ", "άέήίόύώ", "ς")
_KIN = {c: k for k in CLASSES for c in k} | {c.upper(): k.upper() for k in CLASSES for c in k if c != "ß"}
_KIN |= {str(d): "0123456789" for d in range(10)}
_ALIKE = lambda *sets: {c: s for s in sets for c in s}
_HEX = _ALIKE("0123456789abcdef")
_HEX_IN_PLACE = _ALIKE("0123456789abcdef") | {c: "ABCDEF" for c in "ABCDEF"}
_KEYED = _ALIKE("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "0189")
_TOKEN = _ALIKE("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
#: Characters of an entity that one network permutes.
SEGMENT = 192

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_UPPER = "A-ZÀ-ÖØ-ÞĆČĎĘĚĞĲŁŃŇŒŘŚŞŠŤŮŰŹŻŽΆΈ-ΏΑ-ΫЀ-Я"
#: A name's word; the s of a possessive is none of it.
_PART = r"['’-](?![sS](?!\w))[^\W\d_]+"
_CAPITAL = rf"[{_UPPER}](?:[^\W\d_]+(?:{_PART})*|(?:{_PART})+)"
#: Words that follow an honorific or a given name without being a name, in small letters (fixed values).
NO_NAMES = frozenset("a analyst and architect asked chief com consultant danke de der designer developer die director editor el engineer executive for from has he i im in is lead manager nothing of on or principal product project que replied said says scientist she software the they to und was who y you your".split())
_AWS, _WORDS = "(?:AKIA|ASIA|AROA|AIDA|AGPA)", r"token|secret|password|passwd|passphrase|pwd|api[_-]?key|access[_-]?key|secret[_-]?key|private[_-]?key"
#: Each alternative begins with plain letters, so that a scan can skip to their first ones.
_PREFIXED = "|".join(rf"{head}[A-Z2-70189]{{16}}(?![A-Za-z0-9])" for head in ("AKIA", "ASIA", "AROA", "AIDA", "AGPA")) + rf"|gh[pousr]_[A-Za-z0-9]{{36,}}+|github_pat_\w{{22,}}+|glpat-[\w-]{{20,}}+|sk-[\w-]{{20,}}+|xox[abeoprs]-[\w-]{{10,}}+|AIza[\w-]{{35,}}+|npm_[A-Za-z0-9]{{36,}}+|hf_[A-Za-z0-9]{{30,}}+|eyJ[\w-]{{8,}}+\.[\w-]{{8,}}+(?:\.[\w-]++)?|SG\.[\w-]{{16,}}+\.[\w-]{{16,}}+"
#: A run of digits and what may part them; long enough ones hold cards, addresses, phone numbers and ids.
_RUN = re.compile(r"[+(\d][\d ().:/-]+")
_NUMBERS = re.compile(
    rf"""(?<![\d.])(?P<ip>{_OCTET}(?:\.{_OCTET}){{3}})(?!\d|\.\d)
    |(?<![\d-])(?P<national_id>(?!000|666|9)\d{{3}}-(?!00)\d{{2}}-(?!0000)\d{{4}})(?![\d-])
    |(?<!\d)(?P<card>\d{{4}}(?P<gap>[ -]?)\d{{4}}(?P=gap)\d{{4}}(?P=gap)\d{{4}})(?!\d)
    |(?<![\d.])(?P<digits>[3-6]\d{{12,18}}|3[47]\d\d(?P<split>[ -])\d{{6}}(?P=split)\d{{5}})(?!\d|\.\d)
    |(?<![\w+])(?P<phone>\+1[ .-]?(?:\(\d{{3}}\)|\d{{3}})[ .-]?\d{{3}}[ .-]?\d{{4}}|\+(?!1[ .(-])\d{{1,3}}[ .-]?(?:\(\d{{1,4}}\)|\d{{1,4}})(?:[ .-]?\d{{2,5}}){{1,4}})(?!\d)
    |(?<![\w+.)-])(?P<local>\(\d{{3}}\)[ .-]?\d{{3}}[ .-]\d{{4}}|\d{{3}}(?P<dash>[.-])\d{{3}}(?P=dash)\d{{4}}|\d{{3}}[ ]\d{{3}}[ -]\d{{4}}|0\d{{1,4}}[ /-]\d{{5,8}})(?![\d-])""",
    re.VERBOSE,
)
_LABEL = re.compile(r"(?<!\w)(?i:tel|telephone|phone|mobile|cell|fax|whatsapp|电话|電話|手机|手機)\.?[:：]?\s?\Z")
_CARD_LABEL = re.compile(r"(?<!\w)(?i:(?:credit |debit )?card|card (?:number|no)|visa|mastercard|amex|tarjeta|carte|karte|kreditkarte)\.?:?#?\s?\Z")
_VERSION = re.compile(r"(?<!\w)(?i:v|ver|version|build|release|rev|revision|firmware|kernel)\.?:?\s?\Z")
_SSN = re.compile(r"(?<!\w)(?i:ssn|social security(?: number| no\.?)?)\s?(?:is|[:#])?\s?(?P<ssn>(?!000|666|9)\d{3}([ .-]?)(?!00)\d{2}\2(?!0000)\d{4})(?!\d)")
_LABELLED = re.compile(r"\(?\d[\d ()./-]{5,}\d")
_DOMAIN, _LOCAL_MARKS = re.compile(r"(?:[^\W_][\w-]*\.)+[^\W\d_]{2,}"), set("._%+'-")
_KEYS = re.compile(_PREFIXED)
_VALUE, _BEFORE_VALUE = re.compile(r"""(?:[=:]\s?|(?<= )is )["']?(?P<value>[A-Za-z0-9+/_.!@#$%&*-]{3,}[A-Za-z0-9+/_!@#$%&*-])"""), re.compile(rf"""(?i:{_WORDS})["']?\s?\Z""")
_BEARER = re.compile(r"(?<!\w)[Bb]earer (?P<bearer>(?=[\w.~+/-]*\d)[\w.~+/-]{16,}=*)")
_BLOCK = re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----(?P<block>[^-]+(?:-(?!----)[^-]*)*)")
_IP6 = re.compile(r"(?<![\w:.])(?P<ip6>(?:[0-9A-Fa-f]{0,4}:){2,7}(?:[0-9A-Fa-f]{1,4}|:)?)(?![\w:])")
_IBAN = re.compile(r"[A-Z]{2}\d{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")


def _begins(text: str, at: int) -> bool:
    """Whether no letter, digit or underscore precedes a place."""
    return not at or not (text[at - 1].isalnum() or text[at - 1] == "_")


def _secret_value(m: re.Match) -> bool:
    """Long values after a sign; short ones, and those after "is", only if letters and digits meet in them."""
    value = m["value"]
    mixed = any(c.isdigit() for c in value) and any(c.isalpha() for c in value)
    return mixed or (len(value) >= 9 and not m[0].startswith("is"))


class Detector:
    """Finds entities, with the given names that it knows."""

    def __init__(self, given: dict[tuple[str, str], list[str]] = GIVEN):
        self.given = given
        self.names = {n: k for k, names in given.items() for n in names}
        capitals = {n.upper() for n in self.names}
        any_of = lambda words: "|".join(sorted(map(re.escape, words), key=len, reverse=True))
        more = rf"(?: [{_UPPER}]\.)?(?: (?:{any_of(PARTICLES)}))* {_CAPITAL}"
        self.named = re.compile(rf"(?:{any_of([*self.names, *capitals])}){more}(?!\w)")
        small = {n.lower() for n in self.names}
        self.small = re.compile(rf"\s+(?P<name>(?:{any_of(small)})(?: (?P<family>[^\W\d_A-Z]+))?)(?!\w)")
        self.dear = re.compile(rf"(?<!\w)[Dd]ear (?P<name>{any_of(self.names)})(?=\s*[,:!\n]|\s*$)", re.MULTILINE)
        self.titled = re.compile(rf"(?:{any_of(HONORIFICS)})\.? (?P<name>{_CAPITAL}(?:{more})*)(?!\w)")
        self.introduced, self.signed = (re.compile(rf"\s+(?:(?:{any_of(HONORIFICS)})\.? )?(?!(?:{any_of(HONORIFICS)})(?!\w))(?P<name>{_CAPITAL}(?:{more}){least})(?!\w)") for least in "*+")
        plain = lambda words: "|".join(re.escape(w).replace(r"\ ", " ").replace(r"\-", "-") for w in words)
        #: What every match of a group holds, for a scan that knows no look-around.
        self.marks = {
            "email": "@",
            "secret": rf"[Bb]earer |{_AWS}[A-Z0-9]{{16}}|gh[pousr]_[A-Za-z0-9]{{36}}|github_pat_|glpat-|sk-[A-Za-z0-9_-]{{20}}|xox[abeoprs]-|AIza[A-Za-z0-9_-]{{35}}|npm_[A-Za-z0-9]{{36}}|hf_[A-Za-z0-9]{{30}}|eyJ[A-Za-z0-9_-]{{8}}|SG\.|-----BEGIN|(?i:{_WORDS})[\"']?\s?(?:[=:]|is )",
            "number": r"\d[\d ().:/-]{4,}\d",
            "ip6": r"[0-9A-Fa-f]{0,4}:[0-9A-Fa-f]{0,4}:",
            "iban": r"[A-Z]{2}\d{2} ?[A-Z0-9]{4}",
            "person": rf"(?:{plain(HONORIFICS)})\.? |(?:{plain([*self.names, *capitals])}) |[Dd]ear ",
            "cue": rf"(?i:{plain((*INTRODUCED, *SIGNED))})",
        }

    def _emails(self, text: str) -> Iterator[tuple[int, int]]:
        at, before = text.find("@"), 0
        while at >= 0:
            start = at
            while start > before and (text[start - 1].isalnum() or text[start - 1] in _LOCAL_MARKS):
                start -= 1
            while start < at and text[start] in ".%+'-":
                start += 1
            before = at + 1
            if start < at and (m := _DOMAIN.match(text, at + 1)):
                yield start, m.end()
                before = m.end()
            at = text.find("@", before)

    def _numbers(self, text: str) -> Iterator[tuple[int, int, str]]:
        for run in _RUN.finditer(text):
            start, end = run.span()
            if end - start < 7:
                continue
            label = _LABEL.search(text, max(0, start - 16), start)
            if label and (m := _LABELLED.match(text, start, end)) and 7 <= sum(c.isdigit() for c in m[0]) <= 15:
                yield *m.span(), "labelled"
            while m := _NUMBERS.search(text, start, min(end + 1, len(text))):  # one character more, for what may not follow
                name = m.lastgroup
                before = max(0, m.start() - 20)
                fits = {"digits": lambda x: _luhn(x), "card": lambda x: _luhn(x) or _CARD_LABEL.search(text, before, m.start()), "ip": lambda x: not _VERSION.search(text, before, m.start())}.get(name)  # noqa: B023
                if fits is None or fits(m[name]):
                    yield *m.span(name), name
                    start = m.end()
                else:
                    start = m.start() + 1

    def _persons(self, text: str) -> Iterator[tuple[int, int]]:
        for m in self.named.finditer(text):
            if _begins(text, m.start()) and m[0].split(" ")[1].lower() not in NO_NAMES:
                yield m.span()
        for m in self.titled.finditer(text):
            if _begins(text, m.start()) and m["name"].split(" ")[0].lower() not in NO_NAMES:
                yield m.span("name")
        for m in self.dear.finditer(text):
            yield m.span("name")

    def _cued(self, text: str) -> Iterator[tuple[int, int]]:
        low = text.lower()
        if len(low) != len(text):  # some letters grow when lowered: those stay as they are
            low = "".join(c if len(c.lower()) > 1 else c.lower() for c in text)
        for phrases, after in ((INTRODUCED, self.introduced), (SIGNED, self.signed)):
            for phrase in phrases:
                at = low.find(phrase.lower())
                while at >= 0:
                    if _begins(text, at) and (m := after.match(text, at + len(phrase))) and m["name"].split(" ")[0].lower() not in NO_NAMES:
                        yield m.span("name")
                    elif phrases is INTRODUCED and _begins(text, at) and (m := self.small.match(text, at + len(phrase))):
                        yield m.start("name"), m.start("family") - 1 if m["family"] in NO_NAMES else m.end("name")
                    at = low.find(phrase.lower(), at + 1)

    def find(self, text: str, groups: set[str] | None = None) -> list[tuple[int, int, str]]:
        """(start, end, kind) of the entities, left to right, none overlapping. groups: those whose marks the text holds (all by default)."""
        on = (lambda g: g in groups) if groups is not None else (lambda g: True)
        found: list[tuple[int, int, int, str]] = []
        if on("email"):
            found += ((a, 0, b, "email") for a, b in self._emails(text))
        if on("secret"):
            found += ((m.start(), 1, m.end(), "secret") for m in _KEYS.finditer(text) if _begins(text, m.start()))
            found += ((m.start("value"), 2, m.end("value"), "secret") for m in _VALUE.finditer(text) if _BEFORE_VALUE.search(text, max(0, m.start() - 24), m.start()) and _secret_value(m))
            found += ((m.start("bearer"), 2, m.end("bearer"), "secret") for m in _BEARER.finditer(text))
            found += ((m.start("block"), 3, m.end("block"), "secret") for m in _BLOCK.finditer(text))
        if on("ip6"):
            found += ((m.start(), 4, m.end(), "ip") for m in _IP6.finditer(text) if _is_ip6(m[0]))
        if on("iban"):
            found += ((m.start(), 5, m.end(), "iban") for m in _IBAN.finditer(text) if _begins(text, m.start()) and _mod97(m[0]) == 1)
        if on("number"):
            found += ((a, 6, b, _KIND.get(k, k)) for a, b, k in self._numbers(text))
            found += ((m.start("ssn"), 5, m.end("ssn"), "national_id") for m in _SSN.finditer(text))
        if on("person"):
            found += ((a, 7, b, "person") for a, b in self._persons(text))
        if on("cue"):
            found += ((a, 8, b, "person") for a, b in self._cued(text))
        out, end, alone = [], 0, set()
        for start, _, stop, kind in sorted(found, key=lambda x: (x[0], x[1])):
            if start < end:
                continue
            out.append((start, stop, kind))
            end = stop
            if kind == "person":
                words = {w for w in text[start:stop].split(" ") if len(w) > 2 and w[-1] != "." and w not in PARTICLES}
                words |= {p for w in words for p in w.split("-") if len(p) > 2 and p not in PARTICLES}
                alone |= words | {w.upper() for w in words} | {w.title() for w in words if w.isupper() or w.islower()}
        if not alone:
            return out
        whole, i = [], 0
        for m in _WORD.finditer(text):
            while i < len(out) and out[i][1] <= m.start():
                i += 1
            if m[0] in alone and _begins(text, m.start()) and (i == len(out) or out[i][0] >= m.end()):
                whole.append((*m.span(), "person"))
        return sorted(out + whole)


_WORD = re.compile(rf"{_CAPITAL}(?!\w)")
_KIND = {"digits": "card", "local": "phone", "labelled": "phone"}


def _luhn(text: str) -> bool:
    digits = [int(c) for c in text if c.isdecimal()]
    return sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(reversed(digits))) % 10 == 0


def _mod97(iban: str) -> int:
    plain = iban.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97


def _is_ip6(text: str) -> bool:
    try:
        ipaddress.IPv6Address(text)
    except ValueError:
        return False
    return sum(bool(g) for g in text.split(":")) > 2 and any(c.isdigit() for c in text)


def permuted(x: list[int], radix: list[int], key: bytes) -> list[int]:
    """Another number of the same mixed radix: a keyed permutation without fixed points (if there is more than one number)."""
    half = len(radix) // 2
    sizes = [1, 1]
    values = [0, 0]
    for i, (d, r) in enumerate(zip(x, radix, strict=True)):
        side = i >= half
        values[side], sizes[side] = values[side] * r + d, sizes[side] * r
    n = sizes[0] * sizes[1]
    if n < 2:
        return x
    shape = b"%d/%d/" % tuple(sizes)
    draw = lambda i, v, m: int.from_bytes(hashlib.blake2b(shape + b"%d/%d" % (i, v), key=key, digest_size=32).digest() * (1 + m.bit_length() // 192)) % m

    def forth(a: int, b: int) -> tuple[int, int]:
        for i in range(8):
            a, b = (a, (b + draw(i, a, sizes[1])) % sizes[1]) if i % 2 else ((a + draw(i, b, sizes[0])) % sizes[0], b)
        return a, b

    def back(a: int, b: int) -> tuple[int, int]:
        for i in reversed(range(8)):
            a, b = (a, (b - draw(i, a, sizes[1])) % sizes[1]) if i % 2 else ((a - draw(i, b, sizes[0])) % sizes[0], b)
        return a, b

    a, b = forth(*values)
    step = (a * sizes[1] + b + 1) % n
    a, b = back(*divmod(step, sizes[1]))
    out = [0] * len(x)
    for i in reversed(range(len(x))):
        if i >= half:
            b, out[i] = divmod(b, radix[i])
        else:
            a, out[i] = divmod(a, radix[i])
    return out


@cache
def _others(block: int, category: str) -> str:
    """Letters of one category in a block of 128, beside those of the named classes."""
    return "".join(c for c in map(chr, range(block << 7, (block + 1) << 7)) if unicodedata.category(c) == category and c not in _KIN)


def _class(c: str, kin: dict[str, str]) -> str | None:
    if c in kin:
        return kin[c]
    return _others(ord(c) >> 7, unicodedata.category(c)) if kin is _KIN and c.isalpha() and ord(c) > 127 else None


def _spelled(text: str, kin: dict[str, str], key: bytes) -> str:
    """text with each character that has a class moved within it."""
    found = [(i, k) for i, c in enumerate(text) if (k := _class(c, kin))]
    out = list(text)
    for at in range(0, len(found), SEGMENT):
        part = found[at : at + SEGMENT]
        own = key if not at else hashlib.blake2b(text[: part[0][0]].encode(), key=key, digest_size=32).digest()
        moved = permuted([k.index(text[i]) for i, k in part], [len(k) for _, k in part], own)
        for (i, k), v in zip(part, moved, strict=True):
            out[i] = k[v]
    return "".join(out)


def _followed(text: str, key: bytes, ok, kin: dict[str, str] = _KIN) -> str:
    """The permutation is followed until it meets a valid text: a permutation of the valid ones. It ends, as the text itself is valid and on the way; one in ten or more is valid, so it is short."""
    out = _spelled(text, kin, key)
    while not ok(out):
        out = _spelled(out, kin, key)
    return out


def _iban(text: str, key: bytes) -> str:
    """Country and check digits aside, characters move; the check digits follow from them."""
    moved = text[:2] + "00" + _spelled(text[4:], _KIN, key)
    return f"{text[:2]}{98 - _mod97(moved):02d}{moved[4:]}"


def _person(text: str, key: bytes, detector: Detector) -> str:
    out = []
    for word in re.split("([ -])", text):
        shown = {word.upper(): str.upper, word.lower(): str.lower}.get(word, str)
        name = word if word in detector.names else word.title()
        if name in detector.names and (shown is not str or name == word):
            own = detector.given[detector.names[name]]
            out.append(shown(own[permuted([0, own.index(name)], [1, len(own)], key)[1]]))
        elif word in PARTICLES or not word[:1].isalpha():
            out.append(word)
        else:
            moved = _spelled(word, _KIN, key)
            while moved.title() in detector.names or moved in detector.names or moved in PARTICLES:  # names of lists are images of lists alone
                moved = _spelled(moved, _KIN, key)
            out.append(moved)
    return "".join(out)


#: Blocks of addresses whose kind a surrogate keeps: what stays, and the numbers that the next octet may be (fixed values).
_BLOCKS = {(10,): range(256), (127,): range(256), (192, 168): range(256), (169, 254): range(256), (172,): range(16, 32), (100,): range(64, 128)}


def _block(octets: list[int]) -> tuple[int, ...] | None:
    return next((b for b, then in _BLOCKS.items() if tuple(octets[: len(b)]) == b and octets[len(b)] in then), None)


def _address(text: str, key: bytes) -> str:
    """Private, loopback, link-local and shared addresses move within their block, others among the rest."""
    octets = [int(x) for x in text.split(".")]
    block = _block(octets)
    if block:
        then, rest = _BLOCKS[block], octets[len(block) + 1 :]
        first, *others = permuted([octets[len(block)] - then.start, *rest], [len(then), *[256] * len(rest)], key)
        return ".".join(map(str, [*block, then.start + first, *others]))
    moved = permuted(octets, [256] * 4, key)
    while _block(moved):  # a twentieth of all addresses or so lies in blocks
        moved = permuted(moved, [256] * 4, key)
    return ".".join(map(str, moved))


DETECTOR = Detector()


def find(text: str) -> list[tuple[int, int, str]]:
    return DETECTOR.find(text)


def surrogate(kind: str, text: str, key: str, detector: Detector = DETECTOR) -> str:
    own = hashlib.blake2b(f"{key}/{kind}".encode(), digest_size=32).digest()
    if kind == "card":
        n, valid = sum(c.isdecimal() for c in text), _luhn(text)
        head = text[: 2 if n == 15 else 1]  # the issuer
        return head + _followed(text[len(head) :], own, lambda t: _luhn(head + t) == valid)
    if kind == "ip":
        return _address(text, own) if "." in text else _spelled(text, _HEX_IN_PLACE, own)
    if kind == "person":
        return _person(text, own, detector)
    if kind == "iban":
        return _iban(text, own)
    if kind == "national_id":
        return _followed(text, own, lambda t: (d := re.sub(r"\D", "", t))[:3] not in ("000", "666") and d[0] != "9" and d[3:5] != "00" and d[5:] != "0000")
    if kind == "email":
        name, _, end = text.rpartition(".")  # the last label stays
        return f"{_spelled(name, _KIN, own)}.{end}"
    if kind == "phone":
        code = re.match(r"\+\d{1,3}(?=\D)|\+|0|", text)[0]  # the country, or a trunk prefix, stays
        return code + _spelled(text[len(code) :], _KIN, own)
    if kind == "secret":
        head = re.match(rf"{_AWS}(?=[A-Z2-7]*[A-Z0-9])|gh[pousr]_|github_pat_|glpat-|sk-|xox[abeoprs]-|AIza|npm_|hf_|eyJ|SG\.|", text)[0]
        rest = text[len(head) :]
        kin = _HEX if re.fullmatch(r"[0-9a-f]+", rest) else _KEYED if re.fullmatch(_AWS, head) and set(rest) <= set(_KEYED) else _TOKEN
        return head + _spelled(rest, kin, own)
    raise ValueError(kind)


def secret_of(docs: DataFrame) -> str:
    """The key named in spark.loomgraph.pii.key; where none is named, one drawn from all texts, so that reruns agree and only who has the texts can know it."""
    if named := docs.sparkSession.conf.get("spark.loomgraph.pii.key", None):
        return named
    r = docs.agg(F.bit_xor(F.xxhash64("text", F.lit(1))), F.sum(F.xxhash64("text", F.lit(2)) % 2**20), F.count(F.lit(1))).first()
    return hashlib.sha256(repr(tuple(r)).encode()).hexdigest()


def detector_of(given: dict[tuple[str, str], list[str]] | None) -> Detector:
    """The detector with more given names."""
    return Detector({k: [*GIVEN.get(k, ()), *(n for n in given.get(k, ()) if n not in GIVEN.get(k, ()))] for k in {**GIVEN, **given}}) if given else DETECTOR


ENTITIES = "array<struct<kind:string,original:string,surrogate:string>>"


def redact(docs: DataFrame, *, key: str, carry: tuple[str, ...] = (), given: dict[tuple[str, str], list[str]] | None = None) -> DataFrame:
    """doc_id, text (with surrogates), entities (in order), and the columns named in carry. given: more given names, as in GIVEN."""
    attach(docs.sparkSession)
    detector = detector_of(given)
    kept = {f"carried_{c}": docs.schema[c].dataType.simpleString() for c in carry}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple[str, str], str] = {}
        kind_of = pa.list_(pa.struct([("kind", pa.string()), ("original", pa.string()), ("surrogate", pa.string())]))
        for b in pieces(batches, "text"):
            col = b.column("text")
            held = {g: pc.fill_null(pc.match_substring_regex(col, mark), False).to_pylist() for g, mark in detector.marks.items()}
            texts, found = [], []
            for i in range(b.num_rows):
                groups = {g for g, there in held.items() if there[i]}
                text = col[i].as_py() if groups else None
                spans = detector.find(text, groups) if groups else []
                out, at, own = [], 0, []
                for start, end, kind in spans:
                    original = text[start:end]
                    if (kind, original) not in known:
                        if len(known) > 100_000:  # a memory of what was computed, not a limit
                            known.clear()
                        known[kind, original] = surrogate(kind, original, key, detector)
                    out += [text[at:start], known[kind, original]]
                    own.append({"kind": kind, "original": original, "surrogate": known[kind, original]})
                    at = end
                texts.append("".join(out) + text[at:] if spans else None)
                found.append(own)
            fresh = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pc.if_else(fresh.is_valid(), fresh, col.cast(pa.string())), pa.array(found, kind_of), *(b.column(c) for c in kept)], ["doc_id", "text", "entities", *kept])

    schema = ", ".join([f"doc_id {docs.schema['doc_id'].dataType.simpleString()}", "text string", f"entities {ENTITIES}", *(f"`{c}` {t}" for c, t in kept.items())])
    rows = docs.select("doc_id", "text", *(F.col(c).alias(f"carried_{c}") for c in carry)).mapInArrow(run, schema)
    return rows.withColumnsRenamed({f"carried_{c}": c for c in carry})


def entities_of(redacted: DataFrame) -> DataFrame:
    """kind, original, surrogate: each once."""
    return redacted.select(F.explode("entities").alias("e")).select("e.*").distinct()


def collisions(entities: DataFrame) -> DataFrame:
    """kind, surrogate, originals of surrogates that stand for more than one entity."""
    return entities.groupBy("kind", "surrogate").agg(F.count(F.lit(1)).alias("originals")).where("originals > 1")


def reused(entities: DataFrame) -> DataFrame:
    """kind, surrogate of those that are somebody else's original. Persons aside: listed names move among themselves."""
    some = entities.where("kind <> 'person'")
    return some.select("kind", "surrogate").join(some.select("kind", F.col("original").alias("surrogate")), ["kind", "surrogate"], "left_semi")


def renamed(entities: DataFrame, key: str, detector: Detector | None = None) -> DataFrame:
    """The same entities under another key."""
    attach(entities.sparkSession)
    own = detector or DETECTOR

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [surrogate(k, o, key, own) for k, o in zip(b.column("kind").to_pylist(), b.column("original").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("kind"), b.column("original"), pa.array(made, pa.string())], ["kind", "original", "surrogate"])

    return entities.select("kind", "original").mapInArrow(run, "kind string, original string, surrogate string")


def replace(docs: DataFrame, *, key: str, carry: tuple[str, ...] = (), keys: int = 4, given: dict[tuple[str, str], list[str]] | None = None) -> DataFrame:
    """redact() with the first of ``keys`` keys that gives no collision in the whole corpus. Texts are read once, unless the first key collides."""
    out = stored(redact(docs, key=f"{key}/0", carry=carry, given=given), "redacted")
    pairs = stored(entities_of(out), "entities")
    unique = None
    for attempt in range(keys):
        if attempt:
            pairs = stored(renamed(pairs, f"{key}/{attempt}", detector_of(given)), "entities")
        if collisions(pairs).isEmpty():
            unique = attempt if unique is None else unique
            if reused(pairs).isEmpty():
                unique = attempt
                break
    if unique is None:
        raise RuntimeError("every key led to a collision")
    return out if not unique else redact(docs, key=f"{key}/{unique}", carry=carry, given=given)


def op9_pii(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = replace(docs, key=secret_of(docs))
    kinds = F.array_sort(F.array_distinct(F.transform("entities", lambda e: e["kind"])))
    return out.select(F.col("doc_id").cast("long").alias("doc_id"), F.size("entities").cast("long").alias("n_entities"), F.size(F.array_distinct("entities")).cast("long").alias("n_distinct"), F.array_join(kinds, ",").alias("kinds"), "text")

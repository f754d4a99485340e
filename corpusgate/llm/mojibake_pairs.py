"""Pairs of encodings besides UTF-8: national single-byte and double-byte ones read as Western European, and as each other.

A letter of such an encoding turns into one other letter, which tells nothing by
itself. So the sequences are pairs of letters (or the bytes of one ideograph),
all worked out beforehand; an automaton finds where they stand, and a run of
letters is restored only if the whole of it decodes and reads as a word.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache
from itertools import product

#: Written in, read as: scripts of one byte a letter. Only Western readings: text in another script that makes words as it stands is right.
SINGLE_BYTE = [
    ("cp1251", "cp1252"), ("cp1251", "latin-1"), ("koi8_r", "cp1252"), ("koi8_r", "latin-1"), ("iso8859_5", "latin-1"), ("cp866", "cp437"), ("cp866", "cp850"),
    ("cp1253", "cp1252"), ("cp1253", "latin-1"), ("iso8859_7", "latin-1"), ("cp1255", "cp1252"), ("iso8859_8", "latin-1"), ("cp1256", "cp1252"), ("iso8859_6", "latin-1"), ("tis_620", "latin-1"), ("cp874", "cp1252"),
]
#: Written in, read as: two bytes a sign.
DOUBLE_BYTE = [(w, r) for w in ("gb2312", "big5", "euc_kr", "shift_jis", "euc_jp") for r in ("cp1252", "latin-1")]
# Letters by falling frequency, and everyday signs of the larger scripts.
_FREQUENT = {
    "CYRILLIC": "оеаинтсрвлкмдпуяыьгзбчйхжшюцщэфъё", "GREEK": "αοιετσνηυρπκμλςίόάγέδήθωχύφβώξζψ", "HEBREW": "יוהלאתרמבשנדכחעםקפטגסזןצץךף", "ARABIC": "اليمونترسبدعفةكقحهجشصطخذثضزغظ", "THAI": "านรอกเงมยลวดทสตคปบหแจขชพไใ",
}
_EVERYDAY = {
    "gb2312": "的一是不了在人有我他这个们中来上大为和国地到以说时要就出会可也你对生能而子那得于着下自之年过发后作里用道行所然家种事成方多经么去法学如都同现当没动面起看定天分还进好小部其些主样理心本前开但因只从想实日者意无力世界合同",
    "big5": "的一是不了在人有我他這個們中來上大為和國地到以說時要就出會可也你對生能而子那得於著下自之年過發後作裡用道行所然家種事成方多經麼去法學如都同現當沒動面起看定天分還進好小部其些主樣理心本前開但因只從想實日者意無力世界合",
    "euc_kr": "이다는을가의에하고지한도로기사서은를리어인나대자있그들수해아일시정제보안녕세요습니까합",
    "shift_jis": "のにはをたがでてとしれさるいもなかすらことだ。、者人日本国年大一書です契約", "euc_jp": "のにはをたがでてとしれさるいもなかすらことだ。、者人日本国年大一書です契約",
}
#: First bytes of the rows of everyday signs in each, by the layout of the standards.
_COMMON_ROWS = {"gb2312": range(0xB0, 0xD8), "big5": range(0xA4, 0xC7), "euc_kr": range(0xB0, 0xC9), "shift_jis": range(0x88, 0x98), "euc_jp": range(0xB0, 0xD0)}
_KANA_ROWS = {"shift_jis": (0x82, 0x83), "euc_jp": (0xA4, 0xA5)}

_RUN = re.compile(r"[^\x00-\x7f\s]+")
_VOWELS = set("аеёиоуыэюяіїєАЕЁИОУЫЭЮЯІЇЄαεηιουωάέήίόύώΑΕΗΙΟΥΩ")
_LATER = {"HEBREW", "ARABIC", "THAI"}


def _read(data: bytes, encoding: str) -> str:
    out = []
    for b in data:
        try:
            out.append(bytes([b]).decode(encoding))
        except UnicodeDecodeError:
            out.append(chr(b))
    return "".join(out)


@lru_cache(1)
def _byte_of() -> dict[str, dict[str, int]]:
    """By the encoding a text was read in: character -> the byte it was read from."""
    found: dict[str, dict[str, int]] = {}
    for _, e in SINGLE_BYTE + DOUBLE_BYTE:
        if e not in found:
            found[e] = {_read(bytes([b]), e): b for b in range(0x80, 0x100)}
    return found


def _letters(encoding: str) -> list[str]:
    """The letters beyond ASCII that an encoding has, of its own script."""
    chars = [c for b in range(0x80, 0x100) if len(c := bytes([b]).decode(encoding, "ignore")) == 1]
    return [c for c in chars if c.isalpha() and not unicodedata.name(c, "").startswith("LATIN")]


@lru_cache(1)
def sequences() -> dict[str, list[tuple[str, str]]]:
    """Garbled sequence of two characters -> the pairs of encodings it may come from."""
    found: dict[str, list[tuple[str, str]]] = {}
    for pair in SINGLE_BYTE:
        looks = {c: _read(c.encode(pair[0]), pair[1]) for c in _letters(pair[0])}
        for a, b in product(looks.values(), repeat=2):
            found.setdefault(a + b, []).append(pair)
    for pair in DOUBLE_BYTE:
        for lead in [*_COMMON_ROWS[pair[0]], *_KANA_ROWS.get(pair[0], ())]:
            for trail in range(0x40 if pair[0] in ("big5", "shift_jis") else 0xA1, 0xFF):
                data = bytes([lead, trail])
                if len(data.decode(pair[0], "ignore")) == 1:
                    found.setdefault(_read(data, pair[1]), []).append(pair)
    return found


@lru_cache(1)
def automaton():
    import ahocorasick

    a = ahocorasick.Automaton()
    for garbled, pairs in sequences().items():
        a.add_word(garbled, tuple(pairs))
    a.make_automaton()
    return a


def _word(text: str) -> bool:
    """One script, one way of capitals, and a vowel where the script writes them."""
    if not all(c.isalpha() or unicodedata.category(c) in ("Mn", "Mc") for c in text):
        return False
    scripts = {unicodedata.name(c, "?").split(" ")[0] for c in text if c.isalpha()}
    if len(scripts) != 1 or "LATIN" in scripts:
        return False
    if scripts & _LATER:
        return True
    return (text.islower() or text.isupper() or text.istitle()) and not _VOWELS.isdisjoint(text)


def _signs(text: str, data: bytes, encoding: str) -> bool:
    """Signs of a double-byte script in everyday rows, with its punctuation."""
    rows = set(_COMMON_ROWS[encoding]) | set(_KANA_ROWS.get(encoding, ()))
    at, good = 0, 0
    for c in text:
        n = len(c.encode(encoding))
        good += n == 2 and (data[at] in rows or not c.isalpha())
        at += n
    return good == len(text)


def _usual(text: str, pair: tuple[str, str]) -> float:
    """How usual the letters or signs of a text are where its encoding is used, from 0 to 1."""
    letters = [c for c in text.lower() if c.isalpha()]
    if not letters:
        return 0.0
    if pair in DOUBLE_BYTE:
        return sum(c in _EVERYDAY[pair[0]] for c in letters) / len(letters)
    rows = _FREQUENT.get(unicodedata.name(letters[0], "?").split(" ")[0], "")
    # capitals in place of small letters speak for another encoding of the script
    return sum(1 - rows.index(c) / len(rows) if c in rows else 0.0 for c in letters) / len(letters) - 0.2 * sum(c.isupper() for c in text[1:]) / len(letters)


@lru_cache(100_000)
def restored(run: str, pair: tuple[str, str]) -> str | None:
    """What a run of characters stands for in a pair of encodings, or None if it doesn't decode as a whole or reads as no word."""
    written, read = pair
    table = _byte_of()[read]
    if not all(c in table for c in run):
        return None
    data = bytes(table[c] for c in run)
    try:
        text = data.decode(written)
    except UnicodeDecodeError:
        return None
    if pair in DOUBLE_BYTE:
        return text if len(text) > 1 and _signs(text, data, written) else None
    return text if len(text) > 1 and _word(text) else None


def find(text: str) -> list[tuple[int, int, str]]:
    """Start, end and original of every garbled run; none unless the runs of one pair of encodings prove it together.

    A run is bounded by ASCII, and no ASCII letter may touch it. Double-byte
    runs prove it from two signs on, single-byte words from six letters on in all,
    one of them with four. Of several pairs that restores the most holds, and of
    those the one that gives the most usual letters or signs.
    """
    pairs = {p for _, found in automaton().iter(text) for p in found}
    if not pairs:
        return []
    runs = [(m.start(), m.end(), m.group()) for m in _RUN.finditer(text) if not (text[m.start() - 1 : m.start()].isalpha() or text[m.end() : m.end() + 1].isalpha())]
    if max((b - a for a, b, _ in runs), default=0) < 4:
        return []
    best: list[tuple[int, int, str]] = []
    most = (0, 0.0)
    for pair in sorted(pairs):
        hits = [(a, b, own) for a, b, run in runs if (own := restored(run, pair)) is not None]
        total, usual = sum(b - a for a, b, _ in hits), _usual("".join(own for *_, own in hits), pair)
        proof = total >= 4 and usual >= 0.3 if pair in DOUBLE_BYTE else total >= 6 and any(b - a >= 4 for a, b, _ in hits) and usual >= 0.5
        if proof and (total, usual) > most:
            best, most = hits, (total, usual)
    return best

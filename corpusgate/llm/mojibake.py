"""Text garbled by a wrong character encoding.

The sequences that arise when a character is written in one encoding and read
in another are worked out beforehand for all encoding pairs. A multi-pattern
automaton finds them in one pass over a text, longest match first, and only
the matched spans are replaced; all other text stays as it is.

Three families of pairs are covered: UTF-8 read as a single-byte encoding, once
or twice over; Vietnamese single-byte encodings read as Western European; and
other national encodings of one or two bytes read so (``mojibake_pairs``).
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import product

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import mojibake_pairs

#: Single-byte encodings in which UTF-8 bytes are read by mistake.
READ_AS = ["cp1252", "latin-1", "cp1258", "cp1250", "cp1251", "cp1254", "cp1257", "cp437", "cp850", "mac_roman", "iso8859_15"]
#: Those that are read twice over in any order; the others are listed for reading in the same one twice.
READ_TWICE = ["cp1252", "latin-1", "cp1258"]

# The Vietnamese 8-bit standards, code by code.
# VISCII 0x80-0xFF, and TCVN 5712 lower-case letters by code.
_VISCII = (
    "ẠẮẰẶẤẦẨẬẼẸẾỀỂỄỆỐỒỔỖỘỢỚỜỞỊỎỌỈỦŨỤỲ"
    "ÕắằặấầẩậẽẹếềểễệốồổỗỠƠộờởịỰỨỪỬơớƯ"
    "ÀÁÂÃẢĂẳẵÈÉÊẺÌÍĨỳĐứÒÓÔạỷừửÙÚỹỵÝỡư"
    "àáâãảăữẫèéêẻìíĩỉđựòóôõỏọụùúũủýợỮ"
)
_TCVN = {
    0xA1: "ĂÂÊÔƠƯĐăâêôơưđ", 0xB5: "àảãáạ", 0xBB: "ằẳẵắ", 0xC6: "ặầẩẫấậè", 0xCE: "ẻẽéẹềểễếệìỉ", 0xDC: "ĩíịò", 0xE1: "ỏõóọồổỗốộờởỡớợùủũúụừửữứựỳỷỹýỵ",
}
# VNI writes a base letter and a mark; tone marks on plain, circumflex and breve vowels.
_VNI_TONES = {"": ("", "", ""), "\u0301": ("ù", "á", "é"), "\u0300": ("ø", "à", "è"), "\u0309": ("û", "å", "ú"), "\u0303": ("õ", "ã", "ü"), "\u0323": ("ï", "ä", "ë")}
_VNI_SINGLE = {"í": "í", "ì": "ì", "ỉ": "æ", "ĩ": "ó", "ị": "ò", "ỵ": "î", "đ": "ñ"}

_TONES = ["", "\u0300", "\u0309", "\u0303", "\u0301", "\u0323"]
_VOWELS = "aăâeêioôơuưy"
#: Characters that occur in texts beside plain ASCII: accented letters of the Latin script, Cyrillic and Greek letters, punctuation and signs.
_PUNCTUATION = "–—‘’‚“”„†‡•…‰‹›€™¡¢£¤¥¦§¨©ª«¬®¯°±²³´µ¶·¸¹º»¼½¾¿×÷\xa0\xad\u200b\u200c\u200d\u2060\ufeff≤≥≠√∞∑π①②③"

# Initial consonants and, by vowel group, the finals that Vietnamese syllables have.
ONSETS = "b c ch d đ g gh gi h k kh l m n ng ngh nh p ph qu r s t th tr v x".split() + [""]
_GROUPS = {
    "a": " c ch i m n ng nh o p t u y", "ă": "c m n ng p t", "â": "c m n ng p t u y", "e": " c m n ng o p t", "ê": " ch m n nh p t u", "i": " a c ch m n nh p t u",
    "o": " a c e i m n ng p t", "ô": " c i m n ng p t", "ơ": " i m n p t", "u": " a c i m n ng p t y", "ư": " a c i m n ng t u", "y": " t",
    "iê": "c m n ng p t u", "yê": "m n ng t u", "oa": " c ch i m n ng nh o p t y", "oă": "c m n ng t", "oe": " n o t m ng", "uâ": "n ng t y", "uê": " ch n nh", "uô": "c i m n ng t", "ươ": "c i m n ng p t u", "uy": " a ch n nh t p u", "uyê": "n t", "uơ": " ", "oo": "c ng",
}


def _tone(nucleus: str, tone: str, final: str) -> Iterator[str]:
    """The spellings of a vowel group with a tone, by the older and the newer habit."""
    if not tone:
        yield nucleus
        return
    marked = [i for i, c in enumerate(nucleus) if c in "ăâêôơư"]
    at = {marked[-1]} if marked else {len(nucleus) - 1} if final or len(nucleus) == 1 else {0, 1}
    for i in at:
        yield unicodedata.normalize("NFC", nucleus[: i + 1] + tone) + nucleus[i + 1 :]


@lru_cache(1)
def rimes() -> frozenset[str]:
    """Vietnamese rimes with their tones, lower case, made from the rule of vowel groups and finals."""
    found = set()
    for nucleus, finals in _GROUPS.items():
        for final in finals.split(" "):
            for tone in _TONES if final not in ("c", "ch", "p", "t") else _TONES[-2:]:
                found.update(x + final for x in _tone(nucleus, tone, final))
    return frozenset(found)


@lru_cache(200_000)
def is_syllable(word: str) -> bool:
    """Whether a lower-case word is a Vietnamese syllable: an initial and a rime."""
    return any(word[:i] in _INITIALS and word[i:] in rimes() for i in range(min(3, len(word)) + 1))


_INITIALS = frozenset(ONSETS)


def _single_byte(codes: dict[str, str]):
    return lambda s: "".join(codes.get(c, c) for c in s)


@lru_cache(1)
def legacy_writers() -> dict:
    """By name of the encoding: how lower-case Vietnamese text looks when read as Western European."""
    western = lambda b: bytes([b]).decode("cp1252", "ignore") or chr(b)
    viscii = {c: western(0x80 + i) for i, c in enumerate(_VISCII)}
    tcvn = {c: western(start + i) for start, row in _TCVN.items() for i, c in enumerate(row)}
    vni: dict[str, str] = {}
    for base, tone in product(_VOWELS, _TONES):
        c = unicodedata.normalize("NFC", base + tone)
        mark = _VNI_TONES[tone]
        if c in _VNI_SINGLE:
            vni[c] = _VNI_SINGLE[c]
        elif base in "âêô":
            plain = {"â": "a", "ê": "e", "ô": "o"}[base]
            vni[c] = plain + (mark[1] if tone else "â")
        elif base == "ă":
            vni[c] = "a" + (mark[2] if tone else "ê")
        elif base in "ơư":
            vni[c] = {"ơ": "ô", "ư": "ö"}[base] + mark[0]
        elif base != "i" or tone == "":
            vni[c] = base + mark[0]
    vni["đ"] = "ñ"
    vni |= {c.upper(): v.upper() for c, v in vni.items()}
    return {"viscii": _single_byte(viscii), "tcvn": _single_byte(tcvn), "vni": _single_byte(vni)}


def _read(data: bytes, encoding: str) -> str:
    """Decodes byte by byte; a byte the encoding leaves undefined is read as the control character of its number."""
    out = []
    for b in data:
        try:
            out.append(bytes([b]).decode(encoding))
        except UnicodeDecodeError:
            out.append(chr(b))
    return "".join(out)


def _alphabet() -> list[str]:
    latin = [chr(c) for c in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00)) if chr(c).isalpha()]
    other = [chr(c) for c in (*range(0x391, 0x3CA), *range(0x401, 0x460)) if chr(c).isalpha()]
    marks = list("\u0300\u0301\u0302\u0303\u0306\u0309\u031b\u0323")
    thai = [chr(c) for c in (*range(0xE01, 0xE3B), *range(0xE3F, 0xE5C))]
    emoji = [chr(c) for c in (*range(0x1F300, 0x1F650), *range(0x1F680, 0x1F700), *range(0x1F900, 0x1FA00))]
    return latin + other + marks + thai + emoji + list(_PUNCTUATION)


_OPENERS = set("ÂÃÊÔÁÀÌâãêôáàì\u0300")


def _plausible(garbled: str) -> bool:
    """Whether the sequence may stand in correct text: a Vietnamese letter and then only punctuation or spaces."""
    return garbled[0] in _OPENERS and all(c in " \xa0" or unicodedata.category(c) in ("Pi", "Pf", "Pd", "Ps", "Pe", "Po", "So", "Sc") for c in garbled[1:])


@lru_cache(1)
def patterns() -> dict[str, tuple[str, int]]:
    """Garbled sequence -> (original, weight); weight 2 tells by itself, 1 only beside others of weight 2.

    Sequences that are plain ASCII or a single character are left out. Where
    two originals give one sequence the first listed encoding wins.
    """
    found: dict[str, tuple[str, int]] = {}

    def add(garbled: str, original: str) -> None:
        if len(garbled) > 1 and garbled != original and not garbled.isascii():
            weak = _plausible(garbled) or all(c.isalpha() and c.lower() in _VIETNAMESE for c in garbled)
            found.setdefault(garbled, (original, 1 if weak else 2))
            if "\xa0" in garbled:  # the no-break space was made a plain one later
                found.setdefault(garbled.replace("\xa0", " "), (original, 1))

    once = [(c, e, _read(c.encode(), e)) for e in READ_AS for c in _alphabet()]
    for c, _, garbled in once:
        add(garbled, c)
    for c, e, garbled in once:
        if e in READ_TWICE:
            for second in READ_TWICE:
                add(_read(garbled.encode(), second), c)
        else:
            add(_read(garbled.encode(), e), c)
    # what is left of a letter whose last byte was lost cannot be restored
    for e in READ_AS:
        for lead in (b"\xe1\xba", b"\xe1\xbb", b"\xc3", b"\xc4", b"\xc6"):
            for lost in "?\ufffd":
                s = _read(lead, e) + lost
                found.setdefault(s, (s, 2 if lost == "\ufffd" else 1))
    return found


_VIETNAMESE = frozenset(unicodedata.normalize("NFC", v + t) for v in _VOWELS for t in _TONES) | {"đ"}


@lru_cache(1)
def automaton():
    import ahocorasick

    a = ahocorasick.Automaton()
    for garbled, (original, weight) in patterns().items():
        a.add_word(garbled, (len(garbled), original, weight))
    a.make_automaton()
    return a


@lru_cache(1)
def legacy_automaton():
    """Automaton over every Vietnamese syllable as it looks in each 8-bit encoding: in small letters, capitals, and with a capital first.

    A hit says by encoding what the syllable is, and whether it is a syllable
    also as it looks. Letters that an encoding lacks, as capitals with tones, are left out.
    """
    import ahocorasick

    cases = (str.lower, str.upper, str.capitalize)
    found: dict[str, dict[str, str]] = {}
    for name, write in legacy_writers().items():
        for initial, rime in product(ONSETS, rimes()):
            for case in cases:
                own = case(initial + rime)
                seen = write(own)
                if seen != own and not seen.isascii() and all(c not in seen for c in own if not c.isascii() and c not in write(c)):
                    found.setdefault(seen, {}).setdefault(name, own)
    a = ahocorasick.Automaton()
    for seen, originals in found.items():
        a.add_word(seen, (len(seen), originals, is_syllable(unicodedata.normalize("NFC", seen.lower()))))
    a.make_automaton()
    return a


_SPLIT = "\\s.,;:!?()\\[\\]{}\"'/\\\\|<>=+*&^%$#@~`0-9-"
_WORD = re.compile(f"[^{_SPLIT}]+")
_PARTS = re.compile(f"[{_SPLIT}]")
_UNIT = re.compile(r"(?:[mkcd]?m|ha)[²³]$|[°²³]$", re.I)

#: What it costs to read a word against the evidence, and to go from right text to garbled text or between encodings.
_STRANGE, _PROOF, _HINT, _AMBIGUOUS = 1.0, 2.0, 0.4, 0.1
_START, _ENTER, _LEAVE = 1.1, 1.4, 0.3


def _legacy(text: str) -> tuple[list[tuple[int, int, str]], int]:
    """Start, end and original of every word garbled by a Vietnamese 8-bit encoding, and how many words tell of it.

    Every word is read as it stands or as garbled by one of the encodings, so
    that the whole text costs least. Reading a word as it stands costs something
    if it is a syllable only when garbled, twice as much from five characters
    on, and less if it is short but holds a sign; reading it as garbled does if it is no syllable then, and a little if it
    is one also as it stands. Going over to garbled text costs more than one
    short word can prove. So a word that is right as it stands stays, but in the
    midst of garbled ones, and each stretch has its own encoding.
    """
    hits = {}
    telling = False
    for end, (n, originals, right) in legacy_automaton().iter_long(text):
        start = end - n + 1
        if (not start or _PARTS.match(text[start - 1])) and (end + 1 == len(text) or _PARTS.match(text[end + 1])):
            hits[start] = (end + 1, originals, right)
            telling |= not right and n > 2
    if not telling:
        return [], 0
    names = list(legacy_writers())
    words = [m for m in _WORD.finditer(text) if not m.group().isascii()]
    kinds = []
    cost, back = [0.0] + [_START] * len(names), []
    for m in words:
        own = m.group()
        end, originals, right = hits.get(m.start(), (0, {}, False))
        if end != m.end() or _UNIT.match(own):
            originals = {}
        if not originals:
            right = is_syllable(unicodedata.normalize("NFC", own.lower())) or not any(c.isascii() and c.isalpha() for c in own)
        proves = _PROOF if len(own) > 4 else _STRANGE if len(own) > 2 and any(c.isascii() and c.isalpha() for c in own) else _HINT if any(not c.isalpha() for c in own) else 0.0
        paid = [proves if originals and not right else 0.0] + [(_AMBIGUOUS if right else 0.0) if n in originals else 0.0 if len(own) < 3 and not originals else _STRANGE for n in names]
        kinds.append((originals, proves if not right else 0.0))
        moves = [[cost[c] + (0.0 if c == k else (_ENTER if k else 0.0) + (_LEAVE if c else 0.0)) for c in range(len(cost))] for k in range(len(cost))]
        came = [min(range(len(cost)), key=row.__getitem__) for row in moves]
        cost = [moves[k][c] + paid[k] for k, c in enumerate(came)]
        back.append(came)
    state = min(range(len(cost)), key=cost.__getitem__)
    out, told = [], 0
    for i in range(len(words) - 1, -1, -1):
        originals, proves = kinds[i]
        if state and (own := originals.get(names[state - 1])) is not None:
            out.append((words[i].start(), words[i].end(), own))
            told += proves > _HINT
        state = back[i][state]
    return (out[::-1], told) if told else ([], 0)


#: The last bytes that the Western European code page leaves undefined, and so turn into a question mark.
_LOST = bytes([0x81, 0x8D, 0x8F, 0x90, 0x9D])


@lru_cache(1)
def _lost_letters() -> dict[str, list[str]]:
    """Span whose last byte was lost -> the letters it may have been."""
    found: dict[str, list[str]] = {}
    for e in READ_AS:
        for lead in (b"\xe1\xba", b"\xe1\xbb", b"\xc3", b"\xc4", b"\xc6"):
            letters = [c for b in _LOST if (c := (lead + bytes([b])).decode("utf-8", "ignore")) and c.lower() in _VIETNAMESE]
            for lost in "?\ufffd":
                found.setdefault(_read(lead, e) + lost, letters)
    return found


_AROUND = re.compile(r"[^\W\d_]*")


def _fill(left: str, span: str, right: str) -> str:
    """The one letter that makes a syllable of the word around a span, else the span itself."""
    before, after = _AROUND.match(left[::-1]).group()[::-1], _AROUND.match(right).group()
    fits = [c for c in _lost_letters().get(span, []) if is_syllable((before + c + after).lower())]
    return fits[0] if len(fits) == 1 else span


def _tidy(out: list[tuple[int, int, str]], text: str) -> list[tuple[int, int, str]]:
    """Spans of UTF-8 without those in words whose other characters beyond ASCII decode to nothing and are no Vietnamese letters or signs: such a word is of another encoding."""
    kept = []
    spans = {i for a, b, _ in out for i in range(a, b)}
    for start, end, original in out:
        left, right = start, end
        while left and not text[left - 1].isspace() and not text[left - 1].isascii():
            left -= 1
        while right < len(text) and not text[right].isspace() and not text[right].isascii():
            right += 1
        alien = sum(i not in spans and text[i].isalpha() and text[i].lower() not in _VIETNAMESE for i in range(left, right))
        if 2 * alien < right - left:
            kept.append((start, end, original))
    return kept


def repair(text: str | None) -> tuple[str | None, int]:
    """The text with garbled spans restored, and the number of spans found; (text, 0) if there are none.

    Each span is decided by itself, so a text may hold stretches of several
    encodings beside correct text, which stays as it is. A span whose last byte
    was lost is restored if only one letter makes a syllable of its word. Spans
    that cannot be restored count but stay as they are. Null gives (None, 0), empty text ("", 0).
    """
    if not text or text.isascii():
        return text, 0
    sure = maybe = 0
    spans = []
    for end, (n, original, weight) in automaton().iter_long(text):
        start = end - n + 1
        # a capital inside a word in small letters is no capital
        if weight == 1 and start and text[start].isupper() and text[start - 1].islower():
            weight = 2
        sure += weight == 2
        maybe += weight == 1 and n > 2
        spans.append((start, end + 1, original))
    # a letter and two signs may stand so once, hardly twice
    sure += maybe > 1
    older, words = _legacy(text)
    others = [] if words else [x for x in mojibake_pairs.find(text) if 2 * sum(max(0, min(x[1], b) - max(x[0], a)) for a, b, _ in spans) < x[1] - x[0]]
    found = 0
    if words and sure <= 1 + words // 4:
        # what looks like UTF-8 in the midst of an 8-bit encoding is chance
        inside = (older[0][0], older[-1][1])
        spans = [x for x in spans if not inside[0] <= x[0] < inside[1]]
        sure = len(spans) if len(spans) > 1 and sure > 1 else 0
    taken = sorted([*older, *others])
    found += words + len(others)
    if sure:
        free = []
        at = 0
        for x in spans:
            while at < len(taken) and taken[at][1] <= x[0]:
                at += 1
            if at == len(taken) or x[1] <= taken[at][0]:
                free.append(x)
        found += len(free)
        taken = sorted([*taken, *_tidy(free, text)])
    if not found:
        return text, text.count("\ufffd")
    out, at = [], 0
    for start, end, original in taken:
        out.append(text[at:start])
        if original[-1] in "?\ufffd":  # its last byte is gone; the word around it may tell
            original = _fill("".join(out)[-12:], original, text[end : end + 12])
        out.append(original)
        at = end
    return "".join([*out, text[at:]]), found


def repair_encoding(df: DataFrame, columns: list[str], keep: list[str] | None = None) -> DataFrame:
    """One row for each garbled field: the ``keep`` columns, ``field_name``, ``garbled_text``, ``restored_text``, ``spans``.

    Fields that are null, empty or not garbled give no row. Rows equal to each
    other give a row each. Columns of the table other than ``keep`` are not
    read; a kept column may have any name but those four. No shuffle: every
    text is looked at once, in Arrow batches, and texts of plain ASCII are
    sorted out before they leave the JVM.
    """
    keep = keep if keep is not None else [c for c in df.columns if c not in columns]
    fields = F.explode(F.array(*[F.struct(F.lit(c).alias("field_name"), F.col(c).cast("string").alias("garbled_text")) for c in columns]))
    long = df.select(*keep, fields.alias("_f")).select(*keep, "_f.*").where(F.col("garbled_text").rlike(r"[^\x00-\x7f]"))
    schema = long.withColumn("restored_text", F.lit("")).withColumn("spans", F.lit(0)).schema

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            done = [repair(t) for t in batch["garbled_text"]]
            batch["restored_text"] = [d[0] for d in done]
            batch["spans"] = pd.Series([d[1] for d in done], index=batch.index, dtype="int32")
            batch = batch[batch["spans"] > 0]
            if len(batch):
                yield batch

    return long.mapInPandas(run, schema)

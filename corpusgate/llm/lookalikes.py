"""Text that looks the same but is written with other characters.

Strings that look alike are joined into classes by union-find: other widths
with their usual form, a letter and its accents with the precomposed letter,
every kind of space with the plain one, unseen characters with nothing, and
letters of other scripts with the Latin letter of the same shape. Membership
is transitive. In each class the member most frequent in the corpus stands for
all, and a multi-pattern automaton rewrites texts to it, longest match first.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import permutations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .mojibake import repair

# Letters of other scripts with the shape of a Latin letter, each row as "Latin: others".
SHAPES = {
    "a": "аɑα", "c": "сϲ", "d": "ԁ", "e": "еҽ", "g": "ɡց", "h": "һհ", "i": "іιı", "j": "јϳ", "k": "κк", "l": "ӏ", "n": "ոη", "o": "оοօ",
    "p": "рρ", "q": "ԛգ", "r": "гᴦ", "s": "ѕꜱ", "u": "υսᴜ", "v": "νѵ", "w": "ԝѡ", "x": "хχ", "y": "уүγ", "z": "ᴢ",
    "A": "АΑ", "B": "ВΒ", "C": "СϹ", "E": "ЕΕ", "F": "Ϝ", "G": "Ԍ", "H": "НΗ", "I": "ІΙӀ", "J": "ЈͿ", "K": "КΚ", "M": "МΜ",
    "N": "Ν", "O": "ОΟՕ", "P": "РΡ", "Q": "Ԛ", "S": "ЅՏ", "T": "ТΤ", "U": "Սᑌ", "V": "Ѵ", "W": "Ԝ", "X": "ХΧ", "Y": "УΥҮ", "Z": "Ζ",
    "Đ": "ÐƉ", "đ": "ɖ",
}
# The same for scripts and small capitals whose letters seldom stand beside Latin ones.
FURTHER_SHAPES = {
    "b": "Ꮟ", "c": "ᴄⲥ", "d": "Ꮷ", "h": "Ꮒ", "i": "Ꭵ", "o": "ᴏⲟ", "p": "ⲣ", "v": "ᴠ", "w": "ᴡ", "x": "ⲭ",
    "A": "ᎪⲀꓮ", "B": "ᏴⲂꓐ", "C": "ᏟⲤꓚ", "D": "Ꭰꓓ", "E": "ᎬⲈꓰ", "F": "ꓝ", "G": "Ꮐꓖ", "H": "ᎻⲎꓧ", "I": "Ⲓꓲ", "J": "Ꭻꓙ", "K": "ᏦⲔꓗ", "L": "Ꮮꓡ", "M": "ᎷⲘꓟ",
    "N": "Ⲛꓠ", "O": "Ⲟꓳ", "P": "ᏢⲢꓑ", "R": "Ꮢꓣ", "S": "Ꮪꓢ", "T": "ᎢⲦꓔ", "U": "ꓴ", "V": "Ꮩꓦ", "W": "Ꮃꓪ", "X": "Ⲭꓫ", "Y": "ᎩⲨꓬ", "Z": "ᏃⲌꓜ",
}
#: Kinds of space beside the plain one, and of line end beside the line feed.
SPACES = "".join(c for c in map(chr, range(0x3001)) if unicodedata.category(c) == "Zs" and c != " ")
LINE_ENDS = "\u2028\u2029"
# Code points without a picture of their own that are no format characters by category.
_FILLERS = "\u034f\u115f\u1160\u17b4\u17b5\u3164\uffa0"
_VARIATIONS = "".join(map(chr, (*range(0x180B, 0x1810), *range(0xFE00, 0xFE10), *range(0xE0100, 0xE01F0))))
# Format characters that are seen, as signs before numbers or names.
_SEEN = set("\u0600\u0601\u0602\u0603\u0604\u0605\u06dd\u070f\u0890\u0891\u08e2\U000110bd\U000110cd")
#: Characters that are not seen, by their category.
UNSEEN = "".join(c for c in map(chr, (*range(0x1D200), *range(0xE0000, 0xE0080))) if unicodedata.category(c) == "Cf" and c not in _SEEN) + _FILLERS + _VARIATIONS
_JOINERS = frozenset("\u200c\u200d")
_AFTER_SIGNS = frozenset("\u20e3" + _VARIATIONS) | frozenset(map(chr, range(0xE0020, 0xE0080)))
#: Scripts whose letters change their form beside each other.
_JOINING = ("ARABIC", "SYRIAC", "MONGOLIAN", "NKO", "MANDAIC", "DEVANAGARI", "BENGALI", "GURMUKHI", "GUJARATI", "ORIYA", "TAMIL", "TELUGU", "KANNADA", "MALAYALAM", "SINHALA", "KHMER", "MYANMAR", "TIBETAN", "THAANA")

_RESEMBLING = frozenset("".join([*SHAPES.values(), *FURTHER_SHAPES.values()]))


def _belongs(text: str, at: int) -> bool:
    """Whether an unseen character shapes what stands beside it: a joiner within a joining script or between pictures, a variation or tag after a picture."""
    before, after, c = text[at - 1 : at], text[at + 1 : at + 2], text[at]
    picture = lambda x: bool(x) and (unicodedata.category(x) in ("So", "Sk") or x in "#*0123456789\u203c\u2049\u00a9\u00ae\u2122")
    if c in _JOINERS:
        joining = lambda x: bool(x) and unicodedata.name(x, "").startswith(_JOINING)
        drawn = lambda x: bool(x) and unicodedata.category(x) in ("So", "Sk")
        return (joining(before) and (joining(after) or c == "\u200d")) or (c == "\u200d" and (drawn(before) or before in _AFTER_SIGNS) and drawn(after))
    return c in _AFTER_SIGNS and bool(before) and ((picture(before) and before not in "0123456789") or (before in "0123456789" and after == "\u20e3") or (c >= "\U000e0020" and before >= "\U0001f3f4") or unicodedata.name(before, "").startswith(("CJK", "MONGOLIAN", "KATAKANA", "HIRAGANA")))


class Classes:
    """Union-find over strings."""

    def __init__(self) -> None:
        self.parent: dict[str, str] = {}

    def find(self, x: str) -> str:
        self.parent.setdefault(x, x)
        root = x
        while self.parent[root] != root:
            root = self.parent[root]
        while self.parent[x] != root:
            self.parent[x], x = root, self.parent[x]
        return root

    def join(self, a: str, b: str) -> None:
        self.parent[self.find(a)] = self.find(b)

    def members(self) -> dict[str, list[str]]:
        out: dict[str, list[str]] = {}
        for x in list(self.parent):
            out.setdefault(self.find(x), []).append(x)
        return out


def _spellings(letter: str) -> set[str]:
    """All ways to write a precomposed letter with separate accents, also half composed and in any order."""
    base, marks = (d := unicodedata.normalize("NFD", letter))[0], d[1:]
    found = set()
    for order in permutations(marks):
        head = base
        found.add(base + "".join(order))
        for i, m in enumerate(order[:-1], 1):
            head = unicodedata.normalize("NFC", head + m)
            if len(head) != 1:
                break
            found.add(head + "".join(order[i:]))
    return {f for f in found if unicodedata.normalize("NFC", f) == letter and f != letter}


@lru_cache(1)
def classes() -> dict[str, frozenset[str]]:
    """Every string with a look-alike -> its class; the class is closed under likeness."""
    u = Classes()
    wide = [chr(c) for c in range(0xFF01, 0xFFEF) if unicodedata.decomposition(chr(c)).startswith(("<wide>", "<narrow>"))]
    for c in wide:
        u.join(c, unicodedata.normalize("NFKC", c))
    for c in map(chr, range(0x1D400, 0x1D800)):
        plain = unicodedata.normalize("NFKC", c)
        if plain != c and plain.isascii() and plain.isalnum():
            u.join(c, plain)
    for c in SPACES:
        u.join(c, " ")
    for c in LINE_ENDS:
        u.join(c, "\n")
    for c in UNSEEN:
        u.join(c, "")
    for c in map(chr, (*range(0xFB00, 0xFB07), *range(0x1C4, 0x1CD), *range(0x1F1, 0x1F4), 0x132, 0x133)):  # letters written as one
        u.join(c, unicodedata.normalize("NFKC", c))
    for shapes in (SHAPES, FURTHER_SHAPES):
        for latin, others in shapes.items():
            for c in others:
                u.join(c, latin)
    for mark in "\u0335\u0336":
        u.join("d" + mark, "đ")
        u.join("D" + mark, "Đ")
    likes = u.members()
    like = {x: tuple(m) for m in likes.values() for x in m}
    for c in map(chr, (*range(0xC0, 0x250), *range(0x386, 0x460), *range(0x1E00, 0x2000))):
        if len(unicodedata.normalize("NFD", c)) > 1 and unicodedata.normalize("NFC", c) == c:
            for written in _spellings(c):
                u.join(written, c)
                for base in like.get(written[0], ()):  # a wide or foreign letter under a separate accent
                    if base != written[0] and base and len(base) == 1:
                        u.join(base + written[1:], c)
    return {x: c for c in map(frozenset, u.members().values()) for x in c}


def _usual(member: str) -> bool:
    """Whether a string may stand for its class: nothing, or composed characters of their usual width and form."""
    return unicodedata.normalize("NFC", member) == member and not any(unicodedata.decomposition(c).startswith("<") or unicodedata.combining(c) for c in member)


def representatives(counts: dict[str, int]) -> dict[str, str]:
    """Member -> representative of its class: the usual form that is most frequent by ``counts``.

    A class with Latin letters is read as Latin, so one of them stands for it;
    ties go to the letter the others resemble, then to the smallest code point. A class with the empty string is of
    unseen characters and keeps it.
    """
    rep: dict[str, str] = {}
    for members in set(classes().values()):
        fit = [m for m in members if _usual(m)] or list(members)
        fit = [m for m in fit if _script(m) == "LATIN"] or fit
        best = "" if "" in members else min(fit, key=lambda m: (-counts.get(m, 0), m in _RESEMBLING, len(m), m))
        rep.update({m: best for m in members})
    return rep


@lru_cache(1)
def _counter():
    """Automaton over the members of several characters, and the characters they have beyond their first.

    Plain ASCII strings are not among them: none competes with another usual form.
    """
    import ahocorasick

    known = [m for m in classes() if len(m) > 1 and not m.isascii()]
    automaton = ahocorasick.Automaton()
    for m in known:
        automaton.add_word(m, m)
    automaton.make_automaton()
    return automaton, frozenset(c for m in known for c in m[1:] if not c.isascii())


def frequencies(df: DataFrame, columns: list[str]) -> dict[str, int]:
    """Occurrences in the corpus of every string that has a look-alike, the longest at each place.

    Counted per Arrow batch by the automaton and summed in the cluster. What reaches the driver
    is bounded by the number of known look-alikes, some fifteen thousand at any size.
    """
    known = frozenset(classes())
    long = df.select(F.explode(F.array(*[F.col(c).cast("string") for c in columns])).alias("t")).where("t is not null")
    schema = T.StructType([T.StructField("s", T.StringType()), T.StructField("n", T.LongType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton, parts = _counter()
        total: Counter = Counter()
        for batch in batches:
            total.update(Counter("".join(batch["t"])))
            for t in batch["t"]:
                if not t.isascii() and not parts.isdisjoint(t):
                    for _, m in automaton.iter_long(t):
                        total[m] += 1
                        total.subtract(m)  # its characters were counted singly
        kept = {c: n for c, n in total.items() if n > 0 and c in known}
        if kept:
            yield pd.DataFrame({"s": list(kept), "n": list(kept.values())})

    return {r.s: r.n for r in long.mapInPandas(run, schema).groupBy("s").agg(F.sum("n").alias("n")).collect()}


def _script(c: str) -> str:
    return unicodedata.name(c, "").split(" ")[0] if len(c) == 1 and c.isalpha() else ""


_TOKEN = re.compile(r"[^\s\d.,;:!?()\[\]{}\"'/\\|<>=+*&^%$#@~`«»“”‘’–—-]+")
_FOREIGN = {"CYRILLIC", "GREEK", "ARMENIAN", "CHEROKEE", "LISU", "COPTIC"}


class Rewriter:
    """Rewrites texts by a table of member -> representative."""

    def __init__(self, table: dict[str, str]) -> None:
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        self.foreign = {m for m in table if m and any(_script(c) in _FOREIGN for c in m)}
        for member, rep in table.items():
            if member and member != rep:
                self.automaton.add_word(member, (len(member), rep, member in self.foreign))
        self.automaton.make_automaton()
        # every member that changes has one of these
        self.telling = frozenset(m[-1] for m, rep in table.items() if m and m != rep)

    def _kept(self, text: str) -> list[tuple[int, int]]:
        """Spans of words that belong to another script, or are a symbol of it.

        A word with a letter of a foreign script that resembles no Latin one is
        foreign, and so are words all of look-alikes beside such a word. A
        single Greek letter by itself is a symbol.
        """
        words = []
        for w in _TOKEN.finditer(text):
            letters = [c for c in w.group() if c.isalpha()]
            strange = [c for c in letters if _script(c) in _FOREIGN]
            own = len(letters) - len(strange)
            sure = any(c not in self.foreign and unicodedata.normalize("NFD", c)[0] not in self.foreign for c in strange)
            words.append((w.start(), w.end(), len(letters), len(strange), own, sure, bool(strange) and _script(strange[0]) == "GREEK"))
        kept = []
        for i, (start, end, n, strange, own, sure, greek) in enumerate(words):
            if not strange or own:
                continue
            near = any(0 <= j < len(words) and words[j][5] and not words[j][4] for j in (i - 1, i + 1))
            if sure or near or (greek and n == 1):
                kept.append((start, end))
        return kept

    def rewrite(self, text: str | None) -> tuple[str | None, int]:
        """The text in its consistent form and the number of places changed; (text, 0) for null and plain text."""
        places = 0
        while text:
            text, n = self._once(text)
            places += n
            if not n:  # what an unseen character parted may form a new member
                break
        return text, places

    def _once(self, text: str) -> tuple[str, int]:
        if text.isascii() or self.telling.isdisjoint(text):
            return text, 0
        hits = [(e - n + 1, e + 1, rep, foreign) for e, (n, rep, foreign) in self.automaton.iter_long(text)]
        if not hits:
            return text, 0
        kept = self._kept(text) if any(h[3] for h in hits) else []
        out, at, n = [], 0, 0
        for start, end, rep, foreign in hits:
            if (foreign and any(a <= start < b for a, b in kept)) or (not rep and end - start == 1 and _belongs(text, start)):
                continue
            out += [text[at:start], rep]
            at, n = end, n + 1
        return "".join([*out, text[at:]]), n


def unify_lookalikes(df: DataFrame, columns: list[str], keep: list[str] | None = None, counts: dict[str, int] | None = None) -> DataFrame:
    """One row for each field with a look-alike: the ``keep`` columns, ``field_name``, ``found_text``, ``unified_text``, ``places``, ``garbled``.

    Reads the texts twice: to count characters, and to rewrite. Fields that
    are null, empty, plain or already consistent give no row; equal rows give
    a row each. ``garbled`` tells that the field holds text read with a wrong
    encoding, where odd characters stand for other bytes. A kept column may
    have any name but those five. No shuffle but of the character counts.
    """
    keep = keep if keep is not None else [c for c in df.columns if c not in columns]
    table = representatives(counts if counts is not None else frequencies(df, columns))
    fields = F.explode(F.array(*[F.struct(F.lit(c).alias("field_name"), F.col(c).cast("string").alias("found_text")) for c in columns]))
    long = df.select(*keep, fields.alias("_f")).select(*keep, "_f.*").where(F.col("found_text").rlike(r"[^\x00-\x7f]"))
    schema = long.withColumn("unified_text", F.lit("")).withColumn("places", F.lit(0)).withColumn("garbled", F.lit(True)).schema

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rewriter = Rewriter(table)
        for batch in batches:
            done = [rewriter.rewrite(t) for t in batch["found_text"]]
            batch["unified_text"] = [d[0] for d in done]
            batch["places"] = pd.Series([d[1] for d in done], index=batch.index, dtype="int32")
            batch = batch[batch["places"] > 0].copy()
            batch["garbled"] = [repair(t)[1] > 0 for t in batch["found_text"]]
            if len(batch):
                yield batch

    return long.mapInPandas(run, schema)

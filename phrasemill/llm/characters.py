"""Character tables and per-text functions for text that looks alike but is written with other characters."""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from functools import lru_cache

# Letters of other scripts drawn like a Latin letter, as 'Latin: look-alikes'.
LOOKALIKES = """
a: а α
c: с ϲ ⲥ
d: ԁ
e: е ҽ
g: ց
h: һ հ
i: і ι
j: ј ϳ
l: ӏ
n: ո
o: о ο օ ⲟ
p: р ρ ⲣ
q: ԛ գ
r: г
s: ѕ
u: ս
v: ν ѵ
w: ԝ ѡ
x: х ⲭ
y: у ү
A: А Α Ꭺ
B: В Β Ᏼ
C: С Ϲ Ꮯ Ⲥ
D: Ꭰ
E: Е Ε Ꭼ
F: Ϝ
G: Ԍ Ꮐ
H: Н Η Ꮋ
I: І Ι Ӏ
J: Ј Ꭻ
K: К Κ Ꮶ
L: Ꮮ
M: М Μ Ꮇ
N: Ν Ⲛ
O: О Ο Օ Ⲟ
P: Р Ρ Ꮲ
Q: Ԛ
R: Ꭱ
S: Ѕ Տ Ꮪ
T: Т Τ Ꭲ
U: Ս
V: Ѵ Ꮩ
W: Ԝ Ꮃ
X: Х Χ
Y: Ү Υ У
Z: Ζ Ꮓ
"""
TO_LATIN = {x: latin for latin, others in (line.split(": ") for line in LOOKALIKES.split("\n") if line) for x in others.split()}
#: A run of Latin, Greek, Cyrillic, Armenian, Cherokee or Coptic letters with their combining marks; other scripts have no look-alikes here.
WORD = re.compile("[A-Za-zªºµÀ-ÖØ-öø-ɏͰ-ϿЀ-ԯԱ-Ֆա-ևᎠ-ᏽḀ-ỿἀ-῿Ⲁ-ⳮ][A-Za-zªºµÀ-ÖØ-öø-ɏͰ-ϿЀ-ԯԱ-Ֆա-ևᎠ-ᏽḀ-ỿἀ-῿Ⲁ-ⳮ\u0300-\u036f]*")


@lru_cache(None)
def script(c: str) -> str:
    """LATIN, CYRILLIC, GREEK and so on of a letter, by the first word of its name."""
    return unicodedata.name(c, "?").split()[0]


#: Per script, its own letter for a look-alike of another script.
TO_SCRIPT: dict[str, dict[str, str]] = {"LATIN": TO_LATIN}
for _other, _latin in TO_LATIN.items():
    if _other <= "џ":  # letters of living alphabets: the rarer ones are disguises, never the meant form
        TO_SCRIPT.setdefault(script(_other), {}).setdefault(_latin, _other)
for _name, _table in TO_SCRIPT.items():
    if _name != "LATIN":
        for _other, _latin in TO_LATIN.items():
            if script(_other) != _name and _latin in _table:
                _table[_other] = _table[_latin]
_SKELETON = str.maketrans(TO_LATIN)


def _plain_table() -> dict[int, str | None]:
    """Invisible characters to nothing, single gaps to a space, full-width and mathematical forms, ligatures and numerals to ordinary ones."""
    table: dict[int, str | None] = {}
    planes = (range(0x80, 0x10000), range(0x10000, 0x14000), range(0x1BC00, 0x1BD00), range(0x1D100, 0x1D800), range(0xE0000, 0xE0200))
    for cp in (x for p in planes for x in p):
        kind = unicodedata.category(chr(cp))
        if kind == "Cf" or cp == 0x034F or 0xFE00 <= cp <= 0xFE0F or 0x180B <= cp <= 0x180F or 0xE0100 <= cp <= 0xE01EF:
            table[cp] = None
        elif kind in ("Zs", "Zl", "Zp"):
            table[cp] = " "
        elif 0xFF01 <= cp <= 0xFF60 or 0xFFE0 <= cp <= 0xFFE6 or 0xFB00 <= cp <= 0xFB06 or 0x2160 <= cp <= 0x217F or 0x1D400 <= cp <= 0x1D7FF:
            table[cp] = unicodedata.normalize("NFKC", chr(cp))
    table.update({0x2010: "-", 0x2011: "-", 0xB5: "μ"})
    table.update({ord(c): " " for c in "\t\n\v\f\r\x85"})
    return table


def _class(points: list[int]) -> str:
    """A pattern that matches any one of the sorted code points, by runs of consecutive ones."""
    runs: list[list[int]] = []
    for p in points:
        if runs and p == runs[-1][1] + 1:
            runs[-1][1] = p
        else:
            runs.append([p, p])
    return "[" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in runs) + "]"


PLAIN = _plain_table()
_TO_PLAIN = re.compile(_class(sorted(PLAIN)))
_ASCII_GAP = re.compile(r"\r\n?|[\t\n\v\f]")


def plain(text: str) -> str:
    """``text`` without differences that no reader sees, apart from look-alike letters: NFC, with every single gap a space."""
    if text.isascii():
        return _ASCII_GAP.sub(" ", text).strip()
    out = _TO_PLAIN.sub(lambda m: PLAIN[ord(m[0])] or "", text.replace("\r\n", " "))
    return (out if unicodedata.is_normalized("NFC", out) else unicodedata.normalize("NFC", out)).strip()


def skeleton(text: str) -> str:
    """``plain`` with every look-alike letter as its Latin one, accents kept: equal for texts that look the same."""
    out = plain(text)
    if out.isascii():
        return out
    return unicodedata.normalize("NFC", unicodedata.normalize("NFD", out).translate(_SKELETON))


def _resolve(word: str, target: str) -> str | None:
    """``word`` with all its foreign letters as letters of ``target``; None if one has no such form."""
    table, out = TO_SCRIPT.get(target, {}), []
    for c in unicodedata.normalize("NFD", word):
        if c.isalpha() and script(c) != target:
            c = table.get(c)
            if c is None:
                return None
        out.append(c)
    return unicodedata.normalize("NFC", "".join(out))


@lru_cache(200_000)
def _scripts(word: str) -> tuple[tuple[str, int], ...]:
    """Letters of a word by script."""
    return tuple(Counter(script(c) for c in word if c.isalpha()).items())


def suspects(text: str) -> dict[str, list[str]]:
    """Words of a plain text that mix scripts, or hold look-alikes only in a text of another script, with possible repairs.

    First comes the form in the word's dominant script (for a word of one foreign script, the text's dominant one), then
    forms in its other scripts. A script in which some letter has no form gives none; words without a form are left out.
    """
    if text.isascii():
        return {}
    words = set(WORD.findall(text))
    odd = [w for w in words if not w.isascii()]
    if not odd:
        return {}
    per = {w: dict(_scripts(w)) for w in odd}
    whole: Counter[str] = Counter(LATIN=sum(len(w) for w in words if w.isascii()))
    for n in per.values():
        whole.update(n)
    main = max(whole, key=lambda x: (whole[x], x))
    out = {}
    for w in odd:
        order = sorted(per[w], key=lambda x: (-per[w][x], x != main, x))
        if order == [main]:
            continue
        targets = order if len(order) > 1 else [main]
        forms = [f for f in (_resolve(w, t) for t in targets) if f is not None and f != w]
        if forms:
            out[w] = list(dict.fromkeys(forms))
    return out


def is_mixed(word: str) -> bool:
    """Whether a word has letters of more than one script."""
    return not word.isascii() and len(_scripts(word)) > 1


def pure_words(text: str) -> set[str]:
    """Words of one script."""
    return {w for w in WORD.findall(text) if w.isascii() or len(_scripts(w)) == 1}


def replace_words(text: str, table: dict[str, str]) -> str:
    """``text`` with whole words exchanged."""
    return WORD.sub(lambda m: table.get(m[0], m[0]), text) if table else text

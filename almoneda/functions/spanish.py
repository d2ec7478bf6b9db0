"""Spanish stems and stop words for full-text search: the published Snowball algorithm, on words whose accents may be gone."""

from __future__ import annotations

from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words that say nothing by themselves, folded.
STOP = frozenset("""
a al algo algunas algunos ante antes como con contra cual cuando de del desde donde durante e el ella ellas ellos en entre era es esa esas ese eso esos esta
estaba estado estar estas este esto estos fue fueron ha han hasta hay la las le les lo los mas me mi mis mucho muchos muy nada ni no nos nosotras nosotros
nuestra nuestras nuestro nuestros o os otra otras otro otros para pero poco por porque que quien quienes se sea sean ser si sin sobre son su sus suya suyas
suyo suyos tambien tanto te tiene tienen todo todos tu tus un una uno unos vosotras vosotros vuestra vuestras vuestro vuestros y ya yo
""".split())

VOWELS = frozenset("aeiouáéíóúü")
_PRONOUNS = ("selas", "selos", "sela", "selo", "las", "les", "los", "nos", "me", "se", "la", "le", "lo")
_PLAIN = str.maketrans("áéíóú", "aeiou")
_NOUN = ("amientos", "imientos", "amiento", "imiento", "anzas", "ismos", "ables", "ibles", "istas", "anza", "icos", "icas", "ismo", "able", "ible", "ista", "osos", "osas", "ico", "ica", "oso", "osa")
_AGENT = ("aciones", "adoras", "adores", "ancias", "adora", "ación", "antes", "ancia", "ador", "ante")
_VERB_Y = ("yamos", "yendo", "yeron", "yais", "yan", "yen", "yas", "yes", "ya", "ye", "yo", "yó")
_E = ("emos", "éis", "en", "es")
_VERB = tuple(sorted(
    [f"{v}{e}" for v in ("ar", "er", "ir") for e in ("ían", "ías", "án", "ás", "íais", "ía", "éis", "íamos", "emos", "á", "é")]
    + ["aban", "abas", "ada", "adas", "ado", "ados", "ando", "ara", "arais", "aran", "aras", "aron", "ase", "aseis", "asen", "ases", "aste", "asteis", "abais", "aba", "ábamos", "áramos", "ásemos", "amos", "an", "ar", "as", "ad"]
    + ["ida", "idas", "ido", "idos", "iendo", "iera", "ierais", "ieran", "ieras", "ieron", "iese", "ieseis", "iesen", "ieses", "iste", "isteis", "imos", "iéramos", "iésemos", "ía", "íais", "íamos", "ían", "ías", "ió", "ir", "ís", "id", "er", "ed", "áis"],
    key=len, reverse=True))


def _after(word: str, start: int) -> int:
    """Where the region after the first consonant that follows a vowel begins."""
    for i in range(start + 1, len(word)):
        if word[i] not in VOWELS and word[i - 1] in VOWELS:
            return i + 1
    return len(word)


def _regions(w: str) -> tuple[int, int, int]:
    r1 = _after(w, 0)
    r2 = _after(w, r1)
    rv = len(w)
    if len(w) > 2:
        if w[1] not in VOWELS:
            rv = next((i + 1 for i in range(2, len(w)) if w[i] in VOWELS), len(w))
        elif w[0] in VOWELS:
            rv = next((i + 1 for i in range(2, len(w)) if w[i] not in VOWELS), len(w))
        else:
            rv = 3
    return rv, r1, r2


def _ends(w: str, suffixes, region: int) -> str | None:
    """The longest of the suffixes (longest first) at the word's end, if it lies in the region."""
    s = next((s for s in suffixes if w.endswith(s)), None)
    return s if s is not None and len(w) - len(s) >= region else None


def _drop(w: str, suffixes, region: int) -> str:
    s = _ends(w, suffixes, region)
    return w[: -len(s)] if s else w


def _standard(w: str, r1: int, r2: int) -> str:
    """The noun and adjective suffixes; the word unchanged if it has none."""
    if s := _ends(w, ("amente",), r1):
        w = w[: -len(s)]
        if w.endswith("iv") and len(w) - 2 >= r2:
            return _drop(w[:-2], ("at",), r2)
        return _drop(w, ("os", "ic", "ad"), r2)
    if s := _ends(w, ("mente",), r2):
        return _drop(w[: -len(s)], ("ante", "able", "ible"), r2)
    for suffixes, put, before in ((("logías", "logía"), "log", ()), (("uciones", "ución"), "u", ()), (("encias", "encia"), "ente", ()), (("idades", "idad"), "", ("abil", "ic", "iv")), (("ivas", "ivos", "iva", "ivo"), "", ("at",)), (_AGENT, "", ("ic",)), (_NOUN, "", ())):
        if s := _ends(w, suffixes, r2):
            return _drop(w[: -len(s)], before, r2) if not put else w[: -len(s)] + put
    return w


@lru_cache(200_000)
def stem(word: str) -> str:
    w = word.lower()
    rv, r1, r2 = _regions(w)
    if p := _ends(w, _PRONOUNS, rv):
        base = w[: -len(p)]
        for accented, plain in (("iéndo", "iendo"), ("ándo", "ando"), ("ár", "ar"), ("ér", "er"), ("ír", "ir")):
            if base.endswith(accented) and len(base) - len(accented) >= rv:
                w = base[: -len(accented)] + plain
                break
        else:
            if any(base.endswith(v) and len(base) - len(v) >= rv for v in ("iendo", "ando", "ar", "er", "ir")) or (base.endswith("uyendo") and len(base) - 5 >= rv):
                w = base
    done = _standard(w, r1, r2)
    if done == w:
        if (s := _ends(w, _VERB_Y, rv)) and w[: -len(s)].endswith("u"):
            done = w[: -len(s)]
        else:
            found = [s for s in (_ends(w, _VERB, rv), _ends(w, _E, rv)) if s]
            if found:
                s = max(found, key=len)
                done = w[: -len(s)]
                if s in _E and done.endswith("gu"):
                    done = done[:-1]
    w = done
    if s := _ends(w, ("os", "a", "o", "á", "í", "ó"), rv):
        w = w[: -len(s)]
    elif _ends(w, ("e", "é"), rv):
        w = w[:-1]
        if w.endswith("gu") and len(w) - 1 >= rv:
            w = w[:-1]
    return w.translate(_PLAIN)


def lexeme(word: str) -> str:
    """The stem, or '' of a stop word, which keeps its place in a phrase."""
    return "" if word in STOP else stem(word)


def _lexemes(words: pd.Series) -> pd.Series:
    return words.map(lambda ws: None if ws is None else [lexeme(w) for w in ws])


def lexemes(words: Column) -> Column:
    """Arrays of folded words as lexemes. Python runs in Arrow batches where a catalogue is written; searches only compare."""
    return F.pandas_udf(_lexemes, "array<string>")(words)

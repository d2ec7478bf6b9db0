"""Visually identical text in different characters, brought to one form.

A quick check per character tells which can't be changed by normalization. Only the segments around the others are normalized, each from
the last safe boundary before it to the next one after it, and spliced into the unchanged text. Values that a regular expression of
stable characters covers wholly never leave the JVM.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Letters of other scripts and the Latin letters that look the same.
CYRILLIC = dict(zip("АВЕЅІЈКМНОРСТУХЗаеѕіјорсухкԁԛԝһӏ", "ABESIJKMHOPCTYX3aesijopcyxkdqwhl", strict=True))
GREEK = dict(zip("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧοανιρυχκ", "ABEZHIKMNOPTYXoavipuxk", strict=True))
LATIN = dict(zip("ıɡɑᴏ", "igao", strict=True))
ARMENIAN = dict(zip("ՕՍՏԼօսոհցզյ", "OUSLounhgqj", strict=True))
CHEROKEE = dict(zip("ᎠᎡᎢᎪᎫᎬᎳᎷᎻᏀᏃᏎᏙᏟᏢᏦᏞᏴᎽᏚ", "DRTAJEWMHGZ4VCPKLBYS", strict=True))
LISU = dict(zip("ꓐꓑꓓꓔꓖꓗꓙꓚꓜꓝꓟꓠꓡꓢꓣꓦꓧꓪꓫꓬꓮꓰꓲꓳꓴ", "BPDTGKJCZFMNLSRVHWXYAEIOU", strict=True))
COPTIC = dict(zip("ⲀⲂⲤⲎⲔⲘⲚⲞⲢⲦⲬⲟⲣⲥ", "ABCHKMNOPTXopc", strict=True))
LETTERS = CYRILLIC | GREEK | LATIN | ARMENIAN | CHEROKEE | LISU | COPTIC
#: Marks that stand in for ASCII punctuation.
MARKS = dict(zip("‚‐‑‒–—−⁄∕’‘ʼ′‛“”„″꞉∶⸱･", ",------//'''''\"\"\"\"::··", strict=True)) | {"‹": "<", "›": ">"}
#: What is plain in this domain although compatibility normalization would change it.
PLAIN = frozenset("ªº²³·´¨¸")
#: Letters and signs of Spanish and its neighbours that no step changes, for the JVM's filter.
STABLE = r"^[\x20-\x7E\t\r\nªºÀ-ÖØ-öø-ÿ]*\z"


@lru_cache(200_000)
def is_stable(c: str) -> bool:
    """The quick check: no normalization changes the character, and it never combines with the one before it."""
    if " " <= c <= "~" or c in PLAIN or c in "\t\r\n":
        return True
    if c in LETTERS or c in MARKS or invisible(c) or unicodedata.combining(c) or unicodedata.category(c) in ("Zs", "Zl", "Zp"):
        return False
    return unicodedata.is_normalized("NFKC", c) and not 0x1160 <= ord(c) <= 0x11FF


@lru_cache(10_000)
def invisible(c: str) -> bool:
    """Format and control characters, fillers and variation selectors."""
    n = ord(c)
    return unicodedata.category(c) in ("Cf", "Cc") and c not in "\t\r\n" or n in (0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x2800, 0x3164, 0xFFA0) or 0xFE00 <= n <= 0xFE0F or 0x180B <= n <= 0x180F or 0xE0100 <= n <= 0xE01EF


def segments(text: str) -> list[tuple[int, int]]:
    """Unstable stretches with their boundary context: the character before, with which a combining one may join."""
    out: list[tuple[int, int]] = []
    i, n = 0, len(text)
    while i < n:
        if is_stable(text[i]):
            i += 1
            continue
        start = i
        while i < n and not is_stable(text[i]):
            i += 1
        start = max(out[-1][1] if out else 0, start - 1)
        if out and start <= out[-1][1] and start == out[-1][1]:
            out[-1] = (out[-1][0], i)
        else:
            out.append((start, i))
    return out


def _canonical(part: str) -> str:
    """Invisible characters go, spaces become plain, the rest is composed; what is plain in this domain stays."""
    kept = []
    run: list[str] = []
    for c in part:
        if invisible(c):
            continue
        if c in PLAIN:
            kept.append(unicodedata.normalize("NFKC", "".join(run)) + c)
            run = []
        elif c in MARKS:
            run.append(MARKS[c])
        else:
            run.append(" " if unicodedata.category(c) in ("Zs", "Zl", "Zp") else c)
    return "".join(kept) + unicodedata.normalize("NFKC", "".join(run))


def _script(c: str) -> str:
    if not c.isalpha():
        return ""
    n = ord(c)
    if n < 0x250 or 0x1E00 <= n < 0x1F00:
        return "latin"
    return "other"


def _unmask(text: str, code: bool) -> str:
    """Letters of another script that stand in for Latin ones. A name in that script keeps them: one with a word of it that couldn't be
    Latin, outside words that mix both; in such a name only mixed words are read as Latin. A code is never in another script."""
    if not any(c in LETTERS for c in text):
        return text
    if code:
        return "".join(LETTERS.get(c, c) for c in text)
    words: list[tuple[int, int]] = []
    i = 0
    while i < len(text):
        if not text[i].isalpha():
            i += 1
            continue
        j = i
        while j < len(text) and text[j].isalpha():
            j += 1
        words.append((i, j))
        i = j
    kinds = [({_script(c) for c in text[a:b]}, any(_script(c) == "other" and c not in LETTERS for c in text[a:b])) for a, b in words]
    latin = any("latin" in k for k, _ in kinds)
    genuine = any(k == {"other"} and foreign for k, foreign in kinds)
    out = list(text)
    for (a, b), (k, _) in zip(words, kinds, strict=True):
        if "latin" in k or (latin and not genuine):
            out[a:b] = [LETTERS.get(c, c) for c in text[a:b]]
    return "".join(out)


def canonical(text: str | None, code: bool = False) -> str | None:
    """The consistent form of a value: null stays null, the empty text stays empty, a stable text comes back as it is."""
    if text is None:
        return None
    at, out = 0, []
    for a, b in segments(text):
        out += [text[at:a], _canonical(text[a:b])]
        at = b
    out.append(text[at:])
    spliced = "".join(out)
    unmasked = _unmask(spliced, code)
    # A letter made Latin may compose with an accent that its look-alike couldn't take.
    return unmasked if unmasked == spliced else unicodedata.normalize("NFC", unmasked)


def normalized(df: DataFrame, key: str, fields: dict[str, bool], changed_only: bool = False) -> DataFrame:
    """(key, campo, valor, limpio): the fields' values and their consistent form; fields maps a column's name to whether it is a code.

    Null values give no row with ``changed_only`` and a null form without. Rows are judged one by one: no shuffle, repeated rows stay,
    an empty table gives no rows, other columns aren't read. Ordinary Latin values pass through without Python.
    """
    one = F.explode(F.array(*[F.struct(F.lit(n).alias("campo"), F.col(n).cast("string").alias("valor"), F.lit(c).alias("codigo")) for n, c in fields.items()])).alias("f")
    rows = df.select(F.col(key).alias("id"), one).select("id", "f.*")
    plain = F.coalesce(F.col("valor").rlike(STABLE), F.lit(True))

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            b["limpio"] = [canonical(v, c) for v, c in zip(b["valor"], b["codigo"], strict=True)]
            yield b[["id", "campo", "valor", "limpio"]]

    odd = rows.where(~plain).mapInPandas(run, "id long, campo string, valor string, limpio string")
    if changed_only:
        return odd.where(~F.col("valor").eqNullSafe(F.col("limpio")))
    return rows.where(plain).select("id", "campo", "valor", F.col("valor").alias("limpio")).unionByName(odd)

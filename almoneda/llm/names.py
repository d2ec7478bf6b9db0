"""Names of companies and people as typed: stand-ins, cut ends, legal forms, trades, initials and nicknames."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable
from functools import lru_cache
from typing import NamedTuple

from almoneda.llm.lookalike import canonical

#: What is written in place of an unknown or absent value, folded, letters and digits only.
STAND_INS = frozenset("""
ND NA SN NULL NONE NAN DESCONOCIDO DESCONOCIDA NOCONSTA SINDATOS PENDIENTE VERRESOLUCION VERANEXO VERPLIEGO CONFIDENCIAL DESIERTO
DESIERTA NOPROCEDE VARIOS SINADJUDICATARIO SINADJUDICAR SINNIF NODISPONIBLE NOAPLICA NINGUNO ANONIMO SINNOMBRE NOINFORMADO
""".split())

#: Trades, as the folded words that name them.
TRADES = (
    "ASFALTOS", "COMERCIAL", "COMPANIA GENERAL", "CONSTRUCCIONES", "CONSULTORIA", "EXCAVACIONES", "GESTION AMBIENTAL", "GRUPO", "HERMANOS", "INFORMATICA", "INGENIERIA", "INSTALACIONES ELECTRICAS", "JARDINERIA", "LIMPIEZAS",
    "OBRAS Y CAMINOS", "RESTAURACION Y EVENTOS", "SEGURIDAD", "SERVICIOS INTEGRALES", "SUMINISTROS MEDICOS", "TOPOGRAFIA", "TRANSPORTES",
)

#: Short forms of given names.
NICKNAMES = {
    "PACO": "FRANCISCO", "CURRO": "FRANCISCO", "FRAN": "FRANCISCO", "KIKO": "FRANCISCO", "PACA": "FRANCISCA", "PEPE": "JOSE", "PEPA": "JOSEFA", "LOLA": "DOLORES", "LOLI": "DOLORES", "CHARO": "ROSARIO", "QUINO": "JOAQUIN", "CHIMO": "JOAQUIN",
    "NACHO": "IGNACIO", "MONTSE": "MONTSERRAT", "MERCHE": "MERCEDES", "CONCHA": "CONCEPCION", "CONCHI": "CONCEPCION", "LUPE": "GUADALUPE", "LUPITA": "GUADALUPE", "MAITE": "MARIA TERESA", "TERE": "TERESA", "MANOLO": "MANUEL", "MANU": "MANUEL",
    "SANTI": "SANTIAGO", "YAGO": "SANTIAGO", "IAGO": "SANTIAGO", "EDU": "EDUARDO", "TONI": "ANTONIO", "TOÑO": "ANTONIO", "TONO": "ANTONIO", "ANTON": "ANTONIO", "QUIQUE": "ENRIQUE", "KIKE": "ENRIQUE", "ISA": "ISABEL", "CHABELA": "ISABEL",
    "CHUS": "JESUS", "SUSO": "JESUS", "MARICARMEN": "MARIA DEL CARMEN", "MAMEN": "MARIA DEL CARMEN", "CARMELA": "MARIA DEL CARMEN", "RAFA": "RAFAEL", "JAVI": "JAVIER", "PILI": "PILAR", "ALE": "ALEJANDRO", "ALEX": "ALEJANDRO", "MARISA": "MARIA LUISA",
    "NANDO": "FERNANDO", "FEDE": "FEDERICO", "GABI": "GABRIEL", "NATI": "NATIVIDAD", "CHELO": "CONSUELO", "CHEMA": "JOSE MARIA", "MIGUE": "MIGUEL", "RAMON": "RAMON", "TINO": "FAUSTINO", "VICEN": "VICENTE", "XIMO": "JOAQUIN", "PEP": "JOSE",
}
#: Legal forms at a name's end, without dots and spaces.
FORMS = {
    "SL": "SL", "SLU": "SLU", "SA": "SA", "SAU": "SA", "SAL": "SAL", "SLL": "SLL", "SCOOP": "COOP", "COOP": "COOP", "SCL": "COOP", "SOCIEDADLIMITADA": "SL", "SOCIEDADLIMITADAUNIPERSONAL": "SLU", "SOCIEDADANONIMA": "SA",
    "SOCIEDADANONIMALABORAL": "SAL", "SOCIEDADLIMITADALABORAL": "SLL", "SOCIEDADCOOPERATIVA": "COOP", "SOCIEDADANONIMAUNIPERSONAL": "SA", "GMBH": "GMBH",
}
_TAILS = {"EMPRESA", "YCIA", "CIA", "SOCIEDAD", "LIMITADA"}
_LINKING = {"Y", "&", "DE", "DEL", "LA", "SR", "SRA", "DON", "DNA"}
_TOKEN = re.compile(r"[^\W_]+|&")


@lru_cache(50_000)
def fold(text: str) -> str:
    """Upper case without accents, look-alike characters made plain."""
    if text.isascii() and text.isprintable():
        return text.upper()
    plain = canonical(text) or ""
    return "".join(c for c in unicodedata.normalize("NFD", plain.upper()) if not unicodedata.combining(c))


def squeezed(text: str) -> str:
    """Folded letters and digits only: equal for spellings that differ in case, accents, spacing and punctuation."""
    return "".join(c for c in fold(text) if c.isalnum())


def is_stand_in(text: str | None) -> bool:
    """Null, blank, punctuation only, a row of X, or a word for unknown."""
    if text is None:
        return True
    s = squeezed(text)
    return not s or s in STAND_INS or not s.strip("X") or not any(c.isalpha() for c in s)


def form_at(tokens: list[str]) -> tuple[str | None, int]:
    """The legal form at the end of the tokens, and how many of them it takes."""
    for n in range(min(4, len(tokens) - 1), 0, -1):
        got = FORMS.get("".join(tokens[-n:]))
        if got:
            return got, n
    return None, 0


def is_joint(text: str) -> bool:
    """A joint venture: it has its members' names but is none of them."""
    tokens = _TOKEN.findall(fold(text))
    return "UTE" in tokens or any(tokens[i : i + 3] == ["U", "T", "E"] for i in range(len(tokens)))


def ends_whole(text: str, company: bool) -> bool:
    """A company's name has its legal form; a person's at least three words."""
    tokens = _TOKEN.findall(fold(text))
    return form_at(tokens)[0] is not None if company else len(tokens) >= 3


def is_filler(word: str) -> bool:
    """Words that reading passes over: linking ones, and what stands about a legal form."""
    return word in _LINKING or word in _TAILS


class Name(NamedTuple):
    trade: str | None
    words: tuple[str, ...]
    initials: tuple[str, ...]
    form: str | None


def _subsequence(a: str, b: str) -> bool:
    it = iter(b)
    return all(c in it for c in a)


def edits(a: str, b: str, most: int = 99) -> int:
    """Optimal string alignment distance, given up beyond ``most``."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    far = most + 1
    two: list[int] = []
    one = [min(j, far) for j in range(len(b) + 1)]
    for i, x in enumerate(a, 1):
        # Only cells within ``most`` of the diagonal can end within it.
        low, high = max(1, i - most), min(len(b), i + most)
        now = [far] * (len(b) + 1)
        now[0] = min(i, far)
        best = now[0]
        for j in range(low, high + 1):
            y = b[j - 1]
            if x == y:
                d = one[j - 1]
            else:
                d = 1 + min(one[j], now[j - 1], one[j - 1])
                if i > 1 and j > 1 and x == b[j - 2] and y == a[i - 2] and two[j - 2] + 1 < d:
                    d = two[j - 2] + 1
            now[j] = d
            if d < best:
                best = d
        if best > most:
            return far
        two, one = one, now
    return one[-1]


class Lexicon:
    """How names are read: trades (phrases of folded words) and short forms of given names. The tables are arguments; by default those
    above. Reading is remembered, as names' words come again and again."""

    def __init__(self, trades: Iterable[str] = TRADES, nicknames: dict[str, str] | None = None) -> None:
        self.trades, self.nicknames = tuple(trades), NICKNAMES if nicknames is None else nicknames
        self.words = {w: t for t in self.trades for w in t.split() if w != "Y"}
        self.letters = {w: frozenset(w) for w in self.words if len(w) >= 6}
        self.trade_word = lru_cache(200_000)(self._trade_word)
        self.parse = lru_cache(100_000)(self.read)

    def __reduce__(self):
        return _lexicon, (self.trades, tuple(sorted(self.nicknames.items())))

    def _trade_word(self, token: str) -> str | None:
        """The trade's word that a token is, abbreviates or misspells."""
        if token in self.words:
            return token
        if len(token) < 3:
            return None
        starts = [w for w in self.words if w.startswith(token)]
        if starts:
            return "COMERCIAL" if token == "COM" else min(starts, key=len)
        short = [w for w in self.words if w[0] == token[0] and len(token) < len(w) and _subsequence(token, w) and token[-1] in w[len(w) // 2 :]]
        # Drawn together: consonants side by side, as no whole word of a name would have them.
        if short and (re.search(r"[^AEIOU]{2}", token) or len(token) >= 6 or token in ("CIA", "CIAL")):
            if token in ("CIA", "CIAL"):
                return "COMPANIA" if token == "CIA" else "COMERCIAL"
            return max(short, key=lambda w: (w[-1] == token[-1], len(token) / len(w)))
        if len(token) >= 6:
            # An edit changes at most one letter of each side.
            letters = set(token)
            alike = [w for w, ws in self.letters.items() if abs(len(w) - len(token)) <= 2 and len(letters - ws) <= 2 and len(ws - letters) <= 2]
            near = [w for w in alike if edits(token, w, 2) <= (2 if len(w) >= 9 else 1)]
            if near:
                return min(near, key=lambda w: edits(token, w, 2))
        return None

    def read(self, text: str) -> Name:
        """Trade, other words, initials and legal form of a name in any order; nicknames and abbreviations written out."""
        tokens = _TOKEN.findall(fold(text))
        form, n = form_at(tokens)
        if n:
            tokens = tokens[:-n]
        while len(tokens) > 1 and (tokens[-1] in _TAILS and not (tokens[-1] == "CIA" and len(tokens) < 2)):
            tail = tokens.pop()
            if tail == "CIA" and tokens[-1] in ("Y", "&"):
                tokens.pop()
        if form is None:
            form, n = form_at(tokens)
            tokens = tokens[: len(tokens) - n]
        # A whole trade word outweighs a long abbreviation, that a short one; what belongs to another trade than the strongest is a name.
        found = {t: w for t in tokens if len(t) > 1 and (w := self.trade_word(t)) is not None}
        trade = max((((t == w) * 2 + (len(t) > 3), self.words[w]) for t, w in found.items()), default=(0, None))[1]
        words: dict[str, None] = {}
        initials: list[str] = []
        for i, t in enumerate(tokens):
            if t in _LINKING:
                continue
            if t == "O" and any(found.get(x) == "CAMINOS" for x in tokens[i + 1 : i + 3]):
                trade = "OBRAS Y CAMINOS"
            elif t in found and self.words[found[t]] == trade:
                continue
            elif len(t) == 1:
                initials.append(t)
            elif t in self.nicknames:
                words |= dict.fromkeys(x for x in self.nicknames[t].split() if x != "DEL")
            else:
                words[t] = None
        return Name(trade, tuple(words), tuple(dict.fromkeys(initials)), form)


@lru_cache(8)
def _lexicon(trades: tuple[str, ...], nicknames: tuple[tuple[str, str], ...]) -> Lexicon:
    """One a worker process and table, so that what it has read is remembered between batches."""
    return Lexicon(trades, dict(nicknames))


STANDARD = Lexicon()
parse = STANDARD.parse
